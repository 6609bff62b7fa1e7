"""One file read by many tasks gives what Spark's own reader gives in one."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from txmon.sources import files, split_csv


@pytest.fixture
def small_blocks(settings):
    """Blocks of a few lines, so that most records are near an edge."""

    def size(octets: int) -> None:
        settings(
            {"spark.sql.files.maxPartitionBytes": str(octets), "spark.sql.files.openCostInBytes": "0",
             "spark.sql.files.minPartitionNum": "64"}
        )

    return size


def rows(df):
    return sorted(map(repr, map(tuple, df.drop("_source_file").collect())))


def _field(rng: random.Random) -> str:
    plain = rng.choice(["", "x", " padded ", "12.50", "é€😀", "a;b"])
    kind = rng.random()
    if kind < 0.5:
        return plain
    parts = [rng.choice(["line\n", '""', ",", "word ", "\r\n", "\n\n", "é", ""]) for _ in range(rng.randint(0, 12))]
    return '"' + "".join(parts) + '"'


def _file(seed: int, records: int, columns: int = 4, end: str = "\n") -> str:
    rng = random.Random(seed)
    lines = [",".join(f"c{k}" for k in range(columns))]
    for _ in range(records):
        n = rng.choice([columns, columns, columns, columns - 1, columns + 1])
        lines.append(",".join(_field(rng) for _ in range(n)))
    return end.join(lines) + end * rng.randint(0, 2)


@pytest.mark.parametrize("octets", [64, 300, 1 << 20])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_same_as_the_reader_of_whole_files(spark, tmp_path, small_blocks, octets, seed):
    for k in range(2):
        (tmp_path / f"{k}.csv").write_text(_file(seed * 10 + k, 150), newline="")
    want = rows(files.read_raw_csv(spark, str(tmp_path)))
    small_blocks(octets)
    assert rows(split_csv.read_split_csv(spark, str(tmp_path))) == want


def test_one_file_is_read_by_many_tasks(spark, tmp_path, small_blocks):
    (tmp_path / "big.csv").write_text(_file(5, 3000), newline="")
    small_blocks(4096)
    read = split_csv.read_split_csv(spark, str(tmp_path / "big.csv"))
    tasks = read.select(F.spark_partition_id()).distinct().count()
    assert tasks > 8
    # Records stay where they were read: only those put together from parts are shuffled.
    whole = str(read._jdf.queryExecution().optimizedPlan().toString())
    assert "Join" not in whole
    assert rows(read) == rows(files.read_raw_csv(spark, str(tmp_path / "big.csv")))


def test_a_record_over_many_blocks(spark, tmp_path, small_blocks):
    long = "".join(f"line {k},\n" for k in range(400))
    (tmp_path / "a.csv").write_text(f'id,text\n1,"{long}"\n2,x\n3,"{long}""{long}"\n4,y\n')
    small_blocks(100)
    found = {r["id"]: r["text"] for r in split_csv.read_split_csv(spark, str(tmp_path)).collect()}
    assert found == {"1": long, "2": "x", "3": f'{long}"{long}', "4": "y"}


def test_windows_line_ends(spark, tmp_path, small_blocks):
    text = "id,text\r\n" + "".join(f'{k},"a\r\nb"\r\n\r\n-{k},c\r\n' for k in range(1, 60))
    (tmp_path / "a.csv").write_text(text, newline="")
    small_blocks(50)
    found = {r["id"]: r["text"] for r in split_csv.read_split_csv(spark, str(tmp_path)).collect()}
    assert found == {str(k): "a\r\nb" if k > 0 else "c" for k in range(-59, 60) if k}


def test_columns_are_taken_by_name(spark, tmp_path):
    texts = ["a,b\n1,2\n", "b,a\n3,4\n", "a,c,b\n5,6,7\n", "b\n8\n", "a,b\n", ""]
    for k, text in enumerate(texts):
        (tmp_path / f"{k}.csv").write_text(text)
    read = split_csv.read_split_csv(spark, str(tmp_path))
    assert read.columns == ["a", "b", "c", "_source_file"]
    assert sorted((r["a"] or "", r["b"], r["c"]) for r in read.collect()) == [
        ("", "8", None), ("1", "2", None), ("4", "3", None), ("5", "7", "6"),
    ]
    assert {r["_source_file"].rsplit("/", 1)[1] for r in read.collect()} == {f"{k}.csv" for k in range(4)}
    some = split_csv.read_split_csv(spark, str(tmp_path), ["c", "z", "a"])
    assert sorted(map(str, (r[:3] for r in some.collect()))) == sorted(
        map(str, [(None, None, "1"), (None, None, "4"), ("6", None, "5"), (None, None, None)])
    )


@pytest.mark.parametrize("line", ['5" pipe,x', '"a"b,c', 'x,a "quoted" word'])
def test_quotes_out_of_place_fail(spark, tmp_path, line):
    (tmp_path / "a.csv").write_text(f"id,text\n1,x\n{line}\n2,y\n")
    with pytest.raises(Exception, match="neither at the edge of a field nor doubled"):
        split_csv.read_split_csv(spark, str(tmp_path)).collect()


@pytest.mark.parametrize("line", ["", '"""",""', '"a""","""b"', '"a"",""b",c', '"x\n"" , ""\ny"'])
def test_quotes_in_place_pass(spark, tmp_path, line):
    (tmp_path / "a.csv").write_text(f"id,text\n1,x\n{line}\n2,y\n")
    assert rows(split_csv.read_split_csv(spark, str(tmp_path))) == rows(
        files.read_raw_csv(spark, str(tmp_path))
    )


@pytest.mark.parametrize("text", ['"a\nb",c\n1,2\n', "a,a\n1,2\n"])
def test_headers_that_are_refused(spark, tmp_path, text):
    (tmp_path / "a.csv").write_text(text)
    with pytest.raises(ValueError, match="header"):
        split_csv.read_split_csv(spark, str(tmp_path))


def test_no_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    assert split_csv.read_split_csv(spark, str(tmp_path)).columns == ["_source_file"]
    (tmp_path / "b.csv").write_text("a,b")
    read = split_csv.read_split_csv(spark, str(tmp_path))
    assert (read.columns, read.count()) == (["a", "b", "_source_file"], 0)
