from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from txmon.functions.timestamps import (
    SHAPES,
    known_shape,
    normalize_ts,
    parse_shaped,
    parse_timestamp,
)
from txmon.operators.clean import parse_timestamps

# The layouts, in the order they are to be tried.
LAYOUTS = (
    "dd-MM-yyyy HH:mm", "dd-MM-yyyy HH:mm:ss", "dd-MM-yyyy",
    "MM/dd/yyyy HH:mm:ss", "MM/dd/yyyy hh:mm:ss a", "MM/dd/yyyy",
    "dd/MM/yyyy HH:mm:ss", "dd/MM/yyyy",
    "MMM dd yyyy HH:mm:ss", "MMM-dd-yyyy HH:mm:ss",
    "yyyy.MM.dd HH:mm:ss", "yyyy/MM/dd HH:mm:ss", "yyyy/MM/dd HH:mm",
    "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm",
    "yyyyMMdd", "yyyyMMdd HHmmss", "yyyyMMdd HHmm",
)


def parsed(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, booking_ts string")
    rows = parse_timestamps(df).orderBy("id").collect()
    return [(r["__norm_booking_ts"], r["booking_ts_ts"]) for r in rows]


CASES = [
    ("05-01-2026 10:11", dt.datetime(2026, 1, 5, 10, 11)),
    ("05-01-2026 10:11:12", dt.datetime(2026, 1, 5, 10, 11, 12)),
    ("05-01-2026", dt.datetime(2026, 1, 5)),
    ("03/04/2026 10:11:12", dt.datetime(2026, 3, 4, 10, 11, 12)),
    ("13/04/2026 10:11:12", dt.datetime(2026, 4, 13, 10, 11, 12)),
    ("13/04/2026", dt.datetime(2026, 4, 13)),
    ("03/04/2026 01:11:12 pm", dt.datetime(2026, 3, 4, 13, 11, 12)),
    ("13/04/2026 01:11:12 PM", None),
    ("Oct 05 2026 10:00:00", dt.datetime(2026, 10, 5, 10)),
    ("Sep-05-2026 10:00:00", dt.datetime(2026, 9, 5, 10)),
    ("2026.01.05 10:11:12", dt.datetime(2026, 1, 5, 10, 11, 12)),
    ("2026.01.05", None),
    ("2026/01/05 10:11", dt.datetime(2026, 1, 5, 10, 11)),
    ("2026/01/05", None),
    ("2026-01-05_10:11:12 UTC", dt.datetime(2026, 1, 5, 10, 11, 12)),
    ("20260105", dt.datetime(2026, 1, 5)),
    ("20260105 1011", dt.datetime(2026, 1, 5, 10, 11)),
    ("20260105 101112", dt.datetime(2026, 1, 5, 10, 11, 12)),
    ("2026-007 15:00:00", dt.datetime(2026, 1, 7, 15)),
    ("2026-007 15:00:00.5 and more", dt.datetime(2026, 1, 7, 15)),
    ("2026-007", None),
    ("2026-400 15:00:00", None),
    ("2026-366 15:00:00", None),
    ("2024-366 15:00:00", dt.datetime(2024, 12, 31, 15)),
    ("2026-01-05T10:00:00Z", dt.datetime(2026, 1, 5, 10)),
    ("2026-01-05T10:00:00+05:30", dt.datetime(2026, 1, 5, 4, 30)),
    ("2026-01-05 10:00:00 America/New_York", dt.datetime(2026, 1, 5, 15)),
    ("2026-01-05 10:00:00.25", dt.datetime(2026, 1, 5, 10, 0, 0, 250000)),
    ("  2026-01-05  ", dt.datetime(2026, 1, 5)),
    ("2026", dt.datetime(2026, 1, 1)),
    ("31-02-2026", None),
    ("UNKNOWN", None),
    ("", None),
    ("UTC", None),
    (None, None),
    # a time of day alone is not today
    ("45:00.0", None),
    ("10:30", None),
    ("10:30:00", None),
    ("T10:30", None),
    ("T10", None),
    ("10:30 UTC", None),
    # exponents
    ("2.02601E+13", None),
    ("2.0E+3", dt.datetime(2000, 1, 1)),
    # years no calendar in use has
    ("202601", None),
    ("12026-01-01", None),
    ("02026-01-01", dt.datetime(2026, 1, 1)),
    ("012026-01-01", None),
    ("00000-01-01", None),
    ("-2026-01-01", None),
    ("0000-01-01", None),
    ("01-01-0000", None),
    ("01-01-+12026 10:00", None),
]


def test_known_instants(spark):
    results = parsed(spark, [text for text, _ in CASES])
    wrong = [
        (text, want, got)
        for (text, want), (_, got) in zip(CASES, results, strict=True)
        if got != want
    ]
    assert wrong == []


@pytest.mark.parametrize(
    ("raw", "norm"),
    [
        (" 2026-01-05T10:00:00Z ", "2026-01-05 10:00:00"),
        ("2026-01-05_10:00:00 GMT", "2026-01-05 10:00:00"),
        ("Oct 05 2026 10:00:00", "Oct 05 2026 10:00:00"),
        ("2.02601E+13", "20260100000000"),
        ("Z", None),
        ("   ", None),
        (None, None),
    ],
)
def test_normalized_text(spark, raw, norm):
    df = spark.createDataFrame([(raw,)], "booking_ts string")
    assert df.select(normalize_ts(F.col("booking_ts"))).first()[0] == norm
    assert parsed(spark, [raw])[0][0] == norm


def test_one_column_expression(spark):
    df = spark.createDataFrame([("13/04/2026",), ("10:30",)], "t string")
    assert [r[0] for r in df.select(parse_timestamp(F.col("t"))).collect()] == [
        dt.datetime(2026, 4, 13), None,
    ]


def _corpus(size: int) -> list[str]:
    """Times in every layout, some of them damaged."""
    rng = random.Random(7)
    formats = [
        "%d-%m-%Y %H:%M", "%d-%m-%Y %H:%M:%S", "%d-%m-%Y", "%m/%d/%Y %H:%M:%S",
        "%m/%d/%Y %I:%M:%S %p", "%m/%d/%Y", "%d/%m/%Y %H:%M:%S", "%d/%m/%Y",
        "%b %d %Y %H:%M:%S", "%b-%d-%Y %H:%M:%S", "%Y.%m.%d %H:%M:%S", "%Y/%m/%d %H:%M:%S",
        "%Y/%m/%d %H:%M", "%Y-%m-%d %H:%M:%S", "%Y-%m-%d %H:%M", "%Y%m%d", "%Y%m%d %H%M%S",
        "%Y%m%d %H%M", "%Y-%j %H:%M:%S", "%Y-%m-%dT%H:%M:%SZ", "%Y-%m-%dT%H:%M:%S+05:30",
        "%Y-%m-%d_%H:%M:%S UTC", "%Y-%m-%d", "%Y-%m", "%Y", "%H:%M",
    ]
    start = dt.datetime(1995, 1, 1)
    texts = []
    for _ in range(size):
        moment = start + dt.timedelta(seconds=rng.randrange(40 * 365 * 86400))
        text = moment.strftime(rng.choice(formats))
        for _ in range(rng.choice([0, 0, 1, 1, 2])):
            at = rng.randrange(len(text) + 1)
            edit = rng.choice(["drop", "put", "swap"])
            if edit == "drop":
                text = text[:at] + text[at + 1 :]
            elif edit == "put":
                text = text[:at] + rng.choice("0123456789-/:. TZ_+aM") + text[at:]
            else:
                text = text[:at] + rng.choice("0123456789-/:. TZ_+aM") + text[at + 1 :]
        texts.append(text)
    return texts


def test_same_as_trying_every_layout_in_order(spark):
    """Deciding by separator gives what the plain list of attempts gives."""
    texts = _corpus(6000)
    df = parse_timestamps(
        spark.createDataFrame(list(enumerate(texts)), "id int, booking_ts string").repartition(8)
    )
    norm = F.col("__norm_booking_ts")
    ordinal = F.regexp_extract(norm, r"^(\d{4}-\d{3})\s+\d{2}:\d{2}:\d{2}", 1)
    clock = F.regexp_extract(norm, r"^\d{4}-\d{3}\s+(\d{2}:\d{2}:\d{2})", 1)
    attempts = [F.try_to_timestamp("booking_ts"), F.try_to_timestamp(norm)]
    attempts += [F.try_to_timestamp(norm, F.lit(layout)) for layout in LAYOUTS]
    attempts.append(
        F.try_to_timestamp(F.concat_ws(" ", ordinal, clock), F.lit("yyyy-DDD HH:mm:ss"))
    )
    first = F.coalesce(*attempts)
    dateless = norm.rlike(r"^[Tt]?\d{1,2}(:|$)") & ~norm.rlike(r"^\d{1,2}$")
    plain = F.when(dateless, F.lit(None)).otherwise(first)
    plain = F.when(F.year(plain).between(1, 9999), plain)
    # Compared as text: Python cannot hold some of the instants a wrong parse gives.
    checked = df.select(
        "booking_ts",
        norm.alias("norm"),
        F.col("booking_ts_ts").cast("string").alias("got"),
        plain.cast("string").alias("want"),
    )
    wrong = checked.where(~F.col("got").eqNullSafe(F.col("want")))
    assert [tuple(r) for r in wrong.take(20)] == []
    assert checked.where("got IS NOT NULL").count() > 2000


def test_shapes_are_read_as_the_patterns_read_them(spark):
    rng = random.Random(3)
    texts = [
        "".join(rng.choice("0001112234569") if c == "0" else c for c in shape)
        for shape in SHAPES
        for _ in range(400)
    ]
    # Years 0, 1 and 9999, days and hours out of range.
    texts += [shape.replace("0", d) for shape in SHAPES for d in "0129"]
    df = spark.createDataFrame([(t,) for t in texts], "raw string").select(
        "raw", known_shape(F.col("raw")).alias("shape")
    )
    assert df.where("shape IS NULL").count() == 0
    got = parse_shaped(F.col("raw"), F.col("shape")).cast("string")
    want = parse_timestamp(F.col("raw")).cast("string")
    checked = df.select("raw", got.alias("got"), want.alias("want"), normalize_ts(F.col("raw")).alias("norm"))
    assert [tuple(r) for r in checked.where("NOT got <=> want OR norm <> raw").take(20)] == []
    assert checked.where("got IS NOT NULL").count() > 500


def test_other_texts_have_no_shape(spark):
    others = ["", " 2026-01-01", "2026-01-01 ", "2026-1-01", "20260101 12", "1234", "2026-01-01T00:00:00",
              "٢٠٢٦-01-01", None, "00:00", "2026-01-01 00:00:00.5", "26-01-2026 1:00"]
    df = spark.createDataFrame([(t,) for t in others], "raw string")
    assert df.select(known_shape(F.col("raw")).alias("s")).where("s IS NOT NULL").count() == 0
