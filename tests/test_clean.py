from __future__ import annotations

from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from txmon.operators import clean, quality


def one_column(spark, name, values):
    rows = [(i, v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, f"id int, {name} string")


def values(df, name):
    return [r[name] for r in df.orderBy("id").collect()]


def test_null_tokens_are_exact_and_leave_others_untrimmed(spark):
    raw = [" UNKNOWN ", "NULL", "null", "N/A", "na", "", "  ", None, "Unknown", "NA", "n/a", " x "]
    df = clean.null_tokens(one_column(spark, "v", raw))
    assert values(df, "v") == [None] * 8 + ["Unknown", "NA", "n/a", " x "]


def test_null_tokens_touch_only_strings(spark):
    df = spark.createDataFrame([(1, "na", 2.0)], "id int, s string, d double")
    assert clean.null_tokens(df).first().asDict() == {"id": 1, "s": None, "d": 2.0}


def test_scrub_text_replaces_each_control_character(spark):
    df = clean.scrub_text(one_column(spark, "reference", ["a\r\nb\tc", "a  b", None]))
    assert values(df, "reference") == ["a  b c", "a  b", None]


def test_absent_columns_are_skipped(spark):
    df = one_column(spark, "other", [" a\t"])
    for step in (clean.scrub_text, clean.normalize_codes, clean.parse_booleans):
        assert values(step(df), "other") == [" a\t"]
    assert clean.parse_timestamps(df, []).columns == ["id", "other"]


def test_codes(spark):
    df = clean.normalize_codes(one_column(spark, "currency_code", [" usd ", "EUR", None]))
    assert values(df, "currency_code") == ["USD", "EUR", None]


def test_levels_and_states_are_not_codes(spark):
    df = clean.normalize_codes(one_column(spark, "acct_status", [" dormant "]))
    assert values(df, "acct_status") == [" dormant "]


def test_booleans(spark):
    raw = ["true", "FALSE", "True", "true ", "1", "", None]
    for name in ("any_flag", "is_deleted"):
        df = clean.parse_booleans(one_column(spark, name, raw))
        assert values(df, name) == [True, False, True, None, None, None, None]


def test_amounts(spark):
    expected = {
        "1,234.50": ("1234.50", "1234.50", 0),
        "(1,234.50)": ("1234.50", "1234.50", 0),
        "$-5": ("-5", "-5.00", 1),
        "1.2E5": ("1.25", "1.25", 0),
        "1.234,56": ("1.23456", "1.23", 0),
        "abc": ("", None, 1),
        "1.2.3": ("1.2.3", None, 1),
        "1.005": ("1.005", "1.01", 0),
        "99999999999999999999": ("99999999999999999999", None, 1),
        None: (None, None, 1),
    }
    df = clean.clean_amount(one_column(spark, "amount", list(expected)))
    got = [
        (r["amount_clean_str"], r["amount_num"], r["dq_amount_invalid"])
        for r in df.orderBy("id").collect()
    ]
    assert got == [(s, n and Decimal(n), q) for s, n, q in expected.values()]


@settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    st.lists(
        st.text(alphabet=" \t\nTRUEFALSuetrnaN/K.0", max_size=8) | st.none(),
        min_size=1,
        max_size=40,
    )
)
def test_cleaning_twice_changes_nothing(spark, texts):
    df = one_column(spark, "reference", texts).withColumn("status", F.col("reference"))
    for step in (clean.null_tokens, clean.scrub_text, clean.normalize_codes):
        once = step(df)
        assert sorted(map(str, step(once).collect())) == sorted(map(str, once.collect()))


def test_quality_of_nothing(spark):
    empty = spark.createDataFrame([], "transaction_id string, dq_amount_invalid int")
    assert quality.null_profile(empty, ["transaction_id"]).first()[0] is None
    assert quality.amount_status(empty).count() == 0
