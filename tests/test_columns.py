from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from feedforge.functions import columns as C


def one(spark, column, value, kind):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column.alias("y")).first()["y"]


@pytest.mark.parametrize("given, folded", [
    ("like", "LIKE"), ("ReTweet", "RETWEET"), ("  LIKE  ", "LIKE"), ("CLAP", "UNKNOWN"),
    ("", "UNKNOWN"), (None, "UNKNOWN"), ("\tLIKE", "UNKNOWN"),
])
def test_engagement_type(spark, given, folded):
    assert one(spark, C.engagement_type("x"), given, "string") == folded


@pytest.mark.parametrize("kind, weight", [
    ("LIKE", 1.0), ("REPLY", 2.0), ("RETWEET", 3.0), ("QUOTE", 4.0), ("VIEW", 0.1), ("UNKNOWN", 1.0),
])
def test_weight(spark, kind, weight):
    assert one(spark, C.engagement_weight("x"), kind, "string") == weight


@pytest.mark.parametrize("total, tier", [
    (10000, "viral"), (9999, "high"), (1000, "high"), (999, "medium"), (100, "medium"), (99, "low"), (0, "low"),
])
def test_tier(spark, total, tier):
    assert one(spark, C.engagement_tier("x"), total, "bigint") == tier


@pytest.mark.parametrize("total, shown, rate", [
    (20, 1000, 2.0), (5, 0, 0.0), (350, 100, 350.0), (1, 3, 33.3333), (7, None, 0.0),
])
def test_rate(spark, total, shown, rate):
    df = spark.createDataFrame([(total, shown)], "t bigint, i bigint")
    assert df.select(C.engagement_rate_pct("t", "i").alias("y")).first()["y"] == rate


def test_safe_divide(spark):
    df = spark.createDataFrame([(6.0, 4), (6.0, 0), (6.0, None)], "n double, d int")
    assert [r[0] for r in df.select(C.safe_divide("n", "d")).collect()] == [1.5, 0.0, 0.0]


def test_date_key(spark):
    assert one(spark, C.date_key("x"), date(2024, 1, 15), "date") == 20240115
    assert one(spark, C.month_key("x"), date(2024, 1, 15), "date") == 202401


def test_weekend_and_day_of_week(spark):
    days = {date(2024, 1, 13): (6, True), date(2024, 1, 14): (0, True),
            **{date(2024, 1, d): (d - 7, False) for d in range(8, 13)}}
    for day, (number, weekend) in days.items():
        assert one(spark, C.day_of_week("x"), day, "date") == number
        assert one(spark, C.is_weekend("x"), day, "date") is weekend
    assert one(spark, C.is_weekend("x"), None, "date") is False


def test_surrogate_key_marks_nulls(spark):
    df = spark.createDataFrame([("a", None), ("a", "")], "x string, y string")
    keys = [r[0] for r in df.select(C.surrogate_key(["x", "y"])).collect()]
    assert len(set(keys)) == 2 and all(len(k) == 32 for k in keys)


@pytest.mark.parametrize("text, at", [
    ("2024-01-15T14:30:00+00:00", datetime(2024, 1, 15, 14, 30)),
    ("2024-01-15T14:30:00+02:00", datetime(2024, 1, 15, 12, 30)),
    ("2024-01-15T14:30:00", datetime(2024, 1, 15, 14, 30)),
    ("1705329000", datetime(2024, 1, 15, 14, 30)),
    ("yesterday", None), ("", None), (None, None),
])
def test_utc_timestamp(spark, text, at):
    shown = one(spark, F.date_format(C.utc_timestamp("x"), "yyyy-MM-dd HH:mm:ss"), text, "string")
    assert shown == (at and str(at))


def test_array_len_of_missing_and_empty(spark):
    df = spark.createDataFrame([(None,), ([],), (["a", "b"],)], "x array<string>")
    assert [r[0] for r in df.select(C.array_len("x")).collect()] == [0, 0, 2]
