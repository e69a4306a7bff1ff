from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from feedforge.operators import quality as K
from feedforge.operators import suites as S
from feedforge.operators.quality import Suite


def outcome(df, *rules, layer="silver", blocking=True):
    results = K.run_suite(df, Suite("s", layer, blocking, rules))
    return [(r["success"], r["observed"]) for r in results.orderBy("rule_no").collect()]


def ints(spark, values):
    return spark.createDataFrame([(v,) for v in values], "x int")


@pytest.mark.parametrize("nulls, mostly, success", [(10, 0.95, False), (1, 0.95, True), (0, 1.0, True)])
def test_not_null_mostly(spark, nulls, mostly, success):
    df = ints(spark, [None] * nulls + [1] * (100 - nulls))
    assert outcome(df, *K.not_null("x", mostly=mostly)) == [(success, round(1 - nulls / 100, 4))]


def test_unique_forms(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",)], "x string")
    assert outcome(df, *K.unique("x")) == [(False, 0.6667)]
    assert outcome(df, *K.unique("x", mostly=0.6)) == [(True, 0.6667)]
    assert outcome(df, *K.unique_strict("x")) == [(False, 0.3333)]
    assert outcome(df, K.unique_proportion("x", 0.999, 1.0)) == [(False, 0.6667)]
    with_nulls = spark.createDataFrame([("a",), (None,), (None,)], "x string")
    assert outcome(with_nulls, *K.unique("x")) == [(False, 0.6667)]
    assert outcome(with_nulls, *K.unique_strict("x")) == [(True, 1.0)]


def test_between_zero_is_a_bound_and_nulls_are_left_out(spark):
    assert outcome(ints(spark, [10, -5, 100, -1]), K.between("x", 0)) == [(False, 0.5)]
    assert outcome(ints(spark, [10, None, 50, None, 100]), K.between("x", 0)) == [(True, 1.0)]
    assert outcome(ints(spark, [None, None]), K.between("x", 0, 5)) == [(True, 1.0)]
    assert outcome(ints(spark, [1, 6]), K.between("x", None, 5, 0.5)) == [(True, 0.5)]


def test_in_set_counts_nulls_as_misses_and_shows_samples(spark):
    df = spark.createDataFrame([(v,) for v in ("a", "z", "y", "y", None, "w", "v", "u", "t")], "x string")
    results = K.run_suite(df, Suite("s", "bronze", False, (K.in_set("x", ("a",)),))).first()
    assert not results["success"] and results["observed"] == 0.1111
    assert results["details"].endswith("e.g. null, t, u, v, w")


def test_row_count_absent_column_and_empty_table(spark):
    df = ints(spark, [1, 2])
    assert outcome(df, K.row_count(1, 5)) == [(True, 2.0)]
    assert outcome(df, K.row_count(3)) == [(False, 2.0)]
    assert outcome(df, *K.exists("x", "y"), *K.not_null("y"), *K.unique("y")) == \
        [(True, 1.0), (False, 0.0), (False, 0.0), (False, 0.0)]
    assert outcome(df.limit(0), K.row_count(1), *K.not_null("x"), *K.unique("x"), K.in_set("x", (1,))) == \
        [(False, 0.0), (True, 1.0), (True, 1.0), (True, 1.0)]


def test_regex(spark):
    good = "0b1e7a52-8f0c-4d0e-9b1a-1234567890ab"
    df = spark.createDataFrame([(good,), ("nope",), (None,)], "x string")
    assert outcome(df, K.matches("x", S.UUID)) == [(False, 0.5)]


def test_suite_sizes():
    assert [len(s.rules) for s in S.SUITES.values()] == [15, 11, 25, 15, 12, 20, 14]
    assert sum(len(S.TABLE_TESTS[t].rules) for t in ("tweets", "engagements", "posts")) == 22
    assert sum(len(s.rules) for s in S.TABLE_TESTS.values()) == 62
    assert [s.blocking for s in S.SUITES.values()] == [False, False, True, True, True, False, False]


def test_gate_and_enforce(spark):
    df = ints(spark, [1, None])
    rules = tuple(K.not_null("x"))
    strict, loose, gold = Suite("a", "silver", True, rules), Suite("b", "bronze", False, rules), \
        Suite("c", "gold", False, rules)
    reports = K.kpi([K.run_suite(df, s) for s in (strict, loose, gold)])
    decisions = {r["suite"]: r["decision"] for r in K.gate(reports, [strict, loose, gold]).collect()}
    assert decisions == {"a": "block", "b": "warn", "c": "alert"}
    assert [r["success"] for r in K.enforce(df, loose)] == [False]
    with pytest.raises(K.QualityGateError, match="not_null"):
        K.enforce(df, strict)
    assert K.enforce(df.filter("x is not null"), strict)[0]["success"]


def test_report(spark):
    df = ints(spark, [1, 2])
    row = K.report(K.run_suite(df, Suite("s", "gold", False, (K.row_count(1), K.row_count(9))))).first()
    assert (row["total_checks"], row["passed"], row["failed"], row["success_rate"], row["overall_pass"]) == \
        (2, 1, 1, 0.5, False)


def test_completeness(spark):
    df = spark.createDataFrame([("a", 100, 80), ("b", 100, 79), ("c", 0, 0)], "entity string, lower_rows int, upper_rows int")
    got = {r["entity"]: r["success"] for r in K.completeness(df).collect()}
    assert got == {"a": True, "b": False, "c": True}


def test_distinct_keys_travel_without_the_other_measures(spark, plan):
    df = spark.range(100).select(F.col("id").alias("k"), *[F.lit(i).alias(f"m{i}") for i in range(5)])
    suite = Suite("s", "silver", True, (*K.unique("k"), *K.not_null("k", *[f"m{i}" for i in range(5)])))
    text = plan(K.run_suite(df, suite))
    assert "Expand" not in text


def test_suites_of_a_table_share_its_passes(spark, plan):
    rows = [("a" * 50, 1, None), ("a" * 50, 1, "x"), ("b", 2, None), (None, 2, "x"), (None, -1, "y")]
    df = spark.createDataFrame(rows, "text string, n int, s string").withColumn("pair", F.struct("n", "s"))
    first = Suite("one", "silver", True, (K.row_count(1, 4), *K.unique("text", "n"), *K.unique_strict("text"),
                                          K.in_set("s", ("x",))))
    second = Suite("two", "gold", False, (*K.unique("pair"), K.unique_proportion("s", 0.5, 0.9), K.between("n", 0), *K.exists("zz")))
    both = K.run_suites(df, [first, second])
    shown = lambda d: sorted(map(tuple, d.collect()))
    assert shown(both) == sorted(shown(K.run_suite(df, first)) + shown(K.run_suite(df, second)))
    text = plan(K.run_suites(df, [first, second]))
    keyed = [line for line in text.splitlines() if "Exchange hashpartitioning(" in line and "hash#" in line]
    assert len(keyed) == 1 and "text#" not in keyed[0]  # one shuffle of short entries for all columns
    empty = {(r["suite"], r["rule_no"]): r["success"] for r in K.run_suites(df.where("false"), [first, second]).collect()}
    assert len(empty) == 9 and empty["one", 1] and not empty["one", 0] and empty["two", 0]


def test_hashed_values_keep_apart_what_differs(spark):
    rows = [(None, 1, ["a", None]), (1, None, [None, "a"]), (1, 1, ["a"]), (1, 1, ["a", ""]), (None, None, None)]
    df = spark.createDataFrame(rows, "a int, b int, c array<string>").withColumn("pair", F.struct("a", "b"))
    suite = Suite("s", "silver", True, (*K.unique("pair"), *K.unique("c")))
    observed = [r["observed"] for r in K.run_suite(df, suite).orderBy("rule_no").collect()]
    assert observed == [0.8, 1.0]
