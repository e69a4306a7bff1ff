"""Tables kept up to date by batches equal one pass over everything."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from feedforge.operators.history import scd2, scd2_merge
from feedforge.plans import upkeep
from feedforge.sources import snapshots as S

T0 = datetime(2024, 1, 1)
USERS = "user_id string, account string, verified boolean, seen_at timestamp, n int"
EVENTS = "post string, at timestamp, v int"


def told(rng, n):
    return [(rng.choice(["a", "b", "c", None]), rng.choice(["X", "Y", None]), rng.random() < 0.5,
             T0 + timedelta(hours=rng.randrange(24 * 9)), i) for i in range(n)]


def as_set(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("seed", range(4))
def test_merged_history_equals_one_pass(spark, seed):
    rng = random.Random(seed)
    rows = told(rng, 60)
    rng.shuffle(rows)  # late, early, and several times a day
    args = ("user_id", ["account", "verified"], "seen_at", ("n",), "user_sk")
    history, at = None, 0
    while at < len(rows):
        size = rng.choice([5, 20, 30])
        batch = spark.createDataFrame(rows[at:at + size] + rows[max(0, at - 2):at], USERS)  # some come again
        merged = scd2_merge(history, batch, *args)
        history = spark.createDataFrame(merged.collect(), merged.schema)
        at += size
    assert as_set(history.drop("observed")) == as_set(scd2(spark.createDataFrame(rows, USERS), *args))


def test_late_snapshots_split_close_and_yield(spark):
    args = ("user_id", ["account", "verified"], "seen_at", ("n",), "user_sk")
    row = lambda d, account, h=12, n=0: ("a", account, True, datetime(2024, 1, d, h), n)
    spans = lambda df: sorted((r["valid_from"].day, r["valid_to"] and r["valid_to"].day, r["account"]) for r in df.collect())

    def merged(history, *rows):
        df = scd2_merge(history, spark.createDataFrame(list(rows), USERS), *args)
        return spark.createDataFrame(df.collect(), df.schema)

    h = merged(None, row(1, "X"), row(5, "X"), row(8, "X"))
    assert spans(h) == [(1, None, "X")]
    assert spans(merged(h, row(5, "Y", h=3))) == [(1, None, "X")]  # day 5 is known better
    split = merged(h, row(6, "Y"))
    assert spans(split) == [(1, 6, "X"), (6, 8, "Y"), (8, None, "X")]
    assert spans(merged(split, row(6, "X", h=20))) == [(1, None, "X")]  # later on that day, back again
    assert spans(merged(split, row(9, "Z"))) == [(1, 6, "X"), (6, 8, "Y"), (8, 9, "X"), (9, None, "Z")]


def test_only_touched_buckets_are_written(spark, tmp_path):
    root = str(tmp_path / "users")
    many = spark.createDataFrame([(f"u{i}", "X", True, T0, i) for i in range(200)], USERS)
    upkeep.update_dim_users(many, root, ["account", "verified"], buckets=16)
    before = S.snapshot(spark, root).parts
    one = spark.createDataFrame([("u7", "Y", True, T0 + timedelta(days=3), 0)], USERS)
    upkeep.update_dim_users(one, root, ["account", "verified"], buckets=16)
    after = S.snapshot(spark, root).parts
    assert len(before) == len(after) == 16 and sum(before[p] != after[p] for p in before) == 1
    assert upkeep.read_kept(spark, root).count() == 201
    assert upkeep.read_kept(spark, root).filter("user_id = 'u7'").filter("is_current and account = 'Y'").count() == 1


def sums():
    return {"n": F.count(F.lit(1)), "v": F.sum("v")}


def test_any_split_into_batches_gives_the_same_totals(spark, tmp_path):
    rng = random.Random(5)
    rows = [(rng.choice("pq"), None if i % 37 == 0 else T0 + timedelta(hours=rng.randrange(24 * 6)), i) for i in range(300)]
    whole = as_set(spark.createDataFrame(rows, EVENTS).groupBy("post", F.to_date("at").alias("metric_date")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("v").alias("v")))
    for name, cuts in (("one", [300]), ("three", [10, 200, 300]), ("shuffled", [100, 101, 300])):
        if name == "shuffled":
            rng.shuffle(rows)
        root, start = str(tmp_path / name), 0
        for n, end in enumerate(cuts):
            batch = spark.createDataFrame(rows[start:end], EVENTS)
            assert upkeep.update_totals(batch, root, ["post"], "at", sums(), "s", n)
            assert not upkeep.update_totals(batch, root, ["post"], "at", sums(), "s", n)  # repeated
            start = end
        assert as_set(S.read_snapshot(spark, root, "post", "metric_date", "n", "v")) == whole


def test_a_lost_batch_counts_once_and_streams_are_apart(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    batch = spark.createDataFrame([("p", T0, 1)], EVENTS)
    args = (batch, root, ["post"], "at", sums())

    def lost(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(S, "put_once", lost)
        with pytest.raises(RuntimeError, match="lost"):
            upkeep.update_totals(*args, "s", 0)
    assert upkeep.update_totals(*args, "s", 0) and not upkeep.update_totals(*args, "s", 0)
    assert upkeep.update_totals(*args, "other", 0)
    assert S.read_snapshot(spark, root).first()["n"] == 2


def test_a_writer_that_comes_second_merges_again(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    batch = spark.createDataFrame([("p", T0, 1)], EVENTS)
    upkeep.update_totals(batch, root, ["post"], "at", sums(), "a", 0)
    real, others = S.put_once, []

    def late(*args):
        if not others:
            others.append(1)
            upkeep.update_totals(batch, root, ["post"], "at", sums(), "b", 0)
        return real(*args)

    monkeypatch.setattr(S, "put_once", late)
    upkeep.update_totals(batch, root, ["post"], "at", sums(), "c", 0)
    assert S.read_snapshot(spark, root).first()["n"] == 3
    assert S.snapshot(spark, root).notes == {"a": 0, "b": 0, "c": 0}


def test_sketches_add_up(spark, tmp_path):
    root = str(tmp_path / "s")
    visits = spark.range(60_000).select(
        (F.col("id") % 20_000).alias("user"), F.timestamp_add("DAY", (F.col("id") % 10).cast("int"), F.lit(T0)).alias("at"))
    for part in (0, 1, 1):
        upkeep.update_user_sketches(visits.where(F.col("id") % 2 == part), root, "user", "at")
    kept = S.read_snapshot(spark, root)
    assert kept.count() == 10
    month = upkeep.distinct_users(kept, F.trunc("day", "month")).first()
    assert month["period_start"] == date(2024, 1, 1)
    assert abs(month["active_users"] - 20_000) <= 20_000 * 4 * upkeep.SKETCH_ERROR
