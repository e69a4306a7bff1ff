from __future__ import annotations

import random
from collections import defaultdict
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from checks.catalog import QUERIES
from feedforge.operators.calendar import date_spine, dim_date, relative_flags, with_holidays
from feedforge.operators.cleaning import (
    dead_letter, fill_nulls, normalize_ts, reject_split, tag_metadata, validate_required,
)
from feedforge.operators.dedup import dedup_latest
from feedforge.operators.history import as_of, scd2
from feedforge.operators.integrity import orphan_keys, rule_violations, series_violations
from feedforge.operators.ranking import rolling_days, top_per_group
from feedforge.operators.retention import file_manifest, retention_candidates
from feedforge.operators.runs import layer_counts
from feedforge.operators.threads import thread_depth

T0 = datetime(2024, 1, 15)


def test_dedup_keeps_latest_and_earliest(spark):
    rows = [("t1", T0 + timedelta(hours=10), "old"), ("t1", T0 + timedelta(hours=12), "new"),
            ("t1", T0 + timedelta(hours=8), "older")]
    df = spark.createDataFrame(rows, "id string, ingested_at timestamp, v string")
    assert [r["v"] for r in dedup_latest(df, ["id"]).collect()] == ["new"]
    assert [r["v"] for r in dedup_latest(df, ["id"], desc=False).collect()] == ["older"]
    once = dedup_latest(df, ["id"])
    assert dedup_latest(once, ["id"]).collect() == once.collect()
    assert dedup_latest(df.limit(0), ["id"]).count() == 0


def test_dedup_compound_key_and_null_time(spark):
    rows = [("p1", "twitter", T0), ("p1", "twitter", None), ("p1", "youtube", T0)]
    df = spark.createDataFrame(rows, "id string, platform string, ingested_at timestamp")
    kept = dedup_latest(df, ["id", "platform"]).collect()
    assert sorted((r["platform"], r["ingested_at"]) for r in kept) == [("twitter", T0), ("youtube", T0)]


def test_dedup_ties_do_not_depend_on_the_order_of_arrival(spark):
    rows = [("k", T0, f"v{i}") for i in range(50)]
    winners = set()
    for seed in range(4):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "id string, ingested_at timestamp, v string").repartition(5)
        winners.add(dedup_latest(df, ["id"]).first()["v"])
    assert len(winners) == 1


def test_dedup_is_cut_down_before_the_shuffle(spark, plan):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("ingested_at"))
    text = plan(dedup_latest(df, ["k"]))
    below = text[text.index("Exchange"):]
    assert "WindowGroupLimit" in below and "Partial" in below


def test_dedup_against_a_model(spark):
    rng = random.Random(7)
    rows = [(rng.randrange(20), rng.randrange(10), rng.randrange(10**6)) for _ in range(2000)]
    best: dict[int, tuple] = {}
    for k, at, v in rows:
        best[k] = max(best.get(k, (-1, -1)), (at, v))
    df = spark.createDataFrame(rows, "k int, ingested_at int, v int")
    got = {r["k"]: (r["ingested_at"], r["v"]) for r in dedup_latest(df, ["k"], tie_break=["v"]).collect()}
    assert got == best


def test_validation(spark):
    df = spark.createDataFrame(
        [("t1", "u1", "twitter", "2024-01-01"), ("t2", None, "twitter", "2024-01-01"), (None, None, "", "x")],
        "tweet_id string, user_id string, platform string, created_at string")
    errors = [r["errors"] for r in validate_required(df, "twitter.tweets").collect()]
    assert errors == [[], ["Required field missing or null: user_id"],
                      ["Required field missing or null: tweet_id", "Required field missing or null: user_id"]]
    absent = validate_required(df.drop("tweet_id"), "twitter.tweets").first()["errors"]
    assert absent == ["Required field missing or null: tweet_id"]
    for entity in ("no.such", None):
        assert validate_required(df, entity).filter(F.size("errors") > 0).count() == 0


def test_reject_split_and_fill(spark):
    df = spark.createDataFrame([(1, "a", None), (None, "b", 2), (3, None, 3)], "x int, y string, n int")
    valid, rejected = reject_split(df, ["x", "y"])
    assert valid.count() == 1 and rejected.count() == 2
    assert fill_nulls(valid, {"n": 0, "not_there": 1}).first()["n"] == 0


def test_tagging_keeps_a_given_time(spark):
    df = spark.createDataFrame([("2024-01-01T00:00:00Z",), (None,)], "ingested_at string")
    now = F.lit("2024-05-01").cast("timestamp")
    rows = tag_metadata(df, "run", "f.json", now).collect()
    assert [r["ingested_at"] for r in rows] == ["2024-01-01T00:00:00Z", "2024-05-01T00:00:00.000000Z"]
    assert {r["batch_id"] for r in rows} == {"run"} and {r["source_file"] for r in rows} == {"f.json"}


def test_normalize_ts_by_type(spark):
    df = spark.createDataFrame([("2024-01-15T00:00:00Z", 1705276800, T0)], "a string, b bigint, c timestamp_ntz")
    row = normalize_ts(df, ["a", "b", "c", "d"]).select(
        *[F.date_format(c, "yyyy-MM-dd HH").alias(c) for c in "abc"]).first()
    assert set(row) == {"2024-01-15 00"}


def test_dead_letter_keeps_the_message(spark):
    df = spark.createDataFrame([(1, "x")], "id int, why string")
    row = dead_letter(df, "topic", F.col("why")).first()
    assert row["original_topic"] == "topic" and '"id":1' in row["original_message"] and row["error"] == "x"


def test_calendar(spark):
    days = dim_date(spark)
    assert days.count() == 4017
    last = days.agg(F.max("full_date")).first()[0]
    assert last == date(2030, 12, 30)
    assert date_spine(spark, inclusive=True).count() == 4018
    row = days.filter("date_sk = 20240115").first()
    assert (row["quarter_name"], row["month_name"], row["month_name_short"], row["week_of_year"],
            row["day_of_week"], row["day_name"], row["day_name_short"], row["is_weekend"],
            row["year_month_key"]) == ("Q1", "January", "Jan", 3, 1, "Monday", "Mon", False, 202401)


def test_relative_flags(spark):
    flags = relative_flags(dim_date(spark), date(2024, 1, 17))
    row = flags.filter("date_sk = 20240115").first()
    assert (row["is_today"], row["is_current_week"], row["is_current_month"], row["is_current_year"],
            row["days_from_today"]) == (False, True, True, True, -2)
    assert flags.filter("is_today").count() == 1


def test_repeated_holidays_do_not_repeat_days(spark):
    holidays = spark.createDataFrame([(date(2024, 1, 1),)] * 3, "holiday_date date")
    marked = with_holidays(dim_date(spark), holidays)
    assert marked.count() == 4017 and marked.filter("is_holiday").count() == 1


def model_scd2(rows):
    """Reference history: last state per day, runs of equal states merged."""
    per_key = defaultdict(dict)
    for key, at, order, state in sorted(rows, key=lambda r: (r[1], r[2])):
        per_key[key][at.date()] = state
    out = []
    for key, days in per_key.items():
        kept = []
        for day in sorted(days):
            if not kept or kept[-1][1] != days[day]:
                kept.append((day, days[day]))
        for i, (day, state) in enumerate(kept):
            out.append((key, state, day, kept[i + 1][0] if i + 1 < len(kept) else None))
    return out


def history_rows(seed, n=400):
    rng = random.Random(seed)
    return [(f"u{rng.randrange(6)}", T0 + timedelta(minutes=rng.randrange(60 * 24 * 20)), i,
             rng.choice(["A", "B", None])) for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_scd2_against_a_model(spark, seed):
    rows = history_rows(seed)
    df = spark.createDataFrame(rows, "user_id string, at timestamp, n int, state string")
    got = scd2(df, "user_id", ["state"], "at", ["n"])
    shown = [(r["user_id"], r["state"], r["valid_from"], r["valid_to"]) for r in got.collect()]
    key = lambda r: (r[0], r[2])
    assert sorted(shown, key=key) == sorted(model_scd2(rows), key=key)
    assert got.filter("is_current").groupBy("user_id").count().filter("count > 1").count() == 0


@pytest.mark.parametrize("seed", [4, 5])
def test_as_of_against_a_model(spark, seed):
    rows = [r for r in history_rows(seed) if r[1].day > 18]
    intervals = model_scd2(rows)
    rng = random.Random(seed)
    facts = [(i, rng.choice(["u0", "u1", "u2", "nobody", None]),
              T0 + timedelta(minutes=rng.randrange(60 * 24 * 25))) for i in range(300)]
    history = scd2(spark.createDataFrame(rows, "user_id string, at timestamp, n int, state string"),
                   "user_id", ["state"], "at", ["n"])
    df = spark.createDataFrame(facts, "id int, user_id string, at timestamp")
    got = {r["id"]: (r["sk"] is not None, r["state"]) for r in as_of(df, history, "user_id", "at", ["sk", "state"]).collect()}
    assert len(got) == len(facts)
    for i, user, at in facts:
        match = [s for u, s, lo, hi in intervals if u == user and lo <= at.date() and (hi is None or at.date() < hi)]
        assert got[i] == ((True, match[0]) if match else (False, None))


def test_thread_depth(spark):
    rows = [("p", "a", None), ("p", "b", "a"), ("p", "c", "b"), ("p", "d", "c"), ("p", "e", "d"),
            ("p", "x", "gone"), ("p", "m", "n"), ("p", "n", "m"), ("q", "a", None), ("q", "b", "a")]
    df = spark.createDataFrame(rows, "post string, id string, up string")
    got = {(r["post"], r["id"]): r["recomputed_depth"] for r in thread_depth(df, ["post"], "id", "up").collect()}
    assert got == {("p", "a"): 0, ("p", "b"): 1, ("p", "c"): 2, ("p", "d"): 3, ("p", "e"): 4,
                   ("p", "x"): None, ("p", "m"): None, ("p", "n"): None, ("q", "a"): 0, ("q", "b"): 1}
    marks = {r["id"]: (r["recomputed_depth_missing"], r["recomputed_depth_cycle"])
             for r in thread_depth(df, ["post"], "id", "up").where("post = 'p'").collect()}
    assert marks["x"] == (True, False) and marks["m"] == marks["n"] == (False, True) and marks["e"] == (False, False)


def test_thread_depth_of_a_long_chain(spark):
    rows = [("p", i, i - 1 if i else None) for i in range(100)] + [("p", 200, 201), ("p", 200, 201), ("p", None, 3)]
    df = spark.createDataFrame(rows, "post string, id int, up int")
    got = [(r["id"], r["recomputed_depth"]) for r in thread_depth(df, ["post"], "id", "up").collect()]
    assert len(got) == len(rows)
    assert all(d == (i if i is not None and i < 100 else None) for i, d in got)


def test_orphans_and_rules(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    parent = spark.createDataFrame([(2,), (3,)], "id int")
    assert {(r["k"], r["orphan_rows"]) for r in orphan_keys(child, parent, {"k": "id"}).collect()} == \
        {(1, 2), (None, 1)}
    counts = rule_violations(child, {"small": F.col("k") < 2, "positive": F.col("k") > 0}).collect()
    assert {(r["rule"], r["n_rows"], r["n_violations"]) for r in counts} == {("small", 4, 1), ("positive", 4, 0)}


def test_series_violations(spark):
    rows = [("a", 1, 5), ("a", 2, 4), ("a", 3, 9), ("b", 1, 1), ("b", 1, 2)]
    df = spark.createDataFrame(rows, "k string, day int, total int")
    got = {r["k"]: (r["n_rows"], r["n_falls"], r["n_not_ascending"])
           for r in series_violations(df, "k", "day", "total").collect()}
    assert got["a"] == (3, 1, 0) and got["b"][2] == 1
    late = spark.createDataFrame([("a", 3, 1, 1), ("a", 1, 2, 2), ("a", 2, 3, 3)], "k string, day int, total int, n int")
    assert series_violations(late, "k", "day", "total", "n").first()["n_not_ascending"] == 1


def test_rolling_window_skips_gaps(spark):
    rows = [("t", date(2024, 1, d), v) for d, v in ((1, 1), (2, 2), (8, 4), (20, 8))]
    df = spark.createDataFrame(rows, "tag string, day date, v int")
    got = {r["day"].day: r["s"] for r in rolling_days(df, ["tag"], "day", "v", 7, "s").collect()}
    assert got == {1: 1, **{d: 3 for d in range(2, 8)}, 8: 6, **{d: 4 for d in range(9, 15)}, 20: 8}


def test_top_per_group_keeps_ties_and_limits_before_the_shuffle(spark, plan):
    df = spark.createDataFrame([("a", 3), ("a", 3), ("a", 2), ("a", 1), ("b", 1)], "g string, v int")
    top = top_per_group(df, ["g"], "v", 1)
    assert sorted((r["g"], r["v"]) for r in top.collect()) == [("a", 3), ("a", 3), ("b", 1)]
    text = plan(top_per_group(spark.range(100).selectExpr("id % 2 as g", "id as v"), ["g"], "v", 2))
    assert "WindowGroupLimit" in text[text.index("Exchange"):]


def test_layer_counts(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1), (None, 1), ("c", None)], "k string, v int")
    row = layer_counts(df, ["k", "v"], ["k"]).first()
    assert tuple(row) == (5, 2, 2, 1)


def test_retention(spark, tmp_path):
    for name in ("a.json", "b.json"):
        (tmp_path / name).write_text("[]")
    manifest = file_manifest(spark, str(tmp_path))
    done = manifest.filter(F.col("path").endswith("a.json")).select("path")
    today = date.today()
    assert retention_candidates(manifest, done, today).count() == 0
    old = retention_candidates(manifest, done, today + timedelta(days=9)).collect()
    assert [r["path"].rsplit("/", 1)[1] for r in old] == ["a.json"]


def test_retention_keeps_an_unprocessed_file_that_shares_its_path(spark):
    day = T0 - timedelta(days=30)
    files = spark.createDataFrame([(1, "a", 5, day), (2, "a", 6, day), (3, None, 7, day)],
                                  "page_id int, path string, length int, modificationTime timestamp")
    done = spark.createDataFrame([(1,), (3,)], "page_id int")
    old = retention_candidates(files, done, T0.date(), by=["page_id"])
    assert sorted(r["length"] for r in old.collect()) == [5, 7]


def test_retention_query_on_pages_that_share_a_url(spark, tmp_path):
    spark.createDataFrame([(1, "u", "xx"), (31, "u", "xxx"), (2, "v", "x")], "page_id bigint, url string, html string") \
        .write.parquet(f"{tmp_path}/pages.parquet")
    spark.createDataFrame([(1,), (2,)], "doc_id bigint").write.parquet(f"{tmp_path}/labels.parquet")
    found = QUERIES["retention_candidates"](spark, str(tmp_path)).collect()
    assert sorted((r["path"], r["length"]) for r in found) == [("u", 2), ("v", 1)]
