"""Quality suites against their rules written out one by one in SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedforge.operators import quality as K
from feedforge.operators import suites as S
from feedforge.operators.integrity import rule_violations
from feedforge.operators.quality import Rule, Suite
from feedforge.operators.calendar import dim_date
from feedforge.plans import gold

from . import sqltext as Q
from .fixtures import raw, raw_sql, shaped, shaped_sql
from .gold import enriched, fact, post_metrics, staged
from .registry import Tables, query
from .silver import engagements, tweets


def _text(v) -> str:
    return f"'{v}'" if isinstance(v, str) else str(v)


def rule_sql(rule: Rule, table: str, columns: set[str] | None) -> str:
    """One rule as one SELECT: rule, success, observed."""
    c, head = rule.column, f"select '{rule.name}' as rule, "
    if rule.kind == "exists" or (columns is not None and c is not None and c not in columns):
        ok = "true" if columns is None or c in columns else "false"
        return f"{head}{ok} as success, {'1.0' if ok == 'true' else '0.0'}::double as observed"
    limits = " and ".join([f"{{0}} >= {rule.low}"] * (rule.low is not None)
                          + [f"{{0}} <= {rule.high}"] * (rule.high is not None)) or "true"
    if rule.kind == "row_count":
        return (f"{head}{limits.format('n')} as success, n::double as observed "
                f"from (select count(*) as n from {table}) x")
    share = {
        "not_null": f"avg(case when {c} is null then 0.0 else 1.0 end)",
        "in_set": f"avg(case when {c} in ({', '.join(map(_text, rule.values))}) then 1.0 else 0.0 end)",
        "between": f"avg(case when {c} is null then null when {limits.format(c)} then 1.0 else 0.0 end)",
        "regex": f"avg(case when {c} is null then null when regexp_matches({c}, '{rule.pattern}') then 1.0 else 0.0 end)",
        "unique": f"(select count(*) from (select distinct {c} from {table}))::double / nullif(count(*), 0)",
        "unique_strict": f"max((select sum(case when n = 1 then 1 else 0 end)::double / sum(n) from "
                         f"(select {c}, count(*) as n from {table} where {c} is not null group by 1)))",
        "unique_proportion": f"count(distinct {c})::double / nullif(count({c}), 0)",
    }[rule.kind]
    passed = limits.format("share") if rule.kind == "unique_proportion" else f"share >= {rule.mostly}"
    return (f"{head}{passed} as success, round(share, 4) as observed "
            f"from (select coalesce({share}, 1.0)::double as share from {table}) x")


def suite_sql(suite: Suite, table: str, columns: set[str] | None = None) -> str:
    return " union all ".join(
        f"select '{suite.name}' as suite, {no} as rule_no, * from ({rule_sql(r, table, columns)}) r{no}"
        for no, r in enumerate(suite.rules))


def shown(results: DataFrame) -> DataFrame:
    return results.select("suite", "rule_no", "rule", "success", "observed")


# table of each suite, as SQL and as DataFrame
TABLES_SQL = {
    "bronze_tweets": raw_sql("tweets"),
    "bronze_engagements": raw_sql("engagements"),
    "tweets": Q.CLEAN_TWEETS,
    "engagements": Q.CLEAN_ENGAGEMENTS,
    "posts": shaped_sql("posts"),
    "fact_engagements": Q.FACT_ENGAGEMENTS,
    "fact_post_metrics": Q.POST_METRICS,
    "dim_date": Q.DIM_DATE,
    "dim_posts": Q.DIM_POSTS,
}
def stored_staged(t: Tables) -> DataFrame:
    """Staged engagements, read by both facts."""
    return t.stored(staged(t), "staged-engagements")


TABLES_DF = {
    "bronze_tweets": lambda t: raw(t, "tweets"),
    "bronze_engagements": lambda t: raw(t, "engagements"),
    "tweets": tweets,
    "engagements": engagements,
    "posts": lambda t: shaped(t, "posts"),
    "fact_engagements": lambda t: fact(t, stored_staged),
    "fact_post_metrics": lambda t: post_metrics(t, stored_staged),
    "dim_date": lambda t: dim_date(t.spark),
    "dim_posts": lambda t: gold.dim_posts(enriched(t)),
}
PAIRS = {
    "bronze": (("bronze_tweets", S.BRONZE_TWEETS), ("bronze_engagements", S.BRONZE_ENGAGEMENTS),
               ("bronze_tweets", S.QUICK_BRONZE_TWEETS)),
    "silver": (("tweets", S.SILVER_TWEETS), ("engagements", S.SILVER_ENGAGEMENTS),
               ("posts", S.SILVER_POSTS), ("tweets", S.QUICK_SILVER_TWEETS)),
    "gold": (("fact_engagements", S.GOLD_FACT_ENGAGEMENTS),
             ("fact_post_metrics", S.GOLD_FACT_POST_METRICS),
             ("fact_engagements", S.QUICK_GOLD_ENGAGEMENTS)),
    "tests": tuple((name, suite) for name, suite in S.TABLE_TESTS.items()),
}


def results_of(t: Tables, layer: str) -> DataFrame:
    names = dict.fromkeys(n for n, _ in PAIRS[layer])
    used = {name: t.stored(TABLES_DF[name](t), name) for name in names}
    return reduce(DataFrame.unionByName, [
        K.run_suites(df, [s for n, s in PAIRS[layer] if n == name], samples=False) for name, df in used.items()])


def layer_sql(layer: str) -> str:
    """Every suite of a layer; the tables are named once and reused."""
    names = dict.fromkeys(n for n, _ in PAIRS[layer])
    tables = ", ".join(f"t_{n} as materialized (select * from {TABLES_SQL[n]} s)" for n in names)
    bodies = " union all ".join(suite_sql(s, f"t_{n}") for n, s in PAIRS[layer])
    return f"with {tables} {bodies}"


def _layer_query(layer: str):
    @query(f"dq_suite_{layer}", layer_sql(layer))
    def _(t):
        return shown(results_of(t, layer))


for _layer in PAIRS:
    _layer_query(_layer)


def _single(name: str, rules: list[Rule], table: str, columns: set[str] | None = None):
    suite = Suite(name, "silver", True, tuple(rules))

    @query(name, f"with x as (select * from {TABLES_SQL[table]} s) {suite_sql(suite, 'x', columns)}")
    def _(t):
        return shown(K.run_suite(TABLES_DF[table](t), suite, samples=False))


_single("dq_row_count", [K.row_count(1, 10_000_000), K.row_count(1, 5)], "bronze_tweets")
_single("dq_not_null", [*K.not_null("tweet_id", "platform"), *K.not_null("user_id", mostly=0.9)], "bronze_tweets")
_single("dq_unique", K.unique("tweet_id", "content", mostly=0.5), "bronze_tweets")
_single("dq_unique_strict", K.unique_strict("tweet_id", "content", mostly=0.5), "bronze_tweets")
_single("dq_unique_proportion", [K.unique_proportion("tweet_id", 0.999, 1.0)], "tweets")
_single("dq_between", [K.between("likes_count", 0), K.between("retweets_count", 0, 50, 0.5),
                       K.between("impressions_count", None, 1_000_000_000)], "bronze_tweets")
_single("dq_regex", [K.matches("tweet_id", S.UUID), K.matches("created_at", "^2024-", 0.5)], "bronze_tweets")


def _samples(table: str, column: str, values: tuple) -> str:
    listed = ", ".join(map(_text, values))
    return f"""(select string_agg(v, ', ' order by v) from (select distinct coalesce(cast({column} as varchar), 'null') as v
        from {table} x where not coalesce({column} in ({listed}), false) order by v limit 5) s)"""


_SET_RULES = [K.in_set("platform", ("twitter",), 0.5),
              K.in_set("user_account_type", ("USER", "BRAND", "INFLUENCER")),
              K.in_set("language", (" EN", " FR", " DE", " ES"))]


@query("dq_in_set", "with x as (select * from " + raw_sql("tweets") + " s) " + " union all ".join(
    f"select {no} as rule_no, rule, success, observed, {_samples('x', r.column, r.values)} as samples "
    f"from ({rule_sql(r, 'x', None)}) r{no}" for no, r in enumerate(_SET_RULES)))
def _(t):
    suite = Suite("dq_in_set", "bronze", False, tuple(_SET_RULES))
    results = K.run_suite(raw(t, "tweets"), suite)
    sample = F.nullif(F.regexp_extract("details", "e\\.g\\. (.*)$", 1), F.lit(""))
    return results.select("rule_no", "rule", "success", "observed", sample.alias("samples"))


_REPORT = """select {0}, suite, count(*) as total_checks, count(*) filter (where success) as passed,
    count(*) filter (where not success) as failed,
    round(count(*) filter (where success)::double / count(*), 4) as success_rate,
    bool_and(success) as overall_pass from ({1}) r group by all"""
_LAYER_OF = "case when suite like '%bronze%' then 'bronze' when suite like '%silver%' then 'silver' else 'gold' end as layer"


@query("dq_kpi", " union all ".join(
    f"select * from ({_REPORT.format(_LAYER_OF, layer_sql(layer))}) k" for layer in ("bronze", "silver", "gold")))
def _(t):
    return K.kpi([results_of(t, layer) for layer in ("bronze", "silver", "gold")])


@query("dq_gate", f"""
    select layer, suite, overall_pass, failed, case when overall_pass then 'pass'
      when layer = 'bronze' then 'warn' when layer = 'silver' then 'block' else 'alert' end as decision
    from (""" + " union all ".join(
        f"select * from ({_REPORT.format(_LAYER_OF, layer_sql(layer))}) k" for layer in ("bronze", "silver")) + ") g")
def _(t):
    reports = K.kpi([results_of(t, "bronze"), results_of(t, "silver")])
    return K.gate(reports, [s for layer in ("bronze", "silver") for _, s in PAIRS[layer]])


@query("dq_completeness", f"""
    select entity, lower_rows, upper_rows, round(upper_rows::double / lower_rows, 4) as completeness,
      upper_rows::double / lower_rows >= 0.8 as success
    from (select 'tweets' as entity, (select count(*) from {raw_sql('tweets')} a) as lower_rows,
            (select count(*) from {Q.CLEAN_TWEETS} b) as upper_rows
          union all
          select 'engagements', (select count(*) from {raw_sql('engagements')} c),
            (select count(*) from {Q.CLEAN_ENGAGEMENTS} d)) x""")
def _(t):
    def counted(df: DataFrame, entity: str, column: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(entity).alias("entity"), F.lit(column).alias("side"), "n")

    sides = [counted(raw(t, "tweets"), "tweets", "lower_rows"), counted(tweets(t), "tweets", "upper_rows"),
             counted(raw(t, "engagements"), "engagements", "lower_rows"),
             counted(engagements(t), "engagements", "upper_rows")]
    both = reduce(DataFrame.unionByName, sides).groupBy("entity") \
        .pivot("side", ["lower_rows", "upper_rows"]).agg(F.sum("n"))
    return K.completeness(both)


@query("dq_row_rules", f"""
    select 'likes_within_views' as rule, count(*) as n_rows,
      count(*) filter (where not like_count <= view_count) as n_violations from {raw_sql('videos')} v
    union all
    select 'ratio_in_unit_range', count(*), count(*) filter (where not l_discount between 0 and 1) from lineitem
    union all
    select 'depth_within_limit', count(*), count(*) filter (where not depth <= 3) from {shaped_sql('comments')} c
    union all
    select 'engaged_after_post', count(*),
      count(*) filter (where not cast(engagement_timestamp as date) >= post_date) from {Q.FACT_ENGAGEMENTS} f""")
def _(t):
    checks = (
        (raw(t, "videos"), {"likes_within_views": F.col("like_count") <= F.col("view_count")}),
        (t.lineitem, {"ratio_in_unit_range": F.col("l_discount").between(0, 1)}),
        (shaped(t, "comments"), {"depth_within_limit": F.col("depth") <= 3}),
        (fact(t), {"engaged_after_post": F.to_date("engagement_timestamp") >= F.col("post_date")}),
    )
    return reduce(DataFrame.unionByName, [rule_violations(df, rules) for df, rules in checks])
