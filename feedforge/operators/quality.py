"""Data-quality rules compiled to aggregates.

All suites of a table become at most three column-pruned passes over it: one
map-side aggregate for every rule that is a rate, one grouping for all columns
whose uniqueness is asked for, and one for samples of values outside a set. For
the grouping a row becomes one short entry per such column, (column, 128-bit hash
of the value), so there is one shuffle however many columns and suites, and wide
text is never shuffled. Keeping it apart from the rates matters: in a single
aggregate every distinct key would carry the buffers of all other rules.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SAMPLE_SIZE = 5  # fixed value: offending values shown per rule
RESULT_SCHEMA = ("rule_no int, rule string, kind string, success boolean, observed double, "
                 "expected string, details string")
HASH_SALT = 0x5bd1e995
KEYED = ("unique", "unique_strict", "unique_proportion")


@dataclass(frozen=True)
class Rule:
    """One expectation. ``mostly`` is the share of rows that has to pass."""

    kind: str
    column: str | None = None
    mostly: float = 1.0
    low: float | None = None
    high: float | None = None
    values: tuple = ()
    pattern: str | None = None

    @property
    def name(self) -> str:
        return f"{self.kind}({self.column or ''})"

    @property
    def expected(self) -> str:
        if self.kind == "exists":
            return "present"
        if self.kind in ("row_count", "unique_proportion"):
            return f"[{_bound(self.low)}, {_bound(self.high)}]"
        if self.kind == "between":
            return f">= {self.mostly} in [{_bound(self.low)}, {_bound(self.high)}]"
        return f">= {self.mostly}"


def _bound(x: float | None) -> str:
    return "*" if x is None else f"{x:.12g}"


@dataclass(frozen=True)
class Suite:
    """Rules of one table and what a failure means for the pipeline."""

    name: str
    layer: str
    blocking: bool
    rules: tuple[Rule, ...] = field(default_factory=tuple)

    @property
    def action(self) -> str:
        if self.blocking:
            return "block"
        return "warn" if self.layer == "bronze" else "alert"


class QualityGateError(RuntimeError):
    """A blocking suite failed."""


def row_count(low: int = 1, high: int | None = None) -> Rule:
    return Rule("row_count", low=low, high=high)


def exists(*columns: str) -> list[Rule]:
    return [Rule("exists", c) for c in columns]


def not_null(*columns: str, mostly: float = 1.0) -> list[Rule]:
    return [Rule("not_null", c, mostly) for c in columns]


def unique(*columns: str, mostly: float = 1.0) -> list[Rule]:
    return [Rule("unique", c, mostly) for c in columns]


def unique_strict(*columns: str, mostly: float = 1.0) -> list[Rule]:
    return [Rule("unique_strict", c, mostly) for c in columns]


def unique_proportion(column: str, low: float, high: float) -> Rule:
    return Rule("unique_proportion", column, low=low, high=high)


def in_set(column: str, values: Sequence, mostly: float = 1.0) -> Rule:
    return Rule("in_set", column, mostly, values=tuple(values))


def between(column: str, low: float | None = None, high: float | None = None,
            mostly: float = 1.0) -> Rule:
    return Rule("between", column, mostly, low, high)


def matches(column: str, pattern: str, mostly: float = 1.0) -> Rule:
    return Rule("regex", column, mostly, pattern=pattern)


def _in_range(c: Column, low: float | None, high: float | None) -> Column:
    inside = F.lit(True)
    if low is not None:
        inside = inside & (c >= low)
    if high is not None:
        inside = inside & (c <= high)
    return inside


def _passes(rule: Rule) -> Column:
    """Number of rows that satisfy a rate rule."""
    c = F.col(rule.column)
    if rule.kind == "not_null":
        return F.count(c)
    if rule.kind == "in_set":  # a null is not in the set
        return F.count_if(F.coalesce(c.isin(*rule.values), F.lit(False)))
    if rule.kind == "between":
        return F.count_if(_in_range(c, rule.low, rule.high))
    return F.count_if(c.rlike(rule.pattern))


def _share(part: Column, whole: Column) -> Column:
    """part / whole, and 1 for an empty table: nothing violates the rule."""
    return F.when(whole == 0, F.lit(1.0)).otherwise(part.cast("double") / whole)


def _result(no: int, rule: Rule, success: Column, observed: Column, details: Column) -> Column:
    return F.struct(
        F.lit(no).alias("rule_no"), F.lit(rule.name).alias("rule"), F.lit(rule.kind).alias("kind"),
        success.alias("success"), F.round(observed.cast("double"), 4).alias("observed"),
        F.lit(rule.expected).alias("expected"), details.alias("details"),
    )


def _absent(no: int, rule: Rule) -> Column:
    return _result(no, rule, F.lit(False), F.lit(0.0), F.lit("column is absent"))


def _rate_rules(df: DataFrame, rules: list[tuple[int, Rule]]) -> DataFrame:
    """Everything that needs no distinct keys: one aggregate, one row, then unpivoted."""
    measures = {"_n": F.count(F.lit(1))}
    present = set(df.columns)
    for no, rule in rules:
        if rule.column in present and rule.kind != "exists":
            measures[f"_pass_{no}"] = _passes(rule)
            if rule.kind in ("between", "regex"):  # nulls are left out of the share
                measures[f"_of_{no}"] = F.count(rule.column)
    totals = df.agg(*[m.alias(name) for name, m in measures.items()])
    rows = []
    for no, rule in rules:
        if rule.kind == "row_count":
            n = F.col("_n")
            rows.append(_result(no, rule, _in_range(n, rule.low, rule.high), n,
                                F.concat(n.cast("string"), F.lit(" rows"))))
        elif rule.column not in present:
            rows.append(_absent(no, rule))
        elif rule.kind == "exists":
            rows.append(_result(no, rule, F.lit(True), F.lit(1.0), F.lit("")))
        else:
            whole = F.col(f"_of_{no}") if f"_of_{no}" in measures else F.col("_n")
            share = _share(F.col(f"_pass_{no}"), whole)
            missed = (whole - F.col(f"_pass_{no}")).cast("string")
            rows.append(_result(no, rule, share >= rule.mostly, share,
                                F.concat(missed, F.lit(" of "), whole.cast("string"), F.lit(" rows fail"))))
    return totals.select(F.inline(F.array(*rows)))


def _value_hash(df: DataFrame, column: str) -> list[Column]:
    """128 bits of a value, as two XXH64 of different seeds; null for null."""
    c = F.col(column)
    if isinstance(df.schema[column].dataType, (T.StructType, T.ArrayType)):
        # A hash of nested values passes over their nulls; text of them does not.
        value = F.to_json(F.struct(c), {"ignoreNullFields": "false"})
    else:
        value = c
    return [F.when(c.isNotNull(), h) for h in (F.xxhash64(value), F.xxhash64(F.lit(HASH_SALT), value))]


def _keyed_rules(df: DataFrame, rules: list[tuple[int, Rule]]) -> DataFrame:
    """Uniqueness rules of all columns from value counts, with one shuffle."""
    columns = sorted({r.column for _, r in rules})
    entries = F.array(*[
        F.struct(F.lit(i).alias("column"), *[h.alias(n) for n, h in zip(("hash", "more"), _value_hash(df, c))])
        for i, c in enumerate(columns)])
    counts = (df.select(F.explode(entries).alias("e")).select("e.*").groupBy("column", "hash", "more")
              .agg(F.count(F.lit(1)).alias("_copies")))
    filled = F.when(F.col("hash").isNotNull(), F.col("_copies"))
    totals = counts.groupBy("column").agg(
        F.sum("_copies").alias("_n"),
        F.count(F.lit(1)).alias("_groups"),
        F.count("hash").alias("_distinct"),
        F.sum(filled).alias("_filled"),
        F.sum(F.when(filled > 1, filled)).alias("_shared"),
    )
    # An empty table has no counts, but its rules have results.
    every = df.sparkSession.range(len(columns)).select(F.col("id").cast("int").alias("column"))
    totals = every.join(totals, "column", "left").fillna(0)
    rows = []
    for no, rule in rules:
        if rule.kind == "unique":  # repeats after the first count, nulls are one value
            share = _share(F.col("_groups"), F.col("_n"))
            ok, bad = share >= rule.mostly, F.col("_n") - F.col("_groups")
        elif rule.kind == "unique_strict":  # every member of a repeated group counts
            share = _share(F.col("_filled") - F.col("_shared"), F.col("_filled"))
            ok, bad = share >= rule.mostly, F.col("_shared")
        else:
            share = _share(F.col("_distinct"), F.col("_filled"))
            ok, bad = _in_range(share, rule.low, rule.high), F.col("_filled") - F.col("_distinct")
        row = _result(no, rule, ok, share, F.concat(bad.cast("string"), F.lit(" duplicates")))
        rows.append(F.when(F.col("column") == columns.index(rule.column), row))
    return totals.select(F.inline(F.filter(F.array(*rows), lambda r: r.isNotNull())))


def offending_values(df: DataFrame, rules: list[tuple[int, Rule]], k: int = SAMPLE_SIZE) -> DataFrame:
    """The ``k`` smallest distinct values outside the set, per rule, as one text."""
    hits = F.array(*[
        F.when(~F.coalesce(F.col(r.column).isin(*r.values), F.lit(False)),
               F.struct(F.lit(no).alias("rule_no"),
                        F.coalesce(F.col(r.column).cast("string"), F.lit("null")).alias("value")))
        for no, r in rules
    ])
    distinct = (df.select(F.explode(F.filter(hits, lambda h: h.isNotNull())).alias("h"))
                .select("h.rule_no", "h.value").distinct())
    nth = F.row_number().over(Window.partitionBy("rule_no").orderBy("value"))
    return (distinct.withColumn("_nth", nth).filter(F.col("_nth") <= k)
            .groupBy("rule_no")
            .agg(F.array_join(F.array_sort(F.collect_list("value")), ", ").alias("samples")))


def run_suite(df: DataFrame, suite: Suite, samples: bool = True) -> DataFrame:
    """One row per rule: success, observed rate, expectation, details."""
    return run_suites(df, [suite], samples)


def run_suites(df: DataFrame, suites: Sequence[Suite], samples: bool = True) -> DataFrame:
    """The rows of several suites of one table, from the same passes over it."""
    present = set(df.columns)
    numbered = [(suite, no, rule) for suite in suites for no, rule in enumerate(suite.rules)]
    rules = [(at, rule) for at, (_, _, rule) in enumerate(numbered)]
    keyed = [(at, r) for at, r in rules if r.kind in KEYED and r.column in present]
    plain = [(at, r) for at, r in rules if (at, r) not in keyed]
    parts = [_rate_rules(df, plain)] if plain else []
    parts += [_keyed_rules(df, keyed)] if keyed else []
    results = reduce(DataFrame.unionByName, parts)
    sets = [(at, r) for at, r in plain if r.kind == "in_set" and r.column in present]
    if samples and sets:
        results = results.join(offending_values(df, sets), "rule_no", "left").withColumn(
            "details", F.when(F.col("samples").isNotNull(),
                              F.concat("details", F.lit("; e.g. "), "samples"))
            .otherwise(F.col("details"))).drop("samples")
    of = F.get(F.array(*[F.struct(F.lit(s.layer).alias("layer"), F.lit(s.name).alias("suite"), F.lit(no).alias("no"))
                         for s, no, _ in numbered]), F.col("rule_no"))
    return results.withColumn("_of", of).select(
        "_of.layer", "_of.suite", F.col("_of.no").alias("rule_no"), *[c for c in results.columns if c != "rule_no"])


def report(results: DataFrame) -> DataFrame:
    """Totals per suite."""
    passed, total = F.count_if("success"), F.count(F.lit(1))
    return results.groupBy("layer", "suite").agg(
        total.alias("total_checks"),
        passed.alias("passed"),
        (total - passed).alias("failed"),
        F.round(passed.cast("double") / total, 4).alias("success_rate"),
        (passed == total).alias("overall_pass"),
    )


def kpi(results: Sequence[DataFrame]) -> DataFrame:
    """Reports of several suites as one table."""
    return report(reduce(DataFrame.unionByName, results))


def gate(reports: DataFrame, suites: Sequence[Suite]) -> DataFrame:
    """What to do after a suite: go on, or the action of its layer."""
    action = F.coalesce(*[F.when(F.col("suite") == s.name, s.action) for s in suites])
    return reports.select(
        "layer", "suite", "overall_pass", "failed",
        F.when(F.col("overall_pass"), "pass").otherwise(action).alias("decision"),
    )


def enforce(df: DataFrame, suite: Suite) -> list:
    """Run a suite and raise if it is blocking and fails.

    Returns the result rows, of which there are as many as rules.
    """
    rows = run_suite(df, suite).orderBy("rule_no").collect()
    failed = [r["rule"] for r in rows if not r["success"]]
    if failed and suite.blocking:
        raise QualityGateError(f"{suite.name}: {', '.join(failed)}")
    return rows


def enforce_all(checks: Sequence[tuple[DataFrame, Suite]], folder: str | None = None,
                run_id: str | None = None) -> list:
    """Run the suites, keep their outcomes, then raise if a blocking one failed.

    With ``folder``, the rows of ``results`` (one per rule) and ``kpi`` (one per
    suite, with the decision of the gate) are appended there. What is collected
    has as many rows as there are rules.
    """
    if not checks:
        return []
    tables: dict[int, tuple[DataFrame, list[Suite]]] = {}
    for df, suite in checks:
        tables.setdefault(id(df), (df, []))[1].append(suite)
    results = reduce(DataFrame.unionByName, [run_suites(df, suites) for df, suites in tables.values()])
    rows = results.orderBy("suite", "rule_no").collect()
    if folder:
        kept = checks[0][0].sparkSession.createDataFrame(rows, results.schema)
        stamped = {"run_id": F.lit(run_id).cast("string"), "checked_at": F.current_timestamp()}
        kept.withColumns(stamped).coalesce(1).write.mode("append").parquet(f"{folder}/results")
        decided = gate(report(kept), [suite for _, suite in checks]).join(
            report(kept).drop("overall_pass", "failed"), ["layer", "suite"])
        decided.withColumns(stamped).coalesce(1).write.mode("append").parquet(f"{folder}/kpi")
    blocking = {suite.name for _, suite in checks if suite.blocking}
    failed = [f"{r['suite']} {r['rule']}" for r in rows if r["suite"] in blocking and not r["success"]]
    if failed:
        raise QualityGateError(", ".join(failed))
    return rows


def completeness(layers: DataFrame, minimum: float = 0.8) -> DataFrame:
    """Share of the lower layer's rows that reached the upper one.

    Input has one row per entity with ``lower_rows`` and ``upper_rows``.
    """
    share = _share(F.col("upper_rows"), F.col("lower_rows"))
    return layers.withColumns({"completeness": F.round(share, 4), "success": share >= minimum})


def enforce_completeness(ledger: DataFrame, minimum: float = 0.8) -> None:
    """Raise if too little of what an entity delivered was kept; repeated deliveries are no loss.

    The ledger has a row per entity of a run (``layer_ledger``).
    """
    layers = ledger.select("entity", (F.col("records_read") - F.col("duplicates_removed")).alias("lower_rows"),
                           F.col("records_kept").alias("upper_rows"))
    lacking = [f"{r['entity']} {r['completeness']}" for r in completeness(layers, minimum).collect() if r["success"] is False]
    if lacking:
        raise QualityGateError(f"less than {minimum} kept: {', '.join(lacking)}")
