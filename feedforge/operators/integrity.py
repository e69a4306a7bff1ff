"""Referential and series checks."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def orphan_keys(child: DataFrame, parent: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Child keys without a parent and the rows that carry them.

    Children are counted per key before the join, so a key shared by very many
    rows reaches the join as one row.
    """
    counted = child.groupBy(*on).agg(F.count(F.lit(1)).alias("orphan_rows"))
    known = parent.select(*[F.col(p).alias(c) for c, p in on.items()])
    return counted.join(known, list(on), "left_anti")


def series_violations(daily: DataFrame, key: str, order: str, value: str,
                      sequence: str | Column | None = None) -> DataFrame:
    """Per key: steps where a running value falls or a date does not ascend.

    Steps follow ``sequence``, the order of delivery; without it they follow the
    date, and only equal dates can be found.
    """
    steps = Window.partitionBy(key).orderBy(order if sequence is None else sequence)
    compared = daily.withColumns({
        "_prev_value": F.lag(value).over(steps),
        "_prev_order": F.lag(order).over(steps),
    })
    return compared.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col(value) < F.col("_prev_value")).alias("n_falls"),
        F.count_if(F.col(order) <= F.col("_prev_order")).alias("n_not_ascending"),
    )


def rule_violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """(rule, n_rows, n_violations) of row rules, all in one aggregate.

    A rule that evaluates to null (an operand is missing) is not a violation.
    """
    counts = [F.count_if(~rule).alias(name) for name, rule in rules.items()]
    once = df.agg(F.count(F.lit(1)).alias("_n"), *counts)
    rows = F.array(*[F.struct(F.lit(n).alias("rule"), F.col("_n").alias("n_rows"),
                              F.col(n).alias("n_violations")) for n in rules])
    return once.select(F.inline(rows))
