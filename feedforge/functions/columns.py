"""Column -> Column helpers. All of them are built-in expressions, so they stay
inside whole-stage code generation."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Results only agree with existing tables if these stay as they are.
ENGAGEMENT_WEIGHTS = {"LIKE": 1.0, "REPLY": 2.0, "RETWEET": 3.0, "QUOTE": 4.0, "VIEW": 0.1}
OTHER_WEIGHT = 1.0
ENGAGEMENT_TYPES = ("LIKE", "RETWEET", "REPLY", "QUOTE", "VIEW")
OTHER_TYPE = "UNKNOWN"
TIERS = {"viral": 10000, "high": 1000, "medium": 100}
LOWEST_TIER = "low"
PLATFORMS = ("twitter", "youtube", "reddit")
NULL_KEY_TOKEN = "_dbt_utils_surrogate_key_null_"
KEY_SEPARATOR = "-"
DATE_KEY_FORMAT = "yyyyMMdd"
MONTH_KEY_FORMAT = "yyyyMM"
PREVIEW_CHARS = 500


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def any_null(columns: Iterable[str]) -> Column:
    """True where at least one of the columns is null."""
    return reduce(lambda acc, c: acc | F.col(c).isNull(), columns, F.lit(False))


def tidy(c: Column | str, case: str | None = None) -> Column:
    """Strip spaces (SQL trim: spaces only) and optionally fold the case."""
    fold = {"lower": F.lower, "upper": F.upper, None: lambda x: x}[case]
    return fold(F.trim(_col(c)))


def floor_zero(c: Column | str) -> Column:
    return F.greatest(_col(c), F.lit(0))


def array_len(c: Column | str) -> Column:
    """Element count with a missing array counted as empty."""
    return F.coalesce(F.size(_col(c)), F.lit(0))


def engagement_type(c: Column | str) -> Column:
    folded = tidy(c, "upper")
    return F.when(folded.isin(*ENGAGEMENT_TYPES), folded).otherwise(OTHER_TYPE)


def engagement_weight(c: Column | str) -> Column:
    kind = _col(c)
    return reduce(
        lambda rest, item: F.when(kind == item[0], F.lit(item[1])).otherwise(rest),
        ENGAGEMENT_WEIGHTS.items(),
        F.lit(OTHER_WEIGHT),
    )


def engagement_tier(total: Column | str) -> Column:
    value = _col(total)
    by_floor = sorted(TIERS.items(), key=lambda kv: kv[1])
    return reduce(
        lambda rest, item: F.when(value >= item[1], F.lit(item[0])).otherwise(rest),
        by_floor,
        F.lit(LOWEST_TIER),
    )


def engagement_rate_pct(total: Column | str, impressions: Column | str) -> Column:
    """Percentage with 4 decimals; 0 without impressions. May exceed 100."""
    shown = _col(impressions)
    return F.when(shown > 0, F.round(_col(total).cast("double") / shown * 100, 4)).otherwise(0.0)


def safe_divide(numerator: Column | str, denominator: Column | str) -> Column:
    """0 where the denominator is 0 or null."""
    below = _col(denominator)
    return F.when(F.coalesce(below, F.lit(0)) == 0, F.lit(0.0)).otherwise(
        _col(numerator).cast("double") / below
    )


def date_key(c: Column | str) -> Column:
    return F.date_format(_col(c), DATE_KEY_FORMAT).cast("int")


def month_key(c: Column | str) -> Column:
    return F.date_format(_col(c), MONTH_KEY_FORMAT).cast("int")


def day_of_week(c: Column | str) -> Column:
    """0 = Sunday .. 6 = Saturday."""
    return F.dayofweek(_col(c)) - 1


def is_weekend(c: Column | str) -> Column:
    """False where the date is missing."""
    return F.coalesce(day_of_week(c).isin(0, 6), F.lit(False))


def surrogate_key(columns: Sequence[Column | str]) -> Column:
    """md5 over the text of the columns, nulls replaced by a token."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit(NULL_KEY_TOKEN)) for c in columns]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *parts))


def utc_timestamp(c: Column | str) -> Column:
    """ISO-8601 text (offset optional) or epoch seconds to a UTC instant.

    Text that is neither becomes null rather than failing the job.
    """
    text = _col(c)
    return F.coalesce(F.try_to_timestamp(text), F.timestamp_seconds(text.try_cast("bigint")))
