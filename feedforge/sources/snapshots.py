"""Tables that change in one step.

A table is a folder with one data folder per load and a folder of commits. A
commit is one small file, written after all data of its load, that lists which
load folders hold which partition; the newest commit is the table. So a run that
is lost before its commit changes nothing, readers never see half a table, and a
partition that a rerun leaves without rows goes in the same step as the new ones
come. A reader takes the folders of the partitions it needs from the commit, so
one day is listed, however many days and loads the table has.

The list has an entry per partition, not per file or row. Committing puts a file
under a name that must not exist yet, which decides between writers; a loser
builds its list anew from the winner's.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .markers import names, put_once, read_text, remove

COMMITS = "_commits"
LOAD = "load"
ATTEMPTS = 10
CODEC = "zstd"  # texts take about half the room of the session's default
# Fixed value: how Spark names the folder of a null.
NULL_PART = "__HIVE_DEFAULT_PARTITION__"

#: Decides from a partition's values, given as text, null as None.
Wanted = Callable[[dict[str, str | None]], bool]


class CommitConflict(RuntimeError):
    """Other writers kept committing first."""


@dataclass(frozen=True)
class Snapshot:
    """One version of a table: its schema, and the loads that hold each partition."""

    version: int
    schema: T.StructType
    by: tuple[str, ...]
    parts: dict[str, tuple[str, ...]]
    notes: dict[str, int]

    def folders(self, where: Wanted | None = None) -> list[str]:
        return [f"{LOAD}={load}/{part}".rstrip("/") for part, loads in self.parts.items()
                if where is None or where(values_of(part)) for load in loads]


def values_of(part: str) -> dict[str, str | None]:
    """Values of a partition path such as ``year=2024/month=1``."""
    pairs = (step.split("=", 1) for step in part.split("/") if step)
    return {k: None if v == NULL_PART else v for k, v in pairs}


def in_days(first: date, last: date) -> Wanted:
    """Partitions by year, month and day that lie in ``first..last``."""

    def wanted(values: dict[str, str | None]) -> bool:
        found = [values.get(k) for k in ("year", "month", "day")]
        return None not in found and first <= date(*map(int, found)) <= last

    return wanted


def versions(spark: SparkSession, root: str) -> list[int]:
    """The committed versions, oldest first."""
    found = (n.removesuffix(".json") for n in names(spark, f"{root}/{COMMITS}") if n.endswith(".json"))
    return sorted(int(n) for n in found if n.isdigit())


def snapshot(spark: SparkSession, root: str, version: int | None = None) -> Snapshot | None:
    """The newest version, or a given one; None if nothing was ever committed."""
    if version is None:
        known = versions(spark, root)
        if not known:
            return None
        version = known[-1]
    body = json.loads(read_text(spark, f"{root}/{COMMITS}/{version:010d}.json"))
    return Snapshot(version, T.StructType.fromJson(body["schema"]), tuple(body["by"]),
                    {part: tuple(loads) for part, loads in body["parts"].items()}, body["notes"])


def _partitions_of(spark: SparkSession, load: str, depth: int) -> list[str]:
    """Partition paths below a load's folder."""
    found = [""]
    for _ in range(depth):
        found = [f"{part}/{name}".lstrip("/") for part in found
                 for name in names(spark, f"{load}/{part}".rstrip("/")) if "=" in name]
    return found


def publish(df: DataFrame, root: str, by: Sequence[str] = (), covers: Wanted | None = None,
            append: bool = False, rebalance: bool = False, after: int | None = None,
            notes: dict[str, int] | None = None) -> int:
    """Write rows and commit them as the next version; returns the rows written.

    The new version has the written partitions and, of the version before, those
    that ``covers`` does not choose; without ``covers`` the whole table is
    replaced. Covered partitions without a new row are gone. ``append`` keeps
    everything and adds to it. Rows that were made of a version must come ``after``
    just that one (-1 for none), or there is a conflict. ``notes`` are numbers kept
    with the table, changed in the same step.
    """
    spark = df.sparkSession
    load = uuid.uuid4().hex
    laid_out = df.hint("rebalance", *[F.col(c) for c in by]) if rebalance and by else df
    seen = Observation()
    (laid_out.observe(seen, F.count(F.lit(1)).alias("rows"))
     .write.partitionBy(*by).option("compression", CODEC).parquet(f"{root}/{LOAD}={load}"))
    written = _partitions_of(spark, f"{root}/{LOAD}={load}", len(by))
    for _ in range(ATTEMPTS):
        before = snapshot(spark, root)
        if after is not None and after != (before.version if before else -1):
            raise CommitConflict(f"{root}: no longer at version {after}")
        parts: dict[str, tuple[str, ...]] = {}
        if before and (append or covers):
            parts = {p: loads for p, loads in before.parts.items() if append or not covers(values_of(p))}
        for part in written:
            parts[part] = (*parts.get(part, ()), load) if append else (load,)
        body = {"schema": df.schema.jsonValue(), "by": list(by), "parts": parts,
                "notes": {**(before.notes if before else {}), **(notes or {})}}
        version = before.version + 1 if before else 0
        if put_once(spark, f"{root}/{COMMITS}", f"{version:010d}.json", json.dumps(body)):
            return seen.get["rows"]
    raise CommitConflict(f"{root}: other writers committed {ATTEMPTS} times")


def read_snapshot(spark: SparkSession, root: str, *columns: str, where: Wanted | None = None,
                  version: int | None = None) -> DataFrame:
    """The newest version, or a given one; only the folders that ``where`` chooses are listed."""
    found = snapshot(spark, root, version)
    if found is None:
        raise FileNotFoundError(f"nothing was committed to {root}")
    folders = found.folders(where)
    if folders:
        df = (spark.read.schema(T.StructType([*found.schema, T.StructField(LOAD, T.StringType())]))
              .option("basePath", root).parquet(*[f"{root}/{f}" for f in folders]))
    else:
        df = spark.createDataFrame([], found.schema)
    return df.select(*(columns or found.schema.fieldNames()))


def is_snapshot_table(spark: SparkSession, root: str) -> bool:
    return bool(versions(spark, root))


def expire(spark: SparkSession, root: str, keep: int = 10) -> int:
    """Give up all but the newest ``keep`` versions and the loads only they name; returns the loads removed.

    Run it while no load is being written: a load without a commit yet is taken
    for one that was lost.
    """
    known = versions(spark, root)
    live = {load for v in known[-keep:] for loads in snapshot(spark, root, v).parts.values() for load in loads}
    old = [n for n in names(spark, root) if n.startswith(f"{LOAD}=") and n.split("=", 1)[1] not in live]
    for v in known[:-keep]:
        remove(spark, f"{root}/{COMMITS}/{v:010d}.json")
    for name in old:
        remove(spark, f"{root}/{name}")
    return len(old)
