"""Exact top-k inner-product search by a three-phase uniform threshold.

After Cao and Wang, "Efficient Top-K Query Calculation in Distributed Networks"
(2004). The components of the vectors are cut into SEGMENTS lists, and a score is
the sum of one partial score per list.

1. Every block of vectors gathers the k best entries of each local list and their
   sums; the k-th best sum over all blocks is a safe cutoff of a query.
2. A vector that reaches the cutoff has a partial score of at least cutoff /
   SEGMENTS in some list. The cutoffs go out with the query blocks, and every
   block collects all entries at or above that.
3. The remaining scores of the collected entries are resolved exactly, and the k
   best remain.

Queries and vectors meet as blocks, packed by the hash of the id: an equality
join on block numbers gives every pair of blocks once, and a task holds one pair
and a slice of its scores. Blocks are shuffled, never broadcast: nothing passes the
driver but the number of rows and, if Spark finds them small, the cutoffs.

Defined results: components are floor(256 x). Vectors that are null or hold null
or non-finite components take no part; nor do null ids. Rows that share an id are
vectors of their own: each is a candidate, and each asks if the id is asked for
(their answers share the query_id); a query leaves out only its own row. Vectors
of different lengths have no score; an empty vector scores 0 with other empty
ones. Ties go to the smaller id.
Sums are exact; where they could leave 53 bits, whole numbers of any size are
used, and a score beyond 64 bits is cut to the ends of that range.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import ship, stored

SEGMENTS = 4
BLOCK_ROWS = 8192
QUERY_ROWS = 1024
EXACT = 2.0 ** 53


def quantised(vectors: DataFrame) -> DataFrame:
    """(vec_id, q): floor(256 x) as doubles, valid vectors only."""
    x = F.col("embedding")
    bad = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
    valid = vectors.where(F.col("vec_id").isNotNull() & x.isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"), x.cast("array<double>").alias("embedding"))
    valid = valid.where(~F.exists("embedding", bad))
    whole = F.transform("embedding", lambda v: _floor(v * 256))
    return valid.select("vec_id", whole.alias("q"))


def _floor(v: Column) -> Column:
    """floor() as a double of any size (floor of a double is a long in SQL)."""
    return F.when(F.abs(v) >= EXACT, v).otherwise(F.floor(v).cast("double"))


def _blocks(rows: DataFrame, count: int, name: str) -> DataFrame:
    """Pack (row, vec_id, q) into ``count`` blocks: (name, rows, ids, data)."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            for b, *own in zip(*(batch.column(i).to_pylist() for i in range(4))):
                held.setdefault(b, []).append(own)
        for b, own in held.items():
            numbers, ids, data = zip(*own)
            yield pa.RecordBatch.from_arrays(
                [pa.array([b], pa.int32()), pa.array([numbers], pa.list_(pa.int64())), pa.array([ids], pa.list_(pa.int64())),
                 pa.array([data], pa.list_(pa.list_(pa.float64())))], [name, "rows", "ids", "data"])

    numbered = rows.select(F.pmod(F.xxhash64("row"), F.lit(count)).cast("int").alias(name), "row", "vec_id", "q")
    return numbered.repartition(count, name).mapInArrow(
        pack, f"{name} int, rows array<long>, ids array<long>, data array<array<double>>")


def _product(a: list, b: list) -> np.ndarray:
    """Exact partial scores per segment and their sum: (SEGMENTS + 1, rows a, rows b)."""
    left, right = np.array(a, dtype=float), np.array(b, dtype=float)
    width = left.shape[1]
    bound = np.abs(left).max(initial=0) * np.abs(right).max(initial=0) * max(width, 1)
    if bound >= EXACT:
        left = np.array([[int(v) for v in r] for r in a], dtype=object).reshape(len(a), width)
        right = np.array([[int(v) for v in r] for r in b], dtype=object).reshape(len(b), width)
    cuts = np.linspace(0, width, SEGMENTS + 1).astype(int)
    parts = [left[:, s:e] @ right[:, s:e].T for s, e in zip(cuts, cuts[1:])]
    return np.stack([*parts, sum(parts)])


def _scores(query: dict, block: dict) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(query positions, vector positions, scores) of a pair of blocks, in slices."""
    by_width: dict[int, list[int]] = {}
    for at, v in enumerate(block["data"]):
        by_width.setdefault(len(v), []).append(at)
    lengths = np.array([len(v) for v in query["data"]])
    for width, vectors in by_width.items():
        own = np.flatnonzero(lengths == width)
        step = max(1, 2_000_000 // len(vectors))
        for at in range(0, len(own), step):
            some = own[at:at + step]
            yield some, np.array(vectors), _product([query["data"][i] for i in some], [block["data"][i] for i in vectors])


def _best(values: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k largest values, ties to smaller ids."""
    return np.lexsort((ids, -values))[:k]


def _gather(query: dict, block: dict, k: int) -> Iterator[tuple[int, int, object]]:
    """Phase 1: (query position, id, sum) of the k best entries of every local list."""
    ids, numbers = np.array(block["ids"]), np.array(block["rows"])
    for rows, vectors, scores in _scores(query, block):
        names, others = ids[vectors], numbers[vectors]
        for r, q in enumerate(rows):
            own = others != query["rows"][q]
            take = np.zeros(len(names), dtype=bool)
            for part in scores[:-1, r]:
                at = np.flatnonzero(own)
                if len(at) > k:
                    at = at[np.argpartition(-part[at], k - 1)[:k]]
                take[at] = True
            at = np.flatnonzero(take)
            total = scores[-1, r][at]
            for i in _best(total, names[at], k):
                yield q, int(names[at[i]]), total[i]


def _collect(query: dict, block: dict, k: int) -> Iterator[tuple[int, int, object]]:
    """Phases 2 and 3: (query position, id, sum) of entries at or above the cutoff."""
    ids, numbers = np.array(block["ids"]), np.array(block["rows"])
    for rows, vectors, scores in _scores(query, block):
        names, others = ids[vectors], numbers[vectors]
        for r, q in enumerate(rows):
            cutoff = query["cutoff"][q]
            take = others != query["rows"][q]
            if cutoff is not None:
                take &= (scores[:-1, r] * SEGMENTS >= cutoff).any(axis=0)
            at = np.flatnonzero(take)
            total = scores[-1, r][at]
            if cutoff is not None:
                at, total = at[total >= cutoff], total[total >= cutoff]
            for i in _best(total, names[at], k):
                yield q, int(names[at[i]]), total[i]


def _compare(pairs: DataFrame, work, k: int) -> DataFrame:
    """Run a phase on every pair of blocks: (query_row, query_id, vec_id, score)."""
    low, high = -2 ** 63, 2 ** 63 - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                query = {"rows": row["query_rows"], "data": row["query_data"], "cutoff": row["cutoff"]}
                found = list(work(query, {"rows": row["rows"], "ids": row["ids"], "data": row["data"]}, k))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["query_rows"][f[0]] for f in found], pa.int64()),
                     pa.array([row["query_ids"][f[0]] for f in found], pa.int64()),
                     pa.array([f[1] for f in found], pa.int64()),
                     pa.array([min(high, max(low, int(f[2]))) for f in found], pa.int64())],
                    ["query_row", "query_id", "vec_id", "score"])

    return pairs.mapInArrow(run, "query_row long, query_id long, vec_id long, score long")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, k: int = 5, every: int = 50) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows whose id ``every`` divides."""
    ship(vectors.sparkSession)
    rows = stored(quantised(vectors).withColumn("row", F.monotonically_increasing_id()), "quantised")
    asked = rows.where(F.col("vec_id") % every == 0)
    n_blocks = max(1, math.ceil(rows.count() / BLOCK_ROWS))
    n_query = max(1, math.ceil(asked.count() / QUERY_ROWS))
    blocks = stored(_blocks(rows, n_blocks, "block"), "vector-blocks")
    queries = stored(_blocks(asked, n_query, "query_block").select(
        "query_block", F.col("rows").alias("query_rows"), F.col("ids").alias("query_ids"),
        F.col("data").alias("query_data")), "query-blocks")

    def paired(query: DataFrame) -> DataFrame:
        """Every query block goes to every vector block.

        The planner sizes the exploded blocks as the file before the explode and would
        broadcast them: with the driver's memory growing with the square of the table.
        """
        spread = query.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
        return spread.hint("merge").join(blocks, "block").select(
            "query_rows", "query_ids", "query_data", "cutoff", "rows", "ids", "data")

    none = F.expr("transform(query_ids, i -> cast(null as long))")
    gathered = _compare(paired(queries.withColumn("cutoff", none)), _gather, k)
    cutoffs = _ranked(gathered, k).where(F.col("rank") == k).select("query_row", F.col("score").alias("cutoff"))
    listed = queries.select("query_block", F.posexplode("query_rows").alias("at", "query_row")).join(cutoffs, "query_row", "left")
    listed = listed.groupBy("query_block").agg(F.sort_array(F.collect_list(F.struct("at", "cutoff"))).alias("own"))
    informed = stored(queries.hint("merge").join(listed, "query_block").withColumn("cutoff", F.col("own.cutoff")).drop("own"), "cutoffs")
    return _ranked(_compare(paired(informed), _collect, k), k).select("query_id", "rank", "vec_id", "score")
