"""Merkle manifest of a data set, with proofs by nested intervals of leaf ranks.

Every document is a leaf; a source's leaves, in order, form a tree of fan 3, and
the roots of the sources form a tree in the same way. Each node is labelled with
the interval [low, high) of leaf ranks that it covers. An ancestor of a leaf is a
node whose interval contains the leaf's rank; the siblings of a node are what is
left of its parent's interval without the node's own.

Levels are handled in buckets of LEVELS. A bucket row holds the nodes of LEVELS
levels below one node (3 ** LEVELS units at most), so containment is decided
inside rows that are joined by equality: a unit's ancestors within its bucket
come from its own row, those above by joining the bucket to the node one bucket
of levels higher whose interval contains it. Going up and down takes
log(documents) / LEVELS rounds, every join has one row on both sides, and no
task holds a source, however large.

Defined results: ``-`` stands for a null value. Leaves with one doc_id, null
ones first, go by their hash; rows alike in all columns are leaves each. Further
columns of the input are ignored. An empty table has no leaf and no root.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship, stored
from .ranks import ranked

FAN = 3
LEVELS = 4
WIDTH = FAN ** LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def field(value: Column) -> Column:
    """A value with its length in front, or ``-``."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(**changed: Column) -> Column:
    """SHA-256 of a document's fields."""
    return F.sha2(F.concat(*[field(changed.get(c, F.col(c))) for c in FIELDS]).cast("binary"), 256)


def joined_hash(digests: Column) -> Column:
    return F.sha2(F.concat_ws("", digests).cast("binary"), 256)


def _raised(nodes: Column) -> Column:
    """The parents of neighbouring nodes (low, high, digest); runs of FAN become one."""
    runs = F.sequence(F.lit(0), F.ceil(F.size(nodes) / FAN).cast("int") - 1)

    def parent(i: Column) -> Column:
        run = F.slice(nodes, i * FAN + 1, F.lit(FAN))
        return F.struct(F.element_at(run, 1)["low"].alias("low"), F.element_at(run, -1)["high"].alias("high"),
                        joined_hash(F.transform(run, lambda x: x["digest"])).alias("digest"))

    return F.transform(runs, parent)


def _height(units: Column) -> Column:
    """Levels from some nodes to a single one."""
    levels = F.lit(0)
    for level in range(LEVELS):
        levels = F.when(F.size(units) > FAN ** level, level + 1).otherwise(levels)
    return levels


def alone() -> Column:
    """Whether a bucket row holds its whole tree. A full one may not, so it goes on."""
    return (F.col("bucket") == 0) & (F.size("level0") < WIDTH)


def _bucket_rows(units: DataFrame) -> DataFrame:
    """(tree, bucket, extras, levels, level0 .. level4) from (tree, index, low, high, digest, extra).

    An array of nodes for every level, the units first, each with the interval
    of its parent; ``extras`` is what the units carry along.
    """
    rows = (units.groupBy("tree", F.floor(F.col("index") / WIDTH).alias("bucket"))
            .agg(F.sort_array(F.collect_list(F.struct("low", "high", "digest", "extra"))).alias("units"))
            .select("tree", "bucket", F.col("units.extra").alias("extras"),
                    F.transform("units", lambda x: F.struct(x["low"].alias("low"), x["high"].alias("high"),
                                                            x["digest"].alias("digest"))).alias("level0"))
            .withColumn("levels", F.when(alone(), _height(F.col("level0"))).otherwise(LEVELS)))
    for level in range(LEVELS):
        here = F.col(f"level{level}")
        rows = rows.withColumn(f"level{level + 1}", F.when(F.col("levels") > level, _raised(here)).otherwise(here))
    for level in range(LEVELS):
        over = F.col(f"level{level + 1}")
        rows = rows.withColumn(f"level{level}", F.transform(f"level{level}", lambda x, i: F.struct(
            x["low"].alias("low"), x["high"].alias("high"), x["digest"].alias("digest"),
            F.get(over, F.floor(i / FAN).cast("int"))["low"].alias("over_low"),  # noqa: B023
            F.get(over, F.floor(i / FAN).cast("int"))["high"].alias("over_high"))))  # noqa: B023
    return rows


def climb(leaves: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """(bucket rows of every round, roots (tree, digest)) of the trees of ``leaves``.

    ``leaves`` are (tree, index, digest, extra), indexed from 0 within a tree.
    """
    units = leaves.withColumn("low", F.col("index")).withColumn("high", F.col("index") + 1)
    nothing = F.lit(None).cast(leaves.schema["extra"].dataType)
    rounds, roots = [], None
    top = F.col(f"level{LEVELS}")[0]
    while roots is None or not units.isEmpty():
        rows = stored(_bucket_rows(units), "merkle-levels")
        rounds.append(rows)
        done = rows.where(alone()).select("tree", top["digest"].alias("digest"))
        roots = done if roots is None else roots.union(done)
        units = rows.where(~alone()).select(
            "tree", F.col("bucket").alias("index"), top["low"].alias("low"), top["high"].alias("high"),
            top["digest"].alias("digest"), nothing.alias("extra"))
    return rounds, roots


def _steps() -> Column:
    """For every unit of a bucket row: (left, right) siblings per level, from the unit upwards.

    The run of a level is what its parent's interval covers. What is left of it
    without the node that contains the unit lies to the left or to the right.
    """

    def of(unit: Column) -> Column:
        out = []
        for level in range(LEVELS):
            inside = lambda x: (x["over_low"] <= unit["low"]) & (unit["low"] < x["over_high"])
            siblings = lambda side: F.concat_ws("", F.transform(
                F.filter(f"level{level}", lambda x: inside(x) & side(x)), lambda x: x["digest"]))  # noqa: B023
            pair = F.struct(siblings(lambda x: x["high"] <= unit["low"]).alias("left"),
                            siblings(lambda x: x["low"] > unit["low"]).alias("right"))
            out.append(F.when(F.col("levels") > level, pair))
        return F.filter(F.array(*out), lambda pair: pair.isNotNull())

    return F.transform("level0", of)


def descend(rounds: list[DataFrame], roots: DataFrame) -> DataFrame:
    """(tree, extra, steps, subroot) of every leaf.

    ``roots`` are (tree, steps, subroot): the steps that go on above a tree.
    """
    above = None
    for rows in reversed(rounds):
        ending = rows.where(alone()).select(F.col("tree").alias("_tree"))
        known = ending.join(roots, F.col("_tree").eqNullSafe(roots["tree"])).select(
            "_tree", F.lit(0).cast("long").alias("_index"), F.col("steps").alias("upper"), "subroot")
        if above is not None:
            known = known.union(above.select("tree", "index", "steps", "subroot"))
        # A bucket's top node is the unit with the bucket's number one round higher.
        joined = rows.join(known, F.col("tree").eqNullSafe(F.col("_tree")) & (F.col("bucket") == F.col("_index")))
        zipped = F.arrays_zip(F.col("extras").alias("extra"), _steps().alias("steps"))
        units = joined.select("tree", "upper", "subroot", "bucket", F.posexplode(zipped).alias("i", "unit"))
        above = units.select("tree", (F.col("bucket") * WIDTH + F.col("i")).alias("index"), F.col("unit.extra").alias("extra"),
                             F.concat("unit.steps", "upper").alias("steps"), "subroot")
    return above


def manifest(documents: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every document.

    ``folded_root`` is what the proof makes of the document as it is presented:
    without its line feeds where 2 divides the crc32 of its id.
    """
    spark = ship(documents.sparkSession)
    schema = ("doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
    text = F.col("text")
    changed = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0) & text.contains("\n")
    leaves = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "source", leaf_hash().alias("leaf"),
                              F.when(changed, leaf_hash(text=F.translate(text, "\n", ""))).alias("presented"))
    leaves = leaves.withColumn("presented", F.coalesce("presented", "leaf"))
    # Hashed once: dealing by ranges reads its rows twice.
    placed, _ = ranked(stored(leaves, "leaves"), "source", [F.asc_nulls_first("doc_id"), "leaf"])
    rounds, subroots = climb(placed.select(
        F.col("source").alias("tree"), F.col("rank").alias("index"), F.col("leaf").alias("digest"),
        F.struct("doc_id", "leaf", "presented").alias("extra")))
    sources, _ = ranked(subroots.withColumn("all", F.lit(0)), "all", [F.asc_nulls_first("tree")])
    top_rounds, top_roots = climb(sources.select(
        F.col("all").alias("tree"), F.col("rank").alias("index"), "digest", F.struct("tree", "digest").alias("extra")))
    root = top_roots.first()
    if root is None:
        return spark.createDataFrame([], schema)
    no_steps = F.array().cast("array<struct<left:string,right:string>>")
    top = descend(top_rounds, top_roots.select("tree", no_steps.alias("steps"), F.col("digest").alias("subroot")))
    bottom = descend(rounds, stored(top.select(
        F.col("extra.tree").alias("tree"), "steps", F.col("extra.digest").alias("subroot")), "source-steps"))
    siblings = F.concat_ws("", F.transform("steps", lambda s: F.concat(s["left"], s["right"])))
    folded = F.aggregate("steps", F.col("extra.presented"), lambda digest, s: F.sha2(
        F.concat(s["left"], digest, s["right"]).cast("binary"), 256))
    proven = bottom.select(
        F.col("extra.doc_id").alias("doc_id"), F.col("extra.leaf").alias("leaf"), "subroot", F.lit(root.digest).alias("root"),
        F.sha2(siblings.cast("binary"), 256).alias("proof_sha256"), folded.alias("folded_root"))
    return proven.withColumn("verified", F.col("folded_root") == F.col("root"))
