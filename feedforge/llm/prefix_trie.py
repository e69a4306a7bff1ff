"""Conversation prefix trie, rolled up in bands of depths.

Conversations are rebuilt on a shared start (``rebuilt``), and every distinct
sequence of first turns is a node of a trie. A node is named by its smallest
member and its depth, so a conversation owns a run of nodes at the end of its
path, and the nodes above belong to smaller conversations.

1. Identity. The turns of a conversation are grouped by bands of BAND depths.
   The id of a prefix is a hash chain within its band that starts from the id of
   the whole bands before it; those are found in the same way with whole bands
   as turns, so very long conversations take log(depth) steps.
2. Nodes. Equal ids are one node: members and the smallest member by a grouped
   aggregate. An equality join gives every conversation the owners along its
   path, kept as one array per band.
3. Rollup. Every node explodes to its ancestors within its band only (at most
   BAND of them, summed within a conversation's band first). Totals of
   band-root nodes, the top nodes of a band, are then completed from the
   deepest band upwards over a tree of band roots alone, and handed once to the
   ancestors in the band above. So there are depth / BAND rounds over few rows,
   and no explosion beyond BAND.

No conversation, turn or node is held by one task as a whole. The one exception
is given by the digest of the ends: SHA-256 reads its input in order, so the ids
of the conversations that end in a node are hashed one after the other, in
packed pieces that are streamed, never held.

Defined results: rows without conv_id belong to no conversation. Turns with the
same number are ordered by SHA-256 of role and text, repeated rows are repeated
turns, null role or text is the empty string. A negative conv_id takes the
remainder's sign from Spark's ``%``. Without conversations there are no nodes,
not even the root. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship, stored
from .ranks import ranked

BAND = 32
#: Ids packed into one piece before the ends of a node are hashed.
PIECE = 500
GROUP, SHARED = 5, 9
SCHEMA = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
          "saved_tokens long, ends_sha256 string")


def short_hash(text: str | Column) -> Column:
    """128 bits of SHA-256."""
    return F.unhex(F.substring(F.sha2(text, 256), 1, 32))


def turn_rows(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, digest, n_bytes): a narrow row per turn."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    named = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        short_hash(named.cast("binary")).alias("digest"), F.octet_length(text).cast("long").alias("n_bytes"))


def shared_turns(conv_id: str | Column = "conv_id") -> Column:
    """How many turns a conversation takes from the first one of its group."""
    return (F.crc32(F.col(conv_id).cast("string").cast("binary")) % SHARED).cast("int")


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns (conv_id, pos, digest, n_bytes), conversations (conv_id, length)).

    ``pos`` counts from 1.
    """
    turns, spans = ranked(turn_rows(conversations), "conv_id", [F.asc_nulls_first("turn"), F.asc("digest")])
    known = spans.groupBy("conv_id").agg(F.sum("n").alias("n"))
    heads = (turns.where((F.col("rank") < SHARED - 1) & (F.col("conv_id") % GROUP == 0))
             .groupBy(F.col("conv_id").alias("base"))
             .agg(F.sort_array(F.collect_list(F.struct("rank", "digest", "n_bytes"))).alias("head")))
    convs = (known.withColumn("base", F.col("conv_id") - F.col("conv_id") % GROUP)
             .withColumn("h", shared_turns()).join(heads, "base", "left")
             .withColumn("head", F.slice(F.coalesce("head", F.array().cast("array<struct<rank:bigint,digest:binary,n_bytes:bigint>>")),
                                         F.lit(1), F.col("h"))))
    convs = stored(convs.select("conv_id", "n", "h", "head", F.size("head").alias("k"),
                                (F.size("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")),
                   "conversations")
    # A pair of conversation and partition holds a partition's rows at most, however long the conversation.
    parts = spans.select("conv_id", "part").join(convs.select("conv_id", "h", "k"), "conv_id")
    own = turns.join(parts, ["conv_id", "part"]).where("rank >= h").select(
        "conv_id", (F.col("rank") - F.col("h") + F.col("k") + 1).alias("pos"), "digest", "n_bytes")
    taken = convs.select("conv_id", F.inline("head")).select(
        "conv_id", (F.col("rank") + 1).alias("pos"), "digest", "n_bytes")
    return own.union(taken), convs.select("conv_id", "length")


def _band_groups(units: DataFrame) -> DataFrame:
    """(conv_id, band, items): the units (conv_id, pos from 1, digest, n_bytes) of a band in order."""
    item = F.struct("pos", "digest", "n_bytes")
    return units.groupBy("conv_id", F.floor((F.col("pos") - 1) / BAND).alias("band")).agg(
        F.sort_array(F.collect_list(item)).alias("items"))


def _starts(bands: DataFrame, longest: int) -> DataFrame:
    """(conv_id, band, start): the id of the whole bands before a band, for bands after the first."""
    whole = bands.where(F.size("items") == BAND)
    digest = short_hash(F.aggregate("items", F.lit(b""), lambda acc, x: F.concat(acc, x["digest"])))
    units = whole.select("conv_id", (F.col("band") + 1).alias("pos"), digest.alias("digest"), F.lit(0).alias("n_bytes"))
    return prefix_ids(units, longest // BAND).select("conv_id", F.col("pos").alias("band"), F.col("id").alias("start"))


def chained(start: Column, items: str) -> Column:
    """Ids of the prefixes that end at each item."""
    return F.slice(F.aggregate(
        items, F.array(start), lambda ids, x: F.concat(ids, F.array(short_hash(F.concat(F.element_at(ids, -1), x["digest"]))))),
        F.lit(2), F.size(items))


def banded(units: DataFrame, longest: int) -> DataFrame:
    """(conv_id, band, items, ids)."""
    bands = stored(_band_groups(units), "bands")
    first = bands.where("band = 0").withColumn("start", F.lit(b""))
    if longest > BAND:
        later = bands.where("band > 0").join(_starts(bands, longest), ["conv_id", "band"])
        first = first.unionByName(later)
    return first.select("conv_id", "band", "items", chained(F.col("start"), "items").alias("ids"))


def prefix_ids(units: DataFrame, longest: int) -> DataFrame:
    """(conv_id, pos, id, n_bytes) for every prefix; equal ids are equal prefixes."""
    zipped = F.inline(F.arrays_zip(F.col("items.pos").alias("pos"), F.col("ids").alias("id"),
                                   F.col("items.n_bytes").alias("n_bytes")))
    return banded(units, longest).select("conv_id", zipped)


def placed(members: DataFrame) -> DataFrame:
    """(conv_id, pos, owner, n_convs, n_bytes): every prefix with the node it is in."""
    nodes = stored(members.groupBy("id").agg(
        F.min("conv_id").alias("owner"), F.count("*").alias("n_convs")), "nodes")
    # Both sides are read from files, so that the join can split a very common node.
    return stored(members.join(nodes, "id").select("conv_id", "pos", "owner", "n_convs", "n_bytes"), "on-path")


def owned_paths(on_path: DataFrame, root: int) -> DataFrame:
    """(conv_id, band, owners, sizes, bytes): the path of a conversation through a band.

    Arrays have an entry for every depth of the band; ``owners`` has one more in
    front, the owner of the last node above. Only bands in which the conversation
    owns a node.
    """
    here = on_path.withColumn("band", F.floor((F.col("pos") - 1) / BAND))
    entry = on_path.where(F.col("pos") % BAND == 0).withColumn("band", F.floor(F.col("pos") / BAND))
    paths = here.union(entry).groupBy("conv_id", "band").agg(
        F.sort_array(F.collect_list(F.struct("pos", "owner", "n_convs", "n_bytes"))).alias("path"))
    inside = F.filter("path", lambda x: x["pos"] > F.col("band") * BAND)
    front = F.when(F.col("band") == 0, F.array(F.lit(root).cast("long"))).otherwise(F.slice("path.owner", 1, 1))
    paths = paths.select("conv_id", "band", front.alias("front"), inside.alias("inside"))
    return paths.where((F.size("inside") > 0) & (F.element_at("inside.owner", -1) == F.col("conv_id"))).select(
        "conv_id", "band", F.concat("front", "inside.owner").alias("owners"),
        F.col("inside.n_convs").alias("sizes"), F.col("inside.n_bytes").alias("bytes"))


def end_digests(ends: DataFrame) -> DataFrame:
    """(conv_id, depth, ends_sha256) from a row (conv_id, depth, member) per conversation."""
    keys = ["conv_id", "depth", "member"]
    dealt = ends.repartitionByRange(*keys).sortWithinPartitions(*keys)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, ids = None, []
        out: list[tuple] = []
        for batch in batches:
            for conv, depth, member in zip(*(c.to_pylist() for c in batch.columns)):
                if ids and (node != (conv, depth) or len(ids) == PIECE):
                    out.append((*node, ids[0], ",".join(map(str, ids))))
                    ids = []
                node = (conv, depth)
                ids.append(member)
            yield rows(out)
            out = []
        if ids:
            yield rows([(*node, ids[0], ",".join(map(str, ids)))])

    def rows(out: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*out)) or [()] * 4
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.string()))],
            ["conv_id", "depth", "first", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        out: list[tuple] = []
        for batch in batches:
            for conv, depth, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3))):
                if node != (conv, depth):
                    if node:
                        out.append((*node, state.hexdigest()))
                    node, state = (conv, depth), hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield done(out)
            out = []
        if node:
            yield done([(*node, state.hexdigest())])

    def done(out: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*out)) or [()] * 3
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string()))],
            ["conv_id", "depth", "ends_sha256"])

    packed = dealt.mapInArrow(pack, "conv_id long, depth long, first long, ids string")
    ordered = packed.repartition("conv_id", "depth").sortWithinPartitions("conv_id", "depth", "first")
    return ordered.mapInArrow(digest, "conv_id long, depth long, ends_sha256 string")


def depth_of(i: str | Column) -> Column:
    """Depth of the i-th entry of ``owners``."""
    return (F.col("band") * BAND + (F.col(i) if isinstance(i, str) else i)).cast("long")


def rolled_up(paths: DataFrame, leaves: DataFrame, deepest: int) -> DataFrame:
    """(conv_id, depth, n_leaves, saved_tokens), to be summed up per node.

    ``leaves`` are the (conv_id, depth) of the childless nodes.
    """
    flag = leaves.where("depth > 0").select(
        "conv_id", F.floor((F.col("depth") - 1) / BAND).alias("band"), F.lit(1).cast("long").alias("leaf"))
    saved = F.transform("sizes", lambda n, i: F.when(
        F.element_at("owners", i + 2) == F.col("conv_id"), (n - 1) * F.element_at("bytes", i + 1)).otherwise(F.lit(0).cast("long")))
    # A childless node ends its conversation, so it lies below all other nodes of the row.
    valued = stored(paths.join(flag, ["conv_id", "band"], "left").select(
        "conv_id", "band", "owners", F.coalesce("leaf", F.lit(0)).alias("leaf"), saved.alias("saved")), "valued")
    # From the band's last node upwards: a node and all below it on this path.
    below = F.aggregate(F.reverse("saved"), F.array(F.lit(0).cast("long")),
                        lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))
    sums = F.reverse(F.slice(below, F.lit(2), F.size("saved")))
    # In band 0 the front entry is the root; elsewhere it belongs to the band above.
    entries = F.arrays_zip(F.col("owners").alias("owner"), F.concat(
        F.array(F.element_at(sums, 1)), sums).alias("sum"))
    exploded = valued.select("band", "leaf", F.posexplode(entries).alias("i", "entry")).where("band = 0 or i > 0")
    partial = stored(
        exploded.groupBy(F.col("entry.owner").alias("conv_id"), depth_of("i").alias("depth"))
        .agg(F.sum("leaf").alias("n_leaves"), F.sum("entry.sum").alias("saved_tokens")), "partial")
    bands = -(-deepest // BAND)
    if bands < 2:
        return partial
    # The tree of band roots: a root's parent is the entry above it, in a band that is complete.
    tops = stored(
        valued.where((F.col("band") > 0) & (F.element_at("owners", 2) == F.col("conv_id")))
        .select("conv_id", "band", depth_of(F.lit(1)).alias("depth"), F.element_at("owners", 1).alias("parent"))
        .join(partial, ["conv_id", "depth"]), "band-roots", "band")
    lines = stored(
        valued.where(F.size("saved") == BAND)
        .select(F.col("conv_id").alias("parent"), (F.col("band") + 1).alias("band"), "owners"), "band-lines", "band")
    handed, carried = [], None
    for band in range(bands - 1, 0, -1):
        level = tops.where(F.col("band") == band)
        if carried is not None:
            level = level.unionByName(carried, allowMissingColumns=True).groupBy("conv_id").agg(
                F.max("parent").alias("parent"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
        joint = level.groupBy("parent").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
        joint = stored(joint.join(lines.where(F.col("band") == band), "parent"), "band-totals")
        handed.append(joint)
        carried = joint.groupBy(F.element_at("owners", 2).alias("conv_id")).agg(
            F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    for joint in handed:
        spread = joint.withColumn("band", F.col("band") - 1).select(
            "band", F.posexplode("owners").alias("i", "conv_id"), "n_leaves", "saved_tokens").where("band = 0 or i > 0")
        partial = partial.unionByName(spread.select("conv_id", depth_of("i").alias("depth"), "n_leaves", "saved_tokens"))
    return partial


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie of rebuilt conversations.

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256)
    """
    spark = ship(conversations.sparkSession)
    turns, convs = rebuilt(conversations)
    total = convs.agg(F.count("*").alias("n"), F.min("conv_id").alias("root"), F.max("length").alias("deepest")).first()
    if not total.n:
        return spark.createDataFrame([], SCHEMA)
    on_path = placed(stored(prefix_ids(turns, total.deepest), "members"))
    paths = stored(owned_paths(on_path, total.root), "paths")
    root = F.lit(total.root).cast("long")
    nothing = F.lit(None).cast("long")
    top = spark.range(1).select(root.alias("conv_id"), F.lit(0).cast("long").alias("depth"),
                                nothing.alias("parent_conv_id"), F.lit(total.n).cast("long").alias("n_convs"))
    below = paths.select("conv_id", "band", "owners", F.posexplode("sizes").alias("i", "n_convs")).where(
        F.element_at("owners", F.col("i") + 2) == F.col("conv_id"))
    nodes = top.union(below.select(
        "conv_id", depth_of(F.col("i") + 1), F.element_at("owners", F.col("i") + 1), "n_convs"))
    children = nodes.where("depth > 0").groupBy(
        F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("n_children"))
    nodes = stored(nodes.join(children, ["conv_id", "depth"], "left").fillna(0, ["n_children"]), "trie")
    sums = rolled_up(paths, nodes.where("n_children = 0").select("conv_id", "depth"), total.deepest)
    sums = sums.groupBy("conv_id", "depth").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    # A conversation ends in the node of its last prefix; without turns, in the root.
    last = on_path.groupBy("conv_id").agg(F.max(F.struct("pos", "owner")).alias("last"))
    ended = last.select(F.col("last.owner").alias("conv_id"), F.col("last.pos").alias("depth"), F.col("conv_id").alias("member"))
    turnless = convs.where("length = 0").select(root, F.lit(0).cast("long"), "conv_id")
    digests = end_digests(stored(ended.union(turnless), "ends"))
    empty = hashlib.sha256(b"").hexdigest()
    return (nodes.join(sums, ["conv_id", "depth"], "left").join(digests, ["conv_id", "depth"], "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
                    # Only a root without any turn below has no sums.
                    F.coalesce("n_leaves", F.lit(1)).cast("long").alias("n_leaves"),
                    F.coalesce("saved_tokens", F.lit(0)).cast("long").alias("saved_tokens"),
                    F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256")))
