r"""Conversation prefix trie by block hashing.

Every distinct sequence of first turns of the conversations is a node; its
*members* are the conversations that start with it, the root has them all.

A turn's hash covers its place, role and text, so the XOR of a conversation's
first hashes names its prefix whatever the order in which rows are combined. Turns are cut
into blocks of ``block`` turns. A running XOR over a conversation's blocks gives
the prefix before each block, and conversations are grouped by (prefix, block)
first: equal blocks under one prefix become one row. Where all members of a
prefix go on with the same block, its turns are nodes as they are. Only where
sibling blocks differ, turn boundaries are refined: the blocks' own prefixes
are grouped turn by turn.

Sums over subtrees need no walk over levels. A node belongs to its smallest
member; a conversation then has the nodes from some depth to its end, a
*segment*. Within a segment a sum over the subtree is what is left of a running
sum, and a segment adds its total to the nodes above it on its conversation's
path, combined by block before turns are taken apart.

Hashes are 120 bits of SHA-256 with a salt drawn for the run.

Defined cases: a null role or text is empty; turns follow ``turn`` (null first),
equal turns by digest; rows with a null conv_id belong to no conversation;
repeated rows are turns of their own; no conversation gives no node; extra
columns are left alone. A conversation of any length is spread over partitions.
The digest of a node's end members is one SHA-256 stream, so its ids, packed
into strings elsewhere, pass one task in turn, never held together.
"""

from __future__ import annotations

import hashlib
import secrets
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, ship_package
from .common import partitions, range_sorted, running_sum, stored

BLOCK = 4
KEY = ["depth", "key0", "key1"]
NO_ENDS = hashlib.sha256(b"").hexdigest()


def positions(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 1, in order of ``turn``), digest (of role and text)
    and n_bytes (UTF-8 bytes of the text) of every turn."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.sha2(F.concat(F.octet_length(role), F.lit(":"), role, text), 256).alias("digest"),
        F.octet_length(text).cast("long").alias("n_bytes"))
    rows = stored(rows.withColumn("uid", F.monotonically_increasing_id()).withColumn("one", F.lit(1)), "trie-turns")
    ranked = running_sum(rows, ["conv_id"], ["turn", "digest", "uid"], "one", "pos", "trie-rank")
    return cut_lineage(ranked.select("conv_id", (F.col("pos") + 1).alias("pos"), "digest", "n_bytes"), "trie-positions")


def _xor(turns: Column, lane: str) -> Column:
    return F.aggregate(turns, F.lit(0).cast("long"), lambda a, t: a.bitwiseXOR(t[lane]))


def _blocks(turns: DataFrame, block: int) -> DataFrame:
    """conv_id, k (number of the block), p0, p1 (the prefix before it), x0, x1
    (its digest) and its turns (pos, lane0, lane1, n_bytes), at most ``block``."""
    salted = F.sha2(F.concat(F.lit(secrets.token_hex(16)), F.col("pos"), F.lit(":"), F.col("digest")), 256)
    lanes = [F.conv(F.substring("h", 1 + 15 * i, 15), 16, 10).cast("long").alias(f"lane{i}") for i in range(2)]
    rows = (turns.withColumn("h", salted).select("conv_id", "pos", "n_bytes", *lanes)
            .groupBy("conv_id", F.floor((F.col("pos") - 1) / block).alias("k"))
            .agg(F.sort_array(F.collect_list(F.struct("pos", "lane0", "lane1", "n_bytes"))).alias("turns"))
            .withColumn("x0", _xor(F.col("turns"), "lane0")).withColumn("x1", _xor(F.col("turns"), "lane1")))
    ranged = range_sorted(cut_lineage(rows, "trie-block-rows"), ["conv_id", "k"], "trie-block-order")
    before = Window.unboundedPreceding, -1
    within = Window.partitionBy("_pid", "conv_id").orderBy("k").rowsBetween(*before)
    across = Window.partitionBy("conv_id").orderBy("_pid").rowsBetween(*before)
    totals = ranged.groupBy("_pid", "conv_id").agg(F.bit_xor("x0").alias("x0"), F.bit_xor("x1").alias("x1"))
    none = F.lit(0).cast("long")
    bases = totals.select("_pid", "conv_id", *[F.coalesce(F.bit_xor(f"x{i}").over(across), none).alias(f"b{i}") for i in (0, 1)])
    inner = ranged.select("*", *[F.coalesce(F.bit_xor(f"x{i}").over(within), none).alias(f"w{i}") for i in (0, 1)])
    return cut_lineage(inner.join(bases, ["_pid", "conv_id"]).select(
        "conv_id", "k", F.col("w0").bitwiseXOR(F.col("b0")).alias("p0"), F.col("w1").bitwiseXOR(F.col("b1")).alias("p1"),
        "x0", "x1", "turns"), "trie-blocks")


def _turn_nodes() -> Column:
    """An array of the nodes in a block row: depth, key (the prefix up to the
    turn), up (the one before it), n_bytes."""
    def node(t, i):
        upto = F.slice("turns", F.lit(1), i + 1)
        keys = [F.col(f"p{j}").bitwiseXOR(_xor(upto, f"lane{j}")) for j in (0, 1)]
        return F.struct(t["pos"].alias("depth"), keys[0].alias("key0"), keys[1].alias("key1"),
                        keys[0].bitwiseXOR(t["lane0"]).alias("up0"), keys[1].bitwiseXOR(t["lane1"]).alias("up1"),
                        t["n_bytes"].alias("n_bytes"))
    return F.transform("turns", node)


def _nodes(blocks: DataFrame, ids: DataFrame) -> DataFrame:
    """depth, key0, key1, up0, up1, n_bytes, n_convs, conv_id of every node."""
    groups = cut_lineage(blocks.groupBy("k", "p0", "p1", "x0", "x1")
                         .agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"),
                              F.first("turns").alias("turns")), "trie-groups")
    siblings = groups.groupBy("k", "p0", "p1").agg((F.count(F.lit(1)) > 1).alias("diverge"))
    spread = groups.join(siblings.hint("merge"), ["k", "p0", "p1"]).select(
        "diverge", "n_convs", "conv_id", F.explode(_turn_nodes()).alias("t")).select("diverge", "n_convs", "conv_id", "t.*")
    spread = cut_lineage(spread, "trie-spread")
    cols = [*KEY, "up0", "up1", "n_bytes", "n_convs", "conv_id"]
    alone = spread.where("NOT diverge").select(*cols)
    refined = spread.where("diverge").groupBy(*KEY).agg(
        F.first("up0").alias("up0"), F.first("up1").alias("up1"), F.first("n_bytes").alias("n_bytes"),
        F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id")).select(*cols)
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    root = ids.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id")).where("n_convs > 0").select(
        zero.alias("depth"), zero.alias("key0"), zero.alias("key1"), none.alias("up0"), none.alias("up1"),
        zero.alias("n_bytes"), "n_convs", "conv_id")
    return cut_lineage(alone.unionByName(refined).unionByName(root), "trie-nodes")


_PIECE = "depth bigint, key0 bigint, key1 bigint, first bigint, ids string"
_PIECE_ARROW = pa.schema([("depth", pa.int64()), ("key0", pa.int64()), ("key1", pa.int64()),
                          ("first", pa.int64()), ("ids", pa.string())])
_HASH = "depth bigint, key0 bigint, key1 bigint, ends_sha256 string"
_HASH_ARROW = pa.schema([("depth", pa.int64()), ("key0", pa.int64()), ("key1", pa.int64()), ("ends_sha256", pa.string())])


def _join_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (key, conv_id): a node's ids in a batch, comma-joined."""
    for b in batches:
        rows = list(zip(*[b.column(c).to_pylist() for c in (*KEY, "conv_id")]))
        out, lo = [], 0
        for hi in range(1, len(rows) + 1):
            if hi == len(rows) or rows[hi][:3] != rows[lo][:3]:
                out.append((*rows[lo], ",".join(str(r[3]) for r in rows[lo:hi])))
                lo = hi
        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out), _PIECE_ARROW)]
                                         if out else [pa.array([], t.type) for t in _PIECE_ARROW], schema=_PIECE_ARROW)


def _hash_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pieces of each node: one running digest at a time."""
    now, digest = None, None

    def rows(out):
        return pa.RecordBatch.from_pylist([dict(zip(_HASH_ARROW.names, r)) for r in out], schema=_HASH_ARROW)

    for b in batches:
        out = []
        for *key, ids in zip(*[b.column(c).to_pylist() for c in (*KEY, "ids")]):
            if key == now:
                digest.update(b"," + ids.encode())
                continue
            if now is not None:
                out.append((*now, digest.hexdigest()))
            now, digest = key, hashlib.sha256(ids.encode())
        yield rows(out)
    if now is not None:
        yield rows([(*now, digest.hexdigest())])


def _ends(blocks: DataFrame, ids: DataFrame) -> DataFrame:
    """depth, key0, key1, ends_sha256 of the nodes where conversations end."""
    last = F.max_by(F.struct(F.element_at("turns", -1)["pos"].alias("depth"), F.col("p0").bitwiseXOR(F.col("x0")).alias("key0"),
                             F.col("p1").bitwiseXOR(F.col("x1")).alias("key1")), "k").alias("e")
    full = blocks.groupBy("conv_id").agg(last)
    zero = F.lit(0).cast("long")
    ends = ids.join(full, "conv_id", "left").select(
        *[F.coalesce(F.col(f"e.{c}"), zero).alias(c) for c in KEY], "conv_id")
    # sorted and written out as text by range partitions: a node that ends a third of all is spread
    pieces = stored(range_sorted(cut_lineage(ends, "trie-ends"), [*KEY, "conv_id"], "trie-end-order")
                    .select(*KEY, "conv_id").mapInArrow(_join_ids, _PIECE), "trie-end-ids")
    return (pieces.repartition(partitions(pieces.sparkSession), *KEY).sortWithinPartitions(*KEY, "first")
            .mapInArrow(_hash_ids, _HASH))


def trie(turns: DataFrame, ids: DataFrame | None = None, block: int = BLOCK) -> DataFrame:
    """Nodes of ``turns`` (conv_id, pos, digest, n_bytes, as ``positions`` gives
    them): conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens (over the subtree, (n_convs - 1) times the bytes of a
    node's last text) and ends_sha256. ``ids`` (conv_id) names conversations
    that may have no turns. A node's last turn is turn ``depth`` of ``conv_id``."""
    ship_package(turns.sparkSession)
    if ids is None:
        ids = turns.select("conv_id")
    ids = cut_lineage(ids.select("conv_id").distinct(), "trie-ids")
    blocks = _blocks(turns, block)
    nodes = _nodes(blocks, ids)
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("up0").alias("key0"),
                                                F.col("up1").alias("key1")).agg(F.count(F.lit(1)).alias("n_children"))
    weight = (F.col("n_convs") - 1) * F.col("n_bytes")
    nodes = cut_lineage(nodes.join(children, KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
                        .withColumn("weight", weight), "trie-counted")
    segments = cut_lineage(nodes.groupBy("conv_id").agg(
        F.min("depth").alias("top"), (F.max_by("n_children", "depth") == 0).cast("long").alias("leaf"),
        F.sum("weight").alias("total")), "trie-segments")
    # what each segment adds to the nodes above it, combined by block
    above = (blocks.join(segments.where("top > 1").hint("merge"), "conv_id").where(F.col("turns")[0]["pos"] < F.col("top"))
             .groupBy("k", "p0", "p1", "x0", "x1", F.least(F.col("top") - 1, F.element_at("turns", -1)["pos"]).alias("upto"))
             .agg(F.sum("total").alias("total"), F.sum("leaf").alias("leaf"), F.first("turns").alias("turns"))
             .select("total", "leaf", "upto", F.explode(_turn_nodes()).alias("t")).where("t.depth <= upto")
             .groupBy("t.depth", "t.key0", "t.key1").agg(F.sum("total").alias("more"), F.sum("leaf").alias("leaves")))
    zero = F.lit(0).cast("long")
    at_root = segments.where("top > 0").agg(F.sum("total").alias("more"), F.sum("leaf").alias("leaves")) \
        .select(zero.alias("depth"), zero.alias("key0"), zero.alias("key1"), "more", "leaves")
    above = cut_lineage(above.unionByName(at_root), "trie-above")
    rest = running_sum(nodes, ["conv_id"], ["depth"], "weight", "before", "trie-weights").join(segments.hint("merge"), "conv_id")
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("key0").alias("up0"), F.col("key1").alias("up1"),
                           F.col("conv_id").alias("parent_conv_id"))
    rest = cut_lineage(rest.join(parents.hint("merge"), ["depth", "up0", "up1"], "left"), "trie-rest")
    return (rest.join(above, KEY, "left").join(_ends(blocks, ids), KEY, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
        (F.col("leaf") + F.coalesce("leaves", zero)).alias("n_leaves"),
        (F.col("total") - F.col("before") + F.coalesce("more", zero)).cast("long").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256")))


def rebuilt(turns: DataFrame, group: int = 5, heads: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversations of ``turns`` with borrowed beginnings: conversation c gets
    the first h turns of conversation c - c % ``group``, then its own after its
    first h; h is crc32 of c in decimal, modulo ``heads``. Returns the turns and
    the ids (a rebuilt conversation can be without turns)."""
    convs = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).select(
        "conv_id", "n", (F.col("conv_id") - F.col("conv_id") % group).alias("base"),
        (F.crc32(F.col("conv_id").cast("string")) % heads).alias("h"))
    convs = cut_lineage(convs, "trie-convs")
    n_base = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    plan = convs.join(n_base, "base", "left").withColumn(
        "taken", F.least("h", F.coalesce("n_base", F.lit(0).cast("long"))))
    plan = cut_lineage(plan.select("conv_id", "base", "h", "taken"), "trie-plan")
    own = turns.join(plan.hint("merge"), "conv_id").where("conv_id = base OR pos > h").select(
        "conv_id", F.when(F.col("conv_id") == F.col("base"), F.col("pos"))
        .otherwise(F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "digest", "n_bytes")
    heads_of = turns.where(F.col("pos") < heads).withColumnRenamed("conv_id", "base")
    lent = heads_of.join(plan.where("conv_id <> base").hint("merge"), "base").where("pos <= taken") \
        .select("conv_id", "pos", "digest", "n_bytes")
    return cut_lineage(own.unionByName(lent), "trie-rebuilt"), plan.select("conv_id")
