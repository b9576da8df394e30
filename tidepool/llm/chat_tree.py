r"""Chat formatting as a prefix tree.

Conversations that share their first turns are merged into a tree; the tokens
of a shared turn are emitted once. A turn is written as

    ### <role>: <text> </turn>\n

where ``\``, ``###`` and ``</turn>`` in a text (and ``:`` in a role) get a
``\`` before them, so no text can imitate a turn and the texts come back exactly.

Each conversation is the path of digests of its prefixes. Distinct paths are
range-sorted; a prefix belongs to the first path in that order that has it, so
a path emits one *segment*: the turns that no earlier path has. Segments in path
order are the depth-first order of the trees. A distributed prefix sum of
token counts gives each segment's start in its tree, and a path's ancestors are
prefixes of earlier segments: one interval for each.

``write_tree`` writes two tables to a folder, by Spark's committer:

* ``segments``: tree, segment, start (first token, in the tree), token_ids,
  position_ids (a token's place in its conversation), attention (intervals
  start, stop in the tree that the segment's tokens attend to, besides the
  tokens before them in the segment), turn_tokens, loss (start, stop in the
  segment of the texts of the role ``assistant``).
* ``paths``: path, tree, parts (segment, depth of its first turn, turns, start,
  tokens), and ``conversations``: conv_id, path.

Turns are merged by 128 bits of a cryptographic digest. A tree of very many
conversations is many rows; no tree is ever in one task.

Defined cases: a null text or role counts as empty; turns are in the order of
``turn`` (null first), equal turns by digest; rows with a null conv_id are one
conversation; equal conversations share one path; an empty table gives empty
tables; extra columns are left alone.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage, scratch_path, ship_package
from .common import range_sorted, running_sum, stored
from .token_planes import PieceEncoder

ASSISTANT = "assistant"
HEAD, MID, TAIL = "### ", ": ", " </turn>\n"
_CONTROL = re.compile(r"(\\|###|</turn>)")
_ROLE_CONTROL = re.compile(r"(\\|###|</turn>|:)")
_ESCAPED = re.compile(r"\\(\\|###|</turn>|:)")
_TURN = re.compile(r"### ((?:\\.|[^\\:])*): (.*)", re.S)
BATCH_TURNS = 512


def escape(text: str) -> str:
    return _CONTROL.sub(r"\\\1", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def turn_parts(role: str, text: str) -> tuple[str, str, str]:
    """Head, escaped text and tail of a turn."""
    return HEAD + _ROLE_CONTROL.sub(r"\\\1", role) + MID, escape(text), TAIL


def parse(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted conversation."""
    turns = formatted.split(TAIL)
    assert turns.pop() == ""
    return [tuple(map(unescape, _TURN.fullmatch(t).groups())) for t in turns]


def paths_of(conversations: DataFrame) -> DataFrame:
    """conv_id, turns (role, text) in order, path (a digest for each prefix)."""
    empty = F.lit("")
    row = F.struct("turn", F.unhex(F.sha2(F.concat(
        F.length(F.coalesce("role", empty)), F.lit(":"), F.coalesce("role", empty), F.coalesce("text", empty)), 256)).alias("digest"), F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text"))
    convs = (conversations.select("conv_id", row.alias("r")).groupBy("conv_id")
             .agg(F.sort_array(F.collect_list("r")).alias("r"))
             .select("conv_id", F.col("r.digest").alias("digests"),
                     F.transform("r", lambda r: F.struct(r["role"], r["text"])).alias("turns")))

    @F.udf("array<binary>", useArrow=True)
    def chain(digests):
        out, now = [], b""
        for d in digests:
            now = hashlib.blake2b(now + bytes(d), digest_size=16).digest()
            out.append(now)
        return out

    return convs.select("conv_id", "turns", chain("digests").alias("path"))


_SEGMENT = "segment bigint, token_ids array<int>, turn_tokens array<int>, loss array<struct<start:int,stop:int>>"
_SEGMENT_ARROW = pa.schema([
    ("segment", pa.int64()), ("token_ids", pa.list_(pa.int32())), ("turn_tokens", pa.list_(pa.int32())),
    ("loss", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())])))])


def _encode_segments(tokenizer: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = PieceEncoder.get(tokenizer, plain=True)
        for b in batches:
            rows = b.to_pylist()
            for lo in range(0, len(rows), BATCH_TURNS):
                part = rows[lo:lo + BATCH_TURNS]
                flat = [p for r in part for t in r["turns"] for p in turn_parts(t["role"], t["text"])]
                ids = iter(enc.encode(flat))
                out = []
                for r in part:
                    held, sizes, loss, at = [], [], [], 0
                    for t in r["turns"]:
                        head, text, tail = next(ids), next(ids), next(ids)
                        held += [head, text, tail]
                        if t["role"] == ASSISTANT and len(text):
                            loss.append({"start": at + len(head), "stop": at + len(head) + len(text)})
                        sizes.append(len(head) + len(text) + len(tail))
                        at += sizes[-1]
                    out.append({"segment": r["segment"], "token_ids": np.concatenate(held).astype(np.int32),
                                "turn_tokens": sizes, "loss": loss})
                yield pa.RecordBatch.from_pylist(out, schema=_SEGMENT_ARROW)
    return run


def write_tree(conversations: DataFrame, tokenizer: str, out: str | None = None) -> str:
    """Write ``conversations`` (conv_id, turn, role, text) in the format above;
    returns the folder."""
    spark = conversations.sparkSession
    ship_package(spark)
    out = out or scratch_path(spark, f"chat-{uuid.uuid4().hex}")
    convs = stored(paths_of(conversations).withColumn("cid", F.monotonically_increasing_id())
                   .withColumn("leaf", F.element_at("path", -1)), "chat-conversations")
    distinct = cut_lineage(convs.groupBy("leaf").agg(F.min("cid").alias("cid"), F.first("path").alias("key")), "chat-paths")
    # the row number follows the order of the range-sorted partitions
    ranked = cut_lineage(range_sorted(distinct, ["key"], "chat-order")
                         .select("leaf", "cid", "key", "_pid"), "chat-sorted")
    ranked = running_sum(ranked.withColumn("one", F.lit(1)), [], ["key"], "one", "path", "chat-rank")
    ranked = cut_lineage(ranked.select("path", "leaf", "cid", "key"), "chat-ranked")

    nodes = ranked.select("path", F.posexplode("key").alias("depth", "node"))
    owners = cut_lineage(nodes.groupBy("node").agg(F.min("path").alias("segment")), "chat-owners")
    # the turns of a path that one segment has: consecutive, from the segment's first turn on
    parts = cut_lineage(nodes.join(owners.hint("merge"), "node").groupBy("path", "segment")
                        .agg(F.min("depth").alias("depth"), F.count(F.lit(1)).cast("int").alias("turns")), "chat-parts")

    own = parts.where("path = segment").join(ranked.select("path", "cid"), "path")
    texts = convs.select("cid", "turns").join(own.select("cid", "segment", "depth"), "cid") \
        .select("segment", F.expr("slice(turns, depth + 1, size(turns))").alias("turns"))
    tokens = stored(texts.mapInArrow(_encode_segments(tokenizer), _SEGMENT), "chat-tokens")
    sizes = cut_lineage(tokens.select("segment", F.size("token_ids").alias("n")), "chat-sizes")
    starts = cut_lineage(running_sum(sizes, [], ["segment"], "n", "at", "chat-starts")
                         .select("segment", "at"), "chat-at")
    trees = parts.where("depth = 0").select("path", F.col("segment").alias("tree"))
    placed = (starts.join(trees.withColumnRenamed("path", "segment"), "segment")
              .join(starts.toDF("tree", "tree_at").hint("merge"), "tree")
              .select("tree", "segment", (F.col("at") - F.col("tree_at")).alias("start")))
    placed = cut_lineage(placed, "chat-placed")
    sums = tokens.join(placed, "segment").select("segment", "tree", "start", "turn_tokens")
    # a hot segment's row meets the parts of very many paths: a merge join, split by Spark
    spans = parts.join(cut_lineage(sums, "chat-sums").hint("merge"), "segment").select(
        "path", "tree", F.struct(
            "depth", "segment", "turns", "start",
            F.expr("aggregate(slice(turn_tokens, 1, turns), 0L, (a, x) -> a + x)").alias("tokens")).alias("p"))
    paths = spans.groupBy("path", "tree").agg(F.sort_array(F.collect_list("p")).alias("parts"))
    paths.write.parquet(f"{out}/paths")
    convs.select("conv_id", "leaf").join(ranked.select("leaf", "path").hint("merge"), "leaf") \
        .select("conv_id", "path").write.parquet(f"{out}/conversations")

    paths = spark.read.parquet(f"{out}/paths")
    before = F.filter("parts", lambda p: p["segment"] != F.col("path"))
    context = paths.where(F.exists("parts", lambda p: p["segment"] == F.col("path"))).select(
        F.col("path").alias("segment"),
        F.transform(before, lambda p: F.struct(p["start"].alias("start"), (p["start"] + p["tokens"]).alias("stop")))
        .alias("attention"),
        F.aggregate(before, F.lit(0).cast("long"), lambda a, p: a + p["tokens"]).alias("first"))
    (tokens.join(placed, "segment").join(context, "segment")
     .withColumn("position_ids", F.when(F.size("token_ids") > 0, F.sequence(
         F.col("first"), F.col("first") + F.size("token_ids") - 1)).otherwise(F.array().cast("array<bigint>")))
     .select("tree", "segment", "start", "token_ids", "position_ids", "attention", "turn_tokens", "loss")
     .write.option("compression", "zstd").parquet(f"{out}/segments"))
    return out


def read_paths(spark: SparkSession, path: str) -> DataFrame:
    """Each path read back from the folder: path, ids (its tokens, put together
    from the segments), loss (start, stop in them)."""
    parts = (spark.read.parquet(f"{path}/paths").select("path", F.explode("parts").alias("p"))
             .select("path", "p.*"))
    segments = spark.read.parquet(f"{path}/segments").select("segment", "token_ids", "loss")
    pieces = parts.drop("start").join(segments.hint("merge"), "segment").select(
        "path", F.struct("depth", F.expr("slice(token_ids, 1, cast(tokens as int))").alias("ids"),
                         F.filter("loss", lambda x: x["stop"] <= F.col("tokens")).alias("loss")).alias("p"))
    return pieces.groupBy("path").agg(F.sort_array(F.collect_list("p")).alias("pieces"))


_DIGEST = "path bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"


def digests(spark: SparkSession, path: str, tokenizer: str) -> DataFrame:
    """Per conversation, from the written tables: conv_id, n_turns,
    turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = PieceEncoder.get(tokenizer, plain=True).tok

        def text(ids):
            return tok.decode(ids, skip_special_tokens=False)

        for b in batches:
            out = []
            for r in b.to_pylist():
                whole = text([i for p in r["pieces"] for i in p["ids"]])
                loss = "".join(unescape(text(p["ids"][x["start"]:x["stop"]])) for p in r["pieces"] for x in p["loss"])
                turns = parse(whole)
                out.append({
                    "path": r["path"], "n_turns": len(turns),
                    "turns_sha256": hashlib.sha256("".join(f"{a}\n{t}\n" for a, t in turns).encode()).hexdigest(),
                    "loss_chars": len(loss), "loss_sha256": hashlib.sha256(loss.encode()).hexdigest(),
                    "formatted_chars": len(whole)})
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([
                ("path", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]))

    ship_package(spark)
    per_path = cut_lineage(read_paths(spark, path).mapInArrow(read, _DIGEST), "chat-digests")
    return (spark.read.parquet(f"{path}/conversations").join(per_path.hint("merge"), "path").drop("path"))
