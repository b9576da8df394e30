"""Token-ID output in bit or byte planes.

Documents are range-sorted by doc_id; each partition becomes one shard. A
shard's ids (each document's ids, then ``end_id``) are cut into blocks of
``block_ids`` ids. A block's ids, little-endian unsigned 32-bit, are transposed
into 4 byte planes (or 32 bit planes) and each plane is compressed with
zstandard, so the planes that are all zero cost a few bytes.

The format is a folder with two tables, both written by Spark's own committer,
so a lost executor or a retried task leaves no half-written shard:

* ``blocks``: shard, block, n_ids, plane_bytes (the length of each compressed
  plane: the chunk index), planes (the compressed planes, one after another);
  and of the same block ``docs``: for each document with ids in it doc_id, ordinal (of
  the document in its shard), at (its first id in the block), n (ids here), and
  doc_tokens, before (all of its ids, and those of its shard before it).
* ``shards``: shard, n_ids, n_docs, start (ids of all shards before it).

Defined cases: a null text counts as empty, so the document is its end id; a
null doc_id comes first; strings of special tokens in a text are those tokens, as
the library reads them; rows with equal doc_id follow each other by text; an
empty table gives empty tables.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path, ship_package
from .common import partitions

END_ID = 2
BLOCK_IDS = 1 << 16
CACHE_PIECES = 250_000
BATCH_BYTES = 4 << 20

# White space other than space, tab, CR, LF: texts with it are encoded whole.
_ODD = re.compile("[\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_KIND = np.zeros(256, np.uint8)  # 0 other, 1 letter, 2 ASCII sign or digit, 3 white space
_KIND[[*range(65, 91), *range(97, 123)]] = 1
_KIND[[*range(33, 65), *range(91, 97), *range(123, 127)]] = 2
_KIND[[32, 9, 10, 13]] = 3

_TOKENIZERS: dict[tuple[str, bool], PieceEncoder] = {}


class PieceEncoder:
    """Encodes batches of texts with a ``tokenizers`` file whose pre-tokenizer
    is byte-level (words with the space before them, runs of signs, ...).

    Texts are cut where the pre-tokenizer always cuts: before white space, and
    between an ASCII letter and an ASCII sign or digit. The ids of a text are
    those of its pieces one after another, so each distinct piece of a batch is
    encoded once. A bounded table keeps ids of pieces in use across batches, renewed
    from the one before it. Strings of special tokens in a text are read as the library does
    by default, as those tokens; with ``plain`` they are ordinary text.
    """

    def __init__(self, path: str, plain: bool = False):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = plain
        self.special = [] if plain else [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.known: dict[bytes, np.ndarray] = {}
        self.older: dict[bytes, np.ndarray] = {}
        # letters with or without a space before them are one token string of the model
        self.model = self.tok.model.tokenize
        self.letters = all(self._of_letters(p.encode()).tolist() == self.tok.encode(p, add_special_tokens=False).ids
                           for p in ("a", " a", "Word", " quemente", " thninghwtion", "Abc"))

    def _of_letters(self, piece: bytes) -> np.ndarray:
        text = piece.decode()
        return np.array([t.id for t in self.model("\u0120" + text[1:] if text[0] == " " else text)], np.uint32)

    @staticmethod
    def get(path: str, plain: bool = False) -> PieceEncoder:
        if (path, plain) not in _TOKENIZERS:
            _TOKENIZERS[path, plain] = PieceEncoder(path, plain)
        return _TOKENIZERS[path, plain]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray | None] = [None] * len(texts)
        plain = []
        for i, t in enumerate(texts):
            if not t:
                out[i] = np.zeros(0, np.uint32)
            elif _ODD.search(t) or any(x in t for x in self.special):
                out[i] = np.array(self.tok.encode(t, add_special_tokens=False).ids, np.uint32)
            else:
                plain.append(i)
        if plain:
            for i, ids in zip(plain, self._pieces([texts[i] for i in plain])):
                out[i] = ids
        return out

    def _pieces(self, texts: list[str]) -> Iterator[np.ndarray]:
        raw = [t.encode() for t in texts]
        data = np.frombuffer(b"".join(raw), np.uint8)
        ends = np.cumsum([len(r) for r in raw])
        kind = _KIND[data]
        a, b = kind[:-1], kind[1:]
        cut = np.empty(len(data), bool)
        cut[0] = True
        # "'" before a letter may be a contraction
        cut[1:] = ((a != 3) & (b == 3)) | ((a == 1) & (b == 2)) | ((a == 2) & (b == 1) & (data[:-1] != 39))
        cut[ends[:-1]] = True
        starts = np.flatnonzero(cut)
        offsets = np.append(starts, len(data)).astype(np.int64)
        pieces = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
        coded = pieces.dictionary_encode()
        index = coded.indices.to_numpy()
        ids = self._ids(coded.dictionary.to_pylist())
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        first = np.cumsum(size) - size
        flat = np.concatenate(ids)
        n = size[index]
        at = np.cumsum(n)
        all_ids = flat[np.repeat(first[index] - (at - n), n) + np.arange(at[-1])]
        stop = at[np.searchsorted(starts, ends) - 1]  # ids up to each text's last piece
        return iter(np.split(all_ids, stop[:-1]))

    def _ids(self, pieces: list[bytes]) -> list[np.ndarray]:
        if len(self.known) > CACHE_PIECES:
            self.known, self.older = {}, self.known
        known, older, rest = self.known, self.older, []
        for p in pieces:
            if p not in known:
                if p in older:
                    known[p] = older[p]
                elif self.letters and (p.isalpha() or p[:1] == b" " and p[1:].isalpha()):  # bytes: ASCII letters
                    known[p] = self._of_letters(p)
                else:
                    rest.append(p)
        for k in range(0, len(rest), 20_000):
            part = rest[k:k + 20_000]
            e = self.tok.encode([p.decode() for p in part], is_pretokenized=True, add_special_tokens=False)
            stops = np.searchsorted(np.array(e.word_ids), np.arange(len(part)), side="right")
            known.update(zip(part, np.split(np.array(e.ids, np.uint32), stops[:-1])))
        return [known[p] for p in pieces]


def encode_batches(ids_and_texts: Iterator[tuple[list, list[str]]], path: str):
    """(key, ids) per text, in order, some MB of text at a time."""
    enc = PieceEncoder.get(path)
    for keys, texts in ids_and_texts:
        lo, size = 0, 0
        for hi, t in enumerate(texts):
            size += len(t)
            if size >= BATCH_BYTES or hi == len(texts) - 1:
                yield from zip(keys[lo:hi + 1], enc.encode(texts[lo:hi + 1]))
                lo, size = hi + 1, 0


def to_planes(ids: np.ndarray, bits: bool) -> list[bytes]:
    b = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    if bits:
        b = np.unpackbits(b, axis=1, bitorder="little")
        return [np.packbits(b[:, k], bitorder="little").tobytes() for k in range(32)]
    return [b[:, k].tobytes() for k in range(4)]


def from_planes(planes: list[bytes], n: int) -> np.ndarray:
    if len(planes) == 32:
        bits = np.stack([np.unpackbits(np.frombuffer(p, np.uint8), count=n, bitorder="little")
                         for p in planes], axis=1)
        b = np.packbits(bits, axis=1, bitorder="little")
    else:
        b = np.stack([np.frombuffer(p, np.uint8) for p in planes], axis=1)
    return np.ascontiguousarray(b).view("<u4").reshape(-1)


_DOCS = "array<struct<doc_id:bigint,ordinal:bigint,at:int,n:int,doc_tokens:bigint,before:bigint>>"
_BLOCK_SCHEMA = f"shard int, block int, n_ids int, plane_bytes array<int>, planes binary, docs {_DOCS}"
_BLOCK_ARROW = pa.schema([
    ("shard", pa.int32()), ("block", pa.int32()), ("n_ids", pa.int32()), ("plane_bytes", pa.list_(pa.int32())),
    ("planes", pa.binary()),
    ("docs", pa.list_(pa.struct([("doc_id", pa.int64()), ("ordinal", pa.int64()), ("at", pa.int32()),
                                 ("n", pa.int32()), ("doc_tokens", pa.int64()), ("before", pa.int64())])))])


def _shard_writer(tokenizer: str, end_id: int, block_ids: int, bits: bool, level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        from pyspark import TaskContext
        shard = TaskContext.get().partitionId()
        packer = zstandard.ZstdCompressor(level=level)
        end = np.array([end_id], np.uint32)
        block, held, waiting, docs = 0, 0, [], []

        def flush():
            nonlocal block, held, waiting, docs
            planes = [packer.compress(p) for p in to_planes(np.concatenate(waiting), bits)]
            row = {"shard": shard, "block": block, "n_ids": held, "plane_bytes": [len(p) for p in planes],
                   "planes": b"".join(planes), "docs": docs}
            block, held, waiting, docs = block + 1, 0, [], []
            return pa.RecordBatch.from_pylist([row], schema=_BLOCK_ARROW)

        rows = ((b.column(0).to_pylist(), b.column(1).to_pylist()) for b in batches)
        before = ordinal = 0
        for doc_id, ids in encode_batches(rows, tokenizer):
            ids = np.concatenate((ids, end))
            done = 0
            while done < len(ids):
                take = min(block_ids - held, len(ids) - done)
                docs.append({"doc_id": doc_id, "ordinal": ordinal, "at": held, "n": take,
                             "doc_tokens": len(ids), "before": before})
                waiting.append(ids[done:done + take])
                held, done = held + take, done + take
                if held == block_ids:
                    yield flush()
            before, ordinal = before + len(ids), ordinal + 1
        if held:
            yield flush()
    return run


def write_planes(docs: DataFrame, tokenizer: str, out: str | None = None, end_id: int = END_ID,
                 block_ids: int = BLOCK_IDS, bits: bool = False, level: int = 3,
                 text: str = "text", doc_id: str = "doc_id") -> str:
    """Write ``docs`` in the format above; returns the folder."""
    spark = docs.sparkSession
    ship_package(spark)
    out = out or scratch_path(spark, f"planes-{_unique()}")
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
                       F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    # the text's hash deals rows of one doc_id out to several shards
    tie = F.xxhash64("text")
    ordered = (rows.withColumn("_tie", tie).repartitionByRange(partitions(spark), "doc_id", "_tie")
               .sortWithinPartitions("doc_id", "_tie").select("doc_id", "text"))
    ordered.mapInArrow(_shard_writer(tokenizer, end_id, block_ids, bits, level), _BLOCK_SCHEMA) \
        .write.parquet(f"{out}/blocks")
    blocks = spark.read.parquet(f"{out}/blocks")
    sums = blocks.groupBy("shard").agg(F.sum("n_ids").cast("long").alias("n_ids"),
                                       F.max(F.expr("array_max(docs.ordinal)") + 1).alias("n_docs"))
    w = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row for each shard
    sums.withColumn("start", F.coalesce(F.sum("n_ids").over(w), F.lit(0))).write.parquet(f"{out}/shards")
    return out


def _unique() -> str:
    import uuid
    return uuid.uuid4().hex


def block_arrays(batches: Iterator[pa.RecordBatch]):
    """(row without planes, ids) of each block."""
    import zstandard
    unpack = zstandard.ZstdDecompressor()
    for b in batches:
        for r in b.to_pylist():
            planes, at = [], 0
            for n in r["plane_bytes"]:
                planes.append(unpack.decompress(r["planes"][at:at + n]))
                at += n
            yield r, from_planes(planes, r["n_ids"])


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Documents read back from ``path``: shard, ordinal, doc_id, start (ids of
    all documents before it), n_tokens, ids (little-endian unsigned 32-bit).

    A document inside one block comes straight from it; the pieces of one that
    goes over a block's end are put together by (shard, ordinal)."""
    ship_package(spark)
    schema = ("shard int, ordinal bigint, doc_id bigint, before bigint, n_tokens bigint, "
              "piece int, ids binary")
    arrow = pa.schema([("shard", pa.int32()), ("ordinal", pa.int64()), ("doc_id", pa.int64()),
                       ("before", pa.int64()), ("n_tokens", pa.int64()), ("piece", pa.int32()),
                       ("ids", pa.binary())])

    def split(batches):
        for r, ids in block_arrays(batches):
            raw = ids.astype("<u4").tobytes()
            yield pa.RecordBatch.from_pylist(
                [{"shard": r["shard"], "ordinal": d["ordinal"], "doc_id": d["doc_id"], "before": d["before"],
                  "n_tokens": d["doc_tokens"], "piece": r["block"],
                  "ids": raw[4 * d["at"]:4 * (d["at"] + d["n"])]} for d in r["docs"]], schema=arrow)

    blocks = spark.read.parquet(f"{path}/blocks")
    pieces = blocks.mapInArrow(split, schema)
    whole = F.octet_length("ids") == 4 * F.col("n_tokens")
    joined = (pieces.where(~whole).groupBy("shard", "ordinal", "doc_id", "before", "n_tokens")
              .agg(F.sort_array(F.collect_list(F.struct("piece", "ids"))).alias("p"))
              .select("shard", "ordinal", "doc_id", "before", "n_tokens",
                      F.aggregate("p", F.lit(b""), lambda acc, x: F.concat(acc, x["ids"])).alias("ids")))
    docs = pieces.where(whole).drop("piece").unionByName(joined)
    return (docs.join(spark.read.parquet(f"{path}/shards").select("shard", "start"), "shard")
            .withColumn("start", F.col("start") + F.col("before")).drop("before"))


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of ``read_documents``."""
    return docs.select("doc_id", "start", F.col("n_tokens").cast("long").alias("n_tokens"),
                       F.crc32("ids").alias("ids_crc32"))
