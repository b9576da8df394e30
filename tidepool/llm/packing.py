r"""Packing documents into token sequences by the sum-of-squares rule.

A document is its token ids and an end id. Only documents longer than a
sequence are cut, into pieces of the full length; the last piece may be shorter. Let
N(g) be the number of open sequences with g places left. A piece goes where the sum
of N(g)^2 is smallest afterwards: into the open sequence with the best gap (the
tightest among equals), or into a new one. This keeps gaps of all sizes at hand
and is an online rule, so a task packs the documents of its partition as they come,
without any shuffle; some hundred sequences stay open whatever its size.

What is open at the end of a partition is packed again: those sequences (not the
rest) are dealt to tasks of at most about ``SHARD_IDS`` ids, their pieces,
longest first, by the same rule, until one task holds all that is open or
a round no longer helps. In that last round a new sequence is begun only where no
open one has room. A task's open sequences are bounded by ``OPEN_IDS`` ids: beyond it they
are handed to the next round early.

``pack`` writes a folder of Parquet through Spark's committer: sequence_id,
token_ids (at most ``length``, as little-endian unsigned 32-bit integers), and
pieces (doc_id, piece, start, offset, length). ``read_sequences`` gives the ids as arrays.

Defined cases: a null or empty text is its end id; repeated rows and equal or null
doc_ids are packed each; a text of any length is cut, never shortened; an
empty table gives no sequence; extra columns are left alone. Special-token
strings in a text are read as the tokenizers library reads them by default.
"""

from __future__ import annotations

import math
import re
import uuid
import zlib
from array import array
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import delete_paths, ensure_parallelism, scratch_path, ship_package

LENGTH = 4096
END_ID = 1
SHARD_IDS = 8_000_000
OPEN_IDS = 24_000_000
KNOWN_WORDS = 500_000
WORD_BYTES = 64
ROWS_OUT = 128
_SIGNS = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"  # ASCII signs other than the apostrophe
# Letters that neither composition nor case changes in number: ASCII, Latin-1, Extended-A without dotted I.
_LATIN = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f]+")
# Byte-level vocabularies write a byte as its Latin-1 letter; those without a
# printable one take the code points from 256 on, in order.
_BYTE_LETTERS = {b: 256 + k for k, b in enumerate([*range(33), *range(127, 161), 173])}
_ENCODERS: dict[str, WordEncoder] = {}


class _Words(dict):
    """Ids of words, found when a word is first met. A full table is put aside
    and words still in use are taken over from it."""

    def __init__(self, learn, older: dict | None = None):
        self.learn, self.older = learn, {} if older is None else older

    def __missing__(self, word: bytes) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids = self.learn(word)
        if len(word) <= WORD_BYTES:  # long strings hardly come again
            self[word] = ids
        return ids

    def renewed(self) -> _Words:
        if len(self) < KNOWN_WORDS:
            return self
        self.older = {}
        return _Words(self.learn, self)


class WordEncoder:
    """Token ids of whole texts, as little-endian unsigned 32-bit integers, by a
    ``tokenizers`` file that drops white space, lowers case and maps bytes to
    letters. Such a file gives a text the ids of its words one after another, and
    cuts words before and after signs, so the library is asked once for each
    word. A file of another kind encodes whole texts."""

    def __init__(self, path: str):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.model = self.tok.model.tokenize
        self.special = [t.content.encode() for t in self.tok.get_added_tokens_decoder().values()]
        self.by_word = self._drops_white_space()
        self.words = _Words(self._word)

    @staticmethod
    def get(path: str) -> WordEncoder:
        if path not in _ENCODERS:
            _ENCODERS[path] = WordEncoder(path)
        return _ENCODERS[path]

    def _whole(self, text: str) -> bytes:
        return array("I", self.tok.encode(text, add_special_tokens=False).ids).tobytes()

    def _latin(self, low: bytes) -> bytes:
        """Ids of a lower-case word of Latin letters, or of ASCII signs."""
        letters = low.decode() if low.isascii() else low.decode("latin-1").translate(_BYTE_LETTERS)
        return array("I", [t.id for t in self.model(letters)]).tobytes()

    def _word(self, word: bytes) -> bytes:
        if word.isalpha():  # ASCII letters only
            return self._latin(word.lower())
        left = word.lstrip(_SIGNS)
        core = left.rstrip(_SIGNS)
        if len(core) == len(word) or not core:
            text = word.decode()
            return self._latin(text.lower().encode()) if core and _LATIN.fullmatch(text) else self._whole(text)
        if not core.isalpha() and not _LATIN.fullmatch(core.decode()):
            return self._whole(word.decode())
        known, before, after = self.words, word[:len(word) - len(left)], left[len(core):]
        return (known[before] if before else b"") + known[core] + (known[after] if after else b"")

    def _drops_white_space(self) -> bool:
        """Whether texts can be taken apart as ``_word`` does it, by trial."""
        signs = _SIGNS.decode()
        probes = ["One two", " one  Two\n", "don't\tstop...now (here) 12", "a é. ß !?x"]
        apart = [x for p in probes for w in p.split()
                 for x in (w[:len(w) - len(w.lstrip(signs))], w.strip(signs), w[len(w.rstrip(signs)):]) if x]
        letters = [chr(c) for c in range(65, 384) if _LATIN.fullmatch(chr(c))]
        return (b"".join(map(self._whole, probes)) == b"".join(map(self._whole, apart))
                and all(self._latin(w.lower().encode()) == self._whole(w)
                        for w in ["word", "Packing", "...", "?!", *letters, "".join(letters)]))

    def encode(self, text: str) -> bytes:
        raw = text.encode()
        if not self.by_word or any(s in raw for s in self.special):
            return self._whole(text)
        self.words = self.words.renewed()
        return b"".join(map(self.words.__getitem__, raw.split()))


class Packer:
    """Open sequences of one task. ``place`` returns a sequence that is full now."""

    def __init__(self, length: int, may_open: bool = True):
        self.length, self.may_open = length, may_open
        self.count = np.zeros(length + 1, np.int32)  # N(g); places 0 and ``length`` stay 0
        self.open: dict[int, list[list]] = {}        # gap -> sequences, each a list of pieces
        self.ids = 0

    def place(self, piece: tuple, size: int) -> list | None:
        n, length = self.count, self.length
        here = n[size:length]                  # sequences whose gap is size, size + 1, ...
        after = n[:length - size]              # and those that have the gap left then
        cost = np.where(here > 0, 2 * (after - here) + 2, np.iinfo(np.int32).max)
        if len(cost):
            cost[0] -= here[0] > 0             # a full sequence is no longer counted
        best = int(cost.argmin()) if len(cost) else -1
        fits = best >= 0 and here[best] > 0
        if fits and (not self.may_open or cost[best] <= 2 * n[length - size] + 1):
            gap = size + best
            seq = self.open[gap].pop()
            n[gap] -= 1
        else:
            gap, seq = length, []
        seq.append(piece)
        self.ids += size
        left = gap - size
        if left == 0:
            self.ids -= length
            return seq
        n[left] += 1
        self.open.setdefault(left, []).append(seq)
        return None

    def drain(self) -> Iterator[list]:
        for gap in sorted(self.open):
            yield from self.open[gap]
        self.open, self.ids = {}, 0
        self.count[:] = 0


def _row_schema(doc_id: T.DataType) -> T.StructType:
    piece = T.StructType([T.StructField("doc_id", doc_id), T.StructField("piece", T.IntegerType()),
                          T.StructField("start", T.LongType()), T.StructField("offset", T.LongType()),
                          T.StructField("length", T.LongType())])
    return T.StructType([T.StructField("sequence_id", T.LongType()), T.StructField("full", T.BooleanType()),
                         T.StructField("token_ids", T.BinaryType()),
                         T.StructField("pieces", T.ArrayType(piece))])


class _Writer:
    """Arrow batches of sequences; ids are unique by round, task and number."""

    def __init__(self, schema: pa.Schema, round_no: int):
        self.schema, self.rows = schema, []
        self.next = (round_no << 56) | (TaskContext.get().partitionId() << 32)

    def add(self, seq: list, full: bool) -> Iterator[pa.RecordBatch]:
        self.rows.append((self.next, full, seq))
        self.next += 1
        if len(self.rows) >= ROWS_OUT:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.rows:
            return
        numbers, full, seqs = zip(*self.rows)
        self.rows = []
        flat = [p for s in seqs for p in s]
        size = np.array([len(p[3]) // 4 for p in flat], np.int64)
        per = np.array([len(s) for s in seqs])
        bounds = np.concatenate([[0], np.cumsum(per)])
        ends = np.concatenate([[0], np.cumsum(size)])
        offset = ends[:-1] - np.repeat(ends[bounds[:-1]], per)
        struct = self.schema.field("pieces").type.value_type
        fields = [[p[0] for p in flat], [p[1] for p in flat], [p[2] for p in flat], offset, size]
        pieces = pa.StructArray.from_arrays([pa.array(v, f.type) for v, f in zip(fields, struct)], fields=list(struct))
        yield pa.RecordBatch.from_arrays([
            pa.array(numbers, pa.int64()), pa.array(full, pa.bool_()),
            pa.array([b"".join([p[3] for p in s]) for s in seqs], pa.binary()),
            pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pieces).cast(self.schema.field("pieces").type)],
            schema=self.schema)


def _first_round(tokenizer: str, end_id: int, length: int, open_ids: int, schema: pa.Schema):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, bins, out = WordEncoder.get(tokenizer), Packer(length), _Writer(schema, 0)
        for b in batches:
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text")):
                ids = enc.encode(text.as_py() or "") + end
                for k, at in enumerate(range(0, len(ids), 4 * length)):
                    part = ids[at:at + 4 * length]
                    seq = bins.place((doc_id, k, k * length, part), len(part) // 4)
                    if seq is not None:
                        yield from out.add(seq, True)
                if bins.ids > open_ids:
                    for seq in bins.drain():
                        yield from out.add(seq, False)
        for seq in bins.drain():
            yield from out.add(seq, False)
        yield from out.flush()
    return run


def _next_round(round_no: int, length: int, last: bool, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, out, bins = [], _Writer(schema, round_no), Packer(length, may_open=not last)
        for b in batches:
            for ids, pieces in zip(b.column("token_ids"), b.column("pieces").to_pylist()):
                raw = ids.as_py()
                items += [(p["doc_id"], p["piece"], p["start"], raw[4 * p["offset"]:4 * (p["offset"] + p["length"])])
                          for p in pieces]
        items.sort(key=lambda p: -len(p[3]))
        for p in items:
            seq = bins.place(p, len(p[3]) // 4)
            if seq is not None:
                yield from out.add(seq, True)
        for seq in bins.drain():
            yield from out.add(seq, last)
        yield from out.flush()
    return run


def pack(docs: DataFrame, tokenizer: str, end_id: int = END_ID, length: int = LENGTH, out: str | None = None,
         shard_ids: int = SHARD_IDS, open_ids: int = OPEN_IDS) -> str:
    """Write the sequences of ``docs`` (doc_id, text) to a folder; returns it."""
    spark = docs.sparkSession
    ship_package(spark)
    out = out or scratch_path(spark, f"packed-{uuid.uuid4().hex}")
    rows = _row_schema(docs.schema["doc_id"].dataType)
    arrow = to_arrow_schema(rows)
    texts = ensure_parallelism(docs.select("doc_id", "text"))
    state = texts.mapInArrow(_first_round(tokenizer, end_id, length, open_ids, arrow), rows)
    was, k = math.inf, 0
    while True:
        state.write.option("compression", "zstd").partitionBy("full").parquet(f"{out}/round={k}")
        still_open = spark.read.schema(rows).parquet(f"{out}/round={k}").where("NOT full")
        left = still_open.agg(F.coalesce(F.sum(F.octet_length("token_ids") / 4), F.lit(0.0))).first()[0]
        if left == 0:
            break
        k += 1
        shards = math.ceil(left / shard_ids)
        last = shards == 1 or left > 0.7 * was  # what a round hardly reduced doesn't fit together
        was = left
        state = (still_open.repartition(shards, F.xxhash64("sequence_id"))
                 .mapInArrow(_next_round(k, length, last, arrow), rows))
    # no rows, but the columns: a folder without sequences is read like any other
    spark.createDataFrame([], rows).drop("full").write.parquet(f"{out}/round={k + 1}/full=true")
    delete_paths(spark, [f"{out}/round={i}/full=false" for i in range(k + 1)])
    return out


def _stored(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("basePath", path).parquet(path).drop("round", "full")


def read_sequences(spark: SparkSession, path: str) -> DataFrame:
    """The packed sequences: sequence_id, token_ids (an array), pieces."""
    ship_package(spark)
    rows = _stored(spark, path).select("sequence_id", "token_ids", "pieces")
    schema = T.StructType([T.StructField("token_ids", T.ArrayType(T.LongType())) if f.name == "token_ids" else f
                           for f in rows.schema])
    arrow = to_arrow_schema(schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = b.column("token_ids").to_pylist()
            at = pa.array(np.concatenate([[0], np.cumsum([len(r) // 4 for r in raw])]), pa.int32())
            ids = pa.array(np.frombuffer(b"".join(raw), "<u4").astype(np.int64))
            yield pa.RecordBatch.from_arrays([b.column("sequence_id"), pa.ListArray.from_arrays(at, ids).cast(
                arrow.field("token_ids").type), b.column("pieces")], schema=arrow)
    return rows.mapInArrow(read, schema)


def digests(spark: SparkSession, path: str) -> DataFrame:
    """Per piece, from the written sequences: doc_id, piece, start, length,
    ids_crc32, sequence_id, offset."""
    sequences = _stored(spark, path)
    piece = sequences.schema["pieces"].dataType.elementType
    rows = T.StructType([*piece.fields, T.StructField("ids_crc32", T.LongType()), T.StructField("sequence_id", T.LongType())])
    arrow = to_arrow_schema(rows)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column("pieces")
            parts, per = lists.flatten(), np.diff(lists.offsets.to_numpy())
            place = iter(zip((4 * parts.field("offset").to_numpy()).tolist(), (4 * parts.field("length").to_numpy()).tolist()))
            crc = [zlib.crc32(raw[at:at + n]) for ids, k in zip(b.column("token_ids"), per.tolist())
                   for raw in [memoryview(ids.as_buffer())] for at, n in islice(place, k)]
            seq = np.repeat(b.column("sequence_id").to_numpy(), per)
            yield pa.RecordBatch.from_arrays([*[parts.field(f.name) for f in piece.fields],
                                              pa.array(crc, pa.int64()), pa.array(seq, pa.int64())], schema=arrow)
    return sequences.select("sequence_id", "token_ids", "pieces").mapInArrow(read, rows)
