"""N-gram Jaccard join by token-combination prefixes.

A document's tokens are its distinct ``k``-word shingles. Tokens are put in
classes by their count over the whole corpus: rare, frequent, very frequent.
In the global order rare tokens come first, so a prefix holds frequent tokens
only where a document has too few rare ones. A document with n tokens has at
most e = n - ceil(0.85 n) tokens (for the threshold 0.85) that a linked document lacks; its prefix is
extended until it has more than e of "what must be taken away": a rare token
counts 1, and the tokens of a frequent class are dealt into groups, where a
group of m tokens of class c counts m - (c - 1). Then of two linked documents
the one whose prefix ends first keeps, after e losses, a rare token or c tokens
of one group of class c, which the other one's prefix has too. So rare tokens
are indexed alone and frequent ones by combinations of c tokens of a group.
The number of groups depends on a document's size class; each document is
indexed for its own class and the next, which is as far as linked sizes go.

A rare token's bucket has fewer than ``FREQUENT`` documents, so its pairs are
counted: two documents share at most as many tokens as they share indexed ones
plus what lies beyond their prefixes, and pairs that can't reach the overlap
are out. Buckets of combinations may be of any size; ``bucket_join`` finds their
links without expanding them. A document in such a bucket has all its rare
tokens indexed, so every link over one of them is known before: there two
documents can only share frequent tokens, and pairs with too few of them (by
their number, and by a bitmap of them) are out. Near copies of one text that have too
many words of their own go that way without being compared. Candidates are
verified exactly (intersection of the token sets, as 64-bit hashes).

Defined cases: null, empty or blank texts have no tokens and stay alone; rows
with equal text are linked (through one of them); rows with equal doc_id are
separate documents; an empty table gives an empty result; extra columns are
left alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.sizing import broadcast_if_small
from ..session import cut_lineage, intermediates, release_shuffles, ship_package
from .bucket_join import Test, link_components, sorted_runs
from .common import ascii_lower, col, mixed, numbered, partitions, stored, word_array
from .packed_counts import COUNT_BITS, key_counts



@dataclass(frozen=True)
class Rule:
    """Words of a shingle; linked: den * intersection >= num * union."""
    words: int
    num: int
    den: int = 100

    @property
    def tiny(self) -> int:
        """Sets up to this size have no loss (e = 0)."""
        return (self.den - 1) // (self.den - self.num)

    @property
    def base(self) -> float:
        return self.num / self.den - 0.01  # a little wider than linked sizes need


RULE = Rule(4, 85)            # of the query op7_ngram_join
MAX_FREQUENT = 1 << 20        # bound of the broadcast class table; rarer tokens count as rare
FREQUENT = 16                 # least count of a frequent token (doubled until the table fits)
VERY_FREQUENT = 32            # times that: least count of class 3
GROUP_SHARE = 0.1             # groups of a frequent class, of a document's size

_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


# ---- tokens ---------------------------------------------------------------

def hashed_words(df: DataFrame, text: str = "text") -> DataFrame:
    """(uid, w): 64-bit hashes of the lower-cased words of each text."""
    return df.select("uid", F.transform(word_array(ascii_lower(F.col(f"`{text}`"))),
                                        lambda x: F.xxhash64(x)).alias("w"))


def _chain(parts: list[np.ndarray]) -> np.ndarray:
    h = parts[0]
    for p in parts[1:]:
        h = mixed(h * _A + _B) ^ p
    return mixed(h + _C)


def token_sets(lists: pa.Array, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(word hashes, sorted distinct shingle hashes) of each row of a list column."""
    offs = lists.offsets.to_numpy()
    base = offs[0]
    flat = lists.values.to_numpy(zero_copy_only=False).astype(np.int64, copy=False).view(np.uint64)
    flat = flat[base:offs[-1]]
    whole = _chain([flat[i:len(flat) - k + 1 + i] for i in range(k)]) if len(flat) >= k else flat[:0]
    for lo, hi in zip(offs[:-1] - base, offs[1:] - base):
        w = flat[lo:hi]
        if hi - lo >= k:
            yield w, np.unique(whole[lo:hi - k + 1])
        elif hi > lo:  # fewer words: the whole sequence as one token
            yield w, _chain([w[i:i + 1] for i in range(hi - lo)] + [np.array([hi - lo], np.uint64)])
        else:
            yield w, w


def least_overlap(n: int, rule: Rule) -> int:
    return -(-rule.num * n // rule.den)


# ---- counts ---------------------------------------------------------------

def token_classes(words: DataFrame, rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """Sorted frequent tokens and their class (2 or 3), at most MAX_FREQUENT."""
    spark = words.sparkSession
    counts = cut_lineage(key_counts(words, lambda b: (t for _, t in token_sets(b.column(1), rule.words)),
                                    max(16, 4 * partitions(spark)), FREQUENT), "ngram-counts")
    by_size = {r[0]: r[1] for r in counts.groupBy(F.floor(F.log2("n")).alias("p"))
               .agg(F.count(F.lit(1))).collect()}  # one row for each power of two
    least = FREQUENT
    while sum(c for p, c in by_size.items() if 2 ** p >= least) > MAX_FREQUENT:
        least *= 2
    top = counts.where(F.col("n") >= least).orderBy("token").toPandas()  # MAX_FREQUENT rows at most
    return (top["token"].to_numpy(np.int64).astype(np.uint64),
            np.where(top["n"].to_numpy() >= least * VERY_FREQUENT, 3, 2).astype(np.int8))


# ---- signatures -----------------------------------------------------------

def size_class(n: int, rule: Rule) -> int:
    return int(np.log(n) / -np.log(rule.base))


def groups_of(level: int, rule: Rule) -> int:
    return max(1, int(GROUP_SHARE * (1 / rule.base) ** (level - 1)))


def signatures(tokens: np.ndarray, classes: np.ndarray, rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """Rare tokens to index alone, and other signatures, of a set: its sorted
    distinct tokens and the class of each."""
    n = len(tokens)
    if n <= rule.tiny:
        return tokens[:0], _whole(tokens)
    need = n - least_overlap(n, rule) + 1
    rare = tokens[classes == 1]
    others = []
    if len(rare) < need:
        often = [(int(c), t) for c in (2, 3) for t in tokens[classes == c]]
        own = size_class(n, rule)
        for level in (own, own + 1):
            others += _combined(often, need - len(rare), level, rule)
    if n == rule.tiny + 1:  # a tiny set can lie within one of a token more
        others += [_whole(np.delete(tokens, i)) for i in range(n)]
    return rare[:need], np.unique(np.concatenate(others)) if others else tokens[:0]


def _whole(tokens: np.ndarray) -> np.ndarray:
    return _chain([tokens[i:i + 1] for i in range(len(tokens))] + [np.array([len(tokens)], np.uint64)])


def _combined(often: list, left: int, level: int, rule: Rule) -> list[np.ndarray]:
    """Combinations of 2 (class 2) or 3 (class 3) tokens of a group."""
    g = np.uint64(groups_of(level, rule))
    groups: dict[tuple[int, int], list] = {}
    for c, t in often:
        own = groups.setdefault((c, int(t % g)), [])
        own.append(t)
        left -= len(own) >= c
        if left <= 0:
            break
    out = []
    for (c, which), own in groups.items():
        if len(own) >= c:
            at = np.array(list(combinations(range(len(own)), c)))
            own = np.array(own, np.uint64)
            mark = np.full(len(at), (level << 32) + which, np.uint64)
            out.append(_chain([mark] + [own[at[:, i]] for i in range(c)]))
    return out


_INDEX = pa.schema([("sig", pa.int64()), ("uid", pa.int64()), ("n", pa.int32()), ("rest", pa.int32()),
                    ("kind", pa.int8()), ("bits", pa.list_(pa.int64()))])
SINGLE, COMBINED, COPY, SIZE, BITS = 0, 1, 2, 3, 4
BIT_WORDS = 16  # 64-bit words of the bitmap of a set's frequent tokens
_COPIES = 50_000  # texts a task remembers, to index a text that it has seen only once


def index_rows(words: DataFrame, frequent: np.ndarray, frequent_class: np.ndarray,
               rule: Rule) -> DataFrame:
    """kind SINGLE or COMBINED: (sig, uid, n, rest), with the set size n and the
    number of tokens not indexed alone (COMBINED: that two sets can share there,
    which is all of a tiny set); COPY: uid has the same words as document
    ``sig``, which is indexed in its place; SIZE: the set size of each uid;
    BITS: a bitmap of the ``rest`` of each uid that has COMBINED rows."""
    shared = words.sparkSession.sparkContext.broadcast((frequent, frequent_class))
    drop = np.uint64(64 - COUNT_BITS)

    def index(batches):
        often, cls = shared.value
        seen: dict[bytes, int] = {}
        for b in batches:
            out: list[list] = [[], [], [], [], []]
            bitmaps: list[tuple[int, list]] = []

            def add(sig, u, n, rest, kind):
                for x, v in zip(out, (sig, u, n, rest, kind)):
                    x.append(v if v is sig else np.full(len(sig), v, np.int64))

            for u, (w, t) in zip(b.column(0).to_pylist(), token_sets(b.column(1), rule.words)):
                add(np.zeros(1, np.int64), u, len(t), 0, SIZE)
                if not len(t):
                    continue
                key = hashlib.blake2b(w.tobytes(), digest_size=16).digest()
                if key in seen:
                    add(np.array([seen[key]], np.int64), u, len(t), 0, COPY)
                    continue
                if len(seen) >= _COPIES:
                    seen.clear()
                seen[key] = u
                c = np.ones(len(t), np.int8)
                if len(often):
                    short = t >> drop
                    at = np.minimum(np.searchsorted(often, short), len(often) - 1)
                    c = np.where(often[at] == short, cls[at], 1)
                single, combined = signatures(t, c, rule)
                add(single.view(np.int64), u, len(t), len(t) - len(single), SINGLE)
                shared_there = t if len(t) <= rule.tiny + 1 else t[c != 1]
                add(combined.view(np.int64), u, len(t), len(shared_there), COMBINED)
                if len(combined):
                    bitmaps.append((u, bitmap(shared_there)))
            if out[0]:
                cols = [pa.array(np.concatenate(x).astype(f.type.to_pandas_dtype())) for x, f in zip(out, _INDEX)]
                yield pa.RecordBatch.from_arrays([*cols, pa.nulls(len(cols[0]), _INDEX[5].type)], schema=_INDEX)
            if bitmaps:
                n = len(bitmaps)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([0] * n, pa.int64()), pa.array([u for u, _ in bitmaps], pa.int64()),
                     pa.array([0] * n, pa.int32()), pa.array([0] * n, pa.int32()), pa.array([BITS] * n, pa.int8()),
                     pa.array([b for _, b in bitmaps], _INDEX[5].type)], schema=_INDEX)

    return words.mapInArrow(index, "sig long, uid long, n int, rest int, kind byte, bits array<bigint>")


def bitmap(tokens: np.ndarray) -> list[int]:
    bits = np.zeros(64 * BIT_WORDS, np.uint8)
    bits[(tokens % np.uint64(64 * BIT_WORDS)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").view(np.int64).tolist()


def measures(n: Column, rest: Column) -> Column:
    """The set size and ``rest`` of a COMBINED row as one long, ordered by size."""
    return F.shiftleft(n.cast("long"), 32) + rest


def may_share(a: np.ndarray, b: np.ndarray, rule: Rule) -> np.ndarray:
    """Whether two sets, by their ``measures``, can be linked over a combination."""
    na, nb, low = a >> 32, b >> 32, (1 << 32) - 1
    return near_sizes(na, nb, rule) & (np.minimum(a & low, b & low) * (rule.num + rule.den) >= (na + nb) * rule.num)


def may_link(va: Column, vb: Column, xa: Column, xb: Column, rule: Rule) -> Column:
    """The same for columns, and by the bitmaps: a bit of one that the other
    lacks is a token that it lacks, too."""
    def lost(x, y):
        return reduce(lambda a, b: a + b, [F.bit_count(x[i].bitwiseAND(F.bitwise_not(y[i]))) for i in range(BIT_WORDS)])

    def enough(shared):
        return shared * (rule.num + rule.den) >= (na + nb) * rule.num

    na, nb = F.shiftright(va, 32), F.shiftright(vb, 32)
    fa, fb = (v.bitwiseAND((1 << 32) - 1) for v in (va, vb))
    sizes = F.least(na, nb) * rule.den >= F.greatest(na, nb) * rule.num
    return (sizes & enough(F.least(fa, fb))
            & F.coalesce(enough(F.least(fa - lost(xa, xb), fb - lost(xb, xa))), F.lit(True)))


def combined_rows(index: DataFrame, rule: Rule) -> DataFrame:
    """(sig, uid, v) of the COMBINED rows that can be linked with another one of
    their bucket, for all that its smallest set tells; v: ``measures``."""
    rows = index.where(F.col("kind") == COMBINED)
    least = rows.groupBy("sig").agg(F.min("n").alias("low"), F.count(F.lit(1)).alias("k")).where("k > 1").drop("k")
    return (rows.join(least.hint("merge"), "sig")
            .where(F.col("rest").cast("long") * (rule.num + rule.den) >= (F.col("n") + F.col("low")).cast("long") * rule.num)
            .select("sig", "uid", measures(F.col("n"), F.col("rest")).alias("v")))


# ---- candidates -----------------------------------------------------------

def near_sizes(a: np.ndarray, b: np.ndarray, rule: Rule) -> np.ndarray:
    return rule.den * np.minimum(a, b).astype(np.int64) >= rule.num * np.maximum(a, b).astype(np.int64)


def rare_pairs(singles: DataFrame, rule: Rule) -> DataFrame:
    """Pairs (a, b) that share enough rare tokens. A bucket has fewer rows than
    a frequent token's count, so each index row has a bounded number of pairs."""
    rows = singles.select("sig", "uid", "n", "rest").repartition(partitions(singles.sparkSession), "sig") \
        .sortWithinPartitions("sig", "uid")

    def expand(batches):
        for sig, uid, n, rest in sorted_runs(batches):
            out = []
            for d in range(1, len(sig)):
                at = np.flatnonzero(sig[:-d] == sig[d:])
                if not len(at):  # no bucket has more than d rows
                    break
                at = at[near_sizes(n[at], n[at + d], rule)]
                x, y = at, at + d
                both = n[x].astype(np.int64) + n[y]
                overlap = -(-rule.num * both // (rule.num + rule.den))
                least = np.maximum(1, overlap - np.maximum(rest[x], rest[y]))
                out.append((np.minimum(uid[x], uid[y]), np.maximum(uid[x], uid[y]), least.astype(np.int32)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)],
                                                 names=["a", "b", "least"])

    return (rows.mapInArrow(expand, "a long, b long, least int").groupBy("a", "b")
            .agg(F.count(F.lit(1)).alias("shared"), F.max("least").alias("least"))
            .where("shared >= least").select("a", "b"))


def verified(pairs: DataFrame, texts: DataFrame, rule: Rule) -> DataFrame:
    """The links among ``pairs`` (a, b); both sides' token sets are compared."""
    def sets(batches):
        for b in batches:
            t = [t.view(np.int64) for _, t in token_sets(b.column(1), rule.words)]
            if t:
                offs = np.cumsum([0, *map(len, t)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.ListArray.from_arrays(pa.array(offs), pa.array(np.concatenate(t)))],
                    names=["uid", "s"])

    who = cut_lineage(pairs.select(F.explode(F.array("a", "b")).alias("uid")).distinct(), "ngram-who")
    some = texts.join(broadcast_if_small(who), "uid", "left_semi")
    own = cut_lineage(hashed_words(some).mapInArrow(sets, "uid long, s array<long>"), "ngram-sets")
    one, two = own.toDF("a", "sa"), own.toDF("b", "sb")
    shared = F.size(F.array_intersect("sa", "sb"))
    return (pairs.join(one, "a").join(two.hint("merge"), "b").withColumn("i", shared)
            .where(rule.den * F.col("i") >= rule.num * (F.size("sa") + F.size("sb") - F.col("i"))).select("a", "b"))


def linked(texts: DataFrame, rule: Rule = RULE) -> tuple[DataFrame, DataFrame]:
    """(uid, n) and (node, component) for a written table (uid, text, ...)."""
    spark = texts.sparkSession
    ship_package(spark)
    words = hashed_words(texts)
    with intermediates(spark):  # the index goes once the components are there
        classes = token_classes(words, rule)
        release_shuffles(spark)
        index = stored(index_rows(words, *classes, rule), "ngram-index", "kind")
        sizes = stored(index.where(F.col("kind") == SIZE).select("uid", "n"), "ngram-sizes", keep=True)
        copies = index.where(F.col("kind") == COPY).select(F.col("sig").alias("a"), F.col("uid").alias("b"))
        bits = index.where(F.col("kind") == BITS).select("uid", "bits")
        # first of a bucket: the set with the fewest tokens that no other one can have
        test = Test(lambda a, b, _: may_share(a, b, rule), lambda va, vb, xa, xb, _: may_link(va, vb, xa, xb, rule),
                    lambda pairs: verified(pairs, texts, rule), bits,
                    lambda v: F.shiftright(v, 32) * rule.num - v.bitwiseAND((1 << 32) - 1) * (rule.num + rule.den))
        pairs = cut_lineage(rare_pairs(index.where(F.col("kind") == SINGLE), rule), "ngram-pairs")
        release_shuffles(spark)
        with intermediates(spark):
            links = stored(verified(pairs, texts, rule).unionByName(copies), "ngram-links", keep=True)
        release_shuffles(spark)
        combined = stored(combined_rows(index, rule), "ngram-combined")
        release_shuffles(spark)
        comps = stored(link_components(combined, links, pairs, test, "ngram"), "ngram-comps", keep=True)
    return sizes, comps


def join_rows(rows: DataFrame, uid: str = "_uid", text: str = "text", doc_id: str = "doc_id", rule: Rule = RULE) -> DataFrame:
    """For a written table with a unique ``uid``: uid, doc_id, n_shingles,
    component_id (smallest doc_id reachable) and first_of_component (true for
    one row of each component)."""
    texts = rows.select(col(uid).alias("uid"), col(text).alias("text"))
    sizes, comps = linked(texts, rule)
    ids = rows.select(col(uid).alias("uid"), col(doc_id).alias("doc_id"))
    key = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), "uid")
    member = comps.toDF("uid", "comp").join(ids, "uid").withColumn("key", key)
    first = cut_lineage(member.groupBy("comp").agg(F.min("key").alias("first")), "ngram-first")
    of = cut_lineage(comps.toDF("uid", "comp").join(first, "comp").select("uid", "first"), "ngram-of")
    return (ids.join(sizes, "uid", "left").join(of, "uid", "left")
            .withColumn("first", F.coalesce("first", key))
            .select("uid", "doc_id", F.col("n").cast("long").alias("n_shingles"),
                    F.col("first.id").alias("component_id"),
                    (F.col("first.uid") == F.col("uid")).alias("first_of_component")))


def join(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", rule: Rule = RULE) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, first_of_component."""
    rows, uid = numbered(docs.select(col(doc_id).alias("doc_id"), col(text).alias("text")), "ngram-docs")
    return join_rows(rows, uid, rule=rule).drop("uid")


def dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", rule: Rule = RULE) -> DataFrame:
    """``docs`` with one row of each component, that of the smallest doc_id."""
    rows, uid = numbered(docs, "ngram-docs")
    rest = join_rows(rows, uid, text, doc_id, rule).where("not first_of_component").select(F.col("uid").alias(uid))
    return rows.join(rest, uid, "left_anti").select(*[col(c) for c in docs.columns])
