"""Benchmark decontamination by template canonicalisation.

Numbers, names and units are replaced by typed placeholders; what is left of a
text are its literal words. Windows of ``WINDOW`` words of the benchmark's and
the documents' templates meet in a hash join, so a question with other numbers
or names still meets its original. A pair (document, item) then must fill the
item's slots consistently: each slot value of the item ("12", "Anna") stands
for one value, the one that most windows give it, and windows that say
otherwise don't count. That is judged for each place of the document by itself
(windows whose places there and in the item are about equally far apart), so
that each copy has its own values, and for the whole document. An item is in a
document when at least ``COVERAGE`` of its windows are, in one of these. DataFrame functions only.

Typing, on the words of a text: a run of digits (with . or , inside) is a
number; a unit of the list below right after a number is a unit; a word with a
capital first letter and small letters after it, that follows a word or one of
, ; : and a space, is a name. Anywhere else (where a sentence may start) such a
word may be a name or not, and its windows match under either typing. Words of
the list ``COMMON`` are never names. A window with fewer than ``LITERALS``
literal words says too little as a template and must match word by word.

Defined cases: null and empty texts have no windows and match nothing; a text
of fewer than ``WINDOW`` words is one window; an item of 2 to 4 words is looked
for in windows of its own length, and one of a single word matches a text that
is nothing else; repeated documents or items match
each for itself; equal windows of an item count once for each place; empty
tables give an empty result; extra columns are left alone.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.sizing import broadcast_if_small
from ..session import cut_lineage
from .common import col, numbered

WINDOW = 5
COVERAGE = 0.8
LITERALS = 3
NUMBER, NAME, UNIT = "\u0001", "\u0002", "\u0003"
OPEN = "\u0004"    # a name or a literal word
SIGNS = NUMBER + NAME + UNIT + OPEN
# Unit words.
UNITS = ("mm cm dm m km mg g kg t ml cl l s sec second seconds min minute minutes h hour hours day days "
         "week weeks month months year years inch inches foot feet yard yards mile miles mph kmh pound "
         "pounds ounce ounces gallon gallons dollar dollars euro euros cent cents percent degree degrees "
         "watt watts volt volts hz khz mhz ghz kb mb gb tb").split()

# Words that start sentences and are no names.
COMMON = ("A An The This That These Those How What When Where Which Who Whom Whose Why If In On At Of For From To And "
          "But Or Nor So As Is Are Was Were Do Does Did Has Have Had Each Every Some All Any Both After Before Then "
          "There Here He She It They We You His Her Their Its Our Your My By With Without While During Since Because "
          "Although However Also Not No").split()


def typed_words(text: Column) -> Column:
    """The words of a text in lower case; a slot's word starts with its type's
    sign. Runs over whole texts, not word by word; each pattern starts with the
    characters it is about, so that it looks around at these alone."""
    t = F.regexp_replace(F.coalesce(text, F.lit("")), f"[{SIGNS}]", " ")
    t = F.regexp_replace(t, rf"(?=\p{{Lu}})(?<![\p{{L}}\p{{N}}])(?!(?:{'|'.join(COMMON)})(?![\p{{L}}\p{{N}}]))"
                            r"(\p{Lu}\p{Ll}+)(?![\p{L}\p{N}])", OPEN + "$1")
    t = F.regexp_replace(t, rf"{OPEN}(?<=[\p{{L}}\p{{N}},;:] {OPEN})", NAME)
    t = F.regexp_replace(t, r"[.,](?<=[0-9][.,])(?=[0-9])", "")
    t = F.regexp_replace(t, r"(?=[0-9])(?<![\p{L}\p{N}])([0-9]+)", NUMBER + "$1")
    t = F.lower(t)
    t = F.regexp_replace(t, rf"({NUMBER}[0-9]+ ?)({'|'.join(UNITS)})(?![\p{{L}}\p{{N}}])", f"$1 {UNIT}$2")
    return F.filter(F.split(t, rf"[^a-z0-9{SIGNS}\p{{L}}\p{{N}}]+"), lambda w: w != "")


def is_slot(w: Column) -> Column:
    return w < F.lit(OPEN)


def is_open(w: Column) -> Column:
    return w.between(F.lit(OPEN), F.lit("\u0005"))


def bare(words: Column) -> Column:
    return F.transform(words, lambda w: F.translate(w, SIGNS, ""))


def retyped(words: Column, mask: Column) -> Column:
    """``words`` with the open ones settled: names where ``mask`` has their bit."""
    return F.transform(words, lambda w, j: F.when(~is_open(w), w).otherwise(
        F.concat(F.when(F.getbit(mask, j) == 1, F.lit(NAME)).otherwise(F.lit("")), F.substring(w, 2, 1 << 20))))


def template(words: Column) -> Column:
    return F.transform(words, lambda w: F.when(is_slot(w), F.substring(w, 1, 1)).otherwise(w))


def word_codes(words: Column) -> Column:
    """A number for each word: a hash of the bare word, with the type in the
    last three bits (0 literal, 1 number, 2 name, 3 unit, 4 open)."""
    return F.transform(words, lambda w: F.when(
        w < F.lit("\u0005"), F.xxhash64(F.substring(w, 2, 1 << 20)).bitwiseAND(F.lit(-8)).bitwiseOR(F.ascii(w).cast("bigint")))
        .otherwise(F.xxhash64(w).bitwiseAND(F.lit(-8))))


def windows(df: DataFrame, keep: list[str], n: int = WINDOW) -> DataFrame:
    """Columns ``keep`` with n_windows, at, mask, h and ws (typed words) of each
    window of the texts, once for each typing of its open words: ``mask`` has
    the bits of those that are names. Typings with too few literal words all
    hash the bare words, so of these the one with every open word a name stands
    for all: a window has at most 17 rows (of 5 open words up to 2 names, or
    all), and looks at its own words only.

    A word's number is worked out once; windows are rows from then on, hashed
    in generated code, and a broadcast join right behind keeps the few that meet."""
    # outer: for a plain explode Spark infers a filter on the array's size and
    # pushes its whole expression down, to be worked out once more
    words = (df.withColumn("w", typed_words(F.col("text"))).withColumn("codes", word_codes(F.col("w")))
             .withColumn("n_windows", F.when(F.size("w") > 0, F.greatest(F.size("w") - n + 1, F.lit(1))).otherwise(0)))
    rows = words.select(*keep, "w", "codes", "n_windows", F.posexplode_outer("codes").alias("at", "_c")) \
        .where(F.col("at") < F.col("n_windows"))
    code = [F.get("codes", F.col("at") + j) for j in range(n)]
    kind = [c.bitwiseAND(F.lit(7)) for c in code]
    rows = rows.select(
        *keep, "w", "n_windows", "at",
        *[c.bitwiseAND(F.lit(-8)).alias(f"_b{j}") for j, c in enumerate(code)],
        *[F.when(k.between(1, 3), k).alias(f"_s{j}") for j, k in enumerate(kind)],
        sum(F.when(k == 4, F.lit(1 << j)).otherwise(0) for j, k in enumerate(kind)).alias("_open"),
        sum(F.when(k.isin(0, 4), F.lit(1)).otherwise(0) for k in kind).alias("_literal"),
        F.least(F.lit(min(LITERALS, n)), F.size("w")).alias("_enough"))
    subsets = F.array(*[F.array(*[F.lit(m) for m in range(1 << n) if m & o == m]) for o in range(1 << n)])
    rows = rows.select("*", F.explode_outer(F.get(subsets, F.col("_open"))).alias("mask"))
    literal = F.col("_literal") - F.bit_count("mask")
    own = [F.when(F.getbit("mask", F.lit(j)) == 1, F.lit(2).cast("bigint")).otherwise(F.coalesce(f"_s{j}", f"_b{j}"))
           for j in range(n)]
    h = F.when(literal >= F.col("_enough"), F.xxhash64(*own)) \
        .otherwise(F.xxhash64(*[F.col(f"_b{j}") for j in range(n)], F.lit("own")))
    # only its own words go on with a window
    return (rows.where((F.col("mask") == 0) | (F.col("mask") == F.col("_open")) | (literal >= F.col("_enough")))
            .select(*keep, "n_windows", "at", "mask", h.alias("h"), F.slice("w", F.col("at") + 1, F.lit(n)).alias("ws")))


def matches(docs: DataFrame, items: DataFrame, n: int = WINDOW) -> DataFrame:
    """Window matches: _uid, doc_id, item, item_id, at (of the item), shift
    (the document's place less the item's), slots (pairs of the item's and the document's values). ``docs`` has _uid."""
    own = cut_lineage(
        windows(items.select("item_id", "text").withColumn("item", F.monotonically_increasing_id()), ["item", "item_id"], n)
        .withColumn("iw", retyped(F.col("ws"), F.col("mask"))).drop("ws", "mask"), "decon-items")
    texts = docs.select("_uid", "doc_id", "text")
    # a few lengths at most; a text of fewer words than n has its one window already
    short = [r[0] for r in own.where(F.size("iw").between(2, n - 1)).select(F.size("iw")).distinct().collect()]
    d = reduce(DataFrame.unionByName, [windows(texts, ["_uid", "doc_id"], k) for k in (n, *short)])
    # written before the words are compared: that expression would be drawn into
    # the join and take it, and every window before it, out of generated code
    d = cut_lineage(d.drop("n_windows").withColumnRenamed("at", "pos").join(broadcast_if_small(own), "h").drop("h"),
                    "decon-meets").withColumn("dw", retyped(F.col("ws"), F.col("mask")))
    pairs = F.filter(F.zip_with("iw", "dw", lambda i, x: F.struct(i.alias("i"), x.alias("d"))),
                     lambda p: is_slot(p["i"]))
    pairs = F.transform(pairs, lambda p: F.struct(F.translate(p["i"], SIGNS, "").alias("i"),
                                                  F.translate(p["d"], SIGNS, "").alias("d")))
    same = (template(F.col("iw")) == template(F.col("dw"))) | (bare(F.col("iw")) == bare(F.col("dw")))
    return (d.where(same)  # beyond the hash
            .select("_uid", "doc_id", "item", "item_id", "n_windows", "at", (F.col("pos") - F.col("at")).alias("shift"),
                    pairs.alias("slots")).distinct())


def contaminated(docs: DataFrame, items: DataFrame, n: int = WINDOW, coverage: float = COVERAGE) -> DataFrame:
    """A row for each (document, item) with the item in the document: _uid,
    doc_id, item_id, n_windows (of the item), n_matched, coverage, n_slots
    (distinct slot values), reparameterised (some slot has another value)."""
    # a place: shifts within half an item, in two rows of such places that overlap
    # by half, so that a copy with a few words more or less lies in one; 0: all
    span = F.greatest(F.lit(4), F.expr("n_windows div 2"))
    half = F.greatest(F.lit(2), F.expr("n_windows div 4"))
    places = F.array(*[F.struct(F.lit(k).alias("kind"), v.cast("bigint").alias("part")) for k, v in enumerate((
        F.lit(0), F.floor(F.col("shift") / span), F.floor((F.col("shift") + half) / span)))])
    found = cut_lineage(matches(docs, items, n).withColumn("place", F.explode(places)).drop("shift").distinct(),
                        "decon-matches")
    pair = ["_uid", "item", "place"]
    votes = (found.select(*pair, F.explode("slots").alias("s")).groupBy(*pair, "s.i", "s.d")
             .agg(F.count(F.lit(1)).alias("k")))
    # the value most windows give; of equally many the item's own, then the smallest
    best = votes.groupBy(*pair, "i").agg(F.min(F.struct(-F.col("k"), F.col("i") != F.col("d"), "d")).alias("b"))
    fill = best.groupBy(*pair).agg(F.map_from_entries(F.collect_list(F.struct("i", "b.d"))).alias("fill"),
                                   F.count(F.lit(1)).alias("n_slots"),
                                   F.max(F.col("i") != F.col("b.d")).alias("reparameterised"))
    fits = F.col("fill").isNull() | F.forall("slots", lambda s: F.col("fill")[s["i"]] == s["d"])
    hits = (found.join(fill, pair, "left").where(fits)
            .groupBy(*pair, "doc_id", "item_id", "n_windows", "n_slots", "reparameterised")
            .agg(F.count_distinct("at").alias("n_matched"))
            .withColumn("coverage", F.col("n_matched") / F.col("n_windows")))
    # the place with most of the item, one with its own values first
    best = F.min_by(F.struct("doc_id", "item_id", "n_windows", "n_matched", "coverage", "n_slots", "reparameterised"),
                    F.struct(-F.col("n_matched"), F.coalesce("reparameterised", F.lit(False)), "place"))
    hits = hits.groupBy("_uid", "item").agg(best.alias("best")).select("_uid", "best.*")
    return hits.where(F.col("coverage") >= coverage).select(
        "_uid", "doc_id", "item_id", "n_windows", "n_matched", "coverage",
        F.coalesce("n_slots", F.lit(0)).alias("n_slots"),
        F.coalesce("reparameterised", F.lit(False)).alias("reparameterised"))


def report(docs: DataFrame, items: DataFrame, n: int = WINDOW, coverage: float = COVERAGE) -> DataFrame:
    """``contaminated`` for rows of ``docs`` (doc_id, text), without row numbers."""
    rows = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("_uid"))
    return contaminated(rows, items, n, coverage).drop("_uid")


def decontaminate(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item."""
    rows, uid = numbered(docs, "decon-docs")
    bad = (contaminated(rows.select(col(uid).alias("_uid"), "doc_id", "text"), items)
           .select(F.col("_uid").alias(uid)).distinct())
    return rows.join(bad, uid, "left_anti").select(*[col(c) for c in docs.columns])
