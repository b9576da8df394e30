"""Mixing sources to target weights.

Each row gets a hash-random key (md5 of seed and doc_id, so reruns agree).
Rows are range-sorted by (source, key) and a distributed prefix sum of token
counts says how many tokens of the source come before each row. With a budget
of B tokens and S tokens in the source, every row is taken B // S times whole
and the rows up to token B % S once more; the row on the cut is taken in part,
so a source's taken tokens are exactly its budget. DataFrame functions only.

Defined cases: a null source is one source of its own; a null or blank text
has size 0 and is never taken; rows with equal doc_id share a key and are
ordered by text; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import SPACE, WORD, col, free_names, numbered, running_sum, word_array

SEED = "mix-1"


def random_key(doc_id: Column, seed: str = SEED) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def cyclic_weights(sources: DataFrame, weights: list[float]) -> DataFrame:
    """Weights given in turn to the sources by code point, null last. One row
    per source, so the ordering window holds source names only."""
    w = Window.orderBy(F.col("_none"), F.col("_src"))
    turn = F.pmod(F.row_number().over(w) - 1, F.lit(len(weights)))
    return sources.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), turn + 1).cast("double"))


def targets(sources: DataFrame, share: float, max_epochs: float) -> DataFrame:
    """Adds ``target`` to ``sources`` (weight, source_size): ``share`` of all
    sizes dealt by weight, no source above ``max_epochs`` times its size, the
    excess dealt again by weight until none is above.

    The end of that dealing is a water level: sources in order of
    cap / weight, each capped while its cap lies below the level that the
    sources from it on would share. Prefix sums over the sources find it.
    """
    cap = (F.col("source_size") * F.lit(max_epochs)).cast("double")
    order = Window.orderBy("_ratio", "_none", "_src")
    before, whole = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    turn = (sources.withColumn("_cap", cap).withColumn("_ratio", F.col("_cap") / F.col("weight"))
            .withColumn("_turn", F.row_number().over(order))
            .withColumn("_total", F.sum("source_size").over(whole).cast("double") * F.lit(share))
            .withColumn("_weights", F.sum("weight").over(whole))
            .withColumn("_capped", F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
            .withColumn("_used", F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
            # the level if every source before this one is capped and none from it on
            .withColumn("_level", (F.col("_total") - F.col("_capped")) / (F.col("_weights") - F.col("_used"))))
    # the first source that lies above its level sets it; none: all are capped
    stop = F.min(F.when(F.col("_ratio") >= F.col("_level"), F.struct("_turn", "_level"))).over(whole)
    return (turn.withColumn("_stop", stop)
            .withColumn("target", F.when(F.col("_stop").isNull() | (F.col("_turn") < F.col("_stop._turn")),
                                         F.col("_cap")).otherwise(F.col("_stop._level") * F.col("weight")))
            .select(*sources.columns, "target"))


def mix_plan(docs: DataFrame, weights: list[float], share: float, max_epochs: float,
             text: str = "text", source: str = "source", doc_id: str = "doc_id",
             seed: str = SEED, carry: tuple[str, ...] = ()) -> DataFrame:
    """Per row: doc_id, size, source_size, target, taken, ``epochs`` (whole
    takes), ``part`` (words of one more take), and the ``carry`` columns."""
    rows = cut_lineage(docs.select(
        col(doc_id).alias("doc_id"), F.coalesce(col(source), F.lit("")).alias("_src"),
        col(source).isNull().cast("int").alias("_none"), random_key(col(doc_id), seed).alias("_key"),
        F.size(word_array(col(text))).cast("long").alias("size"), F.xxhash64(col(text)).alias("_tie"),
        *[col(x) for x in carry]), "mix-rows")
    sources = rows.groupBy("_none", "_src").agg(F.sum("size").alias("source_size"))
    plan = cut_lineage(targets(cyclic_weights(sources, weights), share, max_epochs), "mix-targets")
    ranked = running_sum(rows, ["_none", "_src"], ["_key", "doc_id", "_tie"], "size", "_before", "mix")
    budget, whole = F.floor(F.col("target")), F.col("source_size")
    epochs = F.when(whole > 0, F.floor(budget / whole)).otherwise(F.lit(0)).cast("long")
    part = F.greatest(F.lit(0), F.least(F.col("size"), budget - F.col("epochs") * whole - F.col("_before")))
    return (ranked.join(plan, ["_none", "_src"])
            .withColumn("epochs", epochs).withColumn("part", part.cast("long"))
            .select("doc_id", "size", "source_size", "target",
                    (F.col("epochs") * F.col("size") + F.col("part")).alias("taken"), "epochs", "part", *carry))


def mix(docs: DataFrame, weights: list[float], share: float, max_epochs: float,
        text: str = "text", source: str = "source", doc_id: str = "doc_id", seed: str = SEED) -> DataFrame:
    """The mixed rows themselves, with the columns of ``docs``: a row stands
    there once for each whole take and once more, cut after ``part`` words,
    for a partial take (``n_chars``, if there, follows a cut text)."""
    rows, uid = numbered(docs, "mix-docs")
    words = free_names(rows, "_words")[0]
    plan = mix_plan(rows, weights, share, max_epochs, text, source, doc_id, seed, carry=(uid,))
    takes = plan.where("taken > 0").select(uid, F.explode(F.concat(
        F.array_repeat(F.lit(None).cast("long"), F.col("epochs").cast("int")),
        F.when(F.col("part") > 0, F.array(F.when(F.col("part") < F.col("size"), F.col("part"))))
        .otherwise(F.array().cast("array<long>")))).alias(words))
    pieces = F.regexp_extract_all(col(text), F.lit(rf"([{SPACE}]*{WORD})"), 1)
    first = F.array_join(F.slice(pieces, F.lit(1), F.col(words).cast("int")), "")
    out = rows.join(takes, uid).withColumn(text, F.when(F.col(words).isNull(), col(text)).otherwise(first))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(words).isNull(), F.col("n_chars"))
                             .otherwise(F.length(col(text))).cast(docs.schema["n_chars"].dataType))
    return out.select(*[col(c) for c in docs.columns])
