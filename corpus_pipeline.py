"""Corpus pipeline: ``documents`` to token ids, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``documents``. ``run`` writes each stage's result to
the shared checkpoint folder as Parquet and rereads it as the next one's input.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tidepool.llm import decontaminate, mixing, ngram_join, token_planes, toxicity
from tidepool.llm.queries import MIX_EPOCHS, MIX_SHARE, MIX_WEIGHTS, default_tokenizer
from tidepool.session import intermediates, release_shuffles, scratch_path


NEAR = ngram_join.Rule(words=5, num=80)  # op7_ngram_join has a rule of its own


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine doesn't call toxic."""
    return toxicity.reject_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of the n-gram Jaccard join: 0.8 of the
    five-word shingles."""
    return ngram_join.dedup(docs, rule=NEAR)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated, kept or cut to each source's token budget."""
    return mixing.mix(docs, MIX_WEIGHTS, MIX_SHARE, MIX_EPOCHS)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids written in planes; a row for each document, read back."""
    path = token_planes.write_planes(docs, default_tokenizer())
    return token_planes.digests(token_planes.read_documents(spark, path))


STAGES = [
    ("toxicity", reject_toxic),
    ("ngram_join", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token_output", write_tokens),
]

# A trained model and a tokenizer aren't SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        if k == len(STAGES) - 1:
            return stage(spark, docs, sf_dir)
        path = scratch_path(spark, f"pipeline-{name}-{uuid.uuid4().hex}")
        with intermediates(spark):  # what a stage wrote on its way goes once its result is written
            stage(spark, docs, sf_dir).write.parquet(path)
        release_shuffles(spark)
        docs = spark.read.parquet(path)
