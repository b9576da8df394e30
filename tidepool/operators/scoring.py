"""Two-level outcome scoring.

Plays ``(round, p1, p2)`` are scored through a 9-entry table (G1), shares
per round are one aggregation (G2), and the rounds are counted by which
side had the larger share (G3). Both levels are ``groupBy`` with map-side
partial aggregation, so a round holding a third of all plays is combined
on every map task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the score of a play (p1, p2); -1 = the first side wins,
# 1 = the second side wins, 0 = draw.
SCORE_TABLE = {
    (0, 0): 0, (0, 1): 1, (0, 2): -1,
    (1, 0): -1, (1, 1): 0, (1, 2): 1,
    (2, 0): 1, (2, 1): -1, (2, 2): 0,
}


def score_frame(spark: SparkSession, table: dict | None = None) -> DataFrame:
    rows = sorted((table or SCORE_TABLE).items())
    return spark.createDataFrame([(a, b, s) for (a, b), s in rows],
                                 T.StructType([T.StructField("p1", T.IntegerType()),
                                               T.StructField("p2", T.IntegerType()),
                                               T.StructField("score", T.IntegerType())]))


def outcome_score(plays: DataFrame, table: dict | None = None) -> DataFrame:
    """G1: plays with their score. The score table is a fixed 9-row frame,
    broadcast (its size is bounded by construction). Pairs not in the table
    get NULL."""
    scores = F.broadcast(score_frame(plays.sparkSession, table))
    return plays.join(scores, ["p1", "p2"], "left")


def round_shares(scored: DataFrame, round_col: str = "round") -> DataFrame:
    """Per round, share of first-side wins, second-side wins and draws."""
    n = F.count(F.lit(1))
    return (scored.groupBy(round_col)
            .agg((F.count_if(F.col("score") == -1) / n).alias("first_share"),
                 (F.count_if(F.col("score") == 1) / n).alias("second_share"),
                 (F.count_if(F.col("score") == 0) / n).alias("draw_share"),
                 n.alias("plays")))


def round_winners(shares: DataFrame) -> DataFrame:
    """Rounds won by each side; equal shares count for nobody."""
    return shares.agg(
        F.count_if(F.col("first_share") > F.col("second_share")).alias("first_wins"),
        F.count_if(F.col("first_share") < F.col("second_share")).alias("second_wins"),
        F.count(F.lit(1)).alias("rounds"))
