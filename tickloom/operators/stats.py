"""Correlation, mutual information and the feature ranking built on them."""

from __future__ import annotations

import math
from functools import reduce
from itertools import combinations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame, Window, functions as F

from tickloom.operators.drift import bucket_of, cut_points, to_long
from tickloom.session import checkpointed

# Selection thresholds (fixed values).
CORR_THRESHOLD = 0.90
MI_THRESHOLD = 0.001


def correlation_pairs(df: DataFrame, columns: list[str], threshold: float = 0.0) -> DataFrame:
    """(feature_1, feature_2, correlation, abs_correlation) for every pair at or above the threshold.

    Over rows where all columns are known. The executors reduce the rows to one columns x columns
    matrix, and only that matrix reaches the driver. A constant column has no correlation and so no
    pairs.
    """
    ready = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).dropna()
    vectors = VectorAssembler(inputCols=columns, outputCol="v").transform(ready).select("v")
    matrix = Correlation.corr(vectors, "v", "pearson").first()[0].toArray()
    rows = [
        (a, b, float(matrix[i, j]))
        for (i, a), (j, b) in combinations(enumerate(columns), 2)
        if not math.isnan(matrix[i, j])
    ]
    table = df.sparkSession.createDataFrame(rows, "feature_1 STRING, feature_2 STRING, correlation DOUBLE")
    size = F.abs("correlation")
    return table.where(size >= threshold).withColumn("abs_correlation", size)


def mutual_information(
    df: DataFrame, columns: list[str], target: str, parts: int = 10, accuracy: int = 10000
) -> DataFrame:
    """Mutual information of each column with the target over equal-frequency bins, in nats.

    Two scans: cut points of all columns, then joint bin counts. The shuffle carries at most
    parts x parts rows per column and task.
    """
    complete = df.select(*columns, target).dropna()
    cuts = F.broadcast(cut_points(complete, columns, parts, accuracy))  # one row per column
    target_cuts = cut_points(complete, [target], parts, accuracy).select("cuts").scalar()
    values = to_long(complete.withColumn("_y", F.col(target).cast("double")), columns, ["_y"])
    joint = (
        values.join(cuts, "feature")
        .select(
            "feature",
            bucket_of(F.col("value"), F.col("cuts"), parts).alias("bx"),
            bucket_of(F.col("_y"), target_cuts, parts).alias("by"),
        )
        .groupBy("feature", "bx", "by")
        .agg(F.count("*").alias("n"))
    )
    # From here on there are at most parts^2 rows per column.
    share = lambda *by: F.sum("n").over(Window.partitionBy("feature", *by)).cast("double")
    total, nx, ny = share(), share("bx"), share("by")
    cells = joint.select("feature", (F.col("n") / total * F.ln(F.col("n") * total / (nx * ny))).alias("term"))
    return cells.groupBy("feature").agg(F.sum("term").alias("mi"))


def average_rank(score: Column, name: str) -> Column:
    """Descending rank where ties share their mean. Ranks a table with one row per feature."""
    ties = F.count("*").over(Window.partitionBy(score))
    return (F.rank().over(Window.orderBy(score.desc_nulls_last())) + (ties - 1) / 2.0).alias(name)


def rank_features(mi: DataFrame, importance: DataFrame) -> DataFrame:
    """Mean of the two ranks; lower is better. Both inputs hold one row per feature."""
    scores = mi.join(importance, "feature", "left")
    ranked = scores.select(
        "feature",
        "mi",
        "importance",
        average_rank(F.col("mi"), "rank_mi"),
        average_rank(F.col("importance"), "rank_importance"),
    )
    return ranked.withColumn("avg_rank", (F.col("rank_mi") + F.col("rank_importance")) / 2)


def collinear_losers(pairs: DataFrame, ranking: DataFrame, threshold: float = CORR_THRESHOLD) -> DataFrame:
    """(feature, at): the features to drop, each with the pair that drops it as an order value, worst pair first.

    Pairs are taken in descending correlation, then by name; of each the worse-ranked feature goes, unless the pair
    already lost one. The outcome of a pair depends only on stronger pairs that could drop one of its two features, so every
    round decides all pairs that no undecided stronger one of that kind touches, and then leaves out the pairs of dropped
    features. The strongest undecided pair is always among them, so the rounds end; their number is the longest chain of
    such dependences, not the number of pairs. Each round is a few aggregates and joins over the undecided pairs.
    """
    rank = ranking.select("feature", "avg_rank")
    first_wins = F.col("rank_1") <= F.col("rank_2")
    open_pairs = checkpointed(
        pairs.where(F.col("abs_correlation") >= threshold)
        .join(rank.toDF("feature_1", "rank_1"), "feature_1")
        .join(rank.toDF("feature_2", "rank_2"), "feature_2")
        .select(
            F.struct((-F.col("abs_correlation")).alias("o"), "feature_1", "feature_2").alias("at"),
            F.when(first_wins, F.col("feature_1")).otherwise(F.col("feature_2")).alias("winner"),
            F.when(first_wins, F.col("feature_2")).otherwise(F.col("feature_1")).alias("loser"),
        )
    )
    dropped = []
    while not open_pairs.isEmpty():
        # The strongest undecided pair that could drop each feature.
        threat = open_pairs.groupBy("loser").agg(F.min("at").alias("at"))
        strongest = open_pairs.join(threat, ["loser", "at"])
        of_winner = threat.select(F.col("loser").alias("winner"), F.col("at").alias("winner_at"))
        decided = strongest.join(of_winner, "winner", "left").where(F.col("winner_at").isNull() | (F.col("winner_at") > F.col("at")))
        gone = checkpointed(decided.select(F.col("loser").alias("feature"), "at"))
        dropped.append(gone)
        side = lambda name: gone.select(F.col("feature").alias(name), F.col("at").alias(f"{name}_gone"))
        left = open_pairs.join(side("winner"), "winner", "left").join(side("loser"), "loser", "left")
        alive = lambda name: F.col(f"{name}_gone").isNull() | (F.col(f"{name}_gone") > F.col("at"))
        open_pairs = checkpointed(left.where(alive("winner") & alive("loser")).select("at", "winner", "loser"))
    return reduce(DataFrame.unionByName, dropped, open_pairs.select(F.col("loser").alias("feature"), "at").limit(0))


def prune_collinear(pairs: DataFrame, ranking: DataFrame, threshold: float = CORR_THRESHOLD) -> DataFrame:
    """One row with the features to drop, worst pair first."""
    ordered = F.sort_array(F.collect_list(F.struct("at", "feature")))
    return collinear_losers(pairs, ranking, threshold).agg(F.transform(ordered, lambda x: x["feature"]).alias("dropped"))


def select_features(
    ranking: DataFrame, pairs: DataFrame, corr_threshold: float = CORR_THRESHOLD, mi_threshold: float = MI_THRESHOLD
) -> DataFrame:
    """The ranking with a ``decision`` per feature: keep, collinear or low_mi."""
    dropped = collinear_losers(pairs, ranking, corr_threshold).select("feature", F.lit(True).alias("_dropped"))
    decision = F.when(F.col("_dropped"), "collinear").when(F.col("mi") < mi_threshold, "low_mi").otherwise("keep")
    return ranking.join(dropped, "feature", "left").withColumn("decision", decision).drop("_dropped")
