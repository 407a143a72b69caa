"""Drift scores against a direct, looped definition; statistics and selection."""

import math
import random
from datetime import datetime, timedelta
from itertools import combinations

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tickloom.operators import drift as d
from tickloom.operators import stats


def frame(spark, reference, recent):
    end = datetime(2025, 3, 1)
    rows = [(end - timedelta(hours=200), float(v)) for v in reference] + [(end, float(v)) for v in recent]
    return spark.createDataFrame(rows, "open_time TIMESTAMP, v DOUBLE")


def scores(spark, reference, recent):
    w = d.label_windows(frame(spark, reference, recent), "open_time")
    return d.drift_scores(w, ["v"]).first()


def direct(reference, recent):
    ordered = sorted(reference)
    cuts = [ordered[max(math.ceil(len(ordered) * i / 10) - 1, 0)] for i in range(1, 10)]
    edges = [-math.inf, *cuts, math.inf]
    psi = 0.0
    for lo, hi in zip(edges, edges[1:]):
        share = lambda xs: max(sum(lo < x <= hi for x in xs) / len(xs), 1e-6)
        psi += (share(recent) - share(reference)) * math.log(share(recent) / share(reference))
    ks = max(abs(sum(x <= c for x in reference) / len(reference) - sum(x <= c for x in recent) / len(recent)) for c in cuts)
    return psi, ks


values = st.lists(st.integers(-20, 20), min_size=12, max_size=60)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(reference=values, recent=values)
def test_one_pass_equals_looped_definition(spark, reference, recent):
    got = scores(spark, reference, recent)
    psi, ks = direct(reference, recent)
    assert got.psi == pytest.approx(psi, abs=1e-9) and got.ks == pytest.approx(ks, abs=1e-9)
    assert 0 <= got.ks <= 1


def test_no_drift_between_equal_windows(spark):
    sample = [random.Random(3).gauss(0, 1) for _ in range(100)]
    got = scores(spark, sample, sample)
    assert got.psi == 0 and got.ks == 0


def test_empty_window_gives_null(spark):
    got = scores(spark, [1, 2, 3], [])
    assert got.psi is None or got.n_recent > 0


def test_window_bounds_exclude_the_lower_edge(spark):
    end = datetime(2025, 3, 1)
    at = [0, 167, 168, 169, 887, 888, 889]
    df = spark.createDataFrame([(end - timedelta(hours=h), h) for h in at], "open_time TIMESTAMP, h INT")
    got = {r.h: r.is_recent for r in d.label_windows(df, "open_time").collect()}
    assert got == {0: True, 167: True, 168: False, 169: False, 887: False}


def test_null_rates(spark):
    w = d.label_windows(frame(spark, [1], [1, 2]), "open_time").withColumn("x", F.when(F.col("v") > 1, F.col("v")))
    assert d.recent_null_rates(w, ["x"]).first().null_rate == 0.5
    assert d.recent_null_rates(w.where("not is_recent"), ["x"]).first().null_rate == 1.0


def test_average_ranks_share_ties(spark):
    mi = spark.createDataFrame([("a", 0.5), ("b", 0.5), ("c", 0.1)], "feature STRING, mi DOUBLE")
    imp = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 3.0)], "feature STRING, importance DOUBLE")
    got = {r.feature: (r.rank_mi, r.rank_importance, r.avg_rank) for r in stats.rank_features(mi, imp).collect()}
    assert got == {"a": (1.5, 3.0, 2.25), "b": (1.5, 2.0, 1.75), "c": (3.0, 1.0, 2.0)}


def test_greedy_pruning_skips_pairs_already_touched(spark):
    rank = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 3.0)], "feature STRING, avg_rank DOUBLE")
    pairs = spark.createDataFrame(
        [("a", "b", 0.99, 0.99), ("b", "c", -0.97, 0.97), ("a", "c", 0.5, 0.5)], "feature_1 STRING, feature_2 STRING, correlation DOUBLE, abs_correlation DOUBLE"
    )
    assert stats.prune_collinear(pairs, rank, 0.9).first().dropped == ["b"]  # (b, c) already lost b, so c stays
    assert stats.prune_collinear(pairs, rank, 0.999).first().dropped == []


@pytest.mark.parametrize("seed,names,share", [(1, 12, 0.9), (2, 40, 0.2), (3, 60, 1.0), (4, 25, 0.5)])
def test_pruning_in_rounds_equals_the_fold(spark, seed, names, share):
    rng = random.Random(seed)
    features = [f"f{i:02d}" for i in range(names)]
    rank = [(f, float(rng.randrange(names // 2))) for f in features]  # ties
    pairs = [(a, b, rng.choice([-1, 1]) * rng.choice([0.91, 0.95, 0.99, 0.5]), 0.0) for a, b in combinations(features, 2) if rng.random() < share]
    pairs = [(a, b, c, abs(c)) for a, b, c, _ in pairs]
    order, dropped = dict(rank), []
    for a, b, _, size in sorted(pairs, key=lambda p: (-p[3], p[0], p[1])):
        if size >= 0.9 and a not in dropped and b not in dropped:
            dropped.append(b if order[a] <= order[b] else a)
    ranking = spark.createDataFrame([(f, r, 0.5) for f, r in rank], "feature STRING, avg_rank DOUBLE, mi DOUBLE")
    table = spark.createDataFrame(pairs, "feature_1 STRING, feature_2 STRING, correlation DOUBLE, abs_correlation DOUBLE")
    assert stats.prune_collinear(table, ranking, 0.9).first().dropped == dropped
    decided = {r.feature: r.decision for r in stats.select_features(ranking, table, 0.9).collect()}
    assert decided == {f: "collinear" if f in dropped else "keep" for f in features}


def test_mutual_information_of_a_copy_is_the_bin_entropy(spark):
    df = spark.range(1000).select(F.col("id").cast("double").alias("x"), F.col("id").cast("double").alias("y"), F.lit(1.0).alias("c"))
    got = {r.feature: r.mi for r in stats.mutual_information(df, ["x", "c"], "y").collect()}
    assert got["x"] == pytest.approx(math.log(10), abs=0.02) and got["c"] == pytest.approx(0, abs=1e-12)


def test_correlation_pairs(spark):
    df = spark.range(200).select(F.rand(1).alias("a"), F.rand(2).alias("b"), F.lit(1.0).alias("c")).withColumn("d", F.col("a") * 2 + F.col("b")).cache()
    got = {(r.feature_1, r.feature_2): r.correlation for r in stats.correlation_pairs(df, ["a", "b", "c", "d"]).collect()}
    expected = {(x, y): df.agg(F.corr(x, y)).first()[0] for x, y in (("a", "b"), ("a", "d"), ("b", "d"))}
    assert got == pytest.approx(expected)  # the constant column has no pairs
    assert stats.correlation_pairs(df, ["a", "d"], 0.99).count() == 0
