"""Splits, folds, promotion, replay, models and scoring."""

import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tickloom import schemas
from tickloom.functions import scores
from tickloom.operators import govern as g
from tickloom.operators import models as m
from tickloom.operators import split as s
from tickloom.operators.evaluate import Candidate, common_keys, evaluate_models, evaluation_rows, fair_comparison
from tickloom.operators.predict import score_latest, to_close_and_return


def model_frame(spark, hours, n=200):
    rows = [("a", hours(i), float(i % 13), float(i % 5), (i % 13) * 2.0 + (i % 5)) for i in range(n)]
    return spark.createDataFrame(rows, "symbol STRING, open_time TIMESTAMP, x DOUBLE, z DOUBLE, y DOUBLE")


def test_temporal_split_keeps_order(spark, hours):
    df = spark.createDataFrame([("a", hours(i), float(i)) for i in range(10)], "symbol STRING, open_time TIMESTAMP, feature DOUBLE")
    got = {r.split: r.f for r in s.temporal_split(df, 1 - 0.2).groupBy("split").agg(F.sort_array(F.collect_list("feature")).alias("f")).collect()}
    assert got == {"train": [float(i) for i in range(8)], "test": [8.0, 9.0]}


@pytest.mark.parametrize("n, folds", [(10, 5), (11, 5), (23, 3)])
def test_folds_expand(spark, hours, n, folds):
    df = spark.createDataFrame([("a", hours(i), i) for i in range(n)], "symbol STRING, open_time TIMESTAMP, i INT")
    blocks = s.cv_blocks(df, folds)
    size = n // (folds + 1)
    for fold in range(folds):
        start = n - (folds - fold) * size
        assert sorted(r.i for r in s.fold_train(blocks, fold).collect()) == list(range(start))
        assert sorted(r.i for r in s.fold_validate(blocks, fold).collect()) == list(range(start, start + size))


def test_scores_by_hand(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 1.0), (4.0, 4.0), (0.0, 1.0)], "y DOUBLE, p DOUBLE")
    got = df.agg(*scores.standard_scores("y", "p", 1e-10)).first()
    assert got.rmse == pytest.approx(((0.25 + 1 + 0 + 1) / 4) ** 0.5) and got.mae == pytest.approx(2.5 / 4)
    assert got.r2 == pytest.approx(1 - 2.25 / sum((v - 1.75) ** 2 for v in (1, 2, 4, 0)))
    plain = df.where("y <> 0").agg(scores.mape("y", "p")).first()[0]
    assert plain == pytest.approx((0.5 + 0.5 + 0) / 3)
    both = df.agg(scores.share_true(scores.both_up_or_not("y", "p")), scores.share_true(scores.same_sign("y", "p"))).first()
    assert tuple(both) == (0.75, 0.75)


def test_best_candidate_breaks_ties(spark):
    rows = [
        ("r1", 1.0, 0.5, 0.50, "trained", "validated"), ("r2", 1.0, 0.5, 0.60, "trained", "validated"), ("r3", 0.1, 0.1, 0.9, "skipped", "validated"),
        ("r4", 0.1, 0.1, 0.9, "trained", "failed"), ("r5", 0.1, None, 0.9, "trained", "validated"),
    ]
    df = spark.createDataFrame(rows, "run_id STRING, rmse DOUBLE, mae DOUBLE, directional_accuracy DOUBLE, training_status STRING, dataset_replay_status STRING")
    assert g.best_candidate(df).first().run_id == "r2"


@pytest.mark.parametrize(
    "challenger, expected", [((0.9, 0.9, 0.5), True), ((0.9, 0.9, 0.4), False), ((1.0, 0.9, 0.9), False), ((0.9, 1.0, 0.9), False)]
)
def test_promotion_rule(spark, challenger, expected):
    names = "challenger_rmse DOUBLE, challenger_mae DOUBLE, challenger_directional_accuracy DOUBLE, champion_rmse DOUBLE, champion_mae DOUBLE, champion_directional_accuracy DOUBLE"
    df = spark.createDataFrame([(*challenger, 1.0, 1.0, 0.5)], names)
    assert g.promote(df).first().promote is expected
    assert g.promote(df, champion_exists=False).first().promote is True
    assert g.promote_if_lower_rmse(df).first().promote is (challenger[0] < 1.0)


def test_promotion_lock(spark):
    aliases = spark.createDataFrame([("m", "champion", "3"), ("n", "champion", "4")], "model_name STRING, alias STRING, version STRING")
    asked = spark.createDataFrame([("m", "3", "9", True), ("n", "3", "9", True), ("new", None, "1", True), ("m2", None, "2", False)], "model_name STRING, expected_version STRING, new_version STRING, promote BOOLEAN")
    got = {r.model_name: (r.promoted, r.lock_conflict, r.final_version) for r in g.promote_locked(asked, aliases).collect()}
    assert got == {"m": (True, False, "9"), "n": (False, True, "4"), "new": (True, False, "1"), "m2": (False, False, None)}


def test_fair_comparison_uses_common_newest_rows(spark, hours):
    mk = lambda lo, hi, p: spark.createDataFrame([(hours(i), "a", 1.0, p) for i in range(lo, hi)], "t TIMESTAMP, symbol STRING, actual DOUBLE, predicted DOUBLE")
    champion, challenger = mk(0, 50, 2.0), mk(30, 90, 1.5)
    assert common_keys(champion, challenger, ["t", "symbol"], None).count() == 20
    got = fair_comparison(champion, challenger, ["t", "symbol"], per_series=10, min_rows=11).first()
    assert (got.eval_rows, got.enough_rows, got.champion_rmse, got.challenger_mae) == (10, False, 1.0, 0.5)


def feature_table(spark, hours, series, n):
    rows = [(hours(i), f"s{k}", float(i), float(k) if i % 2 else None, 1.0) for k in range(series) for i in range(n)]
    return spark.createDataFrame(rows, "t TIMESTAMP, symbol STRING, y DOUBLE, x DOUBLE, z DOUBLE")


FIRST = Candidate(["x", "z"], lambda df: df.withColumn("prediction", F.col("y") + F.col("z")))
SECOND = Candidate(["z"], lambda df: df.withColumn("prediction", F.col("y") - 3 * F.col("z")))


@pytest.mark.parametrize("series", [1, 40])
def test_every_series_is_judged_over_the_same_span(spark, hours, series):
    rows = evaluation_rows(feature_table(spark, hours, series, 60), ["t", "symbol"], "y", ["x", "z"], 12)
    spans = {r.symbol: (r.n, r.first) for r in rows.groupBy("symbol").agg(F.count("*").alias("n"), F.min("t").alias("first")).collect()}
    assert len(spans) == series and set(spans.values()) == {(12, hours(37))}  # odd hours are complete: 37 to 59
    got = evaluate_models(feature_table(spark, hours, series, 60), ["t", "symbol"], "y", FIRST, SECOND, 12, 13).first()
    assert (got.eval_rows, got.enough_rows, got.champion_rmse, got.challenger_rmse) == (12 * series, series > 1, 1.0, 3.0)


def test_without_series_the_newest_rows_are_judged(spark, hours):
    one = feature_table(spark, hours, 1, 60).drop("symbol")
    assert evaluate_models(one, ["t"], "y", FIRST, SECOND, 7).first().eval_rows == 7
    assert evaluate_models(one.limit(0), ["t"], "y", FIRST, SECOND).first().enough_rows is False


def test_evaluation_refuses_repeated_keys_and_missing_columns(spark, hours):
    table = feature_table(spark, hours, 2, 10)
    with pytest.raises(ValueError, match="unique keys"):
        evaluate_models(table.unionByName(table.limit(1)), ["t", "symbol"], "y", FIRST, SECOND)
    with pytest.raises(ValueError, match="missing: .*'w'"):
        evaluate_models(table, ["t", "symbol"], "y", Candidate(["w"], FIRST.scorer), SECOND)


def test_long_series_are_limited_before_the_shuffle(spark, hours):
    rows = evaluation_rows(feature_table(spark, hours, 2, 10), ["t", "symbol"], "y", ["x", "z"], 3)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_manifest_and_replay(spark, hours):
    split = s.temporal_split(model_frame(spark, hours, 50))
    run = {"run_id": "r", "model_algo": "gbt", "raw_table": "raw", "raw_table_version": 1, "features_table": "f", "features_table_version": 1}
    manifest = g.dataset_manifest(split, run, ["x", "z"], "y", 0.8, datetime(2025, 1, 1))
    assert set(manifest.columns) <= set(schemas.struct_of(schemas.MANIFEST).names)
    assert all(r.passed for r in g.replay_checks(split, manifest, ["open_time", "symbol"]).collect())
    doubled = g.replay_checks(split.unionByName(split.limit(1)), manifest, ["open_time", "symbol"])
    assert {r.check_name for r in doubled.where("not passed").collect()} >= {"row_count", "duplicate_keys"}


def test_feature_list_resolution(spark):
    rows = lambda *r: spark.createDataFrame(list(r), "run_id STRING, created_at INT, feature_cols_json STRING")
    sources = {"manifest": rows(("a", 1, '["x"]'), ("a", 2, '["x","y"]')), "artifact": rows(("b", 1, '["z"]')), "active_config": rows(("a", 9, '["q"]'), ("c", 1, '["w"]'))}
    got = {r.run_id: (r.feature_cols_source, r.n_features) for r in g.resolve_feature_columns(sources).collect()}
    assert got == {"a": ("manifest", 2), "b": ("artifact", 1), "c": ("active_config", 1)}
    assert g.resolve_feature_columns(sources, allow_active=False).count() == 2


def test_promotion_history_layout(spark):
    row = spark.createDataFrame([("r", 5, 5, True)], "challenger_run_id STRING, challenger_eval_rows INT, champion_eval_rows INT, promoted BOOLEAN")
    assert g.promotion_history(row, datetime(2025, 1, 1)).columns == schemas.struct_of(schemas.PROMOTIONS).names


def test_score_latest_row_of_each_series(spark, hours):
    df = spark.createDataFrame(
        [("a", hours(0), 10.0, 0.1), ("a", hours(1), 20.0, 0.2), ("a", hours(2), 30.0, None), ("b", hours(0), 5.0, 0.5)], "symbol STRING, open_time TIMESTAMP, close DOUBLE, x DOUBLE"
    )
    out = score_latest(df, ["x"], lambda d: d.withColumn("prediction", F.col("x")), "target_return_1h", {"model_uri": "m"}, hours(9))
    got = {r.symbol: (r.feature_open_time, r.predicted_close, r.predicted_return_1h) for r in out.collect()}
    assert got == {"a": (hours(1), 24.0, 0.2), "b": (hours(0), 7.5, 0.5)}
    assert out.columns == ["symbol", *schemas.struct_of(schemas.PREDICTIONS).names]
    with pytest.raises(ValueError):
        to_close_and_return(df, "target_up")


def test_models_learn_and_explain(spark, hours):
    df = model_frame(spark, hours).withColumn("noise", F.lit(1.0)).cache()
    cols = ["x", "z", "noise"]
    forest = m.train(df, cols, "y", "random_forest", {"numTrees": 10, "maxDepth": 8})
    assert m.predict(forest, df, cols).agg(scores.rmse("y", "prediction")).first()[0] < 2
    importance = {r.feature: r.importance for r in m.built_in_importance(forest, spark, cols).collect()}
    assert importance["x"] > importance["z"] > importance["noise"]
    parts = m.permutation_contributions(forest, df, cols, ["open_time", "symbol"])
    got = {r.feature: r for r in parts.collect()}
    assert got["noise"].mean_abs_shap == 0 and got["x"].mean_abs_shap > got["z"].mean_abs_shap and got["x"].sample_rows == 200
    # Only features x tasks are shuffled after scoring, and the values are those of single swaps.
    plan = parts.select("*")._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning\(j", plan)) == 1 and "Aggregate(keys=[row_idx" not in plan
    flat = df.orderBy("open_time", "symbol").collect()
    half = len(flat) // 2
    swapped = [(r.x, flat[(i - half) % len(flat)].z, r.noise, i) for i, r in enumerate(flat)]
    both = [{r.i: r.prediction for r in m.predict(forest, spark.createDataFrame(rows, "x DOUBLE, z DOUBLE, noise DOUBLE, i INT"), cols).collect()} for rows in (swapped, [(r.x, r.z, r.noise, i) for i, r in enumerate(flat)])]
    assert got["z"].mean_abs_shap == pytest.approx(sum(abs(both[1][i] - both[0][i]) for i in both[0]) / len(flat))
    rows = m.explanation_rows(m.built_in_importance(forest, spark, cols), parts, "r", "random_forest", {"feature_config_id": 7}, datetime(2025, 1, 1))
    assert rows.count() == 6 and rows.columns == schemas.struct_of(schemas.EXPLANATIONS).names


def test_search_reports_every_trial(spark, hours):
    blocks = s.cv_blocks(model_frame(spark, hours, 60), folds=2)
    trials = m.grid(numTrees=[3], maxDepth=[1, 4])
    got = m.search(blocks, ["x", "z"], "y", "random_forest", trials, folds=2).orderBy("trial_number").collect()
    assert len(got) == 2 and got[1].cv_rmse < got[0].cv_rmse
    assert [r.folds_done for r in got] == [2, 2] and m.best_trial(spark.createDataFrame(got)) == 1
    assert m.sample_params("gbt", 3) == m.sample_params("gbt", 3)
    assert all(0.01 <= p["stepSize"] <= 0.3 for p in m.sample_params("gbt", 20))


def test_search_gives_up_poor_trials_in_any_order_of_ends(spark, hours):
    blocks = s.cv_blocks(model_frame(spark, hours, 60), folds=3)
    trials = m.grid(numTrees=[3], maxDepth=[1, 2, 3, 4, 5])
    runs = [m.search(blocks, ["x", "z"], "y", "random_forest", trials, 3, parallel, prune_above=2).collect() for parallel in (1, 4)]
    assert runs[0] == runs[1]
    done = [r.folds_done for r in runs[0]]
    assert len(done) == 5 and done.count(3) == 2 and min(done) == 1
    assert all((r.cv_rmse is None) == (r.folds_done < 3) for r in runs[0])
    best = m.best_trial(spark.createDataFrame(runs[0], "trial_number INT, model_algo STRING, params MAP<STRING, DOUBLE>, cv_rmse DOUBLE, folds_done INT"))
    frame = model_frame(spark, hours, 60)
    _, scored = m.refit(frame, frame, ["x", "z"], "y", "random_forest", trials[best])
    assert scored.count() == 60 and "prediction" in scored.columns
    assert m.best_trial(spark.createDataFrame([], "trial_number INT, cv_rmse DOUBLE")) is None
