"""Model governance: manifests, replay checks, candidate choice, promotion and its history."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.schemas import MANIFEST, PROMOTIONS, conform


def best_candidate(candidates: DataFrame, by=()) -> DataFrame:
    """Lowest rmse among trained and replay-validated runs; mae, then higher direction accuracy break ties.

    An aggregate, so it works per group (``by``) as well as over all candidates.
    """
    eligible = candidates.where(
        (F.col("training_status") == "trained")
        & (F.col("dataset_replay_status") == "validated")
        & F.col("rmse").isNotNull()
        & F.col("mae").isNotNull()
        & F.col("directional_accuracy").isNotNull()
    )
    merit = F.struct("rmse", "mae", (-F.col("directional_accuracy")).alias("d"), "run_id")
    rest = [c for c in candidates.columns if c not in by]
    return eligible.groupBy(*by).agg(F.min_by(F.struct(*rest), merit).alias("best")).select(*by, "best.*")


def promote(metrics: DataFrame, champion_exists: Column | bool = True) -> DataFrame:
    """Add ``promote``: better rmse and mae and no worse direction; the first model always."""
    exists = champion_exists if isinstance(champion_exists, Column) else F.lit(champion_exists)
    c = F.col
    better = (
        (c("challenger_rmse") < c("champion_rmse"))
        & (c("challenger_mae") < c("champion_mae"))
        & (c("challenger_directional_accuracy") >= c("champion_directional_accuracy"))
    )
    return metrics.withColumn("promote", F.when(~exists, True).otherwise(F.coalesce(better, F.lit(False))))


def promote_if_lower_rmse(metrics: DataFrame) -> DataFrame:
    """The simple rule: lower rmse wins; no champion means promote."""
    lower = F.col("challenger_rmse") < F.col("champion_rmse")
    return metrics.withColumn(
        "promote", F.when(F.col("champion_rmse").isNull(), True).otherwise(F.coalesce(lower, F.lit(False)))
    )


def promote_locked(requests: DataFrame, aliases: DataFrame, alias: str = "champion") -> DataFrame:
    """Apply promotion requests only where the alias still points where the evaluation saw it.

    ``requests``: model_name, expected_version, new_version, promote. ``aliases``: model_name, alias,
    version. Adds current_version, promoted, lock_conflict and the version the alias ends at.
    """
    now = aliases.where(F.col("alias") == alias).select("model_name", F.col("version").alias("current_version"))
    unchanged = F.col("current_version").eqNullSafe(F.col("expected_version"))
    joined = requests.join(now, "model_name", "left")
    done = F.col("promote") & unchanged
    return joined.withColumns(
        {
            "promoted": done,
            "lock_conflict": F.col("promote") & ~unchanged,
            "final_version": F.when(done, F.col("new_version")).otherwise(F.col("current_version")),
        }
    )


def promotion_history(evaluations: DataFrame, evaluated_at) -> DataFrame:
    """Evaluation rows in the promotion-history layout."""
    return conform(evaluations.withColumn("evaluated_at", F.lit(evaluated_at)), PROMOTIONS)


def dataset_manifest(
    split: DataFrame,
    run: dict,
    feature_cols: list[str],
    target_col: str,
    fraction: float,
    created_at,
    time: str = "open_time",
) -> DataFrame:
    """One manifest row from a labelled split: bounds and sizes of both parts in one aggregate.

    ``run`` names the run, its algorithm, source tables and their versions.
    """
    part = lambda name: F.when(F.col("split") == name, F.col(time))
    measured = split.agg(
        F.min(part("train")).alias("train_start_time"),
        F.max(part("train")).alias("train_end_time"),
        F.min(part("test")).alias("test_start_time"),
        F.max(part("test")).alias("test_end_time"),
        F.count_if(F.col("split") == "train").alias("train_rows"),
        F.count_if(F.col("split") == "test").alias("test_rows"),
    )
    facts = {
        **run,
        "target_col": target_col,
        "train_fraction": float(fraction),
        "n_features": len(feature_cols),
        "feature_cols_json": json.dumps(feature_cols),
        "created_at": created_at,
    }
    return measured.withColumns(
        {**{k: F.lit(v) for k, v in facts.items()}, "split_idx": F.col("train_rows")}
    ).select(*[name for name in _names(MANIFEST)if name in {*facts, *measured.columns, "split_idx"}])


def _names(ddl: str) -> list[str]:
    from tickloom.schemas import struct_of

    return struct_of(ddl).names


def replay_checks(split: DataFrame, manifest: DataFrame, keys: list[str], time: str = "open_time") -> DataFrame:
    """Compare a rebuilt, labelled split with its manifest: one row (check_name, expected, actual, passed).

    Repeated keys are counted before the split facts are taken, so one shuffle by key serves both.
    Times compare to the microsecond.
    """
    per_key = split.groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.count_if(F.col("split") == "train").alias("n_train"),
        *[F.min(F.when(F.col("split") == s, F.col(time))).alias(f"min_{s}") for s in ("train", "test")],
        *[F.max(F.when(F.col("split") == s, F.col(time))).alias(f"max_{s}") for s in ("train", "test")],
    )
    seen = per_key.agg(
        F.sum("n").alias("rows"),
        F.count_if(F.col("n") > 1).alias("duplicates"),
        F.sum("n_train").alias("train"),
        *[F.min(f"min_{s}").alias(f"min_{s}") for s in ("train", "test")],
        *[F.max(f"max_{s}").alias(f"max_{s}") for s in ("train", "test")],
    )
    micros = lambda c: F.unix_micros(c.cast("timestamp"))
    want = manifest.select(F.struct(*manifest.columns)).scalar()
    count = F.col
    checks = [
        ("row_count", want["train_rows"] + want["test_rows"], count("rows")),
        ("duplicate_keys", F.lit(0), count("duplicates")),
        ("split_idx", F.coalesce(want["split_idx"], F.floor(count("rows") * want["train_fraction"])), count("train")),
        ("train_rows", want["train_rows"], count("train")),
        ("test_rows", want["test_rows"], count("rows") - count("train")),
        ("train_start_time", micros(want["train_start_time"]), micros(count("min_train"))),
        ("train_end_time", micros(want["train_end_time"]), micros(count("max_train"))),
        ("test_start_time", micros(want["test_start_time"]), micros(count("min_test"))),
        ("test_end_time", micros(want["test_end_time"]), micros(count("max_test"))),
        (
            "n_features",
            want["n_features"],
            F.size(F.from_json(want["feature_cols_json"], "array<string>")),
        ),
    ]
    rows = [
        F.struct(
            F.lit(name).alias("check_name"),
            expected.cast("bigint").alias("expected"),
            actual.cast("bigint").alias("actual"),
            expected.cast("bigint").eqNullSafe(actual.cast("bigint")).alias("passed"),
        )
        for name, expected, actual in checks
    ]
    return seen.select(F.inline(F.array(*rows)))


# Where a run's feature list may come from, best first (fixed values).
FEATURE_SOURCES = ("artifact", "manifest", "versioned_config", "active_config")


def resolve_feature_columns(candidates: dict[str, DataFrame], allow_active: bool = True) -> DataFrame:
    """The feature list of each run from the best source that has one.

    ``candidates`` maps a source name to (run_id, created_at, feature_cols_json); inside a source the
    newest row wins. An aggregate over run_id, not a chain of look-ups.
    """
    ranked = None
    for priority, name in enumerate(FEATURE_SOURCES):
        if name not in candidates or (name == "active_config" and not allow_active):
            continue
        rows = candidates[name].where(F.col("feature_cols_json").isNotNull()).select(
            "run_id",
            F.lit(priority).alias("priority"),
            F.lit(name).alias("feature_cols_source"),
            "created_at",
            "feature_cols_json",
        )
        ranked = rows if ranked is None else ranked.unionByName(rows)
    if ranked is None:
        raise ValueError("no candidate source given")
    order = F.struct((-F.col("priority")).alias("p"), "created_at", "feature_cols_json")
    best = ranked.groupBy("run_id").agg(
        F.max_by(F.struct("feature_cols_source", "feature_cols_json"), order).alias("best")
    )
    return best.select(
        "run_id",
        "best.feature_cols_source",
        "best.feature_cols_json",
        F.size(F.from_json("best.feature_cols_json", "array<string>")).alias("n_features"),
    )


def selection_config(
    decided: DataFrame, config_id: int, created_at: str, source_table: str, source_version: int, target_col: str,
    corr_threshold: float, mi_threshold: float, pairs: DataFrame | None = None, candidates: list[str] | None = None, top: int = 20, top_pairs: int = 50,
) -> DataFrame:
    """One config row from the per-feature decisions (a table with one row per feature).

    Kept and candidate features stand in the order of ``candidates``, which is the order of a model's inputs (by
    name without it); dropped ones by name.
    """
    keep = F.col("decision") == "keep"
    place = F.array_position(F.array(*map(F.lit, candidates)), F.col("feature")) if candidates else F.lit(0)
    ordered = lambda cond, at: F.to_json(F.transform(F.sort_array(F.collect_list(F.when(cond, F.struct(at.alias("at"), "feature")))), lambda x: x["feature"]))
    by_mi = F.sort_array(F.collect_list(F.struct("mi", "feature")), asc=False)
    by_importance = F.sort_array(F.collect_list(F.struct("importance", "feature")), asc=False)
    metrics = {"top_mi_features": F.slice(by_mi, 1, top), "top_importance_features": F.slice(by_importance, 1, top)}
    if pairs is not None:
        strong = pairs.agg(
            F.sort_array(
                F.collect_list(
                    F.when(
                        F.col("abs_correlation") >= corr_threshold,
                        F.struct("abs_correlation", "feature_1", "feature_2"),
                    )
                ),
                asc=False,
            )
        ).scalar()
        metrics["high_corr_pairs"] = F.slice(strong, 1, top_pairs)
    return decided.agg(
        ordered(keep, place).alias("config_value"),
        F.count_if(keep).alias("n_features"),
        ordered(F.lit(True), place).alias("candidate_features_json"),
        ordered(~keep, F.lit(0)).alias("dropped_features_json"),
        F.to_json(F.struct(*[v.alias(k) for k, v in metrics.items()])).alias("selection_metrics_json"),
    ).select(
        F.lit("selected_features").alias("config_key"),
        "config_value",
        F.lit(config_id).cast("bigint").alias("config_id"),
        F.lit(config_id).cast("bigint").alias("config_version"),
        F.lit(created_at).alias("created_at"),
        F.lit("feature_selection").alias("created_by"),
        F.lit(True).alias("is_active"),
        "n_features",
        F.lit("eda_auto_selection").alias("method"),
        F.lit(source_table).alias("source_table"),
        F.lit(source_version).cast("bigint").alias("source_table_version"),
        F.lit(target_col).alias("target_col"),
        "candidate_features_json",
        "dropped_features_json",
        "selection_metrics_json",
        F.lit(float(corr_threshold)).alias("corr_threshold"),
        F.lit(float(mi_threshold)).alias("mi_threshold"),
    )


def active_configs(configs: DataFrame) -> DataFrame:
    """The newest active config row of every key, in one aggregate."""
    newest = F.max_by(F.struct(*configs.columns), F.struct("created_at", "config_id"))
    return configs.where("is_active").groupBy("config_key").agg(newest.alias("c")).select("c.*")


def active_config(configs: DataFrame, key: str = "selected_features") -> DataFrame:
    """The newest active config row of a key."""
    return active_configs(configs.where(F.col("config_key") == key))
