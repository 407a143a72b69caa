"""Tree models with MLlib: training, search over expanding folds, importances, explanations."""

from __future__ import annotations

import itertools
import random
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml import Model
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame, functions as F

from tickloom.functions import scores
from tickloom.operators.split import fold_train, fold_validate
from tickloom.operators.windows import stored_row_index
from tickloom.schemas import EXPLANATIONS, conform
from tickloom.session import checkpointed

SEED = 42  # fixed value

# Search ranges by algorithm, name -> (kind, low, high), as far as MLlib's trees have the parameter.
SEARCH_SPACES = {
    "gbt": {
        "maxIter": ("int", 100, 1000),
        "maxDepth": ("int", 3, 12),
        "stepSize": ("log", 0.01, 0.3),
        "subsamplingRate": ("float", 0.6, 1.0),
        "minInstancesPerNode": ("int", 1, 20),
    },
    "random_forest": {
        "numTrees": ("int", 50, 300),
        "maxDepth": ("int", 3, 15),
        "minInstancesPerNode": ("int", 2, 20),
    },
}


def assemble(df: DataFrame, feature_cols: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=feature_cols, outputCol="features").transform(df)


def estimator(algo: str, target: str, params: dict | None = None):
    shared = {"featuresCol": "features", "labelCol": target, "seed": SEED}
    if algo == "random_forest":
        # Every split may use every feature, as in the baseline this stands for.
        defaults = {"numTrees": 100, "maxDepth": 10, "featureSubsetStrategy": "all"}
        return RandomForestRegressor(**{**shared, **defaults, **(params or {})})
    if algo == "gbt":
        return GBTRegressor(**{**shared, "maxIter": 20, "maxDepth": 6, **(params or {})})
    raise ValueError(f"unknown algorithm: {algo}")


def train(df: DataFrame, feature_cols: list[str], target: str, algo: str, params: dict | None = None) -> Model:
    return estimator(algo, target, params).fit(assemble(df, feature_cols))


def predict(model: Model, df: DataFrame, feature_cols: list[str]) -> DataFrame:
    return model.transform(assemble(df, feature_cols)).drop("features")


def sample_params(algo: str, trials: int, seed: int = SEED) -> list[dict]:
    """A reproducible random sample of the search space."""
    rng = random.Random(seed)
    draw = {
        "int": lambda lo, hi: rng.randint(lo, hi),
        "float": lambda lo, hi: rng.uniform(lo, hi),
        "log": lambda lo, hi: lo * (hi / lo) ** rng.random(),
    }
    space = SEARCH_SPACES[algo]
    return [{name: draw[kind](lo, hi) for name, (kind, lo, hi) in space.items()} for _ in range(trials)]


def _prune(errors: dict[int, list[float | None]], at_least: int) -> list[int]:
    """The trials that go on: with more than ``at_least`` of them, those no worse than the median of the running means."""
    if len(errors) <= at_least:
        return list(errors)
    means = {n: sum(e for e in es if e is not None) / max(1, sum(e is not None for e in es)) for n, es in errors.items()}
    middle = sorted(means.values())[(len(means) - 1) // 2]
    return [n for n in errors if means[n] <= middle]


def search(
    blocks: DataFrame,
    feature_cols: list[str],
    target: str,
    algo: str,
    trials: list[dict],
    folds: int = 5,
    parallel: int = 4,
    prune_above: int = 4,
) -> DataFrame:
    """Mean validation rmse per trial over expanding folds; one row per trial.

    ``blocks`` carries ``cv_block``. The assembled rows are checkpointed once and every fit reads them. Fits are
    distributed jobs; ``parallel`` of them run at a time, each in a pool of its own where the scheduler is fair. Fold by fold, the worse
    half of more than ``prune_above`` trials is given up, which does not depend on the order in which fits end. A trial that was
    given up has fewer ``folds_done`` and no ``cv_rmse``.
    """
    spark = blocks.sparkSession
    ready = checkpointed(assemble(blocks, feature_cols).select("features", target, "cv_block"))

    def fold_error(number: int, fold: int) -> float | None:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"trial-{number % parallel}")
        model = estimator(algo, target, trials[number]).fit(fold_train(ready, fold))
        return model.transform(fold_validate(ready, fold)).agg(scores.rmse(target, "prediction")).first()[0]

    errors: dict[int, list[float | None]] = {n: [] for n in range(len(trials))}
    live = list(errors)
    with ThreadPoolExecutor(parallel) as pool:
        for fold in range(folds):
            for number, error in zip(live, pool.map(inheritable_thread_target(spark)(lambda n: fold_error(n, fold)), live)):
                errors[number].append(error)
            if fold < folds - 1:
                live = _prune({n: errors[n] for n in live}, prune_above)
    results = []
    for number, params in enumerate(trials):
        known = [e for e in errors[number] if e is not None]
        mean = sum(known) / len(known) if known and number in live else None
        results.append((number, algo, {k: float(v) for k, v in params.items()}, mean, len(errors[number])))
    return spark.createDataFrame(
        results, "trial_number INT, model_algo STRING, params MAP<STRING, DOUBLE>, cv_rmse DOUBLE, folds_done INT"
    )


def best_trial(found: DataFrame) -> int | None:
    """Number of the trial with the smallest error, the first of equals; None where no trial has one."""
    best = found.where(F.col("cv_rmse").isNotNull()).orderBy("cv_rmse", "trial_number").select("trial_number").first()
    return None if best is None else best[0]


def refit(train_rows: DataFrame, test_rows: DataFrame, feature_cols: list[str], target: str, algo: str, params: dict) -> tuple[Model, DataFrame]:
    """The model of one setting on the whole train part, and the test rows with its ``prediction``."""
    model = train(train_rows, feature_cols, target, algo, params)
    return model, predict(model, test_rows, feature_cols)


def grid(**values) -> list[dict]:
    """Every combination of the given parameter values."""
    names = list(values)
    return [dict(zip(names, combo)) for combo in itertools.product(*values.values())]


def built_in_importance(model: Model, spark, feature_cols: list[str]) -> DataFrame:
    """One row per feature from the fitted trees."""
    pairs = list(zip(feature_cols, [float(x) for x in model.featureImportances.toArray()]))
    return spark.createDataFrame(pairs, "feature STRING, importance DOUBLE")


def permutation_contributions(
    model: Model,
    df: DataFrame,
    feature_cols: list[str],
    order: list[str],
    sample_rows: int | None = None,
) -> DataFrame:
    """Mean absolute and mean signed change of the prediction when one feature is replaced.

    Each row borrows the replacement values from the row half the table away (by exact row index), a
    fixed permutation that keeps every column's distribution. One equi-join on the index pairs the
    rows; the replaced vectors of a row are scored beside its own prediction and added up by feature.
    ``sample_rows`` keeps the first rows by ``order``, as the explanation sample does; the default explains
    all rows. Without rows there is no result.
    """
    rows = df.select(*order, *[c for c in feature_cols if c not in order]).dropna()
    if sample_rows is not None:
        rows = rows.orderBy(*order).limit(sample_rows)
    indexed = stored_row_index(rows, order)
    total = indexed.agg(F.count("*")).scalar()
    vector = F.array(*[F.col(c).cast("double") for c in feature_cols])
    own = indexed.select("row_idx", vector.alias("own"))
    lent = indexed.select(
        F.pmod(F.col("row_idx") + F.floor(total / 2), total).alias("row_idx"), vector.alias("lent")
    )
    paired = own.join(lent, "row_idx")
    swapped = lambda i: F.transform(
        "own", lambda x, j: F.when(j == i, F.element_at("lent", i + 1)).otherwise(x)
    )
    # The row's own prediction stays in the row, so a replaced vector needs no partner: only one row per feature and task is shuffled.
    based = model.transform(paired.select("own", "lent", array_to_vector("own").alias("features")))
    based = based.select("own", "lent", F.col("prediction").alias("base"))
    variants = [F.struct(F.lit(i).alias("j"), swapped(i).alias("x")) for i in range(len(feature_cols))]
    listed = based.select("base", F.inline(F.array(*variants))).select("base", "j", array_to_vector("x").alias("features"))
    change = F.col("base") - F.col("prediction")
    return (
        model.transform(listed)
        .groupBy("j")
        .agg(F.avg(F.abs(change)).alias("mean_abs_shap"), F.avg(change).alias("mean_shap"), F.count("*").alias("sample_rows"))
        .select(F.get(F.array(*map(F.lit, feature_cols)), F.col("j")).alias("feature"), "mean_abs_shap", "mean_shap", "sample_rows")
    )


def explanation_rows(
    importance: DataFrame, contributions: DataFrame, run_id: str, algo: str, versions: dict, created_at
) -> DataFrame:
    """Both kinds of explanation in the explanations-table layout."""
    shared = {
        "run_id": F.lit(run_id),
        "model_algo": F.lit(algo),
        "created_at": F.lit(created_at),
        **{k: F.lit(v) for k, v in versions.items()},
    }
    built_in = importance.withColumns({**shared, "explanation_type": F.lit("feature_importance")})
    summary = contributions.withColumns({**shared, "explanation_type": F.lit("shap_summary")})
    return conform(built_in, EXPLANATIONS).unionByName(conform(summary, EXPLANATIONS))
