"""Blocks must not change any result; indexes must equal a global row number."""

import random
from datetime import timedelta

import pytest
from pyspark.sql import Window, functions as F

from tickloom.operators import indicators as ind
from tickloom.operators.windows import BlockPlan, assign_blocks, over_series, row_index, stored_row_index


def gappy_bars(spark, hours, n=500, seed=1):
    """Two series with random gaps: a dense one that dominates and a sparse one."""
    rng = random.Random(seed)
    rows = []
    for symbol, keep in (("hot", 0.9), ("rare", 0.1)):
        for t in range(n):
            if rng.random() < keep:
                close = 100 + rng.gauss(0, 5)
                rows.append((symbol, hours(t), close - 1, close + 2, close - 2, close, rng.uniform(1, 9)))
    schema = "symbol STRING, open_time TIMESTAMP_NTZ, open DOUBLE, high DOUBLE, low DOUBLE, close DOUBLE, volume DOUBLE"
    return spark.createDataFrame(rows, schema)


def collect(df):
    columns = sorted(df.columns)
    out = {}
    for r in df.select(columns).collect():
        out[(r.symbol, r.open_time)] = tuple(round(v, 9) if isinstance(v, float) else v for v in r)
    return out


@pytest.mark.parametrize("block_rows, days", [(193, 1), (200, 1), (257, 3), (400, 2), (4096, 7)])
def test_blocks_equal_plain_windows(spark, hours, block_rows, days):
    df = gappy_bars(spark, hours, seed=block_rows).cache()
    plan = BlockPlan(ind.FULL_LOOKBACK, ind.HORIZON, timedelta(days=days), block_rows, split_above=0)
    assert collect(ind.full_features(df, plan=plan)) == collect(ind.full_features(df, plan=None))


def test_random_small_plans(spark, hours):
    rng = random.Random(5)
    df = gappy_bars(spark, hours, n=120).cache()

    def build(d, w):
        return d.withColumns(
            {
                "m": F.avg("close").over(w.trailing(5)),
                "p": F.lag("close", 5).over(w.ordered),
                "t": w.at_offset("close", timedelta(hours=2)),
            }
        )

    plain = collect(over_series(df, ["symbol"], "open_time", build))
    for _ in range(6):
        bucket = rng.choice([2, 3, 6])
        plan = BlockPlan(5, timedelta(hours=2), timedelta(hours=bucket), rng.randint(5 + bucket, 40), split_above=rng.choice([0, 30]))
        assert collect(over_series(df, ["symbol"], "open_time", build, plan)) == plain


def test_blocks_really_split_the_hot_series(spark, hours):
    df = gappy_bars(spark, hours)
    blocks = assign_blocks(df, ["symbol"], "open_time", BlockPlan(10, None, timedelta(days=1), 60, split_above=100))
    sizes = blocks.where("symbol = 'hot'").groupBy("_block").count().collect()
    assert len(sizes) > 5 and max(r["count"] for r in sizes) < 60 + 24 + 10 + 24
    assert {r._block for r in blocks.where("symbol = 'rare'").collect()} == {0}  # short series stay whole


def test_features_since_equal_the_filtered_whole(spark, hours):
    df = gappy_bars(spark, hours, n=600, seed=9).cache()
    start = hours(450)
    whole = ind.full_features(df, plan=None).where(F.col("open_time") >= F.lit(start).cast("timestamp_ntz"))
    part = ind.features_since(df, F.lit(start).cast("timestamp_ntz"))
    assert collect(part) == collect(whole)


def test_short_series_need_no_blocks(spark, hours):
    df = gappy_bars(spark, hours, n=50)
    plan = ind.full_features(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


@pytest.mark.parametrize("ahead", [timedelta(hours=1), timedelta(days=3)])
@pytest.mark.parametrize("bucket", [timedelta(days=400), timedelta(days=7)])
def test_full_buckets_are_narrowed(spark, hours, ahead, bucket):
    df = gappy_bars(spark, hours)
    plan = BlockPlan(10, ahead, bucket, 60, split_above=0)
    build = lambda rows, w: rows.select("*", w_sum(w, 10), w.at_offset("close", ahead).alias("target"))
    w_sum = lambda w, n: F.sum("close").over(w.trailing(n)).alias("total")
    plain, cut = (over_series(df, ["symbol"], "open_time", build, p) for p in (None, plan))
    assert collect(cut) == collect(plain)
    sizes = assign_blocks(df, ["symbol"], "open_time", plan).where("not _copy").groupBy("symbol", "_block").count()
    assert sizes.agg(F.max("count")).first()[0] < 120


def test_one_crowded_microsecond_makes_larger_blocks(spark, hours):
    rows = [("hot", hours(n // 90), float(n)) for n in range(450)]
    df = spark.createDataFrame(rows, "symbol string, open_time timestamp_ntz, close double")
    plan = BlockPlan(10, None, timedelta(days=7), 60, split_above=0)
    blocks = assign_blocks(df, ["symbol"], "open_time", plan)
    assert blocks.where("not _copy").count() == 450
    counts = {(r._block, r._copy): r["count"] for r in blocks.groupBy("_block", "_copy").count().collect()}
    assert len({b for b, _ in counts}) > 1 and all(n >= 10 for (_, copy), n in counts.items() if not copy)


def test_dense_series_of_over_a_million_rows(spark):
    """One row a second, above the default limit: cut, and equal to the plain window."""
    seconds = spark.range(1_100_000).select(F.lit("x").alias("symbol"), F.timestamp_seconds(F.col("id")).cast("timestamp_ntz").alias("open_time"), (F.col("id") % 97).cast("double").alias("close"))
    build = lambda rows, w: rows.select("open_time", F.sum("close").over(w.trailing(168)).alias("total"), w.at_offset("close", timedelta(hours=1)).alias("target"))
    plain, cut = (over_series(seconds, ["symbol"], "open_time", build, p) for p in (None, BlockPlan(168, timedelta(hours=1))))
    digest = F.sum(F.xxhash64("open_time", "total", "target").cast("decimal(38,0)"))
    assert plain.agg(digest, F.count("*")).first() == cut.agg(digest, F.count("*")).first()


def test_bad_plans_are_refused():
    with pytest.raises(ValueError):
        BlockPlan(lookback=168, block_rows=168)


@pytest.mark.parametrize("index", [row_index, stored_row_index])
def test_row_index_equals_global_row_number(spark, hours, index):
    df = gappy_bars(spark, hours, n=300).select("symbol", "open_time")
    expected = df.withColumn("x", F.row_number().over(Window.orderBy("open_time", "symbol")) - 1)
    got = index(df, ["open_time", "symbol"])
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in expected.collect()}


def test_stored_index_splits_one_hot_timestamp(spark, hours):
    df = spark.range(20000).select(F.lit(hours(0)).cast("timestamp_ntz").alias("t"), F.col("id").alias("k"))
    got = stored_row_index(df.repartition(8), ["t", "k"])
    assert got.where("row_idx <> k").count() == 0


@pytest.mark.parametrize("split_above, at_most", [(0, 2), (100, 4)])
def test_blocks_evaluate_their_input_a_fixed_number_of_times(spark, hours, split_above, at_most):
    """However often the buckets are narrowed, the input itself is evaluated once for them and once for the result."""
    passes = spark.sparkContext.accumulator(0)
    n = 3000

    def counted(batches):
        for batch in batches:
            passes.add(batch.num_rows)
            yield batch

    source = spark.range(n).select(F.lit("a").alias("k"), (F.lit(hours(0)) + F.make_dt_interval(secs=F.col("id").cast("decimal(18,6)"))).alias("t"), "id")
    rows = source.mapInArrow(counted, source.schema)
    plan = BlockPlan(lookback=3, block_rows=64, split_above=split_above)
    built = over_series(rows, ["k"], "t", lambda df, w: df.withColumn("m", F.sum("id").over(w.trailing(3))), plan)
    got = {r.id: r.m for r in built.collect()}
    assert len(got) == n and all(got[i] == sum(range(max(0, i - 3), i)) for i in range(1, n))
    assert passes.value <= at_most * n
