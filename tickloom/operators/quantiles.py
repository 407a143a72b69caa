"""Exact quantiles of many columns at once, by repeated narrowing of value ranges.

A cut is the smallest value with at least its share of the rows at or below it. Every row stands in one range, at first its
column. Per round a bounded sketch of each range proposes a value to both sides of every cut, and one pass counts exactly the rows
between and at these values. A cut that falls on such a value is solved; the others go on in the range between two of them,
about a hundredth of the rows, with their rank less the rows below. The proposed values are values of the range and not part of
any new one, so every round ends with fewer rows, ties and skew included. A range of at most ``SMALL`` rows is sorted in
one place. The driver holds a sketch per range and a count per class: numbers of columns and cuts, not of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom.operators.drift import BUCKETS, to_long
from tickloom.session import checkpointed

SMALL = 4096
_GRID = 256

# Per range: (column, cut number, rank within the range).
Targets = dict[str, list[tuple[str, int, int]]]


def _proposals(rows: DataFrame, targets: Targets, sizes: dict[str, int], accuracy: int) -> dict[str, list[float]]:
    """Rising values of each range that enclose its cuts, as far as the sketch can tell."""
    grids = rows.groupBy("range").agg(F.percentile_approx("value", [i / _GRID for i in range(_GRID + 1)], accuracy).alias("grid"))
    out = {}
    for r in grids.collect():
        shares = [rank / sizes[r.range] * _GRID for _, _, rank in targets[r.range]]
        places = {min(max(int(s) + d, 0), _GRID) for s in shares for d in (-1, 2)}
        out[r.range] = list(dict.fromkeys(r.grid[i] for i in sorted(places)))
    return out


def _classed(spark: SparkSession, rows: DataFrame, proposals: dict[str, list[float]]) -> DataFrame:
    """Adds ``class``: 2 i between the proposals i - 1 and i, 2 i + 1 at proposal i."""
    cuts = spark.createDataFrame(list(proposals.items()), "range STRING, cuts ARRAY<DOUBLE>")
    placed = rows.join(F.broadcast(cuts), "range").withColumn("below", F.lit(0))
    # A binary search, one step per projection: one expression with a test for every proposal is too long for the JVM to compile.
    for step in (1 << i for i in reversed(range(max(map(len, proposals.values())).bit_length()))):
        reached = F.coalesce(F.get("cuts", F.col("below") + (step - 1)) < F.col("value"), F.lit(False))
        placed = placed.withColumn("below", F.col("below") + F.when(reached, step).otherwise(0))
    at = F.coalesce((F.get("cuts", F.col("below")) == F.col("value")).cast("int"), F.lit(0))
    return placed.select("range", "value", (F.col("below") * 2 + at).alias("class"))


def _advance(targets: Targets, proposals: dict[str, list[float]], counts: dict[str, dict[int, int]]) -> tuple[list[tuple], Targets]:
    """(solved cuts, cuts of the next ranges, which are named by range and class)."""
    solved, following = [], {}
    for of, wanted in targets.items():
        for feature, part, rank in wanted:
            for c in sorted(counts[of]):
                if rank <= counts[of][c]:
                    break
                rank -= counts[of][c]
            if c % 2:
                solved.append((feature, part, proposals[of][c // 2]))
            else:
                following.setdefault(f"{of}/{c}", []).append((feature, part, rank))
    return solved, following


def _sorted(spark: SparkSession, rows: DataFrame, targets: Targets) -> list[tuple]:
    """The cuts of small ranges."""
    wanted = spark.createDataFrame([(of, *t) for of, ts in targets.items() for t in ts], "range STRING, feature STRING, part INT, rank INT")
    lists = rows.join(F.broadcast(wanted.select("range").distinct()), "range").groupBy("range").agg(F.sort_array(F.collect_list("value")).alias("sorted"))
    return [tuple(r) for r in wanted.join(lists, "range").select("feature", "part", F.element_at("sorted", F.col("rank"))).collect()]


def exact_cuts(df: DataFrame, columns: list[str], parts: int = BUCKETS, accuracy: int = 10000, small: int = SMALL) -> DataFrame:
    """(feature, cuts) like ``drift.cut_points``, exact at every size; a column without values has no row.

    NULL is no value; NaN is larger than every number. Ties count as often as they stand there.
    """
    spark = df.sparkSession
    rows = checkpointed(to_long(df, columns, []).withColumnRenamed("feature", "range"))
    sizes = {r.range: r["count"] for r in rows.groupBy("range").count().collect()}
    targets: Targets = {c: [(c, i, max(1, -(-i * n // parts))) for i in range(1, parts)] for c, n in sizes.items()}
    found: list[tuple] = []
    while targets:
        few = {of: ts for of, ts in targets.items() if sizes[of] <= small}
        if few:
            found += _sorted(spark, rows, few)
        targets = {of: ts for of, ts in targets.items() if of not in few}
        if not targets:
            break
        names = spark.createDataFrame([(of,) for of in targets], "range STRING")
        rows = rows.join(F.broadcast(names), "range")
        proposals = _proposals(rows, targets, sizes, accuracy)
        classed = _classed(spark, rows, proposals)
        counts: dict[str, dict[int, int]] = {}
        for r in classed.groupBy("range", "class").count().collect():
            counts.setdefault(r.range, {})[r["class"]] = r["count"]
        sizes = {f"{of}/{c}": n for of, classes in counts.items() for c, n in classes.items()}
        solved, targets = _advance(targets, proposals, counts)
        found += solved
        if targets:
            chosen = spark.createDataFrame([(of,) for of in targets], "range STRING")
            inner = classed.select(F.concat_ws("/", "range", F.col("class").cast("string")).alias("range"), "value")
            rows = checkpointed(inner.join(F.broadcast(chosen), "range"))
    cuts = spark.createDataFrame(found, "feature STRING, part INT, cut DOUBLE").groupBy("feature").agg(F.sort_array(F.collect_list(F.struct("part", "cut"))).alias("cuts"))
    return cuts.select("feature", F.col("cuts.cut").alias("cuts"))
