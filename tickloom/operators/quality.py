"""Row validation, batch checks and column profiles. Each check is one aggregate pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.functions.rules import bar_rules, batch_rules, broken_rules


def mark_broken(df: DataFrame, rules: dict[str, Column] | None = None, strict: bool = False) -> DataFrame:
    """Add ``broken_rules``, the names of the rules each row breaks."""
    return df.withColumn("broken_rules", broken_rules(rules or bar_rules(strict)))


def split_valid(df: DataFrame, strict: bool = False, rules: dict[str, Column] | None = None) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantined rows with their reasons)."""
    marked = mark_broken(df, rules, strict)
    bad = F.size("broken_rules") > 0
    return marked.where(~bad).drop("broken_rules"), marked.where(bad)


def batch_summary(df: DataFrame, rules: dict[str, Column] | None = None, strict: bool = False) -> DataFrame:
    """Row count, unparseable times, invalid rows and hits per rule in one pass."""
    rules = rules or bar_rules(strict)
    bad = F.size(broken_rules(rules)) > 0
    return df.agg(
        F.count("*").alias("row_count"),
        F.count_if(F.col("open_time").isNull()).alias("null_open_time_count"),
        F.count_if(bad).alias("invalid_count"),
        *[F.count_if(rule).alias(name) for name, rule in rules.items()],
    )


def require_clean(df: DataFrame, strict: bool = False) -> None:
    """Fail with the counts when a batch is empty or holds unparseable or invalid rows.

    One job for all counts; at scale prefer :func:`split_valid`, which keeps the good rows.
    """
    found = batch_summary(df, strict=strict).first().asDict()
    if found["row_count"] == 0:
        raise ValueError("the batch is empty")
    if found["null_open_time_count"] or found["invalid_count"]:
        hits = {k: v for k, v in found.items() if v and k not in ("row_count",)}
        raise ValueError(f"the batch has bad rows: {hits}")


def require_rows(df: DataFrame, at_least: int = 100) -> None:
    """Fail when there are fewer rows than training needs. Reads no more than ``at_least`` of them."""
    seen = df.limit(at_least).count()
    if seen < at_least:
        raise ValueError(f"not enough training rows: {seen} < {at_least}")


def batch_errors(batch: DataFrame, keys: list[str], limit: int | None = None) -> DataFrame:
    """One row per (bar, fault) of a freshly fetched batch, repeated keys included.

    Repeats are found with an aggregate over the keys, not a window, so a key with very many copies
    does not end up in one task. Every copy after the first in input order is an error; a set has no
    input order, so the key is reported once with the number of surplus copies.
    """
    rules = batch_rules()
    unparsed = rules.pop("parse_error")
    # A row that does not parse is reported as that alone and takes no part in the repeat check.
    faults = F.when(unparsed, F.array(F.lit("parse_error"))).otherwise(broken_rules(rules))
    row_level = batch.select(*keys, F.explode(faults).alias("error"), F.lit(0).cast("bigint").alias("surplus"))
    repeats = (
        batch.where(~unparsed)
        .groupBy(*keys)
        .agg((F.count("*") - 1).alias("surplus"))
        .where("surplus > 0")
        .select(*keys, F.lit("duplicate_open_time").alias("error"), "surplus")
    )
    report = row_level.unionByName(repeats)
    # The short report of a failed batch; a stable order makes it repeatable.
    return report.orderBy(*keys, "error").limit(limit) if limit else report


def missing_columns(df: DataFrame, expected: list[str]) -> list[str]:
    """Expected names that the frame lacks, compared without case (a plan-time check, no job)."""
    have = {name.lower() for name in df.columns}
    return [name for name in expected if name.lower() not in have]


def existing_columns(df: DataFrame, wanted: list[str]) -> list[str]:
    """Wanted names that are there, in the wanted order."""
    return [name for name in wanted if name in df.columns]


def _per_column(df: DataFrame, columns: list[str], measures: dict) -> DataFrame:
    """One row per column from one aggregate: measures become arrays of structs and are exploded."""
    cells = [
        F.struct(F.lit(c).alias("column"), *[fn(c).alias(name) for name, fn in measures.items()])
        for c in columns
    ]
    return df.agg(F.count("*").alias("_n"), F.array(*cells).alias("_cells")).select("_n", F.inline("_cells"))


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    counted = _per_column(df, columns or df.columns, {"null_count": lambda c: F.count_if(F.col(c).isNull())})
    return counted.select("column", "null_count", F.col("_n").alias("row_count"))


def missing_ratio(df: DataFrame, threshold: float = 0.05, columns: list[str] | None = None) -> DataFrame:
    """Columns whose share of NULLs is above the threshold; every column when the table is empty."""
    counts = null_counts(df, columns)
    ratio = F.when(F.col("row_count") == 0, F.lit(1.0)).otherwise(
        F.try_divide(F.col("null_count"), F.col("row_count"))
    )
    return (
        counts.select("column", ratio.alias("null_ratio"))
        .where(F.col("null_ratio") > threshold)
        .withColumn("alert", F.lit(True))
    )


def age_hours(latest: Column, as_of) -> Column:
    """Hours between two instants, with fractions."""
    as_of = as_of if isinstance(as_of, Column) else F.lit(as_of)
    micros = lambda c: F.unix_micros(c.cast("timestamp"))
    return (micros(as_of) - micros(latest)) / F.lit(3_600_000_000.0)


def freshness(df: DataFrame, as_of, time: str = "open_time", max_hours: float = 2) -> DataFrame:
    """One row: newest time, age, ``no_data``/``fresh``/``stale`` and whether to alert."""
    newest = df.agg(F.max(time).alias("latest"))
    age = age_hours(F.col("latest"), as_of)
    status = F.when(F.col("latest").isNull(), "no_data").when(age <= max_hours, "fresh").otherwise("stale")
    return newest.select(
        "latest", age.alias("age_hours"), status.alias("status"), (status != "fresh").alias("alert")
    )


def column_summary(df: DataFrame, columns: list[str], accuracy: int = 10000) -> DataFrame:
    """count, mean, std, min, quartiles, max, null count and null percentage of numeric columns."""
    value = lambda c: F.col(c).cast("double")
    quartile = lambda p: lambda c: F.percentile_approx(value(c), p, accuracy)
    measures = {
        "count": lambda c: F.count(c),
        "mean": lambda c: F.avg(value(c)),
        "std": lambda c: F.stddev_samp(value(c)),
        "min": lambda c: F.min(value(c)),
        "p25": quartile(0.25),
        "p50": quartile(0.5),
        "p75": quartile(0.75),
        "max": lambda c: F.max(value(c)),
        "null_count": lambda c: F.count_if(F.col(c).isNull()),
    }
    percent = F.round(F.try_divide(F.col("null_count") * 100.0, F.col("_n")), 2)
    return _per_column(df, columns, measures).withColumn("null_pct", percent).drop("_n")


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Counts over equal-width bins from the smallest to the largest value, the last bin closed.

    The range is one scalar subquery; the counts combine on the map side. Empty bins are included.
    """
    value = F.col(column).cast("double")
    ends = df.agg(F.struct(F.min(value).alias("lo"), F.max(value).alias("hi"))).scalar()
    placed = df.where(value.isNotNull()).select(
        F.least(
            F.coalesce(
                F.floor(F.try_divide((value - ends["lo"]) * bins, ends["hi"] - ends["lo"])), F.lit(0)
            ),
            F.lit(bins - 1),
        ).alias("bin")
    )
    counts = placed.groupBy("bin").agg(F.count("*").alias("row_count"))
    width = (ends["hi"] - ends["lo"]) / bins
    every = df.sparkSession.range(bins).select(F.col("id").alias("bin"))
    return every.join(counts, "bin", "left").select(
        "bin",
        (ends["lo"] + F.col("bin") * width).alias("bin_start"),
        (ends["lo"] + (F.col("bin") + 1) * width).alias("bin_end"),
        F.coalesce("row_count", F.lit(0)).alias("row_count"),
    )
