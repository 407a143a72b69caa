"""Landing CSV files: reading, writing and turning text rows into raw bars."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom.functions.parse import FETCHED_AT_FORMATS, format_timestamp, kline_fields, parse_timestamp
from tickloom.operators.dedup import latest_per_key
from tickloom.schemas import LANDING, struct_of

BAR_KEYS = ["symbol", "interval", "open_time"]

# CSV column order (fixed values). The short form is what one older writer produced.
CSV_COLUMNS = (
    "open_time", "open", "high", "low", "close", "volume", "close_time", "quote_volume", "trades",
    "source", "symbol", "interval", "fetched_at",
)
CSV_COLUMNS_SHORT = CSV_COLUMNS[:10]


def read_landing_stream(spark: SparkSession, folder: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """File stream over a landing folder with source file and load time attached.

    The folder is listed incrementally and seen files live in the query's checkpoint. The header is
    enforced by name so a file in the short layout is rejected rather than shifted.
    """
    reader = spark.readStream.schema(struct_of(LANDING)).option("header", True).option("enforceSchema", False)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return with_origin(reader.csv(folder))


def read_landing_batch(spark: SparkSession, path, columns=CSV_COLUMNS) -> DataFrame:
    """Batch read with the declared schema; ``columns`` picks the full or the short layout."""
    schema = struct_of(LANDING)
    picked = type(schema)([schema[c] for c in columns])
    df = spark.read.schema(picked).option("header", True).option("enforceSchema", False).csv(path)
    return df.withColumns({c: F.lit(None).cast(schema[c].dataType) for c in CSV_COLUMNS if c not in columns})


def with_origin(df: DataFrame) -> DataFrame:
    return df.select(
        *CSV_COLUMNS, F.col("_metadata.file_path").alias("_source_file"), F.current_timestamp().alias("_loaded_at")
    )


def to_landing_rows(bars: DataFrame, columns=CSV_COLUMNS, source: str = "binance") -> DataFrame:
    """Bars as CSV-ready rows: ISO times with ``Z``, fixed column order, default source."""
    have = set(bars.columns)
    out = []
    for name in columns:
        if name in ("open_time", "close_time", "fetched_at") and name in have:
            out.append(format_timestamp(name).alias(name))
        elif name == "source":
            out.append((F.coalesce(name, F.lit(source)) if name in have else F.lit(source)).alias(name))
        else:
            out.append((F.col(name) if name in have else F.lit(None).cast("string")).alias(name))
    return bars.select(*out)


def write_landing(bars: DataFrame, folder: str, mode: str = "append", columns=CSV_COLUMNS) -> None:
    """Distributed CSV write: one file per task, each with a header."""
    to_landing_rows(bars, columns).write.mode(mode).option("header", True).csv(folder)


# Fill-ins for text rows that omit them (fixed values).
DEFAULTS = {"source": "binance", "symbol": "BTCUSDT", "interval": "1h"}


def parse_landing(rows: DataFrame, ingested_at=None, defaults=DEFAULTS) -> DataFrame:
    """Typed bars from landing text rows. Unparseable times become NULL for the validator to count."""
    numbers = {c: "double" for c in ("open", "high", "low", "close", "volume", "quote_volume")}
    keep = [c for c in ("_source_file", "_loaded_at") if c in rows.columns]
    return rows.select(
        parse_timestamp("open_time").alias("open_time"),
        *[F.col(c).cast(t).alias(c) for c, t in numbers.items() if c != "quote_volume"],
        parse_timestamp("close_time").alias("close_time"),
        F.col("quote_volume").cast("double").alias("quote_volume"),
        F.col("trades").cast("bigint").alias("trades"),
        *[F.coalesce(c, F.lit(d)).alias(c) for c, d in defaults.items()],
        parse_timestamp("fetched_at", FETCHED_AT_FORMATS).alias("fetched_at"),
        (F.current_timestamp() if ingested_at is None else F.lit(ingested_at)).alias("ingested_at"),
        *keep,
    )


def newest_load(parsed: DataFrame, keys=BAR_KEYS) -> DataFrame:
    """Overlapping files resolved: the latest load wins, then the greater file name."""
    return latest_per_key(parsed, list(keys), ["_loaded_at", "_source_file"], drop_order=True)


def parse_klines(arrays: DataFrame, column: str = "kline", keep=(), symbol=None, interval: str = "1h", fetched_at=None) -> DataFrame:
    """Bars from positional kline arrays held as JSON text."""
    typed = arrays.select(*keep, *kline_fields(F.col(column)))
    stamps = F.current_timestamp() if fetched_at is None else F.lit(fetched_at)
    extra = {"source": F.lit("binance"), "interval": F.lit(interval), "fetched_at": stamps, "ingested_at": stamps}
    if "symbol" not in keep:
        extra["symbol"] = F.lit(symbol or DEFAULTS["symbol"])
    return typed.withColumns(extra)
