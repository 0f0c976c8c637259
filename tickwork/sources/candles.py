"""Candle / tick sources."""

from __future__ import annotations

import logging
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwork.functions.time import parse_timestamp

log = logging.getLogger(__name__)

# Default source column names of the candle CSV and their targets.
DEFAULT_TS_COLUMN = "Open time"
DEFAULT_COLUMNS = {"Open": "open", "High": "high", "Low": "low", "Close": "close", "Volume": "volume"}
CANDLE_COLUMNS = ("ts_raw", "open", "high", "low", "close", "volume")


def normalize_candles(
    raw: DataFrame,
    *,
    ts_col: str = DEFAULT_TS_COLUMN,
    columns: Mapping[str, str] = DEFAULT_COLUMNS,
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """P1-P4 on an already-read frame: parse time, date bounds, map + cast values, final projection.

    Bounds are inclusive and compared as timestamps: a date string means
    midnight, so ``end='2022-12-31'`` keeps only 00:00 of that day. Under ANSI
    mode a malformed number or timestamp raises. One projection, so Catalyst
    folds the bounds and pushes the filter next to the scan.
    """
    df = raw.select(
        parse_timestamp(ts_col).alias("ts_raw"),
        *[F.col(f"`{src}`").cast("double").alias(dst) for src, dst in columns.items()],
    )
    if start:
        df = df.filter(F.col("ts_raw") >= F.lit(start))
    if end:
        df = df.filter(F.col("ts_raw") <= F.lit(end))
    return df.select(*CANDLE_COLUMNS)


def load_candles_csv(
    spark: SparkSession,
    path: str,
    *,
    ts_col: str = DEFAULT_TS_COLUMN,
    columns: Mapping[str, str] = DEFAULT_COLUMNS,
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """S1 + S2: CSV with a header row, every column read as text (no inference pass), normalized.

    CSV is a row format without pushdown; land it once as Parquet
    (:func:`tickwork.sinks.write_parquet`) when it is read more than once.
    """
    log.info("loading candles from %s", path)
    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    return normalize_candles(raw, ts_col=ts_col, columns=columns, start=start, end=end)


def land_candles(candles: DataFrame, path: str) -> None:
    """Land normalized candles as Parquet partitioned by calendar ``date`` (of ``ts_raw``).

    The rows are rebalanced by date first (one shuffle): a date goes to few tasks, and one with
    many rows is split by size, so the number of files follows the data and not tasks x dates. Each
    file is sorted by time (tight row-group min/max statistics for the time filter). Read back with
    :func:`load_candles_parquet`: date bounds prune whole partitions and the
    time bound is pushed to the row groups.
    """
    dated = candles.withColumn("date", F.to_date("ts_raw")).hint("rebalance", "date")
    dated.sortWithinPartitions("date", "ts_raw").write.mode("overwrite").partitionBy("date").parquet(path)


def load_candles_parquet(
    spark: SparkSession, path: str, *, start: str | None = None, end: str | None = None
) -> DataFrame:
    """Read landed candles with the same inclusive bounds as the CSV source."""
    df = spark.read.parquet(path)
    if start:
        df = df.filter((F.col("date") >= F.to_date(F.lit(start))) & (F.col("ts_raw") >= F.lit(start)))
    if end:
        df = df.filter((F.col("date") <= F.to_date(F.lit(end))) & (F.col("ts_raw") <= F.lit(end)))
    return df.select(*CANDLE_COLUMNS)
