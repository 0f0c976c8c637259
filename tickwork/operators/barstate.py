"""Bars as mergeable state: late ticks and coarser bars without reading ticks again (A1).

A bar can't be merged from its published columns: open and close need the order
of their ticks, a deviation needs count and moments. The state of a series key
and bucket keeps all of it in one row: order and value of the first and the last
tick, highest and lowest, volume, and count, mean and sum of squared deviations
of the close. States of any finer buckets, and of any number of loads, merge
into those of a coarser bucket; a bar is a projection of its state.

A store is a Parquet folder of states, to which every load of ticks appends its
own rows: a late file adds rows to buckets that exist, nothing is rewritten, and
reading merges. ``compact`` writes the merged rows as a new store.

Moments merge pair by pair in the order of buckets (the update of Chan, Golub
and LeVeque): no difference of large sums is taken, and the result doesn't
depend on the order in which rows arrive. A group holds one row for each finer
bucket and load of one coarse bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwork.functions.order import packed_order
from tickwork.functions.time import bucket_start, interval_seconds

BUCKET = "bucket"
# Fixed names of the stored state; NULL prices and volumes count like in the bars: not at all.
STATE = ("first_order", "first_open", "last_order", "last_close", "high", "low", "volume", "n", "mean", "m2")


def bar_state(
    ticks: DataFrame, *, ts: str = "ts_raw", keys: Sequence[str] = (), size: str = "15 minutes", tiebreak: Sequence[str] = (),
    open: str = "open", high: str = "high", low: str = "low", close: str = "close", volume: str = "volume",
) -> DataFrame:
    """One row ``*keys, bucket, *STATE`` for each series and bucket of ``size``: a hash aggregate with map-side combining.

    Ticks are ordered as in :func:`tickwork.operators.bars.ohlcv_bars`.
    """
    number = lambda c: F.col(c).cast("double")
    first, last = (packed_order(ticks, [ts, *(tiebreak or [v])]) for v in (open, close))
    c = number(close)
    return ticks.groupBy(*keys, bucket_start(ts, size).alias(BUCKET)).agg(
        F.min(first).alias("first_order"), F.min_by(number(open), first).alias("first_open"),
        F.max(last).alias("last_order"), F.max_by(c, last).alias("last_close"),
        F.max(number(high)).alias("high"), F.min(number(low)).alias("low"), F.sum(number(volume)).alias("volume"),
        F.count(c).alias("n"), F.avg(c).alias("mean"), (F.var_pop(c) * F.count(c)).alias("m2"),
    )


def merged_moments(states: Column) -> Column:
    """``struct(n, mean, m2)`` of an array of such structs, merged one after the other; those with ``n`` 0 or NULL are passed over."""
    none = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))

    def both(a: Column, b: Column) -> Column:
        n, off = a.n + b.n, b["mean"] - a["mean"]
        whole = F.struct(n.alias("n"), (a["mean"] + off * b.n / n).alias("mean"), (a.m2 + b.m2 + off * off * a.n * b.n / n).alias("m2"))
        return F.when(F.coalesce(b.n, F.lit(0)) == 0, a).otherwise(whole)

    return F.aggregate(states, none, both)


def merge_states(states: DataFrame, *, keys: Sequence[str] = (), size: str) -> DataFrame:
    """The states of buckets of ``size`` from those of the same or finer ones, several rows a bucket allowed."""
    parts = F.array_sort(F.collect_list(F.struct(BUCKET, "n", "mean", "m2")))
    merged = states.groupBy(*keys, bucket_start(BUCKET, size).alias("_tw_bucket")).agg(
        F.min("first_order").alias("first_order"), F.min_by("first_open", "first_order").alias("first_open"),
        F.max("last_order").alias("last_order"), F.max_by("last_close", "last_order").alias("last_close"),
        F.max("high").alias("high"), F.min("low").alias("low"), F.sum("volume").alias("volume"), merged_moments(parts).alias("m"),
    )
    return merged.select(*keys, F.col("_tw_bucket").alias(BUCKET), *STATE[:7], *(F.col(f"m.{c}").alias(c) for c in STATE[7:]))


def bars_from_state(states: DataFrame, *, keys: Sequence[str] = (), size: str, out_ts: str = "ts_hour", suffix: str = "_1h") -> DataFrame:
    """The bars of ``size``, with the columns of :func:`tickwork.operators.bars.ohlcv_bars`, from states of the same or finer buckets."""
    s = merge_states(states, keys=keys, size=size)
    published = {"open": "first_open", "close": "last_close", "high": "high", "low": "low", "vol": "volume"}
    dev = F.when(F.col("n") > 0, F.sqrt(F.greatest(F.col("m2"), F.lit(0.0)) / F.col("n")))
    return s.select(*keys, F.col(BUCKET).alias(out_ts), *(F.col(c).alias(f"{name}{suffix}") for name, c in published.items()), dev.alias(f"volatility{suffix}"))


def append_state(states: DataFrame, path: str) -> None:
    """Add the states of a load to the store."""
    states.write.mode("append").parquet(path)


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """All rows of the store, of all loads; a bucket can have several."""
    return spark.read.parquet(path)


def compact(spark: SparkSession, path: str, to: str, *, keys: Sequence[str] = (), size: str) -> None:
    """Write the store as a new one with one row a bucket."""
    interval_seconds(size)  # raises for what isn't an interval
    merge_states(read_state(spark, path), keys=keys, size=size).write.parquet(to)
