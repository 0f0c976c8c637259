"""Adapters from the benchmark tables to the library's input shapes.

* ticks        -- ``events``: ``ts_raw`` and open = high = low = close = volume = value
* keyed ticks  -- the same, keyed by ``event_type``
* activity     -- ``events`` per UTC hour: block count, summed user ids as transaction count, summed value; with a
                  text ``timestamp`` like the activity producers write. One event type can be asked for where a join
                  needs hours without activity
* daily        -- ``orders``: summed ``o_totalprice`` per ``o_orderdate`` as ``Volume``
* large keyed  -- ``lineitem`` keyed by ``l_suppkey``, daily bars; the lines of a day have equal times (order and line number
                  aren't unique), so the price decides

Money sums go through ``decimal(18,2)`` so they are exact: the result does not
depend on the order in which partitions are combined.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwork.functions.time import bucket_start, hour_text


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def exact_sum(c: str) -> F.Column:
    return F.sum(F.col(c).cast("decimal(18,2)")).cast("double")


def ticks(spark: SparkSession, sf_dir: str, keyed: bool = False) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    v = F.col("value")
    return ev.select(
        *(["event_type"] if keyed else []),
        F.col("ts").alias("ts_raw"),
        v.alias("open"), v.alias("high"), v.alias("low"), v.alias("close"), v.alias("volume"),
    )


def activity(spark: SparkSession, sf_dir: str, event_type: str | None = None) -> DataFrame:
    """Hourly activity table with the producers' columns (``timestamp`` text first)."""
    ev = table(spark, sf_dir, "events")
    if event_type is not None:
        ev = ev.filter(F.col("event_type") == event_type)
    hourly = ev.groupBy(bucket_start("ts").alias("_h")).agg(
        F.count(F.lit(1)).alias("block_count"),
        F.sum("user_id").alias("tx_count_hour"),
        exact_sum("value").alias("total_value_hour"),
    )
    return hourly.select(
        hour_text("_h").alias("timestamp"), "total_value_hour",
        F.col("tx_count_hour").cast("double").alias("tx_count_hour"), "block_count",
        F.col("_h").alias("ts_hour"),
    )


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    od = table(spark, sf_dir, "orders")
    return od.groupBy(F.col("o_orderdate").alias("Date")).agg(exact_sum("o_totalprice").alias("Volume"))


def lineitem_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    p = F.col("l_extendedprice")
    return li.select(
        "l_suppkey", F.col("l_shipdate").alias("ts_raw"),
        p.alias("open"), p.alias("high"), p.alias("low"), p.alias("close"),
        F.col("l_quantity").alias("volume"),
    )
