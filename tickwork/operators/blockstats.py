"""Hourly statistics of decoded blocks (A2, A3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwork.functions.time import bucket_start, epoch_to_utc_ntz, hour_text

STATS_COLUMNS = ("timestamp", "block_count", "tx_count_hour", "total_value_hour")


def hourly_block_stats(blocks: DataFrame, *, ts: str = "block_time", tx: str = "tx_count") -> DataFrame:
    """Per UTC hour: number of blocks, summed transaction count, ``0.0`` value placeholder.

    ``blocks`` holds epoch seconds in ``ts``. The hour key is the UTC wall clock
    whatever the session zone. Partial aggregation runs map-side; one row per
    hour is shuffled per task.
    """
    hour = bucket_start(epoch_to_utc_ntz(ts), "1 hour").alias("_tw_hour")
    return (
        blocks.groupBy(hour)
        .agg(F.count(F.lit(1)).alias("block_count"), F.sum(F.col(tx).cast("decimal(20,0)")).alias("tx_count_hour"))
        .select(
            hour_text("_tw_hour").alias("timestamp"),
            "block_count",
            F.coalesce(F.col("tx_count_hour"), F.lit(0)).cast("bigint").alias("tx_count_hour"),
            F.lit(0.0).alias("total_value_hour"),
        )
    )


def total_blocks(stats: DataFrame) -> DataFrame:
    """A3: one-row total of decoded blocks (sum of ``block_count``)."""
    return stats.agg(F.coalesce(F.sum("block_count"), F.lit(0)).cast("bigint").alias("n_blocks"))
