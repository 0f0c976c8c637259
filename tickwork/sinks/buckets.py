"""Co-partitioned storage for the activity join.

Both sides of a join that runs again and again are stored by the hash of the join
key, in equally many buckets, each sorted by the key. The join then reads bucket
by bucket: neither side is shuffled or sorted or broadcast, however large it is.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame

from tickwork.operators.enrich import join_activity


def write_buckets(df: DataFrame, path: str, by: Sequence[str], buckets: int) -> str:
    """Store ``df`` as an external table at ``path``, bucketed and sorted by ``by``; returns the table's name.

    Each task holds one bucket, so there is one file a bucket.
    """
    name = f"tickwork_{uuid.uuid4().hex}"
    placed = df.repartition(buckets, *by).sortWithinPartitions(*by)
    placed.write.bucketBy(buckets, *by).sortBy(*by).option("path", path).format("parquet").saveAsTable(name)
    return name


def join_buckets(spark, bars: str, activity: str, *, on: str = "ts_hour", keys: Sequence[str] = (), columns: Sequence[str] | None = None) -> DataFrame:
    """:func:`tickwork.operators.enrich.join_activity` of two stored tables: bucket by bucket, every bar kept.

    Equal hours of the activity fan out as in any join. The hint keeps Spark from broadcasting a side.
    """
    return join_activity(spark.table(bars), spark.table(activity).hint("merge"), on=on, keys=keys, columns=columns)
