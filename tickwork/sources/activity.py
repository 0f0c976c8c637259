"""Activity series source."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from tickwork.functions.time import bucket_floor
from tickwork.sources.ledger import list_table_files, read_reconciled

log = logging.getLogger(__name__)

# Fixed value: time-column candidates, in priority order, matched case-insensitively.
TIME_CANDIDATES = ("ts_hour", "timestamp", "ts", "date", "datetime")


def detect_time_column(columns: Sequence[str], candidates: Sequence[str] = TIME_CANDIDATES) -> str:
    """The column with the best-ranked candidate name, in any case; ``ValueError`` if there is none."""
    rank = {name: k for k, name in enumerate(candidates)}
    known = [c for c in columns if c.lower() in rank]
    if not known:
        raise ValueError(f"none of {', '.join(candidates)} among the activity columns {', '.join(columns)}")
    return min(reversed(known), key=lambda c: rank[c.lower()])


def align_activity(df: DataFrame, *, ts_col: str | None = None, size: str = "1 hour") -> DataFrame:
    """P5: add (or replace) ``ts_hour`` = start of the ``size`` bucket of the detected time column.

    Text and date columns are read as session-zone timestamps; timestamp columns
    keep their type. Buckets are aligned to the epoch like those of the bars, so
    both join sides meet in every time zone. Rows without a time keep a NULL bucket.
    """
    col = ts_col or detect_time_column(df.columns)
    log.info("activity time column: %s", col)
    kind, t = df.schema[col].dataType, F.col(f"`{col}`")
    if not isinstance(kind, TimestampNTZType):
        t = t.cast("timestamp")
    return df.withColumn("ts_hour", bucket_floor(t, size, ntz=isinstance(kind, TimestampNTZType)))


def load_activity(spark: SparkSession, path: str | None, *, ts_col: str | None = None, size: str = "1 hour", mixed: bool = False) -> DataFrame | None:
    """S3 + S4: the Parquet activity table aligned to ``ts_hour``, or ``None`` without a path (no join then).

    ``mixed`` reads a folder of files whose column types differ (:func:`tickwork.sources.ledger.read_reconciled`).
    """
    if not path:
        log.warning("no activity path given; activity features skipped")
        return None
    if mixed:
        files = [r["path"] for r in list_table_files(spark, path, "*.parquet").select("path").collect()]
        return align_activity(read_reconciled(spark, files), ts_col=ts_col, size=size)
    return align_activity(spark.read.parquet(path), ts_col=ts_col, size=size)
