"""Positions and running totals in one order over all rows, without one task that sees them all (O1, O2, M8).

``Window.orderBy`` without a partition sorts the whole table in a single task.
Here a running total is a distributed prefix sum: rows are dealt out by ranges of
the order, each range's totals become one row, running totals over those rows are
the offsets of the ranges, and a window within each range adds what comes before
a row there. A range holds about ``rows_a_range`` rows; the table of totals, one
row a range, is what one task sums up and what is broadcast.

A row number, written with the rows, ends the order: rows with equal order
columns, however many, are dealt to several ranges. Positions of such rows are
any of theirs, and the same whenever the result is read again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickwork.operators.series import materialize

ROWS_A_RANGE = 1_000_000
_ROW, _RANGE, _N = "_tw_row", "_tw_range", "_tw_count"


def with_running_totals(
    df: DataFrame,
    order: Sequence[str | Column],
    totals: Mapping[str, Column] | None = None,
    *,
    position: str | None = None,
    rows_a_range: int = ROWS_A_RANGE,
) -> DataFrame:
    """``df`` with, for each name in ``totals``, the sum of that column over all rows before, and the 1-based ``position``.

    The sum before the first row is 0. Sums of integers and decimals are exact; doubles are added range by range. ``order``
    holds columns or expressions of ``df`` (``Column.desc()`` too).
    """
    if rows_a_range < 1:
        raise ValueError("a range has rows")
    values = {f"_tw_v{k}": v for k, v in enumerate((totals or {}).values())}
    orders = [F.col(o) if isinstance(o, str) else o for o in order]
    rows = materialize(df.select("*", *(v.alias(n) for n, v in values.items()), F.monotonically_increasing_id().alias(_ROW)), "unordered")
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // rows_a_range))
    ranged = materialize(rows.repartitionByRange(parts, *orders, _ROW).withColumn(_RANGE, F.spark_partition_id()), "ranges")

    sums = [F.sum(n).alias(f"{n}_all") for n in values]
    by_range = ranged.groupBy(_RANGE).agg(F.count(F.lit(1)).alias(_N), *sums)
    earlier = Window.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)  # over one row a range
    offsets = by_range.select(_RANGE, F.coalesce(F.sum(_N).over(earlier), F.lit(0)).alias(_N), *(F.sum(f"{n}_all").over(earlier).alias(f"{n}_all") for n in values))

    inside = Window.partitionBy(_RANGE).orderBy(*orders, _ROW)
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    out = ranged.withColumns({f"{n}_own": F.sum(n).over(before) for n in values} | {"_tw_place": F.row_number().over(inside)})
    out = out.join(F.broadcast(offsets), _RANGE)
    zero = F.lit(0)
    found = [(F.coalesce(F.col(f"{n}_all"), zero) + F.coalesce(F.col(f"{n}_own"), zero)).alias(name) for n, name in zip(values, totals or {})]
    if position:
        found.append((F.col(_N) + F.col("_tw_place")).alias(position))
    return out.select(*df.columns, *found)


def with_positions(df: DataFrame, order: Sequence[str | Column], name: str = "position", rows_a_range: int = ROWS_A_RANGE) -> DataFrame:
    """``df`` with each row's 1-based position in ``order``."""
    return with_running_totals(df, order, position=name, rows_a_range=rows_a_range)


def auc_by_ranks(scored: DataFrame, *, label: str, score: str, rows_a_range: int = ROWS_A_RANGE) -> DataFrame:
    """M8 by its definition, one row ``auc_roc``: the share of (positive, negative) pairs that the score orders rightly, ties half.

    Equal scores are counted first; running totals over distinct scores give the negatives below each. Counts are added as
    decimals, so the number of pairs is exact. NULL if either class is missing.
    """
    whole = lambda c: F.sum(c).cast("decimal(38,0)")
    by = scored.groupBy(F.col(score).alias("score")).agg(whole((F.col(label) == 1).cast("long")).alias("p"), whole((F.col(label) != 1).cast("long")).alias("n"))
    below = with_running_totals(by, ["score"], {"below": F.col("n")}, rows_a_range=rows_a_range)
    half = (F.col("p").cast("double") * (F.col("below") * 2 + F.col("n")).cast("double"))
    t = below.agg(F.sum(half).alias("w"), F.sum("p").cast("double").alias("p"), F.sum("n").cast("double").alias("n"))
    pairs = F.col("p") * F.col("n") * 2
    return t.select(F.when(pairs > 0, F.col("w") / pairs).alias("auc_roc"))


def file_positions(spark: SparkSession, path: str, *columns: str, name: str = "position") -> DataFrame:
    """Rows of a sorted Parquet table with their 1-based place over all its files (O1, O2).

    Files are in the order of their names, as Spark numbers them. A row's place is its place in its file plus the rows of
    the files before: rows are neither sorted nor shuffled, one task adds up one row a file.
    """
    rows = spark.read.parquet(path)
    file = F.col("_metadata.file_path")
    counts = rows.groupBy(file.alias("_tw_file")).agg(F.count(F.lit(1)).alias(_N))
    earlier = Window.orderBy("_tw_file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_tw_file", F.coalesce(F.sum(_N).over(earlier), F.lit(0)).alias(_N))
    placed = rows.select(*columns, file.alias("_tw_file"), F.col("_metadata.row_index").alias("_tw_index"))
    return placed.join(offsets, "_tw_file").select(*columns, (F.col(_N) + F.col("_tw_index") + 1).alias(name))
