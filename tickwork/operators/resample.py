"""Forward fill on a grid (R1) and the daily-to-hourly proxy table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyspark.sql.types import ArrayType, MapType, StructType, TimestampNTZType, VariantType

from tickwork.functions.order import BITS, MOST_BITS, packed_order
from tickwork.functions.time import bucket_floor, epoch_seconds_ntz, epoch_to_utc_ntz, hour_text, interval_seconds
from tickwork.operators.series import Layout, layout_for_bar_size, with_series_columns

_STEP, _ROW, _NEXT, _ORDER = "_tw_step", "_tw_row", "_tw_next_ts", "_tw_order"


def latest_rows(df: DataFrame, by: Sequence[str], ts: str, others: Sequence[str]) -> DataFrame:
    """``*by, *others`` of the latest row of each group; of rows with equal times, the largest in the order of ``others``.

    Observations are never sorted. Time and columns of fixed width are packed into one number (``packed_order``), whose
    maximum is a hash aggregate with map-side combining. Where all columns fit into it, ``max_by`` takes them along.
    Otherwise the rows with the greatest number are fetched by a join on it, nearly always one a group, and only what
    is still equal then is compared as a whole (columns without an order, maps, by their JSON text).
    """
    kinds = {c: df.schema[c].dataType for c in (ts, *others)}
    fixed, left = [], MOST_BITS - BITS.get(type(kinds[ts]), MOST_BITS + 1)
    for c in others:
        left -= BITS.get(type(kinds[c]), MOST_BITS + 1)
        if left < 0:
            break
        fixed.append(c)
    order = packed_order(df, [ts, *fixed])
    if len(fixed) == len(others):
        numbered = df.select(*by, *others, order.alias(_ORDER))
        return numbered.groupBy(*by).agg(*(F.max_by(c, _ORDER).alias(c) for c in others))
    numbered = df.select(*by, F.struct(*others).alias(_ROW), order.alias(_ORDER))
    most = numbered.groupBy(*by).agg(F.max(_ORDER).alias(_ORDER))
    alias = {c: f"_tw_b{k}" for k, c in enumerate([*by, _ORDER])}
    top = most.select(*(F.col(c).alias(a) for c, a in alias.items()))
    met = numbered.join(top, [numbered[c].eqNullSafe(top[a]) for c, a in alias.items()], "left_semi")
    rank = F.to_json(_ROW) if any(_unordered(kinds[c]) for c in others) else F.col(_ROW)
    return met.groupBy(*by).agg(F.max_by(_ROW, rank).alias(_ROW)).select(*by, *(F.col(f"{_ROW}.`{c}`").alias(c) for c in others))


def _unordered(kind) -> bool:
    """Whether values of a type have no order: maps, also within arrays and structs."""
    if isinstance(kind, ArrayType):
        return _unordered(kind.elementType)
    return isinstance(kind, (MapType, VariantType)) or (isinstance(kind, StructType) and any(_unordered(f.dataType) for f in kind))


def resample_ffill(
    df: DataFrame,
    *,
    ts: str,
    keys: Sequence[str] = (),
    step: str = "1 hour",
    out_ts: str | None = None,
    layout: Layout | None = None,
) -> DataFrame:
    """Forward-fill a series onto a ``step`` grid.

    Times are floored to the epoch-aligned grid; of several observations in one
    step of a series the latest counts (of equal times the largest row, see
    :func:`latest_rows`). Each is repeated from its step up to the step before the next observation of its
    series; the last one yields one row. Missing periods are bridged by the latest
    earlier value. Rows without a time are dropped.

    Plan: hash aggregates per series and step (:func:`latest_rows`), ``lead(step)`` per series (block + halo layout, one row ahead), then
    two generators: first the days that a gap covers, then, after those rows are
    dealt out anew, the steps of each day, so neither one row nor one task expands a
    whole long gap of a fine step.
    """
    out_ts = out_ts or ts
    seconds = interval_seconds(step)
    ntz = isinstance(df.schema[ts].dataType, TimestampNTZType)
    others = [c for c in df.columns if c != ts and c not in keys]
    at = F.col(ts) if ntz else F.col(ts).cast("timestamp")
    steps_of = df.where(F.col(ts).isNotNull()).withColumn(_STEP, bucket_floor(at, step, ntz=ntz))
    latest = latest_rows(steps_of, [*keys, _STEP], ts, others)
    nxt = with_series_columns(latest, [(_NEXT, lambda s: F.lead(_STEP, 1).over(s.rows))], keys=keys, order=_STEP,
                              ahead=1, layout=layout or layout_for_bar_size(step))
    epoch = epoch_seconds_ntz if ntz else F.unix_seconds
    first = epoch(F.col(_STEP))
    last = F.coalesce(epoch(F.col(_NEXT)) - F.lit(seconds), first)
    chunk = F.lit(max(86400 // seconds, 1) * seconds)
    parts = nxt.select(*keys, *others, last.alias("_tw_last"), F.explode(F.sequence(first, last, chunk)).alias("_tw_first"))
    parts = parts.repartition(*keys, "_tw_first")
    until = F.least(F.col("_tw_last"), F.col("_tw_first") + chunk - F.lit(seconds))
    steps = parts.select(*keys, *others, F.explode(F.sequence("_tw_first", until, F.lit(seconds).cast("long"))).alias("_tw_at"))
    time = epoch_to_utc_ntz("_tw_at") if ntz else F.timestamp_seconds("_tw_at")
    order = [out_ts if c == ts else c for c in df.columns]
    return steps.withColumn(out_ts, time).select(*order)


# Fixed values of the proxy table: hours per day, count scale, constant block count.
HOURS_PER_DAY = 24.0
TX_SCALE = 10000.0
BLOCKS_PER_HOUR = 6


def daily_to_hourly_proxy(
    daily: DataFrame, *, ts: str, volume: str = "Volume", keys: Sequence[str] = (),
    layout: Layout | None = None,
) -> DataFrame:
    """R2: ``timestamp`` (text), ``total_value_hour = volume/24``,
    ``tx_count_hour = volume/24/10000``, ``block_count = 6`` per forward-filled hour."""
    hourly = resample_ffill(daily.select(*keys, ts, volume), ts=ts, keys=keys, layout=layout)
    per_hour = F.col(volume) / F.lit(HOURS_PER_DAY)
    return hourly.select(
        *keys,
        hour_text(ts).alias("timestamp"),
        per_hour.alias("total_value_hour"),
        (per_hour / F.lit(TX_SCALE)).alias("tx_count_hour"),
        F.lit(BLOCKS_PER_HOUR).cast("bigint").alias("block_count"),
    )
