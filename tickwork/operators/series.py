"""Ordered per-series windows without a single-partition sort.

Every row-frame indicator of the library (lags, leads, moving averages,
rolling deviations) is a window ordered by time within one series. Written
the obvious way -- ``Window.partitionBy(*keys).orderBy(ts)`` -- the whole of a
series lands in one task, and with no keys at all Spark plans a
single-partition exchange over the entire table. That is the bottleneck the
source pipeline accepted; here it is avoided with an exact *block + halo*
layout expressed in plain DataFrame operations:

1. ``_chunk`` = a coarse calendar chunk of the order column (monotonic, so a
   chunk is a contiguous run of each series; see :func:`chunk_of`). Count rows per
   ``(keys, _chunk)`` -- partially aggregated map-side, a table orders of
   magnitude smaller than the rows.
2. On that small table only: running row offsets per series, blocks of whole
   chunks (``offset div block_rows``, numbered without gaps), and for every chunk
   the range of blocks that need a copy of it as *halo*: a later block if it
   starts fewer than ``back`` rows after the chunk ends, or at most
   ``back_seconds`` after it; an earlier one if it ends fewer than ``ahead`` rows
   before the chunk starts (see :func:`chunk_blocks`).
3. Join the rows to that chunk -> blocks table (Spark picks the strategy by
   measured size) -- one row per target block -- and evaluate the windows with
   ``partitionBy(*keys, block).orderBy(ts)``; keep each row only in its home
   block.

Keyed series that fit one block need neither chunks nor halo: their rows go
straight to the block of their key, and only those of longer series are counted
by chunk and joined. There is this one plan for series of every length. A window partition holds
at most ``block_rows`` rows plus one chunk (blocks are whole chunks), plus the
halo chunks, however long a series is. A key holding a third of all bars is
split into many blocks; nothing is dropped or sampled. A chunk is bounded by its
calendar length over the bar size (see :func:`layout_for_bar_size`). Row frames
are covered by ``back``/``ahead`` in rows, time frames by ``back_seconds``,
whatever the bar size, so results equal those of the global window (tests G28,
keyed run = one run per key).

The input is read twice (counts, rows). Left lazy, Catalyst prunes the two
branches differently, the exchanges are not reused and the input's whole
lineage -- typically a full scan and aggregation of the raw ticks -- runs
twice. So the input (bars: orders of magnitude smaller than ticks) is
written once as a Parquet table in the cluster's shared checkpoint folder
(``spark.checkpoint.dir``) and read back; that also cuts the lineage, so a
lost executor costs a re-read of that table, not a re-scan of the ticks.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tickwork.functions.time import interval_seconds




@dataclass(frozen=True)
class Specs:
    """Window specs handed to column builders: same partitioning, two orders.

    ``rows`` is ordered by the order column (+ tiebreak): row frames, lag, lead.
    ``time`` is ordered by whole epoch seconds of the order column, for
    ``rangeBetween`` frames in seconds (time frames).
    """

    rows: WindowSpec
    time: WindowSpec


ColumnBuilder = Callable[[Specs], Column]

_BLK = "_tw_blk"
_HOME = "_tw_home"
_CHUNK = "_tw_chunk"
_CNT = "_tw_n"
_CB = "_tw_cb"  # rows of the series before the chunk
_CA = "_tw_ca"  # rows up to and including the chunk
_T0 = "_tw_t0"  # first whole second of the chunk


@dataclass(frozen=True)
class Layout:
    """How ordered per-series windows are laid out across tasks.

    ``blocked=True`` (default) uses the block + halo scheme above: one shuffle
    of the rows, bounded tasks, plus one Parquet write of the input and a few
    small stages over the chunk counts. ``False`` is the plain
    ``Window.partitionBy(*keys)`` (one task per key, one task in total without
    keys). ``chunk`` is one of hour/day/week/month/quarter/year; the order
    column must be a timestamp or date. ``materialize=False`` skips the
    Parquet write when the input is cheap to recompute;
    :func:`tickwork.sinks.scratch.drop_scratch` removes the tables written so far.
    """

    blocked: bool = True
    block_rows: int = 65536
    chunk: str = "month"
    materialize: bool = True

    def __post_init__(self) -> None:
        if self.block_rows < 1:
            raise ValueError("block_rows must be positive")


DEFAULT_LAYOUT = Layout()
PARTITIONED = Layout(blocked=False)

# Chunk units (see chunk_of), with their longest length in seconds.
_CHUNK_UNITS = (("hour", 3600), ("day", 86400), ("week", 7 * 86400), ("month", 31 * 86400), ("quarter", 92 * 86400),
                ("year", 366 * 86400))
_CLOCK_CHANGE = 7200  # by so many seconds a calendar chunk can be longer in a session zone
def layout_for_bar_size(size: str, min_rows: int = 256, **kw) -> Layout:
    """Blocked layout whose count chunks hold about ``min_rows`` bars or more (e.g. month for hourly bars,
    year for daily bars), so the chunk-count table stays small and each chunk is a bounded group."""
    bar = interval_seconds(size)
    chunk = next((u for u, sec in _CHUNK_UNITS if sec // bar >= min_rows), "year")
    return Layout(chunk=chunk, **kw)


def materialize(df: DataFrame, name: str = "series") -> DataFrame:
    """Write ``df`` once as a Parquet table in the shared folder and read it back.

    One job (a reliable ``checkpoint()`` runs the last stage twice: once for
    the eager count, once for the checkpoint write), columnar and compressed,
    and the re-read prunes columns and pushes filters. The folder is the
    cluster's ``spark.checkpoint.dir``, so the table outlives a lost executor.
    """
    from tickwork.sinks.scratch import scratch_path

    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)  # known schema: no inference job


def series_spec(keys: Sequence[str], order: Sequence[str | Column]) -> WindowSpec:
    """``Window.partitionBy(*keys).orderBy(*order)``; no keys = one global series."""
    return Window.partitionBy(*keys).orderBy(*order)


def epoch_seconds(df: DataFrame, col: str) -> Column:
    """Whole seconds since the epoch of a timestamp (NTZ as UTC wall clock), date or number column."""
    from tickwork.functions.time import epoch_seconds_ntz

    kind = dict(df.dtypes)[col]
    if kind == "timestamp_ntz":
        return epoch_seconds_ntz(col)
    if kind == "timestamp":
        return F.unix_seconds(F.col(col))
    if kind == "date":
        return F.unix_date(F.col(col)).cast("bigint") * 86400
    return F.col(col).cast("bigint")


def chunk_of(df: DataFrame, order: str, unit: str) -> Column:
    """Coarse, monotonic chunk key of the order column, without time-zone round trips.

    ``year``/``quarter``/``month``/``week`` truncate the calendar date, ``day`` is
    the date, ``hour`` counts whole hours since the epoch. For ``TIMESTAMP_NTZ`` the
    date is the wall-clock date; for instants it is the session-zone date, which
    never decreases as time goes on (also across clock changes).
    """
    if unit == "hour":
        return F.floor(epoch_seconds(df, order) / F.lit(3600))
    day = F.to_date(F.col(order))
    if unit == "day":
        return day
    if unit in ("week", "month", "quarter", "year"):
        return F.trunc(day, unit)
    raise ValueError(f"unsupported chunk unit: {unit!r}")


def _specs(df: DataFrame, keys: Sequence[str], order: str, tiebreak: Sequence[str]) -> Specs:
    return Specs(series_spec(keys, [order, *tiebreak]), series_spec(keys, [epoch_seconds(df, order)]))


def with_series_columns(
    df: DataFrame,
    columns: Sequence[tuple[str, ColumnBuilder]],
    *,
    keys: Sequence[str] = (),
    order: str = "ts_hour",
    tiebreak: Sequence[str] = (),
    back: int = 0,
    ahead: int = 0,
    back_seconds: int = 0,
    layout: Layout | None = None,
) -> DataFrame:
    """Add window columns evaluated over each time-ordered series.

    ``columns`` is an ordered list of ``(name, builder)``; a builder receives
    the ordered window specs (see :class:`Specs`) and returns the column, e.g.
    ``lambda s: F.lag("close_1h", 1).over(s.rows)``. All columns are
    added in one projection over the input columns (one ``Window`` operator),
    so a builder cannot refer to another builder's output -- write it over the
    inputs instead (``lag(x, k)`` of a return is a return of lagged closes).
    ``back``/``ahead`` must cover the furthest row any row frame reaches,
    ``back_seconds`` the longest time frame.
    """
    layout = layout or DEFAULT_LAYOUT
    keys = list(keys)
    if not layout.blocked:
        return _add(df, columns, _specs(df, keys, order, tiebreak))

    src = materialize(df) if layout.materialize else df
    rows, short = src, None
    if keys and layout.materialize:
        rows, short = _by_length(src, keys, layout.block_rows)
    chunked = rows.withColumn(_CHUNK, chunk_of(rows, order, layout.chunk))
    plan = chunk_blocks(chunked, keys, order, layout, back, ahead, back_seconds)
    alias = {k: f"_tw_k{i}" for i, k in enumerate([*keys, _CHUNK])}
    plan = plan.select(*[F.col(k).alias(a) for k, a in alias.items()], _HOME, _BLK)
    cond = [chunked[k].eqNullSafe(plan[a]) for k, a in alias.items()]
    spread = chunked.join(plan, cond, "inner").drop(*alias.values(), _CHUNK)
    if short is not None:
        spread = short.withColumns({_HOME: F.lit(1), _BLK: F.lit(1)}).unionByName(spread)
    # Hash the rows by block explicitly: whichever join strategy AQE picks, the
    # windows then never inherit the small table's single-partition layout.
    spread = spread.repartition(*[F.col(k) for k in keys], F.col(_BLK))
    specs = _specs(spread, [*keys, _BLK], order, tiebreak)
    return _add(spread, columns, specs).filter(F.col(_BLK) == F.col(_HOME)).drop(_BLK, _HOME)


def _by_length(src: DataFrame, keys: Sequence[str], block_rows: int) -> tuple[DataFrame, DataFrame]:
    """The rows of series that need more than one block, and those of the others.

    Only the keys of the long series are written: one for ``block_rows`` rows at most, so Spark sees how few they are.
    """
    alias = {k: f"_tw_s{i}" for i, k in enumerate(keys)}
    long = src.groupBy(*keys).agg(F.count(F.lit(1)).alias(_CNT)).filter(F.col(_CNT) > block_rows)
    long = materialize(long.select(*[F.col(k).alias(a) for k, a in alias.items()]), "long_series")
    cond = [src[k].eqNullSafe(long[a]) for k, a in alias.items()]
    return src.join(long, cond, "left_semi"), src.join(long, cond, "left_anti")


def _add(df: DataFrame, columns: Sequence[tuple[str, ColumnBuilder]], specs: Specs) -> DataFrame:
    names = {n for n, _ in columns}
    keep = [F.col(f"`{c}`") for c in df.columns if c not in names]
    return df.select(*keep, *[build(specs).alias(name) for name, build in columns])


def chunk_blocks(
    chunked: DataFrame, keys: Sequence[str], order: str, layout: Layout, back: int, ahead: int, back_seconds: int
) -> DataFrame:
    """Small table ``(*keys, _chunk, home block, target block)``: one row per block a chunk is sent to.

    Blocks are numbered without gaps, so what a chunk is sent to is a range of
    them. The last block that needs it holds the last chunk starting fewer than
    ``back`` rows after the next one does (a range frame over row offsets, read off
    the next chunk), or within ``back_seconds`` and one chunk length of its own
    start (a range frame over times). The first one holds the first chunk ending
    fewer than ``ahead`` rows before the previous one does.
    """
    keys = list(keys)
    counts = chunked.groupBy(*keys, _CHUNK).agg(F.count(F.lit(1)).alias(_CNT), F.min(epoch_seconds(chunked, order)).alias(_T0))
    in_order = Window.partitionBy(*keys).orderBy(_CHUNK)
    by = lambda c: Window.partitionBy(*keys).orderBy(c)
    before = F.coalesce(F.sum(_CNT).over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    c = counts.select(*keys, _CHUNK, _T0, before.alias(_CB), (before + F.col(_CNT)).alias(_CA))
    c = c.withColumn(_HOME, F.dense_rank().over(by(F.expr(f"{_CB} div {layout.block_rows}"))))
    first, last = [F.col(_HOME)], [F.col(_HOME)]
    if back > 0:
        c = c.withColumn("_tw_last", F.max(_HOME).over(by(_CB).rangeBetween(0, back - 1)))
        last.append(F.lead("_tw_last").over(in_order))
    if back_seconds > 0:
        length = dict(_CHUNK_UNITS)[layout.chunk] + _CLOCK_CHANGE
        last.append(F.max(_HOME).over(by(_T0).rangeBetween(0, length + back_seconds)))
    if ahead > 0:
        c = c.withColumn("_tw_first", F.min(_HOME).over(by(_CA).rangeBetween(-(ahead - 1), 0)))
        first.append(F.lag("_tw_first").over(in_order))
    lo = F.least(*first) if len(first) > 1 else first[0]
    hi = F.greatest(*last) if len(last) > 1 else last[0]
    c = c.select(*keys, _CHUNK, _HOME, lo.alias("_tw_lo"), hi.alias("_tw_hi"))
    return c.select(*keys, _CHUNK, _HOME, F.explode(F.sequence("_tw_lo", "_tw_hi")).alias(_BLK))
