"""Averages, deviations and extremes over long row frames (W4-W6) without copying rows.

The block + halo layout (:mod:`tickwork.operators.series`) copies the rows that a
frame reaches back over into each block: for frames much shorter than a block a
small price, for a frame of 100,000 bars several copies of every row. Here no row
is copied, whatever the frame's length:

1. Rows get their position in the series (row counts by calendar chunk, added
   up) and so a block of ``block_rows`` positions.
2. Within a block two running windows give, at each row, the moments and extremes
   of the block up to the row and from the row on. Moments are count, mean and sum
   of squared deviations, so nothing is a difference of large sums.
3. A frame is the end of one block, whole blocks, and the beginning of another.
   The state of a block is one small row; runs of 2, 4, 8, ... blocks are merged by
   doubling, and as many whole blocks as a frame holds are a few of those runs.
4. A row meets the row in which its frame begins by position: an equi-join.

Rows are shuffled four times (by chunk, by block, and both sides of the join),
independent of the frames' lengths; one task holds a block or a chunk.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickwork.operators.series import Layout, chunk_of, layout_for_bar_size, materialize

BLOCK_ROWS = 65536
_POS, _BLOCK, _OFF, _CHUNK, _VALUE = "_tw_pos", "_tw_block", "_tw_off", "_tw_chunk", "_tw_x"
FIGURES = ("avg", "stddev", "min", "max")


def merge_runs(states: Column) -> Column:
    """``struct(n, mean, m2, lo, hi)`` of an array of such structs, the earliest first; NULL and empty ones are passed over."""
    none = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"), F.lit(None).cast("double").alias("lo"), F.lit(None).cast("double").alias("hi"))

    def both(a: Column, b: Column) -> Column:
        n, off = a.n + b.n, b["mean"] - a["mean"]
        whole = F.struct(n.alias("n"), (a["mean"] + off * b.n / n).alias("mean"), (a.m2 + b.m2 + off * off * a.n * b.n / n).alias("m2"), F.least(a.lo, b.lo).alias("lo"), F.greatest(a.hi, b.hi).alias("hi"))
        return F.when(F.coalesce(b.n, F.lit(0)) == 0, a).otherwise(whole)

    return F.aggregate(states, none, both)


def _state(window) -> Column:
    x = F.col(_VALUE)
    n = F.count(x).over(window)
    return F.struct(n.alias("n"), F.avg(x).over(window).alias("mean"), (F.var_pop(x).over(window) * n).alias("m2"), F.min(x).over(window).alias("lo"), F.max(x).over(window).alias("hi"))


def with_series_positions(df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk: str, name: str) -> DataFrame:
    """``df`` (written) with the 0-based position of each row in its series; ``order[0]`` is the time, the rest breaks ties."""
    chunked = df.withColumn(_CHUNK, chunk_of(df, order[0], chunk))
    counts = chunked.groupBy(*keys, _CHUNK).agg(F.count(F.lit(1)).alias("_tw_n"))
    earlier = Window.partitionBy(*keys).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)  # one row a chunk
    alias = {k: f"_tw_k{i}" for i, k in enumerate([*keys, _CHUNK])}
    offsets = counts.select(*(F.col(k).alias(a) for k, a in alias.items()), F.coalesce(F.sum("_tw_n").over(earlier), F.lit(0)).alias("_tw_before"))
    joined = chunked.join(offsets, [chunked[k].eqNullSafe(offsets[a]) for k, a in alias.items()])
    inside = Window.partitionBy(*keys, _CHUNK).orderBy(*order)
    return joined.withColumn(name, F.col("_tw_before") + F.row_number().over(inside) - 1).drop(*alias.values(), "_tw_before", _CHUNK)


def _whole_runs(blocks: DataFrame, keys: Sequence[str], counts: Sequence[int]) -> DataFrame:
    """keys, block, run_k: the merged state of the ``k`` blocks before, for each ``k`` of ``counts``; missing ones are empty.

    Blocks of a series have all numbers from 0 on, so the state some blocks back is a lag.
    """
    w = Window.partitionBy(*keys).orderBy(_BLOCK)
    out, empty = blocks.withColumnRenamed("state", "_tw_lvl0"), F.lit(None)
    runs = {k: (f"_tw_run{k}", 0) for k in counts}  # column, blocks merged so far
    for name, _ in runs.values():
        out = out.withColumn(name, empty.cast(blocks.schema["state"].dataType))
    level, length = "_tw_lvl0", 1
    while length <= max(counts):
        for k, (name, done) in runs.items():
            if k & length:  # this run of blocks comes before those merged so far
                out = out.withColumn("_tw_more", F.lag(level, done + 1).over(w)).withColumn(name, merge_runs(F.array("_tw_more", name))).drop("_tw_more")
                runs[k] = (name, done + length)
        out = out.withColumn("_tw_more", F.lag(level, length).over(w)).withColumn(level, merge_runs(F.array("_tw_more", level))).drop("_tw_more")
        length *= 2
    return out.select(*keys, _BLOCK, *(name for name, _ in runs.values()))


def long_frames(
    bars: DataFrame,
    windows: Sequence[int],
    *,
    value: str = "close_1h",
    keys: Sequence[str] = (),
    order: str = "ts_hour",
    tiebreak: Sequence[str] = (),
    name: str = "frame",
    size: str = "1 hour",
    layout: Layout | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``bars`` with ``{name}_{figure}_{n}`` for each figure and frame length ``n``: the current and the n - 1 rows before.

    Figures are the average, the sample deviation (NULL over fewer than two values), the least and the greatest. Frames at
    the beginning of a series are shorter, NULL values aren't counted, as in a window. ``order`` and ``tiebreak`` together
    order a series; rows equal in them are in any order.
    """
    if min(windows) < 2 or block_rows < 1:
        raise ValueError("a frame has two rows at least, and a block has rows")
    keys, block_rows = list(keys), min(block_rows, min(windows) - 1)  # a frame then always reaches into an earlier block
    layout = layout or layout_for_bar_size(size)
    src = materialize(bars) if layout.materialize else bars
    rows = with_series_positions(src, keys, [order, *tiebreak], layout.chunk, _POS)
    rows = rows.withColumns({_BLOCK: F.expr(f"{_POS} div {block_rows}"), _OFF: F.col(_POS) % block_rows, _VALUE: F.col(value).cast("double")})
    block = Window.partitionBy(*keys, _BLOCK)
    states = rows.withColumns({"_tw_until": _state(block.orderBy(_POS).rowsBetween(Window.unboundedPreceding, 0)), "_tw_from": _state(block.orderBy(F.desc(_POS)).rowsBetween(Window.unboundedPreceding, 0))})
    states = materialize(states.drop(_VALUE), "frames")

    # frame of n rows: its first row is (n - 1) div B blocks earlier, or one more if its offset is below the rest
    back = {n: divmod(n - 1, block_rows) for n in windows}
    counts = sorted({q + k for q, _ in back.values() for k in (-1, 0)} - {0})
    runs = _whole_runs(states.where(F.col(_OFF) == 0).select(*keys, _BLOCK, F.col("_tw_from").alias("state")), keys, counts) if counts else None
    out, alias = states, [f"_tw_k{i}" for i in range(len(keys))]
    match = lambda a, b: [a[k].eqNullSafe(b[x]) for k, x in zip(keys, alias)]
    if runs is not None:
        small = runs.select(*(F.col(k).alias(a) for k, a in zip(keys, alias)), F.col(_BLOCK).alias("_tw_b"), *runs.columns[len(keys) + 1:])
        out = out.join(small, [*match(out, small), out[_BLOCK] == small["_tw_b"]]).drop(*alias, "_tw_b")
    found: list[Column] = []
    for n in windows:
        first = states.select(*(F.col(k).alias(a) for k, a in zip(keys, alias)), (F.col(_POS) + (n - 1)).alias("_tw_at"), F.col("_tw_from").alias(f"_tw_first{n}"))
        out = out.join(first, [*match(out, first), out[_POS] == first["_tw_at"]], "left").drop(*alias, "_tw_at")
        q, rest = back[n]
        run = lambda k: F.col(f"_tw_run{k}") if k else F.lit(None).cast(states.schema["_tw_from"].dataType)
        middle = F.when(F.col(_OFF) >= rest, run(q - 1)).otherwise(run(q))
        out = out.withColumn(f"_tw_s{n}", merge_runs(F.array(F.col(f"_tw_first{n}"), middle, F.col("_tw_until"))))
        s = F.col(f"_tw_s{n}")
        some = s.n > 0
        found += [F.when(some, s["mean"]).alias(f"{name}_avg_{n}"), F.when(s.n > 1, F.sqrt(F.greatest(s.m2, F.lit(0.0)) / (s.n - 1))).alias(f"{name}_stddev_{n}"), s.lo.alias(f"{name}_min_{n}"), s.hi.alias(f"{name}_max_{n}")]
    return out.select(*bars.columns, *found)
