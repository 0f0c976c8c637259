"""Block + halo layout: identical to the plain window; no single-partition exchange over rows."""

import pytest
from conftest import SF_MID, rows
from pyspark.sql import functions as F

from tickwork import tables
from tickwork.operators import PARTITIONED, Layout, add_indicators, add_labels, hourly_bars, moving_averages, ohlcv_bars, rolling_volatility
from tickwork.plans.explain import plan_text
from tickwork.operators.series import with_series_columns


def _events_bars(spark, keyed=False):
    return hourly_bars(tables.ticks(spark, SF_MID, keyed), keys=["event_type"] if keyed else [])


def _same(a, b, cols):
    ra = sorted(rows(a, *cols), key=str)
    rb = sorted(rows(b, *cols), key=str)
    assert len(ra) == len(rb)
    for x, y in zip(ra, rb):
        assert x == pytest.approx(y, rel=1e-12, nan_ok=True) if all(
            isinstance(v, (float, type(None))) for v in x) else x == y


@pytest.mark.parametrize("block_rows,chunk", [(100, "day"), (24, "month"), (1000, "week")])
def test_g28_blocked_equals_global(spark, block_rows, chunk):
    bars = _events_bars(spark)
    plain = add_labels(add_indicators(bars, layout=PARTITIONED), layout=PARTITIONED)
    blocked = add_labels(add_indicators(bars, layout=Layout(block_rows=block_rows, chunk=chunk)),
                         layout=Layout(block_rows=block_rows, chunk=chunk))
    cols = [c for c in plain.columns if c != "ts_hour"]
    _same(plain.select("ts_hour", *cols), blocked.select("ts_hour", *cols), ["ts_hour", *cols])


def test_keyed_blocked_equals_one_run_per_key(spark):
    bars = _events_bars(spark, keyed=True)
    keyed = add_indicators(bars, keys=["event_type"], layout=Layout(block_rows=50, chunk="day"))
    for k in ["view", "click"]:
        single = add_indicators(bars.filter(F.col("event_type") == k), layout=PARTITIONED)
        cols = ["event_type", "ts_hour", "ret_1h", "ret_1h_lag2", "ma_close_12h", "vol_24h"]
        _same(keyed.filter(F.col("event_type") == k), single, cols)


def test_blocks_widen_to_cover_the_halo(spark):
    df = spark.range(12).withColumn("ts_hour", F.expr("timestamp_seconds(id * 3600)"))
    out = with_series_columns(df, [("x", lambda s: F.lag("id", 5).over(s.rows))], back=5,
                              layout=Layout(block_rows=2, chunk="day"))
    assert sorted(rows(out, "id", "x")) == [(i, i - 5 if i >= 5 else None) for i in range(12)]


def test_plan_has_no_single_partition_exchange_over_rows(spark):
    text = plan_text(add_indicators(_events_bars(spark)), "simple")
    # Single-partition exchanges may only sit directly above the per-chunk count aggregate.
    parts = text.split("Exchange SinglePartition")[1:]
    assert parts, "expected the (small) count table to be ordered globally"
    for p in parts:
        assert "HashAggregate(keys=[_tw_chunk" in p.split("\n")[1]
    assert "hashpartitioning(_tw_blk" in text


def test_partitioned_layout_without_keys_is_single_partition(spark):
    text = plan_text(add_indicators(_events_bars(spark), layout=PARTITIONED), "simple")
    assert "Exchange SinglePartition" in text


def test_hot_key_is_split_into_bounded_blocks(spark):
    """One key holds most rows: the blocked layout spreads it over many window partitions."""
    from tickwork.operators.series import _BLK, _CHUNK, chunk_blocks

    hot = spark.range(3000).select(F.lit("hot").alias("k"), F.expr("timestamp_seconds(id * 3600)").alias("ts_hour"),
                                    (F.col("id") + 1).cast("double").alias("close_1h"))
    cold = spark.range(50).select(F.lit("cold").alias("k"), F.expr("timestamp_seconds(id * 3600)").alias("ts_hour"),
                                   (F.col("id") + 1).cast("double").alias("close_1h"))
    bars = hot.union(cold)
    layout = Layout(block_rows=200, chunk="day")
    chunked = bars.withColumn(_CHUNK, F.to_date("ts_hour"))
    plan = chunk_blocks(chunked, ["k"], "ts_hour", layout, 23, 1, 0)
    sizes = (chunked.join(plan, ["k", _CHUNK]).groupBy("k", _BLK).count())
    hot_sizes = [r["count"] for r in sizes.filter(F.col("k") == "hot").collect()]
    assert len(hot_sizes) >= 3000 // 200 - 1
    assert max(hot_sizes) <= 200 + 24 + 24 + 24  # a block, plus a day of halo on each side
    blocked = add_labels(add_indicators(bars.withColumn("high_1h", F.col("close_1h") + 1).withColumn(
        "low_1h", F.col("close_1h") + 1), keys=["k"], layout=layout), keys=["k"], layout=layout)
    plain = add_labels(add_indicators(bars.withColumn("high_1h", F.col("close_1h") + 1).withColumn(
        "low_1h", F.col("close_1h") + 1), keys=["k"], layout=PARTITIONED), keys=["k"], layout=PARTITIONED)
    cols = ["k", "ts_hour", "ret_1h", "ret_1h_lag2", "ma_close_12h", "vol_24h", "close_future", "label_up"]
    _same(blocked, plain, cols)


def test_null_keys_blocked_equals_plain(spark):
    data = [(k, i, float(i % 7 + 1)) for k in (None, "a") for i in range(40)]
    bars = spark.createDataFrame(data, "k string, i int, close_1h double").withColumn(
        "ts_hour", F.expr("timestamp_seconds(i * 3600)")).withColumn("high_1h", F.col("close_1h")).withColumn(
        "low_1h", F.col("close_1h"))
    blocked = add_indicators(bars, keys=["k"], layout=Layout(block_rows=7, chunk="day"))
    plain = add_indicators(bars, keys=["k"], layout=PARTITIONED)
    cols = ["k", "ts_hour", "ret_1h", "ret_1h_lag2", "ma_close_12h", "vol_24h"]
    _same(blocked, plain, cols)
    assert blocked.filter(F.col("k").isNull()).count() == 40


def test_keyed_forward_fill_across_blocks(spark):
    from tickwork.operators import resample_ffill

    data = [(k, d, float(d * 10 + len(k))) for k in ("x", "yy") for d in (0, 1, 4, 5, 9)]
    daily = spark.createDataFrame(data, "k string, d int, Volume double").withColumn(
        "Date", F.expr("timestamp_seconds(d * 86400)")).drop("d")
    a = resample_ffill(daily, ts="Date", keys=["k"], layout=Layout(block_rows=2, chunk="day"))
    b = resample_ffill(daily, ts="Date", keys=["k"], layout=PARTITIONED)
    assert sorted(rows(a, "k", "Date", "Volume")) == sorted(rows(b, "k", "Date", "Volume"))
    assert a.filter(F.col("k") == "x").count() == 9 * 24 + 1


def test_blocked_layout_without_aqe_or_broadcast(spark):
    """A chunk table that is too large to broadcast is joined by sort-merge, with the same result."""
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        bars = _events_bars(spark, keyed=True)
        blocked = add_indicators(bars, keys=["event_type"], layout=Layout(block_rows=60, chunk="day"))
        assert "SortMergeJoin" in plan_text(blocked, "simple")
        plain = add_indicators(bars, keys=["event_type"], layout=PARTITIONED)
        _same(blocked, plain, ["event_type", "ts_hour", "ret_1h", "ret_1h_lag2", "ma_close_12h", "vol_24h"])
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_hour_chunks_are_monotonic_across_a_clock_change(spark):
    """NTZ wall-clock times inside a spring-forward gap keep their order in the layout."""
    spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
    try:
        times = ["2024-03-31 01:40:00", "2024-03-31 02:20:00", "2024-03-31 02:50:00", "2024-03-31 03:10:00",
                 "2024-03-31 04:00:00"]
        df = spark.createDataFrame([(t, float(i + 1)) for i, t in enumerate(times)], "s string, close_1h double") \
            .select(F.col("s").cast("timestamp_ntz").alias("ts_hour"), "close_1h")
        out = with_series_columns(df, [("prev", lambda s: F.lag("close_1h", 1).over(s.rows))], back=1,
                                  layout=Layout(block_rows=1, chunk="hour"))
        assert sorted(rows(out, "close_1h", "prev")) == [(1.0, None), (2.0, 1.0), (3.0, 2.0), (4.0, 3.0), (5.0, 4.0)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_one_plan_whatever_the_length_of_a_series(spark):
    bars = _events_bars(spark, keyed=True)  # five series of ~700 bars
    for block_rows in (100, 1000, 65536):
        text = plan_text(add_indicators(bars, keys=["event_type"], layout=Layout(block_rows=block_rows)), "simple")
        assert "_tw_blk" in text


@pytest.mark.parametrize("size", ["1 minute", "15 minutes", "1 hour", "4 hours"])
@pytest.mark.parametrize("step", [900, 3600])
@pytest.mark.parametrize("block_rows,chunk", [(96, "hour"), (50, "day"), (100_000, "month")])
def test_time_frames_do_not_depend_on_the_layout(spark, size, step, block_rows, chunk):
    """Frames in seconds reach as many bars as there are in them, whatever the bar size, block and chunk."""
    bars = ohlcv_bars(tables.ticks(spark, SF_MID, True), keys=["event_type"], size=size)
    bars = bars.where("event_type IN ('view', 'error') AND ts_hour < TIMESTAMP_NTZ '2024-01-09'")
    cols = ["event_type", "ts_hour", "ma_close_3h", "ma_close_12h", "vol_24h"]

    def frames(layout):
        kw = {"keys": ["event_type"], "frame": "time", "step": step, "layout": layout}
        return rolling_volatility(moving_averages(bars, **kw), **kw)

    _same(frames(Layout(block_rows=block_rows, chunk=chunk)), frames(PARTITIONED), cols)


def test_short_series_need_no_chunk_join(spark):
    """Rows of series that fit one block aren't joined with chunks; long and short series and null keys give the plain windows' values."""
    df = spark.range(900).selectExpr("CASE WHEN id % 9 = 0 THEN 'a' WHEN id % 9 = 1 THEN NULL WHEN id % 9 = 2 THEN 'c' ELSE 'long' END AS k", "id",
                                     "timestamp_seconds(id * 3600) AS ts_hour")
    cols = [("prev", lambda s: F.lag("id", 7).over(s.rows)), ("nxt", lambda s: F.lead("id", 2).over(s.rows))]
    run = lambda layout: with_series_columns(df, cols, keys=["k"], back=7, ahead=2, layout=layout)
    key = lambda r: r[1]
    want = sorted(rows(run(PARTITIONED), "k", "id", "prev", "nxt"), key=key)
    for block_rows in (5, 100, 599, 600, 65536):
        assert sorted(rows(run(Layout(block_rows=block_rows, chunk="day")), "k", "id", "prev", "nxt"), key=key) == want
    out = run(Layout(block_rows=65536, chunk="day"))
    out.collect()
    final = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "SortMergeJoin" not in final and "_tw_chunk" not in final
