from conftest import rows, ts
from pyspark.sql import functions as F

from tickwork.operators import PARTITIONED, Layout, daily_to_hourly_proxy, hourly_bars, join_activity, resample_ffill
from tickwork.plans import build_features


def _bars(spark, hours):
    data = [(ts(f"2024-01-01 {h:02d}:00:00"), float(h)) for h in hours]
    return spark.createDataFrame(data, "ts_hour timestamp_ntz, close_1h double")


def test_g11_left_join_keeps_rows_and_fans_out(spark):
    bars = _bars(spark, [1, 2, 3])
    act = spark.createDataFrame([(ts("2024-01-01 02:00:00"), 5.0), (ts("2024-01-01 03:00:00"), 6.0),
                                 (ts("2024-01-01 03:00:00"), 7.0)], "ts_hour timestamp_ntz, tx double")
    out = sorted(rows(join_activity(bars, act), "close_1h", "tx"), key=str)
    assert out == sorted([(1.0, None), (2.0, 5.0), (3.0, 6.0), (3.0, 7.0)], key=str)
    assert join_activity(bars, act).columns == ["ts_hour", "close_1h", "tx"]
    assert join_activity(bars, None) is bars
    assert join_activity(bars, act, enabled=False) is bars


def test_g14_forward_fill_daily_to_hourly(spark):
    daily = spark.createDataFrame([(ts("2018-01-01 00:00:00"), 1.0), (ts("2018-01-02 00:00:00"), 2.0),
                                   (ts("2018-01-04 00:00:00"), 5.0)], "Date timestamp_ntz, Volume double")
    for layout in (PARTITIONED, Layout(), Layout(block_rows=1, chunk="day")):
        out = resample_ffill(daily, ts="Date", layout=layout)
        got = dict(rows(out, "Date", "Volume"))
        assert len(got) == 73
        assert got[ts("2018-01-03 12:00:00")] == 2.0
        assert max(got) == ts("2018-01-04 00:00:00") and got[max(got)] == 5.0


def test_forward_fill_snaps_to_the_grid_and_keeps_the_latest(spark):
    seen = [("00:30:00", 1.0), ("03:15:00", 2.0), ("03:40:00", 3.0), ("05:00:00", 4.0), ("05:00:00", 5.0)]
    df = spark.createDataFrame([(ts(f"2024-01-01 {t}"), v) for t, v in seen] + [(None, 9.0)], "t timestamp_ntz, v double")
    out = sorted(rows(resample_ffill(df, ts="t"), "t", "v"))
    assert out == [(ts(f"2024-01-01 {h:02d}:00:00"), v) for h, v in enumerate([1.0, 1.0, 1.0, 3.0, 3.0, 5.0])]
    assert resample_ffill(df, ts="t", out_ts="at").columns == ["at", "v"]


def test_forward_fill_of_a_long_gap_and_instants(spark):
    df = spark.createDataFrame([(0, 1.0), (86400 * 40 + 30, 2.0)], "s long, v double").select(F.timestamp_seconds("s").alias("t"), "v")
    out = resample_ffill(df, ts="t", step="1 minute")
    assert out.count() == 40 * 1440 + 1 and out.distinct().count() == out.count()
    assert out.dtypes == [("t", "timestamp"), ("v", "double")]


def test_forward_fill_takes_any_column_and_sorts_no_observation(spark):
    import random

    from tickwork.operators import latest_rows
    from tickwork.plans.explain import plan_text

    rng = random.Random(2)
    data = [(rng.choice(["a", None]), rng.randrange(600), rng.choice(["x", "yy", None]), [rng.randrange(3)], {"k": rng.randrange(3)}, rng.randrange(4)) for _ in range(300)]
    df = spark.createDataFrame(data, "key string, s long, text string, list array<int>, map map<string,int>, n int").withColumn("t", F.timestamp_seconds("s")).drop("s")
    steps = df.withColumn("step", F.floor(F.unix_seconds("t") / 60))
    without_map = latest_rows(steps, ["key", "step"], "t", ["n", "text", "list"])
    want = {}
    for key, s, text, some, _, n in data:
        row = (s, n, text is not None, text or "", some)
        if (key, s // 60) not in want or row > want[key, s // 60]:
            want[key, s // 60] = row
    got = {(r["key"], r["step"]): (r["n"], r["text"], r["list"]) for r in without_map.collect()}
    assert got == {k: (n, text if some_text else None, some) for k, (_, n, some_text, text, some) in want.items()}
    filled = resample_ffill(df, ts="t", keys=["key"], step="1 minute")
    assert filled.columns == df.columns
    assert filled.count() == sum(max(s for k, s in want if k == key) - min(s for k, s in want if k == key) + 1 for key in ("a", None))
    assert all(r["map"]["k"] in (0, 1, 2) for r in filled.collect())
    narrow = df.select("key", "t", "n")
    assert "SortAggregate" not in plan_text(latest_rows(narrow.withColumn("step", F.floor(F.unix_seconds("t") / 60)), ["key", "step"], "t", ["n"]), "simple")


def test_activity_rows_without_a_time_stay(spark):
    from tickwork.sources import align_activity

    df = spark.createDataFrame([("2024-01-01 05:10:00", 1), (None, 2)], "timestamp string, n int")
    assert sorted((str(r.ts_hour), r.n) for r in align_activity(df).collect()) == [("2024-01-01 05:00:00", 1), ("None", 2)]


def test_proxy_columns(spark):
    daily = spark.createDataFrame([(ts("2018-01-01 00:00:00"), 240000.0)], "Date timestamp_ntz, Volume double")
    (r,) = daily_to_hourly_proxy(daily, ts="Date").collect()
    assert (r["timestamp"], r["total_value_hour"], r["tx_count_hour"], r["block_count"]) == \
        ("2018-01-01 00:00:00", 10000.0, 1.0, 6)


def test_g12_spring_change_in_paris(spark):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
    try:
        texts = [f"2022-03-27 {h:02d}:15:00" for h in range(24)]
        ticks = spark.createDataFrame([(t,) for t in texts], "s string").select(
            F.to_timestamp("s").alias("ts_raw"), F.lit(1.0).alias("v")).selectExpr(
            "ts_raw", "v AS open", "v AS high", "v AS low", "v AS close", "v AS volume")
        assert hourly_bars(ticks).count() == 23  # 02:15 does not exist; two local hours share one bar
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    ticks_utc = spark.createDataFrame([(ts(t),) for t in texts], "ts_raw timestamp_ntz").selectExpr(
        "ts_raw", "1.0 AS open", "1.0 AS high", "1.0 AS low", "1.0 AS close", "1.0 AS volume")
    assert hourly_bars(ticks_utc).count() == 24


def test_build_features_columns(spark):
    data = [(ts(f"2024-01-{1 + h // 24:02d} {h % 24:02d}:00:00"), float(100 + h % 7)) for h in range(60)]
    ticks = spark.createDataFrame(data, "ts_raw timestamp_ntz, v double").selectExpr(
        "ts_raw", "v AS open", "v AS high", "v AS low", "v AS close", "v AS volume")
    act = spark.createDataFrame([("2024-01-01 05:00:00", 3.0)], "timestamp string, tx_count_hour double") \
        .withColumn("ts_hour", F.col("timestamp").cast("timestamp_ntz"))
    out = build_features(ticks, act)
    assert out.columns == ["ts_hour", "open_1h", "close_1h", "high_1h", "low_1h", "vol_1h", "volatility_1h",
                           "ret_1h", "high_low_ratio", "ret_1h_lag1", "ret_1h_lag2", "ma_close_3h",
                           "ma_close_12h", "vol_24h", "timestamp", "tx_count_hour", "close_future",
                           "return_future", "label_up"]
    assert out.count() == 59


def test_k2_proxy_sink_and_o1_sorted_features(spark):
    from tickwork.sinks import scratch_path, write_features, write_proxy

    daily = spark.createDataFrame([(ts("2018-01-02 00:00:00"), 48.0), (ts("2018-01-01 00:00:00"), 24.0)],
                                  "Date timestamp_ntz, Volume double")
    path = scratch_path(spark, "test_proxy")
    write_proxy(daily_to_hourly_proxy(daily, ts="Date"), path)
    back = spark.read.parquet(path)
    assert back.columns == ["timestamp", "total_value_hour", "tx_count_hour", "block_count"]
    texts = [r[0] for r in back.collect()]
    assert len(texts) == 25 and texts == sorted(texts)
    feats = spark.createDataFrame([("b", 2), ("a", 3), ("a", 1), ("b", 1)], "k string, t int").withColumn(
        "ts_hour", F.expr("timestamp_seconds(t * 3600)")).coalesce(1)
    fpath = scratch_path(spark, "test_features")
    write_features(feats, fpath, keys=["k"])
    assert [(r["k"], r["t"]) for r in spark.read.parquet(fpath).collect()] == [("a", 1), ("b", 1), ("b", 2), ("a", 3)]


def test_join_projects_the_right_side(spark):
    bars = _bars(spark, [1, 2])
    act = spark.createDataFrame([(ts("2024-01-01 01:00:00"), 5.0, "x", 9)],
                                "ts_hour timestamp_ntz, tx double, note string, n int")
    out = join_activity(bars, act, columns=["tx"])
    assert out.columns == ["ts_hour", "close_1h", "tx"]
    assert sorted(rows(out, "close_1h", "tx"), key=str) == [(1.0, 5.0), (2.0, None)]


def test_ffill_with_observations_closer_than_a_step(spark):
    daily = spark.createDataFrame([(ts("2018-01-01 00:00:00"), 1.0), (ts("2018-01-01 00:30:00"), 2.0),
                                   (ts("2018-01-01 02:00:00"), 3.0)], "Date timestamp_ntz, Volume double")
    got = sorted(rows(resample_ffill(daily, ts="Date"), "Date", "Volume"))
    # the latest observation of a step counts, and is repeated up to the step before the next one
    assert got == [(ts("2018-01-01 00:00:00"), 2.0), (ts("2018-01-01 01:00:00"), 2.0), (ts("2018-01-01 02:00:00"), 3.0)]
