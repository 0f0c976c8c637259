import pytest
from conftest import rows, ts
from pyspark.sql import functions as F

from tickwork.functions.time import bucket_start, truncate_hour
from tickwork.sinks import scratch_path
from tickwork.sources import align_activity, detect_time_column, load_activity, load_candles_csv, normalize_candles


def _raw(spark, data):
    return spark.createDataFrame(
        [(t, str(v), str(v), str(v), str(v), str(v)) for t, v in data],
        "`Open time` string, Open string, High string, Low string, Close string, Volume string",
    )


def test_g9_end_date_means_midnight(spark):
    raw = _raw(spark, [("2022-12-31 00:00:00", 1), ("2022-12-31 05:00:00", 2), ("2022-12-30 23:00:00", 3)])
    out = rows(normalize_candles(raw, start="2022-12-31", end="2022-12-31"), "close")
    assert out == [(1.0,)]


def test_csv_roundtrip_with_padding_and_mapping(spark):
    path = scratch_path(spark, "test_csv")
    spark.createDataFrame(
        [("  2024-01-01 10:00:00 ", "1.5", "2", "1", "1.75", "10", "x")],
        "`Open time` string, Open string, High string, Low string, Close string, Volume string, Extra string",
    ).write.option("header", True).csv(path)
    df = load_candles_csv(spark, path)
    assert df.columns == ["ts_raw", "open", "high", "low", "close", "volume"]
    (r,) = df.collect()
    assert r["open"] == 1.5 and r["close"] == 1.75 and r["volume"] == 10.0
    assert dict(df.dtypes)["ts_raw"] == "timestamp"


def test_custom_column_names(spark):
    raw = spark.createDataFrame([(" 2024-01-01 00:00:00", "1", "4", "0.5", "3", "7")],
                                "t string, o string, h string, l string, c string, v string")
    out = normalize_candles(raw, ts_col="t", columns={"o": "open", "h": "high", "l": "low", "c": "close",
                                                      "v": "volume"})
    assert out.columns == ["ts_raw", "open", "high", "low", "close", "volume"]
    assert rows(out, "open", "high", "low", "close", "volume") == [(1.0, 4.0, 0.5, 3.0, 7.0)]


def test_g17_strict_casts_raise(spark):
    with pytest.raises(Exception):
        normalize_candles(_raw(spark, [("2024-01-01 00:00:00", "x")])).collect()
    with pytest.raises(Exception):
        normalize_candles(_raw(spark, [("bad", 1)])).collect()


def test_g19_time_column_detection():
    assert detect_time_column(["Date", "Timestamp", "v"]) == "Timestamp"
    assert detect_time_column(["x", "DATETIME"]) == "DATETIME"
    with pytest.raises(ValueError, match="a, b"):
        detect_time_column(["a", "b"])


def test_activity_loader_and_optional_path(spark):
    assert load_activity(spark, None) is None
    path = scratch_path(spark, "test_activity")
    spark.createDataFrame([("2024-01-01 10:30:00", 6, 1.5)], "timestamp string, block_count long, tx double") \
        .write.parquet(path)
    (r,) = load_activity(spark, path).collect()
    assert r["ts_hour"] == ts("2024-01-01 10:00:00")


def test_g13_half_hour_zone_bucket_vs_trunc(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        df = spark.createDataFrame([("2024-01-01 10:10:00",)], "s string").select(F.col("s").cast("timestamp").alias("t"))
        (r,) = df.select(bucket_start("t").alias("w"), truncate_hour("t").alias("d")).select(
            F.date_format("w", "HH:mm").alias("w"), F.date_format("d", "HH:mm").alias("d")).collect()
        assert (r["w"], r["d"]) == ("09:30", "10:00")
        # both join sides use bucket_start, so they agree
        a = align_activity(spark.createDataFrame([("2024-01-01 10:10:00",)], "timestamp string"))
        (x,) = a.select(F.date_format("ts_hour", "HH:mm").alias("h")).collect()
        assert x["h"] == "09:30"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_landed_candles_prune_date_partitions(spark):
    from tickwork.plans.explain import plan_text
    from tickwork.sources import land_candles, load_candles_parquet

    raw = _raw(spark, [(f"2022-12-{d:02d} {h:02d}:00:00", d * 100 + h) for d in (29, 30, 31) for h in (0, 5)])
    path = scratch_path(spark, "test_land")
    land_candles(normalize_candles(raw), path)
    out = load_candles_parquet(spark, path, start="2022-12-30", end="2022-12-31")
    assert sorted(r[0] for r in rows(out, "close")) == [3000.0, 3005.0, 3100.0]
    text = plan_text(out, "formatted")
    assert "PartitionFilters: [isnotnull(date" in text and "PushedFilters" in text
