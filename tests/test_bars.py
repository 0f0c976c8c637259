import math

import pytest
from conftest import rows, ts

from tickwork.operators import hourly_bars, ohlcv_bars

G1 = [("2024-01-01 10:00:00", 5.0), ("2024-01-01 10:20:00", 9.0), ("2024-01-01 10:59:59", 3.0),
      ("2024-01-01 11:00:00", 4.0)]


def _ticks(spark, data):
    df = spark.createDataFrame([(ts(t), v) for t, v in data], "ts_raw timestamp_ntz, v double")
    return df.selectExpr("ts_raw", "v AS open", "v AS high", "v AS low", "v AS close", "v AS volume")


def test_g1_bar_values(spark):
    out = rows(hourly_bars(_ticks(spark, G1)).orderBy("ts_hour"))
    (h10, o, c, hi, lo, vol, sd), (h11, *rest) = out
    assert h10 == ts("2024-01-01 10:00:00") and (o, c, hi, lo, vol) == (5.0, 3.0, 9.0, 3.0, 17.0)
    assert sd == pytest.approx(math.sqrt(56 / 9))
    assert h11 == ts("2024-01-01 11:00:00") and rest == [4.0, 4.0, 4.0, 4.0, 4.0, 0.0]


def test_g2_one_row_per_hour_has_zero_volatility(spark):
    data = [(f"2024-01-01 {h:02d}:00:00", float(h + 1)) for h in range(5)]
    vols = [r[0] for r in rows(hourly_bars(_ticks(spark, data)), "volatility_1h")]
    assert vols == [0.0] * 5


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_g27_bars_do_not_depend_on_partitioning(spark, parts):
    base = sorted(rows(hourly_bars(_ticks(spark, G1))))
    shuffled = _ticks(spark, G1).repartition(parts)
    assert sorted(rows(hourly_bars(shuffled))) == base


def test_tiebreak_orders_equal_timestamps(spark):
    # two ticks at the same instant: the tiebreak column decides open and close
    df = spark.createDataFrame(
        [(ts("2024-01-01 00:00:00"), 2, 7.0), (ts("2024-01-01 00:00:00"), 1, 9.0),
         (ts("2024-01-01 00:30:00"), 1, 1.0)], "ts_raw timestamp_ntz, k int, v double",
    ).selectExpr("ts_raw", "k", "v AS open", "v AS high", "v AS low", "v AS close", "v AS volume")
    for parts in (1, 3):
        (o, c), = rows(ohlcv_bars(df.repartition(parts), tiebreak=["k"]), "open_1h", "close_1h")
        assert (o, c) == (9.0, 1.0)


def test_null_time_rows_are_dropped(spark):
    df = _ticks(spark, G1).union(spark.createDataFrame([(None, 1.0, 1.0, 1.0, 1.0, 1.0)], _ticks(spark, G1).schema))
    assert hourly_bars(df).count() == 2


def test_daily_bars_and_keys(spark):
    df = spark.createDataFrame(
        [("a", ts("2024-01-01 03:00:00"), 1.0), ("a", ts("2024-01-01 20:00:00"), 2.0),
         ("b", ts("2024-01-01 05:00:00"), 5.0)], "k string, ts_raw timestamp_ntz, v double",
    ).selectExpr("k", "ts_raw", "v AS open", "v AS high", "v AS low", "v AS close", "v AS volume")
    out = sorted(rows(ohlcv_bars(df, keys=["k"], size="1 day", out_ts="ts_day", suffix="_1d"),
                      "k", "ts_day", "open_1d", "close_1d", "vol_1d"))
    assert out == [("a", ts("2024-01-01 00:00:00"), 1.0, 2.0, 3.0), ("b", ts("2024-01-01 00:00:00"), 5.0, 5.0, 5.0)]


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_tied_ticks_do_not_depend_on_partitioning(spark, parts):
    """Equal times: the smallest value opens and the largest closes, negative and tiny values too."""
    data = [(ts(f"2024-01-01 {h:02d}:00:00"), v) for h in range(3) for v in (7.0, -2.5, 1e-300, 0.0, 7.0000000000000009, 1e18)]
    df = spark.createDataFrame(data, "ts_raw timestamp_ntz, v double").repartition(parts)
    df = df.selectExpr("ts_raw", "v AS open", "v AS high", "v AS low", "v AS close", "v AS volume")
    assert rows(hourly_bars(df), "open_1h", "close_1h") == [(-2.5, 1e18)] * 3


def test_double_rank_sorts_like_doubles(spark):
    import random

    from pyspark.sql import functions as F

    from tickwork.functions.order import double_rank

    rng = random.Random(1)
    values = [0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 1e-310, 1.7976931348623157e308, float("inf"), -float("inf")]
    values += [rng.choice([1, -1]) * math.exp(rng.uniform(-700, 700)) for _ in range(300)]
    values += [f(2.0**k, 9e300) for k in range(-1000, 1000, 37) for f in (math.nextafter, lambda x, _: x)]
    got = spark.createDataFrame([(v,) for v in values], "v double").select("v", double_rank(F.col("v")).alias("r")).collect()
    in_order = sorted(got, key=lambda x: x.v)
    assert all((a.v < b.v) == (a.r < b.r) for a, b in zip(in_order, in_order[1:]))
