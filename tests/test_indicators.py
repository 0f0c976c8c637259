import datetime as dt
import math

import pytest
from conftest import rows, ts

from tickwork.operators import (
    PARTITIONED,
    Layout,
    add_indicators,
    lagged_returns,
    moving_averages,
    rolling_volatility,
)

LAYOUTS = [PARTITIONED, Layout(), Layout(block_rows=2, chunk="day")]


def _bars(spark, closes, hours=None):
    hours = hours or list(range(len(closes)))
    data = [(ts("2024-01-01 00:00:00") + dt.timedelta(hours=h), float(c)) for h, c in zip(hours, closes)]
    return spark.createDataFrame(data, "ts_hour timestamp_ntz, close_1h double").selectExpr(
        "ts_hour", "close_1h", "close_1h AS high_1h", "close_1h AS low_1h")


@pytest.mark.parametrize("layout", LAYOUTS)
def test_g4_moving_average_partial_leading_frames(spark, layout):
    out = rows(moving_averages(_bars(spark, [10, 20, 60, 30]), windows=(3,), layout=layout).orderBy("ts_hour"),
               "ma_close_3h")
    assert [r[0] for r in out] == pytest.approx([10, 15, 30, 36.666666666666664])


@pytest.mark.parametrize("layout", LAYOUTS)
def test_g5_log_return_and_lags(spark, layout):
    out = rows(lagged_returns(_bars(spark, [1, 2, 4, 8]), layout=layout).orderBy("ts_hour"),
               "ret_1h", "ret_1h_lag1", "ret_1h_lag2")
    ln2 = math.log(2)
    assert out[0] == (None, None, None)
    assert out[1][0] == pytest.approx(ln2) and out[1][1:] == (None, None)
    assert out[2][0] == pytest.approx(ln2) and out[2][1] == pytest.approx(ln2) and out[2][2] is None
    assert all(v == pytest.approx(ln2) for v in out[3])


@pytest.mark.parametrize("layout", LAYOUTS)
def test_g3_rolling_deviation_first_row_null(spark, layout):
    out = rows(rolling_volatility(_bars(spark, [1, 2, 4]), layout=layout).orderBy("ts_hour"), "vol_24h")
    assert out[0][0] is None and out[1][0] == pytest.approx(math.sqrt(0.5))


@pytest.mark.parametrize("layout", LAYOUTS)
def test_g8_row_frames_cross_gaps(spark, layout):
    out = rows(lagged_returns(_bars(spark, [1, 2, 8], hours=[10, 11, 15]), layout=layout).orderBy("ts_hour"),
               "ret_1h")
    assert out[2][0] == pytest.approx(math.log(8 / 2))  # previous *row* is 11:00


def test_g18_log_of_non_positive_ratio_is_null(spark):
    out = rows(lagged_returns(_bars(spark, [1, -1, 0])).orderBy("ts_hour"), "ret_1h")
    assert [r[0] for r in out] == [None, None, None]


def test_indicator_set_columns(spark):
    out = add_indicators(_bars(spark, list(range(1, 30))))
    assert out.columns[-7:] == ["ret_1h", "high_low_ratio", "ret_1h_lag1", "ret_1h_lag2", "ma_close_3h",
                                "ma_close_12h", "vol_24h"]


def test_g17_zero_low_raises_under_ansi(spark):
    bars = _bars(spark, [1, 2]).selectExpr("ts_hour", "close_1h", "high_1h", "0.0 AS low_1h")
    with pytest.raises(Exception, match="(?i)divi"):
        add_indicators(bars, layout=PARTITIONED).collect()


@pytest.mark.parametrize("layout", LAYOUTS)
def test_time_frames_stop_at_gaps(spark, layout):
    bars = _bars(spark, [1, 2, 8, 10], hours=[10, 11, 15, 16])
    out = rows(moving_averages(bars, windows=(3,), frame="time", layout=layout).orderBy("ts_hour"), "ma_close_3h")
    assert [r[0] for r in out] == pytest.approx([1, 1.5, 8, 9])  # 15:00 sees only 13:00-15:00
    rows_frame = rows(moving_averages(bars, windows=(3,), layout=layout).orderBy("ts_hour"), "ma_close_3h")
    assert rows_frame[2][0] == pytest.approx(11 / 3)  # the row frame reaches back over the gap
    vol = rows(rolling_volatility(bars, window=2, frame="time", layout=layout).orderBy("ts_hour"), "vol_2h")
    assert vol[2][0] is None and vol[3][0] == pytest.approx(math.sqrt(2))


def test_unknown_frame_is_an_error(spark):
    with pytest.raises(ValueError):
        moving_averages(_bars(spark, [1, 2]), frame="calendar", layout=PARTITIONED)
