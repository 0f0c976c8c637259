import pytest
from conftest import rows, ts

from tickwork.operators import PARTITIONED, Layout, add_labels

LAYOUTS = [PARTITIONED, Layout(), Layout(block_rows=2, chunk="day")]


def _bars(spark, closes):
    data = [(ts(f"2024-01-01 {h:02d}:00:00"), float(c)) for h, c in enumerate(closes)]
    return spark.createDataFrame(data, "ts_hour timestamp_ntz, close_1h double")


@pytest.mark.parametrize("layout", LAYOUTS)
def test_g6_threshold_is_strict_and_last_row_dropped(spark, layout):
    out = rows(add_labels(_bars(spark, [100, 100.05, 100.2, 100]), layout=layout).orderBy("ts_hour"),
               "label_up")
    assert [r[0] for r in out] == [0, 1, 0]


@pytest.mark.parametrize("layout", LAYOUTS)
def test_g7_horizon_drops_last_rows(spark, layout):
    n = 10
    out = add_labels(_bars(spark, range(1, n + 1)), horizon=3, layout=layout)
    assert out.count() == n - 3
    first = rows(out.orderBy("ts_hour"), "close_future")[0][0]
    assert first == 4.0


def test_threshold_parameter(spark):
    out = rows(add_labels(_bars(spark, [100, 100.05, 100.2]), threshold=0.0).orderBy("ts_hour"), "label_up")
    assert [r[0] for r in out] == [1, 1]


def test_label_type_is_int(spark):
    assert dict(add_labels(_bars(spark, [1, 2])).dtypes)["label_up"] == "int"


def test_horizon_must_be_positive(spark):
    with pytest.raises(ValueError):
        add_labels(_bars(spark, [1, 2]), horizon=0)
