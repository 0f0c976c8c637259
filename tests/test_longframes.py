"""Long frames against windows over whole series."""

import random
import statistics

import pytest
from conftest import rows, ts
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickwork.operators import Layout, long_frames
from tickwork.plans.explain import plan_text


def _series(spark, n, keys=("a", None), seed=1):
    rng = random.Random(seed)
    data = [(k, j * 3600 + rng.randrange(3600), j, rng.choice([None, rng.uniform(-5, 5) + 1000]) if rng.random() < 0.2 else rng.uniform(900, 1100)) for k in keys for j in range(n + (k is None) * 13)]
    return spark.createDataFrame(data, "k string, s long, j long, close_1h double").withColumn("ts_hour", F.timestamp_seconds("s").cast("timestamp_ntz")).drop("s")


def _window(df, keys, windows):
    for n in windows:
        w = Window.partitionBy(*keys).orderBy("ts_hour").rowsBetween(-(n - 1), 0)
        df = df.withColumns({f"frame_avg_{n}": F.avg("close_1h").over(w), f"frame_stddev_{n}": F.stddev_samp("close_1h").over(w), f"frame_min_{n}": F.min("close_1h").over(w), f"frame_max_{n}": F.max("close_1h").over(w)})
    return df


def _rounded(df):
    return sorted((tuple(round(v, 7) if isinstance(v, float) else v for v in r) for r in rows(df)), key=str)


@pytest.mark.parametrize("block_rows, windows", [(1, (2, 5)), (4, (9, 10, 11, 12, 13)), (7, (8, 100)), (16, (400,)), (1000, (30, 31))])
def test_frames_equal_windows(spark, block_rows, windows):
    df = _series(spark, 230)
    got = long_frames(df, windows, keys=["k"], block_rows=block_rows, layout=Layout(chunk="day"))
    want = _window(df, ["k"], windows)
    assert got.columns == want.columns and _rounded(got) == _rounded(want)


def test_one_series_without_keys_and_clashing_columns(spark):
    df = _series(spark, 150, keys=("a",)).withColumn("state", F.lit(1)).withColumn("n", F.lit(2)).withColumn("block", F.lit(3))
    assert _rounded(long_frames(df, (40,), block_rows=6)) == _rounded(_window(df, [], (40,)))


def test_deviation_keeps_its_digits(spark):
    """Prices near 1e9 that move by thousandths: a difference of sums of squares would be noise."""
    rng = random.Random(4)
    values = [1e9 + round(rng.random() / 100, 6) for _ in range(400)]
    df = spark.createDataFrame([(ts("2024-01-01 00:00:00"), k, v) for k, v in enumerate(values)], "t0 timestamp_ntz, j int, close_1h double").selectExpr("t0 + make_interval(0,0,0,0,j) AS ts_hour", "close_1h")
    got = dict(rows(long_frames(df, (100,), block_rows=8), "ts_hour", "frame_stddev_100"))
    for k, at in list(enumerate(sorted(got)))[1:]:
        exact = statistics.stdev(v - 1e9 for v in values[max(0, k - 99) : k + 1])
        assert abs(got[at] - exact) < 1e-6 + 1e-3 * exact


def test_empty_short_and_wrong(spark):
    df = _series(spark, 3, keys=("a",))
    assert long_frames(df.where("false"), (5,)).count() == 0
    assert _rounded(long_frames(df, (50,))) == _rounded(_window(df, [], (50,)))
    with pytest.raises(ValueError):
        long_frames(df, (1,))


def test_shuffled_rows_do_not_depend_on_the_frame(spark):
    """The same exchanges of rows for frames of 100 and of 100,000 rows, and one for the row where each frame begins."""
    df = _series(spark, 50)
    rows_exchanged = [plan_text(long_frames(df, (n,), keys=["k"], block_rows=64), "simple").count("Exchange hashpartitioning") for n in (100, 100_000)]
    assert rows_exchanged[0] == rows_exchanged[1]
