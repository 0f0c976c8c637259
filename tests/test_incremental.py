"""Feature runs in steps equal one run over everything."""

import pytest
from conftest import SF_SMALL, rows
from pyspark.sql import functions as F

from tickwork import tables
from tickwork.plans import build_features, features_step
from tickwork.plans.incremental import DONE


def _sorted(df):
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows(df)), key=str)


@pytest.mark.parametrize("horizon, cuts", [(1, ["2024-01-16"]), (3, ["2024-01-01 05:00:00", "2024-01-02", "2024-01-02 01:00:00", "2024-01-20"]), (2, ["2024-01-10", "2024-01-10"])])
def test_steps_equal_one_run(spark, horizon, cuts):
    """Also where a step brings fewer bars than the horizon, or none."""
    ticks, act = tables.ticks(spark, SF_SMALL, keyed=True), tables.activity(spark, SF_SMALL, "view")
    kw = {"keys": ["event_type"], "horizon": horizon, "on_zero": "null"}
    want = build_features(ticks, act, **kw)
    at, carry, got = F.col("ts_raw"), None, []
    for low, high in zip([None, *cuts], [*cuts, None]):
        part = ticks if low is None else ticks.where(at >= F.lit(low))
        part = part if high is None else part.where(at < F.lit(high))
        out, carry = features_step(part, carry, act, **kw)
        assert out.columns == want.columns
        got += _sorted(out)
    assert sorted(got, key=str) == _sorted(want)


def test_carry_is_bounded_and_history_is_not_read(spark):
    ticks = tables.ticks(spark, SF_SMALL, keyed=True)
    _, carry = features_step(ticks.where(F.col("ts_raw") < F.lit("2024-01-25")), keys=["event_type"], on_zero="null")
    most = carry.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col(DONE)).alias("open")).collect()
    assert all(r["n"] == 24 and r["open"] == 1 for r in most)
    out, _ = features_step(ticks.where("false"), carry, keys=["event_type"], on_zero="null")
    assert out.count() == 0 and all("events" not in f for f in out.inputFiles())


def test_unfinished_bars_are_left(spark):
    ticks = tables.ticks(spark, SF_SMALL)
    kw = {"on_zero": "null"}
    cut = F.col("ts_raw") < F.lit("2024-01-16 10:30:00")  # in the middle of a bar, which is read again
    first, carry = features_step(ticks.where(cut), until="2024-01-16 10:00:00", **kw)
    second, _ = features_step(ticks.where(F.col("ts_raw") >= F.lit("2024-01-16 10:00:00")), carry, **kw)
    assert sorted(_sorted(first) + _sorted(second), key=str) == _sorted(build_features(ticks, **kw))
