"""Plan-level checks of the scale properties the README claims."""

from conftest import SF_MID

import __spark_entry__ as E
from tickwork import tables
from tickwork.operators import hourly_bars, layout_for_bar_size
from tickwork.plans.explain import plan_text, single_partition_exchanges


def test_bars_push_filters_and_prune_columns(spark):
    text = plan_text(hourly_bars(tables.ticks(spark, SF_MID)), "formatted")
    assert "PushedFilters: [IsNotNull(ts)]" in text
    assert "ReadSchema: struct<ts:timestamp_ntz,value:double>" in text
    simple = plan_text(hourly_bars(tables.ticks(spark, SF_MID)), "simple")
    assert "partial_min_by" in simple and "HashAggregate" in simple and "SortAggregate" not in simple


def test_bars_with_ties_are_hash_aggregates(spark):
    simple = plan_text(E._large_bars(spark, SF_MID), "simple")
    assert "SortAggregate" not in simple and "partial_min_by" in simple
    text_tie = tables.ticks(spark, SF_MID, keyed=True)  # what doesn't fit into a number is ordered as a struct
    assert "SortAggregate" in plan_text(hourly_bars(text_tie, tiebreak=["event_type"]), "simple")


def test_activity_projection_reaches_the_scan(spark):
    text = plan_text(tables.activity(spark, SF_MID, "view"), "formatted")
    assert "EqualTo(event_type,view)" in text
    assert "props" not in text.split("ReadSchema:")[1].split("\n")[0]


def test_feature_plan_single_partition_only_over_counts(spark):
    df = E.queries()["feature_dataset"](spark, SF_MID)
    assert single_partition_exchanges(df) == 1
    simple = plan_text(df, "simple")
    assert simple.count("Exchange hashpartitioning(_tw_blk") == 1
    # one Window operator over the rows (the other two order the small per-chunk count table)
    row_windows = [l for l in simple.splitlines() if "Window [" in l and "_tw_blk" in l]
    assert len(row_windows) == 1


def test_layout_chunks_follow_bar_size():
    assert layout_for_bar_size("1 hour").chunk == "month"
    assert layout_for_bar_size("1 day").chunk == "year"
    assert layout_for_bar_size("1 minute").chunk == "day"
    assert layout_for_bar_size("5 minutes").chunk == "day"


def test_interval_parsing():
    from tickwork.operators.series import interval_seconds

    assert interval_seconds("1 hour") == 3600
    assert interval_seconds("15 minutes") == 900
    assert interval_seconds("2 days") == 172800
    assert interval_seconds("30 seconds") == 30
