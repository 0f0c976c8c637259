"""Positions, running totals and ranks, against sums in Python; no task gets all rows."""

import random
from decimal import Decimal

import pytest
from conftest import SF_SMALL, rows
from pyspark.sql import functions as F

import __spark_entry__ as E
from tickwork.operators import auc_by_ranks, file_positions, with_positions, with_running_totals
from tickwork.plans.evaluate import auc_roc
from tickwork.plans.explain import plan_text
from tickwork.sinks import scratch_path


@pytest.mark.parametrize("rows_a_range", [1, 7, 10_000])
def test_running_totals_equal_a_loop(spark, rows_a_range):
    rng = random.Random(3)
    data = [(rng.randrange(40), k, Decimal(rng.randrange(10**6)) / 100, rng.choice([None, rng.randrange(9)])) for k in range(300)]
    df = spark.createDataFrame(data, "a int, b int, money decimal(18,2), n int").repartition(5)
    out = with_running_totals(df, [F.desc("a"), "b"], {"money_before": F.col("money"), "n_before": F.col("n")}, position="at", rows_a_range=rows_a_range)
    want, money, n = [], Decimal(0), 0
    for at, (a, b, m, x) in enumerate(sorted(data, key=lambda r: (-r[0], r[1])), 1):
        want.append((a, b, money, n, at))
        money, n = money + m, n + (x or 0)
    assert sorted(rows(out, "a", "b", "money_before", "n_before", "at"), key=lambda r: r[-1]) == want


def test_equal_order_columns_are_dealt_to_several_ranges(spark):
    df = spark.createDataFrame([(1, k) for k in range(500)] + [(None, k) for k in range(100)], "a int, k int")
    out = with_positions(df, ["a"], rows_a_range=20)
    got = rows(out, "a", "position")
    assert sorted(p for _, p in got) == list(range(1, 601))
    assert all((p <= 100) == (a is None) for a, p in got)  # nulls first
    assert rows(out.orderBy("k", "a")) == rows(out.orderBy("k", "a"))


def test_empty_table_and_wrong_range(spark):
    df = spark.createDataFrame([], "a int")
    assert with_positions(df, ["a"]).collect() == []
    with pytest.raises(ValueError):
        with_positions(df, ["a"], rows_a_range=0)


@pytest.mark.parametrize("n", [2, 50, 400])
def test_auc_by_ranks_equals_pairs_and_the_evaluator(spark, n):
    rng = random.Random(n)
    data = [(rng.randrange(12) / 4, int(rng.random() < 0.4)) for _ in range(n)] + [(0.5, 1), (0.25, 0)]
    scored = spark.createDataFrame(data, "score double, label_up int")
    (auc,) = auc_by_ranks(scored, label="label_up", score="score", rows_a_range=2).first()
    up, down = [s for s, y in data if y], [s for s, y in data if not y]
    assert abs(auc - sum((a > b) + (a == b) / 2 for a in up for b in down) / (len(up) * len(down))) < 1e-12
    assert abs(auc - auc_roc(scored, raw="score")) < 1e-9
    assert auc_by_ranks(scored.where("label_up = 1"), label="label_up", score="score").first()[0] is None


def test_file_positions(spark):
    path = scratch_path(spark, "test_positions")
    spark.range(1000).repartitionByRange(7, "id").sortWithinPartitions("id").write.parquet(path)
    out = file_positions(spark, path, "id")
    assert sorted(rows(out)) == [(k, k + 1) for k in range(1000)]


@pytest.mark.parametrize("name", ["features_file_order", "stats_file_order", "running_totals", "auc_by_ranks"])
def test_no_query_sends_its_rows_through_one_task(spark, name):
    """What is exchanged into one partition are totals: a row a file, a range, or the final aggregate."""
    text = plan_text(E.queries()[name](spark, SF_SMALL), "simple")
    for part in text.split("Exchange SinglePartition")[1:]:
        below = part.split("Exchange")[0]
        assert "HashAggregate" in below.splitlines()[1], text
