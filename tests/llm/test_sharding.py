"""Shards against a line of all bytes, laid out and cut in Python."""

import zlib

import pytest
from llm_tables import SF_SMALL, documents

from tickwork.llm import sharding
from tickwork.llm.queries import op12_sharding


def brute(rows, shards=16):
    sized = sorted(((i is not None, i or 0, zlib.crc32((t or "").encode()), len((t or "").encode()) + 1, i) for i, t in rows))
    total, before, out, slots = sum(r[3] for r in sized), 0, [], {}
    target = -(-2 * total // shards)
    for _, _, crc, size, i in sized:
        shard = (2 * before + size) // target
        slots[shard] = slots.get(shard, -1) + 1
        out.append((i, size, crc, "bytes", shard, slots[shard], None))
        before += size
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_query_against_brute_force(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert got(op12_sharding(spark, SF_SMALL)) == brute(map(tuple, rows))


@pytest.mark.parametrize("shards, rows_a_range", [(16, 7), (1, 50), (5, 1000), (400, 3)])
def test_many_ranges_hot_ids_and_nulls(spark, shards, rows_a_range):
    rows = [(7, "same")] * 60 + [(None, None)] * 30 + [(None, "x" * k) for k in range(9)] + [(k % 40 - 5, "é" * (k % 13)) for k in range(90)] + [(1, "long " * 300)]
    docs = documents(spark, rows).repartition(5)
    assert got(sharding.shard_rows(docs, shards, rows_a_range=rows_a_range)) == brute(rows, shards)


def test_shards_are_near_their_target(spark):
    docs = documents(spark, [(k, "w" * (k * 37 % 500)) for k in range(3000)])
    sums = [r["b"] for r in sharding.shard_rows(docs).groupBy("shard").agg({"size": "sum"}).withColumnRenamed("sum(size)", "b").collect()]
    assert len(sums) == 16 and max(sums) - min(sums) <= 2 * 501


def test_written_shards(spark, tmp_path):
    docs = documents(spark, [(k, f"text {k}" * (k % 5)) for k in range(200)] + [(None, None)])
    back = spark.read.parquet(sharding.write_shards(docs, f"{tmp_path}/shards", 4))
    rows = back.select("shard", "slot", "doc.*").collect()
    placed = {(r["shard"], r["slot"]): r["doc_id"] for r in sharding.shard_rows(docs, 4).collect()}
    assert {(r["shard"], r["slot"]): r["doc_id"] for r in rows} == placed
    assert sorted(map(str, docs.collect())) == sorted(str(r["doc"]) for r in back.collect())


def test_edges(spark):
    docs = documents(spark, [(1, "a"), (2, None), (3, "")])
    assert got(sharding.shard_rows(docs)) == brute([(1, "a"), (2, None), (3, "")])
    empty = sharding.shard_rows(docs.where("false"))
    assert empty.count() == 0 and empty.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    with pytest.raises(ValueError):
        sharding.shard_rows(docs, 0)


def test_no_python_worker(spark):
    plan = sharding.shard_rows(documents(spark, [(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
