"""Contiguous shards of nearly equal bytes: global prefix sums of sizes, cut at equal targets. DataFrame functions only.

Rows are put into order by ranges, one partition a range. Each partition's total
of bytes and rows is one row of a small table, whose running totals are the
partitions' offsets; within a partition a window adds up what is before a row.
Both together are a row's place on the line of all bytes. The line is cut at
equal targets, and a row belongs to the shard that its middle lies in: a shard
is off its target by at most half a row at each end. Only ids, sizes and
checksums are shuffled, not texts.

A row number, written once, ends the order: no two rows are equal in it, so a
range is never larger because one id or text is frequent. Ranges hold about
``ROWS_A_RANGE`` rows, and the offsets that are broadcast grow with their number
only (16 bytes for a million rows).

Shards follow the law ``bytes``: ``grown_shard`` is null, as one more shard moves
all cuts. Equal texts are rows like all others and are held apart by a cut.

Defined results: a null text has no bytes, size 1 and the checksum of nothing;
null ids come first. Rows with equal ids are in the order of checksum and size;
rows equal in these too are interchangeable. With fewer rows than shards some
shards are empty. An empty table gives an empty table. Further columns are left
out by ``shard_rows`` and kept, as a struct, by ``write_shards``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickwork.llm.common import written

SHARDS = 16
ROWS_A_RANGE = 1_000_000


def _placed(docs: DataFrame, shards: int, id_col: str, text_col: str, rows_a_range: int, keep: bool) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot; with ``keep`` also doc, the whole row."""
    if shards < 1 or rows_a_range < 1:
        raise ValueError("shards and ranges hold something")
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    whole = [F.struct(*docs.columns).alias("doc")] if keep else []
    order = ["doc_id", "text_crc32", "size", "row"]
    sized = written(docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(text).alias("text_crc32"), F.monotonically_increasing_id().alias("row"), *whole), "sized")
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-sized.count() // rows_a_range))
    ranged = written(sized.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()), "ranged")

    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    totals = ranged.groupBy("part").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    sums = totals.select("part", *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in ("bytes", "rows")), F.sum("bytes").over(Window.partitionBy()).alias("total"))
    inside = Window.partitionBy("part").orderBy(*order)
    own = F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    lined = ranged.withColumns({"own_bytes": own, "own_row": F.row_number().over(inside) - 1}).join(F.broadcast(sums), "part")
    shard = F.expr(f"(2 * (bytes_before + own_bytes) + size) div ((2 * total + {shards - 1}) div {shards})")  # middle and target, both twice
    placed = written(lined.select("doc_id", "size", "text_crc32", shard.cast("int").alias("shard"), (F.col("rows_before") + F.col("own_row")).alias("place"), *(["doc"] if keep else [])), "placed")
    firsts = placed.groupBy("shard").agg(F.min("place").alias("first"))  # one row a shard
    return placed.join(F.broadcast(firsts), "shard").withColumn("slot", F.col("place") - F.col("first")).drop("place", "first")


def shard_rows(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text", rows_a_range: int = ROWS_A_RANGE) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row."""
    placed = _placed(docs, shards, id_col, text_col, rows_a_range, keep=False)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, folder: str, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text", rows_a_range: int = ROWS_A_RANGE) -> str:
    """Write every row (column ``doc``) with its ``slot`` to ``folder``/shard=K, each file in the order of slots."""
    placed = _placed(docs, shards, id_col, text_col, rows_a_range, keep=True)
    placed.select("shard", "slot", "doc").repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(folder)
    return folder
