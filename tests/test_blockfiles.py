import io
import os
import struct

import pytest

from conftest import rows

from tickwork.operators import hourly_block_stats, total_blocks
from tickwork.sinks import scratch_path
from tickwork.sinks.blockfiles import encode_block, encode_count, write_block_files
from tickwork.sinks.scratch import local_fs_path
from tickwork.sources import read_block_files
from tickwork.sources.blockfiles import MAGICS, frame_heads


def _folder(spark, files: dict[str, bytes]) -> str:
    path = scratch_path(spark, "test_blocks")
    local = local_fs_path(path)
    for name, body in files.items():
        full = os.path.join(local, name)
        os.makedirs(os.path.dirname(full), exist_ok=True)
        with open(full, "wb") as f:
            f.write(body)
    return path


def _frame(payload: bytes, magic: bytes = MAGICS[0]) -> bytes:
    return magic + struct.pack("<I", len(payload)) + payload


def _heads(body: bytes):
    return list(frame_heads(io.BytesIO(body), len(body)))


def test_g25_count_widths():
    for first, n, width in [(0xFC, 0xFC, 1), (0xFD, 0x1234, 3), (0xFE, 0x12345678, 5), (0xFF, 0x1234567890, 9)]:
        enc = encode_count(n)
        assert enc[0] == first and len(enc) == width
        assert _heads(encode_block(9, n) + encode_block(10, 1)) == [(9, n), (10, 1)]


def test_count_cut_off_by_its_payload_is_skipped():
    assert _heads(_frame(bytes(80) + b"\xfd\x01") + encode_block(7, 3)) == [(7, 3)]
    assert _heads(_frame(bytes(80) + b"\xfd\x01\x01")) == [(0, 257)]


def test_payloads_are_not_read():
    body = b"".join(_frame(encode_block(k, k)[8:] + bytes(100_000)) for k in range(5))

    class Counting(io.BytesIO):
        n = 0

        def read(self, size=-1):
            part = super().read(size)
            Counting.n += len(part)
            return part

    assert list(frame_heads(Counting(body), len(body))) == [(k, k) for k in range(5)]
    assert Counting.n <= 5 * 97


@pytest.mark.parametrize("method", ["binaryFile", "stream"])
def test_largest_counts_are_kept(spark, method):
    body = encode_block(1600000000, (1 << 64) - 1)
    (r,) = read_block_files(spark, _folder(spark, {"blk00000.dat": body}), method=method).collect()
    assert int(r["tx_count"]) == (1 << 64) - 1


@pytest.mark.parametrize("method", ["binaryFile", "stream"])
def test_folder_without_block_files_and_missing_folder(spark, method):
    path = _folder(spark, {"other.txt": b"x"})
    assert read_block_files(spark, path, method=method).count() == 0
    with pytest.raises(Exception, match="(?i)not found|no such|non-existent|does not exist|cannot list"):
        read_block_files(spark, path + "-missing", method=method).count()


@pytest.mark.parametrize("method", ["binaryFile", "stream"])
def test_g22_two_blocks_then_zero_padding(spark, method):
    body = encode_block(1600000000, 5) + encode_block(1600000100, 7, MAGICS[1]) + bytes(100)
    stats = hourly_block_stats(read_block_files(spark, _folder(spark, {"blk00000.dat": body}), method=method))
    assert rows(stats) == [("2020-09-13 12:00:00", 2, 12, 0.0)]


def test_g23_short_payload_is_skipped(spark):
    body = encode_block(1600000000, 5) + _frame(bytes(80)) + encode_block(1600000100, 7)
    assert _heads(body) == [(1600000000, 5), (1600000100, 7)]


def test_g24_truncated_last_frame_is_ignored(spark):
    body = encode_block(1600000000, 5) + encode_block(1600003600, 7)[:-3]
    assert _heads(body) == [(1600000000, 5)]


def test_stream_reader_packs_small_files(spark):
    files = {f"blk{i:05d}.dat": encode_block(1600000000 + i, i) for i in range(6)}
    from tickwork.sources.blockfiles import BlockFileSource

    spark.dataSource.register(BlockFileSource)
    path = _folder(spark, files)
    packed = spark.read.format("blockfiles").option("maxPartitionBytes", 200).load(path)
    assert packed.rdd.getNumPartitions() == 3  # ~90-byte files, two per 200-byte partition
    assert sorted(r[0] for r in rows(packed, "tx_count")) == list(range(6))


@pytest.mark.parametrize("method", ["binaryFile", "stream"])
def test_glob_and_recursion(spark, method):
    path = _folder(spark, {"a/blk00001.dat": encode_block(1600000000, 1), "b/c/blk00002.dat":
                           encode_block(1600000000, 2), "rev00001.dat": encode_block(1600000000, 50)})
    (r,) = hourly_block_stats(read_block_files(spark, path, method=method)).collect()
    assert (r["block_count"], r["tx_count_hour"]) == (2, 3)


@pytest.mark.parametrize("method", ["binaryFile", "stream"])
def test_g26_no_blocks_gives_empty_table_with_columns(spark, method):
    path = _folder(spark, {"blk00000.dat": bytes(64)})
    stats = hourly_block_stats(read_block_files(spark, path, method=method))
    assert stats.columns == ["timestamp", "block_count", "tx_count_hour", "total_value_hour"]
    assert stats.count() == 0
    assert rows(total_blocks(stats)) == [(0,)]


def test_writer_reader_roundtrip(spark):
    df = spark.createDataFrame([(1600000000 + i * 600, i) for i in range(50)] + [(1700000000, 300)],
                               "block_time long, tx_count long")
    path = scratch_path(spark, "test_writer")
    manifest = write_block_files(df.repartition(3), path, rows_per_file=7)
    assert sum(r[1] for r in rows(manifest)) == 51
    assert all(r[1] <= 7 for r in rows(manifest))
    back = read_block_files(spark, path)
    assert back.count() == 51
    streamed = read_block_files(spark, path, method="stream")
    assert sorted(rows(streamed, "block_time", "tx_count")) == sorted(rows(back, "block_time", "tx_count"))
    assert sorted(rows(back, "block_time", "tx_count"))[-1] == (1700000000, 300)


def test_k1_empty_stats_still_write_four_columns(spark):
    from tickwork.sinks import write_hourly_stats

    path = _folder(spark, {"blk00000.dat": bytes(64)})
    stats = hourly_block_stats(read_block_files(spark, path))
    out = scratch_path(spark, "test_empty_stats")
    write_hourly_stats(stats, out)
    back = spark.read.parquet(out)
    assert back.dtypes == [("timestamp", "string"), ("block_count", "bigint"), ("tx_count_hour", "bigint"),
                           ("total_value_hour", "double")]
    assert back.count() == 0
