"""One block file read in byte ranges equals the walk from its first byte."""

import io
import os
import random
import struct

import pytest
from conftest import rows
from test_blockfiles import _folder, _frame

from tickwork.sinks import scratch_path
from tickwork.sinks.blockfiles import encode_block, write_block_files
from tickwork.sinks.scratch import local_fs_path
from tickwork.sources import read_block_files
from tickwork.sources.blockfiles import MAGICS, frame_heads
from tickwork.sources.blocksplit import _tasks, guessed_entry, magics


def _walk(body: bytes):
    return sorted(frame_heads(io.BytesIO(body), len(body)))


def _split(spark, files: dict[str, bytes], split_bytes: int):
    found = read_block_files(spark, _folder(spark, files), split_bytes=split_bytes)
    return sorted((t, int(x)) for t, x in rows(found, "block_time", "tx_count"))


def _payload(rng, k: int, more: bytes = b"") -> bytes:
    return encode_block(k, rng.choice([3, 300, 70_000, 1 << 40]))[8:] + more


def _body(seed: int) -> bytes:
    """Frames whose payloads hold magics, whole frames and chains of frames, of any length, with short payloads between."""
    rng = random.Random(seed)
    out = []
    for k in range(120):
        inner = [b"", MAGICS[0] * 3, rng.randbytes(rng.randrange(900)), encode_block(7, 1), b"".join(encode_block(10**6 + j, j) for j in range(40)),
                 MAGICS[1] + struct.pack("<I", 1 << 31), _frame(bytes(3000))]
        out.append(_frame(_payload(rng, k, rng.choice(inner)) if rng.random() < 0.9 else bytes(rng.randrange(81)), rng.choice(MAGICS)))
    return b"".join(out)


@pytest.mark.parametrize("seed, split_bytes", [(1, 64), (2, 500), (3, 1500), (4, 7000), (5, 1)])
def test_payloads_that_hold_magics_and_chains(spark, seed, split_bytes):
    body = _body(seed)[: 200_000 if split_bytes > 64 else 9_000]
    assert _split(spark, {"blk00000.dat": body}, split_bytes) == _walk(body) != []


@pytest.mark.parametrize("tail", [bytes(5000), b"\x07" * 4000 + encode_block(9, 9) * 30, encode_block(5, 5)[:-2], MAGICS[0] + b"\xff\xff\xff\x7f" + bytes(2000)])
def test_damaged_tails(spark, tail):
    """What follows the break isn't read, though it holds frames; other files are."""
    body, other = _body(8) + tail, _body(9)
    assert _split(spark, {"blk00000.dat": body, "a/blk00001.dat": other, "blk00002.dat": encode_block(1, 2), "blk00003.dat": b""}, 700) == sorted(_walk(body) + _walk(other) + [(1, 2)])


def test_break_in_the_middle_and_at_the_start(spark):
    body = _body(10)
    broken = body[:30_000] + b"\0" + body[30_001:]
    assert _split(spark, {"blk00000.dat": broken}, 900) == _walk(broken)
    assert _split(spark, {"blk00000.dat": b"\0" + body}, 900) == []


def test_frames_longer_than_ranges(spark):
    rng = random.Random(2)
    body = b"".join(_frame(_payload(rng, k, b"".join(encode_block(99, j) for j in range(k * 7)))) for k in range(20))
    assert _split(spark, {"blk00000.dat": body}, 300) == _walk(body) and len(_walk(body)) == 20


def test_guesses_follow_chains():
    file = io.BytesIO(b"xx" + MAGICS[0] + b"\x01\0\0\0yz" + encode_block(1, 1) * 20)
    length = len(file.getvalue())
    assert list(magics(file, 0, 100, length))[:2] == [2, 12]
    assert guessed_entry(file, 1, 500, length) == 12  # the first magic's chain breaks
    assert guessed_entry(file, 13, 500, length) == 12 + 89
    assert guessed_entry(io.BytesIO(bytes(400)), 0, 400, 400) is None


def test_large_file_is_read_by_many_tasks(spark):
    """2 GB with payloads of a megabyte, of which almost nothing is written to the disk."""
    path = scratch_path(spark, "test_large")
    local = local_fs_path(path)
    os.makedirs(local)
    n, size = 2048, 1 << 20
    with open(f"{local}/blk00000.dat", "wb") as f:
        for k in range(n):
            f.seek(k * (size + 8))
            f.write(MAGICS[0] + struct.pack("<I", size) + encode_block(1_600_000_000 + k, k)[8:])
        f.truncate(n * (size + 8))
    found = read_block_files(spark, path, split_bytes=128 << 20)
    assert sorted(int(x) for x in (r[0] for r in rows(found, "tx_count"))) == list(range(n))
    files = [i for i in spark.read.parquet(*sorted({os.path.dirname(f) for f in found.inputFiles() if "frames" in f})).groupBy("part").count().collect()]
    assert len(files) == 16 and all(r["count"] == 128 for r in files)  # each range was read on its own


def test_ranges_of_written_files(spark):
    df = spark.createDataFrame([(1600000000 + i * 60, i) for i in range(3000)], "block_time long, tx_count long")
    path = scratch_path(spark, "test_ranges")
    write_block_files(df, path, rows_per_file=2000)
    with pytest.raises(ValueError):
        read_block_files(spark, path, split_bytes=0).count()
    one = read_block_files(spark, path, split_bytes=5000)
    assert sorted(rows(one, "block_time", "tx_count")) == sorted(rows(read_block_files(spark, path), "block_time", "tx_count"))


def test_small_ranges_share_tasks(spark):
    """The number of tasks follows from the bytes, not from the number of ranges; large ranges still have one each."""
    path = scratch_path(spark, "test_tasks")
    write_block_files(spark.range(4000).selectExpr("1600000000 + id * 60 AS block_time", "id AS tx_count"), path, rows_per_file=500)
    found = read_block_files(spark, path, split_bytes=512)
    assert len([f for f in found.inputFiles() if "frames" in f]) <= 8 < 4000 * 89 // 512
    assert sorted(rows(found, "block_time", "tx_count")) == sorted(rows(read_block_files(spark, path), "block_time", "tx_count"))
    assert [_tasks(16, 128 << 20, 8), _tasks(5, 1, 8), _tasks(216_000, 16 << 10, 200), _tasks(10**6, 16 << 10, 200), _tasks(0, 1, 8)] == [16, 5, 200, 489, 1]
