"""Reading one block file with many tasks.

Where a frame begins follows only from the frames before it, so a file can't be
cut at any byte. Its byte ranges are read in three steps:

1. Every range guesses its first frame: the first place whose magic starts a
   chain of frames that runs on into the next range. A magic inside a payload
   starts a chain too, but nearly always one that breaks. The guessed chain's
   frames are written as a table, once, with range and offset. Heads only are
   read (see :mod:`tickwork.sources.blockfiles`), and the bytes up to the guess.
2. One row a range, the guess and where its chain leaves the range, is stitched
   along each file: the true chain starts at the file's first byte, and where it
   enters a range at the guessed place the two are one chain from there on (a
   frame's end depends on nothing else). Otherwise that range is walked again
   from its true entry. Ranges inside of one long frame, or behind the end of the
   chain, hold no frames.
3. Rows are the written frames of all rightly guessed ranges and the frames of
   those that were walked again.

The result is that of the walk from the first byte, whatever payloads hold and
wherever a file is damaged: a guess can only cost time. What one task gathers is
one row for each range of one file.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwork.fsutil import pyarrow_filesystem
from tickwork.sources.blockfiles import BLOCK_SCHEMA, COUNT_WIDTHS, FRAME_HEAD, FRAME_PREFIX, HEAD_LEN, HEADER_LEN, MAGICS

SPLIT_BYTES = 128 << 20
TASK_BYTES = 32 << 20  # small ranges are dealt to tasks of about so many bytes
_SEARCH = 1 << 20  # bytes read at a time in search of a magic
_BATCH = 8192  # frames in an Arrow batch
_HEADS = "path string, part int, at bigint, until bigint, block_time bigint, tx_count decimal(20,0)"
_RANGES = "path string, length bigint, part int, first bigint, last bigint"
# Of each range: its guess, and where the guessed chain goes on; null where it ends, or where nothing was found.
_STITCHED = "path string, length bigint, part int, entry bigint, last bigint, walk boolean"


def frame_at(file, at: int, length: int):
    """``(end, seconds, count)`` of the frame at ``at``, count None if its payload is too short; None without a frame."""
    if at + FRAME_PREFIX > length:
        return None
    file.seek(at)
    magic, size, seconds, count, more = struct.unpack(FRAME_HEAD, file.read(HEAD_LEN).ljust(HEAD_LEN, b"\0"))
    end = at + FRAME_PREFIX + size
    if magic not in MAGICS or end > length:
        return None
    width = COUNT_WIDTHS.get(count, 0)
    if size <= HEADER_LEN + width:
        return end, seconds, None
    return end, seconds, int.from_bytes(more[:width], "little") if width else count


def frames(file, at: int, last: int, length: int) -> Iterator[tuple]:
    """``(at, end, seconds, count)`` of the chain from ``at`` on, as far as frames begin before ``last``."""
    while at < last and (frame := frame_at(file, at, length)):
        yield at, *frame
        at = frame[0]


def magics(file, first: int, last: int, length: int) -> Iterator[int]:
    """Places from ``first`` up to ``last`` where a magic is, in order."""
    width = len(MAGICS[0])
    for base in range(first, last, _SEARCH):
        file.seek(base)
        body = file.read(min(base + _SEARCH, last, length) - base + width - 1)
        places = set()
        for magic in MAGICS:
            k = body.find(magic)
            while k >= 0:
                places.add(base + k)
                k = body.find(magic, k + 1)
        yield from sorted(p for p in places if p < last)


def guessed_entry(file, first: int, last: int, length: int) -> int | None:
    """The first place of the range whose chain leaves it; else that of the longest chain, the first of equals."""
    best, most, tried = None, 0, set()
    for p in magics(file, first, last, length):
        if p in tried:
            continue  # on a chain that was followed already and broke off
        at, n = p, 0
        for at, end, *_ in frames(file, p, last, length):
            tried.add(at)
            n += 1
            at = end
        if at >= last:
            return p
        if n > most:
            best, most = p, n
    return best


def _batches(found: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    rows: list[tuple] = []
    schema = pa.schema([("path", pa.string()), ("part", pa.int32()), ("at", pa.int64()), ("until", pa.int64()), ("block_time", pa.int64()), ("tx_count", pa.decimal128(20, 0))])

    def batch():
        *columns, count = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip([*columns, [None if c is None else Decimal(c) for c in count]], schema)], schema=schema)

    for row in found:
        rows.append(row)
        if len(rows) == _BATCH:
            yield batch()
            rows.clear()
    if rows:
        yield batch()


def _read(batches, base: str, guess: bool):
    """Frames of ranges (path, length, entry, last, part), from a guessed place or from the entry given."""
    filesystem, _ = pyarrow_filesystem(base)

    def found():
        for batch in batches:
            for r in batch.to_pylist():
                with filesystem.open_input_file(r["path"]) as file:
                    entry = r["entry"]
                    if guess and entry:
                        entry = guessed_entry(file, entry, r["last"], r["length"])
                    if entry is not None:
                        for frame in frames(file, entry, r["last"], r["length"]):
                            yield r["path"], r["part"], *frame

    return _batches(found())


def _stitch(batches, base: str):
    """The true entry of each range of the files given, and whether the range has to be walked from there.

    The rows of a file come in the order of its ranges.
    """
    filesystem, _ = pyarrow_filesystem(base)
    path, at = None, 0
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            if r["path"] != path:
                path, at = r["path"], 0
            if at is None or at >= r["last"]:
                continue
            entry, right = at, r["guess"] == at
            if right:
                at = r["until"]
            else:
                with filesystem.open_input_file(path) as file:
                    for _, at, *_ in frames(file, entry, r["last"], r["length"]):
                        pass
            if at < r["last"]:
                at = None  # the chain has ended
            out.append((path, r["length"], r["part"], entry, r["last"], not right))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.bool_()))], names=["path", "length", "part", "entry", "last", "walk"])


def _tasks(ranges: int, split_bytes: int, least: int) -> int:
    """Tasks for so many ranges: one each, but where ranges are small one for ``TASK_BYTES``, or ``least`` if that is more."""
    return max(1, min(ranges, max(least, -(-ranges * split_bytes // max(split_bytes, TASK_BYTES)))))


def read_split_files(spark: SparkSession, base: str, files: list[tuple[str, int]], split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """``BLOCK_SCHEMA`` rows of the files (path and length, of the file system that ``base`` is of), cut into ranges."""
    from tickwork.operators.series import materialize

    if split_bytes < 1:
        raise ValueError("a range has bytes")
    listed = spark.createDataFrame(files, "path string, length bigint")
    starts = F.posexplode(F.sequence(F.lit(0).cast("bigint"), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(split_bytes).cast("bigint"))).alias("part", "entry")
    ranges = listed.select("path", "length", starts).withColumn("last", F.least(F.col("entry") + split_bytes, F.col("length")))
    tasks = _tasks(sum(-(-n // split_bytes) for _, n in files), split_bytes, int(spark.conf.get("spark.sql.shuffle.partitions")))
    guessed = materialize(ranges.repartition(tasks, "path", "part").mapInArrow(lambda it: _read(it, base, True), _HEADS), "frames")
    met = materialize(guessed.groupBy("path", "part").agg(F.min("at").alias("guess"), F.max("until").alias("until")), "met")
    known = ranges.select("path", "length", "part", "last").join(met, ["path", "part"], "left")
    in_order = known.repartition("path").sortWithinPartitions("path", "part").select("path", "length", "part", "last", "guess", "until")
    stitched = materialize(in_order.mapInArrow(lambda it: _stitch(it, base), _STITCHED), "ranges")
    # hardly a guess is wrong, so these are what the frames are joined with
    wrong = materialize(met.select("path", "part").join(stitched.where("NOT walk").select("path", "part"), ["path", "part"], "left_anti"), "wrong")
    right = guessed.join(wrong, ["path", "part"], "left_anti")
    again = stitched.where("walk")
    walked = again.repartition(max(1, min(tasks, again.count())), "path", "part").mapInArrow(lambda it: _read(it, base, False), _HEADS)
    return right.unionByName(walked).where("tx_count IS NOT NULL").select(*(c.split()[0] for c in BLOCK_SCHEMA.split(", ")))
