"""Raw block-file source.

A block file is a row of frames: 4 magic bytes (main or test network), a
little-endian uint32 payload size, then the payload, which begins with an
80-byte header (uint32 epoch seconds at offset 68) and a variable-length
transaction count. A file ends at a wrong magic (the zero padding of
preallocated files), or where a frame would reach past the end of the file; a
payload too short for header and count gives no row.

Only the first 97 bytes of a frame matter. ``method="stream"`` (default) is the
Python data source :class:`BlockFileSource`: it opens each file for random
access, reads those bytes and seeks to the next frame, so the payloads, nearly
all of the data, are never read. ``method="binaryFile"`` is Spark's
``binaryFile`` source with ``mapInPandas`` over whole files, for paths that only
Spark's file systems can open. Either way one task per group of files, and a
damaged tail ends only its own file. Everything after the decode (hourly
statistics, joins) is plain DataFrame work.

A file of more than ``split_bytes`` is read in byte ranges by many tasks, see
:mod:`tickwork.sources.blocksplit`.
"""

from __future__ import annotations

import fnmatch
import io
import struct
from collections.abc import Iterator
from decimal import Decimal
from itertools import islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tickwork.fsutil import pyarrow_filesystem, qualified

# Network magics, header length, time offset, markers of longer counts and their widths.
MAGICS = (b"\xf9\xbe\xb4\xd9", b"\x0b\x11\x09\x07")
HEADER_LEN = 80
TIME_OFFSET = 68
COUNT_WIDTHS = {0xFD: 2, 0xFE: 4, 0xFF: 8}

# What matters of a frame: magic, payload size, time, first byte of the count, the bytes that may follow it.
FRAME_HEAD = f"<4sI{TIME_OFFSET}xI{HEADER_LEN - TIME_OFFSET - 4}xB8s"
HEAD_LEN = struct.calcsize(FRAME_HEAD)
FRAME_PREFIX = 8

BLOCK_SCHEMA = "path string, block_time bigint, tx_count decimal(20,0)"
_BATCH = 8192  # blocks per Arrow batch


def frame_heads(file, length: int) -> Iterator[tuple[int, int]]:
    """(epoch seconds, transaction count) of each block in a seekable file of ``length`` bytes."""
    end = 0
    while end + FRAME_PREFIX <= length:
        file.seek(end)
        magic, size, seconds, count, more = struct.unpack(FRAME_HEAD, file.read(HEAD_LEN).ljust(HEAD_LEN, b"\0"))
        end += FRAME_PREFIX + size
        if magic not in MAGICS or end > length:
            break
        width = COUNT_WIDTHS.get(count, 0)
        if size > HEADER_LEN + width:
            yield seconds, int.from_bytes(more[:width], "little") if width else count


def _arrow_batches(path: str, heads: Iterator[tuple[int, int]]):
    """Arrow batches of ``BLOCK_SCHEMA`` with at most ``_BATCH`` blocks of one file."""
    import pyarrow as pa

    schema = pa.schema([("path", pa.string()), ("block_time", pa.int64()), ("tx_count", pa.decimal128(20, 0))])
    while part := list(islice(heads, _BATCH)):
        times, counts = zip(*part)
        columns = [[path] * len(part), times, [Decimal(c) for c in counts]]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _decode_files(batches):
    for batch in batches:
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
            raw = content.as_buffer()
            yield from _arrow_batches(path, frame_heads(io.BytesIO(raw), raw.size))


def list_files(path: str, glob: str) -> list[tuple[str, int]]:
    """Path and length of each ``glob`` file under ``path``, recursively; an error where there is no such folder."""
    from pyarrow import fs

    filesystem, base = pyarrow_filesystem(path)
    found = filesystem.get_file_info(fs.FileSelector(base, recursive=True))
    return sorted((i.path, i.size or 0) for i in found if i.is_file and fnmatch.fnmatch(i.base_name, glob))


def read_block_files(spark: SparkSession, path: str, *, glob: str = "blk*.dat", method: str = "stream", split_bytes: int = 512 << 20) -> DataFrame:
    """S6 + S7: decode every ``glob`` file under ``path`` (recursively) into ``path, block_time`` (epoch seconds),
    ``tx_count`` (decimal: a count can be any unsigned 64-bit number).

    A path without a scheme is one of the session's default file system with either ``method`` (see the module). A
    folder without such files gives no rows, a missing folder an error. With ``method="stream"`` files of more than
    ``split_bytes`` are read in ranges of that many bytes, the others as a whole.
    """
    path = qualified(spark, path)
    if method == "stream":
        from tickwork.sources.blocksplit import read_split_files

        spark.dataSource.register(BlockFileSource)
        whole = spark.read.format(BlockFileSource.name()).option("pathGlobFilter", glob).option("maxFileBytes", split_bytes).load(path)
        large = [(name, n) for name, n in list_files(path, glob) if n > split_bytes]
        return whole.unionByName(read_split_files(spark, path, large, split_bytes)) if large else whole
    if method != "binaryFile":
        raise ValueError(f"method must be 'stream' or 'binaryFile', not {method!r}")
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(path)
    return files.select("path", "content").mapInArrow(_decode_files, BLOCK_SCHEMA)


# ---------------------------------------------------------------- streaming reader (Python data source)
class BlockFileSource(DataSource):
    """``spark.read.format("blockfiles").option("pathGlobFilter", "blk*.dat").load(path)``.

    The driver lists the matching files (recursively) and packs them into
    partitions of about ``maxPartitionBytes`` (default 128 MiB): one task per
    large file, several small files per task; files of more than
    ``maxFileBytes`` are left out. Tasks open them through ``pyarrow.fs`` (local
    or any shared file system URI).
    """

    @classmethod
    def name(cls) -> str:
        return "blockfiles"

    def schema(self) -> str:
        return BLOCK_SCHEMA

    def reader(self, schema):
        return _BlockFileReader(self.options)


class _BlockFileReader(DataSourceReader):
    def __init__(self, options) -> None:
        self.path = options["path"]
        self.glob = options.get("pathGlobFilter", "blk*.dat")
        self.target = int(options.get("maxPartitionBytes", 128 * 1024 * 1024))
        self.most = int(options.get("maxFileBytes", 1 << 62))

    def partitions(self):
        files = [(name, n) for name, n in list_files(self.path, self.glob) if n <= self.most]
        groups: list[list[str]] = [[]]
        size = 0
        for name, n in files:
            if groups[-1] and size + n > self.target:
                groups.append([])
                size = 0
            groups[-1].append(name)
            size += n
        return [InputPartition(g) for g in groups]  # one at least: Spark reads without a partition otherwise

    def read(self, partition):
        filesystem, _ = pyarrow_filesystem(self.path)
        for name in partition.value:
            with filesystem.open_input_file(name) as file:
                yield from _arrow_batches(name, frame_heads(file, file.size()))
