"""Block-file writer: encode ``(block_time, tx_count)`` rows as ``blk*.dat`` frames.

Used to turn rows of a given table into raw files for the block decoder.
No shuffle: each task sorts its own input split by time and writes it batch
by batch (``mapInPandas``), ``rows_per_file`` blocks per file -- one pass over
the input, no group is ever collected whole, a task holds one Arrow batch at
a time. (A range repartition would sample, i.e. scan, the input twice.)
Files are written through ``pyarrow.fs`` (any shared filesystem URI) under a
temporary name and moved into place; names and contents depend only on the
data (partition id, batch and slice index of a sorted partition), so a
retried task rewrites identical files.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwork.fsutil import pyarrow_filesystem, qualified
from tickwork.sources.blockfiles import COUNT_WIDTHS, HEADER_LEN, MAGICS, TIME_OFFSET


def encode_count(n: int) -> bytes:
    """A count in one byte, or a marker and the narrowest width that holds it."""
    if n < min(COUNT_WIDTHS):
        return bytes([n])
    marker, width = next((m, w) for m, w in COUNT_WIDTHS.items() if n < 1 << 8 * w)
    return bytes([marker]) + n.to_bytes(width, "little")


def encode_block(block_time: int, tx_count: int, magic: bytes = MAGICS[0]) -> bytes:
    header = bytearray(HEADER_LEN)
    struct.pack_into("<I", header, TIME_OFFSET, block_time)
    payload = bytes(header) + encode_count(tx_count)
    return magic + struct.pack("<I", len(payload)) + payload


def write_block_files(
    df: DataFrame, path: str, *, ts: str = "block_time", tx: str = "tx_count", rows_per_file: int = 2000,
    padding: int = 64,
) -> DataFrame:
    """Write ``blk<split>-<batch>-<slice>.dat`` files under ``path``; returns the manifest ``(file, n_blocks)``.

    ``padding`` zero bytes end each file, as in preallocated block files; the
    decoder stops at them. The write runs immediately; the manifest is stored
    next to ``path``.
    """
    spark = df.sparkSession
    root = qualified(spark, path)

    def write_partition(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        ctx = TaskContext.get()
        pid, attempt = ctx.partitionId(), ctx.attemptNumber()
        filesystem, base = pyarrow_filesystem(root)
        filesystem.create_dir(base, recursive=True)
        names, counts = [], []
        for b, pdf in enumerate(batches):
            for k, lo in enumerate(range(0, len(pdf), rows_per_file)):
                part = pdf.iloc[lo:lo + rows_per_file]
                name = f"blk{pid:05d}-{b:04d}-{k:03d}.dat"  # separators: wider numbers never run into each other
                body = b"".join(encode_block(int(t), int(x)) for t, x in zip(part[ts], part[tx])) + bytes(padding)
                tmp = f"{base}/_tmp_{name}.{attempt}"  # concurrent (speculative) attempts never share it
                with filesystem.open_output_stream(tmp) as out:
                    out.write(body)
                filesystem.move(tmp, f"{base}/{name}")
                names.append(name)
                counts.append(len(part))
        yield pd.DataFrame({"file": pd.Series(names, dtype="object"), "n_blocks": pd.Series(counts, dtype="int64")})

    written = (
        df.select(F.col(ts).cast("bigint").alias(ts), F.col(tx).cast("bigint").alias(tx))
        .sortWithinPartitions(ts, tx)
        .mapInPandas(write_partition, "file string, n_blocks bigint")
    )
    manifest = f"{path.rstrip('/')}_manifest"
    written.write.mode("overwrite").parquet(manifest)  # runs the writes; one small row per file
    return spark.read.parquet(manifest)
