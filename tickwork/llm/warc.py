"""Pages as sharded WARC archives, written the same way each time, and read back.

Records are dealt into shards of consecutive page ids and sorted in them. Shard
borders come from a sample of page ids chosen by a hash of the id (``BORDERS``
ids at most are asked of the driver), so they depend on the pages alone. A task
writes a shard record by record, each its own gzip member, and starts another
file when one reaches ``roll_bytes``. Dates and record ids are functions of the
page, so a repeated attempt writes the same bytes.

A file is written under a temporary name of the attempt and moved to its own when
it is complete; the task then reports it. The reports, written as a table, are the
manifest: readers open the files that it lists and nothing else.

Of pages with equal payloads of ``least_bytes`` or more, that with the smallest
page_id is a response and the others are revisits without payload. Which they are
is found by digests alone; each such page's decision is sorted in before its page.

Defined results: a null html is an empty payload; a null url becomes a ``urn`` of
the page; rows without page_id sort last, and are responses only if no page with
an id has their payload; of repeated page ids with an equal payload the first
record is the response and the others revisit it; an empty table gives an empty
manifest and no records; further columns are left out.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwork.fsutil import pyarrow_filesystem
from tickwork.llm.common import renamed, written

#: Ids sampled for shard borders, at most about so many.
BORDERS = 50_000
#: Shards are a 64th of the payload, within these sizes in bytes.
SHARD_LEAST, SHARD_MOST = 1 << 20, 1 << 30
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = pa.schema([("shard", pa.int64()), ("roll", pa.int32()), ("file", pa.string()), ("records", pa.int64()), ("bytes", pa.int64()), ("sha256", pa.string())])
MANIFEST_DDL = "shard long, roll int, file string, records long, bytes long, sha256 string"


def record_id(page_id: int | None, digest: str, ordinal: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{page_id}:{digest}:{ordinal}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, ordinal: int, refers_to: int | None, revisit: bool, date: str) -> bytes:
    """One record: headers, then an HTTP response, of which a revisit keeps the head only."""
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else f"urn:page:{page_id}"
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if not revisit:
        block += payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id, digest, ordinal)}", f"WARC-Date: {date}", f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha256:{digest}", f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}"]
    if page_id is not None:
        head.append(f"Page-ID: {page_id}")
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to, digest, 0)}"]
        if refers_to is not None:
            head.append(f"Refers-To-Page-ID: {refers_to}")
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


class ArchiveFile:
    """A file under a temporary name until it is committed."""

    def __init__(self, dest: str, shard: int, roll: int):
        self.fs, root = pyarrow_filesystem(dest)
        self.shard, self.roll, self.name = shard, roll, f"shard-{shard:08d}-{roll:04d}.warc.gz"
        self.final, self.temporary = f"{root}/{self.name}", f"{root}/_temporary-{uuid.uuid4().hex}-{self.name}"
        self.fs.create_dir(root, recursive=True)
        self.out, self.sha, self.records, self.bytes = self.fs.open_output_stream(self.temporary, compression=None), hashlib.sha256(), 0, 0

    def add(self, raw: bytes, level: int) -> None:
        z = zlib.compressobj(level, zlib.DEFLATED, 31)
        member = z.compress(raw) + z.flush()
        self.out.write(member)
        self.sha.update(member)
        self.records, self.bytes = self.records + 1, self.bytes + len(member)

    def commit(self) -> pa.RecordBatch:
        self.out.close()
        self.fs.move(self.temporary, self.final)
        return pa.RecordBatch.from_pylist([{"shard": self.shard, "roll": self.roll, "file": self.name, "records": self.records, "bytes": self.bytes, "sha256": self.sha.hexdigest()}], schema=MANIFEST)

    def abort(self) -> None:
        self.out.close()
        self.fs.delete_file(self.temporary)


def _write_shards(dest: str, roll_bytes: int, level: int, date: str, least_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file: ArchiveFile | None = None
        first_of: dict[str, int | None] = {}  # of the current page id: digest -> the response's page id
        seen: dict[str, int] = {}
        page = object()
        try:
            for batch in batches:
                for shard, page_id, kind, digest, url, payload, first in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if page_id != page:
                        page, first_of, seen = page_id, {}, {}
                    if kind == 0:
                        first_of[digest] = first
                        continue
                    digest = hashlib.sha256(payload).hexdigest()
                    ordinal = seen[digest] = seen.get(digest, -1) + 1
                    revisit = len(payload) >= least_bytes and digest in first_of and (first_of[digest] != page_id or ordinal > 0)
                    if file is not None and (file.shard != shard or file.bytes >= roll_bytes):
                        done, file = file, None
                        yield done.commit()
                        roll = done.roll + 1 if done.shard == shard else 0
                    elif file is None:
                        roll = 0
                    if file is None:
                        file = ArchiveFile(dest, shard, roll)
                    file.add(record(page_id, url, payload, digest, ordinal, first_of.get(digest), revisit, date), level)
            if file is not None:
                done, file = file, None
                yield done.commit()
        finally:
            if file is not None:
                file.abort()

    return run


def repeated_payloads(pages: DataFrame, least_bytes: int) -> DataFrame:
    """page_id, digest, first: each page whose payload occurs again, and the smallest page id with it."""
    keyed = pages.select("page_id", F.sha2("payload", 256).alias("digest"), F.length("payload").alias("n")).where(F.col("n") >= least_bytes).select("page_id", "digest")
    again = keyed.groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", "first")
    return keyed.join(again, "digest").select("page_id", "digest", "first").distinct()


def shard_borders(pages: DataFrame) -> list[float]:
    """Page ids at which shards begin: quantiles by payload size of a sample that a hash of the id draws."""
    n, total = pages.agg(F.count("page_id"), F.coalesce(F.sum(F.length("payload")), F.lit(0))).first()
    shards = -(-total // min(max(total // 64, SHARD_LEAST), SHARD_MOST)) if total else 1
    every = max(1, -(-2 * n // BORDERS))
    drawn = pages.where(F.col("page_id").isNotNull() & (F.pmod(F.xxhash64("page_id"), F.lit(every)) == 0)).groupBy("page_id").agg(F.sum(F.length("payload")).alias("n")).orderBy("page_id").limit(BORDERS).collect() if shards > 1 else []
    each, so_far, borders = sum(r.n for r in drawn) / shards, 0, []
    for r in drawn:
        if so_far >= each * (len(borders) + 1):
            borders.append(float(r.page_id))
        so_far += r.n
    return sorted(set(borders))


def write_archives(pages: DataFrame, dest: str, roll_bytes: int = 1 << 30, level: int = 6, date: str = "1970-01-01T00:00:00Z", least_bytes: int = 100, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write ``pages`` under the folder ``dest``, which all workers share; the manifest, as a table of it."""
    spark = pages.sparkSession
    rows = renamed(pages, page_id=id_col, url=url_col, html=html_col).select(F.col("page_id").cast("long"), "url", F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
    borders = shard_borders(rows)
    repeated = written(repeated_payloads(rows, least_bytes), "repeated")
    both = rows.select("page_id", F.lit(1).alias("kind"), F.sha2("payload", 256).alias("digest"), "url", "payload", F.lit(None).cast("long").alias("first")).unionByName(
        repeated.select("page_id", F.lit(0).alias("kind"), "digest", F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("payload"), "first")
    )
    splits = [float("-inf"), *borders, float("inf")]
    dealt = Bucketizer(splits=splits, inputCol="order", outputCol="shard", handleInvalid="keep").transform(both.withColumn("order", F.col("page_id").cast("double"))) if len(splits) > 2 else both.withColumn("shard", F.lit(0.0))
    dealt = dealt.select(F.coalesce(F.col("shard"), F.lit(float(len(splits)))).cast("long").alias("shard"), "page_id", "kind", "digest", "url", "payload", "first")
    in_order = dealt.repartition(len(splits), "shard").sortWithinPartitions("shard", F.col("page_id").asc_nulls_last(), "kind", "digest", "url")
    in_order.mapInArrow(_write_shards(dest, roll_bytes, level, date, least_bytes), MANIFEST_DDL).write.parquet(f"{dest}/_manifest")
    return spark.read.schema(MANIFEST_DDL).parquet(f"{dest}/_manifest")


def members(stream, chunk: int = 1 << 20) -> Iterator[bytes]:
    """The uncompressed gzip members of a stream, one at a time."""
    z, parts, rest = zlib.decompressobj(31), [], b""
    while True:
        data = rest or stream.read(chunk)
        if not data:
            break
        parts.append(z.decompress(data))
        rest = z.unused_data
        if z.eof:
            yield b"".join(parts)
            z, parts = zlib.decompressobj(31), []
    if any(parts):
        raise ValueError("an archive ends within a record")


def parse_record(raw: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """Headers of a record, headers of its HTTP head, and payload; the block's digest is checked."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = lambda lines: dict(x.split(": ", 1) for x in lines[1:])
    warc = fields(head.decode("utf-8", "surrogatepass").split("\r\n"))
    block = rest[: int(warc["Content-Length"])]
    if warc["WARC-Block-Digest"] != f"sha256:{hashlib.sha256(block).hexdigest()}":
        raise ValueError(f"record {warc['WARC-Record-ID']} is damaged")
    http, _, payload = block.partition(b"\r\n\r\n")
    return warc, fields(http.decode().split("\r\n")), payload


RECORD = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])


def read_archives(manifest: DataFrame, source: str) -> DataFrame:
    """page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload of every record of the listed files.

    A revisit has no payload; its size and digest are those of the payload that it revisits.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pyarrow_filesystem(source)
        for batch in batches:
            for name, expected in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows, found, size = [], 0, 0
                with fs.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    for raw in members(stream):
                        warc, http, payload = parse_record(raw)
                        digest, kind = warc["WARC-Payload-Digest"].removeprefix("sha256:"), warc["WARC-Type"]
                        if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
                            raise ValueError(f"the payload of {warc['WARC-Record-ID']} is damaged")
                        number = lambda key: int(warc[key]) if key in warc else None  # noqa: B023, E731
                        rows.append((number("Page-ID"), warc["WARC-Target-URI"], int(http["Content-Length"]), digest, kind, number("Refers-To-Page-ID"), payload if kind == "response" else None))
                        found, size = found + 1, size + len(payload)
                        if size > 8 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), RECORD, strict=True)], schema=RECORD)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), RECORD, strict=True)], schema=RECORD)
                if found != expected:
                    raise ValueError(f"{name} has {found} records, the manifest says {expected}")

    files = manifest.select("file", "records")
    spread = files.repartition(max(1, files.count()), "file")
    return spread.mapInArrow(read, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary")
