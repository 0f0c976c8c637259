"""Repeatable sinks: staged writes, overwritten by date, committed by manifest (K1-K3, O1).

A table is a folder of immutable data folders and of numbered manifests. A write
goes to a data folder of its own, partitioned by a date column; nobody reads it
yet. The commit writes the next manifest, which lists for every date the folder
that holds it: dates of the new write replace their old folders, the others stay.
A manifest is written under a temporary name and renamed to its number, which
fails if another writer has taken the number.

Readers take the last manifest. They see the whole of a write or nothing of it,
also while it runs, after it was killed, and when it is repeated: what a dead run
has left is listed nowhere (``sweep`` deletes it). A manifest has one entry a
date.

The counts of a commit are taken from the files that were written, from their
footers or the columns that an aggregate needs; the rows aren't computed again.
(``DataFrame.observe`` would count in the write job, but a Spark 4.1 session that
has used an ``Observation`` can't ship models with a training summary to tasks
any more, so the library doesn't use it.)
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwork.fsutil import qualified

DATE = "publish_date"


class PublishedTable:
    """A table of this module at ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, qualified(spark, path).rstrip("/")
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._fs = self._hadoop.Path(self.path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def _names(self, folder: str) -> list[str]:
        place = self._hadoop.Path(f"{self.path}/{folder}")
        return sorted(s.getPath().getName() for s in self._fs.listStatus(place)) if self._fs.exists(place) else []

    def version(self) -> int:
        """Number of the last commit; 0 without one."""
        return max((int(n[:-5]) for n in self._names("_manifests") if n.endswith(".json") and n[0] != "_"), default=0)

    def manifest(self, version: int | None = None) -> dict:
        """``{"dates": {date: folder}, "counts": {...}}`` of a commit, the last one by default."""
        version = self.version() if version is None else version
        if not version:
            return {"dates": {}, "counts": {}}
        file = self._fs.open(self._hadoop.Path(f"{self.path}/_manifests/{version:010d}.json"))
        try:
            return json.loads(bytes(file.readAllBytes()).decode())
        finally:
            file.close()

    def _commit(self, version: int, content: dict) -> None:
        final = self._hadoop.Path(f"{self.path}/_manifests/{version:010d}.json")
        staged = self._hadoop.Path(f"{self.path}/_manifests/_{uuid.uuid4().hex}.json")
        out = self._fs.create(staged)
        try:
            out.write(bytearray(json.dumps(content).encode()))
        finally:
            out.close()
        if self._fs.exists(final) or not self._fs.rename(staged, final):
            self._fs.delete(staged, False)
            raise RuntimeError(f"another writer has committed version {version} of {self.path}; write again")

    def write(self, df: DataFrame, date: Column, *, sort_by: tuple[str, ...] = (), counts: Mapping[str, Column] | None = None, before_commit=None) -> dict:
        """Replace the dates that ``df`` has by its rows; returns what was written: ``rows`` and the aggregates of ``counts``.

        ``date`` gives a row's date (rows without one form a date of their own), ``counts`` are aggregates.
        ``before_commit`` is called between write and commit, e.g. to store what belongs to the write elsewhere.
        """
        version, folder = self.version(), f"data-{uuid.uuid4().hex}"
        dated = df.withColumn(DATE, F.coalesce(date.cast("date").cast("string"), F.lit("none")))
        dated = dated.repartitionByRange(DATE, *sort_by).sortWithinPartitions(DATE, *sort_by)
        dated.write.partitionBy(DATE).parquet(f"{self.path}/{folder}")
        dates = [n.split("=", 1)[1] for n in self._names(folder) if n.startswith(f"{DATE}=")]
        files = self.spark.read.schema(df.schema).parquet(*(f"{self.path}/{folder}/{DATE}={d}" for d in dates)) if dates else self.spark.createDataFrame([], df.schema)
        counted = files.agg(F.count(F.lit(1)).alias("rows"), *(c.alias(n) for n, c in (counts or {}).items())).first().asDict()
        found = {n: (v if isinstance(v, (int, float, str, type(None))) else str(v)) for n, v in counted.items()}
        if before_commit:
            before_commit()
        old = self.manifest(version)["dates"]
        self._commit(version + 1, {"dates": old | {d: folder for d in dates}, "counts": found})
        return found

    def read(self, schema=None, version: int | None = None) -> DataFrame:
        """The rows of a commit, the last one by default, without the date; ``schema`` is needed where no date has rows."""
        dates = self.manifest(version)["dates"]
        if not dates:
            if schema is None:
                raise ValueError(f"{self.path} has no rows yet, and no schema was given")
            return self.spark.createDataFrame([], schema)
        return self.spark.read.parquet(*(f"{self.path}/{folder}/{DATE}={d}" for d, folder in sorted(dates.items())))

    def sweep(self) -> int:
        """Delete data folders that no manifest lists; how many. Not while another writer is at work."""
        used = {f for v in range(1, self.version() + 1) for f in self.manifest(v)["dates"].values()}
        left = [n for n in self._names("") if n.startswith("data-") and n not in used]
        for name in left:
            self._fs.delete(self._hadoop.Path(f"{self.path}/{name}"), True)
        return len(left)
