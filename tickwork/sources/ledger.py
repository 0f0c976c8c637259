"""Incremental scans by a ledger of files, and one schema for files of several producers.

A ledger is a Parquet folder with a row (path, size, time) for each file that a
scan has taken in. A later scan lists the folder and takes the files that the
ledger doesn't have; a file whose size or time has changed since is an error, as
its old rows are in use already. What was taken is added by ``commit``, after the
caller has stored what it read: a run that dies before reads the same files again.

Activity files come from two producers, one of which counts transactions in
integers and the other in doubles. Spark reads a folder by the schema of one of
its files and fails at the others. Here tasks read the files' footers, files of
equal schema are read together, and columns get the type that holds all values.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwork.fsutil import pyarrow_filesystem, qualified

LEDGER = "path string, size bigint, time timestamp"
_WIDTH = {T.ByteType: 0, T.ShortType: 1, T.IntegerType: 2, T.LongType: 3, T.FloatType: 4, T.DoubleType: 5}


def list_table_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """``LEDGER`` rows of the files under ``path``, recursively; contents aren't read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(path)
    return files.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("time")).where(~F.regexp_extract("path", "([^/]*)$", 1).rlike("^[_.]"))


def _ledger(spark: SparkSession, ledger: str) -> DataFrame:
    hadoop = spark._jvm.org.apache.hadoop.fs
    place = hadoop.Path(ledger)
    there = place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(place)
    return spark.read.schema(LEDGER).parquet(ledger) if there else spark.createDataFrame([], LEDGER)


class NewFiles:
    """Files that the ledger didn't have when this was made."""

    def __init__(self, spark: SparkSession, rows: DataFrame, ledger: str):
        self.spark, self.ledger = spark, ledger
        self.rows = rows.orderBy("path").collect()  # the list of files, as Spark's own scan has it

    @property
    def paths(self) -> list[str]:
        return [r["path"] for r in self.rows]

    def commit(self) -> None:
        """Add the files to the ledger: what was read from them is stored."""
        if self.rows:
            self.spark.createDataFrame(self.rows, LEDGER).coalesce(1).write.mode("append").parquet(self.ledger)


def new_files(spark: SparkSession, path: str, ledger: str, glob: str = "*.parquet") -> NewFiles:
    """The files under ``path`` that aren't in the ledger; ``ValueError`` if one that is has changed."""
    found, known = list_table_files(spark, path, glob), _ledger(spark, ledger)
    both = found.join(known.select("path", F.col("size").alias("old_size"), F.col("time").alias("old_time")), "path", "left")
    changed = both.where("old_size IS NOT NULL AND (size <> old_size OR time <> old_time)").select("path").limit(5).collect()
    if changed:
        raise ValueError(f"files were changed after they were read: {', '.join(r[0] for r in changed)}")
    return NewFiles(spark, both.where("old_size IS NULL").select("path", "size", "time"), ledger)


def scan_new(spark: SparkSession, path: str, ledger: str, read: Callable[[Sequence[str]], DataFrame], glob: str = "*.parquet") -> tuple[DataFrame | None, NewFiles]:
    """``read`` of the new files (None without any), and the files, whose ``commit`` ends the scan."""
    files = new_files(spark, path, ledger, glob)
    return (read(files.paths) if files.paths else None), files


# ---------------------------------------------------------------- one schema for files of several
def file_schemas(spark: SparkSession, paths: Sequence[str]) -> list[tuple[T.StructType, list[str]]]:
    """The different schemas of Parquet files, each with its files: footers are read by tasks, a file at a time."""
    base = qualified(spark, paths[0])

    def footers(batches):
        import pandas as pd
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import from_arrow_schema

        filesystem, _ = pyarrow_filesystem(base)
        for batch in batches:
            schemas = []
            for path in batch["path"]:
                with filesystem.open_input_file(pyarrow_filesystem(path)[1]) as file:
                    parquet = pq.ParquetFile(file)
                    own = from_arrow_schema(parquet.schema_arrow.remove_metadata(), prefer_timestamp_ntz=True)
                # the file says whether a time is an instant, but old ones (INT96) all are; nullability is of no matter
                columns = (parquet.schema.column(k) for k in range(len(parquet.schema)))
                old = {c.path for c in columns if c.physical_type == "INT96"}
                schemas.append(json.dumps([[f.name, "timestamp" if f.name in old else f.dataType.jsonValue()] for f in own]))
            yield pd.DataFrame({"path": batch["path"], "schema": schemas})

    listed = spark.createDataFrame([(qualified(spark, p),) for p in paths], "path string")
    rows = listed.repartition(max(1, min(len(paths), 10_000))).mapInPandas(footers, "path string, schema string")
    groups = rows.groupBy("schema").agg(F.sort_array(F.collect_list("path")).alias("paths")).orderBy("schema").collect()

    def struct(text: str) -> T.StructType:
        return T.StructType.fromJson({"type": "struct", "fields": [{"name": n, "type": kind, "nullable": True, "metadata": {}} for n, kind in json.loads(text)]})

    return [(struct(r["schema"]), r["paths"]) for r in groups]


def common_type(column: str, kinds: Sequence[T.DataType]) -> T.DataType:
    """The type that holds the values of all ``kinds``: equal, or numbers, the wider one (integers and fractions as doubles)."""
    kinds = [k for k in dict.fromkeys(kinds) if not isinstance(k, T.NullType)] or [T.NullType()]
    if len(kinds) == 1:
        return kinds[0]
    if not all(type(k) in _WIDTH for k in kinds):
        raise ValueError(f"column {column} has no common type: {', '.join(k.simpleString() for k in kinds)}")
    widest = max(kinds, key=lambda k: _WIDTH[type(k)])
    whole = all(_WIDTH[type(k)] <= 3 for k in kinds)
    return widest if whole else T.DoubleType()


def read_reconciled(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """The rows of Parquet files of several schemas: all columns of any file, in a type that holds all of its values."""
    groups = file_schemas(spark, paths)
    names = list(dict.fromkeys(f.name for schema, _ in groups for f in schema))
    kinds = {n: common_type(n, [schema[n].dataType for schema, _ in groups if n in schema.names]) for n in names}
    parts = []
    for schema, files in groups:
        rows = spark.read.schema(schema).parquet(*files)
        parts.append(rows.select(*((F.col(f"`{n}`") if n in schema.names else F.lit(None)).cast(kinds[n]).alias(n) for n in names)))
    return reduce(DataFrame.unionByName, parts)
