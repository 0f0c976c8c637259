"""Filesystem helpers shared by sources and sinks (no tickwork imports, so no import cycles)."""

from __future__ import annotations


def local_fs_path(uri: str) -> str:
    """``file:/x``, ``file:///x`` or ``/x`` -> ``/x`` for Python-side file access; other URIs unchanged."""
    if uri.startswith("file://"):
        return uri[len("file://"):]
    if uri.startswith("file:"):
        return uri[len("file:"):]
    return uri


def pyarrow_filesystem(uri: str):
    """``(pyarrow FileSystem, path)`` for a local path or any URI pyarrow understands (hdfs://, s3://, ...)."""
    from pyarrow import fs

    local = local_fs_path(uri)
    return fs.FileSystem.from_uri(local) if "://" in local else (fs.LocalFileSystem(), local)


def qualified(spark, path: str) -> str:
    """``path`` as Spark itself resolves it: without a scheme it belongs to the session's default file system."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    place = hadoop.Path(path)
    return place.getFileSystem(conf).makeQualified(place).toString()
