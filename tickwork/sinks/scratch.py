"""Shared scratch folder for intermediate tables and fixture files.

On a cluster every executor must see it, so it is the folder the cluster
names in ``spark.checkpoint.dir``, read from the session. Only a local session
may do without: it gets a fresh temporary folder, registered as its checkpoint
directory. On any other master a missing setting is an error.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

from tickwork.fsutil import local_fs_path  # noqa: F401  (re-exported)

_MADE: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - e.g. a Spark Connect session has no SparkContext
        sc = None
    d = (sc.getCheckpointDir() if sc is not None else None) or spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors of {master or 'the cluster'} share")
        d = tempfile.mkdtemp(prefix="tickwork-ckpt-")
        if sc is not None:
            sc.setCheckpointDir(d)
            d = sc.getCheckpointDir() or d
        else:
            spark.conf.set("spark.checkpoint.dir", d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared folder; :func:`drop_scratch` deletes it."""
    _MADE.append(f"{shared_dir(spark)}/tickwork/{name}-{uuid.uuid4().hex}")
    return _MADE[-1]


def drop_scratch(spark: SparkSession, since: int = 0, until: int | None = None) -> int:
    """Delete the scratch tables made from number ``since`` on, up to ``until`` (see :func:`scratch_mark`); how many there were.

    For callers who no longer need any result that still reads them.
    """
    paths, _MADE[since:until] = _MADE[since:until], []
    hadoop = spark._jvm.org.apache.hadoop.fs
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    for path in map(hadoop.Path, paths):
        path.getFileSystem(conf).delete(path, True)
    return len(paths)


def scratch_mark() -> int:
    """A number for :func:`drop_scratch`: how many scratch paths there are now."""
    return len(_MADE)
