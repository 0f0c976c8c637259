"""K5: the physical plan as text, and checks over it."""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def single_partition_exchanges(df: DataFrame) -> int:
    """Number of ``Exchange SinglePartition`` nodes in the physical plan."""
    return plan_text(df, "simple").count("Exchange SinglePartition")
