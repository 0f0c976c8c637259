"""Return, ratio and label expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(num: str | Column, den: str | Column, on_zero: str = "error") -> Column:
    """``num / den``; a zero denominator raises (ANSI mode, as in the source pipeline) or, with ``"null"``, gives NULL."""
    if on_zero not in ("error", "null"):
        raise ValueError(f"on_zero must be 'error' or 'null', not {on_zero!r}")
    return F.try_divide(_col(num), _col(den)) if on_zero == "null" else _col(num) / _col(den)


def log_return(cur: str | Column, prev: str | Column, on_zero: str = "error") -> Column:
    """Natural-log return ``ln(cur / prev)``; NULL when the ratio is not positive (``on_zero``: see :func:`ratio`)."""
    return F.ln(ratio(cur, prev, on_zero))


def simple_return(future: str | Column, cur: str | Column, on_zero: str = "error") -> Column:
    """Forward simple return ``(future - cur) / cur``."""
    c = _col(cur)
    return ratio(_col(future) - c, c, on_zero)


def up_label(ret: str | Column, threshold: float = 0.001) -> Column:
    """1 when ``ret > threshold`` (strict), else 0 -- a NULL return also gives 0."""
    return F.when(_col(ret) > F.lit(threshold), F.lit(1)).otherwise(F.lit(0))
