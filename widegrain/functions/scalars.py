"""Scalar column expressions: ANSI-safe casts and ratios, recodes, row argmax."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def coerce_numeric(c, to: str = "double") -> Column:
    """``to_numeric(errors='coerce')``: unparsable text becomes null (ANSI-safe)."""
    return _col(c).cast("string").try_cast(to) if to else _col(c)


def safe_ratio(num, den, scale: float | None = None) -> Column:
    """``num / den`` (times ``scale``); a zero or null divisor gives null."""
    r = F.try_divide(_col(num).cast("double"), _col(den).cast("double"))
    return r * F.lit(float(scale)) if scale is not None else r


def mean_of_two(a, b) -> Column:
    """``(a + b) / 2``; null when either side is null."""
    return (_col(a).cast("double") + _col(b).cast("double")) / F.lit(2.0)


def recode(c, mapping: Mapping) -> Column:
    """Simultaneous value recode (``{1: 0, 2: 1}`` maps 1->0 and 2->1, never 1->0->...)."""
    out = None
    for src, dst in mapping.items():
        cond = _col(c) == F.lit(src)
        out = F.when(cond, F.lit(dst)) if out is None else out.when(cond, F.lit(dst))
    return _col(c) if out is None else out.otherwise(_col(c))


def row_argmax(cols: Sequence[str]) -> tuple[Column, Column]:
    """Per-row (max value, name of the column holding it) over named columns.

    Nulls are skipped; ties go to the first listed column; all-null gives null.
    """
    n = len(cols)
    entries = [
        F.when(F.col(c).isNotNull(),
               F.struct(F.col(c).cast("double").alias("v"),
                        F.lit(n - i).alias("p"),
                        F.lit(c).alias("name")))
        for i, c in enumerate(cols)
    ]
    best = F.array_max(F.filter(F.array(*entries), lambda x: x.isNotNull()))
    return best["v"], best["name"]
