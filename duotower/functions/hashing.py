"""Stable hashes that give the same numbers in Spark, in Python and in SQL.

All of them are built on md5 of a ``|``-joined key, first 8 hex digits read as
an unsigned 32-bit integer. That choice is deliberate: the value does not depend
on partitioning, executor count or engine, so a split, a batch order or an
initial weight can be recomputed anywhere (including the DuckDB oracle).
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_32 = 4294967296.0


def _key(parts) -> Column:
    return F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])


def md5_u32(*parts: Column) -> Column:
    """Unsigned 32-bit integer from md5 of the joined parts (bigint column)."""
    return F.conv(F.substring(F.md5(_key(parts)), 1, 8), 16, 10).cast("bigint")


def md5_unit(*parts: Column) -> Column:
    """Uniform number in [0, 1) from md5 of the joined parts."""
    return md5_u32(*parts) / F.lit(TWO_32)


def py_md5_unit(*parts) -> float:
    key = "|".join("" if p is None else str(p) for p in parts)
    return int(hashlib.md5(key.encode()).hexdigest()[:8], 16) / TWO_32


def sql_md5_u32(*parts: str) -> str:
    """The same hash as SQL text for DuckDB (arguments are SQL expressions)."""
    inner = ", ".join(f"coalesce(CAST({p} AS VARCHAR), '')" for p in parts)
    return f"CAST(('0x' || substr(md5(concat_ws('|', {inner})), 1, 8)) AS BIGINT)"


def init_matrix(seed: int, name: str, rows: int, cols: int, bound: float) -> np.ndarray:
    """Uniform(-bound, bound) matrix; entry (r, c) = (2u - 1) * bound, u = md5(seed|name|r|c)."""
    out = np.empty((rows, cols), dtype=np.float64)
    for r in range(rows):
        for c in range(cols):
            out[r, c] = py_md5_unit(seed, name, r, c)
    return (2.0 * out - 1.0) * bound


def init_vector_col(seed: int, name: str, row: Column, dim: int, bound: float) -> Column:
    """Spark column: array of ``dim`` Uniform(-bound, bound) values for table row ``row``.

    Entry j equals ``init_matrix(seed, name, ...)[row, j]``: one rule, two places.
    """
    return F.transform(
        F.sequence(F.lit(0), F.lit(dim - 1)),
        lambda j: (F.lit(2.0) * md5_unit(F.lit(str(seed)), F.lit(name), row, j) - F.lit(1.0)) * F.lit(bound),
    )
