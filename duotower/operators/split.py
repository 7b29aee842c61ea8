"""Train / validation / test split (L2).

``hash_split`` (default): a row's split is a pure function of its key columns,
``md5(keys) % 10000`` against the cumulative weights. It does not depend on
partitioning or executor count (``randomSplit`` does, SURVEY Q9), it needs no
shuffle, and repeated (user, item) pairs always land in the same split.

``random_split`` keeps the reference's ``randomSplit`` for comparison.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duotower.functions.hashing import md5_u32

SPLIT_NAMES = ("train", "validation", "test")
SCALE = 10000


def _cuts(weights) -> list[int]:
    total = float(sum(weights))
    acc, cuts = 0.0, []
    for w in weights:
        acc += w / total
        cuts.append(int(round(acc * SCALE)))
    cuts[-1] = SCALE
    return cuts


def split_column(keys: list[Column], weights=(0.7, 0.2, 0.1), names=SPLIT_NAMES) -> Column:
    h = md5_u32(*keys) % F.lit(SCALE)
    cuts = _cuts(weights)
    expr = None
    for name, cut in zip(names, cuts):
        expr = F.when(h < cut, F.lit(name)) if expr is None else expr.when(h < cut, F.lit(name))
    return expr.otherwise(F.lit(names[-1]))


def hash_split(df: DataFrame, keys: list[str], weights=(0.7, 0.2, 0.1), out: str = "split") -> DataFrame:
    return df.withColumn(out, split_column([F.col(k) for k in keys], weights))


def sql_split_case(key_sql: list[str], weights=(0.7, 0.2, 0.1), names=SPLIT_NAMES) -> str:
    """The same split rule as SQL text (for the oracle)."""
    from duotower.functions.hashing import sql_md5_u32

    h = f"({sql_md5_u32(*key_sql)} % {SCALE})"
    whens = " ".join(f"WHEN {h} < {c} THEN '{n}'" for n, c in zip(names, _cuts(weights)))
    return f"CASE {whens} ELSE '{names[-1]}' END"


def random_split(df: DataFrame, weights=(0.7, 0.2, 0.1), seed: int = 42, out: str = "split") -> DataFrame:
    """The reference's ``randomSplit``, returned as one frame with a split column.

    ``randomSplit`` runs its input once per part, so the rows are checkpointed first: all parts see one snapshot and
    no row is lost or repeated.
    """
    df = df.checkpoint()
    parts = df.randomSplit(list(weights), seed=seed)
    tagged = [p.withColumn(out, F.lit(name)) for p, name in zip(parts, SPLIT_NAMES)]
    res = tagged[0]
    for t in tagged[1:]:
        res = res.unionByName(t)
    return res
