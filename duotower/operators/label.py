"""Rating -> binary label at the global mean.

The reference collects the mean to the driver and closes over it in a Python
UDF. Here the mean is a scalar subquery and the comparison a native CASE: no
driver round trip in the plan, no Python worker.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duotower.operators.profile import valid_rating


def binarize_at_mean(df: DataFrame, rating: str = "rating", out: str = "label") -> DataFrame:
    """``rating < mean -> 0``, ``rating >= mean -> 1``; null/NaN -> null (Q5).

    The mean ignores null and NaN ratings. The rating column is replaced by
    ``out`` (the reference's ``withColumnRenamed('rating', 'label')``).
    """
    r = valid_rating(F.col(rating))
    mean = df.agg(F.avg(r)).scalar()
    lab = F.when(r.isNull(), F.lit(None)).when(r < mean, F.lit(0)).otherwise(F.lit(1)).cast("int")
    return df.withColumn(rating, lab).withColumnRenamed(rating, out)
