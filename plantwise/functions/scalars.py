"""One-row statistics attached as scalar subqueries (no cross joins).

A grand mean, a global median or a row count is a one-row aggregate; it is
attached to every row as an uncorrelated scalar subquery (SQL's
``(SELECT avg(x) FROM t)``).  All columns of one aggregate travel in one
struct-valued subquery, whose repeated uses Spark runs once; its value reaches
the tasks as a constant -- no cartesian product, and no
unpartitioned ``OVER ()`` window that would pull all rows into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _fields(stats: DataFrame) -> list[Column]:
    row = stats.select(F.struct(*[F.col(c) for c in stats.columns]).alias("row")).scalar()
    return [row.getField(c).alias(c) for c in stats.columns]


def with_scalars(df: DataFrame, stats: DataFrame) -> DataFrame:
    """All columns of ``df`` plus every column of the one-row ``stats``."""
    return df.select("*", *_fields(stats))


def one_row(spark: SparkSession, frames: Sequence[DataFrame]) -> DataFrame:
    """One row holding the columns of several one-row frames
    (``SELECT (SELECT a ...), (SELECT b ...)``)."""
    return spark.range(1).select(*[c for f in frames for c in _fields(f)])
