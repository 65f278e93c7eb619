"""Distributed row ranks without a single-partition window.

``row_number() OVER (ORDER BY ...)`` with no partition pulls every row into
one task, and ``PARTITION BY g`` does the same for a hot group.  Instead the
rows are range-partitioned on (group, order keys) -- Spark samples the
boundaries, so a hot group spans many partitions -- then each row's rank is
the number of rows of its group in earlier partitions (from a per-partition
count table of at most ``partitions + groups`` rows) plus its position in
its own partition.  The range-sorted, indexed rows are materialised once so
both the offsets and the positions are read from the same physical rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plantwise.functions.materialize import materialize


def _sort_col(c) -> Column:
    return F.asc_nulls_last(c) if isinstance(c, str) else c


def rank_rows(df: DataFrame, order: Sequence, by: Sequence[str] = (),
              name: str = "row_rank") -> DataFrame:
    """Add a 0-based rank within ``by`` groups following ``order``.

    ``order`` items are column names (ascending, nulls last) or sort
    Columns.  Ties get distinct ranks in arbitrary order: make the order
    total (add a tie-breaker) when the assignment must be reproducible.
    """
    by = list(by)
    nparts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(b).asc_nulls_first() for b in by] + [_sort_col(c) for c in order]
    ordered = df.repartitionByRange(nparts, *keys).sortWithinPartitions(*keys)
    pid = F.spark_partition_id()
    indexed = ordered.withColumn("__rk_pid", pid).withColumn(
        "__rk_li", F.monotonically_increasing_id() - F.shiftleft(pid.cast("long"), 33))
    # Offsets and positions must come from the same physical partitioning
    # (independently planned range shuffles may sample different bounds).
    indexed = materialize(indexed, "row-ranks")
    blocks = indexed.groupBy(*by, "__rk_pid").agg(F.min("__rk_li").alias("__rk_b0"),
                                                  F.count(F.lit(1)).alias("__rk_bn"))
    w = (Window.partitionBy(*by) if by else Window.partitionBy()).orderBy("__rk_pid")
    offsets = blocks.withColumn("__rk_off", F.coalesce(
        F.sum("__rk_bn").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    offsets = offsets.select(F.col("__rk_pid").alias("__rk_opid"), "__rk_off", "__rk_b0",
                             *[F.col(b).alias(f"__rk_by{i}") for i, b in enumerate(by)])
    cond = [F.col("__rk_pid") == F.col("__rk_opid")] + \
        [F.col(b).eqNullSafe(F.col(f"__rk_by{i}")) for i, b in enumerate(by)]
    j = indexed.join(offsets, cond)
    rank = (F.col("__rk_off") + F.col("__rk_li") - F.col("__rk_b0")).alias(name)
    return j.select(*[F.col(c) for c in df.columns], rank)
