"""Exact, distributed quantiles (linear interpolation, nulls ignored).

Spark's ``percentile`` keeps a value->count map per group and merges it in a
single task, so one hot group (or a global median) over a fact table would
land in one task.  Here one algorithm serves every size:

1. values are counted per (group, value), combined before the shuffle, so a
   value that fills a third of the rows is one row; the counted table is written
   once (:func:`counted_values`), so the input is planned and read once whatever
   the number of groups, columns and probabilities, and every later step reads
   distinct values;
2. counts are summed into ordered buckets of the value's logarithm
   (``_OCTAVE`` to a doubling), and running sums over the buckets of a group
   name the bucket that holds each wanted rank;
3. inside those buckets the step is repeated with ``_CELLS`` equally wide
   cells between the bucket's least and greatest value;
4. a cell has at most 2^20 different doubles, and their running counts give
   the values at the wanted ranks, interpolated like ``quantile_cont``.

Steps 2 to 4 are for counted tables of more than ``WINDOW_ROWS`` rows.  Up to
there one running sum per group over its distinct values gives the same values
in a single shuffle, and no task can hold more than that many rows.

Windows run over buckets, cells or one cell's values, whose numbers are bounded
by the format of doubles, never over a group's rows.  Where an approximation is
enough, ``method="approx"`` uses ``percentile_approx``.  Rows with a null group
key are dropped (pandas ``groupby`` semantics).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plantwise.functions.materialize import materialize

#: Columns of a counted table: a value and how often it occurs; bucket, cell, rank.
_V, _N, _B, _C, _R = "__q_v", "__q_n", "__q_b", "__q_c", "__q_r"
#: Distinct values that one window may run over.
WINDOW_ROWS = 1 << 20
#: Buckets to a doubling of the magnitude, and cells of a bucket.
_OCTAVE, _CELLS = 1024, 1 << 22
#: More than any magnitude's bucket below zero.
_SHIFT = 1100 * _OCTAVE


def _default_names(probs: Sequence[float]) -> list[str]:
    return [f"q{int(round(p * 1000)):04d}" for p in probs]


def _bucket(v: Column) -> Column:
    """A bucket number that never falls as ``v`` grows."""
    size = F.floor(F.log2(F.abs(v)) * _OCTAVE) + _SHIFT
    return F.when(v == 0, F.lit(0).cast("long")).when(v > 0, size).otherwise(-size)


def _cell(v: Column) -> Column:
    """The cell of a value between its bucket's ``__q_lo`` and ``__q_hi``."""
    lo, hi = F.col("__q_lo"), F.col("__q_hi")
    return F.when(hi > lo, F.floor((v - lo) / (hi - lo) * _CELLS)).otherwise(F.lit(0).cast("long"))


def quantiles(df: DataFrame, col: str, probs: Sequence[float], by: Sequence[str] = (),
              names: Sequence[str] | None = None, method: str = "exact",
              accuracy: int = 100000) -> DataFrame:
    """One row per group (``by``) with one column per probability.

    ``method``: ``exact`` or ``approx`` (``percentile_approx``).  With
    ``by=()`` the result has exactly one row (nulls on empty input).
    """
    by = list(by)
    names = list(names) if names else _default_names(probs)
    if method == "approx":
        base = df.select(*by, F.col(col).cast("double").alias(_V)).where(F.col(_V).isNotNull() & ~F.isnan(_V))
        for k in by:
            base = base.where(F.col(k).isNotNull())
        arr = F.percentile_approx(_V, list(probs), accuracy)
        out = (base.groupBy(*by).agg(arr.alias("__q_arr")) if by
               else base.agg(arr.alias("__q_arr")))
        return out.select(*by, *[F.col("__q_arr")[i].alias(n) for i, n in enumerate(names)])
    if method != "exact":
        raise ValueError(f"unknown method {method!r}")

    return quantiles_of_counts(materialize(counted_values(df, col, by), "counted"), by, probs, names)


def counted_values(df: DataFrame, col: str, by: Sequence[str] = ()) -> DataFrame:
    """``by..., __q_v, __q_n``: distinct values of each group and how often they
    occur; null values, NaN and rows with a null group key are left out."""
    base = df.select(*by, (F.col(col).cast("double") + 0.0).alias(_V)).where(F.col(_V).isNotNull() & ~F.isnan(_V))
    for k in by:
        base = base.where(F.col(k).isNotNull())
    return base.groupBy(*by, _V).agg(F.count(F.lit(1)).alias(_N))


def recounted(counted: DataFrame, value: Column, by: Sequence[str] = ()) -> DataFrame:
    """The counted values of an expression over a counted table."""
    return counted.select(*by, (value + 0.0).alias(_V), _N).groupBy(*by, _V).agg(F.sum(_N).alias(_N))


def quantiles_of_counts(counted: DataFrame, by: Sequence[str], probs: Sequence[float],
                        names: Sequence[str] | None = None, rows: int | None = None) -> DataFrame:
    """:func:`quantiles` from a table of :func:`counted_values`; all groups and
    probabilities are walked together.  ``rows``: at least as many as the table
    has; without it a written table is expected, whose rows are counted."""
    by = list(by)
    names = list(names) if names else _default_names(probs)
    rows = counted.count() if rows is None else rows
    if rows <= WINDOW_ROWS:
        return _walk_values(counted, by, probs, names)
    picked = _walk_buckets(counted, by, probs)
    return picked.select(*by, *[_between(p, F.element_at("__q_map", F.floor(_position(p))), F.element_at("__q_map", F.ceil(_position(p)))).alias(n)
                                for p, n in zip(probs, names)])


def _position(p: float) -> Column:
    return F.lit(float(p)) * (F.col("__q_total") - 1)


def _between(p: float, lo: Column, hi: Column) -> Column:
    """Interpolated between the values at the ranks below and above."""
    return F.when(F.col("__q_total") > 0, lo + (hi - lo) * (_position(p) - F.floor(_position(p))))


def _ranks(probs: Sequence[float]) -> Column:
    """The ranks a group of ``__q_total`` values needs: floor and ceil of p*(n-1)."""
    return F.array_distinct(F.array(*[f(_position(p)) for p in probs for f in (F.floor, F.ceil)]))


def _picked(found: DataFrame, by: list[str]) -> DataFrame:
    """Per group the values at the wanted ranks, by rank, and the total."""
    return found.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct(F.col(_R), F.col(_V)))).alias("__q_map"),
                                  F.max("__q_total").alias("__q_total"))


def _walk_values(counted: DataFrame, by: list[str], probs: Sequence[float], names: list[str]) -> DataFrame:
    """One running sum per group over its distinct values."""
    w = Window.partitionBy(*by)
    found = (counted.withColumn("__q_cum", F.sum(_N).over(w.orderBy(_V).rowsBetween(Window.unboundedPreceding, Window.currentRow)))
             .withColumn("__q_total", F.sum(_N).over(w)))

    def at(rank):
        return F.max(F.when((rank >= F.col("__q_cum") - F.col(_N)) & (rank < F.col("__q_cum")), F.col(_V)))

    ends = [at(r(_position(p))) for p in probs for r in (F.floor, F.ceil)]
    total = F.max("__q_total").alias("__q_total")
    picked = found.groupBy(*by).agg(total, *[e.alias(f"__q_{i}") for i, e in enumerate(ends)])
    return picked.select(*by, *[_between(p, F.col(f"__q_{2 * i}"), F.col(f"__q_{2 * i + 1}")).alias(n) for i, (p, n) in enumerate(zip(probs, names))])


def _walk_buckets(counted: DataFrame, by: list[str], probs: Sequence[float]) -> DataFrame:
    values = counted.withColumn(_B, _bucket(F.col(_V)))

    def running(keys, order):
        return F.sum(_N).over(Window.partitionBy(*keys).orderBy(order).rowsBetween(
            Window.unboundedPreceding, Window.currentRow))

    def holds(rank):   # the row whose running sum passes the rank
        return (F.col(rank) >= F.col("__q_cum") - F.col(_N)) & (F.col(rank) < F.col("__q_cum"))

    total = F.sum(_N).over(Window.partitionBy(*by))
    buckets = values.groupBy(*by, _B).agg(F.sum(_N).alias(_N), F.min(_V).alias("__q_lo"),
                                          F.max(_V).alias("__q_hi"))
    buckets = (buckets.withColumn("__q_cum", running(by, _B)).withColumn("__q_total", total)
               .withColumn(_R, F.explode(_ranks(probs))).where(holds(_R))
               .select(*by, _B, "__q_lo", "__q_hi", "__q_total", _R,
                       (F.col(_R) - (F.col("__q_cum") - F.col(_N))).alias("__q_rest")))
    inside = values.join(buckets, [*by, _B]).withColumn(_C, _cell(F.col(_V)))
    keys = [*by, _R]
    cells = inside.groupBy(*keys, _C, "__q_rest").agg(F.sum(_N).alias(_N))
    cells = (cells.withColumn("__q_cum", running(keys, _C)).where(holds("__q_rest"))
             .select(*keys, _C, (F.col("__q_rest") - (F.col("__q_cum") - F.col(_N))).alias("__q_left")))
    found = inside.join(cells, [*keys, _C]).withColumn("__q_cum", running(keys, _V)).where(holds("__q_left"))
    return _picked(found, by)


def median(df: DataFrame, col: str, by: Sequence[str] = (), name: str = "median",
           method: str = "exact") -> DataFrame:
    return quantiles(df, col, [0.5], by=by, names=[name], method=method)
