"""Profiling: counts, descriptive statistics, correlations, listings.

Multi-column statistics are computed in one pass: columns are stacked into a
long (column, value) frame and aggregated by column name, so the number of
jobs does not grow with the number of columns.  Listings with a limit are
top-k reports; ties are broken explicitly so results are reproducible.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantwise.functions.quantiles import quantiles
from plantwise.functions.scalars import with_scalars
from plantwise.functions.stats import kurt_sample, skew_sample

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
            T.DecimalType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, _NUMERIC)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def stack_columns(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Long (column, value) form of numeric columns (as double)."""
    return df.select(*keep, F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in cols
    ])).alias("__cv")).select(*keep, "__cv.column", "__cv.value")


def row_count(df: DataFrame, name: str = "rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def conditional_counts(df: DataFrame, predicates: dict[str, Column]) -> DataFrame:
    """One row with ``count_if(pred)`` per named predicate (one scan)."""
    return df.agg(*[F.count_if(p).alias(n) for n, p in predicates.items()])


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values occurring more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")).where(F.col("count") > 1)


def duplicate_rows_on(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number of rows that repeat an earlier row's key (sum of count - 1)."""
    return duplicate_keys(df, keys).agg(
        F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("long").alias("dup_rows"))


def group_mean_std(df: DataFrame, col: str, by: Sequence[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.avg(col).alias("mean"), F.stddev_samp(col).alias("std"))


def describe(df: DataFrame, cols: Sequence[str] | None = None, method: str = "exact") -> DataFrame:
    """count, mean, std, min, 25 %, 50 %, 75 %, max per numeric column
    (exact interpolated quartiles; one row per column)."""
    cols = list(cols or numeric_columns(df))
    long = stack_columns(df, cols)
    base = long.groupBy("column").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"), F.min("value").alias("min"),
        F.max("value").alias("max"))
    q = quantiles(long, "value", [0.25, 0.5, 0.75], by=["column"], names=["p25", "p50", "p75"],
                  method=method)
    names = df.sparkSession.createDataFrame([(c, i) for i, c in enumerate(cols)],
                                            "column string, position int")
    return (names.join(base, "column", "left").join(q, "column", "left")
            .select("column", "position", "count", "mean", "std", "min", "p25", "p50", "p75", "max"))


def describe_strings(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """count, unique, top (most frequent; ties -> smallest), freq per string column."""
    cols = list(cols or string_columns(df))
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols
    ])).alias("__cv")).select("__cv.column", "__cv.value").where(F.col("value").isNotNull())
    freq = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    per = freq.groupBy("column").agg(
        F.sum("n").alias("count"), F.count(F.lit(1)).alias("unique"),
        F.min(F.struct((-F.col("n")).alias("neg"), F.col("value").alias("v"))).alias("__top"))
    return per.select("column", "count", "unique", F.col("__top.v").alias("top"),
                      (-F.col("__top.neg")).alias("freq"))


def null_counts(df: DataFrame) -> DataFrame:
    """Null (and NaN) count per column, only those > 0, most nulls first."""
    def isnull(f):
        c = F.col(f.name)
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            return c.isNull() | F.isnan(c)
        return c.isNull()
    row = df.agg(*[F.count_if(isnull(f)).alias(f.name) for f in df.schema.fields])
    long = row.unpivot([], [f.name for f in df.schema.fields], "column", "nulls")
    return long.where(F.col("nulls") > 0).orderBy(F.desc("nulls"), "column")


def correlation_long(df: DataFrame, cols: Sequence[str], triangle: str = "lower") -> DataFrame:
    """Pearson r for column pairs in one aggregation (pairwise null deletion).
    ``triangle``: 'lower' (var1 after var2 in ``cols``) or 'full'."""
    cols = list(cols)
    pairs = [(a, b) for i, a in enumerate(cols) for j, b in enumerate(cols)
             if (triangle == "full") or i > j]
    if not pairs:
        return df.sparkSession.createDataFrame([], "var1 string, var2 string, r double")
    row = df.agg(*[F.corr(a, b).alias(f"__c{k}") for k, (a, b) in enumerate(pairs)])
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(a).alias("var1"), F.lit(b).alias("var2"), F.col(f"__c{k}").alias("r"))
        for k, (a, b) in enumerate(pairs)])).alias("p")).select("p.*")


def skew_kurtosis(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Sample skewness G1 and excess kurtosis G2 per column."""
    long = stack_columns(df, cols)
    return long.groupBy("column").agg(skew_sample("value").alias("skew"),
                                      kurt_sample("value").alias("kurtosis"))


def dq_summary(df: DataFrame, kpi_col: str, site_col: str = "site_code",
               time_col: str = "month_start", keys: Sequence[str] = ("date_key", "site_code")
               ) -> DataFrame:
    """rows, sites, start, end, nulls, null_pct (2 dp), negs, zeros, dup_keys."""
    c = F.col(kpi_col)
    base = df.agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct(site_col).alias("sites"),
        F.min(time_col).alias("start"), F.max(time_col).alias("end"),
        F.count_if(c.isNull()).alias("nulls"),
        F.round(F.lit(100.0) * F.count_if(c.isNull()) / F.count(F.lit(1)), 2).alias("null_pct"),
        F.count_if(c < 0).alias("negs"), F.count_if(c == 0).alias("zeros"))
    return with_scalars(base, duplicate_rows_on(df, keys).withColumnRenamed("dup_rows", "dup_keys"))


def trend_series(df: DataFrame, cols: Sequence[str], group: str = "site_code",
                 x: str = "m") -> DataFrame:
    """Mean of each column per (site, month) -- the table behind trend charts."""
    return (df.where(F.col(group).isNotNull())
            .groupBy(group, x).agg(*[F.avg(c).alias(c) for c in cols]).orderBy(group, x))


def box_stats(df: DataFrame, cols: Sequence[str], method: str = "exact") -> DataFrame:
    """Per column: quartiles, mean, 1.5*IQR fences, whiskers (extreme values
    inside the fences) and the number of points outside them."""
    long = stack_columns(df, cols).where(F.col("value").isNotNull())
    q = quantiles(long, "value", [0.25, 0.5, 0.75], by=["column"], names=["q1", "median", "q3"],
                  method=method)
    j = long.join(q, "column")
    lo = F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))
    hi = F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))
    inside = (F.col("value") >= lo) & (F.col("value") <= hi)
    return j.groupBy("column", "q1", "median", "q3").agg(
        F.avg("value").alias("mean"), F.first(lo).alias("fence_low"), F.first(hi).alias("fence_high"),
        F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
        F.count_if(~inside).alias("n_outside"))


def histogram(df: DataFrame, col: str, bins: int = 30) -> DataFrame:
    """Equal-width bins between the column's min and max (max in the last bin)."""
    lim = df.agg(F.min(col).alias("__lo"), F.max(col).alias("__hi"))
    j = with_scalars(df.where(F.col(col).isNotNull()), lim)
    pos = F.floor((F.col(col) - F.col("__lo")) / (F.col("__hi") - F.col("__lo")) * bins) + 1
    b = F.when(F.col("__hi") == F.col("__lo"), F.lit(1)).otherwise(F.least(pos, F.lit(bins))) \
        .cast("int")
    width = (F.col("__hi") - F.col("__lo")) / bins
    return j.groupBy(b.alias("bin")).agg(
        F.count(F.lit(1)).alias("count"),
        F.first(F.col("__lo") + (b - 1) * width).alias("bin_start"),
        F.first(F.col("__lo") + b * width).alias("bin_end")).orderBy("bin")


def last_n_per_group(df: DataFrame, n: int = 20, group: str = "site_code",
                     order: str = "date_key") -> DataFrame:
    """The newest ``n`` rows of each group, re-sorted ascending (per-group
    top-k: a window over at most one row per key in the group)."""
    w = Window.partitionBy(group).orderBy(F.desc(order))
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= n) \
        .drop("__rn").orderBy(group, order)


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """Top-k report (Spark plans ``orderBy().limit()`` as TakeOrderedAndProject:
    each task keeps its k best, the driver merges k x tasks rows)."""
    return df.orderBy(*order).limit(k)


def distinct_sorted(df: DataFrame, col: str = "site_code") -> DataFrame:
    return df.select(col).where(F.col(col).isNotNull()).distinct().orderBy(col)


def deterministic_sample(df: DataFrame, n: int = 500, keys: Sequence[str] | None = None,
                         seed: int = 42) -> DataFrame:
    """Reproducible sample of at most ``n`` rows: smallest MD5 of seed and keys."""
    keys = list(keys or df.columns)
    h = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))
    return df.withColumn("__h", h).orderBy("__h", *keys).limit(n).drop("__h")


def union_distinct(frames: Sequence[DataFrame], col: str = "site_code") -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), [f.select(col) for f in frames]).distinct()


def describe_all(df: DataFrame, method: str = "exact") -> DataFrame:
    """Every column in one long table: numeric statistics for numeric
    columns, count / unique / top / freq for text columns (nulls elsewhere)."""
    num = describe(df, method=method) if numeric_columns(df) else None
    txt = describe_strings(df) if string_columns(df) else None
    parts = []
    if num is not None:
        parts.append(num.drop("position").withColumn("unique", F.lit(None).cast("long"))
                     .withColumn("top", F.lit(None).cast("string"))
                     .withColumn("freq", F.lit(None).cast("long")))
    if txt is not None:
        parts.append(txt)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def preview(df: DataFrame, n: int = 20) -> DataFrame:
    """First ``n`` rows (a report preview; the limit is the feature)."""
    return df.limit(n)
