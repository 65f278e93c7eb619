"""Time-series feature engineering on the KPI table.

The KPI table is unique on (date_key, site_code), so a site's partition of
a window holds at most one row per calendar day: per-site windows (lag,
rolling mean) are bounded by the calendar, not by data volume.  Group
statistics are computed with ``groupBy`` (medians and quantiles through the
distributed exact quantiles) and joined back, never with an unpartitioned
window.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plantwise.functions.dates import date_key_parts, month_start_of_key
from plantwise.functions.materialize import materialize
from plantwise.functions.quantiles import WINDOW_ROWS, counted_values, quantiles, quantiles_of_counts, recounted
from plantwise.functions.ranking import rank_rows
from plantwise.functions.safe import ratio
from plantwise.functions.scalars import with_scalars

MERGE_KEYS = ["date_key", "site_code", "y", "m"]
KPI_COLS = ["cost_per_unit", "kwh_per_unit", "fx_effect_ratio"]
IMP_COLS = [c + "_imp" for c in KPI_COLS]
# Robust z constant and outlier threshold.
MAD_TO_SIGMA = 1.4826
SIGMA_K = 3


def _with_time_keys(df: DataFrame) -> DataFrame:
    p = date_key_parts("date_key")
    out = df
    for k in ("y", "m"):
        if k not in df.columns:
            out = out.withColumn(k, p[k])
    return out.withColumn("y", F.col("y").cast("int")).withColumn("m", F.col("m").cast("int")) \
        .withColumn("month_start", month_start_of_key("date_key"))


def _full_outer(a: DataFrame, b: DataFrame, keys: list[str], suffixes=("_x", "_y")) -> DataFrame:
    """pandas-style outer merge: null keys match each other, clashing
    non-key columns get suffixes."""
    clash = (set(a.columns) & set(b.columns)) - set(keys)
    a2 = a.select(*[F.col(c).alias(c + suffixes[0] if c in clash else c) for c in a.columns])
    b2 = b.select(*[F.col(c).alias(c + suffixes[1] if c in clash else "__r_" + c if c in keys
                                   else c) for c in b.columns])
    cond = [a2[k].eqNullSafe(b2["__r_" + k]) for k in keys]
    j = a2.join(b2, cond, "full_outer")
    out = [F.coalesce(a2[k], b2["__r_" + k]).alias(k) for k in keys]
    out += [F.col(c) for c in a2.columns if c not in keys]
    out += [F.col(c) for c in b2.columns if not c.startswith("__r_")]
    return j.select(*out)


def consolidate_kpis(cost: DataFrame, energy: DataFrame, fx: DataFrame) -> DataFrame:
    """Three-way outer merge on (date_key, site_code, y, m).

    ``month_start`` of the cost and energy frames become
    ``month_start_cost`` / ``month_start_energy``; the FX frame's stays
    ``month_start`` (so it is null on rows without an FX value).
    """
    c, e, f = (_with_time_keys(x) for x in (cost, energy, fx))
    ce = _full_outer(c, e, MERGE_KEYS, ("_cost", "_energy"))
    return _full_outer(ce, f, MERGE_KEYS)


def _stack(df: DataFrame, cols: Sequence[str], keep: Sequence[str]) -> DataFrame:
    return df.select(*keep, F.explode(F.array(*[
        F.struct(F.lit(c).alias("kpi"), F.col(c).cast("double").alias("value")) for c in cols
    ])).alias("__kv")).select(*keep, "__kv.kpi", "__kv.value")


def impute_hierarchical(df: DataFrame, cols: Sequence[str] = KPI_COLS,
                        levels: Sequence[Sequence[str]] = (("site_code", "m"), ("site_code",),
                                                           ("m",), ()),
                        suffix: str = "_imp", method: str = "exact") -> DataFrame:
    """``<c>_imp`` = value, else median by each level in turn (medians always
    of the original column; null group keys get no group median).

    The values are counted once, per all level keys together; the levels are
    grouping sets over the counted table, and one quantile walk gives the
    medians of every level and column.
    """
    cols, levels = list(cols), [list(lv) for lv in levels]
    if method != "exact":
        return _impute_by_level(df, cols, levels, suffix, method)
    keys = list(dict.fromkeys(k for lv in levels for k in lv))
    base = _stack(df, cols, keys).where(F.col("value").isNotNull() & ~F.isnan("value"))
    counted = materialize(base.groupBy("kpi", *keys, "value").agg(F.count(F.lit(1)).alias("n")), "kpi-values")
    # One row a level: its keys as text, the others empty; a null key has no level.
    none = F.lit("")
    sets = [F.when(_all_known(lv), F.struct(F.lit(i).alias("__lv"), *[(F.col(k).cast("string") if k in lv else none).alias(f"__k_{k}") for k in keys]))
            for i, lv in enumerate(levels)]
    by = ["kpi", "__lv", *[f"__k_{k}" for k in keys]]
    parts = counted.select("kpi", "value", "n", F.explode(F.array(*sets)).alias("__set")).where(F.col("__set").isNotNull()).select("kpi", "__set.*", "value", "n")
    parts = parts.groupBy(*by, F.col("value").alias("__q_v")).agg(F.sum("n").alias("__q_n"))
    rows = counted.count() * len(levels)   # no level has more values
    if rows > WINDOW_ROWS:
        parts = materialize(parts, "level-values")
    medians = materialize(quantiles_of_counts(parts, by, [0.5], ["med"], rows), "level-medians")
    out = df
    fills = {c: [] for c in cols}
    for i, lv in enumerate(levels):
        one = medians.where(F.col("__lv") == i)
        g = one.groupBy(*[F.col(f"__k_{k}").alias(f"__k{i}_{k}") for k in lv]) if lv else one.groupBy()
        wide = g.agg(*[F.max(F.when(F.col("kpi") == c, F.col("med"))).alias(f"__med{i}_{c}") for c in cols])
        if lv:
            out = out.join(wide, reduce(lambda a, b: a & b, [F.col(k).cast("string") == F.col(f"__k{i}_{k}") for k in lv]), "left")
        else:
            out = with_scalars(out, wide)
        for c in cols:
            fills[c].append(F.col(f"__med{i}_{c}"))
    return out.select(*df.columns, *[F.coalesce(F.col(c), *fills[c]).alias(c + suffix) for c in cols])


def _all_known(cols: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols], F.lit(True))


def _impute_by_level(df: DataFrame, cols: list[str], levels: list[list[str]], suffix: str, method: str) -> DataFrame:
    """:func:`impute_hierarchical` with one (approximate) quantile pass a level."""
    out = df
    fills = {c: [] for c in cols}
    for i, lv in enumerate(levels):
        wide = _group_stats_wide(df, cols, lv, [0.5], [f"med{i}"], method)
        out = out.join(wide, lv, "left") if lv else with_scalars(out, wide)
        for c in cols:
            fills[c].append(F.col(f"__med{i}_{c}"))
    return out.select(*df.columns, *[F.coalesce(F.col(c), *fills[c]).alias(c + suffix) for c in cols])


def series_order(date_col: str = "month_start", tie: str = "date_key") -> list[Column]:
    """Row order of a site series: the month column nulls last, then the key."""
    return [F.col(date_col).asc_nulls_last(), F.col(tie).asc()]


def add_lag_roll(df: DataFrame, col: str, group: str = "site_code",
                 order: Sequence[Column] | None = None, window: int = 3,
                 min_periods: int = 2, method: str = "window") -> DataFrame:
    """``<col>_lag1`` (previous row) and ``<col>_roll3`` (mean of the last
    ``window`` rows incl. the current one, null below ``min_periods``
    non-null values) within each group.

    ``method="window"``: a window per group -- right when a group is bounded
    (the KPI table holds one row per day and site).  ``method="ranked"``:
    rows get a distributed rank within their group and the previous rows are
    fetched by equi-joins on (group, rank - k), which hash-spread even a
    group holding a large share of all rows over many tasks.
    """
    order = list(order) if order is not None else series_order()
    if method == "ranked":
        return _lag_roll_ranked(df, col, group, order, window, min_periods)
    w = Window.partitionBy(group).orderBy(*order)
    wr = w.rowsBetween(-(window - 1), 0)
    return (df.withColumn(f"{col}_lag1", F.lag(col, 1).over(w))
            .withColumn(f"{col}_roll{window}",
                        F.when(F.count(col).over(wr) >= min_periods, F.avg(col).over(wr))))


def _lag_roll_ranked(df: DataFrame, col: str, group: str, order: Sequence[Column],
                     window: int, min_periods: int) -> DataFrame:
    r = rank_rows(df, order, by=[group], name="__lr_rank")
    base = r.select(F.col(group).alias("__lr_g"), F.col("__lr_rank").alias("__lr_src"),
                    F.col(col).alias("__lr_v"))
    out = r
    for k in range(1, window):
        prev = base.select(F.col("__lr_g").alias(group),
                           (F.col("__lr_src") + k).alias("__lr_rank"),
                           F.col("__lr_v").alias(f"__lr_p{k}"))
        out = out.join(prev, [group, "__lr_rank"], "left")
    vals = [F.col(col)] + [F.col(f"__lr_p{k}") for k in range(1, window)]
    n = sum((F.when(v.isNotNull(), 1).otherwise(0) for v in vals[1:]),
            F.when(vals[0].isNotNull(), 1).otherwise(0))
    total = sum((F.coalesce(v, F.lit(0.0)) for v in vals[1:]), F.coalesce(vals[0], F.lit(0.0)))
    out = out.withColumn(f"{col}_lag1", F.col("__lr_p1") if window > 1 else F.lit(None)) \
        .withColumn(f"{col}_roll{window}", F.when(n >= min_periods, total / n))
    return out.drop("__lr_rank", *[f"__lr_p{k}" for k in range(1, window)])


def flag_outliers_3sigma(df: DataFrame, col: str, by: Sequence[str] | None = None,
                         k: float = SIGMA_K) -> DataFrame:
    """z = (x - mean) / sample std (globally or per group); outlier if |z| > k.
    Zero or undefined std gives a null z and no flag.  Adds ``<col>_mean``
    and ``<col>_std`` when grouped, ``<col>_z`` and ``<col>_is_outlier``."""
    return flag_outliers_many(df, [col], by, k)


def flag_outliers_many(df: DataFrame, cols: Sequence[str], by: Sequence[str] | None = None,
                       k: float = SIGMA_K) -> DataFrame:
    """:func:`flag_outliers_3sigma` for several columns with one aggregation
    and one join (instead of one self-join per column)."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"{c}_mean"), F.stddev_samp(c).alias(f"{c}_std")]
    if by:
        out = df.join(df.groupBy(*by).agg(*aggs), list(by), "left")
    else:
        out = with_scalars(df, df.agg(*aggs))
    for c in cols:
        z = ratio(F.col(c) - F.col(f"{c}_mean"), F.col(f"{c}_std"))
        out = out.withColumn(f"{c}_z", z).withColumn(
            f"{c}_is_outlier", F.coalesce(F.abs(F.col(f"{c}_z")) > k, F.lit(False)))
        if not by:
            out = out.drop(f"{c}_mean", f"{c}_std")
    return out


def winsorize_by_group(df: DataFrame, col: str, by: Sequence[str], lower: float = 0.01,
                       upper: float = 0.99, method: str = "exact") -> DataFrame:
    """``<col>_cap`` = value clipped to the group's [lower, upper] quantiles."""
    q = quantiles(df, col, [lower, upper], by=by, names=["__lo", "__hi"], method=method)
    out = df.join(q, list(by), "left")
    x = F.col(col)
    capped = F.when(F.col("__lo").isNotNull(), F.least(F.greatest(x, F.col("__lo")), F.col("__hi")))
    return out.withColumn(f"{col}_cap", F.when(x.isNotNull(), F.coalesce(capped, x))) \
        .drop("__lo", "__hi")


def _group_stats_wide(df: DataFrame, cols: Sequence[str], by: Sequence[str],
                      probs: Sequence[float], names: Sequence[str], method: str) -> DataFrame:
    """Quantiles of several columns in one distributed pass (stacked long),
    pivoted back to one row per group with ``__<name>_<col>`` columns."""
    by = list(by)
    long = _stack(df, cols, by)
    q = quantiles(long, "value", probs, by=["kpi", *by], names=list(names), method=method)
    g = q.groupBy(*by) if by else q.groupBy()
    wide = g.pivot("kpi", list(cols)).agg(*[F.first(n).alias(n) for n in names])
    if len(names) == 1:   # pivot names single aggregates by the pivot value alone
        wide = wide.select(*by, *[F.col(c).alias(f"{c}_{names[0]}") for c in cols])
    return wide.select(*by, *[F.col(f"{c}_{n}").alias(f"__{n}_{c}") for c in cols for n in names])


def add_robust_scaled(df: DataFrame, col: str, by: Sequence[str] | None = None,
                      method: str = "exact") -> DataFrame:
    """``<col>_robust`` = (x - median) / IQR per group (IQR 0 -> 1)."""
    return add_robust_scaled_many(df, [col], by, method)


def add_robust_scaled_many(df: DataFrame, cols: Sequence[str], by: Sequence[str] | None = None,
                           method: str = "exact") -> DataFrame:
    by = list(by or [])
    st = _group_stats_wide(df, cols, by, [0.25, 0.5, 0.75], ["q1", "q2", "q3"], method)
    out = df.join(st, by, "left") if by else with_scalars(df, st)
    for c in cols:
        iqr = F.col(f"__q3_{c}") - F.col(f"__q1_{c}")
        scale = F.when(iqr == 0, F.lit(1.0)).otherwise(iqr)
        out = out.withColumn(f"{c}_robust", (F.col(c) - F.col(f"__q2_{c}")) / scale)
    return out.drop(*[f"__{n}_{c}" for c in cols for n in ("q1", "q2", "q3")])


def robust_zscore(df: DataFrame, col: str, out_col: str | None = None,
                  method: str = "exact") -> DataFrame:
    """(x - median) / (1.4826 * MAD); MAD 0 -> sample std if > 0, else 1.
    Nulls are ignored by the statistics and stay null."""
    out = add_robust_features(df, [col], method=method)
    if out_col and out_col != f"{col}_robust":
        out = out.withColumnRenamed(f"{col}_robust", out_col)
    return out


def add_robust_features(df: DataFrame, cols: Sequence[str] = IMP_COLS,
                        method: str = "exact") -> DataFrame:
    """``<c>_robust`` robust z-scores of several columns (two distributed
    quantile passes in total: medians, then median absolute deviations)."""
    cols = [c for c in cols if c in df.columns]
    if not cols:
        return df
    if method == "exact":
        counted = materialize(counted_values(_stack(df, cols, []), "value", ["kpi"]), "kpi-values")
        rows = counted.count()
        med = quantiles_of_counts(counted, ["kpi"], [0.5], ["med"], rows)
        if rows > WINDOW_ROWS:
            med = materialize(med, "kpi-medians")
        # deviations of distinct values, with their counts
        apart = recounted(counted.join(med, "kpi"), F.abs(F.col("__q_v") - F.col("med")), ["kpi"])
        if rows > WINDOW_ROWS:
            apart = materialize(apart, "kpi-deviations")
        both = med.join(quantiles_of_counts(apart, ["kpi"], [0.5], ["mad"], rows), "kpi")
        stats = both.agg(*[F.max(F.when(F.col("kpi") == c, F.col(p))).alias(f"__{p}_{c}") for c in cols for p in ("med", "mad")])
    else:
        med = _group_stats_wide(df, cols, [], [0.5], ["med"], method)
        dev = with_scalars(df, med).select(*[F.abs(F.col(c) - F.col(f"__med_{c}")).alias(c) for c in cols])
        stats = with_scalars(med, _group_stats_wide(dev, cols, [], [0.5], ["mad"], method))
    sd = df.agg(*[F.stddev_samp(c).alias(f"__sd_{c}") for c in cols])
    out = with_scalars(with_scalars(df, materialize(stats, "kpi-scales")), sd)
    for c in cols:
        scale = F.when(F.col(f"__mad_{c}") != 0, F.col(f"__mad_{c}")) \
            .when(F.col(f"__sd_{c}") > 0, F.col(f"__sd_{c}")).otherwise(F.lit(1.0))
        out = out.withColumn(f"{c}_robust",
                             (F.col(c) - F.col(f"__med_{c}")) / (F.lit(MAD_TO_SIGMA) * scale))
    return out.drop(*[f"__{p}_{c}" for c in cols for p in ("med", "mad", "sd")])


def add_robust_if_missing(df: DataFrame, cols: Sequence[str] = IMP_COLS) -> DataFrame:
    """Fallback: ``<c>_robust`` as a copy of ``<c>`` when absent."""
    for c in cols:
        if c in df.columns and f"{c}_robust" not in df.columns:
            df = df.withColumn(f"{c}_robust", F.col(c))
    return df


def drift_mom(kpi: DataFrame, col: str = "cost_per_unit", threshold: float = 0.30,
              group: str = "site_code", key: str = "date_key") -> DataFrame:
    """Month-on-month drift: mean per (key, site), previous value per site,
    keep |x - prev| / prev > threshold (prev signed; prev 0 -> no row)."""
    cur = kpi.groupBy(key, group).agg(F.avg(col).alias("uc"))
    lagged = cur.withColumn("uc_lag", F.lag("uc").over(Window.partitionBy(group).orderBy(key)))
    return lagged.where(F.col("uc_lag").isNotNull()
                        & (ratio(F.abs(F.col("uc") - F.col("uc_lag")), F.col("uc_lag")) > threshold))


def percentile_outliers(kpi: DataFrame, col: str = "cost_per_unit", by: Sequence[str] = ("site_code",),
                        lower: float = 0.01, upper: float = 0.99, method: str = "exact") -> DataFrame:
    """Rows outside their group's [P1, P99] (inner join: null group keys drop)."""
    q = quantiles(kpi, col, [lower, upper], by=by, names=["__p_lo", "__p_hi"], method=method)
    j = kpi.join(q, list(by))
    return j.where((F.col(col) < F.col("__p_lo")) | (F.col(col) > F.col("__p_hi"))) \
        .drop("__p_lo", "__p_hi")


def temporal_split(df: DataFrame, date_col: str, frac: float = 0.8,
                   tie: Sequence[str] = ("site_code",)) -> DataFrame:
    """Adds ``row_rank`` (order: date nulls last, then ``tie``) and ``split``:
    the first ``int(frac * n)`` rows are 'train', the rest 'test'."""
    ranked = rank_rows(df, [date_col, *tie])
    n = df.agg(F.count(F.lit(1)).alias("__n"))
    cut = F.floor(F.lit(float(frac)) * F.col("__n"))
    return with_scalars(ranked, n).withColumn(
        "split", F.when(F.col("row_rank") < cut, "train").otherwise("test")).drop("__n")


def expanding_folds(df: DataFrame, k: int = 5, rank_col: str = "row_rank") -> DataFrame:
    """Expanding-window folds over a ranked frame (TimeSeriesSplit semantics).

    ts = n div (k+1); fold i tests ranks [n-(k-i)*ts, n-(k-i-1)*ts) and
    trains on all earlier ranks.  One output row per (row, fold) membership
    with ``fold`` and ``role`` ('train'/'test').
    """
    n = df.agg(F.count(F.lit(1)).alias("__n"))
    j = with_scalars(df, n)
    ts = F.floor(F.col("__n") / (k + 1))
    folds = []
    for i in range(k):
        start = F.col("__n") - (k - i) * ts
        role = F.when(F.col(rank_col) < start, "train") \
            .when(F.col(rank_col) < start + ts, "test")
        folds.append(F.struct(F.lit(i).alias("fold"), role.alias("role")))
    return j.withColumn("__f", F.explode(F.array(*folds))).select(
        *df.columns, "__f.fold", "__f.role").where(F.col("role").isNotNull())


def outliers_long(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = ("site_code", "m")
                  ) -> DataFrame:
    """Flagged rows of every KPI in long form (site, m, value, z, kpi)."""
    parts = [df.where(F.col(f"{c}_is_outlier")).select(
        *keep, F.col(c).cast("double").alias("value"), F.col(f"{c}_z").alias("z"),
        F.lit(c).alias("kpi")) for c in cols]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def outlier_report_counts(long: DataFrame) -> DataFrame:
    """Counts per (kpi, site, m), kpi ascending then count descending;
    null keys dropped (pandas groupby)."""
    return (long.where(F.col("site_code").isNotNull() & F.col("m").isNotNull())
            .groupBy("kpi", "site_code", "m").agg(F.count(F.lit(1)).alias("n_outliers"))
            .orderBy("kpi", F.desc("n_outliers"), "site_code", "m"))


def global_sigma_counts(df: DataFrame, cols: Sequence[str], k: float = SIGMA_K) -> DataFrame:
    """Per column, rows outside mean +- k * sample std (one pass, long output)."""
    stats = df.agg(*[F.avg(c).alias(f"__m_{i}") for i, c in enumerate(cols)],
                   *[F.stddev_samp(c).alias(f"__s_{i}") for i, c in enumerate(cols)])
    j = with_scalars(df, stats)
    counts = j.agg(*[F.count_if((F.col(c) < F.col(f"__m_{i}") - k * F.col(f"__s_{i}"))
                                | (F.col(c) > F.col(f"__m_{i}") + k * F.col(f"__s_{i}")))
                     .alias(c) for i, c in enumerate(cols)])
    return counts.unpivot([], list(cols), "kpi", "n_outliers")
