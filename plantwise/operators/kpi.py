"""Unit-cost, unit-energy and FX KPIs plus the reconciliation base.

Parity variants reproduce the published definition, where facts are joined
many-to-many on (site, date_key) *before* summing, so each side is weighted by
the other side's row count.  They are computed without materialising that
fan-out: each side is aggregated per key first (row count and sum), and the
pair sums follow exactly --

    SUM over pairs of a = sum(a) * max(n_other, 1)      (left side)
    SUM over pairs of b = n_left * sum(b)               (right side)

so the shuffle carries one row per key instead of n_left * n_right rows; a
hot key cannot blow up the join.  ``*_preagg`` variants give the plain ratio
of sums (the definition the KPI names promise).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantwise.functions.dates import date_key_parts
from plantwise.functions.safe import ratio
from plantwise.functions.scalars import with_scalars

KEYS = ["date_key", "site_code"]


def _dratio(num, den):
    """Division in double precision (fixed-point sums are cast first, so the
    quotient is one correctly rounded IEEE division), null on a zero divisor."""
    n = F.col(num) if isinstance(num, str) else num
    d = F.col(den) if isinstance(den, str) else den
    return ratio(n.cast("double"), d.cast("double"))


def with_calendar(df: DataFrame, dd: DataFrame | None) -> DataFrame:
    """Inner join with the calendar for (y, m).

    ``dd=None`` means the calendar is the one derived from these same facts
    (every non-null fact key is in it): the join is then equivalent to
    ``date_key IS NOT NULL`` plus key arithmetic, and skipping it saves
    re-scanning every fact just to rebuild the calendar.
    """
    if dd is None:
        p = date_key_parts("date_key")
        return df.where(F.col("date_key").isNotNull()).withColumn("y", p["y"]).withColumn("m", p["m"])
    return df.join(dd.select("date_key", "y", "m"), "date_key")


def _per_key(df: DataFrame, value: str, s: str, n: str) -> DataFrame:
    return df.groupBy(*KEYS).agg(F.sum(value).alias(s), F.count(F.lit(1)).alias(n))


def _fanout_pair(left: DataFrame, lval: str, fm: DataFrame, dd: DataFrame) -> DataFrame:
    """left JOIN dim_date LEFT JOIN manufacturing, as pair sums per key."""
    lk = _per_key(left, lval, "__ls", "__ln")
    mk = _per_key(fm, "units_ok", "__ms", "__mn")
    j = with_calendar(lk, dd).join(mk, KEYS, "left")
    return j.select(
        "date_key", "y", "m", "site_code",
        (F.col("__ls") * F.greatest(F.coalesce(F.col("__mn"), F.lit(0)), F.lit(1))).alias("__pair_l"),
        (F.col("__ln") * F.col("__ms")).alias("__pair_units"))


def kpi_cost_per_unit(fc: DataFrame, fm: DataFrame, dd: DataFrame | None) -> DataFrame:
    """SUM(amount_br) / NULLIF(SUM(units_ok), 0) over the fan-out join."""
    p = _fanout_pair(fc, "amount_br", fm, dd)
    return p.select("date_key", "y", "m", "site_code",
                    _dratio("__pair_l", "__pair_units").alias("cost_per_unit"))


def kpi_energy_per_unit(fe: DataFrame, fm: DataFrame, dd: DataFrame | None) -> DataFrame:
    """SUM(kwh_day) / NULLIF(SUM(units_ok), 0) over the fan-out join."""
    p = _fanout_pair(fe, "kwh_day", fm, dd)
    return p.select("date_key", "y", "m", "site_code",
                    _dratio("__pair_l", "__pair_units").alias("kwh_per_unit"))


def key_sums(fc: DataFrame, fm: DataFrame, fe: DataFrame) -> dict[str, DataFrame]:
    """Per (date_key, site) row counts and sums of each fact -- everything
    the three KPIs need, one aggregation per fact.  Bounded by days x sites."""
    return {
        "costs": fc.groupBy(*KEYS).agg(
            F.count(F.lit(1)).alias("n"), F.sum("amount_br").alias("s"),
            F.sum(F.col("amount_br").cast("double") - F.col("amount_fx") * F.col("fx_rate"))
            .alias("s_fx")),
        "manufacturing": fm.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n"),
                                               F.sum("units_ok").alias("s")),
        "energy": fe.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n"),
                                        F.sum("kwh_day").alias("s")),
    }


def kpis_from_key_sums(keys: dict[str, DataFrame], dd: DataFrame | None = None
                       ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three KPIs (same rows as the per-fact operators) from
    :func:`key_sums`; each fact's sums are read once per KPI."""
    c, m, e = keys["costs"], keys["manufacturing"], keys["energy"]

    def pair(left: DataFrame, name: str) -> DataFrame:
        j = with_calendar(left.select("date_key", "site_code", F.col("s").alias("__ls"),
                                      F.col("n").alias("__ln")), dd) \
            .join(m.select("date_key", "site_code", F.col("s").alias("__ms"),
                           F.col("n").alias("__mn")), KEYS, "left")
        num = F.col("__ls") * F.greatest(F.coalesce(F.col("__mn"), F.lit(0)), F.lit(1))
        den = F.col("__ln") * F.col("__ms")
        return j.select("date_key", "y", "m", "site_code", _dratio(num, den).alias(name))

    fx = c.select("date_key", "site_code", _dratio("s_fx", "s").alias("fx_effect_ratio"))
    return pair(c, "cost_per_unit"), pair(e, "kwh_per_unit"), fx


def kpi_fx_effect(fc: DataFrame) -> DataFrame:
    """SUM(amount_br - amount_fx*fx_rate) / NULLIF(SUM(amount_br), 0)."""
    return fc.groupBy(*KEYS).agg(
        _dratio(F.sum(F.col("amount_br").cast("double") - F.col("amount_fx") * F.col("fx_rate")),
                F.sum("amount_br")).alias("fx_effect_ratio"))


def _month_key(c: str = "date_key"):
    p = date_key_parts(c)
    return (p["y"] * 10000 + p["m"] * 100 + 1).cast("int")


def kpi_cost_per_unit_preagg(fc: DataFrame, fm: DataFrame, dd: DataFrame,
                             grain: str = "day") -> DataFrame:
    """Ratio of independent sums; ``grain='month'`` rolls production to months."""
    m = fm.withColumn("date_key", _month_key()) if grain == "month" else fm
    c = fc.groupBy(*KEYS).agg(F.sum("amount_br").alias("__c"))
    u = m.groupBy(*KEYS).agg(F.sum("units_ok").alias("__u"))
    return (with_calendar(c, dd).join(u, KEYS, "left")
            .select("date_key", "y", "m", "site_code", _dratio("__c", "__u").alias("cost_per_unit")))


def kpi_energy_per_unit_preagg(fe: DataFrame, fm: DataFrame, dd: DataFrame) -> DataFrame:
    e = fe.groupBy(*KEYS).agg(F.sum("kwh_day").alias("__e"))
    u = fm.groupBy(*KEYS).agg(F.sum("units_ok").alias("__u"))
    return (with_calendar(e, dd).join(u, KEYS, "left")
            .select("date_key", "y", "m", "site_code", _dratio("__e", "__u").alias("kwh_per_unit")))


def kpi_oee_avg(fm: DataFrame) -> DataFrame:
    """Mean OEE per (date_key, site) (declared in the docs, no code there)."""
    return fm.groupBy(*KEYS).agg(F.avg("oee").alias("oee_avg"))


def recon_base(fc: DataFrame, other: DataFrame, other_value: str, dd: DataFrame,
               total_name: str = "total_units") -> DataFrame:
    """Per (y, m, site): cost and driver totals over the fan-out join,
    keeping groups whose driver total is > 0 (``HAVING SUM(x) > 0``)."""
    lk = _per_key(fc, "amount_br", "__ls", "__ln")
    ok = _per_key(other, other_value, "__os", "__on")
    j = with_calendar(lk, dd).join(ok, KEYS, "left")
    pair_cost = F.col("__ls") * F.greatest(F.coalesce(F.col("__on"), F.lit(0)), F.lit(1))
    pair_other = F.col("__ln") * F.col("__os")
    return (j.groupBy("y", "m", "site_code")
            .agg(F.sum(pair_cost).cast("double").alias("total_cost_brl"),
                 F.sum(pair_other).cast("double").alias(total_name))
            .where(F.col(total_name) > 0))


def recon_deviation(base: DataFrame, driver_col: str = "total_units") -> DataFrame:
    """rel_diff = |cost - avg_cost * driver / avg_driver| / avg_cost.

    The grand means are scalar subqueries over a one-row aggregate instead
    of an unpartitioned ``AVG() OVER ()`` window, which would pull every row
    into a single task.
    """
    means = base.agg(F.avg("total_cost_brl").alias("__avg_cost"),
                     F.avg(driver_col).alias("__avg_drv"))
    j = with_scalars(base, means)
    expected = F.col("__avg_cost") * ratio(F.col(driver_col), F.col("__avg_drv"))
    rel = ratio(F.abs(F.col("total_cost_brl") - expected), F.col("__avg_cost"))
    return j.select(*base.columns, rel.alias("rel_diff"))


def cost_composition_check(df: DataFrame, total: str, parts: list[str],
                           tol: float = 0.005) -> DataFrame:
    """Rows where total differs from the sum of its parts by more than tol
    (relative; a total of 0 beside non-zero parts differs without bound) -- the
    reconciliation the docs declare (D2)."""
    s = sum((F.coalesce(F.col(p), F.lit(0.0)) for p in parts[1:]),
            F.coalesce(F.col(parts[0]), F.lit(0.0)))
    gap = F.abs(F.col(total) - s)
    rel = F.when(gap == 0, F.lit(0.0)).otherwise(F.coalesce(ratio(gap, F.abs(F.col(total))), F.lit(float("inf"))))
    return df.withColumn("composition_rel_diff", rel).where(F.col(total).isNotNull() & (F.col("composition_rel_diff") > tol))


def cost_composition_monthly(df: DataFrame, total: str, parts: list[str], by: list[str],
                             tol: float = 0.001) -> DataFrame:
    """The same per month (``by``): sums that differ by more than 0.1 %."""
    sums = df.groupBy(*by).agg(*[F.sum(F.coalesce(F.col(c), F.lit(0.0))).alias(c) for c in [total, *parts]])
    return cost_composition_check(sums, total, parts, tol)
