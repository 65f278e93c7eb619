"""Star schema: three facts and four dimensions derived from silver tables.

Facts keep their grain; dimensions are distinct unions of the fact keys.
Dimensions are bounded by the key domains (sites, lines, products, calendar
days), never by fact volume, which is what lets joins against them become
broadcast hash joins at run time.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantwise.functions.dates import date_key_from_day, date_key_from_month, date_key_parts, \
    date_key_to_date


def fact_costs(silver_costs: DataFrame) -> DataFrame:
    """Cost lines keyed by the first day of their month; undated rows dropped."""
    return silver_costs.where(F.col("ref_month").isNotNull()).select(
        date_key_from_month("ref_month").alias("date_key"),
        "site_code", "cost_center", "account_code", "account_name",
        "amount_br", "amount_fx", "fx_rate")


def fact_manufacturing(silver_manufacturing: DataFrame) -> DataFrame:
    """Production records keyed by day (null date -> null key, row kept)."""
    return silver_manufacturing.select(
        date_key_from_day("date").alias("date_key"),
        "site_code", "line_code", "product_code",
        "units_ok", "units_rework", "scrap_units", "takt_time_s", "oee")


def fact_energy(silver_energy: DataFrame) -> DataFrame:
    """Daily energy roll-up per (day, site, line, equipment).

    A plain ``groupBy``: Spark aggregates partially before the shuffle, so a
    hot key ships at most one partial row per map task.
    """
    return (silver_energy
            .select(date_key_from_day("timestamp").alias("date_key"),
                    "site_code", "line_code", "equip_code", "kwh", "kw_demand", "kvarh")
            .groupBy("date_key", "site_code", "line_code", "equip_code")
            .agg(F.sum("kwh").alias("kwh_day"),
                 F.max("kw_demand").alias("kw_demand_peak_day"),
                 F.sum("kvarh").alias("kvarh_day")))


def dim_site(fc: DataFrame, fm: DataFrame, fe: DataFrame) -> DataFrame:
    """Distinct sites of the three facts; a null site stays as one row."""
    return (fc.select("site_code").distinct()
            .unionByName(fm.select("site_code").distinct())
            .unionByName(fe.select("site_code").distinct())
            .distinct())


def dim_line(fm: DataFrame, fe: DataFrame) -> DataFrame:
    """Distinct (site, line) of production and energy, line not null."""
    return (fm.where(F.col("line_code").isNotNull()).select("site_code", "line_code").distinct()
            .unionByName(fe.where(F.col("line_code").isNotNull())
                         .select("site_code", "line_code").distinct())
            .distinct())


def dim_product(fm: DataFrame) -> DataFrame:
    return fm.where(F.col("product_code").isNotNull()).select("product_code").distinct()


def dim_date(fc: DataFrame, fm: DataFrame, fe: DataFrame) -> DataFrame:
    """Calendar of every date key in the facts, with date, y, m, d."""
    keys = (fc.select("date_key").distinct()
            .unionByName(fm.select("date_key").distinct())
            .unionByName(fe.select("date_key").distinct())
            .distinct())
    p = date_key_parts("date_key")
    return keys.select("date_key", date_key_to_date("date_key").alias("date"),
                       p["y"].alias("y"), p["m"].alias("m"), p["d"].alias("d"))


def with_calendar(fact: DataFrame, dd: DataFrame) -> DataFrame:
    """Inner join ``USING (date_key)`` with the calendar (adds date, y, m, d)."""
    return fact.join(dd, "date_key")


@dataclass
class Star:
    fact_costs: DataFrame
    fact_manufacturing: DataFrame
    fact_energy: DataFrame
    dim_site: DataFrame
    dim_line: DataFrame
    dim_product: DataFrame
    dim_date: DataFrame
    derived: bool = False   # dimensions are the unions of these facts' keys (build_star)

    def calendar(self) -> DataFrame | None:
        """Calendar to join KPIs with; None when it is derived from the facts
        themselves (see :func:`plantwise.operators.kpi.with_calendar`)."""
        return None if self.derived else self.dim_date

    def persist(self, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> "Star":
        """Keep facts and dims for a run of many rules (views re-expand otherwise)."""
        for df in self.tables().values():
            df.persist(level)
        return self

    def unpersist(self) -> None:
        for df in self.tables().values():
            df.unpersist()

    def tables(self) -> dict[str, DataFrame]:
        return {k: getattr(self, k) for k in (
            "dim_date", "dim_site", "dim_line", "dim_product",
            "fact_costs", "fact_manufacturing", "fact_energy")}

    def register(self, prefix: str = "") -> None:
        """Named temp views (``fact_costs``, ``dim_date`` ...)."""
        for k, df in self.tables().items():
            df.createOrReplaceTempView(prefix + k)


def build_star(silver_costs: DataFrame, silver_manufacturing: DataFrame,
               silver_energy: DataFrame) -> Star:
    fc = fact_costs(silver_costs)
    fm = fact_manufacturing(silver_manufacturing)
    fe = fact_energy(silver_energy)
    return Star(fc, fm, fe, dim_site(fc, fm, fe), dim_line(fm, fe), dim_product(fm),
                dim_date(fc, fm, fe), derived=True)


def star_from_driver(spark, sf_dir: str, energy_source: str = "lineitem") -> Star:
    """Star over the driver tables (``energy_source`` lineitem or events)."""
    from plantwise.sources import adapters as a
    energy = a.silver_energy(spark, sf_dir) if energy_source == "lineitem" \
        else a.silver_energy_events(spark, sf_dir)
    return build_star(a.silver_costs(spark, sf_dir), a.silver_manufacturing(spark, sf_dir), energy)
