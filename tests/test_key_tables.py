"""Key tables of the rule suite grow with the keys, not with their combinations."""

from pyspark.sql import functions as F

from plantwise.operators import quality as Q
from plantwise.operators import star as S
from plantwise.plans.feature_table import kpi_frames


def _star(spark):
    """400 records, each of another day, site, line and product combination; keys may be null."""
    i = F.col("id")
    r = spark.range(400).select(
        F.expr("timestamp_ntz'2025-01-01' + make_interval(0, 0, 0, int(id % 20))").cast("timestamp").alias("date"),
        F.when(i % 5 > 0, F.concat(F.lit("S"), i % 5)).alias("site_code"), F.when(i % 7 > 0, F.concat(F.lit("L"), i % 7)).alias("line_code"),
        F.when(i % 11 > 0, F.concat(F.lit("P"), i % 11)).alias("product_code"), i.alias("units_ok"), F.lit(0).alias("units_rework"),
        F.lit(0).alias("scrap_units"), F.lit(1.0).alias("takt_time_s"), F.lit(0.5).alias("oee"))
    energy = r.select(F.col("date").alias("timestamp"), "site_code", "line_code", F.concat(F.lit("E"), F.col("units_ok")).alias("equip_code"),
                      F.col("units_ok").cast("decimal(15,2)").alias("kwh"), F.lit(1.0).alias("kw_demand"), F.lit(0.0).alias("kvarh"))
    costs = r.select(F.date_trunc("month", "date").alias("ref_month"), "site_code", F.lit("C").alias("cost_center"), F.lit("A").alias("account_code"),
                     F.lit("a").alias("account_name"), F.col("units_ok").cast("decimal(15,2)").alias("amount_br"), F.lit(1.0).alias("amount_fx"), F.lit(1.0).alias("fx_rate"))
    return S.build_star(costs, r, energy)


def test_key_tables_hold_a_row_a_key(spark):
    star = _star(spark)
    keys = Q.fact_key_tables(star)
    assert keys["manufacturing"].count() <= 20 * 5 + 5 * 7 + 11   # days x sites, lines, products
    assert keys["energy"].count() <= 20 * 5 + 5 * 7
    for name, fact in (("costs", star.fact_costs), ("manufacturing", star.fact_manufacturing), ("energy", star.fact_energy)):
        for kind in Q._SETS_OF[name]:
            cols = Q.KEY_SETS[kind]
            got = sorted(map(str, Q.of_kind(keys, kind)[name].select(*cols, "n").collect()))
            assert got == sorted(map(str, fact.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).collect()))


def test_suite_and_kpis_from_shared_key_tables(spark):
    star = _star(spark)
    keys = Q.fact_key_tables(star)
    a, b = ({r.rule_id: (r.ok, r.message, r.meta) for r in df.collect()}
            for df in (Q.run_suite(star, as_of="2025-10-28", keys=keys), Q.run_rules(star, as_of="2025-10-28")))
    assert a == b
    for own, shared in zip(kpi_frames(star, shared=False), kpi_frames(star, keys=Q.of_kind(keys, "pair"))):
        assert sorted(map(str, own.collect())) == sorted(map(str, shared.select(*own.columns).collect()))
