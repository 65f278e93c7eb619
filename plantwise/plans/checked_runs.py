"""Registered queries of whole runs: layers, saved tables, the validation run and
its exports, each read back from what was written, with its DuckDB text.

Tables go into a database of their own under the shared checkpoint folder, so
that a query leaves nothing in the warehouse."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from plantwise.functions.materialize import new_path
from plantwise.operators import quality as Q
from plantwise.plans import medallion, validation
from plantwise.plans.checked import _LISTED, _table
from plantwise.plans.oracle import deviation, with_star
from plantwise.plans.registry import AS_OF, ORACLE, _qa_sql, _raw_energy, _round, _star, ntz_text, register
from plantwise.sources import catalog
from plantwise.sources import files as S


def _database(spark) -> str:
    return catalog.create_database(spark, f"plantwise_{uuid.uuid4().hex}", new_path(spark, "database"))


# -------------------------------------------------------------------- medallion

@register("medallion_energy", ORACLE["silver_energy_from_text"].replace("\nFROM raw", "\nFROM raw, range(2) delivered"))
def q_medallion_energy(spark, sf_dir):
    """Raw readings delivered as two CSV folders of other column orders, through
    bronze and silver to gold."""
    base = new_path(spark, "medallion")
    raw = _raw_energy(spark, sf_dir)
    S.write_csv(raw, os.path.join(base, "raw", "first"))
    S.write_csv(raw.select(*reversed(raw.columns)), os.path.join(base, "raw", "second"))
    cfg = {"sources": {"energy": {"path": os.path.join(base, "raw", "*", "*.csv"), "datetime_col": "timestamp"}},
           **{layer: os.path.join(base, layer) for layer in ("bronze", "silver", "gold")}, "database": _database(spark)}
    medallion.run_etl(spark, cfg, domains=["energy"])
    gold = spark.read.parquet(os.path.join(cfg["gold"], "energy"))
    return gold.withColumn("timestamp", ntz_text("timestamp")).withColumn("dt", F.col("dt").cast("date").cast("string"))


_RAW_KWH = """(SELECT event_type, value, CASE WHEN event_id % 5 = 0 THEN NULL WHEN user_id % 13 = 0 THEN -value ELSE value END AS kwh FROM events)"""


@register("energy_check_failing", " UNION ALL ".join(f"""
SELECT '{name}' AS readings, COUNT(*) - COUNT(kwh) AS kwh_nulls, COUNT(*) FILTER (WHERE kwh < 0) AS kwh_negative,
       COUNT(*) = COUNT(*) FILTER (WHERE kwh >= 0) AS success FROM {_RAW_KWH} WHERE {cond}""" for name, cond in (("all", "true"), ("good", "kwh >= 0"))))
def q_energy_check_failing(spark, sf_dir):
    """The energy check on readings before they are filled and clipped, some
    missing and some negative, and on those that are neither."""
    kwh = F.when(F.col("event_id") % 5 == 0, None).when(F.col("user_id") % 13 == 0, -F.col("value")).otherwise(F.col("value"))
    raw = _table(spark, sf_dir, "events").select(kwh.alias("kwh"))
    parts = [Q.energy_silver_check(df).select(F.lit(name).alias("readings"), F.col("kwh_nulls").cast("long"), F.col("kwh_negative").cast("long"), "success")
             for name, df in (("all", raw), ("good", raw.where("kwh >= 0")))]
    return parts[0].unionByName(parts[1])


# ----------------------------------------------------------------- saved tables

@register("tables_kept", """
SELECT 'appended' AS kept, c_custkey, c_name, c_nationkey FROM customer, range(2) runs
UNION ALL SELECT 'upserted', c_custkey, CASE WHEN c_custkey % 3 = 0 THEN lower(c_name) ELSE c_name END,
  c_nationkey + CASE WHEN c_custkey % 3 = 0 THEN 100 ELSE 0 END FROM customer""")
def q_tables_kept(spark, sf_dir):
    """A table appended to by position in two runs, and one whose rows a second
    run replaces by key."""
    db = _database(spark)
    rows = _table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    for df in (rows, rows.toDF("key", "label", "nation")):   # the names of a later run don't count
        catalog.append_positional(spark, df, f"{db}.appended")
    anew = rows.where("c_custkey % 3 = 0").select("c_custkey", F.lower("c_name").alias("c_name"), (F.col("c_nationkey") + 100).alias("c_nationkey"))
    for df in (rows, anew):
        catalog.upsert_table(spark, f"{db}.upserted", df, ["c_custkey"])
    parts = [spark.table(f"{db}.{t}").select(F.lit(t).alias("kept"), "c_custkey", "c_name", "c_nationkey") for t in ("appended", "upserted")]
    return parts[0].unionByName(parts[1])


# --------------------------------------------------------------- validation run

@register("validation_report", _qa_sql())
def q_validation_report(spark, sf_dir):
    """The report that a validation run exports, read back from its CSV."""
    base = new_path(spark, "validation")
    validation.run_validation(spark, _star(spark, sf_dir), gold_dir=os.path.join(base, "gold"), results_path=os.path.join(base, "results"),
                              database=None, as_of=AS_OF, meta_digits=6)
    text = S.read_any(spark, os.path.join(base, "gold", "qa_report_csv", "*.csv"))
    return text.select("rule_id", "description", "severity", F.col("ok").cast("boolean").alias("ok"), "message", "meta")


@register("validation_kpis", with_star(" UNION ALL ".join(
    f"SELECT '{kept}' AS kept, '{t}' AS kpi, date_key, site_code, round({c}, {d}) AS value FROM {t}" for kept in ("table", "export") for t, c, d in _LISTED)))
def q_validation_kpis(spark, sf_dir):
    """The KPI tables that a validation run keeps, listed in their order, and
    their parquet exports."""
    base, db = new_path(spark, "validation"), _database(spark)
    validation.run_validation(spark, _star(spark, sf_dir), gold_dir=os.path.join(base, "gold"), database=db, as_of=AS_OF)
    out = None
    for t, c, d in _LISTED:
        for kept, df in (("table", catalog.read_ordered(spark, f"{db}.{t}", ["date_key", "site_code"])), ("export", spark.read.parquet(os.path.join(base, "gold", t)))):
            part = _round(df.select("date_key", "site_code", F.col(c).alias("value")), {"value": d})
            part = part.select(F.lit(kept).alias("kept"), F.lit(t).alias("kpi"), "date_key", "site_code", "value")
            out = part if out is None else out.unionByName(part)
    return out


@register("recon_offenders", with_star("""
SELECT 'R11_RECON_COST_VS_PROD' AS rule_id, y, m, site_code, round(rel_diff, 6) AS rel_diff FROM prod_dev WHERE rel_diff > 0.05
UNION ALL SELECT 'R12_RECON_COST_VS_ENERGY', y, m, site_code, round(rel_diff, 6) FROM energy_dev WHERE rel_diff > 0.05""",
    extra_ctes=deviation("prod_", "units_by_key", "total_units") + "," + deviation("energy_", "energy_by_key", "total_kwh")))
def q_recon_offenders(spark, sf_dir):
    """Months and sites beyond the tolerance of both reconciliations, as rows."""
    return _round(Q.recon_offenders(_star(spark, sf_dir)), {"rel_diff": 6})
