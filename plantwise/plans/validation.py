"""Validation run: star -> rule suite -> KPI tables -> QA report exports.

Results are appended with a run id, so reruns keep history; the report
joins the rule registry with the newest results.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantwise.operators import quality as Q
from plantwise.operators.star import Star
from plantwise.sources.catalog import keyed_upsert, materialize_tables
from plantwise.sources.files import write_csv, write_parquet


def run_validation(spark: SparkSession, star: Star, gold_dir: str | None = None,
                   results_path: str | None = None, database: str | None = "analytics",
                   as_of=None, fail_on_error: bool = False, meta_digits: int | None = None) -> dict[str, DataFrame]:
    """Run R1..R13, materialise and export the KPIs, export the QA report.

    ``results_path``: parquet folder the results are appended to (history);
    ``database``: catalog database for the KPI tables (None: skip);
    ``fail_on_error``: raise when an ERROR rule did not pass;
    ``meta_digits``: decimals of the deviations in the report's lists.
    """
    run_id = uuid.uuid4().hex
    keys = Q.fact_key_tables(star)   # each fact aggregated once for the rules and all three KPIs
    results = Q.run_suite(star, as_of=as_of, meta_digits=meta_digits, keys=keys).withColumn("run_id", F.lit(run_id))
    rules = Q.rules_frame(spark)
    if results_path:
        results.write.mode("append").parquet(results_path)
        history = spark.read.parquet(results_path)
        results = history.where(F.col("run_id") == run_id)
    else:
        from plantwise.functions.materialize import materialize
        results = materialize(results, "qa-results")
    from plantwise.plans.feature_table import kpi_frames
    kpis = dict(zip(("kpi_cost_per_unit", "kpi_energy_per_unit", "kpi_fx_effect"),
                    kpi_frames(star, keys=Q.of_kind(keys, "pair"))))
    if database:
        materialize_tables(spark, kpis, database)
    rep = Q.report(rules, results)
    if gold_dir:
        for name, df in kpis.items():
            write_parquet(df, os.path.join(gold_dir, name))
        write_csv(rep, os.path.join(gold_dir, "qa_report_csv"))
        write_parquet(rep, os.path.join(gold_dir, "qa_report"))
    if fail_on_error:
        bad = [r.rule_id for r in Q.failed_errors(results, rules).collect()]   # <= 15 rows
        if bad:
            raise RuntimeError(f"ERROR rules failed: {bad}")
    return {"results": results, "report": rep, **kpis}


def register_rules(existing: DataFrame | None, spark: SparkSession) -> DataFrame:
    """Rule registry with INSERT OR REPLACE semantics on rule_id."""
    new = Q.rules_frame(spark)
    return new if existing is None else keyed_upsert(existing, new, ["rule_id"])
