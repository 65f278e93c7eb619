import json

from pyspark.sql import functions as F

from plantwise.operators import quality as Q
from plantwise.operators import star as S


def _faulty_star(spark):
    costs = spark.createDataFrame([
        ("2025-09-01", "SC01", 100.0, 90.0, 1.0),
        ("2025-09-01", None, 10.0, 9.0, 1.0),          # null site -> orphan
        ("2025-10-01", "SC01", -5.0, 1.0, 0.0),        # negative amount, fx_rate 0
    ], "ref_month string, site_code string, amount_br double, amount_fx double, fx_rate double") \
        .select(F.to_timestamp("ref_month").alias("ref_month"), "site_code",
                F.lit("CC").alias("cost_center"), F.lit("A").alias("account_code"),
                F.lit("acc").alias("account_name"), "amount_br", "amount_fx", "fx_rate")
    manu = spark.createDataFrame([
        ("2025-09-01", "SC01", "L1", "P1", 10, 0, 0, 30.0, 1.2),   # oee > 1
        ("2025-09-28", "SC01", None, "P1", 5, 0, 0, 30.0, 0.5),    # null line -> orphan line
        ("2025-09-29", "SC02", "L1", None, 5, 0, 0, 30.0, None),   # null product
    ], "date string, site_code string, line_code string, product_code string, units_ok long, "
       "units_rework long, scrap_units long, takt_time_s double, oee double") \
        .withColumn("date", F.to_timestamp("date"))
    energy = spark.createDataFrame([
        ("2025-09-30 10:00:00", "SC01", "L1", "E1", 5.0, 2.0, 1.0),
    ], "timestamp string, site_code string, line_code string, equip_code string, kwh double, "
       "kw_demand double, kvarh double").withColumn("timestamp", F.to_timestamp("timestamp"))
    return S.build_star(costs, manu, energy)


def _by_id(df):
    return {r.rule_id: r for r in df.collect()}


def test_rules_on_faulty_facts(spark):
    st = _faulty_star(spark)
    r = _by_id(Q.run_rules(st, as_of="2025-10-28"))
    assert len(r) == 15
    assert r["R1_COUNTS"].ok and r["R1_COUNTS"].message.startswith("dim_date=")
    assert r["R2A_FRESHNESS_COSTS"].message == "0 month(s) lag"
    assert r["R2B_FRESHNESS_MANU"].message == "29 day(s) lag" and r["R2B_FRESHNESS_MANU"].ok is False
    assert json.loads(r["R2C_FRESHNESS_ENERGY"].meta) == {"max_date": "2025-09-30"}
    assert r["R3_DIM_KEYS_NOT_NULL"].ok is False        # null site is a dim_site row
    assert r["R5_DOMAIN_COSTS"].message == "rows_invalid=1"
    assert r["R6_DOMAIN_MANU"].message == "rows_invalid=1"
    assert r["R7_DOMAIN_ENERGY"].ok
    assert r["R8_FK_COSTS"].message == "missing_date=0; missing_site=1"
    assert json.loads(r["R8_FK_COSTS"].meta) == {"bad_date_keys": None, "bad_sites": [None]}
    m9 = json.loads(r["R9_FK_MANU"].meta)
    assert r["R9_FK_MANU"].message == "missing_date=0; missing_site=0; missing_line=1; missing_prod=1"
    assert m9["bad_lines"] == [None] and m9["bad_products"] == [None]
    assert r["R13_KPI_VALID_RANGE"].ok in (True, False)
    assert r["R4_DIM_DUPLICATES"].meta == '{"dup_site":null,"dup_line":null,"dup_prod":null}'


def test_one_scan_suite_equals_rule_by_rule(spark):
    st = _faulty_star(spark)
    a = _by_id(Q.run_rules(st, as_of="2025-10-28"))
    b = _by_id(Q.run_suite(st, as_of="2025-10-28", materialized=False))
    for k in a:
        assert (a[k].ok, a[k].message, a[k].meta) == (b[k].ok, b[k].message, b[k].meta), k


def test_report_scoreboard_and_gate(spark):
    st = _faulty_star(spark)
    res = Q.run_suite(st, as_of="2025-10-28", materialized=False)
    rules = Q.rules_frame(spark)
    rep = Q.report(rules, res).collect()
    assert len(rep) == 15 and {"description", "severity"} <= set(rep[0].asDict())
    sb = Q.scoreboard(res).first()
    assert sb.rules_run == 15 and sb.rules_ok + sb.rules_not_ok <= 15
    failed = {r.rule_id for r in Q.failed_errors(res, rules).collect()}
    assert "R5_DOMAIN_COSTS" in failed and "R2B_FRESHNESS_MANU" not in failed
    fk = Q.errors_view(res, rules).collect()
    assert {r.rule_id for r in fk} == {"R8_FK_COSTS", "R9_FK_MANU", "R10_FK_ENERGY"}
    runs = res.withColumn("run_id", F.lit("a")).unionByName(res.withColumn("run_id", F.lit("b")))
    latest = Q.latest_results(runs)   # equal stamps: one run's rows
    assert latest.count() == 15 and {r.run_id for r in latest.collect()} == {"b"}


def test_recon_message_and_meta(spark):
    costs = spark.createDataFrame([(f"2025-0{m}-01", s, a) for m, s, a in
                                   [(4, "A", 100.0), (4, "B", 300.0), (5, "A", 100.0)]],
                                  "ref_month string, site_code string, amount_br double") \
        .select(F.to_timestamp("ref_month").alias("ref_month"), "site_code",
                F.lit("c").alias("cost_center"), F.lit("a").alias("account_code"),
                F.lit("n").alias("account_name"), "amount_br", F.col("amount_br").alias("amount_fx"),
                F.lit(1.0).alias("fx_rate"))
    manu = spark.createDataFrame([(f"2025-0{m}-01", s, u) for m, s, u in
                                  [(4, "A", 10), (4, "B", 10), (5, "A", 10)]],
                                 "date string, site_code string, units_ok long") \
        .select(F.to_timestamp("date").alias("date"), "site_code", F.lit("L").alias("line_code"),
                F.lit("P").alias("product_code"), "units_ok", F.lit(0).cast("long").alias("units_rework"),
                F.lit(0).cast("long").alias("scrap_units"), F.lit(1.0).alias("takt_time_s"),
                F.lit(0.5).alias("oee"))
    energy = manu.select(F.col("date").alias("timestamp"), "site_code", "line_code",
                         F.lit("E").alias("equip_code"), F.lit(1.0).alias("kwh"),
                         F.lit(1.0).alias("kw_demand"), F.lit(1.0).alias("kvarh"))
    st = S.build_star(costs, manu, energy)
    r = Q.rule_recon_cost_vs_production(st).first()
    # mean cost 500/3, mean units 10: A deviates 0.4, B 0.8
    assert r.message == "Máx. desvio relativo = 80.0%" and r.ok is False
    meta = json.loads(r.meta)
    assert [m["site_code"] for m in meta] == ["A", "B", "A"]
    assert abs(meta[1]["rel_diff"] - 0.8) < 1e-12


def test_recon_offenders_are_the_listed_ones(spark):
    from plantwise.plans.registry import _star
    star = _star(spark, "/root/testdata/sf0.001")
    rows = Q.recon_offenders(star).collect()
    for rule in (Q.rule_recon_cost_vs_production(star), Q.rule_recon_cost_vs_energy(star)):
        r = rule.first()
        listed = sorted((x["site_code"], round(x["rel_diff"], 9)) for x in json.loads(r.meta))
        assert listed and listed == sorted((o.site_code, round(o.rel_diff, 9)) for o in rows if o.rule_id == r.rule_id)


def test_tables_lie_under_the_given_location(spark, tmpdir_path):
    import os
    from plantwise.sources import catalog
    where = f"{tmpdir_path}/it's here"
    names = catalog.materialize_tables(spark, {"kept": spark.range(3)}, "pw_located", where)
    assert names == ["pw_located.kept"] and spark.table(names[0]).count() == 3 and os.path.isdir(f"{where}/kept")
    spark.sql("DROP DATABASE pw_located CASCADE")


def test_energy_silver_check(spark):
    df = spark.createDataFrame([(1.0,), (None,), (-1.0,)], "kwh double")
    r = Q.energy_silver_check(df).first()
    assert (r.kwh_nulls, r.kwh_negative, r.success) == (1, 1, False)


def test_validation_plan(spark, tmpdir_path):
    from plantwise.plans.validation import register_rules, run_validation
    st = _faulty_star(spark)
    out = run_validation(spark, st, gold_dir=f"{tmpdir_path}/gold",
                         results_path=f"{tmpdir_path}/results", database=None, as_of="2025-10-28")
    assert out["report"].count() == 15
    run_validation(spark, st, results_path=f"{tmpdir_path}/results", database=None, as_of="2025-10-28")
    assert spark.read.parquet(f"{tmpdir_path}/results").count() == 30   # history kept
    assert spark.read.parquet(f"{tmpdir_path}/gold/qa_report").count() == 15
    assert register_rules(Q.rules_frame(spark), spark).count() == 15
    import pytest
    with pytest.raises(RuntimeError):
        run_validation(spark, st, database=None, as_of="2025-10-28", fail_on_error=True)
