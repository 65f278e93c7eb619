import os

import pytest
from pyspark.sql import functions as F

from plantwise.operators import cleaning as C
from plantwise.plans import medallion as MD
from plantwise.sources import catalog as CAT
from plantwise.sources import files as FS


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_csv_glob_union_by_name_and_empty(spark, tmpdir_path):
    _write(f"{tmpdir_path}/e/a.csv", " DataHora ,site_code,line_code,equip_code,KWH,kw_demand,kvarh,extra\n"
           "2025-04-01 10:00:00,SC01,L1,E1,5.5,2,1,x\n2025-04-01 11:00:00,SC01,L1,E1,abc,3,1,y\n")
    _write(f"{tmpdir_path}/e/b.csv", " DataHora ,site_code,line_code,equip_code,KWH\n"
           "bad-ts,SC01,L1,E1,-3\n01/04/2025,SC02,L2,E2,1\n")
    df = FS.load_csv_glob(spark, f"{tmpdir_path}/e/*.csv")
    assert df.count() == 4 and "extra" in df.columns
    assert df.where(F.col("extra").isNull()).count() == 2
    empty = FS.load_csv_glob(spark, f"{tmpdir_path}/none/*.csv")
    assert empty.count() == 0 and empty.columns == []


def test_transform_energy(spark, tmpdir_path):
    _write(f"{tmpdir_path}/e/a.csv", " DataHora ,site_code,line_code,equip_code,KWH\n"
           "2025-04-01 10:00:00,SC01,L1,E1,5.5\nbad-ts,SC01,L1,E1,-3\n2025-04-02,SC02,L2,E2,abc\n")
    s = C.transform_energy(FS.load_csv_glob(spark, f"{tmpdir_path}/e/*.csv"))
    assert s.columns[:5] == ["timestamp", "site_code", "line_code", "equip_code", "kwh"]
    rows = s.orderBy("site_code", "kwh").collect()
    assert sorted(r.kwh for r in rows) == [0.0, 0.0, 5.5]   # negative clipped, bad -> 0
    assert sum(r.timestamp is None for r in rows) == 1
    assert all(r.dt is None or r.dt.hour == 0 for r in rows)


def test_time_column_resolution_errors(spark):
    df = spark.createDataFrame([("x", 1.0)], "site_code string, kwh double")
    with pytest.raises(KeyError, match="available columns"):
        C.transform_energy(df)
    ok = C.resolve_time_column(spark.createDataFrame([("2025-01-01",)], "TS string").toDF("ts"))
    assert ok.columns == ["timestamp"]


def test_transform_manufacturing_and_costs(spark):
    m = spark.createDataFrame([("2025-04-01", "S", "L", "P", "10.7", None, "2", "-0.1"),
                               ("2025-04-02", "S", "L", "P", "x", "1", "1", "1.2"),
                               ("2025-04-03", "S", "L", "P", "3", "1", "1", None)],
                              "date string, site_code string, line_code string, product_code string, "
                              "units_ok string, units_rework string, scrap_units string, oee string")
    r = C.transform_manufacturing(m).orderBy("date").collect()
    assert [x.units_ok for x in r] == [10, 0, 3] and [x.units_rework for x in r] == [0, 1, 1]
    assert [x.oee for x in r] == [0.0, 1.0, None]
    c = spark.createDataFrame([("2025-04-15", "S", "A", "12.5", "0"), (None, "S", "A", "bad", None)],
                              "ref_month string, site_code string, account_code string, "
                              "amount_br string, fx_rate string")
    rc = C.transform_costs(c).collect()
    assert str(rc[0].dt)[:10] == "2025-04-01" and rc[1].amount_br == 0.0 and rc[1].fx_rate == 0.0


def test_shaping_helpers(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, None, "a"), (2, 3.0, None)],
                               "k int, v double, s string")
    assert C.basic_clean(df).count() == 2
    assert C.basic_clean(df).where("s = '0'").count() == 1
    d = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int").toDF("a", "b", "a")
    assert C.dedupe_column_names(d).columns == ["a", "b"]
    f = spark.createDataFrame([(1.0, 1.0, True, 1.0)], "x double, x_mean double, x_is_outlier boolean, x_cap double")
    assert C.drop_by_suffix(f).columns == ["x"]
    num, cat = C.split_columns_by_type(
        spark.createDataFrame([(1, "S", 2.0, 3.0)], "m int, site_code string, a double, t double"), "t")
    assert num == ["a"] and set(cat) == {"site_code", "m"}
    assert C.detect_time_column(spark.createDataFrame([(1, 2)], "x int, date_key int")) == "date_key"
    assert C.site_filter(df.withColumn("site_code", F.lit("A")), "(all)").count() == 3


def test_keyed_upsert(spark):
    old = spark.createDataFrame([("R1", "a"), ("R2", "b")], "rule_id string, d string")
    new = spark.createDataFrame([("R2", "B"), ("R3", "c")], "rule_id string, d string")
    got = {r.rule_id: r.d for r in CAT.keyed_upsert(old, new, ["rule_id"]).collect()}
    assert got == {"R1": "a", "R2": "B", "R3": "c"}


def test_medallion_end_to_end(spark, tmpdir_path):
    src = f"{tmpdir_path}/src"
    _write(f"{src}/energy/a.csv", "timestamp,site_code,line_code,equip_code,kwh,kw_demand,kvarh\n"
           "2025-04-01 10:00:00,SC01,L1,E1,5,2,1\n2025-04-01 12:00:00,SC01,L1,E1,-1,3,1\n")
    _write(f"{src}/manuf/a.csv", "date,site_code,line_code,product_code,units_ok,units_rework,scrap_units,takt_time_s,oee\n"
           "2025-04-01,SC01,L1,P1,10,0,0,30,0.9\n")
    _write(f"{src}/costs/a.csv", "ref_month,site_code,cost_center,account_code,account_name,amount_br,amount_fx,fx_rate\n"
           "2025-04-01,SC01,CC,A,acc,100,90,1.1\n")
    cfg = {"bronze": f"{tmpdir_path}/bronze", "silver": f"{tmpdir_path}/silver",
           "gold": f"{tmpdir_path}/gold", "database": None,
           "sources": {"energy": {"path": f"{src}/energy/*.csv", "datetime_col": "timestamp"},
                       "manufacturing": {"path": f"{src}/manuf/*.csv"},
                       "costs": {"path": f"{src}/costs/*.csv"}}}
    out = MD.run_etl(spark, cfg)
    silver = {d: spark.read.parquet(p["silver"]) for d, p in out.items()}
    assert sorted(r.kwh for r in silver["energy"].collect()) == [0.0, 5.0]
    assert spark.read.parquet(f"{tmpdir_path}/gold/energy").count() == 2
    assert tuple(spark.read.parquet(f"{tmpdir_path}/silver/energy_check").first()) == (0, 0, True)
    # silver -> star -> full rule suite, end to end
    from plantwise.operators.star import build_star
    from plantwise.plans.validation import run_validation
    star = build_star(silver["costs"], silver["manufacturing"], silver["energy"])
    res = {r.rule_id: r for r in run_validation(spark, star, database=None,
                                                 as_of="2025-04-30")["results"].collect()}
    assert len(res) == 15 and res["R6_DOMAIN_MANU"].ok and res["R5_DOMAIN_COSTS"].ok
    assert res["R1_COUNTS"].message.endswith("fact_energy=1")


def test_domain_without_files_and_quoted_header(spark, tmpdir_path):
    src = f"{tmpdir_path}/src"
    _write(f"{src}/costs/a.csv", 'ref_month,site_code,account_code,amount_br,"note, free"\n'
           '2025/04/01 00:00:00,SC01,A,100,"x, y"\n')
    cfg = {"bronze": f"{tmpdir_path}/bronze", "silver": f"{tmpdir_path}/silver",
           "gold": f"{tmpdir_path}/gold", "database": None,
           "sources": {d: {"path": f"{src}/{d}/*.csv"} for d in MD.DOMAINS}}
    silver = {d: spark.read.parquet(MD.stage_silver(spark, d, MD.stage_bronze(spark, d, cfg), cfg)) for d in MD.DOMAINS}
    assert {d: df.count() for d, df in silver.items()} == {"energy": 0, "manufacturing": 0, "costs": 1}
    bronze = spark.read.parquet(f"{tmpdir_path}/bronze/costs")
    assert "note, free" in bronze.columns
    assert [r["note, free"] for r in bronze.collect()] == ["x, y"]


def test_required_check_and_tz(spark):
    df = spark.createDataFrame([("2025-01-01 12:00:00", "S")], "timestamp string, site_code string")
    r = C.check_required(df, "energy").first()
    assert r.missing_columns == ["line_code", "equip_code", "kwh"] and r.ok is False
    ts = df.withColumn("timestamp", F.to_timestamp("timestamp"))
    out = C.localize_to_utc(ts, "timestamp", "America/Sao_Paulo").first().timestamp
    assert out.hour == 15
