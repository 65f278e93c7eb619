from pyspark.sql import functions as F

from plantwise.operators import kpi as K
from plantwise.operators import star as S


def _facts(spark):
    costs = spark.createDataFrame([
        ("2025-04-01", "SC01", "CC1", "A1", "acc", 100.0, 90.0, 1.1),
        ("2025-04-15", "SC01", "CC2", "A2", "acc", 50.0, 45.0, 1.1),
        ("2025-05-01", "SC02", "CC1", "A1", "acc", 70.0, 70.0, 1.0),
        (None, "SC02", "CC1", "A1", "acc", 10.0, 10.0, 1.0),
    ], "ref_month string, site_code string, cost_center string, account_code string, "
       "account_name string, amount_br double, amount_fx double, fx_rate double") \
        .withColumn("ref_month", F.to_timestamp("ref_month"))
    manu = spark.createDataFrame([
        ("2025-04-01", "SC01", "L1", "P1", 10, 0, 0, 30.0, 0.9),
        ("2025-04-01", "SC01", "L2", "P1", 5, 0, 1, 31.0, 0.8),
        ("2025-04-02", "SC01", "L1", "P2", 7, 0, 0, 30.0, None),
        ("2025-05-01", "SC02", "L9", "P1", 0, 0, 0, 30.0, 0.5),
    ], "date string, site_code string, line_code string, product_code string, units_ok long, "
       "units_rework long, scrap_units long, takt_time_s double, oee double") \
        .withColumn("date", F.to_timestamp("date"))
    energy = spark.createDataFrame([
        ("2025-04-01 01:00:00", "SC01", "L1", "E1", 5.0, 2.0, 1.0),
        ("2025-04-01 02:00:00", "SC01", "L1", "E1", 7.0, 3.0, 1.0),
        ("2025-04-01 02:00:00", "SC01", "L2", "E2", 1.0, 1.0, 0.0),
    ], "timestamp string, site_code string, line_code string, equip_code string, kwh double, "
       "kw_demand double, kvarh double").withColumn("timestamp", F.to_timestamp("timestamp"))
    return S.build_star(costs, manu, energy)


def test_star_shapes(spark):
    st = _facts(spark)
    assert st.fact_costs.count() == 3          # undated cost row dropped
    fe = {(r.date_key, r.equip_code): r for r in st.fact_energy.collect()}
    assert fe[(20250401, "E1")].kwh_day == 12.0 and fe[(20250401, "E1")].kw_demand_peak_day == 3.0
    assert sorted(r.site_code for r in st.dim_site.collect()) == ["SC01", "SC02"]
    assert st.dim_line.count() == 3 and st.dim_product.count() == 2
    dd = {r.date_key: r for r in st.dim_date.collect()}
    assert dd[20250402].d == 2 and str(dd[20250402].date) == "2025-04-02"


def test_cost_kpi_fanout_parity_matches_literal_join(spark):
    st = _facts(spark)
    st.register("t_")
    literal = spark.sql("""
      SELECT f.date_key, d.y, d.m, f.site_code,
             try_divide(SUM(f.amount_br), SUM(m.units_ok)) AS cost_per_unit
      FROM t_fact_costs f JOIN t_dim_date d USING (date_key)
      LEFT JOIN t_fact_manufacturing m ON f.site_code = m.site_code AND f.date_key = m.date_key
      GROUP BY 1, 2, 3, 4""").collect()
    ours = K.kpi_cost_per_unit(st.fact_costs, st.fact_manufacturing, st.dim_date).collect()
    a = {(r.date_key, r.site_code): r.cost_per_unit for r in literal}
    b = {(r.date_key, r.site_code): r.cost_per_unit for r in ours}
    assert a.keys() == b.keys()
    for k in a:
        assert (a[k] is None and b[k] is None) or abs(a[k] - b[k]) < 1e-9
    # two cost rows x two production rows on 2025-04-01: 2*150 / (2*15)
    assert b[(20250401, "SC01")] == 300.0 / 30.0
    assert b[(20250501, "SC02")] is None       # zero units -> null, not an error


def test_preagg_and_fx(spark):
    st = _facts(spark)
    pre = {(r.date_key, r.site_code): r.cost_per_unit for r in
           K.kpi_cost_per_unit_preagg(st.fact_costs, st.fact_manufacturing, st.dim_date).collect()}
    assert pre[(20250401, "SC01")] == 150.0 / 15.0
    mon = {(r.date_key, r.site_code): r.cost_per_unit for r in K.kpi_cost_per_unit_preagg(
        st.fact_costs, st.fact_manufacturing, st.dim_date, grain="month").collect()}
    assert mon[(20250401, "SC01")] == 150.0 / 22.0
    fx = {(r.date_key, r.site_code): r.fx_effect_ratio for r in K.kpi_fx_effect(st.fact_costs).collect()}
    assert abs(fx[(20250401, "SC01")] - (150 - (90 * 1.1 + 45 * 1.1)) / 150) < 1e-12


def test_energy_kpi_and_recon(spark):
    st = _facts(spark)
    e = {(r.date_key, r.site_code): r.kwh_per_unit for r in
         K.kpi_energy_per_unit(st.fact_energy, st.fact_manufacturing, st.dim_date).collect()}
    # energy rows (2) x production rows (2): (13 * 2) / (2 * 15)
    assert abs(e[(20250401, "SC01")] - 26.0 / 30.0) < 1e-12
    base = K.recon_base(st.fact_costs, st.fact_manufacturing, "units_ok", st.dim_date)
    dev = K.recon_deviation(base).collect()
    assert len(dev) == 1 and dev[0].rel_diff == 0.0   # a single group deviates from nothing


def test_kpis_from_key_sums_equal_operators(spark):
    st = _facts(spark)
    a = [K.kpi_cost_per_unit(st.fact_costs, st.fact_manufacturing, st.dim_date),
         K.kpi_energy_per_unit(st.fact_energy, st.fact_manufacturing, st.dim_date),
         K.kpi_fx_effect(st.fact_costs)]
    b = K.kpis_from_key_sums(K.key_sums(st.fact_costs, st.fact_manufacturing, st.fact_energy))
    for x, y in zip(a, b):
        assert sorted(map(tuple, x.collect()), key=str) == sorted(map(tuple, y.collect()), key=str)
