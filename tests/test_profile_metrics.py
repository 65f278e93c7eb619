import pandas as pd
import pytest
from pyspark.sql import functions as F

from plantwise.operators import metrics as M
from plantwise.operators import profile as P


def test_describe_matches_pandas(spark):
    xs = [1.0, 2.5, 3.0, 7.0, None, 11.0]
    df = spark.createDataFrame([(x, 2 * x if x else None) for x in xs], "a double, b double")
    d = {r.column: r for r in P.describe(df).collect()}
    s = pd.Series(xs).describe()
    assert d["a"]["count"] == s["count"] and d["a"].mean == pytest.approx(s["mean"])
    assert d["a"].std == pytest.approx(s["std"]) and d["a"].p25 == pytest.approx(s["25%"])
    assert d["a"].p75 == pytest.approx(s["75%"]) and d["b"]["max"] == 22.0


def test_describe_strings_and_nulls(spark):
    df = spark.createDataFrame([("a", 1), ("b", None), ("a", 2), (None, 3)], "s string, n int")
    r = P.describe_strings(df).first()
    assert (r["count"], r.unique, r.top, r.freq) == (3, 2, "a", 2)
    nc = [(x.column, x.nulls) for x in P.null_counts(df).collect()]
    assert nc == [("n", 1), ("s", 1)]


def test_corr_skew_dq(spark):
    df = spark.createDataFrame([(float(i), float(i) * 2 + (i % 3), None if i == 5 else float(i))
                                for i in range(20)], "a double, b double, c double")
    corr = {(r.var1, r.var2): r.r for r in P.correlation_long(df, ["a", "b", "c"]).collect()}
    pdf = df.toPandas()
    assert set(corr) == {("b", "a"), ("c", "a"), ("c", "b")}
    assert corr[("b", "a")] == pytest.approx(pdf["a"].corr(pdf["b"]))
    assert corr[("c", "b")] == pytest.approx(pdf["b"].corr(pdf["c"]))
    sk = {r.column: r for r in P.skew_kurtosis(df, ["b"]).collect()}
    assert sk["b"].skew == pytest.approx(pdf["b"].skew()) and sk["b"].kurtosis == pytest.approx(pdf["b"].kurtosis())
    dq = spark.createDataFrame([(1, "A", None), (1, "A", 0.0), (2, "B", -1.0)],
                               "date_key int, site_code string, k double") \
        .withColumn("month_start", F.current_date())
    r = P.dq_summary(dq, "k").first()
    assert (r.rows, r.sites, r.nulls, r.null_pct, r.negs, r.zeros, r.dup_keys) == (3, 2, 1, 33.33, 1, 1, 1)


def test_box_hist_topk(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 100]], "x double")
    b = P.box_stats(df, ["x"]).first()
    assert (b.q1, b.median, b.q3, b.whisker_high, b.n_outside) == (2.0, 3.0, 4.0, 4.0, 1)
    h = P.histogram(df, "x", 30).collect()
    assert sum(r["count"] for r in h) == 5 and h[-1].bin == 30
    k = spark.createDataFrame([(s, d) for s in "AB" for d in range(30)], "site_code string, date_key int")
    last = P.last_n_per_group(k, 20).collect()
    assert len(last) == 40 and min(r.date_key for r in last) == 10
    assert [r.site_code for r in P.distinct_sorted(k).collect()] == ["A", "B"]
    s1 = P.deterministic_sample(k, 7, ["site_code", "date_key"]).collect()
    assert s1 == P.deterministic_sample(k, 7, ["site_code", "date_key"]).collect() and len(s1) == 7


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 2.0), (4.0, 3.0)], "y_true double, prediction double")
    r = M.regression_metrics(df).first()
    assert r.MAE == pytest.approx(0.5) and r.MSE == pytest.approx(1.25 / 3)
    assert r.RMSE == pytest.approx((1.25 / 3) ** 0.5) and r.MAPE == pytest.approx((0.5 + 0 + 0.25) / 3 * 100)
    ys, ps = [1.0, 2.0, 4.0], [1.5, 2.0, 3.0]
    mean = sum(ys) / 3
    r2 = 1 - sum((y - p) ** 2 for y, p in zip(ys, ps)) / sum((y - mean) ** 2 for y in ys)
    assert r.R2 == pytest.approx(r2)
    z = spark.createDataFrame([(0.0, 1.0), (2.0, 2.0)], "y_true double, prediction double")
    assert M.regression_metrics(z).first().MAPE is None
    assert M.mape_masked(z).first().MAPE == pytest.approx(0.0)
    lim = M.joint_limits(df).first()
    assert (lim.lo, lim.hi) == (1.0, 4.0)


def test_describe_all_and_preview(spark):
    df = spark.createDataFrame([(1.0, "a"), (3.0, "a"), (None, "b")], "x double, s string")
    d = {r.column: r for r in P.describe_all(df).collect()}
    assert d["x"]["count"] == 2 and d["x"].mean == 2.0 and d["s"].top == "a" and d["s"].unique == 2
    assert P.preview(df, 2).count() == 2
