import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plantwise.functions import dates as D
from plantwise.functions import jsonx as J
from plantwise.functions import safe as S
from plantwise.functions.quantiles import quantiles
from plantwise.functions.ranking import rank_rows
from plantwise.functions.stats import kurt_sample, skew_sample


def test_lenient_parsing(spark):
    df = spark.createDataFrame([("1.5",), ("abc",), (None,), ("-2",)], "x string")
    r = df.select(S.lenient_double("x").alias("d"), S.lenient_double("x", 0.0).alias("f"),
                  S.lenient_long("x", 0).alias("l")).collect()
    assert [x.d for x in r] == [1.5, None, None, -2.0]
    assert [x.f for x in r] == [1.5, 0.0, 0.0, -2.0]
    assert [x.l for x in r] == [1, 0, 0, -2]


def test_lenient_timestamp_formats(spark):
    df = spark.createDataFrame([("2025-04-01 10:00:00",), ("2025-04-01",), ("01/04/2025",),
                                ("not a date",)], "x string")
    r = [x[0] for x in df.select(S.lenient_timestamp("x")).collect()]
    assert r[0].hour == 10 and r[1].day == 1 and r[2] is not None and r[3] is None


def test_slash_dates_do_not_follow_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    texts = ["2018/11/04 00:00:00", "11/04/2018 00:00:00", "2018-11-04 00:00:00", "2018/11/04", "2018/11/04 10:00", "1/2/2018"]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")   # 00:00 does not exist there
        got = [r[0] for r in df.select(S.lenient_timestamp("x").cast("string")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == ["2018-11-04 00:00:00"] * 4 + [None, None]


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(-0.1,), (1.2,), (None,), (0.5,)], "x double")
    assert [x[0] for x in df.select(S.clip("x", 0.0, 1.0)).collect()] == [0.0, 1.0, None, 0.5]


def test_ratio_zero_divisor(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (3.0, 2.0)], "a double, b double")
    assert [x[0] for x in df.select(S.ratio("a", "b")).collect()] == [None, None, 1.5]


def test_month_lag_counts_boundaries(spark):
    # max date 2025-12-01 checked on 2025-10-28 -> -2 months (not -1.13)
    df = spark.createDataFrame([("2025-12-01", "2025-10-28")], "a string, b string") \
        .select(F.to_date("a").alias("a"), F.to_date("b").alias("b"))
    assert df.select(D.month_lag("a", "b")).first()[0] == -2
    assert df.select(D.day_lag("a", "b")).first()[0] == -34


def test_date_keys(spark):
    df = spark.createDataFrame([("2025-09-30 13:00:00",)], "t string").select(
        F.to_timestamp("t").alias("t"))
    r = df.select(D.date_key_from_day("t"), D.date_key_from_month("t")).first()
    assert tuple(r) == (20250930, 20250901)
    k = spark.createDataFrame([(20250930,), (20250231,)], "k int")
    out = k.select(*[v.alias(n) for n, v in D.date_key_parts("k").items()],
                   D.date_key_to_date("k").alias("dt")).collect()
    assert (out[0].y, out[0].m, out[0].d) == (2025, 9, 30)
    assert out[1].dt is None   # not a real day -> null, no error


def test_json_helpers(spark):
    df = spark.createDataFrame([(None, 0.34628207615971496, "SC01", None)],
                               "a string, r double, s string, l string")
    j = df.select(J.json_object(dup=F.col("a"), rel=F.col("r")).alias("j"),
                  J.percent_text("r").alias("p"), J.key_text("s", "l").alias("k")).first()
    assert j.j == '{"dup":null,"rel":0.34628207615971496}'
    assert j.p == "34.63%"
    assert j.k is None


@settings(max_examples=8, deadline=None)
@given(st.lists(st.floats(-1e6, 1e6, allow_nan=False), min_size=1, max_size=40))
def test_quantiles_match_numpy(spark, xs):
    df = spark.createDataFrame([(i % 3, x) for i, x in enumerate(xs)], "g int, v double")
    probs = [0.01, 0.25, 0.5, 0.75, 0.99]
    got = {r.g: r for r in quantiles(df, "v", probs, by=["g"]).collect()}
    for g in set(i % 3 for i in range(len(xs))):
        vals = [x for i, x in enumerate(xs) if i % 3 == g]
        want = np.quantile(vals, probs)
        for p, w in zip(got[g][1:], want):
            assert math.isclose(p, w, rel_tol=1e-9, abs_tol=1e-6)


def test_quantiles_global_empty_and_nulls(spark):
    df = spark.createDataFrame([(None,), (1.0,), (3.0,)], "v double")
    assert quantiles(df, "v", [0.5], method="exact").first()[0] == 2.0
    empty = df.where("false")
    r = quantiles(empty, "v", [0.5], method="exact").collect()
    assert len(r) == 1 and r[0][0] is None


def test_quantile_walks_agree(spark, monkeypatch):
    """Both walks over one counted table, with groups, gaps and null keys."""
    from plantwise.functions import quantiles as Q
    df = spark.range(4000).selectExpr("IF(id % 11 = 0, null, id % 5) AS g", "IF(id % 7 = 0, null, pow(id % 97, 3) * IF(id % 2 = 0, -0.5, 1)) AS v")
    probs = [0.0, 0.01, 0.25, 0.5, 0.99, 1.0]
    one = {r.g: tuple(r) for r in quantiles(df, "v", probs, by=["g"]).collect()}
    monkeypatch.setattr(Q, "WINDOW_ROWS", 0)
    two = {r.g: tuple(r) for r in quantiles(df, "v", probs, by=["g"]).collect()}
    assert one == two and set(one) == {0, 1, 2, 3, 4}


def test_rank_rows_distributed(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("g"), (F.col("id") * 37 % 1000).alias("v"))
    r = rank_rows(df, ["v"], by=["g"]).collect()
    by = {}
    for x in r:
        by.setdefault(x.g, []).append((x.v, x.row_rank))
    for g, rows in by.items():
        rows.sort()
        assert [rk for _, rk in rows] == list(range(len(rows)))


def test_sample_moments_match_pandas(spark):
    import pandas as pd
    xs = [1.0, 2.0, 2.0, 3.0, 10.0, 4.5, 7.0]
    df = spark.createDataFrame([(x,) for x in xs], "v double")
    r = df.agg(skew_sample("v"), kurt_sample("v")).first()
    s = pd.Series(xs)
    assert r[0] == pytest.approx(s.skew(), rel=1e-9)
    assert r[1] == pytest.approx(s.kurtosis(), rel=1e-9)


@pytest.mark.parametrize("window_rows", [None, 0])
def test_quantiles_hot_value_and_close_values(spark, monkeypatch, window_rows):
    """A value in a third of the rows is one counted row, and values that share
    a bucket and a cell are told apart, by running sums and by buckets."""
    from plantwise.functions import quantiles as Q
    if window_rows is not None:
        monkeypatch.setattr(Q, "WINDOW_ROWS", window_rows)
    eps = 2.0 ** -52
    xs = [0.0] * 400 + [1.0 + k * eps for k in range(400)] + [-1e300, 1e300, -5.0, 1e-310] * 100
    df = spark.createDataFrame([(x,) for x in xs], "v double").repartition(4)
    probs = [0.0, 0.1, 0.25, 0.5, 0.61, 0.75, 1.0]
    got = list(quantiles(df, "v", probs).first())
    want = [np.quantile(np.array(xs, dtype=np.float64), p) for p in probs]
    assert got == pytest.approx(want, rel=1e-15)


def test_ranked_quantiles_consistent_under_sampling(spark):
    # large enough that the range partitioner samples its boundaries
    n = 300_000
    df = spark.range(n).select((F.col("id") % 3).alias("g"),
                               ((F.col("id") * 7919) % 100_003).cast("double").alias("v"))
    got = {r.g: r for r in quantiles(df, "v", [0.1, 0.5, 0.9], by=["g"], method="exact").collect()}
    pdf = df.toPandas()
    for g, part in pdf.groupby("g"):
        want = np.quantile(part["v"].to_numpy(), [0.1, 0.5, 0.9])
        assert list(got[g][1:]) == pytest.approx(list(want), rel=1e-12)
    r = rank_rows(df, ["v", "g"]).select("row_rank").agg(
        F.min("row_rank"), F.max("row_rank"), F.countDistinct("row_rank")).first()
    assert tuple(r) == (0, n - 1, n)


def test_parsing_is_session_zone_independent(spark):
    from plantwise.plans.registry import ntz_text
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        # midnight of a historical DST start: not a valid local time there
        df = spark.createDataFrame([("1995-10-15",), ("1995-10-15 00:00:00.5",)], "s string")
        r = df.select(ntz_text(S.lenient_timestamp("s")).alias("t")).collect()
        assert [x.t for x in r] == ["1995-10-15 00:00:00.000000", "1995-10-15 00:00:00.500000"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_scale_conf():
    from plantwise.session import scale_conf
    big = scale_conf(100 * 1024 ** 4, 8000)
    assert int(big["spark.sql.shuffle.partitions"]) == 409600
    small = scale_conf(10 * 1024 ** 2, 8)
    assert small["spark.sql.shuffle.partitions"] == "16"
