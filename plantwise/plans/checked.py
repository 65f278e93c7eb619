"""More registered queries: plain functions, preparation and one-feature models,
each with its DuckDB text."""

from __future__ import annotations

from pyspark.sql import functions as F

from plantwise.operators import ml as M
from plantwise.plans.oracle import with_star
from plantwise.plans.registry import _F, _model, _round, _star, register

X, Y = "kwh_per_unit_imp", "cost_per_unit_imp"
NUM = ["kwh_per_unit_imp", "fx_effect_ratio_imp", "cost_per_unit_imp_lag1", "fx_effect_ratio_imp_roll3"]


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register("sites_sorted", with_star("SELECT site_code FROM dim_site WHERE site_code IS NOT NULL"))
def q_sites_sorted(spark, sf_dir):
    from plantwise.operators import profile as P
    return P.distinct_sorted(_star(spark, sf_dir).dim_site)


@register("kpi_listing", with_star("""
SELECT date_key, site_code, round(cost_per_unit, 6) AS cost_per_unit,
       ROW_NUMBER() OVER (ORDER BY date_key, site_code) - 1 AS row_rank
FROM kpi_cost_per_unit WHERE site_code = 'N5'"""))
def q_kpi_listing(spark, sf_dir):
    """A site's KPI listing by (date, site) with its place in the order."""
    from plantwise.functions.ranking import rank_rows
    from plantwise.operators import kpi as K
    from plantwise.operators.cleaning import site_filter
    s = _star(spark, sf_dir)
    k = K.kpi_cost_per_unit(s.fact_costs, s.fact_manufacturing, s.calendar())
    listed = site_filter(k.select("date_key", "site_code", "cost_per_unit"), "N5")
    return _round(rank_rows(listed, ["date_key", "site_code"]), {"cost_per_unit": 6})


_LISTED = [("kpi_cost_per_unit", "cost_per_unit", 6), ("kpi_energy_per_unit", "kwh_per_unit", 6), ("kpi_fx_effect", "fx_effect_ratio", 9)]


@register("kpi_listing_all", with_star(" UNION ALL ".join(
    f"SELECT '{t}' AS kpi, date_key, site_code, round({c}, {d}) AS value, "
    f"ROW_NUMBER() OVER (ORDER BY date_key, site_code) - 1 AS row_rank FROM {t}" for t, c, d in _LISTED)))
def q_kpi_listing_all(spark, sf_dir):
    """The whole listing of the three KPI tables, all sites, by (date, site)."""
    from plantwise.functions.ranking import rank_rows
    from plantwise.operators import kpi as K
    from plantwise.operators.cleaning import site_filter
    s = _star(spark, sf_dir)
    tables = [K.kpi_cost_per_unit(s.fact_costs, s.fact_manufacturing, s.calendar()),
              K.kpi_energy_per_unit(s.fact_energy, s.fact_manufacturing, s.calendar()), K.kpi_fx_effect(s.fact_costs)]
    out = None
    for k, (t, c, d) in zip(tables, _LISTED):
        listed = rank_rows(site_filter(k.select("date_key", "site_code", F.col(c).alias("value"))), ["date_key", "site_code"])
        part = _round(listed, {"value": d}).select(F.lit(t).alias("kpi"), "date_key", "site_code", "value", "row_rank")
        out = part if out is None else out.unionByName(part)
    return out


@register("preview20", "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 20")
def q_preview20(spark, sf_dir):
    from plantwise.operators import profile as P
    return P.preview(_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").orderBy("o_orderkey"))


@register("customers_upserted", """
SELECT c_custkey, c_name, c_nationkey FROM customer WHERE c_custkey % 3 <> 0
UNION ALL SELECT c_custkey, lower(c_name), c_nationkey + 100 FROM customer WHERE c_custkey % 3 = 0""")
def q_customers_upserted(spark, sf_dir):
    """Rows replaced by key: every third customer comes anew."""
    from plantwise.sources.catalog import keyed_upsert
    old = _table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    new = old.where("c_custkey % 3 = 0").select("c_custkey", F.lower("c_name").alias("c_name"),
                                               (F.col("c_nationkey") + 100).alias("c_nationkey"))
    return keyed_upsert(old, new, ["c_custkey"])


_ORDER_PARTS = """
SELECT l_orderkey AS k, SUM(l_extendedprice * (1 - l_discount)) AS net, SUM(l_extendedprice * l_discount) AS cut
FROM lineitem GROUP BY 1"""


def _order_parts(spark, sf_dir):
    li = _table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net"),
        F.sum(F.col("l_extendedprice") * F.col("l_discount")).alias("cut"))
    o = _table(spark, sf_dir, "orders").join(li, "o_orderkey", "left")
    return o.select("o_orderkey", F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m"), "o_totalprice", "net", "cut")


@register("composition_orders", f"""
SELECT o_orderkey, round(abs(o_totalprice - coalesce(net, 0) - coalesce(cut, 0)) / abs(o_totalprice), 6) AS rel
FROM orders LEFT JOIN ({_ORDER_PARTS}) ON k = o_orderkey
WHERE abs(o_totalprice - coalesce(net, 0) - coalesce(cut, 0)) / abs(o_totalprice) > 0.005""")
def q_composition_orders(spark, sf_dir):
    """Orders whose total differs from its parts by over 0.5 %."""
    from plantwise.operators.kpi import cost_composition_check
    df = cost_composition_check(_order_parts(spark, sf_dir), "o_totalprice", ["net", "cut"])
    return _round(df.select("o_orderkey", F.col("composition_rel_diff").alias("rel")), {"rel": 6})


@register("composition_months", f"""
SELECT y, m, round(rel, 6) AS rel FROM (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m,
         abs(SUM(o_totalprice) - coalesce(SUM(net), 0) - coalesce(SUM(cut), 0)) / abs(SUM(o_totalprice)) AS rel
  FROM orders LEFT JOIN ({_ORDER_PARTS}) ON k = o_orderkey GROUP BY 1, 2) WHERE rel > 0.001""")
def q_composition_months(spark, sf_dir):
    from plantwise.operators.kpi import cost_composition_monthly
    df = cost_composition_monthly(_order_parts(spark, sf_dir), "o_totalprice", ["net", "cut"], ["y", "m"])
    return _round(df.select("y", "m", F.col("composition_rel_diff").alias("rel")), {"rel": 6})


@register("required_columns", """
SELECT 'energy' AS domain, 'equip_code' AS missing, COUNT(*) AS "rows", false AS ok FROM lineitem
UNION ALL SELECT 'costs', '', COUNT(*), COUNT(*) >= 1 FROM orders""")
def q_required_columns(spark, sf_dir):
    """Required columns and least rows of two domains, one with a gap."""
    from plantwise.operators.cleaning import check_required
    from plantwise.sources import adapters as A
    parts = [check_required(A.silver_energy(spark, sf_dir).drop("equip_code"), "energy"), check_required(A.silver_costs(spark, sf_dir), "costs")]
    both = parts[0].unionByName(parts[1])
    return both.select("domain", F.concat_ws(",", "missing_columns").alias("missing"), "rows", "ok")


# ---------------------------------------------------------------- preparation

@register("prep_statistics", with_star(" UNION ALL ".join(
    f"SELECT '{c}' AS col, round(median({c}), 6) AS med, round(quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25), 6) AS iqr, "
    f"round(AVG({c}), 6) AS mean, round(STDDEV_POP({c}), 6) AS std, "
    "(SELECT site_code FROM model_df WHERE site_code IS NOT NULL GROUP BY 1 ORDER BY COUNT(*) DESC, 1 LIMIT 1) AS mode, "
    f"(SELECT COUNT(DISTINCT site_code) FROM model_df) AS levels FROM model_df" for c in NUM), extra_ctes=_F))
def q_prep_statistics(spark, sf_dir):
    """Fitted preparation: median, IQR, mean, deviation, mode and levels."""
    df = _model(spark, sf_dir)
    a = M.fit_preprocess(df, NUM, ["site_code"], scaler="robust")
    b = M.fit_preprocess(df, NUM, [], scaler="standard")
    rows = [(c, a.medians[c], a.scales[c], b.centers[c], b.scales[c], a.modes["site_code"], len(a.levels["site_code"])) for c in NUM]
    out = spark.createDataFrame(rows, "col string, med double, iqr double, mean double, std double, mode string, levels long")
    return _round(out, {c: 6 for c in ("med", "iqr", "mean", "std")})


@register("prepared_rows", with_star("""
SELECT date_key, d.site_code, """ + ", ".join(
    f"round(coalesce({c}, m{i}) / CASE WHEN i{i} = 0 THEN 1 ELSE i{i} END, 6) AS {c}" for i, c in enumerate(NUM)) + """,
  CASE WHEN d.site_code = (SELECT MIN(site_code) FROM model_df) THEN 0.0 ELSE 1.0 END AS hot,
  CASE WHEN d.site_code = (SELECT MIN(site_code) FROM model_df) THEN NULL ELSE d.site_code END AS hot_site
FROM model_df d, (SELECT """ + ", ".join(
    f"median({c}) AS m{i}, quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) AS i{i}" for i, c in enumerate(NUM)) + """ FROM model_df)
WHERE d.site_code IS NOT NULL""", extra_ctes=_F))
def q_prepared_rows(spark, sf_dir):
    """The prepared matrix of the rows with a site; fitted on all rows."""
    df = _model(spark, sf_dir)
    return _prepared(M.fit_preprocess(df, NUM, ["site_code"], scaler="robust"), df.where("site_code IS NOT NULL"), "site_code")


def _prepared(prep, df, site):
    """The prepared matrix row by row: imputed and scaled numerics, and the
    drop-first one-hot columns folded into their sum and the hot one's name."""
    t = prep.transform(df, keep=["date_key", "site_code"], prefix="p_")
    hot = [c for c in t.columns if c.startswith(f"p_{site}_")]
    total = sum((F.col(c) for c in hot[1:]), F.col(hot[0])) if hot else F.lit(0.0)
    name = F.coalesce(*[F.when(F.col(c) == 1, F.lit(c[len(f"p_{site}_"):])) for c in hot]) if hot else F.lit(None).cast("string")
    return _round(t.select("date_key", "site_code", *[F.col("p_" + c).alias(c) for c in NUM], total.alias("hot"), name.alias("hot_site")),
                  {c: 6 for c in NUM})


@register("prepared_rows_filled", with_star("""
SELECT date_key, site_code, """ + ", ".join(
    f"round(coalesce({c}, m{i}) / CASE WHEN i{i} = 0 THEN 1 ELSE i{i} END, 6) AS {c}" for i, c in enumerate(NUM)) + """,
  CASE WHEN filled = low THEN 0.0 ELSE 1.0 END AS hot, CASE WHEN filled = low THEN NULL ELSE filled END AS hot_site
FROM (SELECT *, coalesce(gap_site, (SELECT gap_site FROM gapped WHERE gap_site IS NOT NULL GROUP BY 1 ORDER BY COUNT(*) DESC, 1 LIMIT 1)) AS filled,
             (SELECT MIN(gap_site) FROM gapped) AS low FROM gapped),
  (SELECT """ + ", ".join(
    f"median({c}) AS m{i}, quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) AS i{i}" for i, c in enumerate(NUM)) + """ FROM gapped)""",
    extra_ctes=_F + """,
gapped AS (SELECT *, CASE WHEN date_key % 7 <> 0 THEN site_code END AS gap_site FROM model_df)"""))
def q_prepared_rows_filled(spark, sf_dir):
    """The prepared matrix of every row, sites missing on every seventh date
    key (and wherever they are null) filled with the most frequent one."""
    df = _model(spark, sf_dir).withColumn("gap_site", F.when(F.col("date_key") % 7 != 0, F.col("site_code")))
    return _prepared(M.fit_preprocess(df, NUM, ["gap_site"], scaler="robust"), df, "gap_site")


@register("prepared_gaps", with_star("SELECT " + " + ".join(f"COUNT(*) FILTER (gap_{c} IS NULL)" for c in NUM) + """ AS gaps_before,
  """ + " + ".join(f"COUNT(*) FILTER (coalesce(gap_{c}, m_{c}) IS NULL)" for c in NUM) + " AS bad_values FROM gapped, (SELECT " + ", ".join(
    f"median(gap_{c}) AS m_{c}" for c in NUM) + " FROM gapped)", extra_ctes=_F + """,
gapped AS (SELECT """ + ", ".join(f"CASE WHEN date_key % {i + 5} <> 0 THEN {c} END AS gap_{c}" for i, c in enumerate(NUM)) + " FROM model_df)"))
def q_prepared_gaps(spark, sf_dir):
    """Gaps before and after preparation, where each column lacks the values of
    some date keys."""
    df = _model(spark, sf_dir).select("site_code", *[F.when(F.col("date_key") % (i + 5) != 0, F.col(c)).alias(c) for i, c in enumerate(NUM)])
    prep = M.fit_preprocess(df, NUM, ["site_code"])
    t = prep.transform(df)
    before, after = (M.nan_check(x, c).select(F.col("bad_values").cast("long")).first()[0] for x, c in ((df, NUM), (t, t.columns)))
    return spark.createDataFrame([(before, after)], "gaps_before long, bad_values long")


# ----------------------------------------------------------- one-feature models

def _plain(train):
    return M.PreprocessModel([X], [], medians={X: None}, scales={X: 1.0}, centers={X: 0.0})


def _pairs(spark, sf_dir):
    return _model(spark, sf_dir).where(F.col(X).isNotNull() & F.col(Y).isNotNull()).select("date_key", "site_code", X, Y)


_PAIRS = _F + f""",
pairs AS (SELECT date_key, site_code, {X} AS x, {Y} AS y FROM model_df WHERE {X} IS NOT NULL AND {Y} IS NOT NULL)"""


@register("ridge_one_feature", with_star(
    "SELECT round(regr_sxy(y, x) / (regr_sxx(y, x) + 1), 5) AS slope FROM pairs", extra_ctes=_PAIRS))
def q_ridge_one_feature(spark, sf_dir):
    """Ridge (alpha 1) through Spark ML: the slope is Sxy / (Sxx + 1)."""
    df = _pairs(spark, sf_dir)
    st = df.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop(Y).alias("s")).first()
    m = M.fit(_plain(df), df, Y, M.regressors(st["n"], st["s"])["Ridge"])
    return _round(spark.createDataFrame([(float(m.stages[-1].coefficients[0]),)], "slope double"), {"slope": 5})


@register("scored_rows", with_star("""
SELECT date_key, site_code, round(b + a * x, 4) AS prediction, round(y - (b + a * x), 4) AS residual
FROM pairs, (SELECT regr_slope(y, x) AS a, regr_intercept(y, x) AS b FROM pairs)""", extra_ctes=_PAIRS))
def q_scored_rows(spark, sf_dir):
    """Predictions of a one-feature fit beside their rows, with residuals."""
    from plantwise.operators.metrics import with_residual
    df = _pairs(spark, sf_dir)
    prep = M.mean_centred(df, [X], Y)
    m = M.fit(prep, df, Y, M.regressors()["LinearRegression"].setFitIntercept(False))
    out = with_residual(M.score(prep, m, df, keep=["date_key", "site_code", Y]), Y)
    return _round(out.select("date_key", "site_code", "prediction", "residual"), {"prediction": 4, "residual": 4})


@register("cv_one_feature", with_star("""
SELECT CAST(t.fold AS INTEGER) AS fold, round(sqrt(AVG(pow(p.y - (b + a * p.x), 2))), 4) AS rmse
FROM (SELECT f.fold, regr_slope(y, x) AS a, regr_intercept(y, x) AS b
      FROM ranked, range(5) f(fold) WHERE rk < n - (5 - f.fold) * (n // 6) GROUP BY f.fold) t
JOIN ranked p ON p.rk >= p.n - (5 - t.fold) * (p.n // 6) AND p.rk < p.n - (4 - t.fold) * (p.n // 6)
GROUP BY t.fold""", extra_ctes=_PAIRS + """,
ranked AS (SELECT *, ROW_NUMBER() OVER (ORDER BY date_key, site_code) - 1 AS rk, COUNT(*) OVER () AS n FROM pairs)"""))
def q_cv_one_feature(spark, sf_dir):
    """Expanding-window errors of a one-feature fit, fold by fold."""
    per = M.temporal_cv(_plain, _pairs(spark, sf_dir), Y, M.regressors()["LinearRegression"], k=5)
    return _round(per.select(F.col("fold").cast("int").alias("fold"), F.col("RMSE").alias("rmse")), {"rmse": 4})


@register("aligned_rows", with_star("""
SELECT date_key, site_code, m, round(fx_effect_ratio_imp, 9) AS fx_effect_ratio_imp,
       round(cost_per_unit_imp, 6) AS cost_per_unit_imp FROM model_df""", extra_ctes=_F))
def q_aligned_rows(spark, sf_dir):
    """Scoring frame in a model's declared columns, extras dropped."""
    df = _model(spark, sf_dir)
    out, _ = M.align_with_model_features(df, ["date_key", "site_code", "m", "fx_effect_ratio_imp"], Y)
    return _round(out, {"fx_effect_ratio_imp": 9, Y: 6})



# ------------------------------------------------ importance and lasso, checked

X2 = "fx_effect_ratio_imp"
_REPEATS, _SEED = 20, 42
_KNOWN = f"SELECT date_key, site_code, {X} AS a, {X2} AS b, {Y} AS y FROM model_df WHERE {X} IS NOT NULL AND {X2} IS NOT NULL AND {Y} IS NOT NULL"


@register("permutation_importance", with_star(f"""
SELECT feature, round(avg(r0 - r2), 6) AS importance_mean, round(stddev_pop(r0 - r2), 6) AS importance_std
FROM (SELECT feature, rep, 1 - sum((y - p) * (y - p)) / (count(*) * var_pop(y)) AS r2 FROM scored GROUP BY feature, rep), base
GROUP BY feature""", extra_ctes=_F + f""",
known AS (SELECT *, row_number() OVER (ORDER BY date_key, site_code) - 1 AS rk FROM ({_KNOWN})),
s AS (SELECT avg(a) AS ma, avg(b) AS mb, avg(y) AS my, var_pop(a) AS saa, var_pop(b) AS sbb, covar_pop(a, b) AS sab, covar_pop(a, y) AS say, covar_pop(b, y) AS sby FROM known),
w AS (SELECT ma, mb, my, (say * sbb - sby * sab) / (saa * sbb - sab * sab) AS wa, (sby * saa - say * sab) / (saa * sbb - sab * sab) AS wb FROM s),
base AS (SELECT 1 - sum((y - (my + wa * (a - ma) + wb * (b - mb))) ** 2) / (count(*) * var_pop(y)) AS r0 FROM known, w),
draw AS (SELECT rep, rk, row_number() OVER (PARTITION BY rep ORDER BY md5(({_SEED} + rep)::VARCHAR || '|' || rk::VARCHAR), rk) - 1 AS at
         FROM known, (SELECT unnest(range({_REPEATS})) AS rep)),
moved AS (SELECT rep, own.y, own.a, own.b, gift.a AS ga, gift.b AS gb FROM draw JOIN known own ON own.rk = draw.at JOIN known gift ON gift.rk = draw.rk),
scored AS (SELECT '{X}' AS feature, rep, y, my + wa * (ga - ma) + wb * (b - mb) AS p FROM moved, w
           UNION ALL SELECT '{X2}', rep, y, my + wa * (a - ma) + wb * (gb - mb) FROM moved, w)"""))
def q_permutation_importance(spark, sf_dir):
    """Importance of two inputs of a least-squares fit, donors by MD5."""
    from pyspark.ml.regression import LinearRegression
    known = _model(spark, sf_dir).select("date_key", "site_code", X, X2, Y).na.drop(subset=[X, X2, Y])
    prep = M.fit_preprocess(known, [X, X2], [], scaler=None)
    model = M.fit(prep, known, Y, LinearRegression(regParam=0.0, solver="normal"))
    out = M.permutation_importance(prep, model, known, Y, [X, X2], repeats=_REPEATS, seed=_SEED, order=["date_key", "site_code"])
    return _round(out, {"importance_mean": 6, "importance_std": 6})


@register("lasso_one_feature", with_star(f"""
SELECT '{X}' AS feature, round(sign(say) * greatest(abs(say) - 0.001, 0) / saa, 6) AS coefficient, true AS optimal
FROM (SELECT var_pop({X}) AS saa, covar_pop({X}, {Y}) AS say FROM model_df WHERE {X} IS NOT NULL AND {Y} IS NOT NULL)""", extra_ctes=_F))
def q_lasso_one_feature(spark, sf_dir):
    """The lasso of the leaderboard on one input (SQL: soft threshold) and its
    optimality certificate."""
    known = _model(spark, sf_dir).select(X, Y).na.drop()
    prep = M.fit_preprocess(known, [X], [], scaler=None)
    model = M.fit(prep, known, Y, M.regressors()["Lasso"]).stages[-1]
    proof = M.lasso_certificate(known, [X], Y, model.coefficients.toArray().tolist(), model.intercept, 0.001)
    return _round(proof.select("feature", "coefficient", (F.col("slack") < 1e-6).alias("optimal")), {"coefficient": 6})


# ------------------------------------------------- clusters and components, checked

_IMP = ["cost_per_unit_imp", "kwh_per_unit_imp", "fx_effect_ratio_imp"]
_STARTS, _ROUNDS, _K = 10, 15, 3
_SCALED = "z AS MATERIALIZED (SELECT row_number() OVER () AS rk, date_key, site_code, " + ", ".join(
    f"({c} - avg({c}) OVER ()) / coalesce(nullif(stddev_pop({c}) OVER (), 0), 1) AS x{i}" for i, c in enumerate(_IMP)) + " FROM model_df)"


def _lloyd_sql() -> str:
    """A link of the chain a round, all restarts together."""
    apart = " + ".join(f"(z.x{i} - c.x{i}) * (z.x{i} - c.x{i})" for i in range(3))
    near = "SELECT r, rk, j, d, x0, x1, x2 FROM (SELECT c.r, z.rk, c.j, {d} AS d, z.x0, z.x1, z.x2, row_number() OVER (PARTITION BY c.r, z.rk ORDER BY {d}, c.j) AS k FROM z, c{n} c) WHERE k = 1"
    parts = [_SCALED, f"""c0 AS MATERIALIZED (SELECT r, n - 1 AS j, x0, x1, x2 FROM (
  SELECT r, x0, x1, x2, row_number() OVER (PARTITION BY r ORDER BY md5(concat_ws('|', (42 + r)::VARCHAR, date_key::VARCHAR, site_code)), x0, x1, x2) AS n
  FROM z, (SELECT unnest(range({_STARTS})) AS r)) WHERE n <= {_K})"""]
    for n in range(_ROUNDS):
        parts.append(f"n{n} AS MATERIALIZED ({near.format(d=apart, n=n)})")
        parts.append(f"c{n + 1} AS MATERIALIZED (SELECT c.r, c.j, coalesce(m.x0, c.x0) AS x0, coalesce(m.x1, c.x1) AS x1, coalesce(m.x2, c.x2) AS x2 FROM c{n} c "
                     f"LEFT JOIN (SELECT r, j, avg(x0) AS x0, avg(x1) AS x1, avg(x2) AS x2 FROM n{n} GROUP BY r, j) m ON m.r = c.r AND m.j = c.j)")
    parts.append(f"f AS MATERIALIZED ({near.format(d=apart, n=_ROUNDS)})")
    parts.append("b AS (SELECT r FROM (SELECT r, sum(d) AS cost FROM f GROUP BY r) ORDER BY cost, r LIMIT 1)")
    return ",\n" + ",\n".join(parts)


@register("kmeans_clusters", with_star("SELECT j::INTEGER AS cluster_k3, count(*) AS n, round((SELECT sum(d) FROM f JOIN b USING (r)), 4) AS cost FROM f JOIN b USING (r) GROUP BY j",
                                       extra_ctes=_F + _lloyd_sql()))
def q_kmeans_clusters(spark, sf_dir):
    """Cluster sizes and cost of KMeans k=3, best of 10 fixed starts, on the scaled KPIs."""
    res, cost = M.lloyd_kmeans(_model(spark, sf_dir), _IMP, ["date_key", "site_code"], k=_K, n_init=_STARTS, rounds=_ROUNDS)
    return _round(res.groupBy("cluster_k3").agg(F.count(F.lit(1)).alias("n"), F.lit(float(cost)).alias("cost")), {"cost": 4})


def _axes_sql() -> str:
    """Eigenvectors by squaring the matrix 24 times: what remains is the first
    axis's projection; the second axis from the matrix without the first."""
    def squared(name, source):
        steps = [f"{name}0 AS (SELECT a, b, c, d, e, f FROM {source})"]
        for n in range(24):
            square = "a*a + b*b + c*c AS a2, a*b + b*d + c*e AS b2, a*c + b*e + c*f AS c2, b*b + d*d + e*e AS d2, b*c + d*e + e*f AS e2, c*c + e*e + f*f AS f2"
            steps.append(f"{name}{n + 1} AS MATERIALIZED (SELECT a2/t AS a, b2/t AS b, c2/t AS c, d2/t AS d, e2/t AS e, f2/t AS f FROM (SELECT *, a2 + d2 + f2 AS t FROM (SELECT {square} FROM {name}{n})))")
        pick = "CASE WHEN a >= d AND a >= f THEN {0} WHEN d >= f THEN {1} ELSE {2} END"
        # A row of the projection, at length one; the entry of greatest magnitude is its root.
        v = [f"{pick.format(*cols)} / sqrt({pick.format('a', 'd', 'f')})" for cols in (("a", "b", "c"), ("b", "d", "e"), ("c", "e", "f"))]
        steps.append(f"{name}v AS (SELECT {v[0]} AS v0, {v[1]} AS v1, {v[2]} AS v2 FROM {name}24)")
        return steps

    entries = [("a", 0, 0), ("b", 0, 1), ("c", 0, 2), ("d", 1, 1), ("e", 1, 2), ("f", 2, 2)]
    parts = [_SCALED, "g AS MATERIALIZED (SELECT " + ", ".join(f"covar_pop(x{i}, x{j}) AS {n}" for n, i, j in entries) + " FROM z)", *squared("p", "g")]
    value = "v0*v0*a + v1*v1*d + v2*v2*f + 2*(v0*v1*b + v0*v2*c + v1*v2*e)"
    parts.append("h AS MATERIALIZED (SELECT " + ", ".join(f"{n} - ({value}) * v{i} * v{j} AS {n}" for n, i, j in entries) + " FROM g, pv)")
    return ",\n" + ",\n".join(parts + squared("q", "h"))


@register("pca_components", with_star("""
SELECT date_key, site_code, round(pv.v0 * x0 + pv.v1 * x1 + pv.v2 * x2, 6) AS pc1, round(qv.v0 * x0 + qv.v1 * x1 + qv.v2 * x2, 6) AS pc2
FROM z, pv, qv""", extra_ctes=_F + _axes_sql()))
def q_pca_components(spark, sf_dir):
    """First two components of the standardised KPIs, row by row."""
    return _round(M.pca_2d(_model(spark, sf_dir), _IMP, keep=["date_key", "site_code"]), {"pc1": 6, "pc2": 6})
