"""Registered queries of models, column helpers, files and views, each with its
DuckDB text."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from plantwise.functions.materialize import new_path
from plantwise.operators import cleaning as C
from plantwise.operators import ml as M
from plantwise.plans import modeling as MD
from plantwise.plans.checked import _PAIRS, X, Y, _pairs, _plain, _table
from plantwise.plans.oracle import with_star
from plantwise.plans.registry import _F, _FAULTY, _FAULTY_SQL, AS_OF, _faulty_star, _model, _qa_sql, _robust_mad_sql, _round, _star, register

_SPLIT = _PAIRS + """,
ranked AS (SELECT *, ROW_NUMBER() OVER (ORDER BY date_key, site_code) - 1 AS rk, COUNT(*) OVER () AS n FROM pairs)"""


def _linear(reg: float, l1: float = 0.0):
    from pyspark.ml.regression import LinearRegression
    if l1:
        return LinearRegression(regParam=reg, elasticNetParam=l1, standardization=False, maxIter=10000, tol=1e-12)
    return LinearRegression(regParam=reg, standardization=False, solver="normal")


# ------------------------------------------------------- leaderboard and grid

@register("leaderboard_linear", with_star("""
SELECT model, n, round(mae, 5) AS "MAE", round(rmse, 4) AS "RMSE", round(r2, 6) AS "R2", ROW_NUMBER() OVER (ORDER BY rmse) AS place,
       ROW_NUMBER() OVER (ORDER BY rmse) = 1 AS chosen
FROM (SELECT model, COUNT(*) AS n, AVG(ABS(e)) AS mae, SQRT(AVG(e * e)) AS rmse, 1 - SUM(e * e) / (COUNT(*) * VAR_POP(y)) AS r2
      FROM (SELECT model, y, y - (my + share * slope * (x - mx)) AS e FROM ranked, fitted, shares WHERE rk >= floor(0.8 * n)) GROUP BY model)""",
    extra_ctes=_SPLIT + """,
fitted AS (SELECT AVG(x) AS mx, AVG(y) AS my, regr_slope(y, x) AS slope FROM ranked WHERE rk < floor(0.8 * n)),
shares(model, share) AS (VALUES ('LinearRegression', 1.0::DOUBLE), ('Ridge', 1 / 1.1::DOUBLE), ('Lasso', 0.8::DOUBLE))"""))
def q_leaderboard_linear(spark, sf_dir):
    """Three linear models on the temporal split, ordered by their error.  The
    penalties are a tenth of Sxx (ridge) and a fifth of the covariance (lasso),
    so that in closed form the slope shrinks to 1/1.1 and 0.8."""
    df = _pairs(spark, sf_dir)
    train, test = MD.split(df)
    st = train.agg(F.var_pop(X).alias("v"), F.stddev_pop(Y).alias("s"), F.covar_pop(X, Y).alias("c")).first()
    models = {"LinearRegression": _linear(0.0), "Ridge": _linear(0.1 * st["v"] * st["s"]), "Lasso": _linear(0.2 * abs(st["c"]), 1.0)}
    board, _ = M.leaderboard(_plain(train), train, test, Y, models)
    best = MD.choose(board)
    rows = [(r["model"], r["n"], r["MAE"], r["RMSE"], r["R2"], i + 1, r["model"] == best) for i, r in enumerate(board.collect())]
    out = spark.createDataFrame(rows, "model string, n long, MAE double, RMSE double, R2 double, place long, chosen boolean")
    return _round(out, {"MAE": 5, "RMSE": 4, "R2": 6})


_GRID = {"regParam": [0.0, 100.0, 10000.0], "minRowsToSplit": [2, 5]}


@register("grid_search_ridge", with_star("""
SELECT params, round(cv_rmse, 4) AS cv_rmse, round(cv_std, 4) AS cv_std, CAST(ROW_NUMBER() OVER (ORDER BY cv_rmse, params) AS INTEGER) AS place
FROM points JOIN (SELECT reg, AVG(rmse) AS cv_rmse, STDDEV_POP(rmse) AS cv_std FROM (
  SELECT l.reg, l.fold, SQRT(AVG(pow(p.y - (my + slope * (p.x - mx)), 2))) AS rmse FROM lines l
  JOIN ranked p ON p.rk >= p.n - (5 - l.fold) * (p.n // 6) AND p.rk < p.n - (4 - l.fold) * (p.n // 6)
  GROUP BY l.reg, l.fold) GROUP BY reg) USING (reg)""", extra_ctes=_SPLIT + """,
points(params, reg) AS (VALUES """ + ", ".join(
        f"""('{{"minRowsToSplit": {s}, "regParam": {r}}}', {r}::DOUBLE)""" for r in _GRID["regParam"] for s in _GRID["minRowsToSplit"]) + """),
lines AS (SELECT reg, fold, mx, my, sxy / (sxx + reg * cnt / sy) AS slope FROM (SELECT DISTINCT reg FROM points), (
  SELECT f.fold, AVG(x) AS mx, AVG(y) AS my, regr_sxy(y, x) AS sxy, regr_sxx(y, x) AS sxx, STDDEV_POP(y) AS sy, COUNT(*) AS cnt
  FROM ranked, range(5) f(fold) WHERE rk < n - (5 - f.fold) * (n // 6) GROUP BY f.fold))"""))
def q_grid_search_ridge(spark, sf_dir):
    """The grid search over ridge penalties by expanding-window folds, with an
    axis that the estimator has no parameter for: its points share a score."""
    out = M.grid_search(_plain, _pairs(spark, sf_dir), Y, _linear_of, M.grid_points(_GRID), k=5, inert=["minRowsToSplit"])
    return _round(out, {"cv_rmse": 4, "cv_std": 4})


def _linear_of(regParam: float):
    return _linear(regParam)


# ------------------------------------------------------------------ one split

_STUMP = _F + f""",
t AS (SELECT m AS a, date_key % 100 AS b, {Y} AS y FROM model_df WHERE {Y} IS NOT NULL AND m IS NOT NULL),
per AS (SELECT 'm' AS f, a AS v, COUNT(*) AS n, SUM(y) AS s FROM t GROUP BY 2 UNION ALL SELECT 'day', b, COUNT(*), SUM(y) FROM t GROUP BY 2),
run AS (SELECT f, v, SUM(n) OVER (PARTITION BY f ORDER BY v) AS nl, SUM(s) OVER (PARTITION BY f ORDER BY v) AS sl,
               SUM(n) OVER (PARTITION BY f) AS n, SUM(s) OVER (PARTITION BY f) AS s FROM per),
cut AS (SELECT f, v FROM run WHERE nl < n ORDER BY sl * sl / nl + (s - sl) * (s - sl) / (n - nl) DESC LIMIT 1)"""


def _stump(spark, sf_dir):
    """A forest of one tree with one split, all rows and both inputs at it."""
    from pyspark.ml.regression import RandomForestRegressor
    df = _model(spark, sf_dir).select(F.col("m").cast("double").alias("m"), (F.col("date_key") % 100).cast("double").alias("day"), Y).na.drop()
    prep = M.PreprocessModel(["m", "day"], [], medians={"m": None, "day": None})
    tree = RandomForestRegressor(numTrees=1, maxDepth=1, maxBins=32, featureSubsetStrategy="all", bootstrap=False, seed=42)
    return df, prep, M.fit(prep, df, Y, tree)


@register("tree_stump", with_star("""
SELECT below, COUNT(*) AS n, round(AVG(y), 4) AS prediction
FROM (SELECT y, CASE WHEN f = 'm' THEN a ELSE b END <= v AS below FROM t, cut) GROUP BY below""", extra_ctes=_STUMP))
def q_tree_stump(spark, sf_dir):
    """Rows and prediction on both sides of the split that a tree finds (SQL:
    the cut with the least squared error left, over every value of both inputs)."""
    df, prep, model = _stump(spark, sf_dir)
    root = model.stages[-1].trees[0]._call_java("rootNode")
    at, name = float(root.split().threshold()), prep.vector_names()[root.split().featureIndex()]
    scored = M.predict(prep, model, df, keep=["m", "day"])
    out = scored.groupBy((F.col(name) <= at).alias("below")).agg(F.count(F.lit(1)).alias("n"), F.avg("prediction").alias("prediction"))
    return _round(out, {"prediction": 4})


@register("tree_importances", with_star("""
SELECT feature, CASE WHEN feature = f THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS importance FROM cut, (VALUES ('m'), ('day')) names(feature)""", extra_ctes=_STUMP))
def q_tree_importances(spark, sf_dir):
    """Importances of that tree: the input that it splits has all of it."""
    _, prep, model = _stump(spark, sf_dir)
    return M.tree_importances(prep, model)


# --------------------------------------------------------- wide categoricals

@register("prepared_wide_rows", """
WITH held AS (SELECT o_orderkey, o_totalprice, CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS cust FROM orders),
levels AS (SELECT cust, ROW_NUMBER() OVER (ORDER BY cust) - 1 AS place FROM (SELECT DISTINCT cust FROM held WHERE cust IS NOT NULL)),
mode AS (SELECT cust FROM held WHERE cust IS NOT NULL GROUP BY 1 ORDER BY COUNT(*) DESC, 1 LIMIT 1)
SELECT o_orderkey, round(o_totalprice, 2) AS o_totalprice, CASE WHEN place > 0 THEN place - 1 END AS slot
FROM held JOIN levels ON levels.cust = coalesce(held.cust, (SELECT cust FROM mode))""")
def q_prepared_wide_rows(spark, sf_dir):
    """The place of every order's customer among the drop-first slots of a
    categorical whose levels are a table; those missing on every seventh key are
    filled with the most frequent one."""
    key = F.col("o_custkey").cast("string")
    held = _table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", F.when(F.col("o_orderkey") % 7 != 0, key).alias("cust"))
    prep = M.fit_preprocess(held, [], ["cust"], max_levels=16)
    if "cust" not in prep.wide:
        raise ValueError("orders of at most 16 customers")
    slot = F.col("cust__slot").cast("long")
    out = prep.transform(held, keep=["o_orderkey", "o_totalprice"]).select("o_orderkey", "o_totalprice", F.when(slot < prep.wide["cust"]["n"] - 1, slot).alias("slot"))
    return _round(out, {"o_totalprice": 2})


# ------------------------------------------------------------- column helpers

@register("columns_reduced", with_star("SELECT date_key, site_code, round(amount_br, 2) AS amount_br FROM fact_costs"))
def q_columns_reduced(spark, sf_dir):
    """Diagnostic columns dropped by suffix, equally named ones kept once."""
    f = _star(spark, sf_dir).fact_costs
    amount = F.col("amount_br").cast("double")
    twice = f.select("date_key", "site_code", amount.alias("amount_br"), (amount * 2).alias("amount_br_z"), (amount > 0).alias("amount_br_is_outlier"),
                     amount.alias("amount_br_cap"), F.lit("x").alias("site_code"), F.lit(0).alias("date_key"))
    return _round(C.drop_by_suffix(C.dedupe_column_names(twice)), {"amount_br": 2})


_KINDS = """SELECT column_name AS col, 'numeric' AS kind FROM (DESCRIBE orders) WHERE column_type IN ('BIGINT', 'INTEGER', 'DOUBLE')
            AND column_name NOT IN ('o_totalprice', 'o_custkey')
UNION ALL SELECT column_name, 'categorical' FROM (DESCRIBE orders) WHERE column_type = 'VARCHAR' OR column_name = 'o_custkey'"""


@register("column_kinds", f"""
SELECT col, kind, n_values FROM ({_KINDS}) JOIN (
  UNPIVOT (SELECT {", ".join(f"COUNT(DISTINCT {c}) AS {c}" for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"))} FROM orders)
  ON COLUMNS(*) INTO NAME col VALUE n_values) USING (col)""")
def q_column_kinds(spark, sf_dir):
    """Feature columns of orders by kind (target and date left out, a key forced
    to be categorical), with their distinct values."""
    df = _table(spark, sf_dir, "orders")
    numeric, categorical = C.split_columns_by_type(df, "o_totalprice", "o_orderdate", force_categorical=["o_custkey"])
    kinds = {c: "numeric" for c in numeric} | {c: "categorical" for c in categorical}
    row = df.agg(*[F.count_distinct(c).alias(c) for c in kinds])
    cells = F.array(*[F.struct(F.lit(c).alias("col"), F.lit(k).alias("kind"), F.col(c).alias("n_values")) for c, k in kinds.items()])
    return row.select(F.explode(cells).alias("r")).select("r.*")


@register("time_column_days", with_star("""
SELECT strftime(strptime(CAST(date_key AS VARCHAR), '%Y%m%d'), '%Y-%m-%d') AS day, COUNT(*) AS n FROM fact_energy GROUP BY 1"""))
def q_time_column_days(spark, sf_dir):
    """Rows a day by the time column found in the energy fact and parsed."""
    f = _star(spark, sf_dir).fact_energy
    col = C.detect_time_column(f)
    return C.with_parsed_time(f, col).groupBy(F.date_format(col, "yyyy-MM-dd").alias("day")).agg(F.count(F.lit(1)).alias("n"))


@register("events_in_utc", """
SELECT event_id, strftime(ts + INTERVAL 3 HOUR, '%Y-%m-%d %H:%M:%S') AS ts_utc FROM events""")
def q_events_in_utc(spark, sf_dir):
    """Wall-clock times of a zone three hours behind, as UTC."""
    from plantwise.plans.registry import ntz_text
    e = _table(spark, sf_dir, "events").select("event_id", F.col("ts").alias("ts_utc"))
    out = C.localize_to_utc(e, "ts_utc", "-03:00")
    return out.select("event_id", F.substring(ntz_text("ts_utc"), 1, 19).alias("ts_utc"))


@register("aligned_rows_robust", with_star(f"""
SELECT d.date_key, d.site_code, r.{Y}_robust, round(d.cost_per_unit_imp_roll3, 6) AS {Y}_roll3
FROM model_df d JOIN ({_robust_mad_sql()[1]}) r ON r.date_key = d.date_key AND r.site_code IS NOT DISTINCT FROM d.site_code""",
                                           extra_ctes=_F + ",\n" + _robust_mad_sql()[0]))
def q_aligned_rows_robust(spark, sf_dir):
    """A model that asks for a robust column which the scoring frame lacks."""
    out, _ = M.align_with_model_features(_model(spark, sf_dir), ["date_key", "site_code", f"{Y}_robust", f"{Y}_roll3"], None)
    return _round(out, {f"{Y}_robust": 7, f"{Y}_roll3": 6})


@register("robust_fallback", with_star(f"""
SELECT date_key, site_code, round({Y}, 6) AS {Y}_robust, round(kwh_per_unit_imp, 6) + 1 AS kwh_per_unit_imp_robust FROM model_df""", extra_ctes=_F))
def q_robust_fallback(spark, sf_dir):
    """Without a robust column its raw one stands in; a given one stays."""
    from plantwise.operators.features import add_robust_if_missing
    df = _round(_model(spark, sf_dir).select("date_key", "site_code", Y, "kwh_per_unit_imp"), {Y: 6, "kwh_per_unit_imp": 6})
    df = df.withColumn("kwh_per_unit_imp_robust", F.col("kwh_per_unit_imp") + 1)
    return add_robust_if_missing(df).select("date_key", "site_code", f"{Y}_robust", "kwh_per_unit_imp_robust")


# ------------------------------------------------------------ gates and views

@register("failed_errors", _qa_sql("""
SELECT q.rule_id, r.severity, q.message FROM results q JOIN qa_rules r USING (rule_id)
WHERE r.severity = 'ERROR' AND NOT COALESCE(q.ok, false)""", dims=_FAULTY, more=_FAULTY_SQL))
def q_failed_errors(spark, sf_dir):
    """What stops a run on a star whose dimensions and calendar don't fit."""
    from plantwise.operators import quality as Q
    results = Q.run_suite(_faulty_star(spark, sf_dir), as_of=AS_OF, meta_digits=6)
    return Q.failed_errors(results, Q.rules_frame(spark)).select("rule_id", "severity", "message")


@register("views_cost_by_month", with_star("""
SELECT d.y, d.m, c.site_code, COUNT(*) AS n, round(SUM(c.amount_br), 2) AS amount_br FROM fact_costs c JOIN dim_date d USING (date_key) GROUP BY ALL"""))
def q_views_cost_by_month(spark, sf_dir):
    """SQL over the star's named views."""
    _star(spark, sf_dir).register("pw_")
    out = spark.sql("SELECT d.y, d.m, c.site_code, COUNT(*) AS n, CAST(SUM(c.amount_br) AS DOUBLE) AS amount_br "
                    "FROM pw_fact_costs c JOIN pw_dim_date d USING (date_key) GROUP BY d.y, d.m, c.site_code")
    return _round(out, {"amount_br": 2})


# ---------------------------------------------------------------------- files

_READERS = ["layer", "by_extension", "projected", "raw_csv", "csv_glob", "fallback"]


@register("files_round_trip", f"""
SELECT reader, c_custkey, c_name, c_nationkey, round(c_acctbal, 2) AS c_acctbal
FROM customer, (VALUES {", ".join(f"('{r}')" for r in _READERS)}) readers(reader)""")
def q_files_round_trip(spark, sf_dir):
    """Customers written as a layer and as CSV, and read back in every way."""
    from plantwise.sources import files as S
    base = new_path(spark, "files")
    cols = ["c_custkey", "c_name", "c_nationkey", "c_acctbal"]
    layer = S.write_layer(_table(spark, sf_dir, "customer").select(*cols), base, "customer")
    text = S.parquet_to_csv(spark, layer, os.path.join(base, "customer_csv"))
    read = {"layer": S.read_any(spark, layer), "by_extension": spark.read.parquet(S.write_parquet(S.read_any(spark, layer), os.path.join(base, "copy"))),
            "projected": S.read_projected(spark, layer, cols), "raw_csv": S.load_raw_csv(spark, text),
            "csv_glob": S.load_csv_glob(spark, os.path.join(text, "*.csv")),
            "fallback": S.load_with_fallback(spark, os.path.join(base, "absent"), text)}
    out = None
    for name, df in read.items():
        part = df.select(F.lit(name).alias("reader"), F.col("c_custkey").cast("long"), "c_name", F.col("c_nationkey").cast("long"), F.col("c_acctbal").cast("double"))
        out = part if out is None else out.unionByName(part)
    return _round(out, {"c_acctbal": 2})


@register("exported_splits", with_star("""
SELECT split, COUNT(*) AS n, MIN(date_key) AS first_key, MAX(date_key) AS last_key, round(SUM(x), 3) AS sum_x
FROM (SELECT *, CASE WHEN rk < floor(0.8 * n) THEN 'train' ELSE 'test' END AS split FROM ranked) GROUP BY split""", extra_ctes=_SPLIT))
def q_exported_splits(spark, sf_dir):
    """Train and test frames, written and read back."""
    paths = MD.export_splits(*MD.split(_pairs(spark, sf_dir)), new_path(spark, "splits"))
    parts = [spark.read.parquet(p).groupBy(F.lit(k).alias("split")).agg(
        F.count(F.lit(1)).alias("n"), F.min("date_key").alias("first_key"), F.max("date_key").alias("last_key"), F.sum(X).alias("sum_x")) for k, p in paths.items()]
    return _round(parts[0].unionByName(parts[1]), {"sum_x": 3})


@register("saved_model_rows", with_star("""
SELECT date_key, site_code, round(b + a * x, 4) AS prediction
FROM pairs, (SELECT regr_slope(y, x) AS a, regr_intercept(y, x) AS b FROM pairs)""", extra_ctes=_PAIRS))
def q_saved_model_rows(spark, sf_dir):
    """A model saved with its feature list, loaded, and its predictions read
    back from the CSV they were written to."""
    from plantwise.sources import files as S
    df, base = _pairs(spark, sf_dir), new_path(spark, "model")
    prep = M.mean_centred(df, [X], Y)
    M.save_model(prep, M.fit(prep, df, Y, M.regressors()["LinearRegression"].setFitIntercept(False)), base, Y, ["date_key", "site_code", X])
    prep, model, meta = M.load_model(spark, base)
    aligned, _ = M.align_with_model_features(df, meta["feature_names_in"], meta["target"])
    scored = M.score(prep, model, aligned, keep=["date_key", "site_code"])
    back = S.load_raw_csv(spark, S.write_csv(scored, os.path.join(base, "predictions")))
    return _round(back.select(F.col("date_key").cast("int").alias("date_key"), F.col("site_code").cast("string").alias("site_code"), "prediction"), {"prediction": 4})
