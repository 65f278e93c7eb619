import os
import time

import pytest
from pyspark.sql import functions as F

from plantwise.operators import ml as M
from plantwise.streaming import ingest as ST


def _frame(spark, n=200):
    return spark.range(n).select(
        F.col("id").cast("int").alias("date_key"),
        F.when(F.col("id") % 3 == 0, "A").when(F.col("id") % 3 == 1, "B").otherwise("C").alias("site_code"),
        (F.col("id") % 12 + 1).cast("int").alias("m"),
        (F.col("id") * 0.5).alias("x1"), F.sin("id").alias("x2")) \
        .withColumn("y", 3 * F.col("x1") - 2 * F.col("x2") + F.when(F.col("site_code") == "B", 5.0).otherwise(0.0))


def test_preprocess_one_hot_drop_first(spark):
    df = _frame(spark)
    prep = M.fit_preprocess(df, ["x1", "x2"], ["site_code"], scaler=None)
    assert prep.levels["site_code"] == ["A", "B", "C"]
    assert prep.output_columns() == ["x1", "x2", "site_code_B", "site_code_C"]
    unk = spark.createDataFrame([(None, 1.0, "Z")], "x1 double, x2 double, site_code string")
    r = prep.transform(unk).first()
    assert r.x1 == prep.medians["x1"] and (r.site_code_B, r.site_code_C) == (0.0, 0.0)
    assert M.PreprocessModel.from_json(prep.to_json()) == prep


def test_linear_model_recovers_coefficients(spark):
    df = _frame(spark)
    prep = M.fit_preprocess(df, ["x1", "x2"], ["site_code"], scaler=None)
    model = M.fit(prep, df, "y", M.regressors()["LinearRegression"])
    coef = model.stages[-1].coefficients.toArray()
    assert coef[0] == pytest.approx(3.0, abs=1e-6) and coef[1] == pytest.approx(-2.0, abs=1e-6)
    assert coef[2] == pytest.approx(5.0, abs=1e-6)
    ev = M.evaluate(prep, model, df, "y").first()
    assert ev.RMSE < 1e-6


def test_mean_centred_fit_keeps_the_last_digits(spark, tmpdir_path):
    """Least squares about exact means, against fractions; the centre is saved.
    (Of doubles near 16384 neighbours are 3.6e-12 apart.)"""
    from fractions import Fraction as Fr
    rows = [(4000.0 + i % 97 + i / 7, 13000.0 + (i * i) % 8191 + i / 3) for i in range(3000)]
    df = spark.createDataFrame(rows, "x double, y double")
    prep = M.mean_centred(df, ["x"], "y")
    model = M.fit(prep, df, "y", M.regressors()["LinearRegression"].setFitIntercept(False))
    xs, ys = [Fr(x) for x, _ in rows], [Fr(y) for _, y in rows]
    mx, my = sum(xs) / len(xs), sum(ys) / len(ys)
    slope = sum((x - mx) * (y - my) for x, y in zip(xs, ys)) / sum((x - mx) ** 2 for x in xs)
    M.save_model(prep, model, f"{tmpdir_path}/centred", "y", ["x"])
    prep, model, _ = M.load_model(spark, f"{tmpdir_path}/centred")
    for r in M.predict(prep, model, df.limit(50), keep=["x"]).collect():
        assert abs(Fr(r.prediction) - (my + slope * (Fr(r.x) - mx))) < Fr(1, 10 ** 10)
    none = M.mean_centred(df.withColumn("x", F.lit(None).cast("double")), ["x"], "y")
    assert none.centers == {"x": 0.0} and M.mean_centred(df.limit(0), ["x"], "y").target_center == 0.0


def test_leaderboard_cv_kmeans_pca(spark, tmpdir_path):
    df = _frame(spark, 120)
    prep = M.fit_preprocess(df, ["x1", "x2"], ["site_code"])
    board, fitted = M.leaderboard(prep, df, df, "y", M.regressors(120, 1.0, rf_trees=5))
    rows = board.collect()
    assert len(rows) == 4 and rows[0].RMSE <= rows[-1].RMSE
    cv = M.temporal_cv(lambda t: M.fit_preprocess(t, ["x1", "x2"], ["site_code"]), df, "y",
                       M.regressors()["LinearRegression"], k=3)
    assert cv.count() == 3 and M.cv_summary(cv).first().rmse_mean is not None
    km, cost = M.kmeans_best_of(df, ["x1", "x2"], k=3, n_init=2)
    assert km.select("cluster_k3").distinct().count() == 3 and cost > 0
    pc = M.pca_2d(df, ["x1", "x2", "y"], keep=["date_key"])
    assert set(pc.columns) == {"date_key", "pc1", "pc2"}
    imp = M.tree_importances(prep, fitted["RandomForest"], top=2).collect()
    assert len(imp) == 2
    path = M.save_model(prep, fitted["LinearRegression"], f"{tmpdir_path}/model", "y",
                        ["x1", "x2", "site_code"])
    p2, m2, meta = M.load_model(spark, path)
    assert meta["feature_names_in"] == ["x1", "x2", "site_code"] and p2 == prep
    X, extra = M.align_with_model_features(df.withColumn("junk", F.lit(1)), meta["feature_names_in"], "y")
    assert "junk" in extra and X.columns == ["x1", "x2", "site_code", "y"]
    scored = M.score(p2, m2, X)
    assert "prediction" in scored.columns and scored.count() == 120
    with pytest.raises(ValueError):
        M.align_with_model_features(df.drop("x2"), ["x1", "x2"], "y")


def test_permutation_importance(spark):
    df = _frame(spark, 90)
    prep = M.fit_preprocess(df, ["x1", "x2"], [], scaler=None)
    model = M.fit(prep, df, "y", M.regressors()["LinearRegression"])
    imp = {r.feature: r.importance_mean for r in
           M.permutation_importance(prep, model, df, "y", ["x1", "x2"], repeats=2).collect()}
    assert imp["x1"] > imp["x2"] > -0.01


def test_permutation_importance_against_numpy(spark):
    """Donors by the MD5 of seed, repeat and rank; every pair scored at once."""
    import hashlib

    import numpy as np
    rows = [(i, (i * 37 % 101) / 10.0, float(i * i % 17), (i * 37 % 101) * 0.3 - (i * i % 17) + (i % 5)) for i in range(120)]
    df = spark.createDataFrame(rows, "k long, x1 double, x2 double, y double").repartition(4)
    prep = M.fit_preprocess(df, ["x1", "x2"], [], scaler=None)
    model = M.fit(prep, df, "y", M.regressors()["LinearRegression"])
    got = {r.feature: r for r in M.permutation_importance(prep, model, df, "y", ["x1", "x2"], repeats=3, order=["k"]).collect()}
    a = np.array(rows)[:, 1:]
    x, y = np.c_[np.ones(len(a)), a[:, :2]], a[:, 2]
    w = np.linalg.lstsq(x, y, rcond=None)[0]

    def r2(z):
        return 1 - ((y - z @ w) ** 2).sum() / ((y - y.mean()) ** 2).sum()

    for j, name in ((1, "x1"), (2, "x2")):
        drops = []
        for rep in range(3):
            at = sorted(range(len(a)), key=lambda k: (hashlib.md5(f"{42 + rep}|{k}".encode()).hexdigest(), k))
            z = x.copy()
            z[:, j] = x[at, j]
            drops.append(r2(x) - r2(z))
        assert got[name].importance_mean == pytest.approx(np.mean(drops), rel=1e-9)
        assert got[name].importance_std == pytest.approx(np.std(drops), rel=1e-9)


def test_lloyd_and_axes_against_numpy(spark):
    """Fixed starts, all restarts together; axes with a sign rule; gaps are imputed."""
    import hashlib

    import numpy as np
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(m, 0.4, (40, 3)) * [1, 5, 0.2] for m in (0, 3, 9)])
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id long, a double, b double, c double").repartition(4)
    z = (x - x.mean(0)) / x.std(0)
    best = None
    for r in range(4):
        order = sorted(range(len(z)), key=lambda i: hashlib.md5(f"{42 + r}|{i}".encode()).hexdigest())
        cen = z[order[:3]].copy()
        for _ in range(6):
            at = ((z[:, None] - cen) ** 2).sum(2).argmin(1)
            cen = np.array([z[at == j].mean(0) if (at == j).any() else cen[j] for j in range(3)])
        d = ((z[:, None] - cen) ** 2).sum(2)
        if best is None or d.min(1).sum() < best[0] - 1e-12:
            best = (d.min(1).sum(), d.argmin(1))
    got, cost = M.lloyd_kmeans(df, ["a", "b", "c"], ["id"], n_init=4, rounds=6)
    assert cost == pytest.approx(best[0], rel=1e-9) and got.columns == [*df.columns, "cluster_k3"]
    assert [r.cluster_k3 for r in got.orderBy("id").collect()] == best[1].tolist()
    gone = spark.createDataFrame([], df.schema)
    assert M.lloyd_kmeans(gone, ["a", "b", "c"], ["id"])[0].count() == 0
    value, vector = np.linalg.eigh(np.cov(z.T, bias=True))
    axes = M.principal_axes(spark.createDataFrame(z.tolist(), "a double, b double, c double"), ["a", "b", "c"])
    for axis, k in zip(axes, (2, 1)):
        assert abs(np.dot(axis, vector[:, k])) == pytest.approx(1, abs=1e-9) and axis[int(np.argmax(np.abs(axis)))] > 0


def test_lasso_certificate(spark):
    """Two of three inputs stay; the bound on the third holds, a moved solution fails."""
    rows = [(float(i % 7), float(i % 11), float(i % 2), 2.0 * (i % 7) - (i % 11) + 0.01 * (i % 2)) for i in range(154)]
    df = spark.createDataFrame([*rows, (None, 1.0, 1.0, 1.0)], "a double, b double, c double, y double")
    cols, alpha = ["a", "b", "c"], 0.1
    prep = M.fit_preprocess(df.na.drop(), cols, [], scaler=None)
    fit = M.fit(prep, df.na.drop(), "y", M.elastic_net(alpha, 1.0).setTol(1e-12)).stages[-1]
    w = fit.coefficients.toArray().tolist()
    proof = {r.feature: r for r in M.lasso_certificate(df, cols, "y", w, fit.intercept, alpha).collect()}
    assert max(r.slack for r in proof.values()) < 1e-5 and proof["c"].coefficient == 0 and w[0] < 2
    moved = M.lasso_certificate(df, cols, "y", [2.0, -1.0, 0.0], fit.intercept, alpha).collect()
    assert max(r.slack for r in moved) > 0.05


def test_wide_categorical_has_the_slots_of_a_narrow_one(spark, tmpdir_path):
    """The level table and the level list give the same vectors, for unknown,
    missing and first levels too, and through save and load."""
    rows = [(i, f"c{i % 9}" if i % 11 else None, float(i % 5)) for i in range(200)]
    df = spark.createDataFrame(rows, "k long, c string, x double").repartition(3)
    new = spark.createDataFrame([(1000, "never seen", 1.0), (1001, "c0", None), (1002, None, 2.0), (1003, "c8", 3.0)], df.schema)
    narrow, wide = M.fit_preprocess(df, ["x"], ["c"]), M.fit_preprocess(df, ["x"], ["c"], max_levels=4)
    assert not narrow.wide and wide.wide["c"]["n"] == 9 and narrow.modes == wide.modes
    assert wide.vector_names() == narrow.output_columns()
    for part in (df, new):
        a, b = ({r.k: r.features.toArray().tolist() for r in p.assemble(part, keep=["k"]).collect()} for p in (narrow, wide))
        assert a == b and len(a) == part.count()
    fitted = M.fit(wide, df.withColumn("y", F.length("c").cast("double") + F.col("x")).na.drop(), "y", M.regressors()["LinearRegression"])
    again, model, _ = M.load_model(spark, M.save_model(wide, fitted, f"{tmpdir_path}/wide", "y", ["x", "c"]))
    assert again.wide["c"]["path"].startswith(f"{tmpdir_path}/wide")
    assert {r.k: r.prediction for r in M.score(again, model, new).collect()} == {r.k: r.prediction for r in M.predict(wide, fitted, new, keep=["k"]).collect()}


def test_fifty_thousand_levels(spark):
    """Prepared and scored without a column a level."""
    df = spark.range(100_000).select(F.col("id").alias("k"), F.concat(F.lit("u"), F.col("id") % 50_000).alias("c"), (F.col("id") % 2).cast("double").alias("y"))
    prep = M.fit_preprocess(df, [], ["c"])
    assert prep.wide["c"]["n"] == 50_000 and len(prep.output_columns()) == 0 and prep.modes["c"] == "u0"
    data = prep.assemble(df, keep=["k", "y"])
    one = data.where("k = 7").first().features
    assert one.size == 49_999 and one.numNonzeros() == 1
    from pyspark.ml.regression import LinearRegression
    model = M.fit(prep, df, "y", LinearRegression(solver="l-bfgs", maxIter=2, regParam=0.1))
    assert M.score(prep, model, df, keep=["k"]).where("prediction IS NOT NULL").count() == 100_000


def test_grid_of_the_forest_and_its_inert_axis(spark):
    from pyspark.ml.regression import RandomForestRegressor
    points = M.grid_points(M.RF_GRID)
    assert len(points) == 243 and set(M.RF_INERT) < set(points[0])
    grid = M.grid_points({"numTrees": [1, 3], "minRowsToSplit": [2, 5, 10]})
    made = []

    def forest(**p):
        made.append(p)
        return RandomForestRegressor(seed=1, maxDepth=3, **p)

    out = M.grid_search(lambda t: M.fit_preprocess(t, ["x1", "x2"], ["site_code"]), _frame(spark, 90), "y", forest, grid, k=2, inert=M.RF_INERT).collect()
    assert len(out) == 6 and [r.place for r in out] == list(range(1, 7)) and len(made) == 4
    assert [r.cv_rmse for r in out] == sorted(r.cv_rmse for r in out) and len({r.cv_rmse for r in out}) == 2
    bad = M.grid_search(lambda t: M.fit_preprocess(t, ["x1"], []), _frame(spark, 30), "y", lambda numTrees: RandomForestRegressor(numTrees=numTrees),
                        [{"numTrees": 1}, {"numTrees": -1}], k=2).collect()
    assert bad[0].cv_rmse is not None and bad[1].cv_rmse is None


def test_score_of_a_classifier_has_class_probabilities(spark):
    from pyspark.ml.classification import LogisticRegression
    df = _frame(spark, 40).withColumn("up", (F.col("x1") > 10).cast("double"))
    prep = M.fit_preprocess(df, ["x1"], [])
    out = M.score(prep, M.fit(prep, df, "up", LogisticRegression()), df, keep=["date_key"])
    assert all(abs(r.proba_0 + r.proba_1 - 1) < 1e-9 for r in out.collect()) and "probability" not in out.columns


def test_streaming_silver_ingest(spark, tmpdir_path):
    src = f"{tmpdir_path}/drop"
    os.makedirs(src)
    with open(f"{src}/a.csv", "w") as f:
        f.write("timestamp,site_code,line_code,equip_code,kwh,kw_demand,kvarh\n"
                "2025-04-01 10:00:00,SC01,L1,E1,5,2,1\n2025-04-01 11:00:00,SC01,L1,E1,-2,4,1\n")
    cols = ["timestamp", "site_code", "line_code", "equip_code", "kwh", "kw_demand", "kvarh"]
    q = ST.start_silver_ingest(spark, "energy", src, cols, f"{tmpdir_path}/silver",
                               f"{tmpdir_path}/ckpt")
    q.awaitTermination(120)
    silver = spark.read.parquet(f"{tmpdir_path}/silver")
    assert sorted(r.kwh for r in silver.collect()) == [0.0, 5.0]
    daily = ST.energy_daily_stream(ST.silver_stream(ST.raw_stream(spark, src, cols), "energy"))
    assert daily.isStreaming and "kwh_day" in daily.columns


def test_streaming_daily_rollup_emits_closed_days(spark, tmpdir_path):
    src = f"{tmpdir_path}/drop2"
    os.makedirs(src)
    cols = ["timestamp", "site_code", "line_code", "equip_code", "kwh", "kw_demand", "kvarh"]
    head = ",".join(cols) + "\n"
    with open(f"{src}/a.csv", "w") as f:
        f.write(head + "2025-04-01 10:00:00,SC01,L1,E1,5,2,1\n2025-04-01 11:00:00,SC01,L1,E1,7,4,1\n")
    daily = ST.energy_daily_stream(ST.silver_stream(ST.raw_stream(spark, src, cols), "energy"),
                                   lateness="1 hour")
    q = daily.writeStream.format("memory").queryName("pw_daily").outputMode("append").start()
    try:
        q.processAllAvailable()
        with open(f"{src}/b.csv", "w") as f:   # advances the watermark past 2025-04-01
            f.write(head + "2025-04-03 10:00:00,SC01,L1,E1,1,1,1\n")
        q.processAllAvailable()
        q.processAllAvailable()
        rows = spark.sql("SELECT * FROM pw_daily").collect()
    finally:
        q.stop()
    assert [(r.date_key, r.kwh_day, r.kw_demand_peak_day) for r in rows] == [(20250401, 12.0, 4.0)]
