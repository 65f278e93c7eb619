"""Model training, evaluation and scoring on Spark ML.

Preprocessing is fitted with exact DataFrame statistics (interpolated
medians and quartiles, population std, most frequent level) and applied as
plain column expressions, so scoring is a projection Catalyst can fuse into
whole-stage code.  The fitted statistics (one number per column, category
levels bounded by the category cardinality) are the only values brought to
the driver; they are saved as JSON beside the Spark ``PipelineModel``.  The
levels of a wide categorical stay in a table that scoring joins.
"""

from __future__ import annotations

import json
import os
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field, replace

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import Imputer, OneHotEncoder, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plantwise.functions.materialize import materialize, new_path
from plantwise.functions.quantiles import quantiles
from plantwise.functions.ranking import rank_rows
from plantwise.functions.safe import ratio
from plantwise.functions.scalars import with_scalars
from plantwise.operators.metrics import regression_metrics

FEATURES = "features"
# One-hot columns that a categorical may become; one with more levels gets a
# table of its levels and one sparse vector, with the same slots.
MAX_LEVELS = 256


# ------------------------------------------------------------- preprocessing

@dataclass
class PreprocessModel:
    num_cols: list[str]
    cat_cols: list[str]
    medians: dict[str, float | None] = field(default_factory=dict)
    scales: dict[str, float] = field(default_factory=dict)
    centers: dict[str, float] = field(default_factory=dict)
    modes: dict[str, str | None] = field(default_factory=dict)
    levels: dict[str, list[str]] = field(default_factory=dict)
    # Wide categoricals: {"path": table of (level, slot), "n": number of levels}.
    wide: dict[str, dict] = field(default_factory=dict)
    # Taken off the target before a fit and put back on predictions, so that sums
    # over many rows of a target far from 0 keep their last digits.
    target_center: float = 0.0

    def output_columns(self) -> list[str]:
        out = list(self.num_cols)
        for c in self.cat_cols:
            out += [f"{c}_{v}" for v in self.levels.get(c, [])[1:]]
        return out

    def transform(self, df: DataFrame, keep: Sequence[str] = (), prefix: str = "") -> DataFrame:
        """Imputed/scaled numerics and drop-first one-hot columns (unknown or
        missing level -> all zeros after mode imputation), plus ``keep``.

        A wide categorical is one column ``<name>__slot`` instead: the place of
        its one among ``n - 1``, or ``n - 1`` where no place has it.  The slot is
        joined from the level table, so no plan and no driver list grows with
        the levels, and a hot level is split like any skewed join key."""
        exprs = []
        for c in self.num_cols:
            x = F.coalesce(F.col(c).cast("double"), F.lit(self.medians.get(c)).cast("double"))
            x = (x - F.lit(self.centers.get(c, 0.0))) / F.lit(self.scales.get(c, 1.0))
            exprs.append(x.alias(prefix + c))
        for c in self.cat_cols:
            v = F.coalesce(F.col(c).cast("string"), F.lit(self.modes.get(c)))
            for lv in self.levels.get(c, [])[1:]:
                exprs.append((v == F.lit(lv)).cast("double").alias(f"{prefix}{c}_{lv}"))
        for i, (c, w) in enumerate(self.wide.items()):
            table = df.sparkSession.read.parquet(w["path"]).select(F.col("level").alias(f"__level{i}"), F.col("slot").alias(f"__slot{i}"))
            v = F.coalesce(F.col(c).cast("string"), F.lit(self.modes.get(c)))
            df = df.join(table, v == F.col(f"__level{i}"), "left")
            exprs.append(F.coalesce(F.col(f"__slot{i}"), F.lit(w["n"] - 1)).cast("double").alias(f"{prefix}{c}__slot"))
        return df.select(*keep, *exprs)

    def assemble(self, df: DataFrame, keep: Sequence[str] = (), fill: float | None = None) -> DataFrame:
        """``keep`` and the feature vector; ``fill`` stands where a prepared
        value is still null or NaN."""
        t = self.transform(df, keep, prefix="__f_")
        names = ["__f_" + c for c in self.output_columns()]
        if fill is not None:
            t = t.fillna(fill, subset=names)
        for c, w in self.wide.items():
            # The encoder learns its length from one row; the last slot is the dropped one.
            size = df.sparkSession.createDataFrame([(float(w["n"] - 1),)], f"`__f_{c}__slot` double")
            t = OneHotEncoder(inputCol=f"__f_{c}__slot", outputCol=f"__f_{c}__hot", dropLast=True).fit(size).transform(t)
            names.append(f"__f_{c}__hot")
        va = VectorAssembler(inputCols=names, outputCol=FEATURES, handleInvalid="keep")
        return va.transform(t).select(*keep, FEATURES)

    def vector_names(self) -> list[str]:
        """Names of the slots of the assembled vector (as long as the model)."""
        out = self.output_columns()
        for c, w in self.wide.items():
            table = SparkSession.getActiveSession().read.parquet(w["path"])
            out += [f"{c}_{r.level}" for r in table.where(F.col("slot") < w["n"] - 1).orderBy("slot").toLocalIterator()]
        return out

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> "PreprocessModel":
        return PreprocessModel(**json.loads(text))


def fit_preprocess(df: DataFrame, num_cols: Sequence[str], cat_cols: Sequence[str],
                   scaler: str | None = "robust", method: str = "exact", max_levels: int = MAX_LEVELS) -> PreprocessModel:
    """Fit median imputation + scaling (``robust``: divide by IQR, no
    centring; ``standard``: centre and divide by the population std) and
    most-frequent imputation + levels for the categoricals: a list up to
    ``max_levels`` of them, a written table beyond (ranks by range shuffle).
    Both give the same vector slots."""
    num_cols, cat_cols = list(num_cols), list(cat_cols)
    m = PreprocessModel(num_cols, cat_cols)
    if num_cols:
        long = df.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("k"), F.col(c).cast("double").alias("v")) for c in num_cols
        ])).alias("kv")).select("kv.k", "kv.v")
        q = quantiles(long, "v", [0.25, 0.5, 0.75], by=["k"], names=["q1", "q2", "q3"],
                      method=method).collect()
        qs = {r["k"]: r for r in q}
        mom = df.agg(*[F.avg(c).alias(f"a_{i}") for i, c in enumerate(num_cols)],
                     *[F.stddev_pop(c).alias(f"s_{i}") for i, c in enumerate(num_cols)]).first()
        for i, c in enumerate(num_cols):
            r = qs.get(c)
            m.medians[c] = r["q2"] if r else None
            if scaler == "robust":
                iqr = (r["q3"] - r["q1"]) if r and r["q3"] is not None else None
                m.scales[c] = iqr if iqr else 1.0
            elif scaler == "standard":
                m.centers[c] = mom[f"a_{i}"] or 0.0
                m.scales[c] = mom[f"s_{i}"] or 1.0
    for c in cat_cols:
        freq = df.where(F.col(c).isNotNull()).groupBy(F.col(c).cast("string").alias("v")).count()
        rows = freq.orderBy(F.desc("count"), "v").limit(max_levels + 1).collect()
        m.modes[c] = rows[0]["v"] if rows else None
        if len(rows) > max_levels:
            m.wide[c] = _level_table(freq.select(F.col("v").alias("level")))
        else:
            m.levels[c] = sorted(r["v"] for r in rows)
    return m


def _level_table(levels: DataFrame) -> dict:
    """Writes ``level, slot`` of the distinct ``levels`` in their order: the
    first is dropped, so it gets the last slot and the others move up by one."""
    spark = levels.sparkSession
    ranked = materialize(rank_rows(levels, ["level"], name="at"), "level-ranks")
    n = ranked.count()
    path = new_path(spark, "levels")
    slot = F.when(F.col("at") == 0, F.lit(n - 1)).otherwise(F.col("at") - 1)
    ranked.select("level", slot.cast("long").alias("slot")).write.parquet(path)
    return {"path": path, "n": n}


def nan_check(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count of null/NaN feature values (must be 0 before fitting)."""
    return df.agg(F.sum(sum((F.when(F.col(c).isNull() | F.isnan(c), 1).otherwise(0)
                             for c in cols), F.lit(0))).alias("bad_values"))


# --------------------------------------------------------------------- models

def regressors(n_rows: int | None = None, y_std_pop: float | None = None,
               rf_trees: int = 600, seed: int = 42) -> dict[str, object]:
    """Linear, ridge (alpha 1), lasso (alpha 0.001) and a random forest.

    Ridge's alpha maps to Spark's regParam as alpha * std_pop(y) / n
    (Spark scales the squared loss by 1/2n and the label by its std)."""
    ridge_reg = 1.0 * (y_std_pop or 1.0) / (n_rows or 1)
    return {
        "LinearRegression": LinearRegression(regParam=0.0, solver="normal"),
        "Ridge": LinearRegression(regParam=ridge_reg, elasticNetParam=0.0, standardization=False,
                                  solver="normal"),
        "Lasso": LinearRegression(regParam=0.001, elasticNetParam=1.0, standardization=False,
                                  maxIter=10000, tol=1e-12),
        "RandomForest": RandomForestRegressor(numTrees=rf_trees, maxDepth=10,
                                              featureSubsetStrategy="0.7", seed=seed),
    }


def elastic_net(alpha: float = 1.0, l1_ratio: float = 0.5) -> LinearRegression:
    """Elastic net (declared in the analysis, not used by its leaderboard)."""
    return LinearRegression(regParam=alpha, elasticNetParam=l1_ratio, standardization=False,
                            maxIter=10000)


def mean_centred(train: DataFrame, cols: Sequence[str], target: str) -> PreprocessModel:
    """Columns and target about their means, not scaled or filled: with an
    estimator without intercept, least squares whose predictions carry no rounding
    of long sums.  Whole and fractional parts are summed apart (whole numbers add
    up exactly below 2^53); a column without values is centred at 0."""
    whole = lambda c: F.floor(F.col(c)).cast("double")
    row = train.agg(*[((F.sum(whole(c)) + F.sum(F.col(c) - whole(c))) / F.count(c)).alias(f"m{i}") for i, c in enumerate([*cols, target])]).first()
    means = [v or 0.0 for v in row]
    return PreprocessModel(list(cols), [], medians={c: None for c in cols}, scales={c: 1.0 for c in cols},
                           centers=dict(zip(cols, means)), target_center=means[-1])


def fit(prep: PreprocessModel, train: DataFrame, target: str, estimator) -> PipelineModel:
    data = prep.assemble(train, keep=[target]).withColumnRenamed(target, "label")
    if prep.target_center:
        data = data.withColumn("label", F.col("label") - F.lit(prep.target_center))
    return Pipeline(stages=[estimator]).fit(data)


def predict(prep: PreprocessModel, model: PipelineModel, df: DataFrame,
            keep: Sequence[str] = ()) -> DataFrame:
    out = model.transform(prep.assemble(df, keep=keep))
    return out.withColumn("prediction", F.col("prediction") + F.lit(prep.target_center)) if prep.target_center else out


def evaluate(prep: PreprocessModel, model: PipelineModel, test: DataFrame, target: str) -> DataFrame:
    pred = predict(prep, model, test, keep=[target]).select(
        F.col(target).alias("y_true"), "prediction")
    return regression_metrics(pred)


def leaderboard(prep: PreprocessModel, train: DataFrame, test: DataFrame, target: str,
                models: dict[str, object]) -> tuple[DataFrame, dict[str, PipelineModel]]:
    """Fit each model, score the test set; failures are reported, not raised.
    Ordered by RMSE (best first)."""
    spark = train.sparkSession
    rows, fitted = [], {}
    for name, est in models.items():
        try:
            m = fit(prep, train, target, est)
            fitted[name] = m
            rows.append(evaluate(prep, m, test, target).select(F.lit(name).alias("model"), "*",
                                                              F.lit(None).cast("string").alias("error")))
        except Exception as e:  # noqa: BLE001 -- a failing model is a leaderboard row
            rows.append(spark.createDataFrame(
                [(name, str(e))], "model string, error string"))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r, allowMissingColumns=True)
    return out.orderBy(F.asc_nulls_last("RMSE")), fitted


def temporal_cv(prep_fit, df: DataFrame, target: str, estimator, k: int = 5,
                order: Sequence[str] = ("date_key", "site_code")) -> DataFrame:
    """Expanding-window CV: RMSE per fold, then mean and population std.
    ``prep_fit(train_df) -> PreprocessModel`` is refitted on every fold."""
    from plantwise.operators.features import expanding_folds
    ranked = rank_rows(df, list(order))
    folds = expanding_folds(ranked, k)
    res = []
    for i in range(k):
        f = folds.where(F.col("fold") == i)
        tr = f.where(F.col("role") == "train").drop("fold", "role", "row_rank")
        te = f.where(F.col("role") == "test").drop("fold", "role", "row_rank")
        prep = prep_fit(tr)
        m = fit(prep, tr, target, estimator)
        res.append(evaluate(prep, m, te, target).select(F.lit(i).alias("fold"), "RMSE"))
    out = res[0]
    for r in res[1:]:
        out = out.unionByName(r)
    return out


def cv_summary(per_fold: DataFrame) -> DataFrame:
    return per_fold.agg(F.avg("RMSE").alias("rmse_mean"), F.stddev_pop("RMSE").alias("rmse_std"))


def grid_search(prep_fit, df: DataFrame, target: str, make_estimator, grid: list[dict],
                k: int = 5, order: Sequence[str] = ("date_key", "site_code"), inert: Sequence[str] = (),
                workers: int = 4) -> DataFrame:
    """``params, cv_rmse, cv_std, place``: mean and population deviation of the
    expanding-window RMSE of every point of ``grid``, best first (ties by
    ``params``).

    Rows are ranked once; each fold is prepared and its vectors are written
    once, for all points.  ``workers`` fits run at a time as Spark jobs of their
    own.  Points that differ only in ``inert`` axes, which the estimator has no
    parameter for, share one fit and so one score; ``make_estimator`` gets the
    other axes.  A point whose fit fails has a null score.
    """
    from concurrent.futures import ThreadPoolExecutor

    from plantwise.operators.features import expanding_folds
    spark = df.sparkSession
    folds = expanding_folds(materialize(rank_rows(df, list(order)), "grid-rows"), k)
    sides = []
    for i in range(k):
        f = folds.where(F.col("fold") == i)
        tr, te = (f.where(F.col("role") == r).drop("fold", "role", "row_rank") for r in ("train", "test"))
        prep = prep_fit(tr)
        sides.append([materialize(prep.assemble(x, keep=[target]).withColumnRenamed(target, "label"), f"grid-fold{i}") for x in (tr, te)])
    name = lambda p: json.dumps(p, sort_keys=True)
    live = [{a: v for a, v in p.items() if a not in inert} for p in grid]
    distinct = {name(p): p for p in live}

    def rmse(job):
        key, (tr, te) = job
        model = make_estimator(**distinct[key]).fit(tr)
        return regression_metrics(model.transform(te).select(F.col("label").alias("y_true"), "prediction")).first()["RMSE"]

    def attempt(job):
        try:
            return job[0], float(rmse(job))
        except Exception:  # noqa: BLE001 -- a failing point is a row without a score
            return job[0], None

    with ThreadPoolExecutor(max_workers=workers) as pool:
        done = list(pool.map(attempt, [(key, side) for key in distinct for side in sides]))
    scores: dict[str, list] = {}
    for key, v in done:
        scores.setdefault(key, []).append(v)
    rows = []
    for p, key in zip(grid, map(name, live)):
        v = scores[key]
        known = None not in v
        rows.append((name(p), float(np.mean(v)) if known else None, float(np.std(v)) if known else None))
    rows.sort(key=lambda r: (r[1] is None, r[1] or 0.0, r[0]))
    return spark.createDataFrame([(*r, i + 1) for i, r in enumerate(rows)], "params string, cv_rmse double, cv_std double, place int")


# The random-forest grid of the source analysis, 243 points.  The
# least rows of a node to split have no Spark parameter, so that axis is inert
# (RF_INERT) and its points share a score; depth 30 is Spark's greatest and
# stands for "no limit".
RF_GRID = {
    "numTrees": [300, 600, 900],
    "maxDepth": [30, 6, 10],
    "minRowsToSplit": [2, 5, 10],
    "minInstancesPerNode": [1, 2, 4],
    "featureSubsetStrategy": ["sqrt", "log2", "0.7"],
}
RF_INERT = ["minRowsToSplit"]


def grid_points(axes: dict[str, list]) -> list[dict]:
    """Every combination of the axes."""
    from itertools import product
    return [dict(zip(axes, v)) for v in product(*axes.values())]


# ----------------------------------------------------------------- clustering

def unsupervised_prep(df: DataFrame, num_cols: Sequence[str], cat_cols: Sequence[str] = (),
                      scale: bool = True) -> PreprocessModel:
    """Input matrix of clustering and PCA: numerics median-imputed and
    standardised (mean and deviation of the imputed columns), categoricals
    most-frequent-imputed and one-hot."""
    prep = fit_preprocess(df, num_cols, cat_cols, scaler=None)
    if scale and prep.num_cols:
        x = {c: F.coalesce(F.col(c).cast("double"), F.lit(prep.medians[c]).cast("double")) for c in prep.num_cols}
        mom = df.agg(*[F.avg(v).alias(f"a{i}") for i, v in enumerate(x.values())],
                     *[F.stddev_pop(v).alias(f"s{i}") for i, v in enumerate(x.values())]).first()
        for i, c in enumerate(x):
            prep.centers[c], prep.scales[c] = mom[f"a{i}"] or 0.0, mom[f"s{i}"] or 1.0
    return prep


def with_vector(prep: PreprocessModel, df: DataFrame) -> DataFrame:
    """All columns of ``df`` and its feature vector (a column without any value
    counts as 0)."""
    return prep.assemble(df, keep=df.columns, fill=0.0)


def kmeans_best_of(df: DataFrame, cols: Sequence[str], k: int = 3, n_init: int = 10,
                   seed: int = 42, scale: bool = True, out: str = "cluster_k3",
                   cat_cols: Sequence[str] = ()) -> tuple[DataFrame, float]:
    """KMeans restarted with ``n_init`` seeds; the lowest training cost wins.
    Every row gets a cluster: gaps are imputed (see :func:`unsupervised_prep`)."""
    prep = unsupervised_prep(df, cols, cat_cols, scale)
    data = with_vector(prep, df).cache()
    best, best_cost = None, float("inf")
    for i in range(n_init):
        m = KMeans(k=k, seed=seed + i, featuresCol=FEATURES, predictionCol=out).fit(data)
        cost = m.summary.trainingCost
        if cost < best_cost:
            best, best_cost = m, cost
    data.unpersist()
    return best.transform(with_vector(prep, df)).drop(FEATURES), best_cost


def lloyd_kmeans(df: DataFrame, cols: Sequence[str], keys: Sequence[str], k: int = 3, n_init: int = 10,
                 rounds: int = 15, seed: int = 42, scale: bool = True, out: str = "cluster_k3") -> tuple[DataFrame, float]:
    """KMeans with fixed starts and steps: ``df`` with ``out``, and the cost.

    The starts of restart r are the rows whose MD5 of ``<seed + r>|<keys>`` is
    least, so ``keys`` should name a row.  All restarts move together: a round
    is one scan that gives every row its nearest centre in each restart (the
    smaller number of equals) and one group of sums, ``n_init * k`` rows, which
    are all that reach the driver.  After ``rounds`` moves the restart with the
    least cost assigns (the first of equals).  An empty cluster keeps its centre.
    """
    prep = unsupervised_prep(df, cols, scale=scale)
    names = [f"__f_{c}" for c in prep.output_columns()]
    own = [F.col(f"`{c}`") for c in df.columns]
    data = materialize(prep.transform(df, keep=own, prefix="__f_").fillna(0.0, subset=names), "kmeans-rows")
    hashed = F.explode(F.array(*[F.struct(F.lit(r).alias("r"), F.md5(F.concat_ws("|", F.lit(str(seed + r)), *[F.col(c).cast("string") for c in keys])).alias("h"))
                                 for r in range(n_init)]))
    nth = F.row_number().over(Window.partitionBy("r").orderBy("h", *names))
    first = data.select(*names, hashed.alias("s")).select("s.*", *names).withColumn("n", nth).where(F.col("n") <= k)
    centres: dict[int, list[list[float]]] = {}
    for row in first.orderBy("r", "n").collect():
        centres.setdefault(row.r, []).append([row[c] for c in names])
    if not centres:
        return df.withColumn(out, F.lit(None).cast("int")), 0.0

    for cen in centres.values():
        cen += [cen[0]] * (k - len(cen))   # fewer rows than centres: copies of the first, which win no row
    spots = [[f"__c{j}_{i}" for i in range(len(names))] for j in range(k)]
    table = "__r int, " + ", ".join(f"{c} double" for spot in spots for c in spot)
    # A row's nearest centre and squared distance, from the columns of the centre table.
    apart = [sum(((F.col(c) - F.col(x)) * (F.col(c) - F.col(x)) for c, x in zip(names, spot)), F.lit(0.0)) for spot in spots]
    nearest = F.array_min(F.array(*[F.struct(d.alias("d"), F.lit(j).alias("j")) for j, d in enumerate(apart)]))

    def placed(rows, restarts):
        small = df.sparkSession.createDataFrame([(r, *[float(x) for at in centres[r] for x in at]) for r in restarts], table)
        each = rows.withColumn("__r", F.explode(F.array(*[F.lit(r) for r in restarts]))).join(small, "__r")
        return each.withColumn("__at", nearest)

    for _ in range(rounds):
        sums = placed(data.select(*names), list(centres)).groupBy(F.col("__r").alias("r"), F.col("__at.j").alias("j")).agg(*[F.avg(c).alias(c) for c in names])
        for row in sums.collect():
            centres[row.r][row.j] = [row[c] for c in names]
    costs = {row.r: row.cost for row in placed(data.select(*names), list(centres)).groupBy(F.col("__r").alias("r")).agg(F.sum("__at.d").alias("cost")).collect()}
    best = min(costs, key=lambda r: (costs[r], r))
    return placed(data, [best]).select(*own, F.col("__at.j").alias(out)), costs[best]


def cluster_pipeline(cols: Sequence[str], k: int = 3, seed: int = 42) -> Pipeline:
    """Median imputation, standard scaling, KMeans; no row is dropped."""
    filled = [f"__i_{c}" for c in cols]
    return Pipeline(stages=[
        Imputer(strategy="median", inputCols=list(cols), outputCols=filled, relativeError=0.0),
        VectorAssembler(inputCols=filled, outputCol="__raw"),
        StandardScaler(inputCol="__raw", outputCol=FEATURES, withMean=True, withStd=True),
        KMeans(k=k, seed=seed, featuresCol=FEATURES, predictionCol="cluster")])


def principal_axes(df: DataFrame, cols: Sequence[str], n: int = 2) -> list[list[float]]:
    """The first ``n`` eigenvectors of the covariance of ``cols``, from one
    aggregate of their pairs (as many numbers as pairs of columns).  The entry
    of greatest magnitude, the first of equals, is positive."""
    pairs = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    row = df.agg(*[F.covar_pop(cols[i], cols[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    gram = np.zeros((len(cols), len(cols)))
    for i, j in pairs:
        gram[i, j] = gram[j, i] = row[f"c{i}_{j}"] or 0.0
    value, vector = np.linalg.eigh(gram)
    axes = []
    for k in np.argsort(-value, kind="stable")[:n]:
        v = vector[:, k]
        axes.append((v * np.sign(v[np.argmax(np.round(np.abs(v), 9))])).tolist())
    return axes


def pca_2d(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = (),
           cat_cols: Sequence[str] = ()) -> DataFrame:
    """First two principal components (pc1, pc2) of every row's imputed and
    standardised input (see :func:`unsupervised_prep`), axes by
    :func:`principal_axes`; a second component of one column is 0."""
    prep = unsupervised_prep(df, cols, cat_cols)
    if prep.wide:
        raise ValueError(f"axes of all pairs of slots are not for wide categoricals: {list(prep.wide)}")
    names = [f"__f_{c}" for c in prep.output_columns()]
    data = prep.transform(df, keep=[F.col(c) for c in keep], prefix="__f_").fillna(0.0, subset=names)
    axes = principal_axes(data, names) + [[0.0] * len(names)] * 2
    return data.select(*keep, *[sum((F.lit(float(w)) * F.col(c) for c, w in zip(names, axis)), F.lit(0.0)).alias(f"pc{i + 1}") for i, axis in enumerate(axes[:2])])


# ----------------------------------------------------------------- importance

def tree_importances(prep: PreprocessModel, model: PipelineModel, top: int | None = None
                     ) -> DataFrame:
    """Feature importances of the final tree model with expanded names,
    normalised to sum 1, largest first."""
    spark = SparkSession.getActiveSession()
    est = model.stages[-1]
    imp = est.featureImportances.toArray().tolist()
    names = prep.vector_names()
    total = sum(imp) or 1.0
    df = spark.createDataFrame([(n, float(v) / total) for n, v in zip(names, imp)],
                               "feature string, importance double")
    df = df.orderBy(F.desc("importance"), "feature")
    return df.limit(top) if top else df


def permutation_importance(prep: PreprocessModel, model: PipelineModel, test: DataFrame,
                           target: str, cols: Sequence[str], repeats: int = 20,
                           seed: int = 42, order: Sequence[str] | None = None) -> DataFrame:
    """Mean and std of the R2 drop when one raw input column is shuffled.

    Rows get a rank in ``order`` (by default a hash of the row, so a lost block
    is rebuilt alike).  In each repeat they get a second rank by the MD5 of
    ``<seed + repeat>|<rank>``: the row at that rank receives the values of the
    row that drew it.  One grouped ranking serves all repeats, one donor order a
    repeat serves all columns, and every (column, repeat) pair is scored in the
    same job and reduced by group.
    """
    held = [c for c in dict.fromkeys([*prep.num_cols, *prep.cat_cols, *cols]) if c in test.columns]
    src = test if order else test.withColumn("__tie", F.xxhash64(*[F.col(c) for c in test.columns]))
    ranked = rank_rows(src, list(order) if order else ["__tie"], name="__r0")
    keyed = materialize(ranked.select("__r0", F.col(target).alias("__y"), *held), "permuted-rows")
    draws = keyed.select("__r0", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))).alias("__rep"))
    draws = draws.withColumn("__draw", F.md5(F.concat_ws("|", (F.col("__rep") + seed).cast("string"), F.col("__r0").cast("string"))))
    donors = rank_rows(draws, ["__draw", "__r0"], by=["__rep"], name="__at").select("__rep", "__at", F.col("__r0").alias("__from"))
    gives = keyed.select(F.col("__r0").alias("__from"), *[F.col(c).alias(f"__d{i}") for i, c in enumerate(cols)])
    rows = donors.join(gives, "__from").join(keyed.withColumnRenamed("__r0", "__at"), "__at")
    variants = F.array(*[F.struct(F.lit(c).alias("feature"), *[(F.col(f"__d{i}") if k == c else F.col(k)).alias(k) for k in held])
                         for i, c in enumerate(cols)])
    rows = rows.select("__rep", "__y", F.explode(variants).alias("__v")).select("__rep", "__y", "__v.*")
    scored = predict(prep, model, rows, keep=["__rep", "feature", "__y"]).where(F.col("__y").isNotNull())
    error = F.col("__y") - F.col("prediction")
    r2 = F.lit(1.0) - ratio(F.sum(error * error), F.count(F.lit(1)) * F.var_pop("__y"))
    per = scored.groupBy("feature", "__rep").agg(r2.alias("__r2"))
    base = regression_metrics(predict(prep, model, keyed, keep=["__y"]).withColumnRenamed("__y", "y_true")).select("R2")
    drop = with_scalars(per, base).select("feature", (F.col("R2") - F.col("__r2")).alias("drop"))
    return drop.groupBy("feature").agg(F.avg("drop").alias("importance_mean"), F.stddev_pop("drop").alias("importance_std")) \
        .orderBy(F.desc("importance_mean"), "feature")


def lasso_certificate(df: DataFrame, cols: Sequence[str], target: str, coefficients: Sequence[float],
                      intercept: float, alpha: float) -> DataFrame:
    """``feature, coefficient, gradient, slack`` of the lasso objective
    ``1/(2n) |y - b - Xw|^2 + alpha |w|_1``: a solution is optimal exactly if
    every gradient is ``-alpha * sign(w)`` where ``w`` is not 0 and within
    ``[-alpha, alpha]`` where it is; ``slack`` is how far it is from that.  One
    aggregate over the rows (those without nulls)."""
    known = df.select(*cols, target).na.drop()
    fit_ = sum((F.lit(float(w)) * F.col(c) for c, w in zip(cols, coefficients)), F.lit(float(intercept)))
    means = known.agg(*[F.avg((fit_ - F.col(target)) * F.col(c)).alias(f"__g{i}") for i, c in enumerate(cols)])
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), F.lit(float(w)).alias("coefficient"), F.col(f"__g{i}").alias("gradient"))
                     for i, (c, w) in enumerate(zip(cols, coefficients))])
    g, w = F.col("gradient"), F.col("coefficient")
    slack = F.when(w == 0, F.greatest(F.abs(g) - alpha, F.lit(0.0))).otherwise(F.abs(g + alpha * F.signum(w)))
    return means.select(F.explode(rows).alias("r")).select("r.*").withColumn("slack", slack)


# ----------------------------------------------------------- persist / score

def save_model(prep: PreprocessModel, model: PipelineModel, path: str, target: str,
               input_columns: Sequence[str]) -> str:
    """PipelineModel plus a JSON side file (preprocessing and feature list) and
    the level tables of wide categoricals, all under ``path``."""
    model.write().overwrite().save(os.path.join(path, "pipeline"))
    spark = SparkSession.getActiveSession()
    stored = {}
    for i, (c, w) in enumerate(prep.wide.items()):
        stored[c] = {"path": f"levels-{i}", "n": w["n"]}
        spark.read.parquet(w["path"]).write.mode("overwrite").parquet(os.path.join(path, f"levels-{i}"))
    prep = replace(prep, wide=stored)
    meta = {"target": target, "feature_names_in": list(input_columns),
            "preprocess": json.loads(prep.to_json())}
    spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1) \
        .write.mode("overwrite").text(os.path.join(path, "meta"))
    return path


def load_model(spark: SparkSession, path: str) -> tuple[PreprocessModel, PipelineModel, dict]:
    meta = json.loads(spark.read.text(os.path.join(path, "meta")).first()[0])
    prep = PreprocessModel(**meta["preprocess"])
    prep.wide = {c: {**w, "path": os.path.join(path, w["path"])} for c, w in prep.wide.items()}
    return prep, PipelineModel.load(os.path.join(path, "pipeline")), meta


def align_with_model_features(df: DataFrame, feature_names: Sequence[str], target: str | None
                              ) -> tuple[DataFrame, list[str]]:
    """The declared input schema as one projection of the scoring frame.

    Returns the frame with exactly ``feature_names`` (and the target, if it is
    there) and the names of the columns left out.  A robust column that the
    frame lacks is derived, ``date_key`` defaults to 0, and any other missing
    feature is an error.
    """
    from plantwise.operators.cleaning import cast_scoring_keys
    from plantwise.operators.features import add_robust_features, add_robust_if_missing
    full = cast_scoring_keys(add_robust_if_missing(add_robust_features(df)))
    source = {c: F.col(c) for c in full.columns}
    declared = {c: source.get(c, F.lit(0) if c == "date_key" else None)
                for c in feature_names if c != target}
    absent = [c for c, v in declared.items() if v is None]
    if absent:
        raise ValueError(f"missing model features: {absent}")
    if target in source:
        declared[target] = source[target]
    return (full.select(*[v.alias(c) for c, v in declared.items()]),
            [c for c in source if c not in declared and c != target])


def score(prep: PreprocessModel, model: PipelineModel, df: DataFrame,
          keep: Sequence[str] | None = None) -> DataFrame:
    """Predictions beside the input columns; class probabilities become
    ``proba_<i>`` when the model yields them."""
    keep = list(keep or df.columns)
    out = predict(prep, model, df, keep=keep)
    if "probability" in out.columns:
        arr = vector_to_array(F.col("probability"))
        n = model.stages[-1].numClasses
        out = out.select("*", *[arr[i].alias(f"proba_{i}") for i in range(n)]).drop("probability")
    return out.drop(FEATURES, "rawPrediction")
