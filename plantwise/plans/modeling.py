"""Feature table -> temporal split -> preprocessing -> models -> leaderboard.

The heavy lifting (statistics, fitting, scoring, metrics) runs on Spark; the
driver only loops over a handful of model definitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantwise.operators import cleaning as C
from plantwise.operators import features as W
from plantwise.operators import ml as M

TARGET = "cost_per_unit_imp"
# lag/rolling columns that must be present for a training row.
REQUIRED_HISTORY = [
    "cost_per_unit_imp_lag1", "cost_per_unit_imp_roll3",
    "kwh_per_unit_imp_lag1", "kwh_per_unit_imp_roll3",
    "fx_effect_ratio_imp_lag1", "fx_effect_ratio_imp_roll3",
]


def training_frame(features: DataFrame) -> DataFrame:
    """Rows with full history, duplicate names removed."""
    return C.drop_null_rows(C.dedupe_column_names(features), REQUIRED_HISTORY)


def split(df: DataFrame, date_col: str = "date_key", frac: float = 0.8
          ) -> tuple[DataFrame, DataFrame]:
    s = W.temporal_split(df, date_col, frac)
    return (s.where(F.col("split") == "train").drop("split", "row_rank"),
            s.where(F.col("split") == "test").drop("split", "row_rank"))


def feature_columns(df: DataFrame, target: str = TARGET) -> tuple[list[str], list[str]]:
    x = C.drop_by_suffix(df.drop(target))
    return C.split_columns_by_type(x, target, None)


def run(features: DataFrame, target: str = TARGET, rf_trees: int = 600,
        scaler: str = "robust") -> tuple[DataFrame, dict, M.PreprocessModel]:
    """Leaderboard of the four regressors on an 80/20 temporal split."""
    df = training_frame(features)
    train, test = split(df)
    num, cat = feature_columns(df, target)
    prep = M.fit_preprocess(train, num, cat, scaler=scaler)
    st = train.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop(target).alias("s")).first()
    models = M.regressors(st["n"], st["s"], rf_trees=rf_trees)
    board, fitted = M.leaderboard(prep, train, test, target, models)
    return board, fitted, prep


def best_model(board: DataFrame) -> str | None:
    r = board.where(F.col("RMSE").isNotNull()).orderBy("RMSE").limit(1).collect()
    return r[0]["model"] if r else None


def choose(board: DataFrame, tuned: tuple[str, float] | None = None) -> str | None:
    """Name of the model with the least RMSE among the leaderboard and a tuned
    one (``(name, RMSE on the same test rows)``); ties go to the tuned model."""
    best = board.where(F.col("RMSE").isNotNull()).orderBy("RMSE").select("model", "RMSE").first()
    if tuned is not None and (best is None or tuned[1] <= best["RMSE"]):
        return tuned[0]
    return best["model"] if best else None


def export_splits(train: DataFrame, test: DataFrame, out_dir: str) -> dict[str, str]:
    """Write the train and test frames as parquet (``train`` / ``test``)."""
    import os
    paths = {"train": os.path.join(out_dir, "train"), "test": os.path.join(out_dir, "test")}
    train.write.mode("overwrite").parquet(paths["train"])
    test.write.mode("overwrite").parquet(paths["test"])
    return paths
