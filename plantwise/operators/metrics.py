"""Regression metrics and the tables behind evaluation charts (one pass)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantwise.functions.safe import ratio


def regression_metrics(df: DataFrame, y: str = "y_true", p: str = "prediction") -> DataFrame:
    """MAE, MSE, RMSE, R2 and MAPE (%, null when any y_true is 0), one row.
    Rows with a null target or prediction are left out."""
    d = df.where(F.col(y).isNotNull() & F.col(p).isNotNull())
    e = F.col(y) - F.col(p)
    row = d.agg(F.count(F.lit(1)).alias("n"), F.avg(F.abs(e)).alias("MAE"),
                F.avg(e * e).alias("MSE"), F.sum(e * e).alias("__sse"),
                F.var_pop(y).alias("__var"), F.count_if(F.col(y) == 0).alias("__zeros"),
                F.avg(F.abs(ratio(e, F.col(y)))).alias("__mape"))
    return row.select(
        "n", "MAE", "MSE", F.sqrt("MSE").alias("RMSE"),
        F.when(F.col("__zeros") == 0, F.col("__mape") * 100).alias("MAPE"),
        (F.lit(1.0) - ratio(F.col("__sse"), F.col("n") * F.col("__var"))).alias("R2"))


def mape_masked(df: DataFrame, y: str = "y_true", p: str = "prediction",
                eps: float = 1e-8) -> DataFrame:
    """MAPE over rows with |y| > eps, eps added to the denominator, in %."""
    m = F.abs(F.col(y)) > eps
    return df.agg((F.avg(F.when(m, F.abs((F.col(y) - F.col(p)) / (F.col(y) + F.lit(eps)))))
                   * 100).alias("MAPE"))


def with_residual(df: DataFrame, y: str = "y_true", p: str = "prediction",
                  name: str = "residual") -> DataFrame:
    return df.withColumn(name, F.col(y) - F.col(p))


def joint_limits(df: DataFrame, y: str = "y_true", p: str = "prediction") -> DataFrame:
    """Common axis limits of actual and predicted values."""
    return df.agg(F.least(F.min(y), F.min(p)).alias("lo"), F.greatest(F.max(y), F.max(p)).alias("hi"))
