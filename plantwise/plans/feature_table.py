"""KPI table -> consolidated feature table (the EDA chain as one lineage).

kpis -> three-way outer merge -> hierarchical imputation -> lags / rolling
means per site -> drop rows without target -> outlier flags per (site, m)
-> winsorised FX per site -> robust scaling per site -> parquet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantwise.functions.materialize import materialize, materialize_all
from plantwise.operators import features as W
from plantwise.operators import kpi as K
from plantwise.operators.star import Star

TARGET = "cost_per_unit_imp"
# Model inputs of the feature table.
BASE_FEATURES = [
    "kwh_per_unit_imp", "fx_effect_ratio_imp",
    "cost_per_unit_imp_lag1", "kwh_per_unit_imp_lag1", "fx_effect_ratio_imp_lag1",
    "cost_per_unit_imp_roll3", "kwh_per_unit_imp_roll3", "fx_effect_ratio_imp_roll3",
    "m", "site_code",
]
# Helper columns dropped once the features exist.
DROP_AFTER_FEATURES = [
    "cost_per_unit", "date_cost", "month_start_cost",
    "kwh_per_unit", "date_energy", "month_start_energy",
    "fx_effect_ratio", "date", "month_start",
]
LAG_ROLL_COLS = W.IMP_COLS
OUTLIER_KEYS = ["site_code", "m"]


def kpi_frames(star: Star, shared: bool = True, keys: dict[str, DataFrame] | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Cost, energy and FX KPIs.  ``shared``: each fact is aggregated once per
    (date, site) into a small table (materialised, the three jobs run
    concurrently) and all KPIs are derived from those.  ``keys``: these tables,
    where they are there already."""
    if not shared:
        return (K.kpi_cost_per_unit(star.fact_costs, star.fact_manufacturing, star.calendar()),
                K.kpi_energy_per_unit(star.fact_energy, star.fact_manufacturing, star.calendar()),
                K.kpi_fx_effect(star.fact_costs))
    keys = keys or materialize_all(K.key_sums(star.fact_costs, star.fact_manufacturing, star.fact_energy))
    return K.kpis_from_key_sums(keys, star.calendar())


def consolidated(star: Star, materialized: bool = False) -> DataFrame:
    df = W.consolidate_kpis(*kpi_frames(star))
    return materialize(df) if materialized else df


def imputed(star: Star, method: str = "exact") -> DataFrame:
    return W.impute_hierarchical(consolidated(star, materialized=True), method=method)


def with_lags(df: DataFrame) -> DataFrame:
    for c in LAG_ROLL_COLS:
        df = W.add_lag_roll(df, c)
    return df


def model_frame(star: Star, method: str = "exact") -> DataFrame:
    """Rows with a target and a month, helper columns dropped."""
    df = with_lags(imputed(star, method))
    return materialize(df.na.drop(subset=[TARGET, "m"]).drop(*DROP_AFTER_FEATURES))


def flagged(model_df: DataFrame) -> DataFrame:
    return W.flag_outliers_many(model_df, W.IMP_COLS, by=OUTLIER_KEYS)


def treated(model_df: DataFrame, method: str = "exact") -> DataFrame:
    """Outlier flags, winsorised FX by site and IQR-robust KPIs by site."""
    df = W.winsorize_by_group(flagged(model_df), "fx_effect_ratio_imp", ["site_code"],
                              method=method)
    return W.add_robust_scaled_many(df, W.IMP_COLS, ["site_code"], method=method)


def outlier_reports(model_df: DataFrame) -> tuple[DataFrame, DataFrame]:
    long = W.outliers_long(flagged(model_df), W.IMP_COLS)
    return W.outlier_report_counts(long), long


def build_feature_table(star: Star, out_dir: str | None = None, method: str = "exact"
                        ) -> DataFrame:
    """The treated feature table; written as parquet when ``out_dir`` is given
    (the write also cuts the lineage for the modelling steps)."""
    df = treated(model_frame(star, method), method)
    if out_dir:
        df.write.mode("overwrite").parquet(out_dir)
        return df.sparkSession.read.parquet(out_dir)
    return df


def select_features(df: DataFrame) -> DataFrame:
    return df.select(*BASE_FEATURES, TARGET)


def date_from_key(df: DataFrame, col: str = "date_key", out: str = "date") -> DataFrame:
    return df.withColumn(out, F.try_to_timestamp(F.col(col).cast("string"),
                                                 F.lit("yyyyMMdd")).cast("date"))
