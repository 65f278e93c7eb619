"""Tables and views: append, keyed upsert, KPI materialisation, reads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantwise.functions.materialize import materialize


def register_views(frames: dict[str, DataFrame]) -> None:
    for name, df in frames.items():
        df.createOrReplaceTempView(name)


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def append_positional(spark: SparkSession, df: DataFrame, table: str) -> str:
    """Create the table from the frame's schema if missing, then append by
    position (no de-duplication: a rerun appends the rows again)."""
    if not table_exists(spark, table):
        df.limit(0).write.saveAsTable(table)
    df.write.insertInto(table)
    return f"Inserted into {table}"


def keyed_upsert(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``old`` whose key is not in ``new``, plus all of ``new``
    (INSERT OR REPLACE semantics, null keys compared null-safely)."""
    keys = list(keys)
    cond = [old[k].eqNullSafe(new[k]) for k in keys]
    kept = old.join(new.select(*keys), cond, "left_anti")
    return kept.unionByName(new, allowMissingColumns=True)


def upsert_table(spark: SparkSession, table: str, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keyed upsert into a saved table.  The merged result is checkpointed
    first, so the overwrite never reads the table it replaces."""
    if not table_exists(spark, table):
        new.write.saveAsTable(table)
        return spark.table(table)
    merged = materialize(keyed_upsert(spark.table(table), new, keys))
    merged.write.mode("overwrite").saveAsTable(table)
    return spark.table(table)


def create_database(spark: SparkSession, name: str, location: str | None = None) -> str:
    """The database, made where it is missing; its tables lie under ``location``
    instead of the warehouse when one is given."""
    at = " LOCATION '" + location.replace("\\", "\\\\").replace("'", "\\'") + "'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{at}")
    return name


def materialize_tables(spark: SparkSession, frames: dict[str, DataFrame],
                       database: str = "analytics", location: str | None = None) -> list[str]:
    """``CREATE OR REPLACE TABLE <database>.<name> AS ...`` for each frame."""
    create_database(spark, database, location)
    out = []
    for name, df in frames.items():
        df.write.mode("overwrite").saveAsTable(f"{database}.{name}")
        out.append(f"{database}.{name}")
    return out


def read_ordered(spark: SparkSession, table: str, order: Sequence[str],
                 site: str | None = None) -> DataFrame:
    df = spark.table(table)
    if site is not None:
        df = df.where(F.col("site_code") == site)
    return df.orderBy(*order)
