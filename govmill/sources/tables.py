"""Readers and writers of catalog tables: loads, current, history and snapshot tables.

``TABLE_FORMAT`` is the one place that names the storage format. Parquet needs nothing extra; where
Delta is installed, set it to ``delta``.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from govmill.functions.schemas import conform_to_schema
from govmill.operators.keyed import first_per_key

TABLE_FORMAT = "parquet"


def write_current(df: DataFrame, table: str) -> None:
    """Replace a table; its schema may change."""
    df.write.format(TABLE_FORMAT).mode("overwrite").option("overwriteSchema", "true").saveAsTable(table)


def append_rows(df: DataFrame, table: str) -> None:
    """Append, aligned with the table's columns and types; creates the table when it is not there."""
    spark = df.sparkSession
    if spark.catalog.tableExists(table):
        df = conform_to_schema(df, spark.table(table).schema)
    df.write.format(TABLE_FORMAT).mode("append").saveAsTable(table)


def ingest(spark: SparkSession, base: str, folders: dict[str, str], source_format: str = "parquet") -> DataFrame:
    """Load export folders into tables, replacing them; gives the rows loaded per table.

    Folders that hold a Delta log must be read with ``source_format='delta'``, since a plain read
    would also see replaced files. Rows are counted while they are written, not in a second pass.
    """
    loaded = []
    for folder, table in folders.items():
        seen = Observation()
        df = spark.read.format(source_format).load(f"{base}/{folder}")
        write_current(df.observe(seen, F.count(F.lit(1)).alias("rows")), table)
        loaded.append((table, seen.get["rows"]))
    return spark.createDataFrame(loaded, "table string, rows_loaded bigint")


def create_then_overwrite(df: DataFrame, table: str, schema: T.StructType) -> None:
    """Create a typed table once, then replace its rows and never its definition."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        spark.catalog.createTable(table, schema=schema, source=TABLE_FORMAT)
    conform_to_schema(df, schema).write.insertInto(table, overwrite=True)


def ctas_replace(df: DataFrame, table: str) -> None:
    """Replace a table by a query's rows and columns.

    The rows are written under a new name first, so a query that fails leaves the old table whole, and a
    query may read the table that it replaces. Between the drop and the renaming there is a moment without table: readers must
    expect that, and a driver lost in it leaves the rows under the new name.
    """
    spark, new = df.sparkSession, f"{table}_{uuid.uuid4().hex[:12]}"
    try:
        df.write.format(TABLE_FORMAT).saveAsTable(new)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {new}")
        raise
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"ALTER TABLE {new} RENAME TO {table}")


def stamped(df: DataFrame, run_ts: str, time: str) -> DataFrame:
    """Rows with the date and time of the run in front. One time for the whole run."""
    at = F.lit(run_ts).cast("timestamp")
    return df.select(at.cast("date").alias("SnapshotDate"), at.alias(time), *df.columns)


def append_snapshot(df: DataFrame, table: str, run_ts: str, time: str) -> None:
    append_rows(stamped(df, run_ts, time), table)


def new_rows(current: DataFrame, history: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows whose key the history does not have; nulls equal nulls."""
    known = history.select(*(F.col(k).alias(f"_known_{k}") for k in key)).distinct()
    on = reduce(Column.__and__, (F.col(k).eqNullSafe(F.col(f"_known_{k}")) for k in key))
    return current.join(known, on, "left_anti")


def merge_insert_only(current: DataFrame, table: str, key: Sequence[str]) -> None:
    """Append rows with a new key, so a second run adds nothing; of several rows with one key the first in column order."""
    spark = current.sparkSession
    if spark.catalog.tableExists(table):
        current = new_rows(current, spark.table(table), key)
    order = [f.name for f in current.schema.fields if "map<" not in f.dataType.simpleString()]
    append_rows(first_per_key(current, key, order), table)


def write_current_and_history(current: DataFrame, current_table: str, history_table: str,
                              history: DataFrame | None = None, replace_if_lacking: str | None = None) -> None:
    """Replace the current table and append to its history.

    Without ``history`` the current rows are the history rows. A history table that lacks the column
    ``replace_if_lacking`` has an old layout and is replaced once.
    """
    history = current if history is None else history
    spark = current.sparkSession
    write_current(current, current_table)
    outdated = (replace_if_lacking is not None and spark.catalog.tableExists(history_table)
                and replace_if_lacking not in spark.table(history_table).columns)
    (write_current if outdated else append_rows)(history, history_table)


def optional_table(spark: SparkSession, table: str, schema: T.StructType) -> DataFrame:
    """The table if it is there, otherwise no rows with its columns."""
    return spark.table(table) if spark.catalog.tableExists(table) else spark.createDataFrame([], schema)


def snapshot_single_row(asset: DataFrame, run_ts: str, approximate: Column | None = None) -> DataFrame:
    """The catalog total at the time of the run, one row."""
    return asset.agg(F.count("*").alias("TotalAssets")).select(
        F.lit(run_ts).cast("timestamp").alias("SnapshotUtc"), "TotalAssets",
        (F.lit(False) if approximate is None else approximate).alias("IsApproximate"))
