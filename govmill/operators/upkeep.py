"""Derived tables kept up to date from the newest rows alone, instead of from all history.

Deltas need one row per key from before: the last one, kept beside them. Rollups of a snapshot are a function of the history's day
partition, so only the days that new rows fall into are built anew. A run that is started again replaces its own
output and nothing else.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from govmill.operators.timeseries import previous_row, tie


class LateRows(ValueError):
    """Rows that are not newer than what was worked on before."""


def extend_deltas(new: DataFrame, keys: Sequence[str], time: str, values: Sequence[str], *, folder: str, run: int) -> DataFrame:
    """``new`` with the ``Prev`` columns that :func:`previous_row` gives it over the whole history.

    Reads the new rows and the last row of every key as run ``run - 1`` left it, and leaves the last rows for the next run. Rows have a time
    and are newer than the last row of their key; otherwise the run fails before it writes anything, for a late row would also
    change the row after it, which an earlier run gave out (the alert stream judges such rows again). Rows with one key and time
    come in one run and stand in the order that they have over the whole history.
    """
    spark = new.sparkSession
    held = list(dict.fromkeys([*keys, time, *values]))
    kept = T.StructType([new.schema[c] for c in held])
    last = spark.createDataFrame([], kept) if run == 0 else spark.read.schema(kept).parquet(f"{folder}/last/run={run - 1}")
    ends = last.select(*(F.col(k).alias(f"_last_{k}") for k in keys), F.col(time).alias("_at"))
    same = reduce(Column.__and__, (F.col(k).eqNullSafe(F.col(f"_last_{k}")) for k in keys), F.lit(True))
    # With no keys there is one last row at most.
    late = new.join(ends if keys else F.broadcast(ends), same, "left").filter(F.col(time).isNull() | (F.col(time) <= F.col("_at")))
    if late.limit(1).count():
        raise LateRows(f"run {run} has rows without time, or not newer than the last row of their key")
    # The order among equal times is that of the rows alone; a last row has no equal, since no new row is as old.
    marked = new.withColumns({"_new": F.lit(True), "_tie": tie(new)}).unionByName(last.withColumn("_new", F.lit(False)), allowMissingColumns=True)
    fresh = previous_row(marked, keys, time, values).filter("_new").drop("_new", "_tie")
    fresh.write.mode("overwrite").parquet(f"{folder}/deltas/run={run}")
    newest = marked.groupBy(*keys).agg(F.max_by(F.struct(*held), F.struct(time, "_tie")).alias("_r")).filter("_r IS NOT NULL").select("_r.*")
    newest.write.mode("overwrite").parquet(f"{folder}/last/run={run}")
    return spark.read.schema(fresh.schema).parquet(f"{folder}/deltas/run={run}")


def append_days(new: DataFrame, history_path: str, time: str, day: str, run: int) -> list:
    """Add rows to a history in folders per day and run; gives the days they fall into."""
    dated = new.withColumn(day, F.col(time).cast("date")).withColumn("run", F.lit(run))
    dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day, "run").parquet(history_path)
    return sorted((r[0] for r in dated.select(day).distinct().collect()), key=str)


def refresh_days(history: DataFrame, days: Sequence, day: str, build: Callable[[DataFrame], DataFrame], time: str, path: str) -> None:
    """Replace the given days of a derived table by what ``build`` makes of these days of the history.

    Other days are neither read nor written. ``build`` groups by a time whose day is ``day``; ``time`` is its name in the result.
    """
    told = [d for d in days if d is not None]
    picked = F.col(day).isin(told) if len(told) == len(days) else F.col(day).isin(told) | F.col(day).isNull()
    built = build(history.filter(picked).drop(day, "run")).withColumn(day, F.col(time).cast("date"))
    built.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)


def read_days(spark: SparkSession, path: str, day: str) -> DataFrame:
    return spark.read.parquet(path).drop(day, "run")
