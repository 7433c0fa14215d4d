"""One row per key, bounded samples per key, and rows at the newest snapshot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

# Spark's own limit for cutting ranked rows before the shuffle.
GROUP_LIMIT = 1000
SALTS = 64


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Keep one row per key, the first in a total order, so every run keeps the same row.

    Spark keeps one row per key in each map task before the shuffle (a window group limit), so a
    key that holds most rows does not reach one task whole.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")


def sample_per_key(df: DataFrame, key: str, order: Sequence[Column | str], fields: Sequence[str],
                   size: int, name: str) -> DataFrame:
    """The first ``size`` rows of each key in order, as one small array of structs.

    Small sizes are cut in each map task by Spark itself. Larger ones are first cut in salted parts
    of the key, which keeps every row that can be among the first ``size``.
    """
    if size > GROUP_LIMIT:
        part = Window.partitionBy(key, "_salt").orderBy(*order)
        df = (df.withColumn("_salt", F.pmod(F.hash(*order), F.lit(SALTS)))
              .withColumn("_rank", F.row_number().over(part)).filter(F.col("_rank") <= size).drop("_salt"))
    w = Window.partitionBy(key).orderBy(*order)
    kept = df.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= size)
    items = F.array_sort(F.collect_list(F.struct("_rank", *fields)))
    return kept.groupBy(key).agg(
        F.transform(items, lambda i: F.struct(*(i[f].alias(f) for f in fields))).alias(name))


def latest_snapshot_rows(df: DataFrame, time: str) -> DataFrame:
    """Rows at the newest snapshot time. The maximum is a scalar subquery, not a join."""
    return df.filter(F.col(time) == df.select(F.max(time)).scalar())


def semi_join_ids(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return df.join(ids.select(key).distinct(), key, "left_semi")
