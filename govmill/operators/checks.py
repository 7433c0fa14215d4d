"""Small check frames over finished tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from govmill.functions.columns import clean, normalise_id


def breakdown_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column)


def missing_counts(df: DataFrame, column: str, name: str) -> DataFrame:
    return df.agg(F.count_if(clean(F.col(column)).isNull()).alias(name))


def distinct_products(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("rows"), F.countDistinct("DataProductId").alias("products"),
                  F.countDistinct("OwnerObjectId").alias("owners"))


def coverage_check(base: DataFrame, scorecards: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Per scorecard: rows, products, base products it lacks, products the base does not know.

    ``scorecards`` maps a name to a frame and its id column. All are stacked and counted together.
    """
    ids = base.select("DataProductId").distinct()
    cards = reduce(DataFrame.unionByName, (
        df.select(F.lit(name).alias("scorecard"), normalise_id(F.col(key)).alias("DataProductId"))
        for name, (df, key) in scorecards.items()))
    rows = cards.groupBy("scorecard", "DataProductId").agg(F.count("*").alias("n"))
    asked = ids.select(F.explode(F.array(*(F.lit(n) for n in scorecards))).alias("scorecard"), "DataProductId",
                       F.lit(1).alias("known"))
    return rows.join(asked, ["scorecard", "DataProductId"], "full").groupBy("scorecard").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count("n").alias("products"),
        F.count_if(F.col("n").isNull()).alias("missing"), F.count_if(F.col("known").isNull()).alias("unknown"))
