"""Schema checks and alignment on DataFrames; none of them touches rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T


def resolve_columns(df: DataFrame, candidates: Sequence[str]) -> str:
    """First candidate the frame has."""
    for name in candidates:
        if name in df.columns:
            return name
    raise ValueError(f"none of {list(candidates)} in columns {df.columns}")


def conform_to_schema(df: DataFrame, target: T.StructType) -> DataFrame:
    """Columns matched without regard to case, cast, ordered as the target; missing ones become null."""
    have = {c.lower(): c for c in df.columns}

    def take(field: T.StructField):
        source = have.get(field.name.lower())
        value = F.lit(None) if source is None else F.col(f"`{source}`")
        return value.cast(field.dataType).alias(field.name)

    return df.select(*(take(f) for f in target.fields))


def assert_exact_columns(df: DataFrame, expected: Sequence[str], label: str = "frame") -> DataFrame:
    if df.columns != list(expected):
        raise ValueError(f"{label}: expected columns {list(expected)}, got {df.columns}")
    return df


def schema_diff(df: DataFrame, target: T.StructType) -> DataFrame:
    """Differences by column name: other type, only in the frame, only in the table."""
    spark = df.sparkSession
    fields = "name string, {0} string, {0}_type string"

    def listing(schema: T.StructType, side: str) -> DataFrame:
        rows = [(f.name.lower(), f.name, f.dataType.simpleString()) for f in schema.fields]
        return spark.createDataFrame(rows, fields.format(side))

    both = listing(df.schema, "frame").join(listing(target, "table"), "name", "full")
    issue = (F.when(F.col("table").isNull(), "ONLY IN DF").when(F.col("frame").isNull(), "ONLY IN TABLE")
             .when(F.col("frame_type") != F.col("table_type"), "TYPE MISMATCH"))
    return both.withColumn("issue", issue).filter("issue IS NOT NULL").select(
        F.coalesce("frame", "table").alias("column"), "issue", "frame_type", "table_type")


def schema_diff_counts(df: DataFrame, target: T.StructType) -> DataFrame:
    """:func:`schema_diff` with ``filled``, the values of the frame that a difference concerns; null for columns it lacks.

    One pass over the frame counts all of its columns that differ.
    """
    wanted = {f.name.lower(): f.dataType.simpleString() for f in target.fields}
    odd = [f.name for f in df.schema.fields if wanted.get(f.name.lower()) != f.dataType.simpleString()]
    issues = schema_diff(df, target)
    if not odd:
        return issues.withColumn("filled", F.lit(None).cast("bigint"))
    counts = df.agg(*(F.count(f"`{c}`").alias(c) for c in odd)).select(F.inline(F.array(*(
        F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("filled")) for c in odd))))
    return issues.join(counts, "column", "left")


def typed_rows(spark, rows: Sequence[dict], schema: T.StructType) -> DataFrame:
    """Evidence records as a frame whose columns have their types even when there is no record."""
    return spark.createDataFrame([tuple(r.get(n) for n in schema.names) for r in rows], schema)
