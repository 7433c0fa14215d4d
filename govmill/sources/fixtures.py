"""Catalog, rule, evidence and history frames derived from the driver tables.

The SQL in ``fixtures.sql`` runs unchanged in Spark and in the checking engine, so both sides of a
check start from the same rows. Cloud resources get the shape evidence really has: a tag map and a
JSON property bag.
"""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from govmill.session import spread
from govmill.sources.sqlviews import load_views, with_clause

FIXTURES_SQL = str(Path(__file__).with_name("fixtures.sql"))
DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


_schemas: dict[tuple[str, str], T.StructType] = {}


def driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; its schema is read once per folder, the frame belongs to the session that asks."""
    path = f"{sf_dir}/{name}.parquet"
    if (sf_dir, name) not in _schemas:
        _schemas[sf_dir, name] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[sf_dir, name]).parquet(path)


def fixture(spark: SparkSession, sf_dir: str, name: str, dealt: bool = False) -> DataFrame:
    """One derived frame, or a driver table, read from ``sf_dir``; ``dealt`` spreads the tables it is derived from, their used columns only."""
    if name in DRIVER_TABLES:
        return driver_table(spark, sf_dir, name)
    sql = with_clause(f"SELECT * FROM {name}", load_views(FIXTURES_SQL)).replace("{", "{{").replace("}", "}}")
    used = [t for t in DRIVER_TABLES if re.search(rf"\b(FROM|JOIN) {t}\b", sql)]
    sql = re.sub(rf"\b(FROM|JOIN) ({'|'.join(DRIVER_TABLES)})\b", r"\1 {\2}", sql)
    tables = {t: driver_table(spark, sf_dir, t) for t in used}
    return spark.sql(sql, **({t: spread(df) for t, df in tables.items()} if dealt else tables))


def resources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cloud resources: ids, type, place, ``Tags`` map and ``Properties`` JSON. Keys are dealt out before texts are made and taken apart."""
    r = fixture(spark, sf_dir, "g_resource", dealt=True)
    tags = F.create_map(
        F.lit("dataproductid"), "tag_pid_a",
        F.lit("DataProductID"), "tag_pid_b",
        F.lit("DataProductId"), "tag_pid_c",
        F.lit("resource-origin"), "tag_origin",
        F.lit("sovereignty-zone"), "tag_zone",
    )
    properties = F.to_json(F.struct(
        F.struct(F.col("vm_size").alias("vmSize")).alias("hardwareProfile"),
        F.struct(F.col("security_type").alias("securityType")).alias("securityProfile"),
        F.struct(F.col("arc_model").alias("model")).alias("detectedProperties"),
        F.col("linked_vm_id").alias("virtualMachineResourceId"),
    ))
    return r.select(
        "rk", "ResourceId", "ResourceType", "SubscriptionId", "ResourceGroup", "Location",
        F.map_filter(tags, lambda _, v: v.isNotNull()).alias("Tags"),
        properties.alias("Properties"),
        F.col("identity_type").alias("IdentityType"),
    )
