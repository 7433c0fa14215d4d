"""Dashboard measures. Each takes frames already filtered by the caller and gives one row.

A measure that ignores the caller's filter takes the whole frame as a second input. Blank is null,
division by zero is null, and distinct counts count null as one value.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from govmill.functions import fixed_values as V
from govmill.functions.columns import ladder, normalise_id
from govmill.operators.keyed import latest_snapshot_rows


def _distinct(c: Column) -> Column:
    """Distinct values, null counted as one."""
    return F.countDistinct(c) + F.coalesce(F.max(c.isNull().cast("int")), F.lit(0))


def side_by_side(*rows: DataFrame) -> DataFrame:
    """One-row frames as one row: stacked with nulls and merged, so nothing is cross joined."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
    return stacked.agg(*(F.max(c).alias(c) for c in stacked.columns))


def measures_products(products: DataFrame, all_products: DataFrame, assets: DataFrame) -> DataFrame:
    """M1-M7: products, coverage, assets. An empty region counts as present here."""
    pid = F.col("DataProductID")
    placed = F.when(F.col("ResidencyRegion").isNotNull(), pid)
    counts = products.agg(_distinct(pid).alias("m01_total_products"), F.countDistinct(placed).alias("m02_with_residency"))
    unplaced = all_products.filter("ResidencyRegion IS NULL").select(F.col("DataProductDisplayName").alias("DataProductName"))
    total = assets.agg(F.sum("TotalAssets").alias("m05_total_assets"))
    missing = assets.join(unplaced, "DataProductName", "left_semi").agg(F.sum("TotalAssets").alias("m06_assets_missing_residency"))
    m = side_by_side(counts, total, missing)
    return m.withColumns({
        "m03_residency_coverage": F.try_divide(F.col("m02_with_residency").cast("double"), F.col("m01_total_products")),
        "m04_missing_residency": F.col("m01_total_products") - F.col("m02_with_residency"),
        "m07_missing_assets_share": F.try_divide(F.col("m06_assets_missing_residency").cast("double"), F.col("m05_total_assets")),
    }).select(*sorted(("m01_total_products m02_with_residency m03_residency_coverage m04_missing_residency m05_total_assets "
                       "m06_assets_missing_residency m07_missing_assets_share").split()))


def product_flags(products: DataFrame, classification: DataFrame, inventory: DataFrame) -> DataFrame:
    """M8-M10 per product: sensitive, on confidential compute, both."""
    def flag(df: DataFrame, value: str, name: str) -> DataFrame:
        return df.groupBy(normalise_id(F.col("DataProductId")).alias("DataProductId")).agg(F.max(value).alias(name))

    ids = products.select(normalise_id(F.col("DataProductID")).alias("DataProductId"), "DataProductDisplayName").distinct()
    return (ids.join(flag(classification, "HasFullNameClassification", "m08_has_full_name"), "DataProductId", "left")
            .join(flag(inventory, "IsConfidential", "m09_has_confidential_compute"), "DataProductId", "left")
            .fillna(0, ["m08_has_full_name", "m09_has_confidential_compute"])
            .withColumn("m10_both", F.when((F.col("m08_has_full_name") == 1) & (F.col("m09_has_confidential_compute") == 1), 1).otherwise(0)))


def measures_pii(products: DataFrame, classification: DataFrame, inventory: DataFrame, no_compute: DataFrame,
                 not_confidential: DataFrame) -> DataFrame:
    """M8-M10 over all products, and M23-M26."""
    flags = product_flags(products, classification, inventory)
    return side_by_side(
        flags.agg(*(F.coalesce(F.max(c), F.lit(0)).alias(c) for c in ("m08_has_full_name", "m09_has_confidential_compute")),
                  F.sum("m10_both").alias("m10_products_both")),
        no_compute.agg(F.countDistinct("DataProductId").alias("m23_no_compute")),
        not_confidential.agg(F.countDistinct("DataProductId").alias("m24_not_confidential"),
                             F.sum("ComputeVmCount").alias("m25_vms_not_confidential")),
        classification.agg(F.countDistinct(F.when(F.col("HasFullNameClassification") == 1, F.col("DataProductId"))).alias("m26_full_name")))


def _patch_mean() -> Column:
    clear = F.coalesce("PendingUpdatesTotal", F.lit(0)) == 0
    return F.avg(F.when(clear, 100.0).otherwise(0.0)).alias("m19_avg_patch_score")


def measure_patch(cc: DataFrame) -> DataFrame:
    """M19: 100 where nothing is pending, otherwise 0. Not the scorecard's patch rule."""
    return cc.agg(_patch_mean())


def measures_cc(cc: DataFrame, queue: DataFrame) -> DataFrame:
    """M11-M18, M20, M21."""
    score, applicable = F.col("CCForPIIScore"), F.col("CCForPIIStatus") == "Applicable"
    at = {"m13_score_100": 100, "m14_score_25": 25, "m15_score_50": 50, "m16_score_75": 75, "m17_score_0": 0}
    return side_by_side(
        cc.agg(F.count_if(applicable).alias("m11_applicable"), F.avg(F.when(applicable, score)).alias("m12_overall_score"),
               *(F.count_if(score == s).alias(n) for n, s in at.items()), F.avg(score).alias("m18_avg_score")),
        queue.agg(F.count("*").alias("m20_investigations"), _distinct(F.col("OwnerEmail")).alias("m21_owners")))


def measures_scores(cc: DataFrame, defender: DataFrame, residency: DataFrame, tag: DataFrame) -> DataFrame:
    """M18, M19, M22, M28, M29: mean scores."""
    return side_by_side(
        cc.agg(F.avg("CCForPIIScore").alias("m18_avg_cc_score"), _patch_mean()),
        defender.agg(F.avg("progressScore").alias("m22_avg_defender_score")),
        residency.agg(F.avg("ResidencyScorePct").alias("m28_avg_residency_score")),
        tag.agg(F.avg("TagScorePct").alias("m29_avg_tag_score")))


def measures_last_run(residency_deltas: DataFrame, catalog_deltas: DataFrame, timeline: DataFrame,
                      threshold: float = V.SPIKE_THRESHOLD) -> DataFrame:
    """M27, M30-M32: values at the newest snapshot of each table, whatever filter the caller has."""
    def newest(df: DataFrame, value: Column, name: str) -> DataFrame:
        # Newest snapshot and its largest value in one aggregate: times are compared first.
        return df.agg(F.max(F.struct("SnapshotUtc", value.alias("v")))["v"].alias(name))

    m = side_by_side(
        latest_snapshot_rows(residency_deltas, "SnapshotUtc").agg(F.count_if("HasChanged").alias("m27_residency_changes")),
        newest(catalog_deltas, F.col("DeltaPct"), "m30_delta_pct"),
        newest(timeline, F.col("ProductsMissingResidency"), "m32_missing_residency"))
    flag = F.when(F.abs("m30_delta_pct") >= threshold, 1).otherwise(0)
    return m.fillna(0, ["m27_residency_changes", "m32_missing_residency"]).withColumn("m31_spike_flag", flag)


def measures_by_slicer(base: DataFrame) -> DataFrame:
    """Product measures for every value of both slicers, region and kind, and for all of them, from one aggregate.

    ``ALL`` marks a slicer that is not set; the row with both is the grand total.
    """
    kinds = {"s3": "IsS3", "fabric": "IsFabric", "sql": "IsSqlPaaS", "storage": "IsStorage", "hybrid": "IsHybridComputeMachine", "vm": "IsVmLike"}
    kind = ladder(*((F.col(flag), F.lit(name)) for name, flag in kinds.items()), otherwise=F.lit("other"))
    sliced = base.withColumn("kind", kind).cube("ResidencyRegion", "kind").agg(
        F.grouping("ResidencyRegion").alias("_any_region"), F.grouping("kind").alias("_any_kind"), F.count("*").alias("products"),
        F.count_if(F.col("HasFullNameClassification") == 1).alias("sensitive"), F.count_if("DefenderApplicable").alias("protectable"),
        F.sum(F.col("FullNameColumnCount").cast("bigint")).alias("fullname_columns"))
    return sliced.select(
        F.when(F.col("_any_region") == 1, "ALL").otherwise(F.coalesce("ResidencyRegion", F.lit(V.UNASSIGNED_REGION))).alias("region"),
        F.when(F.col("_any_kind") == 1, "ALL").otherwise(F.col("kind")).alias("kind"), "products", "sensitive", "protectable", "fullname_columns")
