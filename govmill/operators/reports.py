"""Report queries: grouped counts, filtered lists and detail tables over finished frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from govmill.functions import fixed_values as V
from govmill.functions.columns import normalise_id
from govmill.operators.measures import product_flags


def star_join(fact: DataFrame, products: DataFrame, fact_key: str, dimension_key: str = "DataProductId") -> DataFrame:
    """Fact rows with their product's columns, prefixed ``Product``. Keys are compared normalised.

    ``dimension_key`` names the relationship's product column; the usual one is the id.
    """
    dim = products.select(normalise_id(F.col(dimension_key)).alias("_key"),
                          *(F.col(c).alias(f"Product{c.removeprefix('DataProduct')}") for c in products.columns))
    return fact.join(dim, normalise_id(F.col(fact_key)) == F.col("_key"), "left").drop("_key")


def products_by_region(products: DataFrame) -> DataFrame:
    return products.groupBy("ResidencyRegion").agg(F.countDistinct("DataProductID").alias("products")).orderBy(
        F.desc("products"), "ResidencyRegion")


def assets_by_product(assets: DataFrame) -> DataFrame:
    return assets.groupBy("DataProductName").agg(F.sum("TotalAssets").alias("assets")).orderBy(F.desc("assets"), "DataProductName")


def missing_region_list(products: DataFrame) -> DataFrame:
    return products.filter("ResidencyRegion IS NULL").select("DataProductDisplayName").distinct()


def kpi_lines(timeline: DataFrame) -> DataFrame:
    return timeline.groupBy("SnapshotUtc").agg(
        F.max("TotalPurviewAssets").alias("catalog_assets"), F.max("TotalProductAssets").alias("product_assets"),
        F.max("ResidencyCoveragePct").alias("coverage"), F.sum("ProductAssetsToPurviewAssetsRatio").alias("ratio")).orderBy("SnapshotUtc")


def residency_log(deltas: DataFrame) -> DataFrame:
    """The saved report keeps rows *without* a change."""
    return deltas.filter("NOT HasChanged").select("SnapshotUtc", "DataProductID", "DataProductDisplayName", "PrevResidencyRegion", "ResidencyRegion")


def relative_time_filter(df: DataFrame, time: str, anchor: Column, hours: int = V.RECENT_HOURS) -> DataFrame:
    """Rows of the last ``hours`` before ``anchor``."""
    start = anchor - F.make_dt_interval(hours=F.lit(hours))
    return df.filter((F.col(time) >= start) & (F.col(time) <= anchor))


def recent_asset_changes(deltas: DataFrame, anchor: Column, hours: int = V.RECENT_HOURS) -> DataFrame:
    """Products whose assets moved in the last hours; sums that cancel out are left out."""
    recent = relative_time_filter(deltas, "SnapshotTS", anchor, hours)
    return recent.groupBy("SnapshotTS", "DataProductName").agg(
        F.sum("TotalAssets").alias("assets"), F.sum("DeltaAssets").alias("delta")).filter("delta <> 0")


def score_gauges(summary: DataFrame) -> DataFrame:
    names = {"residency": "ResidencyScorePct", "defender": "DefenderScorePct", "tag": "TagScorePct", "patch": "PatchComplianceScorePct"}
    return summary.agg(*(F.avg(c).alias(n) for n, c in names.items()))


def non_confidential_vms(inventory: DataFrame, products: DataFrame) -> DataFrame:
    """Virtual machines that are not confidential, with the name of their product."""
    return inventory.filter("IsConfidential = 0").join(
        products.select("DataProductId", "DataProductDisplayName"), "DataProductId").select(
        "DataProductId", "DataProductDisplayName", "ComputeResourceId", "ComputeName", "SecurityType", "Location", "TenantId")


def sensitive_and_confidential(products: DataFrame, classification: DataFrame, inventory: DataFrame) -> DataFrame:
    return product_flags(products, classification, inventory).filter("m10_both = 1").select("DataProductDisplayName").distinct()


def gap_tables(no_compute: DataFrame, not_confidential: DataFrame, products: DataFrame) -> DataFrame:
    """Both gaps by product name, with column and machine counts."""
    def named(df: DataFrame, gap: str) -> DataFrame:
        rows = df.select(F.lit(gap).alias("gap"), "DataProductId", "FullNameColumnCount", "ComputeVmCount")
        return rows.join(products.select("DataProductId", "DataProductDisplayName"), "DataProductId")

    return named(no_compute, "no_compute").unionByName(named(not_confidential, "not_confidential")).groupBy(
        "gap", "DataProductDisplayName").agg(F.sum("FullNameColumnCount").alias("columns"), F.sum("ComputeVmCount").alias("vms"))


def investigation_table(queue: DataFrame) -> DataFrame:
    by = ["DataProductDisplayName", "CCResourceKind", "LookupSkuOrModel", "OwnerName", "OwnerEmail", "CCReason",
          "InvestigationReasonCode"]
    return queue.groupBy(*by).agg(F.sum("CCScorePct").alias("score"))


def score_matrix(summary: DataFrame) -> DataFrame:
    return summary.select(*V.SUMMARY_COLUMNS)


def patch_list(cc: DataFrame, products: DataFrame, status: str | None = None) -> DataFrame:
    rows = cc if status is None else cc.filter(F.col("PatchAssessmentStatus") == status)
    return rows.select("DataProductId", "PatchAssessmentStatus", "PendingUpdatesTotal", "LastUpdateScanUtc").join(
        products.select("DataProductId", "DataProductDisplayName"), "DataProductId", "left")


def cc_cards(cc: DataFrame) -> DataFrame:
    return cc.agg(F.count(F.when(F.col("CCForPIIScore") != 100, F.col("CCForPIIScore"))).alias("below_100"),
                  F.avg("CCForPIIScore").alias("mean_score"))


def cc_detail(cc: DataFrame, products: DataFrame) -> DataFrame:
    return cc.select("DataProductId", "FullNameColumnCount", "CCForPIIStatus", "CCForPIIScore", "Reason", "SnapshotUtc").join(
        products.select("DataProductId", "DataProductDisplayName"), "DataProductId", "left")


def slicers(frames: Sequence[tuple[str, DataFrame, str]]) -> DataFrame:
    """Distinct values per slicer, all in one list."""
    parts = [df.select(F.lit(name).alias("slicer"), F.col(c).alias("value")).distinct() for name, df, c in frames]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.orderBy("slicer", "value")


def dashboard_info(products: DataFrame, assets: DataFrame, eligibility: DataFrame) -> DataFrame:
    """Dashboard facts as rows of section, item, detail and value.

    Counts have one row; lists have one row per product, so no list is gathered into a cell.
    """
    def fact(df: DataFrame, section: str, value: Column, item: Column | None = None, detail: Column | None = None) -> DataFrame:
        item, detail = (F.lit(None).cast("string") if c is None else c for c in (item, detail))
        columns = (F.lit(section).alias("section"), item.alias("item"), detail.alias("detail"), value.cast("bigint").alias("value"))
        return df.select(*columns)

    def count(df: DataFrame, section: str, value: Column) -> DataFrame:
        return fact(df.agg(value.cast("bigint").alias("n")), section, F.col("n"))

    missing = products.filter("ResidencyRegion IS NULL").select("DataProductId", "DataProductDisplayName")
    eligible = eligibility.filter("EligibleForResidencyUpdate")
    blocked = eligibility.filter(F.col("EligibilityReason") == V.ELIGIBILITY_REASONS["not_approved"])
    change = F.concat_ws(" ", "SuggestedPurviewResidencyAction", F.coalesce("ExpectedCurrentResidencyCode", F.lit("-")), "TargetResidencyCode")
    one, name = F.lit(1), F.col("DataProductDisplayName")
    rows = [
        count(missing, "missing_region_count", F.count("*")), fact(missing, "missing_region_product", one, name, F.col("DataProductId")),
        count(products, "total_products", F.count("*")), count(assets, "total_assets", F.sum("TotalAssets")),
        fact(assets, "assets_by_product", F.col("TotalAssets"), F.col("DataProductName")),
        count(eligible, "eligible_count", F.count("*")), fact(eligible, "eligible_product", one, name, change),
        count(blocked, "blocked_count", F.count("*")), fact(blocked, "blocked_product", one, name, F.col("AzureResidencyCode")),
    ]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out
