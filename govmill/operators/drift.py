"""Drift tables over snapshot history: deltas, the KPI timeline, alerts."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from govmill.functions import fixed_values as V
from govmill.functions.columns import is_true
from govmill.operators.timeseries import asof_many, previous_row


def _change(now: Column, before: Column) -> Column:
    """Relative change; null when there is nothing, or zero, to compare with."""
    return F.try_divide((now - before).cast("double"), before.cast("double"))


#: Adds the values of the row before: over a whole history, or from what an earlier run kept (``upkeep.extend_deltas``).
Previous = Callable[[DataFrame, Sequence[str], str, Sequence[str]], DataFrame]


def catalog_deltas(history: DataFrame, previous: Previous = previous_row) -> DataFrame:
    h = history.select("SnapshotUtc", F.col("TotalAssets").cast("bigint"), "IsApproximate")
    now, before = F.col("TotalAssets"), F.col("PrevTotalAssets")
    return previous(h, [], "SnapshotUtc", ["TotalAssets"]).select(
        "SnapshotUtc", "TotalAssets", "IsApproximate", "PrevTotalAssets",
        (now - before).alias("DeltaAssets"), _change(now, before).alias("DeltaPct"))


def asset_count_deltas(history: DataFrame, previous: Previous = previous_row) -> DataFrame:
    h = history.select("SnapshotTS", "SnapshotDate", "DataProductName", F.col("TotalAssets").cast("bigint"))
    now, before = F.col("TotalAssets"), F.col("PrevTotalAssets")
    return previous(h, ["DataProductName"], "SnapshotTS", ["TotalAssets"]).select(
        "SnapshotTS", "SnapshotDate", "DataProductName", "TotalAssets", before.alias("PrevAssets"),
        (now - before).alias("DeltaAssets"), _change(now, before).alias("DeltaPct"))


def residency_deltas(history: DataFrame, previous: Previous = previous_row) -> DataFrame:
    """Region now and at the product's snapshot before. A change needs a region on both sides."""
    h = history.select(F.col("Snapshots").alias("SnapshotUtc"), "SnapshotDate", "DataProductID",
                       "DataProductDisplayName", "ResidencyRegion")
    return previous(h, ["DataProductID"], "SnapshotUtc", ["SnapshotUtc", "ResidencyRegion"]).select(
        "SnapshotUtc", "SnapshotDate", "DataProductID", "DataProductDisplayName", "PrevSnapshotUtc",
        "PrevResidencyRegion", "ResidencyRegion",
        is_true(F.col("ResidencyRegion") != F.col("PrevResidencyRegion")).alias("HasChanged"))


def asset_totals_by_snapshot(history: DataFrame) -> DataFrame:
    return history.groupBy(F.col("SnapshotTS").alias("SnapUtc")).agg(
        F.sum(F.col("TotalAssets").cast("bigint")).alias("TotalProductAssets"))


def residency_totals_by_snapshot(history: DataFrame) -> DataFrame:
    """Products per snapshot, and rows with and without a region (blank counts as without).

    The with and without counts are of rows, the total is of distinct products.
    """
    placed = is_true(F.col("ResidencyRegion") != "")
    return history.groupBy(F.col("Snapshots").alias("SnapUtc")).agg(
        F.countDistinct("DataProductID").alias("TotalDataProducts"),
        F.count_if(~placed).alias("ProductsMissingResidency"), F.count_if(placed).alias("ProductsWithResidency"))


def kpi_timeline(catalog: DataFrame, asset: DataFrame, residency: DataFrame,
                 seconds: int = V.ASOF_SECONDS) -> DataFrame:
    """Catalog snapshots with the newest asset and residency totals at or before them.

    Only rows where both were found stay.
    """
    left = catalog.select("SnapshotUtc", F.col("TotalAssets").cast("bigint").alias("TotalPurviewAssets"), "IsApproximate")
    totals = ["TotalDataProducts", "ProductsMissingResidency", "ProductsWithResidency"]
    both = asof_many(left, "SnapshotUtc", [
        (asset_totals_by_snapshot(asset), "SnapUtc", ["TotalProductAssets"]),
        (residency_totals_by_snapshot(residency), "SnapUtc", totals)], seconds)

    def ratio(a: str, b: str) -> Column:
        return F.try_divide(F.col(a).cast("double"), F.col(b).cast("double"))

    return both.filter("TotalProductAssets IS NOT NULL AND TotalDataProducts IS NOT NULL").select(
        "SnapshotUtc", "TotalPurviewAssets", "IsApproximate", "TotalProductAssets", *totals,
        ratio("ProductsWithResidency", "TotalDataProducts").alias("ResidencyCoveragePct"),
        ratio("TotalProductAssets", "TotalPurviewAssets").alias("ProductAssetsToPurviewAssetsRatio"))


def top_recent(df: DataFrame, order: list[Column | str], n: int) -> DataFrame:
    """The first ``n`` rows of a total order; each task keeps only its own first ``n``."""
    return df.orderBy(*order).limit(n)


def spike_alerts(deltas: DataFrame, key: Column, time: str, value: str, threshold: float) -> DataFrame:
    now = F.col(value)
    return deltas.filter(F.abs("DeltaPct") >= threshold).select(
        key.alias("key"), F.when(F.col("DeltaPct") > 0, "spike").otherwise("drop").alias("kind"),
        (now - F.col("DeltaAssets")).cast("string").alias("prev"), now.cast("string").alias("value"),
        F.col("DeltaPct").alias("pct"), F.col(time).alias("ts"))


def region_alerts(deltas: DataFrame) -> DataFrame:
    """Region changes, and regions gained or lost between snapshots."""
    before, now = F.col("PrevResidencyRegion"), F.col("ResidencyRegion")
    known = F.col("PrevSnapshotUtc").isNotNull()
    kind = (F.when(F.col("HasChanged"), "RegionChanged").when(known & before.isNull() & now.isNotNull(), "GainedRegion")
            .when(known & before.isNotNull() & now.isNull(), "LostRegion"))
    return deltas.withColumn("kind", kind).filter("kind IS NOT NULL").select(
        F.col("DataProductID").alias("key"), "kind", F.col("PrevResidencyRegion").alias("prev"),
        F.col("ResidencyRegion").alias("value"), F.lit(None).cast("double").alias("pct"), F.col("SnapshotUtc").alias("ts"))


def drift_alerts(catalog: DataFrame, asset: DataFrame, residency: DataFrame,
                 threshold: float = V.SPIKE_THRESHOLD) -> DataFrame:
    """All alerts in history: catalog and product spikes and drops, and region moves."""
    return (spike_alerts(catalog_deltas(catalog), F.lit("catalog"), "SnapshotUtc", "TotalAssets", threshold)
            .unionByName(spike_alerts(asset_count_deltas(asset), F.col("DataProductName"), "SnapshotTS", "TotalAssets", threshold))
            .unionByName(region_alerts(residency_deltas(residency))))
