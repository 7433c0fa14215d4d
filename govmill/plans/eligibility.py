"""Which products may have their declared region updated from the detected one, and why."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from govmill.functions import fixed_values as V
from govmill.functions.columns import is_true, ladder, normalise_code, parse_bool_strict, single_value
from govmill.functions.schemas import assert_exact_columns
from govmill.operators.keyed import latest_snapshot_rows


def eligible_region_join(detected: DataFrame, column: str, rules: DataFrame) -> DataFrame:
    """Detected region with its rule row, if any."""
    r = rules.filter("region_code IS NOT NULL").select(
        normalise_code(F.col("region_code")).alias("ApprovedRegionCodeMatch"),
        parse_bool_strict(F.col("approved")).alias("_approved"),
        F.col("region_name").cast("string").alias("ApprovedRegionName"),
        F.col("notes").cast("string").alias("ApprovedRegionNotes"))
    return (detected.join(r, F.col(column) == F.col("ApprovedRegionCodeMatch"), "left")
            .withColumn("IsAzureRegionApproved", is_true(F.col("_approved"))).drop("_approved"))


def residency_eligibility(current: DataFrame, rules: DataFrame, run_ts: str) -> DataFrame:
    """Eligibility of every product at the newest residency snapshot."""
    now = latest_snapshot_rows(current, "SnapshotTimeUtc")
    flags = {c: parse_bool_strict(F.col(c)) for c in ("GlossaryResidencyMissing", "AzureResourceFound", "AzureLocationMatch")}
    norm = now.withColumns({
        **flags,
        "GlossaryResidencyRegionName": normalise_code(F.col("GlossaryResidencyRegionName")),
        "GlossaryResidencyRegionCode": normalise_code(F.col("GlossaryResidencyRegionCode")),
        "AzureResourceCount": F.coalesce(F.col("AzureResourceCount").cast("int"), F.lit(0)),
        "AzureResidencyCode": normalise_code(F.col("AzureLocations")),
        "AzureLocationsRaw": F.col("AzureLocations"),
        "ResidencyScorePct": F.coalesce(F.col("ResidencyScorePct").cast("int"), F.lit(0)),
        "IsApprovedResidency_ScorecardField": parse_bool_strict(F.col("IsApprovedResidency")),
    })
    df = eligible_region_join(norm, "AzureResidencyCode", rules).withColumn(
        "HasSingleClearAzureResidencyValue", single_value(F.col("AzureResidencyCode")))
    r = {k: F.lit(v) for k, v in V.ELIGIBILITY_REASONS.items()}
    same = F.coalesce("GlossaryResidencyRegionCode", F.lit("")) == F.coalesce("AzureResidencyCode", F.lit(""))
    reason = ladder(
        (~F.col("AzureResourceFound"), r["not_found"]),
        (F.col("AzureResourceCount") < 1, r["no_count"]),
        (F.col("AzureResidencyCode").isNull(), r["no_region"]),
        (~F.col("HasSingleClearAzureResidencyValue"), r["several"]),
        (~F.col("IsAzureRegionApproved"), r["not_approved"]),
        (F.col("GlossaryResidencyMissing"), r["add"]),
        (same, r["same"]),
        otherwise=r["replace"])
    # The reason decides; flag and action follow from it.
    action = ladder((F.col("EligibilityReason") == r["add"], F.lit("add")),
                    (F.col("EligibilityReason") == r["replace"], F.lit("replace")), otherwise=F.lit("none"))
    out = (df.withColumn("EligibilityReason", reason).withColumn("SuggestedPurviewResidencyAction", action)
           .withColumns({
               "EligibleForResidencyUpdate": F.col("SuggestedPurviewResidencyAction") != "none",
               "TargetResidencyCode": F.col("AzureResidencyCode"),
               "ExpectedCurrentResidencyCode": F.col("GlossaryResidencyRegionCode"),
               "EligibilityComputedAtUtc": F.lit(run_ts).cast("timestamp"),
               "EligibilityLogicVersion": F.lit(V.ELIGIBILITY_VERSION)}))
    return assert_exact_columns(out.select(*V.ELIGIBILITY_COLUMNS), V.ELIGIBILITY_COLUMNS, "eligibility")


def eligible_listing(eligibility: DataFrame) -> DataFrame:
    """The eligible products, by name."""
    return eligibility.filter("EligibleForResidencyUpdate").select(
        "DataProductDisplayName", "DataProductID", "GlossaryResidencyRegionCode", "TargetResidencyCode",
        "ExpectedCurrentResidencyCode", "IsAzureRegionApproved", "EligibleForResidencyUpdate",
        "SuggestedPurviewResidencyAction", "EligibilityReason").orderBy("DataProductDisplayName", "DataProductID")


def eligibility_counts(eligibility: DataFrame) -> DataFrame:
    return eligibility.agg(F.max("SnapshotTimeUtc").alias("SnapshotTimeUtc"), F.count("*").alias("RowCount"),
                           F.count_if("EligibleForResidencyUpdate").alias("EligibleCount"))
