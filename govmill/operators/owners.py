"""Owner contacts and the confidential-compute investigation queue."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from govmill.functions import fixed_values as V
from govmill.functions.columns import clean, is_compute, is_true, ladder, normalise_code, normalise_id, resource_kind, resource_name
from govmill.functions.schemas import assert_exact_columns
from govmill.operators.gold import product_dimension
from govmill.operators.keyed import first_per_key

RESOLVED, FALLBACK = ("Resolved", "Directory"), ("NotResolved", "Fallback")


def product_owner(owner: DataFrame) -> DataFrame:
    """One owner id per product; products with a blank owner id have none."""
    o = owner.select(normalise_code(F.col("DataProductId")).alias("DataProductId"),
                     clean(F.col("DataProductOwnerId")).alias("OwnerObjectId")).dropna()
    return first_per_key(o, ["DataProductId"], ["OwnerObjectId"])


def owner_contact(owner: DataFrame, contact: DataFrame, fallback_name: str, fallback_email: str,
                  run_ts: str) -> DataFrame:
    """Name and address of each product's owner, from a contact table or else the fallback."""
    known = first_per_key(contact, ["OwnerObjectId"], ["OwnerName", "OwnerEmail"]).withColumn("_known", F.lit(True))
    df = product_owner(owner).join(known, "OwnerObjectId", "left")
    status, source = (F.when(F.col("_known"), a).otherwise(b) for a, b in zip(RESOLVED, FALLBACK))
    return df.select(
        "DataProductId", "OwnerObjectId", F.coalesce("OwnerName", F.lit(fallback_name)).alias("OwnerName"),
        F.coalesce("OwnerEmail", F.lit(fallback_email)).alias("OwnerEmail"), source.alias("OwnerSource"),
        status.alias("ResolveStatus"), F.lit(None).cast("string").alias("ResolveError"),
        F.lit(run_ts).alias("SnapshotUtc"))


def investigate_join(cc_current: DataFrame, owner: DataFrame, gold: DataFrame) -> DataFrame:
    """Confidential-compute rows with owner and product details; both may be absent."""
    cc = cc_current.withColumn("DataProductId", normalise_id(F.col("DataProductId")))
    own = owner.select(normalise_id(F.col("DataProductId")).alias("DataProductId"), "OwnerObjectId", "OwnerName",
                       "OwnerEmail", "OwnerSource", F.col("ResolveStatus").alias("OwnerResolveStatus"))
    meta = product_dimension(gold).select("DataProductId", F.col("DataProductDisplayName").alias("_name"),
                                          "DataProductDescription")
    return (cc.join(own, "DataProductId", "left").join(meta, "DataProductId", "left")
            .withColumn("DataProductDisplayName", F.coalesce("DataProductDisplayName", "_name")).drop("_name"))


def cc_investigation_queue(cc_current: DataFrame, owner: DataFrame, gold: DataFrame) -> DataFrame:
    """Sensitive products on compute that is not confidential, or not approved: one row each."""
    asked = cc_current.filter((F.col("HasFullNameClassification") == 1) & is_compute(F.col("ResourceType"))
                              & F.col("CCForPIIScore").isin(*V.INVESTIGATION_CODES))
    one = first_per_key(asked, ["DataProductId"], ["CCForPIIScore", "ResourceId"])
    df = investigate_join(one, owner, gold)
    key, value = V.INVESTIGATE_TAG
    code = ladder(*((F.col("CCForPIIScore") == s, F.lit(c)) for s, c in V.INVESTIGATION_CODES.items()))
    out = df.withColumns({
        "SnapshotUtc": F.col("SnapshotUtc").cast("string"), "CCScorePct": F.col("CCForPIIScore"),
        "CCState": F.col("CCForPIIStatus"), "CCReason": F.col("Reason"), "InvestigationRequired": F.lit(True),
        "InvestigationReasonCode": code, "ResourceFound": clean(F.col("ResourceId")).isNotNull(),
        "CCApplicableResource": F.lit(True), "CCApplicable": F.lit(True),
        "ResourceName": resource_name(F.col("ResourceId")), "SuggestedTagKey": F.lit(key),
        "SuggestedTagValue": F.lit(value), "LookupSkuOrModel": F.col("VmSize"),
        "CCResourceKind": resource_kind(F.col("ResourceType")), "ArcCloudProvider": F.lit(None).cast("string"),
        "ArcStatus": F.lit(None).cast("string"), "VmSizeCompat": F.col("VmSize")})
    return assert_exact_columns(out.select(*V.INVESTIGATION_COLUMNS), V.INVESTIGATION_COLUMNS, "investigation queue")


def investigation_match(requests: DataFrame, queue: DataFrame) -> DataFrame:
    """A request may act only when its product matches exactly one queue row."""
    counts = queue.groupBy(normalise_id(F.col("DataProductId")).alias("_id")).agg(F.count("*").alias("n"))
    return (requests.join(counts, normalise_id(F.col("dataProductId")) == F.col("_id"), "left")
            .select("requestId", "dataProductId", F.coalesce("n", F.lit(0)).alias("match_count"),
                    is_true(F.col("n") == 1).alias("actionable")))
