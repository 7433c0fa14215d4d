"""Tag requests on resources: merge plan, counts, audit log."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from govmill.functions import fixed_values as V
from govmill.functions.columns import clean, ladder
from govmill.operators.keyed import first_per_key


def tag_merge_plan(items: DataFrame, resource: DataFrame, dry_run: bool, confirm: bool) -> DataFrame:
    """Tags of each item's resource before and after adding its key and value.

    Without confirmation nothing but a dry run is planned. Items without a resource id, or whose
    resource is unknown, are errors; the others go on.
    """
    if not dry_run and not confirm:
        raise ValueError("a real write needs confirm=True; keep dry_run=True to preview")
    key, value = (F.coalesce(clean(F.col(c)), F.lit(d)) for c, d in zip(("tagKey", "tagValue"), V.INVESTIGATE_TAG))
    tags = first_per_key(resource.select(F.lower("ResourceId").alias("_rid"), "Tags", F.lit(True).alias("_known")),
                         ["_rid"], [F.size("Tags").desc(), F.to_json("Tags")])
    df = (items.withColumn("resourceId", F.coalesce(clean(F.col("resourceId")), F.lit("")))
          .withColumn("tagKey", key).withColumn("tagValue", value))
    # Items without an id keep their rows apart in the join by product.
    df = (df.withColumn("_rid", F.when(F.col("resourceId") != "", F.lower("resourceId"))
                        .otherwise(F.concat(F.lit("none:"), F.coalesce("dataProductId", F.lit("")))))
          .join(tags, "_rid", "left"))
    after = F.map_concat(F.map_filter("Tags", lambda k, _: k != F.col("tagKey")), F.create_map("tagKey", "tagValue"))
    status = ladder((F.col("_known").isNull(), F.lit("error")), otherwise=F.lit("preview" if dry_run else "applied"))
    note = ladder((F.col("resourceId") == "", F.lit(V.TAG_NOTES["error"])),
                  (F.col("_known").isNull(), F.lit(V.TAG_NOTES["unknown"])),
                  otherwise=F.lit(V.TAG_NOTES["preview" if dry_run else "applied"]))
    return df.select(
        F.nullif("resourceId", F.lit("")).alias("resourceId"), "dataProductId", "dataProductDisplayName", "ownerEmail",
        F.col("ccScorePct").cast("int").alias("ccScorePct"), "tagKey", "tagValue", F.lit(dry_run).alias("dryRun"),
        (F.lit(not dry_run) & F.col("_known").isNotNull()).alias("applied"), F.col("Tags").alias("beforeTags"),
        F.when(F.col("_known"), after).alias("afterTags"), status.alias("status"), note.alias("note"))


def tag_merge_counts(plan: DataFrame) -> DataFrame:
    return plan.agg(F.count("*").alias("requestedCount"), F.count_if("applied").alias("appliedCount"),
                    F.count_if(F.col("status") == "error").alias("errorCount"))


def cc_changelog(plan: DataFrame, actor: str, source: str, request_id: str, run_ts: str) -> DataFrame:
    """One audit record per item that named a resource; items without one are only reported."""
    stamp = F.lit(run_ts).cast("timestamp")
    raw = F.to_json(F.struct("resourceId", "dataProductId", "tagKey", "tagValue", "status"))
    out = plan.filter("resourceId IS NOT NULL").withColumns({
        "ActionTimeUtc": stamp, "ActionType": F.lit(V.TAG_ACTION_TYPE), "ActionStatus": F.col("status"),
        "SuggestedTagKey": F.col("tagKey"), "SuggestedTagValue": F.col("tagValue"), "RequestedBy": F.lit(actor),
        "RequestSource": F.lit(source), "RequestId": F.lit(request_id), "Notes": F.col("note"), "IngestedAtUtc": stamp,
        "RawActionLogRecordJson": raw})
    return out.select(*(F.col(c).alias(c) for c in V.TAG_LOG_COLUMNS))
