"""Region change requests: plan, apply, verify, log. All requests are planned in one job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from govmill.functions import fixed_values as V
from govmill.functions.columns import clean, is_true, ladder, normalise_code, normalise_id
from govmill.operators.keyed import first_per_key

_OPERATIONS = "array<struct<step:int,operation:string,termId:string,termName:string>>"


def region_terms(term: DataFrame, parent_id: str) -> DataFrame:
    return term.filter(F.col("ParentGlossaryTermId") == parent_id).select(
        F.col("GlossaryTermId").alias("termId"), F.col("GlossaryTermDisplayName").alias("termName"))


def current_regions(assignment: DataFrame, term: DataFrame, parent_id: str) -> DataFrame:
    """Per product: how many region terms are assigned, and the first of them."""
    active = assignment.filter("ActiveFlag = 1").select(
        normalise_id(F.col("DataProductId")).alias("_pid"), F.col("GlossaryTermId").alias("termId")).distinct()
    return (active.join(region_terms(term, parent_id), "termId").groupBy("_pid")
            .agg(F.count("*").alias("_terms"), F.min(F.struct("termId", "termName")).alias("_current")))


def residency_change_plan(request: DataFrame, assignment: DataFrame, term: DataFrame, product: DataFrame,
                          parent_id: str, id_pattern: str = V.GUID_PATTERN) -> DataFrame:
    """What each request would do, and whether it may."""
    targets = first_per_key(region_terms(term, parent_id).withColumn("_name", normalise_id(F.col("termName"))),
                            ["_name"], ["termId"]).select("_name", F.struct("termId", "termName").alias("_target"))
    names = first_per_key(product.select(normalise_id(F.col("DataProductID")).alias("_pid"), "DataProductDisplayName"),
                          ["_pid"], ["DataProductDisplayName"])
    df = (request.withColumn("dataProductId", F.coalesce(normalise_id(F.col("dataProductId")), F.lit("")))
          .withColumn("targetResidencyCode", normalise_code(F.col("targetResidencyCode")))
          .withColumn("expectedCurrentResidencyCode", normalise_code(F.col("expectedCurrentResidencyCode"))))
    current = current_regions(assignment, term, parent_id).join(names, "_pid", "full")
    df = (df.join(current, df["dataProductId"] == current["_pid"], "left")
          .join(targets, df["targetResidencyCode"] == targets["_name"], "left")
          .withColumn("currentResidencyCode", normalise_code(F.col("_current.termName"))))
    now, target, expected = (F.col(c) for c in ("currentResidencyCode", "targetResidencyCode", "expectedCurrentResidencyCode"))

    def outcome(status: str, action: str, note: str | None, can: bool, needs: bool | None, ops: Column | None = None,
                manual: bool = False, conflict: bool = False) -> Column:
        return F.struct(
            F.lit(status).alias("status"), F.lit(action).alias("action"), F.lit(note).cast("string").alias("notes"),
            F.lit(can).alias("canApply"), F.lit(needs).cast("boolean").alias("needsChange"),
            F.lit(manual).alias("manualReviewRequired"), F.lit(conflict).alias("conflict"),
            (F.array() if ops is None else ops).cast(_OPERATIONS).alias("operations"))

    def step(n: int, operation: str, side: str) -> Column:
        return F.struct(F.lit(n).alias("step"), F.lit(operation).alias("operation"),
                        F.col(f"{side}.termId").alias("termId"), F.col(f"{side}.termName").alias("termName"))

    error = {k: outcome("rejected", "none", note, False, None) for k, note in V.PLAN_ERRORS.items()}
    add = F.array(step(1, "addTermRelationship", "_target"))
    replace = F.array(step(1, "deleteTermRelationship", "_current"), step(2, "addTermRelationship", "_target"))
    chosen = ladder(
        (F.col("dataProductId") == "", error["no_id"]),
        (~F.col("dataProductId").rlike(id_pattern), error["bad_id"]),
        (target.isNull(), error["no_target"]),
        (target.contains(","), error["several_targets"]),
        (F.col("_target").isNull(), error["no_term"]),
        (is_true(F.col("_terms") > 1), outcome("blocked", "manual_review", V.PLAN_NOTES["manual"], False, None, manual=True)),
        (F.col("expectedProvided") & ~expected.eqNullSafe(now),
         outcome("blocked", "none", V.PLAN_NOTES["conflict"], False, None, conflict=True)),
        (is_true(now == target), outcome("no_change", "none", V.PLAN_NOTES["same"], True, False)),
        (F.col("_current").isNull(), outcome("preview", "add", None, True, True, add)),
        otherwise=outcome("preview", "replace", None, True, True, replace))
    many = is_true(F.col("_terms") > 1)
    return df.withColumn("_o", chosen).select(
        "requestId", "dataProductId", "DataProductDisplayName", "_o.*",
        F.when(~many, now).alias("currentResidencyCode"), "targetResidencyCode", "expectedCurrentResidencyCode",
        "dryRun", "confirm")


def changes_to_apply(plan: DataFrame) -> DataFrame:
    """Confirmed, real, needed changes; of several requests for one product the first by id."""
    ready = plan.filter(F.col("needsChange") & ~F.col("dryRun") & F.col("confirm"))
    return first_per_key(ready, ["dataProductId"], ["requestId"])


def apply_changes(plan: DataFrame, assignment: DataFrame) -> DataFrame:
    """The assignment table after the confirmed changes: deletions first, then additions."""
    steps = changes_to_apply(plan).select("dataProductId", F.inline("operations"))
    pid = normalise_id(F.col("DataProductId"))
    gone = steps.filter("operation = 'deleteTermRelationship'").select(
        F.col("dataProductId").alias("_pid"), F.col("termId").alias("_term"))
    # Only active rows are relationships; closed ones stay as they are.
    kept = assignment.withColumn("_pid", pid).withColumn("_term", F.col("GlossaryTermId")).withColumn(
        "_live", F.col("ActiveFlag") == 1)
    kept = kept.join(gone.withColumn("_live", F.lit(True)), ["_pid", "_term", "_live"], "left_anti").drop("_pid", "_term", "_live")
    spelled = first_per_key(assignment.select(pid.alias("dataProductId"), F.col("DataProductId").alias("_raw")),
                            ["dataProductId"], ["_raw"])
    added = (steps.filter("operation = 'addTermRelationship'").join(spelled, "dataProductId", "left")
             .select(F.coalesce("_raw", "dataProductId").alias("DataProductId"), F.col("termId").alias("GlossaryTermId"),
                     F.lit(1).alias("ActiveFlag")))
    return kept.unionByName(added)


def residency_change_apply(plan: DataFrame, assignment: DataFrame, term: DataFrame, parent_id: str) -> tuple[DataFrame, DataFrame]:
    """New assignments, and per request whether it was applied and found in place afterwards."""
    after = apply_changes(plan, assignment)
    applied = changes_to_apply(plan).select("requestId", F.lit(True).alias("_applied"))
    state = current_regions(after, term, parent_id).select(
        F.col("_pid").alias("dataProductId"), normalise_code(F.col("_current.termName")).alias("_after"))
    df = plan.join(applied, "requestId", "left").join(state, "dataProductId", "left").withColumn(
        "applied", is_true(F.col("_applied")))
    match = F.when(F.col("applied"), is_true(F.col("_after") == F.col("targetResidencyCode")))
    waits = F.col("needsChange") & ~F.col("dryRun") & ~F.col("confirm")
    status = ladder(
        (F.col("applied") & F.col("verifiedMatch"), F.lit("applied")),
        (F.col("applied"), F.lit("error")),
        (is_true(waits), F.lit("needs_confirmation")),
        (is_true(F.col("needsChange") & ~F.col("dryRun")), F.lit("blocked")),
        otherwise=F.col("planStatus"))
    verdict = F.when(F.col("applied"), F.when(F.col("verifiedMatch"), V.PLAN_NOTES["verified"]).otherwise(V.PLAN_NOTES["not_verified"]))
    result = (df.withColumn("verifiedMatch", match).withColumnRenamed("status", "planStatus").withColumn("status", status)
              .withColumn("notes", F.concat_ws("; ", "notes", verdict)))
    return after, result.select(
        "requestId", "dataProductId", "DataProductDisplayName", "action", "status", "applied", "verifiedMatch",
        "currentResidencyCode", "targetResidencyCode", "dryRun", "notes")


def residency_changelog(result: DataFrame, parent_name: str, actor: str, source: str, run_ts: str) -> DataFrame:
    """One audit record per request."""
    stamp = F.lit(run_ts).cast("timestamp")
    raw = F.to_json(F.struct("requestId", "dataProductId", "action", "status", "currentResidencyCode", "targetResidencyCode"))
    out = result.withColumns({
        "ActionTimeUtc": stamp, "ActionType": F.lit(V.RESIDENCY_ACTION_TYPE), "ActionStatus": F.col("status"),
        "DataProductID": F.col("dataProductId"), "ParentTermName": F.lit(parent_name), "RequestedBy": F.lit(actor),
        "RequestSource": F.lit(source), "ActionDecision": F.col("action"), "IngestedAtUtc": stamp,
        "RawActionLogRecordJson": raw})
    return out.select(*(F.col(c).alias(c) for c in V.RESIDENCY_LOG_COLUMNS))


def request_summary(asked: DataFrame, matched: DataFrame, key: str) -> DataFrame:
    """Asked, matched and missing counts, one row; the missing ids stay a frame (:func:`missing_ids`)."""
    ids = asked.select(key).distinct()
    hits = matched.select(key, F.lit(1).alias("_hit")).distinct()
    return ids.join(hits, key, "left").agg(
        F.count("*").alias("requestedCount"), F.count("_hit").alias("matchedCount"),
        F.count_if(F.col("_hit").isNull()).alias("missingCount"))


def missing_ids(asked: DataFrame, matched: DataFrame, key: str) -> DataFrame:
    return asked.select(key).distinct().join(matched.select(key), key, "left_anti")


def validate_guid(ids: DataFrame, column: str, pattern: str = V.GUID_PATTERN) -> tuple[DataFrame, DataFrame]:
    """Valid and invalid ids as two frames."""
    ok = is_true(clean(F.col(column)).rlike(pattern))
    return ids.filter(ok), ids.filter(~ok)
