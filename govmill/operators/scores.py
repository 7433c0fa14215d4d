"""Scorecards. Each is one ladder over the base products joined with their evidence.

A ladder picks a *band*: a struct with score, state and reason together, so the columns of a
scorecard cannot disagree. Evidence is joined only to products the check applies to.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from govmill.functions import fixed_values as V
from govmill.functions.columns import (
    clean, is_true, ladder, normalise_code, normalise_id, tag_value, verdict,
)
from govmill.functions.schemas import assert_exact_columns
from govmill.operators.evidence import (
    approved_region_lookup, audit_resources, cc_evidence, defender_resources, governed_tag, residency_evidence,
    resource_rollup, rollup_resources, sku_lookup, tagged,
)
from govmill.operators.keyed import first_per_key
from govmill.session import stored


def _stamp(run_ts: str) -> Column:
    return F.lit(run_ts).cast("timestamp")


def tag_evidence(resource: DataFrame, variants: Sequence[str] = V.PRIMARY_PRODUCT_TAG) -> DataFrame:
    """One resource per product, the smallest id, with its two governed tags."""
    one = first_per_key(tagged(resource, variants), ["DataProductId"], ["ResourceId"])

    return _tag_columns(one.withColumn("SovereigntyZone", governed_tag(V.ZONE_TAG)).withColumn("ResourceOrigin", governed_tag(V.ORIGIN_TAG)))


def _tag_columns(one: DataFrame) -> DataFrame:
    return one.select(
        "DataProductId", F.lit(True).alias("resourceFound"), F.col("ResourceId").alias("resourceId"), "ResourceType",
        "SubscriptionId", "ResourceGroup", normalise_id(F.col("Location")).alias("Location"),
        "SovereigntyZone", "ResourceOrigin")


def score_tag(base: DataFrame, resource: DataFrame, run_ts: str,
              variants: Sequence[str] = V.PRIMARY_PRODUCT_TAG, found: DataFrame | None = None) -> DataFrame:
    """Tag scorecard: five parts of 20 points each. ``found`` is the stored ``product_evidence``, where there is one."""
    if found is None:
        evidence = tag_evidence(resource, variants)
    else:
        evidence = _tag_columns(found.filter("tag IS NOT NULL").select("DataProductId", "tag.*"))
    held = [c for c in evidence.columns if c != "DataProductId"]
    df = base.join(evidence, "DataProductId", "left").withColumns({c: F.when(F.col("TagApplicable"), F.col(c)) for c in held})
    df = df.withColumn("resourceFound", is_true(F.col("resourceFound")))
    zone, origin = F.col("SovereigntyZone"), F.col("ResourceOrigin")
    parts = {
        "resourceFound20": F.col("resourceFound"),
        "sovereigntyZoneExists20": zone.isNotNull(),
        "sovereigntyZoneAllowed20": is_true(zone.isin(*V.ALLOWED_ZONES)),
        "resourceOriginExists20": origin.isNotNull(),
        "resourceOriginAllowed20": is_true(origin.isin(*V.ALLOWED_ORIGINS)),
    }
    df = df.withColumns({name: F.when(met, 20).otherwise(0) for name, met in parts.items()})
    points = reduce(Column.__add__, (F.col(name) for name in parts))
    df = df.withColumn("ScoreRaw", F.when(F.col("TagApplicable"), points).otherwise(100).cast("int"))

    def lacks(*names: str) -> Column:
        return reduce(Column.__and__, (F.col(n) == 0 for n in names))

    r = {k: F.lit(v) for k, v in V.TAG_REASONS.items()}
    reason = ladder(
        (~F.col("TagApplicable"), r["na"]),
        (~F.col("resourceFound"), r["not_found"]),
        (F.col("ScoreRaw") == 100, r["all_good"]),
        (lacks("sovereigntyZoneExists20", "resourceOriginExists20"), r["both_missing"]),
        (lacks("sovereigntyZoneExists20"), r["zone_missing"]),
        (lacks("resourceOriginExists20"), r["origin_missing"]),
        (lacks("sovereigntyZoneAllowed20", "resourceOriginAllowed20"), r["both_bad"]),
        (lacks("sovereigntyZoneAllowed20"), r["zone_bad"]),
        (lacks("resourceOriginAllowed20"), r["origin_bad"]),
        otherwise=r["partial"])
    na, full, part, bad = (F.lit(s) for s in V.TAG_STATES)
    state = ladder((~F.col("TagApplicable"), na), (F.col("ScoreRaw") == 100, full),
                   (F.col("ScoreRaw") >= V.TAG_PARTIAL_FROM, part), otherwise=bad)
    out = df.withColumns({"TagScorePct": F.col("ScoreRaw"), "TagState": state, "TagReason": reason,
                          "SnapshotTimeUtc": _stamp(run_ts)})
    return assert_exact_columns(out.select(*(F.col(c).alias(c) for c in V.TAG_CURRENT_COLUMNS)),
                                V.TAG_CURRENT_COLUMNS, "tag current")


def tag_history(current: DataFrame) -> DataFrame:
    """History shape of the tag scorecard. It has no N/A state, so N/A shows as compliant."""
    full, part, bad = (F.lit(s) for s in V.TAG_HISTORY_STATES)
    out = current.withColumns({
        "score": F.col("ScoreRaw"), "sovereignty_zone": F.col("SovereigntyZone"),
        "resource_origin": F.col("ResourceOrigin"), "snapshotTs": F.col("SnapshotTimeUtc"),
        "complianceStatus": ladder((F.col("TagScorePct") == 100, full),
                                   (F.col("TagScorePct") >= V.TAG_PARTIAL_FROM, part), otherwise=bad)})
    return out.select(*V.TAG_HISTORY_COLUMNS)


def score_residency(base: DataFrame, resource: DataFrame, bucket: DataFrame, rules: DataFrame,
                    run_ts: str, found: DataFrame | None = None) -> DataFrame:
    """Residency scorecard: is each product in the approved region it declares?"""
    places = resource_rollup(resource) if found is None else found.select("DataProductId", "place.*")
    declared = approved_region_lookup(
        base.select("DataProductId", "DataProductDisplayName", "DataProductDescription", "ResidencyRegion"),
        "ResidencyRegion", rules)
    df = declared.join(residency_evidence(base, places, bucket), "DataProductId")
    there = (F.col("AzureResourceFound") & F.col("IsApproved")
             & (normalise_id(F.col("AzureLocations")) == normalise_id(F.coalesce("RegionCode", F.lit("")))))
    bands = {k: verdict(b, "score", "reason") for k, b in V.RESIDENCY_BANDS.items()}
    band = ladder(
        (~F.col("AzureResourceFound"), bands["not_found"]),
        (F.col("RegionMissing"), bands["undeclared"]),
        (~F.col("IsApproved"), bands["not_approved"]),
        (~F.col("AzureLocationMatch"), bands["elsewhere"]),
        otherwise=bands["match"])
    out = df.withColumn("AzureLocationMatch", there).withColumn("_band", band).select(
        _stamp(run_ts).alias("SnapshotTimeUtc"), F.col("DataProductId").alias("DataProductID"),
        "DataProductDisplayName", "DataProductDescription",
        F.col("RegionName").alias("GlossaryResidencyRegionName"), F.col("RegionCode").alias("GlossaryResidencyRegionCode"),
        F.col("RegionMissing").alias("GlossaryResidencyMissing"), F.col("IsApproved").alias("IsApprovedResidency"),
        "AzureResourceFound", "AzureResourceCount", "AzureLocations", "AzureResourceIds", "AzureLocationMatch",
        F.col("_band.score").alias("ResidencyScorePct"), F.col("_band.reason").alias("ResidencyScoreReason"))
    return assert_exact_columns(out, V.RESIDENCY_COLUMNS, "residency current")


def score_cc(base: DataFrame, resource: DataFrame, patch: DataFrame, sku_rules: DataFrame, run_ts: str,
             variants: Sequence[str] = V.PRIMARY_PRODUCT_TAG, found: DataFrame | None = None) -> DataFrame:
    """Confidential-compute scorecard for products with full-name columns; others count as 100."""
    evidence = cc_evidence(resource, patch, base.filter("CCApplicable"), variants, found)
    df = sku_lookup(base.select("DataProductId", "DataProductDisplayName", "HasFullNameClassification",
                                "FullNameColumnCount", "CCApplicable").join(evidence, "DataProductId", "left"),
                    "VmSize", sku_rules)
    seen, applicable = is_true(F.col("resourceFound")), F.col("vmApplicable")
    no_sku = clean(F.col("VmSize")).isNull()
    bands = {k: verdict(b, "score", "status", "reason") for k, b in V.CC_BANDS.items()}
    rated = ladder(
        ((F.col("CCResourceKind") == "ArcMachine") & no_sku, bands["arc_no_model"]),
        ((F.col("CCResourceKind") == "AzureVM") & no_sku, bands["vm_no_size"]),
        (~F.col("IsConfidentialSku"), bands["not_confidential"]),
        (~F.col("IsApprovedSku"), bands["not_approved"]),
        otherwise=bands["approved"])
    band = ladder(
        (~F.col("CCApplicable"), bands["not_pii"]),
        (~seen, bands["not_found"]),
        (is_true(~applicable), bands["type_na"]),
        (is_true(applicable), rated),
        otherwise=bands["unknown"])
    out = df.withColumn("_band", band).withColumns({
        "SnapshotUtc": _stamp(run_ts), "CCForPIIScore": F.col("_band.score"), "CCForPIIStatus": F.col("_band.status"),
        "Reason": F.col("_band.reason"), "IsApprovedSku": F.col("CCApplicable") & F.col("IsApprovedSku"),
        "IsApprovedRegion": F.lit(None).cast("boolean")})
    return assert_exact_columns(out.select(*V.CC_COLUMNS), V.CC_COLUMNS, "cc current")


def json_defaults(df: DataFrame) -> DataFrame:
    """Fill absent audit texts: an empty list, or a note that says why there is nothing; cut long ones."""
    notes = F.when(~F.col("DefenderApplicable"), V.DEFENDER_NOTES["na"]).otherwise(V.DEFENDER_NOTES["no_result"])
    fills = {"resourcesJson": F.lit("[]"), "evaluatedResourcesJson": F.lit("[]"), "detailsJson": notes}
    return df.withColumns({c: F.substring(F.coalesce(c, f), 1, V.JSON_LIMIT) for c, f in fills.items()})


def defender_evidence(base: DataFrame, protection: DataFrame) -> DataFrame:
    """Protection evidence joined to the base; counts are zero where there is none, and where the check does not apply.

    ``protection`` are the counts of :func:`rollup_resources`.
    """
    counts = ["applicableResourceCount", "configuredResourceCount", "runningResourceCount", "highActiveAlertCount"]
    asked = F.col("DefenderApplicable")
    df = base.select("DataProductId", "DefenderApplicable").join(protection.withColumn("_found", F.lit(True)), "DataProductId", "left")
    return (df.withColumns({c: F.when(asked, F.coalesce(c, F.lit(0))).otherwise(0) for c in counts})
            .withColumn("resourceFound", asked & is_true(F.col("_found")))
            .withColumn("applicable", asked & (~F.col("resourceFound") | (F.col("applicableResourceCount") > 0)))
            .withColumn("hasUnhealthyAssessments", asked & is_true(F.col("hasUnhealthyAssessments"))).drop("_found"))


def judged_resources(base: DataFrame, resource: DataFrame, pricing: DataFrame, assessment: DataFrame,
                     alert: DataFrame) -> DataFrame:
    """Resources of the products the check applies to, with plan, check and alert facts."""
    asked = base.filter("DefenderApplicable").select("DataProductId")
    return defender_resources(tagged(resource).join(asked, "DataProductId", "left_semi"), pricing, assessment, alert)


def _protection_ladder(bands: dict[str, Column]) -> Column:
    return ladder(
        (~F.col("resourceFound"), bands["not_found"]),
        (~F.col("applicable"), bands["none_applicable"]),
        (F.col("configuredResourceCount") <= 0, bands["not_configured"]),
        (F.col("hasUnhealthyAssessments"), bands["unhealthy"]),
        (F.col("runningResourceCount") <= 0, bands["not_running"]),
        (F.col("highActiveAlertCount") > 0, bands["alerts"]),
        otherwise=bands["healthy"])


def defender_points(evidence: DataFrame, run_ts: str) -> DataFrame:
    """Score and state of every base product, without the audit texts."""
    bands = {k: verdict(b, "score", "state") for k, b in V.DEFENDER_BANDS.items()}
    band = F.when(~F.col("DefenderApplicable"), bands["na"]).otherwise(_protection_ladder(bands))
    return evidence.withColumn("_band", band).withColumns({
        "snapshotUtc": _stamp(run_ts), "progressScore": F.col("_band.score"), "progressState": F.col("_band.state")})


def score_defender(base: DataFrame, resource: DataFrame, pricing: DataFrame, assessment: DataFrame,
                   alert: DataFrame, run_ts: str) -> DataFrame:
    """Threat-protection scorecard with its audit texts. The judged resources are stored: counts and texts read them."""
    judged = stored(judged_resources(base, resource, pricing, assessment, alert))
    df = defender_points(defender_evidence(base, rollup_resources(judged)), run_ts)
    details = F.when(F.col("DefenderApplicable"), ladder(
        (~F.col("resourceFound"), F.lit(V.DEFENDER_NOTES["no_resource"])),
        (~F.col("applicable"), F.lit(V.DEFENDER_NOTES["none_applicable"])),
        otherwise=F.lit(V.DEFENDER_NOTES["evaluated"])))
    out = json_defaults(df.join(audit_resources(judged), "DataProductId", "left").withColumn("detailsJson", details))
    return assert_exact_columns(out.select(*(F.col(c).alias(c) for c in V.DEFENDER_COLUMNS)),
                                V.DEFENDER_COLUMNS, "defender current")


def defender_evidence_state(evidence: DataFrame, not_applicable_ids: DataFrame | None = None) -> DataFrame:
    """Score and state as the evidence layer names them; listed products are overridden to N/A."""
    bands = {k: verdict(b, "score", "state") for k, b in V.DEFENDER_EVIDENCE_STATES.items()}
    df = evidence.withColumn("_na", F.lit(False))
    if not_applicable_ids is not None:
        ids = not_applicable_ids.select("DataProductId", F.lit(True).alias("_listed")).distinct()
        df = df.join(ids, "DataProductId", "left").withColumn("_na", is_true(F.col("_listed")))
    band = F.when(F.col("_na"), bands["override"]).otherwise(_protection_ladder(bands))
    return df.withColumn("_band", band).select(
        "DataProductId", F.col("_band.score").alias("progressScore"), F.col("_band.state").alias("progressState"))


def _rounded_mean(score: Column) -> Column:
    return F.round(F.avg(score.cast("double")), 0).cast("int")


def patch_points() -> Column:
    """Patch score of a product row: no data 0, pending updates 50, otherwise 100."""
    status, pending = F.col("PatchAssessmentStatus"), F.coalesce("PendingUpdatesTotal", F.lit(0))
    return ladder((status == V.PATCH_NO_DATA, F.lit(0)), ((status == V.PATCH_ASSESSED) & (pending > 0), F.lit(50)),
                  otherwise=F.lit(100))


def score_patch(cc_current: DataFrame) -> DataFrame:
    return cc_current.groupBy("DataProductId").agg(_rounded_mean(patch_points()).alias("PatchComplianceScorePct"))


def score_avg_by_product(scorecard: DataFrame, key: str, score: str, name: str) -> DataFrame:
    return scorecard.groupBy(normalise_id(F.col(key)).alias("DataProductId")).agg(
        _rounded_mean(F.col(score)).alias(name))


def product_union(gold: DataFrame, cc: DataFrame, defender: DataFrame, tag: DataFrame) -> DataFrame:
    """Every product any table knows, ids normalised, with its largest name."""
    return _product_rows(gold, cc, defender, tag).groupBy("DataProductId").agg(
        F.max("DataProductDisplayName").alias("DataProductDisplayName"))


def _product_rows(gold: DataFrame, cc: DataFrame, defender: DataFrame, tag: DataFrame) -> DataFrame:
    """Narrow rows of product, name, domain and score. A confidential-compute row also has a patch score."""
    def rows(df: DataFrame, key: str, name: Column, scored: dict[str, Column] | None = None) -> DataFrame:
        pairs = (scored or {None: F.lit(None)}).items()
        narrow = F.array(*(F.struct(F.lit(d).cast("string").alias("domain"), c.cast("double").alias("score")) for d, c in pairs))
        return df.select(normalise_id(F.col(key)).alias("DataProductId"), name.alias("DataProductDisplayName"), F.inline(narrow))

    nameless = F.lit(None).cast("string")
    return reduce(DataFrame.unionByName, [
        rows(gold, "DataProductID", F.col("DataProductDisplayName")),
        rows(cc, "DataProductId", F.col("DataProductDisplayName"), {"cc": F.col("CCForPIIScore"), "patch": patch_points()}),
        rows(defender, "dataProductId", nameless, {"defender": F.col("progressScore")}),
        rows(tag, "dataProductId", F.col("dataProductDisplayName"), {"tag": F.col("TagScorePct")}),
    ])


def compliance_summary(gold: DataFrame, residency: DataFrame, cc: DataFrame, defender: DataFrame,
                       tag: DataFrame) -> DataFrame:
    """Five mean scores per product; null where a domain has no row.

    All tables are stacked as narrow rows and meet in one aggregation, so there is one shuffle
    instead of one per table. Residency rows add scores but not products.
    """
    places = residency.select(
        normalise_id(F.col("DataProductID")).alias("DataProductId"), F.lit(None).cast("string").alias("DataProductDisplayName"),
        F.lit("residency").alias("domain"), F.col("ResidencyScorePct").cast("double").alias("score"))
    rows = _product_rows(gold, cc, defender, tag).withColumn("known", F.lit(True)).unionByName(
        places.withColumn("known", F.lit(False)))
    means = {"ResidencyScorePct": "residency", "CCScorePct": "cc", "DefenderScorePct": "defender",
             "TagScorePct": "tag", "PatchComplianceScorePct": "patch"}
    return (rows.groupBy("DataProductId")
            .agg(F.max("DataProductDisplayName").alias("DataProductDisplayName"), F.bool_or("known").alias("known"),
                 *(_rounded_mean(F.when(F.col("domain") == d, F.col("score"))).alias(c) for c, d in means.items()))
            .filter("known").select(*V.SUMMARY_COLUMNS))
