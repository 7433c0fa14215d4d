"""Evidence about cloud resources, per resource and per product.

The input ``resource`` frame has ResourceId, ResourceType, SubscriptionId, ResourceGroup, Location, a
``Tags`` map and a ``Properties`` JSON text. An optional ``ArmError`` column carries read errors.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from govmill.functions import fixed_values as V
from govmill.functions.columns import (
    assessment_id, bucket_region, clean, defender_candidate_plans, is_compute, is_true, joined, ladder,
    normalise_code, normalise_id, parse_bool, resource_kind, resource_name, subscription_of,
    sum_nested_counts, tag_value,
)
from govmill.functions.schemas import resolve_columns
from govmill.operators.keyed import first_per_key, sample_per_key
from govmill.session import stored

_PROPERTIES = (
    "hardwareProfile struct<vmSize:string>, securityProfile struct<securityType:string>, "
    "detectedProperties struct<model:string,cloudprovider:string,manufacturer:string>, "
    "status string, osType string, osSku string, virtualMachineResourceId string"
)


def parse_resource_id(resource: DataFrame) -> DataFrame:
    rid = F.col("ResourceId")
    return resource.select("ResourceId", resource_name(rid).alias("ResourceName"),
                           subscription_of(rid).alias("SubscriptionId"))


def tagged(resource: DataFrame, variants: Sequence[str] = V.PRODUCT_TAGS) -> DataFrame:
    """Resources that name a product in a tag, with the lower-case product id."""
    return (resource.withColumn("DataProductId", F.trim(tag_value(F.col("Tags"), tuple(variants))))
            .filter("DataProductId <> ''"))


def extract_properties(resource: DataFrame) -> DataFrame:
    """Flat columns out of the property bag, parsed once."""
    p = resource.withColumn("_p", F.from_json("Properties", _PROPERTIES))
    names = {
        "VmSize": "hardwareProfile.vmSize", "SecurityType": "securityProfile.securityType",
        "ArcModel": "detectedProperties.model", "ArcCloudProvider": "detectedProperties.cloudprovider",
        "ArcManufacturer": "detectedProperties.manufacturer", "ArcStatus": "status", "ArcOsType": "osType",
        "ArcOsSku": "osSku", "LinkedVmId": "virtualMachineResourceId",
    }
    return p.select(*resource.columns, *(clean(F.col(f"_p.{path}")).alias(n) for n, path in names.items()))


def union_tenants(frames: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """Stack one inventory frame per tenant; columns a tenant lacks become null."""
    stamped = (df.withColumn("TenantId", F.lit(tenant)) for tenant, df in frames)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), stamped).withColumn(
        "IsConfidentialBool", F.col("IsConfidential") == 1)


def virtual_machines(resource: DataFrame, run_ts: str, variants: Sequence[str] = V.PRIMARY_PRODUCT_TAG) -> DataFrame:
    """Virtual machines that carry a product tag, with their confidential flag."""
    vms = tagged(resource, variants).filter(normalise_id(F.col("ResourceType")) == V.VM_TYPE)
    security = F.get_json_object("Properties", "$.securityProfile.securityType")
    return vms.select(
        F.lit(run_ts).alias("SnapshotUtc"), "DataProductId", F.col("ResourceId").alias("ComputeResourceId"),
        resource_name(F.col("ResourceId")).alias("ComputeName"), "ResourceGroup", "SubscriptionId", "Location",
        security.alias("SecurityType"),
        is_true(F.lower(security) == V.CONFIDENTIAL_SECURITY_TYPE).cast("int").alias("IsConfidential"))


def compute_inventory(resource: DataFrame, tenants: dict[str, Sequence[str]], run_ts: str) -> DataFrame:
    """Tagged virtual machines of all tenants. ``tenants`` maps a tenant to its subscriptions.

    One scan serves every tenant: the tenant is looked up by subscription.
    """
    owner = {s: t for t, subs in tenants.items() for s in subs}
    tenant = F.create_map(*(F.lit(x) for pair in owner.items() for x in pair))
    return (virtual_machines(resource.filter(F.col("SubscriptionId").isin(*owner)), run_ts)
            .withColumn("TenantId", F.try_element_at(tenant, F.col("SubscriptionId")))
            .withColumn("IsConfidentialBool", F.col("IsConfidential") == 1))


def vm_rollup(inventory: DataFrame) -> DataFrame:
    return inventory.groupBy(F.lower("DataProductId").alias("DataProductId")).agg(
        F.count("*").alias("ComputeVmCount"), F.max("IsConfidential").alias("AnyConfidential"))


def _sensitive(classification: DataFrame) -> DataFrame:
    return classification.filter("HasFullNameClassification = 1").select(
        F.lower("DataProductId").alias("DataProductId"), "DataProductDisplayName", "FullNameColumnCount")


def gap_not_confidential(classification: DataFrame, inventory: DataFrame, run_ts: str) -> DataFrame:
    """Sensitive products that run on virtual machines, none of them confidential."""
    return (_sensitive(classification).join(vm_rollup(inventory).filter("AnyConfidential = 0"), "DataProductId")
            .select(F.lit(run_ts).cast("timestamp").alias("SnapshotUtc"), "DataProductId",
                    "DataProductDisplayName", "FullNameColumnCount", "ComputeVmCount",
                    F.col("AnyConfidential").alias("IsConfidentialCompute")))


def gap_no_compute(classification: DataFrame, inventory: DataFrame, run_ts: str) -> DataFrame:
    """Sensitive products without a mapped virtual machine."""
    mapped = inventory.select(F.lower("DataProductId").alias("DataProductId"))
    return (_sensitive(classification).join(mapped, "DataProductId", "left_anti")
            .select(F.lit(run_ts).cast("timestamp").alias("SnapshotUtc"), "DataProductId",
                    "DataProductDisplayName", "FullNameColumnCount",
                    F.lit(0).cast("bigint").alias("ComputeVmCount")))


def resource_rollup(resource: DataFrame) -> DataFrame:
    """Per product: is there a resource, how many, where, and which.

    Places and ids are made distinct before they are gathered, so a product's list holds each once.
    """
    return tagged(resource).groupBy("DataProductId").agg(*_place_columns())


def _place_columns() -> list[Column]:
    return [F.lit(True).alias("AzureResourceFound"), F.count("*").cast("int").alias("AzureResourceCount"),
            joined(F.collect_set(normalise_code(F.col("Location")))).alias("AzureLocations"),
            joined(F.collect_set(clean(F.col("ResourceId")))).alias("AzureResourceIds")]


#: What the confidential-compute check reads of a product's chosen resource, after the order that chooses it.
_CHOSEN = ("ResourceId", "ResourceType", "SubscriptionId", "ResourceGroup", "Location", "ArmError", "VmSize", "SecurityType", "ArcModel", "LinkedVmId")
_TAG = ("ResourceId", "ResourceType", "SubscriptionId", "ResourceGroup", "Location")


def governed_tag(name: str) -> Column:
    return normalise_code(tag_value(F.col("Tags"), (name,)))


def product_evidence(resource: DataFrame, pricing: DataFrame | None = None, assessment: DataFrame | None = None,
                     alert: DataFrame | None = None, variants: Sequence[str] = V.PRIMARY_PRODUCT_TAG) -> DataFrame:
    """Evidence of all domains, one row per product, from one pass over the resources.

    ``tag`` and ``chosen`` are the resources that the tag and the confidential-compute check look at, among those that name the product in
    one of ``variants``; ``place`` and, with the three security frames, ``protection`` cover all spellings. Store the result:
    each scorecard reads its own column of it.
    """
    if tuple(V.PRODUCT_TAGS[: len(variants)]) != tuple(variants):
        raise ValueError("the spellings of the tag checks must come first among all spellings")
    r = extract_properties(_with_error(tagged(resource)))
    # The spellings come in this order, so a resource with one of the first has the same product by either list.
    r = r.withColumn("_own", is_true(F.trim(tag_value(F.col("Tags"), tuple(variants))) != ""))
    r = r.withColumn("vmApplicable", is_compute(F.col("ResourceType")))
    parts = [F.struct(*_place_columns()).alias("place"),
             F.min(F.when(F.col("_own"), F.struct(*_TAG, governed_tag(V.ZONE_TAG).alias("SovereigntyZone"), governed_tag(V.ORIGIN_TAG).alias("ResourceOrigin")))).alias("tag"),
             F.min(F.when(F.col("_own"), F.struct((~F.col("vmApplicable")).alias("_other"), *_CHOSEN))).alias("chosen")]
    if pricing is not None:
        r = _judged(r, pricing, assessment, alert)
        parts.append(F.struct(*_protection_columns()).alias("protection"))
    return r.groupBy("DataProductId").agg(*parts)


def chosen_resources(found: DataFrame) -> DataFrame:
    """The chosen resource of each product in :func:`product_evidence`."""
    return found.filter("chosen IS NOT NULL").select("DataProductId", "chosen.*").withColumn("vmApplicable", ~F.col("_other")).drop("_other")


def _with_error(resource: DataFrame) -> DataFrame:
    return resource if "ArmError" in resource.columns else resource.withColumn("ArmError", F.lit(None).cast("string"))


def override_join(primary: DataFrame, fallback: DataFrame, key: str) -> DataFrame:
    """Primary rows with the fallback's values in front wherever the fallback has the key."""
    values = [c for c in primary.columns if c != key]
    front = fallback.select(key, *(F.col(c).alias(f"_f_{c}") for c in values))
    return primary.join(front, key, "left").select(
        key, *(F.coalesce(f"_f_{c}", c).alias(c) for c in values))


def bucket_places(bucket: DataFrame) -> DataFrame:
    """One place per bucket name; object-storage products have the name of their bucket."""
    places = bucket.select("bucketName", F.lower(bucket_region(F.col("bucketLocation"))).alias("bucketPlace"))
    return first_per_key(places, ["bucketName"], ["bucketPlace"])


def residency_evidence(base: DataFrame, places: DataFrame, bucket: DataFrame) -> DataFrame:
    """Place evidence for every product: resources (:func:`resource_rollup`) first, a bucket where there is no resource."""
    found = base.select("DataProductId", "DataProductDisplayName", "IsS3").join(places, "DataProductId", "left")
    buckets = bucket_places(bucket)
    full = found.join(
        buckets, (found["DataProductDisplayName"] == buckets["bucketName"]) & found["IsS3"]
        & found["AzureResourceFound"].isNull(), "left")
    bucket_arn = F.concat(F.lit("arn:aws:s3:::"), "bucketName")
    return full.select(
        "DataProductId",
        (F.col("bucketName").isNotNull() | is_true(F.col("AzureResourceFound"))).alias("AzureResourceFound"),
        F.coalesce("AzureResourceCount", F.col("bucketName").isNotNull().cast("int")).alias("AzureResourceCount"),
        F.coalesce("bucketPlace", "AzureLocations", F.lit("")).alias("AzureLocations"),
        F.coalesce(bucket_arn, "AzureResourceIds", F.lit("")).alias("AzureResourceIds"))


def approved_regions(rules: DataFrame) -> DataFrame:
    """Rule rows as code, name, approved and notes, whatever the columns are called; one per code."""
    name, code, approved = (resolve_columns(rules, V.APPROVED_COLUMN_NAMES[k]) for k in ("name", "code", "approved"))
    return first_per_key(
        rules.select(normalise_code(F.col(f"`{code}`")).alias("RegionCode"), F.trim(F.col(f"`{name}`")).alias("RegionName"),
                     parse_bool(F.col(f"`{approved}`")).alias("IsApproved")).filter("RegionCode IS NOT NULL"),
        ["RegionCode"], ["RegionName"])


def approved_region_lookup(values: DataFrame, column: str, rules: DataFrame) -> DataFrame:
    """Match text with approved regions by code or by name; a code match wins.

    Both spellings go into one lookup, so the values are joined once. Text that matches nothing stays
    as its own code and name, unapproved.
    """
    yes = approved_regions(rules).filter("IsApproved")
    spellings = yes.select(F.col("RegionCode").alias("_text"), F.lit(0).alias("_by"), "RegionCode", "RegionName").unionByName(
        yes.select(normalise_id(F.col("RegionName")).alias("_text"), F.lit(1).alias("_by"), "RegionCode", "RegionName"))
    lookup = first_per_key(spellings, ["_text"], ["_by", "RegionCode"]).select(
        "_text", F.col("RegionCode").alias("_code"), F.col("RegionName").alias("_name"))
    text = F.col(column)
    missing = F.coalesce(normalise_id(text), F.lit("")).isin(*V.MISSING_REGION_WORDS)
    return (values.join(lookup, normalise_id(text) == F.col("_text"), "left")
            .withColumn("RegionMissing", missing)
            .withColumn("RegionCode", F.coalesce("_code", F.when(~missing, normalise_id(text))))
            .withColumn("RegionName", F.coalesce("_name", F.when(~missing, F.trim(text))))
            .withColumn("IsApproved", ~missing & F.col("_text").isNotNull())
            .drop("_text", "_code", "_name"))


def sku_rule_rollup(rules: DataFrame) -> DataFrame:
    """One row per size; approved when any row approves it."""
    return (rules.select(normalise_code(F.col("sku")).alias("sku_lc"), is_true(F.col("is_approved").cast("boolean")).alias("ok"))
            .filter("sku_lc IS NOT NULL").groupBy("sku_lc").agg(F.bool_or("ok").alias("approved")))


def sku_lookup(evidence: DataFrame, column: str, rules: DataFrame) -> DataFrame:
    """Is a size or model in the rule list, and approved there?"""
    return (evidence.join(sku_rule_rollup(rules), normalise_id(F.col(column)) == F.col("sku_lc"), "left")
            .withColumn("IsConfidentialSku", F.col("sku_lc").isNotNull())
            .withColumn("IsApprovedSku", is_true(F.col("approved"))).drop("sku_lc", "approved"))


def prefer_applicable_resource(resource: DataFrame, variants: Sequence[str] = V.PRIMARY_PRODUCT_TAG) -> DataFrame:
    """One resource per product: a compute type beats any other, then the smallest id."""
    t = tagged(resource, variants).withColumn("vmApplicable", is_compute(F.col("ResourceType")))
    return first_per_key(t, ["DataProductId"], [F.desc("vmApplicable"), "ResourceId"])


def linked_vm_lookup(chosen: DataFrame, resource: DataFrame) -> DataFrame:
    """Size and security type of the virtual machine behind each SQL virtual machine.

    ``chosen`` has the extracted properties; ``resource`` is every resource.
    """
    linked = chosen.filter((normalise_id(F.col("ResourceType")) == V.SQLVM_TYPE) & F.col("LinkedVmId").isNotNull()).select(
        "ResourceId", F.lower("LinkedVmId").alias("_vm"))
    vms = resource.filter(normalise_id(F.col("ResourceType")) == V.VM_TYPE).select(
        F.lower("ResourceId").alias("_vm"), "ResourceId", "Properties")
    details = first_per_key(extract_properties(vms), ["_vm"], ["ResourceId"]).select(
        "_vm", F.col("VmSize").alias("LinkedVmSize"), F.col("SecurityType").alias("LinkedSecurityType"))
    return linked.join(details, "_vm", "left").select("ResourceId", "LinkedVmSize", "LinkedSecurityType")


def patch_lookup(chosen: DataFrame, patch: DataFrame) -> DataFrame:
    """Patch state of each product's machine; a SQL virtual machine is judged by the machine behind it."""
    kind = normalise_id(F.col("ResourceType"))
    target = F.lower(F.when(kind.isin(V.VM_TYPE, V.ARC_TYPE), clean(F.col("ResourceId")))
                     .when(kind == V.SQLVM_TYPE, F.col("LinkedVmId")))
    # Products without a target keep a join key of their own, so they do not meet in one task.
    wanted = chosen.select("DataProductId", target.isNotNull().alias("_has_target"), F.coalesce(
        F.lower(assessment_id(target)), F.concat(F.lit("none:"), "DataProductId")).alias("_target"))
    reports = patch.select(F.lower("assessment_id").alias("_aid"), "counts_json",
                           F.coalesce("startDateTime", "lastModifiedDateTime").alias("LastUpdateScanUtc"))
    # Only reports that a product asks for are counted.
    asked = wanted.join(reports, F.col("_target") == F.col("_aid"), "left").withColumn(
        "PendingUpdatesTotal", sum_nested_counts(F.col("counts_json")))
    return first_per_key(asked, ["DataProductId"], [F.desc("LastUpdateScanUtc"), "PendingUpdatesTotal"]).select(
        "DataProductId", "LastUpdateScanUtc", "PendingUpdatesTotal",
        ladder((F.col("_aid").isNotNull(), F.lit(V.PATCH_ASSESSED)),
               (F.col("_has_target"), F.lit(V.PATCH_NO_DATA))).alias("PatchAssessmentStatus"))


def cc_evidence(resource: DataFrame, patch: DataFrame, products: DataFrame | None = None,
                variants: Sequence[str] = V.PRIMARY_PRODUCT_TAG, found: DataFrame | None = None) -> DataFrame:
    """Confidential-compute evidence, one row per product.

    ``products`` limits the work to some product ids before any resource is looked up; ``found`` is the
    stored :func:`product_evidence`, without which the resources are chosen here.
    """
    resource = _with_error(resource)
    if found is None:
        chosen = extract_properties(prefer_applicable_resource(tagged(resource, variants), variants))
    else:
        chosen = chosen_resources(found)
    if products is not None:
        chosen = chosen.join(products.select("DataProductId"), "DataProductId", "left_semi")
    # One row per product, read three times below.
    chosen = stored(chosen)
    linked = linked_vm_lookup(chosen, resource)
    kind = resource_kind(F.col("ResourceType"))
    full = (chosen.join(linked, "ResourceId", "left").join(patch_lookup(chosen, patch), "DataProductId", "left")
            .withColumn("CCResourceKind", F.coalesce(kind, F.lit("NotApplicable"))))
    k = F.col("CCResourceKind")
    size = ladder((k == "ArcMachine", F.col("ArcModel")), (k == "AzureVM", F.col("VmSize")),
                  (k == "SqlVirtualMachine", F.col("LinkedVmSize")))
    security = ladder(((k == "AzureVM") & F.col("VmSize").isNotNull(), F.col("SecurityType")),
                      ((k == "SqlVirtualMachine") & F.col("LinkedVmSize").isNotNull(), F.col("LinkedSecurityType")))
    unread = ((k == "AzureVM") & F.col("VmSize").isNull()) | (
        (k == "SqlVirtualMachine") & F.col("LinkedVmId").isNotNull() & F.col("LinkedVmSize").isNull())
    note = ladder(
        (k == "NotApplicable", F.lit(V.CC_NOTES["type_na"])),
        (k == "ArcMachine", F.lit(V.CC_NOTES["arc"])),
        ((k == "AzureVM") & unread, F.lit(V.CC_NOTES["vm_unread"])),
        (k == "AzureVM", F.lit(V.CC_NOTES["vm"])),
        (F.col("LinkedVmId").isNull(), F.lit(V.CC_NOTES["sqlvm_unlinked"])),
        (unread, F.lit(V.CC_NOTES["sqlvm_unread"])),
        otherwise=F.lit(V.CC_NOTES["sqlvm"]))
    return full.select(
        "DataProductId", F.lit(True).alias("resourceFound"), "vmApplicable", "CCResourceKind", "ResourceId",
        "ResourceType", "SubscriptionId", "ResourceGroup", normalise_id(F.col("Location")).alias("Location"),
        size.alias("VmSize"), security.alias("SecurityType"), note.alias("DetailsNote"),
        F.when(unread, F.col("ArmError")).alias("ArmError"),
        "LastUpdateScanUtc", "PendingUpdatesTotal", "PatchAssessmentStatus")


def assessment_counts(assessment: DataFrame) -> DataFrame:
    status = F.lower(F.trim("statusCode"))
    known = ("healthy", "unhealthy", "notapplicable")
    return assessment.groupBy(F.lower("resource_id").alias("resource_id")).agg(
        F.count("*").alias("total"), F.count_if(status == "healthy").alias("healthy"),
        F.count_if(status == "unhealthy").alias("unhealthy"),
        F.count_if(status == "notapplicable").alias("notApplicable"),
        F.count_if(~is_true(status.isin(*known))).alias("unknown"))


def assessment_rollup(assessment: DataFrame) -> DataFrame:
    """Counts by status per resource, and the first few checks by name and date as a sample."""
    a = assessment.withColumn("resource_id", F.lower("resource_id"))
    order = ["displayName", "statusCode", "statusChangeDate"]
    sample = sample_per_key(a, "resource_id", order, order, V.SAMPLE_SIZE, "sample")
    return assessment_counts(a).join(sample, "resource_id")


def active_high_alerts(alert: DataFrame) -> DataFrame:
    return alert.filter((F.lower("status") == "active") & (F.lower("severity") == "high")
                        & (clean(F.col("resource_id")).isNotNull())).withColumn("resource_id", F.lower("resource_id"))


def alert_rollup(alert: DataFrame) -> DataFrame:
    """Active, high alerts per resource: how many, and the first few by id."""
    a = active_high_alerts(alert)
    counts = a.groupBy("resource_id").agg(F.count("*").alias("highActiveCount"))
    sample = sample_per_key(a, "resource_id", ["systemAlertId", "startTimeUtc"],
                            ["systemAlertId", "severity", "status", "startTimeUtc"], V.SAMPLE_SIZE, "sample")
    return counts.join(sample, "resource_id")


def pricing_map(pricing: DataFrame) -> DataFrame:
    """One tier per subscription and known plan; of several the alphabetically last."""
    return (pricing.select(clean(F.col("SubscriptionId")).alias("SubscriptionId"),
                           normalise_code(F.col("plan_name")).alias("plan"), F.trim("pricingTier").alias("tier"))
            .filter(F.col("SubscriptionId").isNotNull() & F.col("plan").isin(*V.THREAT_PLANS))
            .groupBy("SubscriptionId", "plan").agg(F.max("tier").alias("tier")))


def defender_resources(resource: DataFrame, pricing: DataFrame, assessment: DataFrame, alert: DataFrame) -> DataFrame:
    """Per resource: can a plan cover it, is one switched on, is it running, how many alerts."""
    return _judged(tagged(resource), pricing, assessment, alert)


def _judged(named: DataFrame, pricing: DataFrame, assessment: DataFrame, alert: DataFrame) -> DataFrame:
    standard = pricing_map(pricing).filter(F.lower("tier") == "standard").groupBy("SubscriptionId").agg(
        F.collect_set("plan").alias("_on"))
    checks = assessment_counts(assessment).select("resource_id", "total", "unhealthy")
    alerts = active_high_alerts(alert).groupBy("resource_id").agg(F.count("*").alias("highActive"))
    r = (named.withColumn("plans", defender_candidate_plans(F.col("ResourceType")))
         .withColumn("isApplicable", F.size("plans") > 0)
         .withColumn("resource_id", F.lower(F.trim("ResourceId"))))
    return (r.join(standard, "SubscriptionId", "left").join(checks, "resource_id", "left")
            .join(alerts, "resource_id", "left")
            .withColumn("isConfigured", F.col("isApplicable") & is_true(F.arrays_overlap("plans", "_on")))
            .withColumns({c: F.when(F.col("isApplicable"), F.coalesce(c, F.lit(0))) for c in ("total", "unhealthy", "highActive")})
            .withColumn("hasAssessments", is_true(F.col("total") > 0))
            .withColumn("isRunning", F.col("isConfigured") & F.col("hasAssessments"))
            .drop("_on"))


def defender_rollup(resource: DataFrame, pricing: DataFrame, assessment: DataFrame, alert: DataFrame) -> DataFrame:
    """Protection evidence per product."""
    return rollup_resources(defender_resources(resource, pricing, assessment, alert))


def rollup_resources(judged: DataFrame) -> DataFrame:
    """Product counts from judged resources (:func:`defender_resources`)."""
    return judged.groupBy("DataProductId").agg(*_protection_columns())


def _protection_columns() -> list[Column]:
    return [F.count_if("isApplicable").cast("int").alias("applicableResourceCount"),
            F.count_if("isConfigured").cast("int").alias("configuredResourceCount"),
            F.count_if("isRunning").cast("int").alias("runningResourceCount"),
            F.coalesce(F.sum("highActive"), F.lit(0)).cast("int").alias("highActiveAlertCount"),
            is_true(F.bool_or(F.col("unhealthy") > 0)).alias("hasUnhealthyAssessments")]


def evaluation_rows(resource: DataFrame, pricing: DataFrame, assessment: DataFrame, alert: DataFrame) -> DataFrame:
    """The whole evaluation, one row per product and resource: what the audit texts hold, never cut.

    Plans and alerts of a resource are rows of their own: :func:`plan_rows`, :func:`alert_rows`.
    """
    checks = assessment_counts(assessment).select("resource_id", "healthy", F.col("unhealthy").alias("_unhealthy"), "notApplicable", "unknown")
    r = defender_resources(resource, pricing, assessment, alert).join(checks, "resource_id", "left")

    def count(c: str) -> Column:
        return F.when(F.col("isApplicable"), F.coalesce(c, F.lit(0)))

    return r.select(
        "DataProductId", "ResourceId", resource_name(F.col("ResourceId")).alias("ResourceName"), "ResourceType", "SubscriptionId", "ResourceGroup", "Location",
        F.col("isApplicable").alias("defenderApplicable"), F.col("isConfigured").alias("defenderConfigured"), "hasAssessments",
        F.col("isRunning").alias("defenderRunning"), F.col("total").alias("assessmentsTotal"), count("healthy").alias("healthy"),
        count("_unhealthy").alias("unhealthy"), count("notApplicable").alias("notApplicable"), count("unknown").alias("unknown"),
        F.col("highActive").alias("highActiveAlerts"))


def plan_rows(resource: DataFrame, pricing: DataFrame) -> DataFrame:
    """One row per product, resource and plan that could cover it, with the plan's tier in its subscription."""
    asked = tagged(resource).select("DataProductId", "ResourceId", "SubscriptionId", F.explode(defender_candidate_plans(F.col("ResourceType"))).alias("plan"))
    return asked.join(pricing_map(pricing), ["SubscriptionId", "plan"], "left").select("DataProductId", "ResourceId", "plan", "tier")


def alert_rows(resource: DataFrame, alert: DataFrame) -> DataFrame:
    """Every active, high alert of a product's resources."""
    named = tagged(resource).select("DataProductId", "ResourceId", F.lower(F.trim("ResourceId")).alias("resource_id"))
    return named.join(active_high_alerts(alert), "resource_id").select(
        "DataProductId", "ResourceId", "systemAlertId", "severity", "status", "startTimeUtc")


def defender_audit_json(resource: DataFrame, pricing: DataFrame, assessment: DataFrame, alert: DataFrame) -> DataFrame:
    """Audit texts per product: its resources, and the evaluation of those a plan can cover.

    Texts are cut at a fixed length. One entry is never shorter than ``least``, so only that many
    leading resources of a product can reach the text, and only those are gathered.
    """
    return audit_resources(defender_resources(resource, pricing, assessment, alert))


def audit_resources(r: DataFrame) -> DataFrame:
    """Audit texts from judged resources (:func:`defender_resources`)."""
    least = 70
    most = V.JSON_LIMIT // least + 1
    where = ("ResourceId", "ResourceType", "SubscriptionId", "ResourceGroup", "Location")
    plain = F.struct(
        F.col("ResourceId").alias("id"), resource_name(F.col("ResourceId")).alias("name"),
        *(F.col(c).alias(n) for c, n in zip(where[1:], ("type", "subscriptionId", "resourceGroup", "location"))),
        F.col("plans").alias("defenderCandidatePlans"), F.col("isApplicable").alias("defenderApplicable"))
    judged = F.struct(
        F.col("ResourceId").alias("id"), F.col("plans").alias("candidatePlans"),
        F.col("isConfigured").alias("defenderConfigured"), "hasAssessments",
        F.col("isRunning").alias("defenderRunning"), F.col("total").alias("assessmentsTotal"),
        F.col("unhealthy").alias("assessmentsUnhealthy"), F.col("highActive").alias("highActiveAlerts"))

    def text(rows: DataFrame, item, name: str) -> DataFrame:
        items = sample_per_key(rows.withColumn("_item", item), "DataProductId", ["ResourceId"], ["_item"], most, "_items")
        return items.select("DataProductId", F.substring(
            F.to_json(F.transform("_items", lambda i: i["_item"])), 1, V.JSON_LIMIT).alias(name))

    return text(r, plain, "resourcesJson").join(
        text(r.filter("isApplicable"), judged, "evaluatedResourcesJson"), "DataProductId", "left")
