"""Texts, codes, limits and column orders that results must carry exactly.

Nothing here is logic. Consumers compare these strings, so they are stated as plain text.
"""

# Tag rules.
ALLOWED_ORIGINS = ("arc", "azure")
ALLOWED_ZONES = ("standard", "comprehensive")
ORIGIN_TAG = "resource-origin"
ZONE_TAG = "sovereignty-zone"
PRODUCT_TAGS = ("dataproductid", "DataProductID", "DataProductId")
PRIMARY_PRODUCT_TAG = ("dataproductid",)
INVESTIGATE_TAG = ("compliance-status", "investigate")

# Resource types, lower case.
VM_TYPE = "microsoft.compute/virtualmachines"
ARC_TYPE = "microsoft.hybridcompute/machines"
SQLVM_TYPE = "microsoft.sqlvirtualmachine/sqlvirtualmachines"
STORAGE_TYPE = "microsoft.storage/storageaccounts"
SQL_PREFIX = "microsoft.sql/"
NO_PLAN_PREFIXES = ("microsoft.fabric/", "microsoft.powerbi/")
RESOURCE_KINDS = {VM_TYPE: "AzureVM", ARC_TYPE: "ArcMachine", SQLVM_TYPE: "SqlVirtualMachine"}
THREAT_PLANS = ("virtualmachines", "sqlservers", "sqlservervirtualmachines", "storageaccounts")
PATCH_SUFFIX = "/patchAssessmentResults/latest"
CONFIDENTIAL_SECURITY_TYPE = "confidentialvm"

# Patterns and limits.
GUID_PATTERN = "^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"
S3_ARN_PATTERN = r"^arn:aws:s3:::([a-zA-Z0-9.\-_]{3,63})$"
DEFAULT_BUCKET_REGION = "us-east-1"
ASOF_SECONDS = 21600
SPIKE_THRESHOLD = 0.05
RECENT_HOURS = 168
SAMPLE_SIZE = 5
JSON_LIMIT = 200000
UNASSIGNED_REGION = "Unknown (not assigned)"
MISSING_REGION_WORDS = ("", "unknown", "unknown (not assigned)", "undefined")
APPROVED_COLUMN_NAMES = {
    "name": ("Region Name", "RegionName", "region_name", "regionName"),
    "code": ("Region Code", "RegionCode", "region_code", "regionCode"),
    "approved": ("Approved", "approved", "IsApproved", "isApproved"),
}

# Boolean spellings.
YES_WORDS = ("yes", "y", "true", "1")
NO_WORDS = ("no", "n", "false", "0")
REQUEST_YES_WORDS = ("1", "true", "t", "yes", "y")
REQUEST_NO_WORDS = ("0", "false", "f", "no", "n")

# Words that place a product in a category (name and description, lower case).
CATEGORY_WORDS = {
    "IsFabric": ("fabric",),
    "IsS3": ("amazon s3", " s3", "s3-", "s3 "),
    "IsSqlPaaS": ("azure sql database",),
    "IsStorage": ("data lake", "adls", "storage account", "azure files"),
    "IsVmLike": ("iaas", " vm", "virtual machine", "sap s/4"),
    "IsHybridComputeMachine": (
        "microsoft.hybridcompute/machines", "hybridcompute/machines", "hybrid compute",
        "azure arc", "arc-enabled", "arc enabled",
    ),
}
SQL_PAAS_EXCLUDED_WORD = "iaas"

# Tag score: state names and reasons.
TAG_STATES = ("NotApplicable", "Compliant", "Partial", "NonCompliant")
TAG_HISTORY_STATES = ("compliant", "partial", "noncompliant")
TAG_PARTIAL_FROM = 60
TAG_REASONS = {
    "na": "Tag check is not applicable for this data product (external/S3). N/A treated as compliant (100%).",
    "not_found": "Couldn’t find the Azure resource (dataproductid tag not matched in searched subscriptions).",
    "all_good": "Required tags are present and allowed (sovereignty-zone, resource-origin).",
    "both_missing": "Both required tags are missing: sovereignty-zone and resource-origin.",
    "zone_missing": "Missing required tag: sovereignty-zone.",
    "origin_missing": "Missing required tag: resource-origin.",
    "both_bad": "Both tag values are not allowed: sovereignty-zone and resource-origin.",
    "zone_bad": "Tag value for sovereignty-zone is not allowed.",
    "origin_bad": "Tag value for resource-origin is not allowed.",
    "partial": "Tag compliance partially met.",
}

# Residency score: (score, reason).
RESIDENCY_BANDS = {
    "not_found": (0, "Could not find Data Product's associated Azure or AWS S3 resource using the dataproductid tag"),
    "undeclared": (25, "Found associated Azure/S3 resource but Purview is missing residency (glossary) as per dp_dataproductresidency_gold"),
    "not_approved": (50, "Found associated Azure/S3 resource + Purview residency (glossary) present, but does not match approved region list (rs_approved_regions)"),
    "elsewhere": (75, "Found associated Azure/S3 resource + Purview residency present and approved, but does not match the associated resource's region"),
    "match": (100, "Found associated Azure/S3 resource + Purview residency present and approved + matches the associated resource's region"),
}

# Confidential-compute score: (score, status, reason).
_CC_NA = "The azure resource is not applicable for confidential compute. N/A is a 100% score"
CC_BANDS = {
    "not_pii": (100, "NA_NotPII", _CC_NA),
    "not_found": (0, "NotFound", "Couldn’t find the respective azure resource for the data product"),
    "type_na": (100, "NA_NotApplicable", _CC_NA),
    "arc_no_model": (50, "Applicable", "Found the resource but not running confidential compute or arc model property is null/empty"),
    "vm_no_size": (25, "Applicable", "Found the azure/arc/sql vm resource and it is a confidential compute applicable resource (azure vm or arc machine)"),
    "not_confidential": (50, "Applicable", "Found the resource but not running confidential compute"),
    "not_approved": (75, "Applicable", "Found the resource but not running the approved confidential compute sku"),
    "approved": (100, "Applicable", "Found the resource running the approved confidential compute sku"),
    "unknown": (100, "Unknown", "Found the resource running the approved confidential compute sku"),
}
CC_NOTES = {
    "none": "No Azure resource found with tags['dataproductid'] matching this DataProductId.",
    "type_na": "Resource found but it is not an Azure VM, Arc machine, or SQL VM. Treat as N/A for Confidential Compute scoring.",
    "arc": "Arc machine details returned from ARG. Use ccLookupSku (Arc model) + resource.location in Fabric to score against rulesets. Patch assessment is sourced from Azure Update Manager / ARG when available.",
    "vm": "VM details returned from ARG. Use ccLookupSku (VM size) + resource.location in Fabric to score against rulesets. Patch assessment is sourced from Azure Update Manager / ARG when available.",
    "vm_unread": "VM found via Resource Graph, but failed to read VM details from ARM.",
    "sqlvm": "SQL VM found. Linked compute VM details returned from ARG. Use ccLookupSku (VM size) + resource.location in Fabric to score against rulesets. Patch assessment is sourced from the linked compute VM when available.",
    "sqlvm_unlinked": "SQL VM resource found, but linked compute VM resource id was empty in properties.virtualMachineResourceId.",
    "sqlvm_unread": "SQL VM resource found, but failed to read linked compute VM details from ARG/ARM.",
}
PATCH_ASSESSED, PATCH_NO_DATA = "Assessed", "NoData"

# Threat-protection score: (score, state), and JSON notes used when evidence is absent.
DEFENDER_BANDS = {
    "na": (100, "NA_NotApplicable"),
    "not_found": (0, "NotFound"),
    "none_applicable": (100, "notApplicable"),
    "not_configured": (25, "notConfigured"),
    "unhealthy": (50, "runningUnhealthy"),
    "not_running": (50, "configuredNotRunning"),
    "alerts": (75, "runningHealthyWithActiveAlert"),
    "healthy": (100, "runningHealthy"),
}
DEFENDER_EVIDENCE_STATES = {
    "override": (100, "notApplicableOverride"),
    "not_found": (0, "resourceNotFound"),
    "none_applicable": (100, "notApplicable"),
    "not_configured": (25, "notConfigured"),
    "unhealthy": (50, "assessmentUnhealthy"),
    "not_running": (50, "configuredNotRunning"),
    "alerts": (75, "runningHealthyWithCriticalAlert"),
    "healthy": (100, "runningHealthy"),
}
DEFENDER_NOTES = {
    "na": '{"note": "Defender not applicable for this data product. N/A treated as compliant (100%)."}',
    "no_result": '{"note": "No Defender API result returned for applicable data product; final rubric applied in Fabric."}',
    "no_resource": '{"note": "No Azure resources found with matching DataProductId tag."}',
    "none_applicable": '{"note": "Resources found, but none are applicable for Defender plans (treated as N/A => 100)."}',
    "evaluated": "{}",
}

# Residency update eligibility.
ELIGIBILITY_REASONS = {
    "not_found": "Azure resource not found for data product",
    "no_count": "No mapped Azure resource found for data product",
    "no_region": "Azure residency not detected",
    "several": "Multiple Azure residency values detected; manual review required",
    "not_approved": "Azure residency is not in approved region list; do not offer Purview update",
    "add": "Eligible: Purview residency missing; Azure residency detected and approved",
    "same": "Purview residency already matches Azure residency",
    "replace": "Eligible: Purview residency differs from Azure residency; Azure residency detected and approved",
}
ELIGIBILITY_VERSION = "v1"

# Investigation queue.
INVESTIGATION_CODES = {50: "CC_NOT_CONFIDENTIAL_OR_MODEL_MISSING", 75: "CC_CONFIDENTIAL_BUT_NOT_APPROVED"}

# Change plan notes and messages.
PLAN_ERRORS = {
    "no_id": "Missing required parameter 'dataProductId'.",
    "bad_id": "Invalid 'dataProductId'. Expected GUID.",
    "no_target": "Missing required parameter 'targetResidencyCode'.",
    "several_targets": "targetResidencyCode must be a single region code (deterministic single value).",
    "no_term": "Target term not found under the parent term.",
}
PLAN_NOTES = {
    "manual": "Multiple child terms are assigned under the residency parent term; manual review required.",
    "conflict": "Purview current residency changed since preview or caller expectation is stale.",
    "same": "Purview residency already matches target Azure residency code.",
    "verified": "Post-update verification succeeded.",
    "not_verified": "Post-update verification did not match target value. Manual review may be required.",
}
RESIDENCY_ACTION_TYPE = "PurviewResidencyGlossaryUpdate"
TAG_ACTION_TYPE = "CCPIIInvestigateTag"
TAG_NOTES = {
    "preview": "Dry run only. No tags were written.",
    "applied": "Investigate tag applied via Microsoft.Resources/tags/default (merged with existing tags).",
    "error": "Missing resourceId in item.",
    "unknown": "Failed to apply tag: resource not found",
}

# Column orders.
TAG_CURRENT_COLUMNS = (
    "resourceFound20 sovereigntyZoneExists20 sovereigntyZoneAllowed20 resourceOriginExists20 "
    "resourceOriginAllowed20 IsFabric IsS3 IsSqlPaaS IsStorage IsVmLike HasFullNameClassification "
    "FullNameColumnCount TagApplicable ResidencyApplicable CCApplicable DefenderApplicable Location "
    "ResourceGroup ResourceOrigin ResourceType ScoreRaw SovereigntyZone SubscriptionId SnapshotTimeUtc "
    "TagScorePct TagState TagReason dataProductId dataProductDisplayName dataProductDescription "
    "residencyRegion resourceFound resourceId"
).split()
TAG_HISTORY_COLUMNS = (
    "dataProductId dataProductDisplayName dataProductDescription residencyRegion resourceFound score "
    "resourceFound20 sovereigntyZoneExists20 sovereigntyZoneAllowed20 resourceOriginExists20 "
    "resourceOriginAllowed20 sovereignty_zone resource_origin complianceStatus snapshotTs"
).split()
RESIDENCY_COLUMNS = (
    "SnapshotTimeUtc DataProductID DataProductDisplayName DataProductDescription "
    "GlossaryResidencyRegionName GlossaryResidencyRegionCode GlossaryResidencyMissing IsApprovedResidency "
    "AzureResourceFound AzureResourceCount AzureLocations AzureResourceIds AzureLocationMatch "
    "ResidencyScorePct ResidencyScoreReason"
).split()
CC_COLUMNS = (
    "SnapshotUtc DataProductId DataProductDisplayName HasFullNameClassification FullNameColumnCount "
    "CCForPIIScore CCForPIIStatus Reason ResourceId ResourceType SubscriptionId ResourceGroup Location "
    "VmSize SecurityType IsApprovedSku IsApprovedRegion DetailsNote ArmError LastUpdateScanUtc "
    "PendingUpdatesTotal PatchAssessmentStatus"
).split()
DEFENDER_COLUMNS = (
    "dataProductId snapshotUtc resourceFound applicable progressScore progressState "
    "applicableResourceCount configuredResourceCount runningResourceCount highActiveAlertCount "
    "hasUnhealthyAssessments resourcesJson evaluatedResourcesJson detailsJson"
).split()
ELIGIBILITY_COLUMNS = (
    "SnapshotTimeUtc EligibilityComputedAtUtc DataProductID DataProductDisplayName DataProductDescription "
    "GlossaryResidencyRegionName GlossaryResidencyRegionCode GlossaryResidencyMissing AzureResourceFound "
    "AzureResourceCount AzureResidencyCode AzureLocationsRaw AzureResourceIds AzureLocationMatch "
    "HasSingleClearAzureResidencyValue IsAzureRegionApproved ApprovedRegionCodeMatch ApprovedRegionName "
    "ApprovedRegionNotes ResidencyScorePct ResidencyScoreReason IsApprovedResidency_ScorecardField "
    "TargetResidencyCode ExpectedCurrentResidencyCode EligibleForResidencyUpdate EligibilityReason "
    "SuggestedPurviewResidencyAction EligibilityLogicVersion"
).split()
INVESTIGATION_COLUMNS = (
    "SnapshotUtc DataProductId DataProductDisplayName DataProductDescription CCScorePct CCState CCReason "
    "InvestigationRequired InvestigationReasonCode ResourceFound CCApplicableResource CCApplicable "
    "ResourceId ResourceName ResourceType SubscriptionId ResourceGroup Location HasFullNameClassification "
    "FullNameColumnCount OwnerObjectId OwnerName OwnerEmail OwnerSource OwnerResolveStatus SuggestedTagKey "
    "SuggestedTagValue LookupSkuOrModel IsApprovedSku CCResourceKind ArcCloudProvider ArcStatus "
    "VmSizeCompat SecurityType"
).split()
RESIDENCY_LOG_COLUMNS = (
    "ActionTimeUtc ActionType ActionStatus DryRun DataProductID DataProductDisplayName ParentTermName "
    "CurrentResidencyCode TargetResidencyCode RequestedBy RequestSource RequestId ActionDecision Notes "
    "IngestedAtUtc RawActionLogRecordJson"
).split()
TAG_LOG_COLUMNS = (
    "ActionTimeUtc ActionType ActionStatus DryRun DataProductID DataProductDisplayName CCScorePct OwnerEmail "
    "ResourceId SuggestedTagKey SuggestedTagValue RequestedBy RequestSource RequestId Notes IngestedAtUtc "
    "RawActionLogRecordJson"
).split()
SUMMARY_COLUMNS = (
    "DataProductId DataProductDisplayName ResidencyScorePct CCScorePct DefenderScorePct TagScorePct "
    "PatchComplianceScorePct"
).split()
