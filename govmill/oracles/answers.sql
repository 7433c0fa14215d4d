-- view: ingest_parquet
SELECT 'part' AS table_name, COUNT(*) AS rows_loaded FROM part UNION ALL SELECT 'nation', COUNT(*) FROM nation
UNION ALL SELECT 'orders', COUNT(*) FROM orders UNION ALL SELECT 'lineitem', COUNT(*) FROM lineitem

-- view: ingest_delta_folder
SELECT ClassificationId, COUNT(*) AS n FROM g_column_class GROUP BY ClassificationId

-- view: write_current
SELECT * FROM o_gold

-- view: create_then_overwrite
SELECT * FROM o_gold

-- view: ctas_replace
SELECT * FROM o_asset_counts

-- view: append_snapshot
SELECT DATE '2024-03-01' AS SnapshotDate, TIMESTAMP '2024-03-01 00:00:00' AS Snapshots, * FROM o_gold
UNION ALL SELECT DATE '2024-03-02', TIMESTAMP '2024-03-02 00:00:00', * FROM o_gold

-- view: merge_insert_only
SELECT * FROM h_catalog

-- view: conform_schema
SELECT CAST(NULL AS VARCHAR) AS NOTE, DataProductName AS dataproductname, CAST(TotalAssets AS INT) AS totalassets, SnapshotTS AS snapshotts FROM h_asset

-- view: exact_columns
SELECT * FROM o_gold

-- view: write_current_and_history
SELECT t.table_name, r.ResidencyScorePct, COUNT(*) AS n FROM o_residency r
JOIN (SELECT 'current' AS table_name UNION ALL SELECT 'history' UNION ALL SELECT 'history' UNION ALL SELECT 'old_history') t ON TRUE
GROUP BY t.table_name, r.ResidencyScorePct

-- view: typed_evidence
SELECT resource_id, displayName, statusCode, statusChangeDate, CAST(NULL AS VARCHAR) AS firstEvaluationDate FROM g_assessment

-- view: union_tenants
SELECT SnapshotUtc, DataProductId, ComputeResourceId, ComputeName, CASE WHEN TenantId = 'tenant-a' THEN ResourceGroup END AS ResourceGroup,
       SubscriptionId, Location, SecurityType, IsConfidential, TenantId, IsConfidentialBool FROM o_vms

-- view: optional_table
SELECT 0 AS HasFullNameClassification, COUNT(*) AS n, 'absent' AS source FROM o_dim
UNION ALL SELECT HasFullNameClassification, COUNT(*), 'present' FROM o_base GROUP BY HasFullNameClassification

-- view: resolve_columns
SELECT * FROM o_rules UNION ALL SELECT * FROM o_rules

-- view: snapshot_single_row
SELECT TIMESTAMP '2024-03-01 00:00:00' AS SnapshotUtc, COUNT(*) AS TotalAssets, FALSE AS IsApproximate FROM g_asset

-- view: normalise_ids
SELECT lower(trim(DataProductId)) AS DataProductId, lower(trim(DataProductOwnerId)) AS OwnerId FROM g_owner
WHERE trim(DataProductId) <> '' AND trim(DataProductOwnerId) <> ''

-- view: validate_guid
SELECT k, id, regexp_matches(id, '^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$') AS is_valid FROM g_guid

-- view: dedupe_first
SELECT * FROM o_dim

-- view: categorise_products
SELECT DataProductId, IsFabric, IsS3, IsSqlPaaS, IsStorage, IsVmLike, IsHybridComputeMachine FROM o_cat

-- view: applicability
SELECT DataProductId, TagApplicable, ResidencyApplicable, CCApplicable, DefenderApplicable FROM o_base

-- view: parse_bool
SELECT k, CASE WHEN w IN ('yes', 'y', 'true', '1') THEN TRUE WHEN w IN ('no', 'n', 'false', '0') THEN FALSE END AS three_way,
       COALESCE(w IN ('yes', 'y', 'true', '1'), FALSE) AS strict,
       CASE WHEN w IN ('no', 'n', 'false', '0', 'f') THEN FALSE ELSE TRUE END AS request
FROM (SELECT k, lower(trim(flag_text)) AS w FROM g_spelling) x

-- view: normalise_code
SELECT k, NULLIF(lower(trim(flag_text)), '') AS code, COALESCE(NULLIF(trim(flag_text), ''), 'Unknown (not assigned)') AS display FROM g_spelling

-- view: parse_resource_id
SELECT ResourceId, 'r' || CAST(rk AS VARCHAR) AS ResourceName, lower(SubscriptionId) AS SubscriptionId FROM g_resource

-- view: parse_s3_bucket
SELECT k, CASE WHEN regexp_matches(trim(arn), '^arn:aws:s3:::[a-zA-Z0-9._-]{3,63}$') THEN substr(trim(arn), 14) END AS bucketName,
       CASE WHEN location IS NULL OR trim(location) IN ('', 'us', 'US') THEN 'us-east-1' ELSE trim(location) END AS bucketLocation FROM g_arn

-- view: tag_key_variants
SELECT ResourceId, DataProductId FROM o_tagged WHERE DataProductId <> ''

-- view: extract_properties
SELECT ResourceId, vm_size AS VmSize, security_type AS SecurityType, arc_model AS ArcModel, linked_vm_id AS LinkedVmId FROM g_resource

-- view: sum_nested_counts
SELECT k, CAST(expected AS BIGINT) AS total FROM g_counts

-- view: derive_assessment_id
SELECT ResourceId, ResourceId || '/patchAssessmentResults/latest' AS assessment_id FROM g_resource

-- view: json_defaults
SELECT DataProductId, DefenderApplicable, '[]' AS resourcesJson, '[]' AS evaluatedResourcesJson,
       CASE WHEN DefenderApplicable THEN '{"note": "No Defender API result returned for applicable data product; final rubric applied in Fabric."}'
            ELSE '{"note": "Defender not applicable for this data product. N/A treated as compliant (100%)."}' END AS detailsJson FROM o_base

-- view: single_value_gate
SELECT DataProductId, NOT contains(AzureLocations, ',') AS single FROM o_rollup

-- view: distinct_sorted_join
SELECT DataProductId, AzureLocations, AzureResourceIds FROM o_rollup

-- view: relative_time_filter
SELECT h.* FROM h_asset h WHERE SnapshotTS >= (SELECT MAX(SnapshotTS) - INTERVAL 168 HOUR FROM h_asset)

-- view: category_filters
SELECT 'not changed' AS "filter", COUNT(*) AS n FROM o_res_deltas WHERE NOT HasChanged
UNION ALL SELECT 'not confidential', COUNT(*) FROM o_vms WHERE IsConfidential = 0
UNION ALL SELECT 'no region', COUNT(*) FROM o_dim WHERE ResidencyRegion IS NULL
UNION ALL SELECT 'score not 100', COUNT(*) FROM o_cc WHERE CCForPIIScore <> 100
UNION ALL SELECT 'no patch data', COUNT(*) FROM o_cc WHERE PatchAssessmentStatus = 'NoData'
UNION ALL SELECT 'moved', COUNT(*) FROM (SELECT DataProductName FROM o_asset_deltas GROUP BY DataProductName HAVING SUM(DeltaAssets) <> 0) x

-- view: resource_kind
SELECT ResourceId, CASE lower(ResourceType) WHEN 'microsoft.compute/virtualmachines' THEN 'AzureVM' WHEN 'microsoft.hybridcompute/machines' THEN 'ArcMachine'
       WHEN 'microsoft.sqlvirtualmachine/sqlvirtualmachines' THEN 'SqlVirtualMachine' END AS kind,
       lower(ResourceType) IN ('microsoft.compute/virtualmachines', 'microsoft.hybridcompute/machines', 'microsoft.sqlvirtualmachine/sqlvirtualmachines') AS applicable
FROM g_resource

-- view: defender_candidate_plans
SELECT ResourceId, CASE WHEN lower(ResourceType) = 'microsoft.compute/virtualmachines' THEN 'virtualmachines,sqlservervirtualmachines'
       WHEN lower(ResourceType) = 'microsoft.hybridcompute/machines' THEN 'virtualmachines' WHEN lower(ResourceType) LIKE 'microsoft.sql/%' THEN 'sqlservers,sqlservervirtualmachines'
       WHEN lower(ResourceType) = 'microsoft.storage/storageaccounts' THEN 'storageaccounts' ELSE '' END AS plans FROM g_resource

-- view: gold_residency
SELECT * FROM o_gold

-- view: gold_asset_counts
SELECT * FROM o_asset_counts

-- view: fullname_classification
SELECT * FROM o_pii

-- view: base_with_pii
SELECT DataProductId, HasFullNameClassification, FullNameColumnCount FROM o_base

-- view: base_products
SELECT * FROM o_base

-- view: approved_region_lookup
SELECT DataProductId, ResidencyRegion AS input, RegionCode, RegionName, IsApproved FROM o_region

-- view: override_join
SELECT d.DataProductId, COALESCE(b.place, r.AzureLocations) AS AzureLocations FROM o_dim d
LEFT JOIN o_rollup r ON r.DataProductId = d.DataProductId LEFT JOIN o_bucket b ON b.bucketName = d.DataProductDisplayName

-- view: gap_not_confidential
SELECT * FROM o_gap_bad

-- view: gap_no_compute
SELECT * FROM o_gap_none

-- view: semi_join_ids
SELECT ResourceId, DataProductId FROM o_tagged WHERE DataProductId IN (SELECT dataProductId FROM g_residency_request)

-- view: prefer_applicable_resource
SELECT DataProductId, ResourceId, a AS vmApplicable FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY DataProductId ORDER BY a DESC, ResourceId) AS rn
  FROM (SELECT *, rtype IN ('microsoft.compute/virtualmachines', 'microsoft.hybridcompute/machines', 'microsoft.sqlvirtualmachine/sqlvirtualmachines') AS a
        FROM o_tagged WHERE DataProductId <> '') x) y WHERE rn = 1

-- view: linked_vm_lookup
SELECT * FROM o_linked

-- view: patch_lookup
SELECT t.DataProductId, p.at AS LastUpdateScanUtc, p.pending AS PendingUpdatesTotal,
       CASE WHEN p.aid IS NOT NULL THEN 'Assessed' WHEN t.target IS NOT NULL THEN 'NoData' END AS PatchAssessmentStatus
FROM (SELECT DataProductId, CASE WHEN rtype IN ('microsoft.compute/virtualmachines', 'microsoft.hybridcompute/machines') THEN ResourceId
             WHEN rtype = 'microsoft.sqlvirtualmachine/sqlvirtualmachines' THEN linked_vm_id END AS target
      FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY DataProductId ORDER BY CASE WHEN rtype IN ('microsoft.compute/virtualmachines',
                   'microsoft.hybridcompute/machines', 'microsoft.sqlvirtualmachine/sqlvirtualmachines') THEN 0 ELSE 1 END, ResourceId) AS rn
            FROM o_tagged WHERE DataProductId <> '') x WHERE rn = 1) t
LEFT JOIN o_patch_report p ON p.aid = lower(t.target) || '/patchassessmentresults/latest'

-- view: sku_lookup
SELECT r.ResourceId, COALESCE(r.vm_size, r.arc_model) AS sku_text, s.sku_lc IS NOT NULL AS IsConfidentialSku, COALESCE(s.approved, FALSE) AS IsApprovedSku
FROM g_resource r LEFT JOIN o_sku s ON s.sku_lc = lower(trim(COALESCE(r.vm_size, r.arc_model)))

-- view: asof_bounded
SELECT * FROM o_asof_assets

-- view: latest_snapshot_join
SELECT * FROM h_residency WHERE Snapshots = (SELECT MAX(Snapshots) FROM h_residency)

-- view: owner_contact
SELECT * FROM o_owner

-- view: investigate_join
SELECT c.DataProductId, c.DataProductDisplayName, d.DataProductDescription, c.CCForPIIScore, o.OwnerObjectId, o.OwnerEmail, o.OwnerSource,
       o.ResolveStatus AS OwnerResolveStatus
FROM o_cc c LEFT JOIN o_owner o ON o.DataProductId = c.DataProductId LEFT JOIN o_dim d ON d.DataProductId = c.DataProductId

-- view: star_join
SELECT COUNT(*) AS rows, COUNT(d.DataProductId) AS matched, 'name' AS relationship
FROM o_asset_counts a LEFT JOIN o_dim d ON lower(trim(d.DataProductDisplayName)) = lower(trim(a.DataProductName))
UNION ALL
SELECT COUNT(*), COUNT(d.DataProductId), 'description'
FROM o_asset_counts a LEFT JOIN o_dim d ON lower(trim(d.DataProductDescription)) = lower(trim(a.DataProductName))

-- view: case_variant_join
SELECT d.DataProductId AS dataProductId, COALESCE(r.AzureResourceCount, 0) AS resources FROM o_dim d LEFT JOIN o_rollup r ON r.DataProductId = d.DataProductId

-- view: eligible_region_join
SELECT r.DataProductId, r.AzureLocations AS code, lower(trim(a.region_code)) AS ApprovedRegionCodeMatch, a.region_name AS ApprovedRegionName,
       a.notes AS ApprovedRegionNotes, COALESCE(lower(trim(a.approved)) IN ('true', '1', 'yes', 'y'), FALSE) AS IsAzureRegionApproved
FROM o_rollup r LEFT JOIN g_approved_region a ON lower(trim(a.region_code)) = r.AzureLocations

-- view: asset_totals_by_snapshot
SELECT * FROM o_asset_totals

-- view: residency_totals_by_snapshot
SELECT * FROM o_res_totals

-- view: vm_rollup
SELECT * FROM o_vm_rollup

-- view: sku_rule_rollup
SELECT * FROM o_sku

-- view: assessment_rollup
SELECT c.*, s.sample FROM (
  SELECT resource_id, COUNT(*) AS total, COUNT(*) FILTER (WHERE lower(statusCode) = 'healthy') AS healthy,
         COUNT(*) FILTER (WHERE lower(statusCode) = 'unhealthy') AS unhealthy, COUNT(*) FILTER (WHERE lower(statusCode) = 'notapplicable') AS notApplicable,
         COUNT(*) FILTER (WHERE lower(statusCode) NOT IN ('healthy', 'unhealthy', 'notapplicable')) AS "unknown" FROM g_assessment GROUP BY resource_id) c
JOIN (SELECT resource_id, STRING_AGG(displayName || '|' || statusCode, ';' ORDER BY displayName, statusCode, statusChangeDate) AS sample
      FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY resource_id ORDER BY displayName, statusCode, statusChangeDate) AS rn FROM g_assessment) x
      WHERE rn <= 5 GROUP BY resource_id) s ON s.resource_id = c.resource_id

-- view: alert_rollup
SELECT resource_id, MAX(n) AS highActiveCount, STRING_AGG(CAST(systemAlertId AS VARCHAR) || '|' || severity || '|' || status, ';' ORDER BY systemAlertId) AS sample
FROM (SELECT *, COUNT(*) OVER (PARTITION BY resource_id) AS n, ROW_NUMBER() OVER (PARTITION BY resource_id ORDER BY systemAlertId, startTimeUtc) AS rn
      FROM g_alert WHERE status = 'Active' AND severity = 'High') x WHERE rn <= 5 GROUP BY resource_id

-- view: pricing_map
SELECT SubscriptionId, lower(plan_name) AS plan, MAX(pricingTier) AS tier FROM g_pricing GROUP BY SubscriptionId, lower(plan_name)

-- view: defender_rollup
SELECT * FROM o_def_rollup

-- view: resource_rollup
SELECT * FROM o_rollup

-- view: score_avg_by_product
SELECT DataProductID AS DataProductId, CAST(ROUND(AVG(ResidencyScorePct), 0) AS INT) AS ResidencyScorePct FROM o_residency GROUP BY DataProductID

-- view: eligibility_counts
SELECT MAX(SnapshotTimeUtc) AS SnapshotTimeUtc, COUNT(*) AS RowCount, COUNT(*) FILTER (WHERE EligibleForResidencyUpdate) AS EligibleCount FROM o_elig

-- view: breakdown_counts
SELECT OwnerSource, COUNT(*) AS n FROM o_owner GROUP BY OwnerSource

-- view: missing_counts
SELECT COUNT(*) AS OwnerEmailMissing FROM o_cc c LEFT JOIN o_owner o ON o.DataProductId = c.DataProductId WHERE o.OwnerEmail IS NULL OR trim(o.OwnerEmail) = ''

-- view: coverage_check
SELECT 'tag' AS scorecard, COUNT(*) AS rows, COUNT(DISTINCT dataProductId) AS products, CAST(0 AS BIGINT) AS missing, CAST(0 AS BIGINT) AS "unknown" FROM o_tag
UNION ALL SELECT 'residency', COUNT(*), COUNT(DISTINCT DataProductID), 0, 0 FROM o_residency
UNION ALL SELECT 'cc', COUNT(*), COUNT(DISTINCT DataProductId), 0, 0 FROM o_cc
UNION ALL SELECT 'defender', COUNT(*), COUNT(DISTINCT dataProductId), 0, 0 FROM o_defender
UNION ALL SELECT 'queue', COUNT(*), COUNT(DISTINCT DataProductId), (SELECT COUNT(*) FROM o_base) - COUNT(DISTINCT DataProductId), 0 FROM o_queue

-- view: distinct_products
SELECT COUNT(*) AS rows, COUNT(DISTINCT DataProductId) AS products, COUNT(DISTINCT OwnerObjectId) AS owners FROM o_owner

-- view: request_summary
SELECT COUNT(*) AS requestedCount, COUNT(r.id) AS matchedCount, COUNT(*) - COUNT(r.id) AS missingCount
FROM (SELECT DISTINCT dataProductId FROM g_residency_request) q
LEFT JOIN (SELECT DISTINCT DataProductId AS id FROM o_tagged WHERE DataProductId <> '') r ON r.id = q.dataProductId

-- view: missing_ids
SELECT DISTINCT dataProductId AS DataProductId FROM g_residency_request
WHERE dataProductId NOT IN (SELECT DataProductId FROM o_tagged WHERE DataProductId IS NOT NULL)

-- view: catalog_deltas
SELECT * FROM o_cat_deltas

-- view: asset_count_deltas
SELECT * FROM o_asset_deltas

-- view: residency_deltas
SELECT * FROM o_res_deltas

-- view: asof_rank
SELECT * FROM o_asof_assets

-- view: top_recent_catalog
SELECT * FROM o_cat_deltas ORDER BY SnapshotUtc DESC LIMIT 10

-- view: top_recent_assets
SELECT * FROM o_asset_deltas ORDER BY SnapshotTS DESC, abs(DeltaAssets) DESC NULLS LAST, DataProductName LIMIT 20

-- view: top_recent_changes
SELECT * FROM o_res_deltas WHERE HasChanged ORDER BY SnapshotUtc DESC, DataProductID LIMIT 50

-- view: top_recent_timeline
SELECT * FROM o_timeline ORDER BY SnapshotUtc DESC LIMIT 20

-- view: sorted_lists
SELECT DataProductDisplayName, DataProductId FROM o_dim

-- view: kpi_timeline
SELECT * FROM o_timeline

-- view: product_union
SELECT * FROM o_products

-- view: anomaly_points
SELECT ts, "value", ROUND(m, 4) AS expected, ROUND(m - w, 4) AS lower, ROUND(m + w, 4) AS upper, abs("value" - m) > w AS is_anomaly
FROM (SELECT ts, "value", m, 4.0 * 1.4826 * d AS w FROM (
  SELECT SnapshotUtc AS ts, CAST(TotalAssets AS DOUBLE) AS "value",
         median(CAST(TotalAssets AS DOUBLE)) OVER w AS m, mad(CAST(TotalAssets AS DOUBLE)) OVER w AS d
  FROM h_catalog WINDOW w AS (ORDER BY SnapshotUtc ROWS BETWEEN 7 PRECEDING AND 7 FOLLOWING)) x) y

-- view: score_tag
SELECT * FROM o_tag

-- view: tag_history
SELECT dataProductId, dataProductDisplayName, dataProductDescription, residencyRegion, resourceFound, ScoreRaw AS score, resourceFound20,
       sovereigntyZoneExists20, sovereigntyZoneAllowed20, resourceOriginExists20, resourceOriginAllowed20, SovereigntyZone AS sovereignty_zone,
       ResourceOrigin AS resource_origin, CASE WHEN TagScorePct = 100 THEN 'compliant' WHEN TagScorePct >= 60 THEN 'partial' ELSE 'noncompliant' END AS complianceStatus,
       SnapshotTimeUtc AS snapshotTs FROM o_tag

-- view: score_residency
SELECT * FROM o_residency

-- view: score_cc
SELECT * FROM o_cc

-- view: score_defender
SELECT d.* EXCLUDE (IsHybridComputeMachine), COALESCE(a.resourcesJson, '[]') AS resourcesJson, COALESCE(a.evaluatedResourcesJson, '[]') AS evaluatedResourcesJson
FROM o_defender d LEFT JOIN o_base b ON b.DataProductId = d.dataProductId LEFT JOIN o_audit a ON a.DataProductId = d.dataProductId AND b.DefenderApplicable

-- view: defender_audit_texts
SELECT * FROM o_audit

-- view: defender_evidence_state
SELECT dataProductId AS DataProductId, progressScore, CASE progressState WHEN 'NotFound' THEN 'resourceNotFound' WHEN 'runningUnhealthy' THEN 'assessmentUnhealthy'
       WHEN 'runningHealthyWithActiveAlert' THEN 'runningHealthyWithCriticalAlert' ELSE progressState END AS progressState
FROM o_defender WHERE progressState <> 'NA_NotApplicable' AND NOT IsHybridComputeMachine
UNION ALL SELECT dataProductId, 100, 'notApplicableOverride' FROM o_defender WHERE progressState <> 'NA_NotApplicable' AND IsHybridComputeMachine

-- view: score_patch
SELECT * FROM o_patch_score

-- view: measure_patch
SELECT AVG(CASE WHEN PendingUpdatesTotal IS NULL OR PendingUpdatesTotal = 0 THEN 100.0 ELSE 0.0 END) AS m19_avg_patch_score FROM o_cc

-- view: compliance_summary
SELECT * FROM o_summary

-- view: residency_eligibility
SELECT * FROM o_elig

-- view: eligible_listing
SELECT DataProductDisplayName, DataProductID, GlossaryResidencyRegionCode, TargetResidencyCode, ExpectedCurrentResidencyCode, IsAzureRegionApproved,
       EligibleForResidencyUpdate, SuggestedPurviewResidencyAction, EligibilityReason FROM o_elig WHERE EligibleForResidencyUpdate

-- view: cc_investigation_queue
SELECT * FROM o_queue

-- view: compute_inventory
SELECT * FROM o_vms

-- view: residency_change_plan
SELECT * EXCLUDE (target_id, term_id) FROM o_plan

-- view: residency_change_apply
SELECT * FROM o_apply

-- view: residency_assignments_after
SELECT * FROM o_after

-- view: residency_changelog
SELECT TIMESTAMP '2024-03-01 00:00:00' AS ActionTimeUtc, 'PurviewResidencyGlossaryUpdate' AS ActionType, status AS ActionStatus, dryRun AS DryRun,
       dataProductId AS DataProductID, DataProductDisplayName, 'P-REGION' AS ParentTermName, currentResidencyCode AS CurrentResidencyCode,
       targetResidencyCode AS TargetResidencyCode, 'steward' AS RequestedBy, 'console' AS RequestSource, requestId AS RequestId, action AS ActionDecision,
       notes AS Notes, TIMESTAMP '2024-03-01 00:00:00' AS IngestedAtUtc,
       '{' || concat_ws(',', '"requestId":"' || requestId || '"', '"dataProductId":"' || dataProductId || '"', '"action":"' || action || '"', '"status":"' || status || '"', '"currentResidencyCode":"' || currentResidencyCode || '"', '"targetResidencyCode":"' || targetResidencyCode || '"') || '}' AS RawActionLogRecordJson FROM o_apply

-- view: tag_merge_plan
SELECT * FROM o_tag_plan

-- view: tag_merge_counts
SELECT COUNT(*) AS requestedCount, COUNT(*) FILTER (WHERE applied) AS appliedCount, COUNT(*) FILTER (WHERE status = 'error') AS errorCount FROM o_tag_plan

-- view: cc_changelog
SELECT TIMESTAMP '2024-03-01 00:00:00' AS ActionTimeUtc, 'CCPIIInvestigateTag' AS ActionType, status AS ActionStatus, dryRun AS DryRun, dataProductId AS DataProductID,
       dataProductDisplayName AS DataProductDisplayName, ccScorePct AS CCScorePct, ownerEmail AS OwnerEmail, resourceId AS ResourceId, tagKey AS SuggestedTagKey,
       tagValue AS SuggestedTagValue, 'steward' AS RequestedBy, 'console' AS RequestSource, 'tags-1' AS RequestId, note AS Notes,
       TIMESTAMP '2024-03-01 00:00:00' AS IngestedAtUtc,
       '{' || concat_ws(',', '"resourceId":"' || resourceId || '"', '"dataProductId":"' || dataProductId || '"', '"tagKey":"' || tagKey || '"', '"tagValue":"' || tagValue || '"', '"status":"' || status || '"') || '}' AS RawActionLogRecordJson FROM o_tag_plan WHERE resourceId IS NOT NULL

-- view: enforce_tag_policy
SELECT ResourceId, 'origin' AS rule, 'resource-origin' AS tag, tag_origin AS before, o AS "after" FROM (
  SELECT *, CASE lower(ResourceType) WHEN 'microsoft.compute/virtualmachines' THEN 'azure' WHEN 'microsoft.hybridcompute/machines' THEN 'arc' END AS o FROM g_resource) x
WHERE o IS NOT NULL AND lower(tag_origin) IS DISTINCT FROM o
UNION ALL
SELECT ResourceId, 'zone', 'sovereignty-zone', tag_zone, z FROM (
  SELECT *, CASE lower(ResourceType) WHEN 'microsoft.compute/virtualmachines' THEN 'standard' WHEN 'microsoft.hybridcompute/machines' THEN 'comprehensive' END AS z FROM g_resource) x
WHERE z IS NOT NULL AND lower(tag_zone) IS DISTINCT FROM z

-- view: audit_managed_identity
SELECT ResourceId, identity_type AS IdentityType FROM g_resource WHERE lower(ResourceType) = 'microsoft.hybridcompute/machines'
  AND (identity_type IS NULL OR NOT contains(identity_type, 'SystemAssigned'))

-- view: policy_state_rollup
SELECT resourceId, COUNT(*) FILTER (WHERE isCompliant) AS compliant, COUNT(*) FILTER (WHERE NOT isCompliant) AS nonCompliant FROM g_policy_state GROUP BY resourceId

-- view: policy_state_by_control
SELECT control, COUNT(*) FILTER (WHERE isCompliant) AS compliant, COUNT(*) FILTER (WHERE NOT isCompliant) AS nonCompliant
FROM (SELECT isCompliant, unnest(string_split(groupNames, ',')) AS control FROM g_policy_state) x GROUP BY control

-- view: dashboard_info
SELECT 'missing_region_count' AS section, NULL AS item, NULL AS detail, COUNT(*) AS "value" FROM o_dim WHERE ResidencyRegion IS NULL
UNION ALL SELECT 'missing_region_product', DataProductDisplayName, DataProductId, 1 FROM o_dim WHERE ResidencyRegion IS NULL
UNION ALL SELECT 'total_products', NULL, NULL, COUNT(*) FROM o_dim
UNION ALL SELECT 'total_assets', NULL, NULL, CAST(SUM(TotalAssets) AS BIGINT) FROM o_asset_counts
UNION ALL SELECT 'assets_by_product', DataProductName, NULL, TotalAssets FROM o_asset_counts
UNION ALL SELECT 'eligible_count', NULL, NULL, COUNT(*) FROM o_elig WHERE EligibleForResidencyUpdate
UNION ALL SELECT 'eligible_product', DataProductDisplayName, SuggestedPurviewResidencyAction || ' ' || COALESCE(ExpectedCurrentResidencyCode, '-') || ' ' || TargetResidencyCode, 1
  FROM o_elig WHERE EligibleForResidencyUpdate
UNION ALL SELECT 'blocked_count', NULL, NULL, COUNT(*) FROM o_elig WHERE EligibilityReason LIKE 'Azure residency is not in approved%'
UNION ALL SELECT 'blocked_product', DataProductDisplayName, AzureResidencyCode, 1 FROM o_elig WHERE EligibilityReason LIKE 'Azure residency is not in approved%'

-- view: investigation_match
SELECT q.requestId, q.dataProductId, COUNT(c.DataProductId) AS match_count, COUNT(c.DataProductId) = 1 AS actionable
FROM g_residency_request q LEFT JOIN o_queue c ON c.DataProductId = lower(trim(q.dataProductId)) GROUP BY q.requestId, q.dataProductId

-- view: measures_products
SELECT *, CAST(m02_with_residency AS DOUBLE) / m01_total_products AS m03_residency_coverage, m01_total_products - m02_with_residency AS m04_missing_residency,
       CAST(m06_assets_missing_residency AS DOUBLE) / m05_total_assets AS m07_missing_assets_share
FROM (SELECT (SELECT COUNT(DISTINCT DataProductID) FROM o_gold) AS m01_total_products,
             (SELECT COUNT(DISTINCT DataProductID) FROM o_gold WHERE ResidencyRegion IS NOT NULL) AS m02_with_residency,
             (SELECT CAST(SUM(TotalAssets) AS BIGINT) FROM o_asset_counts) AS m05_total_assets,
             (SELECT CAST(SUM(TotalAssets) AS BIGINT) FROM o_asset_counts WHERE DataProductName IN
               (SELECT DataProductDisplayName FROM o_gold WHERE ResidencyRegion IS NULL)) AS m06_assets_missing_residency) x

-- view: product_flags
SELECT * FROM o_flags

-- view: measures_pii
SELECT (SELECT MAX(m08_has_full_name) FROM o_flags) AS m08_has_full_name, (SELECT MAX(m09_has_confidential_compute) FROM o_flags) AS m09_has_confidential_compute,
       (SELECT CAST(SUM(m10_both) AS BIGINT) FROM o_flags) AS m10_products_both, (SELECT COUNT(DISTINCT DataProductId) FROM o_gap_none) AS m23_no_compute,
       (SELECT COUNT(DISTINCT DataProductId) FROM o_gap_bad) AS m24_not_confidential, (SELECT CAST(SUM(ComputeVmCount) AS BIGINT) FROM o_gap_bad) AS m25_vms_not_confidential,
       (SELECT COUNT(DISTINCT DataProductId) FROM o_pii WHERE HasFullNameClassification = 1) AS m26_full_name

-- view: measures_cc
SELECT COUNT(*) FILTER (WHERE CCForPIIStatus = 'Applicable') AS m11_applicable, AVG(CCForPIIScore) FILTER (WHERE CCForPIIStatus = 'Applicable') AS m12_overall_score,
       COUNT(*) FILTER (WHERE CCForPIIScore = 100) AS m13_score_100, COUNT(*) FILTER (WHERE CCForPIIScore = 25) AS m14_score_25,
       COUNT(*) FILTER (WHERE CCForPIIScore = 50) AS m15_score_50, COUNT(*) FILTER (WHERE CCForPIIScore = 75) AS m16_score_75,
       COUNT(*) FILTER (WHERE CCForPIIScore = 0) AS m17_score_0, AVG(CCForPIIScore) AS m18_avg_score, (SELECT COUNT(*) FROM o_queue) AS m20_investigations,
       (SELECT COUNT(DISTINCT COALESCE(OwnerEmail, '(none)')) FROM o_queue) AS m21_owners FROM o_cc

-- view: measures_scores
SELECT (SELECT AVG(CCForPIIScore) FROM o_cc) AS m18_avg_cc_score,
       (SELECT AVG(CASE WHEN COALESCE(PendingUpdatesTotal, 0) = 0 THEN 100.0 ELSE 0.0 END) FROM o_cc) AS m19_avg_patch_score,
       (SELECT AVG(progressScore) FROM o_defender) AS m22_avg_defender_score, (SELECT AVG(ResidencyScorePct) FROM o_residency) AS m28_avg_residency_score,
       (SELECT AVG(TagScorePct) FROM o_tag) AS m29_avg_tag_score

-- view: measures_last_run
SELECT *, CASE WHEN abs(m30_delta_pct) >= 0.05 THEN 1 ELSE 0 END AS m31_spike_flag FROM (
  SELECT (SELECT COUNT(*) FROM o_res_deltas WHERE HasChanged AND SnapshotUtc = (SELECT MAX(SnapshotUtc) FROM o_res_deltas)) AS m27_residency_changes,
         (SELECT MAX(DeltaPct) FROM o_cat_deltas WHERE SnapshotUtc = (SELECT MAX(SnapshotUtc) FROM o_cat_deltas)) AS m30_delta_pct,
         (SELECT COALESCE(MAX(ProductsMissingResidency), 0) FROM o_timeline WHERE SnapshotUtc = (SELECT MAX(SnapshotUtc) FROM o_timeline)) AS m32_missing_residency) x

-- view: products_by_region
SELECT ResidencyRegion, COUNT(DISTINCT DataProductID) AS products FROM o_gold GROUP BY ResidencyRegion

-- view: assets_by_product
SELECT DataProductName, CAST(SUM(TotalAssets) AS BIGINT) AS assets FROM o_asset_counts GROUP BY DataProductName

-- view: missing_region_list
SELECT DISTINCT DataProductDisplayName FROM o_gold WHERE ResidencyRegion IS NULL

-- view: kpi_lines
SELECT SnapshotUtc, MAX(TotalPurviewAssets) AS catalog_assets, MAX(TotalProductAssets) AS product_assets, MAX(ResidencyCoveragePct) AS coverage,
       SUM(ProductAssetsToPurviewAssetsRatio) AS ratio FROM o_timeline GROUP BY SnapshotUtc

-- view: residency_log
SELECT SnapshotUtc, DataProductID, DataProductDisplayName, PrevResidencyRegion, ResidencyRegion FROM o_res_deltas WHERE NOT HasChanged

-- view: recent_asset_changes
SELECT SnapshotTS, DataProductName, CAST(SUM(TotalAssets) AS BIGINT) AS assets, CAST(SUM(DeltaAssets) AS BIGINT) AS delta FROM o_asset_deltas
WHERE SnapshotTS >= (SELECT MAX(SnapshotTS) - INTERVAL 168 HOUR FROM h_asset) GROUP BY SnapshotTS, DataProductName HAVING SUM(DeltaAssets) <> 0

-- view: score_gauges
SELECT AVG(ResidencyScorePct) AS residency, AVG(DefenderScorePct) AS defender, AVG(TagScorePct) AS tag, AVG(PatchComplianceScorePct) AS patch FROM o_summary

-- view: non_confidential_vms
SELECT v.DataProductId, d.DataProductDisplayName, v.ComputeResourceId, v.ComputeName, v.SecurityType, v.Location, v.TenantId
FROM o_vms v JOIN o_dim d ON d.DataProductId = v.DataProductId WHERE v.IsConfidential = 0

-- view: sensitive_and_confidential
SELECT DISTINCT DataProductDisplayName FROM o_flags WHERE m10_both = 1

-- view: gap_tables
SELECT gap, d.DataProductDisplayName, CAST(SUM(FullNameColumnCount) AS BIGINT) AS columns, CAST(SUM(ComputeVmCount) AS BIGINT) AS vms FROM (
  SELECT 'no_compute' AS gap, DataProductId, FullNameColumnCount, ComputeVmCount FROM o_gap_none
  UNION ALL SELECT 'not_confidential', DataProductId, FullNameColumnCount, ComputeVmCount FROM o_gap_bad) x
JOIN o_dim d ON d.DataProductId = x.DataProductId GROUP BY gap, d.DataProductDisplayName

-- view: investigation_table
SELECT DataProductDisplayName, CCResourceKind, LookupSkuOrModel, OwnerName, OwnerEmail, CCReason, InvestigationReasonCode, CAST(SUM(CCScorePct) AS BIGINT) AS score
FROM o_queue GROUP BY ALL

-- view: score_matrix
SELECT * FROM o_summary

-- view: patch_list
SELECT c.DataProductId, c.PatchAssessmentStatus, c.PendingUpdatesTotal, c.LastUpdateScanUtc, d.DataProductDisplayName
FROM o_cc c LEFT JOIN o_dim d ON d.DataProductId = c.DataProductId

-- view: patch_list_no_data
SELECT c.DataProductId, c.PatchAssessmentStatus, c.PendingUpdatesTotal, c.LastUpdateScanUtc, d.DataProductDisplayName
FROM o_cc c LEFT JOIN o_dim d ON d.DataProductId = c.DataProductId WHERE c.PatchAssessmentStatus = 'NoData'

-- view: cc_cards
SELECT COUNT(*) FILTER (WHERE CCForPIIScore <> 100) AS below_100, AVG(CCForPIIScore) AS mean_score FROM o_cc

-- view: cc_detail
SELECT c.DataProductId, c.FullNameColumnCount, c.CCForPIIStatus, c.CCForPIIScore, c.Reason, c.SnapshotUtc, d.DataProductDisplayName
FROM o_cc c LEFT JOIN o_dim d ON d.DataProductId = c.DataProductId

-- view: slicers
SELECT DISTINCT 'tenant' AS slicer, TenantId AS "value" FROM o_vms UNION SELECT 'location', Location FROM o_vms
UNION SELECT 'product', DataProductDisplayName FROM o_dim UNION SELECT 'region', ResidencyRegion FROM o_gold

-- view: redact_text
SELECT doc_id, t4 AS "text", t4 <> t0 AS changed FROM o_redacted_all

-- view: redaction_report
SELECT rule, CAST(SUM(n) AS BIGINT) AS replacements, COUNT(*) FILTER (WHERE n > 0) AS docs FROM (
  SELECT 'Exact:mail host' AS rule, (length(t0) - length(replace(t0, 'mail5.example.com', ''))) // 17 AS n FROM o_redacted_all
  UNION ALL SELECT 'EmailReplacement', len(regexp_extract_all(t1, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}')) FROM o_redacted_all
  UNION ALL SELECT 'FunctionAppUrlReplacement', len(regexp_extract_all(t2, 'https://[A-Za-z0-9-]+\.azurewebsites\.net')) FROM o_redacted_all
  UNION ALL SELECT 'KeyVaultUrlReplacement', len(regexp_extract_all(t3, 'https://[A-Za-z0-9-]+\.vault\.azure\.net/?')) FROM o_redacted_all) x GROUP BY rule

-- view: leak_scan
SELECT doc_id, 'literal' AS "type", 'mail2.example.com' AS rule FROM documents WHERE contains("text", 'mail2.example.com')
UNION ALL SELECT doc_id, 'pattern', 'MailAddress' FROM documents WHERE regexp_matches("text", '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}')
UNION ALL SELECT doc_id, 'pattern', 'TenantIdAssignment' FROM documents WHERE regexp_matches("text", '(?im)^(TENANT_ID|tenant_id)\s*=\s*"[0-9a-fA-F-]{36}"')
UNION ALL SELECT doc_id, 'pattern', 'ClientIdAssignment' FROM documents WHERE regexp_matches("text", '(?im)^(CLIENT_ID|client_id|RESOURCE_APP_CLIENT_ID)\s*=\s*"[0-9a-fA-F-]{36}"')
UNION ALL SELECT doc_id, 'pattern', 'SubscriptionGuidArray' FROM documents WHERE regexp_matches("text", '(?im)subscriptions?\s*[=:]\s*\[[^\]]*[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}[^\]]*\]')
UNION ALL SELECT doc_id, 'pattern', 'OwnerEmail' FROM documents WHERE regexp_matches("text", '(?im)OWNER_EMAIL.*@[A-Za-z0-9.-]+')

-- view: leak_verdict
SELECT 'raw' AS texts, CAST(SUM(a + b) AS BIGINT) AS total_findings, SUM(a + b) = 0 AS passed FROM (
  SELECT CASE WHEN contains("text", 'mail2.example.com') THEN 1 ELSE 0 END AS a,
         CASE WHEN regexp_matches("text", '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}') THEN 1 ELSE 0 END AS b FROM documents) x
UNION ALL
SELECT 'redacted', CAST(SUM(b) AS BIGINT), SUM(b) = 0 FROM (
  SELECT CASE WHEN regexp_matches(replace(t4, 'mail2.example.com', '<HOST>'), '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}') THEN 1 ELSE 0 END AS b FROM o_redacted_all) y

-- view: reference_lineage
SELECT * FROM o_lineage

-- view: lineage_counts
SELECT v.page_id, COUNT(DISTINCT v.visual_id) AS visuals, COUNT(DISTINCT l.entity) AS entities
FROM g_visual v LEFT JOIN o_lineage l ON l.page_id = v.page_id GROUP BY v.page_id

-- view: snapshot_ingest_stream
SELECT * FROM h_catalog

-- view: drift_alert_stream
SELECT CASE WHEN kind NOT IN ('spike', 'drop') THEN 'region:' WHEN "key" = 'catalog' THEN '' ELSE 'assets:' END || "key" AS "key", kind, prev, "value", pct, ts
FROM o_alerts

-- view: drift_alerts
SELECT * FROM o_alerts

-- view: catalog_deltas_in_steps
SELECT * FROM o_cat_deltas

-- view: asset_count_deltas_in_steps
SELECT * FROM o_asset_deltas

-- view: residency_deltas_in_steps
SELECT * FROM o_res_deltas

-- view: asset_totals_in_steps
SELECT * FROM o_asset_totals

-- view: residency_totals_in_steps
SELECT * FROM o_res_totals

-- view: defender_evidence_rows
SELECT r.DataProductId, r.ResourceId, regexp_extract(r.ResourceId, '([^/]+)$', 1) AS ResourceName, r.ResourceType, r.SubscriptionId, r.ResourceGroup, r.Location,
       r.ok AS defenderApplicable, r.configured AS defenderConfigured, COALESCE(r.total > 0, FALSE) AS hasAssessments,
       r.configured AND COALESCE(r.total > 0, FALSE) AS defenderRunning, r.total AS assessmentsTotal,
       CASE WHEN r.ok THEN COALESCE(a.healthy, 0) END AS healthy, CASE WHEN r.ok THEN COALESCE(a.unhealthy, 0) END AS unhealthy,
       CASE WHEN r.ok THEN COALESCE(a.na, 0) END AS notApplicable, CASE WHEN r.ok THEN COALESCE(a.other, 0) END AS unknown, r.alerts AS highActiveAlerts
FROM o_def_resource r LEFT JOIN (
  SELECT resource_id, COUNT(*) FILTER (WHERE lower(statusCode) = 'healthy') AS healthy, COUNT(*) FILTER (WHERE lower(statusCode) = 'unhealthy') AS unhealthy,
         COUNT(*) FILTER (WHERE lower(statusCode) = 'notapplicable') AS na,
         COUNT(*) FILTER (WHERE lower(statusCode) NOT IN ('healthy', 'unhealthy', 'notapplicable')) AS other
  FROM g_assessment GROUP BY resource_id) a ON a.resource_id = lower(r.ResourceId)

-- view: defender_plan_rows
SELECT r.DataProductId, r.ResourceId, r.plan, MAX(trim(p.pricingTier)) AS tier
FROM (SELECT DataProductId, ResourceId, SubscriptionId, unnest(string_split(plans, ',')) AS plan FROM o_def_resource WHERE ok) r
LEFT JOIN g_pricing p ON p.SubscriptionId = r.SubscriptionId AND lower(p.plan_name) = r.plan GROUP BY r.DataProductId, r.ResourceId, r.plan

-- view: defender_alert_rows
SELECT r.DataProductId, r.ResourceId, l.systemAlertId, l.severity, l.status, l.startTimeUtc
FROM o_def_resource r JOIN g_alert l ON l.resource_id = lower(r.ResourceId) WHERE l.status = 'Active' AND l.severity = 'High'

-- view: star_rows
SELECT s.fact, s.fact_key, d.DataProductId AS ProductId, d.DataProductDisplayName AS ProductDisplayName
FROM o_star s LEFT JOIN o_dim d ON lower(trim(CASE s.side WHEN 'id' THEN d.DataProductId ELSE d.DataProductDescription END)) = lower(trim(s.fact_key))

-- view: measures_by_slicer
SELECT CASE WHEN GROUPING(ResidencyRegion) = 1 THEN 'ALL' ELSE COALESCE(ResidencyRegion, 'Unknown (not assigned)') END AS region,
       CASE WHEN GROUPING(kind) = 1 THEN 'ALL' ELSE kind END AS kind, COUNT(*) AS products, COUNT(*) FILTER (WHERE HasFullNameClassification = 1) AS sensitive,
       COUNT(*) FILTER (WHERE DefenderApplicable) AS protectable, CAST(SUM(FullNameColumnCount) AS BIGINT) AS fullname_columns
FROM (SELECT *, CASE WHEN IsS3 THEN 's3' WHEN IsFabric THEN 'fabric' WHEN IsSqlPaaS THEN 'sql' WHEN IsStorage THEN 'storage'
                     WHEN IsHybridComputeMachine THEN 'hybrid' WHEN IsVmLike THEN 'vm' ELSE 'other' END AS kind FROM o_base) b
GROUP BY GROUPING SETS ((ResidencyRegion, kind), (ResidencyRegion), (kind), ())

-- view: saved_filter_rows
SELECT 'not changed' AS "filter", DataProductID || ' @ ' || strftime(SnapshotUtc, '%Y-%m-%d %H:%M:%S') AS item FROM o_res_deltas WHERE NOT HasChanged
UNION ALL SELECT 'not confidential', ComputeResourceId FROM o_vms WHERE IsConfidential = 0
UNION ALL SELECT 'no region', DataProductId FROM o_dim WHERE ResidencyRegion IS NULL
UNION ALL SELECT 'score not 100', DataProductId FROM o_cc WHERE CCForPIIScore <> 100
UNION ALL SELECT 'no patch data', DataProductId FROM o_cc WHERE PatchAssessmentStatus = 'NoData'
UNION ALL SELECT 'moved', DataProductName FROM o_asset_deltas GROUP BY DataProductName HAVING SUM(DeltaAssets) <> 0
UNION ALL SELECT 'sensitive and confidential', DataProductDisplayName FROM (SELECT DISTINCT DataProductDisplayName FROM o_flags WHERE m10_both = 1) x

-- view: visual_catalog
SELECT * FROM o_visuals

-- view: report_lineage
SELECT v.report, v.page, COUNT(DISTINCT v.visual_id) AS visuals, COUNT(DISTINCT l.entity) AS entities
FROM o_visuals v LEFT JOIN o_lineage l ON l.visual_id = v.visual_id GROUP BY GROUPING SETS ((v.report, v.page), (v.report))

-- view: table_usage
SELECT l.entity, v.report, v.visual_id, v.page, v.visual_type, v.title, l.properties FROM o_lineage l JOIN o_visuals v ON v.visual_id = l.visual_id

-- view: schema_diff
SELECT 'ResidencyRegion' AS "column", 'ONLY IN DF' AS issue, 'string' AS frame_type, NULL AS table_type, COUNT(ResidencyRegion) AS filled FROM o_dim
UNION ALL SELECT 'DataProductDescription', 'TYPE MISMATCH', 'string', 'int', COUNT(DataProductDescription) FROM o_dim
UNION ALL SELECT 'Retired', 'ONLY IN TABLE', NULL, 'boolean', NULL

-- view: literal_scan
SELECT d.doc_id, r.rule FROM documents d JOIN (
  SELECT 'host ' || CAST(n_nationkey AS VARCHAR) AS rule, 'mail' || CAST(n_nationkey AS VARCHAR) || '.example.com' AS find FROM nation
  UNION ALL SELECT 'product ' || DataProductID, DataProductDisplayName FROM g_product) r ON contains(d."text", r.find)
