-- view: o_gold
SELECT p.DataProductID, p.DataProductDisplayName, p.DataProductDescription, t.GlossaryTermDisplayName AS ResidencyRegion
FROM g_product p
LEFT JOIN g_term_assignment a ON a.DataProductId = p.DataProductID AND a.ActiveFlag = 1
LEFT JOIN g_term t ON t.GlossaryTermId = a.GlossaryTermId AND t.ParentGlossaryTermId = 'P-REGION'

-- view: o_pii
SELECT TIMESTAMP '2024-03-01 00:00:00' AS SnapshotUtc, p.DataProductID AS DataProductId, p.DataProductDisplayName,
       CASE WHEN c.n IS NULL THEN 0 ELSE 1 END AS HasFullNameClassification, COALESCE(c.n, 0) AS FullNameColumnCount
FROM (SELECT DISTINCT DataProductID, DataProductDisplayName FROM g_product) p
LEFT JOIN (
  SELECT pa.DataProductId, COUNT(DISTINCT ac.ColumnId) AS n
  FROM (SELECT DISTINCT DataProductId, DataAssetId FROM g_product_asset) pa
  JOIN g_asset_column ac ON ac.DataAssetId = pa.DataAssetId
  JOIN g_column_class cc ON cc.DataAssetId = ac.DataAssetId AND cc.ColumnId = ac.ColumnId
  JOIN g_class k ON k.ClassificationId = cc.ClassificationId
  WHERE k.ClassificationDisplayName = 'PERSONAL.NAME'
  GROUP BY pa.DataProductId) c ON c.DataProductId = p.DataProductID

-- view: o_dim
SELECT DataProductId, DataProductDisplayName, DataProductDescription, ResidencyRegion FROM (
  SELECT lower(trim(DataProductID)) AS DataProductId, DataProductDisplayName, DataProductDescription, ResidencyRegion,
         ROW_NUMBER() OVER (PARTITION BY lower(trim(DataProductID))
                            ORDER BY ResidencyRegion ASC NULLS LAST, DataProductDisplayName, DataProductDescription) AS rn
  FROM o_gold) x WHERE rn = 1

-- view: o_cat
SELECT DataProductId, DataProductDisplayName, DataProductDescription, ResidencyRegion,
       contains(txt, 'fabric') AS IsFabric,
       contains(txt, 'amazon s3') OR contains(txt, ' s3') OR contains(txt, 's3-') OR contains(txt, 's3 ') AS IsS3,
       contains(txt, 'azure sql database') AND NOT contains(txt, 'iaas') AS IsSqlPaaS,
       contains(txt, 'data lake') OR contains(txt, 'adls') OR contains(txt, 'storage account') OR contains(txt, 'azure files') AS IsStorage,
       contains(txt, 'iaas') OR contains(txt, ' vm') OR contains(txt, 'virtual machine') OR contains(txt, 'sap s/4') AS IsVmLike,
       contains(txt, 'hybridcompute/machines') OR contains(txt, 'hybrid compute') OR contains(txt, 'azure arc')
         OR contains(txt, 'arc-enabled') OR contains(txt, 'arc enabled') AS IsHybridComputeMachine
FROM (SELECT *, lower(COALESCE(DataProductDisplayName, '') || ' ' || COALESCE(DataProductDescription, '')) AS txt FROM o_dim) x

-- view: o_base
SELECT c.*, COALESCE(f.h, 0) AS HasFullNameClassification, CAST(COALESCE(f.n, 0) AS INT) AS FullNameColumnCount,
       NOT IsS3 AS TagApplicable, TRUE AS ResidencyApplicable, COALESCE(f.h, 0) = 1 AS CCApplicable,
       NOT IsFabric AND NOT IsS3 AND (IsVmLike OR IsSqlPaaS OR IsStorage OR IsHybridComputeMachine) AS DefenderApplicable
FROM o_cat c
LEFT JOIN (SELECT lower(trim(DataProductId)) AS id, MAX(HasFullNameClassification) AS h, MAX(FullNameColumnCount) AS n
           FROM o_pii GROUP BY lower(trim(DataProductId))) f ON f.id = c.DataProductId

-- view: o_asset_counts
SELECT p.DataProductDisplayName AS DataProductName, COUNT(a.DataAssetId) AS TotalAssets
FROM g_product p JOIN g_product_asset pa ON pa.DataProductId = p.DataProductID
JOIN g_asset a ON a.DataAssetId = pa.DataAssetId GROUP BY p.DataProductDisplayName

-- view: o_tagged
SELECT lower(COALESCE(tag_pid_a, tag_pid_b, tag_pid_c)) AS DataProductId, lower(ResourceType) AS rtype, r.* FROM g_resource r

-- view: o_single
SELECT lower(tag_pid_a) AS DataProductId, lower(ResourceType) AS rtype,
       lower(ResourceType) IN ('microsoft.compute/virtualmachines', 'microsoft.hybridcompute/machines',
                               'microsoft.sqlvirtualmachine/sqlvirtualmachines') AS vmApplicable, r.*
FROM g_resource r WHERE tag_pid_a IS NOT NULL

-- view: o_vms
SELECT '2024-03-01 00:00:00' AS SnapshotUtc, DataProductId, ResourceId AS ComputeResourceId,
       regexp_extract(ResourceId, '([^/]+)$', 1) AS ComputeName, ResourceGroup, SubscriptionId, Location, security_type AS SecurityType,
       CASE WHEN lower(security_type) = 'confidentialvm' THEN 1 ELSE 0 END AS IsConfidential,
       CASE WHEN SubscriptionId IN ('S0', 'S1', 'S2') THEN 'tenant-a' ELSE 'tenant-b' END AS TenantId,
       COALESCE(lower(security_type) = 'confidentialvm', FALSE) AS IsConfidentialBool
FROM o_single WHERE rtype = 'microsoft.compute/virtualmachines'

-- view: o_vm_rollup
SELECT DataProductId, COUNT(*) AS ComputeVmCount, MAX(IsConfidential) AS AnyConfidential FROM o_vms GROUP BY DataProductId

-- view: o_gap_bad
SELECT TIMESTAMP '2024-03-01 00:00:00' AS SnapshotUtc, lower(f.DataProductId) AS DataProductId, f.DataProductDisplayName,
       f.FullNameColumnCount, v.ComputeVmCount, v.AnyConfidential AS IsConfidentialCompute
FROM o_pii f JOIN o_vm_rollup v ON v.DataProductId = lower(f.DataProductId)
WHERE f.HasFullNameClassification = 1 AND v.AnyConfidential = 0

-- view: o_gap_none
SELECT TIMESTAMP '2024-03-01 00:00:00' AS SnapshotUtc, lower(f.DataProductId) AS DataProductId, f.DataProductDisplayName,
       f.FullNameColumnCount, CAST(0 AS BIGINT) AS ComputeVmCount
FROM o_pii f LEFT JOIN o_vm_rollup v ON v.DataProductId = lower(f.DataProductId)
WHERE f.HasFullNameClassification = 1 AND v.DataProductId IS NULL

-- view: o_rollup
SELECT DataProductId, TRUE AS AzureResourceFound, CAST(COUNT(*) AS INT) AS AzureResourceCount,
       STRING_AGG(DISTINCT lower(trim(Location)), ',' ORDER BY lower(trim(Location))) AS AzureLocations,
       STRING_AGG(DISTINCT ResourceId, ',' ORDER BY ResourceId) AS AzureResourceIds
FROM o_tagged WHERE DataProductId IS NOT NULL GROUP BY DataProductId

-- view: o_rules
SELECT lower(trim(region_code)) AS RegionCode, MIN(trim(region_name)) AS RegionName,
       CASE WHEN lower(trim(MIN(approved))) IN ('yes', 'y', 'true', '1') THEN TRUE
            WHEN lower(trim(MIN(approved))) IN ('no', 'n', 'false', '0') THEN FALSE END AS IsApproved
FROM g_approved_region GROUP BY lower(trim(region_code))

-- view: o_region
SELECT d.*, COALESCE(trim(lower(d.ResidencyRegion)), '') IN ('', 'unknown', 'unknown (not assigned)', 'undefined') AS RegionMissing,
       COALESCE(bc.RegionCode, bn.RegionCode, lower(trim(d.ResidencyRegion))) AS RegionCode,
       COALESCE(bc.RegionName, bn.RegionName, trim(d.ResidencyRegion)) AS RegionName,
       bc.RegionCode IS NOT NULL OR bn.RegionCode IS NOT NULL AS IsApproved
FROM o_dim d
LEFT JOIN o_rules bc ON bc.IsApproved AND bc.RegionCode = lower(trim(d.ResidencyRegion))
LEFT JOIN o_rules bn ON bn.IsApproved AND lower(bn.RegionName) = lower(trim(d.ResidencyRegion))

-- view: o_bucket
SELECT bucketName, CASE WHEN bucketLocation IS NULL OR trim(bucketLocation) = '' OR upper(trim(bucketLocation)) = 'US' THEN 'us-east-1'
       ELSE lower(trim(bucketLocation)) END AS place FROM g_bucket

-- view: o_place
SELECT c.DataProductId,
       r.DataProductId IS NOT NULL OR b.bucketName IS NOT NULL AS AzureResourceFound,
       COALESCE(r.AzureResourceCount, CASE WHEN b.bucketName IS NULL THEN 0 ELSE 1 END) AS AzureResourceCount,
       COALESCE(b.place, r.AzureLocations, '') AS AzureLocations,
       COALESCE('arn:aws:s3:::' || b.bucketName, r.AzureResourceIds, '') AS AzureResourceIds
FROM o_cat c LEFT JOIN o_rollup r ON r.DataProductId = c.DataProductId
LEFT JOIN o_bucket b ON b.bucketName = c.DataProductDisplayName AND c.IsS3 AND r.DataProductId IS NULL

-- view: o_residency
SELECT TIMESTAMP '2024-03-01 00:00:00' AS SnapshotTimeUtc, DataProductId AS DataProductID, DataProductDisplayName, DataProductDescription,
       RegionName AS GlossaryResidencyRegionName, RegionCode AS GlossaryResidencyRegionCode, RegionMissing AS GlossaryResidencyMissing,
       IsApproved AS IsApprovedResidency, AzureResourceFound, AzureResourceCount, AzureLocations, AzureResourceIds, AzureLocationMatch,
       CASE band WHEN 'a' THEN 0 WHEN 'b' THEN 25 WHEN 'c' THEN 50 WHEN 'd' THEN 75 ELSE 100 END AS ResidencyScorePct,
       CASE band
         WHEN 'a' THEN 'Could not find Data Product''s associated Azure or AWS S3 resource using the dataproductid tag'
         WHEN 'b' THEN 'Found associated Azure/S3 resource but Purview is missing residency (glossary) as per dp_dataproductresidency_gold'
         WHEN 'c' THEN 'Found associated Azure/S3 resource + Purview residency (glossary) present, but does not match approved region list (rs_approved_regions)'
         WHEN 'd' THEN 'Found associated Azure/S3 resource + Purview residency present and approved, but does not match the associated resource''s region'
         ELSE 'Found associated Azure/S3 resource + Purview residency present and approved + matches the associated resource''s region' END AS ResidencyScoreReason
FROM (
  SELECT *, CASE WHEN NOT AzureResourceFound THEN 'a' WHEN RegionMissing THEN 'b' WHEN NOT IsApproved THEN 'c'
                 WHEN NOT AzureLocationMatch THEN 'd' ELSE 'e' END AS band
  FROM (SELECT g.*, p.AzureResourceFound, p.AzureResourceCount, p.AzureLocations, p.AzureResourceIds,
               p.AzureResourceFound AND g.IsApproved AND lower(trim(p.AzureLocations)) = COALESCE(g.RegionCode, '') AS AzureLocationMatch
        FROM o_region g JOIN o_place p ON p.DataProductId = g.DataProductId) x) y

-- view: o_tag_parts
SELECT b.*, COALESCE(e.found, FALSE) AS resourceFound, e.ResourceId AS resourceId, e.ResourceType, e.SubscriptionId, e.ResourceGroup,
       lower(trim(e.Location)) AS Location, NULLIF(lower(trim(e.tag_zone)), '') AS SovereigntyZone,
       NULLIF(lower(trim(e.tag_origin)), '') AS ResourceOrigin,
       CASE WHEN e.found THEN 20 ELSE 0 END AS p1,
       CASE WHEN trim(e.tag_zone) <> '' THEN 20 ELSE 0 END AS p2,
       CASE WHEN lower(trim(e.tag_zone)) IN ('standard', 'comprehensive') THEN 20 ELSE 0 END AS p3,
       CASE WHEN trim(e.tag_origin) <> '' THEN 20 ELSE 0 END AS p4,
       CASE WHEN lower(trim(e.tag_origin)) IN ('arc', 'azure') THEN 20 ELSE 0 END AS p5
FROM o_base b LEFT JOIN (
  SELECT TRUE AS found, *, ROW_NUMBER() OVER (PARTITION BY DataProductId ORDER BY ResourceId) AS rn FROM o_single) e
  ON e.rn = 1 AND e.DataProductId = b.DataProductId AND b.TagApplicable

-- view: o_tag
SELECT p1 AS resourceFound20, p2 AS sovereigntyZoneExists20, p3 AS sovereigntyZoneAllowed20, p4 AS resourceOriginExists20,
       p5 AS resourceOriginAllowed20, IsFabric, IsS3, IsSqlPaaS, IsStorage, IsVmLike, HasFullNameClassification, FullNameColumnCount,
       TagApplicable, ResidencyApplicable, CCApplicable, DefenderApplicable, Location, ResourceGroup, ResourceOrigin, ResourceType,
       s AS ScoreRaw, SovereigntyZone, SubscriptionId, TIMESTAMP '2024-03-01 00:00:00' AS SnapshotTimeUtc, s AS TagScorePct,
       CASE WHEN NOT TagApplicable THEN 'NotApplicable' WHEN s = 100 THEN 'Compliant' WHEN s >= 60 THEN 'Partial' ELSE 'NonCompliant' END AS TagState,
       CASE WHEN NOT TagApplicable THEN 'Tag check is not applicable for this data product (external/S3). N/A treated as compliant (100%).'
            WHEN NOT resourceFound THEN 'Couldn’t find the Azure resource (dataproductid tag not matched in searched subscriptions).'
            WHEN s = 100 THEN 'Required tags are present and allowed (sovereignty-zone, resource-origin).'
            WHEN p2 = 0 AND p4 = 0 THEN 'Both required tags are missing: sovereignty-zone and resource-origin.'
            WHEN p2 = 0 THEN 'Missing required tag: sovereignty-zone.'
            WHEN p4 = 0 THEN 'Missing required tag: resource-origin.'
            WHEN p3 = 0 AND p5 = 0 THEN 'Both tag values are not allowed: sovereignty-zone and resource-origin.'
            WHEN p3 = 0 THEN 'Tag value for sovereignty-zone is not allowed.'
            WHEN p5 = 0 THEN 'Tag value for resource-origin is not allowed.'
            ELSE 'Tag compliance partially met.' END AS TagReason,
       DataProductId AS dataProductId, DataProductDisplayName AS dataProductDisplayName, DataProductDescription AS dataProductDescription,
       ResidencyRegion AS residencyRegion, resourceFound, resourceId
FROM (SELECT *, CASE WHEN TagApplicable THEN p1 + p2 + p3 + p4 + p5 ELSE 100 END AS s FROM o_tag_parts) x

-- view: o_sku
SELECT lower(trim(sku)) AS sku_lc, bool_or(is_approved) AS approved FROM g_sku GROUP BY lower(trim(sku))

-- view: o_patch_report
SELECT lower(assessment_id) AS aid, MAX(COALESCE(startDateTime, lastModifiedDateTime)) AS at,
       MAX(CAST(json_extract_string(counts_json, '$.critical') AS BIGINT) + CAST(json_extract_string(counts_json, '$.security') AS BIGINT)) AS pending
FROM g_patch GROUP BY lower(assessment_id)

-- view: o_chosen
SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY DataProductId ORDER BY vmApplicable DESC, ResourceId) AS rn FROM o_single) x WHERE rn = 1

-- view: o_linked
SELECT r.ResourceId, v.vm_size AS LinkedVmSize, v.security_type AS LinkedSecurityType
FROM g_resource r LEFT JOIN g_resource v ON lower(v.ResourceId) = lower(r.linked_vm_id) AND lower(v.ResourceType) = 'microsoft.compute/virtualmachines'
WHERE lower(r.ResourceType) = 'microsoft.sqlvirtualmachine/sqlvirtualmachines' AND r.linked_vm_id IS NOT NULL

-- view: o_cc_evidence
SELECT c.DataProductId, TRUE AS resourceFound, c.vmApplicable, c.rtype, c.ResourceId, c.ResourceType, c.SubscriptionId, c.ResourceGroup,
       lower(trim(c.Location)) AS Location, c.linked_vm_id,
       CASE c.rtype WHEN 'microsoft.hybridcompute/machines' THEN c.arc_model WHEN 'microsoft.compute/virtualmachines' THEN c.vm_size
                    WHEN 'microsoft.sqlvirtualmachine/sqlvirtualmachines' THEN l.LinkedVmSize END AS VmSize,
       CASE WHEN c.rtype = 'microsoft.compute/virtualmachines' AND c.vm_size IS NOT NULL THEN c.security_type
            WHEN c.rtype = 'microsoft.sqlvirtualmachine/sqlvirtualmachines' AND l.LinkedVmSize IS NOT NULL THEN l.LinkedSecurityType END AS SecurityType,
       p.at AS LastUpdateScanUtc, p.pending AS PendingUpdatesTotal,
       CASE WHEN p.aid IS NOT NULL THEN 'Assessed' WHEN t.target IS NOT NULL THEN 'NoData' END AS PatchAssessmentStatus
FROM o_chosen c
LEFT JOIN o_linked l ON l.ResourceId = c.ResourceId
LEFT JOIN (SELECT ResourceId AS rid, CASE WHEN rtype IN ('microsoft.compute/virtualmachines', 'microsoft.hybridcompute/machines') THEN ResourceId
                       WHEN rtype = 'microsoft.sqlvirtualmachine/sqlvirtualmachines' THEN linked_vm_id END AS target FROM o_chosen) t ON t.rid = c.ResourceId
LEFT JOIN o_patch_report p ON p.aid = lower(t.target) || '/patchassessmentresults/latest'

-- view: o_cc
SELECT TIMESTAMP '2024-03-01 00:00:00' AS SnapshotUtc, DataProductId, DataProductDisplayName, HasFullNameClassification, FullNameColumnCount,
       CASE band WHEN 'nf' THEN 0 WHEN 'size' THEN 25 WHEN 'arc' THEN 50 WHEN 'not' THEN 50 WHEN 'unapproved' THEN 75 ELSE 100 END AS CCForPIIScore,
       CASE band WHEN 'pii' THEN 'NA_NotPII' WHEN 'nf' THEN 'NotFound' WHEN 'na' THEN 'NA_NotApplicable' ELSE 'Applicable' END AS CCForPIIStatus,
       CASE band WHEN 'pii' THEN 'The azure resource is not applicable for confidential compute. N/A is a 100% score'
                 WHEN 'na' THEN 'The azure resource is not applicable for confidential compute. N/A is a 100% score'
                 WHEN 'nf' THEN 'Couldn’t find the respective azure resource for the data product'
                 WHEN 'arc' THEN 'Found the resource but not running confidential compute or arc model property is null/empty'
                 WHEN 'size' THEN 'Found the azure/arc/sql vm resource and it is a confidential compute applicable resource (azure vm or arc machine)'
                 WHEN 'not' THEN 'Found the resource but not running confidential compute'
                 WHEN 'unapproved' THEN 'Found the resource but not running the approved confidential compute sku'
                 ELSE 'Found the resource running the approved confidential compute sku' END AS Reason,
       ResourceId, ResourceType, SubscriptionId, ResourceGroup, Location, VmSize, SecurityType,
       CCApplicable AND COALESCE(approved, FALSE) AS IsApprovedSku, CAST(NULL AS BOOLEAN) AS IsApprovedRegion,
       CASE WHEN ResourceId IS NULL THEN NULL
            WHEN NOT vmApplicable THEN 'Resource found but it is not an Azure VM, Arc machine, or SQL VM. Treat as N/A for Confidential Compute scoring.'
            WHEN rtype = 'microsoft.hybridcompute/machines' THEN 'Arc machine details returned from ARG. Use ccLookupSku (Arc model) + resource.location in Fabric to score against rulesets. Patch assessment is sourced from Azure Update Manager / ARG when available.'
            WHEN rtype = 'microsoft.compute/virtualmachines' AND VmSize IS NULL THEN 'VM found via Resource Graph, but failed to read VM details from ARM.'
            WHEN rtype = 'microsoft.compute/virtualmachines' THEN 'VM details returned from ARG. Use ccLookupSku (VM size) + resource.location in Fabric to score against rulesets. Patch assessment is sourced from Azure Update Manager / ARG when available.'
            WHEN linked_vm_id IS NULL THEN 'SQL VM resource found, but linked compute VM resource id was empty in properties.virtualMachineResourceId.'
            WHEN VmSize IS NULL THEN 'SQL VM resource found, but failed to read linked compute VM details from ARG/ARM.'
            ELSE 'SQL VM found. Linked compute VM details returned from ARG. Use ccLookupSku (VM size) + resource.location in Fabric to score against rulesets. Patch assessment is sourced from the linked compute VM when available.' END AS DetailsNote,
       CAST(NULL AS VARCHAR) AS ArmError, LastUpdateScanUtc, PendingUpdatesTotal, PatchAssessmentStatus
FROM (
  SELECT b.*, e.resourceFound, e.vmApplicable, e.rtype, e.ResourceId, e.ResourceType, e.SubscriptionId, e.ResourceGroup, e.Location, e.linked_vm_id,
         e.VmSize, e.SecurityType, e.LastUpdateScanUtc, e.PendingUpdatesTotal, e.PatchAssessmentStatus, s.approved,
         CASE WHEN NOT b.CCApplicable THEN 'pii' WHEN e.resourceFound IS NULL THEN 'nf' WHEN NOT e.vmApplicable THEN 'na'
              WHEN e.rtype = 'microsoft.hybridcompute/machines' AND e.VmSize IS NULL THEN 'arc'
              WHEN e.rtype = 'microsoft.compute/virtualmachines' AND e.VmSize IS NULL THEN 'size'
              WHEN s.sku_lc IS NULL THEN 'not' WHEN NOT s.approved THEN 'unapproved' ELSE 'good' END AS band
  FROM o_base b LEFT JOIN o_cc_evidence e ON e.DataProductId = b.DataProductId AND b.CCApplicable
  LEFT JOIN o_sku s ON s.sku_lc = lower(trim(e.VmSize))) x

-- view: o_def_resource
SELECT r.DataProductId, r.ResourceId, r.ResourceType, r.SubscriptionId, r.ResourceGroup, r.Location, r.plans, r.ok,
       r.ok AND EXISTS (SELECT 1 FROM g_pricing p WHERE p.SubscriptionId = r.SubscriptionId AND lower(p.pricingTier) = 'standard'
                        AND contains(',' || r.plans || ',', ',' || lower(p.plan_name) || ',')) AS configured,
       CASE WHEN r.ok THEN COALESCE(a.total, 0) END AS total, CASE WHEN r.ok THEN COALESCE(a.bad, 0) END AS bad,
       CASE WHEN r.ok THEN COALESCE(l.n, 0) END AS alerts
FROM (SELECT *, plans <> '' AS ok FROM (
        SELECT *, CASE WHEN rtype = 'microsoft.compute/virtualmachines' THEN 'virtualmachines,sqlservervirtualmachines'
                       WHEN rtype = 'microsoft.hybridcompute/machines' THEN 'virtualmachines'
                       WHEN rtype LIKE 'microsoft.sql/%' THEN 'sqlservers,sqlservervirtualmachines'
                       WHEN rtype = 'microsoft.storage/storageaccounts' THEN 'storageaccounts' ELSE '' END AS plans
        FROM o_tagged WHERE DataProductId IS NOT NULL) z) r
LEFT JOIN (SELECT resource_id, COUNT(*) AS total, SUM(CASE WHEN lower(statusCode) = 'unhealthy' THEN 1 ELSE 0 END) AS bad
           FROM g_assessment GROUP BY resource_id) a ON a.resource_id = lower(r.ResourceId)
LEFT JOIN (SELECT resource_id, COUNT(*) AS n FROM g_alert WHERE status = 'Active' AND severity = 'High' GROUP BY resource_id) l
  ON l.resource_id = lower(r.ResourceId)

-- view: o_def_rollup
SELECT DataProductId, CAST(SUM(CASE WHEN ok THEN 1 ELSE 0 END) AS INT) AS applicableResourceCount,
       CAST(SUM(CASE WHEN configured THEN 1 ELSE 0 END) AS INT) AS configuredResourceCount,
       CAST(SUM(CASE WHEN configured AND total > 0 THEN 1 ELSE 0 END) AS INT) AS runningResourceCount,
       CAST(COALESCE(SUM(alerts), 0) AS INT) AS highActiveAlertCount, COALESCE(MAX(bad), 0) > 0 AS hasUnhealthyAssessments
FROM o_def_resource GROUP BY DataProductId

-- view: o_defender
SELECT DataProductId AS dataProductId, TIMESTAMP '2024-03-01 00:00:00' AS snapshotUtc, found AS resourceFound, applicable,
       CASE band WHEN 'nf' THEN 0 WHEN 'notConfigured' THEN 25 WHEN 'runningUnhealthy' THEN 50 WHEN 'configuredNotRunning' THEN 50
                 WHEN 'runningHealthyWithActiveAlert' THEN 75 ELSE 100 END AS progressScore,
       CASE band WHEN 'nf' THEN 'NotFound' WHEN 'na' THEN 'NA_NotApplicable' ELSE band END AS progressState,
       applicableResourceCount, configuredResourceCount, runningResourceCount, highActiveAlertCount, hasUnhealthyAssessments,
       CASE band WHEN 'na' THEN '{"note": "Defender not applicable for this data product. N/A treated as compliant (100%)."}'
                 WHEN 'nf' THEN '{"note": "No Azure resources found with matching DataProductId tag."}'
                 WHEN 'notApplicable' THEN '{"note": "Resources found, but none are applicable for Defender plans (treated as N/A => 100)."}'
                 ELSE '{}' END AS detailsJson, IsHybridComputeMachine
FROM (
  SELECT *, CASE WHEN NOT DefenderApplicable THEN 'na' WHEN NOT found THEN 'nf' WHEN NOT applicable THEN 'notApplicable'
                 WHEN configuredResourceCount <= 0 THEN 'notConfigured' WHEN hasUnhealthyAssessments THEN 'runningUnhealthy'
                 WHEN runningResourceCount <= 0 THEN 'configuredNotRunning' WHEN highActiveAlertCount > 0 THEN 'runningHealthyWithActiveAlert'
                 ELSE 'runningHealthy' END AS band
  FROM (SELECT b.DataProductId, b.DefenderApplicable, b.IsHybridComputeMachine, r.DataProductId IS NOT NULL AS found,
               b.DefenderApplicable AND (r.DataProductId IS NULL OR r.applicableResourceCount > 0) AS applicable,
               COALESCE(r.applicableResourceCount, 0) AS applicableResourceCount, COALESCE(r.configuredResourceCount, 0) AS configuredResourceCount,
               COALESCE(r.runningResourceCount, 0) AS runningResourceCount, COALESCE(r.highActiveAlertCount, 0) AS highActiveAlertCount,
               COALESCE(r.hasUnhealthyAssessments, FALSE) AS hasUnhealthyAssessments
        FROM o_base b LEFT JOIN o_def_rollup r ON r.DataProductId = b.DataProductId AND b.DefenderApplicable) x) y

-- view: o_patch_score
SELECT DataProductId, CAST(ROUND(AVG(CASE WHEN PatchAssessmentStatus = 'NoData' THEN 0.0
       WHEN PatchAssessmentStatus = 'Assessed' AND COALESCE(PendingUpdatesTotal, 0) > 0 THEN 50.0 ELSE 100.0 END), 0) AS INT) AS PatchComplianceScorePct
FROM o_cc GROUP BY DataProductId

-- view: o_products
SELECT DataProductId, MAX(DataProductDisplayName) AS DataProductDisplayName FROM (
  SELECT lower(trim(DataProductID)) AS DataProductId, DataProductDisplayName FROM o_gold UNION
  SELECT DataProductId, DataProductDisplayName FROM o_cc UNION
  SELECT dataProductId, NULL FROM o_defender UNION
  SELECT dataProductId, dataProductDisplayName FROM o_tag) x GROUP BY DataProductId

-- view: o_summary
SELECT p.DataProductId, p.DataProductDisplayName, r.s AS ResidencyScorePct, c.s AS CCScorePct, d.s AS DefenderScorePct, t.s AS TagScorePct,
       h.PatchComplianceScorePct
FROM o_products p
LEFT JOIN (SELECT DataProductID AS id, CAST(ROUND(AVG(ResidencyScorePct), 0) AS INT) AS s FROM o_residency GROUP BY 1) r ON r.id = p.DataProductId
LEFT JOIN (SELECT DataProductId AS id, CAST(ROUND(AVG(CCForPIIScore), 0) AS INT) AS s FROM o_cc GROUP BY 1) c ON c.id = p.DataProductId
LEFT JOIN (SELECT dataProductId AS id, CAST(ROUND(AVG(progressScore), 0) AS INT) AS s FROM o_defender GROUP BY 1) d ON d.id = p.DataProductId
LEFT JOIN (SELECT dataProductId AS id, CAST(ROUND(AVG(TagScorePct), 0) AS INT) AS s FROM o_tag GROUP BY 1) t ON t.id = p.DataProductId
LEFT JOIN o_patch_score h ON h.DataProductId = p.DataProductId

-- view: o_elig
SELECT SnapshotTimeUtc, TIMESTAMP '2024-03-01 00:00:00' AS EligibilityComputedAtUtc, DataProductID, DataProductDisplayName, DataProductDescription,
       gname AS GlossaryResidencyRegionName, gcode AS GlossaryResidencyRegionCode, GlossaryResidencyMissing, AzureResourceFound, AzureResourceCount,
       code AS AzureResidencyCode, AzureLocations AS AzureLocationsRaw, AzureResourceIds, AzureLocationMatch,
       COALESCE(instr(code, ',') = 0, FALSE) AS HasSingleClearAzureResidencyValue, ok AS IsAzureRegionApproved, rule_code AS ApprovedRegionCodeMatch,
       rule_name AS ApprovedRegionName, rule_notes AS ApprovedRegionNotes, ResidencyScorePct, ResidencyScoreReason,
       IsApprovedResidency AS IsApprovedResidency_ScorecardField, code AS TargetResidencyCode, gcode AS ExpectedCurrentResidencyCode,
       AzureResourceFound AND AzureResourceCount >= 1 AND code IS NOT NULL AND instr(code, ',') = 0 AND ok
         AND (GlossaryResidencyMissing OR COALESCE(gcode, '') <> code) AS EligibleForResidencyUpdate,
       CASE WHEN NOT AzureResourceFound THEN 'Azure resource not found for data product'
            WHEN AzureResourceCount < 1 THEN 'No mapped Azure resource found for data product'
            WHEN code IS NULL THEN 'Azure residency not detected'
            WHEN instr(code, ',') > 0 THEN 'Multiple Azure residency values detected; manual review required'
            WHEN NOT ok THEN 'Azure residency is not in approved region list; do not offer Purview update'
            WHEN GlossaryResidencyMissing THEN 'Eligible: Purview residency missing; Azure residency detected and approved'
            WHEN COALESCE(gcode, '') = code THEN 'Purview residency already matches Azure residency'
            ELSE 'Eligible: Purview residency differs from Azure residency; Azure residency detected and approved' END AS EligibilityReason,
       CASE WHEN AzureResourceFound AND AzureResourceCount >= 1 AND code IS NOT NULL AND instr(code, ',') = 0 AND ok
            THEN CASE WHEN GlossaryResidencyMissing THEN 'add' WHEN COALESCE(gcode, '') <> code THEN 'replace' ELSE 'none' END
            ELSE 'none' END AS SuggestedPurviewResidencyAction, 'v1' AS EligibilityLogicVersion
FROM (
  SELECT c.*, NULLIF(lower(trim(c.GlossaryResidencyRegionName)), '') AS gname, NULLIF(lower(trim(c.GlossaryResidencyRegionCode)), '') AS gcode,
         NULLIF(lower(trim(c.AzureLocations)), '') AS code, lower(trim(a.region_code)) AS rule_code, a.region_name AS rule_name, a.notes AS rule_notes,
         COALESCE(lower(trim(a.approved)) IN ('true', '1', 'yes', 'y'), FALSE) AS ok
  FROM o_residency c LEFT JOIN g_approved_region a ON lower(trim(a.region_code)) = NULLIF(lower(trim(c.AzureLocations)), '')) x

-- view: o_owner
SELECT o.id AS DataProductId, o.oid AS OwnerObjectId, COALESCE(c.OwnerName, 'Data Office') AS OwnerName,
       COALESCE(c.OwnerEmail, 'data-office@example.com') AS OwnerEmail, CASE WHEN c.OwnerObjectId IS NULL THEN 'Fallback' ELSE 'Directory' END AS OwnerSource,
       CASE WHEN c.OwnerObjectId IS NULL THEN 'NotResolved' ELSE 'Resolved' END AS ResolveStatus, CAST(NULL AS VARCHAR) AS ResolveError,
       '2024-03-01 00:00:00' AS SnapshotUtc
FROM (SELECT lower(trim(DataProductId)) AS id, MIN(trim(DataProductOwnerId)) AS oid FROM g_owner WHERE trim(DataProductOwnerId) <> ''
      GROUP BY lower(trim(DataProductId))) o
LEFT JOIN g_owner_contact c ON c.OwnerObjectId = o.oid

-- view: o_queue
SELECT c.DataProductId, COALESCE(c.DataProductDisplayName, d.DataProductDisplayName) AS DataProductDisplayName, d.DataProductDescription,
       c.CCForPIIScore AS CCScorePct, c.CCForPIIStatus AS CCState, c.Reason AS CCReason, TRUE AS InvestigationRequired,
       CASE c.CCForPIIScore WHEN 50 THEN 'CC_NOT_CONFIDENTIAL_OR_MODEL_MISSING' ELSE 'CC_CONFIDENTIAL_BUT_NOT_APPROVED' END AS InvestigationReasonCode,
       TRUE AS ResourceFound, TRUE AS CCApplicableResource, TRUE AS CCApplicable, c.ResourceId, regexp_extract(c.ResourceId, '([^/]+)$', 1) AS ResourceName,
       c.ResourceType, c.SubscriptionId, c.ResourceGroup, c.Location, c.HasFullNameClassification, c.FullNameColumnCount, o.OwnerObjectId, o.OwnerName,
       o.OwnerEmail, o.OwnerSource, o.ResolveStatus AS OwnerResolveStatus, 'compliance-status' AS SuggestedTagKey, 'investigate' AS SuggestedTagValue,
       c.VmSize AS LookupSkuOrModel, c.IsApprovedSku,
       CASE lower(c.ResourceType) WHEN 'microsoft.compute/virtualmachines' THEN 'AzureVM' WHEN 'microsoft.hybridcompute/machines' THEN 'ArcMachine'
            ELSE 'SqlVirtualMachine' END AS CCResourceKind, CAST(NULL AS VARCHAR) AS ArcCloudProvider, CAST(NULL AS VARCHAR) AS ArcStatus,
       c.VmSize AS VmSizeCompat, c.SecurityType, '2024-03-01 00:00:00' AS SnapshotUtc
FROM o_cc c LEFT JOIN o_owner o ON o.DataProductId = c.DataProductId LEFT JOIN o_dim d ON d.DataProductId = c.DataProductId
WHERE c.HasFullNameClassification = 1 AND c.CCForPIIScore IN (50, 75)
  AND lower(c.ResourceType) IN ('microsoft.compute/virtualmachines', 'microsoft.hybridcompute/machines', 'microsoft.sqlvirtualmachine/sqlvirtualmachines')

-- view: o_cat_deltas
SELECT SnapshotUtc, TotalAssets, IsApproximate, p AS PrevTotalAssets, TotalAssets - p AS DeltaAssets,
       CASE WHEN p <> 0 THEN CAST(TotalAssets - p AS DOUBLE) / p END AS DeltaPct
FROM (SELECT SnapshotUtc, TotalAssets, IsApproximate, LAG(TotalAssets) OVER (ORDER BY SnapshotUtc) AS p FROM h_catalog) x

-- view: o_asset_deltas
SELECT SnapshotTS, SnapshotDate, DataProductName, TotalAssets, p AS PrevAssets, TotalAssets - p AS DeltaAssets,
       CASE WHEN p <> 0 THEN CAST(TotalAssets - p AS DOUBLE) / p END AS DeltaPct
FROM (SELECT *, LAG(TotalAssets) OVER (PARTITION BY DataProductName ORDER BY SnapshotTS) AS p FROM h_asset) x

-- view: o_res_deltas
SELECT SnapshotUtc, SnapshotDate, DataProductID, DataProductDisplayName, PrevSnapshotUtc, PrevResidencyRegion, ResidencyRegion,
       COALESCE(ResidencyRegion <> PrevResidencyRegion, FALSE) AS HasChanged
FROM (SELECT Snapshots AS SnapshotUtc, SnapshotDate, DataProductID, DataProductDisplayName, ResidencyRegion,
             LAG(ResidencyRegion) OVER w AS PrevResidencyRegion, LAG(Snapshots) OVER w AS PrevSnapshotUtc
      FROM h_residency WINDOW w AS (PARTITION BY DataProductID ORDER BY Snapshots)) x

-- view: o_asset_totals
SELECT SnapshotTS AS SnapUtc, CAST(SUM(TotalAssets) AS BIGINT) AS TotalProductAssets FROM h_asset GROUP BY SnapshotTS

-- view: o_res_totals
SELECT Snapshots AS SnapUtc, COUNT(DISTINCT DataProductID) AS TotalDataProducts,
       COUNT(*) FILTER (WHERE ResidencyRegion IS NULL OR ResidencyRegion = '') AS ProductsMissingResidency,
       COUNT(*) FILTER (WHERE ResidencyRegion IS NOT NULL AND ResidencyRegion <> '') AS ProductsWithResidency
FROM h_residency GROUP BY Snapshots

-- view: o_asof_assets
SELECT SnapshotUtc, TotalAssets, TotalProductAssets FROM (
  SELECT c.SnapshotUtc, c.TotalAssets, a.TotalProductAssets, ROW_NUMBER() OVER (PARTITION BY c.SnapshotUtc ORDER BY a.SnapUtc DESC NULLS LAST) AS rn
  FROM h_catalog c LEFT JOIN o_asset_totals a ON a.SnapUtc <= c.SnapshotUtc AND floor(epoch(c.SnapshotUtc)) - floor(epoch(a.SnapUtc)) <= 21600) x WHERE rn = 1

-- view: o_asof_res
SELECT SnapshotUtc, TotalDataProducts, ProductsMissingResidency, ProductsWithResidency FROM (
  SELECT c.SnapshotUtc, r.*, ROW_NUMBER() OVER (PARTITION BY c.SnapshotUtc ORDER BY r.SnapUtc DESC NULLS LAST) AS rn
  FROM h_catalog c LEFT JOIN o_res_totals r ON r.SnapUtc <= c.SnapshotUtc AND floor(epoch(c.SnapshotUtc)) - floor(epoch(r.SnapUtc)) <= 21600) x WHERE rn = 1

-- view: o_timeline
SELECT c.SnapshotUtc, c.TotalAssets AS TotalPurviewAssets, c.IsApproximate, a.TotalProductAssets, r.TotalDataProducts, r.ProductsMissingResidency,
       r.ProductsWithResidency, CASE WHEN r.TotalDataProducts <> 0 THEN CAST(r.ProductsWithResidency AS DOUBLE) / r.TotalDataProducts END AS ResidencyCoveragePct,
       CASE WHEN c.TotalAssets <> 0 THEN CAST(a.TotalProductAssets AS DOUBLE) / c.TotalAssets END AS ProductAssetsToPurviewAssetsRatio
FROM h_catalog c JOIN o_asof_assets a ON a.SnapshotUtc = c.SnapshotUtc JOIN o_asof_res r ON r.SnapshotUtc = c.SnapshotUtc
WHERE a.TotalProductAssets IS NOT NULL AND r.TotalDataProducts IS NOT NULL

-- view: o_alerts
SELECT 'catalog' AS "key", CASE WHEN DeltaPct > 0 THEN 'spike' ELSE 'drop' END AS kind, CAST(PrevTotalAssets AS VARCHAR) AS prev,
       CAST(TotalAssets AS VARCHAR) AS "value", DeltaPct AS pct, SnapshotUtc AS ts FROM o_cat_deltas WHERE abs(DeltaPct) >= 0.05
UNION ALL
SELECT DataProductName, CASE WHEN DeltaPct > 0 THEN 'spike' ELSE 'drop' END, CAST(PrevAssets AS VARCHAR), CAST(TotalAssets AS VARCHAR), DeltaPct, SnapshotTS
FROM o_asset_deltas WHERE abs(DeltaPct) >= 0.05
UNION ALL
SELECT DataProductID, CASE WHEN HasChanged THEN 'RegionChanged' WHEN ResidencyRegion IS NOT NULL THEN 'GainedRegion' ELSE 'LostRegion' END,
       PrevResidencyRegion, ResidencyRegion, CAST(NULL AS DOUBLE), SnapshotUtc
FROM o_res_deltas WHERE PrevSnapshotUtc IS NOT NULL AND ResidencyRegion IS DISTINCT FROM PrevResidencyRegion

-- view: o_current_terms
SELECT lower(trim(a.DataProductId)) AS pid, COUNT(DISTINCT a.GlossaryTermId) AS terms, MIN(a.GlossaryTermId) AS term_id
FROM g_term_assignment a JOIN g_term t ON t.GlossaryTermId = a.GlossaryTermId AND t.ParentGlossaryTermId = 'P-REGION'
WHERE a.ActiveFlag = 1 GROUP BY lower(trim(a.DataProductId))

-- view: o_plan
SELECT requestId, dataProductId, DataProductDisplayName,
       CASE WHEN band IN ('no id', 'bad id', 'no target', 'several', 'no term') THEN 'rejected' WHEN band IN ('manual', 'conflict') THEN 'blocked'
            WHEN band = 'same' THEN 'no_change' ELSE 'preview' END AS status,
       CASE band WHEN 'manual' THEN 'manual_review' WHEN 'add' THEN 'add' WHEN 'replace' THEN 'replace' ELSE 'none' END AS action,
       CASE band WHEN 'no id' THEN 'Missing required parameter ''dataProductId''.' WHEN 'bad id' THEN 'Invalid ''dataProductId''. Expected GUID.'
                 WHEN 'no target' THEN 'Missing required parameter ''targetResidencyCode''.'
                 WHEN 'several' THEN 'targetResidencyCode must be a single region code (deterministic single value).'
                 WHEN 'no term' THEN 'Target term not found under the parent term.'
                 WHEN 'manual' THEN 'Multiple child terms are assigned under the residency parent term; manual review required.'
                 WHEN 'conflict' THEN 'Purview current residency changed since preview or caller expectation is stale.'
                 WHEN 'same' THEN 'Purview residency already matches target Azure residency code.' END AS notes,
       band IN ('same', 'add', 'replace') AS canApply,
       CASE WHEN band IN ('add', 'replace') THEN TRUE WHEN band = 'same' THEN FALSE END AS needsChange,
       band = 'manual' AS manualReviewRequired, band = 'conflict' AS conflict,
       CASE band WHEN 'add' THEN '1:addTermRelationship:' || target_id
                 WHEN 'replace' THEN '1:deleteTermRelationship:' || term_id || ';2:addTermRelationship:' || target_id ELSE '' END AS operations,
       CASE WHEN COALESCE(terms, 0) <= 1 THEN now_code END AS currentResidencyCode, target AS targetResidencyCode, expected AS expectedCurrentResidencyCode,
       dryRun, confirm, target_id, term_id
FROM (
  SELECT q.*, c.terms, c.term_id, lower(trim(ct.GlossaryTermDisplayName)) AS now_code, tt.GlossaryTermId AS target_id, d.DataProductDisplayName,
         CASE WHEN q.dataProductId = '' THEN 'no id' WHEN NOT regexp_matches(q.dataProductId, '^dp-[0-9]+$') THEN 'bad id'
              WHEN target IS NULL THEN 'no target' WHEN contains(target, ',') THEN 'several' WHEN tt.GlossaryTermId IS NULL THEN 'no term'
              WHEN c.terms > 1 THEN 'manual'
              WHEN expectedProvided AND expected IS DISTINCT FROM lower(trim(ct.GlossaryTermDisplayName)) THEN 'conflict'
              WHEN lower(trim(ct.GlossaryTermDisplayName)) = target THEN 'same' WHEN c.term_id IS NULL THEN 'add' ELSE 'replace' END AS band
  FROM (SELECT requestId, COALESCE(lower(trim(dataProductId)), '') AS dataProductId, NULLIF(lower(trim(targetResidencyCode)), '') AS target,
               NULLIF(lower(trim(expectedCurrentResidencyCode)), '') AS expected, expectedProvided, dryRun, confirm FROM g_residency_request) q
  LEFT JOIN o_current_terms c ON c.pid = q.dataProductId
  LEFT JOIN g_term ct ON ct.GlossaryTermId = c.term_id
  LEFT JOIN (SELECT lower(trim(GlossaryTermDisplayName)) AS name, MIN(GlossaryTermId) AS GlossaryTermId FROM g_term
             WHERE ParentGlossaryTermId = 'P-REGION' GROUP BY 1) tt ON tt.name = q.target
  LEFT JOIN o_dim d ON d.DataProductId = q.dataProductId) x

-- view: o_apply
SELECT requestId, dataProductId, DataProductDisplayName, action,
       CASE WHEN go THEN 'applied' WHEN needsChange AND NOT dryRun THEN 'needs_confirmation' ELSE status END AS status,
       go AS applied, CASE WHEN go THEN TRUE END AS verifiedMatch, currentResidencyCode, targetResidencyCode, dryRun,
       CASE WHEN go THEN 'Post-update verification succeeded.' ELSE COALESCE(notes, '') END AS notes
FROM (SELECT *, COALESCE(needsChange, FALSE) AND NOT dryRun AND confirm AS go FROM o_plan) x

-- view: o_after
SELECT a.DataProductId, a.GlossaryTermId, a.ActiveFlag FROM g_term_assignment a
WHERE NOT (a.ActiveFlag = 1 AND EXISTS (SELECT 1 FROM o_plan p WHERE p.needsChange AND NOT p.dryRun AND p.confirm AND p.action = 'replace'
           AND p.dataProductId = lower(trim(a.DataProductId)) AND p.term_id = a.GlossaryTermId))
UNION ALL
SELECT g.raw, p.target_id, 1 FROM o_plan p JOIN g_pid g ON g.norm = p.dataProductId WHERE p.needsChange AND NOT p.dryRun AND p.confirm

-- view: o_tag_plan
SELECT NULLIF(trim(i.resourceId), '') AS resourceId, i.dataProductId, i.dataProductDisplayName, i.ownerEmail, i.ccScorePct,
       COALESCE(i.tagKey, 'compliance-status') AS tagKey, COALESCE(i.tagValue, 'investigate') AS tagValue, FALSE AS dryRun,
       r.rk IS NOT NULL AS applied,
       CASE WHEN r.rk IS NOT NULL THEN concat_ws(';', 'DataProductID=' || r.tag_pid_b, 'DataProductId=' || r.tag_pid_c, 'dataproductid=' || r.tag_pid_a,
            'resource-origin=' || r.tag_origin, 'sovereignty-zone=' || r.tag_zone) END AS beforeTags,
       CASE WHEN r.rk IS NULL THEN NULL
            WHEN i.tagKey IS NOT NULL THEN concat_ws(';', 'DataProductID=' || r.tag_pid_b, 'DataProductId=' || r.tag_pid_c, 'dataproductid=' || r.tag_pid_a,
                 'resource-origin=' || r.tag_origin, 'sovereignty-zone=comprehensive')
            ELSE concat_ws(';', 'DataProductID=' || r.tag_pid_b, 'DataProductId=' || r.tag_pid_c, 'compliance-status=investigate',
                 'dataproductid=' || r.tag_pid_a, 'resource-origin=' || r.tag_origin, 'sovereignty-zone=' || r.tag_zone) END AS afterTags,
       CASE WHEN r.rk IS NULL THEN 'error' ELSE 'applied' END AS status,
       CASE WHEN trim(i.resourceId) = '' THEN 'Missing resourceId in item.' WHEN r.rk IS NULL THEN 'Failed to apply tag: resource not found'
            ELSE 'Investigate tag applied via Microsoft.Resources/tags/default (merged with existing tags).' END AS note
FROM g_tag_item i LEFT JOIN g_resource r ON lower(r.ResourceId) = lower(trim(i.resourceId))

-- view: o_flags
SELECT d.DataProductId, d.DataProductDisplayName, COALESCE(f.h, 0) AS m08_has_full_name, COALESCE(v.AnyConfidential, 0) AS m09_has_confidential_compute,
       CASE WHEN f.h = 1 AND v.AnyConfidential = 1 THEN 1 ELSE 0 END AS m10_both
FROM o_dim d
LEFT JOIN (SELECT lower(trim(DataProductId)) AS id, MAX(HasFullNameClassification) AS h FROM o_pii GROUP BY 1) f ON f.id = d.DataProductId
LEFT JOIN o_vm_rollup v ON v.DataProductId = d.DataProductId

-- view: o_visual
SELECT visual_id, page_id, json_extract_string(definition, '$.visual.query.field.Column.Expression.SourceRef.Entity') AS e1,
       json_extract_string(definition, '$.visual.filter.Measure.Expression.SourceRef.Entity') AS e2,
       json_extract_string(definition, '$.visual.query.field.Column.Property') AS p1, json_extract_string(definition, '$.visual.filter.Measure.Property') AS p2
FROM g_visual

-- view: o_lineage
SELECT DISTINCT entity, visual_id, page_id, CASE WHEN p1 = p2 THEN p1 WHEN p1 < p2 THEN p1 || ',' || p2 ELSE p2 || ',' || p1 END AS properties
FROM (SELECT e1 AS entity, * FROM o_visual UNION ALL SELECT e2, * FROM o_visual) x

-- view: o_redacted
SELECT doc_id, "text" AS t0, replace("text", 'mail5.example.com', '<MAIL_HOST>') AS t1,
       regexp_replace(replace("text", 'mail5.example.com', '<MAIL_HOST>'), '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}', '<OWNER_EMAIL>', 'g') AS t2
FROM documents

-- view: o_redacted_all
SELECT doc_id, t0, t1, t2, regexp_replace(t2, 'https://[A-Za-z0-9-]+\.azurewebsites\.net', 'https://<FUNCTION_APP>.azurewebsites.net', 'g') AS t3,
       regexp_replace(regexp_replace(t2, 'https://[A-Za-z0-9-]+\.azurewebsites\.net', 'https://<FUNCTION_APP>.azurewebsites.net', 'g'),
                      'https://[A-Za-z0-9-]+\.vault\.azure\.net/?', 'https://<KEYVAULT_NAME>.vault.azure.net/', 'g') AS t4
FROM o_redacted

-- view: o_audit
SELECT a.DataProductId, substr(a.t, 1, 200000) AS resourcesJson, substr(b.t, 1, 200000) AS evaluatedResourcesJson FROM (
  SELECT DataProductId, '[' || STRING_AGG('{"id":"' || ResourceId || '","name":"' || regexp_extract(ResourceId, '([^/]+)$', 1) || '","type":"' || ResourceType
         || '","subscriptionId":"' || SubscriptionId || '","resourceGroup":"' || ResourceGroup || '","location":"' || Location || '","defenderCandidatePlans":['
         || CASE WHEN ok THEN '"' || replace(plans, ',', '","') || '"' ELSE '' END || '],"defenderApplicable":' || CAST(ok AS VARCHAR) || '}', ',' ORDER BY ResourceId) || ']' AS t
  FROM o_def_resource GROUP BY DataProductId) a
LEFT JOIN (
  SELECT DataProductId, '[' || STRING_AGG('{"id":"' || ResourceId || '","candidatePlans":["' || replace(plans, ',', '","') || '"],"defenderConfigured":' || CAST(configured AS VARCHAR)
         || ',"hasAssessments":' || CAST(total > 0 AS VARCHAR) || ',"defenderRunning":' || CAST(configured AND total > 0 AS VARCHAR) || ',"assessmentsTotal":' || CAST(total AS VARCHAR)
         || ',"assessmentsUnhealthy":' || CAST(CAST(bad AS BIGINT) AS VARCHAR) || ',"highActiveAlerts":' || CAST(alerts AS VARCHAR) || '}', ',' ORDER BY ResourceId) || ']' AS t
  FROM o_def_resource WHERE ok GROUP BY DataProductId) b ON b.DataProductId = a.DataProductId

-- view: o_visuals
SELECT visual_id, COALESCE(json_extract_string(definition, '$.visual.visualType'), 'unknown') AS visual_type,
       COALESCE(trim(json_extract_string(definition, '$.visual.visualContainerObjects.title[0].properties.text.expr.Literal.Value'), ''''), 'Untitled') AS title,
       COALESCE(NULLIF(regexp_extract(path, '([^/]+)__Report/', 1), ''), 'unknown') AS report,
       COALESCE(NULLIF(regexp_extract(path, '/pages/([^/]+)/', 1), ''), 'unknown') AS page
FROM g_visual

-- view: o_star
SELECT 'inventory' AS fact, DataProductId AS fact_key, 'id' AS side FROM o_vms
UNION ALL SELECT 'gap_no_compute', DataProductId, 'id' FROM o_gap_none
UNION ALL SELECT 'gap_not_confidential', DataProductId, 'id' FROM o_gap_bad
UNION ALL SELECT 'classification', DataProductId, 'id' FROM o_pii
UNION ALL SELECT 'asset_counts', DataProductName, 'description' FROM o_asset_counts
UNION ALL SELECT 'eligibility', DataProductID, 'id' FROM o_elig
UNION ALL SELECT 'cc', DataProductId, 'id' FROM o_cc
UNION ALL SELECT 'queue', DataProductId, 'id' FROM o_queue
UNION ALL SELECT 'residency (inactive)', DataProductDescription, 'id' FROM o_residency
UNION ALL SELECT 'defender', dataProductId, 'id' FROM o_defender
UNION ALL SELECT 'tag', dataProductId, 'id' FROM o_tag
UNION ALL SELECT 'summary', DataProductId, 'id' FROM o_summary
UNION ALL SELECT 'scores: queue', DataProductId, 'id' FROM o_queue
UNION ALL SELECT 'scores: signals', DataProductId, 'id' FROM o_cc
UNION ALL SELECT 'scores: summary (inactive)', DataProductId, 'id' FROM o_summary
