-- view: g_pid
SELECT p_partkey AS k, 'dp-' || CAST(p_partkey AS STRING) AS norm,
       CASE WHEN p_partkey % 4 = 0 THEN ' DP-' || CAST(p_partkey AS STRING) || ' '
            WHEN p_partkey % 4 = 1 THEN 'Dp-' || CAST(p_partkey AS STRING)
            ELSE 'dp-' || CAST(p_partkey AS STRING) END AS raw
FROM part

-- view: g_product
SELECT g.raw AS DataProductID, p.p_name || ' ' || p.p_brand AS DataProductDisplayName,
       CASE p.p_partkey % 9 WHEN 0 THEN 'Amazon S3 bucket' WHEN 1 THEN 'Fabric lakehouse'
            WHEN 2 THEN 'Azure SQL Database' WHEN 3 THEN 'Azure SQL Database on IaaS'
            WHEN 4 THEN 'ADLS data lake' WHEN 5 THEN 'Virtual machine host'
            WHEN 6 THEN 'Azure Arc machine' WHEN 7 THEN 'Report only' ELSE NULL END AS DataProductDescription
FROM part p JOIN g_pid g ON g.k = p.p_partkey

-- view: g_term
SELECT 'T' || CAST(n_nationkey AS STRING) AS GlossaryTermId,
       CASE WHEN n_nationkey % 2 = 0 THEN lower(n_name)
            ELSE 'Nation ' || CAST(n_nationkey AS STRING) END AS GlossaryTermDisplayName,
       'P-REGION' AS ParentGlossaryTermId FROM nation
UNION ALL
SELECT 'U' || CAST(r_regionkey AS STRING), r_name, 'P-OTHER' FROM region

-- view: g_term_assignment
SELECT raw AS DataProductId, 'T' || CAST(k % 29 AS STRING) AS GlossaryTermId,
       CASE WHEN k % 11 = 0 THEN 0 ELSE 1 END AS ActiveFlag FROM g_pid
UNION ALL
SELECT raw, 'T' || CAST((k + 1) % 25 AS STRING), 1 FROM g_pid WHERE k % 13 = 0
UNION ALL
SELECT raw, 'U' || CAST(k % 5 AS STRING), 1 FROM g_pid WHERE k % 17 = 0

-- view: g_approved_region
SELECT 'Nation ' || CAST(n_nationkey AS STRING) AS region_name, upper(n_name) AS region_code,
       CASE n_nationkey % 5 WHEN 0 THEN 'Yes' WHEN 1 THEN 'true' WHEN 2 THEN '1'
            WHEN 3 THEN 'no' ELSE 'n/a' END AS approved,
       CAST(n_regionkey AS STRING) AS notes
FROM nation

-- view: g_asset
SELECT 'A' || CAST(o_orderkey AS STRING) AS DataAssetId FROM orders

-- view: g_product_asset
SELECT g.raw AS DataProductId, 'A' || CAST(l.l_orderkey AS STRING) AS DataAssetId
FROM lineitem l JOIN g_pid g ON g.k = l.l_partkey

-- view: g_asset_column
SELECT 'A' || CAST(l_orderkey AS STRING) AS DataAssetId,
       'C' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS ColumnId
FROM lineitem

-- view: g_column_class
SELECT 'A' || CAST(l_orderkey AS STRING) AS DataAssetId,
       'C' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS ColumnId,
       CASE WHEN l_orderkey % 3 = 0 THEN 'K' ELSE 'Unlisted' END || CAST(l_suppkey % 40 AS STRING) AS ClassificationId
FROM lineitem

-- view: g_class
SELECT 'K' || CAST(n_nationkey AS STRING) AS ClassificationId,
       CASE WHEN n_nationkey = 0 THEN 'PERSONAL.NAME'
            ELSE 'CLASS.' || CAST(n_nationkey AS STRING) END AS ClassificationDisplayName
FROM nation

-- view: g_resource_key
SELECT c_custkey AS rk, c_custkey AS k, CAST(c_custkey % 8 AS INT) AS kind, c_custkey % 5 AS sub,
       CASE WHEN c_custkey % 3 = 2 OR c_custkey % 29 > 24 THEN (c_custkey + 1) % 25 ELSE c_custkey % 29 END AS loc
FROM customer
UNION ALL
SELECT -1 - s_suppkey, s_suppkey * 2, 0, s_suppkey % 5, s_suppkey % 25 FROM supplier

-- view: g_resource
SELECT rk, '/subscriptions/S' || CAST(sub AS STRING) || '/resourceGroups/rg' || CAST(k % 7 AS STRING) || '/providers/' ||
       CASE kind WHEN 2 THEN 'Microsoft.HybridCompute/machines'
                 WHEN 3 THEN 'Microsoft.SqlVirtualMachine/sqlVirtualMachines'
                 WHEN 4 THEN 'Microsoft.Storage/storageAccounts' WHEN 5 THEN 'Microsoft.Sql/servers'
                 WHEN 6 THEN 'Microsoft.Fabric/capacities' WHEN 7 THEN 'Microsoft.KeyVault/vaults'
                 ELSE 'Microsoft.Compute/virtualMachines' END || '/r' || CAST(rk AS STRING) AS ResourceId,
       CASE kind WHEN 2 THEN 'Microsoft.HybridCompute/machines'
                 WHEN 3 THEN 'Microsoft.SqlVirtualMachine/sqlVirtualMachines'
                 WHEN 4 THEN 'Microsoft.Storage/storageAccounts' WHEN 5 THEN 'Microsoft.Sql/servers'
                 WHEN 6 THEN 'Microsoft.Fabric/capacities' WHEN 7 THEN 'Microsoft.KeyVault/vaults'
                 ELSE 'Microsoft.Compute/virtualMachines' END AS ResourceType,
       'S' || CAST(sub AS STRING) AS SubscriptionId, 'rg' || CAST(k % 7 AS STRING) AS ResourceGroup,
       'NATION_' || CAST(loc AS STRING) AS Location,
       CASE WHEN rk % 3 = 0 THEN 'DP-' || CAST(k AS STRING) END AS tag_pid_a,
       CASE WHEN rk % 3 <> 0 AND rk % 2 = 0 THEN 'dp-' || CAST(k AS STRING) END AS tag_pid_b,
       CASE WHEN rk % 3 <> 0 AND rk % 2 <> 0 THEN 'dp-' || CAST(k AS STRING) END AS tag_pid_c,
       CASE rk % 6 WHEN 0 THEN NULL WHEN 1 THEN 'other' WHEN 2 THEN ' ARC' ELSE 'azure' END AS tag_origin,
       CASE rk % 7 WHEN 0 THEN '' WHEN 1 THEN 'basic' WHEN 2 THEN 'Comprehensive' ELSE 'standard' END AS tag_zone,
       CASE WHEN kind < 2 AND rk % 16 <> 1 THEN 'Standard_DC' || CAST(k % 60 AS STRING) END AS vm_size,
       CASE WHEN kind < 2 AND rk % 5 = 0 THEN 'ConfidentialVM' WHEN kind < 2 THEN 'TrustedLaunch' END AS security_type,
       CASE WHEN kind = 2 AND rk % 40 <> 2 THEN 'standard_dc' || CAST(k % 60 AS STRING) END AS arc_model,
       CASE WHEN kind = 3 AND rk % 5 <> 0 THEN '/subscriptions/S' || CAST((rk - 3) % 5 AS STRING) || '/resourceGroups/rg' ||
            CAST((rk - 3) % 7 AS STRING) || '/providers/Microsoft.Compute/virtualMachines/r' || CAST(rk - 3 AS STRING)
       END AS linked_vm_id,
       CASE WHEN kind = 2 AND rk % 3 = 0 THEN NULL WHEN kind = 2 AND rk % 3 = 1 THEN 'UserAssigned'
            ELSE 'SystemAssigned' END AS identity_type
FROM g_resource_key

-- view: g_sku
SELECT DISTINCT ' Standard_dc' || CAST(p_size AS STRING) AS sku, p_size % 2 = 0 AS is_approved FROM part

-- view: g_pricing
SELECT 'S' || CAST(r_regionkey AS STRING) AS SubscriptionId, 'VirtualMachines' AS plan_name,
       CASE WHEN r_regionkey % 3 = 0 THEN 'Free' ELSE 'Standard' END AS pricingTier FROM region
UNION ALL
SELECT 'S' || CAST(r_regionkey AS STRING), 'SqlServers',
       CASE WHEN r_regionkey % 3 = 0 THEN 'Free' ELSE 'Standard' END FROM region
UNION ALL
SELECT 'S' || CAST(r_regionkey AS STRING), 'SqlServerVirtualMachines',
       CASE WHEN (r_regionkey + 3) % 3 = 0 THEN 'Free' ELSE 'Standard' END FROM region
UNION ALL
SELECT 'S' || CAST(r_regionkey AS STRING), 'StorageAccounts',
       CASE WHEN (r_regionkey + 2) % 3 = 0 THEN 'Free' ELSE 'Standard' END FROM region

-- view: g_assessment
SELECT lower(r.ResourceId) || CASE WHEN o.o_custkey % 11 = 0 THEN '/parts/1' ELSE '' END AS resource_id, 'check ' || CAST(o.o_orderkey % 9 AS STRING) AS displayName,
       CASE WHEN o.o_orderkey % 60 = 0 THEN 'Unhealthy' WHEN o.o_orderkey % 7 = 0 THEN 'NotApplicable'
            WHEN o.o_orderkey % 11 = 0 THEN '' ELSE 'Healthy' END AS statusCode, o.o_orderdate AS statusChangeDate
FROM orders o JOIN g_resource r ON r.rk = o.o_custkey

-- view: g_alert
SELECT lower(r.ResourceId) AS resource_id, e.event_id AS systemAlertId,
       CASE WHEN e.event_type = 'error' THEN 'High' ELSE 'Low' END AS severity,
       CASE WHEN e.event_id % 7 = 0 THEN 'Active' ELSE 'Resolved' END AS status, e.ts AS startTimeUtc
FROM events e JOIN g_resource r ON r.rk = e.user_id

-- view: g_patch
SELECT lower(r.ResourceId) || CASE WHEN r.rk % 6 = 0 THEN '/patchassessmentresults/older' ELSE '/patchassessmentresults/latest' END AS assessment_id,
       CASE WHEN r.rk % 9 <> 0 THEN x.d0 END AS startDateTime, x.d1 AS lastModifiedDateTime,
       '{"critical":' || CAST(x.n % 2 AS STRING) || ',"security":' || CAST(r.rk % 2 AS STRING) || '}' AS counts_json
FROM (SELECT o_custkey, MIN(o_orderdate) AS d0, MAX(o_orderdate) AS d1, COUNT(*) AS n FROM orders GROUP BY o_custkey) x
JOIN g_resource r ON r.rk = x.o_custkey

-- view: g_bucket
SELECT CASE WHEN p_partkey % 9 = 0 AND p_partkey % 5 <> 0 THEN '' ELSE 'spare ' END || p_name || ' ' || p_brand AS bucketName,
       MIN(CASE p_partkey % 4 WHEN 0 THEN 'US' WHEN 1 THEN '' WHEN 2 THEN lower('NATION_') || CAST(p_partkey % 29 AS STRING)
           ELSE NULL END) AS bucketLocation
FROM part GROUP BY CASE WHEN p_partkey % 9 = 0 AND p_partkey % 5 <> 0 THEN '' ELSE 'spare ' END || p_name || ' ' || p_brand

-- view: g_owner
SELECT raw AS DataProductId, CASE WHEN k % 19 = 0 THEN ' ' WHEN k % 2 = 0 THEN 'O' || CAST(k AS STRING) ELSE 'O' || CAST(k % 97 AS STRING) END AS DataProductOwnerId
FROM g_pid

-- view: g_owner_contact
SELECT CASE WHEN c_custkey % 3 = 0 THEN 'Left' ELSE 'O' END || CAST(c_custkey AS STRING) AS OwnerObjectId, c_name AS OwnerName,
       'owner' || CAST(c_custkey AS STRING) || '@example.com' AS OwnerEmail
FROM customer

-- view: g_catalog_history
SELECT ts AS SnapshotUtc, CASE WHEN event_id % 97 = 0 THEN 0 WHEN event_id % 50 = 0 THEN 5000 + event_id
       ELSE 1000 + event_id END AS TotalAssets, event_id % 2 = 0 AS IsApproximate
FROM events

-- view: g_asset_history
SELECT SnapshotTS, DataProductName, CAST(SUM(n) AS BIGINT) AS TotalAssets
FROM (SELECT date_trunc('hour', ts) AS SnapshotTS, event_id % 50 AS n,
             CASE WHEN event_type NOT IN ('view', 'click') THEN event_type || ' ' WHEN EXTRACT(DAY FROM ts) % 9 = 0 THEN 'night ' ELSE 'user ' END ||
             CAST(user_id AS STRING) AS DataProductName FROM events) x
GROUP BY SnapshotTS, DataProductName

-- view: g_residency_history
SELECT date_trunc('day', ts) AS Snapshots, 'u-' || CAST(user_id AS STRING) AS DataProductID,
       CASE WHEN MAX(event_id) % 6 = 0 THEN NULL WHEN MAX(event_id) % 6 = 1 THEN ''
            ELSE 'nation_' || CAST(MAX(event_id) % 4 AS STRING) END AS ResidencyRegion
FROM events GROUP BY date_trunc('day', ts), user_id

-- view: g_residency_request
SELECT 'req-' || CAST(k AS STRING) AS requestId, CASE WHEN k % 41 = 0 THEN '' ELSE norm END AS dataProductId,
       CASE WHEN k % 37 = 0 THEN NULL WHEN k % 31 = 0 THEN 'nation_1,nation_2' WHEN k % 23 = 0 THEN 'nowhere'
            WHEN k % 2 = 0 AND k % 29 < 25 THEN CASE WHEN (k % 29) % 2 = 0 THEN 'nation_' || CAST(k % 29 AS STRING)
                 ELSE 'nation ' || CAST(k % 29 AS STRING) END
            ELSE 'nation_4' END AS targetResidencyCode,
       k % 5 = 0 AS expectedProvided, CASE WHEN k % 10 = 0 THEN 'nation_2' END AS expectedCurrentResidencyCode,
       k % 3 = 0 AS dryRun, k % 4 <> 0 AS confirm
FROM g_pid

-- view: g_policy_state
SELECT r.ResourceId AS resourceId, o.o_orderkey % 4 <> 0 AS isCompliant,
       CASE WHEN o.o_orderkey % 3 = 0 THEN 'lt-1,lt-2,es-2' ELSE 'dp-3' END AS groupNames, o.o_orderdate AS stateTime
FROM orders o JOIN g_resource r ON r.rk = o.o_custkey

-- view: g_visual
SELECT 'v' || CAST(p_partkey AS STRING) AS visual_id, 'page' || CAST(p_partkey % 6 AS STRING) AS page_id,
       'repo/' || CASE WHEN p_partkey % 8 = 0 THEN 'loose' ELSE 'Board ' || CAST(p_partkey % 4 AS STRING) || '__Report' END ||
       CASE WHEN p_partkey % 7 = 0 THEN '' ELSE '/definition/pages/page' || CAST(p_partkey % 6 AS STRING) END ||
       '/visuals/v' || CAST(p_partkey AS STRING) || '/visual.json' AS path,
       '{"name":"v' || CAST(p_partkey AS STRING) || '","visual":{' ||
       CASE WHEN p_partkey % 5 = 0 THEN '' ELSE '"visualType":"' || CASE p_partkey % 3 WHEN 0 THEN 'card' WHEN 1 THEN 'tableEx' ELSE 'lineChart' END || '",' END ||
       CASE WHEN p_partkey % 4 = 0 THEN '' ELSE '"visualContainerObjects":{"title":[{"properties":{"text":{"expr":{"Literal":{"Value":"''' || p_name || '''"}}}}}]},' END ||
       '"query":{"field":{"Column":{"Expression":{"SourceRef":{"Entity":"' || p_brand ||
       '"}},"Property":"' || p_type || '"}}},"filter":{"Measure":{"Expression":{"SourceRef":{"Entity":"' ||
       p_name || '"}},"Property":"size"}}}}' AS definition
FROM part

-- view: h_asset
SELECT CAST(SnapshotTS AS DATE) AS SnapshotDate, SnapshotTS, DataProductName, TotalAssets FROM g_asset_history

-- view: h_residency
SELECT CAST(Snapshots AS DATE) AS SnapshotDate, Snapshots, DataProductID,
       'Product ' || DataProductID AS DataProductDisplayName, ResidencyRegion
FROM g_residency_history

-- view: h_catalog
SELECT CAST(SnapshotUtc AS DATE) AS SnapshotDate, SnapshotUtc, TotalAssets, IsApproximate FROM g_catalog_history

-- view: g_guid
SELECT k, CASE WHEN k % 7 = 0 THEN substr(h, 1, 8) || '-' || substr(h, 9, 4)
               WHEN k % 7 = 1 THEN 'x' || substr(h, 2, 7) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-'
                    || substr(h, 17, 4) || '-' || substr(h, 21, 12)
               WHEN k % 7 = 2 THEN upper(substr(h, 1, 8)) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-'
                    || substr(h, 17, 4) || '-' || substr(h, 21, 12)
               ELSE substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-'
                    || substr(h, 17, 4) || '-' || substr(h, 21, 12) END AS id
FROM (SELECT k, md5(norm) AS h FROM g_pid) x

-- view: g_spelling
SELECT p_partkey AS k, CASE p_partkey % 13 WHEN 0 THEN 'Yes' WHEN 1 THEN ' TRUE ' WHEN 2 THEN '1' WHEN 3 THEN 'y'
       WHEN 4 THEN 'No' WHEN 5 THEN 'false' WHEN 6 THEN '0' WHEN 7 THEN 'N ' WHEN 8 THEN 't' WHEN 9 THEN 'F'
       WHEN 10 THEN '' WHEN 11 THEN p_brand ELSE NULL END AS flag_text
FROM part

-- view: g_arn
SELECT p_partkey AS k, CASE p_partkey % 6 WHEN 0 THEN 'arn:aws:s3:::' || replace(p_name, ' ', '-') || '.' || CAST(p_partkey AS STRING)
       WHEN 1 THEN 'arn:aws:s3:::b' || CAST(p_partkey % 10 AS STRING) WHEN 2 THEN 'arn:aws:s3:::' || p_name
       WHEN 3 THEN ' arn:aws:s3:::' || lower(replace(p_brand, '#', '_')) || ' ' WHEN 4 THEN '' ELSE NULL END AS arn,
       CASE p_partkey % 5 WHEN 0 THEN 'us' WHEN 1 THEN ' ' WHEN 2 THEN 'eu-west-' || CAST(p_partkey % 3 AS STRING)
       WHEN 3 THEN ' ap-south-1 ' ELSE NULL END AS location
FROM part

-- view: g_counts
SELECT o_orderkey AS k, CASE o_orderkey % 8 WHEN 0 THEN '{"critical":' || CAST(o_orderkey % 5 AS STRING) || ',"other":{"a":1,"b":[2,' || CAST(o_orderkey % 3 AS STRING) || ']}}'
       WHEN 1 THEN '{}' WHEN 2 THEN CAST(o_orderkey % 50 AS STRING) WHEN 3 THEN 'n/a' WHEN 4 THEN '[1,"3","x",true]'
       WHEN 5 THEN ' ' WHEN 6 THEN '{"security":"' || CAST(o_orderkey % 9 AS STRING) || '","updates":null,"rate":2.9}' ELSE NULL END AS counts_json,
       CASE o_orderkey % 8 WHEN 0 THEN o_orderkey % 5 + 3 + o_orderkey % 3 WHEN 1 THEN 0 WHEN 2 THEN o_orderkey % 50 WHEN 4 THEN 5
       WHEN 6 THEN o_orderkey % 9 + 2 ELSE NULL END AS expected
FROM orders

-- view: g_tag_item
SELECT rk, CASE WHEN rk % 17 = 0 THEN ' ' WHEN rk % 19 = 0 THEN '/subscriptions/gone/r' || CAST(rk AS STRING) ELSE ResourceId END AS resourceId,
       coalesce(tag_pid_a, tag_pid_b, tag_pid_c) AS dataProductId, 'Product ' || CAST(rk AS STRING) AS dataProductDisplayName,
       CASE WHEN rk % 3 = 0 THEN 'owner' || CAST(rk AS STRING) || '@example.com' END AS ownerEmail,
       CASE WHEN rk % 2 = 0 THEN 50 ELSE 75 END AS ccScorePct,
       CASE WHEN rk % 5 = 0 THEN 'sovereignty-zone' END AS tagKey, CASE WHEN rk % 5 = 0 THEN 'comprehensive' END AS tagValue
FROM g_resource
