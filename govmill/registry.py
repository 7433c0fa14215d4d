"""Every registered query by key. A query takes the inputs of one data folder and gives a frame."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from govmill.functions import columns as C
from govmill.functions import fixed_values as V
from govmill.functions.schemas import assert_exact_columns, conform_to_schema, schema_diff_counts, typed_rows
from govmill.inputs import ACTOR, PARENT_TERM, RUN_TS, SOURCE, TAG_REQUEST, Inputs
from govmill.operators import checks, drift, evidence, gold, keyed, measures, owners, policy, reports, scores, star, text_jobs, timeseries, upkeep
from govmill.plans import eligibility, residency_change, tag_change
from govmill.session import shared_folder
from govmill.sources import tables
from govmill.streaming import snapshots

Query = Callable[[Inputs], DataFrame]
QUERIES: dict[str, Query] = {}

TEXT_RULES = (
    text_jobs.Rule("Exact:mail host", "mail5.example.com", "<MAIL_HOST>", pattern=False),
    *text_jobs.REDACTION_PATTERNS,
)
SCAN_RULES = (
    text_jobs.Rule("mail2.example.com", "mail2.example.com", pattern=False),
    text_jobs.Rule("MailAddress", text_jobs.REDACTION_PATTERNS[0].find, needs="@"),
    *text_jobs.FORBIDDEN_PATTERNS,
)


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def plain(df: DataFrame) -> DataFrame:
    """Times without zone (UTC), so that rows compare the same everywhere."""
    return df.select(*(F.col(f"`{f.name}`").cast("timestamp_ntz").alias(f.name)
                       if isinstance(f.dataType, T.TimestampType) else F.col(f"`{f.name}`") for f in df.schema.fields))


def tags_text(column: str):
    """A tag map as sorted ``key=value`` text."""
    return F.array_join(F.array_sort(F.transform(F.map_entries(column), lambda e: F.concat_ws("=", e["key"], e["value"]))), ";")


# Loads and table maintenance ------------------------------------------------------------------

@query
def ingest_parquet(d: Inputs) -> DataFrame:
    db = d.database()
    names = ("part", "nation", "orders", "lineitem")
    out = tables.ingest(d.spark, d.sf_dir, {f"{n}.parquet": f"{db}.raw_{n}" for n in names})
    return out.select(F.regexp_extract("table", r"raw_(\w+)$", 1).alias("table_name"), "rows_loaded")


@query
def ingest_delta_folder(d: Inputs) -> DataFrame:
    """Folder load of column classification; parquet here, as Delta is not installed."""
    folder, db = shared_folder(d.spark), d.database()
    d.column_class.write.parquet(f"{folder}/ColumnClass")
    tables.ingest(d.spark, folder, {"ColumnClass": f"{db}.column_class"}, tables.TABLE_FORMAT)
    return d.spark.table(f"{db}.column_class").groupBy("ClassificationId").agg(F.count("*").alias("n"))


@query
def write_current(d: Inputs) -> DataFrame:
    table = f"{d.database()}.gold"
    tables.write_current(d.product, table)
    tables.write_current(d.gold, table)
    return d.spark.table(table)


@query
def create_then_overwrite(d: Inputs) -> DataFrame:
    table = f"{d.database()}.gold"
    for _ in range(2):
        tables.create_then_overwrite(d.gold, table, d.gold.schema)
    return d.spark.table(table)


@query
def ctas_replace(d: Inputs) -> DataFrame:
    table = f"{d.database()}.asset_counts"
    tables.ctas_replace(d.product, table)
    tables.ctas_replace(d.asset_counts, table)
    return d.spark.table(table)


@query
def append_snapshot(d: Inputs) -> DataFrame:
    table = f"{d.database()}.history"
    for day in ("2024-03-01 00:00:00", "2024-03-02 00:00:00"):
        tables.append_snapshot(d.gold, table, day, "Snapshots")
    return d.spark.table(table)


@query
def merge_insert_only(d: Inputs) -> DataFrame:
    """Half the snapshots, then all of them twice: every snapshot is there once."""
    table = f"{d.database()}.catalog_history"
    for rows in (d.h_catalog.filter("IsApproximate"), d.h_catalog, d.h_catalog):
        tables.merge_insert_only(rows, table, ["SnapshotUtc"])
    return d.spark.table(table)


@query
def conform_schema(d: Inputs) -> DataFrame:
    target = T.StructType.fromDDL("NOTE string, dataproductname string, totalassets int, snapshotts timestamp")
    return conform_to_schema(d.h_asset, target)


@query
def exact_columns(d: Inputs) -> DataFrame:
    return assert_exact_columns(d.gold, ["DataProductID", "DataProductDisplayName", "DataProductDescription", "ResidencyRegion"])


@query
def write_current_and_history(d: Inputs) -> DataFrame:
    """Three runs; the last finds a history of an older layout in its second table."""
    db = d.database()
    card = d.residency.drop("SnapshotTimeUtc")
    tables.write_current(card.drop("AzureLocations"), f"{db}.old_history")
    for _ in range(2):
        tables.write_current_and_history(card, f"{db}.current", f"{db}.history")
    tables.write_current_and_history(card, f"{db}.current", f"{db}.old_history", replace_if_lacking="AzureLocations")
    parts = [d.spark.table(f"{db}.{t}").select(F.lit(t).alias("table_name"), "ResidencyScorePct") for t in ("current", "history", "old_history")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("table_name", "ResidencyScorePct").agg(F.count("*").alias("n"))


@query
def typed_evidence(d: Inputs) -> DataFrame:
    """Evidence rows under an explicit schema, stacked on an empty record list of the same schema."""
    schema = T.StructType.fromDDL("resource_id string, displayName string, statusCode string, statusChangeDate timestamp, firstEvaluationDate string")
    return typed_rows(d.spark, [], schema).unionByName(conform_to_schema(d.assessment, schema))


@query
def union_tenants(d: Inputs) -> DataFrame:
    vms = evidence.virtual_machines(d.resource, RUN_TS)
    return evidence.union_tenants([("tenant-a", vms.filter("SubscriptionId < 'S3'")),
                                   ("tenant-b", vms.filter("SubscriptionId >= 'S3'").drop("ResourceGroup"))])


@query
def optional_table(d: Inputs) -> DataFrame:
    """With the table absent every product has flag zero; with it, its flags."""
    table = f"{d.database()}.classification"
    schema = T.StructType.fromDDL("DataProductId string, HasFullNameClassification int, FullNameColumnCount bigint")
    absent = gold.base_with_pii(d.dimension, tables.optional_table(d.spark, table, schema))
    tables.write_current(d.classification, table)
    present = gold.base_with_pii(d.dimension, tables.optional_table(d.spark, table, schema))
    flags = [df.groupBy("HasFullNameClassification").agg(F.count("*").alias("n")).withColumn("source", F.lit(s))
             for s, df in (("absent", absent), ("present", present))]
    return flags[0].unionByName(flags[1])


@query
def resolve_columns(d: Inputs) -> DataFrame:
    spelled = d.approved_region.toDF("Region Name", "regionCode", "IsApproved", "notes")
    return evidence.approved_regions(spelled).unionByName(evidence.approved_regions(d.approved_region))


@query
def snapshot_single_row(d: Inputs) -> DataFrame:
    return d.catalog_snapshot


# Scalar work ----------------------------------------------------------------------------------

@query
def normalise_ids(d: Inputs) -> DataFrame:
    return d.owner.select(C.normalise_code(F.col("DataProductId")).alias("DataProductId"),
                          C.normalise_code(F.col("DataProductOwnerId")).alias("OwnerId")).dropna()


@query
def validate_guid(d: Inputs) -> DataFrame:
    good, bad = residency_change.validate_guid(d.guid, "id")
    return good.withColumn("is_valid", F.lit(True)).unionByName(bad.withColumn("is_valid", F.lit(False)))


@query
def dedupe_first(d: Inputs) -> DataFrame:
    return d.dimension


@query
def categorise_products(d: Inputs) -> DataFrame:
    return gold.categorise_products(d.dimension).select("DataProductId", *V.CATEGORY_WORDS)


@query
def applicability(d: Inputs) -> DataFrame:
    return d.base.select("DataProductId", "TagApplicable", "ResidencyApplicable", "CCApplicable", "DefenderApplicable")


@query
def parse_bool(d: Inputs) -> DataFrame:
    t = F.col("flag_text")
    return d.spelling.select("k", C.parse_bool(t).alias("three_way"), C.parse_bool_strict(t).alias("strict"),
                             C.parse_bool_request(t, True).alias("request"))


@query
def normalise_code(d: Inputs) -> DataFrame:
    return d.spelling.select("k", C.normalise_code(F.col("flag_text")).alias("code"), C.display_region(F.col("flag_text")).alias("display"))


@query
def parse_resource_id(d: Inputs) -> DataFrame:
    return evidence.parse_resource_id(d.resource)


@query
def parse_s3_bucket(d: Inputs) -> DataFrame:
    return d.arn.select("k", C.bucket_of_arn(F.col("arn")).alias("bucketName"), C.bucket_region(F.col("location")).alias("bucketLocation"))


@query
def tag_key_variants(d: Inputs) -> DataFrame:
    return evidence.tagged(d.resource).select("ResourceId", "DataProductId")


@query
def extract_properties(d: Inputs) -> DataFrame:
    return evidence.extract_properties(d.resource).select("ResourceId", "VmSize", "SecurityType", "ArcModel", "LinkedVmId")


@query
def sum_nested_counts(d: Inputs) -> DataFrame:
    return d.counts.select("k", C.sum_nested_counts(F.col("counts_json")).alias("total"))


@query
def derive_assessment_id(d: Inputs) -> DataFrame:
    return d.resource.select("ResourceId", C.assessment_id(F.concat("ResourceId", F.when(F.col("rk") % 2 == 0, "/").otherwise(""))).alias("assessment_id"))


@query
def json_defaults(d: Inputs) -> DataFrame:
    none = {c: F.lit(None).cast("string") for c in ("resourcesJson", "evaluatedResourcesJson", "detailsJson")}
    return scores.json_defaults(d.base.select("DataProductId", "DefenderApplicable").withColumns(none))


@query
def single_value_gate(d: Inputs) -> DataFrame:
    return evidence.resource_rollup(d.resource).select("DataProductId", C.single_value(C.normalise_code(F.col("AzureLocations"))).alias("single"))


@query
def distinct_sorted_join(d: Inputs) -> DataFrame:
    return evidence.resource_rollup(d.resource).select("DataProductId", "AzureLocations", "AzureResourceIds")


@query
def relative_time_filter(d: Inputs) -> DataFrame:
    return reports.relative_time_filter(d.h_asset, "SnapshotTS", d.newest_asset_time)


@query
def category_filters(d: Inputs) -> DataFrame:
    """How many rows each saved report filter keeps."""
    def kept(name: str, df: DataFrame, condition) -> DataFrame:
        return df.agg(F.count_if(condition).alias("n")).select(F.lit(name).alias("filter"), "n")

    cc = d.stored("cc")
    parts = [
        kept("not changed", d.residency_deltas, ~F.col("HasChanged")), kept("not confidential", d.inventory, F.col("IsConfidential") == 0),
        kept("no region", d.dimension, F.col("ResidencyRegion").isNull()), kept("score not 100", cc, F.col("CCForPIIScore") != 100),
        kept("no patch data", cc, F.col("PatchAssessmentStatus") == V.PATCH_NO_DATA),
        kept("moved", d.asset_deltas.groupBy("DataProductName").agg(F.sum("DeltaAssets").alias("s")), F.col("s") != 0),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query
def saved_filter_rows(d: Inputs) -> DataFrame:
    """The rows that each saved report filter keeps."""
    def kept(name: str, df: DataFrame, condition, item) -> DataFrame:
        return df.filter(condition).select(F.lit(name).alias("filter"), item.alias("item"))

    # Both read again by the last filter.
    for name in ("classification", "gold"):
        d.stored(name)
    cc = d.stored("cc")
    at = F.concat_ws(" @ ", "DataProductID", F.date_format("SnapshotUtc", "yyyy-MM-dd HH:mm:ss"))
    both = reports.sensitive_and_confidential(d.gold, d.classification, d.inventory)
    return reduce(DataFrame.unionByName, [
        kept("not changed", d.residency_deltas, ~F.col("HasChanged"), at),
        kept("not confidential", d.inventory, F.col("IsConfidential") == 0, F.col("ComputeResourceId")),
        kept("no region", d.dimension, F.col("ResidencyRegion").isNull(), F.col("DataProductId")),
        kept("score not 100", cc, F.col("CCForPIIScore") != 100, F.col("DataProductId")),
        kept("no patch data", cc, F.col("PatchAssessmentStatus") == V.PATCH_NO_DATA, F.col("DataProductId")),
        kept("moved", d.asset_deltas.groupBy("DataProductName").agg(F.sum("DeltaAssets").alias("s")), F.col("s") != 0, F.col("DataProductName")),
        kept("sensitive and confidential", both, F.lit(True), F.col("DataProductDisplayName")),
    ])


@query
def schema_diff(d: Inputs) -> DataFrame:
    """Products against an older table layout, with the number of filled values that each difference concerns."""
    older = T.StructType([T.StructField("dataproductid", T.StringType()), T.StructField("DataProductDisplayName", T.StringType()),
                          T.StructField("DataProductDescription", T.IntegerType()), T.StructField("Retired", T.BooleanType())])
    return schema_diff_counts(d.dimension, older)


@query
def resource_kind(d: Inputs) -> DataFrame:
    return d.resource.select("ResourceId", C.resource_kind(F.col("ResourceType")).alias("kind"), C.is_compute(F.col("ResourceType")).alias("applicable"))


@query
def defender_candidate_plans(d: Inputs) -> DataFrame:
    return d.resource.select("ResourceId", F.array_join(C.defender_candidate_plans(F.col("ResourceType")), ",").alias("plans"))


# Joins ----------------------------------------------------------------------------------------

@query
def gold_residency(d: Inputs) -> DataFrame:
    return d.gold


@query
def gold_asset_counts(d: Inputs) -> DataFrame:
    return d.asset_counts


@query
def fullname_classification(d: Inputs) -> DataFrame:
    return d.classification


@query
def base_with_pii(d: Inputs) -> DataFrame:
    return gold.base_with_pii(d.dimension, d.classification).select("DataProductId", "HasFullNameClassification", "FullNameColumnCount")


@query
def base_products(d: Inputs) -> DataFrame:
    return d.base


@query
def approved_region_lookup(d: Inputs) -> DataFrame:
    return evidence.approved_region_lookup(d.dimension.select("DataProductId", "ResidencyRegion"), "ResidencyRegion", d.approved_region).select(
        "DataProductId", F.col("ResidencyRegion").alias("input"), "RegionCode", "RegionName", "IsApproved")


@query
def override_join(d: Inputs) -> DataFrame:
    """Region per product from the rollup, with the bucket's place in front where there is one."""
    primary = d.dimension.select("DataProductId").join(evidence.resource_rollup(d.resource).select("DataProductId", "AzureLocations"), "DataProductId", "left")
    places = evidence.bucket_places(d.bucket).join(d.dimension, F.col("bucketName") == F.col("DataProductDisplayName")).select(
        "DataProductId", F.col("bucketPlace").alias("AzureLocations"))
    return evidence.override_join(primary, places, "DataProductId")


@query
def gap_not_confidential(d: Inputs) -> DataFrame:
    return d.gap_not_confidential


@query
def gap_no_compute(d: Inputs) -> DataFrame:
    return d.gap_no_compute


@query
def semi_join_ids(d: Inputs) -> DataFrame:
    asked = d.residency_request.select(F.col("dataProductId").alias("DataProductId"))
    return keyed.semi_join_ids(evidence.tagged(d.resource), asked, "DataProductId").select("ResourceId", "DataProductId")


@query
def prefer_applicable_resource(d: Inputs) -> DataFrame:
    return evidence.prefer_applicable_resource(d.resource, V.PRODUCT_TAGS).select("DataProductId", "ResourceId", "vmApplicable")


@query
def linked_vm_lookup(d: Inputs) -> DataFrame:
    return evidence.linked_vm_lookup(evidence.extract_properties(d.resource), d.resource)


@query
def patch_lookup(d: Inputs) -> DataFrame:
    chosen = evidence.extract_properties(evidence.prefer_applicable_resource(d.resource, V.PRODUCT_TAGS))
    return evidence.patch_lookup(chosen, d.patch)


@query
def sku_lookup(d: Inputs) -> DataFrame:
    sized = evidence.extract_properties(d.resource).select("ResourceId", F.coalesce("VmSize", "ArcModel").alias("sku_text"))
    return evidence.sku_lookup(sized, "sku_text", d.sku)


@query
def asof_bounded(d: Inputs) -> DataFrame:
    return timeseries.asof_bounded(d.h_catalog.select("SnapshotUtc", "TotalAssets"), drift.asset_totals_by_snapshot(d.h_asset),
                                   "SnapshotUtc", "SnapUtc", ["TotalProductAssets"], V.ASOF_SECONDS)


@query
def latest_snapshot_join(d: Inputs) -> DataFrame:
    return keyed.latest_snapshot_rows(d.h_residency, "Snapshots")


@query
def owner_contact(d: Inputs) -> DataFrame:
    return d.owners


@query
def investigate_join(d: Inputs) -> DataFrame:
    return owners.investigate_join(d.cc, d.owners, d.gold).select(
        "DataProductId", "DataProductDisplayName", "DataProductDescription", "CCForPIIScore", "OwnerObjectId", "OwnerEmail", "OwnerSource", "OwnerResolveStatus")


@query
def star_join(d: Inputs) -> DataFrame:
    """Asset counts joined to products through the saved relationship (name to description), counted."""
    through_name = reports.star_join(d.asset_counts, d.dimension, "DataProductName", "DataProductDisplayName")
    through_description = reports.star_join(d.asset_counts, d.dimension, "DataProductName", "DataProductDescription")
    parts = [df.agg(F.count("*").alias("rows"), F.count("ProductId").alias("matched")).withColumn("relationship", F.lit(n))
             for n, df in (("name", through_name), ("description", through_description))]
    return parts[0].unionByName(parts[1])


@query
def star_rows(d: Inputs) -> DataFrame:
    """Every row of every table of both saved models with its product, by the model's relationships."""
    # Read several times, so stored first: all scorecards take their evidence from one pass over the resources.
    for name in ("classification", "gold", "base", "all_found"):
        d.stored(name)
    facts = {
        "inventory": d.inventory, "gap_no_compute": d.gap_no_compute, "gap_not_confidential": d.gap_not_confidential,
        "classification": d.stored("classification"), "asset_counts": d.asset_counts, "eligibility": d.eligibility, "cc": d.stored("cc"),
        "queue": d.queue, "residency": d.stored("residency"), "defender": d.defender_points, "tag": d.tag, "summary": d.summary}
    return star.product_rows(facts, d.dimension)


@query
def measures_by_slicer(d: Inputs) -> DataFrame:
    return measures.measures_by_slicer(d.base)


@query
def case_variant_join(d: Inputs) -> DataFrame:
    b = d.dimension.select("DataProductId").alias("b")
    a = evidence.resource_rollup(d.resource).select(F.col("DataProductId").alias("dataProductId"), "AzureResourceCount").alias("a")
    return b.join(a, F.col("b.DataProductId") == F.col("a.dataProductId"), "left").select(
        F.col("b.DataProductId").alias("dataProductId"), F.coalesce("a.AzureResourceCount", F.lit(0)).alias("resources"))


@query
def eligible_region_join(d: Inputs) -> DataFrame:
    places = evidence.resource_rollup(d.resource).select("DataProductId", C.normalise_code(F.col("AzureLocations")).alias("code"))
    return eligibility.eligible_region_join(places, "code", d.approved_region)


# Aggregations ---------------------------------------------------------------------------------

@query
def asset_totals_by_snapshot(d: Inputs) -> DataFrame:
    return drift.asset_totals_by_snapshot(d.h_asset)


@query
def residency_totals_by_snapshot(d: Inputs) -> DataFrame:
    return drift.residency_totals_by_snapshot(d.h_residency)


@query
def vm_rollup(d: Inputs) -> DataFrame:
    return evidence.vm_rollup(d.inventory)


@query
def sku_rule_rollup(d: Inputs) -> DataFrame:
    return evidence.sku_rule_rollup(d.sku)


def _sample_text(fields: list[str]):
    return F.array_join(F.transform("sample", lambda s: F.concat_ws("|", *(s[f].cast("string") for f in fields))), ";")


@query
def assessment_rollup(d: Inputs) -> DataFrame:
    return evidence.assessment_rollup(d.assessment).withColumn("sample", _sample_text(["displayName", "statusCode"]))


@query
def alert_rollup(d: Inputs) -> DataFrame:
    return evidence.alert_rollup(d.alert).withColumn("sample", _sample_text(["systemAlertId", "severity", "status"]))


@query
def pricing_map(d: Inputs) -> DataFrame:
    return evidence.pricing_map(d.pricing)


@query
def defender_rollup(d: Inputs) -> DataFrame:
    return evidence.defender_rollup(d.resource, d.pricing, d.assessment, d.alert)


@query
def resource_rollup(d: Inputs) -> DataFrame:
    return evidence.resource_rollup(d.resource)


@query
def score_avg_by_product(d: Inputs) -> DataFrame:
    return scores.score_avg_by_product(d.residency, "DataProductID", "ResidencyScorePct", "ResidencyScorePct")


@query
def eligibility_counts(d: Inputs) -> DataFrame:
    return eligibility.eligibility_counts(d.eligibility)


@query
def breakdown_counts(d: Inputs) -> DataFrame:
    return checks.breakdown_counts(d.owners, "OwnerSource")


@query
def missing_counts(d: Inputs) -> DataFrame:
    return checks.missing_counts(owners.investigate_join(d.cc, d.owners, d.gold), "OwnerEmail", "OwnerEmailMissing")


@query
def coverage_check(d: Inputs) -> DataFrame:
    base = d.stored("base")
    return checks.coverage_check(base, {
        "tag": (d.tag, "dataProductId"), "residency": (d.residency_from(base), "DataProductID"), "cc": (d.cc, "DataProductId"),
        "defender": (d.defender_points, "dataProductId"), "queue": (d.queue, "DataProductId")})


@query
def distinct_products(d: Inputs) -> DataFrame:
    return checks.distinct_products(d.owners)


@query
def request_summary(d: Inputs) -> DataFrame:
    asked = d.residency_request.select(F.col("dataProductId").alias("DataProductId"))
    return residency_change.request_summary(asked, evidence.tagged(d.resource), "DataProductId")


@query
def missing_ids(d: Inputs) -> DataFrame:
    asked = d.residency_request.select(F.col("dataProductId").alias("DataProductId"))
    return residency_change.missing_ids(asked, evidence.tagged(d.resource), "DataProductId")


# History, windows, order ----------------------------------------------------------------------

@query
def catalog_deltas(d: Inputs) -> DataFrame:
    return d.catalog_deltas


@query
def asset_count_deltas(d: Inputs) -> DataFrame:
    return d.asset_deltas


@query
def residency_deltas(d: Inputs) -> DataFrame:
    return d.residency_deltas


@query
def asof_rank(d: Inputs) -> DataFrame:
    return timeseries.asof_rank(d.h_catalog.select("SnapshotUtc", "TotalAssets"), drift.asset_totals_by_snapshot(d.h_asset),
                                "SnapshotUtc", "SnapUtc", ["TotalProductAssets"], V.ASOF_SECONDS)


@query
def top_recent_catalog(d: Inputs) -> DataFrame:
    return drift.top_recent(d.catalog_deltas, [F.desc("SnapshotUtc")], 10)


@query
def top_recent_assets(d: Inputs) -> DataFrame:
    return drift.top_recent(d.asset_deltas, [F.desc("SnapshotTS"), F.abs("DeltaAssets").desc_nulls_last(), F.col("DataProductName")], 20)


@query
def top_recent_changes(d: Inputs) -> DataFrame:
    return drift.top_recent(d.residency_deltas.filter("HasChanged"), [F.desc("SnapshotUtc"), F.col("DataProductID")], 50)


@query
def top_recent_timeline(d: Inputs) -> DataFrame:
    return drift.top_recent(d.timeline, [F.desc("SnapshotUtc")], 20)


@query
def sorted_lists(d: Inputs) -> DataFrame:
    return d.dimension.select("DataProductDisplayName", "DataProductId").orderBy("DataProductDisplayName", "DataProductId")


@query
def kpi_timeline(d: Inputs) -> DataFrame:
    return d.timeline


@query
def product_union(d: Inputs) -> DataFrame:
    return scores.product_union(d.gold, d.cc, d.defender_points, d.tag)


@query
def anomaly_points(d: Inputs) -> DataFrame:
    return _rounded(timeseries.anomaly_points(d.h_catalog, "SnapshotUtc", "TotalAssets", 0.5), "expected", "lower", "upper")


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, 4) for n in names})


# Scorecards -----------------------------------------------------------------------------------

@query
def score_tag(d: Inputs) -> DataFrame:
    return d.tag


@query
def tag_history(d: Inputs) -> DataFrame:
    return scores.tag_history(d.tag)


@query
def score_residency(d: Inputs) -> DataFrame:
    return d.residency


@query
def score_cc(d: Inputs) -> DataFrame:
    return d.cc


@query
def score_defender(d: Inputs) -> DataFrame:
    return d.defender


@query
def defender_audit_texts(d: Inputs) -> DataFrame:
    return evidence.defender_audit_json(d.resource, d.pricing, d.assessment, d.alert)


@query
def defender_evidence_rows(d: Inputs) -> DataFrame:
    return evidence.evaluation_rows(d.resource, d.pricing, d.assessment, d.alert)


@query
def defender_plan_rows(d: Inputs) -> DataFrame:
    return evidence.plan_rows(d.resource, d.pricing)


@query
def defender_alert_rows(d: Inputs) -> DataFrame:
    return evidence.alert_rows(d.resource, d.alert)


@query
def defender_evidence_state(d: Inputs) -> DataFrame:
    base = d.stored("base")
    found = scores.defender_evidence(base, d.protection).filter("DefenderApplicable")
    return scores.defender_evidence_state(found, base.filter("IsHybridComputeMachine"))


@query
def score_patch(d: Inputs) -> DataFrame:
    return scores.score_patch(d.cc)


@query
def measure_patch(d: Inputs) -> DataFrame:
    return measures.measure_patch(d.cc)


@query
def compliance_summary(d: Inputs) -> DataFrame:
    return d.summary


@query
def residency_eligibility(d: Inputs) -> DataFrame:
    return d.eligibility


@query
def eligible_listing(d: Inputs) -> DataFrame:
    return eligibility.eligible_listing(d.eligibility)


@query
def cc_investigation_queue(d: Inputs) -> DataFrame:
    return d.queue


@query
def compute_inventory(d: Inputs) -> DataFrame:
    return d.inventory


# Change plans ---------------------------------------------------------------------------------

@query
def residency_change_plan(d: Inputs) -> DataFrame:
    steps = F.array_join(F.transform("operations", lambda o: F.concat_ws(":", o["step"].cast("string"), o["operation"], o["termId"])), ";")
    return d.plan.withColumn("operations", steps)


@query
def residency_change_apply(d: Inputs) -> DataFrame:
    return d.applied[1]


@query
def residency_assignments_after(d: Inputs) -> DataFrame:
    return d.applied[0]


@query
def residency_changelog(d: Inputs) -> DataFrame:
    return residency_change.residency_changelog(d.applied[1], PARENT_TERM, ACTOR, SOURCE, RUN_TS)


@query
def tag_merge_plan(d: Inputs) -> DataFrame:
    return d.tag_plan.withColumn("beforeTags", tags_text("beforeTags")).withColumn("afterTags", tags_text("afterTags"))


@query
def tag_merge_counts(d: Inputs) -> DataFrame:
    return tag_change.tag_merge_counts(d.tag_plan)


@query
def cc_changelog(d: Inputs) -> DataFrame:
    return tag_change.cc_changelog(d.tag_plan, ACTOR, SOURCE, TAG_REQUEST, RUN_TS)


@query
def enforce_tag_policy(d: Inputs) -> DataFrame:
    return policy.enforce_tag_policy(d.resource)


@query
def audit_managed_identity(d: Inputs) -> DataFrame:
    return policy.audit_managed_identity(d.resource)


@query
def policy_state_rollup(d: Inputs) -> DataFrame:
    return policy.policy_state_rollup(d.policy_state)


@query
def policy_state_by_control(d: Inputs) -> DataFrame:
    return policy.policy_state_by_control(d.policy_state)


@query
def dashboard_info(d: Inputs) -> DataFrame:
    return reports.dashboard_info(d.dimension, d.asset_counts, d.eligibility)


@query
def investigation_match(d: Inputs) -> DataFrame:
    return owners.investigation_match(d.residency_request, d.queue)


# Measures -------------------------------------------------------------------------------------

@query
def measures_products(d: Inputs) -> DataFrame:
    return measures.measures_products(d.gold, d.gold, d.asset_counts)


@query
def product_flags(d: Inputs) -> DataFrame:
    return measures.product_flags(d.gold, d.classification, d.inventory)


@query
def measures_pii(d: Inputs) -> DataFrame:
    return measures.measures_pii(d.gold, d.stored("classification"), d.inventory, d.gap_no_compute, d.gap_not_confidential)


@query
def measures_cc(d: Inputs) -> DataFrame:
    cc = d.stored("cc")
    return measures.measures_cc(cc, owners.cc_investigation_queue(cc, d.owners, d.gold))


@query
def measures_scores(d: Inputs) -> DataFrame:
    return measures.measures_scores(d.cc, d.defender_points, d.residency_from(d.stored("base")), d.tag)


@query
def measures_last_run(d: Inputs) -> DataFrame:
    return measures.measures_last_run(d.residency_deltas, d.catalog_deltas, d.timeline)


# Reports --------------------------------------------------------------------------------------

@query
def products_by_region(d: Inputs) -> DataFrame:
    return reports.products_by_region(d.gold)


@query
def assets_by_product(d: Inputs) -> DataFrame:
    return reports.assets_by_product(d.asset_counts)


@query
def missing_region_list(d: Inputs) -> DataFrame:
    return reports.missing_region_list(d.gold)


@query
def kpi_lines(d: Inputs) -> DataFrame:
    return reports.kpi_lines(d.timeline)


@query
def residency_log(d: Inputs) -> DataFrame:
    return reports.residency_log(d.residency_deltas)


@query
def recent_asset_changes(d: Inputs) -> DataFrame:
    return reports.recent_asset_changes(d.asset_deltas, d.newest_asset_time)


@query
def score_gauges(d: Inputs) -> DataFrame:
    return reports.score_gauges(d.summary)


@query
def non_confidential_vms(d: Inputs) -> DataFrame:
    return reports.non_confidential_vms(d.inventory, d.dimension)


@query
def sensitive_and_confidential(d: Inputs) -> DataFrame:
    return reports.sensitive_and_confidential(d.gold, d.classification, d.inventory)


@query
def gap_tables(d: Inputs) -> DataFrame:
    return reports.gap_tables(d.gap_no_compute, d.gap_not_confidential, d.dimension)


@query
def investigation_table(d: Inputs) -> DataFrame:
    return reports.investigation_table(d.queue)


@query
def score_matrix(d: Inputs) -> DataFrame:
    return reports.score_matrix(d.summary)


@query
def patch_list(d: Inputs) -> DataFrame:
    return reports.patch_list(d.cc, d.dimension)


@query
def patch_list_no_data(d: Inputs) -> DataFrame:
    return reports.patch_list(d.cc, d.dimension, V.PATCH_NO_DATA)


@query
def cc_cards(d: Inputs) -> DataFrame:
    return reports.cc_cards(d.cc)


@query
def cc_detail(d: Inputs) -> DataFrame:
    return reports.cc_detail(d.cc, d.dimension)


@query
def slicers(d: Inputs) -> DataFrame:
    return reports.slicers([("tenant", d.inventory, "TenantId"), ("location", d.inventory, "Location"),
                            ("product", d.dimension, "DataProductDisplayName"), ("region", d.gold, "ResidencyRegion")])


# Text -----------------------------------------------------------------------------------------

@query
def redact_text(d: Inputs) -> DataFrame:
    return text_jobs.redact_text(d.documents, TEXT_RULES)


@query
def redaction_report(d: Inputs) -> DataFrame:
    return text_jobs.redaction_report(d.documents, TEXT_RULES)


@query
def leak_scan(d: Inputs) -> DataFrame:
    return text_jobs.leak_scan(d.documents, SCAN_RULES)


@query
def literal_scan(d: Inputs) -> DataFrame:
    """Texts against thousands of literals: host names per nation and the names of all products."""
    hosts = d.nation.select(F.concat(F.lit("host "), F.col("n_nationkey").cast("string")).alias("rule"),
                            F.concat(F.lit("mail"), F.col("n_nationkey").cast("string"), F.lit(".example.com")).alias("find"))
    names = d.product.select(F.concat(F.lit("product "), "DataProductID").alias("rule"), F.col("DataProductDisplayName").alias("find"))
    return text_jobs.literal_scan(d.documents, hosts.unionByName(names))


@query
def leak_verdict(d: Inputs) -> DataFrame:
    """Verdict on the texts as they are, and after redaction."""
    after = text_jobs.redact_text(d.documents, (*TEXT_RULES, text_jobs.Rule("Exact:host", "mail2.example.com", "<HOST>", pattern=False)))
    parts = [text_jobs.leak_verdict(text_jobs.leak_scan(df, SCAN_RULES[:2])).withColumn("texts", F.lit(n))
             for n, df in (("raw", d.documents), ("redacted", after))]
    return parts[0].unionByName(parts[1])


@query
def reference_lineage(d: Inputs) -> DataFrame:
    return text_jobs.reference_lineage(d.visual)


@query
def visual_catalog(d: Inputs) -> DataFrame:
    return text_jobs.visual_catalog(d.visual)


@query
def report_lineage(d: Inputs) -> DataFrame:
    return text_jobs.report_lineage(d.visual)


@query
def table_usage(d: Inputs) -> DataFrame:
    return text_jobs.table_usage(d.visual)


@query
def lineage_counts(d: Inputs) -> DataFrame:
    return text_jobs.lineage_counts(d.visual)


# Streams --------------------------------------------------------------------------------------

def _series(d: Inputs) -> DataFrame:
    """Totals of the catalog and of products, and regions, as one stream of keyed snapshots."""
    catalog = d.h_catalog.select(F.lit("catalog").alias("key"), F.col("SnapshotUtc").cast("timestamp").alias("ts"),
                                 F.col("TotalAssets").cast("bigint").alias("total"), F.lit(None).cast("string").alias("region"))
    totals = d.h_asset.select(F.concat(F.lit("assets:"), "DataProductName").alias("key"), F.col("SnapshotTS").cast("timestamp").alias("ts"),
                              F.col("TotalAssets").alias("total"), F.lit(None).cast("string").alias("region"))
    regions = d.h_residency.select(F.concat(F.lit("region:"), "DataProductID").alias("key"), F.col("Snapshots").cast("timestamp").alias("ts"),
                                   F.lit(None).cast("bigint").alias("total"), F.col("ResidencyRegion").alias("region"))
    return catalog.unionByName(totals).unionByName(regions)


@query
def snapshot_ingest_stream(d: Inputs) -> DataFrame:
    """Snapshot files, one of which comes twice, streamed into a history that keeps each time once."""
    folder = shared_folder(d.spark)
    for half in ("IsApproximate", "NOT IsApproximate", "IsApproximate"):
        d.h_catalog.filter(half).write.mode("append").parquet(f"{folder}/in")
    source = snapshots.snapshot_source(d.spark, f"{folder}/in", d.h_catalog.schema, files_per_batch=2)
    snapshots.snapshot_ingest_stream(source, f"{folder}/history", f"{folder}/progress", ["SnapshotUtc"], "SnapshotUtc").awaitTermination()
    return snapshots.history(d.spark, f"{folder}/history", d.h_catalog.schema)


@query
def drift_alert_stream(d: Inputs) -> DataFrame:
    """Three arrivals out of order, streamed: late rows are judged, and so are the rows after them."""
    folder = shared_folder(d.spark)
    series = _series(d)
    for part in range(3):
        series.filter(F.pmod(F.xxhash64("key", "ts"), F.lit(3)) == part).write.mode("append").parquet(f"{folder}/in")
        source = snapshots.snapshot_source(d.spark, f"{folder}/in", series.schema)
        snapshots.drift_alert_stream(source, f"{folder}/state", f"{folder}/alerts", f"{folder}/progress").awaitTermination()
    return snapshots.current_alerts(d.spark, f"{folder}/state", f"{folder}/alerts")


@query
def drift_alerts(d: Inputs) -> DataFrame:
    return drift.drift_alerts(d.h_catalog, d.h_asset, d.h_residency)


# Derived tables kept up to date -----------------------------------------------------------------

def _months(history: DataFrame, time: str) -> list[DataFrame]:
    """A history in three arrivals, each newer than the one before."""
    at = F.col(time).cast("timestamp")
    cuts = [F.lit(x).cast("timestamp") for x in ("2024-01-11 00:00:00", "2024-01-21 00:00:00")]
    return [history.filter(at < cuts[0]), history.filter((at >= cuts[0]) & (at < cuts[1])), history.filter(at >= cuts[1])]


def _deltas_in_steps(d: Inputs, history: DataFrame, time: str, deltas: Callable[..., DataFrame]) -> DataFrame:
    folder = shared_folder(d.spark)
    steps = [deltas(new, partial(upkeep.extend_deltas, folder=folder, run=i)) for i, new in enumerate(_months(history, time))]
    return reduce(DataFrame.unionByName, steps)


def _totals_in_steps(d: Inputs, history: DataFrame, time: str, totals: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Arrivals that split days between them: each run builds only the days it touches."""
    folder, day = shared_folder(d.spark), "HistoryDay"
    schema = T.StructType([*history.schema.fields, T.StructField(day, T.DateType()), T.StructField("run", T.IntegerType())])
    for i in range(2):
        new = history.filter(F.pmod(F.xxhash64(*history.columns), F.lit(2)) == i)
        days = upkeep.append_days(new, f"{folder}/history", time, day, i)
        stored = d.spark.read.schema(schema).parquet(f"{folder}/history")
        upkeep.refresh_days(stored, days, day, totals, "SnapUtc", f"{folder}/totals")
    return upkeep.read_days(d.spark, f"{folder}/totals", day)


@query
def catalog_deltas_in_steps(d: Inputs) -> DataFrame:
    return _deltas_in_steps(d, d.h_catalog, "SnapshotUtc", drift.catalog_deltas)


@query
def asset_count_deltas_in_steps(d: Inputs) -> DataFrame:
    return _deltas_in_steps(d, d.h_asset, "SnapshotTS", drift.asset_count_deltas)


@query
def residency_deltas_in_steps(d: Inputs) -> DataFrame:
    return _deltas_in_steps(d, d.h_residency, "Snapshots", drift.residency_deltas)


@query
def asset_totals_in_steps(d: Inputs) -> DataFrame:
    return _totals_in_steps(d, d.h_asset, "SnapshotTS", drift.asset_totals_by_snapshot)


@query
def residency_totals_in_steps(d: Inputs) -> DataFrame:
    return _totals_in_steps(d, d.h_residency, "Snapshots", drift.residency_totals_by_snapshot)


def run(key: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(QUERIES[key](Inputs(spark, sf_dir)))
