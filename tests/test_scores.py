"""Every band of every ladder, and properties of scorecards."""

import pytest
from pyspark.sql import functions as F

from govmill.functions import fixed_values as V
from govmill.inputs import RUN_TS
from govmill.operators import checks, evidence, gold, measures, reports, scores
from govmill.plans import eligibility


def counts(df, *by):
    return {tuple(r)[:-1]: r["count"] for r in df.groupBy(*by).count().collect()}


def test_tag_bands(inputs):
    seen = counts(scores.score_tag(inputs.stored("base"), inputs.resource, RUN_TS, V.PRODUCT_TAGS), "TagReason")
    assert {k[0] for k in seen} == {v for k, v in V.TAG_REASONS.items() if k != "partial"}


def test_residency_bands(inputs):
    assert {k[0] for k in counts(inputs.residency, "ResidencyScorePct")} == {0, 25, 50, 75, 100}


def test_cc_bands(inputs):
    card = scores.score_cc(inputs.stored("base"), inputs.resource, inputs.patch, inputs.sku, RUN_TS, V.PRODUCT_TAGS)
    got = {(r.CCForPIIScore, r.CCForPIIStatus, r.Reason) for r in card.collect()}
    assert got == {b for k, b in V.CC_BANDS.items() if k != "unknown"}


def test_defender_bands(inputs):
    assert set(counts(inputs.defender, "progressScore", "progressState")) == set(V.DEFENDER_BANDS.values())


def test_eligibility_reasons(inputs):
    got = {k[0] for k in counts(inputs.eligibility, "EligibilityReason")}
    assert got == {v for k, v in V.ELIGIBILITY_REASONS.items() if k not in ("no_count", "no_region")}


def test_eligibility_reasons_out_of_reach_of_fixtures(inputs, spark):
    row = {"AzureResourceFound": F.lit(True), "GlossaryResidencyMissing": F.lit(True)}
    base = inputs.stored("residency").limit(1).withColumns(row)
    rules = inputs.approved_region
    none = base.withColumns({"AzureResourceCount": F.lit(0)})
    blank = base.withColumns({"AzureResourceCount": F.lit(1), "AzureLocations": F.lit(" ")})
    reasons = [eligibility.residency_eligibility(df, rules, RUN_TS).collect()[0].EligibilityReason for df in (none, blank)]
    assert reasons == [V.ELIGIBILITY_REASONS["no_count"], V.ELIGIBILITY_REASONS["no_region"]]


def test_scorecards_hold_exactly_the_base_products(inputs):
    base = inputs.stored("base")
    got = checks.coverage_check(base, {"tag": (inputs.tag, "dataProductId"), "cc": (inputs.cc, "DataProductId")}).collect()
    n = base.count()
    assert {(r.scorecard, r.rows, r.products, r.missing, r.unknown) for r in got} == {("tag", n, n, 0, 0), ("cc", n, n, 0, 0)}


def test_summary_joins_mixed_case_ids(spark):
    g = spark.createDataFrame([(" DP-1 ", "One", None, None)], "DataProductID string, DataProductDisplayName string, DataProductDescription string, ResidencyRegion string")
    cc = spark.createDataFrame([("dp-1", "One", 75, "Assessed", 2)], "DataProductId string, DataProductDisplayName string, CCForPIIScore int, PatchAssessmentStatus string, PendingUpdatesTotal int")
    d = spark.createDataFrame([("dp-1", 50)], "dataProductId string, progressScore int")
    t = spark.createDataFrame([("dp-1", "One", 80)], "dataProductId string, dataProductDisplayName string, TagScorePct int")
    r = spark.createDataFrame([("dp-1", 25), ("stray", 0)], "DataProductID string, ResidencyScorePct int")
    assert [tuple(x) for x in scores.compliance_summary(g, r, cc, d, t).collect()] == [("dp-1", "One", 25, 75, 50, 80, 50)]


def test_patch_rules_disagree(spark):
    cc = spark.createDataFrame([("a", "NoData", None), ("b", "Assessed", 3), ("c", "Assessed", 0), ("d", None, None)],
                               "DataProductId string, PatchAssessmentStatus string, PendingUpdatesTotal int")
    assert {r.DataProductId: r.PatchComplianceScorePct for r in scores.score_patch(cc).collect()} == {"a": 0, "b": 50, "c": 100, "d": 100}
    assert measures.measure_patch(cc).collect()[0][0] == 75.0


def test_arm_error_is_kept(inputs):
    resource = inputs.resource.withColumn("ArmError", F.lit("no access"))
    got = evidence.cc_evidence(resource, inputs.patch, variants=V.PRODUCT_TAGS).groupBy("DetailsNote").agg(F.max("ArmError").alias("e")).collect()
    unread = {V.CC_NOTES["vm_unread"], V.CC_NOTES["sqlvm_unread"]}
    assert {r.DetailsNote for r in got if r.e} <= unread and any(r.e for r in got)


def test_full_name_counts_with_shared_columns(spark):
    product = spark.createDataFrame([("p", "P"), ("q", "Q"), ("r", "R")], "DataProductID string, DataProductDisplayName string")
    links = spark.createDataFrame([("p", "a"), ("p", "a"), ("p", "b"), ("q", "b"), ("q", "c")], "DataProductId string, DataAssetId string")
    # Column s sits in assets a and b, so product p must count it once.
    cols = [("a", "x"), ("a", "s"), ("b", "s"), ("b", "y"), ("c", "z")]
    columns = spark.createDataFrame(cols, "DataAssetId string, ColumnId string")
    marks = spark.createDataFrame([(a, c, "K") for a, c in cols if c != "z"] * 2, "DataAssetId string, ColumnId string, ClassificationId string")
    classes = spark.createDataFrame([("K", "NAME")], "ClassificationId string, ClassificationDisplayName string")
    got = gold.fullname_classification(product, links, columns, marks, classes, "NAME", RUN_TS).collect()
    assert {r.DataProductId: (r.HasFullNameClassification, r.FullNameColumnCount) for r in got} == {"p": (1, 3), "q": (1, 2), "r": (0, 0)}


def test_cut_json_is_a_whole_prefix(inputs, monkeypatch):
    args = (inputs.resource, inputs.pricing, inputs.assessment, inputs.alert)
    whole = {r.DataProductId: r.resourcesJson for r in evidence.defender_audit_json(*args).collect()}
    monkeypatch.setattr(V, "JSON_LIMIT", 300)
    for r in evidence.defender_audit_json(*args).collect():
        assert r.resourcesJson == whole[r.DataProductId][:300]


def test_report_keeps_unchanged_rows(inputs):
    assert reports.residency_log(inputs.residency_deltas).count() == inputs.residency_deltas.filter("NOT HasChanged").count()


def test_saved_name_to_description_relationship_matches_nothing(inputs):
    joined = reports.star_join(inputs.asset_counts, inputs.dimension, "DataProductName", "DataProductDescription")
    assert joined.filter("ProductId IS NOT NULL").count() == 0


@pytest.mark.parametrize("text, code, approved", [("NATION_1", "nation_1", True), ("nation 1", "nation_1", True),
                                                  ("nation_3", "nation_3", False), (" Unknown ", None, False), (None, None, False)])
def test_region_lookup(inputs, spark, text, code, approved):
    rules = spark.createDataFrame([("Nation 1", "NATION_1", "Yes", ""), ("Nation 3", "NATION_3", "no", "")],
                                  "region_name string, region_code string, approved string, notes string")
    df = spark.createDataFrame([(text,)], "t string")
    r = evidence.approved_region_lookup(df, "t", rules).collect()[0]
    assert (r.RegionCode, r.IsApproved) == (code, approved)
