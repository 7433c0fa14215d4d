"""Change plans: gates, applying, planning again."""

import pytest
from pyspark.sql import functions as F

from govmill.inputs import PARENT_TERM, PRODUCT_PATTERN
from govmill.plans import residency_change, tag_change


def test_every_outcome_is_planned(inputs):
    got = {(r.status, r.action) for r in inputs.stored("plan").select("status", "action").distinct().collect()}
    assert got == {("rejected", "none"), ("blocked", "manual_review"), ("blocked", "none"), ("no_change", "none"),
                   ("preview", "add"), ("preview", "replace")}


def test_second_plan_finds_nothing_to_change(inputs):
    after, results = inputs.applied
    applied = results.filter("applied")
    assert applied.count() > 0 and applied.filter("NOT verifiedMatch").count() == 0
    requests = inputs.residency_request.join(applied.select("requestId"), "requestId", "left_semi").withColumn("expectedProvided", F.lit(False))
    again = residency_change.residency_change_plan(requests, after, inputs.term, inputs.product, PARENT_TERM, PRODUCT_PATTERN)
    assert [r.status for r in again.select("status").distinct().collect()] == ["no_change"]


def test_two_requests_for_one_product_apply_once(spark):
    plan_in = spark.createDataFrame([("r1", "dp-1", "b", False, None, False, True), ("r2", "dp-1", "c", False, None, False, True)],
                                    "requestId string, dataProductId string, targetResidencyCode string, expectedProvided boolean, "
                                    "expectedCurrentResidencyCode string, dryRun boolean, confirm boolean")
    term = spark.createDataFrame([(t, t.lower(), "P") for t in "ABC"], "GlossaryTermId string, GlossaryTermDisplayName string, ParentGlossaryTermId string")
    links = spark.createDataFrame([(" DP-1", "A", 1), (" DP-1", "A", 0), ("dp-2", "A", 1)], "DataProductId string, GlossaryTermId string, ActiveFlag int")
    product = spark.createDataFrame([(" DP-1", "One")], "DataProductID string, DataProductDisplayName string")
    plan = residency_change.residency_change_plan(plan_in, links, term, product, "P", PRODUCT_PATTERN)
    after, result = residency_change.residency_change_apply(plan, links, term, "P")
    assert {r.requestId: (r.status, r.verifiedMatch) for r in result.collect()} == {"r1": ("applied", True), "r2": ("blocked", None)}
    assert sorted(map(tuple, after.collect())) == [(" DP-1", "A", 0), (" DP-1", "B", 1), ("dp-2", "A", 1)]


def test_tag_plan_needs_confirmation(inputs):
    with pytest.raises(ValueError):
        tag_change.tag_merge_plan(inputs.tag_item, inputs.resource, dry_run=False, confirm=False)
    preview = tag_change.tag_merge_plan(inputs.tag_item, inputs.resource, dry_run=True, confirm=False)
    assert preview.filter("applied").count() == 0 and preview.filter("status = 'preview'").count() > 0
