"""Relationships of the report models, slicers, and evidence as rows."""

import pytest
from pyspark.sql import types as T

from govmill import registry
from govmill.functions.schemas import schema_diff_counts
from govmill.inputs import Inputs
from govmill.operators import evidence, measures, scores, star


def test_inactive_relationships_are_followed_only_on_request():
    assert star.path("asset_counts").to == star.DESCRIPTION
    assert star.path("summary").active and not star.path("summary", active_only=False, model="scores: ").active
    with pytest.raises(KeyError):
        star.path("residency")
    assert star.path("residency", active_only=False).column == "DataProductDescription"
    assert len(star.RELATIONSHIPS) == 15 and len({r.name for r in star.RELATIONSHIPS}) == 15


def test_every_fact_row_stays_once_per_product(spark):
    products = spark.createDataFrame([("p1", "One", "cheese"), ("p2", "Two", "cheese"), ("p3", "Three", None)],
                                     "DataProductId string, DataProductDisplayName string, DataProductDescription string")
    key = spark.createDataFrame([(" P1 ",), ("p9",), (None,), (None,)], "DataProductId string")
    facts = {r.fact: key.selectExpr(f"DataProductId as {r.column}") for r in star.RELATIONSHIPS}
    facts["asset_counts"] = spark.createDataFrame([("Cheese",), ("Two",)], "DataProductName string")
    rows = star.product_rows(facts, products).collect()
    per = {}
    for r in rows:
        per.setdefault(r.fact, []).append((r.fact_key, r.ProductId))
    assert len(per) == 15
    assert sorted(per.pop("asset_counts")) == [("Cheese", "p1"), ("Cheese", "p2"), ("Two", None)]
    for got in per.values():
        assert sorted(got, key=str) == sorted([(" P1 ", "p1"), ("p9", None), (None, None), (None, None)], key=str)


def test_slicer_totals_add_up(inputs):
    rows = measures.measures_by_slicer(inputs.stored("base")).collect()
    total = next(r for r in rows if (r.region, r.kind) == ("ALL", "ALL"))
    assert total.products == inputs.stored("base").count()
    for name in ("products", "sensitive", "protectable", "fullname_columns"):
        assert sum(r[name] for r in rows if r.region != "ALL" and r.kind == "ALL") == total[name]
        assert sum(r[name] for r in rows if r.region != "ALL" and r.kind != "ALL") == total[name]


def test_a_product_with_very_many_resources_keeps_them_all(spark):
    n = 10_000
    resource = spark.range(n).selectExpr(
        "concat('/subscriptions/S/resourceGroups/g/providers/Microsoft.Compute/virtualMachines/r', id) AS ResourceId", "'Microsoft.Compute/virtualMachines' AS ResourceType",
        "'S' AS SubscriptionId", "'g' AS ResourceGroup", "'x' AS Location", "map('dataproductid', 'dp-1') AS Tags", "'{}' AS Properties")
    pricing = spark.createDataFrame([("S", "VirtualMachines", "Standard")], "SubscriptionId string, plan_name string, pricingTier string")
    check = spark.createDataFrame([("/subscriptions/s/resourcegroups/g/providers/microsoft.compute/virtualmachines/r7", "c", "Unhealthy", "d")],
                                  "resource_id string, displayName string, statusCode string, statusChangeDate string")
    alert = spark.createDataFrame([("/subscriptions/s/resourcegroups/g/providers/microsoft.compute/virtualmachines/r7", i, "High", "Active", "t") for i in range(40)],
                                  "resource_id string, systemAlertId int, severity string, status string, startTimeUtc string")
    rows = evidence.evaluation_rows(resource, pricing, check, alert)
    assert rows.count() == n == rows.filter("defenderConfigured").count()
    assert [tuple(r) for r in rows.filter("assessmentsTotal > 0").select("ResourceName", "unhealthy", "highActiveAlerts").collect()] == [("r7", 1, 40)]
    assert evidence.plan_rows(resource, pricing).count() == 2 * n and evidence.alert_rows(resource, alert).count() == 40
    one = evidence.product_evidence(resource, pricing, check, alert).collect()
    assert len(one) == 1 and one[0].protection.applicableResourceCount == n and one[0].chosen.ResourceId.endswith("/r0")


def test_schema_differences_are_counted(spark):
    df = spark.createDataFrame([(1, "a", None), (2, None, "x")], "id int, Name string, extra string")
    target = T.StructType([T.StructField("ID", T.LongType()), T.StructField("name", T.StringType()), T.StructField("gone", T.StringType())])
    got = {r.column: (r.issue, r.filled) for r in schema_diff_counts(df, target).collect()}
    assert got == {"id": ("TYPE MISMATCH", 2), "extra": ("ONLY IN DF", 1), "gone": ("ONLY IN TABLE", None)}
    assert schema_diff_counts(df, df.schema).count() == 0


def test_resources_of_a_small_file_are_dealt_out(inputs):
    assert inputs.resource.selectExpr("spark_partition_id() AS p").distinct().count() > 2


def test_all_scorecards_of_the_report_models_read_one_table_of_evidence(spark, sf_dir, monkeypatch):
    def never(*args):
        raise AssertionError("resources were gathered again")

    monkeypatch.setattr(scores, "resource_rollup", never)
    monkeypatch.setattr(scores, "tag_evidence", never)
    monkeypatch.setattr(evidence, "prefer_applicable_resource", never)
    registry.star_rows(Inputs(spark, sf_dir))


def test_saved_filters_classify_the_columns_once(spark, sf_dir):
    d = Inputs(spark, sf_dir)
    registry.saved_filter_rows(d)
    assert {"classification", "gold"} <= set(d._stored)
