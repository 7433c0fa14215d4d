"""Parsers and normalisers on literal cases."""

import json

import pytest
from pyspark.sql import functions as F

from govmill.functions import columns as C
from govmill.functions import fixed_values as V


def values(spark, fn, texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.v for r in rows.select("i", fn(F.col("t")).alias("v")).orderBy("i").collect()]


def test_bool_spellings(spark):
    texts = ["Yes", " y ", "TRUE", "1", "no", "N", "false", "0", "t", "f", "n/a", "", None]
    assert values(spark, C.parse_bool, texts) == [True] * 4 + [False] * 4 + [None] * 5
    assert values(spark, C.parse_bool_strict, texts) == [True] * 4 + [False] * 9
    assert values(spark, lambda c: C.parse_bool_request(c, True), texts) == [True] * 4 + [False] * 4 + [True, False, True, True, True]


def test_guid(spark):
    good = "0a1b2c3d-0000-1111-2222-abcdefABCDEF"
    assert values(spark, C.is_guid, [good, good[:-1], "x" + good[1:], None, f" {good} "]) == [True, False, False, False, True]


def test_resource_paths(spark):
    rid = "/Subscriptions/ABC/resourceGroups/rg/providers/T/vm1"
    assert values(spark, C.resource_name, [rid, "plain"]) == ["vm1", "plain"]
    assert values(spark, C.subscription_of, [rid, "plain", None]) == ["abc", None, None]
    assert values(spark, C.assessment_id, [rid + "//", " ", None]) == [rid + V.PATCH_SUFFIX, None, None]


def test_buckets(spark):
    assert values(spark, C.bucket_of_arn, ["arn:aws:s3:::my-bucket.1", " arn:aws:s3:::abc ", "arn:aws:s3:::ab", "arn:aws:s3:::a b c", "", None]) == [
        "my-bucket.1", "abc", None, None, None, None]
    assert values(spark, C.bucket_region, ["US", "us", " ", None, " eu-west-1 "]) == ["us-east-1"] * 4 + ["eu-west-1"]


@pytest.mark.parametrize("text, total", [
    (None, None), ("", None), ("  ", None), ("null", None), ("n/a", None), ('{"a":', None), ('"word"', None),
    ("{}", 0), ("[]", 0), ("7", 7), ("-3", -3), ("7.9", 7), ("true", 1), ("false", 0), ('"12"', 12),
    ('{"a":1,"b":{"c":2,"d":[3,4,{"e":5}]}}', 15), ('[1,"3","x",true,null]', 5),
    ('{"x 5,":"p,7,q","y":2}', 2), ('{"a":"{\\"x\\":4,\\"y\\":\\"[1,2]\\"}","b":5}', 12),
    ('{"1":2,"3":"4"}', 6), ('{"a":1.5,"b":1.5}', 2), ('{"a":"say \\"9\\" now"}', 0),
    ('{"a":"2.9"}', 2), ('{"a":"true","b":"false"}', 1), ('{"a":" [1,\\n 2] "}', 3), ('{"a":2000000000,"b":2000000000}', 4_000_000_000),
    ('{"a":"007","b":"1e2"}', 107), ("007", 7), ('{"a":"' + "x" * 100_000 + '","b":3}', 3), ('"' + "y" * 5000 + '"', None),
    ('{"a":"' + '\\\\' * 4000 + '","b":1}', 1),
])
def test_nested_counts(spark, text, total):
    assert values(spark, C.sum_nested_counts, [text]) == [total]


def test_nested_counts_opens_every_quoted_level(spark):
    text = '{"n": 1}'
    for level in range(2, 6):
        text = json.dumps({"n": level, "inner": text})
    assert values(spark, C.sum_nested_counts, [text]) == [15]


def test_blank_tag_variants_do_not_hide_filled_ones(spark):
    df = spark.createDataFrame([({"a": " ", "b": "X1"},), ({"a": "", "b": ""},), ({"b": "y"},), (None,)], "tags map<string,string>")
    assert [r[0] for r in df.select(C.tag_value(F.col("tags"), ("a", "b"))).collect()] == ["x1", None, "y", None]


def test_plans_and_kinds(spark):
    types = ["Microsoft.Compute/virtualMachines", "microsoft.sql/servers/databases", "Microsoft.Fabric/x", "other", None]
    assert values(spark, C.defender_candidate_plans, types) == [
        ["virtualmachines", "sqlservervirtualmachines"], ["sqlservers", "sqlservervirtualmachines"], [], [], []]
    assert values(spark, C.resource_kind, types) == ["AzureVM", None, None, None, None]


def test_single_value_and_display(spark):
    assert values(spark, C.single_value, ["a", "a,b", None]) == [True, False, False]
    assert values(spark, C.display_region, [" x ", " ", None]) == ["x", V.UNASSIGNED_REGION, V.UNASSIGNED_REGION]
