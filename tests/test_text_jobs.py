"""Redaction order, leak findings, lineage depth."""

import json

from pyspark.sql import functions as F

from govmill.operators.text_jobs import (
    FORBIDDEN_PATTERNS, REDACTION_PATTERNS, Rule, find_index, leak_scan, literal_scan, leak_verdict, redact_text, redaction_report, report_lineage, table_usage,
    visual_catalog, visual_references,
)

RULES = (Rule("exact", "host.example.com", "<HOST>", pattern=False), *REDACTION_PATTERNS)


def docs(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")


def test_rules_apply_in_order(spark):
    df = docs(spark, "a@host.example.com b@c.org", "https://x-1.azurewebsites.net/api https://k.vault.azure.net/s", "plain", None)
    out = {r.doc_id: (r.text, r.changed) for r in redact_text(df, RULES).collect()}
    assert out == {0: ("a@<HOST> <OWNER_EMAIL>", True), 2: ("plain", False), 3: (None, False),
                   1: ("https://<FUNCTION_APP>.azurewebsites.net/api https://<KEYVAULT_NAME>.vault.azure.net/s", True)}
    report = {r.rule: (r.replacements, r.docs) for r in redaction_report(df, RULES).collect()}
    assert report == {"exact": (1, 1), "EmailReplacement": (1, 1), "FunctionAppUrlReplacement": (1, 1), "KeyVaultUrlReplacement": (1, 1)}


def test_leaks(spark):
    guid = "0a1b2c3d-0000-1111-2222-abcdefabcdef"
    df = docs(spark, f'x = 1\ntenant_id = "{guid}"', f"subscriptions: [{guid}]", 'OWNER_EMAIL = "a@b.org"', f'Client_Id="{guid}"', "clean")
    found = leak_scan(df, (*FORBIDDEN_PATTERNS, Rule("lit", "clean", pattern=False)))
    assert {(r.doc_id, r.type, r.rule) for r in found.collect()} == {
        (0, "pattern", "TenantIdAssignment"), (1, "pattern", "SubscriptionGuidArray"), (2, "pattern", "OwnerEmail"),
        (3, "pattern", "ClientIdAssignment"), (4, "literal", "lit")}
    assert tuple(leak_verdict(found).collect()[0]) == (5, False)
    assert tuple(leak_verdict(leak_scan(df.filter("doc_id = 4"), FORBIDDEN_PATTERNS)).collect()[0]) == (0, True)


def nested(levels: int, entity: str) -> dict:
    node: dict = {"SourceRef": {"Entity": entity}, "Property": f"p-{entity}"}
    for _ in range(levels):
        node = {"child": node}
    return node


def test_references_are_found_at_any_depth(spark):
    doc = {"a": nested(9, "deep-10"), "b": nested(40, "deep-41"), "list": [{"x": nested(0, 'quoted "name"')}, [nested(0, "list in list")], 5],
           "text": '{"SourceRef":{"Entity":"only text"}}'}
    df = spark.createDataFrame([("v", "p", json.dumps(doc)), ("bad", "p", "{"), ("none", "p", None), ("array", "p", json.dumps([nested(0, "x")]))], "visual_id string, page_id string, definition string")
    got = {r.visual_id: (r.entities, r.properties) for r in visual_references(df).collect()}
    assert got == {"v": (["deep-10", "deep-41", 'quoted "name"'], ["p-deep-10", "p-deep-41", 'p-quoted "name"']), "bad": ([], []), "array": ([], []), "none": ([], [])}


def test_visuals_are_described_whatever_is_missing(spark):
    full = {"name": "a", "visual": {"visualType": "card", "visualContainerObjects": {"title": [{"properties": {"text": {"expr": {"Literal": {"Value": "'It''s'"}}}}}]},
                                    "query": nested(2, "T")}}
    rows = [("a", "p", "x/Board__Report/definition/pages/p1/visuals/a/visual.json", json.dumps(full)), ("b", "p", "visual.json", "{"), ("c", "p", None, None),
            ("d", "p", "Board__Report/pages/p1/visuals/d/visual.json", json.dumps({"visual": {"visualContainerObjects": {"title": []}}, "x": nested(0, "T")}))]
    df = spark.createDataFrame(rows, "visual_id string, page_id string, path string, definition string")
    got = {r.visual_id: tuple(r)[1:] for r in visual_catalog(df).collect()}
    assert got == {"a": ("card", "It''s", "Board", "p1"), "b": ("unknown", "Untitled", "unknown", "unknown"),
                   "c": ("unknown", "Untitled", "unknown", "unknown"), "d": ("unknown", "Untitled", "Board", "p1")}
    counts = {(r.report, r.page): (r.visuals, r.entities) for r in report_lineage(df).collect()}
    assert counts == {("Board", "p1"): (2, 1), ("Board", None): (2, 1), ("unknown", "unknown"): (2, 0), ("unknown", None): (2, 0)}
    assert {(r.entity, r.visual_id, r.title) for r in table_usage(df).collect()} == {("T", "a", "It''s"), ("T", "d", "Untitled")}


def test_thousands_of_literals_are_rows(spark):
    texts = ["xkey-17y and key-2", "KEY-3", None, "", "key-4999", "a\nb key-\n12", "é漢字é", "ab", "key-1key-10"]
    finds = [f"key-{i}" for i in range(5000)] + ["a\nb", "漢字é", "b", "", "key-\n1", "key-17y and"]
    rules = spark.createDataFrame([(f"r{i}", f) for i, f in enumerate(finds)] + [("none", None), ("r0", "key-0")], "rule string, find string")
    want = sorted((d, f"r{i}") for d, t in enumerate(texts) if t for i, f in enumerate(finds) if f and f in t)
    for bound in (100_000, 10):
        found = literal_scan(docs(spark, *texts), rules, bound)
        assert sorted(map(tuple, found.collect())) == want
        assert len(found._jdf.queryExecution().optimizedPlan().toString()) < 20_000
    assert literal_scan(docs(spark, "abc"), rules.limit(0)).count() == 0


def test_rules_that_share_a_literal_are_not_searched_one_by_one(spark):
    # Each of the six texts meets the grams of one literal, not of the thousand rules that have it.
    rules = spark.range(3000).selectExpr("concat('r', id) AS rule", "concat('common part ', id % 3) AS find")
    texts = ["a common part 1", "common part", "common part 2 common part 0", None, "b common part 1", "c"]
    assert find_index(rules).count() == 3
    want = sorted((d, f"r{i}") for d, t in enumerate(texts) if t for i in range(3000) if f"common part {i % 3}" in t)
    for bound in (100_000, 3, 2):
        found = literal_scan(docs(spark, *texts), rules, bound)
        assert sorted(map(tuple, found.collect())) == want
        # Three literals stay in one expression, for a bound of three: rules do not count.
        assert ("_row" in found._jdf.queryExecution().optimizedPlan().toString()) == (bound == 2)


def test_definitions_of_one_file_are_taken_apart_by_many_tasks(spark):
    rows = [(f"v{i}", "p", "x", json.dumps(nested(2, f"T{i % 7}"))) for i in range(400)]
    df = spark.createDataFrame(rows, "visual_id string, page_id string, path string, definition string").coalesce(1)
    for made in (visual_references(df), visual_catalog(df)):
        dealt = sorted(r["count"] for r in made.groupBy(F.spark_partition_id()).count().collect())
        assert len(dealt) == 4 and dealt[0] >= 90 and sum(dealt) == 400
