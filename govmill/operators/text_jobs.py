"""Redaction, leak scans and report lineage over text, with native functions only."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from govmill.session import spread, stored


@dataclass(frozen=True)
class Rule:
    """A literal (``pattern`` false) or a regular expression, and what takes its place.

    ``needs`` is a literal that every match contains. Texts without it skip the regular expression,
    which on long texts costs far more than the search for a literal.
    """

    name: str
    find: str
    put: str = ""
    pattern: bool = True
    needs: str = ""

    def _guarded(self, text: Column, result: Column, otherwise: Column) -> Column:
        return F.when(text.contains(self.needs), result).otherwise(otherwise) if self.needs else result

    def count(self, text: Column) -> Column:
        if self.pattern:
            return self._guarded(text, F.regexp_count(text, F.lit(self.find)), F.lit(0))
        shorter = F.length(F.replace(text, F.lit(self.find), F.lit("")))
        return ((F.length(text) - shorter) / len(self.find)).cast("int")

    def apply(self, text: Column) -> Column:
        if self.pattern:
            return self._guarded(text, F.regexp_replace(text, self.find, self.put), text)
        return F.replace(text, F.lit(self.find), F.lit(self.put))

    def found(self, text: Column) -> Column:
        return self._guarded(text, text.rlike(self.find), F.lit(False)) if self.pattern else text.contains(self.find)


# Address and web-host patterns to remove, and patterns that must not remain.
REDACTION_PATTERNS = (
    Rule("EmailReplacement", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", "<OWNER_EMAIL>", needs="@"),
    Rule("FunctionAppUrlReplacement", r"https://[A-Za-z0-9-]+\.azurewebsites\.net", "https://<FUNCTION_APP>.azurewebsites.net",
         needs=".azurewebsites.net"),
    Rule("KeyVaultUrlReplacement", r"https://[A-Za-z0-9-]+\.vault\.azure\.net/?", "https://<KEYVAULT_NAME>.vault.azure.net/",
         needs=".vault.azure.net"),
)
FORBIDDEN_PATTERNS = (
    Rule("TenantIdAssignment", r'(?im)^(TENANT_ID|tenant_id)\s*=\s*"[0-9a-fA-F-]{36}"', needs='"'),
    Rule("ClientIdAssignment", r'(?im)^(CLIENT_ID|client_id|RESOURCE_APP_CLIENT_ID)\s*=\s*"[0-9a-fA-F-]{36}"', needs='"'),
    Rule("SubscriptionGuidArray",
         r"(?im)subscriptions?\s*[=:]\s*\[[^\]]*[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}[^\]]*\]", needs="["),
    Rule("OwnerEmail", r"(?im)OWNER_EMAIL.*@[A-Za-z0-9.-]+", needs="@"),
)


def redact_text(docs: DataFrame, rules: Sequence[Rule], text: str = "text") -> DataFrame:
    """Apply the rules in order, each to what the one before left; flag changed texts.

    Every rule is a projection of its own, so a rule's result is computed once and not once per use.
    """
    steps = docs.select("doc_id", F.col(text).alias("_old"), F.col(text).alias("text"))
    for rule in rules:
        steps = steps.withColumn("text", rule.apply(F.col("text")))
    return steps.select("doc_id", "text", (~F.col("text").eqNullSafe(F.col("_old"))).alias("changed"))


def redaction_report(docs: DataFrame, rules: Sequence[Rule], text: str = "text") -> DataFrame:
    """Replacements and changed texts per rule, counted on the text the rule meets. One scan."""
    steps = docs.select(F.col(text).alias("_t0"))
    for i, rule in enumerate(rules):
        steps = steps.withColumn(f"_n{i}", F.coalesce(rule.count(F.col(f"_t{i}")), F.lit(0))).withColumn(
            f"_t{i + 1}", rule.apply(F.col(f"_t{i}")))
    per_text = F.array(*(F.struct(F.lit(r.name).alias("rule"), F.col(f"_n{i}").alias("n")) for i, r in enumerate(rules)))
    return steps.select(F.inline(per_text)).groupBy("rule").agg(
        F.sum("n").alias("replacements"), F.count_if(F.col("n") > 0).alias("docs"))


def leak_scan(docs: DataFrame, rules: Sequence[Rule], text: str = "text") -> DataFrame:
    """One row per text and rule that is found in it. Every rule runs in the one scan of the texts.

    The outer form keeps Spark from testing the hit list for emptiness, which would run every rule twice.
    """
    hits = F.array_compact(F.array(*(
        F.when(r.found(F.col(text)), F.struct(F.lit("pattern" if r.pattern else "literal").alias("type"), F.lit(r.name).alias("rule")))
        for r in rules)))
    return docs.select("doc_id", F.inline_outer(hits)).filter("rule IS NOT NULL")


#: Different literals whose grams are held against each text inside one expression; more are joined as rows.
RULE_BOUND = 50_000
GRAM = 4


def _grams(text: Column) -> Column:
    """All runs of GRAM characters of a text, overlapping."""
    return F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{GRAM}}}))"), F.lit(1))


def find_index(rules: DataFrame) -> DataFrame:
    """(gram, find): each different literal under the one of its grams that the fewest literals share; shorter literals under a null."""
    every = rules.select("find").filter("find <> ''").distinct()
    grams = every.filter(F.length("find") >= GRAM).select("find", F.explode(F.array_distinct(_grams(F.col("find")))).alias("gram"))
    shared = grams.groupBy("gram").agg(F.count("*").alias("n"))
    best = grams.join(shared, "gram").groupBy("find").agg(F.min(F.struct("n", "gram")).alias("_b")).select("_b.gram", "find")
    return best.unionByName(every.filter(F.length("find") < GRAM).select(F.lit(None).cast("string").alias("gram"), "find"))


def literal_scan(docs: DataFrame, rules: DataFrame, bound: int = RULE_BOUND) -> DataFrame:
    """(doc_id, rule) for every row of ``docs`` and every literal in its text; ``rules`` are rows of (rule, find), so thousands of them
    are data and not parts of the plan.

    Texts are searched for different literals; the rules that share a literal are joined to what was found. A text is cut into grams once;
    only literals whose gram it has are looked for. With up to ``bound`` different literals the grams of the index are one array that each
    text's grams are held against; beyond that, grams that no literal lies under are dropped first, the others meet the literals in
    a join on the gram, and texts are joined again for the literals found that way. Null texts and empty literals match nothing.
    """
    index = stored(find_index(rules))
    rows = docs.select("doc_id", "text").filter("text IS NOT NULL")
    # Literals of less than GRAM characters: there are few different ones, and each text is searched for all of them at once.
    short = index.filter("gram IS NULL").agg(F.collect_list("find")).scalar()
    tiny = rows.withColumn("_short", short).select("doc_id", F.explode(F.filter("_short", lambda f: F.contains(F.col("text"), f))).alias("find"))
    long = index.filter("gram IS NOT NULL")
    if long.limit(bound + 1).count() <= bound:
        known = long.agg(F.collect_set("gram")).scalar()
        found = rows.select("doc_id", "text", F.explode(F.array_intersect(_grams(F.col("text")), known)).alias("gram")).join(F.broadcast(long), "gram")
    else:
        kept = stored(rows.withColumn("_row", F.monotonically_increasing_id()))
        known = stored(long.select("gram").distinct())
        cut = kept.select("_row", F.explode(F.array_distinct(_grams(F.col("text")))).alias("gram")).join(known, "gram", "left_semi")
        found = kept.join(cut.join(long, "gram").select("_row", "find"), "_row")
    found = found.filter(F.contains("text", "find")).select("doc_id", "find").unionByName(tiny)
    return found.join(rules.select("rule", "find").distinct(), "find").select("doc_id", "rule")


def leak_verdict(findings: DataFrame) -> DataFrame:
    return findings.agg(F.count("*").alias("total_findings"), (F.count("*") == 0).alias("passed"))


def _children(nodes: Column) -> Column:
    """JSON objects directly inside objects, or inside an array of an object."""
    def below(node: Column) -> Column:
        return F.flatten(F.transform(F.map_values(node.cast("map<string,variant>")), lambda v: F.coalesce(
            F.when(v.try_cast("map<string,variant>").isNotNull(), F.array(v)),
            F.filter(v.try_cast("array<variant>"), lambda i: i.try_cast("map<string,variant>").isNotNull()),
            F.array().cast("array<variant>"))))
    return F.flatten(F.transform(nodes, below))


def references(definition: Column) -> Column:
    """Entity and property names a JSON definition refers to, from objects at any depth.

    The levels are walked inside one expression: each step gathers the names in the objects of a
    level and moves on to the objects below them. A text has no more levels than opening braces.
    """
    root = F.try_parse_json(definition)
    start = F.struct(
        F.when(root.try_cast("map<string,variant>").isNotNull(), F.array(root)).otherwise(F.array().cast("array<variant>")).alias("nodes"),
        F.array().cast("array<string>").alias("entities"), F.array().cast("array<string>").alias("properties"))

    def names(nodes: Column, path: str) -> Column:
        return F.array_compact(F.transform(nodes, lambda n: F.try_variant_get(n, path, "string")))

    def step(acc: Column, _: Column) -> Column:
        return F.struct(
            _children(acc["nodes"]).alias("nodes"),
            F.array_union(acc["entities"], names(acc["nodes"], "$.SourceRef.Entity")).alias("entities"),
            F.array_union(acc["properties"], names(acc["nodes"], "$.Property")).alias("properties"))

    levels = F.length(F.regexp_replace(F.coalesce(definition, F.lit("")), r"[^{]+", ""))
    return F.aggregate(F.sequence(F.lit(0), levels), start, step)


def visual_references(visuals: DataFrame) -> DataFrame:
    r = spread(visuals.select("visual_id", "page_id", "definition")).select("visual_id", "page_id", references(F.col("definition")).alias("_r"))
    return r.select("visual_id", "page_id", F.array_sort("_r.entities").alias("entities"),
                    F.array_sort("_r.properties").alias("properties"))


def reference_lineage(visuals: DataFrame) -> DataFrame:
    """Which visual uses which entity, with the properties that visual uses."""
    return visual_references(visuals).select(
        F.explode_outer("entities").alias("entity"), "visual_id", "page_id",
        F.array_join("properties", ",").alias("properties")).filter("entity IS NOT NULL")


def lineage_counts(visuals: DataFrame) -> DataFrame:
    """Visuals per page and distinct entities used there."""
    lineage = reference_lineage(visuals).groupBy("page_id").agg(F.countDistinct("entity").alias("entities"))
    counts = visuals.groupBy("page_id").agg(F.countDistinct("visual_id").alias("visuals"))
    return counts.join(lineage, "page_id", "left").fillna(0, ["entities"])


def visual_catalog(visuals: DataFrame) -> DataFrame:
    """Type, title, report and page of every visual; the last two stand in its file's path. Words for what is not there."""
    doc = F.try_parse_json("definition")

    def told(path: str) -> Column:
        return F.try_variant_get(doc, path, "string")

    def part(pattern: str) -> Column:
        return F.coalesce(F.nullif(F.regexp_extract("path", pattern, 1), F.lit("")), F.lit("unknown"))

    title = F.trim(told("$.visual.visualContainerObjects.title[0].properties.text.expr.Literal.Value"), F.lit("'"))
    return spread(visuals.select("visual_id", "path", "definition")).select(
        "visual_id", F.coalesce(told("$.visual.visualType"), F.lit("unknown")).alias("visual_type"), F.coalesce(title, F.lit("Untitled")).alias("title"),
        part("([^/]+)__Report/").alias("report"), part("/pages/([^/]+)/").alias("page"))


def table_usage(visuals: DataFrame) -> DataFrame:
    """Which visual of which report uses which entity, with its type, title and properties."""
    used = reference_lineage(visuals).select("entity", "visual_id", "properties")
    return used.join(visual_catalog(visuals), "visual_id").select("entity", "report", "visual_id", "page", "visual_type", "title", "properties")


def report_lineage(visuals: DataFrame) -> DataFrame:
    """Visuals and entities of every page of a report and, with page null, of the whole report."""
    used = visual_catalog(visuals).join(reference_lineage(visuals).select("visual_id", "entity"), "visual_id", "left")
    return used.groupingSets([["report", "page"], ["report"]], "report", "page").agg(
        F.countDistinct("visual_id").alias("visuals"), F.countDistinct("entity").alias("entities"))
