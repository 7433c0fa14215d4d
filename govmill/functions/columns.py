"""Column expressions for normalising, parsing and branching. All native, no Python UDF."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, functions as F

from govmill.functions import fixed_values as V


def ladder(*steps: tuple[Column, Column], otherwise: Column | None = None) -> Column:
    """First step whose condition holds gives the value; ``otherwise`` when none does."""
    chain = F
    for condition, value in steps:
        chain = chain.when(condition, value)
    return chain.otherwise(F.lit(None) if otherwise is None else otherwise)


def verdict(band: tuple, *names: str) -> Column:
    """A band of fixed values as one struct column."""
    return F.struct(*(F.lit(v).alias(n) for n, v in zip(names, band)))


def is_true(c: Column) -> Column:
    """Null counts as false."""
    return F.coalesce(c, F.lit(False))


def clean(c: Column) -> Column:
    """Trimmed text; blank becomes null."""
    return F.nullif(F.trim(c), F.lit(""))


def normalise_code(c: Column) -> Column:
    """Trimmed, lower-case text; blank becomes null."""
    return F.nullif(F.lower(F.trim(c)), F.lit(""))


def normalise_id(c: Column) -> Column:
    return F.lower(F.trim(c))


def display_region(c: Column) -> Column:
    return F.coalesce(clean(c), F.lit(V.UNASSIGNED_REGION))


def is_guid(c: Column, pattern: str = V.GUID_PATTERN) -> Column:
    return is_true(F.trim(c).rlike(pattern))


def parse_bool(c: Column) -> Column:
    """Yes and no spellings; anything else is null."""
    word = normalise_code(c.cast("string"))
    return ladder((word.isin(*V.YES_WORDS), F.lit(True)), (word.isin(*V.NO_WORDS), F.lit(False)),
                  otherwise=F.lit(None).cast("boolean"))


def parse_bool_strict(c: Column) -> Column:
    """Only a yes spelling is true; everything else, null included, is false."""
    return is_true(normalise_code(c.cast("string")).isin(*V.YES_WORDS))


def parse_bool_request(c: Column, default: bool) -> Column:
    """Request flags also accept t and f, and fall back to ``default``."""
    word = normalise_code(c.cast("string"))
    return ladder((word.isin(*V.REQUEST_YES_WORDS), F.lit(True)),
                  (word.isin(*V.REQUEST_NO_WORDS), F.lit(False)), otherwise=F.lit(default))


def contains_any(text: Column, words: tuple[str, ...]) -> Column:
    return reduce(or_, (text.contains(w) for w in words))


def resource_name(resource_id: Column) -> Column:
    """Last path segment."""
    return F.element_at(F.split(resource_id, "/"), -1)


def subscription_of(resource_id: Column) -> Column:
    """Segment after ``/subscriptions/``, lower case; null when there is none."""
    return normalise_code(F.regexp_extract(resource_id, r"(?i)/subscriptions/([^/]+)", 1))


def bucket_of_arn(arn: Column) -> Column:
    return F.nullif(F.regexp_extract(F.trim(arn), V.S3_ARN_PATTERN, 1), F.lit(""))


def bucket_region(location: Column) -> Column:
    """Storage reports its first region as null, blank or US."""
    text = clean(location)
    return F.when(text.isNull() | (F.upper(text) == "US"), V.DEFAULT_BUCKET_REGION).otherwise(text)


def tag_value(tags: Column, names: tuple[str, ...]) -> Column:
    """First tag among spelling variants that is not blank, in lower case."""
    def filled(name: str) -> Column:
        value = F.try_element_at(tags, F.lit(name))
        return F.when(F.trim(value) != "", value)

    return F.lower(F.coalesce(*map(filled, names)))


def assessment_id(resource_id: Column) -> Column:
    base = clean(resource_id)
    return F.concat(F.regexp_replace(base, "/+$", ""), F.lit(V.PATCH_SUFFIX))


def single_value(c: Column) -> Column:
    """False for null and for comma lists."""
    return is_true(F.instr(c, ",") == 0)


def resource_kind(resource_type: Column) -> Column:
    kind = normalise_id(resource_type)
    return ladder(*((kind == t, F.lit(name)) for t, name in V.RESOURCE_KINDS.items()))


def is_compute(resource_type: Column) -> Column:
    return is_true(normalise_id(resource_type).isin(*V.RESOURCE_KINDS))


def defender_candidate_plans(resource_type: Column) -> Column:
    """Protection plans that would cover a resource type; empty when none can."""
    kind = F.coalesce(normalise_id(resource_type), F.lit(""))

    def plans(*names: str) -> Column:
        return F.array(*(F.lit(n) for n in names))

    none = F.array().cast("array<string>")
    return ladder(
        (reduce(or_, (kind.startswith(p) for p in V.NO_PLAN_PREFIXES)), none),
        (kind == V.VM_TYPE, plans("virtualmachines", "sqlservervirtualmachines")),
        (kind == V.ARC_TYPE, plans("virtualmachines")),
        (kind.startswith(V.SQL_PREFIX), plans("sqlservers", "sqlservervirtualmachines")),
        (kind == V.STORAGE_TYPE, plans("storageaccounts")),
        otherwise=none,
    )


def joined(values: Column) -> Column:
    """Sorted, comma-joined text of an array; empty text for an empty or null array."""
    return F.coalesce(F.array_join(F.array_sort(values), ","), F.lit(""))


# Possessive, so that a string of any length costs no stack.
_TOKEN = r'("(?:[^"\\]++|\\.)*+"\s*+:?|-?\d++(?:\.\d++)?(?:[eE][+-]?\d++)?|\btrue\b)'
_QUOTINGS = 31  # Each quoting of a document doubles its backslashes, so no text of up to 2^31 bytes holds more.


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def sum_nested_counts(text: Column) -> Column:
    """Sum the whole-number leaves of JSON of any depth, as a bigint.

    Works on the scalar tokens of a document, so nesting needs no recursion: keys end with a colon and count nothing, ``true``
    counts one and fractions are cut. A string counts as what its trimmed text is as JSON: a number, a truth value, or a document,
    which is opened in the next round, until no quoted document is left; most texts need one round. Null, blank and plain words
    give null; an empty container gives zero.
    """
    def open_docs(docs: Column, total: Column) -> Column:
        found = F.flatten(F.transform(docs, lambda d: F.transform(F.regexp_extract_all(d, F.lit(_TOKEN), F.lit(1)), _token)))
        return bind(found, lambda f: F.struct(
            F.aggregate(f, total, lambda acc, v: acc + F.coalesce(v["n"], F.lit(0).cast("bigint"))).alias("total"),
            F.transform(F.filter(f, lambda v: v["doc"].isNotNull()), lambda v: v["doc"]).alias("docs")))

    def further(first: Column) -> Column:
        rounds = F.sequence(F.lit(2), F.lit(_QUOTINGS))
        step = F.aggregate(rounds, first, lambda state, _: F.when(F.size(state["docs"]) == 0, state).otherwise(
            open_docs(state["docs"], state["total"])), lambda state: state["total"])
        return F.when(F.size(first["docs"]) == 0, first["total"]).otherwise(step)

    def whole(top: Column) -> Column:
        return F.when(top["doc"].isNotNull(), bind(open_docs(F.array(top["doc"]), F.lit(0).cast("bigint")), further)).otherwise(top["n"])

    return bind(F.trim(text), lambda s: bind(_content(s), whole))


def _counted(n: Column | None = None, doc: Column | None = None) -> Column:
    null = F.lit(None)
    return F.struct((null if n is None else n).cast("bigint").alias("n"), (null if doc is None else doc).cast("string").alias("doc"))


def _whole(number: Column) -> Column:
    return F.coalesce(number.try_cast("bigint"), number.try_cast("double").try_cast("bigint"))


def _content(s: Column) -> Column:
    """What the trimmed text of a string counts: a number, or a document to open; both null for words."""
    def judged(parsed: Column) -> Column:
        return ladder(
            (parsed.isNull(), _counted()),
            (s.rlike(r"^[\[{]"), _counted(doc=s)),
            (s.rlike("^-?[0-9]"), _counted(_whole(s))),
            (s.isin("true", "false"), _counted((s == "true").cast("bigint"))),
            (s.startswith('"'), bind(F.trim(F.try_variant_get(parsed, "$", "string")), lambda inner: F.when(
                inner.rlike(r"^-?[0-9]+$"), _counted(_whole(inner))).otherwise(_counted()))),
            otherwise=_counted())

    # Only texts that begin like JSON are parsed.
    return ladder((s.rlike(r"^-?[0-9]+$"), _counted(_whole(s))),
                  (s.rlike(r'^[-0-9\[{"tf]'), bind(F.try_parse_json(s), judged)), otherwise=_counted())


def _token(token: Column) -> Column:
    return ladder(
        (token.endswith(":") | token.rlike(r'^" *+[^-0-9\[{tf\\" ]'), _counted()),
        (token == "true", _counted(F.lit(1))),
        (token.startswith('"'), bind(F.trim(F.try_variant_get(F.try_parse_json(token), "$", "string")), _content)),
        otherwise=_counted(_whole(token)))
