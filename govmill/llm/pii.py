"""Personal data by weak supervision: labelers vote on candidate spans, EM weighs them, a classifier decides. SQL functions only.

Base spans (email, ip, card, phone) are those of fixed patterns and checks and always count. Every pattern of numbers lies
inside one run of digits, blanks and `+().-`; so a text is cut once into such runs, and the patterns are tried on the runs.
Candidates are the base spans and narrower or disguised forms that the base patterns miss, as a number that runs into the next.

Five labelers vote yes, no or nothing on each candidate: strict form (regex), check digits and ranges, a gazetteer (top-level
domains, country codes, issuer prefixes, reserved networks), words in front (context), and what touches the span. EM over the
counts of vote patterns (at most 4 kinds x 3^5 rows, whatever the input) estimates how reliable each labeler is per
outcome, and so the probability of each pattern. A logistic classifier over votes, kind and length is trained on these
probabilities; candidates that it accepts and that overlap no base span of their kind are added.

Defined results: a null or empty text has no spans. Positions are code points, ends exclusive. Repeated rows are each
judged. Without candidates only base spans count. Whole texts are searched, whatever their length.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from govmill.llm.shared import cut

KINDS = ("email", "ip", "card", "phone")
#: Patterns of base spans in the words of this engine's regular expressions: what cannot give back is possessive, and a
#: span starts where its run of characters does or where the one before ended, which is where the leftmost match starts.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
RUN = r"(?<![+\x20().0-9-])[+\x20().-]*+[0-9][+\x20().0-9-]*+"
#: Candidates beyond the base spans.
LOOSE = {
    "phone": r"(?<![0-9+])(?:\+[0-9]{1,3}[\x20.-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[\x20.-]?[0-9]{2,4}){1,4}|\([0-9]{3}\)\x20?[0-9]{3}[\x20.-][0-9]{4}|[0-9]{3}-[0-9]{3}-[0-9]{4})(?![0-9])",
    "card": r"(?<![0-9])(?:[0-9]{4}[\x20-]?[0-9]{4}[\x20-]?[0-9]{4}[\x20-]?[0-9]{4}|3[0-9]{3}[\x20-]?[0-9]{6}[\x20-]?[0-9]{5})(?![0-9])",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9])",
}
DISGUISED = (r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}(?:\x20?[\[(]at[\])]\x20?|\x20at\x20)[A-Za-z0-9-]{1,63}"
             r"(?:(?:\x20?[\[(]dot[\])]\x20?|\x20dot\x20|\.)[A-Za-z0-9-]{2,63}){1,4}")

BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
#: Gazetteer and context words (small fixed lists).
DOMAINS = r"\.(?:com|org|net|edu|gov|io|info|biz|de|fr|es|uk|it|nl|eu|us|ca|example)$"
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65|35)"
COUNTRIES = r"^\+(?:1|7|2[07]|3[0-469]|4[0-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|21|22|23|25|35|37|38|42|85|97|99)"
RESERVED = r"^(?:0|255|22[4-9]|23[0-9]|24[0-9])\."
NEAR = {
    "email": r"(?i)(?:mail|contact|kontakt|correo|courriel|write|reach)[^A-Za-z]*(?:\w+[^A-Za-z]+){0,2}$",
    "ip": r"(?i)(?:\bip\b|address|host|server|adresse|from)[^A-Za-z]*(?:\w+[^A-Za-z]+){0,2}$",
    "card": r"(?i)(?:card|visa|credit|karte|tarjeta|carte|payment)[^A-Za-z]*(?:\w+[^A-Za-z]+){0,2}$",
    "phone": r"(?i)(?:phone|tel|call|mobile|fax|handy|telefon|llam)[^A-Za-z]*(?:\w+[^A-Za-z]+){0,2}$",
}
AGAINST = r"(?i)(?:version|isbn|issn|page|§|section|\bno\b|order|invoice|serial)[^A-Za-z]*$"
SPAN = "struct<s:int,e:int,t:string,b:string,a:string>"
FEATURES = ("form", "check", "list", "context", "edge")


def _quoted(pattern: str) -> str:
    return "r'" + pattern.replace("'", r"\x27") + "'"


def find(text: str, pattern: str) -> str:
    """SQL for the matches of a pattern in a text: start, end, the match, up to 40 characters before and 20 after it.

    The pieces between matches give the positions. They are added up in groups of 256, so that very many matches cost little
    more than few.
    """
    p = _quoted(pattern)
    step = (f"struct(x.pos + length(w.g[i - 1]) + length(w.m[i - 1]) AS pos, concat(x.spans, array(struct(x.pos + length(w.g[i - 1]) AS s, "
            "x.pos + length(w.g[i - 1]) + length(w.m[i - 1]) AS e, w.m[i - 1] AS t, right(w.g[i - 1], 40) AS b, left(w.g[i], 20) AS a))) AS spans)")
    part = (f"aggregate(sequence(k * 256 + 1, least(size(w.m), k * 256 + 256)), struct(acc.pos AS pos, cast(array() AS array<{SPAN}>) AS spans), (x, i) -> {step})")
    body = (f"flatten(aggregate(sequence(0, cast((size(w.m) - 1) / 256 AS int)), struct(0 AS pos, cast(array() AS array<array<{SPAN}>>) AS parts), "
            f"(acc, k) -> element_at(transform(array({part}), q -> struct(q.pos AS pos, concat(acc.parts, array(q.spans)) AS parts)), 1), acc -> acc.parts))")
    return (f"element_at(transform(array(struct(regexp_extract_all({text}, {p}, 0) AS m, split({text}, {p}, -1) AS g)), "
            f"w -> if(size(w.m) = 0, cast(array() AS array<{SPAN}>), {body})), 1)")


def _inside(pattern: str) -> str:
    """SQL for the matches in all runs, in positions of the text."""
    moved = ("struct(r.s + y.s AS s, r.s + y.e AS e, y.t AS t, if(y.s > 39, y.b, right(concat(r.b, left(r.t, y.s)), 40)) AS b, "
             "if(length(y.a) > 0, y.a, r.a) AS a)")
    return f"flatten(transform(runs, r -> transform({find('r.t', pattern)}, y -> {moved})))"


def digits(t: str) -> str:
    return f"regexp_replace({t}, '[^0-9]', '')"


def luhn(d: str) -> str:
    digit = f"cast(substr({d}, length({d}) - i + 1, 1) AS int)"
    return f"(aggregate(sequence(1, greatest(length({d}), 1)), 0, (z, i) -> z + if(i % 2 = 1, {digit}, {digit} * 2 - if({digit} > 4, 9, 0))) % 10 = 0)"


VALID = {
    "email": "true",
    "ip": f"v.t RLIKE r'^{BYTE}(?:[.]{BYTE}){{3}}$'",
    "card": f"(length({digits('v.t')}) BETWEEN 12 AND 19 AND if(length({digits('v.t')}) BETWEEN 12 AND 19, {luhn(digits('v.t'))}, false))",
    "phone": f"length({digits('v.t')}) BETWEEN 9 AND 15",
}
#: Votes of each kind's candidates: 1 yes, -1 no, 0 nothing.
_VOTE = {
    "email": {"form": r"v.t RLIKE r'^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+[.][A-Za-z]{2,}$'", "check": "length(v.t) BETWEEN 6 AND 254",
              "list": f"lower(v.t) RLIKE {_quoted(DOMAINS)}"},
    "ip": {"form": r"v.t RLIKE r'^[0-9]{1,3}(?:[.][0-9]{1,3}){3}$'", "check": VALID["ip"], "list": f"NOT v.t RLIKE {_quoted(RESERVED)}"},
    "card": {"form": r"v.t RLIKE r'^(?:[0-9]{13,16}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})$'", "check": VALID["card"],
             "list": f"{digits('v.t')} RLIKE {_quoted(ISSUERS)}"},
    "phone": {"form": r"v.t RLIKE r'^(?:[+][0-9]{1,3}[ .-]?)?(?:[(][0-9]{1,4}[)]|[0-9]{1,4})(?:[ .-]?[0-9]{2,4}){1,4}$'",
              "check": f"length({digits('v.t')}) BETWEEN 10 AND 15", "list": f"v.t RLIKE {_quoted(COUNTRIES)}"},
}


def _candidates(kind: str, source: str, is_base: bool) -> str:
    votes = [f"if({_VOTE[kind][f]}, 1, -1) AS {f}" for f in ("form", "check", "list")]
    votes.append(f"CASE WHEN v.b RLIKE {_quoted(NEAR[kind])} THEN 1 WHEN v.b RLIKE {_quoted(AGAINST)} THEN -1 ELSE 0 END AS context")
    votes.append(r"if(right(v.b, 1) RLIKE r'[\p{L}\p{N}]' OR left(v.a, 1) RLIKE r'[\p{L}\p{N}@]', -1, 1) AS edge")
    size = "least(3, cast(length(v.t) / 8 AS int)) AS size"
    return (f"transform({source}, v -> struct(v.s AS s, {KINDS.index(kind)} AS kind, v.e AS e, {str(is_base).lower()} AS base, {', '.join(votes)}, {size}))")


def spans(df: DataFrame, text: str) -> DataFrame:
    """Adds an array `found` of base spans and candidates, each with its votes, to rows with the column `text` (a string)."""
    empty = f"cast(array() AS array<{SPAN}>)"
    out = df.withColumn("whole", F.coalesce(F.col(text), F.lit("")))
    out = out.withColumn("runs", F.expr(find("whole", RUN)))
    plain = {"email": f"if(instr(whole, '@') > 0, {find('whole', EMAIL)}, {empty})"}
    plain |= {kind: _inside(pattern) for kind, pattern in (("ip", IP), ("card", CARD), ("phone", PHONE))}
    loose = {"email": f"if(whole RLIKE r'(?: at |[(]at[)]|\\[at\\])', {find('whole', DISGUISED)}, {empty})"}
    loose |= {kind: _inside(pattern) for kind, pattern in LOOSE.items()}
    for kind in KINDS:
        out = out.withColumn(f"base_{kind}", F.expr(f"filter({plain[kind]}, v -> {VALID[kind]})"))
        apart = f"NOT exists(base_{kind}, o -> o.s < v.e AND v.s < o.e)"
        out = out.withColumn(f"loose_{kind}", F.expr(f"filter({loose[kind]}, v -> {apart})"))
    parts = [_candidates(k, f"base_{k}", True) for k in KINDS] + [_candidates(k, f"loose_{k}", False) for k in KINDS]
    found = out.withColumn("found", F.expr(f"array_sort(concat({', '.join(parts)}))"))
    return found.drop("whole", "runs", *[f"{p}_{k}" for p in ("base", "loose") for k in KINDS])


def reliabilities(patterns: list[tuple[tuple, int]], rounds: int = 60) -> dict[tuple, float]:
    """EM over vote patterns ((kind, size, votes...), count): probability of each pattern that its span is personal data."""
    votes = range(2, 2 + len(FEATURES))
    belief = {p: min(max(0.5 + 0.12 * sum(p[2:]), 0.02), 0.98) for p, _ in patterns}
    for _ in range(rounds):
        prior, table = {}, {}
        for k in range(len(KINDS)):
            mass = [1.0, 1.0]
            for p, n in patterns:
                if p[0] == k:
                    mass[1] += n * belief[p]
                    mass[0] += n * (1 - belief[p])
            prior[k] = mass[1] / sum(mass)
        for j in votes:
            for y in (0, 1):
                mass = {-1: 1.0, 0: 1.0, 1: 1.0}
                # A start that leans to reliable labelers keeps the two outcomes from changing places.
                mass[1 if y else -1] += 2.0
                for p, n in patterns:
                    mass[p[j]] += n * (belief[p] if y else 1 - belief[p])
                total = sum(mass.values())
                for v, m in mass.items():
                    table[j, y, v] = m / total
        for p, _ in patterns:
            odds = math.log(prior[p[0]] / (1 - prior[p[0]])) + sum(math.log(table[j, 1, p[j]] / table[j, 0, p[j]]) for j in votes)
            belief[p] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
    return belief


def features(p: tuple) -> list[float]:
    kind = [1.0 if p[0] == k else 0.0 for k in range(len(KINDS))]
    size = [1.0 if p[1] == s else 0.0 for s in range(4)]
    return kind + size + [x for v in p[2:] for x in (float(v > 0), float(v < 0))]


def classifier(patterns: list[tuple[tuple, int]], belief: dict[tuple, float], rounds: int = 400) -> list[float]:
    """Weights of a logistic classifier of spans, trained on the believed labels (gradient steps on the pattern counts)."""
    rows = [(features(p), belief[p], math.log1p(n)) for p, n in patterns]
    total = sum(n for *_, n in rows) or 1.0
    weights = [0.0] * (len(KINDS) + 4 + 2 * len(FEATURES))
    for _ in range(rounds):
        grad = [1e-3 * w for w in weights]
        for x, y, n in rows:
            p = 1 / (1 + math.exp(-sum(w * f for w, f in zip(weights, x, strict=True))))
            for j, f in enumerate(x):
                grad[j] += n / total * (p - y) * f
        weights = [w - 1.5 * g for w, g in zip(weights, grad, strict=True)]
    return weights


def accepts(weights: list[float]) -> str:
    """SQL that tells whether the classifier takes span v."""
    k, terms = len(KINDS), []
    terms += [f"if(v.kind = {i}, {w!r}D, 0D)" for i, w in enumerate(weights[:k])]
    terms += [f"if(v.size = {i}, {w!r}D, 0D)" for i, w in enumerate(weights[k: k + 4])]
    for j, name in enumerate(FEATURES):
        yes, no = weights[k + 4 + 2 * j: k + 6 + 2 * j]
        terms.append(f"CASE v.{name} WHEN 1 THEN {yes!r}D WHEN -1 THEN {no!r}D ELSE 0D END")
    return f"({' + '.join(terms)}) >= 0"


def fit(found: DataFrame) -> list[float]:
    """The classifier of the spans in a column `found`."""
    columns = ["kind", "size", *FEATURES]
    # At most 4 kinds x 4 sizes x 3^5 votes: a bounded table, whatever the input.
    counts = found.select(F.explode("found").alias("v")).groupBy(*[F.col(f"v.{c}").alias(c) for c in columns]).count().collect()
    patterns = sorted((tuple(r[c] for c in columns), r["count"]) for r in counts)
    return classifier(patterns, reliabilities(patterns)) if patterns else [0.0] * (len(KINDS) + 4 + 2 * len(FEATURES))


def decided(found: DataFrame, weights: list[float]) -> DataFrame:
    """Keeps base spans and accepted candidates in `found`; of candidates of a kind that overlap, the first."""
    taken = f"filter(found, v -> v.base OR ({accepts(weights)}))"
    apart = ("aggregate({0}, cast(array() AS array<struct<s:int,kind:int,e:int,base:boolean>>), (z, v) -> "
             "if(NOT v.base AND exists(z, o -> o.kind = v.kind AND o.s < v.e AND v.s < o.e), z, "
             "concat(z, array(struct(v.s AS s, v.kind AS kind, v.e AS e, v.base AS base)))))").format(taken)
    return found.withColumn("found", F.expr(apart))


def _joined(array: str) -> Column:
    names = ", ".join(f"'{k}'" for k in KINDS)
    return F.expr(f"array_join(transform({array}, v -> concat_ws(':', element_at(array({names}), v.kind + 1), v.s, v.e)), ',')")


def report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_email, n_ip, n_card, n_phone (base spans), base (those spans as text), spans (all of them)."""
    rows = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    found = cut(spans(rows, "text").select("id", "found"))
    out = decided(found, fit(found))
    counts = [F.expr(f"cast(size(filter(found, v -> v.base AND v.kind = {i})) AS bigint)").alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return out.select(F.col("id").alias(id_col), *counts, _joined("filter(found, v -> v.base)").alias("base"), _joined("found").alias("spans"))


def redacted(df: DataFrame, text_col: str = "text", n_chars: str | None = "n_chars") -> DataFrame:
    """The documents with each span in `text_col` replaced by its kind in brackets, and their length set anew; same columns."""
    rows = df.select(F.struct("*").alias("row"), F.col(f"`{text_col}`").alias("text"))
    weights = fit(spans(rows.select("text"), "text"))
    out = decided(spans(rows, "text"), weights)
    names = ", ".join(f"'[{k.upper()}]'" for k in KINDS)
    # Spans in order; one that starts inside what is already replaced only moves its end.
    step = (f"if(v.s < z.at, struct(greatest(z.at, v.e) AS at, z.parts AS parts), struct(v.e AS at, "
            f"concat(z.parts, array(substr(text, z.at + 1, v.s - z.at), element_at(array({names}), v.kind + 1))) AS parts))")
    replaced = (f"if(text IS NULL OR size(found) = 0, text, aggregate(found, struct(0 AS at, cast(array() AS array<string>) AS parts), "
                f"(z, v) -> {step}, z -> concat(array_join(z.parts, ''), substr(text, z.at + 1))))")
    out = out.withColumn("clean", F.expr(replaced))
    columns = []
    for c in df.columns:
        if c == text_col:
            columns.append(F.col("clean").alias(c))
        elif c == n_chars:
            columns.append(F.when(F.expr("size(found) > 0"), F.length("clean").cast(df.schema[c].dataType)).otherwise(F.col(f"row.`{c}`")).alias(c))
        else:
            columns.append(F.col(f"row.`{c}`").alias(c))
    return out.select(columns)
