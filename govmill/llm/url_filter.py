"""URL filter: host and path rules, and a character language-model ratio for what no rule judges. DataFrame functions only.

Two variable-order Markov models (0 to 4 characters of context, Witten-Bell smoothing from order to order down to an even
distribution) are counted on the different URLs that rules allow and on those that rules block, but for one URL in FOLDS. The
score of a URL is the difference of its log-likelihoods, divided by its length. The limit is calibrated on the URLs that
were left out: half way between the score that KEEP of the allowed ones reach and the one that KEEP of the blocked ones stay
below. Digits count as 0; letters are lower-cased.

Counts are summed by piece over all shards; a URL that very many pages share is counted and scored once. The table of
pieces is sent to the tasks if it is small (checked), so the score of a URL needs no exchange of its pieces; otherwise
they are joined by piece.

Defined results: a null URL, or one without ://, has empty host and path and meets no rule; its text (null: empty) is scored
like any other, an empty one has score 0. Repeated rows each get a verdict. Without URLs of both kinds the score is 0 and
the verdict allow. Of rules that fit, the longest wins, the first of equally long ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from govmill.llm.shared import cut, small_enough

ORDER = 5  #: characters of a piece: four of context and one that is predicted
PAD = "\x02"
KINDS = 256.0  #: characters that the even distribution allows for
FOLDS = 5
KEEP = 0.99
TABLE_ROWS = 300_000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: str) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a column; both empty without ://."""
    text = F.coalesce(F.col(url), F.lit(""))
    at = F.instr(text, "://")
    rest = F.when(at > 0, F.substring(text, at + 3, F.length(text))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    return F.translate(host, UPPER, LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The rule that fits best, and its verdict. A rule is (verdict, host/path prefix)."""
    best, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for judged, rule in sorted(reversed(rules), key=lambda x: len(x[1])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        best, verdict = F.when(fits, F.lit(rule)).otherwise(best), F.when(fits, F.lit(judged)).otherwise(verdict)
    return best, verdict


def pieces(urls: DataFrame) -> DataFrame:
    """One row per character of each URL: the character with the four before it."""
    text = F.concat(F.lit(PAD * (ORDER - 1)), F.translate(F.lower("url"), "123456789", "0" * 9))
    places = F.sequence(F.lit(1), F.length("url"))
    return (urls.where(F.length("url") > 0).withColumn("text", text).withColumn("at", F.explode(places))
            .withColumn("piece", F.col("text").substr(F.col("at"), F.lit(ORDER))).drop("text", "at", "url"))


def piece_ratios(urls: DataFrame) -> DataFrame:
    """(piece, ratio): log of the probability among allowed URLs over that among blocked ones, for every piece there is."""
    counted = pieces(urls)
    sums = lambda df, key: df.groupBy(key.alias("piece")).agg(F.sum("a").alias("a"), F.sum("r").alias("r"))
    tables = {ORDER: cut(sums(counted, F.col("piece")))}
    for k in range(ORDER - 1, 0, -1):
        tables[k] = sums(tables[k + 1], F.substring("piece", 2, k))
    below = None
    for k in range(1, ORDER + 1):
        table = tables[k].withColumn("context", F.substring("piece", 1, k - 1))
        seen = lambda c: F.count(F.when(F.col(c) > 0, 1))
        context = table.groupBy("context").agg(F.sum("a").alias("na"), F.sum("r").alias("nr"), seen("a").alias("ta"), seen("r").alias("tr"))
        table = table.join(context, "context")
        if below is None:
            table = table.withColumn("pa", F.lit(1 / KINDS)).withColumn("pr", F.lit(1 / KINDS))
        else:
            table = table.withColumn("suffix", F.substring("piece", 2, k - 1)).join(below, "suffix")
        p = {c: F.when(F.col(f"n{c}") > 0, (F.col(c) + F.col(f"t{c}") * F.col(f"p{c}")) / (F.col(f"n{c}") + F.col(f"t{c}"))).otherwise(F.col(f"p{c}"))
             for c in "ar"}
        level = table.select("piece", p["a"].alias("pa"), p["r"].alias("pr"))
        below = level.withColumnRenamed("piece", "suffix")
    return cut(level.select("piece", F.log(F.col("pa") / F.col("pr")).alias("ratio")))


def judged(df: DataFrame, rules: list[tuple[str, str]], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per page: id, host, path, rule, score (null where a rule decides), verdict."""
    pages = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").alias("url"))
    host, path = host_and_path("url")
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    urls = pages.select(F.coalesce("url", F.lit("")).alias("url")).distinct().withColumn("host", host).withColumn("path", path)
    urls = cut(urls.withColumn("rule", rule).withColumn("verdict", verdict)
               .withColumn("left_out", F.pmod(F.xxhash64("url"), F.lit(FOLDS)) == 0))
    learns = lambda v: ((F.col("verdict") == v) & ~F.col("left_out")).cast("int")
    flags = urls.select("url", F.coalesce(learns("allow"), F.lit(0)).alias("a"), F.coalesce(learns("block"), F.lit(0)).alias("r"))
    ratios = piece_ratios(flags)
    if small_enough(ratios, TABLE_ROWS):
        ratios = F.broadcast(ratios)
    asked = urls.where("verdict is null or left_out")
    scores = (pieces(asked.select("url", F.col("url").alias("key"))).join(ratios, "piece")
              .groupBy("key").agg((F.sum("ratio") / F.count("*")).alias("score")))
    both = flags.agg(F.coalesce((F.sum("a") > 0) & (F.sum("r") > 0), F.lit(False)).alias("x")).first()["x"]
    value = F.coalesce("score", F.lit(0.0)) if both else F.lit(0.0)
    scored = cut(asked.join(scores, asked["url"] == scores["key"], "left").select("url", "verdict", value.alias("score")))
    edge = lambda v, q: F.percentile_approx(F.when(F.col("verdict") == v, F.col("score")), q, 10_000)
    edges = scored.agg(edge("allow", 1 - KEEP).alias("low"), edge("block", KEEP).alias("high")).first()
    limit = (edges["low"] + edges["high"]) / 2 if both and None not in edges else float("-inf")
    method = F.when(F.coalesce(F.col("score"), F.lit(0.0)) >= F.lit(limit), "allow").otherwise("block")
    full = urls.drop("left_out").join(scored.where("verdict is null").select(F.col("url").alias("key"), "score"), F.col("url") == F.col("key"), "left")
    full = full.withColumn("verdict", F.coalesce("verdict", method)).drop("key")
    return (pages.withColumn("url", F.coalesce("url", F.lit(""))).join(full, "url")
            .select(F.col("id").alias(id_col), "host", "path", "rule", "score", "verdict"))
