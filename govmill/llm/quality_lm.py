"""Quality by perplexity: an interpolated modified Kneser-Ney character model of trusted text.

Counting. Tasks count the 5-character pieces of their trusted texts (digits become 0) and the counts are summed by
piece over all shards. Lower orders count the different left neighbours of a piece. Three discounts per order come from the counts
of counts. Each order joins its pieces with the totals of their contexts and with the probabilities of their suffixes,
all hash-sharded joins of count tables; what comes out is one table of pieces with log-probability and back-off weight.

Scoring. If the table has at most MODEL_ROWS rows (the size is checked; characters make it grow slowly), every task gets it and
documents are read in place. Beyond that, the pieces of the documents are joined with the shards of the table. Both give
the same perplexities. The score of a document is its mean negative log-probability per character, drawn to the mean of its
language by PRIOR characters, so that a text of a few words is not judged by chance.

Threshold. Per language, from quantiles of trusted documents that were not counted (one text in FOLDS): upper quartile plus FENCE times the spread of the quartiles. A language with
fewer than ENOUGH such documents, or none (null), takes the quantiles of all of them.

Defined results: null and empty texts have the mean score of their language and are kept; texts are read whole; repeated rows
are scored each; without any trusted text everything is kept with a null score.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from govmill.llm import ragged, words
from govmill.llm.shared import cut, give_back, small_enough, stored

ORDER = 5
PAD = "\x02"  #: stands before the first character of a text
MODEL_ROWS = 2_000_000
SLICE = 1 << 19  #: bytes of text whose pieces are hashed at a time (about 60 MB of arrays)
PRIOR = 40
FENCE = 6.0
FOLDS = 5
ENOUGH = 10
SEND_BOUND = 1_000_000  #: ids of trusted documents that may be sent to every task
HELD_GRAMS = 1_000_000  #: different pieces that a task holds before it passes their counts on


class Grams:
    """Hashes of the pieces that end at each character of some texts, for every order."""

    def __init__(self, texts: list[str | None]):
        lead = PAD * (ORDER - 1)
        joined = "".join(lead + (x or "") for x in texts)
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32).copy()
        points[(points >= 48) & (points < 58)] = 48
        points[points == 0] = 32
        self.points = points
        length = np.fromiter((len(x or "") for x in texts), np.int64, len(texts))
        end = np.cumsum(length + ORDER - 1)
        start = end - length
        #: Places of the characters that are scored, and the range of each text in them.
        self.place = np.arange(length.sum()) + np.repeat(start - (np.cumsum(length) - length), length)
        self.bound = np.concatenate([[0], np.cumsum(length)])
        self.hashes = gram_hashes(points)

    def strings(self, place: np.ndarray) -> list[str]:
        """The longest pieces that end at the places."""
        return gram_strings(self.points[place[:, None] + np.arange(1 - ORDER, 1)])


def gram_strings(points: np.ndarray) -> list[str]:
    return np.ascontiguousarray(points, np.uint32).view(f"<U{points.shape[1]}").ravel().tolist()


def gram_hashes(points: np.ndarray) -> list[np.ndarray]:
    """Element k: hashes of the k characters that end at each place (places without so many wrap around and are not used)."""
    out, total = [np.zeros(len(points), np.uint64)], np.zeros(len(points), np.uint64)
    codes, kinds = pd.factorize(points)
    for k in range(ORDER):
        value = ragged.mixed(kinds.astype(np.uint64) * np.uint64(8) + np.uint64(k))[codes]
        total = total + np.roll(value, k)
        out.append(total)
    return out


def gram_counts(trusted: DataFrame) -> DataFrame:
    """(gram, c) of the longest pieces of the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, int] = {}

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["gram", "c"])

        for batch in batches:
            for part in words.slices(batch, "text", SLICE):
                grams = Grams(part.column("text").to_pylist())
                _, first, code = ragged.distinct(grams.hashes[ORDER][grams.place])
                for gram, n in zip(grams.strings(grams.place[first]), np.bincount(code, minlength=len(first)).tolist(), strict=True):
                    held[gram] = held.get(gram, 0) + n
                if len(held) > HELD_GRAMS:
                    yield out()
                    held.clear()
        if held:
            yield out()

    return trusted.select("text").mapInArrow(run, "gram string, c bigint").groupBy("gram").agg(F.sum("c").alias("c"))


def _discounts(counts: DataFrame) -> list[float]:
    """The three discounts of modified Kneser-Ney from counts of counts; plain values where a count is missing."""
    n = counts.agg(*[F.count(F.when(F.col("c") == k, 1)).alias(f"n{k}") for k in (1, 2, 3, 4)]).first()
    if not all(n[f"n{k}"] for k in (1, 2, 3, 4)):
        return [0.5, 0.75, 0.9]
    y = n["n1"] / (n["n1"] + 2 * n["n2"])
    return [min(max(k - (k + 1) * y * n[f"n{k + 1}"] / n[f"n{k}"], 0.05), k - 0.05) for k in (1, 2, 3)]


def model(trusted: DataFrame) -> DataFrame:
    """(gram, logp, backoff): of every piece of 1 to 5 characters its log-probability after the characters before its last, and
    the log back-off weight of a piece as a context. The empty piece carries the back-off to unknown characters."""
    counts = {ORDER: stored(gram_counts(trusted))}
    for k in range(ORDER - 1, 0, -1):
        counts[k] = counts[k + 1].groupBy(F.substring("gram", 2, k).alias("gram")).agg(F.count("*").alias("c"))
        counts[k] = stored(counts[k])
    lower = None
    tables = []
    for k in range(1, ORDER + 1):
        d = _discounts(counts[k])
        off = F.when(F.col("c") == 1, d[0]).when(F.col("c") == 2, d[1]).otherwise(d[2])
        split = counts[k].select("gram", F.substring("gram", 1, k - 1).alias("context"), (F.col("c") - off).alias("rest"), off.alias("off"), "c")
        context = split.groupBy("context").agg(F.sum("c").alias("total"), F.sum("off").alias("freed"))
        if k == 1:
            kinds = counts[1].count() + 1
            lower = None
            below: Column = F.lit(1.0 / kinds)
            joined = split.crossJoin(F.broadcast(context.drop("context")))  # one row: the empty context
        else:
            joined = (split.join(context, "context").withColumn("suffix", F.substring("gram", 2, k - 1))
                      .join(lower.select(F.col("gram").alias("suffix"), F.col("p").alias("below")), "suffix"))
            below = F.col("below")
        p = joined.select("gram", (F.col("rest") / F.col("total") + F.col("freed") / F.col("total") * below).alias("p"))
        lower = stored(p)
        weight = F.log(F.col("freed") / F.col("total"))
        if k == 1:
            weight = weight - math.log(kinds)  # the empty context leads to the even distribution
        tables += [lower.select("gram", F.log("p").alias("logp"), F.lit(None).cast("double").alias("backoff")),
                   context.select(F.col("context").alias("gram"), F.lit(None).cast("double").alias("logp"), weight.alias("backoff"))]
    return stored(reduce(DataFrame.unionByName, tables).groupBy("gram").agg(F.max("logp").alias("logp"), F.max("backoff").alias("backoff")))


class Table:
    """The model as sorted hashes with log-probability and back-off weight, by length of the piece."""

    def __init__(self, grams: list[str], logp: np.ndarray, backoff: np.ndarray):
        size = np.fromiter(map(len, grams), np.int64, len(grams))
        self.levels = []
        for k in range(ORDER + 1):
            at = np.flatnonzero(size == k)
            if k == 0:
                self.unknown = float(backoff[at[0]]) if len(at) else math.log(1e-6)
                self.levels.append(None)
                continue
            text = "".join(grams[i] for i in at.tolist())
            points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
            key = gram_hashes(points)[k][k - 1:: k]
            order = np.argsort(key)
            self.levels.append((key[order], logp[at][order].astype(np.float32), np.nan_to_num(backoff[at][order]).astype(np.float32)))

    def find(self, k: int, key: np.ndarray) -> np.ndarray:
        keys = self.levels[k][0]
        if not len(keys):
            return np.full(len(key), -1)
        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        return np.where(keys[at] == key, at, -1)

    def log_probability(self, grams: Grams, place: np.ndarray) -> np.ndarray:
        """Of the character at each place after the ones before it."""
        out, open_ = np.zeros(len(place)), np.arange(len(place))
        for k in range(ORDER, 0, -1):
            at = self.find(k, grams.hashes[k][place[open_]])
            logp = np.where(at >= 0, self.levels[k][1][at], np.nan) if len(self.levels[k][1]) else np.full(len(at), np.nan)
            hit = ~np.isnan(logp)
            out[open_[hit]] += logp[hit]
            open_ = open_[~hit]
            if not len(open_):
                break
            if k > 1:
                context = self.find(k - 1, grams.hashes[k - 1][place[open_] - 1])
                out[open_] += np.where(context >= 0, self.levels[k - 1][2][context], 0.0)
            else:
                out[open_] += self.unknown
        return out

    def text_costs(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Negative log-probability and number of characters of each text."""
        grams = Grams(texts)
        if not len(grams.place):
            return np.zeros(len(texts)), np.zeros(len(texts), np.int64)
        _, first, code = ragged.distinct(grams.hashes[ORDER][grams.place])
        value = self.log_probability(grams, grams.place[first])
        total = np.concatenate([[0.0], np.cumsum(value[code])])
        return total[grams.bound[:-1]] - total[grams.bound[1:]], np.diff(grams.bound)


def table_of(m: DataFrame) -> Table:
    got = m.toArrow()
    nan = lambda c: np.array(got.column(c).to_numpy(), np.float64)
    return Table(got.column("gram").to_pylist(), nan("logp"), nan("backoff"))


def costs(docs: DataFrame, m: DataFrame, rows: int = MODEL_ROWS) -> DataFrame:
    """Cost (negative log-probability) and n (characters) of a column `text`, in its place."""
    if small_enough(m, rows):
        sent = docs.sparkSession.sparkContext.broadcast(table_of(m))
        kept = docs.drop("text")
        names = kept.columns
        kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in words.slices(batch, "text", SLICE):
                    cost, n = sent.value.text_costs(part.column("text").to_pylist())
                    yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), pa.array(cost), pa.array(n)],
                                                     names=[*names, "cost", "n"])

        return docs.mapInArrow(run, f"{kinds}, cost double, n bigint")
    return _sharded_costs(docs, m)


def _sharded_costs(docs: DataFrame, m: DataFrame) -> DataFrame:
    """The same by joins with the shards of the model: pieces of each document, then each piece down its suffixes."""
    keyed = cut(docs.withColumn("row", F.monotonically_increasing_id()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.slices(batch, "text", SLICE):
                grams = Grams(part.column("text").to_pylist())
                owner = np.repeat(np.arange(part.num_rows), np.diff(grams.bound)).astype(np.uint64)
                _, first, code = ragged.distinct(grams.hashes[ORDER][grams.place] ^ ragged.mixed(owner))
                yield pa.RecordBatch.from_arrays(
                    [part.column("row").take(pa.array(owner[first].astype(np.int64))), pa.array(grams.strings(grams.place[first]), pa.string()),
                     pa.array(np.bincount(code, minlength=len(first)), pa.int64())], names=["row", "gram", "times"])

    pieces = cut(keyed.select("row", "text").mapInArrow(run, "row bigint, gram string, times bigint"))
    known = pieces.select("gram").distinct().withColumn("logp", F.lit(None).cast("double")).withColumn("back", F.lit(0.0))
    unknown = F.lit(m.where("gram = ''").first()["backoff"])
    for k in range(ORDER, 0, -1):
        tail, head = F.substring("gram", ORDER - k + 1, k), F.substring("gram", ORDER - k + 1, k - 1)
        hit = m.select(F.col("gram").alias("tail"), F.col("logp").alias("found"))
        miss = m.select(F.col("gram").alias("head"), F.col("backoff").alias("weight"))
        known = (known.withColumn("tail", tail).withColumn("head", head).join(hit, "tail", "left").join(miss, "head", "left")
                 .select("gram", F.coalesce("logp", F.col("found") + F.col("back")).alias("logp"),
                         (F.col("back") + F.coalesce(F.when(F.col("head") != "", F.col("weight")), F.lit(0.0))).alias("back")))
    value = known.select("gram", F.coalesce("logp", F.col("back") + unknown).alias("logp"))
    sums = pieces.join(value, "gram").groupBy("row").agg((-F.sum(F.col("times") * F.col("logp"))).alias("cost"), F.sum("times").alias("n"))
    return (keyed.drop("text").join(sums, "row", "left").drop("row")
            .withColumn("cost", F.coalesce("cost", F.lit(0.0))).withColumn("n", F.coalesce("n", F.lit(0).cast("bigint"))))


def language(lang: str) -> Column:
    return F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit(""))


class Judge:
    """A fitted model with the limits of each language."""

    def __init__(self, trusted: DataFrame, rows: int = MODEL_ROWS):
        """trusted: columns text and lang."""
        fold = F.pmod(F.xxhash64("text"), F.lit(FOLDS))
        self.rows, self.model = rows, model(trusted.where(fold > 0))
        rated = cut(costs(trusted.where(fold == 0).select("text", "lang"), self.model, rows).where("n > 0"))
        score = F.col("cost") / F.col("n")
        facts = [F.count("*").alias("docs"), (F.sum("cost") / F.sum("n")).alias("mean"),
                 F.percentile_approx(score, [0.25, 0.75], 10_000).alias("q")]
        self.all = rated.agg(*facts).first()
        self.languages = {r["lang"]: r for r in rated.groupBy("lang").agg(*facts).where(f"docs >= {ENOUGH}").collect()}

    @staticmethod
    def numbers(row) -> tuple[float, float]:
        """Mean cost per character and limit of a language."""
        return float(row["mean"]), float(row["q"][1] + FENCE * (row["q"][1] - row["q"][0]))

    def _per_language(self, value) -> Column:
        out = F.lit(value(self.all))
        for lang, row in self.languages.items():
            out = F.when(F.col("lang") == lang, F.lit(value(row))).otherwise(out)
        return out

    def rate(self, docs: DataFrame) -> DataFrame:
        """perplexity, score, limit and keep in the place of text, for rows with text and lang (as language() gives it)."""
        if not self.all["docs"]:
            none = F.lit(None).cast("double")
            return docs.drop("text").select("*", none.alias("perplexity"), none.alias("score"), none.alias("limit"), F.lit(True).alias("keep"))
        mean = self._per_language(lambda r: self.numbers(r)[0])
        limit = self._per_language(lambda r: self.numbers(r)[1])
        out = costs(docs, self.model, self.rows).withColumn("score", (F.col("cost") + PRIOR * mean) / (F.col("n") + PRIOR))
        out = out.withColumn("limit", limit).withColumn("keep", F.col("score") <= F.col("limit"))
        return out.withColumn("perplexity", F.exp(F.col("cost") / F.greatest("n", F.lit(1)))).drop("cost", "n")


def trusted_texts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Text and language of the documents that are labelled as good."""
    good = labels.where("quality = 1").select(F.col(id_col).alias("id")).distinct()
    if small_enough(good, SEND_BOUND):
        good = F.broadcast(good)
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"), language(lang_col).alias("lang"))
    return rows.join(good, "id", "left_semi").drop("id")


def judged(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per document: id, lang, perplexity, score, limit, keep."""
    rows = docs.select(F.col(f"`{id_col}`").alias(id_col), language(lang_col).alias("lang"), F.col(f"`{text_col}`").alias("text"))
    return Judge(trusted_texts(docs, labels, id_col, text_col, lang_col)).rate(rows)


def kept(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The documents that stay, with all their columns."""
    judge = Judge(trusted_texts(docs, labels, id_col, text_col, lang_col))
    if not judge.all["docs"]:
        return docs
    if not small_enough(judge.model, judge.rows):
        rows = docs.select(F.struct("*").alias("row"), language(lang_col).alias("lang"), F.col(f"`{text_col}`").alias("text"))
        return judge.rate(rows).where("keep").select("row.*")
    # Rows are let through as they are: no second copy of the text goes to Python.
    sent = docs.sparkSession.sparkContext.broadcast((table_of(judge.model), judge.numbers(judge.all), {k: judge.numbers(r) for k, r in judge.languages.items()}))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, rest, known = sent.value
        for batch in batches:
            for part in words.slices(batch, text_col, SLICE):
                cost, n = table.text_costs(part.column(text_col).to_pylist())
                langs = ["" if x is None else str(x) for x in part.column(lang_col).to_pylist()]
                mean, limit = np.array([known.get(x, rest) for x in langs], float).reshape(-1, 2).T
                yield part.filter(pa.array((cost + PRIOR * mean) / (n + PRIOR) <= limit))
        give_back()

    return docs.mapInArrow(run, docs.schema)
