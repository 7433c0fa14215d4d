"""Toxicity by two class-conditional Kneser-Ney models of word pieces with shared backoff counts.

Counts are those of Kneser-Ney: a word counts once for each different word that it follows in a class, so copies and
repetitions of a text add nothing. The counts of words go to their pieces of ORDER characters. The model of a class
discounts what the class has seen of a piece and spreads what that frees, with PSEUDO counts more, by the shared model of
both classes, which in turn backs off to the pieces of one character less. A piece that neither class has seen says nothing.

The log-likelihood ratio of a word is the sum over its pieces. The ratio of a document is the mean over its most toxic words:
SHARE of all its words, repetitions counted, at least FEWEST. So it does not grow with the length of a text, a text with one odd word
is not toxic yet, and ordinary words do not drown toxic ones. It becomes a probability by a logistic curve, fitted on labelled
documents by counts that leave them out (one half rated by the other), both classes weighing the same.

All labelled rows that are not held out are counted, at any size; only the curve, which has two numbers, is fitted on a sample of them
(about SAMPLE, by a hash of the id). Scoring reads every whole text in place. The table of pieces is sent to the tasks if it has at most
TABLE_ROWS rows (checked); beyond that, the words of documents are joined with it.

Defined results: a null or empty text, or one without a word, has the score of a ratio of 0. Repeated rows are each scored. A row
without id is scored and counts as not held out, but is never learned from. Label, language, source and id are not inputs.
Without labelled rows of both classes every score is 0.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from govmill.llm import ragged, words
from govmill.llm.shared import cut, small_enough

SAMPLE = 20_000  #: labelled rows that the curve is fitted on
TABLE_ROWS = 6_000_000  #: 16 bytes each
SEND_BOUND = 1_000_000  #: labelled ids that may be sent to every task
ORDER = 8  #: characters, of which the first of a word is BEFORE: a stem of seven letters
SHARE, FEWEST = 0.02, 2
DISCOUNT = 0.75
PSEUDO = 0.5
TOXIC = 0.7
#: Bits of a word's key that tell the places of the next word apart: of a million different words before one, about 0.002 pairs are taken for one.
KEPT = np.uint64((1 << 48) - 1)
#: Bytes that stand before and after a word; they occur in no word.
BEFORE, AFTER = 1, 2


def fold(id_col: str) -> Column:
    """crc32 of the id as text, modulo 3; remainder 1 is held out."""
    return F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % 3


def word_pieces(flat: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Pieces of ORDER characters of each word flat[start:end] as ranges of bytes: the bytes, starts, ends, and bounds of the words."""
    body, offset = ragged.gather(flat, start, end)
    size = np.diff(offset)
    first = offset[:-1] + np.arange(len(size)) * ORDER
    padded = np.full(offset[-1] + len(size) * ORDER, BEFORE, np.uint8)
    padded[np.arange(len(body)) + np.repeat(first + ORDER - 1 - offset[:-1], size)] = body
    last = first + ORDER - 1 + size
    padded[last] = AFTER
    begins = (padded & 0xC0) != 0x80
    lead = np.append(np.flatnonzero(begins), len(padded))
    nth = np.cumsum(begins) - 1
    count = nth[last] - nth[first] - ORDER + 2
    bound = np.concatenate([[0], np.cumsum(count)])
    at = np.arange(bound[-1]) + np.repeat(nth[first] + ORDER - 1 - bound[:-1], count)
    return padded, lead[at - ORDER + 1], lead[at + 1], bound


def piece_keys(flat: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the pieces of each word, one word after another, and their bounds."""
    padded, first, last, bound = word_pieces(flat, start, end)
    return ragged.piece_keys(padded, first, last).view(np.int64), bound


def top_means(ratio: np.ndarray, bound: np.ndarray) -> np.ndarray:
    """Mean of the largest SHARE of ratio[bound[i]:bound[i + 1]], at least FEWEST (a missing one is 0), for every i."""
    size = np.diff(bound)
    row = np.repeat(np.arange(len(size)), size)
    best = np.lexsort((-ratio, row))
    taken = np.maximum(FEWEST, np.ceil(SHARE * size))
    among = np.arange(len(ratio)) - bound[row] < taken[row]
    return np.bincount(row[among], ratio[best][among], len(size)) / taken


class Words:
    """The lower-cased words of the rows of a column."""

    def __init__(self, column: pa.Array):
        self.flat, offset = words.column_bytes(pa.compute.utf8_lower(column))
        inside = np.zeros(len(self.flat) + 2, bool)
        inside[1:-1] = words._WORD[self.flat]
        begins, ends = inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]
        first = offset[:-1][offset[1:] > offset[:-1]]
        begins[first] = inside[1:-1][first]
        ends[first[first > 0] - 1] = inside[1:-1][first[first > 0] - 1]
        self.start, self.end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        self.bound = np.searchsorted(self.start, offset)
        self.key = ragged.piece_keys(self.flat, self.start, self.end)

    def strings(self, which: np.ndarray) -> pa.Array:
        data = self.flat.tobytes()
        return pa.array([data[a:b] for a, b in zip(self.start[which].tolist(), self.end[which].tolist(), strict=True)], pa.binary())


def word_counts(rows: DataFrame) -> DataFrame:
    """(word, n0, n1): in how many different places (words before it) a word stands in ordinary and in toxic texts.

    Rows with a column `half` (0 or 1) also give these counts within each half, as n0_0, n1_0, n0_1 and n1_1, from the same exchange.
    """
    halves = "half" in rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.slices(batch, "text"):
                got = Words(part.column("text"))
                toxic, half = (np.repeat(part.column(c).to_numpy(), np.diff(got.bound)).astype(np.uint64) for c in ("toxic", "half"))
                before = np.concatenate([[0], got.key[:-1]]).astype(np.uint64) if len(got.key) else got.key
                before[got.bound[:-1][np.diff(got.bound) > 0]] = 0
                _, first, _ = ragged.distinct(ragged.mixed(before) + got.key * np.uint64(5) + toxic + half * np.uint64(2))
                yield pa.RecordBatch.from_arrays(
                    [pa.array((before[first] & KEPT).view(np.int64)), got.strings(first),
                     pa.array((np.uint64(1) << (toxic[first] * np.uint64(2) + half[first])).astype(np.int64))], names=["before", "word", "seen"])

    found = rows.select("text", "toxic", F.col("half").cast("bigint").alias("half") if halves else F.lit(0).cast("bigint").alias("half"))
    # One row per place, whatever classes and halves have it: bits 0 and 1 are the halves of ordinary texts, 2 and 3 those of toxic ones.
    places = found.mapInArrow(run, "before bigint, word binary, seen bigint").groupBy("before", "word").agg(F.bit_or("seen").alias("seen"))
    count = lambda toxic, halves: F.count_if(F.col("seen").bitwiseAND(halves << 2 * toxic) > 0)
    each = [count(t, 1 << h).alias(f"n{t}_{h}") for h in (0, 1) for t in (0, 1)] if halves else []
    return places.groupBy("word").agg(count(0, 3).alias("n0"), count(1, 3).alias("n1"), *each)


def piece_counts(counts: DataFrame) -> DataFrame:
    """Counts of words as counts of their pieces."""
    names = [c for c in counts.columns if c != "word"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, offset = words.column_bytes(batch.column("word"))
            padded, first, last, bound = word_pieces(flat, offset[:-1], offset[1:])
            data, cuts = ragged.gather(padded, first, last)
            piece = pa.Array.from_buffers(pa.large_utf8(), len(first), [None, pa.py_buffer(cuts), pa.py_buffer(data)]).cast(pa.string())
            size = np.diff(bound)
            yield pa.RecordBatch.from_arrays([piece, *(pa.array(np.repeat(batch.column(c).to_numpy(), size)) for c in names)], names=["piece", *names])

    return counts.mapInArrow(run, "piece string" + "".join(f", {c} bigint" for c in names)).groupBy("piece").agg(*[F.sum(c).alias(c) for c in names])


def piece_ratios(counts: DataFrame) -> DataFrame:
    """(piece, ratio) from counts of words."""
    return ratios_of(cut(piece_counts(counts)), [""])


def ratios_of(counted: DataFrame, parts: list[str]) -> DataFrame:
    """piece, and for each part the ratio: log of toxic over ordinary probability of the piece after its characters but the last.

    A part names the columns that hold its counts; a piece that it has not seen has a null. All sums are over pieces with the same six
    characters in the middle, so one exchange does for all of them; such a group has at most the square of the alphabet.
    """

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, offset = words.column_bytes(batch.column("piece"))
            key = ragged.piece_keys(flat, offset[:-1], offset[1:]).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(key), *batch.columns[1:]], names=batch.schema.names)

    table = counted.withColumns({"middle": F.substring("piece", 2, ORDER - 2), "context": F.substring("piece", 1, ORDER - 1),
                                 "suffix": F.substring("piece", 2, ORDER - 1)})
    middle, context, suffix = (Window.partitionBy(*c) for c in (["middle"], ["middle", "context"], ["middle", "suffix"]))

    def ratio(part: str) -> Column:
        n0, n1 = F.col(f"n0{part}"), F.col(f"n1{part}")
        kinds = lambda n, over: F.count(F.when(n > 0, 1)).over(over)
        # Lower order of the shared model: how many different pieces end like this one, among those with its middle.
        below = kinds(n0 + n1, suffix) / kinds(n0 + n1, middle)
        shared = (n0 + n1 - DISCOUNT + DISCOUNT * kinds(n0 + n1, context) * below) / F.sum(n0 + n1).over(context)

        def own(n: Column) -> Column:
            freed = DISCOUNT * kinds(n, context) + PSEUDO
            return (F.greatest(n - DISCOUNT, F.lit(0.0)) + freed * shared) / (F.sum(n).over(context) + PSEUDO)

        return F.when(n0 + n1 > 0, F.log(own(n1) / own(n0)))

    names = [f"ratio{part}" for part in parts]
    return (table.select("piece", *[ratio(part).alias(name) for part, name in zip(parts, names, strict=True)])
            .mapInArrow(keyed, "piece bigint" + "".join(f", {name} double" for name in names)))


class Pieces:
    """Sorted pieces and their ratios, as tasks hold them."""

    def __init__(self, table: pa.Table):
        piece, ratio = table.column("piece").to_numpy(), table.column("ratio").to_numpy()
        order = np.argsort(piece)
        self.piece, self.ratio = piece[order], ratio[order]

    def peaks(self, column: pa.Array) -> np.ndarray:
        """The mean of the largest word ratios of each row; 0 for rows without a word."""
        got = Words(column)
        out = np.zeros(len(column))
        if len(got.key) and len(self.piece):
            _, first, code = ragged.distinct(got.key)
            piece, bound = piece_keys(got.flat, got.start[first], got.end[first])
            at = np.minimum(np.searchsorted(self.piece, piece), len(self.piece) - 1)
            value = np.where(self.piece[at] == piece, self.ratio[at], 0.0)
            out = top_means(np.add.reduceat(value, bound[:-1])[code], got.bound)
        return out


def peaks(docs: DataFrame, ratios: DataFrame, rows: int = TABLE_ROWS) -> DataFrame:
    """`peak` (the mean of the largest word ratios) in the place of a column `text`."""
    kept = docs.drop("text")
    names, kinds = kept.columns, "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept.schema.fields)
    if small_enough(ratios, rows):
        sent = docs.sparkSession.sparkContext.broadcast(Pieces(ratios.toArrow()))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in words.slices(batch, "text"):
                    yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), pa.array(sent.value.peaks(part.column("text")))],
                                                     names=[*names, "peak"])

        return docs.mapInArrow(run, f"{kinds}peak double")
    keyed = cut(docs.withColumn("row", F.monotonically_increasing_id()))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.slices(batch, "text"):
                got = Words(part.column("text"))
                row = np.repeat(part.column("row").to_numpy(), np.diff(got.bound))
                _, first, code = ragged.distinct(ragged.mixed(row) ^ got.key)
                piece, bound = piece_keys(got.flat, got.start[first], got.end[first])
                size = np.diff(bound)
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(row[first], size)), pa.array(np.repeat(got.key[first].view(np.int64), size)),
                                                  pa.array(np.repeat(np.bincount(code, minlength=len(first)), size)), pa.array(piece)],
                                                 names=["row", "word", "times", "piece"])

    by_word = (keyed.select("row", "text").mapInArrow(each, "row bigint, word bigint, times bigint, piece bigint").join(ratios, "piece", "left")
               .groupBy("row", "word").agg(F.sum(F.coalesce("ratio", F.lit(0.0))).alias("ratio"), F.max("times").alias("times")))
    row = Window.partitionBy("row")
    upto = row.orderBy(F.desc("ratio"), "word").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    taken = F.greatest(F.lit(FEWEST), F.ceil(SHARE * F.sum("times").over(row)))
    left = F.col("taken") - F.col("upto") + F.col("times")
    ranked = by_word.withColumn("taken", taken).withColumn("upto", F.sum("times").over(upto))
    best = ranked.where(left > 0).groupBy("row").agg((F.sum(F.col("ratio") * F.least("times", left)) / F.max("taken")).alias("peak"))
    return keyed.drop("text").join(best, "row", "left").drop("row").withColumn("peak", F.coalesce("peak", F.lit(0.0)))


def curve(rated: DataFrame) -> tuple[float, float]:
    """Slope and height of the logistic curve of (peak, toxic), fitted on counts of hundredths (a bounded table)."""
    step = F.round(F.least(F.greatest("peak", F.lit(-50.0)), F.lit(50.0)), 2)
    got = rated.groupBy(step.alias("x"), F.col("toxic").alias("y")).count().toArrow()
    x, y, n = (np.array(got.column(c).to_numpy(), float) for c in ("x", "y", "count"))
    if not len(x) or y.min() == y.max():
        return 0.0, -math.inf
    share = np.array([n[y == 0].sum(), n[y == 1].sum()])
    n = n * (share.sum() / 2 / share)[y.astype(int)]  # both classes weigh the same, however rare the toxic one is
    a, b = 1.0, -float(np.average(x, weights=n))
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        w = n * p * (1 - p)
        # A small pull to a slope of 1 keeps the fit finite where the classes do not overlap.
        grad = np.array([(n * (y - p) * x).sum() - 0.05 * (a - 1), (n * (y - p)).sum()])
        hess = np.array([[(w * x * x).sum() + 0.05, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-3]])
        move = np.clip(np.linalg.solve(hess, grad), -2, 2)
        a, b = a + move[0], b + move[1]
        if np.abs(move).max() < 1e-8:
            break
    return float(a), float(b)


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> DataFrame:
    """One row per document: id, held_out, score, predicted."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    known = (labels.select(F.col(id_col).alias("id"), F.col("toxic").cast("bigint").alias("toxic")).where("id is not null and toxic in (0, 1)")
             .where(fold("id") != 1).groupBy("id").agg(F.max("toxic").alias("toxic")))
    share = min(1.0, sample / max(1, known.count()))
    known = known.withColumn("half", F.pmod(F.hash("id"), F.lit(2)).cast("bigint"))
    if small_enough(known, SEND_BOUND):
        known = F.broadcast(known)
    learned = rows.join(known, "id")
    ratios = cut(ratios_of(cut(piece_counts(cut(word_counts(learned), True)), True), ["", "_0", "_1"]), True)
    # The curve is fitted on what was not counted: each half is rated by counts of the other.
    picked = rows.join(known.where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < math.ceil(share * 1e6)), "id")
    halves = [ratios.where(f"ratio_{h} is not null").select("piece", F.col(f"ratio_{h}").alias("ratio")) for h in (0, 1)]
    rated = [peaks(picked.where(F.col("half") != h).select("toxic", "text"), halves[h]) for h in (0, 1)]
    slope, height = curve(rated[0].unionByName(rated[1]))
    ratios = ratios.select("piece", "ratio")
    score = 1 / (1 + F.exp(-(slope * F.col("peak") + height))) if height > -math.inf else F.lit(0.0)
    out = peaks(rows, ratios).select(F.col("id").alias(id_col), F.coalesce(fold("id") == 1, F.lit(False)).alias("held_out"), score.alias("score"))
    return out.withColumn("predicted", (F.col("score") >= TOXIC).cast("int"))
