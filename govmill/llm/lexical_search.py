"""Ranked lexical search over norm buckets: impact vectors in the order of their lengths, pruned by bounds, rescored in whole numbers.

A document's vector has the impacts of the terms that it shares with the items (term weight times impact); an item's has ones at its terms,
so their product is the score. Vectors are dealt out by range of length and taken in buckets of BUCKET documents (fewer where
they have very many terms), longest first.

* An item skips a bucket whose longest vector, by Cauchy and Schwarz, can't reach the item's k-th score so far; so it does if the largest
  impacts of its terms in the bucket don't add up to it.
* Inside a bucket the item's terms are taken by their largest impact until the others together can't reach the k-th score. Only documents
  with one of those terms are looked at, and of these only the ones whose sum so far can still get there with the least of two bounds on
  the rest: the largest impacts of its terms, and the length of the document's rest.
* What is left is added up in 64-bit whole numbers.

k-th scores are shared: the longest of every block of documents (one in SEED_PART) are searched first and give every item a score to start from.

Three passes: words of the texts to rows of (document, its number of terms, item terms and their counts), stored; their sums for the
weights; search. Items are worked on in blocks of about ITEM_CHARS characters, whose words and weights are sent to every task.

Defined results: items and documents that are null, empty or have no term match nothing; such documents don't count either. Rows of one item
id are one item with the terms of all; an item with no hit gives no row. Repeated documents are documents of their own. Equal scores
go by ascending document id, those without id last. Other columns are not carried, whatever their names. Terms are compared
by 64-bit keys.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from govmill.llm.shared import cut, width
from govmill.llm.words import column_bytes, slices, windows, word_keys

BUCKET, BUCKET_TERMS = 2048, 1_000_000
SEED_PART = 32
ITEM_CHARS = 4_000_000


def item_terms(texts: list[str | None]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Sorted keys of all terms, and for every text the places of its different terms in them."""
    keys, bound = word_keys(*column_bytes(pa.array(texts, pa.string())), letters_only=True)
    terms, place = np.unique(keys, return_inverse=True)
    return terms, [np.unique(place[a:b]) for a, b in zip(bound[:-1], bound[1:], strict=True)]


def counted(column: pa.Array, known: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Terms of every row, and (row << 32 | place in `known`) with its count for those that are known; long texts go through in windows."""
    flat, offset = column_bytes(column)
    n, parts = np.zeros(len(column), np.int64), []
    for a, b in windows(flat, offset, letters_only=True):
        keys, bound = word_keys(flat[a:b], np.clip(offset, a, b) - a, letters_only=True)
        n += np.diff(bound)
        at = np.minimum(np.searchsorted(known, keys), max(0, len(known) - 1))
        hit = np.flatnonzero(known[at] == keys) if len(known) else np.zeros(0, np.int64)
        owner = np.searchsorted(bound, hit, side="right") - 1
        parts.append(np.unique(owner << 32 | at[hit], return_counts=True))
    if len(parts) == 1:
        return n, *parts[0]
    none = np.zeros(0, np.int64)
    both, at = np.unique(np.concatenate([none, *(p[0] for p in parts)]), return_inverse=True)
    return n, both, np.bincount(at, weights=np.concatenate([none, *(p[1] for p in parts)]), minlength=len(both)).astype(np.int64)


def term_rows(docs: DataFrame, terms: np.ndarray) -> DataFrame:
    """(doc, n, terms, tf) of every row: its number of terms, and those among `terms` (sorted keys) with their counts, as 32-bit numbers."""
    sent = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            for part in slices(batch, "text"):
                n, both, tf = counted(part.column("text"), known)
                cuts = np.searchsorted(both, np.arange(part.num_rows + 1) << 32).tolist()
                term, tf = (both & 0xFFFFFFFF).astype("<i4"), tf.astype("<i4")
                rows = list(zip(cuts[:-1], cuts[1:], strict=True))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc"), pa.array(n), *(pa.array([x[a:b].tobytes() for a, b in rows], pa.binary()) for x in (term, tf))],
                    names=["doc", "n", "terms", "tf"])

    kind = docs.schema["doc"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc {kind}, n bigint, terms binary, tf binary")


def corpus_counts(stored: DataFrame, n_terms: int) -> tuple[int, int, np.ndarray]:
    """Documents with a term, all their terms, and the documents that hold each of the item terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, some, total = np.zeros(n_terms, np.int64), 0, 0
        for batch in batches:
            n = batch.column("n").to_numpy()
            some, total = some + int((n > 0).sum()), total + int(n.sum())
            df += np.bincount(np.frombuffer(b"".join(batch.column("terms").to_pylist()), "<i4"), minlength=n_terms)
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(held, [-1, -2])), pa.array(np.append(df[held], [some, total]))], names=["term", "c"])

    rows = stored.select("n", "terms").mapInArrow(run, "term bigint, c bigint").groupBy("term").agg(F.sum("c").alias("c")).collect()
    counts = {r.term: r.c for r in rows}
    return counts.get(-1, 0), counts.get(-2, 0), np.array([counts.get(i, 0) for i in range(n_terms)], np.int64)


def weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)


def vectors(stored: DataFrame, weight: np.ndarray, n_docs: int, n_all: int) -> DataFrame:
    """(doc, length, terms, impact): impacts are 64-bit whole numbers, weight included; rows without any leave."""
    sent = stored.sparkSession.sparkContext.broadcast(weight)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms, tf = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<i4").astype(np.int64) for c in ("terms", "tf"))
            size = pa.compute.binary_length(batch.column("terms")).to_numpy() // 4
            bound = np.concatenate([[0], np.cumsum(size)])
            m = 10 + (90 * batch.column("n").to_numpy() * n_docs) // max(1, n_all)
            impact = sent.value[terms] * ((1_000_000_000 * tf) // (1000 * tf + 8 * np.repeat(m, size)))
            squares = np.concatenate([[0.0], np.cumsum(impact.astype(float) ** 2)])
            length = np.sqrt(np.maximum(0.0, squares[bound[1:]] - squares[bound[:-1]]))
            # A running sum loses small differences; a length may be too long, never too short.
            length += np.sqrt(squares[-1]) * 1e-7
            cuts = list(zip(bound[:-1].tolist(), bound[1:].tolist(), strict=True))
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(length), batch.column("terms"), pa.array([impact[a:b].astype("<i8").tobytes() for a, b in cuts], pa.binary())],
                                             names=["doc", "length", "terms", "impact"])

    kind = stored.schema["doc"].dataType.simpleString()
    return stored.where("length(terms) > 0").select("doc", "n", "terms", "tf").mapInArrow(run, f"doc {kind}, length double, terms binary, impact binary")


@dataclass
class Search:
    """The k best documents of each item so far."""

    items: list[np.ndarray]
    floor: np.ndarray  # no score below this is among the k best
    k: int
    best: list[list[tuple]] = field(default_factory=list)  # (-score, id is null, id), in order
    skipped: int = 0
    rescored: int = 0

    def __post_init__(self) -> None:
        self.floor = self.floor.copy()
        self.best = [[] for _ in self.items]
        self.size = np.array(list(map(len, self.items)), np.int64)
        self.flat = np.concatenate([*self.items, np.zeros(0, np.int64)]).astype(np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.size)])

    def bucket(self, part: pa.RecordBatch) -> None:
        length = part.column("length").to_numpy()
        alive = np.sqrt(self.size) * length.max(initial=0) >= self.floor
        alive &= self.size > 0
        self.skipped += int((~alive).sum())
        if not alive.any():
            return
        n_docs = part.num_rows
        size = pa.compute.binary_length(part.column("terms")).to_numpy() // 4
        term = np.frombuffer(b"".join(part.column("terms").to_pylist()), "<i4")
        impact = np.frombuffer(b"".join(part.column("impact").to_pylist()), "<i8")
        order = np.argsort(term, kind="stable")
        term, doc, impact = term[order], np.repeat(np.arange(n_docs), size)[order], impact[order]
        n_terms = int(max(self.flat.max(initial=-1), term.max(initial=-1))) + 1
        begin = np.searchsorted(term, np.arange(n_terms + 1))
        most = np.zeros(n_terms, np.int64)
        np.maximum.at(most, term, impact)
        total = np.concatenate([[0], np.cumsum(most[self.flat])])
        alive &= total[self.first[1:]] - total[self.first[:-1]] >= np.maximum(self.floor, 1)
        rank = None
        for q in np.flatnonzero(alive).tolist():
            got = self.scored(q, doc, impact, begin, most, length, n_docs)
            if got is None:
                continue
            if rank is None:
                rank = np.empty(n_docs, np.int64)
                rank[pa.compute.sort_indices(part.column("doc"), null_placement="at_end").to_numpy()] = np.arange(n_docs)
            self.keep(q, *got, rank, part.column("doc"))

    def scored(self, q: int, doc: np.ndarray, impact: np.ndarray, begin: np.ndarray, most: np.ndarray, length: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray] | None:
        """Documents that can be among the best of item q, and their scores."""
        terms, floor = self.items[q], max(1.0, self.floor[q])
        terms = terms[np.argsort(-most[terms], kind="stable")]
        terms = terms[most[terms] > 0]
        rest = np.append(np.cumsum(most[terms][::-1])[::-1], 0)
        # A document that holds none of the first `need` terms can't reach the floor.
        need = int((rest[:-1] >= floor).sum())
        places = [np.arange(begin[t], begin[t + 1]) for t in terms[:need].tolist()]
        at = np.concatenate(places) if places else np.zeros(0, np.int64)
        values = impact[at].astype(float)
        sums = np.bincount(doc[at], weights=values, minlength=n_docs)
        squares = np.bincount(doc[at], weights=values * values, minlength=n_docs)
        left = np.sqrt(len(terms) - need) * np.sqrt(np.maximum(0.0, length * length * (1 + 1e-9) - squares))
        high = sums + np.minimum(float(rest[need]), left)
        some = np.flatnonzero((sums > 0) & (high * (1 + 1e-9) >= floor))
        if not len(some):
            return None
        self.rescored += len(some)
        where = np.full(n_docs, -1)
        where[some] = np.arange(len(some))
        at = np.concatenate([np.arange(begin[t], begin[t + 1]) for t in terms.tolist()])
        to = where[doc[at]]
        score = np.zeros(len(some), np.int64)
        np.add.at(score, to[to >= 0], impact[at[to >= 0]])
        keep = score >= floor
        return (some[keep], score[keep]) if keep.any() else None

    def keep(self, q: int, some: np.ndarray, score: np.ndarray, rank: np.ndarray, ids: pa.Array) -> None:
        first = np.lexsort((rank[some], -score))[: self.k]
        new = [(-int(score[i]), not ids[int(some[i])].is_valid, ids[int(some[i])].as_py()) for i in first]
        self.best[q] = sorted([*self.best[q], *new], key=lambda x: x[:2] if x[1] else x)[: self.k]
        if len(self.best[q]) == self.k:
            self.floor[q] = max(self.floor[q], -self.best[q][-1][0])


def searched(ordered: DataFrame, items: list[np.ndarray], floor: np.ndarray, k: int, part_of: int = 1) -> DataFrame:
    """(item, score, doc): the k best of each item in every task; of each block only the longest vectors, one in `part_of`."""
    sent = ordered.sparkSession.sparkContext.broadcast((items, floor))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(*sent.value, k)
        for batch in batches:
            if part_of > 1:
                size = -(-batch.num_rows // part_of)
                batch = batch.take(pa.array(np.argsort(-batch.column("length").to_numpy(), kind="stable")[:size]))
            size = np.cumsum(pa.compute.binary_length(batch.column("terms")).to_numpy() // 4)
            turn = np.maximum(np.arange(batch.num_rows) // BUCKET, size // BUCKET_TERMS)
            for at in np.split(np.arange(batch.num_rows), np.flatnonzero(np.diff(turn)) + 1) if batch.num_rows else ():
                search.bucket(batch.slice(int(at[0]), len(at)))
        rows = [(q, -x[0], x[2]) for q, best in enumerate(search.best) for x in best]
        columns = list(zip(*rows, strict=True)) if rows else [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int64()), pa.array(columns[2], id_type)], names=["item", "score", "doc"])

    id_type = to_arrow_type(ordered.schema["doc"].dataType)
    return ordered.mapInArrow(run, f"item int, score bigint, doc {ordered.schema['doc'].dataType.simpleString()}")


def best_of(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
           item_text_col: str = "text", item_chars: int = ITEM_CHARS) -> DataFrame:
    """(item id, rank, document id, score) of the k best documents of each item."""
    spark = docs.sparkSession
    docs = docs.select(F.col(f"`{id_col}`").alias("doc"), F.col(f"`{text_col}`").alias("text"))
    items = items.select(F.col(f"`{item_col}`").alias("item_id"), F.col(f"`{item_text_col}`").alias("text"))
    blocks = -(-(items.agg(F.sum(F.length("text"))).first()[0] or 0) // item_chars) or 1
    out = None
    for b in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).collect()
        texts: dict = {}
        for r in own:
            texts.setdefault(r.item_id, []).append(r.text or "")
        terms, places = item_terms(["\n".join(x) for x in texts.values()])
        stored = cut(term_rows(docs, terms))
        n_docs, n_all, df = corpus_counts(stored, len(terms))
        rows = vectors(stored, weights(n_docs, df), n_docs, n_all)
        start = np.ones(len(places))
        known = best_of(searched(rows, places, start, k, SEED_PART), k).where(F.col("rank") == k).select("item", "score").collect()
        for r in known:
            start[r.item] = r.score
        # Copies of one row have one length: the row number spreads them.
        dealt = rows.withColumn("_spread", F.monotonically_increasing_id())
        dealt = dealt.repartitionByRange(width(spark), F.desc("length"), F.xxhash64("_spread")).sortWithinPartitions(F.desc("length")).drop("_spread")
        best = best_of(searched(dealt, places, start, k), k)
        names = spark.createDataFrame(list(enumerate(texts)), f"item int, `{item_col}` {items.schema['item_id'].dataType.simpleString()}")
        best = best.join(F.broadcast(names), "item")
        best = cut(best) if blocks > 1 else best
        out = best if out is None else out.unionByName(best)
    return out.select(f"`{item_col}`", F.col("rank").cast("int").alias("rank"), F.col("doc").alias(id_col), "score")
