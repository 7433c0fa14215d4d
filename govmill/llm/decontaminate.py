"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming search, exact weighted-shingle check.

Every document is cut into windows as long as benchmark items are (a few sizes, each with a stride of a quarter of its
length). A window's fingerprint has 64 bits: the majority of its words' key bits. An item has a fingerprint for each of as many
offsets as the stride has steps, so that a passage meets a window cut at the same words, wherever it stands. Fingerprints
within RADIUS bits are found without fail: their 16 bits agree but for one in at least one of four blocks, and each block of the
index lists its neighbours too. A changed, cut or long passage may have no such window, so single shingles nominate as well: of each item
the heaviest ones, as many as weigh more than what a match may lack. A passage without any of them cannot reach LEAST, so none is lost,
wherever in the item the change lies. Each candidate is then checked on the words, at the best place near it: the weight of an item's 5-word shingles that
stand in the passage, as a share of the weight of all of them, has to be 0.8 or more (weight: log(1 + items / items
that have the shingle, over the whole benchmark)).

The benchmark is the query set, taken in blocks of items whose size is checked; documents are read once per block and never
shuffled. A lost task is run again by itself.

Defined results: words are runs of letters and digits, lower-cased, so signs and line breaks do not matter. Null or empty
documents match nothing; items of fewer than five words have no shingle and match nothing; equal items are all reported.
Documents are searched whole; a repeated row is reported again. Other columns of either table are never read by a match.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from govmill.llm import words

SHINGLE = 5
RADIUS = 7
LEAST = 0.8
#: Lengths of windows, each about 1.4 times the one before, from a shingle on. Longer items are met by windows of the last.
LENGTHS = (5, 7, 10, 14, 20, 28, 40, 56, 80, 112, 160, 224)
PART = 1 << 14  #: words whose key bits are summed at a time
ITEM_BYTES = 16_000_000  #: benchmark text of one block


def stride(length: int) -> int:
    return max(1, length // 4)


def fingerprints(keys: np.ndarray, cuts: list[tuple[int, np.ndarray]]) -> list[np.ndarray]:
    """Majority bits of the words keys[start:start + length] for each length and its (sorted) starts.

    Each of the 64 bits of a word is a byte of eight 64-bit numbers; the difference of two running sums of these holds 64
    counts at once, exactly, as no count of a window reaches 256.
    """
    out = [np.empty(len(start), np.uint64) for _, start in cuts]
    longest = max((length for length, _ in cuts), default=0)
    for first in range(0, len(keys), PART):
        part = keys[first: first + PART + longest]
        lanes = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).view(np.uint64)
        total = np.zeros((len(part) + 1, 8), np.uint64)
        np.cumsum(lanes, axis=0, out=total[1:])
        for (length, start), prints in zip(cuts, out, strict=True):
            a, b = np.searchsorted(start, (first, first + PART))
            if b > a:
                at = start[a:b] - first
                count = (total[at + length] - total[at]).view(np.uint8)
                prints[a:b] = np.packbits(count > length // 2, axis=1).view(np.uint64).ravel()
    return out


@dataclass
class Block:
    """One block of 16 bits of all fingerprints of a length: those that have a value or one that differs by a bit."""

    shift: int
    offset: np.ndarray
    entry: np.ndarray

    @classmethod
    def of(cls, prints: np.ndarray, shift: int) -> "Block":
        value = ((prints >> np.uint64(shift)) & np.uint64(0xFFFF)).astype(np.int64)
        near = value[:, None] ^ np.array([0, *(1 << b for b in range(16))])
        order = np.argsort(near.ravel(), kind="stable")
        offset = np.searchsorted(near.ravel()[order], np.arange(65537))
        return cls(shift, offset, np.repeat(np.arange(len(prints)), near.shape[1])[order])

    def find(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        value = ((prints >> np.uint64(self.shift)) & np.uint64(0xFFFF)).astype(np.int64)
        count = (self.offset[1:] - self.offset[:-1])[value]
        some = np.flatnonzero(count)
        count = count[some]
        within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        return np.repeat(some, count), self.entry[np.repeat(self.offset[value[some]], count) + within]


class Index:
    """Benchmark items as fingerprints by window length."""

    def __init__(self, ids: list, texts: pa.Array):
        flat, offset = words.column_bytes(pa.compute.utf8_lower(pa.compute.fill_null(texts, "")))
        keys, bound = words.word_keys(flat, offset, letters_only=True)
        self.ids = ids
        self.size = np.diff(bound)
        shingle, row, _ = words.shingle_keys(keys, bound, SHINGLE)
        enough = self.size[row] >= SHINGLE
        shingle, row = shingle[enough], row[enough]
        both = np.unique(np.stack([shingle, row.astype(np.uint64)]), axis=1)
        self.shingle, df = np.unique(both[0], return_counts=True)
        self.df = df
        owner = both[1].astype(np.int64)
        order = np.argsort(owner, kind="stable")
        at = np.searchsorted(self.shingle, both[0])[order]
        cut = np.searchsorted(owner[order], np.arange(len(ids) + 1))
        self.own = [at[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)]
        self.tables: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, list[Block]]] = {}
        fits: dict[int, list[int]] = {}
        for i, n in enumerate(self.size.tolist()):
            good = [w for w in LENGTHS if w + stride(w) - 1 <= n]
            if good:
                fits.setdefault(good[-1], []).append(i)
        for w, items in fits.items():
            item = np.repeat(np.array(items), stride(w))
            shift = np.tile(np.arange(stride(w)), len(items))
            start = bound[item] + shift
            order = np.argsort(start, kind="stable")
            item, shift = item[order], shift[order]
            prints = fingerprints(keys, [(w, start[order])])[0]
            self.tables[w] = item, shift, prints, [Block.of(prints, s) for s in (0, 16, 32, 48)]

        self.weigh(len(ids), self.df)

    def weigh(self, items: int, df: np.ndarray) -> None:
        """Set the weights of shingles from their counts among so many items, and which shingles nominate which items."""
        self.weight = np.log1p(max(1, items) / df) if len(df) else np.zeros(0)
        self.full = np.array([self.weight[x].sum() for x in self.own])
        named, owner = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for i, mine in enumerate(self.own):
            heavy = mine[np.argsort(-self.weight[mine], kind="stable")]
            enough = np.cumsum(self.weight[heavy]) - self.weight[heavy] <= (1 - LEAST + 1e-9) * self.full[i]
            named.append(heavy[enough])
            owner.append(np.full(enough.sum(), i))
        named, owner = np.concatenate(named), np.concatenate(owner)
        order = np.argsort(named, kind="stable")
        self.named_item = owner[order]
        self.named_bound = np.searchsorted(named[order], np.arange(len(self.shingle) + 1))

    def nominated(self, keys: np.ndarray, bound: np.ndarray) -> list[tuple[int, int, int]]:
        """(row, item, first word) of each place with a shingle that nominates the item."""
        if not len(self.shingle) or not len(keys):
            return []
        shingle, row, first = words.shingle_keys(keys, bound, SHINGLE)
        place = np.minimum(np.searchsorted(self.shingle, shingle), len(self.shingle) - 1)
        hit = np.flatnonzero((self.shingle[place] == shingle) & (np.diff(bound)[row] >= SHINGLE))
        count = np.diff(self.named_bound)[place[hit]]
        within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        item = self.named_item[np.repeat(self.named_bound[place[hit]], count) + within]
        return list(zip(np.repeat(row[hit], count).tolist(), item.tolist(), np.repeat(first[hit], count).tolist(), strict=True))

    def best_window(self, item: int, keys: np.ndarray) -> tuple[float, int]:
        """Largest similarity of the item to a passage of its length and a shingle more at both ends, and where its first word is."""
        shingle, _, _ = words.shingle_keys(keys, np.array([0, len(keys)]), SHINGLE)
        place = np.minimum(np.searchsorted(self.shingle, shingle), len(self.shingle) - 1)
        at = np.flatnonzero((self.shingle[place] == shingle) & np.isin(place, self.own[item]))
        if self.weight[np.unique(place[at])].sum() < (LEAST - 1e-9) * self.full[item]:
            return 0.0, 0
        room, seen, total, left, best, where = int(self.size[item]) + SHINGLE + 1, {}, 0.0, 0, 0.0, 0
        spots, kinds = at.tolist(), place[at].tolist()
        for spot, kind in zip(spots, kinds, strict=True):
            if not seen.get(kind):
                total += self.weight[kind]
            seen[kind] = seen.get(kind, 0) + 1
            while spot - spots[left] >= room:
                seen[kinds[left]] -= 1
                if not seen[kinds[left]]:
                    total -= self.weight[kinds[left]]
                left += 1
            if total > best + 1e-9:
                best, where = total, spots[left]
        return float(best / self.full[item]), where

    def similarity(self, item: int, present: np.ndarray) -> float:
        """Weight of the item's shingles among those present (sorted positions in `shingle`), as a share of its own."""
        return float(self.weight[np.intersect1d(self.own[item], present)].sum() / self.full[item])

    def search(self, column: pa.Array) -> list[tuple[int, int, float, int]]:
        """(row, item, similarity, first word) of every match; the best and first one per row and item."""
        flat, offset = words.column_bytes(pa.compute.utf8_lower(column))
        keys, bound = words.word_keys(flat, offset, letters_only=True)
        row = np.repeat(np.arange(len(bound) - 1), np.diff(bound))
        tried: set[tuple[int, int, int]] = set()
        cuts = []
        for w in self.tables:
            start = np.arange(0, len(keys) - w + 1, stride(w))
            cuts.append((w, start[row[start] == row[start + w - 1]] if len(start) else start))
        for (w, start), mine in zip(cuts, fingerprints(keys, cuts), strict=True):
            item, shift, prints, blocks = self.tables[w]
            for block in blocks:
                left, right = block.find(mine)
                close = np.bitwise_count(mine[left] ^ prints[right]) <= RADIUS
                left, right = start[left[close]], right[close]
                tried.update(zip(row[left].tolist(), item[right].tolist(), (left - shift[right]).tolist(), strict=True))
        best: dict[tuple[int, int], tuple[float, int]] = {}
        for r, i, at in sorted(tried):
            a, b = max(bound[r], at - SHINGLE), min(bound[r + 1], at + self.size[i] + SHINGLE)
            if b - a < SHINGLE:
                continue
            shingle, _, _ = words.shingle_keys(keys[a:b], np.array([0, b - a]), SHINGLE)
            place = np.minimum(np.searchsorted(self.shingle, shingle), len(self.shingle) - 1)
            got = self.similarity(i, np.unique(place[self.shingle[place] == shingle]))
            if got >= LEAST - 1e-12 and got > best.get((r, i), (0.0, 0))[0]:
                best[r, i] = got, max(0, int(at - bound[r]))
        places: dict[tuple[int, int], list[int]] = {}
        for r, i, at in self.nominated(keys, bound):
            places.setdefault((r, i), []).append(at)
        for (r, i), spots in places.items():
            if best.get((r, i), (0.0, 0))[0] >= 1 - 1e-12:
                continue
            # Regions around the nominating places; those that overlap are one.
            far = int(self.size[i]) + 2 * SHINGLE
            spots.sort()
            cuts = [0, *(k for k in range(1, len(spots)) if spots[k] - spots[k - 1] > 2 * far), len(spots)]
            for x, y in zip(cuts[:-1], cuts[1:], strict=True):
                a, b = max(bound[r], spots[x] - far), min(bound[r + 1], spots[y - 1] + far)
                got, first = self.best_window(i, keys[a:b])
                if got >= LEAST - 1e-12 and got > best.get((r, i), (0.0, 0))[0] + 1e-9:
                    best[r, i] = got, int(a - bound[r]) + first
        return [(r, i, s, at) for (r, i), (s, at) in sorted(best.items())]


def indexes(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> list[Index]:
    """The benchmark in blocks of a checked size; each is small enough for every task."""
    items = benchmark.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("b")).first()["b"]
    blocks = 1 + size // ITEM_BYTES
    out = []
    for k in range(blocks):
        got = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == k).toArrow().combine_chunks()
        text = got.column("text").combine_chunks() if got.num_rows else pa.array([], pa.string())
        out.append(Index(got.column("id").to_pylist(), text))
    kinds, code = np.unique(np.concatenate([x.shingle for x in out]), return_inverse=True)
    df = np.bincount(code, np.concatenate([x.df for x in out]), len(kinds))
    for index in out:
        index.weigh(sum(len(x.ids) for x in out), df[np.searchsorted(kinds, index.shingle)])
    return out


def matches(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id") -> DataFrame:
    """(id, item_id, similarity, first_word) of every benchmark item that a document holds."""
    docs = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    kind, item_kind = docs.schema["id"].dataType, benchmark.schema[item_id].dataType
    out = None
    for index in indexes(benchmark, item_id):
        sent = df.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in words.slices(batch, "text"):
                    hit = sent.value.search(part.column("text"))
                    if hit:
                        row, item, similarity, first = zip(*hit, strict=True)
                        yield pa.RecordBatch.from_arrays(
                            [part.column("id").take(pa.array(row)), pa.array([sent.value.ids[i] for i in item], pa.int64()),
                             pa.array(similarity, pa.float64()), pa.array(first, pa.int64())],
                            names=["id", "item_id", "similarity", "first_word"])

        one = docs.mapInArrow(run, f"id {kind.simpleString()}, item_id {item_kind.simpleString()}, similarity double, first_word bigint")
        out = one if out is None else out.unionByName(one)
    return out.withColumnRenamed("id", id_col)


def clean(df: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id: str = "item_id") -> DataFrame:
    """The documents that hold no benchmark item, with all their columns; one pass, no exchange."""
    for index in indexes(benchmark, item_id):
        sent = df.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in words.slices(batch, text_col):
                    keep = np.ones(part.num_rows, bool)
                    keep[[r for r, *_ in sent.value.search(part.column(text_col))]] = False
                    yield part.filter(pa.array(keep))

        df = df.mapInArrow(run, df.schema)
    return df
