"""Alignment of two tokenizers by pointer jumping, and how often their ids are linked in the corpus.

Tokens of both sides cover the same bytes. Every token points to the overlapping token that reaches farthest to the right, itself included;
doubling the pointers (next = next[next]) over whole arrays ends at the terminal token of each component, where both sides end a token.
Tokens with one terminal are a group; every pair of an A token and a B token that overlap is a link.

Both tokenizers end a token before each blank that follows a character other than white space (the piece vocabulary is checked
for it), so texts are taken apart there. The parts of a batch that a worker has not met yet are encoded and aligned together; a bounded
number of them is remembered. A long text goes through in slices of about `ragged.CHUNK` characters, cut at such places.

Three passes: texts to groups and the different (A id, B id) pairs of each document, stored; pairs to their number of documents, added up in
the tasks first; stored pairs to sums. The table of pairs is bounded by the vocabularies, not by the corpus: up to PAIRS of them are sent to every
task, more are joined, with the same result.

Defined results: texts that are null or empty, or that a tokenizer does not give back byte by byte (text with U+2581, say), have
zeros and an empty string. Every input row gives one row and counts as a document, repeated ones too; null ids are kept.
Other columns are not carried, whatever their names.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from govmill.llm import ragged
from govmill.llm.shared import cut, small_enough
from govmill.llm.vocab import byte_letters

#: Pairs of ids that are sent to every task at most (13 bytes each: 52 MB).
PAIRS = 4_000_000
#: Pairs that a task adds up before it passes their counts on.
BLOCK = 2_000_000
BLANK = "▁"


def components(a_end: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the group of every A token and every B token, from the byte offsets where tokens end."""
    n = len(a_end)
    # The other side's token over the last byte reaches at least as far; where both end, the A token is the terminal.
    right = np.searchsorted(b_end, a_end)
    ends = b_end[right] == a_end
    after = np.concatenate([np.where(ends, np.arange(n), n + right), np.searchsorted(a_end, b_end)])
    while True:
        farther = after[after]
        if (farther == after).all():
            break
        after = farther
    number = np.cumsum(ends) - 1
    return number[after[:n]], number[after[n:]]


def flattened(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    return np.array(list(chain.from_iterable(ids)), np.int64), np.cumsum([0, *map(len, ids)])


def links(a_end: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the A and B token of every overlapping pair: one for each range between neighbouring ends of either side."""
    ends = np.union1d(a_end, b_end)
    return np.searchsorted(a_end, ends), np.searchsorted(b_end, ends)


@dataclass
class Parts:
    """What parts of texts come to: `counts` (a row of four per part; n_a is -1 where a tokenizer does not give the part back), the ids of the
    groups in decimal, each with the sign that follows it, and the pair of every link; both one part after another, with bounds."""

    counts: np.ndarray
    said: np.ndarray
    said_bound: np.ndarray
    pairs: np.ndarray
    pair_bound: np.ndarray

    def taken(self, which: np.ndarray) -> "Parts":
        said, said_bound = ragged.gather(self.said, self.said_bound[which], self.said_bound[which + 1])
        pairs, pair_bound = ragged.gather(self.pairs, self.pair_bound[which], self.pair_bound[which + 1])
        return Parts(self.counts[which], said, said_bound, pairs, pair_bound)

    def plus(self, other: "Parts") -> "Parts":
        return Parts(np.concatenate([self.counts, other.counts]), np.concatenate([self.said, other.said]),
                     np.concatenate([self.said_bound, other.said_bound[1:] + self.said_bound[-1]]), np.concatenate([self.pairs, other.pairs]),
                     np.concatenate([self.pair_bound, other.pair_bound[1:] + self.pair_bound[-1]]))


def no_parts() -> Parts:
    zero = np.zeros(1, np.int64)
    return Parts(np.zeros((0, 4), np.int64), np.zeros(0, np.uint8), zero, np.zeros(0, np.int64), zero)


class Memo:
    """Parts by key, in arrays. Where there would be more than `limit`, those that were not asked for since the last time go, then all."""

    def __init__(self, limit: int = 300_000):
        self.limit = limit
        self.keys, self.place, self.used, self.parts = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, bool), no_parts()

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Numbers of the parts with these keys; -1 for none."""
        if not len(self.keys):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        found = np.where(self.keys[at] == keys, self.place[at], -1)
        self.used[found[found >= 0]] = True
        return found

    def keep(self, keys: np.ndarray, parts: Parts) -> None:
        if len(self.keys) + len(keys) > self.limit:
            stay = np.flatnonzero(self.used[self.place])
            stay = stay if len(stay) + len(keys) <= self.limit else stay[:0]
            self.parts, self.keys = self.parts.taken(self.place[stay]), self.keys[stay]
            self.place = np.arange(len(stay))
        self.place = np.concatenate([self.place, len(self.keys) + np.arange(len(keys))])
        self.keys = np.concatenate([self.keys, keys])
        order = np.argsort(self.keys, kind="stable")
        self.keys, self.place, self.parts = self.keys[order], self.place[order], self.parts.plus(parts)
        self.used = np.zeros(len(self.keys), bool)


class Aligner:
    def __init__(self, byte_path: str, piece_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one thread per task
        self.a = Tokenizer.from_file(byte_path)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=piece_path)
        letters = byte_letters()
        self.a_bytes = [b""] * (max(self.a.get_vocab().values()) + 1)
        for token, i in self.a.get_vocab().items():
            self.a_bytes[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(BLANK in p.lstrip(BLANK) for p in pieces):
            raise ValueError("the piece vocabulary has pieces with a blank inside; texts can't be taken apart before blanks")
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(BLANK, " ").encode() for i, p in enumerate(pieces)]
        self.alone = self.b.piece_to_id(BLANK)
        (self.a_flat, self.a_at), (self.b_flat, self.b_at) = (
            (np.frombuffer(b"".join(t), np.uint8), np.cumsum([0, *map(len, t)])) for t in (self.a_bytes, self.b_bytes))
        self.a_size, self.b_size = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        signed = [b"%d%c" % (i, sign) for i in range(max(len(self.a_bytes), len(self.b_bytes))) for sign in b",|;"]
        self.digits, self.digit_bound = np.frombuffer(b"".join(signed), np.uint8), np.cumsum([0, *map(len, signed)])
        self.memo = Memo()

    def aligned(self, parts: list[str]) -> Parts:
        """Parts that each begin with a blank, aligned all at once."""
        a_ids = [x.ids for x in self.a.encode_batch_fast(parts, add_special_tokens=False)]
        # The library puts a blank before each text, and gives nothing at all for an empty one.
        b_ids = [ids or [self.alone] for ids in self.b.encode([p[1:] for p in parts], num_threads=1)]
        good = self.given_back(parts, a_ids, b_ids)
        counts = np.zeros((len(parts), 4), np.int64)
        counts[:, 0] = -1
        said_size, pair_size = np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64)
        said, pairs = np.zeros(0, np.uint8), np.zeros(0, np.int64)
        if len(good):
            if len(good) < len(parts):
                a_ids, b_ids = ([ids[i] for i in good.tolist()] for ids in (a_ids, b_ids))
            (a_flat, a_bound), (b_flat, b_bound) = flattened(a_ids), flattened(b_ids)
            a_end, b_end = np.cumsum(self.a_size[a_flat]), np.cumsum(self.b_size[b_flat])
            a_group, b_group = components(a_end, b_end)
            a_at, b_at = links(a_end, b_end)
            pairs = a_flat[a_at] * len(self.b_bytes) + b_flat[b_at]
            said, said_bound = self.written(a_flat, b_flat, a_group, b_group, a_bound + b_bound)
            pair_bound = np.searchsorted(a_at, a_bound)
            group_bound = np.append(a_group[a_bound[:-1]], a_group[-1] + 1)
            counts[good] = np.diff([a_bound, b_bound, group_bound, pair_bound], axis=1).T
            said_size[good], pair_size[good] = np.diff(said_bound), np.diff(pair_bound)
        return Parts(counts, said, np.append(0, np.cumsum(said_size)), pairs, np.append(0, np.cumsum(pair_size)))

    def given_back(self, parts: list[str], a_ids: list[list[int]], b_ids: list[list[int]]) -> np.ndarray:
        """Numbers of the parts whose bytes both sides give back."""
        plain = [p.encode() for p in parts]
        whole, size, same = np.frombuffer(b"".join(plain), np.uint8), np.array(list(map(len, plain))), True
        for ids, table, at in ((a_ids, self.a_flat, self.a_at), (b_ids, self.b_flat, self.b_at)):
            flat, bound = flattened(ids)
            made, offset = ragged.gather(table, at[flat], at[flat + 1])
            same = same and (np.diff(offset[bound]) == size).all() and (made == whole).all()
        if same:
            return np.arange(len(parts))
        return np.array([i for i, p in enumerate(plain) if b"".join(map(self.a_bytes.__getitem__, a_ids[i])) == p == b"".join(map(self.b_bytes.__getitem__, b_ids[i]))], np.int64)

    def written(self, a_flat: np.ndarray, b_flat: np.ndarray, a_group: np.ndarray, b_group: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all groups in decimal, each with the sign that follows it, and where each part begins: `bound` counts its ids."""
        group = np.concatenate([a_group, b_group])
        order = np.argsort(group * 2 + np.repeat([0, 1], [len(a_flat), len(b_flat)]), kind="stable")
        ids, group, left = np.concatenate([a_flat, b_flat])[order], group[order], order < len(a_flat)
        sign = np.zeros(len(ids), np.int64)
        sign[:-1] = (left[:-1] & ~left[1:]) + 2 * (group[1:] != group[:-1])
        sign[-1] = 2
        flat, offset = ragged.gather(self.digits, self.digit_bound[ids * 3 + sign], self.digit_bound[ids * 3 + sign + 1])
        return flat, offset[bound]

    def parts_of(self, texts: list[str]) -> tuple[Parts, np.ndarray, np.ndarray]:
        """(different parts, number of the part at every place, bounds of the texts) of texts that each begin with a blank."""
        whole = "".join(texts)
        points = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
        first = np.cumsum([0, *map(len, texts)])
        begins = np.zeros(len(points), bool)
        begins[1:] = (points[1:] == 32) & (ragged.char_classes()[points[:-1]] != ragged.SPACE)
        begins[first[:-1]] = True
        start = np.flatnonzero(begins)
        end = np.append(start[1:], len(points))
        keys, where, code = np.unique(ragged.piece_keys(points, start, end), return_index=True, return_inverse=True)
        found = self.memo.find(keys)
        new = np.flatnonzero(found < 0)
        parts = self.memo.parts
        if len(new):
            made = self.aligned([whole[start[p]:end[p]] for p in where[new].tolist()])
            found[new] = len(parts.counts) + np.arange(len(new))
            parts = parts.plus(made)
            self.memo.keep(keys[new], made)
        return parts, found[code], np.searchsorted(start, first)

    def slices(self, text: str, limit: int) -> Iterator[str]:
        """A text with the blank before it, in slices of about `limit` characters that end where both tokenizers end a token."""
        text, at = " " + text, 0
        kind = ragged.char_classes()
        while len(text) - at > limit:
            cut_at = text.find(" ", at + limit)
            while cut_at > 0 and kind[ord(text[cut_at - 1])] == ragged.SPACE:
                cut_at = text.find(" ", cut_at + 1)
            if cut_at < 0:
                break
            yield text[at:cut_at]
            at = cut_at
        yield text[at:]

    def documents(self, texts: list[str | None], limit: int = ragged.CHUNK) -> list["Document"]:
        out = [Document() for _ in texts]
        held: list[tuple[Document, str]] = []
        size = 0
        for doc, text in zip(out, texts, strict=True):
            for part in self.slices(text, limit) if text else ():
                held.append((doc, part))
                size += len(part)
                if size >= limit:
                    self._take(held)
                    held, size = [], 0
        self._take(held)
        return out

    def _take(self, held: list[tuple["Document", str]]) -> None:
        if not held:
            return
        parts, code, bound = self.parts_of([part for _, part in held])
        found = parts.taken(code)
        # The different pairs of each text.
        owner = np.repeat(np.arange(len(held)), np.diff(found.pair_bound[bound]))
        both, times = np.unique(owner << 40 | found.pairs, return_counts=True)
        pair_bound = np.searchsorted(both, np.arange(len(held) + 1) << 40)
        pairs = both & ((1 << 40) - 1)
        bad = ragged.text_sums((found.counts[:, 0] < 0).astype(np.int64), bound)
        sums = np.stack([ragged.text_sums(found.counts[:, c], bound) for c in range(4)], axis=1)
        said_bound = found.said_bound[bound].tolist()
        for k, (doc, _) in enumerate(held):
            if bad[k]:
                doc.broken = True
            elif not doc.broken:
                a, b = pair_bound[k], pair_bound[k + 1]
                doc.add(sums[k], found.said[said_bound[k]: said_bound[k + 1] - 1], pairs[a:b], times[a:b])


class Document:
    """Sums over the slices of one text."""

    __slots__ = ("broken", "counts", "hash", "pairs", "times")

    def __init__(self) -> None:
        self.broken, self.counts, self.hash = False, np.zeros(4, np.int64), None
        self.pairs = self.times = np.zeros(0, np.int64)

    def add(self, counts: np.ndarray, groups: np.ndarray, pairs: np.ndarray, times: np.ndarray) -> None:
        self.counts = self.counts + counts
        if self.hash is None:
            self.hash = hashlib.sha256(groups)
            self.pairs, self.times = pairs, times
        else:
            self.hash.update(b";")
            self.hash.update(groups)
            self.pairs, at = np.unique(np.concatenate([self.pairs, pairs]), return_inverse=True)
            self.times = np.bincount(at, weights=np.concatenate([self.times, times])).astype(np.int64)

    def row(self) -> tuple:
        if self.broken or self.hash is None:
            return 0, 0, 0, 0, "", b"", b""
        return *self.counts.tolist(), self.hash.hexdigest(), self.pairs.astype("<i8").tobytes(), self.times.astype("<i4").tobytes()


@lru_cache(maxsize=1)
def _aligner(byte_path: str, piece_path: str) -> Aligner:
    return Aligner(byte_path, piece_path)


COUNTS = ["n_a", "n_b", "n_groups", "n_links"]


def grouped(df: DataFrame, byte_path: str, piece_path: str, id_col: str, text_col: str) -> DataFrame:
    """(row, id, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times): pairs are the document's different ones, as A id * B ids + B id."""
    base = df.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(byte_path, piece_path)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                rows = [x.row() for x in aligner.documents(part.column("text").to_pylist())]
                kinds = [pa.int64()] * 4 + [pa.string(), pa.binary(), pa.binary()]
                made = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("row"), part.column("id"), *made], names=["row", "id", *COUNTS, "groups_sha256", "pairs", "times"])

    kind = base.schema["id"].dataType.simpleString()
    return base.mapInArrow(run, f"row bigint, id {kind}, {', '.join(f'{c} bigint' for c in COUNTS)}, groups_sha256 string, pairs binary, times binary")


def pair_counts(stored: DataFrame, b_ids: int) -> DataFrame:
    """(pair, docs, best): documents that hold the pair, and whether no other pair of its A id has more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, docs = np.zeros(0, np.int64), np.zeros(0, np.int64)
        held: list[bytes] = []
        size = 0
        for batch in batches:
            for blob in batch.column("pairs").to_pylist():
                held.append(blob)
                size += len(blob) // 8
                if size >= BLOCK:
                    pairs, docs = summed(pairs, docs, held)
                    held, size = [], 0
                    if len(pairs) >= BLOCK:
                        yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(docs)], names=["pair", "docs"])
                        pairs = docs = np.zeros(0, np.int64)
        pairs, docs = summed(pairs, docs, held)
        yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(docs)], names=["pair", "docs"])

    counts = cut(stored.select("pairs").mapInArrow(run, "pair bigint, docs bigint").groupBy("pair").agg(F.sum("docs").alias("docs")))
    counts = counts.withColumn("a", F.floor(F.col("pair") / b_ids))
    # One row per id of A at most.
    most = counts.groupBy("a").agg(F.max("docs").alias("most"))
    return counts.join(F.broadcast(most), "a").select("pair", "docs", (F.col("docs") == F.col("most")).alias("best"))


def summed(pairs: np.ndarray, docs: np.ndarray, held: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Counts of pairs with one more document for each pair of every blob."""
    own, times = np.unique(np.frombuffer(b"".join(held), "<i8"), return_counts=True)
    if not len(pairs):
        return own, times
    pairs, at = np.unique(np.concatenate([pairs, own]), return_inverse=True)
    total = np.zeros(len(pairs), np.int64)
    np.add.at(total, at, np.concatenate([docs, times]))
    return pairs, total


def sums_in_place(stored: DataFrame, table: DataFrame) -> DataFrame:
    """Adds n_best and count_sum to stored rows with the whole table of pairs in every task."""
    got = table.toArrow()
    order = np.argsort(got["pair"].to_numpy())
    sent = stored.sparkSession.sparkContext.broadcast(
        (got["pair"].to_numpy()[order], got["docs"].to_numpy()[order], got["best"].to_numpy()[order]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, docs, best = sent.value
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                blobs, times = part.column("pairs").to_pylist(), part.column("times").to_pylist()
                bound = np.cumsum([0, *(len(x) // 8 for x in blobs)])
                where = np.searchsorted(pairs, np.frombuffer(b"".join(blobs), "<i8"))
                times = np.frombuffer(b"".join(times), "<i4").astype(np.int64)
                rest = [part.column(c) for c in ("id", *COUNTS, "groups_sha256")]
                made = [pa.array(ragged.text_sums(x, bound)) for x in (times * best[where], times * docs[where])]
                yield pa.RecordBatch.from_arrays([*rest, *made], names=["id", *COUNTS, "groups_sha256", "n_best", "count_sum"])

    kind = stored.schema["id"].dataType.simpleString()
    return stored.mapInArrow(run, f"id {kind}, {', '.join(f'{c} bigint' for c in COUNTS)}, groups_sha256 string, n_best bigint, count_sum bigint")


def sums_by_join(stored: DataFrame, table: DataFrame) -> DataFrame:
    """The same by joining the pairs of all documents with the table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, pairs, times in zip(*(batch.column(c).to_pylist() for c in ("row", "pairs", "times")), strict=True):
                pairs = np.frombuffer(pairs, "<i8")
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(pairs), row, np.int64)), pa.array(pairs), pa.array(np.frombuffer(times, "<i4").astype(np.int64))],
                                                 names=["row", "pair", "times"])

    long = stored.select("row", "pairs", "times").mapInArrow(run, "row bigint, pair bigint, times bigint")
    sums = long.join(table, "pair").groupBy("row").agg(F.sum(F.col("times") * F.col("best").cast("bigint")).alias("n_best"), F.sum(F.col("times") * F.col("docs")).alias("count_sum"))
    return stored.join(sums, "row", "left").na.fill(0, ["n_best", "count_sum"])


def alignment(df: DataFrame, byte_path: str, piece_path: str, id_col: str = "doc_id", text_col: str = "text", pairs: int = PAIRS) -> DataFrame:
    """One row per input row: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    stored = cut(grouped(df, byte_path, piece_path, id_col, text_col))
    table = cut(pair_counts(stored, SentencePieceProcessor(model_file=piece_path).get_piece_size()))
    out = sums_in_place(stored, table) if small_enough(table, pairs) else sums_by_join(stored, table)
    return out.select(F.col("id").alias(id_col), *COUNTS, "n_best", "count_sum", "groups_sha256")
