"""Token counts by rank-synchronous array merging.

The pre-tokens of a batch are one ragged array of symbols. In every round each sequence finds its lowest-ranked pair and all
sequences merge theirs at the same time, at every place of it; sequences without a ranked pair leave. The symbols that
are left are counted. One stage, no exchange: a count depends on its text alone.

Defined results: null and empty texts have 0 bytes and 0 tokens. Repeated rows are each counted. Other columns, also
ones that share a name with a result, are not carried; `id_col` and `text_col` name what is read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from govmill.llm import ragged
from govmill.llm.vocab import Merges, from_json


def merge_counts(flat: np.ndarray, offset: np.ndarray, merges: Merges) -> np.ndarray:
    """Symbols left of every sequence flat[offset[i]:offset[i + 1]] of bytes."""
    count = np.diff(offset)
    symbol, owner = merges.first[flat], np.repeat(np.arange(len(count)), count)
    top = np.iinfo(np.int64).max
    while len(symbol) > 1:
        at = merges.find(symbol[:-1] * merges.size + symbol[1:])
        at[owner[:-1] != owner[1:]] = -1
        rank = np.where(at >= 0, merges.rank[at], top)
        head = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        lowest = np.minimum.reduceat(np.append(rank, top), head)
        per_head = np.diff(np.append(head, len(symbol)))
        alive = np.repeat(lowest < top, per_head)
        if not alive.any():
            break
        hit = (rank == np.repeat(lowest, per_head)[:-1]) & alive[:-1]
        # In a run of places that overlap (aaaa), every other one merges, from the left.
        place = np.flatnonzero(hit)
        run = np.append(True, place[1:] != place[:-1] + 1)
        place = place[(np.arange(len(place)) - np.flatnonzero(run)[np.cumsum(run) - 1]) % 2 == 0]
        symbol[place] = merges.made[at[place]]
        np.subtract.at(count, owner[place], 1)
        keep = alive
        keep[place + 1] = False
        symbol, owner = symbol[keep], owner[keep]
    return count


class Counter:
    def __init__(self, merges: Merges):
        self.merges, self.memo = merges, ragged.Memo()

    def count(self, texts: list[str | None]) -> np.ndarray:
        parts, extra = [], np.zeros(len(texts), np.int64)
        owner: list[int] = []
        for i, text in enumerate(texts):
            pieces = [text or ""]
            for s in self.merges.special:
                if s in pieces[0]:
                    pieces = [y for x in pieces for y in x.split(s)]
            extra[i] = len(pieces) - 1
            parts += pieces
            owner += [i] * len(pieces)
        total = np.concatenate([self._counted(parts[a:b]) for a, b in ragged.chunks(parts)] or [np.zeros(0, np.int64)])
        np.add.at(extra, np.array(owner, np.int64), total)
        return extra

    def _counted(self, texts: list[str]) -> np.ndarray:
        pieces = ragged.Pieces(texts)
        keys, first, code = ragged.distinct(pieces.key)
        found = self.memo.find(keys)
        new = [i for i, x in enumerate(found) if x is None]
        if new:
            made = merge_counts(*pieces.bytes_of(first[new]), self.merges).tolist()
            for i, x in zip(new, made, strict=True):
                found[i] = x
            self.memo.keep([keys[i] for i in new], made)
        return ragged.text_sums(np.array(found, np.int64)[code], pieces.bound)


_COUNTERS: dict[str, Counter] = {}


def _counter(path: str) -> Counter:
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(from_json(path))
    return _COUNTERS[path]


def token_counts(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_bytes (UTF-8), n_tokens."""
    base = df.select(F.col(f"`{id_col}`").alias(id_col), F.col(f"`{text_col}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                column = part.column("text")
                size = column.cast(pa.binary())
                n_bytes = pa.array([len(x) if x is not None else 0 for x in size.to_pylist()], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(id_col), n_bytes, pa.array(counter.count(column.to_pylist()), pa.int64())],
                    names=[id_col, "n_bytes", "n_tokens"])

    kind = base.schema[id_col].dataType.simpleString()
    return base.mapInArrow(run, f"`{id_col}` {kind}, n_bytes bigint, n_tokens bigint")
