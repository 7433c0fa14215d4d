"""Byte-level BPE encoding and decoding by corpus-level merge replay.

A task holds the different words (pre-tokens) of a slice of the corpus that it has not met yet as one linked list of
symbols, with an inverted index from token pair to places in it. It then replays the merges in rank order: each pair is taken
from a queue once, every place in its list is merged, and only the two neighbours of a merged place enter the index
anew. What a word becomes depends on the word alone, so slices need no exchange: the job reads, encodes and writes
in one stage, a lost task is simply run again, and no group of rows is ever brought together.

Defined results: a null or empty text gives no ids (an empty binary value). Texts are encoded whole. Rows are kept as
they are, repeated ones too. Columns of the input that share a name with an output column are replaced by the output.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from govmill.llm import ragged
from govmill.llm.vocab import Merges, from_ranks


class Replay:
    """Merges the words of a slice of the corpus in the order of the ranks."""

    def __init__(self, merges: Merges):
        self.merges = merges
        self.rank_of = dict(zip(merges.keys.tolist(), merges.rank.tolist(), strict=True))
        self.made = dict(zip(merges.rank.tolist(), merges.made.tolist(), strict=True))

    def __call__(self, flat: np.ndarray, offset: np.ndarray) -> list[bytes]:
        """Ids of every word flat[offset[i]:offset[i + 1]] of bytes, as little-endian 32-bit numbers.

        Places of a rank are merged from left to right. Where a merge makes a pair of a lower rank than its own, that pair
        merges at once, as it is then the lowest of its word.
        """
        size, get, merges = self.merges.size, self.rank_of.get, self.merges
        n, first = len(flat), merges.first[flat]
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        filled = offset[1:] > offset[:-1]
        after[offset[1:][filled] - 1] = before[offset[:-1][filled]] = -1
        # The index of all first pairs at once: places in the order of rank, then of position.
        found = merges.find(first[:-1] * size + first[1:]) if n > 1 else np.zeros(0, np.int64)
        at = np.flatnonzero((found >= 0) & (after[:-1] >= 0))
        rank = merges.rank[found[at]]
        order = np.argsort(rank, kind="stable")
        ranks, head = np.unique(rank[order], return_index=True)
        places = dict(zip(ranks.tolist(), (x.tolist() for x in np.split(at[order], head[1:])), strict=True)) if len(at) else {}
        queue = ranks.tolist()
        symbol, after, before = first.tolist(), after.tolist(), before.tolist()
        while queue:
            rank = heappop(queue)
            listed, made = places.pop(rank), self.made[rank]
            for at in sorted(listed):
                then = after[at]
                if then < 0 or get(symbol[at] * size + symbol[then]) != rank:
                    continue
                merged = made
                while True:
                    symbol[at], symbol[then] = merged, -1
                    after[at] = then = after[then]
                    lowest, where = rank, -1
                    if then >= 0:
                        before[then] = at
                        if (new := get(merged * size + symbol[then])) is not None:
                            if new < rank:
                                lowest, where = new, at
                            elif new in places:
                                places[new].append(at)
                            else:
                                places[new] = [at]
                                heappush(queue, new)
                    if (back := before[at]) >= 0 and (new := get(symbol[back] * size + merged)) is not None:
                        if new < rank:
                            if new <= lowest:
                                lowest, where = new, back
                        elif new in places:
                            places[new].append(back)
                        else:
                            places[new] = [back]
                            heappush(queue, new)
                    if where < 0:
                        break
                    at, then, merged = where, after[where], self.made[lowest]
        out = np.array(symbol, np.int64)
        ids = out[out >= 0].astype("<u4").tobytes()
        bound = np.concatenate([[0], np.cumsum(out >= 0)])[offset] * 4
        return [ids[a:b] for a, b in zip(bound[:-1].tolist(), bound[1:].tolist(), strict=True)]


class Encoder:
    """Encodes texts; remembers a bounded number of words as little-endian 32-bit ids."""

    def __init__(self, merges: Merges):
        self.replay, self.memo = Replay(merges), ragged.Memo()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        out: list[bytes] = []
        for a, b in ragged.chunks(texts):
            pieces = ragged.Pieces([x or "" for x in texts[a:b]])
            keys, first, code = ragged.distinct(pieces.key)
            found = self.memo.find(keys)
            new = [i for i, x in enumerate(found) if x is None]
            if new:
                made = self.replay(*pieces.bytes_of(first[new]))
                for i, x in zip(new, made, strict=True):
                    found[i] = x
                self.memo.keep([keys[i] for i in new], made)
            code, bound = code.tolist(), pieces.bound.tolist()
            ids_of = found.__getitem__
            out += [b"".join(map(ids_of, code[x:y])) for x, y in zip(bound[:-1], bound[1:], strict=True)]
        return out


class Decoder:
    def __init__(self, table: list[bytes]):
        self.flat = np.frombuffer(b"".join(table), np.uint8)
        self.offset = np.cumsum([0, *map(len, table)])

    def decode(self, rows: list[bytes | None]) -> list[bytes]:
        """Bytes of rows of little-endian 32-bit ids."""
        out: list[bytes] = []
        for a, b in ragged.chunks(rows):
            part = [x or b"" for x in rows[a:b]]
            ids = np.frombuffer(b"".join(part), "<u4").astype(np.int64)
            flat, offset = ragged.gather(self.flat, self.offset[ids], self.offset[ids + 1])
            bound = offset[np.cumsum([0, *(len(x) // 4 for x in part)])].tolist()
            whole = flat.tobytes()
            out += [whole[x:y] for x, y in zip(bound[:-1], bound[1:], strict=True)]
        return out


_ENCODERS: dict[str, tuple[Encoder, Decoder]] = {}


def _encoder(path: str) -> tuple[Encoder, Decoder]:
    """One encoder per worker and vocabulary, so that words met by one task serve the next."""
    if path not in _ENCODERS:
        merges, table = from_ranks(path)
        _ENCODERS[path] = Encoder(merges), Decoder(table)
    return _ENCODERS[path]


def _mapped(df: DataFrame, schema: str, work: Callable[[pa.RecordBatch], dict[str, pa.Array]]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                yield pa.RecordBatch.from_pydict(dict(zip(part.schema.names, part.columns, strict=True)) | work(part))

    return df.mapInArrow(run, schema)


def _schema(df: DataFrame, added: dict[str, str]) -> str:
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields]
    return ", ".join(kept + [f"`{k}` {v}" for k, v in added.items()])


def _keep(df: DataFrame, text: str, *out: str) -> DataFrame:
    """One column named `text`; those that an output would clash with go."""
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in out])


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "token_ids", drop_text: bool = False) -> DataFrame:
    """Adds `ids` (binary: little-endian unsigned 32-bit ids, the layout of token shards) and `n_tokens`."""
    base = _keep(df, text, ids, "n_tokens")

    def work(part: pa.RecordBatch) -> dict[str, pa.Array]:
        got = _encoder(path)[0].encode(part.column(text).to_pylist())
        return {ids: pa.array(got, pa.binary()), "n_tokens": pa.array([len(x) // 4 for x in got], pa.int64())}

    out = _mapped(base, _schema(base, {ids: "binary", "n_tokens": "bigint"}), work)
    return out.drop(text) if drop_text else out


def decode(df: DataFrame, path: str, ids: str = "token_ids", decoded: str = "decoded") -> DataFrame:
    """Adds `decoded` (binary) from ids in the layout of `encode`; null ids give empty bytes."""
    base = _keep(df, ids, decoded)

    def work(part: pa.RecordBatch) -> dict[str, pa.Array]:
        return {decoded: pa.array(_encoder(path)[1].decode(part.column(ids).to_pylist()), pa.binary())}

    return _mapped(base, _schema(base, {decoded: "binary"}), work)


def round_trip(df: DataFrame, path: str, text: str = "text") -> DataFrame:
    """`encode` and `decode` in one pass over Python: ids, count and the bytes that the ids stand for; the text goes."""
    added = {"token_ids": "binary", "n_tokens": "bigint", "decoded": "binary"}
    base = _keep(df, text, *added)
    kept = base.drop(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = _encoder(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                ids = encoder.encode(part.column(text).to_pylist())
                rest = {n: c for n, c in zip(part.schema.names, part.columns, strict=True) if n != text}
                yield pa.RecordBatch.from_pydict(rest | {
                    "token_ids": pa.array(ids, pa.binary()), "n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()),
                    "decoded": pa.array(decoder.decode(ids), pa.binary())})

    return base.mapInArrow(run, _schema(kept, added))
