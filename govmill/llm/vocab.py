"""Merge tables of public byte-level vocabularies, read from the files of their libraries."""

from __future__ import annotations

import base64
import json
from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Merges:
    """`keys`: pairs of symbols as left * size + right, sorted; `rank` and `made` belong to them.

    A vocabulary is bounded by its file (50,000 merges here: 1 MB), so every task may hold it.
    """

    size: int
    first: np.ndarray  # symbol of each of the 256 bytes
    keys: np.ndarray
    rank: np.ndarray
    made: np.ndarray
    special: tuple[str, ...] = ()

    def find(self, key: np.ndarray) -> np.ndarray:
        """Positions of pairs in the table; -1 for none."""
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, at, -1)

    def checked(self) -> "Merges":
        """Itself, if no merge makes a pair of a lower rank: then all places of the lowest pair can merge at once."""
        born = np.full(self.size, -1, np.int64)
        np.maximum.at(born, self.made, self.rank)
        late = np.maximum(born[self.keys // self.size], born[self.keys % self.size]) >= self.rank
        if late.any():
            raise ValueError(f"{late.sum()} merges come before their parts; all places of a pair can't be merged at once")
        return self


def _table(size: int, first: list[int], rows: list[tuple[int, int, int, int]], special: tuple[str, ...] = ()) -> Merges:
    left, right, rank, made = (np.array(x, np.int64) for x in zip(*rows, strict=True)) if rows else [np.zeros(0, np.int64)] * 4
    order = np.argsort(left * size + right)
    return Merges(size, np.array(first, np.int64), (left * size + right)[order], rank[order], made[order], special)


def byte_letters() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabulary files: itself, or the next free letter from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def from_json(path: str) -> Merges:
    """Merges listed in a .json file; only the listed pairs merge. Special strings in a text are tokens by themselves."""
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    vocab, letters = file["model"]["vocab"], byte_letters()
    first = [0] * 256
    for letter, byte in letters.items():
        first[byte] = vocab[letter]
    pairs = [x if isinstance(x, list) else x.split(" ") for x in file["model"]["merges"]]
    rows = [(vocab[a], vocab[b], rank, vocab[a + b]) for rank, (a, b) in enumerate(pairs)]
    special = tuple(x["content"] for x in file["added_tokens"])
    return _table(max(vocab.values()) + 1, first, rows, special).checked()


def from_ranks(path: str) -> tuple[Merges, list[bytes]]:
    """Ranks of a .tiktoken file: any two neighbours merge that give a ranked token. Also the bytes of each id."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    size = max(ranks.values()) + 1
    rows = [(ranks[token[:k]], ranks[token[k:]], rank, rank) for token, rank in ranks.items() for k in range(1, len(token))
            if token[:k] in ranks and token[k:] in ranks]
    table = [b""] * size
    for token, rank in ranks.items():
        table[rank] = token
    return _table(size, [ranks[bytes([b])] for b in range(256)], rows), table
