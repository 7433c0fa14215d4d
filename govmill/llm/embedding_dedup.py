"""Near-duplicate embeddings by E8 lattice hashing, with exact cosine checks.

Vectors of a label are scaled to length 1; equal ones count once, with their number. Each of TABLES random projections to eight
dimensions is decoded to the nearest point of the E8 lattice, which is the vector's home cell; it also probes the
PROBES next nearest of the neighbouring points. Vectors meet in a cell if it is the home of one and home or probe of the other;
their cosine is then computed in double precision. A pair is counted at its first meeting only (table, then the smaller
cell), which both vectors' cells tell without looking elsewhere, so no pair leaves a task.

A cell with more than CELL vectors is dealt out as pairs of blocks, so one very common vector neighbourhood is shared by
many tasks. What leaves a task is a row per vector: links found there, and the smallest vector it is connected with.

SCALE sets the size of cells against the distance of a link (0.2 at cosine 0.98): of random pairs at that limit, 0.9994 meet. For many more vectors per label, raise it
and TABLES together: cells shrink with its eighth power.

Defined results: vectors that are null, empty, zero or hold null or non-finite components, and those with a null label, have
0 links and are their own component (null id: null component). Vectors of different lengths never link. Copies of a vector
link with each other. Every input row gives one row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from govmill.llm.ragged import mixed
from govmill.llm.shared import components, cut, runs, width

LEAST = 0.98
TABLES = 6
PROBES = 2
SCALE = 1.0
CELL = 1024
SEED = 8


def neighbours() -> np.ndarray:
    """The 240 shortest vectors of E8: two coordinates of +-1, or all +-1/2 with an even number of minus signs."""
    out = []
    for i in range(8):
        for j in range(i):
            for a in (-1, 1):
                for b in (-1, 1):
                    v = np.zeros(8)
                    v[i], v[j] = a, b
                    out.append(v)
    for signs in range(256):
        v = np.array([-0.5 if signs >> k & 1 else 0.5 for k in range(8)])
        if bin(signs).count("1") % 2 == 0:
            out.append(v)
    return np.array(out)


def decode_d8(x: np.ndarray) -> np.ndarray:
    """Nearest integer points with an even sum: round, and where the sum is odd round the worst coordinate the other way."""
    near = np.rint(x)
    odd = np.flatnonzero(near.sum(axis=1) % 2 != 0)
    off = x[odd] - near[odd]
    worst = np.abs(off).argmax(axis=1)
    near[odd, worst] += np.where(off[np.arange(len(odd)), worst] >= 0, 1.0, -1.0)
    return near


def decode(x: np.ndarray) -> np.ndarray:
    """Nearest E8 points: the nearer of D8 and D8 shifted by one half."""
    whole, half = decode_d8(x), decode_d8(x - 0.5) + 0.5
    nearer = ((x - whole) ** 2).sum(axis=1) <= ((x - half) ** 2).sum(axis=1)
    return np.where(nearer[:, None], whole, half)


def cell_keys(points: np.ndarray, table: int, label: np.ndarray, dim: int) -> np.ndarray:
    """Vectors of another label or length never share a cell."""
    key = mixed(mixed(label.astype(np.int64).view(np.uint64) * np.uint64(64) + np.uint64(table)) ^ np.uint64(dim))
    for j in range(8):
        key = mixed(key ^ (np.rint(2 * points[..., j]).astype(np.int64).view(np.uint64) + np.uint64(0x9E37 * (j + 1))))
    return key


def cells(unit: np.ndarray, label: np.ndarray, tables: int = TABLES, probes: int = PROBES, scale: float = SCALE) -> tuple[np.ndarray, np.ndarray]:
    """Home cells (n, tables) and probed cells (n, tables, probes) of unit vectors."""
    short = neighbours()
    home = np.empty((len(unit), tables), np.uint64)
    near = np.empty((len(unit), tables, probes), np.uint64)
    for t in range(tables):
        way = np.random.default_rng(SEED + 1000 * unit.shape[1] + t).standard_normal((unit.shape[1], 8))
        y = unit @ way * scale
        point = decode(y)
        home[:, t] = cell_keys(point, t, label, unit.shape[1])
        # The nearest of the points around home: smallest |n|^2 - 2 n (y - home), and all n are equally long.
        best = np.argpartition(-((y - point) @ short.T), probes, axis=1)[:, :probes]
        near[:, t] = cell_keys(point[:, None, :] + short[best], t, label[:, None], unit.shape[1])
    return home, near


def vectors(df: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(id, node, label, unit) of each row; node and unit are null for vectors that link with nothing."""
    rows = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("bigint").alias("label"),
                     F.col(f"`{vector_col}`").cast("array<double>").alias("v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, unit = [], []
            for label, v in zip(batch.column("label").to_pylist(), batch.column("v"), strict=True):
                x = None if label is None or not v.is_valid else v.values.to_numpy(zero_copy_only=False).astype(float)
                # A factor first: squares of very large or small components would leave the range of numbers.
                top = np.abs(x).max() if x is not None and len(x) and np.isfinite(x).all() else 0.0
                if not top > 0:
                    node.append(None)
                    unit.append(None)
                    continue
                x = x / top
                x = x / np.sqrt((x * x).sum())
                node.append(int.from_bytes(hashlib.blake2b(x.tobytes() + str(label).encode(), digest_size=8).digest(), "little", signed=True))
                unit.append(x.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(node, pa.int64()), batch.column("label"), pa.array(unit, pa.binary())],
                                             names=["id", "node", "label", "unit"])

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, node bigint, label bigint, unit binary")


def placed(reps: DataFrame) -> DataFrame:
    """One row per (node, cell) of home and probed cells, with the vector and all its cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = np.array([len(x) for x in batch.column("unit").to_pylist()])
            for dim in np.unique(size).tolist():
                for at in np.array_split(np.flatnonzero(size == dim), 1 + (size == dim).sum() // 1024):
                    if not len(at):
                        continue
                    part = batch.take(pa.array(at))
                    unit = np.frombuffer(b"".join(part.column("unit").to_pylist())).reshape(len(at), -1)
                    home, near = cells(unit, part.column("label").to_numpy())
                    both = np.concatenate([home[:, :, None], near], axis=2)
                    marks = [x.tobytes() for x in np.ascontiguousarray(both)]
                    for t in range(home.shape[1]):
                        for k in range(both.shape[2]):
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(both[:, t, k].view(np.int64)), pa.array(np.full(len(at), t)), pa.array(np.full(len(at), k == 0)),
                                 part.column("node"), part.column("copies"), part.column("unit"), pa.array(marks, pa.binary())],
                                names=["cell", "tab", "home", "node", "copies", "unit", "marks"])

    return reps.mapInArrow(run, "cell bigint, tab bigint, home boolean, node bigint, copies bigint, unit binary, marks binary")


def meet(marks: np.ndarray, i: np.ndarray, j: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
    """For pairs (i, j) in table t: whether the home of i is a cell of j, and the home of j one of i."""
    a = (marks[i, t, :1] == marks[j, t]).any(axis=1)
    b = (marks[j, t, :1] == marks[i, t]).any(axis=1)
    return a, b


def cell_links(unit: np.ndarray, marks: np.ndarray, home: np.ndarray, cell: int, t: int, left: np.ndarray, right: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs (one from left, one from right) whose first meeting is this cell of this table."""
    out_i, out_j = [], []
    step = max(1, 4_000_000 // max(1, len(right)))
    for at in range(0, len(left), step):
        some = left[at: at + step]
        a, b = np.nonzero(unit[some] @ unit[right].T >= least)
        i, j = some[a], right[b]
        keep = (i < j) if left is right else np.ones(len(i), bool)
        keep &= home[i] | home[j]
        i, j = i[keep], j[keep]
        for earlier in range(t):
            x, y = meet(marks, i, j, earlier)
            i, j = i[~(x | y)], j[~(x | y)]
        x, y = meet(marks, i, j, t)
        first = np.where(x & y, np.minimum(marks[i, t, 0], marks[j, t, 0]), np.where(x, marks[i, t, 0], marks[j, t, 0]))
        mine = first == np.int64(cell).view(np.uint64)
        out_i.append(i[mine])
        out_j.append(j[mine])
    none = np.zeros(0, np.int64)
    return np.concatenate(out_i or [none]), np.concatenate(out_j or [none])


def roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest place that each of n places is connected with."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        after = root.copy()
        np.minimum.at(after, i, low)
        np.minimum.at(after, j, low)
        np.minimum.at(after, root[i], low)
        np.minimum.at(after, root[j], low)
        after = after[after]
        if (after == root).all():
            return root
        root = after


def found_links(spots: DataFrame, least: float) -> DataFrame:
    """(node, links, root) per node and block of a cell: weight of its links there, and the node that stands for its class."""
    counts = spots.groupBy("cell").agg(F.count("*").alias("c"), F.max("home").alias("any_home")).where("c > 1 and any_home")
    counts = counts.select("cell", F.ceil(F.col("c") / CELL).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = spots.join(counts, "cell").withColumn("own", block)
    # Blocks x <= y: a row of block k goes to every pair that holds k.
    pair = F.explode(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda x: F.least(x, F.col("own")) * 65536 + F.greatest(x, F.col("own"))))
    dealt = (dealt.withColumn("pair", pair).drop("blocks", "c")
             .repartition(width(spots.sparkSession), "cell", "pair").sortWithinPartitions("cell", "pair", "node", "home"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, ["cell", "pair"]):
            node, copies, own, home = (group.column(c).to_numpy() for c in ("node", "copies", "own", "home"))
            # A vector is in a cell once; as home, if it is that.
            keep = np.append(node[1:] != node[:-1], True)
            if keep.sum() < 2:
                continue
            at = np.flatnonzero(keep)
            part = group.take(pa.array(at))
            blobs = part.column("unit").to_pylist()
            node, copies, own, home = node[at], copies[at], own[at], home[at]
            cell, t, pair = group.column("cell")[0].as_py(), group.column("tab")[0].as_py(), group.column("pair")[0].as_py()
            marks = np.frombuffer(b"".join(part.column("marks").to_pylist()), np.uint64).reshape(len(at), TABLES, 1 + PROBES)
            unit = np.frombuffer(b"".join(blobs)).reshape(len(at), -1)
            x, y = np.flatnonzero(own == pair // 65536), np.flatnonzero(own == pair % 65536)
            i, j = cell_links(unit, marks, home, cell, t, x, x if pair // 65536 == pair % 65536 else y, least)
            if not len(i):
                continue
            links = np.zeros(len(at), np.int64)
            np.add.at(links, i, copies[j])
            np.add.at(links, j, copies[i])
            root = roots(len(at), i, j)
            some = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays([pa.array(node[some]), pa.array(links[some]), pa.array(node[root[some]])], names=["node", "links", "root"])

    return dealt.mapInArrow(run, "node bigint, links bigint, root bigint")


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", least: float = LEAST) -> DataFrame:
    """One row per vector: id, n_links, component_id, kept."""
    rows = cut(vectors(df, id_col, vector_col, label_col))
    reps = rows.where("node is not null").groupBy("node", "label", "unit").agg(F.count("*").alias("copies"))
    found = cut(found_links(cut(placed(reps)), least))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    label = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")).where("a != b"))
    copies = reps.select("node", "copies")
    member = (rows.select("id", "node").join(copies, "node", "left").join(links, "node", "left").join(label, "node", "left")
              .withColumn("label", F.coalesce("label", "node")))
    smallest = member.where("node is not null").groupBy("label").agg(F.min("id").alias("component_id"))
    out = member.join(smallest, "label", "left")
    n_links = F.coalesce(F.col("copies") - 1, F.lit(0)) + F.coalesce("links", F.lit(0))
    component = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    return out.select(F.col("id").alias(id_col), n_links.cast("bigint").alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))
