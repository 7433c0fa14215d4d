"""Exact top-k by inner product: ball-tree branch and bound per shard.

Components become whole numbers, floor(UNIT * x). Vectors are dealt out in ranges of their nearest of PIVOTS sampled vectors, so that
a shard holds vectors that lie together (this orders the work and nothing else), and cut into shards of at most SHARD rows and
SHARD_BYTES. Each shard is stored with a ball tree: halves by count along the direction of widest spread, with centre and radius of
every node. An inner product in a node is at most q*c + |q|*r. A query goes down where this bound reaches its k-th score so far and
takes the leaves in the order of their bounds; leaves hold at most LEAF rows.

Queries are worked on in blocks of at most BLOCK, sent to all shards. First a few shards (SEEDS at most) give every query of the block
a k-th score that the search of all shards starts with; a task hands its k-th scores from shard to shard. Every bound is valid
whatever the seeds are, so the result is exact.

Of equal vectors the k + 1 smallest ids can be among the k best of a query; the others are left out before the search, so a
vector that a third of all rows hold costs k + 1 rows.

Defined results: vectors that are null or empty, hold null or non-finite components (also after scaling), or whose inner products would
leave 64 bits (a component of sqrt(2^62 / length) or more) take no part, nor do rows without id. Vectors meet vectors of
the same length only. Equal rows count once. Where an id has several vectors, all are candidates and the smallest
in the order of their bytes is the query. Other columns are not carried, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from govmill.llm.shared import cut, width

UNIT = 1024
EVERY = 100
SHARD, SHARD_BYTES, LEAF = 4096, 4 << 20, 64
BLOCK, BLOCK_BYTES = 4096, 8 << 20
SEEDS, PIVOTS = 64, 256
NOTHING = np.iinfo(np.int64).min


def packed(v: np.ndarray) -> bytes | None:
    """Scaled vector as bytes, equal for equal vectors: 16-bit numbers where they fit, else 64-bit ones. None: takes no part."""
    with np.errstate(over="ignore"):
        scaled = np.floor(UNIT * v)
    if not len(v) or not np.isfinite(scaled).all():
        return None
    top = np.abs(scaled).max()
    if top < 1 << 15:
        return b"h" + scaled.astype("<i2").tobytes()
    return b"q" + scaled.astype("<i8").tobytes() if top < np.sqrt(2.0**62 / len(v)) else None


def unpacked(blobs: list[bytes]) -> np.ndarray:
    """Vectors of one length as rows of 64-bit numbers."""
    return np.stack([np.frombuffer(x, "<i2" if x[:1] == b"h" else "<i8", offset=1).astype(np.int64) for x in blobs])


def vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, dim, vec) of the rows that take part."""
    base = df.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    base = base.where("id is not null and v is not null and not exists(v, x -> x is null or isnan(x))")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("v")
            blobs = [packed(x.values.to_numpy(zero_copy_only=False)) for x in column]
            keep = np.flatnonzero([x is not None for x in blobs])
            dims = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int32)[keep]
            yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(keep)), pa.array(dims, pa.int32()), pa.array([blobs[i] for i in keep], pa.binary())],
                                             names=["id", "dim", "vec"])

    return base.mapInArrow(run, "id bigint, dim int, vec binary")


class Tree:
    """A ball tree over rows of `points`: node i has the children 2 i + 1 and 2 i + 2; all leaves are on the last level."""

    def __init__(self, points: np.ndarray):
        n, x = len(points), points.astype(float)
        self.levels = max(0, int(np.ceil(np.log2(max(1, n) / LEAF))))
        nodes = (2 << self.levels) - 1
        self.order = np.arange(n)
        self.start, self.end = np.zeros(nodes, np.int64), np.zeros(nodes, np.int64)
        self.centre, self.radius = np.zeros((nodes, points.shape[1])), np.zeros(nodes)
        self.end[0] = n
        for i in range(nodes):
            a, b = self.start[i], self.end[i]
            if b > a:
                own = x[self.order[a:b]]
                self.centre[i] = own.mean(axis=0)
                off = own - self.centre[i]
                far = (off * off).sum(axis=1)
                self.radius[i] = np.sqrt(far.max())
                if 2 * i + 1 < nodes:
                    # From the row farthest from the centre to the one farthest from that: about the widest spread.
                    one = own[far.argmax()]
                    other = own[((own - one) ** 2).sum(axis=1).argmax()]
                    half = (b - a) // 2
                    self.order[a:b] = self.order[a:b][np.argpartition(own @ (other - one), half)] if b - a > 1 else self.order[a:b]
            if 2 * i + 1 < nodes:
                middle = a + (b - a) // 2
                self.start[2 * i + 1], self.end[2 * i + 1] = a, middle
                self.start[2 * i + 2], self.end[2 * i + 2] = middle, b


def shards(rows: DataFrame) -> DataFrame:
    """(shard, dim, ids, points, nodes): blocks of rows in the order of their trees, and the trees as bytes."""
    spark = rows.sparkSession
    sample = rows.orderBy(F.xxhash64("vec", "id")).limit(PIVOTS).select("dim", "vec").collect()
    dims = sorted({r.dim for r in sample})
    pivots = {d: unpacked([r.vec for r in sample if r.dim == d]).astype(float) for d in dims}

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dim, pivot = batch.column("dim").to_numpy(), np.zeros(batch.num_rows, np.int32)
            blobs = batch.column("vec").to_pylist()
            for d, p in pivots.items():
                at = np.flatnonzero(dim == d)
                for some in np.array_split(at, 1 + len(at) // 1024):
                    if len(some):
                        pivot[some] = (((p * p).sum(axis=1) / 2) - unpacked([blobs[i] for i in some]).astype(float) @ p.T).argmin(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pivot)], names=["id", "dim", "vec", "pivot"])

    def built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int] = []
        blobs: list[bytes] = []
        dim = size = 0

        def shard() -> pa.RecordBatch:
            points = unpacked(blobs)
            tree = Tree(points)
            points = points[tree.order]
            kind = "<i2" if np.abs(points).max() < 1 << 15 else "<i8"
            row = {"dim": dim, "ids": np.array(ids, "<i8")[tree.order].tobytes(), "points": kind.encode() + points.astype(kind).tobytes(),
                   "bounds": np.stack([tree.start, tree.end]).astype("<i8").tobytes(), "centre": tree.centre.tobytes(), "radius": tree.radius.tobytes()}
            return pa.RecordBatch.from_pylist([row], pa.schema([("dim", pa.int32())] + [(c, pa.binary()) for c in ("ids", "points", "bounds", "centre", "radius")]))

        for batch in batches:
            for i, d, v in zip(*(batch.column(c).to_pylist() for c in ("id", "dim", "vec")), strict=True):
                if ids and (d != dim or len(ids) == SHARD or size + 8 * d > SHARD_BYTES):
                    yield shard()
                    ids, blobs, size = [], [], 0
                dim = d
                ids.append(i)
                blobs.append(v)
                size += 8 * d
        if ids:
            yield shard()

    placed = rows.mapInArrow(near, "id bigint, dim int, vec binary, pivot int")
    dealt = placed.repartitionByRange(width(spark), "dim", "pivot", F.xxhash64("vec", "id")).sortWithinPartitions("dim", "pivot", "vec", "id")
    return dealt.mapInArrow(built, "dim int, ids binary, points binary, bounds binary, centre binary, radius binary")


class Search:
    """The k best of a block of queries so far, by score and then by smaller id."""

    def __init__(self, ids: np.ndarray, points: np.ndarray, floor: np.ndarray, k: int):
        self.ids, self.points, self.k = ids, points, k
        self.norm = np.sqrt((points.astype(float) ** 2).sum(axis=1))
        self.floor = floor.copy()  # no score below this is among the k best
        self.score = np.full((len(ids), k), NOTHING)
        self.found = np.full((len(ids), k), np.iinfo(np.int64).max)
        self.visits = 0

    def scores(self, rows: np.ndarray, points: np.ndarray) -> np.ndarray:
        """Inner products, exact: in floating point where all sums stay below 2^53, else in 64-bit numbers."""
        top = float(np.abs(self.points[rows]).max(initial=0)) * float(np.abs(points).max(initial=0)) * points.shape[1]
        if top < 2.0**53:
            return (self.points[rows].astype(float) @ points.astype(float).T).astype(np.int64)
        return self.points[rows] @ points.T

    def leaf(self, rows: np.ndarray, ids: np.ndarray, points: np.ndarray) -> None:
        self.visits += len(rows)
        score = self.scores(rows, points)
        own = ids[None, :] == self.ids[rows][:, None]
        near = np.flatnonzero(((score >= self.floor[rows][:, None]) & ~own).any(axis=1))
        if not len(near):
            return
        score, own, rows = score[near], own[near], rows[near]
        both = np.concatenate([self.score[rows], np.where(own, NOTHING, score)], axis=1)
        whose = np.concatenate([self.found[rows], np.where(own, np.iinfo(np.int64).max, ids[None, :])], axis=1)
        # ~x turns the order of whole numbers round.
        best = np.lexsort((whose, ~both), axis=1)[:, : self.k]
        self.score[rows], self.found[rows] = np.take_along_axis(both, best, 1), np.take_along_axis(whose, best, 1)
        self.floor[rows] = np.maximum(self.floor[rows], self.score[rows, -1])

    def shard(self, ids: np.ndarray, points: np.ndarray, bounds: np.ndarray, centre: np.ndarray, radius: np.ndarray) -> None:
        nodes = len(radius)
        row, node = np.arange(len(self.ids)), np.zeros(len(self.ids), np.int64)
        size = np.sqrt((centre * centre).sum(axis=1)) + radius
        q = self.points.astype(float)

        def upper(row: np.ndarray, node: np.ndarray) -> np.ndarray:
            bound = np.empty(len(row))
            for at in np.array_split(np.arange(len(row)), 1 + len(row) // 65536):
                bound[at] = (q[row[at]] * centre[node[at]]).sum(axis=1)
            # Rounding never makes a bound too low.
            return bound + self.norm[row] * radius[node] + 1e-9 * self.norm[row] * size[node] + 1e-6

        while True:
            full = bounds[1][node] > bounds[0][node]
            row, node = row[full], node[full]
            high = upper(row, node)
            alive = high >= self.floor[row]
            row, node, high = row[alive], node[alive], high[alive]
            if not len(node) or 2 * node[0] + 1 >= nodes:
                break
            row, node = np.repeat(row, 2), np.stack([2 * node + 1, 2 * node + 2], axis=1).ravel()
        # Round by round, every query takes its next best leaf, as long as the bound reaches its k-th score.
        order = np.lexsort((node, -high, row))
        row, node, high = row[order], node[order], high[order]
        first = np.flatnonzero(np.append(True, row[1:] != row[:-1])) if len(row) else np.zeros(0, np.int64)
        turn = np.arange(len(row)) - np.repeat(first, np.diff(np.append(first, len(row))))
        for r in range(int(turn.max(initial=-1)) + 1):
            at = np.flatnonzero(turn == r)
            at = at[high[at] >= self.floor[row[at]]]
            at = at[np.argsort(node[at], kind="stable")]
            for some in np.split(at, np.flatnonzero(np.diff(node[at])) + 1) if len(at) else ():
                a, b = bounds[0][node[some[0]]], bounds[1][node[some[0]]]
                self.leaf(row[some], ids[a:b], points[a:b])


def searched(trees: DataFrame, asked: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]], k: int) -> DataFrame:
    """(query_id, score, vec_id): at most k rows per query and task, none below the query's floor. `asked`: ids, points, floors by length."""
    sent = trees.sparkSession.sparkContext.broadcast(asked)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: dict[int, Search] = {}
        for batch in batches:
            for r in batch.to_pylist():
                if r["dim"] not in sent.value:
                    continue
                if r["dim"] not in open_:
                    open_[r["dim"]] = Search(*sent.value[r["dim"]], k)
                d, kind = r["dim"], r["points"][:3].decode()
                open_[d].shard(np.frombuffer(r["ids"], "<i8"), np.frombuffer(r["points"], kind, offset=3).reshape(-1, d).astype(np.int64),
                               np.frombuffer(r["bounds"], "<i8").reshape(2, -1), np.frombuffer(r["centre"]).reshape(-1, d), np.frombuffer(r["radius"]))
        for s in open_.values():
            row, column = np.nonzero((s.score > NOTHING) & (s.score >= s.floor[:, None]))
            yield pa.RecordBatch.from_arrays([pa.array(s.ids[row]), pa.array(s.score[row, column]), pa.array(s.found[row, column])], names=["query_id", "score", "vec_id"])

    return trees.mapInArrow(run, "query_id bigint, score bigint, vec_id bigint")


def ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", every: int = EVERY, k: int = 10, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of highest inner product of every row whose id is divisible by `every`."""
    spark = df.sparkSession
    rows = cut(vectors(df, id_col, vector_col).dropDuplicates(["id", "vec"]))
    first = Window.partitionBy("vec").orderBy("id")
    trees = cut(shards(rows.withColumn("copy", F.row_number().over(first)).where(F.col("copy") <= k + 1).drop("copy")))
    queries = cut(rows.where(F.col("id") % every == 0).groupBy("id").agg(F.min("vec").alias("vec"), F.min_by("dim", "vec").alias("dim")))
    size = queries.agg(F.count("*").alias("n"), F.max("dim").alias("dim")).first()
    blocks = -(-size.n // max(1, min(block, BLOCK_BYTES // (8 * (size.dim or 1))))) or 1
    n_shards = trees.count()
    seeds = trees.where(F.pmod(F.xxhash64("ids"), F.lit(n_shards)) < max(1, min(SEEDS, n_shards // 8))) if n_shards else trees
    out = None
    for b in range(blocks):
        some = queries.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b).orderBy("id").collect()
        asked = {}
        for d in {r.dim for r in some}:
            own = [r for r in some if r.dim == d]
            asked[d] = np.array([r.id for r in own], np.int64), unpacked([r.vec for r in own]), np.full(len(own), NOTHING)
        known = {r.query_id: r.score for r in ranked(searched(seeds, asked, k), k).where(F.col("rank") == k).collect()}
        for ids, _, floor in asked.values():
            floor[:] = [known.get(i, NOTHING) for i in ids.tolist()]
        best = ranked(searched(trees, asked, k), k)
        if blocks > 1:
            best = cut(best)
        out = best if out is None else out.unionByName(best)
    return out.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id"), "score")
