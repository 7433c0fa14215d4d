"""Exact n-gram Jaccard self-join of documents by T-occurrence search, and the classes that its links make.

Sets of 5-word shingles that are equal count once, as one node. Two sets of n and m shingles link when they share at
least T = ceil(s (n + m) / (1 + s)) of them.

1. Inverted lists. A node enters the lists of the first n - ceil(s n) + k of its shingles, those that are frequent in a sample
   of documents last, with k = 1 + n / 10. Two linked nodes always meet in as many of these lists as the smaller k, whatever
   the order; so the sample decides about speed alone. Nodes that share fewer lists than that with all others
   together drop out, twice: what shares a passage with others and little else does not stay.
2. Candidates, in two rounds. In each list (and band of lengths) all nodes are compared with the smallest one, which gives no
   more pairs than nodes; links make classes. Then the nodes of a list that are still in different classes are
   compared with each other inside the tasks that hold blocks of the list: bit maps tell which may have the overlap that a link needs, these
   come back with their sets, and the block is searched in place. What leaves it are fewer edges than it has nodes.
3. T-occurrence search of each query in blocks of its candidates (DivideSkip): of the candidates' inverted lists the
   shorter ones are merged with a heap, the L longest are only probed by binary search, and those that reach T remain.

Defined results: a null text, or one without words, has an empty set (n_shingles 0) and is linked with nothing. Texts of fewer
than five words have one shingle, their whole sequence. Equal sets link. Every input row gives one row, repeated rows too; a
row without id takes no part and has no component. Columns other than id and text are not read. Keys have 64
bits: two different shingles of one candidate pair share one with probability 2^-64.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from govmill.llm import words
from govmill.llm.ragged import mixed
from govmill.llm.shared import components, cut, runs, small_enough, stored, whole_runs, width

SAMPLE_DOCS = 8192  #: about so many documents tell which shingles are frequent
FREQUENT = 4  #: in so many of them
ORDER_BOUND = 1_000_000  #: at most so many frequent shingles are put last (8 MB)
PRUNINGS = 2
EXTRA = 10  #: a node enters one more list for each so many shingles, and has to share as many more
FIRST_LISTS = 16  #: the smallest of its lists that a node carries, so that a pair found in many lists leaves from one
SMALL = 24  #: nodes of a list that are compared one by one
LIST_BLOCK = 4096  #: nodes of a list, and as many of other classes, that one task compares
BLOCK = 256  #: candidates of a query that one search takes at a time
SEND_BOUND = 1_000_000  #: node ids that may be sent to every task (8 MB)


def required(n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """Least overlap of linked sets of n and m shingles."""
    return -(-percent * (n + m) // (100 + percent))


def shared_lists(n: np.ndarray) -> np.ndarray:
    """In how many lists a node of n shingles must meet each node that it links with."""
    return 1 + n // EXTRA


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64), pa.int64())


def set_keys(key: np.ndarray, bound: np.ndarray) -> np.ndarray:
    """64-bit keys of sets of shingles: equal for equal sets."""
    total = np.zeros(len(key) + 1, np.uint64)
    np.cumsum(mixed(key ^ np.uint64(0x5BD1E995)), out=total[1:])
    return mixed(total[bound[1:]] - total[bound[:-1]] + mixed(np.diff(bound)))


def parity_bits(key: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A bit map of each set, whose bits tell whether an odd number of shingles fall on them, and the offsets of the maps.

    A map has at least as many bits as its set has shingles, a power of two. The bits in which two maps differ are
    at most as many as the shingles that one set has and the other has not. Halves XORed give the map of half the size.
    """
    n = np.diff(bound)
    size = np.left_shift(1, np.ceil(np.log2(np.maximum(n, 64))).astype(np.int64))
    offset = np.concatenate([[0], np.cumsum(size)])
    row = np.repeat(np.arange(len(n)), n)
    place = offset[:-1][row] + (mixed(key ^ np.uint64(0x2545F4914F6CDD1D)) & (size[row] - 1).astype(np.uint64)).astype(np.int64)
    odd = (np.bincount(place, minlength=offset[-1]) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view(np.int64), (offset // 64).astype(np.int32)


#: Bits in which two maps differ, after folding the larger one to the size of the smaller (at most twice as large).
_FOLD = "if(size({a}) > size({b}), zip_with(slice({a}, 1, cast(size({a}) / 2 as int)), slice({a}, cast(size({a}) / 2 as int) + 1, cast(size({a}) / 2 as int)), (x, y) -> x ^ y), {a})"
_DIFFER = f"aggregate(zip_with({_FOLD.format(a='bits', b='query_bits')}, {_FOLD.format(a='query_bits', b='bits')}, (x, y) -> bit_count(x ^ y)), 0, (s, x) -> s + x)"


def possible(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Those (node, query) whose bit maps do not rule out that they link: overlap <= (n + m - differing bits) / 2."""
    mine = reps.select("node", "n", "bits")
    other = reps.select(F.col("node").alias("query"), F.col("n").alias("m"), F.col("bits").alias("query_bits"))
    bound = f"(n + m - {_DIFFER}) * (100 + {percent}) >= 2 * {percent} * (n + m)"
    return pairs.join(mine, "node").join(other, "query").where(bound).select("node", "query")


def _frequent(docs: DataFrame, size: int) -> np.ndarray:
    """Shingles that are frequent in the sample, sorted; only the order of prefixes depends on them."""
    total = max(1, docs.count())
    part = docs.where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < math.ceil(1e6 * min(1.0, SAMPLE_DOCS / total)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in words.slices(batch, "text"):
                yield pa.RecordBatch.from_arrays([_signed(words.shingle_sets(piece.column("text"), size)[0])], names=["h"])

    often = (part.select("text").mapInArrow(run, "h bigint").groupBy("h").count().where(F.col("count") >= FREQUENT)
             .orderBy(F.desc("count"), "h").limit(ORDER_BOUND).select("h"))
    return np.sort(np.array(often.toArrow().column("h").to_numpy(), np.int64).view(np.uint64))


def nodes(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """(id, n, node, prefix, bits) of every document; documents with equal sets have the same node."""
    late = docs.sparkSession.sparkContext.broadcast(_frequent(docs, size))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = late.value
        for batch in batches:
            for piece in words.slices(batch, "text"):
                key, bound = words.shingle_sets(piece.column("text"), size)
                n = np.diff(bound)
                row = np.repeat(np.arange(len(n)), n)
                at = np.minimum(np.searchsorted(frequent, key), max(0, len(frequent) - 1))
                hot = frequent[at] == key if len(frequent) else np.zeros(len(key), bool)
                order = np.lexsort((key, hot, row))
                take = n - -(-percent * n // 100) + shared_lists(n)
                take[n == 0] = 0
                place = np.arange(len(key)) - bound[:-1][row]
                prefix = key[order][place < take[row]]
                node = set_keys(key, bound)
                offset = np.concatenate([[0], np.cumsum(take)]).astype(np.int32)
                bits, place = parity_bits(key, bound)
                yield pa.RecordBatch.from_arrays(
                    [piece.column("id"), pa.array(n, pa.int64()), _signed(node), pa.ListArray.from_arrays(pa.array(offset), _signed(prefix)),
                     pa.ListArray.from_arrays(pa.array(place), pa.array(bits))], names=["id", "n", "node", "prefix", "bits"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"id {kind}, n bigint, node bigint, prefix array<bigint>, bits array<bigint>")


def sets_of(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(node, shingles) for the wanted (id, node); shingles are sorted 64-bit keys in binary form."""
    wanted = wanted.select("id", "node")
    if small_enough(wanted, SEND_BOUND):
        wanted = F.broadcast(wanted)
    picked = docs.join(wanted, "id").select("node", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in words.slices(batch, "text"):
                key, bound = words.shingle_sets(piece.column("text"), size)
                # An id that stands for several texts meets all of them here; each node keeps its own.
                own = set_keys(key, bound).view(np.int64) == piece.column("node").to_numpy()
                blobs = [key[a:b].tobytes() for a, b in zip(bound[:-1][own].tolist(), bound[1:][own].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([piece.column("node").filter(pa.array(own)), pa.array(blobs, pa.binary())],
                                                 names=["node", "shingles"])

    return picked.mapInArrow(run, "node bigint, shingles binary")


def divide_skip(lists: list[np.ndarray], least: int, weight: float = 0.01) -> tuple[np.ndarray, np.ndarray]:
    """Candidates that occur in at least `least` of the sorted lists, and in how many.

    The longest lists are set aside, fewer than `least` of them; the others are merged with a heap, and who is in enough of them
    to reach `least` with the help of those set aside is looked up in each by binary search.
    """
    lists = sorted((x for x in lists if len(x)), key=len)
    if least < 1 or len(lists) < least:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    aside = min(least - 1, int(least / (weight * math.log(len(lists[-1]) + 1) + 1)))
    short, long = lists[: len(lists) - aside], lists[len(lists) - aside:]
    found, count, last, seen = [], [], -1, 0
    for x in [*heapq.merge(*(x.tolist() for x in short)), -1]:
        if x == last:
            seen += 1
            continue
        if seen >= least - aside and last >= 0:
            found.append(last)
            count.append(seen)
        last, seen = x, 1
    ids, total = np.array(found, np.int64), np.array(count, np.int64)
    for x in long:
        at = np.minimum(np.searchsorted(x, ids), len(x) - 1)
        total += x[at] == ids
    reach = total >= least
    return ids[reach], total[reach]


def search(query: np.ndarray, sets: list[np.ndarray], percent: int) -> dict[int, int]:
    """Overlaps of those sets that link with the query, by T-occurrence search."""
    size = np.array([len(x) for x in sets], np.int64)
    flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), size)
    at = np.minimum(np.searchsorted(query, flat), len(query) - 1)
    shared = query[at] == flat
    at, owner = at[shared], owner[shared]
    order = np.argsort(at, kind="stable")
    at, owner = at[order], owner[order]
    lists = np.split(owner, np.flatnonzero(np.diff(at)) + 1) if len(at) else []
    need = required(np.int64(len(query)), size, percent)
    ids, total = divide_skip(lists, int(need.min()))
    return {i: t for i, t in zip(ids.tolist(), total.tolist(), strict=True) if t >= need[i]}


def verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Linked pairs (node, query) of candidates (query, node): one search per query and block of candidates."""
    blocks = pairs.groupBy("query").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    candidates = (pairs.join(blocks, "query").withColumn("block", F.pmod(F.xxhash64("node"), "blocks"))
                  .join(sets.select("node", "shingles"), "node")
                  .select("query", "block", F.lit(1).alias("is_candidate"), "node", "shingles"))
    queries = (blocks.select("query", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("block"))
               .join(sets.select(F.col("node").alias("query"), "shingles"), "query")
               .select("query", "block", F.lit(0).alias("is_candidate"), F.col("query").alias("node"), "shingles"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, ["query", "block"]):
            blobs = [np.frombuffer(x, np.uint64) for x in group.column("shingles").to_pylist()]
            node = group.column("node").to_numpy()
            hits = search(blobs[0], blobs[1:], percent)
            if hits:
                found = np.array(sorted(hits)) + 1
                yield pa.RecordBatch.from_arrays([pa.array(node[found]), pa.array(np.full(len(found), node[0]))], names=["a", "b"])

    dealt = (candidates.unionByName(queries).repartition(width(pairs.sparkSession), "query", "block")
             .sortWithinPartitions("query", "block", "is_candidate"))
    return dealt.mapInArrow(run, "a bigint, b bigint")


def _near(a: str, b: str, percent: int) -> str:
    """SQL: whether sets of two sizes can link at all."""
    return f"100 * least({a}, {b}) >= {percent} * greatest({a}, {b})"


def links(docs: DataFrame, rows: DataFrame, size: int, percent: int) -> DataFrame:
    """Edges (a, b) between nodes that have the same classes as all links."""
    reps = rows.where("n > 0 and id is not null").groupBy("node").agg(
        *[F.min_by(c, "id").alias(c) for c in ("prefix", "bits")], F.min("n").alias("n"), F.min("id").alias("id"))
    posting = reps.select("node", "id", "n", F.explode("prefix").alias("h"))
    posting = cut(_crowded(posting))
    for _ in range(PRUNINGS):
        # Who shares fewer lists with all others together than with its smallest possible partner cannot link; then others fall.
        enough = posting.groupBy("node").agg(F.count("*").alias("c"), F.first("n").alias("n")).where(f"c >= 1 + floor({percent} * n / {100 * EXTRA})")
        posting = cut(_crowded(posting.join(enough.select("node"), "node", "left_semi")))
    reps = cut(reps.drop("prefix").join(posting.select("node").distinct(), "node", "left_semi"))

    def linked(pairs: DataFrame) -> DataFrame:
        pairs = stored(possible(pairs, reps, percent))
        nodes_ = pairs.select("node").unionByName(pairs.select(F.col("query").alias("node"))).distinct()
        return stored(verify(pairs, sets_of(docs, reps.select("id", "node").join(nodes_, "node", "left_semi"), size), percent))

    band = F.floor(F.log(F.col("n").cast("double")) / math.log(100 / percent))
    lists = posting.withColumn("band", band)
    least = lists.groupBy("h", "band").agg(F.min(F.struct("node", "n")).alias("q"))
    known = cut(lists.join(least, ["h", "band"]).where("node != q.node").where(_near("n", "q.n", percent))
                .select("node", F.col("q.node").alias("query")).distinct())
    found = linked(known)
    # What is left in a list: nodes of other classes than its largest, against all of them.
    return found.unionByName(_across(_labelled(posting, found), reps, docs, size, percent))


def close_pairs(n: np.ndarray, label: np.ndarray, bits: list[np.ndarray], others: int, percent: int) -> list[tuple[int, int]]:
    """Pairs (i, j) of different labels, i among the first `others` nodes, that sizes and bit maps do not rule out."""
    size = np.array([len(x) for x in bits])
    maps = {s: (np.flatnonzero(size == s), np.stack([bits[i] for i in np.flatnonzero(size == s)])) for s in np.unique(size).tolist()}
    out: list[tuple[int, int]] = []
    for s, (left, left_map) in maps.items():
        left_map, left = left_map[left < others], left[left < others]
        for t in (s // 2, s, 2 * s):
            if t not in maps or not len(left):
                continue
            right, right_map = maps[t]
            a = left_map if t >= s else left_map[:, :t] ^ left_map[:, t:]
            b = right_map if t <= s else right_map[:, :s] ^ right_map[:, s:]
            step = max(1, 2_000_000 // (len(right) * a.shape[1]))
            for at in range(0, len(left), step):
                i = left[at: at + step]
                differ = np.bitwise_count(a[at: at + step, None, :] ^ b[None]).sum(axis=2, dtype=np.int64)
                both = n[i][:, None] + n[right][None]
                fits = (both - differ) * (100 + percent) >= 2 * percent * both
                fits &= 100 * np.minimum(n[i][:, None], n[right][None]) >= percent * np.maximum(n[i][:, None], n[right][None])
                fits &= label[i][:, None] != label[right][None]
                x, y = np.nonzero(fits)
                out += zip(i[x].tolist(), right[y].tolist(), strict=True)
    return out


def few_pairs(n: np.ndarray, label: np.ndarray, bits: list[np.ndarray], others: int, percent: int) -> list[tuple[int, int]]:
    """What `close_pairs` gives, for short lists."""
    n, label, out = n.tolist(), label.tolist(), []
    maps = [int.from_bytes(x.tobytes(), "little") for x in bits]
    for i in range(others):
        for j in range(len(n)):
            both = n[i] + n[j]
            if label[i] == label[j] or 100 * min(n[i], n[j]) < percent * max(n[i], n[j]):
                continue
            x, y, size = maps[i], maps[j], 64 * min(len(bits[i]), len(bits[j]))
            if len(bits[i]) * 64 > size:
                x = (x >> size) ^ (x & ((1 << size) - 1))
            if len(bits[j]) * 64 > size:
                y = (y >> size) ^ (y & ((1 << size) - 1))
            if (both - (x ^ y).bit_count()) * (100 + percent) >= 2 * percent * both:
                out.append((i, j))
    return out


def pairs_to_check(n: np.ndarray, label: np.ndarray, bits: list[np.ndarray], others: int, percent: int) -> list[tuple[int, int]]:
    return (few_pairs if len(n) <= SMALL else close_pairs)(n, label, bits, others, percent)


def _dealt(lists: DataFrame, facts: DataFrame) -> DataFrame:
    """The nodes of lists of several classes, in blocks: a node outside the largest class (role 0) meets all nodes (role 1) of its list.

    A task holds one block of the former and one of the latter, however long a list is.
    """
    sizes = lists.groupBy("h", "label").agg(F.count("*").alias("c"))
    blocks = (sizes.groupBy("h").agg(F.max(F.struct("c", "label")).alias("top"), F.count("*").alias("labels"), F.sum("c").alias("size"))
              .where("labels > 1")
              .select("h", F.col("top.label").alias("top"), F.ceil(F.col("size") / LIST_BLOCK).alias("blocks"),
                      F.ceil((F.col("size") - F.col("top.c")) / LIST_BLOCK).alias("others")))
    members = lists.join(blocks, "h").join(facts, "node")
    mine = lambda many: F.pmod(F.xxhash64("node"), many)
    each = lambda many: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(many) - 1))
    columns = ["h", "block", "other", "role", "node", "n", "label", "bits", "lists"]
    inside = members.withColumn("block", mine("blocks")).withColumn("other", each("others")).withColumn("role", F.lit(1))
    outside = members.where("label != top").withColumn("block", each("blocks")).withColumn("other", mine("others")).withColumn("role", F.lit(0))
    return (inside.select(columns).unionByName(outside.select(columns)).repartition(width(lists.sparkSession), "h", "block", "other")
            .sortWithinPartitions("h", "block", "other", "role"))


def _marked(dealt: DataFrame, percent: int) -> DataFrame:
    """(h, block, other, role, node): the nodes of each block that size and bit map let link with one of another class there.

    A pair marks its nodes in the first list that both are in, if that is known: the smallest common one of their first lists.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, bound in whole_runs(batches, ["h", "block", "other"]):
            h, node, n, label, role = (part.column(c).to_numpy() for c in ("h", "node", "n", "label", "role"))
            bits, lists_ = (part.column(c) for c in ("bits", "lists"))
            maps, at = bits.values.to_numpy().view(np.uint64), bits.offsets.to_numpy().tolist()
            first, to = lists_.values.to_numpy(), lists_.offsets.to_numpy().tolist()
            marks = np.zeros(part.num_rows, bool)
            for a, b in zip(bound[:-1], bound[1:], strict=True):
                others = int(np.searchsorted(role[a:b], 1))
                if not others:
                    continue
                some = [maps[at[i]: at[i + 1]] for i in range(a, b)]
                for i, j in pairs_to_check(n[a:b], label[a:b], some, others, percent):
                    x, y = a + i, a + j
                    if marks[x] and marks[y]:
                        continue
                    common = set(first[to[x]: to[x + 1]].tolist()) & set(first[to[y]: to[y + 1]].tolist())
                    if min(common, default=h[a]) == h[a]:
                        marks[x] = marks[y] = True
            if marks.any():
                yield part.select(["h", "block", "other", "role", "node"]).filter(pa.array(marks))

    return dealt.mapInArrow(run, "h bigint, block bigint, other bigint, role int, node bigint")


class Classes:
    """Union-find over the nodes of a block; nodes of one label start in one class."""

    def __init__(self, label: np.ndarray):
        self.root = np.unique(label, return_inverse=True)[1]

    def join(self, i: int, j: int) -> bool:
        x, y = self.root[i], self.root[j]
        if x == y:
            return False
        self.root[self.root == y] = x
        return True


def block_links(node: np.ndarray, n: np.ndarray, label: np.ndarray, bits: list[np.ndarray], sets: list[np.ndarray],
                others: int, percent: int) -> list[tuple[int, int]]:
    """Linked pairs of nodes that join all classes of a block that links join: at most one less than classes."""
    classes, out = Classes(label), []
    candidates: dict[int, list[int]] = {}
    for i, j in pairs_to_check(n, label, bits, others, percent):
        candidates.setdefault(i, []).append(j)
    for i, js in candidates.items():
        some = np.array(js)
        for at in range(0, len(some), BLOCK):
            apart = some[at: at + BLOCK]
            apart = apart[classes.root[apart] != classes.root[i]]
            if len(apart):
                hits = search(sets[i], [sets[j] for j in apart.tolist()], percent)
                out += [(int(node[i]), int(node[j])) for j in apart[sorted(hits)].tolist() if classes.join(i, j)]
    return out


def _across(lists: DataFrame, reps: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Edges (a, b) that join the classes of nodes that share a list.

    First the tasks that hold the blocks of lists tell which nodes may link there, then these blocks are dealt again with the sets of those nodes,
    and each is searched where it lies. Pairs never leave a task: what does are nodes of a block, and edges fewer than these.
    """
    least = lists.groupBy("node").agg(F.slice(F.array_sort(F.collect_list("h")), 1, FIRST_LISTS).alias("lists"))
    marked = cut(_marked(_dealt(lists, reps.select("node", "bits").join(least, "node")), percent))
    wanted = reps.join(marked.select("node").distinct(), "node", "left_semi")
    label = lists.groupBy("node").agg(F.first("label").alias("label"))
    facts = wanted.select("node", "n", "bits").join(label, "node").join(sets_of(docs, wanted, size), "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, ["h", "block", "other"]):
            node, n, label, role = (group.column(c).to_numpy() for c in ("node", "n", "label", "role"))
            sets = [np.frombuffer(x, np.uint64) for x in group.column("shingles").to_pylist()]
            bits = [np.array(x, np.int64).view(np.uint64) for x in group.column("bits").to_pylist()]
            found = block_links(node, n, label, bits, sets, int(np.searchsorted(role, 1)), percent)
            if found:
                a, b = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    again = (marked.join(facts, "node").select("h", "block", "other", "role", "node", "n", "label", "bits", "shingles")
             .repartition(width(lists.sparkSession), "h", "block", "other").sortWithinPartitions("h", "block", "other", "role"))
    return stored(again.mapInArrow(run, "a bigint, b bigint").distinct())


def _crowded(posting: DataFrame) -> DataFrame:
    """The rows of lists with at least two nodes."""
    here = Window.partitionBy("h")
    return posting.withColumn("df", F.count("*").over(here)).where("df > 1").drop("df")


def _labelled(posting: DataFrame, edges: DataFrame) -> DataFrame:
    label = components(edges)
    return cut(posting.drop("label").join(label, "node", "left").withColumn("label", F.coalesce("label", "node")))


def jaccard_classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: id, n_shingles, component_id (the smallest id that links reach)."""
    docs = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    rows = cut(nodes(docs, size, percent))
    label = components(links(docs, rows, size, percent))
    member = rows.select("id", "n", "node").join(label, "node", "left").withColumn("label", F.when(F.col("n") > 0, F.coalesce("label", "node")))
    least = member.where("n > 0 and id is not null").groupBy("label").agg(F.min("id").alias("component_id"))
    out = member.join(least, "label", "left")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                      F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component_id"))
