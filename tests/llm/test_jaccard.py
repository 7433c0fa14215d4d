"""The n-gram Jaccard join against a comparison of all pairs."""

import random
import re
from collections import defaultdict

import numpy as np

from govmill.llm import jaccard_join as J

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(zip(*(w[k:] for k in range(5)), strict=False)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(rows):
    sets, root = {i: shingles(t) for i, t in rows}, {i: i for i, _ in rows}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                    x, y = top(a), top(b)
                    root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), top(i)) for i in ids}


def corpus(seed=1):
    pick, rows = random.Random(seed), []
    word = lambda: "".join(pick.choices("abcdefg", k=pick.randrange(1, 6)))
    passage = [word() for _ in range(40)]
    for g in range(25):
        base = [word() for _ in range(pick.randrange(3, 120))]
        if g % 3 == 0:
            base = base[:20] + passage + base[20:]
        for _ in range(pick.randrange(1, 7)):
            copy = list(base)
            for _ in range(pick.randrange(0, 4)):
                copy[pick.randrange(len(copy))] = word()
            text = " ".join(copy)
            rows.append((len(rows), text.upper() if pick.random() < 0.2 else text))
    return rows


def test_classes_are_those_of_all_pairs(docs):
    rows = corpus() + [(1000, None), (1001, ""), (1002, "one two"), (1003, "ONE\ttwo"), (1004, "two one"), (1005, "w " * 3000)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.jaccard_classes(docs(rows)).collect()}
    assert got == brute(rows)


def test_a_large_group_of_near_copies_and_one_shared_passage(docs, monkeypatch):
    monkeypatch.setattr(J, "LIST_BLOCK", 16)
    monkeypatch.setattr(J, "BLOCK", 8)
    pick = random.Random(5)
    base = [f"w{k}" for k in range(60)]
    rows = []
    for i in range(150):
        copy = list(base)
        for _ in range(pick.randrange(0, 3)):
            copy[pick.randrange(60)] = f"x{pick.randrange(10**6)}"
        rows.append((i, " ".join(copy)))
    rows += [(1000 + i, " ".join(base[:30] + [f"y{i}_{k}" for k in range(30)])) for i in range(60)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.jaccard_classes(docs(rows)).collect()}
    assert got == brute(rows)


def test_repeated_rows_null_ids_and_extra_columns(docs):
    rows = [(1, "a b c d e f", 1), (1, "a b c d e f", 2), (2, "a b c d e f", 3), (None, "a b c d e f", 4), (3, "q r s t u v", 5), (3, "something else that is not alike", 6)]
    out = J.jaccard_classes(docs(rows, "doc_id bigint, text string, node int"))
    assert sorted((r.doc_id or -1, r.component_id or -1) for r in out.collect()) == [(-1, -1), (1, 1), (1, 1), (2, 1), (3, 3), (3, 3)]
    assert J.jaccard_classes(docs([])).count() == 0


def test_divide_skip_finds_all_with_enough_lists():
    pick = random.Random(2)
    for _ in range(200):
        lists = [np.array(sorted(pick.sample(range(30), pick.randrange(0, 25)))) for _ in range(pick.randrange(1, 14))]
        count = defaultdict(int)
        for x in lists:
            for i in x.tolist():
                count[i] += 1
        least = pick.randrange(1, 12)
        ids, total = J.divide_skip(lists, least)
        assert dict(zip(ids.tolist(), total.tolist(), strict=True)) == {i: c for i, c in count.items() if c >= least}


def test_bit_maps_never_rule_out_a_link():
    pick = np.random.default_rng(3)
    for _ in range(100):
        n = int(pick.integers(1, 400))
        a = pick.integers(1, 1 << 62, n).astype(np.uint64)
        b = np.concatenate([a[int(pick.integers(0, n)):], pick.integers(1, 1 << 62, int(pick.integers(0, 30))).astype(np.uint64)])
        a, b = np.unique(a), np.unique(b)
        if not len(b) or not 0.5 <= len(a) / len(b) <= 2:
            continue
        both = len(np.intersect1d(a, b))
        bits, offset = J.parity_bits(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
        maps = [bits[x:y].view(np.uint64) for x, y in zip(offset[:-1], offset[1:], strict=True)]
        found = J.close_pairs(np.array([len(a), len(b)]), np.array([1, 2]), maps, 1, 80)
        if 100 * both >= 80 * (len(a) + len(b) - both):
            assert (0, 1) in found


def test_edges_of_a_block_join_what_its_links_join():
    pick = np.random.default_rng(11)
    for others in (3, 8):
        for count in (10, 40):  # compared one by one, and as arrays
            base = pick.integers(1, 1 << 62, 40).astype(np.uint64)
            sets = []
            for _ in range(count):
                own = base.copy()
                own[pick.integers(0, 40, int(pick.integers(0, 9)))] = pick.integers(1, 1 << 62, 1).astype(np.uint64)
                sets.append(np.unique(own))
            n, label = np.array([len(x) for x in sets]), pick.integers(0, 6, count)
            bits, at = J.parity_bits(np.concatenate(sets), np.concatenate([[0], np.cumsum(n)]))
            maps = [bits[x:y].view(np.uint64) for x, y in zip(at[:-1], at[1:], strict=True)]
            links = {(i, j) for i in range(others) for j in range(count)
                     if label[i] != label[j] and 180 * len(np.intersect1d(sets[i], sets[j])) >= 80 * (n[i] + n[j])}
            edges = J.block_links(np.arange(count), n, label, maps, sets, others, 80)
            assert set(edges) <= links and len(edges) < len(set(label.tolist()))
            want, got = J.Classes(label), J.Classes(label)
            for c, pairs in ((want, links), (got, edges)):
                for i, j in pairs:
                    c.join(i, j)
            assert all((want.root[i] == want.root[j]) == (got.root[i] == got.root[j]) for i in range(count) for j in range(count))
