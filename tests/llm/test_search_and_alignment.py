"""Lexical search, exact top-k and token alignment against brute force, the public libraries and their SQL twins."""

import hashlib
import math
import random
import re
from collections import Counter

import compare
import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from govmill.llm import exact_topk, lexical_search, queries, token_alignment

BYTE, PIECE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


@pytest.mark.parametrize("key", list(queries.ORACLE_SQL))
def test_sql_twins(llm, sf_dir, key):
    assert compare.differences(queries.QUERIES[key](llm, sf_dir), compare.duck(sf_dir), queries.ORACLE_SQL[key]) is None


# --- lexical search


def terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def brute_search(docs, items, k):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    n_docs, n_all = sum(bool(b) for _, b in bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(terms(t))
    out = []
    for item, want in wanted.items():
        scored = []
        for i, bag in bags:
            m = 100 - 90 + (90 * sum(bag.values()) * n_docs) // max(1, n_all)
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * bag[t]) // (1000 * bag[t] + 8 * m)) for t in want if t in bag)
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, r, x[3], -x[0]) for r, x in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def test_search_is_brute_force(docs, odd):
    pick = random.Random(5)
    words = [f"w{int(pick.paretovariate(0.7)) % 300}" for _ in range(4000)] + ["É", "ß1", "UPPER", "a_b"]
    rows = odd + [(100 + i, " ".join(pick.choices(words, k=pick.randrange(1, 80)))) for i in range(400)]
    rows += [(600 + i, "same text for a third of all W1 W2 rows") for i in range(200)] + [(None, "w1 w2 w3"), (700, "w1, w2; w3!")]
    asked = [(i, " ".join(pick.choices(words, k=20))) for i in range(12)] + [(50, None), (51, ""), (52, "nowhere_to_be found!x"), (53, "same rows"), (53, "third")]
    for k, chars in ((10, 4_000_000), (3, 300), (1000, 4_000_000)):
        got = lexical_search.search(docs(rows), docs(asked, "item_id int, text string"), k=k, item_chars=chars)
        assert got.columns == ["item_id", "rank", "doc_id", "score"]
        assert sorted(map(tuple, got.collect()), key=str) == brute_search(rows, asked, k)


def test_search_of_empty_tables_and_text_ids(docs):
    none = docs([])
    asked = docs([(1, "a b c")], "item_id int, text string")
    assert lexical_search.search(none, asked).count() == 0
    assert lexical_search.search(docs([(1, "a b")]), docs([], "item_id int, text string")).count() == 0
    named = docs([("x", "a b", 1), ("y", "a c", 2), (None, "b", 3)], "doc_id string, text string, score int")
    got = lexical_search.search(named, docs([("p", "a", "b")], "item_id string, text string, doc_id string"))
    assert [(r.item_id, r.doc_id) for r in got.collect()] == [("p", "x"), ("p", "y")]


def test_long_texts_go_through_in_windows(monkeypatch):
    import pyarrow as pa

    from govmill.llm import words

    texts = ["alpha beta " * 5000, None, "x" * 9000, "", "beta"]
    known = np.unique(words.word_keys(*words.column_bytes(pa.array(["alpha beta"])), letters_only=True)[0])
    whole = lexical_search.counted(pa.array(texts), known)
    small = words.windows.__defaults__
    monkeypatch.setattr(words.windows, "__defaults__", (*small[:-1], 64))
    for x, y in zip(whole, lexical_search.counted(pa.array(texts), known), strict=True):
        assert (x == y).all()
    assert whole[0].tolist() == [10000, 0, 1, 0, 1]


def test_bounds_skip_buckets_and_documents():
    pick = np.random.default_rng(1)
    import pyarrow as pa

    items = [np.array([0, 1, 2]), np.array([3, 4])]
    rows = []
    for _ in range(6000):
        held = np.unique(pick.integers(0, 40, 6))
        rows.append((held, pick.integers(1, 1000, len(held)) * np.where(pick.random() < 0.01, 50, 1)))
    rows.sort(key=lambda r: -float((r[1].astype(float) ** 2).sum()))
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(6000)), pa.array([math.sqrt(float((v.astype(float) ** 2).sum())) for _, v in rows]),
         pa.array([t.astype("<i4").tobytes() for t, _ in rows]), pa.array([v.astype("<i8").tobytes() for _, v in rows])], names=["doc", "length", "terms", "impact"])
    found = lexical_search.Search(items, np.ones(2), 5)
    for at in range(0, 6000, 500):
        found.bucket(batch.slice(at, 500))
    for q, item in enumerate(items):
        scores = [(-int(v[np.isin(t, item)].sum()), False, i) for i, (t, v) in enumerate(rows)]
        assert found.best[q] == sorted(s for s in scores if s[0])[:5]
    assert found.skipped > 0 and found.rescored < 3000


# --- exact top-k


def brute_top(rows, every, k):
    seen = {(i, tuple(map(float, v))) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and max(map(abs, v)) < 1e5}
    scaled = sorted({(i, tuple(math.floor(1024 * x) for x in v)) for i, v in seen})
    out = []
    for q, v in scaled:
        if q % every == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in scaled if i != q and len(w) == len(v))[:k]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    return sorted(out)


def test_top_k_is_brute_force(llm):
    pick = np.random.default_rng(3)
    rows = [(i, pick.normal(size=8).round(2).tolist()) for i in range(600)]
    rows += [(1000 + i, [0.5] * 8) for i in range(300)]  # a hot vector
    rows += [(2000 + i, pick.normal(size=3).tolist()) for i in range(30)]
    rows += [(3000, [40000.0, -40000.0, 1.0]), (3100, [-30000.0, 20000.0, 7.5]), (5, rows[5][1]), (4000, [1e300] * 8), (4100, None), (4200, []),
             (4300, [None, 1.0]), (4400, [float("nan")] * 8), (4500, [float("inf")] * 8), (None, [1.0] * 8), (4600, [0.0] * 8), (-100, [-1.0] * 8)]
    table = llm.createDataFrame([(i, v, "x", 1.0) for i, v in rows], "vec_id bigint, embedding array<double>, label string, score double")
    for k, block in ((10, 4096), (3, 4), (700, 4096)):
        got = exact_topk.top_k(table.repartition(5), k=k, block=block)
        assert got.columns == ["query_id", "rank", "vec_id", "score"]
        assert sorted(map(tuple, got.collect())) == brute_top(rows, 100, k)
    assert exact_topk.top_k(table.limit(0)).count() == 0


def test_tree_bounds_skip_leaves():
    pick = np.random.default_rng(4)
    points = (pick.normal(size=(40, 4)) * 3000).astype(np.int64)[pick.integers(0, 40, 4096)] + pick.integers(-9, 9, (4096, 4))
    tree = exact_topk.Tree(points)
    assert sorted(tree.order.tolist()) == list(range(4096))
    found = exact_topk.Search(np.arange(10), points[:10], np.full(10, exact_topk.NOTHING), 10)
    found.shard(tree.order, points[tree.order], np.stack([tree.start, tree.end]), tree.centre, tree.radius)
    for q in range(10):
        scores = points @ points[q]
        assert found.found[q].tolist() == [i for _, i in sorted((-int(s), i) for i, s in enumerate(scores) if i != q)[:10]]
    assert found.visits < 10 * 4096 / exact_topk.LEAF / 3
    same = exact_topk.Tree(np.ones((500, 3), np.int64))
    assert same.radius.max() == 0


# --- token alignment


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(BYTE)
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=PIECE), token_alignment.Aligner(BYTE, PIECE)


def brute_alignment(text, libraries):
    """(n_a, n_b, n_groups, n_links, groups, links) of a whole text by the libraries and a walk over both sides."""
    a_lib, b_lib, tables = libraries
    nothing = (0, 0, 0, 0, "", Counter())
    if not text:
        return nothing
    a, b = a_lib.encode(" " + text, add_special_tokens=False).ids, b_lib.encode(text)
    a_bytes, b_bytes = [tables.a_bytes[i] for i in a], [tables.b_bytes[i] for i in b]
    if not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
        return nothing
    a_end, b_end = np.cumsum([*map(len, a_bytes)]).tolist(), np.cumsum([*map(len, b_bytes)]).tolist()
    said, links, i, j = [], Counter(), 0, 0
    for end in sorted(set(a_end) & set(b_end)):
        sides = [], []
        while i < len(a) and a_end[i] <= end:
            sides[0].append(str(a[i]))
            i += 1
        while j < len(b) and b_end[j] <= end:
            sides[1].append(str(b[j]))
            j += 1
        said.append("|".join(map(",".join, sides)))
    i = j = 0
    while i < len(a) and j < len(b):
        links[a[i], b[j]] += 1
        x, y = a_end[i], b_end[j]
        i, j = i + (x <= y), j + (y <= x)
    return len(a), len(b), len(said), sum(links.values()), hashlib.sha256(";".join(said).encode()).hexdigest(), links


TEXTS = ["a  b", " a", " ", "  ", "x ", "x  ", "\n", "a\n b", "a \n b", "a▁b", "é ñ 漢字 \U0001F600 ", "\x00\x1f odd", "don't  stop'll it's", "\t a\t\tb",
         "<|endoftext|> a <s> </s> <unk> <0x41>", "a  b", "　 x", "1234 567a  8", "x" * 3000, "a " * 2000, "a\u0085 b", "a\x1c b", "naïve café, Straße!"]


def test_alignment_is_brute_force(docs, odd, libraries):
    pick = random.Random(9)
    rows = odd + list(enumerate(TEXTS, 100)) + [(200 + i, "".join(pick.choices("ab cé\n ,.▁1 漢'", k=pick.randrange(60)))) for i in range(150)]
    rows += [(500, "the same words again and again")] * 40
    want = [(i, brute_alignment(t, libraries)) for i, t in rows]
    held = Counter(p for _, w in want for p in w[5])
    best = {}
    for (x, _), c in held.items():
        best[x] = max(best.get(x, 0), c)
    expected = sorted([(i, *w[:4], sum(n for p, n in w[5].items() if held[p] == best[p[0]]), sum(n * held[p] for p, n in w[5].items()), w[4]) for i, w in want], key=str)
    df = docs([(i, t, 1, "x") for i, t in rows], "doc_id bigint, text string, pair int, n_a string").repartition(3)
    for pairs in (token_alignment.PAIRS, 10):
        got = token_alignment.alignment(df, BYTE, PIECE, pairs=pairs)
        assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
        assert sorted(map(tuple, got.collect()), key=str) == expected
    assert token_alignment.alignment(docs([]), BYTE, PIECE).count() == 0


def test_alignment_in_slices(libraries):
    text = " ".join(TEXTS[:9] + TEXTS[10:]) * 3
    whole = libraries[2].documents([text, None, "b"])
    cut = libraries[2].documents([text, None, "b"], limit=7)
    assert [x.row() for x in whole] == [x.row() for x in cut]
    assert whole[0].row()[:5] == brute_alignment(text, libraries)[:5]


def test_pointers_end_at_the_terminal_token():
    a_group, b_group = token_alignment.components(np.array([2, 5, 9, 10]), np.array([1, 5, 6, 8, 10]))
    assert a_group.tolist() == [0, 0, 1, 1] and b_group.tolist() == [0, 0, 1, 1, 1]
