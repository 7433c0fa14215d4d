"""Quality, toxicity and URL models: against direct computations, held-out accuracy and odd rows."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from govmill.llm import quality_lm, queries, toxicity, url_filter


def kneser_ney(texts, order):
    """Direct interpolated modified Kneser-Ney: a function (history, character) -> probability."""
    counts = {order: Counter()}
    for t in texts:
        padded = quality_lm.PAD * (order - 1) + t
        counts[order].update(padded[i:i + order] for i in range(len(t)))
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    tables = {}
    for k in range(1, order + 1):
        n = [sum(c == j for c in counts[k].values()) for j in (1, 2, 3, 4)]
        if all(n):
            y = n[0] / (n[0] + 2 * n[1])
            d = [min(max(j - (j + 1) * y * n[j] / n[j - 1], 0.05), j - 0.05) for j in (1, 2, 3)]
        else:
            d = [0.5, 0.75, 0.9]
        total, freed = defaultdict(float), defaultdict(float)
        for g, c in counts[k].items():
            total[g[:-1]] += c
            freed[g[:-1]] += d[min(c, 3) - 1]
        tables[k] = counts[k], d, total, freed

    def p(history, char):
        k = len(history) + 1
        count, d, total, freed = tables[k]
        below = p(history[1:], char) if k > 1 else 1 / (len(tables[1][0]) + 1)
        if not total[history]:
            return below
        c = count[history + char]
        return ((c - d[min(c, 3) - 1] if c else 0) + freed[history] * below) / total[history]

    return p


@pytest.mark.parametrize("rows", [quality_lm.MODEL_ROWS, 0])
def test_costs_are_those_of_a_direct_model(docs, rows):
    pick = random.Random(4)
    words = ["stone", "river", "moon", "tree", "rivet", "stove", "treat"]
    text = lambda: " ".join(pick.choices(words, k=pick.randrange(1, 12)))
    trusted = [text() for _ in range(60)]
    asked = [(1, text()), (2, "unknown Zebra!"), (3, ""), (4, None), (5, trusted[0])]
    model = quality_lm.model(docs([(0, t) for t in trusted]).select("text"))
    p = kneser_ney(trusted, quality_lm.ORDER)
    got = {r.doc_id: (r.cost, r.n) for r in quality_lm.costs(docs(asked), model, rows).collect()}
    for i, t in asked:
        padded = quality_lm.PAD * (quality_lm.ORDER - 1) + (t or "")
        want = -sum(math.log(p(padded[j:j + quality_lm.ORDER - 1], padded[j + quality_lm.ORDER - 1])) for j in range(len(t or "")))
        assert got[i][1] == len(t or "") and got[i][0] == pytest.approx(want, rel=1e-4, abs=1e-4)


def test_quality_keeps_clean_and_rejects_junk(llm, sf_dir):
    folder = sf_dir.replace("sf0.001", "sf0.01")
    docs, labels = (queries.table(llm, folder, x) for x in ("documents", "labels"))
    out = quality_lm.judged(docs, labels).join(labels, "doc_id").collect()
    stays = quality_lm.kept(docs, labels)
    assert sorted(r.doc_id for r in stays.collect()) == sorted(r.doc_id for r in quality_lm.judged(docs, labels).where("keep").collect())
    good = [r.keep for r in out if r.quality == 1]
    bad = [r.keep for r in out if r.quality == 0]
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.3 * len(bad)


def test_quality_on_odd_rows_and_without_trusted_text(docs, odd, llm):
    rows = docs([(i, t, None if k % 2 else "en", k) for k, (i, t) in enumerate(odd)], "doc_id bigint, text string, lang string, cost int")
    none = llm.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert quality_lm.judged(rows, none).where("keep").count() == len(odd)
    some = llm.createDataFrame([(4, 1, 0), (8, 1, 0), (9, 1, 0), (9, 1, 0), (None, 1, 0)], "doc_id bigint, quality int, toxic int")
    kept = quality_lm.kept(rows, some)
    assert kept.columns == rows.columns and quality_lm.judged(rows, some).count() == len(odd)
    assert {(r.doc_id, r.text) for r in kept.collect()} >= {(1, None), (2, "")}
    assert quality_lm.judged(rows.limit(0), some).count() == 0


def test_toxicity_on_held_out_documents(llm, sf_dir):
    folder = sf_dir.replace("sf0.001", "sf0.1")
    # In these tables only English toxic documents differ from others by their words.
    english = queries.table(llm, folder, "documents").where("lang = 'en'").select("doc_id")
    out = queries.op2_toxicity(llm, folder).join(queries.table(llm, folder, "labels"), "doc_id").join(english, "doc_id").where("held_out").collect()
    toxic = [r.predicted for r in out if r.toxic == 1]
    clean = [r.predicted for r in out if r.toxic == 0]
    assert sum(toxic) >= 0.85 * len(toxic) and sum(clean) <= 0.03 * len(clean)


def test_toxic_documents_are_found_in_every_language(llm, sf_dir):
    folder = sf_dir.replace("sf0.001", "sf0.1")
    docs = queries.table(llm, folder, "documents").select("doc_id", "lang")
    out = queries.op2_toxicity(llm, folder).join(queries.table(llm, folder, "labels"), "doc_id").join(docs, "doc_id").where("held_out").collect()
    for lang in ("en", "de", "fr", "es"):
        toxic, clean = ([r.predicted for r in out if r.lang == lang and r.toxic == t] for t in (1, 0))
        assert sum(toxic) >= 0.85 * len(toxic) > 0 and sum(clean) <= 0.03 * len(clean), lang


def test_pieces_are_counted_in_characters_and_ratios_over_the_top_words():
    flat = np.frombuffer("réêeux漢abcdefgh".encode(), np.uint8)
    at = len("réêeux漢".encode())
    padded, first, last, bound = toxicity.word_pieces(flat, np.array([0, at]), np.array([at, len(flat)]))
    got = [padded[a:b].tobytes().decode() for a, b in zip(first, last, strict=True)]
    want = [("\x01" * 7 + w + "\x02")[i:i + 8] for w in ("réêeux漢", "abcdefgh") for i in range(len(w) + 1)]
    assert got == want and bound.tolist() == [0, 8, 17]
    ratios = np.array([5.0, 1, 1, 3] + [0.0] * 96 + [2.0] * 3 + [4.0] + [-1.0] * 97)
    assert toxicity.top_means(ratios, np.array([0, 0, 1, 100, 201])).tolist() == [0, 2.5, 2, 8 / 3]


def test_all_labelled_rows_are_counted_however_few_fit_the_curve(docs, llm):
    pick = random.Random(8)
    rude = [chr(97 + k // 26) + chr(97 + k % 26) + "zzyx" for k in range(150)]
    rows = []
    for i in range(600):
        words = pick.choices(["stone", "river", "moon", "tree", "cloud"], k=10)
        if i % 2:
            words[2:2] = [rude[i // 4 % 150]] * 2
        rows.append((i, " ".join(words)))
    labels = llm.createDataFrame([(i, 1, i % 2) for i, _ in rows], "doc_id bigint, quality int, toxic int")
    # With counts from the 60 rows of the curve, most rude words would not be seen.
    full = docs(rows)
    learned = full.join(labels, "doc_id").withColumn("half", labels.doc_id % 2)
    seen = {r.word.decode(): r for r in toxicity.word_counts(learned).collect()}
    assert set(seen) >= set(rude)
    assert seen["stone"].n0 == seen["stone"].n0_0 and seen["stone"].n0_1 == 0 == seen["stone"].n1_0
    counted = []
    inner = toxicity.piece_counts
    toxicity.piece_counts = lambda counts: counted.append({r.word.decode() for r in counts.select("word").collect()}) or inner(counts)
    try:
        toxicity.toxicity(full, labels, sample=60).count()
    finally:
        toxicity.piece_counts = inner
    held = {i for i, _ in rows if zlib.crc32(str(i).encode()) % 3 == 1}
    assert counted[0] == {w for i, t in rows if i not in held for w in t.split()}


def test_toxicity_table_and_join_agree_and_odd_rows(docs, odd, llm):
    pick = random.Random(6)
    calm, rude = ["stone", "river", "moon", "tree", "cloud"], ["vilest", "vilely", "vileness"]
    rows = []
    for i in range(300):
        words = pick.choices(calm, k=12)
        if i % 3 == 0:
            words[5] = pick.choice(rude)
        rows.append((i + 100, " ".join(words)))
    labels = llm.createDataFrame([(i, 1, int((i - 100) % 3 == 0)) for i, _ in rows], "doc_id bigint, quality int, toxic int")
    full = docs(rows + odd)
    out = {(r.doc_id, r.score, r.predicted) for r in toxicity.toxicity(full, labels).collect()}
    assert all(p == int((i - 100) % 3 == 0) for i, _, p in out if i and i >= 100)
    assert all(0 <= s <= 1 for _, s, _ in out)
    ratios = toxicity.piece_ratios(toxicity.word_counts(full.join(labels, "doc_id")))
    sent, joined = (sorted((r.doc_id or 0, round(r.peak, 9)) for r in toxicity.peaks(full, ratios, n).collect()) for n in (10**6, 0))
    assert sent == joined
    assert toxicity.toxicity(full, labels.limit(0)).where("score > 0").count() == 0


def markov(urls, order):
    """Direct Witten-Bell model of padded URLs: a function piece -> probability of its last character."""
    followers = defaultdict(Counter)
    for u in urls:
        padded = url_filter.PAD * (order - 1) + u
        for i in range(order - 1, len(padded)):
            for k in range(order):
                followers[padded[i - k:i]][padded[i]] += 1

    def p(context, char):
        below = p(context[1:], char) if context else 1 / url_filter.KINDS
        seen = followers.get(context)
        return (seen[char] + len(seen) * below) / (sum(seen.values()) + len(seen)) if seen else below

    return p


def test_url_ratios_and_verdicts(llm):
    pick = random.Random(7)
    good = [f"http://a.org/{pick.choice(['news', 'wiki'])}/{k}" for k in range(40)]
    bad = [f"http://b.com/de/{pick.choice(['win', 'spin'])}{k}" for k in range(40)]
    asked = ["http://c.net/news/5", "http://c.net/spin77", "no scheme", "", "HTTP://X.ORG/a", "http://org/y#z", "http://evilorg/y", None]
    rows = list(enumerate(good + bad + asked + asked))
    out = {r.page_id: r for r in url_filter.judged(llm.createDataFrame(rows, "page_id bigint, url string"), queries.URL_RULES).collect()}
    assert len(out) == len(rows)
    by_url = {u: out[i] for i, u in rows}
    assert by_url["HTTP://X.ORG/a"][1:4] == ("x.org", "/a", "org/") and by_url["http://org/y#z"].rule == "org/"
    assert by_url["http://evilorg/y"].rule is None and by_url[None][1:4] == ("", "", None)
    assert by_url["http://c.net/news/5"].score > by_url["http://c.net/spin77"].score
    assert by_url["http://c.net/news/5"].verdict == "allow"
    # The ratios are those of two directly computed models.
    flags = llm.createDataFrame([(u, 1, 0) for u in good] + [(u, 0, 1) for u in bad], "url string, a int, r int")
    plain = [[u.translate(str.maketrans("123456789", "0" * 9)) for u in x] for x in (good, bad)]
    pa, pr = (markov(x, url_filter.ORDER) for x in plain)
    for r in url_filter.piece_ratios(flags).collect():
        assert r.ratio == pytest.approx(math.log(pa(r.piece[:-1], r.piece[-1]) / pr(r.piece[:-1], r.piece[-1])), abs=1e-9)
    assert url_filter.judged(llm.createDataFrame([], "page_id bigint, url string"), queries.URL_RULES).count() == 0
