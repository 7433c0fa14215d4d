"""Personal data, decontamination, embeddings, chats and the pipeline against brute force."""

import random
import re

import numpy as np
import pytest

from govmill.llm import chat_repair, decontaminate, embedding_dedup, pii, queries


def base_spans(t):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[ -]", "", m[0])
        total = sum(int(c) * (1 + i % 2) - 9 * (int(c) * (1 + i % 2) > 9) for i, c in enumerate(reversed(d)))
        if 12 <= len(d) <= 19 and total % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in sorted(out))


def test_base_spans_on_random_and_odd_texts(docs, odd):
    pick = random.Random(2)
    parts = list("0123456789") * 2 + list(" .-+()@a%_é\n,") + ["1.2.3.4", "4111111111111111", "+1 (578) 555-6437", "a@b.co", "x at y dot com", "255"]
    rows = [(100 + i, "".join(pick.choices(parts, k=pick.randrange(40)))) for i in range(1500)]
    rows += odd + [(50, "7" * 3000), (51, "a@b" + ".c" * 3000), (52, "4111111111111111 x " * 600)]
    out = pii.report(docs(rows)).collect()
    assert len(out) == len(rows)
    texts = {i: t for i, t in rows if i is not None}
    for r in out:
        if r.doc_id is not None:
            assert r.base == base_spans(texts[r.doc_id] or "")
            assert set(filter(None, r.base.split(","))) <= set(filter(None, r.spans.split(",")))
            assert r.n_ip == r.base.count("ip:") and r.n_phone == r.base.count("phone:")
    assert pii.report(docs([])).count() == 0


def test_numbers_that_run_together_are_added(docs):
    plain = [(i, f"call me at +1 (578) 555-{1000 + i} or pay with card 4111111111111111 now") for i in range(40)]
    out = {r.doc_id: r.spans for r in pii.report(docs([*plain, (99, "call +1 (578) 555-6437 4111111111111111 now")])).collect()}
    assert out[99] == "phone:5:22,card:23:39"


def test_redaction_keeps_columns_and_order(docs):
    rows = [(1, "mail a@b.com, ip 10.0.0.1.", 26, "x"), (2, None, None, "y"), (3, "none", 4, "z")]
    out = pii.redacted(docs(rows, "doc_id bigint, text string, n_chars bigint, found string"))
    assert out.columns == ["doc_id", "text", "n_chars", "found"]
    assert sorted(map(tuple, out.collect())) == [(1, "mail [EMAIL], ip [IP].", 22, "x"), (2, None, None, "y"), (3, "none", 4, "z")]


def test_em_finds_the_reliable_labelers():
    pick, counts = random.Random(1), {}
    for _ in range(4000):
        true = pick.random() < 0.4
        votes = tuple((1 if true else -1) if pick.random() < q else (-1 if true else 1) for q in (0.95, 0.9, 0.8, 0.5, 0.6))
        counts[(0, 1, *votes)] = counts.get((0, 1, *votes), 0) + 1
    belief = pii.reliabilities(sorted(counts.items()))
    assert belief[0, 1, 1, 1, 1, -1, -1] > 0.9 and belief[0, 1, -1, -1, -1, 1, 1] < 0.1


def words_of(t):
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", (t or "").lower())


def shingle_set(w):
    return {tuple(w[k:k + 5]) for k in range(len(w) - 4)}


def test_benchmark_passages_are_found_and_nothing_else(llm, docs, odd):
    pick = random.Random(3)
    word = lambda: "".join(pick.choices("abcdefgh", k=3))
    items = [(i, " ".join(word() for _ in range(pick.randrange(6, 70)))) for i in range(60)] + [(900, "too short"), (901, None), (902, " ".join(["w"] * 30))]
    items.append((903, items[0][1]))
    rows = list(odd)
    for i in range(300):
        body = [word() for _ in range(pick.randrange(5, 200))]
        if i % 3 == 0:
            item = items[pick.randrange(60)][1].split()
            if i % 6 == 0:
                item[-1] = "changed"
            at = pick.randrange(len(body) + 1)
            body[at:at] = [x.upper() + "," for x in item]
        rows.append((1000 + i, "\n".join(body) if i % 2 else " ".join(body)))
    benchmark = llm.createDataFrame(items, "item_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.matches(docs(rows), benchmark).collect()}
    index = decontaminate.Index([i for i, _ in items], __import__("pyarrow").array([t for _, t in items], "string"))
    weight = dict(zip(index.shingle.tolist(), index.weight.tolist(), strict=True))
    want, exact = set(), set()
    for d, t in rows:
        for i, item in items:
            mine, own = shingle_set(words_of(t)), shingle_set(words_of(item))
            if own and own <= mine:
                exact.add((d, i))
            if own and len(own & mine) >= 0.7 * len(own):
                want.add((d, i))
    assert weight and exact <= got <= want
    kept = decontaminate.clean(docs(rows), benchmark)
    flagged = {d for d, _ in got}
    assert sorted(r.doc_id or -1 for r in kept.collect()) == sorted(d or -1 for d, _ in rows if d not in flagged)
    assert decontaminate.matches(docs(rows), benchmark.limit(0)).count() == 0 == decontaminate.matches(docs([]), benchmark).count()


def test_fingerprints_within_the_radius_are_found_without_fail():
    pick = np.random.default_rng(4)
    prints = pick.integers(0, 1 << 63, 200).astype(np.uint64)
    near = prints.copy()
    for k in range(200):
        for b in pick.choice(64, int(pick.integers(0, decontaminate.RADIUS + 1)), replace=False):
            near[k] ^= np.uint64(1) << np.uint64(b)
    found = set()
    for shift in (0, 16, 32, 48):
        found |= set(zip(*(x.tolist() for x in decontaminate.Block.of(prints, shift).find(near)), strict=True))
    assert {(k, k) for k in range(200)} <= found


def test_benchmark_in_blocks(llm, docs, monkeypatch):
    items = llm.createDataFrame([(i, " ".join(f"w{i}x{k}" for k in range(20))) for i in range(12)], "item_id bigint, text string")
    rows = docs([(i, "before " + " ".join(f"w{i}x{k}" for k in range(20)) + " after") for i in range(12)])
    monkeypatch.setattr(decontaminate, "ITEM_BYTES", 300)
    assert len(decontaminate.indexes(items)) > 3
    assert {(r.doc_id, r.item_id) for r in decontaminate.matches(rows, items).collect()} == {(i, i) for i in range(12)}


@pytest.mark.parametrize("size", [15, 30, 45, 300, 1000])
def test_changed_passages_of_all_lengths_are_found(size):
    import pyarrow as pa

    pick = random.Random(size)
    word = lambda: "".join(pick.choices("abcdefghijklmnopqrstuvwxyz", k=6))
    items = [[word() for _ in range(size)] for _ in range(20)]
    index = decontaminate.Index(list(range(20)), pa.array([" ".join(t) for t in items], "string"))
    shingles = lambda t: {tuple(t[k:k + 5]) for k in range(len(t) - 4)}
    texts, want = [], set()
    for i, t in enumerate(items):
        drop = round(0.17 * (size - 4))
        changed = list(t)
        for _ in range(max(1, size // 28)):
            changed[pick.randrange(size)] = word()
        for passage in (t[drop:], t[:-drop], changed, t[:size // 2]):
            if len(shingles(t) & shingles(passage)) >= 0.8 * (size - 4):
                want.add((len(texts), i))
            texts.append(" ".join([word() for _ in range(pick.randrange(40))] + passage + [word() for _ in range(pick.randrange(40))]))
    assert len(want) >= 40
    assert {(r, i) for r, i, _, _ in index.search(pa.array(texts, "string"))} == want


def test_weights_are_those_of_the_whole_benchmark(llm, monkeypatch):
    items = llm.createDataFrame([(i, f"a common start of all items {i} then x{i} y{i} z{i} w{i} v{i}") for i in range(40)], "item_id bigint, text string")
    whole = {k: w for x in decontaminate.indexes(items) for k, w in zip(x.shingle.tolist(), x.weight.tolist(), strict=True)}
    monkeypatch.setattr(decontaminate, "ITEM_BYTES", 300)
    parts = decontaminate.indexes(items)
    assert len(parts) > 3
    for x in parts:
        assert [whole[k] for k in x.shingle.tolist()] == pytest.approx(x.weight.tolist())


def test_lattice_points_are_nearest():
    pick = np.random.default_rng(1)
    x = pick.normal(size=(300, 8))
    point, short = embedding_dedup.decode(x), embedding_dedup.neighbours()
    assert len(short) == 240 and np.allclose((short ** 2).sum(axis=1), 2)
    best = ((x[:, None] - point[:, None] - short[None]) ** 2).sum(axis=2).min(axis=1)
    assert (((x - point) ** 2).sum(axis=1) <= best + 1e-9).all()


@pytest.mark.parametrize("cell", [1024, 16])
def test_embedding_links_against_all_pairs(llm, monkeypatch, cell):
    monkeypatch.setattr(embedding_dedup, "CELL", cell)
    pick = np.random.default_rng(2)
    rows = []
    for c in range(40):
        center = pick.normal(size=32)
        for _ in range(int(pick.integers(1, 12))):
            rows.append((len(rows), [float(x) for x in center + pick.normal(size=32) * pick.choice([0.0, 0.05, 0.1, 0.2])], int(c % 3)))
    bad = [(500, None, 1), (501, [], 1), (502, [0.0] * 32, 1), (503, [float("nan")] * 32, 1), (504, rows[0][1], None), (505, [None] * 32, 1), (506, [1.0, 2.0], 0), (None, rows[0][1], 0)]
    out = {r.vec_id: r for r in embedding_dedup.near_duplicates(llm.createDataFrame(rows + bad, "vec_id bigint, embedding array<double>, label int")).collect()}
    x = np.array([v for _, v, _ in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([y for *_, y in rows])
    close = (x @ x.T >= 0.98) & (label[:, None] == label[None])
    want = close.sum(axis=1) - 1
    got = np.array([out[i].n_links for i in range(len(rows))]) - np.array([int(close[0, i]) for i in range(len(rows))])  # the row without id is a copy of row 0
    assert (got <= want).all() and got.sum() >= 0.9 * want.sum()
    for i in range(500, 507):
        assert (out[i].n_links, out[i].component_id, out[i].kept) == (0, i, True)
    assert out[None].component_id is None


ROLE = {"system": 1, "user": 2, "assistant": 3}


def cheapest(roles):
    """Shortest way over (turns read, state), one act at a time."""
    import heapq

    queue, done = [(0, 0, 0)], set()
    while queue:
        cost, k, q = heapq.heappop(queue)
        if (k, q) in done:
            continue
        done.add((k, q))
        if k == len(roles) and q == 3:
            return cost
        for to in chat_repair.NEXT[q]:
            heapq.heappush(queue, (cost + 3, k, to))
            if k < len(roles):
                heapq.heappush(queue, (cost + (0 if ROLE.get(roles[k], 0) == to else 2), k + 1, to))
        if k < len(roles) and q:
            heapq.heappush(queue, (cost + 1 + (0 if ROLE.get(roles[k], 0) == q else 2), k + 1, q))


@pytest.mark.parametrize("block", [2048, 3])
def test_chats_are_repaired_at_least_cost(llm, monkeypatch, block):
    monkeypatch.setattr(chat_repair, "BLOCK", block)
    pick = random.Random(1)
    chats = {c: [pick.choice(["user", "assistant", "system", "tool", None]) for _ in range(pick.randrange(1, 9))] for c in range(150)}
    chats[None] = ["user", "assistant"]
    chats[999] = [pick.choice(["user", "assistant"]) for _ in range(400)]
    rows = [(c, i, r, f"t{i}") for c, roles in chats.items() for i, r in enumerate(roles)]
    out = {}
    for r in chat_repair.repaired(llm.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")).collect():
        out.setdefault(r.conv_id, []).append(r)
    assert out.keys() == chats.keys()
    for c, pieces in out.items():
        pieces.sort(key=lambda r: r.place)
        text, cost, turns = "".join(r.piece for r in pieces), 0, iter(chats[c])
        for r in pieces:
            same = r.action == "insert" or next(turns) == r.role
            cost += {"insert": 3, "keep": 0, "relabel": 2, "merge": 1 + 2 * (not same)}[r.action]
        order = "".join(x[0] for x in re.findall(r"<\|(system|user|assistant)\|>", text))
        assert re.fullmatch("s?(ua)+", order) and text.endswith(chat_repair.END) and text.count(chat_repair.END) == len(order)
        assert cost == cheapest(chats[c])
    assert chat_repair.repaired(llm.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")).count() == 0


def tasks_of(spark, name, work):
    """What `work` gives, and how many tasks the driver has recorded for it."""
    context = spark.sparkContext
    context.setJobGroup(name, name)
    try:
        out = work()
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    tracker = context.statusTracker()
    stages = {k for j in tracker.getJobIdsForGroup(name) for k in tracker.getJobInfo(j).stageIds}
    return out, sum(tracker.getStageInfo(k).numCompletedTasks for k in stages if tracker.getStageInfo(k))


def test_near_copies_leave_few_tasks_for_the_driver_to_record(llm, docs):
    import corpus_pipeline

    words = [f"w{k}" for k in range(200)]
    rows = [(k, " ".join(words[k % 8: k % 8 + 120] + [f"own{k // 8}"])) for k in range(64)]
    set_to = {"spark.sql.shuffle.partitions": "24", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: llm.conf.get(k) for k in set_to}
    for k, v in set_to.items():
        llm.conf.set(k, v)
    try:
        kept, n = tasks_of(llm, "few-tasks", lambda: {r[0] for r in corpus_pipeline.near_copies(llm, docs(rows), "").collect()})
    finally:
        for k, v in before.items():
            llm.conf.set(k, v)
    assert kept == {0}
    assert n < 3000  # 2,074; 4,174 when frames were checkpoints and the classes were made twice


def test_components_of_stars_and_paths(llm):
    from govmill.llm.shared import components, stars

    path = [(k, k + 1) for k in range(20)]
    star = [(100, k) for k in range(101, 140)]
    tree = [(k // 2, k) for k in range(402, 460)]
    frame = lambda rows: llm.createDataFrame(rows, "a bigint, b bigint")
    assert stars(frame([(b, a) for a, b in star])) and not stars(frame([(b, a) for a, b in path])) and stars(frame([]))
    _, n = tasks_of(llm, "one-star", lambda: components(frame(star)).collect())
    _, most = tasks_of(llm, "one-path", lambda: components(frame(path)).collect())
    assert n < most
    root: dict[int, int] = {}
    find = lambda x: x if root.setdefault(x, x) == x else find(root[x])
    for a, b in path + star + tree:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    got = {r["node"]: r["label"] for r in components(frame(path + star + tree + star[:5])).collect()}
    assert got == {k: find(k) for k in root}


def test_pipeline_stages_keep_columns_and_take_effect(llm, sf_dir):
    import corpus_pipeline

    folder = sf_dir.replace("sf0.001", "sf0.01")
    docs = queries.table(llm, folder, "documents")
    first = docs
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before, docs = docs, stage(llm, docs, folder).cache()
        assert docs.count() <= before.count()
        assert k == len(corpus_pipeline.STAGES) - 1 or docs.dtypes == first.dtypes
        if k == 3:
            texts = [r.text for r in docs.collect()]
            assert all(not base_spans(t or "") for t in texts) and any("[EMAIL]" in (t or "") for t in texts)
    assert docs.where("not lossless").count() == 0 < docs.count()
    assert corpus_pipeline.run(llm, sf_dir).count() > 0


def test_rows_that_repeat_an_id_leave_only_as_copies(llm, docs):
    import corpus_pipeline

    text = lambda k: " ".join(f"w{k}x{j}" for j in range(30))
    rows = [(1, text(1)), (2, text(2)), (2, text(1)), (2, None), (2, ""), (3, text(3)), (3, text(3)), (3, text(4)), (None, text(1)), (4, text(3)), (5, text(5))]
    kept = corpus_pipeline.near_copies(llm, docs(rows), "")
    want = [(1, text(1)), (2, text(2)), (2, None), (2, ""), (3, text(3)), (3, text(4)), (None, text(1)), (5, text(5))]
    assert sorted(map(str, kept.collect())) == sorted(map(str, docs(want).collect()))


def test_every_query_is_registered():
    import __spark_entry__ as entry

    assert {int(m[1]) for k in entry.queries() if (m := re.match(r"op(\d+)_", k))} == set(range(1, 14)) and "pipeline" in entry.queries()
