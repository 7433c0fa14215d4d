"""Token counts and byte-level BPE against the public libraries."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
import tiktoken
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from govmill.llm import byte_bpe, queries, ragged, token_counts, vocab

JSON, RANKS = (public_tokenizers.path(f"byte_bpe_50k.{x}") for x in ("json", "tiktoken"))
LIBRARY = tokenizers.Tokenizer.from_file(JSON)
with open(RANKS, "rb") as f:
    TIKTOKEN = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                 mergeable_ranks={base64.b64decode(a): int(b) for a, b in map(bytes.split, f)})
LETTERS = list("aAsStremvld'''  \n\t.,!1²é中　\x85\x1c reve ll") + ["\U0001F600", "<|endoftext|>", "aaaa", "     ", "the", "===="]


def texts(n=3000, seed=3):
    pick = random.Random(seed)
    return ["".join(pick.choices(LETTERS, k=pick.randrange(40))) for _ in range(n)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=30), max_size=4))
def test_pretokens_are_those_of_the_pattern(parts):
    parts = [x.encode("utf-8", "ignore").decode() for x in parts]
    pieces, joined = ragged.Pieces(parts), "".join(parts)
    got = [[joined[pieces.start[i]:pieces.end[i]] for i in range(pieces.bound[j], pieces.bound[j + 1])] for j in range(len(parts))]
    assert ["".join(x) for x in got] == parts
    if joined.isascii():
        assert got == [regex.findall(public_tokenizers.PATTERN, x) for x in parts]


def test_counts_are_those_of_the_library():
    sample = texts()
    want = [len(x.ids) for x in LIBRARY.encode_batch(sample, add_special_tokens=False)]
    assert token_counts.Counter(vocab.from_json(JSON)).count(sample).tolist() == want


def test_ids_are_those_of_the_library_and_decode_to_the_text():
    sample = texts()
    merges, table = vocab.from_ranks(RANKS)
    ids = byte_bpe.Encoder(merges).encode(sample)
    assert [np.frombuffer(x, "<u4").tolist() for x in ids] == [TIKTOKEN.encode_ordinary(x) for x in sample]
    assert byte_bpe.Decoder(table).decode(ids) == [x.encode() for x in sample]


def test_merges_before_their_parts_are_refused():
    with pytest.raises(ValueError, match="come before"):
        vocab._table(300, list(range(256)), [(257, 1, 0, 256), (1, 2, 5, 257)]).checked()


def test_memo_forgets_but_stays_right():
    merges, _ = vocab.from_ranks(RANKS)
    encoder = byte_bpe.Encoder(merges)
    encoder.memo.limit = 50
    sample = texts(400)
    for _ in range(2):
        assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(sample)] == [TIKTOKEN.encode_ordinary(x) for x in sample]
    assert len(encoder.memo.young) + len(encoder.memo.old) < 3000


def test_queries_on_odd_rows(docs, odd, tmp_path, llm):
    docs(odd).write.parquet(f"{tmp_path}/documents.parquet")
    counted = {(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in queries.op1_token_counts(llm, str(tmp_path)).collect()}
    assert counted == {(i, len((t or "").encode()), n := len(LIBRARY.encode(t or "", add_special_tokens=False).ids), n > 1024) for i, t in odd}
    rows = queries.op10_byte_bpe(llm, str(tmp_path)).collect()
    want = set()
    for i, t in odd:
        ids = TIKTOKEN.encode_ordinary(t or "")
        want.add((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert len(rows) == len(odd) and {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows} == want


def test_clashing_columns_and_empty_tables(docs):
    clash = docs([(1, "ab cd", "x", 7)], "doc_id bigint, text string, token_ids string, n_tokens int")
    row = byte_bpe.decode(byte_bpe.encode(clash, RANKS), RANKS).first()
    assert row.n_tokens == 2 and bytes(row.decoded) == b"ab cd"
    assert byte_bpe.round_trip(docs([]), RANKS).count() == 0 == token_counts.token_counts(docs([]), JSON).count()


def test_long_columns_are_cut_into_slices():
    batch = pa.RecordBatch.from_pydict({"text": ["a" * 1000, None, "b" * 5000, ""]})
    from govmill.llm import words

    assert sum(x.num_rows for x in words.slices(batch, "text", 1500)) == 4


def test_the_pipeline_sends_texts_to_python_in_small_batches(llm):
    import corpus_pipeline

    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    docs = llm.range(40, numPartitions=1).selectExpr("id AS doc_id", "repeat('some words ', 20000) AS text", "'en' AS lang", "'own' AS source", "220000 AS n_chars")

    def sizes(batches):
        yield from (pa.RecordBatch.from_pydict({"rows": [x.num_rows], "bytes": [x.nbytes]}) for x in batches)

    try:
        coded = corpus_pipeline.encoded(llm, docs, "")
        got = docs.mapInArrow(sizes, "rows bigint, bytes bigint").collect()
        assert coded.where("lossless").count() == 40 == sum(x.rows for x in got)
        assert max(x.bytes for x in got) < 2 * corpus_pipeline.BATCH_BYTES
    finally:
        llm.conf.unset(limit)
