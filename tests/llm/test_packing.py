import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from aerolith.llm.packing import END_ID, cut, pack_documents, plan, token_ids
from aerolith.llm.queries import op1_best_fit_packing
from tests.llm.fixtures import ROWS, empty, odd


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def verify(rows, documents, tokenizer, capacity):
    """Every document's ids come back from its pieces, and every sequence is gapless and fits."""
    ids = {}
    for doc_id, text in documents:
        ids.setdefault((doc_id, text), []).append(tokenizer.encode(text or "", add_special_tokens=False).ids + [END_ID])
    want = sorted(
        ((doc_id is None, doc_id or 0), k, start, length, zlib.crc32(np.array(x[start : start + length], "<u4").tobytes()))
        for (doc_id, _), copies in ids.items()
        for x in copies
        for k, (start, length) in enumerate(cut(len(x), capacity))
    )
    assert sorted(((r["doc_id"] is None, r["doc_id"] or 0), r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    held = defaultdict(list)
    for r in rows:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(held)


def test_query_is_whole_and_tight(spark, sf_dir, tokenizer):
    rows = op1_best_fit_packing(spark, sf_dir).collect()
    documents = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    used = verify(rows, documents, tokenizer, 2048)
    assert used <= -(-sum(r["length"] for r in rows) // 2048) + 3


def test_odd_rows(spark, tokenizer):
    rows = pack_documents(odd(spark), capacity=64).collect()
    verify(rows, [(r[0], r[1]) for r in ROWS], tokenizer, 64)
    assert pack_documents(empty(spark)).count() == 0


def test_kept_ids(spark, tokenizer):
    rows = pack_documents(odd(spark), capacity=16, keep_ids=True).where("doc_id = 1").orderBy("piece").collect()
    assert [i for r in rows for i in r["ids"]] == tokenizer.encode(ROWS[0][1], add_special_tokens=False).ids + [END_ID]


def test_added_tokens_and_long_blanks(tokenizer):
    for text in ("a <|endoftext|> b", "<|endoftext|>" * 3, "<|endoftext|", " " * 200_000 + "x"):
        assert token_ids(text, "byte_bpe_50k.tiktoken") == tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.text())
def test_ids_equal_those_of_tokenizers(tokenizer_text):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")) if not hasattr(test_ids_equal_those_of_tokenizers, "t") else test_ids_equal_those_of_tokenizers.t
    test_ids_equal_those_of_tokenizers.t = t
    text = tokenizer_text.encode("utf-8", "ignore").decode()
    assert token_ids(text, "byte_bpe_50k.tiktoken") == t.encode(text, add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 500), max_size=25))
def test_plan_holds_every_rank_once(counts):
    rows = plan(counts, 40)
    held, at = defaultdict(int), defaultdict(int)
    for length, first, ranks, sequence, offset, per, repeats in sorted(rows):
        assert first == at[length] and ranks == per * repeats
        at[length] += ranks
    for length, _, _, sequence, offset, per, repeats in sorted(rows, key=lambda r: r[4]):
        for s in range(sequence, sequence + repeats):
            assert held[s] == offset
            held[s] += length * per
    assert dict(at) == counts and all(v <= 40 for v in held.values())


def test_very_long_runs(tokenizer):
    for text in (" " * 1_000_000 + "x", "a" * 200_000, "\n" * 200_000, "word " * 100_000):
        assert token_ids(text, "byte_bpe_50k.tiktoken") == tokenizer.encode(text, add_special_tokens=False).ids
