import hashlib
import re

import numpy as np
import pyarrow as pa

from aerolith.llm.fingerprints import FRACTION, compare, decode, fingerprints, merge, paired_fingerprints, sketch
from aerolith.llm.hashing import shingle_sets
from aerolith.llm.queries import op10_document_fingerprints
from tests.llm.fixtures import empty, odd


def shingles(text, k=5):
    w = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def test_shingle_sets_count_words_right():
    texts = ["", None, "a", "A b\tc\u000bd e f a b c d e f", " x", "x y z é", "the end "]
    for k in (1, 2, 5):
        sizes = [len(s) for s in shingle_sets(pa.array(texts), k)]
        assert sizes == [len(shingles(t or "", k)) for t in texts]
    sliced = pa.array(["zz yy", *texts]).slice(1)
    assert [list(a) for a in shingle_sets(sliced, 2)] == [list(a) for a in shingle_sets(pa.array(texts), 2)]


def test_query(spark, sf_dir):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()]
    rows = {r["doc_id"]: r for r in op10_document_fingerprints(spark, sf_dir).collect()}
    assert len(rows) == len(docs)
    errors, misses = [], []
    hashes = dict(zip([d for d, _ in docs], shingle_sets(pa.array([t for _, t in docs]), 5), strict=True))
    for i, (doc_id, text) in enumerate(docs):
        r, (next_id, following), n = rows[doc_id], docs[(i + 1) % len(docs)], len(text)
        edited = text[: n - n // 2] + following[: n // 2]
        assert (r["n_chars"], r["edited_sha256"]) == (n, hashlib.sha256(edited.encode()).hexdigest())
        own, new = ([x for x in hashes[d] if x < 2**64 * FRACTION] for d in (doc_id, next_id))
        assert list(decode(r["fingerprint"])) == own
        both = len(set(own) & set(new))
        assert r["near_next"] == (1.0 if text == following else both / (len(own) + len(new) - both) if own and new else 0.0)
        assert r["in_next"] == (1.0 if text == following else both / len(own) if own and new else 0.0)
        a, b = shingles(text), shingles(edited)
        exact = len(a & b) / len(a | b) if a | b else 1.0
        misses.append(abs(exact - r["near_edited"]))
        assert r["near_edited"] < 1.0 or exact > 0.8 or text == edited
        if len(own) > 8:
            errors.append((len(a & b) / len(a | b) - r["near_edited"]) / (0.5 / len(own) ** 0.5))
            assert abs(len(a & b) / len(a) - r["in_edited"]) < 2.5 / len(own) ** 0.5
    assert abs(np.mean(errors)) < 0.3 and np.abs(errors).max() < 5
    assert np.mean(misses) < 0.08 and np.quantile(misses, 0.95) < 0.35  # all texts, those with empty sketches among them
    prints = {}
    for doc_id, text in docs:
        assert prints.setdefault(text, rows[doc_id]["fingerprint"]) == rows[doc_id]["fingerprint"]


def test_merging_and_containment():
    rng = np.random.default_rng(0)
    a, b = (np.unique(rng.integers(0, 2**64, n, dtype=np.uint64)) for n in (40_000, 1_000))
    part = np.union1d(a[:: 10], b)
    assert (merge(sketch(a), sketch(b)) == sketch(np.union1d(a, b))).all() and len(sketch(a, 1)) == len(a)
    _, in_part, in_a = compare(sketch(a), sketch(part))
    assert abs(in_a - 0.8) < 0.12 and abs(in_part - 0.1) < 0.03


def test_odd_rows(spark):
    rows = paired_fingerprints(odd(spark)).collect()
    assert len(rows) == 10
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r)
    assert by[2][0]["fingerprint"] == by[3][0]["fingerprint"] == by[4][0]["fingerprint"] == ""
    assert by[1][0]["fingerprint"] == by[6][0]["fingerprint"] == by[6][1]["fingerprint"]
    assert by[2][0]["near_next"] == 1.0 and by[1][0]["near_next"] == 0.0  # next of 1 is the null text of 2
    assert paired_fingerprints(empty(spark)).count() == 0 == fingerprints(empty(spark)).count()
    one = paired_fingerprints(odd(spark).where("doc_id = 1")).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0
    short = spark.createDataFrame([(1, "one two"), (2, "three four"), (3, "three four")], "doc_id long, text string")
    assert [r["near_next"] for r in paired_fingerprints(short, fraction=1e-9).orderBy("doc_id").collect()] == [0.0, 1.0, 0.0]
    assert {len(decode(r["fingerprint"])) for r in fingerprints(odd(spark), fraction=1).where("doc_id = 7").collect()} == {1}
