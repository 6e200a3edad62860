import math
import re
from collections import Counter

import numpy as np
import pytest

from aerolith.llm.lm_scoring import ADDED, BIGRAM_WEIGHT, score_documents
from aerolith.llm.queries import op8_lm_scoring
from tests.llm.fixtures import empty, odd


def words(text):
    return re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs):
    """Losses with plain counts of all other documents."""
    counts = []
    for rows in ([d for d in docs if d[2]], docs):
        uni, bi = Counter(), Counter()
        for _, t, _ in rows:
            w = words(t)
            uni.update(w)
            bi.update(zip([None, *w], w))
        counts.append((uni, bi, sum(uni.values()), sum(1 for _, t, _ in rows if words(t))))
    every = counts[1][2]
    out = {}
    for d, t, marked in docs:
        w = words(t)
        own, pairs = Counter(w), Counter(zip([None, *w], w))
        losses = []
        for (uni, bi, tokens, starts), less in zip(counts, (marked, True)):
            total = 0.0
            for a, b in zip([None, *w], w):
                p = (uni[b] - less * own[b] + ADDED) / (tokens - less * len(w) + ADDED * every)
                context = starts - less if a is None else uni[a] - less * own[a]
                if context:
                    p = BIGRAM_WEIGHT * (bi[a, b] - less * pairs[a, b]) / context + (1 - BIGRAM_WEIGHT) * p
                total -= math.log2(p)
            losses.append(total / len(w) if w else None)
        out[d] = (len(w), *losses)
    return out


def held_against(rows, want):
    got = {r["doc_id"]: r for r in rows}
    assert sorted(got) == sorted(want)
    for d, (n, target, background) in want.items():
        assert got[d]["n_tokens"] == n
        if n:
            assert abs(got[d]["target_loss"] - target) < 1e-9 and abs(got[d]["background_loss"] - background) < 1e-9
            assert abs(got[d]["score"] - (target - background)) < 1e-9
        else:
            assert got[d]["score"] is got[d]["target_loss"] is got[d]["background_loss"] is None


@pytest.mark.parametrize("cell_bytes", [1 << 13])
def test_equals_brute_force(spark, sf_dir, cell_bytes):
    docs = [(r["doc_id"], r["text"], r["doc_id"] % 3 == 0) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    docs += [(10**6, docs[1][1], False), (10**6 + 1, "", True), (10**6 + 2, None, True)]
    df = spark.createDataFrame(docs, "doc_id long, text string, t boolean").repartition(3)
    held_against(score_documents(df, df.where("t"), cell_bytes=cell_bytes, range_bytes=cell_bytes).collect(), brute(docs))


def test_query_equals_brute_force(spark, sf_dir):
    good = {r["doc_id"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1 and toxic = 0").collect()}
    docs = [(r["doc_id"], r["text"], r["doc_id"] in good) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    held_against(op8_lm_scoring(spark, sf_dir).collect(), brute(docs))


def test_texts_are_shuffled_once(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = score_documents(df, df.where("doc_id % 2 = 0"))
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan or plan.count("Scan parquet") == 2


def test_query_prefers_the_target(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = op8_lm_scoring(spark, sf_dir).collect()
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    labels = {r["doc_id"]: (r["quality"], r["toxic"]) for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    good = [r["score"] for r in rows if labels.get(r["doc_id"]) == (1, 0)]
    bad = [r["score"] for r in rows if labels.get(r["doc_id"], (1, 0))[0] == 0]
    assert np.mean(good) < np.mean(bad)


def test_odd_rows(spark):
    rows = score_documents(odd(spark), odd(spark).where("doc_id < 5 or doc_id is null")).collect()
    assert len(rows) == 10
    by = {r["doc_id"]: r for r in rows}
    for k in (2, 3, 4):
        assert by[k]["n_tokens"] == 0 and by[k]["score"] is None
    assert by[5]["n_tokens"] == 8000 and by[None]["n_tokens"] == 8
    assert by[1]["background_loss"] == by[6]["background_loss"]
    assert score_documents(empty(spark), odd(spark)).count() == 0
    far = score_documents(odd(spark).where("doc_id = 1"), odd(spark).selectExpr("doc_id + 90 as doc_id")).collect()  # ids of no document
    assert len(far) == 1 and far[0]["score"] == 0
    none = score_documents(odd(spark), empty(spark)).where("doc_id = 1").first()
    assert none["target_loss"] > none["background_loss"]
