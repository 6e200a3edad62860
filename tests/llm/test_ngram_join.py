import random
import re
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from aerolith.llm import ngram_join
from aerolith.llm.components import components
from aerolith.llm.hashing import shingle_sets
from aerolith.llm.ngram_join import count_links, keep_one_of_each, linked, near_duplicate_groups, set_links, tree_links
from aerolith.llm.queries import op4_ngram_jaccard_join
from tests.llm.fixtures import empty, odd


def brute(docs, k=4, percent=85):
    """Rows (doc_id, n_shingles, component_id) by comparing all pairs that share a shingle."""
    sets, homes = [], {}
    for i, (_, text) in enumerate(docs):
        w = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append({tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))} if w else set())
        for x in sets[-1]:
            homes.setdefault(x, []).append(i)
    parent = list(range(len(docs)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for a, b in {p for h in homes.values() for p in combinations(h, 2)}:
        both = len(sets[a] & sets[b])
        if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            parent[root(a)] = root(b)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return sorted(((d, len(sets[i]), least.get(root(i)) if sets[i] else d) for i, (d, _) in enumerate(docs)), key=str)


def rows_of(df):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect()), key=str)


def test_query_equals_brute_force(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    want = brute(docs)
    assert rows_of(op4_ngram_jaccard_join(spark, sf_dir)) == want
    assert len({r[2] for r in want}) < len(want) - 20


def near_copies(rng, groups, copies, words=60):
    """Groups of documents around the threshold, so that links hold in part of a group."""
    docs = []
    for g in range(groups):
        base = [f"w{rng.randrange(4000)}" for _ in range(words)]
        for _ in range(copies):
            own = list(base)
            for _ in range(rng.randrange(4)):
                own[rng.randrange(words)] = f"x{rng.randrange(10**6)}"
            docs.append((len(docs) * 7 % 100_003, " ".join(own)))
    return docs


def test_threshold_groups_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "LEAF", 3)
    monkeypatch.setattr(ngram_join, "BLOCK", 5)
    docs = near_copies(random.Random(3), 6, 40) + near_copies(random.Random(9), 40, 3, 25)
    docs = [(i, t) for i, (_, t) in enumerate(docs)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert rows_of(near_duplicate_groups(df, k=4, percent=85, order_bits=12)) == brute(docs)


@pytest.mark.parametrize("every", [True, False])
def test_trees_lose_no_link(every):
    rng = random.Random(4)
    texts = [t for _, t in near_copies(rng, 8, 30)]
    sets = list(shingle_sets(pa.array(texts), 4))
    f = pd.DataFrame({"s": range(len(sets)), "component": [i % 50 for i in range(len(sets))], "set": sets})
    asking = f[f["component"] < 20]
    got = {tuple(map(int, p)) for p in tree_links(asking, f, 85, every)}
    true = {(i, j) for i in asking["s"] for j in f["s"] if i != j and linked(sets[i], sets[j], 85)}
    if every:
        assert got == {(i, j) for i, j in true if i < j}
        return
    assert got <= true and len(got) < len(sets)

    def parts(links):
        label = dict(enumerate(f["component"]))
        for i, j in links:
            old, new = label[i], label[j]
            label = {k: new if v == old else v for k, v in label.items()}
        return {frozenset(k for k in label if label[k] == v) for v in label.values()}

    assert parts(got) == parts(true)


def test_all_links_equal_brute_force(spark, monkeypatch):
    """With small leaves, blocks and lanes."""
    monkeypatch.setattr(ngram_join, "LEAF", 3)
    monkeypatch.setattr(ngram_join, "BLOCK", 7)
    monkeypatch.setattr(ngram_join, "LANE", 4)
    docs = [t for _, t in near_copies(random.Random(3), 5, 25)]
    docs = [(i, t) for i, t in enumerate([*docs, docs[0], docs[0], "", None, "a b c", "A B C"])]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    sets = list(shingle_sets(pa.array([t for _, t in docs], pa.string()), 5))
    near = {i: sum(j != i and len(sets[i]) > 0 and len(sets[j]) > 0 and linked(sets[i], sets[j], 80) for j in range(len(docs))) for i in range(len(docs))}
    links, members = set_links(df, order_bits=10)
    assert {r["doc_id"]: r["n_links"] for r in count_links(links, members).collect()} == near
    assert rows_of(near_duplicate_groups(df, order_bits=10)) == brute(docs, 5, 80)


def test_members_that_fit_no_leader_are_compared(spark, monkeypatch):
    """A group whose leaders are all short must still hold the links of its long members."""
    monkeypatch.setattr(ngram_join, "LEAF", 3)
    same = " ".join(f"c{i}" for i in range(9))
    short = [f"{same} s{i} t{i}" for i in range(12)]
    tail = " ".join(f"e{i}" for i in range(60))
    long = [f"{same} {tail} l{i}" for i in range(12)]
    docs = list(enumerate(short + long))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert rows_of(near_duplicate_groups(df, order_bits=4)) == brute(docs, 5, 80)


def test_counts_keep_their_order_in_sixteen_bits():
    counts = np.unique(np.concatenate([np.arange(40_000), np.geomspace(4e4, 1e14, 5000).astype(np.int64)]))
    codes = ngram_join.count_codes(counts).astype(int)
    assert (np.diff(codes) >= 0).all() and (codes[:32_768] == counts[:32_768]).all()
    hot = counts[(counts > 1 << 15) & (counts < 2**46)]
    lanes = ngram_join.lanes_of(ngram_join.count_codes(hot))
    assert (lanes * ngram_join.LANE >= hot).all() and (lanes * ngram_join.LANE <= hot * 1.01 + 2 * ngram_join.LANE).all()


def test_components(spark):
    rng = np.random.default_rng(0)
    edges = [(i, i + 1) for i in range(60)] + [(int(a), int(b)) for a, b in rng.integers(100, 400, (150, 2))] + [(500, 500)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    label = {x: x for e in edges for x in e}
    for _ in range(400):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    assert {k: v for k, v in label.items() if any(k in e and e[0] != e[1] for e in edges)} == got


def test_odd_rows(spark):
    assert rows_of(near_duplicate_groups(odd(spark), order_bits=8)) == brute([(r["doc_id"], r["text"]) for r in odd(spark).collect()], 5, 80)
    assert near_duplicate_groups(empty(spark), order_bits=8).count() == 0
    kept = keep_one_of_each(odd(spark), order_bits=8)
    assert kept.columns == odd(spark).columns and kept.where("doc_id in (1, 6)").count() == 1
