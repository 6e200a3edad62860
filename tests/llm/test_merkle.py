import hashlib
import zlib

from pyspark.sql import functions as F

from aerolith.llm.merkle import folded, merkle_manifest, numbered, proof_digest, verified_manifest
from aerolith.llm.queries import op12_merkle_manifest
from tests.llm.fixtures import ROWS, empty, odd

LOW = {c: c + 32 for c in range(65, 91)}


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, source, lang, n_chars, text):
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def climb(nodes, fanout):
    """Root of a list of digests, and for each its (left, right) texts level by level."""
    paths = [[] for _ in nodes]
    owners = [[j] for j in range(len(nodes))]
    while len(nodes) > 1:
        up, up_owners = [], []
        for a in range(0, len(nodes), fanout):
            run = nodes[a : a + fanout]
            for j in range(len(run)):
                for o in owners[a + j]:
                    paths[o].append(("".join(run[:j]), "".join(run[j + 1 :])))
            up.append(H(*run))
            up_owners.append([o for x in owners[a : a + fanout] for o in x])
        nodes, owners = up, up_owners
    return nodes[0], paths


def brute(rows, fanout=16):
    """Rows of (doc_id, text, lang, source, n_chars) -> sorted result tuples."""
    by = {}
    for d, text, lang, source, n in rows:
        low = None if text is None else text.translate(LOW)
        own = leaf(d, source, lang, n, text)
        changed = leaf(d, source, lang, n, low) if d is not None and zlib.crc32(str(d).encode()) % 5 == 0 else own
        by.setdefault(source, []).append((d, own, changed))
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in order:
        by[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        trees.append(climb([r[1] for r in by[s]], fanout))
    root, tops = climb([t[0] for t in trees], fanout)
    out = []
    for s, (subroot, paths), top in zip(order, trees, tops, strict=True):
        for (d, own, changed), path in zip(by[s], paths, strict=True):
            h = changed
            for left, right in path + top:
                h = H(left, h, right)
            out.append((d, own, subroot, root, H(*(a + b for a, b in path + top)), h, h == root))
    return sorted(out, key=str)


def test_query_equals_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    got = sorted(map(tuple, op12_merkle_manifest(spark, sf_dir).collect()), key=str)
    assert got == brute(rows)
    assert 0 < sum(not r[-1] for r in got) < len(got) / 3  # changed texts are found, all others verify


def test_odd_rows(spark):
    got = sorted(map(tuple, verified_manifest(odd(spark)).collect()), key=str)
    assert got == brute(ROWS)
    assert verified_manifest(empty(spark)).collect() == []
    lone = verified_manifest(odd(spark).where("doc_id = 7")).collect()
    assert len(lone) == 1 and lone[0]["leaf"] == lone[0]["subroot"] == lone[0]["root"] == lone[0]["folded_root"] and lone[0]["proof_sha256"] == H()


def test_sources_of_all_sizes(spark):
    """Runs of one, levels that end early, null and empty sources, and a source with most rows."""
    sizes = {None: 1, "": 4, "a": 5, "b": 17, "É": 16, "hot": 300, "z": 1, **{f"s{i}": 1 + i % 3 for i in range(20)}}
    rows = [(10 * j + i, f"Text {j} {i}", "en", s, i) for j, (s, n) in enumerate(sizes.items()) for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(7)
    assert sorted(map(tuple, verified_manifest(df).collect()), key=str) == brute(rows)
    out = merkle_manifest(df, fanout=4).select("leaf", "root", folded(F.col("leaf"), F.col("path")).alias("f"), proof_digest(F.col("path")).alias("p"), F.size("path").alias("n"))
    got = out.collect()
    assert {r["f"] for r in got} == {r["root"] for r in got} and len({r["root"] for r in got}) == 1
    assert got[0]["root"] == brute(rows, 4)[0][3] and max(r["n"] for r in got) == 5 + 3


def test_numbers_of_a_hot_group(spark):
    rows = [("a" if i < 900 else f"b{i % 7}", i) for i in range(1000)]
    got = numbered(spark.createDataFrame(rows, "g string, v long").repartition(9), "g", ["v"]).collect()
    want = {}
    for g, v in sorted(rows):
        want[(g, v)] = len([1 for x in want if x[0] == g])
    assert {(r["g"], r["v"]): r["i"] for r in got} == want
