import zlib

from aerolith.llm.queries import op6_sharding
from aerolith.llm.sharding import shard_documents
from tests.llm.fixtures import ROWS, empty, odd


def verify(rows, documents, shards):
    want = sorted((d is None, d or 0, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in documents)
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["size"], r["text_crc32"]) for r in rows) == want
    for k in range(shards):
        own = [r for r in rows if r["shard"] == k]
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
    total, longest = sum(r["size"] for r in rows), max(r["size"] for r in rows)
    for k in range(shards):
        assert abs(sum(r["size"] for r in rows if r["shard"] == k) - total / shards) <= longest + 1


def test_query(spark, sf_dir):
    rows = op6_sharding(spark, sf_dir).collect()
    verify(rows, [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()], 8)
    assert {r["law"] for r in rows} == {"bytes"} and {r["grown_shard"] for r in rows} == {None}


def test_odd_rows(spark):
    verify(shard_documents(odd(spark), 3).collect(), [(r[0], r[1]) for r in ROWS], 3)
    assert shard_documents(empty(spark)).count() == 0


def test_one_shard_and_equal_texts(spark):
    docs = spark.createDataFrame([(i, "same" if i % 3 else f"other text {i}") for i in range(300)], "doc_id long, text string")
    assert {r["shard"] for r in shard_documents(docs, 1).collect()} == {0}
    rows = shard_documents(docs, 4).collect()
    verify(rows, [(r["doc_id"], r["text"]) for r in docs.collect()], 4)


def test_few_groups_are_parted(spark):
    docs = spark.createDataFrame([(i, f"text of group {i // 4} " * 5) for i in range(4000)], "doc_id long, text string")
    rows = shard_documents(docs, 8).collect()
    groups = {}
    for r in rows:
        groups.setdefault(r["doc_id"] // 4, set()).add(r["shard"])
    assert sum(len(s) > 1 for s in groups.values()) <= 7 and {r["shard"] for r in rows} == set(range(8))
