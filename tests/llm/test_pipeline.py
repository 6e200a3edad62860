from collections import defaultdict

import pytest

import corpus_pipeline
from aerolith.llm.line_dedup import dedup_lines
from aerolith.llm.quality import score_quality
from tests.llm.fixtures import ROWS
from tests.llm.test_decontamination import brute as windows_hit
from tests.llm.test_ngram_join import brute as groups_of


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """The output of every stage over the smallest tables."""
    sf_dir, folder = "/root/testdata/sf0.001", tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = out[name] = spark.read.parquet(f"{folder}/{name}")
    return sf_dir, out


def pairs(df):
    return sorted((r["doc_id"], r["text"]) for r in df.collect())


def test_stages_keep_the_columns(tables):
    _, out = tables
    for name in ("quality", "line_dedup", "near_duplicates", "decontamination"):
        assert out[name].dtypes == out["documents"].dtypes


def test_quality_drops_what_it_rejects(spark, tables):
    sf_dir, out = tables
    scores = {r["doc_id"]: r["predicted"] for r in score_quality(out["documents"], spark.read.parquet(f"{sf_dir}/labels.parquet")).collect()}
    assert pairs(out["quality"]) == [p for p in pairs(out["documents"]) if scores[p[0]]]


def test_line_dedup_takes_effect(tables):
    _, out = tables
    want = sorted((r["doc_id"], r["text"]) for r in dedup_lines(out["quality"]).collect() if not r["n_removed"] or r["text"].strip())
    assert pairs(out["line_dedup"]) == want != pairs(out["quality"])
    assert all(r["n_chars"] == len(r["text"]) for r in out["line_dedup"].collect())


def test_one_of_each_group_stays(tables):
    _, out = tables
    groups = groups_of(pairs(out["line_dedup"]), 5, 80)
    assert [d for d, _ in pairs(out["near_duplicates"])] == sorted(d for d, _, c in groups if d == c)


def test_contaminated_documents_go(spark, tables):
    sf_dir, out = tables
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    hit = {r[0] for r in windows_hit(pairs(out["near_duplicates"]), items) if r[-1]}
    assert pairs(out["decontamination"]) == [p for p in pairs(out["near_duplicates"]) if p[0] not in hit] and hit


def test_packing_and_run(spark, tables):
    sf_dir, out = tables
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    key = lambda r: (r["doc_id"], r["piece"], r["length"], r["ids_crc32"])
    assert sorted(map(key, rows)) == sorted(map(key, out["packing"].collect()))
    assert {r["doc_id"] for r in rows} == {d for d, _ in pairs(out["decontamination"])}
    full = defaultdict(int)
    for r in rows:
        full[r["sequence_id"]] += r["length"]
    assert max(full.values()) <= 2048


def test_odd_rows_pass_through(spark, tmp_path):
    docs = spark.createDataFrame([r[:3] + ("s", 1) for r in ROWS], "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "no such words")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    left = {r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert {2, 3, 4, 5, 7, 8, None} <= left
    docs.where("false").write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
