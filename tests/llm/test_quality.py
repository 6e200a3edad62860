import zlib

import numpy as np

from aerolith.llm.quality import FEATURES, fit_quality, keep_quality, score_quality, statistics
from aerolith.llm.queries import op5_quality_classifier
from tests.llm.fixtures import empty, odd


def test_query_tells_held_out_classes_apart(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = op5_quality_classifier(spark, sf_dir).collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert sorted(r["doc_id"] for r in rows) == sorted(r[0] for r in docs.select("doc_id").collect())
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    marks = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    good = np.array([r["score"] for r in rows if r["held_out"] and marks.get(r["doc_id"]) == 1])
    bad = np.array([r["score"] for r in rows if r["held_out"] and marks.get(r["doc_id"]) == 0])
    assert (good[:, None] > bad[None, :]).mean() > 0.97 and (good >= 0.3).mean() > 0.97


def test_odd_rows(spark):
    labels = spark.createDataFrame([(1, 1), (5, 0), (6, 1), (7, None), (None, 1), (9, 3)], "doc_id long, quality int")
    rows = score_quality(odd(spark), labels).collect()
    assert len(rows) == 10 and all(0 <= r["score"] <= 1 for r in rows)
    by = {r["doc_id"]: r["score"] for r in rows}
    assert by[2] == by[3]
    assert score_quality(empty(spark), labels).count() == 0
    none = score_quality(odd(spark), labels.where("false")).collect()
    assert {r["score"] for r in none} == {0.5}
    kept = keep_quality(odd(spark), labels.where("false"))
    assert kept.columns == odd(spark).columns and kept.count() == 10


def test_discriminant_follows_bayes_on_gaussians(spark):
    rng = np.random.default_rng(3)
    k = len(FEATURES)
    x0, x1 = rng.normal(0, 1, (3000, k)), rng.normal(0.5, 1.6, (3000, k))
    rows = [(x.tolist(), y) for y, xs in ((0, x0), (1, x1)) for x in xs]
    model = fit_quality(spark.createDataFrame(rows, "f array<double>, y int"), pooling=0.0, diagonal=0.0)
    z0, z1 = rng.normal(0, 1, (2000, k)), rng.normal(0.5, 1.6, (2000, k))
    true = lambda x: (-0.5 * ((x - 0.5) / 1.6) ** 2 - np.log(1.6) + 0.5 * x**2).sum(1)
    assert np.corrcoef(model.differences(np.concatenate([z0, z1])), true(np.concatenate([z0, z1])))[0, 1] > 0.99
    p = model.scores(np.concatenate([z0, z1]))
    assert abs(p.mean() - 0.5) < 0.03


def test_statistics_are_finite():
    for t in ("", " ", "\n\n", "a", "!!!", "é" * 50, "x " * 5000, "\U0001f600"):
        assert len(statistics(t)) == len(FEATURES) and np.isfinite(statistics(t)).all()
