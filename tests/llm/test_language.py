import zlib

import numpy as np

from aerolith.llm.language import UNKNOWN, fit_temperature, grams, identify_language, softmax
from aerolith.llm.queries import op2_language_id
from tests.llm.fixtures import empty, odd


def test_query_predicts_held_out_rows(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = op2_language_id(spark, sf_dir).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert np.mean([r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in held]) > 0.97
    # calibrated: the mean score is near the accuracy
    assert abs(np.mean([r["score"] for r in held]) - 1) < 0.05


def test_odd_rows(spark):
    rows = identify_language(odd(spark)).collect()
    assert len(rows) == 10
    by = {r["doc_id"]: r for r in rows}
    for k in (2, 3, 4):
        assert (by[k]["lang_pred"], by[k]["score"]) == (UNKNOWN, 0.0)
    assert by[1]["lang_pred"] in ("en", "fr", "de")
    assert identify_language(empty(spark)).count() == 0
    unlabelled = identify_language(odd(spark).selectExpr("doc_id", "text", "CAST(NULL AS string) AS lang")).collect()
    assert {r["lang_pred"] for r in unlabelled} == {UNKNOWN}


def test_grams_do_not_cross_texts():
    one, _, letters = grams(["Abc, d"])
    two, begins, _ = grams(["xyz", "Abc, d", ""])
    assert (two[:, begins[1] : begins[2]] == one).all() and letters[0] == 4
    assert (grams(["abc  !! D"])[0] == one).all()


def test_temperature_softens_an_overconfident_model():
    rng = np.random.default_rng(0)
    z = rng.normal(size=(4000, 3))
    p = softmax(z)
    labels = np.array([rng.choice(3, p=q) for q in p])
    assert abs(fit_temperature(z * 5, labels) - 5) < 0.7
