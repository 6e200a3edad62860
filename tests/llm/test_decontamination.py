import hashlib
import re

from aerolith.llm.decontamination import contamination, find_windows, remove_contaminated
from aerolith.llm.queries import op3_benchmark_decontamination
from tests.llm.fixtures import empty, odd


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[i : i + 10]), set()).add(item)
    sizes = {len(k) for k in windows}
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if (x := tuple(w[i : i + n])) in windows:
                    hit |= set(range(i, i + n))
                    found |= windows[x] - {None}
        found = sorted(map(str, found))
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(found).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


COLUMNS = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


def test_query_equals_brute_force(spark, sf_dir):
    read = lambda t: [tuple(r) for r in spark.read.parquet(f"{sf_dir}/{t}.parquet").selectExpr("doc_id" if t == "documents" else "item_id", "text").collect()]
    got = op3_benchmark_decontamination(spark, sf_dir).select(*COLUMNS).collect()
    want = brute(read("documents"), read("benchmark"))
    assert sorted(map(tuple, got), key=str) == want
    assert sum(r[-1] for r in want) > 1


def test_short_items_overlaps_and_case(spark):
    items = [(1, "Alpha beta, gamma!"), (2, "a b c d e f g h i j k l"), (3, ""), (4, None), (5, "..."), (None, "ΑΣ'Α ΟΔΟΣ x"), (6, "a b c d e f g h i j"), (6, "one")]
    docs = [
        (1, "alpha BETA gamma alpha beta gamma"),
        (2, "z a b c d e f g h i j k l a b c d e f g h i j"),
        (3, "a b c d e f g h i"),
        (4, None),
        (5, "..."),
        (6, "ΑΣ Α ΟΔΟΣ x y"),
        (7, "one One ONE two Alpha-beta"),
        (7, "one One ONE two Alpha-beta"),
        (None, "one"),
        (8, "É one é"),
    ]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    assert sorted(map(tuple, contamination(d, b).select(*COLUMNS).collect()), key=str) == brute(docs, items)
    assert {r["doc_id"] for r in remove_contaminated(d, b).collect()} == {3, 4, 5}


def test_odd_and_empty_tables(spark):
    b = spark.createDataFrame([(1, "three four five"), (2, "word " * 30)], "item_id long, text string")
    rows = contamination(odd(spark), b).collect()
    assert len(rows) == 10 and {r["doc_id"] for r in rows if r["contaminated"]} == {1, 6}
    assert contamination(empty(spark), b).count() == 0
    clean = contamination(odd(spark), b.where("false")).collect()
    assert len(clean) == 10 and not any(r["contaminated"] for r in clean)
    assert remove_contaminated(odd(spark), b).columns == odd(spark).columns
    assert find_windows(odd(spark), b).where("doc_id = 1").first()["start"] == 2
