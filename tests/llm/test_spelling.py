import random
import re
import zlib

import numpy as np
import pyarrow as pa

from aerolith.llm.queries import op11_spelling_variants
from aerolith.llm.spelling import LONG, anagram_key, followed, remainders, spelling_variants, words_of
from tests.llm.fixtures import empty, odd

LOW = {c: c + 32 for c in range(65, 91)}


def counted(rows, least=5, every=97):
    out = {}
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = run.translate(LOW)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % every == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            if len(word) >= least:
                out[word] = out.get(word, 0) + 1
    return out


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows, every=97):
    """Rows of (doc_id, text) -> sorted result tuples, all pairs of words compared."""
    words = {w: n for w, n in counted(rows, every=every).items() if n >= 3}
    by_length = {}
    for w in words:
        by_length.setdefault(len(w), []).append(w)
    form, beside = {}, {}
    for w, n in words.items():
        close = [x for k in (-1, 0, 1) for x in by_length.get(len(w) + k, ()) if x != w and near(w, x)]
        best = min(close, key=lambda x: (-words[x], x), default=None)
        form[w], beside[w] = best if best is not None and words[best] >= 2 * n else None, len(close)
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, beside[w], words.get(form[w])))
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, df.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=str)


def test_query_equals_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert got(op11_spelling_variants(spark, sf_dir)) == brute(rows)


def test_words_equal_a_plain_count():
    rng = random.Random(4)
    letters = "abAZéÀÿ× .-中\U0001f600ſ'0"
    rows = [(rng.choice([None, 1, 22, 333]), rng.choice([None, "", "x" * 300, "".join(rng.choice(letters) for _ in range(rng.randrange(80)))])) for _ in range(400)]
    found = {}
    for words, n in words_of([d for d, _ in rows], pa.array([t for _, t in rows]), 3, 7):
        for w, k in zip(words.to_pylist(), n.tolist(), strict=True):
            found[w] = found.get(w, 0) + k
    assert found == counted(rows, 3, 7)


def test_variants_of_made_up_words(spark):
    """Chains of forms, ties, anagrams that are not near, repeated letters, words longer than the exact remainders."""
    rng = random.Random(8)
    base = ["".join(rng.choice("abcé") for _ in range(rng.choice([5, 6, 7, LONG - 1, LONG, LONG + 1, LONG + 2]))) for _ in range(60)]
    words = {}
    for w in base + ["listen", "silent", "aaaaaa", "aaaaa", "aabaa"]:
        words[w] = rng.choice([3, 5, 40, 90])
        for _ in range(6):
            i, c = rng.randrange(len(w)), rng.choice("abcé")
            words[rng.choice([w[:i] + w[i + 1 :], w[:i] + c + w[i:], w[:i] + c + w[i + 1 :]])] = rng.choice([3, 6, 12, 45])
    rows = [(i, " ".join(w for w, n in words.items() if i < n)) for i in range(90)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = brute(rows, every=10**9)
    assert got(spelling_variants(df, every=10**9)) == want
    assert any(form and form != root for _, form, root, *_ in want)


def test_odd_rows(spark):
    df = odd(spark).unionByName(odd(spark)).unionByName(odd(spark))
    rows = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    assert got(spelling_variants(df)) == brute(rows) != []
    assert spelling_variants(empty(spark)).collect() == []
    huge = spark.createDataFrame([(i, "a" * 200_000 + " " + "a" * 199_999) for i in range(3)], "doc_id long, text string")
    assert [(len(r["word"]), r["n_near"], r["form"]) for r in spelling_variants(huge, every=10**9).orderBy("n_near", "word").collect()] == [(199_999, 1, None), (200_000, 1, None)]


def test_keys_and_followed_links(spark):
    codes = lambda w: np.frombuffer(w.encode("latin-1"), np.uint8)
    assert anagram_key(codes("silent"))[0] == anagram_key(codes("listen"))[0] == sum(ord(c) ** 5 for c in "tinsel")
    key, values = anagram_key(codes("lists"))
    assert anagram_key(codes("list"))[0] in key - values
    for n in (LONG - 1, LONG, LONG + 1, LONG + 2):
        word = "ab" * n
        assert remainders(word[:n])[1][3] == remainders(word[:3] + word[4:n])[0]
    chain = [(i, i + 1) for i in range(37)] + [(100, 5), (101, 37)]
    ends = {r["w"]: r["root"] for r in followed(spark.createDataFrame(chain, "w long, up long")).collect()}
    assert ends == {w: 37 for w, _ in chain}
