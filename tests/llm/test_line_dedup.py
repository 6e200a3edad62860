import random
import re
from itertools import pairwise

from pyspark.sql import functions as F

from aerolith.llm import line_dedup
from aerolith.llm.line_dedup import dedup_lines, without_repeated_lines
from aerolith.llm.queries import op9_line_dedup
from tests.llm.fixtures import ROWS, empty, odd


def lines(text):
    return [x for x in re.split(r"(?<=\n)|(?<=[.!?] )", text or "")]


def bare(text):
    return [x.strip(" \n\r\t") for x in lines(text)]


def sentence(rng, n=12):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(n)) + ". "


def test_query_removes_nothing_but_what_occurs_before(spark):
    """Every removed line stands in an earlier text, next to a removed or equal neighbour; kept lines keep their order."""
    sf_dir = "/root/testdata/sf0.01"
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = {r["doc_id"]: r for r in op9_line_dedup(spark, sf_dir).collect()}
    assert sorted(rows) == sorted(docs)
    first = {}
    for d in sorted(docs):
        for i, x in enumerate(bare(docs[d])):
            first.setdefault(x, (d, i))
    changed = 0
    for d, r in rows.items():
        assert r["n_lines"] == len(lines(docs[d]))
        if not r["n_removed"]:
            assert r["text"] == docs[d]
            continue
        changed += 1
        left, at = [x for x in lines(r["text"]) if x], 0
        assert len(left) in (r["n_lines"] - r["n_removed"], r["n_lines"] - r["n_removed"] - 1)
        for i, x in enumerate(lines(docs[d])):
            if not x:
                continue
            if at < len(left) and left[at] == x:
                at += 1
            else:
                assert first[bare(docs[d])[i]] < (d, i)
        assert at == len(left)
    assert changed > 20


def test_planted_passages_are_cut_once(spark):
    rng = random.Random(5)
    passages = ["".join(sentence(rng, 11) for _ in range(9)) for _ in range(30)]
    docs, homes = [], {}
    for d in range(400):
        parts = [sentence(rng, rng.randint(3, 20)) for _ in range(12)]
        if d % 2:
            p = rng.randrange(30)
            parts.insert(rng.randint(0, 12), passages[p])
            homes.setdefault(p, d)
        docs.append((d, "".join(parts)))
    rows = {r["doc_id"]: r["text"] for r in dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    caught = total = 0
    for d, text in docs:
        for p, passage in enumerate(passages):
            if passage in text:
                if homes[p] == d:
                    assert passage in rows[d]
                else:
                    total += 1
                    caught += passage not in rows[d]
                    if passage not in rows[d]:
                        assert rows[d] == text.replace(passage, "")
        if d % 2 == 0:
            assert rows[d] == text
    assert caught > 0.9 * total > 100


def test_copies_and_short_repeats(spark):
    rng = random.Random(1)
    a, b = ("".join(sentence(rng) for _ in range(6)) for _ in range(2))
    docs = [(1, a), (2, a), (3, "Short line here once. " + b), (4, "Short line here once. " + sentence(rng)), (5, b + b), (None, a)]
    rows = {r["doc_id"]: (r["text"], r["n_removed"]) for r in dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert rows[None] == (a, 0) and rows[1][0] == rows[2][0] == "" and rows[3][1] == rows[4][1] == 0
    assert rows[5][0] == "" and rows[5][1] >= 12
    kept = without_repeated_lines(spark.createDataFrame(docs, "doc_id long, text string"), size_col=None).collect()
    assert sorted(r["doc_id"] or 0 for r in kept) == [0, 3, 4]


def test_odd_rows(spark):
    rows = dedup_lines(odd(spark)).collect()
    assert sorted(str(r["text"]) for r in rows if r["doc_id"] != 5) == sorted(str(r[1]) for r in ROWS if r[0] != 5)
    assert dedup_lines(empty(spark)).count() == 0
    assert without_repeated_lines(odd(spark)).columns == odd(spark).columns
    assert all(x <= y for x, y in pairwise(sorted(r["n_removed"] for r in rows)))


def brute(docs, least_words=25, lone_words=50):
    """Texts without every line of a run that is long enough and stands in the same order before: all runs, all places."""
    seen, out = set(), {}
    for d, text in docs:
        b = bare(text)
        b = b[:-1] if b[-1] == "" and not lines(text)[-1] else b  # nothing stands after the last line's end
        gone = set()
        for i in range(len(b)):
            for j in range(i, len(b)):
                n = sum(len(x.split()) for x in b[i : j + 1])
                if n >= lone_words or (j > i and n >= least_words):
                    if tuple(b[i : j + 1]) in seen:
                        gone |= set(range(i, j + 1))
                    seen.add(tuple(b[i : j + 1]))
        out[d] = [x for i, x in enumerate(lines(text)) if i not in gone and x.strip()]
    return out


def test_two_document_plants_are_all_cut(spark):
    """A passage of one to five sentences that stands once each in two documents, between other neighbours."""
    rng = random.Random(11)
    docs, plants = [], []
    for m in range(1, 6):
        for _ in range(40):
            passage = "".join(sentence(rng, max(13, -(-50 // m)) + rng.randint(0, 4)) for _ in range(m))
            for _ in range(2):
                docs.append((len(docs), "".join(sentence(rng, rng.randint(3, 20)) for _ in range(4)) + passage + "".join(sentence(rng, rng.randint(3, 20)) for _ in range(4))))
            plants.append((len(docs) - 1, m, passage))
    rows = {r["doc_id"]: (r["text"], r["n_removed"]) for r in dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    texts = dict(docs)
    for d, m, passage in plants:
        assert rows[d] == (texts[d].replace(passage, ""), m)
        assert rows[d - 1] == (texts[d - 1], 0)


def test_equals_all_runs_by_brute_force(spark):
    """Short and long lines, blank lines and newlines from a small stock, so that runs of all kinds repeat."""
    rng = random.Random(3)
    stock = [sentence(rng, n) for n in (1, 1, 2, 3, 5, 8, 11, 12, 13, 24, 25, 26, 30, 49, 50, 51)] + ["\n", "\n", "One line.\n"]
    docs = [(d, "".join(rng.choice(stock) for _ in range(rng.randint(1, 14)))) for d in range(150)]
    rows = dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    got = {r["doc_id"]: [x for x in lines(r["text"]) if x.strip()] for r in rows}
    assert got == brute(docs)


def test_pairs_of_lines_go_whose_lines_stood_alone_before(spark):
    """Passages of two lines, whole in two documents, with each line alone in an earlier one: the second copy goes in every case."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    line = lambda n: " ".join(word() for _ in range(n))
    docs, passages = [], []
    for i in range(30):
        a, b = line(30), line(30)
        passages.append(f"{a}\n{b}")
        docs += [(100 + 2 * i, f"{line(9)}\n{a}\n{line(9)}"), (101 + 2 * i, f"{line(9)}\n{b}\n{line(9)}")]
    docs += [(1000 + k * 100 + i, f"{line(40)}\n{p}\n{line(40)}") for k in (0, 1) for i, p in enumerate(passages)]
    got = {r["doc_id"]: r["text"] for r in dedup_lines(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()}
    assert all(p in got[1000 + i] and p not in got[1100 + i] for i, p in enumerate(passages))
    assert all(got[d] == t for d, t in docs if d < 1000)


def test_windows_are_compiled_distinct_and_whole(spark):
    """Each line's least windows, listed once, from rows of lines: no lambda stands above them, nor a filter that makes the arrays again."""
    rng = random.Random(9)
    texts = [[rng.choice([1, 2, 3, 5, 11, 13, 24, 25, 26, 49, 50, 51, 0, 0]) for _ in range(rng.randint(1, 12))] for _ in range(300)]
    docs = spark.createDataFrame([(d, d, [" ".join("w" * n) for n in text]) for d, text in enumerate(texts)], "d long, k long, lines array<string>")
    for least, lone in (25, 50), (3, 6), (10, 10):
        found = line_dedup._windows(docs, least, lone)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "Generate posexplode" in plan and "lambda" not in plan.split("Generate posexplode")[0] and "Filter (size" not in plan
        want = []
        for d, text in enumerate(texts):
            text, spans = text[:-1] if text[-1] == 0 else text, set()
            long = lambda i, j, text=text: sum(text[i : j + 1]) >= (least if j > i else lone)
            for i in (i for i, n in enumerate(text) if n):
                ends, starts = [j for j in range(i, len(text)) if long(i, j)], [j for j in range(i + 1) if long(j, i)]
                spans |= {(i, j) for j in ends[:1]} | {(j, i) for j in starts[-1:]}
            want.append(spans)
        got = [(r["d"], r["a"], r["a"] + r["n"] - 1) for r in found.collect()]
        assert len(got) == len(set(got))
        assert all((d, *s) in set(got) for d, spans in enumerate(want) for s in spans)


def test_signed_lines_are_the_lines(spark):
    rng = random.Random(4)
    texts = ["", "x", "n\n", "b. x", *("".join(rng.choice(["a", "b", "n", "x", " ", "\n", ". ", "! ", "?", "\r", "é"]) for _ in range(rng.randint(0, 30))) for _ in range(500))]
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    signed = line_dedup._signed(F.col("text"))
    odd_lines = F.filter(signed, lambda x, i: i % 2 == 1)
    got = rows.select("text", F.size(signed).alias("n"), line_dedup._unsigned(signed).alias("all"), line_dedup._unsigned(odd_lines).alias("odd")).collect()
    for r in got:
        assert (r["n"], r["all"], r["odd"]) == (len(lines(r["text"])), r["text"], "".join(lines(r["text"])[1::2]))
