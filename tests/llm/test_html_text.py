import random
import re

import pytest

from aerolith.llm.html_text import ARTICLE, DECLARED, ELSEWHERE, common_lines, extract_text, kept_lines, page_lines, url_key
from aerolith.llm.queries import op7_html_extraction


def texts(html, zone=None):
    return [t for t, z in page_lines(html) if zone is None or z == zone]


def test_blocks_entities_and_markup():
    html = "<body><p>A &amp; B&nbsp; c<b>d</b>e\n f<br>g<p>next<script>var t='</p>';</script> part<!-- no --><div>in <i>it</i></div></body>"
    assert texts(html) == ["A & B cde f g", "next part", "in it"]
    assert texts('<p title="a > b">x</p><style>p{}</style>tail') == ["x", "tail"]
    assert texts("") == [] and texts("plain < text") == ["plain < text"] and texts("<p>open <script>never closed") == ["open"]


def test_declared_parts_go():
    html = (
        "<nav>menu</nav><div class='side-bar ad'>buy</div><article><header>by me</header><h1>T</h1><p>one</p><aside>x</aside><form>f</form>"
        "<section id=comments><p>reader</p></section><p class=notice>n<p>two</article><footer>foot</footer>"
    )
    assert texts(html, ARTICLE) == ["by me", "T", "one", "two"]
    assert texts("<article class='teaser related'>x</article><div>y</div>", ELSEWHERE) == ["y"]
    assert texts("<article><math>a = b</math><p hidden>h</article>") == ["a = b", "h"]


def test_articles_keep_parts_with_like_names():
    html = (
        '<article><h2 id="related-work">Related work</h2><section id="social-history"><p>Body</p></section><p class="share-price">Shares rose</p><div class="banner-image article-body"><p>All of it</p></div>'
        '<h3 class="comments">On comments</h3><div class="commentList">reader</div><div class="ad-slot top">buy</div><div id="cookie-notice">ok</div><ul class="related-posts"><li>more</ul></article>'
    )
    assert texts(html, ARTICLE) == ["Related work", "Body", "Shares rose", "All of it", "On comments"]


def test_floods_of_end_tags():
    import time

    began = time.perf_counter()
    assert texts("<div>" * 100_000 + "x" + "</p>" * 100_000 + "y") == ["x", "y"] and time.perf_counter() - began < 5
    assert texts("<nav><div>" * 3 + "menu" + "</nav>" * 3 + "text</div></section>after") == ["menu", "text", "after"]
    assert texts("<p class=ad>x<div>y</p>z", ELSEWHERE) == ["y", "z"]


def test_what_decides():
    assert kept_lines([DECLARED, ELSEWHERE, ARTICLE, ARTICLE, ELSEWHERE], {0, 2, 4}) == [1, 2, 3]
    assert kept_lines([DECLARED, ELSEWHERE, ELSEWHERE], {0, 1, 2}) == [1, 2]  # a copy


def test_long_odd_pages_take_linear_time():
    import time

    for piece in ('<a "', "<!", "<script ", "<p '", "<b>"):
        began = time.perf_counter()
        page_lines(piece * 40_000)
        assert time.perf_counter() - began < 5
    began = time.perf_counter()
    rng = random.Random(1)
    a, b = ([rng.choice([1, 1, 1, 2]) for _ in range(5000)] for _ in range(2))
    assert len(common_lines(a, b)) > 4000 and time.perf_counter() - began < 5


def test_differencing_decides_menus_without_names(spark):
    """Pages of an article and unnamed menus: the menus go as shared, unshared text outside the article stays."""
    page = lambda i: f"<div>home</div><div>shop</div><article><p>story {i}</p><p>told often</p></article><div>more of {i}</div><div>(c) us</div>"
    df = spark.createDataFrame([(i, f"http://h/x/{i}", page(i)) for i in range(9)], "page_id long, url string, html string")
    assert {r["page_id"]: r["text"] for r in extract_text(df).collect()} == {i: f"story {i}\n\ntold often\n\nmore of {i}" for i in range(9)}


def test_query_gives_the_article(spark, sf_dir):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    rows = op7_html_extraction(spark, sf_dir).collect()
    assert sorted(r["page_id"] for r in rows) == sorted(pages)
    for r in rows:
        page = pages[r["page_id"]]
        inner = re.search(r"<article>(.*?)</article>", page["html"], re.S)[1]
        blocks = [" ".join(re.sub(r"<[^>]*>", " ", b).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
        assert "".join(r["text"].split()) == "".join("".join(blocks).split()).replace("&amp;", "&").replace("&lt;", "<").replace("&gt;", ">") or "&" in inner
        assert r["n_chars"] == len(r["text"]) and r["url"] == page["url"]


def test_differencing_without_articles(spark):
    rng = random.Random(2)
    line = lambda: " ".join(rng.choice("abcdefghij") * 3 for _ in range(12))
    rows, want = [], {}
    for site in range(3):
        frame = [line() for _ in range(6)]
        for i in range(40):
            body = [line() for _ in range(rng.randint(1, 5))]
            blocks = frame[:3] + body + frame[3:]
            rows.append((site * 100 + i, f"http://h{site}.example/{i:03d}?q={rng.random()}", "".join(f"<div>{b}</div>" for b in blocks)))
            want[site * 100 + i] = "\n\n".join(body)
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    assert {r["page_id"]: r["text"] for r in extract_text(df).collect()} == want


@pytest.mark.parametrize("seed", range(20))
def test_common_lines_is_a_longest_common_subsequence(seed):
    rng = random.Random(seed)
    a, b = ([rng.randrange(4) for _ in range(rng.randrange(12))] for _ in range(2))
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    got = [a[i] for i in sorted(common_lines(a, b))]
    assert len(common_lines(a, b, 4)) == len(got)
    rest = iter(b)
    assert len(got) == best[-1][-1] and all(x in rest for x in got)


def test_odd_rows(spark):
    rows = [(1, None, None), (2, "", ""), (None, "http://a/b", "<p>x y</p>"), (4, "http://a/b", "<p>x y</p>"), (4, "http://a/b", "<p>x y</p>"), (5, "http://a/c", "<p>" + "w " * 50000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'z' AS text", "1 AS block", "'k' AS lines", "2 AS id")
    got = extract_text(df).collect()
    assert sorted((str(r["page_id"]), str(r["url"]), r["text"][:5], r["n_chars"]) for r in got) == sorted(
        [("1", "None", "", 0), ("2", "", "", 0), ("None", "http://a/b", "x y", 3), ("4", "http://a/b", "x y", 3), ("4", "http://a/b", "x y", 3), ("5", "http://a/c", "w w w", 99999)]
    )
    assert extract_text(df.where("false")).count() == 0
    assert url_key("HTTP://Host.X/a/b/?q=1#f") == ("host.x", "a/b")
