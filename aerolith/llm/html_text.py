"""HTML extraction: nearest-URL page differencing.

Pages are ordered by host and path; each is paired with the neighbour of its host whose path shares the longest prefix,
their lines of text are aligned by longest common subsequence, and shared lines go.  The markup is a guard on both
sides.  Shared lines inside an article element stay, because copies of articles and passages that articles share are
common and deleting them would lose text.  Lines that the markup declares to be menus, forms, adverts and the like go even where the
neighbour does not have them, as adverts and readers' comments seldom repeat.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: No alternative reads past the next "<" outside quotes, so unclosed tags cost no more than their length.
_INSIDE = r"(?:[^<>\"']|\"[^\"]*\"|'[^']*')*+"
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>script|style|noscript|template|svg|iframe|textarea|select|title)\b{_INSIDE}>.*?(?:</(?P=raw)\s*>|\Z)"
    rf"|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest>{_INSIDE})>"
    r"|<[!?][^<>]*>",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CONTAINERS = frozenset(["article", "main"])
PLAIN_TAGS = frozenset("nav header footer aside form menu dialog button".split())
PLAIN_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer header login masthead menu "
    "modal nav navbar navigation newsletter notice notices popup promo recommended related replies reply respond search share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)
#: Words that say where such a part stands or of what kind it is, and so change nothing about it; words of an article's own parts.
NEUTRAL_WORDS = frozenset(
    "area bar block bottom box column container content fixed global group holder inner item items left links list main mobile outer page panel part post posts primary right row secondary section side site slot sticky top "
    "unit wrap wrapper zone".split()
)
OWN_WORDS = frozenset("article body entry prose story".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PLAIN_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())
#: Where a line stands: in what the markup declares no text, elsewhere, in an article.
DECLARED, ELSEWHERE, ARTICLE = 0, 1, 2
_SAFE = frozenset(["html", "body", "main"])


def _names_plain(value: str) -> bool:
    """Whether a class or id names a part that holds no text of the article.

    One of its names must be made of plain words, neutral ones beside them at most, so `comment-list` and `ad slot` do but `related-work` and `share-price` do not; and
    none may be made of an article's own words.
    """
    found = False
    for name in value.split():
        words = set(re.split(r"[^a-z0-9]+", re.sub(r"(?<=[a-z0-9])(?=[A-Z])", " ", name).lower())) - {""}
        if words & OWN_WORDS:
            return False
        found |= bool(words & PLAIN_WORDS) and words <= PLAIN_WORDS | NEUTRAL_WORDS
    return found


def _is_plain(tag: str, rest: str, inside: bool) -> bool:
    if tag in PLAIN_TAGS and not (tag == "header" and inside):  # an article's own header holds its headline
        return True
    if tag in _SAFE or tag in HEADINGS or not rest.strip(" /\n\t\r"):
        return False
    for m in ATTRIBUTE.finditer(rest):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name in ("class", "id") and _names_plain(value) or name == "role" and value.lower() in PLAIN_ROLES:
            return True
    return False


def page_lines(html: str) -> list[tuple[str, int]]:
    """The blocks of a page in order, white space joined, with where each stands."""
    from html import unescape

    out: list[tuple[str, int]] = []
    held: list[str] = []
    stack: list[tuple[str, bool, bool]] = []  # tag, plain, container
    opened: dict[str, int] = {}  # how often each tag stands there, so that an end without a start costs nothing
    plain = inside = 0
    where = ELSEWHERE

    def close() -> None:
        if held:
            text = " ".join("".join(held).split())
            held.clear()
            if text:
                out.append((text, where))

    at = 0
    for m in TOKEN.finditer(html):
        if m.start() > at:
            if not held:
                where = DECLARED if plain else ARTICLE if inside else ELSEWHERE
            held.append(unescape(html[at : m.start()]))
        at = m.end()
        tag = m["tag"]
        if not tag:
            continue
        tag = tag.lower()
        if tag == "br":
            held.append(" ")
            continue
        if tag in BLOCKS:
            close()
        if m["end"]:
            if opened.get(tag):
                k = next(k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == tag)
                changed = any(p or c for _, p, c in stack[k:])
                if changed:
                    close()
                for t, p, c in stack[k:]:
                    plain, inside = plain - p, inside - c
                    opened[t] -= 1
                del stack[k:]
        elif tag not in VOID:
            if tag in BLOCKS and stack and stack[-1][0] == "p":  # a paragraph ends where a block begins
                plain -= stack.pop()[1]
                opened["p"] -= 1
            p, c = _is_plain(tag, m["rest"], inside > 0), tag in CONTAINERS
            if p or c:
                close()
            if (p or c or tag in BLOCKS) and not m["rest"].endswith("/"):
                if tag != "p" or p:
                    stack.append((tag, p, c))
                    opened[tag] = opened.get(tag, 0) + 1
                plain, inside = plain + (p and (tag != "p" or p)), inside + c
    if at < len(html):
        if not held:
            where = DECLARED if plain else ARTICLE if inside else ELSEWHERE
        held.append(unescape(html[at:]))
    close()
    return out


def _steps(a: list[int], b: list[int]) -> Iterator[int]:
    """After each of `b`: a number whose bit i is unset where a longest common subsequence with a[: i + 1] is longer than with a[:i]."""
    where: dict[int, int] = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << i
    every = (1 << len(a)) - 1
    v = every
    for y in b:
        u = v & where.get(y, 0)
        v = ((v + u) | (v - u)) & every
        yield v


def _lengths(a: list[int], b: list[int]) -> np.ndarray:
    """Lengths of the longest common subsequences of `b` with each beginning of `a`."""
    v = (1 << len(a)) - 1
    for v in _steps(a, b):  # noqa: B007
        pass
    bits = np.unpackbits(np.frombuffer(v.to_bytes(len(a) // 8 + 1, "little"), np.uint8), bitorder="little")[: len(a)]
    return np.concatenate([[0], np.cumsum(bits == 0)])


def common_lines(a: list[int], b: list[int], limit: int = 1 << 28) -> set[int]:
    """Places in `a` of a longest common subsequence of `a` and `b`, found in whole numbers of len(a) bits.

    Repeated lines cost no more than others.  Where the numbers together would exceed `limit` bits, `b` is halved and `a` cut where
    both halves fit best.
    """
    n = min(len(a), len(b))
    lo = next((i for i in range(n) if a[i] != b[i]), n)
    hi = next((i for i in range(n - lo) if a[-1 - i] != b[-1 - i]), n - lo)
    kept = set(range(lo)) | set(range(len(a) - hi, len(a)))
    a, b = a[lo : len(a) - hi], b[lo : len(b) - hi]
    if not a or not b:
        return kept
    if len(a) * len(b) > limit and len(b) > 1:
        half = len(b) // 2
        k = int((_lengths(a, b[:half]) + _lengths(a[::-1], b[half:][::-1])[::-1]).argmax())
        return kept | {lo + i for i in common_lines(a[:k], b[:half], limit)} | {lo + k + i for i in common_lines(a[k:], b[half:], limit)}
    steps = list(_steps(a, b))
    i, j = len(a), len(b)
    while i and j:
        if steps[j - 1] >> (i - 1) & 1:
            i -= 1
        else:
            j -= 1
            if not j or steps[j - 1] >> (i - 1) & 1:
                i -= 1
                kept.add(lo + i)
    return kept


def kept_lines(zones: list[int], shared: set[int]) -> list[int]:
    """The lines that are left of a page whose lines in `shared` the nearest page has too."""
    new = [i for i, z in enumerate(zones) if z == ARTICLE or z == ELSEWHERE and i not in shared]
    return new or [i for i, z in enumerate(zones) if z == ELSEWHERE]


def url_key(url: str | None) -> tuple[str, str]:
    """Host and path of a URL; query and fragment do not count."""
    rest = re.sub(r"^[a-zA-Z][a-zA-Z0-9+.-]*://", "", url or "")
    rest = re.split(r"[?#]", rest, maxsplit=1)[0]
    host, _, path = rest.partition("/")
    return host.lower(), path.rstrip("/")


def _nearer(path: str, before: str | None, after: str | None) -> int | None:
    """0 for the page before, 1 for that after, None if neither is of the host."""
    if before is None or after is None:
        return 0 if before is not None else 1 if after is not None else None

    def shared(x: str) -> int:
        return next((i for i, (p, q) in enumerate(zip(path, x)) if p != q), min(len(path), len(x)))

    return int(shared(after) > shared(before))


def _block_bounds(pages: DataFrame) -> list[tuple[tuple, tuple]]:
    """Smallest and largest key of each range of pages, in order; two keys per range reach the driver."""
    parts = 2 * int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = F.struct("host", "path", "url", "page_id")
    ranged = pages.select("host", "path", "url", "page_id").repartitionByRange(parts, "host", "path", "url", "page_id")
    found = ranged.groupBy(F.spark_partition_id().alias("part")).agg(F.min(key).alias("low"), F.max(key).alias("high")).collect()
    return sorted((tuple(r["low"]), tuple(r["high"])) for r in found)


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Columns page_id, url, text, n_chars: one row per row of `pages`.

    Blocks hold decoded text with white space as one blank; text joins the kept blocks, in page order, by two newlines.
    A line goes if the nearest page of the host has it too, unless it stands in an article or main element, or if the markup
    declares it to be of menus, headers, footers, sidebars, notices, adverts, forms or comments.  Where nothing would be left
    of a page without an article, as of a copy, its shared lines stay.  Of two neighbours that are as near, the one before counts.  A null
    html is empty and gives an empty text; a null URL is of the empty host; repeated rows are pages of their
    own, and copies of each other.  Very long pages are read whole, in time that grows with their length, or for the
    alignment with the product of the numbers of lines that differ, by 64.  An empty table gives no rows; other columns are ignored.
    """

    @F.pandas_udf("host string, path string")
    def keys(url):
        import pandas as pd

        return pd.DataFrame([url_key(u) for u in url], columns=["host", "path"])

    slim = pages.select(F.coalesce(F.col(id_col).cast("long"), F.lit(-(2**63))).alias("page_id"), F.coalesce(F.col(url_col).cast("string"), F.lit("")).alias("url"), F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("link"), F.col(html_col).cast("string").alias("html"))
    slim = slim.withColumn("key", keys("url")).select("key.host", "key.path", "url", "page_id", "id", "link", "html")
    bounds = _block_bounds(slim)
    lows = [low for low, _ in bounds]
    names = ["block", "kind", "host", "path", "url", "page_id", "id", "link", "lines", "hashes", "zones"]
    kinds = [pa.int32(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.string()), pa.list_(pa.int64()), pa.list_(pa.int32())]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from hashlib import blake2b

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = []
                for host, path, url, page_id, own, link, html in zip(*(c.to_pylist() for c in batch.slice(at, 256).columns), strict=True):
                    lines = page_lines(html or "")
                    hashes = [int.from_bytes(blake2b(t.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True) for t, _ in lines]
                    zones = [z for _, z in lines]
                    key = (host, path, url, page_id)
                    b = max(0, bisect_right(lows, key) - 1)
                    rest = (host, path, url, page_id, own, link)
                    rows.append((b, 1, *rest, [t if z else "" for t, z in lines], hashes, zones))
                    # The ends of a range are also sent, without their texts, to the ranges next to it.
                    if b > 0 and key == bounds[b][0]:
                        rows.append((b - 1, 2, *rest, [], hashes, zones))
                    if b + 1 < len(bounds) and key == bounds[b][1]:
                        rows.append((b + 1, 0, *rest, [], hashes, zones))
                columns = list(zip(*rows, strict=True)) or [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    parsed = slim.mapInArrow(parse, "block int, kind int, host string, path string, url string, page_id long, id long, link string, lines array<string>, hashes array<long>, zones array<int>")
    routed = parsed.repartitionById(max(len(bounds), 1), F.col("block")).sortWithinPartitions("block", "kind", "host", "path", "url", "page_id")

    def text_of(page: tuple, before: tuple | None, after: tuple | None) -> str:
        lines, hashes, zones = page[4], page[5], page[6]
        same = [None if p is None or p[:2] != page[:2] else p for p in (before, after)]
        side = _nearer(page[2], *(p and p[2] for p in same))
        shared = common_lines(hashes, same[side][5]) if side is not None else set()
        return "\n\n".join(lines[i] for i in kept_lines(zones, shared))

    def differ(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = page = None
        done: list[tuple] = []

        def emit() -> pa.RecordBatch:
            texts = [t for _, _, t in done]
            out = pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done], pa.string()), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])
            done.clear()
            return out

        for batch in batches:
            for block, kind, host, path, _, _, own, link, lines, hashes, zones in (row for at in range(0, batch.num_rows, 256) for row in zip(*(c.to_pylist() for c in batch.slice(at, 256).columns), strict=True)):
                new = (block, host, path, kind, lines, hashes, zones, own, link)
                if page is not None and page[3] == 1:
                    done.append((page[7], page[8], text_of(page, before, new)))
                    if len(done) >= 500:
                        yield emit()
                before, page = page, new
        if page is not None and page[3] == 1:
            done.append((page[7], page[8], text_of(page, before, None)))
        if done:
            yield emit()

    return routed.mapInArrow(differ, "page_id long, url string, text string, n_chars long")
