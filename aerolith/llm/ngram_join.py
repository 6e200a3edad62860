"""N-gram Jaccard join with signature trees: exact groups of near-duplicate documents.

Documents with equal sets of shingles are one representative.  Representatives that can reach the threshold share a
shingle among their first few in an order that puts rare shingles first, so they meet in the group of
that shingle.  A group that fits into a leaf is paired by size alone.  The members of a larger group first try a few
leaders; where that leaves it in several components, signature trees (nodes hold OR-combined bitmaps of their
members' shingles and size ranges) are traversed in pairs, and a pair of nodes goes on only if its largest possible overlap
reaches the threshold.  Leaves that meet are compared exactly where they lie, and only links that join two components
leave the task, so a group of any size sends fewer links than it has members.  :func:`set_links` gives all links instead.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.llm.common import checkpointed, sum_arrays, without_keys
from aerolith.llm.components import components
from aerolith.llm.hashing import mix, shingle_sets

K, PERCENT = 5, 80
#: Shingles are counted in so many buckets (a power of two) to tell rare ones from frequent ones.
ORDER_BITS = 22
#: Documents in a leaf, children of a node, leaders of a group, documents of a group that meet in one task and their shingles.
LEAF, FANOUT, LEADERS, BLOCK, BLOCK_SHINGLES = 32, 8, 4, 2048, 1 << 19
#: Rows of a shingle's group in one task while it is sorted; the groups of shingles that may have more go in lanes.
LANE = 1 << 14
_SALT = np.uint64(0x632BE59BD9B4E019)


def set_key(s: np.ndarray) -> int:
    """Hash of a set of shingle hashes, as a signed 64-bit number."""
    if not len(s):
        return 0
    total = int(mix(s ^ _SALT).sum(dtype=np.uint64)) * 0x9E3779B97F4A7C15 % 2**64 ^ len(s)
    return total - 2**64 if total >= 2**63 else total


def least_overlap(n: int, percent: int) -> int:
    """Shingles that a set of n must share with any set that it is linked with."""
    return (percent * n + 99) // 100


def fits(a, b, percent: int):
    """Whether sizes a and b allow a link."""
    return (100 * np.minimum(a, b) >= percent * np.maximum(a, b)) & (np.minimum(a, b) > 0)


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def described(texts: DataFrame, k: int) -> DataFrame:
    """Columns d, t (keys of the row), n, s (set key) for d, t, text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(len(s), set_key(s)) for s in shingle_sets(batch.column(2), k)]
            n, s = (np.array(c, np.int64) for c in zip(*found)) if found else (np.zeros(0, np.int64),) * 2
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n), pa.array(s)], ["d", "t", "n", "s"])

    return texts.mapInArrow(run, "d long, t long, n long, s long")


def count_codes(counts: np.ndarray) -> np.ndarray:
    """Counts in 16 bits, in the same order: exact below 2**15, then by their logarithm."""
    large = np.maximum(counts, 1 << 15)
    return np.where(counts < 1 << 15, counts, np.minimum((1 << 15) + 1024 * np.log2(large / (1 << 15)), 65535)).astype(np.uint16)


def lanes_of(codes: np.ndarray, lane: int = LANE) -> np.ndarray:
    """Lanes for the groups of shingles whose buckets have these counts; the count of a code is its upper end."""
    counts = np.where(codes < 1 << 15, codes, 2.0 ** ((codes.astype(float) + 1 - (1 << 15)) / 1024 + 15))
    return np.maximum(np.ceil(counts / lane), 1).astype(np.int64)


def bucket_counts(texts: DataFrame, k: int, bits: int) -> np.ndarray:
    """How many shingles of all documents fall into each bucket, as codes of :func:`count_codes`."""

    def partial(batches: Iterator[pd.DataFrame]) -> dict[str, np.ndarray]:
        counts = np.zeros(1 << bits, np.int32)
        for pdf in batches:
            for s in shingle_sets(pa.array(pdf["text"], pa.string(), from_pandas=True), k):
                np.add.at(counts, (s >> np.uint64(64 - bits)).astype(np.int64), 1)
        return {"n": counts}

    return count_codes(sum_arrays(texts.select("text"), partial).get("n", np.zeros(1 << bits, np.int64)))


def routes(texts: DataFrame, k: int, percent: int, bits: int) -> DataFrame:
    """Columns h (shingle), lane, s, n: the first shingles, rare ones first, of each representative; only shingles of two or more.

    The lane is -1 but for shingles that so many documents may hold that their group is dealt out among lanes.
    """
    counts = texts.sparkSession.sparkContext.broadcast(bucket_counts(texts, k, bits))  # of fixed size

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            hs, lanes, ss, ns = [], [], [], []
            for s in shingle_sets(batch.column(0), k):
                key, n = set_key(s), len(s)
                if not n or key in seen:
                    continue
                seen.add(key)  # copies in the same task go on once
                m = n - least_overlap(n, percent) + 1
                rank = counts.value[(s >> np.uint64(64 - bits)).astype(np.int64)]
                first = np.lexsort((s, rank))[:m]
                among = lanes_of(rank[first], LANE)
                hs.append(s[first])
                lanes.append(np.where(among > 1, (key & 0x7FFFFFFFFFFFFFFF) % among, -1).astype(np.int32))
                ss.append(np.full(m, key, np.int64))
                ns.append(np.full(m, n, np.int64))
            if hs:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(hs).view(np.int64)), pa.array(np.concatenate(lanes)), pa.array(np.concatenate(ss)), pa.array(np.concatenate(ns))], ["h", "lane", "s", "n"])

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Drop repeated rows and the rows that are alone with their shingle, from rows sorted by h, lane, s; one row is held back."""
        held, met = np.zeros((0, 4), np.int64), False  # the last row so far, and whether its group had one before it
        for batch in _with_end(batches):
            rows = held
            if batch is not None:
                rows = np.concatenate([held, np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns], 1)])
            if not len(rows):
                continue
            new = np.ones(len(rows), bool)
            new[1:] = (rows[1:, :3] != rows[:-1, :3]).any(1)
            rows = rows[new]
            same = (rows[1:, :2] == rows[:-1, :2]).all(1)
            keep = rows[:, 1] >= 0  # a lane's lone row has its group in other lanes
            keep[0] |= met
            keep[1:] |= same
            keep[:-1] |= same
            if batch is None:
                rows = rows[keep]
            else:
                held, met = rows[-1:], bool(keep[-1]) if len(rows) > 1 else met
                rows = rows[:-1][keep[:-1]]
            if len(rows):
                columns = [np.ascontiguousarray(rows[:, j]) for j in range(4)]
                columns[1] = columns[1].astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["h", "lane", "s", "n"])

    shape = "h long, lane int, s long, n long"
    rows = texts.select("text").mapInArrow(prefixes, shape)
    return rows.repartition("h", "lane").sortWithinPartitions("h", "lane", "s").mapInArrow(shared, shape)


def _with_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def first_pairs(groups: DataFrame, percent: int) -> DataFrame:
    """Columns a, b: pairs of groups that fit into a leaf, of the members of larger ones with their leaders, and of those members with themselves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[int, int]] = []
        own: list[tuple[int, int]] = []  # the group's first rows, as many as a leaf holds
        at, large = None, False

        def pair(heads: list[tuple[int, int]], others: list[tuple[int, int]]) -> None:
            for i, (s, n) in enumerate(heads):
                for t, m in others[i + 1 :] if others is own else others:
                    if 100 * min(n, m) >= percent * max(n, m):
                        found.append((s, t))

        def small() -> None:
            pair(own, own)
            if at is not None and at[1] >= 0:
                found.extend((s, s) for s, _ in own)

        def emit() -> pa.RecordBatch:
            out = np.unique(np.array(found, np.int64).reshape(-1, 2), axis=0)
            found.clear()
            return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(out[:, 0])), pa.array(np.ascontiguousarray(out[:, 1]))], ["a", "b"])

        for batch in batches:
            for h, lane, s, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (h, lane) != at:
                    if not large:
                        small()
                    own, at, large = [], (h, lane), False
                if len(own) < LEAF:
                    own.append((s, n))
                    continue
                if not large:  # rows come sorted by s, so groups of the same members share leaders
                    large = True
                    pair(own[:LEADERS], own)
                    found.extend((t, t) for t, _ in own)
                pair(own[:LEADERS], [(s, n)])
                found.append((s, s))
            if len(found) > 200_000:
                yield emit()
        if not large:
            small()
        if found:
            yield emit()

    return groups.mapInArrow(run, "a long, b long").distinct()


def stored(rows: DataFrame, place: DataFrame, k: int) -> DataFrame:
    """Columns s, size, bits (signature), z (compressed text) of the documents that `place` (s, x, y) names among `rows` (x, y, text).

    Texts are compressed before they are shuffled.  Repeated rows of a document come once.
    """

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        packer = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            z = [packer.compress((t.as_py() or "").encode()) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(z, pa.binary())], ["x", "y", "z"])

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [(len(s), signature(s, 1 << max(6, int(4 * len(s) - 1).bit_length())).tobytes()) for s in shingle_sets(texts_of(batch.column(1)), k)]
            size, bits = zip(*made, strict=True) if made else ((), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size, pa.int64()), pa.array(bits, pa.binary()), batch.column(1)], ["s", "size", "bits", "z"])

    packed = rows.select("x", "y", "text").mapInArrow(compress, "x long, y long, z binary")
    found = packed.join(place.hint("shuffle_hash"), ["x", "y"]).dropDuplicates(["x", "y"])
    return found.select("s", "z").mapInArrow(sign, "s long, size long, bits binary, z binary")


def texts_of(z: pa.Array) -> pa.Array:
    import zstandard

    unpacker = zstandard.ZstdDecompressor()
    return pa.array([unpacker.decompress(x.as_py()).decode() for x in z], pa.string())


def possible(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose signatures leave the threshold in reach."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, n, m = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("a", "b", "n", "m"))
            keep = np.zeros(len(a), bool)
            for i, (p, q) in enumerate(zip(batch.column("p"), batch.column("q"), strict=True)):
                x, y = (np.frombuffer(v.as_py(), np.uint8)[None, :] for v in (p, q))
                size = 8 * min(x.shape[1], y.shape[1])
                x, y = fold(x, size), fold(y, size)
                excess = min(int(n[i]) - int(np.bitwise_count(x).sum()), int(m[i]) - int(np.bitwise_count(y).sum()))
                keep[i] = reachable(min(int(np.bitwise_count(x & y).sum()) + excess, int(n[i]), int(m[i])), int(n[i]) + int(m[i]), percent)
            yield pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(b[keep])], ["a", "b"])

    one = pairs.join(sets.select(F.col("s").alias("a"), F.col("bits").alias("p"), F.col("size").alias("n")), "a")
    both = one.join(sets.select(F.col("s").alias("b"), F.col("bits").alias("q"), F.col("size").alias("m")), "b")
    return both.select("a", "b", "n", "m", "p", "q").mapInArrow(run, "a long, b long")


def reachable(overlap, sizes, percent: int):
    """Whether an overlap is enough for sets of these sizes together: overlap / union reaches the threshold."""
    return (100 + percent) * overlap >= percent * sizes


def true_links(pairs: DataFrame, sets: DataFrame, k: int, percent: int) -> DataFrame:
    """Columns u, v: the pairs (a, b) whose exact Jaccard likeness reaches the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, own = None, None
        for batch in batches:
            a, b = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("a", "b"))
            texts, keep = batch.column("x"), np.zeros(len(a), bool)
            for i, s in enumerate(shingle_sets(texts_of(batch.column("y")), k)):
                if a[i] != last:  # rows of one document follow each other
                    last, own = a[i], next(shingle_sets(texts_of(texts.slice(i, 1)), k))
                keep[i] = linked(own, s, percent)
            yield pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(b[keep])], ["u", "v"])

    right = pairs.join(sets.select(F.col("s").alias("b"), F.col("z").alias("y")), "b")
    both = right.join(sets.select(F.col("s").alias("a"), F.col("z").alias("x")), "a")
    return both.select("a", "b", "x", "y").mapInArrow(run, "u long, v long")


@dataclass
class Node:
    """A node of a signature tree: size range, OR of the bitmaps, most shingles that share a bit, its component or None."""

    low: int
    high: int
    bits: np.ndarray
    excess: int
    component: int | None
    children: list
    rows: np.ndarray | None
    held: tuple | None = None  # of a leaf: its shingles and who has them


def signature(s: np.ndarray, size: int) -> np.ndarray:
    """Bitmap of `size` bits (a power of two) of a set of hashes."""
    bits = np.zeros(size, bool)
    bits[(s & np.uint64(size - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little")


def fold(bits: np.ndarray, size: int) -> np.ndarray:
    """Bitmaps (rows of bytes) brought to fewer bits by OR."""
    while bits.shape[1] * 8 > size:
        half = bits.shape[1] // 2
        bits = bits[:, :half] | bits[:, half:]
    return bits


def grow(n: np.ndarray, bits: np.ndarray, component: np.ndarray) -> Node | None:
    """A tree over documents in order of component and size."""
    if not len(n):
        return None
    order = np.lexsort((n, component))
    excess = n - np.bitwise_count(bits).sum(1)
    level = []
    for at in range(0, len(n), LEAF):
        rows = order[at : at + LEAF]
        own = set(component[rows].tolist())
        level.append(Node(int(n[rows].min()), int(n[rows].max()), np.bitwise_or.reduce(bits[rows], 0), int(excess[rows].max()), own.pop() if len(own) == 1 else None, [], rows))
    while len(level) > 1:
        parts = [level[at : at + FANOUT] for at in range(0, len(level), FANOUT)]
        level = [
            Node(min(c.low for c in p), max(c.high for c in p), np.bitwise_or.reduce([c.bits for c in p], 0), max(c.excess for c in p), p[0].component if len({c.component for c in p}) == 1 else None, p, None) for p in parts
        ]
    return level[0]


def traverse(a: Node | None, b: Node | None, percent: int) -> Iterator[tuple[Node, Node]]:
    """Pairs of leaves that may hold a link between different components."""
    stack = [(a, b)] if a and b else []
    while stack:
        x, y = stack.pop()
        if x.component is not None and x.component == y.component:
            continue
        overlap = min(x.high, y.high, int(np.bitwise_count(x.bits & y.bits).sum()) + min(x.excess, y.excess))
        if not reachable(overlap, x.low + y.low, percent) or 100 * x.high < percent * y.low or 100 * y.high < percent * x.low:
            continue
        if x.rows is not None and y.rows is not None:
            yield x, y
        elif y.rows is None and (x.rows is not None or y.high - y.low >= x.high - x.low):
            stack += [(x, c) for c in y.children]
        else:
            stack += [(c, y) for c in x.children]


def overlaps(x: Node, xs: list[np.ndarray], y: Node, ys: list[np.ndarray]) -> np.ndarray:
    """Exact sizes of the intersections of the sets of two leaves."""
    for leaf, sets in ((x, xs), (y, ys)):
        if leaf.held is None:
            own = [sets[i] for i in leaf.rows]
            of, at = np.unique(np.concatenate(own), return_inverse=True)
            has = np.zeros((len(own), len(of)), np.float32)
            has[np.repeat(np.arange(len(own)), [len(s) for s in own]), at] = 1
            leaf.held = of, has
    _, i, j = np.intersect1d(x.held[0], y.held[0], assume_unique=True, return_indices=True)
    return (x.held[1][:, i] @ y.held[1][:, j].T).astype(np.int64)


def tree_links(asking: pd.DataFrame, held: pd.DataFrame, percent: int, every: bool = False) -> np.ndarray:
    """Links (asking, held) between the rows of two tables of s, component and set.

    Only those that join two components, as far as these are known by then: fewer than there are rows.  With `every`, all
    links of a smaller s to a larger one.
    """
    if not len(asking) or not len(held):
        return np.zeros((0, 2), np.int64)
    sizes = [f["set"].map(len).to_numpy(np.int64) for f in (asking, held)]
    bits = 1 << int(min(max(6, int(8 * np.median(np.concatenate(sizes))).bit_length()), 20))
    names, at = np.unique(np.concatenate([f["component"].to_numpy() for f in (asking, held)]), return_inverse=True)
    codes = at[: len(asking)], at[len(asking) :]
    trees = [grow(n, np.stack([signature(s, bits) for s in f["set"]]), np.arange(len(c)) if every else c) for f, n, c in zip((asking, held), sizes, codes, strict=True)]
    if every:
        for node in _nodes(trees):
            node.component = None
    root = np.arange(len(names))  # of each component, the one that it has joined

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = i = root[root[i]]
        return i

    (s, t), (a, b), out = (f["s"].to_numpy() for f in (asking, held)), (f["set"].tolist() for f in (asking, held)), []
    for x, y in traverse(*trees, percent):
        n, m = sizes[0][x.rows][:, None], sizes[1][y.rows][None, :]
        if every:
            ok = s[x.rows][:, None] < t[y.rows][None, :]
        else:
            ok = np.array([top(i) for i in codes[0][x.rows]])[:, None] != np.array([top(i) for i in codes[1][y.rows]])[None, :]
        ok &= fits(n, m, percent)
        if not ok.any():
            continue
        both = overlaps(x, a, y, b)
        for i, j in zip(*np.nonzero(ok & (100 * both >= percent * (n + m - both))), strict=True):
            u, v = int(x.rows[i]), int(y.rows[j])
            if not every:
                p, q = top(codes[0][u]), top(codes[1][v])
                if p == q:
                    continue
                root[p] = q
            out.append((s[u], t[v]))
    return np.array(out, np.int64).reshape(-1, 2)


def _nodes(trees: list[Node | None]) -> Iterator[Node]:
    stack = [t for t in trees if t]
    while stack:
        node = stack.pop()
        stack += node.children
        yield node


def later_links(groups: DataFrame, labels: DataFrame | None, sets: DataFrame, k: int, percent: int) -> DataFrame:
    """Links (u, v) that the signature trees find in large groups: those between components, or all if there are no `labels`.

    Members outside a group's largest component ask; all members are held.  Both are dealt out in blocks that meet
    pair by pair, so a group of any size is no single task.  Groups of the same members are taken once.
    """
    every = labels is None
    rows = groups.select("h", "lane", "s", "n")
    alike = rows.groupBy("h").agg(F.count("*").alias("members"), F.max("lane").alias("lane"), F.bit_xor(F.xxhash64("s")).alias("x"), F.bit_xor(F.xxhash64("s", F.lit(1))).alias("y"), F.sum("n").alias("all")).where((F.col("members") > LEAF) | (F.col("lane") >= 0))
    once = alike.groupBy("members", "x", "y").agg(F.min(F.struct("h", "all")).alias("g")).select("g.h", "members", "g.all")
    rows = rows.drop("lane").join(once, "h")
    if labels is None:
        rows = rows.withColumns({"component": F.col("s"), "largest": F.lit(None).cast("long"), "asking": F.col("members"), "asked": F.col("all")})
    else:
        rows = checkpointed(rows.join(labels, F.col("s") == F.col("node"), "left").select("h", "s", "n", "members", "all", F.coalesce("component", "s").alias("component")))
        parts = rows.groupBy("h", "component").agg(F.count("*").alias("c"), F.sum("n").alias("w")).groupBy("h").agg(F.max(F.struct("c", "component", "w")).alias("p"))
        parts = parts.select("h", F.col("p.component").alias("largest"), F.col("p.c").alias("most"), F.col("p.w").alias("weight"))
        rows = rows.join(parts, "h").where("most < members").withColumns({"asking": F.col("members") - F.col("most"), "asked": F.col("all") - F.col("weight")})
    pieces = lambda n, w: F.greatest(F.ceil(n / BLOCK), F.ceil(w / BLOCK_SHINGLES)).cast("int")
    blocks, asks = pieces(F.col("members"), F.col("all")), pieces(F.col("asking"), F.col("asked"))

    rows = rows.join(sets.select("s", "z"), "s")
    base = ["h", "s", "component", "z"]
    held = rows.select(*base, F.pmod(F.xxhash64("s"), blocks).cast("int").alias("block"), F.explode(F.sequence(F.lit(0), asks - 1)).alias("ask"), F.lit(False).alias("asks"))
    others = rows if labels is None else rows.where("component != largest")
    asking = others.select(*base, F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"), F.pmod(F.xxhash64("s", F.lit(1)), asks).cast("int").alias("ask"), F.lit(True).alias("asks"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf["set"] = list(shingle_sets(texts_of(pa.array(pdf["z"], pa.binary())), k))
        return pd.DataFrame(tree_links(pdf[pdf["asks"]], pdf[~pdf["asks"]], percent, every), columns=["u", "v"])

    return held.unionByName(asking).groupBy("h", "block", "ask").applyInPandas(run, "u long, v long")


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("d"), F.xxhash64(F.col(text_col)).alias("t"), F.col(text_col).cast("string").alias("text"))


def _met(rows: DataFrame, known: DataFrame, k: int, percent: int, order_bits: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Groups by shingle, the pairs to be compared first, and one stored document of each set that is to be compared."""
    groups = checkpointed(routes(rows.select("text"), k, percent, order_bits))
    pairs = checkpointed(first_pairs(groups, percent))
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("s")).distinct()
    keyed = F.coalesce("d", F.lit(-(2**63))).alias("x")
    # Copies of a set are reduced in every task before they shuffle.
    place = known.groupBy("s").agg(F.min(F.struct(keyed, F.col("t").alias("y"))).alias("p")).join(wanted, "s")
    sets = checkpointed(stored(rows.select(keyed, F.col("t").alias("y"), "text"), place.select("s", "p.x", "p.y"), k))
    return groups, pairs.where("a != b"), sets


def near_duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, percent: int = PERCENT, order_bits: int = ORDER_BITS) -> DataFrame:
    """Columns doc_id, n_shingles, component_id, t (hash of the text): one row per row of `docs`.

    Words are runs of non-blank characters with A-Z lowered; a set holds the distinct k-word shingles, or all words of a
    shorter text as one.  Two documents link when 100 * |intersection| >= percent * |union|; component_id is the
    smallest id that is reached by links.  Texts without words (null, empty, blank) have n_shingles 0 and are linked with
    nothing.  Repeated rows are rows of their own with equal sets; a null id is never the smallest unless all are null.
    Texts are read whole at any length: a task holds a span of texts and one text's set.  Ties cannot arise: a link depends
    on the two sets alone.  An empty table gives no rows; other columns are ignored.
    """
    rows = _texts(docs, id_col, text_col)
    known = checkpointed(described(rows, k))
    groups, pairs, sets = _met(rows, known, k, percent, order_bits)
    links = checkpointed(true_links(possible(pairs, sets, percent), sets, k, percent))
    links = links.unionByName(later_links(groups, components(links), sets, k, percent))
    labels = components(links)
    # The smallest id of each set, then of each component; copies are counted before they shuffle.
    ids = known.where("n > 0").groupBy("s").agg(F.min("d").alias("d"))
    ids = ids.join(labels, F.col("s") == F.col("node"), "left").select("s", "d", F.coalesce("component", "s").alias("component"))
    least = ids.groupBy("component").agg(F.min("d").alias("component_id"))
    named = ids.join(least, "component").select(F.col("s").alias("key"), "component_id")
    out = known.join(named, (F.col("s") == F.col("key")) & (F.col("n") > 0), "left")
    return out.select(F.col("d").alias("doc_id"), F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("d")).alias("component_id"), "t")


def set_links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, percent: int = PERCENT, order_bits: int = ORDER_BITS) -> tuple[DataFrame, DataFrame]:
    """All links between different sets, and who holds which set: tables (a, b), a < b, and (doc_id, n_shingles, set_id).

    Rules are those of :func:`near_duplicate_groups`; documents of equal sets have one set_id and are not paired
    with each other, and texts without words have a set_id that is linked with nothing.  The number of links can grow with the square
    of a group of near copies that differ, which is the answer's own size; :func:`near_duplicate_groups` does not have this growth.
    """
    rows = _texts(docs, id_col, text_col)
    known = checkpointed(described(rows, k))
    groups, pairs, sets = _met(rows, known, k, percent, order_bits)
    links = true_links(possible(pairs, sets, percent), sets, k, percent).unionByName(later_links(groups, None, sets, k, percent))
    links = links.select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")).distinct()
    return links, known.select(F.col("d").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("s").alias("set_id"))


def count_links(links: DataFrame, members: DataFrame) -> DataFrame:
    """Columns doc_id, n_shingles, set_id, n_links: with how many other documents each one is linked, by the tables of :func:`set_links`."""
    copies = members.where("n_shingles > 0").groupBy("set_id").agg(F.count("*").alias("copies"))
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = both.join(copies.withColumnRenamed("set_id", "b"), "b").groupBy(F.col("a").alias("set_id")).agg(F.sum("copies").alias("near"))
    sums = copies.join(near, "set_id", "left").select(F.col("set_id").alias("key"), (F.col("copies") - 1 + F.coalesce("near", F.lit(0))).alias("n_links"))
    out = members.join(sums, (F.col("set_id") == F.col("key")) & (F.col("n_shingles") > 0), "left")
    return out.select("doc_id", "n_shingles", "set_id", F.coalesce("n_links", F.lit(0)).alias("n_links"))


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of `docs`, all columns, that are the first of their group by id; repeated rows of it stay together.

    Groups are those of :func:`near_duplicate_groups`: texts without words, null texts and null ids that stand alone stay, a
    null id in a group with others goes, and texts of any length are compared whole.  An empty table stays empty; columns may
    have any names.
    """
    groups = near_duplicate_groups(docs, id_col, text_col, **options)
    gone = groups.where(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("d"), "t").distinct()
    return without_keys(docs, gone, id_col, text_col)
