"""Embedding near-dedup by Euclidean p-stable hashing, with exact cosine checks.

Equal vectors of one label are one class.  A class's normalised vector is projected on Gaussian directions; each table cuts `projections` of
them into steps of one width, and the steps name a bucket.  Unit vectors of cosine c lie sqrt(2 - 2c) apart, so near ones share
their steps and far ones seldom do.  Only buckets of several classes go on, with vectors: small ones whole, large ones in pairs of blocks,
so a bucket of any size is spread over tasks.  Tasks compare by exact cosine in double precision.  A pair counts in the first
of the tables where it meets, so each link counts once; what leaves a task are links counted by class and the links that join
components, never all pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolith.llm.common import checkpointed, written
from aerolith.llm.components import components

COSINE = 0.98
#: A pair at the threshold (distance 0.2) meets in a table with chance 0.920 ** 10 = 0.44, and in none of 18 with 0.00004; vectors
#: at right angles meet in a table with chance 0.486 ** 10 = 0.0007.  Projections should grow with the logarithm of a label's rows, and
#: want more tables then: see :func:`miss_chance`.
PROJECTIONS, TABLES, WIDTH = 10, 18, 2.0
#: Classes of a bucket that meet in one task at once.
BLOCK = 512
#: Lanes that rows of one key are dealt out to before anything is known of the key.
LANES = 32
SEED = 20240613


def step_chance(distance: float, width: float) -> float:
    """Chance that two points so far apart share the step of one Gaussian projection."""
    if distance == 0:
        return 1.0
    t = width / distance
    return 1 - math.erfc(t / math.sqrt(2)) - 2 / (math.sqrt(2 * math.pi) * t) * (1 - math.exp(-t * t / 2))


def miss_chance(cosine: float, projections: int = PROJECTIONS, tables: int = TABLES, width: float = WIDTH) -> float:
    """Chance that a pair of this cosine meets in no table."""
    return (1 - step_chance(math.sqrt(max(0.0, 2 - 2 * cosine)), width) ** projections) ** tables


def usable(vector: Column) -> Column:
    """Whether a vector has components, all finite and not all zero."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(vector.isNotNull() & F.forall(vector, finite) & F.exists(vector, lambda x: x != 0), F.lit(False))


def lane_of(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(LANES)).cast("int")


def spread(lanes: DataFrame, keys: list[str], **totals: Column) -> DataFrame:
    """A total by `keys` of rows that were summed by keys and lane, for each lane that has rows: a join on keys and lane has no hot key."""
    per = lanes.groupBy(*keys).agg(*(x.alias(k) for k, x in totals.items()), F.collect_set("lane").alias("lanes"))
    return per.select(*keys, *totals, F.explode("lanes").alias("lane"))


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as rows, in double precision."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled first, so that no square overflows or vanishes."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def bucket_keys(x: np.ndarray, projections: int, tables: int, width: float) -> np.ndarray:
    """One number a table for each row of `x` (unit vectors): a mixture of its steps."""
    rng = np.random.default_rng([SEED, x.shape[1]])
    directions = rng.standard_normal((x.shape[1], tables * projections))
    shifts = rng.uniform(0, width, tables * projections)
    steps = np.floor((x @ directions + shifts) / width).astype(np.int64).reshape(len(x), tables, projections)
    odd = rng.integers(1, 2**62, projections) * 2 + 1
    return (steps * odd).sum(axis=2)


def _hashed(classes: DataFrame, projections: int, tables: int, width: float) -> DataFrame:
    """`classes` (c, m, label, v) with keys: the bucket of each table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = np.diff(batch.column("v").offsets.to_numpy())
            for n in np.unique(lengths):
                part = batch.take(pa.array(np.flatnonzero(lengths == n)))
                keys = bucket_keys(unit(_matrix(part.column("v"))), projections, tables, width)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(keys) + 1, dtype=np.int32) * tables, pa.int32()), pa.array(keys.ravel()))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), lists], [*names, "keys"])

    names = ["c", "m", "label", "v"]
    shape = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in classes.select(names).schema)
    return classes.select(names).mapInArrow(run, f"{shape}, keys array<long>")


def _units(hashed: DataFrame, block: int) -> DataFrame:
    """The rows of each bucket of two classes or more, dealt out in units: (label, dim, t, key, i, j) names two blocks of a bucket.

    Counts are made by lane of the class, so that no bucket's rows meet in one task to learn the bucket's size.
    """
    slim = hashed.select("c", "label", F.size("v").alias("dim"), lane_of("c").alias("lane"), F.posexplode("keys").alias("t", "key"))
    bucket = ["label", "dim", "t", "key"]
    lanes = slim.groupBy(*bucket, "lane").agg(F.count("*").alias("n"))
    large = spread(lanes, bucket, size=F.sum("n")).where("size > 1")
    blocks = F.ceil(F.col("size") / block).cast("int")
    met = slim.join(large, [*bucket, "lane"]).select("c", *bucket, blocks.alias("blocks"), F.pmod(F.xxhash64("c", F.lit(1)), blocks).cast("int").alias("own"))
    # Vectors join their rows by class, of which each has at most one row a table.
    met = met.join(hashed.select("c", "m", "v", "keys"), "c")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    met = met.select("c", "m", *bucket, "v", "keys", "own", other.alias("other"))
    return met.select("c", "m", *bucket, "v", "keys", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))


def _forest(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Places of the links that join components that those before do not."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent.setdefault(up, up)
        return x

    keep = []
    for place, (x, y) in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
        x, y = root(x), root(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
            keep.append(place)
    return np.array(keep, int)


def compare(x: np.ndarray, keys: np.ndarray, first: np.ndarray | None, t: int, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Links (places of both ends) among rows that share the bucket of table `t`, and not that of an earlier table.

    Rows of one block are compared among themselves; where `first` marks those of the first of two blocks, with the others alone.
    """
    u = unit(x)
    left, right = (np.arange(len(x)),) * 2 if first is None else (np.flatnonzero(first), np.flatnonzero(~first))
    near = u[left] @ u[right].T >= cosine
    if first is None:
        near = np.triu(near, 1)
    a, b = np.nonzero(near)
    a, b = left[a], right[b]
    new = ~(keys[a, :t] == keys[b, :t]).any(axis=1)
    return a[new], b[new]


def _links(units: DataFrame, cosine: float) -> DataFrame:
    """Columns c, n (rows linked with the rows of class c, in one unit) and o (a class linked with c, where that joins components there, else null)."""
    name = ["label", "dim", "t", "key", "i", "j"]

    def settled(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        """Links of one unit."""
        whole = pa.Table.from_batches(rows)
        column = lambda k: whole.column(k).combine_chunks()
        c, m, own, i, j = (column(k).to_numpy() for k in ("c", "m", "own", "i", "j"))
        keys = column("keys").flatten().to_numpy().reshape(len(c), -1)
        a, b = compare(_matrix(column("v")), keys, None if i[0] == j[0] else own == i[0], column("t")[0].as_py(), cosine)
        counts = (np.bincount(a, m[b], len(c)) + np.bincount(b, m[a], len(c))).astype(np.int64)
        keep, linked = _forest(a, b), np.flatnonzero(counts)
        others = np.concatenate([np.zeros(len(linked), np.int64), c[b[keep]]])
        out = [pa.array(np.concatenate([c[linked], c[a[keep]]])), pa.array(np.concatenate([counts[linked], np.zeros(len(keep), np.int64)])), pa.array(others, mask=np.arange(len(others)) < len(linked))]
        return pa.RecordBatch.from_arrays(out, ["c", "n", "o"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # the rows of the last unit so far: two blocks at most
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            codes = [batch.column(k).to_numpy(zero_copy_only=False) for k in name]
            new = np.zeros(batch.num_rows, bool)
            for k in codes:
                new[1:] |= k[1:] != k[:-1]
            cuts = [0, *np.flatnonzero(new).tolist(), batch.num_rows]
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                unit_name = tuple(k[lo] for k in codes)
                if held and unit_name != last:
                    yield settled(held)
                    held = []
                held.append(batch.slice(lo, hi - lo))
                last = unit_name
        if held:
            yield settled(held)

    return units.repartition(*name).sortWithinPartitions(*name).mapInArrow(run, "c long, n long, o long")


def near_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", cosine: float = COSINE, projections: int = PROJECTIONS, tables: int = TABLES, width: float = WIDTH, block: int = BLOCK) -> DataFrame:
    """Columns vec_id, n_links, component_id, kept: one row per row of `rows`.

    Vectors of equal labels and lengths are linked from `cosine` on.  n_links counts the other rows that a row is linked with directly, copies
    among them; component_id is the smallest id reachable; kept marks the row that has it.  Vectors that are null, empty, zero or hold null or
    non-finite components, and those of a null label, are linked with nothing.  Repeated rows are rows like any other, linked with each other, and all rows of the
    smallest id are kept; a null id is never the smallest but where there is no other.  Pairs are missed with :func:`miss_chance`.
    Vectors may have any length, also different ones.  An empty table gives no rows; other columns of any names are ignored.
    """
    name = lambda c: F.col(f"`{c}`")
    slim = rows.select(name(id_col).cast("long").alias("id"), name(label_col).cast("string").alias("label"), name(vector_col).alias("v"))
    slim = slim.withColumn("lane", lane_of("id"))
    good = F.col("label").isNotNull() & usable(F.col("v"))
    # Copies are counted by lane first, and each lane of a class asks for its answer, so a vector that many rows share is no hot key.
    parts = slim.where(good).groupBy("label", "v", "lane").agg(F.count("*").alias("m"), F.min("id").alias("least"))
    classes = parts.groupBy("label", "v").agg(F.sum("m").alias("m"), F.min("least").alias("least"), F.collect_set("lane").alias("lanes"))
    classes = written(classes.withColumn("c", F.monotonically_increasing_id()))
    hashed = written(_hashed(classes, projections, tables, width))
    found = checkpointed(_links(_units(hashed, block), cosine))

    groups = components(found.where(F.col("o").isNotNull()).select(F.col("c").alias("u"), F.col("o").alias("v")))
    nodes = classes.select("c", "least", "m", lane_of("c").alias("lane")).join(groups.withColumnRenamed("node", "c"), "c", "left")
    nodes = nodes.join(found.groupBy("c").agg(F.sum("n").alias("n")), "c", "left").withColumn("component", F.coalesce("component", "c"))
    smallest = spread(nodes.groupBy("component", "lane").agg(F.min("least").alias("least")), ["component"], component_id=F.min("least"))
    nodes = nodes.join(smallest, ["component", "lane"]).select("c", "component_id", (F.coalesce("n", F.lit(0)) + F.col("m") - 1).alias("n_links"))
    answers = classes.join(nodes, "c").select("label", "v", "n_links", "component_id", F.explode("lanes").alias("lane"))
    linked = slim.where(good).join(answers, ["label", "v", "lane"])
    alone = slim.where(~good).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    out = linked.select("id", "n_links", "component_id").unionByName(alone)
    return out.select(F.col("id").alias("vec_id"), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
