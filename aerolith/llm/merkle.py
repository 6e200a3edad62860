"""Merkle dataset manifest: a tree of digests over a table, built level by level with DataFrames.

Rows are put in one global order, and every row takes its number within its source from a running count in its partition and what
the partitions before hold of the same source; so no source is one window, however large it is.  A level groups the numbers by
`number // fanout` into arrays of at most `fanout` sorted children and hashes them into parents, a source at a
time, until one node is left: its subroot.  The subroots, ordered by source, are the leaves of one more such
tree, which ends in the root.  From the root down each level is joined with the level above, which appends the siblings; a
row's proof is so at most `fanout - 1` digests a level.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolith.llm.common import checkpointed, written

FANOUT = 16
#: Siblings of a node within its run, as one text each side of it.
SIDES = "array<struct<left:string,right:string>>"


def field(value: Column) -> Column:
    """`-` for null, else the UTF-8 bytes of the value as text, `:`, and that text."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(*values: Column) -> Column:
    return F.sha2(F.concat(*map(field, values)), 256)


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, all else kept; plain lower() where the text is ASCII."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """`rows` with i: the number from 0 within `group` (never null), in the order of `group` and `order`, without a window by group.

    The driver learns of each partition its first and last group and the rows of the last.
    """
    keys = [group, *order]
    ordered = checkpointed(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("part", F.spark_partition_id()))
    counts = ordered.groupBy("part", F.col(group).alias("g")).agg(F.count("*").alias("n")).select("part", F.struct("g", "n").alias("run"))
    ends = counts.groupBy("part").agg(F.min("run").alias("lo"), F.max("run").alias("hi")).collect()
    before: dict[int, int] = {}  # rows of the partition's first group in the partitions before
    last, carried = None, 0
    for r in sorted(ends, key=lambda r: r["part"]):
        before[r["part"]] = carried if r["lo"]["g"] == last else 0
        carried = r["hi"]["n"] + (before[r["part"]] if r["lo"]["g"] == r["hi"]["g"] else 0)
        last = r["hi"]["g"]
    names = [*rows.columns, "i"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at = None, 0  # the group of the last row, and the number of the next row if it goes on
        for batch in batches:
            if not batch.num_rows:
                continue
            groups = batch.column(group)
            codes = groups.dictionary_encode().indices.to_numpy(zero_copy_only=False)
            starts = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
            runs = np.diff(np.append(starts, len(codes)))
            number = np.arange(len(codes)) - np.repeat(starts, runs)
            if held is None:
                at = before[batch.column("part")[0].as_py()]
            elif held != groups[0].as_py():
                at = 0
            number[: runs[0]] += at
            held, at = groups[len(codes) - 1].as_py(), int(number[-1]) + 1
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names[:-1]), pa.array(number)], names)

    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return ordered.mapInArrow(count, f"{shape}, i long")


def _joined(digests: Column) -> Column:
    return F.array_join(F.transform(digests, lambda x: x["h"]), "")


def _lone() -> Column:
    """Whether a group holds the last node of its tree: number 0, and no other beside it."""
    return (F.col("i") == 0) & (F.size("kids") == 1)


def levels_of(nodes: DataFrame, fanout: int) -> tuple[list[DataFrame], DataFrame]:
    """The levels of the trees of `nodes` (g, i, h and more), leaves first, and their tops (g, h, level).

    Level k holds the groups (g, i, kids) of the nodes of that level: i is the parent's number, kids are sorted.
    """
    levels: list[DataFrame] = []
    tops = None
    while True:
        kid = F.struct("i", *(c for c in nodes.columns if c not in ("g", "i")))
        level = written(nodes.groupBy("g", F.floor(F.col("i") / fanout).cast("long").alias("i")).agg(F.sort_array(F.collect_list(kid)).alias("kids")))
        top = level.where(_lone()).select("g", F.col("kids")[0]["h"].alias("h"), F.lit(len(levels)).alias("level"))
        tops = top if tops is None else tops.unionByName(top)
        levels.append(level)
        nodes = level.where(~_lone()).select("g", "i", F.sha2(_joined(F.col("kids")), 256).alias("h"))
        if nodes.isEmpty():
            return levels, written(tops)


def _opened(groups: DataFrame) -> DataFrame:
    """The children of `groups` (g, kids, path, top), each with its own path."""
    kids, at = F.col("kids"), F.col("at")
    siblings = F.struct(_joined(F.slice(kids, F.lit(1), at)).alias("left"), _joined(F.slice(kids, at + 2, F.size(kids))).alias("right"))
    path = F.when(F.col("lone"), F.col("path")).otherwise(F.concat(F.array(siblings), F.col("path")))
    return groups.select("g", "kids", "path", "top", "lone", F.posexplode("kids").alias("at", "kid")).select("g", "kid", path.alias("path"), "top")


def with_paths(levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """Columns g, kid (a leaf), path, top for all leaves, given `tops` (g, level, path, top): each level joined with the one above it."""
    out = None
    for k in reversed(range(len(levels))):
        # A lone node is the top of its tree; the parent of any other group is a node of the level above.
        above = tops.where(F.col("level") == k).select("g", F.lit(0).cast("long").alias("i"), "path", "top", F.lit(True).alias("lone"))
        if out is not None:
            above = above.unionByName(written(out.select("g", F.col("kid.i").alias("i"), "path", "top", F.lit(False).alias("lone"))))
        out = _opened(levels[k].select("*", _lone().alias("lone")).join(above, ["g", "i", "lone"]))
    return out


def proof_digest(path: Column) -> Column:
    """Digest of all siblings of a path, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf's digest and its path give."""
    return F.aggregate(path, leaf, lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]), 256))


def merkle_manifest(rows: DataFrame, id_col: str = "doc_id", group_col: str = "source", value_cols: Sequence[str] = ("lang", "n_chars", "text"), fanout: int = FANOUT, carry: dict[str, Column] | None = None) -> DataFrame:
    """Columns doc_id, leaf, subroot, root, path: one row per row of `rows`; `carry` names further slim columns that ride along.

    A leaf is the digest of id, group and values.  Leaves stand in the order of their id (a null one first), then of the digest, so repeated rows are
    neighbours with equal digests, each a leaf of its own.  A null group is a group, unlike that of the empty
    text, and stands first.  Null values count as `-`, empty texts as `0:`; texts are read whole at any length and never shuffled.  A table of one row has
    its leaf as root and an empty path; an empty table gives no rows.  Other columns of any names are ignored.
    """
    carry = carry or {}
    name = lambda c: F.col(f"`{c}`")
    leaf = leaf_digest(name(id_col), name(group_col), *map(name, value_cols))
    # 'g' and a letter before each group's name, so that null sorts before the empty text and joins as a value.
    group = F.when(name(group_col).isNull(), F.lit("")).otherwise(F.concat(F.lit("g"), name(group_col).cast("string")))
    slim = checkpointed(rows.select(group.alias("g"), name(id_col).cast("long").alias("doc_id"), leaf.alias("h"), F.struct(F.lit(0).alias("_"), *(c.alias(k) for k, c in carry.items())).alias("more")))
    levels, tops = levels_of(numbered(slim, "g", ["doc_id", "h"]), fanout)
    # The tops in the order of their groups are the leaves of one more tree.
    crowns, root = levels_of(numbered(tops.select(F.lit("").alias("g"), F.col("g").alias("of"), "h", "level"), "g", ["of"]), fanout)
    ends = written(with_paths(crowns, root.select("g", "level", F.array().cast(SIDES).alias("path"), F.col("h").alias("top"))))
    subroots = ends.select(F.col("kid.of").alias("g"), F.col("kid.level").alias("level"), "path", F.struct(F.col("kid.h").alias("subroot"), F.col("top").alias("root")).alias("top"))
    leaves = with_paths(levels, subroots)
    return leaves.select("kid.doc_id", F.col("kid.h").alias("leaf"), "top.subroot", "top.root", "path", *(F.col(f"kid.more.`{k}`").alias(k) for k in carry))


def verified_manifest(docs: DataFrame, id_col: str = "doc_id", group_col: str = "source", text_col: str = "text", value_cols: Sequence[str] = ("lang", "n_chars"), every: int = 5) -> DataFrame:
    """Columns doc_id, leaf, subroot, root, proof_sha256, folded_root, verified: the manifest, held against a table in which some texts were changed.

    Where `every` divides the crc32 of the id's decimals, the changed text is lower-cased (A-Z); a null text and a row without an id stay.
    The root is computed anew from the changed leaf and the siblings of the manifest.  Odd rows are those of :func:`merkle_manifest`.
    """
    name = lambda c: F.col(f"`{c}`")
    lowered = leaf_digest(name(id_col), name(group_col), *map(name, value_cols), lower_ascii(name(text_col)))
    changed = F.when(F.crc32(name(id_col).cast("string").cast("binary")) % every == 0, lowered)
    out = merkle_manifest(docs, id_col, group_col, (*value_cols, text_col), carry={"changed": changed})
    again = folded(F.coalesce("changed", "leaf"), F.col("path"))
    out = out.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), again.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
