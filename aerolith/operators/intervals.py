"""Interval joins: ranges cut at measured starts, and a sweep in each.

Two closed intervals meet where the later start lies in the other interval.  So each side is seen twice: as points, its starts, which are dealt out by
ranges that hold equally many of them, and as intervals, which are lent to every range that they touch.  In a range the points are sorted, and an
interval meets the points from its start to its end, a slice found by bisection: work goes with the pairs that there are, whatever the lengths of
the intervals.  A start that many rows share has a range of its own.  The rows of each range are counted, those that are lent to it among them, and where a side has more than its share its
rows are dealt out in lanes, each of which meets all rows of the other side; so neither a hot month nor a hot moment is a hot task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, DoubleType, FloatType, IntegerType, LongType, StructField, StructType, TimestampNTZType, TimestampType

from aerolith.shared import staged

#: Rows of output in a batch.
CHUNK = 1 << 15


def position(column: Column, kind) -> Column:
    """A place on the number line, in the order of the column: days, microseconds, or the number itself."""
    if isinstance(kind, DateType):
        return F.unix_date(column).cast("long")
    if isinstance(kind, TimestampType):
        return F.unix_micros(column)
    if isinstance(kind, TimestampNTZType):  # free of the session's zone
        clock = F.hour(column) * 3600 + F.minute(column) * 60
        return (F.unix_date(column.cast("date")).cast("long") * 86_400 + clock) * 1_000_000 + (F.extract(F.lit("SECOND"), column) * 1_000_000).cast("long")
    return column.cast("double" if isinstance(kind, (FloatType, DoubleType)) else "long")


def _sides(a: DataFrame, b: DataFrame, start: str, end: str, other_start: str, other_end: str) -> DataFrame:
    """Both sides in one shape: lo, hi, l (row of `a`), r (row of `b`).  Intervals without an end or with the end before the start meet nothing."""

    def shaped(df: DataFrame, lo: str, hi: str, own: str) -> DataFrame:
        kinds = {f.name: f.dataType for f in df.schema}
        rows = df.select(position(F.col(f"`{lo}`"), kinds[lo]).alias("lo"), position(F.col(f"`{hi}`"), kinds[hi]).alias("hi"), F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias(own))
        return rows.where("lo <= hi")

    return shaped(a, start, end, "l").unionByName(shaped(b, other_start, other_end, "r"), allowMissingColumns=True)


def cut_points(sides: DataFrame, ranges: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts at equal shares of each side's rows, in order; a start of several shares comes as often.  Two arrays of `ranges` numbers reach the driver."""
    shares = [i / ranges for i in range(1, ranges)]
    if not shares:
        return np.zeros(0), np.zeros(0)
    one = lambda side: F.percentile_approx(F.when(F.col(side).isNotNull(), F.col("lo")), shares, 50 * ranges).alias(side)
    found = sides.agg(one("l"), one("r")).first()
    kind = float if dict(sides.dtypes)["lo"] == "double" else np.int64
    return np.sort(np.array(found["l"] or [], kind)), np.sort(np.array(found["r"] or [], kind))


class Deal:
    """Ranges between the cuts of both sides, and the lanes of each side's rows in them.

    Range 2 s + 1 holds the starts from the s-th bound up to the next one; the starts equal to a bound of several cuts of one side have the range 2 s of their own.
    """

    def __init__(self, left: np.ndarray, right: np.ndarray):
        self.bounds = np.unique(np.concatenate([left, right]))
        many = [np.searchsorted(x, self.bounds, "right") - np.searchsorted(x, self.bounds, "left") for x in (left, right)]
        self.hot = np.maximum(*many) > 1
        self.parts = 2 * len(self.bounds) + 2
        self.lanes = np.ones((2, self.parts), np.int64)

    def part_of(self, x: np.ndarray) -> np.ndarray:
        s = np.searchsorted(self.bounds, x, "right")
        own = (s > 0) & (self._at(self.bounds, s, 0) == x) & self._at(self.hot, s, False)
        return 2 * s + 1 - own

    def _at(self, values: np.ndarray, s: np.ndarray, default) -> np.ndarray:
        """The values of the bounds number s, counted from 1."""
        return values[np.maximum(s, 1) - 1] if len(values) else np.full(len(s), default)

    def exists(self, part: np.ndarray) -> np.ndarray:
        return (part % 2 == 1) | ((part > 0) & self._at(self.hot, part // 2, False))

    def measure(self, sides: DataFrame, ranges: int) -> Deal:
        """Count the rows of each side in each range, those that are lent to it among them, and give each side a lane for every equal share of all rows."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            change = np.zeros((2, self.parts + 1), np.int64)  # rows that come in at a range, less those that ended before it
            for batch in batches:
                lo, hi = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("lo", "hi"))
                left = batch.column("left").to_numpy(zero_copy_only=False)
                for side, rows in enumerate((left, ~left)):
                    change[side] += np.bincount(self.part_of(lo[rows]), minlength=self.parts + 1) - np.bincount(self.part_of(hi[rows]) + 1, minlength=self.parts + 1)
            side, part = np.nonzero(change)
            yield pa.RecordBatch.from_arrays([pa.array(side), pa.array(part), pa.array(change[side, part])], ["side", "part", "n"])

        slim = sides.select("lo", "hi", F.col("l").isNotNull().alias("left"))
        change = np.zeros((2, self.parts + 1), np.int64)
        for r in slim.mapInArrow(run, "side long, part long, n long").groupBy("side", "part").agg(F.sum("n").alias("n")).collect():  # two numbers a range
            change[r["side"], r["part"]] = r["n"]
        held = np.cumsum(change, axis=1)[:, : self.parts]
        share = max(1, 2 * int(np.maximum(change, 0).sum()) // ranges)
        self.lanes = np.maximum(-(-held // share), 1)
        return self

    def lanes_of(self, part: np.ndarray, side: int) -> np.ndarray:
        return self.lanes[side][part]


def _spans(n: np.ndarray) -> np.ndarray:
    """0 .. n - 1 for each n, one after the other."""
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


def _dealt(sides: DataFrame, deal: Deal) -> DataFrame:
    """`sides` with part, la, lb and point: a row goes to all ranges that it touches, in one lane of its own side and all lanes of the other; it is a point in the first."""
    kinds = [StructField("part", IntegerType()), StructField("la", IntegerType()), StructField("lb", IntegerType()), StructField("point", BooleanType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            lo, hi = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("lo", "hi"))
            left = batch.column("l").is_valid().to_numpy(zero_copy_only=False)
            first = deal.part_of(lo)
            n = deal.part_of(hi) - first + 1
            row = np.repeat(np.arange(len(lo)), n)
            part = _spans(n) + first[row]
            row, part = row[there := deal.exists(part)], part[there]
            many = [deal.lanes_of(part, side) for side in (0, 1)]
            own, other = np.where(left[row], *many), np.where(left[row], *many[::-1])
            lane = (seen + row) % own
            row, part, lane, turn = np.repeat(row, other), np.repeat(part, other), np.repeat(lane, other), _spans(other)
            la, lb = np.where(left[row], lane, turn), np.where(left[row], turn, lane)
            seen += len(lo)
            for i in range(0, len(row), CHUNK):
                cut = slice(i, i + CHUNK)
                taken = batch.take(pa.array(row[cut]))
                extra = [*(pa.array(x[cut], pa.int32()) for x in (part, la, lb)), pa.array(part[cut] == first[row[cut]])]
                yield pa.RecordBatch.from_arrays([*extra, *taken.columns], [*(k.name for k in kinds), *taken.schema.names])

    return sides.mapInArrow(run, StructType([*kinds, *sides.schema.fields]))


def slices(starts: np.ndarray, lo: np.ndarray, hi: np.ndarray, after: bool) -> tuple[np.ndarray, np.ndarray]:
    """For each interval the slice of sorted starts from its own start (or `after` it) to its end."""
    return np.searchsorted(starts, lo, "right" if after else "left"), np.searchsorted(starts, hi, "right")


def _swept(dealt: DataFrame) -> DataFrame:
    """Columns l and r of all pairs that meet.  A task holds the points and intervals of one range at once, and gives pairs in chunks."""

    def pairs(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        rows = rows.combine_chunks()
        lo, hi, point = (rows.column(c).to_numpy() for c in ("lo", "hi", "point"))
        left, right = (rows.column(c).combine_chunks() for c in ("l", "r"))
        is_left = left.is_valid().to_numpy(zero_copy_only=False)
        # Pairs of equal starts count once: with the left interval and the right point.
        for intervals, points, after in ((is_left, ~is_left & point, False), (~is_left, is_left & point, True)):
            held, targets = np.flatnonzero(intervals), np.flatnonzero(points)
            targets = targets[np.argsort(lo[targets], kind="stable")]
            first, stop = slices(lo[targets], lo[held], hi[held], after)
            n = stop - first
            ends = np.cumsum(n)
            total = int(ends[-1]) if len(ends) else 0
            for at in range(0, total, CHUNK):
                number = np.arange(at, min(at + CHUNK, total))
                i = np.searchsorted(ends, number, "right")
                j = targets[first[i] + number - (ends[i] - n[i])]
                i = held[i]
                a, b = (i, j) if not after else (j, i)
                yield pa.RecordBatch.from_arrays([left.take(pa.array(a)), right.take(pa.array(b))], ["l", "r"])

    name = ["part", "la", "lb"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy() for c in name], 1)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if held and tuple(keys[a]) != last:
                    yield from pairs(pa.Table.from_batches(held))
                    held = []
                held.append(batch.slice(a, b - a))
                last = tuple(keys[a])
        if held:
            yield from pairs(pa.Table.from_batches(held))

    fields = {f.name: f for f in dealt.schema.fields}
    return dealt.repartition(*name).sortWithinPartitions(*name).mapInArrow(run, StructType([fields["l"], fields["r"]]))


def overlap_join(a: DataFrame, b: DataFrame, start: str, end: str, other_start: str, other_end: str, ranges: int | None = None) -> DataFrame:
    """All columns of both sides for each pair of rows whose closed intervals meet, each pair once.

    Starts and ends are dates, times or numbers, and both sides' of like kind.  A null start or end, or an end before its start meets nothing; a moment (equal start and end)
    is an interval; repeated rows are rows like any other.  `ranges` defaults to four for each shuffle partition.  A row is shuffled once for each range that it
    touches and each lane that the other side has there.
    """
    sides = _sides(a, b, start, end, other_start, other_end)
    many = ranges or 4 * int(a.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = _swept(_dealt(sides, Deal(*cut_points(sides, many)).measure(sides, many)))
    return met.select(*(F.col(f"l.`{c}`").alias(c) for c in a.columns), *(F.col(f"r.`{c}`").alias(c) for c in b.columns))


def overlap_counts(a: DataFrame, b: DataFrame, start: str, end: str, other_start: str, other_end: str, out: str = "n", ranges: int | None = None) -> DataFrame:
    """`a` with the column `out`: how many rows of `b` its closed interval meets, by the rules of `overlap_join`, 0 if none.

    No pair is made.  An interval meets all that start up to its end, but for those that end before its start: two numbers that grow along the line.  The different
    places of both sides, with the starts and ends of `b` at each, are dealt out in `ranges` of the line and added up in order; the driver learns the bounds and two sums a range.
    """
    kinds = {f.name: f.dataType for f in a.schema}
    lo, hi = (position(F.col(f"`{c}`"), kinds[c]) for c in (start, end))
    rows = a.select(F.struct(*(F.col(f"`{c}`") for c in a.columns)).alias("l"), lo.alias("lo"), hi.alias("hi"))
    kinds = {f.name: f.dataType for f in b.schema}
    other = b.select(position(F.col(f"`{other_start}`"), kinds[other_start]).alias("lo"), position(F.col(f"`{other_end}`"), kinds[other_end]).alias("hi")).where("lo <= hi")
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    ends = lambda df, s, e: df.select(F.inline(F.array(F.struct(F.col("lo").alias("x"), s.alias("starts"), zero.alias("ends")), F.struct(F.col("hi").alias("x"), zero.alias("starts"), e.alias("ends")))))
    marks = ends(rows.where("lo <= hi"), zero, zero).unionByName(ends(other, one, one)).groupBy("x").agg(F.sum("starts").alias("starts"), F.sum("ends").alias("ends"))
    marks = staged(marks, "marks")

    many = ranges or 4 * int(a.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / many for i in range(1, many)]
    found = marks.agg(F.percentile_approx("x", shares, 50 * many)).first()[0] if shares else None
    bounds = np.unique(np.array(found or [], float if dict(marks.dtypes)["x"] == "double" else np.int64))

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number = np.searchsorted(bounds, batch.column("x").to_numpy(zero_copy_only=False), "right")
            yield pa.RecordBatch.from_arrays([pa.array(number, pa.int32()), *batch.columns], ["part", *batch.schema.names])

    dealt = marks.mapInArrow(part, StructType([StructField("part", IntegerType()), *marks.schema.fields]))
    before = np.zeros((len(bounds) + 2, 2), np.int64)  # starts and ends in the ranges before each
    for r in dealt.groupBy("part").agg(F.sum("starts").alias("s"), F.sum("ends").alias("e")).collect():  # two numbers a range
        before[r["part"] + 1] = r["s"], r["e"]
    before = np.cumsum(before, axis=0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = -1, np.zeros(2, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            number = batch.column("part").to_numpy()
            counts = np.stack([batch.column(c).to_numpy() for c in ("starts", "ends")], 1)
            sums = np.cumsum(counts, axis=0)
            first = np.flatnonzero(np.r_[number[0] != last, number[1:] != number[:-1]])
            # What comes before each row's range, or before the batch in the first one's, less the batch's sums up to there.
            base = np.repeat(held[None], len(number), 0)
            for at, stop in zip(first, [*first[1:], len(number)], strict=True):
                base[at:stop] = before[number[at]] - (sums[at] - counts[at])
            total = sums + base
            last, held = number[-1], total[-1]
            yield pa.RecordBatch.from_arrays([batch.column("x"), pa.array(total[:, 0]), pa.array(total[:, 1] - counts[:, 1])], ["x", "begun", "over"])

    shape = StructType([*(f for f in marks.schema.fields if f.name == "x"), StructField("begun", LongType()), StructField("over", LongType())])
    line = dealt.repartition("part").sortWithinPartitions("part", "x").mapInArrow(run, shape)
    met = rows.join(line.select(F.col("x").alias("hi"), "begun"), "hi", "left").join(line.select(F.col("x").alias("lo"), "over"), "lo", "left")
    n = F.when(F.col("lo") <= F.col("hi"), F.col("begun") - F.col("over"))
    return met.select("l.*", F.coalesce(n, zero).alias(out))
