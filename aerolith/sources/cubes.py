"""Cubes of gridded values as a data source: files are cut into slabs of time, and filters choose slabs before any value is read.

A decoder turns an opened file into variables with dimensions, attributes and sliced reads; binary formats need their libraries, so it is given with the source (one for
`.npz` files with described arrays comes along).  All else is here: variables are searched by aliases in any group, times in `units since` and their calendars become
timestamps, axes are found by name or length and put in order, fills and scales are undone, and longitudes run from -180 to 180.
Planning reads headers and axes alone.  Comparisons of time, lat, lon and variable that Spark pushes down choose slabs, and rows and columns within them.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime
from typing import Any, Protocol

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual
from pyspark.sql.types import StructType

#: Names of the axes, and what is no value in any file.
TIME_NAMES, LAT_NAMES, LON_NAMES = ("valid_time", "time"), ("latitude", "lat"), ("longitude", "lon")
LEAST = -1e30
FIRST_GROUP = "PRODUCT"
SCHEMA = "path string, variable string, time timestamp_ntz, row int, col int, lat double, lon double, value double"
#: Microseconds of the units of time, and lengths of the months of calendars without leap days.
UNITS = {"microsecond": 1, "millisecond": 1_000, "msec": 1_000, "second": 1_000_000, "sec": 1_000_000, "s": 1_000_000, "minute": 60_000_000, "min": 60_000_000, "hour": 3_600_000_000, "hr": 3_600_000_000, "h": 3_600_000_000, "day": 86_400_000_000, "d": 86_400_000_000}
MONTHS = (31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31)
STANDARD = ("standard", "gregorian", "proleptic_gregorian")
DAY = UNITS["day"]


@dataclass(frozen=True)
class Variable:
    """A variable of a file: its dimensions, their lengths, and its attributes."""

    dims: tuple[str, ...]
    shape: tuple[int, ...]
    attrs: Mapping[str, Any] = field(default_factory=dict)


class Cube(Protocol):
    """What a decoder gives for a file: variables by name (groups before a slash), and reads of parts of them."""

    variables: Mapping[str, Variable]

    def read(self, name: str, part: tuple[slice, ...]) -> np.ndarray: ...


class NpzCube:
    """Arrays of a `.npz` file; its member `describe` holds JSON of each array's dims and attrs."""

    def __init__(self, file: Any):
        self._arrays = np.load(file, allow_pickle=False)
        told = json.loads(str(self._arrays["describe"]))
        self._held: dict[str, np.ndarray] = {}
        self.variables = {k: Variable(tuple(v["dims"]), tuple(v["shape"]), v.get("attrs", {})) for k, v in told.items()}

    def read(self, name: str, part: tuple[slice, ...]) -> np.ndarray:
        if name not in self._held:
            self._held[name] = self._arrays[name.replace("/", "__")]
        return self._held[name][part]

    @staticmethod
    def save(file: Any, arrays: Mapping[str, tuple[Sequence[str], np.ndarray, Mapping[str, Any]]]) -> None:
        """Write arrays (name -> dims, values, attributes)."""
        told = {k: {"dims": list(d), "shape": list(np.shape(a)), "attrs": dict(t)} for k, (d, a, t) in arrays.items()}
        np.savez(file, describe=np.array(json.dumps(told)), **{k.replace("/", "__"): a for k, (_, a, _) in arrays.items()})


def find_variable(names: Sequence[str], aliases: Sequence[str], group: str | None = None) -> str | None:
    """The variable of the first alias that any has, whatever case: in `group` if given, else without a group, in the first group by rule, then in any, by name."""
    place = lambda n: (n.count("/") > 0, n.split("/")[0] != FIRST_GROUP, n.count("/"), n)
    for alias in aliases:
        found = [n for n in names if n.rpartition("/")[2].lower() == alias.lower() and (group is None or n.rpartition("/")[0] == group)]
        if found:
            return min(found, key=place)
    return None


def _years(days: np.ndarray, calendar: str) -> np.ndarray:
    """Days since year 0 of a calendar of equal years -> dates; days that no real month has are NaT."""
    if calendar == "360_day":
        year, month, day = days // 360, days % 360 // 30, days % 30
    else:
        lengths = MONTHS if calendar in ("noleap", "365_day") else (31, 29, *MONTHS[2:])
        ends = np.cumsum(lengths)
        year, rest = days // ends[-1], days % ends[-1]
        month = np.searchsorted(ends, rest, "right")
        day = rest - np.concatenate([[0], ends])[month]
    start = (year * 12 + month - 1970 * 12).astype("datetime64[M]")
    return np.where(day < ((start + 1).astype("datetime64[D]") - start.astype("datetime64[D]")).astype(int), start.astype("datetime64[D]") + day, np.datetime64("NaT"))


def decode_times(values: np.ndarray, units: str | None, calendar: str = "standard") -> np.ndarray:
    """Numbers of `units since` a moment as datetime64[us]; without units seconds since 1970.  Zones of the moment are undone; missing numbers are NaT.

    Calendars: standard (as proleptic: moments before 1582 are not told apart), noleap or 365_day, all_leap or 366_day, 360_day.  What has no real date is NaT.
    """
    x = np.asarray(values, float)
    told = re.fullmatch(r"\s*(\w+?)s?\s+since\s+(-?\d{1,4})-(\d{1,2})-(\d{1,2})(?:[T ]+(\d{1,2}):(\d{1,2})(?::(\d{1,2})(\.\d+)?)?)?\s*(?:Z|UTC|GMT|([+-])(\d{1,2}):?(\d{2})?)?\s*", units or "seconds since 1970-01-01", re.IGNORECASE)
    if told is None or (told[1].lower() not in UNITS):
        raise ValueError(f"times in {units!r} are not known")
    year, month, day, hour, minute, second = (int(told[i] or 0) for i in range(2, 8))
    offset = (hour * 60 + minute) * 60_000_000 + second * 1_000_000 + round(float(told[8] or 0) * 1e6)
    if told[9]:
        offset -= (1 if told[9] == "+" else -1) * (int(told[10]) * 60 + int(told[11] or 0)) * 60_000_000
    good = np.isfinite(x) & (np.abs(x) < 1e18)
    micros = np.round(np.where(good, x, 0) * UNITS[told[1].lower()]).astype(np.int64) + offset
    calendar = calendar.lower()
    if calendar in STANDARD:
        out = np.datetime64(f"{year:04d}-{month:02d}-{day:02d}", "us") + micros
    elif calendar in ("noleap", "365_day", "all_leap", "366_day", "360_day"):
        lengths = MONTHS if calendar in ("noleap", "365_day") else (31, 29, *MONTHS[2:])
        first = year * 360 + (month - 1) * 30 if calendar == "360_day" else year * sum(lengths) + sum(lengths[: month - 1])
        days = first + day - 1 + micros // DAY
        out = _years(days, calendar).astype("datetime64[us]") + micros % DAY
    else:
        raise ValueError(f"the calendar {calendar!r} is not known")
    return np.where(good, out, np.datetime64("NaT"))


def real_values(x: np.ndarray, attrs: Mapping[str, Any]) -> np.ndarray:
    """Stored numbers as values: fills, what lies outside the valid range and anything below the common fill are NaN, then scale and offset."""
    out = np.asarray(x, float)
    bad = out < LEAST
    for name in ("_FillValue", "missing_value"):
        if attrs.get(name) is not None:
            bad |= out == float(attrs[name])
    if attrs.get("valid_range") is not None:
        low, high = attrs["valid_range"]
        bad |= (out < low) | (out > high)
    return np.where(bad, np.nan, out) * float(attrs.get("scale_factor", 1)) + float(attrs.get("add_offset", 0))


def axes_of(variable: Variable, lengths: Sequence[int | None]) -> list[int | None]:
    """The places of time, lat and lon among a variable's dimensions: by name, else by length, lon last if several fit; None where it has no such axis."""
    names = [d.rpartition("/")[2].lower() for d in variable.dims]
    out: list[int | None] = [next((i for i, d in enumerate(names) if d in known), None) for known in (TIME_NAMES, LAT_NAMES, LON_NAMES)]
    for k in (2, 0, 1):
        if out[k] is None and lengths[k] is not None:
            free = [i for i, n in enumerate(variable.shape) if n == lengths[k] and i not in out]
            out[k] = (free[-1] if k == 2 else free[0]) if free else None
    return out


@dataclass
class Slab(InputPartition):
    """Time steps t0 to t1 of one variable of a file, in its rows i0 to i1 and columns j0 to j1."""

    path: str
    name: str
    alias: str
    box: tuple[int, int, int, int, int, int]

    def __init__(self, path: str, name: str, alias: str, box: tuple[int, int, int, int, int, int]):
        super().__init__((path, name, box))
        self.path, self.name, self.alias, self.box = path, name, alias, box


def east(lon: np.ndarray) -> np.ndarray:
    """Longitudes from -180 up to 180; those that are already stay as they are."""
    return np.where((lon >= -180) & (lon < 180), lon, (lon + 180) % 360 - 180)


class Axes:
    """Times and places of a file."""

    def __init__(self, cube: Cube):
        names = list(cube.variables)
        whole = lambda n: cube.read(n, tuple(slice(None) for _ in cube.variables[n].shape))
        lat, lon, time = (find_variable(names, known) for known in (LAT_NAMES, LON_NAMES, TIME_NAMES))
        if lat is None or lon is None:
            raise KeyError("the file has no latitudes or longitudes")
        y, x = (real_values(whole(n), cube.variables[n].attrs) for n in (lat, lon))
        # Swaths keep one grid for each of their steps; the first counts.
        self.lat, self.lon = (a[0] if a.ndim == 3 else a for a in (y, east(x)))
        attrs = cube.variables[time].attrs if time else {}
        self.times = np.atleast_1d(decode_times(whole(time), attrs.get("units"), attrs.get("calendar", "standard"))) if time else None
        self.lengths = [None if self.times is None else len(self.times), self.lat.shape[0], self.lon.shape[-1]]


class Bounds:
    """Lowest and highest of what pushed comparisons leave, both included."""

    def __init__(self):
        self.low: dict[str, Any] = {}
        self.high: dict[str, Any] = {}
        self.variables: set[str] | None = None

    def take(self, f: Filter) -> bool:
        """Learn from a filter; False if it is of no use here."""
        column = getattr(f, "attribute", (None,))[0]
        if column == "variable" and isinstance(f, (EqualTo, In)):
            given = {f.value} if isinstance(f, EqualTo) else set(f.value)
            self.variables = given if self.variables is None else self.variables & given
        elif column in ("time", "lat", "lon") and isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)):
            value = f.value.replace(tzinfo=None) if isinstance(f.value, datetime) else f.value
            value = np.datetime64(value, "us") if column == "time" else float(value)
            if not isinstance(f, (LessThan, LessThanOrEqual)):
                self.low[column] = max(value, self.low.get(column, value))
            if not isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                self.high[column] = min(value, self.high.get(column, value))
        else:
            return False
        return True

    def inside(self, column: str, x: np.ndarray) -> np.ndarray:
        """Which of x may count; NaT and NaN may, as Spark looks again."""
        out = np.ones(x.shape, bool)
        if column in self.low:
            out &= ~(x < self.low[column])
        if column in self.high:
            out &= ~(x > self.high[column])
        return out

    def span(self, column: str, x: np.ndarray) -> tuple[int, int]:
        """First and last place, not included, of an axis that may count."""
        at = np.flatnonzero(self.inside(column, x))
        return (int(at[0]), int(at[-1]) + 1) if len(at) else (0, 0)


class CubeReader(DataSourceReader):
    def __init__(self, path: str, decode: Callable[[Any], Cube], variables: Mapping[str, Sequence[str]], cells: int, pattern: str, threads: int):
        self.path, self.decode, self.variables, self.cells, self.pattern, self.threads = path, decode, variables, cells, pattern, threads
        self.bounds = Bounds()

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Slabs, rows and columns are chosen by these; Spark tests the rows all the same, as a slab is wider than a filter."""
        for f in filters:
            self.bounds.take(f)
            yield f

    def _files(self) -> list[str]:
        files, root = pafs.FileSystem.from_uri(self.path.replace("file:/", "file:///", 1) if re.match(r"file:/[^/]", self.path) else self.path)
        found = files.get_file_info(pafs.FileSelector(root, recursive=True))
        return sorted(f.path for f in found if f.is_file and re.fullmatch(self.pattern, f.base_name))

    def _open(self, path: str) -> Cube:
        files, _ = pafs.FileSystem.from_uri(self.path.replace("file:/", "file:///", 1) if re.match(r"file:/[^/]", self.path) else self.path)
        return self.decode(files.open_input_file(path))

    def slabs(self, path: str, bounds: Bounds) -> list[Slab]:
        """The slabs of a file that may hold rows within the bounds, each of about `cells` values."""
        cube = self._open(path)
        axes, out = Axes(cube), []
        for alias, names in self.variables.items():
            found = find_variable(list(cube.variables), names)
            if found is None or (bounds.variables is not None and alias not in bounds.variables):
                continue
            rows, columns = (bounds.span("lat", axes.lat), bounds.span("lon", axes.lon)) if axes.lat.ndim == 1 else ((0, axes.lat.shape[0]), (0, axes.lat.shape[1]))
            t0, t1 = (0, 1) if axes.times is None else bounds.span("time", axes.times)
            n = (rows[1] - rows[0]) * (columns[1] - columns[0])
            if not n:
                continue
            step = max(1, self.cells // n)
            out += [Slab(path, found, alias, (t, min(t + step, t1), *rows, *columns)) for t in range(t0, t1, step)]
        return out

    def plan(self, bounds: Bounds) -> list[Slab]:
        with ThreadPoolExecutor(self.threads) as pool:
            return [s for found in pool.map(lambda p: self.slabs(p, bounds), self._files()) for s in found]

    def partitions(self) -> Sequence[InputPartition]:
        return self.plan(self.bounds) or [Slab("", "", "", (0, 0, 0, 0, 0, 0))]

    def read(self, partition: Slab) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        cube = self._open(partition.path)
        axes, variable = Axes(cube), cube.variables[partition.name]
        t0, t1, i0, i1, j0, j1 = partition.box
        places = axes_of(variable, axes.lengths)
        part = [slice(None)] * len(variable.shape)
        for place, (lo, hi) in zip(places, ((t0, t1), (i0, i1), (j0, j1)), strict=True):
            if place is not None:
                part[place] = slice(lo, hi)
        x = real_values(cube.read(partition.name, tuple(part)), variable.attrs)
        # Axes of other kinds are averaged over what is finite; missing ones have length 1.
        for axis in sorted(set(range(x.ndim)) - set(places), reverse=True):
            n = np.isfinite(x).sum(axis)
            x = np.where(n > 0, np.nansum(x, axis) / np.maximum(n, 1), np.nan)
            places = [p if p is None or p < axis else p - 1 for p in places]
        x = x.transpose([p for p in places if p is not None])
        for k, p in enumerate(places):
            if p is None:
                x = np.expand_dims(x, k)
        lat, lon = np.meshgrid(axes.lat[i0:i1], axes.lon[j0:j1], indexing="ij") if axes.lat.ndim == 1 else (axes.lat[i0:i1, j0:j1], axes.lon[i0:i1, j0:j1])
        row, column = np.indices(lat.shape)
        n = lat.size
        for k, grid in enumerate(x):
            time = None if axes.times is None or np.isnat(axes.times[t0 + k]) else axes.times[t0 + k].item()
            arrays = [pa.array([partition.path] * n), pa.array([partition.alias] * n), pa.array([time] * n, pa.timestamp("us")), pa.array(row.ravel() + i0, pa.int32()), pa.array(column.ravel() + j0, pa.int32()), pa.array(lat.ravel()), pa.array(lon.ravel()), pa.array(np.broadcast_to(grid, lat.shape).ravel())]
            yield pa.RecordBatch.from_arrays(arrays, ["path", "variable", "time", "row", "col", "lat", "lon", "value"])


def cube_source(decode: Callable[[Any], Cube] = NpzCube, name: str = "cubes") -> type[DataSource]:
    """A data source of files that `decode` opens.

    Options: path; variables, JSON of output name -> aliases; cells (values a slab, a million if not given); pattern (a regular expression of file names); threads (that plan).
    A file without the variable gives no rows; one without places, or that does not decode, is an error.  Values that are missing are NaN.
    """

    class CubeSource(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return SCHEMA

        def reader(self, schema: StructType) -> CubeReader:
            o = self.options
            return CubeReader(o["path"], decode, json.loads(o["variables"]), int(o.get("cells", 1 << 20)), o.get("pattern", ".*"), int(o.get("threads", 16)))

    return CubeSource


def register_cubes(spark: SparkSession, decode: Callable[[Any], Cube] = NpzCube, name: str = "cubes") -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(cube_source(decode, name))


def cubes(spark: SparkSession, path: str, variables: Mapping[str, Sequence[str]], decode: Callable[[Any], Cube] = NpzCube, name: str = "cubes") -> DataFrame:
    """The cubes below `path` as rows, by output names and their aliases."""
    register_cubes(spark, decode, name)
    return spark.read.format(name).option("path", path).option("variables", json.dumps({k: list(v) for k, v in variables.items()})).load()
