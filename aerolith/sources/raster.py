"""Rasters as relations of pixels.

Binary readers of swaths and cubes are optional libraries, so each reader takes a function from a file's bytes to numpy
arrays.  One task reads one file; pixels leave it as Arrow batches, and every mask and statistic is a DataFrame
operation on them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

#: Fill below it, and the valid range of an aerosol depth's stored numbers.
SWATH_FILL, AOD_FILL, AOD_LOW, AOD_HIGH = -1e30, -28672, -1000, 30000
PIXELS = "path string, band string, time_index int, row int, col int, lat double, lon double, value double, qa double"

Decoded = Mapping[str, Any]


def swath_values(raw: np.ndarray, fill: float | None = None) -> np.ndarray:
    """The first time step; the file's fill and anything below the common fill are NaN."""
    x = np.asarray(raw, float)
    x = x[0] if x.ndim == 3 else x
    bad = x < SWATH_FILL
    return np.where(bad if fill is None else bad | (x == fill), np.nan, x)


def aod_values(raw: np.ndarray, scale: float = 0.001) -> np.ndarray:
    """Scaled depths; a third axis of orbits is averaged over what is valid."""
    x = np.asarray(raw, float)
    x = np.where((x == AOD_FILL) | (x < AOD_LOW) | (x > AOD_HIGH), np.nan, x)
    if x.ndim == 3:
        n = np.isfinite(x).sum(0)
        x = np.where(n > 0, np.nansum(x, 0) / np.maximum(n, 1), np.nan)
    return x * scale


def cube_values(raw: np.ndarray, dims: list[str], order: tuple[str, str, str] = ("time", "lat", "lon")) -> np.ndarray:
    """A cube with axes in this order; missing axes have length 1, other axes are averaged over what is finite."""
    x = np.asarray(raw, float)
    for axis in [i for i, d in enumerate(dims) if d not in order][::-1]:
        n = np.isfinite(x).sum(axis)
        x = np.where(n > 0, np.nansum(x, axis) / np.maximum(n, 1), np.nan)
    left = [d for d in dims if d in order]
    x = x.transpose([left.index(d) for d in order if d in left])
    for i, d in enumerate(order):
        if d not in left:
            x = np.expand_dims(x, i)
    return x


def read_pixels(spark: SparkSession, path: str, decode: Callable[[bytes], Decoded], pattern: str = "*") -> DataFrame:
    """Pixels of all files below `path`.

    `decode` gives bands (name -> 2-D or 3-D array, time first), lat and lon (1-D axes or 2-D grids) and, if there
    is one, qa (2-D).  A file that does not decode is an error of its task.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for name, content in zip(pdf["path"], pdf["content"], strict=True):
                yield from pixels_of(name, decode(content))

    # Whole files travel in these batches, so a batch holds few of them.
    return files.select("path", "content").mapInPandas(run, PIXELS)


def pixels_of(path: str, decoded: Decoded) -> Iterator[pd.DataFrame]:
    """One frame per band and time step."""
    lat, lon = np.asarray(decoded["lat"], float), np.asarray(decoded["lon"], float)
    if lat.ndim == 1:
        lat, lon = np.meshgrid(lat, lon, indexing="ij")
    qa = decoded.get("qa")
    for band, values in decoded["bands"].items():
        cube = np.asarray(values, float)
        cube = cube[None] if cube.ndim == 2 else cube
        for t, grid in enumerate(cube):
            row, col = np.indices(grid.shape)
            fits = qa is not None and np.shape(qa) == grid.shape
            yield pd.DataFrame(
                {"path": path, "band": band, "time_index": t, "row": row.ravel().astype("int32"), "col": col.ravel().astype("int32"), "lat": lat.ravel(), "lon": lon.ravel(), "value": grid.ravel(), "qa": np.ravel(qa).astype(float) if fits else np.nan}
            ).astype({"time_index": "int32"})
