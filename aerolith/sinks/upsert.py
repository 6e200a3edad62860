"""Upserts and scoped overwrites of Parquet tables.

Built-in tables take no MERGE, so an upsert rewrites the partitions that its source touches: new rows plus the
target's rows whose keys the source lacks, staged next to the table and then swapped in by dynamic overwrite.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from aerolith.operators.dedup import insert_new


def merged(target: DataFrame, source: DataFrame, keys: Sequence[str], null_safe: bool = False) -> DataFrame:
    """What MERGE leaves: the source's rows, and the target's rows of other keys.  The source must have unique keys."""
    return insert_new(source, target, list(keys), null_safe).unionByName(source, allowMissingColumns=True)


def read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at `path`, or None if there is no such folder or it holds no files; any other failure is an error."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def repeated_keys(df: DataFrame, keys: Sequence[str], null_safe: bool = False) -> DataFrame:
    """The keys that several rows have; null is a key only if nulls are to match."""
    rows = df if null_safe else df.dropna(subset=list(keys))
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def upsert(source: DataFrame, path: str, keys: Sequence[str], partition_by: Sequence[str] = (), null_safe: bool = False) -> None:
    """Merge `source` into the table at `path`; only the partitions of source rows are read and rewritten.

    A key that the source repeats is an error, as in MERGE.  A key must not move between partitions (partition columns
    are part of it or follow from it).  The source is computed once, into a table beside the target, from which it is checked and merged.
    """
    spark = source.sparkSession
    folder = f"{path.rstrip('/')}__source_{uuid.uuid4().hex}"
    source.write.parquet(folder)
    try:
        _upsert(spark.read.schema(source.schema).parquet(folder), path, keys, partition_by, null_safe)
    finally:
        place, files = _files(spark, folder)
        files.delete(place, True)


def _upsert(source: DataFrame, path: str, keys: Sequence[str], partition_by: Sequence[str], null_safe: bool) -> None:
    spark = source.sparkSession
    if keys and not repeated_keys(source, keys, null_safe).isEmpty():
        raise ValueError(f"the source repeats a key of {', '.join(keys)}")
    target = read_or_none(spark, path)
    if target is not None and partition_by:
        touched = source.select(*partition_by).distinct()
        target = target.join(touched, list(partition_by), "left_semi")
    new = source if target is None else merged(target, source.select(*target.columns) if set(source.columns) == set(target.columns) else source, keys, null_safe)
    replace_partitions(new, path, partition_by)


def _files(spark: SparkSession, path: str):
    """The folder and its file system."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def _swap(spark: SparkSession, staged: str, path: str) -> None:
    """Put a staged table in the place of another by renaming: at every moment one of the two lies whole under its own or the old one's set-aside name."""
    (old, files), (new, _), (aside, _) = _files(spark, path), _files(spark, staged), _files(spark, f"{path.rstrip('/')}__old_{uuid.uuid4().hex}")
    had = files.exists(old)
    if had and not files.rename(old, aside):
        raise OSError(f"{path} cannot be set aside")
    if not files.rename(new, old):
        if had:
            files.rename(aside, old)
        raise OSError(f"{staged} cannot be renamed to {path}")
    if had:
        files.delete(aside, True)


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Overwrite the partitions of `df` (or the whole table) with its rows, which may come from the table itself."""
    spark = df.sparkSession
    if not partition_by:
        replace_table(df, path)
        return
    staged = f"{path.rstrip('/')}__staged_{uuid.uuid4().hex}"
    df.write.parquet(staged)
    spark.read.schema(df.schema).parquet(staged).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)
    folder, files = _files(spark, staged)
    files.delete(folder, True)


def replace_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Put `df`, which may come from the table itself, in the place of the whole table."""
    staged = f"{path.rstrip('/')}__staged_{uuid.uuid4().hex}"
    (df.write.partitionBy(*partition_by) if partition_by else df.write).parquet(staged)
    _swap(df.sparkSession, staged, path)


def delete_where(spark: SparkSession, path: str, condition: Column, partition_by: Sequence[str] = ()) -> None:
    """Drop rows for which the condition is true; null keeps a row.  The table is staged and swapped in."""
    replace_table(spark.read.parquet(path).where(~F.coalesce(condition, F.lit(False))), path, partition_by)


def append_new(source: DataFrame, path: str, keys: Sequence[str], null_safe: bool = False) -> None:
    """Append the rows whose keys the table lacks."""
    target = read_or_none(source.sparkSession, path)
    rows = source if target is None else insert_new(target, source, list(keys), null_safe)
    rows.write.mode("append").parquet(path)


def full_refresh(source: DataFrame, path: str, column: str, partition_by: Sequence[str] = ()) -> None:
    """Replace the table's rows within the source's range of `column`, and nothing else; an empty source changes nothing.

    Partitions that the range touches are rewritten, those of which no row is left are deleted, all others are not read whole.
    """
    spark = source.sparkSession
    target = read_or_none(spark, path)
    if target is None:
        replace_partitions(source, path, partition_by)
        return
    bounds = source.agg(F.min(column).alias("lo"), F.max(column).alias("hi")).first()
    if bounds["lo"] is None:
        return
    inside = F.coalesce(F.col(column).between(F.lit(bounds["lo"]), F.lit(bounds["hi"])), F.lit(False))
    if not partition_by:
        replace_partitions(target.where(~inside).unionByName(source, allowMissingColumns=True), path)
        return
    parts = list(partition_by)
    touched = target.where(inside).select(*parts).distinct().unionByName(source.select(*parts).distinct()).distinct()
    new = target.where(~inside).join(touched, parts, "left_semi").unionByName(source, allowMissingColumns=True)
    # One folder for each partition with rows in the range; those without a row to come are emptied after the write.
    folder = F.regexp_replace("_metadata.file_path", "/[^/]*$", "")
    emptied = target.where(inside).select(*parts, folder.alias("__folder")).distinct().join(new.select(*parts).distinct(), parts, "left_anti")
    gone = [r["__folder"] for r in emptied.select("__folder").distinct().collect()]
    replace_partitions(new, path, partition_by)
    for name in gone:
        # The path comes percent-encoded, as a URI.
        old = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(name))
        old.getFileSystem(spark._jsc.hadoopConfiguration()).delete(old, True)
    spark.catalog.refreshByPath(path)


def empty_table(spark: SparkSession, schema: StructType | str) -> DataFrame:
    """No rows of a schema, for a source that is absent."""
    return spark.createDataFrame([], schema)
