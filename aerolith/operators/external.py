"""Programs outside Spark, one call per row."""

from __future__ import annotations

import subprocess
from collections.abc import Callable, Iterator, Mapping, Sequence
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame

STATUS = "status string, error_message string"


def call_per_row(df: DataFrame, call: Callable[[Mapping[str, Any]], Mapping[str, Any]], schema: str, keep: Sequence[str]) -> DataFrame:
    """`keep` columns, the call's columns (`schema`), status and error_message: one row per row.

    `call` gets a row as a mapping.  What it raises becomes the status 'failed' with the message, and nulls.  Rows are
    dealt out by Spark; a retried task calls again, so a call must be able to run twice.
    """
    names = [c.strip().split()[0] for c in schema.split(",")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for row in pdf.to_dict("records"):
                try:
                    got, status, error = call(row), "success", None
                except Exception as e:
                    got, status, error = {}, "failed", f"{type(e).__name__}: {e}"[:2000]
                rows.append([row[c] for c in keep] + [got.get(n) for n in names] + [status, error])
            yield pd.DataFrame(rows, columns=[*keep, *names, "status", "error_message"])

    kinds = dict(df.dtypes)
    return df.mapInPandas(run, ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), schema, STATUS]))


def command(build: Callable[[Mapping[str, Any]], Sequence[str]], timeout: float = 600.0) -> Callable[[Mapping[str, Any]], Mapping[str, Any]]:
    """A call that runs a program and gives its output as the column `output`; a non-zero exit is an error."""

    def call(row: Mapping[str, Any]) -> Mapping[str, Any]:
        done = subprocess.run(list(build(row)), capture_output=True, text=True, timeout=timeout, check=False)
        if done.returncode:
            raise RuntimeError(f"exit {done.returncode}: {(done.stderr or done.stdout)[-1000:]}")
        return {"output": done.stdout}

    return call
