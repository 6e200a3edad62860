"""Outside programs that answer row by row: one process a task, frames, time limits, and retries from a table of attempts.

Starting a program for each row costs more than most rows' work.  Here a task starts it once and talks to it in frames, a line of JSON for each row and one back.
A row has a limit of time: a program that does not answer in time, or ends, is stopped, the row has failed, and the next row gets a new process.  Every try
is a row of the attempts table; what has not succeeded, and was not tried too often, is tried again by the next run.
"""

from __future__ import annotations

import json
import os
import selectors
import subprocess
import time
from collections.abc import Iterator, Mapping, Sequence
from typing import Any

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from aerolith.shared import staged

#: Longest answer in bytes, and of its error text what the attempts table keeps.
ANSWER_BYTES, ERROR_CHARS = 1 << 24, 2000


class Program:
    """A process that answers a line with a line."""

    def __init__(self, argv: Sequence[str], env: Mapping[str, str] | None = None):
        self.argv, self.env = list(argv), env
        self.process: subprocess.Popen | None = None
        self.rest = b""

    def _running(self) -> subprocess.Popen:
        if self.process is None or self.process.poll() is not None:
            self.stop()
            self.process = subprocess.Popen(self.argv, stdin=subprocess.PIPE, stdout=subprocess.PIPE, stderr=subprocess.DEVNULL, env={**os.environ, **(self.env or {})}, bufsize=0)
        return self.process

    def ask(self, line: bytes, timeout_s: float) -> bytes:
        """The answer; TimeoutError after the limit, EOFError if the program ends.  After either the process is gone."""
        process, end = self._running(), time.monotonic() + timeout_s
        data, answer = memoryview(line + b"\n"), self.rest
        os.set_blocking(process.stdin.fileno(), False)
        try:
            with selectors.DefaultSelector() as ready:
                ready.register(process.stdout, selectors.EVENT_READ)
                ready.register(process.stdin, selectors.EVENT_WRITE)
                while b"\n" not in answer:
                    left = end - time.monotonic()
                    if left <= 0:
                        raise TimeoutError(f"no answer in {timeout_s:g} s")
                    for key, _ in ready.select(left):
                        if key.fileobj is process.stdin:
                            data = data[os.write(process.stdin.fileno(), data[: 1 << 16]) :]
                            if not data:
                                ready.unregister(process.stdin)
                        else:
                            got = os.read(process.stdout.fileno(), 1 << 16)
                            if not got:
                                raise EOFError(f"the program ended with {process.wait()}")
                            answer += got
                            if len(answer) > ANSWER_BYTES:
                                raise OSError("the answer is too long")
        except (OSError, EOFError, TimeoutError) as error:
            self.stop()
            if isinstance(error, BrokenPipeError):
                raise EOFError("the program ended") from error
            raise
        answer, _, self.rest = answer.partition(b"\n")
        return answer

    def stop(self) -> None:
        if self.process is not None:
            self.process.kill()
            self.process.wait()
            for pipe in (self.process.stdin, self.process.stdout):
                pipe.close()
        self.process, self.rest = None, b""


def _value(v: Any) -> Any:
    return v.isoformat() if hasattr(v, "isoformat") else str(v) if not isinstance(v, (str, int, float, bool, list, dict, type(None))) else v


def attempted(rows: DataFrame, argv: Sequence[str], schema: StructType | str, keys: Sequence[str], timeout_s: float = 60.0, attempt: str | None = None, env: Mapping[str, str] | None = None) -> DataFrame:
    """One attempt a row: keys, the answer's columns (`schema`), status (success, failed, timeout), error, seconds, attempt.

    The program gets all columns of a row as a JSON object and answers with one: its fields are the answer's columns, missing ones null; a field `error` that is not null, or an answer
    that is no object or does not fit the schema, fails the row.  `attempt` names a column with the number of attempts before.  Programs run as the task's user and see its environment.
    A task that Spark runs again asks again, so programs must bear that.  An empty table starts no program.
    """
    shape = rows.sparkSession.createDataFrame([], schema).schema
    names = [f.name for f in shape]
    from pyspark.sql.pandas.types import to_arrow_type

    kinds = [to_arrow_type(f.dataType) for f in shape]
    sent = [c for c in rows.columns if c != attempt]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        program = Program(argv, env)
        try:
            for batch in batches:
                for at in range(0, batch.num_rows, 256):
                    yield tried(program, batch.slice(at, 256))
        finally:
            program.stop()

    def tried(program: Program, batch: pa.RecordBatch) -> pa.RecordBatch:
        out: list[list] = [[] for _ in names]
        status, errors, seconds = [], [], []
        for row in batch.select(sent).to_pylist():
            began, answer, state, error = time.monotonic(), {}, "success", None
            try:
                answer = json.loads(program.ask(json.dumps({k: _value(v) for k, v in row.items()}).encode(), timeout_s))
                if not isinstance(answer, dict):
                    raise ValueError("the answer is no object")
                if answer.get("error") is not None:
                    raise ValueError(str(answer["error"]))
                for n, kind in zip(names, kinds, strict=True):
                    pa.scalar(answer.get(n), kind)
            except TimeoutError as e:
                answer, state, error = {}, "timeout", str(e)
            except (EOFError, OSError, ValueError, TypeError, OverflowError) as e:
                answer, state, error = {}, "failed", str(e)[:ERROR_CHARS]
            for values, n in zip(out, names, strict=True):
                values.append(answer.get(n))
            status.append(state)
            errors.append(error)
            seconds.append(time.monotonic() - began)
        before = batch.column(attempt).to_pylist() if attempt else [0] * batch.num_rows
        columns = [*(batch.column(k) for k in keys), *(pa.array(v, t) for v, t in zip(out, kinds, strict=True)), pa.array(status), pa.array(errors, pa.string()), pa.array(seconds, pa.float64()), pa.array([b + 1 for b in before], pa.int32())]
        return pa.RecordBatch.from_arrays(columns, [*keys, *names, "status", "error", "seconds", "attempt"])

    held = {f.name: f for f in rows.schema}
    result = StructType([*(held[k] for k in keys), *shape.fields]).add("status", "string").add("error", "string").add("seconds", "double").add("attempt", "integer")
    return rows.mapInArrow(run, result)


def _attempts(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def pending(rows: DataFrame, attempts: DataFrame | None, keys: Sequence[str], most: int) -> DataFrame:
    """The rows that have no success and fewer than `most` attempts, with __attempts, their number so far."""
    if attempts is None:
        return rows.withColumn("__attempts", F.lit(0))
    done = attempts.groupBy(*keys).agg(F.count("*").cast("int").alias("__attempts"), F.max(F.col("status") == "success").alias("__ok"))
    joined = rows.join(done, list(keys), "left")
    return joined.where(~F.coalesce("__ok", F.lit(False)) & (F.coalesce("__attempts", F.lit(0)) < most)).withColumn("__attempts", F.coalesce("__attempts", F.lit(0))).drop("__ok")


def run_programs(rows: DataFrame, path: str, argv: Sequence[str], schema: StructType | str, keys: Sequence[str], timeout_s: float = 60.0, most: int = 3, env: Mapping[str, str] | None = None) -> DataFrame:
    """Try every pending row once, append the attempts to the table at `path`, and give the last attempt of each row of `rows`.

    `keys` are unique and not null.  Call again to try again what failed, until `most` attempts are spent; what succeeded is never asked again.
    """
    spark = rows.sparkSession
    todo = staged(pending(rows, _attempts(spark, path), keys, most), "pending")
    attempted(todo, argv, schema, keys, timeout_s, "__attempts", env).write.mode("append").parquet(path)
    table = spark.read.parquet(path)
    best = F.max_by(F.struct(*(c for c in table.columns if c not in keys)), "attempt").alias("__last")
    return table.groupBy(*keys).agg(best).select(*keys, "__last.*").join(rows.select(*keys), list(keys), "left_semi")
