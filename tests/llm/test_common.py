import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from aerolith.llm import common
from aerolith.llm.common import checkpoint_dir, checkpointed, held_out, sum_arrays, written


def test_sums_over_many_partitions(spark, monkeypatch):
    monkeypatch.setattr(common, "FAN", 3)
    monkeypatch.setattr(common, "CHUNK", 7)

    def partial(batches):
        out = {"a": np.zeros(20, np.int64), "b": np.zeros(3, np.int64)}
        for pdf in batches:
            np.add.at(out["a"], pdf["id"] % 20, 1)
            out["b"][1] += int(pdf["id"].sum()) * 10**6
        return out

    got = sum_arrays(spark.range(0, 1000, 1, 31), partial)
    assert got["a"].tolist() == [50] * 20 and got["b"].tolist() == [0, 499_500 * 10**6, 0]
    assert sum_arrays(spark.range(0), partial) == {}


def test_lineage_is_cut_in_the_shared_folder(spark):
    df = spark.range(10).selectExpr("id", "id % 3 AS k")
    for cut in (checkpointed, written):
        out = cut(df)
        assert out.count() == 10 and "Range" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert checkpoint_dir(spark)


@pytest.mark.parametrize("value", [0, 17, -3, None])
def test_held_out_is_null_safe(spark, value):
    row = spark.createDataFrame([(value,)], "d long").select(held_out(F.col("d"))).first()[0]
    assert row is (zlib.crc32(("" if value is None else str(value)).encode()) % 5 == 0)
