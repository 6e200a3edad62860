import math

import numpy as np
import pytest

from aerolith.llm.embeddings import PROJECTIONS, TABLES, miss_chance, near_vectors, step_chance
from aerolith.llm.queries import op13_embedding_near_dedup
from tests.llm.fixtures import CLASHING

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, cosine=0.98):
    """Rows of (vec_id, vector, label) -> sorted (vec_id, n_links, component_id, kept) by comparing all pairs."""
    def unit(v):
        if not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            return None
        v = np.array(v, float) / max(map(abs, v))
        return v / np.linalg.norm(v)

    units = [unit(v) for _, v, _ in rows]
    near = [{j for j in range(len(rows)) if j != i and u is not None and units[j] is not None and rows[i][2] is not None and rows[j][2] == rows[i][2] and len(u) == len(units[j]) and u @ units[j] >= cosine} for i, u in enumerate(units)]
    out = []
    for i, (v, _, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            todo += (new := near[todo.pop()] - seen)
            seen |= new
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        least = min(ids) if ids else None
        out.append((v, len(near[i]), least, v == least))
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, df.select("vec_id", "n_links", "component_id", "kept").collect()), key=str)


def test_query_equals_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert got(op13_embedding_near_dedup(spark, sf_dir)) == brute(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None, 1), (2, [], 1), (3, [0.0, 0.0], 1), (4, [1.0, None], 1), (5, [nan, 1.0], 1), (6, [inf, 1.0], 1),
        (7, [1.0, 2.0], None), (8, [1.0, 2.0], None), (9, [1.0, 2.0], 1), (10, [2.0, 4.0], 1), (11, [1.0, 2.0, 0.0], 1),
        (12, [1.0, 2.0], 2), (13, [1e300, 2e300], 1), (14, [1e-300, 2e-300], 1), (None, [1.0, 2.0], 1), (9, [1.0, 2.0], 1),
        (15, [-1.0, -2.0], 1), (16, [5.0, -5.0], 3), (16, [5.0, -5.0], 3), (None, [-7.0, 1.0], 4), (17, [0.0, 1.0], 5), (18, [-0.0, 1.0], 5),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    for c in CLASHING:
        df = df.selectExpr("*", f"'x' AS `{c}`") if c not in df.columns else df
    assert got(near_vectors(df)) == brute(rows)
    assert near_vectors(df.limit(0)).collect() == []


@pytest.mark.parametrize("block", [7, 512])
def test_groups_of_copies_and_near_copies(spark, block):
    """A third of the rows are one vector, a third near copies of another; chains stretch past the threshold."""
    rng = np.random.default_rng(3)
    hot, other = rng.standard_normal((2, 16))
    rows = [(i, hot, 1) for i in range(80)] + [(100 + i, other + 0.13 * rng.standard_normal(16) * np.linalg.norm(other) / 4, 1) for i in range(80)]
    angle = np.arange(40) * 0.15
    rows += [(300 + i, [math.cos(a), math.sin(a), *[0.0] * 14], 2) for i, a in enumerate(angle)]
    rows += [(400 + i, rng.standard_normal(16), int(i % 3)) for i in range(60)]
    rows = [(int(i), [float(x) for x in v], k) for i, v, k in rows]
    want = brute(rows)
    assert got(near_vectors(spark.createDataFrame(rows, SCHEMA).repartition(5), block=block)) == want
    assert max(n for _, n, _, _ in want) == 79 and len({c for _, _, c, _ in want if c is not None and 300 <= c < 400}) == 1


def test_chances():
    """Steps are shared as often as the formula says, and the parameters miss few pairs at the threshold."""
    rng = np.random.default_rng(5)
    for distance in (0.2, 1.0, 1.4):
        a, b = rng.standard_normal(200_000) * distance, rng.uniform(0, 2, 200_000)
        assert abs(np.mean(np.floor(b / 2) == np.floor((a + b) / 2)) - step_chance(distance, 2)) < 0.005
    assert miss_chance(0.98) < 1e-4 and step_chance(math.sqrt(2), 2) ** PROJECTIONS * TABLES < 0.02
