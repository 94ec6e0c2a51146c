import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from fragmill.llm import queries, vectors
from fragmill.llm.vectors import Codes, near_vectors, rotated, tables, units

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows: list[tuple], threshold: float = 0.98) -> list[tuple]:
    """By all pairs, one at a time."""
    sound = []
    for _, v, label in rows:
        ok = label is not None and v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v)
        v = np.array(v, float) / max(map(abs, v)) if ok else None
        sound.append(v / np.linalg.norm(v) if ok else None)
    links, root = [0] * len(rows), list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sound[i], sound[j]
            if a is not None and b is not None and rows[i][2] == rows[j][2] and len(a) == len(b) and float(a @ b) >= threshold:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    least: dict = {}
    for i, r in enumerate(rows):
        known = [x for x in (least.get(find(i)), r[0]) if x is not None]
        least[find(i)] = min(known, default=None)
    return sorted([(r[0], links[i], least[find(i)], r[0] == least[find(i)]) for i, r in enumerate(rows)], key=repr)


def result(df) -> list[tuple]:
    return sorted([(r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in df.collect()], key=repr)


def mixed_rows(rng, labels=3, groups=12, dim=24) -> list[tuple]:
    out = []
    for label in range(labels):
        for _ in range(groups):
            base = rng.normal(size=dim)
            for _ in range(rng.integers(1, 7)):
                out.append((base + rng.normal(size=dim) * rng.choice([0, 0.05, 0.12, 0.2]) * np.linalg.norm(base) / math.sqrt(dim)).tolist() + [label])
    return [(i, v[:-1], int(v[-1])) for i, v in enumerate(out)]


def test_rotation_keeps_products():
    x = units([v.tobytes() for v in np.random.default_rng(1).normal(size=(20, 100))], "<f8")
    y = rotated(x, 3)
    assert np.allclose(y @ y.T, x @ x.T, atol=1e-5)


def test_estimate_is_unbiased_and_bound_holds():
    rng = np.random.default_rng(2)
    o, side = rng.normal(size=(2, 4000, 64))
    o /= np.linalg.norm(o, axis=1, keepdims=True)
    side -= (side * o).sum(1, keepdims=True) * o
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    how = Codes(0, 0.98)
    codes, factor = how.of(o)
    signs = (np.unpackbits(codes, axis=1).astype(float) * 2 - 1) / 8
    for t in (0.5, 0.9, 0.98):
        products = (rotated(t * o + math.sqrt(1 - t * t) * side, 0) * signs).sum(1)
        assert abs((products / factor).mean() - t) < 0.01
    assert (products >= how.least(factor, 64)).all()


def test_tables_leave_few_pairs_apart():
    same = 1 - math.acos(0.98) / math.pi
    for bits in (1, 6, 20):
        assert (1 - same**bits) ** tables(bits, 0.98) <= 1e-9
    assert tables(0, 0.98) == 1


@pytest.mark.parametrize(("bucket", "block"), [(128, 4096), (2, 4096), (2, 3), (128, 3)])
def test_links_equal_brute_force(spark, monkeypatch, bucket, block):
    monkeypatch.setattr(vectors, "BUCKET", bucket)
    monkeypatch.setattr(vectors, "BLOCK", block)
    rows = mixed_rows(np.random.default_rng(bucket + block))
    rows += [(1000 + i, rows[0][1], rows[0][2]) for i in range(9)] + [(2000, [2 * x for x in rows[0][1]], rows[0][2])]
    assert result(near_vectors(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    odd = [None, [], [0.0, 0.0], [-0.0, 0.0], [1.0, None], [nan, 1.0], [inf, 1.0], [1.0], [2.0], [-1.0], [1.0, 1.0], [1e200, 1e200], [1e-200, 1e-200], [1.0, -0.0], [1.0, 0.0], [1.0, 1.0, 0.0]]
    rows = [(i, v, 1) for i, v in enumerate(odd)] + [(100 + i, v, None) for i, v in enumerate(odd)] + [(None, [1.0, 1.0], 1), (None, [7.0, -3.0], 1), (10, [1.0, 1.0], 1), (3, [1.0, 1.01], 2), (3, [5.0, -1.0], 2)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("key", F.lit(1)).withColumn("n", F.lit(2)).withColumn("cid", F.lit(3))
    assert result(near_vectors(df)) == brute(rows)
    assert near_vectors(df.limit(0)).collect() == []


def test_registered_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    assert result(queries.op11_embedding_near_dedup(spark, folder)) == brute(rows)
