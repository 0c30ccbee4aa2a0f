import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from opinlake.llm import centroid_clusters as cc

SCHEMA = "vec_id long, embedding array<float>"


def expected(rows, k=16, rounds=3):
    """Plain Python: every vector against every centroid."""
    kept = [
        (i, [math.floor(64 * x) for x in v])
        for i, v in rows
        if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)
    ]
    named = [(hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None]
    centroids = [v for _, v in sorted(named)[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for n, members in groups.items():
            centroids[n] = [sum(x) // len(members) for x in zip(*members, strict=True)]
    out = [(i, *nearest(v)[::-1]) for i, v in kept]
    inertia = sum(d for _, _, d in out)
    own = {n: sum(d for _, c, d in out if c == n) for n in range(len(centroids))}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, c, d, own[c], inertia, digest[c]) for i, c, d in out), key=repr)


def as_floats(rows):
    return [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]


@pytest.fixture(scope="module")
def vectors():
    rnd = random.Random(11)
    middles = [[rnd.uniform(-1, 1) for _ in range(64)] for _ in range(9)]
    rows = [(k, [m + rnd.gauss(0, 0.1) for m in middles[k % 9]]) for k in range(300)]
    rows += [(1000 + k, [0.25] * 64) for k in range(40)]  # many equal ones
    rows += [(2000, None), (2001, []), (2002, [0.5] * 63), (2003, [0.5] * 65), (2004, [0.5] * 63 + [None])]
    rows += [(2005, [0.5] * 63 + [float("nan")]), (2006, [float("inf")] + [0.5] * 63), (2007, [-0.001] * 64)]
    rows += [(5, [0.1] * 64), (5, [0.1] * 64), (None, [0.3] * 64), (None, None), (2008, [300.0, -300.0] * 32)]
    return as_floats(rows)


def test_equals_comparing_all(spark, vectors, rows_of):
    frame = spark.createDataFrame(vectors, SCHEMA).repartition(5)
    for name in ("cluster", "distance", "vector", "digest", "number", "place", "n"):
        frame = frame.withColumn(name, F.lit("x"))
    assert rows_of(cc.clusters(frame, cc.fit(frame))) == expected(vectors)


def test_few_and_no_vectors(spark, rows_of):
    rows = as_floats([(k, [k / 7] * 64) for k in range(5)] + [(9, [0.0] * 64), (9, [1.0] * 64)])
    frame = spark.createDataFrame(rows, SCHEMA)
    assert rows_of(cc.clusters(frame, cc.fit(frame))) == expected(rows)
    empty = frame.limit(0)
    assert cc.clusters(empty, cc.fit(empty)).count() == 0
    unusable = spark.createDataFrame([(1, None), (2, [1.0])], SCHEMA)
    assert cc.clusters(unusable, cc.fit(unusable)).count() == 0


def test_ties_go_to_the_smaller_number():
    centroids = cc.Centroids(np.array([[4] * 4, [0] * 4, [4] * 4, [2, 0, 0, 0]]))
    found, best, _ = centroids.nearest(np.array([[2] * 4, [4] * 4, [1, 0, 0, 0]]))
    assert found.tolist() == [3, 0, 1] and best.tolist() == [12, 0, 1]


@pytest.mark.parametrize("spread", [3, 4000, 1 << 23])
def test_search_is_exact_and_skips(spread):
    rnd = np.random.default_rng(3)
    rows = rnd.integers(-spread, spread, (200, 64)) + rnd.integers(-spread, spread, (200, 1))
    vectors = rnd.integers(-spread, spread, (500, 64)) + rnd.integers(-spread, spread, (500, 1))
    found, best, worked = cc.Centroids(rows).nearest(vectors)
    full = ((vectors[:, None, :] - rows[None]) ** 2).sum(axis=2)
    assert (best == full.min(axis=1)).all() and (found == full.argmin(axis=1)).all()
    assert worked < 0.7 * full.size


def test_components_out_of_bounds_are_an_error():
    import pyarrow as pa

    with pytest.raises(ValueError, match="beyond"):
        cc.in_integers(pa.array([[1e9] * 64]), 64, 64)

