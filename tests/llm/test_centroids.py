"""Centroid clustering against brute force."""
from __future__ import annotations

import math
import random
from hashlib import sha256

import numpy as np
import pytest

from barsmith.llm import centroids

COLUMNS = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def brute(data, k, rounds, dim, seed=2):
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v in data
            if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:k]
    c = [v for _, v in first]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, x)), j) for j, x in enumerate(c))

    for _ in range(rounds):
        own = [near(v)[1] for _, v in kept]
        c = [[sum(col) // own.count(j) for col in zip(*(v for (_, v), o in zip(kept, own) if o == j))] if j in own else x for j, x in enumerate(c)]
    got = [(i, *near(v)[::-1]) for i, v in kept]
    total = sum(d for *_, d in got)
    by = [sum(d for _, j, d in got if j == x) for x in range(len(c))]
    return [(i, j, d, by[j], total, sha256(",".join(map(str, c[j])).encode()).hexdigest()) for i, j, d in got]


def vectors(n, dim, seed):
    rnd = random.Random(seed)
    hubs = [[rnd.uniform(-2, 2) for _ in range(dim)] for _ in range(6)]
    data = [(i, [x + rnd.gauss(0, 0.3) for x in rnd.choice(hubs)]) for i in range(n)]
    same = data[3][1]
    data += [(n + i, same) for i in range(n // 2)]  # a third of all vectors
    data += [(1, same), (1, data[0][1]), (None, data[2][1]), (10 ** 6, None), (10 ** 6 + 1, same[:-1]), (10 ** 6 + 2, [*same[:-1], None]),
             (10 ** 6 + 3, [*same[:-1], float("nan")]), (10 ** 6 + 4, [*same[:-1], float("-inf")]), (10 ** 6 + 5, []), (10 ** 6 + 6, [1e5] * dim)]
    return data


def sort(rows):
    return sorted(map(tuple, rows), key=str)


@pytest.mark.parametrize("n, dim, k, rounds", [(200, 8, 12, 5), (30, 4, 40, 3), (60, 64, 7, 0)])
def test_against_brute_force(spark, n, dim, k, rounds):
    data = vectors(n, dim, n)
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>").repartition(4)
    got = centroids.clustered(df, centroids=k, rounds=rounds, dimension=dim)
    assert sort(got.select(*COLUMNS).collect()) == sort(brute(data, k, rounds, dim))


def test_only_changed_components_are_read():
    """A step from known dot products equals the products themselves, and reads
    no component that stayed."""
    import pyarrow as pa

    rnd = np.random.default_rng(1)
    v, old = rnd.integers(-500, 500, (50, 6)), rnd.integers(-500, 500, (4, 6))
    new = old.copy()
    new[1, 2] += 7
    new[3] -= 1
    lists = lambda m: pa.array(m.tolist())
    poison = v.copy()
    poison[:, 5] = 10 ** 6  # wrong where only centroid 3 may look
    batch = pa.RecordBatch.from_arrays([pa.array(range(50)), lists(v).cast(pa.list_(pa.int32())), lists(v @ old.T)], names=["vec_id", "v", "dots"])
    out = next(centroids.stepped(old, new)(iter([batch])))
    assert out.column(2).to_pylist() == (v @ new.T).tolist()
    assert out.column(4).to_pylist() == ((v[:, None] - new[None]) ** 2).sum(axis=2).min(axis=1).tolist()
    batch = pa.RecordBatch.from_arrays([pa.array(range(50)), lists(poison).cast(pa.list_(pa.int32())), lists(v @ old.T)], names=["vec_id", "v", "dots"])
    dots = np.array(next(centroids.stepped(old, new)(iter([batch]))).column(2).to_pylist())
    assert (dots[:, :3] == (v @ new.T)[:, :3]).all() and (dots[:, 3] != (v @ new.T)[:, 3]).all()


def test_tables_of_past_rounds_go(spark):
    import os

    from barsmith.session import ensure_checkpoint_dir
    folder = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    centroids.clustered(spark.createDataFrame(vectors(40, 4, 1), "vec_id long, embedding array<float>"), centroids=5, dimension=4).count()
    assert len([n for n in set(os.listdir(folder)) - before if n.startswith("distances-")]) == 1


def test_edges(spark):
    kind = "vec_id string, embedding array<double>, v string, cluster string, dots string, distance string"
    assert centroids.clustered(spark.createDataFrame([], kind)).count() == 0
    assert centroids.clustered(spark.createDataFrame([("a", None, "v", "c", "d", "x")], kind)).count() == 0
    one = centroids.clustered(spark.createDataFrame([("a", [0.5] * 64, "v", "c", "d", "x")] * 2, kind)).collect()
    assert [(r.vec_id, r.cluster, r.distance) for r in one] == [("a", 0, 0)] * 2
    with pytest.raises(Exception, match="too large"):
        centroids.clustered(spark.createDataFrame([("a", [1e300] * 64, "v", "c", "d", "x")], kind)).count()
