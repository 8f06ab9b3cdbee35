"""Centroid clustering (Lloyd's rounds) over an incremental distance matrix.

Components are integers, so all sums and products are exact and no result hangs
on the order of adding.

Matrix.  Each vector's dot product with every centroid is kept beside it, in a
table that is written once a round.  When centroids have moved, a dot product
changes by the vector times the change, so only the components of a centroid
that did change are read; a centroid that stayed costs nothing.  The squared
distance is |v|^2 - 2 v.c + |c|^2, and the nearest centroid the first least one.

Centroids.  A task adds up its vectors per centroid and sends a row for each,
so what is shuffled is tasks * centroids rows whatever the data, and the driver
gets one row a centroid.  A cluster that holds a third of all vectors (or one
vector repeated) is no heavier than another.

Lost executors cost one round at most, as each round's table lies in the shared
folder; the one before is deleted when it is no longer read.

Defined results: vectors of another length and those with a null, NaN or
infinite component are left out; a component beyond ``LARGEST`` in units of
1 / ``SCALE`` has no distance that fits a long, and stops the run with that
message; a null id hashes as an empty one and repeated rows are vectors of their
own; vectors whose ids hash alike come in the order of their components; fewer
vectors than centroids make as many centroids as vectors; an empty table gives an
empty one.  Only the named columns are read, so others cannot clash.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barsmith.llm.common import forget, written

SCALE, LARGEST = 256, 1 << 27
DIMENSION, CENTROIDS, ROUNDS, SEED = 64, 40, 5, 2


def quantised(df: DataFrame, vec_id: str, vector: str, dimension: int) -> DataFrame:
    """(vec_id, v) of the vectors that count, v as integers."""
    rows = df.select(F.col(f"`{vec_id}`").alias("vec_id"), F.col(f"`{vector}`").cast("array<double>").alias("x"))
    rows = rows.where(f"size(x) = {dimension} AND NOT exists(x, c -> c IS NULL OR isnan(c) OR abs(c) = double('infinity'))")
    return rows.select("vec_id", F.expr(f"""
        IF(exists(x, c -> abs({SCALE} * c) > {LARGEST}), raise_error('a component is too large for a squared distance that fits a long'),
           transform(x, c -> cast(floor({SCALE} * c) AS int)))""").cast("array<int>").alias("v"))


def matrix(column: pa.Array) -> np.ndarray:
    """Lists of one length as the rows of a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), -1)


def stepped(old: np.ndarray, new: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The state's rows after the centroids moved from ``old`` to ``new``."""
    change = new - old
    moved = [(j, at) for j in range(len(new)) if len(at := np.flatnonzero(change[j]))]
    square = (new * new).sum(axis=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            v, dots = matrix(batch.column(1)), matrix(batch.column(2))
            for j, at in moved:
                dots[:, j] += v[:, at] @ change[j, at]
            apart = square - 2 * dots
            cluster = apart.argmin(axis=1)
            distance = apart[np.arange(len(v)), cluster] + (v * v).sum(axis=1)
            offsets = pa.array(np.arange(len(v) + 1) * dots.shape[1], pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.ListArray.from_arrays(offsets, pa.array(dots.reshape(-1))),
                                              pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())],
                                             names=["vec_id", "v", "dots", "cluster", "distance"])

    return run


def added(k: int, dimension: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task's (v, cluster, distance) -> a row for each cluster it has met."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, n, apart = np.zeros((k, dimension), np.int64), np.zeros(k, np.int64), np.zeros(k, np.int64)
        for batch in batches:
            if not len(batch):
                continue
            cluster = batch.column(1).to_numpy()
            order = np.argsort(cluster, kind="stable")
            which, first = np.unique(cluster[order], return_index=True)
            sums[which] += np.add.reduceat(matrix(batch.column(0))[order], first, axis=0)
            apart[which] += np.add.reduceat(batch.column(2).to_numpy()[order], first)
            n += np.bincount(cluster, minlength=k)
        met = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(met, pa.int32()), pa.array(n[met]), pa.array(apart[met]), pa.array(sums[met].tolist(), pa.list_(pa.int64()))],
                                         names=["cluster", "n", "distance", "sums"])

    return run


def per_cluster(state: DataFrame, k: int, dimension: int) -> dict[int, tuple[int, int, list[int]]]:
    """{cluster: (vectors, distance, sum of each component)}: k rows at most."""
    kind = T.StructType([T.StructField("cluster", T.IntegerType()), T.StructField("n", T.LongType()), T.StructField("distance", T.LongType()),
                         T.StructField("sums", T.ArrayType(T.LongType()))])
    exact = lambda c: F.sum(c.cast("decimal(38,0)"))
    rows = (state.select("v", "cluster", "distance").mapInArrow(added(k, dimension), kind)
            .groupBy("cluster").agg(F.sum("n"), exact(F.col("distance")), *[exact(F.col("sums")[i]) for i in range(dimension)]).collect())
    return {r[0]: (r[1], int(r[2]), [int(x) for x in r[3:]]) for r in rows}


def clustered(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", centroids: int = CENTROIDS, rounds: int = ROUNDS,
              seed: int = SEED, dimension: int = DIMENSION) -> DataFrame:
    """(vec_id, v, cluster, distance, cluster_inertia, inertia, centroid_sha256)
    of every vector that counts; ``v`` are its integer components."""
    spark = df.sparkSession
    kept = quantised(df, vec_id, vector, dimension)
    by = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    now = np.array([r.v for r in kept.orderBy(by, "v").limit(centroids).collect()], np.int64).reshape(-1, dimension)
    k = len(now)
    kind = T.StructType([T.StructField("vec_id", df.schema[vec_id].dataType), T.StructField("v", T.ArrayType(T.IntegerType())),
                         T.StructField("dots", T.ArrayType(T.LongType())), T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])
    state, before = kept.withColumn("dots", F.array_repeat(F.lit(0).cast("long"), k)), np.zeros_like(now)
    for turn in range(rounds + 1 if k else 0):
        held = state
        state = written(held.select("vec_id", "v", "dots").mapInArrow(stepped(before, now), kind), "distances")
        if turn:
            forget(held)
        found = per_cluster(state, k, dimension)
        before = now
        if turn < rounds:
            now = np.array([[x // found[j][0] for x in found[j][2]] if j in found else now[j] for j in range(k)], np.int64)
    if not k:
        state, found = spark.createDataFrame([], kind), {}
    total = sum(apart for _, apart, _ in found.values())
    names = [(j, apart, total, sha256(",".join(map(str, now[j].tolist())).encode()).hexdigest()) for j, (_, apart, _) in sorted(found.items())]
    named = spark.createDataFrame(names, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    # a row a centroid
    return state.drop("dots").join(F.broadcast(named), "cluster").select("vec_id", "v", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def q_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustered(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")).drop("v")


def _sql() -> str:
    """The same rounds as relations of (vector, component) and (centroid, component)."""
    out = [f"""
WITH kept AS (
  SELECT vec_id, [floor({SCALE} * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
  WHERE len(embedding) = {DIMENSION} AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
),
parts AS (SELECT vec_id, generate_subscripts(v, 1) AS i, unnest(v) AS x FROM kept),
c0 AS MATERIALIZED (
  SELECT c, generate_subscripts(v, 1) AS i, unnest(v) AS x FROM (
    SELECT row_number() OVER (ORDER BY h) - 1 AS c, v FROM (SELECT v, sha256('{SEED}:' || vec_id) AS h FROM kept) ORDER BY h LIMIT {CENTROIDS})
)"""]
    for r in range(ROUNDS + 1):
        out.append(f"""
a{r} AS MATERIALIZED (
  SELECT vec_id, arg_min(c, (d, c)) AS c, min(d)::BIGINT AS d FROM (
    SELECT vec_id, c, sum((p.x - q.x) * (p.x - q.x)) AS d FROM parts p JOIN c{r} q USING (i) GROUP BY 1, 2) GROUP BY 1
)""")
        if r < ROUNDS:
            out.append(f"""
c{r + 1} AS MATERIALIZED (
  SELECT o.c, o.i, coalesce(m.x, o.x) AS x FROM c{r} o LEFT JOIN (
    SELECT c, i, ((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS x FROM parts JOIN a{r} USING (vec_id) GROUP BY 1, 2) m USING (c, i)
)""")
    return ",".join(out) + f"""
SELECT vec_id, c::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia, centroid_sha256
FROM a{ROUNDS} JOIN (SELECT c, sha256(string_agg(x::VARCHAR, ',' ORDER BY i)) AS centroid_sha256 FROM c{ROUNDS} GROUP BY 1) USING (c)
"""


SQL_CENTROIDS = _sql()
