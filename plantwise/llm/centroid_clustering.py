"""Centroid clustering (operator 13) by scalar lookup tables.

Vectors are turned into integers once and written.  In every round a task
tabulates, for each dimension, the squared difference between the integers that
occur in its batch and the centroids; the distance of a vector is then a sum of
table rows picked by its integers, with no arithmetic per vector beyond that
sum.  All arithmetic is on integers, so results don't depend on how rows are
dealt out.  A round is one scan of the written table: a task gives the sums of
its vectors per cluster, ``clusters * dims`` numbers, which are all that is
shuffled or sent to the driver.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantwise.llm.common import Stages

DIMS, CLUSTERS, ROUNDS, SCALE, SEED = 64, 8, 10, 1024, 3
#: Vectors whose tables a task builds at a time.
STEP = 4096
#: Integers beyond this, where a distance may not fit a long, are an error.
LARGEST = 1 << 27


def integers(vectors: DataFrame, dims: int = DIMS, scale: int = SCALE, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``vec_id, ints`` of the vectors with ``dims`` finite components; an
    integer beyond ``LARGEST`` is null."""
    src = vectors.select(F.col(id_col).alias("vec_id"), F.col(vec_col).cast("array<double>").alias("x"))
    src = src.filter((F.size("x") == dims) & F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))))
    return src.select("vec_id", F.transform("x", lambda v: F.when(F.abs(v) < LARGEST / scale, F.floor(v * scale).cast("int"))).alias("ints"))


def occurring(column: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(values that occur, place of every entry's value among them)."""
    low = int(column.min())
    span = int(column.max()) - low + 1
    if span > 4 * len(column) + 1024:
        return np.unique(column, return_inverse=True)
    present = np.zeros(span, bool)
    present[column - low] = True
    return np.flatnonzero(present) + low, (np.cumsum(present) - 1)[column - low]


def nearest(ints: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the nearest centroid, the smaller of equals; squared distance)."""
    total = np.zeros((len(ints), len(centroids)), np.int64)
    for d in range(ints.shape[1]):
        values, code = occurring(ints[:, d])
        table = (values[:, None] - centroids[None, :, d]) ** 2
        total += table[code]
    cluster = total.argmin(axis=1)
    return cluster, total[np.arange(len(ints)), cluster]


def _steps(batches, dims):
    for batch in batches:
        for a in range(0, batch.num_rows, STEP):
            part = batch.slice(a, STEP)
            yield part, part.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)


def _cluster_sums(table: DataFrame, centroids: np.ndarray) -> dict[int, tuple[int, dict[int, int]]]:
    """Cluster -> (vectors, dimension -> sum) of the non-empty clusters."""
    k, dims = centroids.shape

    def run(batches):
        n, sums = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for _, ints in _steps(batches, dims):
            cluster, _ = nearest(ints, centroids)
            n += np.bincount(cluster, minlength=k)
            np.add.at(sums, cluster, ints)
        some = np.flatnonzero(n)
        if len(some):
            at = np.repeat(some, dims)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(np.tile(np.arange(dims), len(some)), pa.int32()), pa.array(n[at]), pa.array(sums[some].ravel())],
                                             names=["cluster", "dim", "n", "s"])

    rows = table.mapInArrow(run, "cluster int, dim int, n long, s long")
    total = rows.groupBy("cluster", "dim").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
    out: dict[int, tuple[int, dict[int, int]]] = {}
    for r in total:
        out.setdefault(r.cluster, (int(r.n), {}))[1][r.dim] = int(r.s)
    return out


def centroid_clustering(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE, seed: int = SEED,
                        id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256``
    of every vector of exactly ``dims`` components, none null or non-finite;
    other rows are left out.

    Components become ``floor(scale * x)``.  The starts are the vectors whose
    lowercase-hex sha256 of ``<seed>:<vec_id>`` is least, of equal ids that with
    the least integers first; null ids are clustered but never start.  Fewer
    vectors than ``clusters`` give fewer clusters.  A vector at equal distances
    goes to the smaller number; a centroid is replaced by the floor of its
    vectors' mean, an empty one stays.  Repeated rows are separate vectors; an
    empty table gives no rows; other columns are ignored.  Integers beyond
    ``LARGEST`` raise ``ArithmeticError``: their distances don't fit a long.
    """
    stages = Stages(vectors.sparkSession, "centroid-clustering")
    table = stages.write(integers(vectors, dims, scale, id_col, vec_col), "integers")
    kind = table.schema["vec_id"]
    if not table.filter(F.exists("ints", lambda v: v.isNull())).isEmpty():
        raise ArithmeticError(f"a component beyond {LARGEST} / {scale}")
    text = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    starts = table.filter("vec_id IS NOT NULL").orderBy(text, "ints").limit(clusters).select("ints").collect()
    if not starts:
        starts = table.orderBy("ints").limit(1).select("ints").collect()  # null ids alone
    schema = T.StructType([kind, T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])
    centroids = np.array([r.ints for r in starts], np.int64).reshape(-1, dims)
    for _ in range(rounds if len(centroids) else 0):
        moved = centroids.copy()
        for c, (n, sums) in _cluster_sums(table, centroids).items():
            moved[c] = [sums[d] // n for d in range(dims)]
        if (moved == centroids).all():
            break  # later rounds would repeat this one
        centroids = moved

    def assign(batches):
        for part, ints in _steps(batches, dims):
            cluster, distance = nearest(ints, centroids)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(cluster, pa.int32()), pa.array(distance)], names=["vec_id", "cluster", "distance"])

    found = stages.write(table.mapInArrow(assign, schema), "assigned")
    stages.drop("integers")
    sums = {r.cluster: int(r.s) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    # One entry a cluster: plain constants.
    per = F.array(*[F.lit(sums.get(c, 0)).cast("long") for c in range(len(digest))]) if digest else F.array(F.lit(0).cast("long"))
    names = F.array(*map(F.lit, digest)) if digest else F.array(F.lit(""))
    return found.select("vec_id", "cluster", "distance", F.get(per, F.col("cluster")).alias("cluster_inertia"),
                        F.lit(sum(sums.values())).cast("long").alias("inertia"), F.get(names, F.col("cluster")).alias("centroid_sha256"))


def _oracle() -> str:
    """The same rows by DuckDB: a link of the chain a round."""
    dist = "list_sum(list_transform(range(1, {d} + 1), lambda i: (v.x[i] - c.x[i]) * (v.x[i] - c.x[i])))::BIGINT".format(d=DIMS)
    near = "SELECT vec_id, x, c, d FROM (SELECT v.vec_id, v.r, v.x, c.c, {dist} AS d, row_number() OVER (PARTITION BY v.r ORDER BY {dist}, c.c) AS k FROM v, c{k} c) WHERE k = 1"
    parts = [f"""WITH v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda y: floor({SCALE} * y::DOUBLE)::BIGINT) AS x FROM embeddings
WHERE len(embedding) = {DIMS} AND len(list_filter(embedding, lambda y: y IS NOT NULL AND isfinite(y::DOUBLE))) = {DIMS}),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id::VARCHAR), x) - 1 AS c, x FROM v WHERE vec_id IS NOT NULL QUALIFY c < {CLUSTERS})"""]
    for k in range(ROUNDS):
        parts.append(f"n{k} AS MATERIALIZED ({near.format(dist=dist, k=k)})")
        parts.append(f"""m{k} AS MATERIALIZED (SELECT c, list(f ORDER BY i) AS x FROM (SELECT c, i, floor(sum(x[i]) / count(*))::BIGINT AS f FROM n{k}, (SELECT unnest(range(1, {DIMS} + 1)) AS i) GROUP BY c, i) GROUP BY c)""")
        parts.append(f"c{k + 1} AS MATERIALIZED (SELECT c.c, coalesce(m.x, c.x) AS x FROM c{k} c LEFT JOIN m{k} m ON m.c = c.c)")
    parts.append(f"f AS MATERIALIZED ({near.format(dist=dist, k=ROUNDS)})")
    return ",\n".join(parts) + f"""
SELECT f.vec_id, f.c::INTEGER AS cluster, f.d AS distance, (sum(f.d) OVER (PARTITION BY f.c))::BIGINT AS cluster_inertia, (sum(f.d) OVER ())::BIGINT AS inertia,
       sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM f JOIN c{ROUNDS} c ON c.c = f.c
"""


ORACLE = _oracle()
