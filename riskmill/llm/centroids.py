"""k-means over integer vectors; the nearest centroid by the threshold algorithm.

Every dimension keeps a sorted list of the centroids' values. A vector walks each list
outward from its own value; a centroid met anywhere gets its exact distance. The values
that the walk stands at bound what any centroid not met yet can have, so the walk ends
when the sum of their squared distances is strictly larger than the best exact one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskmill.functions.durable import take_bounded
from riskmill.llm.common import materialize, plain

SCALE = 1024
#: Components must be smaller than this in integer form, so that a squared distance fits a long.
LARGEST = 1 << 27
#: Vectors that walk at once.
STEP = 4096


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number, squared distance, centroids compared exactly) for each vector; ties take the smaller number.

    Both arrays are int64, (n, dimensions) and (k, dimensions), k at least one.
    """
    many, k = len(vectors), len(centroids)
    order = np.argsort(centroids, axis=0, kind="stable").T
    values = np.take_along_axis(centroids.T, order, axis=1)
    dimensions = np.arange(len(order))
    at = np.stack([np.searchsorted(values[d], vectors[:, d]) for d in dimensions], axis=1) if many else np.zeros(vectors.shape, np.int64)
    below, above = at - 1, at  # next places of the walk to either side
    best, number = np.full(many, np.iinfo(np.int64).max), np.zeros(many, np.int64)
    seen = np.zeros((many, k), bool)
    walking = np.arange(many)
    for _ in range(k):
        x, low, high = vectors[walking], below[walking], above[walking]
        left = np.where(low >= 0, x - values[dimensions, np.maximum(low, 0)], np.iinfo(np.int32).max)
        right = np.where(high < k, values[dimensions, np.minimum(high, k - 1)] - x, np.iinfo(np.int32).max)
        down = left <= right
        met = order[dimensions, np.where(down, low, high)]
        fresh = np.zeros((len(walking), k), bool)
        np.put_along_axis(fresh, met, True, axis=1)
        fresh &= ~seen[walking]
        for c in np.flatnonzero(fresh.any(axis=0)):
            rows = np.flatnonzero(fresh[:, c])
            exact = ((x[rows] - centroids[c]) ** 2).sum(axis=1)
            own = walking[rows]
            better = (exact < best[own]) | ((exact == best[own]) & (c < number[own]))
            best[own[better]], number[own[better]] = exact[better], c
        seen[walking] |= fresh
        below[walking], above[walking] = np.where(down, low - 1, low), np.where(down, high, high + 1)
        bound = (np.minimum(left, right) ** 2).sum(axis=1)
        walking = walking[bound <= best[walking]]
        if not len(walking):
            break
    return number, best, seen.sum(axis=1)


def _vectors(column: pa.Array) -> np.ndarray:
    dense = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return dense.reshape(len(column), -1)


def _assign(batches: Iterator[pa.RecordBatch], centroids: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, STEP):
            part = batch.slice(at, STEP)
            number, distance, _ = nearest(_vectors(part.column(1)), centroids)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(number.astype(np.int32)), pa.array(distance)], ["vec_id", "cluster", "distance"])


def _sums(batches: Iterator[pa.RecordBatch], centroids: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(cluster, n, sums) of the rows of one task, one row for each cluster."""
    total, count = np.zeros(centroids.shape, np.int64), np.zeros(len(centroids), np.int64)
    for batch in batches:
        for at in range(0, batch.num_rows, STEP):
            vectors = _vectors(batch.slice(at, STEP).column(0))
            number, _, _ = nearest(vectors, centroids)
            for c in np.unique(number):
                own = vectors[number == c]
                total[c] += own.sum(axis=0)
                count[c] += len(own)
    held = np.flatnonzero(count)
    yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(count[held]), pa.array(total[held].tolist(), pa.list_(pa.int64()))], ["cluster", "n", "sums"])


def kept_vectors(rows: DataFrame, dimensions: int = 64, scale: int = SCALE) -> DataFrame:
    """(vec_id, vector): rows with exactly so many components, none null or non-finite, as integers floor(scale * x).

    Null vectors, other lengths, nulls, NaN and infinities are left out. A component too large for
    exact distances (``LARGEST``) is an error, since its distance would not fit a long.
    """
    x = F.transform("embedding", lambda v: v.cast("double"))
    fine = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf")))
    kept = plain(rows, "vec_id", "embedding").filter((F.size("embedding") == dimensions) & F.forall(x, fine))
    small = lambda v: F.when(F.abs(v * scale) < LARGEST, F.floor(v * scale).cast("int")).otherwise(F.raise_error(F.lit("a component is too large for exact distances")).cast("int"))
    return kept.select("vec_id", F.transform(x, small).alias("vector"))


def first_centroids(vectors: DataFrame, k: int, salt: str) -> np.ndarray:
    """The k vectors with the smallest SHA-256 of ``salt:vec_id``; of repeated ids the smaller vector first, null ids last."""
    mark = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    rows = vectors.select(mark.alias("mark"), "vector").orderBy(F.col("mark").asc_nulls_last(), "vector").limit(k)
    return np.array([r.vector for r in take_bounded(rows, k, "centroids")], np.int64)


def cluster_vectors(rows: DataFrame, k: int = 8, rounds: int = 10, dimensions: int = 64, salt: str = "3") -> tuple[DataFrame, np.ndarray]:
    """((vec_id, cluster, distance) of every kept row, final centroids).

    Lloyd's rounds from ``first_centroids``: every vector goes to its nearest centroid, every
    centroid with vectors becomes the floor of their exact mean. The rounds end early only when no
    centroid moved, after which further rounds change nothing. Each round sums up within tasks, so a task
    hands on one row per centroid; k centroids travel to the tasks and their sums to the driver.
    Fewer than k vectors give as many centroids; repeated rows stay rows; no vectors give an empty table.
    """
    vectors = materialize(kept_vectors(rows, dimensions), "vectors")
    centroids = first_centroids(vectors, k, salt)
    for _ in range(rounds if len(centroids) else 0):
        parts = vectors.select("vector").mapInArrow(partial(_sums, centroids=centroids), "cluster int, n bigint, sums array<bigint>")
        parts = parts.select("cluster", "n", F.posexplode("sums").alias("d", "s")).groupBy("cluster", "d")
        moved = centroids.copy()
        for r in take_bounded(parts.agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")), k * dimensions, "sums"):
            moved[r.cluster, r.d] = int(r.s) // r.n
        if (moved == centroids).all():
            break
        centroids = moved
    kind = dict(vectors.dtypes)["vec_id"]
    if not len(centroids):
        return vectors.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), centroids
    found = vectors.mapInArrow(partial(_assign, centroids=centroids), f"vec_id {kind}, cluster int, distance bigint")
    return materialize(found, "clusters"), centroids


def cluster_report(rows: DataFrame) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every kept row of ``rows``.

    See ``kept_vectors`` for the rows left out and ``cluster_vectors`` for ties, repeats and empty tables.
    """
    found, centroids = cluster_vectors(rows)
    marks = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    sums = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s"))
    totals = {r.cluster: int(r.s) for r in take_bounded(sums, max(1, len(marks)), "clusters")}
    clusters = [(i, totals.get(i, 0), sum(totals.values()), mark) for i, mark in enumerate(marks)]
    side = rows.sparkSession.createDataFrame(clusters, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return found.join(F.broadcast(side), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def report_sql(k: int = 8, rounds: int = 10, dimensions: int = 64, salt: str = "3") -> str:
    """The same rows for DuckDB, every distance computed."""
    steps = [f"""v as materialized (
        select row_number() over () as r, vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::double)::bigint) as x from embeddings
        where len(embedding) = {dimensions} and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = {dimensions})""",
        f"c0 as materialized (select row_number() over (order by sha256('{salt}:' || vec_id), x) - 1 as cluster, x as c from v where vec_id is not null"
        f" qualify row_number() over (order by sha256('{salt}:' || vec_id), x) <= {k})"]
    near = lambda i: f"""a{i} as materialized (select r, vec_id, x, min(struct_pack(d := d, cluster := cluster)) as n from (
        select r, vec_id, x, cluster, list_sum(list_transform(list_zip(x, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::bigint as d from v, c{i})
        group by r, vec_id, x)"""  # noqa: E731
    for i in range(rounds):
        steps += [near(i), f"""c{i + 1} as materialized (select cluster, coalesce(m, c) as c from c{i} left join (
            select cluster, list(((s - ((s % n) + n) % n) // n)::bigint order by d) as m from (
                select n.cluster as cluster, d, sum(x[d])::hugeint as s, count(*) as n from a{i}, range(1, {dimensions + 1}) t(d) group by all)
            group by cluster) using (cluster))"""]
    return f"""with {", ".join([*steps, near(rounds)])}
    select vec_id, n.cluster::int as cluster, n.d as distance, (sum(n.d) over (partition by n.cluster))::bigint as cluster_inertia,
      (sum(n.d) over ())::bigint as inertia, sha256(array_to_string(c, ',')) as centroid_sha256
    from a{rounds} join c{rounds} on n.cluster = cluster"""
