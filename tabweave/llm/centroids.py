"""Centroid clustering of integer vectors by exact rounds with Yinyang bounds.

Centroids are put into groups once, at the start. Every vector carries an upper bound on the distance to its own
centroid and, for each group, a lower bound on the distances to the group's other centroids. After each update
the bounds move by what the centroids moved; a vector whose upper bound is below all its lower bounds keeps its
centroid unseen (global filter), one that is not looks only at the groups whose bound its own distance, now
exact, reaches (group filter), and there at the centroids that their own movement may have brought near; these
are scanned exactly. Distances are compared as whole numbers; bounds are floating point and widened by `SLACK`, so
that a tie is always scanned. Results are those of scanning everything.

A round is one pass over the stored vectors, which writes them with their new bounds, and one sum over the vectors
that changed their centroid, added up in each task before it is exchanged. The driver holds k centroids and k sums.

Edge cases: vectors that are null, of another length or hold null or non-finite components are left out; fewer
vectors than k give as many centroids; rows that repeat count each; a row without an id is clustered, but comes
last when the first centroids are chosen; ties of distance go to the smaller number; an empty table gives no rows. Components so large
that a distance may not fit into a long raise an error.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabweave.llm.common import released, stored, table

K, ROUNDS, DIM, SCALE = 8, 10, 64, 1024
SLACK, FAR, CELLS = 1 + 1e-12, np.iinfo(np.int64).max, 1 << 21
STATE = "vec_id {id}, x array<long>, was int, cluster int, upper double, lower array<double>"


def whole(vector: Column, dim: int = DIM, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component, null for a vector that is not kept."""
    kept = (F.size(vector) == dim) & ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(F.coalesce(kept, F.lit(False)), F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double"))))


def grouped(centroids: np.ndarray, groups: int) -> np.ndarray:
    """The group of each centroid: a few rounds of plain k-means among them."""
    at = centroids.astype(float)
    centres = at[:: max(1, len(at) // groups)][:groups].copy()
    for _ in range(5):
        group = ((at[:, None, :] - centres[None, :, :]) ** 2).sum(axis=2).argmin(axis=1)
        for g in range(len(centres)):
            if (group == g).any():
                centres[g] = at[group == g].mean(axis=0)
    return np.unique(group, return_inverse=True)[1]


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows of whole numbers."""
    d = x - y
    return np.einsum("ij,ij->i", d, d)


class Step:
    """An assignment to these centroids, which moved by `drift` since the bounds were set."""

    def __init__(self, centroids: np.ndarray, drift: np.ndarray, group: np.ndarray) -> None:
        self.centroids, self.drift, self.group = centroids, drift, group
        self.members = [np.flatnonzero(group == g) for g in range(int(group.max()) + 1)]
        self.most = np.array([drift[m].max() for m in self.members])
        self.limit = math.isqrt(FAR // centroids.shape[1]) // 2
        self.scanned = 0

    def assign(self, x: np.ndarray, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """New clusters and bounds. A cluster of -1 stands for none yet."""
        if len(x) and max(-int(x.min()), int(x.max())) > self.limit:
            raise ValueError(f"components beyond {self.limit} have no exact distances")
        rows = max(1, CELLS // max(self.centroids.shape))
        done = [self._slice(*(a[i:i + rows] for a in (x, cluster, upper, lower))) for i in range(0, len(x), rows)]
        return tuple(np.concatenate(a) for a in zip(*done, strict=True)) if done else (cluster, upper, lower)

    def _slice(self, x: np.ndarray, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        k, new = len(self.centroids), cluster < 0
        upper, cluster, before = np.where(new, np.inf, upper + self.drift[cluster]) * SLACK, cluster.copy(), lower
        lower = np.maximum(lower - self.most, 0)
        at = np.flatnonzero(upper >= lower.min(axis=1))
        own = np.where(new[at], FAR, squared(x[at], self.centroids[cluster[at]]))
        upper[at] = np.where(new[at], np.inf, np.sqrt(own.astype(float)) * SLACK)
        open_ = upper[at] >= lower[at].min(axis=1)
        at, own = at[open_], own[open_]
        mine, up, low = cluster[at], upper[at], lower[at]
        best, name = own.copy(), np.where(mine < 0, k, mine)
        bound = low[:, self.group].copy()
        for g, members in enumerate(self.members):
            near = np.flatnonzero(up >= low[:, g])
            for c in members:
                own_bound = before[at[near], g] - self.drift[c]
                bound[near, c] = np.maximum(bound[near, c], own_bound)
                to = near[(mine[near] != c) & (up[near] >= own_bound)]
                d = squared(x[at[to]], self.centroids[c])
                self.scanned += len(to)
                bound[to, c] = np.sqrt(d.astype(float)) / SLACK
                better = (d < best[to]) | ((d == best[to]) & (c < name[to]))
                best[to[better]], name[to[better]] = d[better], c
        had = np.flatnonzero(mine >= 0)
        bound[had, mine[had]] = np.sqrt(own[had].astype(float)) / SLACK
        bound[np.arange(len(at)), name] = np.inf
        cluster[at], upper[at] = name, np.sqrt(best.astype(float)) * SLACK
        lower[at] = np.stack([bound[:, m].min(axis=1) for m in self.members], axis=1)
        return cluster, upper, lower


def _matrix(column: pa.ListArray, n: int, kind: type) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(n, -1) if n else np.zeros((0, 1), dtype=kind)


def _stepped(step: Step, last: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            x, was = _matrix(batch.column(1), n, np.int64), batch.column(3).to_numpy()
            cluster, upper, lower = step.assign(x, was, batch.column(4).to_numpy(), _matrix(batch.column(5), n, float))
            if last:
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cluster, pa.int32()), pa.array(squared(x, step.centroids[cluster]))], ["vec_id", "cluster", "distance"])
            else:
                bounds = pa.ListArray.from_arrays(np.arange(0, lower.size + 1, lower.shape[1], dtype=np.int32), lower.ravel())
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(was, pa.int32()), pa.array(cluster, pa.int32()), pa.array(upper), bounds], ["vec_id", "x", "was", "cluster", "upper", "lower"])
    return run


def _summed(k: int, dim: int):
    """Per task: what the vectors that changed add to the sums of their new centroids and take from the old ones', last the count."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((k, dim + 1), dtype=np.int64)
        for batch in batches:
            x = np.column_stack([_matrix(batch.column(2), batch.num_rows, np.int64), np.ones(batch.num_rows, dtype=np.int64)]) if batch.num_rows else sums[:0]
            was, cluster = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for c in range(k):
                sums[c] += x[cluster == c].sum(axis=0) - x[was == c].sum(axis=0)
        c, p = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32()), pa.array(p, pa.int32()), pa.array(sums[c, p])], ["cluster", "place", "total"])
    return run


def clustered(rows: DataFrame, k: int = K, rounds: int = ROUNDS, dim: int = DIM, scale: int = SCALE, salt: str = "3", groups: int | None = None) -> tuple[DataFrame, np.ndarray]:
    """rows: vec_id, embedding. Returns per kept vector vec_id, cluster and distance (squared), and the centroids. The first centroids are the vectors with
    the smallest hashes of their ids; groups: how many of centroids there are, a third of them if not given."""
    kept = rows.select("vec_id", whole(F.col("embedding"), dim, scale).alias("x")).where("x IS NOT NULL")
    first = kept.select("x", F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")), 256).alias("h")).orderBy(F.asc_nulls_last("h"), "x").limit(k).collect()
    kind = dict(rows.dtypes)["vec_id"]
    if not first:
        return rows.sparkSession.createDataFrame([], f"vec_id {kind}, cluster int, distance long"), np.zeros((0, dim), dtype=np.int64)
    centroids = np.array([r.x for r in first], dtype=np.int64)
    k = len(centroids)
    group = grouped(centroids, min(groups or -(-k // 3), k))
    sums, drift = np.zeros((k, dim + 1), dtype=object), np.zeros(k)
    unseen = kept.select("*", F.lit(-1).alias("was"), F.lit(-1).alias("cluster"), F.lit(0.0).alias("upper"), F.array_repeat(F.lit(0.0), int(group.max()) + 1).alias("lower"))
    state = stored(unseen, "vectors")
    for _ in range(rounds):
        before, state = state, stored(state.mapInArrow(_stepped(Step(centroids, drift, group), False), STATE.format(id=kind)), "vectors")
        released(before)
        changed = state.where("was <> cluster").select("was", "cluster", "x").mapInArrow(_summed(k, dim), "cluster int, place int, total long")
        for r in changed.groupBy("cluster", "place").agg(F.sum("total").alias("total")).collect():
            sums[r.cluster, r.place] += r.total
        new = np.array([[int(s) // int(row[dim]) for s in row[:dim]] if row[dim] else centroids[c].tolist() for c, row in enumerate(sums)], dtype=np.int64)
        drift = np.sqrt(squared(new, centroids).astype(float)) * SLACK
        centroids = new
        if not drift.any():  # nothing moves any more
            break
    return state.mapInArrow(_stepped(Step(centroids, drift, group), True), f"vec_id {kind}, cluster int, distance long"), centroids


def op13_yinyang(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, centroids = clustered(table(spark, sf_dir, "embeddings"))
    found = stored(found, "clusters")
    named = [(c, hashlib.sha256(",".join(map(str, row.tolist())).encode()).hexdigest()) for c, row in enumerate(centroids)]
    totals = found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")).collect()  # as many rows as centroids
    every = sum(r.cluster_inertia for r in totals)
    hashes = dict(named)
    about = spark.createDataFrame([(r.cluster, r.cluster_inertia, every, hashes[r.cluster]) for r in totals], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(about), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _sql(k: int = K, rounds: int = ROUNDS) -> str:
    near = "(SELECT v.r, min({{'d': CAST(list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT), 'c': c.c}}) AS m FROM v, c{0} c GROUP BY v.r)"
    out = f"""WITH v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, x) - 1 AS c, x FROM (SELECT sha256('3:' || vec_id) AS h, x FROM v ORDER BY h, x LIMIT {k}))"""
    for i in range(rounds):
        out += f""",
a{i} AS MATERIALIZED {near.format(i)},
c{i + 1} AS MATERIALIZED (SELECT c.c, coalesce(u.x, c.x) AS x FROM c{i} c LEFT JOIN (SELECT k, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY p) AS x FROM
  (SELECT k, p, sum(e) AS s, count(*) AS n FROM (SELECT a.m.c AS k, unnest(v.x) AS e, unnest(range(64)) AS p FROM v JOIN a{i} a ON a.r = v.r) GROUP BY k, p) GROUP BY k) u ON u.k = c.c)"""
    return out + f""",
z AS MATERIALIZED {near.format(rounds)}
SELECT v.vec_id, CAST(z.m.c AS INT) AS cluster, z.m.d AS distance, CAST(sum(z.m.d) OVER (PARTITION BY z.m.c) AS BIGINT) AS cluster_inertia, CAST(sum(z.m.d) OVER () AS BIGINT) AS inertia,
sha256(list_aggregate(list_transform(c.x, lambda e: CAST(e AS VARCHAR)), 'string_agg', ',')) AS centroid_sha256 FROM v JOIN z ON z.r = v.r JOIN c{rounds} c ON c.c = z.m.c
"""


OP13_SQL = _sql()
