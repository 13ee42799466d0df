"""Near-duplicate vectors by spherical-cap filters.

Filter directions are the products of small random codes on the blocks of a structured random rotation
(signs and Hadamard transforms, twice). A vector is list-decoded to the `FILTERS` directions nearest to it, so
that its caps are as high as it takes and no vector is without filters at any size; vectors are joined on
filters and each pair is verified by its cosine in double precision, in the first filter it shares. The number
of directions follows the number of vectors, so that a filter keeps about `BUCKET` of random ones.

Large filters (groups of near copies) are cut into chunks, and pairs of chunks are compared apart, so no
task holds more than two chunks and none of the pairs is lost. Tasks return link counts and spanning
trees, never the pairs.

Edge cases: vectors that are null, empty, zero or hold null or non-finite components link with nothing,
nor do rows without an id; vectors of other lengths are compared among themselves; equal vectors are one
node with a count; an empty table gives no rows. The method is approximate: a pair at the threshold is
missed if it shares no filter (measured in the tests and the README).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabweave.llm.common import stored, table
from tabweave.llm.components import components

THRESHOLD, BUCKET, FILTERS, CHUNK, SEED, ROWS = 0.95, 256, 24, 512, 11, 512


class Code:
    """The filters for vectors of one length: `parts` codes of `words` directions each, and how many a vector is in."""

    def __init__(self, dim: int, n: int, filters: int = FILTERS, bucket: int = BUCKET, seed: int = SEED) -> None:
        share = min(bucket / max(n, 1), 0.05)
        self.filters = filters
        self.size = 1 << max(4, (max(dim, 2) - 1).bit_length())  # short vectors are padded
        self.parts = 1
        while self.parts < 4 and (filters / share) ** (1 / self.parts) > 2048 and self.size >> self.parts >= 2:
            self.parts += 1
        self.parts = max(2, self.parts)
        self.words = int(np.ceil((filters / share) ** (1 / self.parts)))
        rng = np.random.default_rng([seed, dim])
        self.signs = rng.choice([-1.0, 1.0], (2, self.size))
        codes = rng.standard_normal((self.parts, self.words, self.size // self.parts if self.parts in (2, 4) else -(-self.size // self.parts)))
        self.codes = codes / np.linalg.norm(codes, axis=2, keepdims=True)

    def rotate(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros((len(x), self.size))
        out[:, : x.shape[1]] = x
        for signs in self.signs:
            out *= signs
            step = 1
            while step < self.size:
                view = out.reshape(len(x), -1, 2, step)
                view[:, :, 0], view[:, :, 1] = view[:, :, 0] + view[:, :, 1], view[:, :, 0] - view[:, :, 1]
                step *= 2
            out /= np.sqrt(self.size)
        return out

    def decode(self, x: np.ndarray) -> list[np.ndarray]:
        """For each unit vector the numbers of its nearest filters, ascending."""
        return [found for i in range(0, len(x), ROWS) for found in self._nearest(x[i:i + ROWS])]

    def _nearest(self, x: np.ndarray) -> np.ndarray:
        """The best sums over the first blocks are among the best over one block less, each with the best of its own block."""
        y, width = self.rotate(x), self.codes.shape[2]
        y = np.pad(y, ((0, 0), (0, width * self.parts - self.size)))
        number, total = np.zeros((len(x), 1), dtype=np.int64), np.zeros((len(x), 1))
        for p in range(self.parts):
            scores = y[:, p * width:(p + 1) * width] @ self.codes[p].T
            own = self._best(scores)
            sums = (total[:, :, None] + np.take_along_axis(scores, own, 1)[:, None, :]).reshape(len(x), -1)
            numbers = (number[:, :, None] * self.words + own[:, None, :]).reshape(len(x), -1)
            at = self._best(sums)
            number, total = np.take_along_axis(numbers, at, 1), np.take_along_axis(sums, at, 1)
        return np.sort(number, axis=1)

    def _best(self, scores: np.ndarray) -> np.ndarray:
        k = min(self.filters, scores.shape[1])
        return np.argpartition(-scores, k - 1, axis=1)[:, :k]


def _decode(n: int, filters: int, bucket: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes: dict[int, Code] = {}
        for batch in batches:
            ids, vectors = batch.column(0), batch.column(2).to_pylist()
            found: list = [None] * len(vectors)
            for dim in {len(v) for v in vectors}:
                at = [i for i, v in enumerate(vectors) if len(v) == dim]
                x = np.array([vectors[i] for i in at], dtype=np.float64)
                code = codes.setdefault(dim, None) or codes.__setitem__(dim, Code(dim, n, filters, bucket, seed)) or codes[dim]
                x /= np.abs(x).max(axis=1, keepdims=True)
                for i, f in zip(at, code.decode(x / np.linalg.norm(x, axis=1, keepdims=True)), strict=True):
                    found[i] = f
            yield pa.RecordBatch.from_arrays([ids, batch.column(1), batch.column(2), pa.array(found, pa.list_(pa.int64()))], ["rep", "copies", "vector", "filters"])
    return run


def _tree(linked: np.ndarray, ids: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest."""
    free, out = np.ones(len(ids), dtype=bool), []
    for start in range(len(ids)):
        if not free[start]:
            continue
        free[start], stack = False, [start]
        while stack:
            at = stack.pop()
            new = np.flatnonzero(linked[at] & free)
            free[new] = False
            stack.extend(new.tolist())
            out += [(int(ids[at]), int(ids[k])) for k in new]
    return out


def _compare(threshold: float):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        _, number, left, right = key
        ids, copies = rows["rep"].to_numpy(), rows["copies"].to_numpy()
        x = np.array(rows["vector"].tolist(), dtype=np.float64)
        x /= np.abs(x).max(axis=1, keepdims=True)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        linked = x @ x.T >= threshold
        np.fill_diagonal(linked, False)
        if left != right:
            own = rows["chunk"].to_numpy()
            linked &= own[:, None] != own[None, :]
        if not linked.any():
            return pd.DataFrame({"a": [], "b": [], "n": []}, dtype="int64")
        some = linked.any(axis=1)
        linked, ids, copies = linked[np.ix_(some, some)], ids[some], copies[some]
        lists = [np.asarray(f) for f in rows["filters"][some]]
        lists = [f[f < number] for f in lists]  # filters before this one: a pair that shares one of them is compared there
        names, at = np.unique(np.concatenate(lists), return_inverse=True)
        if len(names):
            has = np.zeros((len(lists), len(names)), dtype=np.float32)
            has[np.repeat(np.arange(len(lists)), [len(f) for f in lists]), at] = 1
            linked &= (has @ has.T) == 0
        counts = linked @ copies
        edges = _tree(linked, ids)
        return pd.DataFrame({"a": np.concatenate([ids, [e[0] for e in edges]]), "b": np.concatenate([ids, [e[1] for e in edges]]), "n": np.concatenate([counts, np.zeros(len(edges))])}).astype("int64")
    return run


def near_vectors(rows: DataFrame, threshold: float = THRESHOLD, filters: int = FILTERS, bucket: int = BUCKET, chunk: int = CHUNK, seed: int = SEED) -> DataFrame:
    """rows: vec_id, embedding. Returns vec_id, n_links, component_id, kept for every row."""
    vector = F.col("embedding")
    sound = F.col("vec_id").isNotNull() & F.coalesce((F.size(vector) > 0) & ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(vector, lambda x: x != 0), F.lit(False))
    classes = rows.where(sound).groupBy("embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")).select("rep", "copies", F.col("embedding").alias("vector"))
    classes = stored(classes, "vectors")
    n = classes.count()
    vectors = dict(rows.dtypes)["embedding"]
    coded = stored(classes.mapInArrow(_decode(n, filters, bucket, seed), f"rep long, copies long, vector {vectors}, filters array<long>"), "coded")
    each = coded.select("*", F.size("vector").alias("dim"), F.explode("filters").alias("filter"))
    large = each.groupBy("dim", "filter").count().where(F.col("count") > chunk).select("dim", "filter", F.ceil(F.col("count") / chunk).cast("int").alias("chunks"))
    each = each.join(large, ["dim", "filter"], "left").withColumn("chunks", F.coalesce("chunks", F.lit(1))).withColumn("chunk", F.pmod(F.xxhash64("rep"), F.col("chunks")).cast("int"))
    each = each.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    each = each.withColumns({"left": F.least("chunk", "other"), "right": F.greatest("chunk", "other")}).select("dim", "filter", "left", "right", "rep", "copies", "vector", "filters", "chunk")
    found = stored(each.groupBy("dim", "filter", "left", "right").applyInPandas(_compare(threshold), "a long, b long, n long"), "near")
    roots = components(found.where("a <> b").select("a", "b"))
    smallest = roots.groupBy("root").agg(F.min("node").alias("component"))
    counts = found.where("a = b").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n"))
    known = classes.join(counts, "rep", "left").join(roots.join(smallest, "root").select(F.col("node").alias("rep"), "component"), "rep", "left")
    known = known.where("copies > 1 OR n > 0").select(F.col("vector").alias("__v"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("links"), F.coalesce("component", "rep").alias("component"))
    out = rows.select("vec_id", "embedding").join(known, (F.col("embedding") == F.col("__v")) & sound, "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))


def op7_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


OP7_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95),
r AS (SELECT vec_id AS node, vec_id AS root FROM embeddings UNION SELECT l.b, r.root FROM r JOIN l ON r.node = l.a),
m AS (SELECT node, min(root) AS root FROM r GROUP BY node), n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT e.vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, m.root AS component_id, e.vec_id = m.root AS kept FROM embeddings e JOIN m ON m.node = e.vec_id LEFT JOIN n ON n.a = e.vec_id
"""
