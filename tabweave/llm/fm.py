"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

score = sigmoid(w0 + sum w_i x_i + sum over pairs <v_i, v_j> x_i x_j); the pairs cost linear time by the
identity 1/2 sum_f [(sum_i v_if x_i)^2 - sum_i (v_if x_i)^2]. Words are hashed to buckets and weighted by
the root of their share; statistics of structure (lengths, capitals, punctuation, symbols, repeated lines
and phrases, digits) and metadata (the declared length) are cut into bins, one feature each.

Training takes at most `SAMPLE` labelled rows, chosen by a hash; labels, language, source and id are not
features. Counts of all words of whole texts enter, at training and scoring.

Edge cases: null and empty texts are scored by their (empty) statistics; null metadata has a bin of its
own; without labelled rows every score is 0.5; rows that repeat get the same score each; several labels
of one id count each; an empty table gives no rows; a score of exactly the limit counts as good; very long
texts are scored whole; further columns are carried, and those named like an output are replaced.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabweave.llm.common import table, trimmed

BUCKETS, RANK, SAMPLE, FOLDS, LIMIT = 1 << 14, 8, 4_000, 5, 0.3
BINS, SLICE = 12, 256
_WORD_END = re.compile(r"\w\W\W+(?:\s|\Z)")


def statistics(text: str, n_chars: int | None) -> list[float]:
    """Shares and logarithms, each in a range that BINS bins divide evenly."""
    n, words, lines = max(1, len(text)), text.split(), [x for x in text.split("\n") if x.strip()]
    distinct, grams = set(words), list(zip(words, words[1:], words[2:], strict=False))
    upper, letters = sum(map(str.isupper, words)), sum(len(w) for w in words)
    marks = {m: min(1.0, 20 * text.count(m) / max(1, len(words))) for m in "!|$%*#&"}
    return [
        min(1.0, np.log1p(len(words)) / 10), upper / max(1, len(words)), len(distinct) / max(1, len(words)), len(set(grams)) / max(1, len(grams)), len(set(lines)) / max(1, len(lines)),
        min(1.0, letters / max(1, len(words)) / 16), min(1.0, len(lines) / 20 / max(1, len(words) / 100)), min(1.0, 20 * sum(c.isdigit() for c in text) / n), min(1.0, 20 * len(_WORD_END.findall(text)) / max(1, len(words))),
        min(1.0, max(map(len, words), default=0) / 60), text.count(".") / max(1, len(words)), min(1.0, sum(1 for w in words if len(w) > 2 and w[0].isupper()) / max(1, len(words))), *marks.values(),
        -1.0 if n_chars is None else min(1.0, np.log1p(max(0, n_chars)) / 12), 0.0 if n_chars is None else min(1.0, abs(n_chars - len(text)) / n),
    ]


N_STATISTICS = len(statistics("", None))
FEATURES = BUCKETS + N_STATISTICS * (BINS + 2)


def features(text: str | None, n_chars: int | None, memo: dict) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and values of the features of a document; its words' squares sum to one."""
    text = text or ""
    words = text.lower().split()
    if len(memo) > 100_000:
        memo.clear()
    at = np.fromiter((memo.get(w) if w in memo else memo.setdefault(w, zlib.crc32(w.encode("utf-8", "surrogatepass")) % BUCKETS) for w in words), dtype=np.int64, count=len(words))
    ids, counts = np.unique(at, return_counts=True)
    stats = np.array(statistics(text, n_chars))
    bins = np.where(stats < 0, BINS + 1, np.minimum((stats * BINS).astype(np.int64) + (stats > 0), BINS))
    own = BUCKETS + np.arange(N_STATISTICS) * (BINS + 2) + bins
    return np.concatenate([ids, own]), np.concatenate([np.sqrt(counts / max(1, len(words))), np.full(N_STATISTICS, 0.5)])


class FactorisationMachine:
    def __init__(self, n: int = FEATURES, rank: int = RANK, seed: int = 1) -> None:
        self.w0, self.w, self.v = 0.0, np.zeros(n), np.random.default_rng(seed).normal(0, 0.02, (n, rank))

    @staticmethod
    def _joined(rows: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return np.concatenate([r[0] for r in rows]), np.concatenate([r[1] for r in rows]), np.concatenate([[0], np.cumsum([len(r[0]) for r in rows])[:-1]])

    def _forward(self, ids: np.ndarray, x: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        vx = self.v[ids] * x[:, None]
        sums = np.add.reduceat(vx, starts)
        return self.w0 + np.add.reduceat(self.w[ids] * x, starts) + 0.5 * (sums ** 2 - np.add.reduceat(vx ** 2, starts)).sum(axis=1), vx, sums

    def scores(self, rows: list) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self._forward(*self._joined(rows))[0], -35, 35))) if rows else np.zeros(0)

    def fit(self, rows: list, labels: np.ndarray, epochs: int = 8, batch: int = 128, rate: float = 0.1, decay: float = 1e-5, seed: int = 2) -> None:
        """AdaGrad on the logistic loss."""
        rng, gw, gv, g0 = np.random.default_rng(seed), np.full(len(self.w), 1e-6), np.full(self.v.shape, 1e-6), 1e-6
        for _ in range(epochs):
            order = rng.permutation(len(rows))
            for i in range(0, len(rows), batch):
                part = order[i:i + batch]
                ids, x, starts = self._joined([rows[k] for k in part])
                score, vx, sums = self._forward(ids, x, starts)
                d = 1 / (1 + np.exp(-np.clip(score, -35, 35))) - labels[part]
                each = np.repeat(np.arange(len(part)), np.diff(np.append(starts, len(ids))))
                used, place = np.unique(ids, return_inverse=True)
                dw = np.bincount(place, d[each] * x, len(used)) / len(part) + decay * self.w[used]
                dv = (d[each] * x)[:, None] * (sums[each] - vx)
                dv = np.stack([np.bincount(place, dv[:, f], len(used)) for f in range(dv.shape[1])], axis=1) / len(part) + decay * self.v[used]
                gw[used] += dw ** 2
                gv[used] += dv ** 2
                g0 += d.mean() ** 2
                self.w[used] -= rate * dw / np.sqrt(gw[used])
                self.v[used] -= 0.3 * rate * dv / np.sqrt(gv[used])
                self.w0 -= rate * d.mean() / np.sqrt(g0)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS)) == 0, F.lit(False))


def trained(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> FactorisationMachine:
    """Fitted on at most `sample` labelled rows outside the held-out fold."""
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).select(F.col("doc_id").alias("__id"), F.col("quality").cast("int").alias("__y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = docs.select("doc_id", "text", "n_chars").join(known, F.col("doc_id") == F.col("__id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict = {}
        for batch in batches:
            found = [features(t, n, memo) for i in range(0, batch.num_rows, SLICE) for t, n in zip(*(batch.column(k).slice(i, SLICE).to_pylist() for k in (1, 2)), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(3), pa.array([f[0].astype(np.int32) for f in found], pa.list_(pa.int32())), pa.array([f[1].astype(np.float32) for f in found], pa.list_(pa.float32()))], ["doc_id", "y", "ids", "x"])

    got = rows.select("doc_id", "text", "n_chars", "__y").mapInArrow(trimmed(run), "doc_id long, y int, ids array<int>, x array<float>").toArrow().combine_chunks()
    model = FactorisationMachine()
    model.v *= got.num_rows > 0
    if got.num_rows:
        order = np.lexsort((got.column(1).to_numpy(), got.column(0).to_numpy()))
        ids, x = (c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in (got.column(2), got.column(3)))
        ends, ids, x = ids.offsets.to_numpy(), ids.values.to_numpy(), x.values.to_numpy()
        model.fit([(ids[ends[i]:ends[i + 1]].astype(np.int64), x[ends[i]:ends[i + 1]].astype(np.float64)) for i in order], got.column(1).to_numpy()[order].astype(float))
    return model


def classified(docs: DataFrame, model: FactorisationMachine, keep: float = LIMIT, whole: bool = False, names: tuple[str, str] = ("score", "predicted")) -> DataFrame:
    """docs with score and predicted, under these names (columns that have one, in any case, are replaced); doc_id and these only, unless whole.

    Rows are scored `SLICE` at a time, so a task holds a batch of texts and the features of a slice."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.select(*(F.col(f"`{c}`") for c in docs.columns if c.lower() not in names))
    lower = [c.lower() for c in docs.columns]
    text, n_chars = lower.index("text"), lower.index("n_chars")
    columns = docs.columns if whole else [docs.columns[lower.index("doc_id")]]
    kept = [docs.columns.index(c) for c in columns]
    if not whole:
        docs, kept, text, n_chars = docs.select(columns[0], "text", "n_chars"), [0], 1, 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict = {}
        for batch in batches:
            for i in range(0, batch.num_rows, SLICE):
                part = batch.slice(i, SLICE)
                score = shared.value.scores([features(t, n, memo) for t, n in zip(part.column(text).to_pylist(), part.column(n_chars).to_pylist(), strict=True)])
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in kept), pa.array(score, pa.float64()), pa.array((score >= keep).astype(np.int32))], [*columns, *names])

    schema = ", ".join(f"`{c}` {t}" for c, t in docs.select(*(F.col(f"`{c}`") for c in columns)).dtypes)
    return docs.mapInArrow(trimmed(run), f"{schema}, `{names[0]}` double, `{names[1]}` int")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return classified(docs, trained(docs, table(spark, sf_dir, "labels"))).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
