"""Language-model scores: cross-entropy difference of matched n-gram models.

Target and background share one vocabulary, order and smoothing; their counts come from all target texts and
all other texts. A bigram's probability is its count with the word's unigram probability as prior
(Dirichlet), the unigram's is smoothed by one. For each token the loss under the target model less that under
the background model is taken; a document's score is the mean (lower: more like the target).

Every word and every pair counts, however rare, and no table of them is broadcast or sent to the driver. Rows
are packed into chunks of about `CHUNK` tokens, stored as word numbers. Each chunk sends its distinct words and
pairs with its counts, packed by ranges of hashes; there are `RANGES` for each partition of an exchange, however large the
corpus. Where they arrive they are sorted by hash (Spark's sort, which spills), those of the same hash are summed up as they pass, and
the sums go back to their chunks, packed, from which the chunk's rows are scored. What is sent grows in proportion to the
corpus, what a task holds does not grow; larger corpora want more shuffle partitions, as in any exchange.

Edge cases: null, empty and blank texts have no tokens, losses of 0 and a score of 0; without target texts
both models are the same smoothing; rows that repeat are counted and scored each; an empty table gives no rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabweave.llm.common import bounded, freeing, shuffles_dropped, small_batches, stored, swept, table, trimmed

PRIOR = 50.0
CHUNK, HELD, SENT_ROWS, RANGES, START = 1 << 20, 1 << 17, 16, 4, 0x9E3779B97F4A7C15


def joint(before: np.ndarray, u: np.ndarray) -> np.ndarray:
    x = (before * np.uint64(0xC2B2AE3D27D4EB4F)) ^ (u + np.uint64(0x165667B19E3779F9))
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (x ^ (x >> np.uint64(32))).view(np.int64)


def packed(x: np.ndarray) -> bytes:
    """Whole numbers by planes of their bytes, compressed."""
    planes = np.ascontiguousarray(x.astype(np.int64).view(np.uint8).reshape(-1, 8).T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpacked(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, decompressed_size=8 * n, codec="zstd", asbytes=True), dtype=np.uint8) if n else np.zeros(0, dtype=np.uint8)
    return np.ascontiguousarray(planes.reshape(8, -1).T).view(np.int64).ravel()


CHUNKS = "chunk long, ids array<long>, targets array<boolean>, lengths array<long>, n_words long, words binary, numbers binary, target long, background long"
#: A word (at: its number in the chunk) or pair (at: -1 less its number) of a chunk, by its hash; counts: those in target texts, times 2 to the 32, and in others.
ENTRIES = "key long, chunk long, at int, counts long"
#: A chunk's words or pairs of a range of hashes: the number of the first and how many, their hashes in order (differences) and counts.
SENT = "chunk long, part long, pairs boolean, first long, n long, hashes binary, counts binary"
#: What goes back to a chunk: the sums over all chunks for some of its words and pairs. new_words: how many words were summed up in it.
ANSWERS = "of long, n long, new_words long, at binary, target binary, background binary"


def _batch(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "array<boolean>": pa.list_(pa.bool_()), "boolean": pa.bool_()}
    names, types = zip(*(x.split() for x in schema.split(", ")), strict=True)
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[t]) for i, t in enumerate(types)], list(names))


def _chunked(size: int):
    """Chunks of rows: the hashes of their words, in order of appearance, and the number of each token's word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        from pyspark import TaskContext

        made = count(TaskContext.get().partitionId() << 32)
        seen: defaultdict = defaultdict(count().__next__)
        ids, targets, lengths, held = [], [], [], []
        total = [0, 0]

        def flush() -> pa.RecordBatch:
            nonlocal seen, total
            hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) - (1 << 63) for w in seen), dtype=np.int64, count=len(seen))
            row = (next(made), ids.copy(), targets.copy(), lengths.copy(), len(seen), packed(hashes), packed(np.concatenate(held)), total[1], total[0])
            for x in (ids, targets, lengths, held):
                x.clear()
            seen, total = defaultdict(count().__next__), [0, 0]
            return _batch(CHUNKS, [row])

        for batch in batches:
            for doc, text, target in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
                held.append(np.fromiter(map(seen.__getitem__, words), dtype=np.int32, count=len(words)))
                ids.append(doc)
                targets.append(bool(target))
                lengths.append(len(words))
                total[bool(target)] += len(words)
                if sum(total) >= size or len(ids) >= 100_000:
                    yield flush()
        if ids:
            yield flush()
    return run


def _opened(row: dict) -> tuple[np.ndarray, ...]:
    """Of a chunk: its lengths, words and pairs (distinct hashes, ascending), and each token's word and pair among them."""
    lengths = np.array(row["lengths"], dtype=np.int64)
    words, at = np.unique(unpacked(row["words"], row["n_words"]), return_inverse=True)
    numbers = at[unpacked(row["numbers"], int(lengths.sum()))]
    u = words.view(np.uint64)[numbers]
    before = np.roll(u, 1)
    before[_starts(lengths)] = START
    grams, gram = np.unique(joint(before, u), return_inverse=True)
    return lengths, words, numbers, grams, gram


def _starts(lengths: np.ndarray) -> np.ndarray:
    """Where the texts that have tokens begin."""
    return (np.cumsum(lengths) - lengths)[lengths > 0]


def _sent(parts: int):
    """What each chunk has in each range of hashes."""
    bounds = np.array([i * (1 << 64) // parts - (1 << 63) for i in range(1, parts)], dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in (x for i in range(len(batch)) for x in batch.slice(i, 1).to_pylist()):
                lengths, words, numbers, grams, gram = _opened(row)
                target = np.repeat(np.array(row["targets"], dtype=bool), lengths)
                for kind, (keys, of) in enumerate(((words, numbers), (grams, gram))):
                    counts = np.bincount(of[target], minlength=len(keys)) << 32
                    counts += np.bincount(of, minlength=len(keys)) - (counts >> 32)
                    ends = [0, *np.searchsorted(keys, bounds).tolist(), len(keys)]
                    some = [p for p in range(parts) if ends[p + 1] > ends[p]]
                    for i in range(0, len(some), SENT_ROWS):
                        cuts = [(p, slice(ends[p], ends[p + 1])) for p in some[i:i + SENT_ROWS]]
                        yield _batch(SENT, [(row["chunk"], p, kind == 1, c.start, c.stop - c.start, packed(np.diff(keys[c], prepend=np.int64(0))), packed(counts[c])) for p, c in cuts])
    return run


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """ENTRIES of what was sent, for sorting."""
    for batch in batches:
        for r in (x for i in range(len(batch)) for x in batch.slice(i, 1).to_pylist()):
            at = np.arange(r["first"], r["first"] + r["n"], dtype=np.int32)
            columns = np.cumsum(unpacked(r["hashes"], r["n"])), np.full(r["n"], r["chunk"]), -1 - at if r["pairs"] else at, unpacked(r["counts"], r["n"])
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "chunk", "at", "counts"])


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries in order of their hashes: each takes the sums over all of the same hash and kind, and goes back to its chunk, packed with others."""
    def summed(keys: np.ndarray, chunks: np.ndarray, at: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, ...]:
        order = np.lexsort((at < 0, keys))  # a word and a pair of the same hash stay apart
        keys, chunks, at, counts = keys[order], chunks[order], at[order], counts[order]
        new = np.concatenate([[True], (np.diff(keys) != 0) | (np.diff((at < 0).astype(np.int8)) != 0)])
        run, starts = np.cumsum(new) - 1, np.flatnonzero(new)
        return chunks, at, np.add.reduceat(counts >> 32, starts)[run], np.add.reduceat(counts & 0xFFFFFFFF, starts)[run], new & (at >= 0)

    def packs(held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        chunks, at, target, background, words = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.lexsort((at, chunks))
        rows = []
        for mine in np.split(order, np.flatnonzero(np.diff(chunks[order])) + 1):
            rows.append((int(chunks[mine[0]]), len(mine), int(words[mine].sum()), packed(np.diff(at[mine].astype(np.int64), prepend=0)), packed(target[mine]), packed(background[mine])))
        return _batch(ANSWERS, rows)

    held, n, left = [], 0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [c.to_numpy() for c in batch.columns]
        if left:
            columns = [np.concatenate(x) for x in zip(left, columns, strict=True)]
        cut = int(np.searchsorted(columns[0], columns[0][-1]))  # the last hash may go on
        left = [c[cut:] for c in columns]
        if cut:
            held.append(summed(*(c[:cut] for c in columns)))
            n += cut
        if n >= HELD:
            yield packs(held)
            held, n = [], 0
    if left:
        yield packs([*held, summed(*left)])


SCORES = "doc_id long, n_tokens long, target_loss double, background_loss double, score double, n_nearer long"


def _rated(totals: np.ndarray, vocabulary: int, prior: float):
    def run(chunks: pa.Table, answers: pa.Table) -> pa.Table:
        (row,) = chunks.to_pylist()
        lengths, words, numbers, grams, gram = _opened(row)
        counts = [[np.zeros(len(words), dtype=np.int64), np.zeros(len(grams), dtype=np.int64)] for _ in totals]
        for r in answers.to_pylist():
            at = np.cumsum(unpacked(r["at"], r["n"]))
            for (of_words, of_pairs), side in zip(counts, ("target", "background"), strict=True):
                sums = unpacked(r[side], r["n"])
                of_words[at[at >= 0]], of_pairs[-1 - at[at < 0]] = sums[at >= 0], sums[at < 0]
        starts, filled = _starts(lengths), lengths > 0
        losses = []
        for (of_words, of_pairs), total in zip(counts, totals, strict=True):
            c = of_words[numbers].astype(float)
            before = np.roll(c, 1)
            before[starts] = total  # at the start of a text, so many starts at most
            losses.append(-np.log((np.minimum(of_pairs[gram], before) + prior * (c + 1) / (total + vocabulary)) / (before + prior)))
        t, b = losses
        out = [np.zeros(len(lengths)) for _ in range(4)]
        if len(starts):
            for x, of in zip(out, (t, b, t - b, t < b), strict=True):
                x[filled] = np.add.reduceat(of.astype(float), starts)
            for x in out[:3]:
                x[filled] /= lengths[filled]
        return pa.table([pa.array(row["ids"], pa.int64()), pa.array(lengths), *map(pa.array, out[:3]), pa.array(out[3].astype(np.int64))], names=[x.split()[0] for x in SCORES.split(", ")])
    return run


def sent(chunks: DataFrame) -> DataFrame:
    """What chunks send: a row for each range of hashes, of which there are a few for each partition of an exchange."""
    return chunks.mapInArrow(trimmed(_sent(RANGES * int(chunks.sparkSession.conf.get("spark.sql.shuffle.partitions")))), SENT)


def dealt(packs: DataFrame) -> DataFrame:
    """What chunks send, `RANGES` neighbouring ranges to each partition: by a hash of the range some partitions would get several times what others do."""
    return packs.repartitionById(int(packs.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.floor(F.col("part") / RANGES).cast("int"))


def scored_corpus(docs: DataFrame, prior: float = PRIOR, chunk: int = CHUNK) -> DataFrame:
    """docs: doc_id, text, target (boolean). Per row: doc_id, n_tokens, target_loss, background_loss (means), score (their difference), n_nearer (tokens likelier in the target), by the models of all words and pairs."""
    spark = docs.sparkSession
    with small_batches(spark):
        chunks = stored(docs.select("doc_id", "text", "target").mapInArrow(trimmed(_chunked(chunk)), CHUNKS), "chunks")
    target, background = (int(x or 0) for x in chunks.agg(F.sum("target"), F.sum("background")).first())
    with small_batches(spark, 20_000, 1 << 20), shuffles_dropped(spark):  # packs are large rows, entries small ones
        answers = stored(dealt(sent(chunks)).mapInArrow(trimmed(_entries), ENTRIES).sortWithinPartitions("key").mapInArrow(trimmed(_summed), ANSWERS), "answers")
    swept(spark)
    vocabulary = answers.agg(F.sum("new_words")).first()[0] or 0
    return chunks.groupBy("chunk").cogroup(answers.groupBy("of")).applyInArrow(freeing(_rated(np.array([target, background], dtype=float), vocabulary, prior)), SCORES)


def op2_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target: documents labelled of good quality and not toxic; background: all others."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    good = bounded(labels.where("quality = 1 AND toxic = 0 AND doc_id IS NOT NULL").select(F.col("doc_id").alias("__id")).distinct(), "target")
    texts = docs.select("doc_id", "text").join(good, F.col("doc_id") == F.col("__id"), "left").select("doc_id", "text", F.col("__id").isNotNull().alias("target"))
    return scored_corpus(texts)
