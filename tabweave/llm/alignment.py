"""Alignment of the tokens of two tokenizers by distinct segments.

A text is cut before each run of white space where neither tokenizer can join what lies on both sides: every
entry of both vocabularies is looked through, and a white-space character at which some entry has it behind something else is
no place to cut (`Pair.cuts`). What the two make of a segment is then what they make of it within any text. Texts are
packed into chunks of about `CHUNK` characters, as numbers of segments; the segments of all chunks meet by one exchange,
in which each is tokenized and aligned once, and their alignments go back to the chunks, where documents are put
together from them. Links are counted likewise: a chunk sums up in how many of its documents each pair of ids is linked, the
sums are added over chunks and joined back, and documents add up what their segments count. What is exchanged is the
numbers, and the distinct segments and pairs of each chunk; a task holds one chunk.

A group is what lies between two byte offsets at which tokens of both end; links are all pairs of tokens within a group.

Edge cases: null and empty texts, and those that the two tokenizers' bytes do not give back, have no tokens; rows
that repeat, have the same id or none are aligned each; a text longer than a chunk is a chunk of its own; an empty
table gives no rows. Only `doc_id` and `text` are read.
"""

from __future__ import annotations

import gc
import hashlib
import os
import re
import time
from collections import defaultdict
from collections.abc import Iterator
from functools import cached_property
from itertools import chain, count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tabweave.llm.common import freeing, sliced, stored, swept, table, trimmed
from tabweave.llm.lm import packed, unpacked

TOKENIZERS = "/opt/tokenizers"
CHUNK, ROWS, LARGE, HELD = 6 << 20, 1024, 4096, 1 << 17
SPACES = " \t\n\r\x0b\x0c"
#: What the byte-level alphabet of the first kind of tokenizer shows as itself; other bytes have code points from 256 on.
SHOWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]


class Pair:
    """Two tokenizers: a byte-level one (a JSON file), to which a space is put before the text, and one of pieces with byte fallback (a model file), which puts it there itself."""

    def __init__(self, bytes_path: str, pieces_path: str) -> None:
        self.paths = bytes_path, pieces_path

    def __reduce__(self):
        return Pair, self.paths

    @cached_property
    def first(self):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism; threads of their own would hold memory each
        from tokenizers import Tokenizer

        out = Tokenizer.from_file(self.paths[0])
        out.encode_special_tokens = True
        return out

    @cached_property
    def second(self):
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_file=self.paths[1])

    @cached_property
    def entries(self) -> tuple[list[bytes], list[bytes]]:
        """The bytes of each id of both."""
        hidden = (b for b in range(256) if b not in set(SHOWN))
        to_byte = {chr(b): b for b in SHOWN} | {chr(256 + i): b for i, b in enumerate(hidden)}
        names = {i: t for t, i in self.first.get_vocab(with_added_tokens=True).items()}
        one = [bytes(to_byte[c] for c in names[i]) if all(c in to_byte for c in names.get(i, "\n")) else b"" for i in range(max(names) + 1)]
        pieces = [(self.second.id_to_piece(i), self.second.is_byte(i)) for i in range(self.second.get_piece_size())]
        return one, [bytes([int(p[1:-1], 16)]) if byte else p.replace("▁", " ").encode() for p, byte in pieces]

    @cached_property
    def cuts(self) -> str:
        """White space before which a text can be cut, if no white space comes before it: no entry has it behind another character."""
        texts = [entry.decode(errors="replace") for side in self.entries for entry in side]
        joined = {y for t in texts for x, y in zip(t, t[1:], strict=False) if not x.isspace()}
        return "".join(c for c in SPACES if c not in joined)

    @cached_property
    def seal(self) -> str:
        """A character that no piece holds: pieces behind it are those of the text behind it."""
        pieces = b"".join(e for e in self.entries[1] if len(e) > 1)
        return next(c for c in ("\n", "\x0b", "\x01", "\x02") if c.encode() not in pieces)

    @cached_property
    def segment(self) -> re.Pattern:
        """A segment runs on over white space that is no place to cut."""
        if not self.cuts:
            return re.compile(r".+", re.S)
        other = f"(?![{re.escape(self.cuts)}])\\s"
        return re.compile(rf"\s*\S+(?:{other}\s*\S*)*|\s+")

    def segments(self, text: str | None) -> list[str]:
        return self.segment.findall(" " + text) if text else []

    def encoded(self, segments: list[str]) -> list[tuple[list[int], list[int]]]:
        skip = len(self.second.encode(self.seal))
        one = self.first.encode_batch(segments, add_special_tokens=False)
        return [(a.ids, b[skip:]) for a, b in zip(one, self.second.encode([self.seal + s for s in segments], num_threads=1), strict=True)]

    @cached_property
    def sizes(self) -> tuple[np.ndarray, np.ndarray]:
        return tuple(np.array([len(e) for e in side], dtype=np.int64) for side in self.entries)

    def sound(self, segments: list[str], encoded: list[tuple[list[int], list[int]]]) -> list[bool]:
        """Whether both sides give back the bytes of each segment."""
        one, two = self.entries
        return [b"".join(map(one.__getitem__, a)) == data and b"".join(map(two.__getitem__, b)) == data
                for data, (a, b) in zip((s.encode("utf-8", "surrogatepass") for s in segments), encoded, strict=True)]

    def groups(self, encoded: list[tuple[list[int], list[int]]]) -> list[list[np.ndarray]]:
        """For each sound segment: ids of both sides, and how many of either each group has."""
        ids = [np.fromiter(chain.from_iterable(e[k] for e in encoded), dtype=np.int64) for k in range(2)]
        ends = [np.cumsum(size[i]) for size, i in zip(self.sizes, ids, strict=True)]
        shared = np.intersect1d(*ends, assume_unique=True)
        sizes = [np.bincount(np.searchsorted(shared, e), minlength=len(shared)) for e in ends]
        tokens = [np.cumsum([0, *(len(e[k]) for e in encoded)]) for k in range(2)]
        cuts = np.concatenate([[0], np.searchsorted(shared, ends[0][tokens[0][1:] - 1], side="right")]) if len(encoded) else [0]
        return [[ids[0][tokens[0][i]:tokens[0][i + 1]], ids[1][tokens[1][i]:tokens[1][i + 1]], sizes[0][cuts[i]:cuts[i + 1]], sizes[1][cuts[i]:cuts[i + 1]]] for i in range(len(encoded))]


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of each stretch, one stretch after the other."""
    return np.repeat(starts - np.cumsum(lengths) + lengths, lengths) + np.arange(int(lengths.sum()))


def folded(parts: list[np.ndarray]) -> tuple[bytes, bool]:
    """An aligned segment as bytes: how many tokens of both and groups there are, ids and sizes of groups; and whether it takes four bytes a value, not two."""
    values = np.concatenate([[len(parts[0]), len(parts[1]), len(parts[2])], *parts])
    wide = bool(values.max() > 0xFFFF)
    return values.astype("<u4" if wide else "<u2").tobytes(), wide


def unfolded(data: np.ndarray, numbers: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All values of all segments in the order of their numbers, where each segment begins, and which are sound. Lengths are in bytes, negative for wide ones, 0 for segments without tokens."""
    size, wide = np.abs(lengths), lengths < 0
    starts = (np.cumsum(size) - size) // 2
    values, counts = data.view("<u2").astype(np.int64), size // np.where(wide, 4, 2)
    more = [data[2 * starts[i]:2 * starts[i] + size[i]].copy().view("<u4").astype(np.int64) for i in np.flatnonzero(wide)]
    starts[wide] = len(values) + np.cumsum([0, *map(len, more)])[:-1]
    none = counts == 0
    starts[none], counts[none] = len(values) + sum(map(len, more)), 3
    values = np.concatenate([values, *more, np.zeros(3, dtype=np.int64)])
    order = np.argsort(numbers)
    counts = counts[order]
    return values[ragged(starts[order], counts)], np.cumsum(counts) - counts, ~none[order]


def joined(parts: pa.Array, lengths: np.ndarray, by: str) -> pa.Array:
    """Texts of so many parts each."""
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()), parts), by)


def ranged(sums: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sums over stretches of so many."""
    total, ends = np.concatenate([[0], np.cumsum(sums)]), np.cumsum(lengths, dtype=np.int64)
    return total[ends] - total[ends - lengths]


def _batch(schema: str, rows: list[tuple], doc_id: pa.DataType) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "array<id>": pa.list_(doc_id), "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}
    names, types = zip(*(x.split() for x in schema.split(", ")), strict=True)
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[t]) for i, t in enumerate(types)], list(names))


#: Rows of a chunk: how many segments each has, all their numbers in turn (packed), and the segments by number.
CHUNKS = "chunk long, ids array<id>, lengths array<long>, numbers binary, segments array<string>"


def _chunked(pair: Pair, size: int, doc_id: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        made, held = count(TaskContext.get().partitionId() << 32), 0
        seen, ids, numbers = defaultdict(count().__next__), [], []

        def flush() -> pa.RecordBatch:
            nonlocal seen, held
            row = (next(made), ids.copy(), [len(n) for n in numbers], packed(np.concatenate(numbers)), list(seen))
            ids.clear()
            numbers.clear()
            seen, held = defaultdict(count().__next__), 0
            return _batch(CHUNKS, [row], doc_id)

        for batch in batches:
            for doc, text in sliced(batch, 0, 1):
                segments = pair.segments(text)
                ids.append(doc)
                numbers.append(np.fromiter(map(seen.__getitem__, segments), dtype=np.int64, count=len(segments)))
                held += len(text or "") + 64
                if held >= size:
                    yield flush()
        if ids:
            yield flush()
    return trimmed(run)


#: Aligned segments of a chunk: their numbers, the lengths of what each is folded to (0 where bytes are not given back, negative where wide), and that, compressed.
ANSWERS = "of long, n long, numbers binary, lengths binary, size long, aligned binary"


def _answered(pair: Pair):
    """Rows in order of their segments: each segment is tokenized and aligned once, what goes back to the same chunk is packed."""
    def encoded(segments: list[str]) -> list[tuple[bytes, bool]]:
        out = []
        for i in range(0, len(segments), ROWS):
            part = segments[i:i + ROWS]
            ids = pair.encoded(part)
            sound = pair.sound(part, ids)
            groups = iter(pair.groups([e for e, ok in zip(ids, sound, strict=True) if ok]))
            out += [folded(next(groups)) if ok else (b"", False) for ok in sound]
        return out

    def packs(held: list[tuple]) -> pa.RecordBatch:
        chunks, numbers, wide = (np.concatenate([h[i] for h in held]) for i in range(3))
        order = np.lexsort((numbers, chunks))
        data = pa.concat_arrays([h[3] for h in held]).take(pa.array(order))
        _, ends, values = data.buffers()
        ends = np.frombuffer(ends, dtype=np.int32)[: len(data) + 1]
        chunks, numbers, lengths = chunks[order], numbers[order], np.diff(ends) * np.where(wide[order], -1, 1)
        cuts, rows = [0, *(np.flatnonzero(np.diff(chunks)) + 1).tolist(), len(chunks)], []
        for i, j in zip(cuts, cuts[1:], strict=False):
            size = int(ends[j] - ends[i])
            rows.append((int(chunks[i]), j - i, packed(np.diff(numbers[i:j], prepend=0)), packed(lengths[i:j]), size, pa.compress(values.slice(int(ends[i]), size), codec="zstd", asbytes=True)))
        return _batch(ANSWERS, rows, pa.null())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, last, before = [], 0, None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            column = batch.column(0).dictionary_encode()
            names, at = column.dictionary.to_pylist(), column.indices
            known = names[0] == last
            data = [before] * known + encoded(names[known:])
            last, before = names[-1], data[-1]
            held.append((batch.column(1).to_numpy(), batch.column(2).to_numpy().astype(np.int64), np.array([w for _, w in data])[at.to_numpy()], pa.array([d for d, _ in data], pa.binary()).take(at)))
            rows += batch.num_rows
            if rows >= HELD:
                yield packs(held)
                held, rows = [], 0
        if rows:
            yield packs(held)
    return trimmed(run)


class Links:
    """The aligned segments of a chunk, in the order of their numbers: sizes, groups as text, and the pairs of ids they link, each with how often."""

    def __init__(self, values: np.ndarray, at: np.ndarray, sound: np.ndarray) -> None:
        self.sound, n = sound, len(at)
        n_a, n_b, n_groups = (values[at + i] for i in range(3))
        sizes_at = at + 3 + n_a + n_b
        x, y = values[ragged(sizes_at, n_groups)], values[ragged(sizes_at + n_groups, n_groups)]
        of = np.repeat(np.arange(n), n_groups)
        a, b = values[ragged(at + 3, n_a)], values[ragged(at + 3 + n_a, n_b)]
        starts = np.cumsum(x) - x, np.cumsum(y) - y
        sides = [joined(pa.array(ids, pa.int64()).cast(pa.string()), size, ",") for ids, size in ((a, x), (b, y))]
        self.shown = joined(pc.binary_join_element_wise(*sides, "|"), n_groups, ";")
        self.sizes = np.stack([n_a, n_b, n_groups, np.bincount(of, weights=x * y, minlength=n).astype(np.int64)], axis=1)
        small = x * y <= LARGE
        i, j, times, owner = self._products(starts[0][small], starts[1][small], x[small], y[small], of[small])
        keys = [a[i] << 32 | b[j]]
        for g in np.flatnonzero(~small):  # ids that repeat within a large group count once, with how often
            (one, n), (two, m) = (np.unique(side[s[g]:s[g] + z[g]], return_counts=True) for side, s, z in zip((a, b), starts, (x, y), strict=True))
            keys.append((one[:, None] << 32 | two[None, :]).ravel())
            times = np.concatenate([times, (n[:, None] * m[None, :]).ravel()])
            owner = np.concatenate([owner, np.full(len(one) * len(two), of[g])])
        order = np.argsort(owner, kind="stable")
        self.pairs, self.pair_of = np.unique(np.concatenate(keys)[order], return_inverse=True)
        self.times = times[order]
        self.lengths = np.bincount(owner, minlength=n).astype(np.int64)

    @staticmethod
    def _products(at_a: np.ndarray, at_b: np.ndarray, x: np.ndarray, y: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, ...]:
        n = x * y
        k, wide = ragged(np.zeros(len(n), dtype=np.int64), n), np.repeat(np.maximum(y, 1), n)
        return np.repeat(at_a, n) + k // wide, np.repeat(at_b, n) + k % wide, np.ones(int(n.sum()), dtype=np.int64), np.repeat(of, n)


#: A chunk put together: its rows' sizes and groups, in how many of them each pair is linked, and what the second pass takes: how many links each segment has, their pairs and how often.
COMPOSED = "of long, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, groups array<string>, pairs array<long>, documents array<long>, links binary, link binary, times binary, n_segments long, n_all long"


def _composed(digest: bool):
    def run(chunks: pa.Table, answers: pa.Table) -> pa.Table:
        lengths = np.array(chunks.column("lengths")[0].as_py(), dtype=np.int64)
        at = unpacked(chunks.column("numbers")[0].as_py(), int(lengths.sum()))
        none = np.zeros(0, dtype=np.int64)
        packs = answers.to_pylist()
        data = b"".join(pa.decompress(r["aligned"], decompressed_size=r["size"], codec="zstd", asbytes=True) for r in packs if r["size"])
        links = Links(*unfolded(np.frombuffer(data, dtype=np.uint8), np.concatenate([none, *(np.cumsum(unpacked(r["numbers"], r["n"])) for r in packs)]), np.concatenate([none, *(unpacked(r["lengths"], r["n"]) for r in packs)])))
        sound = (ranged(~links.sound[at], lengths) == 0) & (lengths > 0)
        sizes = np.stack([ranged(links.sizes[at, i], lengths) for i in range(4)], axis=1) * sound[:, None]
        documents, first, starts = np.zeros(len(links.pairs), dtype=np.int64), np.zeros(len(links.pairs), dtype=np.int64), np.cumsum(links.lengths) - links.lengths
        for mine in (x for x, ok in zip(np.split(at, np.cumsum(lengths)[:-1]), sound, strict=True) if ok):
            pairs = links.pair_of[ragged(starts[mine], links.lengths[mine])]
            first[pairs] = np.arange(len(pairs))  # one of the places of each
            documents[pairs[first[pairs] == np.arange(len(pairs))]] += 1
        texts = joined(links.shown.take(pa.array(at)), lengths, ";")
        shown = [(hashlib.sha256(t).hexdigest() if digest else t.decode()) if ok else "" for t, ok in zip(texts.cast(pa.binary()).to_pylist(), sound, strict=True)]
        row = (chunks.column("chunk")[0].as_py(), *(sizes[:, i] for i in range(4)), shown, links.pairs, documents, packed(links.lengths), packed(links.pair_of), packed(links.times), len(links.lengths), len(links.pair_of))
        return pa.Table.from_batches([_batch(COMPOSED, [row], pa.null())])
    return run


def _totalled(groups: str):
    """The rows of a chunk with the sums of what their links count."""
    def run(chunks: pa.Table, counted: pa.Table) -> pa.Table:
        row = {c: chunks.column(c)[0].as_py() for c in ("lengths", "numbers", "links", "link", "times", "n_segments", "n_all")}
        order = np.argsort(counted.column("pair").to_numpy())
        links, lengths = unpacked(row["links"], row["n_segments"]), np.array(row["lengths"], dtype=np.int64)
        link, times = (unpacked(row[c], row["n_all"]) for c in ("link", "times"))
        at = unpacked(row["numbers"], int(lengths.sum()))
        lists = {c: chunks.column(c).combine_chunks().flatten() for c in ("ids", "n_a", "n_b", "n_groups", "n_links", "groups")}
        sound = lists["n_a"].to_numpy() > 0
        sums = [ranged(ranged(counted.column(c).to_numpy()[order][link] * times, links)[at], lengths) * sound for c in ("best", "documents")]
        return pa.table([*lists.values(), *map(pa.array, sums)], names=["doc_id", "n_a", "n_b", "n_groups", "n_links", groups, "n_best", "count_sum"])
    return run


def alignments(docs: DataFrame, pair: Pair, chunk: int = CHUNK, digest: bool = False) -> DataFrame:
    """docs: doc_id, text. Returns per row doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups: ids of both, groups apart by ';', sides by '|', ids by ',' (with digest: groups_sha256, its hash)."""
    if not pair.cuts:
        raise ValueError("the vocabularies can join across any white space")
    kind, groups = dict(docs.dtypes)["doc_id"], "groups_sha256" if digest else "groups"
    doc_id = to_arrow_type(docs.schema["doc_id"].dataType)
    chunks = stored(docs.select("doc_id", "text").mapInArrow(_chunked(pair, chunk, doc_id), CHUNKS.replace("<id>", f"<{kind}>")), "chunks", "zstd")
    named = chunks.select("chunk", F.posexplode("segments").alias("number", "segment"))
    known = named.select("segment", "chunk", "number").repartition("segment").sortWithinPartitions("segment").mapInArrow(_answered(pair), ANSWERS)
    composed = stored(chunks.drop("segments", "ids").groupBy("chunk").cogroup(known.groupBy("of")).applyInArrow(freeing(_composed(digest)), COMPOSED), "composed")
    del known, named
    gc.collect()  # plans that Python still holds in cycles keep their shuffles
    swept(docs.sparkSession)
    time.sleep(0.5)  # Python's references are given up in the background
    swept(docs.sparkSession)
    counts = composed.select(F.explode(F.arrays_zip("pairs", "documents")).alias("p")).groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.documents").alias("documents"))
    counts = stored(counts.withColumn("a", F.shiftright("pair", 32)), "pairs")
    most = counts.groupBy("a").agg(F.max("documents").alias("most"))  # no more rows than the first vocabulary has entries
    counts = counts.join(F.broadcast(most), "a").select("pair", "documents", (F.col("documents") == F.col("most")).cast("long").alias("best"))
    counted = composed.select("of", F.explode("pairs").alias("pair")).join(counts, "pair")
    rows = chunks.drop("segments").join(composed.drop("pairs", "documents").withColumnRenamed("of", "chunk").hint("merge"), "chunk")
    out = f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, {groups} string, n_best long, count_sum long"
    return rows.groupBy("chunk").cogroup(counted.groupBy("of")).applyInArrow(freeing(_totalled(groups)), out)


def op11_alignment(spark: SparkSession, sf_dir: str, tokenizers: str = TOKENIZERS) -> DataFrame:
    pair = Pair(f"{tokenizers}/byte_bpe_50k.json", f"{tokenizers}/piece_bpe_32k.model")
    out = alignments(table(spark, sf_dir, "documents"), pair, digest=True)
    return out.select(F.col("doc_id").cast("long").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
