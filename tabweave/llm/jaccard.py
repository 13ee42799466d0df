"""N-gram Jaccard join by parity sketches.

A document's set is its distinct word shingles, as 64-bit hashes. Sets are split into size bands; for a
band, a threshold of J bounds the symmetric difference of two sets by d. Tokens are hashed to positions
of a bit sketch and flip their bits (XOR), so sketches differ in at most as many bits as sets in tokens.
The sketch of a band is cut into blocks: d tokens touch d blocks at most, so of any d + 1 blocks of one
set that hold bits, one is equal in the other. Each set emits its first d + 1 blocks with bits as keys;
a key names band, block and the block's bits. That finds every pair above the threshold (see _keys).

To keep passages that many documents share from filling buckets, tokens that occur very often are left
out of the sketch as long as the others fill d + 1 blocks; which ones does not affect the result.

Sets with a key in common are candidates. Each is compared with one leader per key (a star, so a group of
n copies costs n comparisons), a few times over with other leaders; what the links found do not already
connect is then compared in full.
Candidates pass the Hamming bound of whole parity sketches, then the exact test on the sets. Equal sets
are one node from the start. Only links between nodes already connected are left untested, so classes
are those of the full join.

Edge cases: null, empty and blank texts have no set, n_shingles 0 and a class of their own; texts of
fewer words than a shingle are one shingle; rows that repeat an id share its class; rows without an id
link as others do and have the smallest id of their class, null if none has an id; empty tables give no rows. Set ids are 64-bit hashes: two unequal sets of n share one with probability n * n / 2^65.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabweave.llm.common import bounded, bucketed, fresh, released, releasing, small_batches, stored, swept, table, trimmed
from tabweave.llm.components import components

GRAM, SHARE, WHOLE = 5, 80, 100
SLACK, GROWTH = 1.5, 1.25
SKETCH_LONGS = 16
ROUNDS = 1
#: Blocks of which each holds one token, nearly always.
FINE = 1 << 20
FLUSH = 1 << 21
#: Bytes of texts that are taken at once; a longer text is taken by itself.
STRETCH = 1 << 19
#: Words of more bytes are hashed one at a time.
LONG_WORD = 64
#: A shingle is left out of sketches if it is in so many of the documents; at most 2,000 times the mean set size of shingles are. Which are left out does not change results.
COMMON_SHARE, COMMON_LEAST = 2000, 64
#: As many of them at most are sent to the tasks, 16 MB: if there are more, the share is raised.
COMMON_MOST = 2_000_000
DESCRIBED = "doc_id long, row long, n_shingles long, sid long, token long, n long"
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], dtype=np.uint64)
#: Masks of the first bytes of eight.
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _words(raw: bytes, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each of the words raw[start:end], by eight bytes at a time; of long words by xxhash. Seven bytes at least follow the last word."""
    import xxhash

    length = end - start
    eight = np.ndarray(len(raw) - 7, dtype="<u8", buffer=raw, strides=(1,))
    h = _mix(_mix(length.astype(np.uint64)) ^ (eight[start] & _FIRST[np.minimum(length, 8)]))
    for k in range(8, LONG_WORD, 8):
        more = np.flatnonzero((length > k) & (length <= LONG_WORD))
        if not len(more):
            break
        h[more] = _mix(h[more] ^ (eight[start[more] + k] & _FIRST[np.minimum(length[more] - k, 8)]))
    for i in np.flatnonzero(length > LONG_WORD).tolist():
        h[i] = xxhash.xxh3_64_intdigest(raw[start[i]:end[i]])
    return h


def _shingled(raw: bytes, bounds: np.ndarray, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """The sets of the texts raw[bounds[i]:bounds[i + 1]], see shingle_sets(). bytes.lower() knows ASCII only, as the contract does."""
    raw = raw.lower() + bytes(8)
    byte = np.frombuffer(raw, dtype=np.uint8, count=len(raw) - 8)
    inside = (byte != 32) & ((byte - np.uint8(9)) > 4)
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    filled = bounds[1:] > bounds[:-1]
    for flags, edge in ((first, bounds[:-1][filled]), (last, bounds[1:][filled] - 1)):  # words end with their text
        flags[edge] = inside[edge]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    words = np.searchsorted(start, bounds)
    n, h = np.diff(words), _words(raw, start, end)
    counts = np.where(n >= gram, n - gram + 1, n > 0)
    at = np.concatenate([[0], np.cumsum(counts)])
    total = np.zeros(len(h), dtype=np.uint64)
    for k, factor in enumerate(_factors(gram, gram)[:len(h)]):
        total[:len(h) - k] += h[k:] * factor
    found = total[np.arange(at[-1]) + np.repeat(words[:-1] - at[:-1], counts)]
    for size in np.unique(n[(n > 0) & (n < gram)]).tolist():
        short = np.flatnonzero(n == size)
        found[at[short]] = (h[words[short][:, None] + np.arange(size)] * _factors(size, gram)).sum(axis=1, dtype=np.uint64)
    found = _mix(found)
    for a, b in pairwise(at.tolist()):
        if b - a > 1:
            found[a:b].sort()
    new = np.ones(len(found), dtype=bool)
    new[1:] = found[1:] != found[:-1]
    new[at[:-1][counts > 0]] = True
    return found[new], np.concatenate([[0], np.cumsum(new)])[at]


def _factors(size: int, gram: int) -> np.ndarray:
    return np.resize(_FACTORS, size) + np.arange(size, dtype=np.uint64) * np.uint64(2) + np.uint64(0 if size == gram else 2 * size * 1_000_003)


def shingle_sets(texts: pa.Array, gram: int = GRAM, size: int = STRETCH) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sorted distinct shingle hashes of each text, for texts of about `size` bytes at a time: (sets, at), of which sets[at[i]:at[i + 1]] is that of the i-th text."""
    if not len(texts):
        return
    texts = pc.fill_null(texts, "") if texts.null_count else texts
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64 if pa.types.is_large_string(texts.type) else np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    low = 0
    while low < len(texts):
        high = max(low + 1, int(np.searchsorted(bounds, bounds[low] + size, side="right")) - 1)
        length = int(bounds[high] - bounds[low])
        yield _shingled(data.slice(int(bounds[low]), length).to_pybytes() if length else b"", bounds[low:high + 1] - bounds[low], gram)
        low = high


def _each(sets: np.ndarray, at: np.ndarray) -> Iterator[np.ndarray]:
    return (sets[a:b] for a, b in pairwise(at.tolist()))


def set_id(found: np.ndarray) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(found.tobytes()) - (1 << 63)


class Bands:
    """Size bands [low, high), their difference bound d, and which bands a set of a size takes part in."""

    def __init__(self, share: int = SHARE, whole: int = WHOLE) -> None:
        self.share, self.whole, self.edges = share, whole, [1, 2]
        self.known: dict[int, list[tuple[int, int]]] = {}

    def of(self, size: int) -> list[tuple[int, int]]:
        """(band, d): the set's own, and those below that hold a smaller set it may be similar to."""
        if size in self.known:
            return self.known[size]
        edges = self.edges
        while edges[-1] <= size:
            edges.append(max(edges[-1] + 1, int(edges[-1] * GROWTH)))
        band = int(np.searchsorted(edges, size, side="right")) - 1
        out = []
        while band >= 0:
            most = edges[band + 1] - 1
            if most < size and self.share * size > self.whole * most:
                break
            out.append((band, (self.whole - self.share) * most // self.share))
            band -= 1
        if len(self.known) < 100_000:
            self.known[size] = out
        return out


def _n_blocks(d):
    return (SLACK * (d + 1)).astype(np.int64) + (d > 0)


def _blocks(tokens: np.ndarray, band: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the blocks that hold bits, and their bits' fingerprints: the XOR of a hash of every set position (of 2^20 a block)."""
    block = ((tokens >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)  # tokens are sorted, so blocks are
    position = (block << np.uint64(20)) | (tokens & np.uint64(0xFFFFF))
    starts = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
    bits = np.bitwise_xor.reduceat(_mix(position + np.uint64((band + 1) << 54)), starts)
    kept = bits != 0
    return block[starts][kept], bits[kept]


def _keys(tokens: np.ndarray, rare: np.ndarray, band: int, d: int) -> list[np.ndarray]:
    """Keys of a set in a band. Let A and B differ in at most d tokens.

    If the rare tokens of A fill d + 1 blocks, one of its first d + 1 is equal in B, and it is among B's first
    d + 1 as well if A's last lies no further than B's, else with A and B exchanged. If they fill fewer in
    both sets, the same holds of much finer blocks, which hold a rare token each, then of blocks of all tokens;
    failing all that, all of d + 1 blocks are emitted, empty ones included, of which one is equal."""
    n, out = int(_n_blocks(np.array(d))), []
    for mode, (of, blocks) in enumerate(((rare, n), (rare, FINE), (tokens, n))):
        block, bits = _blocks(of, band, blocks) if len(of) else (of, of)
        take = slice(0, d + 1)
        out.append(_mix(bits[take] ^ _mix(block[take] * np.uint64(4) + np.uint64(mode) + np.uint64(band << 40))))
        if len(block) > d:
            return out
    whole = np.zeros(d + 1, dtype=np.uint64)
    block, bits = _blocks(tokens, band, d + 1)
    whole[block.astype(np.int64)] = bits
    out.append(_mix(whole ^ _mix(np.arange(d + 1, dtype=np.uint64) * np.uint64(4) + np.uint64(3) + np.uint64(band << 40))))
    return out


def _keys_of(sets: np.ndarray, at: np.ndarray, chosen: np.ndarray, often: np.ndarray, bands: Bands) -> tuple[np.ndarray, np.ndarray]:
    """Keys as by _keys() of the chosen ones of a stretch of sets (see shingle_sets), and of which set each is. `often`: sorted common tokens.

    All sets and bands at once. Those whose rare tokens do not fill d + 1 blocks, and very large sets, are left to _keys()."""
    if len(often):
        rarely = often[np.minimum(np.searchsorted(often, sets), len(often) - 1)] != sets
        rare, rare_at = sets[rarely], np.concatenate([[0], np.cumsum(rarely)])[at]
    else:
        rare, rare_at = sets, at
    pairs = [(i, band, d) for i, size in zip(chosen.tolist(), np.diff(at)[chosen].tolist(), strict=True) for band, d in bands.of(size)]
    of, band, d = (np.array(x, dtype=np.int64) for x in zip(*pairs, strict=True))
    large = np.diff(at)[of] > STRETCH
    lengths = np.where(large, 0, np.diff(rare_at)[of])
    starts = np.cumsum(lengths) - lengths
    tokens = rare[np.arange(int(lengths.sum())) + np.repeat(rare_at[of] - starts, lengths)]
    block = ((tokens >> np.uint64(32)) * np.repeat(_n_blocks(d).astype(np.uint64), lengths)) >> np.uint64(32)
    bits = _mix(((block << np.uint64(20)) | (tokens & np.uint64(0xFFFFF))) + np.repeat((band + 1).astype(np.uint64) << np.uint64(54), lengths))
    new = np.ones(len(block), dtype=bool)
    new[1:] = block[1:] != block[:-1]
    new[starts[lengths > 0]] = True
    heads = np.flatnonzero(new)
    bits = np.bitwise_xor.reduceat(bits, heads) if len(heads) else bits
    pair = np.searchsorted(starts, heads, side="right") - 1  # of pairs without tokens that begin where another does, the last has them
    heads, bits, pair = (x[bits != 0] for x in (heads, bits, pair))
    filled = np.bincount(pair, minlength=len(of))
    enough = (filled > d) & ~large
    take = (np.arange(len(pair)) - (np.cumsum(filled) - filled)[pair] <= d[pair]) & enough[pair]
    heads, bits, pair = heads[take], bits[take], pair[take]
    keys = [_mix(bits ^ _mix(block[heads] * np.uint64(4) + (band[pair].astype(np.uint64) << np.uint64(40))))]
    whose = [of[pair]]
    for i, b, most in (pairs[k] for k in np.flatnonzero(~enough).tolist()):
        for part in _keys(sets[at[i]:at[i + 1]], rare[rare_at[i]:rare_at[i + 1]], b, most):
            keys.append(part)
            whose.append(np.full(len(part), i, dtype=np.int64))
    return np.concatenate(keys), np.concatenate(whose)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _describe(gram: int):
    """One pass over the texts: a row for each document, and (token, n) for shingles met twice or more among the distinct sets of a stretch of documents."""
    names, kinds = [x.split(" ")[0] for x in DESCRIBED.split(", ")], [pa.int64()] * 6

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, seen = [], 0, set()

        def flush() -> pa.RecordBatch:
            every = np.concatenate(held)
            held.clear()
            every.sort()
            starts = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
            counts = np.diff(np.append(starts, len(every)))
            often = counts > 1
            none = pa.nulls(int(often.sum()), pa.int64())
            return pa.RecordBatch.from_arrays([none, none, none, none, pa.array(_signed(every[starts[often]])), pa.array(counts[often])], names)

        for batch in batches:
            n, ids = [], []
            for found in (x for stretch in shingle_sets(batch.column(1), gram) for x in _each(*stretch)):
                n.append(len(found))
                ids.append(set_id(found) if len(found) else None)
                if len(found) and ids[-1] not in seen:
                    seen.add(ids[-1])
                    held.append(found.copy())  # not a part of its stretch
                    size += len(found)
                if size > FLUSH:
                    yield flush()
                    size, seen = 0, set()
            none = pa.nulls(len(n), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip((batch.column(0), batch.column(2), n, ids, none, none), kinds, strict=True)], names)
        if held:
            yield flush()
    return run


def _emit(gram: int, share: int, whole: int, common):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands, often, seen, keys, ids, size = Bands(share, whole), common.value, set(), [], [], 0

        def out():
            return pa.RecordBatch.from_arrays([pa.array(_signed(np.concatenate(keys))), pa.array(np.concatenate(ids))], ["key", "sid"])

        for sets, at in (stretch for batch in batches for stretch in shingle_sets(batch.column(0), gram)):
            own, chosen = np.zeros(len(at) - 1, dtype=np.int64), []
            for i, found in enumerate(_each(sets, at)):
                if not len(found) or (sid := set_id(found)) in seen:  # copies met before need not be sent again
                    continue
                seen.add(sid)
                own[i] = sid
                chosen.append(i)
            if chosen:
                part, whose = _keys_of(sets, at, np.array(chosen), often, bands)
                keys.append(part)
                ids.append(own[whose])
                size += len(part)
            if size > 200_000:
                yield out()
                keys, ids, size = [], [], 0
            if len(seen) > 200_000:
                seen.clear()
        if keys:
            yield out()
    return run


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Input sorted by key, sid; output key, sid, leader for keys with more than one sid. Holds one batch and the last row."""
    last = None  # key, sid of the row held back, leader, whether it has been sent
    for batch in batches:
        if not batch.num_rows:
            continue
        key, sid = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        if last is not None:
            key, sid = np.concatenate([[last[0]], key]), np.concatenate([[last[1]], sid])
        new = np.concatenate([[True], (key[1:] != key[:-1]) | (sid[1:] != sid[:-1])])
        key, sid = key[new], sid[new]
        head = np.concatenate([[True], key[1:] != key[:-1]])
        start = np.maximum.accumulate(np.where(head, np.arange(len(key)), 0))
        leader = sid[start].copy()
        carried = last is not None
        if carried:  # the first run goes on from before
            leader[start == 0] = last[2]
        more = np.concatenate([key[1:] == key[:-1], [False]])
        out = ~head | more
        if carried and last[3]:
            out[0] = False
        elif carried and last[2] != last[1]:
            out[0] = True
        tail = len(key) - 1
        sent = bool(out[tail]) or (tail == 0 and carried and last[3])
        last = (key[tail], sid[tail], leader[tail], sent)
        if out.any():
            yield pa.RecordBatch.from_arrays([pa.array(key[out]), pa.array(sid[out]), pa.array(leader[out])], ["key", "sid", "leader"])


def _sets(gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            ids, n, sketches, sets = [], [], [], []
            every = (x for stretch in shingle_sets(batch.column(0), gram) for x in _each(*stretch))
            for found, repeated in zip(every, batch.column(1).to_pylist(), strict=True):
                own = set_id(found)
                if repeated:
                    if own in seen:
                        continue
                    seen.add(own)
                ids.append(own)
                n.append(len(found))
                flips = np.bincount((found & np.uint64(64 * SKETCH_LONGS - 1)).astype(np.int64), minlength=64 * SKETCH_LONGS) & 1
                sketches.append(np.packbits(flips.astype(np.uint8)).view(np.int64))
                sets.append(_signed(found))
            if len(seen) > 200_000:
                seen.clear()
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(sketches, pa.list_(pa.int64())), pa.array(sets, pa.list_(pa.int64()))], ["sid", "n", "sketch", "tokens"])
    return run


def verified(pairs: DataFrame, sets: DataFrame, tag: str, share: int = SHARE, whole: int = WHOLE) -> DataFrame:
    """Those of pairs (a, b: sids) that link, stored: Hamming bound of the parity sketches first, then the exact test."""
    short = sets.select("sid", "n", "sketch")
    side = lambda x, of=short: of.select(*(F.col(c).alias(x if c == "sid" else f"{c}_{x}") for c in of.columns))
    apart = F.aggregate(F.zip_with("sketch_a", "sketch_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    near = pairs.join(side("a"), "a").join(side("b"), "b")
    near = near.where((share * F.greatest("n_a", "n_b") <= whole * F.least("n_a", "n_b")) & ((whole + share) * apart <= (whole - share) * (F.col("n_a") + F.col("n_b")))).select("a", "b")
    with releasing() as keep:
        near = keep(near, "near")  # its size is known then, so few pairs fetch their sets without dealing out all sets
        both = near.join(side("a", sets.select("sid", "n", "tokens")), "a").join(side("b", sets.select("sid", "n", "tokens")), "b")
        shared = F.size(F.array_intersect("tokens_a", "tokens_b"))
        return stored(both.where(whole * shared >= share * (F.col("n_a") + F.col("n_b") - shared)).select("a", "b"), tag)


def _connected(multi: DataFrame, sets: DataFrame, share: int, whole: int, rounds: int = ROUNDS) -> DataFrame:
    """multi: key, sid, leader of sets with a key in common. Returns node, root of the components of all links among them.

    Each round compares every set with one leader per key, its first at first and then one drawn anew, unless
    both are connected already; that is one comparison a row. Keys whose sets are all connected are done. What
    is left after the rounds is compared in full: all pairs of a key's sets that are in different components."""
    rows = multi.join(sets.select("sid", "n"), "sid").select("key", "sid", "n", "leader", F.col("sid").alias("root"))
    known, opened, pairs, turn = None, None, multi.where("sid <> leader").select(F.col("leader").alias("a"), F.col("sid").alias("b")).distinct(), 0
    while True:
        linked = verified(pairs, sets, "linked", share, whole)
        links = linked
        if known is not None:
            old = known.select(F.col("node"), F.col("root").alias("at"))
            links = links.join(old.select(F.col("node").alias("a"), F.col("at").alias("x")), "a", "left").join(old.select(F.col("node").alias("b"), F.col("at").alias("y")), "b", "left").select(F.coalesce("x", "a").alias("a"), F.coalesce("y", "b").alias("b"))
        merged = components(links)
        if known is None:
            known = merged
        else:  # roots of roots, and nodes linked for the first time
            before = known
            known = stored(known.join(merged.select(F.col("node").alias("root"), F.col("root").alias("to")), "root", "left").select("node", F.coalesce("to", "root").alias("root")).unionByName(merged.join(known.select("node"), "node", "left_anti").select("node", "root")), "roots")
            released(before)
        released(linked)
        if turn > rounds:
            released(opened)
            return known
        turn += 1
        rows = rows.drop("root").join(known.select(F.col("node").alias("sid"), "root"), "sid", "left").withColumn("root", F.coalesce("root", "sid"))
        before, opened = opened, stored(rows.select("key", "sid", "n", "leader", "root"), "open")
        released(before)
        rows = opened
        still = rows.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y"), F.min(F.struct(F.xxhash64(F.lit(turn), "sid").alias("h"), F.col("sid").alias("a"), F.col("n").alias("m"), F.col("root").alias("r"))).alias("drawn")).where("x <> y").select("key", "drawn")
        near = lambda m, n: share * F.greatest(m, n) <= whole * F.least(m, n)
        if turn <= rounds:
            rows = rows.join(still, "key")
            pairs = rows.where((F.col("drawn.r") != F.col("root")) & near("drawn.m", "n")).select(F.col("drawn.a").alias("a"), F.col("sid").alias("b")).distinct()
            rows = rows.drop("drawn")
        else:
            # The Hamming bound is part of the join's condition, so what cannot link is never a row.
            bits = [f"s{i}" for i in range(SKETCH_LONGS)]
            rows = rows.join(still.select("key"), "key", "left_semi").join(sets.select("sid", *(F.col("sketch")[i].alias(c) for i, c in enumerate(bits))), "sid")
            a, b = rows.alias("a"), rows.alias("b")
            differ = reduce(lambda x, y: x + y, (F.bit_count(F.col(f"a.{c}").bitwiseXOR(F.col(f"b.{c}"))) for c in bits))
            apart = (F.col("a.key") == F.col("b.key")) & (F.col("a.root") < F.col("b.root")) & (F.col("a.sid") != F.col("a.leader")) & (F.col("b.sid") != F.col("b.leader")) & near("a.n", "b.n")
            apart = apart & ((whole + share) * differ <= (whole - share) * (F.col("a.n") + F.col("b.n")))
            pairs = a.join(b, apart).select(F.col("a.sid").alias("a"), F.col("b.sid").alias("b")).distinct()


def _common(facts: DataFrame, least: int) -> np.ndarray:
    """Sorted shingles that `least` documents or more hold, of which there are COMMON_MOST at most: least is raised until then."""
    sums = facts.where("token IS NOT NULL").groupBy("token").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    with releasing() as keep:
        sums = keep(sums, "common")
        while sums.where(F.col("n") >= least).count() > COMMON_MOST:
            least *= 2
        return np.sort(sums.where(F.col("n") >= least).select("token").toArrow().column(0).to_numpy().astype(np.int64).view(np.uint64))


def jaccard_classes(docs: DataFrame, gram: int = GRAM, share: int = SHARE, whole: int = WHOLE) -> DataFrame:
    """docs: doc_id, text. Returns doc_id, n_shingles, component_id for every row; documents link if whole * |A and B| >= share * |A or B|."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("row"))  # row: to fetch texts by, with and without an id
    with small_batches(spark):
        facts = stored(docs.mapInArrow(trimmed(_describe(gram)), DESCRIBED), "sets")
    described = facts.where("token IS NULL").select("doc_id", "row", "n_shingles", "sid")
    by_set = described.where("sid IS NOT NULL").groupBy("sid").agg(F.min("doc_id").alias("first"), F.min("row").alias("row"), F.count("*").alias("__n"))
    common = spark.sparkContext.broadcast(_common(facts, max(COMMON_LEAST, described.count() // COMMON_SHARE)))
    emitted = docs.select("text").mapInArrow(trimmed(_emit(gram, share, whole, common)), "key long, sid long")
    with releasing() as keep:
        with small_batches(spark):
            multi = keep(emitted.repartition("key").sortWithinPartitions("key", "sid").mapInArrow(trimmed(_runs), "key long, sid long, leader long"), "keys")
        rows = described.where("sid IS NOT NULL").groupBy("row").agg((F.count("*") > 1).alias("repeated"))
        wanted = bounded(multi.select("sid").distinct().join(by_set, "sid").select("row").distinct().join(rows, "row"), "wanted", keep=keep)
        with small_batches(spark):  # in buckets, as each round of tests joins the sets twice
            sets = bucketed(docs.join(wanted, "row").select("text", "repeated").mapInArrow(trimmed(_sets(gram)), "sid long, n long, sketch array<long>, tokens array<long>").dropDuplicates(["sid"]), "tokens", "sid")
        swept(spark)
        roots = stored(_connected(multi, sets, share, whole), "classes")
        released(sets)
    of_set = by_set.join(roots.select(F.col("node").alias("sid"), "root"), "sid", "left").select("sid", "first", F.coalesce("root", "sid").alias("root"))
    smallest = of_set.groupBy("root").agg(F.min("first").alias("component"))
    classes = of_set.join(smallest, "root").select("sid", "component")
    linked = by_set.where("__n > 1").select("sid").union(roots.select(F.col("node").alias("sid"))).distinct()
    return described.join(classes.join(linked, "sid", "left_semi"), "sid", "left").select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def deduplicated(docs: DataFrame, **options) -> DataFrame:
    """docs with one document of each class, the one of the smallest id. Documents without words and rows without an id stay; rows that repeat an id stay or go together."""
    [gone_id] = fresh(docs.columns, "__id")
    classes = jaccard_classes(docs, **options).select(F.col("doc_id").alias(gone_id), F.col("component_id").alias("__class")).distinct()
    gone = bounded(classes.where(F.col(gone_id) != F.col("__class")).select(gone_id).distinct(), "gone")
    return docs.join(gone, F.col("doc_id") == F.col(gone_id), "left_anti")


def op6_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sets of 4-word shingles, linked from 85 in 100."""
    return jaccard_classes(table(spark, sf_dir, "documents"), gram=4, share=85)


OP6_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s FROM w),
e AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
l AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
r AS (SELECT doc_id AS node, doc_id AS root FROM documents UNION SELECT l.b, r.root FROM r JOIN l ON r.node = l.a)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, m.root AS component_id FROM s JOIN (SELECT node, min(root) AS root FROM r GROUP BY node) m ON m.node = s.doc_id
"""
