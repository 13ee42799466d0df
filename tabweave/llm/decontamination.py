"""Benchmark decontamination by a broadcast hash set of normalised test n-grams.

Windows of test items are hashed and broadcast in sets of a fixed size; every window of the training
texts is hashed and probed against them, hits are verified by comparing the words themselves, and
documents or the hit spans are removed. Only DataFrame functions run on the data.

Edge cases: null and empty texts have no words and no hits; items of fewer than 13 words are one
window; repeated items and repeated windows count once per item id; null item ids are listed as the
empty string; repeated rows each get their own result; empty tables give empty or clean results; very long
texts are read whole; further columns are carried, whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabweave.llm.common import ascii_lower, bounded, fresh, split_words, table

WINDOW = 13
#: What is neither a digit, an ASCII letter nor beyond ASCII separates words (after lower-casing, capitals are gone).
SEPARATORS = "\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F"
#: The same before lower-casing.
OUTSIDE = "\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F"
#: Windows broadcast at once: about 150 bytes each, so 75 MB at most. More windows take more passes.
BROADCAST_WINDOWS = 500_000


def words(text: Column) -> Column:
    return split_words(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS)


def _hashed(of: Column) -> Column:
    return F.transform(of, lambda w: F.xxhash64(w))


def _windows_of(hashes: Column, room: Column, n: int) -> Column:
    return F.transform(F.sequence(F.lit(1), room), lambda i: F.xxhash64(F.slice(hashes, i, n)))


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct windows: __len, __hash, __window (its words, joined) and __items (ids as strings)."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("__item"), words(F.col("text")).alias("__w")).where(F.size("__w") > 0)
    at = items.select("__item", "__w", F.least(F.size("__w"), F.lit(window)).alias("__len")).select("__item", "__w", "__len", F.explode(F.sequence(F.lit(1), F.size("__w") - F.col("__len") + 1)).alias("__at"))
    cut = at.select("__item", "__len", F.slice("__w", F.col("__at"), F.col("__len")).alias("__cut"))
    found = cut.select("__item", "__len", F.array_join("__cut", " ").alias("__window"), F.xxhash64(_hashed(F.col("__cut"))).alias("__hash"))
    return found.groupBy("__len", "__hash", "__window").agg(F.collect_set("__item").alias("__items"))


def find_hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """One row per verified occurrence: doc_id, __key (of the text), __at (first word, from 0), __len, __items."""
    windows = benchmark_windows(benchmark, window)
    lengths = {r[0]: r[1] for r in windows.groupBy("__len").count().collect()}  # `window` rows at most
    parts = max(1, -(-sum(lengths.values()) // broadcast_windows))
    of = docs.select("doc_id", text_key(F.col("text")).alias("__key"), words(F.col("text")).alias("__w"))
    of = of.withColumn("__h", _hashed(F.col("__w")))
    probes, start, starts = [], F.lit(0), {}
    for n in sorted(lengths):
        room = F.greatest(F.size("__h") - (n - 1), F.lit(0))
        probes.append(F.when(room > 0, _windows_of(F.col("__h"), room, n)).otherwise(F.array().cast("array<bigint>")))
        starts[n] = start
        start = start + room
    if not probes:
        return of.select("doc_id", "__key", F.lit(0).alias("__at"), F.lit(0).alias("__len"), F.array().cast("array<string>").alias("__items")).where(F.lit(False))
    probed = of.select("doc_id", "__key", "__w", *(starts[n].alias(f"__s{n}") for n in starts), F.posexplode(F.concat(*probes)).alias("__at", "__hash"))
    begin = reduce(lambda e, n: e.when(F.col("__len") == n, F.col(f"__s{n}")), starts, F.when(F.lit(False), 0)).otherwise(0)
    found = []
    for k in range(parts):
        chosen = windows if parts == 1 else windows.where(F.pmod("__hash", F.lit(parts)) == k)
        hit = probed.join(F.broadcast(chosen), "__hash").withColumn("__at", F.col("__at") - begin)
        found.append(hit.where(F.array_join(F.slice("__w", F.col("__at") + 1, F.col("__len")), " ") == F.col("__window")).select("doc_id", "__key", "__at", "__len", "__items"))
    return reduce(DataFrame.unionByName, found)


def text_key(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")).cast("binary"))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row of docs: doc_id, __key, n_words, __spans (hit [first, end) word spans, sorted), n_hit, __items (sorted)."""
    hits = find_hits(docs, benchmark, window).groupBy("doc_id", "__key").agg(
        F.array_sort(F.collect_set(F.struct(F.col("__at").alias("first"), (F.col("__at") + F.col("__len")).alias("end")))).alias("__spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("__items")))).alias("__items"))
    covered = F.aggregate("__spans", F.struct(F.lit(0).alias("n"), F.lit(0).alias("to")), lambda a, s: F.struct(
        (a["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(s["first"], a["to"]))).alias("n"), F.greatest(a["to"], s["end"]).alias("to")), lambda a: a["n"])
    hits = hits.select(F.col("doc_id").alias("__doc"), F.col("__key").alias("__text"), "__spans", "__items", covered.cast("long").alias("__hit"))
    base = docs.select("doc_id", text_key(F.col("text")).alias("__key"), F.size(words(F.col("text"))).cast("long").alias("n_words"))
    return (base.join(hits, F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("__key") == F.col("__text")), "left")
            .select("doc_id", "__key", "n_words", "__spans", F.coalesce("__hit", F.lit(0)).alias("n_hit"), F.coalesce("__items", F.array().cast("array<string>")).alias("__items")))


def decontaminate(docs: DataFrame, benchmark: DataFrame, mode: str = "document", share: int = 20, window: int = WINDOW) -> DataFrame:
    """docs without contaminated documents (a `share`-th of the words hit, at least), or, in mode "span", with the hit words cut out of every text.

    A word goes with the separators before it."""
    columns = docs.columns
    doc, key, spans = fresh(columns, "__doc", "__text", "__spans")
    found = contamination(docs, benchmark, window).where(F.col("n_hit") > 0)
    if mode == "document":
        found = found.where(share * F.col("n_hit") >= F.col("n_words"))
    found = found.groupBy(F.col("doc_id").alias(doc), F.col("__key").alias(key)).agg(F.first("__spans").alias(spans))
    if mode == "document":
        found = bounded(found.drop(spans), "contaminated")
    same = F.col("doc_id").eqNullSafe(F.col(doc)) & (text_key(F.col("text")) == F.col(key))
    if mode == "document":
        return docs.join(found, same, "left_anti")
    pieces = F.split(F.col("text"), f"(?<=[^{OUTSIDE}])(?=[{OUTSIDE}])")  # each word with what stands before it
    kept = F.array_join(F.filter(pieces, lambda p, i: ~F.exists(spans, lambda s: (s["first"] <= i) & (i < s["end"]))), "")
    joined = docs.join(found, same, "left")
    return joined.select(*(F.when(F.col(spans).isNull(), F.col("text")).otherwise(kept).alias("text") if c == "text" else F.col(f"`{c}`") for c in columns))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", F.size("__items").cast("long").alias("n_items"), F.sha2(F.array_join("__items", ","), 256).alias("items_sha256"),
                      ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"))


OP10_SQL = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
bl AS (SELECT item, w, least(13, len(w)) AS l FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item, l, array_to_string(w[i:i + l - 1], ' ') AS g FROM (SELECT item, w, l, unnest(range(1, len(w) - l + 2)) AS i FROM bl)),
dw AS (SELECT doc_id, i, l, array_to_string(w[i:i + l - 1], ' ') AS g FROM (SELECT doc_id, w, l, unnest(range(1, len(w) - l + 2)) AS i FROM d, (SELECT DISTINCT l FROM bl) WHERE len(w) >= l)),
h AS (SELECT doc_id, i, dw.l, item FROM dw JOIN bw ON dw.g = bw.g AND dw.l = bw.l),
c AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + l)) AS p FROM (SELECT DISTINCT doc_id, i, l FROM h)) GROUP BY 1),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY 1)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN c ON d.doc_id = c.doc_id LEFT JOIN t ON d.doc_id = t.doc_id
"""
