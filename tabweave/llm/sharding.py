"""Uniform sharding by a hypergeometric communication matrix.

Rows are dealt to fixed hash cells (the source partitions). How many rows each cell sends to each
shard is drawn exactly, without replacement, from the shards' capacities, so that shard sizes come
out exact and the whole is a uniform shuffle: a local permutation ranks the rows of a cell, the
rank picks the shard, rows are exchanged, and a second permutation ranks them within the shard.

Edge cases: null ids and texts hash like any other value; fully repeated rows are interchangeable
and each gets a slot of its own; an empty table gives no rows; input columns are carried unchanged
(columns named like an output column, in any case, are replaced).
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabweave.llm.common import table

CELLS, BUCKETS, SHARDS = 4096, 256, 24


def hypergeometric(good: int, bad: int, draws: int, rng: np.random.Generator) -> int:
    """How many of `draws` drawn without replacement are good: inversion over the mass around the mode, at any population size."""
    total = good + bad
    low, high = max(0, draws - bad), min(draws, good)
    if low >= high:
        return low
    mode = min(max((draws + 1) * (good + 1) // (total + 2), low), high)
    sd = math.sqrt(draws * (good / total) * (bad / total) * (total - draws) / max(1, total - 1))
    reach = int(14 * sd) + 30
    first, last = max(low, mode - reach), min(high, mode + reach)
    k = np.arange(first, last, dtype=np.float64)
    step = np.log((good - k) * (draws - k)) - np.log((k + 1) * (bad - draws + k + 1))
    logp = np.concatenate([[0.0], np.cumsum(step)])
    mass = np.cumsum(np.exp(logp - logp.max()))
    return first + int(min(np.searchsorted(mass, rng.random() * mass[-1], side="right"), last - first))


def communication_matrix(cells: dict[int, int], shards: list[int], seed: int) -> dict[int, list[int]]:
    """For each cell the upper bounds of the ranks that go to each shard. Row sums are cell sizes, column sums shard sizes, both exact."""
    rng = np.random.default_rng(seed)
    free, out = list(shards), {}
    for cell in sorted(cells):
        left, rest, bounds = cells[cell], sum(free), []
        for s in range(len(free)):
            take = hypergeometric(free[s], rest - free[s], left, rng) if left else 0
            rest -= free[s]
            free[s] -= take
            left -= take
            bounds.append(take)
        out[cell] = np.cumsum(bounds).tolist()
    return out


def shuffle_to_shards(rows: DataFrame, keys: list[Column], n_shards: int = SHARDS, seed: int = 20240607, cells: int = CELLS, buckets: int = BUCKETS) -> DataFrame:
    """rows with shard (0 to n_shards - 1, sizes at most one apart) and slot (gapless from 0 in each shard), a uniform random permutation.

    keys identify a row; ties among them are broken by all columns. cells and buckets fix the number of
    sort groups, so no task has to hold more than a small share of the rows."""
    spark = rows.sparkSession
    rows = rows.select(*(c for c in rows.columns if c.lower() not in ("shard", "slot", "__deal", "__again", "__cell", "__bucket", "__tie")))
    atomic = [F.col(f"`{n}`") for n, t in rows.dtypes if "map<" not in t and t != "variant"]
    dealt = rows.withColumns({
        "__deal": F.xxhash64(F.lit(seed), *keys), "__again": F.xxhash64(F.lit(seed + 1), *keys), "__tie": F.xxhash64(*atomic),
    }).withColumn("__cell", F.pmod(F.xxhash64(F.lit(seed + 2), "__deal"), F.lit(cells)).cast("int"))
    sizes = {r[0]: r[1] for r in dealt.groupBy("__cell").count().collect()}  # one row a cell
    n = sum(sizes.values())
    plan = communication_matrix(sizes, [n // n_shards + (s < n % n_shards) for s in range(n_shards)], seed)
    matrix = spark.createDataFrame(sorted(plan.items()), "__cell int, __bounds array<bigint>")
    local = Window.partitionBy("__cell").orderBy("__deal", "__tie")
    sent = (dealt.withColumn("__rank", F.row_number().over(local) - 1).join(F.broadcast(matrix), "__cell")  # at most `cells` rows
            .withColumn("shard", F.size(F.filter("__bounds", lambda b: b <= F.col("__rank"))))
            .withColumn("__bucket", F.pmod(F.shiftright("__again", 32), F.lit(buckets)).cast("int")))
    before = Window.partitionBy("shard").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sent.groupBy("shard", "__bucket").agg(F.count("*").alias("__n")).withColumn("__start", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    again = Window.partitionBy("shard", "__bucket").orderBy("__again", "__tie")
    return (sent.withColumn("__place", F.row_number().over(again) - 1)
            .join(F.broadcast(starts.drop("__n")), ["shard", "__bucket"])  # n_shards * buckets rows at most
            .select(*(F.col(f"`{c}`") for c in rows.columns), "shard", (F.col("__start") + F.col("__place")).cast("long").alias("slot")))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents into shards 0 to 23 under the law `rows`. Empty texts have size 8 and crc 0."""
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, sf_dir, "documents").select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    out = shuffle_to_shards(docs, [F.col("doc_id"), F.col("text_crc32"), F.col("size")])
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
