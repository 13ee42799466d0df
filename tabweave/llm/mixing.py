"""Mixing sources to target weights by a low-discrepancy schedule.

Targets in words come from weights, with at most `most` times a source's size; what is above is
shared out again. A source's documents lie end to end in a shuffled order, repeated as often as its
target asks, and are cut into blocks of equal length. The grid 0 .. 2^m - 1, at least one point a
block, is divided among the sources in proportion to their blocks (the cumulative weights); the
van der Corput bit reversal of a grid point is its slot in the mix. A source's slots are ranked and
the r-th takes its r-th block: an interval of the grid with k blocks holds at least k points, so
every block gets a slot, and any stretch of slots holds the sources in near their proportions.

Edge cases: documents without words (null or empty text) take no part and have taken 0; null is a
source of its own; repeated rows are documents of their own;
an empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabweave.llm.common import SPACE, n_words, stored, table

BLOCK, MOST, CHUNKS, SPAN = 1024, 3, 4096, 4096


def targets(sizes: DataFrame, most: int = MOST) -> DataFrame:
    """Per source (one row each in sizes: source, source_size): weights 1, 2, 3, repeating by code point, null last; target.

    With r = most * source_size / weight, sources are capped in the order of r while r is below the level
    that the others would get; that is one pass over the sources ordered by r."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("weight", ((F.row_number().over(order) - 1) % 3 + 1).cast("double"))
    by_room = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    level = (F.sum("source_size").over(whole) - most * F.coalesce(F.sum("source_size").over(before), F.lit(0))) / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    filled = ranked.withColumn("__level", level).withColumn("__capped", F.col("__level") * F.col("weight") > most * F.col("source_size"))
    filled = filled.withColumn("__level", F.min(F.when(~F.col("__capped"), F.struct(F.col("source_size") / F.col("weight"), "__level"))).over(whole)["__level"])
    return filled.select("source", "source_size", "weight", F.when(F.col("__capped"), most * F.col("source_size")).otherwise(F.col("__level") * F.col("weight")).cast("double").alias("target"))


def reversed_bits(value: Column, bits: int) -> Column:
    """The lowest `bits` bits of a long in reverse order."""
    for k in (1, 2, 4, 8, 16, 32):
        mask = sum(((1 << k) - 1) << s for s in range(0, 64, 2 * k))
        value = F.shiftrightunsigned(value, k).bitwiseAND(F.lit(mask)).bitwiseOR(F.shiftleft(value.bitwiseAND(F.lit(mask)), k))
    return F.shiftrightunsigned(value, 64 - bits) if bits else F.lit(0).cast("long")


def schedule(blocks: DataFrame, bits: int, total: int) -> DataFrame:
    """blocks: source, __blocks, __before (blocks of the sources before it). Returns source, __block, slot."""
    grid = 1 << bits
    edge = lambda c: F.expr(f"(cast({c} as decimal(19,0)) * cast({grid} as decimal(19,0)) + {total - 1}) div {total}")
    ranges = blocks.select("source", "__blocks", edge("__before").alias("__low"), edge("(__before + __blocks)").alias("__high")).where(F.col("__high") > F.col("__low"))
    spans = ranges.select("source", "__blocks", "__high", F.explode(F.sequence("__low", F.col("__high") - 1, F.lit(SPAN).cast("long"))).alias("__from")).repartition("source", "__from")
    points = spans.select("source", "__blocks", F.explode(F.sequence(F.col("__from"), F.least(F.col("__from") + SPAN, F.col("__high")) - 1)).alias("__point"))
    slots = points.select("source", "__blocks", reversed_bits(F.col("__point"), bits).alias("slot"))
    cut = slots.withColumn("__chunk", F.shiftright("slot", max(0, bits - 10)))  # 1024 stretches of the mix, each holding every source in proportion
    counts = cut.groupBy("source", "__chunk").agg(F.count("*").alias("__n"))
    starts = counts.withColumn("__start", F.coalesce(F.sum("__n").over(Window.partitionBy("source").orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("__n")
    rank = F.row_number().over(Window.partitionBy("source", "__chunk").orderBy("slot")) - 1
    ranked = cut.withColumn("__rank", rank).alias("c").join(starts.alias("s"), F.col("c.source").eqNullSafe(F.col("s.source")) & (F.col("c.__chunk") == F.col("s.__chunk")))
    return ranked.select("c.source", "__blocks", "slot", (F.col("__start") + F.col("__rank")).alias("__block")).where(F.col("__block") < F.col("__blocks")).drop("__blocks")


def mix(docs: DataFrame, block: int = BLOCK, most: int = MOST, seed: int = 7, chunks: int = CHUNKS) -> tuple[DataFrame, DataFrame]:
    """docs: __row (anything that tells rows apart), source, size. Returns (sources with targets, pieces).

    A piece is a run of one document's words in one block: __row, source, __epoch, __block, __from (its place in the block), slot, __first
    (its place in the document), __words; the pieces by slot and __from are the mix. Columns of docs beside these are not read."""
    sources = stored(targets(stored(docs.groupBy("source").agg(F.sum("size").alias("source_size")), "sizes"), most), "targets")
    line = sources.withColumn("__length", F.least(F.round("target").cast("long"), most * F.col("source_size"))).withColumn("__blocks", F.ceil(F.col("__length") / block).cast("long"))
    line = line.withColumn("__before", F.coalesce(F.sum("__blocks").over(Window.orderBy(F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    line = stored(line, "line")
    total = line.agg(F.sum("__blocks")).first()[0] or 0
    bits = max(0, (total - 1).bit_length()) if total else 0
    slots = stored(schedule(line.where(F.col("__blocks") > 0), bits, max(total, 1)), "schedule")
    key = F.xxhash64(F.lit(seed), "__row")
    placed = docs.where(F.col("size") > 0).withColumn("__key", key).withColumn("__chunk", F.pmod(F.shiftright("__key", 32), F.lit(chunks)).cast("int"))
    sums = placed.groupBy("source", "__chunk").agg(F.sum("size").alias("__n"))
    starts = sums.withColumn("__start", F.coalesce(F.sum("__n").over(Window.partitionBy("source").orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("__n")
    at = F.coalesce(F.sum("size").over(Window.partitionBy("source", "__chunk").orderBy("__key", "__row").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    heads = starts.alias("s").join(line.alias("l"), F.col("s.source").eqNullSafe(F.col("l.source"))).select(F.col("s.source").alias("__source"), F.col("s.__chunk").alias("__c"), "__start", "source_size", "__length")
    put = placed.withColumn("__in", at).join(heads, F.col("source").eqNullSafe(F.col("__source")) & (F.col("__chunk") == F.col("__c")))
    copies = put.select("__row", "source", "size", "source_size", "__length", (F.col("__start") + F.col("__in")).alias("__at"), F.explode(F.sequence(F.lit(0), F.lit(most - 1))).alias("__epoch"))
    copies = copies.withColumn("__at", F.col("__at") + F.col("__epoch") * F.col("source_size")).withColumn("__end", F.least(F.col("__at") + F.col("size"), F.col("__length"))).where(F.col("__at") < F.col("__end"))
    pieces = copies.select("__row", "source", "__epoch", "__at", "__end", F.explode(F.sequence((F.col("__at") / block).cast("long"), ((F.col("__end") - 1) / block).cast("long"))).alias("__block"))
    pieces = pieces.select("__row", "source", "__epoch", "__block", (F.greatest(F.col("__at"), F.col("__block") * block) - F.col("__block") * block).alias("__from"), (F.greatest(F.col("__at"), F.col("__block") * block) - F.col("__at")).alias("__first"),
                           (F.least(F.col("__end"), (F.col("__block") + 1) * block) - F.greatest(F.col("__at"), F.col("__block") * block)).alias("__words"))
    joined = pieces.alias("p").join(slots.alias("t").hint("merge"), F.col("p.source").eqNullSafe(F.col("t.source")) & (F.col("p.__block") == F.col("t.__block")))
    return sources, joined.select("p.__row", "p.source", "p.__epoch", "p.__block", "p.__from", "t.slot", "p.__first", "p.__words")


def _alike(docs: DataFrame) -> Column:
    """Equal for rows that agree in all columns (but maps and variants), which are interchangeable."""
    atomic = [F.col(f"`{n}`") for n, t in docs.dtypes if "map<" not in t and "variant" not in t]
    return F.struct(F.col("doc_id"), F.xxhash64(*atomic).alias("hash"))


def numbered(docs: DataFrame) -> DataFrame:
    """size, source and doc_id of every row, with what tells rows apart: __alike, and __copy, a number among rows alike."""
    sized = docs.select("source", n_words(F.col("text")).alias("size"), "doc_id", _alike(docs).alias("__alike"))
    return stored(sized.withColumn("__copy", F.row_number().over(Window.partitionBy("__alike").orderBy("__alike"))), "sizes")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix as documents, columns unchanged, in the order of the schedule: one row for each epoch's copy, at the slot of its first block.

    A copy is cut after the last word taken where the target ends inside it. Further columns are carried, whatever their names."""
    columns, kinds = docs.columns, dict(docs.dtypes)
    rows = numbered(docs)
    _, pieces = mix(rows.select(F.struct("__alike", "__copy").alias("__row"), "source", "size"), **options)
    copies = pieces.groupBy(F.col("__row.__alike").alias("__key"), F.col("__row.__copy").alias("__copy"), F.col("__epoch")).agg(F.sum("__words").alias("taken"), F.min("slot").alias("slot"), F.min(F.struct("__block", "__from")).alias("at"))
    whole = docs.select(F.struct(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns))).alias("__doc"), _alike(docs).alias("__alike")).dropDuplicates(["__alike"])
    joined = whole.join(copies, F.col("__alike") == F.col("__key"))
    text = F.col(f"__doc.c{columns.index('text')}")
    ends = F.split(text, f"(?<=[^{SPACE}])(?=[{SPACE}])")
    cut = F.when(F.col("taken") >= n_words(text), text).otherwise(F.array_join(F.slice(ends, 1, F.col("taken").cast("int")), ""))
    ordered = joined.select("slot", "at", cut.alias("__cut"), "__doc").orderBy("slot", "at")
    return ordered.select(*(F.col("__cut").alias("text") if c == "text" else F.length("__cut").cast(kinds[c]).alias(c) if c == "n_chars" else F.col(f"__doc.c{i}").alias(c) for i, c in enumerate(columns)))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Beside the contract's columns: first_slot (of the mix, at which the document first comes; null if it is not taken) and n_blocks (of which it is part)."""
    docs = numbered(table(spark, sf_dir, "documents"))
    docs = docs.select(F.struct("__alike", "__copy").alias("__row"), "doc_id", "source", "size")
    sources, pieces = mix(docs.select("__row", "source", "size"))
    taken = pieces.groupBy("__row").agg(F.sum("__words").alias("taken"), F.min("slot").alias("first_slot"), F.count("*").alias("n_blocks"))
    out = docs.join(taken, "__row", "left").alias("d").join(sources.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source")))
    return out.select("doc_id", "size", F.col("source_size").cast("long").alias("source_size"), "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), F.col("first_slot").cast("long").alias("first_slot"), F.coalesce("n_blocks", F.lit(0)).cast("long").alias("n_blocks"))
