"""Mix sources to target weights by drawing fixed-length blocks of words.

The words of a source, document after document, are packed into blocks of equal
length.  A source gets as many slots of the mix as its target holds blocks.  Each output
shard of SHARD_SLOTS slots draws from a multinomial, seeded by its number, how many of its slots
each source has; running sums over the shards number the slots of a source.  Slots that the
draws leave over go to shards behind the drawn ones, and draws beyond a source's slots
lapse, so a source gets exactly its slots.  Slot j
of a source with n blocks takes the block to which the permutation of pass j // n
maps j % n, so no block is taken more often than the target's multiple of its source, rounded up.

Where a document's words begin in its source follows from two sums: of the hashed
chunks of the source before its own, and of the documents before it in its chunk.
No task holds a source.  The driver holds a row for each source.  Texts are moved once, to the blocks
that were chosen of them.

A null or empty text has no words, takes part with size 0 and is never taken.  A null
source is a source of its own, last in order.  Rows with one id, or wholly equal ones,
are mixed one by one.  An empty table gives no rows.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from discolake.llm.tables import in_batches, partitions, stored

WORDS = r"[^\x20\x09-\x0D]+"
#: A word with the white space after it; side by side they are the text again.
WORD_AND_SPACE = r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*"
WEIGHTS = (5.0, 2.0, 1.0)
#: A target is at most so many times the size of its source.
MOST = 3
BLOCK_WORDS = 64
SHARD_SLOTS = 4096
#: Shards of a running sum; counts that a task draws at once.
CHUNK_SHARDS = 1024
DRAWN_ROWS = 1 << 20
CHUNK_DOCS = 5000
#: Rounds of swap-or-not; each swaps about half of all index pairs.
ROUNDS = 12
SEED = 17


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """source, source_size -> with number, target.  One row for each source.

    A target is weight times a level, or the limit if that is lower.  With the sources
    in order of limit / weight those at their limit come first, so the level
    is what is left after them over the weight that is left after them.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    number = F.row_number().over(by_name) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (number % len(weights) + 1).cast("int"))
    ranked = sizes.withColumns(
        {"number": number, "__weight": weight, "__limit": F.lit(float(most)) * F.col("source_size")}
    )
    ratio = F.col("__limit") / F.col("__weight")
    everyone = Window.partitionBy()
    before = Window.orderBy(ratio, "number").rowsBetween(Window.unboundedPreceding, -1)
    from_here = Window.orderBy(ratio, "number").rowsBetween(0, Window.unboundedFollowing)
    left = F.sum("source_size").over(everyone) - F.coalesce(F.sum("__limit").over(before), F.lit(0.0))
    level = left / F.sum("__weight").over(from_here)
    levels = ranked.withColumn("__level", level).withColumn("__free", F.col("__level") <= ratio)
    first_free = F.min(F.when(F.col("__free"), F.struct(ratio, "number", "__level"))).over(everyone)
    target = F.least(F.col("__limit"), F.col("__weight") * first_free["__level"])
    return levels.withColumn("target", F.coalesce(target, F.col("__limit"))).select(
        "source", "source_size", "number", "target"
    )


def laid_out(docs: DataFrame, text_col: str, id_col: str, source_col: str, keep: list[str]) -> DataFrame:
    """Columns of docs with __size, __start (words of the source before it), __source_size, __number, __target."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    sized = docs.withColumns(
        {
            "__size": F.regexp_count(text, F.lit(WORDS)).cast("long"),
            "__tie": F.xxhash64(text),
            "__chunk": F.pmod(
                F.xxhash64(F.col(id_col), F.lit(SEED)), F.lit(max(1, docs.count() // CHUNK_DOCS))
            ),
        }
    )
    sized = stored(sized.select(*keep, "__size", "__tie", "__chunk"), "mix-sizes", narrow=True)
    chunks = sized.groupBy(F.col(source_col).alias("source"), "__chunk").agg(
        F.sum("__size").alias("words")
    )
    known = targets(chunks.groupBy("source").agg(F.sum("words").alias("source_size")))
    before = Window.partitionBy("number").orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    places = (
        chunks.join(known.withColumnRenamed("source", "named"), F.col("source").eqNullSafe(F.col("named")))
        .withColumn("__first", F.coalesce(F.sum("words").over(before), F.lit(0)))
        .select(
            "source",
            F.col("__chunk").alias("chunk"),
            "__first",
            F.col("number").alias("__number"),
            F.col("source_size").alias("__source_size"),
            F.col("target").alias("__target"),
        )
    )
    within = (
        Window.partitionBy("__number", "__chunk")
        .orderBy(id_col, "__size", "__tie")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    right = places.withColumnRenamed("source", "__source")
    same = F.col(source_col).eqNullSafe(F.col("__source")) & (F.col("__chunk") == F.col("chunk"))
    start = F.col("__first") + F.coalesce(F.sum("__size").over(within), F.lit(0))
    return (
        sized.join(right, same)
        .withColumn("__start", start)
        .drop("__source", "chunk", "__first", "__tie", "__chunk")
    )


def permuted(index: Column, count: Column, *key: Column) -> Column:
    """Swap-or-not: a pseudorandom permutation of 0 .. count - 1 for each key."""

    def swap(x: Column, turn: Column) -> Column:
        partner = F.pmod(F.xxhash64(*key, turn) - x, count)
        chosen = F.xxhash64(*key, turn, F.greatest(x, partner), F.lit("swap"))
        return F.when(chosen.bitwiseAND(F.lit(1)) == 1, partner).otherwise(x)

    turns = F.sequence(F.lit(1), F.lit(ROUNDS))
    return F.aggregate(turns, index.cast("long"), swap)


def draw_batches(shares: list[tuple[int, float]], batches: Iterator[pa.RecordBatch]):
    """For each shard how many of its slots each source has; sources without any are left out."""
    numbers = np.array([n for n, _ in shares], "i8")
    odds = np.array([p for _, p in shares])
    for batch in batches:
        shards = batch.column("shard").to_numpy()
        for low in range(0, len(shards), max(1, DRAWN_ROWS // len(numbers))):
            some = shards[low : low + max(1, DRAWN_ROWS // len(numbers))]
            drawn = [np.random.default_rng((SEED, int(x))).multinomial(SHARD_SLOTS, odds) for x in some]
            at, source = np.nonzero(np.array(drawn))
            columns = [some[at], numbers[source], np.array(drawn)[at, source].astype("i8")]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["shard", "number", "drawn"])


def drawn_slots(known: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Runs of slots: number, blocks, shard, low, high (the slots low .. high - 1 of the source)."""
    spark = known.sparkSession
    blocks = F.ceil(F.col("source_size") / block_words)
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    counted = known.select(
        "number", blocks.alias("blocks"), F.round(share * blocks).cast("long").alias("slots")
    ).filter("slots > 0")
    sources = sorted(map(tuple, counted.collect()))
    total = sum(slots for _, _, slots in sources)
    shards = -(-total // SHARD_SLOTS)
    work = functools.partial(draw_batches, [(number, slots / total) for number, _, slots in sources])
    tasks = max(1, min(partitions(spark), shards // 16))
    numbered = spark.range(0, shards, 1, tasks).withColumnRenamed("id", "shard")
    drawn = in_batches(numbered, work, "shard long, number long, drawn long") if sources else None
    if drawn is None:
        return spark.createDataFrame([], "number long, blocks long, shard long, low long, high long")
    # Running sums in two steps, so that no task holds all shards of a source.
    drawn = drawn.withColumn("chunk", F.floor(F.col("shard") / CHUNK_SHARDS))
    sums = drawn.groupBy("number", "chunk").agg(F.sum("drawn").alias("sum"))
    before = Window.partitionBy("number").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sums.withColumn("first", F.coalesce(F.sum("sum").over(before), F.lit(0)))
    within = Window.partitionBy("number", "chunk").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    low = F.col("first") + F.coalesce(F.sum("drawn").over(within), F.lit(0))
    placed = drawn.join(firsts.drop("sum"), ["number", "chunk"]).withColumn("low", low)
    placed = placed.join(counted, "number").select(
        "number", "blocks", "shard", "low", F.least(F.col("low") + F.col("drawn"), "slots").alias("high")
    )
    all_drawn = sums.groupBy("number").agg(F.sum("sum").alias("all"))
    left = counted.join(all_drawn, "number", "left").withColumn("low", F.least(F.coalesce("all", F.lit(0)), "slots"))
    left = left.withColumn("left", F.col("slots") - F.col("low"))
    # What was left over, source after source, fills shards behind the drawn ones; one row for each source.
    ahead = F.sum("left").over(Window.orderBy("number").rowsBetween(Window.unboundedPreceding, -1))
    left = left.withColumn("ahead", F.coalesce(ahead, F.lit(0))).filter("left > 0")
    cuts = F.sequence(F.floor(F.col("ahead") / SHARD_SLOTS), F.floor((F.col("ahead") + F.col("left") - 1) / SHARD_SLOTS))
    left = left.withColumn("shard", F.explode(cuts))
    begin = F.greatest(F.col("shard") * SHARD_SLOTS, "ahead") - F.col("ahead")
    end = F.least((F.col("shard") + 1) * SHARD_SLOTS - F.col("ahead"), "left")
    rest = left.select(
        "number", "blocks", (F.col("shard") + shards).alias("shard"),
        (F.col("low") + begin).alias("low"), (F.col("low") + end).alias("high"),
    )
    return placed.filter("low < high").unionByName(rest)


def slots(known: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """All slots of the mix: number, slot, turn (which pass), block, shard."""
    runs = drawn_slots(known, block_words)
    # A shard has SHARD_SLOTS slots, so the runs of a shard are even work.
    runs = runs.repartition(max(runs.sparkSession.sparkContext.defaultParallelism, 1), "shard")
    each = F.explode(F.sequence("low", F.col("high") - 1))
    numbered = runs.select("number", "blocks", "shard", each.alias("slot")).withColumn(
        "turn", F.floor(F.col("slot") / F.col("blocks"))
    )
    key = (F.lit(SEED), F.col("number"), F.col("turn"))
    block = permuted(F.col("slot") % F.col("blocks"), F.col("blocks"), *key)
    return numbered.select("number", "slot", "turn", block.alias("block"), "shard")


def pieces(laid: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The part that each block has of each document: number, start, block, low, high (words)."""
    start, end = F.col("__start"), F.col("__start") + F.col("__size")
    first, last = F.floor(start / block_words), F.floor((end - 1) / block_words)
    exploded = laid.filter("__size > 0").select(
        F.col("__number").alias("number"),
        F.col("__start").alias("start"),
        end.alias("end"),
        F.explode(F.sequence(first, last)).alias("block"),
    )
    return exploded.select(
        "number",
        "start",
        "block",
        (F.greatest("start", F.col("block") * block_words) - F.col("start")).alias("low"),
        (F.least("end", (F.col("block") + 1) * block_words) - F.col("start")).alias("high"),
    )


def _sources(laid: DataFrame) -> DataFrame:
    return laid.select(
        F.col("__number").alias("number"),
        F.col("__source_size").alias("source_size"),
        F.col("__target").alias("target"),
    ).distinct()


def taken_words(
    docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", source_col: str = "source"
) -> DataFrame:
    """One row for each row of docs: id, size, source_size, target, taken."""
    laid = laid_out(docs, text_col, id_col, source_col, [id_col, source_col])
    laid = stored(laid, "mix-laid", narrow=True)
    times = slots(_sources(laid)).groupBy("number", "block").agg(F.count(F.lit(1)).alias("times"))
    taken = (
        pieces(laid)
        .join(times, ["number", "block"])
        .groupBy(F.col("number").alias("__number"), F.col("start").alias("__start"))
        .agg(F.sum((F.col("high") - F.col("low")) * F.col("times")).alias("taken"))
    )
    # Documents without words share their start with the next one, which has the words.
    return laid.join(taken, ["__number", "__start"], "left").select(
        id_col,
        F.col("__size").alias("size"),
        F.col("__source_size").alias("source_size"),
        F.col("__target").alias("target"),
        F.when(F.col("__size") > 0, F.coalesce("taken", F.lit(0))).otherwise(F.lit(0)).alias("taken"),
    )


def row_hash(docs: DataFrame) -> Column:
    """A hash of all columns, so rows that agree in it and in their id are equal."""
    return F.xxhash64(*[f.name for f in docs.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))])


def mixed_documents(
    docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", source_col: str = "source"
) -> DataFrame:
    """docs as the mix takes them: a row for each document and pass, with the words taken.

    Keeps the columns of docs and adds mix_turn, the pass, and mix_shards, the output
    shards that its blocks go to.  The taken words keep the white space after them.
    """
    hashed = docs.withColumn("__row", row_hash(docs))
    laid = laid_out(hashed, text_col, id_col, source_col, [id_col, source_col, "__row"])
    laid = stored(laid, "mix-laid", narrow=True)
    # A document has a piece for each of its blocks at most, so the lists follow its length.
    chosen = (
        pieces(laid)
        .join(slots(_sources(laid)), ["number", "block"])
        .groupBy(F.col("number").alias("__number"), F.col("start").alias("__start"), F.col("turn").alias("__turn"))
        .agg(
            F.sort_array(F.collect_list(F.struct("low", "high"))).alias("__parts"),
            F.sort_array(F.collect_set("shard")).alias("__shards"),
        )
    )
    whose = laid.filter("__size > 0").select("__number", "__start", "__row", F.col(id_col).alias("__id"))
    chosen = chosen.join(whose, ["__number", "__start"]).select("__id", "__row", "__turn", "__parts", "__shards")
    # Equal rows share a hash: any of them stands for the others.
    twins = laid.groupBy(id_col, "__row").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    if not twins.isEmpty():
        hashed = hashed.dropDuplicates([id_col, "__row"])
    words = F.regexp_extract_all(F.col(text_col), F.lit(WORD_AND_SPACE), F.lit(0))
    cut = F.transform(
        "__parts",
        lambda p: F.array_join(F.slice("__words", p["low"] + 1, p["high"] - p["low"]), ""),
    )
    mine, theirs = hashed.withColumnRenamed("__row", "__own"), chosen
    same = (F.col("__own") == F.col("__row")) & F.col(id_col).eqNullSafe(F.col("__id"))
    return (
        mine.join(theirs, same)
        # A generator, as a plain column would be worked out again for each part.
        .select("*", F.explode(F.array(words)).alias("__words"))
        .withColumn(text_col, F.array_join(cut, ""))
        .select(*docs.columns, F.col("__turn").alias("mix_turn"), F.col("__shards").alias("mix_shards"))
    )
