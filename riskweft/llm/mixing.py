"""Mixing sources to target weights.

The words of a source, document after document, are packed into blocks of a
fixed length. The mix is a table of output shards with a fixed number of
slots. Each shard draws how many of its slots go to each source: whole
expected slots are given, the rest is drawn from the multinomial of the
remainders. The k-th slot of a source takes the block that a pseudorandom
permutation of the source's block numbers has at place k; after all blocks
were taken once, the next pass goes through another permutation. Slots and
blocks are joined by source and block number.

Nulls: a null text has no words, a null source is a source of its own that
stands last, a null doc_id is a document like any other. Repeated rows are
packed one after the other and each is counted by itself. An empty table
gives an empty mix. Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweft.llm.common import PARTS, SPACE, running_start, word_count
from riskweft.session import stage

BLOCK_WORDS = 128
SHARD_SLOTS = 1024
WEIGHTS = (5.0, 2.0, 1.0)
MOST = 3
ROUNDS = 12
#: Cells of [0, 1) by which a drawn number finds its source.
CELLS = 4096
SEED = 17


def measured(docs: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: size in words, and what its place in the source depends on."""
    tie = F.xxhash64(F.col("text"))
    return docs.select(
        "doc_id", "source", word_count(F.col("text")).alias("size"), tie.alias("tie"),
        F.pmod(F.xxhash64(F.col("doc_id"), F.col("text")), F.lit(PARTS)).cast("int").alias("part"), *carry,
    )


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """sizes: source, source_size. Adds rank, weight and target.

    All words are shared by weight, and no target goes beyond `most` times its
    source. The capped sources are the first ones by cap / weight: the share for
    one unit of weight is what the capped leave, over the weight of the others.
    Windows run over one row per source.
    """
    ranked = sizes.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    order = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    before, rest, every = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing), Window.partitionBy()
    left = F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    unit = ranked.withColumn("unit", left / F.sum("weight").over(rest))
    open_unit = F.min(F.when(F.col("unit") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), F.col("rank"), F.col("unit")))).over(every)
    # With no words at all every cap is 0 and any share fits.
    share = F.coalesce(open_unit["unit"], F.lit(0.0))
    return unit.withColumn("target", F.least("cap", share * F.col("weight"))).drop("unit")


def source_table(rows: DataFrame, block_words: int = BLOCK_WORDS, weights: tuple[float, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """One row per source: rank, size, target, number of blocks, expected draws, staged because every later step reads it."""
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    named = source_targets(sizes, weights, most)
    blocks = F.ceil(F.col("source_size") / F.lit(float(block_words))).cast("long")
    named = named.withColumn("blocks", blocks).withColumn(
        "draws", F.when(F.col("source_size") > 0, F.col("target") * F.col("blocks") / F.col("source_size")).otherwise(F.lit(0.0))
    )
    every = Window.partitionBy()
    slots = F.ceil(F.sum("draws").over(every)).cast("long")
    named = named.withColumn("slots", slots).withColumn("p", F.when(F.col("slots") > 0, F.col("draws") / F.sum("draws").over(every)).otherwise(F.lit(0.0)))
    return stage(named, "mix-sources")


def segments(rows: DataFrame, sources: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Pieces of documents by block: rank, start (a document's first word in its source), block, first, words.

    `first` counts from 0 inside the document. Documents without words have none.
    """
    placed = rows.join(sources.select("source", "rank"), rows["source"].eqNullSafe(sources["source"])).drop(sources["source"])
    placed = running_start(placed.where("size > 0"), ["rank"], "part", [F.col("doc_id"), F.col("tie")], "size", "start")
    first_block = F.floor(F.col("start") / block_words)
    last_block = F.floor((F.col("start") + F.col("size") - 1) / block_words)
    pieces = placed.withColumn("block", F.explode(F.sequence(first_block, last_block)))
    low = F.greatest(F.col("start"), F.col("block") * block_words)
    high = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block_words)
    return pieces.withColumn("first", low - F.col("start")).withColumn("words", high - low)


def _permuted(place: Column, size: Column, key: Column, rounds: int = ROUNDS) -> Column:
    """The swap-or-not shuffle: a permutation of 0 .. size-1 for any size, from hash values only."""

    def swap(at: Column, r: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(key, r, F.lit("k")), size) - at, size)
        bit = F.pmod(F.xxhash64(key, r, F.greatest(at, other)), F.lit(2))
        return F.when(bit == 1, other).otherwise(at)

    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), place, swap)


def slots(sources: DataFrame, shard_slots: int = SHARD_SLOTS, most: int = MOST, seed: int = SEED) -> DataFrame:
    """Filled slots of the mix: shard, rank, slot (its number among the source's slots in the shard), block.

    A source that would be drawn more than `most` times over leaves the slots beyond empty.
    """
    spark = sources.sparkSession
    total = sources.agg(F.max("slots").alias("n")).first()["n"] or 0
    full, rest = divmod(total, shard_slots)
    kinds = [(0, shard_slots, full)] * (full > 0) + [(1, rest, 1)] * (rest > 0)
    if not kinds:
        kinds = [(0, shard_slots, 0)]
    kind = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(n).alias("n_slots"), F.lit(s).alias("shards")) for k, n, s in kinds]))
    shares = sources.where("draws > 0").select("rank", "p", "blocks", kind.alias("x")).select("rank", "p", "blocks", "x.*")
    shares = shares.withColumn("given", F.floor(F.col("p") * F.col("n_slots")))
    one = Window.partitionBy("kind")
    shares = shares.withColumn("left", F.col("p") * F.col("n_slots") - F.col("given")).withColumn("drawn", F.col("n_slots") - F.sum("given").over(one))
    upto = one.orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    shares = shares.withColumn("hi", F.coalesce(F.try_divide(F.sum("left").over(upto), F.sum("left").over(one)), F.lit(0.0)))
    shares = shares.withColumn("hi", F.when(F.row_number().over(one.orderBy(F.desc("rank"))) == 1, F.lit(1.0)).otherwise(F.least("hi", F.lit(1.0))))
    shares = shares.withColumn("lo", F.coalesce(F.lag("hi").over(one.orderBy("rank")), F.lit(0.0)))
    shares = stage(shares, "mix-shares")

    # Remaining slots of each shard, each with a uniform number that picks a source by its remainder.
    shard_table = spark.range(full + (rest > 0)).select(F.col("id").alias("shard"), F.when(F.col("id") < full, 0).otherwise(1).alias("kind"))
    open_slots = shard_table.join(shares.groupBy("kind").agg(F.max("drawn").alias("drawn")), "kind").where("drawn > 0")
    u = F.pmod(F.xxhash64(F.lit(seed), F.col("shard"), F.col("j")), F.lit(1 << 52)) / F.lit(float(1 << 52))
    drawn = open_slots.withColumn("j", F.explode(F.sequence(F.lit(1).cast("long"), F.col("drawn")))).withColumn("u", u)
    drawn = drawn.select("shard", "kind", "u", F.floor(F.col("u") * CELLS).alias("cell"))
    cells = F.explode(F.sequence(F.floor(F.col("lo") * CELLS), F.least(F.floor(F.col("hi") * CELLS), F.lit(CELLS - 1))))
    ranges = shares.where("hi > lo").select("kind", "rank", "lo", "hi", cells.alias("cell"))
    extra = drawn.join(ranges, ["kind", "cell"]).where("u >= lo AND u < hi").groupBy("shard", "rank").agg(F.count("*").alias("n"))
    given = shard_table.join(shares.select("kind", "rank", "given"), "kind").where("given > 0").select("shard", "rank", F.col("given").alias("n"))
    counts = extra.unionByName(given).groupBy("shard", "rank").agg(F.sum("n").alias("n")).withColumn("part", F.floor(F.col("shard") / PARTS))
    counts = running_start(counts, ["rank"], "part", [F.col("shard")], "n", "before")

    # The counts are few rows, the slots many: they are dealt out before they are spread.
    counts = counts.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "rank", "shard")
    known = shares.groupBy("rank").agg(F.max("blocks").alias("blocks"))
    filled = counts.join(known, "rank").withColumn("slot", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    place = F.col("before") + F.col("slot")
    filled = filled.withColumn("place", place).where(F.col("place") < F.col("blocks") * most)
    key = F.xxhash64(F.lit(seed), F.col("rank"), F.floor(F.col("place") / F.col("blocks")))
    return filled.withColumn("key", key).select("shard", "rank", "slot", _permuted(F.pmod("place", "blocks"), F.col("blocks"), F.col("key")).alias("block"))


def taken_words(docs: DataFrame, block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, weights: tuple[float, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken."""
    rows = stage(measured(docs), "mix-sizes")
    sources = source_table(rows, block_words, weights, most)
    times = slots(sources, shard_slots, most).groupBy("rank", "block").agg(F.count("*").alias("times"))
    pieces = segments(rows, sources, block_words).select("doc_id", "size", "rank", "start", "block", "words")
    # Documents with words have places of their own in their source.
    taken = pieces.join(times, ["rank", "block"], "left").groupBy("rank", "start").agg(
        F.first("doc_id").alias("doc_id"), F.first("size").alias("size"), F.sum(F.col("words") * F.coalesce("times", F.lit(0))).alias("taken")
    )
    named = sources.select("rank", "source", "source_size", "target")
    empty = rows.where("size = 0").join(named, rows["source"].eqNullSafe(named["source"])).drop("source")
    full = taken.join(named.drop("source"), "rank")
    columns = ["doc_id", "size", "source_size", "target", "taken"]
    return full.select(*columns).unionByName(empty.withColumn("taken", F.lit(0).cast("long")).select(*columns))


def mixture(docs: DataFrame, block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, weights: tuple[float, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """The mix itself: shard, source, slot, block, doc_id, first, words, text (words joined by one space).

    A slot has one row for each document in its block. Documents are placed and
    dealt out without their texts; a text then moves once, to the list of its
    pieces, and is split once.
    """
    rows = stage(measured(docs), "mix-sizes")
    sources = source_table(rows, block_words, weights, most)
    pieces = segments(rows, sources, block_words).select("rank", "block", "doc_id", "tie", "first", "words")
    dealt = slots(sources, shard_slots, most).join(pieces, ["rank", "block"])
    # A document's pieces are as many as its blocks times the passes, so the list is bounded by its length.
    # Both keys are hashes and never null, so that a text is shuffled once, for the fold and the join.
    lists = dealt.groupBy(F.xxhash64("doc_id").alias("id"), "tie").agg(F.collect_list(F.struct("shard", "rank", "slot", "block", "first", "words")).alias("pieces"))
    # Rows with the same id and text are placed one by one, but any of their texts serves.
    texts = docs.select("doc_id", "text", F.xxhash64("doc_id").alias("id"), F.xxhash64("text").alias("tie")).dropDuplicates(["id", "tie"])
    held = texts.join(lists, ["id", "tie"])
    split = F.filter(F.split("text", SPACE), lambda w: w != "")

    def cut(words: Column) -> Column:
        return F.transform("pieces", lambda p: F.struct(
            p["shard"].alias("shard"), p["rank"].alias("rank"), p["slot"].alias("slot"), p["block"].alias("block"), p["first"].alias("first"), p["words"].alias("words"),
            F.array_join(F.slice(words, (p["first"] + 1).cast("int"), p["words"].cast("int")), " ").alias("text"),
        ))

    # The words are bound to a variable, so that a text is not split again for each piece.
    cells = F.get(F.transform(F.array(split), cut), F.lit(0))
    out = held.select("doc_id", F.explode(cells).alias("x")).select("doc_id", "x.*")
    # One row for each source.
    return out.join(sources.select("rank", "source"), "rank").select("shard", "source", "slot", "block", "doc_id", "first", "words", "text")
