"""Line deduplication by a deletion-neighbourhood join.

Lines are compared as lists of lower-cased words. Two lines are near copies when
one becomes the other by at most one word inserted, deleted or replaced. Of all
places where a line stands, the earliest one by (doc_id, text, line number)
stays; a line with an earlier near copy goes everywhere.

1. Equal lines are folded to one class by a 128-bit hash.
2. Within one edit, two lines share their first or their last half. Only classes
   that share such a half with another class go on; this loses no pair.
3. Each of those emits, for every word, the hash of the line without that word.
   Equal hashes at the same place of lines of one length are a replacement,
   a hash equal to a whole line's hash is a deletion. All members of such a
   group are near copies of each other (or of the whole line), so joining every
   member with the earliest one finds all that have an earlier copy, and no
   pairs inside a group are made.
4. The joined pairs are verified on the words themselves.

Lines under MIN_NEAR words are only compared for equality (one edit in five
words is a similarity of 0.8). drop_repeated, the stage of the pipeline, compares
every line that has a word; dedup_lines leaves lines under `least` words where
they are, by default MIN_WORDS as its SQL does.

Nulls: a null text has no lines and stays null; a null doc_id stands last.
Repeated rows with the same doc_id and text are one document and keep the same
lines. An empty table gives an empty result. Extra columns are kept as they are.
Memory: no task holds more than one document, or one line's words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweft.session import release, stage

#: Bits of a hash that name a cell of a broadcast filter.
CELL_BITS = 19
MIN_WORDS = 3
MIN_NEAR = 5
_LAST = (1 << 63) - 1


def _key() -> list[Column]:
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("doc"), F.xxhash64("text").alias("tie")]


def _plain(text: Column) -> Column:
    """Lower-cased text, its words with one space between, its lines kept.

    Only texts that need it pay for regular expressions.
    """
    odd = F.startswith(text, F.lit(" ")) | F.endswith(text, F.lit(" "))
    for said in ("  ", " \n", "\n ", "\t", "\r", "\x0b", "\x0c"):
        odd = odd | F.contains(text, F.lit(said))
    spaced = F.regexp_replace(F.regexp_replace(text, r"[\x20\x09\x0B-\x0D]+", " "), r"\x20?\n\x20?", "\n")
    return F.lower(F.when(odd, F.trim(spaced)).otherwise(text))


def occurrences(docs: DataFrame, least: int = MIN_WORDS) -> DataFrame:
    """doc, tie, line (its number from 0), said (its words, one space between), n, h1, h2; lines of at least `least` words."""
    lines = docs.select(*_key(), F.posexplode(F.split(_plain(F.col("text")), "\n")).alias("line", "said"))
    n = F.octet_length("said") - F.octet_length(F.replace("said", F.lit(" "))) + F.when(F.col("said") == "", 0).otherwise(1)
    return lines.withColumn("n", n).where(F.col("n") >= least).withColumns({"h1": F.xxhash64("said"), "h2": F.xxhash64(F.lit(7), "said")})


def _halves() -> Column:
    """Keys of which two lines within one edit share one: their first or last m words, where the longer one has n words and m is n / 2 or (n - 1) / 2."""

    def ends(m: Column) -> list[Column]:
        return [F.xxhash64(F.lit(side), m, F.call_function("substring_index", F.col("said"), F.lit(" "), m * side)) for side in (1, -1)]

    m = F.floor(F.col("n") / 2).cast("int")
    return F.when(F.col("n") % 2 == 1, F.array(*ends(m))).otherwise(F.array(*ends(m), *ends(m - 1)))


def _cell(h: str) -> Column:
    return F.shiftrightunsigned(h, 64 - CELL_BITS).alias("__cell")


def _keep_cells(rows: DataFrame, h: str, wanted: DataFrame) -> DataFrame:
    """Rows whose hash h shares a cell with a wanted one: a first, coarse filter whose broadcast table has 2 ** CELL_BITS rows at most."""
    cells = stage(wanted.select(_cell(h)).distinct(), "line-cells")
    return rows.withColumn("__cell", _cell(h)).join(F.broadcast(cells), "__cell", "left_semi").drop("__cell")


def near_lines(slim: DataFrame, spots: DataFrame, found: DataFrame) -> DataFrame:
    """Classes (h1, h2) with an earlier class within one edit, staged; what was staged on the way is dropped.

    slim: line places with their halves; spots: classes with their first place `at`; found: line places with their words.
    """
    halves = slim.where(F.col("n") >= MIN_NEAR).select("h1", "h2", F.explode("halves").alias("half"))
    shared = stage(halves.groupBy("half").agg(F.min("h1").alias("low"), F.max("h1").alias("high")).where("low <> high").select("half"), "line-halves")
    going = _keep_cells(halves, "half", shared).join(shared, "half", "left_semi").select("h1", "h2").distinct()
    first = stage(spots.where(F.col("n") >= MIN_NEAR).join(going, ["h1", "h2"]).select("h1", "h2", "n", "at"), "line-firsts")
    # Words of a class, taken from its first place.
    said = _keep_cells(found, "h1", first).select("h1", "h2", F.struct("doc", "tie", "line").alias("at"), "said")
    said = first.join(said, ["h1", "h2", "at"]).dropDuplicates(["h1", "h2"]).withColumn("words", F.split("said", " ")).drop("said")
    said = lines = stage(said, "near-lines")

    # The words stand in the line's task: one move by class, then windows that need none.
    me = F.struct("at", "h1", "h2").alias("me")
    word = said.repartition("h1", "h2").select("h1", "h2", "at", "n", F.posexplode("words").alias("i", "word"))
    line = Window.partitionBy("h1", "h2")
    upto = line.orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    word = word.select("h1", "h2", "at", "n", "i", F.xxhash64("word", "i").alias("t0"), F.xxhash64("word", F.col("i") - 1).alias("t1"))
    word = word.withColumns({"all0": F.bit_xor("t0").over(line), "all1": F.bit_xor("t1").over(line), "run0": F.bit_xor("t0").over(upto), "run1": F.bit_xor("t1").over(upto)})
    replaced = F.col("all0").bitwiseXOR(F.col("t0"))
    deleted = F.col("run0").bitwiseXOR(F.col("t0")).bitwiseXOR(F.col("all1").bitwiseXOR(F.col("run1")))
    variants = word.select(me, F.col("n").cast("int").alias("n"), "i", replaced.alias("replaced"), deleted.alias("deleted"), "all0")
    # One hash for each group that a variant, or a whole line (for deletions), stands in.
    variants = variants.withColumns({
        "same": F.xxhash64(F.lit(0), "replaced", "i", "n"), "less": F.xxhash64(F.lit(1), "deleted", "n"), "whole": F.when(F.col("i") == 0, F.xxhash64(F.lit(1), "all0", F.col("n") + 1)),
    })
    variants = stage(variants, "line-variants")

    # Groups with a pair in them; only hashes move, and few groups are left.
    one = F.explode(F.array(
        F.struct(F.col("same").alias("g"), F.lit(1).alias("kind")), F.struct(F.col("less").alias("g"), F.lit(2).alias("kind")), F.struct(F.col("whole").alias("g"), F.lit(4).alias("kind")),
    )).alias("x")
    groups = variants.select(one).select("x.*").where("g IS NOT NULL").groupBy("g").agg(F.count(F.lit(1)).alias("members"), F.bit_or("kind").alias("kinds"))
    groups = stage(groups.where("(kinds = 1 AND members > 1) OR kinds = 6").select("g"), "line-groups")

    def in_groups(name: str) -> DataFrame:
        rows = variants.withColumnRenamed(name, "g").where("g IS NOT NULL")
        return _keep_cells(rows, "g", groups).join(groups, "g", "left_semi")

    # Replacement: every member of a group against the group's earliest.
    place = ["replaced", "i", "n"]
    same = stage(in_groups("same").select("me", "n", "i", "replaced"), "line-same")
    earliest = same.groupBy(*place).agg(F.min("me").alias("other"), F.max("me").alias("last")).where("other <> last").drop("last")
    replacements = same.join(earliest, place).where("me <> other").select("me", "other", "i")
    # Deletion: lines with one word less whose whole hash is the variant.
    whole = in_groups("whole").select(F.col("me").alias("short"), F.col("all0").alias("deleted"), (F.col("n") + 1).alias("n"))
    deletions = stage(in_groups("less").select("me", "n", "i", "deleted").join(whole, ["deleted", "n"]), "line-deletions")
    later_long = deletions.where("short < me").select("me", F.col("short").alias("other"), "i")
    later_short = deletions.where("me < short").groupBy("short").agg(F.min(F.struct("me", "i")).alias("x"))
    pairs = replacements.withColumn("kind", F.lit(0)).unionByName(later_long.withColumn("kind", F.lit(1)))
    pairs = pairs.unionByName(later_short.select(F.col("short").alias("me"), F.col("x.me").alias("other"), F.col("x.i").alias("i"), F.lit(2).alias("kind")))

    # The edit is verified on the words: without word i, the longer line is the shorter one.
    mine = said.select(me, F.col("words").alias("a"))
    yours = said.select(F.struct("at", "h1", "h2").alias("other"), F.col("words").alias("b"))
    pairs = pairs.join(mine, "me").join(yours, "other")

    def without(words: Column) -> Column:
        return F.concat(F.slice(words, F.lit(1), F.col("i")), F.slice(words, F.col("i") + 2, F.greatest(F.size(words) - F.col("i") - 1, F.lit(0))))

    a = F.when(F.col("kind") == 2, F.col("a")).otherwise(without(F.col("a")))
    b = F.when(F.col("kind") == 1, F.col("b")).otherwise(without(F.col("b")))
    near = stage(pairs.where(a == b).select("me.h1", "me.h2").distinct(), "near-classes")
    for used in (shared, first, lines, variants, groups, same, deletions):
        release(used)
    return near


def dropped_lines(docs: DataFrame, least: int = MIN_WORDS) -> DataFrame:
    """doc, tie, gone (sorted line numbers), n_near: documents that lose lines. gone holds repeated lines and near copies."""
    found = occurrences(docs, least)
    slim = stage(found.select("doc", "tie", "line", "n", "h1", "h2", F.when(F.col("n") >= MIN_NEAR, _halves()).alias("halves")), "lines")
    at = F.struct("doc", "tie", "line")
    spots = stage(slim.groupBy("h1", "h2").agg(F.min(at).alias("at"), F.max(at).alias("last"), F.min("n").alias("n")), "line-classes")
    near = near_lines(slim, spots, found).withColumn("near", F.lit(True))
    # Classes that take a line away somewhere; most lines stand once and have no near copy.
    acting = spots.join(near, ["h1", "h2"], "left").where("near OR at <> last").select("h1", "h2", "at", F.coalesce("near", F.lit(False)).alias("near"))
    gone = slim.select("doc", "tie", "line", "h1", "h2").join(acting, ["h1", "h2"]).where(F.col("near") | (F.col("at") != at))
    return gone.groupBy("doc", "tie").agg(F.array_sort(F.collect_set("line")).alias("gone"), F.count(F.when(F.col("near"), 1)).alias("n_near"))


def dedup_lines(docs: DataFrame, least: int = MIN_WORDS) -> DataFrame:
    """docs without the lines that go, and with the added columns lines_gone (their numbers) and near_gone (near copies among them)."""
    out = stage(dropped_lines(docs, least), "lines-gone")
    doc, tie = _key()
    rows = docs.withColumn("__doc", doc).withColumn("__tie", tie)
    gone = out.select(F.col("doc").alias("__doc"), F.col("tie").alias("__tie"), F.col("gone").alias("lines_gone"), F.col("n_near").alias("near_gone"))
    # Documents in no cell of a document that loses lines stay where they are.
    cells = F.broadcast(stage(gone.select(_cell("__tie")).distinct(), "line-cells"))
    rows = rows.withColumn("__cell", _cell("__tie"))
    joined = rows.join(cells, "__cell", "left_semi").join(gone, ["__doc", "__tie"], "left")
    whole = rows.join(cells, "__cell", "left_anti").withColumns({"lines_gone": F.lit(None).cast("array<int>"), "near_gone": F.lit(None).cast("long")})
    rows = joined.unionByName(whole).drop("__cell")
    kept = F.array_join(F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains("lines_gone", i)), "\n")
    text = F.when(F.col("lines_gone").isNull(), F.col("text")).otherwise(kept)
    none = F.array().cast("array<int>")
    return rows.withColumn("text", text).withColumns({"lines_gone": F.coalesce("lines_gone", none), "near_gone": F.coalesce("near_gone", F.lit(0))}).drop("__doc", "__tie")


def drop_repeated(docs: DataFrame) -> DataFrame:
    """docs with the lines that stay, of all lines with a word; a document that lost lines and has no word left goes. n_chars follows the text."""
    done = dedup_lines(docs, least=1)
    changed = F.size("lines_gone") > 0
    done = done.where(~changed | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    if "n_chars" in docs.columns:
        done = done.withColumn("n_chars", F.when(changed, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return done.select(*docs.columns)
