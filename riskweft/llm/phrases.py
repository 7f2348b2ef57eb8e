"""Phrase collocations by dynamic itemset counting.

Texts are cut into shards, and the shards are scanned in a cycle, one a step, by
all executors. A scan counts phrases of all lengths at once: a word from the
first step on, a longer phrase from the step after the one in which both its
subphrases, without its last word and without its first, had reached the
threshold. Every phrase is counted for exactly one cycle from its own start, so
its count is its number of occurrences in all texts, and the scans end when no
phrase is left in its cycle. A phrase that is as frequent as the threshold has
subphrases that are, so none is missed.

Which phrases have reached the threshold is told to the tasks by a table of 2^24
cells, each with the step from which phrases whose hash falls into it are
active. The table has this size whatever the corpus. Phrases that share a cell
are active together; such a phrase starts earlier than it had to, or at all, but
it too is counted for one whole cycle from its start, which is a function of the
cells of the phrases inside it. So a full table costs time and changes no count.

Texts are split into words once and staged as blocks of numbers. Counting works on
128-bit hashes of (language, phrase), which are folded per block in the task
before they are shuffled, so a hot language or source does not gather in one
task. Between steps only phrases inside their cycle are kept, and of those that
have completed it the frequent ones. At last the frequent phrases are joined with
one block each that holds them, and their texts are read there: a block meets the
hashes to be read in it and makes one row for each, so this too grows with the
number of frequent phrases.

Defined results: a null text has no words, a null language counts as `und`,
together with rows that say so. Repeated rows count each. An empty table, or one
without frequent phrases, gives an empty result. Extra columns are ignored. A
long text is read whole, in bounded parts that end between two pieces; only a
piece without any separator is held whole.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (makes pa.compute)
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweft.llm.words import mix, pieces, signed, text_bytes
from riskweft.session import release, stage

THRESHOLD = 100
LONGEST = 5
SHARDS = 3
#: Result rows of a language.
PER_LANGUAGE = 2000

CELL_BITS = 24
#: In the table of cells: no phrase of this cell has reached the threshold.
NEVER = 255
#: Words that a scan works on at once.
BLOCK = 1 << 20
#: Bytes of text whose documents are read at once; a longer text by itself.
READ = 1 << 23
#: Bytes of a long text that are split at once.
SLICE = 1 << 20

#: All separators become line feeds and both blanks become spaces.
_FOLD = bytes(10 if b in b".,;:!?\x0a\x0b\x0c\x0d" else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))
_FACTORS = mix(np.arange(1, 17, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F)) | np.uint64(1)

#: A block of words: which shard it belongs to, its number, how many words it has, its distinct words with their 128-bit hashes, and the text as indexes into them, 0 between two pieces.
BLOCKS = "lang string, shard int, id bigint, n bigint, words binary, hashes binary, places binary"
#: Both halves of the hash, number of words, the step in which the phrase is first counted, occurrences, a block that holds the phrase.
COUNTS = "h1 bigint, h2 bigint, k int, start int, n bigint, block bigint"
#: Texts of phrases with their occurrences; the empty phrase counts all words of a language.
TEXTS = "lang string, phrase string, n bigint"


def _word_hashes(lang: str, words: list[bytes]) -> np.ndarray:
    """(2, words): 128 bits of each word."""
    seed = zlib.crc32(lang.encode())
    return np.frombuffer(b"".join(xxhash.xxh3_128_digest(w, seed) for w in words), np.uint64).reshape(-1, 2).T.copy()


def _phrase_hashes(hashes: np.ndarray, parts: list[np.ndarray]) -> np.ndarray:
    """(2, phrases): 128 bits of the phrases whose j-th words are parts[j]."""
    total = np.full((2, len(parts[0])), len(parts), np.uint64)
    for p, factor in zip(parts, _FACTORS):
        total += hashes[:, p] * factor
    return mix(total)


def _cells(hashes: np.ndarray, cells: int) -> np.ndarray:
    """Cells of hashed phrases: low bits of the first half; their number is a power of two."""
    return (hashes[0] & np.uint64(cells - 1)).astype(np.int64)


def _blocks(texts: list[bytes]) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """(words, places): about BLOCK words at a time as indexes into words, where index 0 stands between two pieces."""
    known: dict[bytes, int] = {b"\n": 0}
    held: list[np.ndarray] = []
    size = 0
    for text in texts:
        folded = text.translate(_FOLD)
        at = 0
        while at < len(folded):
            end = min(at + SLICE, len(folded))
            if end < len(folded):
                # A cut must not go through a word.
                after = [p for p in (folded.find(b" ", end), folded.find(b"\n", end)) if p >= 0]
                end = min(after) if after else len(folded)
            tokens = [w for w in folded[at:end].replace(b"\n", b" \n ").split(b" ") if w]
            ids = [known.setdefault(w, len(known)) for w in tokens]
            if end == len(folded):
                ids.append(0)
            held.append(np.array(ids, np.int64))
            size += len(ids)
            at = end
            if size >= BLOCK:
                every = np.concatenate(held)
                ends = np.flatnonzero(every == 0)
                if len(ends):
                    # The rest of an open piece goes into the next block, with words of its own numbering.
                    last, words = int(ends[-1]), list(known)
                    yield words, every[: last + 1]
                    rest = [words[i] for i in every[last + 1 :].tolist()]
                    known = {b"\n": 0}
                    held = [np.array([known.setdefault(w, len(known)) for w in rest], np.int64)]
                    size = len(rest)
    if size:
        yield list(known), np.concatenate(held)


def _levels(known: np.ndarray, places: np.ndarray, cells: np.ndarray, step: int, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray, list[np.ndarray], np.ndarray]]:
    """(hashes, start, words at each position, occurrences) of the distinct phrases of one block that are active in the step, length by length."""
    size = known.shape[1]
    hashes = _phrase_hashes(known, [np.arange(size)])
    n = np.bincount(places, minlength=size)
    n[0] = 0
    used = np.flatnonzero(n)
    yield hashes[:, used], np.zeros(len(used), np.int64), [used], n[used]
    # The step from which the phrase at each place lets longer ones start.
    active = cells[_cells(hashes, len(cells))].astype(np.int64)
    active[0] = NEVER
    here = active[places]
    ids = places
    for k in range(2, longest + 1):
        at = np.flatnonzero(np.maximum(here[:-1], here[1:]) <= step)
        at = at[at + k <= len(places)]
        if not len(at):
            return
        codes, unique = pd.factorize(ids[at] * size + places[at + k - 1])
        first = np.empty(len(unique), np.int64)
        first[codes[::-1]] = at[::-1]
        start = np.maximum(here[first], here[first + 1])
        parts = [places[first + j] for j in range(k)]
        hashes = _phrase_hashes(known, parts)
        yield hashes, start, parts, np.bincount(codes, minlength=len(unique))
        if k < longest:
            # A cell that others have set says nothing before the phrase's own start.
            found = np.maximum(cells[_cells(hashes, len(cells))], start)
            ids = np.full(len(places), -1, np.int64)
            ids[at] = codes
            here = np.full(len(places), NEVER, np.int64)
            here[at] = found[codes]


def _counted(block: int, known: np.ndarray, places: np.ndarray, cells: np.ndarray, step: int, shards: int, longest: int) -> Iterator[pa.RecordBatch]:
    """Counts of the phrases of one block that are inside their cycle."""
    for hashes, start, parts, n in _levels(known, places, cells, step, longest):
        inside = start > step - shards
        if inside.any():
            h1, h2 = (signed(h[inside]) for h in hashes)
            k, at = np.full(len(h1), len(parts), np.int32), np.full(len(h1), block, np.int64)
            columns = [h1, h2, k, start[inside].astype(np.int32), n[inside].astype(np.int64), at]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["h1", "h2", "k", "start", "n", "block"])


def _said(lang: str, words: bytes, places: np.ndarray, cells: np.ndarray, wanted: pd.DataFrame, longest: int) -> Iterator[pa.RecordBatch]:
    """Texts of the phrases that are wanted of this block: h1, h2 and n of each."""
    known = [b"\n", *words.split(b"\n")]
    texts = pa.array(known, pa.binary())
    halves = np.sort(wanted["h1"].to_numpy())
    for hashes, _, parts, _ in _levels(_word_hashes(lang, known), places, cells, NEVER - 1, longest):
        h1, h2 = (signed(h) for h in hashes)
        near = np.flatnonzero(halves[np.minimum(np.searchsorted(halves, h1), len(halves) - 1)] == h1)
        here = pd.DataFrame({"h1": h1[near], "h2": h2[near], "at": near}).merge(wanted, on=["h1", "h2"])
        if len(here):
            said = [texts.take(pa.array(p[here["at"].to_numpy()])) for p in parts]
            phrase = said[0] if len(said) == 1 else pa.compute.binary_join_element_wise(*said, b" ")
            columns = [pa.array([lang] * len(here), pa.string()), phrase.cast(pa.string()), pa.array(here["n"].to_numpy())]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "phrase", "n"])


def _packed(cells: np.ndarray) -> bytes:
    # Most cells stay empty, so what travels with the task is about as large as the number of set cells.
    return zlib.compress(cells.tobytes(), 1)


def _unpacked(packed: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(packed), np.uint8)


def _places(row: dict) -> np.ndarray:
    return np.frombuffer(row["places"], np.int32).astype(np.int64)


def _scan(cells: np.ndarray, step: int, shards: int, longest: int):
    packed = _packed(cells)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = _unpacked(packed)
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                known = np.frombuffer(row["hashes"], np.uint64).reshape(-1, 2).T.copy()
                yield from _counted(row["id"], known, _places(row), cells, step, shards, longest)

    return run


def _read_back(cells: np.ndarray, longest: int):
    packed = _packed(cells)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = _unpacked(packed)
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.select(["lang", "words", "places"]).slice(i, 1).to_pylist()[0]
                wanted = pa.RecordBatch.from_struct_array(batch.column("wanted")[i].values).to_pandas()
                yield from _said(row["lang"], row["words"], _places(row), cells, wanted, longest)

    return run


def _reached(phrases: DataFrame, cells: int) -> np.ndarray:
    """Cells of the given phrases; at most one value for each cell comes to the driver."""
    return phrases.select(F.col("h1").bitwiseAND(cells - 1).cast("int").alias("cell")).distinct().toArrow()["cell"].to_numpy()


def _tokenised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    made = TaskContext.get().partitionId() << 32
    for batch in pieces(batches, "text", READ):
        groups: dict[tuple[str, int], list[bytes]] = {}
        for lang, shard, text in zip(batch.column("lang").to_pylist(), batch.column("shard").to_pylist(), text_bytes(batch.column("text"))):
            groups.setdefault((lang, shard), []).append(text)
        for (lang, shard), texts in groups.items():
            for words, places in _blocks(texts):
                if not places.any():
                    continue
                cells = [b"\n".join(words[1:]), _word_hashes(lang, words).T.tobytes(), places.astype(np.int32).tobytes()]
                numbers = [pa.array([made], pa.int64()), pa.array([np.count_nonzero(places)], pa.int64())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang]), pa.array([shard], pa.int32()), *numbers, *[pa.array([c], pa.binary()) for c in cells]],
                    ["lang", "shard", "id", "n", "words", "hashes", "places"],
                )
                made += 1


def word_blocks(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Texts as blocks of words, staged by shard: a text is split into words once, and a step reads the numbers of its own shard only."""
    shard = F.pmod(F.xxhash64("doc_id", "text"), F.lit(shards)).cast("int")
    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"), shard.alias("shard")).where("text <> ''")
    return stage(rows.mapInArrow(_tokenised, BLOCKS), "phrases-blocks", ["shard"])


def frequent_phrases(docs: DataFrame, threshold: int = THRESHOLD, longest: int = LONGEST, shards: int = SHARDS, cell_bits: int = CELL_BITS) -> DataFrame:
    """lang, phrase, n for every phrase of at most `longest` words with n >= threshold; the empty phrase holds all words of a language."""
    if longest * shards >= NEVER or longest > len(_FACTORS):
        raise ValueError("too many steps or words")
    blocks = word_blocks(docs, shards)
    cells = np.full(1 << cell_bits, NEVER, np.uint8)
    counts, complete, step, latest = None, [], 0, -1
    # The last phrases that can start do so in the step after the latest one in which a phrase reached the threshold.
    while step < shards or step <= latest + shards:
        seen = blocks.where(F.col("shard") == step % shards).select("id", "hashes", "places").mapInArrow(_scan(cells, step, shards, longest), COUNTS)
        if counts is not None:
            seen = seen.unionByName(counts.where(F.col("start") > step - shards))
        seen = seen.groupBy("h1", "h2", "k", "start").agg(F.sum("n").alias("n"), F.min("block").alias("block"))
        ends = F.col("start") == step - shards + 1
        before, counts = counts, stage(seen.where(~ends | (F.col("n") >= threshold)), "phrases-counts")
        if before is not None:
            release(before)
        complete.append(stage(counts.where(ends).select("h1", "h2", "n", "block"), "phrases-complete"))
        new = _reached(counts.where((F.col("n") >= threshold) & (F.col("k") < longest)), len(cells))
        new = new[cells[new] == NEVER]
        if len(new):
            cells[new] = step + 1
            latest = step
        step += 1
    release(counts)
    found = complete[0]
    for more in complete[1:]:
        found = found.unionByName(more)
    # One block holds each phrase. A block that some phrase is to be read in moves once; the others stay where they are.
    wanted = stage(found.groupBy("block").agg(F.collect_list(F.struct("h1", "h2", "n")).alias("wanted")), "phrases-wanted")
    read = stage(wanted.select(F.col("block").alias("id")), "phrases-read")
    held = blocks.select("id", "lang", "words", "places").join(read, "id", "left_semi")
    held = held.join(wanted.withColumnRenamed("block", "id").hint("merge"), "id").select("lang", "words", "places", "wanted")
    totals = blocks.groupBy("lang").agg(F.lit("").alias("phrase"), F.sum("n").alias("n"))
    said = stage(held.mapInArrow(_read_back(cells, longest), TEXTS).unionByName(totals), "phrases-said")
    release(blocks)
    return said


def _exact(name: str) -> Column:
    return F.col(name).cast("decimal(19,0)")


def score(a: str, n: str, left: str, right: str) -> Column:
    """floor(1000 * a * n / (left * right)) in decimals of 38 digits."""
    over = F.lit(1000).cast("decimal(4,0)") * (_exact(a) * _exact(n)).cast("decimal(34,0)")
    under = (_exact(left) * _exact(right)).cast("decimal(38,0)")
    return F.call_function("div", over.cast("decimal(38,0)"), under)


def collocations(frequent: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the best phrases of each language.

    frequent is what frequent_phrases returns. A phrase of two words or more is
    scored at the cut that explains it best, and left out if a longer frequent
    phrase that holds it is as frequent.
    """
    table = stage(frequent, "phrases-frequent")
    sizes = table.where("phrase = ''").select("lang", F.col("n").alias("words"))
    known = table.where("phrase <> ''")
    spoken = known.withColumn("w", F.split("phrase", " ")).where(F.size("w") > 1)

    # The longest count among longer phrases that hold this one; they are at most one word longer at a time, but any length counts.
    inner = F.filter(
        F.flatten(F.transform(F.sequence(F.lit(1), F.size("w")), lambda i: F.transform(
            F.sequence(F.lit(1), F.size("w") - i + 1), lambda k: F.slice("w", i, k)))),
        lambda p: (F.size(p) > 1) & (F.size(p) < F.size("w")),
    )
    held = spoken.where(F.size("w") > 2).select("lang", F.explode(inner).alias("p"), "n")
    held = held.select("lang", F.array_join("p", " ").alias("phrase"), "n").groupBy("lang", "phrase").agg(F.max("n").alias("most"))
    open_ = spoken.join(held, ["lang", "phrase"], "left").where("most IS NULL OR most < n").select("lang", "phrase", "w", F.col("n").alias("a"))

    cuts = open_.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("w") - 1)))
    cuts = cuts.select("lang", "phrase", "a", "k", F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("lp"), F.array_join(F.slice("w", F.col("k") + 1, F.size("w")), " ").alias("rp"))
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("lp"), F.col("n").alias("l")), ["lang", "lp"])
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("rp"), F.col("n").alias("r")), ["lang", "rp"])
    cuts = cuts.join(sizes.select("lang", F.col("words").alias("n")), "lang")
    cuts = cuts.withColumn("score", score("a", "n", "l", "r"))
    best = cuts.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("x")).select("lang", "phrase", "x.*").drop("k")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = best.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= per_language)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
