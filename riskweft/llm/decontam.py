"""Benchmark decontamination by spaced seeds.

A mask names the word positions of a window that count; the others may differ.
Hashes of all masked windows of the corpus are joined with those of the
benchmark. Every hit gives a diagonal (where the item would start in the
document), and the words along it are compared: the document is contaminated
where a stretch of OVERLAP words (or the whole item, if it is shorter) agrees in
80 % of its words. Items shorter than the first mask must stand there whole.
The masks are chosen by enumeration: whichever words of a stretch the 80 % leave
free to differ, one mask finds the rest. Masks for items of 7 to 9 and of 10 to
14 words are used only where the benchmark holds such items.

Before the join, windows whose hash falls into no cell of the benchmark's hash
table go; the table has a fixed number of cells, whatever the benchmark's size.

Nulls: a null text has no words, on either side. Items under MIN_ITEM words are
no evidence and are ignored; items with equal words are one item, named by the
smallest item_id. Repeated rows are found alike. A null doc_id is matched like
any other. Empty tables give an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweft.llm.common import cell_filter, keep_others, passes, passing
from riskweft.llm.words import mix, pieces, signed, text_bytes, windows, word_hashes
from riskweft.session import stage

#: Word positions that count; with these, four words of 20 and three of 15 may differ anywhere.
MASKS = ((0, 1, 2, 3, 5, 6), (0, 1, 3, 4, 7, 8), (0, 2, 3, 5, 8, 9), (0, 1, 2, 6, 10, 11))
#: Further masks, by the lengths of the items that need them: two words of 10 to 14 may differ, one of 7 to 9.
SHORT_MASKS = {
    (10, 14): ((0, 1, 4, 5, 6, 7), (0, 2, 4, 5, 6, 7), (0, 1, 2, 3, 4, 6)),
    (7, 9): ((0, 1, 2, 3, 4, 5), (0, 1, 2, 3, 4, 6), (0, 1, 2, 4, 5, 6), (0, 1, 3, 4, 5, 6), (0, 2, 3, 4, 5, 6)),
}
MIN_ITEM = 5
OVERLAP = 20
PERCENT = 80
_LAST = (1 << 63) - 1


def _document_key() -> list[Column]:
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("doc"), F.xxhash64("text").alias("tie")]


def _masks(n: int) -> tuple[tuple[int, ...], ...]:
    """Masks by which an item of n words is found."""
    if n <= MASKS[0][-1]:
        return (tuple(range(n)),)
    return MASKS + tuple(mask for (low, high), masks in SHORT_MASKS.items() if low <= n <= high for mask in masks)


def _seeds(hashes: np.ndarray, masks: list[tuple[int, ...]]) -> Iterator[tuple[tuple[int, ...], np.ndarray]]:
    """Each mask and the hashes of its windows, by their start. Masks are told apart by their positions."""
    for mask in masks:
        yield mask, mix(windows(hashes, mask) + np.uint64(sum(1 << i for i in mask)))


def benchmark_items(benchmark: DataFrame) -> DataFrame:
    """item (smallest item_id), said (the words' hashes); one row per distinct item of MIN_ITEM words or more."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            hashes, counts = word_hashes(text_bytes(batch.column("text")))
            ends = np.cumsum(counts)
            said = [hashes[e - n : e].tobytes() for e, n in zip(ends.tolist(), counts.tolist())]
            yield pa.RecordBatch.from_arrays([batch.column("item"), pa.array(said, pa.binary())], ["item", "said"])

    items = benchmark.select(F.coalesce(F.col("item_id").cast("long"), F.lit(_LAST)).alias("item"), F.col("text").cast("string").alias("text"))
    read_items = items.mapInArrow(read, "item long, said binary").where(F.length("said") >= 8 * MIN_ITEM)
    return stage(read_items.groupBy("said").agg(F.min("item").alias("item")), "benchmark-items")


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc, tie, item, first (word of the document, from 0), words, matched: one row per document text and item."""
    items = benchmark_items(benchmark)
    # Lengths from OVERLAP on need the same masks, so few rows come to the driver.
    lengths = items.select(F.least((F.length("said") / 8).cast("int"), F.lit(OVERLAP)).alias("n")).distinct()
    masks = sorted({mask for r in lengths.collect() for mask in _masks(r["n"])})

    # Items shorter than the masks are looked for as whole windows of their length.
    def item_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, said in zip(batch.column("item").to_pylist(), batch.column("said").to_pylist()):
                said = np.frombuffer(said, np.uint64)
                for _, found in _seeds(said, _masks(len(said))):
                    if len(found):
                        at = pa.array(np.arange(len(found), dtype=np.int32))
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), item)), at, pa.array(signed(found))], ["item", "at", "seed"])

    seeds = stage(items.mapInArrow(item_seeds, "item long, at int, seed long"), "benchmark-seeds")
    cells = cell_filter(seeds.select("seed"))

    def corpus_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            hashes, counts = word_hashes(text_bytes(batch.column("text")))
            ends = np.cumsum(counts)
            for mask, found in _seeds(hashes, masks):
                hit = np.flatnonzero(passes(cells, found))
                row = np.searchsorted(ends, hit, side="right")
                inside = hit + mask[-1] < ends[row]
                hit, row = hit[inside], row[inside]
                if len(hit):
                    start = hit - (ends - counts)[row]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc").take(pa.array(row)), batch.column("tie").take(pa.array(row)), pa.array(start), pa.array(signed(found[hit]))],
                        ["doc", "tie", "start", "seed"],
                    )

    rows = docs.select(*_document_key(), F.col("text").cast("string").alias("text"))
    hits = rows.mapInArrow(corpus_seeds, "doc long, tie long, start long, seed long").join(seeds, "seed")
    diagonals = hits.select("doc", "tie", "item", (F.col("start") - F.col("at")).alias("diagonal")).distinct()
    found = diagonals.groupBy("doc", "tie", "item").agg(F.collect_list("diagonal").alias("diagonals")).join(items, "item")
    found = stage(found.groupBy("doc", "tie").agg(F.collect_list(F.struct("item", "said", "diagonals")).alias("found")), "benchmark-hits")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            hashes, counts = word_hashes(text_bytes(batch.column("text")))
            ends = np.cumsum(counts)
            out = []
            for doc, tie, end, n, found in zip(*(batch.column(c).to_pylist() for c in ("doc", "tie")), ends.tolist(), counts.tolist(), batch.column("found").to_pylist()):
                for x in found:
                    best = _best_overlap(hashes[end - n : end], np.frombuffer(x["said"], np.uint64), x["diagonals"])
                    if best:
                        out.append((doc, tie, x["item"], *best))
            columns = list(zip(*out)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc", "tie", "item", "first", "words", "matched"])

    hit = cell_filter(found.select("tie"))

    def hit_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield passing(batch, hit, "tie")

    # Texts without a hit stay where they are.
    texts = rows.mapInArrow(hit_rows, rows.schema).dropDuplicates(["doc", "tie"])
    return texts.join(found, ["doc", "tie"]).mapInArrow(verify, "doc long, tie long, item long, first long, words long, matched long")


def _best_overlap(words: np.ndarray, item: np.ndarray, diagonals: list[int]) -> tuple[int, int, int] | None:
    """Of all diagonals, the stretch with the most agreeing words: first word, length, agreeing words."""
    need = min(OVERLAP, len(item))
    best = None
    for d in sorted(diagonals):
        low, high = max(0, d), min(len(words), d + len(item))
        if high - low < need:
            continue
        same = words[low:high] == item[low - d : high - d]
        total = np.concatenate(([0], np.cumsum(same)))
        good = np.flatnonzero(100 * (total[need:] - total[:-need]) >= PERCENT * need)
        if len(good):
            first, last = int(good[0]), int(good[-1]) + need
            matched = int(total[last] - total[first])
            if best is None or matched > best[2]:
                best = (low + first, last - first, matched)
    return best


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, first, words, matched."""
    back = lambda c: F.when(F.col(c) != _LAST, F.col(c))
    return contaminated(docs, benchmark).select(back("doc").alias("doc_id"), back("item").alias("item_id"), "first", "words", "matched")


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without contaminated documents."""
    return keep_others(docs, contaminated(docs, benchmark), *_document_key())
