"""Toxicity from bags of subword embeddings.

A word (a run between white space, A-Z lower-cased, punctuation parting words)
is the mean of the vectors of its byte n-grams, with its bounding spaces, and of
itself; a document is the mean of its words; a linear softmax reads the mean.
Vectors sit in a hashed table and are trained with the softmax, in numpy, so a
misspelling that was never seen shares most of its n-grams' vectors with the
word it stands for.

The model learns from a bounded sample: SAMPLE documents of each label with the
smallest hashes, weighted back to the labels' true shares. As everything is
linear up to the softmax, a trained table folds to one number per cell, and a
whole text is scored in one pass over its bytes.

Nulls: a null or empty text has an empty bag and the score of the bias alone.
Null labels are not learned from; a document with both labels is learned once
for each, repeated rows are learned once. Without a label of both kinds every score is 0.5 of the missing
evidence: the share of label 1, or 0 without labels. A null doc_id joins no
label. Repeated rows get equal scores. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskweft.llm.common import crc_mod
from riskweft.llm.words import _BYTE, _power_tables, mix, pieces, text_bytes
from riskweft.session import stage

GRAMS = (3, 4, 5)
CELL_BITS = 16
DIMENSIONS = 8
SAMPLE = 1500
EPOCHS = 16
BATCH = 64
RATE = 0.3
#: A mean over thousands of n-grams is small; inputs are scaled by this.
GAIN = 64.0
CUT = 0.3
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def cells_of(texts: list[bytes], bits: int = CELL_BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word by word: cells of the n-grams and of the word; first cell of each word; cells of each word; the word's text."""
    folded = b" " + b" ".join(texts).translate(_FOLD) + b" "
    data = np.frombuffer(folded, np.uint8)
    solid = data != 32
    edges = np.flatnonzero(solid[1:] != solid[:-1]) + 1
    starts, ends = edges[0::2], edges[1::2]
    text = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), starts - 1, side="right")
    up, down = _power_tables(len(data) + 1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * up[: len(data)])])
    shift = np.uint64(64 - bits)

    def cell(a: np.ndarray, b: np.ndarray, tag: int) -> np.ndarray:
        return (mix((total[b] - total[a]) * down[a] + np.uint64(tag)) >> shift).astype(np.int64)

    room = ends - starts + 2
    counts = [np.maximum(room - n + 1, 0) for n in GRAMS]
    many = 1 + sum(counts)
    first = np.cumsum(many) - many
    out = np.empty(int(many.sum()), np.int64)
    out[first] = cell(starts, ends, 1)
    at = first + 1
    for n, k in zip(GRAMS, counts):
        inner = np.arange(int(k.sum())) - np.repeat(np.cumsum(k) - k, k)
        a = np.repeat(starts - 1, k) + inner
        out[np.repeat(at, k) + inner] = cell(a, a + n, n)
        at = at + k
    return out, first, many, text


def bags(texts: list[bytes], bits: int = CELL_BITS) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per text: distinct cells and their share of the document's mean."""
    cells, _, many, text = cells_of(texts, bits)
    words = np.bincount(text, minlength=len(texts))
    weight = np.repeat(1.0 / (many * words[text]), many)
    owner = np.repeat(text, many)
    bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
    out = []
    for a, b in zip(bounds[:-1], bounds[1:]):
        found, index = np.unique(cells[a:b], return_inverse=True)
        out.append((found.astype(np.int32), np.bincount(index.reshape(-1), weights=weight[a:b]).astype(np.float32)))
    return out


def train(examples: list[tuple[np.ndarray, np.ndarray, int]], weights: tuple[float, float], bits: int = CELL_BITS, seed: int = 11) -> tuple[np.ndarray, float]:
    """examples: cells, shares, label. Returns one number per cell and a bias: the difference of the two classes' logits."""
    r = np.random.default_rng(seed)
    # Vectors start at zero, so a cell that was never seen says nothing.
    e, w, c = np.zeros((1 << bits, DIMENSIONS), np.float32), r.normal(0, 0.5, (DIMENSIONS, 2)).astype(np.float32), np.zeros(2, np.float32)
    seen = np.full((1 << bits, 1), 1e-4, np.float32)
    step, steps = 0, EPOCHS * -(-len(examples) // BATCH)
    for _ in range(EPOCHS):
        order = r.permutation(len(examples))
        for at in range(0, len(order), BATCH):
            part = [examples[i] for i in order[at : at + BATCH]]
            # Only the cells that occur in the batch are touched.
            cells, index = np.unique(np.concatenate([x[0] for x in part]), return_inverse=True)
            x = np.zeros((len(part), len(cells)), np.float32)
            x[np.repeat(np.arange(len(part)), [len(q[0]) for q in part]), index.reshape(-1)] = np.concatenate([q[1] for q in part]) * GAIN
            y = np.array([q[2] for q in part])
            h = x @ e[cells]
            logits = h @ w + c
            d = np.exp(logits - logits.max(axis=1, keepdims=True))
            d /= d.sum(axis=1, keepdims=True)
            d[np.arange(len(y)), y] -= 1
            d *= np.array(weights, np.float32)[y][:, None] / len(y)
            rate = RATE * (1 - 0.95 * step / steps)
            step += 1
            down_w, down_e = h.T @ d, x.T @ (d @ w.T)
            # Adagrad by cell: rare n-grams learn in large steps, frequent ones in small.
            seen[cells] += (down_e * down_e).mean(axis=1, keepdims=True)
            e[cells] -= rate * down_e / np.sqrt(seen[cells])
            w -= 0.1 * rate * down_w
            c -= 0.1 * rate * d.sum(axis=0)
    return (e @ (w[:, 1] - w[:, 0]) * GAIN).astype(np.float64), float(c[1] - c[0])


def learn(docs: DataFrame, labels: DataFrame, per_label: int = SAMPLE) -> tuple[np.ndarray, float]:
    """docs: doc_id, text of the rows to learn from; labels: doc_id, toxic."""
    known = labels.select(F.col("doc_id").alias("id"), F.col("toxic").cast("int").alias("y")).where("y IN (0, 1)")
    # The sample is chosen by hashes alone; only its texts are fetched.
    hashed = docs.select(F.col("doc_id").alias("id"), F.xxhash64("doc_id", "text").alias("h"))
    rows = stage(hashed.join(known, "id").select("y", "id", "h").distinct(), "toxic-labels")
    shares = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    total = sum(shares.values())
    if len(shares) < 2:
        known_share = float(1 in shares)
        return np.zeros(1 << CELL_BITS), 30.0 if known_share else -30.0
    # First within slices of a label, then over what the slices leave.
    slices, place = Window.partitionBy("y", "slice").orderBy("h", "id"), Window.partitionBy("y").orderBy("h", "id")
    rows = rows.withColumn("slice", F.pmod("h", F.lit(64))).withColumn("k", F.row_number().over(slices)).where(F.col("k") <= per_label)
    chosen = stage(rows.withColumn("k", F.row_number().over(place)).where(F.col("k") <= per_label).select("y", "id", "h", "k"), "toxic-sample")
    texts = docs.select(F.col("doc_id").alias("id"), F.xxhash64("doc_id", "text").alias("h"), F.col("text").cast("string").alias("text"))
    # At most per_label rows of each label.
    sample = texts.join(F.broadcast(chosen), ["id", "h"]).select("y", "k", "text").dropDuplicates(["y", "k"])

    def bag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            found = bags(text_bytes(batch.column("text")))
            columns = [batch.column("y"), batch.column("k"), pa.array([c.tobytes() for c, _ in found], pa.binary()), pa.array([w.tobytes() for _, w in found], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["y", "k", "cells", "shares"])

    got = sample.mapInArrow(bag, "y int, k int, cells binary, shares binary").toArrow()  # at most per_label rows of each label, of at most one entry per cell
    order = sorted(range(got.num_rows), key=lambda i: (got["y"][i].as_py(), got["k"][i].as_py()))
    examples = [(np.frombuffer(got["cells"][i].as_buffer(), np.int32), np.frombuffer(got["shares"][i].as_buffer(), np.float32), got["y"][i].as_py()) for i in order]
    counts = np.bincount([x[2] for x in examples], minlength=2)
    weights = tuple(float(shares[y] / total * len(examples) / max(counts[y], 1)) for y in (0, 1))
    return train(examples, weights)


def score(docs: DataFrame, table: np.ndarray, bias: float, carry: tuple[str, ...] = ("doc_id",), cut: float = CUT) -> DataFrame:
    """carry columns, score, predicted. Only the text is an input."""
    rows = docs.select(*(F.col(c).alias(f"__{c}") for c in carry), F.col("text").cast("string").alias("__text"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "__text"):
            texts = text_bytes(batch.column("__text"))
            cells, first, many, text = cells_of(texts)
            words = np.add.reduceat(table[cells], first) / many if len(first) else np.zeros(0)
            logit = np.bincount(text, weights=words, minlength=len(texts)) / np.maximum(np.bincount(text, minlength=len(texts)), 1) + bias
            p = 1.0 / (1.0 + np.exp(-np.clip(logit, -60, 60)))
            kept = [batch.column(f"__{c}") for c in carry]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(p), pa.array((p >= cut).astype(np.int32))], [*carry, "score", "predicted"])

    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in carry)
    return rows.mapInArrow(read, f"{kinds}, score double, predicted int")


def judge(docs: DataFrame, labels: DataFrame, held_part: int = 2, parts: int = 4) -> DataFrame:
    """doc_id, held_out, score, predicted: learns from the rows that are not held out, scores all."""
    table, bias = learn(docs.where(crc_mod(F.col("doc_id"), parts) != held_part), labels)
    return score(docs, table, bias).withColumn("held_out", crc_mod(F.col("doc_id"), parts) == held_part)
