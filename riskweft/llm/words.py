"""Word and shingle hashes of whole texts in numpy, and Arrow helpers for tasks that work on them.

Words are runs of anything but ASCII white space, with A-Z lower-cased. A word's
64-bit hash does not depend on where the word stands, so a long text can be cut
at any white space.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (makes pa.compute)

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Bytes of text that are hashed at once.
PIECE = 1 << 20
_SPACES = bytes([9, 10, 11, 12, 13, 32])
_FOLD = bytes(32 if b in _SPACES else b + 32 if 65 <= b <= 90 else b for b in range(256))


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _U(0xD1B54A32D192ED03))
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, PIECE + 2)
        up, down = np.full(size, _BASE, np.uint64), np.full(size, _INVERSE, np.uint64)
        up[0] = down[0] = 1
        _powers[:] = [np.multiply.accumulate(up), np.multiply.accumulate(down)]
    return _powers[0], _powers[1]


def _hash_piece(folded: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the words in a text whose white space is all spaces, and their hashes."""
    text = np.frombuffer(b" " + folded + b" ", np.uint8)
    solid = text != 32
    edges = np.flatnonzero(solid[1:] != solid[:-1]) + 1
    starts, ends = edges[0::2], edges[1::2]
    up, down = _power_tables(len(text))
    total = np.cumsum(_BYTE[text] * up[: len(text)])
    return starts - 1, mix((total[ends - 1] - total[starts - 1]) * down[starts] + (ends - starts).astype(np.uint64))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts one after the other, and how many each text has."""
    counts, hashes = np.zeros(len(texts), np.int64), []
    for first, last in _runs([len(t) for t in texts]):
        if last - first == 1 and len(texts[first]) > PIECE:
            found = [_hash_piece(x)[1] for x in _cut(texts[first].translate(_FOLD))]
            counts[first] = sum(map(len, found))
            hashes += found
            continue
        starts, h = _hash_piece(b" ".join(texts[first:last]).translate(_FOLD))
        bounds = np.cumsum([0] + [len(t) + 1 for t in texts[first:last]])
        counts[first:last] = np.diff(np.searchsorted(starts, bounds))
        hashes.append(h)
    return (np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)), counts


def _runs(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Neighbouring texts of at most PIECE bytes together; a longer text by itself."""
    first, held = 0, 0
    for i, size in enumerate(sizes):
        if i > first and held + size + 1 > PIECE:
            yield first, i
            first, held = i, 0
        held += size + 1
    if sizes:
        yield first, len(sizes)


def _cut(text: bytes) -> Iterator[bytes]:
    at = 0
    while at < len(text):
        end = min(at + PIECE, len(text))
        if end < len(text):
            space = text.rfind(b" ", at, end)
            if space <= at:
                space = text.find(b" ", end)
            end = space if space > 0 else len(text)
        yield text[at:end]
        at = end + 1


def _factors(k: int) -> np.ndarray:
    return mix(np.arange(1, k + 1, dtype=np.uint64) * _U(0xA0761D6478BD642F)) | _U(1)


def windows(hashes: np.ndarray, offsets: tuple[int, ...]) -> np.ndarray:
    """For each start i, a hash of the words at i + offset. Starts whose last word is beyond the end are left out."""
    n = len(hashes) - offsets[-1]
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for offset, factor in zip(offsets, _factors(len(offsets))):
        total += hashes[offset : offset + n] * factor
    return mix(total + _U(len(offsets)))


def shingle_sets(texts: list[bytes], k: int = 5) -> list[np.ndarray]:
    """Sorted distinct k-word shingle hashes of each text; a shorter text is one shingle, a text without words has none."""
    hashes, counts = word_hashes(texts)
    every = windows(hashes, tuple(range(k)))
    sets, at = [], 0
    for n in counts.tolist():
        if n >= k:
            sets.append(np.unique(every[at : at + n - k + 1]))
        elif n:
            sets.append(windows(hashes[at : at + n], tuple(range(n))))
        else:
            sets.append(np.zeros(0, np.uint64))
        at += n
    return sets


def text_bytes(column: pa.Array) -> list[bytes]:
    """Texts of an Arrow string column as UTF-8; null is empty."""
    return [b"" if t is None else t for t in column.cast(pa.large_binary()).to_pylist()]


def pieces(batches: Iterator[pa.RecordBatch], column: str, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The batches again, cut so that the named text column of each holds about `limit` bytes, or one row."""
    for batch in batches:
        sizes = [0 if n is None else n for n in pa.compute.binary_length(batch.column(column)).to_pylist()]
        first = held = 0
        for i, size in enumerate(sizes):
            if i > first and held + size > limit:
                yield batch.slice(first, i - first)
                first, held = i, 0
            held += size
        if batch.num_rows > first:
            yield batch.slice(first)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
