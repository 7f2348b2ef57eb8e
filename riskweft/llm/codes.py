"""Vector code compression: product codes by Lloyd rounds that compare active entries only.

Components become integers, floor(SCALE * x), and a vector is cut into
consecutive parts. Each part position has a codebook that starts with the parts
of the smallest ids. A round assigns every part to the nearest entry (squared
distance, ties to the lower index), then moves each entry to the componentwise
floor of the mean of its parts; unused entries stay.

Between rounds each part keeps its entry and the exact distance to it. If that
entry did not move, the distance still holds and no entry that stayed can be
nearer, so the part is compared with the moved entries only; an entry with the
same distance wins by its index, as in a full scan. Parts whose own entry moved
scan all entries. Both give what a full scan of all parts gives.

A round reads the vectors once, writes them with their entries and distances to
the shared folder, and sums the parts of each entry in the tasks: the driver
receives parts x entries sums, whatever the number of vectors. The previous
round's table is dropped, so two copies exist at most.

Arithmetic is exact: products run in float64 while all sums stay below 2^53, else
in int64. Components beyond +-LIMIT are taken as +-LIMIT, which keeps every
distance inside 64 bits.

Defined results: rows whose vector is null or holds null or non-finite
components are dropped, and so are vectors of another length than the most
frequent one (ties: the shorter). A length that the parts do not divide is cut as
evenly as possible. A null id stands last; rows that share an id stand by their
vectors. Fewer vectors than entries give a shorter codebook, an empty table an
empty result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweft.session import release, stage

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
LIMIT = 1 << 24
#: Parts that are compared with all entries at once.
ROWS = 4096

#: vec_id, label and components, then what the last assignment found for each part.
STATE = "vec_id bigint, label string, x array<int>, entry array<int>, distance array<bigint>"


@dataclass(frozen=True)
class Codebooks:
    """One array of entries x components for each part position, and which entries moved last."""

    parts: tuple[np.ndarray, ...]
    moved: tuple[np.ndarray, ...]

    @property
    def dims(self) -> int:
        return sum(p.shape[1] for p in self.parts)

    def sha256(self) -> str:
        """Digest of all components, by part, entry and position, as decimal integers with commas."""
        return hashlib.sha256(",".join(str(c) for p in self.parts for c in p.ravel().tolist()).encode()).hexdigest()


def cuts(dims: int, parts: int) -> list[tuple[int, int]]:
    return [(dims * p // parts, dims * (p + 1) // parts) for p in range(parts)]


def _integers(x: Column, scale: int) -> Column:
    def whole(c: Column) -> Column:
        return F.floor(F.greatest(F.lit(float(-LIMIT)), F.least(F.lit(float(LIMIT)), c.cast("double") * F.lit(float(scale))))).cast("int")

    return F.transform(x, whole)


def kept_vectors(table: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", scale: int = SCALE) -> DataFrame:
    """vec_id, label, x (integers) of the rows that can be coded."""
    limit = F.lit(float("inf"))
    usable = F.col("v").isNotNull() & F.forall("v", lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < limit), F.lit(False)))
    rows = table.select(F.col(key).alias("vec_id"), F.col(label).cast("string").alias("label"), F.col(vector).alias("v")).where(usable)
    # One row for each length.
    common = rows.groupBy(F.size("v").alias("dims")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "dims").limit(1).select("dims")
    return rows.where(F.size("v") == common.scalar()).select("vec_id", "label", _integers(F.col("v"), scale).alias("x"))


def _rows(column: pa.ListArray, n: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(n, -1)


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    n, width = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(0, (n + 1) * width, width, dtype=np.int32) if width else np.zeros(n + 1, np.int32)), pa.array(values.ravel(), kind))


def squared_distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of int64 rows to int64 entries."""
    most = max(int(np.abs(x).max(initial=0)), int(np.abs(entries).max(initial=0)))
    if 4 * x.shape[1] * most * most < 1 << 53:
        a, b = x.astype(np.float64), entries.astype(np.float64)
        found = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2.0 * (a @ b.T)
        return found.astype(np.int64)
    found = np.zeros((len(x), len(entries)), np.int64)
    for d in range(x.shape[1]):
        found += (x[:, d, None] - entries[None, :, d]) ** 2
    return found


def assign_all(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entry, distance) of each part by a full scan; argmin takes the lowest index of equal ones."""
    entry, distance = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
    for at in range(0, len(x), ROWS):
        found = squared_distances(x[at : at + ROWS], book)
        best = found.argmin(axis=1)
        entry[at : at + ROWS] = best
        distance[at : at + ROWS] = found[np.arange(len(best)), best]
    return entry, distance


def assign_active(x: np.ndarray, book: np.ndarray, moved: np.ndarray, entry: np.ndarray, distance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same from the last assignment: full scans where the own entry moved, elsewhere moved entries against the stored distance."""
    entry, distance = entry.copy(), distance.copy()
    lost = moved[entry]
    if lost.any():
        entry[lost], distance[lost] = assign_all(x[lost], book)
    active, fixed = np.flatnonzero(moved), np.flatnonzero(~lost)
    if len(active) and len(fixed):
        # active is ascending, so the first of equal moved entries has the lowest index.
        best, near = assign_all(x[fixed], book[active])
        best = active[best]
        better = (near < distance[fixed]) | ((near == distance[fixed]) & (best < entry[fixed]))
        entry[fixed[better]], distance[fixed[better]] = best[better], near[better]
    return entry, distance


def _assign(vectors: DataFrame, books: Codebooks, parts: int, first: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            x = _rows(batch.column("x"), n)
            if first:
                old_entry = old_distance = np.zeros((n, parts), np.int64)
            else:
                old_entry, old_distance = _rows(batch.column("entry"), n), _rows(batch.column("distance"), n)
            entry, distance = np.zeros((n, parts), np.int64), np.zeros((n, parts), np.int64)
            for p, (low, high) in enumerate(cuts(books.dims, parts)):
                if first:
                    entry[:, p], distance[:, p] = assign_all(x[:, low:high], books.parts[p])
                else:
                    entry[:, p], distance[:, p] = assign_active(x[:, low:high], books.parts[p], books.moved[p], old_entry[:, p], old_distance[:, p])
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), batch.column("x"), _lists(entry, pa.int32()), _lists(distance, pa.int64())],
                ["vec_id", "label", "x", "entry", "distance"],
            )

    return vectors.mapInArrow(run, STATE)


def _sums(state: DataFrame, dims: int, parts: int, entries: int) -> dict[tuple[int, int], tuple[int, np.ndarray]]:
    """(part, entry) -> how many parts it has and their componentwise sum."""
    places = cuts(dims, parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((parts, entries), np.int64)
        sums = [np.zeros((entries, high - low), np.int64) for low, high in places]
        for batch in batches:
            if not batch.num_rows:
                continue
            x, entry = _rows(batch.column("x"), batch.num_rows), _rows(batch.column("entry"), batch.num_rows)
            for p, (low, high) in enumerate(places):
                counts[p] += np.bincount(entry[:, p], minlength=entries)
                np.add.at(sums[p], entry[:, p], x[:, low:high])
        used = [(p, e) for p in range(parts) for e in np.flatnonzero(counts[p]).tolist()]
        yield pa.RecordBatch.from_pydict({
            "part": pa.array([p for p, _ in used], pa.int32()), "entry": pa.array([e for _, e in used], pa.int32()),
            "n": pa.array([int(counts[k]) for k in used], pa.int64()), "total": pa.array([sums[p][e].tolist() for p, e in used], pa.list_(pa.int64())),
        })

    partial = state.select("x", "entry").mapInArrow(run, "part int, entry int, n bigint, total array<bigint>")
    widest = max(high - low for low, high in places)
    # Sums of parts x entries rows, one for each component position.
    positions = [F.sum(F.get("total", F.lit(d))).alias(f"s{d}") for d in range(widest)]
    rows = partial.groupBy("part", "entry").agg(F.sum("n").alias("n"), *positions).collect()
    return {(r["part"], r["entry"]): (r["n"], np.array([r[f"s{d}"] for d in range(places[r["part"]][1] - places[r["part"]][0])], np.int64)) for r in rows}


def moved_books(books: Codebooks, sums: dict[tuple[int, int], tuple[int, np.ndarray]]) -> Codebooks:
    parts, moved = [], []
    for p, old in enumerate(books.parts):
        new = old.copy()
        for e in range(len(old)):
            if (p, e) in sums:
                n, total = sums[p, e]
                new[e] = total // n
        parts.append(new)
        moved.append((new != old).any(axis=1))
    return Codebooks(tuple(parts), tuple(moved))


def first_books(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> Codebooks | None:
    """The parts of the vectors with the smallest ids; at most `entries` rows come to the driver."""
    chosen = [r["x"] for r in vectors.orderBy(F.col("vec_id").asc_nulls_last(), "x").select("x").limit(entries).collect()]
    if not chosen:
        return None
    x = np.array(chosen, np.int64).reshape(len(chosen), -1)
    books = tuple(x[:, low:high] for low, high in cuts(x.shape[1], parts))
    return Codebooks(books, tuple(np.ones(len(b), bool) for b in books))


def compress(
    table: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
    scale: int = SCALE,
) -> tuple[DataFrame, Codebooks]:
    """(vec_id, label, x, entry and distance of each part), staged, and the final codebooks."""
    vectors = stage(kept_vectors(table, key, vector, label, scale), "codes-vectors")
    books = first_books(vectors, parts, entries)
    if books is None:
        empty = vectors.withColumn("entry", F.array().cast("array<int>")).withColumn("distance", F.array().cast("array<bigint>"))
        return empty, Codebooks((), ())
    state = stage(_assign(vectors, books, parts, True), "codes-round")
    release(vectors)
    for _ in range(rounds):
        books = moved_books(books, _sums(state, books.dims, parts, entries))
        before, state = state, stage(_assign(state, books, parts, False), "codes-round")
        release(before)
    return state, books


def code_text(entry: Column) -> Column:
    """Entries as two hex digits each, in part order."""
    return F.array_join(F.transform(entry, lambda e: F.lower(F.lpad(F.hex(e.cast("bigint")), 2, "0"))), "")


def decode(codes: DataFrame, books: Codebooks, scale: int = SCALE) -> DataFrame:
    """vec_id and the vector that its code stands for: the middle of each component's integer step."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                entry = _rows(batch.column("entry"), batch.num_rows)
                x = np.concatenate([b[entry[:, p]] for p, b in enumerate(books.parts)], axis=1)
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), _lists((x + 0.5) / scale, pa.float64())], ["vec_id", "embedding"])

    return codes.select("vec_id", "entry").mapInArrow(run, "vec_id bigint, embedding array<double>")


def label_errors(codes: DataFrame, hot_share: float = 0.001) -> DataFrame:
    """vec_id, code parts, error, and label_error: the error of all rows of a label, nulls together (null if it passes 64 bits).

    Labels with more than hot_share of all rows, at most 1 / hot_share of them,
    are attached by broadcast, the others by a shuffle in which none is large.
    """
    rows = codes.select("vec_id", "entry", F.aggregate("distance", F.lit(0).cast("bigint"), lambda a, d: a + d).alias("error"), "label")
    rows = rows.withColumn("key", F.struct(F.col("label").isNull().alias("none"), F.coalesce("label", F.lit("")).alias("value"))).drop("label")
    sums = stage(rows.groupBy("key").agg(F.try_sum("error").alias("label_error"), F.count(F.lit(1)).alias("n")), "codes-labels")
    is_hot = F.col("n") > F.coalesce(sums.agg(F.sum("n")).scalar(), F.lit(0)) * hot_share
    hot, cold = sums.where(is_hot).drop("n"), sums.where(~is_hot).drop("n")
    by_broadcast = rows.join(F.broadcast(hot), "key")
    rest = rows.join(F.broadcast(hot.select("key")), "key", "left_anti").join(cold, "key")
    return by_broadcast.unionByName(rest).drop("key")
