"""Exact nearest neighbours of every row, and the opposite-label rate.

Equal vectors are folded first, so a large group of copies is one row. The
distinct vectors are assigned to their closest pivot; a first pass inside each
cell gives every vector an upper bound, and a second pass visits only those
cells that the triangle inequality cannot rule out.

The vectors of a cell are packed into blocks of bounded size, and each pass goes
over pairs of blocks: a task holds one part of the residents and streams one part
of the visitors past it. Vectors are written once and read again by each task, so
disk grows with the number of vectors, though the comparisons grow with its
square; a task emits only the best few candidates per visitor.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from riskweft.operators.splitting import hash_order
from riskweft.session import stage
from riskweft.sources.contract import SEED

CHUNK = 2_000
MAX_PIVOTS = 256


def standardized_vectors(df: DataFrame, columns: Sequence[str], keep: Sequence[str], vector: str = "vec") -> DataFrame:
    """Columns scaled by their sample deviation (0 counts as 1) and packed into one array."""
    stats = df.agg(*[F.struct(F.avg(c), F.stddev_samp(c)).alias(c) for c in columns]).first()
    scaled = [(F.col(c) - F.lit(stats[c][0])) / F.lit(stats[c][1] or 1.0) for c in columns]
    return df.select(*keep, F.array(*scaled).alias(vector))


def standardize_array(df: DataFrame, array: str, keep: Sequence[str], vector: str = "vec") -> DataFrame:
    """Cells scaled like standardized_vectors; the width is that of the data, and vectors of several widths are refused."""
    widths = df.agg(F.min(F.size(array)).alias("low"), F.max(F.size(array)).alias("high")).first()
    if widths["low"] != widths["high"]:
        raise ValueError(f"vectors have between {widths['low']} and {widths['high']} cells")
    size = widths["low"] or 0
    cells = df.select(*keep, *[F.get(array, F.lit(i)).cast("double").alias(f"_x{i}") for i in range(size)])
    return standardized_vectors(cells, [f"_x{i}" for i in range(size)], keep, vector)


def _fold_copies(df: DataFrame, key: str, label: str, vector: str, rank: int) -> DataFrame:
    """One row per distinct vector with its rank + 1 smallest keys and the label counts.

    The row-number filter is a group limit, applied before the shuffle as well:
    a task never receives more than rank + 1 rows per map task of one vector.
    """
    first = Window.partitionBy(vector).orderBy(key)
    heads = df.select(key, label, vector).withColumn("_r", F.row_number().over(first)).where(F.col("_r") <= rank + 1)
    listed = heads.groupBy(vector).agg(
        F.array_sort(F.collect_list(F.struct(F.col(key).alias("id"), F.col(label).cast("int").alias("label")))).alias("heads")
    )
    counts = df.groupBy(vector, label).agg(F.count(F.lit(1)).alias("_n")).groupBy(vector).agg(
        F.sum("_n").alias("copies"),
        F.map_from_entries(F.collect_list(F.struct(F.col(label).cast("int"), F.col("_n")))).alias("by_label"),
    )
    return listed.join(counts, vector).select(F.col("heads")[0]["id"].alias("vid"), F.col(vector).alias("vec"), "heads", "copies", "by_label")


def _assign(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Add cell (closest pivot) and radius (distance to it)."""
    def assign(batches):
        for pdf in batches:
            x = np.stack(pdf["vec"].to_numpy()) if len(pdf) else np.empty((0, pivots.shape[1]))
            d = np.stack([np.sqrt(((x - p) ** 2).sum(axis=1)) for p in pivots], axis=1)
            cell = d.argmin(axis=1)
            yield pdf.assign(cell=cell.astype("int32"), radius=d[np.arange(len(pdf)), cell] if len(pdf) else [])

    return vectors.mapInPandas(assign, "vid bigint, vec array<double>, heads array<struct<id:bigint,label:int>>, cell int, radius double")


_CANDIDATE = "vid bigint, dist double, id bigint, label int"


#: Visitors of one matrix product.
BLOCK = 512
#: Bytes of vectors in one part of the residents.
PART_BYTES = 32 << 20

_PACKED = "cell int, n int, vid binary, vec binary, bound binary, many binary, head_id binary, head_label binary"


def _packed(residents: DataFrame, chunk: int) -> DataFrame:
    """Blocks of up to about chunk vectors of one cell; residents(vid, vec, heads, cell, bound), bound NaN where there is none."""
    sizes = _sizes(residents, chunk)
    many = [(c, n) for c, n in sizes.items() if n > 1]
    blocks = F.coalesce(F.create_map(*[F.lit(v) for pair in many for v in pair])[F.col("cell")], F.lit(1)) if many else F.lit(1)

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        heads = list(rows["heads"])
        cells = [
            rows["vid"].to_numpy("int64"), np.stack(rows["vec"].to_numpy()).astype("float64"), rows["bound"].to_numpy("float64"), np.array([len(h) for h in heads], "int32"),
            np.array([x["id"] for h in heads for x in h], "int64"), np.array([x["label"] for h in heads for x in h], "float64"),
        ]
        return pd.DataFrame([[rows["cell"].iloc[0], len(rows), *[np.ascontiguousarray(c).tobytes() for c in cells]]], columns=[x.split()[0] for x in _PACKED.split(", ")])

    dealt = residents.withColumn("chunk", F.pmod(F.xxhash64("vid"), blocks).cast("int"))
    return dealt.select("cell", "chunk", "vid", "vec", "heads", "bound").groupBy("cell", "chunk").applyInPandas(pack, _PACKED)


class _Vectors:
    """The arrays of one block."""

    def __init__(self, n: int, vid: bytes, vec: bytes, bound: bytes):
        self.vid, self.bound = np.frombuffer(vid, "int64"), np.frombuffer(bound, "float64")
        self.vec = np.frombuffer(vec, "float64").reshape(n, -1)


class _Residents(_Vectors):
    """Also the first few heads of each vector."""

    def __init__(self, n: int, vid: bytes, vec: bytes, bound: bytes, many: bytes, head_id: bytes, head_label: bytes, needed: int):
        super().__init__(n, vid, vec, bound)
        whole = np.frombuffer(many, "int32").astype("int64")
        first = np.cumsum(whole) - whole
        self.many = np.minimum(whole, needed)
        taken = np.repeat(first, self.many) + _within(self.many)
        self.head_id, self.head_label = np.frombuffer(head_id, "int64")[taken], np.frombuffer(head_label, "float64")[taken]
        self.first = np.cumsum(self.many) - self.many
        self.norms = (self.vec**2).sum(axis=1)


def _within(many: np.ndarray) -> np.ndarray:
    """0, 1, ... inside each of the runs of the given lengths."""
    return np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)


_Found = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def _best_rows(found: list[_Found], needed: int) -> _Found:
    """Of (visitor, dist, id, label) the best few of each visitor."""
    i, dist, ids, labels = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((ids, dist, i))
    i, dist, ids, labels = i[order], dist[order], ids[order], labels[order]
    kept = np.arange(len(i)) - np.searchsorted(i, i) < needed
    return i[kept], dist[kept], ids[kept], labels[kept]


def _closest(visitors: _Vectors, rows: np.ndarray, residents: _Residents, needed: int) -> list[_Found]:
    """Best candidates of some visitors among the residents of one block.

    A matrix product gives all distances of a block up to rounding; residents
    that may be among the needed ones are measured again, exactly.
    """
    found = []
    data, many = residents.vec, residents.many
    for start in range(0, len(rows), BLOCK):
        at = rows[start : start + BLOCK]
        vecs = visitors.vec[at]
        size = (vecs**2).sum(axis=1)
        square = size[:, None] + residents.norms[None, :] - 2 * (vecs @ data.T)
        slack = 1e-9 * (size[:, None] + residents.norms[None, :] + 1)
        square[visitors.vid[at][:, None] == residents.vid[None, :]] = np.inf
        last = min(needed, len(data)) - 1
        kth = np.partition(square + slack, last, axis=1)[:, last]
        i, j = np.nonzero((square - slack <= kth[:, None]) & np.isfinite(square))
        exact = np.sqrt(((data[j] - vecs[i]) ** 2).sum(axis=1))
        # What lies beyond a visitor's bound cannot be among its nearest.
        near = ~(exact > visitors.bound[at[i]])
        i, j, exact = i[near], j[near], exact[near]
        head = np.repeat(residents.first[j], many[j]) + _within(many[j])
        found.append(_best_rows([(np.repeat(at[i], many[j]), np.repeat(exact, many[j]), residents.head_id[head], residents.head_label[head])], needed))
    return found


_Reach = Callable[[int, np.ndarray, np.ndarray, int], np.ndarray]


def _search(visitors: DataFrame, residents: DataFrame, needed: int, reach: _Reach | None = None) -> DataFrame:
    """Best candidates of visitors among the residents of the cells in their goals; both are packed, visitors also have goals.

    Pairs of blocks are joined without a key: each task reads one part of both
    tables, so no vector is copied for the cells or blocks that it visits.
    reach(home, vectors, bounds, cell) says which visitors have to look at a cell.
    """
    facts = residents.agg(F.count(F.lit(1)).alias("blocks"), F.sum(F.length("vec")).alias("bytes")).first()
    parts = max(1, min(facts["blocks"], -(-(facts["bytes"] or 0) // PART_BYTES)))
    parallelism = 2 * residents.sparkSession.sparkContext.defaultParallelism
    streams = max(1, min(visitors.count(), max(parts, -(-parallelism // parts))))
    left = visitors.select(*[F.col(c).alias(f"v_{c}") for c in ("cell", "n", "vid", "vec", "bound")], "goals")
    pairs = left.repartition(streams).join(residents.repartition(parts).hint("shuffle_replicate_nl"), F.array_contains("goals", F.col("cell")))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, best = None, []

        def flush() -> pa.RecordBatch:
            i, dist, ids, labels = _best_rows(best, needed)
            known = ~np.isnan(labels)
            return pa.RecordBatch.from_arrays(
                [pa.array(held[1].vid[i]), pa.array(dist), pa.array(ids), pa.array(np.where(known, labels, 0).astype("int32"), mask=~known)], ["vid", "dist", "id", "label"],
            )

        for batch in batches:
            for r in range(batch.num_rows):
                row = {c: batch.column(c)[r].as_py() for c in ("v_cell", "v_n", "v_vid", "cell", "n", "vid", "vec", "bound", "many", "head_id", "head_label")}
                # Rows of one visitor block follow each other.
                if held is None or held[0] != row["v_vid"]:
                    if best:
                        yield flush()
                    held, best = (row["v_vid"], _Vectors(row["v_n"], row["v_vid"], batch.column("v_vec")[r].as_py(), batch.column("v_bound")[r].as_py())), []
                block = held[1]
                rows = np.arange(len(block.vid)) if reach is None else np.flatnonzero(reach(row["v_cell"], block.vec, block.bound, row["cell"]))
                if len(rows):
                    found = _closest(block, rows, _Residents(*[row[c] for c in ("n", "vid", "vec", "bound", "many", "head_id", "head_label")], needed), needed)
                    best = [_best_rows([*best, *found], needed)]
        if best:
            yield flush()

    return pairs.mapInArrow(compare, _CANDIDATE)


def _keep_best(candidates: DataFrame, needed: int) -> DataFrame:
    order = Window.partitionBy("vid").orderBy("dist", "id")
    return candidates.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= needed)


def _sizes(df: DataFrame, chunk: int) -> dict[int, int]:
    return {r["cell"]: -(-r["count"] // chunk) for r in df.groupBy("cell").count().collect()}


def opposite_label_rate(df: DataFrame, key: str, label: str, vector: str, rank: int = 2, chunk: int = CHUNK, pivots: int | None = None) -> DataFrame:
    """One row (rows, opposite, opposite_rate): how often the rank-th nearest other row has another label.

    Distances are Euclidean on the vectors as given, ties go to the smaller key.
    """
    if rank not in (1, 2):
        raise ValueError("rank must be 1 or 2")
    folded = stage(_fold_copies(df, key, label, vector, rank), "vectors")
    distinct = folded.count()
    wanted = pivots or int(min(MAX_PIVOTS, max(1, distinct // (2 * chunk))))
    # A bounded pivot table: the vectors with the smallest hashes.
    chosen = folded.orderBy(hash_order("vid", SEED)).limit(wanted).select("vec").collect()
    table = np.array([r["vec"] for r in chosen], dtype=float)
    residents = stage(_assign(folded.select("vid", "vec", "heads"), table), "cells")
    home = residents.withColumn("bound", F.lit(float("nan")))
    packed = stage(_packed(home, chunk), "blocks")
    near = stage(_search(packed.withColumn("goals", F.array("cell")), packed, rank), "near")
    best = _keep_best(near, rank)
    if len(chosen) > 1:
        bound = best.groupBy("vid").agg(F.when(F.count(F.lit(1)) >= rank, F.max("dist")).alias("bound"))
        rings = {r["cell"]: (r["lo"], r["hi"]) for r in residents.groupBy("cell").agg(F.min("radius").alias("lo"), F.max("radius").alias("hi")).collect()}
        reach = _reach(table, rings)
        bounded = residents.join(bound, "vid", "left").withColumn("bound", F.coalesce("bound", F.lit(float("nan"))))
        visitors = stage(_with_goals(_packed(bounded, chunk), sorted(rings), reach), "visitors")
        far = stage(_search(visitors.where(F.size("goals") > 0), packed, rank, reach), "far")
        best = _keep_best(near.unionByName(far), rank)
    ranked = best.groupBy("vid").agg(*[F.max(F.when(F.col("_r") == i, F.col("label"))).alias(f"out{i}") for i in (1, 2)])
    return _rate(folded.drop("vec").join(ranked, "vid", "left"), rank)


def _reach(pivots: np.ndarray, rings: dict[int, tuple[float, float]]) -> _Reach:
    """Which vectors of one cell may have a closer vector in another one."""
    def reach(home: int, vecs: np.ndarray, bounds: np.ndarray, cell: int) -> np.ndarray:
        if cell == home:
            return np.zeros(len(vecs), bool)
        low, high = rings[cell]
        limit = np.where(np.isnan(bounds), np.inf, bounds * (1 + 1e-9) + 1e-9)
        d = np.sqrt(((vecs - pivots[cell]) ** 2).sum(axis=1))
        own = np.sqrt(((vecs - pivots[home]) ** 2).sum(axis=1))
        apart = np.sqrt(((pivots[cell] - pivots[home]) ** 2).sum())
        # Distance to the plane between the two pivots, and to the ring the cell occupies.
        plane = (d**2 - own**2) / (2 * apart) if apart > 0 else np.zeros(len(vecs))
        return (plane <= limit) & (d - high <= limit) & (low - d <= limit)

    return reach


def _with_goals(packed: DataFrame, cells: list[int], reach: _Reach) -> DataFrame:
    """Blocks with the cells that at least one of their vectors has to look at."""
    def goals(batches):
        for pdf in batches:
            found = []
            for home, n, vid, vec, bound in zip(pdf["cell"], pdf["n"], pdf["vid"], pdf["vec"], pdf["bound"]):
                block = _Vectors(n, vid, vec, bound)
                found.append([c for c in cells if reach(home, block.vec, block.bound, c).any()])
            yield pdf.assign(goals=found)

    return packed.mapInPandas(goals, f"{_PACKED}, goals array<int>")


def _rate(folded: DataFrame, rank: int) -> DataFrame:
    """Count opposite labels, copies first: they are each other's nearest neighbours."""
    def label_of(i: int) -> Column:
        return F.get("heads", F.lit(i))["label"]

    def differing(reference: Column, members: Column) -> Column:
        """Members of the copy group (as label counts) whose label differs from reference."""
        same = F.coalesce(F.try_element_at(members, reference), F.lit(0))
        total = F.aggregate(F.map_values(members), F.lit(0).cast("bigint"), lambda s, v: s + v)
        return total - same

    def one(differs: Column) -> Column:
        return F.when(differs, 1).otherwise(0).cast("bigint")

    copies = F.col("copies")
    if rank == 1:
        # With copies: the first sees the second, all others see the first.
        inside = differing(label_of(0), F.col("by_label")) + one(label_of(0) != label_of(1))
        opposite = F.when(copies >= 2, inside).otherwise(one(F.col("out1") != label_of(0)))
        counted = F.when((copies >= 2) | F.col("out1").isNotNull(), copies).otherwise(0)
    else:
        # Three or more copies: first and second see the third, all others see the second.
        others = differing(label_of(1), F.col("by_label")) - one(label_of(0) != label_of(1))
        inside = others + one(label_of(0) != label_of(2)) + one(label_of(1) != label_of(2))
        pair = one(F.col("out1") != label_of(0)) + one(F.col("out1") != label_of(1))
        opposite = F.when(copies >= 3, inside).when(copies == 2, pair).otherwise(one(F.col("out2") != label_of(0)))
        known = F.when(copies >= 3, True).when(copies == 2, F.col("out1").isNotNull()).otherwise(F.col("out2").isNotNull())
        counted = F.when(known, copies).otherwise(0)
    sums = folded.agg(F.sum(counted).alias("rows"), F.sum(opposite).alias("opposite"))
    return sums.select("rows", "opposite", F.coalesce(F.try_divide("opposite", "rows"), F.lit(0.0)).alias("opposite_rate"))
