"""Embedding near-dedup by int8 tile products with rigorous error bounds.

Each unit vector x is written as s * q with int8 codes q and a rest of norm e.
For two vectors

    |x . y - s_x s_y (q_x . q_y)| <= |s_x q_x| e_y + e_x |s_y q_y| + e_x e_y

and the product of codes is exact (in float32, in parts of 1024 dimensions), so
a tile product bounds every cosine. Only pairs whose upper bound reaches the
threshold are computed again in double precision.

Tiles: equal vectors are folded first. PIVOTS vectors of the table, those with
the smallest hashes, part the rest into cells with a known radius, and a vector
visits a cell only if the triangle inequality on angles leaves room for a
partner there. Cells are cut into tiles of about TILE_ROWS rows. Visitors
stream past a tile; they are dealt to slices of about SLICE_ROWS rows, so a task
holds one tile and one batch and its work is bounded too. A task sends the
number of links of each vector and the edges of a spanning forest, not its pairs.

Null vectors, zero vectors, vectors without components or with null or
non-finite ones link with nothing; vectors of different lengths do not link. A
null vec_id stands last and comes back as null. Rows that share a vec_id are
judged by their own vectors. An empty table gives an empty result. Extra columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (makes pa.compute)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweft.llm.graph import components
from riskweft.session import stage

THRESHOLD = 0.9
PIVOTS = 16
TILE_ROWS = 8192
SLICE_ROWS = 65536
#: Far above what double arithmetic and the float32 comparison can be off by.
SLACK = 1e-5
#: Dimensions whose code products a float32 sum holds exactly.
EXACT_DIMS = 1024
_LAST = (1 << 63) - 1


def usable_vectors(table: DataFrame) -> DataFrame:
    """id, v (array of double), k1, k2 (a hash pair of the components); vectors that can link."""
    rows = table.select(F.coalesce(F.col("vec_id").cast("long"), F.lit(_LAST)).alias("id"), F.col("embedding").cast("array<double>").alias("v"))
    fine = F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))) & F.exists("v", lambda x: x != 0)
    rows = rows.where(F.col("v").isNotNull()).where(F.coalesce(fine, F.lit(False)))
    rows = rows.withColumn("v", F.transform("v", lambda x: x + F.lit(0.0)))  # -0.0 and 0.0 are one value
    return rows.withColumn("k1", F.xxhash64("v")).withColumn("k2", F.xxhash64(F.lit(1), "v"))


def _scaled(flat: np.ndarray, dim: int) -> np.ndarray:
    """Rows of vectors, each times a power of two, so that squares neither overflow nor vanish."""
    rows = flat.reshape(-1, dim)
    return np.ldexp(rows, -np.frexp(np.abs(rows).max(axis=1))[1][:, None])


def _units(rows: np.ndarray) -> np.ndarray:
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _codes(x: np.ndarray, scale: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes, norm of scale * code, norm of the rest."""
    codes = np.rint(x / scale).astype(np.int8)
    near = codes * scale
    return codes, np.sqrt((near * near).sum(axis=1)), np.sqrt(((x - near) ** 2).sum(axis=1))


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of int8 codes, exact."""
    parts = [a[:, i : i + EXACT_DIMS].astype(np.float32) @ b[:, i : i + EXACT_DIMS].astype(np.float32).T for i in range(0, a.shape[1], EXACT_DIMS)]
    return parts[0] if len(parts) == 1 else sum(p.astype(np.float64) for p in parts)


class _Tile:
    """A tile's vectors, their link counts so far, and which of them are known to be connected."""

    def __init__(self, rows: pa.Table, dim: int, threshold: float):
        self.nodes = rows.column("node").to_numpy()
        self.weight = rows.column("rows").to_numpy()
        self.raw = _scaled(np.frombuffer(b"".join(rows.column("v").to_pylist()), np.float64), dim)
        self.norm = np.sqrt((self.raw * self.raw).sum(axis=1))
        unit = self.raw / self.norm[:, None]
        self.scale = np.abs(unit).max() / 127.0
        codes, near, rest = _codes(unit, np.full((len(unit), 1), self.scale))
        self.codes, self.near, self.rest = codes, near.max(), rest.max()
        self.links = np.zeros(len(unit), np.int64)
        self.label = np.arange(len(unit))
        self.threshold, self.dim = threshold, dim

    def meet(self, rows: pa.Table) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]:
        """Visitors' nodes and link counts, and the edges that join what was not connected."""
        nodes, weight, own = (rows.column(c).to_numpy() for c in ("node", "rows", "own"))
        raw = _scaled(np.frombuffer(b"".join(rows.column("v").to_pylist()), np.float64), self.dim)
        norm = np.sqrt((raw * raw).sum(axis=1))
        unit = raw / norm[:, None]
        scale = np.abs(unit).max(axis=1) / 127.0
        codes, near, rest = _codes(unit, scale[:, None])
        error = near * self.rest + rest * self.near + rest * self.rest + SLACK
        low = ((self.threshold - error) / (scale * self.scale)).astype(np.float32)
        counts, edges = np.zeros(len(nodes), np.int64), []
        for first in range(0, len(nodes), 512):
            part = slice(first, first + 512)
            i, j = np.nonzero(_product(codes[part], self.codes) >= low[part, None])
            i = i + first
            fit = ~own[i] | (nodes[i] < self.nodes[j])  # inside a tile, each pair once
            i, j = i[fit], j[fit]
            sure = np.concatenate([self._exact(raw, norm, i[k : k + 65536], j[k : k + 65536]) for k in range(0, len(i), 65536)] or [np.zeros(0, bool)])
            i, j = i[sure], j[sure]
            np.add.at(counts, i, self.weight[j])
            np.add.at(self.links, j, weight[i])
            starts = np.flatnonzero(np.r_[True, i[1:] != i[:-1]]) if len(i) else []
            for a, b in zip(starts, [*starts[1:], len(i)]):
                self._join(int(nodes[i[a]]), j[a:b], edges)
        return nodes, counts, edges

    def _exact(self, raw: np.ndarray, norm: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        return np.einsum("ij,ij->i", raw[i], self.raw[j]) / (norm[i] * self.norm[j]) >= self.threshold

    def _join(self, node: int, j: np.ndarray, edges: list[tuple[int, int]]) -> None:
        labels, at = np.unique(self.label[j], return_index=True)
        edges += [(node, int(self.nodes[k])) for k in j[at]]
        if len(labels) > 1:
            self.label[np.isin(self.label, labels)] = labels[0]


def linked_vectors(table: DataFrame, threshold: float = THRESHOLD, tile_rows: int = TILE_ROWS, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of the table."""
    rows = stage(usable_vectors(table), "vectors")
    # A class is named by its first hash.
    classes = stage(rows.groupBy("k1", "k2").agg(F.count("*").alias("rows"), F.first("v").alias("v")), "vector-classes")
    chosen = classes.orderBy("k1", "k2").limit(PIVOTS).select("v").collect()
    pivots = {d: _units(_scaled(np.array([r["v"] for r in chosen if len(r["v"]) == d]), d)) for d in {len(r["v"]) for r in chosen}}
    names = {d: i for i, d in enumerate(sorted(pivots))}

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = pa.compute.list_value_length(batch.column("v")).to_numpy()
            for d in np.unique(length).tolist():
                some = batch.filter(pa.array(length == d))
                flat = some.column("v").flatten().to_numpy(zero_copy_only=False)
                angle, cell = np.zeros(len(flat) // d), np.full(len(flat) // d, -1)
                if d in pivots:
                    angles = np.arccos(np.clip(_units(_scaled(flat, d)) @ pivots[d].T, -1.0, 1.0))
                    cell = angles.argmin(axis=1)
                    angle = angles[np.arange(len(cell)), cell]
                v = pa.array([x.tobytes() for x in flat.reshape(-1, d)], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [some.column("k1"), some.column("rows"), v, pa.array(np.full(len(cell), d, np.int32)), pa.array(cell.astype(np.int32)), pa.array(angle)],
                    ["node", "rows", "v", "dim", "cell", "angle"],
                )

    placed = stage(classes.mapInArrow(place, "node long, rows long, v binary, dim int, cell int, angle double"), "vector-cells")
    cells = placed.groupBy("dim", "cell").agg(F.max("angle").alias("radius"), F.count("*").alias("n"))
    cells = stage(cells.withColumn("cuts", F.ceil(F.col("n") / tile_rows).cast("int")), "vector-radii")
    radius = {(r["dim"], r["cell"]): r["radius"] for r in cells.where("cell >= 0").collect()}  # at most PIVOTS rows
    slices = -(-placed.count() // slice_rows)
    reach = float(np.arccos(threshold)) + SLACK

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Cells at or after a vector's own that may hold a partner."""
        for batch in batches:
            out = []
            for d, cell, v in zip(batch.column("dim").to_pylist(), batch.column("cell").to_pylist(), batch.column("v")):
                if cell < 0:
                    out.append([-1])
                    continue
                angles = np.arccos(np.clip(pivots[d] @ _units(_scaled(np.frombuffer(v.as_buffer(), np.float64), d))[0], -1.0, 1.0))
                out.append([c for c in range(cell, len(angles)) if (d, c) in radius and (c == cell or angles[c] - radius[d, c] <= reach)])
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("node", "rows", "v", "dim", "cell")] + [pa.array(out, pa.list_(pa.int32()))], ["node", "rows", "v", "dim", "cell", "to"])

    sized = cells.select("dim", "cell", "cuts")
    tile = F.pmod(F.xxhash64("node"), F.col("cuts")).cast("int")
    owners = placed.join(sized, ["dim", "cell"]).withColumn("tile", tile).withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1)))) if slices else placed.limit(0).withColumns({"tile": F.lit(0), "slice": F.lit(0)})
    owners = owners.select("dim", "cell", "tile", "slice", F.lit(0).alias("role"), F.lit(False).alias("own"), "node", "rows", "v")
    guests = placed.mapInArrow(visit, "node long, rows long, v binary, dim int, home int, to array<int>").withColumn("cell", F.explode("to"))
    homes = sized.select(F.col("dim").alias("hd"), F.col("cell").alias("home"), F.col("cuts").alias("home_cuts"))
    guests = guests.join(sized, ["dim", "cell"]).join(homes, (F.col("dim") == F.col("hd")) & (guests["home"] == homes["home"])).drop(homes["home"])
    home_tile = F.pmod(F.xxhash64("node"), F.col("home_cuts")).cast("int")
    first = F.when(F.col("home") == F.col("cell"), home_tile).otherwise(F.lit(0))
    guests = guests.withColumn("tile", F.explode(F.sequence(first, F.col("cuts") - 1)))
    own = (F.col("home") == F.col("cell")) & (F.col("tile") == home_tile)
    guests = guests.select("dim", "cell", "tile", F.pmod(F.xxhash64(F.lit(5), "node"), F.lit(max(slices, 1))).cast("int").alias("slice"), F.lit(1).alias("role"), own.alias("own"), "node", "rows", "v")
    key = ["dim", "cell", "tile", "slice"]
    dealt = owners.unionByName(guests).repartition(*key).sortWithinPartitions(*key, "role")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, tile, held = None, None, []
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in (*key, "role")], axis=1)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
            for a, b in zip(cuts[:-1], cuts[1:]):
                if a == b:
                    continue
                name, guest = tuple(keys[a, :4].tolist()), keys[a, 4] == 1
                part = pa.Table.from_batches([batch.slice(a, b - a)])
                if name != current:
                    yield from _closed(tile)
                    current, tile, held = name, None, []
                if not guest:
                    held.append(part)
                    continue
                if tile is None:
                    tile = _Tile(pa.concat_tables(held), name[0], threshold)
                nodes, counts, edges = tile.meet(part)
                yield from _sent(nodes, counts, edges)
        yield from _closed(tile)

    facts = stage(dealt.mapInArrow(compare, "a long, b long, n long"), "vector-links")
    counts = facts.where("b IS NULL").groupBy(F.col("a").alias("k1")).agg(F.sum("n").alias("n"))
    reached = stage(components(facts.where("b IS NOT NULL").select("a", "b")), "vector-components")

    firsts = rows.groupBy("k1").agg(F.min("id").alias("id"), F.count("*").alias("copies"))
    known = firsts.join(counts, "k1", "left").join(reached, F.col("k1") == F.col("node"), "left")
    known = known.select("k1", "id", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "k1").alias("component"))
    known = stage(known, "vector-known")
    smallest = known.groupBy("component").agg(F.min("id").alias("component_id"))
    known = known.join(smallest, "component").select("k1", "n_links", "component_id")
    linked = rows.select("id", "k1").join(known, "k1").select("id", "n_links", "component_id")
    back = lambda c: F.when(F.col(c) != _LAST, F.col(c))
    every = table.select(F.coalesce(F.col("vec_id").cast("long"), F.lit(_LAST)).alias("id"), F.col("embedding").cast("array<double>").alias("v"))
    fine = F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))) & F.exists("v", lambda x: x != 0)
    alone = every.where(~F.coalesce(fine, F.lit(False))).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    out = linked.unionByName(alone).withColumn("kept", F.col("id") == F.col("component_id"))
    return out.select(back("id").alias("vec_id"), "n_links", back("component_id").alias("component_id"), "kept")


def _sent(nodes: np.ndarray, counts: np.ndarray, edges: list[tuple[int, int]]) -> Iterator[pa.RecordBatch]:
    """Counts have no b, edges no n."""
    some = counts > 0
    a = np.concatenate([nodes[some], np.array([e[0] for e in edges], np.int64)])
    b = np.array([e[1] for e in edges], np.int64)
    k = int(some.sum())
    if len(a):
        b = pa.concat_arrays([pa.nulls(k, pa.int64()), pa.array(b)])
        n = pa.concat_arrays([pa.array(counts[some]), pa.nulls(len(edges), pa.int64())])
        yield pa.RecordBatch.from_arrays([pa.array(a), b, n], ["a", "b", "n"])


def _closed(tile: _Tile | None) -> Iterator[pa.RecordBatch]:
    if tile is not None:
        yield from _sent(tile.nodes, tile.links, [])
