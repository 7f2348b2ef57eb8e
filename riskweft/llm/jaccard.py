"""Exact n-gram Jaccard join: size-banded tiles, hashed bitmap signatures, sorted-array intersection.

A document's set holds its distinct five-word shingles (64-bit hashes). Two
documents link when 100 * intersection >= 80 * union. The result is the class
of documents that links reach, so copies never turn into all their pairs.

1. Equal sets are folded; one document stands for each class.
2. In one global order of shingles, two linked sets share a shingle among the
   first n - ceil(0.8 n) + 1 of each. The order puts shingles that repeat last,
   by a fixed-size table of counts over all documents, so a passage in a third
   of all documents joins nothing. Any order is exact.
3. At every shared shingle, all documents are verified against one of them, and
   what is linked is one component from then on. The first leader is the most
   central document, whose rarest shingles repeat most: it has the fewest edits
   of its own, so it links with whatever can link in its group. A few rounds with
   other leaders follow, only for shingles that still join several components,
   and settle groups of near copies without making their pairs.
4. Documents of different components that share such a shingle meet in tiles of
   one shingle and one size band (a linked pair's sizes differ by a factor of
   1.25 at most). Each carries a parity bitmap with about one bit per shingle.
   Bits that differ are shingles that differ, so the bit count bounds the
   intersection from above. A large tile is cut into blocks that meet pairwise.
   Two documents of one band meet in its own tile, not in the next one's.
5. Pairs that pass are verified by intersecting the whole sorted sets.

Nulls and empty texts have an empty set and link with nothing. A null doc_id
stands last and comes back as null. Rows that share a doc_id are one document
where their texts are the same, and may be joined through the id where they are
not. An empty table gives an empty result; extra columns are ignored.
Memory: a task holds one batch of texts and one tile block; the driver holds the
fixed-size table of counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweft.llm.common import cell_filter, keep_others, passes, passing
from riskweft.llm.graph import components
from riskweft.llm.words import mix, pieces, shingle_sets, signed, text_bytes
from riskweft.session import release, stage

SHINGLE = 5
PERCENT = 80
#: Bits of a hash that name a cell of the table of counts.
LEVEL_BITS = 22
#: Shingles that a task sorts at once to see which repeat.
RUN = 1_500_000
#: Rounds of verifying the members of a shingle against one of them, each time another.
STAR_ROUNDS = 3
#: Documents of one tile that meet in one task; a larger tile is cut into blocks.
TILE_ROWS = 1024
#: A little over 1.25, so that rounding cannot put two linked sizes further apart than one band.
BAND = 1.26
_LAST = (1 << 63) - 1
#: Documents without an id are nodes by a hash of their text, above all ids up to this one.
_NO_ID = _LAST - (1 << 40)


def _node() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST) - F.pmod(F.xxhash64(F.col("text").cast("string")), F.lit(1 << 40)))


def _source(docs: DataFrame) -> DataFrame:
    return docs.select(_node().alias("doc"), F.col("text").cast("string").alias("text"))


def shingle_levels(docs: DataFrame) -> np.ndarray:
    """For each cell of shingle hashes, the logarithm of how often its shingles were seen to repeat.

    Tasks sort their shingles in runs of about RUN and report those that more
    than one document of a run has. The order that follows need not be right for
    every shingle, only the same everywhere.
    """

    def repeated(sets: list[np.ndarray]) -> pa.RecordBatch:
        found, n = np.unique(np.concatenate(sets) if sets else np.zeros(0, np.uint64), return_counts=True)
        cells, at = np.unique((found[n > 1] >> np.uint64(64 - LEVEL_BITS)).astype(np.int32), return_inverse=True)
        total = np.bincount(at.reshape(-1), weights=n[n > 1], minlength=len(cells)).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(cells, pa.int32()), pa.array(total)], ["cell", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in pieces(batches, "text"):
            for s in shingle_sets(text_bytes(batch.column("text")), SHINGLE):
                held.append(s)
                size += len(s)
            if size >= RUN:
                yield repeated(held)
                held, size = [], 0
        yield repeated(held)

    counted = _source(docs).select("text").mapInArrow(count, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    levels = np.zeros(1 << LEVEL_BITS, np.uint8)
    rows = counted.toArrow()  # at most one row for each cell
    levels[rows["cell"].to_numpy()] = np.log2(rows["n"].to_numpy())
    return levels


def signatures(docs: DataFrame, levels: np.ndarray, percent: int = PERCENT) -> DataFrame:
    """doc, n, h1, h2 (hashes of the set), prefix, centre, bits; documents with at least one shingle.

    centre: how much the shingles of the prefix repeat, the mean of their levels in eighths.
    """
    u = np.uint64

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            ids, sizes, one, two, prefixes, centres, bits = [], [], [], [], [], [], []
            for doc, s in zip(batch.column("doc").to_pylist(), shingle_sets(text_bytes(batch.column("text")), SHINGLE)):
                n = len(s)
                if not n:
                    continue
                ids.append(doc)
                sizes.append(n)
                one.append(int(signed(np.add.reduce(mix(s ^ u(0x5555555555555555)), keepdims=True))[0]))
                two.append(int(signed(np.bitwise_xor.reduce(mix(s + u(0x1234567887654321)), keepdims=True))[0]))
                k = n - (percent * n + 99) // 100 + 1
                level = levels[(s >> u(64 - LEVEL_BITS)).astype(np.int64)]
                first = np.argsort(level, kind="stable")[:k]
                prefixes.append(signed(s[first]))
                centres.append(int(8 * level[first].sum(dtype=np.int64) // k))
                width = max(64, 1 << (n - 1).bit_length())
                odd = np.bincount((s & u(width - 1)).astype(np.int64), minlength=width) & 1
                bits.append(np.packbits(odd.astype(np.uint8), bitorder="little").tobytes())
            if ids:
                offsets = np.cumsum([0] + [len(p) for p in prefixes])
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(prefixes)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(sizes, pa.int32()), pa.array(one, pa.int64()), pa.array(two, pa.int64()), lists, pa.array(centres, pa.int16()), pa.array(bits, pa.binary())],
                    ["doc", "n", "h1", "h2", "prefix", "centre", "bits"],
                )

    return _source(docs).mapInArrow(sign, "doc long, n int, h1 long, h2 long, prefix array<long>, centre short, bits binary")


def _may_link(n: int, a: bytes, m: int, b: bytes, percent: int) -> bool:
    """Whether the bit counts leave an intersection large enough: bits that differ are at most the shingles that differ."""
    if len(a) < len(b):
        n, a, m, b = m, b, n, a
    x, y = int.from_bytes(a, "little"), int.from_bytes(b, "little")
    wide, narrow = len(a) * 8, len(b) * 8
    while wide > narrow:
        wide //= 2
        x = (x >> wide) ^ (x & ((1 << wide) - 1))
    most = (n + m - (x ^ y).bit_count()) // 2
    return 100 * most >= percent * (n + m - most)


def _sized(n: int, m: int, percent: int) -> bool:
    return 100 * min(n, m) >= percent * max(n, m)


def verified(pairs: DataFrame, signs: DataFrame, docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Of the pairs (a, b), those whose sets link. signs: doc, n, bits of every document that occurs."""
    left = signs.select(F.col("doc").alias("a"), F.col("n").alias("an"), F.col("bits").alias("abits"))
    right = signs.select(F.col("doc").alias("b"), F.col("n").alias("bn"), F.col("bits").alias("bbits"))

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [c.to_pylist() for c in (batch.column(x) for x in ("an", "abits", "bn", "bbits"))]
            keep = pa.array([_sized(n, m, percent) and _may_link(n, a, m, b, percent) for n, a, m, b in zip(*rows)], pa.bool_())
            yield batch.select(["a", "b"]).filter(keep)

    near = stage(pairs.join(left, "a").join(right, "b").select("a", "b", "an", "abits", "bn", "bbits").mapInArrow(bound, "a long, b long"), "jaccard-pairs")

    wanted = near.select(F.col("a").alias("doc")).unionByName(near.select(F.col("b").alias("doc"))).distinct()
    cells = cell_filter(wanted.select(F.xxhash64("doc")))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(iter([passing(batch, cells, "hash")]), "text"):
                sets = [s.tobytes() for s in shingle_sets(text_bytes(part.column("text")), SHINGLE)]
                yield pa.RecordBatch.from_arrays([part.column("doc"), pa.array(sets, pa.binary())], ["doc", "items"])

    # Only the sets of documents in pairs are made and moved.
    found = _source(docs).withColumn("hash", F.xxhash64("doc")).mapInArrow(gather, "doc long, items binary").where("length(items) > 0")
    sets = stage(found.join(wanted, "doc", "left_semi"), "jaccard-sets")
    # Rows that share a doc_id may differ in text: the pair links if any of their sets do.
    both = near.join(sets.select(F.col("doc").alias("a"), F.col("items").alias("aitems")), "a").join(sets.select(F.col("doc").alias("b"), F.col("items").alias("bitems")), "b")

    def intersect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("aitems"), batch.column("bitems")):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    links = stage(both.select("a", "b", "aitems", "bitems").mapInArrow(intersect, "a long, b long").distinct(), "jaccard-links")
    release(near)
    release(sets)
    return links


def tile_pairs(members: DataFrame, signs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """members: key, doc, n, component; signs: doc, bits -> distinct pairs (a, b) of different components that sizes and bit counts allow."""
    band = F.floor(F.log(F.col("n")) / F.lit(float(np.log(BAND)))).cast("int")
    tile = F.inline(F.array(*[F.struct((band + i).alias("band"), F.lit(bool(i)).alias("guest")) for i in (0, 1)]))
    tiled = members.select("key", "doc", "n", "component", tile)
    parts = tiled.groupBy("key", "band").agg(F.count("*").alias("rows"), F.min("component").alias("low"), F.max("component").alias("high"), F.every("guest").alias("guests"))
    parts = parts.where("low <> high AND NOT guests").select("key", "band", F.ceil(F.col("rows") / TILE_ROWS).cast("int").alias("cuts"))
    tiled = tiled.join(parts, ["key", "band"]).join(signs.select("doc", "bits"), "doc").withColumn("cut", F.pmod(F.xxhash64("doc"), F.col("cuts")).cast("int"))
    tiled = tiled.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
    block = F.struct("key", "band", F.least("cut", "other").alias("i"), F.greatest("cut", "other").alias("j"))
    tiled = tiled.select(F.xxhash64(block).alias("block"), block.alias("full"), "doc", "n", "guest", "component", "bits")
    # Blocks of one partition stand together; a block is never split between tasks.
    dealt = tiled.repartition("block", "full").sortWithinPartitions("block", "full")
    dealt = dealt.select(F.xxhash64(F.lit(3), "full").alias("check"), "block", "doc", "n", "guest", "component", "bits")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            now = pa.Table.from_batches([batch])
            held = now if held is None else pa.concat_tables([held, now])
            keys = np.stack([held.column(x).to_numpy() for x in ("block", "check")])
            changes = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0))
            if len(changes):
                cut = int(changes[-1]) + 1
                yield from _block_pairs(held.slice(0, cut), percent)
                held = held.slice(cut)
        if held is not None:
            yield from _block_pairs(held, percent)

    return dealt.mapInArrow(meet, "a long, b long").distinct()


def _block_pairs(rows: pa.Table, percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs of neighbours at distance 1, 2, ... inside the blocks, for all blocks at once."""
    block, check, doc, n, guest, component = (rows.column(x).to_numpy() for x in ("block", "check", "doc", "n", "guest", "component"))
    bits = rows.column("bits").to_pylist()
    at = np.arange(len(block))
    found: list[tuple[int, int]] = []
    step = 0
    while True:
        step += 1
        at = at[at + step < len(block)]
        at = at[(block[at] == block[at + step]) & (check[at] == check[at + step])]
        if not len(at):
            break
        to = at + step
        low, high = np.minimum(n[at], n[to]).astype(np.int64), np.maximum(n[at], n[to])
        open_pairs = (component[at] != component[to]) & ~(guest[at] & guest[to]) & (100 * low >= percent * high)
        for i, j in zip(at[open_pairs].tolist(), to[open_pairs].tolist()):
            if _may_link(int(n[i]), bits[i], int(n[j]), bits[j], percent):
                found.append((min(doc[i], doc[j]), max(doc[i], doc[j])))
        if len(found) > 100_000:
            yield _pairs(found)
            found = []
    if found:
        yield _pairs(found)


def _pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
    pairs = np.unique(np.array(found, np.int64), axis=0)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])


def _stars(rows: DataFrame) -> DataFrame:
    """rows: key, doc, component, leader, led (the leader's component) -> distinct pairs of a key's leader with its members of other components."""
    return rows.where("component <> led").select(F.least("leader", "doc").alias("a"), F.greatest("leader", "doc").alias("b")).distinct()


def _shared_members(firsts: DataFrame, shared: DataFrame) -> DataFrame:
    """key, doc, n, centre for the prefix shingles that more than one document has; a filter keeps the others out of the join."""
    cells = cell_filter(shared.select("key"))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("prefix")
            keys = lists.flatten().to_numpy()
            many = np.diff(lists.offsets.to_numpy())
            keep = passes(cells, keys)
            columns = [pa.array(np.repeat(batch.column(c).to_numpy(), many)[keep]) for c in ("doc", "n", "centre")]
            yield pa.RecordBatch.from_arrays([pa.array(keys[keep]), *columns], ["key", "doc", "n", "centre"])

    spread_out = firsts.select("doc", "n", "centre", "prefix").mapInArrow(spread, "key long, doc long, n int, centre short")
    return spread_out.join(shared, "key", "left_semi").distinct()


def linked_documents(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of docs."""
    back = lambda c: F.when(F.col(c) <= _NO_ID, F.col(c))
    return linked_nodes(docs, percent).select(back("doc").alias("doc_id"), F.col("n").cast("long").alias("n_shingles"), back("component").alias("component_id"))


def linked_nodes(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc, n, component for every row of docs, by node."""
    signs = stage(signatures(docs, shingle_levels(docs), percent), "jaccard-signs")
    classes = stage(signs.groupBy("h1", "h2", "n").agg(F.min("doc").alias("doc"), F.max("doc").alias("last")), "jaccard-classes")
    # One document for each class: the others of a class go.
    several = classes.where("doc <> last").select("h1", "h2", F.col("doc").alias("first"))
    copies = stage(signs.select("doc", "h1", "h2").join(several, ["h1", "h2"]).where("doc <> first").select("doc", "h1").distinct(), "jaccard-copies")
    firsts = signs.join(copies, ["doc", "h1"], "left_anti")
    slim = stage(firsts.select("doc", "n", "bits").dropDuplicates(), "jaccard-bits")
    shared = firsts.select(F.explode("prefix").alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("rows"))
    shared = stage(shared.where("rows > 1").select("key"), "jaccard-keys")
    members = stage(_shared_members(firsts, shared), "jaccard-members")
    for done in (copies, shared):
        release(done)
    links = found = None
    for round_ in range(STAR_ROUNDS + 1):
        named = members.withColumn("component", F.col("doc"))
        if found is not None:
            named = members.join(found, F.col("doc") == found["node"], "left").withColumn("component", F.coalesce("component", "doc")).drop("node")
            named = stage(named, "jaccard-named")
        # The most central document first, then others by chance.
        rank = F.struct(F.col("centre") if round_ == 0 else F.lit(0), F.xxhash64(F.lit(round_), "doc"))
        leader = F.max_by(F.struct(F.col("doc").alias("leader"), F.col("component").alias("led")), rank).alias("x")
        mixed = named.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"), leader).where("low <> high").select("key", "x.*")
        # A shingle whose documents are one component stays so: later rounds see the others only.
        mixed = stage(named.join(mixed, "key"), "jaccard-open")
        pairs = _stars(mixed) if round_ < STAR_ROUNDS else tile_pairs(mixed, slim, percent)
        more = verified(pairs, slim, docs, percent)
        if found is not None:
            for done in (named, found):
                release(done)
        release(members)
        members = mixed.drop("component", "leader", "led")
        members.staged_path = mixed.staged_path
        links = more if links is None else links.unionByName(more)
        found = stage(components(links), "jaccard-components")
    release(members)

    first = F.coalesce("component", "first")
    classed = classes.drop("last").withColumnRenamed("doc", "first").join(found, F.col("first") == found["node"], "left").select("h1", "h2", "n", first.alias("component"))
    named = signs.select("doc", "n", "h1", "h2").join(classed, ["h1", "h2", "n"]).select("doc", "n", "component")
    empty = _source(docs).where(~F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")).select("doc", F.lit(0).alias("n"), F.col("doc").alias("component"))
    return named.unionByName(empty)


def one_of_each(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """docs without those that reach a document with a smaller node; of repeated rows one stays. Empty texts all stay."""
    found = stage(linked_nodes(docs, percent), "jaccard-found")
    hashed = F.xxhash64("doc").alias("tie")
    kept = keep_others(docs, found.where("doc <> component").select("doc", hashed), _node(), F.xxhash64(_node()))
    again = found.where("doc = component AND n > 0").groupBy("doc").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    again = stage(again.select("doc", hashed), "jaccard-again")
    if again.isEmpty():
        return kept
    # Rows that share a node: of those with one text, one stays.
    single = keep_others(kept, again, _node(), F.xxhash64(_node()))
    node = _node()
    repeated = kept.join(again.select("doc"), node == F.col("doc"), "left_semi").dropDuplicates(["doc_id", "text"])
    return single.unionByName(repeated)
