"""Personal data: patterns, and what the corpus itself shows to reveal them.

Base spans come from fixed patterns. The method then protects every value that
they found (an e-mail address, a card number, ...) as an entity c. A term t in
its neighbourhood discloses c by PMI(c, t) / IC(c), with

    PMI(c, t) = ln(N * n_ct / (n_c * n_t)),  IC(c) = ln(N / n_c)

over documents: 1 means that whoever reads t knows c. Terms at or above
GENERALISE are cut to their first letters, at or above REMOVE they go. n_ct
counts documents in which t stands within REACH words of c and must be at least
SUPPORT; n_t counts all documents of the corpus that hold t anywhere. With
`everywhere`, as the registered query asks, a term that discloses any entity is
marked at all its places in all documents by its highest disclosure; what stands
in a base span goes with it.

Terms are counted in a second scan that keeps only candidates (a fixed-size
table of cells says which hashes may be one), so what is shuffled follows the
personal data found, not the vocabulary. Hot entities and terms are counted
with partial aggregation and never gathered.

Nulls: a null text is empty. A null doc_id is a document like any other.
Repeated rows count each, and get the same spans. An empty table gives an empty
result. Extra columns are ignored. Patterns and neighbours take time in
proportion to the text and the values found in it.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweft.llm.common import cell_filter, keep_others, passes, passing
from riskweft.llm.words import _FOLD, _hash_piece, pieces, signed, text_bytes
from riskweft.session import stage

KINDS = ("email", "ip", "card", "phone")
REACH = 10
SUPPORT = 2
GENERALISE = 0.75
REMOVE = 0.95
KEPT_LETTERS = 2
#: Term counts that a task holds before it sends them on.
HELD = 2_000_000
_LAST = (1 << 63) - 1

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match can only begin where a run of digits begins: from inside it, the same end is reached.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TERM = re.compile("[0-9A-Za-z\x80-\U0010ffff]+")
_LETTER = re.compile(r"[^\W\d_]")
#: Bytes of a term; all others part terms.
_TERM_FOLD = bytes(_FOLD[b] if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def _emails(text: str) -> Iterator[tuple[int, int]]:
    end, at = 0, text.find("@")
    while at >= 0:
        first = at
        while first > end and text[first - 1] in _LOCAL:
            first -= 1
        domain = _DOMAIN.match(text, at + 1) if first < at else None
        if domain:
            end = domain.end()
            yield first, end
        at = text.find("@", max(at + 1, end))


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _digits(said: str) -> str:
    return "".join(c for c in said if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[str, int, int, str]]:
    """kind, start, end, value; by kind as in KINDS, then by start."""
    found = [("email", a, b, text[a:b].lower()) for a, b in _emails(text)]
    for m in _IP.finditer(text) if "." in text else ():
        parts = [p.lstrip("0") for p in m.group().split(".")]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            found.append(("ip", m.start(), m.end(), ".".join(p or "0" for p in parts)))
    for m in _CARD.finditer(text):
        digits = _digits(m.group()) if m.end() - m.start() >= 16 else ""
        if 16 <= len(digits) <= 19 and _luhn(digits):
            found.append(("card", m.start(), m.end(), digits))
    for m in _PHONE.finditer(text) if "+" in text else ():
        digits = _digits(m.group())
        if 8 <= len(digits) <= 15:
            found.append(("phone", m.start(), m.end(), digits))
    return found


def _neighbours(text: str, spans: list[tuple[str, int, int, str]]) -> tuple[list[int], list[str], list[int], list[int]]:
    """Entity hash, term, start, end for each term among the REACH words before and after an entity that has a letter and touches no base span."""
    entities, terms, starts, ends = [], [], [], []
    every = [(m.start(), m.end()) for m in _TERM.finditer(text)]
    if not every:
        return entities, terms, starts, ends
    first, last = np.array(every).T
    free = _outside(first, last, spans).tolist()
    first, last = first.tolist(), last.tolist()
    usable = [f and bool(_LETTER.search(text, a, b)) for f, a, b in zip(free, first, last)]
    for kind, a, b, value in spans:
        entity = int.from_bytes(hashlib.blake2b(f"{kind}:{value}".encode(), digest_size=8).digest(), "little", signed=True)
        before, after = bisect_right(last, a), bisect_left(first, b)
        for i in (*range(max(0, before - REACH), before), *range(after, min(len(every), after + REACH))):
            if usable[i]:
                entities.append(entity)
                terms.append(text[first[i] : last[i]])
                starts.append(first[i])
                ends.append(last[i])
    return entities, terms, starts, ends


def _new(entities: list[int], terms: list[int]) -> list[bool]:
    """Which pairs are the first of their kind."""
    seen: set[tuple[int, int]] = set()
    return [pair not in seen and not seen.add(pair) for pair in zip(entities, terms)]


def _term_hashes(terms: list[str]) -> np.ndarray:
    return _hash_piece(" ".join(terms).encode().translate(_FOLD))[1] if terms else np.zeros(0, np.uint64)


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tie"), F.col("text").cast("string").alias("text"))


def _key() -> Column:
    """doc_id, with a number for null."""
    return F.coalesce("doc_id", F.lit(_LAST))


def _found(docs: DataFrame) -> DataFrame:
    """Per row: doc, tie, base (spans as text), counts, and the terms near each entity."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            base, counts, near = [], [], []
            for text in batch.column("text").to_pylist():
                spans = base_spans(text or "")
                base.append(",".join(f"{k}:{a}:{b}" for k, a, b, _ in spans))
                counts.append([sum(s[0] == k for s in spans) for k in KINDS])
                entities, terms, starts, ends = _neighbours(text, spans) if spans else ([], [], [], [])
                hashes = signed(_term_hashes(terms)).tolist()
                near.append([{"entity": e, "term": t, "start": a, "end": b, "new": n} for e, t, a, b, n in zip(entities, hashes, starts, ends, _new(entities, hashes))])
            kind = pa.list_(pa.struct([("entity", pa.int64()), ("term", pa.int64()), ("start", pa.int32()), ("end", pa.int32()), ("new", pa.bool_())]))
            columns = [batch.column("doc_id"), batch.column("tie"), pa.array(base, pa.string()), *(pa.array([c[i] for c in counts], pa.int64()) for i in range(4)), pa.array(near, kind)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "tie", "base", *(f"n_{k}" for k in KINDS), "near"])

    schema = "doc_id long, tie long, base string, n_email long, n_ip long, n_card long, n_phone long, near array<struct<entity: long, term: long, start: int, end: int, new: boolean>>"
    return stage(_rows(docs).mapInArrow(scan, schema), "pii-base")


def _document_counts(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """term, n_t: documents of the corpus that hold the term. terms: a column `term` of hashes."""
    cells = cell_filter(terms.select("term"))

    def merged(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        found, at = np.unique(np.concatenate([f for f, _ in held]), return_inverse=True)
        return found, np.bincount(at.reshape(-1), weights=np.concatenate([n for _, n in held]), minlength=len(found)).astype(np.int64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in pieces(batches, "text"):
            texts = text_bytes(batch.column("text"))
            starts, hashes = _hash_piece(b" ".join(texts).translate(_TERM_FOLD))
            ends = np.cumsum([len(t) + 1 for t in texts])
            hit = np.flatnonzero(passes(cells, hashes))
            if not len(hit):
                continue
            row = np.searchsorted(ends, starts[hit], side="right")
            pairs = np.unique(np.stack([hashes[hit], row.astype(np.uint64)], axis=1), axis=0)
            held.append(np.unique(pairs[:, 0], return_counts=True))
            size += len(held[-1][0])
            if size > HELD:
                held = [merged(held)]
                size = len(held[0][0])
                if size > HELD // 2:
                    yield pa.RecordBatch.from_arrays([pa.array(signed(held[0][0])), pa.array(held[0][1])], ["term", "n"])
                    held, size = [], 0
        if held:
            found, n = merged(held)
            yield pa.RecordBatch.from_arrays([pa.array(signed(found)), pa.array(n)], ["term", "n"])

    return docs.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n_t"))


def disclosing(docs: DataFrame, found: DataFrame) -> DataFrame:
    """entity, term, disclosure: the pairs at or above GENERALISE."""
    total = found.count()
    near = found.where("size(near) > 0")
    pair = near.select(F.explode(F.filter("near", lambda x: x["new"])).alias("x")).select("x.entity", "x.term")
    pairs = pair.groupBy("entity", "term").agg(F.count("*").alias("n_ct")).where(F.col("n_ct") >= SUPPORT)
    each = lambda field: near.select(F.explode(F.array_distinct(F.transform("near", lambda x: x[field]))).alias(field)).groupBy(field)
    entities = each("entity").agg(F.count("*").alias("n_c")).where((F.col("n_c") >= SUPPORT) & (F.col("n_c") < total))
    n = F.lit(float(max(total, 1)))

    def shown(n_t: str) -> Column:
        return F.log(n * F.col("n_ct") / (F.col("n_c") * F.col(n_t))) / F.log(n / F.col("n_c"))

    # A term stands in at least as many documents as it stands in near entities: what falls short with those is out.
    least = each("term").agg(F.count("*").alias("n_near"))
    likely = stage(pairs.join(entities, "entity").join(least, "term").where(shown("n_near") >= GENERALISE).drop("n_near"), "pii-pairs")
    counted = likely.join(_document_counts(docs, likely.select("term")), "term")
    return counted.select("entity", "term", shown("n_t").alias("disclosure")).where(F.col("disclosure") >= GENERALISE)


def _outside(starts: np.ndarray, ends: np.ndarray, spans: list[tuple[str, int, int, str]]) -> np.ndarray:
    """Which places touch no span."""
    if not spans:
        return np.ones(len(starts), bool)
    taken = np.array(sorted((a, b) for _, a, b, _ in spans))
    furthest = np.concatenate(([0], np.maximum.accumulate(taken[:, 1])))
    return furthest[np.searchsorted(taken[:, 0], ends, side="left")] <= starts


def _places(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """doc_id, tie, term, start, end: every place outside base spans whose hash may be one of `terms`; an exact join must follow."""
    cells = cell_filter(terms)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            texts = text_bytes(batch.column("text"))
            folded = b" ".join(texts).translate(_TERM_FOLD) + b" "
            starts, hashes = _hash_piece(folded)
            hit = np.flatnonzero(passes(cells, hashes))
            if not len(hit):
                continue
            starts, hashes = starts[hit], hashes[hit]
            bounds = np.cumsum([0] + [len(t) + 1 for t in texts])
            row = np.searchsorted(bounds, starts, side="right") - 1
            ends = np.array([folded.find(b" ", at) for at in starts.tolist()])
            edges = np.flatnonzero(np.diff(row, prepend=-1)).tolist() + [len(row)]
            for first, last in zip(edges, edges[1:]):
                i = int(row[first])
                # Characters up to each byte: the spans are in characters.
                upto = np.cumsum((np.frombuffer(texts[i], np.uint8) & 0xC0) != 0x80, dtype=np.int32)
                a, b = upto[starts[first:last] - bounds[i]] - 1, upto[ends[first:last] - bounds[i] - 1]
                free = _outside(a, b, base_spans(texts[i].decode()))
                a, b, found = a[free], b[free], hashes[first:last][free]
                at = pa.array(np.full(len(a), i))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(at), batch.column("tie").take(at), pa.array(signed(found)), pa.array(a, pa.int32()), pa.array(b, pa.int32())],
                    ["doc_id", "tie", "term", "start", "end"],
                )

    return _rows(docs).mapInArrow(scan, "doc_id long, tie long, term long, start int, end int")


def find_spans(docs: DataFrame, everywhere: bool = False) -> DataFrame:
    """doc_id, tie, base, n_email, n_ip, n_card, n_phone, terms (sorted array of start, end, disclosure) for every row.

    everywhere: terms at all their places in all documents, else only beside the entity that they disclose.
    """
    found = _found(docs)
    shown = stage(disclosing(docs, found), "pii-terms")
    if everywhere:
        highest = stage(shown.groupBy("term").agg(F.max("disclosure").alias("disclosure")), "pii-highest")
        placed = _places(docs, highest.select("term")).join(highest, "term")
    else:
        rows = found.where("size(near) > 0").select("doc_id", "tie", F.explode("near").alias("x")).select("doc_id", "tie", "x.*")
        placed = rows.join(shown, ["entity", "term"])
    marked = placed.groupBy("doc_id", "tie", "start", "end").agg(F.max("disclosure").alias("disclosure"))
    spans = marked.groupBy("doc_id", "tie").agg(F.array_sort(F.collect_list(F.struct("start", "end", "disclosure"))).alias("terms"))
    spans = spans.select(F.col("doc_id").alias("__id"), F.col("tie").alias("__tie"), "terms")
    joined = found.drop("near").join(spans, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("tie") == F.col("__tie")), "left")
    return joined.drop("__id", "__tie").withColumn("terms", F.coalesce("terms", F.array().cast("array<struct<start:int,end:int,disclosure:double>>")))


def changed(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """doc_id, tie, text: base spans as <KIND>, disclosing terms cut to their first letters or removed, for rows that have spans.

    spans: what find_spans returns for docs. Only texts whose hash may be one of
    these rows' are moved.
    """
    marked = spans.where("base <> '' OR size(terms) > 0").dropDuplicates(["doc_id", "tie"]).select(F.col("doc_id").alias("__doc"), "tie", "base", "terms")
    cells = cell_filter(marked.select("tie"))

    def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield passing(batch, cells, "tie")

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            out = [_cleaned(*row) for row in zip(*(batch.column(c).to_pylist() for c in ("text", "base", "terms")))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("tie"), pa.array(out, pa.string())], ["doc_id", "tie", "text"])

    joined = _rows(docs).mapInArrow(some, "doc_id long, tie long, text string").join(marked, "tie").where(F.col("__doc").eqNullSafe(F.col("doc_id")))
    return joined.select("doc_id", "tie", "text", "base", "terms").mapInArrow(clean, "doc_id long, tie long, text string")


def sanitise(docs: DataFrame, everywhere: bool = False) -> DataFrame:
    """doc_id, text of every row, as in `changed` where it has spans. everywhere: as in find_spans."""
    spans = stage(find_spans(docs, everywhere), "pii-spans")
    same = keep_others(_rows(docs), spans.where("base <> '' OR size(terms) > 0").select(_key().alias("doc"), "tie"), _key(), F.col("tie"))
    return same.select("doc_id", "text").unionByName(changed(docs, spans).select("doc_id", "text"))


def _cleaned(text: str, base: str, terms: list[dict]) -> str:
    spans = []
    for said in base.split(",") if base else ():
        kind, a, b = said.split(":")
        spans.append((int(a), int(b), f"<{kind.upper()}>"))
    for t in terms:
        word = text[t["start"] : t["end"]]
        spans.append((t["start"], t["end"], "" if t["disclosure"] >= REMOVE else word[:KEPT_LETTERS] + "*"))
    out, at = [], 0
    for a, b, new in sorted(spans):
        if b <= at:
            continue
        out += [text[at : max(a, at)], new]  # base spans of two kinds may overlap: both go
        at = b
    return "".join(out) + text[at:]
