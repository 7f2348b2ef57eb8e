import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweft.llm import codes

SCHEMA = "vec_id long, embedding array<double>, label int, entry int, error string, x int, key int, n int"


def plain(rows, parts=4, entries=256, rounds=4, scale=1024):
    """Full scans in Python integers: {vec_id: (code, error, label_error)} and the digest."""
    fine = [(i, v, label) for i, v, label in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    sizes = [len(v) for _, v, _ in fine]
    if not fine:
        return {}, None
    dims = min(set(sizes), key=lambda n: (-sizes.count(n), n))
    clamp = lambda c: max(-codes.LIMIT, min(codes.LIMIT, c))
    kept = sorted((math.inf if i is None else i, [math.floor(clamp(scale * c)) for c in v], label) for i, v, label in fine if len(v) == dims)
    cut = [(dims * p // parts, dims * (p + 1) // parts) for p in range(parts)]
    pieces = [[x[a:b] for a, b in cut] for _, x, _ in kept]
    books = [[pieces[j][p] for j in range(min(entries, len(kept)))] for p in range(parts)]

    def assign():
        return [[min((sum((s - t) ** 2 for s, t in zip(part, e)), k) for k, e in enumerate(books[p])) for p, part in enumerate(row)] for row in pieces]

    for _ in range(rounds):
        found = assign()
        for p in range(parts):
            for k in range(len(books[p])):
                own = [row[p] for row, f in zip(pieces, found) if f[p][1] == k]
                if own:
                    books[p][k] = [sum(c) // len(own) for c in zip(*own)]
    found = assign()
    errors = [sum(d for d, _ in f) for f in found]
    by_label = {}
    for (_, _, label), e in zip(kept, errors):
        by_label[label] = by_label.get(label, 0) + e
    digest = hashlib.sha256(",".join(str(c) for book in books for e in book for c in e).encode()).hexdigest()
    return sorted((str(i), "".join(f"{k:02x}" for _, k in f), e, by_label[label]) for (i, _, label), f, e in zip(kept, found, errors)), digest


def run(spark, rows, **settings):
    table = spark.createDataFrame([(i, v, label, 0, "e", 1, 2, 3) for i, v, label in rows], SCHEMA)
    coded, books = codes.compress(table, **settings)
    done = codes.label_errors(coded).select("vec_id", codes.code_text(F.col("entry")).alias("code"), "error", "label_error").collect()
    return sorted((str(math.inf if r["vec_id"] is None else r["vec_id"]), r["code"], r["error"], r["label_error"]) for r in done), books


def corpus(n, dims, seed=3):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(12, dims)) * 0.2
    return [(i, (centres[int(r.integers(12))] + r.normal(size=dims) * r.choice([0, 0.01, 0.2])).tolist(), None if i % 7 == 0 else int(r.integers(3))) for i in range(n)]


@pytest.mark.parametrize("entries, rounds", [(256, 4), (16, 4), (3, 6)])
def test_against_full_scans(spark, entries, rounds):
    rows = corpus(300, 16)
    random.Random(1).shuffle(rows)
    want, digest = plain(rows, entries=entries, rounds=rounds)
    got, books = run(spark, rows, entries=entries, rounds=rounds)
    assert got == want and books.sha256() == digest


def test_dropped_rows_ties_copies_and_odd_lengths(spark):
    rows = corpus(40, 10) + [(100, None, 1), (101, [None] * 10, 1), (102, [math.nan] + [0.0] * 9, 1), (103, [math.inf] * 10, 1), (104, [1.0, 2.0], 1), (105, [], 1)]
    rows += [(3, [0.5] * 10, 0)] * 3 + [(None, [0.25] * 10, 0), (None, [-1e30] + [1e30] * 9, None), (200, [-0.00001] * 10, 5)]
    want, digest = plain(rows, entries=8)
    got, books = run(spark, rows, entries=8)
    assert got == want and books.sha256() == digest and len(got) == 40 + 6


def test_empty_and_few(spark):
    assert run(spark, []) == ([], codes.Codebooks((), ()))
    assert run(spark, [(1, None, 0)])[0] == []
    assert run(spark, [(5, [0.0, 0.0, 0.0, 0.0], None)])[0] == [("5", "00000000", 0, 0)]


def test_active_entries_equal_a_full_scan():
    r = np.random.default_rng(5)
    for _ in range(200):
        x, book = r.integers(-3, 4, size=(60, 3)), r.integers(-3, 4, size=(9, 3))
        entry, distance = codes.assign_all(x, book)
        moved = r.random(9) < r.choice([0.0, 0.2, 0.6, 1.0])
        new = book.copy()
        new[moved] += r.integers(-1, 2, size=(int(moved.sum()), 3))
        want, got = codes.assign_all(x, new), codes.assign_active(x, new, moved, entry, distance)
        assert (want[0] == got[0]).all() and (want[1] == got[1]).all()


def test_fixed_parts_meet_moved_entries_only(monkeypatch):
    r = np.random.default_rng(6)
    x, book = r.integers(-50, 50, size=(500, 4)), r.integers(-50, 50, size=(32, 4))
    entry, distance = codes.assign_all(x, book)
    moved = np.zeros(32, bool)
    moved[3] = True
    compared = []
    real = codes.squared_distances
    monkeypatch.setattr(codes, "squared_distances", lambda a, b: compared.append(len(a) * len(b)) or real(a, b))
    codes.assign_active(x, book, moved, entry, distance)
    lost = int((entry == 3).sum())
    assert sum(compared) == lost * 32 + (500 - lost) * 1


def test_large_components_are_exact():
    x, book = np.array([[codes.LIMIT, -codes.LIMIT, 5]]), np.array([[-codes.LIMIT, codes.LIMIT, 4], [-codes.LIMIT, codes.LIMIT, 6]])
    assert codes.squared_distances(x, book).tolist() == [[8 * codes.LIMIT**2 + 1] * 2]


def test_decode(spark):
    rows = corpus(50, 8)
    table = spark.createDataFrame([(i, v, label, 0, "e", 1, 2, 3) for i, v, label in rows], SCHEMA)
    coded, books = codes.compress(table)
    back = {r["vec_id"]: r["embedding"] for r in codes.decode(coded, books).collect()}
    # 50 vectors are all entries of their own, so what is lost is the rounding.
    assert max(abs(a - b) for i, v, _ in rows for a, b in zip(v, back[i])) <= 0.5 / codes.SCALE + 1e-12
