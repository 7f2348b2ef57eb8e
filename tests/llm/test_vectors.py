import math
import random

import numpy as np
from plain import components

from riskweft.llm import vectors

SCHEMA = "vec_id long, embedding array<float>, label int, rows long"


def corpus():
    r = np.random.default_rng(2)
    rows = []
    for i in range(300):
        if i < 40 or r.random() < 0.4:
            v = r.normal(size=16)
        else:
            v = np.array(rows[int(r.integers(len(rows)))][1]) + r.normal(size=16) * r.choice([0, 0.1, 0.35, 0.5])
        rows.append((i, [float(np.float32(x)) for x in v * 10.0 ** r.integers(-20, 18)], 0, 1))
    rows += [(400, None, 0, 1), (401, [0.0] * 16, 0, 1), (402, [math.nan] + [1.0] * 15, 0, 1), (403, [math.inf] + [1.0] * 15, 0, 1), (404, [], 0, 1)]
    rows += [(405, [None] + [1.0] * 15, 0, 1), (406, [1.0, 2.0], 0, 1), (407, [2.0, 4.0], 0, 1), (408, [1.0, -2.0], 0, 1)]
    return rows


def expected(rows):
    def fine(v):
        return v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    good = [(i, np.array(v, dtype=float)) for i, v, *_ in rows if fine(v)]
    good = [(i, v / np.abs(v).max()) for i, v in good]
    links = []
    for a in range(len(good)):
        for b in range(a):
            x, y = good[a][1], good[b][1]
            if len(x) == len(y) and x @ y / math.sqrt((x @ x) * (y @ y)) >= 0.9:
                links.append((good[a][0], good[b][0]))
    label = components([r[0] for r in rows], links)
    return {i: (sum(i in e for e in links), label[i], label[i] == i) for i, *_ in rows}


def found(df):
    return {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in df.collect()}


def test_against_plain_version(spark):
    rows = corpus()
    random.Random(1).shuffle(rows)
    want = expected(rows)
    table = spark.createDataFrame(rows, SCHEMA)
    assert found(vectors.linked_vectors(table)) == want
    assert found(vectors.linked_vectors(table, tile_rows=20, slice_rows=50)) == want
    assert sum(not k for _, _, k in want.values()) > 40


def test_repeated_rows_and_null_id(spark):
    rows = [(1, [1.0, 0.0], 0, 1), (1, [1.0, 0.0], 0, 1), (None, [2.0, 0.0], 0, 1), (3, [0.0, -0.0], 0, 1), (4, [0.0, 1.0], 0, 1), (5, [-0.0, 1.0], 0, 1)]
    got = sorted(((str(r["vec_id"]), r["n_links"], str(r["component_id"])) for r in vectors.linked_vectors(spark.createDataFrame(rows, SCHEMA)).collect()))
    assert got == [("1", 2, "1"), ("1", 2, "1"), ("3", 0, "3"), ("4", 1, "4"), ("5", 1, "4"), ("None", 2, "1")]


def test_bound_holds():
    r = np.random.default_rng(0)
    x, y = (vectors._units(r.normal(size=(200, 48)) * r.exponential(size=48)) for _ in range(2))
    (q, nq, eq), (p, np_, ep) = (vectors._codes(z, np.abs(z).max(axis=1, keepdims=True) / 127.0) for z in (x, y))
    scale = np.abs(x).max(axis=1)[:, None] * np.abs(y).max(axis=1)[None, :] / 127.0**2
    error = nq[:, None] * ep + eq[:, None] * np_ + eq[:, None] * ep
    assert (np.abs(vectors._product(q, p) * scale - x @ y.T) <= error + 1e-12).all()


def test_empty(spark):
    assert vectors.linked_vectors(spark.createDataFrame([], SCHEMA)).count() == 0
    assert found(vectors.linked_vectors(spark.createDataFrame([(2, None, 0, 1)], SCHEMA))) == {2: (0, 2, True)}
