"""Language and toxicity: gradients, held-out accuracy, and the cases without data."""

import random
import zlib

import numpy as np
import pytest
from plain import documents

from riskweft.llm import language, toxicity

SYLLABLES = {"aa": ["the", "ing", "wh", "ou", "st"], "bb": ["sch", "ung", "über", "ei", "tz"], "cc": ["eau", "é", "oi", "ç", "vre"]}


def speech(r, lang, n):
    return " ".join("".join(r.choice(SYLLABLES[lang]) for _ in range(r.randrange(1, 4))) for _ in range(n))


def test_gradients_are_those_of_the_loss():
    net = language.Network(3, hidden=4, seed=1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    r = np.random.default_rng(0)
    grid, y = r.integers(97, 105, (5, 6)).astype(np.uint8), r.integers(0, 3, 6)
    _, g = net.gradients(grid, y)
    for name, at in (("w", (3, 1)), ("c", (2,)), ("uf", (1, 2)), ("ub", (2, 9)), ("uf", (0, 6)), ("xf", (int(grid[1, 0]), 3)), ("xb", (int(grid[4, 2]), 10))):
        kept, step = net.p[name][at], 1e-2
        net.p[name][at] = kept + step
        up = net.gradients(grid, y)[0]
        net.p[name][at] = kept - step
        down = net.gradients(grid, y)[0]
        net.p[name][at] = kept
        assert (up - down) / (2 * step) == pytest.approx(g[name][at], rel=0.05, abs=2e-4), name


def test_language_held_out(spark):
    r = random.Random(4)
    rows = [(i, speech(r, lang, r.randrange(2, 40)), lang) for i in range(150) for lang in [r.choice(list(SYLLABLES))]]
    rows += [(1000, None, "aa"), (1001, "12 34 !", "aa"), (1002, "", None), (1003, speech(r, "bb", 30), None), (None, speech(r, "cc", 30), None), (1004, "\n".join([speech(r, "aa", 5000)] * 2), "aa"), rows[3], (1005, "schüng" * 50, "bb")]
    found = language.identify(documents(spark, rows)).collect()
    assert len(found) == len(rows)
    said = {r[0]: r for r in rows}
    held = [r for r in found if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 1000]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in found if r["doc_id"] is not None)
    assert sum(r["lang_pred"] == said[r["doc_id"]][2] for r in held) >= 0.95 * len(held) > 30
    by = {r["doc_id"]: r for r in found}
    assert [by[i]["lang_pred"] for i in (1000, 1001, 1002, 1003, None, 1004, 1005)] == ["und", "und", "und", "bb", "cc", "aa", "bb"]
    assert all(0 <= r["score"] <= 1 for r in found)


def test_language_of_equal_runs_is_remembered_right():
    net = language.Network(2, seed=3)
    one = language.Labeller(net, 2)
    texts = [b"abc def abc", b"abc", "é ü".encode(), b"", b"def " * 300, b"x" * 500]
    first, again = one.documents(texts), one.documents(texts)
    assert np.allclose(first, again) and np.allclose(first[:, :].sum(axis=1)[[0, 1, 2, 4, 5]], 1, atol=1e-5)
    data = np.frombuffer(b" abc ", np.uint8)
    want = net.labels(language._framed(data, np.array([1]), 3))[0][1:-1].sum(axis=0)[0] / 3
    assert np.allclose(first[1], want, atol=1e-6)


def test_language_without_labels(spark):
    found = language.identify(documents(spark, [(1, "some text", None), (2, None, None)])).collect()
    assert [(r["lang_pred"], r["score"]) for r in found] == [("und", 0.0)] * 2
    assert language.identify(documents(spark, [])).count() == 0
    assert language.keep_known(documents(spark, [(1, "text", None)])).columns == documents(spark, []).columns


def toxic_corpus(n=400):
    r = random.Random(8)
    rows, labels = [], []
    for i in range(n):
        bad = r.random() < 0.3
        words = speech(r, r.choice(list(SYLLABLES)), r.randrange(15, 60)).split()
        if bad:
            for _ in range(1 + len(words) // 15):
                words.insert(r.randrange(len(words)), r.choice(["scumbag", "worthless", "moron", "idiotic"]))
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(bad)))
    return rows, labels


LABELS = "doc_id long, quality int, toxic int"


def test_toxicity_held_out_and_misspellings(spark):
    rows, labels = toxic_corpus()
    rows += [(1000, None), (1001, ""), (1002, "the worthles idiotik thing whou thest " * 3), (1003, "the stou thing whou thest " * 3), (None, "x")]
    labels += [(1000, 1, None), (5000, 1, 1), (None, 0, 1)]
    found = {r["doc_id"]: r for r in toxicity.judge(documents(spark, rows), spark.createDataFrame(labels, LABELS)).collect()}
    assert len(found) == len(rows)
    held = [(found[i]["predicted"], y) for i, _, y in labels if i in found and i is not None and i < 1000 and found[i]["held_out"]]
    assert sum(p == y for p, y in held) >= 0.93 * len(held) > 60
    assert all(r["predicted"] == int(r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in found.values())
    assert found[1002]["predicted"] == 1 and found[1003]["predicted"] == 0 and found[1000]["score"] == found[1001]["score"]


def test_toxicity_without_labels(spark):
    docs = documents(spark, [(1, "a"), (2, None)])
    assert [r["predicted"] for r in toxicity.judge(docs, spark.createDataFrame([], LABELS)).collect()] == [0, 0]
    assert [r["predicted"] for r in toxicity.judge(docs, spark.createDataFrame([(1, 1, 1)], LABELS)).collect()] in ([1, 1], [0, 0])
    assert toxicity.judge(documents(spark, []), spark.createDataFrame([(1, 1, 1)], LABELS)).count() == 0


def test_subword_cells():
    cells, first, many, text = toxicity.cells_of([b"ab. CDE", b"", b"ab"])
    assert text.tolist() == [0, 0, 2] and many.tolist() == [1 + 2 + 1, 1 + 3 + 2 + 1, 4]
    assert cells[first[0] : first[0] + 4].tolist() == cells[first[2] :].tolist()
