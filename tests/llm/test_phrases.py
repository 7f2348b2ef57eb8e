import random
import re
from collections import Counter
from fractions import Fraction
from math import floor

import numpy as np
import pandas as pd
import pytest
from plain import ascii_lower, documents

from riskweft.llm import phrases
from riskweft.session import stage


def plain_counts(rows, threshold, longest):
    """{lang: (n, {words: f})} of the phrases at the threshold."""
    out = {}
    for _, text, lang, *_ in rows:
        n, f = out.setdefault(lang if lang is not None else "und", [0, Counter()])
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", ascii_lower(text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            out[lang if lang is not None else "und"][0] += len(words)
            for k in range(1, longest + 1):
                f.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    return {lang: (n, {g: c for g, c in f.items() if c >= threshold}) for lang, (n, f) in out.items()}


def plain_best(counts, per_language):
    rows = []
    for lang, (n, f) in counts.items():
        found = []
        for g, a in f.items():
            if len(g) < 2 or any(len(q) > len(g) and 100 * c >= 100 * a and any(q[i : i + len(g)] == g for i in range(len(q) - len(g) + 1)) for q, c in f.items()):
                continue
            score, k = min((floor(Fraction(1000 * a * n, f[g[:k]] * f[g[k:]])), k) for k in range(1, len(g)))
            found.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:per_language], 1):
            rows.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(rows)


def corpus(seed=4, n=160):
    r = random.Random(seed)
    vocabulary = ["in", "Spite", "of", "the", "é", "new", "york\t", "a\x00b", "x\u00a0y", "ß", "Ünder"] + [f"w{i}" for i in range(30)]
    fixed = ["in spite of the rain", "New York City", "as far as I know", "la la la la la la"]
    rows = []
    for i in range(n):
        parts = [r.choice(fixed) if r.random() < 0.3 else " ".join(r.choices(vocabulary, weights=[1 / (j + 1) for j in range(len(vocabulary))], k=r.randint(0, 9))) for _ in range(r.randint(0, 12))]
        text = "".join(p + r.choice([". ", ",", "\n", "\r\n", "; ", " ", "!?", "\t\t"]) for p in parts)
        rows.append((i, text, r.choice(["en", "en", "fr", None, "und"]), "a"))
    return rows + [(900, None, "en", None), (901, "", None, "a"), (902, " . ", "de", "a"), (None, "New York City", "en", "b")] + [(7, "copy of a copy, copy of a copy", "en", "a")] * 30


def table(spark, rows):
    return documents(spark, rows).withColumnRenamed("first", "phrase")


@pytest.mark.parametrize("shards, longest", [(3, 4), (1, 2)])
def test_against_plain_counts(spark, shards, longest):
    rows = corpus()
    want = plain_counts(rows, 12, longest)
    got = {}
    for r in phrases.frequent_phrases(table(spark, rows), 12, longest, shards).collect():
        got.setdefault(r["lang"], {})[tuple(r["phrase"].split(" ")) if r["phrase"] else ()] = r["n"]
    for lang, (n, f) in want.items():
        assert {g: c for g, c in got.get(lang, {}).items() if g} == f, lang
        if f:
            assert got[lang][()] == n


def test_collocations_against_plain_version(spark):
    rows = corpus()
    frequent = stage(phrases.frequent_phrases(table(spark, rows), 8))
    for most in (2000, 5):
        got = sorted(tuple(r) for r in phrases.collocations(frequent, most).collect())
        assert got == plain_best(plain_counts(rows, 8, 5), most)


@pytest.mark.parametrize("cell_bits", [2])
def test_full_cells_change_nothing(spark, cell_bits):
    rows = corpus(5, 60)
    got = {}
    for r in phrases.frequent_phrases(table(spark, rows), 6, 3, 2, cell_bits).where("phrase <> ''").collect():
        got.setdefault(r["lang"], {})[tuple(r["phrase"].split(" "))] = r["n"]
    assert got == {lang: f for lang, (_, f) in plain_counts(rows, 6, 3).items() if f}


def test_every_phrase_is_counted_for_one_cycle():
    starts = []
    for step in range(5):
        # Few cells with unlike steps: phrases meet cells that others have set.
        cells = np.array([1, 2, 1, 3], np.uint8)
        for words, places in phrases._blocks([b"a b c a b c. a b"]):
            for batch in phrases._counted(7, phrases._word_hashes("en", words), places, cells, step, 2, 4):
                starts += [(step, (r["h1"], r["h2"]), r["start"], r["n"]) for r in batch.to_pylist()]
    for phrase in {p for _, p, _, _ in starts}:
        own = [(s, start, n) for s, p, start, n in starts if p == phrase]
        assert len({n for _, _, n in own}) == 1 and [s for s, _, _ in own] == [own[0][1], own[0][1] + 1], phrase


def test_lengths_are_interleaved(spark, monkeypatch):
    rows = [(i, "new york city. " * 20 + " ".join(f"u{i}x{j}" for j in range(20)), "en", "a") for i in range(60)]
    steps = []
    real = phrases._scan
    monkeypatch.setattr(phrases, "_scan", lambda cells, step, shards, longest: steps.append(int((cells != phrases.NEVER).sum())) or real(cells, step, shards, longest))
    found = {r["phrase"]: r["n"] for r in phrases.frequent_phrases(table(spark, rows), 100, 5, 4).collect()}
    # Words reach the threshold in the first scan, pairs in the second, the triple in the third: 2 + 4 steps, not 3 cycles of 4.
    assert found["new york city"] == 1200 and steps[:4] == [0, 3, 5, 6] and len(steps) == 7


def test_last_scan_makes_rows_of_frequent_phrases_only(spark, monkeypatch):
    # So many phrases that a filter of hashes lets some pass by chance.
    r = random.Random(8)
    rows = [(i, " ".join(f"w{r.randrange(2000)}" for _ in range(200)), "en", "a") for i in range(300)]
    staged = {}

    def keep(df, label, *more):
        staged[label] = stage(df, label, *more)
        return staged[label]

    monkeypatch.setattr(phrases, "stage", keep)
    got = {tuple(r["phrase"].split(" ")): r["n"] for r in phrases.frequent_phrases(table(spark, rows), 2).collect() if r["phrase"]}
    f = plain_counts(rows, 2, 5)["en"][1]
    assert got == f and staged["phrases-said"].where("phrase <> ''").count() == len(f)


def test_a_phrase_is_read_by_its_whole_hash():
    (words, places), cells = next(phrases._blocks([b"a b c. a b"])), np.zeros(4, np.uint8)
    known = phrases._word_hashes("en", words)
    h1, h2 = (int(h[0]) for h in phrases._phrase_hashes(known, [np.array([words.index(w)]) for w in (b"a", b"b")]).view(np.int64))
    wanted = pd.DataFrame({"h1": [h1, h1, 5], "h2": [h2 ^ 1, h2, 5], "n": [3, 4, 5]})
    said = [row for batch in phrases._said("en", b"\n".join(words[1:]), places, cells, wanted, 3) for row in batch.to_pylist()]
    assert said == [{"lang": "en", "phrase": "a b", "n": 4}]


def test_blocks_end_between_pieces(monkeypatch):
    monkeypatch.setattr(phrases, "BLOCK", 7)
    monkeypatch.setattr(phrases, "SLICE", 11)
    texts = ["One two three, four five six seven eight nine ten. x y", "", "no separator in all of this very long piece of text", "\n\n", "end"]
    pieces = []
    for words, places in phrases._blocks([t.encode() for t in texts]):
        assert places[-1] == 0
        said = [words[i] for i in places.tolist()]
        pieces += [p.split() for p in b" ".join(said).split(b"\n")]
    want = [p.split() for t in texts for p in re.split(r"[.,;:!?\n]", ascii_lower(t))]
    assert [p for p in pieces if p] == [[w.encode() for w in p] for p in want if p]


def test_scores_beyond_64_bits(spark):
    df = spark.createDataFrame([(3 * 10**12, 9 * 10**13, 3 * 10**12 + 1, 3 * 10**12 + 7)], "a long, n long, l long, r long")
    a, n, left, right = df.first()
    assert df.select(phrases.score("a", "n", "l", "r").alias("s")).first()["s"] == 1000 * a * n // (left * right)


def test_empty(spark):
    for rows in ([], [(1, None, None, None)], [(1, "a b c", "en", "a")]):
        assert phrases.collocations(phrases.frequent_phrases(table(spark, rows))).count() == 0
