import random

from plain import components, documents, shingles

from riskweft.llm import jaccard
from riskweft.llm.words import PIECE, shingle_sets, word_hashes


def expected(rows):
    sets = [shingles(t) for _, t in rows]
    links = []
    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if a and sets[j] and 100 * common >= 80 * (len(a) + len(sets[j]) - common):
                links.append((rows[i][0], rows[j][0]))
    label = components([r[0] for r in rows], links)
    return {r[0]: (len(s), label[r[0]]) for r, s in zip(rows, sets)}


def corpus():
    r = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    rows, shared = [], [r.choice(words) for _ in range(60)]
    for i in range(150):
        kind = r.random()
        if kind < 0.5 or i < 10:
            said = [r.choice(words) for _ in range(r.randrange(1, 220))]
            if r.random() < 0.5:
                said += shared
        else:
            said = rows[r.randrange(len(rows))][1].split()
            for _ in range(r.randrange(0, 8)):
                k = r.randrange(len(said) + 1)
                said[k : k + r.randrange(3)] = [r.choice(words)] * r.randrange(2)
        rows.append((i, " ".join(said)))
    return rows + [(900, None), (901, ""), (902, " \n"), (903, "ONE two"), (904, "one\tTWO "), (905, "x " * 9000), (906, "x " * 8000)]


def test_against_plain_version(spark):
    rows = corpus()
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.linked_documents(documents(spark, rows)).collect()}
    assert found == expected(rows)
    assert len({c for _, c in found.values()}) < len(rows) - 20


def test_small_tiles_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "TILE_ROWS", 3)
    rows = corpus()
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.linked_documents(documents(spark, rows)).collect()}
    assert found == expected(rows)


def test_one_of_each_group(spark):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(5, text), (5, text), (3, text + " more"), (9, "alone is this one"), (10, None), (11, None), (None, "no id has this text here")]
    left = jaccard.one_of_each(documents(spark, rows))
    assert sorted(str(r["doc_id"]) for r in left.collect()) == ["10", "11", "3", "9", "None"]
    assert left.columns == documents(spark, []).columns
    twice = jaccard.one_of_each(documents(spark, [(5, text), (5, text)]))
    assert twice.count() == 1


def test_empty(spark):
    assert jaccard.linked_documents(documents(spark, [])).count() == 0


def test_long_texts_are_hashed_in_pieces():
    text = ("word%d " * 300_000) % tuple(range(300_000))
    whole, counts = word_hashes([text.encode(), b"", b"word7"])
    assert len(text) > 2 * PIECE and counts.tolist() == [300_000, 0, 1] and whole[7] == whole[-1] and len(set(whole.tolist())) == 300_000
    assert len(shingle_sets([text.encode()])[0]) == 299_996
