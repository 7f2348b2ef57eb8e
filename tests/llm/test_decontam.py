import random
from itertools import combinations

from plain import WORD, ascii_lower, documents

from riskweft.llm import decontam

ITEMS = "item_id long, text string, first string"
OLD = ((0, 1, 2, 3, 5, 6), (0, 1, 3, 4, 7, 8), (0, 2, 3, 5, 8, 9))
OPEN = {c for c in combinations(range(20), 4) if all(set(c) & {at + i for i in m} for m in OLD for at in range(20 - m[-1]))}


def words(text):
    return WORD.findall(ascii_lower(text or ""))


def expected(rows, items):
    """All diagonals of all pairs, without seeds."""
    out = set()
    for doc, text in rows:
        a = words(text)
        for item, said in items:
            b = words(said)
            need = min(decontam.OVERLAP, len(b))
            if len(b) < decontam.MIN_ITEM:
                continue
            for d in range(-len(b), len(a)):
                low, high = max(0, d), min(len(a), d + len(b))
                same = [a[i] == b[i - d] for i in range(low, high)]
                percent = 80 if len(b) >= 7 else 100
                if any(100 * sum(same[k : k + need]) >= percent * need for k in range(len(same) - need + 1)):
                    out.add((doc, item))
    return out


def corpus():
    r = random.Random(9)
    vocabulary = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(r.choice(vocabulary) for _ in range(r.randrange(20, 60)))) for i in range(12)]
    items += [(20, "Five Words make an item"), (21, "four words are none"), (22, None), (23, items[0][1].upper()), (24, "six words are here as well")]
    rows = []
    for d in range(120):
        said = [r.choice(vocabulary) for _ in range(r.randrange(0, 150))]
        if d % 3 == 0:
            passage = r.choice(items[:12])[1].split()
            for _ in range(r.randrange(0, 1 + len(passage) // 8)):
                passage[r.randrange(len(passage))] = "other"
            if d % 2:
                passage = passage[: r.randrange(10, len(passage))]
            k = r.randrange(len(said) + 1)
            said[k:k] = passage
        rows.append((d, " ".join(said)))
    rows += [(200, "here: five words make an item in it"), (201, "four words are none"), (202, None), (203, ""), (204, "so six words are here as well, too"), rows[0], (205, "six words are here as well")]
    return rows, items


def test_against_plain_version(spark):
    rows, items = corpus()
    found = decontam.matches(documents(spark, rows), spark.createDataFrame([(*i, "x") for i in items], ITEMS)).collect()
    # Item 23 has the words of item 0 and goes by its name.
    want = {(d, i) for d, i in expected(rows, items) if i != 23}
    assert {(r["doc_id"], r["item_id"]) for r in found} == want and len(want) > 30
    text = dict(rows)
    for r in found:
        assert r["first"] + r["words"] <= len(words(text[r["doc_id"]])) and 10 * r["matched"] >= 7 * r["words"]


def test_every_fifth_word_changed_is_found(spark):
    item = [f"v{i}" for i in range(40)]
    changed = " ".join(w if i % 5 != 4 else "other" for i, w in enumerate(item))
    bench = spark.createDataFrame([(1, " ".join(item), "x")], ITEMS)
    left = decontam.decontaminate(documents(spark, [(1, "before " + changed + " after"), (2, "clean"), (None, None)]), bench)
    assert sorted(str(r["doc_id"]) for r in left.collect()) == ["2", "None"] and left.columns == documents(spark, []).columns


def test_masks_leave_no_placement_out():
    for n in range(7, 60):
        size = min(n, decontam.OVERLAP)
        places = [frozenset(at + i for i in mask) for mask in decontam._masks(n) for at in range(size - mask[-1])]
        for changed in combinations(range(size), size * (100 - decontam.PERCENT) // 100):
            assert any(p.isdisjoint(changed) for p in places), (n, changed)


def test_every_placement_in_short_items(spark):
    items = [(n, " ".join(f"i{n}w{k}" for k in range(n)), "x") for n in range(5, 21)]
    rows, want = [], set()
    for n, said, _ in items:
        for free in {0, n // 5, n // 5 + 1} if n >= 7 else {0, 1}:
            # All placements, of 20 words only each tenth and those that three masks had left out.
            for k, changed in enumerate(combinations(range(n), free)):
                if n > 17 and k % 10 and changed not in OPEN:
                    continue
                text = " ".join("other" if i in changed else w for i, w in enumerate(said.split()))
                rows.append((len(rows), f"before {text} after"))
                if free <= (n // 5 if n >= 7 else 0):
                    want.add((rows[-1][0], n))
    found = decontam.matches(documents(spark, rows), spark.createDataFrame(items, ITEMS)).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == want and len(want) > 2000


def test_empty(spark):
    none = spark.createDataFrame([], ITEMS)
    assert decontam.matches(documents(spark, [(1, "a b c d e f g")]), none).count() == 0
    assert decontam.matches(documents(spark, []), spark.createDataFrame([(1, "a b c d e f g", "x")], ITEMS)).count() == 0
