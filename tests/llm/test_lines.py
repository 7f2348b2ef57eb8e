import random

from plain import documents, word_edits

from riskweft.llm import lines


def expected(rows):
    """Lines that stay, by (doc_id, text)."""
    places, first = [], {}
    for doc, text in sorted({(d, t) for d, t in rows if t is not None}, key=lambda x: (x[0] is None, x[0] or 0)):
        for i, line in enumerate(text.split("\n")):
            words = tuple(line.lower().split())
            if len(words) >= 3:
                at = (doc is None, doc or 0, i)
                places.append(((doc, text), i, words, at))
                first[words] = min(first.get(words, at), at)
    near = set()
    for a in first:
        for b in first:
            if a != b and min(len(a), len(b)) >= 5 and abs(len(a) - len(b)) <= 1 and first[b] < first[a] and word_edits(list(a), list(b)) <= 1:
                near.add(a)
    return {(key, i) for key, i, words, at in places if words in near or at != first[words]}


def test_against_plain_version(spark):
    r = random.Random(3)
    base = [[f"w{r.randrange(6)}" for _ in range(r.randrange(1, 9))] for _ in range(60)]
    rows = []
    for d in range(60):
        said = []
        for _ in range(r.randrange(1, 6)):
            words = list(r.choice(base))
            for _ in range(r.randrange(3)):
                k = r.randrange(len(words) + 1)
                words[k : k + r.randrange(2)] = [f"w{r.randrange(6)}"] * r.randrange(2)
            said.append((" " if r.random() < 0.3 else "") + ("  " if r.random() < 0.1 else " ").join(words).title())
        rows.append((d, "\n".join(said)))
    rows += [(None, rows[3][1] + "\none more line of words"), (70, None), (71, ""), (72, "\n\n"), rows[5], (73, "long word " * 5000)]
    want = expected(rows)
    found = lines.dedup_lines(documents(spark, rows)).collect()
    assert len(found) == len(rows)
    given = sorted((r[0] is None, r[0] or 0, r[1] or "") for r in rows)
    by_id = {}
    for row in found:
        by_id.setdefault(row["doc_id"], []).append(row)
    for d, text in rows:
        row = by_id[d][0]
        gone = sorted(i for key, i in want if key == (d, text))
        assert row["lines_gone"] == gone, d
        assert row["text"] == (None if text is None else "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone))
        assert row["n"] == 1 and row["first"] == "x"
    assert given and len(want) > 40


def test_earliest_of_many_near_copies_stays(spark):
    rows = [(i, f"the same words stand here number{i} each time") for i in range(300)] + [(500, "a line of its own stands here")]
    left = lines.drop_repeated(documents(spark, rows)).select("doc_id", "n_chars").collect()
    assert sorted(r["doc_id"] for r in left) == [0, 500]


def test_stage_takes_short_lines_too(spark):
    copy = "a line that stands in two documents\nEauouon.\n\n長い文章は一語\nyes  no"
    rows = [(1, copy), (2, copy.upper()), (3, " eauouon. \nits own\n\nyes no\n\nyes"), (4, "長い文章は一語"), (5, "no"), (6, "yes\nits"), (7, "\n\n"), (None, "its\nother")]
    left = {r["doc_id"]: (r["text"], r["n_chars"]) for r in lines.drop_repeated(documents(spark, rows)).collect()}
    want = {1: copy, 3: "its own\n\n\nyes", 5: "no", 6: "its", 7: "\n\n", None: "other"}
    assert left == {d: (t, len(t)) for d, t in want.items()}


def test_empty(spark):
    assert lines.dedup_lines(documents(spark, [])).count() == 0
    assert [r["text"] for r in lines.drop_repeated(documents(spark, [(1, None), (2, "")])).collect()] in ([None, ""], ["", None])
