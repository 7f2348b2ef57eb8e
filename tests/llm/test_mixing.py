import pytest
from plain import WORD, documents

from riskweft.llm import mixing


def plain_targets(sizes: dict, weights=(5, 2, 1), most=3) -> dict:
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        open_names = [s for s in names if s not in fixed]
        unit = (total - sum(fixed.values())) / max(sum(weight[s] for s in open_names), 1)
        over = [s for s in open_names if unit * weight[s] > most * sizes[s]]
        if not over:
            return fixed | {s: unit * weight[s] for s in open_names}
        fixed |= {s: most * sizes[s] for s in over}


def corpus(spark):
    rows = []
    for i in range(400):
        source = [None, "b", "é", "a", "c"][0 if i % 2 else i % 5]
        rows.append((i, " ".join(f"w{i}x{k}" for k in range(i % 90)), "en", source))
    rows += [(1000, None, "en", "a"), (1001, " \t", "en", None), (1002, "tiny", "en", "zz"), (None, "x y z", "en", "a"), (7, rows[7][1], "en", None), (2000, "long " * 30_000, "en", "c")]
    return rows


def test_targets_and_takes(spark):
    rows = corpus(spark)
    found = mixing.taken_words(documents(spark, rows), block_words=16, shard_slots=64).toPandas()
    assert len(found) == len(rows)
    size = {}
    for _, text, _, source in rows:
        size[source] = size.get(source, 0) + len(WORD.findall(text or ""))
    targets = plain_targets(size)
    want = sorted((r[0] is None, r[0] or 0, len(WORD.findall(r[1] or "")), size[r[3]], round(targets[r[3]], 6)) for r in rows)
    got = sorted((d != d, 0 if d != d else int(d), n, s, round(t, 6)) for d, n, s, t in zip(found.doc_id, found["size"], found.source_size, found.target))
    assert got == want
    assert (found.taken <= 3 * found["size"]).all() and found.taken.sum() == pytest.approx(sum(size.values()), rel=0.02)
    by = found.groupby("source_size")
    for source_size, group in by:
        assert abs(group.taken.sum() - group.target.iloc[0]) <= max(0.1 * group.target.iloc[0], 64), source_size


def test_reruns_agree_and_texts_are_the_documents(spark):
    rows = [r for r in corpus(spark) if r[0] not in (None, 7)]
    docs = documents(spark, rows)
    key = ["doc_id", "size", "taken"]
    one = mixing.taken_words(docs, 16, 64).select(key).toPandas().sort_values(key).values.tolist()
    two = mixing.taken_words(docs.repartition(7), 16, 64).select(key).toPandas().sort_values(key).values.tolist()
    assert one == two
    words = {r[0]: WORD.findall(r[1] or "") for r in rows}
    taken = dict.fromkeys(words, 0)
    slots = set()
    for r in mixing.mixture(docs, 16, 64).collect():
        assert r["text"].split(" ") == words[r["doc_id"]][r["first"] : r["first"] + r["words"]]
        taken[r["doc_id"]] += r["words"]
        slots.add((r["shard"], r["source"], r["slot"]))
    assert taken == {d: t for d, _, t in one}
    assert max(sum(1 for s in slots if s[0] == shard) for shard in {s[0] for s in slots}) <= 64


def test_blocks_are_permuted(spark):
    docs = documents(spark, [(1, "w " * 16 * 200, "en", "a")])
    sources = mixing.source_table(mixing.measured(docs), 16)
    blocks = [r["block"] for r in mixing.slots(sources, 64).orderBy("shard", "slot").collect()]
    assert sorted(blocks) == list(range(200)) and blocks != sorted(blocks)


def test_nothing_to_mix(spark):
    assert mixing.taken_words(documents(spark, [])).count() == 0
    row = mixing.taken_words(documents(spark, [(1, None), (2, "")])).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in row] == [(0, 0.0, 0)] * 2
    assert mixing.mixture(documents(spark, [(1, "")])).count() == 0
