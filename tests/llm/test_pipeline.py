"""Each stage against a plain version of what it keeps."""

import random

import corpus_pipeline
from plain import WORD, documents, shingles

from riskweft.llm import decontam, jaccard, language, lines


def corpus():
    r = random.Random(6)
    words = {"en": ["the", "thing", "what", "our", "stone", "wheat"], "de": ["schon", "übung", "zeit", "ein", "tatze"]}

    def said(lang, n):
        return " ".join(r.choice(words[lang]) + str(r.choice("abcdefgh")) + r.choice(words[lang]) for _ in range(n))

    passage = " ".join(f"bench{i}" for i in range(30))
    rows = [(i, "\n".join(said(lang, r.randrange(12, 30)) for _ in range(4)), lang, f"s{i % 3}") for i in range(60) for lang in ["en" if i % 3 else "de"]]
    copy = rows[10][1]
    near = "\n".join(" ".join("x" + w if k in (3, 9) else w for k, w in enumerate(line.split(" "))) for line in copy.split("\n"))
    rows += [(100, copy, "en", "s0"), (101, near, "en", "s1"), (102, said("en", 20) + " " + passage, "en", "s2"), (103, "123", "en", "s0"), (104, None, "en", "s0")]
    return rows, passage


def test_stages(spark, tmp_path):
    rows, passage = corpus()
    docs = documents(spark, rows)
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    step = dict(corpus_pipeline.STAGES)
    first = step["language_id"](spark, docs, str(tmp_path))
    assert {r[0] for r in rows} - {r["doc_id"] for r in first.collect()} == {103, 104}
    second = step["line_dedup"](spark, first, str(tmp_path))
    assert 100 not in {r["doc_id"] for r in second.collect()} and 101 in {r["doc_id"] for r in second.collect()}
    assert all(r["n_chars"] == len(r["text"]) for r in second.collect())
    third = step["ngram_jaccard"](spark, docs, str(tmp_path))
    sets = {r[0]: shingles(r[1]) for r in rows}
    gone = {a for a in sets for b in sets if b < a and sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    assert {r["doc_id"] for r in third.collect()} == set(sets) - gone and 100 in gone
    fourth = step["decontamination"](spark, second, str(tmp_path))
    assert {r["doc_id"] for r in second.collect()} - {r["doc_id"] for r in fourth.collect()} == {102}
    for stage in (first, second, third, fourth):
        assert stage.columns == docs.columns
    mixed = step["mixing"](spark, fourth, str(tmp_path)).collect()
    text = {r["doc_id"]: WORD.findall(r["text"]) for r in fourth.collect()}
    assert mixed and all(m["text"].split(" ") == text[m["doc_id"]][m["first"] : m["first"] + m["words"]] for m in mixed)


def test_run(spark, tmp_path):
    rows, passage = corpus()
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    found = corpus_pipeline.run(spark, str(tmp_path))
    assert {100, 102, 103, 104} & {r["doc_id"] for r in found.collect()} == set()
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "ngram_jaccard", "decontamination", "mixing"]
    assert corpus_pipeline.ORACLE_SQL is None and all(callable(f) for f in (decontam.matches, jaccard.one_of_each, language.keep_known, lines.drop_repeated))
