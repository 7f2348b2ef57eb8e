import hashlib
import math
import random
import re
import time
from collections import Counter

from plain import ascii_lower, documents
from hypothesis import given, settings
from hypothesis import strategies as st

from riskweft.llm import pii
from riskweft.llm.queries import QUERIES

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(digits[::-1]):
        total += int(c) if i % 2 == 0 else sum(divmod(int(c) * 2, 10))
    return total % 10 == 0


def expected(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


@settings(max_examples=600, deadline=None)
@given(st.text("a@.-_%0123456789 +()é,", max_size=60))
def test_patterns_match_plain_ones(text):
    assert [s[:3] for s in pii.base_spans(text)] == expected(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a@b.c", ".", "_", "-", "4111 1111 1111 1111", "4111111111111111", "1.2.3.4", "256.1.1.1", "01.002.3.4", "+1 (017) 555-7713", " ", "5", "é", "@", "x"]), max_size=12))
def test_joined_values_match_plain_ones(parts):
    text = "".join(parts)
    assert [s[:3] for s in pii.base_spans(text)] == expected(text)


def test_time_is_linear():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "+1" + " " * 300_000, "a@" * 150_000, "+1" * 100_000):
        pii.base_spans(text)


def corpus():
    rows = [(i, f"common words stand in every text and number{i} too") for i in range(200)]
    rows += [(300 + i, f"common words say that zorblax writes from jane.doe@example.com and common words end number{i}") for i in range(4)]
    rows += [(400, "only once does kimquat write from once@example.org"), (401, "zorblax"), (402, None), (403, ""), (None, "mail jane.doe@example.com now"), rows[201]]
    return rows


def test_spans_and_disclosure(spark):
    rows = corpus()
    found = pii.find_spans(documents(spark, rows)).toPandas()
    assert len(found) == len(rows)
    text = {r[0]: r[1] or "" for r in rows}
    for r in found.to_dict("records"):
        said = text[None if r["doc_id"] != r["doc_id"] else int(r["doc_id"])]
        assert r["base"] == ",".join(f"{k}:{a}:{b}" for k, a, b in expected(said))
        marked = {said[t["start"] : t["end"]] for t in r["terms"]}
        assert ("zorblax" in marked) == ("zorblax writes" in said)
        assert not marked & {"common", "words", "kimquat", "and"}


def test_sanitised_text(spark):
    done = {r["doc_id"]: r["text"] for r in pii.sanitise(documents(spark, corpus())).collect()}
    assert done[402] is None and done[403] == "" and done[400] == "only once does kimquat write from <EMAIL>"
    assert "jane" not in done[300] and "<EMAIL>" in done[300] and "zorblax" not in done[300] and done[5] == corpus()[5][1]


def test_disclosing_terms_go_wherever_they_stand(spark, tmp_path):
    far = " ".join(f"filler{i}" for i in range(30))
    rows = corpus() + [
        (500, f"Zorblax, {far} ünd ZORBLAX at zorblax@other.org é zorblax."), (501, f"jane.doe@example.com {far} zorblax"), (502, "xzorblax zorblax2 zor blax"), (503, "\U0001f600é zorblax"),
    ]
    found = {r["doc_id"]: r for r in pii.find_spans(documents(spark, rows), everywhere=True).collect()}
    for doc, text in rows:
        base = [(a, b) for _, a, b in expected(text or "")]
        want = [(m.start(), m.end()) for m in re.finditer("[0-9A-Za-z\x80-\U0010ffff]+", text or "") if m.group().lower() == "zorblax" and not any(a < m.end() and m.start() < b for a, b in base)]
        marked = [(t["start"], t["end"]) for t in found[doc]["terms"] if "zorblax" in text[t["start"] : t["end"]].lower()]
        assert marked == want, doc
    assert len(found[500]["terms"]) >= 3 and found[401]["terms"] and found[501]["terms"] and not found[502]["terms"]
    done = {r["doc_id"]: r["text"] for r in pii.sanitise(documents(spark, rows), everywhere=True).collect()}
    assert all("zorblax" not in (done[d] or "").lower() for d, _ in rows if d != 502)
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    registered = {r["doc_id"]: r["n_terms"] for r in QUERIES["op1_pii"](spark, str(tmp_path)).collect()}
    assert registered == {d: len(r["terms"]) for d, r in found.items()}


def digest(kind, value):
    return int.from_bytes(hashlib.blake2b(f"{kind}:{value}".encode(), digest_size=8).digest(), "little", signed=True)


def disclosures(rows):
    """(entity, term) -> PMI / IC by plain loops over whole texts."""
    together, of_entity, of_term = Counter(), Counter(), Counter()
    for _, text in rows:
        base = pii.base_spans(text or "")
        words = [(m.start(), m.end(), ascii_lower(m.group())) for m in re.finditer("[0-9A-Za-z\x80-\U0010ffff]+", text or "")]
        pairs = set()
        for kind, a, b, value in base:
            for x, y, w in [w for w in words if w[1] <= a][-10:] + [w for w in words if w[0] >= b][:10]:
                if re.search(r"[^\W\d_]", w) and not any(x < d and c < y for _, c, d, _ in base):
                    pairs.add((digest(kind, value), w))
        together.update(pairs)
        of_entity.update({e for e, _ in pairs})
        of_term.update({w for _, _, w in words})
    n, out = len(rows), {}
    for (e, t), k in together.items():
        if k >= 2 and 2 <= of_entity[e] < n:
            shown = math.log(n * k / (of_entity[e] * of_term[t])) / math.log(n / of_entity[e])
            if shown >= 0.75:
                out[e, t] = shown
    return out


def test_every_disclosure_number(spark):
    r = random.Random(3)
    words = [f"w{i}" for i in range(400)] + ["É", "straße", "x9"]
    people = [("ann@a.org", "annie"), ("bob@b.net", "bobby"), ("10.0.0.7", "gateway"), ("4111 1111 1111 1111", "cardholder"), ("+1 (017) 555-7713", "caller")]
    rows = []
    for i in range(400):
        said = [r.choice(words) for _ in range(r.randrange(0, 60))]
        for value, term in r.sample(people, r.randrange(0, 3)):
            k = r.randrange(len(said) + 1)
            long = "x" * 700 if r.random() < 0.2 else "near"
            said[k:k] = [term, long, value, term.upper()] if r.random() < 0.8 else [value]
        rows.append((i, " ".join(said)))
    want = disclosures(rows)
    docs = documents(spark, rows)
    found = {(x["entity"], x["term"]): x["disclosure"] for x in pii.disclosing(docs, pii._found(docs)).collect()}
    terms = sorted({t for _, t in want})
    hashed = dict(zip(terms, (int(h) for h in pii._term_hashes(terms).view("int64"))))
    assert len(want) >= 5 and set(found) == {(e, hashed[t]) for e, t in want}
    assert all(abs(found[e, hashed[t]] - v) < 1e-9 for (e, t), v in want.items())


def test_neighbours_are_counted_in_words():
    text = "one " + "y" * 900 + " two a@b.org three " + "z" * 900 + " four"
    assert set(pii._neighbours(text, pii.base_spans(text))[1]) == {"one", "y" * 900, "two", "three", "z" * 900, "four"}


def test_many_values_in_one_text(spark):
    text = " ".join(f"word{i % 7} u{i}@site.org" for i in range(40_000))
    start = time.perf_counter()
    spans = pii.base_spans(text)
    assert len(spans) == 40_000 and len(pii._neighbours(text, spans)[0]) > 200_000
    assert time.perf_counter() - start < 20
    found = pii.find_spans(documents(spark, [(1, text), (2, text)]), everywhere=True).first()
    assert found["n_email"] == 40_000
    assert time.perf_counter() - start < 60


def test_changed_texts(spark, tmp_path):
    docs = documents(spark, corpus())
    spans = pii.find_spans(docs, everywhere=True)
    marked = {r["doc_id"] for r in spans.collect() if r["base"] or r["terms"]}
    whole = {r["doc_id"]: r["text"] for r in pii.sanitise(docs, everywhere=True).collect()}
    new = {r["doc_id"]: r["text"] for r in pii.changed(docs, spans).collect()}
    assert set(new) == marked and all(whole[d] == t for d, t in new.items())
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = QUERIES["op1_pii"](spark, str(tmp_path)).collect()
    assert len(rows) == len(corpus())
    for r in rows:
        assert r["sanitised_sha256"] == (hashlib.sha256(new[r["doc_id"]].encode()).hexdigest() if r["doc_id"] in new else None)
        assert r["n_removed"] + r["n_generalised"] == r["n_terms"]


def test_empty(spark):
    assert pii.find_spans(documents(spark, [])).count() == 0
    assert pii.find_spans(documents(spark, []), everywhere=True).count() == 0


def test_query_digest(spark):
    row = pii.find_spans(documents(spark, [(1, "write to a@b.c")])).first()
    assert hashlib.sha256(row["base"].encode()).hexdigest() == hashlib.sha256(b"email:9:14").hexdigest() and row["n_email"] == 1
