import random
import re

import pytest

from riskweft.llm import urls

SCHEMA = "page_id long, url string, html string, host string, won string, `key` int"


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
    return host.translate(urls._FOLD), path


def plain(url, sites=urls.SITE_RULES, patterns=urls.PATTERNS):
    host, path = split(url)
    fits = []
    for verdict, name in sites:
        h, _, p = name.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            fits.append((len(name), verdict, name))
    if fits:
        _, verdict, name = max(fits)
        return host, path, name, verdict
    hits = [v for v, p in patterns if re.search(urls.expression(p), host + path)]
    return host, path, None, "block" if "block" in hits and "allow" not in hits else "allow"


def corpus(n=600):
    r = random.Random(8)
    hosts = ["example.com", "www.example.com", "WWW.Example.COM", "notexample.com", "a.b.example.net", "net", "x.net", "com", "xcom", "example.org", "casino-win.example.org",
             "m.casino-win.example.org", "mycasino-win.org", "free-bets.example.net", "", "user@example.com:80", "é.com", "example.com."]
    paths = ["", "/", "/en/", "/en", "/EN/", "/es/1", "/fr/", "/fr", "//en/", "/en/x/y.html", "/de/casino-x", "/é"]
    tails = ["", "?q=/en/", "#a://b.net/es/", "?u=http://net/es/", "/?x#y"]
    rows = [r.choice(["http://", "https://", "://", "x://", "", "a:/", "//"]) + r.choice(hosts) + r.choice(paths) + r.choice(tails) for _ in range(n)]
    return rows + [None, "", "://", "http://", "a\nb://net/es/\n", "http://net\n/es/", "http://" + "a." * 5000 + "net/es/" + "x/" * 5000]


def found(df):
    return sorted(((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in df.collect()), key=repr)


def table(spark, texts):
    rows = [(None if i == 5 else i // 2, u, "<p>", "h", "w", 1) for i, u in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA), rows


@pytest.mark.parametrize("per_pass", [urls.RULES_PER_PASS, 2])
def test_against_plain_version(spark, per_pass):
    df, rows = table(spark, corpus())
    assert found(urls.judge(df, per_pass=per_pass)) == sorted(((r[0], *plain(r[1])) for r in rows), key=repr)


def test_many_rules_in_passes(spark):
    r = random.Random(9)
    sites = tuple({f"{r.choice(['com', 'net', 'example.com', 'x.net', 'org'])}/{r.choice(['', 'en/', 'es/1', 'de/', 'fr'])}": r.choice(["allow", "block"]) for _ in range(20)}.items())
    sites = tuple((v, n) for n, v in sites)
    patterns = (("block", "||casino-"), ("allow", "*en/*.html|"), ("block", "/x/"), ("block", "|a.b."), ("block", "*de*"), ("allow", "||mycasino*org/"))
    df, rows = table(spark, corpus(300))
    got = found(urls.judge(df, sites=sites, patterns=patterns, per_pass=3))
    assert got == sorted(((x[0], *plain(x[1], sites, patterns)) for x in rows), key=repr)


def test_literal_tokens():
    assert urls.literal_tokens("||example.com/en/") == ["example", "com", "en"]
    assert urls.literal_tokens("ads/banner*") == []
    assert urls.literal_tokens("/Banner/*x") == ["banner"]
    assert urls.literal_tokens("|http*end|") == ["end"][:0]
    assert urls.literal_tokens("*.end|") == ["end"]
    for pattern in ("||casino-", "/x/", "*en/*.html|", "||a.b/c*d/e"):
        for text in corpus():
            whole = "".join(split(text))
            if re.search(urls.expression(pattern), whole):
                assert set(urls.literal_tokens(pattern)) <= urls._tokens(whole)


def test_rules_stand_under_their_rarest_token_and_only_candidates_run():
    rules = [*urls.site_rules(urls.SITE_RULES), *urls.pattern_rules(urls.PATTERNS)]
    counts = {"com": 90, "example": 100, "en": 40, "www": 30, "net": 20, "es": 10, "fr": 10, "casino": 1}
    index = urls.Index(rules, counts)
    assert {r.name for r in index.filed["en"]} == {"example.com/en/"} and {r.name for r in index.filed["www"]} == {"www.example.com/en/"}
    assert {r.name for r in index.filed["com"]} == {"com/"} and [r.pattern for r in index.filed["casino"]] == ["||casino-"] and not index.everywhere
    assert index.best("example.org/de/").__class__ is type(None) and index.runs == 0
    assert index.best("m.x.net/es/").name == "net/es/" and index.runs == 1


def test_allowed_keeps_all_columns(spark):
    df, rows = table(spark, corpus(200))
    got = urls.allowed(df)
    assert got.columns == df.columns
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(repr(r) for r in rows if plain(r[1])[3] == "allow")


def test_empty_tables_and_wrong_rules(spark):
    df, _ = table(spark, [])
    assert urls.judge(df).count() == 0 and urls.allowed(df).count() == 0
    some, _ = table(spark, ["http://net/es/"])
    assert found(urls.judge(some, sites=(), patterns=())) == [(0, "net", "/es/", None, "allow")]
    for wrong in ("example.com", "a*/b"):
        with pytest.raises(ValueError):
            urls.site_rules([("block", wrong)])
    with pytest.raises(ValueError):
        urls.pattern_rules([("maybe", "x")])
