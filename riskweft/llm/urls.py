"""URL filters: rules indexed by their rarest literal token.

A rule is a pattern over host + path. `||` at its start stands for the host
itself or any of its subdomains, `*` for anything, `|` at an end for that end of
the text; every other character stands for itself. A run of letters, digits and
characters beyond ASCII that is bounded on both sides inside the pattern is a
literal token: a text that the rule fits has it as a whole token.

How often each of these tokens occurs is counted over all URLs, in one pass
whose tasks send one row per token of the rules. Each rule is then filed under
its rarest token. A URL's tokens fetch the rules filed under them, and only
those run their regular expressions, with the rules that have no literal token.

Site rules, `host/path` texts, are such patterns too: the longest one that fits
gives rule and verdict (equal lengths: the one that blocks, then the smaller
text). Where none fits, the method's own patterns decide: allow if an allowing
pattern fits or no blocking one does, else block.

The index of a pass is sent to the tasks; more than RULES_PER_PASS rules take
several passes over the staged table, and the best match so far is carried
along, so the index stays bounded.

Defined results: a null URL, one without `://` and an empty one have an empty
host and an empty path; no site rule fits them. A null page_id comes back as
null, repeated rows are judged one by one, an empty table gives an empty result.
`judge` ignores extra columns; `allowed` keeps all columns as they are, whatever
their names. URLs of any length are read whole.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweft.session import stage

ALLOW, BLOCK = "allow", "block"
#: Rules whose index is sent to the tasks at once.
RULES_PER_PASS = 100_000

# The site rules of the contract.
SITE_RULES = (
    (ALLOW, "com/"), (BLOCK, "example.com/en/"), (ALLOW, "www.example.com/en/"), (BLOCK, "net/es/"), (BLOCK, "net/fr/"),
)
#: What the method blocks where no site rule fits: hosts whose name says gambling, medicine trade, adult pages, advertising or spam.
PATTERNS = (
    (BLOCK, "||casino-"), (BLOCK, "||cheap-pills."), (BLOCK, "||adult-"), (BLOCK, "||free-bets."), (BLOCK, "||ads-track."), (BLOCK, "||spam-farm."),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_FOLD = str.maketrans(_UPPER, _LOWER)
_TOKEN = re.compile(r"[a-z0-9\u0080-\U0010FFFF]+")


@dataclass(frozen=True)
class Rule:
    verdict: str
    pattern: str
    #: The text that the result names, for a site rule.
    name: str | None = None

    def __post_init__(self):
        if self.verdict not in (ALLOW, BLOCK):
            raise ValueError(f"a rule allows or blocks: {self.verdict}")
        if not self.pattern.strip("|*"):
            raise ValueError("a rule needs a character that stands for itself")

    @property
    def order(self) -> tuple:
        """Site rules before patterns; of two site rules the longer one; of two patterns the one that allows."""
        if self.name is not None:
            return (1, len(self.name), self.verdict == BLOCK, _reversed(self.name))
        return (0, self.verdict == ALLOW, 0, ())


def _reversed(name: str) -> tuple:
    # Ends with a zero, so that the smaller of two texts is the greater key.
    return tuple(-ord(c) for c in name) + (0,)


def site_rules(rules: Sequence[tuple[str, str]]) -> list[Rule]:
    """host/path rules as patterns, the host lower-cased; a name with `*` or `|` is refused, because there they stand for themselves."""
    found = []
    for verdict, name in rules:
        host, slash, path = name.partition("/")
        if not slash or set(name) & set("*|"):
            raise ValueError(f"a site rule is host/path without * and |: {name}")
        found.append(Rule(verdict, f"||{host.translate(_FOLD)}/{path}", name))
    return found


def pattern_rules(rules: Sequence[tuple[str, str]]) -> list[Rule]:
    return [Rule(verdict, pattern) for verdict, pattern in rules]


def _anchors(pattern: str) -> tuple[str, str, str]:
    """(anchor at the start, middle, anchor at the end)."""
    head = "||" if pattern.startswith("||") else "|" if pattern.startswith("|") else ""
    tail = "|" if len(pattern) > len(head) and pattern.endswith("|") else ""
    return head, pattern[len(head) : len(pattern) - len(tail)], tail


def expression(pattern: str) -> str:
    """The regular expression of a pattern, over host + path."""
    head, middle, tail = _anchors(pattern)
    start = {"||": r"\A(?:[^/]*\.)?", "|": r"\A", "": ""}[head]
    return "(?s)" + start + ".*?".join(re.escape(x) for x in middle.split("*")) + (r"\Z" if tail else "")


def literal_tokens(pattern: str) -> list[str]:
    """Tokens that every text has whole that the pattern fits, lower-cased."""
    head, middle, tail = _anchors(pattern)
    runs = middle.translate(_FOLD).split("*")
    found = []
    for i, run in enumerate(runs):
        for token in _TOKEN.finditer(run):
            open_left = token.start() == 0 and (i > 0 or not head)
            open_right = token.end() == len(run) and (i < len(runs) - 1 or not tail)
            if not (open_left or open_right):
                found.append(token.group())
    return found


def _tokens(text: str) -> set[str]:
    return set(_TOKEN.findall(text.translate(_FOLD)))


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"://([^/?#]*)", 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"://[^/?#]*([^?#]*)", 1)


def token_counts(urls: DataFrame, rules: Sequence[Rule]) -> dict[str, int]:
    """In how many URLs each literal token of the rules occurs; urls has host and path."""
    wanted = frozenset(t for r in rules for t in literal_tokens(r.pattern))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for host, path in zip(batch.column("host").to_pylist(), batch.column("path").to_pylist()):
                seen.update(_tokens(host + path) & wanted)
        yield pa.RecordBatch.from_pydict({"token": pa.array(list(seen), pa.string()), "n": pa.array(list(seen.values()), pa.int64())})

    sums = urls.select("host", "path").mapInArrow(count, "token string, n bigint").groupBy("token").agg(F.sum("n").alias("n"))
    # One row for each token of the rules at most.
    return {r["token"]: r["n"] for r in sums.collect()}


def rarest(pattern: str, counts: dict[str, int]) -> str | None:
    """The literal token of the pattern in the fewest URLs (ties: the longer, then the smaller one); None without one."""
    return min(literal_tokens(pattern), key=lambda t: (counts.get(t, 0), -len(t), t), default=None)


class Index:
    """Rules by their rarest token, and the expressions that have been run (for tests and figures)."""

    def __init__(self, rules: Sequence[Rule], counts: dict[str, int]):
        self.filed: dict[str, list[Rule]] = defaultdict(list)
        self.everywhere: list[Rule] = []
        self.compiled: dict[str, re.Pattern] = {}
        self.runs = 0
        for rule in rules:
            token = rarest(rule.pattern, counts)
            (self.everywhere if token is None else self.filed[token]).append(rule)

    def candidates(self, text: str) -> list[Rule]:
        found = list(self.everywhere)
        for token in _tokens(text):
            found += self.filed.get(token, ())
        return found

    def best(self, text: str) -> Rule | None:
        """The rule that fits and comes first; better rules are tried first, so a hit ends the search."""
        for rule in sorted(self.candidates(text), key=lambda r: r.order, reverse=True):
            if rule.pattern not in self.compiled:
                self.compiled[rule.pattern] = re.compile(expression(rule.pattern))
            self.runs += 1
            if self.compiled[rule.pattern].search(text):
                return rule
        return None


def _pass(urls: DataFrame, rules: Sequence[Rule], counts: dict[str, int], first: bool) -> DataFrame:
    """urls with the best rule of this pass, or of an earlier one, as won (verdict, pattern, name)."""
    rules = tuple(rules)
    at, kind = urls.columns.index("won") if not first else -1, "struct<verdict:string,pattern:string,name:string>"

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(rules, counts)
        form = pa.struct([("verdict", pa.string()), ("pattern", pa.string()), ("name", pa.string())])
        for batch in batches:
            earlier = [None] * batch.num_rows if first else batch.column("won").to_pylist()
            won = []
            for host, path, had in zip(batch.column("host").to_pylist(), batch.column("path").to_pylist(), earlier):
                rule = index.best(host + path)
                old = Rule(**had) if had is not None else None
                best = max((r for r in (rule, old) if r is not None), key=lambda r: r.order, default=None)
                won.append(None if best is None else {"verdict": best.verdict, "pattern": best.pattern, "name": best.name})
            column = pa.array(won, form)
            if first:
                yield pa.RecordBatch.from_arrays([*batch.columns, column], [*batch.schema.names, "won"])
            else:
                yield batch.set_column(at, "won", column)

    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in urls.schema.fields if f.name != "won")
    return urls.mapInArrow(judged, f"{names}, won {kind}")


def _decided(rows: DataFrame, url: str, rules: Sequence[Rule], per_pass: int) -> DataFrame:
    """rows (key, url) as key, host, path, won."""
    urls = rows.select("key", host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    counts = token_counts(urls, rules)
    parts = [rules[i : i + per_pass] for i in range(0, len(rules), per_pass)]
    if not parts:
        return urls.withColumn("won", F.lit(None).cast("struct<verdict:string,pattern:string,name:string>"))
    out = _pass(urls, parts[0], counts, True)
    for more in parts[1:]:
        out = _pass(stage(out, "url-rules"), more, counts, False)
    return out


def judge(
    pages: DataFrame, key: str = "page_id", url: str = "url", sites: Sequence[tuple[str, str]] = SITE_RULES, patterns: Sequence[tuple[str, str]] = PATTERNS,
    per_pass: int = RULES_PER_PASS,
) -> DataFrame:
    """One row per page: the key under its name, host, path, rule (null if no site rule fits), verdict."""
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url"))
    done = _decided(rows, "url", [*site_rules(sites), *pattern_rules(patterns)], per_pass)
    return done.select(
        F.col("key").alias(key), "host", "path", F.col("won.name").alias("rule"), F.coalesce("won.verdict", F.lit(ALLOW)).alias("verdict"),
    )


def allowed(
    pages: DataFrame, url: str = "url", sites: Sequence[tuple[str, str]] = SITE_RULES, patterns: Sequence[tuple[str, str]] = PATTERNS, per_pass: int = RULES_PER_PASS,
) -> DataFrame:
    """The pages whose URL is allowed, with all their columns."""
    rows = pages.select(F.struct(*[F.col(f"`{c.replace('`', '``')}`") for c in pages.columns]).alias("key"), F.col(f"`{url.replace('`', '``')}`").alias("url"))
    done = _decided(rows, "url", [*site_rules(sites), *pattern_rules(patterns)], per_pass)
    return done.where(F.coalesce("won.verdict", F.lit(ALLOW)) == ALLOW).select("key.*")
