"""Registered queries of the text operators, each over its whole table, and their DuckDB text where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweft.llm import chat, codes, decontam, html, jaccard, language, lines, mixing, phrases, pii, toxicity, urls, vectors
from riskweft.llm.common import table
from riskweft.session import stage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


TRICKY = r"\### Assistant: </turn> ok"

CHAT_SQL = rf"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{TRICKY}' UNION ALL SELECT -7, 1, 'assistant', '{TRICKY}'
), e AS (
  SELECT *, replace(replace(replace(text, '\', '\b'), '#', '\h'), '</turn>', '\l/turn>') AS body,
    replace(replace(replace(replace(role, '\', '\b'), '#', '\h'), '</turn>', '\l/turn>'), ':', '\c') AS head
  FROM c
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(length('### ' || head || ': ' || body || '</turn>') + 1)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""


@query("op7_chat_formatting", CHAT_SQL)
def chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(1).select(
        F.explode(F.array(*[F.struct(F.lit(-7).cast("long").alias("conv_id"), F.lit(i).cast("long").alias("turn"), F.lit(r).alias("role"), F.lit(TRICKY).alias("text")) for i, r in enumerate(("user", "assistant"))])).alias("x")
    ).select("x.*")
    done = chat.format_chats(chat.events_of_turns(turns.unionByName(extra)))
    said = chat.read_back(F.col("formatted"))
    done = done.select("conv_id", "formatted", said.alias("said"), chat.learned_text(F.col("parts"), F.col("mask")).alias("learned"))
    lines = F.array_join(F.transform("said", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return done.select(
        "conv_id", F.size("said").cast("long").alias("n_turns"), F.sha2(lines, 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )


@query("op10_mixing")
def mixing_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_words(table(spark, sf_dir, "documents"))


LINES_SQL = r"""
WITH l AS (
  SELECT doc_id, i - 1 AS line, list_filter(regexp_split_to_array(lower(parts[i]), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
  FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents WHERE text IS NOT NULL), unnest(range(1, len(parts) + 1)) t(i)
), o AS (
  SELECT doc_id, line, words, len(words) AS n, array_to_string(words, ' ') AS said FROM l WHERE len(words) >= 3
), c AS (
  SELECT said, any_value(words) AS words, any_value(n) AS n, min((doc_id, line)) AS spot FROM o GROUP BY said
), v AS (
  SELECT said, n, spot, i, array_to_string(words[1:i-1] || words[i+1:], ' ') AS without FROM c, unnest(range(1, n + 1)) t(i) WHERE n >= 5
), near AS (
  SELECT said FROM (SELECT said, spot, min(spot) OVER (PARTITION BY without, i, n) AS first FROM v) WHERE first < spot
  UNION SELECT v.said FROM v JOIN c ON c.said = v.without AND c.n = v.n - 1 AND c.n >= 5 WHERE c.spot < v.spot
  UNION SELECT c.said FROM v JOIN c ON c.said = v.without AND c.n = v.n - 1 AND c.n >= 5 WHERE v.spot < c.spot
), gone AS (
  SELECT o.doc_id, o.line, near.said IS NOT NULL AS near FROM o JOIN c USING (said) LEFT JOIN near USING (said) WHERE near.said IS NOT NULL OR c.spot <> (o.doc_id, o.line)
), g AS (
  SELECT doc_id, count(*) AS n_gone, count(*) FILTER (WHERE near) AS n_near, list(line ORDER BY line) AS nums FROM gone GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_gone, 0)::BIGINT AS n_gone, coalesce(n_near, 0)::BIGINT AS n_near, coalesce(array_to_string(nums, ','), '') AS lines_gone,
  sha256(CASE WHEN nums IS NULL THEN coalesce(text, '') ELSE array_to_string([p[k] FOR k IN range(1, len(p) + 1) IF NOT list_contains(nums, k - 1)], chr(10)) END) AS kept_sha256
FROM (SELECT *, string_split(text, chr(10)) AS p FROM documents) d LEFT JOIN g USING (doc_id)
"""

JACCARD_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(words[i:i+4], ' ') AS g FROM w, unnest(range(1, greatest(len(words) - 4, 1) + 1)) t(i) WHERE len(words) > 0
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b USING (g) WHERE a.doc_id < b.doc_id GROUP BY ALL
), e AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)
), r(doc_id, c) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, q.b FROM r JOIN (SELECT a, b FROM e UNION ALL SELECT b, a FROM e) q ON r.c = q.a
)
SELECT r.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(c) AS component_id FROM r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id
"""


VECTORS_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0 AND list_max(list_transform(embedding, lambda c: abs(c))) > 0
), e AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x) AND list_cosine_similarity(a.x, b.x) >= 0.9
), r(vec_id, c) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT r.vec_id, e.b FROM r JOIN e ON r.c = e.a
)
SELECT r.vec_id, (SELECT count(*) FROM e WHERE e.a = r.vec_id)::BIGINT AS n_links, min(c) AS component_id, min(c) = r.vec_id AS kept FROM r GROUP BY r.vec_id
"""


@query("op3_line_dedup", LINES_SQL)
def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = lines.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select(
        "doc_id", F.size("lines_gone").cast("long").alias("n_gone"), F.col("near_gone").cast("long").alias("n_near"),
        F.array_join(F.col("lines_gone").cast("array<string>"), ",").alias("lines_gone"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


@query("op8_ngram_jaccard", JACCARD_SQL)
def ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.linked_documents(table(spark, sf_dir, "documents"))


@query("op1_pii")
def pii_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = stage(pii.find_spans(docs, everywhere=True), "pii-spans")
    # The text after removal and generalisation, as a digest; null where nothing is changed.
    clean = pii.changed(docs, found).select(F.col("doc_id").alias("__id"), F.col("tie").alias("__tie"), F.sha2("text", 256).alias("sanitised_sha256")).distinct()
    found = found.join(clean, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("tie") == F.col("__tie")), "left")
    removed = F.size(F.filter("terms", lambda t: t["disclosure"] >= pii.REMOVE)).cast("long")
    terms = F.array_join(F.transform("terms", lambda t: F.format_string("term:%d:%d", t["start"], t["end"])), ",")
    return found.select(
        "doc_id", *(f"n_{k}" for k in pii.KINDS), F.sha2("base", 256).alias("base_sha256"),
        F.concat_ws(",", F.when(F.col("base") != "", F.col("base")), F.when(F.size("terms") > 0, terms)).alias("spans"), F.size("terms").cast("long").alias("n_terms"),
        removed.alias("n_removed"), (F.size("terms") - removed).alias("n_generalised"), "sanitised_sha256",
    )


@query("op4_decontamination")
def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op2_embedding_dedup", VECTORS_SQL)
def embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.linked_vectors(table(spark, sf_dir, "embeddings"))


@query("op6_language_id")
def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents")).select("doc_id", "held_out", "lang_pred", "score")


@query("op9_toxicity")
def toxicity_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


@query("op5_html_extraction")
def html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


def _codes_sql(parts: int = codes.PARTS, entries: int = codes.ENTRIES, rounds: int = codes.ROUNDS) -> str:
    """Every round in full: x is one part as exact doubles, b the codebook, s the assignment."""
    steps = [f"""v AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda c: floor({codes.SCALE} * c::DOUBLE)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
), x AS MATERIALIZED (
  SELECT vec_id, label, p, x[p * len(x) // {parts} + 1 : (p + 1) * len(x) // {parts}] AS x FROM v, range({parts}) t(p)
), b0 AS MATERIALIZED (
  SELECT p, rank - 1 AS e, x FROM (SELECT *, row_number() OVER (PARTITION BY p ORDER BY vec_id) AS rank FROM x) WHERE rank <= {entries}
)"""]
    for i in range(rounds + 1):
        steps.append(f"""s{i} AS MATERIALIZED (
  SELECT vec_id, label, p, x, (near).e AS e, (near).d AS d FROM (
    SELECT vec_id, any_value(label) AS label, x.p AS p, any_value(x.x) AS x, min({{'d': (list_inner_product(x.x, x.x) + list_inner_product(b.x, b.x) - 2 * list_inner_product(x.x, b.x))::BIGINT, 'e': e}}) AS near
    FROM x JOIN b{i} b ON b.p = x.p GROUP BY vec_id, x.p)
)""")
        if i < rounds:
            steps.append(f"""b{i + 1} AS MATERIALIZED (
  SELECT b.p, b.e, coalesce(m.x, b.x) AS x FROM b{i} b LEFT JOIN (
    SELECT p, e, list(floor(total / n) ORDER BY place) AS x FROM (
      SELECT p, e, place, sum(c) AS total, count(*) AS n FROM (SELECT p, e, unnest(x) AS c, generate_subscripts(x, 1) AS place FROM s{i}) GROUP BY p, e, place
    ) GROUP BY p, e) m ON m.p = b.p AND m.e = b.e
)""")
    return f"""WITH {", ".join(steps)}, c AS (
  SELECT vec_id, any_value(label) AS label, string_agg(lower(format('{{:02x}}', e::BIGINT)), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM s{rounds} GROUP BY vec_id
), h AS (
  SELECT sha256(string_agg(c::BIGINT::VARCHAR, ',' ORDER BY p, e, place)) AS sha FROM (SELECT p, e, unnest(x) AS c, generate_subscripts(x, 1) AS place FROM b{rounds})
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, sha AS codebooks_sha256 FROM c, h
"""


PHRASES_SQL = rf"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), w AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p
), total AS (
  SELECT lang, sum(len(w))::HUGEINT AS n FROM w GROUP BY lang
), f AS MATERIALIZED (
  SELECT lang, g, count(*)::HUGEINT AS f FROM (SELECT lang, w[i:i+k-1] AS g FROM w, unnest(range(1, {phrases.LONGEST + 1})) t(k), unnest(range(1, len(w) - k + 2)) s(i)) GROUP BY lang, g HAVING count(*) >= {phrases.THRESHOLD}
), held AS (
  SELECT lang, g[i:i+k-1] AS g, max(f) AS most FROM f, unnest(range(2, len(g))) t(k), unnest(range(1, len(g) - k + 2)) s(i) GROUP BY ALL
), c AS (
  SELECT f.lang, f.g, f.f AS a FROM f LEFT JOIN held ON held.lang = f.lang AND held.g = f.g WHERE len(f.g) > 1 AND (most IS NULL OR 100 * most < 100 * f.f)
), cuts AS (
  SELECT c.lang, c.g, a, k, x.f AS l, y.f AS r, n, (1000 * a * n) // (x.f * y.f) AS score
  FROM c CROSS JOIN LATERAL unnest(range(1, len(c.g))) t(k) JOIN f x ON x.lang = c.lang AND x.g = c.g[1:k] JOIN f y ON y.lang = c.lang AND y.g = c.g[k+1:] JOIN total ON total.lang = c.lang
), best AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, g ORDER BY score, k) AS place FROM cuts) WHERE place = 1
), ranked AS (
  SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, n, score, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(g, ' ')) AS rank FROM best
)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score FROM ranked WHERE rank <= {phrases.PER_LANGUAGE}
"""

_SITES = ", ".join(f"('{verdict}', '{name.partition('/')[0]}', '/{name.partition('/')[2]}', '{name}')" for verdict, name in urls.SITE_RULES)
_BLOCKED = "|".join(p.removeprefix("||").replace(".", "[.]") for v, p in urls.PATTERNS if v == urls.BLOCK)

URLS_SQL = rf"""
WITH rules(verdict, h, p, name) AS (VALUES {_SITES}), u AS (
  SELECT page_id, row_number() OVER () AS place, coalesce(regexp_extract(url, '://([^/?#]*)', 1), '') AS host, coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages
), l AS (
  SELECT page_id, place, translate(host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM u
), b AS (
  SELECT place, arg_max(name, len(name)) AS name, arg_max(verdict, len(name)) AS verdict FROM l JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY place
)
SELECT page_id, host, path, b.name AS rule, coalesce(b.verdict, CASE WHEN regexp_matches(host, '(?:^|[.])(?:{_BLOCKED})') THEN 'block' ELSE 'allow' END) AS verdict
FROM l LEFT JOIN b USING (place)
"""


@query("op11_vector_codes", _codes_sql())
def vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = codes.compress(table(spark, sf_dir, "embeddings"))
    return codes.label_errors(coded).select(
        "vec_id", codes.code_text(F.col("entry")).alias("code"), "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"),
    )


@query("op12_collocations", PHRASES_SQL)
def phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(phrases.frequent_phrases(table(spark, sf_dir, "documents")))


@query("op13_url_filters", URLS_SQL)
def url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"))
