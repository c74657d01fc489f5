"""Named queries over the driver tables and the SQL that they are checked against.

Queries run over whole tables. The SQL is written on its own, for DuckDB; character classes that
the engines read differently are spelled out on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.chars import WS, re2
from ..operators import dedup, html, language, quality, tokens, urls
from ..session import spread, table
from ..sources import shards
from . import corpus

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


_W = re2(WS).replace("\\t-\\r", "\\x09-\\x0d")
_NOISE = re2(T.NOISE)
_URL_EMAIL = re2(T.URL).replace("\\t-\\r", "\\x09-\\x0d") + "|" + T.EMAIL
_STRIP = lambda x: f"regexp_replace({x}, '^[{_W}]+|[{_W}]+$', '', 'g')"

CLEANED = rf"""
raw AS (SELECT doc_id, source, lang, nfc_normalize(text) AS t FROM documents WHERE length(text) BETWEEN 50 AND 1000000),
scrubbed AS (
  SELECT doc_id, source, lang, regexp_replace(regexp_replace(regexp_replace(t, '{_NOISE}', '', 'g'), '{T.TAG}', ' ', 'g'), '(?i){_URL_EMAIL}', ' ', 'g') AS t FROM raw),
spaced AS (
  SELECT doc_id, source, lang, regexp_replace(regexp_replace(regexp_replace(t, '\r\n?', chr(10), 'g'), '[ \t]+', ' ', 'g'), '\n\n\n+', chr(10) || chr(10), 'g') AS t FROM scrubbed),
lined AS (
  SELECT doc_id, source, lang, regexp_split_to_array(regexp_replace(t, '\n$', ''), '[\n\x{{85}}\x{{2028}}\x{{2029}}]') AS l FROM spaced),
keyed AS (SELECT *, list_transform(l, lambda x: {_STRIP('x')}) AS k FROM lined),
firsts AS (
  SELECT doc_id, source, lang, {_STRIP("array_to_string(list_filter(l, lambda x, i: list_position(k, k[i]) = i), chr(10))")} AS t FROM keyed),
cleaned AS (SELECT doc_id, source, lang, t FROM firsts WHERE length(t) BETWEEN 50 AND 1000000)"""

_WORDS = rf"len(list_filter(regexp_split_to_array(t, '[{_W}]+'), lambda w: w <> ''))"


def _documents(spark: SparkSession, d: str) -> DataFrame:
    """The documents, dealt to all cores where they are few: every query that uses this does much per row."""
    return spread(table(spark, d, "documents"))


def _cleaned(spark: SparkSession, d: str) -> DataFrame:
    return T.clean(_documents(spark, d)).where("clean_text is not null")


@query(f"WITH {CLEANED} SELECT doc_id, length(t)::BIGINT AS char_count, {_WORDS}::BIGINT AS word_count, greatest(1, length(t) // 4)::BIGINT AS token_estimate FROM cleaned")
def clean_counts(spark, d):
    return _cleaned(spark, d).select("doc_id", *T.counters(F.col("clean_text")))


@query(f"WITH {CLEANED} SELECT doc_id, sha256(t) AS content_hash FROM cleaned")
def clean_text_hash(spark, d):
    return _cleaned(spark, d).select("doc_id", F.sha2("clean_text", 256).alias("content_hash"))


_MEASURES = rf"""
SELECT doc_id,
  greatest(1, len(list_filter(string_split(regexp_replace(t, '([.!?])[{_W}]+', '\1' || chr(1), 'g'), chr(1)), lambda p: {_STRIP('p')} <> '')))::BIGINT AS sentence_count,
  len(regexp_extract_all(t, '[.,!?;:"''()\[\]{{}}]'))::BIGINT AS n_punctuation, len(regexp_extract_all(t, '\p{{Nd}}'))::BIGINT AS n_numeric, sha256(t) AS content_hash
FROM cleaned"""


@query(f"WITH {CLEANED} {_MEASURES}")
def doc_metadata(spark, d):
    return _cleaned(spark, d).select("doc_id", *T.document_measures(F.col("clean_text")))


def _profiled(counted: str, scored: str) -> str:
    """CTEs up to `detected`: profiles from the texts of `counted` (doc_id, lang, text), by which those of `scored` are detected."""
    gram = "unnest(list_transform(range(1, len(c) - 1), lambda i: {'pos': i, 'gram': c[i] || c[i + 1] || c[i + 2]}), recursive := true)"
    return f"""
learned AS (SELECT lang, {gram} FROM (SELECT lang, string_split(lower(text), '') AS c FROM ({counted}) WHERE text IS NOT NULL AND lang IS NOT NULL) WHERE len(c) >= 3),
profiles AS (SELECT lang, gram, row_number() OVER (PARTITION BY lang ORDER BY n DESC, gram) - 1 AS rank FROM (SELECT lang, gram, count(*) AS n FROM learned GROUP BY lang, gram) QUALIFY rank < {language.PROFILE}),
grams AS (SELECT doc_id, {gram} FROM (SELECT doc_id, string_split(lower(left(text, {language.SAMPLE})), '') AS c FROM ({scored}) WHERE text IS NOT NULL) WHERE len(c) >= 3),
scores AS (SELECT g.doc_id, p.lang, sum({language.PROFILE} - p.rank)::BIGINT AS score, min(g.pos) AS first FROM grams g JOIN profiles p USING (gram) GROUP BY g.doc_id, p.lang),
best AS (SELECT doc_id, lang, score, sum(score) OVER (PARTITION BY doc_id) AS total FROM scores QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, first, lang) = 1),
detected AS (SELECT d.doc_id, d.lang, coalesce(b.lang, 'unknown') AS language, coalesce(b.score, 0)::BIGINT AS best, coalesce(b.total, 0)::BIGINT AS total FROM ({scored}) d LEFT JOIN best b USING (doc_id))"""


_PROFILE = _profiled(f"SELECT lang, left(text, {language.SAMPLE}) AS text FROM documents", "SELECT doc_id, lang, text FROM documents")


@query(f"WITH {_PROFILE} SELECT lang, rank::INTEGER AS rank, gram FROM profiles")
def lang_profiles(spark, d):
    # The SQL of this query and of lang_detect counts the first characters only.
    return language.build_profiles(table(spark, d, "documents"), sample=language.SAMPLE)


@query(f"WITH {_PROFILE} SELECT doc_id, language, best, total FROM detected")
def lang_detect(spark, d):
    docs = _documents(spark, d)
    return language.detect(docs, language.build_profiles(docs, sample=language.SAMPLE)).withColumnRenamed("id", "doc_id")


@query(f"WITH {_PROFILE} SELECT lang, language, count(*)::BIGINT AS n FROM detected GROUP BY lang, language")
def lang_confusion(spark, d):
    return lang_detect(spark, d).join(table(spark, d, "documents").select("doc_id", "lang"), "doc_id").groupBy("lang", "language").agg(F.count("*").alias("n"))


_LINES = f"list_filter(regexp_split_to_array(text, '\\r\\n|[\\n\\x0b\\x0c\\r\\x1c-\\x1e\\x{{85}}\\x{{2028}}\\x{{2029}}]'), lambda x: regexp_matches(x, '[^{_W}]'))"
def _counted(rows: str) -> str:
    return rf"""
counted AS (
  SELECT doc_id, length(text)::BIGINT AS n_chars, len(w)::BIGINT AS n_words, len(regexp_extract_all(text, '\p{{L}}'))::BIGINT AS n_alpha, len(regexp_extract_all(text, '\p{{Lu}}'))::BIGINT AS n_upper,
    len(regexp_extract_all(text, '\p{{Nd}}'))::BIGINT AS n_digits, len(regexp_extract_all(text, '[{_W}]'))::BIGINT AS n_space, len(list_distinct(list_transform(w, lambda x: lower(x))))::BIGINT AS n_unique,
    len(l)::BIGINT AS n_lines, len(list_filter(l, lambda x: regexp_matches(x, '^[{_W}]*[-•*·▪▸►◦‣⁃][{_W}]')))::BIGINT AS n_bullets
  FROM (SELECT doc_id, text, list_filter(regexp_split_to_array(text, '[{_W}]+'), lambda w: w <> '') AS w, {_LINES} AS l FROM {rows} WHERE text IS NOT NULL))"""


_COUNTS = _counted("documents")
_SCORE = """
parts AS (
  SELECT *, 1 - least((n_chars - n_alpha - n_digits - n_space) / n_chars / 0.15::DOUBLE, 1) * 0.5 AS s1, 1 - least(n_digits / n_chars / 0.30::DOUBLE, 1) * 0.5 AS s2,
    CASE WHEN n_alpha > 0 THEN 1 - least(n_upper / n_alpha / 0.25::DOUBLE, 1) * 0.5 END AS s3, CASE WHEN (n_chars - n_space) / n_words BETWEEN 3 AND 12 THEN 1.0 ELSE 0.5 END::DOUBLE AS s4,
    least(n_unique / n_words / 0.20::DOUBLE, 1) AS s5, CASE WHEN n_lines > 0 THEN 1 - least(n_bullets / n_lines * 2, 1) * 0.4 END AS s6
  FROM counted WHERE n_words > 0),
scored AS (SELECT c.doc_id, c.n_words, coalesce((s1 + s2 + coalesce(s3, 0) + s4 + s5 + coalesce(s6, 0)) / (4 + (s3 IS NOT NULL)::INT + (s6 IS NOT NULL)::INT), 0) AS score FROM counted c LEFT JOIN parts USING (doc_id))"""


@query(f"WITH {_COUNTS} SELECT * FROM counted")
def quality_components(spark, d):
    docs = _documents(spark, d).where("text is not null")
    return docs.select("doc_id", *[c.alias(n) for n, c in quality.counts(F.col("text")).items()])


@query(f"WITH {_COUNTS}, {_SCORE} SELECT doc_id, floor(round(score, 4) * 1000 + 0.5)::BIGINT AS score_millis, score >= 0.5 AND n_words >= 20 AS passed FROM scored")
def quality_score(spark, d):
    rows = quality_components(spark, d).withColumn("quality_score", quality.score())
    return rows.select("doc_id", F.floor(F.col("quality_score") * 1000 + 0.5).alias("score_millis"), quality.gate().alias("passed"))


@query("SELECT doc_id, doc_id = min(doc_id) OVER (PARTITION BY sha256(text)) AS is_first FROM documents")
def exact_dedup_keep(spark, d):
    return dedup.exact_keep(table(spark, d, "documents")).select("doc_id", "is_first")


def _hashes(n: int) -> str:
    a, b = dedup.hash_family(n)
    return ", ".join(f"min(({x}::UBIGINT * h + {y}) & 4294967295) AS m{i}" for i, (x, y) in enumerate(zip(a, b, strict=True)))


def _signed(rows: str) -> str:
    return f"""
shingled AS (
  SELECT DISTINCT doc_id, ('0x' || left(md5(substring(t, i, 5)), 8))::UBIGINT AS h
  FROM (SELECT doc_id, lower(text) AS t, unnest(range(1, greatest(1, length(text) - 4) + 1)) AS i FROM {rows} WHERE text IS NOT NULL)),
signed AS (SELECT doc_id, {_hashes(128)} FROM shingled GROUP BY doc_id)"""


_SIGNED = _signed("documents")


@query(f"WITH {_SIGNED} SELECT doc_id, sha256(concat_ws(',', {', '.join(f'm{i}' for i in range(128))})) AS signature_hash FROM signed")
def minhash_signature(spark, d):
    docs = _documents(spark, d).where("text is not null")
    return docs.select("doc_id", F.sha2(F.concat_ws(",", dedup.signature_udf()(F.col("text")).cast("array<string>")), 256).alias("signature_hash"))


def _bands() -> str:
    return " UNION ALL ".join(f"SELECT doc_id, '{i}:' || concat_ws(',', {', '.join(f'm{j}' for j in range(8 * i, 8 * i + 8))}) AS bucket FROM signed" for i in range(16))


def _greedy_ctes(signed: str, rounds: int = 4) -> str:
    """The fixpoint of dedup.lsh_keep, unrolled: d{rounds} has the documents that go."""
    out = [f"{signed}, member AS MATERIALIZED ({_bands()}), d0 AS (SELECT NULL::BIGINT AS doc_id WHERE false), k0 AS (SELECT NULL::BIGINT AS doc_id WHERE false)"]
    for r in range(1, rounds + 1):
        p = r - 1
        out.append(f"o{r} AS MATERIALIZED (SELECT * FROM member WHERE doc_id NOT IN (SELECT doc_id FROM d{p}))")
        out.append(f"f{r} AS (SELECT doc_id, doc_id = min(doc_id) OVER (PARTITION BY bucket) AS is_least FROM o{r})")
        out.append(f"k{r} AS MATERIALIZED (SELECT doc_id FROM f{r} GROUP BY doc_id HAVING bool_and(is_least))")
        out.append(f"d{r} AS MATERIALIZED (SELECT doc_id FROM d{p} UNION SELECT doc_id FROM o{r} WHERE doc_id NOT IN (SELECT doc_id FROM k{r}) AND bucket IN (SELECT bucket FROM o{r} WHERE doc_id IN (SELECT doc_id FROM k{r})))")
    return ", ".join(out)


def _greedy() -> str:
    return f"WITH {_greedy_ctes(_SIGNED)} SELECT doc_id, doc_id NOT IN (SELECT doc_id FROM d4) AS kept FROM signed"


@query(_greedy())
def lsh_keep(spark, d):
    return dedup.lsh_keep(_documents(spark, d)).withColumnRenamed("id", "doc_id")


def _judged(min_chars: int, min_score: float, min_words: int, min_confidence: float) -> str:
    """CTEs up to `judged` (doc_id, stage, ...): the corpus pipeline by the SQL of its stages."""
    gated = CLEANED.replace("BETWEEN 50", f"BETWEEN {min_chars}")
    return f"""{gated}, clean AS MATERIALIZED (SELECT doc_id, lang, t AS text FROM cleaned), {_profiled("SELECT lang, text FROM documents", "SELECT doc_id, lang, text FROM clean")}, {_counted("clean")}, {_SCORE},
staged AS MATERIALIZED (
  SELECT c.doc_id, c.text, d.language, round(d.best / nullif(d.total, 0), 4) AS confidence, round(s.score, 4) AS quality,
    CASE WHEN coalesce(round(d.best / nullif(d.total, 0), 4), 0) < {min_confidence} THEN 2 WHEN s.n_words < {min_words} OR round(s.score, 4) < {min_score} THEN 3 ELSE 4 END AS stage
  FROM clean c JOIN detected d USING (doc_id) JOIN scored s USING (doc_id)),
{_greedy_ctes(_signed("(SELECT * FROM staged WHERE stage = 4)"))},
judged AS (SELECT d.doc_id, s.text, s.language, s.confidence, s.quality, CASE WHEN s.doc_id IS NULL THEN 1 WHEN s.stage = 4 AND s.doc_id NOT IN (SELECT doc_id FROM d4) THEN 5 ELSE s.stage END AS stage FROM documents d LEFT JOIN staged s USING (doc_id))"""


_FUNNEL = ", ".join(f"count(*) FILTER (stage >= {i})::BIGINT AS {n}" for i, n in enumerate(corpus.STAGES, 1))
_LIBRARY, _WORKER = _judged(50, 0.5, 20, 0.1), _judged(30, 0.4, 10, 0.05)


@query(f"""WITH {_LIBRARY} SELECT doc_id, language, floor(confidence * 1000 + 0.5)::BIGINT AS confidence_millis, floor(quality * 1000 + 0.5)::BIGINT AS score_millis, length(text)::BIGINT AS char_count,
  {_WORDS.replace("(t,", "(text,")}::BIGINT AS word_count, greatest(1, length(text) // 4)::BIGINT AS token_estimate, sha256(text) AS content_hash FROM judged WHERE stage = 5""")
def flagship_corpus(spark, d):
    docs = _documents(spark, d)
    judged = corpus.judge(docs, language.build_profiles(docs))
    millis = lambda c, name: F.floor(F.col(c) * 1000 + 0.5).alias(name)
    return corpus.kept(judged).select("doc_id", "language", millis("lang_confidence", "confidence_millis"), millis("quality_score", "score_millis"), *T.counters(F.col("clean_text"), F.col("n_words")), F.sha2("clean_text", 256).alias("content_hash"))


@query(f"WITH {_LIBRARY} SELECT {_FUNNEL} FROM judged")
def pipeline_funnel(spark, d):
    docs = _documents(spark, d)
    return corpus.funnel(corpus.judge(docs, language.build_profiles(docs)))


@query(f"WITH {_WORKER} SELECT {_FUNNEL} FROM judged")
def pipeline_funnel_worker(spark, d):
    docs = _documents(spark, d)
    return corpus.funnel(corpus.judge(docs, language.build_profiles(docs), corpus.CorpusConfig.worker()))


_NORMAL = """
split AS (SELECT page_id, regexp_extract(url, '^(https?)://', 1) AS scheme, lower(regexp_extract(url, '^https?://([^/?#]*)', 1)) AS host, regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1) AS path, regexp_extract(url, '\\?([^#]*)', 1) AS q FROM pages),
normal AS (
  SELECT page_id, host, scheme || '://' || host || CASE WHEN path IN ('', '/') THEN '/' ELSE regexp_replace(path, '/+$', '') END
    || CASE WHEN q = '' THEN '' ELSE '?' || array_to_string(list_sort(list_filter(string_split(q, '&'), lambda x: NOT regexp_matches(x, '=$|^[^=]*$'))), '&') END AS normalized
  FROM split)"""


@query(f"WITH {_NORMAL} SELECT page_id, normalized, sha256(normalized) AS fp FROM normal")
def url_normalized(spark, d):
    return urls.canonicalize(table(spark, d, "pages")).select("page_id", "normalized", "fp")


@query("SELECT page_id, lower(regexp_extract(url, '^(https?)://', 1)) AS scheme, lower(regexp_extract(url, '^https?://([^/?#]*)', 1)) AS host, coalesce(nullif(regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1), ''), '/') AS path, regexp_extract(url, '\\?([^#]*)', 1) AS query, regexp_extract(url, '#(.*)$', 1) AS fragment FROM pages")
def url_parts(spark, d):
    parts = table(spark, d, "pages").select("page_id", urls.url_parts("url").alias("p"))
    return parts.select("page_id", "p.scheme", "p.host", "p.path", "p.query", "p.fragment")


@query("SELECT page_id, NOT regexp_matches(url, '(?i)^https?://') OR length(url) > 2048 AS rejected FROM pages")
def url_fast_reject(spark, d):
    return table(spark, d, "pages").select("page_id", urls.fast_reject(F.col("url")).alias("rejected"))


@query("SELECT regexp_extract(url, '^https?://([^/?#]*)', 1) AS domain, count(*)::BIGINT AS n FROM pages GROUP BY 1")
def domain_counts(spark, d):
    return table(spark, d, "pages").groupBy(urls.domain(F.col("url")).alias("domain")).agg(F.count("*").alias("n"))


_LINKS = r"""
bare AS (SELECT url, regexp_replace(regexp_replace(html, '<!--.*?-->', '', 'gs'), '<(script|style)\b.*?</(script|style)\s*>', '', 'gis') AS h FROM pages WHERE html IS NOT NULL),
links AS (SELECT url, unnest(regexp_extract_all(h, '<a\s[^>]*?href="([^"]+)"', 1, 'i')) AS href, generate_subscripts(regexp_extract_all(h, '<a\s[^>]*?href="([^"]+)"', 1, 'i'), 1) - 1 AS pos FROM bare)"""


# Percent-coding of all but what a path may hold as it is.
_QUOTED = "url_encode({})"
for _c in "/:@!$&'()*+,;=%":
    _QUOTED = f"replace({_QUOTED}, '%{ord(_c):02X}', '{_c.replace(chr(39), chr(39) * 2)}')"


@query(f"""WITH {_LINKS}, full_links AS (SELECT DISTINCT regexp_extract(url, '^(https?)://', 1) || '://' || lower(regexp_extract(url, '^https?://([^/?#]*)', 1)) || CASE WHEN href = '/' THEN '/' ELSE {_QUOTED.format("regexp_replace(href, '/+$', '')")} END AS normalized FROM links WHERE href LIKE '/%')
SELECT normalized, sha256(normalized) AS fp FROM full_links""")
def frontier_links(spark, d):
    return urls.frontier(html.page_links(spread(table(spark, d, "pages"))))


@query(f"WITH {_LINKS} SELECT url, pos::INTEGER AS pos, href FROM links")
def page_links(spark, d):
    return html.page_links(table(spark, d, "pages"))


@query()
def page_extract(spark, d):
    return html.extract_pages(spread(table(spark, d, "pages"))).select("page_id", "url", "title", "text")


_STATS = "count(*)::BIGINT AS docs, sum(length(text))::BIGINT AS chars, sum(greatest(1, length(text) // 4))::BIGINT AS tokens"


@query(f"SELECT source AS shard, {_STATS} FROM documents WHERE text IS NOT NULL GROUP BY source")
def corpus_stats_by_source(spark, d):
    docs = table(spark, d, "documents").where("text is not null").select("source", F.col("lang").alias("language"), *T.counters(F.col("text")))
    return shards.shard_stats(docs, F.col("source")).select("shard", "docs", "chars", "tokens")


@query(f"SELECT lang, {_STATS} FROM documents WHERE text IS NOT NULL GROUP BY GROUPING SETS ((lang), ())")
def corpus_stats_rollup(spark, d):
    docs = table(spark, d, "documents").where("text is not null").select("lang", *T.counters(F.col("text")))
    return shards.corpus_rollup(docs, "lang")


@query("SELECT count(*)::BIGINT AS n FROM documents WHERE n_chars BETWEEN 100 AND 10000")
def filtered_count(spark, d):
    return shards.count_texts(table(spark, d, "documents"), chars_col="n_chars", min_chars=100, max_chars=10000)  # bounds of the SQL


@query("WITH s AS (SELECT list_sort(list(n_chars)) AS v, count(*) AS n FROM documents) SELECT n::BIGINT AS n, v[1] AS min, v[n] AS max, " + ", ".join(f"v[least(n * {p} // 100, n - 1) + 1] AS p{p}" for p in (50, 75, 90, 95, 99)) + ", least(pow(2, length(bin(v[least(n * 95 // 100, n - 1) + 1])))::BIGINT, 2048)::BIGINT AS recommended FROM s")
def length_percentiles(spark, d):
    return tokens.length_stats(table(spark, d, "documents"), "n_chars").drop("mean")


@query("WITH b AS (SELECT doc_id, ((row_number() OVER (ORDER BY doc_id) - 1) // 32)::BIGINT AS batch_id FROM documents) SELECT * FROM b QUALIFY count(*) OVER (PARTITION BY batch_id) = 32")
def batch_plan(spark, d):
    return tokens.batches(table(spark, d, "documents").select("doc_id"), order_col="doc_id", drop_last=True)


@query("SELECT turn, length(string_agg(text, '' ORDER BY conv_id))::BIGINT AS chars FROM conversations GROUP BY turn")
def conversation_chars(spark, d):
    return table(spark, d, "conversations").groupBy("turn").agg(F.sum(F.length("text")).cast("long").alias("chars"))


@query(rf"SELECT word, count(*)::BIGINT AS n FROM (SELECT unnest(list_filter(regexp_split_to_array(text, '[{_W}]+'), lambda w: w <> '')) AS word FROM documents) GROUP BY word ORDER BY n DESC, word LIMIT 20")
def top_words(spark, d):
    words = _documents(spark, d).select(F.explode(F.filter(F.split("text", f"[{WS}]+"), lambda w: w != "")).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "word").limit(20)


@query()
def token_metrics(spark, d):
    return tokens.metrics(_documents(spark, d), tokens.default_path())


@query()
def token_top(spark, d):
    return tokens.top_tokens(_documents(spark, d), tokens.default_path())


@query()
def token_lengths(spark, d):
    docs = _documents(spark, d).select(tokens.count_udf(tokens.default_path())(F.col("text")).alias("length"))
    return tokens.length_stats(docs, "length")


@query()
def token_shards(spark, d):
    docs = tokens.batches(table(spark, d, "documents").select("doc_id", "text"), order_col="doc_id", size=256)
    ids = docs.select("doc_id", "batch_id", tokens.encode_udf(tokens.default_path(), max_length=512)(F.col("text")).alias("ids"))
    return tokens.pad(ids, pad_id=50256).select("doc_id", "batch_id", "input_ids", "attention_mask", "length", "padded_length")


@query()
def token_edge_cases(spark, d):
    return tokens.edge_cases(spark, tokens.default_path()).select("name", "n_tokens", "roundtrip_ok")


@query("""WITH b AS (SELECT conv_id, turn, list_transform(range(1, length(text) % 7 + 1), lambda i: i::INTEGER) AS ids FROM conversations),
p AS (SELECT *, max(len(ids)) OVER (PARTITION BY conv_id) - len(ids) AS k FROM b)
SELECT conv_id, turn, array_to_string(list_concat(ids, list_transform(range(k), lambda i: 0)), ',') AS input_ids, array_to_string(list_concat(ids, list_transform(range(k), lambda i: -100)), ',') AS labels FROM p""")
def lm_labels(spark, d):
    n = (F.length("text") % 7).cast("int")
    ids = F.when(n > 0, F.sequence(F.lit(1), F.greatest(n, F.lit(1)))).otherwise(F.array().cast("array<int>"))
    rows = tokens.pad(table(spark, d, "conversations").select("conv_id", "turn", ids.alias("ids")), batch_col="conv_id")
    join = lambda c: F.array_join(F.col(c).cast("array<string>"), ",").alias(c)
    return rows.select("conv_id", "turn", join("input_ids"), join("labels"))


@query("SELECT u, min(event_id) AS first_event FROM (SELECT event_id, sha256(user_id::VARCHAR) AS u FROM events) GROUP BY u")
def seen_set(spark, d):
    events = table(spark, d, "events").select("event_id", F.sha2(F.col("user_id").cast("string"), 256).alias("u"))
    return dedup.drop_seen(events, key="u", order_col="event_id").select("u", F.col("event_id").alias("first_event"))
