"""Op 4, secret scans [native]: spans of credentials, judged by corpus-wide ownership frequency.

Method: every candidate value is hashed and the hashes are aggregated over the whole corpus by
distinct repositories and owners. A value that many owners or repositories have is a widely copied
example; one that few have is owner-specific and looks live. Every span carries these counts and its
verdict. The three base kinds (assign, access, hex) are reported whatever the verdict; two kinds are
reported only where it is live, and are looked for in what the base spans leave of the text: a bare
token (20 or more of ``[A-Za-z0-9_-]`` with a letter and a digit) and a key (a run of 20 or more of
``[A-Za-z0-9+/_-]`` and its padding, with a ``+``, ``/`` or ``=``, that has the entropy and the changes
between cases and digits of a random value: base64 credentials; paths and slugs have few).

Everything is DataFrame expressions. Positions come without any UDF: the pieces between the
matches (``split``) and the matches (``regexp_extract_all``) alternate, so running sums of their
lengths are the starts. Running sums go by blocks of about sqrt(n), so n matches cost n^1.5 additions
and no copies of growing arrays; parts of a text are cut from its UTF-32 bytes, where a place needs no
scan. The ownership counts are two partial aggregations (hash and owner, then hash), so a hot value is
reduced before any shuffle; candidates join their verdict by hash, which adaptive execution splits when
one hash is hot. Documents without a candidate take part in no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._scratch import materialize

#: The base kinds in the order in which they are listed, then the added one.
ASSIGN = r"""((?i)password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"
BARE = r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{20,}"
KEY = r"[A-Za-z0-9+/_-]{20,}={0,2}"
KINDS = ("assign", "access", "hex", "bare", "key")
#: A key has at least so many bits of entropy a character, and a change within a word on every so many characters.
KEY_BITS = 3.0
KEY_CHANGE = 8

_SPAN = "struct<start:int,rank:int,end:int,kind:string,value:string>"
_FILL = "\x00"


def _let(value: Column, body) -> Column:
    """body(value), with `value` evaluated once, also where the body uses it within a lambda."""
    return F.transform(F.array(value), body)[0]


def _prefixes(values: Column, op) -> Column:
    """For each of an array of ints, op (sum or maximum, from 0) over all before it."""

    def whole(a: Column) -> Column:
        wide = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(a)))).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), F.ceil(F.size(a) / wide).cast("int") - 1), lambda b: F.slice(a, b * wide + 1, wide))
        return _let(blocks, by_block)

    def by_block(blocks: Column) -> Column:
        def placed(tops: Column) -> Column:
            before = F.transform(tops, lambda _, i: F.aggregate(F.slice(tops, F.lit(1), i), F.lit(0), op))
            inner = lambda start, block: F.transform(block, lambda _, j: op(start, F.aggregate(F.slice(block, F.lit(1), j), F.lit(0), op)))
            return F.flatten(F.zip_with(before, blocks, inner))

        return _let(F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), op)), placed)

    return F.when(F.size(values) > 0, _let(values, whole)).otherwise(F.array().cast("array<int>"))


def _all(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def _spans(text: Column, matches: Column, pattern: str, kind: str) -> Column:
    """Array of spans, from the matches of `pattern` in `text` (code points, end exclusive)."""
    none = F.array().cast(f"array<{_SPAN}>")
    sizes = F.zip_with(F.slice(F.split(text, pattern, -1), 1, F.size(matches)), matches, lambda p, m: F.struct(F.length(p).alias("gap"), F.length(m).alias("own")))

    def placed(both: Column) -> Column:
        before = _prefixes(F.transform(both, lambda x: x["gap"] + x["own"]), lambda a, b: a + b)
        at = F.zip_with(before, both, lambda b, x: F.struct((b + x["gap"]).alias("start"), (b + x["gap"] + x["own"]).alias("end")))
        return F.zip_with(at, matches, lambda x, m: F.struct(x["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), x["end"].alias("end"), F.lit(kind).alias("kind"), m.alias("value")))

    return F.when(F.size(matches) > 0, _let(sizes, placed)).otherwise(none)


def _covered(text: Column, spans: Column, put) -> Column:
    """`text` with put(length, new) for every span (sorted by start): `length` characters from the span's start,
    or from the end of those before it if that is later, `new` only in the first case."""

    def cut(both: Column) -> Column:
        u = both["u"]
        part = lambda lo, hi: F.decode(F.substring(u, 4 * lo + 1, 4 * (hi - lo)), "UTF-32")

        def one(s: Column, done: Column) -> Column:
            return F.when(s["start"] >= done, F.concat(part(done, s["start"]), put(s["end"] - s["start"], True))).when(s["end"] > done, put(s["end"] - done, False)).otherwise(F.lit(""))

        last = F.aggregate(spans, F.lit(0), lambda a, s: F.greatest(a, s["end"]))
        return F.concat(F.array_join(F.zip_with(spans, both["before"], one), ""), part(last, F.length(u).cast("int") / 4))

    before = _prefixes(F.transform(spans, lambda s: s["end"]), lambda a, b: F.greatest(a, b))
    return F.when(F.size(spans) > 0, _let(F.struct(F.encode(text, "UTF-32").alias("u"), before.alias("before")), cut)).otherwise(text)


def _entropy(value: Column) -> Column:
    """Bits a character, by the value's own character counts."""
    n = F.length(value).cast("double")
    share = lambda c: (n - F.length(F.replace(value, c, F.lit("")))) / n
    return F.aggregate(F.array_distinct(F.filter(F.split(value, ""), lambda c: c != "")), F.lit(0.0), lambda acc, c: acc - share(c) * F.log2(share(c)))


def _random_looking(value: Column) -> Column:
    changes = F.regexp_count(value, F.lit("(?<=[a-z])[A-Z0-9]|(?<=[0-9])[A-Za-z]|(?<=[A-Z])[0-9]"))
    return (changes * KEY_CHANGE >= F.length(value)) & (_entropy(value) >= KEY_BITS)


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_secrets(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repo_col: str = "source", min_example_owners: int = 3, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of `docs`: doc_id, base and spans (arrays of struct start, rank, end, kind, value, n_owners,
    n_repos, verdict; by start and then kind) and `row`, a struct of the columns named in `keep`.

    The verdict is 'example' for a value that at least `min_example_owners` distinct owners or repositories
    hold, else 'live'. The value of an assignment is what is assigned. A null owner or repository counts as
    one of its own name. `documents` has a single provenance column, so by default it serves as both. A null
    text is an empty one and has no spans; repeated rows each have their own result; an empty table gives no
    rows. Kept columns lie in a struct and cannot clash with the result's.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    found = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(owner_col).cast("string"), F.lit("\0")).alias("owner"),
        F.coalesce(F.col(repo_col).cast("string"), F.lit("\0")).alias("repo"),
        F.struct(*[F.col(c) for c in keep] or [F.lit(None).cast("string").alias("none")]).alias("row"),
        text.alias("t"),
    )
    base = dict(zip(KINDS[:3], (ASSIGN, ACCESS, HEX), strict=True))
    found = found.select("*", *[_all(F.col("t"), p).alias(k) for k, p in base.items()])
    found = found.select("doc_id", "owner", "repo", "row", "t", *[_spans(F.col("t"), F.col(k), p, k).alias(k) for k, p in base.items()])
    held = F.filter("assign", lambda s: F.length(F.regexp_extract(s["value"], ASSIGN, 2)) >= 6)
    found = found.select("doc_id", "owner", "repo", "row", "t", F.array_sort(F.concat(held, "access", "hex")).alias("base"))
    found = found.select("doc_id", "owner", "repo", "row", "base", _covered(F.col("t"), F.col("base"), lambda n, _: F.repeat(F.lit(_FILL), n)).alias("t"))
    rest = dict(zip(KINDS[3:], (BARE, KEY), strict=True))
    found = found.select("*", *[_all(F.col("t"), p).alias(k) for k, p in rest.items()])
    found = found.select("doc_id", "owner", "repo", "row", "base", *[_spans(F.col("t"), F.col(k), p, k).alias(k) for k, p in rest.items()])
    mixed = lambda s: s["value"].rlike("[0-9]") & s["value"].rlike("[A-Za-z]")
    more = F.concat(F.filter("bare", mixed), F.filter("key", lambda s: mixed(s) & s["value"].rlike("[+/=]") & _random_looking(s["value"])))
    found = materialize(found.select("doc_id", "owner", "repo", "row", F.concat("base", more).alias("all"), F.monotonically_increasing_id().alias("rid")), "secrets")

    some = F.size("all") > 0
    value = F.when(F.col("s.kind") == "assign", F.regexp_extract("s.value", ASSIGN, 2)).otherwise(F.col("s.value"))
    cands = found.where(some).select("rid", "owner", "repo", F.explode("all").alias("s")).withColumn("sha", F.sha2(value, 256))
    judged = cands.select("rid", "s", "sha").join(ownership(cands, "sha", "owner", "repo", min_example_owners), "sha")
    judged = judged.where((F.col("s.rank") < len(base)) | (F.col("verdict") == "live"))
    listed = judged.groupBy("rid").agg(F.array_sort(F.collect_list(F.struct("s.*", "n_owners", "n_repos", "verdict"))).alias("spans"))
    none = F.array().cast(listed.schema["spans"].dataType)
    joined = found.where(some).join(listed, "rid", "left").select("doc_id", "row", F.coalesce("spans", none).alias("spans"))
    out = found.where(~some).select("doc_id", "row", none.alias("spans")).unionByName(joined)
    return out.select("doc_id", "row", F.filter("spans", lambda s: s["rank"] < len(base)).alias("base"), "spans")


def ownership(cands: DataFrame, sha: str, owner: str, repo: str, min_example_owners: int = 3) -> DataFrame:
    """Per candidate hash: n_owners, n_repos (distinct), n (occurrences) and verdict."""
    once = cands.groupBy(sha, owner, repo).agg(F.count("*").alias("n"))
    stats = once.groupBy(sha).agg(F.countDistinct(owner).alias("n_owners"), F.countDistinct(repo).alias("n_repos"), F.sum("n").alias("n"))
    wide = (F.col("n_owners") >= min_example_owners) | (F.col("n_repos") >= min_example_owners)
    return stats.withColumn("verdict", F.when(wide, "example").otherwise("live"))


def verdicts(found: DataFrame) -> DataFrame:
    """Report over `find_secrets(...)`: per hash of a span's value n_owners, n_repos, n (spans) and verdict."""
    cands = found.select(F.explode("spans").alias("s"))
    value = F.when(F.col("s.kind") == "assign", F.regexp_extract("s.value", ASSIGN, 2)).otherwise(F.col("s.value"))
    return cands.groupBy(F.sha2(value, 256).alias("sha")).agg(F.first("s.n_owners").alias("n_owners"), F.first("s.n_repos").alias("n_repos"), F.count("*").alias("n"), F.first("s.verdict").alias("verdict"))


def redacted(text: Column, spans: Column, mark: str = "[SECRET]", only: str | None = "live") -> Column:
    """`text` with every span of the verdict `only` (None: every one) replaced by `mark`; spans come sorted by start,
    and overlapping ones count as one."""
    chosen = spans if only is None else F.filter(spans, lambda s: s["verdict"] == only)
    return _covered(text, chosen, lambda n, new: F.lit(mark if new else ""))


def secrets_digest(found: DataFrame) -> DataFrame:
    """Counts per base kind, the digest of the base spans, and all spans, their owner counts and verdicts as text."""
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    each = lambda name: F.array_join(F.transform("spans", lambda s: s[name].cast("string")), ",")
    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(_listed(F.col("base")), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"), each("n_owners").alias("owners"), each("n_repos").alias("repos"), each("verdict").alias("verdicts"))


_DUCK = {"assign": r"""(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""", "access": ACCESS, "hex": "[0-9a-f]{24,}", "bare": "[A-Za-z0-9_-]{20,}", "key": KEY}

_FOUND = "\nUNION ALL\n".join(
    f"""SELECT rid, owner, {i} AS rank, '{k}' AS kind, unnest(pieces) AS piece, unnest(list_concat(matches, [''])) AS match, generate_subscripts(pieces, 1) AS i
FROM (SELECT rid, owner, string_split_regex(t, '{p}') AS pieces, regexp_extract_all(t, '{p}') AS matches FROM docs WHERE regexp_matches(t, '{p}'))"""
    for i, (k, p) in enumerate(_DUCK.items())
)

# Runs of the two added kinds are found in the whole text here and then cut at the base spans.
ORACLE_SQL = rf"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, coalesce(source, chr(1)) AS owner FROM documents),
found AS ({_FOUND}),
placed AS (
  SELECT *, sum(length(piece) + length(match)) OVER (PARTITION BY rid, kind ORDER BY i) AS e FROM found),
runs AS (
  SELECT rid, owner, rank, kind, match, (e - length(match))::BIGINT AS s, e::BIGINT AS e FROM placed
  WHERE match <> '' AND (kind <> 'assign' OR length(regexp_extract(match, '{_DUCK["assign"]}', 1)) >= 6)),
base AS (SELECT * FROM runs WHERE rank < 3),
edges AS (
  SELECT rid, owner, rank, kind, match, s AS s0, s, s AS upto, e FROM runs WHERE rank > 2
  UNION ALL SELECT r.rid, r.owner, r.rank, r.kind, r.match, r.s, b.s, b.e, r.e FROM runs r JOIN base b ON r.rid = b.rid AND r.rank > 2 AND b.s < r.e AND r.s < b.e),
gaps AS (
  SELECT rid, owner, rank, kind, match, s0, max(upto) OVER w AS s, least(coalesce(lead(s) OVER w, e), e) AS e
  FROM edges WINDOW w AS (PARTITION BY rid, rank, s0 ORDER BY s, upto ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
parts AS (
  SELECT rid, owner, rank, kind, regexp_extract(substr(match, (s - s0 + 1)::BIGINT, (e - s)::BIGINT), CASE kind WHEN 'key' THEN '{KEY}' ELSE '{_DUCK["bare"]}' END) AS match, s FROM gaps WHERE e - s >= 20),
added AS (
  SELECT rid, owner, rank, kind, match, s, s + length(match) AS e FROM parts
  WHERE regexp_matches(match, '[0-9]') AND regexp_matches(match, '[A-Za-z]') AND (kind = 'bare' OR (regexp_matches(match, '[+/=]')
    AND 8 * len(list_filter(range(1, length(match)), lambda i: regexp_matches(substr(match, i, 2), '[a-z][A-Z0-9]|[0-9][A-Za-z]|[A-Z][0-9]'))) >= length(match)
    AND list_sum(list_transform(list_distinct(string_split(match, '')), lambda c: -len(list_filter(string_split(match, ''), lambda x: x = c)) / length(match) * log2(len(list_filter(string_split(match, ''), lambda x: x = c)) / length(match)))) >= 3))),
every_one AS (
  SELECT *, CASE kind WHEN 'assign' THEN regexp_extract(match, '{_DUCK["assign"]}', 1) ELSE match END AS value FROM (SELECT rid, owner, rank, kind, match, s, e FROM base UNION ALL SELECT rid, owner, rank, kind, match, s, e FROM added)),
owned AS (SELECT value, count(DISTINCT owner) AS n FROM every_one GROUP BY value),
judged AS (SELECT x.*, o.n, CASE WHEN o.n >= 3 THEN 'example' ELSE 'live' END AS verdict FROM every_one x JOIN owned o USING (value)),
listed AS (
  SELECT rid, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
    coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) FILTER (rank < 3), '') AS base_listed,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) AS spans, string_agg(n::VARCHAR, ',' ORDER BY s, rank) AS owners, string_agg(verdict, ',' ORDER BY s, rank) AS verdicts
  FROM judged WHERE rank < 3 OR verdict = 'live' GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
  sha256(coalesce(base_listed, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(owners, '') AS owners, coalesce(owners, '') AS repos, coalesce(verdicts, '') AS verdicts
FROM docs LEFT JOIN listed USING (rid)
"""
