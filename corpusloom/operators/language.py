"""Language identification by character trigram profiles (LNG-1..5).

A profile lists a language's trigrams by rank; trigram r of n scores n - r for every occurrence in
the lower-cased first 2,000 characters. Scores are integers, so sums don't depend on any order.
Profiles are a parameter: any table (lang, rank, gram), or built from labelled texts by frequency.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..functions.slices import PART, parts

SAMPLE = 2000
PROFILE = 30


def _sample(text: str | None) -> str:
    return (text or "")[:SAMPLE].lower()


def grams(lows: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed trigrams of lower-cased texts, the text that each belongs to, and its place there."""
    codes = np.frombuffer("".join(lows).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    sizes = np.array([len(x) for x in lows], np.int64)
    if len(codes) < 3:
        return (np.empty(0, np.int64),) * 3
    text = np.repeat(np.arange(len(lows)), sizes)
    pos = np.arange(len(codes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    inside = text[:-2] == text[2:]
    key = codes[:-2] << 42 | codes[1:-1] << 21 | codes[2:]
    return key[inside], text[:-2][inside], pos[:-2][inside]


def packed(lows: list[str]) -> np.ndarray:
    """The packed trigrams alone."""
    codes = np.frombuffer("".join(lows).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    if len(codes) < 3:
        return np.empty(0, np.int64)
    key = codes[:-2] << 42
    key |= codes[1:-1] << 21
    key |= codes[2:]
    inside = np.ones(len(codes), bool)
    ends = np.cumsum([len(x) for x in lows])
    inside[np.maximum(ends - 1, 0)] = inside[np.maximum(ends - 2, 0)] = False
    return key[inside[:-2]]


def _packed(gram: str) -> int:
    a, b, c = map(ord, gram)
    return a << 42 | b << 21 | c


def _spelled(key: int) -> str:
    return chr(key >> 42) + chr(key >> 21 & 0x1FFFFF) + chr(key & 0x1FFFFF)


def build_profiles(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", n: int = PROFILE, sample: int | None = None, most: int = 500_000) -> DataFrame:
    """lang, rank (from 0), gram: the n most frequent trigrams of each language, ties by gram.

    Whole texts count, or, where `sample` is given, so many first characters of each.

    Trigrams are counted in the worker first (at most about `most` distinct ones of a language are held), so that only
    distinct ones are shuffled.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def told(lang: str) -> pa.RecordBatch:
            keys, n = held.pop(lang)
            return pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array([_spelled(k) for k in keys.tolist()], pa.string()), pa.array(n)], names=["lang", "gram", "n"])

        for batch in batches:
            at = 0
            for texts in parts(batch.column(1), 2 * PART):
                langs = batch.column(0).slice(at, len(texts)).to_pylist()
                at += len(texts)
                for lang in sorted(set(langs)):
                    found = pa.array(packed([t.lower() for t, own in zip(texts, langs, strict=True) if own == lang and t])).value_counts()
                    keys, n = held.get(lang, (np.empty(0, np.int64),) * 2)
                    keys, place = np.unique(np.append(keys, found.field(0).to_numpy()), return_inverse=True)
                    held[lang] = keys, np.bincount(place, np.append(n, found.field(1).to_numpy()), len(keys)).astype(np.int64)
                    if len(keys) > most:
                        yield told(lang)
        for lang in sorted(held):
            yield told(lang)

    text = F.col(text_col) if sample is None else F.substring(text_col, 1, sample)
    rows = docs.where(F.col(lang_col).isNotNull()).select(F.col(lang_col).alias("lang"), text.alias("text"))
    counts = rows.mapInArrow(count, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram")) - 1
    return counts.withColumn("rank", rank).where(F.col("rank") < n).select("lang", "rank", "gram")


def profiles_from_json(spark: SparkSession, path: str) -> DataFrame:
    """Profiles from a JSON object {lang: [gram, ...]}; where a gram repeats in a list, the later rank counts."""
    text = "\n".join(r[0] for r in spark.read.text(path).collect())
    rows = {(lang, gram): rank for lang, listed in json.loads(text).items() for rank, gram in enumerate(listed)}
    return spark.createDataFrame([(lang, rank, gram) for (lang, gram), rank in rows.items()], "lang string, rank int, gram string")


def scorer(profiles: DataFrame, text_col: str = "text", n: int = PROFILE, most: int = 200_000) -> Column:
    """struct<language, best, total>: highest score (ties: earliest first match, then name) and the sum of all languages'.

    Confidence is best / total. Texts without a profile gram are 'unknown' with 0 and 0. Scoring is one Arrow
    pass without a shuffle; the profile table (n rows a language, at most `most` rows) goes along with it.
    """
    listed = profiles.select("lang", "rank", "gram").limit(most + 1).collect()
    if len(listed) > most:
        raise ValueError(f"more than {most} profile rows")
    langs = sorted({r["lang"] for r in listed})
    place = {lang: i for i, lang in enumerate(langs)}
    entries = sorted((_packed(r["gram"]), place[r["lang"]], n - r["rank"]) for r in listed if len(r["gram"]) == 3)
    keys, owner, points = (np.array([e[i] for e in entries], np.int64) for i in range(3))

    def many(texts: list[str | None]) -> list[tuple[str, int, int]]:
        got: list[tuple[str, int, int]] = [("unknown", 0, 0)] * len(texts)
        key, text, pos = grams([_sample(x) for x in texts])
        lo, hi = np.searchsorted(keys, key, "left"), np.searchsorted(keys, key, "right")
        n_hits = hi - lo
        if not n_hits.sum():
            return got
        # One row a match: of a text's trigram and a profile's entry.
        row = np.repeat(np.arange(len(key)), n_hits)
        entry = np.arange(len(row)) - np.repeat(np.cumsum(n_hits) - n_hits, n_hits) + np.repeat(lo, n_hits)
        pair, inverse = np.unique(text[row] * len(langs) + owner[entry], return_inverse=True)
        scores = np.bincount(inverse, points[entry]).astype(np.int64)
        first = np.full(len(pair), len(key))
        np.minimum.at(first, inverse, pos[row])
        total = np.bincount(pair // len(langs), scores, minlength=len(texts)).astype(np.int64)
        order = np.lexsort((pair % len(langs), first, -scores, pair // len(langs)))
        best = order[np.unique(pair[order] // len(langs), return_index=True)[1]]
        for i in best:
            at = int(pair[i] // len(langs))
            got[at] = langs[pair[i] % len(langs)], int(scores[i]), int(total[at])
        return got

    @arrow_udf(StructType([StructField("language", StringType()), StructField("best", LongType()), StructField("total", LongType())]))
    def score(text: pa.Array) -> pa.Array:
        rows = [x for at in range(0, len(text), 500) for x in many(text.slice(at, 500).to_pylist())]
        return pa.StructArray.from_arrays([pa.array([x[i] for x in rows], kind) for i, kind in enumerate((pa.string(), pa.int64(), pa.int64()))], ["language", "best", "total"])

    return score(F.substring(text_col, 1, SAMPLE))


def detect(docs: DataFrame, profiles: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", n: int = PROFILE) -> DataFrame:
    """id, language, best, total (see `scorer`)."""
    return docs.select(F.col(id_col).alias("id"), scorer(profiles, text_col, n).alias("x")).select("id", "x.language", "x.best", "x.total")


def with_language(docs: DataFrame, profiles: DataFrame, *, text_col: str = "text", n: int = PROFILE) -> DataFrame:
    """`docs` with language, best and total; no join, no shuffle."""
    scored = docs.withColumn("_x", scorer(profiles, text_col, n))
    return scored.withColumns({c: F.col(f"_x.{c}") for c in ("language", "best", "total")}).drop("_x")


def language_gate(language: Column, best: Column, total: Column, *, min_confidence: float = 0.1, allowed: tuple[str, ...] = ()) -> Column:
    """Confident enough and, if `allowed` names languages, one of these."""
    ok = F.coalesce(F.round(best / F.nullif(total, F.lit(0)), 4), F.lit(0.0)) >= min_confidence
    return ok & language.isin(*allowed) if allowed else ok
