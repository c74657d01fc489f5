"""Op 9, language ID: a linear-chain CRF labels every word of a text, code-switched or not.

Method: a word's features are its affixes (first and last 1 to 3 letters), its letter 1- to 3-grams
and its lexicon entry (the word itself), all hashed into one table of weights per language;
transitions between languages are learned. Chains are a line's words, or `CHAIN` words of a longer
line, so that every word of the text takes part. Forward-backward gives each word's language
marginals, and a document's language has the largest sum of them, weighted by word length.

Training texts are monolingual; chains for training join stretches of lines of different languages,
so that switches have a finite cost.

Fitted on at most ``per_lang`` documents of each of the ``max_langs`` most frequent languages, of at
most ``max_text`` characters each, drawn by a hash of the id. Features of a batch's distinct words are
computed together, from their letters as one matrix; a text's result depends on nothing but the text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .crf import Adam, forward_backward

TABLE = 1 << 16
CHAIN = 256
WIDE = 24  # longer words are looked at in pieces of so many letters
UNKNOWN = "und"

_word = re.compile(r"[^\W\d_]+")


def chains(texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words, word number of each position, lengths of the chains, positions per text."""
    numbers: dict[str, int] = {}
    flat: list[int] = []
    lengths: list[int] = []
    per_text = np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        begin = len(flat)
        for line in (text or "").lower().split("\n"):
            words = _word.findall(line)
            if not words:
                continue
            flat += [numbers.setdefault(w, len(numbers)) for w in words]
            n = len(words)
            while n > CHAIN:
                lengths.append(CHAIN)
                n -= CHAIN
            lengths.append(n)
        per_text[i] = len(flat) - begin
    return list(numbers), np.array(flat, np.int64), np.array(lengths, np.int64), per_text


def _hash(*parts: np.ndarray | int) -> np.ndarray:
    h = np.uint32(0x811C9DC5)
    for p in parts:
        h = (h ^ np.asarray(p, np.uint32)) * np.uint32(0x01000193)
        h = h ^ (h >> np.uint32(15))
    return ((h * np.uint32(0x85EBCA6B)) >> np.uint32(16)).astype(np.int64)


def word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers and the word that each belongs to. Every letter of every word takes part."""
    with np.errstate(over="ignore"):
        pieces, owner = words, np.arange(len(words))
        if any(len(w) > WIDE for w in words):
            pieces, owner = [], []
            for i, w in enumerate(words):
                for at in range(0, len(w), WIDE - 2):  # two letters of overlap: no n-gram is lost
                    if at == 0 or at + 2 < len(w):
                        pieces.append(w[at : at + WIDE])
                        owner.append(i)
            owner = np.array(owner)
        grid = np.array(pieces, dtype=f"U{WIDE}")
        c = grid.view(np.uint32).reshape(len(pieces), WIDE)
        size = (c != 0).sum(axis=1)
        out, whose = [], []

        def add(h: np.ndarray, at: np.ndarray) -> None:
            out.append(h)
            whose.append(at)

        width = int(size.max()) if len(size) else 0
        for j in range(width):
            for n in (1, 2, 3):
                at = np.flatnonzero(size >= j + n)
                if len(at):
                    add(_hash(n, *(c[at, j + k] for k in range(n))), owner[at])
        first = np.flatnonzero(np.diff(owner, prepend=-1) != 0)
        last = np.append(first[1:] - 1, len(owner) - 1) if len(first) else first
        for n in (1, 2, 3):
            at = first[size[first] >= n]
            if len(at):
                add(_hash(10 + n, *(c[at, k] for k in range(n))), owner[at])
            at = last[size[last] >= n]
            if len(at):
                add(_hash(20 + n, *(c[at, size[at] - n + k] for k in range(n))), owner[at])
        # The lexicon entry: each word's own hash, whatever words lie beside it.
        whole = np.fromiter((xxhash.xxh32_intdigest(w.encode("utf-8", "surrogatepass")) for w in words), np.uint32, len(words))
        add(_hash(30, whole), np.arange(len(words)))
    return np.concatenate(out), np.concatenate(whose)


def word_scores(words: list[str], w: np.ndarray) -> np.ndarray:
    """[words, languages]: summed weights of each word's features, over the root of their number."""
    if not words:
        return np.zeros((0, w.shape[1]))
    f, whose = word_features(words)
    n = np.bincount(whose, minlength=len(words))
    return np.stack([np.bincount(whose, w[f, s], minlength=len(words)) for s in range(w.shape[1])], axis=1) / np.sqrt(n)[:, None]


def fit(texts: list[str], langs: list[str], *, epochs: int = 25, rate: float = 0.15, max_words: int = 150_000) -> dict:
    """CRF weights by full-batch Adam. Of the texts' lines, in turn over the languages, at most `max_words` words are used."""
    names = sorted(set(langs))
    if len(names) < 2:
        return {"langs": names, "w": np.zeros((TABLE, max(1, len(names)))), "trans": np.zeros((max(1, len(names)),) * 2)}
    queues = {n: [x for t, lang in zip(texts, langs, strict=True) if lang == n for x in t.split("\n") if x.strip()] for n in names}
    joined: list[str] = []
    labels: list[int] = []
    rng = np.random.default_rng(11)
    words_used, at = 0, dict.fromkeys(names, 0)
    while words_used < max_words and any(at[n] < len(queues[n]) for n in names):
        chain: list[str] = []
        # A training chain: stretches of up to 12 words from one, often two or three languages.
        for n in rng.permutation(len(names))[: int(rng.integers(1, min(4, len(names) + 1)))]:
            name = names[n]
            if at[name] < len(queues[name]):
                got = _word.findall(queues[name][at[name]].lower())
                at[name] += 1
                chain += got
                labels += [int(n)] * len(got)
        if chain:
            joined.append(" ".join(chain))
            words_used += len(chain)
    words, flat, lengths, _ = chains(joined)
    y = np.array(labels)
    f, whose = word_features(words)
    norm = 1 / np.sqrt(np.bincount(whose, minlength=len(words)))
    w, trans = np.zeros((TABLE, len(names))), np.zeros((len(names), len(names)))
    once = np.eye(len(names))[y]
    inner = np.ones(len(y), bool)
    inner[np.concatenate([[0], np.cumsum(lengths)[:-1]])] = False
    seen = np.zeros_like(trans)
    b = np.flatnonzero(inner)
    np.add.at(seen, (y[b - 1], y[b]), 1)
    opt = Adam([w, trans], rate)
    for _ in range(epochs):
        scores = np.stack([np.bincount(whose, w[f, s], minlength=len(words)) for s in range(len(names))], axis=1) * norm[:, None]
        p, joint = forward_backward(scores[flat], lengths, trans, pairs=True)
        gap = np.stack([np.bincount(flat, (p - once)[:, s], minlength=len(words)) for s in range(len(names))], axis=1) * norm[:, None]
        g = np.stack([np.bincount(f, gap[whose, s], minlength=TABLE) for s in range(len(names))], axis=1)
        opt.step([g / len(y) + 1e-7 * w, (joint - seen) / len(y)])
    return {"langs": names, "w": w.astype(np.float32), "trans": trans}


def predict(texts: list[str | None], model: dict, marginals: bool = False):
    """Language and score per text; with `marginals`, also words, word numbers, word marginals and words per text."""
    names = model["langs"]
    words, flat, lengths, per_text = chains(texts)
    size = np.array([len(w) for w in words], np.float64)
    alpha = np.array([any(map(str.isalpha, w)) for w in words], bool)
    if not names or not len(flat):
        got = [(UNKNOWN, 0.0)] * len(texts)
        return (got, words, flat, np.zeros((len(flat), len(names))), per_text) if marginals else got
    p = forward_backward(word_scores(words, model["w"])[flat], lengths, model["trans"])
    weight = (size * alpha)[flat]
    text_of = np.repeat(np.arange(len(texts)), per_text)
    total = np.stack([np.bincount(text_of, p[:, s] * weight, minlength=len(texts)) for s in range(len(names))], axis=1)
    whole = total.sum(axis=1)
    best = total.argmax(axis=1)
    got = [(names[b], float(min(1.0, t[b] / n))) if n > 0 else (UNKNOWN, 0.0) for b, t, n in zip(best, total, whole, strict=True)]
    return (got, words, flat, p, per_text) if marginals else got


def train(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", usable=None, per_lang: int = 150, max_langs: int = 200, max_text: int = 200_000, seed: int = 5) -> dict:
    """Model from at most `per_lang` documents of each of the `max_langs` most frequent languages (ties by name).

    Documents are drawn by a hash of the id among those of at most `max_text` characters, so that what is
    fetched has a bound; `usable` filters ids. Rows that repeat an id in a language count as one, of the
    smallest text. Null ids, texts and languages aren't learned from. An empty table gives a model that
    knows no language.
    """
    known = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    known = known.where(F.length("text") <= max_text)
    if usable is not None:
        known = known.where(usable(F.col("doc_id")))
    # At most `max_langs` rows; a language's share is what leaves about 1.3 times per_lang documents.
    sizes = known.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(max_langs)
    h = F.xxhash64("doc_id", F.lit(seed))
    drawn = known.join(F.broadcast(sizes), "lang").where(F.pmod(h, F.lit(1_000_000)) < F.ceil(1_000_000 * F.least(F.lit(1.0), F.lit(1.3 * per_lang) / F.col("n"))))
    once = drawn.groupBy("lang", h.alias("h")).agg(F.min("text").alias("text"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    rows = once.withColumn("rank", rank).where(F.col("rank") <= per_lang).collect()
    rows.sort(key=lambda r: (r["lang"], r["h"]))
    return fit([r["text"] for r in rows], [r["lang"] for r in rows])


def identify(docs: DataFrame, model: dict, *, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns in `keep`, lang_pred and score, one row per row of `docs`.

    A null text and one without a letter are 'und' with score 0; so is any text if nothing was learned.
    Of languages with equal sums the first by name is taken; repeated rows each have their result, and
    equal texts equal ones; an empty table gives no rows. Other columns of `docs` may have any name; of
    `keep`, one that is named like a result column gives way to it.
    """
    from pyspark.sql.types import DoubleType, StringType, StructField, StructType

    keep = tuple(c for c in keep if c not in ("lang_pred", "score"))
    picked = docs.select(*[F.col(c) for c in keep], F.col(text_col).cast("string").alias("__text"))
    schema = StructType([*picked.schema.fields[:-1], StructField("lang_pred", StringType()), StructField("score", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                got = predict(batch.column(batch.num_columns - 1).to_pylist(), model)
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())], names=[*keep, "lang_pred", "score"])

    return picked.mapInArrow(run, schema)


def langid_digest(docs: DataFrame) -> DataFrame:
    """Predictions for all `docs`; documents whose id has the remainder 2 modulo 4 are held out of training."""
    from .quality import remainder

    model = train(docs, usable=lambda c: remainder(c, 4) != 2)
    out = identify(docs, model)
    return out.select("doc_id", (F.coalesce(remainder(F.col("doc_id"), 4), F.lit(-1)) == 2).alias("held_out"), "lang_pred", "score")
