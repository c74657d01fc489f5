"""Heuristic quality score (QLT-1..10): a weighted mean of six sub-scores, built-in expressions over measures of one Arrow pass."""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import LongType, StructField, StructType

from ..functions.slices import mapped

#: Fixed value: characters that start a bullet line if white space follows.
BULLETS = frozenset("-•*·▪▸►◦‣⁃")
MEASURES = ("n_chars", "n_words", "n_alpha", "n_upper", "n_digits", "n_space", "n_unique", "n_lines", "n_bullets")


@dataclass(frozen=True)
class QualityConfig:
    min_score: float = 0.5
    min_words: int = 20
    max_symbol_ratio: float = 0.15
    max_digit_ratio: float = 0.30
    max_uppercase_ratio: float = 0.25
    min_avg_word_len: float = 3
    max_avg_word_len: float = 12
    min_unique_word_ratio: float = 0.20
    #: symbol, digit, uppercase, word length, unique words, bullets
    weights: tuple[float, ...] = (1.0, 1.0, 1.0, 1.0, 1.0, 1.0)

    def __post_init__(self):
        if not 0 <= self.min_score <= 1 or self.min_words < 0 or self.min_avg_word_len > self.max_avg_word_len:
            raise ValueError("quality thresholds out of range")
        if min(self.max_symbol_ratio, self.max_digit_ratio, self.max_uppercase_ratio, self.min_unique_word_ratio) <= 0:
            raise ValueError("quality ratios must be positive")
        if len(self.weights) != 6 or min(self.weights) < 0:
            raise ValueError("six weights of at least 0 are needed")


@cache
def _kinds() -> np.ndarray:
    """Of every code point: 1 letter, 2 upper-case letter, 4 decimal digit, 8 white space."""
    bits = {"Lu": 3, "Ll": 1, "Lt": 1, "Lm": 1, "Lo": 1, "Nd": 4}
    table = np.array([bits.get(unicodedata.category(chr(i)), 0) for i in range(0x110000)], np.uint8)
    table[[i for i in range(0x3001) if chr(i).isspace()]] |= 8
    return table


def measured(texts: list[str | None]) -> pa.Array:
    """A struct of MEASURES a text; null for a null text."""
    known = [x or "" for x in texts]
    kinds = _kinds()[np.frombuffer("".join(known).encode("utf-32-le", "surrogatepass"), np.uint32)]
    sizes = np.array([len(x) for x in known], np.int64)
    ends = np.cumsum(sizes)
    by_kind = []
    for bit in (1, 2, 4, 8):
        upto = np.append(0, np.cumsum(kinds & bit > 0, dtype=np.int64))
        by_kind.append(upto[ends] - upto[ends - sizes])
    # str.split(), splitlines() and strip() go by the classes WS and, for ends of lines, EOL with \r\v\f\x1c-\x1e.
    words, unique, n_lines, bullets = [], [], [], []
    for x in known:
        words.append(len(x.split()))
        unique.append(len(set(x.lower().split())))
        lines = [y for y in map(str.lstrip, x.splitlines()) if y]
        n_lines.append(len(lines))
        bullets.append(sum(y[0] in BULLETS and y[1:2].isspace() for y in lines))
    columns = [sizes, words, *by_kind, unique, n_lines, bullets]
    return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], MEASURES, mask=pa.array([x is None for x in texts]))


@arrow_udf(StructType([StructField(n, LongType()) for n in MEASURES]))
def _measures(text: pa.Array) -> pa.Array:
    return mapped(text, measured, pa.struct([(n, pa.int64()) for n in MEASURES]))


def counts(text: Column) -> dict[str, Column]:
    """Integer measures that the sub-scores derive from: one Arrow pass (a regular expression for each took 40 times as long)."""
    found = _measures(text)
    return {n: found.getField(n) for n in MEASURES}


def score(config: QualityConfig = QualityConfig()) -> Column:
    """Score in [0, 1] from the columns of `counts`; 0 without a word."""
    c = F.col
    one = F.lit(1.0)
    n = F.greatest(c("n_chars"), F.lit(1))
    ratio = lambda over, under, most: one - F.least(over / under / F.lit(most), one) * 0.5
    symbols = c("n_chars") - c("n_alpha") - c("n_digits") - c("n_space")
    mean_word = (c("n_chars") - c("n_space")) / F.greatest(c("n_words"), F.lit(1))
    parts = [
        (F.lit(True), ratio(symbols, n, config.max_symbol_ratio)),
        (F.lit(True), ratio(c("n_digits"), n, config.max_digit_ratio)),
        (c("n_alpha") > 0, ratio(c("n_upper"), F.greatest(c("n_alpha"), F.lit(1)), config.max_uppercase_ratio)),
        (F.lit(True), F.when(mean_word.between(config.min_avg_word_len, config.max_avg_word_len), 1.0).otherwise(0.5)),
        (F.lit(True), F.least(c("n_unique") / F.greatest(c("n_words"), F.lit(1)) / F.lit(config.min_unique_word_ratio), one)),
        (c("n_lines") > 0, one - F.least(c("n_bullets") / F.greatest(c("n_lines"), F.lit(1)) * 2, one) * 0.4),
    ]
    top = sum((F.when(on, w * x).otherwise(0.0) for (on, x), w in zip(parts, config.weights, strict=True)), F.lit(0.0))
    under = sum((F.when(on, F.lit(w)).otherwise(0.0) for (on, _), w in zip(parts, config.weights, strict=True)), F.lit(0.0))
    return F.when((c("n_words") > 0) & (under > 0), F.round(F.least(F.greatest(top / under, F.lit(0.0)), one), 4)).otherwise(0.0)


def gate(config: QualityConfig = QualityConfig()) -> Column:
    return (F.col("n_words") >= config.min_words) & (F.col("quality_score") >= config.min_score)
