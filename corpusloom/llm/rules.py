"""Op 3, quality rules with risk-controlled thresholds.

Method: every rule compares one signal of a document with a cutoff, and a ladder of ``STEPS``
steps holds cutoffs for all rules, fixed in advance from loose to strict. Labelled documents (label
1: good, 0: bad) that pass the base rules are the holdout, every distinct text one draw. For each stratum (here: language) the good documents that a step would
reject are counted, and the exact binomial (Clopper-Pearson) upper bound of its false rejection
rate is taken. Steps are tested from loose to strict until the first that fails (a fixed sequence,
so a stratum costs one test), and the strata share the error probability ``delta`` equally
(Bonferroni). So with probability 1 - delta at most ``alpha`` of the good distinct texts of every
stratum that pass the base rules are rejected by the cutoffs. The base rules are given, not chosen: what
they reject comes on top and has no such bound. Of the certified steps a stratum takes the one that rejects most documents
labelled bad, and of those the loosest; without bad ones it rejects none.

Scale: signals are computed where the text is read and written as a narrow table; what reaches the
driver are counts per stratum and step, for at most ``max_strata`` strata.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._scratch import materialize
from .neardup import _MULT, _hashes, _mix

_U = np.uint64
#: The symbols that are counted and the white space between words.
SYMBOLS = b"#*$%&|<>"
SPACE = b" \t\n\x0b\x0c\r"

STEPS = 60


def _ladder(loose: float, strict: float) -> tuple[float, ...]:
    """STEPS cutoffs from loose to strict in equal ratios."""
    return tuple(loose * (strict / loose) ** (i / (STEPS - 1)) for i in range(STEPS))


#: Rule: (signal's numerator, denominator, cutoffs from loose to strict). A document whose ratio exceeds the cutoff is rejected.
RULES = {
    "symbols_per_char": ("n_symbols", "word_chars", _ladder(0.6, 0.004)),
    "upper_per_char": ("n_upper", "word_chars", _ladder(0.95, 0.05)),
    "digits_per_char": ("n_digits", "word_chars", _ladder(0.9, 0.05)),
    "marks_per_word": ("n_marks", "n_words", _ladder(3.0, 0.05)),
    "repeats_per_word": ("n_repeat_words", "n_words", _ladder(0.5, 0.05)),
    "dup_lines_per_line": ("n_dup_lines", "n_lines", _ladder(0.9, 0.05)),
    "bars_per_word": ("n_bars", "n_words", _ladder(1.0, 0.02)),
}

SIGNALS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_digits", "n_marks", "n_bars")


def signals(text: str | None) -> tuple[int, ...]:
    """SIGNALS of one whole text; a null text is an empty one."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    b = np.frombuffer(raw, np.uint8)
    counts = np.bincount(b, minlength=256)
    spaces = int(counts[list(SPACE)].sum())
    # Every \n-split line that has a word; a line equal to an earlier one counts as a duplicate.
    lines = [x for x in raw.split(b"\n") if not x.isspace() and x]
    repeat = 0
    if n >= 4:
        h = np.fromiter(map(_hashes.__getitem__, words), _U, n)
        w = _mix(h[:-2] * _MULT[0] + h[1:-1] * _MULT[1] + h[2:] * _MULT[2])
        order = np.argsort(w, kind="stable")
        same = w[order[1:]] == w[order[:-1]]
        hit = np.zeros(n - 2, bool)
        hit[order[1:][same]] = True
        hit[order[:-1][same]] = True
        covered = np.zeros(n, bool)
        covered[:-2] = hit
        covered[1:-1] |= hit
        covered[2:] |= hit
        repeat = int(covered.sum())
    ascii_upper = int(counts[65:91].sum())
    # Two-byte letters of Latin-1 in upper case: C3 and then 80..9E without the multiplication sign.
    at = np.flatnonzero(b[:-1] == 0xC3) if counts[0xC3] else None
    latin = int(((b[at + 1] <= 0x9E) & (b[at + 1] != 0x97)).sum()) if at is not None else 0
    return (n, len(text) - spaces, int(counts[list(SYMBOLS)].sum()), len(lines) - len(set(lines)), repeat, len(lines), ascii_upper + latin, int(counts[48:58].sum()), int(counts[33] + counts[63]), int(counts[124]))


def _signal_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        text = batch.column(batch.num_columns - 1)
        got = np.array([signals(x.as_py()) for x in text], np.int64).reshape(-1, len(SIGNALS))
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *(pa.array(got[:, i]) for i in range(len(SIGNALS)))], names=[*batch.schema.names[:-1], *SIGNALS])


def upper_bound(bad: int, n: int, error: float) -> float:
    """Clopper-Pearson: the largest rate at which `bad` or fewer of `n` have probability `error`."""
    if n == 0 or bad >= n:
        return 1.0
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) for i in range(bad + 1)]
    low, high = bad / n, 1.0
    for _ in range(60):
        p = (low + high) / 2
        tail = sum(math.exp(c + i * math.log(p) + (n - i) * math.log1p(-p)) for i, c in enumerate(logs)) if p < 1 else 0.0
        low, high = (p, high) if tail > error else (low, p)
    return high


def choose_steps(counts: dict, *, alpha: float, delta: float) -> dict:
    """counts: {stratum: (good, bad)}, arrays of STEPS + 1: entry i counts documents that step i and all
    stricter ones reject; the last entry those that none rejects. Returns the step per stratum, or None
    where nothing may be rejected."""
    out = {}
    for stratum, (good, bad) in counts.items():
        n, best, most = int(sum(good)), None, 0
        false = true = 0
        for i in range(STEPS):
            false += int(good[i])
            true += int(bad[i])
            if upper_bound(false, n, delta / len(counts)) > alpha:
                break
            if true > most:
                best, most = i, true
        out[stratum] = best
    return out


def quality_rules(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang", label_id: str = "doc_id", label_col: str = "quality", alpha: float = 0.05, delta: float = 0.05, min_words: int = 50, max_repeat_percent: int = 50, max_strata: int = 1000, rules: dict = RULES) -> DataFrame:
    """One row per row of `docs`: doc_id, SIGNALS, stratum, base_failed, failed_rules (array), kept.

    base_failed: fewer than `min_words` words or more than `max_repeat_percent` % repeated ones. Null
    and empty texts have no words and fail. A null stratum is a stratum of its own; one without
    enough labelled good documents to bound any rejection by `alpha`, or beyond the `max_strata` that have
    most of them (ties by name), has no certified cutoff and its documents fail the base only. Labels other
    than 0 and 1 and those of no row of `docs` are not used; a text counts once a stratum and label, however
    many labels and copies it has. Repeated rows each have their result; an empty table gives no rows. Other
    columns may have any name.
    """
    text = F.col(text_col).cast("string")
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(stratum_col).cast("string").alias("stratum"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    ddl = f"doc_id {docs.schema[id_col].dataType.simpleString()}, stratum string, text_hash long, " + ", ".join(f"{s} long" for s in SIGNALS)
    seen = materialize(narrow.mapInArrow(_signal_rows, ddl), "signals")
    base = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    known = labels.where(F.col(label_col).isin(0, 1)).select(F.col(label_id).alias("doc_id"), F.col(label_col).cast("int").alias("label")).distinct()
    held = seen.where(~base).join(known, "doc_id")

    def ratio(rule: str):
        over, under, _ = rules[rule]
        return F.col(over) / F.greatest(F.col(under), F.lit(1))

    # The first step that rejects a document: per rule the number of cutoffs that it doesn't exceed, the least of these.
    step = lambda rule: F.size(F.filter(F.array(*map(F.lit, rules[rule][2])), lambda c: ratio(rule) <= c))
    held = held.groupBy("stratum", "text_hash", "label").agg(F.min(F.least(*map(step, rules))).alias("step"))
    per = held.groupBy("stratum", "step").agg(F.count_if(F.col("label") == 1).alias("good"), F.count_if(F.col("label") == 0).alias("bad"))
    per = materialize(per, "steps")
    # With fewer good ones even no false rejection at all proves nothing.
    least = math.ceil(math.log(delta) / math.log1p(-alpha))
    large = per.groupBy("stratum").agg(F.sum("good").alias("n")).where(F.col("n") >= least).orderBy(F.desc("n"), "stratum").limit(max_strata)
    chosen = per.alias("p").join(F.broadcast(large).alias("l"), F.col("p.stratum").eqNullSafe(F.col("l.stratum"))).select("p.*")
    counts: dict = {}
    for row in chosen.collect():
        good, bad = counts.setdefault(row["stratum"], (np.zeros(STEPS + 1, int), np.zeros(STEPS + 1, int)))
        good[row["step"]] += row["good"]
        bad[row["step"]] += row["bad"]
    by = {s: {r: rules[r][2][i] for r in rules} for s, i in choose_steps(counts, alpha=alpha, delta=delta).items() if i is not None}
    spark = docs.sparkSession
    # One row a stratum that has cutoffs: at most max_strata.
    table = spark.createDataFrame([(s, x) for s, x in by.items()], "stratum string, cutoffs map<string,double>")
    failed = F.filter(F.array(*[F.when(ratio(r) > F.col("cutoffs")[r], F.lit(r)) for r in rules]), lambda x: x.isNotNull())
    out = seen.alias("d").join(F.broadcast(table).alias("c"), F.col("d.stratum").eqNullSafe(F.col("c.stratum")), "left")
    out = out.select("d.*", base.alias("base_failed"), F.coalesce(failed, F.array().cast("array<string>")).alias("failed_rules"))
    return out.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))


def rules_digest(judged: DataFrame) -> DataFrame:
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
