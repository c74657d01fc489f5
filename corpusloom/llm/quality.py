"""Op 7, quality classifier: a linear-chain CRF labels every line good or bad.

Method: a line is described by binned signals of itself and of its two neighbours; transitions are
learned. Forward-backward gives each line's probability of being good, and a document's score is
the mean of these, weighted by the lines' lengths (at least 1 each, so that empty texts have a
score).

Only documents are labelled, so the lines' labels are latent and found by rounds of posterior
regularization. A first model judges lines one by one. In every round each document's line
probabilities are moved, all by one shift of their log-odds and only as far as needed, until their
weighted mean is at least `GOOD_LEAST` for a good document and at most `BAD_MOST` for a bad one; the
CRF then learns from these probabilities. So a bad document keeps good lines, a good one bad ones,
and transitions see both.

Fitted on at most ``max_train`` labelled documents a label, of at most ``max_text`` characters each,
drawn by a hash of the id; every document is scored. Signals come from byte counts over a whole batch
of texts at once, never line by line.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .crf import Adam, forward_backward

BINS = 9
QUANTILES = (0.1, 0.3, 0.5, 0.7, 0.85, 0.95, 0.99)
#: Bounds of the mean line probability of a labelled document, weighted by length.
GOOD_LEAST, BAD_MOST = 0.8, 0.3
#: Names of the signals of a line; each is a ratio or a size, cut at the quantiles of the training lines.
SIGNALS = ("bytes", "words", "letters", "upper", "digits", "symbols", "bars", "marks", "stops", "high", "mean_word", "dup", "again")


def _classes() -> np.ndarray:
    table = np.zeros((8, 256), np.uint8)
    table[0, list(range(65, 91)) + list(range(97, 123)) + list(range(192, 256))] = 1  # letters (a lead byte stands for one)
    table[1, 65:91] = 1
    table[2, 48:58] = 1
    table[3, list(b"#*$%&<>@^~_=+\\{}[]")] = 1
    table[4, list(b"|")] = 1
    table[5, list(b"!?")] = 1
    table[6, list(b".,;:")] = 1
    table[7, 128:] = 1
    return table


_TABLE = _classes()
_SPACE = np.zeros(256, bool)
_SPACE[list(b" \t\n\x0b\x0c\r")] = True


def line_signals(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Signals [lines, len(SIGNALS)], bytes of each line, and lines per text (at least 1)."""
    raws = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    b = np.frombuffer(b"\n".join(raws) + b"\n", np.uint8)
    ends = np.flatnonzero(b == 10)
    starts = np.concatenate([[0], ends[:-1] + 1])
    size = (ends - starts).astype(np.float64)
    per_text = np.array([r.count(b"\n") + 1 for r in raws])

    def per_line(mask: np.ndarray) -> np.ndarray:
        return np.add.reduceat(mask, starts, dtype=np.int32).astype(np.float64)

    counts = [per_line(_TABLE[i][b]) for i in range(len(_TABLE))]
    # Upper case of Latin-1 letters: lead byte C3, then 80..9E.
    lead = np.zeros(len(b), np.uint8)
    lead[1:] = (b[:-1] == 0xC3) & (b[1:] >= 0x80) & (b[1:] <= 0x9E)
    counts[1] += per_line(lead)
    space = _SPACE[b]
    first = ~space
    first[1:] &= space[:-1]
    words = per_line(first.view(np.uint8))
    chars = np.maximum(size, 1)
    letters = np.maximum(counts[0], 1)
    dup, again = np.zeros(len(ends)), np.zeros(len(ends))
    at = 0
    for raw, n in zip(raws, per_text, strict=True):
        seen: set[bytes] = set()
        for i, line in enumerate(raw.split(b"\n"), at):
            again[i] = len(set(line.split()))
            if line in seen:
                dup[i] = 1.0
            elif line:
                seen.add(line)
        at += n
    w = np.maximum(words, 1)
    cols = [size, words, counts[0] / chars, counts[1] / letters, counts[2] / chars, counts[3] / w, counts[4] / w, counts[5] / w, counts[6] / w, counts[7] / chars, size / w, dup, 1 - again / w]
    return np.stack(cols, axis=1), size, per_text


def cut_points(x: np.ndarray) -> np.ndarray:
    """[signals, BINS - 1] quantiles of the non-zero values; the first bin is for values up to 0."""
    out = np.full((x.shape[1], BINS - 1), np.inf)
    out[:, 0] = 0
    for j in range(x.shape[1]):
        pos = x[x[:, j] > 0, j]
        if len(pos):
            out[j, 1:] = np.quantile(pos, QUANTILES)
    return out


def features(x: np.ndarray, cuts: np.ndarray, per_text: np.ndarray) -> np.ndarray:
    """Feature numbers [lines, 3 * signals]: a line's own bins, then its neighbours' (or 'none')."""
    own = np.stack([np.searchsorted(cuts[j], x[:, j], side="left") for j in range(x.shape[1])], axis=1)
    first = np.zeros(len(x), bool)
    first[np.cumsum(per_text)[:-1]] = True
    first[0] = True
    last = np.roll(first, -1)
    before, after = np.roll(own, 1, axis=0), np.roll(own, -1, axis=0)
    before[first], after[last] = BINS, BINS
    width = BINS + 1
    base = np.arange(own.shape[1]) * width
    step = own.shape[1] * width
    return np.concatenate([own + base, before + base + step, after + base + 2 * step], axis=1)


def shifted(p: np.ndarray, weight: np.ndarray, per_text: np.ndarray, good: np.ndarray) -> np.ndarray:
    """Line probabilities `p`, each text's moved by one shift of their log-odds, if need be, until their weighted
    mean is at least GOOD_LEAST (good texts) or at most BAD_MOST (the others)."""
    at = np.concatenate([[0], np.cumsum(per_text)[:-1]])
    odds = np.log(np.clip(p, 1e-6, 1 - 1e-6)) - np.log1p(-np.clip(p, 1e-6, 1 - 1e-6))
    whole = np.add.reduceat(weight, at)

    def mean(shift: np.ndarray) -> np.ndarray:
        return np.add.reduceat(weight / (1 + np.exp(-(odds + np.repeat(shift, per_text)))), at) / whole

    now, aim = mean(np.zeros(len(at))), np.where(good == 1, GOOD_LEAST, BAD_MOST)
    needed = np.where(good == 1, now < aim, now > aim)
    low, high = np.where(good == 1, 0.0, -30.0), np.where(good == 1, 30.0, 0.0)
    for _ in range(40):
        mid = (low + high) / 2
        above = mean(mid) > aim
        low, high = np.where(above, low, mid), np.where(above, mid, high)
    shift = np.where(needed, (low + high) / 2, 0.0)
    return 1 / (1 + np.exp(-(odds + np.repeat(shift, per_text))))


def fit(texts: list[str], good: np.ndarray, *, rounds: int = 4, epochs: int = 40, rate: float = 0.08, l2: float = 1.0, good_share: float = 0.75) -> dict:
    """CRF weights from whole texts and their labels; full-batch Adam on the log-likelihood per text."""
    x, size, per_text = line_signals(texts)
    cuts = cut_points(x)
    f = features(x, cuts, per_text)
    y = np.repeat(good.astype(float), per_text)
    n_own = x.shape[1]
    w, bias, trans = np.zeros(int(f.max()) + 1 + 3 * (BINS + 1)), np.zeros(1), np.zeros((2, 2))
    # Each text counts once, its lines by their length; a label's texts weigh `good_share` or the rest together.
    share = np.where(good == 1, good_share / max(1, (good == 1).sum()), (1 - good_share) / max(1, (good == 0).sum()))
    length = np.maximum(size, 1)
    at = np.concatenate([[0], np.cumsum(per_text)[:-1]])
    weight = np.repeat(share / per_text, per_text)
    inner = np.ones(len(y), bool)
    inner[at] = False
    second = np.flatnonzero(inner)

    def learn(q: np.ndarray, columns: np.ndarray, chains: np.ndarray) -> None:
        """`epochs` steps towards line probabilities `q`, by the features in `columns`."""
        soft = np.stack([1 - q, q], axis=1)
        seen = (soft[second - 1] * weight[second, None]).T @ soft[second] if len(chains) < len(q) else trans * 0
        opt = Adam([w, bias, trans], rate)
        for _ in range(epochs):
            gap = w[columns].sum(axis=1) + bias[0]
            p, joint = forward_backward(np.stack([-gap / 2, gap / 2], axis=1), chains, trans, pairs=True, weight=weight)
            g = (p[:, 1] - q) * weight
            opt.step([np.bincount(columns.ravel(), np.repeat(g, columns.shape[1]), minlength=len(w)) + l2 * 1e-4 * w, np.array([g.sum()]), joint - seen + l2 * 1e-3 * trans])

    # Line by line first: own signals, no neighbours, no transitions.
    learn(y, f[:, :n_own], np.ones(len(y), np.int64))
    model = {"w": w, "bias": 0.0, "trans": trans, "cuts": cuts}
    for i in range(rounds):
        columns, chains = (f[:, :n_own], np.ones(len(y), np.int64)) if i == 0 else (f, per_text)
        gap = w[columns].sum(axis=1) + bias[0]
        p = forward_backward(np.stack([-gap / 2, gap / 2], axis=1), chains, trans)[:, 1]
        learn(shifted(p, length, per_text, good), f, per_text)
    model["bias"] = float(bias[0])
    return model


def line_marginals(texts: list[str | None], model: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Probability of being good of every line, the lines' bytes, and lines per text."""
    x, size, per_text = line_signals(texts)
    f = features(x, model["cuts"], per_text)
    gap = model["w"][np.minimum(f, len(model["w"]) - 1)].sum(axis=1) + model["bias"]
    return forward_backward(np.stack([-gap / 2, gap / 2], axis=1), per_text, model["trans"])[:, 1], size, per_text


def score(texts: list[str | None], model: dict) -> np.ndarray:
    """Probability in [0, 1] of being good, per text."""
    if not texts:
        return np.empty(0)
    p, size, per_text = line_marginals(texts, model)
    weight = np.maximum(size, 1)
    at = np.concatenate([[0], np.cumsum(per_text)[:-1]])
    return np.clip(np.add.reduceat(p * weight, at) / np.add.reduceat(weight, at), 0, 1)


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id", label_col: str = "quality", usable=None, max_train: int = 1500, max_text: int = 200_000, seed: int = 7) -> dict:
    """Model from at most `max_train` documents a label, drawn by a hash of the id; `usable` filters ids.

    Labels other than 0 and 1 and null ids aren't used; an id of both labels is none of either's; of documents
    that share an id the one of the smallest text counts, a null text as an empty one. Drawn documents of over
    `max_text` characters are left out, so that what is fetched has a bound. Without documents of both labels
    the model is neutral: every score is 0.5.
    """
    neutral = {"w": np.zeros(1), "bias": 0.0, "trans": np.zeros((2, 2)), "cuts": np.zeros((len(SIGNALS), BINS - 1))}
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(label_id).isNotNull()).groupBy(F.col(label_id).alias("doc_id")).agg(F.min(label_col).cast("int").alias("y"), F.max(label_col).cast("int").alias("z")).where("y = z").drop("z")
    if usable is not None:
        known = known.where(usable(F.col("doc_id")))
    sizes = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    if len(sizes) < 2:
        return neutral
    # About max_train of a label's rows are drawn, never over 1.5 times that; the cut below makes it exact.
    keep, h = F.lit(False), F.xxhash64("doc_id", F.lit(seed))
    for y, n in sizes.items():
        keep |= (F.col("y") == y) & (F.pmod(h, F.lit(1_000_000)) < int(1_000_000 * min(1.0, 1.3 * max_train / n)))
    drawn = F.broadcast(known.where(keep))
    found = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).where(F.length("text") <= max_text).join(drawn, "doc_id")
    rows = found.groupBy("y", h.alias("h")).agg(F.min("text").alias("text")).collect()
    texts, good = [], []
    for y in sorted(sizes):
        mine = sorted((r for r in rows if r["y"] == y), key=lambda r: r["h"])[:max_train]
        texts += [r["text"] for r in mine]
        good += [y] * len(mine)
    return fit(texts, np.array(good)) if len(set(good)) == 2 else neutral


def classify(docs: DataFrame, model: dict, *, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns in `keep` and `score` (double), one row per row of `docs`.

    Null texts count as empty, which is one empty line; equal texts have equal scores, repeated rows each their
    own; an empty table gives no rows. Other columns of `docs` may have any name; a column `score` of `keep`
    gives way to the result's.
    """
    from pyspark.sql.types import DoubleType, StructField, StructType

    keep = tuple(c for c in keep if c != "score")
    picked = docs.select(*[F.col(c) for c in keep], F.col(text_col).cast("string").alias("__text"))
    schema = StructType([*picked.schema.fields[:-1], StructField("score", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                got = score(batch.column(batch.num_columns - 1).to_pylist(), model)
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(got, pa.float64())], names=[*keep, "score"])

    return picked.mapInArrow(run, schema)


def remainder(doc_id, by: int):
    """crc32 of the id as text, modulo `by`; a null id has none."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(by))


def quality_digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores of all `docs`; labels whose id has the remainder 1 modulo 3 are held out of training."""
    model = train(docs, labels, usable=lambda c: remainder(c, 3) != 1)
    out = classify(docs, model)
    return out.select("doc_id", (F.coalesce(remainder(F.col("doc_id"), 3), F.lit(-1)) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
