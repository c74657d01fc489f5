"""Op 1, best-fit packing: documents to token sequences of a fixed length.

Method: vector best-fit. Every piece is a vector (tokens, 1 document, attention cost = length
squared) and every open bin has a residual capacity vector. Pieces come longest first; each goes
to the open bin that has room for it in every dimension and scores best, either by the smallest
weighted norm of the residual after placement (``rule="norm"``) or by the largest weighted dot
product of piece and residual (``rule="dot"``); a new bin opens only where none has room.

Scale: the input partition is packed where it is tokenized, in windows of ``window_tokens`` (the
only thing held in memory); bins with room for a piece of over ``slack`` tokens in every dimension are
carried to the next window and, at the end of the partition or where they hold most of a window, set
apart. Those are packed once more across partitions, mixed by length, about ``tail_tokens`` a task,
together with as many of the full sequences of short pieces as can fill them. So only leftovers and
their fillers are shuffled, and no task ever sees the whole corpus.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._scratch import materialize

PIECES = "piece int, start long, length long, ids binary, sequence_id long, offset long, leftover boolean, longest long, room long"

#: Per Python worker: the encoder for a rank file, and the slow one.
_encoders: dict = {}
_plain: dict = {}


def default_ranks() -> str:
    """Rank file of the 50k byte-level BPE: the same ids as byte_bpe_50k.json gives with `tokenizers`."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def default_json() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def encoder(ranks_path: str, json_path: str | None = None):
    """A cached tiktoken encoder; its special tokens are those of the JSON file."""
    key = ranks_path, json_path
    if key not in _encoders:
        import public_tokenizers
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        with open(json_path or default_json(), encoding="utf-8") as f:
            special = {t["content"]: t["id"] for t in json.load(f).get("added_tokens", [])}
        _encoders[key] = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
    return _encoders[key]


def encode(enc, text: str, json_path: str | None = None) -> list[int]:
    """Ids of a text of any length, as `tokenizers` gives them without adding special tokens: the string of a
    special token within the text is that token.

    The encoder's regular expression overflows its stack on a run of some hundred thousand white
    space characters; such a text goes through `tokenizers`, which is slower and gives the same ids.
    """
    try:
        return enc.encode(text, allowed_special="all") if any(s in text for s in enc.special_tokens_set) else enc.encode_ordinary(text)
    except BaseException as error:  # a Rust panic is no Exception
        if type(error).__name__ != "PanicException":
            raise
        from tokenizers import Tokenizer

        path = json_path or default_json()
        if path not in _plain:
            _plain[path] = Tokenizer.from_file(path)
        return _plain[path].encode(text, add_special_tokens=False).ids


def best_fit(lengths: np.ndarray, capacity: int, max_docs: int, max_cost: float, weights: tuple[float, float, float], rule: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin of each piece, its offset there, and the tokens left in each bin.

    A piece of full capacity gets a bin of its own. Ties go to the bin opened first. A piece whose
    attention cost alone exceeds `max_cost` also gets a bin of its own.
    """
    n = len(lengths)
    bins, offsets = np.empty(n, np.int64), np.zeros(n, np.int64)
    order = np.argsort(-lengths, kind="stable")
    wt, wd, wc = weights
    # Open bins live in the first `m` places; one that can take nothing more gives its place away.
    tok, doc, cost, name = np.zeros(1024), np.zeros(1024), np.zeros(1024), np.zeros(1024, np.int64)
    left: list[int] = []
    m = 0
    least = int(lengths.min()) if n else 0
    for i in order:
        x = int(lengths[i])
        c = float(x) * x
        best = -1
        if m and x < capacity:
            t = tok[:m] - x
            fits = t >= 0
            fits &= doc[:m] >= 1
            fits &= cost[:m] >= c
            if rule == "dot":
                score = -(wt * x * tok[:m] / capacity**2 + wd * doc[:m] / max_docs**2 + wc * c * cost[:m] / max_cost**2)
            else:
                score = wt * (t / capacity) ** 2
                if wd:
                    score += wd * ((doc[:m] - 1) / max_docs) ** 2
                if wc:
                    score += wc * ((cost[:m] - c) / max_cost) ** 2
            score[~fits] = np.inf
            best = int(score.argmin())
            if score[best] == np.inf:
                best = -1
        if best < 0:
            bins[i] = len(left)
            left.append(capacity - x)
            if x < capacity:
                if m == len(tok):
                    tok, doc, cost, name = (np.concatenate([a, np.zeros_like(a)]) for a in (tok, doc, cost, name))
                tok[m], doc[m], cost[m], name[m] = capacity - x, max_docs - 1, max_cost - c, bins[i]
                m += 1
                best = m - 1
        else:
            b = int(name[best])
            bins[i], offsets[i] = b, capacity - left[b]
            left[b] -= x
            tok[best] -= x
            doc[best] -= 1
            cost[best] -= c
        if best >= 0 and (tok[best] < least or doc[best] < 1):
            m -= 1
            for a in (tok, doc, cost, name):
                a[best] = a[m]
    return bins, offsets, np.asarray(left, np.int64)


class _Packer:
    """Pieces of one partition, packed window by window."""

    def __init__(self, opts: dict, base: int, final: bool, kind: pa.DataType):
        self.o, self.base, self.final, self.kind, self.next = opts, base, final, kind, 0
        self.rows: list[tuple] = []  # doc_id, piece, start, ids as bytes
        self.held = 0

    def add(self, doc_id, piece: int, start: int, ids: bytes) -> None:
        self.rows.append((doc_id, piece, start, ids))
        self.held += len(ids) // 4

    def flush(self, last: bool) -> Iterator[pa.RecordBatch]:
        if not self.rows:
            return
        o, rows = self.o, self.rows
        lengths = np.fromiter((len(r[3]) // 4 for r in rows), np.int64, len(rows))
        bins, offsets, left = best_fit(lengths, o["capacity"], o["max_docs"], o["max_cost"], o["weights"], o["rule"])
        # The longest piece that a bin still takes, in every dimension.
        docs, cost = np.bincount(bins, minlength=len(left)), np.bincount(bins, lengths.astype(np.float64) ** 2, minlength=len(left))
        room = np.minimum(left, np.sqrt(np.maximum(o["max_cost"] - cost, 0)).astype(np.int64)) * (docs < o["max_docs"])
        loose = room > o["slack"]
        # A mostly loose window isn't carried on, which would not end; its loose bins are set apart as the last window's are.
        apart = last or (loose.sum() * o["capacity"] - left[loose].sum()) * 2 > lengths.sum()
        keep = np.flatnonzero(loose[bins]) if not apart else np.empty(0, np.int64)
        out = np.flatnonzero(~loose[bins]) if not apart else np.arange(len(rows))
        self.rows, self.held = [rows[i] for i in keep], int(lengths[keep].sum())
        if len(out):
            longest = np.zeros(len(left), np.int64)
            np.maximum.at(longest, bins, lengths)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([rows[i][0] for i in out], self.kind),
                    pa.array([rows[i][1] for i in out], pa.int32()),
                    pa.array([rows[i][2] for i in out], pa.int64()),
                    pa.array(lengths[out]),
                    pa.array([rows[i][3] for i in out], pa.binary()),
                    pa.array(bins[out] + (self.base + self.next)),
                    pa.array(offsets[out]),
                    pa.array(loose[bins[out]] & (apart and not self.final)),
                    pa.array(longest[bins[out]]),
                    pa.array(np.where(offsets[out] == 0, room[bins[out]], 0)),
                ],
                names=["doc_id", *(x.split()[0] for x in PIECES.split(", "))],
            )
        self.next += len(left)


def _fillers(packed: DataFrame) -> Column:
    """Which full sequences of short pieces are opened again, as many tokens as leftover ones have room for.

    Where a table is ordered by length, short documents fill sequences of their own and none would
    be left for the half-empty ones of the long documents.
    """
    room = packed.where("leftover").agg(F.sum("room").alias("all"), F.max("room").alias("most")).first()
    need, limit, part = room["all"] or 0, -1, 1.0
    full = packed.where(~F.col("leftover") & (F.col("longest") <= (room["most"] or 0)))
    # One row a length.
    for r in sorted(full.groupBy("longest").agg(F.sum("length").alias("n")).collect()) if need else []:
        limit, part = r["longest"], min(1.0, need / r["n"])
        need -= r["n"]
        if need <= 0:
            break
    chosen = F.pmod(F.xxhash64("sequence_id"), F.lit(1000)) < F.lit(int(np.ceil(1000 * part)))
    return (F.col("longest") < limit) | ((F.col("longest") == limit) & chosen)


def pack_documents(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    ranks_path: str | None = None,
    json_path: str | None = None,
    capacity: int = 2048,
    end_id: int = 0,
    max_docs: int | None = None,
    max_cost: float | None = None,
    weights: tuple[float, float, float] = (1.0, 0.1, 0.1),
    rule: str = "norm",
    window_tokens: int = 4_000_000,
    tail_tokens: int = 1_000_000,
    slack: int = 8,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids, sequence_id, offset.

    ids: the piece's token ids, little-endian unsigned 32-bit. A document is its text's ids and
    then `end_id`; a null or empty text is `end_id` alone. Only a document of more than `capacity`
    ids is cut, into pieces of `capacity`, of which the first may be shorter. Piece offsets in a
    sequence are gapless from 0. `max_docs` and `max_cost` (sum of squared lengths) default to what
    no sequence can exceed, so that by default only tokens decide how many sequences there are, and the
    other two decide which of the bins with room is taken (`weights`: tokens, documents, cost). A piece
    whose own cost exceeds `max_cost` has a sequence to itself.

    Repeated rows are packed as often as they occur, a null id stays null, ties in length keep
    the order of rows, and an empty table gives no rows. Ids keep their type. Only `id_col` and
    `text_col` are read, so other columns may have any name.
    """
    if rule not in ("norm", "dot"):
        raise ValueError(f"rule is norm or dot, not {rule!r}")
    opts = {
        "capacity": capacity,
        "max_docs": max_docs or capacity,
        "max_cost": float(max_cost or capacity**2),
        "weights": weights,
        "rule": rule,
        "slack": slack,
    }
    ranks = ranks_path or default_ranks()

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(ranks, json_path)
        packer = None
        for batch in batches:
            packer = packer or _Packer(opts, TaskContext.get().partitionId() << 33, False, batch.schema.types[0])
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encode(enc, text.as_py() or "", json_path)
                ids.append(end_id)
                raw, n = np.asarray(ids, "<u4").tobytes(), len(ids)
                cut = (n - 1) % capacity + 1  # the first piece's length
                packer.add(doc_id, 0, 0, raw[: 4 * cut])
                for k, at in enumerate(range(cut, n, capacity), 1):
                    packer.add(doc_id, k, at, raw[4 * at : 4 * (at + capacity)])
                if packer.held >= window_tokens:
                    yield from packer.flush(last=False)
        if packer:
            yield from packer.flush(last=True)

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = None
        for batch in batches:
            packer = packer or _Packer(opts, (1 << 62) + (TaskContext.get().partitionId() << 33), True, batch.schema.types[0])
            cols = [batch.column(i).to_pylist() for i in range(4)]
            for row in zip(*cols, strict=True):
                packer.add(*row)
        if packer:
            yield from packer.flush(last=True)

    pieces = f"doc_id {docs.schema[id_col].dataType.simpleString()}, {PIECES}"
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    packed = materialize(narrow.mapInArrow(first, pieces), "packed")
    packed = packed.withColumn("leftover", F.col("leftover") | _fillers(packed))
    loose = packed.where("leftover")
    total = loose.agg(F.sum("length")).first()[0] or 0
    # Rows are dealt in turn in the order of their hash, so every task gets about as many tokens, of all lengths.
    tasks = max(1, -(-total // tail_tokens))
    tail = loose.select("doc_id", "piece", "start", "ids").repartition(tasks).mapInArrow(again, pieces)
    return packed.where("not leftover").unionByName(tail).drop("leftover", "longest", "room")


def packing_digest(packed: DataFrame) -> DataFrame:
    """The packed pieces without their ids, of which a CRC-32 stays."""
    return packed.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")
