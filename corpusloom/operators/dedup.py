"""Exact and near-duplicate removal in arrival order (DUP-1..4, LSH-1..5).

Arrival order is an explicit column; the first of equals wins. Near-duplicates are judged by band
collisions alone: a document is dropped if and only if an earlier kept one shares a band. That is
the lexicographically first maximal independent set, found here by rounds over (bucket, document)
rows: an undecided document that is the smallest in all its buckets is kept, all that share a bucket with
a kept one are dropped, and so on until none is undecided. Two shuffles a round, no pairs.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import ArrayType, LongType

from ..functions.slices import PART, mapped
from ..scratch import materialize

#: The linear congruential generator that draws the hash family.
SEED, LCG_A, LCG_C = 42, 1664525, 1013904223


def fingerprint(text: Column) -> Column:
    return F.sha2(text, 256)


def exact_keep(docs: DataFrame, *, text_col: str = "text", order_col: str = "doc_id") -> DataFrame:
    """Adds `is_first`: no earlier row has the same text. A null text is a text of its own.

    Fingerprints are reduced before they are shuffled, and the join may split a hot one.
    """
    marked = docs.withColumn("_fp", F.coalesce(fingerprint(F.col(text_col)), F.lit("")))
    first = marked.groupBy("_fp").agg(F.min(order_col).alias("_first"))
    return marked.join(first, "_fp").withColumn("is_first", F.col(order_col) == F.col("_first")).drop("_fp", "_first")


def drop_seen(new: DataFrame, seen: DataFrame | None = None, key: str = "fp", order_col: str | None = None) -> DataFrame:
    """Rows of `new` whose key is not in `seen` (also DUP-4: what is completed); of rows with one key one stays, the
    first by `order_col` if that is given."""
    if order_col is None:
        once = new.dropDuplicates([key])
    else:
        once = new.groupBy(key).agg(F.min_by(F.struct(*[F.col(c) for c in new.columns if c != key]), order_col).alias("_row")).select(key, "_row.*").select(*new.columns)
    return once if seen is None else once.join(seen.select(key), key, "left_anti")


#: Shifts and constants of MD5 (RFC 1321).
_SHIFTS = [s for row in ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)) for s in row * 4]
_SINES = [int(abs(math.sin(i + 1)) * 2**32) for i in range(64)]
_START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)


def md5_prefixes(block: np.ndarray, tile: int = 32768) -> np.ndarray:
    """First 32 bits of the MD5 digests of messages of one block each, padded as MD5 asks for: [n, 16] words."""
    return np.concatenate([_md5_tile(block[at : at + tile]) for at in range(0, max(1, len(block)), tile)])


def _md5_tile(block: np.ndarray) -> np.ndarray:
    start = [np.full(len(block), x, np.uint32) for x in _START]
    words = [block[:, g] if block[:, g].any() else None for g in range(16)]
    a, b, c, d = start
    for i in range(64):
        if i < 16:
            f, g = (b & c) | (~b & d), i
        elif i < 32:
            f, g = (d & b) | (~d & c), (5 * i + 1) % 16
        elif i < 48:
            f, g = b ^ c ^ d, (3 * i + 5) % 16
        else:
            f, g = c ^ (b | ~d), 7 * i % 16
        f += a
        f += np.uint32(_SINES[i])
        if words[g] is not None:
            f += words[g]
        a, d, c = d, c, b
        b = b + (f << np.uint32(_SHIFTS[i]) | f >> np.uint32(32 - _SHIFTS[i]))
    return (a + start[0]).byteswap()


def _blocks(codes: np.ndarray) -> np.ndarray:
    """Padded message blocks [n, 16] of the UTF-8 forms of strings of equal length, given as code points [n, k].

    Words lie together by their place in the block, as MD5 goes through them.
    """
    n, k = codes.shape
    out = np.zeros((16, n), np.uint32)
    ascii_, wide = np.flatnonzero((codes < 0x80).all(axis=1)), np.flatnonzero((codes >= 0x80).any(axis=1))
    if len(ascii_):
        plain = codes[ascii_].astype(np.uint32)
        for w in range(k // 4 + 1):
            word = np.full(len(ascii_), 0x80 << 8 * (k % 4) if w == k // 4 else 0, np.uint32)
            for j in range(4 * w, min(k, 4 * w + 4)):
                word |= plain[:, j] << np.uint32(8 * (j % 4))
            out[w, ascii_] = word
        out[14, ascii_] = 8 * k
    if len(wide):
        out[:, wide] = _wide_blocks(codes[wide]).T
    return out.T


def _wide_blocks(codes: np.ndarray) -> np.ndarray:
    n, k = codes.shape
    out, at, rows = np.zeros((n, 64), np.uint8), np.zeros(n, np.int64), np.arange(n)
    for j in range(k):
        c = codes[:, j]
        size = 1 + (c > 0x7F) + (c > 0x7FF) + (c > 0xFFFF)
        for part in range(4):
            here = np.flatnonzero(size > part)
            x, more = c[here], size[here] - 1 - part
            lead = np.choose(size[here] - 1, [0, 0xC0, 0xE0, 0xF0])
            low = x >> (6 * more).astype(np.uint32)
            out[rows[here], at[here] + part] = (low | lead if part == 0 else (low & 0x3F) | 0x80).astype(np.uint8)
        at += size
    out[rows, at] = 0x80
    block = out.view("<u4").copy()
    block[:, 14] = at * 8
    return block


def hash_family(n: int) -> tuple[np.ndarray, np.ndarray]:
    x, pairs = SEED, []
    for _ in range(n):
        a = (x := (LCG_A * x + LCG_C) & 0xFFFFFFFF) | 1
        b = x = (LCG_A * x + LCG_C) & 0xFFFFFFFF
        pairs.append((a, b))
    table = np.array(pairs, np.uint64)
    return table[:, 0], table[:, 1]


def least_hashes(hashes: np.ndarray, ends: np.ndarray, n_hashes: int, tile: int = 16384) -> np.ndarray:
    """[texts, n_hashes] minima of (a * h + b) mod 2^32; text i has hashes[ends[i - 1] : ends[i]], at least one.

    One hash function after another over a tile of all texts' hashes, which stays in the processor's cache.
    """
    a, b = (x.astype(np.uint32) for x in hash_family(n_hashes))
    best = np.full((n_hashes, len(ends)), 0xFFFFFFFF, np.uint32)
    starts = np.append(0, ends[:-1])
    buffer = np.empty(tile, np.uint32)
    for at in range(0, len(hashes), tile):
        h = hashes[at : at + tile]
        lo, hi = np.searchsorted(starts, at, "right") - 1, np.searchsorted(starts, at + len(h), "left")
        cuts, got = np.maximum(starts[lo:hi] - at, 0), buffer[: len(h)]
        for i in range(n_hashes):
            np.multiply(h, a[i], out=got)
            np.add(got, b[i], out=got)
            np.minimum(best[i, lo:hi], np.minimum.reduceat(got, cuts), out=best[i, lo:hi])
    return best.T


def _distinct(ids: np.ndarray) -> np.ndarray:
    ids = np.sort(ids)
    return ids[np.append(True, ids[1:] != ids[:-1])]


def signature_udf(n_hashes: int = 128, shingle: int = 5):
    """text -> array<long> of minima of (a * h + b) mod 2^32 over the MD5 prefixes of its character shingles."""

    def plain(low: str) -> np.ndarray:
        """Hashes of a text's shingles, one by one."""
        found = {low[i : i + shingle] for i in range(max(1, len(low) - shingle + 1))}
        return np.array([int.from_bytes(hashlib.md5(x.encode("utf-8", "surrogatepass")).digest()[:4], "big") for x in found], np.uint32)

    def many(lows: list[str]) -> list[np.ndarray]:
        """Hashes of the shingles of texts of at least `shingle` characters; each distinct shingle is hashed once."""
        codes = np.frombuffer("".join(lows).encode("utf-32-le", "surrogatepass"), np.uint32)
        used = np.zeros(0x110000, bool)
        used[codes] = True
        letters = np.flatnonzero(used)
        if len(letters) ** shingle >= 1 << 63:
            return [plain(x) for x in lows]
        place = np.zeros(letters[-1] + 1, np.int64)
        place[letters] = np.arange(len(letters))
        ids = place[codes]
        key = np.zeros(len(codes) - shingle + 1, np.int64)
        for j in range(shingle):
            key *= len(letters)
            key += ids[j : j + len(key)]
        coded = pa.array(key).dictionary_encode()
        every, own = coded.dictionary.to_numpy(), coded.indices.to_numpy()
        spelled = np.stack([letters[every // len(letters) ** (shingle - 1 - j) % len(letters)] for j in range(shingle)], axis=1)
        h = md5_prefixes(_blocks(spelled))
        sizes = np.array([len(x) for x in lows])
        starts = np.cumsum(sizes) - sizes
        return [h[_distinct(own[s : s + n - shingle + 1])] for s, n in zip(starts, sizes, strict=True)]

    def signed(texts: list[str | None]) -> pa.Array:
        known = [x.lower() for x in texts if x is not None]
        long = [i for i, x in enumerate(known) if shingle <= len(x) and shingle <= 13]  # 13 characters surely fit a block of MD5
        hashes: list[np.ndarray | None] = [None] * len(known)
        for i, h in zip(long, many([known[i] for i in long]) if long else [], strict=True):
            hashes[i] = h
        hashes = [plain(x) if h is None else h for x, h in zip(known, hashes, strict=True)]
        flat = np.concatenate(hashes) if known else np.empty(0, np.uint32)
        values = least_hashes(flat, np.cumsum([len(h) for h in hashes], dtype=np.int64), n_hashes).astype(np.int64).ravel()
        has = np.array([x is not None for x in texts])
        return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(has) * n_hashes), pa.int32()), pa.array(values), mask=pa.array(~has))

    @arrow_udf(ArrayType(LongType()))
    def signature(text: pa.Array) -> pa.Array:
        return mapped(text, signed, pa.list_(pa.int64()), 2 * PART)

    return signature


def band_keys(signature: Column, n_bands: int = 16, n_hashes: int = 128) -> Column:
    rows = n_hashes // n_bands
    if rows * n_bands != n_hashes:
        raise ValueError("the number of hashes must be a multiple of the number of bands")
    return F.array(*[F.sha2(F.concat_ws(",", F.lit(i).cast("string"), F.slice(signature, i * rows + 1, rows).cast("array<string>")), 256) for i in range(n_bands)])


def _checkpoint(df: DataFrame) -> DataFrame:
    """A written table in spark.checkpoint.dir: unlike checkpoint(), the plan runs once."""
    return materialize(df, "round")


def lsh_keep(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", n_hashes: int = 128, n_bands: int = 16, shingle: int = 5, seen: DataFrame | None = None) -> DataFrame:
    """id, kept: greedy band-collision deduplication in the order of `id_col`.

    `seen` (bucket) holds the buckets of documents kept in earlier batches. Null texts are not judged
    and not returned.
    """
    sig = signature_udf(n_hashes, shingle)
    signed = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), sig(F.col(text_col)).alias("sig"))
    member = _checkpoint(signed.select("id", F.explode(band_keys(F.col("sig"), n_bands, n_hashes)).alias("bucket")))
    ids = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"))
    dropped = member.join(seen.select("bucket"), "bucket", "left_semi").select("id").distinct() if seen is not None else None
    if dropped is not None:
        member = _checkpoint(member.join(dropped, "id", "left_anti"))
    # A bucket with one member decides nothing.
    shared = member.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket")
    open_ = _checkpoint(member.join(shared, "bucket"))
    while not open_.isEmpty():
        least = open_.groupBy("bucket").agg(F.min("id").alias("least"))
        state = open_.join(least, "bucket").withColumn("is_least", F.col("id") == F.col("least"))
        kept = state.groupBy("id").agg(F.min("is_least").alias("keep")).where("keep").select("id")
        taken = state.join(kept, "id", "left_semi").select("bucket").distinct()
        lost = _checkpoint(open_.join(taken, "bucket", "left_semi").select("id").distinct().join(kept, "id", "left_anti"))
        dropped = lost if dropped is None else _checkpoint(dropped.union(lost))
        open_ = _checkpoint(open_.join(lost, "id", "left_anti").join(taken, "bucket", "left_anti"))
    if dropped is None:
        return ids.withColumn("kept", F.lit(True))
    return ids.join(dropped.withColumn("lost", F.lit(True)), "id", "left").select("id", F.col("lost").isNull().alias("kept"))
