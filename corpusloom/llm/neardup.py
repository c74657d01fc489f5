"""Op 10, near-duplicates: fast similarity sketching, banding, exact verification.

Method (Dahlgaard, Knudsen and Thorup, 2017): a set fills the ``t`` coordinates of its sketch in
rounds. In round i < t every element is hashed to a bin and to a value v and offers i + v there; in
round t + j every element goes to bin j, so that each coordinate surely fills within 2 t rounds,
almost always within two or three. Two sketches agree in a coordinate with probability J, with the
concentration of sampling without replacement. ``bands`` bands of ``rows`` coordinates give the
candidates, and every link is confirmed on the full shingle sets.

No pairs within a group: documents with equal sets are one node. In each band's bucket all nodes
are compared with two pivots only (the smallest and the largest node), linked nodes become
components, and a second round compares the nodes of different components that still share a
bucket: each member outside a bucket's largest component with the bucket's members, so that a few
strangers among many copies cost no more than the copies' number; in blocks of bounded size, by their
sketches first (a pair is left out if its agreement is over five standard deviations below the
threshold), then exactly. What is left out in total: a pair at similarity s
shares no band with probability (1 - s^rows)^bands, 3e-6 at 0.8.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._scratch import materialize, release

_U = np.uint64
_MULT = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], _U)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finalizer (splitmix64)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class _WordHashes(dict):
    """64-bit hashes of words, kept for the words met lately."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


_hashes = _WordHashes()


def shingle_set(text: str | None, k: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct k-word shingles of a whole text.

    A-Z count as a-z; words are runs of characters other than ASCII white space (bytes.split() and
    bytes.lower() have just these rules). With fewer than k words the whole sequence is one shingle.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    n = len(words)
    if not n:
        return np.empty(0, _U)
    h = np.fromiter(map(_hashes.__getitem__, words), _U, n)
    if n < k:
        return _mix(np.atleast_1d((h * _MULT[:n]).sum(dtype=_U) + _U(n * 0x2545F4914F6CDD1D & 0xFFFFFFFFFFFFFFFF)))
    s = h[: n - k + 1] * _MULT[0]
    for i in range(1, k):
        s += h[i : n - k + 1 + i] * _MULT[i]
    return np.unique(_mix(s))


def sketches(flat: np.ndarray, sizes: np.ndarray, t: int) -> np.ndarray:
    """Fast similarity sketches, one row of `t` values per non-empty set; sets lie one after another in `flat`."""
    none = np.iinfo(np.uint64).max
    m = len(sizes)
    out = np.full((m, t), none, _U)
    active = np.arange(m)  # sets with an empty coordinate; `work` has their rows
    work, owner, x = out.copy(), np.repeat(np.arange(m), sizes), flat
    for i in range(2 * t):
        h = _mix(x ^ _mix(np.atleast_1d(_U((i + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))))
        bins = ((h >> _U(32)) % _U(t)).astype(np.int64) if i < t else np.full(len(x), i - t)
        # No later round can undercut an earlier one: the round is the value's whole part.
        np.minimum.at(work.reshape(-1), owner * t + bins, (h & _U(0xFFFFFFFF)) | (_U(i) << _U(32)))
        if i > 8 and i % 8 and i < 2 * t - 1:
            continue  # an extra round changes nothing in a full sketch
        short = (work == none).any(axis=1)
        if short.all():
            continue
        out[active[~short]] = work[~short]
        if not short.any():
            break
        stay = short[owner]
        active, work = active[short], work[short]
        x, owner = x[stay], (np.cumsum(short) - 1)[owner[stay]]
    return out


_ARROW = pa.schema([("doc_id", pa.int64()), ("th", pa.int64()), ("n_shingles", pa.int64()), ("sid", pa.binary()), ("bands", pa.list_(pa.int64()))])
_DDL = "doc_id long, th long, n_shingles long, sid binary, bands array<long>"


def _sketch_rows(k: int, bands: int, rows: int):
    t = bands * rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                sets = [shingle_set(x.as_py(), k) for x in batch.column(2)]
                sizes = np.array([len(s) for s in sets])
                full = np.flatnonzero(sizes)
                keys = np.zeros((len(sets), bands), np.int64)
                if len(full):
                    sk = sketches(np.concatenate([sets[i] for i in full]), sizes[full], t)
                    by = _mix(sk).reshape(len(full), bands, rows)
                    acc = np.broadcast_to(_mix(np.arange(1, bands + 1, dtype=_U)), (len(full), bands)).copy()
                    for r in range(rows):
                        acc = _mix(acc * _U(0x9E3779B97F4A7C15) + by[:, :, r])
                    keys[full] = acc.view(np.int64)
                listed = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(np.where(sizes > 0, bands, 0))]).astype(np.int32)), pa.array(keys[full].ravel()))
                sids = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(sids, pa.binary()), listed], schema=_ARROW)

    return run


def _verify(k: int, threshold: float):
    """Keeps the pairs (a, b, text_a, text_b) whose shingle sets are similar enough; exact in integers."""
    cents = round(threshold * 100)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, held = None, None
        for pdf in batches:
            keep = np.zeros(len(pdf), bool)
            for i, (b, ta, tb) in enumerate(zip(pdf["b"], pdf["text_a"], pdf["text_b"], strict=True)):
                if b != last:
                    last, held = b, shingle_set(tb, k)
                sa = shingle_set(ta, k)
                if 100 * min(len(sa), len(held)) >= cents * max(len(sa), len(held)):
                    both = len(np.intersect1d(sa, held, assume_unique=True))
                    keep[i] = 100 * both >= cents * (len(sa) + len(held) - both)
            yield pdf.loc[keep, ["a", "b"]]

    return run


#: Coordinates of the second, one-bit sketch. Two sets agree in a bit with probability (1 + J) / 2.
BITS = 4096


def _bit_rows(k: int):
    """(nid, text) to (nid, bits): one bit of each coordinate of a long sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 200):
                batch = whole.slice(at, 200)
                sets = [shingle_set(x.as_py(), k) for x in batch.column(1)]
                sk = sketches(np.concatenate(sets), np.array([len(s) for s in sets]), BITS)
                bits = np.packbits((_mix(sk) & _U(1)).astype(np.uint8), axis=1)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x.tobytes() for x in bits], pa.binary())], names=["nid", "bits"])

    return run


def _rivals(least: int, cents: int):
    """Within one group (two parts of a bucket, i and j, the first of strangers): pairs of different components
    that may be similar enough.

    Each pair comes from the first band that its two nodes share, so no pair comes twice.
    """

    def meet(rows: dict[str, np.ndarray]) -> np.ndarray:
        """Pairs (left, right) of one group."""
        bucket, i, j = rows["key"][0], rows["i"][0], rows["j"][0]
        found: list[np.ndarray] = []
        left, right = np.flatnonzero(rows["part"] == i), np.flatnonzero(rows["part"] == j)
        if len(left) and len(right):
            (lbits, rbits), (lc, rc), (ln, rn), (lid, rid), (lb, rb) = ((rows[c][left], rows[c][right]) for c in ("bits", "comp", "n", "nid", "bands"))
            band = int((lb[0] == bucket).argmax())
            for at in range(0, len(left), 128):  # a few rows at a time: the matrices stay small
                to = slice(at, at + 128)
                near = lc[to, None] != rc[None]
                near &= 100 * np.minimum(ln[to, None], rn[None]) >= cents * np.maximum(ln[to, None], rn[None])
                if i == j:
                    near &= lid[to, None] < rid[None]
                for k in range(band):
                    near &= lb[to, k, None] != rb[None, :, k]
                x, y = np.nonzero(near)
                x += at
                for some in range(0, len(x), 8192):
                    p, q = x[some : some + 8192], y[some : some + 8192]
                    close = np.bitwise_count(lbits[p] ^ rbits[q]).sum(axis=1, dtype=np.int64) <= BITS - least
                    found.append(np.stack([lid[p], rid[q]], axis=1)[close])
        return np.concatenate(found) if found else np.empty((0, 2), np.int64)

    def columns(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
        out = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "i", "j", "part", "nid", "comp")}
        out["n"] = batch.column("n").to_numpy(zero_copy_only=False).astype(np.float64)
        out["bits"] = np.frombuffer(b"".join(batch.column("bits").to_pylist()), _U).reshape(batch.num_rows, -1)
        out["bands"] = batch.column("bands").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by group; a group that a batch breaks off waits for the next one."""

        def emit(pairs: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(pairs.max(axis=1, initial=-1)), pa.array(pairs.min(axis=1, initial=(1 << 63) - 1))], names=["a", "b"])

        held: dict[str, np.ndarray] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = columns(batch)
            if held is not None:
                rows = {c: np.concatenate([held[c], rows[c]]) for c in rows}
            new = np.zeros(len(rows["key"]), bool)
            for c in ("key", "i", "j"):
                new[1:] |= rows[c][1:] != rows[c][:-1]
            edges = [0, *np.flatnonzero(new).tolist()]
            done = [meet({c: v[lo:hi] for c, v in rows.items()}) for lo, hi in pairwise(edges)]
            held = {c: v[edges[-1] :] for c, v in rows.items()}
            if done:
                yield emit(np.concatenate(done))
        if held is not None:
            yield emit(meet(held))

    return run


def connected_components(edges: DataFrame) -> DataFrame:
    """nid, comp (the smallest nid reachable) for the nodes of edges (a, b); iterated min-label with pointer jumping."""
    both = materialize(edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b").alias("u"), F.col("a").alias("v"))).distinct(), "edges")
    labels = materialize(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("comp")).withColumnRenamed("u", "nid"), "labels")
    while True:
        spread = both.join(labels.withColumnRenamed("nid", "v"), "v").groupBy("u").agg(F.min("comp").alias("near"))
        lower = labels.join(spread.withColumnRenamed("u", "nid"), "nid").select("nid", "comp", F.least("comp", "near").alias("next"))
        jump = labels.select(F.col("nid").alias("next"), F.col("comp").alias("far"))
        new = materialize(lower.join(jump, "next").select("nid", F.col("comp").alias("old"), F.least("next", "far").alias("comp")), "labels")
        release(labels)
        labels = new
        if not labels.where("old <> comp").limit(1).count():
            release(both)
            return labels.select("nid", "comp")


def near_duplicates(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    k: int = 5,
    threshold: float = 0.8,
    bands: int = 32,
    rows: int = 5,
    block: int = 1024,
) -> DataFrame:
    """One row per row of `docs`: doc_id, text_hash, n_shingles, component_id, group_id, kept.

    component_id: the smallest doc_id reachable over links of at least `threshold`; kept: doc_id is
    that one. Null, empty and wordless texts have no shingles, are linked with nothing and kept.
    Repeated rows have equal sets; rows that share the smallest id are all kept (group_id and
    text_hash, which is xxhash64 of the text, tell them apart). A row with a null id is kept only if its component has no other id.
    Ids are whole numbers. Only `id_col` and `text_col` are read, so other columns may have any name.
    group_id numbers the components of this run, also those without an id; it is null without shingles.
    """
    t = bands * rows
    text = F.col(text_col).cast("string")
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), text.alias("text"))
    seen = materialize(named.mapInArrow(_sketch_rows(k, bands, rows), _DDL), "sketches")

    # One node per distinct set; nid is fixed as the table is written.
    nodes = seen.where("n_shingles > 0").groupBy("sid").agg(F.min(F.struct(F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("at"), "th", "doc_id")).alias("first"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"))
    nodes = materialize(nodes.withColumn("nid", F.monotonically_increasing_id()), "nodes")
    banded = nodes.select("nid", F.explode("bands").alias("key"))
    shared = materialize(banded.groupBy("key").agg(F.min("nid").alias("lo"), F.max("nid").alias("hi"), F.count("*").alias("members")).where("lo <> hi"), "shared")
    members = materialize(banded.join(shared, "key").select("key", "nid", "lo", "hi", "members"), "members")
    star = members.select("nid", F.explode(F.array("lo", "hi")).alias("b")).where("nid <> b").distinct()
    star = star.select(F.greatest("nid", "b").alias("a"), F.least("nid", "b").alias("b")).distinct()

    # Texts of the nodes that share a bucket, found again by id and hash of the text.
    wanted = members.select("nid").distinct().join(nodes.select("nid", "first"), "nid").select("nid", F.col("first.doc_id").alias("want"), F.col("first.th").alias("wth"))
    found = docs.select(F.col(id_col).cast("long").alias("want"), F.xxhash64(text).alias("wth"), text.alias("text"))
    texts = wanted.alias("w").join(found.alias("d"), F.col("w.want").eqNullSafe(F.col("d.want")) & (F.col("w.wth") == F.col("d.wth"))).select("nid", "text")
    texts = materialize(texts, "texts")

    def verified(pairs: DataFrame) -> DataFrame:
        a = texts.select(F.col("nid").alias("a"), F.col("text").alias("text_a"))
        b = texts.select(F.col("nid").alias("b"), F.col("text").alias("text_b"))
        return pairs.join(a, "a").join(b, "b").select("a", "b", "text_a", "text_b").mapInPandas(_verify(k, threshold), "a long, b long")

    links = materialize(verified(star).distinct(), "links")
    labels = connected_components(links)

    # Second round: nodes of different components that still share a bucket.
    marked = members.join(labels, "nid", "left").select("key", "nid", "members", F.coalesce("comp", "nid").alias("comp"))
    # Per bucket of several components: its largest one (ties: the smaller number); who isn't in that is a stranger there.
    sizes = marked.groupBy("key", "comp").agg(F.count("*").alias("c"), F.first("members").alias("members"))
    top = sizes.groupBy("key").agg(F.max(F.struct("c", (-F.col("comp")).alias("least"))).alias("top"), F.count("*").alias("comps"), F.first("members").alias("members"))
    mixed = top.where("comps > 1").select("key", (-F.col("top.least")).alias("main"), (F.col("members") - F.col("top.c")).alias("minors"))
    rivals = materialize(marked.join(mixed, "key").withColumn("minor", F.col("comp") != F.col("main")).drop("main"), "rival")
    bits = texts.join(rivals.select("nid").distinct(), "nid").select("nid", "text").mapInArrow(_bit_rows(k), "nid long, bits binary")
    bits = materialize(bits, "bits")
    rival = rivals.join(bits, "nid").join(nodes.select("nid", "n", "bands"), "nid")
    # Parts of about `block` nodes, those of strangers first; each of these meets itself and every other part, in a group of its own.
    first, rest = F.ceil(F.col("minors") / block).cast("int"), F.ceil((F.col("members") - F.col("minors")) / block).cast("int")
    mine = F.xxhash64("nid")
    rival = rival.withColumn("part", F.when(F.col("minor"), F.pmod(mine, first)).otherwise(first + F.pmod(mine, rest)).cast("int"))
    rival = rival.withColumn("o", F.explode(F.sequence(F.lit(0), F.when(F.col("minor"), first + rest).otherwise(first) - 1)))
    rival = rival.select("key", F.least("part", "o").alias("i"), F.greatest("part", "o").alias("j"), "part", "nid", "comp", "n", "bits", "bands")
    sd = ((1 + threshold) / 2 * (1 - threshold) / 2 / BITS) ** 0.5
    least = int(((1 + threshold) / 2 - 5 * sd) * BITS)
    # Sorted runs instead of grouped pandas: most groups have a handful of rows.
    more = rival.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(_rivals(least, round(threshold * 100)), "a long, b long")
    late = materialize(verified(more.join(star, ["a", "b"], "left_anti")).distinct(), "late")
    labels = connected_components(links.union(late))
    for done in (shared, members, texts, rivals, bits, links, late):
        release(done)

    # Component ids; nodes without a link keep their own smallest document.
    linked = labels.join(nodes.select("nid", F.col("first.doc_id").alias("d")), "nid")
    least_doc = linked.groupBy("comp").agg(F.min("d").alias("component_id"))
    of = labels.join(least_doc, "comp").select("nid", "component_id", F.col("comp").alias("group_id"))
    of = nodes.select("sid", "nid", F.col("first.doc_id").alias("d")).join(of, "nid", "left")
    of = of.select("sid", F.when(F.col("group_id").isNotNull(), F.col("component_id")).otherwise(F.col("d")).alias("component_id"), F.coalesce("group_id", "nid").alias("group_id"))
    out = seen.select("doc_id", F.col("th").alias("text_hash"), "n_shingles", "sid").join(of, "sid", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "text_hash", "n_shingles", component.alias("component_id"), "group_id").withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def neardup_digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "n_shingles", "component_id", "kept")


ORACLE_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3])) END AS s FROM words),
sorted AS (SELECT doc_id, list_sort(s) AS key FROM sets WHERE len(s) > 0),
nodes AS (SELECT min(doc_id) AS d, key, len(key) AS n FROM sorted GROUP BY key),
items AS (SELECT d, n, unnest(key) AS x FROM nodes),
links AS (
  SELECT a.d AS a, b.d AS b FROM items a JOIN items b ON a.x = b.x AND a.d <> b.d
  GROUP BY a.d, b.d, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach(a, b) AS (SELECT d, d FROM nodes UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least_of AS (SELECT a AS d, min(b) AS component_id FROM reach GROUP BY a)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, coalesce(l.component_id, s.doc_id) AS component_id, s.doc_id = coalesce(l.component_id, s.doc_id) AS kept
FROM sets s LEFT JOIN nodes n ON list_sort(s.s) = n.key LEFT JOIN least_of l ON n.d = l.d
"""
