"""Op 5, exact top-k inner product search: ball-tree branch and bound per shard.

Method: the candidates are dealt into shards of bounded size and every shard becomes a ball tree
(nodes split at the median along the line between two far points; a node has centre and radius),
built once and stored as one row. For a query q no point of a node scores above
<q, centre> + |q| * radius. A search visits nodes by descending bound and leaves off at the first that
cannot beat the query's current k-th score. That score is shared: a block of queries goes from tree to
tree and takes its k-th scores along, and before that every block has searched one group of trees, its
home, whose k-th scores are the bar in all other groups.

All is integer arithmetic on floor(scale * x): scores are exact sums in int64, or in whole numbers of
any size where int64 might overflow, and the bounds, which are floats, are widened by a margin above
their rounding error, so no tie is lost to it.

Scale: trees come in groups and queries in blocks of bounded size, and each block meets each group once;
nothing is broadcast. With blocks of b queries and groups of g points a point is moved n / (every * b)
times and a query n / g times. Only the at most k best rows of a query and group, and only those that
reach the bar, are shuffled to the final ranking.
"""

from __future__ import annotations

import io
from itertools import pairwise

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._scratch import materialize

#: Largest sum of squares of two vectors whose products are exact in float64, and in int64.
EXACT, WIDE = float(1 << 52), float(1 << 62)
LARGEST = (1 << 63) - 1


class BallTree:
    """Ball tree over integer points [n, d]: arrays of nodes, and points and ids in the order of the leaves."""

    def __init__(self, points: np.ndarray, ids: np.ndarray, leaf: int = 64):
        self.order = np.arange(len(points))
        self.leaf = leaf
        self.nodes: list[tuple[np.ndarray, float, int, int, int]] = []  # centre, radius, from, to, parent
        self.inner: set[int] = set()
        if len(points):
            self._build(points.astype(np.float64), 0, len(points), -1)
        self.points, self.ids = points[self.order], ids[self.order]
        self.centres = np.stack([n[0] for n in self.nodes]) if self.nodes else np.zeros((0, points.shape[1]))
        self.radii = np.array([n[1] for n in self.nodes])
        self.spans = np.array([n[2:] for n in self.nodes], np.int64).reshape(-1, 3)
        self.leaves = np.array([i for i in range(len(self.nodes)) if i not in self.inner], np.int64)

    def _build(self, points: np.ndarray, lo: int, hi: int, parent: int) -> None:
        own = points[self.order[lo:hi]]
        centre = own.mean(axis=0)
        gap = np.sqrt(((own - centre) ** 2).sum(axis=1))
        radius = float(gap.max()) * (1 + 1e-9) + 1e-6 + 1e-9 * float(np.abs(centre).max(initial=0))
        at = len(self.nodes)
        self.nodes.append((centre, radius, lo, hi, parent))
        if hi - lo > self.leaf and (own != own[0]).any():
            a = own[int(gap.argmax())]
            b = own[int(((own - a) ** 2).sum(axis=1).argmax())]
            side = own @ (a - b)
            mid = (hi - lo) // 2
            self.inner.add(at)
            self.order[lo:hi] = self.order[lo:hi][np.argpartition(side, mid)]
            self._build(points, lo, lo + mid, at)
            self._build(points, lo + mid, hi, at)

    def packed(self) -> bytes:
        """The tree as bytes, which `BallTree.unpacked` reads."""
        buffer = io.BytesIO()
        np.savez(buffer, points=self.points, ids=self.ids, centres=self.centres, radii=self.radii, spans=self.spans, leaves=self.leaves)
        return buffer.getvalue()

    @classmethod
    def unpacked(cls, data: bytes) -> BallTree:
        tree = cls.__new__(cls)
        with np.load(io.BytesIO(data), allow_pickle=False) as stored:
            for name in stored.files:
                setattr(tree, name, stored[name])
        return tree

    def search(self, queries: np.ndarray, own: np.ndarray, best: Best) -> None:
        """Puts this tree's points into `best`, the queries' own ids (`own`) left out."""
        if not len(self.leaves) or not len(queries):
            return
        q, p = queries.astype(np.float64), self.points.astype(np.float64)
        norm = np.sqrt((q**2).sum(axis=1))
        largest = float(np.sqrt((p**2).sum(axis=1)).max())
        # Products in float64 are exact for small vectors; larger ones are multiplied as integers, of any size if need be.
        small = np.maximum(norm, largest) ** 2 <= EXACT
        wide = ~small & (norm * largest < WIDE)
        for chosen, kind in ((small, np.float64), (wide, np.int64), (~small & ~wide, object)):
            at = np.flatnonzero(chosen)
            if len(at):
                self._search(q, norm, queries.astype(kind), p if kind is np.float64 else self.points.astype(kind), at, own, best)

    def _search(self, q: np.ndarray, norm: np.ndarray, queries: np.ndarray, points: np.ndarray, active: np.ndarray, own: np.ndarray, best: Best) -> None:
        size = np.sqrt((self.centres**2).sum(axis=1)) + self.radii
        row = np.zeros(len(q), np.int64)
        row[active] = np.arange(len(active))
        bounds = q[active] @ self.centres.T
        bounds += norm[active, None] * (self.radii * (1 + 1e-9) + size * 1e-9) + 1e-3
        # A node's bound holds for all below it, so a leaf's is the least on its path (parents come first).
        for at, (_, _, parent) in enumerate(self.spans):
            if parent >= 0:
                np.minimum(bounds[:, at], bounds[:, parent], out=bounds[:, at])
        bounds = bounds[:, self.leaves]
        ranks = np.argsort(-bounds, axis=1, kind="stable")
        at, take = 0, 2
        while at < len(self.leaves) and len(active):
            # Twice as many leaves a round, every query's best bounds first; the k-th score so far ends its search.
            chosen = ranks[row[active], at : at + take]
            good = bounds[row[active, None], chosen] >= best.score[active, None].astype(np.float64)
            x, y = np.nonzero(good)
            leaf, asked = chosen[x, y], active[x]
            order = np.argsort(leaf, kind="stable")
            leaf, asked = leaf[order], asked[order]
            edges = np.flatnonzero(np.diff(leaf, prepend=-1, append=len(self.leaves)))
            for lo, hi in pairwise(edges):
                first, last, _ = self.spans[self.leaves[leaf[lo]]]
                for some in range(lo, hi, 4096):
                    mine = asked[some : min(hi, some + 4096)]
                    scores = queries[mine] @ points[first:last].T
                    scores = np.clip(scores, -LARGEST, LARGEST).astype(np.int64) if scores.dtype == object else scores.astype(np.int64)
                    best.offer(mine, self.ids[first:last], scores, own)
            best.settle()
            active = active[good[:, 0]]
            at, take = at + take, take * 2


class Best:
    """The k best (score, then smaller id) of every query so far; `score` and `id` are those of the k-th, or the bar."""

    def __init__(self, score: np.ndarray, ids: np.ndarray, k: int):
        self.score, self.id, self.k = score, ids, k
        none = np.empty(0, np.int64)
        self.rows, self.held = (none, none, none), 0
        self.new: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def offer(self, asked: np.ndarray, ids: np.ndarray, scores: np.ndarray, own: np.ndarray) -> None:
        """scores: [asked, ids]. What can't reach the k best isn't kept."""
        bar, last = self.score[asked, None], self.id[asked, None]
        x, y = np.nonzero(((scores > bar) | ((scores == bar) & (ids[None] <= last))) & (ids[None] != own[asked, None]))
        if len(x):
            self.new.append((asked[x], ids[y], scores[x, y]))
            self.held += len(x)
            if self.held > 2_000_000:
                self.settle()

    def settle(self) -> None:
        if not self.new:
            return
        q, ids, scores = (np.concatenate(c) for c in zip(self.rows, *self.new, strict=True))
        order = np.lexsort((ids, -scores, q))
        q, ids, scores = q[order], ids[order], scores[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        stay = place < self.k
        self.rows, self.new, self.held = (q[stay], ids[stay], scores[stay]), [], 0
        full = place == self.k - 1
        self.score[q[full]], self.id[q[full]] = scores[full], ids[full]


def quantized(vector: Column, scale: int = 64) -> Column:
    """floor(scale * x) of every component, or null for a vector that is null or holds a null or non-finite component."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(vector.isNotNull() & ~bad, F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long")))


def _matrix(column: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(column), width), np.int64)
    for i, v in enumerate(column):
        out[i, : len(v)] = v
    return out


def top_k(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 20, every: int = 20, scale: int = 64, shard_rows: int = 8192, group_trees: int = 16, query_rows: int = 16384) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each row whose id is divisible by `every`, the k other rows of
    highest integer inner product (all, if fewer), ties to the smaller id.

    Vectors that are null, or hold a null or non-finite component, and rows with a null id take no part;
    empty vectors score 0. Components beyond a vector's own length count as 0. A row is left out of its own
    query by id, so rows that repeat an id are all left out of its queries; a repeated query row is one query
    (of the smallest vector), a repeated candidate row is one candidate. A component or a score beyond the range
    of a long counts as the limit of that range. An empty table gives no rows. Other columns may have any name.
    """
    ready = vectors.select(F.col(id_col).cast("long").alias("id"), quantized(F.col(vector_col), scale).alias("v")).where("id is not null and v is not null").distinct()
    ready = materialize(ready, "vectors")
    n, width = ready.agg(F.count("*"), F.max(F.size("v"))).first()
    width = width or 0
    shards = max(1, -(-n // shard_rows))
    blocks = max(1, -(-n // (every * query_rows)))
    # Groups of up to `group_trees` trees, but enough of them to keep the cluster busy.
    busy = 3 * vectors.sparkSession.sparkContext.defaultParallelism
    groups = min(shards, max(-(-shards // group_trees), -(-busy // blocks)))
    shard = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(shards)).cast("int")
    block = F.pmod(F.xxhash64("id", F.lit(2)), F.lit(blocks)).cast("int")

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = BallTree(_matrix(pdf["v"], width), pdf["id"].to_numpy(np.int64))
        return pd.DataFrame({"group": [int(pdf["shard"].iloc[0]) % groups], "tree": [tree.packed()]})

    trees = materialize(ready.select(shard.alias("shard"), "id", "v").groupBy("shard").applyInPandas(build, "group int, tree binary"), "trees")
    queries = ready.where(F.pmod(F.col("id"), F.lit(every)) == 0).groupBy("id").agg(F.min("v").alias("v"))
    queries = queries.select("id", "v", block.alias("block"), F.pmod(block, F.lit(groups)).cast("int").alias("home"))

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        own, asked = left["id"].to_numpy(np.int64), _matrix(left["v"], width)
        best = Best(left["bar"].to_numpy(np.int64).copy(), left["bar_id"].to_numpy(np.int64).copy(), k)
        for data in right["tree"]:
            BallTree.unpacked(data).search(asked, own, best)
        q, ids, scores = best.rows
        return pd.DataFrame({"query_id": own[q], "vec_id": ids, "score": scores})

    def meet(asked: DataFrame) -> DataFrame:
        """asked: id, v, bar, bar_id, block, group."""
        met = asked.groupBy("block", "group").agg(F.count("*").alias("_")).select("block", "group")
        dealt = trees.join(met, "group").select(F.col("block").alias("b"), F.col("group").alias("g"), "tree")
        return asked.groupBy("block", "group").cogroup(dealt.groupBy("b", "g")).applyInPandas(search, "query_id long, vec_id long, score long")

    # First every block's home group, which gives its queries' bars; then all other groups.
    lowest = F.lit(-LARGEST - 1).cast("long"), F.lit(LARGEST).cast("long")
    found = materialize(meet(queries.select("id", "v", lowest[0].alias("bar"), lowest[1].alias("bar_id"), "block", F.col("home").alias("group"))), "first")
    if groups > 1:
        kth = F.when(F.count("*") >= k, F.max(F.struct((-F.col("score")).alias("score"), "vec_id")))
        bars = found.groupBy(F.col("query_id").alias("id")).agg(kth.alias("kth"))
        others = queries.join(bars, "id", "left").withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).where("group <> home")
        found = found.union(meet(others.select("id", "v", F.coalesce(-F.col("kth.score"), lowest[0]).alias("bar"), F.coalesce("kth.vec_id", lowest[1]).alias("bar_id"), "block", "group")))
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


ORACLE_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 20
"""
