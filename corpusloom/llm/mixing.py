"""Op 8, mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

Method: the mix is cut into blocks of `block` words. Highest quotients (target / (2 k - 1)) give
every source an integer number of blocks: all quotients of at least half a block get one, so the
house has the size that the targets add up to, rounded source by source. Highest quotients of words
then divide a source's blocks among its shards, and the words that a shard is too small for among its
others. In each shard the documents stand in a seeded order and the quota's blocks are read off that
stream, again from its start when it ends. So a document counts 0, 1 or 2 times, of which one count
may be partial.

Scale: nothing that grows with the number of sources reaches the driver. A source has one shard for
each `docs_per_shard` of its documents, chosen by a hash of the document: a hot source spreads over
many, a thin one keeps to one; the running sums that read off the blocks are per source and shard.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._scratch import materialize
from ._words import WORD


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_key(source: Column) -> Column:
    """A key without nulls, so that joins and windows on it share a partitioning; null has a key of its own."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def water_level(sources: DataFrame, total: float, most: float) -> float:
    """The level `unit` at which min(unit * w, most * words), summed over `sources` (w, words), is `total`;
    infinity if it never gets there.

    Rounds of one aggregation, of one row a weight, each: whatever a level fills stays full at the next,
    which is therefore higher. Sums are of integers, so reruns agree to the last bit.
    """
    unit, before = 0.0, -1
    while True:
        full = F.lit(unit) * F.col("w") > F.lit(most) * F.col("words")
        found = sources.where("words > 0").groupBy("w").agg(F.sum(F.when(full, F.col("words")).otherwise(0)).alias("full"), F.count_if(full).alias("n"), F.count_if(~full).alias("open")).orderBy("w").collect()
        filled, weight = sum(r["full"] for r in found), sum(r["w"] * r["open"] for r in found)
        if not weight:
            return float("inf")
        if before == (before := sum(r["n"] for r in found)):
            return unit
        unit = (total - most * filled) / weight


def sainte_lague(weights: np.ndarray, seats: int, caps: np.ndarray) -> np.ndarray:
    """Seats by highest quotients weight / (2 k - 1), at most caps[i] each; ties go to the lower index.

    Starts from what the divisor method surely gives (halves rounded down at a divisor that is a
    little too large) and hands out the rest one by one, so its cost doesn't grow with `seats`.
    """
    weights, caps = np.asarray(weights, float), np.asarray(caps, np.int64)
    seats = int(min(seats, caps[weights > 0].sum()))
    got = np.zeros(len(weights), np.int64)
    if seats <= 0:
        return got
    at = lambda d: np.where(weights > 0, np.minimum(caps, np.floor(weights / d + 0.5)).astype(np.int64), 0)
    low, high = weights[weights > 0].min() / (2 * seats + 2), 2 * weights.max() + 1
    for _ in range(200):  # the largest known divisor with too many seats, the smallest with at most enough
        mid = (low + high) / 2
        if mid in (low, high):
            break
        low, high = (mid, high) if at(mid).sum() > seats else (low, mid)
    got = at(high)
    queue = [(-weights[i] / (2 * got[i] + 1), i) for i in np.flatnonzero((weights > 0) & (got < caps))]
    heapq.heapify(queue)
    for _ in range(seats - int(got.sum())):
        _, i = heapq.heappop(queue)
        got[i] += 1
        if got[i] < caps[i]:
            heapq.heappush(queue, (-weights[i] / (2 * got[i] + 1), i))
    return got


def mix_sources(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    cycle: tuple[float, ...] = (3.0, 1.0, 2.0),
    weights: dict | None = None,
    share: float = 1.5,
    most: float = 2.0,
    block: int = 64,
    docs_per_shard: int = 1_000,
    seed: int = 17,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per row of `docs`: doc_id, source, size, source_size, target, quota, taken and `row` (struct of `keep`).

    Sources by code point, null last, weigh `cycle` in turn, or as `weights` says (1 where it says
    nothing); they share `share` times all words, each at most `most` times its own. taken: words
    of the document in the mix, repeats counted, at most `most` times its size. A source's taken
    words differ from its target by at most a block, however many shards it has. Null texts and texts
    without words take 0. Reruns with one seed agree: order is by a hash of seed, id and text; rows that
    repeat both share a shard. An empty table gives no rows. Kept columns lie in a struct and cannot clash
    with the result's.
    """
    text = F.col(text_col).cast("string")
    key = F.xxhash64(F.lit(seed), F.col(id_col).cast("string"), text)
    sized = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        source_key(F.col(source_col)).alias("skey"),
        n_words(text).alias("size"),
        key.alias("key"),
        F.struct(*[F.col(c) for c in keep] or [F.lit(None).cast("string").alias("none")]).alias("row"),
    )
    sized = materialize(sized, "sized")
    plan = materialize(_plan(sized, cycle=cycle, weights=weights, share=share, most=most, block=block, docs_per_shard=docs_per_shard), "plan")
    n, width = plan.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("skey")), F.lit(0))).first()
    # Broadcast up to a checked size; beyond it a join that adaptive execution splits where a source is hot.
    small = F.broadcast(plan) if n <= 100_000 and width <= 32 << 20 else plan
    dealt = sized.join(small, "skey").withColumn("shard", F.pmod(F.xxhash64("key", F.lit(1)), F.col("shards")).cast("int"))
    cells = dealt.groupBy("skey", "shard").agg(F.sum("size").alias("words"), F.first("quota").alias("quota"), F.first("target").alias("target"), F.first("shards").alias("shards"))

    def divide(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("shard", ignore_index=True)
        words = pdf["words"].to_numpy(np.int64)
        quota, target = int(pdf["quota"].iloc[0]), float(pdf["target"].iloc[0])
        caps = np.floor(words * most).astype(np.int64)
        budget = np.minimum(sainte_lague(words, quota, np.ceil(words * most / block)) * block, caps)
        # What caps cut off blocks goes, word by word, to the source's other shards; a source without a block takes its target's words.
        rest = (quota * block if quota else round(target)) - int(budget.sum())
        budget += sainte_lague(words, rest, caps - budget)
        return pd.DataFrame({"skey": pdf["skey"], "shard": pdf["shard"], "words": words, "budget": budget})

    # A source of one shard has nothing to divide.
    asked = F.when(F.col("quota") > 0, F.col("quota") * block).otherwise(F.rint("target").cast("long"))
    alone = cells.where("shards = 1").select("skey", "shard", "words", F.least(asked, F.floor(F.col("words") * most)).alias("budget"))
    blocks = cells.where("shards > 1").groupBy("skey").applyInPandas(divide, "skey string, shard int, words long, budget long")
    blocks = materialize(alone.unionByName(blocks), "blocks")
    # The running sums and the join with the blocks share one partitioning, so documents move once.
    stream = Window.partitionBy("skey", "shard").orderBy("key", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.withColumn("before", F.coalesce(F.sum("size").over(stream), F.lit(0))).join(blocks, ["skey", "shard"])
    budget = F.col("budget")
    rounds = F.when(F.col("words") > 0, F.floor(budget / F.col("words"))).otherwise(0)
    part = budget - rounds * F.col("words") - F.col("before")
    taken = rounds * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), part))
    return placed.select("doc_id", "source", "size", "source_size", "target", "quota", taken.cast("long").alias("taken"), "row")


def _plan(sized: DataFrame, *, cycle: tuple[float, ...], weights: dict | None, share: float, most: float, block: int, docs_per_shard: int) -> DataFrame:
    """Per source: skey, source_size, target, quota and shards."""
    per = sized.groupBy("skey", "source").agg(F.sum("size").alias("words"), F.count("*").alias("docs"))
    order = [F.col("source").isNull(), F.col("source")]
    # Places in the order of names: sizes of the ranges before, and the place within one's range.
    ranged = materialize(per.repartitionByRange(*order).withColumn("range", F.spark_partition_id()), "sources")
    sizes = ranged.groupBy("range").agg(F.count("*").alias("n"), F.sum("words").alias("words"))
    before = sizes.select("range", (F.sum("n").over(Window.orderBy("range")) - F.col("n")).alias("before"))  # one row a range
    place = F.row_number().over(Window.partitionBy("range").orderBy(*order)) - 1 + F.col("before")
    named = ranged.join(F.broadcast(before), "range").withColumn("place", place)
    if weights is None:
        w = F.element_at(F.array(*map(F.lit, map(float, cycle))), (F.col("place") % len(cycle) + 1).cast("int"))
    else:
        listed = [F.lit(x) for s, v in weights.items() if s is not None for x in (s, float(v))]
        own = F.create_map(*listed)[F.col("source")] if listed else F.lit(None).cast("double")
        w = F.when(F.col("source").isNull(), F.lit(float(weights.get(None, 1.0)))).otherwise(F.coalesce(own, F.lit(1.0)))
    named = materialize(named.select("skey", "words", "docs", w.alias("w")), "weights")
    total = share * (named.agg(F.sum("words")).first()[0] or 0)
    unit = water_level(named, total, most)
    own = F.lit(most) * F.col("words")
    target = F.when(F.col("words") > 0, F.least(F.lit(unit) * F.col("w"), own) if unit != float("inf") else own).otherwise(0.0)
    quota = F.least(F.floor(target / block + 0.5), F.ceil(own / block)).cast("long")
    shards = F.greatest(F.lit(1), F.ceil(F.col("docs") / docs_per_shard)).cast("int")
    return named.select("skey", F.col("words").alias("source_size"), target.alias("target"), quota.alias("quota"), shards.alias("shards"))


def mixing_digest(mixed: DataFrame) -> DataFrame:
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def write_out(mixed: DataFrame, text: str = "row.text") -> DataFrame:
    """The mix itself: `doc_id`, `copy` (from 0) and the first words of the text that this copy has.

    A whole copy is the unchanged text; a partial one keeps the text up to its last word taken.
    """
    copies = mixed.where("taken > 0").withColumn("copy", F.explode(F.sequence(F.lit(0), ((F.col("taken") - 1) / F.col("size")).cast("int"))))
    words = F.least(F.col("size"), F.col("taken") - F.col("copy") * F.col("size"))
    cut = F.when(words >= F.col("size"), F.col(text)).otherwise(F.array_join(F.slice(F.regexp_extract_all(text, F.lit("[\\x20\\x09-\\x0D]*" + WORD), F.lit(0)), F.lit(1), words.cast("int")), ""))
    return copies.select("doc_id", "copy", cut.alias("text"), "row")
