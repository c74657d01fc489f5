"""Op 6, sharding: vector bin packing of documents into shards.

Method: the vectors (bytes, tokens, rows) are balanced jointly. Items come largest first and each
goes to the shard where the dot product of its vector with the shard's residual capacity (both as
shares of the total) is highest.

Groups of equal texts stay together. At any scale the driver places only a bounded number of
items: light groups are hashed into ``bundles`` (a group never leaves its bundle), and a group
larger than a bundle's share in any dimension is an item of its own, at most three times
``n_shards * bundles_per_shard`` of them; a group that is more than `split_share` of a shard, and only
such a one, is split by document into chunks of about that size, as one third of all rows may be one
text. The placement table is broadcast; its size has that bound too.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._scratch import materialize, release
from ._words import WORD


def text_bytes(text: Column) -> Column:
    """UTF-8 bytes of the text (null: none) plus 8."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 8


def place(items: np.ndarray, n_shards: int, weights: tuple[float, float, float] = (2.0, 1.0, 1.0)) -> np.ndarray:
    """Shard of each item. items: n x 3 (bytes, tokens, rows). Ties go to the lower shard.

    `weights` are those of the dimensions in the dot product: bytes, whose balance is promised, count double.
    """
    total = np.maximum(items.sum(axis=0, dtype=np.float64), 1)
    share = items / total
    residual = np.full((n_shards, items.shape[1]), 1 / n_shards)
    out = np.zeros(len(items), np.int64)
    for i in np.lexsort((np.arange(len(items)), -share.max(axis=1))):
        best = int(np.argmax(residual @ (share[i] * weights)))
        out[i] = best
        residual[best] -= share[i]
    return out


def chunk_of(chunks: str) -> Column:
    return F.pmod(F.xxhash64("doc_id", F.lit(3)), F.col(chunks).cast("long")).cast("int")


def assign_shards(
    docs: DataFrame,
    *,
    n_shards: int = 24,
    id_col: str = "doc_id",
    text_col: str = "text",
    bundles_per_shard: int = 256,
    split_share: float = 1 / 2,
    slot_parts: int | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per row of `docs`: doc_id, size, text_crc32, shard, slot, and `row` (struct of `keep`).

    size: UTF-8 bytes plus 8; slot: place in the shard, gapless from 0, by a hash of the document
    and then its id, so that a shard's order is unrelated to its sources. A text's rows share a
    shard unless they make up more than `split_share` of a shard's bytes, words or rows. Null texts are one group, of 8
    bytes a row. Repeated rows keep their number. An empty table gives no rows. Kept columns lie in a struct
    and cannot clash with the result's.
    """
    text = F.col(text_col).cast("string")
    base = docs.select(
        F.col(id_col).alias("doc_id"),
        text_bytes(text).alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.xxhash64(text, F.lit(1)).alias("gid"),
        F.struct(*[F.col(c) for c in keep] or [F.lit(None).cast("string").alias("none")]).alias("row"),
    )
    measured = docs.select(F.xxhash64(text, F.lit(1)).alias("gid"), text_bytes(text).alias("size"), F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("tokens"))
    n_bundles = n_shards * bundles_per_shard
    bundle = F.pmod(F.xxhash64("gid", F.lit(2)), F.lit(n_bundles)).cast("int")
    groups = measured.groupBy("gid").agg(F.sum("size").alias("b"), F.sum("tokens").alias("t"), F.count("*").alias("r"), F.lit(0).alias("_")).drop("_")
    groups = materialize(groups, "groups")
    b, t, r = (float(x or 0) for x in groups.agg(F.sum("b"), F.sum("t"), F.sum("r")).first())
    share = F.greatest(F.col("b") / max(b, 1), F.col("t") / max(t, 1), F.col("r") / max(r, 1))
    # Each heavy group has over 1/n_bundles of the bytes, tokens or rows: at most 3 * n_bundles of them.
    heavy = share > 1 / n_bundles
    own = groups.where(heavy).select("gid", "b", "t", "r", F.when(share * n_shards > split_share, F.least(F.col("r"), F.ceil(share * n_shards / split_share))).otherwise(1).cast("int").alias("chunks")).orderBy("gid").collect()
    light = groups.where(~heavy).groupBy(bundle.alias("item")).agg(F.sum("b").alias("b"), F.sum("t").alias("t"), F.sum("r").alias("r")).orderBy("item").collect()
    spark = docs.sparkSession
    # A split group's chunks by their real rows; its texts are equal, so bytes and tokens follow.
    cut = [(x["gid"], x["chunks"]) for x in own if x["chunks"] > 1]
    rows: dict[tuple[int, int], int] = {}
    if cut:
        counted = base.join(F.broadcast(spark.createDataFrame(cut, "gid long, chunks int")), "gid").groupBy("gid", chunk_of("chunks").alias("chunk")).count()
        rows = {(x["gid"], x["chunk"]): x["count"] for x in counted.collect()}
    names, vectors, splits, at = [], [], [], n_bundles
    for x in light:
        names.append(x["item"])
        vectors.append((x["b"], x["t"], x["r"]))
    for x in own:
        splits.append((x["gid"], at, x["chunks"]))
        names += range(at, at + x["chunks"])
        for k in range(x["chunks"]):
            own_share = rows.get((x["gid"], k), 0) / x["r"] if x["chunks"] > 1 else 1
            vectors.append((x["b"] * own_share, x["t"] * own_share, x["r"] * own_share))
        at += x["chunks"]
    release(groups)
    shards = place(np.asarray(vectors, float).reshape(-1, 3), n_shards)
    placed = spark.createDataFrame(list(zip(map(int, names), map(int, shards), strict=True)), "item int, shard int")
    split = spark.createDataFrame(splits, "gid long, first int, chunks int")

    # Both tables have a proven bound: 3 * n_bundles groups and n_bundles + 3 * n_bundles + 3 * n_shards / split_share items.
    chunk = F.col("first") + chunk_of("chunks")
    sharded = base.join(F.broadcast(split), "gid", "left").withColumn("item", F.coalesce(chunk, bundle)).join(F.broadcast(placed), "item")
    # An order within the shard from many small sorts: sub-buckets by hash, and their sizes added up.
    parts = slot_parts or max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    sharded = sharded.withColumn("part", F.pmod(F.xxhash64("doc_id", "text_crc32", F.lit(4)), F.lit(parts)).cast("int"))
    sizes = sharded.groupBy("shard", "part").agg(F.count("*").alias("n"))
    before = sizes.select("shard", "part", (F.sum("n").over(Window.partitionBy("shard").orderBy("part")) - F.col("n")).alias("before"))
    order = Window.partitionBy("shard", "part").orderBy("doc_id", "text_crc32", "size")
    ranked = sharded.withColumn("within", F.row_number().over(order) - 1)
    return ranked.join(F.broadcast(before), ["shard", "part"]).select("doc_id", "size", "text_crc32", "shard", (F.col("before") + F.col("within")).cast("long").alias("slot"), "row")


def sharding_digest(sharded: DataFrame) -> DataFrame:
    """The law that holds is `bytes`: sizes near equal; no promise for another number of shards."""
    return sharded.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def write_shards(sharded: DataFrame, path: str) -> None:
    """Files of a sharding made with `keep`: one folder a shard, rows by slot."""
    out = sharded.select("shard", "slot", "row.*") if "slot" not in sharded.schema["row"].dataType.names else sharded.select("shard", "slot", "row")
    out.repartition("shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
