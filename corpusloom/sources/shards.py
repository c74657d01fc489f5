"""Scans of corpus shards and queue messages (SRC-1..8) and their sinks (of SNK-1..6).

Left out: the writer of token shards (SNK-3) and the sink of failed URLs (SNK-6).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, LongType, StringType, StructField, StructType

from ..functions.text import corpus_normalize

#: Fixed value: columns of a corpus shard.
SHARD = StructType(
    [StructField(n, StringType()) for n in ("doc_id", "text", "source", "language")]
    + [StructField(n, FloatType()) for n in ("lang_confidence", "quality_score")]
    + [StructField(n, LongType()) for n in ("char_count", "word_count", "token_estimate")]
    + [StructField("metadata_json", StringType())]
)
MESSAGE = StructType([StructField(n, StringType()) for n in ("id", "url", "source", "title", "text", "html", "_corrupt")])
DEAD_LETTER = StructType([StructField("reason", StringType()), StructField("timestamp", DoubleType()), StructField("raw", StringType()), StructField("url", StringType())])


def read_shards(spark: SparkSession, folder: str, *, ignore_corrupt: bool = True) -> DataFrame:
    """Parquet shards of a folder; unreadable files are skipped if asked for."""
    return spark.read.schema(SHARD).option("ignoreCorruptFiles", ignore_corrupt).option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").parquet(folder)


def read_texts(spark: SparkSession, folder: str, *, min_chars: int = 1, max_chars: int = 1_000_000, dedupe: bool = False) -> DataFrame:
    """Normalized texts (one column is read), by length, optionally distinct."""
    text = read_shards(spark, folder).where("text is not null and text <> ''").select(corpus_normalize(F.col("text")).alias("text"))
    text = text.where(F.length("text").between(min_chars, max_chars))
    return text.dropDuplicates() if dedupe else text


def count_texts(docs: DataFrame, *, chars_col: str = "char_count", min_chars: int = 50, max_chars: int = 1_000_000) -> DataFrame:
    """n: rows by their stored length, without reading any text (AGG-2)."""
    return docs.where(F.col(chars_col).between(min_chars, max_chars)).agg(F.count("*").alias("n"))


def read_with_metadata(spark: SparkSession, folder: str) -> DataFrame:
    """text and a map of metadata: the JSON's fields (none where malformed), then source, language and score."""
    rows = read_shards(spark, folder).select("text", "source", "language", "quality_score", "metadata_json")
    parsed = F.coalesce(F.from_json("metadata_json", "map<string,string>"), F.expr("map()").cast("map<string,string>"))
    own = F.create_map(F.lit("source"), F.col("source"), F.lit("language"), F.col("language"), F.lit("quality_score"), F.col("quality_score").cast("string"))
    return rows.select("text", F.map_concat(F.map_filter(parsed, lambda k, v: ~k.isin("source", "language", "quality_score")), own).alias("metadata"))


def first_texts(docs: DataFrame, n: int, *, order: tuple[str, ...] = ("doc_id",), text_col: str = "text", min_chars: int = 50) -> DataFrame:
    """The first `n` rows in shard order (`order`) whose text has at least `min_chars` characters (AGG-11, LIM-1)."""
    return docs.where(F.length(text_col) >= min_chars).orderBy(*order).limit(n)


def corpus_rollup(docs: DataFrame, by: str) -> DataFrame:
    """docs, chars and tokens per value of `by`, and over all (`by` null) (AGG-4)."""
    return docs.groupingSets([[by], []], by).agg(F.count("*").alias("docs"), F.sum("char_count").alias("chars"), F.sum("token_estimate").alias("tokens"))


def shard_order(spark: SparkSession, folder: str, *, seed: int | None = None) -> DataFrame:
    """Shard files by name, or in a seeded order."""
    files = read_shards(spark, folder).select(F.input_file_name().alias("file")).distinct()
    return files.orderBy("file" if seed is None else F.xxhash64("file", F.lit(seed)))


def shard_stats(docs: DataFrame, shard: Column) -> DataFrame:
    """Per shard: docs, chars, words, tokens, mean chars and documents per language."""
    by = docs.groupBy(shard.alias("shard"), "language").agg(F.count("*").alias("n"), F.sum("char_count").alias("c"), F.sum("word_count").alias("w"), F.sum("token_estimate").alias("t"))
    langs = F.map_from_entries(F.sort_array(F.filter(F.collect_list(F.struct("language", "n")), lambda x: x["language"].isNotNull() & (x["language"] != ""))))
    out = by.groupBy("shard").agg(F.sum("n").alias("docs"), F.sum("c").alias("chars"), F.sum("w").alias("words"), F.sum("t").alias("tokens"), langs.alias("languages"))
    return out.withColumn("mean_chars", F.round(F.col("chars") / F.greatest("docs", F.lit(1))))


def write_shards(docs: DataFrame, folder: str, *, shard_size: int = 10_000, level: int = 3, fmt: str = "parquet") -> None:
    """Parquet (zstd) or gzipped JSON lines, at most `shard_size` rows a file."""
    rows = docs.select(*[F.col(f.name).cast(f.dataType) for f in SHARD])
    writer = rows.write.option("maxRecordsPerFile", shard_size)
    if fmt == "parquet":
        writer.option("compression", "zstd").option("parquet.compression.codec.zstd.level", level).parquet(folder)
    else:
        writer.option("compression", "gzip").json(folder)


def parse_messages(lines: DataFrame, *, required: str = "text", value_col: str = "value") -> DataFrame:
    """Adds `m` (parsed message) and `reason`: null for a good one, else why it goes to the dead letters."""
    m = F.from_json(F.col(value_col), MESSAGE, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    bad = F.col("m").isNull() | F.col("m._corrupt").isNotNull() | (F.length(F.trim(F.coalesce(F.col(f"m.{required}"), F.lit("")))) == 0)
    return lines.withColumn("m", m).withColumn("reason", F.when(bad, f"invalid_json_or_missing_{required}"))


def dead_letters(parsed: DataFrame, value_col: str = "value") -> DataFrame:
    """Rows for the dead-letter sink; raw payloads are cut at 2,000 characters."""
    return parsed.where("reason is not null").select("reason", (F.unix_micros(F.current_timestamp()) / 1e6).alias("timestamp"), F.substring(value_col, 1, 2000).alias("raw"), F.col("m.url").alias("url"))


def message_documents(parsed: DataFrame) -> DataFrame:
    """doc_id, source, title, text of the good messages: source = url, else source, else 'redis'; id = its own or a hash."""
    text = F.regexp_replace("m.text", "^\\s+|\\s+$", "")
    return parsed.where("reason is null").select(F.coalesce("m.id", F.substring(F.sha2(text, 256), 1, 16)).alias("doc_id"), F.coalesce(F.nullif("m.url", F.lit("")), "m.source", F.lit("redis")).alias("source"), F.coalesce("m.title", F.lit("")).alias("title"), text.alias("text"))
