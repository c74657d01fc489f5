"""The corpus pipeline: clean, language, quality, deduplication, metadata, and its funnel."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import dedup, language, quality


@dataclass(frozen=True)
class CorpusConfig:
    clean: T.CleanConfig = field(default_factory=T.CleanConfig)
    quality: quality.QualityConfig = field(default_factory=quality.QualityConfig)
    min_confidence: float = 0.10
    languages: tuple[str, ...] = ()
    n_hashes: int = 128
    n_bands: int = 16
    shingle: int = 5

    @staticmethod
    def worker() -> CorpusConfig:
        """The queue worker's settings, laxer than the library's."""
        return CorpusConfig(clean=T.CleanConfig(min_chars=30), quality=quality.QualityConfig(min_score=0.40, min_words=10), min_confidence=0.05)


STAGES = ("total_input", "after_cleaning", "after_language_filter", "after_quality_filter", "after_dedup")


def judge(docs: DataFrame, profiles: DataFrame, config: CorpusConfig = CorpusConfig(), *, hook=None) -> DataFrame:
    """Every document with its measures and `stage`, the number of stages that it passed (1: input only, 5: kept).

    doc_id is the arrival order. `hook` maps the DataFrame before the first stage.
    """
    docs = hook(docs) if hook else docs
    cleaned = T.clean(docs, config.clean, title_col="title" if "title" in docs.columns else None)
    rows = language.with_language(cleaned.drop("text"), profiles, text_col="clean_text")
    rows = rows.withColumns(quality.counts(F.col("clean_text")))
    rows = rows.withColumn("quality_score", quality.score(config.quality)).withColumn("lang_confidence", F.round(F.col("best") / F.nullif("total", F.lit(0)), 4))
    good_language = language.language_gate(F.col("language"), F.col("best"), F.col("total"), min_confidence=config.min_confidence, allowed=config.languages)
    stage = F.when(F.col("clean_text").isNull(), 1).when(~F.coalesce(good_language, F.lit(False)), 2).when(~quality.gate(config.quality), 3).otherwise(4)
    rows = dedup._checkpoint(rows.withColumn("stage", stage))
    kept = dedup.lsh_keep(rows.where("stage = 4"), text_col="clean_text", n_hashes=config.n_hashes, n_bands=config.n_bands, shingle=config.shingle).where("kept").select(F.col("id").alias("doc_id"), F.lit(5).alias("last"))
    return rows.join(kept, "doc_id", "left").withColumn("stage", F.coalesce("last", "stage")).drop("last")


def kept(judged: DataFrame) -> DataFrame:
    return judged.where("stage = 5")


def funnel(judged: DataFrame) -> DataFrame:
    """One row: documents that reached each stage."""
    return judged.agg(*[F.count_if(F.col("stage") >= i).alias(n) for i, n in enumerate(STAGES, 1)])


def corpus_rows(judged: DataFrame) -> DataFrame:
    """Kept documents as shard rows, metadata included."""
    docs = kept(judged).withColumnRenamed("clean_text", "text")
    return T.metadata_record(docs.select("*", *T.counters(F.col("text"))), text_col="text")


def report(row) -> str:
    """A boxed text of a funnel row."""
    lines = [f"  {n.replace('_', ' ').capitalize():<24}: {row[n]:>12,}" for n in STAGES]
    wide = max(map(len, lines)) + 2
    return "\n".join(["+" + "-" * wide + "+", *("|" + x.ljust(wide) + "|" for x in lines), "+" + "-" * wide + "+"])
