"""Stages of the corpus pipeline over `documents`: quality, near duplicates, secrets, mixing, packing.

Every stage takes (spark, docs, sf_dir), works on all that the one before it kept, and all but the
last return the columns of documents, so that other columns, whatever their names, end at the first.
`run` writes each stage's result as Parquet in the shared folder and reads it again as the next one's
input. Every stage gives no rows for an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import table
from . import mixing, neardup, packing, quality, secrets
from ._scratch import materialize, release

#: Stands for a null id where ids are compared.
NO_ID = (1 << 63) - 1
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line CRF scores at least 0.5; fitted on labelled documents outside the held-out third.

    A null text counts as an empty one and goes if empty ones do; repeated rows go or stay together; a null
    in another column changes nothing.
    """
    model = quality.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), usable=lambda c: quality.remainder(c, 3) != 1)
    return quality.classify(docs, model, keep=COLUMNS).where("score >= 0.5").select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (five-word shingles, similarity 0.8): the one of smallest id.

    Texts without a word, null ones included, belong to no group and stay. Of rows that repeat id and
    text one stays, that of the smallest source and language. A null id comes after all others.
    """
    found = neardup.near_duplicates(docs, k=5, threshold=0.8)
    # A group's document by its id and text; of rows that repeat both, one stays.
    chosen = found.where("n_shingles > 0").groupBy("group_id").agg(F.min(F.struct(F.coalesce("doc_id", F.lit(NO_ID)).alias("at"), "text_hash")).alias("c")).select("c.at", "c.text_hash")
    worded = F.col("text").rlike("[^\\x20\\x09-\\x0D]")
    named = docs.where(worded).select(*COLUMNS, F.coalesce("doc_id", F.lit(NO_ID)).alias("at"), F.xxhash64("text").alias("text_hash"))
    first = F.row_number().over(Window.partitionBy("at", "text_hash").orderBy("source", "lang"))
    one = named.join(chosen, ["at", "text_hash"]).withColumn("first", first).where("first = 1").select(*COLUMNS)
    return one.unionByName(docs.where(~worded | F.col("text").isNull()).select(*COLUMNS))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; a mark replaces every span of a secret that looks live. Values that three or more sources
    hold are widely copied examples and stay.

    A null text becomes an empty one; a null source is a source of its own; repeated rows are redacted alike.
    """
    found = secrets.find_secrets(docs, keep=COLUMNS)
    text = secrets.redacted(F.col("row.text"), F.col("spans"))
    return found.select("doc_id", text.alias("text"), "row.lang", "row.source", F.length(text).cast("long").alias("n_chars"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a document once per copy that it takes, a partial copy cut after its last word taken.

    Documents without a word, null texts included, take no part; a null source comes last; rows that repeat
    an id and a text are documents of their own.
    """
    mixed = mixing.mix_sources(docs, keep=COLUMNS)
    copies = mixing.write_out(mixed)
    return copies.select("doc_id", "text", "row.lang", "row.source", F.length("text").cast("long").alias("n_chars"))


#: Capacities of a sequence besides its 2048 tokens: documents, and attention cost (sum of squared lengths) of
#: three quarters of a full one's. A piece whose own cost is above that has a sequence to itself.
MAX_DOCS, MAX_COST = 16, 0.75 * 2048**2


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens, `MAX_DOCS` documents and `MAX_COST` attention cost: a row per piece with its ids.

    A null text is an empty one, of the end token alone; repeated rows are packed as often as they occur.
    """
    return packing.pack_documents(docs, max_docs=MAX_DOCS, max_cost=MAX_COST)


STAGES = [
    ("quality classifier", keep_good),
    ("MinHash near-dedup", drop_near_duplicates),
    ("secret scans", redact_secrets),
    ("mixing sources", mix),
    ("best-fit packing", pack),
]

#: Trained models and tokenizers are beyond SQL; tests hold every stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if i == len(STAGES) - 1:
            return out
        written = materialize(out, f"stage{i}")
        release(docs)
        docs = written
    return docs
