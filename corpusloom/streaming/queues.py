"""Queues as Structured Streaming: directories of JSON lines in, tables out (SRC-1..4, STR-1..11, SNK-4..6).

An available-now trigger ends a run when the queue is drained (idle shutdown), maxFilesPerTrigger is
the backpressure, and the checkpoint makes every message count once, which a reliable queue
approximates. A query stops after the batch it is in (`stop_gracefully`); `Progress` keeps its counts and rate.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..operators import html, urls
from ..sources import shards


def lines(spark: SparkSession, folder: str, *, files_per_trigger: int = 500) -> DataFrame:
    return spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(folder)


def consume_texts(spark: SparkSession, queue: str, out: str, dead: str, checkpoint: str, *, files_per_trigger: int = 500) -> StreamingQuery:
    """clean_text_queue -> documents (Parquet) and dead letters (JSON)."""

    def batch(rows: DataFrame, number: int) -> None:
        parsed = shards.parse_messages(rows, required="text").persist()
        # Folders by batch and overwriting: a batch that is repeated after a failure counts once.
        shards.message_documents(parsed).write.mode("overwrite").parquet(f"{out}/batch={number}")
        shards.dead_letters(parsed).write.mode("overwrite").json(f"{dead}/batch={number}")
        parsed.unpersist()

    return lines(spark, queue, files_per_trigger=files_per_trigger).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def extract_pages(spark: SparkSession, queue: str, out: str, dead: str, checkpoint: str, *, files_per_trigger: int = 20) -> StreamingQuery:
    """html_queue -> clean_text_queue (JSON lines url, title, text) and dead letters."""

    def batch(rows: DataFrame, number: int) -> None:
        parsed = shards.parse_messages(rows, required="html").persist()
        tried = html.try_extract(parsed.where("reason is null").select("m.url", "m.html")).persist()
        tried.where("text is not null").select("url", "title", "text").write.mode("overwrite").json(f"{out}/batch={number}")
        broken = tried.where("failed").select(F.lit("extractor_exception").alias("reason"), (F.unix_micros(F.current_timestamp()) / 1e6).alias("timestamp"), F.lit(None).cast("string").alias("raw"), "url")
        shards.dead_letters(parsed).unionByName(broken).write.mode("overwrite").json(f"{dead}/batch={number}")
        tried.unpersist()
        parsed.unpersist()

    return lines(spark, queue, files_per_trigger=files_per_trigger).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


class Progress(StreamingQueryListener):
    """Batches, rows and rows a second of every query of a session, by the query's id; register with spark.streams.addListener (STR-10, AGG-12)."""

    def __init__(self):
        self.seen: dict[str, dict] = {}

    def onQueryStarted(self, event) -> None:
        self.seen[str(event.id)] = {"batches": 0, "rows": 0, "rows_per_second": 0.0, "ended": False}

    def onQueryProgress(self, event) -> None:
        p = event.progress
        mine = self.seen.setdefault(str(p.id), {"batches": 0, "rows": 0, "rows_per_second": 0.0, "ended": False})
        mine["batches"] += 1
        mine["rows"] += p.numInputRows
        mine["rows_per_second"] = p.processedRowsPerSecond

    def onQueryIdle(self, event) -> None:
        return

    def onQueryTerminated(self, event) -> None:
        self.seen.setdefault(str(event.id), {})["ended"] = True


def stop_gracefully(query: StreamingQuery, wait: float = 0.2) -> None:
    """Ends a query between two batches, so that none is cut off (STR-2)."""
    while query.isActive and query.status["isTriggerActive"]:
        time.sleep(wait)
    query.stop()


def generate_frontier(spark: SparkSession, queue: str, seen: str, checkpoint: str, *, files_per_trigger: int = 500, counters: list | None = None) -> StreamingQuery:
    """seeds_urls_queue (a URL a line) -> the table `seen` (normalized, fp) of distinct valid URLs, over all batches.

    `seen` lies in folders by the first two digits of fp, so that a batch reads those that its own URLs fall into.
    `counters` gets a dict of popped, valid, skipped and pushed per batch (STR-8).
    """

    def batch(rows: DataFrame, number: int) -> None:
        found = urls.canonicalize(rows.select(F.col("value").alias("url"))).select("normalized", "fp").persist()
        new = found.where("normalized is not null").dropDuplicates(["fp"]).withColumn("bucket", F.substring("fp", 1, 2))
        if number:
            schema = "normalized string, fp string, bucket string, batch long"
            buckets = [r["bucket"] for r in new.select("bucket").distinct().collect()]  # at most 256
            before = spark.read.schema(schema).option("basePath", seen).parquet(seen).where(F.col("bucket").isin(buckets) & (F.col("batch") != number))
            new = new.join(before.select("fp"), "fp", "left_anti").select("normalized", "fp", "bucket")
        new.write.mode("overwrite").partitionBy("bucket").parquet(f"{seen}/batch={number}")
        if counters is not None:
            n, valid = found.agg(F.count("*"), F.count("normalized")).first()
            pushed = spark.read.schema("normalized string, fp string, bucket string").parquet(f"{seen}/batch={number}").count() if valid else 0
            counters.append({"popped": n, "valid": valid, "skipped": n - pushed, "pushed": pushed})
        found.unpersist()

    return lines(spark, queue, files_per_trigger=files_per_trigger).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
