"""Tokenizer operators over public vocabularies (TOK-4..14, AGG-5..10, EXP-1..6, SNK-3, SNK-7).

Tokenizers are never trained here: a tokenizer is a JSON file of the `tokenizers` library, given by path.
"""

from __future__ import annotations

import hashlib
import json
import os
import time
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf, pandas_udf
from pyspark.sql.types import ArrayType, IntegerType, StringType

from ..functions.slices import mapped, parts
from ..scratch import materialize

_loaded: dict = {}

#: Strings on which every tokenizer is tried.
EDGE_CASES = (
    ("english_prose", "ICANN coordinates the Internet Assigned Numbers Authority functions."),
    ("numbers_dates", "The organization was founded on September 18 1998 with 2500 employees."),
    ("urls_domains", "Visit https://www.icann.org/resources/pages/dnssec-2012-02-25-en for details."),
    ("punctuation", "Hello, world! This is a test: does it work? Yes — it does (probably)."),
    ("acronyms", "ICANN IANA DNS DNSSEC WHOIS GDPR TLD gTLD ccTLD IDN IPv4 IPv6"),
    ("long_word", "internationalization supercalifragilisticexpialidocious telecommunications"),
    ("kinyarwanda", "Inama y'Umuryango w'Abibumbye yateranye i Kigali mu mwaka wa 2024."),
    ("swahili", "Shirika la Kimataifa la Mawasiliano linasimamia mifumo ya majina ya kikoa."),
    ("french", "L'ICANN coordonne les systèmes d'identification uniques de l'internet mondial."),
    ("single_word", "internet"),
    ("two_words", "domain name"),
    ("empty_string", ""),
    ("unicode_mixed", "café résumé naïve Ångström 中文 العربية हिन्दी"),
    ("numbers_only", "1234567890 3.14159 1,000,000 +250 788 123 456"),
)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def load(path: str):
    """The tokenizer, loaded once per process; a missing file is a FileNotFoundError."""
    if path not in _loaded:
        from tokenizers import Tokenizer

        if not os.path.exists(path):
            raise FileNotFoundError(path)
        _loaded[path] = Tokenizer.from_file(path)
    return _loaded[path]


def encoded(path: str, texts: list[str | None], *, special: bool = False) -> list:
    """The library's encodings, some hundred bytes a token: only ever of a part of a batch."""
    return load(path).encode_batch_fast([x or "" for x in texts], add_special_tokens=special)


def encode_udf(path: str, *, max_length: int | None = None, special: bool = False):
    def ids(texts: list[str | None]) -> pa.Array:
        got = [np.array(e.ids[:max_length], np.int32) for e in encoded(path, texts, special=special)]
        return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, got)]), pa.int32()), pa.array(np.concatenate(got)))

    @arrow_udf(ArrayType(IntegerType()))
    def encode(text: pa.Array) -> pa.Array:
        return mapped(text, ids, pa.list_(pa.int32()))

    return encode


def count_udf(path: str, *, special: bool = False):
    """Number of tokens; the ids stay in the worker.

    It is marked as not deterministic only so that no filter on its result runs it a second time.
    """

    @arrow_udf(IntegerType())
    def count(text: pa.Array) -> pa.Array:
        return mapped(text, lambda texts: pa.array([len(e) for e in encoded(path, texts, special=special)], pa.int32()), pa.int32())

    return count.asNondeterministic()


def decode_udf(path: str):
    @pandas_udf(StringType())
    def decode(ids: pd.Series) -> pd.Series:
        tok = load(path)
        return ids.map(lambda x: tok.decode([int(i) for i in x], skip_special_tokens=True))

    return decode


def tokenize_udf(path: str):
    @pandas_udf(ArrayType(StringType()))
    def tokenize(text: pd.Series) -> pd.Series:
        return pd.Series([e.tokens for e in load(path).encode_batch([x or "" for x in text], add_special_tokens=False)])

    return tokenize


def batches(rows: DataFrame, *, order_col: str, size: int = 32, drop_last: bool = False) -> DataFrame:
    """Adds batch_id (from 0): consecutive groups of `size` in the order of `order_col`, whose values are distinct.

    Row numbers come from counts per range partition and a number within each, so no task holds all rows.
    """
    ranged = rows.repartitionByRange(F.col(order_col)).withColumn("_p", F.spark_partition_id())
    ranged = ranged.sortWithinPartitions("_p", order_col)
    from .dedup import _checkpoint

    ranged = _checkpoint(ranged)
    counts = ranged.groupBy("_p").agg(F.count("*").alias("n"))
    before = counts.select("_p", (F.sum("n").over(Window.orderBy("_p")) - F.col("n")).alias("before"))
    number = F.row_number().over(Window.partitionBy("_p").orderBy(order_col)) - 1
    out = ranged.withColumn("_i", number).join(F.broadcast(before), "_p").withColumn("batch_id", F.floor((F.col("_i") + F.col("before")) / size)).drop("_p", "_i", "before")
    if drop_last:
        full = out.groupBy("batch_id").agg(F.count("*").alias("n")).where(F.col("n") == size).select("batch_id")
        out = out.join(full, "batch_id", "left_semi")
    return out


def pad(rows: DataFrame, *, ids_col: str = "ids", pad_id: int = 0, batch_col: str = "batch_id") -> DataFrame:
    """Adds input_ids, attention_mask, labels (-100 at pads), length and padded_length (the batch's longest)."""
    longest = F.max(F.size(ids_col)).over(Window.partitionBy(batch_col))
    fill = F.col("padded_length") - F.col("length")
    out = rows.withColumn("length", F.size(ids_col)).withColumn("padded_length", longest)
    ones, zeros = F.array_repeat(F.lit(1).cast("tinyint"), F.col("length")), F.array_repeat(F.lit(0).cast("tinyint"), fill)
    return out.withColumns({"input_ids": F.concat(ids_col, F.array_repeat(F.lit(pad_id), fill)), "attention_mask": F.concat(ones, zeros), "labels": F.concat(ids_col, F.array_repeat(F.lit(-100), fill))})


def unk_id(path: str) -> int | None:
    """Id of the unknown token, if the vocabulary has one."""
    model = load(path)
    return next((i for i in map(model.token_to_id, ("<unk>", "[UNK]")) if i is not None), None)


def properties(path: str) -> dict:
    """vocab_size and the ids of the pad, bos, eos and unk tokens; None where there is none (TOK-11)."""
    tok = load(path)
    named = {"pad_id": ("<pad>", "[PAD]"), "bos_id": ("<bos>", "<s>", "<|endoftext|>"), "eos_id": ("<eos>", "</s>", "<|endoftext|>")}
    found = {k: next((i for i in map(tok.token_to_id, names) if i is not None), None) for k, names in named.items()}
    return {"vocab_size": tok.get_vocab_size(), **found, "unk_id": unk_id(path)}


def metrics(docs: DataFrame, path: str, *, text_col: str = "text", lang_col: str = "lang", vocab_size: int | None = None) -> DataFrame:
    """Per language and overall (language null): docs, words, chars, tokens, unks, unique tokens and the ratios of these.

    Texts are encoded once: each part of an Arrow batch gives its sums and its counts by token, and only these are shuffled.
    """
    unknown = unk_id(path)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["language", "id", *sums]
        for batch in batches:
            at = 0
            for every in parts(batch.column(1)):
                langs = batch.column(0).slice(at, len(every)).to_pylist()
                at += len(every)
                for lang in sorted(set(langs)):
                    texts = [t for t, own in zip(every, langs, strict=True) if own == lang]
                    found, n = np.unique(np.concatenate([np.array(e.ids, np.int64) for e in encoded(path, texts)]), return_counts=True)
                    none = np.zeros(len(n), np.int64)
                    rows = [found, none, none, none, n, np.where(found == (-1 if unknown is None else unknown), n, 0)]
                    whole = [-1, len(texts), sum(len(x.split()) for x in texts), sum(map(len, texts)), 0, 0]
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * (len(n) + 1), pa.string()), *(pa.array(np.append(c, x), pa.int64()) for c, x in zip(rows, whole, strict=True))], names=names)

    sums = ("docs", "words", "chars", "tokens", "unks")
    lang = F.coalesce(F.nullif(F.col(lang_col), F.lit("")), F.lit("unknown"))
    rows = docs.where(F.length(text_col) > 0).select(lang.alias("language"), F.col(text_col).alias("text"))
    counted = rows.mapInArrow(count, "language string, id long, docs long, words long, chars long, tokens long, unks long")
    # One row a language and token.
    counted = materialize(counted.groupBy("language", "id").agg(*[F.sum(c).alias(c) for c in sums]), "tokens")
    unique = F.countDistinct(F.when(F.col("id") >= 0, F.col("id"))).alias("unique_tokens")
    out = counted.groupingSets([["language"], []], "language").agg(*[F.sum(c).alias(c) for c in sums], unique)
    ratio = lambda a, b, n: F.round(F.col(a) / F.greatest(F.col(b), F.lit(1)), n)
    size = vocab_size or load(path).get_vocab_size()
    out = out.withColumns({"fertility": ratio("tokens", "words", 4), "compression": ratio("chars", "tokens", 4), "unk_rate": ratio("unks", "tokens", 6), "utilisation": F.round(F.col("unique_tokens") / size, 4)})
    return out.withColumn("vocab_coverage", F.round(1 - F.col("unks") / F.greatest("tokens", F.lit(1)), 6)).orderBy(F.col("language").asc_nulls_last())


def warnings(fertility: Column, unk_rate: Column, utilisation: Column) -> Column:
    flags = [F.when(fertility > 2.5, "fertility high"), F.when(fertility < 1.1, "fertility low"), F.when(unk_rate > 0.001, "unknown tokens"), F.when(utilisation < 0.5, "vocabulary little used")]
    return F.filter(F.array(*flags), lambda x: x.isNotNull())


def top_tokens(docs: DataFrame, path: str, *, text_col: str = "text", order_col: str = "doc_id", k: int = 20) -> DataFrame:
    """id, count of the k most frequent tokens, ties by where they first occur, without the unknown token.

    Each part of an Arrow batch gives a row a token, its count and first place there; only these reach the JVM.
    """
    rows = docs.select(F.col(order_col).alias("o"), F.col(text_col).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.take(pc.sort_indices(batch.column(0), null_placement="at_start"))
            at = 0
            for texts in parts(batch.column(1)):
                ids = [np.array(e.ids, np.int64) for e in encoded(path, texts)]
                ends = np.cumsum([len(x) for x in ids])
                found, first, n = np.unique(np.concatenate(ids), return_index=True, return_counts=True)
                row = np.searchsorted(ends, first, "right")
                pos = first - ends[row] + [len(ids[i]) for i in row] if len(row) else first
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n), batch.column(0).take(pa.array(row + at)), pa.array(pos)], names=["id", "n", "o", "pos"])
                at += len(texts)

    counted = rows.mapInArrow(count, f"id long, n long, o {rows.schema['o'].dataType.simpleString()}, pos long")
    most = counted.groupBy(F.col("id").cast("int").alias("id")).agg(F.sum("n").alias("count"), F.min(F.struct("o", "pos")).alias("first")).orderBy(F.desc("count"), "first").limit(k)
    return most.where(F.col("id") != F.lit(unk_id(path))).drop("first") if unk_id(path) is not None else most.drop("first")


def write_token_shards(docs: DataFrame, path: str, folder: str, *, order_col: str = "doc_id", text_col: str = "text", size: int = 256, max_length: int | None = 2048, pad_id: int = 0, min_chars: int = 50) -> dict:
    """Padded batches of ids as Parquet (input_ids, attention_mask, length = the batch's), batches in folders by
    range of number; gives the summary shards, total_seqs, total_tokens (pads included), elapsed_s, tokens_per_sec.
    """
    began = time.monotonic()
    kept = batches(docs.where(F.length(text_col) >= min_chars).select(order_col, text_col), order_col=order_col, size=size)
    ids = kept.select(order_col, "batch_id", encode_udf(path, max_length=max_length)(F.col(text_col)).alias("ids"))
    rows = pad(materialize(ids, "ids"), pad_id=pad_id)
    shard = rows.select("batch_id", F.col("input_ids").cast("array<int>"), "attention_mask", F.col("padded_length").cast("int").alias("length"))
    shard.repartition("batch_id").sortWithinPartitions("batch_id").write.option("compression", "zstd").parquet(folder)
    done = docs.sparkSession.read.parquet(folder).agg(F.countDistinct("batch_id").alias("b"), F.count("*").alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("t")).first()
    took = time.monotonic() - began
    return {"shards": done["b"], "total_seqs": done["n"], "total_tokens": done["t"], "elapsed_s": round(took, 2), "tokens_per_sec": round(done["t"] / max(took, 0.001))}


def validation_report(docs: DataFrame, path: str, out: str | None = None, *, sample: int = 5000, order_col: str = "doc_id") -> dict:
    """Metrics of the first `sample` texts, overall and per language (ascending), top tokens, warnings and the edge
    cases; written as JSON to the local file `out` if that is given (SNK-7). What is fetched is a row a language."""
    from ..sources.shards import first_texts

    some = materialize(first_texts(docs, sample, order=(order_col,)), "sample")
    began = time.monotonic()
    rows = [r.asDict() for r in metrics(some, path).collect()]
    if not rows or not rows[-1]["docs"]:
        raise RuntimeError("no texts to validate on")
    whole = next(r for r in rows if r["language"] is None)
    tok = load(path)
    per = {r["language"]: {k: r[k] for k in ("docs", "fertility", "unk_rate", "vocab_coverage")} for r in rows if r["language"] is not None}
    flags = docs.sparkSession.range(1).select(warnings(F.lit(whole["fertility"]), F.lit(whole["unk_rate"]), F.lit(whole["utilisation"])).alias("w")).first()["w"]
    found = {k: v for k, v in whole.items() if k != "language"} | {"vocab_size": tok.get_vocab_size(), "top_20_tokens": [tok.id_to_token(r["id"]) for r in top_tokens(some, path, order_col=order_col).collect()], "per_language": per, "warnings": flags, "elapsed_seconds": round(time.monotonic() - began, 2)}
    report = {"metrics": found, "edge_cases": [r.asDict() for r in edge_cases(docs.sparkSession, path).collect()]}
    if out:
        with open(out, "w", encoding="utf-8") as f:
            json.dump(report, f, indent=2, ensure_ascii=False)
    return report


def self_test(spark: SparkSession, path: str) -> dict[str, bool]:
    """Checks of a tokenizer before it is used: load, special tokens, round trip, batches, padding, labels, truncation, lengths (TOK-13)."""
    own, text = properties(path), "Every tokenizer should give this sentence back."
    rows = spark.createDataFrame([(0, text), (1, "Two words."), (2, "Short.")], "k int, text string")
    batch = rows.select("k", "text", F.lit(0).alias("batch_id"), encode_udf(path)("text").alias("ids")).withColumn("back", decode_udf(path)("ids"))
    got = pad(batch, pad_id=own["pad_id"] or 0).orderBy("k").collect()
    long = spark.createDataFrame([("internet " * 1000,)], "text string").select(F.size(encode_udf(path, max_length=512)("text"))).first()[0]
    stats = length_stats(batch.select(F.size("ids").alias("n")), "n").first()
    return {
        "vocabulary": own["vocab_size"] > 0,
        **{name: own[name] is not None for name in ("bos_id", "eos_id", "pad_id", "unk_id")},
        "encodes": len(got[0]["ids"]) > 0,
        "round_trip": text.lower() in got[0]["back"].lower(),
        "input_ids": all(r["input_ids"] for r in got),
        "attention_mask": all(sum(r["attention_mask"]) == r["length"] for r in got),
        "batch_size": len(got) == 3,
        "same_length": len({len(r["input_ids"]) for r in got}) == 1,
        "truncation": long == 512,
        "labels": all([x for x in r["labels"] if x != -100] == r["ids"] for r in got),
        "lengths": stats["mean"] > 0,
    }


def length_stats(lengths: DataFrame, col: str, percentiles: tuple[int, ...] = (50, 75, 90, 95, 99)) -> DataFrame:
    """One row: n, min, max, mean and percentiles without interpolation (rank floor(n p / 100), from 0), recommended length.

    Works on counts per distinct length, of which there are few. An empty input gives no row.
    """
    counts = lengths.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("v")).agg(F.count("*").alias("c"))
    upto = counts.withColumn("upto", F.sum("c").over(Window.orderBy("v"))).withColumn("n", F.sum("c").over(Window.partitionBy()))
    pick = [F.min(F.when(F.col("upto") > F.least(F.floor(F.col("n") * p / 100), F.col("n") - 1), F.col("v"))).alias(f"p{p}") for p in percentiles]
    out = upto.agg(F.max("n").alias("n"), F.min("v").alias("min"), F.max("v").alias("max"), F.round(F.sum(F.col("v") * F.col("c")) / F.max("n"), 1).alias("mean"), *pick).where("n is not null")
    if 95 in percentiles:
        out = out.withColumn("recommended", F.least(F.pow(F.lit(2), F.length(F.bin("p95"))).cast("long"), F.lit(2048).cast("long")))
    return out


def edge_cases(spark: SparkSession, path: str) -> DataFrame:
    """name, input, ids, tokens, roundtrip, n_tokens, n_unks, roundtrip_ok for the fixed strings."""
    rows = spark.createDataFrame(EDGE_CASES, "name string, input string")
    out = rows.withColumn("ids", encode_udf(path)("input")).withColumn("tokens", tokenize_udf(path)("input")).withColumn("roundtrip", decode_udf(path)("ids"))
    unks = F.size(F.filter("ids", lambda x: x == F.lit(unk_id(path)))) if unk_id(path) is not None else F.lit(0)
    return out.withColumn("n_tokens", F.size("ids")).withColumn("n_unks", unks).withColumn("roundtrip_ok", F.trim("roundtrip") == F.trim("input"))


def export(path: str, folder: str) -> dict:
    """vocab.txt, vocab.json, merges.txt (BPE only), config and a manifest with sizes and SHA-256 in `folder`."""
    os.makedirs(folder, exist_ok=True)
    model = json.load(open(path, encoding="utf-8"))["model"]
    vocab = load(path).get_vocab()
    by_id = sorted(vocab, key=vocab.get)
    files = {"vocab.txt": "\n".join(by_id) + "\n", "vocab.json": json.dumps(vocab, ensure_ascii=False, indent=0), "tokenizer_config_export.json": json.dumps({"model_type": model["type"], "vocab_size": len(vocab), "model_max_length": 2048}, indent=2)}
    if model["type"] == "BPE":
        files["merges.txt"] = "#version: 0.2\n" + "".join((m if isinstance(m, str) else " ".join(m)) + "\n" for m in model["merges"])
    manifest = []
    for name, text in sorted(files.items()):
        with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
            f.write(text)
        manifest.append({"name": name, "path": name, "size_bytes": len(text.encode()), "sha256": hashlib.sha256(text.encode()).hexdigest()})
    # The package that transformer libraries load: the tokenizer itself and its configuration.
    own = properties(path)
    package = {"tokenizer_class": "PreTrainedTokenizerFast", "model_max_length": 2048} | {name[:-3] + "_token": load(path).id_to_token(i) for name, i in own.items() if name != "vocab_size" and i is not None}
    os.makedirs(os.path.join(folder, "huggingface"), exist_ok=True)
    load(path).save(os.path.join(folder, "huggingface", "tokenizer.json"))
    with open(os.path.join(folder, "huggingface", "tokenizer_config.json"), "w", encoding="utf-8") as f:
        json.dump(package, f, indent=2, ensure_ascii=False)
    with open(os.path.join(folder, "manifest.json"), "w", encoding="utf-8") as f:
        json.dump({"files": manifest}, f, indent=2)
    return {"files": manifest}
