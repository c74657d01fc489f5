"""Hand fixtures for rules that the tables do not exercise."""

import json

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import text as T
from corpusloom.operators import dedup, html, language, quality, tokens, urls
from corpusloom.sources import shards
from corpusloom.streaming import queues

LONG = "word " * 20


def cleaned(spark, text, title=None, **config):
    df = spark.createDataFrame([(text, title)], "text string, title string")
    return T.clean(df, T.CleanConfig(**{"min_chars": 1} | config), title_col="title").first()["clean_text"]


@pytest.mark.parametrize(
    ("text", "title", "want"),
    [
        ("Abcd Abcd rest", "Abcd", "Abcd rest"),
        ("a​b­c﻿d\x00e", None, "abcde"),
        ("a <b>x</b> c", None, "a x c"),
        ("1 < 2 and 3 > 2", None, "1 2"),
        ("mail a@b.co.uk now", None, "mail .uk now"),
        ("a\r\n\r\n\r\n\r\nb\tc", None, "a\n\nb c"),
        ("p1\n\np2\n\np3", None, "p1\n\np2\np3"),
        ("see https://x.org/y?z now", None, "see now"),
        ("é", None, "é"),
        (None, None, None),
        ("", None, None),
    ],
)
def test_clean(spark, text, title, want):
    assert cleaned(spark, text, title) == want


def test_length_gates(spark):
    assert cleaned(spark, "x" * 49, min_chars=50) is None
    assert cleaned(spark, "x" * 50, min_chars=50) == "x" * 50
    assert cleaned(spark, "x" * 40 + " " * 30, min_chars=50) is None


def test_quality_extremes(spark):
    df = spark.createDataFrame([("12345 678",), ("   ",), ("",)], "text string")
    got = df.select(*[c.alias(n) for n, c in quality.counts(F.col("text")).items()]).withColumn("quality_score", quality.score())
    rows = got.select("quality_score").collect()
    assert rows[1][0] == rows[2][0] == 0.0
    assert 0 < rows[0][0] < 1  # the upper-case term is left out of the mean
    with pytest.raises(ValueError):
        quality.QualityConfig(min_score=2)


def test_profiles_count_whole_texts(spark):
    docs = spark.createDataFrame([("x", "abc" + " " * 1997 + "xyz" * 2000)], "lang string, text string")
    top = [r["gram"] for r in language.build_profiles(docs, n=3).orderBy("rank").collect()]
    assert top == ["xyz", "yzx", "zxy"]
    assert language.build_profiles(docs, n=1, sample=language.SAMPLE).first()["gram"] == "   "


def test_language_unknown_and_tie(spark):
    profiles = spark.createDataFrame([("b", 0, "abc"), ("a", 0, "xyz")], "lang string, rank int, gram string")
    df = spark.createDataFrame([(1, "日本語です"), (2, "xyz abc"), (3, "abc xyz"), (4, None), (5, "ab")], "doc_id long, text string")
    got = {r["id"]: r["language"] for r in language.detect(df, profiles).collect()}
    assert got == {1: "unknown", 2: "a", 3: "b", 4: "unknown", 5: "unknown"}


def test_lsh_chain_is_greedy(spark, monkeypatch):
    """A~B and B~C but not A~C in arrival order: A and C stay."""
    from pyspark.sql.functions import pandas_udf
    from pyspark.sql.types import ArrayType, LongType

    def fake(n_hashes, shingle):
        @pandas_udf(ArrayType(LongType()))
        def sig(text):
            return text.map(lambda x: [int(c) for c in x])

        return sig

    monkeypatch.setattr(dedup, "signature_udf", fake)
    df = spark.createDataFrame([(1, "12"), (2, "13"), (3, "43"), (4, "12"), (5, "98")], "doc_id long, text string")
    got = {r["id"]: r["kept"] for r in dedup.lsh_keep(df, n_hashes=2, n_bands=2).collect()}
    assert got == {1: True, 2: False, 3: True, 4: False, 5: True}


def test_short_text_is_one_shingle(spark):
    df = spark.createDataFrame([(1, "abc"), (2, "abc"), (3, "")], "doc_id long, text string")
    got = {r["id"]: r["kept"] for r in dedup.lsh_keep(df).collect()}
    assert got == {1: True, 2: False, 3: True}


def test_url_normal_form():
    norm = lambda u: urls.normalize(urls.parse(u))
    assert norm("HTTP://Ex.COM:80/a/../b//c/?b=2&a=1&x=#f") == "http://ex.com/b/c?a=1&b=2"
    assert norm("https://example.com") == "https://example.com/"
    assert norm("https://u:p%40@h.org:8443/x y") == "https://u:p%40@h.org:8443/x%20y"
    assert urls.remove_dot_segments("/a/b/c/./../../g") == "/a/g"
    assert urls.remove_dot_segments("/../a/..") == "/"
    assert urls.canonical(urls.parse("http://Ex.org:80/%7Ea/./b?q#f")) == "http://ex.org/~a/b?q#f"
    assert urls.domain_parts("a.b.co.uk") == ("a", "b", "co.uk")
    assert urls.domain_parts("1.2.3.4") == ("", "1.2.3.4", "")


def test_url_rejects(spark):
    bad = ["https://a.org/x.PDF", "https://a.org/" + "x" * 2048, "ftp://a.org/", "javascript:1", "https://a_b.org/", "https://a.xn--p1ai/", "https://a.org:99999/", None, " "]
    good = ["https://localhost/", "http://127.0.0.1/x", "https://a.org/x?f=y.pdf"]
    df = spark.createDataFrame([(u,) for u in bad + good], "url string")
    got = [r["normalized"] for r in urls.canonicalize(df).collect()]
    assert got[: len(bad)] == [None] * len(bad)
    assert all(got[len(bad) :])


def test_frontier_is_distinct_and_new(spark):
    links = spark.createDataFrame([("https://a.org/x/", "../y"), ("https://a.org/", "/y#z"), ("https://a.org/", "mailto:x"), ("https://a.org/", "/z")], "url string, href string")
    first = urls.frontier(links)
    assert sorted(r["normalized"] for r in first.collect()) == ["https://a.org/y", "https://a.org/z"]
    assert urls.frontier(links, seen=first).count() == 0


PAGE = "<title>T</title><h2>Head</h2><p>{}</p>"


def test_extract_rules():
    long = "This paragraph has a good number of characters, more than forty and more than eighty of them in all."
    assert html.extract(PAGE.format(long)) == ("T", f"T\n\nHead\n\n{long}")
    assert long[:20] not in str(html.extract(f'<div class="thread-list"><p>{long}</p></div>'))
    assert html.extract(f'<body class="has-sidebar"><p>{long}</p></body>') is None
    assert html.extract(PAGE.format(long + "<button>x</button> tail text")) == ("T", f"T\n\nHead\n\n{long}")
    assert html.extract(PAGE.format("Read more " + long)) is None
    assert html.extract("") is None and html.extract(None) is None
    assert html.links('<a href="/x">1</a><!-- <a href="/no"> --><a href="/x"><a>') == ["/x", "/x"]
    assert html.links('<![no such><a href="/x"><![if !IE]><a href="/y"><![endif]><![<a href="/no">') == ["/x", "/y"]
    assert html.extract("<!doctype html><![no such>" + PAGE.format(long) + "<a " * 200_000) == ("T", f"T\n\nHead\n\n{long}")


def test_batches_and_padding(spark):
    rows = spark.createDataFrame([(i, list(range(1, i % 3 + 2))) for i in range(5)], "k long, ids array<int>")
    got = tokens.pad(tokens.batches(rows, order_col="k", size=2), pad_id=9).orderBy("k").collect()
    assert [r["batch_id"] for r in got] == [0, 0, 1, 1, 2]
    assert got[0]["input_ids"] == [1, 9] and got[0]["labels"] == [1, -100] and got[0]["attention_mask"] == [1, 0]
    assert tokens.batches(rows, order_col="k", size=2, drop_last=True).count() == 4


def test_length_stats(spark):
    row = tokens.length_stats(spark.createDataFrame([(i,) for i in range(1, 11)], "n long"), "n").first()
    assert (row["p50"], row["p90"], row["n"], row["mean"]) == (6, 10, 10, 5.5)
    row = tokens.length_stats(spark.createDataFrame([(512,)], "n long"), "n").first()
    assert row["recommended"] == 1024
    assert tokens.length_stats(spark.createDataFrame([], "n long"), "n").count() == 0


def test_tokenizer_round_trip_and_export(spark, tmp_path):
    rows = tokens.edge_cases(spark, tokens.default_path()).collect()
    assert len(rows) == 14 and all(r["roundtrip_ok"] for r in rows)
    done = tokens.export(tokens.default_path(), str(tmp_path))
    assert {f["name"] for f in done["files"]} == {"vocab.txt", "vocab.json", "merges.txt", "tokenizer_config_export.json"}
    assert (tmp_path / "merges.txt").read_text().startswith("#version")
    with pytest.raises(FileNotFoundError):
        tokens.load("/nowhere.json")


def test_shards_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("1", "Ａ  text", "s", "en", 0.5, 0.5, 7, 2, 1, '{"a": "b"}'), ("2", "", "s", None, 0.5, 0.5, 0, 0, 1, "{bad")], shards.SHARD.fieldNames())
    shards.write_shards(df, str(tmp_path / "p"), shard_size=1)
    assert [r["text"] for r in shards.read_texts(spark, str(tmp_path / "p")).collect()] == ["A text"]
    meta = {r["text"]: r["metadata"] for r in shards.read_with_metadata(spark, str(tmp_path / "p")).collect()}
    assert meta["Ａ  text"]["a"] == "b" and meta["Ａ  text"]["source"] == "s"
    shards.write_shards(df, str(tmp_path / "j"), fmt="json")
    assert spark.read.json(str(tmp_path / "j")).count() == 2
    stats = shards.shard_stats(df, F.lit("x")).first()
    assert stats["docs"] == 2 and stats["languages"] == {"en": 1}


def test_count_texts_has_the_reference_bounds(spark):
    df = spark.createDataFrame([(x,) for x in (None, 49, 50, 99, 10_001, 1_000_000, 1_000_001)], "char_count long")
    assert shards.count_texts(df).first()["n"] == 4


def test_queue_to_documents_and_dead_letters(spark, tmp_path):
    queue = tmp_path / "q"
    queue.mkdir()
    good = {"url": "https://a.org/", "title": "t", "text": " hello "}
    (queue / "1.jsonl").write_text("\n".join([json.dumps(good), "{broken", json.dumps({"url": "x", "text": None}), json.dumps({"text": "  "}), "[1]", json.dumps({"id": "7", "text": "x"})]))
    queues.consume_texts(spark, str(queue), str(tmp_path / "o"), str(tmp_path / "d"), str(tmp_path / "c")).awaitTermination()
    rows = {r["doc_id"]: r for r in spark.read.parquet(str(tmp_path / "o")).collect()}
    assert len(rows) == 2 and rows["7"]["source"] == "redis"
    assert any(r["text"] == "hello" and r["source"] == "https://a.org/" for r in rows.values())
    assert spark.read.json(str(tmp_path / "d")).count() == 4
    # A second run finds nothing new.
    queues.consume_texts(spark, str(queue), str(tmp_path / "o"), str(tmp_path / "d"), str(tmp_path / "c")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "o")).count() == 2


def test_frontier_stream_remembers(spark, tmp_path):
    queue = tmp_path / "q"
    queue.mkdir()
    (queue / "1").write_text("https://a.org\nhttps://a.org/#x\nnot a url\n")
    run = lambda: queues.generate_frontier(spark, str(queue), str(tmp_path / "s"), str(tmp_path / "c")).awaitTermination()
    run()
    (queue / "2").write_text("https://a.org/\nhttps://b.org/\n")
    run()
    assert sorted(r["normalized"] for r in spark.read.parquet(str(tmp_path / "s")).collect()) == ["https://a.org/", "https://b.org/"]


def test_html_stream(spark, tmp_path, sf):
    queue = tmp_path / "q"
    spark.read.parquet(f"{sf}/pages.parquet").select("url", "html").coalesce(1).write.json(str(queue))
    queues.extract_pages(spark, str(queue), str(tmp_path / "o"), str(tmp_path / "d"), str(tmp_path / "c")).awaitTermination()
    assert spark.read.json(str(tmp_path / "o")).count() == 45


def test_clean_runs_once(spark, sf):
    """A filter on the cleaned text doesn't clean again."""
    df = T.clean(spark.read.parquet(f"{sf}/documents.parquet")).where("clean_text is not null").select("doc_id", *T.counters(F.col("clean_text")))
    assert df._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1


def test_md5_prefixes():
    import hashlib
    import random

    import numpy as np

    rng = random.Random(0)
    words = ["".join(rng.choices("aé😀z日 \n", k=5)) for _ in range(200)]
    codes = np.array([[ord(c) for c in w] for w in words], np.uint32)
    want = [int.from_bytes(hashlib.md5(w.encode()).digest()[:4], "big") for w in words]
    assert dedup.md5_prefixes(dedup._blocks(codes)).tolist() == want


def test_exact_keep_and_drop_seen(spark):
    df = spark.createDataFrame([(3, "a"), (1, "a"), (2, None), (4, None), (5, "b")], "doc_id long, text string")
    assert {r["doc_id"] for r in dedup.exact_keep(df).where("is_first").collect()} == {1, 2, 5}
    new = spark.createDataFrame([("x", 2), ("x", 1), ("y", 3), ("z", 4)], "fp string, n long")
    done = spark.createDataFrame([("y",)], "fp string")
    assert sorted(map(tuple, dedup.drop_seen(new, done, order_col="n").collect())) == [("x", 1), ("z", 4)]


def test_canonical_query_and_paragraph_gate():
    assert urls.canonical(urls.parse("http://a.org/?q=%7Ex y")) == "http://a.org/?q=~x%20y"
    short = "x" * 38 + " •"  # 40 characters before cleaning
    body = "This paragraph has a good number of characters, more than forty and more than eighty of them in all."
    assert short[:38] in html.extract(PAGE.format(body) + f"<p>{short}</p>")[1]


def test_failed_and_paced_urls(spark):
    pages = spark.createDataFrame([("u", 404, "text/html", 1), ("v", 200, "text/html", 1), ("w", 200, "image/png", 1)], "url string, status int, content_type string, content_length long")
    assert [tuple(r) for r in urls.failed_urls(pages).collect()] == [("u", 404)]
    got = urls.paced(spark.createDataFrame([("http://a.org/2",), ("http://a.org/1",), ("http://b.org/",)], "url string"), delay=2.0)
    assert {r["url"]: r["wait"] for r in got.collect()} == {"http://a.org/1": 0.0, "http://a.org/2": 2.0, "http://b.org/": 0.0}


def test_token_metrics_by_hand(spark):
    texts = [("the cat sat", "en"), ("le chat", "fr"), ("the dog", "en"), (None, "en"), ("", "en"), ("x", None)]
    df = spark.createDataFrame([(i, t, x) for i, (t, x) in enumerate(texts)], "doc_id long, text string, lang string")
    tok = tokens.load(tokens.default_path())
    rows = tokens.metrics(df, tokens.default_path()).collect()
    assert [r["language"] for r in rows] == ["en", "fr", "unknown", None]
    every = [i for t, _ in texts if t for i in tok.encode(t, add_special_tokens=False).ids]
    whole = rows[-1]
    assert (whole["docs"], whole["words"], whole["tokens"], whole["unique_tokens"]) == (4, 8, len(every), len(set(every)))
    assert whole["unk_rate"] == 0 and whole["vocab_coverage"] == 1 and rows[0]["docs"] == 2
    counts = {i: every.count(i) for i in every}
    want = sorted(counts, key=lambda i: (-counts[i], every.index(i)))[:3]
    assert [r["id"] for r in tokens.top_tokens(df, tokens.default_path(), k=3).collect()] == want


def test_token_shards_report_and_self_test(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("doc_id < 40")
    done = tokens.write_token_shards(docs, tokens.default_path(), str(tmp_path / "t"), size=16)
    rows = spark.read.parquet(str(tmp_path / "t")).collect()
    assert done["total_seqs"] == len(rows) and done["total_tokens"] == sum(len(r["input_ids"]) for r in rows) and done["shards"] == len({r["batch_id"] for r in rows})
    assert all(len(r["input_ids"]) == len(r["attention_mask"]) == r["length"] <= 2048 for r in rows)
    report = tokens.validation_report(docs, tokens.default_path(), str(tmp_path / "r.json"), sample=20)
    assert json.loads((tmp_path / "r.json").read_text())["metrics"]["docs"] == report["metrics"]["docs"] == 20
    assert list(report["metrics"]["per_language"]) == sorted(report["metrics"]["per_language"]) and len(report["edge_cases"]) == 14
    checks = tokens.self_test(spark, tokens.default_path())
    assert not [k for k, ok in checks.items() if not ok and k not in ("pad_id", "unk_id")]  # this vocabulary has neither
    assert tokens.properties(tokens.default_path())["eos_id"] == 50256


def test_stream_failures_counters_and_progress(spark, tmp_path, monkeypatch):
    queue = tmp_path / "q"
    queue.mkdir()
    (queue / "1").write_text("https://a.org\nhttps://a.org/#x\nnot a url\n")
    seen: list = []
    progress = queues.Progress()
    spark.streams.addListener(progress)
    query = queues.generate_frontier(spark, str(queue), str(tmp_path / "s"), str(tmp_path / "c"), counters=seen)
    query.awaitTermination()
    assert seen == [{"popped": 3, "valid": 2, "skipped": 2, "pushed": 1}]
    for _ in range(50):
        if progress.seen.get(str(query.id), {}).get("rows"):
            break
        import time

        time.sleep(0.1)
    assert progress.seen[str(query.id)]["rows"] == 3
    spark.streams.removeListener(progress)
    pages = spark.createDataFrame([("u", None), ("v", "<p>x")], "url string, html string")
    assert [(r["url"], r["failed"]) for r in html.try_extract(pages).collect()] == [("u", False), ("v", False)]


def test_rollup_and_first_texts(spark):
    df = spark.createDataFrame([(2, "x" * 60, "a", 60, 15), (1, "y" * 50, "b", 50, 12), (3, "z" * 49, "a", 49, 12)], "doc_id long, text string, lang string, char_count long, token_estimate long")
    assert [r["doc_id"] for r in shards.first_texts(df, 2).collect()] == [1, 2]
    assert {r["lang"]: r["docs"] for r in shards.corpus_rollup(df, "lang").collect()} == {"a": 2, "b": 1, None: 3}
