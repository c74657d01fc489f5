"""The registered queries against SQL or brute force on the smallest tables."""

import binascii
import hashlib
import re
import zlib
from collections import Counter, defaultdict

import pytest

from corpusloom.llm import registry

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet").collect()


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_against_sql(spark, sf, duck, name):
    got, want = registry.QUERIES[name](spark, sf).toPandas(), duck.sql(registry.ORACLE_SQL[name]).df()
    cols = sorted(want.columns)
    assert cols == sorted(got.columns)
    a, b = (x[cols].astype(str).sort_values(cols, ignore_index=True).values.tolist() for x in (got, want))
    assert a == b


def test_op1(spark, sf, docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = registry.QUERIES["op1_best_fit_packing"](spark, sf).collect()
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_seq[r["sequence_id"]].append(r)
    total = 0
    for d in docs:
        ids = tok.encode(d["text"] or "", add_special_tokens=False).ids + [0]
        total += len(ids)
        mine = sorted(by_doc[d["doc_id"]], key=lambda r: r["piece"])
        assert [r["piece"] for r in mine] == list(range(len(mine)))
        at = 0
        for r in mine:
            assert r["start"] == at and 0 < r["length"] <= 2048
            assert r["piece"] == 0 or r["length"] == 2048
            raw = b"".join(i.to_bytes(4, "little") for i in ids[at : at + r["length"]])
            assert r["ids_crc32"] == zlib.crc32(raw)
            at += r["length"]
        assert at == len(ids) and (len(mine) == 1 or len(ids) > 2048)
    for mine in by_seq.values():
        at = 0
        for r in sorted(mine, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048
    assert len(by_seq) <= 1.02 * total / 2048 + 1


def test_op2_shows_every_visible_word(spark, sf):
    """All words of a page, by a plain scan without head, script and style, are there in order of display."""
    from html import unescape

    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    rows = registry.QUERIES["op2_html_extraction"](spark, sf).collect()
    assert len(rows) == len(pages)
    for r in rows:
        body = re.sub(r"(?s)<head>.*?</head>|<script.*?</script>|<style.*?</style>|<!--.*?-->|<!DOCTYPE[^>]*>", " ", pages[r["page_id"]])
        want = unescape(re.sub(r"<[^>]+>", " ", body)).split()
        got = [w for w in r["text"].split() if w != "-"]
        assert got == [w for w in want if w != "-"]


def test_op3(spark, sf, docs):
    rows = {r["doc_id"]: r for r in registry.QUERIES["op3_quality_rules"](spark, sf).collect()}
    assert len(rows) == len(docs)
    for d in docs:
        text, r = d["text"] or "", rows[d["doc_id"]]
        words = WORD.findall(text)
        windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
        hit = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        dup = sum(x in set(lines[:i]) for i, x in enumerate(lines))
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(hit))
        assert r["base_failed"] == (len(words) < 50 or 100 * len(hit) > 50 * len(words))
        assert not (r["base_failed"] and r["kept"])


def test_op4_base_spans_by_plain_search(spark, sf, docs):
    patterns = {"assign": re.compile(r"""((?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), "access": re.compile("AKIA[A-Z0-9]+"), "hex": re.compile("[0-9a-f]+")}
    rows = {r["doc_id"]: r for r in registry.QUERIES["op4_secret_scans"](spark, sf).collect()}
    for d in docs:
        spans = []
        for rank, (kind, p) in enumerate(patterns.items()):
            for m in p.finditer(d["text"] or ""):
                if (len(m[2]) >= 6) if kind == "assign" else len(m[0]) >= (20 if kind == "access" else 24):
                    spans.append((m.start(), rank, m.end(), kind))
        listed = ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(spans))
        assert rows[d["doc_id"]]["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()


def test_op6(spark, sf, docs):
    rows = registry.QUERIES["op6_sharding"](spark, sf).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(d["doc_id"] for d in docs)
    text = {d["doc_id"]: d["text"] or "" for d in docs}
    sizes, slots = Counter(), defaultdict(list)
    for r in rows:
        assert r["size"] == len(text[r["doc_id"]].encode()) + 8 and r["text_crc32"] == binascii.crc32(text[r["doc_id"]].encode())
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert set(sizes) == set(range(24)) and max(sizes.values()) < 1.15 * sum(sizes.values()) / 24


def test_op7_held_out_accuracy(spark, duck):
    big = "/root/testdata/sf0.01"
    rows = {r["doc_id"]: r for r in registry.QUERIES["op7_quality_classifier"](spark, big).collect()}
    labels = [(r["doc_id"], r["quality"]) for r in spark.read.parquet(f"{big}/labels.parquet").collect()]
    held = [(i, y) for i, y in labels if zlib.crc32(str(i).encode()) % 3 == 1]
    assert all(rows[i]["held_out"] for i, _ in held) and sum(r["held_out"] for r in rows.values()) < len(rows) / 2
    assert sum(rows[i]["predicted"] == y for i, y in held) / len(held) > 0.97


def test_op8(spark, sf, docs):
    first, again = (sorted(map(tuple, registry.QUERIES["op8_mixing"](spark, sf).collect())) for _ in range(2))
    assert first == again
    rows = registry.QUERIES["op8_mixing"](spark, sf).collect()
    source = {d["doc_id"]: d["source"] for d in docs}
    size = {d["doc_id"]: len(WORD.findall(d["text"] or "")) for d in docs}
    totals, taken, target = Counter(), Counter(), {}
    for r in rows:
        assert r["size"] == size[r["doc_id"]] and 0 <= r["taken"] <= 2 * r["size"]
        s = source[r["doc_id"]]
        totals[s] += r["size"]
        taken[s] += r["taken"]
        target[s] = r["target"]
    names = sorted(totals)
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    left, open_, want = 1.5 * sum(totals.values()), set(names), {}
    while open_:
        unit = left / sum(weights[s] for s in open_)
        full = {s for s in open_ if unit * weights[s] > 2 * totals[s]}
        for s in full or open_:
            want[s] = 2 * totals[s] if full else unit * weights[s]
        left -= sum(want[s] for s in full)
        open_ = open_ - full if full else set()
    for s in names:
        assert target[s] == pytest.approx(want[s]) and abs(taken[s] - target[s]) <= 64


def test_op9_held_out_accuracy(spark):
    big = "/root/testdata/sf0.01"
    rows = {r["doc_id"]: r for r in registry.QUERIES["op9_language_id"](spark, big).collect()}
    held = [(r["doc_id"], r["lang"]) for r in spark.read.parquet(f"{big}/documents.parquet").collect() if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert sum(rows[i]["lang_pred"] == y for i, y in held) / len(held) > 0.98
    assert {i for i, r in rows.items() if r["held_out"]} == {i for i, _ in held}
