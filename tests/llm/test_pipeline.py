"""Every stage of the pipeline against a plain version of its decisions, on the smallest tables."""

import re
from collections import Counter, defaultdict

import corpus_pipeline
from corpusloom.llm import packing, quality, stages

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BASE = (
    (re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), lambda m: len(m[1]) >= 6),
    (re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
    (re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 24),
)


def water_fill(sizes, weights, total, most):
    """Shares of `total` by weight; one above `most` times its size stops there and its excess goes to the others."""
    out, open_, left = [0.0] * len(sizes), [i for i, x in enumerate(sizes) if x > 0], total
    while open_:
        unit = left / sum(weights[i] for i in open_)
        full = [i for i in open_ if unit * weights[i] > most * sizes[i]]
        for i in full or open_:
            out[i] = most * sizes[i] if full else unit * weights[i]
        left -= sum(out[i] for i in full)
        open_ = [i for i in open_ if i not in full] if full else []
    return out


def plain_spans(text):
    """Base spans with their values."""
    return sorted((m.start(), m.end(), m[m.re.groups]) for p, ok in BASE for m in p.finditer(text) if ok(m))


def plain_redaction(docs):
    """{doc_id: text}: spans of values that fewer than three sources hold, base ones and bare tokens outside these."""
    found, owners = defaultdict(list), defaultdict(set)
    for i, text, source in docs:
        found[i] = plain_spans(text)
        masked = list(text)
        for s, e, _ in found[i]:
            masked[s:e] = "\0" * (e - s)
        for m in re.finditer("[A-Za-z0-9_-]{20,}", "".join(masked)):
            if re.search("[0-9]", m[0]) and re.search("[A-Za-z]", m[0]):
                found[i].append((m.start(), m.end(), m[0]))
        for _, _, value in found[i]:
            owners[value].add(source)
    out = {}
    for i, text, _ in docs:
        spans, at, done = sorted((s, e) for s, e, v in found[i] if len(owners[v]) < 3), 0, ""
        for s, e in spans:
            if s >= at:
                done += text[at:s] + "[SECRET]"
            at = max(at, e)
        out[i] = done + text[at:]
    return out


def test_stages_against_plain_versions(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    before = {r["doc_id"]: r for r in docs.collect()}
    outs = []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf).write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        outs.append(docs.collect())
    good, single, clean, mixed, packed = outs

    model = quality.train(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"), usable=lambda c: quality.remainder(c, 3) != 1)
    ids = sorted(before)
    scores = quality.score([before[i]["text"] for i in ids], model)
    assert sorted(r["doc_id"] for r in good) == [i for i, s in zip(ids, scores, strict=True) if s >= 0.5]

    sets = {}
    for r in good:
        w = r["text"].lower().split()
        sets[r["doc_id"]] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    comp = {i: i for i in sets}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    for _ in sets:
        for a, b in links:
            comp[a] = comp[b] = min(comp[a], comp[b])
    assert sorted(r["doc_id"] for r in single) == sorted(i for i in sets if comp[i] == i)

    want = plain_redaction([(r["doc_id"], r["text"], r["source"]) for r in single])
    assert {r["doc_id"]: r["text"] for r in clean} == want
    assert all(r["n_chars"] == len(r["text"]) for r in clean)

    words, taken = Counter(), Counter()
    source = {r["doc_id"]: r["source"] for r in clean}
    for r in clean:
        words[r["source"]] += len(WORD.findall(r["text"]))
    for r in mixed:
        assert want[r["doc_id"]].startswith(r["text"])
        taken[source[r["doc_id"]]] += len(WORD.findall(r["text"]))
    assert max(Counter(r["doc_id"] for r in mixed).values()) <= 2
    names = sorted(words)
    targets = water_fill([words[s] for s in names], [(3, 1, 2)[i % 3] for i in range(len(names))], 1.5 * sum(words.values()), 2)
    assert all(abs(taken[s] - t) <= 64 for s, t in zip(names, targets, strict=True))

    enc = packing.encoder(packing.default_ranks())
    tokens = Counter()
    for r in mixed:
        tokens[r["doc_id"]] += len(enc.encode_ordinary(r["text"])) + 1
    got = Counter()
    for r in packed:
        got[r["doc_id"]] += r["length"]
    assert got == tokens and sum(r["piece"] == 0 for r in packed) == len(mixed)
    sequences = defaultdict(list)
    for r in packed:
        sequences[r["sequence_id"]].append(r["length"])
    assert all(sum(x) <= 2048 and len(x) <= stages.MAX_DOCS and (len(x) == 1 or sum(n * n for n in x) <= stages.MAX_COST) for x in sequences.values())
    assert sorted(r["doc_id"] for r in corpus_pipeline.run(spark, sf).collect()) == sorted(r["doc_id"] for r in packed)
