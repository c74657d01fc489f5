"""Methods of the training-data operators against plain versions, and at the places where they once broke."""

import itertools
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from corpusloom.llm import htmltext, langid, mixing, neardup, packing, quality, registry, rules, secrets, sharding


# op1


def test_packing_of_sorted_reversed_and_shuffled_tables(spark):
    rng = np.random.default_rng(0)
    sizes = [1500] * 1200 + [540] * 1200
    counts = {}
    for how in ("down", "up", "mixed"):
        y = rng.permutation(sizes) if how == "mixed" else sorted(sizes, reverse=how == "down")
        df = spark.createDataFrame([(i, " a" * int(n - 1)) for i, n in enumerate(y)], "doc_id long, text string").coalesce(2)
        for name, opts in (("tokens", {}), ("all", {"max_docs": 2, "max_cost": 0.75 * 2048**2})):
            rows = packing.pack_documents(df, window_tokens=300_000, tail_tokens=200_000, **opts).collect()
            fill = defaultdict(list)
            for r in rows:
                fill[r["sequence_id"]].append(r["length"])
            assert len(rows) == len(sizes) and all(sum(x) <= 2048 for x in fill.values())
            assert name == "tokens" or all(len(x) <= 2 and sum(n * n for n in x) <= 0.75 * 2048**2 for x in fill.values())
            counts[name, how] = len(fill)
    assert max(counts.values()) <= 1.02 * min(counts.values()) and min(counts.values()) <= 1.01 * sum(sizes) / 2040


def test_packing_keeps_the_type_of_ids(spark):
    df = spark.createDataFrame([("x", "a b", 1), (None, None, 2)], "doc_id string, text string, length int")
    assert sorted((r["doc_id"] or "", r["length"]) for r in packing.pack_documents(df).collect()) == [("", 1), ("x", 3)]


# op2


def test_html_cost_and_visibility_below_any_depth():
    for page in ("<div>" * 30_000 + "x", "<p><table><tr><td>" + "<div>" * 30_000 + "x", "<svg>" + "<g>" * 30_000 + "<text>x"):
        assert htmltext.render(page).strip() == "x"
    deep = "<div>" * 150
    assert htmltext.render(deep + "<div hidden>no<p>no</p></div>yes") == "yes"
    assert htmltext.render(deep + "<i style='visibility:hidden'>no<b style='visibility:visible'>yes</b>no</i> x") == "yes x"
    assert htmltext.render(deep + "<script>no</script><details><summary>s</summary>no</details>z").split() == ["s", "z"]
    assert htmltext.render(deep + "<p>a</p>b<div>c</div>d").split() == list("abcd")


def test_html_first_attribute_counts():
    assert htmltext.render("<p style='display:none' style=''>no</p><p style='' style='display:none'>yes</p>") == "yes"


def test_html_tables_of_wide_cells_and_letters():
    rows = "<tr><td>a<td>b" * 2000
    text = htmltext.render("<table><tr><td>" + "w" * 20_000 + "<td>z" + rows + "</table>")
    assert text.split("\n")[:2] == ["w" * 20_000 + "  z", "a  b"] and len(text) < 60_000
    assert htmltext.render("<table><tr><td>日本<td>x<tr><td>abcde<td>y</table>") == "日本   x\nabcde  y"
    assert htmltext.render("<table><tr><td colspan=5000>w<td>z<tr><td>a<td>b</table>") == "w     z\na  b"


def test_html_titles_and_clashing_columns(spark):
    assert htmltext.title("<TITLE>A &amp; B\n c</title>") == "A & B c" and htmltext.title("<title>x") == htmltext.title("<title" * 1000) == ""
    df = spark.createDataFrame([(1, "<p>x", "own", "own")], "page_id long, html string, title string, text string")
    assert htmltext.extract_text(df, keep=("page_id", "title", "text")).collect()[0].asDict() == {"page_id": 1, "title": "", "text": "x"}
    assert htmltext.extract_text(df.limit(0), keep=("title",)).columns == ["title", "text"]


# op3


def plain_kept(rows, labels, alpha=0.05, delta=0.05):
    """rows: {doc_id: (stratum, text, signals)}. Verdicts by loops."""
    names = rules.SIGNALS
    base = {i: x["n_words"] < 50 or 100 * x["n_repeat_words"] > 50 * x["n_words"] for i, (_, _, x) in rows.items()}
    assert set(names) <= set(next(iter(rows.values()))[2])
    exceeds = lambda x, step: any(x[over] / max(x[under], 1) > cuts[step] for over, under, cuts in rules.RULES.values())
    draws = {(rows[i][0], rows[i][1], y): rows[i][2] for i, y in labels if i in rows and not base[i] and y in (0, 1)}
    strata = {s for s, n in Counter(s for s, _, y in draws if y == 1).items() if (1 - alpha) ** n <= delta}
    steps = {}
    for s in strata:
        good, bad = ([x for (t, _, y), x in draws.items() if t == s and y == want] for want in (1, 0))
        best, most = None, 0
        for step in range(rules.STEPS):
            false = sum(exceeds(x, step) for x in good)
            # P(at most `false` of n) at the rate alpha: over delta / strata, no bound below alpha.
            tail = sum(math.comb(len(good), k) * alpha**k * (1 - alpha) ** (len(good) - k) for k in range(false + 1))
            if tail > delta / len(strata):
                break
            true = sum(exceeds(x, step) for x in bad)
            if true > most:
                best, most = step, true
        steps[s] = best
    return {i: not base[i] and not (steps.get(s) is not None and exceeds(x, steps[s])) for i, (s, _, x) in rows.items()}


def test_rules_against_the_plain_version(spark):
    big = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{big}/documents.parquet"), spark.read.parquet(f"{big}/labels.parquet")
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = rules.quality_rules(docs, labels).collect()
    rows = {r["doc_id"]: (r["stratum"], text[r["doc_id"]], {k: r[k] for k in rules.SIGNALS}) for r in got}
    want = plain_kept(rows, [(r["doc_id"], r["quality"]) for r in labels.collect()])
    assert {r["doc_id"]: r["kept"] for r in got} == want
    assert any(not r["base_failed"] and not r["kept"] for r in got)


def test_rules_count_a_text_once(spark):
    """A thousand copies of one good document certify nothing."""
    text = " ".join(f"word{i}" for i in range(60))
    junk = " ".join(f"w{i}###" for i in range(60))
    df = spark.createDataFrame([(i, text, "en") for i in range(1000)] + [(2000 + i, junk + f" x{i}", "en") for i in range(20)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i in range(1000)] + [(2000 + i, 0) for i in range(20)] + [(5, 7)], "doc_id long, quality int")
    assert all(r["kept"] for r in rules.quality_rules(df, labels).collect())


# op6


def test_place_is_the_greedy_dot_product():
    items = np.array([[5, 5, 1], [4, 1, 1], [3, 3, 1], [3, 2, 1], [1, 1, 1], [1, 1, 1]], float)
    share, left, want = items / items.sum(axis=0), [[0.5] * 3 for _ in range(2)], {}
    for i in sorted(range(6), key=lambda i: (-max(share[i]), i)):
        best = max(range(2), key=lambda s: (sum(w * a * b for w, a, b in zip((2, 1, 1), left[s], share[i], strict=True)), -s))
        want[i] = best
        left[best] = [a - b for a, b in zip(left[best], share[i], strict=True)]
    assert sharding.place(items, 2).tolist() == [want[i] for i in range(6)]


def test_sharding_splits_only_heavy_groups(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = sharding.assign_shards(docs, keep=("text",)).select("shard", "size", "row.text").collect()
    shards, size = defaultdict(set), Counter()
    for r in rows:
        shards[r["text"]].add(r["shard"])
        size[r["text"]] += r["size"]
    total = sum(size.values())
    assert all(len(s) == 1 for t, s in shards.items() if size[t] < total / 24 / 3)
    per = Counter()
    for r in rows:
        per[r["shard"]] += r["size"]
    assert max(per.values()) < 1.03 * total / 24


# op7


def test_quality_lines_of_one_document_get_both_labels():
    big = "/root/testdata/sf0.01"
    import pyarrow.parquet as pq

    text = dict(zip(*(pq.read_table(f"{big}/documents.parquet")[c].to_pylist() for c in ("doc_id", "text")), strict=True))
    lab = pq.read_table(f"{big}/labels.parquet").to_pylist()
    known = [(text[r["doc_id"]], r["quality"]) for r in lab if zlib.crc32(str(r["doc_id"]).encode()) % 3 != 1]
    model = quality.fit([t for t, _ in known], np.array([y for _, y in known]))
    p, _, per = quality.line_marginals([t for t, _ in known], model)
    at = np.concatenate([[0], np.cumsum(per)[:-1]])
    assert ((np.maximum.reduceat(p, at) > 0.5) & (np.minimum.reduceat(p, at) < 0.5)).sum() > 5
    good = [t.split("\n")[:4] for t, y in known if y == 1 and t.count("\n") >= 4][:10]
    junk = [x[:3] for t, y in known if y == 0 and len(x := [line for line in t.split("\n") if line.count("###") > 2]) >= 3][:10]
    assert len(good) == 10 and len(junk) > 3
    for a, b in zip(good, junk, strict=False):
        q, _, _ = quality.line_marginals(["\n".join(a + b)], model)
        assert (q[: len(a)] > 0.5).sum() >= len(a) - 1 and (q[len(a) :] < 0.5).all()


def test_quality_shift_meets_its_bounds():
    p, weight, per = np.array([0.9, 0.8, 0.2, 0.1, 0.6, 0.95]), np.array([3.0, 1, 2, 2, 5, 1]), np.array([2, 2, 2])
    q = quality.shifted(p, weight, per, np.array([0, 1, 1]))
    mean = [np.average(q[i : i + 2], weights=weight[i : i + 2]) for i in (0, 2, 4)]
    assert mean[0] == pytest.approx(quality.BAD_MOST) and mean[1] == pytest.approx(quality.GOOD_LEAST) and mean[2] == pytest.approx(quality.GOOD_LEAST)
    assert q[0] > q[1] and q[2] > q[3]


def test_quality_score_by_enumeration():
    """Signals of a text's lines to its score: all label paths, weighted by length; alone as in company."""
    rng = np.random.default_rng(3)
    texts = ["Good line here.\n### $$$\nanother line of words", "", None, "x\n\ny"]
    x, size, per = quality.line_signals(texts)
    cuts = quality.cut_points(x)
    model = {"w": rng.normal(size=3 * len(quality.SIGNALS) * (quality.BINS + 1)), "bias": 0.3, "trans": rng.normal(size=(2, 2)), "cuts": cuts}
    own = np.stack([np.searchsorted(cuts[j], x[:, j], side="left") for j in range(x.shape[1])], axis=1)
    got, at, width = quality.score(texts, model), 0, quality.BINS + 1
    for i, n in enumerate(per):
        gaps = []
        for k in range(n):
            near = [own[at + k], own[at + k - 1] if k else None, own[at + k + 1] if k + 1 < n else None]
            gaps.append(0.3 + sum(model["w"][(b * x.shape[1] + j) * width + (quality.BINS if v is None else v[j])] for b, v in enumerate(near) for j in range(x.shape[1])))
        paths = list(itertools.product((0, 1), repeat=int(n)))
        w = np.array([math.exp(sum((y - 0.5) * g for y, g in zip(path, gaps, strict=True)) + sum(model["trans"][a, b] for a, b in itertools.pairwise(path))) for path in paths])
        p = (w[:, None] * np.array(paths)).sum(axis=0) / w.sum()
        length = np.maximum(size[at : at + n], 1)
        assert got[i] == pytest.approx((p * length).sum() / length.sum())
        assert got[i] == quality.score([texts[i]], model)[0]
        at += n


# op8


@pytest.mark.parametrize("docs_per_shard", [10_000, 100, 1])
def test_mixing_of_thin_sources(spark, docs_per_shard):
    """Within a block of the target, whatever the number of shards; the plan's rows never reach the driver."""
    rows = [(i, "w " * 2, "a") for i in range(200)] + [(1000 + i, "w " * 5, "b") for i in range(400)] + [(2000 + i, "w " * 40, "c") for i in range(1000)]
    rows += [(9000 + i, "w x", f"u{i}") for i in range(100)] + [(9900, "", None), (9901, None, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken, target, words = Counter(), {}, Counter()
    for r in mixing.mix_sources(df, docs_per_shard=docs_per_shard).collect():
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
        words[r["source"]] += r["size"]
        target[r["source"]] = r["target"]
    assert all(abs(taken[s] - target[s]) <= 64 for s in target)
    assert sum(target.values()) == pytest.approx(1.5 * sum(words.values())) and target[None] == target["z"] == 0


def test_mixing_weights_follow_code_points(spark):
    names = ["Z", "a", "é", "ﬀ", "😀", None]
    df = spark.createDataFrame([(i, "w " * 1000, s) for i, s in enumerate(names)], "doc_id long, text string, source string")
    target = {r["source"]: r["target"] for r in mixing.mix_sources(df, share=1.0).collect()}
    assert [round(target[s] / 500) for s in names] == [3, 1, 2, 3, 1, 2]


# op9


def test_language_score_is_a_function_of_the_text():
    texts = ["the cat and the dog with the house", "le chat et le chien avec la maison", "der hund und die katze " * 9, "x" * 300 + " ab", "", None, "123"]
    model = langid.fit(texts[:3] * 5, ["en", "fr", "de"] * 5)
    together = langid.predict(texts * 3, model)
    assert together == [langid.predict([t], model)[0] for t in texts] * 3
    assert langid.predict(list(reversed(texts)), model) == list(reversed(together[: len(texts)]))


def test_language_features_and_marginals_by_hand():
    def plain(word):
        codes, out = [ord(c) for c in word], []
        hashed = lambda *parts: int(langid._hash(*(np.array([p], np.uint32) if i else p for i, p in enumerate(parts)))[0])
        for n in (1, 2, 3):
            out += [hashed(n, *codes[j : j + n]) for j in range(len(codes) - n + 1)]
            if len(codes) >= n:
                out += [hashed(10 + n, *codes[:n]), hashed(20 + n, *codes[-n:])]
        import xxhash

        return sorted([*out, hashed(30, xxhash.xxh32_intdigest(word.encode()))])

    words = ["a", "chien", "the", "größe"]
    with np.errstate(over="ignore"):
        f, whose = langid.word_features(words)
        for i, w in enumerate(words):
            assert sorted(f[whose == i].tolist()) == plain(w)
    rng = np.random.default_rng(1)
    model = {"langs": ["x", "y"], "w": rng.normal(size=(langid.TABLE, 2)), "trans": rng.normal(size=(2, 2))}
    scores = langid.word_scores(words, model["w"])
    paths = list(itertools.product((0, 1), repeat=4))
    w = np.array([math.exp(sum(scores[i, y] for i, y in enumerate(p)) + sum(model["trans"][a, b] for a, b in itertools.pairwise(p))) for p in paths])
    p = np.stack([(w[:, None] * (np.array(paths) == y)).sum(axis=0) / w.sum() for y in (0, 1)], axis=1)
    size = np.array([len(x) for x in words])
    total = (p * size[:, None]).sum(axis=0) / size.sum()
    (lang, score), = langid.predict([" ".join(words)], model)
    assert lang == "xy"[total.argmax()] and score == pytest.approx(total.max())


@pytest.mark.parametrize("parts", [1, 7])
def test_language_by_any_partitioning(spark, sf, parts):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = langid.fit(["the cat and the dog", "le chat et le chien"] * 5, ["en", "fr"] * 5)
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.identify(docs.repartition(parts), model).collect()}
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert all(got[i] == langid.predict([text[i]], model)[0] for i in list(text)[:60])


@pytest.mark.parametrize("run", [lambda d: langid.identify(d, langid.fit([], []), keep=("doc_id", "score", "lang_pred")), lambda d: quality.classify(d, {"w": np.zeros(1), "bias": 0.0, "trans": np.zeros((2, 2)), "cuts": np.zeros((13, 8))}, keep=("doc_id", "score"))])
def test_kept_columns_give_way(spark, run):
    df = spark.createDataFrame([(1, None, "x", "y"), (1, None, "x", "y")], "doc_id long, text string, score string, lang_pred string")
    out = run(df)
    assert len(out.columns) == len(set(out.columns)) and out.count() == 2 and run(df.limit(0)).count() == 0


# op10


def test_neardup_recall_close_to_the_threshold(spark):
    """Pairs planted at similarities of 0.80 to 0.86: every one found, nothing else linked."""
    rng = np.random.default_rng(7)
    rows, pairs = [], []
    while len(pairs) < 1000:
        n = int(rng.integers(30, 300))
        a = [f"p{len(rows)}_{k}" for k in range(n)]
        cut = int(round((n - 3) * (1 - (s := rng.uniform(0.8, 0.86))) / (1 + s)))
        b = a[: n - cut] + [f"z{len(rows)}_{k}" for k in range(cut)]
        x, y = ({tuple(w[i : i + 4]) for i in range(n - 3)} for w in (a, b))
        if 100 * len(x & y) >= 80 * len(x | y):
            pairs.append((len(rows), len(rows) + 1))
            rows += [(len(rows), " ".join(a)), (len(rows) + 1, " ".join(b))]
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), k=4).collect()}
    assert all(got[b] == a == got[a] for a, b in pairs)


def test_neardup_strangers_in_a_large_bucket(spark):
    """One band for all: a bucket of many copies and several small groups, in parts of two nodes."""
    base = [f"b{i}" for i in range(40)]
    texts = [" ".join([*base, f"x{i}"]) for i in range(12)] + [" ".join([*base[:34], *(f"y{i // 2}_{k}" for k in range(6)), f"e{i}"]) for i in range(8)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = [{tuple(t.split()[i : i + 4]) for i in range(len(t.split()) - 3)} for t in texts]
    comp = list(range(len(sets)))
    for _ in sets:
        for i, j in itertools.combinations(range(len(sets)), 2):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                comp[i] = comp[j] = min(comp[i], comp[j])
    for block in (2, 1024):
        got = neardup.near_duplicates(df, k=4, bands=60, rows=1, block=block).collect()
        assert [r["component_id"] for r in sorted(got, key=lambda r: r["doc_id"])] == comp


# op4 and the registry


def test_secret_plan_has_no_python(spark, sf):
    for df in (secrets.find_secrets(spark.read.parquet(f"{sf}/documents.parquet"), keep=("text",)),):
        plan = df._jdf.queryExecution().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_registry_has_one_query_an_operator():
    assert sorted(n.split("_")[0] for n in registry.QUERIES if n != "pipeline") == sorted(f"op{i}" for i in range(1, 11))
