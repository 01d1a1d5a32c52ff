"""Language ID, near duplicates, decontamination, page wrappers and the pipeline against brute force."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from routecast.llm import decontamination, graph, html_wrappers, language, near_duplicates, textscan

SF = "/root/testdata/sf0.01"


def _lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


# ---- words


@pytest.mark.parametrize("segment", [1 << 20, 16, 50])
def test_words_equal_a_regular_expression(segment, monkeypatch):
    monkeypatch.setattr(textscan, "SEGMENT", segment)
    rng = random.Random(segment)
    texts = [None, "", " ", "a", "A b\tc", "Éa É-b", "x" * 100, *("".join(rng.choice("abC \n.-é世0") for _ in range(rng.randrange(80))) for _ in range(60))]
    for table, pattern in ((near_duplicates.WORD, r"[^\x20\x09-\x0D]+"), (decontamination.WORD, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        seen: dict[int, str] = {}
        rows: list[list[str]] = [[] for _ in texts]
        want = [re.findall(pattern, _lower(t)) for t in texts]
        for w in textscan.words(pa.array(texts, pa.string()), table):
            b = w.bounds()
            for r in range(w.hi - w.lo):
                own = w.number[b[r] : b[r + 1]].tolist()
                assert len(own) == len(want[w.lo + r])
                for h, word in zip(own, want[w.lo + r]):
                    assert seen.setdefault(h, word) == word
                    rows[w.lo + r].append(seen[h])
        assert rows == want
        assert len(seen) == len({x for t in want for x in t})


# ---- near duplicates


def _sets(texts):
    out = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", _lower(t))
        out.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    return out


def _components(keys, sets):
    root = list(range(len(keys)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                root[find(i)] = find(j)
    groups: dict = {}
    for i in range(len(keys)):
        groups.setdefault(find(i), []).append(i)
    best = {g: min((keys[i] is None, keys[i] or 0) for i in v) for g, v in groups.items()}
    return [None if best[find(i)][0] else best[find(i)][1] for i in range(len(keys))]


def _varied(seed, n=260):
    """Bases, chains of small edits, shared passages, copies, subsets, short and empty texts."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 6)))
    passage = [word() for _ in range(30)]
    bases = [[word() for _ in range(rng.choice([1, 3, 5, 6, 8, 20, 60, 150]))] for _ in range(25)]
    texts = [None, "", "  ", "a", "A", "a b c d", "a b c d e", "A b c d e"]
    while len(texts) < n:
        w = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 2, 3, 6])):
            at = rng.randrange(len(w) + 1)
            w[at : at + rng.randrange(2)] = [word()] * rng.randrange(2)
        if rng.random() < 0.3:
            w = w + passage if rng.random() < 0.5 else passage + w
        if rng.random() < 0.2:
            bases.append(w)
        texts.append(rng.choice([" ", "  ", "\n"]).join(w))
    return texts


@pytest.mark.parametrize("seed,block", [(1, 1024), (2, 16), (3, 5)])
def test_near_duplicates_equal_brute_force(table, spark, seed, block, monkeypatch):
    monkeypatch.setattr(near_duplicates, "DELEGATES", 3)
    monkeypatch.setattr(near_duplicates, "CHAIN", 2)
    monkeypatch.setattr(near_duplicates, "BLOCK", block)
    texts = _varied(seed)
    keys = list(range(len(texts)))
    random.Random(seed).shuffle(keys)
    keys[40], keys[41], keys[42] = None, None, keys[43]
    docs = table(spark.createDataFrame([(k, t, 1, "x") for k, t in zip(keys, texts)], "doc_id long, text string, n long, component_id string").repartition(3))
    rows = near_duplicates.near_duplicates(docs).collect()
    sets = _sets(texts)
    want = sorted(map(str, zip(keys, map(len, sets), _components(keys, sets))))
    assert sorted(str((r.doc_id, r.n_shingles, r.component_id)) for r in rows) == want
    # One first row in each component, and it bears the component's key.
    firsts = [r for r in rows if r.is_first]
    assert all(r.doc_id == r.component_id for r in firsts)
    linked = [r for r in firsts if r.n_shingles]
    assert len({r.component_id for r in linked if r.component_id is not None}) <= len(linked)


def test_near_duplicates_in_buckets_by_tokens(table, spark, monkeypatch):
    """Many small buckets, more than the session's partitions: the same groups, and more tasks for them."""
    rng = random.Random(5)
    base = [[f"w{rng.randrange(500)}" for _ in range(40)] for _ in range(60)]
    texts = [" ".join(b if k % 3 else [*b[:-1], f"new{k}"]) for k, b in enumerate(base * 3)]
    docs = table(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    few = sorted(map(tuple, near_duplicates.near_duplicates(docs).collect()))
    monkeypatch.setattr(near_duplicates, "BUCKET_TOKENS", 100)
    sized = spark.createDataFrame([(3000,), (1001,)], "n long")
    n = near_duplicates._buckets(sized)
    assert n == max(41, 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))) and near_duplicates._buckets(sized.limit(0)) > 0
    assert sorted(map(tuple, near_duplicates.near_duplicates(docs).collect())) == few
    assert len({r[3] for r in few}) == 60


def test_near_duplicates_hot_groups(table, spark):
    base = [f"w{i}" for i in range(40)]
    texts = [" ".join(base)] * 300 + [" ".join(base[:-2] + [f"e{i}", f"f{i}"]) for i in range(300)] + [" ".join([f"u{i}x{k}" for k in range(50)] + base[:30]) for i in range(300)]
    docs = table(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    got = {r.doc_id: r.component_id for r in near_duplicates.near_duplicates(docs).collect()}
    assert all(got[i] == 0 for i in range(600)) and all(got[i] == i for i in range(600, 900))


def test_near_duplicates_empty(table, odd_docs):
    assert near_duplicates.near_duplicates(table(odd_docs.limit(0))).count() == 0
    assert near_duplicates.near_duplicates(table(odd_docs)).count() == odd_docs.count()


def test_components(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 80)] + [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(70)] + [(7, 7), (900, 901), (901, 900)]
    got = {r.node: r.label for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = sorted({x for a, b in edges for x in (a, b) if a != b})
    root = {x: x for x in nodes}
    for _ in range(100):
        for a, b in edges:
            if a != b:
                root[a] = root[b] = min(root[a], root[b])
    assert got == root
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---- decontamination


def _brute_contamination(texts, items, window):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", _lower(t))
    wins: dict = {}
    for i, t in items:
        w = words(t)
        if t is not None and w:
            n = min(window, len(w))
            for a in range(len(w) - n + 1):
                wins.setdefault(tuple(w[a : a + n]), set()).add("" if i is None else str(i))
    out = []
    for t in texts:
        w = words(t)
        hit, found = set(), set()
        for n in {len(x) for x in wins}:
            for a in range(len(w) - n + 1):
                if tuple(w[a : a + n]) in wins:
                    hit |= set(range(a, a + n))
                    found |= wins[tuple(w[a : a + n])]
        spans = [[min(g), max(g) + 1] for g in _runs(sorted(hit))]
        out.append((len(w), len(hit), spans, sorted(found)))
    return out


def _runs(xs):
    out: list[list[int]] = []
    for x in xs:
        if out and out[-1][-1] == x - 1:
            out[-1].append(x)
        else:
            out.append([x])
    return out


@pytest.mark.parametrize("seed,block_bytes,hot", [(1, 1 << 20, None), (2, 1 << 20, None), (3, 300, None), (2, 0, 3)])
def test_contamination_equals_brute_force(table, spark, seed, block_bytes, hot, monkeypatch):
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", block_bytes)
    if hot:
        monkeypatch.setattr(decontamination, "EMITTED", hot)
    rng = random.Random(seed)
    vocabulary = ["a", "b", "c", "dd", "É", "x9", "世"]
    run = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(i, rng.choice([" ", ", ", "-"]).join(run(rng.choice([1, 2, 3, 4, 5, 6, 9, 12])))) for i in range(12)] + [(None, "dd dd dd dd"), (3, "q r s t u v"), (50, None), (51, ""), (52, "...")]
    items = [(i, t) for i, t in items if t is None or len(t.split()) != 1 or seed == 2]
    texts = [None, "", "..", *(rng.choice([" ", "! "]).join(run(rng.randrange(60))).upper() for _ in range(80)), *(f"zz {t} yy" for _, t in items if t), *(items[k][1] for k in range(3))]
    keys = [rng.choice([None, 1, 2, 3, 4]) if k % 5 == 0 else k for k in range(len(texts))]
    docs = table(spark.createDataFrame([(k, t, 0, "clash") for k, t in zip(keys, texts)], "doc_id long, text string, n_hit long, items string"))
    found = decontamination.find_contamination(docs, spark.createDataFrame(items, "item_id long, text string"), window=5).collect()
    want = _brute_contamination(texts, items, 5)
    got = sorted(str((r.doc_id, r.n_words, r.n_hit, [[s.first, s.end] for s in r.spans], r["items"])) for r in found)
    assert got == sorted(str((k, *w)) for k, w in zip(keys, want))


def test_many_items_stay_out_of_the_driver(spark, monkeypatch):
    """Fifty blocks of items: two passes over the documents, no window built in the driver, a hot passage and struct keys."""
    passes = []
    for name in ("_counted", "_hits"):
        plain = getattr(decontamination, name)
        monkeypatch.setattr(decontamination, name, lambda *a, plain=plain: passes.append(1) or plain(*a))
    monkeypatch.setattr(decontamination, "_Windows", None)
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 1000)
    monkeypatch.setattr(decontamination, "EMITTED", 16)
    rng = random.Random(11)
    run = lambda n: " ".join(f"w{rng.randrange(4000)}" for _ in range(n))
    items = [(f"i{k}", run(100)) for k in range(100)]
    hot = " ".join(items[7][1].split()[20:35])
    texts = [f"{run(30)} {hot} {run(30)}" if k % 3 == 0 else f"{run(50)} {items[k % 100][1]}" if k % 50 == 1 else run(80) for k in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").select(F.struct("*").alias("doc"))
    found = decontamination.find_contamination(docs, spark.createDataFrame(items, "item_id string, text string"), key="doc", text="doc.text")
    rows = found.select("doc.doc_id", "n_words", "n_hit", "spans", "items").collect()
    want = _brute_contamination(texts, items, 10)
    assert sorted(str((r.doc_id, r.n_words, r.n_hit, [[s.first, s.end] for s in r.spans], r["items"])) for r in rows) == sorted(str((k, *w)) for k, w in enumerate(want))
    assert sum(r.n_hit > 0 for r in rows) >= 100 and len(passes) == 2


def test_contamination_without_items_or_documents(table, spark, odd_docs):
    items = spark.createDataFrame([], "item_id long, text string")
    rows = decontamination.find_contamination(table(odd_docs), items).collect()
    assert len(rows) == odd_docs.count() and not any(r.n_hit for r in rows)
    some = spark.createDataFrame([(1, "the quick brown fox")], "item_id long, text string")
    assert decontamination.find_contamination(odd_docs.limit(0), some).count() == 0
    assert sum(r.n_hit for r in decontamination.find_contamination(table(odd_docs), some).collect()) == 4 * 4


# ---- language


def test_language_accuracy_on_held_out_rows(spark):
    from routecast.llm.queries import op4_string_kernels

    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = [r for r in op4_string_kernels(spark, SF).collect() if r.held_out]
    assert len(rows) > 100
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in rows]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_odd_rows(odd_docs):
    model = language.fit(odd_docs)
    assert model is not None and model.languages == ["en"]
    out = language.predict(odd_docs, model)
    assert out.columns == [c for c in odd_docs.columns if c != "score"] + ["lang_pred", "score"]
    for r in out.collect():
        assert r.lang_pred == ("en" if r.text and any(c.isalpha() for c in r.text) else "und"), r
        assert r.key == "clash"
    nothing = language.predict(odd_docs, language.fit(odd_docs.limit(0))).collect()
    assert {(r.lang_pred, r.score) for r in nothing} == {("und", 0.0)}
    assert language.predict(odd_docs.limit(0), model).count() == 0


def test_language_sample_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(language, "SAMPLE", 40)
    monkeypatch.setattr(language, "LANDMARKS", 12)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language.fit(docs, spread="doc_id")
    assert model.languages == ["de", "en", "es", "fr"]
    rows = language.predict(docs.select("lang", "text"), model).collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.9


def test_three_hundred_languages(spark):
    """More languages than landmarks' worth of rows, each with words of its own."""
    rng = random.Random(5)
    words = {f"l{i:03d}": ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(12)] for i in range(300)}
    rows = [(k * 300 + i, " ".join(rng.choice(own) for _ in range(40)), name) for k in range(6) for i, (name, own) in enumerate(words.items())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(docs, spread="doc_id")
    assert len(model.languages) == 300 and len(model.weights) == 1
    got = language.predict(docs, model).select("lang", "lang_pred").collect()
    assert sum(r.lang == r.lang_pred for r in got) / len(got) > 0.9


def test_more_languages_than_landmarks(spark, monkeypatch):
    """Scores through the landmarks are the scores of one matrix."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 200")
    one = language.fit(docs, spread="doc_id")
    monkeypatch.setattr(language, "LANDMARKS", 3)
    two = language.fit(docs, spread="doc_id")
    assert len(one.weights) == 1 and len(two.weights) == 2
    assert {r.lang_pred for r in language.predict(docs, two).collect()} <= set(one.languages)


def test_long_texts_are_read_in_segments(monkeypatch):
    text = "Ünïcode Σας tail wörds 世界 " * 50
    whole = language.present(text, np.zeros(1 << language.BITS, bool)).copy()
    for size in (1, 7, 64):
        monkeypatch.setattr(language, "SEGMENT", size)
        assert (language.present(text.replace("Σ", "s"), np.zeros(1 << language.BITS, bool)) == language.present(text.replace("Σ", "s"), np.ones(1 << language.BITS, bool))).all()
        cut = language.present(text.replace("Σ", "σ"), np.zeros(1 << language.BITS, bool)).copy()
        monkeypatch.setattr(language, "SEGMENT", 1 << 18)
        assert (cut == language.present(text.replace("Σ", "σ"), np.zeros(1 << language.BITS, bool))).all()
    assert whole.any() and not language.present("", np.zeros(1 << language.BITS, bool))[:0].any()


def test_unlabelled_corpus_keeps_every_text_with_a_letter(spark):
    import corpus_pipeline

    rows = [(i, t, None, "s", 1) for i, t in enumerate(["some words", "世界", "é", None, "", "123 ...", "x1"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.language_id(spark, docs, SF)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [0, 1, 2, 6]
    assert corpus_pipeline.language_id(spark, docs.withColumn("doc_id", F.lit(None).cast("long")), SF).count() == 4


def test_held_out(spark):
    import zlib

    rows = spark.range(100).select(F.col("id").alias("doc_id"), language.held_out("doc_id").alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)


# ---- pages

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><p>no</p>";</script></head><body>
<nav><ul><li><a href="/a">Menu %d</a></li><li>More</li></ul></nav><div class="cookie-notice">We use cookies</div><aside><p>Side %d</p></aside>
<article><h1>Head &amp; tail %d</h1><p>One <b>bold</b>
text&nbsp;here&#33;<p>Two &lt;x&gt;%s</p><form><p>Mail</p></form><section class="comments"><p>Reader %d</p></section></article><div class="ad">Buy</div><footer>&copy; us</footer></body></html>"""


def _pages():
    rows = [(i, f"https://Host{i % 3}.example.org/p?{i}", PAGE % (i, i, i, "".join(f"<p>Item {k}" for k in range(i % 4)), i)) for i in range(12)]
    return rows + [
        (100, None, None),
        (101, "nonsense", ""),
        (102, "http://bare.example.org/1", "<div class=menu>Same</div><p>Only 1</p>plain<br>line<!-- no <p>x</p> -->"),
        (103, "http://bare.example.org/2", "<div class=menu>Same</div><p>Only 2</p>plain<br>line"),
        (104, "http://bare.example.org/3", "<p>unclosed <i>x<p>next<script>never closed <p>"),
        (104, "http://bare.example.org/3", "<p>unclosed <i>x<p>next<script>never closed <p>"),
    ]


def test_pages(spark, monkeypatch):
    monkeypatch.setattr(html_wrappers, "ALIGNED", 2)
    pages = spark.createDataFrame([(*r, "x", 1) for r in _pages()], "page_id long, url string, html string, host string, text long")
    wrappers = html_wrappers.infer_wrappers(pages)
    rows = sorted(html_wrappers.extract_text(pages, wrappers).collect(), key=lambda r: r.page_id)
    got = [(r.page_id, r.text) for r in rows]
    want = [(i, "\n".join([f"Head & tail {i}", "One bold text here!", "Two <x>", *(f"Item {k}" for k in range(i % 4))])) for i in range(12)]
    want += [(100, ""), (101, ""), (102, "Only 1\nplain line"), (103, "Only 2\nplain line"), (104, "unclosed x\nnext"), (104, "unclosed x\nnext")]
    assert got == want
    by_host = {r.host: r for r in wrappers.collect()}
    assert by_host["host0.example.org"].n_pages == 4
    assert "(" in by_host["host1.example.org"].wrapper
    assert html_wrappers.extract_text(pages.limit(0), wrappers).count() == 0
    assert html_wrappers.infer_wrappers(pages.limit(0)).count() == 0


def test_pages_without_a_broadcast(spark, monkeypatch):
    monkeypatch.setattr(html_wrappers, "BROADCAST_BYTES", 0)
    pages = spark.createDataFrame(_pages(), "page_id long, url string, html string")
    assert html_wrappers.extract_text(pages, html_wrappers.infer_wrappers(pages)).where("text = 'Only 1\nplain line'").count() == 1


def test_alignment():
    a = html_wrappers.grouped(["<ul>", "<li>", "#", "</li>", "<li>", "#", "</li>", "</ul>"])
    assert html_wrappers.as_text(a) == "<ul>(<li>#</li>)+</ul>"
    one = html_wrappers.grouped(["<ul>", "<li>", "#", "</li>", "</ul>"])
    assert html_wrappers.as_text(html_wrappers.aligned(a, one)) == "<ul>(<li>#</li>)+</ul>"
    more = html_wrappers.grouped(["<h1>", "#", "</h1>", "<ul>", "<li>", "#", "</li>", "</ul>"])
    assert html_wrappers.as_text(html_wrappers.aligned(a, more)) == "(<h1>#</h1>)?<ul>(<li>#</li>)+</ul>"
    assert html_wrappers.aligned(a, a) == a


def test_given_pages_equal_their_article(spark):
    import html as entities

    from routecast.llm.queries import op8_html_wrappers

    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = op8_html_wrappers(spark, SF).collect()
    assert len(rows) == len(pages)
    for r in rows:
        article = re.search(r"<article>(.*?)</article>", pages[r.page_id].html, re.S)[1]
        parts = (" ".join(entities.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in re.split(r"<(?:/?(?:p|h1)|br)>", article))
        assert r.text == "\n".join(x for x in parts if x)
        assert (r.n_chars, r.url) == (len(r.text), pages[r.page_id].url)


# ---- pipeline


def test_pipeline_equals_brute_force(spark, tmp_path, plain):
    """On copies of given rows plus planted ones: language, near duplicates, leaks, then packing."""
    import shutil

    import corpus_pipeline

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    benchmark = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    leak = benchmark.where("length(text) > 80").first().text
    long_text = docs.where("length(text) > 400").first().text
    top = docs.agg(F.max("doc_id")).first()[0]
    planted = [(top + 1, None), (top + 2, ""), (top + 3, "123 456 !"), (top + 4, long_text + " more"), (top + 5, f"zebra {leak} zebra"), (top + 6, long_text), (top + 6, long_text), (None, "only words without any key at all")]
    extra = spark.createDataFrame([(k, t, None, None, None) for k, t in planted], docs.schema)
    sf = tmp_path / "sf"
    docs.unionByName(extra).withColumn("row", F.lit(1)).withColumn("doc", F.lit("x")).repartition(2).write.parquet(str(sf / "documents.parquet"))
    shutil.copy("/root/testdata/sf0.001/benchmark.parquet", sf / "benchmark.parquet")

    rows = spark.read.parquet(str(sf / "documents.parquet")).collect()
    lettered = [r for r in rows if r.text and any(c.isalpha() for c in r.text)]
    sets = _sets([r.text for r in lettered])
    groups = _components([r.doc_id for r in lettered], sets)
    seen, kept = set(), []
    for r, g in zip(lettered, groups):
        if r.doc_id == g and g not in seen:
            seen.add(g)
            kept.append(r)
    items = [(r.item_id, r.text) for r in benchmark.collect()]
    clean = [r for r, c in zip(kept, _brute_contamination([r.text for r in kept], items, 10)) if not c[1]]

    stages = [n for n, _ in corpus_pipeline.STAGES]
    assert stages == ["language_id", "near_duplicates", "decontamination", "best_fit_packing"]
    frame, sizes = spark.read.parquet(str(sf / "documents.parquet")), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, frame, str(sf))
        assert out.columns == frame.columns
        out.write.parquet(str(tmp_path / f"s{k}"))
        frame = spark.read.parquet(str(tmp_path / f"s{k}"))
        sizes.append(frame.count())
    assert sizes == [len(lettered), len(kept), len(clean)]
    pieces = corpus_pipeline.run(spark, str(sf)).collect()
    assert sorted(str((r.doc_id, r.piece)) for r in pieces) == sorted(str((r.doc_id, p)) for r in clean for p in range(-(-(len(plain(r.text)) + 1) // 4096)))
    assert top + 5 not in {r.doc_id for r in pieces} and top + 4 not in {r.doc_id for r in pieces}


def test_stages_take_an_empty_table(spark, tmp_path):
    import corpus_pipeline

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(0)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    frame = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, frame, "/root/testdata/sf0.001").count() == 0


def test_items_digest():
    assert hashlib.sha256(b"").hexdigest() == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


# ---- pages: the wrapper's slots


def _read(spark, rows):
    """Texts of (url, html) rows, in their order."""
    pages = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "page_id long, url string, html string")
    out = html_wrappers.extract_text(pages, html_wrappers.infer_wrappers(pages)).collect()
    return [r.text for r in sorted(out, key=lambda r: r.page_id)]


def test_slots_are_places_in_the_wrapper(spark):
    """Same path, other place: a line that every page has goes, the varying one stays."""
    rows = [(f"http://slots.org/{i}", f"<body><p>Welcome</p><h1>Head {i}</h1><p>Text {i}</p><hr><p>Bye</p></body>") for i in range(3)]
    assert _read(spark, rows) == [f"Head {i}\nText {i}" for i in range(3)]


@pytest.mark.parametrize("widest", [1000, 20])
def test_wrapper_has_every_stream(widest, monkeypatch):
    monkeypatch.setattr(html_wrappers, "WIDEST", widest)
    rng = random.Random(8)
    parts = [["<p>", "#", "</p>"], ["<h2>", "#", "</h2>"], ["<ul>", "<li>", "#", "</li>", "</ul>"], ["<li>", "#", "</li>"], ["#"]]
    for _ in range(60):
        streams = [[t for _ in range(rng.randrange(9)) for t in rng.choice(parts)] for _ in range(6)]
        whole = html_wrappers.grouped(streams[0])
        for s in streams[1:]:
            whole = html_wrappers.narrowed(html_wrappers.aligned(whole, html_wrappers.grouped(s)))
        matcher = html_wrappers.Matcher(whole)
        for s in streams:
            group, became = html_wrappers.folded(s)
            assert matcher.places(s) is not None and len(became) == s.count("#")
            assert len(matcher.slots(group)) == len(set(became))
        assert len(matcher.tokens) < sum(map(len, streams)) or not any(streams)


def test_long_groups():
    body = [f"<t{k}>" for k in range(40)]
    assert html_wrappers.grouped(["<a>", *body * 3, "<b>"]) == ["<a>", ["+", *body], "<b>"]


PROSE = "Long sentences of number %d follow one another here, so that nobody takes this for a menu, a notice or a button."


def test_class_words_do_not_empty_a_page(spark):
    frames = ['<html class="menu-closed"><body class="has-sidebar">%s</body></html>', '<body><article class="post has-comments">%s</article></body>', '<main class="search">%s</main>', '<body><div class="page has-sidebar">%s</div></body>']
    rows = [(f"http://frame{n}.org/{i}", f % f"<div class=menu>Menu {i}</div><p>{PROSE % i}</p>") for n, f in enumerate(frames) for i in range(2)]
    assert _read(spark, rows) == [PROSE % i for _ in frames for i in range(2)]


def test_slugs_and_sections_inside_content(spark):
    """Ids made from titles are no class words; long varying texts overrule one, but no notice and no comments."""
    page = """<article><h2 id="how-to-share-data">Share %d</h2><section id="search-methods"><p>Methods %d</p></section>
<div class="notice"><p>""" + PROSE + """</p></div><div class="widget"><p>""" + PROSE + """</p></div><div class="share">Tweet %d</div><div class="comments"><p>""" + PROSE + """</p></div></article>"""
    rows = [(f"http://slug.org/{i}", page % (i, i, -i, i, i, -i)) for i in range(1, 4)]
    assert _read(spark, rows) == [f"Share {i}\nMethods {i}\n{PROSE % i}" for i in range(1, 4)]


NEVER = """<section id="comments"><p>%s</p></section><ol class="commentlist"><li>%s</li></ol><div class="notice"><p>%s</p></div>
<div class="breadcrumb"><a>Home</a> %s</div><div class="cookie-consent"><p>%s</p></div><div id="respond">%s</div><div class="share">Share this</div><form><p>%s</p></form>"""


def test_comments_notices_consent_and_navigation_are_no_text(spark):
    """Inside article and main, on hosts with one page, with few and with many; readers' comments outside too, longer than the text."""
    rows, want = [], []
    for host, many in (("one", 1), ("few", 3), ("many", 12)):
        for frame in ("article", "main"):
            for i in range(many):
                other = NEVER % tuple(PROSE % (100 * i + k) for k in range(7))
                rows.append((f"http://{host}-{frame}.org/{i}", f"<body><{frame}><h1>Title {i}</h1><p>{PROSE % i}</p>{other}</{frame}></body>"))
                want.append(f"Title {i}\n{PROSE % i}")
    for i in range(3):
        thread = "".join(f"<p>{PROSE % (1000 * i + k)}</p>" for k in range(6))
        rows.append((f"http://thread.org/{i}", f'<body><div class="text"><p>{PROSE % i}</p></div><div class="comments">{thread}</div></body>'))
        want.append(PROSE % i)
    assert _read(spark, rows) == want


def test_pages_are_read_in_linear_time():
    """Tags and quotes that never end, very deep pages, and tags that were never opened: a megabyte in seconds."""
    import time

    for source in ("<a " * 350_000, '<a "' * 250_000, "<!" * 500_000, "<div>" * 200_000 + "x", "<nav>" * 100_000 + "</p>" * 100_000, "<b><p>" * 80_000, '<div class="x y">' * 50_000 + "</div>" * 50_000):
        t = time.time()
        html_wrappers.parsed(source)
        assert time.time() - t < 8, source[:20]
    deep = "<div>" * 300 + "<p>text</p>" + "<nav>menu</nav>" + "</div>" * 300
    texts = html_wrappers.parsed(deep)[1]
    assert [t for _, t in texts] == ["text", "menu"] and "!nav" in texts[1][0] and "!" not in texts[0][0]


def test_teasers_are_not_the_text(spark):
    """Articles in furniture mark nothing; teaser cards beside longer text aren't the text; other pages of the host stay."""
    aside = '<div class=text><p>' + PROSE + '</p></div><aside><article><p>Teaser %d</p></article></aside>'
    cards = '<div class=text><p>' + PROSE + '</p><p>' + PROSE + '</p></div><article><p>Card %d</p></article><article><p>Card %d</p></article>'
    rows = [(f"http://aside.org/{i}", aside % (i, i)) for i in range(3)] + [(f"http://cards.org/{i}", cards % (i, i, i, -i)) for i in range(3)]
    rows += [("http://cards.org/only", "<article><p>Only a card</p></article>"), ("http://texts.org/1", f"<p>Tag 1</p><article>{PROSE % 1}</article>"), ("http://texts.org/2", "<p>No article 2</p>")]
    want = [PROSE % i for i in range(3)] + [f"{PROSE % i}\n{PROSE % i}" for i in range(3)] + ["Only a card", PROSE % 1, "No article 2"]
    assert _read(spark, rows) == want


def test_copies_of_one_page_keep_their_text(spark):
    """Rows that are all copies of one page, or differ in furniture only, show no template."""
    page = '<body><div class="page has-menu"><p>' + PROSE % 7 + '</p></div></body>'
    rows = [("http://copy.org/1", "<body><nav>Menu</nav><p>Same text</p></body>")] * 3 + [("http://copies.org/1", page)] * 2
    rows += [(f"http://counted.org/{i}", f"<p>Same text</p><footer>{i} views</footer><div class=widget>{i} likes</div>") for i in range(2)]
    rows += [("http://two.org/1", "<div>Site</div><p>Text 1</p>")] * 3 + [("http://two.org/2", "<div>Site</div><p>Text 2</p>")]
    assert _read(spark, rows) == ["Same text"] * 3 + [PROSE % 7] * 2 + ["Same text"] * 2 + ["Text 1"] * 3 + ["Text 2"]


def test_near_duplicates_when_scans_are_split_anew(spark, tmp_path, monkeypatch):
    """Each job splits its scans in another way; rows keep their numbers."""
    import corpus_pipeline
    from routecast.llm import store

    rng = random.Random(5)
    texts = [" ".join(rng.choice("abcdefghijklmnop") * rng.randrange(1, 9) for _ in range(60)) for _ in range(20)]
    rows = [(i, f"{texts[i % 20]} {i // 20}" if i % 20 < 15 else f"alone {i} " + " ".join(f"w{i}x{k}" for k in range(30))) for i in range(80)]
    path = str(tmp_path / "docs.parquet")
    spark.createDataFrame(rows, "doc_id long, text string").repartition(8).write.parquet(path)
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    calls, written = [], store.written

    def split(k):
        for n, v in zip(names, (("128MB", "0"), ("2KB", "0"), ("6KB", "4KB"))[k % 3]):
            spark.conf.set(n, v)

    def written_then_split_anew(df, name):
        out = written(df, name)
        calls.append(name)
        split(len(calls))
        return out

    monkeypatch.setattr(store, "written", written_then_split_anew)
    want = {i: i % 20 if i % 20 < 15 else i for i, _ in rows}
    try:
        docs = spark.read.parquet(path)
        split(0)
        got = {r.doc_id: r.component_id for r in near_duplicates.near_duplicates(docs).collect()}
        assert got == want
        split(0)
        kept = [r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()]
        assert sorted(kept) == sorted(set(want.values()))
    finally:
        for n, v in zip(names, before):
            spark.conf.set(n, v)
