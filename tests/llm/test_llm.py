"""Operators against brute force on small tables: nulls, empty and very long texts, ties, repeated rows, clashing columns, empty tables."""

import hashlib
import random
import re
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import bpe, components, embedding_join, html_text, langid, mixing, ngram_join, pii, quality_model, quality_rules, substring_dedup

WORD = r"[^\x20\x09-\x0D]+"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(n, seed, words=400):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(words)}" for _ in range(n))


def documents():
    base = prose(200, 1).split()
    near = [*base]
    near[50] = "changed"
    far = [*base]
    for i in range(0, 200, 4):
        far[i] = f"x{i}"
    shared = prose(60, 2)
    texts = [
        None, "", " \t\n", "one two", "One TWO", "hello", " ".join(base), " ".join(near), " ".join(base), " ".join(far), prose(30, 3) + " " + shared + " " + prose(30, 4),
        prose(80, 5) + "\n" + shared, "a" * 50_000, "mail a@b.co now +1 (437) 555-0689 card 4111 1111 1111 1111 ip 10.0.0.1", "Ünïcode été 🎉 日本語 " * 5, prose(5000, 6), "x y z " * 300,
    ]
    return [(i, t, ("en", "fr", None)[i % 3], ("a", "b", None)[i % 3], len(t or "")) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(documents(), SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def shingle_sets():
    out = {}
    for i, t, *_ in documents():
        w = re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        out[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    return out


def test_ngram_join(docs, empty):
    sets = shingle_sets()
    comp = {i: i for i in sets}
    for i in sets:
        for j in sets:
            o = len(sets[i] & sets[j])
            if i < j and o and 100 * o >= 80 * len(sets[i] | sets[j]):
                a, b = comp[i], comp[j]
                comp = {k: min(a, b) if v in (a, b) else v for k, v in comp.items()}
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.join(docs).collect()}
    assert got == {i: (len(sets[i]), comp[i]) for i in sets}
    assert ngram_join.join(empty).count() == 0
    assert ngram_join.keep_one(docs).columns == docs.columns


def test_ngram_join_of_large_families(spark):
    """Chains whose last document is held against the first and links the second as well."""
    words = [[f"g{k}n{i}" for i in range(40)] for k in range(100)]
    texts = [" ".join(w[a : a + 31]) for w in words for a in (0, 6, 3)]
    sets = [{tuple(x[i : i + 5]) for i in range(len(x) - 4)} for x in map(str.split, texts)]
    link = lambda a, b: 100 * len(a & b) >= 80 * len(a | b)
    assert all(link(sets[k + 2], sets[k]) and link(sets[k + 2], sets[k + 1]) and not link(sets[k], sets[k + 1]) for k in range(0, 300, 3))
    got = {r.doc_id: r.component_id for r in ngram_join.join(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert got == {i: i - i % 3 for i in range(300)}


def test_ngram_join_of_a_long_chain(spark):
    """One family in which each document shares blocks with its neighbours only, which is held together block by block, against brute force."""
    r = random.Random(8)
    at, texts = 0, []
    for _ in range(500):
        texts.append(" ".join(f"c{at + i}" for i in range(60)))
        at += r.choice([5, 7, 8, 7])
    r.shuffle(texts)
    sets = [{tuple(x[i : i + 5]) for i in range(len(x) - 4)} for x in map(str.split, texts)]
    forest = components.Forest()
    for i in range(500):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                forest.union(i, j)
    got = {r.doc_id: r.component_id for r in ngram_join.join(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert got == {i: forest.find(i) for i in range(500)}


def test_ngram_bounds_lose_no_link():
    """Random linked pairs share a key, with any set of frequent n-grams left out."""
    r = np.random.default_rng(0)
    for n in (3, 4, 5, 9, 20, 60, 200, 700):
        for _ in range(30):
            x = r.integers(0, 2**63, n, dtype=np.uint64)
            most = int(n / 9)  # replaced elements that leave a similarity of 80 % or so
            y = np.concatenate([x[most:], r.integers(0, 2**63, int(r.integers(0, most + 1)), dtype=np.uint64)])
            o, u = len(np.intersect1d(x, y)), len(np.union1d(x, y))
            if 100 * o < 80 * u:
                continue
            s = ngram_join.Sets.__new__(ngram_join.Sets)
            parts = [np.sort(x), np.sort(y)]
            s.sizes = np.array([len(p) for p in parts])
            s.at, s.all = np.append(0, np.cumsum(s.sizes)), np.concatenate(parts)
            for frequent in (x[:0], np.sort(x[: n // 2]), np.sort(x)):
                keys, owners = ngram_join.signatures(s, frequent)
                assert set(keys[owners == 0].tolist()) & set(keys[owners == 1].tolist())


def test_sketches_lose_no_link():
    """Sketches of several lengths against the sets: they bound the difference, and the product joins what links join."""
    r = np.random.default_rng(4)
    base = r.integers(0, 2**63, 600).astype(np.uint64)
    sets = [np.unique(np.concatenate([base[: 600 - k], r.integers(0, 2**63, e).astype(np.uint64)])) for k in (0, 40, 90, 110) for e in (0, 20, 60, 100)]
    sets += [np.unique(r.integers(0, 2**63, n).astype(np.uint64)) for n in (1, 14, 16, 17, 500)]
    sizes, n = np.array([len(x) for x in sets]), len(sets)
    links = {(i, j) for i in range(n) for j in range(i) if ngram_join.linked(len(np.intersect1d(sets[i], sets[j])), sizes[i], sizes[j])}
    every, one = np.ones(n, dtype=bool), np.arange(n) % 3 == 0
    differ = lambda x, y: int(np.bitwise_count(np.frombuffer(x, np.uint8) ^ np.frombuffer(y, np.uint8)).sum())
    assert all(differ(ngram_join.sketch(sets[i]), ngram_join.sketch(sets[j])) <= len(np.setxor1d(sets[i], sets[j])) for i in range(n) for j in range(i) if len(ngram_join.sketch(sets[i])) == len(ngram_join.sketch(sets[j])))

    def closed(pairs, component):
        forest = components.Forest()
        for i, c in enumerate(component):
            forest.union(n + c, i)
        for i, j in pairs:
            forest.union(i, j)
        return [forest.find(i) for i in range(n)]

    for component in (list(range(n)), [i % 7 for i in range(n)], [0] * n):
        for asks in (every, one):
            got = ngram_join.product(list(range(n)), sets, asks, every, np.array(component))
            assert closed(got, component) == closed([x for x in links if asks[x[0]] or asks[x[1]]], component)
            assert all((max(x), min(x)) in links for x in got) and len(got) < len(set(component))


def test_ngram_join_of_a_large_block(spark):
    """5,000 documents of one block, most of them linked with nothing, against brute force, in one task and in tiles."""
    r = np.random.default_rng(5)
    base = [f"b{i}" for i in range(60)]
    texts = []
    for i in range(5000):
        own = [*base]
        for at in r.choice(60, 1 if i % 10 == 0 else 5, replace=False).tolist():
            own[at] = f"e{r.integers(0, 1 << 40)}"
        texts.append(" ".join(own))
    sets = ngram_join.Sets(texts)
    column = np.unique(sets.all, return_inverse=True)[1]
    forest, sizes = components.Forest(), sets.sizes
    by = np.argsort(column, kind="stable")
    owner, start = np.repeat(np.arange(5000), sizes)[by], np.append(0, np.cumsum(np.bincount(column)))
    for i in range(5000):
        overlap = np.bincount(np.concatenate([owner[start[c] : start[c + 1]] for c in column[sets.at[i] : sets.at[i + 1]]]), minlength=5000)
        for j in np.flatnonzero(ngram_join.linked(overlap, sizes[i], sizes)).tolist():
            forest.union(i, j)
    before = ngram_join.ASK_BYTES, ngram_join.WIDE_BYTES
    try:
        ngram_join.ASK_BYTES, ngram_join.WIDE_BYTES = 1 << 18, 1 << 20
        got = {r.doc_id: r.component_id for r in ngram_join.join(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    finally:
        ngram_join.ASK_BYTES, ngram_join.WIDE_BYTES = before
    assert got == {i: forest.find(i) for i in range(5000)}


def test_components(spark):
    edges = [(5, 4), (4, 3), (3, 9), (20, 21), (21, 22), (7, 7)] + [(100, i) for i in range(101, 140)]
    for few in (components.FEW, 0):  # in one task, and by rounds
        components.FEW = few
        got = dict(map(tuple, components.components(spark.createDataFrame(edges, "a long, b long")).collect()))
        assert got == {4: 3, 5: 3, 9: 3, 21: 20, 22: 20, **{i: 100 for i in range(101, 140)}}
    components.FEW = 200_000


def test_pii(docs, empty, spark):
    def luhn(d):
        return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0

    extra = spark.createDataFrame([(100, "a@b.c_d@e.f x@y"), (101, "1.2.3.4.5.6.7.8 256.1.1.1 01.2.3.4"), (102, " IBAN DE89 3704 0044 0532 0130 00 4111-1111-1111-1112"), (103, "1 " * 20_000)], "doc_id long, text string")
    for r in pii.find(docs.select("doc_id", "text").unionByName(extra)).collect():
        want = []
        for kind, _, pattern, *_ in pii.KINDS[:4]:
            for m in re.finditer(pattern, r.text or ""):
                d = re.sub("[^0-9]", "", m[0])
                if {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")), "card": 16 <= len(d) <= 19 and luhn(d), "phone": 8 <= len(d) <= 15}[kind]:
                    want.append((kind, m.start(), m.end()))
        assert [(s.kind, s.start, s.end) for s in r.pii_spans if s.kind in pii.BASE_KINDS] == want
    clean = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    assert clean[13] == "mail <EMAIL> now <PHONE> card <CARD> ip <IP>" and clean[0] is None and clean[12] == "a" * 50_000
    assert pii.redact(empty).count() == 0


def test_mixing(docs, empty):
    rows = mixing.decide(docs).collect()
    sizes = Counter()
    for _, t, _, s, _ in documents():
        sizes[s] += len(re.findall(WORD, t or ""))
    order = sorted((s for s in sizes if s), key=str) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    full, total = set(), sum(sizes.values())
    while True:
        level = (total - sum(3 * sizes[s] for s in full)) / sum(weight[s] for s in order if s not in full)
        more = {s for s in order if s not in full and level * weight[s] >= 3 * sizes[s]}
        if not more:
            break
        full |= more
    for r in rows:
        want = 3 * sizes[r.source] if r.source in full else level * weight[r.source]
        assert r.mix_target == pytest.approx(want) and r.mix_size == len(re.findall(WORD, r.text or "")) and 0 <= r.mix_copies <= 3
    assert sorted((r.doc_id, r.mix_copies) for r in rows) == sorted((r.doc_id, r.mix_copies) for r in mixing.decide(docs.repartition(3)).collect())
    assert mixing.apply(docs).columns == docs.columns and mixing.apply(empty).count() == 0


def test_texts_full_of_numbers_cost_linear_time(spark):
    began = time.perf_counter()
    for unit, kind, n in (("12 a,", "card", 0), ("+1 437 555 0689, ", "phone", 58_823)):
        d = spark.createDataFrame([(1, unit * (1_000_000 // len(unit)))], "doc_id long, text string")
        assert pii.find(d).select(F.size(F.filter("pii_spans", lambda s: s["kind"] == kind)).alias("n")).first().n == n
        assert pii.redact(d).first().text.count("<") == n
    assert time.perf_counter() - began < 60


def test_names_that_clash(spark):
    schema = "doc_id long, text string, source string, mix_size int, MIX_source int, spans string, pii_spans string, pred string, `a.b` int"
    d = spark.createDataFrame([(1, "mail a@b.co", "s", 5, 6, "x", "y", "z", 7), (2, "ok ok", None, 5, 6, "x", "y", "z", 7)], schema)
    rest = lambda r: tuple(r)[3:]
    assert pii.redact(d).columns == d.columns and {r.text: rest(r) for r in pii.redact(d).collect()} == {"mail <EMAIL>": (5, 6, "x", "y", "z", 7), "ok ok": (5, 6, "x", "y", "z", 7)}
    out = mixing.apply(d)
    assert out.columns == d.columns and {rest(r) for r in out.collect()} == {(5, 6, "x", "y", "z", 7)}
    assert mixing.apply(d.limit(0)).count() == 0 and pii.redact(d.limit(0)).count() == 0


def test_bpe(docs, empty, spark):
    import public_tokenizers as P
    import tiktoken

    path = P.path("byte_bpe_multi_50k.tiktoken")
    ref = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.codec(path, P.PATTERN).ranks, special_tokens={})
    more = ["it's  two\n\n x", "\x1c\x85  é", "ab" * 3000, "日本語" * 400, " lead", "trail ", "<|endoftext|>"]
    rows = [(i, t) for i, t, *_ in documents()] + [(100 + i, t) for i, t in enumerate(more)]
    for r in bpe.digest(spark.createDataFrame(rows, "doc_id long, text string"), path, P.PATTERN, with_ids=True).collect():
        text = dict(rows)[r.doc_id] or ""
        ids = ref.encode_ordinary(text)
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest() and r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert bpe.digest(empty, path, P.PATTERN).count() == 0


def test_langid(docs, empty, spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    profiles = langid.learn(d.where(~langid.held_out()))
    got = langid.predict(d.where(langid.held_out()), profiles)
    assert got.where("lang_pred = lang").count() >= 0.97 * got.count()
    odd = {r.doc_id: r for r in langid.predict(docs, profiles).collect()}
    assert odd[0].lang_pred == odd[1].lang_pred == "und" and odd[0].lang_score == 0 and all(0 <= r.lang_score <= 1 for r in odd.values())
    assert langid.learn(empty) == {} and langid.predict(docs, {}).where("lang_pred <> 'und'").count() == 0


def test_quality_rules(docs, empty):
    for r in quality_rules.judge(docs).collect():
        t = documents()[r.doc_id][1] or ""
        w = re.findall(WORD, t)
        lines = [x for x in t.split("\n") if re.search(WORD, x)]
        windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        c = Counter(windows)
        inside = {k for i, x in enumerate(windows) if c[x] > 1 for k in (i, i + 1, i + 2)}
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(inside))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (len(w) < 50 or 100 * len(inside) > 50 * len(w)) and not (r.base_failed and r.kept)
    assert quality_rules.judge(empty).count() == 0
    p = quality_rules.posteriors({"+" * 10: 900, "+--" + "+" * 7: 40, "-" + "+" * 5 + "--++": 30, "0" + "+" * 9: 30, "+++---++++": 20})
    assert p["+" * 10] > 0.9 > 0.5 > max(p["+--" + "+" * 7], p["+++---++++"])


def test_quality_model(spark, docs, empty):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", "quality")
    b = quality_model.featurize(d).checkpoint()
    w = quality_model.train(b.where(~quality_model.held_out()), labels.where(~quality_model.held_out()))
    got = quality_model.score(b, w).where(quality_model.held_out()).join(labels, "doc_id").withColumn("hit", (F.col("score") >= 0.3).cast("int") == F.col("quality"))
    assert got.where("hit").count() >= 0.9 * got.count()
    assert quality_model.score(quality_model.featurize(docs), w).where("score between 0 and 1").count() == len(documents())
    none = quality_model.train(quality_model.featurize(empty), labels.limit(0))
    assert {r.score for r in quality_model.score(quality_model.featurize(docs), none).collect()} == {0.5}


def test_class_prior_is_found_from_positives_and_unlabelled_texts():
    """Three kinds of documents, of which two are good: whatever share of the good ones is trusted, the estimate is near the truth."""
    r = np.random.default_rng(4)
    for truth, trusted in ((0.8, 0.5), (0.5, 0.2), (0.2, 0.9)):
        good = r.random(20_000) < truth
        kind = np.where(good, r.integers(0, 2, 20_000), np.where(r.random(20_000) < 0.95, 2, 1))  # some bad ones look good
        x = np.zeros((20_000, quality_model.DIM))
        x[np.arange(20_000), kind] = 1
        x[:, -1] = 1
        p = good & (r.random(20_000) < trusted)
        got = quality_model.class_prior(x.T @ x, x[p].sum(axis=0), 20_000, int(p.sum()))
        assert abs(got - truth) < 0.05
    none = np.zeros((quality_model.DIM, quality_model.DIM))
    assert quality_model.class_prior(none, none[0], 0, 0) == 0.5


def test_unbiased_risk_has_no_lower_point_nearby():
    """minimise() against the risk itself, computed text by text."""
    r = np.random.default_rng(6)
    n, good = 3000, r.random(3000) < 0.6
    x = np.zeros((n, quality_model.DIM))
    x[np.arange(n), np.where(good, r.integers(0, 4, n), r.integers(2, 6, n))] = 1
    x[:, -1] = 1
    p, prior = good & (r.random(n) < 0.5), 0.6

    def risk(w):
        f, plus, minus = x @ w, lambda f: (f - 1) ** 2 / 4, lambda f: (f + 1) ** 2 / 4
        return prior * plus(f[p]).mean() + max(0.0, minus(f).mean() - prior * minus(f[p]).mean()) + quality_model.RIDGE * (w @ w) / 4

    w = quality_model.minimise(x.T @ x, x[p].sum(axis=0), n, int(p.sum()), x[p].T @ x[p] / p.sum(), prior)
    assert all(risk(w) <= risk(w + 0.02 * r.normal(size=quality_model.DIM) * (np.arange(quality_model.DIM) < 6)) + 1e-6 for _ in range(300))


def test_html(spark):
    page = """<html><head><title>t</title><style>p{}</style></head><body><nav><a href=/>Home</a></nav><div class="cookie-notice">We use cookies</div>
    <article><h1>Title &amp; more</h1><p>A   para<br>of text<p>Second &eacute;t&eacute;<script>var x="<p>no</p>"</script><section class="comments"><p>Nice post, I really liked it a lot</p></section></article>
    <aside>Related</aside><form><label>Name</label></form><!-- hidden <p>x</p> --><footer>&copy; 2020</footer></body></html>"""
    rows = [(1, "u", page), (2, "u", None), (3, "u", ""), (4, "u", "<p>" + "word " * 50_000), (5, "u", page)]
    got = {r.page_id: r for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[1].text == got[5].text == "Title & more A para of text Second été" and got[1].n_chars == len(got[1].text)
    assert got[2].text == got[3].text == "" and got[4].n_chars == 50_000 * 5 - 1


def test_html_markup_that_misleads():
    p = "<p>" + "word " * 40 + "</p>"
    text = "word " * 39 + "word"
    comment = '<section class="comments"><article class="comment"><p>nice post here</p></article></section>'
    for page, want in (
        (f'<body class="has-sidebar"><article>{p}</article>', text), (f'<article class="post no-comments">{p}</article>', text), (f'<div class="content-with-sidebar"><article>{p}</article></div>', text),
        (f"<article><a name=x><p>one two three four</p>{p}", f"one two three four {text}"), (f"<article><p>a <a>b c d</a></p>{p}</article>", f"a b c d {text}"),
        (f"<article><p>x <math><mi>y</mi></math> z</p>{p}</article>", f"x y z {text}"), (f"<article>{p}{comment}</article>", text), (p + p, f"{text} {text}"), ("", ""),
    ):
        assert html_text.main_text(page) == want

    def features(node):
        return {node[0]} | features(node[2]) | features(node[3]) if isinstance(node, tuple) else set()

    assert {html_text.FEATURES.index(f) for f in ("prev_words", "next_words", "link_density", "words")} <= features(html_text.tree())
    some = [tuple(r) for r in html_text.labelled()]
    assert sum(html_text.decide(html_text.tree(), r[:-1]) == r[-1] for r in some) >= 0.95 * len(some)


def test_html_names_links_and_adverts_in_the_article():
    w = "word " * 39 + "word"
    p = f"<p>{w}</p>"
    for page, want in (
        (f'<article><div class="social-history">{p}</div></article>', w), (f'<article><p class="legal-notice-para">{w}</p></article>', w), (f'<article><h2 class="header">T</h2>{p}</article>', f"T {w}"),
        (f'<article><div class="article-header"><h1>Title</h1></div>{p}</article>', f"Title {w}"), (f"<article><p><a href=x>see the report</a></p>{p}</article>", f"see the report {w}"),
        (f"<article>{p}<ul><li><a href=1>one</a></li><li><a href=2>two</a></li></ul></article>", f"{w} one two"), (f'<article><p>a <span class="ad">buy <b>now</b></span> b</p>{p}</article>', f"a b {w}"),
        (f'<article><p>a <span class="sponsored">buy now</p>{p}</article>', f"a {w}"), (f'<article>{p}<div class="social-links"><p>share it</p></div><div class="comment-list">{p}</div></article>', w), (f"<p>{w}</p>{p}<p>all rights reserved</p>", f"{w} {w}"),
        (f'<article>{p}<p>one</p></article><footer>site of words</footer>', f"{w} one"), ("<p>only this</p>", "only this"),
    ):
        assert html_text.main_text(page) == want, page


def test_html_against_a_parser(spark):
    """The article of each page as html.parser reads it; without its class names and elements, blocks next to links and at the end are told apart by their neighbours."""
    from html.parser import HTMLParser

    class Article(HTMLParser):
        def __init__(self):
            super().__init__()
            self.depth, self.words = 0, []

        def handle_starttag(self, tag, attrs):
            self.depth += tag == "article"
            self.words.append(" ")

        def handle_endtag(self, tag):
            self.depth -= tag == "article"
            self.words.append(" ")

        def handle_data(self, data):
            if self.depth:
                self.words.append(data)

    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r for r in html_text.query(spark, "/root/testdata/sf0.01").collect()}
    for r in rows.collect():
        reader = Article()
        reader.feed(r.html)
        assert got[r.page_id].text.split() == "".join(reader.words).split() and got[r.page_id].n_chars == len(got[r.page_id].text)
    assert html_text.extract(rows.limit(0)).count() == 0


def test_embeddings(spark):
    r = np.random.default_rng(1)
    base = r.normal(size=(40, 8))
    vecs = [*base, *(base[:10] + r.normal(size=(10, 8)) * 0.05), base[0], base[0], *(base[1] + r.normal(size=(60, 8)) * 0.02)]
    rows = [(i, [float(x) for x in v], i % 2 if i < 30 else 0) for i, v in enumerate(vecs)]
    n = len(rows)
    rows += [(n, None, 0), (n + 1, [0.0] * 8, 0), (n + 2, [float("nan")] * 8, 0), (n + 3, [1.0] * 8, None), (n + 4, [None] * 8, 0), (n + 5, [], 0), (n + 6, [1.0, 2.0], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    x = np.array([np.array(v, dtype=np.float32).astype(float) for _, v, _ in rows[:n]])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([lab for *_, lab in rows[:n]])
    link = (x @ x.T >= 0.98) & (label[:, None] == label) & ~np.eye(n, dtype=bool)
    comp = np.arange(n)
    for _ in range(n):
        comp = np.minimum(comp, np.where(link, comp, n).min(axis=1))
    for tile in (4096, 16):
        embedding_join.TILE = tile
        got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_join.join(df).collect()}
        assert [got[i] for i in range(n)] == [(int(link[i].sum()), int(comp[i]), comp[i] == i) for i in range(n)]
        assert all(got[i] == (0, i, True) for i in range(n, n + 7))
    embedding_join.TILE = 4096


def test_substrings(docs, empty):
    got = {r.doc_id: r for r in substring_dedup.find(docs).collect()}
    assert set(got) == {6, 7, 8, 10, 11}
    assert any(s.s <= 32 and s.e >= 88 for s in got[10].spans) and got[10].partner == 11 and got[8].copy_of == 6
    assert substring_dedup.find(empty).count() == 0
    x = np.arange(300, dtype=np.uint64)
    v, c, lo, hi = substring_dedup.compact_windows(x, np.array([0, 150, 300]), np.uint64(5), 20)
    h = ngram_join.mix(x ^ np.uint64(5))
    for value, at, a, b in zip(v, c, lo, hi, strict=True):
        assert h[a : b + 1].min() == value == h[at] and b - a + 1 >= 20 and (a in (0, 150) or h[a - 1] < value) and (b in (149, 299) or h[b + 1] < value)


def test_near_passages_against_brute_force(spark):
    """Passages of 50 to 150 words with up to three words changed or inserted, in pairs and in clusters: all pairs of texts are verified."""
    r = random.Random(3)
    words = lambda n: [f"w{r.randrange(20_000)}" for _ in range(n)]
    texts = []
    for size in (50, 70, 100, 150):
        for copies in (2, 2, 2, 2, 5, 20):
            p = words(size)
            for _ in range(copies):
                q = list(p)
                for at in sorted(r.sample(range(size), r.randrange(4)), reverse=True):
                    q[at : at + r.randrange(2)] = [f"z{r.randrange(10**9)}"]
                texts.append(" ".join(words(r.randrange(0, 150)) + q + words(r.randrange(0, 150))))
    texts += [" ".join(words(200)) for _ in range(40)] + [texts[0], texts[0], None, ""]
    n = len(texts)
    s = [substring_dedup.sequence(t) for t in texts]
    pairs = {(i, j) for i in range(n) for j in range(n) if i != j and len(np.intersect1d(s[i], s[j])) > 30 and substring_dedup.passages(s[i], s[j])}
    want = {i for p in pairs for i in p}
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = [sorted(map(str, substring_dedup.find(rows.repartition(k)).collect())) for k in (1, 7)]
    assert found[0] == found[1]
    got = {x.doc_id for x in substring_dedup.find(rows).select("doc_id").collect()}
    assert got <= want and len(got) >= 0.97 * len(want)


def test_longest_stretch():
    r = np.random.default_rng(1)
    for _ in range(200):
        x = r.integers(-3, 3, r.integers(1, 12))
        s, e = substring_dedup.longest(x)
        sums = [(j - i, i, j) for i in range(len(x)) for j in range(i, len(x) + 1) if x[i:j].sum() >= 0]
        assert e - s == max(sums)[0] and x[s:e].sum() >= 0


def test_pipeline(spark):
    import corpus_pipeline

    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.columns[:4] == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and out.count() > 100


def test_pipeline_stages_alone(spark, docs, empty):
    """Each stage on nulls, empty and long texts, repeated rows and columns of its own names, against brute force; and on an empty table."""
    import corpus_pipeline

    stages = dict(corpus_pipeline.STAGES)
    more = docs.unionByName(docs.where("doc_id in (4, 13)")).withColumns({"pred": F.lit("p"), "score": F.lit(2.5), "spans": F.lit(1), "mix_size": F.lit("m")})
    for name, stage in stages.items():
        none = stage(spark, empty, "")
        assert none.count() == 0 and (name == "token_ids" or none.columns == empty.columns)
        if name != "token_ids":
            assert stage(spark, more, "").columns == more.columns
    texts = {i: t for i, t, *_ in documents()}
    sets = shingle_sets()
    gone = {j for i in sets for j in sets if i < j and sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])}
    assert sorted(r.doc_id for r in stages["near_duplicates"](spark, more, "").collect()) == sorted(i for i in [*texts, 4, 13] if i not in gone)
    clean = stages["personal_data"](spark, more, "").collect()
    assert sorted(r.doc_id for r in clean) == sorted([*texts, 4, 13]) and all(r.text == texts[r.doc_id] and (r.pred, r.score, r.spans, r.mix_size) == ("p", 2.5, 1, "m") for r in clean if r.doc_id != 13)
    assert {(r.text, r.n_chars) for r in clean if r.doc_id == 13} == {(x := "mail <EMAIL> now <PHONE> card <CARD> ip <IP>", len(x))}
    kept = {r.doc_id for r in stages["language_id"](spark, more, "").collect()}
    assert kept <= set(texts) and not kept & {0, 1, 2}
    mixed = Counter(r.doc_id for r in stages["source_mix"](spark, more, "").collect())
    want = {r.doc_id: r.mix_copies for r in mixing.decide(more.drop("mix_size")).collect()}
    assert mixed == {i: n * (2 if i in (4, 13) else 1) for i, n in want.items() if n}
    tokens = stages["token_ids"](spark, more, "").collect()
    assert Counter(r.doc_id for r in tokens) == Counter([*texts, 4, 13])
    assert all(r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest() for r in tokens)
