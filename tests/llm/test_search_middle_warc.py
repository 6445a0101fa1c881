"""Ranked search, fill-in-middle and WARC against brute force on small tables: nulls, empty and very long texts, ties, repeated rows, clashing columns, empty tables."""

import gzip
import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from ledgerloom.llm import fill_in_middle, ranked_search, warc

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


# Ranked search


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def ranked(docs, items, k=10):
    """The contract's formula, all pairs, in Python's integers."""
    tf = [Counter(terms(t)) for _, t in docs]
    n = [sum(c.values()) for c in tf]
    n_docs, n_terms = sum(x > 0 for x in n), sum(n)
    df = Counter(t for c in tf for t in c)
    out = []
    for item, text in items:
        want = Counter(terms(text))
        scored = []
        for (doc_id, _), c, length in zip(docs, tf, n, strict=True):
            m = 25 + (75 * length * n_docs) // n_terms if n_terms else 0
            s = sum(r * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m)) for t, r in want.items() if t in c)
            if s > 0:
                scored.append((-s, doc_id is None, doc_id or 0, doc_id))
        out += [(item, i + 1, d, -s) for i, (s, _, _, d) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def corpus(seed, n, words=300):
    r = random.Random(seed)
    return " ".join(f"{r.choice('abcdeé')}{r.randrange(words) if r.random() < 0.5 else r.randrange(12)}" for _ in range(n))


def texts():
    copies = [(i, corpus(1, 40)) for i in range(400, 460)]
    own = [(i, corpus(i, 5 + i % 90)) for i in range(300)]
    odd = [(900, None), (901, ""), (902, " .,\n\t"), (903, "Ünïcode 日本語, ÉTÉ été a1"), (904, corpus(904, 30_000)), (None, corpus(1, 40)), (905, "x\0y A1-b2_c3"), (7, corpus(1, 40)), (7, "a1 a2 a3")]
    return own + copies + odd


@pytest.fixture(scope="module")
def queries():
    return [(0, corpus(1, 12)), (1, "a1 a1 a1 b2"), (2, None), (3, ""), (4, "nothing here matches zzz"), (5, "été 日本語 ÜNÏCODE"), (6, corpus(904, 500)), (7, corpus(5, 20)), (7, corpus(5, 20)), (None, "x y c3"), (8, "a1 " * 2000)]


def test_ranked_search_equals_brute_force(spark, tmp_path, queries, monkeypatch):
    docs = spark.createDataFrame([(i, t, "s", 1.0) for i, t in texts()], "doc_id long, text string, terms string, score double").repartition(5)
    items = spark.createDataFrame([(i, t, 0) for i, t in queries], "item_id long, text string, rank int")
    want = ranked(texts(), queries)
    rows = lambda df: sorted((tuple(r) for r in df.collect()), key=str)
    only = ranked_search.vocabulary(items)
    assert set(only.tolist()) == set(ranked_search._counted([t for _, t in queries], None)[2].tolist())
    index = ranked_search.build(docs, f"file://{tmp_path}/only", only)
    assert rows(ranked_search.search(index, items)) == want
    assert rows(ranked_search.search(index, items, 3)) == [r for r in want if r[1] <= 3]
    monkeypatch.setattr(ranked_search, "BLOCK", 15)  # several blocks of queries
    whole = ranked_search.build(docs, f"file://{tmp_path}/whole", sample=40, chunk=50, cluster=8)
    assert whole.read("clusters").count() > 40
    assert rows(ranked_search.search(whole, items)) == want
    monkeypatch.setattr(ranked_search, "MOST_TERMS", 3)
    assert ranked_search.vocabulary(items) is None


def test_ranked_search_of_empty_tables(spark, tmp_path, queries):
    none = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame(queries, "item_id long, text string")
    assert ranked_search.search(ranked_search.build(none, f"file://{tmp_path}/a"), items).count() == 0
    docs = spark.createDataFrame([(1, "a1 b2"), (2, None)], "doc_id long, text string")
    index = ranked_search.build(docs, f"file://{tmp_path}/b")
    assert ranked_search.search(index, items.limit(0)).count() == 0
    # one document with terms: every weight is floor(1000 * ln(4 / 3))
    assert {tuple(r) for r in ranked_search.search(index, items.where("item_id = 1")).collect()} == {tuple(r) for r in ranked([(1, "a1 b2"), (2, None)], [(1, "a1 a1 a1 b2")])}


def test_graph_bisection_brings_common_terms_together():
    """Documents of eight topics, shuffled: after bisection most neighbours are of one topic, and each stays in the order once."""
    r = np.random.default_rng(3)
    topic = r.permutation(np.repeat(np.arange(8), 64))
    lists = [np.unique(np.append(r.integers(0, 40, 12) + 40 * t, r.integers(320, 360, 4))) for t in topic]
    ends, flat = np.cumsum([len(x) for x in lists]), np.concatenate(lists)
    order = ranked_search.bisect(ends, flat, 3, rounds=20)
    assert sorted(order.tolist()) == list(range(512))
    parts = topic[order].reshape(8, 64)
    assert np.mean([np.bincount(p).max() / 64 for p in parts]) > 0.9
    tree = ranked_search.fit(ends, flat, depth=3)
    leaf = ranked_search.route(tree, ends, flat)
    assert set(leaf.tolist()) <= set(range(8))
    assert np.mean([np.bincount(leaf[topic == t]).max() / 64 for t in range(8)]) > 0.8


def test_clusters_are_left_out_by_their_bounds(spark, tmp_path):
    """The search scores few of the clusters, and none whose bound lies below the result's last score."""
    docs = [(t * 100 + i, " ".join(f"t{t}w{w}" for w in np.random.default_rng(t * 100 + i).integers(0, 30, 20))) for t in range(20) for i in range(100)]
    index = ranked_search.build(spark.createDataFrame(docs, "doc_id long, text string"), f"file://{tmp_path}/i", cluster=16)
    batch = index.read("clusters").toArrow().combine_chunks().to_batches()[0]
    _, ends, distinct, _ = ranked_search._counted(["t3w1 t3w2 t3w3"], None)
    block = ranked_search.Block(distinct, np.arange(1, 4), np.zeros(3, dtype=np.int64), np.full(3, 1000), 1)
    found = ranked_search.Clusters(batch, block)
    assert 0 < (found.bounds > 0).sum() < batch.num_rows / 3
    found.postings()
    for c in range(batch.num_rows):
        ids, scores = found.scores(c, np.array([0]))
        assert scores.max(initial=0) <= found.bounds[c, 0]
    assert sum(len(found.scores(c, np.array([0]))[0]) for c in range(batch.num_rows)) == 2000


# Fill-in-middle


def cut(doc_id, text):
    text = text or ""
    n, h = len(text), hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = text[:a], text[a:b], text[b:]
    return (n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < 20 else (n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}")


def middles():
    own = [(i, "é🎉<P<" * (i % 70) + "<") for i in range(20, 400)]
    return own + [(0, None), (1, ""), (2, "a\0b\nc\r\n" * 50), (3, "<S>x"), (4, "é🎉日本" * 300), (5, "x" * 2_000_000), (6, "<P<S"), (7, "a"), (7, "a"), (None, "hello"), (8, "y" * 64), (9, "z" * 65), (10, "<M"), (11, "a<M>b")]


def test_fill_in_middle_equals_brute_force_and_comes_back(spark):
    rows = middles()
    docs = spark.createDataFrame([(*r, "q", 1) for r in rows], "doc_id long, text string, output string, n int").repartition(3)
    with pytest.raises(ValueError):
        fill_in_middle.transform(docs, keep=("doc_id", "N"))
    made = fill_in_middle.transform(docs, keep=("doc_id", "text"))
    key = lambda r: (str(r[0]), str(r[1]))
    assert sorted((tuple(r) for r in made.collect()), key=key) == sorted(((i, t, *cut(i, t)) for i, t in rows), key=key)
    back = fill_in_middle.restore(made, keep=("text",)).collect()
    assert len(back) == len(rows) and all(r.restored == (r.text or "") for r in back)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = {(i, *(x := cut(i, t))[:4], sha(x[4]), sha(t or "")) for i, t in rows}
    got = [tuple(r) for r in fill_in_middle.digest(docs).collect()]
    assert set(got) == want and len(got) == len(rows)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}
    assert fill_in_middle.digest(docs.limit(0)).count() == fill_in_middle.transform(docs.limit(0)).count() == 0


# WARC


def pages():
    shared, big = "é" * 60, "".join(random.Random(1).choices("abc ", k=3_000_000))
    return [
        (1, "u\nx é%20", None), (2, None, "x" * 99), (3, "v", "x" * 99), (5, "a", shared), (4, "b", shared), (4, "b2", shared), (None, "n", shared), (None, "m", "z" * 200), (None, "m", "z" * 200),
        (9, "w", "WARC/1.1\r\n\r\n" * 30), (10, "w", "WARC/1.1\r\n\r\n" * 30), (11, "big", big), (12, "s", "y" * 100), (13, "s", "y" * 100), (14, "", ""), (-3, "neg", shared + "-"),
    ]


def expected():
    """payload_bytes, payload_digest, record_type, refers_to of each page; rows that repeat the smallest page_id are responses."""
    rows, first = pages(), {}
    for i, _, h in rows:
        b = (h or "").encode()
        if len(b) >= 100 and i is not None:
            first[b] = min(first.get(b, i), i)
    out = []
    for i, _, h in rows:
        b = (h or "").encode()
        of = first.get(b) if len(b) >= 100 else None
        revisit = of is not None and of != i
        out.append((i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if revisit else "response", of if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("broadcast", [100_000, 0])
def test_warc_round_trip(spark, tmp_path, monkeypatch, broadcast):
    monkeypatch.setattr(warc, "BROADCAST_DIGESTS", broadcast)
    monkeypatch.setattr(warc, "ROWS_A_PART", 1)
    df = spark.createDataFrame([(*r, "q", 1) for r in pages()], "page_id long, url string, html string, offset string, first int").repartition(3)
    folder = f"file://{tmp_path}/w"
    index = warc.write(df, folder, archive=2000)
    wanted = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted((tuple(r) for r in index.select(*wanted).collect()), key=str) == expected()
    got = warc.read(index, folder, span=500, most=100_000)
    assert sorted((tuple(r) for r in got.select(*wanted).collect()), key=str) == expected()
    urls = sorted((str(i), str(u)) for i, u, _ in pages())
    assert sorted((str(r.page_id), str(r.url)) for r in got.select("page_id", "url").collect()) == urls
    assert {r.page_id: bytes(r.payload) for r in got.where("record_type = 'response' AND page_id IN (4, 9, 11, 12)").collect()} == {i: (h or "").encode() for i, _, h in pages() if i in (4, 9, 11, 12)}
    whole = warc.payloads(index, index, folder).collect()
    assert sorted((str(r.page_id), str(r.url), bytes(r.payload).decode()) for r in whole) == sorted((str(i), str(u), h or "") for i, u, h in pages())
    some = index.where("page_id IN (10, 13)")
    assert {(r.page_id, r.record_type) for r in warc.read(some, folder).collect()} == {(10, "revisit"), (13, "revisit")}
    assert {(r.page_id, bytes(r.payload)) for r in warc.payloads(index, some, folder).collect()} == {(10, b"WARC/1.1\r\n\r\n" * 30), (13, b"y" * 100)}
    # every archive is a file of gzip members that begin where the index says
    for name in {r.archive for r in index.select("archive").collect()}:
        raw = (tmp_path / "w" / name).read_bytes()
        rows = sorted((r.offset, r.length) for r in index.where(index.archive == name).collect())
        assert rows[0][0] == 0 and sum(n for _, n in rows) == len(raw) and all(a + n == b for (a, n), (b, _) in zip(rows, rows[1:]))
        assert gzip.decompress(raw).count(b"WARC-Record-ID: <urn:page:") == len(rows)


def test_warc_of_no_pages(spark, tmp_path):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    index = warc.write(none, f"file://{tmp_path}/w")
    assert index.count() == warc.read(index, f"file://{tmp_path}/w").count() == 0


def test_warc_record_that_is_not_what_the_index_says(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "abc" * 50), (2, "v", "def" * 50)], "page_id long, url string, html string").coalesce(1)
    folder = f"file://{tmp_path}/w"
    index = warc.write(df, folder)
    wrong = index.selectExpr("3 - page_id AS page_id", "url", "archive", "offset", "length", "payload_bytes", "payload_digest", "record_type", "refers_to")
    with pytest.raises(Exception, match="isn't what the index says"):
        warc.read(wrong, folder).collect()


def test_warc_reads_are_coalesced():
    near, far = warc.GAP, warc.GAP + 1
    rows = [("a", 0, 10), ("a", 10, 10), ("a", 20 + near, 10), ("a", 30 + near + far, 10), ("b", 0, warc.READ), ("b", warc.READ, 1)]
    assert list(warc.ranges(rows)) == [(0, 3), (3, 4), (4, 5), (5, 6)]
    assert list(warc.ranges([])) == []


def test_warc_header_and_record():
    raw = warc.record(5, "http://a/b c", b"x\r\n\r\ny", "0" * 64, None, "2024-01-01T00:00:00Z")
    fields, block, length, payload = warc.parse(raw)
    assert payload == b"x\r\n\r\ny" and length == 6 and fields["warc-target-uri"] == "http://a/b%20c" and len(block) == int(fields["content-length"])
    revisit = warc.parse(warc.record(6, None, b"x" * 100, "0" * 64, 5, "2024-01-01T00:00:00Z"))
    assert revisit[0]["warc-type"] == "revisit" and revisit[2:] == (100, b"") and "warc-target-uri" not in revisit[0]
    with pytest.raises(ValueError):
        warc.parse(raw[:-2])
    assert pa.schema(warc.INDEX_SCHEMA).names[:5] == ["page_id", "url", "archive", "offset", "length"]
