"""The pipeline as a whole against its five stages in plain Python, on a small table; column names with dots, rows without ids."""

import base64
import random
import re
from collections import Counter

import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerloom.llm import langid, mixing

WORD = r"[^\x20\x09-\x0D]+"
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"


def fixture():
    r = random.Random(12)
    vocab = {k: ["".join(r.choices(letters, k=r.randrange(2, 8))) for _ in range(400)] for k, letters in (("en", "abcdefgh"), ("fr", "éèaijklm"))}
    rows = []
    for i in range(90):
        k = "en" if i % 3 else "fr"
        words = r.choices(vocab[k], k=r.randrange(20, 160))
        if i % 4 == 0:
            words.insert(5, f"me{i}@mail.example.org,")
        rows.append([i, " ".join(words), k, ("a", "b", None)[i % 5 % 3]])
    for i in range(90, 110):  # near copies: a word changed, or only the case of letters
        of = rows[r.randrange(90)]
        words = of[1].split(" ")
        if i % 2:
            words[len(words) // 2] = "zzz"
        rows.append([i, " ".join(words).upper() if i % 5 == 0 else " ".join(words), of[2], "a"])
    rows += [[110, None, "en", "a"], [111, "", "en", "a"], [112, "123 !!", "en", "b"], [113, "ææ øø þþ ðð ææ", None, "b"], [114, rows[3][1], "en", "b"], [None, rows[7][1], "en", "a"], [None, " ".join(vocab["en"][:50]), "en", "a"]]
    return [(i, t, lang, source, len(t or "")) for i, t, lang, source in rows]


def out_of_place(text, profiles, size):
    codes, counts = langid.grams(text)
    own = [g for g, _ in sorted(zip(codes.tolist(), counts.tolist()), key=lambda x: (-x[1], x[0]))[:size]]
    if not own:
        return "und", 0.0
    out = {k: sum(abs(p.index(g) - i) if g in p else size for i, g in enumerate(own)) for k, p in profiles.items()}
    best = min(sorted(out), key=out.get)
    return best, 1 - out[best] / (size * len(own))


def shingles(text):
    w = re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def test_pipeline_equals_its_stages_in_plain_python(spark, tmp_path):
    import public_tokenizers

    rows = fixture()
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    df.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()

    profiles = langid.learn(df)
    kept = []
    for r in rows:
        k, s = out_of_place(r[1], profiles, langid.PROFILE)
        if k != "und" and s >= corpus_pipeline.LEAST_SCORE:
            kept.append(r)
    assert {110, 111, 112}.isdisjoint(r[0] for r in kept) and len(kept) >= 100
    ids = [r[0] for r in kept if r[0] is not None]
    sets, comp = {r[0]: shingles(r[1]) for r in kept if r[0] is not None}, {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a in ids:
            for b in ids:
                if a < b and comp[a] != comp[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    comp[a] = comp[b] = min(comp[a], comp[b])
                    changed = True
    left = [r for r in kept if r[0] is None or comp[r[0]] == r[0]]
    assert len(kept) - len(left) >= 10 and sum(r[0] is None for r in left) == 2
    clean = [(i, t := re.sub(EMAIL, "<EMAIL>", text), lang, source, len(t)) for i, text, lang, source, _ in left]
    assert sum("<EMAIL>" in r[1] for r in clean) >= 10
    table = spark.createDataFrame(clean, df.schema)
    copies = {(r.doc_id, r.text): r.mix_copies for r in mixing.decide(table).collect()}
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = Counter()
    for i, text, *_ in clean:
        want[i, tuple(enc.encode_ordinary(text))] += copies[i, text]
    assert Counter((r.doc_id, tuple(r.ids)) for r in got) == +want


def test_names_with_dots_pass_the_stages(spark):
    d = spark.createDataFrame([(1, "write to a.b@c.org now", 22, "x"), (None, "plain", 5, "y")], "doc_id long, text string, n_chars long, `a.b` string")
    out = dict(corpus_pipeline.STAGES)["personal_data"](spark, d, "")
    assert out.columns == d.columns and {(r.text, r.n_chars, r["a.b"]) for r in out.collect()} == {("write to <EMAIL> now", 20, "x"), ("plain", 5, "y")}
    kept = dict(corpus_pipeline.STAGES)["near_duplicates"](spark, d.unionByName(d.withColumn("doc_id", F.col("doc_id") + 1)), "")
    assert kept.columns == d.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["1", "None", "None"]
