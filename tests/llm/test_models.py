"""The models' arithmetic against plain loops: language profiles and distances, expectation-maximisation of the rules' votes."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import langid, quality_rules


def counted(text):
    codes, counts = langid.grams(text)
    return Counter(dict(zip(codes.tolist(), counts.tolist())))


def test_language_profiles_and_distances(spark):
    r = random.Random(8)
    vocab = {k: ["".join(r.choices(letters, k=r.randrange(1, 7))) for _ in range(60)] for k, letters in (("aa", "abcdef"), ("bb", "defghi"), ("cc", "éèxyzw"))}
    prose = lambda k, n: " ".join(r.choices(vocab[k], k=n))
    rows = [(i, prose(k, r.randrange(1, 80)), k) for i, k in enumerate("aabbcc"[2 * (j % 3)] * 2 for j in range(60))]
    rows += [(100, None, "aa"), (101, "", "bb"), (102, "123 !?", "cc"), (103, prose("aa", 5000), "aa"), (104, rows[0][1], rows[0][2]), (104, rows[0][1], rows[0][2]), (105, prose("bb", 9), None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    size = 50
    profiles = langid.learn(df, size=size)
    want = {}
    for k in vocab:
        total = sum((counted(t) for _, t, lang in rows if lang == k), Counter())
        want[k] = [g for g, _ in sorted(total.items(), key=lambda x: (-x[1], x[0]))[:size]]
    assert profiles == want

    def predicted(text):
        own = [g for g, _ in sorted(counted(text).items(), key=lambda x: (-x[1], x[0]))[:size]]
        if not own:
            return "und", 0.0
        out = {k: sum(abs(p.index(g) - i) if g in p else size for i, g in enumerate(own)) for k, p in want.items()}
        best = min(sorted(out), key=out.get)
        return best, 1 - out[best] / (size * len(own))

    got = langid.predict(df.withColumn("LANG_PRED2", F.lit(1)), profiles, size=size).collect()
    assert len(got) == len(rows)
    for x in got:
        k, s = predicted(x.text)
        assert x.lang_pred == k and x.lang_score == pytest.approx(s, abs=1e-12)
    assert sum(x.lang_pred == x.lang for x in got if x.lang and x.text and len(x.text) > 30) >= 0.95 * sum(bool(x.lang and x.text and len(x.text) > 30) for x in got)
    # equal distances go to the first language by name, whatever the order of the profiles
    assert langid.Model({"zz": want["aa"], "mm": want["aa"]}, size).predict(rows[0][1])[0] == "mm"
    assert langid.Model({}, size).predict("abc") == ("und", 0.0)


def test_votes_are_weighed_as_document_by_document():
    r = random.Random(9)
    rules = len(quality_rules.RULES)
    docs = ["".join(r.choices("+-0", (8, 1, 1) if r.random() < 0.7 else (3, 4, 3))[0] for _ in range(rules)) for _ in range(400)]
    got = quality_rules.posteriors(Counter(docs), rounds=15)
    good = [0.1 if "-" in d else 0.95 for d in docs]
    for _ in range(15):
        share = min(0.98, max(0.02, sum(good) / len(good)))
        rates = []
        for w, prior in ((good, (8.0, 0.02, 2.0)), ([1 - g for g in good], (1.0, 1.0, 1.0))):
            table = []
            for rule in range(rules):
                c = [p + sum(g for g, d in zip(w, docs) if d[rule] == k) for k, p in zip("+-0", prior)]
                table.append({k: x / sum(c) for k, x in zip("+-0", c)})
            rates.append(table)
        for i, d in enumerate(docs):
            a, b = (math.prod(t[rule][d[rule]] for rule in range(rules)) for t in rates)
            good[i] = share * a / (share * a + (1 - share) * b)
    for d, g in zip(docs, good):
        assert got[d] == pytest.approx(g, abs=1e-6)
    assert quality_rules.posteriors({}) == {}
