"""Collocations against brute force, with few wanted phrases so that the bound decides."""
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tabprep.llm import phrases as M
from tabprep.llm.common import importable

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


@pytest.fixture(autouse=True)
def _paths(spark):
    importable(spark)


def brute(rows, least, top):
    counts, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", re.sub("[A-Z]", lambda m: m.group().lower(), text or "")):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for m in range(1, 6):
                counts[lang].update(tuple(words[k:k + m]) for k in range(len(words) - m + 1))
    out = []
    for lang, f in counts.items():
        often = {p: c for p, c in f.items() if c >= least}
        found = []
        for p, a in often.items():
            longer = [q for q in often if len(q) > len(p) and often[q] >= a
                      and any(q[k:k + len(p)] == p for k in range(len(q) - len(p) + 1))]
            if len(p) < 2 or longer:
                continue
            score, k = min((1000 * a * n[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, rank + 1, p.decode(), -a, left, right, n[lang], -score)
                for rank, (score, a, p, left, right) in enumerate(sorted(found)[:top])]
    return sorted(out)


def corpus(rng, docs, vocabulary, lang):
    words = [f"{lang}{k}é" if k % 5 else f"{lang.upper()}{k}" for k in range(vocabulary)]
    weights = [1 / (k + 1) for k in range(vocabulary)]
    fixed = [rng.choices(words, weights, k=rng.randrange(2, 7)) for _ in range(20)]
    out = []
    for _ in range(docs):
        text = []
        for _ in range(rng.randrange(12)):
            text += rng.choice(fixed) if rng.random() < 0.5 else rng.choices(words, weights, k=3)
            if rng.random() < 0.3:
                text[-1] += rng.choice([".", ",", "!\n", ";", " ?", ":"])
        out.append((lang, rng.choice([" ", "  ", "\t"]).join(text)))
    return out


@pytest.mark.parametrize("top,share", [(3, 0.01), (10, 0.25), (40, 0.1), (5000, 0.25)])
def test_brute_force(spark, top, share):
    rng = random.Random(top)
    rows = corpus(rng, 200, 60, "en") + corpus(rng, 150, 300, "fr") + corpus(rng, 5, 40, "xx")
    rows += [(None, "a b a b a b a b. A B"), (None, None), ("en", ""), ("", "x y, x y. x y"), ("", "x y")] * 3
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "lang string, text string").select("*", F.lit("no").alias("phrase"), F.lit(0).alias("f"))
    got = M.mine(df.repartition(3), least=4, top=top, first_share=share, chunk_words=700)
    assert got.columns == COLUMNS
    assert sorted(map(tuple, got.collect())) == brute(rows, 4, top)


def test_bit_set_collisions_change_nothing(spark):
    rows = corpus(random.Random(8), 120, 80, "en") + corpus(random.Random(9), 60, 200, "de")
    got = M.mine(spark.createDataFrame(rows, "lang string, text string"), least=3, top=15, bits=64)
    assert sorted(map(tuple, got.collect())) == brute(rows, 3, 15)


def test_empty_and_long(spark):
    schema = "lang string, text string"
    assert M.mine(spark.createDataFrame([], schema)).collect() == []
    assert M.mine(spark.createDataFrame([("en", None), (None, " .,\n")], schema)).collect() == []
    rows = [("en", "x y z " * 40_000)]  # one text, overlapping phrases
    got = M.mine(spark.createDataFrame(rows, schema), top=4)
    assert sorted(map(tuple, got.collect())) == brute(rows, 100, 4) and got.count() == 4


def test_hash_agrees(spark):
    words = ["a", "é b", "日本", "x" * 100, "", "ß\x1c"]
    got = spark.createDataFrame([("l", w) for w in words], "lang string, phrase string").select(M.place(M.BITS))
    assert [r[0] for r in got.collect()] == [M.place_of(b"l", w.encode(), M.BITS) for w in words]


def test_exact_beyond_64_bits(spark):
    big = 3 * 10 ** 12
    counts = spark.createDataFrame([("l", "a b", big), ("l", "a", big + 1), ("l", "b", big + 7)], "lang string, phrase string, f long")
    limits = spark.createDataFrame([("l", 10 ** 15, 2 ** 62)], "lang string, n long, upto long")
    (row,) = M.survivors(counts, limits).collect()
    assert row.score == 1000 * big * 10 ** 15 // ((big + 1) * (big + 7))
