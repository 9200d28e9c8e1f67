"""The pipeline against a brute-force version of every stage after the classifier."""
import hashlib
import math
import re
import struct
from collections import Counter, defaultdict

import corpus_pipeline
import duckdb
import pytest
from pyspark.sql import functions as F
from test_edges import similar
from test_queries import base_spans, simhash, token_spans

from tabprep.llm import pii_info, toxicity
from tabprep.llm.common import table

SF = "/root/testdata/sf0.001"


def near_duplicate_survivors(docs):
    fps = {d: simhash(t) for d, t in docs.items()}
    left, kept = set(docs), []
    while left:
        first = min(left)
        group, todo = {first}, [first]
        while todo:
            a = todo.pop()
            new = {b for b in left - group if (fps[a] ^ fps[b]).bit_count() <= 4}
            group |= new
            todo += new
        kept.append(first)
        left -= group
    return kept


def holds_item(text, items):
    words = "".join(" " if c in pii_info._BREAK + "-_~^" else c for c in text).split()
    words = [re.sub("[A-Z]", lambda m: m.group().lower(), w) for w in words]
    marks = {tuple(words[k:k + 5]) for k in range(len(words) - 4)}
    for item in items:
        if not any(tuple(item[k:k + 5]) in marks for k in range(len(item) - 4)):
            continue
        for k in range(max(1, len(words) - len(item) + 1)):
            if similar(words[k:k + len(item)], item) >= 0.8:
                return True
    return False


def cut(text):
    """(start, term) of every term."""
    plain = "".join(" " if c in pii_info._BREAK else c.lower() if c.isascii() else c for c in text)
    return [(m.start(), m.group()) for m in re.finditer("[^ ]+", plain) if len(m.group()) >= pii_info.LEAST_CHARS]


def sanitised(docs):
    spans, entities = {}, {}
    for d, t in docs.items():
        spans[d] = base_spans(t)
        entities[d] = {kind + ":" + (re.sub("[^0-9]", "", v) if kind in ("card", "phone") else v.lower()) for *_, kind, v in spans[d]}
    n, df_t, df_e, df_te = len(docs), Counter(), Counter(), Counter()
    for d, t in docs.items():
        own = {w for _, w in cut(t)}
        df_t.update(own)
        df_e.update(entities[d])
        df_te.update((e, w) for e in entities[d] for w in own)
    share = defaultdict(dict)
    for (e, w), c in df_te.items():
        if c >= 3 and df_e[e] >= 3 and n > df_e[e]:
            s = 1 + math.log2(c / df_t[w]) / math.log2(n / df_e[e])
            if s >= 0.9:
                share[e][w] = s
    out = {}
    for d, t in docs.items():
        marks = [(a, k, b, f"[{kind.upper()}]") for a, k, b, kind, _ in spans[d]]
        base = [(a, b) for a, _, b, _, _ in spans[d]]
        for a, w in cut(t):
            best = max((share[e][w] for e in entities[d] if w in share[e]), default=None)
            if best is not None and not any(x < a + len(w) and y > a for x, y in base):
                marks.append((a, 4, a + len(w), "" if best >= 0.98 else "[TERM]"))
        text, at = "", 0
        for a, _, b, mark in sorted(marks):
            if a >= at:
                text += t[at:a] + mark
            at = max(at, b)
        out[d] = text + t[at:]
    return out


@pytest.mark.parametrize("sf", [SF])
def test_pipeline_matches_brute_force(spark, sf):
    import public_tokenizers as P
    import tiktoken
    from tabprep.llm.bpe import read_ranks
    docs = table(spark, sf, "documents")
    model = toxicity.learn(docs, table(spark, sf, "labels"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    scores = dict(zip(texts, toxicity.Margins(model).probabilities(list(texts.values()))))
    texts = {d: t for d, t in texts.items() if scores[d] < 0.5}
    texts = {d: texts[d] for d in near_duplicate_survivors(texts)}
    items = [t.lower() for (t,) in duckdb.sql(f"select text from '{sf}/benchmark.parquet'").fetchall()]
    items = ["".join(" " if c in pii_info._BREAK + "-_~^" else c for c in t).split() for t in items]
    before = len(texts)
    texts = {d: t for d, t in texts.items() if not holds_item(t, items)}
    assert 0 < len(texts) < before
    texts = sanitised(texts)
    enc = tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=read_ranks(P.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, sf).collect()}
    assert set(got) == set(texts)
    for d, t in texts.items():
        ids = enc.encode_ordinary(t)
        assert got[d].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()
        assert got[d].ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest() and got[d].n_tokens == len(ids)
        assert list(zip(got[d].starts, got[d].ends)) == token_spans(t, enc.decode_tokens_bytes(ids))


def test_stages_keep_odd_rows(spark):
    """Nulls in any column, empty texts, repeated rows and extra columns."""
    names = "_id _hash _key _found _text _terms _score _base _added _salt IDS row key id hash score fp kept starts DECODED n".split()
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in names)
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, "plain words of a clean text", "en", "s", 27),
            (None, "no id here at all", "en", "s", 17), (3, "plain words of a clean text", "en", "s", 27),
            (4, "write to jane.doe@example.org or +49 (30) 1234-5678 soon", "en", "s", 56)]
    docs = spark.createDataFrame([(*r, *[None if r[1] is None else f"own {c}" for c in names]) for r in rows], schema)
    for name, step in corpus_pipeline.STAGES:
        out = step(spark, docs, SF)
        if name != "byte_bpe":
            assert out.columns == docs.columns
            assert {r["_text"] for r in out.collect()} == {None, "own _text"} and {r.IDS for r in out.collect()} == {None, "own IDS"}
        ids = [r.doc_id for r in out.collect()]
        if name == "simhash_near_dedup":
            assert sorted(ids, key=str) == [1, 3, 4, None]  # 1 and 2 are both empty
        else:
            assert sorted(ids, key=str) == [1, 2, 3, 3, 4, None]
        if name == "pii":
            assert [(r.text, r.n_chars) for r in out.collect() if r.doc_id == 4] == [("write to [EMAIL] or [PHONE] soon", 32)]
        assert step(spark, docs.limit(0), SF).count() == 0
