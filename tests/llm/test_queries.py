"""Registered queries against DuckDB or a brute-force version."""
import base64
import hashlib
import re
import struct
import zlib
from collections import defaultdict

import duckdb
import pytest

from tabprep.llm import queries as Q

SF = "/root/testdata/sf0.01"
TABLES = ("documents", "embeddings", "pages", "benchmark", "labels")


def rows_of(name, spark, sf=SF):
    return [r.asDict() for r in Q.QUERIES[name](spark, sf).collect()]


def read(name, sf=SF):
    return duckdb.sql(f"select * from '{sf}/{name}.parquet'").fetchall()


@pytest.mark.parametrize("name", sorted(Q.ORACLE))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = con.execute(Q.ORACLE[name])
    columns = [c[0] for c in want.description]
    want = sorted((dict(zip(columns, r)) for r in want.fetchall()), key=str)
    want = sorted([tuple(sorted(r.items())) for r in want], key=str)
    got = sorted([tuple(sorted(r.items())) for r in rows_of(name, spark)], key=str)
    assert got == want and got


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = int(d) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    rules = [("email", EMAIL, lambda s: True),
             ("ip", IP, lambda s: all(int(p) <= 255 for p in s.split("."))),
             ("card", CARD, lambda s: 14 <= len(digits(s)) <= 19 and luhn(digits(s))),
             ("phone", PHONE, lambda s: 10 <= len(digits(s)) <= 15)]
    out = [(m.start(), k, m.end(), kind, m.group()) for k, (kind, p, ok) in enumerate(rules)
           for m in p.finditer(text) if ok(m.group())]
    return sorted(out)


def test_op2_base(spark):
    texts = {r[0]: r[1] or "" for r in read("documents")}
    found = rows_of("op2_pii_information", spark)
    assert sorted(r["doc_id"] for r in found) == sorted(texts)
    for r in found:
        spans = base_spans(texts[r["doc_id"]])
        text = ",".join(f"{kind}:{a}:{b}" for a, _, b, kind, _ in spans)
        assert r["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        for kind in ("email", "ip", "card", "phone"):
            assert r[f"n_{kind}"] == sum(s[3] == kind for s in spans)
        assert set(filter(None, text.split(","))) <= set(r["spans"].split(","))
    assert sum(r["n_email"] for r in found) > 0


def token_spans(text, pieces):
    """Start and end code point of each token from the bytes it stands for."""
    owner = [k for k, c in enumerate(text) for _ in c.encode()]
    at, spans = 0, []
    for piece in pieces:
        spans.append((owner[at], owner[at + len(piece) - 1] + 1))
        at += len(piece)
    return spans


def test_op5(spark):
    import public_tokenizers as P
    import tiktoken
    from tabprep.llm.bpe import read_ranks
    ranks = read_ranks(P.path("byte_bpe_multi_50k.tiktoken"))
    enc = tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {r[0]: r[1] or "" for r in read("documents")}
    found = rows_of("op5_byte_bpe", spark)
    assert len(found) == len(texts)
    for r in found:
        ids = enc.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()
        flat = [x for span in token_spans(texts[r["doc_id"]], enc.decode_tokens_bytes(ids)) for x in span]
        assert r["offsets_sha256"] == hashlib.sha256(struct.pack(f"<{len(flat)}I", *flat)).hexdigest()


def test_op6(spark):
    pages = read("pages")
    by = defaultdict(list)
    for page_id, _, html in pages:
        by[html or ""].append(page_id)
    found = {r["page_id"]: r for r in rows_of("op6_warc_content_addressed", spark)}
    assert len(found) == len(pages)
    for page_id, _, html in pages:
        r, raw = found[page_id], (html or "").encode()
        first = max(by[html or ""])
        assert r["payload_bytes"] == len(raw)
        assert r["payload_digest"] == base64.b32encode(hashlib.sha1(raw).digest()).decode()
        assert (r["record_type"], r["refers_to"]) == (("response", None) if page_id == first else ("revisit", first))


def simhash(text):
    import xxhash
    words = text.encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_op8(spark):
    texts = {r[0]: r[1] or "" for r in read("documents")}
    fps = {d: simhash(t) for d, t in texts.items()}
    ids = sorted(fps)
    parent = {d: d for d in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            if (fps[a] ^ fps[b]).bit_count() <= 4:
                ra, rb = sorted((root(a), root(b)))
                parent[rb] = ra
    found = rows_of("op8_simhash_trie", spark)
    assert len(found) == len(ids)
    for r in found:
        assert r["fingerprint"] == f"{fps[r['doc_id']]:016x}"
        assert r["component_id"] == root(r["doc_id"])


def test_op10(spark):
    found = {r["doc_id"]: r for r in rows_of("op10_toxicity_subword", spark)}
    docs = read("documents")
    assert len(found) == len(docs)
    for d, *_ in docs:
        r = found[d]
        assert r["held_out"] == (zlib.crc32(str(d).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    toxic = {d: t for d, _, t in read("labels")}
    train = [(found[d]["score"], t) for d, t in toxic.items() if d in found and not found[d]["held_out"]]
    wrong = sum((s >= 0.5) != bool(t) for s, t in train)
    assert wrong <= 0.02 * len(train)
