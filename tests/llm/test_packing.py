"""Packing against the tokenizers library, an exact round trip and brute force."""
import random
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tabprep.llm import packing as K
from tabprep.llm import queries as Q
from tabprep.llm.common import importable

SF = "/root/testdata/sf0.01"
PATH = P.path("byte_bpe_50k.json")


@pytest.fixture(autouse=True)
def _paths(spark):
    importable(spark)


@pytest.fixture(scope="module")
def library():
    own = Tokenizer.from_file(PATH)
    own.encode_special_tokens = True
    return lambda texts: [x.ids for x in own.encode_batch(texts, add_special_tokens=False)]


def in_place(rows, cap=2048):
    """Sequences without gaps or overlaps, none over the cap; their number."""
    held = defaultdict(list)
    for r in rows:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for spans in held.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at and length > 0
            at += length
        assert at <= cap
    return len(held)


def test_query(spark, library):
    docs = duckdb.sql(f"select doc_id, coalesce(text, '') from '{SF}/documents.parquet'").fetchall()
    ids = {d: x + [0] for (d, _), x in zip(docs, library([t for _, t in docs]))}
    found = Q.QUERIES["op13_swap_packing"](spark, SF)
    assert dict(found.dtypes) == {"doc_id": "bigint", "piece": "int", "start": "bigint", "length": "bigint",
                                  "ids_crc32": "bigint", "sequence_id": "bigint", "offset": "bigint"}
    rows = [r.asDict() for r in found.collect()]
    by = defaultdict(list)
    for r in rows:
        by[r["doc_id"]].append(r)
    assert by.keys() == ids.keys()
    for d, own in by.items():
        own.sort(key=lambda r: r["piece"])
        assert [r["piece"] for r in own] == list(range(len(own))) and sum(r["length"] for r in own) == len(ids[d])
        assert len(own) == -(-len(ids[d]) // 2048) and all(r["length"] == 2048 for r in own[1:])
        at = 0
        for r in own:
            assert r["start"] == at
            cut = np.array(ids[d][at:at + r["length"]], dtype="<u4").tobytes()
            assert r["ids_crc32"] == zlib.crc32(cut)
            at += r["length"]
    least = -(-sum(map(len, ids.values())) // 2048)
    assert least <= in_place(rows) <= least * 1.01 + 1


ODD = ["", " ", "  ", "a", " a", "a ", "a  b", "a \n b", "x\n y", "x \ny", "\n\nx", "don't I'll  'tis", "é è\xa0ü \xa0x", "a  b",
       "x\x1cy \x1cz", "<|endoftext|> <|endoftext|>", "日本語 テキスト　全角", "🙂 🙂🙂 a🙂", "tab\there \t x", "1 22 333 a1b2", "...!? ,x", "\r\n \r\n a"]


def test_ids_as_the_library(library):
    rng = random.Random(5)
    chars = ["a", "B", "é", " ", " ", "\n", "\t", "\xa0", "1", ".", "'", "s", "日", "🙂", "\x1c", " "]
    texts = ODD + ["".join(rng.choice(chars) for _ in range(rng.randrange(40))) for _ in range(3000)]
    ids, bounds = K.Encoder(PATH, P.PATTERN).texts(pa.array(texts), 0)
    for text, want, a, b in zip(texts, library(texts), bounds, bounds[1:]):
        assert ids[a:b].tolist() == want + [0], repr(text)


def test_odd_rows_and_long_texts(spark, library, monkeypatch):
    monkeypatch.setattr(K, "SLICE_BYTES", 500)
    long = " ".join(f"word{k % 97}{k}" for k in range(3000))
    rows = [(k, t) for k, t in enumerate(ODD)] + [(None, None), (7, None), (7, "same"), (7, "same"), (8, long), (8, long + "  x")]
    df = spark.createDataFrame(rows, "doc_id long, text string").select("*", F.lit(1).alias("_row"), F.lit(2).alias("_size"),
                                                                         F.lit(3).alias("sequence_id"), F.lit(4).alias("_group"))
    cut = K.pieces(df.repartition(3), PATH, P.PATTERN, keep=("doc_id", "_row", "_size", "_group"), cap=64)
    packed = K.pack(cut, cap=64, group_rows=40)
    got = [r.asDict() for r in packed.collect()]
    assert packed.columns == ["doc_id", "_row", "_size", "_group", "piece", "start", "length", "ids", "sequence_id", "offset"]
    want = sorted(str(x + [0]) for x in library([t or "" for _, t in rows]))
    whole = [np.frombuffer(r["ids"], "<u4") for r in got]
    assert sum(map(len, whole)) == sum(map(len, map(eval, want))) and all(len(i) == r["length"] for i, r in zip(whole, got))
    in_place(got, 64)
    for r, ids in zip(got, whole):
        if r["piece"] == 0 and len(ids) < 64 and ids[-1] == 0 and r["doc_id"] not in (7, 8, None):
            assert ids.tolist() == library([ODD[r["doc_id"]]])[0] + [0]
    for s in K.sequences(packed).collect():
        parts = sorted((r["offset"], r["ids"]) for r in got if r["sequence_id"] == s.sequence_id)
        assert bytes(s.ids) == b"".join(bytes(p) for _, p in parts) and s.n_tokens == len(s.ids) // 4


def test_empty_table_and_bad_lengths(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert K.pack(K.pieces(none, PATH, P.PATTERN)).collect() == []
    with pytest.raises(Exception, match="lengths"):
        K.pack(spark.createDataFrame([(5,), (99,)], "length long"), cap=64).collect()


def fewest(sizes, cap):
    """Least number of bins by exhaustive search."""
    best = len(sizes)

    def go(rest, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if not rest:
            best = len(rooms)
            return
        tried = set()
        for k, r in enumerate(rooms):
            if r >= rest[0] and r not in tried:
                tried.add(r)
                go(rest[1:], rooms[:k] + [r - rest[0]] + rooms[k + 1:])
        go(rest[1:], rooms + [cap - rest[0]])

    go(sorted(sizes, reverse=True), [])
    return best


def test_local_search(spark):
    rng, better = random.Random(2), 0
    for _ in range(150):
        sizes = [rng.randrange(15, 50) for _ in range(rng.randrange(1, 13))]
        bins = K.pack_sizes(sizes, 100)
        assert sorted(k for b in bins for k in b) == list(range(len(sizes)))
        assert all(0 < sum(sizes[k] for k in b) <= 100 for b in bins)
        first = K.best_fit(sizes, 100)
        least = fewest(sizes, 100)
        better += len(bins) < len(first)
        assert least <= len(bins) <= min(len(first), least + 1)
    # three-way splits, on which best fit falls short
    sizes = [s for _ in range(200) for s in (lambda a, b: (a, b, 1000 - a - b))(rng.randrange(260, 400), rng.randrange(260, 340))]
    before, after = K.best_fit(sizes, 1000), K.pack_sizes(sizes, 1000)
    assert better + (len(after) < len(before)) > 0 and len(after) <= len(before)


def test_exchanges_raise_squared_fill():
    rng = random.Random(4)
    sizes = [rng.randrange(200, 420) for _ in range(300)]
    search = K.Search(sizes, [[k] for k in range(300)], 1000)  # a poor start
    filled = lambda: int(((1000 - search.room) ** 2).sum())
    fills, step = [], search.step

    def counted(v):
        fills.append(filled())
        found = step(v)
        if found is None:
            fills.append(None)
        return found

    search.step = counted
    bins = search.run()
    pairs = [(a, b) for a, b in zip(fills, fills[1:]) if a is not None and b is not None]
    assert len(pairs) > 100 and all(a < b for a, b in pairs)
    assert len(bins) < 120 and sorted(k for b in bins for k in b) == list(range(300))


def test_rounds_lose_no_bin_per_group(spark):
    rng = random.Random(9)
    sizes = [rng.randrange(1, 700) for _ in range(4000)] + [64] * 2000  # a third of all rows alike
    rows = spark.createDataFrame([(1, s) for s in sizes], "doc_id int, length int")
    got = [r.asDict() for r in K.pack(rows, cap=1000, group_rows=300).collect()]
    assert sorted(r["length"] for r in got) == sorted(sizes)
    assert in_place(got, 1000) <= -(-sum(sizes) // 1000) * 1.01 + 1
