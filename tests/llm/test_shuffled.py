"""What whole rows and pairs are shuffled for: only keys that a join may hit."""

from pyspark.sql import functions as F

from tabprep.llm import common, pii_info, simhash_trie


def filters(df):
    return [line for line in df._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Filter" in line and "getbit(" in line]


def test_a_key_set_loses_no_key(spark):
    keys = spark.createDataFrame([(i * 7, f"k{i}") for i in range(500)] + [(None, None), (1, None)], "a long, b string")
    assert keys.where(common.perhaps_in(keys, "a", "b")).count() == 502
    others = spark.range(20_000).select((F.col("id") + 5000).alias("a"), F.lit("other").alias("b"))
    passed = others.where(common.perhaps_in(keys, "a", "b")).count()
    assert 0 < passed < 4000
    assert others.where(common.perhaps_in(keys.limit(0), "a", "b")).count() == 0


def test_a_full_key_set_lets_everything_pass(spark, monkeypatch):
    monkeypatch.setattr(common, "MAX_SET_BITS", 64)
    keys = spark.range(5000)
    assert spark.range(9000).where(common.perhaps_in(keys, "id")).count() == 9000


def test_rows_that_stay_are_not_shuffled(spark):
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[(i * 7 + k * 3) % 400] for k in range(12))) for i in range(60)]
    rows += [(100 + i, rows[i][1]) for i in range(10)] + [rows[3], (None, rows[4][1]), (None, None), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    components = {r.doc_id: r.component_id for r in simhash_trie.near_duplicates(df).collect() if r.doc_id is not None}
    left = simhash_trie.keep_one(df)
    stay = [f for f in filters(left) if "NOT (getbit(" in f]
    assert len(stay) == 1 and len(filters(left)) == 3  # the others: rows that may be dropped, twice as some repeat
    ids = [r.doc_id for r in left.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(set(components.values())) and ids.count(None) == 1


def test_own_pairs_are_asked_for_before_the_join(spark):
    rows = [(i, f"note {i} for ada{i % 3}@example.org about topic{i % 3} and more") for i in range(1500)]
    rows += [(1, rows[1][1]), (2000, "nothing here"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = pii_info.annotate(df, generalise_at=0.8)
    assert filters(out)
    own = out.where("size(_base) > 0")
    found, _, _ = pii_info.disclosing(df, generalise_at=0.8)
    told = {}
    for r in found.collect():
        told.setdefault(r.entity, set()).add(r.term)
    assert told
    for r in own.collect():
        entity = "email:" + next(w for w in r._text.split() if "@" in w)
        marked = {r._text[s.start:s.end].lower() for s in r._added}
        outside = r._text[:r._base[0].start] + r._text[r._base[0].end:]
        assert marked == told.get(entity, set()) & set(outside.lower().split())
