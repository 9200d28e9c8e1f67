"""Registered queries of this subpackage: ``fn(spark, sf_dir)`` by name, and
the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabprep.llm.common import folder, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


#: Rules and blocked sites of the url filter (fixed values).
URL_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
             ("block", "net", "/es/"), ("block", "net", "/fr/")]
BLOCKED_SITES = ["spam-farm.example.org"]


@register("op1_url_bloom_cascade", sql=r"""
    WITH u AS (SELECT page_id, position('://' IN coalesce(url, '')) AS p, coalesce(url, '') AS url FROM pages),
    r AS (SELECT page_id, CASE WHEN p > 0 THEN substr(url, p + 3) ELSE '' END AS r FROM u),
    s AS (SELECT page_id, regexp_extract(r, '^([^/?#]*)', 1) AS h0, regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM r),
    t AS (SELECT page_id, translate(h0, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM s),
    k AS (SELECT *, (host = 'spam-farm.example.org' OR ends_with(host, '.spam-farm.example.org')) AS listed,
        CASE WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
             WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
             WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
             WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
             WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/' END AS rule FROM t)
    SELECT page_id, host, path, rule, CASE WHEN rule IN ('www.example.com/en/', 'com/') THEN 'allow'
        WHEN rule IS NOT NULL THEN 'block' WHEN listed THEN 'block' ELSE 'allow' END AS verdict, listed FROM k""")
def op1_url_bloom_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabprep.llm import url_cascade as U
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    host, path = U.split_url(F.col("url"))
    blocked = reduce(lambda a, b: a | b, [U.on_site(host, site) for site in BLOCKED_SITES])
    listed = pages.where(blocked).select(F.concat(host, path).alias("key")).distinct()
    return U.judge(pages, [U.Rule(*r) for r in URL_RULES], listed)


@register("op2_pii_information")
def op2_pii_information(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabprep.llm import pii_info
    return pii_info.report(table(spark, sf_dir, "documents"))


@register("op3_decontaminate_simhash")
def op3_decontaminate_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabprep.llm import decontam_simhash
    return decontam_simhash.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: Queries of the vector search: every row whose id is divisible by this.
QUERY_EVERY = 20


@register("op4_maxscore", sql=f"""
    WITH v AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS q FROM embeddings
               WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
                 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT a.vec_id AS query_id, b.vec_id AS vec_id, list_dot_product(a.q::DOUBLE[], b.q::DOUBLE[])::BIGINT AS score
          FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % {QUERY_EVERY} = 0)
    SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
    FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 20""")
def op4_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabprep.llm import maxscore
    return maxscore.top_k(table(spark, sf_dir, "embeddings"), F.col("id") % QUERY_EVERY == 0, k=20)


@register("op5_byte_bpe")
def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from tabprep.llm import bpe
    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                          public_tokenizers.PATTERN)


@register("op6_warc_content_addressed")
def op6_warc_content_addressed(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabprep.llm import warc_cas
    place = folder(spark)
    warc_cas.write(table(spark, sf_dir, "pages"), place)
    return warc_cas.read(spark, place)


@register("op7_gru_lm")
def op7_gru_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabprep.llm import gru_lm
    return gru_lm.score(table(spark, sf_dir, "documents"))


@register("op8_simhash_trie")
def op8_simhash_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabprep.llm import simhash_trie
    return simhash_trie.near_duplicates(table(spark, sf_dir, "documents"), width=4, budget=4)


@register("op9_extendible_hashing", sql="""
    WITH RECURSIVE d AS (SELECT doc_id, coalesce(strlen(text), 0) AS bytes,
        lpad(bin(('0x' || substr(md5(doc_id::VARCHAR), 1, 15))::BIGINT), 60, '0') AS a FROM documents),
    b AS (SELECT '' AS shard, 0 AS depth, sum(bytes)::BIGINT AS shard_bytes FROM d
          UNION ALL
          SELECT k.shard, k.depth, k.shard_bytes FROM (
            SELECT left(d.a, b.depth + 1) AS shard, b.depth + 1 AS depth, sum(d.bytes)::BIGINT AS shard_bytes
            FROM b JOIN d ON left(d.a, b.depth) = b.shard WHERE b.shard_bytes > 1048576 GROUP BY 1, 2) k)
    SELECT d.doc_id, b.shard, b.depth, b.shard_bytes FROM d JOIN b ON left(d.a, b.depth) = b.shard
    WHERE b.shard_bytes <= 1048576""")
def op9_extendible_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabprep.llm import ext_hash
    docs = table(spark, sf_dir, "documents").select("doc_id", F.octet_length("text").alias("n"), F.md5("text").alias("m"))
    return ext_hash.shards(docs, key=F.col("doc_id"), size=F.col("n"), row=F.col("m")).select(
        "doc_id", "shard", "depth", "shard_bytes")


@register("op10_toxicity_subword")
def op10_toxicity_subword(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabprep.llm import toxicity
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op11_whitening")
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabprep.llm import whitening
    found = whitening.whiten(table(spark, sf_dir, "embeddings"), scale=256, k=4)
    # the contract's type is long; null where the exact value needs more bits
    return found.withColumn("deviation", F.expr("try_cast(deviation AS BIGINT)"))


@register("op13_swap_packing")
def op13_swap_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from tabprep.llm import packing
    cut = packing.pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                         public_tokenizers.PATTERN, cap=2048, end=0)
    return packing.pack(cut.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")), cap=2048)


@register("op12_phrase_collocations", sql=r"""
    WITH d AS (SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang,
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
    p AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
    w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM p),
    n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY 1),
    g AS (SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: w[i:i + m - 1])) AS g
          FROM w, (SELECT unnest(range(1, 6)) AS m) WHERE len(w) >= m),
    f AS (SELECT lang, m, array_to_string(g, ' ') AS phrase, any_value(g) AS g, count(*) AS a FROM g GROUP BY 1, 2, 3 HAVING count(*) >= 100),
    x AS (SELECT DISTINCT lang, unnest([array_to_string(g[1:m - 1], ' '), array_to_string(g[2:m], ' ')]) AS phrase, a FROM f WHERE m > 2),
    c AS (SELECT f.*, unnest(range(1, m)) AS k FROM f ANTI JOIN x ON f.lang = x.lang AND f.phrase = x.phrase AND f.a = x.a WHERE m > 1),
    s AS (SELECT c.lang, c.phrase, c.a, c.k, l.a AS l, r.a AS r, n.n, (1000::HUGEINT * c.a * n.n) // (l.a::HUGEINT * r.a) AS score
          FROM c JOIN n ON n.lang = c.lang JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.g[1:c.k], ' ')
          JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.g[c.k + 1:c.m], ' ')),
    t AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
    SELECT lang, CAST(row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS BIGINT) AS rank,
        phrase, a, l, r, n, score::BIGINT AS score FROM t QUALIFY rank <= 2000""")
def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabprep.llm import phrases
    found = phrases.mine(table(spark, sf_dir, "documents"), least=100, top=2000)
    return found.withColumn("rank", F.col("rank").cast("long"))
