"""From raw documents to token ids: five stages over the operators of ``tabprep.llm``.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet and read again before the next one.  All but the last return
the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabprep.llm import bpe, decontam_simhash, pii_info, simhash_trie, toxicity
from tabprep.llm.common import free, importable, stage, table

#: Documents at this score or more are rejected.
TOXIC_AT = 0.5
VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    own = free(docs.columns, "_score")
    return toxicity.score(docs, model, score_col=own).where(F.col(own) < TOXIC_AT).drop(own)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    importable(spark)
    return simhash_trie.keep_one(docs, width=4, budget=4)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontam_simhash.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def remove_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data, and terms that give it away, replaced."""
    return pii_info.sanitise(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document and their offsets (code points), and digests
    of ids and decoded bytes."""
    importable(spark)
    path = public_tokenizers.path(VOCABULARY)
    coded = bpe.encode(docs, path, public_tokenizers.PATTERN, offsets=True, decoded_col="decoded", keep=["doc_id", "lang", "source"])
    return coded.select("doc_id", "lang", "source", "n_tokens", "ids", "starts", "ends", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("pii", remove_personal_data),
    ("byte_bpe", encode),
]

#: A classifier trained in numpy decides the first stage; SQL cannot express it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, step in STAGES:
        docs = stage(step(spark, docs, sf_dir))
    return docs
