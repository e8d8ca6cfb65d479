"""From the documents table to token ids: language ID, near-duplicates, personal data, mixing, encoding.

Each stage works on all rows that the one before it kept and returns the columns of ``documents``; the last returns ids.
Nulls: a null text has no language and goes with the rejected ones; a null id is never a duplicate of another.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siltwave.llm import bpe, langid, mixing, pii, simhash
from siltwave.llm._common import scratch_dir

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
NEAR_WORDS, NEAR_BITS = 5, 7
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the nearest centroid accepts; null texts and texts without a letter have none and go.

    Repeated rows and rows without an id are each judged by their text. Without documents nothing is learned and none come out.
    """
    model = langid.fit(docs)
    return langid.keep_accepted(docs, model).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near-duplicates, once; rows without an id stay.

    Groups are of five-word shingles whose fingerprints differ in at most ``NEAR_BITS`` bits.
    Rows of one id with different texts are documents of their own: each stays unless its fingerprint is that of another
    row of the id, or its group has a smaller id.
    """
    key = F.xxhash64("text", "lang", "source", "n_chars")
    near = simhash.near_duplicates(docs, most=NEAR_BITS, size=NEAR_WORDS, row_key=key).filter("doc_id = component_id")
    groups = near.groupBy("doc_id", "fingerprint").agg(F.min("row_key").alias("row_key")).select("doc_id", "row_key")
    named = docs.filter("doc_id is not null").withColumn("row_key", key).join(groups, ["doc_id", "row_key"], "left_semi")
    one = F.row_number().over(W.partitionBy("doc_id", "row_key").orderBy("text", "lang", "source", "n_chars"))
    named = named.select(*COLUMNS, one.alias("copy")).filter("copy = 1")
    return named.select(*COLUMNS).unionByName(docs.filter("doc_id is null").select(*COLUMNS))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with the kind of each identifier in its place; null and empty texts stay as they are, repeated rows repeat."""
    return pii.mask_column(docs).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows repeated as often as the mix takes them: as many words as came in, no source more than twice.

    Rows of one id are taken as often as the most wanted of them; rows without an id stay once. Ties in a source's order go by the digest of the id.
    """
    taken = mixing.mix(docs.filter("doc_id is not null"), budget_share=1.0, repetition=2.0).select("doc_id", "copies").filter("copies > 0")
    taken = taken.groupBy("doc_id").agg(F.max("copies").alias("copies"))
    rows = docs.join(taken, "doc_id").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return rows.select(*COLUMNS).unionByName(docs.filter("doc_id is null").select(*COLUMNS))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids`` with the ids as packed little-endian 32-bit numbers; null and empty texts have none.

    Each row is encoded by itself, so repeated rows and rows without an id repeat.
    """
    out = bpe.encode_documents(docs, WORD_BPE)
    return out.select("doc_id", F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("language ID", identify_language),
    ("SimHash near-dedup", drop_near_duplicates),
    ("personal data", mask_personal_data),
    ("mixing sources", mix_sources),
    ("BPE encoding", encode),
]

#: SQL cannot express SimHash, the transducers or the merges; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*COLUMNS)
    base = f"{scratch_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{base}/{k}")
        docs = spark.read.schema(out.schema).parquet(f"{base}/{k}")
    return docs
