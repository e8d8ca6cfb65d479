"""One query for each operator of this package over the whole documents table, and the pipeline."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, filter_audit, jaccard_join, langid, media, mixing, pii, prefix_trie, quality, simhash, suffix_dedup, token_count, token_files
from ._common import materialise, scratch_dir
from .oracles import ORACLES  # noqa: F401 (part of this module's interface)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(documents(spark, sf_dir))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.token_counts(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), 512)


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(documents(spark, sf_dir))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = f"{scratch_dir(spark)}/token-files-{uuid.uuid4().hex}"
    token_files.write_token_files(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), out)
    return token_files.id_checksums(token_files.read_token_files(spark, out))


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir), budget_share=1.0, repetition=2.0)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    out = langid.predict(docs, langid.fit(docs))
    return out.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score", "rejected")


def op8_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = media.inspect(media.store(documents(spark, sf_dir)), with_payload=True)
    feature = F.concat_ws("|", "codec", "duration_ms", "n_samples", "key_ranges").alias("feature")
    return seen.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", feature)


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(documents(spark, sf_dir))

    def joined(spans: str):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))


def op10_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bpe.round_trip(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
    n = F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens")
    return out.select("doc_id", n, F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"), F.sha2("readable", 256).alias("readable_sha256"))


def op11_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = materialise(prefix_trie.turn_ids(spark.read.parquet(f"{sf_dir}/conversations.parquet")))
    return prefix_trie.trie_nodes(prefix_trie.as_keys(prefix_trie.rebuilt(own)))


def op12_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(documents(spark, sf_dir))


def op13_filter_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_simhash_near_duplicates, op2_quality_rules, op3_token_counts, op4_suffix_dedup, op5_token_files,
    op6_source_mixing, op7_language_id, op8_media_columns, op9_pii, op10_bpe_round_trip, op11_conversation_prefix_trie, op12_ngram_jaccard_join, op13_filter_interactions, pipeline,
)}
