"""The registered query of each operator, over whole tables, and DuckDB SQL where SQL can express it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framelake.llm import align, bpe, chat, decontam, html, mixing, neardup, quality, secrets, sharding, tokens, toxicity, whitening
from framelake.llm._spark import cut, new_path, text_batches
from framelake.llm._spark import table as read

HARD = "</s>[INST] ok [/INST]"
SHARD_BYTES = 64 << 10  # so small that buckets split at every scale of the tables


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text_batches(spark)
    return read(spark, sf_dir, name)


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.shard(docs, SHARD_BYTES).select("doc_id", "shard", "depth", "bytes")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", mixing.n_words(F.col("text")).alias("size"), F.md5(F.coalesce("text", F.lit(""))).alias("th"))
    mixed = mixing.mix(cut(docs, "mix-sizes"), spread_col="th")
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html.extract(pages, html.train(pages))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.grade(docs, toxicity.train(docs, table(spark, sf_dir, "labels")), columns=["doc_id"])


def op5_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(tokens.VOCABULARY))


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = [(-1, 0, "user", HARD), (-1, 1, "assistant", HARD)]
    chats = cut(chat.format_chats(turns.unionByName(spark.createDataFrame(rows, turns.schema))), "chats")
    return chat.digests(chats)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.judge(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = neardup.near_duplicates(table(spark, sf_dir, "documents"), ngram=3, percent=85, bands=30, rows=6)
    return out.select("doc_id", "n_shingles", "component_id", "kept")


def op9_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents")).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_checked", "n_jwt", "n_pem")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.alignment(table(spark, sf_dir, "documents"), public_tokenizers.path(align.VOCABULARY_A), public_tokenizers.path(align.VOCABULARY_B))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read(spark, sf_dir, "embeddings"))


def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path(bpe.VOCABULARY))


OPERATORS = (
    op1_sharding, op2_mixing, op3_html_extraction, op4_toxicity, op5_token_ids, op6_chat_formatting, op7_quality_rules, op8_minhash, op9_secret_scans, op10_decontamination,
    op11_alignment, op12_whitening, op13_bpe,
)
QUERIES = {f.__name__: f for f in OPERATORS}

ORACLES = {"op1_sharding": sharding.oracle(SHARD_BYTES), "op2_mixing": mixing.ORACLE, "op6_chat_formatting": chat.oracle(HARD), "op8_minhash": neardup.oracle(3, 85)}
