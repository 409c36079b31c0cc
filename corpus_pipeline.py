"""A corpus pipeline of five stages over ``documents``; each is written as Parquet and read as the next one's input."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framelake.llm import decontam, mixing, neardup, tokens, toxicity
from framelake.llm._spark import cut, fresh, new_path, table, text_batches


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents graded toxic go.

    The model is fitted on labelled rows of ``docs``; without one, the grade is that of a text without features and all stay.
    Null and empty texts, which hold no feature, are judged alike. Rows that repeat an id or a text are judged each for
    itself; a null id is never labelled. Texts are read whole. An empty table gives no row. Columns stay as they are,
    whatever they are called.
    """
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    graded = toxicity.grade(docs, model)
    return graded.where(~F.col(graded.columns[-1])).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: five-word shingles, similarity 0.8 or more.

    The one with the least id stays; among rows that share id and text, the one whose columns hash lowest. A null id is no
    id: such a row stays only where its group has none. Null and blank texts have no copies and all stay. Long texts
    are compared by all their shingles. An empty table gives no row. Columns stay as they are.
    """
    return neardup.keep_one(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go.

    Null and empty texts hold none and stay; so do all where the benchmark is empty. Rows that repeat an id are judged each
    for itself. Long texts are searched whole. An empty table gives no row. Columns stay as they are.
    """
    judged = decontam.contamination(docs, table(spark, sf_dir, "benchmark"), columns=docs.columns)
    return judged.where(~F.col(judged.columns[-1])).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks for: not at all, or up to three times.

    Sizes are words; null and empty texts have none and may be taken any number of times up to three. A null source is a
    source of its own. Rows that repeat an id count each; rows that are the same in id and text may swap their copies.
    An empty table gives no row. Columns stay as they are. Sizes are written once and read by each pass.
    """
    size, spread = fresh(docs, "size"), fresh(docs, "spread")
    sized = docs.withColumn(size, mixing.n_words(F.col("text"))).withColumn(spread, F.md5(F.coalesce("text", F.lit(""))))
    mixed = mixing.mix(cut(sized, "mix-sizes"), size_col=size, spread_col=spread)
    return mixing.emit(mixed, docs.columns, mixed.columns[-1])


def write_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of all texts in packed files; what is returned is read back from them: doc_id, start, n_tokens, ids_crc32.

    A null or empty text is its end id alone. Documents go by id, a null id first, rows of one id by the hash of their text;
    each copy that mixing made has its place. An empty table gives no row. Columns other than id and text aren't read.
    """
    return tokens.round_trip(docs, public_tokenizers.path(tokens.VOCABULARY))


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_benchmark),
    ("mixing_sources", mix_sources),
    ("token_ids", write_token_ids),
]

#: the stages score with a fitted model, hashed sketches and a tokenizer, which SQL can't express; tests hold them against plain versions
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, over all of ``documents``."""
    text_batches(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
