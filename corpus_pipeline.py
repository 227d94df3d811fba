"""The corpus pipeline: language ID, exact dedup, near-duplicate join, mixing, SentencePiece encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
stage's docs. All stages but the last return the columns of documents.

Any column may be null, texts may be empty or very long, rows may repeat, the table may be empty, and further columns, of
whatever name, go along. A text that is null or has no letter goes with the first stage, as its language can't be told.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyspark.llm.common import cut, discard, mark
from tallyspark.llm.exact_dedup import drop_copies
from tallyspark.llm.language_id import keep_identified
from tallyspark.llm.merge_dropout import encode_pieces
from tallyspark.llm.mixing import mixed
from tallyspark.llm.ngram_join import keep_one_of_each


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; each row is judged by its own text, whatever its id."""
    return keep_identified(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, by id and text; rows with a null id, or that repeat both, stay."""
    return drop_copies(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies; rows with a null id stay."""
    return keep_one_of_each(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample calibrated to the target weights of source, language and topic; nulls are a value of their own."""
    return mixed(docs)


def sentencepiece_dropout(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_pieces, ids) of each row; null texts have no pieces. Lots are small: the stages before left memory in use."""
    return encode_pieces(docs, lot=1 << 19)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("mixing", mixing),
    ("sentencepiece_dropout", sentencepiece_dropout),
]

#: A trained classifier, a similarity join and BPE merges can't be put in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. What a stage wrote for itself is deleted once its result is written."""
    docs, since = spark.read.parquet(f"{sf_dir}/documents.parquet"), mark()
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = cut(docs, f"stage{k}-{name}")
            discard(spark, since, keep=1)
    return docs
