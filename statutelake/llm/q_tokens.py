"""Queries of the token operators (1, 3, 7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import sentencepieces, token_counts, token_files
from .registry import query
from .session import shared_path, table
from .vocabularies import vocabulary


@query("op3_token_files")
def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, written as ORC files and measured from what is read back."""
    path = shared_path(spark, "ids")
    token_files.write_ids(table(spark, sf_dir, "documents"), path, vocabulary("word_bpe_49k.json"))
    return token_files.digest(spark, path)


@query("op7_token_counts")
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and word pieces of every document."""
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


@query("op1_sentencepieces")
def op1_sentencepieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document by parts, with the size and checksum of what they decode to."""
    model = vocabulary("piece_bpe_32k.model")
    return sentencepieces.digest(sentencepieces.encode(table(spark, sf_dir, "documents"), model), model)
