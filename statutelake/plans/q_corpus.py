"""Corpus tables themselves, as the base check of the bridge."""

from __future__ import annotations

from statutelake.plans import corpus
from statutelake.plans.oracle import sql
from statutelake.plans.registry import query


@query("base_laws", sql("SELECT * FROM laws", "laws"))
def base_laws(spark, sf_dir):
    return corpus.laws(spark, sf_dir).drop("filename")


@query("base_nodes", sql("SELECT * EXCLUDE (content, content_en), md5(content) AS h, md5(content_en) AS h_en FROM nodes", "nodes"))
def base_nodes(spark, sf_dir):
    from pyspark.sql import functions as F

    return corpus.nodes(spark, sf_dir).withColumn("h", F.md5("content")).withColumn("h_en", F.md5("content_en")).drop("content", "content_en")


@query("base_cases", sql("SELECT * FROM cases", "cases"))
def base_cases(spark, sf_dir):
    return corpus.cases(spark, sf_dir)


@query("base_questions", sql("SELECT * FROM questions", "questions"))
def base_questions(spark, sf_dir):
    return corpus.questions(spark, sf_dir)
