"""The operators bound to the test tables: one query each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    clustering, jaccard, lexicon_bpe, license_scan, line_dedup, mixing, neardup, packing, pii, quality, ranked_search, substring, toxicity)
from .common import read, word_count, written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(pii.sanitise(read(spark, sf_dir, "documents")))


@query
def op2_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(read(spark, sf_dir, "embeddings"))


@query
def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", word_count(F.col("text")).alias("size"))
    return mixing.mix(written(docs, "sizes")).select("doc_id", "size", "source_size", "target", "taken")


@query
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(read(spark, sf_dir, "documents")).drop("frequent")


@query
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(read(spark, sf_dir, "documents"))


@query
def op6_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_join(read(spark, sf_dir, "documents"))


@query
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(line_dedup.drop_lines(
        written(line_dedup.page_texts(read(spark, sf_dir, "pages")), "page-texts")))


@query
def op8_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.report(substring.remove_repeats(read(spark, sf_dir, "documents")))


@query
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query
def op10_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.report(license_scan.scan(read(spark, sf_dir, "documents")))


@query
def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query
def op12_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.report(clustering.cluster(read(spark, sf_dir, "embeddings")))


@query
def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return lexicon_bpe.report(lexicon_bpe.decode(lexicon_bpe.encoded_at(docs)))
