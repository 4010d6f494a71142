"""The corpus pipeline: quality rules, line dedup, near-duplicates, mixing, packing.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame, which
is written as Parquet and read again as the next one's docs.  All but the last return the columns of
documents; n_chars follows the text.  Near duplicates are of five-word shingles and a similarity of 0.75.

Rows of any kind pass without failing: null, empty and very short texts are rejected by the quality rules;
repeated rows and ties are judged alike and the near-duplicate stage keeps one of them; extra columns of
documents are dropped at the first stage; empty documents give no sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.llm import jaccard, line_dedup, mixing, packing, quality
from marketlake.llm.common import on_workers, read, word_count, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _as_documents(df: DataFrame) -> DataFrame:
    return df.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; lines above the limits leave the others."""
    on_workers(spark)
    return _as_documents(quality.cleaned(docs.select(*COLUMNS)))


def line_dedup_by_source(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines on more than a fifth of a source's documents go."""
    on_workers(spark)
    return _as_documents(line_dedup.drop_lines(docs, host_col="source"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    on_workers(spark)
    return jaccard.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated, cut or left out so that each source has its budget of words."""
    on_workers(spark)
    return _as_documents(mixing.apply_mix(mixing.mix(docs.withColumn("size", word_count(F.col("text"))))))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in sequences of 1024."""
    on_workers(spark)
    return packing.packed(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup_by_source),
    ("near_duplicates", near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Hashed shingles, a graph's components and a tokenizer have no SQL; tests/llm has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(on_workers(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
