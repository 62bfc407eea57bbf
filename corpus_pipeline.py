"""A training corpus from raw documents: five stages, each of which works on all that the one before it kept.

1. quality: documents below the Bradley-Terry ranker's threshold go.
2. toxicity: documents at or above the factorisation machine's limit go.
3. near duplicates: one document of each group of alike shingle sets stays, that with the smallest id.
4. decontamination: passages of the benchmark are cut out; documents that hold nothing else go.
5. tokens: whole texts in byte-level BPE, and what the ids decode to.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of ``documents``.
Null texts count as empty; empty tables pass through; columns beyond those of ``documents`` are carried by every stage but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codespine.llm import bpe, decontaminate, quality, simhash, toxicity
from codespine.llm.catalog import vocabulary_file
from codespine.llm.common import free_name, remainder, table, written

TOXIC_FROM = 0.3


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that score 0.5 or more; labels of the rows that ``op8`` holds out are not learned from here either."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"), allowed=remainder("doc_id", 3) != 1)
    name = free_name(docs, "quality_score")
    return quality.scored(docs, model, name).where(F.col(name) >= 0.5).drop(name)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that score below the limit; labels of the rows that ``op10`` holds out are not learned from here either."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), allowed=remainder("doc_id", 4) != 2)
    name = free_name(docs, "toxic_score")
    return toxicity.scored(docs, model, name).where(F.col(name) < TOXIC_FROM).drop(name)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each component of documents with a shingle similarity of 0.8.

    SimHash fingerprints propose pairs, pivot distance tables discard and shingle sets verify them; an exact join of rare shingles, past the same tables, adds
    those pairs that fingerprints four bits apart don't show.
    """
    return simhash.deduplicated(docs).select(*docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts benchmark passages out; ``n_chars`` follows the text."""
    clean = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    if "n_chars" in clean.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``n_tokens`` and the digests of ids and decoded text."""
    return bpe.digests(docs, vocabulary_file("byte_bpe_50k.json"))


STAGES = [
    ("quality", quality_stage),
    ("toxicity", toxicity_stage),
    ("near_duplicates", dedup_stage),
    ("decontamination", decontamination_stage),
    ("tokens", token_stage),
]

#: Learned models and automata are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
