"""The registered queries: each applies one operator to its whole table and derives the contract's columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import align, ann, bpe, chat, counts, decontaminate, lattice, licences, phrases, quality, simhash, tokenfile, toxicity
from .common import remainder, table


def vocabulary_file(name: str) -> str:
    """Path of a public tokenizer's file; the files are installed beside Python, not kept here."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    same = "<|im_end|><|im_start|>assistant ok"
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(same).alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    out = chat.read_back(chat.formatted(rows.select("conv_id", "turn", "role", chat.text_part(F.col("text")).alias("parts"))))
    listed = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(listed.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfile.round_trip(table(spark, sf_dir, "documents"), vocabulary_file("word_bpe_49k.json"), end_id=1)


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), width=4, radius=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op5_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.occurrences(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)
    named = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select(
        "doc_id", "n_words", decontaminate.hit_words().alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(named.cast("binary"), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"),
    )


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), vocabulary_file("byte_bpe_50k.json"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), remainder("doc_id", 3) == 1
    model = quality.fit(docs, table(spark, sf_dir, "labels"), allowed=~held_out)
    rows = quality.scored(docs.select("doc_id", "text"), model)
    score = F.col("quality_score")
    return rows.select("doc_id", held_out.alias("held_out"), score.alias("score"), (score >= 0.5).cast("int").alias("predicted"))


def op9_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    training, held_out = lattice.split_by_id()
    return lattice.scores(table(spark, sf_dir, "documents"), vocabulary_file("piece_bpe_32k.model"), training=training, held_out=held_out)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), remainder("doc_id", 4) == 2
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), allowed=~held_out)
    rows = toxicity.scored(docs.select("doc_id", "text"), model)
    score = F.col("toxic_score")
    return rows.select("doc_id", held_out.alias("held_out"), score.alias("score"), (score >= 0.3).cast("int").alias("predicted"))


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.token_counts(table(spark, sf_dir, "documents"), vocabulary_file("byte_bpe_50k.json"), limit=1024)


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.alignment(table(spark, sf_dir, "documents"), vocabulary_file("byte_bpe_50k.json"), vocabulary_file("piece_bpe_32k.model"))[0]


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"), least=30, top=2000)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (
        op1_ann, op2_chat, op3_token_files, op4_simhash, op5_licences, op6_decontaminate, op7_bpe, op8_quality, op9_lattice, op10_toxicity,
        op11_token_counts, op12_alignment, op13_collocations,
    )
    return {f.__name__: f for f in every}


def oracle_sql() -> dict[str, str]:
    return {"op2_chat": chat.oracle(), "op5_licences": licences.oracle(), "op13_collocations": phrases.oracle()}
