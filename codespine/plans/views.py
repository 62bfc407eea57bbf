"""The public views over the warehouse's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.evaluate import provenance_lists
from ..operators.hierarchy import chapter_code


def public_view(records: DataFrame, provenance: DataFrame, sources: DataFrame) -> DataFrame:
    """Records with their primary source's authority and address, and the list and number of all sources."""
    listed = provenance_lists(provenance, "record_id", "source_document_id")
    primary = sources.select(F.col("source_document_id").alias("primary_source_document_id"), F.col("authority").alias("primary_source_authority"), F.col("url").alias("primary_source_url"), "observed_at", "retrieved_at")
    return records.join(primary, "primary_source_document_id").join(listed, "record_id")


def national_notes_view(notes: DataFrame, versions: DataFrame, applicability: DataFrame) -> DataFrame:
    return notes.join(versions, "national_note_id").join(applicability, "national_note_version_id")


def proposals_view(proposals: DataFrame, batches: DataFrame) -> DataFrame:
    return proposals.join(batches, "batch_id")


def indicators_view(indicators: DataFrame, methodologies: DataFrame) -> DataFrame:
    return indicators.join(methodologies, "methodology_id", "left")


def notes_of_chapter(view: DataFrame, chapter: str) -> DataFrame:
    """A chapter's notes in their order; every null place is explicit. Raises for what isn't two digits."""
    order = [F.asc_nulls_last(c) for c in ("note_number", "scope_type", "scope_value", "source_document_id", "national_note_version_id") if c in view.columns]
    return view.where(F.col("chapter") == chapter_code(chapter)).orderBy(*order)


def register(views: dict[str, DataFrame]) -> None:
    """Names the views in their session, for SQL."""
    for name, view in views.items():
        view.createOrReplaceTempView(name)


def note_tables(notes: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Parsed notes as three tables (note, version, applicability) with identifiers from their content."""
    from ..functions.hashing import surrogate

    rows = notes.withColumn("national_note_id", surrogate("note", F.col("chapter"), F.col("scope_type"), F.col("scope_value"), F.col("note_number")))
    rows = rows.withColumn("national_note_version_id", surrogate("version", F.col("national_note_id"), F.col("text"), F.col("source_document_id")))
    rows = rows.withColumn("applicability_id", surrogate("applies", F.col("national_note_version_id"), F.col("chapter")))
    return (
        rows.select("national_note_id", "note_number").distinct(),
        rows.select("national_note_version_id", "national_note_id", "text", "source_document_id").distinct(),
        rows.select("applicability_id", "national_note_version_id", "chapter", "scope_type", "scope_value").distinct(),
    )
