"""Types of the tables whose shape is part of the contract."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: The public columns in order.
PUBLIC = (
    "record_id string, record_version int, is_current boolean, code string, formatted_code string, level string, hs2 string, hs4 string, hs6 string, "
    "fraccion8 string, nico2 string, nico10 string, name string, description string, name_is_derived boolean, unit_code string, unit_name string, "
    "values_from_level string, igi_text string, igi_kind string, igi_value decimal(18,6), ige_text string, ige_kind string, ige_value decimal(18,6), "
    "ligie_version string, dataset_version string, schema_version string, record_hash string, validity_basis string, updated_at date, published_at date, "
    "classification_effective_from date, classification_effective_to date, rate_effective_from date, rate_effective_to date, effective_from date, "
    "effective_to date, observed_at date, retrieved_at timestamp, primary_source_document_id string, primary_source_authority string, "
    "primary_source_url string, source_document_ids_json string, source_count bigint"
)
CLASSIFICATIONS = "level string, code string, description string, ligie_version string, validity_basis string, updated_at date, published_at date, classification_effective_from date, classification_effective_to date, source_document_id string"
RATES = "code string, ligie_version string, unit_code string, unit_name string, igi_text string, igi_kind string, igi_value decimal(18,6), ige_text string, ige_kind string, ige_value decimal(18,6), updated_at date, published_at date, rate_effective_from date, rate_effective_to date, source_document_id string"
NOTES = "chapter string, scope_type string, scope_value string, note_number string, text string, source_document_id string"


def empty(spark: SparkSession, ddl: str) -> DataFrame:
    return spark.createDataFrame([], ddl)


def names(ddl: str) -> list[str]:
    return [part.strip().split(" ")[0] for part in ddl.replace("(18,6)", "").split(",")]


def in_contract_order(df: DataFrame, ddl: str = PUBLIC) -> DataFrame:
    """The contract's columns in their order; raises if one is missing."""
    if missing := [n for n in names(ddl) if n not in df.columns]:
        raise ValueError(f"columns that are missing: {', '.join(missing)}")
    return df.select(*names(ddl))
