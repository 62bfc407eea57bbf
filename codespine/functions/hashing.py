"""Canonical JSON and SHA-256 identities, stable across engines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What a record's hash covers, in this order.
SEMANTIC_FIELDS = (
    "level", "code", "hs2", "hs4", "hs6", "fraccion8", "nico2", "nico10", "name", "description", "unit_code", "unit_name", "values_from_level",
    "igi_text", "igi_kind", "igi_value", "ige_text", "ige_kind", "ige_value", "ligie_version", "validity_basis",
    "classification_effective_from", "classification_effective_to", "rate_effective_from", "rate_effective_to", "effective_from", "effective_to",
)


def decimal_text(value: Column) -> Column:
    """A decimal without trailing zeros."""
    text = value.cast("string")
    return F.when(text.contains("."), F.regexp_replace(F.regexp_replace(text, r"0+\z", ""), r"\.\z", "")).otherwise(text)


def json_string(value: Column) -> Column:
    """A JSON string literal (escapes in lower-case hexadecimal), or ``null``."""
    quoted = F.regexp_extract(F.to_json(F.struct(value.alias("v")), {"ignoreNullFields": "false"}), r"(?s)\A\{\"v\":(.*)\}\z", 1)
    for code in (0x0B, 0x0E, 0x0F, 0x1A, 0x1B, 0x1C, 0x1D, 0x1E, 0x1F):
        quoted = F.replace(quoted, F.lit(f"\\u{code:04X}"), F.lit(f"\\u{code:04x}"))
    return quoted


def json_value(value: Column, kind: T.DataType) -> Column:
    """Numbers and booleans bare, decimals and dates as strings, null as ``null``."""
    if isinstance(kind, (T.IntegralType, T.BooleanType)):
        return F.coalesce(value.cast("string"), F.lit("null"))
    return json_string(decimal_text(value) if isinstance(kind, T.DecimalType) else value.cast("string"))


def canonical_object(df: DataFrame, fields: tuple[str, ...]) -> Column:
    """A compact JSON object of columns, in the order given; a column that is missing counts as null."""
    kinds = {f.name: f.dataType for f in df.schema}
    each = [F.concat(F.lit(f'"{name}":'), json_value(F.col(name), kinds[name]) if name in kinds else F.lit("null")) for name in fields]
    return F.concat(F.lit("{"), F.concat_ws(",", *each), F.lit("}"))


def canonical_list(df: DataFrame, fields: tuple[str, ...]) -> Column:
    kinds = {f.name: f.dataType for f in df.schema}
    return F.concat(F.lit("["), F.concat_ws(",", *[json_value(F.col(name), kinds[name]) for name in fields]), F.lit("]"))


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def with_record_hash(df: DataFrame) -> DataFrame:
    return df.withColumn("record_hash", digest(canonical_object(df, SEMANTIC_FIELDS)))


def with_record_id(df: DataFrame) -> DataFrame:
    return df.withColumn("record_id", digest(canonical_list(df, ("level", "code", "ligie_version", "effective_from", "effective_to", "record_version"))))


def surrogate(prefix: str, *parts: Column, supplied: Column | None = None) -> Column:
    """A supplied identifier, else one derived from the parts."""
    own = F.concat(F.lit(f"{prefix}-"), digest(F.concat(F.lit("["), F.concat_ws(",", *[json_string(p.cast("string")) for p in parts]), F.lit("]"))))
    return own if supplied is None else F.coalesce(supplied, own)


def source_id(*parts: Column) -> Column:
    """Identifier of a captured source: digest of its parts, joined by NUL."""
    return F.concat(F.lit("source-"), digest(F.concat_ws("\0", *parts)))
