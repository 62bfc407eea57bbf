"""Invariants of a published data set. All row-local checks share one pass; the others are joins and groups."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F


class ValidationError(ValueError):
    """Invariants that don't hold, with their counts."""


def blank(c: str) -> Column:
    return F.col(c).isNull() | (F.trim(c) == "")


def row_checks() -> dict[str, Column]:
    """Conditions under which a row breaks an invariant; null is no breach."""
    code = F.col("code")
    head = lambda n: F.substring(code, 1, n)
    unset = F.col("level").isin("hs2", "hs4", "hs6") & (F.col("values_from_level").isNotNull() | F.col("unit_code").isNotNull() | F.col("igi_text").isNotNull() | F.col("ige_text").isNotNull())
    no_value = lambda d: F.col(f"{d}_kind").isin("prohibida", "especifica", "compuesta", "desconocida") & F.col(f"{d}_value").isNotNull()
    return {
        "missing_required_values": blank("description") | F.col("ligie_version").isNull() | F.col("dataset_version").isNull() | F.col("schema_version").isNull() | blank("primary_source_authority") | blank("primary_source_url"),
        "invalid_hierarchy": (F.col("hs2") != head(2)) | (F.col("hs4") != head(4)) | (F.col("hs6") != head(6)) | (F.col("fraccion8") != head(8)) | (F.col("nico10").isNotNull() & ((F.col("nico10") != code) | (F.col("nico2") != F.substring(code, -2, 2)))),
        "reversed_intervals": F.col("effective_from") > F.col("effective_to"),
        "provenance_count_mismatch": F.col("source_count") != F.json_array_length("source_document_ids_json"),
        "invalid_duty_values": no_value("igi") | no_value("ige"),
        "invalid_value_origin": unset | (F.col("level").isin("fraccion8", "nico10") & (F.col("values_from_level") != "fraccion8")),
        "missing_public_metadata": F.col("updated_at").isNull() | F.col("ligie_version").isNull() | F.col("dataset_version").isNull() | F.col("schema_version").isNull(),
    }


def certified_origin() -> Column:
    """The certification's form of ``invalid_value_origin``: compared null-safe, so a rate level without an origin is a breach there."""
    return F.coalesce(F.col("level").isin("fraccion8", "nico10"), F.lit(False)) & ~F.col("values_from_level").eqNullSafe("fraccion8")


def single_pass(records: DataFrame, checks: dict[str, Column] | None = None) -> DataFrame:
    """One row with a count for each row-local check and ``duplicate_record_ids``."""
    counts = [F.count(F.when(condition, 1)).alias(name) for name, condition in (checks or row_checks()).items()]
    return records.agg((F.count("*") - F.count_distinct("record_id")).alias("duplicate_record_ids"), *counts)


def written_with_counts(records: DataFrame, path: str, checks: dict[str, Column] | None = None, *, key: str = "record_id") -> dict[str, int]:
    """Writes the records to ``path`` and returns the counts of :func:`single_pass`, taken by the pass that writes.

    The counts are observed metrics, so the records aren't read again. Metrics can't count distinct keys, so a key's rows are
    numbered first, and all but its first count (rows without a key all count).
    """
    again = (F.row_number().over(Window.partitionBy(key).orderBy(key)) > 1) | F.col(key).isNull()
    seen = Observation()
    counts = [F.count(F.when(condition, 1)).alias(name) for name, condition in (checks or row_checks()).items()]
    flagged = records.withColumn("_again", again).observe(seen, F.count(F.when(F.col("_again"), 1)).alias("duplicate_record_ids"), *counts)
    flagged.drop("_again").write.parquet(path)
    return {k: int(v) for k, v in seen.get.items()}


def published(records: DataFrame, path: str, checks: dict[str, Column] | None = None) -> DataFrame:
    """Writes records beside ``path`` and renames them to it if every row-local invariant holds; else raises and leaves nothing at ``path``."""
    spark, stage = records.sparkSession, f"{path}.staging"
    where = spark._jvm.org.apache.hadoop.fs.Path
    files = where(path).getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(where(path)):
        raise ValidationError(f"{path} is there already")
    files.delete(where(stage), True)
    counts = written_with_counts(records, stage, checks)
    if any(counts.values()):
        files.delete(where(stage), True)
    require(counts)
    files.rename(where(stage), where(path))
    return spark.read.schema(records.schema).parquet(path)


#: Levels and the level that their parent has, with the check that finds those without.
PARENT_CHECKS = {
    "current_nico_without_parent": ("nico10", "fraccion8"), "fraction_without_hs6_parent": ("fraccion8", "hs6"),
    "hs6_without_hs4_parent": ("hs6", "hs4"), "hs4_without_hs2_parent": ("hs4", "hs2"),
}


def without_parents(records: DataFrame) -> DataFrame:
    """``check`` and the rows of :func:`without_parent` for all levels, by one anti join on (parent level, parent code, version)."""
    current = records.where("is_current")
    child = F.create_map(*[F.lit(x) for name, (level, _) in PARENT_CHECKS.items() for x in (level, name)])
    up = F.coalesce(*[F.when(F.col("level") == level, F.struct(F.lit(parent).alias("level"), F.col(parent).alias("code"))) for level, parent in PARENT_CHECKS.values()])
    rows = current.where(F.col("level").isin([level for level, _ in PARENT_CHECKS.values()])).withColumns({"check": F.element_at(child, F.col("level")), "_up": up})
    have = current.select(F.struct("level", "code").alias("_up"), "ligie_version")
    return rows.join(have, ["_up", "ligie_version"], "left_anti").drop("_up")


def note_cardinality(versions: DataFrame, applicability: DataFrame) -> DataFrame:
    """Note versions that don't apply to exactly one chapter: ``national_note_version_id``, ``n``."""
    n = applicability.groupBy("national_note_version_id").agg(F.count("applicability_id").alias("n"))
    return versions.join(n, "national_note_version_id", "left").select("national_note_version_id", F.coalesce("n", F.lit(0)).alias("n")).where("n <> 1")


def without_parent(records: DataFrame, level: str, parent_level: str) -> DataFrame:
    """Current records of a level whose parent of the same version isn't current."""
    current = records.where("is_current")
    up = current.where(F.col("level") == parent_level).select(F.col("code").alias(parent_level), "ligie_version")
    return current.where(F.col("level") == level).join(up, [parent_level, "ligie_version"], "left_anti")


def non_contiguous(records: DataFrame, identity: list[str], version: str = "record_version") -> DataFrame:
    n = records.groupBy(*identity).agg(F.count("*").alias("rows"), F.min(version).alias("first"), F.max(version).alias("last"), F.count_distinct(version).alias("different"))
    return n.where((F.col("first") != 1) | (F.col("last") != F.col("rows")) | (F.col("different") != F.col("rows")))


def overlapping(records: DataFrame, identity: list[str], *, start: str = "effective_from", end: str = "effective_to", ties: list[str]) -> DataFrame:
    """Rows that begin before the row ahead of them has ended. Ends are closed; an open end or start overlaps."""
    line = Window.partitionBy(*identity).orderBy(F.asc_nulls_first(start), *[F.asc_nulls_first(t) for t in ties])
    rows = records.withColumns({"_k": F.row_number().over(line), "_end": F.lag(end).over(line)})
    return rows.where((F.col("_k") > 1) & (F.col("_end").isNull() | F.col(start).isNull() | (F.col(start) <= F.col("_end")))).drop("_k", "_end")


def without_one_primary(records: DataFrame, provenance: DataFrame, key: str = "record_id") -> DataFrame:
    """Keys that have no primary source, or several."""
    n = provenance.groupBy(key).agg(F.count(F.when(F.col("is_primary"), 1)).alias("primary_count"))
    return records.select(key).distinct().join(n, key, "left").select(key, F.coalesce("primary_count", F.lit(0)).alias("primary_count")).where("primary_count <> 1")


def repeated(records: DataFrame, key: str) -> DataFrame:
    return records.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


def value_mismatches(records: DataFrame, values: list[str]) -> DataFrame:
    """Current items whose inherited values differ from their fraction's, null-safe."""
    current = records.where("is_current")
    parent = current.where("level = 'fraccion8'").select(F.col("code").alias("fraccion8"), "ligie_version", *[F.col(v).alias(f"_{v}") for v in values])
    differ = reduce(lambda a, b: a | b, (~F.col(v).eqNullSafe(F.col(f"_{v}")) for v in values))
    return current.where("level = 'nico10'").join(parent, ["fraccion8", "ligie_version"]).where(differ)


INHERITED = ["unit_code", "unit_name", "igi_text", "igi_kind", "igi_value", "ige_text", "ige_kind", "ige_value"]


def report(records: DataFrame, provenance: DataFrame, notes: DataFrame | None = None, applicability: DataFrame | None = None) -> dict[str, int]:
    """Every check's count. The records are read by several jobs, so a caller may cache them."""
    out = single_pass(records).first().asDict()
    identity = ["level", "code", "ligie_version"]
    out |= {
        "current_nico_without_parent": without_parent(records, "nico10", "fraccion8").count(),
        "fraction_without_hs6_parent": without_parent(records, "fraccion8", "hs6").count(),
        "hs6_without_hs4_parent": without_parent(records, "hs6", "hs4").count(),
        "hs4_without_hs2_parent": without_parent(records, "hs4", "hs2").count(),
        "non_contiguous_versions": non_contiguous(records, identity).count(),
        "overlapping_intervals": overlapping(records, identity, ties=["record_version"]).count(),
        "primary_source_count": without_one_primary(records, provenance).count(),
        "duplicate_current_records": repeated(records.where("is_current"), "code").count(),
        "nico_parent_value_mismatch": value_mismatches(records, INHERITED).count(),
    }
    if notes is not None and applicability is not None:
        out["national_note_applicability_cardinality"] = note_cardinality(notes, applicability).count()
    return {k: int(v) for k, v in out.items()}


def require(counts: dict[str, int]) -> None:
    if failed := {k: v for k, v in counts.items() if v}:
        raise ValidationError(f"invariants that don't hold: {failed}")
