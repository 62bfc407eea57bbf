"""Serving tables: releases partitioned by tag, and a pointer of one row that is switched last.

Parquet has no transactions: a tag's rows are written whole before the pointer names it, and readers go through the pointer. Pointers are
numbered and added, never overwritten, and the last whole one holds; so a stop at any time leaves the release active that was.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..storage import written


class PromotionError(ValueError):
    """A release that can't be served."""


def checked(records: DataFrame, *, expected: int | None = None) -> DataFrame:
    """Current records, one for each code; raises for none, for repeated codes, or for another number than expected."""
    current = records.where("is_current")
    n, different = current.agg(F.count("*"), F.count_distinct("code")).first()
    if not n or n != different or expected not in (None, n):
        raise PromotionError(f"{n} current records of {different} codes, expected {expected or 'some'}")
    return current


def promote(records: DataFrame, tag: str, root: str, *, generated_at: str, expected: int | None = None) -> None:
    """Adds the records that a tag doesn't have yet, then points to it. Doing it twice changes nothing."""
    spark = records.sparkSession
    current = checked(records, expected=expected).withColumn("release_tag", F.lit(tag))
    there = _exists(spark, f"{root}/records")
    if there:
        old = spark.read.parquet(f"{root}/records").where(F.col("release_tag") == tag)
        current = current.join(old.select("code"), "code", "left_anti")
    current.write.mode("append").partitionBy("release_tag").parquet(f"{root}/records")
    row = spark.createDataFrame([(tag, generated_at)], "release_tag string, generated_at string")
    known = _exists(spark, f"{root}/releases") and not spark.read.parquet(f"{root}/releases").where(F.col("release_tag") == tag).isEmpty()
    if not known:
        row.write.mode("append").parquet(f"{root}/releases")
    row.select("release_tag").coalesce(1).write.parquet(f"{root}/active/{max(_pointers(spark, root), default=0) + 1:010d}")


RELEASE = "release_tag string, dataset_version string, schema_version string, manifest_sha256 string, generated_at timestamp, published_at timestamp, source_checked_at timestamp, evidence_json string"
#: What makes two releases of one tag the same; only the evidence of a release may change.
SAME = ("dataset_version", "schema_version", "manifest_sha256")
EVIDENCE = ("source_documents", "record_provenance", "national_notes")
SHA256 = r"\A[0-9a-f]{64}\z"


def release_breaches() -> dict[str, Column]:
    """Conditions under which a release can't be served."""
    lists = [F.get_json_object("evidence_json", f"$.{k}") for k in EVIDENCE]
    wrong = reduce(lambda a, b: a | b, [x.isNotNull() & ~(x.rlike(r"\A\[") & F.coalesce(F.forall(F.from_json(x, "array<string>"), lambda i: i.rlike(r"\A\{")), F.lit(False))) for x in lists])
    return {
        "tag": ~F.coalesce(F.col("release_tag").rlike(r"\Adata-\d{4}\.\d{2}\.\d{2}\z"), F.lit(False)),
        "dataset_version": ~F.concat(F.lit("data-"), "dataset_version").eqNullSafe(F.col("release_tag")),
        "schema_version": F.coalesce(F.col("schema_version"), F.lit("")) == "",
        "manifest_sha256": ~F.coalesce(F.col("manifest_sha256").rlike(SHA256), F.lit(False)),
        "dates": F.col("generated_at").isNull() | F.col("published_at").isNull() | F.col("source_checked_at").isNull(),
        "evidence": F.json_object_keys("evidence_json").isNull() | wrong,
    }


def record_breaches() -> dict[str, Column]:
    """Conditions under which a record can't be served."""
    empty = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    return {
        "text": empty("code") | empty("level") | empty("description"), "record_hash": ~F.coalesce(F.col("record_hash").rlike(SHA256), F.lit(False)),
        "source_document_ids": F.coalesce(F.json_array_length("source_document_ids"), F.lit(0)) == 0, "payload": F.coalesce(F.json_object_keys("payload"), F.array().cast("array<string>")) == F.array().cast("array<string>"),
    }


def breaches(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """The rows that break a condition, with the names of those they break in ``breaches``."""
    names = F.array_compact(F.array(*[F.when(c, name) for name, c in conditions.items()]))
    return df.withColumn("breaches", names).where(F.size("breaches") > 0)


def merged_releases(held: DataFrame, new: DataFrame) -> DataFrame:
    """The table of releases after an upsert: its rows and ``outcome`` (kept, inserted, updated, unchanged, refused).

    A known tag takes the new evidence if version, schema and manifest are what they were, null-safe; otherwise it is refused and stays as it is.
    Both sides have one row a tag.
    """
    columns = F.struct(*[c for c in new.columns if c != "release_tag"])
    both = held.select("release_tag", columns.alias("o")).join(new.select("release_tag", columns.alias("n")), "release_tag", "full")
    same = reduce(lambda a, b: a & b, (F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}")) for c in SAME))
    equal = F.col("o.evidence_json").eqNullSafe(F.col("n.evidence_json"))
    outcome = F.when(F.col("n").isNull(), "kept").when(F.col("o").isNull(), "inserted").when(~same, "refused").when(equal, "unchanged").otherwise("updated")
    row = F.when(F.col("o").isNull(), F.col("n")).when(outcome == "updated", F.col("o").withField("evidence_json", F.col("n.evidence_json"))).otherwise(F.col("o"))
    return both.select("release_tag", row.alias("r"), outcome.alias("outcome")).select("release_tag", "r.*", "outcome")


def upsert_releases(new: DataFrame, root: str) -> DataFrame:
    """Puts releases into the table at ``root``, each tag a partition: only tags that are new or have new evidence are rewritten.

    Raises, and writes nothing, where a release breaks a guard, comes twice, or is refused. Doing it again changes nothing. Returns the outcomes.
    """
    spark, path = new.sparkSession, f"{root}/release_table"
    bad = breaches(new, release_breaches()).select("release_tag", "breaches").head(1)
    twice = new.groupBy("release_tag").count().where("count > 1").head(1)
    if bad or twice:
        raise PromotionError(f"a release that can't be served: {bad or twice}")
    columns = [c.split(" ")[0] for c in RELEASE.split(", ")]
    held = spark.read.schema(RELEASE).parquet(path) if _exists(spark, path) else spark.createDataFrame([], RELEASE)
    merged = written(merged_releases(held.select(columns), new.select(columns)))  # the table is read before it is written
    if refused := merged.where("outcome = 'refused'").select("release_tag").head(1):
        raise PromotionError(f"{refused[0].release_tag} is there with another version, schema or manifest")
    changed = merged.where("outcome IN ('inserted', 'updated')").drop("outcome")
    changed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("release_tag").parquet(path)
    return merged.where("outcome <> 'kept'").select("release_tag", "outcome")


def release_evidence(releases: DataFrame, kind: str) -> DataFrame:
    """The rows of one kind of evidence (source_documents, record_provenance, national_notes) of releases: ``release_tag``, ``position``, ``item`` (a map). A kind that isn't there has no rows."""
    listed = F.from_json(F.get_json_object("evidence_json", f"$.{kind}"), "array<map<string,string>>")
    return releases.select("release_tag", F.posexplode(listed).alias("position", "item"))


def record_evidence(releases: DataFrame) -> DataFrame:
    """Provenance of records with its documents, primary first: one join of two kinds of evidence of each release."""
    rows, documents = release_evidence(releases, "record_provenance"), release_evidence(releases, "source_documents")
    named = documents.select("release_tag", F.col("item")["source_document_id"].alias("source_document_id"), F.col("position").alias("_k"), F.col("item").alias("document"))
    last = named.withColumn("_n", F.row_number().over(Window.partitionBy("release_tag", "source_document_id").orderBy(F.desc("_k")))).where("_n = 1").drop("_n", "_k")
    of = rows.select("release_tag", F.col("item")["code"].alias("code"), F.col("item")["source_document_id"].alias("source_document_id"), F.col("item")["role"].alias("role"), F.coalesce(F.col("item")["is_primary"] == "true", F.lit(False)).alias("is_primary"))
    joined = of.join(last, ["release_tag", "source_document_id"])
    order = F.row_number().over(Window.partitionBy("release_tag", "code").orderBy(F.desc("is_primary"), "source_document_id", "role"))
    return joined.withColumn("rank", order)


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _pointers(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the pointers that are whole."""
    top = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/active")
    files = top.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(top):
        return []
    names = [f.getPath().getName() for f in files.listStatus(top)]
    return [int(n) for n in names if n.isdigit() and _exists(spark, f"{root}/active/{n}/_SUCCESS")]


def active_tag(spark: SparkSession, root: str) -> str:
    whole = _pointers(spark, root)
    if not whole:
        raise PromotionError("no release is active")
    return spark.read.parquet(f"{root}/active/{max(whole):010d}").first().release_tag


def active_records(spark: SparkSession, root: str) -> DataFrame:
    """Rows of the active release: the tag is read first, so only its partition is scanned."""
    return spark.read.parquet(f"{root}/records").where(F.col("release_tag") == active_tag(spark, root))


def latest_release(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/releases").orderBy(F.desc("generated_at"), F.desc("release_tag")).limit(1)


def public_record(records: DataFrame) -> DataFrame:
    """What is served of a record: rates only for eight-digit fractions."""
    rated = F.length("code") == 8
    rate = lambda side: F.struct(F.col(f"{side}_text").alias("text"), F.col(f"{side}_kind").alias("kind"), F.col(f"{side}_value").cast("double").alias("value"))
    return records.select("code", "level", "description", F.when(rated, rate("igi")).alias("igi"), F.when(rated, rate("ige")).alias("ige"))
