"""Reports: coverage, recall, comparison with a third party, evidence, provenance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def coverage(codes: DataFrame, known_missing: DataFrame) -> DataFrame:
    """Eight-digit codes with and without ten-digit descendants, one row; ``known_missing``: codes whose gap is explained."""
    fractions = codes.where(F.length("code") == 8).select("code").distinct()
    below = codes.where(F.length("code") == 10).select(F.substring("code", 1, 8).alias("code"), F.lit(True).alias("has")).distinct()
    known = known_missing.select("code", F.lit(True).alias("known")).distinct()
    rows = fractions.join(below, "code", "left").join(known, "code", "left")
    gap, seen = F.col("has").isNull(), F.col("known").isNotNull()
    n = lambda c: F.count(F.when(c, 1))
    return rows.agg(
        F.count("*").alias("fraccion8"), n(~gap).alias("with_nico_descendant"), n(gap).alias("missing_nico_descendant"),
        n(gap & seen).alias("known_upstream_lag"), n(gap & ~seen).alias("unclassified_missing"),
    )


def uncovered(codes: DataFrame) -> DataFrame:
    below = codes.where(F.length("code") == 10).select(F.substring("code", 1, 8).alias("code"))
    return codes.where(F.length("code") == 8).select("code").distinct().join(below, "code", "left_anti")


def top_k_recall(cases: DataFrame, predictions: DataFrame, *, top_k: int) -> DataFrame:
    """Coverage, recall and selective recall of ranked candidates, one row. Raises unless each case has one prediction.

    ``cases``: case_id, gold; ``predictions``: case_id, candidates, abstained.
    """
    if isinstance(top_k, bool) or not isinstance(top_k, int) or top_k <= 0:
        raise ValueError("top_k is a positive whole number")
    sides = cases.select("case_id", F.lit(1).alias("c"), F.lit(0).alias("p")).union(predictions.select("case_id", F.lit(0), F.lit(1)))
    if not sides.groupBy("case_id").agg(F.sum("c").alias("c"), F.sum("p").alias("p")).where("c <> 1 or p <> 1").isEmpty():
        raise ValueError("each case has exactly one prediction")
    return recall_row(cases.join(predictions, "case_id"), top_k)


def recall_row(answers: DataFrame, top_k: int) -> DataFrame:
    answered = ~F.col("abstained")
    hit = answered & F.array_contains(F.slice("candidates", 1, top_k), F.col("gold"))
    n = lambda c: F.count(F.when(c, 1))
    counted = answers.agg(F.count("*").alias("total_cases"), n(answered).alias("answered_cases"), n(hit).alias("hits"))
    return counted.select(
        "total_cases", "answered_cases", (F.col("total_cases") - F.col("answered_cases")).alias("abstentions"),
        (F.col("answered_cases") / F.col("total_cases")).alias("coverage"), (F.col("hits") / F.col("total_cases")).alias("top_k_recall"),
        F.when(F.col("answered_cases") > 0, F.col("hits") / F.col("answered_cases")).otherwise(0.0).alias("selective_top_k_recall"),
    )


def field_comparison(ours: DataFrame, theirs: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """One row for each key and field with both values and ``match``; keys that they lack have one row, ``present``."""
    b = theirs.select(key, *[F.col(f).cast("string").alias(f"_{f}") for f in fields], F.lit(True).alias("_there"))
    both = ours.select(key, *[F.col(f).cast("string").alias(f) for f in fields]).join(b, key, "left")
    some = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("ours"), F.col(f"_{f}").alias("theirs"), F.col(f).eqNullSafe(F.col(f"_{f}")).alias("match")) for f in fields])
    none = F.array(F.struct(F.lit("present").alias("field"), F.lit("yes").alias("ours"), F.lit(None).cast("string").alias("theirs"), F.lit(False).alias("match")))
    return both.select(key, F.explode(F.when(F.col("_there"), some).otherwise(none)).alias("r")).select(key, "r.*")


def first_of_each(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key. Rows beyond it are dropped in each task before the shuffle."""
    return rows.withColumn("_k", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_k = 1").drop("_k")


def latest_unique(rows: DataFrame, keys: list[str], day: str) -> DataFrame:
    """``keys``, latest ``day``, ``n`` rows that have it, ``undated`` rows, and ``is_unique``: whether one document is the current one."""
    last = rows.groupBy(*keys).agg(F.max(day).alias("latest"), F.count("*").alias("rows"), F.count(F.when(F.col(day).isNull(), 1)).alias("undated"))
    n = rows.where(F.col(day).isNotNull()).groupBy(*keys, day).agg(F.count("*").alias("n")).withColumnRenamed(day, "latest")
    both = last.join(n, [*keys, "latest"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return both.withColumn("is_unique", (F.col("rows") == 1) | ((F.col("undated") == 0) & (F.col("n") == 1)))


def provenance(records: DataFrame, links: DataFrame, documents: DataFrame) -> DataFrame:
    """Sources of each record: primary first, then by id and role; ``links``: record_id, source_document_id, role, is_primary."""
    order = Window.partitionBy("record_id").orderBy(F.desc("is_primary"), "source_document_id", "role")
    return records.select("record_id").join(links, "record_id").join(documents, "source_document_id").withColumn("position", F.row_number().over(order))


#: Links that one task tells apart and orders.
LINKS_AT_ONCE = 250_000


def distinct_links(links: DataFrame) -> DataFrame:
    """Each link once. Links hardly repeat, so they are dealt out by record before they are told apart, and by their number: exchanges are sized by
    their compressed bytes otherwise, which says little of what rows take in memory. What follows by record needs no further exchange of them.
    """
    return links.repartition(max(1, -(-links.count() // LINKS_AT_ONCE)), "record_id").distinct()


def provenance_lists(links: DataFrame, key: str, source: str) -> DataFrame:
    """Distinct sources of each record as a sorted JSON list, and their number."""
    ids = F.array_sort(F.collect_set(source))
    return links.groupBy(key).agg(F.to_json(ids).alias("source_document_ids_json"), F.size(ids).cast("long").alias("source_count"))


def reconciliation(required: DataFrame, evidence: DataFrame) -> DataFrame:
    """Discrepancies: required (role, day) without evidence of that role and day."""
    lacking = required.join(evidence, ["role", "day"], "left_anti")
    return lacking.select(F.concat_ws(":", F.lit("missing_dof_evidence"), "role", F.coalesce(F.col("day").cast("string"), F.lit("None"))).alias("discrepancy"))


def discrepancy_report(found: DataFrame, by: str) -> DataFrame:
    """``by``, ``publishable``, ``error_codes`` (each once, sorted) and ``n`` for each group of ``found`` (``by``, ``discrepancy``; a null is none).

    The codes are few kinds, so sets stay small however many discrepancies a group has.
    """
    code = F.split_part("discrepancy", F.lit(":"), F.lit(1))
    rows = found.groupBy(by).agg(F.count("discrepancy").alias("n"), F.array_sort(F.collect_set(F.when(F.col("discrepancy").isNotNull(), code))).alias("error_codes"))
    return rows.select(by, (F.col("n") == 0).alias("publishable"), "error_codes", "n")


#: Severity of check results.
SEVERITY = ("pass", "warn", "fail")


def rollup(checks: DataFrame) -> DataFrame:
    """The worst status."""
    names = F.array(*map(F.lit, SEVERITY))
    return checks.agg(F.element_at(names, F.max(F.array_position(names, F.col("status"))).cast("int")).alias("status"))


def eligible_releases(releases: DataFrame) -> DataFrame:
    """Published releases (neither ``draft`` nor ``prerelease``) whose ``tag`` names a day, with that ``day``."""
    day = F.try_to_date(F.regexp_extract("tag", r"\A(?:data-)?(\d{4}\.\d{2}\.\d{2})\z", 1), "yyyy.MM.dd")
    return releases.where(~F.col("draft") & ~F.col("prerelease")).withColumn("day", day).where("day is not null")


def newest_release(releases: DataFrame) -> DataFrame:
    """The eligible release with the latest day (ties: the greatest tag), one row or none."""
    return eligible_releases(releases).orderBy(F.desc("day"), F.desc("tag")).limit(1)


def over_budget(errors: DataFrame, budget: DataFrame) -> DataFrame:
    """``code``, ``n``, ``allowed`` of the error codes that come up more often than ``budget`` (code, allowed) lets them; codes without one have none."""
    n = errors.groupBy("code").agg(F.count("*").alias("n"))
    return n.join(budget, "code", "left").select("code", "n", F.coalesce("allowed", F.lit(0)).cast("long").alias("allowed")).where("n > allowed")
