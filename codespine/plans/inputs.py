"""Inputs of the registered queries: code trees, revisions and literals derived from the benchmark tables.

Each shape has a DataFrame here and the same rule as SQL text, so that a query and its check start from equal rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.hierarchy import prefix_tree


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pad(c: Column, n: int = 2) -> Column:
    return F.lpad(c.cast("string"), n, "0")


def leaves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as ten-digit items: the code is a mixed-radix number of the key and the size."""
    k = F.col("p_partkey")
    code = F.concat(_pad(k % 98 + 1), _pad(F.col("p_size")), _pad(k % 7), _pad(k % 5), _pad(k % 3))
    return table(spark, sf_dir, "part").select(code.alias("code10"), "p_partkey", "p_name", "p_type", "p_brand", "p_retailprice")


LEAF_SQL = """leaf AS (SELECT lpad((p_partkey % 98 + 1)::VARCHAR, 2, '0') || lpad(p_size::VARCHAR, 2, '0') || lpad((p_partkey % 7)::VARCHAR, 2, '0')
    || lpad((p_partkey % 5)::VARCHAR, 2, '0') || lpad((p_partkey % 3)::VARCHAR, 2, '0') AS code10, p_partkey, p_name, p_type, p_brand, p_retailprice FROM part)"""


def tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``code``, ``level``, ``description``, ``n_parts`` of every prefix of the items."""
    return prefix_tree(leaves(spark, sf_dir), "code10", F.min(F.concat_ws(" ", "p_name", "p_type", "p_brand")).alias("description"), F.count("*").alias("n_parts"))


TREE_SQL = (
    LEAF_SQL
    + """, tree AS (SELECT left(code10, w) AS code, CASE w WHEN 2 THEN 'hs2' WHEN 4 THEN 'hs4' WHEN 6 THEN 'hs6' WHEN 8 THEN 'fraccion8' ELSE 'nico10' END AS level,
    min(p_name || ' ' || p_type || ' ' || p_brand) AS description, count(*) AS n_parts FROM leaf, (VALUES (2), (4), (6), (8), (10)) widths(w) GROUP BY ALL)"""
)


def classifications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as classification revisions: an interval of 400 days whose ends are open for some."""
    day = F.to_date("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("custkey"), F.col("o_orderstatus").alias("status"),
        F.when(F.col("o_orderkey") % 11 != 0, day).alias("valid_from"), F.when(F.col("o_orderkey") % 13 != 0, F.date_add(day, 400)).alias("valid_to"),
    )


CLASSIFICATION_SQL = """classification AS (SELECT o_orderkey AS k, o_custkey AS custkey, o_orderstatus AS status,
    CASE WHEN o_orderkey % 11 <> 0 THEN o_orderdate::DATE END AS valid_from, CASE WHEN o_orderkey % 13 <> 0 THEN o_orderdate::DATE + 400 END AS valid_to FROM orders)"""


def rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as rate revisions of 90 days."""
    day = F.to_date("l_shipdate")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("line"), F.col("l_suppkey").alias("suppkey"), F.col("l_partkey").alias("partkey"),
        F.when(F.col("l_linenumber") != 3, day).alias("valid_from"), F.when(F.col("l_linenumber") != 5, F.date_add(day, 90)).alias("valid_to"),
    )


RATE_SQL = """rate AS (SELECT l_orderkey AS k, l_linenumber AS line, l_suppkey AS suppkey, l_partkey AS partkey,
    CASE WHEN l_linenumber <> 3 THEN l_shipdate::DATE END AS valid_from, CASE WHEN l_linenumber <> 5 THEN l_shipdate::DATE + 90 END AS valid_to FROM lineitem)"""

LITERALS = ("10%", " Ex. ", "Prohibida", "0.36 USD/Kg", "10%  +  0.36 USD/Kg", "según decreto", "12,5", "Exenta")


def duty_text(k: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, LITERALS)), (k % len(LITERALS) + 1).cast("int"))


def duty_sql(k: str) -> str:
    return f"list_extract({list(LITERALS)!r}, ({k} % {len(LITERALS)} + 1)::INT)"


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tree as public records, with breaches of every invariant at places that the code's number gives."""
    k, n = F.col("code").cast("bigint"), F.length("code")
    at = lambda by, rest: k % by == rest
    head = lambda w: F.when(n >= w, F.substring("code", 1, w))
    kind = F.when(n >= 8, F.element_at(F.array(*map(F.lit, ("ad_valorem", "exento", "prohibida", "especifica"))), (k % 4 + 1).cast("int")))
    start = F.when(~at(11, 0), F.date_add(F.lit("2020-01-01").cast("date"), (k % 400).cast("int")))
    return tree(spark, sf_dir).select(
        F.when(at(97, 5), F.concat(F.lit("r"), (k % 7).cast("string"))).otherwise(F.concat(F.lit("r-"), "code")).alias("record_id"), "code", "level",
        F.when(at(89, 3), "  ").otherwise(F.col("description")).alias("description"), head(2).alias("hs2"),
        F.when(at(101, 7) & (n >= 4), "9999").otherwise(head(4)).alias("hs4"), head(6).alias("hs6"), head(8).alias("fraccion8"), head(10).alias("nico10"),
        F.when(n == 10, F.substring("code", 9, 2)).alias("nico2"), F.when(~at(103, 1), F.concat(F.lit("v"), (k % 100 % 2).cast("string"))).alias("ligie_version"),
        F.lit("d1").alias("dataset_version"), F.lit("2").alias("schema_version"), (k % 10 != 9).alias("is_current"),
        F.when((n >= 8) & at(53, 2), "hs6").when((n >= 8) & ~at(59, 4), "fraccion8").when((n < 8) & at(61, 8), "hs4").alias("values_from_level"),
        F.when(n >= 8, F.concat(F.lit("u"), (k % 3).cast("string"))).alias("unit_code"), kind.alias("igi_text"), kind.alias("igi_kind"),
        F.when((kind == "ad_valorem") | at(73, 2), F.lit("1.5").cast("decimal(18,6)")).alias("igi_value"),
        *[F.lit(None).cast("string").alias(c) for c in ("ige_text", "ige_kind")], F.lit(None).cast("decimal(18,6)").alias("ige_value"),
        start.alias("effective_from"), F.date_add(start, (100 - k % 130).cast("int")).alias("effective_to"),
        F.lit('["a","b"]').alias("source_document_ids_json"), F.when(at(71, 6), 3).otherwise(2).cast("bigint").alias("source_count"),
        F.when(at(83, 2), " ").otherwise("DOF").alias("primary_source_authority"), F.lit("https://example.org/a").alias("primary_source_url"),
        F.when(~at(67, 3), F.lit("2024-01-01").cast("date")).alias("updated_at"),
    )


RECORDS_SQL = (
    TREE_SQL
    + """, numbered AS (SELECT *, code::BIGINT AS k, length(code) AS n, CASE WHEN length(code) >= 8 THEN list_extract(['ad_valorem', 'exento', 'prohibida', 'especifica'], (code::BIGINT % 4 + 1)::INT) END AS kind,
    CASE WHEN code::BIGINT % 11 <> 0 THEN DATE '2020-01-01' + (code::BIGINT % 400)::INT END AS start FROM tree),
  records AS (SELECT CASE WHEN k % 97 = 5 THEN 'r' || (k % 7) ELSE 'r-' || code END AS record_id, code, level, CASE WHEN k % 89 = 3 THEN '  ' ELSE description END AS description, left(code, 2) AS hs2,
    CASE WHEN n >= 4 THEN CASE WHEN k % 101 = 7 THEN '9999' ELSE left(code, 4) END END AS hs4, CASE WHEN n >= 6 THEN left(code, 6) END AS hs6, CASE WHEN n >= 8 THEN left(code, 8) END AS fraccion8,
    CASE WHEN n = 10 THEN code END AS nico10, CASE WHEN n = 10 THEN right(code, 2) END AS nico2, CASE WHEN k % 103 <> 1 THEN 'v' || (k % 100 % 2) END AS ligie_version, 'd1' AS dataset_version, '2' AS schema_version,
    k % 10 <> 9 AS is_current, CASE WHEN n >= 8 AND k % 53 = 2 THEN 'hs6' WHEN n >= 8 AND k % 59 <> 4 THEN 'fraccion8' WHEN n < 8 AND k % 61 = 8 THEN 'hs4' END AS values_from_level,
    CASE WHEN n >= 8 THEN 'u' || (k % 3) END AS unit_code, kind AS igi_text, kind AS igi_kind, CASE WHEN kind = 'ad_valorem' OR k % 73 = 2 THEN 1.5::DECIMAL(18, 6) END AS igi_value,
    NULL::VARCHAR AS ige_text, NULL::VARCHAR AS ige_kind, NULL::DECIMAL(18, 6) AS ige_value, start AS effective_from, start + (100 - k % 130)::INT AS effective_to, '["a","b"]' AS source_document_ids_json,
    CASE WHEN k % 71 = 6 THEN 3 ELSE 2 END AS source_count, CASE WHEN k % 83 = 2 THEN ' ' ELSE 'DOF' END AS primary_source_authority, 'https://example.org/a' AS primary_source_url,
    CASE WHEN k % 67 <> 3 THEN DATE '2024-01-01' END AS updated_at FROM numbered)"""
)
