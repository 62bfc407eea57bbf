"""Registered queries on whole records, releases and ledgers, and the same results as DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import hashing, messages, text, trade
from ..operators import cards, certify, compare, consolidate, diff, evaluate, hierarchy, search_index, validate
from ..sources import html, layouts, ledgers, pages, thirdparty
from ..storage import shared_dir
from . import inputs, serving
from .inputs import CLASSIFICATION_SQL, RATE_SQL, RECORDS_SQL, TREE_SQL, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def _query(sql: str) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return add


_CHECKS_SQL = {
    "missing_required_values": "trim(coalesce(description, '')) = '' OR ligie_version IS NULL OR dataset_version IS NULL OR schema_version IS NULL OR trim(coalesce(primary_source_authority, '')) = '' OR trim(coalesce(primary_source_url, '')) = ''",
    "invalid_hierarchy": "hs2 <> left(code, 2) OR hs4 <> left(code, 4) OR hs6 <> left(code, 6) OR fraccion8 <> left(code, 8) OR (nico10 IS NOT NULL AND (nico10 <> code OR nico2 <> right(code, 2)))",
    "reversed_intervals": "effective_from > effective_to", "provenance_count_mismatch": "source_count <> json_array_length(source_document_ids_json)",
    "invalid_duty_values": "(igi_kind IN ('prohibida', 'especifica', 'compuesta', 'desconocida') AND igi_value IS NOT NULL) OR (ige_kind IN ('prohibida', 'especifica', 'compuesta', 'desconocida') AND ige_value IS NOT NULL)",
    "invalid_value_origin": "(level IN ('hs2', 'hs4', 'hs6') AND (values_from_level IS NOT NULL OR unit_code IS NOT NULL OR igi_text IS NOT NULL OR ige_text IS NOT NULL)) OR (level IN ('fraccion8', 'nico10') AND values_from_level <> 'fraccion8')",
    "missing_public_metadata": "updated_at IS NULL OR ligie_version IS NULL OR dataset_version IS NULL OR schema_version IS NULL",
}


@_query(f"WITH {RECORDS_SQL} SELECT count(*) - count(DISTINCT record_id) AS duplicate_record_ids, " + ", ".join(f"count(*) FILTER ({c}) AS {n}" for n, c in _CHECKS_SQL.items()) + " FROM records")
def release_gates(spark: SparkSession, d: str) -> DataFrame:
    counts = validate.written_with_counts(inputs.records(spark, d), shared_dir(spark))
    return spark.createDataFrame([tuple(counts.values())], ", ".join(f"{n} bigint" for n in counts))


@_query(f"WITH {RECORDS_SQL}, current AS (SELECT * FROM records WHERE is_current) " + " UNION ALL ".join(
    f"SELECT '{name}' AS \"check\", code FROM current c WHERE level = '{level}' AND NOT EXISTS (SELECT 1 FROM current p WHERE p.level = '{up}' AND p.code = c.{up} AND p.ligie_version = c.ligie_version)" for name, (level, up) in validate.PARENT_CHECKS.items()))
def records_without_parent(spark: SparkSession, d: str) -> DataFrame:
    return validate.without_parents(inputs.records(spark, d)).select("check", "code")


@_query(f"WITH {RECORDS_SQL} SELECT fraccion8, count(*) AS n FROM records WHERE is_current AND fraccion8 IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
def current_repeats(spark: SparkSession, d: str) -> DataFrame:
    return validate.repeated(inputs.records(spark, d).where("is_current AND fraccion8 IS NOT NULL"), "fraccion8")


@_query(f"""WITH {RECORDS_SQL}, current AS (SELECT * FROM records WHERE is_current) SELECT n.code FROM current n JOIN current f ON f.level = 'fraccion8' AND f.code = n.fraccion8 AND f.ligie_version = n.ligie_version
  WHERE n.level = 'nico10' AND (n.unit_code IS DISTINCT FROM f.unit_code OR n.igi_text IS DISTINCT FROM f.igi_text OR n.igi_kind IS DISTINCT FROM f.igi_kind OR n.igi_value IS DISTINCT FROM f.igi_value)""")
def parent_value_mismatch(spark: SparkSession, d: str) -> DataFrame:
    return validate.value_mismatches(inputs.records(spark, d), ["unit_code", "igi_text", "igi_kind", "igi_value"]).select("code")


@_query("""WITH a AS (SELECT l_orderkey AS v FROM lineitem WHERE l_linenumber <= 2) SELECT o_orderkey AS national_note_version_id, count(a.v) AS n FROM orders LEFT JOIN a ON a.v = o_orderkey GROUP BY 1 HAVING count(a.v) <> 1""")
def note_cardinality(spark: SparkSession, d: str) -> DataFrame:
    applies = table(spark, d, "lineitem").where("l_linenumber <= 2").select(F.col("l_orderkey").alias("national_note_version_id"), F.col("l_partkey").alias("applicability_id"))
    return validate.note_cardinality(table(spark, d, "orders").select(F.col("o_orderkey").alias("national_note_version_id")), applies)


_TEXT = "Réd widget small"


def search_indexed(spark: SparkSession, d: str) -> DataFrame:
    nodes = inputs.tree(spark, d).withColumn("folded", text.fold("description"))
    return search_index.search(search_index.build(nodes, shared_dir(spark)), _TEXT, limit=50).select("code", "description", "level", "score", "match_kind", "confidence")


def _json(columns: dict[str, str]) -> str:
    return "{" + ", ".join(f"{k}: {v}" for k, v in columns.items()) + "}"


_RECORD = _json({"code": "p.code", "level": "p.level", "description": "p.description"})
_SECTIONS = ", ".join(f"('{r}', '{t}', '{a:02d}', '{b:02d}')" for r, t, a, b in hierarchy.SECTIONS)
_NOTES_SQL = "notes AS (SELECT lpad((doc_id % 97 + 1)::VARCHAR, 2, '0') AS chapter, (doc_id // 97 + 1)::VARCHAR AS note_number, lang AS text, source AS source_document_id FROM documents WHERE doc_id < 970)"
_CARDS_SQL = f"""current AS (SELECT * FROM records WHERE is_current), sections(roman, title, a, b) AS (VALUES {_SECTIONS}), {_NOTES_SQL},
  chain AS (SELECT c.code, to_json(list({_RECORD} ORDER BY p.code)) AS hierarchy_json, count(*) AS n FROM current c JOIN current p ON length(p.code) <= length(c.code) AND left(c.code, length(p.code)) = p.code GROUP BY c.code),
  below AS (SELECT left(p.code, length(p.code) - 2) AS code, to_json(list({_RECORD} ORDER BY p.code)) AS children_json FROM current p WHERE length(p.code) > 2 GROUP BY 1),
  listed AS (SELECT chapter, to_json(list({{note_number: note_number, text: text, source_document_id: source_document_id}} ORDER BY note_number, source_document_id)) AS notes_json FROM notes GROUP BY 1),
  cards AS (SELECT c.code, s.roman AS section, n = length(c.code) // 2 AS complete, hierarchy_json::VARCHAR AS hierarchy_json, coalesce(children_json::VARCHAR, '[]') AS children_json, coalesce(notes_json::VARCHAR, '[]') AS notes_json
    FROM current c JOIN chain USING (code) LEFT JOIN below USING (code) LEFT JOIN sections s ON left(c.code, 2) BETWEEN s.a AND s.b LEFT JOIN listed ON listed.chapter = left(c.code, 2))"""


def _notes(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("doc_id")
    return table(spark, d, "documents").where(k < 970).select(F.lpad((k % 97 + 1).cast("string"), 2, "0").alias("chapter"), F.floor(k / 97 + 1).cast("string").alias("note_number"), F.col("lang").alias("text"), F.col("source").alias("source_document_id"))


def _json_cards(df: DataFrame) -> list:
    as_json = lambda c: F.to_json(c, {"ignoreNullFields": "false"})
    return ["code", F.col("section.roman").alias("section"), "complete", as_json("hierarchy").alias("hierarchy_json"), as_json("children").alias("children_json"), as_json("national_notes").alias("notes_json")]


@_query(f"WITH {RECORDS_SQL}, {_CARDS_SQL} SELECT * FROM cards WHERE length(code) = 8")
def card_records(spark: SparkSession, d: str) -> DataFrame:
    rows = inputs.records(spark, d)
    found = cards.record_cards(rows, rows.where("level = 'fraccion8'").select("code"), notes=_notes(spark, d))
    return found.select(*_json_cards(found))


_FOLD = "trim(regexp_replace(replace(lower(strip_accents(description)), 'ß', 'ss'), '\\s+', ' ', 'g'))"
_TOKENS = text.folded(_TEXT).split()


@_query(f"""WITH {RECORDS_SQL}, {_CARDS_SQL}, m AS (SELECT *, {" + ".join(f"contains({_FOLD}, '{t}')::INT" for t in _TOKENS)} AS m FROM current), scored AS (SELECT code, description, 300 + 25 * m + CASE WHEN m = {len(_TOKENS)} THEN 5 ELSE 0 END AS score FROM m WHERE m > 0),
  best AS (SELECT *, max(score) OVER (PARTITION BY left(code, 2)) AS best, max(length(code) = 8) OVER () AS any_fraction FROM scored), top AS (SELECT row_number() OVER (ORDER BY best DESC, score DESC, code, description)::INT AS rank, code, score FROM best WHERE length(code) = 8 OR NOT any_fraction)
  SELECT rank, score, '{cards.DISCLAIMER}' AS disclaimer, cards.* FROM top JOIN cards USING (code) WHERE rank <= 5""")
def suggest_cards(spark: SparkSession, d: str) -> DataFrame:
    rows = inputs.records(spark, d).withColumn("folded", text.fold("description"))
    found = cards.suggestions(rows, _TEXT, limit=5, notes=_notes(spark, d))
    return found.select("rank", "score", "disclaimer", *_json_cards(found))


@_query(f"""WITH {CLASSIFICATION_SQL}, {RATE_SQL} SELECT c.custkey, c.k, r.k AS rate_k, r.line, r.suppkey, r.partkey, greatest(c.valid_from, r.valid_from) AS valid_from, least(c.valid_to, r.valid_to) AS valid_to
  FROM classification c JOIN rate r ON c.k % 50 = r.k % 50 AND r.line = 1 AND c.status = 'P' WHERE greatest(c.valid_from, r.valid_from) IS NULL OR least(c.valid_to, r.valid_to) IS NULL OR greatest(c.valid_from, r.valid_from) <= least(c.valid_to, r.valid_to)""")
def interval_hot_keys(spark: SparkSession, d: str) -> DataFrame:
    left = inputs.classifications(spark, d).where("status = 'P'").withColumn("g", F.col("k") % 50)
    right = inputs.rates(spark, d).where("line = 1").withColumn("g", F.col("k") % 50).withColumnRenamed("k", "rate_k")
    return consolidate.bucketed_interval_join(left, right, ["g"], days=120).select("custkey", "k", "rate_k", "line", "suppkey", "partkey", "valid_from", "valid_to")


@_query("""WITH a AS (SELECT o_orderkey::VARCHAR AS o_orderkey, o_orderstatus, o_totalprice::DECIMAL(18, 2)::VARCHAR AS o_totalprice FROM orders), b AS (
    SELECT o_orderkey::VARCHAR AS o_orderkey, CASE WHEN o_orderkey % 500 = 3 THEN 'X' WHEN o_orderkey % 500 = 4 THEN NULL ELSE o_orderstatus END AS o_orderstatus, o_totalprice::DECIMAL(18, 2)::VARCHAR AS o_totalprice FROM orders WHERE o_orderkey % 700 <> 1
    UNION ALL SELECT o_orderkey::VARCHAR, o_orderstatus, o_totalprice::DECIMAL(18, 2)::VARCHAR FROM orders WHERE o_orderkey % 900 = 2),
  n AS (SELECT o_orderkey, o_orderstatus, o_totalprice, sum(s) AS s FROM (SELECT *, 1 AS s FROM a UNION ALL SELECT *, -1 FROM b) GROUP BY ALL)
  SELECT CASE WHEN s > 0 THEN 'left' ELSE 'right' END AS side, o_orderkey, o_orderstatus, o_totalprice, abs(s)::BIGINT AS times FROM n WHERE s <> 0""")
def artefact_differences(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    rows = table(spark, d, "orders").select(k, "o_orderstatus", F.col("o_totalprice").cast("decimal(18,2)").alias("o_totalprice"))
    other = rows.where(k % 700 != 1).withColumn("o_orderstatus", F.when(k % 500 == 3, "X").when(k % 500 != 4, F.col("o_orderstatus"))).unionByName(rows.where(k % 900 == 2))
    return diff.differences(rows, other, rows.columns)


_CATEGORIES = [*diff.EVENT_OF, "unknown"]
_DOCUMENT = f"SELECT o_orderkey AS position, list_extract({_CATEGORIES!r}, (o_custkey % {len(_CATEGORIES)} + 1)::INT) AS category, (o_custkey % 40)::VARCHAR AS ordinal, '  Decree ' || o_orderstatus || '  ' || (o_custkey % 9) AS title"


@_query(f"""WITH a AS ({_DOCUMENT}, o_orderpriority AS kind FROM orders WHERE o_orderkey % 11 <> 0), b AS ({_DOCUMENT}, CASE WHEN o_orderkey % 50 = 7 THEN 'changed' ELSE o_orderpriority END AS kind FROM orders WHERE o_orderkey % 13 <> 0),
  x AS (SELECT *, trim(regexp_replace(title, '\\s+', ' ', 'g')) AS key FROM a QUALIFY row_number() OVER (PARTITION BY category, ordinal, key ORDER BY position DESC) = 1), y AS (SELECT *, trim(regexp_replace(title, '\\s+', ' ', 'g')) AS key FROM b QUALIFY row_number() OVER (PARTITION BY category, ordinal, key ORDER BY position DESC) = 1),
  c AS (SELECT category, ordinal, key, coalesce(y.title, x.title) AS title FROM x FULL JOIN y USING (category, ordinal, key) WHERE x.position IS NULL OR y.position IS NULL OR x.title <> y.title OR x.kind IS DISTINCT FROM y.kind),
  e AS (SELECT CASE category {" ".join(f"WHEN '{c}' THEN '{v}'" for c, v in diff.EVENT_OF.items())} ELSE '{diff.UNKNOWN_EVENT}' END AS event_type, category || ':' || ordinal || ':' || title AS detail, 0 AS rank FROM c)
  SELECT * FROM e UNION ALL SELECT * FROM (VALUES ('ligie_reform_changed', 'displayed law reform date', 1)) v(event_type, detail, rank) WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.event_type = v.event_type)""")
def ledger_events(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    category = F.element_at(F.array(*map(F.lit, _CATEGORIES)), (F.col("o_custkey") % len(_CATEGORIES) + 1).cast("int"))
    rows = table(spark, d, "orders").select(k.alias("position"), category.alias("category"), (F.col("o_custkey") % 40).cast("string").alias("ordinal"), F.concat(F.lit("  Decree "), "o_orderstatus", F.lit("  "), (F.col("o_custkey") % 9).cast("string")).alias("title"), F.col("o_orderpriority").alias("kind"))
    at = F.col("position")
    after = rows.where(at % 13 != 0).withColumn("kind", F.when(at % 50 == 7, "changed").otherwise(F.col("kind")))
    shown = spark.createDataFrame([("2025-12-29", "2026-04-23"), ("2026-01-02", "2026-04-23")], "last_law_reform string, latest_tariff_modification string")
    found = diff.ledger_changes(rows.where(at % 11 != 0), after, ["kind"], dates_before=shown.where("last_law_reform < '2026'"), dates_after=shown.where("last_law_reform > '2026'"))
    return found.select("event_type", "detail", F.col("position.rank").alias("rank"))


_RELEASES = """SELECT 'data-' || o_orderkey AS release_tag, o_orderkey::VARCHAR AS dataset_version, {schema} AS schema_version, o_orderstatus AS manifest_sha256, o_orderdate::TIMESTAMP AS generated_at, o_orderdate::TIMESTAMP AS published_at, o_orderdate::TIMESTAMP AS source_checked_at, {evidence} AS evidence_json FROM orders WHERE {where}"""


@_query(f"""WITH o AS ({_RELEASES.format(schema="'2'", evidence="o_orderpriority", where="o_orderkey % 3 <> 0")}), n AS ({_RELEASES.format(schema="CASE WHEN o_orderkey % 10 = 2 THEN '3' WHEN o_orderkey % 14 = 0 THEN NULL ELSE '2' END", evidence="CASE WHEN o_orderkey % 4 = 0 THEN 'new' ELSE o_orderpriority END", where="o_orderkey % 2 = 0")})
  SELECT release_tag, CASE WHEN o.dataset_version IS NULL THEN n.schema_version ELSE o.schema_version END AS schema_version, CASE WHEN o.dataset_version IS NULL THEN n.evidence_json WHEN n.dataset_version IS NOT NULL AND o.schema_version IS NOT DISTINCT FROM n.schema_version THEN n.evidence_json ELSE o.evidence_json END AS evidence_json,
    CASE WHEN n.dataset_version IS NULL THEN 'kept' WHEN o.dataset_version IS NULL THEN 'inserted' WHEN o.schema_version IS DISTINCT FROM n.schema_version THEN 'refused' WHEN o.evidence_json = n.evidence_json THEN 'unchanged' ELSE 'updated' END AS outcome FROM o FULL JOIN n USING (release_tag)""")
def release_upsert(spark: SparkSession, d: str) -> DataFrame:
    k, day = F.col("o_orderkey"), F.col("o_orderdate").cast("timestamp")

    def releases(schema, evidence) -> DataFrame:
        return table(spark, d, "orders").select(k, F.concat(F.lit("data-"), k.cast("string")).alias("release_tag"), k.cast("string").alias("dataset_version"), schema.alias("schema_version"), F.col("o_orderstatus").alias("manifest_sha256"), *[day.alias(c) for c in ("generated_at", "published_at", "source_checked_at")], evidence.alias("evidence_json"))

    held = releases(F.lit("2"), F.col("o_orderpriority")).where(k % 3 != 0).drop("o_orderkey")
    new = releases(F.when(k % 10 == 2, "3").when(k % 14 != 0, "2"), F.when(k % 4 == 0, "new").otherwise(F.col("o_orderpriority"))).where(k % 2 == 0).drop("o_orderkey")
    return serving.merged_releases(held, new).select("release_tag", "schema_version", "evidence_json", "outcome")


_EVIDENCE = """'{"source_documents": [{"source_document_id": "s' || (o_custkey % 5) || '", "url": "u' || (o_custkey % 5) || '"}, {"source_document_id": "t"}], "record_provenance": [{"code": "' || (o_orderkey % 30) || '", "source_document_id": "s' || (o_custkey % 6) || '", "role": "b", "is_primary": false}, {"code": "' || (o_orderkey % 30) || '", "source_document_id": "t", "role": "a", "is_primary": true}]}'"""


@_query("""WITH p AS (SELECT o_orderkey, (o_orderkey % 30)::VARCHAR AS code, unnest([{s: 's' || (o_custkey % 6), role: 'b', p: false, ok: o_custkey % 6 = o_custkey % 5}, {s: 't', role: 'a', p: true, ok: true}]) AS x, o_custkey FROM orders)
  SELECT 'data-' || o_orderkey AS release_tag, code, x.s AS source_document_id, x.role AS role, x.p AS is_primary, CASE WHEN x.s <> 't' THEN 'u' || (o_custkey % 5) END AS url, row_number() OVER (PARTITION BY o_orderkey, code ORDER BY x.p DESC, x.s, x.role)::INT AS rank FROM p WHERE x.ok""")
def release_evidence(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").select(F.expr("concat('data-', o_orderkey)").alias("release_tag"), F.expr(_EVIDENCE).alias("evidence_json"))
    return serving.record_evidence(rows).select("release_tag", "code", "source_document_id", "role", "is_primary", F.col("document")["url"].alias("url"), "rank")


@_query(f"WITH {TREE_SQL}, f AS (SELECT p.code, p.level, p.description FROM tree p WHERE left(p.code, length(p.code) - 2) = (SELECT min(code) FROM tree WHERE length(code) = 4)) SELECT * FROM f")
def children_of(spark: SparkSession, d: str) -> DataFrame:
    nodes = inputs.tree(spark, d)
    first = nodes.where(F.length("code") == 4).agg(F.min("code")).first()[0]
    return hierarchy.children(nodes, first).select("code", "level", "description")


@_query(f"WITH {RECORDS_SQL} SELECT code, description FROM records WHERE level = 'hs2' AND is_current")
def chapter_list(spark: SparkSession, d: str) -> DataFrame:
    return hierarchy.chapters(inputs.records(spark, d)).select("code", "description")


_HEADS = (
    ("Fracción", "Descripción", "UMT", "IMPORT.", "EXPORT."), ("FRACCION ARANCELARIA", "DESCRIPCION", "", "TASA", ""), ("Fracción", "Descripción", "Unidad", "Tasa", "Tasa"),
    ("FRACCION", "FRACCION", "DESCRIPCION", "IGI", "IGE"), ("a", "b", "c", "d", "e"),
)
_BELOW = (("01012101", "x", "Kg", "10", "Ex."), ("", "", "", "Imp", "Exp"), ("", "", "", "x", "y"), ("01012101", "01", "x", "10", "Ex."), ("01012101", "x", "Kg", "10", "Ex."))
_LAYOUT = ((5, 2, 3, "ok"), (4, 2, 4, "ok"), (None, None, None, "unresolved"), (None, None, None, "ambiguous"), (None, None, None, "unknown"))


@_query("SELECT c_custkey AS file, " + ", ".join(f"CASE c_custkey % 5 {' '.join(f'WHEN {k} THEN {repr(x[at]) if at == 3 else x[at]}' for k, x in enumerate(_LAYOUT) if x[at] is not None)} END AS {name}" for at, name in ((0, "n_columns"), (1, "header_row"), (2, "data_row"), (3, "outcome"))) + " FROM customer")
def sheet_layouts(spark: SparkSession, d: str) -> DataFrame:
    row = lambda options: F.element_at(F.array(*[F.array(*map(F.lit, o)) for o in options]), (F.col("c_custkey") % 5 + 1).cast("int"))
    files = table(spark, d, "customer").select(F.col("c_custkey").alias("file"), F.lit("Hoja1").alias("sheet"), F.lit(0).alias("sheet_at"), F.posexplode(F.array(F.array(F.col("c_name")), row(_HEADS), row(_BELOW))).alias("k", "cells"))
    found = layouts.layouts(layouts.probed(files.select("file", "sheet", "sheet_at", (F.col("k") + 1).alias("row"), "cells")), "ligie_snapshot")
    return found.select("file", F.when(F.col("error").isNull(), F.size("columns")).alias("n_columns"), "header_row", "data_row", F.coalesce(F.split_part("error", F.lit(" "), F.lit(1)), F.lit("ok")).alias("outcome"))


_BODY_SQL = "coalesce(html, '')"
for _pattern in pages.SILENT:
    _BODY_SQL = f"regexp_replace({_BODY_SQL}, '{_pattern}', ' ', 'g')"


@_query(f"""WITH t AS (SELECT page_id, generate_subscripts(l, 1) - 1 AS position, unnest(l) AS t FROM (SELECT page_id, regexp_extract_all({_BODY_SQL}, '{pages.TAG}', 1) AS l FROM pages)),
  e AS (SELECT page_id, position, lower(ltrim(t, '/')) AS tag, CASE WHEN starts_with(t, '/') THEN -1 ELSE 1 END AS step FROM t WHERE lower(ltrim(t, '/')) IN {pages.PAIRED!r}),
  o AS (SELECT *, sum(step) OVER (PARTITION BY page_id, tag ORDER BY position) AS open, sum(step) OVER (PARTITION BY page_id ORDER BY position) AS depth, CASE WHEN step = 1 AND regexp_matches(tag, '^h[1-6]$') THEN right(tag, 1)::INT END AS heading FROM e),
  p AS (SELECT *, CASE WHEN step = 1 THEN depth ELSE depth + 1 END AS level, coalesce(heading > last_value(heading IGNORE NULLS) OVER (PARTITION BY page_id ORDER BY position ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1, false) AS skips FROM o),
  m AS (SELECT *, lag(tag) OVER (PARTITION BY page_id, level ORDER BY position) AS partner FROM p), a AS (SELECT page_id, count(*) AS n_tags, max(depth)::BIGINT AS depth, min(open) AS low, max(step = -1 AND partner IS DISTINCT FROM tag) AS crossed, max(skips) AS skips FROM m GROUP BY 1),
  s AS (SELECT page_id, max(abs(n)) AS stays FROM (SELECT page_id, tag, sum(step) AS n FROM e GROUP BY ALL) GROUP BY 1)
  SELECT page_id, coalesce(n_tags, 0) AS n_tags, coalesce(depth, 0) AS depth, CASE WHEN strlen(coalesce(html, '')) < {pages.MIN_BYTES} THEN 'small' WHEN NOT ({" OR ".join(f"contains(lower(coalesce(html, '')), '{m}')" for m in pages.MARKERS)}) THEN 'not_html' WHEN low < 0 OR stays > 0 THEN 'unbalanced' WHEN crossed THEN 'crossed' WHEN skips THEN 'heading_skipped' ELSE 'ok' END AS reason
  FROM pages LEFT JOIN a USING (page_id) LEFT JOIN s USING (page_id)""")
def page_verdicts(spark: SparkSession, d: str) -> DataFrame:
    return pages.verdicts(table(spark, d, "pages"))


_ADDRESS = r"""regexp_extract(html, '(?is)<a\s[^>]*?href\s*=\s*["'']([^"'']*)["'']', 1)"""


@_query(rf"""WITH RECURSIVE p AS (SELECT page_id, {_ADDRESS} AS url, html FROM pages), l AS (SELECT DISTINCT url, unnest(regexp_extract_all(html, '(?is)<a\s[^>]*?href\s*=\s*["'']([^"'']*)["'']', 1)) AS target FROM p WHERE url <> ''),
  walk AS (SELECT DISTINCT url, 0 AS depth FROM p WHERE page_id < 5 AND url <> '' UNION SELECT l.target, depth + 1 FROM walk JOIN l USING (url) WHERE depth < 4 AND l.target <> '')
  SELECT url, min(depth) AS depth FROM walk GROUP BY 1""")
def registered_discovery(spark: SparkSession, d: str) -> DataFrame:
    href = r"""(?is)<a\s[^>]*?href\s*=\s*["']([^"']*)["']"""
    rows = table(spark, d, "pages").select("page_id", F.regexp_extract("html", href, 1).alias("url"), "html").where("url <> ''")
    targets = rows.select("url", F.explode(F.regexp_extract_all("html", F.lit(href), 1)).alias("target")).where("target <> ''")
    return pages.discovered(rows, rows.where("page_id < 5"), rounds=4, targets=targets)


_TEXT_SQL = "'\"' || {0} || '\"'"


def _object_sql() -> str:
    """The canonical JSON of a record: the fields in their order, decimals trimmed, what isn't there null."""
    kinds = {"is_current": "{0}::VARCHAR", "igi_value": _TEXT_SQL.format("rtrim(rtrim({0}::VARCHAR, '0'), '.')"), "ige_value": _TEXT_SQL.format("rtrim(rtrim({0}::VARCHAR, '0'), '.')"), "effective_from": _TEXT_SQL.format("{0}::VARCHAR"), "effective_to": _TEXT_SQL.format("{0}::VARCHAR"), "updated_at": _TEXT_SQL.format("{0}::VARCHAR")}
    have = "code level description hs2 hs4 hs6 fraccion8 nico10 nico2 ligie_version dataset_version schema_version is_current values_from_level unit_code igi_text igi_kind igi_value ige_text ige_kind ige_value effective_from effective_to updated_at".split()
    each = [f"""'"{n}":' || """ + (f"coalesce({kinds.get(n, _TEXT_SQL).format(n)}, 'null')" if n in have else "'null'") for n in hashing.SEMANTIC_FIELDS]
    return "'{' || " + " || ',' || ".join(each) + " || '}'"


@_query(f"WITH {RECORDS_SQL} SELECT code, sha256({_object_sql()}) AS record_hash FROM records")
def semantic_hashes(spark: SparkSession, d: str) -> DataFrame:
    return hashing.with_record_hash(inputs.records(spark, d)).select("code", "record_hash")


_RATE = "CASE WHEN length(code) = 8 THEN to_json({{text: {0}_text, kind: {0}_kind, value: {0}_value::DOUBLE}})::VARCHAR END AS {0}_json"


@_query(f"WITH {RECORDS_SQL} SELECT code, level, description, {_RATE.format('igi')}, {_RATE.format('ige')} FROM records")
def public_records(spark: SparkSession, d: str) -> DataFrame:
    rows = serving.public_record(inputs.records(spark, d))
    return rows.select("code", "level", "description", *[F.to_json(c, {"ignoreNullFields": "false"}).alias(f"{c}_json") for c in ("igi", "ige")])


@_query(f"WITH {RECORDS_SQL} SELECT 'data-2024.02.01' AS release_tag, code, level FROM records WHERE is_current AND code::BIGINT % 3 = 0")
def active_records(spark: SparkSession, d: str) -> DataFrame:
    rows, root = inputs.records(spark, d).select("code", "level", "is_current"), shared_dir(spark)
    serving.promote(rows, "data-2024.01.01", root, generated_at="2024-01-01")
    serving.promote(rows.where(F.col("code").cast("bigint") % 3 == 0), "data-2024.02.01", root, generated_at="2024-02-01")
    return serving.active_records(spark, root).select("release_tag", "code", "level")


_PROBLEMS = "CASE page_id % 5 WHEN 0 THEN '<h2>Sección XXX</h2><p>1. algo</p>' WHEN 1 THEN '<h2>Capítulo 3</h2><p>1. </p><p>2. dos</p>' WHEN 2 THEN '<h2>Capítulo 4</h2><p>1. uno</p><h2>TRANSITORIOS</h2>' ELSE '' END"


@_query("""SELECT 'p-' || page_id AS source_document_id, CASE page_id % 5 WHEN 0 THEN 'unknown_section' ELSE 'no_notes' END AS reason, CASE page_id % 5 WHEN 0 THEN 'XXX' END AS scope_value, CASE page_id % 5 WHEN 0 THEN '1' END AS note_number FROM pages WHERE page_id % 5 IN (0, 3, 4)""")
def note_problems(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "pages").select(F.concat(F.lit("p-"), F.col("page_id").cast("string")).alias("source_document_id"), F.concat(F.expr(_PROBLEMS), "html").alias("html"))
    return html.note_problems(rows)


_REVISIONS_SQL = f"""{TREE_SQL}, cl AS (SELECT code, level, code::BIGINT AS k, CASE WHEN code::BIGINT % 2 = 0 THEN 'observed_snapshot' ELSE 'dated' END AS basis, CASE WHEN code::BIGINT % 3 <> 0 THEN DATE '2020-01-01' + (code::BIGINT % 100)::INT END AS a FROM tree),
  rate AS (SELECT code AS f8, NULL::DATE AS a, CASE WHEN k % 5 = 0 THEN DATE '2022-01-01' END AS b, 'exento' AS igi_kind, 'r1' AS src FROM cl WHERE length(code) = 8 UNION ALL SELECT code, DATE '2022-01-02', NULL, 'ad_valorem', 'r2' FROM cl WHERE length(code) = 8 AND k % 5 = 0),
  three AS (SELECT c.code, c.level, c.basis, r.igi_kind, greatest(c.a, r.a) AS a, r.b, 2 AS sources FROM cl c JOIN rate r ON r.f8 = c.code UNION ALL
    SELECT c.code, c.level, c.basis, r.igi_kind, greatest(c.a, r.a, p.a), r.b, 3 FROM cl c JOIN rate r ON r.f8 = left(c.code, 8) JOIN cl p ON p.code = r.f8 WHERE length(c.code) = 10 UNION ALL SELECT code, level, basis, NULL, a, NULL, 1 FROM cl WHERE length(code) < 8)"""


@_query(f"""WITH {_REVISIONS_SQL} SELECT code, level, CASE WHEN length(code) >= 8 THEN 'fraccion8' END AS values_from_level, row_number() OVER (PARTITION BY code ORDER BY a NULLS FIRST, b DESC NULLS LAST)::INT AS record_version, a AS effective_from, b AS effective_to,
  (a IS NULL OR a <= DATE '2024-01-01') AND (b IS NULL OR b >= DATE '2024-01-01') AND (a IS NOT NULL OR basis = 'observed_snapshot') AS is_current, igi_kind, sources::BIGINT AS source_count FROM three""")
def consolidated_records(spark: SparkSession, d: str) -> DataFrame:
    k, none = F.col("code").cast("bigint"), lambda kind: F.lit(None).cast(kind)
    rows = inputs.tree(spark, d).select(
        "level", "code", "description", F.lit("v1").alias("ligie_version"), F.when(k % 2 == 0, "observed_snapshot").otherwise("dated").alias("validity_basis"), none("date").alias("updated_at"), none("date").alias("published_at"),
        F.when(k % 3 != 0, F.date_add(F.lit("2020-01-01").cast("date"), (k % 100).cast("int"))).alias("classification_effective_from"), none("date").alias("classification_effective_to"), F.concat(F.lit("c-"), "code").alias("source_document_id"),
    )

    def rates(kind: str, start, end, source: str) -> DataFrame:
        values = {"unit_code": none("string"), "unit_name": none("string"), "igi_text": F.lit(kind), "igi_kind": F.lit(kind), "igi_value": none("decimal(18,6)"), "ige_text": none("string"), "ige_kind": none("string"), "ige_value": none("decimal(18,6)")}
        return rows.where("level = 'fraccion8'").select("code", "ligie_version", *[c.alias(n) for n, c in values.items()], none("date").alias("updated_at"), none("date").alias("published_at"), start.alias("rate_effective_from"), end.alias("rate_effective_to"), F.lit(source).alias("source_document_id"))

    day = lambda text: F.lit(text).cast("date")
    every = rates("exento", none("date"), F.when(k % 5 == 0, day("2022-01-01")), "r1").unionByName(rates("ad_valorem", day("2022-01-02"), none("date"), "r2").where(k % 5 == 0))
    out = consolidate.consolidate(rows, every, effective_as_of="2024-01-01", dataset_version="d1")
    return out.select("code", "level", "values_from_level", "record_version", "effective_from", "effective_to", "is_current", "igi_kind", "source_count")


_MESSAGES = ("Legal reconciliation failed", "SHA256 mismatch", "checksum", "unknown workbook profile", "bad PDF", "row_count differs", "something else", "missing official snapshot")
_KINDS = ("ValueError", "ReadTimeout", "BadZipFile", "KeyError", "OSError")
_CATEGORY = ("legal_reconciliation", "checksum", "checksum", "parser_profile", "parser", "validation", None, "source_discovery")


@_query(f"""WITH e AS (SELECT event_id, (event_id % {len(_MESSAGES)})::INT AS m, (user_id % {len(_KINDS)})::INT AS t FROM events) SELECT event_id, CASE WHEN m = 0 THEN 'legal_reconciliation' WHEN t = 1 THEN 'source_network' WHEN m IN (7, 1, 2, 3) THEN list_extract({[c or '' for c in _CATEGORY]!r}, m + 1)
  WHEN t = 2 OR m = 4 THEN 'parser' WHEN m = 5 THEN 'validation' WHEN t IN (0, 4) THEN 'domain_error' ELSE 'unexpected_error' END AS category FROM e""")
def failure_classes(spark: SparkSession, d: str) -> DataFrame:
    of = lambda values, c: F.element_at(F.array(*map(F.lit, values)), (F.col(c) % len(values) + 1).cast("int"))
    return table(spark, d, "events").select("event_id", messages.failure(of(_MESSAGES, "event_id"), of(_KINDS, "user_id")).alias("category"))


@_query("""WITH f AS (SELECT o_custkey, CASE WHEN o_orderkey % 3 = 0 THEN 'missing_dof_evidence:' || o_orderstatus WHEN o_orderkey % 7 = 0 THEN 'other' END AS x FROM orders)
  SELECT o_custkey, count(x) = 0 AS publishable, coalesce(array_to_string(list_sort(list(DISTINCT split_part(x, ':', 1)) FILTER (x IS NOT NULL)), ','), '') AS error_codes, count(x) AS n FROM f GROUP BY 1""")
def discrepancy_codes(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    rows = table(spark, d, "orders").select("o_custkey", F.when(k % 3 == 0, F.concat(F.lit("missing_dof_evidence:"), "o_orderstatus")).when(k % 7 == 0, "other").alias("discrepancy"))
    return evaluate.discrepancy_report(rows, "o_custkey").withColumn("error_codes", F.array_join("error_codes", ","))


_HAVE_SQL = [f"o_orderkey % {p} <> 0" for p in (2, 3, 5, 7, 11, 13, 17)]
_CODE_SQL = "CASE o_orderkey % 4 WHEN 0 THEN '' WHEN 1 THEN '0101.21.01' WHEN 2 THEN '0101-2101 00' ELSE '0101' END"
_URL_SQL = "CASE o_custkey % 5 WHEN 0 THEN 'https://www.snice.gob.mx/a' WHEN 1 THEN 'http://www.snice.gob.mx/a' WHEN 2 THEN 'https://www.snice.gob.mx:8443/a' WHEN 3 THEN 'https://example.org/' ELSE ' https://www.gob.mx/b ' END"
_OFFICIAL_SQL = "o_custkey % 5 = 0 AND o_orderkey % 6 <> 0 AND o_orderkey % 9 <> 0"


def _missing_sql(labels: tuple[str, ...], have: list[str]) -> str:
    return "array_to_string(list_filter([" + ", ".join(f"CASE WHEN NOT coalesce({h}, false) THEN '{x}' END" for x, h in zip(labels, have, strict=True)) + "], lambda x: x IS NOT NULL), '|')"


_RRNA_SQL = _missing_sql(trade.RRNA_LABELS, ["o_orderkey % 4 IN (1, 2)", _OFFICIAL_SQL, "true", "o_orderkey % 9 <> 0", _HAVE_SQL[0]])
_PEDIMENTO_SQL = _missing_sql(trade.PEDIMENTO_LABELS, ["o_orderkey % 4 <> 0", "true", "o_orderkey % 10 <> 0", "o_totalprice > 100000", *_HAVE_SQL[:4], _OFFICIAL_SQL])
_TMEC_SQL = _missing_sql(trade.TMEC_LABELS, _HAVE_SQL)


@_query(f"""WITH x AS (SELECT o_orderkey, o_orderkey % 4 <> 0 AND o_orderkey % 10 <> 0 AS known, {_OFFICIAL_SQL.replace('= 0 AND', '= 4 AND', 1)} AS official, o_custkey % 80 < 40 AS below, {_TMEC_SQL} AS t, {_RRNA_SQL} AS r, {_PEDIMENTO_SQL} AS p FROM orders)
  SELECT o_orderkey, CASE WHEN NOT known OR NOT official THEN 'evidence_required' WHEN below THEN 'threshold_not_met' WHEN t <> '' THEN 'evidence_required' ELSE 'evidence_review_required' END AS tmec_status, CASE WHEN NOT known OR official THEN t END AS tmec_missing,
    CASE WHEN r <> '' THEN 'evidence_required' ELSE 'evidence_review_required' END AS rrna_status, r AS rrna_missing, CASE WHEN p = '' THEN 'review_required' ELSE 'incomplete' END AS pedimento_status, p AS pedimento_missing FROM x""")
def trade_matrices(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    have = [k % p != 0 for p in (2, 3, 5, 7, 11, 13, 17)]
    code, origin, consulted = F.expr(_CODE_SQL), F.when(k % 10 != 0, "US").otherwise(""), F.when(k % 6 != 0, "2026-01-02").otherwise("soon")
    note = F.when(k % 9 != 0, "note").otherwise(" ")
    reference = trade.official_reference(F.expr(_URL_SQL), consulted, note, "rrna")
    t = trade.tmec_orientation(code, origin, (F.col("o_custkey") % 80).cast("double"), F.lit(40.0), trade.official_reference(F.expr(_URL_SQL), consulted, note, "tmec"), have)
    r = trade.rrna_orientation(code, reference, consulted, note, have[0])
    p = trade.pedimento_checklist(code, F.lit("A1"), origin, F.col("o_totalprice").cast("double") - 100000, *have[:4], reference)
    every = {"tmec": t, "rrna": r, "pedimento": p}
    columns = [c for name, x in every.items() for c in (x["status"].alias(f"{name}_status"), F.array_join(x["missing"], "|").alias(f"{name}_missing"))]
    return table(spark, d, "orders").select("o_orderkey", *columns)


_DIFFERENT = "sin relacion"


def _line(field: str, ours: str, theirs: str, match: str, note: str) -> str:
    return f"{{'field': '{field}', 'ours': ({ours})::VARCHAR, 'theirs': ({theirs})::VARCHAR, 'match': ({match})::BOOLEAN, 'note': '{note}'}}"


_THEIR_DUTY = "CASE WHEN k % 5 = 1 THEN 'Ex.' ELSE igi_text END"
_THEIRS = ", ".join((
    _line("description", "description", f"CASE WHEN k % 6 = 3 OR trim(description) = '' THEN '{_DIFFERENT}' WHEN k % 6 = 2 THEN upper(description) ELSE description END", "trim(description) = '' OR k % 6 <> 3", ""),
    _line("igi", "igi_text", _THEIR_DUTY, "k % 5 <> 1 OR igi_text = 'exento'", ""), _line("ige", "NULL", "NULL", "NULL", ""),
))


@_query(f"""WITH {RECORDS_SQL}, r AS (SELECT code, level, description, igi_text, code::BIGINT AS k FROM records WHERE is_current AND length(code) >= 6),
  ask AS (SELECT code AS asked FROM records WHERE is_current AND length(code) >= 4 AND code::BIGINT % 4 = 0),
  page AS (SELECT code AS sheet, k % 11 = 4 AS broken FROM r WHERE level = 'fraccion8' AND k % 7 <> 3),
  keyed AS (SELECT unnest(CASE level WHEN 'hs6' THEN [code] WHEN 'fraccion8' THEN [code, left(code, 6)] ELSE [code, left(code, 8), left(code, 6)] END) AS asked, * FROM r),
  j AS (SELECT q.*, f.code AS fraction, p.sheet, p.broken, q.level = 'nico10' AND (f.code IS NULL OR p.sheet IS NULL OR p.broken) AS alone
    FROM keyed q LEFT JOIN r f ON f.level = 'fraccion8' AND f.code = left(q.code, 8) LEFT JOIN page p ON p.sheet = left(q.code, 8) WHERE q.asked IN (SELECT asked FROM ask) AND q.asked IN (SELECT code FROM r)),
  lines AS (SELECT asked, code, level, unnest(CASE WHEN level = 'hs6' THEN [{_line('description', 'description', 'NULL', 'NULL', compare.NO_PAGE)}]
      WHEN level = 'nico10' AND fraction IS NULL THEN [{_line('present', "'yes'", 'NULL', 'NULL', compare.NO_FRACTION.replace("'", "''"))}] WHEN sheet IS NULL THEN [{_line('present', "'yes'", 'NULL', 'NULL', compare.NO_SHEET)}]
      WHEN broken THEN [{_line('present', "'yes'", 'NULL', 'false', thirdparty.NOT_TOLD)}] WHEN level = 'nico10' AND k % 13 = 6 THEN [{_line('present', "'yes'", 'NULL', 'false', compare.NO_ITEM)}] ELSE [{_THEIRS}] END) AS x
    FROM j WHERE NOT alone OR asked = code)
  SELECT asked, code, level, x.field AS field, x.ours AS ours, x.theirs AS theirs, x.match AS match, x.note AS note FROM lines
  UNION ALL SELECT asked, asked, NULL, 'code', NULL, NULL, NULL, '{compare.NO_RECORD}' FROM ask WHERE asked NOT IN (SELECT code FROM r)""")
def third_party_compare(spark: SparkSession, d: str) -> DataFrame:
    """Pages of a classifier are made from the fractions and their items, read again, and compared with the records; every fourth code is asked."""
    rows = inputs.records(spark, d).where("is_current").withColumn("k", F.col("code").cast("bigint"))
    k, told = F.col("k"), F.trim("description") != ""
    name = F.when((k % 6 == 3) | ~told, _DIFFERENT).when(k % 6 == 2, F.upper("description")).otherwise(F.col("description"))
    cells = lambda first: F.concat(F.lit("<tr><td>"), first, F.lit("</td><td>"), name, F.lit("</td><td>"), F.when(k % 5 == 1, "Ex.").otherwise(F.col("igi_text")), F.lit("</td></tr>"))
    items = rows.where((F.col("level") == "nico10") & (k % 13 != 6)).select(F.substring("code", 1, 8).alias("code"), cells(F.when(k % 2 == 0, F.substring("code", 9, 2)).otherwise(F.col("code"))).alias("line"))
    below = items.groupBy("code").agg(F.array_join(F.array_sort(F.collect_list("line")), "").alias("lines"))
    pages = rows.where((F.col("level") == "fraccion8") & (k % 7 != 3)).join(below, "code", "left").select(
        F.concat(F.lit("https://example.org/hojas/"), "code", F.lit(".html")).alias("url"),
        F.when(k % 11 == 4, "<p>nada</p>").otherwise(F.concat(
            F.lit("<table><tr><th>Fracción</th><th>Descripción</th></tr>"), cells(F.concat_ws(".", F.substring("code", 1, 4), F.substring("code", 5, 2), F.substring("code", 7, 2))),
            F.lit("</table><table><tr><th>NICO</th><th>Descripción</th></tr>"), F.coalesce("lines", F.lit("")), F.lit("</table>"),
        )).alias("html"),
    )
    asked = rows.where((F.length("code") >= 4) & (k % 4 == 0)).select("code")
    return compare.third_party(rows, thirdparty.fraction_sheets(pages), asked)


_LEDGER_HEADS = ("Publicación original", "Decretos de reforma", "Decretos que modifican la Tarifa", "Acuerdos complementarios")
_LEDGER_TITLES = ("Notas Nacionales", "Acuerdo NICO", "Correlación", "Otro acuerdo")
_LEDGER_ROOT = "https://example.org/leyes/"


def _ledger_pages(spark: SparkSession, d: str) -> DataFrame:
    """A ledger of each customer's orders: four sections, dates and the current text for some."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    file = F.concat(F.when(k % 5 == 0, "LIGIE_2022_ref").otherwise("doc"), k.cast("string"))
    links = F.concat(F.lit('<a href="pdf/'), file, F.lit('.pdf">DOF '), F.date_format("o_orderdate", "dd-MM-yyyy"), F.lit('</a> <a href="'), file, F.lit('.doc">Texto</a>'))
    title = F.element_at(F.array(*map(F.lit, _LEDGER_TITLES)), (F.least(k % 7, F.lit(3)) + 1).cast("int"))
    line = F.concat(F.lit("<tr><td>"), k.cast("string"), F.lit("</td><td>"), title, F.lit("</td><td>"), F.date_format("o_orderdate", "dd/MM/yyyy"), F.lit(" "), links, F.lit("</td></tr>"))
    each = table(spark, d, "orders").select(c.alias("custkey"), F.struct((k / 2 % 4).cast("int").alias("part"), k.alias("k"), line.alias("line")).alias("x"))
    rows = each.groupBy("custkey").agg(F.array_sort(F.collect_list("x")).alias("xs"))  # one customer's page
    of = lambda part: F.filter("xs", lambda x: x["part"] == part)
    parts = [F.concat(F.lit(f"<tr><th>{h}</th></tr>"), F.array_join(F.transform(of(p), lambda x: x["line"]), "")) for p, h in enumerate(_LEDGER_HEADS)]
    c = F.col("custkey")
    shown = F.when(c % 6 != 5, F.concat(F.lit("<p>Última reforma publicada DOF "), (c % 28 + 1).cast("string"), F.lit(" de enero de 2020</p><p>Fracciones arancelarias: Decreto DOF 05/06/2021</p>"))).otherwise("")
    current = F.when(c % 2 == 0, '<a href="pdf/LIGIE_2022.pdf?x=1">Ley</a>').otherwise("")
    return rows.select(F.concat(F.lit(_LEDGER_ROOT), c.cast("string"), F.lit(".htm")).alias("url"), F.concat(shown, current, F.lit("<table>"), *parts, F.lit("</table>")).alias("html"))


@_query(f"""WITH o AS (SELECT *, floor((o_orderkey / 2.0) % 4)::INT AS part FROM orders),
  r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY part, o_orderkey) AS n, CASE WHEN o_orderkey % 5 = 0 THEN 'LIGIE_2022_ref' ELSE 'doc' END || o_orderkey AS file FROM o),
  law AS (SELECT DISTINCT o_custkey, CASE WHEN o_custkey % 6 <> 5 THEN DATE '2020-01-01' + (o_custkey % 28)::INT END AS law FROM orders)
  SELECT '{_LEDGER_ROOT}' || o_custkey || '.htm' AS url, (CASE WHEN o_custkey % 2 = 0 THEN 1 ELSE 0 END + part + n)::INT AS position,
    CASE WHEN o_orderkey % 5 = 0 THEN 'law_reform' WHEN part < 3 THEN list_extract(['original', 'law_reform', 'tariff_decree'], part + 1) ELSE list_extract(['national_notes', 'nico_agreement', 'correlation', 'unknown'], least(o_orderkey % 7, 3)::INT + 1) END AS category,
    o_orderkey::VARCHAR AS label, list_extract({list(_LEDGER_TITLES)!r}, least(o_orderkey % 7, 3)::INT + 1) AS title, o_orderdate::DATE AS displayed_date,
    'dof {_LEDGER_ROOT}pdf/' || file || '.pdf ' || o_orderdate::DATE || ' application/pdf,word {_LEDGER_ROOT}' || file || '.doc - application/msword' AS links FROM r
  UNION ALL SELECT '{_LEDGER_ROOT}' || o_custkey || '.htm', 0, 'consolidated_text', 'current', 'Texto vigente LIGIE 2022', law, 'pdf {_LEDGER_ROOT}pdf/LIGIE_2022.pdf?x=1 - application/pdf' FROM law WHERE o_custkey % 2 = 0""")
def ledger_documents(spark: SparkSession, d: str) -> DataFrame:
    shown = lambda x: F.concat_ws(" ", x["role"], x["target"], F.coalesce(x["displayed_date"].cast("string"), F.lit("-")), x["media_type"])
    return ledgers.ledger_documents(_ledger_pages(spark, d)).withColumn("links", F.array_join(F.transform("links", shown), ","))


@_query(f"SELECT DISTINCT '{_LEDGER_ROOT}' || o_custkey || '.htm' AS url, 'missing_date' AS reason FROM orders WHERE o_custkey % 6 = 5")
def ledger_problems(spark: SparkSession, d: str) -> DataFrame:
    return ledgers.ledger_problems(_ledger_pages(spark, d))


def _released(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The records as five releases by chapter, with faults of their own, and what their release rows and manifests say."""
    v, n = F.col("dataset_version"), F.length("code")
    rows = inputs.records(spark, d).withColumn("dataset_version", F.concat(F.lit("d"), (F.substring("code", 1, 2).cast("int") % 5).cast("string")))
    rows = rows.withColumns({
        "record_id": F.when(v == "d1", F.col("code")).otherwise(F.col("record_id")), "is_current": F.col("is_current") | (v == "d3"),
        "values_from_level": F.when(v == "d2", F.when(n >= 8, "fraccion8")).otherwise(F.col("values_from_level")), "igi_value": F.when((v != "d2") | (n >= 8), F.col("igi_value")),
        "hs4": F.when((v == "d3") & (n >= 4), F.substring("code", 1, 4)).otherwise(F.col("hs4")), "ligie_version": F.when(v == "d3", "v0").otherwise(F.col("ligie_version")),
    })
    counts = rows.groupBy("dataset_version").agg(F.count("*").alias("row_count"), *[F.count(F.when(F.col("level") == x, 1)).alias(x) for x in certify.LEVELS])
    facts = lambda schema, status: (v, schema.alias("schema_version"), F.lit("v0").alias("ligie_version"), F.lit("2024-01-01").cast("date").alias("effective_as_of"), status.alias("validation_status"))
    said = counts.select(*facts(F.lit("2"), F.when(v != "d0", "passed").otherwise("failed")), (F.col("row_count") + (v == "d2").cast("int")).alias("row_count"))
    releases = said.unionByName(said.where(v == "d3"))
    levels = F.create_map(*[x for name in certify.LEVELS for x in (F.lit(name), F.col(name) + ((v == "d4") & F.lit(name == "hs2")).cast("int"))])
    return rows, releases, counts.select(*facts(F.when(v == "d1", "1").otherwise("2"), F.lit("passed")), "row_count", levels.alias("level_counts"))


_RELEASED_SQL = RECORDS_SQL + """, rel AS (SELECT * EXCLUDE v REPLACE (CASE WHEN v = 'd1' THEN code ELSE record_id END AS record_id, is_current OR v = 'd3' AS is_current,
    CASE WHEN v = 'd2' THEN CASE WHEN length(code) >= 8 THEN 'fraccion8' END ELSE values_from_level END AS values_from_level, CASE WHEN v <> 'd2' OR length(code) >= 8 THEN igi_value END AS igi_value,
    CASE WHEN v = 'd3' AND length(code) >= 4 THEN left(code, 4) ELSE hs4 END AS hs4, CASE WHEN v = 'd3' THEN 'v0' ELSE ligie_version END AS ligie_version, v AS dataset_version)
    FROM (SELECT *, 'd' || (left(code, 2)::INT % 5) AS v FROM records)), cur AS (SELECT * FROM rel WHERE is_current)"""
_ORPHANS_SQL = " UNION ALL ".join(
    f"SELECT dataset_version, '{name}' AS problem, count(*) AS n FROM cur c WHERE level = '{level}' AND NOT EXISTS (SELECT 1 FROM cur p WHERE p.level = '{up}' AND p.code = c.{up} AND p.ligie_version = c.ligie_version AND p.dataset_version = c.dataset_version) GROUP BY 1"
    for level, (up, name) in certify.PARENTS.items()
)
_FILLED = " OR ".join(f"{c} IS NOT NULL" for c in certify.VALUES if c != "unit_name")


@_query(f"""WITH {_RELEASED_SQL}, g AS (SELECT dataset_version, count(*) - count(DISTINCT record_id) AS twice, count(*) FILTER (level IN ('hs2', 'hs4', 'hs6') AND ({_FILLED})) AS low,
    count(*) FILTER (level IN ('fraccion8', 'nico10') AND values_from_level IS DISTINCT FROM 'fraccion8') AS origin FROM rel GROUP BY 1),
  found AS (SELECT dataset_version, unnest([{{'p': 'duplicate_record_ids', 'n': twice}}, {{'p': 'hs_values', 'n': low}}, {{'p': 'tariff_origin', 'n': origin}}, {{'p': 'not_validated', 'n': (dataset_version = 'd0')::BIGINT}},
      {{'p': 'metadata_mismatch', 'n': (dataset_version IN ('d0', 'd1'))::BIGINT}}, {{'p': 'row_count_mismatch', 'n': (dataset_version = 'd2')::BIGINT}}, {{'p': 'release_rows', 'n': CASE dataset_version WHEN 'd3' THEN 2 ELSE 0 END}},
      {{'p': 'level_counts_mismatch', 'n': (dataset_version = 'd4')::BIGINT}}]) AS x FROM g)
  SELECT dataset_version, x.p AS problem, x.n AS n FROM found WHERE x.n > 0 UNION ALL {_ORPHANS_SQL}""")
def certification_problems(spark: SparkSession, d: str) -> DataFrame:
    return certify.problems(*_released(spark, d))


@_query(f"""WITH {_RELEASED_SQL}, f AS (SELECT dataset_version, code, code::BIGINT % 4 = 1 AS late, EXISTS (SELECT 1 FROM cur i WHERE i.level = 'nico10' AND i.fraccion8 = c.code AND i.dataset_version = c.dataset_version) AS held FROM cur c WHERE level = 'fraccion8')
  SELECT dataset_version, count(*) AS fraccion8, count(*) FILTER (held) AS with_nico_descendant, count(*) FILTER (NOT held) AS missing_nico_descendant, count(*) FILTER (NOT held AND late) AS known_upstream_lag, count(*) FILTER (NOT held AND NOT late) AS unclassified_missing FROM f GROUP BY 1""")
def nico_coverage(spark: SparkSession, d: str) -> DataFrame:
    rows, *_ = _released(spark, d)
    return certify.nico_coverage(rows, rows.where("level = 'fraccion8' AND CAST(code AS BIGINT) % 4 = 1").select("code"))


@_query("""WITH a AS (SELECT o_orderkey::VARCHAR AS k, o_orderstatus AS r, o_totalprice AS p FROM orders), e AS (SELECT k, r, k::BIGINT AS n FROM a WHERE k::BIGINT % 5 = 0 OR k::BIGINT % 7 = 0 OR k::BIGINT % 11 = 0)
  SELECT k AS dataset_key, r AS document_role, CASE WHEN n % 5 = 0 AND n % 7 = 0 THEN NULL WHEN n % 5 = 0 THEN 'removed' WHEN n % 7 = 0 THEN 'added' ELSE 'updated' END AS change, n % 7 = 0 AND n % 5 <> 0 AND n % 3 = 0 AS wrong FROM e WHERE NOT (n % 5 = 0 AND n % 7 = 0)""")
def source_history(spark: SparkSession, d: str) -> DataFrame:
    """Two states of sources with some new, gone and changed; every third new one is told as gone and found wrong."""
    k = F.col("o_orderkey")
    rows = table(spark, d, "orders").select(k.cast("string").alias("dataset_key"), F.col("o_orderstatus").alias("document_role"), F.col("o_totalprice").cast("string").alias("sha256"), k.alias("k"))
    now = rows.where("k % 5 <> 0").drop("k")
    was = rows.where("k % 7 <> 0").withColumn("sha256", F.when(F.col("k") % 11 == 0, "old").otherwise(F.col("sha256"))).drop("k")
    history = certify.source_history(was, now, ["sha256"])
    told = history.withColumn("change", F.when((F.col("change") == "added") & (F.col("dataset_key").cast("bigint") % 3 == 0), "removed").otherwise(F.col("change")))
    wrong = certify.history_problems(told, now, ["sha256"]).select(*certify.KEY, F.lit(True).alias("wrong")).distinct()
    return history.join(wrong, certify.KEY, "left").select(*certify.KEY, "change", F.coalesce("wrong", F.lit(False)).alias("wrong"))


@_query(f"""WITH {TREE_SQL}, f AS (SELECT code, trim(description) AS description, code::BIGINT AS k FROM tree WHERE level = 'fraccion8')
  SELECT code AS place, code, CASE WHEN k % 3 <> 0 THEN description END AS description, CASE WHEN k % 3 <> 0 THEN CASE WHEN k % 2 = 0 THEN '10' ELSE 'Ex.' END END AS igi, CASE WHEN k % 3 = 1 THEN 'Ex.' END AS ige,
    CASE WHEN k % 3 = 0 THEN '{thirdparty.NO_ROW}' END AS error FROM f""")
def fraction_documents(spark: SparkSession, d: str) -> DataFrame:
    """Pages of labelled rows made from the fractions: every third has the code in a paragraph only."""
    k = F.col("code").cast("bigint")
    dotted = F.concat_ws(".", F.substring("code", 1, 4), F.substring("code", 5, 2), F.substring("code", 7, 2))
    head = F.when(k % 3 == 1, F.concat(F.lit("<tr><td>Fracción arancelaria</td><td>"), dotted, F.lit("</td><td>"), "description", F.lit("</td></tr><tr><td>IGE</td><td>Ex.</td></tr>")))
    plain = F.concat(F.lit("<tr><td>Código:</td><td>"), dotted, F.lit("</td><td>"), "description", F.lit("</td><td>x</td></tr>"))
    rates = F.concat(F.lit("<tr><td>IGI</td><td>viejo</td></tr><tr><td>Impuesto general de importación</td><td>"), F.when(k % 2 == 0, "10").otherwise("Ex."), F.lit("</td></tr>"))
    pages = inputs.tree(spark, d).where("level = 'fraccion8'").select(
        F.col("code").alias("place"), F.concat(F.lit("<p>"), "code", F.lit("</p><table>"), F.when(k % 3 == 0, "").otherwise(F.coalesce(head, plain)), rates, F.lit("</table>")).alias("html"),
    )
    return thirdparty.fraction_documents(pages)
