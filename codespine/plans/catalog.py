"""The registered queries of the engine, and the same results as DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import codes, dates, duty, hashing, lists, text, trade
from ..operators import consolidate, diff, evaluate, hierarchy, search, validate
from ..sources import html
from . import inputs, records_catalog, views
from .inputs import CLASSIFICATION_SQL, RATE_SQL, TREE_SQL, table

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def _query(sql: str | None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql is not None:
            _SQL[f.__name__] = sql
        return f

    return add


@_query(f"WITH {TREE_SQL} SELECT level, count(*) AS n FROM tree GROUP BY level")
def code_levels(spark: SparkSession, d: str) -> DataFrame:
    return hierarchy.level_counts(inputs.tree(spark, d))


@_query(f"""WITH {TREE_SQL} SELECT code, CASE length(code) WHEN 2 THEN code WHEN 4 THEN left(code, 2) || '.' || right(code, 2) WHEN 6 THEN left(code, 4) || '.' || right(code, 2)
  WHEN 8 THEN left(code, 4) || '.' || substr(code, 5, 2) || '.' || right(code, 2) ELSE left(code, 4) || '.' || substr(code, 5, 2) || '.' || substr(code, 7, 2) || ' ' || right(code, 2) END AS formatted_code,
  array_to_string(regexp_extract_all(code, '..'), '.') AS paired_code, left(code, 2) AS hs2, CASE WHEN length(code) >= 4 THEN left(code, 4) END AS hs4, CASE WHEN length(code) >= 6 THEN left(code, 6) END AS hs6,
  CASE WHEN length(code) >= 8 THEN left(code, 8) END AS fraccion8, CASE WHEN length(code) = 10 THEN code END AS nico10, CASE WHEN length(code) = 10 THEN right(code, 2) END AS nico2 FROM tree""")
def code_formats(spark: SparkSession, d: str) -> DataFrame:
    code = F.col("code")
    return inputs.tree(spark, d).select("code", codes.formatted(code).alias("formatted_code"), codes.paired(code).alias("paired_code"), *[c.alias(n) for n, c in codes.components(code).items()])


@_query(f"""WITH {TREE_SQL} SELECT left(code, length(code) - 2) AS parent, count(*) AS n_children, '["' || string_agg(code, '","' ORDER BY code) || '"]' AS children_json
  FROM tree WHERE length(code) > 2 GROUP BY 1""")
def tree_children(spark: SparkSession, d: str) -> DataFrame:
    return hierarchy.child_lists(inputs.tree(spark, d))


_SECTIONS = ", ".join(f"('{r}', '{a:02d}', '{b:02d}')" for r, _, a, b in hierarchy.SECTIONS)


@_query(f"""WITH {TREE_SQL}, sections(roman, a, b) AS (VALUES {_SECTIONS}), chains AS (
    SELECT t.code, '["' || string_agg(u.code, '","' ORDER BY u.code) || '"]' AS ancestors_json FROM tree t JOIN tree u ON length(u.code) < length(t.code) AND left(t.code, length(u.code)) = u.code GROUP BY t.code),
  below AS (SELECT left(code, length(code) - 2) AS code, count(*) AS n FROM tree WHERE length(code) > 2 GROUP BY 1)
  SELECT t.code, t.level, s.roman AS section, CASE WHEN length(t.code) > 2 THEN left(t.code, length(t.code) - 2) END AS parent, coalesce(c.ancestors_json, '[]') AS ancestors_json, coalesce(b.n, 0) AS n_children
  FROM tree t LEFT JOIN sections s ON left(t.code, 2) BETWEEN s.a AND s.b LEFT JOIN chains c ON c.code = t.code LEFT JOIN below b ON b.code = t.code""")
def tree_ancestors_card(spark: SparkSession, d: str) -> DataFrame:
    return hierarchy.cards(inputs.tree(spark, d)).select("code", "level", "section", "parent", "ancestors_json", "n_children")


@_query("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey = 7")
def lookup_unique(spark: SparkSession, d: str) -> DataFrame:
    code = F.lpad(F.col("o_orderkey").cast("string"), 10, "0")
    rows = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", code.alias("code"), F.lit(True).alias("is_current"))
    return hierarchy.lookup(rows, "00.00.00.00 07").drop("code", "is_current")


_KEPT = "CAST(substr(code, length(code) - 1, 2) AS INT) % 3 <> 1 OR length(code) IN (2, 10)"


@_query(f"""WITH {TREE_SQL}, kept AS (SELECT * FROM tree WHERE {_KEPT})
  SELECT code, level, left(code, length(code) - 2) AS parent FROM kept k WHERE length(code) > 2 AND NOT EXISTS (SELECT 1 FROM kept p WHERE p.code = left(k.code, length(k.code) - 2))""")
def orphan_codes(spark: SparkSession, d: str) -> DataFrame:
    kept = inputs.tree(spark, d).where((F.substring("code", -2, 2).cast("int") % 3 != 1) | F.length("code").isin(2, 10))
    return hierarchy.orphans(kept).select("code", "level", "parent")


@_query(f"""WITH {CLASSIFICATION_SQL}, {RATE_SQL} SELECT c.k, r.line, r.suppkey, r.partkey, greatest(c.valid_from, r.valid_from) AS valid_from, least(c.valid_to, r.valid_to) AS valid_to
  FROM classification c JOIN rate r USING (k) WHERE greatest(c.valid_from, r.valid_from) IS NULL OR least(c.valid_to, r.valid_to) IS NULL OR greatest(c.valid_from, r.valid_from) <= least(c.valid_to, r.valid_to)""")
def interval_consolidate(spark: SparkSession, d: str) -> DataFrame:
    joined = consolidate.interval_join(inputs.classifications(spark, d), inputs.rates(spark, d), ["k"])
    return joined.select("k", "line", "suppkey", "partkey", "valid_from", "valid_to")


@_query(f"""WITH {CLASSIFICATION_SQL}, {RATE_SQL}, parent AS (SELECT c_custkey AS custkey, c_nationkey AS nation, CASE WHEN c_custkey % 4 <> 0 THEN DATE '1995-01-01' + (c_custkey % 900)::INT END AS valid_from,
    CASE WHEN c_custkey % 5 <> 0 THEN DATE '1996-06-01' + (c_custkey % 1200)::INT END AS valid_to FROM customer), pair AS (
    SELECT c.k, c.custkey, r.line, r.suppkey, r.partkey, greatest(c.valid_from, r.valid_from) AS a, least(c.valid_to, r.valid_to) AS b FROM classification c JOIN rate r USING (k)),
  three AS (SELECT k, line, suppkey, partkey, nation, greatest(a, valid_from) AS valid_from, least(b, valid_to) AS valid_to FROM pair JOIN parent USING (custkey) WHERE (a <= b) IS NOT FALSE)
  SELECT * FROM three WHERE (valid_from <= valid_to) IS NOT FALSE""")
def interval_three_way(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("c_custkey")
    parent = table(spark, d, "customer").select(
        key.alias("custkey"), F.col("c_nationkey").alias("nation"),
        F.when(key % 4 != 0, F.date_add(F.lit("1995-01-01").cast("date"), (key % 900).cast("int"))).alias("valid_from"),
        F.when(key % 5 != 0, F.date_add(F.lit("1996-06-01").cast("date"), (key % 1200).cast("int"))).alias("valid_to"),
    )
    two = consolidate.interval_join(inputs.classifications(spark, d), inputs.rates(spark, d), ["k"])
    return consolidate.interval_join(two, parent, ["custkey"]).select("k", "line", "suppkey", "partkey", "nation", "valid_from", "valid_to")


@_query(f"""WITH {CLASSIFICATION_SQL} SELECT k, custkey, status, row_number() OVER (PARTITION BY custkey, status ORDER BY valid_from NULLS FIRST, valid_to NULLS FIRST, k) AS record_version FROM classification""")
def version_number(spark: SparkSession, d: str) -> DataFrame:
    rows = inputs.classifications(spark, d)
    out = consolidate.numbered(rows, ["custkey", "status"], start="valid_from", published="valid_to", last="k")
    return out.select("k", "custkey", "status", "record_version")


@_query("""WITH v AS (SELECT o_custkey, (o_orderkey % 4 + 1)::INT AS record_version FROM orders)
  SELECT o_custkey, count(*) AS rows, min(record_version) AS first, max(record_version) AS last, count(DISTINCT record_version) AS different FROM v GROUP BY o_custkey
  HAVING min(record_version) <> 1 OR max(record_version) <> count(*) OR count(DISTINCT record_version) <> count(*)""")
def version_contiguity(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").select("o_custkey", (F.col("o_orderkey") % 4 + 1).cast("int").alias("record_version"))
    return validate.non_contiguous(rows, ["o_custkey"])


@_query(f"""WITH {RATE_SQL}, x AS (SELECT *, row_number() OVER t AS n, lag(valid_to) OVER t AS before FROM rate WINDOW t AS (PARTITION BY k ORDER BY valid_from NULLS FIRST, valid_to NULLS FIRST, line NULLS FIRST, suppkey NULLS FIRST, partkey NULLS FIRST))
  SELECT k, line, suppkey, partkey, valid_from, valid_to FROM x WHERE n > 1 AND (before IS NULL OR valid_from IS NULL OR valid_from <= before)""")
def interval_overlap(spark: SparkSession, d: str) -> DataFrame:
    rows = inputs.rates(spark, d)
    return validate.overlapping(rows, ["k"], start="valid_from", end="valid_to", ties=["valid_to", "line", "suppkey", "partkey"]).select("k", "line", "suppkey", "partkey", "valid_from", "valid_to")


_DUTY = {"10%": ("ad_valorem", "10"), "Ex.": ("exento", "0"), "Prohibida": ("prohibida", None), "0.36 USD/Kg": ("especifica", None), "10% + 0.36 USD/Kg": ("compuesta", None), "según decreto": ("desconocida", None), "12,5": ("ad_valorem", "12.5"), "Exenta": ("exento", "0")}
_DUTY_KIND = " ".join(f"WHEN '{k}' THEN '{v}'" for k, (v, _) in _DUTY.items())
_DUTY_VALUE = " ".join(f"WHEN '{k}' THEN {v}" for k, (_, v) in _DUTY.items() if v)


@_query(f"""WITH x AS (SELECT l_orderkey, l_linenumber, trim(regexp_replace({inputs.duty_sql('l_partkey')}, '\\s+', ' ', 'g')) AS literal FROM lineitem)
  SELECT literal, CASE literal {_DUTY_KIND} END AS kind, CAST(CASE literal {_DUTY_VALUE} END AS DECIMAL(18, 6)) AS value, count(*) AS n FROM x GROUP BY ALL""")
def duty_parse(spark: SparkSession, d: str) -> DataFrame:
    return duty.counts(table(spark, d, "lineitem"), inputs.duty_text(F.col("l_partkey")))


@_query("""WITH x AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(CAST(l_discount AS DECIMAL(18, 6)) * 100 AS DECIMAL(18, 6)) AS v FROM lineitem)
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, rtrim(rtrim(v::VARCHAR, '0'), '.') AS plain FROM x""")
def decimal_text(spark: SparkSession, d: str) -> DataFrame:
    value = (F.col("l_discount").cast("decimal(18,6)") * 100).cast("decimal(18,6)")
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", hashing.decimal_text(value).alias("plain"))


@_query("""SELECT o_orderkey, sha256('{"level":"' || o_orderstatus || '","code":"' || o_orderkey || '","igi_value":"' || rtrim(rtrim(CAST(o_totalprice AS DECIMAL(18, 6))::VARCHAR, '0'), '.') || '","name":null,"effective_from":"' || o_orderdate::DATE || '"}') AS record_hash,
  sha256('["' || o_orderstatus || '","' || o_orderkey || '",null,"' || o_orderdate::DATE || '",' || (o_orderkey % 5) || ']') AS record_id FROM orders""")
def record_hash(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").select(
        "o_orderkey", F.col("o_orderstatus").alias("level"), F.col("o_orderkey").cast("string").alias("code"), F.col("o_totalprice").cast("decimal(18,6)").alias("igi_value"),
        F.lit(None).cast("string").alias("name"), F.to_date("o_orderdate").alias("effective_from"), (F.col("o_orderkey") % 5).alias("record_version"),
    )
    return rows.select(
        "o_orderkey", hashing.digest(hashing.canonical_object(rows, ("level", "code", "igi_value", "name", "effective_from"))).alias("record_hash"),
        hashing.digest(hashing.canonical_list(rows, ("level", "code", "name", "effective_from", "record_version"))).alias("record_id"),
    )


@_query("""SELECT l_orderkey, '["' || array_to_string(list_sort(list(DISTINCT 's-' || l_suppkey)), '","') || '"]' AS source_document_ids_json, count(DISTINCT l_suppkey) AS source_count FROM lineitem GROUP BY l_orderkey""")
def provenance_list(spark: SparkSession, d: str) -> DataFrame:
    links = table(spark, d, "lineitem").select("l_orderkey", F.concat(F.lit("s-"), F.col("l_suppkey").cast("string")).alias("source"))
    return evaluate.provenance_lists(links, "l_orderkey", "source")


@_query("""WITH l AS (SELECT DISTINCT l_orderkey AS record_id, l_suppkey AS source_document_id, l_returnflag AS role, l_linenumber = 1 AS is_primary FROM lineitem)
  SELECT record_id, source_document_id, role, is_primary, s_name, row_number() OVER (PARTITION BY record_id ORDER BY is_primary DESC, source_document_id, role) AS position
  FROM (SELECT o_orderkey AS record_id FROM orders) JOIN l USING (record_id) JOIN (SELECT s_suppkey AS source_document_id, s_name FROM supplier) USING (source_document_id)""")
def provenance_ranked(spark: SparkSession, d: str) -> DataFrame:
    links = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("record_id"), F.col("l_suppkey").alias("source_document_id"), F.col("l_returnflag").alias("role"), (F.col("l_linenumber") == 1).alias("is_primary"))
    documents = table(spark, d, "supplier").select(F.col("s_suppkey").alias("source_document_id"), "s_name")
    return evaluate.provenance(table(spark, d, "orders").select(F.col("o_orderkey").alias("record_id")), evaluate.distinct_links(links), documents)


@_query("""SELECT o_orderkey AS record_id, count(*) FILTER (l_linenumber = 1) AS primary_count FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1 HAVING count(*) FILTER (l_linenumber = 1) <> 1""")
def primary_count(spark: SparkSession, d: str) -> DataFrame:
    links = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("record_id"), (F.col("l_linenumber") == 1).alias("is_primary"))
    return validate.without_one_primary(table(spark, d, "orders").select(F.col("o_orderkey").alias("record_id")), links)


_RECORDS = f"""{TREE_SQL}, records AS (SELECT code, level, left(code, 8) AS fraccion8, 'v1' AS ligie_version, true AS is_current,
    CASE WHEN length(code) >= 8 AND right(code, 2)::INT % 4 <> 0 THEN 'u' || (right(code, 2)::INT % 3) END AS unit_code FROM tree)"""


def _records(spark: SparkSession, d: str) -> DataFrame:
    last = F.substring("code", -2, 2).cast("int")
    unit = F.when((F.length("code") >= 8) & (last % 4 != 0), F.concat(F.lit("u"), (last % 3).cast("string")))
    return inputs.tree(spark, d).select("code", "level", F.substring("code", 1, 8).alias("fraccion8"), F.lit("v1").alias("ligie_version"), F.lit(True).alias("is_current"), unit.alias("unit_code"))


@_query(f"""WITH {_RECORDS} SELECT n.code, n.unit_code, f.unit_code AS parent_unit_code FROM records n JOIN records f ON f.level = 'fraccion8' AND f.code = n.fraccion8
  WHERE n.level = 'nico10' AND n.unit_code IS DISTINCT FROM f.unit_code""")
def value_mismatch(spark: SparkSession, d: str) -> DataFrame:
    return validate.value_mismatches(_records(spark, d), ["unit_code"]).select("code", "unit_code", F.col("_unit_code").alias("parent_unit_code"))


def _fold_sql(column: str) -> str:
    return f"trim(regexp_replace(replace(lower(strip_accents({column})), 'ß', 'ss'), '\\s+', ' ', 'g'))"


def _score_sql(tokens: list[str], text_sql: str) -> str:
    return " + ".join(f"contains({text_sql}, '{t}')::INT" for t in tokens)


def _search_sql(query: list[str], code: str | None = None) -> str:
    exact, prefix = (f"code = '{code}'", f"starts_with(code, '{code}')") if code else ("false", "false")
    return f"""{TREE_SQL}, m AS (SELECT *, {_score_sql(query, _fold_sql('description'))} AS m FROM tree), scored AS (
      SELECT code, description, level, CASE WHEN {exact} THEN 1000 WHEN {prefix} THEN 700 WHEN m > 0 THEN 300 + 25 * m + CASE WHEN m = {len(query)} THEN 5 ELSE 0 END END AS score,
        CASE WHEN {exact} THEN 'exact_code' WHEN {prefix} THEN 'code_prefix' ELSE 'description' END AS match_kind,
        CASE WHEN {exact} THEN 1.0 WHEN {prefix} THEN 0.85 ELSE m / {float(len(query))} END::DOUBLE AS confidence FROM m WHERE {exact} OR {prefix} OR m > 0)"""


_TEXT = "Réd widget small"


def _nodes(spark: SparkSession, d: str) -> DataFrame:
    return inputs.tree(spark, d).withColumn("folded", text.fold("description"))


_HIT = ["code", "description", "level", "score", "match_kind", "confidence"]


@_query(f"""WITH {_search_sql(text.folded(_TEXT).split())}, b AS (SELECT *, max(score) OVER (PARTITION BY left(code, 2)) AS best FROM scored)
  SELECT code, description, level, score, match_kind, confidence FROM b ORDER BY best DESC, score DESC, code, description LIMIT 50""")
def search_text_topk(spark: SparkSession, d: str) -> DataFrame:
    return search.search(_nodes(spark, d), _TEXT, limit=50).select(*_HIT)


_SQL["search_indexed"] = _SQL["search_text_topk"]
_QUERIES["search_indexed"] = records_catalog.search_indexed


@_query(f"WITH {_search_sql(['07'], '07')} SELECT * FROM scored ORDER BY score DESC, code, description LIMIT 50")
def search_code_topk(spark: SparkSession, d: str) -> DataFrame:
    return search.search(_nodes(spark, d), "07", limit=50).select(*_HIT)


_SUGGEST = """, p AS (SELECT *, max(CASE WHEN length(code) = 8 THEN 1 ELSE 0 END) OVER () AS any_fraction FROM {source})
  SELECT code, description, level, score, match_kind, confidence FROM p WHERE any_fraction = 0 OR length(code) = 8 ORDER BY best DESC, score DESC, code, description LIMIT 5"""
_BEST = ", b AS (SELECT *, max(score) OVER (PARTITION BY left(code, 2)) AS best FROM scored)"


@_query(f"WITH {_search_sql(text.folded(_TEXT).split())}{_BEST}" + _SUGGEST.format(source="b"))
def suggest_preferred(spark: SparkSession, d: str) -> DataFrame:
    return search.suggest(_nodes(spark, d), _TEXT, limit=5).select(*_HIT)


@_query(f"WITH {_search_sql(text.folded(_TEXT).split())}{_BEST}, top AS (SELECT * FROM b ORDER BY best DESC, score DESC, code, description LIMIT 50)" + _SUGGEST.format(source="top"))
def suggest_capped(spark: SparkSession, d: str) -> DataFrame:
    return search.suggest(_nodes(spark, d), _TEXT, limit=5, ranking=50).select(*_HIT)


@_query("SELECT p_partkey, p_name, CASE WHEN starts_with(p_partkey::VARCHAR, '12') THEN 100 ELSE 50 END AS score FROM part WHERE p_name ILIKE '%re%n_c%' OR starts_with(p_partkey::VARCHAR, '12')")
def ilike_search(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "part").select("p_partkey", "p_name", F.col("p_partkey").cast("string").alias("code"))
    return search.matching(rows, "re%n_c", code="12", description="p_name").select("p_partkey", "p_name", "score")


_STOP = list(text.STOPWORDS)


@_query(f"""WITH t AS (SELECT p_partkey, p_name, p_type, lower(p_name) AS a, lower(p_type) || ' ' || lower(p_brand) || ' ' || split_part(lower(p_name), ' ', 1) || ' ' || split_part(lower(p_name), ' ', 2) AS b FROM part), k AS (
    SELECT *, list_filter(list_distinct(regexp_extract_all(a, '[a-z0-9]+')), lambda w: length(w) > 2 AND NOT list_contains({_STOP!r}, w)) AS x,
      list_filter(list_distinct(regexp_extract_all(b, '[a-z0-9]+')), lambda w: length(w) > 2 AND NOT list_contains({_STOP!r}, w)) AS y FROM t)
  SELECT p_partkey, len(list_intersect(x, y))::INT AS shared, contains(a, b) OR contains(b, a) OR (least(len(x), len(y)) > 0 AND len(list_intersect(x, y)) >= greatest(2, least(len(x), len(y)) // 2)) AS consistent FROM k""")
def token_overlap(spark: SparkSession, d: str) -> DataFrame:
    name = F.lower("p_name")
    other = F.concat_ws(" ", F.lower("p_type"), F.lower("p_brand"), F.split_part(name, F.lit(" "), F.lit(1)), F.split_part(name, F.lit(" "), F.lit(2)))
    rows = table(spark, d, "part").select("p_partkey", name.alias("a"), other.alias("b"))
    shared = F.size(F.array_intersect(text.description_tokens(F.col("a")), text.description_tokens(F.col("b"))))
    return rows.select("p_partkey", shared.alias("shared"), text.consistent(F.col("a"), F.col("b")).alias("consistent"))


@_query(f"SELECT doc_id, md5({_fold_sql('text')}) AS folded_md5, length({_fold_sql('text')})::INT AS n FROM documents")
def fold_text(spark: SparkSession, d: str) -> DataFrame:
    folded = table(spark, d, "documents").select("doc_id", text.fold("text").alias("folded"))
    return folded.select("doc_id", F.md5(F.col("folded").cast("binary")).alias("folded_md5"), F.length("folded").alias("n"))


@_query("""WITH s AS (SELECT doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS w FROM documents), h AS (
    SELECT doc_id, w, CASE WHEN regexp_replace(regexp_extract(w, '^([^;.:]*)', 1), '[ \\t\\r\\n;.:]+$', '') = '' THEN w ELSE regexp_replace(regexp_extract(w, '^([^;.:]*)', 1), '[ \\t\\r\\n;.:]+$', '') END AS c FROM s)
  SELECT doc_id, CASE WHEN w = '' THEN NULL ELSE rtrim(CASE WHEN length(c) <= 120 THEN c WHEN regexp_extract(left(c, 121), '^(.+) ', 1) <> '' THEN regexp_extract(left(c, 121), '^(.+) ', 1) ELSE left(c, 120) END) END AS name FROM h""")
def derive_names(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", text.derived_name(F.col("text")).alias("name"))


@_query("""WITH e AS (SELECT event_id, user_id, ts, CASE WHEN event_id % 3 = 0 THEN event_type ELSE '' END AS cell FROM events)
  SELECT event_id, user_id, last_value(CASE WHEN trim(cell) <> '' THEN cell END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS cell FROM e""")
def forward_fill(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events").select("event_id", "user_id", "ts", F.when(F.col("event_id") % 3 == 0, F.col("event_type")).otherwise("").alias("cell"))
    return hierarchy.forward_filled(rows, "cell", order=[F.col("ts"), F.col("event_id")], partition=["user_id"]).drop("ts")


@_query("""WITH a AS (SELECT o_orderkey, o_orderstatus AS s FROM orders WHERE o_orderkey % 7 <> 0), b AS (SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 3 THEN 'X' WHEN o_orderkey % 10 = 4 THEN NULL ELSE o_orderstatus END AS s FROM orders WHERE o_orderkey % 5 <> 0)
  SELECT o_orderkey, a.s AS previous_s, b.s AS current_s, CASE WHEN a.o_orderkey IS NULL THEN 'added' WHEN b.o_orderkey IS NULL THEN 'removed' ELSE 'updated' END AS change
  FROM a FULL JOIN b USING (o_orderkey) WHERE a.o_orderkey IS NULL OR b.o_orderkey IS NULL OR a.s IS DISTINCT FROM b.s""")
def snapshot_diff(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").select("o_orderkey", F.col("o_orderstatus").alias("s"))
    key = F.col("o_orderkey")
    after = rows.where(key % 5 != 0).withColumn("s", F.when(key % 10 == 3, "X").when(key % 10 != 4, F.col("s")))
    return diff.snapshot_diff(rows.where(key % 7 != 0), after, ["o_orderkey"], ["s"])


@_query("""WITH l AS (SELECT DISTINCT l_suppkey AS dataset_key, l_returnflag AS document_role FROM lineitem)
  SELECT sha256('[' || string_agg('{"dataset_key":' || dataset_key || ',"document_role":"' || document_role || '"}', ',' ORDER BY dataset_key, document_role) || ']') AS digest FROM l""")
def identity_digest(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("dataset_key"), F.col("l_returnflag").alias("document_role")).distinct()
    return diff.identity_digest(rows, ["dataset_key", "document_role"])


_EVENTS = list(diff.JOBS)


@_query(f"""WITH route(event_type, step, job) AS (VALUES {", ".join(f"('{e}', {k}, '{j}')" for e, jobs in diff.JOBS.items() for k, j in enumerate(jobs))}),
  c AS (SELECT event_id AS position, list_extract({_EVENTS!r}, (event_id % {len(_EVENTS)} + 1)::INT) AS event_type FROM events),
  f AS (SELECT job, min((position, step)) AS p FROM c JOIN route USING (event_type) GROUP BY job) SELECT job, p[1] AS position, p[2] AS step FROM f""")
def change_routing(spark: SparkSession, d: str) -> DataFrame:
    kind = F.element_at(F.array(*map(F.lit, _EVENTS)), (F.col("event_id") % len(_EVENTS) + 1).cast("int"))
    changes = table(spark, d, "events").select(F.col("event_id").alias("position"), kind.alias("event_type"))
    return diff.routed_jobs(changes)


_HREF_SQL = r"""(?is)<a\s[^>]*?href\s*=\s*["'']([^"'']*)["''][^>]*>"""


@_query(f"""WITH l AS (SELECT page_id, url, list_distinct(list_transform(regexp_extract_all(html, '{_HREF_SQL}', 1), lambda x: trim(x))) AS u FROM pages), x AS (SELECT page_id, unnest(u) AS href FROM l)
  SELECT page_id, replace(href, '&amp;', '&') AS href FROM x WHERE href <> '' AND NOT starts_with(href, '#')""")
def page_links(spark: SparkSession, d: str) -> DataFrame:
    return html.links(table(spark, d, "pages"), frames=False).select("page_id", "href")


@_query("""SELECT source, lang, doc_id, n_chars FROM (SELECT *, row_number() OVER (PARTITION BY source, lang ORDER BY n_chars DESC NULLS LAST, doc_id) AS k FROM documents) WHERE k = 1""")
def best_per_key(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").select("source", "lang", "doc_id", "n_chars")
    return evaluate.first_of_each(rows, ["source", "lang"], [F.desc_nulls_last("n_chars"), F.asc("doc_id")])


@_query("""WITH t AS (SELECT o_custkey, 'LIGIE_' || strftime(o_orderdate, '%Y%m%d') || '_' || (o_orderkey % 3) || CASE WHEN o_orderkey % 9 = 0 THEN '_x' ELSE '' END AS title, CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_orderdate::DATE END AS day FROM orders),
  r AS (SELECT o_custkey, max(day) AS latest, count(*) AS rows, count(*) FILTER (day IS NULL) AS undated FROM t GROUP BY 1), n AS (SELECT o_custkey, day AS latest, count(*) AS n FROM t WHERE day IS NOT NULL GROUP BY ALL)
  SELECT o_custkey, latest, rows, undated, coalesce(n, 0) AS n, rows = 1 OR (undated = 0 AND coalesce(n, 0) = 1) AS is_unique FROM r LEFT JOIN n USING (o_custkey, latest)""")
def latest_dated_unique(spark: SparkSession, d: str) -> DataFrame:
    stamp = F.when(F.col("o_orderkey") % 17 == 0, "99999999").otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
    title = F.concat(F.lit("LIGIE_"), stamp, F.lit("_"), (F.col("o_orderkey") % 3).cast("string"))
    rows = table(spark, d, "orders").select("o_custkey", dates.latest_snapshot(title).alias("day"))
    return evaluate.latest_unique(rows, ["o_custkey"], "day")


@_query(f"""WITH {TREE_SQL}, kept AS (SELECT code FROM tree WHERE length(code) = 8 OR (length(code) = 10 AND n_parts % 2 = 1)), f AS (SELECT code, EXISTS (SELECT 1 FROM kept n WHERE length(n.code) = 10 AND left(n.code, 8) = k.code) AS has, right(code, 1) = '3' AS known FROM kept k WHERE length(code) = 8)
  SELECT count(*) AS fraccion8, count(*) FILTER (has) AS with_nico_descendant, count(*) FILTER (NOT has) AS missing_nico_descendant, count(*) FILTER (NOT has AND known) AS known_upstream_lag, count(*) FILTER (NOT has AND NOT known) AS unclassified_missing FROM f""")
def coverage_report(spark: SparkSession, d: str) -> DataFrame:
    kept = inputs.tree(spark, d).where((F.length("code") == 8) | ((F.length("code") == 10) & (F.col("n_parts") % 2 == 1))).select("code")
    return evaluate.coverage(kept, kept.where((F.length("code") == 8) & F.col("code").endswith("3")))


@_query("""WITH x AS (SELECT doc_id % 4 = 0 AS abstained, toxic = ((doc_id + 1) % 3) OR toxic = (doc_id % 2) AS hit FROM labels), y AS (SELECT count(*) AS t, count(*) FILTER (NOT abstained) AS a, count(*) FILTER (NOT abstained AND hit) AS h FROM x)
  SELECT t AS total_cases, a AS answered_cases, t - a AS abstentions, a / t AS coverage, h / t AS top_k_recall, CASE WHEN a > 0 THEN h / a ELSE 0.0 END AS selective_top_k_recall FROM y""")
def topk_recall(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "labels")
    cases = rows.select(F.col("doc_id").alias("case_id"), F.col("toxic").cast("long").alias("gold"))
    predictions = rows.select(F.col("doc_id").alias("case_id"), F.array((F.col("doc_id") + 1) % 3, F.col("doc_id") % 2, F.lit(7).cast("long")).alias("candidates"), (F.col("doc_id") % 4 == 0).alias("abstained"))
    return evaluate.top_k_recall(cases, predictions, top_k=2)


@_query(f"""WITH {CLASSIFICATION_SQL} SELECT count(*) - count(DISTINCT k % 5000) AS duplicate_record_ids, count(*) FILTER (status = 'F') AS blank_status, count(*) FILTER (valid_from > valid_to - 500) AS reversed_intervals,
  count(*) FILTER (valid_from IS NULL OR valid_to IS NULL) AS open_intervals FROM classification""")
def validation_summary(spark: SparkSession, d: str) -> DataFrame:
    rows = inputs.classifications(spark, d).withColumn("record_id", F.col("k") % 5000)
    return validate.single_pass(rows, {"blank_status": F.col("status") == "F", "reversed_intervals": F.col("valid_from") > F.date_sub("valid_to", 500), "open_intervals": F.col("valid_from").isNull() | F.col("valid_to").isNull()})


@_query("""WITH o AS (SELECT p_partkey, p_name, p_type, p_brand FROM part), t AS (SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN upper(p_name) ELSE p_name END AS p_name, p_type, CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE p_brand END AS p_brand FROM part WHERE p_partkey % 6 <> 0)
  SELECT p_partkey, 'p_name' AS field, o.p_name AS ours, t.p_name AS theirs, o.p_name IS NOT DISTINCT FROM t.p_name AS match FROM o JOIN t USING (p_partkey)
  UNION ALL SELECT p_partkey, 'p_type', o.p_type, t.p_type, o.p_type IS NOT DISTINCT FROM t.p_type FROM o JOIN t USING (p_partkey)
  UNION ALL SELECT p_partkey, 'p_brand', o.p_brand, t.p_brand, o.p_brand IS NOT DISTINCT FROM t.p_brand FROM o JOIN t USING (p_partkey)
  UNION ALL SELECT p_partkey, 'present', 'yes', NULL, false FROM o WHERE p_partkey % 6 = 0""")
def compare_unpivot(spark: SparkSession, d: str) -> DataFrame:
    ours = table(spark, d, "part").select("p_partkey", "p_name", "p_type", "p_brand")
    key = F.col("p_partkey")
    theirs = ours.where(key % 6 != 0).withColumns({"p_name": F.when(key % 3 == 0, F.upper("p_name")).otherwise(F.col("p_name")), "p_brand": F.when(key % 4 != 0, F.col("p_brand"))})
    return evaluate.field_comparison(ours, theirs, "p_partkey", ["p_name", "p_type", "p_brand"])


@_query("""SELECT event_id, (props->>'k')::INT AS k, '{"event_id":' || event_id || ',"k":' || (props->>'k') || ',"type":"' || event_type || '"}' AS payload FROM events""")
def json_payload(spark: SparkSession, d: str) -> DataFrame:
    k = F.from_json("props", "k int")["k"]
    rows = table(spark, d, "events").select("event_id", "event_type", k.alias("k"))
    return rows.select("event_id", "k", F.to_json(F.struct("event_id", "k", F.col("event_type").alias("type")), {"ignoreNullFields": "false"}).alias("payload"))


_CENT = "floor(({}  + 2.220446049250313e-16) * 100 + 0.5) / 100"


@_query(f"""WITH a AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice AS v, {_CENT.format('l_extendedprice * (l_discount * 100) / 100')} AS igi, {_CENT.format('l_extendedprice * 0.8 / 100')} AS dta FROM lineitem),
  b AS (SELECT *, {_CENT.format('v + igi + dta + 0.0')} AS iva_base FROM a), c AS (SELECT *, {_CENT.format('iva_base * 16.0::DOUBLE / 100')} AS iva FROM b), e AS (SELECT *, {_CENT.format('igi + dta + 0.0 + iva')} AS total_contributions FROM c)
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, igi, dta, iva_base, iva, total_contributions, {_CENT.format('v + total_contributions')} AS landed_cost FROM e""")
def landed_cost(spark: SparkSession, d: str) -> DataFrame:
    parts = trade.import_estimate(F.col("l_extendedprice"), F.col("l_discount") * 100, F.lit(0.8), F.lit(0.0), F.lit(16.0))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *[c.alias(n) for n, c in parts.items() if n != "ieps"])


@_query("""WITH x AS (SELECT o_orderkey, o_orderstatus <> 'P' AS applies, o_totalprice > 150000 AS a, o_orderpriority LIKE '1%' AS b FROM orders)
  SELECT o_orderkey, list_filter([CASE WHEN a THEN NULL ELSE 'value' END, CASE WHEN b THEN NULL ELSE 'origin' END], lambda x: x IS NOT NULL)::VARCHAR AS missing,
    CASE WHEN NOT applies THEN 'not_applicable' WHEN a AND b THEN 'complete' WHEN a OR b THEN 'partial' ELSE 'missing' END AS status FROM x""")
def evidence_matrix(spark: SparkSession, d: str) -> DataFrame:
    have = {"value": F.col("o_totalprice") > 150000, "origin": F.col("o_orderpriority").like("1%")}
    listed = F.concat(F.lit("["), F.array_join(trade.missing(have), ", "), F.lit("]"))
    return table(spark, d, "orders").select("o_orderkey", listed.alias("missing"), trade.status(have, applies=F.col("o_orderstatus") != "P").alias("status"))


@_query("""WITH r AS (SELECT o_orderkey, strftime(o_orderdate, 'data-%Y.%m') AS tag, o_totalprice FROM orders), a AS (SELECT max(tag) AS tag FROM r) SELECT tag, o_orderkey, o_totalprice FROM r JOIN a USING (tag)""")
def active_release(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").select("o_orderkey", F.date_format("o_orderdate", "'data-'yyyy.MM").alias("tag"), "o_totalprice")
    pointer = rows.agg(F.max("tag").alias("tag"))  # one row
    return rows.join(F.broadcast(pointer), "tag").select("tag", "o_orderkey", "o_totalprice")


@_query("""SELECT c_custkey, roman AS section, chapter FROM (SELECT c_custkey, lpad((c_custkey % 98 + 1)::VARCHAR, 2, '0') AS chapter FROM customer) LEFT JOIN (VALUES """ + _SECTIONS + """) s(roman, a, b) ON chapter BETWEEN a AND b""")
def section_of_chapter(spark: SparkSession, d: str) -> DataFrame:
    chapter = F.lpad((F.col("c_custkey") % 98 + 1).cast("string"), 2, "0")
    return hierarchy.with_section(table(spark, d, "customer").select("c_custkey", chapter.alias("chapter")), F.col("chapter"))


@_query("""WITH q AS (SELECT o_orderstatus AS role, o_orderdate::DATE AS day FROM orders), e AS (SELECT o_orderstatus AS role, o_orderdate::DATE AS day FROM orders WHERE o_orderkey % 3 = 0)
  SELECT DISTINCT 'missing_dof_evidence:' || role || ':' || day AS discrepancy FROM q WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.role = q.role AND e.day = q.day)""")
def reconcile_evidence(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").select("o_orderkey", F.col("o_orderstatus").alias("role"), F.to_date("o_orderdate").alias("day"))
    required = rows.select("role", "day").distinct()
    return evaluate.reconciliation(required, rows.where(F.col("o_orderkey") % 3 == 0).select("role", "day"))


_PAGE_NOTES = "'<h2>' || CASE WHEN page_id % 3 = 0 THEN 'Sección II' ELSE 'Capítulo ' || (page_id % 97 + 1) END || '</h2><p>0 no note</p><p>1. Nota <b>' || page_id || '</b></p><p>que sigue</p><p>2. Otra &amp; más</p><h2>TRANSITORIOS</h2><p>3. fuera</p>'"


@_query("""WITH p AS (SELECT page_id, page_id % 3 = 0 AS s, lpad((page_id % 97 + 1)::VARCHAR, 2, '0') AS c FROM pages), n AS (SELECT page_id, s, c, unnest(['1', '2']) AS note_number FROM p)
  SELECT unnest(CASE WHEN s THEN ['06', '07', '08', '09', '10', '11', '12', '13', '14'] ELSE [c] END) AS chapter, CASE WHEN s THEN 'section' ELSE 'chapter' END AS scope_type, CASE WHEN s THEN 'II' ELSE c END AS scope_value, note_number,
    CASE note_number WHEN '1' THEN 'Nota ' || page_id || ' que sigue' ELSE 'Otra & más' END AS text, 'p-' || page_id AS source_document_id FROM n""")
def notes_of_pages(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "pages").select(F.concat(F.lit("p-"), F.col("page_id").cast("string")).alias("source_document_id"), F.expr(_PAGE_NOTES).alias("html"))
    return html.national_notes(rows)


@_query("""WITH p AS (SELECT page_id, page_id % 3 = 0 AS s, lpad((page_id % 97 + 1)::VARCHAR, 2, '0') AS c FROM pages), n AS (SELECT page_id, s, c, unnest(['1', '2']) AS note_number FROM p WHERE s OR c = '07')
  SELECT note_number, CASE WHEN s THEN 'section' ELSE 'chapter' END AS scope_type, CASE note_number WHEN '1' THEN 'Nota ' || page_id || ' que sigue' ELSE 'Otra & más' END AS text, 'p-' || page_id AS source_document_id FROM n""")
def notes_by_chapter(spark: SparkSession, d: str) -> DataFrame:
    return views.notes_of_chapter(notes_of_pages(spark, d), "07").select("note_number", "scope_type", "text", "source_document_id")


@_query(f"""WITH {TREE_SQL} SELECT code, level, CASE WHEN length(code) < 8 THEN 'hs_version' WHEN length(code) = 8 THEN 'fraction_version' ELSE 'nico_version' END AS "table" FROM tree""")
def level_routing(spark: SparkSession, d: str) -> DataFrame:
    return hierarchy.in_level_order(hierarchy.routed(inputs.tree(spark, d).select("code", "level")))


_LISTS = """CASE event_id % 6 WHEN 0 THEN '["a", "b-' || user_id || '"]' WHEN 1 THEN '{"a": 1}' WHEN 2 THEN '[1, "a"]' WHEN 3 THEN '[]' WHEN 4 THEN 'no json' END"""


@_query("""SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'a,b-' || user_id WHEN 3 THEN '' END AS ids, event_id % 6 = 0 AS has_a FROM events""")
def json_id_list(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events").select("event_id", F.expr(_LISTS).alias("j"))
    return rows.select("event_id", F.array_join(lists.id_list(F.col("j")), ",").alias("ids"), lists.listed(F.col("j"), F.lit("a")).alias("has_a"))


@_query("""WITH r AS (SELECT strftime(o_orderdate, 'data-%Y.%m.%d') AS tag, o_orderdate::DATE AS day FROM orders WHERE o_orderstatus <> 'F' AND o_orderkey % 5 <> 0 AND o_orderkey % 4 = 0)
  SELECT DISTINCT tag, day FROM r WHERE day = (SELECT max(day) FROM r)""")
def newest_release(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("o_orderkey")
    rows = table(spark, d, "orders").select(F.when(key % 4 == 0, F.date_format("o_orderdate", "'data-'yyyy.MM.dd")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("tag"), (F.col("o_orderstatus") == "F").alias("draft"), (key % 5 == 0).alias("prerelease"))
    return evaluate.newest_release(rows).select("tag", "day")


@_query("""WITH b(code, allowed) AS (VALUES ('purchase', 3), ('view', 1000000000)), n AS (SELECT event_type AS code, count(*) AS n FROM events GROUP BY 1)
  SELECT code, n, coalesce(allowed, 0)::BIGINT AS allowed FROM n LEFT JOIN b USING (code) WHERE n > coalesce(allowed, 0)""")
def error_budget(spark: SparkSession, d: str) -> DataFrame:
    budget = spark.createDataFrame([("purchase", 3), ("view", 1_000_000_000)], "code string, allowed long")
    return evaluate.over_budget(table(spark, d, "events").select(F.col("event_type").alias("code")), budget)


@_query(f"""WITH {TREE_SQL}, r AS (SELECT level, CASE right(code, 1) WHEN '1' THEN 'fraccion8' WHEN '2' THEN 'hs6' END AS v FROM tree WHERE level IN ('fraccion8', 'nico10'))
  SELECT count(*) FILTER (v <> 'fraccion8') AS built, count(*) FILTER (v IS DISTINCT FROM 'fraccion8') AS certified FROM r""")
def value_origin(spark: SparkSession, d: str) -> DataFrame:
    last = F.substring("code", -1, 1)
    none = F.lit(None).cast("string")
    rows = inputs.tree(spark, d).where(F.length("code") >= 8).select("level", "code", F.when(last == "1", "fraccion8").when(last == "2", "hs6").alias("values_from_level"), *[none.alias(c) for c in ("unit_code", "igi_text", "ige_text")])
    n = lambda c: F.count(F.when(c, 1))
    return rows.agg(n(validate.row_checks()["invalid_value_origin"]).alias("built"), n(validate.certified_origin()).alias("certified"))


def queries() -> dict[str, Query]:
    return _QUERIES | records_catalog.QUERIES


def oracle_sql() -> dict[str, str]:
    return _SQL | records_catalog.SQL
