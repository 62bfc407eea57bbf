"""Operators on small hand-made tables."""

import datetime as dt
import hashlib
import json
from decimal import Decimal

import pytest
from codespine.functions import codes, dates, duty, hashing, text, trade
from codespine.operators import consolidate, diff, evaluate, hierarchy, search, validate
from codespine.sources import html, sheets
from pyspark.sql import functions as F

TREE = [
    ("r-hs2", "01", "hs2", "Animales vivos"),
    ("r-hs4", "0101", "hs4", "Caballos, asnos, mulos y burdéganos, vivos"),
    ("r-hs6", "010121", "hs6", "Reproductores de raza pura"),
    ("r-frac", "01012101", "fraccion8", "Reproductores de raza pura"),
    ("r-nico", "0101210100", "nico10", "Reproductores de raza pura"),
]


@pytest.fixture(scope="module")
def records(spark):
    df = spark.createDataFrame(TREE, "record_id string, code string, level string, description string")
    return df.withColumns({"folded": text.fold("description"), "is_current": F.lit(True)})


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(f(F.col("v")).alias("r")).first().r


@pytest.mark.parametrize(("value", "want"), [("0101.21.01", "01012101"), ("01 01", "0101"), ("1", None), ("01-01", None), ("", None), (None, None), ("01012", None)])
def test_ingest_digits(spark, value, want):
    assert one(spark, value, codes.ingest_digits) == want


def test_other_code_functions(spark):
    assert one(spark, "01-01", codes.query_digits) == "0101"
    assert one(spark, "7", lambda c: codes.ingest_digits(c, 2)) == "07" and one(spark, "123", lambda c: codes.ingest_digits(c, 2)) is None
    shown = {"01": "01", "0101": "01.01", "010121": "0101.21", "01012101": "0101.21.01", "0101210100": "0101.21.01 00"}
    for code, want in shown.items():
        assert one(spark, code, codes.formatted) == want
    assert one(spark, "010121", codes.paired) == "01.01.21" and one(spark, "01", codes.parent) is None and one(spark, "0101", codes.parent) == "01"
    assert one(spark, "5", lambda c: codes.nico_code(F.lit("01012101"), c)) == "0101210105" and one(spark, "123", lambda c: codes.nico_code(F.lit("01012101"), c)) is None


LITERALS = [("10%", "ad_valorem", 10), ("Ex.", "exento", 0), ("Prohibida", "prohibida", None), ("0.36 USD/Kg", "especifica", None), ("10% + 0.36 USD/Kg", "compuesta", None), ("según decreto", "desconocida", None), (None, None, None), ("  ", None, None), ("12,5", "ad_valorem", Decimal("12.5")), ("exentas", "exento", 0)]


@pytest.mark.parametrize(("literal", "kind", "value"), LITERALS)
def test_duties(spark, literal, kind, value):
    parts = duty.parsed(F.col("v"))
    r = spark.createDataFrame([(literal,)], "v string").select(parts["kind"].alias("k"), parts["value"].alias("x")).first()
    assert (r.k, r.x) == (kind, value)


def test_comparable_duties(spark):
    assert [one(spark, v, duty.comparable) for v in ("ex.", "10 %", "1,5", "libre", None)] == ["ex", "10", "1.5", "libre", ""]


@pytest.mark.parametrize(("description", "name"), [("Caballos; asnos", "Caballos"), (". x", ". x"), ("  ", None), ("a" * 130, "a" * 120), ("ab " * 60, ("ab " * 40).strip()), ("uno\xa0 dos:", "uno dos")])
def test_names(spark, description, name):
    assert one(spark, description, text.derived_name) == name


def test_folding(spark):
    assert one(spark, "  Straße  ÁÑ½ ", text.fold) == "strasse an1⁄2" and one(spark, None, text.fold) == "" and one(spark, " É  x", text.fold_case_kept) == "E x"
    assert one(spark, "Imp. de\nImportación", text.header_key) == "IMP DE IMPORTACION"
    pair = spark.createDataFrame([("caballos de raza pura", "raza pura vivos"), ("mesa", "mesas de pino"), ("uno", "dos"), ("", "x")], "a string, b string")
    assert [r.c for r in pair.select(text.consistent(F.col("a"), F.col("b")).alias("c")).collect()] == [True, True, False, True]


def test_hashes_are_the_json_modules(spark):
    row = ("nico10", '01"\\é\n', Decimal("1.500000"), None, dt.date(2022, 6, 7), 2, True)
    df = spark.createDataFrame([row], "level string, code string, igi_value decimal(18,6), name string, effective_from date, record_version int, flag boolean")
    fields = tuple(df.columns)
    payload = dict(zip(fields, ("nico10", '01"\\é\n', "1.5", None, "2022-06-07", 2, True), strict=True))
    got = df.select(hashing.canonical_object(df, fields).alias("o"), hashing.canonical_list(df, fields).alias("l"), hashing.digest(hashing.canonical_object(df, fields)).alias("d")).first()
    want = json.dumps(payload, ensure_ascii=False, separators=(",", ":"))
    assert got.o == want and got.l == json.dumps(list(payload.values()), ensure_ascii=False, separators=(",", ":")) and got.d == hashlib.sha256(want.encode()).hexdigest()


def test_dates(spark):
    assert one(spark, "LIGIE_20220607 x 20229999 123456789", dates.latest_snapshot) == dt.date(2022, 6, 7)
    assert one(spark, "DOF 07-06-2022", dates.numeric_date) == dt.date(2022, 6, 7) and one(spark, "el 7 de junio de 2022", dates.named_date) == dt.date(2022, 6, 7)
    assert one(spark, "nada", dates.named_date) is None


def test_landed_cost(spark):
    parts = trade.import_estimate(F.lit(1000.0), F.lit(10.0), F.lit(0.8), F.lit(0.0), F.lit(16.0))
    r = spark.range(1).select(*[c.alias(n) for n, c in parts.items()]).first()
    assert (r.igi, r.dta, r.iva, r.total_contributions, r.landed_cost) == (100, 8, 177.28, 285.28, 1285.28)


def test_tree_questions(records):
    assert [r.code for r in hierarchy.children(records, "01").collect()] == ["0101"] and hierarchy.children(records, "0101210100").count() == 0
    assert hierarchy.lookup(records, "0101.21.01").first().record_id == "r-frac"
    for bad in ("99", "abc", "0101.2"):
        with pytest.raises(hierarchy.QueryError):
            hierarchy.lookup(records, bad)
    card = hierarchy.cards(records).where("code = '01012101'").first()
    assert (card.section, card.parent, json.loads(card.ancestors_json), card.n_children) == ("I", "010121", ["01", "0101", "010121"], 1)
    assert hierarchy.orphans(records.where("code <> '010121'")).first().code == "01012101"
    assert hierarchy.chapters(records).count() == 1
    with pytest.raises(hierarchy.QueryError):
        hierarchy.chapters(records.union(records))
    assert hierarchy.deduplicated(records.union(records).select("code", "description"), "code").count() == 5
    with pytest.raises(hierarchy.QueryError):
        hierarchy.deduplicated(records.select("description", "code"), "description")


def test_search_keeps_the_first_rows_of_all_chapters(spark):
    rows = [(f"{1 + k % 7:02d}" + f"{k * 37 % 90 + 10}" * (k % 4), " ".join(w for n, w in enumerate(("red", "small", "old")) if k * 7 % 11 >> n & 1)) for k in range(180)]
    df = spark.createDataFrame([(c, t, t) for c, t in rows * 2], "code string, description string, folded string")
    hits = [(300 + 25 * n + 5 * (n == 2), c, t) for c, t in rows * 2 if (n := ("red" in t) + ("small" in t))]
    best = {}
    for n, c, _ in hits:
        best[c[:2]] = max(n, best.get(c[:2], 0))
    ordered = [c for n, c, t in sorted(hits, key=lambda h: (-best[h[1][:2]], -h[0], h[1], h[2]))]
    for limit in (1, 3, 40):
        found = search.search(df, "red small", limit=limit)
        assert [r.code for r in found.collect()] == ordered[:limit]
        assert [r.code for r in search.suggest(df, "red small", limit=limit).collect()] == [c for c in ordered if len(c) == 8][:limit]
    assert "WindowGroupLimit" in found._jdf.queryExecution().executedPlan().toString()


def test_search(records):
    hits = search.search(records, "0101.21", limit=9).select("code", "score", "match_kind", "confidence").collect()
    assert [(h.code, h.score) for h in hits] == [("010121", 1000), ("01012101", 700), ("0101210100", 700)] and hits[1].confidence == 0.85
    hits = search.search(records, "raza PURA perros", limit=2).collect()
    assert [(h.code, h.score, round(h.confidence, 3)) for h in hits] == [("010121", 350, 0.667), ("01012101", 350, 0.667)]
    assert search.search(records, "burdeganos", limit=1).first().score == 330
    assert [h.code for h in search.suggest(records, "raza", limit=5).collect()] == ["01012101"] and [h.code for h in search.suggest(records, "vivos", limit=5).collect()] == ["01", "0101"]
    assert [h.code for h in search.suggest(records, "raza", limit=5, ranking=1).collect()] == ["010121"]
    for bad in ("", "  "):
        with pytest.raises(hierarchy.QueryError):
            search.search(records, bad, limit=1)
    with pytest.raises(hierarchy.QueryError):
        search.search(records, "x", limit=0)


def revisions(spark, rate_from="2022-01-01", codes8=("01012101",)):
    day = lambda s: s and dt.date.fromisoformat(s)
    rows = [("fraccion8", "0101.21.01", "Reproductores; puros", "2022", "legal", None, None, day("2022-06-01"), None, "s1"), ("nico10", "0101210100", "Caballos", "2022", "legal", None, None, day("2022-07-01"), day("2023-01-01"), "s2"), ("hs2", "01", "Animales vivos", "2022", "observed_snapshot", None, None, None, None, "s1")]
    c = spark.createDataFrame(rows, "level string, code string, description string, ligie_version string, validity_basis string, updated_at date, published_at date, classification_effective_from date, classification_effective_to date, source_document_id string")
    rates = [(k, "2022", "01", "Cbza", "10", "ad_valorem", Decimal(10), "Ex.", "exento", Decimal(0), dt.date(2022, 1, 2), None, day(rate_from), None, "s3") for k in codes8]
    r = spark.createDataFrame(rates, "code string, ligie_version string, unit_code string, unit_name string, igi_text string, igi_kind string, igi_value decimal(18,6), ige_text string, ige_kind string, ige_value decimal(18,6), updated_at date, published_at date, rate_effective_from date, rate_effective_to date, source_document_id string")
    return c, r


def test_consolidation(spark):
    rows = {r.code: r for r in consolidate.consolidate(*revisions(spark), effective_as_of="2022-08-01", dataset_version="d").collect()}
    item = rows["0101210100"]
    assert (item.effective_from, item.effective_to, item.is_current, item.igi_text, item.values_from_level, item.primary_source_document_id) == (dt.date(2022, 7, 1), dt.date(2023, 1, 1), True, "10", "fraccion8", "s2")
    assert json.loads(item.source_document_ids_json) == ["s1", "s2", "s3"] and rows["01"].is_current and rows["01"].igi_text is None and rows["01012101"].name == "Reproductores"
    assert item.record_version == 1 and len(item.record_hash) == 64 and rows["01012101"].primary_source_document_id == "s3"


@pytest.mark.parametrize("broken", ["rate", "parent", "interval"])
def test_consolidation_fails_closed(spark, broken):
    c, r = revisions(spark, codes8=() if broken == "rate" else ("01012101",), rate_from="2025-01-01" if broken == "interval" else "2022-01-01")
    if broken == "parent":
        c = c.where("level <> 'fraccion8'")
    with pytest.raises(consolidate.ConsolidationError, match=broken):
        consolidate.consolidate(c, r, effective_as_of="2022-08-01", dataset_version="d")


def test_invariants(spark):
    c, r = revisions(spark)
    rows = consolidate.consolidate(c.where("level <> 'hs2'"), r, effective_as_of="2022-08-01", dataset_version="d")
    rows = rows.withColumns({"primary_source_authority": F.lit("a"), "primary_source_url": F.lit("https://x"), "unit_name": F.when(F.col("level") == "nico10", "other").otherwise(F.col("unit_name"))})
    links = rows.select("record_id", F.lit(False).alias("is_primary"))
    counts = validate.report(rows, links)
    broken = {k for k, v in counts.items() if v}
    assert broken == {"nico_parent_value_mismatch", "primary_source_count", "fraction_without_hs6_parent"}
    with pytest.raises(validate.ValidationError):
        validate.require(counts)


def test_overlaps_touch_at_closed_ends(spark):
    d = dt.date
    rows = [("a", d(2022, 1, 1), d(2022, 2, 1), 1), ("a", d(2022, 2, 1), None, 2), ("a", d(2022, 3, 1), None, 3), ("b", None, d(2022, 1, 1), 1), ("b", d(2022, 1, 2), None, 2)]
    df = spark.createDataFrame(rows, "code string, effective_from date, effective_to date, record_version int")
    assert sorted((r.code, r.record_version) for r in validate.overlapping(df, ["code"], ties=["record_version"]).collect()) == [("a", 2), ("a", 3)]


def test_diff_and_routes(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (3, None), (4, "z")], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (2, "Y"), (3, "n"), (5, "w")], "k int, v string")
    assert {(r.k, r.change) for r in diff.snapshot_diff(a, b, ["k"], ["v"]).collect()} == {(2, "updated"), (3, "updated"), (4, "removed"), (5, "added")}
    assert diff.same_rows(a, a) and not diff.same_rows(a, b) and diff.unequal(a, a, ["k"]).count() == 0
    changes = spark.createDataFrame([(0, "national_notes_changed"), (1, "nico_agreement_changed")], "position int, event_type string")
    assert [r.job for r in diff.routed_jobs(changes).collect()] == ["diputados_capture", "dof_verification", "national_notes", "canonical_rebuild", "snice_nico_discovery", "nico_timeline"]
    with pytest.raises(ValueError, match="unknown"):
        diff.routed_jobs(changes.withColumn("event_type", F.lit("?")))


def test_recall(spark):
    cases = spark.createDataFrame([("1", "a"), ("2", "b")], "case_id string, gold string")
    answers = spark.createDataFrame([("1", ["x", "a"], False), ("2", ["b"], True)], "case_id string, candidates array<string>, abstained boolean")
    r = evaluate.top_k_recall(cases, answers, top_k=2).first()
    assert (r.coverage, r.top_k_recall, r.selective_top_k_recall, r.abstentions) == (0.5, 0.5, 1.0, 1)
    for bad in (lambda: evaluate.top_k_recall(cases, answers.limit(1), top_k=1), lambda: evaluate.top_k_recall(cases, answers, top_k=0)):
        with pytest.raises(ValueError, match="prediction|positive"):
            bad()


def test_coverage(spark):
    df = spark.createDataFrame([("01012101",), ("01012102",), ("01012103",), ("01012104",), ("0101210100",)], "code string")
    r = evaluate.coverage(df, spark.createDataFrame([("01012102",), ("01012103",)], "code string")).first()
    assert tuple(r) == (4, 1, 3, 2, 1)


def test_rollup(spark):
    assert evaluate.rollup(spark.createDataFrame([("pass",), ("warn",), ("pass",)], "status string")).first().status == "warn"


PAGE = '<a href="a.pdf">A</a><A class="x" HREF=\'/b/c.xlsx?d=1\'>B</A><iframe src="https://h.mx/f.htm"></iframe><a href="a.pdf">again</a><a href="#top">top</a>'


def test_links(spark):
    pages = spark.createDataFrame([("https://s.mx/p/i.html", PAGE)], "url string, html string")
    found = html.links(pages)
    assert [r.target for r in found.orderBy("position").collect()] == ["https://s.mx/p/a.pdf", "https://s.mx/b/c.xlsx?d=1", "https://h.mx/f.htm"]
    odd = spark.createDataFrame([("https://s.mx/p/q/i.html", '<a href=../x.pdf?a=1&amp;b=2>x</a><a href="">e</a><script>var u = "<a href=no>"; location = "old.xls"</script>')], "url string, html string")
    assert [(r.href, r.target) for r in html.links(odd).collect()] == [("../x.pdf?a=1&b=2", "https://s.mx/p/x.pdf?a=1&b=2")]
    assert "https://s.mx/p/q/old.xls" in [r.target for r in html.raw_links(odd).collect()]
    assert [r.target for r in html.document_links(found, ["S.MX"]).collect()] == ["https://s.mx/p/a.pdf"]
    registry = [{"dataset_key": "ligie", "pages": ["https://s.mx/p/i.html"], "allowed_hosts": ["s.mx"], "media_types": ["application/pdf"], "families": [("snapshot", ["A.*\\.PDF"])]}]
    rows = html.classified(found.select(F.col("url").alias("page"), "target", html.media_type(F.col("target")).alias("media_type")), registry)
    assert [(r.target, r.document_role) for r in rows.where("dataset_key is not null").collect()] == [("https://s.mx/p/a.pdf", "snapshot")]


def test_tables_and_sheets(spark):
    page = "<table><tr><th>Fracción</th><th>D</th></tr><tr><td>0101.21.01</td><td>Puros &amp; <b>vivos</b></td><td>10</td><td>Ex.</td></tr><tr><td>05</td><td>Otros</td></tr><tr><td></td></tr></table>"
    pages = spark.createDataFrame([("https://v.mx/buildHojas1.01012101.html", page)], "url string, html string")
    assert len(pages.select(html.tables("html").alias("t")).first().t[0]) == 3
    assert [(r.item, r.description, r.igi) for r in html.fraction_sheet(pages).orderBy("item").collect()] == [("01012101", "Puros & vivos", "10"), ("0101210105", "Otros", None)]


def test_fractions_after_a_label(spark):
    page = "<table><tr><td>Fracción</td><td>0101.21.01</td><td>Puros</td><td>10</td></tr><tr><td>0101.21.01</td><td>05</td><td>Otros</td></tr><tr><td>x</td><td>10</td></tr></table>"
    pages = spark.createDataFrame([("https://v.mx/buildHojas1.01012101.html", page)], "url string, html string")
    assert [(r.item, r.description, r.igi) for r in html.fraction_sheet(pages).orderBy("item").collect()] == [("01012101", "Puros", "10"), ("0101210105", "Otros", None)]


def test_ledger_labels_and_categories(spark):
    page = '<h3>Leyes</h3><table><tr><td>Original</td><td><a href="ligie_2022_orig_1.pdf">DOF</a><a href="ligie_2022_ref02_1.doc">Word</a></td></tr></table><h3>Otros</h3><table><tr><td>Notas Nacionales 1/2/2023</td><td><a href="n.pdf">PDF</a></td></tr></table>'
    rows = html.ledger(spark.createDataFrame([("https://d.mx/i.htm", page)], "url string, html string")).collect()
    assert [(r.section, r.role, r.category, r.day) for r in rows] == [("Leyes", "dof", "original", None), ("Leyes", "word", "law_reform", None), ("Otros", "pdf", "national_notes", dt.date(2023, 2, 1))]


def test_ledger(spark):
    page = '<table><tr><td>Decreto DOF 07-06-2022</td><td><a href="x/l.pdf">pdf</a></td></tr><tr><td>7 de junio de 2023</td><td><a href="http://dof.mx/n">Nota del DOF</a></td></tr></table>'
    rows = html.ledger(spark.createDataFrame([("https://d.mx/i.htm", page)], "url string, html string")).orderBy("row").collect()
    assert [(r.target, r.role, r.day) for r in rows] == [("https://d.mx/x/l.pdf", "pdf", dt.date(2022, 6, 7)), ("http://dof.mx/n", "dof", dt.date(2023, 6, 7))]


def test_sheet_layouts(spark):
    cells = [["Tarifa", None, None, None], ["Fracción", "Descripción", "Imp.", "Exp."], ["0101.21.01", "Puros", "10", "Ex."], [" ", "", None], ["0101.29.99", "Otros"], ["01", "no"]]
    rows = spark.createDataFrame([("f", "s", k, c) for k, c in enumerate(cells)], "file string, sheet string, row int, cells array<string>")
    layout = sheets.resolve(sheets.probe(rows))
    assert layout.first_row == 2 and layout.columns == {"code": 0, "description": 1, "igi": 2, "ige": 3}
    got = sheets.tariff_rows(sheets.fields(rows, layout)).orderBy("row").collect()
    assert [(r.row, r.code, r.igi_kind, r.ige_kind) for r in got] == [(2, "01012101", "ad_valorem", "exento"), (4, "01012999", None, None)]
    for bad in ([["a", "b"]], [["Fracción", "Fracción", "Descripción"]]):
        with pytest.raises(sheets.LayoutError):
            sheets.resolve(bad)
    items = spark.createDataFrame([("0101.21.01", "5"), (None, "0101210107"), ("x", "1")], "code string, nico string")
    assert sorted(r.item for r in sheets.item_rows(items).collect()) == ["0101210105", "0101210107"]


def test_links_are_dealt_out_by_their_number(spark, monkeypatch):
    monkeypatch.setattr(evaluate, "LINKS_AT_ONCE", 10)
    links = spark.range(95).selectExpr("id % 50 AS record_id", "id % 50 AS source_document_id", "'a' AS role", "true AS is_primary")
    once = evaluate.distinct_links(links)
    assert once.rdd.getNumPartitions() == 10 and once.count() == 50
    assert evaluate.distinct_links(links.limit(0)).count() == 0
