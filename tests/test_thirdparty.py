"""Third-party sheets, their comparison with records, and legal ledgers as documents."""

import datetime

import pandas as pd
import pytest
from codespine import workers
from codespine.operators import compare
from codespine.sources import ledgers, thirdparty

RECORDS = "code string, level string, description string, igi_text string, ige_text string, extra int"
PAGES = "url string, html string, error string, items int"

SHEET = """<table><tr><td>Fracción</td><td>Otra</td></tr><tr><td>Partida 9001</td></tr></table>
<table><tr><td>9001.40.02</td><td>10</td><td>0</td><td>5%</td></tr><tr><td>nota breve</td></tr><tr><td>9001.40.02 lentes de vidrio para gafas</td><td>Lentes de vidrio para anteojos &amp; gafas</td></tr></table>
<table><tr><th>Nico</th><th>Texto</th></tr><tr><td>00</td><td>De vidrio</td><td>Ex.</td><td>5</td></tr><tr><td>90014002 01</td><td>Los demás</td></tr><tr><td>1</td><td>mal</td></tr><tr><td>02</td></tr></table>"""


def sheets(spark, rows):
    return thirdparty.fraction_sheets(spark.createDataFrame([(u, h, None, 1) for u, h in rows], PAGES))


def test_sheet_of_a_fraction(spark):
    found = {r.url: r for r in sheets(spark, [("https://v.mx/h/90014002.html", SHEET), ("https://v.mx/h/a.html", SHEET), ("https://v.mx/90014003.html", SHEET), ("https://v.mx/90014004.html", None), ("https://v.mx/90014005.html", "<p>90014005</p>"), (None, "")]).collect()}
    one = found["https://v.mx/h/90014002.html"]
    # neither a number, a short cell below nor one that names the code is a description
    assert (one.sheet_code, one.description, one.igi, one.ige, one.error) == ("90014002", "Lentes de vidrio para anteojos & gafas", "0", "5%", None)
    assert [tuple(i) for i in one["items"]] == [("00", "9001400200", "De vidrio", "Ex.", "5"), ("90014002 01", "9001400201", "Los demás", None, None), ("1", None, "mal", None, None)]
    assert {u: r.error for u, r in found.items() if r.error} == {
        "https://v.mx/h/a.html": thirdparty.NO_CODE, None: thirdparty.NO_CODE, "https://v.mx/90014003.html": thirdparty.NOT_TOLD,
        "https://v.mx/90014004.html": thirdparty.NOT_TOLD, "https://v.mx/90014005.html": thirdparty.NO_ROW,
    }
    assert sheets(spark, [("https://v.mx/90014002.html", "<table><tr><td>90014002</td><td>12</td></tr></table>")]).collect()[0].description == "12"


@pytest.fixture
def records(spark):
    return spark.createDataFrame([
        ("900140", "hs6", "Lentes de vidrio", None, None, 1), ("90014002", "fraccion8", "Lentes de vidrio para gafas y anteojos", "0%", "5", 1),
        ("9001400200", "nico10", "De vidrio", "Ex", None, 1), ("9001400201", "nico10", None, None, None, 1), ("9001400299", "nico10", "Otros", None, None, 1),
        ("90014003", "fraccion8", "Otros", "5", None, 1), ("9001400300", "nico10", "Otros", "5", None, 1), ("9001400900", "nico10", "Sola", None, None, 1), ("90", "hs2", "Óptica", None, None, 1),
    ], RECORDS)


def compared(spark, records, pages, asked):
    out = compare.third_party(records, sheets(spark, pages), spark.createDataFrame([(c,) for c in asked], "code string"))
    return sorted(((r.asked, r.code, r.field, r.match, r.note) for r in out.collect()), key=str)


def test_six_digits_ask_all_below(spark, records):
    got = compared(spark, records, [("https://v.mx/90014002.html", SHEET), ("https://v.mx/a/90014002.html", "<p>nada</p>")], ["900140", "900140", None])
    assert got == sorted([
        ("900140", "900140", "description", None, compare.NO_PAGE), *[("900140", "90014002", f, True, "") for f in ("description", "igi", "ige")],
        ("900140", "9001400200", "description", True, ""), ("900140", "9001400200", "igi", True, ""), ("900140", "9001400200", "ige", False, ""),
        ("900140", "9001400201", "description", False, ""), ("900140", "9001400201", "igi", None, ""), ("900140", "9001400201", "ige", None, ""),
        ("900140", "9001400299", "present", False, compare.NO_ITEM), ("900140", "90014003", "present", None, compare.NO_SHEET),
    ], key=str)


def test_failures_are_rows(spark, records):
    got = compared(spark, records, [("https://v.mx/90014003.html", "<p>nada</p>")], ["9001400300", "90014003", "9001400900", "9001400200", "90", "12345678"])
    assert got == sorted([
        ("9001400300", "9001400300", "present", False, thirdparty.NOT_TOLD), ("90014003", "90014003", "present", False, thirdparty.NOT_TOLD), ("9001400900", "9001400900", "present", None, compare.NO_FRACTION),
        ("9001400200", "9001400200", "present", None, compare.NO_SHEET), ("90", "90", "code", None, compare.NO_RECORD), ("12345678", "12345678", "code", None, compare.NO_RECORD),
    ], key=str)


def test_empty_inputs(spark, records):
    assert compared(spark, records.limit(0), [], ["900140"]) == [("900140", "900140", "code", None, compare.NO_RECORD)]
    assert compared(spark, records, [], []) == []


LEDGER = """<h1>Ley</h1><p>Última reforma publicada en el DOF el 7 de junio de 2022</p><p>Fracciones arancelarias: última modificación, Decreto DOF 15-11-2023</p>
<a href="/LeyesBiblio/pdf/LIGIE_2022.pdf">PDF</a><a href="otra.pdf">Otra</a>
<table><tr><td>00</td><td>Sin sección</td><td><a href="x.pdf">x</a></td></tr><tr><td colspan=3>Publicación original</td></tr>
<tr><td> 01 </td><td>Ley nueva</td><td>07/06/2022 <a href="a.pdf">DOF 07-06-2022</a><a href="a.doc">Texto</a><a href="a">Otro</a></td></tr>
<tr><td>Acuerdos complementarios</td></tr><tr><td>02</td><td>Notas Nacionales</td><td><a href="n.pdf">pdf</a></td></tr><tr><td>03</td><td>sin enlace</td></tr>
<tr><td>Decretos que modifican la Tarifa</td></tr><tr><td><a href="LIGIE_2022_ref03_1.pdf">04</a></td></tr></table><a href="z.pdf">texto vigente</a>"""


def pages(spark, *rows):
    return spark.createDataFrame([(u, h, 1, "x") for u, h in rows], "url string, html string, page int, position string")


def test_ledger_documents(spark):
    made = pages(spark, ("https://d.mx/b/i.htm", LEDGER), ("https://d.mx/b/i.htm", LEDGER), (None, None))
    rows = ledgers.ledger_documents(made).distinct().orderBy("position").collect()
    day = datetime.date
    assert [(r.category, r.label, r.title, r.displayed_date) for r in rows] == [
        ("consolidated_text", "current", "Texto vigente LIGIE 2022", day(2022, 6, 7)), ("consolidated_text", "current", "Texto vigente LIGIE 2022", day(2022, 6, 7)), ("unknown", "00", "Sin sección", None),
        ("original", "01", "Ley nueva", day(2022, 6, 7)), ("national_notes", "02", "Notas Nacionales", None), ("law_reform", "04", "04", None),
    ]
    assert [tuple(x) for x in rows[3].links] == [
        ("dof", "https://d.mx/b/a.pdf", "DOF 07-06-2022", day(2022, 6, 7), "application/pdf"), ("word", "https://d.mx/b/a.doc", "Texto", None, "application/msword"), ("document", "https://d.mx/b/a", "Otro", None, None),
    ]
    assert ledgers.ledger_documents(made).count() == 12
    assert {tuple(r) for r in ledgers.ledger_dates(made).collect()} == {("https://d.mx/b/i.htm", day(2022, 6, 7), day(2023, 11, 15)), (None, None, None)}
    assert ledgers.ledger_documents(made.limit(0)).count() == 0


def test_ledger_problems_stop_the_whole(spark):
    twice = LEDGER.replace('<a href="a.pdf">', '<a href="LIGIE_2022_orig.pdf"></a><a href="ligie_2022_tarifa2.pdf">')
    made = pages(spark, ("https://d.mx/a.htm", LEDGER), ("https://d.mx/b.htm", twice), ("https://d.mx/c.htm", LEDGER.replace("Última", "Primera")), (None, None))
    assert {tuple(r) for r in ledgers.ledger_problems(made).collect()} == {("https://d.mx/b.htm", "ambiguous_families"), ("https://d.mx/c.htm", "missing_date"), (None, "missing_date"), (None, "no_documents")}
    with pytest.raises(ledgers.LedgerError, match="missing_date"):
        ledgers.required_ledger(made)
    assert ledgers.required_ledger(made.where("url = 'https://d.mx/a.htm'")).count() == 6


def test_ledger_problems_are_found_page_by_page(spark):
    made = spark.createDataFrame([("https://d.mx/a.htm", "<p>x</p>")], "url string, html string")
    plan = ledgers.ledger_problems(made)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Exchange", "Join", "Window")) and plan.count("ArrowEvalPython") == 1
    assert len(plan) < 20_000  # texts are folded where pages are parsed; the tables of folding aren't in the plan


def test_parsed_pages_leave_the_worker_in_slices(spark):
    pages = [pd.Series(["x" * 10, None, "y" * 30, "z"]), pd.Series([], dtype=object)]
    assert list(workers.by_slices(((p,) for p in pages), len_of, most=130)) == [[10, 0], [30, 1]]
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    workers.ready(spark)
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 4096


def len_of(page):
    return len(page or "")
