"""Labels from pages and tables, key-value documents, messages."""

from codespine.functions import messages
from codespine.sources import documents
from pyspark.sql import functions as F


def test_chapter_titles(spark):
    pages = [
        ["Capítulo 01", "Animales", "Cámara de Diputados", "vivos", "Notas.", "Capítulo 09"],
        ["Texto", "CAPÍTULO 02 (bis)", "Carne y"],
        ["3 de 9", "", "despojos", "CÓDIGO", "x"],
        ["Capítulo 03"],
    ]
    rows = [("d", p, k, t) for p, lines in enumerate(pages) for k, t in enumerate(lines)] + [("e", 0, 0, "nada")]
    df = spark.createDataFrame(rows, "doc string, page int, line int, text string")
    got = documents.chapter_titles(df).orderBy("position").collect()
    assert [(r.doc, r.code, r.description) for r in got] == [("d", "01", "Animales vivos"), ("d", "02", "Carne y despojos")]


def test_table_labels(spark):
    cells = [
        (0, ["CÓDIGO", "DESCRIPCIÓN"]), (0, ["01.01", "Caballos, asnos, mulos", "-"]), (1, ["y burdéganos,", "10"]), (1, [None, " "]), (1, ["vivos."]), (1, ["-", "Caballos:"]), (1, ["no cuenta"]),
        (1, ["0101.21", "Reproductores de raza pura", "Ex."]), (1, ["0101.21.01", "Reproductores", "10", "Ex."]), (1, ["tampoco"]), (2, ["0102", ""]), (2, ["Bovinos"]), (2, ["0103"]),
    ]
    df = spark.createDataFrame([("d", p, 0, k, c) for k, (p, c) in enumerate(cells)], "doc string, page int, table int, row int, cells array<string>")
    got = documents.table_labels(df).orderBy("position").collect()
    assert [(r.code, r.description) for r in got] == [("0101", "Caballos, asnos, mulos y burdéganos, vivos."), ("010121", "Reproductores de raza pura"), ("0102", "Bovinos")]


def test_fraction_documents(spark):
    page = "<table><tr><td>Fracción</td><td>9001.40.02</td><td>Lentes</td></tr></table><table><tr><td>IGI</td><td>Ex.</td></tr><tr><td>Impuesto General de Exportación</td><td>10%</td></tr></table>"
    df = spark.createDataFrame([("90014002", page), ("90014003", page)], "code string, html string")
    assert [tuple(r) for r in documents.fraction_document(df).collect()] == [("90014002", "Lentes", "Ex.", "10%")]
    a = spark.createDataFrame([("1", "Ex.", "10"), ("2", "5", None)], "code string, igi string, ige string")
    b = spark.createDataFrame([("1", "exento", "10 %"), ("2", "6", None)], "code string, igi string, ige string")
    assert [r.code for r in documents.same_duties(a, b).collect()] == ["2"]


def test_messages(spark):
    said = {"SHA256 of x: mismatch": "checksum", "bad workbook": "parser", "profile missing": "parser_profile", "legal reconciliation failed": "legal_reconciliation", "boom": "unexpected_error", "row_count 0": "validation"}
    df = spark.createDataFrame([(k,) for k in said], "m string")
    assert {r.m: r.f for r in df.select("m", messages.failure(F.col("m")).alias("f")).collect()} == said
    text = "see https://a.mx/x. and [b](https://b.mx/y) https://b.mx/y"
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(messages.bare_urls(F.col("t"))).first()[0] == ["https://a.mx/x"]
    urls = spark.createDataFrame([("https://a.mx/x",), ("http://a.mx",), ("http://s.mx/a",), ("https://a.mx/x.",), ("ftp://a",), ("nope",), (None,)], "u string")
    assert [r[0] for r in urls.select(messages.is_documented(F.col("u"), ("s.mx",))).collect()] == [True, False, True, False, False, False, False]
