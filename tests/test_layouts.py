"""Layouts of many files at once, checks of pages, discovery."""

from codespine.sources import layouts, pages
from pyspark.sql import functions as F

PROBE = "file string, sheet string, sheet_at int, row int, cells array<string>"


def probes(spark, files):
    rows = [(f, s, k, r, cells) for f, sheets in files.items() for k, (s, lines) in enumerate(sheets.items()) for r, cells in enumerate(lines, 1)]
    return spark.createDataFrame(rows, PROBE)


def test_layouts_of_many_files(spark):
    data = ["01012101", "x", "Kg", "10", "Ex."]
    files = {
        "plain": {"S": [["Title"], [" Fracción ", "Descripción", "Unidad de medida", "Imp.", "EXPORTACIÓN"], data]},
        "two rows": {"S": [["FRACCION", "DESCRIPCION", None, "Arancel", None], [None, None, None, "IGI", "IGE"], data]},
        "one rate missing, data below": {"S": [["FRACCION", "DESCRIPCION", "UMT", "IGI"], data]},
        "unresolved": {"S": [["FRACCION", "DESCRIPCION"], ["", ""], data]},
        "short row below": {"S": [["x", "FRACCION", "DESCRIPCION"], ["y"]]},
        "nothing below": {"S": [["FRACCION", "DESCRIPCION"]]},
        "most fields win": {"A": [["FRACCION", "DESCRIPCION"]], "B": [["FRACCION", "DESCRIPCION", "IGI", "IGE"]]},
        "two alike": {"A": [["FRACCION", "DESCRIPCION"]], "B": [["FRACCION", "DESCRIPCION"]]},
        "repeated heading": {"A": [["a"]], "B": [["FRACCION", "FRACCION ARANCELARIA", "DESCRIPCION"]]},
        "repeated, but no header": {"B": [["FRACCION", "IGI", "IGI"], ["FRACCION", "DESCRIPCION", "IGI", "IGE"]]},
        "repeated below": {"B": [["FRACCION", "DESCRIPCION", "", ""], ["", "", "IGI", "IMP", "IGE"]]},
        "none": {"S": [["Clave", "Arancel"]]},
    }
    for k in range(200):
        files[f"many {k}"] = {"S": [[""]] * (k % 7) + [["Descripcion", "FRACCION", "IGI", "IGE"], data]}
    found = layouts.layouts(layouts.probed(probes(spark, files)), "ligie_snapshot").collect()
    got = {r.file: r for r in found}
    assert len(found) == len(files)
    at = lambda f: (got[f].sheet, got[f].header_row, got[f].data_row, {k: v["index"] for k, v in got[f].columns.items()})
    assert at("plain") == ("S", 2, 3, {"code": 0, "description": 1, "unit_name": 2, "igi": 3, "ige": 4})
    assert got["plain"].columns["code"].heading == " Fracción " and got["plain"].parser_version == "ligie-profile-1"
    assert at("two rows") == ("S", 1, 3, {"code": 0, "description": 1, "igi": 3, "ige": 4})
    assert at("one rate missing, data below") == ("S", 1, 2, {"code": 0, "description": 1, "unit_name": 2, "igi": 3})
    assert at("short row below")[1:3] == (1, 2) and at("nothing below")[1:3] == (1, 2)
    assert at("most fields win")[:2] == ("B", 1) and at("repeated, but no header")[:2] == ("B", 2)
    errors = {f: got[f].error for f in files if got[f].error}
    assert errors == {
        "unresolved": "unresolved two-row tariff header: ligie_snapshot; location=S!1", "two alike": "ambiguous workbook profile: ligie_snapshot",
        "repeated heading": "ambiguous workbook profile: ligie_snapshot; logical=code; location=B!1", "repeated below": "ambiguous workbook profile: ligie_snapshot; logical=igi; location=B!1",
        "none": "unknown workbook profile: ligie_snapshot",
    }
    assert all(at(f"many {k}")[1:3] == (k % 7 + 1, k % 7 + 2) for k in range(200))


def test_rows_of_all_files(spark):
    files = {"a": {"S": [["NICO", "FRACCIÓN", "DESCRIPCIÓN NICO"], ["01", "01012101", "x"], ["", " ", ""], ["02"]]}, "b": {"T": [["FRACCION", "NICO", "DESCRIPCION"], ["01012102", "00", "y"]]}, "c": {"T": [["?"]]}}
    rows = probes(spark, files)
    found = layouts.layouts(rows, "nico_snapshot")
    got = layouts.read(rows, found, "nico_snapshot").orderBy("file", "row").collect()
    assert [(r.file, r.fraccion8, r.nico2, r.description) for r in got] == [("a", "01012101", "01", "x"), ("a", None, "02", None), ("b", "01012102", "00", "y")]
    assert layouts.layouts(rows.limit(0), "nico_snapshot").count() == 0


def page(body, head="<title>t</title>"):
    return f"<!DOCTYPE html><html><head>{head}</head><body>{body}{'<p>' * 80}</body></html>"


def test_verdicts_of_pages(spark):
    bodies = {
        "ok": page("<h1>a</h1><h2>b</h2><div><a href='x'>l</a><br></div><h2>c</h2>"), "small": "<html></html>", "none": None, "not_html": "x" * 300,
        "open": page("<div><span>"), "closed": page("</div><div>"), "crossed": page("<div><span></div></span>"), "skips": page("<h1>a</h1><h3>b</h3>"),
        "hidden": page("<!-- <div> --><script>var t='</div><div><div>'</script><STYLE>a{}</STYLE><h2>x</h2>"), "upper": page("<DIV><A>x</a></Div>"),
    }
    df = spark.createDataFrame(list(bodies.items()), "page_id string, html string")
    got = {r.page_id: r.reason for r in pages.verdicts(df).collect()}
    assert got == {"ok": "ok", "small": "small", "none": "small", "not_html": "not_html", "open": "unbalanced", "closed": "unbalanced", "crossed": "crossed", "skips": "heading_skipped", "hidden": "ok", "upper": "ok"}
    assert pages.verdicts(df.limit(0)).count() == 0


def test_discovery_in_rounds(spark):
    web = {"http://a/1": ["2", "3", "2"], "http://a/2": ["4", "1"], "http://a/4": ["5"], "http://a/5": ["6"], "http://a/9": ["1"]}
    df = spark.createDataFrame([(u, "".join(f"<a href='{x}'>x</a>" for x in to)) for u, to in web.items()], "url string, html string")
    seeds = spark.createDataFrame([("http://a/1",), ("http://a/1",), (None,)], "url string")
    walk = lambda n: {r.url[-1]: r.depth for r in pages.discovered(df, seeds, rounds=n).collect()}
    assert walk(2) == {"1": 0, "2": 1, "3": 1, "4": 2}
    assert walk(20) == {"1": 0, "2": 1, "3": 1, "4": 2, "5": 3, "6": 4}
    assert pages.discovered(df, seeds.limit(0), rounds=3).count() == 0
    assert pages.discovered(df.withColumn("html", F.lit(None).cast("string")), seeds, rounds=3).count() == 1
