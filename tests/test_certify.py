"""Certification of releases, coverage by items, source histories, and pages of labelled rows."""

import datetime

import pytest
from codespine.operators import certify
from codespine.sources import thirdparty

RECORD = "dataset_version string, record_id string, code string, level string, is_current boolean, hs2 string, hs4 string, hs6 string, fraccion8 string, ligie_version string, values_from_level string, igi_text string"
FACTS = "dataset_version string, schema_version string, ligie_version string, effective_as_of date, validation_status string, row_count bigint"
DAY = datetime.date(2024, 1, 1)
LEVEL = dict(zip((2, 4, 6, 8, 10), certify.LEVELS, strict=True))
CODES = ("01", "0101", "010121", "01012101", "0101210100", "01012102")


def record(version, code, **other):
    head = [code[:w] if len(code) >= w else None for w in (2, 4, 6, 8)]
    row = dict(zip(RECORD.replace(" string", "").replace(" boolean", "").split(", "), [version, f"r{code}", code, LEVEL[len(code)], True, *head, "v", "fraccion8" if len(code) > 6 else None, "5" if len(code) > 6 else None], strict=True))
    return tuple({**row, **other}.values())


def three(spark, records, releases, manifests):
    return spark.createDataFrame(records, RECORD), spark.createDataFrame(releases, FACTS), spark.createDataFrame(manifests, FACTS + ", level_counts map<string,bigint>")


def fact(version, n=6, status="passed", schema="2"):
    return (version, schema, "v", DAY, status, n)


GOOD = {"hs2": 1, "hs4": 1, "hs6": 1, "fraccion8": 2, "nico10": 1}


def test_a_release_as_its_manifest_says(spark):
    tables = three(spark, [record("a", c) for c in CODES], [fact("a")], [(*fact("a"), GOOD)])
    assert certify.problems(*tables).count() == 0
    assert [tuple(r) for r in certify.certification(*tables).collect()] == [("a", True, [])]
    certify.require(*tables)


def test_problems_of_releases(spark):
    bad = [record("b", "01"), record("b", "0101", hs2="03"), record("b", "010121", ligie_version=None), record("b", "01012101", values_from_level=None), record("b", "01012101", record_id=" "), record("b", "02", igi_text="x"), record("b", "0202", is_current=False)]
    tables = three(spark, [record("a", c) for c in CODES] + bad + [record(None, "01")], [fact("a"), fact("b", 7, None), fact("c")], [(*fact("a", schema="1"), GOOD), (*fact("b", 7), {**GOOD, "hs2": None}), (*fact("d"), GOOD)])
    got = {(r.dataset_version, r.problem): r.n for r in certify.problems(*tables).collect()}
    assert got == {
        ("a", "metadata_mismatch"): 1, ("b", "not_validated"): 1, ("b", "metadata_mismatch"): 1, ("b", "level_counts_mismatch"): 1, ("b", "blank_record_ids"): 1, ("b", "hs_values"): 1, ("b", "tariff_origin"): 1,
        ("b", "hs4_without_hs2"): 1, ("b", "hs6_without_hs4"): 1, ("b", "fraction_without_hs6"): 2, ("c", "no_records"): 1, ("c", "no_manifest"): 1, ("d", "no_records"): 1, ("d", "release_rows"): 1,
        (None, "no_manifest"): 1, (None, "release_rows"): 1,
    }
    publishable = {r.dataset_version: r.publishable for r in certify.certification(*tables).collect()}
    assert publishable == dict.fromkeys(("a", "b", "c", "d", None), False)
    with pytest.raises(certify.CertificationError):
        certify.require(*tables)


def test_no_releases_at_all(spark):
    tables = three(spark, [], [], [])
    assert certify.certification(*tables).count() == 0
    assert certify.nico_coverage(tables[0], spark.createDataFrame([], "code string")).count() == 0


def test_coverage_by_items(spark):
    rows = spark.createDataFrame([record("a", c) for c in (*CODES, "01012103", "01012103")] + [record("b", "01012101")], RECORD)
    got = {tuple(r) for r in certify.nico_coverage(rows, spark.createDataFrame([("01012102",), ("01012102",), (None,)], "code string")).collect()}
    assert got == {("a", 3, 1, 2, 1, 1), ("b", 1, 0, 1, 0, 1)}


def test_history_of_sources(spark):
    made = lambda *rows: spark.createDataFrame(rows, "dataset_key string, document_role string, sha256 string")
    now = made(("k", "law", "2"), ("n", "new", None), ("same", "x", "1"))
    history = certify.source_history(made(("k", "law", "1"), ("old", "gone", "1"), ("same", "x", "1")), now, ["sha256"])
    state = lambda s: s and tuple(s)
    assert {(r.change, r.dataset_key, state(r.previous), state(r.current)) for r in history.collect()} == {
        ("updated", "k", ("k", "law", "1"), ("k", "law", "2")), ("removed", "old", ("old", "gone", "1"), None), ("added", "n", None, ("n", "new", None)),
    }
    assert certify.history_problems(history, now, ["sha256"]).count() == 0
    one = ("k", "law", "2")
    told = spark.createDataFrame([("moved", "k", "law", None, one), ("added", "k", "law", one, one), ("added", " ", "r", None, None), ("updated", "k", "law", ("o", "law", "1"), ("k", "law", "9")), ("removed", "x", "y", ("x", "y", "1"), None), (None, "k", "law", None, None)], history.select("change", *certify.KEY, "previous", "current").schema)
    assert {tuple(r) for r in certify.history_problems(told, now, ["sha256"]).collect()} == {("k", "law", "change"), ("k", "law", "states"), (" ", "r", "key"), (" ", "r", "states"), ("k", "law", "identity"), ("k", "law", "current")}


def test_pages_of_labelled_rows(spark):
    page = "<table><tr><td>IGI</td><td> 5 </td></tr><tr><td>sola</td></tr><tr><td>{}</td><td>9001.40.02</td><td>Lentes</td></tr><tr><td>igi</td><td>Ex.</td></tr></table>"
    rows = [(1, page.format("HTS Code"), "90014002", "z"), (2, page.format("Otra fracción"), None, "z"), (3, "<table><tr><td>La fracción</td><td>90014002</td></tr></table>90014002", "", "z"), (4, page.format("nada"), "90014002", "z"), (5, None, None, "z"), (6, page.format("Código"), "11111111", "z")]
    got = {r.id: (r.code, r.description, r.igi, r.ige, r.error) for r in thirdparty.fraction_documents(spark.createDataFrame(rows, "id int, html string, want string, igi string"), expected="want").collect()}
    # the digits of a page are looked for before its dots are taken off
    assert got == {
        1: ("90014002", "Lentes", "Ex.", None, None), 2: (None, None, None, None, thirdparty.NO_DIGITS), 3: ("90014002", "90014002", None, None, None),
        4: ("90014002", None, None, None, thirdparty.NO_ROW), 5: (None, None, None, None, thirdparty.NO_DIGITS), 6: ("11111111", None, None, None, thirdparty.NO_ROW),
    }
