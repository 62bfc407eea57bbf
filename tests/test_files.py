"""Files, JSON lists, level order, budgets, notes by chapter."""

import json

import pytest
from codespine.functions import lists
from codespine.operators import evaluate, hierarchy
from codespine.plans import serving, views
from codespine.sources import files
from pyspark.sql import functions as F


def test_columns_of_artefacts(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b'code,text\r\n01,"a,""b"""\r\n02,\r\n')
    assert [tuple(r) for r in files.read_csv(spark, str(tmp_path / "a.csv"), ["code", "text"]).collect()] == [("01", 'a,"b"'), ("02", "")]
    with pytest.raises(files.ArtifactError):
        files.read_csv(spark, str(tmp_path / "a.csv"), ["text", "code"])
    (tmp_path / "a.json").write_text(json.dumps([{"code": "01", "n": 1}, {"code": "02", "n": None}]))
    assert [tuple(r) for r in files.read_json(spark, str(tmp_path / "a.json"), "code string, n int").collect()] == [("01", 1), ("02", None)]
    with pytest.raises(files.ArtifactError):
        files.read_json(spark, str(tmp_path / "a.json"), "code string")


def test_strict_decoding(spark):
    rows = spark.createDataFrame([(bytearray("é".encode()), None), (bytearray("é".encode("latin-1")), None), (bytearray("é".encode("latin-1")), "iso-8859-1"), (bytearray(b"\x81"), "nonsense"), (None, "utf-8")], "c binary, n string")
    assert [r[0] for r in rows.select(files.decoded(F.col("c"), F.col("n"))).collect()] == ["é", "é", "é", None, None]


def test_registry(spark, tmp_path):
    entry = {"dataset_key": "k", "pages": ["https://s.mx/p"], "allowed_hosts": ["s.mx"], "media_types": ["text/html"], "families": [{"role": "r", "patterns": ["A.*"]}]}
    path = tmp_path / "r.json"
    path.write_text(json.dumps({"sources": [entry]}))
    assert files.registry(spark, str(path))[0]["families"] == [("r", ["A.*"])]
    for bad in ([entry, entry], [{**entry, "pages": ["http://s.mx/p"]}], [{**entry, "pages": ["https://t.mx/p"]}]):
        path.write_text(json.dumps({"sources": bad}))
        with pytest.raises(files.ArtifactError):
            files.registry(spark, str(path))


def test_lists_of_ids(spark):
    rows = spark.createDataFrame([('["a", "b"]',), ("[]",), ('{"a": 1}',), ("[1]",), ('["a", 1]',), ("x",), (None,)], "j string")
    assert [r[0] for r in rows.select(lists.id_list(F.col("j"))).collect()] == [["a", "b"], [], None, None, None, None, None]


def test_level_order_and_tables(spark):
    rows = spark.createDataFrame([("0101", "hs4"), ("0101210100", "nico10"), ("02", "hs2"), ("01", "hs2"), ("x", "other"), ("01012101", "fraccion8")], "code string, level string")
    got = hierarchy.in_level_order(hierarchy.routed(rows)).collect()
    assert [(r.code, r.table) for r in got] == [("01", "hs_version"), ("02", "hs_version"), ("0101", "hs_version"), ("01012101", "fraction_version"), ("0101210100", "nico_version"), ("x", None)]


def test_notes_of_a_chapter(spark):
    rows = spark.createDataFrame([("03", "2", None, None), ("03", "1", "section", None), ("03", "1", "section", "I"), ("04", "1", "chapter", "04")], "chapter string, note_number string, scope_type string, scope_value string")
    assert [(r.note_number, r.scope_value) for r in views.notes_of_chapter(rows, "03").collect()] == [("1", "I"), ("1", None), ("2", None)]
    with pytest.raises(hierarchy.QueryError):
        views.notes_of_chapter(rows, "3")


def test_releases_that_count(spark):
    rows = spark.createDataFrame([("data-2026.08.15", False, False), ("data-2026.09.01", True, False), ("data-2026.09.02", False, True), ("data-2026.13.01", False, False), ("v2", False, False), ("2026.08.01", False, False)], "tag string, draft boolean, prerelease boolean")
    assert evaluate.newest_release(rows).first().tag == "data-2026.08.15" and evaluate.eligible_releases(rows).count() == 2


def test_a_half_written_pointer_changes_nothing(spark, tmp_path):
    rows = spark.createDataFrame([("01", True)], "code string, is_current boolean")
    serving.promote(rows, "t1", str(tmp_path), generated_at="1")
    (tmp_path / "active" / "0000000002").mkdir()
    assert serving.active_tag(spark, str(tmp_path)) == "t1"
    serving.promote(rows, "t0", str(tmp_path / "other"), generated_at="1")
    assert serving.active_records(spark, str(tmp_path)).count() == 1
