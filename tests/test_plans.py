"""Releases, serving tables and polling."""

import csv
import datetime as dt
import json
from decimal import Decimal

import pytest
from codespine.plans import release, schemas, serving, views
from codespine.sources import html
from codespine.streaming import poll

ROWS = [("0101", True, Decimal("1.500000"), 'a "quoted", text\nline', None, dt.datetime(2022, 6, 7, 1, 2, 3), None), ("01", False, None, "", dt.date(2022, 1, 1), None, 1.5)]
DDL = "code string, is_current boolean, igi_value decimal(18,6), description string, effective_from date, retrieved_at timestamp, share double"


def test_release_round_trip(spark, tmp_path):
    df = spark.createDataFrame(ROWS, DDL)
    manifest = release.export(df, str(tmp_path / "r"), metadata={"dataset_version": "d1"}, ranges=2)
    assert manifest["row_count"] == 2 and release.verify(str(tmp_path / "r")) == manifest
    text = (tmp_path / "r" / "records.csv").read_bytes().decode()
    assert text.split("\r\n")[:2] == [",".join(df.columns), "01,false,,,2022-01-01,,1.5"]
    assert list(csv.reader(text.splitlines(keepends=True)))[2][:3] == ["0101", "true", "1.5"]
    objects = json.loads((tmp_path / "r" / "records.json").read_text())
    assert [o["code"] for o in objects] == ["01", "0101"] and objects[1]["igi_value"] == 1.5 and list(objects[0]) == df.columns and objects[1]["retrieved_at"] == "2022-06-07T01:02:03Z"
    with pytest.raises(release.ReleaseError):
        release.export(df, str(tmp_path / "r"), metadata={})
    again = release.export(df, str(tmp_path / "s"), metadata={"dataset_version": "d1"}, ranges=3)
    assert {k: v for k, v in again["files"].items() if k.endswith(("csv", "json"))} == {k: v for k, v in manifest["files"].items() if k.endswith(("csv", "json"))}
    (tmp_path / "r" / "records.csv").write_text("x")
    with pytest.raises(release.ReleaseError):
        release.verify(str(tmp_path / "r"))


def test_empty_release(spark, tmp_path):
    release.export(schemas.empty(spark, DDL), str(tmp_path / "e"), metadata={})
    assert json.loads((tmp_path / "e" / "records.json").read_text()) == [] and (tmp_path / "e" / "records.csv").read_bytes().count(b"\r\n") == 1


def test_capture(tmp_path):
    about = {"observed_at": "2022-06-07", "source": "dof", "kind": "page"}
    assert release.capture(b"x", about, str(tmp_path)) == release.capture(b"x", about, str(tmp_path))
    with pytest.raises(release.ReleaseError):
        release.capture(b"x", {**about, "url": "u"}, str(tmp_path))


def test_promotion(spark, tmp_path):
    root = str(tmp_path)
    rows = spark.createDataFrame([("01", True, "a"), ("02", True, "b"), ("03", False, "c")], "code string, is_current boolean, description string")
    with pytest.raises(serving.PromotionError):
        serving.active_tag(spark, root)
    for tag in ("data-1", "data-2", "data-2"):
        serving.promote(rows, tag, root, generated_at=tag)
    assert serving.active_tag(spark, root) == "data-2" and serving.active_records(spark, root).count() == 2
    assert serving.latest_release(spark, root).first().release_tag == "data-2" and spark.read.parquet(f"{root}/records").count() == 4
    for bad in (rows.where("not is_current"), rows.union(rows)):
        with pytest.raises(serving.PromotionError):
            serving.promote(bad, "data-3", root, generated_at="x")
    assert serving.active_tag(spark, root) == "data-2"


def test_polling(spark, tmp_path):
    (tmp_path / "in").mkdir()
    say = lambda name, rows: (tmp_path / "in" / name).write_text("".join(json.dumps(dict(zip(("dataset_key", "document_role", "source_url", "sha256", "observed_at"), r, strict=True))) + "\n" for r in rows))
    run = lambda: poll.poll(spark, str(tmp_path / "in"), str(tmp_path / "state"), str(tmp_path / "changes"), str(tmp_path / "cp")).awaitTermination()
    say("1.json", [("ligie", "snapshot", "u", "1", "2022-01-01"), ("nico", "snapshot", "u", "1", "2022-01-01")])
    run()
    say("2.json", [("ligie", "snapshot", "u", "2", "2022-01-02"), ("nico", "snapshot", "u", "1", "2022-01-02")])
    run()
    got = sorted((r.batch, r.dataset_key, r.change) for r in spark.read.parquet(f"{tmp_path}/changes").collect())
    assert got == [(0, "ligie", "added"), (0, "nico", "added"), (1, "ligie", "updated")]


def test_views(spark):
    notes = html.national_notes(spark.createDataFrame([("d", "<p>Capítulo 3</p><p>1. Peces.</p><p>2. Más.</p>")], "source_document_id string, html string"))
    a, b, c = views.note_tables(notes)
    assert views.national_notes_view(a, b, c).count() == 2 and len(schemas.names(schemas.PUBLIC)) == 44
    with pytest.raises(ValueError, match="missing"):
        schemas.in_contract_order(notes)
    assert schemas.in_contract_order(notes, schemas.NOTES).columns == schemas.names(schemas.NOTES)
