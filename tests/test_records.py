"""Gates, cards, ledger changes, upserts and comparisons of whole records."""

import datetime as dt
import json
import random

import pytest
from codespine.operators import cards, consolidate, diff, validate
from codespine.plans import inputs, serving
from pyspark.sql import functions as F

DAY = dt.date(2024, 1, 1)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_counts_of_the_writing_pass(spark, sf_dir, tmp_path):
    records = inputs.records(spark, sf_dir)
    odd = records.unionByName(records.limit(5).withColumn("record_id", F.lit(None).cast("string")))
    counts = validate.written_with_counts(odd, str(tmp_path / "r"))
    back = spark.read.schema(odd.schema).parquet(str(tmp_path / "r"))
    assert counts == validate.single_pass(odd).first().asDict() and all(counts.values())
    assert back.columns == odd.columns and back.count() == odd.count()
    assert validate.written_with_counts(odd.limit(0), str(tmp_path / "none")) == dict.fromkeys(counts, 0)


def test_nothing_is_published_that_breaks_a_gate(spark, sf_dir, tmp_path):
    records, path = inputs.records(spark, sf_dir), str(tmp_path / "release")
    with pytest.raises(validate.ValidationError, match="reversed_intervals"):
        validate.published(records, path)
    assert not (tmp_path / "release").exists() and not (tmp_path / "release.staging").exists()
    bad = F.lit(False)
    for condition in validate.row_checks().values():
        bad = bad | F.coalesce(condition, F.lit(False))
    good = records.where(~bad).dropDuplicates(["record_id"])
    assert validate.published(good, path).count() == good.count() > 0
    with pytest.raises(validate.ValidationError, match="already"):
        validate.published(good, path)


def test_parents_by_one_join_are_those_of_each_check(spark, sf_dir):
    records = inputs.records(spark, sf_dir)
    one = {(r.check, r.code) for r in validate.without_parents(records).collect()}
    assert one == {(name, r.code) for name, (level, up) in validate.PARENT_CHECKS.items() for r in validate.without_parent(records, level, up).collect()}


def test_interval_join_by_stretches(spark):
    rng = random.Random(3)

    def table(n, names):
        day = lambda: None if rng.random() < 0.15 else DAY + dt.timedelta(days=rng.randrange(900))
        return spark.createDataFrame([(rng.choice(["hot", "hot", "hot", "b", None]), k, day(), day()) for k in range(n)], f"g string, {names} int, valid_from date, valid_to date")

    left, right = table(150, "l"), table(150, "r")
    assert rows_of(consolidate.bucketed_interval_join(left, right, ["g"], days=40)) == rows_of(consolidate.interval_join(left, right, ["g"]))
    assert consolidate.bucketed_interval_join(left.limit(0), right, ["g"]).count() == 0 == consolidate.bucketed_interval_join(left.limit(0), right.limit(0), ["g"]).count()
    open_ = spark.createDataFrame([("a", 1, None, None)], left.schema), spark.createDataFrame([("a", 2, None, None)], right.schema)
    assert consolidate.bucketed_interval_join(*open_, ["g"]).count() == 1


def test_differences_are_those_of_multisets(spark):
    left = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (3, ""), (4, "d")] + [(k, "same") for k in range(10, 300)], "k int, v string")
    right = left.where("k NOT IN (3, 4)").unionByName(spark.createDataFrame([(1, "a"), (3, None)], "k int, v string"))
    got = {tuple(r) for r in diff.differences(left, right, ["k", "v"]).collect()}
    assert got == {("right", "1", "a", 1), ("left", "3", "", 1), ("right", "3", None, 1), ("left", "4", "d", 1)}
    assert diff.differences(left, left.orderBy(F.desc("k")), ["k", "v"]).isEmpty() and diff.same_rows(left.limit(0), left.limit(0))
    text = left.select(F.col("k").cast("string"), "v")
    assert diff.differences(left, text, ["k", "v"]).isEmpty()


DOCUMENT = "position int, category string, ordinal string, title string, displayed_date string, links array<string>"


def test_ledger_changes_and_their_jobs(spark):
    before = spark.createDataFrame([(0, "original", "Orig", "Law", "d", ["a"]), (1, "law_reform", "02", "Reform  two", "d", ["b"]), (2, "correlation", "01", "Tables", None, ["c"]), (3, "national_notes", "03", "Notes", "d", ["x"]), (4, "national_notes", "03", " Notes ", "d", ["n"])], DOCUMENT)
    after = spark.createDataFrame([(0, "original", "Orig", "Law", "d", ["a"]), (1, "national_notes", "03", " Notes ", "d", ["n"]), (2, "correlation", "01", "Tables", "e", ["c"]), (3, "nico_agreement", "04", "NICO", "d", None)], DOCUMENT)
    shown = "last_law_reform string, latest_tariff_modification string"
    old, new = spark.createDataFrame([("1", "1")], shown), spark.createDataFrame([("2", "2")], shown)
    found = diff.ledger_changes(before, after, ["displayed_date", "links"], dates_before=old, dates_after=new)
    assert [(r.event_type, r.detail) for r in found.orderBy("position").collect()] == [
        ("correlation_changed", "correlation:01:Tables"), ("ligie_reform_changed", "law_reform:02:Reform  two"), ("nico_agreement_changed", "nico_agreement:04:NICO"),
        ("tariff_decree_changed", "displayed tariff modification date"),
    ]
    jobs = [r.job for r in diff.routed_jobs(found).collect()]
    want = []
    for event in ("correlation_changed", "ligie_reform_changed", "nico_agreement_changed", "tariff_decree_changed"):
        want += [j for j in diff.JOBS[event] if j not in want]
    assert jobs == want
    assert diff.ledger_changes(after, after, ["links"], dates_before=old, dates_after=old).count() == 0
    assert diff.ledger_changes(before.limit(0), after, ["links"]).count() == 4
    with pytest.raises(ValueError, match="unknown kind"):
        diff.routed_jobs(diff.ledger_changes(before.limit(0), after.withColumn("category", F.lit("unknown")), ["links"]))


def release(tag="data-2026.01.02", schema="2", evidence=None, digest="a" * 64):
    at = dt.datetime(2026, 1, 2)
    return (tag, tag.removeprefix("data-"), schema, digest, at, at, at, json.dumps(evidence or {"source_documents": []}))


def test_upsert_of_releases(spark, tmp_path):
    root = str(tmp_path)
    put = lambda *rows: {r.release_tag: r.outcome for r in serving.upsert_releases(spark.createDataFrame(list(rows), serving.RELEASE), root).collect()}
    held = lambda: {r.release_tag: r.evidence_json for r in spark.read.parquet(f"{root}/release_table").collect()}
    assert put(release(), release("data-2026.01.09")) == {"data-2026.01.02": "inserted", "data-2026.01.09": "inserted"}
    first = sorted((tmp_path / "release_table").rglob("*.parquet"))
    assert put(release()) == {"data-2026.01.02": "unchanged"} and sorted((tmp_path / "release_table").rglob("*.parquet")) == first
    new = {"source_documents": [{"source_document_id": "s"}]}
    assert put(release(evidence=new)) == {"data-2026.01.02": "updated"}
    assert json.loads(held()["data-2026.01.02"]) == new and len(held()) == 2
    before = held()
    for row, about in ((release(schema="3"), "another version"), (release("data-1"), "tag"), (release(digest="x"), "manifest"), (release(evidence={"national_notes": [1]}), "evidence"), (release(evidence={"national_notes": {}}), "evidence")):
        with pytest.raises(serving.PromotionError, match=about):
            put(row)
    with pytest.raises(serving.PromotionError):
        put(release("data-2026.02.02"), release("data-2026.02.02"))
    assert held() == before


def test_evidence_of_releases(spark):
    evidence = {"source_documents": [{"source_document_id": "s", "url": "u"}, {"source_document_id": "t"}], "record_provenance": [{"code": "01", "source_document_id": "t", "role": "rate", "is_primary": False}, {"code": "01", "source_document_id": "s", "role": "text", "is_primary": True}, {"code": "01", "source_document_id": "gone", "role": "a"}]}
    rows = spark.createDataFrame([release(evidence=evidence), release("data-2026.01.03"), (*release("data-2026.01.04")[:-1], None)], serving.RELEASE)
    got = serving.record_evidence(rows).orderBy("rank").collect()
    assert [(r.release_tag, r.code, r.source_document_id, r.is_primary, r.document.get("url"), r["rank"]) for r in got] == [("data-2026.01.02", "01", "s", True, "u", 1), ("data-2026.01.02", "01", "t", False, None, 2)]
    assert serving.release_evidence(rows, "national_notes").count() == 0


def test_records_that_cannot_be_served(spark):
    rows = [("01", "hs2", "x", "a" * 64, '["s"]', '{"a": 1}'), ("", "hs2", "x", "a" * 64, '["s"]', '{"a": 1}'), ("01", "hs2", "x", "A" * 64, '["s"]', '{"a": 1}'), ("01", "hs2", "x", "a" * 64, "[]", "{}"), (None, None, None, None, None, None)]
    df = spark.createDataFrame(rows, "code string, level string, description string, record_hash string, source_document_ids string, payload string")
    got = [r.breaches for r in serving.breaches(df, serving.record_breaches()).collect()]
    assert got == [["text"], ["record_hash"], ["source_document_ids", "payload"], ["text", "record_hash", "source_document_ids", "payload"]]


def test_cards(spark):
    rows = [("01", "hs2", "Animals", True), ("0101", "hs4", "Horses", True), ("010121", "hs6", "Pure", True), ("01012101", "fraccion8", "Breeding", True), ("01012102", "fraccion8", "Other", True), ("01012103", "fraccion8", "Old", False), ("9801", "hs4", "Lost", True)]
    records = spark.createDataFrame(rows, "code string, level string, description string, is_current boolean")
    notes = spark.createDataFrame([("01", "2", "second", "b"), ("01", "1", "first", "a"), ("02", "1", "no", "a")], "chapter string, note_number string, text string, source_document_id string")
    wanted = spark.createDataFrame([("010121",), ("010121",), ("9801",), ("01012103",), (None,)], "code string")
    got = {r.code: r for r in cards.record_cards(records, wanted, notes=notes).collect()}
    assert set(got) == {"010121", "9801"}
    card = got["010121"]
    assert card.section.roman == "I" and card.formatted_code == "0101.21" and card.complete and card.record.description == "Pure"
    assert [r.code for r in card.hierarchy] == ["01", "0101", "010121"] and [r.code for r in card.children] == ["01012101", "01012102"]
    assert [n.text for n in card.national_notes] == ["first", "second"]
    assert got["9801"].section is None and not got["9801"].complete and got["9801"].children == [] and got["9801"].national_notes == []
    folded = records.withColumn("folded", F.lower("description"))
    hits = cards.suggestions(folded, "breeding other", limit=2, notes=notes).orderBy("rank").collect()
    assert [(h["rank"], h.code, len(h.national_notes)) for h in hits] == [(1, "01012101", 2), (2, "01012102", 2)] and all(h.disclaimer == cards.DISCLAIMER for h in hits)
    assert cards.suggestions(folded, "zzz").count() == 0


def test_notes_that_would_be_lost(spark):
    from codespine.sources import html

    texts = ["<h2>Capítulo 3</h2><p>1. Los peces.</p>", "<h2>Sección XXIX</h2><p>1. algo</p>", "<p>nada</p>", None, "<h2>Capítulo 3</h2><p>1. <b></b></p><h2>Capítulo 4</h2><p>2. dos</p>"]
    pages = spark.createDataFrame([(f"p{k}", t) for k, t in enumerate(texts)], "source_document_id string, html string")
    got = {(r.source_document_id, r.reason, r.scope_value) for r in html.note_problems(pages).collect()}
    assert {("p1", "unknown_section", "XXIX"), ("p2", "no_notes", None), ("p3", "no_notes", None)} <= got and not any(p == "p0" for p, _, _ in got)
    assert html.required_notes(pages.where("source_document_id = 'p0'")).count() == 1
    with pytest.raises(html.NotesError, match="p1: unknown_section"):
        html.required_notes(pages.where("source_document_id < 'p3'"))


def test_limits_of_the_serving_variants(spark):
    from codespine.operators import search
    from codespine.operators.hierarchy import QueryError

    rows = spark.createDataFrame([("01", "abc", "abc")], "code string, description string, folded string")
    assert search.served_search(rows, "abc", limit=50).count() == 1 and search.served_suggest(rows, "abc", limit=20).count() == 1
    for ask, limit in ((search.served_search, 51), (search.served_suggest, 21), (search.served_search, 0)):
        with pytest.raises(QueryError):
            ask(rows, "abc", limit=limit)


def test_a_read_only_package_goes_to_workers(spark, tmp_path, monkeypatch):
    import zipfile

    from codespine import workers

    sent = []
    monkeypatch.setattr(workers, "_SENT", set())
    monkeypatch.setattr(type(spark.sparkContext), "addPyFile", lambda self, path: sent.append(zipfile.ZipFile(path).namelist()))
    workers.ready(spark)
    assert "codespine/workers.py" in sent[0] and "codespine/sources/html.py" in sent[0] and not any(n.endswith(".pyc") for n in sent[0])
