"""Folding without Python workers and the trigram index, against Python and the full scan."""

import unicodedata

import pytest
from codespine.functions import folding, text
from codespine.operators import search, search_index
from codespine.operators.hierarchy import QueryError
from codespine.plans import catalog, inputs
from codespine.storage import shared_dir
from pyspark.sql import functions as F


def python_fold(t):
    return " ".join("".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c)).casefold().split())


def python_kept(t):
    return "".join(c for c in unicodedata.normalize("NFKD", " ".join(t.split())) if not unicodedata.combining(c))


def test_every_character_folds_as_in_python(spark):
    chars = [chr(c) for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF and (c < 0x3400 or 0xA000 <= c < 0x20000 or 0x2F800 <= c < 0x2FA20 or c % 997 == 0)]
    texts = ["x" + "y".join(chars[k : k + 60]) + "z" for k in range(0, len(chars), 60)]
    texts += ["", " \t\x1c\x85  ", "Straße ÁÑ½ ﬁn", "각 가나다 ẹ́ ¨a", "İstanbul ǅ", "ß", "ẞ"]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string").repartition(4)
    for row in df.select("t", text.fold("t").alias("f"), text.fold_case_kept("t").alias("c")).collect():
        assert row.f == python_fold(row.t), ascii(row.t)
        assert row.c == python_kept(row.t), ascii(row.t)


def test_search_needs_no_python(spark, sf_dir):
    plan = catalog.queries()["search_text_topk"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert folding.tables(True) is folding.tables(True)


@pytest.fixture(scope="module")
def index(spark, sf_dir):
    nodes = inputs.tree(spark, sf_dir).withColumn("folded", text.fold("description"))
    return search_index.build(nodes, shared_dir(spark)), nodes


@pytest.mark.parametrize("query", ["Réd widget small", "widg", "07", "0101", "no such token here", "ed", "blue  BLUE", "12345678901", "ß"])
@pytest.mark.parametrize("limit", [3, 10_000])
def test_index_finds_what_the_scan_finds(index, query, limit):
    built, nodes = index
    columns = ["code", "description", "score", "match_kind", "confidence"]
    got = search_index.search(built, query, limit=limit).select(*columns).collect()
    assert got == search.search(nodes, query, limit=limit).select(*columns).collect()


def test_index_prunes_blocks(spark, monkeypatch):
    monkeypatch.setattr(search_index, "BLOCK_BITS", 4)
    rows = spark.createDataFrame([(f"{k:08d}", f"item number {k} of {'quartz' if k == 777 else 'stone'}") for k in range(1000)], "code string, description string")
    built = search_index.build(rows.withColumn("folded", text.fold("description")), shared_dir(spark))
    found = search_index.search(built, "quartz", limit=5)
    assert [r.code for r in found.collect()] == ["00000777"]
    assert "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString().lower()
    assert search_index.pruned(built, "quartz").count() == 1
    again = search_index.opened(spark, built.records.inputFiles()[0].split("/records/")[0])
    assert [r.code for r in search_index.search(again, "quartz", limit=5).collect()] == ["00000777"]
    with pytest.raises(QueryError):
        search_index.search(built, " ", limit=5)


def test_index_of_odd_records(spark):
    rows = spark.createDataFrame([(None, "a b"), ("01", None), ("01", "abc"), ("01", "abc")], "code string, description string").withColumn("folded", F.col("description"))
    built = search_index.build(rows, shared_dir(spark))
    assert search_index.search(built, "abc", limit=9).count() == 2 and search_index.search(built, "01", limit=9).count() == 3
    empty = search_index.build(rows.limit(0), shared_dir(spark))
    assert search_index.search(empty, "abc", limit=9).count() == 0
