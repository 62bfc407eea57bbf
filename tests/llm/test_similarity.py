"""SimHash, search, decontamination and licences against brute force."""

import pickle
import random
import re
import textwrap
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from codespine.llm import ann, catalog, common, decontaminate, licences, simhash, similar
from codespine.llm import components as linked
from codespine.llm.common import table
from codespine.llm.components import components
from pyspark.sql import functions as F

from .helpers import EDGES, documents


def fingerprint(text, width=4):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(ids, fps, radius):
    root = dict(zip(ids, ids, strict=True))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(ids):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= radius:
                x, y = find(a), find(ids[j])
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def near_texts():
    rng = random.Random(2)
    words = [f"w{k}" for k in range(300)]
    base = [" ".join(rng.choice(words) for _ in range(rng.randrange(60, 200))) for _ in range(12)]
    out = []
    for t in base:
        for _ in range(4):
            cut = t.split()
            for _ in range(rng.randrange(3)):
                cut[rng.randrange(len(cut))] = rng.choice(words)
            out.append(" ".join(cut))
    return out + EDGES[:7]


@pytest.mark.parametrize("bucket", [1, 1024])
def test_simhash_components(spark, bucket):
    texts = near_texts()
    docs = documents(spark, texts, extra=True)
    got = {r.doc_id: r for r in simhash.near_duplicates(docs, bucket=bucket).collect()}
    fps = [fingerprint(t) for t in texts]
    want = classes(list(range(len(texts))), fps, 4)
    assert {k: r.fp % 2**64 for k, r in got.items()} == dict(enumerate(fps))
    assert {k: r.component_id for k, r in got.items()} == want


def grams(text, width=5):
    words = (text or "").encode().lower().split()
    return {b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def alike(a, b):
    return bool(a or b) and len(a & b) >= 0.8 * len(a | b)


def check_one_of_each_group(docs, kept):
    """``docs``: text by id. Exactly the smallest id of each group of alike shingle sets stays."""
    ids = sorted(docs)
    groups = similar_groups([docs[i] for i in ids])
    assert set(kept) == {ids[k] for k in groups.values()}


def test_repeated_ids_fill_one_rank(spark):
    rng = np.random.default_rng(2)
    same, other = rng.normal(size=8), rng.normal(size=8)
    rows = [(50, same.tolist())] * 7 + [(51, same.tolist())] * 3 + [(51, other.tolist()), (52, (-same).tolist()), (100, other.tolist()), (100, (same + 0.1).tolist())] + [(200 + k, rng.normal(size=8).tolist()) for k in range(30) if k % 50]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ann.search(df, F.col("vec_id") % 50 == 0, k=3, probes=1.0, shortlist=100).collect()
    unit = lambda v: np.array(v) / np.linalg.norm(v)
    want = []
    for query, vector in sorted({(i, tuple(v)) for i, v in rows if i % 50 == 0}):
        best = {}
        for i, v in rows:
            if i != query:
                best[i] = max(best.get(i, -2), float(unit(vector) @ unit(v)))
        want += [(query, r, i, round(s, 9)) for r, (i, s) in enumerate(sorted(best.items(), key=lambda x: (-x[1], x[0]))[:3], 1)]
    assert sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in got) == sorted(want)
    assert sum(r.query_id == 100 for r in got) == 6 and [r.vec_id for r in got if r.query_id == 50 and r["rank"] == 1] == [51]


def test_simhash_keeps_one_of_each_group(spark):
    texts = [*near_texts(), None]
    docs = documents(spark, texts)
    kept = [r.doc_id for r in simhash.deduplicated(docs.union(docs.limit(5))).collect()]
    assert len(kept) == len(set(kept))
    check_one_of_each_group(dict(enumerate(texts)), set(kept))
    assert simhash.deduplicated(documents(spark, [])).count() == 0
    hot = simhash.near_duplicates(docs, width=5, similarity=0.8, bucket=1).select("component_id").distinct().count()
    assert hot == len(kept)


def test_rows_that_share_an_id_are_told_apart(spark):
    same, other = "one two three four five six seven eight nine ten", "nothing alike here at all in any of these words"
    rows = [(1, same, "a"), (1, other, "a"), (1, same, "a"), (2, same, "b"), (1, same, "z"), (None, same, "a"), (None, same, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row_hash string")
    got = simhash.deduplicated(docs).collect()
    assert sorted((r.doc_id, r.text) for r in got if r.doc_id) == sorted([(1, same), (1, other)])
    assert sum(r.doc_id is None for r in got) == 2
    assert sorted(tuple(r) for r in got if r.doc_id) == sorted(tuple(r) for r in simhash.deduplicated(docs.orderBy(F.desc("text"))).collect() if r.doc_id)
    plan = simhash.deduplicated(docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id", "text"]))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan


def similar_groups(texts):
    """The smallest index of each group that pairs with a Jaccard similarity of 0.8 or equal sets join."""
    sets, root = [grams(t) for t in texts], list(range(len(texts)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a == sets[j] or alike(a, sets[j]):
                x, y = root[i], root[j]
                root = [min(x, y) if r in (x, y) else r for r in root]
    return dict(enumerate(root))


def found_groups(spark, texts, **options):
    return {r.doc_id: r.component_id for r in simhash.near_duplicates(documents(spark, texts), width=5, similarity=0.8, **options).collect()}


def edited(rng, words, n, edits):
    """``n`` texts, each with that many runs of other words in the same 300."""
    out = []
    for _ in range(n):
        text = list(words)
        for at in rng.sample(range(len(text) // 10), edits):
            text[10 * at] = f"x{rng.random()}"
        out.append(" ".join(text))
    return out


def test_all_pairs_above_the_similarity_are_found(spark):
    rng = random.Random(8)
    texts = []
    for k in range(120):
        base = [f"w{k}-{i}" for i in range(200)]
        texts += [" ".join(base), *edited(rng, base, 1, 1 + k % 6)]
    want = similar_groups([*texts, *EDGES])
    assert len(set(want.values())) < 160
    assert found_groups(spark, [*texts, *EDGES]) == want


def test_hot_groups_of_near_copies(spark):
    rng = random.Random(9)
    texts = [t for k in range(2) for t in edited(rng, [f"w{k}-{i}" for i in range(300)], 150, 4)]
    want = similar_groups(texts)
    assert found_groups(spark, texts, bucket=1) == found_groups(spark, texts, bucket=1024) == want


def test_a_nearer_text_hides_no_partner(spark):
    rng = random.Random(10)
    shared = [f"s{i}" for i in range(150)]
    texts = []
    for k in range(60):  # a passage of all, and three texts of each kind, of which the first two are alike
        own = [f"o{k}-{i}" for i in range(50)]
        texts += edited(rng, shared + own, 2, 2) + edited(rng, shared + own, 1, 9)
    want = similar_groups(texts)
    assert found_groups(spark, texts) == want


def test_equal_fingerprints_need_the_similarity(spark):
    often = "same " * 400
    texts = [often + " ".join(f"{x}{i}" for i in range(40)) for x in "ab"]
    assert fingerprint(texts[0], 5) == fingerprint(texts[1], 5) and not alike(*map(grams, texts))
    assert found_groups(spark, texts) == {0: 0, 1: 1}


def test_pivots_discard_no_link():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**63, 500, dtype=np.uint64)
    b = a ^ np.array([sum(1 << int(k) for k in rng.choice(64, 4, replace=False)) for _ in a], np.uint64)
    rows = [np.bitwise_count(x[:, None] ^ simhash.PIVOTS).astype(int) for x in (a, b)]
    assert np.abs(rows[0] - rows[1]).max() <= 4


def test_parity_bits_rule_out_no_similar_pair():
    rng = np.random.default_rng(5)
    for n in (1, 3, 60, 90, 500, 2000, 9000):
        for _ in range(30):
            common = rng.integers(-(2**63), 2**63 - 1, n)
            a, b = (np.unique(np.concatenate([common, rng.integers(-(2**63), 2**63 - 1, int(rng.integers(0, n // 4 + 2)))])) for _ in range(2))
            apart = len(np.setxor1d(a, b))
            x, y = similar.parity(a), similar.parity(b)
            for size in (16, min(len(x), len(y))):
                assert np.bitwise_count(similar.folded(x, size) ^ similar.folded(y, size)).sum() <= apart
        far = rng.integers(-(2**63), 2**63 - 1, n)
        if n > 3:  # sets that share nothing are told apart
            z = similar.parity(np.unique(far))
            size = min(len(x), len(z))
            assert np.bitwise_count(similar.folded(x, size) ^ similar.folded(z, size)).sum() > (len(a) + len(far)) / 9
    assert similar.parity(np.zeros(0, np.int64)).tobytes() == bytes(16)


def test_pivot_tables_rule_out_no_similar_pair():
    rng = np.random.default_rng(6)
    hashes = lambda n: rng.integers(-(2**63), 2**63 - 1, n)
    for n in (0, 1, 5, 60, 700, 40_000):
        for _ in range(10):
            common = hashes(n)
            a, b = (np.unique(np.concatenate([common, hashes(int(rng.integers(0, n // 4 + 2)))])) for _ in range(2))
            tables = [similar.pivots(x).astype(int) for x in (a, b)]
            assert np.abs(tables[0] - tables[1]).max() <= len(np.setxor1d(a, b))
            for x, table in zip((a, b), tables, strict=True):  # the signs are the set's fingerprint
                if len(x):
                    fp = int(simhash.majority(x.view(np.uint64), np.array([len(x)]))[0])
                    assert [fp >> k & 1 for k in range(64)] == (table > 0).astype(int).tolist()
    far = [similar.pivots(np.unique(hashes(60))).astype(int) for _ in range(2)]
    assert np.abs(far[0] - far[1]).max() > 120 / 9
    assert similar.pivots(np.arange(40_000) * 2 + 1)[0] == 2**15 - 1


def test_near_duplicates_are_found_by_fingerprints_and_pivots(spark, monkeypatch):
    """Without the rounds of the exact join, what fingerprints propose is verified and linked all the same."""
    rng = random.Random(12)
    base = [[f"w{k}-{i}" for i in range(300)] for k in range(12)]
    often = "same " * 400  # equal fingerprints, different sets
    texts = [t for words in base for t in [" ".join(words), *edited(rng, words, 3, 1)]] + [often + " ".join(f"{x}{i}" for i in range(40)) for x in "ab"] + EDGES
    sets, fps = [grams(t) for t in texts], [fingerprint(t, 5) for t in texts]
    near = [(i, j) for j in range(len(texts)) for i in range(j) if sets[i] != sets[j] and (fps[i] ^ fps[j]).bit_count() <= 4]
    good = [(i, j) for i, j in near if alike(sets[i], sets[j])]
    assert len(good) > 10 and len(good) < len(near)
    rows = simhash.similar(documents(spark, texts), width=5, similarity=0.8)[0].collect()
    node = {r.doc_id: r.node for r in rows}
    pairs = [(r.a, r.b) for r in simhash.proposed(spark.createDataFrame(rows, "doc_id long, fp long, node long")).collect()]
    spanned = lambda links: classes_of(links, set(node.values()))
    assert spanned(pairs) == spanned([(node[i], node[j]) for i, j in near])
    monkeypatch.setattr(similar, "ROUNDS", ())
    got, want = found_groups(spark, texts), similar_groups(texts)
    assert all(want[k] == want[v] for k, v in got.items()) and sum(got[i] == got[j] for i, j in good) > len(good) // 2


def classes_of(links, nodes):
    root = {n: n for n in nodes}
    for a, b in links:
        x, y = sorted((root[a], root[b]))
        root = {n: x if r == y else r for n, r in root.items()}
    return root


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(60)] + [(100, 101), (101, 100), (7, 7)], "a long, b long")
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {k: 0 for k in range(61)} | {100: 100, 101: 100}


@pytest.mark.parametrize("at_once", [7, 1000])
def test_components_by_rounds_and_in_one_task(spark, monkeypatch, at_once):
    """Few links take no rounds of tables; many take them, with the same result."""
    rng = random.Random(14)
    links = [(rng.randrange(-90, 90), rng.randrange(-90, 90)) for _ in range(70)]
    tables = []
    monkeypatch.setattr(linked, "EDGES_AT_ONCE", at_once)
    monkeypatch.setattr(linked, "written", lambda df, keep=linked.written: tables.append(df) or keep(df))
    got = sorted((r.node, r.root) for r in components(spark.createDataFrame(links, "a long, b long")).collect())
    links = [(a, b) for a, b in links if a != b]
    assert got == sorted(classes_of(links, {n for pair in links for n in pair}).items())
    assert len(tables) == 2 if at_once == 1000 else len(tables) > 3
    assert not components(spark.createDataFrame([(5, 5)], "a long, b long")).count()


def test_few_pairs_are_few_files(spark, monkeypatch):
    """Files of intermediate tables follow their rows, not the number of shuffle partitions."""
    held = {"spark.sql.shuffle.partitions": "32", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {name: spark.conf.get(name) for name in held}
    rng = random.Random(15)
    texts = [t for k in range(12) for t in edited(rng, [f"w{k}-{i}" for i in range(60)], 8, 1)]
    files = []
    for module in (simhash, similar, linked):
        monkeypatch.setattr(module, "written", lambda df, keep=module.written: files.append(len((out := keep(df)).inputFiles())) or out)
    try:
        for name, value in held.items():
            spark.conf.set(name, value)
        got = found_groups(spark, texts)
    finally:
        for name, value in old.items():
            spark.conf.set(name, value)
    assert got == similar_groups(texts)
    assert sum(n > 8 for n in files) <= 7  # those whose rows can't be known before


def test_shingles_free_the_words_of_other_operators(spark, monkeypatch):
    """A worker that has scored toxicity doesn't hold its words any more while it makes shingle sets."""
    kept = {b"model": {b"word": b"place"}}
    monkeypatch.setitem(common._KEPT, "codespine.llm.toxicity", [kept])
    maps = []
    docs = documents(spark, ["a b c"]).selectExpr("doc_id", "cast(text as binary) AS data")
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, run, schema: maps.append(run))
    similar.shingled(docs, lambda t: simhash.shingle_hashes(t, 2), "n int", lambda each: {"n": pa.array([len(x) for x in each])})
    made = list(maps[0](iter([pa.RecordBatch.from_pydict({"doc_id": [0], "data": [b"a b c"]})])))
    assert made[0].to_pydict() == {"doc_id": [0], "n": [2]} and not kept


def vectors(spark, n=600, d=16, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)).astype(np.float32)
    x[50:90] = x[50]
    rows = [(k, v.tolist()) for k, v in enumerate(x)] + [(n, None), (n + 1, [0.0] * d), (n + 2, [float("nan")] + [1.0] * (d - 1)), (n + 3, [1.0]), (n + 4, []), (n + 5, [None] * d)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>"), x.astype(np.float64)


def test_neighbours(spark):
    df, x = vectors(spark)
    rows = ann.search(df.withColumn("id", F.lit("clash")).withColumn("v", F.lit(1)), F.col("vec_id") % 50 == 0, k=5, block=64).collect()
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    hits = 0
    for q in range(0, len(x), 50):
        mine = sorted((r for r in rows if r.query_id == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == [1, 2, 3, 4, 5] and all(r.vec_id != q for r in mine)
        cos = unit @ unit[q]
        assert all(abs(r.score - cos[r.vec_id]) < 1e-12 for r in mine)
        assert [(-r.score, r.vec_id) for r in mine] == sorted((-r.score, r.vec_id) for r in mine)
        cos[q] = -2
        hits += len({r.vec_id for r in mine} & set(np.lexsort((np.arange(len(x)), -cos.round(12)))[:5].tolist()))
    assert hits >= 0.9 * 5 * len(range(0, len(x), 50))
    assert {r.query_id for r in rows} == set(range(0, len(x), 50))


def test_all_cells_give_exact_neighbours_of_copies(spark):
    df, _ = vectors(spark)
    mine = [r.vec_id for r in ann.search(df, F.col("vec_id") == 50, k=5, probes=1.0, shortlist=600).orderBy("rank").collect()]
    assert mine == [51, 52, 53, 54, 55]


def test_few_or_no_vectors(spark):
    df, _ = vectors(spark)
    assert ann.search(df.limit(0), F.lit(True)).count() == 0
    few = ann.search(df.where("vec_id < 3"), F.col("vec_id") == 0, probes=1.0).collect()
    assert sorted(r.vec_id for r in few) == [1, 2]


def test_few_vectors_with_the_default_probes(spark):
    df, _ = vectors(spark)
    for n in range(2, 13):
        got = ann.search(df.where(F.col("vec_id") < n), F.lit(True)).collect()
        assert {q: sum(r.query_id == q for r in got) for q in range(n)} == dict.fromkeys(range(n), min(5, n - 1))


def recall_of(spark, sf_dir):
    rows = catalog.op1_ann(spark, sf_dir).collect()
    pdf = table(spark, sf_dir, "embeddings").toPandas()
    x = np.stack(pdf.embedding.to_numpy()).astype(np.float64)
    ids = pdf.vec_id.to_numpy()
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    hit = n = 0
    for k in np.flatnonzero(ids % 50 == 0):
        cos = x @ x[k]
        cos[k] = -2
        best = {int(i) for i in ids[np.lexsort((ids, -cos))[:5]]}
        hit += len(best & {r.vec_id for r in rows if r.query_id == ids[k]})
        n += 5
    return hit / n


def test_recall_on_the_table(spark, sf_dir):
    assert recall_of(spark, sf_dir) >= 0.9


@pytest.mark.parametrize("clusters", [0, 60])
def test_recall_on_ten_thousand_vectors(spark, clusters):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(10_000, 24))
    if clusters:
        x = 0.15 * x + rng.normal(size=(clusters, 24))[rng.integers(0, clusters, len(x))]
    x = x.astype(np.float32)
    df = spark.createDataFrame([(k, v) for k, v in enumerate(x.tolist())], "vec_id long, embedding array<float>")
    rows = ann.search(df, F.col("vec_id") % 100 == 0).collect()
    u = x.astype(np.float64)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    hits = 0
    for q in range(0, len(x), 100):
        cos = u @ u[q]
        cos[q] = -2
        mine = [r for r in rows if r.query_id == q]
        assert [r.rank for r in sorted(mine, key=lambda r: (-r.score, r.vec_id))] == [1, 2, 3, 4, 5] and all(abs(r.score - cos[r.vec_id]) < 1e-12 for r in mine)
        hits += len({r.vec_id for r in mine} & set(np.argsort(-cos)[:5].tolist()))
    assert hits >= 0.9 * 500


def test_clustered_vectors_need_few_cells_and_a_short_list():
    rng = np.random.default_rng(8)
    x = ann.unit(0.1 * rng.normal(size=(4000, 24)) + rng.normal(size=(40, 24))[rng.integers(0, 40, 4000)])
    model = ann.Quantiser.fit(x, 60, 12)
    visited, places = ann.measured(model, x, 5)
    assert visited <= 12 and places <= 400


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def hits_of(texts, items, window):
    wins = {}
    for i, t in items:
        w = words_of(t)
        for v in [tuple(w[k : k + window]) for k in range(len(w) - window + 1)] if len(w) >= window else [tuple(w)] * bool(w):
            wins.setdefault(v, set()).add(i)
    out = []
    for t in texts:
        w = words_of(t)
        hit, which = set(), set()
        for n in {len(v) for v in wins}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in wins:
                    hit |= set(range(k, k + n))
                    which |= wins[tuple(w[k : k + n])]
        out.append((len(w), hit, sorted(which)))
    return out


@pytest.mark.parametrize("block_bytes", [30, 1 << 20])
def test_occurrences(spark, block_bytes):
    rng = random.Random(5)
    say = lambda n: " ".join(rng.choice(["a", "B", "c", "d-e", "é"]) for _ in range(n))
    items = [(k, say(rng.randrange(0, 9))) for k in range(12)] + [(12, None), (13, ""), (14, say(4)), (15, say(4))]
    texts = [say(rng.randrange(0, 50)) for _ in range(60)] + EDGES
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: r for r in decontaminate.occurrences(documents(spark, texts, extra=True), bench, window=4, block_bytes=block_bytes).collect()}
    for k, (n, hit, which) in enumerate(hits_of(texts, items, 4)):
        r = got[k]
        assert (r.n_words, {i for s in r.spans for i in range(s.first, s.after)}, r["items"]) == (n, hit, which)


def test_decontaminated_texts_hold_no_long_match(spark, sf_dir):
    docs, bench = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    before = decontaminate.occurrences(docs, bench)
    clean = decontaminate.decontaminate(docs, bench)
    assert before.where(F.size("spans") > 0).count() > 0
    assert decontaminate.occurrences(clean, bench).where(F.size("spans") > 0).count() == 0
    untouched = before.where(F.size("spans") == 0).join(docs, "doc_id").select("doc_id", "text")
    assert untouched.join(clean, "doc_id").where(clean.text.eqNullSafe(untouched.text)).count() == untouched.count()
    assert decontaminate.decontaminate(docs, bench.limit(0)).count() == docs.count()
    assert decontaminate.decontaminate(docs.limit(0), bench).count() == 0


def test_blocks_of_items_change_no_cut(spark):
    rng = random.Random(6)
    say = lambda n: " ".join(rng.choice("abcd") for _ in range(n))
    items = spark.createDataFrame([(k, say(rng.randrange(2, 12))) for k in range(14)], "item_id long, text string")
    docs = documents(spark, [say(rng.randrange(0, 40)) + " z " + say(5) for _ in range(80)] + EDGES, extra=True).withColumn("spans", F.lit(1))
    one, many = (decontaminate.decontaminate(docs, items, window=6, longest=6, block_bytes=size).orderBy("doc_id").collect() for size in (1 << 20, 30))
    assert one == many and 0 < len(one)


@pytest.mark.parametrize("block_bytes", [8, 1 << 20])
def test_a_cut_leaves_no_new_window(spark, block_bytes):
    a, b = [f"a{k}" for k in range(10)], [f"b{k}" for k in range(10)]
    items = [(1, " ".join(a)), (2, " ".join(b)), (3, "x y z x y z x y z x")]
    docs = documents(spark, ["p q " + " ".join(a[:5] + b + a[5:]) + " z", " ".join(a[:5] + b + a[5:]), "p " + " ".join(a[:4]) + " " + " ".join(b + b) + " q"])
    got = {r.doc_id: r.text.split() for r in decontaminate.decontaminate(docs, spark.createDataFrame(items, "item_id long, text string"), block_bytes=block_bytes).collect()}
    assert got == {0: ["p", "q", "z"], 2: ["p", *a[:4], "q"]}


@pytest.mark.parametrize("block_bytes", [6, 1 << 20])
def test_coverage_is_of_all_items_together(spark, block_bytes):
    items = spark.createDataFrame([(1, "a b c"), (2, "d e f")], "item_id long, text string")
    docs = documents(spark, ["a b c x1 x2 x3 x4 d e f", "a b c x1 x2 x3 x4 x5"])
    got = {r.doc_id: (r.text or "").split() for r in decontaminate.decontaminate(docs, items, block_bytes=block_bytes).collect()}
    assert got == {0: ["x1", "x2", "x3", "x4"], 1: "a b c x1 x2 x3 x4 x5".split()}


def test_a_full_block_is_small_on_the_workers():
    rng = random.Random(9)
    vocabulary = [f"{rng.choice('bcdfg')}{rng.choice('aeiou')}{k}" for k in range(20_000)]
    items = [(k, " ".join(rng.choices(vocabulary, k=60)).encode()) for k in range(1200)]
    size = sum(len(t) for _, t in items)
    assert len(pickle.dumps(decontaminate.Automaton(items, 10))) <= 16 * size  # 64 MB of a block of 4 MB


def test_cleaning_keeps_the_rest():
    data = b"one two, three four"
    assert decontaminate.cleaned(data, [(1, 3)]) == b"one  four"


def licence_brute(text):
    """Every run that begins or ends where the template would around one of its anchors."""
    words = licences.normal_words(text or "")
    grams, found = licences.bigrams(words), []
    for name, template in licences.known_bigrams(licences.TEMPLATES).items():
        want, where = Counter(template), licences.anchors(template, 0.8)
        starts = {k - where[g] for k, g in enumerate(grams) if g in where}
        for n in range(1, 2 * len(template)):
            for at in {s for s in starts} | {s + len(template) - n for s in starts}:
                score = 2.0 * sum((Counter(grams[at : at + n]) & want).values()) / (n + len(template)) if 0 <= at <= len(grams) - n else 0.0
                if score >= 0.8:
                    found.append((at + n + 1, at, -score, name))
    n, after = 0, 0
    for end, at, *_ in sorted(found):
        if at >= after:
            n, after = n + 1, end
    best = min(((m, name) for _, _, m, name in found), default=None)
    return n, best and best[1], best and -best[0]


def family(name):
    """A notice holds the shorter statements of the same licence whole, of which the first name wins."""
    return name and name.split("-")[0]


def check_licences(spark, texts):
    got = {r.doc_id: (r.n_matches, r.licence, r.score) for r in licences.scan(documents(spark, texts, extra=True)).collect()}
    for k, t in enumerate(texts):
        n, name, score = licence_brute(t)
        assert got[k][:2] == (n, name) and (score is None) == (got[k][2] is None) and (score is None or abs(score - got[k][2]) < 1e-12), t
    return got


def test_licences(spark):
    rng = random.Random(3)
    texts = [*licences.TEMPLATES.values(), "x\nReleased under the MIT License!\nz", "Licensed under  CC-BY NC 4.0 today", *EDGES, "Released under the MIT License. " * 40]
    for t in licences.TEMPLATES.values():
        w = t.split()
        del w[rng.randrange(len(w))]
        texts.append("Before.\n" + " ".join(w).upper() + "\nAfter that.")
    got = check_licences(spark, texts)
    names = list(licences.TEMPLATES)
    assert all(family(got[k][1]) == family(name) and got[k][2] == 1 for k, name in enumerate(names))
    assert got[len(names)][:2] == (1, "MIT") and got[len(names) + 2 + len(EDGES)][:2] == (40, "MIT")
    assert licences.scan(documents(spark, [])).count() == 0


def test_wrapped_and_shared_lines(spark):
    def wrapped(t, mark):
        return f"import os\n{mark} Copyright 2020 somebody\n" + "".join(f"{mark} {x}\n" for x in textwrap.wrap(t, 44)) + "\ndef f(x):\n    return x + 1\n"

    templates = list(licences.TEMPLATES.items())
    texts = [wrapped(t, mark) for _, t in templates for mark in ("#", " *")] + [f"We thank all who wrote parts of this small tool. {t} And more is to come." for _, t in templates]
    got = check_licences(spark, texts)
    assert [family(got[k][1]) for k in range(len(texts))] == [family(n) for n, _ in templates for _ in range(2)] + [family(n) for n, _ in templates]
    assert all(got[k][2] == 1 for k in got)


def test_every_match_has_an_anchor_and_a_marker():
    known = licences.known_bigrams(licences.TEMPLATES)
    marks, rng = licences.markers(known, 0.8), random.Random(4)
    for t in known.values():
        few = licences.sizes(t, 0.8)[0]
        for _ in range(200):
            held = {t[k] for k in rng.sample(range(len(t)), few)}
            assert held & set(licences.anchors(t, 0.8)) and any(m in g for m in marks for g in held)


def test_search_is_measured_with_the_queries(spark):
    """Queries that lie apart from most vectors need other cells and shortlists than these."""
    rng = np.random.default_rng(0)
    x = rng.normal(size=(6000, 32))
    x[::50] = rng.normal(size=32) + 0.05 * rng.normal(size=(120, 32))
    rows = spark.createDataFrame([(k, v) for k, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    got = ann.search(rows, F.col("vec_id") % 50 == 0).collect()
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    found = 0
    for q in range(0, 6000, 50):
        near = u @ u[q]
        near[q] = -2
        found += len({r.vec_id for r in got if r.query_id == q} & set(np.argsort(-near)[:5].tolist()))
    assert len(got) == 600 and found >= 0.9 * 600
