"""Token counts, alignment and phrases against the libraries, brute force and SQL."""

import hashlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest
from codespine.llm import align, bpe, counts, phrases
from codespine.llm.catalog import op11_token_counts, op12_alignment, op13_collocations, oracle_sql, vocabulary_file
from codespine.llm.common import table, written

from pyspark.sql import functions as F

from .helpers import EDGES, documents

BYTE, PIECE, WORD = map(vocabulary_file, ("byte_bpe_50k.json", "piece_bpe_32k.model", "word_bpe_49k.json"))
ODD = [*EDGES, " lead", "  two", "trail ", "a  b", "a\n b", "\n\nx y", "a\xa0 b 　c", "▁ u", "<|endoftext|> <|endoftext|>x y", "'s 't it's", "<0x41> <s> <unk>", "日本 語", "\x1c \x1d a"]


def library_counts(path, texts):
    if path.endswith(".model"):
        import sentencepiece

        return list(map(len, sentencepiece.SentencePieceProcessor(model_file=path).encode(texts, num_threads=1)))
    from tokenizers import Tokenizer

    return [len(e.ids) for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("path", [BYTE, PIECE, WORD])
def test_counts_are_the_librarys(spark, path):
    got = {r.doc_id: r for r in counts.token_counts(documents(spark, ODD, extra=True), path, limit=3).collect()}
    texts = [t or "" for t in ODD]
    assert [got[k].n_tokens for k in range(len(ODD))] == library_counts(path, texts)
    assert [got[k].n_bytes for k in range(len(ODD))] == [len(t.encode()) for t in texts]
    assert all(r.over_limit == (r.n_tokens > 3) for r in got.values())


def test_counts_of_the_table(spark, sf_dir):
    texts = {r.doc_id: r.text or "" for r in table(spark, sf_dir, "documents").select("doc_id", "text").collect()}
    got = {r.doc_id: r.n_tokens for r in op11_token_counts(spark, sf_dir).collect()}
    assert got == dict(zip(texts, library_counts(BYTE, list(texts.values())), strict=True))


def test_counts_of_empty_tables_and_repeated_rows(spark):
    docs = documents(spark, ["a b", None])
    assert counts.token_counts(docs.limit(0), BYTE).count() == 0
    rows = counts.token_counts(docs.union(docs).selectExpr("IF(text IS NULL, doc_id, NULL) AS doc_id", "text"), BYTE).collect()
    assert sorted((r.doc_id is None, r.n_tokens) for r in rows) == [(False, 0), (False, 0), (True, 2), (True, 2)]


def test_kept_words_are_bounded(monkeypatch):
    monkeypatch.setattr(counts, "KEPT_WORDS", 5)
    ask = counts.Lengths(BYTE)
    texts = [f"word{k} and other{k} things" for k in range(50)]
    assert [n for t in texts for n in ask.of([t])] == library_counts(BYTE, texts)
    assert len(ask.known) < 20


def brute_alignment(rows):
    """(key, text) rows: what the contract says, from whole texts and all links."""
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(BYTE), sentencepiece.SentencePieceProcessor(model_file=PIECE)
    a.encode_special_tokens = True
    both = align.Pair(BYTE, PIECE)
    docs, held = [], Counter()
    for key, text in rows:
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        bytes_a, bytes_b = [both.bytes_a[i] for i in ids_a], [both.bytes_b[i] for i in ids_b]
        if not text or b"".join(bytes_a) != (" " + text).encode() or b"".join(bytes_b) != (" " + text).encode():
            docs.append((key, 0, 0, [], []))
            continue
        end_a, end_b = np.cumsum(list(map(len, bytes_a))).tolist(), np.cumsum(list(map(len, bytes_b))).tolist()
        cuts = sorted(set(end_a) & set(end_b))
        groups = [([], []) for _ in cuts]
        for side, ids, ends in ((0, ids_a, end_a), (1, ids_b, end_b)):
            for i, e in zip(ids, ends, strict=True):
                groups[int(np.searchsorted(cuts, e))][side].append(i)
        links = [(x, y) for g in groups for x in g[0] for y in g[1]]
        held.update(set(links))
        docs.append((key, len(ids_a), len(ids_b), groups, links))
    most = defaultdict(int)
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    out = []
    for key, na, nb, groups, links in docs:
        shown = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        digest = hashlib.sha256(shown.encode()).hexdigest() if groups else ""
        out.append((key, na, nb, len(groups), len(links), sum(held[p] == most[p[0]] for p in links), sum(held[p] for p in links), digest))
    return out, held


ALIGNED = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_alignment_is_all_links(spark):
    texts = [t if t is None or len(t) < 10_000 else t[:3000] for t in ODD] + ["the cat sat on thé mat", "unaligned xxxxxxx yyyyyyyyyyy xxxxx" * 3, "the cat sat"]
    found, pairs = align.alignment(documents(spark, texts, extra=True), BYTE, PIECE)
    want, held = brute_alignment(list(enumerate(texts)))
    assert sorted(tuple(r[c] for c in ALIGNED) for r in found.collect()) == sorted(want)
    assert {(r.a, r.b): r.n for r in pairs.collect()} == dict(held)


def test_alignment_of_the_table(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in table(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    got = sorted(tuple(r[c] for c in ALIGNED) for r in op12_alignment(spark, sf_dir).collect())
    assert got == sorted(brute_alignment(rows)[0])


def test_alignment_of_empty_tables_and_repeated_rows(spark):
    docs = documents(spark, ["a ba", None, "a ba"])
    assert align.alignment(docs.limit(0), BYTE, PIECE)[0].count() == 0
    found = align.alignment(docs.selectExpr("CAST(NULL AS BIGINT) AS doc_id", "text"), BYTE, PIECE)[0].collect()
    assert sorted((r.doc_id, r.n_a > 0) for r in found) == [(None, False), (None, True), (None, True)]


def test_small_portions_and_dictionaries_change_nothing(monkeypatch):
    texts = [f"some words{k} about the same things {k % 7} again" for k in range(60)]
    whole = align.Pair(BYTE, PIECE).portion(texts)
    monkeypatch.setattr(align, "KEPT_WORDS", 4)
    small = align.Pair(BYTE, PIECE)
    digests = [d for t in texts for d in small.portion([t])[2]]
    assert digests == whole[2] and len(small.known) < 20


def brute_phrases(rows, least, top):
    """(lang, text) rows."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang, pieces = lang or "und", [[]]
        for c in (text or "").encode() + b".":
            pieces[-1].append(c + 32 if 65 <= c <= 90 else c)
            if chr(c) in ".,;:!?\n\x0b\x0c\r":
                pieces[-1].pop()
                pieces.append([])
        for p in pieces:
            w = [x for x in bytes(p).replace(b"\t", b" ").split(b" ") if x]
            n[lang] += len(w)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i : i + k])] += 1
    cand = {k: v for k, v in f.items() if len(k[1]) > 1 and v >= least}
    gone = {(lang, p[i : i + k]) for (lang, p), v in cand.items() for k in range(2, len(p)) for i in range(len(p) - k + 1) if 100 * v >= 80 * f[lang, p[i : i + k]]}
    out = defaultdict(list)
    for (lang, p), a in cand.items():
        if (lang, p) not in gone:
            s, k = min((2_000_000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k) for k in range(1, len(p)))
            out[lang].append((-s, -a, b" ".join(p), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted((lang, r, p.decode(), -a, left, right, n[lang], -s) for lang, x in out.items() for r, (s, a, p, left, right) in enumerate(sorted(x)[:top], 1))


COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


@pytest.mark.parametrize("small", [False, True])
def test_phrases_are_all_counts(spark, sf_dir, monkeypatch, small):
    if small:
        monkeypatch.setattr(phrases, "PORTION_BYTES", 2000)
        monkeypatch.setattr(phrases, "RANGE_KEYS", 50)
    odd = documents(spark, [*EDGES[:-2], "A b\tC d. a B c d, a b\x0bc d", "x x x x x x x x", "é É e", "one two three four five " * 40, "a b c d\x00 e\x1c f " * 9]).withColumn("lang", F.expr("IF(doc_id % 3 = 0, NULL, lang)"))
    docs = odd.unionByName(odd) if small else odd.select("doc_id", "text", "lang").unionByName(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    least, top = (2, 15) if small else (4, 300)
    got = sorted(tuple(r[c] for c in COLUMNS) for r in phrases.collocations(docs, least=least, top=top).collect())
    assert got == brute_phrases([(r.lang, r.text) for r in docs.collect()], least, top)


def test_phrases_equal_their_sql(spark):
    folder = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    want = con.sql(f"SELECT {', '.join(COLUMNS)} FROM ({oracle_sql()['op13_collocations']})").fetchall()
    df = op13_collocations(spark, folder)
    assert dict(df.dtypes) == {c: "string" if c in ("lang", "phrase") else "bigint" for c in COLUMNS}
    assert sorted(tuple(r[c] for c in COLUMNS) for r in df.collect()) == sorted(want)
    assert len(want) > 200


def test_phrases_of_an_empty_table(spark):
    assert phrases.collocations(documents(spark, ["a b"]).limit(0)).count() == 0
    assert phrases.collocations(documents(spark, [None, "", "a b a b"])).count() == 0


def test_keys_are_sorted_and_counted():
    rng = np.random.default_rng(5)
    for n in (2, 3, 4):
        keys = rng.choice(np.array([1, 2, 70_000, 1 << 31, (1 << 32) - 1], np.uint32), (500, n))
        order = phrases.radix_order(keys)
        assert list(map(tuple, keys[order].tolist())) == sorted(map(tuple, keys.tolist()))
        seq = rng.integers(0, 4, 300).astype(np.uint32)
        got, count = phrases.counted(seq, n)
        plain = [tuple(w) for i in range(len(seq) - n + 1) if 0 not in (w := seq[i : i + n].tolist())]
        assert dict(zip(map(tuple, got.tolist()), count.tolist(), strict=True)) == Counter(plain)
        good = rng.random(len(got)) < 0.7
        fine = {g for g, k in zip(map(tuple, got.tolist()), good, strict=True) if k}
        left = Counter(tuple(w) for w in phrases.windows(phrases.broken(seq, n, good), n + 1)[1].tolist()) if n < 4 else None
        want = Counter(tuple(w) for w in phrases.windows(seq, n + 1)[1].tolist() if {tuple(w[:-1]), tuple(w[1:])} <= fine)
        assert left is None or left == want


def test_alignment_holds_little_at_once(spark, monkeypatch):
    rng = np.random.default_rng(4)
    keys = [np.array([2, *rng.integers(0, 6, 4)], "<u4").tobytes() for _ in range(40)]
    each = np.unique(rng.integers(0, 60 * 40, 900))
    found = [align.surplus(each // 40, each % 40, keys)]
    monkeypatch.setattr(align, "ROWS_AT_ONCE", 7)
    found.append(align.surplus(each // 40, each % 40, keys))
    assert all(np.array_equal(a, b) for a, b in zip(*found, strict=True)) and len(found[0][0])
    long = np.arange(301, dtype="<u4").tobytes()
    links = align.expanded(spark.createDataFrame([(long[:0] + (150).to_bytes(4, "little") + long[4:], 3)], "key binary, held bigint")).collect()
    assert len(links) == 150 * 150 and {len(r[0]) for r in links} == {32}


def test_row_groups_are_bounded_in_bytes(spark):
    rows = spark.range(0, 60, 1, 1).selectExpr("id", "sha2(string(id), 256) AS h").selectExpr("id", "repeat(h, 40000) AS text")
    read = written(rows, "none")
    sizes = [g for path in read.inputFiles() for m in [pq.ParquetFile(path.removeprefix("file://")).metadata] for g in [m.row_group(k).total_byte_size for k in range(m.num_row_groups)]]
    assert read.count() == 60 and max(sizes) < 48 << 20 < sum(sizes)


def test_a_worker_keeps_the_words_of_one_operator():
    bpe.vocabulary(BYTE).encode_all(["some words"])
    assert bpe.vocabulary(BYTE).words
    counts.lengths(BYTE)
    assert not bpe._LOADED and counts._LOADED
