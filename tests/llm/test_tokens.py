"""BPE and token files against the tokenizers library."""

import hashlib
import zlib

import numpy as np
import pytest
from codespine.llm import bpe, tokenfile
from codespine.llm.catalog import vocabulary_file
from codespine.llm.common import table
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from .helpers import EDGES, documents

BYTES, WORDS = vocabulary_file("byte_bpe_50k.json"), vocabulary_file("word_bpe_49k.json")

LIBRARY = Tokenizer.from_file(BYTES)


@pytest.fixture(scope="module")
def library():
    return {p: Tokenizer.from_file(p) for p in (BYTES, WORDS)}


def check_bpe(library, spark, docs):
    got = {r.doc_id: r for r in bpe.digests(docs, BYTES).collect()}
    rows = docs.collect()
    assert len(got) == len(rows)
    for r in rows:
        ids = library[BYTES].encode(r.text or "", add_special_tokens=False).ids
        back = library[BYTES].decode(ids, skip_special_tokens=False)
        want = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest())
        assert (got[r.doc_id].n_tokens, got[r.doc_id].ids_sha256, got[r.doc_id].decoded_sha256) == want


def test_bpe_is_the_librarys(library, spark, sf_dir):
    check_bpe(library, spark, table(spark, sf_dir, "documents"))


def test_bpe_edges(library, spark):
    check_bpe(library, spark, documents(spark, EDGES, extra=True))
    assert bpe.digests(documents(spark, []), BYTES).count() == 0


def test_bpe_decodes_what_it_encodes(spark):
    rows = bpe.encode(documents(spark, EDGES), BYTES).join(documents(spark, EDGES).select("doc_id", "text"), "doc_id").collect()
    assert all(r.decoded == (r.text or "") for r in rows)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from("abehstion éñ\n\t 1½!<|>日😀\x00\x1c'"), max_size=60))
def test_any_text(text):
    vocab = bpe.vocabulary(BYTES)
    ids = np.frombuffer(vocab.encode_all([text])[0], "<u4").tolist()
    assert ids == LIBRARY.encode(text, add_special_tokens=False).ids
    assert vocab.decode(np.array(ids, "<u4").tobytes()).decode() == text
    words = tokenfile.word_ids(WORDS)
    assert np.frombuffer(words.encode([text])[0], words.kind).tolist() == words.lib.encode(text, add_special_tokens=False).ids


def test_exact_merging_agrees_with_proposals():
    vocab = bpe.vocabulary(BYTES)
    for word in (b" the", b"thinesion", b"aaaaaaa", b" anticonstitution", "日本語".encode()):
        into = {}
        vocab.learn([word], into)
        assert np.frombuffer(into[word], "<u4").tolist() == vocab.merged(word)


@pytest.mark.parametrize("values", [[], [0], [255, 256, 65535, 65536, 1 << 24, (1 << 32) - 1], list(range(0, 70000, 7))])
def test_packed_values_come_back(values):
    values = np.array(values, np.uint32)
    control, data = tokenfile.packed(values)
    assert (tokenfile.unpacked(np.frombuffer(control, np.uint8), np.frombuffer(data, np.uint8), len(values)) == values).all()


def check_files(library, spark, docs):
    got = tokenfile.round_trip(docs, WORDS).orderBy("doc_id").collect()
    rows = sorted(docs.collect(), key=lambda r: r.doc_id)
    start = 0
    for g, r in zip(got, rows, strict=True):
        ids = [*library[WORDS].encode(r.text or "", add_special_tokens=False).ids, 1]
        assert (g.doc_id, g.start, g.n_tokens, g.ids_crc32) == (r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_token_files(library, spark, sf_dir):
    check_files(library, spark, table(spark, sf_dir, "documents"))


def test_token_file_edges(library, spark):
    check_files(library, spark, documents(spark, EDGES, extra=True))
    assert tokenfile.round_trip(documents(spark, []), WORDS).count() == 0


def test_frequent_ids_have_small_ranks(spark, tmp_path):
    docs = documents(spark, ["the the the the cat", "the dog"])
    files = tokenfile.write(docs, WORDS, str(tmp_path / "f"), file_tokens=3)
    assert files.agg({"tokens": "sum"}).first()[0] == 9
    ranks = {r.id: r.rank for r in spark.read.parquet(str(tmp_path / "f" / "ranks")).collect()}
    words = tokenfile.word_ids(WORDS)
    assert ranks[words.lib.encode("the", add_special_tokens=False).ids[0]] == 0 and ranks[1] == 1
    back = tokenfile.read(spark, str(tmp_path / "f"), crc=False).orderBy("doc_id").collect()
    assert np.frombuffer(back[1].ids, "<u4").tolist() == [*words.lib.encode("the dog", add_special_tokens=False).ids, 1]
