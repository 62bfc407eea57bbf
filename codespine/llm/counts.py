"""Token counts of whole texts, from the tokenizers' own libraries: batches of about the same bytes go through an Arrow function, lengths come back.

A text is split where no token can cross: at a single space between two characters that aren't white space. The space leads the
piece after it, so pieces are mostly words and come back often; the lengths of pieces met twice are kept, and a long text is never handed over whole
unless it has no such place. Pieces whose length isn't known go to the library in calls of about ``CALL_BYTES``.
A vocabulary whose pre-tokenizer, normaliser or pieces don't allow that split gets whole texts, balanced by bytes all the same.

Defined results: null and empty texts have no bytes and no tokens; strings of special tokens inside a text count as the library takes them by default;
repeated rows and null ids give repeated rows; an empty table gives no rows; other columns don't matter.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import portions, ready, sole, text_bytes, utf8

BATCH_BYTES = 4 << 20
CALL_BYTES = 1 << 18
KEPT_WORDS, KEPT_CHARS = 500_000, 40
BORDER = re.compile(r"(?<=\S) (?=\S)")
ODD = re.compile(r" \s|\s |^\s| $")


def words(text: str) -> list[str]:
    """The text split at single spaces between characters that aren't white space; those spaces are left out."""
    return BORDER.split(text) if ODD.search(text) else text.split(" ")


def by_bytes(texts: Iterable[str], size: int = CALL_BYTES) -> Iterator[list[str]]:
    """Lists of texts of about ``size`` characters; a longer text is a list of its own."""
    held, total = [], 0
    for t in texts:
        if held and total + len(t) > size:
            yield held
            held, total = [], 0
        held.append(t)
        total += len(t)
    if held:
        yield held


class Met:
    """Whether a word was met before, by one bit a hash: words that come once aren't worth keeping. Equal hashes only keep a word too early."""

    def __init__(self, bits: int = 23):
        self.table, self.mask = bytearray(1 << (bits - 3)), (1 << bits) - 1

    def before(self, word: str) -> bool:
        at = hash(word) & self.mask
        was = self.table[at >> 3] >> (at & 7) & 1
        self.table[at >> 3] |= 1 << (at & 7)
        return bool(was)


class Lengths:
    """Numbers of tokens by one vocabulary file: ``.json`` by the tokenizers library, ``.model`` by sentencepiece."""

    def __init__(self, path: str):
        self.encoded, self.splits, self.lead = sentencepiece_lengths(path) if path.endswith(".model") else tokenizers_lengths(path)
        self.known: dict[str, int] = {}
        self.met = Met()

    def ask(self, texts: Iterable[str]) -> list[int]:
        return [n for call in by_bytes(texts) for n in self.encoded(call)]

    def of(self, texts: list[str]) -> list[int]:
        if not self.splits:
            return self.ask(texts)
        if len(self.known) > KEPT_WORDS:
            self.known.clear()
            self.met = Met()
        cut = [words(t) if t else [] for t in texts]
        first = self.ask([w[0] for w in cut if w]) if self.lead else None  # a text's first word has no space before it
        rest = [w[1:] for w in cut] if self.lead else cut
        known = self.known
        new = list({w for ws in rest for w in ws if w not in known})
        known.update(zip(new, self.ask([self.lead + w for w in new]), strict=True))
        counts = [sum(map(known.__getitem__, ws)) for ws in rest]
        for w in new:
            if len(w) > KEPT_CHARS or not self.met.before(w):
                del known[w]
        if first is not None:
            heads = iter(first)
            counts = [n + (next(heads) if w else 0) for n, w in zip(counts, cut, strict=True)]
        return counts


def tokenizers_lengths(path: str) -> tuple[Callable[[list[str]], list[int]], bool, str]:
    """The encoder, whether texts may be split, and what leads a word. Byte-level patterns end a token before a space that follows other characters."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a worker for each core
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    before = spec.get("pre_tokenizer") or {}
    plain = spec.get("normalizer") is None and spec["model"]["type"] == "BPE" and not spec["model"].get("dropout")
    whole = all(" " not in t["content"] and not (t["lstrip"] or t["rstrip"] or t["single_word"]) for t in spec["added_tokens"])
    splits = plain and whole and before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space", True)
    return (lambda texts: [len(e) for e in tok.encode_batch_fast(texts, add_special_tokens=False)]), splits, " "


def sentencepiece_lengths(path: str) -> tuple[Callable[[list[str]], list[int]], bool, str]:
    """As above. sentencepiece puts the space before a text itself; words may be split where no piece holds a space after another character
    and the normaliser leaves texts as they are."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    probe = "a  ﬁ Å  b"
    same = model.normalize(probe) == "▁" + probe.replace(" ", "▁")
    crossing = any("▁" in model.id_to_piece(i).lstrip("▁") for i in range(model.vocab_size()))
    return (lambda texts: list(map(len, model.encode(texts, num_threads=1)))), same and not crossing, ""


_LOADED: dict[str, Lengths] = {}


def lengths(path: str) -> Lengths:
    """Loaded once per Python process; the lengths met so far stay with it."""
    sole(__name__, _LOADED)
    if path not in _LOADED:
        _LOADED[path] = Lengths(path)
    return _LOADED[path]


def token_counts(docs: DataFrame, path: str, *, limit: int = 1024, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key``, ``n_bytes`` (UTF-8), ``n_tokens``, ``over_limit`` (more tokens than ``limit``) of whole texts.

    A narrow map without a shuffle: a worker holds one batch, and lengths of at most ``KEPT_WORDS`` words and those of a batch.
    """
    ready(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ask = lengths(path)
        for batch in portions(batches, 1, BATCH_BYTES):
            n = ask.of([utf8(t) for t in batch.column(1).to_pylist()])
            size = pc.binary_length(batch.column(1)).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), size, pa.array(np.array(n, np.int64))], names=["key", "n_bytes", "n_tokens"])

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(docs[key].alias("key"), text_bytes(text).alias("data"))
    out = rows.mapInArrow(run, f"key {kind}, n_bytes bigint, n_tokens bigint")
    return out.select(F.col("key").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
