"""Byte-level BPE by speculation: propose greedily, test all adjacent pairs at once, merge exactly only where a test fails.

A text is cut into words by the vocabulary's pattern. For each word not met before, greedy longest match proposes
tokens. A proposal is the BPE encoding exactly if every token is the encoding of its own bytes and every adjacent pair
(a, b) is compatible: no merge across the border between a and b comes before the merges that use up its two sides.
All pairs of all new words are tested together in numpy; words with a failing pair are merged in order of rank.

Defined results: null text is empty, an empty text has no ids and decodes to the empty text; long texts are cut into
words like any other, words over ``CACHED_BYTES`` are encoded each time and not kept; repeated rows give repeated rows.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import ready, slices, sole, text_bytes, utf8

CACHED_WORDS = 400_000
CACHED_BYTES = 64
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
NEVER = np.iinfo(np.int64).max


def _byte_of_char() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary file."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class ByteBpe:
    """A vocabulary file of the tokenizers library, with the tables for proposing, testing and merging."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, chars = spec["model"], _byte_of_char()
        raw = {t: bytes(chars[c] for c in t) for t in model["vocab"] if all(c in chars for c in t)}
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.split_special = regex.compile("|".join(f"({regex.escape(s)})" for s in sorted(self.special, key=len, reverse=True))) if self.special else None
        size = max([*model["vocab"].values(), *self.special.values()]) + 1
        self.token = [b""] * size
        for t, i in model["vocab"].items():
            self.token[i] = raw.get(t, t.encode())
        for s, i in self.special.items():
            self.token[i] = s.encode()
        self.id_of = {self.token[model["vocab"][t]]: model["vocab"][t] for t in raw if t not in self.special}
        self.longest = max(map(len, self.id_of))
        self.byte_id = [self.id_of[bytes([b])] for b in range(256)]
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        self.rank = np.full(size, -1, np.int64)
        self.left, self.right = np.arange(size), np.arange(size)
        for k, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            a, b, both = model["vocab"][a], model["vocab"][b], model["vocab"][a + b]
            self.merge.setdefault((a, b), (k, both))
            if self.rank[both] < 0:
                self.rank[both], self.left[both], self.right[both] = k, a, b
        codes = np.array([a << 32 | b for a, b in self.merge], np.int64)
        order = np.argsort(codes)
        self.pair_code, self.pair_rank = codes[order], np.array([r for r, _ in self.merge.values()], np.int64)[order]
        self.sound = np.ones(size, bool)
        made = np.flatnonzero(self.rank >= 0)
        self.sound[made] = self.compatible(self.left[made], self.right[made], self.rank[made])
        for t in made[np.argsort(self.rank[made])]:  # a token whose halves are not their own encodings isn't either
            self.sound[t] &= self.sound[self.left[t]] and self.sound[self.right[t]]
        self.words: dict[bytes, bytes] = {}
        self.pattern = regex.compile(WORD_PATTERN)

    def pair_ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        code = a << 32 | b
        at = np.minimum(np.searchsorted(self.pair_code, code), len(self.pair_code) - 1)
        return np.where(self.pair_code[at] == code, self.pair_rank[at], NEVER)

    def compatible(self, a: np.ndarray, b: np.ndarray, allowed: np.ndarray | None = None) -> np.ndarray:
        """Whether the border of each pair stays; ``allowed``: ranks of merges across it that count as staying.

        Merges at both sides are undone from the last one back. While x and y face each other, a merge of them
        with a rank below the next merge at the border would have come first. At equal ranks the leftmost goes first.
        """
        x, y = a.astype(np.int64), b.astype(np.int64)
        bound, good, open_ = np.full(len(x), NEVER), np.ones(len(x), bool), np.arange(len(x))
        first = True
        while len(open_):
            r = self.pair_ranks(x, y)
            bad = r < bound[open_]
            if first and allowed is not None:
                bad &= r != allowed
            first = False
            good[open_[bad]] = False
            rx, ry = self.rank[x], self.rank[y]
            on = ~bad & ((rx >= 0) | (ry >= 0))
            undo_x = rx > ry
            bound[open_] = np.where(undo_x, rx, ry + 1)
            x, y = np.where(undo_x, self.right[x], x)[on], np.where(undo_x, y, self.left[y])[on]
            open_ = open_[on]
        return good

    def propose(self, word: bytes) -> list[int]:
        ids, at, n = [], 0, len(word)
        while at < n:
            for end in range(min(n, at + self.longest), at, -1):
                if (t := self.id_of.get(word[at:end])) is not None:
                    ids.append(t)
                    at = end
                    break
        return ids

    def merged(self, word: bytes) -> list[int]:
        """Exact merging by rank, leftmost first, in O(n log n)."""
        ids = [self.byte_id[b] for b in word]
        after, before = [*range(1, len(ids)), -1], [-1, *range(len(ids) - 1)]
        heap = [(m[0], i, ids[i], ids[i + 1]) for i in range(len(ids) - 1) if (m := self.merge.get((ids[i], ids[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i] if ids[i] == a else -1
            if j < 0 or ids[j] != b:
                continue
            ids[i], ids[j], after[i] = self.merge[a, b][1], -1, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for p, q in ((before[i], i), (i, after[i])):
                if p >= 0 and q >= 0 and (m := self.merge.get((ids[p], ids[q]))):
                    heapq.heappush(heap, (m[0], p, ids[p], ids[q]))
        return [t for t in ids if t >= 0]

    def learn(self, words: Iterable[bytes], into: dict[bytes, bytes]) -> int:
        """Encodes words together; returns how many needed exact merging."""
        words = list(words)
        plans = [self.propose(w) for w in words]
        n = np.fromiter(map(len, plans), np.int64, len(plans))
        ids = np.fromiter((t for p in plans for t in p), np.int64, int(n.sum()))
        owner = np.repeat(np.arange(len(plans)), n)
        failed = np.zeros(len(plans), bool)
        failed[owner[~self.sound[ids]]] = True
        inner = np.flatnonzero(owner[:-1] == owner[1:])
        codes, back = np.unique(ids[inner] << 32 | ids[inner + 1], return_inverse=True)
        good = self.compatible(codes >> 32, codes & 0xFFFFFFFF)
        failed[owner[inner[~good[back]]]] = True
        for k, word in enumerate(words):
            into[word] = np.array(self.merged(word) if failed[k] else plans[k], "<u4").tobytes()
        return int(failed.sum())

    def pieces(self, text: str) -> list[bytes | int]:
        """Words as bytes, special tokens as ids."""
        if not self.split_special or not any(s in text for s in self.special):
            return [w.encode() for w in self.pattern.findall(text)]
        return [x for part in self.split_special.split(text) if part for x in ([self.special[part]] if part in self.special else [w.encode() for w in self.pattern.findall(part)])]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        if len(self.words) > CACHED_WORDS:
            self.words.clear()
        cut = [self.pieces(t) for t in texts]
        known = self.words
        new = {w for pieces in cut for w in pieces if w not in known and not isinstance(w, int)}
        long = {w for w in new if len(w) > CACHED_BYTES}
        self.learn(new - long, known)
        rare: dict[bytes | int, bytes] = {i: np.array([i], "<u4").tobytes() for i in self.special.values()}
        self.learn(long, rare)
        if not long and not self.special.keys():
            return [b"".join(map(known.__getitem__, p)) for p in cut]
        get = known.get
        return [b"".join([get(w) or rare[w] for w in p]) for p in cut]

    def decode(self, ids: bytes) -> bytes:
        """UTF-8 bytes of the ids; broken sequences become the replacement character."""
        data = b"".join(map(self.token.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        try:
            data.decode()
            return data
        except UnicodeDecodeError:
            return data.decode("utf-8", "replace").encode()


_LOADED: dict[str, ByteBpe] = {}


def vocabulary(path: str) -> ByteBpe:
    """Loaded once per Python process; the words met so far stay with it."""
    sole(__name__, _LOADED)
    if path not in _LOADED:
        _LOADED[path] = ByteBpe(path)
    return _LOADED[path]


def encode(docs: DataFrame, path: str, *, text: str = "text", key: str = "doc_id", decoded: bool = True) -> DataFrame:
    """Encodes whole texts: key, ``n_tokens`` long, ``ids`` binary (little-endian unsigned 32-bit), ``decoded`` string.

    A narrow map: no shuffle; memory is bounded by one Arrow batch and the word cache.
    """
    ready(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for batch in slices(batches):
            ids = bpe.encode_all([utf8(t) for t in batch.column(1).to_pylist()])
            out = [batch.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())]
            names = ["key", "n_tokens", "ids"]
            if decoded:
                out.append(pa.array([bpe.decode(x) for x in ids], pa.binary()).cast(pa.string()))
                names.append("decoded")
            yield pa.RecordBatch.from_arrays(out, names=names)

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(docs[key].alias("key"), text_bytes(text).alias("data"))
    out = rows.mapInArrow(run, f"key {kind}, n_tokens bigint, ids binary" + ", decoded string" * decoded)
    return out.withColumnRenamed("key", key)


def digests(docs: DataFrame, path: str, *, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Digest columns of ids and of what they decode to, hashed in the worker so that the ids never leave it."""
    ready(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for batch in slices(batches):
            ids = bpe.encode_all([utf8(t) for t in batch.column(1).to_pylist()])
            hexed = [hashlib.sha256(x).hexdigest() for x in ids]
            back = [hashlib.sha256(bpe.decode(x)).hexdigest() for x in ids]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(hexed), pa.array(back)], names=["key", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(docs[key].alias("key"), text_bytes(text).alias("data"))
    return rows.mapInArrow(run, f"key {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string").withColumnRenamed("key", key)
