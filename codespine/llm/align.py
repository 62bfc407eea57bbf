"""Cross-tokenizer alignment by a group dictionary: which tokens of a byte-level vocabulary (A) meet which of a piece vocabulary (B).

The bytes of space + text are cut wherever tokens of both end; the tokens between two cuts are a group, and all its A tokens link to all its B tokens.
Distinct groups are few, so the work goes by groups:

1. Texts are encoded in portions of about ``PORTION_BYTES``. A portion is one row: its distinct groups with the number of its documents that hold
   each, and its documents as places in that list.
2. Groups of all portions are summed by key, each distinct group's links are expanded once, and its number of documents is given to each of its id pairs.
   A document that holds a pair in several distinct groups would count more than once; what is too much is found inside the portion and taken off.
3. What a group is worth (links that are their A id's best, sum of the pairs' counts) goes back to the portions by group key, and there to the documents.

So neither documents nor occurrences are shuffled by group: a portion gives each of its groups once, however often and in how many documents it stands.

Words between single spaces (``counts.words``) are encoded once as long as they are kept: both vocabularies end a token before such a space.

Defined results: each row is a document; null and empty texts, and texts whose joined tokens of A or B are other bytes than space + text (U+2581 in them), have no
tokens: zeros and an empty digest. Repeated rows and null ids give repeated rows; an empty table gives none; other columns don't matter.
A group of very many tokens is expanded by its distinct ids, not by its occurrences.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bpe import _byte_of_char
from .common import gathered, ready, sole, text_bytes, utf8, written
from .counts import Met, by_bytes, sentencepiece_lengths, tokenizers_lengths, words

PORTION_BYTES = 4 << 20
KEPT_WORDS, KEPT_CHARS, KEPT_GROUPS = 300_000, 40, 400_000
LEARNED_AT_ONCE = 20_000
LINKS_AT_ONCE = 200_000
#: What a worker holds at once beside its caches: texts whose new words are told apart, and rows of a portion while pairs are counted.
SLICE_BYTES, ROWS_AT_ONCE = 1 << 20, 500_000


def pair_codes(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (a << 32 | b) of all pairs of two id lists, and how often each stands among them."""
    (ua, na), (ub, nb) = np.unique(a, return_counts=True), np.unique(b, return_counts=True)
    return (ua.astype(np.int64)[:, None] << 32 | ub.astype(np.int64)).ravel(), (na[:, None] * nb).ravel()


def ids_of(key: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The A and B ids of a group's key: the number of A ids, then both, as 32-bit integers."""
    x = np.frombuffer(key, "<u4")
    return x[1 : 1 + x[0]], x[1 + x[0] :]


class Pair:
    """Both vocabularies, the words met so far as lists of group numbers, and the groups by number."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        if not (tokenizers_lengths(path_a)[1] and sentencepiece_lengths(path_b)[1]):
            raise ValueError("both vocabularies have to end a token before a space that follows another character")
        self.a = Tokenizer.from_file(path_a)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        with open(path_a, encoding="utf-8") as f:
            spec, chars = json.load(f), _byte_of_char()
        ids = spec["model"]["vocab"] | {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_a = [b""] * (max(ids.values()) + 1)
        for t, i in ids.items():
            self.bytes_a[i] = bytes(chars[c] for c in t) if all(c in chars for c in t) else t.encode()
        piece = self.b.id_to_piece
        self.bytes_b = [bytes([int(piece(i)[3:5], 16)]) if self.b.is_byte(i) else piece(i).replace("▁", " ").encode() for i in range(self.b.vocab_size())]
        self.size_a, self.size_b = (np.array(list(map(len, x)), np.int64) for x in (self.bytes_a, self.bytes_b))
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, bytes] = {}
        self.shown: dict[str, str] = {}
        self.number: dict[bytes, int] = {}
        self.keys: list[bytes] = []
        self.shapes: list[tuple[int, int]] = []
        self.texts: list[str] = []
        self.met = Met()

    def group(self, key: bytes, n: int) -> int:
        """The number of a group, a new one where the key is new; ``n``: of its A ids."""
        got = self.number.get(key)
        if got is None:
            got = self.number[key] = len(self.keys)
            a, b = ids_of(key)
            self.keys.append(key)
            self.shapes.append((n, len(b)))
            self.texts.append(f"{','.join(map(str, a.tolist()))}|{','.join(map(str, b.tolist()))}")
        return got

    def learn(self, new: list[str]) -> None:
        """Groups of words, each with the space before it. Words that don't come back as the same bytes stay out.

        Words that neither begin nor end in white space are encoded as one text, since both vocabularies end their tokens between them.
        """
        plain = [w for w in new if w and not w[0].isspace() and not w[-1].isspace() and "▁" not in w]
        rest = [w for w in new if not w or w[0].isspace() or w[-1].isspace() or "▁" in w]
        if plain and not self.met_groups(plain, " ".join(plain)):
            rest = new
        for w in rest:
            self.met_groups([w], w)

    def met_groups(self, new: list[str], text: str) -> bool:
        """Keeps the groups of the words that make up a text; False where the text doesn't come back as the same bytes from both."""
        whole = b" " + text.encode()
        (encoded,), pieces = self.a.encode_batch_fast([" " + text], add_special_tokens=False), self.b.encode(text, num_threads=1)
        a, b = np.array(encoded.ids, "<u4"), np.array(pieces, "<u4")
        if not b"".join(map(self.bytes_a.__getitem__, a.tolist())) == whole == b"".join(map(self.bytes_b.__getitem__, pieces)):
            return False
        end_a, end_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        place = np.searchsorted(end_b, end_a)  # the last ends of both are equal
        cut = np.flatnonzero(end_b[place] == end_a)
        to_a, to_b = cut + 1, place[cut] + 1
        from_a, from_b = np.concatenate([[0], to_a[:-1]]), np.concatenate([[0], to_b[:-1]])
        raw_a, raw_b, group = a.tobytes(), b.tobytes(), self.group
        numbers = [group(n.to_bytes(4, "little") + raw_a[4 * s : 4 * e] + raw_b[4 * t : 4 * u], n) for s, e, t, u, n in zip(from_a.tolist(), to_a.tolist(), from_b.tolist(), to_b.tolist(), (to_a - from_a).tolist(), strict=True)]
        last = np.cumsum([len(w.encode()) + 1 for w in new])
        ends = np.searchsorted(end_a[cut], last) + 1  # every word ends a group
        packed, texts, start = np.array(numbers, "<u4").tobytes(), self.texts, 0
        for word, end in zip(new, ends.tolist(), strict=True):
            self.known[word] = packed[4 * start : 4 * end]
            self.shown[word] = ";".join([texts[g] for g in numbers[start:end]])
            start = end
        return True

    def portion(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """Group numbers of all texts, one after the other; how many each text has; each text's digest."""
        if len(self.keys) > KEPT_GROUPS:  # numbers hold for a portion, so groups may go before one only
            self.clear()
        found = [self.sliced(some) for some in by_bytes(texts, SLICE_BYTES)]
        if not found:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64), []
        return np.concatenate([x for x, _, _ in found]), np.concatenate([x for _, x, _ in found]), [d for _, _, x in found for d in x]

    def sliced(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """As above for some texts of a portion; words that aren't worth keeping are given up after them."""
        if len(self.known) > KEPT_WORDS:
            self.known.clear()
            self.shown.clear()
            self.met = Met()
        cut = [words(t) if t else [] for t in texts]
        known, shown = self.known, self.shown
        new = list({w for ws in cut for w in ws if w not in known})
        short, long = [w for w in new if len(w) <= KEPT_CHARS], [w for w in new if len(w) > KEPT_CHARS]
        for group, size in ((short, LEARNED_AT_ONCE), (long, 256)):
            for at in range(0, len(group), size):
                self.learn(group[at : at + size])
        parts, digests = [], []
        for ws in cut:
            found = list(map(known.get, ws))
            good = bool(ws) and None not in found
            parts.append(b"".join(found) if good else b"")
            digests.append(hashlib.sha256(";".join(map(shown.__getitem__, ws)).encode()).hexdigest() if good else "")
        for w in new:
            if len(w) > KEPT_CHARS or not self.met.before(w):
                known.pop(w, None)
                shown.pop(w, None)
        return np.frombuffer(b"".join(parts), "<u4"), np.array([len(p) // 4 for p in parts], np.int64), digests


_LOADED: dict[tuple[str, str], Pair] = {}


def loaded(path_a: str, path_b: str) -> Pair:
    """Loaded once per Python process; the words and groups met so far stay with it."""
    sole(__name__, _LOADED)
    if (path_a, path_b) not in _LOADED:
        _LOADED[path_a, path_b] = Pair(path_a, path_b)
    return _LOADED[path_a, path_b]


def sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of consecutive stretches of the given sizes."""
    total = np.concatenate([[0], np.cumsum(values)])
    end = np.cumsum(sizes)
    return total[end] - total[end - sizes]


def stretches(sizes: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """Documents from, to, and their values from, to: about ``ROWS_AT_ONCE`` values at a time, a longer document by itself."""
    end = np.cumsum(sizes)
    at = 0
    while at < len(sizes):
        base = int(end[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(end, base + ROWS_AT_ONCE, "right")))
        yield at, to, base, int(end[to - 1])
        at = to


def sums_of(by: np.ndarray, places: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of what the places hold in consecutive stretches of the given sizes."""
    return np.concatenate([np.zeros(0, np.int64), *(sums(by[places[a:b]], sizes[i:j]) for i, j, a, b in stretches(sizes))])


def distinct(places: np.ndarray, sizes: np.ndarray, width: int) -> np.ndarray:
    """Each document's distinct places, as document * width + place, in order."""
    return np.concatenate([np.zeros(0, np.int64), *(np.unique(np.repeat(np.arange(i, j), sizes[i:j]) * width + places[a:b]) for i, j, a, b in stretches(sizes))])


def surplus(doc: np.ndarray, group: np.ndarray, keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For distinct (document, group) rows in order: pairs that documents hold in several distinct groups, and how many groups too many count for them."""
    codes = [pair_codes(*ids_of(k))[0] for k in keys]
    size = np.array(list(map(len, codes)), np.int64)
    pairs, place, held = np.unique(np.concatenate(codes), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(keys)), size)
    several = held[place] > 1
    owner, place = owner[several], place[several]
    size = np.bincount(owner, minlength=len(keys))
    start = np.cumsum(size) - size
    over, every = np.zeros(len(pairs), np.int64), np.cumsum(size[group])
    at = 0
    while at < len(doc):  # some whole documents at a time, whose rows come one after the other
        to = int(np.searchsorted(every, (every[at - 1] if at else 0) + ROWS_AT_ONCE, "right"))
        to = int(np.searchsorted(doc, doc[min(to, len(doc) - 1)], "left")) if to < len(doc) else len(doc)
        to = to if to > at else int(np.searchsorted(doc, doc[at], "right"))
        n = size[group[at:to]]
        row = np.repeat(np.arange(at, to), n)
        inner = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        pair = place[start[group[row]] + inner]
        once = np.unique(doc[row] * len(pairs) + pair) % len(pairs)
        over += np.bincount(pair, minlength=len(pairs)) - np.bincount(once, minlength=len(pairs))
        at = to
    return pairs[over > 0], over[over > 0]


def encoded(docs: DataFrame, path_a: str, path_b: str, text: str, key: str) -> DataFrame:
    """One row a portion: its groups (``keys``, ``held``: documents with each), surplus pairs, and its documents."""
    kind = docs.schema[key].dataType.simpleString()
    ready(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, task, k = loaded(path_a, path_b), TaskContext.get().partitionId(), 0
        for batch in gathered(batches, 1, PORTION_BYTES):
            found, sizes, digests = both.portion([utf8(t) for t in batch.column(1).to_pylist()])
            there = np.zeros(len(both.keys), bool)
            there[found] = True
            used = np.flatnonzero(there)
            local = (np.cumsum(there) - 1).astype("<u4")[found]
            keys = [both.keys[g] for g in used.tolist()]
            shape = np.array(both.shapes, np.int64).reshape(-1, 2)[used]
            each = distinct(local, sizes, max(1, len(used)))
            doc, group = each // max(1, len(used)), each % max(1, len(used))
            pairs, over = surplus(doc, group, keys) if keys else (np.zeros(0, np.int64),) * 2
            n = [sums_of(by, local, sizes) for by in (shape[:, 0], shape[:, 1], shape[:, 0] * shape[:, 1])]
            columns = {
                "portion": pa.array([task << 32 | k]), "keys": pa.array([keys], pa.list_(pa.binary())),
                "held": pa.array([np.bincount(group, minlength=len(keys))], pa.list_(pa.int64())),
                "over_pair": pa.array([pairs], pa.list_(pa.int64())), "over": pa.array([over], pa.list_(pa.int64())),
                "ids": pa.array([batch.column(0).to_pylist()], pa.list_(batch.column(0).type)),
                "n_a": pa.array([n[0]], pa.list_(pa.int64())), "n_b": pa.array([n[1]], pa.list_(pa.int64())),
                "n_groups": pa.array([sizes], pa.list_(pa.int64())), "n_links": pa.array([n[2]], pa.list_(pa.int64())),
                "digests": pa.array([digests], pa.list_(pa.string())), "places": pa.array([local.tobytes()], pa.binary()),
            }
            k += 1
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    longs = ", ".join(f"{c} array<bigint>" for c in ("n_a", "n_b", "n_groups", "n_links"))
    rows = docs.select(docs[key].alias("key"), text_bytes(text).alias("data"))
    schema = f"portion bigint, keys array<binary>, held array<bigint>, over_pair array<bigint>, over array<bigint>, ids array<{kind}>, {longs}, digests array<string>, places binary"
    return rows.mapInArrow(run, schema)


def name_of(key: str) -> Column:
    """What stands for a group's key beside each of its links: long keys by their digest, as a group of n tokens has up to n * n links."""
    return F.when(F.octet_length(key) < 32, F.col(key)).otherwise(F.unhex(F.sha2(key, 256))).alias("name")


def expanded(groups: DataFrame) -> DataFrame:
    """Links of each distinct group, once: ``name`` (of the group), ``a``, ``b``, ``times`` (occurrence pairs in the group), ``held``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, codes, times, total = [], [], [], 0
            held = batch.column(2).to_numpy(zero_copy_only=False)
            for k, key in enumerate(batch.column(0).to_pylist()):
                code, n = pair_codes(*ids_of(key))
                for at in range(0, len(code), LINKS_AT_ONCE):
                    codes.append(code[at : at + LINKS_AT_ONCE])
                    times.append(n[at : at + LINKS_AT_ONCE])
                    rows.append(np.full(len(codes[-1]), k))
                    total += len(codes[-1])
                    if total >= LINKS_AT_ONCE:
                        yield links(batch, held, rows, codes, times)
                        rows, codes, times, total = [], [], [], 0
            if rows:
                yield links(batch, held, rows, codes, times)

    def links(batch: pa.RecordBatch, held: np.ndarray, rows: list, codes: list, times: list) -> pa.RecordBatch:
        row, code, n = map(np.concatenate, (rows, codes, times))
        return pa.RecordBatch.from_arrays([batch.column(1).take(pa.array(row)), pa.array(code >> 32), pa.array(code & 0xFFFFFFFF), pa.array(n), pa.array(held[row])], names=["name", "a", "b", "times", "held"])

    return groups.select("key", name_of("key"), "held").mapInArrow(run, "name binary, a bigint, b bigint, times bigint, held bigint")


def alignment(docs: DataFrame, path_a: str, path_b: str, *, text: str = "text", key: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """Documents (``key``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum``, ``groups_sha256``) and id pairs (``a``, ``b``, ``n``: documents with the pair linked).

    ``n_best`` are links whose pair no other pair of the same A id has more documents than; ``count_sum`` is the sum of the links' ``n``.
    """
    kind = docs.schema[key].dataType.simpleString()
    parts = written(encoded(docs, path_a, path_b, text, key))
    listed = parts.select("portion", F.posexplode(F.arrays_zip("keys", "held")).alias("place", "g")).select("portion", "place", F.col("g.keys").alias("key"), F.col("g.held").alias("held"))
    links = written(expanded(listed.groupBy("key").agg(F.sum("held").alias("held"))))
    over = parts.select(F.explode(F.arrays_zip("over_pair", "over")).alias("o")).select(F.shiftright("o.over_pair", 32).alias("a"), F.col("o.over_pair").bitwiseAND(0xFFFFFFFF).alias("b"), (-F.col("o.over")).alias("n"))
    pairs = written(links.select("a", "b", F.col("held").alias("n")).unionByName(over).groupBy("a", "b").agg(F.sum("n").alias("n")))
    best = F.broadcast(pairs.groupBy("a").agg(F.max("n").alias("most")))  # a row for each id of the vocabulary at most
    worth = links.join(pairs, ["a", "b"]).join(best, "a").groupBy("name").agg(F.sum(F.when(F.col("n") == F.col("most"), F.col("times")).otherwise(0)).alias("best"), F.sum(F.col("times") * F.col("n")).alias("total"))
    back = listed.select("portion", "place", name_of("key")).join(worth, "name").select(F.col("portion").alias("part"), "place", "best", "total")

    def finish(part: pa.Table, scores: pa.Table) -> pa.Table:
        names = ["key", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
        if not part.num_rows:
            return pa.table({n: pa.array([], t) for n, t in zip(names, [part.schema.field("ids").type.value_type, *[pa.int64()] * 6, pa.string()], strict=True)})
        one = {c: part.column(c).combine_chunks() for c in part.column_names}
        flat = {c: one[c].flatten() for c in ("ids", "n_a", "n_b", "n_groups", "n_links", "digests")}
        places, sizes = np.frombuffer(one["places"][0].as_py(), "<u4"), flat["n_groups"].to_numpy()
        value = np.zeros((2, one["n_keys"][0].as_py()), np.int64)
        value[:, scores.column("place").to_numpy()] = scores.column("best").to_numpy(), scores.column("total").to_numpy()
        counted = [pa.array(sums_of(v, places, sizes)) for v in value]
        return pa.Table.from_arrays([flat["ids"], flat["n_a"], flat["n_b"], flat["n_groups"], flat["n_links"], *counted, flat["digests"]], names=names)

    left = parts.select("portion", F.size("keys").alias("n_keys"), "ids", "n_a", "n_b", "n_groups", "n_links", "digests", "places")
    schema = f"key {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"
    out = left.groupBy("portion").cogroup(back.groupBy("part")).applyInArrow(finish, schema)
    return out.withColumnRenamed("key", key), pairs
