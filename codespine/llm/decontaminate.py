"""Benchmark decontamination by a generalised suffix automaton over the words of the test items.

The automaton of all normalised items is small and goes to every worker. Documents stream through it word by word; the
longest match that ends at each word tells which item windows occur there. A window is ``window`` consecutive words of an
item, or the whole item where it has fewer. Before the automaton runs, numpy finds the stretches of a document whose
neighbouring words also neighbour in some item: a window can only lie within such a stretch.

Items above ``BLOCK_BYTES`` of text in all are taken in blocks, each with an automaton of its own, and the documents' hits
are united; so what is sent to the workers at once keeps its bound however large the benchmark. The automaton is built in dictionaries (some 90 bytes
for each byte of items, on the driver, one block at a time) and sent as flat arrays, about a tenth of that.

Where a passage is cut out, what was before and after it become neighbours and may make a window that wasn't there. So cutting is repeated
until nothing is left to cut.

Defined results: null or word-less texts and items have no words, no windows and no hits; a repeated item is found
under each of its ids; repeated document rows each get their row; an empty benchmark leaves every document clean.
"""

from __future__ import annotations

import re
from array import array
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StructField, StructType

from .common import free_name, portions, ready, slices, text_bytes, written

BLOCK_BYTES = 4 << 20
#: A-Z to lower case; what is neither an ASCII letter or digit nor part of a longer UTF-8 sequence to a space.
FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))
WORD = re.compile(rb"[^\x20]+")


def words(data: bytes) -> list[bytes]:
    return data.translate(FOLD).split()


class Automaton:
    """Suffix automaton of several word sequences, with the items of each window."""

    def __init__(self, items: Iterable[tuple[int, bytes]], window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.step: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        texts = []
        for item, data in items:
            if seq := [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words(data)]:
                texts.append((item, seq))
                state = 0
                for w in seq:
                    state = self.extend(state, w)
        self.shortest = min([window, *(len(s) for _, s in texts)])
        base = len(self.vocabulary) + 1
        self.pairs = np.unique(np.array([a * base + b for _, s in texts for a, b in zip(s, s[1:], strict=False)], np.int64))
        self.known = np.zeros(base, bool)
        self.known[1:] = True
        ends, wholes = [], []
        for item, seq in texts:
            state = 0
            for n, w in enumerate(seq, 1):
                state = self.step[state][w]
                if n >= window:
                    ends.append((self.covering(state, window), item))
            if len(seq) < window:
                wholes.append((self.covering(state, len(seq)), len(seq), item))
        self.freeze(ends, wholes)

    def freeze(self, ends: list[tuple[int, int]], wholes: list[tuple[int, int, int]]) -> None:
        """Flat arrays instead of the dictionaries: steps by (state, word); by state the items of the window that ends there,
        and the shorter whole items that end there."""
        base = len(self.vocabulary) + 1
        code = np.fromiter((s * base + w for s, step in enumerate(self.step) for w in step), np.int64)
        target = np.fromiter(chain.from_iterable(step.values() for step in self.step), np.int32, len(code))
        order = np.argsort(code)
        self.base, self.code, self.target = base, array("q", code[order].tobytes()), array("i", target[order].tobytes())
        self.link, self.length = array("i", self.link), array("i", self.length)
        del self.step
        ends.sort()
        self.window_state, self.window_item = array("q", [s for s, _ in ends]), array("q", [i for _, i in ends])
        self.whole: dict[int, list[tuple[int, int]]] = {}
        for state, size, item in wholes:
            self.whole.setdefault(state, []).append((size, item))

    def after(self, state: int, w: int) -> int:
        """The state that a word leads to, or -1."""
        want = state * self.base + w
        at = bisect_left(self.code, want)
        return self.target[at] if at < len(self.code) and self.code[at] == want else -1

    def items_at(self, state: int) -> Iterator[int]:
        at = bisect_left(self.window_state, state)
        while at < len(self.window_state) and self.window_state[at] == state:
            yield self.window_item[at]
            at += 1

    def extend(self, last: int, w: int) -> int:
        """Appends a word to the sequence that ends in ``last``; sequences that are known already share their states."""
        if w in self.step[last]:
            to = self.step[last][w]
            return to if self.length[to] == self.length[last] + 1 else self.parted(last, w, to)
        new = self.state(self.length[last] + 1, {})
        at = last
        while at >= 0 and w not in self.step[at]:
            self.step[at][w] = new
            at = self.link[at]
        if at < 0:
            self.link[new] = 0
        else:
            to = self.step[at][w]
            self.link[new] = to if self.length[to] == self.length[at] + 1 else self.parted(at, w, to)
        return new

    def state(self, length: int, step: dict[int, int]) -> int:
        self.step.append(step)
        self.link.append(0)
        self.length.append(length)
        return len(self.step) - 1

    def parted(self, at: int, w: int, to: int) -> int:
        """Splits off the shorter suffixes of ``to`` that follow ``at``."""
        new = self.state(self.length[at] + 1, dict(self.step[to]))
        self.link[new], self.link[to] = self.link[to], new
        while at >= 0 and self.step[at].get(w) == to:
            self.step[at][w] = new
            at = self.link[at]
        return new

    def covering(self, state: int, length: int) -> int:
        """The state of the last ``length`` words of what ``state`` stands for."""
        while self.length[self.link[state]] >= length:
            state = self.link[state]
        return state

    def stretches(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last word (exclusive) of the stretches that can hold a window."""
        if self.shortest < 2:
            flag = np.concatenate([[False], ids > 0, [False]])
            more = 0
        else:
            both = np.zeros(max(len(ids) - 1, 0), bool)
            some = np.flatnonzero((ids[:-1] > 0) & (ids[1:] > 0))
            code = ids[some] * np.int64(len(self.vocabulary) + 1) + ids[some + 1]
            if len(self.pairs):
                both[some] = self.pairs[np.minimum(np.searchsorted(self.pairs, code), len(self.pairs) - 1)] == code
            flag, more = np.concatenate([[False], both, [False]]), 1
        edge = np.flatnonzero(flag[1:] != flag[:-1])
        start, end = edge[0::2], edge[1::2] + more
        keep = end - start >= self.shortest
        return start[keep], end[keep]

    def search(self, ids: list[int]) -> tuple[list[tuple[int, int]], set[int]]:
        """Hit spans and items of one stretch."""
        spans, items, state, n = [], set(), 0, 0
        for at, w in enumerate(ids, 1):
            to = self.after(state, w)
            while state and to < 0:
                state = self.link[state]
                n = self.length[state]
                to = self.after(state, w)
            if to >= 0:
                state, n = to, n + 1
            if n >= self.window:
                items.update(self.items_at(self.covering(state, self.window)))
                spans.append((at - n, at))
            up = state
            while up > 0 and self.whole:
                for size, item in self.whole.get(up, ()):
                    if size <= n:
                        items.add(item)
                        spans.append((at - size, at))
                up = self.link[up]
        return spans, items


def united(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


SPAN = pa.list_(pa.struct([("first", pa.int32()), ("after", pa.int32())]))
FOUND = "key bigint, n_words bigint, spans array<struct<first: int, after: int>>, items array<bigint>"


def find(auto: Automaton, texts: list[bytes]) -> list[tuple[int, list[tuple[int, int]], list[int]]]:
    """Number of words, hit spans and items of each text."""
    n_words, ids, get = [], [], auto.vocabulary.get
    for data in texts:
        found = words(data)
        n_words.append(len(found))
        ids += [get(w, 0) for w in found]
        ids.append(0)  # no stretch goes from one text into the next
    first = np.concatenate([[0], np.cumsum(np.array(n_words, np.int64) + 1)])
    hits: dict[int, tuple[list, set]] = {}
    for a, b in zip(*(x.tolist() for x in auto.stretches(np.array(ids, np.int64))), strict=True):
        some, which = auto.search(ids[a:b])
        if some:
            k = int(np.searchsorted(first, a, "right")) - 1
            old = hits.setdefault(k, ([], set()))
            old[0].extend((a - int(first[k]) + x, a - int(first[k]) + y) for x, y in some)
            old[1].update(which)
    return [(n, united(hits[k][0]), sorted(hits[k][1])) if k in hits else (n, [], []) for k, n in enumerate(n_words)]


def _shared(docs: DataFrame, items: list[Row], window: int) -> Broadcast:
    return docs.sparkSession.sparkContext.broadcast(Automaton(((r[0], bytes(r[1])) for r in items), window))


def _scan(docs: DataFrame, automaton: Broadcast) -> DataFrame:
    """``key``, ``n_words``, ``spans``, ``items`` against one block's automaton; ``docs``: key, data."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, 1):
            found = find(automaton.value, batch.column(1).to_pylist())
            spans = [[{"first": a, "after": b} for a, b in s] for _, s, _ in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([n for n, _, _ in found], pa.int64()), pa.array(spans, SPAN), pa.array([i for _, _, i in found], pa.list_(pa.int64()))], names=["key", "n_words", "spans", "items"])

    return docs.mapInArrow(run, FOUND)


def _blocks(benchmark: DataFrame, item: str, text: str, block_bytes: int) -> list[DataFrame]:
    """The items in parts of bounded size (by a hash of the item; one part where all fit)."""
    tests = benchmark.select(F.col(item).cast("long").alias("item"), text_bytes(text).alias("data")).where("item is not null")
    size = tests.agg(F.coalesce(F.sum(F.octet_length("data")), F.lit(0))).first()[0]
    count = max(1, -(-size // block_bytes))
    place = F.pmod(F.xxhash64("item", "data"), F.lit(count))
    return [tests] if count == 1 else [tests.where(place == k) for k in range(count)]


def occurrences(docs: DataFrame, benchmark: DataFrame, *, window: int = 10, text: str = "text", key: str = "doc_id", item: str = "item_id", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``key``, ``n_words`` long, ``spans`` (hit words, united, ascending), ``items`` (ascending ids) of every document."""
    if window < 1:
        raise ValueError("a window has one word at least")
    ready(docs.sparkSession)
    parts = _blocks(benchmark, item, text, block_bytes)
    rows = docs.select(F.col(key).cast("long").alias("key"), text_bytes(text).alias("data"))
    if len(parts) == 1:
        return _scan(rows, _shared(docs, parts[0].collect(), window)).withColumnRenamed("key", key)
    numbered = written(rows.withColumn("row", F.monotonically_increasing_id()))
    found = None
    for part in parts:  # one block's automaton at a time
        automaton = _shared(docs, part.collect(), window)
        more = written(_scan(numbered.select(F.col("row").alias("key"), "data"), automaton))
        automaton.unpersist()
        found = more if found is None else found.union(more)
    joined = found.groupBy("key").agg(F.max("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    merged = joined.mapInArrow(_unite, FOUND).withColumnRenamed("key", "row")
    return numbered.select("row", "key").join(merged, "row").select(F.col("key").alias(key), "n_words", "spans", "items")


def _unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        spans = [[{"first": a, "after": b} for a, b in united((s["first"], s["after"]) for s in x)] for x in batch.column(2).to_pylist()]
        yield batch.set_column(2, "spans", pa.array(spans, SPAN))


def hit_words(spans: str = "spans"):
    """Number of words inside hit spans."""
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["after"] - s["first"])


def cleaned(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the words of the spans and what lies between them."""
    at = [m.span() for m in WORD.finditer(data.translate(FOLD))]
    out, last = [], 0
    for first, after in spans:
        out.append(data[last : at[first][0]])
        last = at[after - 1][1]
    return b"".join([*out, data[last:]])


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, window: int = 10, longest: int = 10, coverage: float = 0.5, text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The same columns without contamination.

    Spans of ``longest`` or more words are removed, shorter ones (whole short items) where all spans together cover
    more than ``coverage`` of the document's words; a document left without a word goes. Clean rows stay as they are.
    Cutting is repeated until no span is left that these rules remove.

    With one block of items that is a single narrow map. With several, each adds its spans to those found before on the text as it was, what all
    together decide is cut once, and the rows that were cut are gone through again, as long as there are any; so the size of the blocks changes no result.
    No rows are shuffled.
    """
    ready(docs.sparkSession)
    place, schema = docs.schema.fieldNames().index(text), docs.schema
    held, again = free_name(docs, "spans"), free_name(docs, "again")
    span = ArrayType(StructType([StructField("first", IntegerType()), StructField("after", IntegerType())]))

    def removed(n: int, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
        return spans if sum(b - a for a, b in spans) > coverage * n else [(a, b) for a, b in spans if b - a >= longest]

    def put(batch: pa.RecordBatch, texts: list[str | None], keep: list[bool]) -> pa.RecordBatch:
        return batch.set_column(place, batch.schema.field(place), pa.array(texts, batch.schema.field(place).type)).filter(pa.array(keep, pa.bool_()))

    parts = _blocks(benchmark, "item_id", "text", block_bytes)
    if len(parts) == 1:
        automaton = _shared(docs, parts[0].collect(), window)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in portions(batches, place):
                texts = batch.column(place).to_pylist()
                raw = {k: (t or "").encode() for k, t in enumerate(texts)}
                cut: set[int] = set()
                while raw:
                    found = zip(raw.items(), find(automaton.value, list(raw.values())), strict=True)
                    raw = {k: cleaned(data, spans) for (k, data), (n, every, _) in found if (spans := removed(n, every))}
                    cut.update(raw)
                    for k, data in raw.items():
                        texts[k] = data.decode("utf-8", "replace")
                yield put(batch, texts, [k not in cut or bool(words((t or "").encode())) for k, t in enumerate(texts)])

        return docs.mapInArrow(run, schema)

    wide = StructType([*schema.fields, StructField(again, BooleanType()), StructField(held, span)])

    def look(df: DataFrame, automaton: Broadcast) -> DataFrame:
        """Adds a block's spans to those of the rows that are to be gone through."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in portions(batches, place):
                due, old = batch.column(len(schema)).to_pylist(), batch.column(len(schema) + 1).to_pylist()
                rows = [k for k, d in enumerate(due) if d]
                raw = batch.column(place).take(pa.array(rows, pa.int64())).to_pylist()
                spans = [[(s["first"], s["after"]) for s in x] for x in old]
                for k, (_, more, _) in zip(rows, find(automaton.value, [(t or "").encode() for t in raw]), strict=True):
                    spans[k] = united([*spans[k], *more])
                yield batch.set_column(len(schema) + 1, held, pa.array([[{"first": a, "after": b} for a, b in x] for x in spans], SPAN))

        return df.mapInArrow(run, wide)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, place):
            texts, spans = batch.column(place).to_pylist(), batch.column(len(schema) + 1).to_pylist()
            due, keep = [False] * len(texts), [True] * len(texts)
            for k, some in enumerate(spans):
                data = (texts[k] or "").encode()
                if some and (out := removed(len(words(data)), [(s["first"], s["after"]) for s in some])):
                    left = cleaned(data, out)
                    texts[k], due[k], keep[k] = left.decode("utf-8", "replace"), True, bool(words(left))
            done = batch.set_column(len(schema), again, pa.array(due)).set_column(len(schema) + 1, held, pa.array([[]] * len(texts), SPAN))
            yield put(done, texts, keep)

    rows = docs.select("*", F.lit(True).alias(again), F.array().cast(span).alias(held))
    while True:
        for part in parts:  # one block's automaton at a time, on the driver and in the workers
            automaton = _shared(docs, part.collect(), window)
            rows = written(look(rows, automaton))
            automaton.unpersist()
        rows = written(rows.mapInArrow(cut, wide))
        if rows.where(again).isEmpty():
            return rows.select(*docs.columns)
