"""Toxicity by a factorisation machine over hashed terms.

A document is the set of its terms, hashed: words, and the first few bytes of words. Its score is the logistic function of a bias, a weight of each term, and
for each pair of terms the product of their factor vectors, which sees that two words together mean more (or less) than
each alone. Every term of the fitting sample takes part, with a weight and factors of its own; none is screened out, as a term
may tell nothing alone and much in a pair. A term's value is between ``LEAST_VALUE`` and 1: it grows with how many documents have
the term or with how far its share of toxic documents is from chance (Chernoff's bound, with all terms seen taken into account). So what is seen well
is learned first, and the thousands of terms that a single long document has carry little. In each step of fitting a part of
every document's terms is hidden, so that one telling term alone has to do.

The model is fitted on at most ``SAMPLE`` labelled rows, whatever the size of the table, and has the terms of those rows.

Defined results: null and empty texts have no terms and get the bias alone; repeated words count once, repeated rows get
equal scores; without both labels every document gets score 0. A column that has the score's name already is an error.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

from .common import ready, schema_ddl, slices, sole, text_bytes
from .labelled import sample

SAMPLE = 6000
BITS = 22
BEGINNINGS = (4, 5, 6, 7)
SHOWN = 0.8
FACTORS = 4
LEAST_VALUE = 0.1
#: Mean square length of the documents' frequent terms at most; long documents would make the steps too long.
MEAN_LENGTH = 8.0
#: Share of the documents from which a term has its full value, whatever it tells alone.
WELL_SEEN = 0.1
CACHED_WORDS = 200_000
#: A-Z to lower case; what is neither an ASCII letter or digit nor part of a longer UTF-8 sequence to a space.
FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


def hashed(word: bytes) -> int:
    return zlib.crc32(word) & ((1 << BITS) - 1)


def hashes(word: bytes) -> list[int]:
    """Terms of a word: itself and how it begins, which is shared by inflected and compound forms."""
    return [hashed(word), *(hashed(b"^" + word[:n]) for n in BEGINNINGS if len(word) >= n)]


def terms(data: bytes) -> set[int]:
    return {h for w in set(data.translate(FOLD).split()) for h in hashes(w)}


def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        rows = [np.array(sorted(terms(t)), "<i4").tobytes() for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary())], names=["label", "x"])


def summed(lines: np.ndarray, by: np.ndarray, size: int) -> np.ndarray:
    """In each line, the sums of the values with the same number."""
    return np.stack([np.bincount(by, line, minlength=size) for line in lines]).astype(np.float32)


def logits(bias: float, of: np.ndarray, who: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each document: bias, weights and products of all pairs; and its sums. ``of``: weight and factors of each term of each document."""
    total = summed(of, who, size)
    alone = np.bincount(who, np.einsum("ij,ij->j", of[1:], of[1:]), minlength=size)
    return bias + total[0] + 0.5 * ((total[1:] ** 2).sum(0) - alone), total


class Part:
    """Some documents of the sample: the terms of all, one after the other, and whose each is."""

    def __init__(self, own: list[np.ndarray], y: np.ndarray, value: np.ndarray):
        self.y, self.who = y.astype(np.float32), np.repeat(np.arange(len(own), dtype=np.int32), [len(r) for r in own])
        self.terms, term = np.unique(np.concatenate(own), return_inverse=True)
        self.term = term.astype(np.int32)
        self.value = value[self.terms][term]


class Model:
    """Bias, and by term a weight and factors (``own``: lines, the weight first), fitted by stochastic gradients with momentum."""

    def __init__(self, rows: list[np.ndarray], y: np.ndarray, *, rounds: int = 6, batch: int = 128, rate: float = 0.5, penalty: float = 1e-4, seed: int = 11):
        self.found, place = np.unique(np.concatenate(rows), return_inverse=True)
        place = place.astype(np.int32)
        size, count = len(self.found), np.array([len(r) for r in rows])
        share = y.mean()
        n, k = np.bincount(place, minlength=size), np.bincount(place, np.repeat(y, count), minlength=size)
        rate_of = np.clip(k / n, 1e-12, 1 - 1e-12)
        far = n * (rate_of * np.log(rate_of / share) + (1 - rate_of) * np.log((1 - rate_of) / (1 - share)))
        often = np.minimum(1, n / (WELL_SEEN * len(rows)))
        length = (often[place] ** 2).sum() / len(rows)
        often *= min(1.0, np.sqrt(MEAN_LENGTH / length))
        value = (LEAST_VALUE + (1 - LEAST_VALUE) * np.maximum(np.minimum(1, far / np.log(10 * size)), often)).astype(np.float32)
        rng = np.random.default_rng(seed)
        w = np.zeros((1 + FACTORS, size), np.float32)
        w[1:] = rng.normal(0, 0.05, (FACTORS, size))
        self.bias, slope, bias_slope = float(np.log(share / (1 - share))), np.zeros_like(w), 0.0
        each = np.split(place, np.cumsum(count)[:-1])
        some = rng.permutation(np.flatnonzero(count))  # documents without a term teach the bias only, which is given
        parts = [Part([each[i] for i in own], y[own], value) for own in np.split(some, range(batch, len(some), batch)) if len(own)]
        for step in range(rounds * len(parts)):
            part = parts[step % len(parts)]
            now = rate * (1 - step / (rounds * len(parts)))
            x = part.value * (rng.random(part.value.shape, np.float32) < SHOWN)
            of = w[:, part.terms][:, part.term] * x
            score, total = logits(self.bias, of, part.who, len(part.y))
            error = ((self.logistic(score) - part.y) / len(part.y)).astype(np.float32)
            back = error[part.who] * x
            rest = total[1:][:, part.who] - of[1:]
            slope *= 0.9
            slope[:, part.terms] += summed(np.concatenate([back[None], back * rest]), part.term, len(part.terms))
            w *= 1 - now * penalty
            w -= now * slope
            bias_slope = 0.9 * bias_slope + float(error.sum())
            self.bias -= 0.1 * now * bias_slope
        self.own = w * value

    @staticmethod
    def logistic(s: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(s, -30, 30)))

    def places(self, words: list[bytes]) -> Iterator[tuple[bytes, bytes]]:
        """Each word with the places of those of its terms that the sample had, as 32-bit integers."""
        each = list(map(hashes, words))
        code = np.fromiter(chain.from_iterable(each), np.int64)
        at = np.minimum(np.searchsorted(self.found, code), len(self.found) - 1)
        there = self.found[at] == code
        size = np.cumsum([len(e) for e in each])
        end = 4 * np.concatenate([[0], np.cumsum(there)])[size]
        packed = at[there].astype("<i4").tobytes()
        return ((w, packed[a:b]) for w, a, b in zip(words, [0, *end[:-1].tolist()], end.tolist(), strict=True))

    def score(self, rows: list[np.ndarray]) -> np.ndarray:
        """By document: places of its terms, each once."""
        n = np.array([len(r) for r in rows], np.int64)
        at = np.concatenate([np.zeros(0, np.int32), *rows])
        return self.logistic(logits(self.bias, self.own[:, at], np.repeat(np.arange(len(rows)), n), len(rows))[0])


def fit(docs: DataFrame, labels: DataFrame, *, allowed: Column | None = None, most: int = SAMPLE) -> Model | None:
    """None where the sample lacks one of the labels or has no term."""
    ready(docs.sparkSession)
    rows = sample(docs, labels, "toxic", allowed=allowed, most=most).select("label", text_bytes().alias("data"))
    got = sorted((r.label, bytes(r.x)) for r in rows.mapInArrow(features, "label int, x binary").collect())  # order must not depend on tasks
    y = np.array([a for a, _ in got], np.float64)
    if not 0 < y.sum() < len(y) or not any(b for _, b in got):
        return None
    return Model([np.frombuffer(b, "<i4") for _, b in got], y)


#: Of this process: a model's terms by word.
_PLACES: dict[bytes, dict[bytes, bytes]] = {}


def scored(docs: DataFrame, model: Model | None, name: str = "toxic_score") -> DataFrame:
    """All columns of ``docs`` and ``name`` double (0 to 1); a narrow map beside the rows."""
    ready(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.schema.fieldNames().index("text")
    if name in docs.columns:
        raise ValueError(f"{name} is a column already")
    out = f"{schema_ddl(docs)}, `{name}` double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        sole(__name__, _PLACES)
        mark = own.found.tobytes() if own else b""
        if mark not in _PLACES:
            _PLACES.clear()
            _PLACES[mark] = {}
        known = _PLACES[mark]
        for batch in slices(batches):
            if len(known) > CACHED_WORDS:
                known.clear()
            rows = []
            for t in batch.column(place).to_pylist():
                words = set((t or "").encode().translate(FOLD).split())
                if own and (new := [w for w in words if w not in known]):
                    known.update(own.places(new))
                rows.append(np.unique(np.frombuffer(b"".join(map(known.__getitem__, words)), "<i4")) if own else [])
            score = own.score(rows) if own else np.zeros(len(rows))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score)], names=[*batch.schema.names, name])

    return docs.mapInArrow(run, out)
