"""Quality by Bradley-Terry ranking: scores learned from preference pairs, a threshold from the scores' quantiles.

A document is a short row of measures of its surface (case, symbols, separators, word lengths, repetition). A pair is a
document labelled 1 against one labelled 0; the probability that the first is preferred is the logistic function of the difference of their scores, and
the weights minimise the logistic loss on feature differences. Documents below the quantile that corresponds to
the share of label 0 are rejected; the score is the logistic function of the distance to that threshold.

All labelled rows are learned from. They are dealt into buckets by a hash of their ids, and in a bucket each row of either label stands in pairs with
rows of the other; the rarer label's rows go to several buckets where there are too few of them. Means, Newton's steps and the threshold (an exact order
statistic of all scores) are sums over buckets, so the driver holds a few numbers for each bucket.

Defined results: null and empty texts have the measures of an empty text and a score like any other; repeated rows get equal
scores; without both labels every document is kept, at score 1.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ready, schema_ddl, slices, text_bytes, written
from .labelled import labelled

#: Pairs at least, and for each row of the more frequent label.
PAIRS, PAIRS_EACH = 20_000, 4
#: Rows of the more frequent label in a bucket, and of the rarer one at least where there are as many.
BUCKET, FEWEST = 8192, 64
#: Scores that the driver orders itself, and bins of a pass that narrows them down.
ORDERED, BINS = 50_000, 4096
CHUNK = 1 << 20
UPPER, LOWER, DIGIT, SPACE = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b" \t\r\n\x0b\x0c"
SYMBOLS = (b"|", b"#$%&*", b"!", b".", b",;:", b"?", b"<>{}[]()=/\\_^~@+`\"'-")
#: By measure: bytes that it counts.
CLASSES = (UPPER, LOWER, DIGIT, SPACE, *SYMBOLS)
CLASS_OF = np.full(256, len(CLASSES))
for _k, _bytes in enumerate(CLASSES):
    CLASS_OF[list(_bytes)] = _k
STOP = re.compile(rb"[.!?]")


def measures(data: bytes) -> list[float]:
    """The surface of one text; the work is linear in its length."""
    raw = np.frombuffer(data, np.uint8)
    by_class = np.bincount(CLASS_OF[raw], minlength=len(CLASSES) + 1) if len(raw) <= CHUNK else sum(np.bincount(CLASS_OF[raw[i : i + CHUNK]], minlength=len(CLASSES) + 1) for i in range(0, len(raw), CHUNK))
    words, lines = data.split(), [x for x in data.split(b"\n") if x.strip()]
    n, size = len(words), max(len(data), 1)
    distinct, different = len(set(words)), len(set(lines))
    out = [float(np.log1p(n)), float(np.log1p(len(data)))]
    for count in by_class.tolist():
        out += [count / size, float(np.sqrt(count / size)), count / max(n, 1)]
    out += [
        len(data) / max(n, 1), distinct / max(n, 1), float(np.log1p(n) - np.log1p(distinct)), different / max(len(lines), 1), float(np.log1p(len(lines) - different)),
        len(STOP.findall(data)) / max(n, 1), n / max(len(lines), 1), float(len(data) == 0), sum(1 for w in words if len(w) == 1) / max(n, 1),
    ]
    return out


WIDTH = len(measures(b""))


def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([measures(t) for t in batch.column(1).to_pylist()], pa.list_(pa.float64()))], names=["id", "x"])


def scale_of(spread: np.ndarray) -> np.ndarray:
    return np.where(spread > 1e-9, spread, np.inf)


def slopes(d: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums over pairs of the logistic loss' gradient and second derivatives; ``d``: differences."""
    p = 1 / (1 + np.exp(np.clip(d @ w, -40, 40)))
    return -d.T @ p, (d * (p * (1 - p))[:, None]).T @ d


def newton(step: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray, int]], width: int, penalty: float) -> np.ndarray:
    """Newton's method on the mean loss of all pairs; ``step``: sums as above and the number of pairs at some weights."""
    w = np.zeros(width)
    for _ in range(25):
        gradient, curve, n = step(w)
        move = np.linalg.solve(curve / n + penalty * np.eye(width), gradient / n + penalty * w)
        w -= move
        if np.abs(move).max() < 1e-8:
            break
    return w


class Model:
    """Weights over standardised measures, and the threshold."""

    def __init__(self, x: np.ndarray, y: np.ndarray, *, pairs: int = PAIRS, penalty: float = 1e-3, seed: int = 7):
        """Fitted on rows at hand, with random pairs."""
        self.mean, self.scale = x.mean(0), scale_of(x.std(0))
        z = self.standard(x)
        rng = np.random.default_rng(seed)
        good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
        d = z[rng.choice(good, pairs)] - z[rng.choice(bad, pairs)]
        self.w = newton(lambda w: (*slopes(d, w), pairs), d.shape[1], penalty)
        s = np.sort(z @ self.w)
        k = int(np.clip(len(bad), 1, len(s) - 1))  # as many rejected as have label 0
        self.threshold = float((s[k - 1] + s[k]) / 2)

    def standard(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.standard(x) @ self.w - self.threshold, -700, 700)))


def pairs_of(z: np.ndarray, first: int, bucket: int, least: int) -> np.ndarray:
    """Differences of a bucket's pairs: every one of the ``first`` rows (label 1) and of the others stands in some, ``least`` pairs or more."""
    rng = np.random.default_rng((7, bucket))
    length = max(first, len(z) - first)
    times = max(PAIRS_EACH, -(-least // length))
    dealt = lambda n: np.concatenate([np.resize(rng.permutation(n), length) for _ in range(times)])
    return z[dealt(first)] - z[first + dealt(len(z) - first)]


def packed(group: pa.Table) -> pa.Table:
    """A bucket as one row: its rows in an order that doesn't depend on tasks, label 1 first, and which of them are no copies."""
    x = group.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, WIDTH)
    label, own = (group.column(c).to_numpy() for c in ("label", "own"))
    order = np.lexsort((*x.T[::-1], ~own, -label))
    return pa.table({"bucket": group.column("bucket")[:1], "first": pa.array([int(label.sum())]), "own": pa.array([own[order].tobytes()], pa.binary()), "x": pa.array([x[order].tobytes()], pa.binary())})


class Buckets:
    """Labelled rows by buckets, and passes over all of them."""

    def __init__(self, rows: DataFrame, good: int, bad: int):
        """``rows``: label, x, h (a hash of the id)."""
        most, rare = max(good, bad), min(good, bad)
        self.n, self.bad, self.count = good + bad, bad, -(-most // BUCKET)
        few = min(self.count, max(1, rare // FEWEST))
        at = F.pmod("h", F.when(F.col("label") == int(good < bad), F.lit(few)).otherwise(F.lit(self.count)))
        step = F.when(F.col("label") == int(good < bad), F.lit(few)).otherwise(F.lit(self.count))
        dealt = rows.select("label", "x", at.cast("long").alias("at"), step.cast("long").alias("step")).withColumn("bucket", F.explode(F.sequence("at", F.lit(self.count - 1).cast("long"), "step")))
        dealt = dealt.select("bucket", "label", "x", (F.col("bucket") == F.col("at")).alias("own"))
        self.rows = written(dealt.groupBy("bucket").applyInArrow(packed, "bucket bigint, first bigint, own binary, x binary"))

    def each(self, f: Callable[[int, int, np.ndarray, np.ndarray], np.ndarray]) -> list[np.ndarray]:
        """Numbers of each bucket, in order of the buckets; ``f``: bucket, rows of label 1, which are no copies, measures."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    out = f(row["bucket"], row["first"], np.frombuffer(row["own"], bool), np.frombuffer(row["x"]).reshape(-1, WIDTH))
                    yield pa.RecordBatch.from_arrays([pa.array([row["bucket"]]), pa.array([out.astype(np.float64).tobytes()], pa.binary())], names=["bucket", "out"])

        return [np.frombuffer(r.out) for r in sorted(self.rows.mapInArrow(run, "bucket bigint, out binary").collect(), key=lambda r: r.bucket)]

    def sum(self, f: Callable[[int, int, np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
        return np.sum(self.each(f), axis=0)

    def middle(self, score: Callable[[np.ndarray], np.ndarray], k: int) -> float:
        """Half way between the k-th and the next of all scores: bins are counted until few enough scores are left to be ordered."""
        low, high, below, left = -np.inf, np.inf, 0, self.n
        if left > ORDERED:
            ends = self.each(lambda b, first, own, x: np.array([score(x).min(), score(x).max()]))
            low, high = min(e[0] for e in ends), max(e[1] for e in ends)
        while left > ORDERED:
            edges = np.linspace(low, high, BINS + 1)[1:-1]
            counts = self.sum(lambda b, first, own, x: np.bincount(np.searchsorted(edges, (s := score(x[own]))[(s >= low) & (s <= high)], "left"), minlength=BINS))  # noqa: B023
            total = below + np.cumsum(counts)
            a, b = np.searchsorted(total, [k, k + 1])
            bounds = np.concatenate([[low], edges, [high]])
            new = max(low, np.nextafter(bounds[a], np.inf) if a else low), bounds[b + 1]
            below += int(counts[:a].sum())
            if new == (low, high):
                break  # equal scores
            (low, high), left = new, int(counts[a : b + 1].sum())

        def values(b: int, first: int, own: np.ndarray, x: np.ndarray) -> np.ndarray:
            s = score(x[own])
            return np.concatenate(np.unique(s[(s >= low) & (s <= high)], return_counts=True))

        found = [v.reshape(2, -1) for v in self.each(values)]
        value, times = np.concatenate([v[0] for v in found]), np.concatenate([v[1] for v in found])
        order = np.argsort(value)
        end = below + np.cumsum(times[order])
        return float(value[order][np.searchsorted(end, [k, k + 1])].mean())


def fit(docs: DataFrame, labels: DataFrame, *, allowed: Column | None = None, key: str = "doc_id", penalty: float = 1e-3) -> Model | None:
    """Fitted on all labelled rows; None where they lack one of the labels."""
    ready(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()
    measured = docs.where(F.col(key).isNotNull()).select(key, text_bytes().alias("data")).mapInArrow(features, f"id {kind}, x array<double>")
    one = labelled(labels, "quality", allowed=allowed, key=key).withColumnRenamed(key, "id")
    rows = written(measured.join(one, "id").select("label", "x", F.xxhash64("id").alias("h")))  # measures are joined, not texts
    number = {r.label: r["count"] for r in rows.groupBy("label").count().collect()}
    good, bad = number.get(1, 0), number.get(0, 0)
    if not good or not bad:
        return None
    data, model = Buckets(rows, good, bad), Model.__new__(Model)
    mean = data.sum(lambda b, first, own, x: x[own].sum(0)) / data.n
    scale = scale_of(np.sqrt(data.sum(lambda b, first, own, x: ((x[own] - mean) ** 2).sum(0)) / data.n))
    model.mean, model.scale = mean, scale
    standard, least = (lambda x: np.clip((x - mean) / scale, -8, 8)), -(-PAIRS // data.count)

    def step(w: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        def one(b: int, first: int, own: np.ndarray, x: np.ndarray) -> np.ndarray:
            d = pairs_of(standard(x), first, b, least)
            gradient, curve = slopes(d, w)
            return np.concatenate([gradient, curve.ravel(), [len(d)]])

        total = data.sum(one)
        return total[:WIDTH], total[WIDTH:-1].reshape(WIDTH, WIDTH), int(total[-1])

    model.w = w = newton(step, WIDTH, penalty)
    model.threshold = data.middle(lambda x: standard(x) @ w, bad)  # as many rejected as have label 0
    return model


def scored(docs: DataFrame, model: Model | None, name: str = "quality_score") -> DataFrame:
    """All columns of ``docs`` and ``name`` double (0 to 1; at least 0.5: kept); a narrow map beside the rows."""
    ready(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.schema.fieldNames().index("text")
    if name in docs.columns:
        raise ValueError(f"{name} is a column already")
    out = f"{schema_ddl(docs)}, `{name}` double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in slices(batches):
            x = np.array([measures((t or "").encode()) for t in batch.column(place).to_pylist()]).reshape(-1, WIDTH)
            score = own.score(x) if own else np.ones(len(x))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score)], names=[*batch.schema.names, name])

    return docs.mapInArrow(run, out)
