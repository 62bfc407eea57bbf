"""SimHash near-duplicates verified through pivot distance tables.

Fingerprints of 64 bits link at ``radius`` or fewer differing bits. Equal fingerprints are one class from the start, so
copies cost nothing further. A metric table alone can't find candidates here: distances of random fingerprints to any
reference lie within a few bits of 32, and nearly every pair survives a single coordinate. So classes first meet in
buckets: of ``radius + 2`` bands of bits, linked fingerprints agree in two at least, so any two equal bands make a
bucket, and no link is lost. Within a bucket every fingerprint has a row of Hamming distances to 32 references (Walsh
patterns, which are orthogonal); pairs whose largest coordinate difference exceeds the radius can't link (triangle inequality)
and are discarded, and the survivors are verified on the fingerprints.

A bucket sends the edges of a spanning forest, never all its pairs. Buckets above ``BUCKET`` fingerprints are not
compared at all: there each fingerprint visits all centres within ``radius / 2`` bits, and those that share a centre are linked
to the least of them, which gives the same components in a number of rows linear in the bucket.

Few bits apart is only a sign of likeness: texts that share 0.8 of their shingles differ in about ten bits, and some within four
share less. Where a similarity is asked for, equal and linked fingerprints propose pairs; pivot distance tables of their shingle sets (``similar.pivots``) discard,
and the sets themselves verify them. What fingerprints can't propose isn't lost: ``similar`` finds all other pairs of shingle sets exactly, past the same tables.

Defined results: null and empty texts have fingerprint zero and link like any other; a text with fewer words than a shingle
is one shingle; repeated rows share a class; null ids stay as rows and never name a component that has another id.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, in_few, ready, slices, text_bytes, written
from .components import components, forest
from .similar import IDS_A_TASK, NODES_SENT, SAMPLE, data_of, folded, frequent, gram_set, node_of, parity, pivots, prefix, shingled, similar_links

BUCKET = 1024
SEED = 42
FAMILY_BIT = 52
MIX = np.uint64(0x9E3779B97F4A7C15)
LANES = np.uint64(0x0101010101010101)
PIVOTS = np.array([sum(((k & j).bit_count() & 1) << j for j in range(64)) for k in range(1, 64, 2)], np.uint64)


def shingle_hashes(data: bytes, width: int) -> list[int]:
    """XXH64 of each run of ``width`` words; A-Z in lower case, words parted by ASCII white space."""
    words = data.lower().split()
    if not words:
        return []
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= width:
        return [digest(joined, SEED)]
    size = np.fromiter(map(len, words), np.int64, len(words))
    start = np.cumsum(size + 1) - size - 1
    end = (start + size)[width - 1 :].tolist()
    return [digest(joined[a:b], SEED) for a, b in zip(start.tolist(), end, strict=False)]


def majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The fingerprint of each group: bits set in over half of its hashes; ``counts``: hashes per group, none zero.

    Eight bits are counted side by side in the bytes of one integer, in runs short enough not to overflow.
    """
    ends = np.cumsum(counts)
    runs = -(-counts // 255)
    at = np.repeat(ends - counts, runs) + 255 * (np.arange(runs.sum()) - np.repeat(np.cumsum(runs) - runs, runs))
    first = np.cumsum(runs) - runs
    out = np.zeros(len(counts), np.uint64)
    for k in range(8):
        lanes = np.add.reduceat(hashes >> np.uint64(k) & LANES, at)
        votes = np.add.reduceat(lanes.view(np.uint8).reshape(-1, 8).astype(np.int64), first, axis=0)
        for j, column in enumerate(votes.T):
            out |= (2 * column > counts).astype(np.uint64) << np.uint64(8 * j + k)
    return out


def remixed(hashes: np.ndarray, family: int) -> np.ndarray:
    """Other hashes of the same shingles; family 0 has the hashes as they are."""
    if not family:
        return hashes
    mixed = (hashes ^ hashes >> np.uint64(29) ^ np.uint64(family)) * MIX
    return (mixed ^ mixed >> np.uint64(32)) * MIX


def fingerprints(docs: DataFrame, *, width: int = 4, families: int = 1, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``doc_id``, ``fp`` long (the 64 bits as a signed integer) of every row, and ``others``, the fingerprints of further
    families of hashes; a narrow map."""
    ready(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            each = [np.array(shingle_hashes(t, width), np.uint64) for t in batch.column(1).to_pylist()]
            counts = np.array([len(x) for x in each])
            out = np.zeros((families, len(each)), np.uint64)
            if counts.any():
                for k in range(families):
                    out[k, counts > 0] = majority(remixed(np.concatenate(each), k), counts[counts > 0])
            others = pa.array(list(out[1:].T.view(np.int64)) if families > 1 else [[]] * len(each), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out[0].view(np.int64)), others], names=["doc_id", "fp", "others"])

    rows = docs.select(F.col(key).alias("doc_id"), text_bytes(text).alias("data"))
    return rows.mapInArrow(run, f"doc_id {docs.schema[key].dataType.simpleString()}, fp bigint, others array<bigint>")


def bands(radius: int) -> list[tuple[int, int]]:
    """(first bit, bits) of ``radius + 2`` bands."""
    cuts = [round(64 * k / (radius + 2)) for k in range(radius + 3)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


def bucket_keys(fp: Column, radius: int) -> Column:
    """One key for each two bands; the bands' number and bits fit a long."""
    cut = bands(radius)
    part = [F.shiftrightunsigned(fp, a).bitwiseAND((1 << n) - 1) for a, n in cut]
    both = combinations(range(len(cut)), 2)
    return F.array(*[F.lit(k << 48).bitwiseOR(F.shiftleft(part[i], 24)).bitwiseOR(part[j]) for k, (i, j) in enumerate(both)])


def bucket_links(keys: np.ndarray, fps: np.ndarray, radius: np.ndarray, wide: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Spanning links (positions) of the buckets in rows sorted by key, and pairs to look at beyond the radius.

    ``radius`` goes by row and is negative where no pair is sure. Of the pairs that differ in more bits, up to ``wide``, each
    linked group of a bucket keeps its nearest, so their number is linear in the bucket.
    """
    table = np.bitwise_count(fps[:, None] ^ PIVOTS).astype(np.int8)
    lefts, rights, apart = [], [], []
    alive = np.arange(len(keys) - 1)
    step = 1
    while len(alive := alive[alive + step < len(keys)]):
        alive = alive[keys[alive] == keys[alive + step]]
        for at in range(0, len(alive), 1 << 16):
            a = alive[at : at + (1 << 16)]
            for k in (slice(0, 8), slice(8, 16), slice(16, 32)):  # the first coordinates already discard most pairs
                a = a[np.abs(table[a, k] - table[a + step, k]).max(axis=1, initial=0) <= wide]
            bits = np.bitwise_count(fps[a] ^ fps[a + step])
            near = bits <= wide
            lefts.append(a[near])
            rights.append(a[near] + step)
            apart.append(bits[near])
        step += 1
    none = np.zeros(0, np.int64)
    left, right, bits = (np.concatenate(x) if x else none for x in (lefts, rights, apart))
    close = bits <= radius[left]
    root = forest(left[close], right[close], len(keys))
    linked = np.flatnonzero(root != np.arange(len(keys)))
    x, y, bits = left[~close], right[~close], bits[~close]
    other = root[x] != root[y]
    order = np.argsort(bits[other], kind="stable")
    x, y = x[other][order], y[other][order]
    first = np.zeros(len(x), bool)
    for end in (x, y):
        first[np.unique(root[end], return_index=True)[1]] = True
    return linked, root[linked], x[first], y[first]


def light_links(rows: DataFrame, radius: int, wide: int) -> DataFrame:
    """``a``, ``b``, ``sure`` of the links and the pairs to look at within buckets of bounded size.

    ``rows``: key, bits (compared), fp (who it is). Only pairs of the first family, within ``radius``, are sure.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64)] * 3

        def out(k: np.ndarray, bits: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
            a, b, x, y = bucket_links(k, bits.view(np.uint64), np.where(k >> FAMILY_BIT == 0, radius, -1), wide)
            sure = pa.array(np.arange(len(a) + len(x)) < len(a))
            return pa.RecordBatch.from_arrays([pa.array(fp[np.concatenate([a, x])]), pa.array(fp[np.concatenate([b, y])]), sure], names=["a", "b", "sure"])

        for batch in batches:
            held = [np.concatenate([h, batch.column(i).to_numpy(zero_copy_only=False)]) for i, h in enumerate(held)]
            done = int(np.searchsorted(held[0], held[0][-1])) if len(held[0]) else 0
            if done:
                yield out(*(h[:done] for h in held))
                held = [h[done:] for h in held]
        if len(held[0]):
            yield out(*held)

    return rows.select("key", "bits", "fp").repartition("key").sortWithinPartitions("key", "bits", "fp").mapInArrow(run, "a bigint, b bigint, sure boolean")


def heavy_links(rows: DataFrame, radius: int) -> DataFrame:
    """Links within buckets of any size through shared centres ``radius / 2`` bits away; ``rows``: key, fp."""
    flips = [sum(1 << b for b in some) for n in range(radius // 2 + 1) for some in combinations(range(64), n)]
    signed = F.array(*[F.lit(x - (1 << 64) if x >> 63 else x) for x in flips])
    spread = rows.select("fp").distinct().select("fp", F.explode(F.transform(signed, lambda m: m.bitwiseXOR(F.col("fp")))).alias("centre"))
    least = spread.groupBy("centre").agg(F.min("fp").alias("b"), F.max("fp").alias("top")).where("b < top").select("centre", "b")
    return spread.join(least, "centre").where("fp <> b").select(F.col("fp").alias("a"), "b").distinct()


def links(classes: DataFrame, *, families: int = 1, radius: int = 4, wide: int | None = None, bucket: int = BUCKET) -> DataFrame:
    """``a``, ``b``, ``sure``: links between different fingerprints whose components are those of all links.

    ``classes``: distinct ``fp``, and ``others`` for further families. With ``wide`` there are also pairs to compare, which aren't
    sure: up to that many bits apart in a bucket of any family, or a class and the least one of a bucket above ``bucket``.
    """
    if radius % 2 or not 0 < radius <= 8:
        raise ValueError("the radius has to be 2, 4, 6 or 8 bits")
    each = F.concat(F.array("fp"), F.coalesce("others", F.array().cast("array<bigint>"))) if families > 1 else F.array("fp")
    keyed = classes.select("fp", F.posexplode(each).alias("family", "bits"))
    key = F.shiftleft(F.col("family").cast("long"), FAMILY_BIT).bitwiseOR(F.col("k"))
    keyed = keyed.withColumn("k", F.explode(bucket_keys(F.col("bits"), radius))).select(key.alias("key"), "fp")
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    # by size of file Spark would broadcast the keys, many times that file
    shared = keyed.hint("merge").join(sizes, "key").join(classes.select("fp", each.alias("each")), "fp")  # bits come back for the few that meet
    met = written(shared.select("key", F.get("each", F.shiftright("key", FAMILY_BIT).cast("int")).alias("bits"), "fp", "n"))
    light = light_links(met.where(F.col("n") <= bucket), radius, wide or radius)
    heavy = met.where(F.col("n") > bucket)
    if heavy.isEmpty():
        return light
    first = heavy.where(F.col("key") < 1 << FAMILY_BIT)
    light = light.union(heavy_links(first, radius).withColumn("sure", F.lit(True)))
    if wide:
        least = heavy.groupBy("key").agg(F.min("fp").alias("b"))
        light = light.union(heavy.join(least, "key").where("fp <> b").select(F.col("fp").alias("a"), "b", F.lit(False)))
    return light


def proposed(prints: DataFrame, *, radius: int = 4, bucket: int = BUCKET) -> DataFrame:
    """``a``, ``b``: pairs of different sets with equal or linked fingerprints, so many as span each group of them; ``prints``: fp, node."""
    rows = prints.count()
    each = written(in_few(prints.select("fp", "node").distinct(), rows, IDS_A_TASK))
    first = written(in_few(each.groupBy("fp").agg(F.min("node").alias("first"), F.count("*").alias("n")), rows, IDS_A_TASK))
    same = each.join(first.where("n > 1"), "fp").select(F.col("first").alias("a"), F.col("node").alias("b"))
    of = lambda side: first.select(F.col("fp").alias(side), F.col("first").alias(f"{side}_first"))
    near = links(first.select("fp"), radius=radius, bucket=bucket).join(of("a"), "a").join(of("b"), "b").select("a_first", "b_first")
    return same.union(near).where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def similar(docs: DataFrame, *, width: int, similarity: float, radius: int = 4, bucket: int = BUCKET, text: str = "text", key: str = "doc_id") -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """``doc_id``, ``fp``, ``node`` (of the shingle set) of every row; ``node``, ``least`` id; ``node``, ``root`` of linked nodes or None."""
    data = data_of(docs, text, key)
    hashes = lambda t: shingle_hashes(t, width)

    def sets(each: list[list[int]]) -> dict[str, pa.Array]:
        grams = [gram_set(x) for x in each]
        return {"node": pa.array([node_of(g) for g in grams], pa.int64()), "grams": pa.array(grams, pa.list_(pa.int64()))}

    def sets_of(ids: DataFrame) -> DataFrame:
        return shingled(data.join(ids, F.col("doc_id").eqNullSafe(F.col("id")), "left_semi"), hashes, "node bigint, grams array<bigint>", sets)

    count = data.count()
    share = -(-count // SAMPLE) or 1
    sample = data.where(F.pmod(F.xxhash64("doc_id", "data"), F.lit(share)) == 0)
    common = docs.sparkSession.sparkContext.broadcast(frequent(shingled(sample, hashes, "node bigint, grams array<bigint>", sets)))

    def prints(each: list[list[int]]) -> dict[str, pa.Array]:
        grams = [gram_set(x) for x in each]
        counts = np.array([len(x) for x in each])
        fps = np.zeros(len(each), np.uint64)
        if counts.any():
            fps[counts > 0] = majority(np.concatenate([np.array(x, np.uint64) for x in each]), counts[counts > 0])
        bits = [parity(g) for g in grams]
        short = np.array([folded(b, 16) for b in bits], np.uint8).reshape(-1, 16).view(np.int64)
        return {
            "fp": pa.array(fps.view(np.int64)), "node": pa.array([node_of(g) for g in grams], pa.int64()),
            "size": pa.array([len(g) for g in grams], pa.int32()), "prefix": pa.array([prefix(g, common.value, similarity) for g in grams], pa.list_(pa.int64())),
            "parity": pa.array([b.tobytes() for b in bits], pa.binary()), "pivots": pa.array([pivots(g).tobytes() for g in grams], pa.binary()), "low": pa.array(short[:, 0]), "high": pa.array(short[:, 1]),
        }

    rows = written(shingled(data, hashes, "fp bigint, node bigint, size int, prefix array<bigint>, parity binary, pivots binary, low bigint, high bigint", prints))
    nodes = written(in_few(rows.groupBy("node").agg(F.min("doc_id").alias("least"), F.min("low").alias("low"), F.min("high").alias("high")), count, IDS_A_TASK))
    pairs = proposed(rows, radius=radius, bucket=bucket)
    return rows.select("doc_id", "fp", "node"), nodes, similar_links(rows, nodes, sets_of, similarity, pairs)


def near_duplicates(docs: DataFrame, *, width: int = 4, radius: int = 4, similarity: float | None = None, bucket: int = BUCKET, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``doc_id``, ``fp``, ``component_id`` (the smallest id reachable over links, itself included) of every row.

    Fingerprints up to ``radius`` bits apart link. With ``similarity``, documents link instead if their sets of shingles are equal
    or have that Jaccard similarity; then ``radius`` and ``bucket`` decide which pairs are looked at first, not which are found.
    """
    if similarity:
        prints, classes, roots = similar(docs, width=width, similarity=similarity, radius=radius, bucket=bucket, text=text, key=key)
    else:
        prints = written(fingerprints(docs, width=width, text=text, key=key)).withColumn("node", F.col("fp"))
        classes = written(prints.groupBy("node").agg(F.min("doc_id").alias("least")))
        roots = components(links(classes.select(F.col("node").alias("fp")), radius=radius, bucket=bucket))
    if roots is None:
        final = classes.select("node", F.col("least").alias("component_id"))
    else:
        linked = roots.join(classes, "node").select("node", "root", "least")
        named = linked.groupBy("root").agg(F.min("least").alias("component"))
        of = linked.join(named, "root").select("node", "component")
        final = classes.join(of, "node", "left").select("node", F.coalesce("component", "least").alias("component_id"))
    return prints.join(final, "node").select("doc_id", "fp", "component_id")


def deduplicated(docs: DataFrame, *, width: int = 5, radius: int = 4, similarity: float | None = 0.8) -> DataFrame:
    """One row of each component: that with the smallest id, and of several such rows that with the smallest hash of its columns. The columns stay.

    Rows that share an id and differ in a column are documents of their own: alike ones are one component, others all stay.
    Rows equal in all columns are one document (columns of maps don't count). Rows without an id all stay.
    Ids and hashes decide; texts move between tasks only if more than ``NODES_SENT`` rows go, and once then.
    """
    row = F.xxhash64(*[c for c, kind in docs.dtypes if "map<" not in kind])
    named = docs.select(F.when(F.col("doc_id").isNotNull(), F.struct(F.col("doc_id").alias("id"), row.alias("row"))).alias("doc_id"), "text")
    found = near_duplicates(named, width=width, radius=radius, similarity=similarity).where("doc_id IS NOT NULL")
    decided = written(found.groupBy("doc_id").agg(F.count("*").alias("n"), F.first("component_id").alias("component_id")))
    column = free_name(docs, "row_hash")
    of = decided.select(F.col("doc_id.id").alias("doc_id"), F.col("doc_id.row").alias(column), "n", (F.col("doc_id") == F.col("component_id")).alias("kept"))
    gone, several = of.where("NOT kept").drop("n", "kept"), of.where("kept AND n > 1").drop("n", "kept")
    sent = lambda x: F.broadcast(x) if x.count() <= NODES_SENT else x
    left = docs.withColumn(column, row).join(sent(gone), ["doc_id", column], "left_anti")
    if several.isEmpty():
        return left.select(*docs.columns)
    several = sent(several)
    once = left.join(several, ["doc_id", column], "left_semi").dropDuplicates(["doc_id", column])
    return left.join(several, ["doc_id", column], "left_anti").unionByName(once).select(*docs.columns)
