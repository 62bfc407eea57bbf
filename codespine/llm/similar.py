"""All pairs of shingle sets with a least Jaccard similarity, found exactly by prefixes of rare shingles.

Sets a and b of similarity t or more share ``t / (1 + t) x (|a| + |b|)`` shingles at least. So in any one order of all shingles they
have a common one among the first ``|a| - ceil(t |a|) + 1`` of a, and as many of b (their prefixes). The order here is rare shingles
first, by counts in a sample, then by hash; the sample decides on speed only. Sets meet in the list of each shingle of their prefixes. A
pair in a list is dropped where the sizes, or what follows the shared shingle in both sets, rule the similarity out. So is a pair whose
parity fingerprints differ too much: bit i tells whether an odd number of the set's hashes is i modulo the bits, so a shingle in one set only flips one
bit, and Hamming distance is at most the number of such shingles, of which a similar pair has ``(1 - t) / (1 + t) x (|a| + |b|)`` at most.
Lists carry 128 bits of it; what they leave is compared on two to four bits a shingle, and on pivot distance tables (``pivots``): a set's distances to 64
references, none of which can differ by more than the two sets' own distance. All others are verified on the sets. Nothing else is left out, however long a list is.

Pairs that the caller proposes (``simhash`` has those of near fingerprints) come first, through the same tables and the same verification. Then lists are taken in rounds: neighbours by size first, in the lists of the rarest shingles only and then in all, then farther members, at last
all. Each round leaves out pairs that links found before have joined, so a list of thousands of near copies doesn't become all its pairs, nor do
all the lists that they share. Equal sets are one node from the start.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_few, ready, slices, sole, text_bytes, written
from .components import components

#: So many documents at most tell which shingles are frequent, and so many frequent shingles go to all tasks.
SAMPLE, FREQUENT = 8192, 1 << 18
#: By round: places in the prefixes that count (None: all), and distances in a list.
ROUNDS = ((2, 1, 1), (None, 1, 4), (None, 5, 64), (None, 65, None))
#: So many nodes to compare go to all tasks at most.
NODES_SENT = 500_000
PAIRS_AT_ONCE = 1 << 18
#: About so many ids, pairs with their fingerprints, and pairs with their sets are a task and a file where they are few.
IDS_A_TASK, PAIRS_A_TASK, SETS_A_TASK = 1 << 16, 1 << 12, 1 << 9


def gram_set(hashes: list[int]) -> np.ndarray:
    return np.unique(np.array(hashes, np.uint64)).view(np.int64)


def node_of(grams: np.ndarray) -> int:
    """64 bits that stand for a set."""
    return int(np.uint64(xxhash.xxh64_intdigest(grams.tobytes())).view(np.int64))


def parity(grams: np.ndarray) -> np.ndarray:
    """The parity fingerprint of a set, 128 bits or the power of two that is two to four times its size, as bytes."""
    bits = 1 << max(7, (2 * len(grams) - 1).bit_length())
    return np.packbits(np.bincount(grams & (bits - 1), minlength=bits).astype(np.uint8) & 1, bitorder="little")


def pivots(grams: np.ndarray) -> np.ndarray:
    """A set's pivot distance table: by bit, how many more of its hashes have it set than not, within 16 bits.

    Reference i is the set of all shingles whose hash has bit i. A shingle that has it brings a set one nearer to it, any other one takes it one farther,
    so the number is a constant less the distance (shingles in one set only) to the reference, and by the triangle inequality two sets' numbers
    differ by their distance at most. Its signs are the SimHash of the set.
    """
    ones = np.unpackbits(grams.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.clip(2 * ones - len(grams), -(2**15), 2**15 - 1).astype(np.int16)


def folded(bits: np.ndarray, size: int) -> np.ndarray:
    """The fingerprint in so many bytes at most: as places are remainders, halves add up to the shorter one."""
    while len(bits) > size:
        bits = bits[: len(bits) // 2] ^ bits[len(bits) // 2 :]
    return bits


def frequent(sets: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that several of the ``sets`` (node, grams) have, ascending, and their counts; the most frequent ones if many."""
    counts = sets.dropDuplicates(["node"]).select(F.explode("grams").alias("gram")).groupBy("gram").count().where("count > 1")
    rows = counts.orderBy(F.desc("count"), "gram").limit(FREQUENT).toArrow()
    gram, count = (rows.column(k).to_numpy() for k in ("gram", "count"))
    order = np.argsort(gram)
    return gram[order], count[order]


def prefix(grams: np.ndarray, common: tuple[np.ndarray, np.ndarray], similarity: float) -> np.ndarray:
    """The first shingles of a set, rare ones first."""
    size = len(grams) - int(np.ceil(similarity * len(grams) - 1e-9)) + 1 if len(grams) else 0
    rank = np.zeros(len(grams), np.int64)
    if len(common[0]):
        at = np.minimum(np.searchsorted(common[0], grams), len(common[0]) - 1)
        rank = np.where(common[0][at] == grams, common[1][at], 0)
    return grams[np.lexsort((grams, rank))[:size]]


def whole_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """Columns of rows sorted by the first, cut only where that changes."""
    held: list[list[np.ndarray]] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        new = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        cut = int(np.searchsorted(new[0], new[0][-1]))
        if held and (cut or held[-1][0][-1] != new[0][-1]):
            head = int(np.searchsorted(new[0], held[-1][0][-1], "right"))
            done = max(cut, head)
            yield [np.concatenate(c) for c in zip(*held, [c[:done] for c in new], strict=True)]
            held, new = [], [c[done:] for c in new]
        elif cut:
            yield [c[:cut] for c in new]
            new = [c[cut:] for c in new]
        if len(new[0]):
            held.append(new)
    if held:
        yield [np.concatenate(c) for c in zip(*held, strict=True)]


def by_list(rows: DataFrame) -> DataFrame:
    return rows.repartition("key").sortWithinPartitions("key", "size", "node")


def meeting(postings: DataFrame) -> DataFrame:
    """The rows (``key``, ``size``, ``node``, ``pos``) of lists with two sets at least."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lists in whole_lists(batches):
            same = np.concatenate([[False], lists[0][1:] == lists[0][:-1], [False]])
            some = same[1:] | same[:-1]
            yield pa.RecordBatch.from_arrays([pa.array(c[some]) for c in lists], names=["key", "size", "node", "pos"])

    return by_list(postings.select("key", "size", "node", "pos")).mapInArrow(run, "key bigint, size int, node bigint, pos int")


def list_pairs(met: DataFrame, similarity: float, first: int, last: int | None) -> DataFrame:
    """``a``, ``b``: pairs of sets of different ``label``, ``first`` to ``last`` places apart in a list, that can be similar."""
    share, apart = similarity / (1 + similarity), (1 - similarity) / (1 + similarity)

    def pairs(key: np.ndarray, size: np.ndarray, node: np.ndarray, pos: np.ndarray, low: np.ndarray, high: np.ndarray, label: np.ndarray) -> Iterator[np.ndarray]:
        rest, step, alive = size - pos, 1, np.arange(len(key) - 1)
        while len(alive := alive[alive + step < len(key)]) and (last is None or step <= last):
            alive = alive[key[alive] == key[alive + step]]
            alive = alive[size[alive] >= similarity * size[alive + step] - 1e-9]  # farther ones are larger still
            if step >= first:
                for at in range(0, len(alive), PAIRS_AT_ONCE):
                    a = alive[at : at + PAIRS_AT_ONCE]
                    b = a + step
                    ok = (np.minimum(rest[a], rest[b]) >= share * (size[a] + size[b]) - 1e-9) & (label[a] != label[b])
                    a, b = a[ok], b[ok]
                    flips = sum(np.bitwise_count((x[a] ^ x[b]).view(np.uint64)).astype(np.int64) for x in (low, high))
                    ok = flips <= apart * (size[a] + size[b]) + 1e-9
                    if ok.any():
                        x, y = node[a[ok]], node[b[ok]]
                        yield np.stack([np.minimum(x, y), np.maximum(x, y)])
            step += 1

    def out(held: list[np.ndarray]) -> pa.RecordBatch:
        a, b = np.concatenate(held, axis=1)
        order = np.lexsort((b, a))
        a, b = a[order], b[order]
        new = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
        return pa.RecordBatch.from_arrays([pa.array(a[new]), pa.array(b[new])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for lists in whole_lists(batches):
            for some in pairs(*lists):
                held.append(some)
                n += some.shape[1]
                if n >= PAIRS_AT_ONCE:
                    yield out(held)
                    held, n = [], 0
        if held:
            yield out(held)

    return by_list(met.select("key", "size", "node", "pos", "low", "high", "label")).mapInArrow(run, "a bigint, b bigint").distinct()


def asked_of(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()


def promising(pairs: DataFrame, rows: DataFrame, similarity: float) -> DataFrame:
    """The ``pairs`` whose pivot tables and whole parity fingerprints don't rule that similarity out; ``rows``: node, size, parity, pivots."""
    apart = (1 - similarity) / (1 + similarity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            most = apart * (batch.column("a_size").to_numpy() + batch.column("b_size").to_numpy()) + 1e-9
            of_a, of_b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.int16).reshape(-1, 64).astype(np.int64) for c in ("a_pivots", "b_pivots"))
            near = np.abs(of_a - of_b).max(axis=1, initial=0) <= most
            batch, keep = batch.filter(pa.array(near)), []
            for x, y, n in zip(batch.column("a_parity").to_pylist(), batch.column("b_parity").to_pylist(), most[near].tolist(), strict=True):
                x, y = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
                least = min(len(x), len(y))
                keep.append(int(np.bitwise_count(folded(x, least) ^ folded(y, least)).sum()) <= n)
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    told = ["size", "parity", "pivots"]
    bits = rows.select("node", *told).join(asked_of(pairs), "node", "left_semi").dropDuplicates(["node"])
    of = lambda side: bits.select(F.col("node").alias(side), *[F.col(c).alias(f"{side}_{c}") for c in told])
    both = pairs.join(of("a"), "a").join(of("b"), "b").select("a", "b", *[f"{side}_{c}" for side in "ab" for c in told])
    return both.mapInArrow(run, "a bigint, b bigint")


def verified(pairs: DataFrame, rows: int, nodes: DataFrame, sets_of, similarity: float) -> DataFrame:
    """The ``pairs`` (``rows`` of them) whose sets have that similarity. ``nodes``: node, ``least``, the id of one document that may be null."""
    asked = asked_of(pairs)
    ids = written(in_few(nodes.join(asked, "node", "left_semi").select(F.col("least").alias("id")), rows, IDS_A_TASK))
    sets = sets_of(F.broadcast(ids) if ids.count() <= NODES_SENT else ids).join(asked, "node", "left_semi")
    sets = sets.dropDuplicates(["node"])  # one exchange by node, which both joins read
    of = lambda side: sets.select(F.col("node").alias(side), F.col("grams").alias(f"{side}_grams"))
    both = pairs.join(of("a"), "a").join(of("b"), "b")
    common = F.size(F.array_intersect("a_grams", "b_grams"))
    union = F.size("a_grams") + F.size("b_grams") - common
    return both.where((union > 0) & (common >= similarity * union)).select("a", "b")


def similar_links(rows: DataFrame, nodes: DataFrame, sets_of, similarity: float, proposed: DataFrame) -> DataFrame | None:
    """``node``, ``root`` of the components of all pairs with that similarity; None where no pair has it.

    ``rows``: node, size, prefix, parity, pivots; ``nodes``: node, least id, and ``low`` and ``high``, the parity in 128 bits; ``sets_of``: node and grams of
    the documents with given ids; ``proposed``: pairs (``a``, ``b``) of different nodes to look at first.
    """
    found = labels = None

    def looked_at(pairs: DataFrame) -> tuple[DataFrame | None, DataFrame | None]:
        pairs = written(pairs)
        if not (n := pairs.count()):
            return found, labels
        left = written(in_few(promising(pairs, rows, similarity), n, PAIRS_A_TASK))
        if not (n := left.count()):
            return found, labels
        more = written(in_few(verified(left, n, nodes, sets_of, similarity), n, SETS_A_TASK))
        if more.isEmpty():
            return found, labels
        links = more if found is None else found.union(more)
        return links, components(links)

    found, labels = looked_at(proposed)
    postings = rows.select("node", "size", "prefix").dropDuplicates(["node"]).select("node", "size", F.posexplode("prefix").alias("pos", "key"))
    met = written(meeting(postings).join(nodes.select("node", "low", "high"), "node"))  # bits go to the few rows that meet
    longest = met.groupBy("key").count().agg(F.coalesce(F.max("count"), F.lit(0))).first()[0]
    for places, first, last in ROUNDS:
        if first >= longest:
            break
        lists = met if places is None else met.where(F.col("pos") < places)
        named = lists.withColumn("label", F.col("node")) if labels is None else lists.join(labels, "node", "left").withColumn("label", F.coalesce("root", "node"))
        found, labels = looked_at(list_pairs(named, similarity, first, last))
    return labels


def shingled(docs: DataFrame, hashes, schema: str, fields) -> DataFrame:
    """A narrow map of ``docs`` (id, data): the id and what ``fields`` makes of the lists of shingle hashes of a batch."""
    ready(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sole(__name__)
        for batch in slices(batches):
            made = fields([hashes(t) for t in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), *made.values()], names=["doc_id", *made])

    return docs.mapInArrow(run, f"doc_id {docs.schema[0].dataType.simpleString()}, {schema}")


def data_of(docs: DataFrame, text: str, key: str) -> DataFrame:
    return docs.select(F.col(key).alias("doc_id"), text_bytes(text).alias("data"))
