"""Phrases of two to four words by their collocation score, counted over whole texts.

1. Texts are read in portions of about ``PORTION_BYTES``, each language on its own: words become places in the portion's own list, pieces end with a mark.
2. Words of all portions are summed; those with ``least`` occurrences or more get dense ids of 32 bits. A phrase can't be frequent unless its words are, so the portions
   are rewritten in ids and broken at all other words. The dictionary goes to the portions by a join, so it may be of any size.
3. For n = 2, 3, 4 a portion's id n-grams are packed into keys of n 32-bit ids, put in order by a radix sort over 16-bit digits and run-length counted. What is left,
   at most one row a key and portion, is cut at the borders of key ranges, which a sample of keys gives; each range is sorted and counted the same way.
   A range tells each portion which of its keys are frequent, and the portion breaks its pieces where one isn't, so that the next n has little left.
4. Candidates are scored at their cuts by joins with the counts of their parts, which are all frequent.

Hot words and phrases are counted where they stand: no key has more rows in a shuffle than there are portions. Ranges hold about ``RANGE_KEYS`` keys.
Borders of ranges come from at most ``SAMPLED`` portions; they move work between tasks, never results.

Defined results: null and empty texts have no words; a null language is ``und``; A-Z are lower-cased and no other letters; repeated rows count each time; an
empty table gives no rows; other columns don't matter. Counts are exact 64-bit integers, and products of them decimals of 38 digits.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import gathered, ready, text_bytes, written

PORTION_BYTES = 12 << 20
RANGE_KEYS = 1_000_000
SAMPLED, SAMPLE_KEYS = 256, 64
LONGEST = 4
MARK = b"."
CODEC = "zstd"

#: One table does both: A-Z become a-z, the characters that end a piece become the mark, which then is no part of a word.
CLEAN = bytes(MARK[0] if chr(c) in ".,;:!?\n\x0b\x0c\r" else c + 32 if 65 <= c <= 90 else 32 if c == 9 else c for c in range(256))


class Places(dict):
    """Words by their place in order of first appearance."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def packed(x: np.ndarray) -> bytes:
    """Compressed bytes of integers, with their number before them."""
    raw = np.ascontiguousarray(x).tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, CODEC, asbytes=True) if raw else b""


def unpacked(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(pa.decompress(data[8:], int.from_bytes(data[:8], "little"), CODEC, asbytes=True) if data else b"", kind)


def radix_order(keys: np.ndarray) -> np.ndarray:
    """The order of fixed-width keys (rows of 32-bit ids): least significant 16-bit digit first, each pass a stable counting sort."""
    order = np.arange(len(keys))
    for column in range(keys.shape[1] - 1, -1, -1):
        for shift in (0, 16):
            digit = (keys[:, column] >> shift).astype(np.uint16)
            if len(digit) and (digit != digit[0]).any():
                order = order[np.argsort(digit[order], kind="stable")]
    return order


def runs(keys: np.ndarray) -> np.ndarray:
    """Where a new key begins in sorted keys."""
    first = np.ones(len(keys), bool)
    first[1:] = (keys[1:] != keys[:-1]).any(axis=1)
    return np.flatnonzero(first)


def windows(seq: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``n`` ids without a break (0) among them, and the ids, a row each."""
    if len(seq) < n:
        return np.zeros(0, np.int64), np.zeros((0, n), np.uint32)
    view = np.lib.stride_tricks.sliding_window_view(seq, n)
    whole = seq[n - 1 :] != 0
    for k in range(n - 1):
        whole = whole & (seq[k : len(seq) - n + 1 + k] != 0)
    at = np.flatnonzero(whole)
    return at, np.ascontiguousarray(view[at])


def counted(seq: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams in order, and how often each occurs."""
    keys = windows(seq, n)[1]
    keys = keys[radix_order(keys)]
    start = runs(keys)
    return keys[start], np.diff(np.append(start, len(keys))).astype("<u4")


def broken(seq: np.ndarray, n: int, good: np.ndarray) -> np.ndarray:
    """The ids with a break wherever an n-gram isn't good (``good``: by distinct n-gram in order); stretches of fewer than n + 1 ids go."""
    at, keys = windows(seq, n)
    order = radix_order(keys)
    first = np.zeros(len(keys), np.int64)
    first[runs(keys[order])] = 1
    fine = np.zeros(len(keys), bool)
    fine[order] = good[np.cumsum(first) - 1]
    at = at[fine]
    if not len(at):
        return np.zeros(0, np.uint32)
    start = np.flatnonzero(np.append(True, np.diff(at) != 1))
    size = np.diff(np.append(start, len(at)))
    start, size = at[start[size > 1]], size[size > 1] + n  # ids of each stretch, and the break after them
    if not len(size):
        return np.zeros(0, np.uint32)
    end = np.cumsum(size)
    place = np.arange(end[-1]) - np.repeat(end - size, size) + np.repeat(start, size)
    out = seq[np.minimum(place, len(seq) - 1)].copy()
    out[end - 1] = 0
    return out


def read(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """Portions: ``portion``, ``lang``, distinct ``words`` with their ``counts``, ``seq``: places of words from 1 on, 0 ends a piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, k = TaskContext.get().partitionId(), 0
        for batch in gathered(batches, 1, PORTION_BYTES):
            langs = batch.column(0).dictionary_encode()
            for code, name in enumerate(langs.dictionary.to_pylist()):
                texts = batch.column(1).take(pa.array(np.flatnonzero(langs.indices.to_numpy() == code))).to_pylist()
                places = Places()
                places[MARK] = 0
                cut = ((t + MARK).translate(CLEAN).replace(MARK, b" . ").split() for t in texts)  # the mark ends each text too
                seq = np.fromiter(map(places.__getitem__, chain.from_iterable(cut)), "<u4")
                del places[MARK]
                words = [w.decode() for w in places]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([task << 32 | k]), pa.array([name]), pa.array([words], pa.list_(pa.string())), pa.array([np.bincount(seq, minlength=len(words) + 1)[1:]], pa.list_(pa.int64())), pa.array([packed(seq)], pa.binary())],
                    names=["portion", "lang", "words", "counts", "seq"],
                )
                k += 1

    ready(docs.sparkSession)
    rows = docs.select(F.coalesce(docs[lang].cast("string"), F.lit("und")).alias("lang"), text_bytes(text).alias("data"))
    return rows.mapInArrow(run, "portion bigint, lang string, words array<string>, counts array<bigint>, seq binary")


def numbered(words: DataFrame) -> DataFrame:
    """``id``: dense from 1 on, by the rows of each written part of the table and the parts before it."""
    rows = written(words.withColumn("at", F.monotonically_increasing_id()))
    part = F.shiftright("at", 33)
    sizes = rows.groupBy(part.alias("part")).count()  # a row for each task that wrote
    before = sizes.select("part", (F.sum("count").over(Window.orderBy("part")) - F.col("count")).alias("before"))
    return written(rows.join(F.broadcast(before), part == F.col("part")).withColumn("id", F.col("before") + F.col("at").bitwiseAND((1 << 33) - 1) + 1).drop("at", "part", "before"))


LEVEL = "portion bigint, lang string, seq binary, size bigint, keys binary, counts binary, sample array<binary>"


def level_row(portion: int, lang: str, seq: np.ndarray, n: int) -> pa.Table:
    """A portion's row: its ids and its distinct n-grams in order."""
    keys, counts = counted(seq, n)
    big = keys.astype(">u4")
    sample = [big[i].tobytes() for i in np.unique(np.linspace(0, len(keys) - 1, SAMPLE_KEYS).astype(int))] if len(keys) else []
    return pa.table(
        [pa.array([portion]), pa.array([lang]), pa.array([packed(seq)], pa.binary()), pa.array([len(keys)]), pa.array([packed(keys.T)], pa.binary()), pa.array([packed(counts)], pa.binary()), pa.array([sample], pa.list_(pa.binary()))],
        names=["portion", "lang", "seq", "size", "keys", "counts", "sample"],
    )


def in_ids(parts: DataFrame, ids: DataFrame) -> DataFrame:
    """Level 2: the portions in ids of frequent words (``ids``: part, place, id), with their bigrams."""

    def run(part: pa.Table, found: pa.Table) -> pa.Table:
        if not part.num_rows or not found.num_rows:
            return level_row(0, "", np.zeros(0, np.uint32), 2).slice(0, 0)
        id_of = np.zeros(part.column("n_words")[0].as_py() + 1, np.uint32)
        id_of[found.column("place").to_numpy() + 1] = found.column("id").to_numpy()
        seq = id_of[unpacked(part.column("seq")[0].as_py(), "<u4")]
        return level_row(part.column("portion")[0].as_py(), part.column("lang")[0].as_py(), seq, 2)

    left = parts.select("portion", "lang", F.size("words").alias("n_words"), "seq")
    return left.groupBy("portion").cogroup(ids.groupBy("part")).applyInArrow(run, LEVEL)


def next_level(level: DataFrame, frequent: DataFrame, n: int) -> DataFrame:
    """Level n + 1 from level n and the marks of its frequent n-grams."""

    def run(part: pa.Table, marks: pa.Table) -> pa.Table:
        if not part.num_rows or not marks.num_rows:
            return level_row(0, "", np.zeros(0, np.uint32), n + 1).slice(0, 0)
        good = np.zeros(part.column("size")[0].as_py(), bool)
        for start, size, bits in zip(*(marks.column(c).to_pylist() for c in ("start", "size", "marks")), strict=True):
            good[start : start + size] = np.unpackbits(np.frombuffer(bits, np.uint8), count=size)
        seq = broken(unpacked(part.column("seq")[0].as_py(), "<u4"), n, good)
        return level_row(part.column("portion")[0].as_py(), part.column("lang")[0].as_py(), seq, n + 1)

    left = level.select("portion", "lang", "seq", "size")
    return left.groupBy("portion").cogroup(frequent.groupBy("portion")).applyInArrow(run, LEVEL)


def borders(level: DataFrame) -> list[bytes]:
    """First keys of all ranges but the first, from the sampled keys of at most ``SAMPLED`` portions."""
    total = level.agg(F.sum("size")).first()[0] or 0
    some = level.where(F.size("sample") > 0).select("portion", "sample").orderBy(F.xxhash64("portion")).limit(SAMPLED)
    keys = sorted(r[0] for r in some.select(F.explode("sample")).collect())
    n = min(-(-total // RANGE_KEYS), len(keys))
    return sorted({keys[len(keys) * i // n] for i in range(1, n)}) if n > 1 else []


def totals(level: DataFrame, n: int, least: int) -> DataFrame:
    """Frequent n-grams (``lang``, ``hi``, ``lo``: the key's ids two by two, ``f``) and, for each portion, marks of those among its own."""
    at = borders(level)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for portion, lang, keys, counts in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                rows, counts = unpacked(keys, "<u4").reshape(n, -1).T, unpacked(counts, "<u4")
                if not len(rows):
                    continue
                ends = [0, *places(rows), len(rows)]
                for k, (s, e) in enumerate(zip(ends[:-1], ends[1:], strict=True)):
                    if e > s:
                        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (k, portion, lang, s, packed(rows[s:e].T), packed(counts[s:e]))], names=["range", "portion", "lang", "start", "keys", "counts"])

    def places(rows: np.ndarray) -> list[int]:
        """Where the ranges begin among sorted keys: by the first two ids, then the others among equals of these."""
        hi = rows[:, 0].astype(np.uint64) << np.uint64(32) | rows[:, 1]
        lo = (rows[:, 2].astype(np.uint64) << np.uint64(32) | (rows[:, 3] if n > 3 else np.uint32(0))) if n > 2 else np.zeros(len(rows), np.uint64)
        out = []
        for first in at:
            ids = first + b"\0" * (16 - len(first))
            a, b = (np.uint64(int.from_bytes(ids[k : k + 8], "big")) for k in (0, 8))
            s, e = np.searchsorted(hi, a, "left"), np.searchsorted(hi, a, "right")
            out.append(int(s + np.searchsorted(lo[s:e], b, "left")))
        return out

    def count(table: pa.Table) -> pa.Table:
        parts = [unpacked(x, "<u4").reshape(n, -1).T for x in table.column("keys").to_pylist()]
        size = np.array(list(map(len, parts)))
        keys = np.concatenate(parts)
        held = np.concatenate([unpacked(x, "<u4") for x in table.column("counts").to_pylist()]).astype(np.int64)
        order = radix_order(keys)
        start = runs(keys[order])
        f = np.add.reduceat(held[order], start)
        enough = f >= least
        good = np.zeros(len(keys), bool)
        good[order] = np.repeat(enough, np.diff(np.append(start, len(keys))))
        where = order[start[enough]]  # a row of each frequent key
        ids = np.column_stack([keys[where].astype(np.int64), np.zeros((len(where), LONGEST - n), np.int64)])
        lang = table.column("lang").combine_chunks().take(pa.array(np.searchsorted(np.cumsum(size), where, "right")))
        found = pa.table({"portion": pa.nulls(len(where), pa.int64()), "start": pa.nulls(len(where), pa.int64()), "size": pa.nulls(len(where), pa.int64()), "marks": pa.nulls(len(where), pa.binary()), "lang": lang, "hi": ids[:, 0] << 32 | ids[:, 1], "lo": ids[:, 2] << 32 | ids[:, 3], "f": f[enough]})
        end = np.cumsum(size)
        own = [k for k in range(len(parts)) if n < LONGEST and good[end[k] - size[k] : end[k]].any()]
        bits = [np.packbits(good[end[k] - size[k] : end[k]]).tobytes() for k in own]
        own = pa.array(own, pa.int64())
        back = pa.table({"portion": table.column("portion").combine_chunks().take(own), "start": table.column("start").combine_chunks().take(own), "size": pa.array(size).take(own), "marks": pa.array(bits, pa.binary())})
        return pa.concat_tables([found, back.append_column("lang", pa.nulls(len(own), pa.string())).append_column("hi", none := pa.nulls(len(own), pa.int64())).append_column("lo", none).append_column("f", none)])

    pieces = level.select("portion", "lang", "keys", "counts").mapInArrow(cut, "range bigint, portion bigint, lang string, start bigint, keys binary, counts binary")
    return written(pieces.groupBy("range").applyInArrow(count, "portion bigint, start bigint, size bigint, marks binary, lang string, hi bigint, lo bigint, f bigint"))


def wide(x: Column) -> Column:
    return x.cast("decimal(19,0)")


def joined(*ids: Column) -> tuple[Column, Column]:
    """Both halves of a key of up to four ids."""
    ids = [*ids, *[F.lit(0).cast("long")] * (LONGEST - len(ids))]
    return tuple(F.shiftleft(ids[k], 32).bitwiseOR(ids[k + 1]) for k in (0, 2))


def scored(found: DataFrame, words: DataFrame) -> DataFrame:
    """Candidates left after the longer ones were heard: ``lang``, ``ids``, ``a``, ``l``, ``r``, ``score``."""
    low = 0xFFFFFFFF
    ids = F.filter(F.array(F.shiftrightunsigned("hi", 32), F.col("hi").bitwiseAND(low), F.shiftrightunsigned("lo", 32), F.col("lo").bitwiseAND(low)), lambda x: x > 0)
    key = lambda x: F.struct(*(c.alias(n) for c, n in zip(joined(*x), ("hi", "lo"), strict=True)))
    part = lambda c, s, n: [F.coalesce(F.get(c, F.lit(s + k)), F.lit(0).cast("long")) if k < n else F.lit(0).cast("long") for k in range(LONGEST)]
    counts = words.select(F.shiftleft("id", 32).alias("hi"), F.lit(0).cast("long").alias("lo"), F.col("n").alias("f")).unionByName(found.select("hi", "lo", "f"))
    cand = found.select("lang", "hi", "lo", F.col("f").alias("a"), ids.alias("ids"))
    size = F.size("ids")

    def inner(start: int) -> Column:
        """The key of all words but one: the last (0) or the first (1)."""
        return F.when(size == 3, key(part(F.col("ids"), start, 2))).otherwise(key(part(F.col("ids"), start, 3)))

    longer = cand.where(size > 2).select("a", F.explode(F.array(inner(0), inner(1))).alias("k")).groupBy(F.col("k.hi").alias("hi"), F.col("k.lo").alias("lo")).agg(F.max("a").alias("longer"))
    left = cand.join(longer, ["hi", "lo"], "left").where(F.col("longer").isNull() | (wide(F.col("longer")) * 100 < wide(F.col("a")) * 80))

    def cut(k: int) -> Column:
        rest = F.when(size == k + 1, key(part(F.col("ids"), k, 1)))
        for n in range(2, LONGEST - k + 1):
            rest = rest.when(size == k + n, key(part(F.col("ids"), k, n)))
        return F.struct(F.lit(k).alias("k"), key(part(F.col("ids"), 0, k)).alias("left"), rest.alias("right"))

    cuts = left.select("lang", "hi", "lo", "ids", "a", F.explode(F.filter(F.array(*map(cut, range(1, LONGEST))), lambda c: c["k"] < size)).alias("c"))
    flat = cuts.select("lang", "hi", "lo", "ids", "a", "c.k", F.col("c.left.hi").alias("lh"), F.col("c.left.lo").alias("ll"), F.col("c.right.hi").alias("rh"), F.col("c.right.lo").alias("rl"))
    both = flat.join(counts.select(F.col("hi").alias("lh"), F.col("lo").alias("ll"), F.col("f").alias("l")), ["lh", "ll"]).join(counts.select(F.col("hi").alias("rh"), F.col("lo").alias("rl"), F.col("f").alias("r")), ["rh", "rl"])
    score = F.expr("(CAST(2000000 AS DECIMAL(7, 0)) * CAST(a AS DECIMAL(19, 0))) div (CAST(l AS DECIMAL(19, 0)) + CAST(r AS DECIMAL(19, 0)))")
    worst = both.select("lang", "hi", "lo", "ids", "a", F.struct(score.alias("score"), "k", "l", "r").alias("cut")).groupBy("hi", "lo").agg(F.min("cut").alias("cut"), F.first("lang").alias("lang"), F.first("ids").alias("ids"), F.first("a").alias("a"))
    return worst.select("lang", "hi", "lo", "ids", "a", "cut.l", "cut.r", "cut.score")


def collocations(docs: DataFrame, *, least: int = 30, top: int = 2000, text: str = "text", lang: str = "lang") -> DataFrame:
    """``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``: the first ``top`` phrases of each language."""
    parts = written(read(docs, text, lang))
    listed = parts.select("portion", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("place", "w")).select("portion", "lang", "place", F.col("w.words").alias("word"), F.col("w.counts").alias("c"))
    words = numbered(listed.groupBy("lang", "word").agg(F.sum("c").alias("n")).where(F.col("n") >= least))
    if (words.agg(F.max("id")).first()[0] or 0) >= 1 << 32:
        raise ValueError("more frequent words than 32-bit ids")
    all_words = parts.select("lang", F.aggregate("counts", F.lit(0).cast("long"), lambda s, x: s + x).alias("n")).groupBy("lang").agg(F.sum("n").alias("n"))
    level = written(in_ids(parts, listed.join(words.select("lang", "word", "id"), ["lang", "word"]).select(F.col("portion").alias("part"), "place", "id")))
    every = []
    for n in range(2, LONGEST + 1):
        found = totals(level, n, least)
        every.append(found.where("f IS NOT NULL").select("lang", "hi", "lo", "f"))
        if n < LONGEST:
            level = written(next_level(level, found.where("marks IS NOT NULL").select("portion", "start", "size", "marks"), n))
    found = every[0].unionByName(every[1]).unionByName(every[2])
    by = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    near = written(scored(found, words).withColumn("place", F.rank().over(by)).where(F.col("place") <= top))  # ties of the last place too
    spelt = near.select("hi", "lo", F.posexplode("ids").alias("pos", "id")).join(words.select("id", "word"), "id").groupBy("hi", "lo").agg(F.array_sort(F.collect_list(F.struct("pos", "word"))).alias("w"))  # four words at most
    phrase = F.array_join(F.transform("w", lambda x: x["word"]), " ")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    rows = near.join(spelt, ["hi", "lo"]).select("lang", phrase.alias("phrase"), "a", "l", "r", "score").withColumn("rank", rank.cast("long")).where(F.col("rank") <= top)
    return rows.join(all_words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def oracle(least: int = 30, top: int = 2000) -> str:
    """The same in DuckDB's SQL."""
    grams = " UNION ALL ".join(f"SELECT lang, array_to_string(w[i:i + {n - 1}], ' ') AS phrase, {n} AS size FROM (SELECT lang, w, unnest(range(1, len(w) - {n - 2})) AS i FROM pieces WHERE len(w) >= {n})" for n in range(1, LONGEST + 1))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
    WITH pieces AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(text, '{upper}', '{lower}'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents WHERE text IS NOT NULL)),
    f AS (SELECT lang, phrase, size, count(*) AS a FROM ({grams}) GROUP BY ALL),
    totals AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE size = 1 GROUP BY lang),
    cand AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND a >= {least}),
    inner_ AS (SELECT c.lang, array_to_string(c.w[s:s + k - 1], ' ') AS phrase, max(c.a) AS longer FROM cand c, unnest(range(2, 4)) AS t(k), unnest(range(1, 4)) AS u(s) WHERE k < c.size AND s + k - 1 <= c.size GROUP BY ALL),
    kept AS (SELECT c.* FROM cand c LEFT JOIN inner_ i ON c.lang = i.lang AND c.phrase = i.phrase WHERE i.longer IS NULL OR 100::HUGEINT * i.longer < 80::HUGEINT * c.a),
    cuts AS (SELECT c.lang, c.phrase, c.a, k, l.a AS l, r.a AS r, (2000000::HUGEINT * c.a // (l.a + r.a))::BIGINT AS score
             FROM (SELECT *, unnest(range(1, size)) AS k FROM kept) c
             JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:k], ' ') JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[k + 1:c.size], ' ')),
    worst AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
    ranked AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase COLLATE "binary") AS rank, phrase, a, l, r, score FROM worst)
    SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= {top}
    """
