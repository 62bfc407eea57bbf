"""Token-id files: frequency-ranked ids in byte-aligned variable-length coding with control bytes apart from data.

The ids of all documents are counted, and each id is replaced with its rank by frequency (ties: the smaller id first).
A rank takes 1 to 4 data bytes; a control byte holds the lengths of four ranks, two bits each. The reader looks lengths
up in a table of 256 rows and gathers the data bytes with numpy, without a loop over tokens.

A folder holds ``ranks/`` (Parquet: id, rank), ``index/`` (Parquet: file, docs, tokens) and one ``NNNNNNNN.tok`` file for each range of ascending document ids,
of ``FILE_TOKENS`` tokens, or of more where that would be above ``MOST_FILES`` files. Files are written and read block by block, so their size takes no memory;
a file is a run of blocks, each ``MAGIC, docs, tokens, data bytes`` (unsigned 32-bit) followed by the doc ids (signed
64-bit), tokens of each document (unsigned 32-bit), control bytes and data bytes.

Defined results: null and empty texts hold the end id alone; repeated rows are all written, those of one id in the order of
their ids' bytes; a null doc_id is written as the least 64-bit integer and read back as null; an empty table writes no file.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from array import array
from collections.abc import Iterator
from itertools import chain, islice
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import portions, ready, shared_dir, slices, sole, text_bytes, utf8, written

MAGIC = 0x314B4F54
BLOCK_TOKENS = 1 << 18
FILE_TOKENS = 6_000_000
MOST_FILES = 16_384
INDEX = "file int, docs bigint, tokens bigint"
CACHED_WORDS = 600_000
PORTION_BYTES = 10 << 20
CACHED_CHARS = 64
NO_ID = np.iinfo(np.int64).min
LETTERS_THEN_MARKS = re.compile(r"([^\W\d_]*[^\W\d_\u0130])([!-&(-/:-@\[-`{-~]+)")
#: The character that stands for each byte in a byte-level vocabulary.
_PLAIN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BYTE_CHARS = {b: b for b in _PLAIN} | {b: 256 + k for k, b in enumerate(sorted(set(range(256)) - set(_PLAIN)))}
#: Words that show whether a vocabulary's model takes words as they are.
PROBES = ("a", "the", "zyxwv", "straße", "çao", "слово", "言葉", "aaaaaaaaaaaaaaaaaaaaaaaaaaaa")
#: Byte length of each of the four ranks of a control byte.
LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.uint8) + 1


class WordIds:
    """Ids by the tokenizers library, kept by word.

    Splitting at spaces and line feeds beforehand changes nothing where the vocabulary's pattern drops white space and
    cuts there: no token, special string or normalisation reaches across. Probes tell whether it does, and whether it
    ignores case; other vocabularies encode whole texts. New words are encoded in one text, parted by
    a control character that is a token of its own; words with that character or a special string are encoded alone.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.lib = Tokenizer.from_file(path)
        self.lib.no_truncation()
        self.lib.no_padding()
        part = self.lib.encode(" \x01 ", add_special_tokens=False).ids
        self.part_id = part[0] if len(part) == 1 else None
        self.marks = tuple(x.content for x in self.lib.get_added_tokens_decoder().values())
        self.kind, self.letter = ("<u2", "H") if self.lib.get_vocab_size() <= 1 << 16 else ("<u4", "I")
        self.odd = ("\x01", *self.marks) if self.part_id is not None else ("",)
        self.words: dict[str, bytes] = {"": b""}
        self.model, self.direct = self.lib.model, True
        self.direct = all(self.by_model(w) == self.alone(w) for w in PROBES)
        self.by_words = all(self.alone(f"{a}{b}") == self.alone(a) + self.alone(b) for a, b in (("some", " words"), ("a \n", "\n the"), ("end", ".,!"), ("THE", "|")))
        self.folds = all(self.alone(w.upper()) == self.alone(w) for w in ("a", "the", "zyxwv"))

    def alone(self, word: str) -> bytes:
        return np.array(self.lib.encode(word, add_special_tokens=False).ids, self.kind).tobytes()

    def by_model(self, word: str) -> bytes:
        """A word of lower-case letters goes to the library's model at once: nothing is left to normalise or to cut."""
        return array(self.letter, [x.id for x in self.model.tokenize(word if word.isascii() else word.encode().decode("latin-1").translate(BYTE_CHARS))]).tobytes()

    def learn(self, words: list[str]) -> dict[str, bytes]:
        plain = [w for w in words if w.isalpha() and (w.isascii() or w.islower() and is_normalized("NFC", w))] if self.direct else []
        out = dict(zip(plain, map(self.by_model, plain), strict=True))
        words = [w for w in words if w not in out]
        for at in range(0, len(words), 64):
            some = words[at : at + 64]
            ids = np.array(self.lib.encode_batch_fast([" \x01 ".join(some)], add_special_tokens=False)[0].ids)
            cuts = np.flatnonzero(ids == self.part_id)
            raw, wide = ids.astype(self.kind).tobytes(), np.dtype(self.kind).itemsize
            starts, ends = [0, *(wide * (cuts + 1)).tolist()], [*(wide * cuts).tolist(), len(raw)]
            out.update((w, raw[a:b]) for w, a, b in zip(some, starts, ends, strict=True))
        return out

    def halves(self, word: str) -> tuple[str, str]:
        """Letters and the ASCII punctuation after them: the pattern cuts there, and A-Z count as a-z.

        Not after U+0130, whose lower case ends in a mark that joins the punctuation.
        """
        letters = word.isalpha()
        if self.folds and word.isascii() or self.folds and letters and not any(c in word for c in "\u0130\u03a3"):  # others depend on their neighbours
            word = word.lower()
        if letters:
            return word, ""
        head = word[:-1]
        if word[-1] in ".,!|" and head.isalpha() and head[-1] != "\u0130":
            return head, word[-1]
        found = LETTERS_THEN_MARKS.fullmatch(word)
        return found.groups() if found else (word, "")

    def encode_bytes(self, texts: list[bytes]) -> list[bytes]:
        """Ids of UTF-8 texts. Where the vocabulary ignores case, A-Z are made small at once, unless that makes a special string."""
        low = [t.lower() for t in texts] if self.folds else texts
        special = [m.encode() for m in self.marks if self.folds]
        return self.encode([utf8(t if any(m in x for m in special) else x) for t, x in zip(texts, low, strict=True)])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text. Each different word of these texts is looked up or encoded once.

        Words met first stay known from one call to the next: they are mostly the frequent ones.
        """
        if not self.by_words:
            return [self.alone(t) for t in texts]
        cut = [t.replace("\n", " ").split(" ") for t in texts]
        known = self.words
        odd = [m for m in self.odd if any(m in t for t in texts)]
        here = dict.fromkeys(chain.from_iterable(cut))
        here.update(zip(here, map(known.get, here), strict=True))
        new = [w for w, ids in here.items() if ids is None]
        halves = [("", "") if len(w) > CACHED_CHARS or odd and any(m in w for m in odd) else self.halves(w) for w in new]
        parts = set(chain.from_iterable(halves))
        learned = self.learn(list(parts.difference(known)))
        learned.update((x, known[x]) for x in parts.intersection(known))
        here.update((w, learned[a] + learned[b] if b else learned[a] if a else self.alone(w)) for w, (a, b) in zip(new, halves, strict=True))
        if (room := CACHED_WORDS - len(known)) > 0:
            known.update(islice(learned.items(), room))
            if len(known) < CACHED_WORDS // 3:  # whole words while the frequent ones come in
                known.update(islice(((w, here[w]) for w, (a, _) in zip(new, halves, strict=True) if a), room // 3))
        return [b"".join(map(here.__getitem__, words)) for words in cut]


_LOADED: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    sole(__name__, _LOADED)
    if path not in _LOADED:
        _LOADED[path] = WordIds(path)
    return _LOADED[path]


def packed(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of unsigned 32-bit values."""
    values = values.astype("<u4")
    size = 1 + (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    codes = np.zeros(-(-len(values) // 4) * 4, np.uint8)
    codes[: len(values)] = size - 1
    control = codes[0::4] | codes[1::4] << 2 | codes[2::4] << 4 | codes[3::4] << 6
    wide = int(size.max(initial=1))
    return control.tobytes(), values.view(np.uint8).reshape(-1, 4)[:, :wide][np.arange(wide) < size[:, None]].tobytes()


def unpacked(control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    """The values again: lengths by table lookup, offsets by a running sum, bytes by gathering."""
    size = LENGTHS[control].ravel()[:n]
    at = np.cumsum(size, dtype=np.int64) - size
    out = data[at].astype(np.uint32)
    for k in (1, 2, 3):
        more = np.flatnonzero(size > k)
        if len(more):
            out[more] |= data[at[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def block(docs: list[int], ranks: list[np.ndarray]) -> bytes:
    control, data = packed(np.concatenate(ranks))
    counts = np.array([len(r) for r in ranks], "<u4")
    head = struct.pack("<4I", MAGIC, len(docs), int(counts.sum()), len(data))
    return head + np.array(docs, "<i8").tobytes() + counts.tobytes() + control + data


def blocks(source) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Doc ids, tokens of each and ranks, block by block from an open file."""
    while head := source.read(16):
        magic, docs, tokens, size = struct.unpack("<4I", head)
        if magic != MAGIC:
            raise ValueError("not a token file")
        ids, counts = np.frombuffer(source.read(8 * docs), "<i8"), np.frombuffer(source.read(4 * docs), "<u4")
        control, data = (np.frombuffer(source.read(n), np.uint8) for n in (-(-tokens // 4), size))
        if len(data) < size:
            raise ValueError("a token file that ends too early")
        yield ids, counts, unpacked(control, data, tokens)


def store_of(path: str):
    """The file system and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def save(path: str, name: str, parts: Iterator[bytes]) -> None:
    """Writes a file whole or not at all: first under a name of this attempt, then renamed."""
    store, top = store_of(path)
    store.create_dir(top, recursive=True)
    task = TaskContext.get()
    trial = f"{top}/.{name}.{task.taskAttemptId() if task else 0}"
    with store.open_output_stream(trial) as out:
        for part in parts:
            out.write(part)
    store.move(trial, f"{top}/{name}")


def tokenised(docs: DataFrame, path: str, *, end_id: int | None = 1, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``doc`` long, ``ids`` binary with the end id appended; and from each task one row with ``counts`` of its ids.

    Ids are 16-bit integers where the vocabulary fits (marked by a leading 2, else 4), which halves the table. Counts are
    64-bit integers by id.
    """
    ready(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_ids(path)
        mark = b"\2" if words.kind == "<u2" else b"\4"
        end = b"" if end_id is None else np.array([end_id], words.kind).tobytes()
        total = np.zeros(0, np.int64)

        def rows(doc: pa.Array, ids: list, counts: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([doc, pa.array(ids, pa.binary()), pa.array(counts, pa.binary())], names=["doc", "ids", "counts"])

        for batch in portions(batches, 1, PORTION_BYTES, 1 << 16):
            ids = [x + end for x in words.encode_bytes(batch.column(1).to_pylist())]
            some = np.bincount(np.frombuffer(b"".join(ids), words.kind), minlength=len(total))
            some[: len(total)] += total
            total = some
            yield rows(batch.column(0), [mark + x for x in ids], [None] * len(ids))
        if total.any():
            yield rows(pa.array([None], pa.int64()), [None], [total.astype("<i8").tobytes()])

    rows = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(int(NO_ID))).alias("doc"), text_bytes(text).alias("data"))
    return rows.mapInArrow(run, "doc bigint, ids binary, counts binary")


def widened(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, "<u2" if raw[:1] == b"\2" else "<u4", offset=1)


def frequencies(tokens: DataFrame) -> DataFrame:
    """``id`` long, ``n`` long over all documents, from the tasks' counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                n = np.frombuffer(raw, "<i8")
                seen = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(n[seen])], names=["id", "n"])

    return tokens.select("counts").where("counts is not null").mapInArrow(run, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))


def write(docs: DataFrame, vocabulary: str, folder: str, *, end_id: int | None = 1, text: str = "text", key: str = "doc_id", file_tokens: int = FILE_TOKENS) -> DataFrame:
    """Writes the token files of a table; returns ``file`` int, ``docs`` long, ``tokens`` long of each.

    Texts are tokenised once into a compact table; files are ranges of ascending ids of about ``file_tokens`` tokens.
    The rank table is bounded by the vocabulary, whatever the corpus.
    """
    spark = docs.sparkSession
    tokens = written(tokenised(docs, vocabulary, end_id=end_id, text=text, key=key))
    counts = sorted(((r.id, r.n) for r in frequencies(tokens).collect()), key=lambda x: (-x[1], x[0]))
    rank_of = np.zeros(max((i for i, _ in counts), default=0) + 1, np.uint32)
    rank_of[[i for i, _ in counts]] = np.arange(len(counts))
    spark.createDataFrame([(int(i), k) for k, (i, _) in enumerate(counts)], "id long, rank long").coalesce(1).write.parquet(f"{folder}/ranks")
    shared = spark.sparkContext.broadcast(rank_of)
    files = min(max(8, -(-sum(n for _, n in counts) // file_tokens)), MOST_FILES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, seen = shared.value, [0, 0]

        def parts() -> Iterator[bytes]:
            docs, held, size = [], [], 0
            for batch in slices(batches):
                for doc, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    docs.append(doc)
                    held.append(ranks[widened(raw)])
                    size += len(held[-1])
                    if size >= BLOCK_TOKENS:
                        seen[:] = seen[0] + len(docs), seen[1] + size
                        yield block(docs, held)
                        docs, held, size = [], [], 0
            if docs:
                seen[:] = seen[0] + len(docs), seen[1] + size
                yield block(docs, held)

        found = parts()
        first = next(found, None)
        if first is None:
            return
        number = TaskContext.get().partitionId()
        save(folder, f"{number:08d}.tok", (x for some in ([first], found) for x in some))
        yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([seen[0]], pa.int64()), pa.array([seen[1]], pa.int64())], names=["file", "docs", "tokens"])

    ordered = tokens.where("counts is null").select("doc", "ids").repartitionByRange(files, "doc").sortWithinPartitions("doc", "ids")
    ordered.mapInArrow(run, INDEX).write.parquet(f"{folder}/index")
    return index(spark, folder)


def index(spark: SparkSession, folder: str) -> DataFrame:
    """``file`` int, ``docs`` long, ``tokens`` long: a row for each file, ``MOST_FILES`` at most."""
    return spark.read.schema(INDEX).parquet(f"{folder}/index")


def read(spark: SparkSession, folder: str, *, crc: bool = True) -> DataFrame:
    """Reads a folder's files back: ``file`` int, ``at`` long (place in the file), ``doc_id``, ``first`` (ids before it in
    the file), ``n_tokens`` long, and ``ids_crc32`` long or else ``ids`` binary.

    One task reads one file, and holds one block of it.
    """
    ready(spark)
    id_of = np.zeros(spark.read.parquet(f"{folder}/ranks").count(), "<u4")
    for r in spark.read.parquet(f"{folder}/ranks").collect():
        id_of[r.rank] = r.id
    shared = spark.sparkContext.broadcast(id_of)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, (store, top) = shared.value, store_of(folder)
        for number in chain.from_iterable(batch.column(0).to_pylist() for batch in batches):
            at = first = 0
            with store.open_input_stream(f"{top}/{number:08d}.tok") as source:
                for docs, counts, ranks in blocks(source):
                    ids = ids_of[ranks].tobytes()
                    ends = np.cumsum(counts.astype(np.int64))
                    view, starts = memoryview(ids), ends - counts
                    each = [view[4 * a : 4 * b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                    last = pa.array([zlib.crc32(x) for x in each], pa.int64()) if crc else pa.array([bytes(x) for x in each], pa.binary())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([number] * len(docs), pa.int32()), pa.array(range(at, at + len(docs)), pa.int64()), pa.array(docs, pa.int64(), mask=docs == NO_ID), pa.array(first + starts, pa.int64()), pa.array(counts.astype(np.int64)), last],
                        names=["file", "at", "doc_id", "first", "n_tokens", "last"],
                    )
                    at, first = at + len(docs), first + int(counts.sum())

    files = index(spark, folder)
    rows = files.select("file").repartitionByRange(max(1, files.count()), "file")
    out = rows.mapInArrow(run, f"file int, at bigint, doc_id bigint, first bigint, n_tokens bigint, last {'bigint' if crc else 'binary'}")
    return out.withColumnRenamed("last", "ids_crc32" if crc else "ids")


def round_trip(docs: DataFrame, vocabulary: str, *, end_id: int | None = 1, folder: str | None = None) -> DataFrame:
    """Writes all texts and reads the files back: ``doc_id``, ``start``, ``n_tokens``, ``ids_crc32``."""
    spark = docs.sparkSession
    folder = folder or shared_dir(spark)
    files = write(docs, vocabulary, folder, end_id=end_id)
    if files.isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    # one task for the sums over files, whose number is bounded
    before = files.select("file", (F.sum("tokens").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))).alias("before"))
    return read(spark, folder).join(before, "file").select("doc_id", (F.coalesce("before", F.lit(0)) + F.col("first")).alias("start"), "n_tokens", "ids_crc32")
