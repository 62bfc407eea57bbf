"""Language-model scores from a subword lattice: the marginal probability of a text over all its segmentations.

The pieces and their scores come from an existing sentencepiece vocabulary. A word is spelled by every path of
pieces through its characters (a leading mark, then the word; any character also by its UTF-8 bytes), and a forward
recursion in log space adds the paths up. Words are independent given their borders, so a document's log probability is
the sum over its words and one end token. Nothing else makes up the score: a word met in training has no other path than one not met.

A piece's weight comes from the vocabulary's score and from the corpus. The scores of a vocabulary of merges are ranks, which stand for
probabilities in proportion to 1 / (rank + 10), after Zipf. Expectation maximisation over all words of the training documents, each as often as it
occurs, then moves the weights; in every round the vocabulary's own probabilities count as ``PRIOR`` of all uses, so a piece
that the corpus lacks keeps its standing. Beside it stands the base score: add-one word frequencies of the training documents.

Pieces and the end token have probabilities that add up to one, and every text is the end of different paths, so the probabilities of all
texts add up to one at most. A text's own mark characters (U+2581) are spelled by bytes only, as a piece's mark means the border of a word.

Words are counted by partial counts in the tasks and one shuffle. Counts of the ``FREQUENT`` most frequent words go to the
workers (a bound on what is sent) for the base score; all other words of a document are joined to the whole count table.

Defined results: null and empty texts hold the end token alone; repeated rows count and are scored each; without
training documents all counts are zero and the pieces keep the vocabulary's weights. In fitting as in scoring, every word is whole, however long.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import portions, ready, remainder, slices, sole, text_bytes, utf8, written

FREQUENT = 150_000
CACHED_WORDS = 500_000
HELD_WORDS = 300_000
#: Longer words are taken one at a time, so many places at once.
LONG_WORD, BLOCK = 48, 8192
#: Stands for the end token among words, which hold no white space.
END = b"\n"
MARK = "▁"
#: What stands for a text's own mark character: above all characters, so that no piece has it.
OWN_MARK = 0x110000
PRIOR = 0.1


class Pieces:
    """The pieces of a vocabulary file as a trie whose edges are found by binary search."""

    def __init__(self, path: str):
        import sentencepiece

        lib = sentencepiece.SentencePieceProcessor(model_file=path)
        size = lib.get_piece_size()
        self.end = lib.eos_id()
        self.byte_id = np.full(256, -1)
        merit = np.full(size + 256, 1e6)
        children: list[dict[int, int]] = [{}]
        final = [-1]
        for i in range(size):
            piece = lib.id_to_piece(i)
            if lib.is_byte(i):
                self.byte_id[int(piece[3:5], 16)] = i
            elif not (lib.is_control(i) or lib.is_unknown(i) or lib.is_unused(i)):
                merit[i] = min(-lib.get_score(i), 1e6)
                node = 0
                for c in piece:
                    code = ord(c)
                    if code not in children[node]:
                        children[node][code] = len(children)
                        children.append({})
                        final.append(-1)
                    node = children[node][code]
                final[node] = i
        for b in np.flatnonzero(self.byte_id < 0):  # a vocabulary without byte pieces gets them
            self.byte_id[b] = size + b
        self.size = size + 256
        self.final = np.array(final)
        edges = sorted((n << 21 | c, to) for n, kids in enumerate(children) for c, to in kids.items())
        self.edge, self.target = np.array([e for e, _ in edges]), np.array([t for _, t in edges])
        weight = 1 / (merit + 10)
        weight[self.end] = weight.max()
        self.first = np.log(weight / weight.sum())

    def arcs(self, chars: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """From, to and piece of every piece that fits; ``start``: characters' positions, ``end``: their words' ends."""
        out, at, node, stop = [], start, np.zeros(len(start), np.int64), end
        begin = start
        while len(at):
            code = node << 21 | chars[at]
            place = np.minimum(np.searchsorted(self.edge, code), len(self.edge) - 1)
            found = self.edge[place] == code
            begin, at, stop, node = begin[found], at[found] + 1, stop[found], self.target[place[found]]
            piece = self.final[node]
            ends = piece >= 0
            out.append((begin[ends], at[ends], piece[ends]))
            on = at < stop
            begin, at, stop, node = begin[on], at[on], stop[on], node[on]
        return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 3


_LOADED: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    sole(__name__, _LOADED, _SCORED)
    if path not in _LOADED:
        _LOADED[path] = Pieces(path)
    return _LOADED[path]


def codes_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Characters of marked words, one after the other, and the words' lengths."""
    n = np.array([len(w) + 1 for w in words])
    chars = np.frombuffer("".join(MARK + w for w in words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    own = chars == ord(MARK)
    own[np.cumsum(n) - n] = False
    chars[own] = OWN_MARK
    return chars, n


def bytes_of(code: int) -> list[int]:
    return list((MARK if code == OWN_MARK else chr(code)).encode("utf-8", "replace"))


def added(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Log of the sum of exponentials of each run of values that begins at ``first``."""
    top = np.maximum.reduceat(values, first)
    runs = np.diff(np.append(first, len(values)))
    with np.errstate(invalid="ignore", divide="ignore"):
        return np.where(np.isneginf(top), -np.inf, top + np.log(np.add.reduceat(np.exp(values - np.repeat(np.where(np.isneginf(top), 0, top), runs)), first)))


class Lattice:
    """Words side by side: a node for each place between characters, an arc for each piece."""

    def __init__(self, vocab: Pieces, weight: np.ndarray, words: list[str]):
        chars, n = codes_of(words)
        word_end = np.cumsum(n)
        self.origin = np.concatenate([[0], np.cumsum(n + 1)[:-1]])  # each word has a node more than characters
        self.goal = self.origin + n
        owner = np.repeat(np.arange(len(n)), n)
        a, b, piece = vocab.arcs(chars, np.arange(len(chars)), word_end[owner])
        single = np.arange(len(chars))
        # the arc of a character's bytes: one arc, numbered after the pieces by the character
        kinds, kind = np.unique(chars, return_inverse=True)
        self.spelled = [[int(vocab.byte_id[x]) for x in bytes_of(c)] for c in kinds.tolist()]
        raw = np.array([weight[s].sum() for s in self.spelled]) if len(kinds) else np.zeros(0)
        self.size = vocab.size
        who = np.concatenate([owner[a], owner])
        self.source, self.target = np.concatenate([a, single]) + who, np.concatenate([b, single + 1]) + who
        self.piece = np.concatenate([piece, self.size + kind])
        self.weight = np.concatenate([weight[piece], raw[kind]])
        self.base, self.nodes, self.longest = self.origin[who], int(len(chars) + len(n)), int(n.max(initial=0))

    def sweep(self, of: np.ndarray, to: np.ndarray, begin: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Log sums over all paths from ``begin`` to each node, in the order of ``place`` (of the node reached)."""
        score = np.full(self.nodes, -np.inf)
        score[begin] = 0.0
        order = np.lexsort((to, place))
        of, to, weight, place = of[order], to[order], self.weight[order], place[order]
        cut = np.flatnonzero(np.diff(place, prepend=-1)).tolist()
        for i, j in zip(cut, [*cut[1:], len(place)], strict=True):
            first = np.flatnonzero(np.diff(to[i:j], prepend=-1))
            score[to[i:j][first]] = added(score[of[i:j]] + weight[i:j], first)
        return score

    def forward(self) -> np.ndarray:
        self.alpha = self.sweep(self.source, self.target, self.origin, self.target - self.base)
        return self.alpha[self.goal]

    def expected(self, counts: np.ndarray) -> np.ndarray:
        """Expected uses of every piece, each word as often as it counts."""
        total = self.forward()
        beta = self.sweep(self.target, self.source, self.goal, self.longest - (self.source - self.base))
        who = np.searchsorted(self.origin, self.source, "right") - 1
        share = np.exp(self.alpha[self.source] + self.weight + beta[self.target] - total[who]) * counts[who]
        uses = np.bincount(self.piece, share, minlength=self.size + len(self.spelled))
        out = uses[: self.size].copy()
        for spelled, n in zip(self.spelled, uses[self.size :].tolist(), strict=True):
            np.add.at(out, spelled, n)
        return out


def marginals(vocab: Pieces, weight: np.ndarray, words: list[bytes]) -> np.ndarray:
    """Natural log probability of each word over all segmentations."""
    out = np.zeros(len(words))
    texts = [utf8(w) for w in words]
    order = np.argsort([len(t) for t in texts], kind="stable")
    for at in range(0, len(order), 4096):
        some = order[at : at + 4096]
        short = [k for k in some.tolist() if len(texts[k]) <= LONG_WORD]
        if short:
            out[short] = Lattice(vocab, weight, [texts[k] for k in short]).forward()
        for k in some.tolist():
            if len(texts[k]) > LONG_WORD:
                out[k] = long_word(vocab, weight, texts[k])
    return out


def block_arcs(vocab: Pieces, chars: np.ndarray, at: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Arcs from the ``BLOCK`` places from ``at`` on, by place: where each place's begin and end, what they reach, their pieces."""
    start = np.arange(at, min(at + BLOCK, len(chars)))
    a, b, piece = vocab.arcs(chars, start, np.full(len(start), len(chars)))
    order = np.argsort(a, kind="stable")
    return np.searchsorted(a[order], np.arange(at, start[-1] + 2)), b[order], piece[order]


def long_forward(vocab: Pieces, weight: np.ndarray, chars: np.ndarray) -> np.ndarray:
    """The forward recursion for one word of any length, in blocks whose arcs fit in memory: the log sum of all paths to each place."""
    score = np.full(len(chars) + 1, -np.inf)
    score[0] = 0.0
    for at in range(0, len(chars), BLOCK):
        cut, to, piece = block_arcs(vocab, chars, at)
        w = weight[piece]
        for k, c in enumerate(chars[at : at + BLOCK].tolist()):
            i, raw = at + k, weight[vocab.byte_id[bytes_of(c)]].sum()
            score[i + 1] = np.logaddexp(score[i + 1], score[i] + raw)
            t = to[cut[k] : cut[k + 1]]  # one arc to a place at most
            score[t] = np.logaddexp(score[t], score[i] + w[cut[k] : cut[k + 1]])
    return score


def long_word(vocab: Pieces, weight: np.ndarray, word: str) -> float:
    """Natural log probability of one word of any length."""
    return float(long_forward(vocab, weight, codes_of([word])[0])[-1])


def long_uses(vocab: Pieces, weight: np.ndarray, word: str) -> np.ndarray:
    """Expected uses of every piece in one word of any length: the forward recursion, then blocks from the end backwards."""
    chars = codes_of([word])[0]
    alpha, beta, uses = long_forward(vocab, weight, chars), np.full(len(chars) + 1, -np.inf), np.zeros(vocab.size)
    beta[-1], total = 0.0, alpha[-1]
    for at in reversed(range(0, len(chars), BLOCK)):
        cut, to, piece = block_arcs(vocab, chars, at)
        w = weight[piece]
        block = chars[at : at + BLOCK].tolist()
        for k in reversed(range(len(block))):
            i, spelled = at + k, vocab.byte_id[bytes_of(block[k])]
            ways = np.append(w[cut[k] : cut[k + 1]] + beta[to[cut[k] : cut[k + 1]]], weight[spelled].sum() + beta[i + 1])
            beta[i] = np.logaddexp.reduce(ways)
            share = np.exp(alpha[i] + ways - total)
            np.add.at(uses, piece[cut[k] : cut[k + 1]], share[:-1])
            np.add.at(uses, spelled, share[-1])
    return uses


def tokens(data: bytes) -> list[bytes]:
    return data.lower().split()


def word_counts(docs: DataFrame) -> DataFrame:
    """``word`` binary, ``n`` long over all rows, the end token among them; ``docs``: a column ``data``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def out() -> Iterator[pa.RecordBatch]:
            words = list(held)
            for at in range(0, len(words), 50_000):
                some = words[at : at + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array(some, pa.binary()), pa.array([held[w] for w in some], pa.int64())], names=["word", "n"])
            held.clear()

        for batch in portions(batches, 0):
            held.update(chain.from_iterable(map(tokens, batch.column(0).to_pylist())))
            held[END] += batch.num_rows
            if len(held) > HELD_WORDS:
                yield from out()
        yield from out()

    return docs.select("data").mapInArrow(run, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def refit(counts: DataFrame, path: str, rounds: int = 2) -> np.ndarray:
    """Log weights of the pieces after rounds of expectation maximisation over the counted words, each as often as it counts.

    What a round sends to the driver is one number for each piece of the vocabulary, whatever the corpus.
    """
    spark = counts.sparkSession
    vocab = pieces(path)
    weight = vocab.first
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(weight)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            own, total = pieces(path), None
            for batch in slices(batches, 4096):
                total = np.zeros(own.size) if total is None else total
                short = []
                for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    if word == END:
                        total[own.end] += n
                    elif len(w := utf8(word)) > LONG_WORD:
                        total += n * long_uses(own, shared.value, w)
                    else:
                        short.append((w, n))
                if short:
                    short.sort(key=lambda x: len(x[0]))
                    total += Lattice(own, shared.value, [w for w, _ in short]).expected(np.array([n for _, n in short], np.float64))
            if total is not None:
                used = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["piece", "uses"])

        uses = np.zeros(vocab.size)
        for r in counts.select("word", "n").mapInArrow(run, "piece bigint, uses double").groupBy("piece").agg(F.sum("uses").alias("uses")).collect():
            uses[r.piece] = r.uses
        if not uses.any():
            return weight
        weight = posterior(vocab, uses)
    return weight


def posterior(vocab: Pieces, uses: np.ndarray) -> np.ndarray:
    """Log weights from expected uses and the vocabulary's own probabilities."""
    return np.log((1 - PRIOR) * uses / uses.sum() + PRIOR * np.exp(vocab.first))


def frequent_from(counts: DataFrame, most: int) -> int:
    """The least count such that ``most`` words at most have it or more; what comes to the driver is a row for each of the
    counts from which at least a word has it, cut to those that matter."""
    by_count = counts.groupBy("n").agg(F.count("*").alias("words")).orderBy(F.desc("n")).limit(most).collect()
    held, least = 0, None
    for r in by_count:
        held += r.words
        if held > most:
            return least or r.n + 1
        least = r.n
    return 1 if len(by_count) < most else least


#: By model: log weights of the words met so far in this process.
_SCORED: dict[str, dict[bytes, float]] = {}


def scores(docs: DataFrame, path: str, *, training: Column, held_out: Column, rounds: int = 2, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score`` (log10) of every row.

    ``training``: which rows the counts and weights are learned from.
    """
    spark = docs.sparkSession
    ready(spark)
    counts = written(word_counts(docs.where(training).select(text_bytes(text).alias("data"))))
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    weight = refit(counts, path, rounds)
    least = frequent_from(counts, FREQUENT)
    frequent = {bytes(r.word): r.n for r in counts.where(F.col("n") >= least).collect()}
    if END not in frequent and total:
        frequent[END] = counts.where(F.col("word") == F.lit(bytearray(END))).first().n
    floor = float(np.log10(total + 1.0 * (distinct + 1)))
    whole = least <= 1
    shared = spark.sparkContext.broadcast((frequent, weight))
    model = f"{path}:{zlib.crc32(weight.tobytes())}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted, weight = shared.value
        vocab = pieces(path)
        if model not in _SCORED:
            _SCORED.clear()
            _SCORED[model] = {}
        end_score = float(weight[vocab.end] / np.log(10))
        end_base, end_seen = float(np.log10(counted.get(END, 0) + 1)), END in counted
        for batch in portions(batches, 2):
            known = _SCORED[model]
            if len(known) > CACHED_WORDS:  # what came first is the more frequent half
                known = _SCORED[model] = dict(islice(known.items(), CACHED_WORDS // 2))
            cut = [tokens(t) for t in batch.column(2).to_pylist()]
            sizes = np.array([len(w) for w in cut])
            here = dict.fromkeys(chain.from_iterable(cut))  # each word of these texts once
            words = list(here)
            here.update(zip(words, range(len(words)), strict=True))
            got = list(map(known.get, words))
            gaps = [k for k, x in enumerate(got) if x is None]
            new = [words[k] for k in gaps]
            for k, w, x in zip(gaps, new, marginals(vocab, weight, new).tolist(), strict=True):
                got[k] = known[w] = x
            at = np.fromiter(map(here.__getitem__, chain.from_iterable(cut)), np.int64, int(sizes.sum()))
            who = np.repeat(np.arange(len(cut)), sizes)
            n_of = np.array([counted.get(w, 0) for w in words], np.float64)
            spelled = np.array(got, np.float64) / np.log(10)
            base, seen = np.log10(n_of + 1)[at], (n_of > 0)[at]
            sums = lambda x, n=len(cut): np.bincount(who, x, minlength=n)
            score = sums(spelled[at]) + end_score
            pairs, times = np.unique(who[~seen] * len(words) + at[~seen], return_counts=True) if not whole else (np.zeros(0, np.int64),) * 2
            offsets = np.searchsorted(pairs, np.arange(len(cut) + 1) * max(len(words), 1)).astype(np.int32)
            which = pairs % max(len(words), 1)
            rest = pa.StructArray.from_arrays([pa.array(words, pa.binary()).take(pa.array(which)), pa.array(times.astype(np.int32))], ["word", "n"])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array(sizes + 1, pa.int64()), pa.array(sums(seen).astype(np.int64) + end_seen),
                    pa.array(sums(base) + end_base), pa.array(score), pa.ListArray.from_arrays(pa.array(offsets), rest),
                ],
                names=["key", "held_out", "n_tokens", "seen", "base", "score", "rest"],
            )

    rows = docs.select(F.col(key).alias("key"), held_out.alias("held_out"), text_bytes(text).alias("data"))
    kind = docs.schema[key].dataType.simpleString()
    first = rows.mapInArrow(run, f"key {kind}, held_out boolean, n_tokens bigint, seen bigint, base double, score double, rest array<struct<word: binary, n: int>>")
    final = [F.col("key").alias(key), "held_out", "n_tokens"]
    if whole:  # every counted word went to the workers
        done = first.select(*final, F.col("seen").alias("n_known"), F.lit(int(total)).alias("train_tokens"), (F.col("base") - F.col("n_tokens") * F.lit(floor)).alias("base_score"), "score")
        return done
    first = written(first.withColumn("row", F.monotonically_increasing_id()))
    rare = first.select("row", F.explode("rest").alias("r")).select("row", "r.word", F.col("r.n").alias("k"))
    n = F.coalesce("n", F.lit(0))
    sums = (
        rare.join(counts, "word", "left").groupBy("row")
        .agg(
            F.sum(F.when(n > 0, F.col("k")).otherwise(0)).alias("more_seen"), F.sum(F.col("k") * F.log10(n + 1)).alias("more_base"),
        )
    )
    both = first.drop("rest").join(sums, "row", "left")
    return both.select(
        *final,
        (F.col("seen") + F.coalesce("more_seen", F.lit(0))).alias("n_known"),
        F.lit(int(total)).alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0)) - F.col("n_tokens") * F.lit(floor)).alias("base_score"),
        "score",
    )


def split_by_id(key: str = "doc_id") -> tuple[Column, Column]:
    """Training and held-out rows by the remainder of the id's checksum."""
    out = remainder(key, 7) == 2
    return ~out, out
