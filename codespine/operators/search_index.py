"""A persisted trigram index of folded descriptions, which prunes the rows that a search has to score.

Records are numbered and kept in blocks of ``1 << BLOCK_BITS`` numbers; for each block and trigram there is one list of the rows that have it,
coded as differences. Lists lie in folders by a hash of their trigram. A search reads the lists of its tokens' trigrams only, keeps rows that have all
trigrams of a token, reads the blocks that hold such rows, and scores these rows as ``search.scored`` does, substring test included: the
result is that of the scan of all records.

Tokens of one or two characters have no trigram and can stand anywhere, so a search with one reads all records. An index
of no records finds nothing. Null descriptions have no trigrams, as they match nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as words
from ..storage import written
from .hierarchy import QueryError
from .search import code_candidate, ranked, scored

BLOCK_BITS = 16
FOLDERS = 32
#: So many rows to score at most are sent to all tasks.
SENT = 1_000_000


def trigrams(folded: Column) -> Column:
    """Distinct runs of three characters."""
    return F.array_distinct(F.regexp_extract_all(folded, F.lit("(?s)(?=(...))"), 1))


def folder(trigram: Column) -> Column:
    return F.pmod(F.xxhash64(trigram), F.lit(FOLDERS)).cast("int")


@dataclass
class Index:
    """Records by block (``block``, ``row``, ...) and posting lists by folder (``folder``, ``trigram``, ``block``, ``steps``)."""

    records: DataFrame
    postings: DataFrame
    folded: str


def build(records: DataFrame, root: str, *, folded: str = "folded") -> Index:
    """Writes records and lists below ``root``. A list is one block's, so no task gathers more than a block's rows for a trigram."""
    number = F.monotonically_increasing_id()
    numbered = records.withColumn("row", number).withColumn("block", F.shiftright("row", BLOCK_BITS))
    kept = written(numbered, f"{root}/records", ["block"])
    pairs = kept.select("block", (F.col("row") - F.shiftleft("block", BLOCK_BITS)).cast("int").alias("place"), F.explode(trigrams(F.col(folded))).alias("trigram"))
    lists = pairs.groupBy("block", "trigram").agg(F.array_sort(F.collect_list("place")).alias("places"))
    steps = F.transform("places", lambda x, k: x - F.when(k > 0, F.get("places", k - 1)).otherwise(0))
    postings = lists.select("block", "trigram", steps.alias("steps"), folder(F.col("trigram")).alias("folder"))
    return Index(kept, written(postings, f"{root}/postings", ["folder"]), folded)


def opened(spark: SparkSession, root: str, *, folded: str = "folded") -> Index:
    return Index(spark.read.parquet(f"{root}/records"), spark.read.parquet(f"{root}/postings"), folded)


def candidates(index: Index, tokens: list[str]) -> DataFrame:
    """``block``, ``row`` of records that have all trigrams of one of the tokens (three characters or more each)."""
    spark = index.postings.sparkSession
    wanted = sorted({(token, token[k : k + 3]) for token in tokens for k in range(len(token) - 2)})
    names = sorted({t for _, t in wanted})
    needed = spark.createDataFrame([(token, t, sum(x == token for x, _ in wanted)) for token, t in wanted], "token string, trigram string, needed int")
    folders = [r[0] for r in spark.createDataFrame([(t,) for t in names], "t string").select(folder(F.col("t"))).distinct().collect()]
    lists = index.postings.where(F.col("folder").isin(folders) & F.col("trigram").isin(names))
    line = Window.partitionBy("trigram", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    places = lists.select("trigram", "block", F.posexplode("steps").alias("at", "step")).select("trigram", "block", F.sum("step").over(line).alias("place"))
    found = places.join(F.broadcast(needed), "trigram")  # the query's own trigrams
    full = found.groupBy("token", "block", "place").agg(F.count("*").alias("n"), F.first("needed").alias("needed")).where("n = needed")
    return full.select("block", (F.shiftleft("block", BLOCK_BITS) + F.col("place")).alias("row")).distinct()


def pruned(index: Index, text: str) -> DataFrame:
    """The records that a search for the text has to score, all its matches among them."""
    tokens = sorted({t for t in words.folded(text).split(" ") if t})
    if not tokens or any(len(t) < 3 for t in tokens):
        return index.records
    found = candidates(index, tokens)
    few = found.limit(SENT + 1).count() <= SENT
    rows = index.records.join(F.broadcast(found) if few else found, ["block", "row"], "left_semi")
    digits = code_candidate(text)
    if digits is None:
        return rows
    return rows.where(~F.coalesce(F.col("code").startswith(digits), F.lit(False))).unionByName(index.records.where(F.col("code").startswith(digits)))


def search(index: Index, text: str, *, limit: int, description: str = "description") -> DataFrame:
    """As ``search.search`` on all records of the index."""
    if limit <= 0:
        raise QueryError("a limit is above zero")
    if not isinstance(text, str) or not text.strip():
        raise QueryError("a search text isn't empty")
    found = scored(pruned(index, text), text, folded=index.folded)
    rows, order = ranked(found, by_chapter=code_candidate(text) is None, most=limit, description=description)
    return rows.orderBy(*order).limit(limit).drop("_best", "block", "row")
