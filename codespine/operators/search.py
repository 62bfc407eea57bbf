"""Scored search: exact code, code prefix, tokens in descriptions; suggestions; plain matching."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as words
from .hierarchy import QueryError

EXACT, PREFIX, TOKENS, TOKEN, ALL_TOKENS = 1000, 700, 300, 25, 5
SCORER_VERSION = "1"


def code_candidate(text: str) -> str | None:
    """One to ten digits of a text that holds digits and separators only."""
    digits = "".join(c for c in text.strip() if c not in ".-" and not c.isspace())
    return digits if digits.isascii() and digits.isdigit() and len(digits) <= 10 else None


#: The most rows that the serving variants give.
SEARCH_MOST, SUGGEST_MOST = 50, 20


def checked_limit(limit: int, most: int | None = None) -> int:
    """The limit; raises where it isn't above zero, or above ``most``."""
    if not isinstance(limit, int) or isinstance(limit, bool) or limit <= 0:
        raise QueryError("a limit is above zero")
    if most is not None and limit > most:
        raise QueryError(f"a limit is {most} at most")
    return limit


def served_search(records: DataFrame, text: str, *, limit: int = 20, **options: str) -> DataFrame:
    """:func:`search` with the serving variant's limit."""
    return search(records, text, limit=checked_limit(limit, SEARCH_MOST), **options)


def served_suggest(records: DataFrame, text: str, *, limit: int = 5, **options: str) -> DataFrame:
    """:func:`suggest` with the serving variant's limit and its cut of the ranking before the preference."""
    return suggest(records, text, limit=checked_limit(limit, SUGGEST_MOST), ranking=SEARCH_MOST, **options)


def scored(records: DataFrame, text: str, *, folded: str = "folded") -> DataFrame:
    """Records that match, with ``score``, ``match_kind``, ``matched``, ``confidence`` and ``scorer_version``.

    ``records``: ``code``, the folded description and others. A text of digits is a code first; records that don't match it
    are held against the text like any other.
    """
    if not isinstance(text, str) or not text.strip():
        raise QueryError("a search text isn't empty")
    tokens = [t for t in words.folded(text).split(" ") if t]
    candidate = code_candidate(text)
    matched = F.lit(0)
    for token in tokens:
        matched = matched + F.contains(F.col(folded), F.lit(token)).cast("int")
    exact = F.lit(False) if candidate is None else F.col("code") == candidate
    prefix = F.lit(False) if candidate is None else F.col("code").startswith(candidate)
    found = records.withColumn("_m", matched)
    kind = F.when(exact, "exact_code").when(prefix, "code_prefix").when(F.col("_m") > 0, "description")
    score = F.when(exact, EXACT).when(prefix, PREFIX).when(F.col("_m") > 0, TOKENS + TOKEN * F.col("_m") + F.when(F.col("_m") == len(tokens), ALL_TOKENS).otherwise(0))
    sure = F.when(exact, 1.0).when(prefix, 0.85).otherwise(F.col("_m") / F.lit(float(max(len(tokens), 1))))
    is_code = exact | prefix
    return (
        found.where(is_code | (F.col("_m") > 0))
        .withColumns({"score": score, "match_kind": kind, "matched": F.when(is_code, 0).otherwise(F.col("_m")), "confidence": sure, "scorer_version": F.lit(SCORER_VERSION)})
        .drop("_m")
    )


def ranked(found: DataFrame, *, by_chapter: bool, most: int, apart: Column | None = None, description: str = "description") -> tuple[DataFrame, list[Column]]:
    """The rows and their stable order: the chapter's best score first (texts only), then score, code, description.

    No more than ``most`` rows of a chapter can be among the first ``most`` of all, so others go before the chapters meet (Spark
    cuts them in each task, before the shuffle), and the best stay. ``apart``: a condition whose two sides keep ``most`` rows each.
    """
    own = [F.desc("score"), F.asc_nulls_last("code"), F.asc_nulls_last(description)]
    if not by_chapter:
        return found, own
    chapter = F.substring("code", 1, 2)
    place = F.row_number().over(Window.partitionBy(chapter, *([] if apart is None else [apart])).orderBy(*own))
    first = found.withColumn("_place", place).where(F.col("_place") <= most).drop("_place")
    return first.withColumn("_best", F.max("score").over(Window.partitionBy(chapter))), [F.desc("_best"), *own]


def search(records: DataFrame, text: str, *, limit: int, folded: str = "folded", description: str = "description") -> DataFrame:
    """The first ``limit`` matches. Scores are computed where the rows are; only the first rows of each chapter meet."""
    checked_limit(limit)
    found, order = ranked(scored(records, text, folded=folded), by_chapter=code_candidate(text) is None, most=limit, description=description)
    return found.orderBy(*order).limit(limit).drop("_best")


def suggest(records: DataFrame, text: str, *, limit: int = 5, ranking: int | None = None, folded: str = "folded", description: str = "description") -> DataFrame:
    """The first matches among eight-digit fractions, or among all levels if no fraction matches.

    ``ranking`` (the serving variant has 50) cuts the ranking before the preference, not after it.
    """
    checked_limit(limit)
    fraction = F.length("code") == 8
    kept = {"most": limit, "apart": fraction} if ranking is None else {"most": ranking}
    found, order = ranked(scored(records, text, folded=folded), by_chapter=code_candidate(text) is None, description=description, **kept)
    if ranking is not None:
        found = found.orderBy(*order).limit(ranking)
    any_fraction = found.agg(F.coalesce(F.max(fraction.cast("int")), F.lit(0)).alias("_any"))
    preferred = found.crossJoin(F.broadcast(any_fraction)).where((F.col("_any") == 0) | fraction)  # one row
    return preferred.orderBy(*order).limit(limit).drop("_best", "_any")


def matching(records: DataFrame, pattern: str, *, code: str | None = None, description: str = "description") -> DataFrame:
    """Case-insensitive containment; ``%`` and ``_`` in the pattern keep their meaning. Score 100 by code, else 50."""
    hit = F.col(description).ilike(f"%{pattern}%")
    if code is None:
        return records.where(hit).withColumn("score", F.lit(50))
    by_code = F.col("code").startswith(code)
    return records.where(hit | by_code).withColumn("score", F.when(by_code, 100).otherwise(50))
