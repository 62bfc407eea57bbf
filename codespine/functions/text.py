"""Column functions on descriptions: folding, names, tokens, consistency."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import folding

#: Words that say nothing about a description.
STOPWORDS = ("de", "la", "el", "los", "las", "y", "o", "a", "en", "para", "con", "sin", "del", "al", "por", "un", "una", "que", "se", "su")
NAME_LENGTH = 120


def fold_case_kept(texts: Column | str) -> Column:
    """Single spaces, compatibility forms resolved, marks stripped; null is empty."""
    return folding.case_kept(F.col(texts) if isinstance(texts, str) else texts)


def fold(texts: Column | str) -> Column:
    """The search form: as above, and full case folding (``ß`` becomes ``ss``)."""
    return folding.search_form(F.col(texts) if isinstance(texts, str) else texts)


def folded(text: str) -> str:
    """The search form of a query text, on the driver."""
    return " ".join(folding.unmarked(text).casefold().split())


def single_spaced(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"(?U)[\s\x1c-\x1f]+", " "))


def header_key(text: Column) -> Column:
    """A sheet header for matching: folded, upper case, words of letters and digits."""
    return F.trim(F.regexp_replace(F.upper(fold_case_kept(text)), r"[^A-Z0-9]+", " "))


def derived_name(description: Column) -> Column:
    """Up to the first of ``; . :``, and 120 characters at most, cut at a space where there is one.

    A description that has nothing before the mark is taken whole; a blank one has no name (null).
    """
    whole = single_spaced(description)
    head = F.regexp_replace(F.regexp_extract(whole, r"\A([^;.:]*)", 1), r"[ \t\r\n;.:]+\z", "")
    name = F.when(head == "", whole).otherwise(head)
    at_space = F.regexp_extract(F.substring(name, 1, NAME_LENGTH + 1), r"\A(.+) ", 1)
    cut = F.when(F.length(name) <= NAME_LENGTH, name).when(at_space != "", at_space).otherwise(F.substring(name, 1, NAME_LENGTH))
    return F.when(whole != "", F.rtrim(cut))


def description_tokens(folded_text: Column) -> Column:
    """Distinct words of three or more letters or digits, without stopwords, of a folded text."""
    words = F.regexp_extract_all(folded_text, F.lit(r"[a-z0-9]+"), 0)
    return F.array_except(F.array_distinct(F.filter(words, lambda w: F.length(w) > 2)), F.array(*map(F.lit, STOPWORDS)))


def consistent(left: Column, right: Column) -> Column:
    """Whether two folded descriptions tell the same: one holds the other, or half of the shorter's tokens (two at least) are shared."""
    a, b = description_tokens(left), description_tokens(right)
    fewest = F.least(F.size(a), F.size(b))
    shared = F.size(F.array_intersect(a, b)) >= F.greatest(F.lit(2), F.floor(fewest / 2))
    return F.contains(right, left) | F.contains(left, right) | ((fewest > 0) & shared)
