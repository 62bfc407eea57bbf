"""Column functions on hierarchical codes: two, four, six, eight or ten digits, kept as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Level by number of digits, and the digits of the level above and below.
LEVELS = {2: "hs2", 4: "hs4", 6: "hs6", 8: "fraccion8", 10: "nico10"}
WIDTHS = tuple(LEVELS)
PARENT_WIDTH = {4: 2, 6: 4, 8: 6, 10: 8}
CHILD_WIDTH = {parent: child for child, parent in PARENT_WIDTH.items()}


def ingest_digits(code: Column, width: int | None = None) -> Column:
    """Digits of a published code, or null where it isn't one.

    Dots and white space are separators; anything else is wrong. Without ``width`` the number of digits has to be a
    level's; with it, up to ``width`` digits are filled with zeros on the left.
    """
    digits = F.regexp_replace(code, r"(?U)[.\s]", "")
    fits = digits.rlike(r"\A[0-9]+\z")
    if width is not None:
        return F.when(fits & (F.length(digits) <= width), F.lpad(digits, width, "0"))
    return F.when(fits & F.length(digits).isin(*WIDTHS), digits)


def query_digits(code: Column) -> Column:
    """As :func:`ingest_digits`, for what users type: hyphens are separators too."""
    return ingest_digits(F.replace(code, F.lit("-"), F.lit("")))


def search_digits(text: Column) -> Column:
    """One to ten digits of a search text made of digits and separators; null for other texts."""
    digits = F.regexp_replace(text, r"(?U)[.\s-]", "")
    return F.when(digits.rlike(r"\A[0-9]{1,10}\z"), digits)


def level(code: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for pair in LEVELS.items() for x in pair]), F.length(code))


def prefix(code: Column, width: int) -> Column:
    """The ancestor of ``width`` digits; null for shorter codes."""
    return F.when(F.length(code) >= width, F.substring(code, 1, width))


def components(code: Column) -> dict[str, Column]:
    """The hierarchy's columns of a code."""
    return {
        **{name: prefix(code, width) for width, name in LEVELS.items()},
        "nico2": F.when(F.length(code) == 10, F.substring(code, 9, 2)),
    }


def parent(code: Column) -> Column:
    return F.when(F.length(code) > 2, F.substr(code, F.lit(1), F.length(code) - 2))


def formatted(code: Column) -> Column:
    """How publications print a code: ``01.01``, ``0101.21``, ``0101.21.01``, ``0101.21.01 00``."""
    cut = lambda a, n: F.substring(code, a, n)
    six = F.concat(cut(1, 4), F.lit("."), cut(5, 2))
    eight = F.concat(six, F.lit("."), cut(7, 2))
    n = F.length(code)
    return F.when(n == 2, code).when(n == 4, F.concat(cut(1, 2), F.lit("."), cut(3, 2))).when(n == 6, six).when(n == 8, eight).when(n == 10, F.concat(eight, F.lit(" "), cut(9, 2)))


def paired(code: Column) -> Column:
    """The serving dialect: pairs of digits joined by dots."""
    return F.array_join(F.regexp_extract_all(code, F.lit(".."), 0), ".")


def nico_code(fraction: Column, token: Column) -> Column:
    """Ten digits from an eight-digit fraction and a token of two digits, or of all ten; null otherwise."""
    digits = F.regexp_replace(token, r"[^0-9]", "")
    return F.when(F.length(digits) == 10, digits).when(F.length(digits) <= 2, F.when(F.length(digits) > 0, F.concat(fraction, F.lpad(digits, 2, "0"))))
