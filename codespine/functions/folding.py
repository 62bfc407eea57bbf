"""Unicode folding as column expressions, without Python workers.

Compatibility decomposition, the removal of marks and full case folding each look at one character at a time (what is left after the marks are gone has no
order to change), so together they are a table from characters to texts. Spark has ``translate`` for those that become one character or
none; the few that become several are looked up in the rows that have any. Hangul syllables are taken apart by arithmetic.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The first and last Hangul syllable, the first of each kind of letter, and how many syllables share a first letter or a vowel.
HANGUL, LEADS, VOWELS, TAILS, BY_LEAD, BY_VOWEL = ("가", "힣"), 0x1100, 0x1161, 0x11A7, 588, 28


OTHER = re.compile(r"[^\x00-\x7f]+")


def unmarked(text: str) -> str:
    """Compatibility forms resolved, marks stripped."""
    return text if text.isascii() else OTHER.sub(lambda m: "".join(c for c in m[0] if not unicodedata.combining(c)), unicodedata.normalize("NFKD", text))


def character(c: str, case: bool) -> str:
    """What one character becomes; ``case``: case is folded and white space becomes a space."""
    if not case:
        return unmarked(c)
    return "".join(" " if x.isspace() else x for x in unmarked(c).casefold())


@lru_cache
def tables(case: bool) -> tuple[str, str, dict[str, str]]:
    """Characters that become one or none (these last), what they become, and those that become several."""
    one, none, several = {}, [], {}
    for code in range(0x110000):
        if 0xD800 <= code <= 0xDFFF or ord(HANGUL[0]) <= code <= ord(HANGUL[1]):
            continue
        c = chr(code)
        f = character(c, case)
        if f == c:
            continue
        if len(f) == 1:
            one[c] = f
        elif f:
            several[c] = f
        else:
            none.append(c)
    return "".join([*one, *none]), "".join(one.values()), several


def _class(characters: list[str]) -> str:
    """A pattern's character class of ascending characters, neighbours as ranges."""
    spans: list[list[int]] = []
    for code in map(ord, characters):
        if spans and spans[-1][1] == code - 1:
            spans[-1][1] = code
        else:
            spans.append([code, code])
    return "[" + "".join(rf"\x{{{a:x}}}-\x{{{b:x}}}" for a, b in spans) + "]"


def _letters(first: int, n: int) -> Column:
    return F.lit("".join(chr(first + k) for k in range(n)))


def characters_folded(texts: Column, case: bool) -> Column:
    """Each character by the tables."""
    source, target, several = tables(case)
    several = dict(several)
    if case:  # the one that is frequent
        texts = F.replace(texts, F.lit("ß"), F.lit(several.pop("ß")))
    texts = F.translate(texts, source, target)
    names, values = "".join(several), F.split(F.lit("\0".join(several.values())), "\0")
    at = F.ascii  # the code point of the first character

    def expanded(c: Column) -> Column:
        k = at(c) - ord(HANGUL[0])
        lead = F.substring(_letters(LEADS, 19), F.floor(k / BY_LEAD).cast("int") + 1, F.lit(1))
        vowel = F.substring(_letters(VOWELS, 21), F.floor(k % BY_LEAD / BY_VOWEL).cast("int") + 1, F.lit(1))
        tail = F.when(k % BY_VOWEL > 0, F.substring(_letters(TAILS + 1, 27), k % BY_VOWEL, F.lit(1))).otherwise("")
        place = F.instr(F.lit(names), c)
        return F.when(c.between(*HANGUL), F.concat(lead, vowel, tail)).when(place > 0, F.element_at(values, place)).otherwise(c)

    some = _class(sorted([*several, *map(chr, range(ord(HANGUL[0]), ord(HANGUL[1]) + 1))]))
    return F.when(texts.rlike(some), F.array_join(F.transform(F.regexp_extract_all(texts, F.lit("(?s)."), 0), expanded), "")).otherwise(texts)


@lru_cache
def white_space() -> str:
    """A pattern of what Python's ``str.split`` parts words by."""
    return _class([chr(c) for c in range(0x3001) if chr(c).isspace()]) + "+"


def case_kept(texts: Column) -> Column:
    """Single spaces, then compatibility forms resolved and marks stripped; null is empty."""
    spaced = F.trim(F.regexp_replace(F.coalesce(texts.cast("string"), F.lit("")), white_space(), " "))
    return characters_folded(spaced, case=False)


def search_form(texts: Column) -> Column:
    """As above and full case folding, with single spaces at the end; null is empty."""
    return F.trim(F.regexp_replace(characters_folded(F.coalesce(texts.cast("string"), F.lit("")), case=True), " +", " "))
