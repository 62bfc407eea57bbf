"""Column functions on log messages and documented addresses."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Failure categories in order, each with alternatives of phrases that have to be there together.
FAILURES = (
    ("legal_reconciliation", (("legal reconciliation",), ("missing_dof_evidence",))),
    ("source_discovery", (("missing official snapshot",), ("ambiguous official snapshot",))),
    ("source_registry", (("source registry",), ("registered source",))),
    ("checksum", (("checksum",), ("sha256", "mismatch"))),
    ("parser_profile", (("profile",),)),
    ("parser", (("workbook",), ("parser",), ("parse ",), ("pdf",))),
    ("validation", (("validation",), ("canonical database",), ("tariff values",), ("row_count",), ("contains no rows",), ("contains no tariff",), ("validation_status",))),
)
URL = r"https?://[^\s)\]>\"'`]+"


#: Kinds of errors that tell a category by themselves, and the category before which they are asked.
KINDS = (
    ("source_discovery", "source_network", ("RequestException", "HTTPError", "ConnectionError", "Timeout", "ConnectTimeout", "ReadTimeout", "SSLError", "TooManyRedirects", "InvalidURL", "ChunkedEncodingError")),
    ("parser", "parser", ("BadZipFile", "XLRDError")),
    (None, "domain_error", ("ValueError", "OSError", "FileNotFoundError", "PermissionError", "UnicodeDecodeError", "JSONDecodeError", "TimeoutError")),
)


def failure(message: Column, kind: Column | None = None) -> Column:
    """The first category whose phrases a message has, else ``unexpected_error``; with the error's ``kind`` (its class), kinds are asked in their place too."""
    low = F.lower(F.coalesce(message, F.lit("")))
    rules = [(name, reduce(or_, (reduce(and_, (low.contains(p) for p in way)) for way in ways))) for name, ways in FAILURES]
    if kind is not None:
        for before, name, classes in KINDS:
            at = next((k for k, (n, _) in enumerate(rules) if n == before), len(rules))
            rules.insert(at, (name, F.coalesce(kind.isin(*classes), F.lit(False))))
    out = F.when(rules[0][1], rules[0][0])
    for name, hit in rules[1:]:
        out = out.when(hit, name)
    return out.otherwise("unexpected_error")


def sanitised(url: Column) -> Column:
    """Without white space around and punctuation behind."""
    return F.regexp_replace(F.trim(url), r"[.,;:]+\z", "")


def bare_urls(text: Column) -> Column:
    """Addresses of a text that aren't targets of its Markdown links, in order."""
    linked = F.transform(F.regexp_extract_all(text, F.lit(r"\[[^\]]+\]\((https?://[^)]+)\)"), 1), sanitised)
    return F.filter(F.transform(F.regexp_extract_all(text, F.lit(URL), 0), sanitised), lambda u: ~F.array_contains(linked, u))


def is_documented(url: Column, plain_hosts: tuple[str, ...] = ()) -> Column:
    """Whether an address is absolute and clean: https, or http on one of the hosts."""
    scheme, host = F.lower(F.try_parse_url(url, F.lit("PROTOCOL"))), F.lower(F.try_parse_url(url, F.lit("HOST")))
    plain = host.isin(*plain_hosts) if plain_hosts else F.lit(False)
    good = host.isNotNull() & ((scheme == "https") | ((scheme == "http") & plain)) & ~url.rlike(r"[\s`<>]") & (sanitised(url) == url)
    return F.coalesce(good, F.lit(False))
