"""Legal ledgers: documents by section with their links, and the two displayed dates of a page."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from html.parser import HTMLParser
from operator import and_

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dates, text
from ..workers import by_slices, ready
from .html import SILENT, file_category, joined, link_role, title_category

#: Words of the rows that open a section, patterns of the displayed dates, the current text's label, file and title, media types of roles.
SECTIONS = {
    "original": ("publicacion original",), "law_reform": ("decretos de reforma",), "tariff_decree": ("decretos que modifican", "tarifa"), "complementary": ("acuerdos complementarios",),
}
LAW_DATE = r"ultima reforma publicada.*?(\d{1,2}\s+de\s+[a-z]+\s+de\s+\d{4})"
TARIFF_DATE = r"fracciones arancelarias.*?decreto dof\s+(\d{1,2}[-/]\d{1,2}[-/]\d{4})"
CURRENT_LABEL, CURRENT_FILE, CURRENT_TITLE = "texto vigente", "/pdf/ligie_2022.pdf", "Texto vigente LIGIE 2022"
MEDIA = {"dof": "application/pdf", "word": "application/msword", "pdf": "application/pdf"}

#: ``said``, ``folded``: texts in search form (those of rows and of their titles: the second cell, else the whole row).
_LINKS = T.ArrayType(T.StructType().add("target", "string").add("label", "string").add("said", "string"))
_ROWS = T.ArrayType(T.StructType().add("cells", T.ArrayType(T.StringType())).add("links", _LINKS).add("folded", "string").add("title", "string"))
_PAGE_TYPE = T.StructType().add("said", "string").add("loose", _LINKS).add("rows", _ROWS)


class LedgerError(ValueError):
    """A ledger that can't be taken over whole."""


class _Ledger(HTMLParser):
    """Table rows with the texts of their cells and their links; links outside of rows; all text."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.said: list[str] = []
        self.rows: list[dict] = []
        self.loose: list[dict] = []
        self.row: dict | None = None
        self.cell: list[str] | None = None
        self.label: list[str] | None = None
        self.silent = 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.silent += tag in SILENT
        if tag == "tr":
            self.row = {"cells": [], "links": []}
            self.rows.append(self.row)
        elif tag in ("td", "th") and self.row is not None:
            self.cell = []
            self.row["cells"].append(self.cell)
        elif tag == "a" and (link := dict(attrs).get("href")):
            self.label = []
            (self.loose if self.row is None else self.row["links"]).append({"target": link.strip(), "label": self.label})

    def handle_data(self, data: str) -> None:
        if not self.silent:
            for held in (self.said, self.cell, self.label):
                if held is not None:
                    held.append(data)

    def handle_endtag(self, tag: str) -> None:
        if tag in SILENT:
            self.silent = max(0, self.silent - 1)
        elif tag in ("td", "th"):
            self.cell = None
        elif tag == "a":
            self.label = None
        elif tag in ("tr", "table"):
            self.row = self.cell = None


def _joined(parts: list[str]) -> str:
    return " ".join(" ".join(parts).split())


@F.pandas_udf(_PAGE_TYPE)
def _read(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    def one(page: str | None, url: str | None) -> dict:
        parser = _Ledger()
        parser.feed(page or "")
        parser.close()

        def links(found: list[dict]) -> list[dict]:
            labels = [_joined(x["label"]) for x in found]
            return [{"target": joined(url, x["target"]), "label": label, "said": text.folded(label)} for x, label in zip(found, labels, strict=True)]

        rows = []
        for r in parser.rows:
            cells = [_joined(c) for c in r["cells"]]
            whole = text.folded(" ".join(cells))
            rows.append({"cells": cells, "links": links(r["links"]), "folded": whole, "title": text.folded(cells[1]) if len(cells) > 1 else whole})
        return {"said": text.folded(" ".join(parser.said)), "loose": links(parser.loose), "rows": rows}

    yield from (pd.DataFrame(made, columns=["said", "loose", "rows"]) for made in by_slices(batches, one))


def _pages(pages: DataFrame, html: str, url: str) -> DataFrame:
    """``url``, ``page`` (a number of the page's row), both dates, ``entries`` (loose, cells, links) in the page's order, loose links first."""
    ready()
    read = pages.select(F.col(url).alias("url"), F.monotonically_increasing_id().alias("page"), _read(html, url).alias("_p"))
    said = F.col("_p.said")
    law, tariff = F.regexp_extract(said, LAW_DATE, 1), F.regexp_extract(said, TARIFF_DATE, 1)

    def current(x: Column) -> Column:
        path = F.lower(F.regexp_extract(x["target"], r"\A(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1))
        return x["said"].contains(CURRENT_LABEL) | path.endswith(CURRENT_FILE)

    loose = F.transform(F.filter("_p.loose", current), lambda x: F.struct(F.lit(True).alias("loose"), F.array().cast("array<string>").alias("cells"), F.array(x).alias("links"), F.lit("").alias("folded"), F.lit("").alias("title")))
    rows = F.transform("_p.rows", lambda r: F.struct(F.lit(False).alias("loose"), r["cells"].alias("cells"), r["links"].alias("links"), r["folded"].alias("folded"), r["title"].alias("title")))
    return read.select("url", "page", dates.named_date(law).alias("last_law_reform"), dates.numeric_date(tariff).alias("latest_tariff_modification"), F.concat(loose, rows).alias("entries"))


def _whole(cells: Column) -> Column:
    return F.trim(F.array_join(cells, " "))


def _opens(loose: Column, folded: Column) -> Column:
    """The section that a row opens, or null."""
    contained = lambda words: [folded.contains(w) for w in words]
    return F.coalesce(*[F.when(reduce(and_, contained(words), ~loose), name) for name, words in SECTIONS.items()])


def _families(links: Column) -> Column:
    return F.array_distinct(F.array_compact(F.transform(links, lambda x: file_category(x["target"]))))


def _documents(read: DataFrame) -> DataFrame:
    each = read.select("url", "page", "last_law_reform", F.posexplode("entries").alias("position", "_e")).select("url", "page", "last_law_reform", "position", "_e.*")
    order = Window.partitionBy("url", "page").orderBy("position")
    rows = each.withColumn("_text", _whole(F.col("cells"))).withColumn("_opens", _opens(F.col("loose"), F.col("folded"))).withColumn("_section", F.coalesce(F.last("_opens", ignorenulls=True).over(order), F.lit("unknown")))
    rows = rows.where(F.col("_opens").isNull() & (F.size("links") > 0) & (F.col("loose") | (F.col("_text") != "")))
    families = _families(F.col("links"))
    title = F.when(F.size("cells") > 1, F.get("cells", F.lit(1))).otherwise(F.col("_text"))
    rows = rows.withColumns({"_families": families, "_title": title})
    by_section = F.when(F.col("_section") == "complementary", title_category(F.col("title"))).otherwise(F.col("_section"))

    def link(x: Column) -> Column:
        role = link_role(x["said"], x["target"])
        media = F.coalesce(*[F.when(role == r, m) for r, m in MEDIA.items()])
        return F.struct(role.alias("role"), x["target"].alias("target"), x["label"].alias("label"), dates.numeric_date(x["label"]).alias("displayed_date"), media.alias("media_type"))

    loose = F.col("loose")
    return rows.select(
        "url", "page", "position",
        F.when(loose, "consolidated_text").otherwise(F.coalesce(F.get("_families", F.lit(0)), by_section)).alias("category"),
        F.when(loose, "current").otherwise(F.trim(F.get("cells", F.lit(0)))).alias("label"), F.when(loose, CURRENT_TITLE).otherwise(F.col("_title")).alias("title"),
        F.when(loose, F.col("last_law_reform")).otherwise(dates.numeric_date(F.col("_text"))).alias("displayed_date"),
        F.transform("links", link).alias("links"),
    )


def ledger_documents(pages: DataFrame, *, html: str = "html", url: str = "url") -> DataFrame:
    """``url``, ``position``, ``category``, ``label``, ``title``, ``displayed_date``, ``links`` (role, target, label, displayed_date, media_type).

    A row of a table is a document where it has links and text; rows with the words of a section open it. Its category is that of its links' file names, else
    its section, which the title decides among complementary documents. Links to the current text outside of tables are documents, too, dated by the last reform.
    Positions count the current texts and then all rows. Pages are read one by one, sections follow by a window over a page's rows; a null page has no documents.
    What a page lacks is in :func:`ledger_problems`.
    """
    return _documents(_pages(pages, html, url)).drop("page")


def ledger_dates(pages: DataFrame, *, html: str = "html", url: str = "url") -> DataFrame:
    """``url``, ``last_law_reform``, ``latest_tariff_modification`` of each page; a date that isn't shown is null."""
    return _pages(pages, html, url).select("url", "last_law_reform", "latest_tariff_modification")


def ledger_problems(pages: DataFrame, *, html: str = "html", url: str = "url") -> DataFrame:
    """``url``, ``reason`` (missing_date, no_documents, ambiguous_families): why a page can't be taken over."""
    document = lambda e: _opens(e["loose"], e["folded"]).isNull() & (F.size(e["links"]) > 0) & (e["loose"] | (_whole(e["cells"]) != ""))
    found = F.filter("entries", document)
    twice = F.exists("_found", lambda e: ~e["loose"] & (F.size(_families(e["links"])) > 1))
    both = _pages(pages, html, url).withColumn("_found", found)
    reasons = F.array_compact(F.array(
        F.when(F.col("last_law_reform").isNull() | F.col("latest_tariff_modification").isNull(), "missing_date"),
        F.when(F.size("_found") == 0, "no_documents"), F.when(twice, "ambiguous_families"),
    ))
    return both.select("url", F.explode(reasons).alias("reason"))


def required_ledger(pages: DataFrame, *, html: str = "html", url: str = "url") -> DataFrame:
    """The documents of pages without problems; raises for the first page that has one, so that no part of a ledger is lost unseen."""
    if first := ledger_problems(pages, html=html, url=url).orderBy("url", "reason").head(1):
        raise LedgerError(f"{first[0].url}: {first[0].reason}")
    return ledger_documents(pages, html=html, url=url)
