"""HTML sources: links, iframes, tables, national notes, fraction sheets, document ledgers.

Pages go through Arrow UDFs over small parsers of the standard library, which yield lines, links and tables; what follows from these is
column functions, windows and joins. Every extractor is a column function or a DataFrame operator, so pages are parsed where they are.
"""

from __future__ import annotations

import html as entities
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import codes, dates, text
from ..operators.hierarchy import section_chapters
from ..workers import by_slices, ready

#: Elements whose start or end ends a line of text, and those whose content is no text.
BLOCKS = {"p", "div", "h1", "h2", "h3", "h4", "h5", "h6", "li", "tr", "br", "table", "ul", "ol"}
SILENT = {"script", "style"}


class _Page(HTMLParser):
    """Lines of text, and links with their labels, headings and table rows, of one page."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[list[str]] = [[]]
        self.links: list[dict] = []
        self.heading, self.row, self.silent = "", -1, 0
        self.label: list[str] | None = None
        self.head: list[str] | None = None
        self.row_text: list[list[str]] = []

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in SILENT:
            self.silent += 1
        if tag in BLOCKS:
            self.lines.append([])
        if tag == "tr":
            self.row += 1
            self.row_text.append([])
        if tag in ("td", "th") and self.row_text:
            self.row_text[-1].append(" ")
        if len(tag) == 2 and tag[0] == "h" and tag[1].isdigit():
            self.head = []
        at = {"a": "href", "iframe": "src"}.get(tag)
        address = next((v for k, v in attrs if k == at and v), None) if at else None
        if address is not None:
            self.label = []
            self.links.append({"kind": tag, "href": address.strip(), "label": self.label, "heading": self.heading, "row": self.row})

    def handle_data(self, data: str) -> None:
        if self.silent:
            return
        self.lines[-1].append(data)
        for held in (self.label, self.head, self.row_text[-1] if self.row_text else None):
            if held is not None:
                held.append(data)

    def handle_endtag(self, tag: str) -> None:
        if tag in SILENT:
            self.silent = max(0, self.silent - 1)
        if tag in BLOCKS:
            self.lines.append([])
        if tag in ("a", "iframe"):
            self.label = None
        if self.head is not None and len(tag) == 2 and tag[0] == "h":
            self.heading, self.head = " ".join("".join(self.head).split()), None


def _read(page: str | None) -> _Page:
    parser = _Page()
    parser.feed(page or "")
    parser.close()
    return parser


@F.pandas_udf(T.ArrayType(T.StringType()))
def _lines(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    one = lambda p: [x for x in (" ".join("".join(line).split()) for line in _read(p).lines) if x]
    yield from map(pd.Series, by_slices(((pages,) for pages in batches), one))


ANCHOR = T.StructType([T.StructField(n, T.IntegerType() if n == "row" else T.StringType()) for n in ("kind", "href", "target", "label", "heading", "row", "title")])


@F.pandas_udf(T.ArrayType(ANCHOR))
def _anchors(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    def one(page: str | None, url: str | None) -> list[dict]:
        read = _read(page)
        titles = [" ".join("".join(r).split()) for r in read.row_text]
        return [{**x, "target": joined(url, x["href"]), "label": " ".join("".join(x["label"]).split()), "title": titles[x["row"]] if x["row"] >= 0 else ""} for x in read.links]

    yield from map(pd.Series, by_slices(batches, one))


def joined(base: str | None, link: str) -> str:
    """A link resolved against its page's address; one that can't be is left as it is."""
    try:
        return urljoin(base or "", link)
    except ValueError:
        return link


def text_lines(html: Column | str) -> Column:
    """Lines of a page's text in order: character references resolved, single spaces, without scripts and styles."""
    ready()
    return _lines(html)


def anchors(html: Column | str, url: Column | str) -> Column:
    """Links and frames of a page in order, with label, the heading before and the text of the table row around (row -1: none)."""
    ready()
    return _anchors(html, url)


def links(pages: DataFrame, *, html: str = "html", url: str = "url", frames: bool = True) -> DataFrame:
    """One row for each distinct link of a page, in the order of its first place: ``position``, ``href``, ``target``.

    Places on the page itself (``#``) and empty links are left out.
    """
    found = F.filter(anchors(html, url), lambda x: (x["href"] != "") & ~x["href"].startswith("#") & (F.lit(frames) | (x["kind"] == "a")))
    each = F.transform(found, lambda x: F.struct(x["href"].alias("href"), x["target"].alias("target")))
    rest = [c for c in pages.columns if c != html]
    return pages.select(*rest, F.posexplode(F.array_distinct(each)).alias("position", "_l")).select(*rest, "position", F.col("_l.href").alias("href"), F.col("_l.target").alias("target"))


#: Fixed value: addresses in attributes and scripts of old pages.
RAW_URL = r"""(?i)(?:href|src|action|location(?:\.href)?)\s*=\s*["']([^"'#]+)["']"""


def raw_links(pages: DataFrame, *, html: str = "html", url: str = "url") -> DataFrame:
    """Addresses that attributes or scripts name, each once, in the order of their first place."""
    found = F.transform(F.array_distinct(F.regexp_extract_all(html, F.lit(RAW_URL), 1)), lambda x: F.trim(x))
    rows = pages.select(*[c for c in pages.columns if c != html], F.posexplode(found).alias("position", "href"))
    return rows.withColumn("target", resolved(F.col("href"), F.col(url)))


@F.pandas_udf(T.StringType())
def _resolved(links: pd.Series, bases: pd.Series) -> pd.Series:
    return pd.Series([None if a is None else joined(b, entities.unescape(a)) for a, b in zip(links, bases, strict=True)])


def resolved(link: Column, base: Column) -> Column:
    """A link resolved against its page's address, ``..`` folded; null stays null."""
    ready()
    return _resolved(link, base)


def document_links(found: DataFrame, hosts: list[str], suffix: str = ".pdf") -> DataFrame:
    """Links over https to a document on an allowed host, each target once (the first place counts)."""
    good = (F.try_parse_url("target", F.lit("PROTOCOL")) == "https") & F.lower(F.try_parse_url("target", F.lit("HOST"))).isin([h.lower() for h in hosts]) & F.lower(F.try_parse_url("target", F.lit("PATH"))).endswith(suffix)
    return found.where(good).groupBy("target").agg(F.min("position").alias("position"))


#: Media types by suffix.
MEDIA_TYPES = {
    ".pdf": "application/pdf", ".xls": "application/vnd.ms-excel", ".xlsx": "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",
    ".htm": "text/html", ".html": "text/html", ".csv": "text/csv", ".zip": "application/zip",
}


def file_name(url: Column) -> Column:
    return F.regexp_extract(F.regexp_replace(url, r"[?#].*\z", ""), r"([^/]*)\z", 1)


def media_type(url: Column) -> Column:
    suffix = F.lower(F.regexp_extract(file_name(url), r"(\.[A-Za-z0-9]+)\z", 1))
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for p in MEDIA_TYPES.items() for x in p]), suffix), F.lit("text/html"))


def classified(candidates: DataFrame, registry: list[dict]) -> DataFrame:
    """Adds ``dataset_key`` and ``document_role`` of the first registered family that a candidate belongs to.

    ``candidates``: page, target, media_type; a registry entry has dataset_key, pages, allowed_hosts, media_types and families
    (pairs of role and file-name patterns). The registry is configuration, so it is written into the plan.
    """
    host, name = F.lower(F.try_parse_url("target", F.lit("HOST"))), F.upper(file_name(F.col("target")))
    kind = F.lower(F.trim(F.substring_index("media_type", ";", 1)))
    result = F.lit(None).cast("struct<dataset_key: string, document_role: string>")
    for entry in reversed(registry):
        here = F.col("page").isin(entry["pages"]) & (host.isNull() | host.isin(entry["allowed_hosts"])) & kind.isin(entry["media_types"])
        for role, patterns in reversed(entry["families"]):
            some = F.lit(False)
            for p in patterns:
                some = some | name.rlike(rf"(?i)\A(?:{p})\z")
            result = F.when(here & some, F.struct(F.lit(entry["dataset_key"]).alias("dataset_key"), F.lit(role).alias("document_role"))).otherwise(result)
    return candidates.withColumn("_r", result).select(*candidates.columns, F.col("_r.dataset_key").alias("dataset_key"), F.col("_r.document_role").alias("document_role"))


#: How lines begin that name a scope, end the notes, or open a note.
OF_CHAPTER = r"(?iu)\ACap[ií]tulo\s+(\d{1,2})(?![.\d])"
OF_SECTION = r"(?iu)\ASecci[oó]n\s+([IVXLCDM]+)\b"
OF_NOTHING = r"(?iu)\A(?:Art[ií]culo\s+|TRANSITORIOS\b)"
NOTE = r"\A(\d+)\.\s+"


class NotesError(ValueError):
    """A page whose national notes can't all be told."""


def _note_lines(pages: DataFrame, html: str, source: str) -> DataFrame:
    """Lines of pages with the scope and the note that they belong to (windows over a page's lines)."""
    one = lambda pattern: F.regexp_extract("line", pattern, 1)
    numbered = pages.select(F.monotonically_increasing_id().alias("page"), F.col(source).alias("source"), text_lines(html).alias("lines"))
    lines = numbered.select("page", "source", F.posexplode_outer("lines").alias("k", "line"))
    of = lambda kind, value: F.struct(F.lit(kind).alias("type"), value.alias("value"))
    scope = F.when(one(OF_CHAPTER) != "", of("chapter", F.lpad(one(OF_CHAPTER), 2, "0"))).when(one(OF_SECTION) != "", of("section", F.upper(one(OF_SECTION)))).when(F.col("line").rlike(OF_NOTHING), of("none", F.lit("")))
    before = Window.partitionBy("page").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    marked = lines.withColumns({"scope": scope, "opens": F.when(scope.isNotNull(), -1).when(one(NOTE) != "", F.col("k"))})
    return marked.withColumns({"scope": F.last("scope", ignorenulls=True).over(before), "note": F.last("opens", ignorenulls=True).over(before), "number": one(NOTE)})


def _notes(lines: DataFrame) -> DataFrame:
    """Notes of the lines, those without a text too: ``page``, ``source``, ``scope_type``, ``scope_value``, ``note_number``, ``text``, and the section's ``_chapter``."""
    placed = lines.where("note >= 0 and scope.type in ('chapter', 'section')")
    part = F.struct("k", F.when(F.col("k") == F.col("note"), F.regexp_replace("line", NOTE, "")).otherwise(F.col("line")).alias("line"))
    notes = placed.groupBy("page", "source", "scope", "note").agg(F.max(F.when(F.col("k") == F.col("note"), F.col("number"))).alias("note_number"), F.array_sort(F.collect_list(part)).alias("parts"))
    whole = notes.select("page", "source", F.col("scope.type").alias("scope_type"), F.col("scope.value").alias("scope_value"), "note_number", text.single_spaced(F.array_join(F.col("parts.line"), " ")).alias("text"))
    to = section_chapters(lines.sparkSession).select(F.col("roman").alias("scope_value"), F.col("chapter").alias("_chapter"))
    spread = whole.join(F.broadcast(to), "scope_value", "left")  # 97 rows
    return spread.withColumn("chapter", F.when(F.col("scope_type") == "chapter", F.col("scope_value")).otherwise(F.col("_chapter")))


def national_notes(pages: DataFrame, *, html: str = "html", source: str = "source_document_id") -> DataFrame:
    """Numbered notes with their scope, one row for each chapter they apply to: ``chapter``, ``scope_type``, ``scope_value``,
    ``note_number``, ``text``, ``source_document_id``. Section notes apply to all of the section's chapters.

    A line sets the scope, opens a note, or goes on with the note before it; the last scope and the last note before a line are windows over a page's lines.
    Lines outside of a scope, or before its first note, belong to none. Notes without a text and notes of unknown sections are left out here and
    are rows of :func:`note_problems`; :func:`required_notes` doesn't go on where there are any.
    """
    rows = _notes(_note_lines(pages, html, source)).where("text <> '' AND chapter IS NOT NULL")
    return rows.select("chapter", "scope_type", "scope_value", "note_number", "text", F.col("source").alias("source_document_id"))


def note_problems(pages: DataFrame, *, html: str = "html", source: str = "source_document_id") -> DataFrame:
    """What :func:`national_notes` can't publish: ``source_document_id``, ``reason`` (no_notes, empty_note, unknown_section), ``scope_value``, ``note_number``."""
    lines = _note_lines(pages, html, source)
    notes = _notes(lines)
    reason = F.when(F.col("text") == "", "empty_note").when(F.col("chapter").isNull(), "unknown_section")
    bad = notes.select("source", reason.alias("reason"), "scope_value", "note_number").where("reason IS NOT NULL").distinct()
    opened = lines.groupBy("page", "source").agg(F.max(F.coalesce((F.col("note") >= 0) & F.col("scope.type").isin("chapter", "section"), F.lit(False))).alias("some"))
    none = opened.where("NOT some").select("source", F.lit("no_notes").alias("reason"), F.lit(None).cast("string").alias("scope_value"), F.lit(None).cast("string").alias("note_number"))
    return bad.unionByName(none).withColumnRenamed("source", "source_document_id")


def required_notes(pages: DataFrame, *, html: str = "html", source: str = "source_document_id") -> DataFrame:
    """The notes of pages that all have notes, all with texts and known scopes; raises otherwise, so that no note of a legal text is lost unseen."""
    if first := note_problems(pages, html=html, source=source).orderBy("source_document_id", "reason").head(1):
        raise NotesError(f"{first[0].source_document_id}: {first[0].reason}, scope {first[0].scope_value}, note {first[0].note_number}")
    return national_notes(pages, html=html, source=source)


class _Tables(HTMLParser):
    """Cells of all tables; a table inside a cell begins a new one."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.tables: list[list[list[str]]] = []
        self.open: list[list[list[str]]] = []
        self.cell: list[str] | None = None

    def handle_starttag(self, tag: str, attrs: object) -> None:
        if tag == "table":
            self.open.append([])
        elif tag == "tr" and self.open:
            self.open[-1].append([])
        elif tag in ("td", "th") and self.open and self.open[-1]:
            self.cell = []

    def handle_data(self, data: str) -> None:
        if self.cell is not None:
            self.cell.append(data)

    def handle_endtag(self, tag: str) -> None:
        if tag in ("td", "th") and self.cell is not None and self.open and self.open[-1]:
            self.open[-1][-1].append(" ".join(" ".join(self.cell).split()))
            self.cell = None
        elif tag == "table" and self.open:
            if rows := [r for r in self.open.pop() if any(r)]:
                self.tables.append(rows)


def tables(html: Column | str) -> Column:
    """Tables, rows, cells of each page; blank rows and empty tables are left out."""
    ready()
    return _tables(html)


@F.pandas_udf(T.ArrayType(T.ArrayType(T.ArrayType(T.StringType()))))
def _tables(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:

    def one(page: str | None) -> list:
        parser = _Tables()
        parser.feed(page or "")
        parser.close()
        return parser.tables

    yield from map(pd.Series, by_slices(((pages,) for pages in batches), one))


def fraction_sheet(pages: DataFrame, *, html: str = "html", url: str = "url") -> DataFrame:
    """Third-party sheets: ``code`` (eight digits of the address), and rows with the code, or an item of it, in any cell; what follows that cell is
    the description and the duties."""
    code = F.regexp_extract(file_name(F.col(url)), r"(\d{8})", 1)
    rows = pages.select(code.alias("code"), F.explode(F.flatten(tables(html))).alias("cells")).where("code <> ''")

    def item(cell: Column) -> Column:
        digits = F.regexp_replace(cell, r"[.\s]", "")
        return F.when(digits.rlike(r"\A\d{2}\z"), codes.nico_code(F.col("code"), digits)).when(digits.rlike(r"\A(?:\d{8}|\d{10})\z") & digits.startswith(F.col("code")), digits)

    # an item of two digits counts in the first cell only, where it can't be a duty
    found = F.transform("cells", lambda c, k: F.when((k == 0) | (F.length(F.regexp_replace(c, r"[.\s]", "")) > 2), item(c)))
    placed = rows.withColumn("found", found).withColumn("place", F.array_position(F.transform("found", lambda x: x.isNotNull()), True).cast("int")).where("place > 0")
    # of a code and an item beside it, the item
    last = F.when(F.try_element_at("cells", F.col("place") + 1).rlike(r"\A\d{2}\z") & (F.length(F.element_at("found", F.col("place"))) == 8), 1).otherwise(0)
    beside = placed.withColumn("more", last)
    own = F.when(F.col("more") == 1, F.concat("code", F.element_at("cells", F.col("place") + 1))).otherwise(F.element_at("found", F.col("place")))
    at = lambda k: F.try_element_at("cells", F.col("place") + F.col("more") + k)
    return beside.select("code", own.alias("item"), at(1).alias("description"), at(2).alias("igi"), at(3).alias("ige"))


def link_role(label: Column, url: Column) -> Column:
    """What a link leads to, by its label first and its suffix then; ``label`` folded."""
    suffix = F.lower(F.regexp_extract(file_name(url), r"(\.[A-Za-z0-9]+)\z", 1))
    return F.when(label.contains("dof"), "dof").when(label.contains("word") | (suffix == ".doc"), "word").when(suffix == ".pdf", "pdf").otherwise("document")


#: Families of file names of the law's own documents.
LAW_FILES = {"original": r"(?i)^ligie_2022_orig(?:_|$)", "law_reform": r"(?i)^ligie_2022_ref\d+(?:_|$)", "tariff_decree": r"(?i)^ligie_2022_tarifa\d+(?:_|$)"}


def file_category(url: Column) -> Column:
    """The family of a document's file name, or null."""
    stem = F.regexp_replace(file_name(url), r"\.[^.]*\z", "")
    out = F.lit(None).cast("string")
    for name, pattern in LAW_FILES.items():
        out = F.when(stem.rlike(pattern), name).otherwise(out)
    return out


def title_category(title: Column) -> Column:
    """The category of a complementary document by its folded title."""
    return (
        F.when(title.contains("nota") & title.contains("nacional"), "national_notes").when(title.contains("nico") | title.contains("identificacion comercial"), "nico_agreement")
        .when(title.contains("correlacion"), "correlation").otherwise("unknown")
    )


def ledger(pages: DataFrame, *, html: str = "html", url: str = "url") -> DataFrame:
    """Links in the table rows of a legal ledger: the heading above (``section``), the row's text and date, the link's label, role and category."""
    each = pages.select(F.col(url), F.explode(F.filter(anchors(html, url), lambda x: (x["row"] >= 0) & (x["kind"] == "a") & ~x["href"].startswith("#"))).alias("x"))
    rows = each.select(url, F.col("x.row").alias("row"), F.col("x.heading").alias("section"), F.col("x.title").alias("title"), F.col("x.label").alias("label"), F.col("x.target").alias("target"))
    folded = rows.withColumns({"_label": text.fold("label"), "_title": text.fold("title")})
    found = folded.withColumns({
        "role": link_role(F.col("_label"), F.col("target")), "category": F.coalesce(file_category(F.col("target")), title_category(F.col("_title"))),
        "day": F.coalesce(dates.numeric_date(F.col("title")), dates.named_date(F.col("_title"))),
    })
    return found.drop("_label", "_title")
