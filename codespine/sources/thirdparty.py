"""Third-party sheets of fractions: what a classifier's page says of one code and its items, as one row a page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import fold
from .html import file_name, tables

#: An eight-digit code in a cell, the letters of a description, and the length above which a later row's cell is one.
FRACTION = r"(?<!\d)(\d{4}\.?\d{2}\.?\d{2})(?!\d)"
LETTERS = r"[A-Za-zÁÉÍÓÚÜáéíóúüñÑ]"
LONG = 20

NO_CODE, NO_DIGITS, NOT_TOLD, NO_ROW = "the address has no code", "the page has no code", "the page lacks its code", "the page has no row of its code"


def fraction_sheets(pages: DataFrame, *, html: str = "html", url: str = "url") -> DataFrame:
    """``sheet_code``, ``url``, ``description``, ``igi``, ``ige``, ``items`` (token, item, description, igi, ige) and ``error`` of each page.

    The code is that of the address. Its row is the first one with a cell that names it; the description is the next cell with letters, else the
    first long one of a later row of that table, else the row's second cell; duties are its third and fourth cells. Items are the rows of tables whose
    first row says NICO; a token of two digits follows the fraction, one of ten stands for itself, others have a null ``item``. A page that can't be
    read so keeps its row with the ``error``; a null page lacks its code. Nothing is shuffled: a page is read in its own row.
    """
    code = F.regexp_extract(file_name(F.col(url)), r"(\d{8})", 1)
    told = F.contains(F.regexp_replace(F.coalesce(F.col(html), F.lit("")), r"\D", ""), code)
    read = pages.select(F.nullif(code, F.lit("")).alias("sheet_code"), F.col(url).alias("url"), F.coalesce(told, F.lit(False)).alias("_told"), tables(html).alias("_tables"))

    def names(cell: Column) -> Column:
        found = F.regexp_extract_all(cell, F.lit(FRACTION), F.lit(1))
        return F.exists(found, lambda x: F.replace(x, F.lit("."), F.lit("")) == F.col("sheet_code"))

    def tells(cell: Column) -> Column:
        return cell.rlike(LETTERS) & ~names(cell)

    rows = F.flatten(F.transform("_tables", lambda t, i: F.transform(t, lambda r, j: F.struct(i.alias("table"), j.alias("row"), r.alias("cells")))))
    placed = read.withColumn("_rows", rows).withColumn("_hit", F.get(F.filter("_rows", lambda r: F.exists(r["cells"], names)), F.lit(0)))
    place = F.array_position(F.transform("_hit.cells", names), True).cast("int")
    beside = F.get(F.filter(F.slice("_hit.cells", place + 1, F.size("_hit.cells")), tells), F.lit(0))
    below = F.flatten(F.transform(F.filter("_rows", lambda r: (r["table"] == F.col("_hit.table")) & (r["row"] > F.col("_hit.row"))), lambda r: r["cells"]))
    later = F.get(F.filter(below, lambda c: tells(c) & (F.length(c) > LONG)), F.lit(0))
    cell = lambda cells, k: F.get(cells, F.lit(k))
    own = lambda k: cell(F.col("_hit.cells"), k)
    listed = F.filter("_tables", lambda t: F.lower(F.array_join(cell(t, 0), " ")).contains("nico"))
    lines = F.filter(F.flatten(F.transform(listed, lambda t: F.slice(t, 2, F.size(t)))), lambda r: F.size(r) > 1)

    def item(token: Column) -> Column:
        digits = F.regexp_replace(token, r"\D", "")
        return F.when(F.length(digits) == 10, digits).when(F.length(digits) == 2, F.concat("sheet_code", digits))

    items = F.transform(lines, lambda r: F.struct(cell(r, 0).alias("token"), item(cell(r, 0)).alias("item"), cell(r, 1).alias("description"), cell(r, 2).alias("igi"), cell(r, 3).alias("ige")))
    error = F.when(F.col("sheet_code").isNull(), NO_CODE).when(~F.col("_told"), NOT_TOLD).when(F.col("_hit").isNull(), NO_ROW)
    return placed.select(
        "sheet_code", "url", F.coalesce(beside, later, own(1), own(0)).alias("description"), own(2).alias("igi"), own(3).alias("ige"), items.alias("items"), error.alias("error"),
    )


#: Words in the label of a code's row, and the folded labels of both duties.
CODE_LABELS = ("fraccion", "hts code", "codigo")
DUTY_LABELS = {"igi": ("igi", "impuesto general de importacion"), "ige": ("ige", "impuesto general de exportacion")}


def fraction_documents(pages: DataFrame, *, html: str = "html", expected: str | None = None) -> DataFrame:
    """``code``, ``description``, ``igi``, ``ige`` and ``error`` beside the columns of each page of labelled rows.

    The code is that of the column ``expected``, else the first eight digits of the page. Its row is the first one with two cells whose label speaks of
    a code and whose second cell has its digits (described by the third cell, or the last), or whose digits in all are the code and which says
    "fracción" (described by the last). Of rows with the label of a duty the last counts. A page without a code or a row of it keeps its row with the ``error``;
    columns of the page with those names give way.
    """
    own = F.nullif(F.regexp_extract(F.coalesce(F.col(html), F.lit("")), r"(\d{8})", 1), F.lit(""))
    code = F.coalesce(F.nullif(F.col(expected), F.lit("")), own) if expected else own
    made = ("code", "description", "igi", "ige", "error")
    kept = [c for c in pages.columns if c != html and c not in made]
    rows = F.filter(F.flatten(tables(html)), lambda r: F.size(r) > 1)
    read = pages.select(F.struct(*kept, F.lit(None).alias("_none")).alias("_page"), code.alias("_code"), rows.alias("_rows"))
    digits = lambda x: F.regexp_replace(x, r"\D", "")

    def described(r: Column) -> Column:
        label, whole = fold(F.get(r, F.lit(0))), F.array_join(r, " ")
        named = F.exists(F.array(*map(F.lit, CODE_LABELS)), lambda w: label.contains(w)) & (digits(F.get(r, F.lit(1))) == F.col("_code"))
        last = F.element_at(r, -1)
        return F.when(named, F.coalesce(F.get(r, F.lit(2)), last)).when((digits(whole) == F.col("_code")) & fold(whole).contains("fraccion"), last)

    def duty(name: str) -> Column:
        rated = F.filter("_rows", lambda r: fold(F.get(r, F.lit(0))).isin(*DUTY_LABELS[name]))
        return F.try_element_at(F.transform(rated, lambda r: F.get(r, F.lit(1))), F.lit(-1))

    found = read.withColumn("_description", F.get(F.array_compact(F.transform("_rows", described)), F.lit(0)))
    there = F.col("_description").isNotNull()
    error = F.when(F.col("_code").isNull(), NO_DIGITS).when(~there, NO_ROW)
    return found.select(
        *[F.col(f"_page.`{c}`").alias(c) for c in kept], F.col("_code").alias("code"), F.col("_description").alias("description"),
        F.when(there, duty("igi")).alias("igi"), F.when(there, duty("ige")).alias("ige"), error.alias("error"),
    )
