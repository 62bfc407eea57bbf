"""Spreadsheet layouts: header resolution on a bounded probe, then positional reads of rows of cells.

Rows come as ``file``, ``sheet``, ``row`` (from 0) and ``cells`` array<string>, whatever read them. Excel readers aren't part of
Spark; :func:`read_cells` uses openpyxl for xlsx where it is installed, one file in a task.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from io import BytesIO

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import codes, duty

PROBE_ROWS, PROBE_COLUMNS = 20, 30
#: Headers that stand for a field in sheets of no registered family (those are in ``layouts``), most specific first.
ALIASES = {
    "code": ("FRACCION ARANCELARIA", "FRACCION", "CODIGO", "CLAVE"),
    "nico": ("NUMERO DE IDENTIFICACION COMERCIAL", "NICO"),
    "description": ("DESCRIPCION DE LA MERCANCIA", "DESCRIPCION"),
    "unit": ("UNIDAD DE MEDIDA", "UNIDAD", "UM"),
    "igi": ("IMPUESTO DE IMPORTACION", "IMP", "IGI", "ARANCEL"),
    "ige": ("IMPUESTO DE EXPORTACION", "EXP", "IGE"),
}


class LayoutError(ValueError):
    """A sheet whose headers are missing or ambiguous."""


@dataclass(frozen=True)
class Layout:
    """Index of each field's column, and the first row of data."""

    columns: dict[str, int]
    first_row: int


def _key(cell: str | None) -> str:
    plain = "".join(c for c in unicodedata.normalize("NFKD", cell or "") if not unicodedata.combining(c))
    return " ".join(re.sub(r"[^A-Z0-9]+", " ", plain.upper()).split())


def resolve(probe: list[list[str]], needed: tuple[str, ...] = ("code", "description")) -> Layout:
    """The layout of a sheet from its first rows, by header alone, of one row or of two rows read together."""
    for at, cells in enumerate(probe):
        for height in (1, 2):
            under = probe[at + 1] if height == 2 and at + 1 < len(probe) else []
            heads = [_key(" ".join(x for x in (c, under[i] if i < len(under) else "") if x)) for i, c in enumerate(cells)]
            columns: dict[str, int] = {}
            for field, names in ALIASES.items():
                for name in names:
                    hits = [i for i, h in enumerate(heads) if h == name]
                    if len(hits) > 1:
                        raise LayoutError(f"{name} heads more than one column")
                    if hits:
                        columns.setdefault(field, hits[0])
                        break
            if all(f in columns for f in needed):
                return Layout(columns, at + height)
    raise LayoutError(f"no row of the probe has headers for {', '.join(needed)}")


def probe(rows: DataFrame) -> list[list[str]]:
    """The first rows and columns of one sheet: at most 20 by 30 cells come to the driver."""
    some = rows.where(F.col("row") < PROBE_ROWS).orderBy("row").select(F.slice("cells", 1, PROBE_COLUMNS)).collect()
    return [[c or "" for c in r[0]] for r in some]


def fields(rows: DataFrame, layout: Layout) -> DataFrame:
    """Named columns of the data rows; short rows are padded with null, blank rows left out, row numbers kept."""
    data = rows.where((F.col("row") >= layout.first_row) & F.exists("cells", lambda c: F.trim(c) != ""))
    return data.select(*[c for c in rows.columns if c != "cells"], *[F.try_element_at("cells", F.lit(i + 1)).alias(name) for name, i in layout.columns.items()])


def cell_text(number: Column) -> Column:
    """A numeric cell as text; whole numbers have no decimals."""
    return F.when(number == F.floor(number), F.floor(number).cast("string")).otherwise(number.cast("string"))


def tariff_rows(named: DataFrame) -> DataFrame:
    """Eight-digit fractions with parsed duties; other rows are left out."""
    out = named.withColumn("code", codes.ingest_digits(F.col("code"))).where(F.length("code") == 8)
    for side in ("igi", "ige"):
        if side in named.columns:
            parts = duty.parsed(F.col(side))
            out = out.withColumns({f"{side}_text": parts["literal"], f"{side}_kind": parts["kind"], f"{side}_value": parts["value"]})
    return out


def item_rows(named: DataFrame) -> DataFrame:
    """Ten-digit items from one column of ten digits, or from a fraction and its two-digit part."""
    whole = codes.ingest_digits(F.col("nico"))
    parts = F.concat(codes.ingest_digits(F.col("code")), codes.ingest_digits(F.col("nico"), 2))
    return named.withColumn("item", F.coalesce(F.when(F.length(whole) == 10, whole), parts)).where(F.length("item") == 10)


def read_cells(spark: SparkSession, path: str) -> DataFrame:
    """Cells of xlsx files; raises in the task where openpyxl isn't installed."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import openpyxl

        for batch in batches:
            for file, content in zip(batch["path"], batch["content"], strict=True):
                book = openpyxl.load_workbook(BytesIO(content), read_only=True, data_only=True)
                for sheet in book.worksheets:
                    rows = [(file, sheet.title, k, [None if c is None else str(int(c)) if isinstance(c, float) and c.is_integer() else str(c) for c in r]) for k, r in enumerate(sheet.iter_rows(values_only=True))]
                    yield pd.DataFrame(rows, columns=["file", "sheet", "row", "cells"])

    raw = spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").load(path).select("path", "content")
    return raw.mapInPandas(run, "file string, sheet string, row int, cells array<string>")
