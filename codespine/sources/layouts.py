"""Layouts of spreadsheets by registered family, for all files of a table in one plan.

``probes`` has the first rows of each sheet: ``file``, ``sheet``, ``sheet_at`` (its place in the file), ``row`` (from 1, without gaps), ``cells``.
Each row is a candidate header where every required field has one heading; the row below may add missing rates. A file's layout is the
candidate with most fields. Whatever can't be told is the file's ``error``, never a guess and never another file's failure.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import codes, text
from .sheets import PROBE_COLUMNS, PROBE_ROWS

#: The headings of each family's fields, required and optional, and the version of the layout.
FAMILIES = {
    "ligie_snapshot": (
        {"code": ("FRACCION", "FRACCION ARANCELARIA"), "description": ("DESCRIPCION",)},
        {"unit_name": ("UNIDAD", "UNIDAD DE MEDIDA", "UMT"), "igi": ("IGI", "IMP", "IMPORT", "IMPORTACION"), "ige": ("IGE", "EXP", "EXPORT", "EXPORTACION")},
        "ligie-profile-1",
    ),
    "nico_snapshot": ({"fraccion8": ("FRACCION", "FRACCION ARANCELARIA"), "nico2": ("NICO",), "description": ("DESCRIPCION", "DESCRIPCION NICO")}, {}, "nico-profile-1"),
}
RATES = ("igi", "ige")


def probed(rows: DataFrame) -> DataFrame:
    """The rows and columns of each sheet that a layout may be read from; ``row`` from 1."""
    return rows.where(F.col("row").between(1, PROBE_ROWS)).withColumn("cells", F.slice("cells", 1, PROBE_COLUMNS))


def places(keys: Column, headings: tuple[str, ...]) -> Column:
    """Where a field's headings stand."""
    return F.filter(F.transform(keys, lambda k, i: F.when(k.isin(*headings), i)), lambda i: i.isNotNull())


def _any(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def candidates(probes: DataFrame, family: str) -> DataFrame:
    """The rows with ``columns`` (field to heading and index; null where the row is no header), ``data_row`` and ``error`` (null where there is none).

    Fields are asked in their order: a required one that is missing ends the row, so a repeated heading behind it is no error.
    """
    if family not in FAMILIES:
        raise ValueError(f"unknown workbook profile: {family}")
    required, optional, _ = FAMILIES[family]
    fields = {**required, **optional}
    sheet = Window.partitionBy("file", "sheet_at").orderBy("row")
    keyed = probes.withColumn("_keys", F.transform("cells", lambda c: text.header_key(c)))
    rows = keyed.withColumns({"_below": F.lead("cells").over(sheet), "_below_keys": F.lead("_keys").over(sheet)})
    rows = rows.withColumns({f"_{name}": places(F.col("_keys"), headings) for name, headings in fields.items()})
    n = {name: F.size(f"_{name}") for name in fields}
    reached, repeated = F.lit(True), []
    for name in fields:
        repeated.append(F.when(reached & (n[name] > 1), name))
        if name in required:
            reached = reached & (n[name] == 1)
    twice = F.coalesce(*repeated)
    header = twice.isNull() & reached
    rows = rows.withColumns({"_twice": twice, "_header": header})
    if "igi" in fields:
        lower = {r: places(F.col("_below_keys"), fields[r]) for r in RATES}
        missing = {r: n[r] == 0 for r in RATES}
        rows = rows.withColumns({f"_{r}_below": F.when(missing[r], lower[r]) for r in RATES})
        asked = F.col("_header") & (missing["igi"] | missing["ige"]) & F.col("_below").isNotNull()
        again = F.coalesce(*[F.when(asked & (F.size(f"_{r}_below") > 1), r) for r in RATES])
        merged = asked & again.isNull() & ~_any([missing[r] & (F.size(f"_{r}_below") != 1) for r in RATES])
        under = F.get("_below", F.get("_code", F.lit(0)))
        data = (F.get("_code", F.lit(0)) >= F.size("_below")) | F.coalesce(F.length(codes.ingest_digits(under)) == 8, F.lit(False))
        rows = rows.withColumns({"_again": again, "_merged": merged})
        rows = rows.withColumn("_open", asked & F.col("_again").isNull() & ~F.col("_merged") & ~data)
    else:
        rows = rows.withColumns({"_again": F.lit(None).cast("string"), "_merged": F.lit(False), "_open": F.lit(False)})

    def entry(name: str) -> Column:
        of = lambda cells, at: F.struct(F.lit(name).alias("key"), F.struct(F.get(cells, at).alias("heading"), at.alias("index")).alias("value"))
        own = F.when(n[name] == 1, of(F.col("cells"), F.get(f"_{name}", F.lit(0))))
        return F.coalesce(own, F.when(F.col("_merged"), of(F.col("_below"), F.get(f"_{name}_below", F.lit(0))))) if name in RATES and "igi" in fields else own

    error = (
        F.when(F.col("_twice").isNotNull(), F.concat(F.lit(f"ambiguous workbook profile: {family}; logical="), "_twice"))
        .when(F.col("_again").isNotNull(), F.concat(F.lit(f"ambiguous workbook profile: {family}; logical="), "_again"))
        .when(F.col("_open"), f"unresolved two-row tariff header: {family}")
    )
    columns = F.when(F.col("_header") & error.isNull(), F.map_from_entries(F.array_compact(F.array(*map(entry, fields)))))
    return rows.select(*probes.columns, columns.alias("columns"), (F.col("row") + 1 + F.col("_merged").cast("int")).alias("data_row"), error.alias("error"))


def layouts(probes: DataFrame, family: str) -> DataFrame:
    """One row for each file: ``file``, ``family``, ``parser_version``, ``sheet``, ``header_row``, ``data_row``, ``columns``, ``error``.

    The first row with an error, in the order of sheets and rows, is the file's error. Files without a header, and files whose best candidates are several, have an error too.
    """
    rows = candidates(probes, family)
    size = F.size("columns")
    one = F.struct(size.alias("n"), "sheet", F.col("row").alias("header_row"), "data_row", "columns")
    files = rows.groupBy("file").agg(
        F.min(F.when(F.col("error").isNotNull(), F.struct("sheet_at", "row", F.concat("error", F.lit("; location="), "sheet", F.lit("!"), F.col("row").cast("string")).alias("error")))).alias("_e"),
        F.collect_list(F.when(F.col("columns").isNotNull(), one)).alias("_c"),  # rows of a probe at most
    )
    most = F.array_max(F.transform("_c", lambda c: c["n"]))
    best = files.withColumn("_c", F.filter("_c", lambda c: c["n"] == most))
    error = F.coalesce(F.col("_e.error"), F.when(F.size("_c") == 0, f"unknown workbook profile: {family}").when(F.size("_c") > 1, f"ambiguous workbook profile: {family}"))
    chosen = best.withColumn("error", error).withColumn("_l", F.when(F.col("error").isNull(), F.get("_c", F.lit(0))))
    return chosen.select("file", F.lit(family).alias("family"), F.lit(FAMILIES[family][2]).alias("parser_version"), *[F.col(f"_l.{c}").alias(c) for c in ("sheet", "header_row", "data_row", "columns")], "error")


def read(rows: DataFrame, found: DataFrame, family: str) -> DataFrame:
    """The data rows of all files that have a layout, with the family's fields by name; blank rows are left out, short rows padded with null.

    Layouts are as many as files, so they join by file and sheet; nothing is read a file at a time.
    """
    required, optional, _ = FAMILIES[family]
    of = found.where("error IS NULL").select("file", "sheet", "data_row", "columns")
    data = rows.join(of, ["file", "sheet"]).where((F.col("row") >= F.col("data_row")) & F.exists("cells", lambda c: F.trim(c) != ""))
    return data.select("file", "sheet", "row", *[F.get("cells", F.element_at("columns", name)["index"]).alias(name) for name in (*required, *optional)])
