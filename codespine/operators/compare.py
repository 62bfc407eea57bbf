"""Records against third-party sheets, for a whole batch of codes in one plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import duty, text
from .evaluate import first_of_each

LEVELS = ("hs6", "fraccion8", "nico10")
#: Field, the record's column and the sheet's.
FIELDS = (("description", "description", "description"), ("igi", "igi_text", "igi"), ("ige", "ige_text", "ige"))

NO_PAGE, NO_SHEET = "sheets are of eight digits; the fractions below are compared", "no sheet of the fraction"
NO_ITEM, NO_FRACTION, NO_RECORD = "the sheet has no row of the item", "no record of the item's fraction", "no record of six, eight or ten digits"


def agrees(field: str, ours: Column, theirs: Column) -> Column:
    """Whether both say the same: null where neither says anything, false where one does. Descriptions by their tokens, duties by their comparable form."""
    a, b = text.fold(ours), text.fold(theirs)
    same = text.consistent(a, b) if field == "description" else duty.comparable(a) == duty.comparable(b)
    return F.when(ours.isNull() & theirs.isNull(), F.lit(None).cast("boolean")).when(ours.isNull() | theirs.isNull(), F.lit(False)).otherwise(same)


def third_party(records: DataFrame, sheets: DataFrame, asked: DataFrame) -> DataFrame:
    """``asked``, ``code``, ``level``, ``field``, ``ours``, ``theirs``, ``match``, ``note`` for each asked code (``asked``: ``code``).

    A fraction is compared with its sheet, and so are its items; an item with its row in its fraction's sheet; six digits have one row without a match,
    and those of all fractions below. A fraction without a sheet, or with one that has an error, has one row (``present``), and its items none unless
    they are asked themselves. An item without a record of its fraction, and an asked code without a record of the three levels, have a row that says so.
    ``records`` (code, level, description, igi_text, ige_text) are those in force; ``sheets`` are of ``fraction_sheets``; of several for a code the first
    address without an error counts. Only what is asked meets the sheets: the records go to the codes that can ask for them, by equal keys.
    """
    code = F.col("code")
    mine = records.where(F.col("level").isin(*LEVELS)).select("code", "level", *[c for _, c, _ in FIELDS])
    above = F.array_distinct(F.filter(F.array(code, F.substring("code", 1, 8), F.substring("code", 1, 6)), lambda k: F.length(k).isin(6, 8, 10)))
    wanted = asked.select(code.alias("asked")).where("asked IS NOT NULL").distinct()
    there = mine.select(code.alias("asked"))
    known = wanted.join(there, "asked", "left_semi")
    keyed = mine.withColumn("sheet_code", F.when(F.col("level") != "hs6", F.substring("code", 1, 8))).withColumn("asked", F.explode(above)).join(known, "asked")
    first = first_of_each(sheets.where("sheet_code IS NOT NULL"), ["sheet_code"], [F.col("error").isNotNull().asc(), F.col("url").asc()])
    of = first.select("sheet_code", F.struct("description", "igi", "ige", "items", "error").alias("_s"))
    fractions = mine.where("level = 'fraccion8'").select(code.alias("sheet_code"), F.lit(True).alias("_fraction")).distinct()
    rows = keyed.join(of, "sheet_code", "left").join(fractions, "sheet_code", "left")

    is_item = F.col("level") == "nico10"
    row = F.when(is_item, F.get(F.filter("_s.items", lambda x: x["item"] == code), F.lit(0)))
    rows = rows.withColumn("_i", row)

    def line(field: str, ours: Column, theirs: Column, match: Column, note: Column) -> Column:
        return F.struct(F.lit(field).alias("field"), ours.cast("string").alias("ours"), theirs.cast("string").alias("theirs"), match.cast("boolean").alias("match"), note.alias("note"))

    def present(match: bool | None, note: Column) -> Column:
        return F.array(line("present", F.lit("yes"), F.lit(None), F.lit(match), note))

    def compared(name: str, ours: str, theirs: str) -> Column:
        other = F.when(is_item, F.col(f"_i.{theirs}")).otherwise(F.col(f"_s.{theirs}"))
        return line(name, F.col(ours), other, agrees(name, F.col(ours), other), F.lit(""))

    failed = F.col("_s").isNull() | F.col("_s.error").isNotNull()
    alone = is_item & (F.col("_fraction").isNull() | failed)
    lines = (
        F.when(F.col("level") == "hs6", F.array(line("description", F.col("description"), F.lit(None), F.lit(None), F.lit(NO_PAGE))))
        .when(is_item & F.col("_fraction").isNull(), present(None, F.lit(NO_FRACTION)))
        .when(F.col("_s").isNull(), present(None, F.lit(NO_SHEET)))
        .when(F.col("_s.error").isNotNull(), present(False, F.col("_s.error")))
        .when(is_item & F.col("_i").isNull(), present(False, F.lit(NO_ITEM)))
        .otherwise(F.array(*[compared(*f) for f in FIELDS]))
    )
    out = rows.where(~alone | (F.col("asked") == code)).select("asked", "code", "level", F.explode(lines).alias("_l")).select("asked", "code", "level", "_l.*")
    none = wanted.join(there, "asked", "left_anti").select("asked", F.col("asked").alias("code"), F.lit(None).cast("string").alias("level"), line("code", F.lit(None), F.lit(None), F.lit(None), F.lit(NO_RECORD)).alias("_l"))
    return out.unionByName(none.select("asked", "code", "level", "_l.*"))
