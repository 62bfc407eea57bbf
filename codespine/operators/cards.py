"""Cards of codes as nested records: the record, its section, its ancestors, its children and its chapter's notes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import codes
from .hierarchy import section_chapters
from .search import suggest

FIELDS = ("code", "level", "description")
NOTE = ("note_number", "text", "source_document_id")
#: Fixed value: what every suggestion says of itself.
DISCLAIMER = "This is not a classification. Retrieve-only matches from the official dataset. WCO is not LIGIE/NICO authority."


def record_cards(records: DataFrame, wanted: DataFrame, *, fields: tuple[str, ...] = FIELDS, notes: DataFrame | None = None, chapter: str = "chapter") -> DataFrame:
    """One card for each of the ``wanted`` codes that has a current record.

    ``code``, ``record``, ``formatted_code``, ``section`` (null outside of all), ``hierarchy`` (records from the chapter down to the code itself),
    ``complete`` (no ancestor is missing), ``children`` (direct ones, by code), and with ``notes`` the chapter's ``national_notes`` in their order.
    One explode to prefixes, one join and one group each serve all codes together; there is no query a code. A node has a hundred children at most.
    Codes that come twice have one card; a code with several current records raises no error but has one of equal rank, the least.
    """
    record = F.struct(*fields)
    current = records.where("is_current").groupBy(F.col("code").alias("at")).agg(F.min(record).alias("r"))
    codes_ = wanted.select("code").where("code IS NOT NULL").distinct()
    widths = F.filter(F.array(*map(F.lit, codes.WIDTHS)), lambda w: w <= F.length("code"))
    path = codes_.select("code", F.explode(F.transform(widths, lambda w: F.substring(F.col("code"), F.lit(1), w))).alias("at"))
    chain = path.join(current, "at").groupBy("code").agg(F.array_sort(F.collect_list("r")).alias("hierarchy"), F.max(F.when(F.col("at") == F.col("code"), F.col("r"))).alias("record"))
    up = codes.parent(F.col("at"))
    below = current.where(up.isNotNull()).select(up.alias("code"), "r").join(codes_, "code", "left_semi").groupBy("code").agg(F.array_sort(F.collect_list("r")).alias("children"))
    of = section_chapters(records.sparkSession).select(F.struct("roman", "title").alias("section"), F.col("chapter").alias("_chapter"))
    none = F.array().cast(f"array<{current.schema['r'].dataType.simpleString()}>")
    found = chain.where("record IS NOT NULL").join(below, "code", "left").withColumn("_chapter", F.substring("code", 1, 2)).join(F.broadcast(of), "_chapter", "left")  # 97 rows
    columns: list[Column] = [
        F.col("code"), F.col("record"), codes.formatted(F.col("code")).alias("formatted_code"), F.col("section"), F.col("hierarchy"),
        (F.size("hierarchy") == F.floor(F.length("code") / 2)).alias("complete"), F.coalesce("children", none).alias("children"),
    ]
    if notes is None:
        return found.select(*columns)
    listed = notes_by_chapter(notes, chapter)
    empty = F.array().cast(listed.schema["national_notes"].dataType)
    return found.join(listed, "_chapter", "left").select(*columns, F.coalesce("national_notes", empty).alias("national_notes"))


def notes_by_chapter(notes: DataFrame, chapter: str = "chapter") -> DataFrame:
    """``_chapter`` and its notes as an array in the order of number, scope, source."""
    order = [c for c in ("note_number", "scope_type", "scope_value", "source_document_id") if c in notes.columns]
    placed = F.struct(*[F.struct(F.col(c).isNull(), F.col(c)).alias(f"k{k}") for k, c in enumerate(order)], F.struct(*NOTE).alias("note"))
    rows = notes.groupBy(F.col(chapter).alias("_chapter")).agg(F.array_sort(F.collect_list(placed)).alias("n"))
    return rows.select("_chapter", F.transform("n", lambda x: x["note"]).alias("national_notes"))


def suggestions(records: DataFrame, text: str, *, limit: int = 5, notes: DataFrame | None = None, fields: tuple[str, ...] = FIELDS, folded: str = "folded") -> DataFrame:
    """The suggested codes with rank, score and confidence, their cards, notes and the disclaimer: one plan, no query a hit."""
    hits = suggest(records.where("is_current"), text, limit=limit, folded=folded)
    ranked = hits.select(F.monotonically_increasing_id().alias("_k"), "code", "score", "match_kind", "confidence").coalesce(1)
    placed = ranked.select((F.col("_k") + 1).cast("int").alias("rank"), "code", "score", "match_kind", "confidence")
    cards = record_cards(records, placed, fields=fields, notes=notes)
    return placed.join(cards, "code").withColumn("disclaimer", F.lit(DISCLAIMER))
