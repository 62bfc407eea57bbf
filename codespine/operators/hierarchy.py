"""Operators on code trees: nodes, children, ancestors, cards, sections, orphans, lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import codes

#: The sections of the harmonised system with their chapters.
SECTIONS = (
    ("I", "Animales vivos y productos del reino animal", 1, 5),
    ("II", "Productos del reino vegetal", 6, 14),
    ("III", "Grasas y aceites animales, vegetales o de origen microbiano", 15, 15),
    ("IV", "Productos de las industrias alimentarias", 16, 24),
    ("V", "Productos minerales", 25, 27),
    ("VI", "Productos de las industrias químicas o de las industrias conexas", 28, 38),
    ("VII", "Plástico y caucho, y sus manufacturas", 39, 40),
    ("VIII", "Pieles, cueros, peletería y manufacturas", 41, 43),
    ("IX", "Madera, carbón vegetal, corcho y cestería", 44, 46),
    ("X", "Pasta de madera, papel y cartón", 47, 49),
    ("XI", "Materias textiles y sus manufacturas", 50, 63),
    ("XII", "Calzado, sombreros, paraguas y similares", 64, 67),
    ("XIII", "Manufacturas de piedra, productos cerámicos y vidrio", 68, 70),
    ("XIV", "Perlas, piedras y metales preciosos; bisutería", 71, 71),
    ("XV", "Metales comunes y manufacturas de estos metales", 72, 83),
    ("XVI", "Máquinas, aparatos y material eléctrico", 84, 85),
    ("XVII", "Material de transporte", 86, 89),
    ("XVIII", "Instrumentos de óptica, medida, relojería y música", 90, 92),
    ("XIX", "Armas, municiones, y sus partes y accesorios", 93, 93),
    ("XX", "Mercancías y productos diversos", 94, 96),
    ("XXI", "Objetos de arte o colección y antigüedades", 97, 97),
)


class QueryError(ValueError):
    """A question that can't be asked of the data set."""


def chapter_code(chapter: str) -> str:
    if not (isinstance(chapter, str) and len(chapter) == 2 and chapter.isascii() and chapter.isdigit()):
        raise QueryError("a chapter has exactly two digits")
    return chapter


def sections(spark: SparkSession) -> DataFrame:
    rows = [(k, roman, title, f"{a:02d}", f"{b:02d}") for k, (roman, title, a, b) in enumerate(SECTIONS, 1)]
    return spark.createDataFrame(rows, "ordinal int, roman string, title string, chapter_from string, chapter_to string")


def section_chapters(spark: SparkSession) -> DataFrame:
    """The sections' ranges as one row for each chapter (97 rows), so that chapters join by equality."""
    span = F.sequence(F.col("chapter_from").cast("int"), F.col("chapter_to").cast("int"))
    return sections(spark).select("roman", "title", F.explode(F.transform(span, lambda c: F.lpad(c.cast("string"), 2, "0"))).alias("chapter"))


def with_section(df: DataFrame, chapter: Column) -> DataFrame:
    """Adds ``section``; null for chapters outside of all."""
    of = section_chapters(df.sparkSession).select(F.col("roman").alias("section"), F.col("chapter").alias("_chapter"))
    return df.withColumn("_chapter", chapter).join(F.broadcast(of), "_chapter", "left").drop("_chapter")  # 97 rows


def prefix_tree(leaves: DataFrame, code: str, *aggregates: Column) -> DataFrame:
    """Every prefix of the leaves' codes as a node: ``code``, ``level`` and the aggregates over its leaves.

    One pass: each leaf goes to its prefixes, and equal prefixes are combined before the shuffle.
    """
    widths = F.filter(F.array(*map(F.lit, codes.WIDTHS)), lambda w: w <= F.length(code))
    spread = leaves.withColumn("_node", F.explode(F.transform(widths, lambda w: F.substring(F.col(code), F.lit(1), w))))
    return spread.groupBy(F.col("_node").alias("code")).agg(*aggregates).withColumn("level", codes.level(F.col("code")))


def level_counts(nodes: DataFrame) -> DataFrame:
    """Nodes of each of the five levels, levels without any included."""
    every = nodes.sparkSession.createDataFrame([(name,) for name in codes.LEVELS.values()], "level string")
    return every.join(nodes.groupBy("level").agg(F.count("*").alias("n")), "level", "left").select("level", F.coalesce("n", F.lit(0)).alias("n"))


def children(nodes: DataFrame, code: str) -> DataFrame:
    """Direct children of a node: a prefix and a length, both of which reach the scan."""
    width = codes.CHILD_WIDTH.get(len(code))
    if width is None:
        return nodes.limit(0)
    return nodes.where(F.col("code").startswith(code) & (F.length("code") == width)).orderBy("code")


def child_lists(nodes: DataFrame) -> DataFrame:
    """``parent``, ``n_children``, ``children_json`` of every node that has children; a node has a hundred at most."""
    up = codes.parent(F.col("code"))
    return nodes.where(up.isNotNull()).groupBy(up.alias("parent")).agg(F.count("*").alias("n_children"), F.to_json(F.array_sort(F.collect_list("code"))).alias("children_json"))


def ancestors(nodes: DataFrame) -> DataFrame:
    """``code`` and each of its ancestors in the tree, joined by equality on prefixes."""
    widths = F.filter(F.array(*map(F.lit, codes.WIDTHS)), lambda w: w < F.length("code"))
    pairs = nodes.select("code", F.explode(F.transform(widths, lambda w: F.substring(F.col("code"), F.lit(1), w))).alias("ancestor"))
    return pairs.join(nodes.select(F.col("code").alias("ancestor")).distinct(), "ancestor").select("code", "ancestor")


def cards(nodes: DataFrame) -> DataFrame:
    """Every node with its section, parent, ancestors (root first) and number of children."""
    chain = ancestors(nodes).groupBy("code").agg(F.to_json(F.array_sort(F.collect_list("ancestor"))).alias("ancestors_json"))
    below = child_lists(nodes).select(F.col("parent").alias("code"), "n_children")
    both = nodes.join(chain, "code", "left").join(below, "code", "left")
    out = with_section(both, F.substring("code", 1, 2))
    return out.withColumns({"parent": codes.parent(F.col("code")), "ancestors_json": F.coalesce("ancestors_json", F.lit("[]")), "n_children": F.coalesce("n_children", F.lit(0))})


def orphans(nodes: DataFrame) -> DataFrame:
    """Nodes below the top whose parent isn't there."""
    up = nodes.withColumn("parent", codes.parent(F.col("code"))).where(F.col("parent").isNotNull())
    return up.join(nodes.select(F.col("code").alias("parent")), "parent", "left_anti")


def lookup(records: DataFrame, code: str) -> DataFrame:
    """The one current record of a code. Raises if there is none or more than one; reads two rows at most."""
    digits = "".join(c for c in code if c not in ".- \t")
    if not (digits.isascii() and digits.isdigit() and len(digits) in codes.LEVELS):
        raise QueryError(f"not a code: {code!r}")
    found = records.where((F.col("code") == digits) & F.col("is_current")).limit(2)
    rows = found.collect()  # two at most
    if len(rows) != 1:
        raise QueryError(f"several current records of {digits}" if rows else f"no current records of {digits}")
    return records.sparkSession.createDataFrame(rows, found.schema)


def chapters(records: DataFrame) -> DataFrame:
    """Current chapters in order. Raises where a chapter is there twice."""
    found = records.where((F.col("level") == "hs2") & F.col("is_current"))
    if not found.groupBy("code").count().where("count > 1").isEmpty():
        raise QueryError("a chapter has more than one current record")
    return found.orderBy("code")


def deduplicated(rows: DataFrame, key: str) -> DataFrame:
    """Repeated rows once. Raises where one key has different rows."""
    others = [c for c in rows.columns if c != key]
    clash = rows.groupBy(key).agg(F.count_distinct(F.struct(*others)).alias("n")).where("n > 1")
    if not clash.isEmpty():
        raise QueryError(f"conflicting rows for one {key}")
    return rows.dropDuplicates([key])


def forward_filled(df: DataFrame, value: str, *, order: list[Column], partition: list[str]) -> DataFrame:
    """Blank cells take the last value above them."""
    w = Window.partitionBy(*partition).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(value, F.last(F.when(F.trim(value) != "", F.col(value)), ignorenulls=True).over(w))


def in_level_order(df: DataFrame) -> DataFrame:
    """Parents before children: by level from the top, then by code; unknown levels last."""
    rank = F.array_position(F.array(*map(F.lit, codes.LEVELS.values())), F.col("level"))
    return df.orderBy(F.asc_nulls_last(F.nullif(rank, F.lit(0))), F.asc_nulls_last("code"))


#: The table that holds each level.
TABLE_OF = {"hs2": "hs_version", "hs4": "hs_version", "hs6": "hs_version", "fraccion8": "fraction_version", "nico10": "nico_version"}


def routed(df: DataFrame) -> DataFrame:
    """Adds ``table``: where rows of a level are kept; null for a level without one. Writing partitioned by it routes all rows in one pass."""
    return df.withColumn("table", F.element_at(F.create_map(*[F.lit(x) for pair in TABLE_OF.items() for x in pair]), F.col("level")))
