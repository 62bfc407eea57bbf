"""Checks of raw pages by windows over their tags, and discovery of pages over links in bounded rounds.

Tags come from the text by pattern, in the JVM: comments, scripts and styles are cut first. A page's tags are one window partition, so a page is checked as a
whole and pages are checked in parallel.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..storage import written
from .html import links

#: The least size of a page, and elements of which one has to be there.
MIN_BYTES = 256
MARKERS = ("<html", "<body", "<table")
#: What is cut before tags are read, and how a tag is found.
SILENT = (r"(?s)<!--.*?-->", r"(?is)<script\b.*?</script\s*>", r"(?is)<style\b.*?</style\s*>")
TAG = r"<(/?[A-Za-z][A-Za-z0-9]*)"
#: Elements that have to be closed; others may stand open.
PAIRED = ("html", "head", "body", "title", "table", "div", "article", "section", "nav", "ul", "ol", "a", "b", "i", "span", "h1", "h2", "h3", "h4", "h5", "h6")
REASONS = ("small", "not_html", "unbalanced", "crossed", "heading_skipped")


def tags(pages: DataFrame, *, key: str = "page_id", html: str = "html") -> DataFrame:
    """``key``, ``position``, ``tag`` (lower case), ``step``: 1 where an element that has to be closed opens, -1 where it closes."""
    body = F.coalesce(F.col(html), F.lit(""))
    for pattern in SILENT:
        body = F.regexp_replace(body, pattern, " ")
    each = pages.select(key, F.posexplode(F.regexp_extract_all(body, F.lit(TAG), 1)).alias("position", "t"))
    named = each.select(key, "position", F.lower(F.ltrim(F.col("t"), F.lit("/"))).alias("tag"), F.when(F.col("t").startswith("/"), -1).otherwise(1).alias("step"))
    return named.where(F.col("tag").isin(*PAIRED))


def verdicts(pages: DataFrame, *, key: str = "page_id", html: str = "html") -> DataFrame:
    """``key``, ``n_tags``, ``depth`` (the deepest nesting), ``reason``: the first rule that the page breaks, or ``ok``.

    small: fewer bytes than a page has; not_html: no marker; unbalanced: an element closes before it opens, or stays open; crossed: an element is closed
    where another one is open inside it; heading_skipped: a heading is more than one level below the heading before. A null page is small. Keys name pages.
    """
    events = tags(pages, key=key, html=html)
    order = Window.partitionBy(key).orderBy("position")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    heading = F.when(F.col("tag").rlike(r"\Ah[1-6]\z") & (F.col("step") == 1), F.substring("tag", 2, 1).cast("int"))
    own = Window.partitionBy(key, "tag").orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    deep = events.withColumns({"open": F.sum("step").over(own), "depth": F.sum("step").over(so_far), "heading": heading})
    before = F.last("heading", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))
    placed = deep.withColumns({"level": F.when(F.col("step") == 1, F.col("depth")).otherwise(F.col("depth") + 1), "skips": F.coalesce(F.col("heading") > before + 1, F.lit(False))})
    matched = placed.withColumn("partner", F.lag("tag").over(Window.partitionBy(key, "level").orderBy("position")))
    crossed = (F.col("step") == -1) & ~F.col("partner").eqNullSafe(F.col("tag"))
    each = matched.groupBy(key).agg(
        F.count("*").alias("n_tags"), F.max("depth").alias("depth"), F.min("open").alias("low"), F.sum("step").alias("left"),
        F.max(crossed).alias("crossed"), F.max("skips").alias("skips"),
    )
    stays = deep.groupBy(key, "tag").agg(F.sum("step").alias("n")).groupBy(key).agg(F.max(F.abs("n")).alias("stays"))
    body = F.lower(F.coalesce(F.col(html), F.lit("")))
    marker = F.lit(False)
    for m in MARKERS:
        marker = marker | body.contains(m)
    looked = pages.select(key, (F.octet_length(F.coalesce(F.col(html), F.lit(""))) < MIN_BYTES).alias("small"), (~marker).alias("odd"))
    both = looked.join(each, key, "left").join(stays, key, "left")
    reason = F.when(F.col("small"), "small").when(F.col("odd"), "not_html").when((F.col("low") < 0) | (F.col("stays") > 0), "unbalanced").when(F.col("crossed"), "crossed").when(F.col("skips"), "heading_skipped").otherwise("ok")
    return both.select(key, F.coalesce("n_tags", F.lit(0)).alias("n_tags"), F.coalesce("depth", F.lit(0)).cast("bigint").alias("depth"), reason.alias("reason"))


def discovered(pages: DataFrame, seeds: DataFrame, *, rounds: int, html: str = "html", url: str = "url", targets: DataFrame | None = None) -> DataFrame:
    """``url``, ``depth``: addresses that links lead to from the seeds in at most ``rounds`` steps, each with its least number of steps.

    Links are read once. A round joins its frontier to them and drops what was seen by an anti join; each round is written, so lineage stays
    short, and an empty one ends the search. ``targets`` (``url``, ``target``) stands for the links of pages where they are known.
    """
    found = targets if targets is not None else links(pages, html=html, url=url).select(F.col(url).alias("url"), "target")
    edges = written(found.where("target IS NOT NULL").distinct())
    frontier = written(seeds.select(F.col(url).alias("url")).where("url IS NOT NULL").distinct().withColumn("depth", F.lit(0)))
    seen = frontier
    for depth in range(1, rounds + 1):
        new = edges.join(frontier, "url").select(F.col("target").alias("url")).distinct().join(seen, "url", "left_anti")
        frontier = written(new.withColumn("depth", F.lit(depth)))
        if frontier.isEmpty():
            break
        seen = seen.unionByName(frontier)
    return seen
