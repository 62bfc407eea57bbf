"""Artefacts and configuration from files: CSV and JSON with a column check, captured texts, the registry of sources."""

from __future__ import annotations

import codecs
import re
from urllib.parse import urlsplit

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..workers import ready


class ArtifactError(ValueError):
    """A file that isn't what its contract says."""


def read_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """All columns as text, empty where there is none. Raises unless the header names exactly these columns in this order, in every file."""
    heads = spark.read.text(path).withColumn("k", F.monotonically_increasing_id()).groupBy(F.input_file_name()).agg(F.min_by("value", "k").alias("head"))
    if not heads.where(F.regexp_replace("head", "\r", "") != ",".join(columns)).isEmpty():
        raise ArtifactError(f"columns of {path} aren't {', '.join(columns)}")
    ddl = ", ".join(f"`{c}` string" for c in columns)
    return spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("emptyValue", "").schema(ddl).csv(path).na.fill("")


def read_json(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """Rows of JSON arrays. Raises where a row lacks one of the columns or has others."""
    want = [f.name for f in spark.createDataFrame([], ddl).schema]
    objects = spark.read.text(path, wholetext=True).select(F.explode_outer(F.from_json("value", "array<map<string, string>>")).alias("o"))
    if not objects.where(F.col("o").isNull() | (F.array_sort(F.map_keys("o")) != F.array(*map(F.lit, sorted(want))))).isEmpty():
        raise ArtifactError(f"objects of {path} don't have the columns {', '.join(want)}")
    return spark.read.option("multiLine", True).schema(ddl).json(path)


@F.pandas_udf(T.StringType())
def _decoded(contents: pd.Series, charsets: pd.Series) -> pd.Series:
    def one(content: bytes, charset: str | None) -> str | None:
        for name in (charset, "utf-8", "cp1252"):
            try:
                return content.decode(codecs.lookup(name).name) if name else None
            except (LookupError, UnicodeDecodeError):
                continue
        return None

    return pd.Series([None if c is None else one(bytes(c), n or "utf-8") for c, n in zip(contents, charsets, strict=True)])


def decoded(content: Column, charset: Column) -> Column:
    """Text of captured bytes, strictly: by the declared charset, else UTF-8, else cp1252; null where none fits."""
    ready()
    return _decoded(content, charset)


def registry(spark: SparkSession, path: str) -> list[dict]:
    """The registered sources of a JSON file. Raises for addresses that aren't https, or lie outside of the entry's hosts, and for repeated keys.

    It is configuration of some dozens of entries, and becomes part of plans.
    """
    ddl = "sources array<struct<dataset_key: string, pages: array<string>, allowed_hosts: array<string>, media_types: array<string>, families: array<struct<role: string, patterns: array<string>>>>>"
    rows = spark.read.option("multiLine", True).schema(ddl).json(path).select(F.explode("sources").alias("s")).select("s.*").collect()
    out = [{**r.asDict(), "families": [(f.role, list(f.patterns)) for f in r.families or []]} for r in rows]
    if len({e["dataset_key"] for e in out}) < len(out):
        raise ArtifactError("a dataset key is registered twice")
    for e in out:
        for page in e["pages"] or []:
            at = urlsplit(page)
            if at.scheme != "https" or at.hostname not in (e["allowed_hosts"] or []):
                raise ArtifactError(f"{page} isn't on a host of {e['dataset_key']}")
        for _, patterns in e["families"]:
            for p in patterns:
                re.compile(p)
    return out
