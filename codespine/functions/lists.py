"""Column functions on lists kept as JSON text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def id_list(text: Column) -> Column:
    """The texts of a JSON array; null where the value is no array or holds anything but texts."""
    value = F.try_parse_json(text)
    kinds = F.from_json(text, "array<string>")
    whole = F.schema_of_variant(value)
    return F.when(whole == "ARRAY<STRING>", kinds).when(whole == "ARRAY<VOID>", F.when(F.size(kinds) == 0, kinds))


def listed(text: Column, item: Column | str) -> Column:
    """Whether a JSON array of texts has an item; false where it is no such array."""
    return F.coalesce(F.array_contains(id_list(text), item), F.lit(False))
