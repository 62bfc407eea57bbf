"""Labelled rows, and a bounded sample of them with their texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Texts of a sample come to the driver as features, so their bytes are bounded too.
MOST_BYTES = 64 << 20


def labelled(labels: DataFrame, label: str, *, allowed: Column | None = None, key: str = "doc_id") -> DataFrame:
    """``key``, ``label`` int: null and other labels than 0 and 1 don't count; of several for one id the largest holds. ``allowed`` says which rows may be learned from."""
    known = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull())
    if allowed is not None:
        known = known.where(allowed)
    return known.groupBy(key).agg(F.max(label).cast("int").alias("label"))


def sample(docs: DataFrame, labels: DataFrame, label: str, *, allowed: Column | None = None, most: int = 8000, most_bytes: int = MOST_BYTES, key: str = "doc_id") -> DataFrame:
    """Rows of ``docs`` with a 0/1 ``label``, ``most`` of them and ``most_bytes`` of their texts at most, chosen by a hash of the id.

    ``allowed`` says which label rows may be learned from. Only the chosen ids are sent to the documents, and ``most``
    bounds them. In the order of the hash, ids whose texts go beyond the bytes left are passed over. Null and other labels don't count; of several labels for
    one id the largest holds.
    """
    one = labelled(labels, label, allowed=allowed, key=key)
    chosen = one.withColumn("h", F.xxhash64(key)).orderBy("h", key).limit(most)
    sizes = docs.select(key, F.octet_length(F.coalesce(F.col("text"), F.lit(""))).cast("long").alias("size")).join(F.broadcast(chosen), key)
    rows = sizes.groupBy(key, "label", "h").agg(F.sum("size").alias("size")).orderBy("h", key).select(key, "label", "size").collect()  # ``most`` numbers
    kept, left = [], most_bytes
    for row in rows:
        if row["size"] <= left:
            kept.append((row[0], row["label"]))
            left -= row["size"]
    few = docs.sparkSession.createDataFrame(kept, f"`{key}` {docs.schema[key].dataType.simpleString()}, label int")
    return docs.select(key, "text").join(F.broadcast(few), key)
