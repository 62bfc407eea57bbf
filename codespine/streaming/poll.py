"""Polling for changed sources as a stream: new identity files are compared with the last known state.

Each micro-batch of observed identities is diffed against a small state table (one row for each source key) and the
changes are appended; a batch without changes writes nothing. With ``availableNow`` a scheduled run takes in what has
arrived since the last one and ends.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.diff import snapshot_diff
from ..operators.evaluate import first_of_each
from ..plans.serving import _exists

IDENTITY = "dataset_key string, document_role string, source_url string, sha256 string, observed_at timestamp"
KEYS = ["dataset_key", "document_role"]
VALUES = ["source_url", "sha256"]


def apply_batch(batch: DataFrame, state: str, changes: str, number: int) -> None:
    """Appends the batch's changes and replaces the state; doing a batch again gives the same state."""
    spark = batch.sparkSession
    newest = first_of_each(batch, KEYS, [F.desc("observed_at"), F.asc("source_url"), F.asc("sha256")])
    folders = sorted((int(p.rsplit("=", 1)[1]) for p in _folders(spark, state)), reverse=True)
    last = next((k for k in folders if k < number), None)
    known = spark.read.schema(IDENTITY).parquet(f"{state}/batch={last}") if last is not None else spark.createDataFrame([], IDENTITY)
    found = snapshot_diff(known, newest, KEYS, VALUES).where("change <> 'removed'").withColumn("batch", F.lit(number))
    found.write.mode("overwrite").parquet(f"{changes}/batch={number}")
    rest = known.join(newest.select(*KEYS), KEYS, "left_anti")
    rest.unionByName(newest.select(*rest.columns)).write.mode("overwrite").parquet(f"{state}/batch={number}")


def _folders(spark: SparkSession, path: str) -> list[str]:
    if not _exists(spark, path):
        return []
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return [str(f.getPath().getName()) for f in p.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(p) if "batch=" in f.getPath().getName()]


def poll(spark: SparkSession, source: str, state: str, changes: str, checkpoint: str) -> StreamingQuery:
    """Starts the stream over JSON files of identities; it ends when all that is there has been taken in."""
    rows = spark.readStream.schema(IDENTITY).json(source)
    writer = rows.writeStream.foreachBatch(lambda batch, number: apply_batch(batch, state, changes, number))
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
