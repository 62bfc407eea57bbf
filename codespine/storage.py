"""Tables that operators write for themselves: indexes, numbered rows, rounds of an iteration."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """A new path under ``spark.checkpoint.dir``. A local session without one gets a temporary folder of this process;
    on a cluster that would be one machine's folder, so there it is an error.
    """
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        top = tempfile.mkdtemp(prefix="codespine-")
        atexit.register(shutil.rmtree, top, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", top)
    return f"{top.rstrip('/')}/codespine/{uuid.uuid4().hex}"


def written(df: DataFrame, path: str | None = None, partition_by: list[str] | None = None) -> DataFrame:
    """The rows as Parquet under a shared path, and a scan of them; the files outlive a lost executor."""
    path = path or shared_dir(df.sparkSession)
    out = df.write.partitionBy(*partition_by) if partition_by else df.write
    out.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
