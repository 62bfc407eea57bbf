"""Helpers shared by the operators: table access, written intermediate tables, batch iteration."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import workers

ROWS_AT_ONCE = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data folder; only Spark's reader touches the path."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ready(spark: SparkSession) -> None:
    """Prepares the session for Python workers.

    The package is sent to them, and imported by name, so that their word caches outlive a task. Arrow batches get a bound in rows and bytes.
    """
    workers.ready(spark)


#: Of this process, by module: what its operators keep between tasks.
_KEPT: dict[str, list[dict]] = {}


def sole(owner: str, *caches: dict) -> None:
    """Empties what other modules keep: a worker outlives its operator, and would hold the vocabularies and words of all that it ever served."""
    _KEPT[owner] = list(caches)
    for other, held in _KEPT.items():
        if other != owner:
            for cache in held:
                cache.clear()


def shared_dir(spark: SparkSession) -> str:
    """A new path under ``spark.checkpoint.dir``. A local session without one (tests) gets a temporary folder of this process;
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


#: Rows may be megabytes, so row groups are closed by their bytes from the first row on (by default from the hundredth), and writers and readers hold little.
ROW_GROUPS = {"parquet.block.size": 32 << 20, "parquet.page.size.row.check.min": 1, "parquet.block.size.row.check.min": 1}


def written(df: DataFrame, codec: str = "zstd") -> DataFrame:
    """Cuts the lineage: writes the rows as Parquet to the shared folder and returns a scan of them.

    Unlike a cached block the files survive a lost executor.
    """
    spark, schema = df.sparkSession, df.schema
    path = shared_dir(spark)
    df.write.options(compression=codec, **ROW_GROUPS).parquet(path)
    return spark.read.schema(schema).parquet(path)


def in_few(df: DataFrame, rows: int, each: int) -> DataFrame:
    """``df``, of some ``rows`` rows, in tasks of about ``each`` of them, or one for each core: small tables become few files.

    Its tasks are put together without a shuffle, so there are never more than it has.
    """
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // each)))


def text_bytes(name: str = "text") -> Column:
    """UTF-8 bytes of a text column; null is empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary")


def remainder(name: str, by: int) -> Column:
    """crc32 of the id as text, modulo ``by``; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary")), F.lit(by))


def slices(batches: Iterator[pa.RecordBatch], rows: int = ROWS_AT_ONCE) -> Iterator[pa.RecordBatch]:
    """The same rows in short batches, which bounds what a worker holds as Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def portions(batches: Iterator[pa.RecordBatch], column: int, size: int = 4 << 20, rows: int = 4096) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``size`` bytes in one column (a longer value is a batch of its own)."""
    for batch in batches:
        end = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            base = int(end[at - 1]) if at else 0
            to = min(max(int(np.searchsorted(end, base + size, "right")), at + 1), at + rows, batch.num_rows)
            yield batch.slice(at, to - at)
            at = to


def gathered(batches: Iterator[pa.RecordBatch], column: int, size: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``size`` bytes in one column, put together from shorter ones."""
    held, total = [], 0
    for batch in portions(batches, column, size):
        n = pc.sum(pc.binary_length(batch.column(column))).as_py() or 0
        if held and total + n > size:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, total = [], 0
        held.append(batch)
        total += n
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def utf8(data: bytes) -> str:
    return data.decode("utf-8", "replace")


def free_name(df: DataFrame, name: str) -> str:
    """The name, or one with underscores before it where the table has that column already."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def schema_ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in df.schema)
