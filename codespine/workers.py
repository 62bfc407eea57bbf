"""The package for Python workers.

Functions that run in workers are sent by the name of their module, so workers need the package too. It goes to them as one archive through
Spark's own file distribution, once for each Spark application; a package that is installed on the workers does no harm.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import SparkSession

_SENT: set[str] = set()
#: Bounds of Arrow batches, as the default of 10,000 rows can be gigabytes of long texts; smaller bounds of the session stay.
BATCH_BOUNDS = {"spark.sql.execution.arrow.maxRecordsPerBatch": 4096, "spark.sql.execution.arrow.maxBytesPerBatch": 16 << 20}
#: Characters of pages that are parsed before what came of them leaves the worker.
PAGES_AT_ONCE = 1 << 20


def bounded(spark: SparkSession) -> None:
    """Batches of the session in rows and bytes."""
    for name, most in BATCH_BOUNDS.items():
        held = spark.conf.get(name, None)
        if held is None or not held.lstrip("-").isdigit() or not 0 < int(held) <= most:
            spark.conf.set(name, str(most))


def by_slices(batches: Iterator[tuple[pd.Series, ...]], one: Callable[..., object], most: int = PAGES_AT_ONCE) -> Iterator[list]:
    """What ``one`` makes of each row, in lists for about ``most`` characters of the first column (one row at least).

    Parsed pages are many times their size, so a whole batch of them isn't held.
    """
    for columns in batches:
        made, total = [], 0
        for row in zip(*columns, strict=True):
            made.append(one(*row))
            total += len(row[0] or "") + 64
            if total >= most:
                yield made
                made, total = [], 0
        if made:
            yield made


def ready(spark: SparkSession | None = None) -> None:
    """Sends this package to the workers of the session (the active one by default), where that hasn't been done, and bounds its Arrow batches."""
    spark = spark or SparkSession.getActiveSession()
    if spark is not None:
        bounded(spark)
    if spark is None or spark.sparkContext.applicationId in _SENT:
        return
    folder = tempfile.mkdtemp(prefix="codespine-")  # read by the driver's file server only
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = f"{folder}/codespine.zip"
    package = Path(__file__).resolve().parent
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:  # sources, so nothing is compiled into the package's own folder
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    spark.sparkContext.addPyFile(archive)
    _SENT.add(spark.sparkContext.applicationId)
