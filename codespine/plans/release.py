"""Release artefacts: tables, deterministic CSV and JSON, manifest and checksums; stage, verify, publish.

Rows are rendered to text by Spark, in the canonical order, with one file for each range of it; only the file list and the
checksums are handled on the driver. ``folder`` is a path that the driver can open (releases are published from one place).
"""

from __future__ import annotations

import hashlib
import json
import os
import shutil
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.hashing import decimal_text, json_string
from ..operators.diff import same_rows

#: The order of rows in a release.
ORDER = (("code", "first"), ("effective_from", "first"), ("effective_to", "last"), ("ligie_version", "first"), ("record_id", "first"))


class ReleaseError(ValueError):
    """A release that isn't what its manifest says."""


def canonical_order(columns: list[str]) -> list[Column]:
    """Order by code, start (open first), end (open last), version and id, as far as the columns are there."""
    return [F.asc_nulls_first(c) if nulls == "first" else F.asc_nulls_last(c) for c, nulls in ORDER if c in columns] or [F.asc_nulls_first(c) for c in columns]


def cell(name: str, kind: T.DataType) -> Column:
    """CSV text of a value: ``true``/``false``, plain decimals, UTC times with ``Z``; null is empty."""
    c = F.col(name)
    if isinstance(kind, T.DecimalType):
        out = decimal_text(c)
    elif isinstance(kind, T.TimestampType):
        out = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    else:
        out = c.cast("string")
    return F.coalesce(out, F.lit(""))


def quoted(text: Column) -> Column:
    """Quoted where a comma, quote or line end asks for it."""
    return F.when(text.rlike('[,"\\r\\n]'), F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(text)


def csv_lines(df: DataFrame) -> Column:
    return F.concat_ws(",", *[quoted(cell(f.name, f.dataType)) for f in df.schema])


def json_lines(df: DataFrame) -> Column:
    """One object a row, keys in column order, numbers bare, nulls kept."""
    parts = []
    for f in df.schema:
        c = F.col(f.name)
        bare = isinstance(f.dataType, (T.NumericType, T.BooleanType))
        value = F.coalesce(decimal_text(c) if isinstance(f.dataType, T.DecimalType) else c.cast("string"), F.lit("null")) if bare else json_string(F.when(c.isNotNull(), cell(f.name, f.dataType)))
        parts.append(F.concat(F.lit(f'"{f.name}":'), value))
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


def write_lines(df: DataFrame, line: Column, path: str, *, ranges: int, line_end: str) -> list[str]:
    """Rendered rows as text parts in the canonical order; returns the parts in that order."""
    order = canonical_order(df.columns)
    rows = df.repartitionByRange(ranges, *order).sortWithinPartitions(*order).select(line.alias("value"))
    rows.write.option("lineSep", line_end).text(path)
    return sorted(str(p) for p in Path(path).glob("part-*"))


def joined(parts: list[str], target: str, *, head: str = "", between: str = "", tail: str = "", strip: str = "") -> None:
    """Puts parts together in chunks; ``between`` goes between parts, ``strip`` leaves the end of each part."""
    with open(target, "wb") as out:
        out.write(head.encode())
        first = True
        for part in parts:
            size = os.path.getsize(part)
            if not size:
                continue
            if not first:
                out.write(between.encode())
            first = False
            with open(part, "rb") as src:
                left = size - len(strip.encode())
                while left > 0 and (chunk := src.read(min(1 << 20, left))):
                    out.write(chunk)
                    left -= len(chunk)
        out.write(tail.encode())


def sha256_of(path: Path) -> str:
    digest = hashlib.sha256()
    with path.open("rb") as f:
        while chunk := f.read(1 << 20):
            digest.update(chunk)
    return digest.hexdigest()


def export(records: DataFrame, folder: str, *, metadata: dict, name: str = "records", ranges: int = 8) -> dict:
    """Writes Parquet, CSV (CRLF) and a JSON array of equal rows, a manifest and checksums; publishes by one rename.

    The rows are written once and rendered from that copy, so all forms agree; the CSV is read back and compared. An existing
    release isn't touched.
    """
    target, stage = Path(folder), Path(f"{folder}.staging")
    if target.exists():
        raise ReleaseError(f"{folder} is there already")
    shutil.rmtree(stage, ignore_errors=True)
    stage.mkdir(parents=True)
    try:
        spark, schema = records.sparkSession, records.schema
        records.write.parquet(str(stage / f"{name}.parquet"))
        rows = spark.read.schema(schema).parquet(str(stage / f"{name}.parquet"))
        columns = ",".join(rows.columns)
        joined(write_lines(rows, csv_lines(rows), str(stage / "_csv"), ranges=ranges, line_end="\r\n"), str(stage / f"{name}.csv"), head=columns + "\r\n")
        joined(write_lines(rows, json_lines(rows), str(stage / "_json"), ranges=ranges, line_end=",\n"), str(stage / f"{name}.json"), head="[\n", between=",\n", tail="\n]\n", strip=",\n")
        shutil.rmtree(stage / "_csv")
        shutil.rmtree(stage / "_json")
        plain = rows.select(*[cell(f.name, f.dataType).alias(f.name) for f in schema])
        back = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("emptyValue", "").option("nullValue", "\0").schema(plain.schema).csv(str(stage / f"{name}.csv"))
        if not same_rows(plain, back.na.fill("")):
            raise ReleaseError("the CSV doesn't read back as it was written")
        files = {p.relative_to(stage).as_posix(): sha256_of(p) for p in sorted(stage.rglob("*")) if p.is_file() and not p.name.startswith((".", "_"))}
        manifest = {**metadata, "columns": rows.columns, "row_count": rows.count(), "files": files}
        (stage / "manifest.json").write_text(json.dumps(manifest, ensure_ascii=False, indent=2, sort_keys=True) + "\n")
        (stage / "SHA256SUMS").write_text("".join(f"{d}  {p}\n" for p, d in sorted({**files, "manifest.json": sha256_of(stage / "manifest.json")}.items())))
        os.rename(stage, target)
        return manifest
    except BaseException:
        shutil.rmtree(stage, ignore_errors=True)
        raise


def verify(folder: str) -> dict:
    """The manifest of a release whose files all have their checksums; raises otherwise."""
    top = Path(folder)
    for line in (top / "SHA256SUMS").read_text().splitlines():
        digest, _, name = line.partition("  ")
        if not (top / name).is_file() or sha256_of(top / name) != digest:
            raise ReleaseError(f"{name} is missing or changed")
    return json.loads((top / "manifest.json").read_text())


def capture(content: bytes, metadata: dict, root: str) -> Path:
    """Keeps a fetched document under its day, source and kind, by content; the same again is no change, other metadata is an error."""
    digest = hashlib.sha256(content).hexdigest()
    place = Path(root) / metadata["observed_at"][:10] / metadata["source"] / metadata["kind"] / digest
    place.mkdir(parents=True, exist_ok=True)
    about = json.dumps({**metadata, "sha256": digest}, ensure_ascii=False, sort_keys=True)
    if (place / "metadata.json").exists():
        if (place / "metadata.json").read_text() != about:
            raise ReleaseError("the same content was captured with other metadata")
        return place
    (place / "content").write_bytes(content)
    (place / "metadata.json").write_text(about)
    return place
