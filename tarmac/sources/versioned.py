"""Tables that are replaced in one step, whole or part by part.

The folder of a table holds data folders, which are written once and never
changed, and under ``_versions`` one small file per version, which names the
data folders that make up the table (its parts). A writer first writes new data
folders with an ordinary Spark job and then creates the file of the next
version; readers use the newest version. So a job that is killed in mid-write
leaves the table as it was, a running query keeps the files it started with,
and replacing one part rewrites no other.

Version files appear by a rename that fails when the number is taken (on file
systems whose rename does), so of two writers the second one applies its change
to what the first one left. Only the current and the previous version keep
their data; :func:`vacuum` removes what killed writers left.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.sources import files

VERSIONS = "_versions"
WHOLE = "whole"
#: Versions whose data folders are kept.
KEPT = 2
#: Rows per output file; bounds file size however the input is partitioned.
MAX_RECORDS_PER_FILE = 5_000_000

_ATTEMPTS = 50


@dataclass(frozen=True)
class Part:
    folder: str          # below the table's folder
    source: str = ""     # what it was made from, as its writer says
    schema: str = ""     # of its rows, as JSON


@dataclass(frozen=True)
class Version:
    number: int
    parts: dict[str, Part]


def _file(path: str, number: int) -> str:
    return f"{path.rstrip('/')}/{VERSIONS}/{number:012d}.json"


def _read_version(spark: SparkSession, path: str, number: int) -> Version:
    parts = json.loads(files.read_text(spark, _file(path, number)))
    return Version(number, {name: Part(**p) for name, p in parts.items()})


def _numbers(spark: SparkSession, path: str) -> list[int]:
    return [int(f.name.removesuffix(".json")) for f in files.listing(spark, f"{path.rstrip('/')}/{VERSIONS}")
            if f.name.endswith(".json")]


def current(spark: SparkSession, path: str) -> Version | None:
    """The newest version, or None when there is no whole table."""
    numbers = _numbers(spark, path)
    return _read_version(spark, path, numbers[-1]) if numbers else None


def exists(spark: SparkSession, path: str) -> bool:
    return bool(_numbers(spark, path))


def state(spark: SparkSession, path: str) -> str:
    """Names the data of the newest version; other data have another name."""
    version = current(spark, path)
    return ";".join(sorted(p.folder for p in version.parts.values())) if version else ""


def read(spark: SparkSession, path: str, only: set[str] | None = None) -> DataFrame:
    """The newest version of the table (of it, ``only`` these parts). Parts may
    lack columns that others have: those are null."""
    version = current(spark, path)
    parts = [p for name, p in version.parts.items() if only is None or name in only] if version else []
    if not parts:
        raise ValueError(f"there is no whole table at {path}")
    fields: dict[str, T.StructField] = {}
    for part in parts:
        for field in T.StructType.fromJson(json.loads(part.schema)):
            known = fields.setdefault(field.name.lower(), field)
            if known.dataType != field.dataType:
                raise ValueError(f"{path}: {field.name} is {known.dataType} in one part, {field.dataType} in another")
    return spark.read.schema(T.StructType(list(fields.values()))).parquet(
        *[f"{path.rstrip('/')}/{p.folder}" for p in parts])


def _commit(spark: SparkSession, path: str,
            change: Callable[[dict[str, Part]], dict[str, Part]]) -> Version:
    for _ in range(_ATTEMPTS):
        now = current(spark, path)
        version = Version((now.number if now else 0) + 1, change(dict(now.parts) if now else {}))
        text = json.dumps({name: vars(p) for name, p in version.parts.items()}, sort_keys=True)
        if files.create_once(spark, _file(path, version.number), text):
            _expire(spark, path, version)
            return version
    raise RuntimeError(f"{path}: other writers took every version number")


def _expire(spark: SparkSession, path: str, newest: Version) -> None:
    """Remove versions before the last ``KEPT``, and data only they name."""
    old = [_read_version(spark, path, n) for n in _numbers(spark, path) if n <= newest.number]
    keep = {p.folder for v in old[-KEPT:] for p in v.parts.values()}
    for version in old[:-KEPT]:
        for part in version.parts.values():
            if part.folder not in keep:
                files.delete(spark, f"{path.rstrip('/')}/{part.folder}")
        files.delete(spark, _file(path, version.number))


def _new_folder() -> str:
    return f"data-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def _write(df: DataFrame, folder: str) -> None:
    df.write.mode("error").option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).parquet(folder)


def replace(df: DataFrame, path: str, source: str = "") -> Version:
    """Replace the whole table by ``df``."""
    folder = _new_folder()
    _write(df.hint("rebalance"), f"{path.rstrip('/')}/{folder}")
    part = Part(folder, source, df.schema.json())
    return _commit(df.sparkSession, path, lambda _: {WHOLE: part})


def replace_parts(spark: SparkSession, path: str, frames: dict[str, DataFrame],
                  sources: dict[str, str] | None = None, drop: tuple[str, ...] = ()) -> Version:
    """Replace (or add) the parts named by ``frames``, which share one schema,
    remove those in ``drop``, and leave all others. One job writes all parts."""
    sources, root = sources or {}, path.rstrip("/")
    made: dict[str, Part] = {}
    if frames:
        base, tag = _new_folder(), "part"
        names = list(frames)
        while any(tag == c.lower() for df in frames.values() for c in df.columns):
            tag = f"_{tag}"
        tagged = [df.withColumn(tag, F.lit(i)) for i, df in enumerate(frames.values())]
        union = tagged[0]
        for df in tagged[1:]:
            union = union.unionByName(df)
        (union.hint("rebalance", tag).write.mode("error").partitionBy(tag)
         .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).parquet(f"{root}/{base}"))
        written = {f.name for f in files.listing(spark, f"{root}/{base}")}
        for i, name in enumerate(names):
            folder = f"{base}/{tag}={i}"
            if f"{tag}={i}" not in written:  # a part without rows has no folder yet
                folder = f"{base}-empty-{i}"
                _write(frames[name].filter(F.lit(False)), f"{root}/{folder}")
            made[name] = Part(folder, sources.get(name, ""), frames[name].schema.json())

    def change(parts: dict[str, Part]) -> dict[str, Part]:
        return {**{name: p for name, p in parts.items() if name not in drop}, **made}

    return _commit(spark, path, change)


def vacuum(spark: SparkSession, path: str, older_than_s: float = 7 * 86_400) -> list[str]:
    """Remove data folders that no version names and that are older than the
    given age (a younger one may belong to a writer at work); their names."""
    root = path.rstrip("/")
    named = {p.folder.split("/")[0] for n in _numbers(spark, path)
             for p in _read_version(spark, path, n).parts.values()}
    before = (time.time() - older_than_s) * 1000
    gone = [f.name for f in files.listing(spark, root)
            if f.is_dir and f.name.startswith("data-") and f.name not in named and f.modified < before]
    for name in gone:
        files.delete(spark, f"{root}/{name}")
    return gone
