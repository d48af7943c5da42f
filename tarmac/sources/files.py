"""File-system facts through Spark's own file-system layer, so any scheme the
session can read (local, HDFS, object stores) is listed the same way."""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class FileInfo:
    path: str
    name: str
    is_dir: bool
    size: int
    modified: int


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return bool(_fs(spark, path).exists(_path(spark, path)))


def listing(spark: SparkSession, path: str) -> list[FileInfo]:
    """Entries directly under ``path`` (or the file itself), sorted by name;
    empty when it does not exist."""
    if not exists(spark, path):
        return []
    found = [FileInfo(s.getPath().toString(), s.getPath().getName(), bool(s.isDirectory()),
                      int(s.getLen()), int(s.getModificationTime()))
             for s in _fs(spark, path).listStatus(_path(spark, path))]
    return sorted(found, key=lambda f: f.name)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme, as listings name it."""
    return _fs(spark, path).makeQualified(_path(spark, path)).toString()


def delete(spark: SparkSession, path: str) -> None:
    _fs(spark, path).delete(_path(spark, path), True)


def read_text(spark: SparkSession, path: str) -> str:
    """A small UTF-8 file."""
    stream = _fs(spark, path).open(_path(spark, path))
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file whole, or return False when there is one already:
    it is written beside its place and renamed."""
    fs, target = _fs(spark, path), _path(spark, path)
    folder, _, name = path.rpartition("/")
    beside = _path(spark, f"{folder}/.{name}-{uuid.uuid4().hex}")
    out = fs.create(beside, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if not fs.exists(target) and fs.rename(beside, target):
        return True
    fs.delete(beside, False)
    return False


def _tree_state(spark: SparkSession, folders: list[str]) -> str:
    """One digest of path, size and time of every file below the folders, at
    any depth: Spark lists them, and an aggregate makes the digest, so no list
    of files is kept on the driver. (The reader leaves out hidden files.)"""
    found = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folders)
             .select(F.xxhash64("path", "length", "modificationTime").alias("h"), "length"))
    # Two sums of independent hashes, so that changes cannot cancel out.
    row = found.agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("bytes"),
                    F.bit_xor("h").alias("a"),
                    F.sum(F.xxhash64("h", F.lit(1)).cast("decimal(38, 0)")).alias("b")).first()
    return ":".join(str(x) for x in row)


def fingerprint(spark: SparkSession, paths: list[str]) -> str:
    """Digest of names, sizes and modification times of all files of the given
    tables (each a file, or a folder of files and folders): it changes when the
    input does, at whatever depth."""
    h, folders = hashlib.sha1(), []
    for path in paths:
        h.update(path.encode())
        if not exists(spark, path):
            continue
        status = _fs(spark, path).getFileStatus(_path(spark, path))
        if status.isDirectory():
            folders.append(path)
        else:
            h.update(f"{status.getLen()}:{status.getModificationTime()}".encode())
    if folders:
        h.update(_tree_state(spark, folders).encode())
    return h.hexdigest()
