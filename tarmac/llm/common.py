"""Shared pieces of the corpus operators: inputs, intermediate tables,
byte-level views of Arrow text columns, word boundaries and word hashes."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.session import ensure_checkpoint_dir

#: Bytes of text that one numpy block holds; a longer single text is a block of its own.
BLOCK_BYTES = 1 << 20

#: Bytes of a row group of the tables that operators write for themselves.
ROW_GROUP_BYTES = 32 << 20

#: ASCII white space: the bytes that separate words.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: Lower-cases A-Z and leaves every other byte as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package wherever they run, once per application."""
    sc = spark.sparkContext
    if sc.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parents[1]
        archive = Path(tempfile.mkdtemp(prefix="tarmac-py-")) / "tarmac.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for path in sorted(package.rglob("*.py")):
                out.write(path, path.relative_to(package.parent))
        sc.addPyFile(str(archive))
        _SHIPPED.add(sc.applicationId)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def text_of(column: str | Column = "text") -> Column:
    """The text, with null as the empty string."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def fold(doc_id: str | Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")) % F.lit(folds)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back. The lineage is
    cut there: a lost executor costs a re-read of files, not a recomputation,
    and every consumer sees the same rows."""
    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/corpus/{name}-{uuid.uuid4().hex}"
    # Small row groups: a writer holds one of them in memory.
    df.write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that ``df`` does not have yet (names are case-blind)."""
    taken, name = {c.lower() for c in df.columns}, wanted
    while name.lower() in taken:
        name = f"_{name}"
    return name


def own_columns(df: DataFrame) -> list[Column]:
    """All columns of ``df``, whatever characters their names have."""
    return [F.col(f"`{c.replace('`', '``')}`") for c in df.columns]


def text_hashes(text: Column) -> dict[str, Column]:
    """A short name of a text, ``text_h``, and 128 bits in two independent
    hashes, ``text_a`` and ``text_b``, for texts whose short names are equal."""
    return {"text_h": F.hash(text), "text_a": F.xxhash64(text), "text_b": F.xxhash64(F.lit("text"), text)}


class Block:
    """Texts of consecutive rows as one byte array; ``off`` has a text's first
    byte at its row and the end of the last text as its last entry."""

    __slots__ = ("lo", "hi", "buf", "off")

    def __init__(self, lo: int, hi: int, buf: np.ndarray, off: np.ndarray):
        self.lo, self.hi, self.buf, self.off = lo, hi, buf, off

    @property
    def rows(self) -> int:
        return self.hi - self.lo


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column without nulls, copying nothing."""
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)
    off = off[column.offset:column.offset + len(column) + 1].astype(np.int64)
    buf = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf, off


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """Cut a text column into blocks of at most ``limit`` bytes, or one row."""
    if not len(column):
        return
    buf, off = text_buffer(column)
    lo, n = 0, len(column)
    while lo < n:
        hi = int(np.searchsorted(off, off[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield Block(lo, hi, buf[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
        lo = hi


def word_bounds(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word (a run without ASCII white space), and
    the number of words before each row's first word (rows + 1 entries)."""
    n = len(block.buf)
    if n == 0:
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(block.rows + 1, np.int64)
    ink = ~SPACE[block.buf]
    edges = block.off[(block.off > 0) & (block.off < n)]
    first = ink.copy()
    first[1:] &= ~ink[:-1]
    first[edges] = ink[edges]
    last = ink.copy()
    last[:-1] &= ~ink[1:]
    last[edges - 1] = ink[edges - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, block.off)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers (the public splitmix64 finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class RangeHash:
    """Hashes of any ranges of a sequence of 64-bit values, from one prefix sum.

    The hash of values v_0..v_n-1 is the sum of v_i * base^i modulo 2^64; the
    range [s, e) is read as the difference of two prefix sums, moved back by
    base^-s. ``base`` is odd, so it has an inverse."""

    def __init__(self, base: int):
        self._base, self._inverse = base, pow(base, -1, 1 << 64)
        self._up = self._down = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self._up) <= n:
            size = 1 << int(n).bit_length()
            for name, base in (("_up", self._base), ("_down", self._inverse)):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))

    def prefix(self, values: np.ndarray) -> np.ndarray:
        self._grow(len(values) + 1)
        sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self._up[:len(values)], dtype=np.uint64, out=sums[1:])
        return sums

    def ranges(self, prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (prefix[ends] - prefix[starts]) * self._down[starts]


_BYTE_HASH = RangeHash(0x9E3779B97F4A7C15)
_BYTE_CODE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


def byte_prefix(buf: np.ndarray) -> np.ndarray:
    return _BYTE_HASH.prefix(_BYTE_CODE[buf])


def byte_ranges(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte strings between ``starts`` and ``ends``."""
    return mix(_BYTE_HASH.ranges(prefix, starts, ends))
