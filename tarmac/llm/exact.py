"""Exact deduplication with counting quotient filters.

Each partition builds a counting quotient filter over its texts' 64-bit
fingerprints: the top bits (the quotient) name a run of slots, the rest (the
remainder) is stored in the slot, and equal fingerprints share one slot with a
counter. A filter is lossless, since quotient and remainder together are the
whole fingerprint, and its slots are sorted, so filters merge like sorted
lists. The filters travel in segments by quotient range, so no task holds the
whole corpus' filter. Fingerprints whose merged count is above one go to byte
verification: their texts are grouped as bytes, with a map-side partial
aggregate, so a text with millions of copies sends one row from each task.

Defined results: a null text counts as empty; empty texts are equal to each
other. Of equal texts the row with the largest ``doc_id`` stays (a null id is
smaller than any other); of repeated rows with that id all are marked kept,
and :func:`drop_duplicates` leaves one. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm.common import (free_name, own_columns, shuffle_partitions, text_hashes, text_of,
                               written)

#: Quotient bits: 2^24 runs; a merged segment covers a range of them.
QUOTIENT_BITS = 24


class CountingQuotientFilter:
    """A counting quotient filter over the runs [first, last) of the quotient.

    ``occupied`` has a bit for each quotient of the range that has a run,
    ``run_end`` a bit for each slot that ends a run; ``remainder`` and
    ``count`` hold the slots, sorted by quotient and remainder.
    """

    def __init__(self, first: int, last: int, occupied: np.ndarray, run_end: np.ndarray,
                 remainder: np.ndarray, count: np.ndarray):
        self.first, self.last = first, last
        self.occupied, self.run_end, self.remainder, self.count = occupied, run_end, remainder, count

    @classmethod
    def of_sorted(cls, fingerprints: np.ndarray, counts: np.ndarray, first: int, last: int,
                  bits: int = QUOTIENT_BITS) -> "CountingQuotientFilter":
        """From ascending distinct fingerprints whose quotients lie in the range."""
        shift = np.uint64(64 - bits)
        quotient = (fingerprints >> shift).astype(np.int64)
        occupied = np.zeros(last - first, dtype=bool)
        occupied[quotient - first] = True
        run_end = np.ones(len(quotient), dtype=bool)
        run_end[:-1] = quotient[1:] != quotient[:-1]
        remainder = fingerprints & ((np.uint64(1) << shift) - np.uint64(1))
        return cls(first, last, occupied, run_end, remainder, counts)

    @classmethod
    def of(cls, fingerprints: np.ndarray, first: int = 0, last: int = 1 << QUOTIENT_BITS,
           bits: int = QUOTIENT_BITS) -> "CountingQuotientFilter":
        keys, counts = np.unique(fingerprints, return_counts=True)
        return cls.of_sorted(keys, counts.astype(np.int64), first, last, bits)

    def items(self, bits: int = QUOTIENT_BITS) -> tuple[np.ndarray, np.ndarray]:
        """Ascending fingerprints and their counts."""
        runs = np.flatnonzero(self.occupied) + self.first
        run_of_slot = np.concatenate(([0], np.cumsum(self.run_end)[:-1])) if len(self.run_end) else \
            np.zeros(0, np.int64)
        quotient = runs[run_of_slot.astype(np.int64)].astype(np.uint64)
        return (quotient << np.uint64(64 - bits)) | self.remainder, self.count

    @staticmethod
    def merge(filters: list["CountingQuotientFilter"], bits: int = QUOTIENT_BITS) \
            -> "CountingQuotientFilter":
        """Merge by the sorted remainders; counts of equal slots add up."""
        first, last = filters[0].first, filters[0].last
        keys, counts = zip(*(f.items(bits) for f in filters))
        keys, counts = np.concatenate(keys), np.concatenate(counts)
        order = np.argsort(keys, kind="stable")  # merges the ascending runs
        keys, counts = keys[order], counts[order]
        if not len(keys):
            return CountingQuotientFilter.of_sorted(keys, counts, first, last, bits)
        heads = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        return CountingQuotientFilter.of_sorted(keys[heads], np.add.reduceat(counts, heads),
                                                first, last, bits)

    def to_bytes(self) -> bytes:
        n = len(self.remainder)
        head = np.array([self.first, self.last, n], dtype=np.int64).tobytes()
        return b"".join((head, np.packbits(self.occupied).tobytes(),
                         np.packbits(self.run_end).tobytes(),
                         self.remainder.astype(np.uint64).tobytes(),
                         self.count.astype(np.int64).tobytes()))

    @classmethod
    def from_bytes(cls, data: bytes) -> "CountingQuotientFilter":
        first, last, n = (int(x) for x in np.frombuffer(data, np.int64, 3))
        at, width = 24, last - first
        occupied = np.unpackbits(np.frombuffer(data, np.uint8, -(-width // 8), at), count=width)
        at += -(-width // 8)
        run_end = np.unpackbits(np.frombuffer(data, np.uint8, -(-n // 8), at), count=n) if n else \
            np.zeros(0, np.uint8)
        at += -(-n // 8)
        remainder = np.frombuffer(data[at:at + 8 * n], np.uint64)
        count = np.frombuffer(data[at + 8 * n:at + 16 * n], np.int64)
        return cls(first, last, occupied.astype(bool), run_end.astype(bool), remainder, count)


def _segment_bounds(segments: int) -> np.ndarray:
    return (np.arange(segments + 1, dtype=np.int64) << QUOTIENT_BITS) // segments


def repeated_fingerprints(fingerprints: DataFrame, segments: int) -> DataFrame:
    """(fp, n) for every value of the one bigint column that occurs more than
    once, through filters built per partition and merged per segment."""
    bounds = _segment_bounds(segments)
    shift = np.uint64(64 - QUOTIENT_BITS)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for batch in batches:
            new, n = np.unique(batch.column(0).to_numpy().view(np.uint64), return_counts=True)
            both = np.concatenate((keys, new))
            add = np.concatenate((counts, n.astype(np.int64)))
            order = np.argsort(both, kind="stable")
            both, add = both[order], add[order]
            if len(both):
                heads = np.flatnonzero(np.concatenate(([True], both[1:] != both[:-1])))
                keys, counts = both[heads], np.add.reduceat(add, heads)
        cuts = np.searchsorted((keys >> shift).astype(np.int64), bounds)
        for i in range(segments):
            lo, hi = cuts[i], cuts[i + 1]
            if lo < hi:
                part = CountingQuotientFilter.of_sorted(
                    keys[lo:hi], counts[lo:hi], int(bounds[i]), int(bounds[i + 1]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i], pa.int32()), pa.array([part.to_bytes()], pa.binary())],
                    names=["segment", "filter"])

    def merge(table: pa.Table) -> pa.Table:
        merged = CountingQuotientFilter.merge(
            [CountingQuotientFilter.from_bytes(x) for x in table.column("filter").to_pylist()])
        keys, counts = merged.items()
        keep = counts > 1
        return pa.table({"fp": pa.array(keys[keep].view(np.int64), pa.int64()),
                         "n": pa.array(counts[keep], pa.int64())})

    parts = fingerprints.mapInArrow(build, "segment int, filter binary")
    return parts.groupBy("segment").applyInArrow(merge, "fp bigint, n bigint")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 with_hash: bool = False) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256, and
    with ``with_hash`` the columns of ``text_hashes``."""
    text = text_of(text_col)
    segments = max(1, shuffle_partitions(docs.sparkSession))
    repeated = repeated_fingerprints(docs.select(F.xxhash64(text).alias("fp")), segments)
    # Byte verification: equal fingerprints are not enough, equal bytes are.
    # The copies of a text are combined in each task before they are shuffled.
    suspects = (
        docs.select(F.col(id_col).alias("id"), text.alias("t"), F.xxhash64(text).alias("fp"))
        .join(repeated.select("fp"), "fp")
        .groupBy("t").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("top"))
        .filter("n > 1")
        .select(F.sha2("t", 256).alias("sha"), F.col("top").alias("keep_id"),
                F.col("n").alias("group_size"))
    )
    hashes = text_hashes(text) if with_hash else {}
    rows = docs.select(F.col(id_col).alias("doc_id"), F.sha2(text, 256).alias("text_sha256"),
                       *[h.alias(c) for c, h in hashes.items()])
    grouped = F.col("group_size").isNotNull()
    keep_id = F.when(grouped, F.col("keep_id")).otherwise(F.col("doc_id"))
    return (
        rows.join(suspects, F.col("text_sha256") == F.col("sha"), "left")
        .select("doc_id", keep_id.alias("keep_id"),
                F.coalesce("group_size", F.lit(1).cast("bigint")).alias("group_size"),
                F.col("doc_id").eqNullSafe(keep_id).alias("kept"), "text_sha256",
                *hashes)
    )


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts, all its columns kept."""
    groups = exact_groups(docs.select(id_col, text_col), id_col, text_col, with_hash=True)
    return without_rows(docs, groups.withColumnRenamed("kept", "stays"), "exact", id_col, text_col)


def without_rows(docs: DataFrame, judged: DataFrame, name: str, id_col: str, text_col: str) -> DataFrame:
    """``docs`` without the rows that do not stay, and with one of repeated rows
    that do. ``judged``: doc_id, the columns of ``text_hashes``, ``stays``, for
    each row; ``name`` names the tables written.

    An id alone names no row: it may be null, or on rows of several texts. A row
    is named by its id and the short name of its text, and by all 128 bits where
    two texts of an id have one short name. So the list of what goes is short,
    and the planner may send it to the texts instead of dealing them anew."""
    texts = judged.groupBy("doc_id", "text_h", "text_a", "text_b", "stays").agg(F.count(F.lit(1)).alias("n"))
    others = F.count(F.lit(1)).over(Window.partitionBy("doc_id", "text_h")) > 1
    listed = written(
        texts.withColumn("others", others).filter("not stays or n > 1").select(
            "doc_id", "text_h", F.when(F.col("others"), F.col("text_a")).alias("text_a"),
            F.when(F.col("others"), F.col("text_b")).alias("text_b"), "stays"), f"{name}-gone")
    several = written(listed.filter("stays"), f"{name}-repeated")
    own = {c: free_name(docs, f"_{c}") for c in ("text_h", "text_a", "text_b")}
    ids, *theirs = (free_name(docs, f"_gone_{c}") for c in ("id", *own))
    hashed = docs.withColumns({own[c]: h for c, h in text_hashes(text_of(text_col)).items()})

    def named(df: DataFrame) -> DataFrame:
        return df.select(F.col("doc_id").alias(ids), *[F.col(c).alias(x) for c, x in zip(own, theirs)])

    h, a, b = (F.col(own[c]) == F.col(x) for c, x in zip(own, theirs))
    same = F.col(id_col).eqNullSafe(F.col(ids)) & h & (F.col(theirs[1]).isNull() | (a & b))
    left = hashed.join(named(listed), same, "left_anti")
    again = hashed.join(named(several), same, "left_semi").dropDuplicates([id_col, *own.values()])
    return left.select(own_columns(docs)).unionByName(again.select(own_columns(docs)))
