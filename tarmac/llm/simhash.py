"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprint: 64 bits; a bit is 1 if it is set in over half of the XXH64 values
of a text's word shingles. Two documents link if their fingerprints differ in
at most ``radius`` bits.

Candidate search: every bit position gets a nonzero vector of radius + 1 bits;
for each nonzero vector v there is a table that keeps the positions whose
vector has an odd product with v. The vectors of any ``radius`` positions
cannot span the whole space, so for every pair within the radius some v is
orthogonal to all positions where the pair differs: the pair agrees on that
table's whole mask. No pair is missed, and no probability is involved.

Fingerprints are made distinct first, so exact copies cost nothing. A bucket
with more members than ``SPLIT`` is covered again on the positions that its
mask leaves free, which bounds a bucket by the number of values of the bits
that both masks leave free; buckets then give the links of a spanning forest,
not all pairs, and components are joined over all tables.

Defined results: a null or empty text, or one without words, has fingerprint
zero and links like any other; fewer words than a shingle form one shingle;
repeated rows have one fingerprint; an empty table gives an empty result. A
null id never names a component: the component of null ids alone is null.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import LOWER, text_hashes, text_of, written
from tarmac.llm.components import components
from tarmac.llm.exact import without_rows

BITS = 64
SEED = 42

#: A bucket with more distinct fingerprints is covered a second time.
SPLIT = 1024

#: Bits of each byte value, highest first.
_BYTE_BITS = ((np.arange(256)[:, None] >> np.arange(7, -1, -1)) & 1).astype(np.int64)


def fingerprint(text: str, shingle: int = 3) -> int:
    """The unsigned 64-bit fingerprint of one text."""
    import xxhash

    words = text.encode("utf-8", "surrogatepass").translate(LOWER.tobytes()).split()
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(g, SEED) for g in grams], dtype=">u8")
    columns = hashes.view(np.uint8).reshape(-1, 8)
    if len(hashes) < 256:
        ones = np.unpackbits(columns, axis=1).sum(axis=0, dtype=np.int64)
    else:
        ones = np.concatenate([np.bincount(columns[:, i], minlength=256) @ _BYTE_BITS
                               for i in range(8)])
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprints(text: Column, shingle: int = 3) -> Column:
    """Signed bigint column with the bits of :func:`fingerprint`."""
    @F.arrow_udf("bigint")
    def simhash(texts: pa.Array) -> pa.Array:
        values = np.array([fingerprint(t or "", shingle) for t in texts.to_pylist()], np.uint64)
        return pa.array(values.view(np.int64))

    return simhash(text)


def covering_masks(positions: list[int], radius: int) -> list[int]:
    """Masks over ``positions`` such that two values that differ in at most
    ``radius`` of them agree on some whole mask."""
    dims = radius + 1
    vectors = [1 + i % ((1 << dims) - 1) for i in range(len(positions))]
    masks = []
    for v in range(1, 1 << dims):
        kept = [p for p, x in zip(positions, vectors) if bin(x & v).count("1") % 2]
        masks.append(sum(1 << p for p in kept))
    return masks


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _keyed(fps: DataFrame, radius: int) -> DataFrame:
    masks = covering_masks(list(range(BITS)), radius)
    tables = F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
                       for t, m in enumerate(masks)])
    return fps.select("fp", F.inline(tables))


def _covered_again(keyed: DataFrame, radius: int) -> DataFrame:
    """Rows of large buckets, keyed by a second cover of their free bits."""
    finer = []
    for t, m in enumerate(covering_masks(list(range(BITS)), radius)):
        free = [p for p in range(BITS) if not m >> p & 1]
        finer.append(F.array(*[
            F.struct(F.lit(t * 1000 + 1 + i).alias("t2"),
                     F.col("fp").bitwiseAND(F.lit(_signed(m | s))).alias("key2"))
            for i, s in enumerate(covering_masks(free, radius))]))
    again = F.element_at(F.array(*finer), F.col("t") + 1)
    return keyed.select("fp", F.inline(again)).select(
        F.xxhash64("t2", "key2").alias("bucket"), "fp")


def _forest(values: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (a, b) of a spanning forest of the values within the radius."""
    values = np.sort(values)
    n = len(values)
    root = np.arange(n)
    for i in range(n - 1):  # one row of the comparison at a time: n values of memory
        near = np.flatnonzero(np.bitwise_count(values[i + 1:] ^ values[i]) <= radius) + i + 1
        if len(near):
            roots = np.unique(np.append(root[near], root[i]))
            if len(roots) > 1:
                root[np.isin(root, roots)] = roots[0]
    child = np.flatnonzero(root != np.arange(n))
    return values[child], values[root[child]]


def near_links(fps: DataFrame, radius: int) -> DataFrame:
    """(a, b): links that connect all fingerprints within the radius of each
    other, directly or over others. ``fps`` has one distinct bigint ``fp``."""
    keyed = _keyed(fps, radius)
    shared = (keyed.groupBy(F.col("t").alias("st"), F.col("key").alias("skey"))
              .agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
    rows = keyed.join(shared, (F.col("t") == F.col("st")) & (F.col("key") == F.col("skey")))
    small = rows.filter(F.col("n") <= SPLIT).select(F.xxhash64("t", "key").alias("bucket"), "fp")
    large = _covered_again(rows.filter(F.col("n") > SPLIT), radius)
    buckets = (small.union(large).groupBy("bucket")
               .agg(F.collect_list("fp").alias("fps")).filter(F.size("fps") > 1))

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            offsets = lists.offsets.to_numpy()
            flat = lists.values.to_numpy().view(np.uint64)
            size = np.diff(offsets)
            # Pairs are most of the buckets: all of them at once.
            two = offsets[:-1][size == 2]
            x, y = flat[two], flat[two + 1]
            near = (np.bitwise_count(x ^ y) <= radius) & (x != y)
            found = [(x[near], y[near])]
            for i in np.flatnonzero(size > 2):
                found.append(_forest(np.unique(flat[offsets[i]:offsets[i + 1]]), radius))
            a, b = (np.concatenate(c).view(np.int64) for c in zip(*found))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return buckets.select("fps").mapInArrow(link, "a bigint, b bigint").distinct()


def _rooted(signed: DataFrame, radius: int, name: str, order: Column) -> DataFrame:
    """(nfp, ``name``): the least ``order`` of the component of each fingerprint."""
    distinct = signed.groupBy("fp").agg(F.min(order).alias("least"))
    roots = components(near_links(distinct.select("fp"), radius), "simhash-links")
    rooted = (distinct.join(roots, F.col("fp") == F.col("node"), "left")
              .select("fp", F.coalesce("root", "fp").alias("root"), "least"))
    least = rooted.groupBy(F.col("root").alias("r")).agg(F.min("least").alias(name))
    return (rooted.join(least, F.col("root") == F.col("r"))
            .select(F.col("fp").alias("nfp"), name))


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 3,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id, the smallest id
    that is reachable over links."""
    signed = written(docs.select(F.col(id_col).alias("doc_id"),
                                 fingerprints(text_of(text_col), shingle).alias("fp")), "simhash")
    named = _rooted(signed, radius, "component_id", F.col("doc_id"))
    return signed.join(named, F.col("fp") == F.col("nfp")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 3,
                         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component, all its columns kept: the
    smallest id, null ids last, and of its texts the one with the smallest hash."""
    hashes = text_hashes(text_of(text_col))
    signed = written(docs.select(F.col(id_col).alias("doc_id"), *[h.alias(c) for c, h in hashes.items()],
                                 fingerprints(text_of(text_col), shingle).alias("fp")), "simhash")
    top = ("doc_id", "text_a", "text_b")
    named = _rooted(signed, radius, "top", F.struct(F.col("doc_id").isNull(), *top))
    stays = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col("top")[c]) for c in top])
    judged = signed.join(named, F.col("fp") == F.col("nfp")).select("doc_id", *hashes, stays.alias("stays"))
    return without_rows(docs, judged, "near", id_col, text_col)
