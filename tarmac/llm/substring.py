"""Repeated token spans by a compacted de Bruijn graph.

The graph's edges are all ``WINDOW``-token windows of the corpus. It is never
held edge by edge: consecutive windows of a document that share their
minimizer (the window's smallest ``SEED_WORDS``-token k-mer, the leftmost of
equals) are compacted to one path when the text is read. The minimizer is a
function of the window's tokens alone, so two equal windows always lie on
paths of the same k-mer, and a corpus of n tokens has about n / 20 paths.

Spark then joins paths by k-mer:

* a k-mer that occurs in one document only has no repeated window;
* occurrences of the path that the k-mer's smallest document has (an
  independent 64-bit hash of all its tokens agrees) stay compacted: their
  source is the occurrence in that document, and behind it all their windows
  are repeats. Where the paths of a k-mer do not branch, these are all;
* the others branch off. Behind such a path's own smallest document all its
  windows are repeats; for that document, the path is looked up at its source
  coordinate, taken apart into its windows, and a further aggregate and join
  finds those that another path of the k-mer has in a smaller document.

So a repeat is verified by the 128 bits of k-mer and window or path hash at
its source coordinates, and a window counts as repeated in a document exactly
if some document with a smaller id has it. All groups are reduced to minima
in every task before a shuffle, and hot keys meet only joins, which AQE splits.

Defined results: a null text has no words; a document with a null id neither
loses words nor is a source; rows of one id do not remove each other, and if
their texts differ each is judged as a text of that id (a 64-bit hash beside the
id tells them apart); texts shorter than a window stay as they are; an empty table gives an empty
result. Words are runs without ASCII white space, compared byte by byte.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import (Block, RangeHash, blocks, byte_prefix, byte_ranges, free_name, mix,
                               text_of, word_bounds, written)

WINDOW = 50
SEED_WORDS = 10

_ORDER = RangeHash(0xC2B2AE3D27D4EB4F)
_CHECK = RangeHash(0x165667B19E3779F9)
_SALT = np.uint64(0x27D4EB2F165667C5)


class _Tokens:
    """Prefix hashes over the words of a block of texts."""

    def __init__(self, block: Block):
        starts, ends, self.first = word_bounds(block)
        hashes = byte_ranges(byte_prefix(block.buf), starts, ends)
        self.words = len(starts)
        self._order = _ORDER.prefix(hashes)
        self._check = _CHECK.prefix(mix(hashes ^ _SALT))

    def seeds(self, size: int) -> np.ndarray:
        """Hash of the ``size`` words from each word on."""
        at = np.arange(max(self.words - size + 1, 0))
        return mix(_ORDER.ranges(self._order, at, at + size))

    def check(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix(_CHECK.ranges(self._check, starts, ends))


def _smallest(values: np.ndarray, span: int) -> np.ndarray:
    """Position of the leftmost smallest value of each ``span`` neighbours."""
    best, at = values, np.arange(len(values))
    covered = 1
    while covered < span:
        step = min(covered, span - covered)
        right, right_at = best[step:], at[step:]
        left, left_at = best[:len(right)], at[:len(right)]
        take = right < left
        best, at = np.where(take, right, left), np.where(take, right_at, left_at)
        covered += step
    return at


def _paths(block: Block, window: int, seed_words: int) -> dict[str, np.ndarray]:
    """Compacted paths of a block: row, first word, windows, k-mer, path hash."""
    tokens = _Tokens(block)
    seeds = tokens.seeds(seed_words)
    at = _smallest(seeds, window - seed_words + 1)[:max(tokens.words - window + 1, 0)]
    counts = np.diff(tokens.first)
    row_of = np.repeat(np.arange(block.rows), counts)[:len(at)]
    # windows that end in another text are none
    fits = np.arange(len(at)) + window <= tokens.first[row_of + 1]
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1]) | (row_of[1:] != row_of[:-1])
    head = np.flatnonzero(new & fits)
    if not len(head):
        empty = np.zeros(0, np.int64)
        return {"row": empty, "start": empty, "n": empty, "kmer": empty, "path": empty}
    stop = new | ~fits
    ends = np.append(np.flatnonzero(stop), len(at))
    length = ends[np.searchsorted(ends, head, side="right")] - head
    kmer = seeds[at[head]]
    inside = (at[head] - head).astype(np.uint64) * np.uint64(1 << 16) + length.astype(np.uint64)
    path = mix(tokens.check(head, head + length + window - 1) ^ mix(inside))
    row = row_of[head]
    return {"row": row, "start": head - tokens.first[row], "n": length,
            "kmer": kmer.view(np.int64), "path": path.view(np.int64)}


def _compacted(docs: DataFrame, window: int, seed_words: int) -> DataFrame:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, tags = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for block in blocks(batch.column(2)):
                p = _paths(block, window, seed_words)
                if len(p["row"]):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(p["kmer"]), pa.array(p["path"]),
                         pa.array(ids[block.lo + p["row"]], pa.int64()),
                         pa.array(tags[block.lo + p["row"]], pa.int64()),
                         pa.array(p["start"].astype(np.int32)), pa.array(p["n"].astype(np.int32))],
                        names=["kmer", "path", "doc", "tag", "start", "n"])

    return docs.mapInArrow(read, "kmer bigint, path bigint, doc bigint, tag bigint, start int, n int")


def _windows_of(rows: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """Windows of the wanted paths, read at their source coordinates."""
    lists = wanted.groupBy(F.col("doc").alias("k"), F.col("tag").alias("kt")).agg(
        F.collect_list(F.struct("kmer", "path", "start", "n")).alias("paths"))
    # All columns of ``rows`` are passed on, so that this join and the one that
    # cuts the texts read one shuffle of them.
    joined = rows.join(lists, (F.col("doc") == F.col("k")) & (F.col("tag") == F.col("kt"))).select(
        "doc", text_of("text").alias("text"), "paths", *[c for c in rows.columns if c not in ("doc", "text")])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lists_ = batch.column(0).to_numpy(), batch.column(2)
            at, flat = lists_.offsets.to_numpy(), lists_.values
            kmer, path, start, n = (flat.field(i).to_numpy() for i in range(4))
            for block in blocks(batch.column(1)):
                tokens = _Tokens(block)
                lo, hi = at[block.lo], at[block.hi]
                row = np.repeat(np.arange(block.rows), np.diff(at[block.lo:block.hi + 1]))
                size = n[lo:hi].astype(np.int64)
                which = np.repeat(np.arange(lo, hi), size)
                nth = np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size)
                begin = tokens.first[row[which - lo]] + start[which] + nth
                yield pa.RecordBatch.from_arrays(
                    [pa.array(kmer[which]), pa.array(path[which]), pa.array(nth.astype(np.int32)),
                     pa.array(tokens.check(begin, begin + window).view(np.int64)),
                     pa.array(ids[block.lo + row[which - lo]], pa.int64())],
                    names=["kmer", "path", "nth", "win", "doc"])

    return joined.mapInArrow(read, "kmer bigint, path bigint, nth int, win bigint, doc bigint")


def _meet(many: DataFrame, one: DataFrame, left: list[str], right: list[str]) -> DataFrame:
    """Join rows with an aggregate of them. The hash of the key is joined too:
    the aggregate is dealt by the key alone, so both sides are dealt anew and
    AQE can split a key with many rows."""
    return many.join(one, (F.xxhash64(*left) == F.xxhash64(*right)) & reduce(
        lambda a, b: a & b, [F.col(x) == F.col(y) for x, y in zip(left, right)]))


def _ranges(rows: DataFrame, window: int, seed_words: int) -> DataFrame:
    """(doc, tag, start, n): n windows from word ``start`` on of the document's
    text with that tag, each of which some document with a smaller id has too.
    ``rows``: doc (not null), tag, text, ..."""
    texts = rows.select("doc", "tag", text_of("text").alias("text"))
    paths = written(_compacted(texts, window, seed_words), "substring-paths")
    kmers = paths.groupBy(F.col("kmer").alias("k")).agg(
        F.min("doc").alias("low"), F.max("doc").alias("high"), F.min_by("path", "doc").alias("trunk"),
        (F.min("path") != F.max("path")).alias("branches")).filter("low < high")
    shared = written(_meet(paths, kmers, ["kmer"], ["k"]).select(
        "kmer", "path", "doc", "tag", "start", "n", "low", "trunk", "branches"), "substring-shared")
    # The path of a k-mer's smallest document, met again: all of it is a repeat.
    straight = shared.filter("path = trunk and doc > low").select("doc", "tag", "start", "n")
    forked = shared.filter("branches and (path != trunk or doc = low)").select(
        "kmer", "path", "doc", "tag", "start", "n")
    sources = written(forked.groupBy("kmer", "path", "n").agg(
        F.min(F.struct("doc", "tag", "start")).alias("at")).select("kmer", "path", "n", "at.*"),
        "substring-sources")
    # Behind a path's smallest document all its windows are repeats.
    placed = _meet(forked, sources.select(F.col("kmer").alias("sk"), F.col("path").alias("sp"),
                                          F.col("doc").alias("first")), ["kmer", "path"], ["sk", "sp"])
    later = placed.filter("doc > first").select("doc", "tag", "start", "n")
    # In it, those are that another path has in a smaller document.
    windows = _windows_of(rows, sources, window)
    least = windows.groupBy(F.col("kmer").alias("wk"), F.col("win").alias("ww")).agg(
        F.min("doc").alias("low"), F.max("doc").alias("high")).filter("low < high")
    earlier = _meet(windows, least, ["kmer", "win"], ["wk", "ww"]).filter("low < doc").select(
        F.col("kmer").alias("ek"), F.col("path").alias("ep"), "nth")
    firsts = placed.filter("doc = first").join(
        earlier, (F.col("kmer") == F.col("ek")) & (F.col("path") == F.col("ep"))).select(
        "doc", "tag", (F.col("start") + F.col("nth")).alias("start"), F.lit(1).alias("n"))
    return straight.union(later).union(firsts)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   window: int = WINDOW, seed_words: int = SEED_WORDS) -> DataFrame:
    """``docs`` with a new struct column, named by :func:`result_column`:
    n_words, n_removed, and ``kept``, the words that stay, joined by a space."""
    result, others = result_column(docs), [c for c in docs.columns if c not in (id_col, text_col)]
    rows = docs.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("bigint").alias("doc"), F.xxhash64(text_of(text_col)).alias("tag"),
        F.col(text_col).alias("text"), *([F.struct(*[F.col(f"`{c}`") for c in others]).alias("rest")] if others else []))
    found = _ranges(rows, window, seed_words).groupBy(F.col("doc").alias("k"), F.col("tag").alias("kt")).agg(
        F.collect_list(F.struct("start", "n")).alias("ranges"))

    @F.arrow_udf("struct<n_words: bigint, n_removed: bigint, kept: string>")
    def cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
        n_words, n_removed, kept = [], [], []
        for text, span in zip(texts.to_pylist(), spans):
            words = text.encode().split()
            n_words.append(len(words))
            if span.is_valid and len(span):
                start = span.values.field(0).to_numpy().astype(np.int64)
                stop = start + span.values.field(1).to_numpy() + window - 1
                depth = np.zeros(len(words) + 1, np.int64)
                np.add.at(depth, start, 1)
                np.add.at(depth, stop, -1)
                gone = np.cumsum(depth)[:-1] > 0
                words = [w for w, g in zip(words, gone.tolist()) if not g]
            n_removed.append(n_words[-1] - len(words))
            kept.append(b" ".join(words).decode())
        return pa.StructArray.from_arrays(
            [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())],
            names=["n_words", "n_removed", "kept"])

    def shaped(df: DataFrame, ranges: Column, columns: dict[str, Column]) -> DataFrame:
        return df.select(*[columns[c].alias(c) for c in docs.columns],
                         cut(text_of(columns[text_col]), ranges).alias(result))

    kind = docs.schema[id_col].dataType
    named = {id_col: F.col("doc").cast(kind), text_col: F.col("text"),
             **{c: F.col("rest").getField(c) for c in others}}
    nothing = F.lit(None).cast("array<struct<start: int, n: int>>")
    own = (F.col("doc") == F.col("k")) & (F.col("tag") == F.col("kt"))
    cut_rows = shaped(rows.join(found, own, "left"), F.col("ranges"), named)
    # A document without an id takes no part.
    unnamed = docs.filter(F.col(id_col).isNull())
    return cut_rows.union(shaped(unnamed, nothing, {c: F.col(f"`{c}`") for c in docs.columns}))


def result_column(docs: DataFrame) -> str:
    return free_name(docs, "_repeats")
