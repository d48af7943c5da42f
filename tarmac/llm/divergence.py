"""Source divergence audit with count-level bitmaps.

Within a language every source is compared with every other one, and with the
language as a whole, by smoothed term shares

    p = 1 + floor(10^9 * (count + 2) / (N + 2 V)),   f = floor((p - q)^2 / (p + q)),

over the V terms that are in at least ``min_docs`` documents of the language.
A term's part f depends on two counts alone. So for each group (language,
source) and each count that occurs in it, a bitmap holds the ids of the terms
with that count. ANDing a bitmap of one group with one of another and counting
the bits gives the number of terms with that pair of counts, a joint cell,
which is multiplied by the cell's f. Cells with a zero count follow by
complement: what a bitmap shares with none of the other group's, and what no
bitmap of either group holds.

Terms are counted in the tasks, in bounded tables, and summed by Spark. Ids
are given in the order of falling counts, so a word of 64 ids meets few
different counts where terms are rare, and a bitmap is stored as its non-zero
words. Blocks of 4,096 ids and tiles of about 64 groups bound what a task
holds, whatever the numbers of terms and sources: a task ANDs the bitmaps of
one block and two tiles.

Defined results: a null text, language or source is the empty string; a group
without kept terms is compared like any other; without any kept term all pair
values are 0 and there are no term rows; repeated rows are documents of their
own; ties rank by the item's bytes; an empty table gives an empty result; other
columns are not read. Exact for counts below 9 * 10^15.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm.common import text_of, written

# What is no term in ASCII, the share's scale, and the count added to all.
NO_TERM = (*range(0x00, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80))
SCALE = 1_000_000_000
ADDED = 2

MIN_DOCS = 10
TOP_TERMS = 10
#: Term ids of a block (64 words of 64 bits), and groups of a tile on average.
BLOCK_SHIFT = 12
TILE = 64
#: Pairs of words that are ANDed at once.
AT_ONCE = 1 << 20

#: Distinct terms of its groups that a task counts before it hands them on, and
#: rows of what it hands on at once.
HELD_TERMS = 400_000
ROWS = 50_000

#: Lower-cases A-Z, and makes every byte that is in no term a space.
_TERM_BYTES = bytes(32 if b in NO_TERM else b + 32 if 65 <= b <= 90 else b for b in range(256))


def _terms(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8. A term is a run of letters A-Z and of code
    points beyond ASCII, and all bytes of the latter are beyond ASCII as well."""
    return text.translate(_TERM_BYTES).split()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of a task's documents, handed on whenever they fill the memory set aside."""
    occurrences: dict[tuple[str, str], Counter] = defaultdict(Counter)
    with_term: dict[tuple[str, str], Counter] = defaultdict(Counter)

    def flush() -> Iterator[pa.RecordBatch]:
        for (lang, source), n in occurrences.items():
            in_docs = with_term[lang, source]
            rows = pa.RecordBatch.from_arrays(
                [pa.repeat(pa.scalar(lang, pa.string()), len(n)), pa.repeat(pa.scalar(source, pa.string()), len(n)),
                 pa.array(n, pa.binary(), size=len(n)).cast(pa.string()),
                 pa.array(n.values(), pa.int64(), size=len(n)),
                 pa.array(map(in_docs.__getitem__, n), pa.int64(), size=len(n))],
                names=["lang", "source", "term", "n", "docs"])
            for lo in range(0, len(n), ROWS):
                yield rows.slice(lo, ROWS)
        occurrences.clear()
        with_term.clear()

    held = 0
    for batch in batches:
        langs, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for lang, source, text in zip(langs, sources, batch.column(2)):
            words = _terms(text.as_buffer().to_pybytes())
            known = occurrences[lang, source]
            held -= len(known)
            known.update(words)
            held += len(known)
            with_term[lang, source].update(set(words))
            if held > HELD_TERMS:
                yield from flush()
                held = 0
    yield from flush()


def term_counts(docs: DataFrame, lang_col: str, source_col: str, text_col: str) -> DataFrame:
    """(lang, source, term, n, docs): occurrences, and documents with the term."""
    texts = docs.select(*[text_of(F.col(f"`{c}`")).alias(name) for c, name in (
        (lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    counts = texts.mapInArrow(_count, "lang string, source string, term string, n bigint, docs bigint")
    return counts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def kept_terms(counts: DataFrame, min_docs: int) -> DataFrame:
    """(lang, term, n_lang, id) of the kept terms; ids ascend with falling counts."""
    order = [F.col("lang"), F.col("n_lang").desc(), F.col("term")]
    return (counts.groupBy("lang", "term").agg(F.sum("n").alias("n_lang"), F.sum("docs").alias("docs"))
            .filter(F.col("docs") >= min_docs).select("lang", "term", "n_lang")
            .repartitionByRange(*order).sortWithinPartitions(*order)
            .withColumn("id", F.monotonically_increasing_id()))


def _share(count: str, total: str, terms: str) -> Column:
    """p of a count, exact: the product may be beyond a bigint."""
    return F.expr(f"1 + (cast({count} + {ADDED} AS decimal(20, 0)) * cast({SCALE} AS decimal(10, 0))) "
                  f"DIV cast({total} + {ADDED} * {terms} AS decimal(20, 0))")


def shares(count: np.ndarray, total: np.ndarray | int, terms: int) -> np.ndarray:
    """p of counts, exact in 64 bits: a long division by three digits at a time."""
    left = np.asarray(count, np.int64) + ADDED
    whole = np.asarray(total, np.int64) + ADDED * terms
    out = np.zeros_like(left)
    for _ in range(3):
        left = left * 1000
        out, left = out * 1000 + left // whole, left % whole
    return out + 1


def _f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


class _Group:
    """The non-zero bitmap words of one group in one block."""

    __slots__ = ("name", "word", "bits", "p", "pop", "p0")

    def __init__(self, name, word, bits, level, total: int, terms: int):
        self.name, self.word, self.bits = name, word, bits
        self.p = shares(level, total, terms)
        self.p0 = int(shares(np.zeros(1), total, terms)[0])
        self.pop = np.bitwise_count(bits).astype(np.int64)


def _joint(one: _Group, others: list[_Group], ids: int) -> np.ndarray:
    """Sum of f over the block's ``ids`` terms, for ``one`` with each other group."""
    p0 = np.array([g.p0 for g in others], np.int64)
    none = _f(one.p0, p0)  # f of a term that neither has
    # Zeros by complement: first as if the two shared no term at all ...
    levels, at = np.unique(one.p, return_inverse=True)
    held = np.zeros(len(levels), np.int64)
    np.add.at(held, at, one.pop)
    total = ids * none + (held[:, None] * (_f(levels[:, None], p0) - none)).sum(axis=0)
    owner = np.repeat(np.arange(len(others)), [len(g.word) for g in others])
    word, bits, p, pop = (np.concatenate([getattr(g, x) for g in others])
                          for x in ("word", "bits", "p", "pop"))
    np.add.at(total, owner, pop * (_f(one.p0, p) - none[owner]))
    # ... then every joint cell takes the place of the two it was counted in.
    order = np.argsort(word, kind="stable")
    owner, word, bits, p = owner[order], word[order], bits[order], p[order]
    first = np.searchsorted(word, one.word, side="left")
    n = np.searchsorted(word, one.word, side="right") - first
    ends = np.cumsum(n)
    lo = 0
    while lo < len(n):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + AT_ONCE, side="right")))
        mine = np.repeat(np.arange(lo, hi), n[lo:hi])
        starts = np.cumsum(n[lo:hi]) - n[lo:hi]
        theirs = np.arange(len(mine)) - np.repeat(starts - first[lo:hi], n[lo:hi])
        both = np.bitwise_count(one.bits[mine] & bits[theirs]).astype(np.int64)
        hit = np.flatnonzero(both)
        mine, theirs, both = mine[hit], theirs[hit], both[hit]
        g, mp, tp = owner[theirs], one.p[mine], p[theirs]
        np.add.at(total, g, both * (_f(mp, tp) - _f(mp, p0[g]) - _f(one.p0, tp) + none[g]))
        lo = hi
    return total


def _block_pairs(table: pa.Table) -> pa.Table:
    """One block of ids, two tiles of groups: (lang, one, other, value)."""
    a, b = table.column("a")[0].as_py(), table.column("b")[0].as_py()
    tile = table.column("tile").to_numpy()
    names = table.column("source").combine_chunks().dictionary_encode()
    code = names.indices.to_numpy()
    total = table.column("total").to_numpy()
    bits = table.column("bits").to_numpy().view(np.uint64)
    word, level = table.column("word").to_numpy(), table.column("level").to_numpy()
    head = total >= 0  # the row that names the group; all others hold a bitmap word
    first = int(np.flatnonzero(head)[0])
    ids, terms = (table.column(c)[first].as_py() for c in ("ids", "terms"))
    lang = table.column("lang")[0].as_py()
    order = np.argsort(code, kind="stable")
    cuts = np.searchsorted(code[order], np.arange(len(names.dictionary) + 1))
    groups: dict[int, list[_Group]] = {a: [], b: []}
    for i, name in enumerate(names.dictionary.to_pylist()):
        rows = order[cuts[i]:cuts[i + 1]]
        words = rows[~head[rows]]
        groups[int(tile[rows[0]])].append(_Group(
            name, word[words], bits[words], level[words], int(total[rows[head[rows]][0]]), terms))
    out: list[tuple] = []
    groups[a].sort(key=lambda g: g.name)  # a pair has the same order in every block
    for i, one in enumerate(groups[a]):
        others = groups[b] if a != b else groups[a][i + 1:]
        if others:
            out += zip([one.name] * len(others), (g.name for g in others),
                       _joint(one, others, ids).tolist())
    cols = list(zip(*out)) or [(), (), ()]
    return pa.table({"lang": pa.array([lang] * len(out), pa.string()), "one": pa.array(cols[0], pa.string()),
                     "other": pa.array(cols[1], pa.string()), "value": pa.array(cols[2], pa.int64())})


def bitmaps(known: DataFrame) -> DataFrame:
    """(lang, source, word, level, bits): the non-zero words of the bitmaps of
    the terms that a group has ``level`` times."""
    return (known.withColumn("bit", F.expr("shiftleft(1L, cast(id & 63 AS int))"))
            .groupBy("lang", "source", F.shiftright("id", 6).alias("word"), F.col("n").alias("level"))
            .agg(F.bit_or("bit").alias("bits")))


def _pair_values(known: DataFrame, groups: DataFrame, blocks: DataFrame) -> DataFrame:
    """(lang, one, other, value), each pair once, in languages with kept terms."""
    place = groups.filter("terms > 0").select("lang", "source", "tile", "tiles", "total", "terms")
    words = bitmaps(known).join(place.select("lang", "source", "tile", "tiles"), ["lang", "source"]).select(
        "lang", "source", "tile", "tiles", F.shiftright("word", BLOCK_SHIFT - 6).alias("block"), "word",
        "level", "bits", F.lit(-1).cast("bigint").alias("total"), F.lit(0).cast("bigint").alias("terms"),
        F.lit(0).cast("bigint").alias("ids"))
    # Every group has a row in every block: what it lacks there counts as well.
    heads = place.join(blocks, "lang").select(
        "lang", "source", "tile", "tiles", "total", "terms", F.inline("blocks")).select(
        "lang", "source", "tile", "tiles", "block", F.lit(0).cast("bigint").alias("word"),
        F.lit(0).cast("bigint").alias("level"), F.lit(0).cast("bigint").alias("bits"),
        "total", "terms", "ids")
    dealt = words.unionByName(heads).withColumn("with", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    dealt = dealt.withColumns({"a": F.least("tile", "with"), "b": F.greatest("tile", "with")}).drop(
        "with", "tiles")
    parts = dealt.groupBy("lang", "block", "a", "b").applyInArrow(
        _block_pairs, "lang string, one string, other string, value bigint")
    return parts.groupBy("lang", "one", "other").agg(F.sum("value").alias("value"))


def _no_term_pairs(groups: DataFrame) -> DataFrame:
    """Pairs of languages without any kept term: their value is 0."""
    empty = groups.filter("terms = 0").select("lang", "source", "tile", "tiles")
    left = empty.select("lang", F.col("source").alias("one"),
                        F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("tile"))
    right = empty.select("lang", F.col("source").alias("other"), "tile")
    return left.join(right, ["lang", "tile"]).filter("one < other").select(
        "lang", "one", "other", F.lit(0).cast("bigint").alias("value"))


def divergence(docs: DataFrame, lang_col: str = "lang", source_col: str = "source",
               text_col: str = "text", min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): for each group all other sources
    of its language (``pair``) and its ``top`` terms (``term``)."""
    counts = written(term_counts(docs, lang_col, source_col, text_col), "divergence-counts")
    terms = written(kept_terms(counts, min_docs), "divergence-terms")
    known = written(counts.select("lang", "source", "term", "n").join(terms, ["lang", "term"]),
                    "divergence-known")
    blocks = (terms.groupBy("lang", F.shiftright("id", BLOCK_SHIFT).alias("block"))
              .agg(F.count(F.lit(1)).alias("ids"))
              .groupBy("lang").agg(F.collect_list(F.struct("block", "ids")).alias("blocks")))
    langs = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("n_lang").alias("lang_total"))
    all_groups = docs.select(text_of(F.col(f"`{lang_col}`")).alias("lang"),
                             text_of(F.col(f"`{source_col}`")).alias("source")).distinct()
    sizes = all_groups.groupBy("lang").agg(
        F.ceil(F.count(F.lit(1)) / F.lit(float(TILE))).cast("int").alias("tiles"))
    zero = F.lit(0).cast("bigint")
    groups = written(
        all_groups.join(sizes, "lang").join(langs, "lang", "left")
        .join(known.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left")
        .select("lang", "source", "tiles", F.pmod(F.xxhash64("source"), F.col("tiles")).cast("int").alias("tile"),
                F.coalesce("total", zero).alias("total"), F.coalesce("terms", zero).alias("terms"),
                F.coalesce("lang_total", zero).alias("lang_total")), "divergence-groups")

    once = _pair_values(known, groups, blocks).unionByName(_no_term_pairs(groups))
    both = once.select("lang", F.inline(F.array(
        F.struct(F.col("one").alias("source"), F.col("other").alias("item")),
        F.struct(F.col("other").alias("source"), F.col("one").alias("item")))), "value")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    pairs = both.select("lang", "source", F.lit("pair").alias("part"), "item", "value",
                        F.row_number().over(order).alias("rank"))

    shared = known.join(groups, ["lang", "source"]).withColumns(
        {"p": _share("n", "total", "terms"), "q": _share("n_lang", "lang_total", "terms")})
    found = (shared.filter("p > q")
             .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                     F.expr("((p - q) * (p - q)) DIV (p + q)").alias("value"))
             .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top))
    return pairs.unionByName(found)
