"""Document fingerprints by consistent weighted sampling.

A text is a weighted set: its lower-cased words, each weighted by how often it
occurs. For every term and each of ``samples`` positions of the signature a
hash gives two Gamma(2, 1) variables r, c and a uniform b. With weight s,

    t = floor(ln s / r + b),   ln a = ln c - r * (t - b + 1),

and the term with the least a is the position's sample, together with its t.
Two texts get the same (term, t) with a probability equal to their generalised
Jaccard similarity, the sum of smaller weights over the sum of larger ones; so
the share of equal positions estimates it.

Only DataFrame functions are used. Rows are dealt once, by ranges of ids that
hold about equal numbers of rows; words are counted, samples drawn and
neighbours paired within those ranges, without moving a word again. A least
value and its term travel as one bigint (ln a above, a 32-bit hash of term and
t below), so each position is a plain ``min``.

Defined results: a null or empty text, or one without words, has the signature
of all ones; two such texts have likeness 1. The next document is that with
the next smaller id (a null id is smaller than any other; among rows of one id
the smaller text hash is first); after the last comes the first, and a lone
row is its own next. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm.common import shuffle_partitions, text_of

SAMPLES = 32

#: Characters of text in a range, so that counting its words needs little
#: memory, and the number of ranges at most (beyond it, ranges grow and Spark
#: spills what does not fit).
RANGE_CHARS = 4_000_000
MAX_RANGES = 50_000
WORD_BREAK = r"[\s\p{Punct}]+"

_LOW = (1 << 32) - 1
_LEAST_ID = -(1 << 63)


def _uniform(bits: Column, width: int) -> Column:
    """A value strictly between 0 and 1 from ``width`` random bits."""
    return (bits + F.lit(0.5)) / F.lit(float(1 << width))


def _gamma2(u: Column, v: Column) -> Column:
    """Gamma(2, 1): the sum of two exponential variables."""
    return -F.ln(u * v)


def weighted_sample(term: Column, weight: Column, position: int) -> Column:
    """ln a and (term, t) of one term at one position, packed into a bigint."""
    first = F.xxhash64(term, F.lit(2 * position))
    second = F.xxhash64(term, F.lit(2 * position + 1))
    r = _gamma2(_uniform(F.shiftrightunsigned(first, 32), 32),
                _uniform(first.bitwiseAND(F.lit(_LOW)), 32))
    c = _gamma2(_uniform(F.shiftrightunsigned(second, 42), 22),
                _uniform(F.shiftrightunsigned(second, 21).bitwiseAND(F.lit((1 << 21) - 1)), 21))
    b = _uniform(second.bitwiseAND(F.lit((1 << 21) - 1)), 21)
    t = F.floor(F.ln(weight) / r + b)
    ln_a = F.ln(c) - r * (t - b + F.lit(1.0))
    high = ((ln_a + F.lit(512.0)) * F.lit(float(1 << 21))).cast("bigint")
    return F.shiftleft(high, 32).bitwiseOR(F.xxhash64(term, t).bitwiseAND(F.lit(_LOW)))


def signatures(texts: DataFrame, keys: list[str], samples: int = SAMPLES) -> DataFrame:
    """``keys`` (which name a row) and ``signature``, 8 hex digits per sample,
    for each row of ``texts`` with a word in its column ``text``."""
    terms = (
        texts.select(*keys, F.explode(F.split(F.lower("text"), WORD_BREAK)).alias("word"))
        .filter("word != ''")
        .groupBy(*keys, F.xxhash64("word").alias("term"))
        .agg(F.count(F.lit(1)).cast("double").alias("weight"))
    )
    drawn = terms.groupBy(*keys).agg(
        *[F.min(weighted_sample(F.col("term"), F.col("weight"), i)).alias(f"s{i}")
          for i in range(samples)])
    return drawn.select(*keys, F.lower(F.concat(
        *[F.lpad(F.hex(F.col(f"s{i}").bitwiseAND(F.lit(_LOW))), 8, "0") for i in range(samples)]
    )).alias("signature"))


def likeness(a: Column, b: Column, samples: int = SAMPLES) -> Column:
    """Share of the positions in which two signatures agree."""
    def piece(x: Column, i: Column) -> Column:
        return F.substring(x, i * 8 + 1, F.lit(8))

    agreed = F.aggregate(F.sequence(F.lit(0), F.lit(samples - 1)), F.lit(0),
                         lambda n, i: n + (piece(a, i) == piece(b, i)).cast("int"))
    return agreed / F.lit(float(samples))


def _ranges(ids: DataFrame, parts: int) -> list[int]:
    """Lowest ids of ``parts`` ranges with about equal numbers of rows, padded
    to one less than a power of two."""
    shares = [i / parts for i in range(1, parts)]
    found = []
    if shares:
        row = ids.agg(F.percentile_approx("ord", shares, F.lit(max(10_000, 10 * parts)))).first()
        found = sorted(set(row[0] or []))
    size = (1 << max(1, len(found).bit_length())) - 1
    return found + [(1 << 63) - 1] * (size - len(found))


def _range_of(ord_: Column, bounds: list[int]) -> Column:
    """How many of the bounds are at most ``ord_``, by binary search."""
    # one literal, folded into an array when the plan is made
    table = F.split(F.lit(" ".join(map(str, bounds))), " ").cast("array<bigint>")
    steps, step = [], (len(bounds) + 1) // 2
    while step:
        steps.append(step)
        step //= 2
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]), F.lit(0),
        lambda at, s: F.when(F.element_at(table, at + s) <= ord_, at + s).otherwise(at))


def _with_next(docs: DataFrame, parts: int) -> DataFrame:
    """Rows with their range, place in it, and the next row's text. Each range
    ends with a copy of the row that follows it in the next range."""
    rows = docs.select("doc_id", F.coalesce("doc_id", F.lit(_LEAST_ID)).alias("ord"), "text")
    bounds = _ranges(rows.select("ord"), parts)
    # never null, so no later join adds a test for null to one use of the rows
    rows = rows.withColumn("part", F.coalesce(_range_of(F.col("ord"), bounds), F.lit(0)))
    # One row for each range, so at most ``parts`` rows.
    tops = sorted(tuple(r) for r in rows.groupBy("part").agg(F.max("ord")).collect())
    follows = [(top, tops[(i + 1) % len(tops)][0]) for i, (_, top) in enumerate(tops)]
    borders = docs.sparkSession.createDataFrame(follows, "top bigint, into int")
    copies = rows.join(F.broadcast(borders), F.col("ord") == F.col("top")).select(
        "doc_id", "ord", "text", F.coalesce("into", F.lit(0)).alias("part"), F.lit(True).alias("copy"))
    both = rows.select("doc_id", "ord", "text", "part", F.lit(False).alias("copy")).union(copies)
    dealt = both.repartitionById(len(bounds) + 1, F.col("part"))
    order = Window.partitionBy("part").orderBy("copy", F.desc("ord"), F.xxhash64("text"))
    return dealt.select("part", "copy", "doc_id", "ord", "text", F.row_number().over(order).alias("place"),
                        F.coalesce(F.lead("text").over(order), F.lit("")).alias("next_text"))


def edited(text: Column, following: Column) -> Column:
    """The last half of the code points replaced by the next text's first."""
    half = F.floor(F.char_length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.char_length(text) - half),
                    F.substring(following, F.lit(1), half))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 samples: int = SAMPLES) -> DataFrame:
    """doc_id, n_chars, the edited text's hash, both fingerprints, and the
    likeness of a document to its edited text and to the next document."""
    docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_of(text_col).alias("text"))
    total = docs.agg(F.sum(F.char_length("text"))).first()[0] or 0
    parts = min(-(-total // RANGE_CHARS), MAX_RANGES)
    rows = _with_next(docs, max(1, shuffle_partitions(docs.sparkSession), parts))
    rows = rows.withColumn("edit", edited(F.col("text"), F.col("next_text")))
    # The filter lets every row pass. It keeps the id in the dealt rows, so that
    # both uses of them read one shuffle.
    texts = rows.filter(F.col("ord") <= F.coalesce("doc_id", "ord")).select("part", "place", F.inline(F.array(
        F.struct(F.lit(0).alias("kind"), F.col("text").alias("text")),
        F.struct(F.lit(1).alias("kind"), F.col("edit").alias("text")))))
    found = signatures(texts, ["part", "place", "kind"], samples)
    pairs = found.groupBy("part", "place").agg(
        F.max(F.when(F.col("kind") == 0, F.col("signature"))).alias("own"),
        F.max(F.when(F.col("kind") == 1, F.col("signature"))).alias("other"))
    none = F.lit("f" * (8 * samples))
    full = rows.select("part", "place", "copy", "doc_id", F.char_length("text").cast("bigint").alias("n_chars"),
                       F.sha2("edit", 256).alias("edited_sha256")).join(pairs, ["part", "place"], "left")
    full = full.withColumns({"own": F.coalesce("own", none), "other": F.coalesce("other", none)})
    following = F.lead("own").over(Window.partitionBy("part").orderBy("place"))
    full = full.withColumn("following", F.coalesce(following, F.col("own"))).filter("not copy")
    return full.select(
        "doc_id", "n_chars", "edited_sha256", F.col("own").alias("fingerprint"),
        F.col("other").alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("other"), samples).alias("near_edited"),
        likeness(F.col("own"), F.col("following"), samples).alias("near_next"))
