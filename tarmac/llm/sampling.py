"""Bounded samples of labelled rows for fitting the small models."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import text_of

def class_sample(rows: DataFrame, label: str, key: str, per_class: int) -> DataFrame:
    """About ``per_class`` rows of each label (all of a rarer one), chosen by a
    hash of ``key``: a filter, so no rows are moved to choose them. Only the
    number of rows of each label reaches the driver."""
    counts = {r[label]: r["n"] for r in rows.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    drawn = F.pmod(F.xxhash64(F.col(key), F.lit(17)), F.lit(1 << 30)).cast("double") / (1 << 30)
    keep = [(F.col(label) == F.lit(value)) & (drawn < min(1.0, per_class / n))
            for value, n in counts.items() if value is not None]
    return rows.filter(reduce(lambda a, b: a | b, keep, F.lit(False)))


def sampled_texts(docs: DataFrame, chosen: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, y, t): one text of each chosen id ``k`` with its label ``y``. An id on
    rows of several texts gives the one with the smallest hash, so the sample
    has no more rows than ids."""
    return (docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("t"))
            # The chosen ids are a bounded set, so they may be sent to every task.
            .join(F.broadcast(chosen), F.col("id") == F.col("k"))
            .groupBy("id", "y").agg(F.min_by("t", F.xxhash64("t")).alias("t")))
