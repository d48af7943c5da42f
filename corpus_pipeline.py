"""The training-corpus pipeline: five stages, each one of the corpus operators.

A stage is (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame. All but the last return the columns of ``docs``; the last
returns the packed pieces. :func:`run` writes each stage's result as Parquet
to the session's shared folder and reads it again for the next one, so a stage
works on exactly what its predecessor kept, and lost executors cost re-reads.

Defined results: a null text is an empty one; extra columns pass through; an
empty table stays empty up to the end. ``n_chars``, if there, is kept equal to
the number of code points where a stage shortens a text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm import exact, packing, quality, simhash, substring
from tarmac.llm.common import (documents, fold, free_name, own_columns, read_table, ship_package,
                               written)
from tarmac.llm.queries import GOOD_FROM, tokenizer_file


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a quality score of at least ``GOOD_FROM``."""
    ship_package(spark)
    labels = read_table(spark, sf_dir, "labels").filter(fold("doc_id", 5) != 0)
    model = quality.fit_quality(docs, labels)
    score = free_name(docs, "_score")
    return (docs.withColumn(score, quality.quality_score(model, F.col("text")))
            .filter(F.col(score) >= GOOD_FROM).drop(score))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest id."""
    ship_package(spark)
    return exact.drop_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies, the smallest id."""
    ship_package(spark)
    return simhash.drop_near_duplicates(docs, shingle=3, radius=3)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of windows that a document with a smaller id has too are cut out.
    A text that loses words has the others joined by one space; any other
    text stays as it is."""
    ship_package(spark)
    cut = substring.remove_repeats(docs, window=50)
    found = F.col(substring.result_column(docs))
    shorter = found["n_removed"] > 0
    changed = {"text": F.when(shorter, found["kept"]).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(shorter, F.char_length(found["kept"])).otherwise(
            F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return cut.withColumns(changed).select(own_columns(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokenised pieces, packed into sequences of 1,024 ids."""
    ship_package(spark)
    return packing.pack(docs, tokenizer_file("byte_bpe_50k.json"), capacity=1024, end_id=2)


STAGES = [
    ("quality", drop_low_quality),
    ("exact dedup", drop_exact_copies),
    ("near dedup", drop_near_copies),
    ("substring dedup", cut_repeats),
    ("packing", pack_sequences),
]

#: A fitted network, SimHash and packing are beyond SQL; tests hold the stages
#: against brute force.
ORACLE_SQL = None


#: Rows that a task and its Python worker exchange at once. All stages run in
#: the same executors, so what one of them holds adds to the others' memory.
ROWS_AT_ONCE = 2000
_ROWS_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs, before = documents(spark, sf_dir), spark.conf.get(_ROWS_SETTING)
    spark.conf.set(_ROWS_SETTING, ROWS_AT_ONCE)
    try:
        for name, stage in STAGES:
            docs = written(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    finally:
        spark.conf.set(_ROWS_SETTING, before)
    return docs
