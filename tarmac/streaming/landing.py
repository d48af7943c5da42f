"""Incremental load of newly landed CSV files with Structured Streaming.

The file stream source keeps the log of files already processed in its
checkpoint, which replaces the "skip years/files already loaded" checks of
a batch run and survives restarts. Each micro-batch names new files; they
alone are read, and are added to their years' tables as parts of their own.
A yearly table knows the files it holds (:func:`append_files`), so replaying a
micro-batch after a failure, or a stream that starts anew, adds no row twice;
a later batch load of the year makes one part of all. A file outside every year folder stops the
batch, so that it is not marked as processed and forgotten.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tarmac.plans.load import PREFIX, SCHEME, append_files, plain_path
from tarmac.session import ensure_checkpoint_dir
from tarmac.sources import files
from tarmac.sources.csv import CSV_GLOB

#: Files of a micro-batch at most.
MAX_FILES = 1000

# The fixed schema of the binaryFile source (streams need it stated).
BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def start_incremental_load(spark: SparkSession, landing_root: str, tables: str,
                           prefix: str = PREFIX, checkpoint: str | None = None,
                           available_now: bool = True, max_files: int = MAX_FILES) -> StreamingQuery:
    """Watch ``landing_root/<year>/**/*.csv`` and keep the yearly tables under
    ``tables`` current.

    ``available_now`` processes everything new and stops (a scheduled
    batch); otherwise the query keeps running. A micro-batch has at most
    ``max_files`` files; the driver sees their names, never rows."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    checkpoint = checkpoint or f"{root}/tarmac/streams/landing"

    found = (spark.readStream.format("binaryFile")
             .schema(BINARY_FILE_SCHEMA)
             .option("pathGlobFilter", CSV_GLOB)
             .option("recursiveFileLookup", "true")
             .option("maxFilesPerTrigger", max_files)
             .load(landing_root)
             .select("path"))

    # The folder right below the landing root names the year, files lie at any depth.
    base = plain_path(files.qualified(spark, landing_root)).rstrip("/")
    in_year = "^\\Q" + base + "\\E/([0-9]{4})/"

    def per_batch(batch: DataFrame, _batch_id: int) -> None:
        plain = F.regexp_replace("path", SCHEME, "/")
        by_year = batch.select("path", F.regexp_extract(plain, in_year, 1).alias("year")).groupBy(
            "year").agg(F.sort_array(F.collect_list("path")).alias("paths")).collect()
        lost = [r["paths"][0] for r in by_year if not r["year"]]
        if lost:
            raise ValueError(f"landed outside every year folder: {lost[0]}")
        for row in sorted(by_year, key=lambda r: r["year"]):
            append_files(batch.sparkSession, landing_root, tables, row["year"], row["paths"], prefix)

    writer = found.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="1 minute")
    return writer.start()
