"""Landed CSV files: a manifest of their layouts, and one scan for all of them.

Monthly files arrive in UTF-8 or Latin-1 and in two column layouts. One
distributed pass over the lines works out, per split of a file, whether every
line is valid UTF-8, how many quotes it has and what the header is; the splits
of a file give its row in the manifest, a small table in the session's shared
folder. Rows then meet the manifest by the file they come from, and each is
parsed by its file's layout, so no list of files is made on the driver: it sees
one row per layout.

A file belongs to one of three kinds:

* ``plain``: no quoted field has a line end, so every line is a record;
* ``spanning``: some do. Whether a split of such a file begins inside quotes
  follows from the quotes of the splits before it, so the splits are read by as
  many tasks as those of any other file. Only records cut by the end of a split
  are put together from both sides;
* ``whole``: its quotes do not pair up as quoted fields (one stands inside an
  unquoted field, or one is never closed). What a record is then depends on all
  text before it, so one task reads the file. These exceptions are named to the
  reader by their paths.

Fields are quoted with doubled quotes and there is no escape character, so a
backslash is an ordinary character.
"""

from __future__ import annotations

import re
import uuid
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.functions.exprs import let
from tarmac.session import ensure_checkpoint_dir

# The two encodings tried, in order; Latin-1 decodes any bytes,
# so no third fallback can ever be reached.
ENCODINGS = ("UTF-8", "ISO-8859-1")
# Matches ".csv" in any letter case.
CSV_GLOB = "*.[cC][sS][vV]"

SOURCE_FILE = "source_file"
REJECTED = "rejected_record"
PLAIN, SPANNING, WHOLE = "plain", "spanning", "whole"

#: Stands between no two fields: a line that has it is read as part of a whole file.
_NO_SEPARATOR = "\x01\x02\x03"
#: Bytes of paths and layouts of files up to which they are sent to every task.
BROADCAST_BYTES = 8 << 20
_BLANK = r"^[\x00-\x20]*$"
#: A quoted field, from its first to its last quote.
_QUOTED_FIELD = r'(?:\A|(?<=,))"[^"]*+(?:""[^"]*+)*+"(?=,|\z)'
_OPTIONS = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": REJECTED}


def year_dir(root: str, year: str | int) -> str:
    root = root.rstrip("/")
    return f"{root}/{year}" if root else str(year)


def _found(reader):
    return reader.option("pathGlobFilter", CSV_GLOB).option("recursiveFileLookup", "true")


def _path() -> Column:
    return F.col("_metadata.file_path")


def _literal(path: str) -> str:
    """A path as file metadata write it, for a reader: without percent codes,
    and without characters that would make it a pattern."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", unquote(path))


def _quotes(text: Column) -> Column:
    return F.length(F.regexp_replace(text, '[^"]+', ""))


def _splits(spark: SparkSession, where: str | list[str]) -> DataFrame:
    """One row per split: its encoding, quotes and first line."""
    lines = _found(spark.read).text(where)
    # Every split of a file is read by one task, in order, so ``first`` of the
    # split at offset 0 is the header line.
    return lines.groupBy(_path().alias("path"), F.col("_metadata.file_block_start").alias("at")).agg(
        F.bool_and(F.is_valid_utf8("value")).alias("is_utf8"),
        F.bool_or(_quotes(F.col("value")) % 2 == 1).alias("spans_lines"),
        F.bool_or(F.contains("value", F.lit(_NO_SEPARATOR))).alias("odd_text"),
        F.sum(_quotes(F.col("value"))).alias("quotes"),
        F.first(F.col("value").cast("binary")).alias("line"))


def list_csv(spark: SparkSession, root: str, year: str | int | None = None) -> DataFrame:
    """Files ending in ``.csv`` (any case) anywhere under ``root[/year]``:
    ``path``, ``is_utf8``, ``spans_lines`` (a line has an odd number of quotes)
    and the raw bytes of the ``header`` line. Raises when there are none."""
    where = year_dir(root, year) if year is not None else root
    files = _listed(_splits(spark, where)).drop("odd_text")
    if files.isEmpty():
        raise ValueError(f"no CSV file under {where}")
    return files


def _listed(splits: DataFrame) -> DataFrame:
    return splits.groupBy("path").agg(
        F.bool_and("is_utf8").alias("is_utf8"), F.bool_or("spans_lines").alias("spans_lines"),
        F.bool_or("odd_text").alias("odd_text"), F.min_by("line", "at").alias("header"))


# ------------------------------------------------- records over several lines

def _spanning_records(spark: SparkSession, where: str | list[str], files: DataFrame) -> DataFrame:
    """(path, at, rec, record): the records of the given spanning files, split
    by split. ``files``: path, at, opens (the split begins inside quotes)."""
    lines = _found(spark.read).text(where).select(
        "value", _path().alias("path"), F.col("_metadata.file_block_start").alias("at"),
        F.monotonically_increasing_id().alias("id"))  # lines of a split, in order
    lines = lines.join(files, ["path", "at"]).withColumn("q", _quotes(F.col("value")))
    order = Window.partitionBy("path", "at").orderBy("id")
    before = F.coalesce(F.sum("q").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = lines.withColumn("start", (before + F.col("opens").cast("int")) % 2 == 0)
    numbered = starts.withColumn("rec", F.sum(F.col("start").cast("int")).over(
        order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    parts = numbered.groupBy("path", "at", "rec").agg(
        _in_order(F.struct("id", "value")).alias("record"), (F.sum("q") % 2 == 1).alias("odd"))
    # Record 0 of a split goes on from an earlier one; an odd one is cut by the end.
    cut = (F.col("rec") == 0) | F.col("odd")
    pieces = parts.filter(cut).withColumn("owner", F.sum((F.col("rec") > 0).cast("int")).over(
        Window.partitionBy("path").orderBy("at", "rec")))
    joined = pieces.groupBy("path", "owner").agg(
        F.min(F.struct("at", "rec")).alias("first"), _in_order(F.struct("at", "rec", F.col("record").alias("value")))
        .alias("record"))
    records = parts.filter(~cut).select("path", "at", "rec", "record").union(
        joined.select("path", "first.at", "first.rec", "record"))
    return records.filter(~F.col("record").rlike(_BLANK))


def _in_order(line: Column) -> Column:
    lines = F.sort_array(F.collect_list(line))
    return F.array_join(F.transform(lines, lambda x: x["value"]), "\n")


def _opens(splits: DataFrame) -> DataFrame:
    """(path, at, opens) of the splits: an odd number of quotes came before."""
    earlier = Window.partitionBy("path").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    return splits.select("path", "at", (
        F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2 == 1).alias("opens"))


# ------------------------------------------------------------------- manifest

def _written(df: DataFrame, name: str) -> DataFrame:
    root = ensure_checkpoint_dir(df.sparkSession).rstrip("/")
    path = f"{root}/tarmac/csv/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def file_manifest(spark: SparkSession, where: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """Two small written tables. One row per file: ``path``, ``is_utf8``,
    ``header`` (its first line, as bytes) and ``kind``; and of the spanning files
    one row per split: ``path``, ``at``, ``opens``."""
    splits = _written(_splits(spark, where), "splits")
    files = _listed(splits)
    spanning = files.filter("spans_lines and not odd_text").select("path")
    opens = _written(_opens(splits.join(spanning, "path")), "opens")
    odd = F.when(F.col("odd_text"), WHOLE)
    if opens.isEmpty():  # no lines to put together
        return _written(files.select("path", "is_utf8", "header", odd.otherwise(PLAIN).alias("kind")),
                        "manifest"), opens
    # A file's quotes pair up if nothing but quoted fields holds any, and if
    # its first line is its header.
    records = _spanning_records(spark, where, opens)
    regular = records.groupBy(F.col("path").alias("p")).agg(
        (F.bool_and(~F.contains(F.regexp_replace("record", _QUOTED_FIELD, ""), F.lit('"'))) &
         (F.min(F.struct("at", "rec")) == F.struct(F.lit(0).cast("bigint"), F.lit(1).cast("bigint"))) &
         ~F.contains(F.min_by("record", F.struct("at", "rec")), F.lit("\n"))).alias("regular"))
    kind = odd.when(~F.col("spans_lines"), PLAIN).when(
        F.coalesce("regular", F.lit(False)), SPANNING).otherwise(WHOLE)
    manifest = _written(files.join(regular, F.col("path") == F.col("p"), "left").select(
        "path", "is_utf8", "header", kind.alias("kind")), "manifest")
    return manifest, opens


# ----------------------------------------------------------------------- read

def _fields(record: Column) -> Column:
    """Number of fields of a raw record: separators outside quotes, plus one."""
    bare = F.regexp_replace(record, r'"[^"]*+"', "")
    return let(bare, lambda b: F.length(b) - F.length(F.replace(b, F.lit(","), F.lit("")))) + 1


def _parsed(records: DataFrame, layouts: list[list[str]]) -> DataFrame:
    """``records`` (record, layout, path) parsed by their layouts, all columns
    by name; REJECTED has the records with more fields than their header."""
    structs = []
    for i, names in enumerate(layouts):
        ddl = ", ".join(f"`{n.replace('`', '``')}` STRING" for n in [*names, REJECTED])
        structs.append(F.when(F.col("layout") == i, F.from_csv("record", ddl, _OPTIONS)).alias(f"p{i}"))
    # As the column of a generated row each record is parsed once: a filter or
    # projection above would repeat the parsing for each column it names.
    parsed = records.select("path", F.explode(F.array(F.struct(*structs))).alias("parsed")).select("path", "parsed.*")
    columns: dict[str, list[Column]] = {}
    rejected = []
    for i, names in enumerate(layouts):
        for name in names:
            columns.setdefault(name, []).append(F.col(f"p{i}").getField(name))
        raw = F.col(f"p{i}").getField(REJECTED)
        rejected.append(F.when(_fields(raw) > len(names), raw))
    return parsed.select(*[F.coalesce(*parts).alias(name) for name, parts in columns.items()],
                         F.coalesce(*rejected).alias(REJECTED), F.col("path").alias(SOURCE_FILE))


def _plain_records(spark: SparkSession, where: str | list[str], tagged: DataFrame) -> DataFrame:
    """Every line after its file's header. The CSV scan drops header and blank
    lines; read as Latin-1 without separator and quotes it leaves the bytes."""
    lines = (_found(spark.read).schema("value string").option("header", True).option("encoding", ENCODINGS[1])
             .option("sep", _NO_SEPARATOR).option("quote", "").csv(where)
             .select("value", _path().alias("path")))
    utf8 = F.encode("value", ENCODINGS[1]).cast("string")
    return lines.join(tagged.filter(F.col("kind") == PLAIN), "path").select(
        "path", "layout", F.when(F.col("is_utf8"), utf8).otherwise(F.col("value")).alias("record"))


def _records_of_spanning(spark: SparkSession, where: str | list[str], tagged: DataFrame,
                         opens: DataFrame) -> DataFrame:
    files = tagged.filter(F.col("kind") == SPANNING)
    splits = opens.join(files.select("path"), "path", "left_semi")
    records = _spanning_records(spark, where, splits).filter("at > 0 or rec > 1")  # the header is the first
    latin = F.decode(F.col("record").cast("binary"), ENCODINGS[1])
    return records.join(files, "path").select(
        "path", "layout", F.when(F.col("is_utf8"), F.col("record")).otherwise(latin).alias("record"))


def _whole_files(spark: SparkSession, paths: list[str], is_utf8: bool, names: list[str]) -> DataFrame:
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, REJECTED]])
    df = (spark.read.options(**_OPTIONS).option("header", True).option("multiLine", True)
          .option("encoding", ENCODINGS[0 if is_utf8 else 1]).option("columnPruning", "false")
          .schema(schema).csv([_literal(p) for p in paths]))
    # Spark reads the raw record only together with a data column; the test
    # on the first one is always true and keeps it in every scan.
    data = F.length(F.coalesce(F.col(f"`{names[0]}`"), F.lit(""))) >= 0
    too_many = data & (_fields(F.col(REJECTED)) > len(names))
    return df.select(*[F.col(f"`{n}`") for n in names], F.when(too_many, F.col(REJECTED)).alias(REJECTED),
                     _path().alias(SOURCE_FILE))


def read_csv(spark: SparkSession, root: str, year: str | int | None = None,
             paths: list[str] | None = None) -> DataFrame:
    """All CSV files under ``root[/year]`` (or just those of ``paths``) as one
    string-typed DataFrame with two more columns: ``source_file``, and
    ``rejected_record``, the raw text of a record with more fields than its
    header (null for all others).

    Each file is decoded as UTF-8 when all of it is valid UTF-8, otherwise as
    Latin-1; columns are matched by name across files (absent ones are null).
    A record with fewer fields has nulls at its end."""
    where = paths or (year_dir(root, year) if year is not None else root)
    manifest, opens = file_manifest(spark, where)
    # One row per layout; paths only of the files that one task must read.
    groups = sorted(manifest.groupBy("is_utf8", "header").agg(
        F.min("path").alias("example"), F.count_if(F.col("kind") == PLAIN).alias("plain"),
        F.count_if(F.col("kind") == SPANNING).alias("spanning"), F.min_by("kind", "path").alias("kind"),
        F.sum(F.length("path") + 64).alias("bytes"),
        F.sort_array(F.collect_list(F.when(F.col("kind") == WHOLE, F.col("path")))).alias("whole")).collect(),
        key=lambda g: g["example"])
    if not groups:
        raise ValueError(f"no CSV file under {where}")
    layouts = [
        spark.read.options(**_OPTIONS).option("header", True).option("multiLine", g["kind"] != PLAIN)
        .option("encoding", ENCODINGS[0 if g["is_utf8"] else 1]).csv(_literal(g["example"])).columns
        for g in groups]
    numbered = spark.createDataFrame([(g["is_utf8"], g["header"], i) for i, g in enumerate(groups)],
                                     "is_utf8 boolean, header binary, layout int")
    tagged = manifest.join(F.broadcast(numbered), ["is_utf8", "header"]).select("path", "kind", "is_utf8", "layout")
    # Lines that are joined by path meet in one task for each file, however large
    # it is. Only where files are too many to be sent around do lines move.
    if sum(g["bytes"] for g in groups) <= BROADCAST_BYTES:
        tagged = F.broadcast(tagged)
    frames = []
    if any(g["plain"] for g in groups):
        frames.append(_parsed(_plain_records(spark, where, tagged), layouts))
    if any(g["spanning"] for g in groups):
        frames.append(_parsed(_records_of_spanning(spark, where, tagged, opens), layouts))
    frames += [_whole_files(spark, g["whole"], g["is_utf8"], names)
               for g, names in zip(groups, layouts) if g["whole"]]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_csv_mixed_encoding(spark: SparkSession, root: str, year: str | int | None = None,
                            with_source: bool = True) -> DataFrame:
    """Whole records of :func:`read_csv`; reading a record with too many fields
    stops the job."""
    df = read_csv(spark, root, year)
    message = F.concat(F.col(SOURCE_FILE), F.lit(": a record has more fields than the header: "),
                       F.left(F.col(REJECTED), F.lit(200)))
    df = df.filter(F.when(F.col(REJECTED).isNotNull(), F.raise_error(message)).otherwise(F.lit(True)))
    return df.drop(REJECTED) if with_source else df.drop(REJECTED, SOURCE_FILE)
