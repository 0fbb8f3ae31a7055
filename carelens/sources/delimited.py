"""Delimited text files with a header line, read as text and typed by declaration."""

import csv
import re
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from carelens.fixed_values import MISSING_TOKENS, SAMPLE_FILES
from carelens.functions.keys import lit, named, ref
from carelens.sources.headers import column_names
from carelens.tables import SCHEMAS, Schema, apply_schema, infer_types


def _options(sep: str, encoding: str, multiline: bool) -> dict[str, object]:
    # Quotes inside a quoted field are doubled.  Only multi-line files give up splitting.
    return {"sep": sep, "encoding": encoding, "quote": '"', "escape": '"', "multiLine": multiline}


def read_headers(spark: SparkSession, path: str, sep: str = ";", encoding: str = "UTF-8") -> list[str]:
    """Column names of a file from its header line, the only line read here."""
    first = spark.read.options(**_options(sep, encoding, False)).csv(path).head()
    return column_names([] if first is None else [h if h is None else h.removeprefix("﻿") for h in first])


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    sep: str = ";",
    encoding: str = "UTF-8",
    schema: Schema | None = None,
    infer: bool = False,
    missing: Iterable[str] = MISSING_TOKENS,
    multiline: bool = False,
) -> DataFrame:
    """A delimited table under normalised column names; several paths are one table with one header.

    Columns are text, then typed by ``schema`` where it declares them, or from the whole content with ``infer``.
    Texts standing for "no value" are NULL.
    """
    first = path if isinstance(path, str) else path[0]
    return _read(spark, path, read_headers(spark, first, sep, encoding), sep, encoding, schema, infer, missing, multiline)


def _read(
    spark: SparkSession,
    path: str | list[str],
    names: list[str],
    sep: str = ";",
    encoding: str = "UTF-8",
    schema: Schema | None = None,
    infer: bool = False,
    missing: Iterable[str] = MISSING_TOKENS,
    multiline: bool = False,
) -> DataFrame:
    texts = StructType([StructField(n, StringType()) for n in names])
    raw = spark.read.options(header=True, **_options(sep, encoding, multiline)).schema(texts).csv(path)
    tokens = ", ".join(map(lit, missing))
    if tokens:
        raw = raw.selectExpr(*[named(f"CASE WHEN {ref(n)} NOT IN ({tokens}) THEN {ref(n)} END", n) for n in names])
    if schema is not None:
        return apply_schema(raw, schema)
    return infer_types(raw) if infer else raw


BAD_LINE = "__bad_line"


def read_checked(
    spark: SparkSession, path: str | list[str], sep: str = ";", encoding: str = "UTF-8", schema: Schema | None = None,
    missing: Iterable[str] = MISSING_TOKENS, names: list[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``read_delimited`` for lines as wide as their header, and the others as (file, line, fields, expected, reason).

    Accepted and rejected rows together are the lines of the files, but for headers and blank lines.  A line is rejected
    whole: neither are missing fields filled, nor surplus ones dropped.
    """
    first = path if isinstance(path, str) else path[0]
    names = names or read_headers(spark, first, sep, encoding)
    texts = StructType([*(StructField(n, StringType()) for n in names), StructField(BAD_LINE, StringType())])
    options = {**_options(sep, encoding, False), "columnNameOfCorruptRecord": BAD_LINE, "columnPruning": False}
    raw = spark.read.options(header=True, mode="PERMISSIVE", **options).schema(texts).csv(path)
    # True of every row: the reader refuses queries that ask for bad lines without any column.
    raw = raw.where(f"coalesce(length({ref(names[0])}), 0) >= 0") if names else raw
    good = raw.where(f"{ref(BAD_LINE)} IS NULL").drop(BAD_LINE)
    tokens = ", ".join(map(lit, missing))
    if tokens:
        good = good.selectExpr(*[named(f"CASE WHEN {ref(n)} NOT IN ({tokens}) THEN {ref(n)} END", n) for n in names])
    # Separators outside quotes; a quote inside a quoted field is doubled.
    bare = f"regexp_replace({ref(BAD_LINE)}, '\"([^\"]|\"\")*\"', '')"
    fields = f"1 + length({bare}) - length(replace({bare}, {lit(sep)}, ''))"
    bad = raw.select("*", F.col("_metadata.file_path").alias("__file")).where(f"{ref(BAD_LINE)} IS NOT NULL")
    bad = bad.selectExpr("__file AS file", named(ref(BAD_LINE), "line"), f"{fields} AS fields", f"{len(names)} AS expected")
    bad = bad.selectExpr("*", "CASE WHEN fields < expected THEN 'too few fields' WHEN fields > expected THEN 'too many fields' ELSE 'unreadable' END AS reason")
    return (good if schema is None else apply_schema(good, schema)), bad


def list_files(spark: SparkSession, folder: str, suffix: str = ".csv") -> list[str]:
    """Paths of the delimited files below a folder; only names travel, not contents."""
    found = spark.read.format("binaryFile").options(recursiveFileLookup=True).load(folder).select("path")
    return sorted(row["path"] for row in found.collect() if f"{suffix}/" in f"{row['path'].lower()}/")


def first_lines(spark: SparkSession, folder: str, suffix: str = ".csv") -> DataFrame:
    """(path, line, latin): the first line of every delimited file below a folder, in UTF-8 and in ISO-8859-1.

    One scan of the files' lines, however many files there are; files without lines are left out.
    """
    lines = spark.read.options(recursiveFileLookup=True).text(folder).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), "value"
    )
    ours = lines.where(F.contains(F.concat(F.lower("path"), F.lit("/")), F.lit(f"{suffix}/")) & (F.col("start") == 0))
    # Numbers rise along a file's first block.
    numbered = ours.withColumn("n", F.monotonically_increasing_id())
    first = numbered.groupBy("path").agg(F.min_by("value", "n").alias("line"))
    return first.select("path", "line", F.decode(F.col("line").cast("binary"), "ISO-8859-1").alias("latin"))


def header_of(line: str, sep: str = ";") -> tuple[str, ...]:
    """Column names of a header line."""
    raw = next(csv.reader([line.removeprefix("\ufeff")], delimiter=sep), [])
    return tuple(column_names([h or None for h in raw]))


def table_name(folder: str, path: str, suffix: str = ".csv") -> str:
    """Name of the table a file belongs to: the stem, up to the first dot, of the file or of the folder of parts."""
    root, full = (re.sub(r"^\w+:/*", "/", p).rstrip("/") for p in (folder, path))
    named = [p for p in full.removeprefix(root).split("/") if p.lower().endswith(suffix)]
    return named[0].split(".")[0]


def _encoding_of(name: str, encoding: str | dict[str, str]) -> str:
    return encoding if isinstance(encoding, str) else encoding.get(name, "UTF-8")


def scan_headers(spark: SparkSession, folder: str) -> list[tuple[str, str, str]]:
    """(path, header line, header line in ISO-8859-1) of every file: a short text for each comes to the driver, as their
    paths do for any scan."""
    return [tuple(r) for r in first_lines(spark, folder).orderBy("path").collect()]


def read_folder(
    spark: SparkSession,
    folder: str,
    encoding: str | dict[str, str] = "UTF-8",
    skip_pattern: str | None = SAMPLE_FILES,
    schemas: dict[str, Schema] | None = None,
    views: bool = True,
    appended: dict[str, str] | None = None,
    checked: bool = False,
) -> dict[str, DataFrame]:
    """Every delimited file of a folder as a table named by its stem, registered as a view of the same name.

    ``name.csv`` may be a file or a folder of part files.  Headers are found in one scan; the files of one table with the
    same header are one scan, those with another are appended by column name.  File names matching ``skip_pattern`` are
    left out.  ``encoding`` is one for all tables, or one by table name (UTF-8 for tables that it lacks).

    ``appended`` names tables made of all files of a sub-folder (sub-folder by table name): such files, one for each
    region, are no tables of their own.  With ``checked`` lines that are not as wide as their header are left out of the
    tables and found in the table ``rejects`` (``read_checked``).
    """
    declared = SCHEMAS if schemas is None else schemas
    below = {part.strip("/"): name for name, part in (appended or {}).items()}
    root = re.sub(r"^\w+:/*", "/", folder).rstrip("/")
    grouped: dict[str, dict[tuple[str, ...], list[str]]] = {}
    for path, line, latin in scan_headers(spark, folder):
        if skip_pattern and re.search(skip_pattern, path):
            continue
        inside = re.sub(r"^\w+:/*", "/", path).removeprefix(root).strip("/")
        name = next((n for part, n in below.items() if inside.startswith(part + "/")), None) or table_name(folder, path)
        header = header_of(line if _encoding_of(name, encoding).upper().replace("_", "-") == "UTF-8" else latin)
        grouped.setdefault(name, {}).setdefault(header, []).append(path)
    tables, rejects = {}, []
    for name, by_header in grouped.items():
        own = _encoding_of(name, encoding)
        if checked:
            both = [read_checked(spark, paths, encoding=own, schema=declared.get(name), names=list(header)) for header, paths in by_header.items()]
            rejects += [bad.selectExpr(f"{lit(name)} AS table_name", "*") for _, bad in both]
            parts = [good for good, _ in both]
        else:
            parts = [_read(spark, paths, list(header), encoding=own, schema=declared.get(name)) for header, paths in by_header.items()]
        tables[name] = concat_sources(parts)
    if rejects:
        tables["rejects"] = concat_sources(rejects)
    if views:
        for name, df in tables.items():
            df.createOrReplaceTempView(f"`{name}`")
    return tables


def concat_sources(frames: Iterable[DataFrame]) -> DataFrame:
    """Append frames by column name; a column a frame lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_appended(spark: SparkSession, folder: str, sep: str = ";", encoding: str = "UTF-8") -> DataFrame:
    """All delimited files of a folder as one table.  Headers are one scan, files with the same header another."""
    by_header: dict[tuple[str, ...], list[str]] = {}
    for path, line, latin in scan_headers(spark, folder):
        header = header_of(line if encoding.upper().replace("_", "-") == "UTF-8" else latin, sep)
        by_header.setdefault(header, []).append(path)
    return concat_sources([_read(spark, paths, list(header), sep, encoding) for header, paths in by_header.items()])
