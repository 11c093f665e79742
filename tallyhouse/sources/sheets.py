"""Scans of raw invoice lines, one file or folder per sheet.

Values stay as they were read: text from text formats, the stored types from
columnar ones. Types are settled after exact copies are gone, so two lines that
differ in any digit stay two lines, and the reports see what the source holds.

Every file is read by its own columns. CSV files are grouped by their headers
(:mod:`tallyhouse.sources.quoted_csv`), files of other formats by their stored names;
files of one sheet may hold the columns in any order and lack some.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping
from dataclasses import dataclass
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.constants import SHEET
from tallyhouse.schemas import RAW
from tallyhouse.session import qualified
from tallyhouse.sources import quoted_csv
from tallyhouse.sources.errors import missing_as_file_error

_PARTITION = f"{SHEET}="
_SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?"


def _below(path: Column, root: str) -> Column:
    """What follows ``root`` in the path of a file; both may or may not have a scheme."""
    inside = F.regexp_replace(path, _SCHEME, "")
    return F.substring(inside, len(root.rstrip("/")) + 2, 1 << 30)


def _root_path(spark: SparkSession, root: str) -> str:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(qualified(spark, root))
    return path.toUri().getPath()


def discover_sheets(spark: SparkSession, root: str) -> dict[str, str]:
    """Sheet name to path for every file or folder right below ``root``.

    The listing runs as a Spark job on any file system Spark can read. A file
    is named by its stem, a folder by its whole name, or by its value if it is
    a partition folder. Two entries of one name are an error.
    """
    with missing_as_file_error(root):
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    below = _below(F.col("path"), _root_path(spark, root))
    entries = files.select(
        F.substring_index(below, "/", 1).alias("entry"), F.contains(below, F.lit("/")).alias("folder")
    ).distinct()
    sheets: dict[str, str] = {}
    for row in entries.collect():  # one row per sheet of the source
        if row.entry.startswith(("_", ".")):
            continue
        name = row.entry
        if name.startswith(_PARTITION):
            name = unquote(name.removeprefix(_PARTITION))
        elif not row.folder and "." in name:
            name = name.rsplit(".", 1)[0]
        if name in sheets:
            raise ValueError(f"two sheets are named {name!r}: {sheets[name]} and {row.entry}")
        sheets[name] = f"{root.rstrip('/')}/{row.entry}"
    return dict(sorted(sheets.items()))


def _sheet_name(path: Column, root: str) -> Column:
    """The name :func:`discover_sheets` gives to the sheet of the file at ``path``."""
    # Paths in the metadata are URL-encoded, but for the plus sign.
    path = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    below = _below(path, root)
    entry = F.substring_index(below, "/", 1)
    value = F.replace(F.substring(entry, len(_PARTITION) + 1, 1 << 30), F.lit("+"), F.lit("%2B"))
    return (
        F.when(F.startswith(entry, F.lit(_PARTITION)), F.url_decode(value))
        .when(F.contains(below, F.lit("/")), entry)
        .otherwise(F.regexp_replace(entry, r"(?<=.)\.[^.]*$", ""))
    )


@dataclass(frozen=True)
class Workbook:
    """The lines of some sheets, and the text of those with too few or too many fields, which stay lines as well."""

    lines: DataFrame
    malformed: DataFrame


def _as_raw(sheet: DataFrame, name: Column) -> DataFrame:
    """The raw columns a sheet has, by name: names and codes as text, the rest as read."""
    columns = []
    for field in RAW:
        if field.name in sheet.columns and field.name != SHEET:
            column = F.col(f"`{field.name}`")
            text = isinstance(field.dataType, T.StringType)
            columns.append((column.cast("string") if text else column).alias(field.name))
    return sheet.select(*columns, name.alias(SHEET))


def _options(file_format: str, options: Mapping[str, str]) -> dict[str, str]:
    """CSV may have quoted line breaks; ``multiLine="false"`` says that every line is a record."""
    defaults = {"header": "true", "quote": '"', "escape": '"', "multiLine": "true"}
    return {**(defaults if file_format == "csv" else {}), **options}


def _by_header(file_format: str, options: Mapping[str, str]) -> bool:
    """Whether the CSV reader of this package knows all the options; Spark's own reads anything else."""
    known = options.keys() <= quoted_csv.OPTIONS and str(options.get("header")).lower() == "true"
    return file_format == "csv" and known and bool(options["quote"]) and bool(options["escape"])


def _malformed(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], f"{SHEET} string, raw_text string")


def _open_csv(spark: SparkSession, paths: list[str], sheet: Column, options: Mapping[str, str]) -> Workbook:
    """Every file by its own header; the first of two columns of one name counts."""
    scans, malformed = [], _malformed(spark)
    for names, rows in quoted_csv.read_records(spark, paths, sheet, options).parsed():
        columns = [
            F.col(f"fields.c{names.index(field.name)}").alias(field.name)
            for field in RAW
            if field.name in names and field.name != SHEET
        ]
        scans.append(rows.select(*columns, F.col("sheet").alias(SHEET)))
        bad = rows.where("fields.malformed IS NOT NULL")
        malformed = malformed.union(bad.select("sheet", "record"))
    none = spark.createDataFrame([], T.StructType([T.StructField(name, T.StringType()) for name in RAW.names]))
    return Workbook(_combine(scans) if scans else none, malformed)


def _combine(scans: list[DataFrame]) -> DataFrame:
    """Scans under one another by column name; a column that a scan lacks is null
    there, and one that they store in different types becomes text."""
    kinds = {}
    for field in RAW:
        found = {scan.schema[field.name].dataType.simpleString() for scan in scans if field.name in scan.columns}
        kinds[field.name] = found.pop() if len(found) == 1 else "string" if found else field.dataType.simpleString()
    combined = None
    for scan in scans:
        even = scan.select(*[
            (F.col(f"`{name}`") if name in scan.columns else F.lit(None)).cast(kind).alias(name)
            for name, kind in kinds.items()
        ])
        combined = even if combined is None else combined.union(even)
    return combined


def _reader(spark: SparkSession, file_format: str, options: Mapping[str, str]):
    """Parquet files of one sheet may differ in columns: the sheet has the columns of all. A header that does not
    match the columns of the first file of its sheet is an error where Spark's own CSV reader is used."""
    own = {"parquet": {"mergeSchema": "true"}, "csv": {"enforceSchema": "false"}}.get(file_format, {})
    return spark.read.format(file_format).options(**(own | dict(options)))


def open_sheet(
    spark: SparkSession, path: str, name: str, file_format: str = "parquet", **options: str
) -> Workbook:
    """One sheet, tagged with its name. Text formats are read as text, so ids
    keep leading zeros and letters."""
    options = _options(file_format, options)
    with missing_as_file_error(path):
        if _by_header(file_format, options):
            return _open_csv(spark, [path], F.lit(name), options)
        sheet = _reader(spark, file_format, options).load(path)
    return Workbook(_as_raw(sheet, F.lit(name)), _malformed(spark))


def scan_sheet(
    spark: SparkSession, path: str, name: str, file_format: str = "parquet", **options: str
) -> DataFrame:
    """The lines of :func:`open_sheet`."""
    return open_sheet(spark, path, name, file_format, **options).lines


def scan_sheets(
    spark: SparkSession, sheets: Mapping[str, str], file_format: str = "parquet", **options: str
) -> DataFrame:
    """The given sheets under one another."""
    if not sheets:
        raise FileNotFoundError("no sheets to read")
    return _combine([scan_sheet(spark, path, name, file_format, **options) for name, path in sheets.items()])


def open_workbook(
    spark: SparkSession, root: str, file_format: str = "parquet", **options: str
) -> Workbook:
    """Every sheet found below ``root``.

    Files with the same columns in the same order are one scan that takes the
    name from the path, so the plan grows with the number of layouts and not
    with the number of files or sheets. Opening CSV writes its records to a scratch
    folder, which goes with the application.
    """
    paths = list(discover_sheets(spark, root).values())
    if not paths:
        raise FileNotFoundError(f"no sheets in {root}")
    options = _options(file_format, options)
    inside = _root_path(spark, root)
    if _by_header(file_format, options):
        return _open_csv(spark, [root], _sheet_name(F.col("path"), inside), options)

    def schema(path: str) -> T.StructType:
        return _reader(spark, file_format, options).load(path).schema

    with ThreadPoolExecutor(8) as pool:
        schemas = list(pool.map(schema, paths))
    layouts: dict[str, list[int]] = defaultdict(list)
    for i, found in enumerate(schemas):
        layouts[found.simpleString()].append(i)
    name = _sheet_name(F.col("_metadata.file_path"), inside)
    scans = []
    for members in layouts.values():
        reader = _reader(spark, file_format, options).schema(schemas[members[0]])
        scans.append(_as_raw(reader.load([paths[i] for i in members]), name))
    return Workbook(_combine(scans), _malformed(spark))


def scan_workbook(
    spark: SparkSession, root: str, file_format: str = "parquet", **options: str
) -> DataFrame:
    """The lines of :func:`open_workbook`."""
    return open_workbook(spark, root, file_format, **options).lines


def scan_landing(spark: SparkSession, root: str, schema: T.StructType = RAW) -> DataFrame:
    """Lines that :func:`tallyhouse.sinks.tables.write_landing` stored, as one scan."""
    with missing_as_file_error(root):
        return spark.read.schema(schema).parquet(root)
