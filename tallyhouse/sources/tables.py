"""Typed scans of the engine's own tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.schemas import CLEAN, LINE_POSITION, WAREHOUSE
from tallyhouse.sources import versions
from tallyhouse.sources.errors import SchemaError, missing_as_file_error

_WITH_POSITION = T.StructType([*CLEAN.fields, *LINE_POSITION.fields])


def check_schema(path: str, found: T.StructType, expected: T.StructType) -> None:
    """An error that names every column of ``expected`` that is missing or has another type."""
    kinds = {field.name: field.dataType.simpleString() for field in found}
    faults = [
        f"{field.name} is missing" if field.name not in kinds
        else f"{field.name} is {kinds[field.name]}, not {field.dataType.simpleString()}"
        for field in expected
        if kinds.get(field.name) != field.dataType.simpleString()
    ]
    if faults:
        raise SchemaError(f"{path}: {'; '.join(faults)}")


def _read(spark: SparkSession, schema: T.StructType, path: str) -> DataFrame:
    """A table of the engine. The schema in the footer of its files is compared first: a column that is missing
    would otherwise read as null, and one of another type fail in the middle of a job."""
    with missing_as_file_error(path):
        check_schema(path, spark.read.parquet(path).schema, schema)
        return spark.read.schema(schema).parquet(path)


def read_clean(spark: SparkSession, path: str, with_position: bool = False) -> DataFrame:
    """The written clean table; its row position only on request."""
    schema = _WITH_POSITION if with_position else CLEAN
    return _read(spark, schema, path).select(*schema.names)


def read_clean_csv(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """A clean table exported as CSV, columns by name; empty fields are null.

    Quoted line breaks are kept, so a file is one split; ``multiLine="false"``
    splits files of a table that has none.
    """
    options = {"header": "true", "quote": '"', "escape": '"', "nullValue": "", "multiLine": "true", **options}
    text = spark.read.options(**options).csv(path)
    return text.select(*[
        F.col(field.name).cast(field.dataType).alias(field.name) for field in CLEAN
    ])


def warehouse_lines(clean: DataFrame) -> DataFrame:
    """Clean lines as the warehouse takes them: empty text counts as missing."""
    texts = ("invoice_id", "stock_code", "description", "country")
    return clean.withColumns({name: F.nullif(F.col(name), F.lit("")) for name in texts})


def read_table(spark: SparkSession, location: str, name: str) -> DataFrame:
    """A table of the current version of the warehouse at ``location``."""
    return _read(spark, WAREHOUSE[name], f"{versions.current(spark, location)}/{name}")
