"""Errors of sources that are not there or not as expected."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException

_ABSENT = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


class SchemaError(ValueError):
    """A stored table lacks columns or holds them in other types."""


@contextmanager
def missing_as_file_error(path: str) -> Iterator[None]:
    """Turn Spark's complaint about a path without data into FileNotFoundError."""
    try:
        yield
    except AnalysisException as error:
        if error.getCondition() not in _ABSENT:
            raise
        raise FileNotFoundError(f"no data at {path}") from error
