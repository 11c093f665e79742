"""Folders of tables that are replaced as a whole.

Every build writes its tables to a version folder of its own. A manifest, a file that
names one version, is added last, under the next number; the highest number counts. A manifest is
renamed into place, so it is there with all its text or not at all, and of two builds
that end at once the second fails. Until then, and if a build stops half way, readers
see the version before. One older version stays for those who are still reading it.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import SparkSession

from tallyhouse.session import drop_folder, file_system

_MANIFESTS, _VERSIONS = "manifests", "versions"
_KEPT = 2  # the current version and the one before


def _names(spark: SparkSession, path: str) -> list[str]:
    files, target = file_system(spark, path)
    return sorted(status.getPath().getName() for status in files.listStatus(target)) if files.exists(target) else []


def _numbers(spark: SparkSession, location: str) -> list[int]:
    return sorted(int(name) for name in _names(spark, f"{location}/{_MANIFESTS}") if re.fullmatch(r"\d+", name))


def _version_of(spark: SparkSession, location: str, number: int) -> str:
    files, target = file_system(spark, f"{location}/{_MANIFESTS}/{number:08d}")
    stream = files.open(target)
    try:
        return stream.readUTF()
    finally:
        stream.close()


def current(spark: SparkSession, location: str) -> str:
    """Folder of the tables that count; ``location`` itself where no manifest was ever written."""
    numbers = _numbers(spark, location)
    return f"{location}/{_VERSIONS}/{_version_of(spark, location, numbers[-1])}" if numbers else location


def new_version(location: str) -> str:
    """A fresh folder to write tables to."""
    return f"{location}/{_VERSIONS}/{uuid.uuid4().hex}"


def publish(spark: SparkSession, location: str, version: str) -> None:
    """Make ``version`` count, then delete what neither counts nor counted last: older
    versions, and what stopped builds have left."""
    numbers = _numbers(spark, location)
    number, name = numbers[-1] + 1 if numbers else 1, version.rsplit("/", 1)[1]
    files, draft = file_system(spark, f"{location}/{_MANIFESTS}/draft-{name}")
    stream = files.create(draft)
    stream.writeUTF(name)
    stream.close()
    _, target = file_system(spark, f"{location}/{_MANIFESTS}/{number:08d}")
    if files.exists(target) or not files.rename(draft, target):
        files.delete(draft, False)
        raise RuntimeError(f"another build of {location} ended at the same time")
    numbers = [*numbers, number]
    kept = {_version_of(spark, location, n) for n in numbers[-_KEPT:]}
    for n in numbers[:-_KEPT]:
        drop_folder(spark, f"{location}/{_MANIFESTS}/{n:08d}")
    for other in _names(spark, f"{location}/{_VERSIONS}"):
        if other not in kept:
            drop_folder(spark, f"{location}/{_VERSIONS}/{other}")
