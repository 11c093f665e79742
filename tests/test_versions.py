"""A warehouse is replaced as a whole, and read only if it is what it should be."""

import os

import pytest
from pyspark.sql import functions as F

from tallyhouse.plans.views import open_star
from tallyhouse.schemas import DIM_PRODUCT, RAW
from tallyhouse.sinks import tables
from tallyhouse.sinks.tables import write_clean, write_warehouse
from tallyhouse.sources import versions
from tallyhouse.sources.errors import SchemaError
from tallyhouse.sources.tables import read_clean, read_table
from tests.test_cleaning import raw_row


def _clean(spark, path, *invoices):
    write_clean(spark.createDataFrame([raw_row(i) for i in invoices], RAW), path)
    return path


def _invoices(spark, location):
    return {r.invoice_id for r in open_star(spark, location).fact_transactions.collect()}


def test_a_build_that_stops_leaves_the_old_warehouse(spark, tmp_path, monkeypatch):
    location = str(tmp_path / "w")
    first, second = _clean(spark, str(tmp_path / "a"), "1"), _clean(spark, str(tmp_path / "b"), "2", "3")

    def stop(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as broken:
        broken.setattr(tables, "write_fact", stop)
        with pytest.raises(KeyboardInterrupt):
            write_warehouse(spark, first, location)
        with pytest.raises(FileNotFoundError):
            open_star(spark, location)
    write_warehouse(spark, first, location)
    old = versions.current(spark, location)
    with monkeypatch.context() as broken:
        broken.setattr(tables, "write_fact", stop)
        with pytest.raises(KeyboardInterrupt):
            write_warehouse(spark, second, location)
    assert _invoices(spark, location) == {"1"} and versions.current(spark, location) == old
    assert os.listdir(f"{location}/versions") == [old.rsplit("/", 1)[1]]


def test_readers_keep_their_version_until_the_next_but_one(spark, tmp_path):
    location = str(tmp_path / "w")
    seen = []
    for invoice in ("1", "2", "3"):
        write_warehouse(spark, _clean(spark, str(tmp_path / invoice), invoice), location)
        seen.append(versions.current(spark, location))
        assert _invoices(spark, location) == {invoice}
    assert {f"{location}/versions/{name}" for name in os.listdir(f"{location}/versions")} == set(seen[1:])
    assert read_table(spark, seen[1], "fact_transactions").first().invoice_id == "2"


def test_what_a_killed_build_left_goes_with_the_next(spark, tmp_path):
    location = str(tmp_path / "w")
    spark.range(1).write.parquet(f"{versions.new_version(location)}/dim_date")
    write_warehouse(spark, _clean(spark, str(tmp_path / "a"), "1"), location)
    assert len(os.listdir(f"{location}/versions")) == 1


def test_two_builds_at_once(spark, tmp_path):
    location = str(tmp_path / "w")
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(versions, "_numbers", lambda *_: [])
        for name in ("a", "b"):
            spark.range(1).write.parquet(f"{location}/versions/{name}/t")
        versions.publish(spark, location, f"{location}/versions/a")
        with pytest.raises(RuntimeError, match="same time"):
            versions.publish(spark, location, f"{location}/versions/b")
    assert versions.current(spark, location) == f"{location}/versions/a"


def test_other_columns_are_an_error_before_the_scan(spark, tmp_path):
    clean, location = _clean(spark, str(tmp_path / "a"), "1"), str(tmp_path / "w")
    write_warehouse(spark, clean, location)
    path = f"{versions.current(spark, location)}/dim_product"
    good = spark.createDataFrame([(1, "A", "x")], DIM_PRODUCT)
    good.drop("description").withColumn("product_key", F.lit("1")).write.mode("overwrite").parquet(path)
    with pytest.raises(SchemaError, match="product_key is string, not bigint; description is missing"):
        open_star(spark, location)
    good.withColumn("more", F.lit(1)).write.mode("overwrite").parquet(path)
    assert open_star(spark, location).dim_product.columns == DIM_PRODUCT.names
    spark.read.parquet(clean).withColumn("quantity", F.col("quantity").cast("long")).write.parquet(str(tmp_path / "b"))
    with pytest.raises(SchemaError, match="quantity is bigint, not int"):
        read_clean(spark, str(tmp_path / "b"))
