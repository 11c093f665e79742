"""What the physical plans must and must not contain."""

import os
import re
from collections import Counter
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import cleaning
from tallyhouse.operators.fact import customer_lookup, fact_transactions, key_lookup
from tallyhouse.operators.ordering import number_rows, sort_with_place
from tallyhouse.plans import business, catalog, views
from tallyhouse.plans.kpis import executive_kpis
from tallyhouse.plans.views import open_star
from tallyhouse.session import EXPANSION, shared_folder, source_bytes
from tallyhouse.sinks.tables import write_clean, write_warehouse
from tallyhouse.sources.tables import read_clean, warehouse_lines
from tests.conftest import SMALL


def plan(frame):
    return frame._jdf.queryExecution().explainString(
        frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def executed(frame):
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(catalog.queries()))
def test_no_python_and_no_cross_join(spark, small, name):
    text = plan(catalog.queries()[name](spark, SMALL))
    for operator in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "MapInPandas", "FlatMapGroups"):
        assert operator not in text


@pytest.mark.parametrize("question", [
    business.top_international_markets, business.top_products_by_revenue, business.top_products_by_units,
    business.top_customers, business.top_markets, business.product_revenue_vs_volume,
    business.valid_sales_sample, business.top_product,
])
def test_limits_are_top_k(small, question):
    assert "TakeOrderedAndProject" in plan(question(small.star))


def test_filter_and_columns_reach_the_scan(small):
    text = plan(views.country_performance(small.star))
    scan = next(part for part in text.split("\n\n") if "fact_transactions" in part)
    assert "PushedFilters: [IsNotNull(is_valid_sale), EqualTo(is_valid_sale,1)" in scan
    columns = set(re.findall(r"(\w+):", re.search(r"ReadSchema: struct<(.*)>", scan).group(1)))
    assert columns == {"invoice_id", "customer_key", "country_key", "quantity", "sales_revenue", "is_valid_sale"}


def test_kpis_scan_the_fact_once(small):
    assert plan(executive_kpis(small.star.fact_transactions)).count("Scan parquet") == 2  # tree and detail


def test_concentration_groups_the_fact_once(small):
    text = executed(business.revenue_concentration(small.star))
    assert "ReusedExchange" in text


def test_windows_see_blocks_only(spark, small):
    """Ranks over all products number the blocks of a written sort, and rows inside a block."""
    for name, query in catalog.queries().items():
        text = plan(query(spark, SMALL))
        if "Window" in text:
            assert name == "volume_vs_revenue_rank"
            assert all("_block" in part for part in text.split("\n\n") if re.match(r"\(\d+\) Window", part))


def test_sample_limits_before_it_joins(small):
    text = plan(business.valid_sales_sample(small.star)).split("\n\n")[0]
    assert text.index("Join") < text.index("TakeOrderedAndProject")


def shuffled_rows(frame):
    """Rows of every shuffle of an executed frame."""
    frame.write.format("noop").mode("overwrite").save()
    frame.collect()
    return [float(n) for n in re.findall(r"ShuffleQueryStage \(\d+\), Statistics\(.*?rowCount=([\d.E+]+)\)", plan(frame))]


def test_rows_without_copies_are_not_shuffled(spark, small, tmp_path):
    unique = small.raw.dropDuplicates()
    unique.write.parquet(str(tmp_path / "unique"))
    frame = cleaning.deduplicate(spark.read.parquet(str(tmp_path / "unique")))
    assert sum(shuffled_rows(frame)) == 0 and frame.count() == unique.count()
    copies = small.raw.count() - unique.count()
    frame = cleaning.deduplicate(small.raw)
    assert 0 < sum(shuffled_rows(frame)) <= 2 * copies  # both copies of a row, if no task saw both


def test_copies_collapse_before_the_shuffle(small):
    text = plan(cleaning.deduplicate(small.raw)).split("\n\n")[0]
    assert [line.strip(" +-:*|").split(" ")[0] for line in text.splitlines()].count("HashAggregate") == 2


def test_ranks_need_no_table_and_no_full_sort(spark, small):
    before = set(os.listdir(shared_folder(spark)))
    frame = business.volume_vs_revenue_rank(small.star)
    assert frame.count() == 100 and set(os.listdir(shared_folder(spark))) == before
    nothing = replace(small.star, fact_transactions=small.star.fact_transactions.limit(0))
    empty = business.volume_vs_revenue_rank(nothing)
    assert empty.count() == 0 and empty.dtypes == frame.dtypes


@pytest.mark.parametrize("view", [views.monthly_sales, views.country_performance, business.monthly_trend])
def test_no_line_is_multiplied(small, view):
    """The aggregate over invoices and customers sits on the scan; only its rows are expanded."""
    tree = plan(view(small.star)).split("\n\n")[0].splitlines()
    names = [re.sub(r"^[ +:*|-]*", "", line).split(" ")[0] for line in tree]
    scan = next(i for i, line in enumerate(tree) if "fact_transactions" in line or names[i] == "Scan")
    above = [n for n in names[:scan] if n not in ("Filter", "Project", "ColumnarToRow")]
    assert above[-1] == "HashAggregate"
    assert "Expand" in names


@pytest.fixture
def shuffled_joins(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "2500",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def hot_lines(spark):
    """A third of the lines share one product, another third has no customer."""
    n = F.col("id")
    return spark.range(60_000, numPartitions=8).select(
        n.alias("transaction_key"),
        F.when(n % 3 == 0, F.lit("p0")).otherwise(F.concat(F.lit("p"), (n % 500).cast("string"))).alias("stock_code"),
        F.when(n % 3 != 1, (n % 700).cast("string")).alias("customer_id"),
    )


def largest_partition(frame):
    return frame.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]


def test_hot_product_is_dealt_over_many_partitions(spark, shuffled_joins):
    """Beyond 2000 partitions adaptive execution sees no skew."""
    members = spark.range(500).select(
        F.concat(F.lit("p"), F.col("id").cast("string")).alias("stock_code"), (F.col("id") + 1).alias("product_key")
    )
    joined = key_lookup(hot_lines(spark), members, "stock_code", "product_key").select("transaction_key", "product_key")
    rows = joined.withColumn("p", F.spark_partition_id()).collect()
    assert len(rows) == 60_000 and all(
        r.product_key == 1 + (0 if r.transaction_key % 3 == 0 else r.transaction_key % 500) for r in rows
    )
    assert max(Counter(r.p for r in rows).values()) < 1000  # 20,000 lines have the hot product


def test_missing_customers_are_scattered(spark, shuffled_joins):
    lines = hot_lines(spark)
    members = spark.range(700).select(
        F.col("id").cast("string").alias("customer_id"), (F.col("id") + 1).alias("customer_key")
    )
    rows = customer_lookup(lines, members).withColumn("p", F.spark_partition_id()).collect()
    assert sum(r.customer_key == 0 for r in rows) == sum(r.customer_id is None for r in rows) == 20_000
    assert max(Counter(r.p for r in rows).values()) < 1000


def test_fact_keeps_its_order_when_lookups_shuffle(spark, small, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_warehouse(spark, small.clean_path, str(tmp_path))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    fact = open_star(spark, str(tmp_path)).fact_transactions
    files = fact.groupBy(F.input_file_name()).agg(F.min("transaction_key").alias("a"), F.max("transaction_key").alias("b"))
    ranges = sorted((r.a, r.b) for r in files.collect())
    assert len(ranges) > 1
    assert all(before[1] < after[0] for before, after in zip(ranges, ranges[1:], strict=False))
    assert fact.exceptAll(small.star.fact_transactions).count() == 0


def test_valid_sales_with_shuffled_members(spark, small):
    expected = views.valid_sales(small.star)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = views.valid_sales(small.star)
        assert found.exceptAll(expected).count() == 0 and found.count() == expected.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_clean_shuffles_whole_lines_once(spark, small, tmp_path):
    """Copies are dropped in the ranges of the sort, however many of them there are."""
    raw = small.raw.union(small.raw)
    order = [F.col(f"`{name}`") for name in raw.columns]
    placed = sort_with_place(raw, order, "line", distinct=True)
    text = plan(placed).split("\n\n")[0]
    names = [line.strip(" +-:*|").split(" ")[0] for line in text.splitlines()]
    assert names.count("Exchange") == 1 and placed.count() == raw.distinct().count()
    before = set(os.listdir(shared_folder(spark)))
    write_clean(raw, str(tmp_path / "clean"))
    assert set(os.listdir(shared_folder(spark))) == before
    clean, expected = spark.read.parquet(str(tmp_path / "clean")), spark.read.parquet(small.clean_path)
    columns = [name for name in expected.columns if not name.startswith("line_")]
    assert clean.select(columns).exceptAll(expected.select(columns)).count() == 0 and clean.count() == expected.count()


def test_lookups_shuffle_whole_lines_once(spark, small, shuffled_joins):
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    star = small.star
    lines = number_rows(warehouse_lines(read_clean(spark, small.clean_path, with_position=True)), "line", "transaction_key")
    fact = fact_transactions(lines, star.dim_customer, star.dim_product, star.dim_country)
    text = plan(fact)
    shuffles = [part for part in text.split("\n\n") if re.match(r"\(\d+\) Exchange", part)]
    assert sum("line#" in part.split("Arguments")[0] or "net_line_value" in part for part in shuffles) == 1
    assert fact.exceptAll(star.fact_transactions).count() == 0 and fact.count() == star.fact_transactions.count()


def test_workspace_is_sized_by_rows_in_memory(small):
    assert small.num_bytes == EXPANSION * source_bytes(small.spark, SMALL)


def test_products_are_dealt_when_the_session_is_narrow(spark, small):
    """Queries on the written tables run with the session's width, which may be far too small for their rows."""
    narrow = {"spark.tallyhouse.reducerBytes": "20k"}
    expected = business.top_products_by_units(small.star).collect()
    for key, value in narrow.items():
        spark.conf.set(key, value)
    try:
        frame = business.top_products_by_units(small.star)
        assert "REPARTITION_BY_NUM" in plan(frame) and frame.collect() == expected
    finally:
        for key in narrow:
            spark.conf.unset(key)
