"""Dimensions, fact, views, KPIs and segments on hand-made lines."""

from datetime import date, datetime
from decimal import Decimal
from itertools import product

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import dimensions
from tallyhouse.plans import business, rfm, views
from tallyhouse.plans.kpis import executive_kpis
from tallyhouse.plans.rfm import customer_segment, rfm_customers, rfm_segment_summary
from tallyhouse.plans.views import open_star, register_views
from tallyhouse.schemas import CLEAN, DIM_CUSTOMER, FACT, RAW
from tallyhouse.sinks.tables import write_clean, write_warehouse
from tests.test_cleaning import raw_row

AT = datetime(2010, 1, 5, 10)


def build(spark, path, rows):
    write_clean(spark.createDataFrame(rows, RAW), f"{path}/clean")
    write_warehouse(spark, f"{path}/clean", f"{path}/warehouse")
    return open_star(spark, f"{path}/warehouse")


LINES = [
    raw_row("1", "B", "mug", 2, datetime(2010, 1, 3, 9), "5.00", 20.0, "France"),
    raw_row("1", "A", "cup", 1, datetime(2010, 1, 3, 9), "3.00", 20.0, "France"),
    raw_row("2", "A", "cup", 4, datetime(2010, 1, 5, 9), "3.00", 20.0, "Spain"),
    raw_row("3", "A", "tea cup", 1, datetime(2010, 2, 1, 9), "3.00", 100.0, "Spain"),
    raw_row("4", "C", None, 1, datetime(2010, 2, 1, 9), "7.00", None, "Malta"),
    raw_row("5", None, "ghost", 1, datetime(2010, 2, 2, 9), "1.00", 3.0, None),
    raw_row("6", "", "   ", 1, datetime(2010, 2, 2, 9), "2.00", 3.0, " "),
    raw_row("C7", "A", "cup", -1, datetime(2010, 2, 3, 9), "3.00", 20.0, "France"),
    raw_row("8", "A", "cup", 1, None, "3.00", 20.0, "France"),
]


@pytest.fixture(scope="module")
def star(spark, tmp_path_factory):
    return build(spark, str(tmp_path_factory.mktemp("warehouse")), LINES)


def test_customers_in_text_order_with_first_country(star):
    got = [tuple(r) for r in star.dim_customer.orderBy("customer_key").collect()]
    assert got == [(1, "100", "Spain"), (2, "20", "France"), (3, "3", None)]


def test_products_keep_the_missing_code(star):
    got = [tuple(r) for r in star.dim_product.orderBy("product_key").collect()]
    assert got == [
        (1, "A", "cup"), (2, "B", "mug"), (3, "C", "UNKNOWN PRODUCT"), (4, None, "UNKNOWN PRODUCT"),
    ]


def test_countries_put_the_missing_one_last(star):
    got = [tuple(r) for r in star.dim_country.orderBy("country_key").collect()]
    assert got == [(1, "France"), (2, "Malta"), (3, "Spain"), (4, None)]


def test_dates_have_no_gaps(star):
    days = star.dim_date.orderBy("full_date").collect()
    assert len(days) == 32 and days[0].full_date == date(2010, 1, 3)
    assert tuple(days[0]) == (20100103, date(2010, 1, 3), 2010, "Q1", 1, "January", "2010-01", 3, "Sunday", 53, 1)


def test_long_spine(spark):
    ends = [(datetime(2009, 12, 1, 7, 45),), (datetime(2011, 12, 9, 12, 50),)]
    assert dimensions.date_dimension(spark.createDataFrame(ends, "invoice_date timestamp_ntz")).count() == 739


def test_modal_description_ties_go_to_the_lowest(spark):
    rows = [("p", d) for d in "zbzba"] + [("q", None), (None, "x")]
    got = dimensions.product_members(spark.createDataFrame(rows, "stock_code string, description string"))
    assert {r.stock_code: r.description for r in got.collect()} == {
        "p": "b", "q": "UNKNOWN PRODUCT", None: "UNKNOWN PRODUCT",
    }


def test_fact(star):
    fact = {r.invoice_id: r for r in star.fact_transactions.collect() if r.invoice_id != "1"}
    assert star.fact_transactions.schema == FACT
    assert sorted(r[0] for r in star.fact_transactions.select("transaction_key").collect()) == list(range(1, 10))
    assert fact["4"].customer_key == 0
    assert fact["5"].product_key == 4 and fact["5"].country_key == 4
    assert fact["6"].product_key == 4 and fact["6"].country_key == 4
    assert fact["8"].date_key == 0 and fact["8"].is_valid_sale == 0
    assert fact["C7"].is_cancelled == 1 and fact["C7"].return_value == 3


def test_keys_follow_row_order(star):
    moments = [r[0] for r in star.fact_transactions.orderBy("transaction_key").select("invoice_datetime").collect()]
    assert moments[0] is None and moments[1:] == sorted(moments[1:])


def test_unknown_customers_count_as_none(star):
    got = {r.country: r for r in views.country_performance(star).collect()}
    assert got["Malta"].customers == 0 and got["Malta"].revenue == 7
    assert got["France"].orders == 1 and got["France"].units_sold == 3
    assert got[None].revenue == 3


def test_months(star):
    got = {r.year_month: tuple(r)[4:] for r in views.monthly_sales(star).collect()}
    assert got == {"2010-01": (Decimal("25.00"), 2, 1, 7), "2010-02": (Decimal("13.00"), 4, 2, 4)}


def test_valid_sales_name_their_members(star):
    rows = {r.invoice_id: r for r in views.valid_sales(star).collect() if r.invoice_id != "1"}
    assert len(rows) + 2 == 7
    assert rows["4"].customer_id is None and rows["4"].description == "UNKNOWN PRODUCT"
    assert rows["2"].customer_id == "20" and rows["2"].country == "Spain"


def test_views_by_name(spark, star):
    register_views(star)
    assert spark.sql("SELECT sum(revenue) AS r FROM vw_product_performance").first().r == 38
    assert spark.sql("SELECT count(*) AS n FROM vw_valid_sales JOIN dim_date USING (date_key)").first().n == 7


def test_kpis(star):
    got = {r.metric: r.value for r in executive_kpis(star.fact_transactions).collect()}
    assert got["Gross Sales Revenue"] == 38 and got["Recorded Return Value"] == 3
    assert got["Estimated Net Revenue"] == 35
    assert got["Total Valid Orders"] == 6 and got["Identified Customers"] == 3 and got["Units Sold"] == 11
    assert got["Cancellation Rate (%)"] == 12.5
    assert got["Repeat Customer Rate (%)"] == 66.67
    assert got["Unidentified Customer Revenue"] == 7


def test_kpis_of_nothing(spark):
    got = executive_kpis(spark.createDataFrame([], FACT)).collect()
    assert len(got) == 12 and {r.value for r in got} == {0.0}


def test_an_invoice_shared_by_two_customers_counts_once(spark, tmp_path):
    rows = [raw_row("1", customer=1.0), raw_row("1", customer=2.0), raw_row("1", customer=None)]
    got = {r.metric: r.value for r in executive_kpis(build(spark, str(tmp_path), rows).fact_transactions).collect()}
    assert got["Total Valid Orders"] == 1 and got["Identified Customers"] == 2
    assert got["Repeat Customer Rate (%)"] == 0 and got["Unidentified Customer Revenue"] == 1


def test_operational_entries_are_left_out(spark, tmp_path):
    rows = [raw_row(str(i), f"P{i}", name, price="9.00") for i, name in enumerate(
        ["postage", " Manual ", "Bank  charges", "Discount", "mug", None])]
    star = build(spark, str(tmp_path), rows)
    names = [r.description for r in business.top_products_by_revenue(star).collect()]
    assert names == ["mug", "UNKNOWN PRODUCT"]
    assert business.active_products(star).first()[0] == 6
    assert business.home_vs_international(star).first().market == "home"


def test_segment_rules(spark):
    scores = spark.createDataFrame(list(product(range(1, 6), repeat=3)),
                                   "recency_score int, frequency_score int, monetary_score int")
    got = {r[0]: r[1] for r in scores.groupBy(customer_segment()).count().collect()}
    assert got == {
        "Champions": 8, "Loyal Customers": 22, "New Customers": 5, "Potential Loyalists": 20, "At Risk": 20,
        "Lost Customers": 10, "Hibernating": 20, "Big Spenders": 4, "Need Attention": 16,
    }


def test_rfm_recency_starts_at_one(spark, tmp_path):
    rows = [raw_row(str(i), at=datetime(2011, 12, 1 + i, 14), customer=float(i), price=f"{i}.00") for i in range(1, 8)]
    rows.append(raw_row("99", at=datetime(2011, 12, 9, 12, 50), customer=None))
    star = build(spark, str(tmp_path), rows)
    got = {r.customer_id: r for r in rfm_customers(spark, star).collect()}
    assert got["7"].recency_days == 1 and got["1"].recency_days == 7
    assert [got[str(i)].recency_score for i in range(1, 8)] == [1, 1, 2, 3, 4, 5, 5]
    assert [got[str(i)].monetary_score for i in range(1, 8)] == [1, 1, 2, 3, 4, 5, 5]
    # All have one order: ties are ranked by id.
    assert [got[str(i)].frequency_score for i in range(1, 8)] == [1, 1, 2, 3, 4, 5, 5]
    assert got["7"].rfm_score == "555" and got["7"].customer_segment == "Champions"
    summary = rfm_segment_summary(rfm_customers(spark, star)).collect()
    assert sum(r.customer_count for r in summary) == 7
    assert sum(r.total_revenue for r in summary) == 28


def test_rfm_of_one_and_of_none(spark, tmp_path):
    one = build(spark, str(tmp_path / "one"), [raw_row("1")])
    assert rfm_customers(spark, one).first().rfm_score == "511"
    none = build(spark, str(tmp_path / "none"), [raw_row("1", customer=None)])
    assert rfm_customers(spark, none).count() == 0
    assert rfm_segment_summary(rfm_customers(spark, none)).count() == 0


def test_clean_table_round_trip(spark, tmp_path):
    from tallyhouse.operators.cleaning import clean_transactions
    from tallyhouse.sources.tables import read_clean

    raw = spark.createDataFrame(LINES, RAW)
    write_clean(raw, str(tmp_path / "clean"))
    stored = read_clean(spark, str(tmp_path / "clean"))
    assert stored.schema == CLEAN
    assert sorted(map(str, stored.collect())) == sorted(map(str, clean_transactions(raw).collect()))
    assert DIM_CUSTOMER.names == ["customer_key", "customer_id", "country"]
