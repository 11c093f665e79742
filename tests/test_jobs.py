"""The three jobs end to end, and what must hold between their outputs."""

import csv
import glob

import pytest

from tallyhouse.plans import jobs
from tallyhouse.sources.sample_lines import retail_lines
from tallyhouse.sources.sheets import scan_workbook
from tallyhouse.sources.tables import read_clean, read_clean_csv, warehouse_lines
from tallyhouse.sinks.exports import write_csv
from tests.conftest import SMALL


def read_csv(folder):
    rows = []
    for path in sorted(glob.glob(f"{folder}/part-*.csv")):
        with open(path, newline="") as lines:
            rows += list(csv.DictReader(lines))
    return rows


def metrics(folder):
    return {r["metric"]: r["value"] for r in read_csv(folder)}


@pytest.fixture(scope="module")
def output(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("jobs")
    retail_lines(spark, SMALL).write.partitionBy("source_sheet").parquet(str(root / "sheets"))
    raw = scan_workbook(spark, str(root / "sheets"))
    out = str(root / "out")
    for land in (True, False):  # The second run replaces the first.
        jobs.ingest_and_clean(spark, raw, out, 1, land=land)
        jobs.build_warehouse(spark, out)
        jobs.export_analytics(spark, out)
    jobs.answer_questions(spark, out)
    return out


def test_reports_agree(output):
    reports, analytics = f"{output}/reports", f"{output}/analytics"
    quality, cleaning = metrics(f"{reports}/data_quality_summary"), metrics(f"{reports}/cleaning_summary")
    kpis = {k: float(v) for k, v in metrics(f"{reports}/executive_kpis").items()}
    months, countries = read_csv(f"{analytics}/monthly_sales"), read_csv(f"{analytics}/country_performance")
    segments, customers = read_csv(f"{reports}/rfm_segment_summary"), read_csv(f"{analytics}/customer_performance")
    scored = read_csv(f"{analytics}/customer_rfm_segments")

    assert len(quality) == 20 and len(cleaning) == 13 and len(kpis) == 12
    assert len(read_csv(f"{reports}/column_profile")) == 9
    raw_rows, copies = float(cleaning["Raw rows"]), float(cleaning["Exact duplicates removed"])
    assert raw_rows - copies == float(cleaning["Rows after deduplication"]) == 6000
    assert float(quality["Total rows"]) == raw_rows and float(quality["Duplicate rows"]) == copies

    def total(rows, column):
        return round(sum(float(r[column]) for r in rows), 2)

    gross = kpis["Gross Sales Revenue"]
    assert total(months, "revenue") == total(countries, "revenue") == gross
    assert float(cleaning["Total valid sales revenue"]) == gross
    assert total(read_csv(f"{analytics}/product_performance"), "revenue") == gross
    assert total(months, "units_sold") == total(countries, "units_sold") == kpis["Units Sold"]
    assert total(countries, "customers") >= kpis["Identified Customers"] == len(customers) == len(scored)
    assert total(segments, "customer_count") == kpis["Identified Customers"]
    identified = round(gross - kpis["Unidentified Customer Revenue"], 2)
    assert total(segments, "total_revenue") == identified == total(customers, "revenue")
    assert kpis["Estimated Net Revenue"] == round(gross - kpis["Recorded Return Value"], 2)
    assert kpis["Average Order Value"] == pytest.approx(gross / kpis["Total Valid Orders"], abs=0.006)
    assert total(segments, "revenue_share_percentage") == pytest.approx(100, abs=0.1)


def test_questions_are_answered(output):
    questions = {
        "monthly_trend": 80, "top_international_markets": 10, "revenue_concentration": 25, "top_products_by_revenue": 10,
        "top_products_by_units": 10, "top_customers": 20, "top_markets": 15, "product_revenue_vs_volume": 100,
        "valid_sales_sample": 100, "home_vs_international": 2, "active_products": 1, "top_product": 1,
        "volume_vs_revenue_rank": 100, "segment_spotlight": 1,
    }
    for name, most in questions.items():
        rows = read_csv(f"{output}/questions/{name}")
        assert 0 < len(rows) <= most, name


def test_exports_are_sorted(output):
    for name, column in [("country_performance", "revenue"), ("product_performance", "revenue"),
                         ("customer_performance", "revenue")]:
        values = [float(r[column]) for r in read_csv(f"{output}/analytics/{name}")]
        assert values == sorted(values, reverse=True) and values
    months = [(int(r["year"]), int(r["month_number"])) for r in read_csv(f"{output}/analytics/monthly_sales")]
    assert months == sorted(months)
    revenue = [float(r["total_revenue"]) for r in read_csv(f"{output}/reports/rfm_segment_summary")]
    assert revenue == sorted(revenue, reverse=True)


def test_numbers_and_times_are_plain(output):
    gross = metrics(f"{output}/reports/executive_kpis")["Gross Sales Revenue"]
    assert "E" not in gross and len(gross.partition(".")[2]) == 2
    first = read_csv(f"{output}/analytics/customer_performance")[0]["first_purchase"]
    assert len(first) == 19 and first[10] == " "


def test_exceptions_stay_in_the_clean_table(spark, output):
    clean = read_clean(spark, f"{output}/clean_transactions")
    listed = read_csv(f"{output}/data_exceptions")
    assert clean.count() == 6000
    assert len(listed) == float(metrics(f"{output}/reports/cleaning_summary")["Exception rows"])


def test_clean_csv_round_trip(spark, output, tmp_path):
    clean = read_clean(spark, f"{output}/clean_transactions")
    write_csv(clean, str(tmp_path / "csv"))
    back = read_clean_csv(spark, str(tmp_path / "csv"))
    assert back.schema == clean.schema
    expected = warehouse_lines(clean)  # a CSV field is missing or has text
    assert back.exceptAll(expected).count() == 0 and expected.exceptAll(back).count() == 0


def test_warehouse_answers_sql_in_a_later_session(spark, output):
    jobs.attach_warehouse(spark.newSession(), output)
    session = spark.newSession()
    jobs.attach_warehouse(session, output)
    share = session.sql("SELECT sum(revenue) AS r FROM vw_country_performance WHERE country <> 'United Kingdom'")
    assert 0 < share.first().r < float(metrics(f"{output}/reports/executive_kpis")["Gross Sales Revenue"])
    assert session.sql("SELECT * FROM vw_monthly_sales ORDER BY 1").count() == 80


def test_jobs_need_their_input(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        jobs.build_warehouse(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError):
        jobs.export_analytics(spark, str(tmp_path))
