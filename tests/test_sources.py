"""Sheets in files and folders."""

from datetime import datetime
from decimal import Decimal

import pytest

from tallyhouse.schemas import RAW
from tallyhouse.operators.cleaning import clean_transactions, deduplicate, standardise
from tallyhouse.operators.rejects import reject_summary, rejects
from tallyhouse.plans.catalog import Workspace
from tallyhouse.plans.jobs import ingest_and_clean
from tallyhouse.session import scratch, shuffle_partitions_for, sized_for, source_bytes
from tallyhouse.sinks.tables import write_clean, write_landing
from tallyhouse.sources.sample_lines import write_sample_workbook
from tallyhouse.sources.sheets import discover_sheets, open_workbook, scan_landing, scan_sheets, scan_workbook
from tallyhouse.sources.tables import read_clean, read_table
from tests.test_cleaning import raw_row

HEADER = "Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID,Country\n"


@pytest.fixture
def workbook(tmp_path):
    book = tmp_path / "book"
    book.mkdir()
    (book / "Year 2009-2010.csv").write_text(
        HEADER + '489434,0085048,"a ""big"", mug",12,2009-12-01 07:45:00,6.95,13085.0,United Kingdom\n'
        "C489449,22087,,-12,2009-12-01 10:33:00,2.95,,Australia\n"
    )
    # Columns in another order, one missing, one unknown, one bad number.
    (book / "Year 2010-2011.csv").write_text(
        "Quantity,Invoice,StockCode,InvoiceDate,Price,Country,Note\n"
        "many,536365,85123A,2010-12-01 08:26:00,2.55,EIRE,x\n"
    )
    return str(book)


def test_sheets_are_found_by_name(spark, workbook):
    assert discover_sheets(spark, workbook) == {
        "Year 2009-2010": f"{workbook}/Year 2009-2010.csv",
        "Year 2010-2011": f"{workbook}/Year 2010-2011.csv",
    }


def test_csv_workbook(spark, workbook):
    raw = scan_workbook(spark, workbook, "csv")
    assert raw.columns == RAW.names and {kind for _, kind in raw.dtypes} == {"string"}
    mug = raw.where("Invoice = '489434'").first()
    assert (mug.StockCode, mug.Description, mug.Quantity, mug.Price) == ("0085048", 'a "big", mug', "12", "6.95")
    assert mug.source_sheet == "Year 2009-2010"
    rows = {r.invoice_id: r for r in standardise(raw).collect()}
    mug = rows["489434"]
    assert (mug.quantity, mug.invoice_date, mug.unit_price, mug.customer_id) == (
        12, datetime(2009, 12, 1, 7, 45), Decimal("6.95"), "13085",
    )
    assert rows["C489449"].description is None
    late = rows["536365"]
    assert (late.quantity, late.description, late.customer_id, late.source_sheet) == (None, None, None, "Year 2010-2011")


def test_numbers_in_other_shapes(spark, tmp_path):
    quantities = ["6.0", "1e3", "2.5", " 7", "-3.0", "many", "", "99999999999"]
    (tmp_path / "s.csv").write_text(HEADER + "".join(f"{i},A,x,{q},2010-01-01,1,1,F\n" for i, q in enumerate(quantities)))
    rows = standardise(scan_workbook(spark, str(tmp_path), "csv")).collect()
    assert [r.quantity for r in sorted(rows, key=lambda r: r.invoice_id)] == [6, 1000, None, 7, -3, None, None, None]
    stored = spark.createDataFrame([("1", 2.5), ("2", 6.0)], "Invoice string, Quantity double")
    stored.write.parquet(str(tmp_path / "book" / "p"))
    rows = standardise(scan_workbook(spark, str(tmp_path / "book"))).collect()
    assert {r.invoice_id: r.quantity for r in rows} == {"1": None, "2": 6}


def test_sample_sheets_are_written_and_read_in_many_tasks(spark, tmp_path):
    rows = [
        (str(i), "A", "d", 1 + i % 30, datetime(2010 + i % 2, 1, 1 + i % 28), Decimal("1.5"), 7.0, "F", "s") for i in range(400)
    ]
    lines = spark.createDataFrame(
        rows,
        "Invoice string, StockCode string, Description string, Quantity int, InvoiceDate timestamp, "
        "Price decimal(18,4), `Customer ID` double, Country string, source_sheet string",
    ).repartition(8)
    book = str(tmp_path / "book")
    write_sample_workbook(lines, book)
    assert set(discover_sheets(spark, book)) == {"lines.v1.2010", "lines.v1.2011"}
    for sheet in (tmp_path / "book").glob("source_sheet=*"):
        assert len(list(sheet.glob("part-*.csv"))) > 1
    raw = scan_workbook(spark, book, "csv").collect()
    assert sorted(int(r.Invoice) for r in raw) == list(range(400))
    assert all(r.source_sheet == f"lines.v1.{2010 + int(r.Invoice) % 2}" for r in raw)
    assert all((r.Country is None) == (int(r.Invoice) % 2 == 0) for r in raw)
    assert all(r.Description == ('d\n"new"' if (1 + int(r.Invoice) % 30) % 3 == 0 else "d") for r in raw)


def test_line_breaks_inside_quotes(spark, tmp_path):
    (tmp_path / "s.csv").write_text(HEADER + '1,A,"two\nlines",1,2010-01-01,1,1,F\n')
    rows = scan_workbook(spark, str(tmp_path), "csv").collect()
    assert [(r.Invoice, r.Description) for r in rows] == [("1", "two\nlines")]


def test_lines_that_differ_in_any_digit_stay(spark, tmp_path):
    rows = [("1", 1.00001, "a"), ("1", 1.00002, "a"), ("1", 1.00002, "a")]
    spark.createDataFrame(rows, "Invoice string, Price double, Description string").write.parquet(str(tmp_path / "b" / "p"))
    raw = scan_workbook(spark, str(tmp_path / "b"))
    assert raw.schema["Price"].dataType.simpleString() == "double"
    assert deduplicate(raw).count() == 2


def test_timestamp_format(spark, tmp_path):
    (tmp_path / "s.csv").write_text(HEADER + "1,A,x,1,12/1/2009 7:45,1,1,F\n2,A,x,1,soon,1,1,F\n")
    raw = scan_sheets(spark, {"s": str(tmp_path / "s.csv")}, "csv")
    rows = standardise(raw, "M/d/yyyy H:mm").collect()
    assert {r.invoice_id: r.invoice_date for r in rows} == {"1": datetime(2009, 12, 1, 7, 45), "2": None}


def test_text_dates_are_ordered_by_time(spark, tmp_path):
    days = ["12/1/2009 7:45", "2/1/2010 7:45", "11/30/2009 9:00", "soon"]
    (tmp_path / "s.csv").write_text(HEADER + "".join(f"{i},A,x,1,{d},1,1,F\n" for i, d in enumerate(days)))
    write_clean(scan_workbook(spark, str(tmp_path), "csv"), str(tmp_path / "clean"), "M/d/yyyy H:mm")
    rows = read_clean(spark, str(tmp_path / "clean"), with_position=True).collect()
    ordered = sorted(rows, key=lambda r: (r.line_block, r.line_place))
    assert [r.invoice_id for r in ordered] == ["3", "2", "0", "1"]


def test_folders_of_parquet(spark, tmp_path):
    book, landing = str(tmp_path / "book"), str(tmp_path / "landing")
    rows = [raw_row("1", sheet="Year 1"), raw_row("2", sheet="v+2: %"), raw_row("2", sheet="v+2: %")]
    lines = spark.createDataFrame(rows, RAW)
    lines.write.partitionBy("source_sheet").parquet(book)
    assert list(discover_sheets(spark, book)) == ["Year 1", "v+2: %"]
    expected = sorted(map(str, lines.collect()))
    assert sorted(map(str, scan_workbook(spark, book).collect())) == expected
    write_landing(lines, landing)
    assert sorted(map(str, scan_landing(spark, landing).collect())) == expected
    assert scan_landing(spark, landing).schema == RAW


def test_dotted_folders_stay_apart(spark, tmp_path):
    book = tmp_path / "b5"
    for i, name in enumerate(("v1.2009", "v1.2010", "b5", "plain name")):
        (book / name).mkdir(parents=True)
        (book / name / "part.csv").write_text(HEADER + f"{i},A,x,1,2010-01-01,1,1,F\n")
    rows = scan_workbook(spark, str(book), "csv").collect()
    assert {r.source_sheet: r.Invoice for r in rows} == {"v1.2009": "0", "v1.2010": "1", "b5": "2", "plain name": "3"}


def test_names_that_clash_are_an_error(spark, tmp_path):
    (tmp_path / "y.csv").write_text(HEADER)
    (tmp_path / "y.txt").write_text(HEADER)
    with pytest.raises(ValueError, match="two sheets are named 'y'"):
        discover_sheets(spark, str(tmp_path))


def test_plan_does_not_grow_with_the_sheets(spark, tmp_path):
    for i in range(60):
        header = HEADER if i % 2 else "Quantity,Invoice\n"
        (tmp_path / f"s{i}.csv").write_text(header + ("1,A,x,1,2010-01-01,1,1,F\n" if i % 2 else "1,1\n"))
    raw = scan_workbook(spark, str(tmp_path), "csv")
    assert raw._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 2
    assert raw.select("source_sheet").distinct().count() == 60


def test_clean_needs_no_types_in_the_source(spark, tmp_path):
    (tmp_path / "s.csv").write_text(HEADER + "1,A,x,2.0,2010-01-01 10:00:00,1.25,7.0,F\n" * 2)
    row = clean_transactions(scan_workbook(spark, str(tmp_path), "csv")).collect()
    assert [(r.net_line_value, r.customer_id, r.transaction_status) for r in row] == [(Decimal("2.50"), "7", "valid_sale")]


@pytest.mark.parametrize("read", [
    lambda s, p: scan_workbook(s, p),
    lambda s, p: scan_landing(s, p),
    lambda s, p: scan_sheets(s, {"a": p}),
    lambda s, p: read_clean(s, p),
    lambda s, p: read_table(s, p, "dim_date"),
])
def test_missing_source(spark, tmp_path, read):
    with pytest.raises(FileNotFoundError):
        read(spark, str(tmp_path / "nowhere"))


def test_no_sheets(spark):
    with pytest.raises(FileNotFoundError):
        scan_sheets(spark, {})


def test_shuffles_grow_with_the_input(spark, workbook):
    assert 0 < source_bytes(spark, workbook) < 10_000
    assert shuffle_partitions_for(0) == 1
    assert shuffle_partitions_for(100 << 40) == 204_800
    assert shuffle_partitions_for(100 << 40, 1 << 30) == 102_400
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    with sized_for(spark, 10 << 40):
        assert spark.conf.get(key) == "20480"
    with sized_for(spark, 1):
        assert spark.conf.get(key) == before
    assert spark.conf.get(key) == before


def test_scratch_goes_when_the_work_is_done(spark, tmp_path):
    with scratch(spark, "x") as path:
        spark.range(3).write.parquet(path)
        kept = path
    with pytest.raises(FileNotFoundError):
        scan_landing(spark, kept)
    space = Workspace(spark, "/root/testdata/sf0.001")
    assert space.raw.count() > 0
    space.close()
    with pytest.raises(FileNotFoundError):
        scan_landing(spark, f"{space.root}/landing")


def test_files_of_one_sheet_with_other_columns(spark, tmp_path):
    sheet = tmp_path / "book" / "s"
    sheet.mkdir(parents=True)
    (sheet / "a.csv").write_text(HEADER + "1,A,x,3,2010-01-01,9.75,7,F\n")
    (sheet / "b.csv").write_text(HEADER.replace("Quantity,InvoiceDate,Price", "Price,InvoiceDate,Quantity") + "2,A,x,9.75,2010-01-01,3,7,F\n")
    (sheet / "c.csv").write_text('Country,Quantity,Quantity,Invoice\nF,4,5,"3\n"\n')
    for rows in (scan_workbook(spark, str(sheet.parent), "csv"), scan_sheets(spark, {"s": str(sheet)}, "csv")):
        found = {r.Invoice: (r.Quantity, r.Price, r.Description, r.source_sheet) for r in rows.collect()}
        assert found == {"1": ("3", "9.75", "x", "s"), "2": ("3", "9.75", "x", "s"), "3\n": ("4", None, None, "s")}
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 3


def test_plan_grows_with_layouts_not_files(spark, tmp_path):
    for i in range(24):
        names = ["Invoice", "Quantity", "Price"][: 2 + i % 2]
        (tmp_path / "s").mkdir(exist_ok=True)
        (tmp_path / "s" / f"{i}.csv").write_text(",".join(names) + "\n" + ",".join("1" for _ in names) + "\n")
    rows = scan_workbook(spark, str(tmp_path), "csv")
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 2 and rows.count() == 24


def test_columns_of_all_parquet_files_of_a_sheet(spark, tmp_path):
    spark.createDataFrame([("1", 2)], "Invoice string, Quantity int").coalesce(1).write.parquet(str(tmp_path / "s"))
    spark.createDataFrame([(3, "2", "F")], "Quantity int, Invoice string, Country string").coalesce(1).write.mode("append").parquet(str(tmp_path / "s"))
    rows = {r.Invoice: (r.Quantity, r.Country) for r in scan_workbook(spark, str(tmp_path)).collect()}
    assert rows == {"1": (2, None), "2": (3, "F")}


def test_options_that_only_sparks_reader_knows(spark, tmp_path):
    (tmp_path / "s").mkdir()
    (tmp_path / "s" / "a.csv").write_text("# note\nInvoice,Quantity\n1,3\n")
    assert [(r.Invoice, r.Quantity) for r in scan_workbook(spark, str(tmp_path), "csv", comment="#").collect()] == [("1", "3")]
    (tmp_path / "s" / "b.csv").write_text("Quantity,Invoice\n1,3\n")
    with pytest.raises(Exception, match="CSV header does not conform"):
        scan_workbook(spark, str(tmp_path), "csv", comment="#").collect()


def test_rejects_keep_what_was_lost(spark, tmp_path):
    values = [("2.5", "2010-01-01", "x", "7"), ("many", "soon", "1e2", "y"), ("6.0", "", "NaN", ""), (" ", "2010-01-01", "1", "8.0")]
    lines = [f'{i},A,d,{q},{d},{p},{c},F\n' for i, (q, d, p, c) in enumerate(values)]
    (tmp_path / "s.csv").write_text(HEADER + "".join(lines) + "9,A,d,1\n8,A,d,1,2010-01-01,1,7,F,too many\n")
    book = open_workbook(spark, str(tmp_path), "csv")
    found = {tuple(r) for r in rejects(book.lines, book.malformed).collect()}
    assert found == {
        ("s", "0", "Quantity", "2.5", "not a whole number in range"),
        ("s", "0", "Price", "x", "no number"),
        ("s", "1", "Quantity", "many", "no number"),
        ("s", "1", "InvoiceDate", "soon", "no timestamp"),
        ("s", "1", "Customer ID", "y", "no number"),
        ("s", None, None, "9,A,d,1", "malformed line"),
        ("s", None, None, "8,A,d,1,2010-01-01,1,7,F,too many", "malformed line"),
    }
    assert book.lines.count() == 6
    summary = {tuple(r) for r in reject_summary(rejects(book.lines, book.malformed)).collect()}
    assert ("s", None, "malformed line", 2) in summary and len(summary) == 6
    typed = spark.createDataFrame([("1", 2.5, float("nan"))], "Invoice string, Quantity double, Price double")
    typed.write.parquet(str(tmp_path / "p" / "t"))
    book = open_workbook(spark, str(tmp_path / "p"))
    assert [tuple(r) for r in rejects(book.lines, book.malformed).collect()] == [
        ("t", "1", "Quantity", "2.5", "not a whole number in range")
    ]


def test_clean_job_writes_rejects(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "s.csv").write_text(HEADER + "1,A,d,many,2010-01-01,1,7,F\n" * 3 + "2,A\n")
    book = open_workbook(spark, str(tmp_path / "in"), "csv")
    ingest_and_clean(spark, book.lines, str(tmp_path / "out"), 1, land=True, malformed=book.malformed)
    rows = spark.read.options(header="true").csv(str(tmp_path / "out" / "reports" / "reject_summary")).collect()
    assert {(r.column_name, r.reason, r.rejected) for r in rows} == {("Quantity", "no number", "3"), (None, "malformed line", "1")}
    assert spark.read.options(header="true").csv(str(tmp_path / "out" / "data_rejects")).count() == 4
