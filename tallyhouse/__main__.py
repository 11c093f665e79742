"""``python -m tallyhouse clean|warehouse|analytics|questions --output ...``

Run through spark-submit on a cluster; the session comes from its settings.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tallyhouse.plans import jobs
from tallyhouse.session import source_bytes
from tallyhouse.sources.sheets import open_workbook


def main() -> None:
    parser = argparse.ArgumentParser(prog="tallyhouse")
    parser.add_argument("job", choices=["clean", "warehouse", "analytics", "questions"])
    parser.add_argument("--output", required=True, help="folder of all tables and reports")
    parser.add_argument("--sheets", help="folder with one file or folder per sheet (clean)")
    parser.add_argument("--format", default="parquet", help="format of the sheets")
    parser.add_argument("--timestamp-format", help="pattern of InvoiceDate in text sheets")
    parser.add_argument(
        "--plain-lines", action="store_true", help="no line breaks inside quotes: quotes of CSV lines are not followed"
    )
    options = parser.parse_args()

    # Invoice times are wall-clock times; UTC has no hour that is skipped.
    spark = (
        SparkSession.builder.appName(f"tallyhouse {options.job}")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    if options.job == "clean":
        if not options.sheets:
            parser.error("clean needs --sheets")
        splits = {"multiLine": "false"} if options.plain_lines and options.format == "csv" else {}
        book = open_workbook(spark, options.sheets, options.format, **splits)
        jobs.ingest_and_clean(
            spark,
            book.lines,
            options.output,
            source_bytes(spark, options.sheets),
            land=True,
            timestamp_format=options.timestamp_format,
            malformed=book.malformed,
        )
    elif options.job == "warehouse":
        jobs.build_warehouse(spark, options.output)
    elif options.job == "analytics":
        jobs.export_analytics(spark, options.output)
    else:
        jobs.answer_questions(spark, options.output)


if __name__ == "__main__":
    main()
