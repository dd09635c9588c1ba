"""The two file jobs from their inputs to the staging tables: compute, write CSV, refresh the table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tunehouse.plans.currencies import currencies
from tunehouse.plans.departments import load_department_budgets
from tunehouse.sinks.files import write_csv
from tunehouse.sinks.tables import refresh_table
from tunehouse.sources.rates import daily_rates, read_rate_responses


def csv_to_table(rows: DataFrame, csv_path: str, table: str, root: str) -> DataFrame:
    """Write ``rows`` as CSV and refresh ``table`` from the files written; gives the stored table."""
    write_csv(rows, csv_path)
    written = rows.sparkSession.read.csv(csv_path, schema=rows.schema, header=True, mode="FAILFAST")
    return refresh_table(written, table, root)


def department_job(
    spark: SparkSession,
    departments: str,
    json_lines: str,
    json_columns: str,
    csv_path: str,
    table: str,
    root: str,
    one_per_line: bool = False,
) -> DataFrame:
    """Department budgets from their three files into ``table``, by way of ``csv_path``."""
    totals = load_department_budgets(spark, departments, json_lines, json_columns, one_per_line)
    return csv_to_table(totals, csv_path, table, root)


def currency_job(invoices: DataFrame, responses: str, csv_path: str, table: str, root: str) -> DataFrame:
    """Invoices priced by the landed responses into ``table``, by way of ``csv_path``.

    Days without a usable response have the default rate; ``response_counts`` tells how many responses failed.
    """
    rates = daily_rates(read_rate_responses(invoices.sparkSession, responses))
    return csv_to_table(currencies(invoices, rates), csv_path, table, root)
