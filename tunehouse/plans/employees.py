"""Employee analyses."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tunehouse.functions.numbers import percent_of, percent_text
from tunehouse.functions.text import full_name


def employee_growth(
    dim_employee: DataFrame, dim_customer: DataFrame, fact_invoice: DataFrame, distinct_customers: bool = False
) -> DataFrame:
    """Years employed, customers served per year and growth of sales for each employee.

    "Customers served" counts invoices, and a customer without any counts one in
    the year NULL; with ``distinct_customers`` it counts customers. Growth is
    against the employee's previous row, whichever year that is.

    Sales are added up per customer and year, then per employee and year, before
    each join: an employee with a third of all customers is a few rows by then.
    """
    yearly = fact_invoice.groupBy("customerid", F.year("invoicedate").alias("year")).agg(
        F.count(F.lit(1)).alias("_invoices"), F.sum("total").alias("_revenue")
    )
    served = F.lit(1) if distinct_customers else F.coalesce("_invoices", F.lit(1))
    by_employee = (
        dim_customer.select("customerid", F.col("supportrepid").alias("employeeid"))
        .join(yearly, "customerid", "left")
        .groupBy("employeeid", "year")
        .agg(
            F.sum(F.when(F.col("customerid").isNotNull(), served).otherwise(0)).alias("_served"),
            F.sum("_revenue").alias("_revenue"),
        )
    )
    name = full_name(F.col("firstname"), F.col("lastname")).alias("name")
    rows = (
        dim_employee.select("employeeid", name, "years_employed")
        .join(by_employee, "employeeid", "left")
        .groupBy("employeeid", "name", "years_employed", "year")
        .agg(
            F.sum(F.coalesce("_served", F.lit(0))).alias("total_customers_served_per_year"),
            F.sum("_revenue").alias("_revenue"),
        )
    )
    before = F.lag("_revenue").over(Window.partitionBy("employeeid").orderBy(F.asc_nulls_last("year")))
    return rows.withColumn("_before", before).select(
        "employeeid",
        "name",
        "years_employed",
        "year",
        "total_customers_served_per_year",
        percent_text(percent_of(F.col("_revenue") - F.col("_before"), F.col("_before"))).alias("growth_percentege"),
    )
