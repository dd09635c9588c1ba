"""Department budgets from three differently shaped files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunehouse.schemas import DEPARTMENT, DEPARTMENT_BUDGET, SUB_BUDGET, conform
from tunehouse.sources.files import read_delimited, read_json_columns, read_json_lines


def department_budgets(departments: DataFrame, *sub_budgets: DataFrame) -> DataFrame:
    """Total budget per department; sub-budgets of unknown departments drop out.

    Sub-budgets are added up per department before the join, so a department
    with very many of them does not become a hot join key.
    """
    rows = sub_budgets[0]
    for more in sub_budgets[1:]:
        rows = rows.unionByName(more, allowMissingColumns=True)
    per_department = rows.groupBy("department_id").agg(F.sum(F.col("budget").cast("decimal(28,2)")).alias("_budget"))
    totals = (
        departments.join(per_department, "department_id")
        .filter(F.col("department_name").isNotNull())
        .groupBy("department_id", "department_name")
        .agg(F.coalesce(F.sum("_budget"), F.lit(0)).alias("budget"))
    )
    return conform(totals, DEPARTMENT_BUDGET)


def load_department_budgets(
    spark: SparkSession, departments: str, json_lines: str, json_columns: str, one_per_line: bool = False
) -> DataFrame:
    """The same from the paths of the three files."""
    return department_budgets(
        read_delimited(spark, departments, DEPARTMENT),
        read_json_lines(spark, json_lines, SUB_BUDGET),
        read_json_columns(spark, json_columns, SUB_BUDGET, one_per_line),
    )
