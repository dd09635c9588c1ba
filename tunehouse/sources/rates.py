"""Exchange rates: landed service responses instead of one request per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunehouse.schemas import RATE_RESPONSE


def first_mid(response: Column) -> Column:
    """``rates[0].mid`` of a JSON response text."""
    return F.get_json_object(response, "$.rates[0].mid").cast("double")


def read_rate_responses(spark: SparkSession, path: str) -> DataFrame:
    """Responses, one JSON object per line with its day and currency code.

    A line that is no such object (an error page, say) is a row of its own with
    ``malformed`` true and all else NULL, so that its day falls back to the
    default rate instead of failing the job. ``response_counts`` counts them.
    """
    schema = T.StructType([*RATE_RESPONSE.fields, T.StructField("_text", T.StringType())])
    raw = spark.read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_text").json(path)
    good = F.col("_text").isNull()
    return raw.select(
        F.when(good, F.col("rate_date")).alias("rate_date"),
        F.when(good, F.lower("code")).alias("code"),
        F.when(good, F.get("rates", F.lit(0))["mid"]).alias("mid"),
        (~good).alias("malformed"),
    )


def response_counts(responses: DataFrame) -> DataFrame:
    """One row: all responses, those that could not be read, and those without a usable rate."""
    unusable = F.col("rate_date").isNull() | F.col("mid").isNull() | (F.col("mid") == 0)
    return responses.agg(
        F.count(F.lit(1)).alias("responses"),
        F.count_if("malformed").alias("malformed"),
        F.count_if(unusable & ~F.col("malformed")).alias("without_rate"),
    )


def daily_rates(rates: DataFrame) -> DataFrame:
    """One row per day: ``rate_date, usd_pln, ils_pln``. At most one row per calendar day."""
    return rates.filter(F.col("rate_date").isNotNull()).groupBy("rate_date").agg(
        F.max(F.when(F.col("code") == "usd", F.col("mid"))).alias("usd_pln"),
        F.max(F.when(F.col("code") == "ils", F.col("mid"))).alias("ils_pln"),
    )
