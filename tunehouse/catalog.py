"""The named queries, each over one folder of Parquet test tables."""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunehouse.operators.joins import anti_join, semi_join, update_from
from tunehouse.operators.ranking import head_rest_split
from tunehouse.operators.sets import union_all
from tunehouse.plans import checks, countries, customers, employees, playlists, recommend, tracks
from tunehouse.plans.currencies import convert, convert_at_default
from tunehouse.plans.jobs import currency_job, department_job
from tunehouse.plans.incremental import SalesStates
from tunehouse.plans.load import LoadedWarehouse, check_loaded, check_loaded_contents, load_warehouse
from tunehouse.plans.publish import PublishedWarehouse, delete_rows, publish
from tunehouse.plans.warehouse import Warehouse
from tunehouse.schemas import DEPARTMENT, MAX_LENGTHS, SUB_BUDGET
from tunehouse.session import land, own_scratch, scratch_path
from tunehouse.sinks.files import write_csv, write_delimited, write_json_columns, write_json_document, write_json_lines
from tunehouse.sinks.partitions import read_partitioned, update_stored, write_partitioned
from tunehouse.sinks.tables import refresh_table
from tunehouse.sources.files import read_delimited, read_json_columns, read_json_lines
from tunehouse.sources.json_document import read_json_document
from tunehouse.sources.rates import daily_rates, read_rate_responses
from tunehouse.sources.tables import read_table
from tunehouse.staging import Staging

AS_OF = datetime.date(2024, 2, 28)  # stands for "today", so that results do not change from day to day
HEAD_ROWS = 25  # fixed value: rows converted by rate; the others get the default rate

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def comparable(df: DataFrame) -> DataFrame:
    """Types that every engine hands out alike: decimals as doubles, dates as midnight timestamps."""
    as_type = {T.DecimalType: "double", T.DateType: "timestamp_ntz"}
    return df.withColumns(
        {f.name: F.col(f.name).cast(as_type[type(f.dataType)]) for f in df.schema.fields if type(f.dataType) in as_type}
    )


def query(build: Callable[[Warehouse], DataFrame]) -> Callable[[Warehouse], DataFrame]:
    """Register a query under its function name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(build(Warehouse(Staging.of(spark, sf_dir), AS_OF)))

    QUERIES[build.__name__] = run
    return build


# ---- sources


def _department_files(wh: Warehouse) -> tuple[str, str, str]:
    """Nations as departments; customers' and suppliers' balances as sub-budgets.

    Department ids are shifted, so some budgets have no department and the other way round.
    """
    s = wh.staging
    paths = tuple(scratch_path(s.spark, name) for name in ("department", "budget-lines", "budget-columns"))
    nations = s.source("nation").select("n_nationkey", "n_name").toDF("department_id", "department_name")

    def budgets(table: str, c: str, key: str) -> DataFrame:
        return s.source(table).select(
            F.col(key).alias("sub_dep_id"),
            F.col(f"{c}_name").alias("sub_dep_name"),
            (F.col(f"{c}_nationkey") + 2).alias("department_id"),
            F.floor(f"{c}_acctbal").alias("budget"),
        )

    write_delimited(nations, paths[0])
    write_json_lines(budgets("customer", "c", "c_custkey"), paths[1])
    write_json_columns(budgets("supplier", "s", "s_suppkey"), paths[2], key="sub_dep_id")
    return paths


@query
def src_delimited(wh: Warehouse) -> DataFrame:
    """Customers as `-`-delimited text."""
    s, path = wh.staging, scratch_path(wh.staging.spark, "delimited")
    write_delimited(s.source("customer").select("c_custkey", "c_name").toDF("department_id", "department_name"), path)
    return read_delimited(s.spark, path, DEPARTMENT)


@query
def src_jsonl(wh: Warehouse) -> DataFrame:
    """Orders as JSON Lines."""
    s, path = wh.staging, scratch_path(wh.staging.spark, "jsonl")
    rows = s.source("orders").select("o_orderkey", "o_orderpriority", "o_custkey", F.floor("o_totalprice"))
    write_json_lines(rows.toDF(*SUB_BUDGET.fieldNames()), path)
    return read_json_lines(s.spark, path, SUB_BUDGET)


@query
def src_json_columns(wh: Warehouse) -> DataFrame:
    """Parts as column-oriented JSON documents; some cells are missing."""
    s, path = wh.staging, scratch_path(wh.staging.spark, "json-columns")
    name = F.when(F.col("p_size") > 3, F.col("p_name"))
    rows = s.source("part").select("p_partkey", name, F.col("p_size").cast("bigint"), F.floor("p_retailprice"))
    write_json_columns(rows.toDF(*SUB_BUDGET.fieldNames()), path, key="sub_dep_id")
    return read_json_columns(s.spark, path, SUB_BUDGET, one_per_line=True)


@query
def src_json_document(wh: Warehouse) -> DataFrame:
    """All parts as one column-oriented JSON document; some cells are missing."""
    s, path = wh.staging, scratch_path(wh.staging.spark, "json-document")
    name = F.when(F.col("p_size") > 3, F.concat("p_name", F.lit(', "{'), "p_brand", F.lit('}\\"')))
    rows = s.source("part").select("p_partkey", name, F.col("p_size").cast("bigint"), F.floor("p_retailprice"))
    write_json_document(rows.toDF(*SUB_BUDGET.fieldNames()), path, key="sub_dep_id")
    return read_json_document(s.spark, path, SUB_BUDGET, parts=True)


@query
def src_table(wh: Warehouse) -> DataFrame:
    return read_table(wh.staging.spark, f"{wh.staging.sf_dir}/orders.parquet")


def _response_files(wh: Warehouse) -> str:
    """The rates as service responses, one per day and currency."""
    s, path = wh.staging, scratch_path(wh.staging.spark, "rates")

    def response(code: str, mid: str):
        rates = F.array(F.struct(F.col(mid).alias("mid")))
        return F.struct(F.col("rate_date"), F.lit(code).alias("code"), rates.alias("rates"))

    both = F.array(response("USD", "usd_pln"), response("ILS", "ils_pln"))
    write_json_lines(s.rates().select(F.inline(both)), path)
    return path


@query
def src_rates_json(wh: Warehouse) -> DataFrame:
    return daily_rates(read_rate_responses(wh.staging.spark, _response_files(wh)))


# ---- jobs, dimensions, facts


def _stored(wh: Warehouse, job: Callable[..., DataFrame], name: str, *inputs: object, **options: object) -> DataFrame:
    """Run a job into a table of its own and read that back."""
    spark, table = wh.staging.spark, f"{name}_{uuid.uuid4().hex}"
    loaded = job(*inputs, csv_path=scratch_path(spark, name), table=table, root=own_scratch(spark), **options)
    spark.sql(f"DROP TABLE {table}")  # the files stay, and the frame reads those
    return loaded


@query
def etl_department(wh: Warehouse) -> DataFrame:
    """The department job from files to the stored table."""
    return _stored(wh, department_job, "department", wh.staging.spark, *_department_files(wh), one_per_line=True)


@query
def etl_currencies(wh: Warehouse) -> DataFrame:
    """The currency job from landed responses to the stored table."""
    return _stored(wh, currency_job, "currencies", wh.staging.invoice(), _response_files(wh))


@query
def dim_playlist(wh: Warehouse) -> DataFrame:
    return wh.playlist()


@query
def dim_customer(wh: Warehouse) -> DataFrame:
    return wh.customer()


@query
def dim_employee(wh: Warehouse) -> DataFrame:
    return wh.employee()


@query
def dim_track(wh: Warehouse) -> DataFrame:
    return wh.track()


@query
def dim_currencies(wh: Warehouse) -> DataFrame:
    """Priced invoices as loaded: one row per invoice, with the invoices' own columns left out."""
    return wh.currencies()


@query
def fact_invoice(wh: Warehouse) -> DataFrame:
    return wh.invoice()


@query
def fact_invoiceline(wh: Warehouse) -> DataFrame:
    return wh.invoiceline()


# ---- sinks


@query
def sink_csv(wh: Warehouse) -> DataFrame:
    rows, path = wh.currencies(), scratch_path(wh.staging.spark, "csv")
    write_csv(rows, path)
    return wh.staging.spark.read.csv(path, schema=rows.schema, header=True, mode="FAILFAST")


@query
def sink_overwrite(wh: Warehouse) -> DataFrame:
    """Load customers, then replace them by the load with cleaned names."""
    spark, clean = wh.staging.spark, wh.customer()
    name, root = f"refresh_{uuid.uuid4().hex}", own_scratch(spark)
    refresh_table(wh.staging.customer().withColumn("email_domain", F.lit(None).cast("string")), name, root)
    loaded = refresh_table(clean, name, root)
    spark.sql(f"DROP TABLE {name}")  # the files stay, and the frame reads those
    return loaded


# ---- checks


@query
def chk_playlist_counts(wh: Warehouse) -> DataFrame:
    return playlists.load_counts(wh.playlist(drop_ids=()))


@query
def chk_keys(wh: Warehouse) -> DataFrame:
    tracks_checked = ("trackid", "track_name", "track_duration", "composer")
    invoices_checked = ("invoiceid", *MAX_LENGTHS["fact_invoice"])
    return checks.check_keys(
        {
            "dim_playlist": (
                wh.playlist(),
                ["playlist_id", "track_id"],
                ["playlist_id", "playlist_name", "track_id"],
                MAX_LENGTHS["dim_playlist"],
            ),
            "dim_track": (
                wh.track(*tracks_checked),
                ["trackid"],
                ["trackid", "track_name", "track_duration"],
                MAX_LENGTHS["dim_track"],
            ),
            "fact_invoice": (
                wh.invoice(*invoices_checked),
                ["invoiceid"],
                ["invoiceid", "billingcountry"],
                MAX_LENGTHS["fact_invoice"],
            ),
            "fact_invoiceline": (wh.invoiceline("invoiceline_id"), ["invoiceline_id"], ["invoiceline_id"]),
        }
    )


@query
def chk_load_counts(wh: Warehouse) -> DataFrame:
    """The stored tables against staging; a warehouse that is not stored yet is loaded first."""
    if isinstance(wh, LoadedWarehouse):
        return check_loaded(wh)
    spark, database = wh.staging.spark, f"dwh_{uuid.uuid4().hex}"
    load_warehouse(wh, database, own_scratch(spark))
    counts = land(check_loaded(LoadedWarehouse(spark, database, wh)), "load-counts")
    spark.sql(f"DROP DATABASE {database} CASCADE")
    return counts


@query
def chk_contents(wh: Warehouse) -> DataFrame:
    """Every column of the stored tables against the rows built anew; a warehouse that is not stored yet is published first."""
    if isinstance(wh, LoadedWarehouse):
        return check_loaded_contents(wh)
    spark, root = wh.staging.spark, scratch_path(wh.staging.spark, "published")
    publish(wh, root)
    return check_loaded_contents(PublishedWarehouse(spark, root, source=wh))


# ---- operators


@query
def op_published_load(wh: Warehouse) -> DataFrame:
    """Two loads, a day and a year apart, both readable; of each, its tables' rows, the employees' years, and lines without their invoice."""
    spark, root = wh.staging.spark, scratch_path(wh.staging.spark, "published")
    publish(Warehouse(wh.staging, wh.as_of.replace(year=wh.as_of.year - 1)), root)
    publish(wh, root)
    parts = []
    for number in (1, 2):
        load = PublishedWarehouse(spark, root, number)
        rows = [df.agg(F.count(F.lit(1)).alias("value")).withColumn("measure", F.lit(f"rows of {name}")) for name, df in load.tables().items()]
        years = load.employee("years_employed").agg(F.sum(F.col("years_employed").cast("bigint")).alias("value"))
        orphans = anti_join(load.invoiceline("invoice_id"), load.invoice("invoiceid"), {"invoice_id": "invoiceid"})
        rows.append(years.withColumn("measure", F.lit("employees' years")))
        rows.append(orphans.agg(F.count(F.lit(1)).alias("value")).withColumn("measure", F.lit("lines without invoice")))
        parts += [r.select(F.lit(number).alias("load_number"), "measure", "value") for r in rows]
    return union_all(*parts)


@query
def op_delete_stored(wh: Warehouse) -> DataFrame:
    """Invoices of one country deleted from the published table; only files with such an invoice are written anew."""
    spark, root = wh.staging.spark, scratch_path(wh.staging.spark, "published")
    publish(wh, root)
    delete_rows(spark, root, "fact_invoice", F.col("billingcountry") == "NATION_7")
    return PublishedWarehouse(spark, root).invoice()


def _invoices_by_year(wh: Warehouse) -> tuple[str, T.StructType]:
    """Stored invoices in folders by year."""
    path = scratch_path(wh.staging.spark, "by-year")
    invoices = wh.invoice("invoiceid", "customerid", "invoicedate", "total").withColumn("year", F.year("invoicedate"))
    write_partitioned(invoices, path, "year")
    return path, invoices.schema


@query
def op_update_stored(wh: Warehouse) -> DataFrame:
    """Totals of the invoices of 1995 that have a line over 80,000 set to the dearest line's price; other years' files stay."""
    spark, (path, schema) = wh.staging.spark, _invoices_by_year(wh)
    lines = wh.invoiceline("invoice_id", "unitprice").where("unitprice > 80000")
    dated = wh.invoice("invoiceid", "invoicedate").where(F.year("invoicedate") == 1995)
    source = lines.join(dated, F.col("invoice_id") == F.col("invoiceid")).select("invoice_id", F.col("unitprice").alias("total"))
    update_stored(spark, path, schema, "year", source, {"invoiceid": "invoice_id"}, ["total"])
    return read_partitioned(spark, path, schema)


@query
def an_months_of_best_year(wh: Warehouse) -> DataFrame:
    """Monthly sales of the best year, from invoices in folders by year."""
    path, schema = _invoices_by_year(wh)
    return customers.months_of_best_years(read_partitioned(wh.staging.spark, path, schema))


def _sales_states(wh: Warehouse) -> SalesStates:
    """States after three loads: the older invoices, all of them (the older files again), and none new."""
    spark = wh.staging.spark
    root, source = (scratch_path(spark, n) for n in ("states", "invoice-files"))
    priced = convert(wh.invoice("invoiceid", "customerid", "invoicedate", "total", "billingcountry"), wh.staging.rates())
    states = SalesStates(spark, root)
    older = F.coalesce(F.col("invoicedate") < F.lit("1995-06-17").cast("date"), F.lit(True))
    for part in (older, ~older):
        priced.where(part).write.mode("append").parquet(source)
        states.add(source)
    states.add(source)
    return states


@query
def an_monthly_sales_kept(wh: Warehouse) -> DataFrame:
    """Sales per month, from states that two loads have added to."""
    return _sales_states(wh).monthly_sales()


@query
def an_customer_totals_kept(wh: Warehouse) -> DataFrame:
    """Customers' totals, from states that two loads have added to."""
    return customers.ranked_customers(_sales_states(wh).customer_totals())


@query
def an_country_customers_kept(wh: Warehouse) -> DataFrame:
    """Distinct customers per country, from bitmaps that two loads have added to."""
    return _sales_states(wh).customers_per_country()


@query
def op_update_from(wh: Warehouse) -> DataFrame:
    """List prices replaced by the highest price a track was sold at; unsold tracks keep theirs."""
    prices = wh.track("trackid", "unitprice")
    return update_from(prices, wh.invoiceline("track_id", "unitprice"), {"trackid": "track_id"}, ["unitprice"])


@query
def op_semi_join(wh: Warehouse) -> DataFrame:
    """Tracks sold at least once."""
    return semi_join(wh.track("trackid", "track_name"), wh.invoiceline("track_id"), {"trackid": "track_id"})


@query
def op_anti_join(wh: Warehouse) -> DataFrame:
    """Tracks never sold."""
    return anti_join(wh.track("trackid", "track_name"), wh.invoiceline("track_id"), {"trackid": "track_id"})


@query
def op_track_popularity(wh: Warehouse) -> DataFrame:
    return recommend.track_popularity(
        wh.customer("customerid"),
        wh.invoice("invoiceid", "customerid"),
        wh.invoiceline("invoice_id", "track_id"),
        wh.track("trackid", "track_name", "genre_name"),
    )


@query
def op_head_rest_split(wh: Warehouse) -> DataFrame:
    """The first invoices at the day's rate, all others at the default rate."""
    invoices = wh.staging.invoice().select("invoiceid", "invoicedate", "total")
    head, rest = head_rest_split(invoices, HEAD_ROWS, "invoicedate", key="invoiceid")
    return union_all(convert(head, wh.staging.rates()), convert_at_default(rest)).drop("rate_is_default")


# ---- analyses of playlists and tracks


@query
def an_playlist_count_stats(wh: Warehouse) -> DataFrame:
    return playlists.count_stats(wh.playlist())


@query
def an_playlist_extremes(wh: Warehouse) -> DataFrame:
    return playlists.extremes(wh.playlist())


@query
def an_playlist_breakdown(wh: Warehouse) -> DataFrame:
    return playlists.breakdown(
        wh.playlist(), wh.track("trackid", "genre_name", "mediatype_name"), wh.invoiceline("track_id")
    )


@query
def an_track_sales_buckets(wh: Warehouse) -> DataFrame:
    return tracks.sales_tiers(wh.track("trackid"), wh.invoiceline("track_id"))


@query
def an_top_artists_by_albums(wh: Warehouse) -> DataFrame:
    return tracks.top_by_distinct(wh.track("artist_name", "albumid"), "artist_name", "albumid", "total_albums")


@query
def an_top_artists_by_tracks(wh: Warehouse) -> DataFrame:
    return tracks.top_by_distinct(wh.track("artist_name", "trackid"), "artist_name", "trackid", "total_tracks")


@query
def an_top_genres_by_tracks(wh: Warehouse) -> DataFrame:
    return tracks.top_by_distinct(wh.track("genre_name", "trackid"), "genre_name", "trackid", "total_tracks")


def _track_sales(wh: Warehouse) -> tuple[DataFrame, DataFrame]:
    return wh.track("trackid", "track_duration"), wh.invoiceline("track_id", "unitprice")


@query
def an_duration_sales(wh: Warehouse) -> DataFrame:
    return tracks.duration_sales(*_track_sales(wh))


@query
def an_duration_line(wh: Warehouse) -> DataFrame:
    return tracks.duration_line(*_track_sales(wh))


@query
def an_duration_ticks(wh: Warehouse) -> DataFrame:
    return tracks.duration_ticks(*_track_sales(wh))


# ---- analyses of countries, customers and employees


@query
def an_country_tiers(wh: Warehouse) -> DataFrame:
    return countries.country_tiers(wh.invoice("billingcountry", "total"))


@query
def an_country_genre_share(wh: Warehouse) -> DataFrame:
    return countries.genre_share(
        wh.invoice("invoiceid", "billingcountry", "total"),
        wh.invoiceline("invoice_id", "track_id", "unitprice"),
        wh.track("trackid", "genre_name"),
    )


@query
def an_country_customer_summary(wh: Warehouse) -> DataFrame:
    return countries.customer_summary(
        wh.customer("customerid", "country"), wh.invoice("invoiceid", "customerid", "total")
    )


@query
def an_top_countries(wh: Warehouse) -> DataFrame:
    return countries.top_countries(wh.invoice("billingcountry", "total"))


@query
def an_manager_share(wh: Warehouse) -> DataFrame:
    return countries.manager_share(
        wh.invoice("customerid", "billingcountry", "total"),
        wh.customer("customerid", "country", "supportrepid"),
        wh.employee("employeeid", "is_manager"),
    )


@query
def an_customer_totals(wh: Warehouse) -> DataFrame:
    totals = customers.customer_totals(wh.invoice("customerid", "invoicedate"), wh.currencies())
    return customers.ranked_customers(totals)


@query
def an_top_customers(wh: Warehouse) -> DataFrame:
    totals = customers.customer_totals(wh.invoice("customerid", "invoicedate"), wh.currencies())
    return customers.top_customers(totals, wh.customer("customerid", "firstname", "lastname"))


@query
def an_monthly_sales(wh: Warehouse) -> DataFrame:
    return customers.monthly_sales(wh.invoice("invoicedate", "total"))


@query
def an_employee_growth(wh: Warehouse) -> DataFrame:
    return employees.employee_growth(
        wh.employee("employeeid", "firstname", "lastname", "years_employed"),
        wh.customer("customerid", "supportrepid"),
        wh.invoice("customerid", "invoicedate", "total"),
    )


@query
def an_recommendations(wh: Warehouse) -> DataFrame:
    return recommend.recommend(
        wh.customer("customerid"),
        wh.invoice("invoiceid", "customerid"),
        wh.invoiceline("invoice_id", "track_id"),
        wh.track("trackid", "track_name", "genre_name"),
    )
