"""The music store's staging tables, derived from the test tables.

Every staging table covers the whole of the table it comes from: parts are
tracks, orders are invoices, line items are invoice lines, suppliers are
employees and, by key modulo 18, playlists. Large tables stay plain projections
over the Parquet scan; only the short look-up lists (genre, artist, album, media
type, playlist, department) are landed, so that Catalyst knows their size when it
plans joins.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tunehouse.operators.ranking import with_global_position
from tunehouse.session import land, listing
from tunehouse.sources.tables import read_table


def once(build):
    """Define a frame on first use; later calls get the same lazy frame."""

    @functools.wraps(build)
    def frame(self, *args):
        key = (build.__name__, *args)
        if key not in self._frames:
            self._frames[key] = build(self, *args)
        return self._frames[key]

    return frame


def text(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def day_after(start: str, days: Column) -> Column:
    return F.date_add(F.lit(start).cast("date"), days.cast("int"))


class Staging:
    """Staging tables over one folder of Parquet test tables."""

    _known: dict[tuple[str, SparkSession, str], tuple[tuple, Staging]] = {}

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._frames: dict[tuple, DataFrame] = {}

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> Staging:
        """The staging tables of a folder, defined once per session like views, and anew once its files change."""
        key = (spark.sparkContext.applicationId, spark, sf_dir.rstrip("/"))
        files = listing(spark, sf_dir)
        if key not in cls._known or cls._known[key][0] != files:
            cls._known[key] = (files, cls(spark, sf_dir))
        return cls._known[key][1]

    @once
    def source(self, name: str) -> DataFrame:
        return read_table(self.spark, f"{self.sf_dir}/{name}.parquet")

    # ---- look-up lists

    @once
    def _lookup(self, name: str) -> DataFrame:
        return land(getattr(self, f"_build_{name}")(), name)

    def _numbered(self, distinct: DataFrame, *order: str) -> DataFrame:
        return with_global_position(distinct, *order, name="_at").withColumn("_id", F.col("_at") + 1)

    def _build_genre(self) -> DataFrame:
        names = self._numbered(self.source("part").select("p_type").distinct(), "p_type")
        return names.select(
            F.col("_id").alias("genreid"),
            F.col("p_type").alias("name"),
            day_after("2017-01-01", F.col("_id")).alias("last_update"),
        )

    def _build_artist(self) -> DataFrame:
        names = self._numbered(self.source("part").select("p_brand").distinct(), "p_brand")
        return names.select(
            F.col("_id").alias("artistid"),
            F.col("p_brand").alias("name"),
            day_after("2017-03-01", F.col("_id")).alias("last_update"),
        )

    def _build_album(self) -> DataFrame:
        titles = self._numbered(self.source("part").select("p_brand", "p_size").distinct(), "p_brand", "p_size")
        artists = self.artist().select("artistid", F.col("name").alias("p_brand"))
        return titles.join(artists, "p_brand").select(
            F.col("_id").alias("albumid"),
            F.concat("p_brand", F.lit(" vol "), text("p_size")).alias("title"),
            "artistid",
            day_after("2017-06-01", F.col("_id")).alias("last_update"),
            "p_brand",
            "p_size",
        )

    def _build_mediatype(self) -> DataFrame:
        return (
            self.source("part")
            .select((F.col("p_size") % 5 + 1).cast("bigint").alias("mediatypeid"))
            .distinct()
            .select(
                "mediatypeid",
                F.concat(F.lit("media "), text("mediatypeid")).alias("name"),
                day_after("2017-09-01", F.col("mediatypeid")).alias("last_update"),
            )
        )

    def genre(self) -> DataFrame:
        return self._lookup("genre")

    def artist(self) -> DataFrame:
        return self._lookup("artist")

    def album(self) -> DataFrame:
        return self._lookup("album").drop("p_brand", "p_size")

    def mediatype(self) -> DataFrame:
        return self._lookup("mediatype")

    # ---- tracks and playlists

    @once
    def track(self, keys: tuple[str, ...] = ("genreid", "albumid")) -> DataFrame:
        """``keys`` names the look-up keys that are wanted; each of them needs a join."""
        key = F.col("p_partkey")
        parts = self.source("part")
        columns = [
            key.alias("trackid"),
            F.col("p_name").alias("name"),
            (F.col("p_size") % 5 + 1).cast("bigint").alias("mediatypeid"),
            F.when(key % 11 != 3, F.concat("p_brand", F.lit(" writers"))).alias("composer"),
            F.when(key % 199 == 5, None)
            .when(key % 101 == 0, key % 1000 + 6_000_000)
            .otherwise(key * 3137 % 400_000 + 1000)
            .cast("int")
            .alias("milliseconds"),
            F.col("p_retailprice").cast("decimal(10,2)").alias("unitprice"),
            day_after("2018-01-01", key % 1000).alias("last_update"),
        ]
        if "genreid" in keys:
            parts = parts.join(self.genre().select("genreid", F.col("name").alias("p_type")), "p_type", "left")
            columns.append(F.when(key % 97 != 0, F.col("genreid")).alias("genreid"))
        if "albumid" in keys:
            albums = self._lookup("album").select("albumid", "p_brand", "p_size")
            parts = parts.join(albums, ["p_brand", "p_size"], "left")
            columns.append(F.when(key % 53 != 1, F.col("albumid")).alias("albumid"))
        return parts.select(*columns)

    def playlist(self) -> DataFrame:
        return self._lookup("playlist")

    def _build_playlist(self) -> DataFrame:
        number = F.col("playlistid")
        return (
            self.source("supplier")
            .select((F.col("s_suppkey") % 18 + 1).alias("playlistid"))
            .distinct()
            .select(
                number,
                F.when(number.isin(1, 8), "Music")
                .when(number.isin(3, 10), "TV Shows")
                .otherwise(F.concat(F.lit("Playlist "), text(number)))
                .alias("name"),
            )
        )

    @once
    def playlisttrack(self) -> DataFrame:
        """Playlist n holds tracks whose key is a multiple of n; playlists 12 to 15 stay empty."""
        bucket = F.col("l_suppkey") % 18
        number = F.when(bucket.between(11, 14), bucket - 11).otherwise(bucket) + 1
        return (
            self.source("lineitem")
            .select(number.alias("playlistid"), "l_partkey", F.col("l_shipdate").cast("date").alias("last_update"))
            .groupBy("playlistid", (F.col("l_partkey") - F.col("l_partkey") % F.col("playlistid")).alias("trackid"))
            .agg(F.max("last_update").alias("last_update"))
        )

    # ---- people

    @once
    def customer(self) -> DataFrame:
        key = F.col("c_custkey")
        segment = F.lower("c_mktsegment")
        nations = self.source("nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
        return (
            self.source("customer")
            .join(nations, "c_nationkey")
            .select(
                key.alias("customerid"),
                F.concat(segment, F.lit(" ANN")).alias("firstname"),
                F.upper("c_name").alias("lastname"),
                F.when(key % 50 == 7, "no-at-sign")
                .otherwise(F.concat(F.lit("u"), text(key), F.lit("@"), segment, F.lit(".com")))
                .alias("email"),
                F.when(key % 100 == 0, F.concat(F.lit("SOLO_"), text(key))).otherwise(F.col("n_name")).alias("country"),
                (key % 8 + 3).alias("supportrepid"),
                day_after("2019-01-01", key % 500).alias("last_update"),
            )
        )

    def department(self) -> DataFrame:
        return self._lookup("department")

    def _build_department(self) -> DataFrame:
        """Regions as departments; the budget is the suppliers' balance in the region."""
        by_nation = (
            self.source("supplier")
            .groupBy(F.col("s_nationkey").alias("n_nationkey"))
            .agg(F.sum(F.col("s_acctbal").cast("decimal(12,2)")).alias("budget"))
        )
        by_region = (
            by_nation.join(self.source("nation"), "n_nationkey")
            .groupBy(F.col("n_regionkey").alias("r_regionkey"))
            .agg(F.sum("budget").alias("budget"))
        )
        return by_region.join(self.source("region"), "r_regionkey").select(
            (F.col("r_regionkey") + 1).cast("bigint").alias("department_id"),
            F.col("r_name").alias("department_name"),
            F.col("budget").cast("decimal(38,2)").alias("budget"),
        )

    @once
    def employee(self) -> DataFrame:
        """Suppliers as employees; four managers, and two department ids that do not exist."""
        key = F.col("s_suppkey")
        return self.source("supplier").select(
            (key + 1).alias("employeeid"),
            F.lit("EMP").alias("firstname"),
            F.col("s_name").alias("lastname"),
            F.when(key % 50 == 5, "noat").otherwise(F.concat(F.lower("s_name"), F.lit("@corp.com"))).alias("email"),
            F.concat(F.lit("C"), text(key)).alias("country"),
            F.when(key != 0, key % 4 + 1).alias("reportsto"),
            (key % 7 + 1).alias("departmentid"),
            F.when(key == 2, F.lit("2004-02-29").cast("date"))
            .otherwise(F.make_date((key % 9 + 2002).cast("int"), (key % 12 + 1).cast("int"), F.lit(28)))
            .alias("hiredate"),
            day_after("2019-01-01", key % 300).alias("last_update"),
        )

    # ---- sales

    @once
    def invoice(self) -> DataFrame:
        buyer = F.col("o_custkey")
        return self.source("orders").select(
            F.col("o_orderkey").alias("invoiceid"),
            buyer.alias("customerid"),
            F.col("o_orderdate").alias("invoicedate"),
            F.concat(text(buyer), F.lit(" Main St")).alias("billingaddress"),
            F.concat(F.lit("City "), text(buyer % 200)).alias("billingcity"),
            F.when(buyer % 3 != 0, F.concat(F.lit("S"), text(buyer % 50))).alias("billingstate"),
            F.when(buyer % 149 == 7, None)
            .when(buyer % 100 == 0, F.concat(F.lit("SOLO_"), text(buyer)))
            .otherwise(F.concat(F.lit("NATION_"), text(buyer * 7 % 25)))
            .alias("billingcountry"),
            F.concat(F.lit("P"), text(buyer % 9000 + 1000)).alias("billingpostalcode"),
            F.col("o_totalprice").cast("decimal(10,2)").alias("total"),
            F.col("o_orderdate").cast("date").alias("last_update"),
        )

    @once
    def invoiceline(self) -> DataFrame:
        """All line items. Twelve neighbouring parts share their sales unevenly.

        The later a part stands in its dozen, the more of its lines stay with
        it; the others go to the dozen's first part. So there are very popular,
        rarely sold and unsold tracks.
        """
        part, place = F.col("l_partkey"), F.col("l_partkey") % 12
        return self.source("lineitem").select(
            (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("invoicelineid"),
            F.col("l_orderkey").alias("invoiceid"),
            F.when(F.col("l_orderkey") % 30 < place, part).otherwise(part - place).alias("trackid"),
            F.col("l_extendedprice").cast("decimal(10,2)").alias("unitprice"),
            F.col("l_quantity").cast("int").alias("quantity"),
            F.col("l_shipdate").cast("date").alias("last_update"),
        )

    # ---- exchange rates

    @once
    def rates(self) -> DataFrame:
        """One row per invoice day, at most one per calendar day; none are published at weekends."""
        day = F.col("rate_date")
        of_month = F.dayofmonth(day)
        return (
            self.source("orders")
            .select(F.to_date("o_orderdate").alias("rate_date"))
            .distinct()
            .filter(F.weekday(day) < 5)
            .select(
                day,
                ((F.lit(3500) + of_month % 10 * 50).cast("double") / 1000.0).alias("usd_pln"),
                ((F.lit(1000) + of_month % 4 * 20).cast("double") / 1000.0).alias("ils_pln"),
            )
        )
