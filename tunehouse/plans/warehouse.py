"""Dimensions and facts of the star schema.

Each build takes staging DataFrames. ``columns`` narrows the result; a look-up
that feeds none of the wanted columns is then not joined at all. All look-up
tables are unique on their key, so leaving out such a left join changes no row.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunehouse.functions.dates import completed_years
from tunehouse.functions.numbers import round_to_int
from tunehouse.functions.text import capitalize_first, email_domain, minutes_seconds, seconds_of
from tunehouse.operators.joins import flag_member
from tunehouse.plans.currencies import dim_currencies
from tunehouse.schemas import (
    CUSTOMER_EXTRA,
    DIM_PLAYLIST,
    DIM_TRACK,
    EMPLOYEE_EXTRA,
    FACT_INVOICE,
    FACT_INVOICELINE,
    clone_schema,
    conform,
)
from tunehouse.sinks.tables import delete_where

GENRE_COLUMNS = frozenset({"genreid", "genre_name", "genre_last_update"})
MEDIA_COLUMNS = frozenset({"mediatypeid", "mediatype_name", "mediatype_last_update"})
ALBUM_COLUMNS = frozenset({"albumid", "album_name", "album_last_update"})
ARTIST_COLUMNS = frozenset({"artistid", "artist_name", "artist_last_update"})
REPEATED_PLAYLISTS = (8, 10)  # fixed value: ids whose name another playlist already has


def dim_playlist(
    playlisttrack: DataFrame, playlist: DataFrame, drop_ids: tuple[int, ...] = REPEATED_PLAYLISTS
) -> DataFrame:
    """One row per playlist and track; playlists without a track do not occur."""
    bridge = playlisttrack
    if drop_ids:
        bridge = delete_where(bridge, F.col("playlistid").isin(*drop_ids))
    names = playlist.select("playlistid", F.col("name").alias("playlist_name"))
    rows = bridge.join(names, "playlistid", "left").withColumnsRenamed(
        {"playlistid": "playlist_id", "trackid": "track_id"}
    )
    return conform(rows, DIM_PLAYLIST)


def dim_customer(customer: DataFrame, columns: tuple[str, ...] = ()) -> DataFrame:
    """All staging columns, names in sentence case, and the e-mail domain."""
    rows = customer.withColumns(
        {
            "firstname": capitalize_first(F.col("firstname")),
            "lastname": capitalize_first(F.col("lastname")),
            "email_domain": email_domain(F.col("email")),
        }
    )
    return conform(rows, clone_schema(customer.schema, CUSTOMER_EXTRA), columns)


def needs_department(columns: tuple[str, ...]) -> bool:
    return not columns or bool({"department_name", "department_budget"} & set(columns))


def needs_invoice(columns: tuple[str, ...]) -> bool:
    return not columns or "line_total" in columns


def dim_employee(
    employee: DataFrame, department: DataFrame | None, as_of: datetime.date, columns: tuple[str, ...] = ()
) -> DataFrame:
    """All staging columns plus department, years employed, manager flag and e-mail domain."""
    rows = employee
    if needs_department(columns):
        lookup = department.select(
            F.col("department_id").alias("departmentid"),
            "department_name",
            round_to_int(F.col("budget")).alias("department_budget"),
        )
        rows = rows.join(lookup, "departmentid", "left")
    if not columns or "is_manager" in columns:
        rows = flag_member(rows, employee, {"employeeid": "reportsto"}, "is_manager")
    rows = rows.withColumns(
        {
            "years_employed": completed_years(F.col("hiredate"), as_of).cast("string"),
            "email_domain": email_domain(F.col("email")),
        }
    )
    return conform(rows, clone_schema(employee.schema, EMPLOYEE_EXTRA), columns)


def dim_track(
    track: DataFrame,
    genre: DataFrame | None = None,
    mediatype: DataFrame | None = None,
    album: DataFrame | None = None,
    artist: DataFrame | None = None,
    columns: tuple[str, ...] = (),
) -> DataFrame:
    """Tracks with genre, media type, album and the album's artist in one row.

    The look-up's own key is taken over, so a key it does not know becomes NULL.
    A look-up that ``columns`` does not need may be left out.
    """

    def wants(names: frozenset[str]) -> bool:
        return not columns or bool(names & set(columns))

    rows = track.withColumnsRenamed(
        {"name": "track_name", "genreid": "_genre", "mediatypeid": "_media", "albumid": "_album"}
    )
    if wants(GENRE_COLUMNS):
        lookup = genre.select(
            "genreid", F.col("name").alias("genre_name"), F.col("last_update").alias("genre_last_update")
        )
        rows = rows.join(lookup, F.col("_genre") == F.col("genreid"), "left")
    if wants(MEDIA_COLUMNS):
        lookup = mediatype.select(
            "mediatypeid", F.col("name").alias("mediatype_name"), F.col("last_update").alias("mediatype_last_update")
        )
        rows = rows.join(lookup, F.col("_media") == F.col("mediatypeid"), "left")
    by_artist = wants(ARTIST_COLUMNS)
    if by_artist or wants(ALBUM_COLUMNS):
        lookup = album.select(
            "albumid",
            F.col("title").alias("album_name"),
            F.col("last_update").alias("album_last_update"),
            F.col("artistid").alias("_artist"),
        )
        rows = rows.join(lookup, F.col("_album") == F.col("albumid"), "left")
    if by_artist:
        lookup = artist.select(
            "artistid", F.col("name").alias("artist_name"), F.col("last_update").alias("artist_last_update")
        )
        rows = rows.join(lookup, F.col("_artist") == F.col("artistid"), "left")
    rows = rows.withColumns(
        {"seconds": seconds_of(F.col("milliseconds")), "track_duration": minutes_seconds(F.col("milliseconds"))}
    )
    return conform(rows, DIM_TRACK, columns)


def fact_invoice(invoice: DataFrame, columns: tuple[str, ...] = ()) -> DataFrame:
    """Invoices; the timestamp becomes a DATE."""
    return conform(invoice, FACT_INVOICE, columns)


def fact_invoiceline(
    invoiceline: DataFrame, invoice: DataFrame | None, columns: tuple[str, ...] = ()
) -> DataFrame:
    """Invoice lines. ``line_total`` repeats the invoice's total on each line: never add it up."""
    rows = invoiceline.withColumnsRenamed(
        {"invoicelineid": "invoiceline_id", "invoiceid": "invoice_id", "trackid": "track_id"}
    )
    if needs_invoice(columns):
        totals = invoice.select(F.col("invoiceid").alias("invoice_id"), F.col("total").alias("line_total"))
        rows = rows.join(totals, "invoice_id", "left")
    return conform(rows, FACT_INVOICELINE, columns)


class Warehouse:
    """Dimensions and facts over a staging object, built lazily and only as wide as asked for."""

    def __init__(self, staging, as_of: datetime.date):
        self.staging = staging
        self.as_of = as_of

    def playlist(self, *columns: str, drop_ids: tuple[int, ...] = REPEATED_PLAYLISTS) -> DataFrame:
        return dim_playlist(self.staging.playlisttrack(), self.staging.playlist(), drop_ids).select(*(columns or "*"))

    def customer(self, *columns: str) -> DataFrame:
        return dim_customer(self.staging.customer(), columns)

    def employee(self, *columns: str) -> DataFrame:
        department = self.staging.department() if needs_department(columns) else None
        return dim_employee(self.staging.employee(), department, self.as_of, columns)

    def track(self, *columns: str) -> DataFrame:
        s, wanted = self.staging, set(columns)
        genre = not columns or bool(wanted & GENRE_COLUMNS)
        media = not columns or bool(wanted & MEDIA_COLUMNS)
        artist = not columns or bool(wanted & ARTIST_COLUMNS)
        album = artist or bool(wanted & ALBUM_COLUMNS)
        track = s.track((("genreid",) if genre else ()) + (("albumid",) if album else ()))
        return dim_track(
            track,
            s.genre() if genre else None,
            s.mediatype() if media else None,
            s.album() if album else None,
            s.artist() if artist else None,
            columns,
        )

    def invoice(self, *columns: str) -> DataFrame:
        return fact_invoice(self.staging.invoice(), columns)

    def invoiceline(self, *columns: str) -> DataFrame:
        invoice = self.staging.invoice() if needs_invoice(columns) else None
        return fact_invoiceline(self.staging.invoiceline(), invoice, columns)

    def currencies(self, *columns: str) -> DataFrame:
        return dim_currencies(self.staging.invoice(), self.staging.rates()).select(*(columns or "*"))
