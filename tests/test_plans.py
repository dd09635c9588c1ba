"""Builds and analyses on a few literal rows, chosen for what the test tables do not hold."""

import datetime
import os
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from tunehouse import session
from tunehouse.plans import checks, countries, customers, departments, employees, jobs, playlists, recommend, tracks, warehouse
from tunehouse.plans.currencies import convert, currencies
from tunehouse.plans.departments import department_budgets
from tunehouse.sources.rates import read_rate_responses, response_counts
from tunehouse.sources.tables import StagingTables

DAY = datetime.datetime


def table(spark, ddl, *data):
    return spark.createDataFrame(list(data), ddl)


# ---- warehouse builds


def test_department_groups_drop_null_names_and_unknown_ids(spark):
    deps = table(spark, "department_id bigint, department_name string", (1, "a"), (2, None), (3, "c"))
    budgets = table(spark, "department_id bigint, budget bigint", (1, 5), (1, 6), (2, 1), (3, None), (9, 9))
    assert rows(department_budgets(deps, budgets)) == [(1, "a", Decimal("11.00")), (3, "c", Decimal("0.00"))]


def test_playlist_without_tracks_does_not_load_and_repeats_are_dropped(spark):
    bridge = table(spark, "playlistid bigint, trackid bigint, last_update date", (1, 7, None), (8, 7, None), (5, 3, None), (None, 4, None))
    lists = table(spark, "playlistid bigint, name string", (1, "Music"), (8, "Music"), (9, "Empty"))
    got = warehouse.dim_playlist(bridge, lists)
    assert rows(got.drop("last_update")) == [(1, "Music", 7), (5, None, 3), (None, None, 4)]
    assert warehouse.dim_playlist(bridge, lists, drop_ids=()).count() == 4


def test_customer_clone_keeps_all_columns(spark):
    staged = table(spark, "customerid bigint, firstname string, lastname string, email string, phone string", (1, "mary ANN", "o'NEIL", "x@y.z", "5"))
    got = warehouse.dim_customer(staged)
    assert got.columns == [*staged.columns, "email_domain"]
    assert rows(got) == [(1, "Mary ann", "O'neil", "x@y.z", "5", "@y.z")]


def test_employee_flags_budget_and_years(spark):
    staged = table(
        spark,
        "employeeid bigint, reportsto bigint, departmentid bigint, hiredate date, email string",
        (1, None, 1, datetime.date(2020, 2, 29), "a@b"),
        (2, 1, 9, datetime.date(2020, 6, 1), None),
    )
    deps = table(spark, "department_id bigint, department_name string, budget decimal(38,2)", (1, "IT", Decimal("2.50")))
    got = warehouse.dim_employee(staged, deps, datetime.date(2023, 2, 28))
    picked = got.select("employeeid", "department_name", "department_budget", "years_employed", "is_manager", "email_domain")
    assert rows(picked) == [(1, "IT", 3, "2", 1, "@b"), (2, None, None, "2", 0, None)]
    assert got.columns[:5] == staged.columns


def test_track_look_ups_keep_every_track(spark):
    staged = table(
        spark,
        "trackid bigint, name string, albumid bigint, mediatypeid bigint, genreid bigint, composer string, "
        "milliseconds int, unitprice decimal(10,2), last_update date",
        (1, "t", 1, 1, 1, None, 61_500, Decimal("0.99"), None),
        (2, "u", 9, None, 9, "c", None, Decimal("1.99"), None),
    )
    name = "name string, last_update date"
    genre = table(spark, f"genreid bigint, {name}", (1, "Rock", None))
    media = table(spark, f"mediatypeid bigint, {name}", (1, "CD", None))
    album = table(spark, "albumid bigint, title string, artistid bigint, last_update date", (1, "A", 4, None))
    artist = table(spark, f"artistid bigint, {name}", (4, "Z", None))
    got = warehouse.dim_track(staged, genre, media, album, artist)
    picked = got.select("trackid", "genreid", "genre_name", "mediatype_name", "album_name", "artist_name", "seconds", "track_duration")
    assert rows(picked) == [(1, 1, "Rock", "CD", "A", "Z", 61, "01:01"), (2, None, None, None, None, None, None, ":")]
    assert rows(got.select("trackid", "unitprice")) == [(1, Decimal("0.99")), (2, Decimal("1.99"))]
    assert warehouse.dim_track(staged, columns=("trackid", "composer")).columns == ["trackid", "composer"]


def test_line_total_is_the_invoice_total_and_orphans_stay(spark):
    lines = table(spark, "invoicelineid bigint, invoiceid bigint, trackid bigint, unitprice decimal(10,2), quantity int, last_update date",
                  (1, 1, 1, Decimal("1.00"), 2, None), (2, 1, 2, Decimal("1.00"), 1, None), (3, 9, 1, Decimal("1.00"), 1, None))
    invoices = table(spark, "invoiceid bigint, total decimal(10,2)", (1, Decimal("7.00")))
    got = warehouse.fact_invoiceline(lines, invoices).select("invoiceline_id", "line_total")
    assert rows(got) == [(1, Decimal("7.00")), (2, Decimal("7.00")), (3, None)]


# ---- currencies

INVOICE = "invoiceid bigint, customerid bigint, invoicedate timestamp_ntz, total decimal(10,2)"
RATES = "rate_date date, usd_pln double, ils_pln double"


def test_missing_rate_takes_the_default(spark):
    invoices = table(spark, INVOICE, (1, 1, DAY(2024, 5, 2, 13), Decimal("10.00")), (2, 1, DAY(2024, 5, 3), Decimal("10.00")), (3, 1, None, None))
    rates = table(spark, RATES, (datetime.date(2024, 5, 2), 4.0, 1.25), (datetime.date(2024, 5, 3), 4.0, None))
    got = {r.invoiceid: (r.ils_price, r.rate_is_default) for r in convert(invoices, rates).collect()}
    assert got == {1: (32.0, False), 2: (10 * 3.56, True), 3: (None, False)}
    assert currencies(invoices, rates).columns == ["purchase_date", "usd_price", "ils_price"]


def test_customer_totals_count_every_pair_of_a_day(spark):
    fact = table(spark, "customerid bigint, invoicedate date",
                 (1, datetime.date(2024, 1, 1)), (2, datetime.date(2024, 1, 1)), (2, datetime.date(2024, 1, 1)), (None, datetime.date(2024, 1, 1)), (3, datetime.date(2024, 1, 9)))
    money = table(spark, "purchase_date timestamp_ntz, usd_price double, ils_price double",
                  (DAY(2024, 1, 1), 10.0, 30.0), (DAY(2024, 1, 1), 5.0, None), (DAY(2024, 1, 1, 9), 99.0, 99.0))
    got = [(a, float(b), float(c)) for a, b, c in rows(customers.customer_totals(fact, money))]
    assert got == [(1, 15.0, 30.0), (2, 30.0, 60.0)]


def test_totals_per_invoice_are_not_inflated(spark):
    fact = table(spark, INVOICE, (1, 1, DAY(2024, 1, 1), Decimal("10.00")), (2, 2, DAY(2024, 1, 1), Decimal("5.00")))
    got = customers.customer_totals_per_invoice(fact, table(spark, RATES))
    assert [(a, float(b), float(c)) for a, b, c in rows(got)] == [(1, 10.0, 35.6), (2, 5.0, 17.8)]


def test_ranked_customers_are_in_order(spark):
    totals = table(spark, "customerid bigint, usd_price decimal(38,6)", (3, Decimal(1)), (2, Decimal(5)), (1, Decimal(1)))
    assert [r.customerid for r in customers.ranked_customers(totals).collect()] == [2, 1, 3]


def test_top_customers_are_those_with_a_name(spark):
    totals = table(spark, "customerid bigint, usd_price decimal(38,6), ils_price decimal(38,6)", *[(i, Decimal(10 - i), Decimal(1)) for i in range(8)])
    names = table(spark, "customerid bigint, firstname string, lastname string", *[(i, "F", str(i)) for i in range(1, 8)])
    got = [r.customer_name for r in customers.top_customers(totals, names).collect()]
    assert got == ["F 1", "F 2", "F 3", "F 4", "F 5"]


# ---- countries

FACT = "invoiceid bigint, customerid bigint, billingcountry string, total decimal(10,2)"


def sales(spark, *countries_and_totals):
    return table(spark, FACT, *[(i, i, c, Decimal(t)) for i, (c, t) in enumerate(countries_and_totals)])


def test_few_countries_are_in_both_tiers_and_null_is_a_country(spark):
    fact = sales(spark, ("a", "3.00"), ("b", "2.00"), (None, "1.00"))
    got = [(r.country_tier, r.country) for r in countries.country_tiers(fact).collect()]
    assert got == [("Top", "a"), ("Top", "b"), ("Top", None), ("Bottom", None), ("Bottom", "b"), ("Bottom", "a")]
    assert [r.country for r in countries.top_countries(fact).collect()] == ["a", "b"]


def test_genre_share_doubles_a_country_in_both_tiers(spark):
    fact = sales(spark, ("a", "8.00"), (None, "1.00"))
    lines = table(spark, "invoice_id bigint, track_id bigint, unitprice decimal(10,2)", (0, 1, Decimal("1.00")), (0, 2, Decimal("3.00")), (1, 1, Decimal("1.00")))
    dims = table(spark, "trackid bigint, genre_name string", (1, "Rock"), (2, "Jazz"))
    assert rows(countries.genre_share(fact, lines, dims)) == [
        ("a", 1, "Rock", "25.00%"),
        ("a", 2, "Jazz", "75.00%"),
        (None, 1, None, None),
    ]


def test_invoice_without_lines_is_a_line_without_genre(spark):
    fact = sales(spark, ("a", "8.00"), ("a", "2.00"), ("b", "1.00"))
    lines = table(spark, "invoice_id bigint, track_id bigint, unitprice decimal(10,2)", (0, 1, Decimal("1.00")), (0, 9, Decimal("2.00")))
    dims = table(spark, "trackid bigint, genre_name string", (1, "Rock"))
    assert rows(countries.genre_share(fact, lines, dims, k=1)) == [("a", 1, "Rock", "10.00%"), ("a", 2, None, "20.00%"), ("b", 1, None, None)]


def test_single_customer_countries_fold_into_other(spark):
    people = table(spark, "customerid bigint, country string", (1, "a"), (2, "a"), (3, "b"), (4, "c"))
    fact = table(spark, FACT, *[(i, c, None, Decimal("1.00")) for i, c in enumerate([1, 1, 2, 2, 2, 3, 3, 3])])
    got = [(a, b, c, float(d)) for a, b, c, d in rows(countries.customer_summary(people, fact))]
    assert got == [("Other", 2, 1, 1.5), ("a", 2, 2, 2.5)]


def test_other_is_there_without_any_single_customer(spark):
    people = table(spark, "customerid bigint, country string", (1, "a"), (2, "a"))
    got = rows(countries.customer_summary(people, sales(spark)))
    assert got == [("Other", None, None, None), ("a", 2, 0, None)]


def test_manager_share_uses_the_customers_country(spark):
    fact = table(spark, FACT, (1, 1, "a", Decimal("3.00")), (2, 2, "a", Decimal("1.00")), (3, 3, "b", Decimal("1.00")), (4, 1, None, Decimal("9.00")))
    people = table(spark, "customerid bigint, country string, supportrepid bigint", (1, "b", 1), (2, "b", 2), (4, "a", 1), (5, None, 1))
    staff = table(spark, "employeeid bigint, is_manager int", (1, 1), (2, 0), (3, 1))
    got = [tuple(r) for r in countries.manager_share(fact, people, staff).collect()]
    assert got == [("a", Decimal("4.00"), Decimal("0.00"), 0.0), ("b", Decimal("1.00"), Decimal("12.00"), 1200.0)]


def test_months_without_date_drop_out(spark):
    fact = table(spark, "invoicedate date, total decimal(10,2)", (datetime.date(2024, 2, 1), Decimal("1.00")), (datetime.date(2024, 2, 9), None), (None, Decimal("5.00")))
    assert rows(customers.monthly_sales(fact)) == [(2024, 2, Decimal("1.00"))]


# ---- employees


def growth(spark, **options):
    staff = table(spark, "employeeid bigint, firstname string, lastname string, years_employed string", (1, "A", "B", "4"), (2, "C", "D", "1"))
    people = table(spark, "customerid bigint, supportrepid bigint", (1, 1), (2, 1), (3, 1))
    fact = table(
        spark, "customerid bigint, invoicedate date, total decimal(10,2)",
        (1, datetime.date(2020, 1, 1), Decimal("0.00")), (1, datetime.date(2022, 1, 1), Decimal("4.00")),
        (1, datetime.date(2022, 2, 1), Decimal("4.00")), (2, datetime.date(2023, 1, 1), Decimal("7.00")),
    )
    got = employees.employee_growth(staff, people, fact, **options)
    return sorted((tuple(r)[0:1] + tuple(r)[3:] for r in got.collect()), key=repr)


def test_growth_is_against_the_previous_row(spark):
    assert growth(spark) == [
        (1, 2020, 1, None),
        (1, 2022, 2, None),  # nothing to divide by: the year before sold 0.00
        (1, 2023, 1, "-12.50%"),
        (1, None, 1, None),  # the customer without invoices
        (2, None, 0, None),
    ]


def test_distinct_customers_option(spark):
    assert [r[2] for r in growth(spark, distinct_customers=True)] == [1, 1, 1, 1, 0]


# ---- playlists and tracks

PLAYLIST = "playlist_id bigint, playlist_name string, track_id bigint"


def test_same_named_playlists_merge_and_ties_multiply(spark):
    lists = table(spark, PLAYLIST, (1, "M", 1), (2, "M", 2), (3, "N", 9), (3, "N", 1))
    dims = table(spark, "trackid bigint, genre_name string, mediatype_name string", (1, "Rock", "CD"), (2, "Jazz", "LP"))
    lines = table(spark, "track_id bigint", (1,), (1,), (1,), (9,))
    assert rows(playlists.track_counts(lists)) == [("M", 2), ("N", 2)]
    assert rows(playlists.breakdown(lists, dims, lines)) == [
        ("M", "75%", "Jazz", "CD"),
        ("M", "75%", "Jazz", "LP"),
        ("M", "75%", "Rock", "CD"),
        ("M", "75%", "Rock", "LP"),
        ("N", "100%", "Rock", "CD"),
    ]


def test_null_genre_leads_only_alone(spark):
    lists = table(spark, PLAYLIST, (1, "M", 1))
    dims = table(spark, "trackid bigint, genre_name string, mediatype_name string", (1, None, "CD"))
    assert rows(playlists.breakdown(lists, dims, table(spark, "track_id bigint"))) == [("M", "0%", None, "CD")]


def test_empty_tiers_have_no_row(spark):
    dims = table(spark, "trackid bigint", (1,), (2,), (3,))
    lines = table(spark, "track_id bigint", *[(1,)] * 10, *[(2,)] * 9, (7,))
    assert rows(tracks.sales_tiers(dims, lines)) == [(1, 1), (2, 1), (4, 1)]


def test_artist_without_albums_counts_zero(spark):
    dims = table(spark, "artist_name string, albumid bigint", ("a", None), ("b", 1), ("b", 1), (None, 5))
    assert rows(tracks.top_by_distinct(dims, "artist_name", "albumid", "n")) == [("a", 0), ("b", 1)]


def test_ticks_equal_every_nth_row(spark):
    rng = random.Random(3)
    dims = [(i, f"{rng.choice([0, 0, 0, 1, 2]):02d}:{rng.randint(0, 2):02d}") for i in range(500)]
    lines = [(rng.randint(0, 520), Decimal("1.00")) for _ in range(700)]
    args = table(spark, "trackid bigint, track_duration string", *dims), table(spark, "track_id bigint, unitprice decimal(10,2)", *lines)
    ordered = [r.track_duration for r in tracks.duration_sales(*args).collect()]
    assert ordered == sorted(ordered)
    assert sorted(r.track_duration for r in tracks.duration_ticks(*args, stride=35).collect()) == ordered[::35]
    line = {r.track_duration: r.n for r in tracks.duration_line(*args).collect()}
    assert sum(line.values()) == len(ordered)


# ---- recommendations


def offer(bought, names, order="track_id", n_genres=2, per_genre=3, fill=False):
    """Brute force: every customer against every ordered track."""
    popular, result = {}, set()
    for _, t in bought:
        popular[t] = popular.get(t, 0) + 1
    for customer in {c for c, _ in bought}:
        mine = [t for c, t in bought if c == customer]
        count = {}
        for t in mine:
            if names.get(t):
                count[names[t]] = count.get(names[t], 0) + 1
        best = sorted(count, key=lambda g: (-count[g], g))[:n_genres]
        take = per_genre * n_genres if fill and len(best) == 1 else per_genre
        for genre in best:
            new = [t for t in popular if names.get(t) == genre and t not in mine]
            new.sort(key=lambda t: (-popular[t], t) if order == "popularity" else t)
            result |= {(customer, t, genre) for t in new[:take]}
    return result


@pytest.fixture(scope="module")
def shop(spark):
    """Customer 0 owns nearly all, 1 exactly the first tracks, 2 one genre only, 3 nothing."""
    rng = random.Random(11)
    names = {t: "Rock" if t % 3 else rng.choice(["Jazz", "Folk", None]) for t in range(400)}
    rock = sorted(t for t in names if names[t] == "Rock")
    bought = [(0, t) for t in names if t % 50 != 49] + [(0, 5)] * 3
    bought += [(1, t) for t in rock[:100]] + [(2, t) for t in rock[10:20]]
    bought += [(c, rng.randrange(410)) for c in range(4, 30) for _ in range(rng.randint(1, 40))]
    bought += [(99, t) for t in rng.sample(sorted(names), 60)]
    known = [(c, t) for c, t in bought if c != 99]
    rng.shuffle(bought)
    frames = (
        table(spark, "customerid bigint", *[(c,) for c in range(30)]),
        table(spark, "invoiceid bigint, customerid bigint", *[(i, c) for i, (c, _) in enumerate(bought)]),
        table(spark, "invoice_id bigint, track_id bigint", *[(i, t) for i, (_, t) in enumerate(bought)], (10**6, 1)),
        table(spark, "trackid bigint, track_name string, genre_name string", *[(t, f"t{t}", g) for t, g in names.items()]),
    )
    return known, names, frames


@pytest.mark.parametrize(
    "options",
    [{}, {"order": "popularity"}, {"fill_single_genre": True}, {"n_genres": 1, "per_genre": 80}],
    ids=["default", "popularity", "fill", "beyond the mask"],
)
def test_recommendations_equal_brute_force(shop, options):
    known, names, frames = shop
    got = recommend.recommend(*frames, **options)
    assert all(r.track_name == f"t{r.track_id}" for r in got.collect())
    found = [(r.customerid, r.track_id, r.genre_name) for r in got.collect()]
    force = {("fill" if k == "fill_single_genre" else k): v for k, v in options.items()}
    assert len(found) == len(set(found)) and set(found) == offer(known, names, **force)


@pytest.mark.parametrize("customer", [0, 1, 2, 3, 12])
def test_recommendations_for_one_customer(shop, customer):
    known, names, frames = shop
    got = recommend.recommend(*frames, customer_id=customer)
    assert {(r.customerid, r.track_id, r.genre_name) for r in got.collect()} == {o for o in offer(known, names) if o[0] == customer}


def test_unknown_order_is_refused(shop):
    with pytest.raises(ValueError):
        recommend.recommend(*shop[2], order="random")


def test_popularity_counts_known_customers_only(shop):
    known, names, frames = shop
    got = {r.track_id: r.total_track_orders for r in recommend.track_popularity(*frames).collect()}
    expect = {}
    for _, t in known:
        if t in names:
            expect[t] = expect.get(t, 0) + 1
    assert got == expect


# ---- checks


def test_checks_find_repeated_and_missing_keys(spark):
    df = table(spark, "k int, v string", (1, "a"), (1, "b"), (1, None), (None, "c"))
    got = dict(rows(checks.check_keys({"t": (df, ["k"], ["k", "v"])})))
    assert got == {"t: unique k": 2, "t: k not null": 1, "t: v not null": 1}
    long = dict(rows(checks.check_table(table(spark, "k int, v string", (1, "abc"), (2, "ab"), (3, None)), "t", ["k"], [], {"v": 2})))
    assert long == {"t: unique k": 0, "t: v at most 2 characters": 1}
    assert dict(rows(checks.check_keys({"t": (df.limit(0), ["k"], ["k"])}))) == {"t: unique k": 0, "t: k not null": 0}


def test_load_counts(spark):
    five, none = spark.range(5), spark.range(0)
    other = T.StructType([T.StructField("id", T.StringType()), T.StructField("more", T.LongType())])
    tables = {
        "a": (five, spark.range(3), five.schema),
        "b": (none, none, none.schema),
        "c": (five, spark.range(7), five.schema),
        "d": (five, five, other),
    }
    assert rows(checks.check_load_counts(tables)) == [("a", 5, 3, 2), ("b", 0, 0, 0), ("c", 5, 7, 2), ("d", 5, 5, 2)]


def test_one_scan_per_checked_table(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(5).selectExpr("id as k", "string(id) as v").write.parquet(path)
    df = checks.check_table(spark.read.parquet(path), "t", ["k"], ["k", "v"], {"v": 1})
    df.collect()
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan") <= 2  # the final and the initial plan
    assert df._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 1


# ---- exact shares


def test_genre_of_a_refunded_country_ranks_by_share(spark):
    invoices = table(spark, "invoiceid bigint, billingcountry string, total decimal(10,2)", (1, "A", Decimal("-100.00")))
    lines = table(
        spark, "invoice_id bigint, track_id bigint, unitprice decimal(10,2)", (1, 1, Decimal(20)), (1, 2, Decimal(60))
    )
    tracks = table(spark, "trackid bigint, genre_name string", (1, "rock"), (2, "jazz"))
    got = rows(countries.genre_share(invoices, lines, tracks))
    # in both tiers, so doubled
    assert got == [("A", 1, "jazz", "-120.00%"), ("A", 2, "rock", "-40.00%")]


def test_genre_share_reads_the_lines_once(spark, tmp_path):
    path = str(tmp_path / "lines")
    spark.range(50).selectExpr("id as invoice_id", "id as track_id", "cast(1 as decimal(10,2)) as unitprice").write.parquet(path)
    invoices = spark.range(60).selectExpr("id as invoiceid", "'A' as billingcountry", "cast(2 as decimal(10,2)) as total")
    tracks = spark.range(50).selectExpr("id as trackid", "'g' as genre_name")
    df = countries.genre_share(invoices, spark.read.parquet(path), tracks)
    assert df._jdf.queryExecution().optimizedPlan().toString().count("parquet") == 1
    assert rows(df) == [("A", 1, "g", "83.33%"), ("A", 2, None, None)]


def test_large_shares_are_rounded_once(spark):
    customers = spark.range(200_000).selectExpr("id as customerid", "'A' as country")
    invoices = table(spark, "invoiceid bigint, customerid bigint, total decimal(12,2)", (1, 5, Decimal("200999.99")))
    assert countries.customer_summary(customers, invoices).filter("country = 'A'").first()["avg_revenue_per_customer"] == Decimal("1.00")


# ---- jobs


def test_unusable_rates_fall_back_to_the_default(spark, tmp_path):
    landed = tmp_path / "responses"
    landed.mkdir()
    (landed / "a.json").write_text(
        '{"rate_date":"2020-01-01","code":"USD","rates":[{"mid":4.0}]}\n'
        '{"rate_date":"2020-01-01","code":"ILS","rates":[{"mid":1.0}]}\n'
        '{"rate_date":"2020-01-02","code":"USD","rates":[{"mid":4.0}]}\n'
        '{"rate_date":"2020-01-02","code":"ILS","rates":[{"mid":0.0}]}\n'
        "404 NotFound\n"
        '{"rate_date":"2020-01-03","code":"USD","rates":[]}\n'
    )
    responses = read_rate_responses(spark, str(landed))
    assert response_counts(responses).first().asDict() == {"responses": 6, "malformed": 1, "without_rate": 2}
    invoices = table(
        spark,
        "invoiceid bigint, invoicedate timestamp_ntz, total decimal(10,2)",
        *((i, datetime.datetime(2020, 1, i), Decimal(10)) for i in (1, 2, 3, 4)),
    )
    stored = jobs.currency_job(invoices, str(landed), str(tmp_path / "csv"), "job_currencies", str(tmp_path / "db"))
    try:
        assert sorted((r["purchase_date"].day, round(r["ils_price"], 6)) for r in stored.collect()) == [
            (1, 40.0), (2, 35.6), (3, 35.6), (4, 35.6)
        ]
        assert rows(spark.table("job_currencies")) == rows(stored)
        header = next(f for f in (tmp_path / "csv").glob("part-*")).read_text().splitlines()[0]
        assert header == "purchase_date,usd_price,ils_price"
    finally:
        spark.sql("DROP TABLE job_currencies")


def test_department_job_feeds_the_employees(spark, fixture_dir, tmp_path):
    files = [os.path.join(fixture_dir, f) for f in ("departments.txt", "budgets.jsonl", "budgets_by_column.json")]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS stg_job LOCATION '{tmp_path / 'stg'}'")
    try:
        stored = jobs.department_job(spark, *files, str(tmp_path / "csv"), "stg_job.department", str(tmp_path / "stg"))
        assert rows(stored) == rows(departments.load_department_budgets(spark, *files))
        staging = StagingTables(spark, lambda name: spark.table(f"stg_job.{name}"))
        assert rows(staging.department()) == rows(stored) and stored.count() > 0
    finally:
        spark.sql("DROP DATABASE stg_job CASCADE")


def test_one_customer_reads_only_its_own_invoices(spark, tmp_path):
    path = str(tmp_path / "invoices")
    spark.range(20).selectExpr("id as invoiceid", "id % 4 as customerid").write.parquet(path)
    lines = spark.range(20).selectExpr("id as invoice_id", "id % 7 as track_id")
    names = spark.range(7).selectExpr("id as trackid", "'t' as track_name", "'g' as genre_name")
    people = spark.range(4).selectExpr("id as customerid")
    before = set(os.listdir(session.own_scratch(spark))) if os.path.isdir(session.own_scratch(spark)) else set()
    df = recommend.recommend(people, spark.read.parquet(path), lines, names, customer_id=2)
    assert "EqualTo(customerid,2)" in df._jdf.queryExecution().executedPlan().toString()
    assert {r["customerid"] for r in df.collect()} == {2}
    after = set(os.listdir(session.own_scratch(spark))) if os.path.isdir(session.own_scratch(spark)) else set()
    assert after == before  # nothing is landed
