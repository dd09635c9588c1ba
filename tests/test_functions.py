"""Scalar expressions at their awkward values."""

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tunehouse.functions import dates, money, numbers, text
from tunehouse.sources.rates import first_mid


def dec(value, kind="decimal(20,2)"):
    return F.lit(value).cast(kind)


@pytest.mark.parametrize(
    "email, domain",
    [("ann@shop.com", "@shop.com"), ("no-at-sign", "no-at-sign"), ("a@b@c", "@b@c"), ("@x", "@x"), ("", ""), (None, None)],
)
def test_email_domain_keeps_the_at_sign(one, email, domain):
    assert one(text.email_domain(F.lit(email).cast("string"))) == domain


@pytest.mark.parametrize("name, out", [("mary ANN", "Mary ann"), ("x", "X"), ("", ""), ("ÉMILE zola", "Émile zola"), (None, None)])
def test_only_the_first_letter_is_upper_case(one, name, out):
    assert one(text.capitalize_first(F.lit(name).cast("string"))) == out


@pytest.mark.parametrize(
    "ms, out",
    [(0, "00:00"), (999, "00:00"), (61_000, "01:01"), (599_999, "09:59"), (6_000_000, "00:00"), (6_061_000, "01:01"), (None, ":")],
)
def test_duration_drops_hundreds_of_minutes_and_survives_null(one, ms, out):
    assert one(text.minutes_seconds(F.lit(ms).cast("int"))) == out


def test_concat_skip_nulls(one):
    assert one(text.concat_skip_nulls(F.lit("a"), F.lit(None).cast("string"), F.lit("b"))) == "ab"


def test_full_name_is_null_with_a_null_part(one):
    assert one(text.full_name(F.lit("a"), F.lit("b"))) == "a b"
    assert one(text.full_name(F.lit("a"), F.lit(None).cast("string"))) is None


@pytest.mark.parametrize("a, b, out", [(7, 2, 3), (-7, 2, -3), (0, 5, 0), (None, 5, None)])
def test_integer_division_truncates(one, a, b, out):
    assert one(numbers.int_div(F.lit(a).cast("bigint"), b)) == out


@pytest.mark.parametrize("x, out", [(1.015, 1.01), (2.5, 2.5), (0.125, 0.12), (0.135, 0.14), (-1.005, -1.0)])
def test_round_half_even_like_numpy(one, x, out):
    import numpy as np

    assert one(numbers.round_half_even(F.lit(x))) == out == float(np.round(x, 2))


def test_decimal_rounds_half_up(one):
    assert one(numbers.round_half_up(dec("1.015", "decimal(10,3)"))) == Decimal("1.02")
    assert one(numbers.round_half_up(dec("-1.015", "decimal(10,3)"))) == Decimal("-1.02")


@pytest.mark.parametrize("x, out", [("2.5", 3), ("2.4", 2), ("-2.5", -3)])
def test_numeric_to_int_rounds(one, x, out):
    assert one(numbers.round_to_int(dec(x, "decimal(10,2)"))) == out


@pytest.mark.parametrize(
    "part, whole, out",
    [("1", "8", "12.50%"), ("1", "3", "33.33%"), ("2", "3", "66.67%"), ("-1", "8", "-12.50%"), ("5", "0", None), (None, "1", None)],
)
def test_percent_text_has_two_decimals(one, part, whole, out):
    assert one(numbers.percent_text(numbers.percent_of(dec(part), dec(whole)))) == out


def test_whole_percent_text(one):
    assert one(numbers.whole_percent_text(F.lit(2).cast("bigint"), F.lit(3).cast("bigint"))) == "66%"
    assert one(numbers.whole_percent_text(F.lit(2).cast("bigint"), F.lit(0).cast("bigint"))) is None


@pytest.mark.parametrize(
    "hired, as_of, years",
    [
        ("2020-02-29", "2023-02-28", 2),
        ("2020-02-29", "2023-03-01", 3),
        ("2020-02-29", "2024-02-29", 4),
        ("2020-06-15", "2023-06-14", 2),
        ("2020-06-15", "2023-06-15", 3),
        ("2024-06-15", "2023-06-14", -1),
    ],
)
def test_completed_years(one, hired, as_of, years):
    assert one(dates.completed_years(F.lit(hired).cast("date"), datetime.date.fromisoformat(as_of))) == years


def test_cross_rate_and_default(one):
    usd, none = dec("10.00"), F.lit(None).cast("double")
    assert one(money.usd_to_ils(usd, F.lit(4.0), F.lit(1.25))) == 10.0 * 4.0 * (1 / 1.25)
    assert one(money.usd_to_ils(usd, none, F.lit(1.25))) is None
    assert one(money.usd_to_ils_or_default(usd, F.lit(4.0), none)) == 10.0 * 3.56
    assert one(money.usd_to_ils_or_default(usd, none, none, 2.0)) == 20.0


def test_first_mid(one):
    assert one(first_mid(F.lit('{"code":"USD","rates":[{"mid":3.9},{"mid":4.0}]}'))) == 3.9
    assert one(first_mid(F.lit('{"rates":[]}'))) is None


@pytest.mark.parametrize(
    "part, whole, out",
    [
        ("499999.99", "10000000000.00", "0.00%"),
        ("500000.00", "10000000000.00", "0.01%"),
        ("-500000.00", "10000000000.00", "-0.01%"),
        ("499999.99", "-10000000000.00", "0.00%"),
        ("12.00", "-8.00", "-150.00%"),
        ("99999999999999.99", "0.01", "999999999999999900.00%"),
    ],
)
def test_percentages_are_rounded_once(one, part, whole, out):
    assert one(numbers.percent_text(numbers.percent_of(dec(part, "decimal(22,2)"), dec(whole, "decimal(22,2)")))) == out


@pytest.mark.parametrize("amount, n, out", [("200999.99", 200_000, "1.00"), ("201000.00", 200_000, "1.01"), ("-201000.00", 200_000, "-1.01"), ("1.00", 0, None)])
def test_averages_are_rounded_once(one, amount, n, out):
    got = one(numbers.average_of(dec(amount, "decimal(22,2)"), F.lit(n).cast("bigint")))
    assert got == (None if out is None else Decimal(out))


@pytest.mark.parametrize("usd_pln, ils_pln", [(4.0, 0.0), (0.0, 1.0), (None, 1.0), (4.0, None)])
def test_unusable_rate_gives_the_default(one, usd_pln, ils_pln):
    rate = [F.lit(r).cast("double") for r in (usd_pln, ils_pln)]
    assert one(money.usd_to_ils(F.lit(10.0), *rate)) is None
    assert one(money.usd_to_ils_or_default(F.lit(10.0), *rate)) == pytest.approx(35.6)
