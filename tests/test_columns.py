"""Column expressions against Python's own functions and fixed cases."""

import datetime as dt
import math
import random
from decimal import Decimal

import pytest

from tradewind.functions import columns as C
from tradewind.operators.quality import normalise_date


def one(spark, value, kind, expression):
    df = spark.createDataFrame([(value,)], f"v {kind}")
    return df.select(expression("v")).first()[0]


NAMES = ["  red CHAIR ", "o'neil x-ray", "3d printer 2nd", "smith, jones and co", "a", "",
         "  \t tab\n", "éclair ÜBER", "USB-C 3.1gen", "'quoted' Name", "x1y2z3"]


@pytest.mark.parametrize("name", NAMES)
def test_title_case_is_pythons(spark, name):
    assert one(spark, name, "string", C.title_case) == name.strip().title()


def test_white_space_is_pythons():
    assert C.WHITE_SPACE == "".join(c for c in map(chr, range(0x110000)) if c.isspace())


def test_title_case_keeps_null(spark):
    assert one(spark, None, "string", C.title_case) is None


def test_week_key_is_strftime(spark):
    start = dt.date(1999, 12, 25)
    days = [(start + dt.timedelta(days=i),) for i in range(1200)]
    got = spark.createDataFrame(days, "d date").select("d", C.week_key("d")).collect()
    assert all(key == d.strftime("%Y-W%W") for d, key in got)


@pytest.mark.parametrize("text,want", [
    ("05-06-2025", dt.datetime(2025, 6, 5)),
    ("5-6-2025", dt.datetime(2025, 6, 5)),
    ("2025-06-05 10:11:12", dt.datetime(2025, 6, 5, 10, 11, 12)),
    (" 2025-06-05 ", dt.datetime(2025, 6, 5)),
    ("2025-06-05T10:11:12", dt.datetime(2025, 6, 5, 10, 11, 12)),
    ("2025/06/05", dt.datetime(2025, 6, 5)),
    ("6/5/2025", dt.datetime(2025, 6, 5)),
    ("2025/06/05 10:11:12", dt.datetime(2025, 6, 5, 10, 11, 12)),
    ("6/5/2025 10:11:12", dt.datetime(2025, 6, 5, 10, 11, 12)),
    ("06-05-2025 10:11:12", dt.datetime(2025, 6, 5, 10, 11, 12)),
    ("20250605", dt.datetime(2025, 6, 5)),
    ("2025-06", dt.datetime(2025, 6, 1)),
    ("5 Jun 2025", dt.datetime(2025, 6, 5)),
    ("5 June 2025", dt.datetime(2025, 6, 5)),
    ("Jun 5, 2025", dt.datetime(2025, 6, 5)),
    ("05-06-2025x", None), ("2025-13-01", None), ("2025-06-05 25:00:00", None),
    ("June 5, 2025", dt.datetime(2025, 6, 5)),
    ("25/12/2024", dt.datetime(2024, 12, 25)), ("12-25-2024", dt.datetime(2024, 12, 25)),
    ("2024.12.25", dt.datetime(2024, 12, 25)), ("Dec 25 2024", dt.datetime(2024, 12, 25)),
    ("12/25/24", dt.datetime(2024, 12, 25)), ("25-Dec-2024", dt.datetime(2024, 12, 25)),
    ("25 Dec 2024 10:00", dt.datetime(2024, 12, 25, 10)),
    ("2024/12/25 10:00", dt.datetime(2024, 12, 25, 10)),
    ("12/25/2024 10:00 PM", dt.datetime(2024, 12, 25, 22)),
    ("12/25/2024 12:30 am", dt.datetime(2024, 12, 25, 0, 30)),
    ("December 25, 2024 10:00:00", dt.datetime(2024, 12, 25, 10)),
    ("12/25/2024 13:00 PM", None), ("Decem 25 2024", None), ("12/25/202412/25/2024", None),
    ("31-02-2025", None), ("junk", None), ("", None), ("   ", None), (None, None),
])
def test_parse_timestamp(spark, text, want):
    assert one(spark, text, "string", C.parse_timestamp) == want


@pytest.mark.parametrize("text,want", [
    ("05-06-2025", dt.date(2025, 5, 6)), ("25-06-2025", dt.date(2025, 6, 25)),
    ("2025-06-05", dt.date(2025, 6, 5)), ("unknown", None)])
def test_registration_dates_are_month_first(spark, text, want):
    got = normalise_date(spark.createDataFrame([(text,)], "v string"), "v").collect()
    assert [r.v for r in got] == ([want] if want else [])


@pytest.mark.parametrize("day,want", [
    (dt.date(2024, 2, 29), dt.date(2023, 3, 1)), (dt.date(2024, 3, 31), dt.date(2023, 3, 31)),
    (None, None)])
def test_months_before(spark, day, want):
    assert one(spark, day, "date", lambda c: C.months_before(c, 12)) == want


@pytest.mark.parametrize("text,want", [
    ("9/8/2016", dt.date(2016, 9, 8)), ("12/31/2017", dt.date(2017, 12, 31)), ("13/1/2017", None)])
def test_parse_date_text(spark, text, want):
    assert one(spark, text, "string", C.parse_date_text) == want


@pytest.mark.parametrize("value,want", [
    (10.0, "10.0%"), (1.9, "1.9%"), (15.384, "15.38%"), (0.0, "0.0%"), (-3.456, "-3.46%"),
    (123456789.5, "123456789.5%"), (None, None)])
def test_percent_text(spark, value, want):
    assert one(spark, value, "double", C.percent_text) == want


def test_two_decimals_of_the_exact_value(spark):
    """Ties, values next to ties and all others, as the standard formatting of doubles gives them."""
    rng = random.Random(4)
    values = [0.125, 0.375, 2.675, 1.005, 0.005, 0.015, 99.995, 0.995, -0.001, 1e12 + 0.125, 12345.675, 0.0]
    values += [math.nextafter(v, to) for v in values for to in (-1e9, 1e9)]
    values += [rng.uniform(-1, 1) * 10 ** rng.uniform(-4, 9) for _ in range(3000)] + [rng.randrange(10**7) / 1000 for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r[0] for r in df.select(C.two_decimals("v")).collect()] == [f"{v:.2f}" for v in values]


@pytest.mark.parametrize("now,was,want", [
    (5, 0, "+100.00%"), (0, 0, "0.00%"), (6, 5, "+20.00%"), (5, 5, "0.00%"), (4, 5, "-20.00%"),
    (801, 800, "+0.12%"), (803, 800, "+0.38%"), (799, 800, "-0.12%"), (99999, 100000, "-0.00%"), (100001, 100000, "+0.00%"),
    (None, 5, None), (2999999, 1000000, "+200.00%")])
def test_change_text(spark, now, was, want):
    df = spark.createDataFrame([(now, was)], "a long, b long")
    assert df.select(C.change_text("a", "b")).first()[0] == want


def test_days_between_has_fractions(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2025, 1, 3, 18), dt.datetime(2025, 1, 1, 12))],
        "a timestamp_ntz, b timestamp_ntz")
    assert df.select(C.days_between("a", "b")).first()[0] == 2.25


def test_days_between_ignores_the_time_zone(spark):
    """A day with a clock change is still one day."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame(
            [(dt.datetime(2025, 4, 1), dt.datetime(2025, 3, 2))], "a timestamp_ntz, b timestamp_ntz")
        assert df.select(C.days_between("a", "b")).first()[0] == 30.0
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize("value,want", [
    (10000.01, "High"), (10000.0, "Medium"), (5000.0, "Medium"), (4999.99, "Low"), (-1.0, "Low"),
    (None, "Low")])
def test_tier_bounds(spark, value, want):
    assert one(spark, value, "double", C.tier) == want


@pytest.mark.parametrize("value,want", [
    (0.01, "Profitable"), (0.0, "Loss"), (-1.0, "Loss"), (None, "Loss")])
def test_profit_flag(spark, value, want):
    assert one(spark, value, "double", C.profit_flag) == want


def test_net_revenue_is_exact_and_signed(spark):
    df = spark.createDataFrame(
        [(3, Decimal("19.99"), Decimal("12.50")), (-2, Decimal("10.00"), Decimal("0.00")),
         (None, Decimal("1.00"), Decimal("0.00"))],
        "quantity int, unit_price decimal(12,2), discount_percent decimal(5,2)")
    got = [r[0] for r in df.select(C.net_revenue()).collect()]
    assert got == [Decimal("52.473750"), Decimal("-20.000000"), None]


def test_in_days_includes_the_whole_last_day(spark):
    stamps = [dt.datetime(2025, 1, 1), dt.datetime(2025, 1, 31, 23, 59, 59),
              dt.datetime(2025, 2, 1), dt.datetime(2024, 12, 31, 23, 59, 59)]
    df = spark.createDataFrame([(s,) for s in stamps], "t timestamp_ntz")
    got = [r[0] for r in df.filter(C.in_days("t", "2025-01-01", "2025-01-31")).collect()]
    assert got == stamps[:2]


@pytest.mark.parametrize("email,bad", [
    ("a@b.co", False), ("a.b.co", True), ("a@", True), ("a@b", True), ("a@@b.co", True),
    ("", True), (None, True)])
def test_invalid_email(spark, email, bad):
    assert one(spark, email, "string", C.invalid_email) is bad


# Published shares and growth rates with the numbers they come from.
@pytest.mark.parametrize("part,whole,want", [
    (69, 3627, "1.9%"), (43, 3254, "1.32%"), (69, 4031, "1.71%"), (48, 3924, "1.22%"),
    (2, 13, "15.38%"), (1, 17, "5.88%"), (1, 10, "10.0%"), (3, 13, "23.08%"), (4, 18, "22.22%"),
    (10094163.74 - 8264750.5, 8264750.5, "22.14%"),
    (11224630.88 - 9701323.26, 9701323.26, "15.7%"),
    (13396989.62 - 10102381.68, 10102381.68, "32.61%"), (1, 0, None)])
def test_published_rates(spark, part, whole, want):
    df = spark.createDataFrame([(float(part), float(whole))], "a double, b double")
    assert df.select(C.percent_text(C.ratio("a", "b"))).first()[0] == want
