"""Column expressions: money, periods, labels and text cleaning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Layouts of dates that arrive as text; parts in brackets may be
# missing. No text fits two of them, so the most common one comes first.
DATE_FORMATS = ("yyyy-MM-dd[ HH:mm:ss]", "d-M-yyyy")
# Names of months; the first three letters will do as well.
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september",
          "october", "november", "december")
# Any other date: three parts, one of them perhaps a month's name, then perhaps a time of day.
GENERAL_PATTERN = (
    r"^(\d{1,4}|[A-Za-z]{3,9})[\s,./-]+(\d{1,2}|[A-Za-z]{3,9})[\s,./-]+(\d{1,4})"
    r"(?:,?[T\s]+(\d{1,2}):(\d{2})(?::(\d{2}(?:\.\d{1,6})?))?\s*([AaPp][Mm])?)?$")
# What is taken out or spelled out before that: eight digits run together, perhaps with six of a time;
# a weekday in front; the ending of a day's number; a word or comma before the time.
GENERAL_CLEANUP = (
    (r"^(\d{4})(\d{2})(\d{2})(?:[T\s]?(\d{2})(\d{2})(\d{2}))$", "$1/$2/$3 $4:$5:$6"),
    (r"^(\d{4})(\d{2})(\d{2})$", "$1/$2/$3"),
    (r"(?i)^(?:mon|tues?|wed(?:nes)?|thu(?:rs?)?|fri|sat(?:ur)?|sun)(?:day)?[\s,.]+", ""),
    (r"(?i)(\d)(?:st|nd|rd|th)(?![a-z])", "$1"),
    (r"(?i),?\s+at\s+(?=\d)", " "),
)
# The characters that count as white space.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")
# The patterns of the cleaning rules.
EMAIL_PATTERN = r"^[^@]+@[^@]+\.[^@]+$"
DAY_FIRST_PATTERN = r"^\d{2}-\d{2}-\d{4}$"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- money -----------------------------------------------------------------

def net_revenue(
    quantity: str | Column = "quantity",
    unit_price: str | Column = "unit_price",
    discount_percent: str | Column = "discount_percent",
) -> Column:
    """``quantity * unit_price * (1 - discount/100)``, exact; returns are negative."""
    keep = F.lit(1) - _col(discount_percent) * F.lit(0.01).cast("decimal(3,2)")
    return (_col(quantity) * _col(unit_price) * keep).cast("decimal(24,6)")


def money(c: str | Column, digits: int = 2) -> Column:
    """Half-up rounding to a fixed decimal type wide enough for any total."""
    return F.round(_col(c), digits).cast(f"decimal(28,{digits})")


def mean_of(total: Column, count: Column, digits: int = 4) -> Column:
    """total / count, rounded; NULL when nothing was counted."""
    return F.round(F.try_divide(total.cast("double"), count.cast("double")), digits)


def ratio(num: str | Column, den: str | Column, scale: float = 100.0, digits: int = 2) -> Column:
    """Rounded ``num / den * scale``; NULL on a zero or NULL denominator."""
    top = _col(num).cast("double") * F.lit(float(scale))
    return F.round(F.try_divide(top, _col(den).cast("double")), digits)


def percent_text(c: str | Column) -> Column:
    """``10.0%``, ``1.9%``, ``15.38%``: two decimals, one trailing zero cut."""
    text = F.round(_col(c), 2).cast("decimal(28,2)").cast("string")
    return F.concat(F.regexp_replace(text, "0$", ""), F.lit("%"))


def two_decimals(c: str | Column) -> Column:
    """A double below 10^15 with two decimals, the exact value rounded half to even, its sign kept (``-0.00``).

    ``round`` goes by the shortest text of a double and ``bround`` takes 2.675 for a tie, which it is not. Here the
    distance from the tie next to the value is worked out in steps that are exact wherever it is small:
    200 times the fraction is 128 + 64 + 8 times it, and multiples by powers of two have no rounding.
    """
    size = F.abs(_col(c))
    fraction = size - F.floor(size)
    cents = F.floor(fraction * 100)
    off = ((fraction * 128 - (cents * 2 + 1)) + fraction * 64) + fraction * 8
    cents = cents + F.when((off > 0) | ((off == 0) & (cents % 2 == 1)), 1).otherwise(0)
    whole = F.floor(size) + F.when(cents == 100, 1).otherwise(0)
    return F.concat(
        F.when(_col(c) < 0, F.lit("-")).otherwise(F.lit("")), whole.cast("string"),
        F.lit("."), F.lpad((cents % 100).cast("string"), 2, "0"))


def change_text(current: str | Column, previous: str | Column) -> Column:
    """Signed percent change; a zero base gives ``+100.00%`` or ``0.00%``."""
    now, was = _col(current).cast("double"), _col(previous).cast("double")
    change = F.try_divide(now - was, was) * F.lit(100.0)
    sign = F.when(change > 0, F.lit("+")).otherwise(F.lit(""))
    # handed on by a lambda, as its text uses the change many times
    digits = F.transform(F.array(change), two_decimals)[0]
    return (
        F.when(was == 0, F.when(now > 0, F.lit("+100.00%")).otherwise(F.lit("0.00%")))
        .otherwise(F.concat(sign, digits, F.lit("%")))
    )


# --- labels ----------------------------------------------------------------

def profit_flag(c: str | Column) -> Column:
    """'Profitable' above zero; zero, losses and NULL are 'Loss'."""
    return F.when(_col(c) > 0, F.lit("Profitable")).otherwise(F.lit("Loss"))


def tier(c: str | Column, high: float = 10000, low: float = 5000) -> Column:
    """High above ``high``, Medium between both bounds inclusive, else Low."""
    v = _col(c)
    return (
        F.when(v > high, F.lit("High")).when(v.between(low, high), F.lit("Medium"))
        .otherwise(F.lit("Low"))
    )


def quartile_label(c: str | Column) -> Column:
    v = _col(c)
    return (
        F.when(v == 1, F.lit("Platinum")).when(v == 2, F.lit("Gold"))
        .when(v == 3, F.lit("Silver")).otherwise(F.lit("Bronze"))
    )


def risk_flag(average_gap: str | Column, days: float = 30) -> Column:
    """'At Risk' above ``days``; customers without a gap are 'Normal'."""
    return F.when(_col(average_gap) > days, F.lit("At Risk")).otherwise(F.lit("Normal"))


# --- dates -----------------------------------------------------------------

def month_key(c: str | Column) -> Column:
    return F.date_format(_col(c), "yyyy-MM")


def week_key(c: str | Column) -> Column:
    """``yyyy-Www`` with weeks starting on Monday, 00 before the first Monday."""
    day = F.to_date(_col(c))
    week = F.floor((F.dayofyear(day) + F.lit(6) - F.weekday(day)) / F.lit(7))
    return F.concat(F.date_format(day, "yyyy"), F.lit("-W"), F.lpad(week.cast("string"), 2, "0"))


def period_key(c: str | Column, kind: str) -> Column:
    """Grouping key of a ``daily``, ``weekly`` or ``monthly`` report, as text."""
    kinds = {
        "daily": lambda: F.date_format(_col(c), "yyyy-MM-dd"),
        "weekly": lambda: week_key(c),
        "monthly": lambda: month_key(c),
    }
    if kind not in kinds:
        raise ValueError(f"unknown period {kind!r}; use one of {sorted(kinds)}")
    return kinds[kind]()


def month_distance(later: str | Column, earlier: str | Column) -> Column:
    """Whole calendar months between two dates."""
    a, b = _col(later), _col(earlier)
    return (F.year(a) - F.year(b)) * 12 + (F.month(a) - F.month(b))


def days_between(later: str | Column, earlier: str | Column, digits: int = 2) -> Column:
    """Fractional days between two wall-clock times, rounded.

    Days and seconds of the day are taken apart, so no time zone gets a say.
    """
    def second_of_day(c: Column) -> Column:
        return F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)

    a, b = _col(later), _col(earlier)
    seconds = F.datediff(a, b).cast("long") * 86400 + second_of_day(a) - second_of_day(b)
    return F.round(seconds / F.lit(86400.0), digits)


def in_days(c: str | Column, start: str, end: str) -> Column:
    """Inclusive range of whole days, open at the top so scans can push it down."""
    v = _col(c)
    first = F.lit(start).cast("date").cast("timestamp_ntz")
    after = F.date_add(F.lit(end).cast("date"), 1).cast("timestamp_ntz")
    return (v >= first) & (v < after)


def parse_date_text(c: str | Column, fmt: str = "M/d/yyyy") -> Column:
    """Text to date; NULL instead of an error on junk."""
    return F.try_to_timestamp(_col(c), F.lit(fmt)).cast("date")


def parse_general(c: str | Column) -> Column:
    """Dates of any usual layout: year first, or month first unless that is above 12, or a named month.

    Two-digit years are those of 1976 to 2075; a time of day may follow. A weekday in front, endings such as ``25th`` and an
    ``at`` before the time are passed over. NULL if it cannot be read.

    The text is matched once and the parts are handed on as the argument of a lambda: as plain columns they would be
    copied into the plan, and into the generated code, wherever one of them is used.
    """
    text = strip(c)
    for pattern, plain in GENERAL_CLEANUP:
        text = F.regexp_replace(text, pattern, plain)
    return F.transform(F.array(text), _from_general)[0]


def _from_general(text: Column) -> Column:
    split = F.split(F.regexp_replace(text, GENERAL_PATTERN, "$1|$2|$3|$4|$5|$6|$7"), r"\|")
    return F.when(text.rlike(GENERAL_PATTERN), F.transform(F.array(split), _from_parts)[0])


def _from_parts(parts: Column) -> Column:
    first, second, third, hour, minute, seconds, half = (parts[i] for i in range(7))

    def whole(part: Column) -> Column:
        return part.try_cast("int")

    year_first = first.rlike(r"^\d{4}$")
    day_first = second.rlike("[A-Za-z]") | (whole(first) > 12)
    year = F.when(year_first, first).otherwise(third)
    month = F.lower(F.when(year_first | day_first, second).otherwise(first))
    day = F.when(year_first, third).when(day_first, first).otherwise(second)
    names = [m[:3] for m in MONTHS]
    month = F.when(
        month.isin(*names, *MONTHS, "sept"),
        F.array_position(F.array(*map(F.lit, names)), F.substring(month, 1, 3)).cast("int")
    ).otherwise(whole(month))
    year = (
        F.when(F.length(year) == 4, whole(year))
        .when(F.length(year) == 2, whole(year) + F.when(whole(year) > 75, 1900).otherwise(2000)))
    hour = (
        F.when(hour == "", 0).when(half == "", whole(hour))
        .when(whole(hour).between(1, 12),
              whole(hour) % 12 + F.when(F.lower(half) == "pm", 12).otherwise(0)))
    return F.try_make_timestamp_ntz(
        year, month, whole(day), hour, F.coalesce(whole(minute), F.lit(0)),
        F.coalesce(seconds.try_cast("decimal(8,6)"), F.lit(0).cast("decimal(8,6)")))


def parse_timestamp(c: str | Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """The first of ``formats`` that fits wins, then ISO 8601, then the general layouts; blank and junk become NULL."""
    text = strip(c)
    tried = [F.try_to_timestamp(text, F.lit(f)).cast("timestamp_ntz") for f in formats]
    return F.coalesce(*tried, text.try_cast("timestamp_ntz"), parse_general(c))


def months_before(c: str | Column, months: int) -> Column:
    """The same day ``months`` earlier; a day that month lacks runs over into the next one (29 February to 1 March)."""
    day = F.to_date(_col(c))
    return F.date_add(F.add_months(F.trunc(day, "month"), -months), F.dayofmonth(day) - 1)


# --- text ------------------------------------------------------------------

def strip(c: str | Column) -> Column:
    """Cut white space of every kind at both ends, not only blanks."""
    return F.trim(_col(c), F.lit(WHITE_SPACE))


def is_blank(c: str | Column) -> Column:
    """NULL, empty or only white space."""
    return F.coalesce(strip(c) == "", F.lit(True))


def title_case(c: str | Column) -> Column:
    """Upper-case every letter that follows a non-letter, lower-case the rest.

    ``initcap`` looks at blanks only and would keep ``X-ray`` or ``O'neil``.
    """
    letters = r"\p{Lu}\p{Ll}\p{Lt}"
    runs = F.regexp_extract_all(F.lower(strip(c)), F.lit(f"([{letters}]+|[^{letters}]+)"), F.lit(1))
    raised = F.transform(
        runs, lambda run: F.concat(F.upper(F.substring(run, 1, 1)), F.substr(run, F.lit(2))))
    return F.array_join(raised, "")


def invalid_email(c: str | Column) -> Column:
    """True unless the text looks like ``name@host.tld``; NULL is invalid."""
    return ~F.coalesce(_col(c).rlike(EMAIL_PATTERN), F.lit(False))
