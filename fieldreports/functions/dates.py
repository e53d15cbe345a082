"""Date parsing as Column expressions (no Python UDFs).

All parsers return ``timestamp_ntz`` (or ``date``) and NULL on failure; the
callers decide the fallback. Nothing raises under ANSI mode: ``d.m.yyyy`` is
split into fields whose lengths are checked and built with
``try_make_timestamp_ntz``; the other formats use ``try_to_date`` behind a shape
check, because Spark's parser accepts over-long fields such as ``010.02.2018``
that a strict reading rejects.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldreports.constants import MAX_SERVICE_AGE_DAYS, TWO_DIGIT_YEAR_PIVOT

# Shapes checked before parsing: 1-2 digit day and month, then a 4-digit
# (report) or 2-digit (roster) year, nothing else.
DMY4_SHAPE = r"^[0-9]{1,2}[.][0-9]{1,2}[.][0-9]{4}$"
DMY2_SHAPE = r"^[0-9]{1,2}[.][0-9]{1,2}[.][0-9]{2}$"

# Free-form visit dates are read token by token: what is no part of the day is taken out,
# the rest is split at any separators.
# A time of day behind an ISO date goes with all that follows it.
ISO_DATE_TIME = r"^([0-9]{4}-[0-9]{1,2}-[0-9]{1,2})[t ][0-9]{1,2}:[0-9]{2}.*$"
TIME_OF_DAY = (
    r"\b[0-9]{1,2}:[0-9]{2}(?::[0-9]{2}(?:[.][0-9]+)?)?\s*(?:[ap]m\b)?\s*(?:(?:z|utc|gmt)\b|[+-][0-9]{2}:?[0-9]{2}\b)?"
    r"|\b[0-9]{1,2}\s*[ap]m\b"
)
FILLERS = r"\b(?:mon|tue|tues|wed|wednes|thu|thur|thurs|fri|sat|satur|sun)(?:day)?\b|\b(?:at|on|of|the|and)\b"
ORDINAL = r"([0-9])(?:st|nd|rd|th)\b"
DATE_TEXT = r"^[a-z0-9 ,./-]+$"
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ts_literal(value) -> Column:
    """A ``timestamp_ntz`` literal for a Python ``datetime`` / ``date`` / ISO text
    (or a Column, cast). Goes through text, so the Python process's time zone
    plays no part (``F.lit(datetime)`` would read it as local time)."""
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    if hasattr(value, "isoformat"):
        value = value.isoformat(sep=" ") if hasattr(value, "hour") else value.isoformat()
    return F.lit(str(value)).cast("timestamp_ntz")


def digits_as_dots(text) -> Column:
    """Every run of non-digits becomes one ``.``; one leading non-digit is dropped.

    Only ASCII digits count as digits. After the first step a leading
    non-digit can only be ``.``, so the second step is a prefix check, not a
    second regular expression.
    """
    dotted = F.regexp_replace(_col(text), r"[^0-9]+", ".")
    return F.when(dotted.startswith("."), F.substr(dotted, F.lit(2))).otherwise(dotted)


def _dmy_from_digits(text: Column) -> Column:
    """``d.m.yyyy`` → timestamp_ntz for text made of digits and dots only:
    exactly three fields of 1-2, 1-2 and 4 digits forming a calendar day."""
    parts = F.split(text, "[.]")
    day, month, year = F.get(parts, 0), F.get(parts, 1), F.get(parts, 2)
    shape = (
        (F.size(parts) == 3)
        & F.length(day).between(1, 2)
        & F.length(month).between(1, 2)
        & (F.length(year) == 4)
        & (year != F.lit("0000"))  # there is no year 0
    )
    made = F.try_make_timestamp_ntz(
        year.try_cast("int"), month.try_cast("int"), day.try_cast("int"), F.lit(0), F.lit(0), F.lit(0)
    )
    return F.when(shape, made)


def strict_dmy(text) -> Column:
    """Parse ``d.m.yyyy`` exactly (whole string, valid calendar day) to timestamp_ntz."""
    t = _col(text)
    return F.when(t.rlike(DMY4_SHAPE), _dmy_from_digits(t))


def day_start(ts) -> Column:
    """Midnight of the same day, as timestamp_ntz."""
    return F.to_date(_col(ts)).cast("timestamp_ntz")


def parse_service_date(
    service_date,
    report_date,
    max_age_days: int | None = MAX_SERVICE_AGE_DAYS,
    fallback: str = "day",
) -> Column:
    """Service date of a report, or a fallback when it is unusable.

    The free text is reduced to ``d.m.yyyy`` by :func:`digits_as_dots` and parsed
    strictly. A date after the report time, or (if ``max_age_days`` is set) more
    than ``max_age_days`` before it, is rejected. On any failure the result is
    the report's day (``fallback='day'``) or the report time itself
    (``fallback='timestamp'``, the lenient repair job).

    This runs on every report, so it avoids a second regular expression and
    the date formatter, and uses a constant interval.
    """
    report = _col(report_date)
    parsed = _dmy_from_digits(digits_as_dots(service_date))
    ok = service_date_usable(parsed, report, max_age_days)
    if fallback == "day":
        fb = day_start(report)
    elif fallback == "timestamp":
        fb = report
    else:
        raise ValueError(f"unknown fallback {fallback!r}")
    return F.when(ok, parsed).otherwise(fb)


def service_date_usable(parsed: Column, report: Column, max_age_days: int | None = MAX_SERVICE_AGE_DAYS) -> Column:
    """Whether a parsed service date is kept: not after the report time and,
    with ``max_age_days``, not more than that many days before it."""
    ok = parsed.isNotNull() & (parsed <= report)
    if max_age_days is not None:
        ok = ok & (parsed >= report - F.expr(f"INTERVAL '{int(max_age_days)}' DAY"))
    return ok


def service_date_fell_back(service_date, report_date, max_age_days: int | None = MAX_SERVICE_AGE_DAYS) -> Column:
    """True when :func:`parse_service_date` uses its fallback for this report."""
    parsed = _dmy_from_digits(digits_as_dots(service_date))
    return ~service_date_usable(parsed, _col(report_date), max_age_days)


def date_or_keep(text) -> Column:
    """``d.m.yyyy`` text → ISO ``yyyy-MM-dd``; anything else is kept as it is."""
    t = _col(text)
    return F.coalesce(F.date_format(strict_dmy(t), "yyyy-MM-dd"), t)


def parse_roster_date(text) -> Column:
    """Roster ``dd.mm.yy`` → timestamp_ntz; years 69-99 are 1969-1999.

    Returns NULL for text that does not have the shape or is not a calendar day;
    :func:`fieldreports.sources.readers.load_roster` turns that into an error.
    """
    t = _col(text)
    parsed = F.when(t.rlike(DMY2_SHAPE), F.try_to_date(t, "d.M.yy"))
    # Spark reads yy as 2000-2099; move the pivot years back a century.
    fixed = F.when(
        F.year(parsed) >= 2000 + TWO_DIGIT_YEAR_PIVOT, F.add_months(parsed, -1200)
    ).otherwise(parsed)
    return fixed.cast("timestamp_ntz")


def parse_visit_date(text) -> Column:
    """Free-form visit date → ``date``, NULL if it cannot be read (f5).

    Weekday names, ordinals, filler words and a time of day are passed over, and any of
    blank, comma, dot, slash and hyphen separates. What is left must be eight digits
    (``yyyymmdd``), a month name with a day and a year, or three numbers: the year first
    where the first has four digits, else last; of the other two the month comes first
    unless only the other reading is a date. Two-digit years are completed (69-99: 19yy).
    """
    t = F.regexp_replace(F.lower(F.trim(_col(text))), ISO_DATE_TIME, "$1")
    for pattern, new in ((TIME_OF_DAY, " "), (FILLERS, " "), (ORDINAL, "$1")):
        t = F.regexp_replace(t, pattern, new)
    # each step is evaluated once: its value is the variable of a one-element transform
    return _let(t, lambda clean: F.when(
        clean.rlike(DATE_TEXT), _let(F.regexp_extract_all(clean, F.lit("[a-z]+|[0-9]+"), F.lit(0)), _date_of_tokens)))


def _let(value: Column, use) -> Column:
    return F.get(F.transform(F.array(value), use), 0)


def _date_of_tokens(tokens: Column) -> Column:
    numbers = F.filter(tokens, lambda x: x.rlike("^[0-9]+$"))
    names = F.filter(tokens, lambda x: ~x.rlike("^[0-9]+$"))
    name = F.get(names, 0)
    month = F.coalesce(*[
        F.nullif(F.array_position(F.array(*[F.lit(m) for m in spelled]), name), F.lit(0))
        for spelled in (MONTHS, [m[:3] for m in MONTHS])
    ], F.when(name == "sept", F.lit(9))).cast("int")
    a, b, c = (F.get(numbers, i) for i in range(3))

    def made(year: Column, month: Column, day: Column) -> Column:
        y = year.try_cast("int")
        full = F.when(F.length(year) == 4, y).when(F.length(year) == 2, y + F.when(y >= TWO_DIGIT_YEAR_PIVOT, 1900).otherwise(2000))
        return F.to_date(F.when((F.length(day) <= 2) & (full > 0), F.try_make_timestamp_ntz(
            full, month.cast("int"), day.try_cast("int"), F.lit(0), F.lit(0), F.lit(0))))

    def either(year: Column, x: Column, y: Column) -> Column:
        two = (F.length(x) <= 2) & (F.length(y) <= 2)
        return F.when(two, F.coalesce(made(year, x.try_cast("int"), y), made(year, y.try_cast("int"), x)))

    whole = (F.size(tokens) == 1) & (F.length(a) == 8)
    named = (F.size(numbers) == 2) & (F.size(names) == 1)
    plain = (F.size(numbers) == 3) & (F.size(names) == 0)
    return (
        F.when(whole, made(F.substring(a, 1, 4), F.substring(a, 5, 2).try_cast("int"), F.substring(a, 7, 2)))
        .when(named & (F.length(a) == 4), made(a, month, b))
        .when(named, made(b, month, a))
        .when(plain & (F.length(a) == 4), either(a, b, c))
        .when(plain, either(c, a, b))
    )


def iso_day(ts) -> Column:
    """``yyyy-MM-dd`` text of a timestamp or date."""
    return F.date_format(_col(ts), "yyyy-MM-dd")


def iso_timestamp(ts) -> Column:
    """``yyyy-MM-ddTHH:mm:ss`` text, the form used in request windows and payloads."""
    return F.date_format(_col(ts), "yyyy-MM-dd'T'HH:mm:ss")
