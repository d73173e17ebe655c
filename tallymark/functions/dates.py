"""Days, intervals, partial dates, recurrences. The day that counts as today is always a parameter, as_of."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .textkeys import ColumnOrName, _col

_DAY = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"

#: Month names, English by the first three letters and German (fixed values).
MONTHS = {
    "jan": 1, "feb": 2, "mar": 3, "apr": 4, "may": 5, "jun": 6, "jul": 7, "aug": 8, "sep": 9, "oct": 10, "nov": 11, "dec": 12,
    "januar": 1, "jänner": 1, "februar": 2, "märz": 3, "maerz": 3, "mär": 3, "april": 4, "mai": 5, "juni": 6, "juli": 7, "august": 8, "september": 9, "oktober": 10, "okt": 10, "november": 11, "dezember": 12, "dez": 12,
}

#: Countries' time zones, for wall times without one.
ZONES = {
    "DE": "Europe/Berlin", "RO": "Europe/Bucharest", "IT": "Europe/Rome", "FR": "Europe/Paris", "AT": "Europe/Vienna", "CH": "Europe/Zurich", "RS": "Europe/Belgrade", "GR": "Europe/Athens",
    "NL": "Europe/Amsterdam", "BE": "Europe/Brussels", "ES": "Europe/Madrid", "PT": "Europe/Lisbon", "PL": "Europe/Warsaw", "CZ": "Europe/Prague", "HU": "Europe/Budapest", "GB": "Europe/London",
}


def day(x: ColumnOrName) -> Column:
    """A day written YYYY-MM-DD that exists; else null."""
    t = F.trim(_col(x))
    return F.when(t.rlike(_DAY), F.try_to_timestamp(t, F.lit("yyyy-MM-dd")).cast("date"))


def span(x: ColumnOrName) -> Column:
    """struct(start, end) of a day or of A/B with B not before A; else null."""
    t = F.trim(_col(x))
    a, b = day(F.split_part(t, F.lit("/"), F.lit(1))), day(F.split_part(t, F.lit("/"), F.lit(2)))
    one = day(t)
    return F.when(F.contains(t, F.lit("/")), F.when((b >= a) & (F.size(F.split(t, "/")) == 2), F.struct(a.alias("start"), b.alias("end")))).when(one.isNotNull(), F.struct(one.alias("start"), one.alias("end")))


def next_occurrence(source: ColumnOrName, recurring: ColumnOrName, date: ColumnOrName, estimate: ColumnOrName, next_estimate: ColumnOrName, as_of: ColumnOrName, emitting: tuple[str, ...] = ("confirmed", "inferred")) -> Column:
    """struct(start, end, source, reason). Annual rows count from next_estimate, rows per fixture have none,
    others from date or estimate; the reason says why there is no occurrence and is null where there is one."""
    raw = _raw_date(recurring, date, estimate, next_estimate)
    return _occurrence(_col(source), _col(recurring), raw, span(raw), as_of, emitting)


def with_next_occurrence(rows: DataFrame, name: str, source: str, recurring: str, date: ColumnOrName, estimate: ColumnOrName, next_estimate: ColumnOrName, as_of: ColumnOrName, emitting: tuple[str, ...] = ("confirmed", "inferred")) -> DataFrame:
    """Rows with next_occurrence() as a column; the date is parsed once for each row."""
    staged = rows.withColumn("_raw", _raw_date(recurring, date, estimate, next_estimate)).withColumn("_found", span("_raw"))
    return staged.withColumn(name, _occurrence(_col(source), _col(recurring), F.col("_raw"), F.col("_found"), as_of, emitting)).drop("_raw", "_found")


def _raw_date(recurring: ColumnOrName, date: ColumnOrName, estimate: ColumnOrName, next_estimate: ColumnOrName) -> Column:
    filled = lambda c: F.nullif(_col(c), F.lit(""))
    return F.when(_col(recurring) == "annual", filled(next_estimate)).otherwise(F.coalesce(filled(date), filled(estimate)))


def _occurrence(src: Column, recurring: Column, raw: Column, found: Column, as_of: ColumnOrName, emitting: tuple[str, ...]) -> Column:
    reason = (
        F.when(src.isNull(), "no source for the date")
        .when(src == "disputed", "disputed date")
        .when(~src.isin(*emitting), "unknown source for the date")
        .when(recurring == "per fixture", "recurs with each fixture")
        .when(raw.isNull(), F.when(recurring == "annual", "annual without a next estimate").otherwise("no date"))
        .when(found.isNull(), "unparseable date")
        .when(found["end"] < _col(as_of), "in the past")
    )
    ok = reason.isNull()
    return F.struct(F.when(ok, found["start"]).alias("start"), F.when(ok, found["end"]).alias("end"), F.when(ok, src).alias("source"), reason.alias("reason"))


def occurrences(fixtures: ColumnOrName, next_fixture: ColumnOrName, source: ColumnOrName, date: ColumnOrName, as_of: ColumnOrName, emitting: tuple[str, ...] = ("confirmed", "inferred")) -> Column:
    """D3: an array of struct(suffix, start, end, source, reason): a row's fixtures (array of struct(date, dateSource))
    if it has any, with suffixes -0, -1, ...; else its next fixture (such a struct); else its own date."""

    def one(suffix: Column, src: Column, raw: Column) -> Column:
        found = span(raw)
        reason = F.when(src.isNull(), "no source for the date").when(src == "disputed", "disputed date").when(~src.isin(*emitting), "unknown source for the date").when(found.isNull(), "unparseable date").when(found["end"] < _col(as_of), "in the past")
        ok = reason.isNull()
        return F.struct(suffix.alias("suffix"), F.when(ok, found["start"]).alias("start"), F.when(ok, found["end"]).alias("end"), F.when(ok, src).alias("source"), reason.alias("reason"))

    f, n = _col(fixtures), _col(next_fixture)
    return (
        F.when(F.coalesce(F.size(f), F.lit(0)) > 0, F.transform(f, lambda x, i: one(F.concat(F.lit("-"), i.cast("string")), x["dateSource"], x["date"])))
        .when(n.isNotNull(), F.array(one(F.lit(""), n["dateSource"], n["date"])))
        .when(_col(date).isNotNull(), F.array(one(F.lit(""), _col(source), _col(date))))
        .otherwise(F.array(F.struct(F.lit("").alias("suffix"), F.lit(None).cast("date").alias("start"), F.lit(None).cast("date").alias("end"), F.lit(None).cast("string").alias("source"), F.lit("no date").alias("reason"))))
    )


def shown_precision(start: ColumnOrName, end: ColumnOrName, confirmed: ColumnOrName) -> Column:
    """A confirmed day as the day, a confirmed interval as both days, anything else as its month or months."""
    s, e = _col(start), _col(end)
    month = lambda d: F.date_format(d, "yyyy-MM")
    days = F.when(s == e, s.cast("string")).otherwise(F.concat_ws("/", s.cast("string"), e.cast("string")))
    months = F.when(month(s) == month(e), month(s)).otherwise(F.concat_ws("/", month(s), month(e)))
    return F.when(_col(confirmed), days).otherwise(months)


def days_of(start: ColumnOrName, end: ColumnOrName) -> Column:
    """The days from start to end, both included; none where end is before start."""
    return F.when(_col(end) >= _col(start), F.sequence(_col(start), _col(end))).otherwise(F.array().cast("array<date>"))


def months_of(start: ColumnOrName, end: ColumnOrName) -> Column:
    """The first days of the months that the interval touches."""
    a, b = F.trunc(_col(start), "month"), F.trunc(_col(end), "month")
    return F.when(b >= a, F.sequence(a, b, F.expr("interval 1 month"))).otherwise(F.array().cast("array<date>"))


def to_utc(local: ColumnOrName, zone: ColumnOrName, country: ColumnOrName, fallback: str = "Europe/Berlin") -> Column:
    """struct(utc, zone, guessed): the row's zone, else its country's, else the fallback, flagged as guessed."""
    table = F.create_map(*(F.lit(x) for kv in ZONES.items() for x in kv))
    known = F.coalesce(F.nullif(_col(zone), F.lit("")), F.element_at(table, F.coalesce(_col(country), F.lit(""))))
    used = F.coalesce(known, F.lit(fallback))
    return F.struct(F.to_utc_timestamp(_col(local), used).alias("utc"), used.alias("zone"), known.isNull().alias("guessed"))


def exclusive_end(end: ColumnOrName) -> Column:
    """The day after."""
    return F.date_add(_col(end), 1)


def year_before(d: ColumnOrName) -> Column:
    """Twelve months earlier; 29 February becomes the 28th."""
    return F.add_months(_col(d), -12)


def month_end(x: ColumnOrName) -> Column:
    """Of YYYY-MM the month's last day, of YYYY the year's, of a day itself; else null."""
    t = F.trim(_col(x))
    month = F.last_day(day(F.concat(t, F.lit("-01"))))
    return F.when(t.rlike(_DAY), day(t)).when(t.rlike("^[0-9]{4}-[0-9]{2}$"), month).when(t.rlike("^[0-9]{4}$"), day(F.concat(t, F.lit("-12-31"))))


def partial_bounds(x: ColumnOrName) -> Column:
    """Struct(lo, hi, precision) of YYYY, YYYY-MM or YYYY-MM-DD; null where it is none of these."""
    t = F.trim(_col(x))
    lo = F.when(t.rlike("^[0-9]{4}$"), day(F.concat(t, F.lit("-01-01")))).when(t.rlike("^[0-9]{4}-[0-9]{2}$"), day(F.concat(t, F.lit("-01")))).otherwise(day(t))
    kind = F.when(F.length(t) == 4, "year").when(F.length(t) == 7, "month").otherwise("day")
    return F.when(lo.isNotNull(), F.struct(lo.alias("lo"), month_end(x).alias("hi"), kind.alias("precision")))


_WRITTEN = r"([0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4}|[0-9]{1,2}\.? [A-Za-zäÄ]{3,9}\.? [0-9]{4}|[A-Za-zäÄ]{3,9}\.? [0-9]{4})"


def written_date(x: Column) -> Column:
    """The day that 14.12.2025, 1 Feb 2023 or Dezember 2025 names; a month counts as its last day."""
    dotted = F.try_to_timestamp(x, F.lit("d.M.yyyy")).cast("date")
    table = F.create_map(*(F.lit(v) for kv in MONTHS.items() for v in kv))
    name = F.lower(F.regexp_extract(x, r"([A-Za-zäÄ]{3,9})", 1))
    month = F.coalesce(F.element_at(table, name), F.element_at(table, F.substring(name, 1, 3)))
    year, dom = F.regexp_extract(x, r"([0-9]{4})$", 1), F.regexp_extract(x, r"^([0-9]{1,2})\.? ", 1)
    text = lambda d: F.concat_ws("-", year, F.lpad(month.cast("string"), 2, "0"), d)
    return F.when(x.rlike(r"^[0-9]{1,2}\.[0-9]"), dotted).when(month.isNull(), None).when(dom != "", day(text(F.lpad(dom, 2, "0")))).otherwise(F.last_day(day(text(F.lit("01")))))


#: Words before a date that make it a document's own (fixed values); a day on which something was read never is one.
MARKERS = r"(?:Stand|gilt ab(?: dem)?|g[üu]ltig ab|valid from)"


def marked_days(x: ColumnOrName) -> Column:
    """The days that a marker word names, such as Stand: 14.12.2025; a marker inside a longer word is none."""
    found = F.regexp_extract_all(F.coalesce(_col(x), F.lit("")), F.lit(rf"(?iu)(?<![\p{{L}}\p{{N}}_]){MARKERS}\s*:?\s*{_WRITTEN}"), 1)
    return F.array_compact(F.transform(found, written_date))


def opening_day(x: ColumnOrName) -> Column:
    """The day that a text starts with; null without."""
    return written_date(F.nullif(F.regexp_extract(F.coalesce(_col(x), F.lit("")), rf"^\s*{_WRITTEN}", 1), F.lit("")))


def alarm_day(start: ColumnOrName, lead_days: ColumnOrName) -> Column:
    """The day of the alarm; null without a lead."""
    return F.date_sub(_col(start), _col(lead_days).cast("int"))


def alarm_trigger(lead_days: ColumnOrName) -> Column:
    """As iCalendar writes it."""
    return F.concat(F.lit("-P"), _col(lead_days).cast("string"), F.lit("D"))


def in_past(end: ColumnOrName, as_of: ColumnOrName) -> Column:
    """F8: the day is before today."""
    return _col(end) < _col(as_of)


def in_future(checked: ColumnOrName, as_of: ColumnOrName) -> Column:
    """F8: the day is after today."""
    return _col(checked) > _col(as_of)


def stale(checked: ColumnOrName, as_of: ColumnOrName, days: int) -> Column:
    """F8: more than so many days ago."""
    return F.date_diff(_col(as_of), _col(checked)) > days


_MONTH_WORD = "(" + "|".join(sorted({*MONTHS, "january", "february", "march", "june", "july", "october", "december"}, key=lambda m: (-len(m), m))) + ")"
#: Endings of an ordinal number (fixed values).
_NTH = "(?:st|nd|rd|th)"

#: The ways a text names a day: pattern, and the order of year, month and day in what it captures (0 for no year).
_NAMED_DAYS = [
    (r"\b([0-9]{4})-([0-9]{2})-([0-9]{2})\b", (1, 2, 3)),
    (r"\b([0-9]{1,2})\.\s?([0-9]{1,2})\.\s?([0-9]{4}|[0-9]{2})\b", (3, 2, 1)),
    (r"\b([0-9]{1,2})/([0-9]{1,2})/([0-9]{4}|[0-9]{2})\b", (3, 2, 1)),
    (rf"(?i)\b([0-9]{{1,2}}){_NTH}?(?:\s?[-–]\s?[0-9]{{1,2}}{_NTH}?)?\.?\s+(?:of\s+)?{_MONTH_WORD}\b(?:\.?,?\s+([0-9]{{4}})\b)?", (3, 2, 1)),
    (rf"(?i)\b{_MONTH_WORD}\b\.?\s+([0-9]{{1,2}}){_NTH}?\b(?!\.?\s*(?:of\s+)?(?:{_MONTH_WORD[1:]})(?:\.?,?\s+([0-9]{{4}})\b)?", (3, 1, 2)),
]


def days_named(x: ColumnOrName, as_of: ColumnOrName) -> Column:
    """an array of struct(said, on): the days that a text names, in ISO, dotted, slashed or written form, in two
    languages. A year of two digits is of this century, a missing one is that of as_of; on is null where there is no
    such day."""
    t = F.coalesce(_col(x), F.lit(""))
    return F.array_distinct(F.concat(*(_named_by(t, pattern, order, _col(as_of)) for pattern, order in _NAMED_DAYS)))


def _named_by(text: Column, pattern: str, order: tuple[int, int, int], as_of: Column) -> Column:
    table = F.create_map(*(F.lit(v) for kv in MONTHS.items() for v in kv))

    def one(said: Column) -> Column:
        y, m, d = (F.regexp_extract(said, pattern, i) for i in order)
        year = F.when(y == "", F.year(as_of).cast("string")).when(F.length(y) == 2, F.concat(F.lit("20"), y)).otherwise(y)
        name = F.lower(m)
        month = F.coalesce(F.element_at(table, name), F.element_at(table, F.substring(name, 1, 3)), m.try_cast("int"))
        return F.struct(said.alias("said"), day(F.concat_ws("-", year, F.lpad(month.cast("string"), 2, "0"), F.lpad(d, 2, "0"))).alias("on"))

    return F.transform(F.regexp_extract_all(text, F.lit(pattern), 0), one)


def future_days_in(x: ColumnOrName, as_of: ColumnOrName) -> Column:
    """the days after as_of that a text names."""
    named = F.transform(days_named(x, as_of), lambda n: n["on"])
    return F.filter(F.array_sort(F.array_distinct(F.array_compact(named))), lambda d: d > _col(as_of))


def banned_dates(x: ColumnOrName, as_of: ColumnOrName) -> Column:
    """what of a text names a day after as_of, or a day that doesn't exist."""
    return F.transform(F.filter(days_named(x, as_of), lambda n: n["on"].isNull() | (n["on"] > _col(as_of))), lambda n: n["said"])


def kickoff(x: ColumnOrName) -> Column:
    """An ISO time in UTC; the sentinel of 1970 and what isn't a time are null."""
    t = F.try_to_timestamp(_col(x))
    return F.when(F.year(t) > 1970, t)

