"""Dates and years. Today and placeholders are parameters, so that results don't depend on when a plan runs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values of evidence without a date.
PLACEHOLDER_DATE, PLACEHOLDER_YEAR = "2026-01-01T00:00:00", 2026
FIRST_YEAR = 1950


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strict_date(c) -> Column:
    """YYYY-MM-DD only; null otherwise."""
    return F.when(_col(c).rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(_col(c), "yyyy-MM-dd"))


def try_date(c) -> Column:
    """A text as a date as SQL casts it: year, month and day are needed; slashes will do; a time is left away."""
    text = F.regexp_replace(F.trim(_col(c)), "/", "-")
    return F.when(text.rlike(r"^\d+-\d{1,2}-\d{1,2}"), F.try_to_date(F.regexp_extract(text, r"^(\d+-\d{1,2}-\d{1,2})(?:[ T].*)?$", 1), "y-M-d"))


#: Names of months, whole or short, and how dates with them are written; places of year, month and day.
_MONTH = "(jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sep(?:t(?:ember)?)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)"
_NAMED = (
    (rf"(?i)^{_MONTH}\.? (\d{{1,2}})(?:st|nd|rd|th)?,? (\d{{4}})$", (3, 1, 2)),
    (rf"(?i)^(\d{{1,2}})(?:st|nd|rd|th)?[ -]{_MONTH}\.?,?[ -](\d{{4}})$", (3, 2, 1)),
    (rf"(?i)^{_MONTH}\.?,? (\d{{4}})$", (2, 1, None)),
    (rf"(?i)^(\d{{4}})[ -]{_MONTH}\.?[ -](\d{{1,2}})$", (1, 2, 3)),
)


def free_date(c) -> Column:
    """A date with a month's name, with dots, or in numbers with the year last: then the month comes first, if it can be one."""
    text = F.trim(_col(c))
    found = []
    for pattern, (y, m, d) in _NAMED:
        head = F.lower(F.substring(F.regexp_extract(text, pattern, m), 1, 3))
        month = ((F.instr(F.lit("janfebmaraprmayjunjulaugsepoctnovdec"), head) + 2) / 3).cast("int")
        day = F.regexp_extract(text, pattern, d) if d else F.lit("1")
        found.append(F.when(text.rlike(pattern), F.concat_ws("-", F.regexp_extract(text, pattern, y), month.cast("string"), day)))
    first = r"^(\d{1,2})[/.-](\d{1,2})[/.-](\d{4})$"
    a, b, y = (F.regexp_extract(text, first, i) for i in (1, 2, 3))
    can = a.try_cast("int") <= 12
    found.append(F.when(text.rlike(first), F.concat_ws("-", y, F.when(can, a).otherwise(b), F.when(can, b).otherwise(a))))
    found.append(F.when(text.rlike(r"^\d{4}\.\d{1,2}\.\d{1,2}$"), F.replace(text, F.lit("."), F.lit("-"))))
    return F.try_to_date(F.coalesce(*found), "y-M-d")


def norm_date_iso(c) -> Column:
    """An ISO text of date and time from a year, month, day, compact date or ISO time with an offset, or a `free_date`; null
    otherwise.

    What is missing is the first month, day or midnight. An offset is kept, Z as +00:00.
    """
    text = F.regexp_replace(F.trim(_col(c)), "/", "-")
    y, m, d = (F.regexp_extract(text, r"^(\d{4})(?:-?(\d{1,2}))?(?:-?(\d{1,2}))?(?:[T ].*)?$", i) for i in (1, 2, 3))
    pad = lambda x: F.when(x == "", "01").otherwise(F.lpad(x, 2, "0"))
    day = F.concat_ws("-", y, pad(m), pad(d))
    time = F.regexp_extract(text, r"[T ](\d{2}:\d{2}(?::\d{2}(?:\.\d+)?)?)", 1)
    time = F.when(time == "", "00:00:00").when(F.length(time) == 5, F.concat(time, F.lit(":00"))).otherwise(time)
    offset = F.regexp_extract(text, r"[T ]\d{2}:\d{2}(?::\d{2}(?:\.\d+)?)?\s*(Z|[+-]\d{2}:?\d{2})$", 1)
    offset = F.when(offset == "Z", "+00:00").otherwise(F.regexp_replace(offset, r"^([+-]\d{2})(\d{2})$", "$1:$2"))
    shape = r"^\d{4}(-\d{1,2}(-\d{1,2}([T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?\s*(Z|[+-]\d{2}:?\d{2})?)?)?)?$|^\d{8}$"
    ok = text.rlike(shape) & F.try_to_date(day, "yyyy-MM-dd").isNotNull()
    free = F.date_format(free_date(c), "yyyy-MM-dd'T'00:00:00")
    return F.when(ok, F.concat(day, F.lit("T"), time, offset)).when(_col(c).rlike(r"[A-Za-z]{3}|^\s*\d{1,4}[/.-]\d{1,2}[/.-]"), free)


def best_publication_date(*found) -> Column:
    """The first date, as ISO text, that one of several sources gives."""
    return F.coalesce(*map(norm_date_iso, found))


def utc_instant(c) -> Column:
    """The instant of an ISO text; one without an offset is in UTC (needs the session's zone to be UTC)."""
    return F.try_to_timestamp(_col(c))


def date_of_parts(parts) -> Column:
    """ISO text from an array of year, and perhaps month and day."""
    parts = _col(parts)
    at = lambda i: F.coalesce(F.get(parts, F.lit(i)), F.lit(1)).cast("int")
    text = F.concat_ws("-", F.lpad(F.get(parts, F.lit(0)).cast("string"), 4, "0"), F.lpad(at(1).cast("string"), 2, "0"), F.lpad(at(2).cast("string"), 2, "0"))
    return F.when(F.size(parts).between(1, 3) & F.try_to_date(text, "yyyy-MM-dd").isNotNull(), F.concat(text, F.lit("T00:00:00")))


def realistic_date(c, today: str) -> Column:
    """The text if its date lies from 1950 to today; null otherwise."""
    day = F.try_to_date(F.substring(_col(c), 1, 10), "yyyy-MM-dd")
    return F.when(day.between(F.lit(f"{FIRST_YEAR}-01-01").cast("date"), F.lit(today).cast("date")), _col(c))


def best_date(published, created, today: str) -> Column:
    return F.coalesce(realistic_date(published, today), realistic_date(created, today))


def realistic_year(c, this_year: int) -> Column:
    return F.coalesce(_col(c).between(FIRST_YEAR, this_year), F.lit(False))


def leading_year(c, this_year: int) -> Column:
    """The first four signs as a realistic year; null otherwise."""
    head = F.substring(F.trim(_col(c).cast("string")), 1, 4)
    year = F.when(head.rlike(r"^\d{1,4}$"), head.cast("int"))
    return F.when(realistic_year(year, this_year), year)


def first_year(this_year: int, *candidates) -> Column:
    return F.coalesce(*[leading_year(c, this_year) for c in candidates])


def work_year(publication_year, publication_date, this_year: int) -> Column:
    return F.coalesce(F.when(realistic_year(publication_year, this_year), _col(publication_year)), leading_year(publication_date, this_year))


def published_at(c) -> Column:
    """A load's instant: ISO text, where an offset beyond 14 hours counts as none; the epoch if it can't be read."""
    text = F.trim(_col(c))
    hours = F.regexp_extract(text, r"[+-](\d{2}):?\d{2}$", 1)
    far = (hours != "") & (hours.cast("string").try_cast("int") > 14) & text.contains("T")
    text = F.when(far, F.regexp_replace(text, r"[+-]\d{2}:?\d{2}$", "")).otherwise(text)
    return F.coalesce(F.try_to_timestamp(text), F.lit("1970-01-01 00:00:00").cast("timestamp"))


def search_format(c) -> Column:
    """UTC with milliseconds and +00:00."""
    return F.date_format(_col(c), "yyyy-MM-dd'T'HH:mm:ss.SSSxxx")
