"""Date helpers over day-partition keys (``yyyyMMdd`` strings).

All parsing uses ``try_*`` functions: bad input gives NULL (or the stated
default), never a task failure under ANSI mode.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_FORMAT = "yyyyMMdd"
EPOCH_DAY = "19700101"
EPOCH_DATE = "1970-01-01"

# Names that free-form date texts may hold, and US zones with their hours from UTC.
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
WEEKDAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")
ZONES = {"gmt": 0, "ut": 0, "utc": 0, "est": -5, "edt": -4, "cst": -6, "cdt": -5, "mst": -7, "mdt": -6, "pst": -8, "pdt": -7}


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def today() -> str:
    """Run date default: today's ``yyyyMMdd`` (driver clock)."""
    return _dt.date.today().strftime("%Y%m%d")


def shift_day(day: str, n: int) -> str:
    """``day`` minus ``n`` days for parameters; bad input -> ``19700101``."""
    try:
        d = _dt.datetime.strptime(day, "%Y%m%d").date()
    except (TypeError, ValueError):
        return EPOCH_DAY
    return (d - _dt.timedelta(days=n)).strftime("%Y%m%d")


def date_minus(s, n: int) -> Column:
    """Column form of ``shift_day``: ``yyyyMMdd`` minus n days, bad -> 19700101."""
    parsed = F.try_to_timestamp(_col(s), F.lit(DAY_FORMAT)).cast("date")
    return F.coalesce(F.date_format(F.date_sub(parsed, n), DAY_FORMAT), F.lit(EPOCH_DAY))


def _named(word: Column, names, least: int = 3) -> Column:
    """1-based place of the name that ``word`` abbreviates (``least`` letters or more), else 0."""
    hit = F.array(*[F.lit(n).startswith(word) for n in names])
    return F.when(F.length(word) >= least, F.array_position(hit, True)).otherwise(F.lit(0)).cast("int")


def free_date(s, century_start: int | None = None) -> Column:
    """Free-form date text -> DATE, NULL for any other text.

    Month, day and year as ``Aug 13 2019``, ``13 August 2019``, ``8/13/19`` or
    ``2019/8/13``; commas, a weekday, a time (with AM or PM) and a zone may be
    among them. A time in another zone counts in UTC. Two-digit years are
    within 100 years of ``century_start`` (default: 80 years ago). A day past the
    month's end runs on into the next month. ISO ``2019-01-01`` is not accepted.
    """
    start = _dt.date.today().year - 80 if century_start is None else century_start
    common = _common_date(_col(s), start)
    # Every form holds the first letters of a month, or two slashes; other texts need no closer look.
    possible = F.regexp_like(F.lower(_col(s)), F.lit("|".join([*(m[:3] for m in MONTHS), "/.*/"])))
    return F.coalesce(common, F.when(possible, _any_date(s, start)))


def _prefixes(names) -> str:
    """Pattern of all abbreviations of three letters or more, the longest first."""
    return "|".join(sorted({w[:k] for w in names for k in range(3, len(w) + 1)}, key=len, reverse=True))


def _year(y: Column, start: int) -> Column:
    near = F.lit(start // 100 * 100) + y.try_cast("int")
    return F.when(F.length(y) > 2, y.try_cast("int")).otherwise(F.when(near < start, near + 100).otherwise(near))


def _day_of(year: Column, month: Column, day: Column) -> Column:
    valid = month.between(1, 12) & year.between(1, 9999)
    return F.when(valid, F.date_add(F.make_date(year, month, F.lit(1)), day - 1))


def _common_date(s: Column, start: int) -> Column:
    """The forms that nearly all texts have: a leading weekday, a time below 24 hours and UTC at their usual
    places. One compiled pattern decides, plain extractions follow; NULL for every other text."""
    text, gap = F.lower(s), r"[\s,]+"
    time = rf"(?:{gap}(?:[01]?\d|2[0-3]):[0-5]?\d(?::[0-5]?\d)?\s*(?:am|pm)?)?(?:{gap}(?:gmt|utc|ut))?"
    lead, end = rf"^[\s,]*(?:(?:{_prefixes(WEEKDAYS)})\.?{gap})?", rf"{time}[\s,]*$"
    month, year = rf"({_prefixes(MONTHS)})\.?", r"(\d{4}|\d{2})"
    forms = {  # pattern -> year, month and day of a match, after a mark that no pattern starts with
        rf"{lead}{month}{gap}(\d{{1,2}}){time}{gap}{year}{end}": "=$3 $1 $2",
        rf"{lead}(\d{{1,2}}){gap}{month}{gap}{year}{end}": "=$3 $2 $1",
        rf"{lead}(\d{{1,2}})/(\d{{1,2}})/{year}{end}": "=$3 $1 $2",
        rf"{lead}(\d{{4}})/(\d{{1,2}})/(\d{{1,2}}){end}": "=$1 $2 $3",
    }
    found = F.regexp_replace(text, "^=", " =")
    for pattern, parts in forms.items():
        found = F.regexp_replace(found, pattern, parts)

    def date(x: Column) -> Column:
        y, m, d = (F.split_part(F.substring(x, 2, 100), F.lit(" "), F.lit(i)) for i in (1, 2, 3))
        named = F.instr(F.lit("".join(n[:3] for n in MONTHS)), F.substring(m, 1, 3)) + 2
        number = F.when(named > 2, (named / 3).cast("int")).otherwise(m.try_cast("int"))
        return F.when(x.startswith("="), _day_of(_year(y, start), number, d.try_cast("int")))

    # The match is bound once (transform over one element) instead of being pasted into each use.
    return F.get(F.transform(F.array(found), date), 0)


def _any_date(s, start: int) -> Column:
    """``free_date`` for any order of the parts."""
    days = _prefixes(WEEKDAYS)
    zone = rf"(?<![a-z])({'|'.join(sorted(ZONES, key=len, reverse=True))})(?![a-z])"
    time = r"(\d{1,2}):(\d{1,2})(?::(\d{1,2}))?\s*(am|pm)?(?![a-z0-9:])"
    forms = {  # pattern -> groups of year, month, day
        r"^([a-z]{3,9})\.? (\d{1,2}) (\d{4}|\d{2})$": (3, 1, 2),
        r"^(\d{1,2}) ([a-z]{3,9})\.? (\d{4}|\d{2})$": (3, 2, 1),
        r"^(\d{1,2})/(\d{1,2})/(\d{4}|\d{2})$": (3, 1, 2),
        r"^(\d{4})/(\d{1,2})/(\d{1,2})$": (1, 2, 3),
    }

    def split(text):
        """Hours from UTC of the time's zone, and what is left without weekday, time, zone and commas."""
        part = lambda i: F.coalesce(F.nullif(F.regexp_extract(text, time, i), F.lit("")).try_cast("int"), F.lit(0))
        half = F.regexp_extract(text, time, 4)
        hour = F.when(half == "", part(1)).otherwise(part(1) % 12 + F.when(half == "pm", 12).otherwise(0))
        offset = F.coalesce(F.get(F.array(*map(F.lit, ZONES.values())), F.array_position(F.array(*map(F.lit, ZONES)), F.regexp_extract(text, zone, 1)).cast("int") - 1), F.lit(0))
        rest = F.regexp_replace(F.regexp_replace(text, time, " "), rf"(?<![a-z])(?:{days})(?![a-z])\.?", " ")
        rest = F.trim(F.regexp_replace(F.regexp_replace(rest, zone, " "), r"[\s,]+", " "))
        which = [F.when(F.regexp_like(rest, F.lit(p)), F.struct(*[F.regexp_extract(rest, p, g).alias(n) for g, n in zip(gs, "ymd")])) for p, gs in forms.items()]
        # Whole days by which the time in UTC is after (or before) the written day.
        moved = F.floor((hour * 60 + part(2) - offset * 60) / 1440).cast("int")
        return F.struct(F.coalesce(*which).alias("of"), moved.alias("moved"))

    def date(found):
        y, m = found["of"]["y"], found["of"]["m"]
        month = F.when(F.regexp_like(m, F.lit("^[a-z]")), _named(m, MONTHS)).otherwise(m.try_cast("int"))
        return _day_of(_year(y, start), month, found["of"]["d"].try_cast("int") + found["moved"])

    # Each step's value is bound once (transform over one element) instead of being pasted into the next.
    text = F.lower(F.regexp_replace(_col(s), r"\([^()]*\)", " "))
    return F.get(F.transform(F.transform(F.array(text), split), date), 0)


def post_date(s, default: str = EPOCH_DATE, century_start: int | None = None) -> Column:
    """Free-form date text (see ``free_date``) -> ``yyyy-MM-dd``; unknown form / NULL -> default."""
    return F.coalesce(F.date_format(free_date(s, century_start), "yyyy-MM-dd"), F.lit(default))


def date_text(s, century_start: int | None = None) -> Column:
    """As ``post_date`` but failures give ""."""
    return post_date(s, "", century_start)


def login_date(s) -> Column:
    """``yyyyMMddHHmmss`` -> DATE from its first 8 characters; bad/empty/NULL -> NULL."""
    s = _col(s)
    text = F.concat_ws("-", F.substring(s, 1, 4), F.substring(s, 5, 2), F.substring(s, 7, 2))
    return F.try_to_date(text)


def day_key(ts) -> Column:
    """Timestamp -> ``yyyyMMdd`` partition key."""
    return F.date_format(_col(ts), DAY_FORMAT)
