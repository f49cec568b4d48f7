"""Dates: tolerant parsing to UTC, day differences, truncation, relative ages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_MICROS = 86_400_000_000

# Zone of naive job-board dates.
BOARD_ZONE = "+02:00"

# Zone names of mail headers
_ZONE_NAMES = {
    "GMT": "+0000", "UTC": "+0000", "UT": "+0000", "BST": "+0100", "CET": "+0100", "CEST": "+0200", "SAST": "+0200",
    "EST": "-0500", "EDT": "-0400", "CST": "-0600", "CDT": "-0500", "MST": "-0700", "MDT": "-0600", "PST": "-0800", "PDT": "-0700",
}
# shapes of dates and times: N is a name, E, H and Y are runs of eight, six and four digits, 9 one or two, f a fraction, p AM or PM
_DATE_SHAPES = {
    "9 N Y": "d MMM yyyy", "9 N 9": "d MMM yy", "N 9 Y": "MMM d yyyy", "9-N-Y": "d-MMM-yyyy", "9-N-9": "d-MMM-yy",
    "9/9/Y": "M/d/yyyy", "9/9/9": "M/d/yy", "9.9.Y": "d.M.yyyy", "9.9.9": "d.M.yy", "9-9-Y": "M-d-yyyy",
    "Y/9/9": "yyyy/M/d", "Y.9.9": "yyyy.M.d", "Y-9-9": "yyyy-M-d", "E": "yyyyMMdd",
}
_TIME_SHAPES = {
    "": "", " 9:9": " H:mm", " 9:9:9": " H:mm:ss", " 9:9:9f": " H:mm:ss.SSSSSSSSS", " 9:9 p": " h:mm a", " 9:9:9 p": " h:mm:ss a", " H": " HHmmss",
}
_ZONE_SHAPES = {"": "", " z": " Z"}
_MONTH_FIRST = ("9/9/Y", "9/9/9")


def _bound(c: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value worked out once, however often it is read; a plain column would be copied into each place."""
    return F.get(F.transform(F.array(c), use), F.lit(0))


def _formats(dates: dict[str, str]) -> Column:
    """Shape -> the one format that reads it, for every date, time and zone."""
    pairs = [f"{d}{t}{z}={fd}{ft}{fz}" for d, fd in dates.items() for t, ft in _TIME_SHAPES.items() for z, fz in _ZONE_SHAPES.items()]
    # one literal, which the planner folds to a map: some hundred of them would be slow to plan
    return F.str_to_map(F.lit("|".join(pairs)), F.lit("[|]"), F.lit("="))


def _tidy(c: Column) -> Column:
    """One spelling of what dates leave open: no weekday, comma, comment or T, months of three letters, the zone as an offset."""
    text = F.regexp_replace(c, r"[,\s\u202f]+", " ")
    text = F.trim(F.regexp_replace(text, r"(?i)^ ?(mon|tue|wed|thu|fri|sat|sun)[a-z]*\.? |\([^)]*\) ?$", ""))
    text = F.regexp_replace(text, r"([A-Za-z]{3})[A-Za-z]*\.?(?= |-)", "$1")
    text = F.regexp_replace(text, r"(?i)(\d) ?([ap])\.?m\b\.?", "$1 $2m")
    text = F.regexp_replace(text, r"(\d)T(\d)", "$1 $2")
    text = F.regexp_replace(text, r"(\d)[Zz]$", "$1 +0000")
    text = F.regexp_replace(text, r"(:\d{2}(?:\.\d+)?) ?([+-]\d{2}):?(\d{2})$", "$1 $2$3")
    return _bound(text, _numbered_zone)


def _numbered_zone(text: Column) -> Column:
    """A zone's name at the end replaced by its offset."""
    zone = F.create_map(*[F.lit(x) for pair in _ZONE_NAMES.items() for x in pair])
    name = F.regexp_extract(text, r" ([A-Z]{2,4})$", 1)
    named = F.concat(F.substr(text, F.lit(1), F.length(text) - F.length(name)), F.try_element_at(zone, name))
    return F.coalesce(named, text)


def _shape(text: Column) -> Column:
    shape = F.regexp_replace(text, r"(?i) [ap]m", " p")
    shape = F.regexp_replace(shape, r" [+-]\d{4}$", " z")
    shape = F.regexp_replace(shape, r"(:\d{2})\.\d{1,9}", "$1f")
    shape = F.regexp_replace(shape, r"[A-Za-z]{3,}", "N")
    for digits, letter in ((r"\d{8}", "E"), (r"\d{6}", "H"), (r"\d{4}", "Y"), (r"\d{1,2}", "9")):
        shape = F.regexp_replace(shape, digits, letter)
    return shape


def _read(text: Column, shape: Column, dates: dict[str, str]) -> Column:
    return F.try_to_timestamp(text, F.try_element_at(_formats(dates), shape))


def parse_mixed(c: Column, naive_zone: str = "UTC") -> Column:
    """ISO 8601, mail-header and month-first dates, and other spellings, to an instant.

    The shape of a text names the one format that is tried; a month beyond 12 in a date with
    strokes makes it day-first. Text without an offset is read in ``naive_zone``; unreadable text is null.
    """
    return _bound(c, lambda raw: _bound(_tidy(raw), lambda text: _bound(
        _shape(text), lambda shape: _parsed(raw, text, shape, naive_zone))))


def _parsed(raw: Column, text: Column, shape: Column, naive_zone: str) -> Column:
    day_first = {d: _DATE_SHAPES[d].replace("M/d", "d/M") for d in _MONTH_FIRST}
    parsed = F.coalesce(
        _read(text, shape, _DATE_SHAPES),
        F.when(shape.startswith("9/9/"), _read(text, shape, day_first)),
        # years and months alone, region names; the cast alone would complete a bare time of day from the clock
        F.when(raw.rlike(r"^\d{4}-\d"), raw).try_cast("timestamp"),
    )
    if naive_zone in ("UTC", "+00:00"):
        return parsed
    return _bound(parsed, lambda at: F.when(shape.endswith(" z"), at).otherwise(F.to_utc_timestamp(at, naive_zone)))


def parse_mixed_each(columns: list[str]) -> Column:
    """The instants of several text columns as one array: the rules stand in the plan once."""
    return F.transform(F.array(*[F.col(c).cast("string") for c in columns]), lambda c: parse_mixed(c))


def parse_mixed_utc(c: Column) -> Column:
    return parse_mixed(c)


def parse_us_date(c: Column) -> Column:
    """Month-first dates only."""
    return _bound(_tidy(c), lambda text: _read(text, _shape(text), {d: _DATE_SHAPES[d] for d in _MONTH_FIRST}))


def assume_zone(c: Column, zone: str = BOARD_ZONE) -> Column:
    """A wall-clock time taken to be in ``zone``, as a UTC instant."""
    return F.to_utc_timestamp(c.cast("timestamp"), zone)


def drop_zone(c: Column) -> Column:
    return c.cast("timestamp_ntz")


def signed_days_floor(a: Column, b: Column) -> Column:
    """Floor of ``a - b`` in days, as a signed integer."""
    micros = F.unix_micros(a.cast("timestamp")) - F.unix_micros(b.cast("timestamp"))
    return F.floor(micros / F.lit(DAY_MICROS)).cast("int")


def days_between_floor(a: Column, b: Column) -> Column:
    """Size of the floored day difference. Not symmetric: one hour early is 1, late is 0."""
    return F.abs(signed_days_floor(a, b))


def whole_days(later: Column, earlier: Column) -> Column:
    """Full days elapsed, cut towards zero."""
    return F.timestamp_diff("DAY", earlier, later)


def period(c: Column, unit: str = "day") -> Column:
    """Start of the day, or of the Monday-based week."""
    return F.date_trunc(unit, c)


def earliest(a: Column, b: Column) -> Column:
    return F.least(a, b)


def older_than(c: Column, asof: Column, days: int = 21) -> Column:
    return c < asof - F.make_dt_interval(F.lit(days))


def relative_to_date(c: Column, asof: Column, legacy_minutes: bool = False) -> Column:
    """The furthest instant a phrase such as ``3d ago`` can mean.

    ``legacy_minutes`` reads ``2mo`` as two minutes, the way the phrase was read
    before months were recognised.
    """
    units = "(m|h|d|w|yr)" if legacy_minutes else "(mo|yr|m|h|d|w)"
    pattern = r"(\d+)\s*" + units
    return _bound(F.lower(c), lambda text: _bound(
        F.struct(F.regexp_extract(text, pattern, 1).alias("digits"), F.regexp_extract(text, pattern, 2).alias("unit")),
        lambda age: _furthest(text, age["digits"], age["unit"], asof)))


def _furthest(text: Column, digits: Column, unit: Column, asof: Column) -> Column:
    # absurd ages have no date: over 999 years, 9,999 months or 99,999 of a smaller unit
    longest = F.when(unit == "yr", 3).when(unit == "mo", 4).otherwise(5)
    count = F.when(F.length(digits) <= longest, digits.try_cast("int")) + 1
    zero = F.lit(0)
    second = F.make_dt_interval(zero, zero, zero, F.lit(1).cast("decimal(18,6)"))
    aged = (
        F.when(unit == "mo", asof - F.make_ym_interval(zero, count))
        .when(unit == "yr", asof - F.make_ym_interval(count, zero))
        .when(unit == "m", asof - F.make_dt_interval(zero, zero, count))
        .when(unit == "h", asof - F.make_dt_interval(zero, count))
        .when(unit == "d", asof - F.make_dt_interval(count))
        .when(unit == "w", asof - F.make_dt_interval(count * 7))
    )
    return F.when(
        text.contains("just now"),
        asof - F.make_dt_interval(zero, zero, zero, F.lit(59).cast("decimal(18,6)")),
    ).otherwise(aged + second)
