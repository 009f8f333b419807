"""Instants (TIMESTAMP_NTZ, meaning UTC), Eastern time and calendar helpers, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Shapes of an ISO instant, every digit as 9: date and clock, and what may stand behind the decimals.
ISO_SHAPES, ZONE_SHAPES = ("9999-99-99T99:99:99", "9999-99-99 99:99:99"), ("", "Z", "+99:99", "-99:99", "+9999", "-9999")
#: What this library writes itself, and what most sources give.
ISO_Z = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z\z"
RFC = r"^(?:[A-Za-z]{3},\s*)?(\d{1,2})\s+([A-Za-z]{3})\s+(\d{4})\s+(\d{2}:\d{2}(?::\d{2})?)\s*([+-]\d{4}|GMT|UTC|UT|Z)?$"
EASTERN = "America/New_York"
# Month names start with these.
MONTHS = "jan feb mar apr may jun jul aug sep oct nov dec".split()
MONTH_NAMES = "january february march april may june july august september october november december".split() + MONTHS + ["sept"]


def epoch_micros(t: Column) -> Column:
    """Microseconds since 1970; from the parts of the wall clock, so no time zone is involved."""
    day = F.datediff(t.cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")
    micros = (F.extract(F.lit("SECOND"), t) * 1_000_000).cast("bigint")
    return (day * 86_400 + F.hour(t) * 3_600 + F.minute(t) * 60) * 1_000_000 + micros


def seconds_between(a: Column, b: Column) -> Column:
    """Seconds from a to b, exact, as a double."""
    return (epoch_micros(b) - epoch_micros(a)) / F.lit(1_000_000.0)


def minutes_between(a: Column, b: Column) -> Column:
    return (epoch_micros(b) - epoch_micros(a)) / F.lit(60_000_000.0)


def to_second(t: Column) -> Column:
    """Sub-seconds dropped."""
    return F.substring(t.cast("string"), 1, 19).cast("timestamp_ntz")


def to_iso(t: Column) -> Column:
    """2026-09-11T01:19:51Z; sub-seconds dropped."""
    s = t.cast("string")
    return F.concat(F.substring(s, 1, 10), F.lit("T"), F.substring(s, 12, 8), F.lit("Z"))


def _offset_minutes(text: Column) -> Column:
    """Minutes of +hh:mm, +hhmm; 0 for names of UTC and none."""
    signed = text.rlike(r"^[+-]\d")
    digits = F.regexp_replace(text, "[^0-9]", "")
    size = F.substring(digits, 1, 2).try_cast("int") * 60 + F.substring(digits, 3, 2).try_cast("int")
    return F.when(signed, F.when(text.startswith("-"), -size).otherwise(size)).otherwise(F.lit(0))


def _month(text: Column) -> Column:
    low = F.lower(text)
    number = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.substring(low, 1, 3)).cast("int")
    return F.when(low.isin(MONTH_NAMES), number)


def _shape(text: Column) -> Column:
    return F.translate(text, "0123456789", "9" * 10)


def _digits(text: Column, least: int, most: int) -> Column:
    return (F.translate(text, "0123456789", "") == "") & F.char_length(text).between(least, most)


def _iso(s: Column) -> Column:
    rest = F.substring(s, 20, 1 << 20)
    after = F.ltrim(rest, F.lit(".0123456789"))
    decimals = F.substr(rest, F.lit(2), F.char_length(rest) - F.char_length(after) - 1)
    zone = F.trim(after)
    sound = _shape(F.substring(s, 1, 19)).isin(*ISO_SHAPES) & _shape(zone).isin(*ZONE_SHAPES) & ((F.char_length(rest) == F.char_length(after)) | (rest.startswith(".") & _digits(decimals, 1, 9)))
    clock = F.concat(F.substring(s, 1, 10), F.lit(" "), F.substring(s, 12, 8), F.lit("."), F.rpad(F.substring(decimals, 1, 6), 6, "0")).try_cast("timestamp_ntz")
    return F.when(sound, F.timestamp_add("MINUTE", -_offset_minutes(zone), clock))


def parse_instant(text: Column) -> Column:
    """ISO-8601 (blank or T, up to 9 decimals cut to 6, Z, an offset or none for UTC) or RFC-2822; else null.

    The plain form is cast as it stands; only other texts are taken apart.
    """
    s = F.trim(text)
    part = lambda i, rx: F.regexp_extract(s, rx, i)
    clock = F.when(F.length(part(4, RFC)) == 5, F.concat(part(4, RFC), F.lit(":00"))).otherwise(part(4, RFC))
    month = F.lpad(_month(part(2, RFC)).cast("string"), 2, "0")
    rfc = F.concat(part(3, RFC), F.lit("-"), month, F.lit("-"), F.lpad(part(1, RFC), 2, "0"), F.lit(" "), clock).try_cast("timestamp_ntz")
    rfc = F.timestamp_add("MINUTE", -_offset_minutes(part(5, RFC)), rfc)
    return F.when(text.rlike(ISO_Z), F.substring(text, 1, 19).try_cast("timestamp_ntz")).when(text.isNotNull(), F.coalesce(_iso(s), F.when(s.rlike(RFC), rfc)))


def eastern(t: Column) -> Column:
    """The Eastern wall clock of an instant."""
    return F.convert_timezone(F.lit("UTC"), F.lit(EASTERN), t)


def offset_minutes(t: Column) -> Column:
    """Eastern offset from UTC in minutes at an instant: -300 or -240."""
    return ((epoch_micros(eastern(t)) - epoch_micros(t)) / 60_000_000).cast("int")


def eastern_iso(t: Column) -> Column:
    """2026-06-15T10:00:00-04:00."""
    local, off = eastern(t).cast("string"), offset_minutes(t)
    zone = F.format_string("%s%02d:%02d", F.when(off < 0, "-").otherwise("+"), (F.abs(off) / 60).cast("int"), (F.abs(off) % 60).cast("int"))
    return F.concat(F.substring(local, 1, 10), F.lit("T"), F.substring(local, 12, 8), zone)


def eastern_fields(t: Column) -> dict[str, Column]:
    """created_at_et, et_date, et_hour, et_dow (Monday is 0)."""
    local = eastern(t)
    return {"created_at_et": eastern_iso(t), "et_date": local.cast("date"), "et_hour": F.hour(local), "et_dow": F.weekday(local.cast("date"))}


def parse_eastern_text(text: Column) -> Column:
    """An instant from Eastern-time prose such as "Tuesday, September 8, 2026, 09:10 pm EDT"; else null.

    Read word by word: the first month's name with a day, a year and a clock
    behind it, then a half of the day and a zone, if they are there.  A zone
    must be the one in force, else null; in the repeated hour of autumn EST
    picks the second pass.
    """
    words = F.filter(F.split(F.translate(text, ",\t\n\r", "    "), " "), lambda w: w != "")

    def dates(all_: Column) -> Column:
        at = lambda i, k: F.coalesce(F.get(all_, i + k), F.lit(""))
        five = F.transform(all_, lambda w, i: F.struct(F.rtrim(w, F.lit(".")).alias("month"), at(i, 1).alias("day"), at(i, 2).alias("year"), at(i, 3).alias("clock"), at(i, 4).alias("half"), at(i, 5).alias("zone")))
        return F.get(F.filter(five, lambda x: _month(x["month"]).isNotNull() & _digits(x["day"], 1, 2) & _digits(x["year"], 4, 4) & x["clock"].contains(":")), F.lit(0))

    def wall(x: Column) -> Column:
        letters = lambda c: F.translate(F.lower(c), "0123456789:.", "")
        glued = letters(x["clock"]) != ""  # 9:10pm
        own = letters(x["half"]).isin("am", "pm")
        half = F.substring(F.when(glued, letters(x["clock"])).when(own, letters(x["half"])).otherwise(""), 1, 1)
        zone = F.upper(F.when(~glued & own, x["zone"]).otherwise(x["half"]))
        clock = F.split(F.translate(F.lower(x["clock"]), "apm.", ""), ":")
        hour = F.get(clock, F.lit(0)).try_cast("int")
        hour = F.when(half == "", hour).when(hour == 12, F.when(half == "p", 12).otherwise(0)).when(half == "p", hour + 12).otherwise(hour)
        two = lambda c: F.lpad(c.cast("string"), 2, "0")
        day = F.concat(x["year"], F.lit("-"), two(_month(x["month"])), F.lit("-"), two(x["day"]))
        at = F.concat(day, F.lit(" "), two(hour), F.lit(":"), F.get(clock, F.lit(1)), F.lit(":"), F.coalesce(F.get(clock, F.lit(2)), F.lit("00"))).try_cast("timestamp_ntz")
        return F.struct(at.alias("at"), F.when(zone.isin("EST", "EDT"), zone).alias("zone"))

    def place(x: Column) -> Column:
        w, zone = x["at"], x["zone"]
        daylight, standard = F.timestamp_add("HOUR", F.lit(4), w), F.timestamp_add("HOUR", F.lit(5), w)
        in_summer, in_winter = eastern(daylight) == w, (eastern(standard) == w) & (offset_minutes(standard) == -300)
        return F.when(zone == "EST", F.when(in_winter, standard)).when(zone == "EDT", F.when(in_summer, daylight)).otherwise(F.when(in_summer, daylight).otherwise(standard))

    return let(let(let(words, dates), wall), place)


def let(value: Column, body) -> Column:
    """body(value), with value evaluated once however often body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def month_of(t: Column) -> Column:
    """yyyy-MM of an instant."""
    return F.substring(t.cast("string"), 1, 7)


def week_bounds(week: Column) -> tuple[Column, Column]:
    """(Monday, Sunday) of "2026-W37"; null for a week that the year does not have."""
    year, number = F.substring(week, 1, 4).try_cast("int"), F.regexp_extract(week, r"^\d{4}-W(\d{1,2})$", 1).try_cast("int")
    first = F.trunc(F.make_date(year, F.lit(1), F.lit(4)), "WEEK")
    monday = F.date_add(first, ((number - 1) * 7).cast("int"))
    thursday = F.date_add(monday, 3)
    monday = F.when((number >= 1) & (F.year(thursday) == year), monday)
    return monday, F.date_add(monday, 6)


def day_range(start: Column, end: Column) -> Column:
    """All days from start to end, both included."""
    return F.when(start <= end, F.sequence(start, end, F.expr("interval 1 day"))).otherwise(F.array().cast("array<date>"))
