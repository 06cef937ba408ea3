"""Date and week column functions; all computed in UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedlake import vocab
from feedlake.functions.text import _c


def week_start(ts) -> Column:
    """Monday 00:00:00 of the ISO week (returned as TIMESTAMP_NTZ, UTC)."""
    return F.date_trunc("week", _c(ts)).cast("timestamp_ntz")


def week_end(ts) -> Column:
    """Sunday 23:59:59 of the ISO week."""
    return week_start(ts) + F.expr("interval '6 23:59:59' day to second")


def week_label(ts) -> Column:
    """ISO week label ``YYYY-Wnn`` with the ISO week-numbering year."""
    c = _c(ts)
    return F.concat(F.extract(F.lit("YEAROFWEEK"), c).cast("string"),
                    F.lit("-W"), F.lpad(F.weekofyear(c).cast("string"), 2, "0"))


def week_number(label) -> Column:
    """Week number text from a label: the part after the last ``-W``."""
    return F.element_at(F.split(_c(label), "-W"), -1)


def month_name_fr(ts) -> Column:
    months = F.array(*[F.lit(m) for m in vocab.MONTHS_FR])
    return F.element_at(months, F.month(_c(ts)))


def date_fr_long(ts) -> Column:
    """``27 mai 2026`` (day not padded)."""
    c = _c(ts)
    return F.concat_ws(" ", F.dayofmonth(c).cast("string"), month_name_fr(c),
                       F.year(c).cast("string"))


def date_fr_short(ts) -> Column:
    return F.date_format(_c(ts), "dd/MM/yyyy")


def datetime_fr(ts) -> Column:
    return F.date_format(_c(ts), "dd/MM/yyyy 'à' HH:mm")


def iso_utc(ts) -> Column:
    """ISO 8601 text with a +00:00 offset; microseconds only when non-zero."""
    c = _c(ts)
    micros = F.unix_micros(c.cast("timestamp")) % 1000000
    return F.when(micros == 0, F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")) \
        .otherwise(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"))


# fixed values: US zone names of feed dates and their fixed offsets
US_ZONES = {"EST": "-0500", "EDT": "-0400", "CST": "-0600", "CDT": "-0500",
            "MST": "-0700", "MDT": "-0600", "PST": "-0800", "PDT": "-0700",
            "UT": "+0000", "UTC": "+0000", "GMT": "+0000", "Z": "+0000"}

# day, month (any length, three letters count), year of two or four digits,
# time with or without seconds, then an offset or a zone name
_RFC_DATE = (r"^(?:[A-Za-z]+\.?,?\s+)?(\d{1,2})[\s-]+([A-Za-z]{3})[A-Za-z]*\.?[\s-]+(\d{2}|\d{4})\s+"
             r"(\d{1,2}:\d{2})(:\d{2})?\s*([A-Za-z]{1,5}|[+-]\d{2}:?\d{2})?$")


def parse_feed_date(col) -> Column:
    """RFC 822 / ISO 8601 feed date to a UTC timestamp; NULL when unparseable.

    One regular expression brings the RFC shapes (day names of any length or
    none, two-digit years, no seconds, offsets with or without colon, US zone
    names) to one form, which is parsed once; zone names are one map lookup
    and an unknown one makes the date unparseable. A date without a zone is
    UTC. Anything else is tried as ISO 8601.
    """
    c = F.trim(_c(col))
    part = lambda i: F.regexp_extract(c, _RFC_DATE, i)
    zones = F.create_map(*[F.lit(x) for kv in US_ZONES.items() for x in kv])
    # the parts are computed once, as an array that the lambda below binds
    parts = F.array(*[part(i) for i in range(1, 7)])

    def rfc(p: Column) -> Column:
        year = F.when(F.length(p[2]) == 4, p[2]).when(p[2] >= "50", F.concat(F.lit("19"), p[2])) \
            .otherwise(F.concat(F.lit("20"), p[2]))
        zone = F.when(p[5] == "", F.lit("+0000")).when(
            p[5].rlike("^[+-]"), F.replace(p[5], F.lit(":"), F.lit(""))).otherwise(
            F.element_at(zones, F.upper(p[5])))
        text = F.concat(p[0], F.lit(" "), F.initcap(p[1]), F.lit(" "), year, F.lit(" "), p[3],
                        F.when(p[4] == "", F.lit(":00")).otherwise(p[4]), F.lit(" "), zone)
        return F.try_to_timestamp(text, F.lit("d MMM yyyy H:mm:ss Z"))

    parsed = F.element_at(F.transform(F.array(parts), rfc), 1)
    return F.coalesce(parsed, F.try_to_timestamp(c)).cast("timestamp_ntz")
