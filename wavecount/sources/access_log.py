"""Web-server access log: fields separated by one blank."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wavecount.sources.parsing import FAILFAST, keep_valid, parsed_fields

# The layout of a log line.
SEPARATOR = " "
IP, USER, TIME, METHOD, URL = 0, 1, 3, 5, 6
TIME_FORMAT = "dd/MM/yyyy:HH:mm:ss"

# Reads one- and two-digit numbers alike; impossible dates are malformed.
_PARSE_FORMAT = "d/M/yyyy:H:m:s VV"

# The same fields as numbers of any size and sign; what follows the last is not read.
_FIELDS = r"^(-?\d{1,9})/(-?\d{1,9})/(-?\d{1,9}):(-?\d{1,9}):(-?\d{1,9}):(-?\d{1,9})"

STRICT = "strict"
ROLLING = "rolling"


def rolling_time(text: Column, zone: str) -> Column:
    """The instant of a local time whose fields may leave their range and then carry over.

    Field arithmetic in place of a parser: months are counted from January of the year,
    days from the first of that month, hours, minutes and seconds from midnight of that
    day. So 31/02/2015 is 03/03/2015, month 0 the December before, hour 24 the next day.
    Null where the text has no such fields or the sum leaves the range of timestamps.
    """
    day, month, year, hour, minute, second = (
        F.regexp_extract(text, _FIELDS, k).try_cast("bigint") for k in range(1, 7))
    months = year * 12 + month - 1
    first_year, first_month = F.floor(months / F.lit(12)), F.pmod(months, F.lit(12)) + 1
    in_range = first_year.between(1, 9999)
    first = F.make_date(F.when(in_range, first_year).cast("int"), first_month.cast("int"), F.lit(1))
    seconds = (day - 1) * 86_400 + hour * 3_600 + minute * 60 + second
    days = F.unix_date(first) + F.floor(seconds / F.lit(86_400))
    # the days from 0001-01-01 to 9999-12-31
    date = F.date_from_unix_date(F.when(days.between(-719_162, 2_932_896), days).cast("int"))
    rest = F.pmod(seconds, F.lit(86_400))
    return F.try_make_timestamp(
        F.year(date), F.month(date), F.dayofmonth(date), F.floor(rest / F.lit(3_600)).cast("int"),
        F.floor(F.pmod(rest, F.lit(3_600)) / F.lit(60)).cast("int"), F.pmod(rest, F.lit(60)).cast("decimal(16,6)"), F.lit(zone))


def _time(text: Column, zone: str, dates: str) -> Column:
    if dates == STRICT:
        return F.try_to_timestamp(F.concat_ws(SEPARATOR, text, F.lit(zone)), F.lit(_PARSE_FORMAT))
    if dates == ROLLING:
        return rolling_time(text, zone)
    raise ValueError(f"unknown dates {dates!r}")


def parse_access_log(lines: DataFrame, mode: str = FAILFAST, zone: str = "UTC",
                     carry: tuple[str, ...] = (), dates: str = STRICT) -> DataFrame:
    """``value`` -> ip, user_id, ts, method, url.

    Times are local to ``zone``; the zone offset of the line is not read. Impossible dates
    are malformed (``strict``) or carried over into the next field (``rolling``).
    Columns named in ``carry`` are passed on unchanged.
    """
    fields = lines.select("value", *carry, F.split(F.rtrim("value"), SEPARATOR).alias("f"))
    parsed = fields.select("value", *carry, parsed_fields(
        F.get("f", F.lit(IP)).alias("ip"),
        F.get("f", F.lit(USER)).alias("user_id"),
        _time(F.get("f", F.lit(TIME)), zone, dates).alias("ts"),
        F.get("f", F.lit(METHOD)).alias("method"),
        F.get("f", F.lit(URL)).alias("url"),
    ))
    valid = F.col("ts").isNotNull() & F.col("url").isNotNull()
    return keep_valid(parsed, valid, F.col("value"), mode).drop("value")
