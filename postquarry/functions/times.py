"""Event time, date parts and day-aligned buckets as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def event_time(millis: Column, tz: str = "UTC") -> Column:
    """Epoch milliseconds (text or number) to a zone-free timestamp in ``tz``, whole seconds.

    Null for text that is not a number.
    """
    seconds = F.floor(millis.try_cast("bigint") / F.lit(1000)).cast("bigint")
    utc = F.expr(EPOCH) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)
    return utc if tz == "UTC" else F.convert_timezone(F.lit("UTC"), F.lit(tz), utc)


def date_parts(ts: Column) -> dict[str, Column]:
    """The four date columns every post table carries."""
    return {
        "year_created": F.year(ts),
        "month_created": F.month(ts),
        "day_created": F.dayofmonth(ts),
        "hour_created": F.hour(ts),
    }


def zone_free(df: DataFrame, ts_col: str, tz: str = "UTC") -> Column:
    """``ts_col`` as TIMESTAMP_NTZ; an instant is shown in ``tz``, a zone-free value stays."""
    if df.schema[ts_col].dataType.typeName() == "timestamp_ntz":
        return F.col(ts_col)
    local = F.col(ts_col).cast("timestamp_ntz")
    return F.convert_timezone(F.current_timezone(), F.lit(tz), local)


def bucket_start(ts: Column, minutes: int) -> Column:
    """Floor of the minute of the day to a multiple of ``minutes``.

    Counted from midnight, not from the epoch, so a resolution that does not divide
    the day starts anew each day.
    """
    if minutes < 1:
        raise ValueError("minutes must be at least 1")
    minute_of_day = F.hour(ts) * 60 + F.minute(ts)
    start = minute_of_day - F.pmod(minute_of_day, F.lit(minutes))
    return F.call_function(
        "make_timestamp_ntz",
        F.year(ts), F.month(ts), F.dayofmonth(ts),
        F.floor(start / 60).cast("int"), F.pmod(start, F.lit(60)), F.lit(0),
    )


def with_bucket(df: DataFrame, ts_col: str, minutes: int = 15, tz: str = "UTC", name: str = "bucket") -> DataFrame:
    """Add the bucket start of ``ts_col``."""
    return df.withColumn(name, bucket_start(zone_free(df, ts_col, tz), minutes))


def year_month(ts: Column) -> Column:
    """``YYYY-MM``."""
    return F.date_format(ts, "yyyy-MM")


def year_month_lang(ts: Column, lang: Column) -> Column:
    """``YYYY-MM-lang``."""
    return F.concat_ws("-", year_month(ts), lang)


def bucket_name(bucket: Column) -> Column:
    """``YYYYMMDDHHMM``, the name of a bucket file."""
    return F.date_format(bucket, "yyyyMMddHHmm")


def bucket_time(name: Column) -> Column:
    """Bucket start from a name holding ``YYYYMMDDHHMM``; null for anything else."""
    digits = F.regexp_extract(name, r"(?:^|/)(\d{12})(?:\.|$)", 1)
    return F.try_to_timestamp(F.when(digits != "", digits), F.lit("yyyyMMddHHmm")).cast("timestamp_ntz")
