"""Row filters and the reason why a row was dropped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postquarry.functions import posts as P

# The reject reasons.
SENSITIVE = "filter out: sensitive"
NO_LOCATION = "filter out: location"
OTHER = "filtered out"


def in_languages(df: DataFrame, langs: list[str], lang_col: str = "lang") -> DataFrame:
    return df.where(F.col(lang_col).isin(langs))


def original_only(df: DataFrame, marker_cols: list[str] = P.ORIGIN_MARKERS) -> DataFrame:
    """Posts that neither answer, quote nor repeat another one."""
    return df.where(P.all_missing(marker_cols))


def drop_sensitive(df: DataFrame, col: str = "possibly_sensitive") -> DataFrame:
    """A missing flag means not sensitive."""
    return df.where(~F.coalesce(F.col(col).cast("boolean"), F.lit(False)))


def require_any(df: DataFrame, cols: list[str] = P.PLACE_FIELDS, empty_is_missing: bool = False) -> DataFrame:
    return df.where(P.any_present(cols, empty_is_missing))


def with_media(df: DataFrame, entities: str = "entities", extended: str = "extended_entities") -> DataFrame:
    return df.where(P.contains_media(F.col(entities), F.col(extended)))


def truncated_only(df: DataFrame, col: str = "truncated") -> DataFrame:
    return df.where(F.coalesce(F.col(col), F.lit(False)))


def after_minutes(df: DataFrame, ts_col: str, minutes: int) -> DataFrame:
    """Drop the first ``minutes`` of every hour."""
    return df.where(F.minute(ts_col) >= minutes) if minutes else df


def in_hour(df: DataFrame, ts_col: str, start: str, lang: str, lang_col: str = "lang") -> DataFrame:
    """Rows of one language in ``[start, start + 1 hour)``."""
    first = F.lit(start).cast("timestamp_ntz")
    return df.where(
        (F.col(ts_col) >= first) & (F.col(ts_col) < first + F.expr("INTERVAL 1 HOUR")) & (F.col(lang_col) == lang)
    )


def in_month(df: DataFrame, ts_col: str, year: int, month: int) -> DataFrame:
    """Rows of one month, as a range so that it reaches the scan."""
    first = F.lit(f"{year:04d}-{month:02d}-01 00:00:00").cast("timestamp_ntz")
    return df.where((F.col(ts_col) >= first) & (F.col(ts_col) < first + F.expr("INTERVAL 1 MONTH")))


def with_reject_reason(df: DataFrame, rules: list[tuple[str, Column]], name: str = "reject_reason") -> DataFrame:
    """The first rule whose condition holds names the reason; null = accepted.

    A condition that is null does not reject.
    """
    reasons = [F.when(condition, F.lit(reason)) for reason, condition in rules]
    return df.withColumn(name, F.coalesce(*reasons) if reasons else F.lit(None).cast("string"))


def post_rules(
    langs: list[str],
    sensitive: bool = False,
    location: bool = False,
    lang_col: str = "lang",
    sensitive_col: str = "possibly_sensitive",
    place_cols: list[str] = P.PLACE_FIELDS,
    marker_cols: list[str] = P.ORIGIN_MARKERS,
    empty_is_missing: bool = False,
) -> list[tuple[str, Column]]:
    """The post filter as ordered rules: sensitive, location, language and origin."""
    rules = []
    if sensitive:
        rules.append((SENSITIVE, F.coalesce(F.col(sensitive_col).cast("boolean"), F.lit(False))))
    if location:
        rules.append((NO_LOCATION, ~P.any_present(place_cols, empty_is_missing)))
    wanted = F.coalesce(F.col(lang_col).isin(langs), F.lit(False)) & P.all_missing(marker_cols)
    return [*rules, (OTHER, ~wanted)]


def accepted(df: DataFrame, name: str = "reject_reason") -> DataFrame:
    return df.where(F.col(name).isNull()).drop(name)


def reject_counts(df: DataFrame, name: str = "reject_reason") -> DataFrame:
    """Rows per reason, accepted rows under ``accepted``."""
    reason = F.coalesce(F.col(name), F.lit("accepted")).alias("reason")
    return df.groupBy(reason).agg(F.count("*").alias("n"))


def nonblank(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).isNotNull() & (F.col(col) != ""))
