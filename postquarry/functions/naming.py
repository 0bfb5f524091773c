"""Names of dumps, archives, members and outputs as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _first_group(text: Column, pattern: str) -> Column:
    found = F.regexp_extract(text, pattern, 1)
    return F.when(found != "", found)


def member_stem(member: Column) -> Column:
    """``20220101/20220101000000.json.gz`` -> ``20220101000000``."""
    return _first_group(member, r"(?:^|/)([^/.]+)[^/]*$")


def archive_date(path: Column) -> Column:
    """The eight digits before ``.tar``."""
    return _first_group(path, r"(\d{8})\.tar$")


def dump_month(path: Column) -> Column:
    """The ``YYYY-MM`` a dump folder name ends with."""
    return _first_group(path, r"(\d{4}-\d{2})/?$")


def padded_lang(lang: Column) -> Column:
    """Language padded to three with ``_``; longer codes stay whole."""
    return F.when(F.length(lang) < 3, F.rpad(lang, 3, "_")).otherwise(lang)


def padded_month(month: Column) -> Column:
    return F.lpad(month.cast("string"), 2, "0")


def month_short_name(ts: Column) -> Column:
    return F.lower(F.date_format(ts, "MMM"))


def project_title(ts: Column, lang: Column, platform: Column, extra: Column) -> Column:
    """``year_mon_lang_platform_extra``."""
    return F.concat_ws("_", F.year(ts).cast("string"), month_short_name(ts), lang, platform, extra)


def table_name(kind: Column, ts: Column, lang: Column, platform: Column) -> Column:
    """``kind_year_month_lang_platform`` with padded month and language."""
    return F.concat_ws("_", kind, F.year(ts).cast("string"), padded_month(F.month(ts)), padded_lang(lang), platform)


def coder_of(file_name: Column) -> Column:
    """Coder = last ``_`` token of the file stem."""
    stem = F.regexp_replace(file_name, r"\.[^.]*$", "")
    return F.element_at(F.split(stem, "_"), -1)
