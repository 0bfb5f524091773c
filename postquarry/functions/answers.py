"""Scalar expressions of the annotation side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Relevance codes and land-cover codes with their names.
RELEVANCE = {"r": "RELEVANT", "n": "NOT_RELEVANT", "u": "UNCERTAIN", "na": "NOT_APPLICABLE"}
LAND_COVER = {
    "as": "ARTIFICIAL_SURFACES",
    "ag": "AGRICULTURAL",
    "fsn": "FOREST_AND_SEMINATURAL_AREAS",
    "wl": "WETLANDS",
    "wb": "WATER_BODIES",
    "ni": "NOT_IDENTIFIABLE",
    "am": "AMBIGUOUS",
}
# The four questions, their domains, and the codes to rewrite.
QUESTIONS = {
    "text_relevant": RELEVANCE,
    "text_class": LAND_COVER,
    "media_relevant": RELEVANCE,
    "media_class": LAND_COVER,
}
FIXES = [("text_relevant", "y", "r"), ("text_relevant", "R", "r")]
CLASS_NEEDS = {"text_class": "text_relevant", "media_class": "media_relevant"}
NOT_RELEVANT = "n"
# Fixed value: an unanswered question in a tool export.
NO_RESPONSE = "000"
# Upper bounds and names of the agreement bands (spelling as published).
KAPPA_BANDS = [
    (0.0, "Poor aggreement"),
    (0.2, "Slight agreement"),
    (0.4, "Fair agreement"),
    (0.6, "Moderate agreement"),
    (0.8, "Substantial agreement"),
]
TOP_BAND = "Almost perfect agreement"


def is_blank(value: Column) -> Column:
    return value.isNull() | (value == "")


def fixed_answer(question: str, value: Column, fixes: list[tuple[str, str, str]]) -> Column:
    """``value`` with the rewrites of this question applied."""
    result = value
    for name, old, new in fixes:
        if name == question:
            result = F.when(value == old, new).otherwise(result)
    return result


def kappa_band(kappa: Column) -> Column:
    """Name of the agreement band; null for a missing or undefined kappa."""
    band = F.when(kappa.isNull() | F.isnan(kappa), F.lit(None).cast("string"))
    for upper, name in KAPPA_BANDS:
        band = band.when(kappa < upper, name)
    return band.otherwise(TOP_BAND)


def joined(values: Column) -> Column:
    """Collect, sort and join with ``"; "``; null when nothing was collected."""
    collected = F.sort_array(F.collect_list(values))
    return F.when(F.size(collected) > 0, F.array_join(collected, "; "))


def user_name(name: Column, user_id: Column) -> Column:
    """Display name, else the id as text."""
    return F.coalesce(name, user_id.cast("string"))
