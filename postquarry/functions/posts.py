"""Read schema of a post and the expressions over it.

Fields of which only presence matters, and the two entity objects, stay JSON text:
Spark keeps an object read into a STRING field as its source text, so a missing value
is null and an empty object is ``{}``. The entity objects are parsed only by the
expressions that need them, so a job that never asks for media never parses it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_text = T.StringType()

POST_SCHEMA = T.StructType([
    T.StructField("id", _text),
    T.StructField("id_str", _text),
    T.StructField("timestamp_ms", _text),
    T.StructField("timestamp", _text),
    T.StructField("lang", _text),
    T.StructField("text", _text),
    T.StructField("truncated", T.BooleanType()),
    T.StructField("extended_tweet", T.StructType([T.StructField("full_text", _text)])),
    T.StructField("user", T.StructType([
        T.StructField("id_str", _text),
        T.StructField("screen_name", _text),
        T.StructField("display_name", _text),
    ])),
    T.StructField("referenced_tweets", _text),
    T.StructField("in_reply_to_status_id", _text),
    T.StructField("quoted_status_id", _text),
    T.StructField("retweeted_status", _text),
    T.StructField("possibly_sensitive", T.BooleanType()),
    T.StructField("geo", _text),
    T.StructField("coordinates", _text),
    T.StructField("place", _text),
    T.StructField("entities", _text),
    T.StructField("extended_entities", _text),
])

# A post with any of these set answers, quotes or repeats another post.
ORIGIN_MARKERS = ["referenced_tweets", "in_reply_to_status_id", "quoted_status_id", "retweeted_status"]
# A post with any of these set has a location.
PLACE_FIELDS = ["geo", "coordinates", "place"]
# Platform name, post address.
PLATFORM = "twitter"
POST_URL = "https://x.com/%s/status/%s"

HASHTAG_SCHEMA = "hashtags ARRAY<STRUCT<text: STRING>>"
MEDIA_SCHEMA = "media ARRAY<STRUCT<media_url_https: STRING>>"


_OWN = "_post_"


def parse_posts(df: DataFrame, value_col: str = "value", keep_raw: bool = False, fields: list[str] | None = None) -> DataFrame:
    """JSON text to post columns, for both payload generations in one parse.

    A line is either the post or an envelope with the post under ``data``. Malformed
    lines keep their place with null fields and their text in ``_corrupt_record``.
    ``fields`` limits what is parsed to the named post fields.
    """
    schema = T.StructType([f for f in POST_SCHEMA.fields if fields is None or f.name in fields])
    both = T.StructType([
        *schema.fields,
        T.StructField("data", schema),
        T.StructField("_corrupt_record", _text),
    ])
    parsed = F.from_json(value_col, both, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    # An id is a number in one generation and text in the other; both read as text.
    wanted = {"id": "bigint"}
    others = [name for name in df.columns if name != value_col or keep_raw]
    enveloped = F.col("data").isNotNull()

    def field(name: str) -> Column:
        value = F.when(enveloped, F.col(f"data.{name}")).otherwise(F.col(f"{_OWN}{name}"))
        return (value.try_cast(wanted[name]) if name in wanted else value).alias(name)

    columns = [field(name) for name in schema.names]
    # inline() of the one parsed struct: a filter on a post field stays above it, so the
    # text is parsed once. Below a plain projection the parse would be copied into the filter.
    opened = df.select(*others, F.inline(F.array(parsed)).alias(*[f"{_OWN}{n}" for n in schema.names], "data", f"{_OWN}corrupt"))
    return opened.select(*others, *columns, F.col(f"{_OWN}corrupt").alias("_corrupt_record"))


def post_url(screen_name: Column, post_id: Column) -> Column:
    """Null when either part is missing."""
    return F.when(screen_name.isNotNull() & post_id.isNotNull(), F.format_string(POST_URL, screen_name, post_id))


def full_text(truncated: Column, text: Column, extended: Column) -> Column:
    """The extended text of a truncated post, else the text; a missing flag is not truncated."""
    return F.when(F.coalesce(truncated, F.lit(False)), F.coalesce(extended, text)).otherwise(text)


def hashtags(entities_json: Column) -> Column:
    """Hashtag texts in order, repeats kept; empty when there are none."""
    return F.coalesce(F.from_json(entities_json, HASHTAG_SCHEMA)["hashtags"]["text"], F.array().cast("array<string>"))


def has_key(object_json: Column, key: str) -> Column:
    """Whether a JSON object has the key, whatever its value; false for a missing object."""
    return F.coalesce(F.array_contains(F.json_object_keys(object_json), key), F.lit(False))


def contains_media(entities_json: Column, extended_json: Column) -> Column:
    """True or null, by presence of the ``media`` key (an empty list still counts)."""
    return F.when(has_key(entities_json, "media") | has_key(extended_json, "media"), F.lit(True))


def media_urls(entities_json: Column, extended_json: Column) -> Column:
    """Media addresses, the extended object first, else the plain one, else empty."""
    def urls(source: Column) -> Column:
        return F.from_json(source, MEDIA_SCHEMA)["media"]["media_url_https"]

    none = F.array().cast("array<string>")
    return (
        F.when(has_key(extended_json, "media"), F.coalesce(urls(extended_json), none))
        .when(has_key(entities_json, "media"), F.coalesce(urls(entities_json), none))
        .otherwise(none)
    )


def all_missing(columns: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNull() for c in columns])


def any_present(columns: list[str], empty_is_missing: bool = False) -> Column:
    """Any column not null; optionally an empty JSON object counts as missing."""
    def present(name: str) -> Column:
        there = F.col(name).isNotNull()
        if empty_is_missing:
            there = there & ~F.regexp_like(F.col(name).cast("string"), F.lit(r"^\s*\{\s*\}\s*$"))
        return there

    return reduce(lambda a, b: a | b, [present(c) for c in columns])


def short_user(id_str: Column, display_name: Column) -> Column:
    """The stripped user kept inside a post once the user table knows the rest."""
    return F.struct(id_str.alias("id_str"), display_name.alias("display_name"))
