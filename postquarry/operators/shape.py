"""Union of JSON shapes and its drift between batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: A place in one JSON value: its path, the path of the object whose key it is (null for what is no key), its type.
_SEEN = "array<struct<path:string,parent:string,type:string>>"
#: A place that has others below it, with its value.
_OPEN = "array<struct<path:string,parent:string,type:string,value:variant>>"


def _escaped(key: Column) -> Column:
    """A key as part of a path: a backslash before what marks paths; a lone backslash stands for the empty key."""
    return F.when(key == "", F.lit("\\")).otherwise(F.regexp_replace(key, r"([\\.\[])", r"\\$1"))


def _members(value: Column) -> Column:
    return value.try_cast("map<string,variant>")


def _elements(value: Column) -> Column:
    return value.try_cast("array<variant>")


def _type_name(value: Column) -> Column:
    scalar = F.schema_of_variant(value)
    return (
        F.when(F.is_variant_null(value), "null").when(_members(value).isNotNull(), "object").when(_elements(value).isNotNull(), "array")
        .when(scalar == "BOOLEAN", "boolean").when(scalar == "BIGINT", "integer").when(scalar == "STRING", "string").otherwise("number")
    )


def _place(path: Column, parent: Column, value: Column) -> Column:
    return F.struct(path.alias("path"), parent.alias("parent"), _type_name(value).alias("type"), value.alias("value"))


def _below(place: Column) -> Column:
    """Places directly below one: the keys of an object or, under one path, the elements of a list."""
    path, value, no_key = place["path"], place["value"], F.lit(None).cast("string")
    keyed = F.transform(
        F.map_entries(_members(value)),
        lambda e: _place(F.concat(path, F.when(path == "", F.lit("")).otherwise(F.lit(".")), _escaped(e["key"])), path, e["value"]),
    )
    listed = F.transform(_elements(value), lambda x: _place(F.concat(path, F.lit("[]")), no_key, x))
    return F.when(place["type"] == "object", keyed).when(place["type"] == "array", listed)


def _walk(text: Column) -> Column:
    """All places of a JSON text, level by level; a text cannot be deeper than it has opening brackets."""
    value = F.try_parse_json(text)
    root = F.array(_place(F.lit(""), F.lit(None).cast("string"), value)).cast(_OPEN)
    bare = lambda places: F.transform(places, lambda p: F.struct(p["path"].alias("path"), p["parent"].alias("parent"), p["type"].alias("type")))
    start = F.struct(F.array().cast(_SEEN).alias("seen"), root.alias("open"))

    def step(so_far: Column, _: Column) -> Column:
        deeper = F.filter(so_far["open"], lambda p: p["type"].isin("object", "array"))
        return F.when(F.size(so_far["open"]) == 0, so_far).otherwise(
            F.struct(
                F.concat(so_far["seen"], bare(so_far["open"])).cast(_SEEN).alias("seen"),
                F.flatten(F.transform(deeper, _below)).cast(_OPEN).alias("open"),
            )
        )

    malformed = F.array(F.struct(F.lit("").alias("path"), F.lit(None).cast("string").alias("parent"), F.lit("malformed").alias("type")))
    places = F.aggregate(F.sequence(F.lit(0), F.regexp_count(text, F.lit(r"[\[{]"))), start, step, lambda done: done["seen"])
    return F.when(value.isNull(), malformed.cast(_SEEN)).otherwise(places)


def key_presence(df: DataFrame, json_col: str, batch_col: str | None = None) -> DataFrame:
    """Merged shape of JSON objects: ``[batch,] path, type, n, required``.

    ``path`` is dotted, ``[]`` stands for the elements of a list and the empty path for
    the object itself; a dot, ``[`` or backslash in a key has a backslash before it. ``required``: the key is in every object that could hold it.
    ``integer`` is a whole number within 64 bits, written without a point or exponent; every other is ``number``. Text that is
    not JSON counts as type ``malformed``, and so does an object with a repeated key unless the session allows these.

    Texts are parsed once, as variants, and walked inside the JVM as deep as each one goes; equal (path, type)
    pairs are combined before the shuffle.
    """
    batch = F.col(batch_col).cast("string") if batch_col else F.lit("")
    source = df.select(batch.alias("batch"), F.col(json_col).alias("value")).where("value IS NOT NULL")
    counts = (
        source.select("batch", F.explode(_walk(F.col("value"))).alias("p")).select("batch", "p.*")
        .groupBy("batch", "path", "parent", "type").agg(F.count("*").alias("n"))
    )
    objects = counts.where("type = 'object'").select(F.col("batch").alias("_b"), F.col("path").alias("_p"), F.col("n").alias("_objects"))
    whole = Window.partitionBy("batch", "path", "parent")
    shaped = (
        counts.withColumn("_at_path", F.sum("n").over(whole))
        .join(objects, F.col("batch").eqNullSafe(F.col("_b")) & (F.col("parent") == F.col("_p")), "left")
        .withColumn("required", F.coalesce(F.col("_at_path") == F.col("_objects"), F.lit(False)))
    )
    columns = ["path", "type", "n", "required"]
    if not batch_col:
        return shaped.select(*columns)
    return shaped.select(F.col("batch").cast(df.schema[batch_col].dataType).alias(batch_col), *columns)


def schema_drift(presence: DataFrame, batch_col: str) -> DataFrame:
    """What changed from one batch to the next: ``batch, path, type, change``.

    Changes: ``added``, ``removed``, ``now required``, ``now optional``. Batches follow
    the order of their own type; the previous batch is found over the list of batches, one
    row each.
    """
    batches = presence.select(F.col(batch_col).alias("batch")).distinct()
    order = Window.orderBy("batch")
    pairs = batches.withColumn("_before", F.lag("batch").over(order)).where("_before IS NOT NULL")
    now = presence.select(F.col(batch_col).alias("batch"), "path", "type", F.col("required").alias("_now"))
    was = (
        presence.select(F.col(batch_col).alias("_before"), "path", "type", F.col("required").alias("_was"))
        .join(pairs, "_before").drop("_before")
    )
    change = (
        F.when(F.col("_was").isNull(), "added").when(F.col("_now").isNull(), "removed")
        .when(F.col("_now") & ~F.col("_was"), "now required").when(~F.col("_now") & F.col("_was"), "now optional")
    )
    compared = now.join(pairs.select("batch"), "batch", "left_semi").join(was, ["batch", "path", "type"], "full")
    return compared.withColumn("change", change).where("change IS NOT NULL").select(F.col("batch").alias(batch_col), "path", "type", "change")
