"""Readers for repacked months, annotation tables, vectors and small JSON files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postquarry.functions import naming as N
from postquarry.functions import times as TM
from postquarry.operators.buckets import index_counts
from postquarry.operators.catalog import month_catalog, months_found
from postquarry.sources.archive import DUMP_NAME, open_folder, read_tree

# JSON times keep their microseconds.
TIME_FORMATS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][XXX]",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]",
}


def read_repacked(
    spark: SparkSession, root: str, schema: T.StructType | None = None, langs: list[str] | None = None, bucket_folders: bool = False,
) -> DataFrame:
    """A repacked table; languages prune the folders.

    With ``schema`` the lines are read as JSON columns, without it as text ``value``. The
    folder columns are read as text: their digits would become numbers.
    """
    folders = ["day", "lang", "bucket"] if bucket_folders else ["day", "lang"]
    fields = [f for f in schema.fields if f.name not in folders] if schema else [T.StructField("value", T.StringType())]
    full = T.StructType([*fields, *[T.StructField(c, T.StringType()) for c in folders]])
    df = spark.read.schema(full).format("json" if schema else "text").options(**TIME_FORMATS).load(root)
    return df.where(F.col("lang").isin(langs)) if langs else df


def read_repacked_tree(
    spark: SparkSession, root: str, months: list[str] | None = None, langs: list[str] | None = None, slice_bytes: int = 256 << 20,
) -> DataFrame:
    """A plain tree ``YYYY-MM/YYYYMMDD/<lang>/YYYYMMDDHHMM.jsonl.gz`` with its location.

    ``dump, archive (day), lang, member (file name), line_no, value``. Months and
    languages select files before anything is opened.
    """
    options: dict[str, str | int] = {"sliceBytes": slice_bytes}
    if months:
        options["dump"] = "|".join(f"repack-{m}" for m in months)
    if langs:
        options["lang"] = "|".join(langs)
    return read_tree(spark, root, **options)


def read_repacked_lines(spark: SparkSession, root: str, months: list[str] | None = None, langs: list[str] | None = None) -> DataFrame:
    """What the repack stage wrote: ``dump, archive, member, line_no`` of the source, ``value, bucket, origin, day, lang``.

    Months (of the day) and languages prune the folders.
    """
    names = ["dump", "archive", "member", "value", "bucket", "origin", "day", "lang"]
    schema = ", ".join([*[f"{name} STRING" for name in names], "line_no BIGINT"])
    df = spark.read.schema(schema).json(root)
    if months:
        df = df.where(F.substring("day", 1, 6).isin([m.replace("-", "") for m in months]))
    return df.where(F.col("lang").isin(langs)) if langs else df


def repack_tree_index(spark: SparkSession, root: str, langs: list[str] | None = None) -> DataFrame:
    """Rows per file of a plain tree, with the bucket time and date parts from the file name."""
    lang_glob = "{" + ",".join(langs) + "}" if langs else "*"
    counted = lines_per_file(spark, f"{root.rstrip('/')}/*/*/{lang_glob}/*.jsonl.gz")
    dt = TM.bucket_time(F.col("path"))
    part = r"/([^/]+/[^/]+/([^/]+)/[^/]+)$"
    files = counted.select(
        F.regexp_extract("path", part, 2).alias("language"),
        dt.alias("dt"), F.year(dt).alias("year"), F.month(dt).alias("month"), F.dayofmonth(dt).alias("day"),
        F.hour(dt).alias("hour"), F.minute(dt).alias("minute"),
        F.regexp_extract("path", part, 1).alias("path"),
        "n",
    )
    return index_counts(files, "language", ["dt", "path"])


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """JSON lines, plain or gzip; malformed lines become null rows."""
    return spark.read.schema(schema).json(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines with the file they come from."""
    return spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), "value")


def lines_per_file(spark: SparkSession, path: str) -> DataFrame:
    """Lines of every file that the readers give: blank ones hold no row."""
    return read_lines(spark, path).where(r"value rlike '\\S'").groupBy("path").agg(F.count("*").alias("n"))


def read_coder_tables(spark: SparkSession, folder: str, columns: T.StructType | str | None = None) -> DataFrame:
    """All coders' answer tables of a folder; the coder is the last ``_`` token of the file name.

    Files may lack columns of one another.
    """
    reader = spark.read.option("mergeSchema", "true")
    if columns is not None:
        reader = reader.schema(columns)
    df = reader.parquet(folder)
    return df.select(*df.columns, N.coder_of(F.col("_metadata.file_name")).alias("coder"))


def read_tool_export(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Annotation-tool export: JSON arrays of flat records, one per task and annotator."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_vector_file(spark: SparkSession, path: str, label: str) -> DataFrame:
    """One JSON array of arrays: ``ref_id, label, vec``."""
    rows = spark.read.text(path, wholetext=True).select(F.posexplode(F.from_json("value", "array<array<double>>")).alias("pos", "vec"))
    return rows.select(F.concat_ws("_", F.lit(label), F.col("pos")).alias("ref_id"), F.lit(label).alias("label"), "vec")


def read_count_map(spark: SparkSession, path: str) -> DataFrame:
    """One JSON object ``{key: count}``: ``key, n``."""
    return spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "map<string,bigint>")).alias("key", "n"))


def read_relevance(spark: SparkSession, path: str) -> DataFrame:
    """Relevance collection: lines ``[location, post, words]`` or objects with those keys."""
    lines = spark.read.text(path)
    parts = F.from_json("value", "array<string>")
    as_object = F.from_json("value", "location STRING, post STRING, words ARRAY<STRING>")
    is_list = F.col("value").startswith("[")
    return lines.select(
        F.from_json(F.when(is_list, F.get(parts, 0)).otherwise(as_object["location"]), "array<string>").alias("location"),
        F.when(is_list, F.get(parts, 1)).otherwise(as_object["post"]).alias("post"),
        F.when(is_list, F.from_json(F.get(parts, 2), "array<string>")).otherwise(as_object["words"]).alias("words"),
    )


def read_picked(spark: SparkSession, path: str) -> DataFrame:
    """Picked candidates in order of time."""
    return spark.read.parquet(path).orderBy("date_created", "platform_id")


def list_months(spark: SparkSession, root: str) -> DataFrame:
    """Folders below ``root`` that end with ``YYYY-MM``: ``path``. One row per month."""
    import pyarrow.fs as pafs

    fs, base = open_folder(root)
    infos = fs.get_file_info(pafs.FileSelector(base, recursive=False, allow_not_found=True))
    paths = sorted(i.path for i in infos if i.type == pafs.FileType.Directory and DUMP_NAME.search(i.path))
    return spark.createDataFrame([(p,) for p in paths], "path STRING")


def read_status(spark: SparkSession, path: str, listing: DataFrame, outputs: tuple[str, ...] = ("stats", "index", "annotation")) -> DataFrame:
    """Every month of a folder listing (``path``) with what the stages have marked for it so far: ``year, month`` and a flag per output."""
    held = not list_partition_values(spark, path, "output").isEmpty()
    schema = "available BOOLEAN, output STRING, year INT, month INT"
    marks = spark.read.schema(schema).parquet(path) if held else spark.createDataFrame([], schema)
    return month_catalog(months_found(listing), {name: marks.where(F.col("output") == name) for name in outputs})


def list_partition_values(spark: SparkSession, root: str, column: str) -> DataFrame:
    """Values of the first partition column of a table, from its folder names alone."""
    import pyarrow.fs as pafs

    fs, base = open_folder(root)
    infos = fs.get_file_info(pafs.FileSelector(base, recursive=False, allow_not_found=True))
    prefix = f"{column}="
    names = sorted({i.base_name for i in infos if i.type == pafs.FileType.Directory and i.base_name.startswith(prefix)})
    return spark.createDataFrame([(n[len(prefix):],) for n in names], f"{column} STRING")
