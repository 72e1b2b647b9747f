"""Landing-zone JSON: read, flatten, count, inventory, write.

Two on-disk layouts exist:
  * ``array``  -- one JSON document per file: a top-level array of records, or a wrapper
                  object whose array-of-records member holds them (foreign landing files).
  * ``lines``  -- JSON lines, as Spark's own JSON sink writes them (our landing table).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from tickwise.sources.arrival import ARRIVAL, BATCH


def _arrival_cols(df: DataFrame) -> list[Column]:
    return [F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_modification_time").alias("_file_mtime")]


def _documents(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """One row per file: ``_file``, ``_file_mtime`` and ``_recs``, the record list its document
    holds (null when there is none)."""
    paths = [path] if isinstance(path, str) else list(path)
    # wholetext is an argument: text() would override the option with its own default
    raw = spark.read.text(paths, wholetext=True).select(F.col("value").alias("doc"), *_arrival_cols(None))
    arr_t = T.ArrayType(schema)
    trimmed = F.regexp_replace(F.col("doc"), r"^\s+", "")
    as_array = F.from_json(F.col("doc"), arr_t)
    members = F.from_json(F.col("doc"), T.MapType(T.StringType(), T.StringType()))
    # first member (by name) whose value parses as an array of records
    wrapped = F.filter(
        F.transform(F.array_sort(F.map_keys(members)),
                    lambda k: F.from_json(F.element_at(members, k), arr_t)),
        lambda a: a.isNotNull())
    records = (F.when(F.startswith(trimmed, F.lit("[")), as_array)
               .when(F.startswith(trimmed, F.lit("{")), F.get(wrapped, F.lit(0))))
    return raw.select("_file", "_file_mtime", records.alias("_recs"))


def read_array_files(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """S1 + S2 for ``array`` files: one document per file, exploded to records (F8: explode,
    then the record struct's fields).

    Each file is read whole (as a multi-line JSON reader does); the document is an array of
    records or an object wrapping one. For a wrapper, the first member by name that parses as
    an array of records is used (the inferred-column order of the original reader, but never a
    member of the wrong type). Unparseable files contribute no rows (S13) and are listed by
    ``bad_files``. Output: record fields + ``_file``, ``_file_mtime``, ``_pos`` (0-based
    position inside the file) for arrival ordering. Like a multi-line JSON reader, a file is
    one task; files are landed per flush, so each is small (a single document must stay
    below the 2 GB text limit).
    """
    parsed = _documents(spark, path, schema)
    return (parsed.select("_file", "_file_mtime", F.posexplode("_recs").alias("_pos", "_r"))
            .select(*[F.col("_r").getField(f.name).alias(f.name) for f in schema.fields],
                    "_file", "_file_mtime", "_pos"))


def bad_files(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """Files of the ``array`` layout that ``read_array_files`` gets no record list from."""
    return _documents(spark, path, schema).where(F.col("_recs").isNull()).select("_file")


def read_json_lines(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """S1 for the ``lines`` layout (splittable); malformed lines are dropped by the parser."""
    df = spark.read.schema(_landed(schema)).option("mode", "DROPMALFORMED").json(path)
    return df.select(*schema.fieldNames(), BATCH, *ARRIVAL.fieldNames(), *_arrival_cols(df),
                     F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_pos"))


def _landed(schema: T.StructType) -> T.StructType:
    """Columns of a landing table: the record's, and those of its arrival (null in foreign files)."""
    return T.StructType([*schema.fields, *ARRIVAL.fields, T.StructField(BATCH, T.LongType())])


def read_landing(spark: SparkSession, path, schema: T.StructType, layout: str = "array") -> DataFrame:
    """One reader per layout (R20): ``array`` (foreign landing files), ``lines`` (JSON
    lines), ``parquet`` (our own landing table, columnar with pushdown)."""
    if layout == "array":
        return read_array_files(spark, path, schema)
    if layout == "lines":
        return read_json_lines(spark, path, schema)
    if layout == "parquet":
        return spark.read.schema(_landed(schema)).parquet(path).select(
            *schema.fieldNames(), BATCH, *ARRIVAL.fieldNames(), *_arrival_cols(None), F.col("_metadata.row_index").alias("_pos"))
    raise ValueError(f"unknown layout {layout!r}")


def load_or_empty(spark: SparkSession, path, schema: T.StructType, layout: str = "array") -> DataFrame:
    """A missing or empty location reads as an empty, typed DataFrame."""
    try:
        return read_landing(spark, path, schema, layout)
    except AnalysisException:
        empty = spark.createDataFrame([], schema)
        return empty.select("*", F.lit(None).cast("string").alias("_file"),
                            F.lit(None).cast("timestamp").alias("_file_mtime"),
                            F.lit(None).cast("int").alias("_pos"))


def record_counts(**datasets: DataFrame) -> DataFrame:
    """Rows per named dataset, as one small DataFrame (one aggregate job per dataset)."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("dataset"), "rows")
             for name, df in datasets.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def write_result(df: DataFrame, path: str, fmt: str = "json") -> None:
    """Overwrite a result table."""
    df.write.mode("overwrite").format(fmt).save(path)


def landing_inventory(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Files and whole KB per landing directory (file contents are never read)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return (files.select(F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("directory"), "length")
            .groupBy("directory")
            .agg(F.count(F.lit(1)).alias("files"),
                 F.floor(F.sum("length") / F.lit(1024)).cast("long").alias("size_kb")))
