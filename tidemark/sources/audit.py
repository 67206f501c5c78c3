"""Reading folders of files of which some may be torn, foreign or empty: the rows, and beside them what became of each file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .catalog import read_lines

#: First and last bytes of a Parquet file (fixed value), and files whose bytes are looked at together.
MAGIC, AT_ONCE = "50415231", 10_000


def _listed(spark: SparkSession, reader: DataFrame) -> DataFrame:
    """(file) of all files that a reader was pointed at, those without bytes among them, as Spark's own listing has them."""
    return spark.createDataFrame([(f,) for f in reader.inputFiles()], "file string")


def _path(column: str):
    """Scheme and path alike for listings and metadata."""
    return F.regexp_replace(F.try_url_decode(F.replace(F.col(column), F.lit("+"), F.lit("%2B"))), "^file:/+", "file:/")


def _outcomes(listed: DataFrame, counts: DataFrame) -> DataFrame:
    got = counts.select(_path("file").alias("_f"), "n_rows", "n_bad")
    met = listed.withColumn("file", _path("file")).join(got, F.col("file") == F.col("_f"), "left").drop("_f")
    return met.fillna(0, ["n_rows", "n_bad"])


def read_lines_audited(spark: SparkSession, path: str, schema: StructType, pattern: str = "*.json*") -> tuple[DataFrame, DataFrame]:
    """(rows, outcomes) of JSON lines: rows as the contract's columns with ``file``; (file, outcome, n_rows, n_bad) of each file.

    ``read``: every line; ``torn``: some lines are no records, which are left out and counted; ``foreign``: none is;
    ``empty``: no lines.
    """
    text = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).text(path)
    lines = text.where("trim(value) <> ''").select("value", F.col("_metadata.file_path").alias("file"))
    parsed = read_lines(lines, "value", ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema))
    counts = parsed.groupBy("file").agg(F.count_if(~F.col("is_torn")).alias("n_rows"), F.count_if("is_torn").alias("n_bad"))
    outcome = F.when(F.col("n_rows") + F.col("n_bad") == 0, "empty").when(F.col("n_rows") == 0, "foreign").when(F.col("n_bad") > 0, "torn").otherwise("read")
    rows = parsed.where("not is_torn").select(*[F.col("record")[f.name].alias(f.name) for f in schema], "file")
    return rows, _outcomes(_listed(spark, text), counts).select("file", outcome.alias("outcome"), "n_rows", "n_bad")


def read_parquet_audited(spark: SparkSession, path: str, schema: StructType, pattern: str = "*.parquet") -> tuple[DataFrame, DataFrame]:
    """(rows, outcomes) of Parquet files: rows as the contract's columns with ``file``; (file, outcome, n_rows, n_bad) of each file.

    ``read``: it gave rows; ``empty``: framed as Parquet without a row that can be read; ``torn``: it begins but doesn't end as
    Parquet; ``foreign``: it doesn't begin so, or has no bytes. Only the bytes of files that gave no row are looked at.
    """
    reader = spark.read.schema(schema).option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).option("ignoreCorruptFiles", "true").option("ignoreMissingFiles", "true")
    whole = reader.parquet(path)
    rows = whole.select(*schema.names, F.col("_metadata.file_path").alias("file"))
    counts = rows.groupBy("file").agg(F.count("*").alias("n_rows"), F.lit(0).cast("long").alias("n_bad"))
    found = _outcomes(_listed(spark, whole), counts)
    silent = [r["file"] for r in found.where("n_rows = 0").select("file").toLocalIterator()]
    kinds = spark.createDataFrame([], "_f string, kind string")
    for at in range(0, len(silent), AT_ONCE):
        raw = spark.read.format("binaryFile").load(silent[at : at + AT_ONCE])
        head, tail = F.lower(F.hex(F.substring("content", 1, 4))), F.lower(F.hex(F.expr("substring(content, -4, 4)")))
        kind = F.when(~head.eqNullSafe(F.lit(MAGIC)), "foreign").when(~tail.eqNullSafe(F.lit(MAGIC)) | (F.col("length") < 12), "torn").otherwise("whole")
        kinds = kinds.unionByName(raw.select(_path("path").alias("_f"), kind.alias("kind")))
    met = found.join(kinds, F.col("file") == F.col("_f"), "left").drop("_f")
    outcome = F.when(F.col("n_rows") > 0, "read").when(F.col("kind") == "whole", "empty").otherwise(F.coalesce("kind", F.lit("foreign")))
    return rows, met.select("file", outcome.alias("outcome"), "n_rows", "n_bad")
