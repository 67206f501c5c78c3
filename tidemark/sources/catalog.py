"""Catalog over stored files: planning by path, versions, union by name, upserts, atomic replacement."""

from __future__ import annotations

import json
import re
import time
import uuid
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.text import folder_version_key


def plan(keys: DataFrame, finished: DataFrame | None = None) -> DataFrame:
    """``key`` paths <unit>/<version>/<split>/data/<file> -> (unit, version, split, file, table, key), finished units only if given."""
    p = F.split("key", "/")
    file = F.element_at(p, -1)
    table = (
        F.when(file.rlike("_snapshots\\.parquet$"), "snapshots").when(file.rlike("_commit_features\\.parquet$"), "commit_features").when(file.rlike("\\.parquet$"), "dataset")
    )
    out = keys.where(F.col("key").rlike("^[^/]+/[^/]+/[^/]+/data/[^/]+$")).select(F.get(p, F.lit(0)).alias("unit"), F.get(p, F.lit(1)).alias("version"), F.get(p, F.lit(2)).alias("split"), file.alias("file"), table.alias("table"), "key").where("table is not null")
    return out if finished is None else out.join(finished.select("unit"), "unit", "left_semi")


def newest_version(planned: DataFrame) -> DataFrame:
    """The version that is last when numeric parts compare as numbers."""
    return planned.agg(F.max_by("version", folder_version_key(F.col("version"))).alias("version"))


def read_by_name(spark: SparkSession, paths: list[str], schema: StructType) -> DataFrame:
    """Files with differing columns as one relation of the contract's columns, cast, with the file's name."""
    def one(path: str) -> DataFrame:
        df = spark.read.parquet(path)
        columns = [(F.col(f.name).try_cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema]
        return df.select(*columns, F.col("_metadata.file_path").alias("filename"))

    return reduce(DataFrame.unionByName, map(one, paths)) if paths else spark.createDataFrame([], StructType(schema.fields).add("filename", "string"))


def last_wins(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One row a key: the one that came last; ties go to the larger row."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(order), *[F.desc(c) for c in rows.columns if c not in keys]))
    return rows.withColumn("_r", rank).where("_r = 1").drop("_r")


def upsert(existing: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """New rows replace those of their keys; missing columns become null."""
    both = existing.withColumn("_o", F.lit(0)).unionByName(new.withColumn("_o", F.lit(1)), allowMissingColumns=True)
    return last_wins(both, keys, "_o").drop("_o")


def file_system(spark: SparkSession, path: str):
    """(file system, path) of Hadoop's interface."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


#: Seconds that a generation stays readable after another has taken its place.
LEASE = 86_400


def _commits(spark: SparkSession, root: str) -> list[tuple[int, dict, float]]:
    """(number, entry, time in seconds) of whole commits, newest first; torn files don't count."""
    fs, folder = file_system(spark, f"{root}/commits")
    out = []
    for status in fs.listStatus(folder) if fs.exists(folder) else []:
        name = status.getPath().getName()
        if re.fullmatch(r"\d+\.json", name):
            source = fs.open(status.getPath())
            try:
                entry = json.loads(bytes(source.readAllBytes()).decode())
                out.append((int(name[:-5]), {"generation": entry["generation"], "tables": entry["tables"]}, status.getModificationTime() / 1000))
            except (ValueError, KeyError, TypeError):
                continue
            finally:
                source.close()
    return sorted(out, key=lambda c: -c[0])


def replace_tables(tables: dict[str, DataFrame], root: str, lease: float = LEASE) -> str:
    """All tables of ``root`` at once; the name of the new generation.

    Every table is written to a new generation's folder, and then a commit is put down: a small file with the next free number,
    made only if it is not there yet, so no rename is needed and of two writers each gets a number of its own. The
    greatest whole commit is the current one: readers see all old or all new tables, and a crash at any moment leaves
    one of both. Tables that are not given are gone in the new generation. Older generations stay for ``lease`` seconds
    after another took their place, for those who still read them.
    """
    spark = next(iter(tables.values())).sparkSession
    name = f"generation-{uuid.uuid4().hex}"
    for table, df in tables.items():
        df.write.parquet(f"{root}/{name}/{table}")
    fs, folder = file_system(spark, f"{root}/commits")
    fs.mkdirs(folder)
    number = max((int(s.getPath().getName()[:-5]) for s in fs.listStatus(folder) if re.fullmatch(r"\d+\.json", s.getPath().getName())), default=0)
    while True:
        number += 1
        try:
            out = fs.create(file_system(spark, f"{root}/commits/{number}.json")[1], False)
        except Py4JJavaError as e:
            if "AlreadyExists" not in e.java_exception.getClass().getName():
                raise
            continue
        out.write(bytearray(json.dumps({"generation": name, "tables": sorted(tables)}).encode()))
        out.close()
        vacuum(spark, root, lease)
        return name


def vacuum(spark: SparkSession, root: str, lease: float = LEASE) -> None:
    """Deletes generations that were replaced, or written without a commit, more than ``lease`` seconds ago."""
    commits, now = _commits(spark, root), time.time()
    fs, folder = file_system(spark, root)
    kept = {commits[0][1]["generation"]} if commits else set()
    for (_, _, replaced), (number, entry, _) in zip(commits, commits[1:], strict=False):
        if replaced > now - lease:
            kept.add(entry["generation"])
        else:
            fs.delete(file_system(spark, f"{root}/commits/{number}.json")[1], False)
    committed = {c[1]["generation"] for c in commits}
    for status in fs.listStatus(folder):
        name = status.getPath().getName()
        if name.startswith("generation-") and name not in kept and (name in committed or status.getModificationTime() / 1000 <= now - lease):
            fs.delete(status.getPath(), True)


def current_generation(spark: SparkSession, root: str) -> str | None:
    commits = _commits(spark, root)
    return commits[0][1]["generation"] if commits else None


def current_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A table of the current generation; a missing one is an error of Spark's reader."""
    return spark.read.parquet(f"{root}/{current_generation(spark, root)}/{table}")


def is_finished(status: Column) -> Column:
    """A run's status text says that all is done: its reason, and nothing failed or deferred. Torn or null text is not finished."""
    s = F.from_json(status, "reason string, files_failed string, files_deferred string")
    none = [F.coalesce(s[c].isin("0", "[]", "false", "null", ""), F.lit(True)) for c in ("files_failed", "files_deferred")]
    return F.coalesce((s["reason"] == "batch done") & none[0] & none[1], F.lit(False))


def catalogue(planned: DataFrame, finished: DataFrame) -> DataFrame:
    """(version, split, n_files, n_finished) of planned files."""
    done = finished.select(F.col("unit").alias("_u")).distinct().withColumn("_f", F.lit(1))
    return planned.join(done, F.col("unit") == F.col("_u"), "left").groupBy("version", "split").agg(F.count("*").alias("n_files"), F.count("_f").alias("n_finished"))


def read_lines(lines: DataFrame, column: str, schema: str) -> DataFrame:
    """``lines`` with ``record`` (null if torn or foreign) and ``is_torn``; blank lines are neither."""
    record = F.from_json(F.col(column), f"{schema}, _torn string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_torn"})
    read = lines.withColumn("_read", record)
    torn = F.col("_read._torn").isNotNull()
    return read.withColumn("is_torn", F.coalesce(torn, F.lit(False))).withColumn("record", F.when(~F.col("is_torn"), F.col("_read"))).drop("_read")


def read_rows(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Parquet, or JSON lines for other names, as the contract's columns; files that can't be read are skipped, and no file gives no row."""
    reader = spark.read.option("ignoreCorruptFiles", "true").option("ignoreMissingFiles", "true").schema(schema)
    fs, target = file_system(spark, path)
    if not fs.exists(target):
        return spark.createDataFrame([], schema)
    return reader.parquet(path) if path.endswith(".parquet") else reader.option("mode", "DROPMALFORMED").json(path)


def siblings(spark: SparkSession, path: str) -> dict[str, str]:
    """Paths of a dataset and of those of its sibling tables that exist."""
    stem = path.removesuffix(".parquet")
    named = {"dataset": path, **{n: f"{stem}_{n}.parquet" for n in ("snapshots", "commit_features")}}
    return {n: p for n, p in named.items() if (at := file_system(spark, p))[0].exists(at[1])}


NESTED = re.compile(r"\([^()]*[+*}][^()]*\)[+*{]")


def search(lines: DataFrame, column: str, pattern: str, order: list[str], hits: int) -> DataFrame:
    """The first ``hits`` lines, in order, that match; patterns with a repeated group that itself repeats are refused."""
    if NESTED.search(pattern):
        raise ValueError("a repeated group holds another repetition")
    return lines.where(F.col(column).rlike(pattern)).orderBy(*order).limit(hits)
