"""Results of costly stages kept under a fingerprint of all that they depend on.

A stage's result is stored as Parquet in a folder of its own, and only then is a small file put down that names the
folder under the fingerprint; nothing is renamed, so object stores will do. A stage that fails leaves no such file, and a
file that is torn or foreign, or names a folder that is gone, is a miss.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VERSION = 1


def content_digest(df: DataFrame) -> str:
    """Changes with any row, column or type; the order of rows and their partitions don't matter. One aggregate of two hashes a row."""
    flat = df.select([F.to_json(F.struct(c)).alias(c) if t.startswith("map") else F.col(c) for c, t in df.dtypes])
    row = F.struct(*flat.columns) if flat.columns else F.lit(0)
    two = flat.select(F.xxhash64(row).alias("a"), F.xxhash64(F.lit("second"), row).alias("b"))
    sums = two.agg(F.count("*").alias("n"), *[F.sum(F.col(c).cast("decimal(38,0)")).cast("string").alias(c) for c in ("a", "b")]).first()
    return hashlib.sha256(json.dumps([sorted(df.dtypes), sums["n"], sums["a"], sums["b"]]).encode()).hexdigest()


def fingerprint(stage: str, inputs: dict[str, DataFrame], settings: dict | None = None, version: int = VERSION) -> str:
    """Of the stage's name and code version, its settings and the content of its inputs."""
    parts = [version, stage, settings or {}, {name: content_digest(df) for name, df in sorted(inputs.items())}]
    return hashlib.sha256(json.dumps(parts, sort_keys=True, default=str).encode()).hexdigest()


class StageCache:
    """A folder that all executors share, of results by stage and fingerprint."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _entry(self, stage: str, key: str) -> str:
        return f"{self.root}/{stage}/{key}.json"

    def find(self, stage: str, key: str) -> DataFrame | None:
        """The result stored under a fingerprint, or None."""
        fs, path = self._fs(self._entry(stage, key))
        if not fs.exists(path):
            return None
        try:
            source = fs.open(path)
            try:
                entry = json.loads(bytes(source.readAllBytes()).decode())
            finally:
                source.close()
            folder = entry["folder"] if entry["format"] == VERSION and entry["key"] == key else None
        except (ValueError, KeyError, TypeError):
            return None
        if folder is None:
            return None
        data, at = self._fs(f"{self.root}/{stage}/{folder}")
        return self.spark.read.parquet(f"{self.root}/{stage}/{folder}") if data.exists(at) else None

    def put(self, stage: str, key: str, result: DataFrame) -> DataFrame:
        """Stores a result; raises, and stores nothing, if it can't be worked out."""
        folder = f"data-{uuid.uuid4().hex}"
        path = f"{self.root}/{stage}/{folder}"
        try:
            result.write.parquet(path)
        except Exception:
            fs, at = self._fs(path)
            fs.delete(at, True)
            raise
        fs, at = self._fs(self._entry(stage, key))
        out = fs.create(at, True)
        try:
            out.write(bytearray(json.dumps({"format": VERSION, "key": key, "folder": folder}).encode()))
        finally:
            out.close()
        return self.spark.read.parquet(path)

    def run(self, stage: str, inputs: dict[str, DataFrame], build: Callable[..., DataFrame], settings: dict | None = None, version: int = VERSION) -> tuple[DataFrame, bool]:
        """(result, whether it was there): ``build(**inputs)`` is called only if no result is stored for these inputs and settings."""
        key = fingerprint(stage, inputs, settings, version)
        found = self.find(stage, key)
        return (found, True) if found is not None else (self.put(stage, key, build(**inputs)), False)
