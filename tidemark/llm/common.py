"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters that separate words and pad lines: space, tab, LF, VT, FF, CR.
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder for cut lineage that the cluster names; a local run without one gets a temporary folder."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="tidemark-checkpoint-"))
    return sc.getCheckpointDir()


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: computed once, survives lost executors, later plans start here."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ascii_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, as UTF-8; null has none."""
    return text.encode().lower().split() if text else []


#: A text longer than this is counted with numpy, so that no list of its words is made.
LONG_TEXT = 1 << 20


def count_words(text: str | None) -> int:
    """Number of ``[^\\x20\\x09-\\x0D]+`` runs; null and empty: 0."""
    if not text:
        return 0
    raw = text.encode()
    if len(raw) <= LONG_TEXT:
        return len(raw.split())
    total, before = 0, True
    for at in range(0, len(raw), LONG_TEXT):
        byte = np.frombuffer(raw, np.uint8, min(LONG_TEXT, len(raw) - at), at)
        blank = (byte == 32) | ((byte >= 9) & (byte <= 13))
        total += int(np.count_nonzero(blank[:-1] & ~blank[1:])) + int(before and not blank[0])
        before = bool(blank[-1])
    return total


def valid_vector(column: str):
    """True for vectors without null or non-finite components and with a component other than zero."""
    v = F.col(column)
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(v.isNotNull() & (F.size(v) > 0) & good & F.exists(v, lambda x: x != 0), F.lit(False))


def stack(vectors) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in vectors]) if len(vectors) else np.zeros((0, 1))


def other_columns(columns: list[str], *names: str) -> list[str]:
    """``columns`` but for ``names``, compared without case as Spark does."""
    return [c for c in columns if c.lower() not in {n.lower() for n in names}]


def kind_of(df: DataFrame, column: str):
    """The type of a column, found without case as Spark finds it."""
    return df.select(column).schema[0].dataType


def free_names(columns: list[str], *wanted: str) -> list[str]:
    """``wanted``, with as many underscores in front as keep each apart from ``columns`` and from one another."""
    taken, out = {c.lower() for c in columns}, []
    for name in wanted:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


#: Bytes of text that a Python worker works on at a time; a longer text is a slice of its own.
SLICE = 1 << 24


def text_slices(batches, column: str = "text", most: int = SLICE):
    """Record batches cut into slices with up to ``most`` bytes of text each, in order; none is empty."""
    for batch in batches:
        text = batch.column(column)
        ends = np.frombuffer(text.buffers()[1], np.int32, len(text) + 1 + text.offset)[text.offset :].astype(np.int64) if len(text) else np.zeros(1, np.int64)
        at = 0
        while at < len(text):
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + most, side="right")) - 1)
            yield batch.slice(at, to - at)
            at = to


def text_bytes(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets from 0) of an Arrow string array without nulls."""
    ends = np.frombuffer(text.buffers()[1], np.int32, len(text) + 1 + text.offset)[text.offset :]
    raw = text.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[ends[0] : ends[-1]], (ends - ends[0]).astype(np.int64)


def string_array(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """The Arrow string array of these UTF-8 bytes, without a copy of them."""
    return pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data))
