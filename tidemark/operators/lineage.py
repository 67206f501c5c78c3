"""Who owned the lines that a change replaced: ownership by line as it was before each change."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

#: Lines of a path that are worked on together.
BLOCK = 256


def _owned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of ranges (_path, _block, t, change, a, b), sorted by all but the lines, to (change, t, owner, owner_t, n_lines).

    Only the last writers of the block that a batch ends in are carried on to the next one.
    """
    held = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        n_held = 0 if held is None else held.num_rows
        both = (rows if held is None else pa.concat_tables([held, rows])).combine_chunks()
        if not both.num_rows:
            continue

        n_rows = both.num_rows

        def starts(*names: str, both=both, n_rows=n_rows) -> np.ndarray:
            """Numbers of runs of rows that have the same columns."""
            out = np.zeros(n_rows, bool)
            for c in (both[n].combine_chunks() for n in names):
                x, y = c.slice(1), c.slice(0, n_rows - 1)
                alike = pc.or_(pc.fill_null(pc.equal(x, y), False), pc.and_(pc.is_null(x), pc.is_null(y)))
                out[1:] |= ~alike.to_numpy(zero_copy_only=False)
            return np.cumsum(out)

        group, writer = starts("_path", "_block"), starts("_path", "_block", "t", "change")
        first, last = (both[c].to_numpy().astype(np.int64) for c in ("a", "b"))
        size = last - first + 1
        row = np.repeat(np.arange(n_rows), size)
        line = np.arange(size.sum()) + np.repeat(first - np.cumsum(size) + size, size)
        # one number a line: its place in the group, then its row
        cells = np.sort((group[row] * BLOCK + line) * n_rows + row)
        place, row = cells // n_rows, cells % n_rows
        # a line that a change writes twice counts once, at its first writing
        once = np.ones(len(row), bool)
        once[1:] = (place[1:] != place[:-1]) | (writer[row[1:]] != writer[row[:-1]])
        place, row = place[once], row[once]
        at = np.flatnonzero((place[1:] == place[:-1]) & (row[1:] >= n_held)) + 1
        pairs, n = np.unique(row[at] * n_rows + row[at - 1], return_counts=True)
        mine, theirs = both.select(["change", "t"]).take(pairs // n_rows), both.select(["change", "t"]).take(pairs % n_rows)
        yield from pa.table({"change": mine["change"], "t": mine["t"], "owner": theirs["change"], "owner_t": theirs["t"], "n_lines": n}).to_batches()
        final = np.ones(len(row), bool)
        final[:-1] = place[1:] != place[:-1]
        final &= place // BLOCK == group[-1]
        kept = np.argsort(row[final], kind="stable")
        held = both.take(row[final][kept])
        for c in ("a", "b"):
            held = held.set_column(held.schema.get_field_index(c), held.schema.field(c), pa.array(place[final][kept] % BLOCK, held.schema.field(c).type))


def line_owners(changes: DataFrame, path: str, change: str, at: str, first: str, last: str) -> DataFrame:
    """(change, t, owner, owner_t, n_lines): for each change at its time, the earlier changes whose lines it replaced, and how many of theirs.

    ``changes``: a row for each range of lines ``first`` to ``last`` of a path that a change wrote at a time; ranges
    of one change may overlap, and count once. A line belongs to the change that wrote it last; of changes at one time
    the one with the greater id is later. Lines are numbered as they stood when the range was written. Ranges are cut into
    blocks of lines and sorted by path, block and time; a task holds the last writers of one block, so lines are
    neither shuffled nor sorted by Spark. Null or empty ranges hold no lines.
    """
    blocks = F.when(F.col(last) >= F.col(first), F.sequence(F.floor(F.col(first) / BLOCK), F.floor(F.col(last) / BLOCK)))
    cut = changes.select(F.col(path).alias("_path"), F.col(change).alias("change"), F.col(at).alias("t"), F.col(first).alias("_a"), F.col(last).alias("_b"), F.explode(blocks).alias("_block"))
    start = F.col("_block") * BLOCK
    pieces = cut.select("_path", "_block", "t", "change", (F.greatest(F.col("_a"), start) - start).cast("int").alias("a"), (F.least(F.col("_b"), start + BLOCK - 1) - start).cast("int").alias("b"))
    by = pieces.repartition("_path", "_block").sortWithinPartitions("_path", "_block", "t", "change")
    kinds = {f.name: f.dataType for f in pieces.schema}
    made = StructType([StructField("change", kinds["change"]), StructField("t", kinds["t"]), StructField("owner", kinds["change"]), StructField("owner_t", kinds["t"]), StructField("n_lines", LongType())])
    owned = by.mapInArrow(_owned, made)
    # by change alone: what is added up or joined by change next needs no further exchange
    return owned.repartition("change").groupBy("change", "t", "owner", "owner_t").agg(F.sum("n_lines").alias("n_lines"))


def earliest_fix(owners: DataFrame, fixes: DataFrame, landed: DataFrame, within: int) -> DataFrame:
    """(change, fix, delay): the first fix (change, t) that replaced lines of a change after it had landed (change, landed) and
    at most ``within`` seconds later; of fixes at one time the smaller id."""
    f = fixes.select(F.col("change").alias("fix"), F.col("t").alias("fixed"))
    met = owners.join(f, F.col("change") == F.col("fix")).drop("change", "t").join(landed.select(F.col("change"), "landed"), F.col("owner") == F.col("change"))
    delay = F.col("fixed") - F.col("landed")
    good = met.where((delay > 0) & (delay <= within))
    return good.groupBy("change").agg(F.min(F.struct(delay.alias("delay"), "fix")).alias("s")).select("change", "s.fix", "s.delay")
