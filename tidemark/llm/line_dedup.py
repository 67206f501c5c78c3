"""Line dedup: range-partitioned line hashes, secondary sort by document and position, keep bitmaps.

DataFrame operations only. A line's key is the line without blanks at its ends and with A-Z lower-cased;
two independent 64-bit hashes stand for it. Occurrences are dealt into ranges of the salted hash and sorted by
hash, document and position inside, once: hashes are uniform, so the ranges' bounds are fixed and need no sample,
and the salt deals one very common line over ``SALTS`` ranges. A window streams over the sorted ranges and marks each
document's first occurrence; firsts are added up by line, with the salts that occur as bits of one number.
Documents get run-length-coded keep bitmaps, not texts.

Defined results: a null or empty text is one empty line; each row is a document, and rows with equal doc_id
count as one document for a line; null doc_id sorts below every id; texts of any length are split whole, a row
of them at a time; columns other than doc_id and text are ignored and kept, whatever their names; an empty table
gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BLANKS, LOWER, UPPER, free_names, other_columns, shuffle_partitions

#: Ranges that the occurrences of one line are dealt over: a power of two, at most 64.
SALTS = 64
MIN_CODE_POINTS = 40
MIN_DOCUMENTS = 5


def line_key(line: Column) -> Column:
    """Blanks stripped at both ends, A-Z lower-cased (``lower`` only where it can touch nothing else)."""
    bare = F.btrim(line, F.lit(BLANKS))
    return F.when(F.octet_length(bare) == F.length(bare), F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _streamed(docs: DataFrame, min_code_points: int) -> DataFrame:
    """Occurrences of lines, with ``first`` = 1 for the first one of a document in its range."""
    lines = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), _lines(F.col("text")).alias("lines"))
    # outer, as a text has a line at least, and Spark would split it once more to make sure
    found = lines.select("doc_id", "text_hash", F.size("lines").alias("n_lines"), F.posexplode_outer("lines").alias("pos", "line"))
    # a key is as long as its line without blanks, which is no longer than the line
    long_ = found.where(F.length("line") >= min_code_points).where(F.length(F.btrim("line", F.lit(BLANKS))) >= min_code_points)
    occurrences = long_.withColumn("key", line_key(F.col("line"))).select(
        F.xxhash64("key").alias("h1"),
        F.xxhash64(F.lit("line"), "key").alias("h2"),
        F.xxhash64("doc_id").bitwiseAND(SALTS - 1).cast("int").alias("salt"),
        "doc_id", "text_hash", "n_lines", "pos",
    )
    ranges = shuffle_partitions(docs.sparkSession)
    place = F.shiftrightunsigned(F.xxhash64("h1", "salt"), 33)  # 31 bits
    ranged = occurrences.withColumn("range", F.shiftright(place * ranges, 31).cast("int")).repartitionById(ranges, "range")
    # n_lines follows from the text; named here, both uses of the stream read the same columns and share one exchange
    order = ["doc_id", "text_hash", "pos", "n_lines"]
    stream = Window.partitionBy("range", "h1", "h2", "salt").orderBy(*order)
    again = (F.row_number().over(stream) > 1) & F.lag("doc_id").over(stream).eqNullSafe(F.col("doc_id"))
    return ranged.sortWithinPartitions("range", "h1", "h2", "salt", *order).withColumn("first", (~again).cast("int")).drop("range")


def keep_bitmaps(docs: DataFrame, min_code_points: int = MIN_CODE_POINTS, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """(doc_id, text_hash, n_lines, n_dropped, runs) of the documents that lose lines.

    ``runs`` is the keep bitmap as run lengths: kept, dropped, kept, ... lines in turn, starting with kept.
    ``text_hash`` (xxhash64) tells rows with the same doc_id and different texts apart.
    """
    streamed = _streamed(docs, min_code_points)
    salts = F.filter(F.sequence(F.lit(0), F.lit(SALTS - 1)), lambda s: F.getbit("salts", s) == 1)
    common = (
        streamed.groupBy("h1", "h2")
        .agg(F.sum("first").alias("n"), F.max("doc_id").alias("last"), F.bit_or(F.expr("shiftleft(1L, salt)")).alias("salts"))
        .where(F.col("n") >= min_documents)
        # joined by salt too, so that the occurrences of a very common line stay dealt
        .select("h1", "h2", "last", F.explode(salts).alias("salt"))
    )
    dropped = streamed.join(common, ["h1", "h2", "salt"]).where(~F.col("doc_id").eqNullSafe(F.col("last")))
    per_doc = dropped.groupBy("doc_id", "text_hash").agg(
        F.first("n_lines").alias("n_lines"), F.sort_array(F.collect_set("pos")).alias("at")
    )
    # neighbours are zipped in, so that no lambda looks into an array from outside
    null = F.array(F.lit(None).cast("int"))
    zipped = F.arrays_zip(
        F.col("at"),
        F.slice(F.concat(null, "at"), F.lit(1), F.size("at")).alias("before"),
        F.slice(F.concat("at", null), F.lit(2), F.size("at")).alias("after"),
    )
    step = per_doc.withColumn("z", zipped)
    starts = F.transform(F.filter("z", lambda z: z["before"].isNull() | (z["before"] != z["at"] - 1)), lambda z: z["at"])
    ends = F.transform(F.filter("z", lambda z: z["after"].isNull() | (z["after"] != z["at"] + 1)), lambda z: z["at"] + 1)
    step = step.withColumn("s", starts).withColumn("e", ends)
    kept_from = F.concat(F.array(F.lit(0)), "e")
    kept_to = F.concat("s", F.array("n_lines"))
    runs = F.flatten(
        F.transform(
            F.arrays_zip(kept_from.alias("a"), kept_to.alias("b"), F.concat("e", F.array("n_lines")).alias("c")),
            lambda z: F.array(z["b"] - z["a"], z["c"] - z["b"]),
        )
    )
    return step.select("doc_id", "text_hash", "n_lines", F.size("at").cast("long").alias("n_dropped"), runs.alias("runs"))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, n_lines: str = "n_lines", n_dropped: str = "n_dropped") -> DataFrame:
    """``docs`` with text replaced by its kept lines, plus two columns (long) of the names given: lines before, and dropped.

    They replace columns of these names; all others stay.
    """
    doc, text_hash, dropped, runs = free_names([*docs.columns, n_lines, n_dropped], "doc", "text_hash", "dropped", "runs")
    hit = bitmaps.toDF(*[f"b_{c}" for c in bitmaps.columns]).select(
        F.col("b_doc_id").alias(doc), F.col("b_text_hash").alias(text_hash), F.col("b_n_dropped").alias(dropped), F.col("b_runs").alias(runs)
    )
    joined = docs.join(hit, docs["doc_id"].eqNullSafe(F.col(doc)) & (F.xxhash64(docs["text"]) == F.col(text_hash)), "left")
    lines = _lines(docs["text"])
    flags = F.flatten(F.transform(runs, lambda n, i: F.array_repeat(i % 2 == 0, n)))
    kept = F.transform(
        F.filter(F.arrays_zip(lines.alias("l"), flags.alias("f")), lambda z: z["f"]), lambda z: z["l"]
    )
    text = F.when(F.col(runs).isNull(), docs["text"]).otherwise(F.array_join(kept, "\n"))
    return joined.select(
        *[text.alias(c) if c.lower() == "text" else docs[c] for c in other_columns(docs.columns, n_lines, n_dropped)],
        F.size(lines).cast("long").alias(n_lines),
        F.coalesce(dropped, F.lit(0)).cast("long").alias(n_dropped),
    )


def drop_common_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with the same columns, common lines left out of every document but the largest that holds them."""
    two = free_names(docs.columns, "n_lines", "n_dropped")
    return apply_bitmaps(docs, keep_bitmaps(docs), *two).drop(*two)
