"""Ranked lexical search by Block-Max WAND over compressed posting blocks.

Documents are indexed in segments of up to ``SEGMENT`` bytes of text, numbered by ascending doc_id inside; a segment
has a row for each term: its postings in blocks of ``BLOCK`` documents, compressed (gaps and frequencies in as few bytes
as the block needs), and a directory of each block's last document and greatest impact, and one row for its documents. Segments are made as tasks read
the documents, without an exchange.

A search takes every item against every segment, items in blocks of ``ITEMS``: rows of terms that items hold go to groups
of one segment and one block of items. There each item is searched by Block-Max WAND. Cursors stand in the order of their documents; the
pivot is the first document at which the terms' greatest impacts reach the tenth best score so far; the cursors'
block pointers then move to the pivot's block in the directory alone (a shallow move), and only if these blocks' greatest
impacts reach that score as well are blocks decompressed and the document scored; otherwise all cursors pass the nearest
block end unread. A score equal to the tenth best is passed over only where doc_ids have gone beyond that of the tenth. A
segment returns its ten best documents for an item, and the ten best of these are the result.

Scores are 64-bit integers; a term's weight counts as often as the item repeats it.

Defined results: a null or empty text has no terms, and such a document is not counted; each row is a document, rows
with equal doc_id are ranked each; a null doc_id comes after all others where scores are equal; an item without terms that
occur has no rows, items with equal item_id and text count once, with equal item_id and other texts are ranked apart; texts of any length are
indexed whole; other columns are ignored, whatever their names; empty tables give an empty result.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections import OrderedDict, defaultdict
from operator import attrgetter

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from .common import LOWER, UPPER, kind_of, materialize, shuffle_partitions, string_array, text_bytes, text_slices

#: Results of an item; postings of a block; bytes of text of a segment; items searched together.
TOP, BLOCK, SEGMENT, ITEMS = 10, 128, 1 << 25, 1024
#: Decompressed blocks that a search keeps.
KEPT = 2048
#: Terms of all items up to which their list is broadcast.
BROADCAST = 200_000
#: Past all documents of a segment.
END = 1 << 62

POSTINGS = "segment long, term string, df long, lasts binary, maxima binary, ends binary, blocks binary, lengths binary"


def _term_bytes() -> np.ndarray:
    """What becomes of each byte: digits, letters in lower case and bytes of other code points stay, the rest parts terms."""
    table = np.arange(256, dtype=np.uint8)
    table[:0x80] = 32
    for first, last in ((0x30, 0x39), (0x61, 0x7A)):
        table[first : last + 1] = np.arange(first, last + 1)
    table[0x41:0x5B] = np.arange(0x61, 0x7B)
    return table


TERM_BYTES = _term_bytes()


def term_lists(text: pa.Array) -> pa.Array:
    """Lists of the terms of each text; a term may be empty, and is none then."""
    data, offsets = text_bytes(text)
    return pc.ascii_split_whitespace(string_array(TERM_BYTES[data], offsets))


def counted_pairs(text: pa.Array, number: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """(terms, terms of each document, pairs, frequencies): a pair is the place of a term times the documents plus the
    document's ``number``; pairs are in order. What is needed on the way is freed on return."""
    lists = term_lists(text)
    doc = np.repeat(number, np.diff(lists.offsets.to_numpy()))
    coded = lists.flatten().dictionary_encode()
    del lists
    pairs = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    terms = coded.dictionary
    del coded
    empty = terms.index("").as_py() if len(terms) else -1
    if empty >= 0:
        full = pairs != empty
        pairs, doc = pairs[full], doc[full]
    n_of = np.bincount(doc, minlength=len(number))
    pairs *= len(number)
    pairs += doc
    del doc
    pairs.sort()
    first = np.flatnonzero(np.concatenate([pairs[:1] == pairs[:1], pairs[1:] != pairs[:-1]]))
    return terms, n_of, pairs[first], np.diff(np.append(first, len(pairs)))


def terms_of(text: Column) -> Column:
    """The terms of a text, with repeats, as DataFrame functions."""
    parts = F.split(F.translate(text, UPPER, LOWER), "[\\x00-/:-@\\[-`{-\\x7f]+")
    return F.filter(parts, lambda t: t != "")


def corpus_size(docs: DataFrame) -> tuple[int, int]:
    """(documents with a term, terms with repeats)."""

    def counted(batches):
        for batch in text_slices(batches):
            data, offsets = text_bytes(batch.column("text"))
            inside = TERM_BYTES[data] != 32
            starts = inside.copy()
            starts[1:] &= ~inside[:-1]
            heads = offsets[:-1][np.diff(offsets) > 0]
            starts[heads] = inside[heads]
            before = np.concatenate([[0], np.cumsum(starts)])
            n = before[offsets[1:]] - before[offsets[:-1]]
            yield pa.RecordBatch.from_arrays([pa.array([int((n > 0).sum())]), pa.array([int(n.sum())])], names=["n", "l"])

    got = docs.where(F.col("text").isNotNull()).select("text").mapInArrow(counted, "n long, l long").agg(F.sum("n").alias("n"), F.sum("l").alias("l")).first()
    return got["n"] or 0, got["l"] or 0


def length_part(n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    return 100 - 75 + (75 * n * n_docs) // max(1, n_terms)


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def _little(out: np.ndarray, at: np.ndarray, values: np.ndarray, width: int) -> None:
    for k in range(width):
        out[at + k] = (values >> (8 * k)) & 255


def compressed(gaps: np.ndarray, tfs: np.ndarray, block_of: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, end of each block): a byte with both widths, the gaps, and the frequencies less one unless all are zero."""
    first = np.cumsum(sizes) - sizes
    more = tfs - 1

    def widths(values, least):
        most = np.maximum.reduceat(values, first) if len(first) else np.zeros(0, np.int64)
        return np.select([most == 0, most < 1 << 8, most < 1 << 16], [least, 1, 2], 4)

    gap_width, tf_width = widths(gaps, 1), widths(more, 0)
    ends = np.cumsum(1 + sizes * (gap_width + tf_width))
    start = ends - (1 + sizes * (gap_width + tf_width))
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    out[start] = gap_width * 8 + tf_width
    place = np.arange(len(gaps)) - first[block_of]
    for width in (1, 2, 4):
        own = np.flatnonzero(gap_width[block_of] == width)
        _little(out, start[block_of[own]] + 1 + place[own] * width, gaps[own], width)
        own = np.flatnonzero(tf_width[block_of] == width)
        b = block_of[own]
        _little(out, start[b] + 1 + sizes[b] * gap_width[b] + place[own] * width, more[own], width)
    return out, ends


def decompressed(raw: bytes, size: int, after: int) -> tuple[np.ndarray, np.ndarray]:
    """(documents, frequencies) of a block of ``size`` postings that comes after document ``after``."""
    gap_width, tf_width = divmod(raw[0], 8)
    gaps = np.frombuffer(raw, f"<u{gap_width}", size, 1)
    tfs = np.frombuffer(raw, f"<u{tf_width}", size, 1 + size * gap_width).astype(np.int64) + 1 if tf_width else np.ones(size, np.int64)
    return after + np.cumsum(gaps.astype(np.int64) + 1), tfs


def _binary(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Binary array of the bytes of ``values``, cut at ``ends`` (in values)."""
    offsets = np.concatenate([[0], ends]) * values.dtype.itemsize
    return pa.BinaryArray.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


def build_index(docs: DataFrame, n_docs: int, n_terms: int, segment_bytes: int = SEGMENT, block: int = BLOCK) -> DataFrame:
    """Segments as rows (segment, term, df, lasts, maxima, ends, blocks) of each term of each, and (segment, "", documents, ..., lengths, ids).

    ``lasts``, ``maxima``, ``ends``: 32-bit integers of each block: last document (by its number in the segment), greatest
    impact, end of its bytes. ``lengths``: what length does to the impact of each document, 64-bit; ``ids``: their doc_ids as text.
    """

    def index(batches):
        made, part = 0, TaskContext.get().partitionId()
        for batch in text_slices(batches, most=segment_bytes):
            ids = batch.column("doc_id")
            order = pc.sort_indices(ids, null_placement="at_end")
            number = np.empty(len(ids), np.int64)
            number[order.to_numpy()] = np.arange(len(ids))
            terms, n_of, pairs, tf = counted_pairs(batch.column("text"), number)
            m = length_part(n_of, n_docs, n_terms)
            code, doc = np.divmod(pairs, max(1, len(ids)))
            heads = np.flatnonzero(np.diff(code, prepend=-1))
            df = np.diff(np.append(heads, len(code)))
            within = np.arange(len(code)) - np.repeat(heads, df)
            starts = np.flatnonzero(within % block == 0)
            sizes = np.diff(np.append(starts, len(code)))
            block_of = np.repeat(np.arange(len(starts)), sizes)
            gaps = np.where(within == 0, doc, np.diff(doc, prepend=0) - 1)
            raw, ends = compressed(gaps, tf, block_of, sizes)
            n_blocks = -(-df // block)
            block_ends = np.cumsum(n_blocks)
            term_bytes = np.concatenate([[0], ends])[block_ends]
            first_byte = np.concatenate([[0], term_bytes])[:-1]
            own_ends = ends - np.repeat(first_byte, n_blocks)
            maxima = np.maximum.reduceat(impact(tf, m[doc]), starts) if len(starts) else np.zeros(0, np.int64)
            segment, made = (part << 32) + made, made + 1
            n = len(heads)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, segment)), terms.take(pa.array(code[heads])).cast(pa.string()), pa.array(df), _binary(doc[starts + sizes - 1].astype("<i4"), block_ends),
                 _binary(maxima.astype("<i4"), block_ends), _binary(own_ends.astype("<i4"), block_ends), _binary(raw, term_bytes), pa.nulls(n, pa.binary()), pa.nulls(n, pa.list_(pa.string()))],
                names=[*[c.split()[0] for c in POSTINGS.split(", ")], "ids"],
            )
            yield pa.RecordBatch.from_arrays(
                [pa.array([segment]), pa.array([""]), pa.array([len(ids)]), *[pa.nulls(1, pa.binary())] * 4, pa.array([m.astype("<i8").tobytes()], pa.binary()),
                 pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), batch.column("name").take(order))],
                names=[*[c.split()[0] for c in POSTINGS.split(", ")], "ids"],
            )

    named = docs.where(F.col("text").isNotNull()).select("doc_id", F.col("doc_id").cast("string").alias("name"), "text")
    return named.mapInArrow(index, f"{POSTINGS}, ids array<string>")


class Postings:
    """A term's blocks in a segment; blocks that were decompressed are kept for other items, ``KEPT`` in all."""

    def __init__(self, df: int, lasts: bytes, maxima: bytes, ends: bytes, blocks: bytes, m: np.ndarray, kept: OrderedDict, block: int):
        self.df, self.raw, self.m, self.kept, self.block = df, blocks, m, kept, block
        self.lasts, self.maxima, self.ends = (np.frombuffer(x, "<i4").tolist() for x in (lasts, maxima, ends))
        self.greatest = max(self.maxima)

    def read(self, b: int) -> tuple[list[int], list[int]]:
        """(documents, impacts) of a block."""
        key = (id(self), b)
        if key in self.kept:
            self.kept.move_to_end(key)
            return self.kept[key]
        size = min(self.block, self.df - b * self.block)
        docs, tfs = decompressed(self.raw[self.ends[b - 1] if b else 0 : self.ends[b]], size, self.lasts[b - 1] if b else -1)
        self.kept[key] = out = docs.tolist(), impact(tfs, self.m[docs]).tolist()
        if len(self.kept) > KEPT:
            self.kept.popitem(last=False)
        return out


class Cursor:
    """A place in a term's postings.

    ``doc``: the document there if ``known``, else none of the term's documents from here to it was passed over;
    ``pointer``: the block that a shallow move has come to; ``docs``, ``impacts``: the block that was read last.
    """

    __slots__ = ("at", "block", "doc", "docs", "impacts", "known", "pointer", "postings", "top", "weight")

    def __init__(self, postings: Postings, weight: int):
        self.postings, self.weight, self.top = postings, weight, weight * postings.greatest
        self.pointer, self.block, self.at, self.doc, self.known = 0, -1, 0, 0, False

    def shallow(self, doc: int) -> int:
        """The greatest score in the block where ``doc`` would be, found in the directory; 0 past the last block."""
        lasts = self.postings.lasts
        if self.pointer < len(lasts) and lasts[self.pointer] < doc:
            self.pointer = bisect_left(lasts, doc, self.pointer + 1)
        return self.weight * self.postings.maxima[self.pointer] if self.pointer < len(lasts) else 0

    def block_end(self) -> int:
        lasts = self.postings.lasts
        return lasts[self.pointer] if self.pointer < len(lasts) else END

    def skip(self, doc: int) -> None:
        """Not before ``doc``; nothing is read."""
        if doc > self.doc:
            self.shallow(doc)
            lasts = self.postings.lasts
            if self.pointer >= len(lasts):
                self.doc, self.known = END, True
            elif self.pointer and lasts[self.pointer - 1] >= doc:
                self.doc, self.known = lasts[self.pointer - 1] + 1, False
            else:
                self.doc, self.known = doc, False

    def seek(self, doc: int) -> None:
        """To the first document from ``doc`` on."""
        self.shallow(doc)
        if self.pointer >= len(self.postings.lasts):
            self.doc, self.known = END, True
            return
        if self.pointer != self.block:
            self.block, self.at = self.pointer, 0
            self.docs, self.impacts = self.postings.read(self.block)
        self.at = bisect_left(self.docs, doc, self.at)
        self.doc, self.known = self.docs[self.at], True


def search_segment(terms: list[tuple[Postings, int]], top: int = TOP) -> list[tuple[int, int]]:
    """(score, document) of the ``top`` best documents of a segment, best first, equal scores by the smaller document.

    Documents are scored in ascending order, so a later one with a score equal to the least held is worse than it.
    """
    cursors = [Cursor(p, w) for p, w in terms]
    place = attrgetter("doc")
    best: list[tuple[int, int]] = []  # (score, -document), least first
    enough = 1  # the score that a document needs
    while True:
        cursors.sort(key=place)
        total, k, n = 0, -1, len(cursors)
        for k, c in enumerate(cursors):
            total += c.top
            if total >= enough:
                break
        else:
            break
        pivot = cursors[k].doc
        if pivot == END:
            break
        while k + 1 < n and cursors[k + 1].doc == pivot:
            k += 1
        there = cursors[: k + 1]
        bound = 0
        for c in there:
            bound += c.shallow(pivot)
        if bound < enough:
            to = min(c.block_end() for c in there) + 1
            if k + 1 < n:
                to = min(to, cursors[k + 1].doc)
            for c in there:
                c.skip(to)
            continue
        score = 0
        for c in there:
            if c.doc < pivot or not c.known:
                c.seek(pivot)
            if c.doc == pivot:
                score += c.weight * c.impacts[c.at]
                c.doc, c.known = pivot + 1, False
        if score >= enough:
            heapq.heappush(best, (score, -pivot))
            if len(best) > top:
                heapq.heappop(best)
            if len(best) == top:
                enough = best[0][0] + 1
    return [(s, -d) for s, d in sorted(best, reverse=True)]


def _search(group: pd.DataFrame, top: int, block: int):
    """All items of one block against one segment."""
    is_docs = group["term"] == ""
    own = group[is_docs].iloc[0]
    m, ids, kept = np.frombuffer(own["lengths"], "<i8"), own["ids"], OrderedDict()
    items = defaultdict(list)
    for row in group[~is_docs].itertuples():
        postings = Postings(row.df, row.lasts, row.maxima, row.ends, row.blocks, m, kept, block)
        for item in row.items_:
            items[item["item"]].append((postings, row.weight * item["times"]))
    return [(item, ids[doc], score) for item, terms in items.items() for score, doc in search_segment(terms, top)]


def search(index: DataFrame, items: DataFrame, n_docs: int, kind: str = "long", top: int = TOP, item_block: int = ITEMS, block: int = BLOCK) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` best documents of an index for each of ``items`` (item_id, text).

    ``kind``: type of doc_id; ``block``: postings of the index's blocks.
    """
    spark = items.sparkSession
    texts = items.where(F.col("text").isNotNull()).select("item_id", F.xxhash64("text").alias("hash"), "text").distinct()
    n_blocks = max(1, -(-texts.count() // item_block))
    word = F.explode(terms_of(F.col("text"))).alias("term")
    asked = texts.select(F.struct("item_id", "hash").alias("item"), word).groupBy("item", "term").agg(F.count("*").alias("times"))
    asked = materialize(asked.withColumn("item_block", F.pmod(F.xxhash64("item"), F.lit(n_blocks)).cast("int")))
    terms = materialize(asked.select("term").unionAll(spark.createDataFrame([("",)], "term string")).distinct())
    # with few terms the index is filtered as it is made, otherwise it is dealt by term
    held = materialize(index.join(F.broadcast(terms) if terms.count() <= BROADCAST else terms, "term", "left_semi"))
    # df fits in doubles; a term's weight is 0 at least
    weight = F.floor(1000 * F.log((2.0 * n_docs + 2.0) / (2.0 * F.col("all_df") + 1.0))).cast("long")
    weights = held.where("term <> ''").groupBy("term").agg(F.sum("df").alias("all_df")).select("term", weight.alias("weight")).where("weight > 0")
    # at most item_block items to a row; items are named by a number of their own, so that any type of item_id will do
    named = asked.withColumn("item", F.xxhash64("item"))
    by_term = named.join(weights, "term").groupBy("term", "item_block", "weight").agg(F.collect_list(F.struct("item", "times")).alias("items_"))
    every = F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("item_block")
    sides = ["segment", "item_block", "term", "df", "lasts", "maxima", "ends", "blocks", "lengths", "ids", "weight", "items_"]
    none = by_term.schema["items_"].dataType
    put = held.where("term <> ''").join(by_term, "term").select(*sides).unionByName(
        held.where("term = ''").select("*", every, F.lit(None).cast("long").alias("weight"), F.lit(None).cast(none).alias("items_")).select(*sides)
    )
    def run(group: pd.DataFrame) -> pd.DataFrame:
        rows = _search(group, top, block)
        return pd.DataFrame({"item": [r[0] for r in rows], "doc_id": pd.Series([r[1] for r in rows], dtype=object), "score": [r[2] for r in rows]}).astype({"item": "int64", "score": "int64"})

    # groups are long work on few bytes, so their number of tasks doesn't follow the bytes
    dealt = put.repartition(shuffle_partitions(spark), "segment", "item_block")
    found = dealt.groupBy("segment", "item_block").applyInPandas(run, "item long, doc_id string, score long").withColumn("doc_id", F.col("doc_id").cast(kind))
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    names = texts.select("item_id", F.xxhash64(F.struct("item_id", "hash")).alias("item"))
    return ranked.join(names, "item").select("item_id", "rank", "doc_id", "score")


def ranked_search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` best of ``docs`` for each of ``items``."""
    n_docs, n_terms = corpus_size(docs)
    return search(build_index(docs, n_docs, n_terms), items, n_docs, kind_of(docs, "doc_id").simpleString(), top)
