"""Spelling variants: words one edit apart by a positional q-gram index with a count filter, grouped under their frequent forms.

A word is padded and has a gram of ``Q`` letters at each place; one edit spoils at most ``Q`` of them, so words one edit
apart share all but ``Q`` grams of the longer one, at places that differ by none (replaced) or by at most one (inserted
or deleted). Words meet by their ``Q`` + 1 rarest grams, of which they must share one: a word goes to the groups of
these grams, their place and its length, and to those of the next shorter length. Each group is a positional index of
its own: the sorted postings of a probe's grams under the limits of length and place are merged, and words that occur in
the merged list at least as often as the bound says are verified, the others are not. Groups over ``BLOCK`` words
are dealt in blocks, each pair of blocks a group. Gram counts are at most as many as triples of letters, whatever the
number of words; they go to the workers.

Lists are merged by a merging sort of the concatenated sorted lists (Python's, or numpy's for long ones), several times
as fast as a heap of Python objects and with the same result.

Defined results: a null text has no words; a null doc_id is written as nothing when its letter to delete is drawn; each row
is a document, rows with equal doc_id draw alike; doc_ids of any type are used in their text form; texts of any length are
read whole; words of any length are compared; of near words with equal counts the smallest in code point order is the form; columns other than
doc_id and text are ignored, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import itertools
import zlib
from collections import defaultdict
from operator import itemgetter, ne

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, shuffle_partitions, string_array, text_bytes, text_slices

#: Words shorter or rarer than this are left out; a form is so many times as frequent as its variant; one run in so many loses a letter.
MIN_LETTERS, MIN_COUNT, FORM_TIMES, ONE_IN = 5, 3, 2, 97
#: Letters of a gram, words of a block, and hot groups up to which their list is broadcast.
Q, BLOCK, HOT_BROADCAST = 3, 4096, 100_000
#: Words of an index from which lists are merged by numpy.
LONG_MERGE = 256
START, STOP = "\x01", "\x02"


def _letters() -> np.ndarray:
    """What becomes of each byte: ASCII letters in lower case and the lead byte of U+00C0 to U+00FF stay, others part runs."""
    table = np.full(256, 32, np.uint8)
    small = np.arange(97, 123)
    table[small], table[small - 32], table[0xC3] = small, small, 0xC3
    return table


LETTERS = _letters()


def letter_runs(text: pa.Array) -> pa.Array:
    """Lists of maximal runs of A-Z, a-z and U+00C0 to U+00FF, A-Z lower-cased; runs may be empty."""
    data, offsets = text_bytes(text)
    kept = LETTERS[data]
    if len(data):
        follows = np.flatnonzero(data[:-1] == 0xC3) + 1
        kept[follows] = data[follows]
    return pc.ascii_split_whitespace(string_array(kept, offsets))


def count_words(docs: DataFrame, one_in: int = ONE_IN, min_letters: int = MIN_LETTERS) -> DataFrame:
    """(word, n long): occurrences of runs of at least ``min_letters`` letters, after some lose one.

    If ``one_in`` divides the CRC-32 of ``<doc_id>:<run>``, the run loses its letter number CRC-32 modulo its length.
    """

    def counted(batches):
        for batch in text_slices(batches):
            runs = letter_runs(batch.column("text"))
            coded = runs.flatten().dictionary_encode()
            words, code = coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            rows = np.repeat(np.arange(len(runs)), np.diff(runs.offsets.to_numpy()))
            pairs, n = np.unique(rows * max(1, len(words)) + code, return_counts=True)
            row, code = np.divmod(pairs, max(1, len(words)))
            prefix = [zlib.crc32(f"{i or ''}:".encode()) for i in batch.column("name").to_pylist()]
            raw = [w.encode() for w in words]
            draw = np.fromiter(map(zlib.crc32, map(raw.__getitem__, code.tolist()), map(prefix.__getitem__, row.tolist())), np.int64, len(code))
            hit = (draw % one_in == 0) & np.array([bool(w) for w in words], bool)[code]
            total = np.bincount(code[~hit], n[~hit], len(words)).astype(np.int64)
            long_ = (total > 0) & np.array([len(w) >= min_letters for w in words], bool)
            changed = defaultdict(int)
            for c, h, times in zip(code[hit].tolist(), draw[hit].tolist(), n[hit].tolist(), strict=True):
                w = words[c]
                at = h % len(w)
                if len(w) > min_letters:
                    changed[w[:at] + w[at + 1 :]] += times
            places = np.flatnonzero(long_)
            yield pa.RecordBatch.from_arrays(
                [pa.concat_arrays([coded.dictionary.take(pa.array(places)).cast(pa.string()), pa.array(list(changed), pa.string())]), pa.array(np.concatenate([total[places], np.array(list(changed.values()), np.int64)]))],
                names=["word", "n"],
            )

    texts = docs.where(F.col("text").isNotNull()).select(F.col("doc_id").cast("string").alias("name"), "text")
    return texts.mapInArrow(counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def grams(word: str) -> list[str]:
    padded = START * (Q - 1) + word + STOP * (Q - 1)
    return [padded[i : i + Q] for i in range(len(word) + Q - 1)]


def one_edit(a: str, b: str) -> bool:
    """Whether the words differ by exactly one inserted, deleted or replaced letter."""
    if len(a) == len(b):
        return sum(map(ne, a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    k = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[k:] == b[k + 1 :]


class PositionalIndex:
    """Postings of words by length and (place, gram), in the order of the words."""

    def __init__(self, words: list[str]):
        self.words, self.lists, self.many = words, {}, len(words) > LONG_MERGE
        for i, w in enumerate(words):
            lists = self.lists.setdefault(len(w), {})
            for key in enumerate(grams(w)):
                lists.setdefault(key, []).append(i)
        if self.many:
            # 16-bit numbers of words are sorted by radix
            kind = np.int16 if len(words) < 1 << 15 else np.int64
            self.lists = {n: {key: np.array(x, kind) for key, x in lists.items()} for n, lists in self.lists.items()}

    def near(self, probe: str, before: int) -> list[str]:
        """Words number 0 to ``before`` - 1, of the probe's length or one letter shorter, that are one edit away."""
        size, own, out = len(probe), None, []
        bound = size - 1  # size + Q - 1 grams, less Q
        for shorter in (0, 1):
            lists = self.lists.get(size - shorter)
            if lists is None:
                continue
            own = own or grams(probe)
            get = lists.get
            met = [x for key in enumerate(own) if (x := get(key)) is not None]
            if shorter:
                met += [x for key in enumerate(own, -1) if (x := get(key)) is not None]
            if len(met) < bound:
                continue
            if self.many:
                merged = np.sort(np.concatenate(met), kind="stable")
                found = np.unique(merged[bound - 1 :][merged[bound - 1 :] == merged[: len(merged) - bound + 1]]).tolist()
            else:
                merged = sorted(itertools.chain.from_iterable(met))
                found = {a for a, b in zip(merged, itertools.islice(merged, bound - 1, None), strict=False) if a == b}
            out += [self.words[i] for i in found if i < before and one_edit(probe, self.words[i])]
        return out


def _routed(words: DataFrame) -> DataFrame:
    """(word, n, own, longer): hashes of the groups where a word stands in the index, and where it only probes."""
    padded = F.concat(F.lit(START * (Q - 1)), "word", F.lit(STOP * (Q - 1)))
    each = words.select(F.explode(F.transform(F.sequence(F.lit(1), F.length("word") + Q - 1), lambda i: F.substring(padded, i, F.lit(Q)))).alias("gram"))
    counts = {r["gram"]: r["n"] for r in each.groupBy("gram").agg(F.count("*").alias("n")).toLocalIterator()}
    shared = words.sparkSession.sparkContext.broadcast(counts)

    def route(batches):
        rank = shared.value
        for batch in batches:
            own, longer = [], []
            for w in batch.column("word").to_pylist():
                n, g = len(w), grams(w)
                rare = sorted((rank[x], x, p) for p, x in enumerate(g))[: Q + 1]
                own.append([f"{n} {p} {x}" for _, x, p in rare])
                longer.append(list({f"{n - 1} {at} {x}" for _, x, p in rare for at in (p - 1, p)}))
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("n"), pa.array(own, pa.list_(pa.string())), pa.array(longer, pa.list_(pa.string()))], names=["word", "n", "own", "longer"])

    named = words.select("word", "n").mapInArrow(route, "word string, n long, own array<string>, longer array<string>")
    return named.select("word", "n", *[F.transform(c, lambda k: F.xxhash64(k)).alias(c) for c in ("own", "longer")])


def near_pairs(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """(a, a_n, b, b_n): each pair of different words one edit apart once, for distinct words with counts (word, n)."""
    routed = materialize(_routed(words))
    member = F.posexplode(F.concat("own", "longer")).alias("at", "key")
    rows = routed.select("word", "n", F.size("own").alias("n_own"), member).select("word", "n", "key", (F.col("at") >= F.col("n_own")).alias("longer"))
    hot = materialize(rows.groupBy("key").agg(F.count("*").alias("held")).where(F.col("held") > block).select(F.col("key").alias("hot_key"), F.ceil(F.col("held") / block).cast("int").alias("blocks")))
    few = hot.count() <= HOT_BROADCAST
    b, j = F.col("b"), F.sequence(F.lit(0), F.col("blocks") - 1)
    # a word of the index stands in every group (b, j); those after it in order probe it, and longer words
    indexed = F.transform(j, lambda x: F.struct(b.alias("i"), x.alias("j"), F.when(x == b, 2).otherwise(1).alias("role")))
    probes = F.transform(F.filter(j, lambda x: F.col("longer") | (x < b)), lambda x: F.struct(x.alias("i"), b.alias("j"), F.lit(0).alias("role")))
    dealt = (
        rows.join(F.broadcast(hot) if few else hot, rows["key"] == hot["hot_key"], "left")
        .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        .withColumn("b", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))
        .select("key", "word", "n", F.explode(F.when(F.col("longer"), probes).otherwise(F.concat(indexed, probes))).alias("to"))
        .select("key", "to.*", "word", "n")
        .repartition(shuffle_partitions(words.sparkSession), "key", "i", "j")
        .sortWithinPartitions("key", "i", "j", "word")
    )

    def compare(batches):
        names = ("key", "i", "j", "role", "word", "n")
        every = (row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in names), strict=True))
        out = []
        for _, group in itertools.groupby(every, key=itemgetter(0, 1, 2)):
            held = list(group)
            index = [r for r in held if r[3]]
            if not index or len(held) < 2:
                continue
            count = {r[4]: r[5] for r in held}
            words = [r[4] for r in index]
            place = {w: i for i, w in enumerate(words)}
            look = PositionalIndex(words)
            for r in held:
                if r[3] != 1:
                    w = r[4]
                    out += [(w, r[5], x, count[x]) for x in look.near(w, place[w] if r[3] == 2 else len(words))]
            if len(out) > 20_000:
                yield _pair_batch(out)
                out = []
        yield _pair_batch(out)

    found = dealt.mapInArrow(compare, "w string, w_n long, x string, x_n long")
    least = F.least(F.struct("w", "w_n"), F.struct(F.col("x").alias("w"), F.col("x_n").alias("w_n")))
    most = F.greatest(F.struct("w", "w_n"), F.struct(F.col("x").alias("w"), F.col("x_n").alias("w_n")))
    # a pair is found in each group that both words go to
    return found.select(least.alias("p"), most.alias("r")).distinct().select(F.col("p.w").alias("a"), F.col("p.w_n").alias("a_n"), F.col("r.w").alias("b"), F.col("r.w_n").alias("b_n"))


def _pair_batch(pairs: list[tuple]) -> pa.RecordBatch:
    w, w_n, x, x_n = zip(*pairs, strict=True) if pairs else ((), (), (), ())
    return pa.RecordBatch.from_arrays([pa.array(w, pa.string()), pa.array(w_n, pa.int64()), pa.array(x, pa.string()), pa.array(x_n, pa.int64())], names=["w", "w_n", "x", "x_n"])


def with_roots(forms: DataFrame, max_rounds: int = 64) -> DataFrame:
    """``forms`` (word, form, ...) with ``root``: the last word that forms lead to, the word itself if it has none.

    Pointers are doubled each round, so rounds are the logarithm of the longest chain. Raises if forms lead in a circle.
    """
    up = materialize(forms.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root"), F.lit(True).alias("open")))
    for _ in range(max_rounds):
        if not up.where("open").limit(1).count():
            break
        to = up.select(F.col("word").alias("via"), F.col("root").alias("beyond"))
        up = materialize(up.join(to, up["root"] == to["via"], "left").select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("open")))
    else:
        raise ValueError("forms lead in a circle")
    ends = up.select(F.col("word").alias("end_word"), "root")
    return forms.join(ends, forms["word"] == ends["end_word"], "left").drop("end_word").withColumn("root", F.coalesce("root", "word"))


def group_variants(words: DataFrame, form_times: int = FORM_TIMES, block: int = BLOCK) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for distinct words with counts (word, n)."""
    near = near_pairs(words, block)
    both = near.select(F.explode(F.array(F.struct(F.col("a").alias("w"), F.col("b").alias("x"), F.col("b_n").alias("x_n")), F.struct(F.col("b").alias("w"), F.col("a").alias("x"), F.col("a_n").alias("x_n")))).alias("s")).select("s.*")
    best = both.groupBy("w").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("x_n")).alias("less"), F.col("x"))).alias("top"))
    wide = words.join(best, words["word"] == best["w"], "left")
    is_form = -F.col("top.less") >= form_times * F.col("n")
    forms = materialize(wide.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(is_form, F.col("top.x")).alias("form"), F.when(is_form, -F.col("top.less")).alias("form_n")))
    return with_roots(forms)


def spelling_variants(docs: DataFrame, min_count: int = MIN_COUNT, **how) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for the words of ``docs`` that occur at least ``min_count`` times."""
    words = materialize(count_words(docs, **how).where(F.col("n") >= min_count))
    return group_variants(words)
