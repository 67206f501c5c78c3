"""LM scoring by deleted interpolation of bigrams, unigrams and a uniform floor.

p(w | h) = l2 c(h,w)/c(h) + l1 c(w)/N + l0/(V+1), with (l2, l1, l0) chosen by the bucket floor(log2 c(h)) of the
context's frequency and learned by expectation-maximisation on held-out counts: each training token is scored by
the counts without itself (deleted). For the learning alone, tokens are gathered in cells of a context bucket and thirds
of a log2 step of both probabilities, and a cell enters with its mean probabilities; scores use exact counts.

Counting and look-up are one exchange of distinct keys, not of tokens. Texts are packed into chunks of about
``CHUNK`` tokens; a chunk asks once for each of its distinct words and bigrams, keys (64-bit hashes) are dealt by
range over groups, a group adds up what the chunks hold and answers each chunk in its own order. A key comes at most
once from a chunk, so no key is hot, and there is a group for every ``PART`` tokens at least, so a group's keys stay
bounded at every size.

Defined results: a null, empty or blank text is one end token; a null doc_id counts as the empty text for the
held-out rule; doc_ids may be of any type with a text form; each row is a document, so repeated rows count again; a
text longer than ``CHUNK`` tokens is scored whole, as a chunk of its own, in memory that grows with it; with no training
rows the model is the uniform floor over the unknown word alone (probability 1, score 0); columns other than doc_id and
text are ignored, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ascii_words, kind_of, materialize, shuffle_partitions

CHUNK = 3_000_000
#: Tokens of the input for each range of keys, at most.
PART = 1 << 21
FOLDS = 10
ALPHA = 0.1
#: The end of a text, and the context of its first word; no word hashes to it but by chance.
END = np.uint64(0x9E3779B97F4A7C15)
BUCKETS = 64
#: Steps of log2 in which probabilities are gathered for expectation-maximisation.
STEPS = 3
ROUNDS = 60

STATE = "chunk long, tokens long, doc_ids array<string>, held binary, lengths binary, codes binary, hashes binary"
ASKED = "part int, chunk long, kind int, keys binary, counts binary"
MERGED = f"{STATE}, words binary, pairs binary, n_train long, v_train long"
ANSWER = "kind int, chunk long, part int, totals binary, n_train long, v_train long"


def pack(values: np.ndarray) -> bytes:
    """Unsigned integers in the fewest bytes, plane by plane, compressed."""
    top = int(values.max()) if len(values) else 0
    kind = next(t for t in ("<u1", "<u2", "<u4", "<u8") if top <= np.iinfo(t).max)
    planes = values.astype(kind).view(np.uint8).reshape(len(values), np.dtype(kind).itemsize).T
    return kind[1:].encode() + zstandard.ZstdCompressor(level=3).compress(np.ascontiguousarray(planes).tobytes())


def unpack(data: bytes) -> np.ndarray:
    kind = "<" + data[:2].decode()
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[2:]), np.uint8)
    if not len(planes):
        return np.zeros(0, dtype=kind)
    return np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def held_out(doc_id: str | None) -> bool:
    return zlib.crc32((doc_id or "").encode()) % FOLDS == 0


class _Chunk:
    """Texts of one chunk as codes of its own words, code 0 being the end."""

    def __init__(self):
        self.code: dict[bytes, int] = {b"": 0}
        self.codes, self.lengths, self.held, self.ids, self.size = [], [], [], [], 0

    def add(self, doc_id, text) -> None:
        code = self.code
        codes = [code.setdefault(w, len(code)) for w in ascii_words(text)]
        codes.append(0)
        self.codes.append(np.array(codes, dtype=np.uint32))
        self.lengths.append(len(codes))
        self.held.append(held_out(doc_id))
        self.ids.append(doc_id)
        self.size += len(codes)

    def frame(self, chunk: int) -> pd.DataFrame:
        codes = np.concatenate(self.codes)
        hashes = np.array([END, *(xxhash.xxh64_intdigest(w) for w in list(self.code)[1:])], dtype=np.uint64)
        # frequent words first, and by hash where they are equally frequent: both codes and hashes pack well so
        order = np.lexsort((hashes, -np.bincount(codes, minlength=len(self.code))))
        rank = np.empty(len(order), dtype=np.uint32)
        rank[order] = np.arange(len(order))
        hashes = hashes[order]
        return pd.DataFrame(
            {"chunk": [chunk], "tokens": [len(codes)], "doc_ids": [self.ids], "held": [np.array(self.held, np.uint8).tobytes()], "lengths": [pack(np.array(self.lengths, np.uint64))], "codes": [pack(rank[codes])], "hashes": [pack(hashes)]}
        )


def _encode(frames, size: int):
    task, n, now = TaskContext.get().partitionId(), 0, _Chunk()
    for frame in frames:
        for doc_id, text in zip(frame["doc_id"], frame["text"], strict=True):
            now.add(doc_id, text)
            if now.size >= size:
                yield now.frame((task << 24) + n)
                n, now = n + 1, _Chunk()
    if now.ids:
        yield now.frame((task << 24) + n)


def _mixed(h: np.ndarray, w: np.ndarray) -> np.ndarray:
    """64-bit keys of bigrams from the hashes of their words."""
    x = h * np.uint64(0x9E3779B97F4A7C15) + ((w << np.uint64(31)) | (w >> np.uint64(33)))
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


class _View:
    """A chunk's distinct words and bigrams, with the training counts that it holds of them."""

    def __init__(self, row):
        self.lengths = unpack(row.lengths).astype(np.int64)
        self.held = np.frombuffer(row.held, np.uint8).astype(bool)
        self.codes = unpack(row.codes).astype(np.int64)
        self.hashes = unpack(row.hashes).astype(np.uint64)
        n, words = len(self.codes), len(self.hashes)
        end = int(self.codes[-1])
        train = np.repeat(~self.held, self.lengths)
        self.end = end
        sorted_ = (self.token_pairs() << 1) | train
        sorted_.sort()
        starts = np.flatnonzero(np.concatenate([[True], (sorted_[1:] >> 1) != (sorted_[:-1] >> 1)]))
        self.pairs = sorted_[starts] >> 1
        self.pair_counts = np.add.reduceat(sorted_ & 1, starts) if n else np.zeros(0, np.int64)
        self.h, self.w = np.divmod(self.pairs, words)
        self.word_counts = np.bincount(self.codes[train], minlength=words)
        del sorted_, starts
        self.pair_keys = _mixed(self.hashes[self.h], self.hashes[self.w])

    def token_pairs(self) -> np.ndarray:
        """The bigram of each token, as context code times words plus word code."""
        pairs = np.empty_like(self.codes)
        pairs[0], pairs[1:] = self.end, self.codes[:-1]
        pairs *= len(self.hashes)
        pairs += self.codes
        return pairs

    def asked(self):
        yield 1, self.hashes, self.word_counts
        yield 2, self.pair_keys, self.pair_counts

    def answered(self, row) -> tuple[np.ndarray, np.ndarray]:
        """Corpus counts of the words and of the bigrams, from the answers in the order of the keys."""
        out = []
        for (_, keys, _), data in zip(self.asked(), (row.words, row.pairs), strict=True):
            totals = np.empty(len(keys), dtype=np.int64)
            totals[np.argsort(keys, kind="stable")] = unpack(data)
            out.append(totals)
        return out[0], out[1]


def _ask(frames, parts: int):
    width = np.uint64(-(-(1 << 64) // parts))
    for frame in frames:
        for row in frame.itertuples():
            for kind, keys, counts in _View(row).asked():
                order = np.argsort(keys, kind="stable")
                keys, counts = keys[order], counts[order]
                part = (keys // width).astype(np.int64)
                cuts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]]))
                rows = [(int(part[a]), row.chunk, kind, pack(np.diff(keys[a:b], prepend=np.uint64(0))), pack(counts[a:b].astype(np.uint64))) for a, b in zip(cuts, cuts[1:])]
                yield pd.DataFrame(rows, columns=["part", "chunk", "kind", "keys", "counts"])


def _total(group: pd.DataFrame) -> pd.DataFrame:
    out, n_train, v_train = [], 0, 0
    for kind, asked in group.groupby("kind"):
        keys = [np.cumsum(unpack(k), dtype=np.uint64) for k in asked["keys"]]  # sent as differences
        counts = np.concatenate([unpack(c).astype(np.int64) for c in asked["counts"]])
        _, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        totals = np.zeros(int(inverse.max()) + 1, dtype=np.int64)
        np.add.at(totals, inverse, counts)
        if kind == 1:
            n_train, v_train = int(totals.sum()), int(np.count_nonzero(totals))
        ends = np.cumsum([len(k) for k in keys])
        for chunk, part, size, end in zip(asked["chunk"], asked["part"], map(len, keys), ends, strict=True):
            out.append((kind, chunk, part, pack(totals[inverse[end - size : end]].astype(np.uint64)), 0, 0))
    out.append((0, -1, -1, b"", n_train, v_train))
    return pd.DataFrame(out, columns=["kind", "chunk", "part", "totals", "n_train", "v_train"])


def _merge(state: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
    """A chunk with its answers put together in the order of the keys; the parts' totals, which have no chunk, as a row of sums."""
    if not len(state):
        sums = {"chunk": [-1], "n_train": [answers["n_train"].sum()], "v_train": [answers["v_train"].sum()]}
        return pd.DataFrame(sums).reindex(columns=[c.split()[0] for c in MERGED.split(", ")]).astype(object).where(lambda x: x.notna(), None)
    put = {}
    for name, kind in (("words", 1), ("pairs", 2)):
        got = answers[answers["kind"] == kind].sort_values("part")["totals"]
        put[name] = [pack(np.concatenate([unpack(x).astype(np.uint64) for x in got]))]
    return state.assign(**put, n_train=0, v_train=0)


def bucket(counts: np.ndarray) -> np.ndarray:
    """0 for a context never seen, else 1 + floor(log2 count)."""
    return np.where(counts > 0, np.frexp(counts.astype(np.float64))[1], 0)


def _ratio(a, b):
    return np.divide(a, b, out=np.zeros(len(a)), where=np.broadcast_to(b, a.shape) > 0)


def _log_step(p: np.ndarray) -> np.ndarray:
    return np.where(p > 0, np.round(STEPS * np.log2(np.where(p > 0, p, 1))), 1).astype(np.int64)


def deleted_counts(view: _View, words: np.ndarray, pairs: np.ndarray, n_train: int) -> pd.DataFrame:
    """Training tokens by context bucket and steps of their deleted bigram and unigram probabilities, with mean probabilities."""
    here = view.pair_counts > 0
    weight = view.pair_counts[here].astype(float)
    c, h, w = pairs[here], words[view.h[here]], words[view.w[here]]
    p2, p1 = _ratio(c - 1.0, h - 1.0), _ratio(w - 1.0, np.float64(n_train - 1))
    cells = pd.DataFrame({"bucket": bucket(h - 1), "i": _log_step(p2), "j": _log_step(p1), "weight": weight, "sum2": weight * p2, "sum1": weight * p1})
    return cells.groupby(["bucket", "i", "j"], as_index=False).sum()


def learn_mixture(cells: pd.DataFrame, v_train: int, rounds: int = ROUNDS) -> np.ndarray:
    """Expectation-maximisation of (l2, l1, l0) for each bucket. A bucket without tokens gets even shares; bucket 0 has no l2.

    Without a training token there are no counts to mix, and all is left to the floor.
    """
    if not v_train:
        return np.tile([0.0, 0.0, 1.0], (BUCKETS + 1, 1))
    out = np.full((BUCKETS + 1, 3), 1 / 3)
    p0 = 1.0 / (v_train + 1)
    for b, own in cells.groupby("bucket"):
        weight = own["weight"].to_numpy()
        p = np.stack([own["sum2"] / weight, own["sum1"] / weight, np.full(len(own), p0)], axis=1)
        mix = np.full(3, 1 / 3)
        for _ in range(rounds):
            share = p * mix
            share /= share.sum(axis=1, keepdims=True)
            mix = (share * weight[:, None]).sum(axis=0) / weight.sum()
        out[int(b)] = np.maximum(mix, [0, 0, 1e-6]) / np.maximum(mix, [0, 0, 1e-6]).sum()
    out[0] = np.array([0, out[0][1] + out[0][0], out[0][2]])
    return out


def _score(view: _View, doc_ids, words, pairs, n_train: int, v_train: int, mixture: np.ndarray) -> pd.DataFrame:
    h, w = words[view.h], words[view.w]
    l2, l1, l0 = mixture[bucket(h)].T
    p = l2 * _ratio(pairs.astype(float), h.astype(float)) + l1 * _ratio(w.astype(float), np.float64(n_train)) + l0 / (v_train + 1)
    per_token = np.log10(p)[np.searchsorted(view.pairs, view.token_pairs())]
    base = np.log10((words + ALPHA) / (n_train + ALPHA * (v_train + 1)))[view.codes]
    starts = np.concatenate([[0], np.cumsum(view.lengths)[:-1]])
    add = np.add.reduceat
    return pd.DataFrame(
        {"doc_id": list(doc_ids), "held_out": view.held, "n_tokens": view.lengths, "n_known": add((words > 0)[view.codes].astype(np.int64), starts), "train_tokens": n_train, "base_score": add(base, starts), "score": add(per_token, starts)}
    )


def score_documents(docs: DataFrame, chunk_tokens: int = CHUNK) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for each row of ``docs``."""
    spark = docs.sparkSession
    state = materialize(docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInPandas(lambda f: _encode(f, chunk_tokens), STATE))
    parts = max(64, 2 * shuffle_partitions(spark), -(-(state.agg(F.sum("tokens")).first()[0] or 0) // PART))
    answers = state.mapInPandas(lambda f: _ask(f, parts), ASKED).groupBy("part").applyInPandas(_total, ANSWER)
    # state and answers meet once; learning and scoring then read the merged chunks without another exchange
    merged = materialize(state.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(_merge, MERGED))
    sums = merged.where("chunk < 0").agg(F.sum("n_train").alias("n"), F.sum("v_train").alias("v")).first()
    n_train, v_train = int(sums["n"] or 0), int(sums["v"] or 0)
    chunks = merged.where("chunk >= 0")

    def gather(frames):
        for frame in frames:
            for row in frame.itertuples():
                view = _View(row)
                yield deleted_counts(view, *view.answered(row), n_train)

    cells = (
        chunks.mapInPandas(gather, "bucket int, i int, j int, weight double, sum2 double, sum1 double")
        .groupBy("bucket", "i", "j").agg(F.sum("weight").alias("weight"), F.sum("sum2").alias("sum2"), F.sum("sum1").alias("sum1"))
    )
    # at most BUCKETS x (steps of log2)^2 cells, whatever the input
    mixture = learn_mixture(cells.orderBy("bucket", "i", "j").toPandas(), v_train)

    def score(frames):
        for frame in frames:
            for row in frame.itertuples():
                view = _View(row)
                yield _score(view, row.doc_ids, *view.answered(row), n_train, v_train, mixture)

    scored = chunks.mapInPandas(score, "doc_id string, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    return scored.withColumn("doc_id", F.col("doc_id").cast(kind_of(docs, "doc_id")))
