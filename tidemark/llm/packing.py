"""Hierarchical multi-length packing of token sequences: tiers of context sizes, gaps filled from shorter tiers, balanced steps.

A document's ids are cut into whole windows and a rest, and the rest goes to the tier of the smallest context size
that holds it (window, half of it, ... down to ``LEAST_TIER``). Tiers are packed from the longest down: each document of
a tier opens a sequence of the tier's size, its gap is filled with the largest whole documents of shorter tiers that
fit, and where none fits the shortest one left is cut at the gap, its end going to the tier that now holds it. So every
sequence is full. When nothing is left for a gap, what the last sequence holds is cut at powers of two, which need no
padding. Sequences are then dealt to step groups of about ``STEP`` windows of tokens, long ones first, each to the
lightest group, so that groups differ by little more than their shortest sequence and have the tiers' mix.

Packing needs no exchange: a task packs what it reads in blocks of about ``BLOCK`` tokens as they pass, and a block's
last sequences are its only short ones. A piece, its sequence and its step come from one task, so a task that runs
again gives a whole result of its own. Sequence and step ids hold the number of the partition.

Where the tokenizer's rules drop white space and look at nothing across it, each distinct run between ASCII blanks is
encoded once and the ids of a text are put together from those of its runs; other files encode texts whole. Runs of
ASCII and Latin-1 letters are encoded by token ranks, with a mark for a word's end that merges first, others by the
library. The tokenizer file is a parameter and is read by each Python worker, so its path must exist on every node.

Defined results: a null text is an empty one, whose only id is the end's; special tokens in a text become their ids,
as the library does by default; each row is a document, whatever its doc_id; doc_ids may be null and of any type; a text
of any length is cut in windows, its ids are held by one task; columns other than doc_id and text are ignored, whatever
their names; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import itertools
import json
import re
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from .bpe import byte_letters, encode_texts, tokenizer
from .common import kind_of, text_slices

WINDOW, LEAST_TIER, END = 4096, 256, 2
#: Tokens that are packed together, and windows of tokens in a step group.
BLOCK, STEP = 1 << 21, 64
#: Distinct runs that are encoded at once, and bytes of text whose runs are told apart together.
AT_ONCE, SLICE = 1 << 16, 1 << 25

# Rules under which white space is dropped and separates.
SEPARATING_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
SEPARATING_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@cache
def runs_are_separate(path: str) -> bool:
    """True if the ids of a text are those of its runs between ASCII blanks, one after another."""
    rules = json.loads(tokenizer(path).to_str())
    normal, split = rules["normalizer"] or {}, rules["pre_tokenizer"] or {}
    parts = split.get("pretokenizers", [])
    return (
        normal.get("normalizers") == SEPARATING_NORMALIZERS and len(parts) == 2
        and parts[0] == {"type": "Split", "pattern": {"Regex": SEPARATING_SPLIT}, "behavior": "Removed", "invert": True}
        and parts[1]["type"] == "ByteLevel" and not parts[1]["add_prefix_space"] and not parts[1]["use_regex"]
        and not rules["model"]["dropout"] and not any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in rules["added_tokens"])
    )


#: Runs that ranks encode as the library does: lower-casing them is plain, and composing them changes nothing.
PLAIN_RUNS = re.compile("[\n!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
#: The separating split over such runs, with line ends between them.
PLAIN_SPLIT = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|\n|[^\\sa-z0-9\u00df-\u00f6\u00f8-\u00ff]+")


@cache
def ranks_with_word_ends(path: str):
    """(encoding of words that end in NUL, id of a lone line end), or None where ids don't rise with the merges.

    NUL stands for the mark of a word's end: its merges with a byte come before all others, as ids of marked bytes do.
    """
    import tiktoken

    model = json.loads(tokenizer(path).to_str())["model"]
    mark, vocab = model["end_of_word_suffix"], model["vocab"]
    made = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    if not mark or made != sorted(made):
        return None
    byte = byte_letters()
    ranks = {}
    for token, i in vocab.items():
        word = token.removesuffix(mark)
        if all(c in byte for c in word):
            ranks.setdefault(bytes(byte[c] for c in word) + b"\0" * (word != token), i)
    singles = {ranks.get(bytes([b]) + end) for b in range(256) for end in (b"", b"\0")}
    if None in singles or max(singles) >= made[0]:
        return None
    return tiktoken.Encoding(path, pat_str=r"[^\x00]+\x00", mergeable_ranks=ranks, special_tokens={}), ranks[b"\n\0"]


def encode_runs(runs: list[str], path: str) -> tuple[np.ndarray, np.ndarray]:
    """(ids, number of ids of each run)."""
    fast = ranks_with_word_ends(path)
    if fast is None:
        plain = np.zeros(len(runs), bool)
    elif (joined := "\n".join(runs)) and PLAIN_RUNS.fullmatch(joined) and "<|" not in joined:
        plain = np.ones(len(runs), bool)
    else:
        plain = np.array([PLAIN_RUNS.fullmatch(r) is not None and "<|" not in r for r in runs], bool)
    counts, parts = np.zeros(len(runs), np.int64), []
    if plain.any():
        encoding, line_end = fast
        words = PLAIN_SPLIT.sub("\\g<0>\0", "\n".join(itertools.compress(runs, plain)).lower() + "\n")
        ids = np.asarray(encoding.encode_to_numpy(words), np.uint32)
        ends = np.flatnonzero(ids == line_end)
        counts[plain] = np.diff(ends, prepend=-1) - 1
        parts.append(np.delete(ids, ends))
    others = list(itertools.compress(runs, ~plain))
    made = encode_texts(others, path)
    counts[~plain] = [len(x) for x in made]
    parts.append(np.fromiter(itertools.chain.from_iterable(made), np.uint32))
    # back in the order of the runs
    order = np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])
    start = np.zeros(len(runs), np.int64)
    start[order] = np.cumsum(counts[order]) - counts[order]
    return gathered(np.concatenate(parts), start, counts), counts


def gathered(values: np.ndarray, start: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The stretches of ``values`` of these starts and lengths, one after another."""
    kind = np.int32 if max(len(values), int(counts.sum())) < 1 << 31 else np.int64
    before = np.cumsum(counts) - counts
    at = np.repeat((start - before).astype(kind), counts)
    at += np.arange(len(at), dtype=kind)
    return values[at]


def encode_slice(text: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """(ids, start of each text's ids and their end) for an array without nulls."""
    if not runs_are_separate(path):
        ids = encode_texts(text.to_pylist(), path)
        ends = np.cumsum([0, *map(len, ids)])
        return np.fromiter(itertools.chain.from_iterable(ids), np.uint32, int(ends[-1])), ends
    runs = pc.ascii_split_whitespace(text)
    coded = runs.flatten().dictionary_encode()
    at, place = runs.offsets.to_numpy(), coded.indices.to_numpy(zero_copy_only=False)
    parts = [encode_runs(coded.dictionary.slice(k, AT_ONCE).to_pylist(), path) for k in range(0, max(1, len(coded.dictionary)), AT_ONCE)]
    counts = np.concatenate([c for _, c in parts])
    n = counts[place]
    ids = gathered(np.concatenate([i for i, _ in parts]), (np.cumsum(counts) - counts)[place], n)
    return ids, np.concatenate([[0], np.cumsum(n)])[at - at[0]]


class Pool:
    """Rests of documents by length."""

    def __init__(self, window: int):
        self.held, self.lengths = [[] for _ in range(window + 1)], 0

    def put(self, length: int, rest: tuple[int, int]) -> None:
        self.held[length].append(rest)
        self.lengths |= 1 << length

    def take(self, length: int) -> tuple[int, int]:
        rest = self.held[length].pop()
        if not self.held[length]:
            self.lengths ^= 1 << length
        return rest

    def longest(self, limit: int) -> int:
        """The greatest length up to ``limit`` that is there, or 0."""
        return max(0, (self.lengths & ((2 << limit) - 1)).bit_length() - 1)

    def shortest(self) -> int:
        return (self.lengths & -self.lengths).bit_length() - 1


def powers(total: int) -> list[int]:
    """Powers of two that add up to ``total``, largest first."""
    return [1 << b for b in range(total.bit_length() - 1, -1, -1) if total >> b & 1]


def cut_at(pieces: list[tuple[int, int, int]], lengths: list[int]) -> list[list[tuple[int, int, int]]]:
    """Pieces (document, start, length) in a row, cut into sequences of these lengths."""
    out, left = [], list(reversed(pieces))
    for length in lengths:
        own = []
        while length:
            doc, start, n = left.pop()
            if n > length:
                left.append((doc, start + length, n - length))
                n = length
            own.append((doc, start, n))
            length -= n
        out.append(own)
    return out


def pack_block(sizes: np.ndarray, window: int = WINDOW, least_tier: int = LEAST_TIER) -> list[list[tuple[int, int, int]]]:
    """Sequences of pieces (document, start, length) that hold each token of documents of these sizes once."""
    pool, out = Pool(window), []
    for doc, size in enumerate(sizes.tolist()):
        whole = size - size % window
        out += [[(doc, at, window)] for at in range(0, whole, window)]
        if size > whole:
            pool.put(size - whole, (doc, whole))
    tier = window
    while pool.lengths:
        if tier > least_tier and pool.longest(tier) <= tier // 2:
            tier //= 2
            continue
        pieces, gap = [], tier
        while gap and pool.lengths:
            n = pool.longest(gap)
            if n:
                pieces.append((*pool.take(n), n))
            else:
                whole = pool.shortest()
                doc, start = pool.take(whole)
                n = gap
                pieces.append((doc, start, n))
                pool.put(whole - n, (doc, start + n))
            gap -= n
        out += cut_at(pieces, powers(tier - gap)) if gap else [pieces]
    return out


def balanced_steps(lengths: list[int], step: int) -> list[int]:
    """A step group for each sequence: about ``step`` tokens each, long sequences first, each to the lightest group."""
    groups = [(0, g) for g in range(max(1, round(sum(lengths) / step)))]
    out = [0] * len(lengths)
    for s in sorted(range(len(lengths)), key=lambda s: -lengths[s]):
        load, group = groups[0]
        heapq.heapreplace(groups, (load + lengths[s], group))
        out[s] = group
    return out


COLUMNS = "start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, sequence_tokens long, step long"


def pack(docs: DataFrame, path: str | None = None, window: int = WINDOW, least_tier: int = LEAST_TIER, end: int | None = END, block: int = BLOCK, step: int = STEP) -> DataFrame:
    """(doc_id, start, length, ids, doc_tokens, sequence_id, offset, sequence_tokens, step): one row for each piece.

    ``ids``: little-endian unsigned 32-bit; ``start``: the document's ids before it; ``doc_tokens``: its document's ids,
    with ``end``; ``sequence_tokens``: ids of the whole sequence, its tier unless it is one of a block's last.
    """
    if window & (window - 1) or least_tier & (least_tier - 1) or not 0 < least_tier <= window:
        raise ValueError("window and least_tier are powers of two, least_tier the smaller")
    path = path or default_path()
    kind = kind_of(docs, "doc_id").simpleString()

    def packed(doc_ids: list[pa.Array], ids: list[np.ndarray], part: int, n_sequences: int, n_steps: int):
        names = pa.concat_arrays(doc_ids)
        sizes = np.array([len(x) for x in ids], np.int64)
        sequences = pack_block(sizes, window, least_tier)
        lengths = [sum(n for *_, n in s) for s in sequences]
        steps = balanced_steps(lengths, step * window)
        rows = np.array([(d, at, n, k) for k, s in enumerate(sequences) for d, at, n in s], np.int64)
        doc, start, length, sequence = rows.T
        before = np.cumsum(length) - length
        first = np.searchsorted(sequence, np.arange(len(sequences)))
        high = part << 32
        pieces = [ids[d][a : a + n].tobytes() for d, a, n in zip(doc.tolist(), start.tolist(), length.tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [names.take(pa.array(doc)), pa.array(start), pa.array(length), pa.array(pieces, pa.binary()), pa.array(sizes[doc]), pa.array(high + n_sequences + sequence),
             pa.array(before - before[first][sequence]), pa.array(np.array(lengths, np.int64)[sequence]), pa.array(high + n_steps + np.array(steps, np.int64)[sequence])],
            names=["doc_id", *[c.split()[0] for c in COLUMNS.split(", ")]],
        )
        return len(sequences), max(steps) + 1

    def run(batches):
        part = TaskContext.get().partitionId()
        doc_ids, ids, held, n_sequences, n_steps = [], [], 0, 0, 0
        for batch in text_slices(batches, most=SLICE):
            flat, ends = encode_slice(batch.column("text"), path)
            doc_ids.append(batch.column("doc_id"))
            tail = np.array([] if end is None else [end], np.uint32)
            own = [np.concatenate([flat[a:b], tail]) for a, b in zip(ends.tolist(), ends[1:].tolist(), strict=False)]
            ids, held = ids + own, held + sum(map(len, own))
            if held >= block:
                made = yield from packed(doc_ids, ids, part, n_sequences, n_steps)
                n_sequences, n_steps, doc_ids, ids, held = n_sequences + made[0], n_steps + made[1], [], [], 0
        if held:
            yield from packed(doc_ids, ids, part, n_sequences, n_steps)

    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, f"doc_id {kind}, {COLUMNS}")
