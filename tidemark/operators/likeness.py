"""The most similar earlier set of a row, among those open or lately merged when it opened, for rows dealt by one of their tokens."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa

#: Subsets worked on at a time, and pairs measured at a time.
SUBSETS, PAIRS = 2_000_000, 100_000
#: Codes from this on are numbered anew before they are made longer.
LARGEST = 2**62


def _join(code: np.ndarray, more: np.ndarray, n: int) -> np.ndarray:
    """One number for (code, more), with ``more`` below ``n``; equal ones stay equal and codes stay in order."""
    if len(code) and (int(code.max()) + 1) * n >= LARGEST:
        code = np.unique(code, return_inverse=True)[1]
    return code * n + more


def _subsets(group: np.ndarray, rest: np.ndarray, size: np.ndarray, j: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(code, row) of each choice of ``j`` tokens of a row's ``rest``; one code is one choice in one group."""
    if not j:
        return group, np.arange(len(group))
    rows, picks = [np.empty(0, np.int64)], [np.empty((0, j), np.int64)]
    for r in np.unique(size[size >= j]):
        own, chosen = np.flatnonzero(size == r), np.array(list(combinations(range(r), j)))
        rows.append(np.repeat(own, len(chosen)))
        picks.append(rest[own][:, chosen].reshape(-1, j))
    row, picks = np.concatenate(rows), np.concatenate(picks)
    code = group[row]
    for i in range(j):
        code = _join(code, picks[:, i], n)
    return code, row


class _Rows:
    """Rows of whole groups (repository, token); times are ranks, so that a time and a subset fit one number."""

    def __init__(self, group, rest, size, n, n_tokens, opened, closed, merged, back):
        never = closed < 0
        times, ranks = np.unique(np.concatenate([opened, opened - back, closed[~never]]), return_inverse=True)
        k = len(group)
        self.group, self.rest, self.size, self.n, self.n_tokens = group, rest, size, n, n_tokens
        self.opened, self.since = ranks[:k], ranks[k : 2 * k]
        self.times = len(times) + 1
        self.closed = np.full(k, self.times - 1)
        self.closed[~never] = ranks[2 * k :]
        self.merged = merged & ~never
        # the last moment at which a row still counts
        self.until = np.where(self.merged, np.searchsorted(times, closed + back, "right") - 1, np.where(never, self.closed, self.closed - 1))
        self.open, self.recent = np.zeros(k), np.zeros(k)

    def held(self, j: int) -> None:
        """Whether a set of some size that holds the token and ``j`` more was there: the latest close of those before says so."""
        code, row = _subsets(self.group, self.rest, self.size, j, self.n_tokens)
        ends = row[self.merged[row]]
        both, who = np.concatenate([code, code[self.merged[row]]]), np.concatenate([row, ends])
        key = _join(both, np.concatenate([self.opened[row], self.closed[ends]]), self.times)
        order = np.argsort(key)
        key, who, is_open = key[order], who[order], order < len(row)
        start = np.concatenate([[True], key[1:] != key[:-1]])
        both = both[order]
        # a subset's times lie above those of the one before, so one running maximum serves all
        base = np.cumsum(np.concatenate([[False], both[1:] != both[:-1]])) * np.int64(self.times)
        first = np.maximum.accumulate(np.where(start, np.arange(len(key)), 0))[is_open]
        asked, base_asked, n, last = who[is_open], base[is_open], self.n[who], base + self.closed[who]
        past, since = base_asked + self.opened[asked], base_asked + self.since[asked]
        least = [np.zeros(len(asked), np.int64), np.zeros(len(asked), np.int64)]
        before = np.full(len(key) + 1, -1)
        for m in np.unique(n)[::-1]:  # the smallest set is the most similar
            for found, kind, enough in ((least[0], is_open, past + 1), (least[1], ~is_open, since)):
                np.maximum.accumulate(np.where(kind & (n == m), last, -1), out=before[1:])
                found[before[first] >= enough] = m
        for best, found in zip((self.open, self.recent), least, strict=True):
            np.maximum.at(best, asked, np.where(found > 0, (j + 1) / (self.n[asked] + np.maximum(found, j + 1) - j - 1), 0.0))

    def met(self, j: int) -> None:
        """Pairs that share the token and ``j`` more, measured whole; what they share of rarer tokens counts in the group of the rarest."""
        code, row = _subsets(self.group, self.rest, self.size, j, self.n_tokens)
        key = _join(code, self.opened[row], self.times)
        order = np.argsort(key)
        key, row = key[order], row[order]
        # an earlier row meets those that opened after it and while it counts: one stretch of those with its subset
        first, end = (np.searchsorted(key, x, "right") for x in (key, key - self.opened[row] + self.until[row]))
        ends = np.cumsum(np.maximum(end - first, 0))
        for i in range(0, int(ends[-1]) if len(ends) else 0, PAIRS):
            pair = np.arange(i, min(i + PAIRS, ends[-1]))
            at = np.searchsorted(ends, pair, "right")
            p, q = row[end[at] - (ends[at] - pair)], row[at]
            t, close = self.opened[p], self.closed[q]
            shared = 1 + ((self.rest[p][:, :, None] == self.rest[q][:, None, :]) & (self.rest[p] >= 0)[:, :, None]).sum((1, 2))
            index = shared / (self.n[p] + self.n[q] - shared)
            np.maximum.at(self.open, p, np.where(close > t, index, 0.0))
            np.maximum.at(self.recent, p, np.where(self.merged[q] & (close < t) & (close >= self.since[p]), index, 0.0))


def best_of(back: int, key: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (repo, token, rest, key, t_open, t_close, merged, n), all rows of a (repo, token) in one partition, ``rest`` the set's
    tokens after ``token`` -> (key, a, b): the largest Jaccard index to open and to recent ones whose first shared token is this one, 0 if none.

    ``t_close`` is not before ``t_open``. Up to three shared tokens are looked up by size; four and more are pairs.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not (batches := [b for b in batches if b.num_rows]):
            return
        t = pa.Table.from_batches(batches).combine_chunks()
        number = lambda c: t[c].to_numpy().astype(np.int64)
        repo = t["repo"].combine_chunks().dictionary_encode().indices.to_numpy().astype(np.int64)
        tokens, token = np.unique(number("token"), return_inverse=True)
        group = np.unique(repo * len(tokens) + token, return_inverse=True)[1]
        lists = t["rest"].combine_chunks()
        size = lists.value_lengths().to_numpy().astype(np.int64)
        names, flat = np.unique(lists.flatten().to_numpy().astype(np.int64), return_inverse=True)
        rest = np.full((len(size), max(1, int(size.max()))), -1, np.int64)
        rest[np.arange(rest.shape[1]) < size[:, None]] = flat
        opened, n = number("t_open"), number("n")
        is_closed = t["t_close"].is_valid().to_numpy()
        zero = min(0, int(opened.min()))  # so that -1 is free for no close
        closed = np.where(is_closed, t["t_close"].fill_null(0).to_numpy() - zero, -1)
        merged = t["merged"].to_numpy(zero_copy_only=False).astype(bool)

        order = np.argsort(group, kind="stable")
        weight = np.cumsum((1 + size + size * (size - 1) // 2 + size * (size - 1) * (size - 2) // 6)[order])
        ends = np.flatnonzero(np.concatenate([group[order][1:] != group[order][:-1], [True]])) + 1
        done = 0
        for i, end in enumerate(ends):
            if i + 1 < len(ends) and weight[ends[i + 1] - 1] - (weight[done - 1] if done else 0) <= SUBSETS:
                continue  # whole groups, as many as fit
            own, done = order[done:end], end
            rows = _Rows(group[own], rest[own], size[own], n[own], len(names) + 1, opened[own] - zero, closed[own], merged[own], back)
            for j in range(3):
                if not j or (rows.size >= j).any():
                    rows.held(j)
            rows.met(3)
            found = np.flatnonzero((rows.open > 0) | (rows.recent > 0))
            yield pa.RecordBatch.from_arrays([t[key].take(pa.array(own[found])).combine_chunks(), pa.array(rows.open[found]), pa.array(rows.recent[found])], names=[key, "a", "b"])

    return run
