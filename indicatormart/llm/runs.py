"""Periodic runs of words: maximal pairs from the LCP-interval tree of each document.

1.  Words become codes (equal words, equal codes).  Suffixes of all documents of
    a group are sorted by prefix doubling, only where a prefix still repeats; the
    ranks of each doubling give the longest common prefixes (LCP) of neighbours.
2.  The LCP-interval tree is walked bottom-up.  Each interval holds the sorted
    positions of its suffixes, and each position the class of the word to its
    left.  Where two children meet, a position and its new neighbour form a pair
    whose common prefix is the interval's LCP, so it can't be extended to the
    right; if the left words differ it can't be extended to the left either.
3.  A maximal pair at distance ``d`` with a common prefix of ``l`` words is a
    stretch of ``l + d`` words that repeats every ``d``.  With ``l`` long enough
    these pairs are the runs.  Pairs at multiples of the smallest period give the
    same stretch; the smallest one stays.

Intervals whose closest positions lie too far apart for their greatest LCP hold
no run and are skipped.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of text whose suffixes are sorted together; a longer text is alone.
GROUP_BYTES = 1 << 20


class Run(NamedTuple):
    start: int
    length: int
    period: int


class Rule(NamedTuple):
    """A run has ``min_words`` words or more, and at least ``min_times`` periods."""
    min_words: int = 6
    min_times: int = 4

    def holds(self, common: int, distance: int) -> bool:
        return common + distance >= self.min_words and common >= (self.min_times - 1) * distance

    @property
    def least_common(self) -> int:
        """The shortest common prefix of a pair that can be a run."""
        return min(max(self.min_words - d, (self.min_times - 1) * d, 1) for d in range(1, self.min_words + 1))


# -- suffixes ----------------------------------------------------------------------------------

def _starts(keys: np.ndarray) -> np.ndarray:
    """Where runs of equal sorted keys start."""
    return np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)


def _group_of(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For sorted keys the index where each one's group starts, and the size of its group."""
    start = _starts(keys)
    size = np.diff(np.append(start, len(keys)))
    return np.repeat(start, size), np.repeat(size, size)


def repeated_prefixes(keys: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(slot, positions, lcp)``: the suffix array, and the neighbours in it that share ``least`` words or more.

    Suffix ``slot`` and the one after it share ``lcp`` words.  ``keys`` are
    word codes that differ between documents, so no prefix crosses one's end.
    """
    n = len(keys)
    order = np.argsort(keys, kind="stable")
    start, size = _group_of(keys[order])
    rank = np.full(n + 1, -1, np.int64)
    rank[order] = start
    levels, step = [rank.astype(np.int32)], 1
    slots = np.flatnonzero(size > 1)
    while len(slots):
        at = order[slots]
        both = rank[at] * (n + 1) + rank[at + step] + 1     # a repeated prefix ends in its document
        by = np.argsort(both, kind="stable")
        at = at[by]
        start, size = _group_of(both[by])
        order[slots] = at
        rank[at] = slots[start]
        levels.append(rank.astype(np.int32))
        slots, step = slots[size > 1], 2 * step
    near = levels[min(least.bit_length() - 1, len(levels) - 1)][order]
    slot = np.flatnonzero(near[1:] == near[:-1])
    one, two = order[slot], order[slot + 1]
    lcp = np.zeros(len(slot), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        lcp += (levels[k][one + lcp] == levels[k][two + lcp]).astype(np.int64) << k
    good = lcp >= least
    return slot[good], order, lcp[good]


def _parts(slot: np.ndarray, order: np.ndarray, lcp: np.ndarray, rule: Rule) -> Iterator[tuple[list, list]]:
    """Positions and LCPs of each outermost interval that may hold a run."""
    if not len(slot):
        return
    first = _starts(slot - np.arange(len(slot)))
    last = np.append(first[1:], len(slot))
    size = last - first + 1
    edge = np.cumsum(size) - size
    which = np.repeat(np.arange(len(size)), size)
    at = order[np.arange(len(which)) - edge[which] + slot[first][which]]
    by = np.lexsort((at, which))
    gap = np.diff(at[by], append=0)
    gap[np.append(edge[1:], len(at)) - 1] = np.iinfo(np.int64).max // (2 * rule.min_times)
    close = np.minimum.reduceat(gap, edge) * (rule.min_times - 1) <= np.maximum.reduceat(lcp, first)
    for i in np.flatnonzero(close):
        yield at[edge[i]:edge[i] + size[i]].tolist(), lcp[first[i]:last[i]].tolist()


# -- the interval tree -------------------------------------------------------------------------

def _met(one: list, two: list, common: int, left: list, rule: Rule, found: dict) -> list:
    """The positions of two children of an interval with LCP ``common``; their maximal pairs go to ``found``."""
    if len(one) < len(two):
        one, two = two, one
    before = -1
    for at in two:
        k = bisect_left(one, at)
        if k and one[k - 1] != before:
            _pair(one[k - 1], at, common, left, rule, found)
        if k < len(one):
            _pair(at, one[k], common, left, rule, found)
        one.insert(k, at)
        before = at
    return one


def _pair(first: int, second: int, common: int, left: list, rule: Rule, found: dict) -> None:
    distance = second - first
    if left[first] != left[second] and rule.holds(common, distance):
        stretch = first, common + distance
        found[stretch] = min(distance, found.get(stretch, distance))


def walk(positions: list, lcps: list, left: list, rule: Rule, found: dict) -> None:
    """Bottom-up over the interval of neighbouring suffixes; ``left`` is the class of the word before a position."""
    stack: list[tuple[int, list]] = []
    last = [positions[0]]
    for common, at in zip(lcps, positions[1:], strict=True):
        while stack and stack[-1][0] > common:
            depth, held = stack.pop()
            last = _met(held, last, depth, left, rule, found)
        if stack and stack[-1][0] == common:
            last = _met(stack.pop()[1], last, common, left, rule, found)
        stack.append((common, last))
        last = [at]
    while stack:
        depth, held = stack.pop()
        last = _met(held, last, depth, left, rule, found)


def find_runs(texts: list[list[bytes]], rule: Rule) -> list[list[Run]]:
    """The runs of each text (a list of words), by start, then period."""
    size = np.array([len(t) for t in texts], np.int64)
    out: list[list[Run]] = [[] for _ in texts]
    if not size.sum():
        return out
    code = {w: i for i, w in enumerate(dict.fromkeys(chain.from_iterable(texts)))}
    words = np.fromiter(map(code.__getitem__, chain.from_iterable(texts)), np.int64, int(size.sum()))
    keys = words + np.repeat(np.arange(len(texts)), size) * len(code)
    offset = np.cumsum(size) - size
    left, found = None, {}
    for positions, lcps in _parts(*repeated_prefixes(keys, rule.least_common), rule):
        if left is None:
            before = np.concatenate([[-1], keys[:-1]])
            before[offset[size > 0]] = -1 - offset[size > 0]      # a text's start is a class of its own
            left = before.tolist()
        walk(positions, lcps, left, rule, found)
    for (start, length), period in found.items():
        text = int(np.searchsorted(offset, start, side="right")) - 1
        out[text].append(Run(start - int(offset[text]), length, period))
    for runs in out:
        runs.sort(key=lambda r: (r.start, r.period))
    return out


def collapse(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words that no run repeats: of each run its first period stays."""
    if not runs:
        return words
    edge = np.zeros(len(words) + 1, np.int64)
    for r in runs:
        edge[r.start + r.period] += 1
        edge[r.start + r.length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]


def _answer(ids: list, texts: list[list[bytes]], rule: Rule) -> pa.RecordBatch:
    found = find_runs(texts, rule)
    flat = np.array([r for runs in found for r in runs], np.int64).reshape(-1, 3)
    edge = np.concatenate([[0], np.cumsum([len(r) for r in found])]).astype(np.int32)
    rows = pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], Run._fields)
    return pa.record_batch({
        "id": pa.array(ids, pa.int64()), "n_words": pa.array([len(t) for t in texts], pa.int64()),
        "runs": pa.ListArray.from_arrays(pa.array(edge), rows),
        "collapsed": pa.array([b" ".join(collapse(t, r)) for t, r in zip(texts, found, strict=True)],
                              pa.binary()).cast(pa.string())})


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 6,
                  min_times: int = 4) -> DataFrame:
    """``(id, n_words, runs, collapsed)``, one row per document.

    ``runs`` is an array of ``(start, length, period)`` by start, then period;
    words are ``[^\\x20\\x09-\\x0D]+``, compared byte by byte and counted from 0.
    ``collapsed`` is the text without the words that runs repeat (of each run
    its first period stays), joined by blanks.

    One pass without a shuffle: a hot source or a group of copies is only more
    rows.  Null, empty and blank texts have no words, no runs and an empty
    ``collapsed``; a null id stays null; repeated rows are answered one by one.
    Stretches found at several periods keep the smallest, so there are no ties.
    A very long text is sorted alone and whole, with about 300 bytes of memory
    a word.  Other columns are ignored, whatever their names; an empty table
    gives no rows.
    """
    rule = Rule(min_words, min_times)

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            ids, texts, size = [], [], 0
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data = text.as_py() or b""
                ids.append(i)
                texts.append(data.split())
                size += len(data)
                if size >= GROUP_BYTES:
                    yield _answer(ids, texts, rule)
                    ids, texts, size = [], [], 0
            if ids:
                yield _answer(ids, texts, rule)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(run, "id long, n_words long, "
                                "runs array<struct<start: long, length: long, period: long>>, collapsed string")
