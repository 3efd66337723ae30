"""Near-duplicate lines by an exact set-similarity join.

A line is the set of its words (lower-cased in A-Z).  Words are ordered by
rarity; two sets of Jaccard similarity t or more share a word among the first
few of both (prefix filter), at positions that leave enough words after it
(positional filter), and have similar sizes (length filter).

Rarity comes from word counts in a fixed number of buckets, taken over all
lines; any order gives the same result, rare words first give few candidates.
Words are told apart by 43 bits of their hash, so two given words are taken
for one with a probability of about 1e-13.

1.  Every set sends a short posting (word, set, size, position, bitmap) for
    each prefix word to the part that owns the word.  Sets whose postings pass
    the length, positional and bitmap filters there get a common *leader*.
2.  The sets that have leaders are sent whole, once per leader (similar sets
    mostly have the same one for all their words), and each pair is verified
    where its smallest common leader is.

Words of very many lines are dealt out over several parts in step 1, without a
comparison, and large groups of one leader to pairs of blocks in step 2.
Parts return per set the number of links and the earliest linked line, never
the pairs.  A bitmap has the parity of the words that fall on each bit, so two
sets differ in at least as many words as their bitmaps in bits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicatormart.llm import _words
from indicatormart.llm._chunks import Ragged, by_part, freeze, thaw
from indicatormart.llm._components import unite
from indicatormart.llm._tables import bloom_of, in_bloom, mix, partitions, same_row, small, unused, written

THRESHOLD = 0.8
#: Buckets of the word counts; they are broadcast as 4 MB.
BUCKETS = 1 << 20
_BLOCKS = 256
#: A word in more lines than this is dealt to several parts in step 1, and its sets all go on to step 2.
SPLIT = 500_000
#: Postings of a word that step 1 compares; beyond it all of them go on to step 2.
RUN = 20_000
#: Sets of a block in step 2, if a leader has more.
GROUP = 2048
_PAIRS = 1 << 20
_SEGMENT = 4 << 20
_NO_ID = np.iinfo(np.int64).max


class Lines(NamedTuple):
    doc: np.ndarray       # text of each line with a word
    number: np.ndarray    # its line number in the text, from 0
    offset: np.ndarray    # where its words start in ``words``
    words: np.ndarray     # uint64, distinct and by rarity within a line (see ``_WORD``)
    key: np.ndarray       # uint64, equal for equal sets

    @property
    def size(self) -> np.ndarray:
        return np.diff(self.offset)


def lines_of(texts: _words.Texts, counts: np.ndarray | None) -> Lines:
    found = _words.words_of(texts)
    if not len(found.start):
        none = np.zeros(0, np.int64)
        return Lines(none, none, np.zeros(1, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64))
    doc = _words.owner(texts.offset, found.start)
    breaks = np.flatnonzero(texts.buf == 10)
    before = np.searchsorted(breaks, found.start)
    number = before - np.searchsorted(breaks, texts.offset[:-1])[doc]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (number[1:] != number[:-1])
    line = np.cumsum(new) - 1
    value = found.hash & _WORD
    if counts is not None:
        value = value | _rarity(counts)[_bucket(value)]
    words, of = [], []
    for low in range(0, int(line[-1]) + 1, 1 << 16):     # so many lines fit in the upper bits of a sort key
        a, b = np.searchsorted(line, [low, low + (1 << 16)])
        both = np.sort(((line[a:b] - low).astype(np.uint64) << np.uint64(48)) | value[a:b])
        keep = np.ones(len(both), bool)
        keep[1:] = both[1:] != both[:-1]
        both = both[keep]
        words.append(both & np.uint64((1 << 48) - 1))
        of.append((both >> np.uint64(48)).astype(np.int64) + low)
    words, of = np.concatenate(words), np.concatenate(of)
    offset = np.searchsorted(of, np.arange(int(line[-1]) + 2))
    size = np.diff(offset).astype(np.uint64)
    key = mix(np.add.reduceat(mix(words & _WORD, 3), offset[:-1]) + size, 4)
    return Lines(doc[new], number[new], offset, words, key)


#: A word is 43 bits of its hash; above them stand 5 bits of its count's size, so values sort by rarity.
_WORD = np.uint64((1 << 43) - 1)


def _bucket(words: np.ndarray) -> np.ndarray:
    return (words & np.uint64(BUCKETS - 1)).astype(np.int64)


def _rarity(counts: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(counts + 1.0), 31).astype(np.uint64) << np.uint64(43)


def _at_least(x: np.ndarray) -> np.ndarray:
    return np.ceil(x - 1e-9).astype(np.int64)


def _needed(a: np.ndarray, b: np.ndarray, t: float) -> np.ndarray:
    """Words that sets of these sizes share at least."""
    return _at_least((a + b) * (t / (1 + t)))


def _segments(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, _words.Texts]]:
    texts = _words.texts_of(batch.column(2))
    ids, keys = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1))
    for a, b in _words.groups(texts, _SEGMENT):
        yield ids[a:b], keys[a:b], _words.part(texts, a, b)


# -- pass 1: lines and word counts --------------------------------------------------------------

_LINES = "doc long, text_key long, line_no int, set_key long, n_words int, block int, counts binary"


def _read_lines(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]):
        counts = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for ids, keys, texts in _segments(batch):
                x = lines_of(texts, None)
                counts += np.bincount(_bucket(x.words), minlength=BUCKETS)
                yield pa.record_batch({
                    "doc": pa.array(ids[x.doc]), "text_key": pa.array(keys[x.doc]),
                    "line_no": pa.array(x.number.astype(np.int32)), "set_key": pa.array(x.key.view(np.int64)),
                    "n_words": pa.array(x.size.astype(np.int32)),
                    "block": pa.nulls(len(x.doc), pa.int32()), "counts": pa.nulls(len(x.doc), pa.binary())})
        some = [b for b in range(_BLOCKS) if counts.reshape(_BLOCKS, -1)[b].any()]
        yield pa.record_batch({
            "doc": pa.nulls(len(some), pa.int64()), "text_key": pa.nulls(len(some), pa.int64()),
            "line_no": pa.nulls(len(some), pa.int32()), "set_key": pa.nulls(len(some), pa.int64()),
            "n_words": pa.nulls(len(some), pa.int32()), "block": pa.array(some, pa.int32()),
            "counts": pa.array([freeze([counts.reshape(_BLOCKS, -1)[b]]) for b in some], pa.binary())})

    return written(rows.mapInArrow(run, _LINES), "lines")


def _counts(lines: DataFrame) -> np.ndarray:
    def add(group):
        import pandas as pd
        total = sum(thaw(x)[0] for x in group["counts"])
        return pd.DataFrame({"block": group["block"][:1], "counts": [freeze([total])]})

    out = np.zeros((_BLOCKS, BUCKETS // _BLOCKS), np.uint32)
    for r in lines.where("block is not null").select("block", "counts").groupBy("block").applyInPandas(
            add, "block int, counts binary").collect():
        out[r.block] = np.minimum(thaw(r.counts)[0], 2**32 - 1)
    return out.ravel()


# -- postings ----------------------------------------------------------------------------------

def _prefixes(x: Lines, once: np.ndarray, t: float) -> tuple[np.ndarray, np.ndarray]:
    """Lines and positions of the prefix words of the lines ``once``."""
    size = x.size[once]
    length = size - _at_least(size * t) + 1
    row = np.repeat(once, length)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(length) - length, length)


class Bitmaps(NamedTuple):
    """Per set the parity of its words in 64 bits times ``width``, a power of two that grows with the set.

    ``half`` is the same at half the width, so sets of neighbouring widths can be compared.
    """
    full: np.ndarray
    half: np.ndarray
    width: np.ndarray

    def take(self, index: np.ndarray) -> Bitmaps:
        return Bitmaps(self.full[index], self.half[index], self.width[index])

    def near(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Positions of the pairs that differ in at most ``most`` bits; the sets b are not smaller than the sets a."""
        left, apart = np.arange(len(a)), np.zeros(len(a), np.int64)
        alike = self.width[a] == self.width[b]
        for j in range(self.full.shape[1]):
            on = left[self.width[a[left]] > j]
            other = np.where(alike[on], self.full[b[on], j], self.half[b[on], j])
            apart[on] += np.bitwise_count(self.full[a[on], j] ^ other)
            left = left[apart[left] <= most[left]]
        return left


MAX_WIDTH = 16


def _widths(size: np.ndarray) -> np.ndarray:
    return np.minimum(1 << np.ceil(np.log2(np.maximum(size, 64) / 64)).astype(np.int64), MAX_WIDTH)


def _bitmap_words(words: np.ndarray, offset: np.ndarray) -> Ragged:
    """The 64-bit words of the sets' bitmaps."""
    size = np.diff(offset)
    width = _widths(size)
    out = np.concatenate([[0], np.cumsum(width)])
    found = np.zeros(int(out[-1]), np.uint64)
    for w in np.unique(width):
        some = np.flatnonzero(width == w)
        part = Ragged(offset, words).take(some)
        slot = mix(part.values & _WORD, 5) & np.uint64(64 * int(w) - 1)
        bit = np.left_shift(np.uint64(1), slot & np.uint64(63))
        for j in range(int(w)):
            mine = bit if w == 1 else np.where((slot >> np.uint64(6)) == j, bit, np.uint64(0))
            found[out[some] + j] = np.bitwise_xor.reduceat(mine, part.offset[:-1])
    return Ragged(out, found)


def _bitmaps(raw: Ragged) -> Bitmaps:
    width = np.diff(raw.offset)
    most = int(width.max()) if len(width) else 1
    full, half = np.zeros((len(width), most), np.uint64), np.zeros((len(width), most), np.uint64)
    for j in range(most):
        on = width > j
        full[on, j] = raw.values[raw.offset[:-1][on] + j]
    for w in np.unique(width[width > 1]):
        on = np.flatnonzero(width == w)
        half[on, :w // 2] = full[on, :w // 2] ^ full[on, w // 2:w]
    return Bitmaps(full, half, width)


#: Postings carry 40 bits of the set key, and 32 of the word besides its part: they only choose candidates.
_SET = np.uint64((1 << 40) - 1)


def _once(x: Lines) -> np.ndarray:
    """The first line of each set in a segment."""
    return np.sort(np.unique(x.key, return_index=True)[1])


def _joined(group) -> list:
    """The arrays of all messages, one after another."""
    sent = [thaw(x) for x in group["data"]]
    out = []
    for column in zip(*sent, strict=True):
        if isinstance(column[0], Ragged):
            sizes = np.concatenate([np.diff(c.offset) for c in column])
            out.append(Ragged(np.concatenate([[0], np.cumsum(sizes)]), np.concatenate([c.values for c in column])))
        else:
            out.append(np.concatenate(column))
    return out


def _pairs(run: np.ndarray, size: np.ndarray, t: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions (a before b) of all pairs of one run with fitting sizes; sorted by run and size."""
    if not len(run):
        return
    width = int(size.max()) + 1
    key = run * width + size
    most = np.minimum(np.floor(size / t + 1e-9).astype(np.int64), width - 1)
    n = np.searchsorted(key, run * width + most, side="right") - np.arange(len(run)) - 1
    total = np.concatenate([[0], np.cumsum(n)])
    at = 0
    while at < len(run):
        to = int(np.searchsorted(total, total[at] + _PAIRS, side="right")) - 1
        to = min(max(to, at + 1), len(run))
        for lo in range(0, int(total[to] - total[at]), _PAIRS):     # one row alone may have more pairs
            flat = np.arange(lo, min(lo + _PAIRS, int(total[to] - total[at]))) + total[at]
            a = np.searchsorted(total, flat, side="right") - 1
            yield a, a + 1 + (flat - total[a])
        at = to


def _leaders(rows: DataFrame, counts: np.ndarray, t: float, parts: int) -> DataFrame:
    """Written ``(low, leader)``: set keys (40 bits) and a leader of each word's group of candidates."""
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for _, _, texts in _segments(batch):
                x = lines_of(texts, counts)
                row, pos = _prefixes(x, _once(x), t)
                value = x.words[x.offset[row] + pos]
                deals = np.maximum(1, -(-counts[_bucket(value)].astype(np.int64) // SPLIT)).astype(np.uint64)
                word, key = mix(value & _WORD, 2), x.key[row] & _SET
                size = np.where(deals > 1, -1, x.size[row]).astype(np.int32)      # -1: no comparison
                owner = np.where(deals > 1, mix(word + key % deals, 9), word)
                order, edge = by_part(owner, parts)
                values = [word.astype(np.uint32), key.astype(np.uint32), (key >> np.uint64(32)).astype(np.uint8), size,
                          pos.astype(np.int32), _bitmap_words(x.words, x.offset).take(row)]
                full = np.flatnonzero(np.diff(edge))
                yield pa.record_batch({
                    "part": pa.array(full, pa.int32()),
                    "data": pa.array([freeze([v.take(s) if isinstance(v, Ragged) else v[s] for v in values])
                                      for s in (order[edge[p]:edge[p + 1]] for p in full)], pa.binary())})

    def find(group):
        import pandas as pd
        word, low, high, size, pos, raw = _joined(group)
        key = low.astype(np.uint64) | (high.astype(np.uint64) << np.uint64(32))
        order = np.lexsort((key, size, word))
        order = order[np.concatenate([[True], (word[order][1:] != word[order][:-1]) | (key[order][1:] != key[order][:-1])])]
        word, key, size, pos = word[order], key[order], size[order].astype(np.int64), pos[order]
        run = np.cumsum(np.concatenate([[True], word[1:] != word[:-1]])) - 1
        length = np.bincount(run)[run]
        leader = np.zeros(len(key), np.uint64)
        whole = (size < 0) | (length > RUN)
        leader[whole] = mix(word[whole].astype(np.uint64), 14) & _SET
        some = np.flatnonzero((length > 1) & ~whole)
        label = np.arange(len(some))
        key_, size_, pos_, bitmaps = key[some], size[some], pos[some].astype(np.int64), _bitmaps(raw.take(order[some]))
        hit = np.zeros(len(some), bool)
        for a, b in _pairs(run[some], size_, t):
            a, b = _fits(a, b, size_, pos_, bitmaps, t)
            hit[a] = True
            hit[b] = True
            unite(label, a, b)
        least = np.full(len(some), _SET)
        np.minimum.at(least, label, key_)
        leader[some] = least[label]
        live = whole
        live[some] |= hit
        return pd.DataFrame({"low": key[live].astype(np.int64), "leader": leader[live].astype(np.int64)}).drop_duplicates()

    sent = rows.mapInArrow(run, "part int, data binary")
    return written(sent.groupBy("part").applyInPandas(find, "low long, leader long").distinct(), "leaders")


def _fits(a, b, size, pos, bitmaps: Bitmaps, t: float) -> tuple[np.ndarray, np.ndarray]:
    """The pairs that pass the positional and bitmap filters."""
    need = _needed(size[a], size[b], t)
    ok = np.minimum(size[a] - pos[a], size[b] - pos[b]) >= need
    a, b, need = a[ok], b[ok], need[ok]
    left = bitmaps.near(a, b, size[a] + size[b] - 2 * need)
    return a[left], b[left]


# -- verification ------------------------------------------------------------------------------

def _whole_sets(rows: DataFrame, counts: np.ndarray, live: np.ndarray) -> DataFrame:
    """``(low, set_key, doc, line_no, words)`` of the sets that (probably) have a leader; words as 6 bytes each."""
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for ids, _, texts in _segments(batch):
                x = lines_of(texts, counts)
                once = _once(x)
                once = once[in_bloom(live, x.key[once] & _SET)]
                sets = Ragged(x.offset, x.words).take(once)
                raw = np.ascontiguousarray(sets.values.view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()
                yield pa.record_batch({
                    "low": pa.array((x.key[once] & _SET).astype(np.int64)), "set_key": pa.array(x.key[once].view(np.int64)),
                    "doc": pa.array(ids[x.doc[once]]), "line_no": pa.array(x.number[once].astype(np.int32)),
                    "words": pa.array([raw[6 * a:6 * b] for a, b in zip(sets.offset, sets.offset[1:], strict=False)],
                                      pa.binary())})

    return rows.mapInArrow(run, "low long, set_key long, doc long, line_no int, words binary")


def _in_blocks(sets: DataFrame, leaders: DataFrame, parts: int) -> DataFrame:
    """One row per set, leader and pair of blocks: where it is compared, and its block if only with the other one."""
    many = written(leaders.groupBy("leader").count().where(F.col("count") > GROUP).select(
        "leader", F.ceil(F.col("count") / GROUP).cast("int").alias("blocks")), "large_leaders")
    lists = leaders.groupBy("low").agg(F.sort_array(F.collect_list("leader")).alias("leaders"))
    sent = sets.join(lists, "low").withColumn("leader", F.explode("leaders")).join(small(many), "leader", "left")
    sent = sent.withColumn("blocks", F.coalesce("blocks", F.lit(1))).withColumn(
        "own", F.pmod("set_key", "blocks").cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    place = F.xxhash64("leader", F.least("own", "other"), F.greatest("own", "other"))
    return sent.select(F.pmod(place, F.lit(parts)).cast("int").alias("part"), place.alias("place"),
                       F.when(F.col("own") == F.col("other"), -1).otherwise(F.col("own")).alias("own"),
                       "leader", "leaders", "set_key", "doc", "line_no", "words")


def _ragged(column) -> np.ndarray:
    return np.concatenate([[0], np.cumsum([len(v) for v in column])]).astype(np.int64)


def _verify(sent: DataFrame, t: float) -> DataFrame:
    """``(set_key, n_links, doc, line_no)``: links found and the earliest linked line, several rows per set."""
    def check(group):
        import pandas as pd
        place, own, key, doc, number, leader = (group[c].to_numpy() for c in (
            "place", "own", "set_key", "doc", "line_no", "leader"))
        bytes_ = np.frombuffer(b"".join(group["words"]), np.uint8).reshape(-1, 6)
        values = np.zeros((len(bytes_), 8), np.uint8)
        values[:, :6] = bytes_
        sets = Ragged(_ragged(group["words"]) // 6, values.view(np.uint64).ravel())
        lists = Ragged(_ragged(group["leaders"]), np.concatenate(list(group["leaders"])))
        order = np.lexsort((number, doc, key, place))
        first = np.concatenate([[True], (place[order][1:] != place[order][:-1]) | (key[order][1:] != key[order][:-1])])
        order = order[first]                                           # of a set, its earliest line
        order = order[np.lexsort((np.diff(sets.offset)[order], place[order]))]
        place, own, key, doc, number, leader = (v[order] for v in (place, own, key, doc, number, leader))
        sets, lists = sets.take(order), lists.take(order)
        size = np.diff(sets.offset)
        run = np.cumsum(np.concatenate([[True], place[1:] != place[:-1]])) - 1
        bitmaps = _bitmaps(_bitmap_words(sets.values, sets.offset))
        in_set, in_list = _member(sets), _member(lists)
        turn = np.zeros(len(key), np.int64)                            # place of this leader among the set's
        earlier = lists.values < np.repeat(leader, np.diff(lists.offset))
        np.add.at(turn, np.repeat(np.arange(len(key)), np.diff(lists.offset)), earlier)
        nil = np.zeros(len(key), np.int64)
        links, best = np.zeros(len(key), np.int64), np.full(len(key), len(key))
        rank = np.empty(len(key), np.int64)
        early = np.lexsort((number, doc))
        rank[early] = np.arange(len(key))
        for a, b in _pairs(run, size, t):
            ok = (own[a] < 0) | (own[a] != own[b])
            a, b = _fits(a[ok], b[ok], size, nil, bitmaps, t)
            here = in_list(a, b, nil[a], turn[a]) == 0                 # no smaller common leader
            a, b = a[here], b[here]
            near = in_set(a, b, nil[a], size[a]) * (1 + t) >= t * (size[a] + size[b]) - 1e-9
            a, b = a[near], b[near]
            links += np.bincount(a, minlength=len(key)) + np.bincount(b, minlength=len(key))
            np.minimum.at(best, a, rank[b])
            np.minimum.at(best, b, rank[a])
        hit = links > 0
        with_ = early[best[hit]]
        return pd.DataFrame({"set_key": key[hit], "n_links": links[hit], "doc": doc[with_], "line_no": number[with_]})

    return sent.groupBy("part").applyInPandas(check, "set_key long, n_links long, doc long, line_no int")


def _member(sets: Ragged) -> Callable[..., np.ndarray]:
    """Counts, for pairs of rows (a, b), of the values ``lo`` to ``hi`` of a that b holds."""
    _, code = np.unique(sets.values, return_inverse=True)
    width = int(code.max()) + 1 if len(code) else 1
    member = np.sort(np.repeat(np.arange(len(sets.offset) - 1), np.diff(sets.offset)) * width + code)

    def shared(a: np.ndarray, b: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        n = hi - lo
        total = np.zeros(len(a), np.int64)
        cuts = np.concatenate([[0], np.cumsum(n)])
        at = 0
        while at < len(a):
            to = min(max(int(np.searchsorted(cuts, cuts[at] + 2 * _PAIRS, side="right")) - 1, at + 1), len(a))
            m = n[at:to]
            pair = np.repeat(np.arange(at, to), m)
            inside = np.arange(len(pair)) - np.repeat(np.cumsum(m) - m, m)
            want = b[pair] * width + code[sets.offset[a[pair]] + lo[pair] + inside]
            found = np.minimum(np.searchsorted(member, want), len(member) - 1)
            total[at:to] += np.bincount(pair - at, weights=member[found] == want, minlength=to - at).astype(np.int64)
            at = to
        return total

    return shared


# -- the operator ------------------------------------------------------------------------------

def match_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                threshold: float = THRESHOLD) -> DataFrame:
    """One row per line with a word: class, links and whether it stays.

    ``(doc_id, text_key, line_no, n_words, class_doc_id, class_line_no,
    n_copies, n_links, kept)``.  Lines are split at ``\\n`` and numbered from 0;
    ``n_words`` counts distinct words.  Lines of the same word set form a
    class, named after its first line, with ``n_copies`` lines; ``n_links``
    counts the other classes of Jaccard similarity ``threshold`` or more.  A
    line goes (``kept`` false) if an earlier line, by (doc_id, line_no), is of
    its class or of a linked one, whether that one stays or not.

    Null ids come after all others.  Rows that share id and line number do not
    precede each other, so repeated rows get equal results.  Null, empty and
    blank texts and blank lines give no rows; nor does an empty table.  Other
    columns are ignored.
    """
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(int(_NO_ID))).alias("doc"),
                       F.xxhash64(F.col(text_col)).alias("text_key"), F.col(text_col).cast("string").alias("text"))
    parts = 4 * partitions(docs.sparkSession)
    read = _read_lines(rows)
    counts = _counts(read)
    lines = read.where("block is null").drop("block", "counts")
    leaders = _leaders(rows, counts, threshold, parts)
    sets = _whole_sets(rows, counts, bloom_of(leaders, "low"))
    found = written(_verify(_in_blocks(sets, leaders, parts), threshold), "line_links")
    linked = found.groupBy("set_key").agg(F.sum("n_links").alias("n_links"),
                                          F.min(F.struct("doc", "line_no")).alias("linked"))
    classes = written(lines.groupBy("set_key").agg(
        F.min(F.struct("doc", "line_no")).alias("first"), F.count("*").alias("n_copies"))
        .join(linked, "set_key", "left"), "line_classes")
    here = F.struct("doc", "line_no")
    gone = (F.col("first") < here) | F.coalesce(F.col("linked") < here, F.lit(False))

    def shown(c: str):
        return F.when(F.col(c) != int(_NO_ID), F.col(c))

    return lines.join(classes, "set_key").select(
        shown("doc").alias("doc_id"), "text_key", "line_no", F.col("n_words").cast("long").alias("n_words"),
        shown("first.doc").alias("class_doc_id"), F.col("first.line_no").alias("class_line_no"), "n_copies",
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), (~gone).alias("kept"))


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        length_col: str | None = "n_chars", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the lines that ``match_lines`` drops; every document stays, if only with an empty text.

    Columns and their order stay; ``length_col``, if there, becomes the new
    number of characters of changed texts.
    """
    gone = match_lines(docs, id_col, text_col, threshold).where(~F.col("kept"))
    gone = written(gone.groupBy(F.col("doc_id").alias("k_id"), F.col("text_key").alias("k_text")).agg(
        F.array_sort(F.collect_set("line_no")).alias("k_lines")), "dropped_lines")
    total = gone.agg(F.sum(F.size("k_lines"))).first()[0] or 0
    gone = small(gone) if total <= 1_000_000 else gone
    joined = docs.join(gone, same_row(docs, id_col, text_col, gone), "left")
    left = F.array_join(F.filter(F.split(docs[text_col], "\n"), lambda x, i: ~F.array_contains(gone["k_lines"], i)), "\n")
    changed = gone["k_lines"].isNotNull()
    text = F.when(changed, left).otherwise(docs[text_col])
    new = unused(joined, "new_text")
    out = joined.withColumn(new, text)
    columns = []
    for name, kind in docs.dtypes:
        if name == text_col:
            columns.append(F.col(new).alias(name))
        elif name == length_col:
            columns.append(F.when(changed, F.length(new)).otherwise(docs[name]).cast(kind).alias(name))
        else:
            columns.append(docs[name])
    return out.select(*columns)
