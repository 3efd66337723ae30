"""Passages that repeat across documents, exact or fuzzy: seeds, collinear chains, alignment.

0.  Of texts that are equal byte by byte only the smallest id goes on; the others
    are passages as a whole.
1.  Seeds: every k-mer of ``K`` words, at all its positions.  Of 20 words of
    which 16 are equal, 4 or more in a row are, so no such window is without one.
2.  A k-mer that up to ``RARE`` documents hold is sent as its position, and
    linked to all earlier holders.  A k-mer of more documents is sent with its
    surroundings: the 16 words on both sides, as 8-bit hashes.  Equal surroundings
    are one class.  The part that owns the k-mer links each class to the smallest
    document whose surroundings agree with it in a window of ``MIN_STRETCH``
    words around the seed (a share of ``IDENTITY``), after trying every holder
    before it; if none agrees, to the first holder.
3.  The links between two documents are chained in order in both, with a cost
    for the gaps; a Fenwick tree gives the best chain before each link.  Two
    disjoint windows of a passage give two disjoint seeds, so a chain that
    covers fewer than ``2 * K`` words goes, unless its surroundings agreed.
4.  Chains are aligned word by word and stretched at both ends, also past words
    left out or put in.  If a chain fails, the windows of its links remain.
5.  Aligned stretches of a document that touch or overlap form a passage,
    whichever earlier documents they come from; passages of ``MIN_WORDS``
    words or more are the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from indicatormart.llm._chunks import NO_ID, Chunk, Ragged, by_part, freeze, parts_for, read_chunk, thaw, tokenise
from indicatormart.llm._native import words as native_words
from indicatormart.llm._tables import bloom_of, in_bloom, mix, small, written

K = 4
#: Cost of a word in a gap, on either side; a seed is worth ``K``.
GAP = 0.05
IDENTITY = 0.8
MIN_STRETCH = 20
MIN_WORDS = 50
#: Words on each side of a seed that a window of ``MIN_STRETCH`` words may take in.
SIDE = MIN_STRETCH - K
#: Equal words that such a window needs besides its seed.
EQUAL = int(np.ceil(IDENTITY * MIN_STRETCH - 1e-9)) - K
#: Words beyond a chain's ends that the alignment may take in.
STRETCH = 64
#: Words between stretches of one passage.
JOIN = 3
#: Documents up to which a k-mer's holders are all linked.
RARE = 4
#: Groups of equal texts whose keys (24 bytes each) may be broadcast.
COPY_GROUPS = 1_000_000
#: Holders of a k-mer that are tried one after another; beyond, only those that share a rare word around it.
STEPS = 64


# -- seeds -------------------------------------------------------------------------------------

def kmers(chunk: Chunk, k: int = K) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(document, place, key)`` of every k-mer of the chunk's documents that have an id, in order."""
    words = chunk.words[chunk.codes]
    n = max(0, len(words) - k + 1)
    total = np.zeros(n, np.uint64)
    for j in range(k):
        total += words[j:j + n] * np.uint64((0x9E3779B97F4A7C15 * (2 * j + 1)) % 2**64)
    doc = np.repeat(np.arange(len(chunk.sizes)), chunk.sizes)
    at = np.flatnonzero((doc[:n] == doc[k - 1:]) & ((chunk.flags[doc[:n]] & NO_ID) == 0))
    return doc[at], at, mix(total[at], 11)


def surroundings(chunk: Chunk, doc: np.ndarray, at: np.ndarray) -> np.ndarray:
    """8-bit hashes of the ``SIDE`` words before each k-mer (nearest first) and after it; 0 beyond the text."""
    short = np.maximum(mix(chunk.words, 14) >> np.uint64(56), np.uint64(1)).astype(np.uint8)[chunk.codes]
    offset = chunk.offset
    low, high = offset[doc], offset[doc + 1]
    out = np.zeros((len(at), 2 * SIDE), np.uint8)
    for j in range(SIDE):
        before, after = at - 1 - j, at + K + j
        some = before >= low
        out[some, j] = short[before[some]]
        some = after < high
        out[some, SIDE + j] = short[after[some]]
    return out


def class_of(key: np.ndarray, around: np.ndarray) -> np.ndarray:
    key, total = _low(key).astype(np.uint64), np.zeros(len(key), np.uint64)
    for j in range(2 * SIDE):
        total += mix(around[:, j].astype(np.uint64), 20 + j)
    return mix(key ^ mix(total, 15), 16)


def _best(equal: np.ndarray) -> np.ndarray:
    """Most equal words in a window around each seed, given which of its surroundings are equal."""
    left = np.cumsum(equal[:, :SIDE], 1, dtype=np.int8)
    right = np.cumsum(equal[:, SIDE:], 1, dtype=np.int8)
    best = np.maximum(left[:, -1], right[:, -1])
    for a in range(1, SIDE):
        np.maximum(best, left[:, a - 1] + right[:, SIDE - a - 1], out=best)
    return best


def alike(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    out = np.empty(len(one), bool)
    for lo in range(0, len(one), 1 << 16):
        x, y = one[lo:lo + (1 << 16)], two[lo:lo + (1 << 16)]
        out[lo:lo + (1 << 16)] = _best((x == y) & (x > 0)) >= EQUAL
    return out


def _low(key: np.ndarray) -> np.ndarray:
    """The low halves of keys; within a part few different keys share one, and their surroundings differ."""
    return (key & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def _ask(chunks: DataFrame, parts: int) -> DataFrame:
    """``(part, chunk, data)``: the chunk's distinct k-mers, as sorted differences of their low halves, and how many
    of its documents hold each (255 at most)."""
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for row in batch.to_pylist():
                doc, _, key = kmers(read_chunk(row))
                known, held = _holders(doc, key)
                order, low, edge, some = _by_low(known, parts)
                n = np.minimum(held[order], 255).astype(np.uint8)
                data = [zstandard.ZstdCompressor(level=1).compress(np.vstack([
                    np.diff(low[edge[p]:edge[p + 1]], prepend=np.uint32(0)).view(np.uint8).reshape(-1, 4).T,
                    n[edge[p]:edge[p + 1]]]).tobytes()) for p in some]
                yield pa.record_batch({"part": pa.array(some, pa.int32()),
                                       "chunk": pa.array([row["chunk"]] * len(some), pa.int64()),
                                       "data": pa.array(data, pa.binary())})

    return chunks.mapInArrow(run, "part int, chunk long, data binary")


def _holders(doc: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and the number of documents of each (``doc`` ascends)."""
    order = np.argsort(key, kind="stable")
    key, doc = key[order], doc[order]
    start, _ = _runs(key)
    if not len(start):
        return key, np.zeros(0, np.int64)
    new = np.ones(len(key), np.int64)
    new[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
    return key[start], np.add.reduceat(new, start)


def _by_low(known: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Order of keys by part and low half, the low halves, where each part starts, and the parts that have any."""
    order, edge = by_part(known, parts)
    owner = np.repeat(np.arange(parts, dtype=np.uint64), np.diff(edge))
    by = np.argsort(owner << np.uint64(32) | _low(known[order]), kind="stable")
    order = order[by]
    return order, _low(known[order]), edge, np.flatnonzero(np.diff(edge))


def _codes(key: np.ndarray, parts: int) -> np.ndarray:
    """A key's part and low half."""
    owner = ((key >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
    return owner << np.uint64(32) | _low(key)


def _ask_shared(chunk: Chunk, parts: int, answers):
    """The chunk's shared k-mers: of rare ones key, holder and its first position; of others the classes with key,
    surroundings, first holder and whether others of the chunk hold it too."""
    doc, at, key = kmers(chunk)
    ids, pos = chunk.ids[doc], (at - chunk.offset[doc]).astype(np.int32)
    known, which = np.unique(key, return_inverse=True)
    shared, common = np.zeros(len(known), bool), np.zeros(len(known), bool)
    order, _, edge, _ = _by_low(known, parts)
    for p, data in answers:
        mine = order[edge[p]:edge[p + 1]]
        bits = np.unpackbits(np.frombuffer(data, np.uint8)).reshape(2, -1)[:, :len(mine)] > 0
        shared[mine], common[mine] = bits
    rare = np.flatnonzero((shared & ~common)[which])
    by = rare[np.lexsort((at[rare], ids[rare], which[rare]))]
    new = np.ones(len(by), bool)
    new[1:] = (which[by[1:]] != which[by[:-1]]) | (ids[by[1:]] != ids[by[:-1]])
    by = by[new]
    few = key[by], [_low(key[by]), ids[by], pos[by]]
    some = common[which]
    doc, at, key, ids, pos = doc[some], at[some], key[some], ids[some], pos[some]
    around = surroundings(chunk, doc, at)
    some = _best(around > 0) >= EQUAL
    key, ids, around, pos, at = key[some], ids[some], around[some], pos[some], at[some]
    kind = class_of(key, around)
    order = np.lexsort((at, ids, kind))
    start, last = _runs(kind[order])
    first = order[start]
    return few, (key[first], [_low(key[first]), around[first], ids[first], pos[first], ids[order[last]] != ids[first]])


def _runs(sorted_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of equal keys start, and where they end (inclusive)."""
    if not len(sorted_keys):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    start = np.flatnonzero(np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]]))
    return start, np.append(start[1:], len(sorted_keys)) - 1


def _serve_shared(group):
    """For each chunk two bits per k-mer it sent: other documents hold it; more than ``RARE`` documents hold it."""
    import pandas as pd
    sent = [np.frombuffer(zstandard.ZstdDecompressor().decompress(x), np.uint8).reshape(5, -1) for x in group["data"]]
    low = [np.cumsum(x[:4].T.copy().view(np.uint32).ravel(), dtype=np.uint32) for x in sent]
    edge = np.cumsum([0, *(len(s) for s in low)])
    _, which = np.unique(np.concatenate(low), return_inverse=True)
    held = np.bincount(which, weights=np.concatenate([x[4] for x in sent]))[which]
    bits = np.stack([held > 1, held > RARE])
    return pd.DataFrame({"chunk": group["chunk"], "part": group["part"],
                         "data": [_bits(bits[:, a:b]) for a, b in zip(edge, edge[1:], strict=False)]})


def _bits(bits: np.ndarray) -> bytes:
    """Each row packed, up to whole bytes."""
    return np.packbits(bits, axis=1).tobytes()


def _rare(around: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(row, column, frequency)`` of the words that two rows must share one of to be alike.

    A window has ``SIDE`` words besides its seed, and at least ``EQUAL`` of them
    agree: so the rarest word that agrees is among the ``SIDE - EQUAL + 1``
    rarest of the window in both rows.
    """
    n = len(around)
    often = np.zeros((n, 2 * SIDE), np.int64)
    for j in range(2 * SIDE):
        often[:, j] = np.bincount(around[:, j], minlength=1 << 8)[around[:, j]]
    often[around == 0] = 0
    rank = often * (2 * SIDE) + np.arange(2 * SIDE)
    chosen = np.zeros((n, 2 * SIDE), bool)
    for a in range(SIDE + 1):
        columns = np.concatenate([np.arange(a), SIDE + np.arange(SIDE - a)])
        least = np.argpartition(rank[:, columns], SIDE - EQUAL, axis=1)[:, :SIDE - EQUAL + 1]
        chosen[np.arange(n)[:, None], columns[least]] = True
    row, column = np.nonzero(chosen & (often > 1))
    return row, column, often[row, column]


def _first_alike(around: np.ndarray, open_: np.ndarray) -> np.ndarray:
    """For each ``open_`` row the first row before it that is alike, else the row itself."""
    best = np.arange(len(around))
    row, column, _ = _rare(around)
    word = column.astype(np.int64) << 16 | around[row, column]
    order = np.lexsort((row, word))
    row, word = row[order], word[order]
    at = np.flatnonzero(open_[row])
    start, last = _runs(word)
    first = np.repeat(start, last - start + 1)
    step = 0
    while True:
        at = at[first[at] + step < at]        # from the first holder of the word on
        if not len(at):
            return best
        later, earlier = row[at], row[first[at] + step]
        better = earlier < best[later]
        later, earlier, at = later[better], earlier[better], at[better]
        good = alike(around[later], around[earlier])
        np.minimum.at(best, later[good], earlier[good])
        at = at[~good]
        step += 1


def first_holders(key: np.ndarray, around: np.ndarray) -> np.ndarray:
    """For each class (sorted by key, then first holder) the first class of its key that is alike; maybe itself."""
    n = len(key)
    best = np.arange(n)
    start, last = _runs(key)
    first = np.repeat(start, last - start + 1)
    size = np.repeat(last - start + 1, last - start + 1)
    left = np.flatnonzero(first < np.arange(n))
    for step in range(STEPS):
        left = left[first[left] + step < left]
        if not len(left):
            return best
        good = alike(around[left], around[first[left] + step])
        best[left[good]] = first[left[good]] + step
        left = left[~good]
    still = np.zeros(n, bool)
    still[left] = True
    for lo in np.unique(first[left]):
        hi = lo + size[lo]
        found = _first_alike(around[lo:hi], still[lo:hi]) + lo
        best[lo:hi] = np.where(still[lo:hi], found, best[lo:hi])
    return best


def _serve(group):
    """For each chunk its links: of rare k-mers key and all holders; of classes key, class, document and position that
    an earlier document is alike to (else its first holder), and whether it is alike."""
    import pandas as pd
    sent = [thaw(x) for x in group["data"]]
    few, many = [x[:3] for x in sent], [x[3:] for x in sent]
    rare = _serve_rare(few)
    edge = np.cumsum([0, *(len(s[0]) for s in many)])
    key, around, ids, pos, more = (np.concatenate(x) for x in zip(*many, strict=True))
    kind = class_of(key.astype(np.uint64), around)
    order = np.lexsort((pos, ids, kind))
    start, last = _runs(kind[order])
    which = np.empty(len(key), np.int64)
    which[order] = np.repeat(np.arange(len(start)), last - start + 1)
    lead = order[start]                                     # the first holder of each class
    rank = np.lexsort((kind[lead], pos[lead], ids[lead], key[lead]))
    lead = lead[rank]
    place = np.empty(len(rank), np.int64)
    place[rank] = np.arange(len(rank))
    best = first_holders(key[lead], around[lead])
    begin, end = _runs(key[lead])
    first = np.repeat(begin, end - begin + 1)
    alone = best == np.arange(len(lead))
    partner = lead[np.where(alone, first, best)][place[which]]
    # a class that several documents hold agrees with its own first holder
    sure = ~alone[place[which]] | more | (ids != ids[lead[place[which]]])
    partner = np.where(sure & alone[place[which]], lead[place[which]], partner)
    useful = more | (ids != ids[partner])
    out = []
    for i, (a, b) in enumerate(zip(edge, edge[1:], strict=False)):
        at = np.flatnonzero(useful[a:b]) + a
        out.append(freeze([*rare[i], key[at], kind[at], ids[partner[at]], pos[partner[at]], sure[at]]))
    return pd.DataFrame({"chunk": group["chunk"], "part": group["part"], "data": out})


def _serve_rare(sent: list[list[np.ndarray]]) -> list[list[np.ndarray]]:
    """For each sender its keys that an earlier document holds too: key, number of holders before its own last one,
    their ids and positions."""
    key, ids, pos = (np.concatenate(x) for x in zip(*sent, strict=True))
    order = np.lexsort((pos, ids, key))
    key, ids, pos = key[order], ids[order], pos[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (ids[1:] != ids[:-1])      # rows that share an id are one holder
    key, ids, pos = key[new], ids[new], pos[new]
    start, last = _runs(key)
    names = key[start]
    holders = Ragged(np.append(start, len(key)), np.arange(len(key)))
    out = []
    for mine, own, _ in sent:
        at = np.searchsorted(names, mine)
        use, which = np.unique(at[own > ids[start[at]]] if len(at) else at, return_inverse=True)
        greatest = np.full(len(use), -2**63)
        np.maximum.at(greatest, which, own[own > ids[start[at]]] if len(at) else own)
        taken = holders.take(use)
        before = ids[taken.values] < np.repeat(greatest, np.diff(taken.offset))
        n = np.add.reduceat(before, taken.offset[:-1]) if len(use) else np.zeros(0, np.int64)
        out.append([names[use], n.astype(np.uint8), ids[taken.values[before]], pos[taken.values[before]]])
    return out


# -- chains ------------------------------------------------------------------------------------

def chains(x: np.ndarray, y: np.ndarray, k: int = K, gap: float = GAP) -> list[np.ndarray]:
    """Disjoint collinear chains of links ``(x, y)`` sorted by x (distinct), best first.

    A chain's score is ``k`` per link less ``gap`` per word between links, in
    both documents.  A Fenwick tree over the ranks of y holds the best
    ``score + gap * (x + y)`` of the links so far.
    """
    n = len(x)
    if n == 1:
        return [np.zeros(1, np.int64)]
    dx, dy = np.diff(x), np.diff(y)
    if (dy > 0).all() and (gap * (dx + dy) < k).all():
        return [np.arange(n)]           # in order throughout, and every step pays
    rank = np.argsort(np.argsort(y, kind="stable"), kind="stable") + 1
    tree_score, tree_link = [-np.inf] * (n + 1), [-1] * (n + 1)
    score, before = [0.0] * n, [-1] * n
    for i in range(n):
        cost = gap * float(x[i] + y[i])
        best, link, r = -np.inf, -1, int(rank[i]) - 1
        while r > 0:
            if tree_score[r] > best:
                best, link = tree_score[r], tree_link[r]
            r &= r - 1
        if link >= 0 and best - cost > 0 and y[link] < y[i]:
            score[i], before[i] = k + best - cost, link
        else:
            score[i] = float(k)
        value, r = score[i] + cost, int(rank[i])
        while r <= n:
            if value > tree_score[r]:
                tree_score[r], tree_link[r] = value, i
            r += r & -r
    used, out = [False] * n, []
    for i in sorted(range(n), key=lambda i: -score[i]):
        path = []
        while i >= 0 and not used[i]:
            used[i] = True
            path.append(i)
            i = before[i]
        if path:
            out.append(np.array(path[::-1]))
    return out


_CHAINS = "doc_id long, from_id long, a_low int, a_size int, b_low int, a_at binary, b_at binary, words binary"


def _links(chunk: Chunk, parts: int, answers) -> tuple[np.ndarray, ...]:
    """``(document, x, source, y, sure)``: x of the document and y of an earlier source begin a shared k-mer."""
    rare, many = [], []
    for p, data in answers:
        code, n, ids, pos, *rest = thaw(data)
        rare.append((np.uint64(p) << np.uint64(32) | code, n, ids, pos))
        many.append(rest)
    doc, at, seed = kmers(chunk)
    x = at - chunk.offset[doc]
    # rare k-mers: every earlier holder
    code, n, ids, pos = (np.concatenate(v) for v in zip(*rare, strict=True))
    begin = np.cumsum(n, dtype=np.int64) - n
    order = np.argsort(code)
    code, n, begin = code[order], n[order], begin[order]
    mine = _codes(seed, parts)
    at_code = np.minimum(np.searchsorted(code, mine), max(len(code) - 1, 0))
    hit = np.flatnonzero(code[at_code] == mine) if len(code) else np.zeros(0, np.int64)
    found = []
    for r in range(RARE):
        some = hit[n[at_code[hit]] > r]
        holder = begin[at_code[some]] + r
        ok = ids[holder] < chunk.ids[doc[some]]
        some, holder = some[ok], holder[ok]
        found.append((doc[some], x[some], ids[holder], pos[holder].astype(np.int64), np.zeros(len(some), bool)))
    # k-mers of many documents: the partner of their class
    asked, kind, from_id, from_pos, sure = (np.concatenate(v) for v in zip(*many, strict=True))
    order = np.argsort(kind)
    kind, from_id, from_pos, sure = kind[order], from_id[order], from_pos[order], sure[order]
    some = np.flatnonzero(np.isin(_low(seed), asked))
    mine = class_of(seed[some], surroundings(chunk, doc[some], at[some]))
    link = np.minimum(np.searchsorted(kind, mine), max(len(kind) - 1, 0))
    ok = np.flatnonzero(kind[link] == mine) if len(kind) else np.zeros(0, np.int64)
    ok = ok[from_id[link[ok]] < chunk.ids[doc[some[ok]]]]
    link, some = link[ok], some[ok]
    found.append((doc[some], x[some], from_id[link], from_pos[link].astype(np.int64), sure[link]))
    doc, x, source, y, sure = (np.concatenate(v) for v in zip(*found, strict=True))
    order = np.lexsort((x, source, doc))
    return doc[order], x[order], source[order], y[order], sure[order]


def _chain_chunk(key, left, right, parts):
    """Chains of the chunk's documents with earlier ones, and the words of their surroundings."""
    import pandas as pd
    chunk = read_chunk(left.iloc[0])
    if not len(right):
        return pd.DataFrame({c.split()[0]: [] for c in _CHAINS.split(", ")})
    doc, x, source, y, sure = _links(chunk, parts, zip(right["part"], right["data"], strict=True))
    thin = _thinned(doc, source, x, y)
    doc, x, source, y, sure = doc[thin], x[thin], source[thin], y[thin], sure[thin]
    start = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (source[1:] != source[:-1])])) \
        if len(doc) else np.zeros(0, np.int64)
    offset = chunk.offset
    rows = []
    if len(start):      # pairs of documents with too few words in common can't have a chain that stays
        step = np.minimum(np.diff(x, prepend=0), K)
        step[start] = K
        good = (np.add.reduceat(step, start) >= 2 * K) | np.logical_or.reduceat(sure, start)
    for i in np.flatnonzero(good) if len(start) else ():
        lo, hi = int(start[i]), int(start[i + 1]) if i + 1 < len(start) else len(doc)
        d = int(doc[lo])
        for path in chains(x[lo:hi], y[lo:hi]):
            b, a = x[lo:hi][path], y[lo:hi][path]
            if K + int(np.minimum(np.diff(b), K).sum()) < 2 * K and not sure[lo:hi][path].any():
                continue
            b_low, a_low = max(0, int(b[0]) - STRETCH), max(0, int(a[0]) - STRETCH)
            b_high = min(int(chunk.sizes[d]), int(b[-1]) + K + STRETCH)
            words = chunk.words[chunk.codes[offset[d] + b_low:offset[d] + b_high]]
            rows.append((int(chunk.ids[d]), int(source[lo]), a_low, int(a[-1]) - a_low + K + STRETCH, b_low, (a - a_low).astype(np.int32).tobytes(),
                         (b - b_low).astype(np.int32).tobytes(), words.astype(np.uint32).tobytes()))
    return pd.DataFrame(rows, columns=[c.split()[0] for c in _CHAINS.split(", ")])


def _thinned(doc: np.ndarray, source: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The links (sorted by document, source and x) that matter.

    Of those of one place in the source, as repeated words have them, one in
    8 words; of links that follow each other word by word in both documents,
    every ``K``-th and the last.
    """
    order = np.lexsort((x // 8, y, source, doc))
    new = np.ones(len(order), bool)
    differs = np.zeros(max(0, len(order) - 1), bool)
    for v in (doc, source, y, x // 8):
        differs |= v[order][1:] != v[order][:-1]
    new[1:] = differs
    some = np.sort(order[new])
    doc, source, x, y = doc[some], source[some], x[some], y[some]
    run = np.zeros(len(some), bool)
    run[1:] = (doc[1:] == doc[:-1]) & (source[1:] == source[:-1]) & (x[1:] == x[:-1] + 1) & (y[1:] == y[:-1] + 1)
    at = np.arange(len(some))
    number = at - np.maximum.accumulate(np.where(run, 0, at))
    return some[(number % K == 0) | ~np.append(run[1:], False)]


# -- alignment ---------------------------------------------------------------------------------

def _common(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence."""
    best = np.zeros(len(b) + 1, np.int64)
    for word in a:
        # row by row: a match adds one to the cell before it; the rest is a running maximum
        best[1:] = np.maximum.accumulate(np.maximum(best[1:], np.where(b == word, best[:-1] + 1, 0)))
    return int(best[-1])


def _run_out(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """How far both go on alike word by word (one point a match, minus one a difference), and the matches."""
    n = min(len(a), len(b))
    if not n:
        return 0, 0
    same = a[:n] == b[:n]
    score = np.cumsum(np.where(same, 1, -1))
    at = int(np.argmax(score))
    return (at + 1, int(same[:at + 1].sum())) if score[at] > 0 else (0, 0)


def _extend(a: np.ndarray, b: np.ndarray) -> tuple[int, int, int]:
    """How far ``b`` goes on alike, also past a word that one side lacks: its words, the aligned columns, and the equal
    ones.  Beyond a chain fewer than ``K`` words in a row are equal, so the next ones tell whether it goes on."""
    taken = columns = equal = 0
    while True:
        for skip_a, skip_b in ((0, 0), (1, 0), (0, 1)):
            x, y = a[skip_a:], b[skip_b:]
            if any(p == q for p, q in zip(x[:K].tolist(), y[:K].tolist(), strict=False)):
                n, same = _run_out(x, y)
                if 2 * same - n > 2 * (skip_a + skip_b):        # a word left out costs more than a different one
                    break
        else:
            return taken, columns, equal
        a, b = x[n:], y[n:]
        taken, columns, equal = taken + skip_b + n, columns + skip_a + skip_b + n, equal + same


def align(a: np.ndarray, b: np.ndarray, a_at: np.ndarray, b_at: np.ndarray, k: int = K) -> tuple[int, int, float]:
    """Start and end in ``b`` of the stretch around a chain, and the share of aligned words that are equal."""
    back, length, equal = _extend(a[:a_at[0]][::-1], b[:b_at[0]][::-1])
    on, columns, same = _extend(a[a_at[-1] + k:], b[b_at[-1] + k:])
    length, equal = length + columns, equal + same
    if (a_at - b_at == a_at[0] - b_at[0]).all():
        n = int(b_at[-1] - b_at[0]) + k
        length += n
        equal += int((a[a_at[0]:a_at[0] + n] == b[b_at[0]:b_at[0] + n]).sum())
    else:
        for i in range(len(a_at) - 1):
            one, two = a[a_at[i]:a_at[i + 1]], b[b_at[i]:b_at[i + 1]]
            length += max(len(one), len(two))
            equal += int((one == two).sum()) if len(one) == len(two) else _common(one, two)
        length += k
        equal += int((a[a_at[-1]:a_at[-1] + k] == b[b_at[-1]:b_at[-1] + k]).sum())
    return int(b_at[0]) - back, int(b_at[-1]) + k + on, equal / length


def window(a: np.ndarray, b: np.ndarray, x: int, y: int) -> tuple[int, int, float] | None:
    """Start, end and equal share in ``b`` of the windows of enough equal words around the link of x and y."""
    reach = SIDE + K - 1                      # windows of links thinned out reach as far
    back, on = min(x, y, reach), min(len(a) - x, len(b) - y, K + reach)
    same = a[x - back:x + on] == b[y - back:y + on]
    if len(same) < MIN_STRETCH:
        return None
    total = np.concatenate([[0], np.cumsum(same)])
    good = np.flatnonzero(total[MIN_STRETCH:] - total[:-MIN_STRETCH] >= EQUAL + K)
    if not len(good):
        return None
    inside = good[0] + np.flatnonzero(same[good[0]:good[-1] + MIN_STRETCH])     # it starts and ends with equal words
    low, high = int(inside[0]), int(inside[-1]) + 1
    return y - back + low, y - back + high, float(same[low:high].mean())


def _aligned(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            a, b = (np.frombuffer(r[c], np.uint32) for c in ("from_words", "words"))
            a_at, b_at = (np.frombuffer(r[c], np.int32) for c in ("a_at", "b_at"))
            if not len(a) or a_at[-1] + K > len(a):
                continue                      # another row of a repeated id, too short for this chain
            low, high, share = align(a, b, a_at, b_at)
            found, ends = [], range(len(b_at))
            if share >= IDENTITY and high - low >= MIN_STRETCH:
                found, ends = [(low, high, share)], sorted({0, len(b_at) - 1})
            for i in ends:
                got = window(a, b, int(a_at[i]), int(b_at[i]))
                if got and not (found and low <= got[0] and got[1] <= high):
                    found.append(got)
            out += [{"doc_id": r["doc_id"], "from_id": r["from_id"], "low": r["b_low"] + lo, "high": r["b_low"] + hi,
                     "identity": part} for lo, hi, part in found]
        yield pa.RecordBatch.from_pylist(out, pa.schema([
            ("doc_id", pa.int64()), ("from_id", pa.int64()), ("low", pa.int64()), ("high", pa.int64()),
            ("identity", pa.float64())]))


def _word_rows(chunks: DataFrame, wanted: np.ndarray) -> DataFrame:
    """``(from_id, all_words)`` of the documents whose ids are (probably) ``wanted``."""
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for row in batch.to_pylist():
                chunk = read_chunk(row)
                offset = chunk.offset
                some = np.flatnonzero(in_bloom(wanted, chunk.ids.view(np.uint64)) & ((chunk.flags & NO_ID) == 0))
                words = [chunk.words[chunk.codes[offset[d]:offset[d + 1]]].astype(np.uint32).tobytes() for d in some]
                for at in range(0, max(len(some), 1), 1024):
                    yield pa.record_batch({"from_id": pa.array(chunk.ids[some[at:at + 1024]]),
                                           "all_words": pa.array(words[at:at + 1024], pa.binary())})

    return chunks.mapInArrow(run, "from_id long, all_words binary")


def stretches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Written ``(doc_id, from_id, low, high, identity)``: words low to high align with an earlier document."""
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    first = _copies(texts)
    h, n = F.xxhash64("text"), F.length("text")
    marked = texts.join(small(first, COPY_GROUPS), (h == first["h"]) & (n == first["n"]), "left").select(
        "id", F.when(F.coalesce(F.col("id") <= F.col("first_id"), F.lit(True)), F.col("text")).alias("text"))
    chunks = tokenise(marked, "id", "text", slim=True)
    parts = parts_for(chunks)
    answered = "chunk long, part int, data binary"
    shared = _ask(chunks, parts).groupBy("part").applyInPandas(_serve_shared, answered)

    def ask(key, left, right):
        import pandas as pd
        chunk = read_chunk(left.iloc[0])
        sides = _ask_shared(chunk, parts, zip(right["part"], right["data"], strict=True))
        cut = [by_part(keys, parts) for keys, _ in sides]
        some = sorted({int(p) for _, edge in cut for p in np.flatnonzero(np.diff(edge))})
        data = [freeze([v[order[edge[p]:edge[p + 1]]] for (order, edge), (_, values) in zip(cut, sides, strict=True)
                        for v in values]) for p in some]
        return pd.DataFrame({"part": some, "chunk": [chunk.id] * len(some), "data": data})

    answers = chunks.groupBy("chunk").cogroup(shared.groupBy("chunk")).applyInPandas(
        ask, "part int, chunk long, data binary").groupBy("part").applyInPandas(_serve, answered)
    found = written(chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(
        lambda key, left, right: _chain_chunk(key, left, right, parts), _CHAINS), "chains")
    wanted = bloom_of(found.select("from_id").distinct(), "from_id")
    pairs = found.join(_word_rows(chunks, wanted), "from_id").select(
        "doc_id", "from_id", "b_low", "a_at", "b_at", "words",
        F.expr("substring(all_words, 4 * a_low + 1, 4 * a_size)").alias("from_words"))
    aligned = pairs.mapInArrow(_aligned, "doc_id long, from_id long, low long, high long, identity double")
    whole = texts.join(small(first, COPY_GROUPS), (h == first["h"]) & (n == first["n"])).where(
        F.col("id") > F.col("first_id")).select(
        F.col("id").alias("doc_id"), F.col("first_id").alias("from_id"), F.lit(0).cast("long").alias("low"),
        F.size(native_words(F.col("text"))).cast("long").alias("high"), F.lit(1.0).alias("identity"))
    return written(aligned.union(whole.where("high > 0")), "stretches")


def _copies(texts: DataFrame) -> DataFrame:
    """Written ``(h, n, first_id)`` of each text that several ids hold: its hash, its length and the smallest id."""
    ids = texts.where(F.col("id").isNotNull() & F.col("text").isNotNull()).select(
        "id", F.xxhash64("text").alias("h"), F.length("text").alias("n"))
    return written(ids.groupBy("h", "n").agg(F.min("id").alias("first_id"), F.max("id").alias("last_id")).where(
        "first_id < last_id").select("h", "n", "first_id"), "copies")


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      min_words: int = MIN_WORDS) -> DataFrame:
    """Passages that occur in an earlier document as well, one row per passage.

    ``(doc_id, start_word, end_word, n_words, from_ids, identity)``: words are
    counted from 0, the end is exclusive; ``from_ids`` lists the earlier
    documents (of each seed all holders, or of many the first that goes on alike; of
    equal texts the first), ``identity`` is the mean share
    of equal words over the aligned stretches.  The first document of a group
    has no row; it is in the others' ``from_ids``.

    Null, empty and blank texts and rows of a null id have no passages; a
    document is not compared with itself or with rows of the same id; equal
    rows give equal passages, listed once.  Other columns are ignored; an empty
    table gives no rows.
    """
    rows = stretches(docs, id_col, text_col).groupBy("doc_id", "from_id", "low", "high").agg(
        F.max("identity").alias("identity"))
    order = Window.partitionBy("doc_id").orderBy("low", "high", "from_id")   # one document's own stretches
    before = F.max("high").over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(before.isNull() | (F.col("low") > before + JOIN), 1).otherwise(0)
    part = F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0))
    grouped = rows.withColumn("new", new).withColumn("passage", part).groupBy("doc_id", "passage").agg(
        F.min("low").alias("start_word"), F.max("high").alias("end_word"),
        F.array_sort(F.collect_set("from_id")).alias("from_ids"),
        (F.sum(F.col("identity") * (F.col("high") - F.col("low"))) / F.sum(F.col("high") - F.col("low")))
        .alias("identity"))
    long = grouped.withColumn("n_words", F.col("end_word") - F.col("start_word"))
    return long.where(F.col("n_words") >= min_words).select(
        "doc_id", "start_word", "end_word", "n_words", "from_ids", "identity")
