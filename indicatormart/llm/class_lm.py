"""Class-based n-grams: exchange clustering, class transitions and word emissions.

P(word | history) = P(class of word | class of the word before) * P(word | class).

Classes come from the exchange algorithm over all words.  It starts from the
``seed_words`` most frequent words, which are clustered by moving single words
between classes as long as the class-bigram likelihood grows (their bigram
counts over the whole training corpus are one bounded matrix), with every other
word in the class that suits its neighbours among them.  Then come rounds in
which every word of the corpus, seed words and rare ones included, moves to the
class that raises the likelihood most given the classes of all its neighbours.
A round is distributed by word; rounds end when the likelihood of all training
tokens no longer grows.  Counts, transitions and scores cover all documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indicatormart.llm._chunks import FLAG, NO_ID, Chunk, Ragged, by_part, freeze, parts_for, read_chunk, requests, thaw, tokenise
from indicatormart.llm._tables import written

SEED_WORDS = 1024
CLASSES = 48
SWEEPS = 8
#: Rounds over all words at most, and the mean gain a token (natural logarithm) below which they end sooner.
ROUNDS = 8
SETTLED = 0.005
#: From so many occurrences on a move is weighed with the word's own counts taken out, below by the slope.
EXACT_FROM = 32
#: Strength of the class unigram in a transition probability.
KAPPA = 20.0


# -- exchange clustering -----------------------------------------------------------------------

def _f(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1.0))


def exchange(bigrams: np.ndarray, classes: int, sweeps: int = SWEEPS) -> np.ndarray:
    """Class of each word by the exchange algorithm; the last word is the text end and stays alone.

    ``bigrams[i, j]`` counts word i followed by word j.  Words are visited by
    falling frequency; a word moves to the class of highest likelihood (ties:
    the lowest class).  Result: classes 0 to ``classes - 1`` for the words,
    ``classes`` for the text end.
    """
    n = len(bigrams) - 1
    c = classes + 1
    of = np.append(np.arange(n) % classes, classes)
    b = bigrams.astype(np.float64)
    member = np.zeros((n + 1, c))
    member[np.arange(n + 1), of] = 1
    right, left = b @ member, b.T @ member          # by class of the next and of the previous word
    table = member.T @ right
    for _ in range(sweeps):
        moved = 0
        for w in range(n):
            a, own = of[w], b[w, w]
            r, l = right[w].copy(), left[w].copy()
            r[a] -= own
            l[a] -= own
            table[a] -= r
            table[:, a] -= l
            table[a, a] -= own
            out, into = table.sum(1) + l, table.sum(0) + r     # other words' counts beside the word stay
            d = np.diagonal(table)
            gain = (_f(table + r) - _f(table)).sum(1) + (_f(table + l[:, None]) - _f(table)).sum(0) \
                - (_f(d + r) - _f(d)) - (_f(d + l) - _f(d)) + _f(d + r + l + own) - _f(d) \
                - (_f(out + r.sum() + own) - _f(out)) - (_f(into + l.sum() + own) - _f(into))
            gain[classes] = -np.inf
            new = int(np.argmax(gain))
            if gain[new] <= gain[a] + 1e-9:
                new = a
            table[new] += r
            table[:, new] += l
            table[new, new] += own
            if new != a:
                moved += 1
                of[w] = new
                right[:, a] -= b[:, w]
                right[:, new] += b[:, w]
                left[:, a] -= b[w]
                left[:, new] += b[w]
        if not moved:
            break
    return of


def _contexts(chunk: Chunk, seed: np.ndarray, of: np.ndarray, classes: int) -> tuple[np.ndarray, Ragged]:
    """Training counts of the chunk's words, and the contexts of the words that are no seed words.

    A context is the class before (0 to ``classes``), or the class after plus
    ``classes + 1``; ``classes`` is the text end.
    """
    doc = np.repeat(np.arange(len(chunk.sizes)), chunk.sizes)
    train = (chunk.flags[doc] & FLAG) > 0
    at = _index(seed, chunk.words)
    kind = np.where(at >= 0, of[at], -1)[chunk.codes]
    before, after = np.full(len(kind), classes), np.full(len(kind), classes)
    joint = doc[1:] == doc[:-1]
    before[1:][joint] = kind[:-1][joint]
    after[:-1][joint] = kind[1:][joint]
    counts = np.bincount(chunk.codes[train], minlength=len(chunk.words))
    ask = train & (kind < 0)
    codes = np.concatenate([chunk.codes[ask & (before >= 0)], chunk.codes[ask & (after >= 0)]])
    found = np.concatenate([before[ask & (before >= 0)], after[ask & (after >= 0)] + classes + 1]).astype(np.uint8)
    order = np.argsort(codes, kind="stable")
    offset = np.concatenate([[0], np.cumsum(np.bincount(codes, minlength=len(chunk.words)))])
    return counts, Ragged(offset, found[order])


def _index(keys: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Position of each of ``words`` in the sorted ``keys``, or -1."""
    if not len(keys):
        return np.full(len(words), -1)
    at = np.minimum(np.searchsorted(keys, words), len(keys) - 1)
    return np.where(keys[at] == words, at, -1)


def _preferences(table: np.ndarray) -> np.ndarray:
    """Log-likelihood gain of each class (columns) for each context (rows: classes before, then after)."""
    t = table + 0.5
    out, into, total = t.sum(1), t.sum(0), t.sum()
    return np.log(np.concatenate([t / out[:, None] / (into / total), t.T / into[:, None] / (out / total)]))[:, :-1]


# -- rounds over all words ---------------------------------------------------------------------

def _neighbours(chunk: Chunk, place: np.ndarray, classes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per word of the chunk the number of its contexts, then these contexts and how often training has them.

    A context is the class before, the class after plus ``classes + 1`` (or
    twice that: the word itself comes after); ``classes`` is the text end.
    """
    doc = np.repeat(np.arange(len(chunk.sizes)), chunk.sizes)
    train = (chunk.flags[doc] & FLAG) > 0
    kind = place[chunk.codes].astype(np.int64)
    joint = doc[1:] == doc[:-1]
    before, after = np.full(len(kind), classes), np.full(len(kind), classes)
    before[1:][joint], after[:-1][joint] = kind[:-1][joint], kind[1:][joint]
    again = np.zeros(len(kind), bool)
    again[:-1] = joint & (chunk.codes[1:] == chunk.codes[:-1])
    wide = 2 * classes + 3
    at = chunk.codes * wide
    found, n = np.unique(np.concatenate([(at + before)[train], (at + after + classes + 1)[train],
                                         (at + wide - 1)[train & again]]), return_counts=True)
    return np.bincount(found // wide, minlength=len(chunk.words)), found % wide, n


def _likelihood(table: np.ndarray) -> float:
    return float(_f(table).sum() - _f(table.sum(0)).sum() - _f(table.sum(1)).sum())


def _moved(seen: np.ndarray, place: np.ndarray, table: np.ndarray, classes: int) -> np.ndarray:
    """The best class of each word, from its contexts (rows of ``seen``), its class and the class bigram counts."""
    c = classes + 1
    gain = seen[:, :2 * c] @ _preferences(table)
    out = np.argmax(gain, 1)
    out[gain[np.arange(len(out)), out] <= gain[np.arange(len(out)), place] + 1e-9] = -1
    often = np.flatnonzero(seen[:, :c].sum(1) >= EXACT_FROM)
    for lo in range(0, len(often), 256):
        some = often[lo:lo + 256]
        row, a, own = np.arange(len(some)), place[some], seen[some, 2 * c]
        l, r = seen[some, :c].copy(), seen[some, c:2 * c].copy()
        l[row, a] -= own
        r[row, a] -= own
        t = np.repeat(table[None], len(some), 0)        # the counts without the word
        t[row, a] -= r
        t[row, :, a] -= l
        t[row, a, a] -= own
        d = np.einsum("wcc->wc", t)
        leave, come = t.sum(2) + l, t.sum(1) + r
        out_n, in_n = (r.sum(1) + own)[:, None], (l.sum(1) + own)[:, None]
        base = _f(t)
        gain = (_f(t + r[:, None]) - base).sum(2) + (_f(t + l[:, :, None]) - base).sum(1) \
            - (_f(d + r) - _f(d)) - (_f(d + l) - _f(d)) + _f(d + r + l + own[:, None]) - _f(d) \
            - (_f(leave + out_n) - _f(leave)) - (_f(come + in_n) - _f(come))
        gain[:, classes] = -np.inf
        best = np.argmax(gain, 1)
        out[some] = np.where(gain[row, best] > gain[row, a] + 1e-9, best, -1)
    return np.where(out < 0, place, out)


def _places(chunk: Chunk, parts: int, part: Iterator[int], data: Iterator[bytes], which: int = -1) -> np.ndarray:
    """One of the arrays of the answers (by default the last) put together for all words of the chunk."""
    owner, edge = by_part(chunk.words, parts)
    out = np.zeros(len(chunk.words), np.int64)
    for p, x in zip(part, data, strict=True):
        out[owner[edge[p]:edge[p + 1]]] = thaw(x)[which]
    return out


def _exchange_all(chunks: DataFrame, answers: DataFrame, parts: int, classes: int, tokens: int) -> DataFrame:
    """Answers ``(chunk, part, data)`` with the class of every word after the rounds over all words."""
    wide = 2 * classes + 3

    def ask(key, left, right):
        import pandas as pd
        chunk = read_chunk(left.iloc[0])
        place = _places(chunk, parts, right["part"], right["data"]).astype(np.uint8)
        size, found, n = _neighbours(chunk, place, classes)
        order, edge = by_part(chunk.words, parts)
        contexts = Ragged(np.concatenate([[0], np.cumsum(size)]), np.arange(len(found)))
        out = {"part": np.flatnonzero(np.diff(edge)), "data": []}
        for p in out["part"]:
            some = order[edge[p]:edge[p + 1]]
            at = contexts.take(some).values
            out["data"].append(freeze([chunk.words[some], place[some], size[some].astype(np.uint16),
                                       found[at].astype(np.uint8), n[at].astype(np.uint32)]))
        return pd.DataFrame({"part": out["part"], "chunk": chunk.id, "data": out["data"]})

    def gather(group):
        import pandas as pd
        sent = [thaw(x) for x in group["data"]]
        words, first, which = np.unique(np.concatenate([s[0] for s in sent]), return_index=True, return_inverse=True)
        place = np.concatenate([s[1] for s in sent])[first].astype(np.int64)
        held = np.repeat(which, np.concatenate([s[2] for s in sent])) * wide + np.concatenate([s[3] for s in sent])
        key, at = np.unique(held, return_inverse=True)
        n = np.bincount(at, weights=np.concatenate([s[4] for s in sent]), minlength=len(key)).astype(np.int64)
        word, context = key // wide, key % wide
        c = classes + 1
        after, start = (context >= c) & (context < 2 * c), context == classes
        table = np.bincount(place[word[after]] * c + context[after] - c, weights=n[after], minlength=c * c) \
            + np.bincount(classes * c + place[word[start]], weights=n[start], minlength=c * c)
        edge = np.cumsum([0, *(len(s[0]) for s in sent)])
        data = [place.astype(np.uint8), np.bincount(word, minlength=len(words)).astype(np.uint16),
                context.astype(np.uint8), n, group["chunk"].to_numpy(), edge, which.astype(np.uint32)]
        return pd.DataFrame({"part": group["part"][:1], "data": [freeze(data)],
                             "moves": [freeze([table.astype(np.int64)])]})

    def step(table):
        def run(batches: Iterator[pa.RecordBatch]):
            for batch in batches:
                for row in batch.to_pylist():
                    place, size, context, n, chunk, edge, which = thaw(row["data"])
                    offset = np.concatenate([[0], np.cumsum(size, dtype=np.int64)])
                    new = place.astype(np.int64)
                    for lo in range(0, len(place), 1 << 12):
                        hi = min(lo + (1 << 12), len(place))
                        a, b = offset[lo], offset[hi]
                        word = np.repeat(np.arange(hi - lo), size[lo:hi])
                        seen = np.bincount(word * wide + context[a:b], weights=n[a:b], minlength=(hi - lo) * wide)
                        new[lo:hi] = _moved(seen.reshape(hi - lo, wide), new[lo:hi], table, classes)
                    new = new.astype(np.uint8)
                    yield pa.record_batch({
                        "chunk": pa.array(chunk, pa.int64()), "part": pa.array([row["part"]] * len(chunk), pa.int32()),
                        "data": pa.array([freeze([new[which[a:b]]]) for a, b in zip(edge, edge[1:], strict=False)],
                                         pa.binary())})
        return run

    best, least = answers, -np.inf
    for turn in range(ROUNDS + 1):
        asked = chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(
            ask, "part int, chunk long, data binary")
        gathered = written(asked.groupBy("part").applyInPandas(gather, "part int, data binary, moves binary"), "contexts")
        table = _sum_tables(gathered, (classes + 1) ** 2).reshape(classes + 1, classes + 1).astype(np.float64)
        now = _likelihood(table)
        if now > least:
            best = answers
        if turn == ROUNDS or now - least < SETTLED * tokens:
            break
        least = now
        answers = written(gathered.select("part", "data").mapInArrow(step(table), "chunk long, part int, data binary"),
                          "places")
    return best


# -- the model ---------------------------------------------------------------------------------

def _proposals(chunks: DataFrame) -> DataFrame:
    """``(word, n)``: how often training has each word, and the token and document counts (null words)."""
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for row in batch.to_pylist():
                chunk = read_chunk(row)
                train = (chunk.flags & FLAG) > 0
                counts = np.bincount(chunk.codes[np.repeat(train, chunk.sizes)], minlength=len(chunk.words))
                top = np.flatnonzero(counts)
                words = chunk.words[top].view(np.int64).tolist() + [None, None]
                n = counts[top].tolist() + [int(chunk.sizes[train].sum()), int(train.sum())]
                yield pa.record_batch({"word": pa.array(words, pa.int64()),
                                       "docs": pa.array([False] * (len(n) - 1) + [True]), "n": pa.array(n, pa.int64())})

    return written(chunks.mapInArrow(run, "word long, docs boolean, n long").groupBy("word", "docs")
                   .agg(F.sum("n").alias("n")), "proposals")


def _seed_bigrams(chunks: DataFrame, seed: np.ndarray) -> np.ndarray:
    """Bigram counts of the seed words and the text end (last) over all training documents."""
    k = len(seed) + 1
    rows = max(1, -(-k // 32))

    def run(batches: Iterator[pa.RecordBatch]):
        total = np.zeros(k * k, np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                chunk = read_chunk(row)
                kind = _index(seed, chunk.words)[chunk.codes]
                offset = chunk.offset
                for d in np.flatnonzero((chunk.flags & FLAG) == 0):
                    kind[offset[d]:offset[d + 1]] = -1
                train = np.flatnonzero(chunk.flags & FLAG)
                ends = np.insert(kind, offset[:-1][train], k - 1)      # a text end before each training text
                ends = np.append(ends, k - 1)
                pair = (ends[:-1] >= 0) & (ends[1:] >= 0)
                total += np.bincount(ends[:-1][pair] * k + ends[1:][pair], minlength=k * k)
        table = total.reshape(k, k)
        for b in range(0, k, rows):
            if table[b:b + rows].any():
                yield pa.record_batch({"block": pa.array([b], pa.int32()),
                                       "data": pa.array([freeze([table[b:b + rows]])], pa.binary())})

    def add(group):
        import pandas as pd
        total = sum(thaw(x)[0] for x in group["data"])
        return pd.DataFrame({"block": group["block"][:1], "data": [freeze([total])]})

    found = chunks.mapInArrow(run, "block int, data binary").groupBy("block").applyInPandas(add, "block int, data binary")
    out = np.zeros((k, k), np.int64)
    for r in found.collect():
        out[r.block:r.block + rows] = thaw(r.data)[0]
    return out


def log_probabilities(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text",
                      classes: int = CLASSES, seed_words: int = SEED_WORDS) -> DataFrame:
    """Score every document with a model learned from the rows where ``train`` is true.

    Returns ``doc_id, learned, n_tokens, n_known, train_tokens, base_score,
    score``.  Tokens are the words lower-cased in A-Z and one end per document.
    ``base_score`` is the add-one unigram log10 probability, ``score`` the
    class model's.  Words that training has not seen count as one type whose
    probability is the training share of words seen once.  Null, empty and
    blank texts are one end token; null ids are scored but never learned from;
    repeated rows are repeated, and learned from as often; an empty table
    gives no rows; without training rows every known probability is zero and
    the unknown type takes all (score zero).
    """
    chunks = tokenise(docs, id_col, text_col, train & F.col(id_col).isNotNull(), by_chunk=True)
    proposals = _proposals(chunks)
    totals = {r.docs: r.n for r in proposals.where("word is null").collect()}
    train_docs = totals.get(True) or 0
    train_tokens = (totals.get(False) or 0) + train_docs
    top = proposals.where("word is not null").orderBy(F.desc("n"), "word").limit(seed_words).collect()
    by_rank = np.array([r.word for r in top], np.int64).view(np.uint64)
    order = np.argsort(by_rank)
    seed = by_rank[order]
    bigrams = _seed_bigrams(chunks, seed)
    falling = np.append(order.argsort(), len(order))   # seed words from the most frequent on, then the text end
    ranked = exchange(bigrams[np.ix_(falling, falling)], classes)
    of = np.empty(len(seed) + 1, np.int64)
    of[falling] = ranked
    member = np.zeros((len(of), classes + 1))
    member[np.arange(len(of)), of] = 1
    table = member.T @ bigrams @ member
    wish, common = _preferences(table), int(np.argmax(table.sum(0)[:classes]))
    parts = parts_for(chunks)

    def ask(chunk: Chunk):
        counts, contexts = _contexts(chunk, seed, of, classes)
        return chunk.words, [counts.astype(np.int32), contexts]

    def serve(group):
        import pandas as pd
        sent = [thaw(x) for x in group["data"]]
        words, which = np.unique(np.concatenate([s[0] for s in sent]), return_inverse=True)
        counts = np.bincount(which, weights=np.concatenate([s[1] for s in sent])).astype(np.int64)
        place = np.full(len(words), common, np.uint8)
        edge = np.cumsum([0, *(len(s[0]) for s in sent)])
        held = np.repeat(which, np.concatenate([np.diff(s[2].offset) for s in sent]))   # the word of each context
        seen_as = np.concatenate([s[2].values for s in sent])
        order = np.argsort(held, kind="stable")
        held, seen_as = held[order], seen_as[order]
        for lo in range(0, len(words), 1 << 13):
            hi = min(lo + (1 << 13), len(words))
            a, b = np.searchsorted(held, [lo, hi])
            seen = np.bincount((held[a:b] - lo) * len(wish) + seen_as[a:b], minlength=(hi - lo) * len(wish))
            seen = seen.reshape(hi - lo, len(wish))
            some = seen.any(1)
            place[lo:hi][some] = np.argmax(seen[some] @ wish, 1)
        at = _index(seed, words)
        place[at >= 0] = of[at[at >= 0]]
        data = [freeze([counts[which[a:b]], place[which[a:b]]]) for a, b in zip(edge, edge[1:], strict=False)]
        return pd.DataFrame({"chunk": [*group["chunk"], -1], "part": [*group["part"], -1], "data": [*data, b""],
                             "types": [0] * len(data) + [int((counts > 0).sum())],
                             "once": [0] * len(data) + [int((counts == 1).sum())]})

    asked = requests(chunks, ask, parts)
    answers = written(asked.groupBy("part").applyInPandas(
        serve, "chunk long, part int, data binary, types long, once long"), "answers")
    stats = answers.where("chunk = -1").agg(F.sum("types").alias("types"), F.sum("once").alias("once")).first()
    types = (stats.types or 0) + (1 if train_docs else 0)
    scale = np.log10(train_tokens + types + 1)
    end_count = train_docs
    answers = answers.where("chunk >= 0").select("chunk", "part", "data")
    if train_tokens:
        places = _exchange_all(chunks, answers, parts, classes, train_tokens)
    else:
        places = answers
    both = answers.withColumn("final", F.lit(False)).unionByName(places.withColumn("final", F.lit(True)))

    def read(key, left, right):
        import pandas as pd
        chunk = read_chunk(left.iloc[0])
        last, first = right[right["final"]], right[~right["final"]]
        counts = _places(chunk, parts, first["part"], first["data"], 0)
        place = _places(chunk, parts, last["part"], last["data"]).astype(np.uint8)
        sizes, docs_n = chunk.sizes, len(chunk.sizes)
        count = counts[chunk.codes]
        kind = np.where(count > 0, place[chunk.codes], classes + 1).astype(np.uint8)
        doc = np.repeat(np.arange(docs_n), sizes)
        known = np.bincount(doc, weights=count > 0, minlength=docs_n).astype(np.int64) + (end_count > 0)
        base = np.bincount(doc, weights=np.log10(count + 1.0), minlength=docs_n) + np.log10(end_count + 1.0)
        logs = np.bincount(doc, weights=np.log10(np.maximum(count, 1)), minlength=docs_n)
        ends = np.insert(kind, np.append(chunk.offset[:-1], len(kind)), classes)   # every text starts after an end
        learn = np.repeat((chunk.flags & FLAG) > 0, sizes + 1)
        # the pair that starts at a text's leading end up to the next text's end belongs to the text
        table = np.bincount(ends[:-1][learn].astype(np.int64) * (classes + 2) + ends[1:][learn],
                            minlength=(classes + 2) ** 2)
        base -= (sizes + 1) * scale
        return pd.DataFrame({"data": [freeze([chunk.ids, chunk.flags, sizes, known, base, logs, ends])],
                             "moves": [freeze([table])]})

    read_docs = written(chunks.groupBy("chunk").cogroup(both.groupBy("chunk")).applyInPandas(
        read, "data binary, moves binary"), "class_sequences")
    moves = _sum_tables(read_docs, (classes + 2) ** 2).reshape(classes + 2, classes + 2)
    unseen = min(0.5, ((stats.once or 0) + 1) / (train_tokens + 1)) if train_tokens else 1.0
    step, emit = _log_tables(moves, classes, unseen, end_count)

    def score(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for data in batch.column(0).to_pylist():
                ids, flags, sizes, known, base, logs, ends = thaw(data)
                ends = ends.astype(np.int64)
                term = step[ends[:-1], ends[1:]] + emit[ends[1:]]
                start = np.cumsum(sizes + 1) - sizes - 1
                total = np.add.reduceat(term, start) + logs
                none = (flags & NO_ID) > 0
                yield pa.record_batch({
                    "doc_id": pa.array(ids, pa.int64(), mask=none), "learned": pa.array((flags & FLAG) > 0),
                    "n_tokens": pa.array(sizes + 1), "n_known": pa.array(known), "base_score": pa.array(base),
                    "score": pa.array(total)})

    return read_docs.select("data").mapInArrow(
        score, "doc_id long, learned boolean, n_tokens long, n_known long, base_score double, score double") \
        .select("doc_id", "learned", "n_tokens", "n_known", F.lit(train_tokens).cast("long").alias("train_tokens"),
                "base_score", "score")


def _sum_tables(rows: DataFrame, size: int) -> np.ndarray:
    def run(batches: Iterator[pa.RecordBatch]):
        total = np.zeros(size, np.int64)
        for batch in batches:
            for data in batch.column(0).to_pylist():
                total += thaw(data)[0]
        at = np.flatnonzero(total)
        yield pa.record_batch({"at": pa.array(at), "n": pa.array(total[at])})

    out = np.zeros(size, np.int64)
    for r in rows.select("moves").mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():
        out[r.at] = r.n
    return out


def _log_tables(moves: np.ndarray, classes: int, unseen: float, ends: int) -> tuple[np.ndarray, np.ndarray]:
    """log10 of the class transitions, and per class what a word of it adds besides its log10 count.

    The known classes share ``1 - unseen``; the end's class has one word.
    """
    known = moves[:classes + 1, :classes + 1].astype(np.float64)
    into = known.sum(0)
    share = into / max(into.sum(), 1)
    smooth = np.empty((classes + 2, classes + 2))
    smooth[:classes + 1, :classes + 1] = (known + KAPPA * share) / (known.sum(1, keepdims=True) + KAPPA)
    smooth[classes + 1, :classes + 1] = share
    smooth[:, classes + 1] = 1
    with np.errstate(divide="ignore"):
        step = np.log10(smooth)
        emit = np.log10(1 - unseen) - np.log10(np.maximum(into, 1))
    step[~np.isfinite(step)] = 0
    emit = np.append(emit, np.log10(unseen))
    emit[classes] = np.log10(1 - unseen) if ends and unseen < 1 else 0.0
    return step, np.where(np.isfinite(emit), emit, 0.0)
