"""The corpus operators against brute force on small tables, and on odd rows."""

import base64
import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from indicatormart.llm import (class_lm, decontaminate, licenses, line_dedup, mixing, passages, quality_rules, ranking,
                               simhash, warc)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp string, counts string"


def prose(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join("".join(rng.choice(list("abcdefgh"), 6)) for _ in range(n))


PASSAGE = prose(7, 70)
ROWS = [
    (1, "Alpha beta gamma delta\nalpha BETA gamma delta\n\n" + prose(1, 60) + "."),
    (2, prose(2, 80) + "\n" + PASSAGE + "\nReleased under the MIT License."),
    (3, prose(3, 40) + " " + PASSAGE + " " + prose(4, 30)),
    (4, prose(2, 80) + "\n" + PASSAGE + "\nReleased under the MIT License."),
    (5, None), (6, ""), (7, "  \n\t "), (8, "one two"), (8, "one two"), (None, prose(5, 60)), (None, None),
    (9, "und " * 300), (10, prose(6, 30000)),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en" if i else None, "s", len(t or ""), "x", "y") for i, t in ROWS]
    return spark.createDataFrame(rows, SCHEMA).cache()


def words(t):
    return (t or "").encode().lower().split()


def test_simhash(spark, docs):
    got = simhash.near_duplicates(docs).collect()
    prints = [simhash.fingerprint(t) for _, t in ROWS]
    label = list(range(len(ROWS)))
    for _ in ROWS:
        for a in range(len(ROWS)):
            for b in range(len(ROWS)):
                if (prints[a] ^ prints[b]).bit_count() <= 3:
                    label[a] = label[b] = min(label[a], label[b])
    least = {}
    for (i, _), x in zip(ROWS, label, strict=True):
        if i is not None:
            least[x] = min(i, least.get(x, i))
    want = Counter((i, np.uint64(p).astype(np.int64).item(), least.get(x)) for (i, _), p, x in
                   zip(ROWS, prints, label, strict=True))
    assert Counter((r.doc_id, r.fp, r.component_id) for r in got) == want
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(label))


def test_simhash_shards_find_all_pairs():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**64, 3000, dtype=np.uint64)
    flip = np.left_shift(np.uint64(1), rng.integers(0, 64, 3000).astype(np.uint64))
    points = np.unique(np.concatenate([base, base ^ flip]))
    tree = simhash.shard_tree(points[::20], 16, 3)
    edges = []
    for _, who, own in simhash.visits(tree, points, 3):
        mine, other = who[own], who[~own]
        label = simhash.link(points[mine], points[other], 3)
        both = np.concatenate([mine, other])
        edges += [(both[i], both[x]) for i, x in enumerate(label) if i != x]
    found = np.arange(len(points))
    simhash.unite(found, *(np.array(x) for x in zip(*edges, strict=True)))
    want = np.arange(len(points))
    simhash.unite(want, *np.nonzero(np.bitwise_count(points[:, None] ^ points[None, :]) <= 3))
    assert np.array_equal(found, want)


def test_lines(spark, docs):
    lines = [((2**63 - 1 if i is None else i, k), frozenset(words(x))) for i, t in ROWS
             for k, x in enumerate((t or "").split("\n")) if words(x)]
    first = {}
    for at, s in lines:
        first[s] = min(at, first.get(s, at))
    near = {s: [o for o in first if o != s and len(s & o) >= 0.8 * len(s | o) - 1e-9] for s in first}
    want = Counter((at, len(s), len(near[s]), first[s] >= at and all(first[o] >= at for o in near[s])) for at, s in lines)
    got = line_dedup.match_lines(docs).collect()
    assert Counter(((2**63 - 1 if r.doc_id is None else r.doc_id, r.line_no), r.n_words, r.n_links, r.kept)
                   for r in got) == want
    out = line_dedup.drop_repeated_lines(docs)
    assert out.columns == docs.columns and out.count() == len(ROWS)
    text = {r.doc_id: r.text for r in out.collect()}
    assert text[4] == "" and text[1].startswith("Alpha beta gamma delta\n\n") and text[5] is None


def test_warc_round_trip_and_salvage(spark):
    pages = [(1, "http://a", "x"), (2, None, "x"), (3, "http://c\n", None), (4, "u", ""), (None, "u", "x"), (5, "u", "é" * 9)]
    got = warc.round_trip(spark, spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    best = {"x": 2, "": 4, "é" * 9: 5}
    want = set()
    for i, _, h in pages:
        data = (h or "").encode()
        again = best[h or ""] != i
        want.add((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
                  "revisit" if again else "response", best[h or ""] if again else None))
    assert {(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got} == want
    parts = [warc.member(warc.page_record(i, "u", b"p%d" % i * 50, None, False)) for i in range(6)]
    broken = b"".join(parts[:2]) + parts[2][:40] + parts[3] + bytes([parts[4][0]]) + b"junk" + parts[5]
    found = list(warc.salvage(broken))
    ids = [x.headers["warc-record-id"] for x in found if isinstance(x, warc.Record)]
    gaps = [(x.offset, x.end) for x in found if isinstance(x, warc.Gap)]
    a = len(parts[0]) + len(parts[1])
    assert ids == [f"<urn:page:{i}>" for i in (0, 1, 3, 5)]
    assert gaps == [(a, a + 40), (a + 40 + len(parts[3]), a + 45 + len(parts[3]))]
    plain = [warc.page_record(i, "u", b"q", None, False) for i in range(3)]
    found = list(warc.salvage(plain[0] + plain[1].replace(b"\r\n\r\nq", b"\r\n\r\nz") + plain[2]))
    assert [isinstance(x, warc.Gap) for x in found] == [False, True, False]
    assert list(warc.salvage(b"")) == []


def warc_pages(spark):
    rng = np.random.default_rng(9)
    rows = [(i, f"http://x/{i}", "".join(rng.choice(list("abcdefghijkl\u00e9"), 40 + i))) for i in range(30)]
    rows += [(100 + i, None, "same") for i in range(20)] + [(200 + i, "u", None) for i in range(40)]
    rows += [(300, "u", "".join(rng.choice(list("abcdefghijklmnop"), 300_000))), (301, "u", rows[3][2]),
             (302, "u", rows[4][2]), (None, "u", "same"), (None, "u", "only here"), (302, "u", rows[4][2])]
    clash = ("sha", "payload", "response", "key", "first", "n")
    return rows, spark.createDataFrame([(*r, *clash) for r in rows], "page_id long, url string, html string, "
                                       + ", ".join(f"{c} string" for c in clash)).repartition(3)


@pytest.mark.parametrize("options", [{}, {"file_bytes": 2000}, {"broadcast_rows": 3, "file_bytes": 1}])
def test_warc_no_page_is_dropped(spark, options):
    """Nulls, repeated rows, clashing names, a payload far over the file size, and shared payloads beyond a broadcast."""
    rows, pages = warc_pages(spark)
    got = warc.round_trip(spark, pages, **options).collect()
    best = {}
    for i, _, h in rows:
        if i is not None:
            best[h or ""] = max(i, best.get(h or "", i))
    want = Counter()
    for i, _, h in rows:
        data, shared = (h or "").encode(), sum((x or "") == (h or "") for _, _, x in rows) > 1
        first = best.get(h or "") if shared else None
        again = first is not None and first != i
        want[(i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
              "revisit" if again else "response", first if again else None)] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == want
    files = {r.file for r in got}
    assert len(files) == len(rows) if options.get("file_bytes") == 1 else len(files) >= (4 if options else 1)


def test_warc_counts_its_records(spark, tmp_path):
    rows, pages = warc_pages(spark)
    warc.write_archives(pages, str(tmp_path / "a"))
    assert warc._whole(warc.read_archives(spark, str(tmp_path / "a")), len(rows)).count() == len(rows)
    with pytest.raises(RuntimeError, match="records expected"):
        warc._whole(warc.read_archives(spark, str(tmp_path / "a")), len(rows) + 1)
    with pytest.raises(RuntimeError, match="gaps"):
        warc._whole(warc.read_archives(spark, str(tmp_path / "a"), limit=1000), len(rows))
    (tmp_path / "none").mkdir()
    assert warc.read_archives(spark, str(tmp_path / "none")).count() == 0


def test_warc_salvage_inside_a_member():
    rng = np.random.default_rng(8)
    records = [warc.page_record(i, "u", rng.bytes(3000), None, False) for i in range(20)]
    one, after = warc.member(b"".join(records)), warc.member(warc.page_record(99, "u", b"x", None, False))
    checksum = one[:-8] + bytes([one[-8] ^ 1]) + one[-7:]
    for broken, least in ((checksum, 20), (one[:len(one) * 3 // 4], 13), (one, 20)):
        found = list(warc.salvage(broken + after))
        ids = [x.headers["warc-record-id"] for x in found if isinstance(x, warc.Record)]
        assert len(ids) > least and ids == [f"<urn:page:{i}>" for i in (*range(len(ids) - 1), 99)]
        assert sum(isinstance(x, warc.Gap) for x in found) == (broken != one)
    limited = list(warc.salvage(one + after, 30000))
    assert sum(isinstance(x, warc.Record) for x in limited) > 5 and isinstance(limited[-2], warc.Gap)


def test_quality_rules(spark, docs):
    got = {(r.doc_id, r.n_words): r for r in quality_rules.judge(docs).collect()}
    for i, t in ROWS:
        w = [x.decode() for x in (t or "").encode().split()]
        seen = Counter(zip(w, w[1:], w[2:], strict=False))
        cover = {j for k in range(len(w) - 2) if seen[tuple(w[k:k + 3])] > 1 for j in (k, k + 1, k + 2)}
        full = [x for x in (t or "").split("\n") if x.split()]
        r = got[(i, len(w))]
        assert (r.word_chars, r.n_dup_lines, r.n_repeat_words) == (sum(map(len, w)), len(full) - len(set(full)), len(cover))
        assert r.base_failed == (len(w) < 50 or 100 * len(cover) > 50 * len(w))
        assert not (r.kept and r.base_failed)
    assert quality_rules.keep_good(docs).columns == docs.columns


def plain_em(votes):
    """Posterior of each vote list by a plain expectation-maximisation from the module's prior."""
    n = len(votes[0])
    start = [[list(quality_rules.PRIOR[c]) for _ in range(n)] for c in ("good", "bad")]
    docs_, tables = list(quality_rules.PRIOR_DOCUMENTS), start
    for _ in range(quality_rules.ROUNDS + 1):
        post = []
        for v in votes:
            like = [docs_[c] * math.prod(tables[c][k][x + 1] / sum(tables[c][k]) for k, x in enumerate(v)) for c in (0, 1)]
            post.append(like[0] / sum(like))
        docs_ = [quality_rules.PRIOR_DOCUMENTS[0] + sum(post), quality_rules.PRIOR_DOCUMENTS[1] + len(post) - sum(post)]
        tables = [[list(row) for row in t] for t in ([[list(quality_rules.PRIOR[c]) for _ in range(n)]
                                                       for c in ("good", "bad")])]
        for v, p in zip(votes, post, strict=True):
            for k, x in enumerate(v):
                tables[0][k][x + 1] += p
                tables[1][k][x + 1] += 1 - p
    return post


def planted_votes(n=3000, accuracy=(0.95, 0.9, 0.9, 0.85, 0.8, 0.6), good=0.75, seed=11):
    rng = np.random.default_rng(seed)
    truth = rng.random(n) < good
    out = []
    for t in truth:
        right = rng.random(len(accuracy)) < accuracy
        silent = rng.random(len(accuracy)) < 0.1
        out.append([0 if s else (1 if t == r else -1) for r, s in zip(right, silent, strict=True)])
    return truth, out


def test_vote_model_recovers_planted_accuracies(spark):
    accuracy = (0.95, 0.9, 0.9, 0.85, 0.8, 0.6)
    truth, votes = planted_votes(accuracy=accuracy)
    table = spark.createDataFrame([(k, v) for k, v in enumerate(votes)], "k int, votes array<int>")
    model = quality_rules.fit_votes(table, len(accuracy))
    for k, a in enumerate(accuracy):
        for row, side in ((model.good[k], 2), (model.bad[k], 0)):
            assert abs(row[side] / (row[0] + row[2]) - a) < 0.06
    assert abs(model.share - 0.75) < 0.03
    got = {r.k: r.p for r in table.select("k", model.posterior(F.col("votes")).alias("p")).collect()}
    want = plain_em(votes)
    assert max(abs(got[k] - p) for k, p in enumerate(want)) < 1e-4
    assert np.mean([(p >= 0.5) == t for p, t in zip(want, truth, strict=True)]) > 0.95
    weak = [k for k, v in enumerate(votes) if v == [1, 1, 1, 1, 1, -1]]     # only the weakest rule objects
    assert weak and all(got[k] > 0.9 for k in weak)


def test_vote_model_of_nothing_and_of_one_pattern(spark):
    none = spark.createDataFrame([], "votes array<int>")
    model = quality_rules.fit_votes(none, 3)
    assert model.share == 0.8 and model.good[0] == [0.025, 0.1, 0.875]
    same = spark.createDataFrame([([1, 1, 1],)] * 50, "votes array<int>")
    model = quality_rules.fit_votes(same, 3)
    assert same.select(model.posterior(F.col("votes")).alias("p")).first().p > 0.9


def test_quality_rules_overrule_one_bad_vote(spark):
    """Junk on which rules agree goes; clean documents that one unreliable rule objects to stay."""
    def sentences(seed):
        return "\n".join(prose(1000 * seed + k, 12) + "." for k in range(8))

    clean = [(k, sentences(k)) for k in range(100)]
    unended = [(200 + k, sentences(k + 200).replace(".", ";")) for k in range(20)]       # only `sentences` objects
    junk = [(300 + k, " ".join(f"{w}###$$$" for w in sentences(k + 300).split())) for k in range(20)]
    rows = clean + unended + junk
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = quality_rules.judge(docs).collect()
    assert {r.doc_id for r in got if r.kept} == {k for k, _ in clean + unended}
    want = plain_em([r.votes for r in got])
    assert max(abs(r.p_good - p) for r, p in zip(got, want, strict=True)) < 1e-4
    assert all(list(r.votes).count(-1) == 1 for r in got if 200 <= r.doc_id < 300)


def test_class_lm(spark, docs):
    got = class_lm.log_probabilities(docs, F.col("doc_id") <= 3).collect()
    train = [words(t) + [0] for i, t in ROWS if i is not None and i <= 3]
    c = Counter(x for t in train for x in t)
    n, v = sum(c.values()), len(c)
    want = sorted((-1 if i is None else i, len(words(t)) + 1, sum(x in c for x in words(t) + [0]),
                   round(sum(math.log10((c.get(x, 0) + 1) / (n + v + 1)) for x in words(t) + [0]), 6)) for i, t in ROWS)
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got) == want
    assert {r.train_tokens for r in got} == {n} and all(r.score <= 0 for r in got)
    empty = class_lm.log_probabilities(docs.where("doc_id = 6"), F.lit(False)).first()
    assert (empty.n_tokens, empty.n_known, empty.score) == (1, 0, 0.0)


def test_class_lm_counts_words_exactly(spark):
    # "middling" comes after thousands of more frequent words in every chunk, and is the most frequent over all
    rows = [(i, " ".join(f"w{i}x{k} " * 3 for k in range(4200)) + "middling middling") for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4, "doc_id")
    chunks = class_lm.tokenise(docs, "doc_id", "text", F.lit(True))
    word = chunks.sparkSession.createDataFrame([(9, "middling")], "doc_id long, text string")
    key = class_lm.read_chunk(class_lm.tokenise(word, "doc_id", "text").first().asDict()).words.view(np.int64)[0].item()
    assert class_lm._proposals(chunks).where(F.col("word") == key).first().n == 8


def test_class_lm_rounds_use_all_neighbours(spark, monkeypatch):
    """Words that never stand beside a seed word get their class from each other."""
    rng = np.random.default_rng(5)
    texts = [" ".join(f"the a{rng.integers(5)} z{rng.integers(5)}" for _ in range(6)) for _ in range(150)]
    texts += [" ".join(f"c{rng.integers(40)} d{rng.integers(40)}" for _ in range(12)) for _ in range(150)]
    texts += [f"the c{rng.integers(40)} d{rng.integers(40)}" for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3, "doc_id")

    def score():
        got = class_lm.log_probabilities(docs, F.lit(True), classes=6, seed_words=11).agg(F.sum("score"), F.sum("n_tokens")).first()
        return got[0] / got[1]

    whole = score()
    monkeypatch.setattr(class_lm, "ROUNDS", 0)
    assert whole > score() + 0.1


def test_class_lm_moves_words_by_likelihood():
    """A word moves to the class that brute force finds best, its own counts and repeats of itself included."""
    rng = np.random.default_rng(6)
    k, c = 12, 4                                         # words (the last is the text end), classes with the end's
    bigrams = rng.integers(0, 60, (k, k)) * rng.integers(0, 2, (k, k))
    place = np.append(rng.integers(0, c - 1, k - 1), c - 1)
    member = np.eye(c)[place]
    seen = np.concatenate([bigrams.T @ member, bigrams @ member, np.diagonal(bigrams)[:, None]], 1)[:-1].astype(float)
    assert (seen[:, :c].sum(1) >= class_lm.EXACT_FROM).all()
    got = class_lm._moved(seen, place[:-1], member.T @ bigrams @ member, c - 1)
    for w in range(k - 1):
        value = []
        for to in range(c - 1):
            m = np.eye(c)[np.where(np.arange(k) == w, to, place)]
            value.append(class_lm._likelihood(m.T @ bigrams @ m))
        assert got[w] == np.argmax(value) and len(set(value)) > 1
    of = class_lm.exchange(bigrams, c - 1)               # settles where no single move is better
    m = np.eye(c)[of]
    best = class_lm._likelihood(m.T @ bigrams @ m)
    for w in range(k - 1):
        for to in range(c - 1):
            m = np.eye(c)[np.where(np.arange(k) == w, to, of)]
            assert class_lm._likelihood(m.T @ bigrams @ m) <= best + 1e-6


def test_containment_and_licenses(spark, docs):
    items = spark.createDataFrame([(1, PASSAGE), (2, "one two"), (3, None), (4, PASSAGE), (5, prose(99, 30))],
                                  "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, items).collect()}
    assert got == {(d, i) for d in (2, 3, 4) for i in (1, 4)} | {(8, 2)}
    assert decontaminate.drop_contaminated(docs, items).count() == len(ROWS) - 5
    assert {(r.doc_id, r.license) for r in licenses.scan(docs).collect()} == {(2, "MIT"), (4, "MIT")}


def test_licenses_whole_texts_and_clauses(spark):
    start = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided "
             "that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
             "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must "
             "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
             "documentation and/or other materials provided with the distribution. ")
    third = ("3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
             "promote products derived from this software without specific prior written permission. ")
    end = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\""
    texts = {1: start + end, 2: start + third + end, 3: "It is under the MIT license, see below",
             4: "Code released under the MIT license, see the file", 5: prose(41, 300) + " " + licenses.TEMPLATES["LGPL-3.0-text"],
             6: licenses.TEMPLATES["GPL-2.0-text"] + prose(42, 90), 7: licenses.TEMPLATES["ISC"]}
    found = licenses.scan(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    got = {}
    for r in found:
        got.setdefault(r.doc_id, set()).add(r.license.split("-notice")[0])
    assert got[1] == {"BSD-2-Clause"} and got[2] == {"BSD-3-Clause"} and got[4] == {"MIT"} and got[7] == {"ISC"}
    assert got[5] == {"LGPL-3.0-text"} and "GPL-2.0-text" in got[6] and "GPL-3.0-text" not in got[6]


def test_mixing(spark, docs):
    got = mixing.mix(docs).collect()
    assert len(got) == len(ROWS) and all(0 <= r.probability <= 1 for r in got)
    assert {r.topic for r in got} == {"prose"}
    assert spark.sql("select 'Licensed | x' as t").select(mixing.topic_of(F.col("t"))).first()[0] == "legal"
    assert mixing.keep_sample(docs).count() == sum(r.kept for r in got)


def test_passages(spark, docs):
    got = {r.doc_id: r for r in passages.repeated_passages(docs).collect()}
    assert set(got) == {3, 4}
    assert (got[3].start_word, got[3].end_word, got[3].from_ids) == (40, 110, [2])
    assert (got[4].start_word, got[4].n_words, got[4].from_ids) == (0, len(ROWS[3][1].split()), [2])
    best = passages.chains(np.array([0, 10, 20, 30]), np.array([100, 5, 15, 25]))
    assert [list(c) for c in best] == [[1, 2, 3], [0]]


def _brute_windows(texts, ids, only):
    """Words of each document in a window of 20 words of which 16 are equal, place by place, in an earlier one."""
    codes = {}
    cut = [np.array([codes.setdefault(w, len(codes)) for w in words(t)]) for t in texts]
    found = {}
    for d, i in enumerate(ids):
        if i not in only:
            continue
        held = np.zeros(len(cut[d]), bool)
        for s, j in enumerate(ids):
            if j >= i:
                continue
            for shift in range(20 - len(cut[d]), len(cut[s]) - 19):
                lo, hi = max(0, -shift), min(len(cut[d]), len(cut[s]) - shift)
                same = cut[d][lo:hi] == cut[s][lo + shift:hi + shift]
                total = np.concatenate([[0], np.cumsum(same)])
                for at in np.flatnonzero(total[20:] - total[:-20] >= 16):
                    equal = lo + at + np.flatnonzero(same[at:at + 20])
                    held[equal[0]:equal[-1] + 1] = True
        found[i] = held
    return found


def _passages_hold(spark, rows, only):
    """The words that brute force finds in runs of 50 or more lie in the passages."""
    got = {}
    for r in passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        got.setdefault(r.doc_id, []).append((r.start_word, r.end_word))
    missed = []
    for i, held in _brute_windows([t for _, t in rows], [i for i, _ in rows], only).items():
        edge = np.flatnonzero(np.diff(np.concatenate([[0], held, [0]])))
        for lo, hi in zip(edge[::2], edge[1::2], strict=True):
            if hi - lo >= 50 and not any(a <= lo and hi <= b for a, b in got.get(i, [])):
                missed.append((i, int(lo), int(hi), got.get(i)))
    assert not missed
    return got


def test_passages_every_copy_in_a_document(spark):
    rows = [(1, prose(20, 30) + " " + PASSAGE), (2, prose(21, 20) + " " + PASSAGE + " " + prose(22, 40) + " " + PASSAGE)]
    got = _passages_hold(spark, rows, {1, 2})
    assert sorted(got[2]) == [(20, 90), (130, 200)]


def _changed(text, every, seed):
    """The text with every ``every``-th word replaced."""
    w = text.split()
    for k, at in enumerate(range(every // 2, len(w), every)):
        w[at] = f"changed{seed}x{k}"
    return " ".join(w)


def test_passages_holders_beyond_the_first(spark):
    # documents 1 to 90 hold runs of 6 words of the passage that 91 and 92 share
    passage = prose(30, 80).split()
    odd = " ".join(w if k % 7 else f"odd{k}" for k, w in enumerate(passage))
    rows = [(i + 1, " ".join(prose(3000 + 20 * i + k, 5) + " " + " ".join(passage[7 * k + 1:7 * k + 7])
                             for k in range(11))) for i in range(90)]
    rows += [(91, prose(31, 30) + " " + odd), (92, prose(32, 25) + " " + " ".join(passage))]
    assert [r for i, x in _passages_hold(spark, rows, {91, 92}).items() for r in x if i == 92]


def test_passages_fuzzy(spark):
    rows = [(k, prose(100 + k, 40) + " " + prose(200 + k, 60) + " " + prose(300 + k, 40)) for k in range(6)]
    rows += [(1000 + 100 * every + k, prose(5000 + 100 * every + k, 30) + " " + _changed(prose(200 + k, 60), every, k) + " "
              + prose(9000 + 100 * every + k, 30)) for every in (5, 6, 7, 8, 10) for k in range(6)]
    got = _passages_hold(spark, rows, {i for i, _ in rows if i >= 1000})
    assert set(got) == {i for i, _ in rows if i >= 1000}


def _mutated(words, vocab, rng, sub, indel):
    out = []
    for w in words:
        r = rng.random()
        if r < sub:
            out.append(str(rng.choice(vocab)))
        elif r >= sub + indel:
            out.append(w)
        elif r >= sub + indel / 2:      # a word put in; else this one is left out
            out += [w, str(rng.choice(vocab))]
    return out


def test_passages_with_words_left_out_and_put_in(spark):
    rng = np.random.default_rng(1)
    vocab = np.array(["".join(rng.choice(list("abcdefghijklmnop"), 5)) for _ in range(5000)])
    prose_of = lambda n: rng.choice(vocab, n).tolist()
    rates = [(0.1, 0.0), (0.0, 0.1), (0.0, 0.15), (0.05, 0.05), (0.1, 0.02)]
    rows, planted = [], {}
    for case, (sub, indel) in enumerate(rates):
        for k in range(20):
            passage, i = prose_of(100), 1000 * case + k
            rows.append((i, " ".join(prose_of(40) + passage + prose_of(40))))
            changed = _mutated(passage, vocab, rng, sub, indel)
            rows.append((10_000 + i, " ".join(prose_of(40) + changed + prose_of(40))))
            planted[10_000 + i] = case, 40, 40 + len(changed), i
    rows += [(50_000 + k, " ".join(prose_of(300))) for k in range(50)]
    found, covered = [0] * len(rates), [0.0] * len(rates)
    for r in passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        case, low, high, source = planted[r.doc_id]                     # nothing else is reported
        assert r.from_ids == [source] and low - 6 <= r.start_word and r.end_word <= high + 6
        found[case] += 1
        covered[case] += (min(r.end_word, high) - max(r.start_word, low)) / (high - low) / 20
    assert min(found) >= 18 and min(covered) >= 0.9, (found, covered)


def test_passages_below_the_identity_are_not_reported(spark):
    rng = np.random.default_rng(2)
    vocab = np.array(["".join(rng.choice(list("abcdefghijklmnop"), 5)) for _ in range(5000)])
    rows = []
    for k in range(20):
        passage = rng.choice(vocab, 100).tolist()
        rows += [(k, " ".join(passage)), (100 + k, " ".join(_mutated(passage, vocab, rng, 0.4, 0.0)))]
    assert passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).count() == 0


def test_passages_of_equal_texts_come_from_the_first(spark):
    text = prose(77, 60)
    rows = [(3, text), (1, text), (1, text), (2, text + " "), (None, text), (4, prose(78, 20)), (5, prose(78, 20)),
            (6, prose(79, 40) + " " + text)]
    got = {r.doc_id: (r.start_word, r.end_word, r.from_ids) for r in
           passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {2: (0, 60, [1]), 3: (0, 60, [1]), 6: (40, 100, [1, 2])}


def test_passages_first_holder_of_many():
    rng = np.random.default_rng(5)
    around = rng.integers(1, 40, (400, 2 * passages.SIDE)).astype(np.uint16)
    around[:, :6] = 7                                    # a line that all have
    for at in range(100, 400, 3):                        # near copies of an earlier one
        around[at] = around[rng.integers(0, at)]
        around[at, rng.integers(0, 2 * passages.SIDE, 3)] = 0
    same = np.stack([passages.alike(np.repeat(around[i:i + 1], 400, 0), around) for i in range(400)])
    want = [min([j for j in range(i) if same[i, j]], default=i) for i in range(400)]
    key = np.ones(400, np.uint64)
    assert np.array_equal(passages.first_holders(key, around), want)
    assert np.array_equal(passages._first_alike(around, np.ones(400, bool)), want)


def test_ranking(spark, docs):
    labels = spark.createDataFrame([(1, 1), (2, 1), (3, 1), (4, 1), (8, 0), (9, 0), (6, 0), (None, 1), (7, None)],
                                   "doc_id long, quality int")
    got = ranking.quality_scores(docs, labels, F.lit(True)).collect()
    assert len(got) == len(ROWS)
    assert {r.doc_id for r in got if r.predicted == 1} >= {1, 2, 3, 4}
    assert not {r.doc_id for r in got if r.predicted == 1} & {6, 8, 9}


def test_ranking_fits_all_pairs(spark):
    """Weights are the optimum over every pair, and no strength that occurs parts the labels better."""
    rng = np.random.default_rng(11)
    label = np.repeat([1, 0], [90, 60])
    x = rng.normal(0, 1, (150, len(ranking.FEATURES))) + 0.6 * label[:, None] * rng.random(len(ranking.FEATURES))
    x[:, 5] = 3.0                                        # a measure that does not vary
    x[:, 4] = rng.random(150) < 0.02                     # one that is rare
    x[120:130] = x[100]                                  # repeated rows count as often as they come
    known = spark.createDataFrame([(int(v), [float(f) for f in r]) for v, r in zip(label, x, strict=True)],
                                  "label int, features array<double>").repartition(3)
    got = ranking.fit(known)
    z = (x - x.mean(0)) / np.where(x.std(0) > 1e-9, x.std(0), 1.0)
    diff = (z[label == 1][:, None] - z[label == 0][None]).reshape(-1, z.shape[1])
    slope = ranking.RIDGE * got.weights - (diff / (1 + np.exp(diff @ got.weights))[:, None]).mean(0)
    assert np.abs(got.weights).max() > 0.1 and np.abs(slope).max() < 1e-7
    s = z @ got.weights
    assert ((s >= got.threshold) == label).sum() == max(((s >= q) == label).sum() for q in s)


def test_ranking_learns_from_every_label(spark):
    """One good document after 12,000 of them still moves the weights."""
    far = [0.0] * len(ranking.FEATURES)
    rows = spark.range(12_001).select(F.lit(1).alias("label"), F.array(
        (F.col("id") % 7).cast("double"), F.when(F.col("id") == 12_000, 5.0).otherwise(0.0),
        *(F.lit(0.0) for _ in far[2:])).alias("features"))
    rows = rows.unionByName(spark.range(50).select(F.lit(0).alias("label"), F.array(
        (F.col("id") % 5).cast("double"), *(F.lit(0.0) for _ in far[1:])).alias("features")))
    got = ranking.fit(rows)
    assert got.mean[1] == pytest.approx(5 / 12_051) and got.weights[1] > 1e-4


@pytest.mark.parametrize("run", [
    line_dedup.match_lines, simhash.keep_one, quality_rules.judge, licenses.scan, mixing.mix, passages.repeated_passages,
    lambda d: class_lm.log_probabilities(d, F.lit(True))])
def test_empty_tables(docs, run):
    assert run(docs.limit(0)).count() == 0


def test_crc_matches_python(spark):
    r = spark.sql("select crc32(cast(cast(123 as string) as binary)) as c").first()
    assert r.c == zlib.crc32(b"123")
