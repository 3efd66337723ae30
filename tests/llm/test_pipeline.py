"""The pipeline and its mixing against brute force, and the operators on empty second tables."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from indicatormart.llm import decontaminate, line_dedup, mixing, quality_rules, ranking, simhash, warc

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, p_good string"
SOURCES = {"hot": 1.0, "web": 1.0, "(none)": 2.0}


def prose(seed, n_lines=8):
    rng = np.random.default_rng(seed)
    return "\n".join(" ".join("".join(rng.choice(list("abcdefghijklmnop"), 6)) for _ in range(14)) + "."
                     for _ in range(n_lines))


def words(text):
    return (text or "").encode().lower().split()


def grams(text):
    w = words(text)
    return {tuple(w[k:k + 5]) for k in range(len(w) - 4)}


ITEM = " ".join(prose(901, 1).split())
GOOD = [(i, prose(i), "en" if i % 3 else "sv", "hot" if i % 3 == 0 else "web", "x") for i in range(1, 31)]
GOOD += [(31, prose(31) + "\n" + prose(1, 2), None, None, "x"),           # two lines of document 1
         (32, prose(2).upper(), "en", "hot", "x"),                        # a copy of document 2 but for case
         (33, prose(33) + "\n" + ITEM + "\n" + prose(34), "en", "web", "x"),
         (40, prose(40), "en", "web", "x"), (40, prose(40), "en", "web", "x")]
BAD = [(50, None, "en", "hot", "x"), (51, "", None, None, "x"), (52, "too short", "en", "web", "x"),
       (53, "und " * 300, "en", "hot", "x"), (None, " \n ", "en", "hot", "x")]


def solved(pairs, goal):
    """The step ``r`` at which ``sum(tokens * min(1, r * factor))`` is ``goal``, by bisection."""
    pairs = [(t, f) for t, f in pairs if t > 0 and f > 0]
    if not pairs:
        return 1.0
    low, high = 0.0, 1 / min(f for _, f in pairs)
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (low, mid) if sum(t * min(1, mid * f) for t, f in pairs) >= goal else (mid, high)
    return high


def raked(tokens, goals, start, sweeps=mixing.SWEEPS):
    """``{cell: factor}`` from ``{cell: tokens}``, in plain Python."""
    factor = dict.fromkeys(tokens, start)
    for _ in range(sweeps):
        for m, margin in enumerate(mixing.MARGINS):
            steps = {v: solved([(tokens[c], factor[c]) for c in tokens if c[m] == v], goals[margin].get(v, 0.0))
                     for v in {c[m] for c in tokens}}
            factor = {c: factor[c] * steps[c[m]] for c in tokens}
    return factor


def mixed(rows, wanted=None, budget=mixing.BUDGET):
    """``[(doc_id, cell, probability, kept)]`` of ``(doc_id, text, lang, source)`` rows, in plain Python."""
    tokens, cells = Counter(), []
    for _, text, lang, source in rows:
        topic = next((n for n, p in mixing.TOPICS if re.search(p, text or "")), mixing.OTHER)
        cells.append((source or "(none)", lang or "(none)", topic))
        tokens[cells[-1]] += len(words(text))
    goals = {}
    for m, margin in enumerate(mixing.MARGINS):
        totals = Counter()
        for c in tokens:
            totals[c[m]] += tokens[c]
        raw = {v: (wanted[margin].get(v, 0.0) if margin in (wanted or {}) else t ** mixing.POWERS[margin] if t else 0.0)
               for v, t in totals.items()}
        scale = solved([(t, raw[v] / t) for v, t in totals.items() if t], budget * sum(tokens.values()))
        goals[margin] = {v: t * min(1, scale * raw[v] / t) if t else 0.0 for v, t in totals.items()}
    factor = raked(tokens, goals, budget)
    out = []
    for (i, *_), c in zip(rows, cells, strict=True):
        p = min(1.0, factor[c])
        key = f"{'null' if i is None else i}:{mixing.SEED}"
        out.append((i, c, p, int(hashlib.md5(key.encode()).hexdigest()[:13], 16) / 2**52 < p))
    return out


@pytest.mark.parametrize("wanted", [None, {"source": SOURCES}])
def test_mixing_brute_force(spark, wanted):
    rows = [(i, t, lang, source) for i, t, lang, source, _ in GOOD + BAD]
    rows += [(60, "Licensed under x " * 9, "sv", "hot"), (61, "a | b " * 40, "en", "web")]
    docs = spark.createDataFrame([(*r, 0, "x") for r in rows], SCHEMA)
    want = mixed(rows, wanted)
    got = mixing.mix(docs, wanted).collect()
    assert Counter((r.doc_id, (r.source, r.lang, r.topic), round(r.probability, 6), r.kept) for r in got) == \
        Counter((i, c, round(p, 6), kept) for i, c, p, kept in want)


def test_mixing_meets_its_margins(spark):
    """A hot source with a third of the tokens, cells at the bound, a value short of tokens, and a report of the gap."""
    rng = np.random.default_rng(4)
    rows = []
    for k in range(600):
        text = " ".join(["w"] * int(rng.integers(20, 200))) + ("", " | x", " a@b")[int(rng.integers(0, 3))]
        source = "hot" if k % 3 == 0 else f"s{int(rng.integers(0, 8))}"
        rows.append((k, text, ("en", "sv", "fi")[min(2, int(rng.integers(0, 6)))], source, 0, "x"))
    docs = spark.createDataFrame(rows, SCHEMA)
    wanted = {"source": {"hot": 1.0, "s1": 5.0, "s2": 1.0, **{f"s{k}": 0.7 for k in range(3, 8)}}}
    for some in (None, wanted):
        found = mixing.mixture(docs, some)
        report = mixing.margins(found).collect()
        assert all(abs(r.expected - r.reachable) < 0.01 for r in report)
        assert {m: round(sum(r.reachable for r in report if r.margin == m), 9) for m in mixing.MARGINS} == \
            dict.fromkeys(mixing.MARGINS, 1.0)
    assert {r.value for r in report if r.margin == "source" and r.wanted - r.reachable > 0.01} == {"s1"}
    assert [r.expected for r in report if r.value == "s0"] == [0.0]
    assert found.cells.where("probability >= 1").count() > 0
    assert found.cells.where("probability > 1 or probability < 0 or probability is null").count() == 0
    # all of the budget and more: everything is kept
    assert mixing.mix(docs, budget=1.0).where("not kept").count() == 0


def brute_force(good, items):
    """The rows that stay, after the stage of quality rules, in plain Python."""
    at = [((i, k), frozenset(words(x))) for i, t, *_ in good for k, x in enumerate(t.split("\n")) if words(x)]
    first = {}
    for place, s in at:
        first[s] = min(place, first.get(s, place))
    stays = {place for place, s in at if first[s] >= place
             and all(first[o] >= place for o in first if len(s & o) >= 0.8 * len(s | o) - 1e-9)}
    rows = []
    for i, text, lang, source, extra in good:
        kept = "\n".join(x for k, x in enumerate(text.split("\n")) if not words(x) or (i, k) in stays)
        rows.append((i, kept, lang, source, len(kept), extra))
    rows = list(dict.fromkeys(rows))                              # full repeats are near duplicates of each other
    label = list(range(len(rows)))
    for _ in rows:
        for a, x in enumerate(rows):
            for b, y in enumerate(rows):
                if (simhash.fingerprint(x[1]) ^ simhash.fingerprint(y[1])).bit_count() <= 3:
                    label[a] = label[b] = min(label[a], label[b])
    rows = [min(r for r, x in zip(rows, label, strict=True) if x == c) for c in sorted(set(label))]
    rows = [r for r in rows if not any(len(grams(r[1]) & grams(q)) >= 0.8 * len(grams(q)) - 1e-9 for q in items)]
    draws = mixed([(i, t, lang, source) for i, t, lang, source, *_ in rows])
    return [r for r, d in zip(rows, draws, strict=True) if d[3]]


def save(spark, folder, good, bad, items):
    rows = [(i, t, lang, source, len(t or ""), x) for i, t, lang, source, x in good + bad]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def test_pipeline_brute_force(spark, tmp_path):
    sf = save(spark, tmp_path, GOOD, BAD, [(1, ITEM), (2, None), (3, prose(902, 1))])
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = quality_rules.keep_good(docs).collect()
    assert Counter(r.doc_id for r in kept) == Counter(r[0] for r in GOOD)
    got = corpus_pipeline.run(spark, sf)
    assert got.columns == docs.columns
    want = brute_force(GOOD, [ITEM, prose(902, 1)])
    assert 0 < len(want) < len(GOOD)
    assert Counter(map(tuple, got.collect())) == Counter(want)


def test_pipeline_empty(spark, tmp_path):
    assert corpus_pipeline.run(spark, save(spark, tmp_path, [], [], [])).count() == 0


def test_empty_second_tables(spark):
    docs = spark.createDataFrame([(i, t, lang, s, 0, x) for i, t, lang, s, x in GOOD[:3] + BAD], SCHEMA)
    none = docs.limit(0)
    items = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert decontaminate.contaminated(none, items).count() == 0
    assert decontaminate.contaminated(docs, items.limit(0)).count() == 0
    assert decontaminate.drop_contaminated(docs, items.limit(0)).count() == docs.count()
    learn = F.col("doc_id").isNotNull()
    assert {round(r.score, 9) for r in ranking.quality_scores(docs, labels, learn).collect()} == {ranking.CUT}
    assert ranking.quality_scores(none, labels, learn).count() == 0
    assert line_dedup.drop_repeated_lines(none).count() == 0
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.round_trip(spark, pages).count() == 0


def test_extra_columns_with_clashing_names(spark):
    """Names that the operators use themselves neither clash nor get lost in the pipeline's stages."""
    names = ("text_key", "k_id", "k_text", "k_lines", "n_words", "kept", "topic", "component_id", "word", "n", "won")
    docs = spark.createDataFrame([(i, t, lang, s, 0, *names) for i, t, lang, s, _ in GOOD[:4] + BAD],
                                 "doc_id long, text string, lang string, source string, n_chars long, "
                                 + ", ".join(f"{n} string" for n in names))
    items = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    for out in (quality_rules.keep_good(docs), line_dedup.drop_repeated_lines(docs), simhash.keep_one(docs),
                decontaminate.drop_contaminated(docs, items), mixing.keep_sample(docs)):
        assert out.columns == docs.columns
        assert all(tuple(r[5:]) == names for r in out.collect())
