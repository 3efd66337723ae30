"""Hard negatives, top-k search and periodic runs against brute force, and on odd rows."""

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from indicatormart.llm import _vectors, negatives, queries, runs, topk

VECTORS = "vec_id long, embedding array<float>, label int, key string, score double, piece string, rows long, leaf int"


# -- vectors -----------------------------------------------------------------------------------

def whole(vector):
    """The integers of a vector, or None if it takes no part."""
    if vector is None or any(x is None or not np.isfinite(x) for x in vector):
        return None
    return [int(np.floor(256.0 * float(np.float32(x)))) for x in vector]


def inner(a, b):
    return sum(x * y for x, y in zip(a, b, strict=False))


def rows_of(data):
    return [(i, whole(v), x) for i, v, x, *_ in data if i is not None and whole(v) is not None]


def top(pairs, k):
    return sorted(set(pairs), key=lambda p: (-p[1], p[0]))[:k]


def brute_top(data, every, k):
    rows = rows_of(data)
    out = set()
    for q in {i for i, _, _ in rows if i % every == 0}:
        found = top([(i, inner(v, w)) for j, w, _ in rows if j == q for i, v, _ in rows if i != q], k)
        out |= {(q, n + 1, i, s) for n, (i, s) in enumerate(found)}
    return out


def brute_negatives(data, every, k=5):
    rows = [r for r in rows_of(data) if r[2] is not None]
    out = []
    for a, w, label in {(i, tuple(v), x) for i, v, x in rows if i % every == 0}:
        good = top([(i, inner(v, w)) for i, v, x in rows if x == label and i != a], k)
        bad = [(i, inner(v, w)) for i, v, x in rows if x != label and i != a]
        for p, ps in good:
            fit = top([(i, s) for i, s in bad if 80 * ps <= 100 * s <= 100 * ps], k)
            out += [(a, p, n + 1, i, ps, s) for n, (i, s) in enumerate(fit)]
    return sorted(out)


def clusters(n, dim, seed, centres=12, copies=0.3):
    """Vectors around centres, a share of them one vector."""
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, dim))
    data = middle[rng.integers(0, centres, n)] + 0.15 * rng.normal(size=(n, dim))
    data[rng.random(n) < copies] = middle[0]
    data = (data / np.linalg.norm(data, axis=1, keepdims=True)).astype(np.float32)
    return [(i, data[i].tolist(), int(rng.integers(0, 4)), "k", 0.5, "p", 1, 2) for i in range(n)]


ODD = [
    (None, [0.1, 0.2], 1), (5, None, 1), (10, [0.1, None], 1), (15, [float("nan"), 0.0], 1), (20, [float("inf"), 0.0], 1),
    (25, [], 1), (30, [0.5, 0.5, 0.5], 1), (35, [0.5, 0.5], None), (40, [0.5, 0.5], 1), (40, [0.5, 0.5], 1),
    (45, [0.5, -0.5], 1), (45, [0.25, 0.5], 2), (46, [0.5, 0.5], 1), (47, [0.5, 0.5], 2), (48, [0.5, 0.4], 2),
    (49, [0.5, 0.4], 2), (50, [0.0, 0.0], 2), (51, [-0.5, -0.5], 1), (52, [0.45, 0.5], 1), (-5, [0.5, 0.44], 1),
]


def frame(spark, data, parts=3):
    return spark.createDataFrame([(*r, *((None,) * (8 - len(r)))) for r in data], VECTORS).repartition(parts)


@pytest.mark.parametrize("data", [ODD, clusters(700, 16, 1), clusters(300, 5, 2, centres=2, copies=0.6)])
def test_top_k(spark, data, monkeypatch):
    monkeypatch.setattr(topk, "SOME", 64)
    got = topk.top_k(frame(spark, data), F.col("vec_id") % 5 == 0, k=3)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == sorted(brute_top(data, 5, 3))


@pytest.mark.parametrize("data", [ODD, clusters(700, 16, 3), clusters(300, 5, 4, centres=2, copies=0.6)])
def test_hard_negatives(spark, data, monkeypatch):
    monkeypatch.setattr(negatives, "LEAF_ROWS", 20)
    monkeypatch.setattr(negatives, "SHARD_ROWS", 30)
    monkeypatch.setattr(negatives, "PIECE_ROWS", 40)
    got = negatives.hard_negatives(frame(spark, data), F.col("vec_id") % 5 == 0)
    assert sorted(map(tuple, got.collect())) == brute_negatives(data, 5)


def test_empty_vector_tables(spark):
    none = frame(spark, ODD).limit(0)
    assert topk.top_k(none, F.col("vec_id") % 5 == 0).count() == 0
    assert negatives.hard_negatives(none, F.col("vec_id") % 5 == 0).count() == 0
    only = frame(spark, ODD[:5])                        # no valid row
    assert topk.top_k(only, F.lit(True)).count() == 0
    assert negatives.hard_negatives(only, F.lit(True)).count() == 0


def test_products_are_exact():
    rng = np.random.default_rng(9)
    for scale in (300, 2.0**40, 1e200):
        a, b = np.floor(rng.normal(size=(4, 7)) * scale), np.floor(rng.normal(size=(5, 7)) * scale)
        want = [[inner(map(int, x), map(int, y)) for y in b] for x in a]
        assert _vectors.products(a, b).tolist() == [[min(max(x, -2**63), 2**63 - 1) for x in row] for row in want]


def test_segment_bounds_hold():
    rng = np.random.default_rng(10)
    for dim in (1, 3, 16, 64, 100):
        a, b = np.floor(256 * rng.normal(size=(30, dim))), np.floor(256 * rng.normal(size=(40, dim)))
        exact, last = a @ b.T, np.inf
        for n in topk.resolutions(dim):
            bound = topk.statistics(a, n, dim) @ topk.statistics(b, n, dim).T
            assert (bound >= exact - 1e-6).all()
            assert bound.mean() <= last
            last = bound.mean()


def test_tree_leaves_out_and_loses_nothing():
    data = np.array([v for _, v, *_ in clusters(4000, 16, 5, centres=40, copies=0.1)]) * 256 // 1
    tree = negatives.fit_tree(data[:2000], 200_000)
    leaf, seen = negatives.route(tree, data)
    length = np.linalg.norm(data, axis=1)
    ranges = negatives.Ranges(*[[np.full(s, v) for s in shape] for shape, v in (
        ([(len(p),) * 2 for p in tree.points], np.inf), ([(len(p),) * 2 for p in tree.points], -np.inf),
        ([len(p) for p in tree.points], np.inf), ([len(p) for p in tree.points], 0.0))])
    for node, (at, child, gap) in seen.items():
        for j in np.unique(child):
            some = child == j
            ranges.low[node][:, j], ranges.high[node][:, j] = gap[some].min(0), gap[some].max(0)
            ranges.shortest[node][j], ranges.longest[node][j] = length[at[some]].min(), length[at[some]].max()
    anchors = data[::40]
    score = anchors @ data.T
    least = np.sort(score, 1)[:, -6]
    for low, high in ((least, np.full(len(least), np.inf)), (0.8 * least, least)):
        pairs = {tuple(p) for p in negatives.meeting(tree, ranges, anchors, [(low, high)]).tolist()}
        need = {(i, int(leaf[j])) for i, j in zip(*np.nonzero((score >= low[:, None]) & (score <= high[:, None])), strict=True)}
        assert need <= pairs and len(pairs) < 0.7 * len(anchors) * tree.leaves


# -- runs --------------------------------------------------------------------------------------

def brute_runs(w, least=6, times=4):
    out = []
    for q in range(1, len(w)):
        i = 0
        while i + q < len(w):
            start = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            n = i - start + q
            if i > start and n >= max(least, times * q) and all(
                    any(w[x] != w[x + p] for x in range(start, start + n - p)) for p in range(1, q)):
                out.append((start, n, q))
            i += 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def random_words(rng, letters, n):
    w = [b"abc"[x:x + 1] for x in rng.integers(0, letters, n)]
    if n and rng.random() < 0.6:
        a = int(rng.integers(0, n))
        p = int(rng.integers(1, max(2, (n - a) // 3 + 1)))
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return w


def test_runs_against_brute_force():
    rng = np.random.default_rng(11)
    for _ in range(400):
        texts = [random_words(rng, int(rng.integers(1, 4)), int(rng.integers(0, 60))) for _ in range(3)]
        for rule in (runs.Rule(), runs.Rule(2, 2), runs.Rule(10, 3)):
            got = [[tuple(r) for r in found] for found in runs.find_runs(texts, rule)]
            assert got == [brute_runs(w, *rule) for w in texts]


def digest(doc_id, text):
    """The row of the contract, in plain Python."""
    w = (text or "").encode().split()
    n = len(w)
    if doc_id is not None:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = brute_runs(w)
    gone = {x for s, m, q in found for x in range(s + q, s + m)}
    first = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    return (doc_id, len(found), *(first or (None,) * 3), 1000 * first[1] // first[2] if first else None,
            hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in found).encode()).hexdigest(),
            hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in gone)).hexdigest())


def test_periodic_runs_query(spark, tmp_path):
    rng = np.random.default_rng(12)
    words = lambda n: " ".join("".join(rng.choice(list("abcdef"), 3)) for _ in range(n))
    data = [(i, words(int(rng.integers(0, 90)))) for i in range(120)]
    data += [(200, None), (201, ""), (202, " \n\t "), (203, "und " * 300), (None, "a b " * 9), (None, None),
             (204, "A a " * 5 + "a A " * 5), (205, "x y " * 8 + "\r\nå\x0bå\x0cå\tå å å å"), (206, words(2000) + " ö" * 400),
             (207, "a " * 6 + "b " * 6), (207, "a " * 6 + "b " * 6)]
    data += [(i, "x y z " * 40) for i in range(300, 340)]
    columns = "doc_id long, text string, runs string, id int, collapsed double, best string, start string"
    docs = spark.createDataFrame([(*r, "r", 1, 0.5, "b", "s") for r in data], columns)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in queries.op12_periodic_runs(spark, str(tmp_path)).collect()]
    assert sorted(got, key=repr) == sorted((digest(*r) for r in data), key=repr)
    assert sum(r[1] > 0 for r in got) > 20
    docs.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert queries.op12_periodic_runs(spark, f"{tmp_path}/none").count() == 0


def test_runs_in_a_very_long_text(spark):
    w = [b"%d" % (i % 977) for i in range(60_000)] + [b"%d" % i for i in range(5000)] + [b"u"] * 20_000
    [found] = runs.find_runs([w], runs.Rule())
    assert [tuple(r) for r in found] == [(0, 60_000, 977), (65_000, 20_000, 1)]
    assert len(runs.collapse(w, found)) == len(w) - (60_000 - 977) - 19_999
