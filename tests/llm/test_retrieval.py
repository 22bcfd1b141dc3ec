import math
import random

import numpy as np
import pytest

from creelgrid.llm import hard_negatives, ranked_search
from creelgrid.llm.base import words_of


def brute_negatives(rows, positives=5, negatives=3):
    able = [(i, label, [math.floor(256 * x) for x in v]) for i, label, v in rows
            if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    product = lambda a, b: sum(x * y for x, y in zip(a, b))
    anchors = {}
    for i, label, v in sorted(able, key=lambda r: (r[0], str(r[1]), r[2])):
        if i % 50 == 0:
            anchors.setdefault(i, (label, v))
    result = []
    for a, (label, v) in anchors.items():
        near = sorted((-product(v, w), j) for j, k, w in able if k == label and j != a)[:positives]
        far = sorted((-product(v, w), j) for j, k, w in able if k != label)
        for p, j in sorted(set(near)):
            inside = [(s, k) for s, k in far if -50 * p <= -100 * s <= -95 * p]
            result += [(a, j, n + 1, k, -p, -s) for n, (s, k) in enumerate(inside[:negatives])]
    return sorted(result)


def vectors_of(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")


@pytest.mark.parametrize("block", [1 << 20, 400])
def test_negatives_against_brute_force(spark, block):
    r = np.random.default_rng(1)
    centres = r.normal(size=(6, 20))
    rows = [(i, int(i % 4), (centres[i % 6] + 0.7 * r.normal(size=20)).astype(np.float32).tolist()) for i in range(400)]
    rows += [(1000 + i, None, rows[0][2]) for i in range(2)] + [(1100, 1, None), (None, 1, rows[1][2]), (1150, 2, []), (1200, 0, [float("nan")] * 20),
             (1250, 0, [None] * 20), (1300, 0, rows[50][2]), (50, rows[50][1], rows[50][2]), (3, rows[3][1], rows[3][2]), (1350, 1, [1.0, 2.0]), (1400, 3, [0.0] * 20)]
    df = vectors_of(spark, rows).selectExpr("*", "'clash' as id", "'clash' as score", "'clash' as rank")
    found = sorted(tuple(x) for x in hard_negatives.mine(df, block_bytes=block).collect())
    assert found == brute_negatives(rows) and len(found) > 60


def test_negatives_of_ties_and_empty_tables(spark):
    rows = [(i, i % 2, [1.0, 0.5]) for i in range(120)]
    found = sorted(tuple(x) for x in hard_negatives.mine(vectors_of(spark, rows), high=100).collect())
    assert [x[3] for x in found if x[0] == 0 and x[1] == 2] == [1, 3, 5]
    assert hard_negatives.mine(vectors_of(spark, [])).count() == 0
    assert hard_negatives.mine(vectors_of(spark, [(50, 1, [1.0])])).count() == 0


def test_bounds_hold_and_exclude():
    r = np.random.default_rng(2)
    rows, anchors = (hard_negatives.Vectors(np.floor(256 * (r.normal(size=(n, 50)) + r.normal(size=(n, 1))))) for n in (300, 40))
    exact = rows.matrix @ anchors.matrix.T
    least, most = np.full(40, np.quantile(exact, 0.9)), np.full(40, np.quantile(exact, 0.97))
    x, y = hard_negatives.survivors(rows, anchors, np.ones((300, 40), bool), least, most)
    kept = set(zip(x.tolist(), y.tolist()))
    assert set(zip(*(c.tolist() for c in np.nonzero((exact >= least) & (exact <= most))))) <= kept
    assert len(kept) < 300 * 40 * 0.8
    assert (hard_negatives.scores(rows, anchors, x, y) == exact[x, y]).all()


def test_scores_beyond_doubles():
    big = hard_negatives.Vectors(np.array([[2.0**40, 3.0], [2.0**31 + 1, 5.0]]))
    got = hard_negatives.scores(big, big, np.array([1, 0]), np.array([1, 0]))
    assert got.tolist() == [(2**31 + 1) ** 2 + 25, 2**63 - 1]


def brute_ranking(docs, items, top):
    words = [(i, words_of(t)) for i, t in docs if words_of(t)]
    n, length = len(words), sum(len(w) for _, w in words)
    out = []
    for name, text in dict.fromkeys(items):
        scored = []
        for i, w in words:
            m, score = 50 + 50 * len(w) * n // length, 0
            for t in set(words_of(text)):
                df = sum(t in x for _, x in words)
                score += math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1))) * (10**9 * w.count(t) // (1000 * w.count(t) + 20 * m))
            if score > 0 and i is not None:
                scored.append((-score, i))
        out += [(name, k + 1, i, -s) for k, (s, i) in enumerate(sorted(scored)[:top])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [1 << 20, 50])
def test_ranking_against_brute_force(spark, make_docs, block):
    r = random.Random(7)
    vocabulary = [f"W{i}é" if i % 5 == 0 else f"w{i}" for i in range(300)]
    some = lambda n: " ".join(vocabulary[min(299, int(r.expovariate(0.03)))] for _ in range(n))
    docs = [(i, some(r.randint(0, 80))) for i in range(300)] + [(300 + i, "w1 w2 w3") for i in range(20)]
    docs += [(None, "w1 w2"), (1, "w7 w8"), (1, "w7 w8"), (900, None), (901, "... !"), (902, some(5000))]
    items = [(i, some(r.randint(1, 30)).upper()) for i in range(12)] + [(3, "w1"), (4, "w1 W2"), (4, "w1 W2"), (50, None), (51, "?"), (52, "unknown"), (None, "w5")]
    df = spark.createDataFrame(items, "item_id long, text string")
    found = ranked_search.rank(make_docs(docs, n="clash", terms="clash", query="clash"), df, top=15, block_bytes=block).collect()
    assert sorted((tuple(x) for x in found), key=repr) == brute_ranking(docs, items, 15)


def test_ranking_of_empty_tables(spark, make_docs):
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert ranked_search.rank(make_docs([]), items).count() == 0
    empty = ranked_search.rank(make_docs([(1, "a")]), items.limit(0))
    assert empty.count() == 0 and empty.columns == ["item_id", "rank", "doc_id", "score"]
    assert [tuple(x)[:3] for x in ranked_search.rank(make_docs([(1, "a")]), items).collect()] == [(1, 1, 1)]
