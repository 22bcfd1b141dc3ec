import itertools
import random

import numpy as np
import pytest

from creelgrid.llm import near_dedup
from creelgrid.llm.base import words_of
from creelgrid.llm.components import components


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        above = 0
        for j, y in enumerate(b):
            above, row[j + 1] = row[j + 1], above + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def similar(a, b):
    """The definition, without sketches, bands or early ends."""
    a, b = (near_dedup.kmers(words_of(x)).tolist() for x in (a, b))
    if not a or not b:
        return False
    n = lcs(a, b)
    return 5 * n >= 4 * (len(a) + len(b) - n)


def classes(rows):
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in itertools.combinations(range(len(rows)), 2):
        if similar(rows[i][1] or "", rows[j][1] or ""):
            parent[max(find(i), find(j))] = min(find(i), find(j))
    return {rows[i][0]: rows[find(i)][0] for i in range(len(rows))}


def meet(x, y):
    """Whether two texts share a bucket that counts."""
    (own_x, others_x), (own_y, others_y) = (map(set, near_dedup.buckets(r)) for r in (x, y))
    return bool(own_x & own_y or own_x & others_y or others_x & own_y)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(11)
    word = lambda: rng.choice("abcdefgh") + rng.choice("lmnop") + str(rng.randint(0, 40))
    rows, shared = [], [word() for _ in range(60)]
    for _ in range(25):
        text = [word() for _ in range(rng.choice([3, 6, 30, 120]))]
        if rng.random() < 0.5:
            text[1:1] = shared  # a passage that many texts have
        for _ in range(rng.randint(1, 6)):  # copies of copies, with more and more changes
            rows.append(" ".join(text))
            for _ in range(rng.randint(0, 3)):
                text[rng.randrange(len(text))] = word()
            if rng.random() < 0.3:
                text.insert(rng.randrange(len(text)), word())
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_classes_against_brute_force(make_docs, corpus):
    got = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(make_docs(corpus, class_id="clash", digest="clash")).collect()}
    assert got == classes(corpus)


def test_alignment_is_exact():
    rng = random.Random(3)
    for _ in range(200):
        a = [rng.choice("abcdef") for _ in range(rng.randint(1, 40))]
        b = list(a)
        for _ in range(rng.randint(0, 3)):
            b[rng.randrange(len(b))] = rng.choice("abcdef")
        if rng.random() < 0.3:
            k = rng.randrange(len(b))
            b = b[k:] + b[:k]
        x, y = (near_dedup.kmers([w.encode() for w in t]) for t in (a, b))
        n = lcs(x.tolist(), y.tolist())
        good = 5 * n >= 4 * (len(x) + len(y) - n)
        assert (near_dedup.aligned(x, y) > 0) == good and near_dedup.aligned(x, y) <= n
        distance = len(x) + len(y) - 2 * n
        assert near_dedup.gaps(x, y, distance) == distance and near_dedup.gaps(x, y, distance + 9) == distance
        if distance:
            assert near_dedup.gaps(x, y, distance - 1) == distance


def test_change_in_a_text_of_repeated_lines():
    line = [b"tree", b"house", b"cat", b"mat", b"number", b"looked", b"warm"]
    a = [w for k in range(40) for w in (*line, str(k).encode())]
    b = [*a[:20], b"other", *a[21:]]
    assert near_dedup.aligned(near_dedup.kmers(a), near_dedup.kmers(b))


def test_sketches_find_pairs_at_the_threshold():
    rng = random.Random(5)
    missed = 0
    for _ in range(300):
        a = [str(rng.random()).encode() for _ in range(184)]
        b = list(a)
        for k in range(20, 180, 45):  # four changes of 184 words: 180 runs, 160 shared of 200
            b[k] = str(rng.random()).encode()
        x, y = near_dedup.kmers(a), near_dedup.kmers(b)
        assert near_dedup.aligned(x, y) == 160
        missed += not meet(x, y)
    assert missed == 0


def test_pairs_of_few_runs_share_a_bucket():
    rng = random.Random(8)
    for _ in range(3000):
        a = [str(rng.random()).encode() for _ in range(rng.randint(4, 28))]
        b = [str(rng.random()).encode() for _ in range(rng.randint(0, 5))]
        b = b + a if rng.random() < 0.5 else a + b  # 8 and 9 words: 4 and 5 runs, similarity 0.8
        x, y = near_dedup.kmers(a), near_dedup.kmers(b)
        if min(len(x), len(y)) < near_dedup.FEW and near_dedup.aligned(x, y):
            assert meet(x, y)


def test_pairs_with_a_repeated_passage_share_a_bucket():
    rng = random.Random(9)
    missed = 0
    for _ in range(600):
        p, x = ([str(rng.random()).encode() for _ in range(n)] for n in (50, 160))
        a, b = near_dedup.kmers(p + x + p), near_dedup.kmers(x + p)
        assert near_dedup.aligned(a, b)
        missed += not meet(a, b)
    assert missed == 0


def test_classes_of_few_runs(make_docs):
    rows = []
    for k in range(600):
        words = [f"w{k}x{j}" for j in range(9)]
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(words[:8]))]
    got = near_dedup.near_duplicates(make_docs(rows)).collect()
    assert all(r.class_id == r.doc_id // 2 * 2 for r in got)


def test_order_matters_to_sketches():
    words = [str(k).encode() for k in range(200)]
    x, sets = near_dedup.buckets(near_dedup.kmers(words))
    moved, others = near_dedup.buckets(near_dedup.kmers(words[100:] + words[:100]))
    assert len(set(x) & set(moved)) < near_dedup.SKETCHES / 3
    assert len(set(sets) & set(others)) > near_dedup.SKETCHES / 2 and not set(x) & set(others) and not set(moved) & set(sets)


def test_repeated_passages_and_changes_share_a_bucket():
    rng = random.Random(12)
    missed = pairs = 0
    while pairs < 400:
        parts = [[str(rng.random()).encode() for _ in range(rng.randint(10, 60))] for _ in range(4)]
        a = [w for _ in range(6) for w in rng.choice(parts)]
        b = list(a)
        for _ in range(rng.randint(0, 4)):
            b[rng.randrange(len(b))] = str(rng.random()).encode()
        x, y = near_dedup.kmers(a[rng.randint(0, 30) :]), near_dedup.kmers(b)
        if near_dedup.aligned(x, y):
            pairs += 1
            missed += not meet(x, y)
    assert missed == 0


def test_repeated_passages_in_the_query(make_docs):
    rng = random.Random(13)
    rows = []
    for k in range(40):
        p, x = ([f"{k}x{rng.random()}" for _ in range(n)] for n in (50, 160))
        rows += [(2 * k, " ".join(p + x + p)), (2 * k + 1, " ".join(x + p))]
    assert all(r.class_id == r.doc_id // 2 * 2 for r in near_dedup.near_duplicates(make_docs(rows)).collect())


def test_odd_rows(odd_docs):
    rows = near_dedup.near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    found = {r.doc_id: r for r in rows}
    assert found[6].class_id == 5 and found[5].class_size == 3 and not found[6].kept
    assert all(found[i].class_id == i and found[i].kept and found[i].class_size == 1 for i in (1, 2, 3, 4, 7, 8, 10, 11))
    assert [(r.class_id, r.kept) for r in rows if r.doc_id is None] == [(None, True)] * 2
    assert near_dedup.near_duplicates(odd_docs.limit(0)).count() == 0


def test_large_group_of_different_near_copies(make_docs):
    rng = random.Random(2)
    text = [f"w{k}" for k in range(150)]
    rows = []
    for i in range(300):
        own = list(text)
        own[rng.randrange(150)] = f"x{i}"
        rows.append((i, " ".join(own)))
    assert {r.class_id for r in near_dedup.near_duplicates(make_docs(rows)).collect()} == {0}


def test_components(spark):
    rng = random.Random(4)
    edges = [(k, k + 1) for k in range(0, 60)] + [(100, 101), (103, 101), (7, 7), (None, 3)]
    edges += [(200, rng.randrange(201, 260)) for _ in range(40)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[k] == 0 for k in range(61)) and got[103] == got[101] == got[100] == 100
    assert all(v == 200 for k, v in got.items() if k >= 200) and len(got) == len(set(got))
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_packed_runs():
    x = near_dedup.kmers([str(k).encode() for k in range(50)])
    data = x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()
    assert (near_dedup._unpack(data) == x).all()
