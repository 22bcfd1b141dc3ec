import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from creelgrid.llm import language, pitman_yor, toxicity
from creelgrid.llm.base import fold, table, working

from .conftest import SF

SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def documents(spark):
    return table(spark, SF01, "documents").withColumn("held_out", fold(F.col("doc_id"), 3) == 1)


def test_folds(documents):
    for r in documents.select("doc_id", "held_out").limit(50).collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)


def test_language_of_held_out_rows(documents):
    slices = language.train(documents.filter("not held_out"))
    rows = language.predict(documents, slices, ["doc_id", "held_out", "lang"]).filter("held_out").collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.99
    assert all(0 <= r.score <= 1 and not (r.lang_pred == "und") for r in rows)


def test_bit_slices_hold_every_gram():
    rng = np.random.default_rng(1)
    for n in (3, 70):  # more languages than bits in a word
        slices = language.BitSlices([f"l{i:02}" for i in range(n)], 0)
        hashes = rng.integers(1, 1 << 62, 5000, np.uint64)
        held = rng.random((5000, n)) < 0.3
        masks = np.zeros((5000, slices.rows.shape[1]), np.uint64)
        for i in range(n):
            masks[:, i // 64] |= held[:, i].astype(np.uint64) << np.uint64(i % 64)
        slices.add(hashes, masks)
        slices.finish()
        for i in (0, n - 1):
            shares = slices.shares(hashes[held[:, i]], np.zeros(held[:, i].sum(), np.int32), 1)
            assert shares[0, i] == pytest.approx(1.0)
        other = slices.shares(rng.integers(1, 1 << 62, 5000, np.uint64), np.zeros(5000, np.int32), 1)
        assert (other < 0.02).all()  # false positives are taken off


def test_grams_one_by_one():
    texts = ["Ab  c!", "", None, "x", "1 2", "été\x00 ü"]
    hashes, owner, has = language.grams(texts)
    assert has.tolist() == [True, False, False, True, False, True]
    for i, t in enumerate(texts):
        alone, _, _ = language.grams([t])
        assert hashes[owner == i].tolist() == alone.tolist()
    assert (owner == 0).sum() == len("  ab c ") - 3 and (owner == 3).sum() == 1


def test_language_odd_rows(spark, odd_docs, make_docs):
    slices = language.train(make_docs([(i, f"the cat {i} sat") for i in range(9)] + [(20, None)], lang="en"))
    rows = language.predict(odd_docs, slices, ["doc_id"]).collect()
    assert len(rows) == odd_docs.count()
    assert {r.doc_id for r in rows if r.lang_pred == "und"} == {None, 1, 2, 3, 10, 11}
    none = language.train(make_docs([(1, "a text")]).withColumn("lang", F.lit(None).cast("string")))
    assert {(r.lang_pred, r.score) for r in language.predict(odd_docs, none, ["doc_id"]).collect()} == {("und", 0.0)}
    assert language.predict(odd_docs.limit(0), slices, ["doc_id"]).count() == 0


def test_toxic_terms_are_learnt(make_docs, spark, odd_docs):
    rng = random.Random(8)
    plain = [f"w{k}" for k in range(300)]
    rows, labels = [], []
    for i in range(900):
        words = rng.choices(plain, k=60)
        kind = i % 3
        if kind == 0:
            words[rng.randrange(60)] = rng.choice(["badword", "worseword"])
        rows.append((i, " ".join(words)))
        labels.append((i, int(kind == 0)))
    labels = spark.createDataFrame(labels + [(5, None), (None, 1)], "doc_id long, toxic int")
    train = make_docs(rows[:600], y="clash", terms="clash")
    machine = toxicity.train(train, labels)
    got = {r.doc_id: r for r in toxicity.score(make_docs(rows[600:]), machine).collect()}
    assert np.mean([got[i].predicted == int(i % 3 == 0) for i in got]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got.values())
    odd = toxicity.score(odd_docs, machine).collect()
    assert len(odd) == odd_docs.count() and len({r.score for r in odd}) == 1
    empty = toxicity.train(train.limit(0), labels)
    assert 0 <= toxicity.score(odd_docs, empty).first().score <= 1
    assert toxicity.score(odd_docs.limit(0), machine).count() == 0


def test_pairs_weigh_more_than_their_terms():
    """Label 1 only where two terms meet: a linear machine cannot learn it."""
    rng = np.random.default_rng(3)
    a, b = rng.random(2000) < 0.5, rng.random(2000) < 0.5
    rows = np.concatenate([np.flatnonzero(x) * 0 + k for k, x in enumerate((a, b))])
    owner = np.concatenate([np.flatnonzero(a), np.flatnonzero(b)])
    labels = (a == b).astype(float)
    machine = toxicity.Machine(np.array([10, 20]), 0.0)
    machine.fit(rows, owner, labels, rounds=1500, rate=0.5)
    marked = machine.margins(rows, owner, 2000) > 0
    assert (marked == (labels > 0)).mean() > 0.99


def test_pairs_of_a_weak_term_are_learnt(spark, make_docs):
    """A group word is toxic beside a verb that alone has no effect: as many toxic rows hold none of either."""
    rng = random.Random(12)
    docs, labels = [], []
    for i in range(4000):
        group, insult = i % 10 == 0, i % 10 == 1
        verb = rng.random() < (0.5 if group else 0 if insult else 0.25)
        words = [f"w{chr(97 + rng.randrange(26))}{chr(97 + rng.randrange(26))}{chr(97 + rng.randrange(26))}" for _ in range(20)]
        docs.append((i, " ".join([*words, *["group"] * group, *["verb"] * verb, *["insult"] * insult])))
        labels.append((i, int(group and verb or insult)))
    docs = make_docs(docs)
    machine = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    found = {r.doc_id: r.predicted for r in toxicity.score(docs, machine).collect()}
    assert np.mean([found[i] == y for i, y in labels if i % 10 == 0]) > 0.95
    assert np.mean([found[i] == y for i, y in labels]) > 0.98


def test_pairs_against_counts_one_by_one(spark, monkeypatch):
    """All pairs of all terms, in one block and in many, hold the statistics of plain counts."""
    rng = random.Random(21)
    rows = []
    for _ in range(400):
        terms = {rng.randrange(40) for _ in range(rng.randint(0, 12))}
        rows.append((int({3, 5} <= terms or rng.random() < 0.1), sorted(terms)))
    few = spark.createDataFrame(rows, "y int, terms array<int>").repartition(3)
    held, toxic = Counter(t for _, ts in rows for t in ts), Counter(t for y, ts in rows for t in ts if y)
    want: dict[int, float] = {}
    for a, b in itertools.combinations(held, 2):
        n_1, n = (sum(a in ts and b in ts and y >= least for y, ts in rows) for least in (1, 0))
        g = min(float(toxicity._g_statistic(n_1, n - n_1, toxic[x], held[x] - toxic[x])) for x in (a, b))
        if n >= toxicity.LEAST_DOCS and g >= 5:
            want[a], want[b] = max(want.get(a, 0), g), max(want.get(b, 0), g)
    monkeypatch.setattr(toxicity, "LEAST_G", 5.0)
    terms = np.array(sorted(held))
    for side, wide in ((2048, 1 << 15), (7, 1 << 15), (7, 4), (2048, 0)):
        monkeypatch.setattr(toxicity, "SIDE", side)
        monkeypatch.setattr(toxicity, "WIDE", wide)
        got = toxicity._partners(few, terms, np.array([toxic[t] for t in terms]), np.array([held[t] for t in terms]))
        assert {3, 5} <= set(got) == set(want) and all(got[t] == pytest.approx(want[t]) for t in want)
    monkeypatch.setattr(toxicity, "SIDE", 4)  # several stripes a share
    for shares in (1, 3):
        monkeypatch.setattr(toxicity, "SHARES", shares)
        got = toxicity._partners(few, terms, np.array([toxic[t] for t in terms]), np.array([held[t] for t in terms]))
        assert set(got) == set(want) and all(got[t] == pytest.approx(want[t]) for t in want)


def test_near_copies_of_toxicity_rows(spark):
    rows = [(1, 0, 5, 6, 7, 8), (2, 0, 5, 6, 7, 8), (3, 1, 5, 6, 7, 8), (4, 0, 5, 9, 9, 9), (5, 1, 5, 6, 7, 9)]
    few = spark.createDataFrame(rows, "id long, y int, s0 long, s1 long, s2 long, s3 long")
    assert {r.id for r in toxicity._alone(few).collect()} == {1, 3, 4, 5}


def test_margins_are_sums_over_pairs():
    machine = toxicity.Machine(np.arange(6), 0.3)
    machine.weights[:] = np.arange(6) / 7
    own = [0, 2, 5]
    want = 0.3 + sum(machine.weights[i] for i in own) + sum(machine.factors[i] @ machine.factors[j] for i in own for j in own if i < j)
    assert machine.margins(np.array(own), np.zeros(3, int), 1)[0] == pytest.approx(want)


def brute_base(rows):
    tokens = {k: [*pitman_yor.tokens_of(t), None] for k, (_, t, _) in enumerate(rows)}
    counts = Counter(w for k, (_, _, train) in enumerate(rows) if train for w in tokens[k])
    total, words = sum(counts.values()), len(counts)
    return sorted(
        (
            (i, train, len(tokens[k]), sum(counts[w] > 0 for w in tokens[k]), total,
             round(sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (words + 1))) for w in tokens[k]), 6))
            for k, (i, _, train) in enumerate(rows)
        ),
        key=repr,
    )


def scored(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string, train boolean").withColumn("score", F.lit("clash"))
    return pitman_yor.score(docs, **options).collect()


def test_base_scores_against_counts(spark, odd_docs):
    rng = random.Random(6)
    words = ["the", "a", "Cat", "sat", "on", "naïve"] + [f"w{k}" for k in range(200)]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(0, 40))), rng.random() < 0.8) for i in range(120)]
    rows += [(r.doc_id, r.text, k % 2 == 0) for k, r in enumerate(odd_docs.collect())]
    for size in (16 << 20, 2000):  # one bucket, and many
        got = scored(spark, rows, bucket_bytes=size)
        assert sorted(((r.doc_id, r.train, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got), key=repr) == brute_base(rows)
        assert all(r.score < 0 for r in got)


def test_model_is_a_distribution(spark):
    """Over a closed vocabulary, the probabilities of what follows a word and of the unseen word add to one."""
    rng = random.Random(1)
    train = [(i, " ".join(rng.choices(["a", "b", "c"], [5, 3, 1], k=30)), True) for i in range(40)]
    nexts = ["", "a", "b", "c", "unseen"]
    ask = [(1000 + k, w, False) for k, w in enumerate(nexts)] + [(2000 + k, f"a {w}", False) for k, w in enumerate(nexts)]
    got = {r.doc_id: r.score for r in scored(spark, train + ask)}
    # P(end | begin) + sum of P(w | begin): the end after one word is taken off again
    end_a = 10 ** (got[2000] - got[1001])  # text "a " is "a": the same text
    assert end_a == pytest.approx(1.0)
    rows = {r.doc_id: r for r in scored(spark, train + [(3000, "a a", False), (3001, "a", False), (3002, "a a a", False)])}
    ratio = 10 ** (rows[3000].score - rows[3001].score)
    assert 10 ** (rows[3002].score - rows[3000].score) == pytest.approx(ratio, rel=1e-4)  # P(a | a) each time
    assert 0.3 < ratio < 0.7


def test_model_learns_order(spark):
    rng = random.Random(2)
    line = [f"w{k}" for k in range(30)]
    rows = []
    for i in range(200):
        k = rng.randrange(20)
        rows.append((i, " ".join(line[k : k + 8]), i % 10 != 0))
    rows += [(900, "w3 w4 w5 w6", False), (901, "w6 w3 w5 w4", False)]
    got = {r.doc_id: r for r in scored(spark, rows)}
    assert got[900].score > got[901].score + 2
    held = [r for r in got.values() if not r.train and r.doc_id < 900]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_seats_follow_the_process():
    """Expected tables of a Pitman-Yor restaurant with one dish, against the closed form."""
    d = 0.5
    random_ = np.random.default_rng(5)
    one = []
    for c in (2, 10, 50):
        opening = np.full(4000, 0.4)
        tables = pitman_yor.seat(np.full(4000, c), opening, d, random_)
        exact = np.zeros(c + 2)
        exact[1] = 1.0
        for seated in range(1, c):
            t = np.arange(c + 2)
            p = 0.4 / (0.4 + np.maximum(seated - d * t, 1e-12))
            exact = exact * (1 - p) + np.concatenate([[0], (exact * p)[:-1]])
        one.append(abs(tables.mean() - exact @ np.arange(c + 2)) / tables.mean())
    assert max(one) < 0.02
    many = pitman_yor.seat(np.array([1_000_000, 1, 0]), np.full(3, 0.4), d, random_)
    assert 1 <= many[0] < 1000 and many[1:].tolist() == [1, 0]


def test_packed_arrays():
    rng = np.random.default_rng(0)
    arrays = [rng.integers(0, 1 << 63, 100, np.uint64), np.sort(rng.integers(0, 1 << 63, 100, np.uint64)), np.zeros(0, np.uint64), rng.random(5), np.arange(300, dtype=np.uint16)]
    for a, b in zip(arrays, pitman_yor.unpack(pitman_yor.pack(*arrays))):
        assert a.dtype == b.dtype and a.tolist() == b.tolist()


def test_score_of_nothing(spark):
    assert scored(spark, []) == []
    assert [r.score for r in scored(spark, [(1, "a", False)])] == [0.0]


def test_tables(spark):
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("pairs_")], SF


def test_a_worker_forgets_other_operators():
    from creelgrid.llm import near_dedup, pitman_yor

    toxicity.terms_of("a few words")
    assert toxicity._known
    near_dedup.kmers([b"a", b"few", b"words"])
    assert near_dedup._known and not toxicity._known
    pitman_yor.hashes_of([b"a"])
    assert pitman_yor._known and not near_dedup._known


def test_fit_with_and_without_the_dense_part(monkeypatch):
    """The machine is the same whether no term, some or all lie in the matrix."""
    rng = np.random.default_rng(5)
    held = rng.random((200, 30)) < 0.2
    owner, rows = np.nonzero(held)
    labels = (held[:, 3] & held[:, 5]).astype(float)
    got = []
    for cells in (0, 200 * 7, 1 << 20):
        monkeypatch.setattr(toxicity, "DENSE", cells)
        machine = toxicity.Machine(np.arange(30), -1.0)
        machine.fit(rows, owner, labels, rounds=60)
        got.append(machine.margins(rows, owner, 200))
    assert np.allclose(got[0], got[1], atol=1e-4) and np.allclose(got[0], got[2], atol=1e-4)
    none = toxicity.Machine(np.arange(2), 0.5)
    none.fit(np.zeros(0, int), np.zeros(0, int), np.zeros(0), rounds=2)
    assert np.isfinite(none.bias)


def slices_of_pairs(rng, slices, docs, words, n):
    """(bodies as slices send them, their entries): entries are slice, document, first and second word, times, train."""
    bodies, entries = [], []
    for c in range(slices):
        cells = np.unique(rng.integers(0, docs * words * words, n))
        doc, first, second = cells % docs, cells // docs // words, cells // docs % words  # sorted by words, then document
        times, train = rng.integers(1, 4, len(cells)), doc % 3 != 0
        heads, per = np.unique(first, return_counts=True)
        dishes, which = np.unique(second, return_inverse=True)
        narrow = [pitman_yor.least_type(x) for x in (per, which, doc, times << 1 | train)]
        bodies.append(pitman_yor.pack(heads.astype(np.uint64), narrow[0], dishes.astype(np.uint64), *narrow[1:]))
        entries += zip([c] * len(cells), doc.tolist(), first.tolist(), second.tolist(), times.tolist(), train.tolist())
    return bodies, entries


def test_buckets_hold_and_add_up_their_pairs(monkeypatch):
    monkeypatch.setattr(pitman_yor, "STRETCH", 100)
    bodies, entries = slices_of_pairs(np.random.default_rng(4), 300, 9, 7, 40)
    own = pitman_yor.Bucket.unpack(pitman_yor.Bucket.merged(bodies, np.arange(300)).pack())
    customers, weights, want = Counter(), {}, Counter()
    for _, _, a, b, times, train in entries:
        customers[a, b] += times * train
        weights[a, b] = a + b / 10
    for c, d, a, b, times, _ in entries:
        want[c, d] += weights[a, b] * times
    pairs = list(zip(np.repeat(own.first, own.per_first).tolist(), own.dishes[own.which].tolist()))
    assert pairs == sorted(customers) and own.customers.tolist() == [customers[p] for p in pairs]
    chunk, doc, (sums,) = own.by_document(np.array([weights[p] for p in pairs]))
    assert dict(zip(zip(chunk.tolist(), doc.tolist()), sums.tolist())) == pytest.approx(dict(want))
    assert list(zip(chunk.tolist(), doc.tolist())) == sorted(want)
    assert not hasattr(pitman_yor.Bucket.unpack(own.pack(), documents=False), "doc")


def test_buckets_are_merged_in_bounded_memory():
    """Bytes for each pair of a document; a bucket of 8 MB of text has over a million."""
    import tracemalloc

    bodies, entries = slices_of_pairs(np.random.default_rng(5), 8, 1000, 300, 30_000)
    tracemalloc.start()
    try:
        own = pitman_yor.Bucket.merged(bodies, np.arange(8))
        merged = tracemalloc.get_traced_memory()[1]
        body = own.pack()
        del own
        tracemalloc.reset_peak()
        own = pitman_yor.Bucket.unpack(body)
        own.by_document(np.ones(len(own.which)))
        added = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert merged < 45 * len(entries) and added < 45 * len(entries)


def test_seating_forgets_the_words():
    pitman_yor.hashes_of([b"a"])
    assert pitman_yor._known
    working(pitman_yor.SEATING)
    assert not pitman_yor._known
