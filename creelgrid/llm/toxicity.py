"""Toxicity by a factorization machine over hashed terms: a term weighs more beside certain others."""

from __future__ import annotations

import itertools
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creelgrid.session import stage_table

from .base import by_size, remembers, words_of, working

#: Hash buckets of terms; terms that the machine keeps at most; the least G-statistic of a kept term and
#: the documents it must stand in; labelled rows in the training sample (expected number); factors.
BUCKETS, TERMS, LEAST_G, LEAST_DOCS, SAMPLE, FACTORS = 1 << 18, 4096, 30.0, 5, 40_000, 8
#: Terms on either side of a block of pairs, which a task counts in one matrix.
SIDE = 2048
#: Shares of the stripes of ``SIDE`` terms: a row is sent once for each pair of shares in which it has terms.
SHARES = 8
#: Pairs of a row in a block from which they are added by a matrix product, with other such rows.
WIDE = 1 << 15
#: Cells of the matrix of texts and commonest terms that the driver keeps while it fits the machine (4 bytes each).
DENSE = 24 << 20
#: Score from which a text is marked.
MARK = 0.7

_SKETCHES = 4
_known: dict[bytes, int] = {}


def _hash(word: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(word)


def terms_of(text: str | None) -> np.ndarray:
    """Sorted distinct hashed terms of a whole text: words of letters, A-Z lower-cased, without digits."""
    words = set(words_of(text))
    working("toxicity")
    if len(_known) > 500_000:
        _known.clear()
    _known.update([(w, _hash(w) & (BUCKETS - 1)) for w in words if w not in _known])
    return np.unique(np.fromiter(map(_known.__getitem__, words), np.int32, len(words)))


def _sketch(text: str) -> list[int]:
    """Least hashes of three-word runs under some hash functions: near copies share most of them."""
    words = words_of(text)
    runs = {b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))}
    base = np.fromiter(map(_hash, runs), np.uint64, len(runs))
    mixed = ((base ^ (base >> np.uint64(31))) * np.uint64(2 * k + 0x9E3779B97F4A7C15) for k in range(_SKETCHES))
    return [int((m ^ (m >> np.uint64(30))).min() >> np.uint64(1)) for m in mixed]


class Machine:
    """Weights and factors of the kept terms; ``place`` maps a bucket to its row, -1 for none."""

    def __init__(self, terms: np.ndarray, bias: float, factors: int = FACTORS):
        self.place = np.full(BUCKETS, -1, np.int32)
        self.place[terms] = np.arange(len(terms))
        self.bias, self.weights = bias, np.zeros(len(terms))
        self.factors = np.random.default_rng(7).normal(0, 0.05, (len(terms), factors))

    def margins(self, rows: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
        """w0 + sum of weights + sum over pairs of the products of their factors, per text."""
        out = self.bias + np.bincount(owner, self.weights[rows], minlength=texts)
        for f in range(self.factors.shape[1]):
            v = self.factors[rows, f]
            out += 0.5 * (np.bincount(owner, v, minlength=texts) ** 2 - np.bincount(owner, v * v, minlength=texts))
        return out

    def fit(self, rows: np.ndarray, owner: np.ndarray, labels: np.ndarray, rounds: int = 400, rate: float = 0.3, shrink: float = 1e-5) -> None:
        """Logistic loss over the whole sample, Adagrad steps, weight decay.

        A round is two products with the 0/1 matrix of texts and terms, for weights and factors together."""
        n, texts = len(self.weights), len(labels)
        held = _Held(rows, owner, texts, n)
        seen_b, seen_w, seen_v = 1e-8, np.full(n, 1e-8), np.full(self.factors.shape, 1e-8)
        for _ in range(rounds):
            own = self.weights - 0.5 * (self.factors**2).sum(1)  # a pair of a term with itself is none
            sums = held.by_text(np.column_stack([own, self.factors]))
            margins = self.bias + sums[:, 0] + 0.5 * (sums[:, 1:] ** 2).sum(1)
            error = (1 / (1 + np.exp(-np.clip(margins, -30, 30))) - labels) / max(texts, 1)
            grads = held.by_term(np.column_stack([error, error[:, None] * sums[:, 1:]]))
            grad_b, grad_w = error.sum(), grads[:, 0] + shrink * self.weights
            grad_v = grads[:, 1:] - self.factors * grads[:, :1] + shrink * self.factors
            seen_b, seen_w, seen_v = seen_b + grad_b**2, seen_w + grad_w**2, seen_v + grad_v**2
            self.bias -= rate * grad_b / np.sqrt(seen_b)
            self.weights -= rate * grad_w / np.sqrt(seen_w)
            self.factors -= rate / 4 * grad_v / np.sqrt(seen_v)


class _Held:
    """Which texts hold which terms: a dense part for the commonest terms, at most ``DENSE`` cells, places for the rest."""

    def __init__(self, rows: np.ndarray, owner: np.ndarray, texts: int, terms: int):
        self.texts, self.terms = texts, terms
        self.common = np.argsort(-np.bincount(rows, minlength=terms), kind="stable")[: DENSE // max(texts, 1)]
        column = np.full(terms, -1)
        column[self.common] = np.arange(len(self.common))
        at = column[rows]
        self.dense = np.zeros((texts, len(self.common)), np.float32)
        self.dense[owner[at >= 0], at[at >= 0]] = 1
        self.rows, self.owner = rows[at < 0], owner[at < 0]

    def by_text(self, values: np.ndarray) -> np.ndarray:
        """Sums of the terms' values, a column at a time, per text."""
        out = (self.dense @ values[self.common].astype(np.float32)).astype(float)
        for k in range(values.shape[1]):
            out[:, k] += np.bincount(self.owner, values[self.rows, k], minlength=self.texts)
        return out

    def by_term(self, values: np.ndarray) -> np.ndarray:
        """Sums of the texts' values per term."""
        out = np.zeros((self.terms, values.shape[1]))
        out[self.common] = self.dense.T @ values.astype(np.float32)
        for k in range(values.shape[1]):
            out[:, k] += np.bincount(self.rows, values[self.owner, k], minlength=self.terms)
        return out


def _g_statistic(with_1, with_0, all_1, all_0):
    """Twice the log-likelihood ratio of a term's documents against independence of the label."""
    cells = [with_1, with_0, all_1 - with_1, all_0 - with_0]
    total = all_1 + all_0
    held = with_1 + with_0
    expected = [held * all_1 / total, held * all_0 / total, (total - held) * all_1 / total, (total - held) * all_0 / total]
    return 2 * sum(np.where(c > 0, c * np.log(np.maximum(c, 1e-12) / np.maximum(e, 1e-12)), 0.0) for c, e in zip(cells, expected))


def _alone(few: DataFrame) -> DataFrame:
    """The least id of each group of near copies: rows of one label whose four least hashes all agree."""
    return few.groupBy("y", *(f"s{k}" for k in range(_SKETCHES))).agg(F.min("id").alias("id")).select("id")


def _lists(column: pa.ListArray) -> list[np.ndarray]:
    """The lists of a column without nulls."""
    ends = np.cumsum(column.value_lengths().to_numpy())
    return np.split(column.flatten().to_numpy(), ends[:-1]) if len(ends) else []


def _blocks(few: DataFrame, place: np.ndarray) -> DataFrame:
    """(block, y, first, other): each row's terms (their places) in every block of pairs in which it has any.

    The stripes of ``SIDE`` places are dealt to ``SHARES`` shares, in order; a block is a pair of shares, the lower
    one first, so a pair of terms is in one block, and a row is sent to at most ``SHARES`` * (``SHARES`` + 1) / 2
    blocks, however many terms there are."""
    sent = few.sparkSession.sparkContext.broadcast(place)
    wide = _share(int(place.max()) + 1)

    def packed(rows: list[tuple]):
        blocks, labels, first, other = zip(*rows)
        lists = [pa.array(x, pa.list_(pa.int32())) for x in (first, other)]
        return pa.RecordBatch.from_arrays([pa.array(blocks, pa.int32()), pa.array(labels, pa.int32()), *lists], ["block", "y", "first", "other"])

    def run(batches):
        place, rows = sent.value, []
        for batch in batches:
            for own, y in zip(_lists(batch.column("terms")), batch.column("y").to_pylist()):
                at = np.sort(place[own])
                at = at[at >= 0]
                held, starts = np.unique(at // wide, return_index=True)
                parts = np.split(at, starts[1:])
                for i, low in enumerate(held.tolist()):
                    rows += [(low * SHARES + high, y, parts[i], parts[i + j]) for j, high in enumerate(held[i:].tolist())]
                    if len(rows) > 5000:
                        yield packed(rows)
                        rows = []
        if rows:
            yield packed(rows)

    return few.select("y", "terms").mapInArrow(run, "block int, y int, first array<int>, other array<int>")


def _share(terms: int) -> int:
    """Places of a share: whole stripes."""
    stripes = -(-terms // SIDE)
    return -(-stripes // SHARES) * SIDE


def _cut(rows: list[np.ndarray], side: int) -> dict[int, dict[int, np.ndarray]]:
    """stripe -> row -> places of the row's terms within that stripe; the lists are sorted."""
    out: dict[int, dict[int, np.ndarray]] = {}
    for k, at in enumerate(rows):
        held, starts = np.unique(at // side, return_index=True)
        for stripe, part in zip(held.tolist(), np.split(at % side, starts[1:])):
            out.setdefault(stripe, {})[k] = part.astype(np.int16)
    return out


def _counted(labels: list[int], lows: dict[int, np.ndarray], highs: dict[int, np.ndarray], side: int, most: int) -> np.ndarray:
    """Rows of each label that hold a term of one stripe and a term of the other: (label, term, term).

    From ``most`` pairs a row is added with others by a matrix product."""
    counts, wide = np.zeros((2, side, side), np.int32), ([], [])
    for k, first in lows.items():
        other, y = highs.get(k), labels[k]
        if other is None:
            continue
        if len(first) * len(other) < most:
            counts[y][first[:, None], other] += 1
        else:
            wide[y].append((first, other))
            if len(wide[y]) == 256:
                _add(counts[y], wide[y])
    for own, rows in zip(counts, wide):
        _add(own, rows)
    return counts


def _add(counts: np.ndarray, rows: list[tuple[np.ndarray, np.ndarray]]) -> None:
    """Adds the pairs of rows with many terms as one product of 0/1 matrices, and empties the list."""
    sides = np.zeros((2, len(rows), len(counts)), np.float32)
    for k, ends in enumerate(rows):
        for side, at in zip(sides, ends):
            side[k, at] = 1
    if rows:
        counts += (sides[0].T @ sides[1]).astype(np.int32)
    rows.clear()


def _partners(few: DataFrame, terms: np.ndarray, with_1: np.ndarray, held: np.ndarray) -> dict[int, float]:
    """Terms of pairs of which either tells the label apart among the rows of the other, with the best statistic.

    That of a pair is the lesser G-statistic of the two, so a strong term does not bring along what stands beside
    it. ``terms`` are those in ``LEAST_DOCS`` rows, with their toxic rows and rows. All their pairs are counted; one
    counts from ``LEAST_DOCS`` rows and a statistic of ``LEAST_G``, and at most ``TERMS`` pairs, the strongest,
    come to the driver. A task holds the rows of a block, which the sample bounds, and counts two stripes after two
    in a matrix of ``SIDE`` x ``SIDE``."""
    able = _g_statistic(with_1, np.zeros(len(terms)), with_1, held - with_1) >= LEAST_G
    terms, with_1, held = terms[able], with_1[able], held[able]  # no other could tell the label apart in the others' rows
    if not len(terms):
        return {}

    order = np.lexsort((terms, -held))  # common terms in few stripes, so that a row is in few blocks
    terms, with_1, held = terms[order], with_1[order], held[order]
    place = np.full(BUCKETS, -1, np.int32)
    place[terms] = np.arange(len(terms))
    sent = few.sparkSession.sparkContext.broadcast((terms, with_1, held))

    def weighed(low: int, high: int, counts: np.ndarray):
        """Pairs (a, b) of two stripes with the lesser of two statistics: b's among the rows of a, a's among those of b."""
        terms, with_1, held = sent.value
        low, high = low * SIDE, high * SIDE
        found = []
        for i in range(min(SIDE, len(terms) - low)):
            j = np.flatnonzero(counts[:, i].sum(0) >= LEAST_DOCS)
            j = j[j > i] if low == high else j
            n_0, n_1 = counts[:, i, j].astype(float)
            g = np.minimum(*(_g_statistic(n_1, n_0, with_1[x], held[x] - with_1[x]) for x in (low + i, high + j)))
            j, g = j[g >= LEAST_G], g[g >= LEAST_G]
            found.append((np.full(len(j), terms[low + i]), terms[high + j], g))
        a, b, g = (np.concatenate(x) for x in zip(*found))
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(g)], ["a", "b", "g"])

    def count(batches):
        now, labels, ends = None, [], ([], [])

        def found():
            lows, highs = (_cut(e, SIDE) for e in ends)
            for low, high in itertools.product(lows, highs):
                if low <= high:
                    yield weighed(low, high, _counted(labels, lows[low], highs[high], SIDE, WIDE))

        for batch in batches:
            lists = (_lists(batch.column(c)) for c in ("first", "other"))
            for block, y, *own in zip(batch.column("block").to_pylist(), batch.column("y").to_pylist(), *lists):
                if block != now:
                    yield from found()
                    now, labels, ends = block, [], ([], [])
                labels.append(y)
                for rows, at in zip(ends, own):
                    rows.append(at)
        yield from found()

    blocks = _blocks(few, place).repartition(SHARES * (SHARES + 1) // 2, "block").sortWithinPartitions("block")
    best = blocks.mapInArrow(count, "a long, b long, g double").orderBy(F.desc("g"), "a", "b").limit(TERMS).toPandas()
    out: dict[int, float] = {}
    for a, b, g in best.itertuples(index=False):
        out[a], out[b] = max(out.get(a, 0.0), g), max(out.get(b, 0.0), g)
    return out


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE
) -> Machine:
    """Fit the machine on a bounded sample of labelled rows, whole texts.

    About ``sample`` labelled ids are taken by a hash of the id; only these few are broadcast, to be found
    in ``docs``. Of near copies of one label (all four least hashes of three-word runs agree) one row teaches.
    Terms with a high G-statistic for the label come to the driver, at most ``TERMS``, with the rows of the
    sample reduced to them; so do pairs of terms of which each has one among the rows of the other, whatever
    they are alone. Rows without a label or text teach nothing; an id with several labels counts as 1 if any is 1.
    """
    labels = labels.select(F.col(id_col).alias("id"), (F.col(label_col).cast("int") > 0).cast("int").alias("y")).filter("id is not null and y is not null")
    total = labels.count()
    unit = F.pmod(F.xxhash64("id"), F.lit(1 << 20)) / (1 << 20)
    chosen = labels.filter(unit < min(1.0, sample / max(total, 1))).groupBy("id").agg(F.max("y").alias("y"))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter("text is not null")

    def run(batches):
        for batch in by_size(batches):
            texts = batch.column("text").to_pylist()
            found, sketches = [terms_of(t) for t in texts], np.array([_sketch(t) for t in texts], np.int64).reshape(-1, _SKETCHES)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("y"), pa.array(found, pa.list_(pa.int32())), *(pa.array(s) for s in sketches.T)],
                ["id", "y", "terms", *(f"s{k}" for k in range(_SKETCHES))],
            )

    sketched = ", ".join(f"s{k} long" for k in range(_SKETCHES))
    kind = docs.schema[id_col].dataType.simpleString()
    few = rows.join(F.broadcast(chosen), "id").select("id", "text", "y").mapInArrow(run, f"id {kind}, y int, terms array<int>, {sketched}")
    few = stage_table(few, "toxic")
    few = few.join(F.broadcast(_alone(few)), "id", "left_semi").select("y", "terms")  # ids of the sample
    whole = few.agg(F.count("*").alias("n"), F.coalesce(F.sum("y"), F.lit(0)).alias("y")).first()
    counts = (
        few.select("y", F.explode("terms").alias("term")).groupBy("term").agg(F.sum("y").alias("with_1"), F.count("*").alias("held"))
        .filter(F.col("held") >= LEAST_DOCS).toPandas()
    )  # at most one row per bucket
    g = _g_statistic(counts.with_1.to_numpy(float), (counts.held - counts.with_1).to_numpy(float), max(whole.y, 1e-9), max(whole.n - whole.y, 1e-9)) if len(counts) else np.zeros(0)
    strength = {int(t): float(x) for t, x in zip(counts.term, g) if x >= LEAST_G}
    found = _partners(few, *(counts[c].to_numpy(np.int64) for c in ("term", "with_1", "held")))
    for t, x in found.items():
        strength[t] = max(x, strength.get(t, 0.0))
    picked = np.array(sorted(strength, key=lambda t: (-strength[t], t))[:TERMS], np.int64)
    share = (whole.y + 0.5) / (whole.n + 1)
    machine = Machine(picked, float(np.log(share / (1 - share))))
    if len(picked):
        sent = few.sparkSession.sparkContext.broadcast(machine.place)

        def reduce(batches):
            place = sent.value
            for batch in batches:
                kept = [t[place[t] >= 0] for t in _lists(batch.column("terms"))]
                yield pa.RecordBatch.from_arrays([batch.column("y"), pa.array(kept, pa.list_(pa.int32()))], ["y", "terms"])

        reduced = few.select("y", "terms").mapInArrow(reduce, "y int, terms array<int>").toPandas()
        owner = np.repeat(np.arange(len(reduced)), [len(t) for t in reduced.terms])
        flat = np.concatenate([*reduced.terms, []]).astype(np.int64)
        machine.fit(machine.place[flat], owner, reduced.y.to_numpy(float))
    return machine


_held: dict[str, Machine] = {}


def _forget() -> None:
    _known.clear()
    _held.clear()


remembers("toxicity", _forget)


def score(docs: DataFrame, machine: Machine, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, score (0 to 1), predicted (1 from ``MARK``).

    A text without known terms, so a null or empty one, has the score of the bias, near the share of
    toxic rows in the sample. Rows that repeat and null ids stay; an empty table gives none.
    """
    sent, name = docs.sparkSession.sparkContext.broadcast(machine.__dict__), uuid.uuid4().hex
    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches):
        working("toxicity")
        if name not in _held:
            _held.clear()
            _held[name] = own = object.__new__(Machine)
            own.__dict__.update(sent.value)
        own = _held[name]
        for batch in by_size(batches):
            found = [own.place[terms_of(t)] for t in batch.column("text").to_pylist()]
            found = [t[t >= 0] for t in found]
            owner = np.repeat(np.arange(len(found)), [len(t) for t in found])
            margins = own.margins(np.concatenate([*found, np.zeros(0, np.int32)]).astype(np.int64), owner, len(found))
            scores = 1 / (1 + np.exp(-np.clip(margins, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores), pa.array((scores >= MARK).astype(np.int32))], ["doc_id", "score", "predicted"])

    return picked.mapInArrow(run, f"doc_id {docs.schema[id_col].dataType.simpleString()}, score double, predicted int")
