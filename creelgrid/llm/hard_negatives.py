"""Hard negatives by exact inner products, behind bounds from the means and deviations of vector segments."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from creelgrid.session import stage_table

#: Segments per vector at each level of refinement, coarse to fine.
LEVELS = (4, 16)
#: Bytes of anchors that one pass over the rows compares, and of bounds that a task holds at once.
BLOCK_BYTES, BOUND_BYTES = 4 << 20, 16 << 20
#: Largest sum of products that doubles hold exactly.
_EXACT = 1 << 53


class Vectors:
    """Vectors of whole numbers as rows, with the summaries of their segments."""

    def __init__(self, matrix: np.ndarray):
        n, width = matrix.shape
        self.matrix = matrix
        self.size = float(np.abs(matrix).max(initial=0.0))
        self.norms = np.sqrt((matrix * matrix).sum(1))
        self.summaries = []
        for segments in LEVELS:
            long = max(1, -(-width // segments))
            padded = np.zeros((n, segments * long))
            padded[:, :width] = matrix
            parts = padded.reshape(n, segments, long)
            means = parts.mean(2)
            deviations = np.sqrt(np.maximum(0.0, ((parts - means[:, :, None]) ** 2).sum(2)))
            self.summaries.append((means * math.sqrt(long), deviations))

    def take(self, low: int, high: int) -> Vectors:
        part = object.__new__(Vectors)
        part.matrix, part.norms, part.size = self.matrix[low:high], self.norms[low:high], self.size
        part.summaries = [(m[low:high], d[low:high]) for m, d in self.summaries]
        return part


def scores(rows: Vectors, anchors: Vectors, r: np.ndarray, a: np.ndarray) -> np.ndarray:
    """Inner products of rows ``r`` and anchors ``a``, exact: in doubles where these hold them, else in Python's numbers."""
    width = rows.matrix.shape[1]
    if rows.size * anchors.size * width < _EXACT:
        step = max(1, BOUND_BYTES // (16 * max(1, width)))
        parts = [
            np.einsum("ij,ij->i", rows.matrix[r[i : i + step]], anchors.matrix[a[i : i + step]]) for i in range(0, len(r), step)
        ]
        return np.concatenate(parts).astype(np.int64) if parts else np.zeros(0, np.int64)
    big = 2**63 - 1
    exact = (sum(int(x) * int(y) for x, y in zip(rows.matrix[i], anchors.matrix[j])) for i, j in zip(r, a))
    return np.array([min(big, max(-big, s)) for s in exact], np.int64)


def survivors(rows: Vectors, anchors: Vectors, allowed: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row, anchor) among ``allowed`` whose score may lie between the anchor's ``least`` and ``most``.

    The product of a segment's means, times its length, plus or minus the product of its deviations holds
    the segment's score. Pairs that the coarse sums do not exclude are bounded again on finer segments.
    """
    slack = 1e-9 * rows.norms[:, None] * anchors.norms[None, :] + 1e-6
    (row_means, row_spread), (means, spread) = rows.summaries[0], anchors.summaries[0]
    centre, reach = row_means @ means.T, row_spread @ spread.T + slack
    r, a = np.nonzero(allowed & (centre + reach >= least) & (centre - reach <= most))
    for (row_means, row_spread), (means, spread) in zip(rows.summaries[1:], anchors.summaries[1:]):
        kept = []
        step = max(1, BOUND_BYTES // (32 * means.shape[1]))
        for i in range(0, len(r), step):
            x, y = r[i : i + step], a[i : i + step]
            centre = np.einsum("ij,ij->i", row_means[x], means[y])
            reach = np.einsum("ij,ij->i", row_spread[x], spread[y]) + slack[x, y]
            kept.append((centre + reach >= least[y]) & (centre - reach <= most[y]))
        keep = np.concatenate(kept) if kept else np.zeros(0, bool)
        r, a = r[keep], a[keep]
    return r, a


class Best:
    """The ``k`` rows of highest score for each key, equal scores by id; repeated rows count each."""

    def __init__(self, keys: int, k: int):
        self.k = k
        self.key, self.score, self.id = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.threshold = np.full(keys, -np.inf)

    def add(self, key: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(key):
            return
        key, score, ids = (np.concatenate(c) for c in ((self.key, key), (self.score, score), (self.id, ids)))
        order = np.lexsort((ids, -score, key))
        key, score, ids = key[order], score[order], ids[order]
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        rank = np.arange(len(key)) - np.repeat(first, np.diff(np.append(first, len(key))))
        kept = rank < self.k
        full = rank == self.k - 1
        self.threshold[key[full]] = score[full]
        self.key, self.score, self.id = key[kept], score[kept], ids[kept]


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists of doubles as rows; shorter ones are filled with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def prepared(vectors: DataFrame, id_col: str, label_col: str, vector_col: str, scale: int) -> DataFrame:
    """id, label as text, components as whole numbers; rows without one of them or with a component that is no finite number are out."""
    whole = F.transform(vector_col, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("double"))
    usable = F.forall(vector_col, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    present = F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.col(vector_col).isNotNull()
    rows = vectors.filter(present & usable)
    return rows.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"), whole.alias("vector"))


def _search(rows: DataFrame, width: int, anchors: list, k: int, keys: int, limits: Callable, collect: Callable, same: bool) -> DataFrame:
    """One pass over the rows against one block of anchors: each task's ``k`` best rows for each key.

    ``limits`` gives the least and most score an anchor still wants; ``collect`` turns scored pairs into (key, pair).
    """
    sent = rows.sparkSession.sparkContext.broadcast(anchors)

    def run(batches):
        own = sent.value
        held = Vectors(np.array([list(a[2]) + [0.0] * (width - len(a[2])) for a in own]).reshape(len(own), width))
        anchor_ids = np.array([a[0] for a in own], np.int64)
        codes: dict[str, int] = {}
        labels = np.array([codes.setdefault(a[1], len(codes)) for a in own])
        best = Best(keys, k)
        for batch in batches:
            ids = batch.column("id").to_numpy()
            kinds = np.array([codes.get(x, -1) for x in batch.column("label").to_pylist()])
            block = Vectors(_matrix(batch.column("vector"), width))
            step = max(1, BOUND_BYTES // (64 * len(own)))
            low = 0
            while low < len(ids):
                high = min(len(ids), low + (step if len(best.key) else min(step, 256)))  # a few rows give the first thresholds
                part = block.take(low, high)
                allowed = (kinds[low:high, None] == labels[None, :]) == same
                if same:
                    allowed &= ids[low:high, None] != anchor_ids[None, :]
                least, most = limits(best)
                r, a = survivors(part, held, allowed, least, most)
                key, pair, score = collect(a, scores(part, held, r, a))
                best.add(key, score, ids[low:high][r[pair]])
                low = high
        if len(best.key):
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (best.key, best.id, best.score)], ["key", "id", "score"])

    return rows.mapInArrow(run, "key long, id long, score long")


def _top(found: DataFrame, group: list[str], k: int) -> DataFrame:
    order = W.partitionBy(*group).orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(
    vectors: DataFrame,
    is_anchor: Column | None = None,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
    scale: int = 256,
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per anchor, positive and negative: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    A component x counts as floor(``scale`` * x); a score is the inner product. The positives of an anchor
    are its ``positives`` best rows of the same label under another id; the negatives of a positive are the
    ``negatives`` best rows of another label with low * p <= 100 * n <= high * p for the scores p and n.
    Equal scores go by the smaller id. ``is_anchor`` picks the anchors by the column ``id`` (null: ids
    divisible by 50).

    Anchors come in blocks of about ``block_bytes``; a block is on the driver and broadcast, and two passes
    over all rows find its positives and then its negatives. A task keeps the best rows of each anchor and
    scores only the pairs that the bounds of their segments leave in between (`survivors`).

    Rows without id, label or vector, or with a component that is null or not finite, take no part. Shorter
    vectors count as filled with zeros, an empty one scores 0. Rows that repeat an id each count, as rows; an
    anchor that repeats is one anchor, the least by label and vector. Scores past 64 bits are cut to the
    largest. A positive that repeats under one id and score is one positive. Empty tables, anchors without
    positives and positives without negatives give no rows. Other columns are not read.
    """
    spark = vectors.sparkSession
    rows = prepared(vectors, id_col, label_col, vector_col, scale)
    chosen = rows.filter(F.col("id") % 50 == 0 if is_anchor is None else is_anchor)
    total, width = chosen.count(), rows.agg(F.max(F.size("vector"))).first()[0] or 0
    blocks = max(1, math.ceil(total * max(1, width) * 8 / block_bytes))
    block = F.pmod(F.xxhash64("id"), F.lit(blocks))
    found = []
    for b in range(blocks):
        taken = sorted(tuple(r) for r in chosen.filter(block == b).collect())
        anchors = [a for i, a in enumerate(taken) if not i or taken[i - 1][0] != a[0]]
        if not anchors:
            continue
        names = spark.createDataFrame([(i, a[0]) for i, a in enumerate(anchors)], "key long, anchor_id long")
        ends = np.full(len(anchors), np.inf)

        def near(best, ends=ends):
            return best.threshold, ends

        def each(a, score):
            return a, np.arange(len(a)), score

        near_rows = _top(_search(rows, width, anchors, positives, len(anchors), near, each, True), ["key"], positives)
        held = sorted((r.key, r.id, r.score) for r in near_rows.select("key", "id", "score").distinct().collect())
        # the scores between which a positive's negatives lie, in whole numbers
        bands = [(k, i, p, -(-low * p // 100), high * p // 100) for k, i, p in held]
        bands = [x for x in bands if x[3] <= x[4]]
        if not bands:
            continue
        owner, floor, ceiling = (np.array([x[c] for x in bands], np.int64) for c in (0, 3, 4))
        first = np.searchsorted(owner, np.arange(len(anchors)))
        number = np.searchsorted(owner, np.arange(len(anchors)), "right") - first

        def between(best, owner=owner, floor=floor, ceiling=ceiling, n=len(anchors)):
            least, most = np.full(n, np.inf), np.full(n, -np.inf)
            np.minimum.at(least, owner, np.maximum(floor, best.threshold))
            np.maximum.at(most, owner, ceiling)
            return least, most

        def banded(a, score, first=first, number=number, floor=floor, ceiling=ceiling):
            pair = np.repeat(np.arange(len(a)), number[a])
            start = np.repeat(np.cumsum(number[a]) - number[a], number[a])
            band = first[a[pair]] + np.arange(len(pair)) - start
            inside = (floor[band] <= score[pair]) & (score[pair] <= ceiling[band])
            return band[inside], pair[inside], score[pair[inside]]

        far_rows = _top(_search(rows, width, anchors, negatives, len(bands), between, banded, False), ["key"], negatives)
        pairs = spark.createDataFrame(
            [(n, x[0], x[1], x[2]) for n, x in enumerate(bands)], "band long, key long, positive_id long, positive_score long"
        ).join(names, "key").drop("key")
        found.append(
            stage_table(far_rows.join(pairs, F.col("key") == F.col("band")).select(
                "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
            ), "negatives")
        )
    if not found:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    out = found[0]
    for part in found[1:]:
        out = out.unionByName(part)
    return out
