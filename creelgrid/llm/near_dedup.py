"""Near duplicates by order MinHash and, for texts of few runs, a prefix filter, verified by banded alignment."""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creelgrid.session import stage_table

from .base import by_size, remembers, words_of, working
from .components import components

#: Words of a k-mer, components of a sketch, minima in each, and the least similarity of near duplicates
#: as a fraction (so that it is compared in whole numbers).
K, SKETCHES, MINIMA, LEAST = 5, 24, 4, (4, 5)
#: Texts of fewer runs are candidates by an exact filter instead: their few minima agree too rarely.
FEW = 20
#: Turns of leaders before all that is left apart is compared.
TURNS = 2
#: Nodes in one row of the lists that are counted then.
LIST = 1000

_SEEDS = np.random.default_rng(20).integers(1, 1 << 63, SKETCHES, np.uint64)
_PRIME = np.uint64(0x9E3779B97F4A7C15)
_ORDER = np.uint64(0xD6E8FEB86659FD93)
_known: dict[bytes, int] = {}
remembers("near_dedup", _known.clear)


def kmers(words: list[bytes]) -> np.ndarray:
    """Hashes (40 bits) of the runs of ``K`` words in text order; a shorter text is one run."""
    import xxhash

    if not words:
        return np.zeros(0, np.uint64)
    working("near_dedup")
    if len(_known) > 200_000:
        _known.clear()
    _known.update([(w, xxhash.xxh64_intdigest(w)) for w in set(words) if w not in _known])
    base = np.fromiter(map(_known.__getitem__, words), np.uint64, len(words))
    n = max(1, len(base) - K + 1)
    runs = np.zeros(n, np.uint64)
    for k in range(min(K, len(base))):
        runs = (runs ^ base[k : k + n]) * _PRIME
        runs ^= runs >> np.uint64(32)
    return runs >> np.uint64(24)


def labelled(runs: np.ndarray) -> np.ndarray:
    """Runs with their occurrence number: the second occurrence of a run is an item of its own."""
    n = len(runs)
    order = np.argsort(runs, kind="stable")
    sorted_ = runs[order]
    starts = np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]])) if n else np.zeros(0, np.int64)
    if len(starts) == n:
        return runs
    number = np.empty(n, np.uint64)
    number[order] = (np.arange(n) - np.repeat(starts, np.diff([*starts, n]))).astype(np.uint64)
    return runs | number << np.uint64(40)


def _mixed(runs: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    mixed = (runs ^ seeds) * _PRIME
    mixed ^= mixed >> np.uint64(29)
    return mixed * np.uint64(0xBF58476D1CE4E5B9)


def _hashed(start: np.ndarray, columns: np.ndarray) -> list[int]:
    """One number for each row of ``columns``, which tells their order."""
    value = start.copy()
    for column in columns.T:
        value = (value ^ column) * _PRIME
        value ^= value >> np.uint64(31)
    return value.view(np.int64).tolist()


def sketches(runs: np.ndarray) -> tuple[list[int], list[int]]:
    """Two sketches of a text: per component, the ``MINIMA`` least labelled runs under its hash, put together
    in the order of the text, and the same runs as a set.

    The order tells moved passages, and texts without repeated runs lose nothing by it: what an alignment
    matches stands in one order. Where a passage is repeated, an alignment may match its first occurrence
    with the other text's second, and the same labelled runs stand in another order; the sets are for these."""
    runs = labelled(runs)
    ordered: list[int] = []
    sets: list[int] = []
    step = max(1, (1 << 17) // max(1, len(runs)))
    for k in range(0, SKETCHES, step):
        seeds = _SEEDS[k : k + step, None]
        mixed = _mixed(runs, seeds)
        if mixed.shape[1] > MINIMA:
            places = np.sort(np.argpartition(mixed, MINIMA - 1, axis=1)[:, :MINIMA], axis=1)
        else:
            places = np.broadcast_to(np.arange(mixed.shape[1]), mixed.shape)
        ordered += _hashed(seeds[:, 0], runs[places])
        sets += _hashed(~seeds[:, 0], np.sort(np.take_along_axis(mixed, places, axis=1), axis=1))
    return ordered, sets


def repeats(runs: np.ndarray) -> bool:
    """Whether a run stands in a text more than once."""
    return len(np.unique(runs)) < len(runs)


def prefix(runs: np.ndarray) -> list[int]:
    """The first of a text's labelled runs in an order that is the same for all texts (that of a hash).

    Texts of the least similarity share that part of either's runs at least. If the first of one, as many
    as it may lack and one more, held none of the other's, too few would be left to share."""
    up, down = LEAST
    n = len(runs)
    first = np.sort(_mixed(labelled(runs), _ORDER))[: n + 1 - -(-up * n // down)]
    return first.view(np.int64).tolist()


def buckets(runs: np.ndarray) -> tuple[list[int], list[int]]:
    """The buckets of a text: those of its own, and those that count where a text with repeated runs has them too.

    Pairs with a text under ``FEW`` runs always share one, by their prefixes. Others share one by their sketches
    in text order or, where a run is repeated in either, by those sketches as sets."""
    up, down = LEAST
    n = len(runs)
    short = prefix(runs) if n and n * up < FEW * down else []
    if n < FEW:
        return short, []
    ordered, sets = sketches(runs)
    return (short + ordered + sets, []) if repeats(runs) else (short + ordered, sets)


def _prefix_hashes(runs: np.ndarray) -> np.ndarray:
    powers = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(len(runs), _PRIME)]))
    return np.concatenate([[np.uint64(0)], np.cumsum((runs * _PRIME ^ runs >> np.uint64(7)) * powers[:-1], dtype=np.uint64)]), powers


def gaps(a: np.ndarray, b: np.ndarray, most: int) -> int:
    """Least number of runs without a partner in an alignment of ``a`` and ``b``; ``most`` + 1 if more.

    With each gap the alignment reaches one diagonal further, so the band is as wide as gaps are allowed.
    All diagonals advance together; how far texts agree from two places comes from prefix hashes.
    """
    n, m = len(a), len(b)
    (hash_a, powers), (hash_b, more) = _prefix_hashes(a), _prefix_hashes(b)
    powers = powers if n > m else more

    def agree(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        low, high = np.zeros(len(x), np.int64), np.minimum(n - x, m - y)
        shift = y - x  # hashes of places apart are compared at the same power
        up, down = powers[np.maximum(shift, 0)], powers[np.maximum(-shift, 0)]
        while (open_ := low < high).any():
            middle = (low + high + 1) >> 1
            same = (hash_a[x + middle] - hash_a[x]) * up == (hash_b[y + middle] - hash_b[y]) * down
            low, high = np.where(open_ & same, middle, low), np.where(open_ & ~same, middle - 1, high)
        return low

    reach = np.full(2 * most + 5, -1, np.int64)  # furthest place in a, per diagonal
    middle = most + 2
    reach[middle + 1] = 0
    for d in range(most + 1):
        diagonals = np.arange(-d, d + 1, 2)
        x = np.maximum(reach[middle + diagonals - 1] + 1, reach[middle + diagonals + 1])
        if d == 0:
            x = np.zeros(1, np.int64)
        inside = (x <= n) & (x - diagonals <= m) & (x - diagonals >= 0)
        diagonals, x = diagonals[inside], x[inside]
        x = x + agree(x, x - diagonals)
        reach[middle + diagonals] = x
        if ((x >= n) & (x - diagonals >= m)).any():
            return d
    return most + 1


def aligned(a: np.ndarray, b: np.ndarray) -> int:
    """Runs that an alignment of two texts matches, at least as many as the least similarity asks, or 0.

    Similarity is L / (len(a) + len(b) - L) with L the longest common subsequence of the runs. Counts of
    common runs bound L from above; labelled runs in the order of both texts bound it from below, which
    settles nearly every pair; the banded alignment decides the others.
    """
    up, down = LEAST
    total = len(a) + len(b)
    enough = -(-up * total // (up + down))  # least L
    most = total - 2 * enough
    _, at, places = np.intersect1d(labelled(a), labelled(b), assume_unique=True, return_indices=True)
    if len(at) < enough or most < 0:
        return 0
    places = places[np.argsort(at)]
    ends: list[int] = []  # longest increasing subsequence of the places
    if (places[1:] > places[:-1]).all():
        return len(places)
    for x in places.tolist():
        k = bisect_left(ends, x)
        ends[k : k + 1] = [x]
    if len(ends) >= enough:
        return len(ends)
    found = gaps(a, b, most)
    return (total - found) // 2 if found <= most else 0


def _sketched(docs: DataFrame, kind: str) -> DataFrame:
    def run(batches):
        import xxhash

        for batch in by_size(batches, most=2 << 20):
            digests, counts, own, others = [], [], [], []
            for text in batch.column("text").to_pylist():
                words = words_of(text)
                runs = kmers(words)
                digests.append(xxhash.xxh3_128_digest(b" ".join(words)) if words else None)
                counts.append(len(runs))
                for kept, found in zip((own, others), buckets(runs)):
                    kept.append(found)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(digests, pa.binary()), pa.array(counts, pa.int64())]
                + [pa.array(x, pa.list_(pa.int64())) for x in (own, others)],
                ["doc_id", "digest", "n", "own", "others"],
            )

    return docs.mapInArrow(run, f"doc_id {kind}, digest binary, n long, own array<long>, others array<long>")


def _runs_of(docs: DataFrame, nodes: DataFrame, kind: str) -> DataFrame:
    """(node, runs) of the documents in ``nodes`` (digest, node)."""

    def run(batches):
        import xxhash

        for batch in by_size(batches, most=2 << 20):
            words = [words_of(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([xxhash.xxh3_128_digest(b" ".join(w)) if w else None for w in words], pa.binary()),
                    pa.array([kmers(w).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes() for w in words], pa.binary()),
                ],
                ["node", "digest", "runs"],
            )

    # One row per document: a null-free id with its digest is a key but for rows that repeat.
    found = docs.filter("doc_id is not null").mapInArrow(run, f"node {kind}, digest binary, runs binary")
    return found.join(nodes, ["digest", "node"], "left_semi").dropDuplicates(["node", "digest"]).select("node", "runs")


def _unpack(data: bytes) -> np.ndarray:
    """Runs from their 40 bits."""
    wide = np.zeros((len(data) // 5, 8), np.uint8)
    wide[:, :5] = np.frombuffer(data, np.uint8).reshape(-1, 5)
    return wide.view("<u8").ravel()


def _verified(pairs: DataFrame, runs: DataFrame, kind: str) -> DataFrame:
    """The pairs (a, b) whose alignment reaches the least similarity."""

    def run(batches):
        for batch in batches:
            keep = [
                aligned(_unpack(x), _unpack(y)) > 0
                for x, y in zip(batch.column("runs_a").to_pylist(), batch.column("runs_b").to_pylist())
            ]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    def of(end: str) -> DataFrame:
        wanted = pairs.select(F.col(end).alias("node")).distinct()
        return runs.join(wanted, "node", "left_semi").select(F.col("node").alias(end), F.col("runs").alias(f"runs_{end}"))

    joined = pairs.join(of("b"), "b").join(of("a"), "a").select("a", "b", "runs_a", "runs_b")
    return joined.mapInArrow(run, f"a {kind}, b {kind}")


def _near(x: str, y: str) -> Column:
    """Whether two counts of runs allow the least similarity."""
    up, down = LEAST
    return (F.col(x) * down >= F.col(y) * up) & (F.col(y) * down >= F.col(x) * up)


def _star(entries: DataFrame, turn: int) -> DataFrame:
    """Pairs (a, b) of each bucket's leader with the members of other classes.

    The first leaders are the nodes that share components with most others, such as the text that all of a
    group were made from; later ones are drawn anew for each bucket and turn."""
    if turn:
        order = F.xxhash64("node", "bucket", F.lit(turn))
    else:
        central = entries.groupBy("node").agg(F.sum("members").alias("met"))
        entries, order = entries.join(central, "node"), -F.col("met")
    leads = entries.groupBy("bucket").agg(F.min(F.struct(order.alias("o"), "node", "n", "label")).alias("l"))
    leads = leads.select("bucket", F.col("l.node").alias("lead"), F.col("l.n").alias("lead_n"), F.col("l.label").alias("lead_label"))
    pairs = entries.join(leads, "bucket").filter((F.col("label") != F.col("lead_label")) & _near("n", "lead_n"))
    return pairs.select(F.least("node", "lead").alias("a"), F.greatest("node", "lead").alias("b")).distinct()


def _open(entries: DataFrame, labels: DataFrame) -> DataFrame:
    """The entries of buckets that hold more than one class, with the class of each."""
    classed = entries.select("bucket", "node", "n").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    mixed = classed.groupBy("bucket").agg(F.min("label").alias("x"), F.max("label").alias("y")).filter("x <> y").select("bucket")
    return classed.join(mixed, "bucket", "left_semi").select("bucket", "node", "n", "label")


def _items(runs: DataFrame, nodes: DataFrame, kind: str) -> DataFrame:
    """(node, n, label, item): the labelled runs of the nodes, one row each."""

    def run(batches):
        for batch in batches:
            found = [labelled(_unpack(x)) for x in batch.column("runs").to_pylist()]
            at = np.repeat(np.arange(len(found)), [len(x) for x in found])
            kept = batch.select(["node", "n", "label"]).take(pa.array(at))
            yield kept.append_column("item", pa.array(np.concatenate([*found, np.zeros(0, np.uint64)]).view(np.int64)))

    return runs.join(nodes, "node").select("node", "n", "label", "runs").mapInArrow(run, f"node {kind}, n long, label {kind}, item long")


def _apart(entries: DataFrame, runs: DataFrame, kind: str) -> DataFrame:
    """All pairs of different classes that can reach the least similarity, among the nodes of mixed buckets.

    Two texts that do share more than four fifths of the longer one's runs, and so some of the rarest fifth
    of either, its head. Common runs outside both heads are no more than the longer rest, so the heads must
    share the others: an exact bound, which pairs that merely have a source or passage in common miss. The
    nodes of a run are a list, and the lists of a node's runs are counted in its task: pairs below the bound
    never become rows. Lists are cut at ``LIST`` nodes.
    """
    up, down = LEAST
    nodes = entries.select("node", "n", "label").distinct()
    items = stage_table(_items(runs, nodes, kind), "items")
    often = items.groupBy("item").agg(F.count("*").alias("df")).filter("df > 1")
    ranked = items.join(often, "item", "left").select("node", "n", "label", F.struct(F.coalesce("df", F.lit(1)).alias("df"), "item").alias("r"))
    own = ranked.groupBy("node", "n", "label").agg(F.array_sort(F.collect_list("r")).alias("own"))
    head = F.expr(f"slice(own, 1, cast(n - (n * {up} + {down - 1}) div {down} + 1 as int))")
    heads = own.select("node", "n", "label", F.explode(F.filter(head, lambda r: r["df"] > 1)).alias("r"))
    heads = stage_table(heads.select("node", "n", "label", F.col("r.item").alias("key"), F.col("r.df").alias("df")), "heads")
    mixed = heads.groupBy("key").agg(F.min("label").alias("first"), F.max("label").alias("last")).filter("first <> last")
    keys = stage_table(heads.join(mixed.select("key", "first"), "key"), "mixed")
    slot = F.pmod(F.xxhash64("node"), F.expr(f"df div {LIST} + 1"))
    lists = keys.groupBy("key", slot.alias("slot")).agg(F.collect_list("node").alias("others"), F.collect_list("n").alias("sizes"))
    left = keys.filter("label <> first").select("key", F.col("node").alias("x"), F.col("n").alias("x_n"))

    def count(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        others, place, shared = np.unique(np.concatenate(rows["others"].to_list()), return_index=True, return_counts=True)
        sizes, own_n = np.concatenate(rows["sizes"].to_list())[place], int(rows["x_n"].iloc[0])
        enough = -(-up * (sizes + own_n) // (up + down))
        rest = np.maximum(sizes, own_n) * up
        rest = -(-rest // down) - 1  # runs outside the longer text's head
        near = (sizes * down >= own_n * up) & (own_n * down >= sizes * up)
        found = others[near & (shared >= enough - rest) & (others != key[0])]
        return pd.DataFrame({"x": np.full(len(found), key[0]), "y": found})

    counted = left.join(lists, "key").groupBy("x").applyInPandas(count, f"x {kind}, y {kind}")
    pairs = counted.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    of = lambda end: nodes.select(F.col("node").alias(end), F.col("label").alias(f"{end}_label"))
    return pairs.join(of("a"), "a").join(of("b"), "b").filter("a_label <> b_label").select("a", "b")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id, class_size, kept.

    Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` with A-Z lower-cased. Texts of the same words are
    copies. Two texts are linked when their labelled five-word runs align with similarity 0.8 or more
    (see ``aligned``; equal to the Jaccard similarity of the runs unless passages change places).
    Candidates with a text under 20 runs come from an exact prefix filter, which misses none. Others agree
    in a component of an order MinHash sketch, the least labelled runs in text order: 24 components of 4
    minima miss a pair at 0.8 once in some 300,000 if texts are long, once in 100,000 at 20 runs, pairs above
    less. Where a run is repeated in one of two texts the order may differ though they align; there the same
    minima as sets, in buckets of their own, find as many. A class is a connected component of copies and links;
    class_id is its least id, class_size counts its rows, and the row with that id is kept.

    Copies count once. The members of a bucket are compared with one leader only, then, if they are still
    in different classes, with another: linear work, which joins large groups. What is left in buckets of
    several classes is compared by an exact filter (see ``_apart``), so no link among it is lost.

    Texts without words, null ones too, are linked to nothing and kept. Rows without an id are in a class
    only as copies; a class of such rows alone has a null class_id and keeps them all. Rows that share an
    id are one document, linked if any of its texts is. An empty table gives none. Extra columns are not
    read. Ids must be integers.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = stage_table(_sketched(picked, kind), "sketches")

    # One node per different sequence of words: the least id that has it.
    copies = stage_table(rows.filter("digest is not null").groupBy("digest").agg(F.min("doc_id").alias("node")), "copies")
    known = copies.filter("node is not null")
    heads = rows.join(known.withColumnRenamed("node", "doc_id"), ["digest", "doc_id"], "left_semi").dropDuplicates(["digest", "doc_id"])
    of = lambda c, own: F.transform(F.array_distinct(c), lambda b: F.struct(b.alias("bucket"), F.lit(own).alias("own")))
    entries = heads.select(F.col("doc_id").alias("node"), "n", F.explode(F.concat(of("own", True), of("others", False))).alias("e")).select("node", "n", "e.bucket", "e.own")
    shared = entries.groupBy("bucket").agg(F.count("*").alias("members"), F.max("own").alias("any")).filter("members > 1 and any").drop("any")
    entries = entries.drop("own")
    entries = stage_table(entries.join(shared, "bucket").withColumn("label", F.col("node")), "buckets")
    nodes = entries.select("node").distinct()
    runs = stage_table(_runs_of(picked, known.join(nodes, "node", "left_semi"), kind), "runs")

    # Leaders first: linear work joins large groups. What is still apart gets other leaders in the next turn.
    labels = None
    for turn in range(TURNS):
        links = stage_table(_verified(stage_table(_star(entries, turn), "star"), runs, kind), "verified")
        if turn and links.isEmpty():
            break
        if labels is not None:
            links = links.union(labels.select(F.col("node").alias("a"), F.col("label").alias("b")))
        labels = stage_table(components(links), "labels")
        entries = stage_table(_open(entries, labels), "open")
    # Then every pair of different classes.
    links = _verified(stage_table(_apart(entries, runs, kind), "apart"), runs, kind)
    labels = stage_table(components(links.union(labels.select(F.col("node").alias("a"), F.col("label").alias("b")))), "labels")

    # Rows that share an id share its class, whatever their texts.
    placed = copies.join(labels, "node", "left").select("digest", F.coalesce("label", "node").alias("class_id"))
    out = rows.select("doc_id", "digest").join(stage_table(placed, "placed"), "digest", "left")
    out = out.withColumn("class_id", F.coalesce("class_id", F.when(F.col("digest").isNull(), F.col("doc_id"))))
    sizes = stage_table(out.groupBy("class_id").agg(F.count("*").alias("class_size")), "sizes")
    out = stage_table(out, "classes").join(sizes, "class_id", "left")
    return out.select(
        "doc_id",
        "class_id",
        F.coalesce("class_size", F.lit(1)).alias("class_size"),
        (F.col("class_id").isNull() | F.col("doc_id").eqNullSafe(F.col("class_id"))).alias("kept"),
    )
