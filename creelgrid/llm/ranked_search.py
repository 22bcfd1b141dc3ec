"""Ranked search: documents in the order of bounds from hashed maxima, rescored exactly until none can enter."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from creelgrid.session import drop_stages, stage_table

from .base import map_arrow, words_of

#: Coordinates of a document's sketch, and documents whose sketches a task compares at once.
WIDTH, DOCUMENTS = 256, 2048
#: Bytes of queries that one pass over the documents answers.
BLOCK_BYTES = 1 << 20
#: Documents that are rescored for a query before the threshold is looked at again.
STEP = 64


def sketches(document: np.ndarray, place: np.ndarray, impact: np.ndarray, n: int, width: int = WIDTH) -> np.ndarray:
    """For each document the largest impact of a term at each coordinate, else 0."""
    out = np.zeros(n * width)
    cell = document * width + place
    order = np.argsort(cell, kind="stable")
    cell = cell[order]
    first = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1]))) if len(cell) else np.zeros(0, np.int64)
    if len(first):
        out[cell[first]] = np.maximum.reduceat(impact[order], first)
    return out.reshape(n, width)


class Ranking:
    """The ``top`` documents of each query among those shown so far."""

    def __init__(self, queries: list[list[int]], places: np.ndarray, top: int, width: int = WIDTH):
        self.queries = [np.array(q, np.int64) for q in queries]
        self.terms = len(places)
        self.places, self.top, self.width = places, top, width
        self.lookups = np.zeros((width, len(queries)))
        for i, q in enumerate(self.queries):
            np.add.at(self.lookups[:, i], places[q], 1.0)
        self.held = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in queries]  # scores, ids
        self.threshold = np.ones(len(queries))

    def show(self, ids: np.ndarray, document: np.ndarray, term: np.ndarray, impact: np.ndarray) -> None:
        """Documents ``ids`` with postings (number of the document, term, impact), sorted by document and term."""
        bounds = sketches(document, self.places[term], impact, len(ids), self.width) @ self.lookups
        keys = document * self.terms + term
        for q in np.flatnonzero((bounds >= self.threshold).any(0)).tolist():
            able = np.flatnonzero(bounds[:, q] >= self.threshold[q])
            able = able[np.argsort(-bounds[able, q], kind="stable")]
            wanted = self.queries[q]
            for i in range(0, len(able), STEP):
                part = able[i : i + STEP]
                if bounds[part[0], q] < self.threshold[q]:
                    break  # and so are all that follow
                cells = part[:, None] * self.terms + wanted[None, :]
                at = np.minimum(np.searchsorted(keys, cells), len(keys) - 1)
                self._add(q, np.where(keys[at] == cells, impact[at], 0).sum(1), ids[part])

    def _add(self, q: int, score: np.ndarray, ids: np.ndarray) -> None:
        some = score > 0
        score, ids = (np.concatenate(c) for c in zip(self.held[q], (score[some], ids[some])))
        order = np.lexsort((ids, -score))[: self.top]
        self.held[q] = score[order], ids[order]
        if len(order) == self.top:
            self.threshold[q] = score[order[-1]]

    def rows(self):
        for q, (score, ids) in enumerate(self.held):
            if len(ids):
                yield q, ids, score


def _postings(batches, vocabulary: dict[bytes, int]):
    """Of each document: id, number of its terms, and those of the vocabulary with their numbers."""
    known = vocabulary.keys()
    for batch in batches:
        sizes, terms, counts = [], [], []
        for text in batch.column("text").to_pylist():
            found = Counter(words_of(text))
            sizes.append(found.total())
            shared = sorted((vocabulary[w], found[w]) for w in found.keys() & known)
            terms.append([t for t, _ in shared])
            counts.append([c for _, c in shared])
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int64()))],
            ["doc_id", "n", "terms", "counts"],
        )


def weights(df: np.ndarray, documents: int) -> np.ndarray:
    """floor(1000 * ln((2N + 2) / (2df + 1))) in doubles."""
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)


def rank(
    docs: DataFrame,
    queries: DataFrame,
    top: int = 50,
    id_col: str = "doc_id",
    text_col: str = "text",
    query_col: str = "item_id",
    query_text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The ``top`` documents of each query with a score above 0: item_id, rank, doc_id, score.

    Terms are ``[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+`` of the whole text with A-Z lower-cased. A term's weight is
    w = floor(1000 * ln((2N + 2) / (2df + 1))), a document's length m = 50 + 50nN div L, its score the sum of
    w * (10^9 tf div (1000 tf + 20m)) over the query's different terms. N, L and df are over all documents
    with a term. Equal scores go by the smaller id.

    Queries are answered in blocks of about ``block_bytes`` of text, which are on the driver and broadcast. A
    pass over the documents writes their terms of the block's vocabulary; statistics are sums over that
    table. A document's sketch holds the largest impact at each of ``WIDTH`` hashed coordinates, so the sum of
    a query's coordinates bounds its score. Tasks rescore documents in descending order of the bound while
    it reaches the score of the ``top``-th.

    Null and empty texts have no terms, count in no statistic and are no result. Documents without an id
    count in the statistics and are not ranked; documents that repeat an id are ranked each. Ids are whole
    numbers. Queries without terms, or that no document shares a term with, give no rows; a query that repeats
    with its id and text is one; an id with different texts is ranked for each text. Empty tables give no
    rows; other columns are not read.
    """
    spark = docs.sparkSession
    kind = queries.schema[query_col].dataType.simpleString()
    asked = queries.select(F.col(query_col).alias("item"), F.col(query_text_col).alias("text")).filter("text is not null").distinct()
    total = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(total / block_bytes))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    out = None
    for b in range(blocks):
        own = asked.filter(F.pmod(F.xxhash64("text"), F.lit(blocks)) == b).collect()
        words = [sorted(set(words_of(r.text))) for r in own]
        vocabulary = {w: i for i, w in enumerate(sorted({w for q in words for w in q}))}
        if not vocabulary:
            continue
        postings = stage_table(map_arrow(texts, lambda batches, v=spark.sparkContext.broadcast(vocabulary): _postings(batches, v.value), "doc_id long, n long, terms array<int>, counts array<long>").filter("n > 0"), "postings")
        documents, length = postings.agg(F.count("*"), F.sum("n")).first()
        df = np.zeros(len(vocabulary), np.int64)
        for r in postings.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
            df[r["term"]] = r["count"]
        places = np.array([zlib.crc32(w) % WIDTH for w in vocabulary], np.int64)
        sent = spark.sparkContext.broadcast(([[vocabulary[w] for w in q] for q in words], places, weights(df, documents)))

        def run(batches, sent=sent, documents=documents, length=length):
            asked_terms, places, weight = sent.value
            ranking = Ranking(asked_terms, places, top)
            for batch in batches:
                for low in range(0, batch.num_rows, DOCUMENTS):
                    part = batch.slice(low, DOCUMENTS)
                    sizes = np.array(part.column("n").to_pylist(), dtype=object)
                    m = (50 + 50 * sizes * documents // length).astype(np.int64)
                    lists = part.column("terms")
                    number = np.diff(lists.offsets.to_numpy())
                    document = np.repeat(np.arange(part.num_rows), number)
                    term = lists.flatten().to_numpy().astype(np.int64)
                    tf = part.column("counts").flatten().to_numpy()
                    impact = weight[term] * (1_000_000_000 * tf // (1000 * tf + 20 * m[document]))
                    ranking.show(part.column("doc_id").to_numpy(), document, term, impact)
            for q, ids, score in ranking.rows():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(ids), q), pa.int32()), pa.array(ids), pa.array(score)], ["query", "doc_id", "score"]
                )

        able = postings.filter("doc_id is not null and size(terms) > 0")
        found = able.mapInArrow(run, "query int, doc_id long, score long")
        order = W.partitionBy("query").orderBy(F.desc("score"), "doc_id")
        best = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
        names = spark.createDataFrame([(i, r["item"]) for i, r in enumerate(own)], f"query int, item_id {kind}")
        best = stage_table(best.join(F.broadcast(names), "query").select("item_id", "rank", "doc_id", "score"), "ranked")
        drop_stages(spark, postings)
        out = best if out is None else out.unionByName(best)
    return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long") if out is None else out
