"""Scores by a hierarchical Pitman-Yor model of word pairs, seated one by one anew in each sweep on the executors.

A restaurant stands for the word before (or the begin of a text); its customers are the words that follow
there in the training texts, and each of its tables sends one customer to the parent restaurant, which all
share. The base of the parent is uniform over the training vocabulary and one unseen word. Probabilities
are averaged over the sweeps after the first.

Pairs are dealt to buckets by their first word (pairs of very frequent first words by both), and words to
word buckets by hash. A bucket's pairs, with the documents that hold them, are one row of a bucketed table.
Per sweep the buckets send the tables of each word to its word bucket, which seats the parent's customers
and answers; nothing but sums per bucket and the few frequent words ever come to the driver.
"""

from __future__ import annotations

import math
import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creelgrid.session import drop_stages, stage_table

from .base import by_size, remembers, working

#: Sweeps, and the first of them that are not averaged; concentration of all restaurants; text bytes whose
#: pairs make a bucket; documents that are sampled to find frequent words (which only routes their pairs),
#: the share of the tokens that makes a word frequent, and so at most 1 / HOT_SHARE words.
SWEEPS, BURN, CONCENTRATION, BUCKET_BYTES, HOT_SAMPLE, HOT_SHARE = 3, 1, 1.0, 8 << 20, 2000, 0.002
HOT = ("word", "customers", "tables")
#: Entries of a bucket, each a pair in a document, that are added up at once.
STRETCH = 1 << 17
BEGIN, END = np.uint64(1), np.uint64(2)  # instead of word hashes

_MIX = np.uint64(0x9E3779B97F4A7C15)
_known: dict[bytes, int] = {}
remembers("pitman_yor", _known.clear)
SEATING = "pitman_yor_seating"  # the steps after the texts are read need no word any more


def tokens_of(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, in UTF-8."""
    return (text or "").encode("utf-8", "replace").lower().split()


def hashes_of(words: list[bytes]) -> np.ndarray:
    import xxhash

    working("pitman_yor")
    if len(_known) > 300_000:
        _known.clear()
    _known.update([(w, xxhash.xxh64_intdigest(w) >> 8) for w in set(words) if w not in _known])
    return np.fromiter(map(_known.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    x = x * _MIX
    x = x ^ (x >> np.uint64(32))
    return x * _MIX ^ (x >> np.uint64(29))


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed value: bytes of equal weight stand together, sorted 64-bit ones as steps."""
    out = []
    for a in arrays:
        steps = a.dtype == np.uint64 and len(a) > 1 and bool((a[1:] >= a[:-1]).all())
        if steps:
            a = np.diff(a, prepend=a.dtype.type(0))
        planes = np.ascontiguousarray(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), -1).T) if len(a) else np.zeros(0, np.uint8)
        out.append(pa.compress(planes.tobytes() or b"\0", codec="zstd", asbytes=True))
        out[-1] = f"{a.dtype.str} {len(a)} {int(steps)} {len(out[-1])}\n".encode() + out[-1]
    return b"".join(out)


def unpack(data: bytes, most: int | None = None) -> list[np.ndarray]:
    """All arrays of a value, or the first ``most``."""
    out, at = [], 0
    while at < len(data) and len(out) != most:
        end = data.index(b"\n", at)
        kind, n, steps, size = data[at:end].decode().split()
        kind, n, size = np.dtype(kind), int(n), int(size)
        at = end + 1 + size
        raw = pa.decompress(data[end + 1 : at], max(1, n * kind.itemsize), codec="zstd", asbytes=True)
        a = np.frombuffer(raw, np.uint8, n * kind.itemsize).reshape(kind.itemsize, n).T.copy().view(kind).ravel() if n else np.zeros(0, kind)
        out.append(np.cumsum(a, dtype=kind) if int(steps) else a)
    return out


def least_type(a: np.ndarray) -> np.ndarray:
    """Whole numbers in the narrowest unsigned type."""
    top = int(a.max()) if len(a) else 0
    return a.astype(np.uint8 if top < 256 else np.uint16 if top < 1 << 16 else np.uint32 if top < 1 << 32 else np.uint64)


def seat(customers: np.ndarray, opening: np.ndarray, discount: float, random: np.random.Generator) -> np.ndarray:
    """Tables of one dish after all its customers sat down one by one, for many dishes at once.

    The first opens a table. Of the next, the j-th customer opens one with weight ``opening`` against
    j - discount * tables for the tables there; ``opening`` is (concentration + discount * all tables) *
    parent probability. From the 64th on customers sit down in groups of a sixteenth of those seated, each
    group with one binomial draw.
    """
    tables = np.minimum(customers, 1).astype(np.float64)
    live = np.flatnonzero(customers > 1)
    seated = 1
    while live.size:
        group = 1 if seated < 64 else seated // 16
        new = opening[live]
        chance = new / (new + np.maximum(seated - discount * tables[live], 1e-12))
        here = np.minimum(customers[live] - seated, group)
        tables[live] += (random.random(len(live)) < chance) if group == 1 else random.binomial(here.astype(np.int64), chance)
        seated += group
        live = live[customers[live] > seated]
    return tables


def _discount(ones: float, twos: float) -> float:
    """From how many have one customer and how many two (Kneser and Ney's estimate)."""
    return min(max(ones / max(ones + 2 * twos, 1), 0.05), 0.95) if ones else 0.5


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Where rows differ from the row before, the first included."""
    n = len(keys[0])
    new = np.zeros(n, bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def _pairs(batches, buckets: int, hot: np.ndarray, partition: int, id_type: pa.DataType):
    """Per slice of documents, its pairs for each bucket and one row that names the documents."""
    for k, batch in enumerate(by_size(batches)):
        chunk = f"{partition}-{k}"
        texts = [tokens_of(t) for t in batch.column("text").to_pylist()]
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        words = hashes_of([w for t in texts for w in t])
        del texts
        doc = np.repeat(np.arange(len(sizes), dtype=np.uint32), sizes + 1)
        starts = np.cumsum(sizes + 1) - (sizes + 1)
        second = np.empty(len(doc), np.uint64)
        inner = np.ones(len(doc), bool)
        inner[starts + sizes] = False
        second[inner], second[~inner] = words, END
        del words, inner
        first = np.concatenate([[BEGIN], second[:-1]]).astype(np.uint64)
        first[starts] = BEGIN
        train = batch.column("train").to_numpy(zero_copy_only=False).astype(bool)
        often = np.isin(first, hot)
        bucket = (np.where(often, mixed(first ^ mixed(second)), mixed(first)) % np.uint64(buckets)).astype(np.uint32)
        order = np.lexsort((doc, second, first, bucket))
        bucket, first, second, doc = bucket[order], first[order], second[order], doc[order]
        at = _runs(bucket, first, second, doc)
        times = np.diff(at, append=len(bucket)).astype(np.uint32)
        bucket, first, second, doc = bucket[at], first[at], second[at], doc[at]
        marked = times << 1 | train[doc].astype(np.uint32)
        cuts = _runs(bucket)
        out: dict[str, list] = {"bucket": [], "body": []}
        for a, b in zip(cuts, [*cuts[1:], len(bucket)]):
            heads = _runs(first[a:b])
            dishes, which = np.unique(second[a:b], return_inverse=True)
            out["bucket"].append(int(bucket[a]))
            out["body"].append(pack(first[a:b][heads], least_type(np.diff(heads, append=b - a)), dishes, least_type(which), least_type(doc[a:b]), least_type(marked[a:b])))
        n = len(out["bucket"])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([*out["bucket"], (partition + k) % buckets], pa.int64()),
                pa.array([chunk] * (n + 1)),
                pa.array([*out["body"], None], pa.binary()),
                pa.array([None] * n + [batch.column("doc_id").to_pylist()], pa.list_(id_type)),
                pa.array([None] * n + [train.tolist()], pa.list_(pa.bool_())),
                pa.array([None] * n + [(sizes + 1).tolist()], pa.list_(pa.int64())),
            ],
            ["bucket", "chunk", "body", "ids", "train", "n_tokens"],
        )


class Bucket:
    """The pairs of a bucket: rows sorted by first and second word, each with the documents that hold it."""

    FIELDS = ("first", "per_first", "dishes", "which", "customers", "per_pair", "chunk", "doc", "times")

    def __init__(self, *arrays: np.ndarray):
        for name, a in zip(self.FIELDS, arrays):
            setattr(self, name, a)

    @classmethod
    def merged(cls, bodies: list[bytes], chunks: np.ndarray) -> Bucket:
        """From the bodies that slices sent; ``chunks`` numbers their slices."""
        chunks = least_type(np.asarray(chunks))
        words = [unpack(b, 3) for b in bodies]
        first, dishes = (np.unique(np.concatenate([w[i] for w in words])) for i in (0, 2))
        del words
        key, chunk, doc, marked = [], [], [], []  # key: the places of both words
        for body, number in zip(bodies, chunks):
            heads, per, own, which, docs, marks = unpack(body)
            ahead = np.repeat(np.searchsorted(first, heads).astype(np.uint64) * np.uint64(len(dishes)), per.astype(np.int64))
            key.append(ahead + np.searchsorted(dishes, own).astype(np.uint64)[which])
            chunk.append(np.full(len(docs), number, chunks.dtype)), doc.append(docs), marked.append(marks)
        key = np.concatenate(key)
        order = np.argsort(key, kind="stable")
        key = key[order]
        pair = _runs(key)
        heads, which = np.divmod(key[pair], np.uint64(len(dishes)))
        del key
        chunk, doc = np.concatenate(chunk)[order], np.concatenate(doc)[order]
        marked = np.concatenate(marked)[order]
        n = len(order)
        del order
        times = marked >> 1
        customers = np.add.reduceat(times * (marked & 1), pair, dtype=np.int64)
        return cls(first, np.diff(_runs(heads), append=len(pair)), dishes, which, customers, np.diff(pair, append=n), chunk, doc, times)

    def pack(self) -> bytes:
        return pack(self.first, least_type(self.per_first), self.dishes, *(least_type(getattr(self, n)) for n in self.FIELDS[3:]))

    @classmethod
    def unpack(cls, body: bytes, documents: bool = True) -> Bucket:
        """Without ``documents`` the pairs and their customers alone. What is held of each document stays narrow."""
        first, per, dishes, which, customers, *rest = unpack(body, None if documents else 5)
        return cls(first, per.astype(np.int64), dishes, which.astype(np.int64), customers.astype(np.int64), *rest)

    def restaurants(self) -> np.ndarray:
        """Of each pair, the place of its first word."""
        return np.repeat(np.arange(len(self.first)), self.per_first)

    def totals(self, per_pair: np.ndarray) -> np.ndarray:
        return np.bincount(self.restaurants(), per_pair, minlength=len(self.first))

    def by_document(self, *values: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """Slice, document and, for each array of values of the pairs, the sum over the document's pairs."""
        n = len(self.doc)
        wide = int(self.doc.max()) + 1
        kind = np.uint32 if (int(self.chunk.max()) + 1) * wide < 1 << 32 else np.uint64
        key = self.chunk.astype(kind) * kind(wide) + self.doc.astype(kind)
        order = np.argsort(key, kind="stable")
        key = key[order]
        at = _runs(key)
        chunk, doc = np.divmod(key[at], kind(wide))
        del key
        place = np.empty(n, np.uint32)
        place[order] = np.repeat(np.arange(len(at), dtype=np.uint32), np.diff(at, append=n))
        del order
        pair = np.repeat(np.arange(len(self.per_pair), dtype=np.uint32), self.per_pair)
        sums = [np.zeros(len(at)) for _ in values]
        for a in range(0, n, STRETCH):
            here = slice(a, a + STRETCH)
            for held, value in zip(sums, values):
                held += np.bincount(place[here], value[pair[here]] * self.times[here], minlength=len(at))
        return chunk, doc, sums

    def seated(self, parent: np.ndarray | None, hot: dict, discount: float, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(tables of each pair, customers and tables of each restaurant). Without parent probabilities
        every pair has one table. A frequent word's restaurant stands in several buckets; its totals are
        those that all buckets had together in the sweep before."""
        owner = self.restaurants()
        tables = np.minimum(self.customers, 1).astype(np.float64)
        customers, all_tables = self.totals(self.customers), self.totals(tables)
        wide = {i: hot[int(w)] for i, w in enumerate(self.first.tolist()) if w in hot}
        for i, (c, t) in wide.items():
            customers[i], all_tables[i] = c, t
        if parent is not None:
            random = np.random.default_rng(seed)
            many = np.flatnonzero(self.customers > 1)
            for _ in range(2):  # the tables of the restaurant that the first round used are prior ones
                opening = (CONCENTRATION + discount * all_tables[owner[many]]) * parent[self.which[many]]
                tables[many] = seat(self.customers[many], opening, discount, random)
                all_tables = self.totals(tables)
                for i, (_, t) in wide.items():
                    all_tables[i] = t
        return tables, customers, all_tables


def _by_word_bucket(dishes: np.ndarray, buckets: int) -> list[tuple[int, np.ndarray]]:
    """(word bucket, places in ``dishes`` of its words) for each; the same order when sent and answered."""
    to = (mixed(dishes) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(to, kind="stable")
    cuts = _runs(to[order])
    return [(int(to[order[a]]), order[a:b]) for a, b in zip(cuts, [*cuts[1:], len(order)])]


def _answers(parts: list | None, dishes: np.ndarray, sweep: dict) -> np.ndarray:
    """Parent probabilities of ``dishes`` from what the word buckets sent back for one sweep."""
    held = np.zeros(len(dishes))
    values = {p["word_bucket"]: p["answer"] for p in parts or ()}
    for number, places in _by_word_bucket(dishes, sweep["buckets"]):
        held[places] = unpack(values[number])[0]
    return (held + sweep["back"] / sweep["words"]) / sweep["scale"]


def score(
    docs: DataFrame, train_col: str = "train", id_col: str = "doc_id", text_col: str = "text", sweeps: int = SWEEPS, burn: int = BURN, bucket_bytes: int = BUCKET_BYTES
) -> DataFrame:
    """One row per row of ``docs``: doc_id, train, n_tokens, n_known, train_tokens, base_score, score.

    ``docs`` marks in ``train_col`` the rows whose texts the model learns; all rows are scored. Tokens are
    words and one end. base_score is the sum over tokens of log10((c + 0.1) / (N + 0.1 * (V + 1))), score
    the model's log10 probability of the text, and n_known the number of its tokens with c > 0. All
    counts are over all training rows.

    Null and empty texts are the end alone. Rows that repeat are scored each, and count each time they
    train; a null mark does not train; null ids stay. Without training rows the base and the model are
    uniform over the one unseen word. An empty table gives none. Other columns are not read. Words are
    told apart by 56-bit hashes.
    """
    spark = docs.sparkSession
    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.coalesce(F.col(train_col), F.lit(False)).alias("train"))
    kind = picked.schema["doc_id"].dataType.simpleString()
    id_type = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]
    size = picked.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    buckets = max(1, math.ceil((size.bytes or 0) / bucket_bytes))
    hot_words = _frequent(picked, size.n)
    seed = 20

    def pairs(batches):
        from pyspark import TaskContext

        yield from _pairs(batches, buckets, hot_words, TaskContext.get().partitionId(), id_type)

    def merge(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        working(SEATING)
        bodies = rows[rows.body.notna()].sort_values("chunk")
        names = rows[rows.body.isna()]
        out = [(key[0], r.chunk, None, r.ids, r.train, r.n_tokens, None, None, None) for r in names.itertuples()]
        if len(bodies):
            chunks = bodies.chunk.drop_duplicates().tolist()
            number = {c: i for i, c in enumerate(chunks)}
            own = Bucket.merged(bodies.body.tolist(), bodies.chunk.map(number).to_numpy())
            often = np.isin(own.first, hot_words)
            customers, tables = own.totals(own.customers), own.totals(np.minimum(own.customers, 1))
            stats = [(~often & (customers > 0)).sum(), customers[~often].sum(), (own.customers == 1).sum(), (own.customers == 2).sum()]
            hot = zip(own.first[often].view(np.int64).tolist(), customers[often].tolist(), tables[often].tolist())
            out.append((key[0], None, own.pack(), None, None, None, chunks, [float(x) for x in stats], [dict(zip(HOT, h)) for h in hot]))
        return pd.DataFrame(out, columns=["bucket", "chunk", "body", "ids", "train", "n_tokens", "chunks", "stats", "hot"], dtype=object)

    dealt = picked.mapInArrow(pairs, f"bucket long, chunk string, body binary, ids array<{kind}>, train array<boolean>, n_tokens array<long>")
    hot_kind = "array<struct<word:long,customers:double,tables:double>>"
    merged = dealt.groupBy("bucket").applyInPandas(
        merge, f"bucket long, chunk string, body binary, ids array<{kind}>, train array<boolean>, n_tokens array<long>, chunks array<string>, stats array<double>, hot {hot_kind}"
    )
    state, name = _bucketed(merged, buckets)
    names = state.filter("body is null")
    state = state.filter("body is not null").select("bucket", "body", "chunks", "stats", "hot")

    sums = state.select(*(F.sum(F.col("stats")[i]).alias(k) for i, k in enumerate(("known", "tokens", "ones", "twos")))).first().asDict()
    hot = _hot_totals(state.select("hot"))
    trained = hot.get(int(BEGIN), (0.0, 0.0))[0]
    counts = {w: c for w, (c, _) in hot.items() if w != int(BEGIN) and c > 0}
    vocabulary = sums["known"] + len(counts) + (trained > 0) if sums["known"] is not None else 0
    total = (sums["tokens"] or 0) + sum(counts.values()) + trained
    discount = _discount(sums["ones"] or 0, sums["twos"] or 0)
    base = {"total": total, "words": vocabulary + 1, "end": trained, "counts": counts}

    past: list[dict] = []
    for sweep in range(sweeps):
        last = past[-1] if past else None
        sent = state.join(last["answers"], "bucket", "left") if last else state.withColumn("parts", F.lit(None).cast("array<struct<word_bucket:long,answer:binary>>"))
        messages = _send(sent.select("bucket", "body", "parts"), last, hot, discount, seed + sweep, buckets, hot_words)
        messages = stage_table(messages, "tables")
        hot = _hot_totals(messages.select("hot")) or hot
        if last and sweep - 1 < burn:
            drop_stages(spark, last["table"])  # not averaged, and seated upon by now
        past.append(_parent(messages.filter("words is not null").select("word_bucket", "bucket", "words"), buckets, vocabulary + 1, last, seed + sweep))
        drop_stages(spark, messages)

    used = past[burn:] or past
    final = state.select("bucket", "body", "chunks")
    for i, sweep in enumerate(used):
        final = final.join(sweep["answers"].withColumnRenamed("parts", f"parts{i}"), "bucket", "left")
    scores = _document_sums(final, used, hot, discount, base, seed)
    out = _by_document(scores, names, kind, base)
    out = stage_table(out, "scores")
    spark.sql(f"drop table if exists {name}")
    return out


def _frequent(docs: DataFrame, n: int) -> np.ndarray:
    """Hashes of words that make up ``HOT_SHARE`` of the tokens of about ``HOT_SAMPLE`` documents, and the
    begin. They only decide where pairs are dealt to."""

    def run(batches):
        for batch in by_size(batches):
            words, times = np.unique(hashes_of([w for t in batch.column("text").to_pylist() for w in tokens_of(t)]), return_counts=True)
            top = np.argsort(-times)[: int(2 / HOT_SHARE)]
            yield pa.RecordBatch.from_arrays([pa.array(words[top].view(np.int64)), pa.array(times[top].astype(np.int64)), pa.array(np.full(len(top), times.sum(), np.int64))], ["word", "n", "of"])

    rate = min(1.0, HOT_SAMPLE / max(n, 1))
    some = docs.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) < rate * (1 << 20))
    found = some.mapInArrow(run, "word long, n long, of long").groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(int(1 / HOT_SHARE)).toPandas()
    often = found[found.n >= HOT_SHARE * max(found.n.sum(), 1)].word.to_numpy(np.int64).view(np.uint64)
    return np.concatenate([often, [BEGIN]]).astype(np.uint64)


def _bucketed(rows: DataFrame, buckets: int) -> tuple[DataFrame, str]:
    """A table in the warehouse whose rows join by bucket without a shuffle."""
    name = f"pairs_{uuid.uuid4().hex}"
    rows.write.bucketBy(min(buckets, 4096), "bucket").saveAsTable(name, format="parquet")
    return rows.sparkSession.table(name), name


def _hot_totals(hot: DataFrame) -> dict[int, tuple[float, float]]:
    """Customers and tables of the frequent restaurants over all buckets; at most 1 / HOT_SHARE + 1 rows."""
    rows = hot.select(F.explode("hot").alias("h")).groupBy("h.word").agg(F.sum("h.customers").alias("c"), F.sum("h.tables").alias("t")).collect()
    return {int(np.int64(r.word).view(np.uint64)): (r.c, r.t) for r in rows}


def _send(state: DataFrame, last: dict | None, hot: dict, discount: float, seed: int, buckets: int, hot_words: np.ndarray) -> DataFrame:
    """Seat every bucket and send the tables of each second word to its word bucket."""
    sweep = {k: last[k] for k in ("back", "words", "scale", "buckets")} if last else None

    def run(batches):
        working(SEATING)
        for batch in batches:
            for number, body, parts in zip(*(batch.column(c).to_pylist() for c in ("bucket", "body", "parts"))):
                own = Bucket.unpack(body, documents=False)
                parent = _answers(parts, own.dishes, sweep) if sweep else None
                tables, customers, _ = own.seated(parent, hot, discount, seed * 1_000_003 + number)
                sent = np.bincount(own.which, tables, minlength=len(own.dishes)).astype(np.int64)
                wide = np.isin(own.first, hot_words)
                mine = own.totals(own.customers)
                here = own.totals(tables)
                totals = [{"word": int(w), "customers": float(c), "tables": float(t)} for w, c, t in zip(own.first[wide].view(np.int64), mine[wide], here[wide])]
                rows = [(k, pack(own.dishes[at], least_type(sent[at]))) for k, at in _by_word_bucket(own.dishes, buckets)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows] + [None], pa.int64()), pa.array([number] * (len(rows) + 1), pa.int64()), pa.array([r[1] for r in rows] + [None], pa.binary()), pa.array([None] * len(rows) + [totals], hot_type)],
                    ["word_bucket", "bucket", "words", "hot"],
                )

    hot_type = pa.list_(pa.struct([("word", pa.int64()), ("customers", pa.float64()), ("tables", pa.float64())]))
    return state.mapInArrow(run, "word_bucket long, bucket long, words binary, hot array<struct<word:long,customers:double,tables:double>>")


def _parent(messages: DataFrame, buckets: int, words: float, last: dict | None, seed: int) -> dict:
    """Seat the parent's customers by word and answer every bucket; with the sums its probabilities need."""
    # Before the first sweep: every word at one table, and a discount like that of small counts.
    tables_before, discount = (last["tables"], last["discount"]) if last else (words, 0.5)

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        working(SEATING)
        parts = [unpack(x) for x in rows.words]
        dishes, which = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        customers = np.bincount(which, np.concatenate([p[1] for p in parts]).astype(float), minlength=len(dishes)).astype(np.int64)
        opening = np.full(len(dishes), (CONCENTRATION + discount * tables_before) / words)
        tables = seat(customers, opening, discount, np.random.default_rng(seed * 1_000_033 + int(key[0])))
        held = np.where(customers > 0, customers - discount * tables, 0).astype(np.float32)
        answers = [pack(held[np.searchsorted(dishes, p[0])]) for p in parts]
        sums = [float(customers.sum()), float(tables.sum()), float((customers == 1).sum()), float((customers == 2).sum())]
        out = [(b, key[0], a, None if i else sums) for i, (b, a) in enumerate(zip(rows.bucket, answers))]
        return pd.DataFrame(out, columns=["bucket", "word_bucket", "answer", "sums"], dtype=object)

    schema = "bucket long, word_bucket long, answer binary, sums array<double>"
    answers = stage_table(messages.groupBy("word_bucket").applyInPandas(run, schema), "parents")
    sums = [x or 0.0 for x in answers.select(*(F.sum(F.col("sums")[i]) for i in range(4))).first()]
    customers, tables, ones, twos = sums
    return {
        "answers": answers.groupBy("bucket").agg(F.collect_list(F.struct("word_bucket", "answer")).alias("parts")),
        "table": answers, "buckets": buckets,
        "back": CONCENTRATION + discount * tables, "scale": CONCENTRATION + customers, "words": words,
        "tables": tables, "discount": _discount(ones, twos) if last is None else discount,
    }


def _document_sums(state: DataFrame, used: list[dict], hot: dict, discount: float, base: dict, seed: int) -> DataFrame:
    """Of each bucket and slice, what its pairs add to each document: known tokens, base score, score."""
    sweeps = [{k: s[k] for k in ("back", "words", "scale", "buckets")} for s in used]

    def run(batches):
        working(SEATING)
        for batch in batches:
            parts = zip(*(batch.column(f"parts{i}").to_pylist() for i in range(len(sweeps))))
            for number, body, chunks, answers in zip(*(batch.column(c).to_pylist() for c in ("bucket", "body", "chunks")), parts):
                own = Bucket.unpack(body)
                owner = own.restaurants()
                chance = np.zeros(len(owner))
                for i, (sweep, part) in enumerate(zip(sweeps, answers)):
                    parent = _answers(part, own.dishes, sweep)
                    tables, customers, all_tables = own.seated(parent, hot, discount, (seed + i + 101) * 1_000_003 + number)
                    up = (CONCENTRATION + discount * all_tables[owner]) * parent[own.which]
                    chance += (np.maximum(own.customers - discount * tables, 0) * (own.customers > 0) + up) / (CONCENTRATION + customers[owner])
                model = np.log10(chance / len(sweeps))
                count = own.totals(own.customers)
                for i, w in enumerate(own.first.tolist()):
                    if w in base["counts"]:
                        count[i] = base["counts"][w]
                plain = np.log10((count + 0.1) / (base["total"] + 0.1 * base["words"]))
                begin = own.first == BEGIN
                plain[begin], count[begin] = 0, 0
                chunk, doc, (known, plain, model) = own.by_document((count > 0)[owner], plain[owner], model)
                known = known.astype(np.int64)
                cuts = _runs(chunk)
                rows = [
                    (chunks[chunk[a]], pack(least_type(doc[a:b]), least_type(known[a:b]), plain[a:b], model[a:b].astype(np.float32)))
                    for a, b in zip(cuts, [*cuts[1:], len(chunk)])
                ]
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.binary())], ["chunk", "body"])

    return state.mapInArrow(run, "chunk string, body binary")


def _by_document(sums: DataFrame, names: DataFrame, kind: str, base: dict) -> DataFrame:
    """Add up the sums of all buckets for the documents of each slice."""
    end = math.log10((base["end"] + 0.1) / (base["total"] + 0.1 * base["words"]))

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        own = rows[rows.body.isna()].iloc[0]
        n = len(own.ids)
        known, plain, model = np.full(n, int(base["end"] > 0)), np.full(n, end), np.zeros(n)
        for body in rows.body[rows.body.notna()]:
            doc, k, p, m = unpack(body)
            known[doc] += k
            plain[doc] += p
            model[doc] += m
        return pd.DataFrame({"doc_id": pd.Series(list(own.ids), dtype=object), "train": own.train, "n_tokens": own.n_tokens, "n_known": known, "train_tokens": int(base["total"]), "base_score": plain, "score": model})

    both = names.select("chunk", "body", "ids", "train", "n_tokens").unionByName(sums, allowMissingColumns=True)
    return both.groupBy("chunk").applyInPandas(run, f"doc_id {kind}, train boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
