"""Benchmark windows in documents by multi-pattern search with block shifts (after Wu and Manber)."""

from __future__ import annotations

import math
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creelgrid.session import stage_table

from .base import map_arrow, remembers, words_of, working

#: Words of a window, and bytes of benchmark text whose windows one pass over the documents searches.
WINDOW, BLOCK_BYTES = 13, 2 << 20


class Windows:
    """Patterns of one length in words: block shifts, buckets by last and first block, direct comparison."""

    def __init__(self, patterns: dict[tuple[bytes, ...], set[str]], length: int):
        self.length, self.block = length, min(2, length)
        self.names = list(patterns.values())
        self.patterns = list(patterns)
        self.shift: dict[tuple[bytes, ...], int] = {}
        self.buckets: dict[tuple[bytes, ...], dict[tuple[bytes, ...], list[int]]] = {}
        size = self.block
        for k, words in enumerate(self.patterns):
            for end in range(size, length + 1):
                part = words[end - size : end]
                if self.shift.get(part, length) > length - end:
                    self.shift[part] = length - end
            self.buckets.setdefault(words[-size:], {}).setdefault(words[:size], []).append(k)

    def find(self, words: list[bytes]):
        """(first word, set of item names) of every occurrence."""
        length, size, n = self.length, self.block, len(words)
        skip, shift, buckets = length - size + 1, self.shift.get, self.buckets
        end = length
        while end <= n:
            part = tuple(words[end - size : end])
            jump = shift(part, skip)  # a block that no pattern holds is passed whole
            if jump:
                end += jump
                continue
            start = end - length
            for k in buckets[part].get(tuple(words[start : start + size]), ()):
                if self.patterns[k] == tuple(words[start:end]):
                    yield start, self.names[k]
            end += 1


class Benchmark:
    """The windows of some items, by length: ``window`` words, or a whole shorter item."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int = WINDOW):
        by_length: dict[int, dict[tuple[bytes, ...], set[str]]] = {}
        for name, text in items:
            words = tuple(words_of(text))
            length = min(window, len(words))
            for start in range(len(words) - length + 1 if length else 0):
                by_length.setdefault(length, {}).setdefault(words[start : start + length], set()).add(name or "")
        self.searches = [Windows(patterns, length) for length, patterns in sorted(by_length.items())]

    def search(self, words: list[bytes], hit: bytearray) -> set[str]:
        """Marks the words that lie in a window and returns the names of the items found."""
        names: set[str] = set()
        for search in self.searches:
            mark = b"\x01" * search.length
            for start, found in search.find(words):
                hit[start : start + search.length] = mark
                names |= found
        return names


def _spans(hit: bytearray) -> list[int]:
    """First and last word of each run of marked words, alternating."""
    out, at = [], hit.find(1)
    while at >= 0:
        end = hit.find(0, at)
        end = len(hit) if end < 0 else end
        out += [at, end - 1]
        at = hit.find(1, end)
    return out


_built: dict[str, Benchmark] = {}  # the block that this worker searches now
remembers("decontaminate", _built.clear)


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    extra: tuple[str, ...] = (),
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, items (array), spans (array), contaminated,
    and the columns ``extra`` as they are (names of the result may not be among them).

    Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` with A-Z lower-cased. A window is ``window``
    consecutive words of an item, or the whole of a shorter one; a document word inside an occurrence of a
    window is hit. Contaminated: n_hit > 0 and 20 * n_hit >= n_words. ``spans`` lists the first and last
    word of each run of hit words, alternating.

    The benchmark is searched in blocks of about ``block_bytes`` of text, one pass over the documents for
    each; only one block is on the driver and broadcast at a time, and between passes the documents and
    what was found in them are a written table. Null and empty texts have no words and are clean; items
    without words match nothing; items of one id count once, a null id counts as the empty name; rows that
    repeat stay; either table may be empty; other columns are not read.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(total / block_bytes))
    kind = docs.schema[id_col].dataType.simpleString()
    state = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(text_col).alias("text"),
        F.lit(0).cast("long").alias("n_words"),
        F.array().cast("array<int>").alias("spans"),
        F.array().cast("array<string>").alias("items"),
        *extra,
    )
    carried = "".join(f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in extra)
    for k in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k).collect()
        sent = spark.sparkContext.broadcast([(r.item, r.text) for r in rows])
        last, name = k == blocks - 1, uuid.uuid4().hex

        def run(batches, sent=sent, last=last, name=name):
            working("decontaminate")
            if name not in _built:
                _built.clear()
                _built[name] = Benchmark(sent.value, window)
            search = _built[name].search
            for batch in batches:
                counts, spans, names = [], [], []
                columns = (batch.column(c).to_pylist() for c in ("text", "spans", "items"))
                for text, old, known in zip(*columns):
                    words = words_of(text)
                    hit = bytearray(len(words))
                    for a, b in zip(old[::2], old[1::2]):
                        hit[a : b + 1] = b"\x01" * (b + 1 - a)
                    names.append(sorted({*known, *search(words, hit)}))
                    counts.append(len(words))
                    spans.append(_spans(hit))
                text = pa.nulls(batch.num_rows, pa.string()) if last else batch.column("text")
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), text, pa.array(counts, pa.int64()), pa.array(spans, pa.list_(pa.int32())), pa.array(names, pa.list_(pa.string())), *(batch.column(c) for c in extra)],
                    ["doc_id", "text", "n_words", "spans", "items", *extra],
                )

        state = map_arrow(state, run, f"doc_id {kind}, text string, n_words long, spans array<int>, items array<string>{carried}")
        if not last:
            state = stage_table(state, "searched")
    signed = F.transform("spans", lambda x, i: F.when(i % 2 == 0, -x).otherwise(x + 1))
    n_hit = F.aggregate(signed, F.lit(0).cast("long"), lambda total, x: total + x)
    state = state.withColumn("n_hit", n_hit)
    return state.select("doc_id", "n_words", "n_hit", "items", "spans", contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"), *extra)


def contaminated(n_hit: Column, n_words: Column) -> Column:
    return (n_hit > 0) & (20 * n_hit >= n_words)
