"""Language of a text from bit-sliced Bloom filters: one probe gives every language that holds an n-gram."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import by_size, remembers, working

#: Characters of an n-gram; rows and probes of the filter; n-grams that it takes at most; labelled rows
#: that a language gives to the training sample (expected number); the share of the best language's
#: document rate from which a language holds an n-gram; documents of it that must have the n-gram.
N, ROWS, PROBES, GRAMS, SAMPLE, SHARE, LEAST_DOCS = 4, 1 << 20, 4, 1 << 17, 2000, 0.25, 3
UNKNOWN = "und"

_STEP_BYTES = 1 << 20
_letter: np.ndarray | None = None


def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    global _letter
    if _letter is None:
        _letter = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _letter


def grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of each n-gram, its text's place in the list, whether each text has a letter).

    Texts are lower-cased; a run of other characters than letters is one blank, and two blanks stand at
    either end, so that every text with a letter has an n-gram.
    """
    joined = "\x00".join(["  " + (t or "").lower() + "  " for t in texts])
    points = np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32)
    ends = points == 0  # a NUL inside a text is no letter; texts are told apart by their lengths
    lengths = np.fromiter((len((t or "").lower()) + 5 for t in texts), np.int64, len(texts))
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), lengths)[: len(points)]
    letter = _letters()[points]
    has = np.zeros(len(texts), bool)
    has[owner[letter]] = True
    edge = np.zeros(len(points), bool)
    edge[:1] = True
    edge[1:] = owner[1:] != owner[:-1]
    keep = letter | edge | ~np.concatenate([[False], ~letter[:-1]]) | np.concatenate([[False], edge[:-1]])
    points, owner = np.where(letter, points, 32)[keep].astype(np.uint64), owner[keep]
    if len(points) < N:
        return np.zeros(0, np.uint64), np.zeros(0, np.int32), has
    hashes = np.zeros(len(points) - N + 1, np.uint64)
    for k in range(N):
        hashes = (hashes ^ points[k : len(points) - N + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
        hashes ^= hashes >> np.uint64(29)
    whole = owner[: len(hashes)] == owner[N - 1 :]
    whole &= has[owner[: len(hashes)]]
    return hashes[whole], owner[: len(hashes)][whole], has


def _mixed(numbers: np.ndarray) -> np.ndarray:
    """Far-apart 64-bit values for small numbers."""
    spread = (numbers.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    return spread ^ (spread >> np.uint64(32))


class BitSlices:
    """A Bloom filter whose rows hold one bit per language, 64 languages to a word."""

    def __init__(self, languages: list[str], prior: int):
        self.languages, self.prior = languages, prior
        self.rows = np.zeros((ROWS, max(1, -(-len(languages) // 64))), np.uint64)
        self.false = np.zeros(len(languages))

    def _places(self, hashes: np.ndarray, k: int) -> np.ndarray:
        return ((hashes >> np.uint64(32)) + np.uint64(k) * (hashes | np.uint64(1))) % np.uint64(ROWS)

    def add(self, hashes: np.ndarray, masks: np.ndarray) -> None:
        for k in range(PROBES):
            places = self._places(hashes, k).astype(np.int64)
            for word in range(self.rows.shape[1]):
                np.bitwise_or.at(self.rows[:, word], places, masks[:, word])

    def finish(self) -> None:
        """False positive rate of each language, from how full its slice is."""
        for i in range(len(self.languages)):
            bits = (self.rows[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)
            self.false[i] = bits.mean() ** PROBES

    def shares(self, hashes: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
        """Per text and language, the share of n-grams held, corrected for false positives."""
        masks = self.rows[self._places(hashes, 0).astype(np.int64)]
        for k in range(1, PROBES):
            masks &= self.rows[self._places(hashes, k).astype(np.int64)]
        total = np.bincount(owner, minlength=texts)
        out = np.zeros((texts, len(self.languages)))
        for i in range(len(self.languages)):
            bits = (masks[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)
            held = np.bincount(owner, bits, minlength=texts) / np.maximum(total, 1)
            out[:, i] = np.maximum(held - self.false[i], 0) / max(1 - self.false[i], 1e-9)
        return out


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE) -> BitSlices:
    """Learn the filter from a bounded sample of labelled rows, whole texts.

    About ``sample`` rows of each language are taken, by a hash of id and text. Document counts of the
    n-grams per language are summed on the executors, and the ``GRAMS`` most frequent n-grams come to the
    driver. Rows without a language or text teach nothing; without any the filter knows no language.
    """
    rows = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.col(id_col).alias("doc_id"))
    rows = rows.filter("lang is not null and text is not null")
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").collect()}
    languages = sorted(counts)
    if not languages:
        return BitSlices([], 0)
    rate = F.create_map(*(F.lit(x) for lang in languages for x in (lang, min(1.0, sample / counts[lang]))))
    unit = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) / (1 << 20)
    number = {lang: i for i, lang in enumerate(languages)}

    def run(batches):
        for batch in by_size(batches, most=_STEP_BYTES):
            langs = np.array([number[x] for x in batch.column("lang").to_pylist()], np.int64)
            hashes, owner, has = grams(batch.column("text").to_pylist())
            _, once = np.unique(hashes ^ _mixed(owner), return_index=True)  # an n-gram counts once a document
            lang, gram = langs[owner[once]], hashes[once]
            _, place, n = np.unique(gram ^ _mixed(lang), return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(lang[place].astype(np.int32)), pa.array(np.zeros(len(n), bool)), pa.array(gram[place].view(np.int64)), pa.array(n.astype(np.int64))],
                ["lang", "documents", "gram", "n"],
            )
            taught = np.bincount(langs[has], minlength=len(languages))
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(languages)), pa.int32()), pa.array(np.ones(len(taught), bool)), pa.array(np.zeros(len(taught), np.int64)), pa.array(taught)],
                ["lang", "documents", "gram", "n"],
            )

    found = rows.filter(unit < rate[F.col("lang")]).mapInArrow(run, "lang int, documents boolean, gram long, n long")
    wide = found.groupBy("documents", "gram").agg(*(F.sum(F.when(F.col("lang") == i, F.col("n")).otherwise(0)).alias(f"n{i}") for i in range(len(languages))))
    most = F.greatest(*(F.col(f"n{i}") for i in range(len(languages))), F.lit(0))
    picked = wide.filter(F.col("documents") | (most >= LEAST_DOCS)).orderBy(F.desc("documents"), most.desc(), "gram").limit(GRAMS + 1).toPandas()
    slices = BitSlices(languages, languages.index(next(iter(counts))))
    whole = picked[picked.documents].iloc[:, 2:].to_numpy(float)
    rest = picked[~picked.documents]
    if len(rest) and len(whole):
        rates = rest.iloc[:, 2:].to_numpy(float) / np.maximum(whole[0], 1)
        held = (rates >= SHARE * rates.max(1, keepdims=True)) & (rest.iloc[:, 2:].to_numpy() > 0)
        masks = np.zeros((len(rest), slices.rows.shape[1]), np.uint64)
        for i in range(len(languages)):
            masks[:, i // 64] |= held[:, i].astype(np.uint64) << np.uint64(i % 64)
        slices.add(rest.gram.to_numpy(np.int64).view(np.uint64), masks)
    slices.finish()
    return slices


_held: dict[str, BitSlices] = {}
remembers("language", _held.clear)


def predict(docs: DataFrame, slices: BitSlices, extra: list[str] | None = None, text_col: str = "text") -> DataFrame:
    """The columns ``extra`` of every row of ``docs`` with lang_pred, score and share.

    The language is the one with the largest corrected share of the text's n-grams (ties and texts without
    a known n-gram: the commonest language of the training rows, then by name); score is its part of the
    sum of all shares, share its corrected share. A text that is null, empty or without a letter, or any
    text when no language is known, is ``und`` with score and share 0. Rows are kept as they are.
    """
    kept = list(extra or [])
    sent, name = docs.sparkSession.sparkContext.broadcast((slices.languages, slices.prior, slices.rows, slices.false)), uuid.uuid4().hex
    picked = docs.select(*(F.col(c).alias(f"c{i}") for i, c in enumerate(kept)), F.col(text_col).alias("text"))

    def run(batches):
        working("language")
        if name not in _held:
            _held.clear()
            _held[name] = known = object.__new__(BitSlices)
            known.languages, known.prior, known.rows, known.false = sent.value
        known = _held[name]
        for batch in by_size(batches, most=_STEP_BYTES):
            texts = batch.column("text").to_pylist()
            hashes, owner, has = grams(texts)
            if known.languages:
                shares = known.shares(hashes, owner, len(texts))
                order = np.arange(len(known.languages)) != known.prior  # the prior first among equals
                best = np.lexsort((np.broadcast_to(order, shares.shape), -shares), axis=1)[:, 0]
                top = shares[np.arange(len(texts)), best]
                score = top / np.maximum(shares.sum(1), 1e-12)
                langs = [known.languages[b] if h else UNKNOWN for b, h in zip(best.tolist(), has.tolist())]
                top, score = np.where(has, top, 0.0), np.where(has, score, 0.0)
            else:
                langs, top, score = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
            rest = [batch.column(f"c{i}") for i in range(len(kept))]
            names = [f"c{i}" for i in range(len(kept))]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(langs), pa.array(score), pa.array(top)], [*names, "lang_pred", "score", "share"])

    types = [f"c{i} {docs.schema[c].dataType.simpleString()}, " for i, c in enumerate(kept)]
    out = picked.mapInArrow(run, "".join(types) + "lang_pred string, score double, share double")
    return out.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(kept)), "lang_pred", "score", "share")


def rejected(lang_pred: Column, share: Column, least: float = 0.05) -> Column:
    """Texts without a language: ``und``, or hardly an n-gram that any language holds."""
    return (lang_pred == UNKNOWN) | (share < least)
