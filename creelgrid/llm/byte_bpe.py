"""Byte-level BPE by numpy matrices: every row merges its leftmost pair of least rank, round by round."""

from __future__ import annotations

import base64
import heapq
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import by_size, map_arrow, remembers, working
from .units import UnitCache

#: Longest piece of a matrix. Longer pieces, whose rounds would cost the square of their length, are
#: merged from a heap in the same order.
WIDEST = 256
#: Cells of a matrix, which with its temporary ones stays in the caches.
CELLS = 1 << 16
#: Bytes of text taken apart at once and units a worker remembers: as the last stage of a run, it gets
#: executors whose memory earlier stages have filled.
SLICE, REMEMBERED = 1 << 20, 60_000
NONE = np.int32(2**31 - 1)
#: Keys of a matrix order pairs by rank, then place; from this one on there is no pair.
NO_KEY = int(NONE) * WIDEST
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


class Ranks:
    """A rank file (base64 token, blank, rank) as arrays: ranks are the ids of the tokens."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.size = len(self.tokens)
        self.byte_ids = np.array([ranks[bytes([c])] for c in range(256)], np.int32)
        left, right, joined = [], [], []
        for token, rank in ranks.items():  # every way in which two tokens join to a third
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), joined.append(rank)
        keys = np.array(left, np.int64) * self.size + np.array(right, np.int64)
        self._build(keys, np.array(joined, np.int32))

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * _FACTOR) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _build(self, keys: np.ndarray, values: np.ndarray) -> None:
        """An open-addressed table with linear probing, filled for all keys at once."""
        self.bits = max(4, int(4 * max(1, len(keys))).bit_length())
        self.keys, self.values = np.full(1 << self.bits, -1, np.int64), np.full(1 << self.bits, NONE, np.int32)
        slots = self._slots(keys)
        while len(keys):
            free = self.keys[slots] < 0
            self.keys[slots[free]] = keys[free]  # of several for one slot the last stays
            settled = self.keys[slots] == keys
            self.values[slots[settled]] = values[settled]
            keys, values, slots = keys[~settled], values[~settled], (slots[~settled] + 1) & ((1 << self.bits) - 1)

    def joined(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, or NONE; negative ids are padding."""
        keys = left.astype(np.int64) * self.size + right
        keys[(left < 0) | (right < 0)] = -2
        flat = keys.ravel()
        slots = self._slots(flat)
        there = self.keys[slots]
        out = np.where(there == flat, self.values[slots], NONE)
        open_ = np.flatnonzero((there != flat) & (there >= 0) & (flat >= 0))
        while open_.size:
            slots[open_] = (slots[open_] + 1) & ((1 << self.bits) - 1)
            there = self.keys[slots[open_]]
            hit = there == flat[open_]
            out[open_[hit]] = self.values[slots[open_[hit]]]
            open_ = open_[~hit & (there >= 0)]
        return out.reshape(keys.shape)

    def merge_matrix(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids, one piece after the other, and their numbers, of pieces of ``data``, each a column of a matrix.

        Ids stay at the place of their first byte and know the places before and after them, so that a round
        reads the keys alone as a whole; a last row of padding stands for no neighbour.
        """
        width, n = max(1, int(lengths.max())), len(lengths)
        places = np.arange(width)[:, None]
        ids = np.full((width + 1, n), -1, np.int32)
        ids[:width] = np.where(places < lengths, self.byte_ids[data[np.minimum(starts + places, len(data) - 1)]], -1)
        keys = np.full((width + 1, n), NO_KEY, np.int64)
        keys[:width] = self.joined(ids[:-1], ids[1:]).astype(np.int64) * WIDEST + places
        after = np.repeat(np.arange(1, width + 2), n)
        before = np.repeat(np.arange(-1, width), n)
        before[:n] = width
        cells, columns = ids.reshape(-1), np.arange(n)
        while True:
            least = keys.min(axis=0)  # the first of equal ranks
            live = np.flatnonzero(least < NO_KEY)
            if not live.size:
                break
            if live.size < 0.8 * len(columns):  # compaction: columns without a pair are ready
                keys, columns, least = keys[:, live], columns[live], least[live]
                live = np.arange(len(columns))
            m, of = len(columns), columns[live]
            rank, at = np.divmod(least[live], WIDEST)
            here = at * n + of
            gone = after[here]
            there = gone * n + of
            behind, ahead = before[here], after[there]
            cells[here], cells[there] = rank, -1
            after[here], before[ahead * n + of] = ahead, at
            found = self.joined(
                np.concatenate([rank, cells[behind * n + of]]), np.concatenate([cells[ahead * n + of], rank])
            ).astype(np.int64)
            keys[gone, live] = NO_KEY
            keys[at, live] = found[: len(live)] * WIDEST + at
            keys[behind, live] = np.where(behind < width, found[len(live) :] * WIDEST + behind, NO_KEY)
        columnwise = np.ascontiguousarray(ids.T)
        left = columnwise >= 0
        return columnwise[left], left.sum(axis=1)

    def merge_heap(self, piece: bytes) -> np.ndarray:
        """Ids of one long piece: the same order of merges from a heap of (rank, place)."""
        ids = self.byte_ids[np.frombuffer(piece, np.uint8)].tolist()
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        pairs = self.joined(np.array(ids[:-1], np.int32), np.array(ids[1:], np.int32)).tolist()
        heap = [(r, i, ids[i], ids[i + 1]) for i, r in enumerate(pairs) if r != NONE]
        heapq.heapify(heap)
        rank_of = {}

        def offer(i: int) -> None:
            if i >= 0 and after[i] < len(ids):
                a, b = ids[i], ids[after[i]]
                if (a, b) not in rank_of:
                    rank_of[a, b] = int(self.joined(np.array([a], np.int32), np.array([b], np.int32))[0])
                if rank_of[a, b] != NONE:
                    heapq.heappush(heap, (rank_of[a, b], i, a, b))

        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= len(ids) or ids[j] != b:
                continue  # one of the two has been merged since
            ids[i], ids[j], after[i] = rank, -1, after[j]
            if after[j] < len(ids):
                before[after[j]] = i
            offer(i)
            offer(before[i])
        return np.array([x for x in ids if x >= 0], np.int32)

    def merged(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of binary pieces, one piece after the other in any order, with their starts and numbers."""
        offsets = np.frombuffer(pieces.buffers()[1], np.int32)[pieces.offset :][: len(pieces) + 1].astype(np.int64)
        data = np.frombuffer(pieces.buffers()[2] or b"\0", np.uint8)
        starts, lengths = offsets[:-1], np.diff(offsets)
        order = np.argsort(lengths, kind="stable")
        short = int(np.searchsorted(lengths[order], WIDEST, "right"))
        parts, counts = [], np.zeros(len(order), np.int64)
        k = 0
        while k < short:  # as many pieces of about one length as a matrix holds
            widths = np.maximum(lengths[order[k : min(short, k + CELLS)]], 1)
            step = max(1, int(np.count_nonzero(widths * np.arange(1, len(widths) + 1) <= CELLS)))
            some = order[k : k + step]
            ids, counts[some] = self.merge_matrix(data, starts[some], lengths[some])
            parts.append(ids)
            k += step
        for i in order[short:].tolist():
            parts.append(self.merge_heap(data[starts[i] : starts[i] + lengths[i]].tobytes()))
            counts[i] = len(parts[-1])
        places = np.zeros(len(order), np.int64)
        places[order] = np.cumsum(counts[order]) - counts[order]
        return np.concatenate([np.empty(0, np.int32), *parts]), places, counts

    def pieces(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of pieces, each on its own."""
        ids, starts, counts = self.merged(pa.array(pieces, pa.binary()))
        return [ids[a : a + n] for a, n in zip(starts.tolist(), counts.tolist())]


class Encoder:
    """Texts to ids and back for one rank file and pattern."""

    def __init__(self, path: str, pattern: str):
        import regex

        self.ranks, self.find = Ranks(path), regex.compile(pattern).findall
        self.cache = UnitCache(self.encode_units, most=REMEMBERED)

    def encode_units(self, texts: list[str]) -> list[bytes]:
        found = list(map(self.find, texts))
        coded = pa.array(list(chain.from_iterable(found)), pa.string()).dictionary_encode()
        ids, starts, counts = self.ranks.merged(coded.dictionary.cast(pa.binary()))
        code = coded.indices.to_numpy()
        ends = np.concatenate([[0], np.cumsum(counts[code])])
        picked = ids[np.arange(ends[-1]) + np.repeat(starts[code] - ends[:-1], counts[code])]
        data = picked.astype("<u4").tobytes()
        cuts = (4 * ends[np.concatenate([[0], np.cumsum(list(map(len, found)), dtype=np.int64)])]).tolist()
        return [data[a:b] for a, b in zip(cuts, cuts[1:])]

    def encode(self, texts: pa.Array | list[str | None]) -> list[bytes]:
        """Ids of whole texts as little-endian unsigned 32-bit integers."""
        return self.cache.texts(texts)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.ranks.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(2)
def encoder(path: str, pattern: str) -> Encoder:
    return Encoder(path, pattern)


remembers("byte_bpe", encoder.cache_clear)


def encode_decode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, ids (unsigned 32-bit, little-endian), decoded (bytes).

    Every match of ``pattern`` is encoded on its own by the ranks in ``path``, without special tokens; the
    ids are then decoded. Pieces are rows of padded matrices, one width per length bucket; each round,
    every row merges its leftmost pair of least rank (found in a hashed table), rows without a pair leave.
    Units of text between blanks that a worker has seen are not encoded again. Null and empty texts have
    no ids; rows that repeat, null ids and an empty table pass as they are; other columns are not read.
    A text must be valid UTF-8.
    """

    def run(batches):
        working("byte_bpe")
        enc = encoder(path, pattern)
        for batch in by_size(batches, most=SLICE):
            ids = enc.encode(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array(ids, pa.binary()),
                    pa.array([enc.decode(x) for x in ids], pa.binary()),
                ],
                ["doc_id", "n_tokens", "ids", "decoded"],
            )

    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = picked.schema["doc_id"].dataType.simpleString()
    return map_arrow(picked, run, f"doc_id {kind}, n_tokens long, ids binary, decoded binary")
