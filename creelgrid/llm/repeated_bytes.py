"""Long byte strings that occur twice anywhere in a corpus, found by suffix arrays of small neighbourhoods."""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creelgrid.operators.joins import skew_join
from creelgrid.session import drop_stages, stage_table

from .base import by_size, map_arrow, remembers, working
from .suffix_groups import suffix_array

#: Bytes that must occur twice, and bytes of the anchor by which equal windows are brought together.
LENGTH, ANCHOR = 400, 200
#: Different neighbourhoods of one anchor that share a suffix array; more are told apart by narrower
#: cores, whose windows start in steps of ``STEPS``. Within a task runs are narrowed to ``NARROW`` windows.
TOGETHER, STEPS, NARROW = 128, (16, 1), 32
#: Bytes of text of one suffix array, or runs without any, after which a task passes on what it found.
ARRAY_BYTES, ARRAY_ROWS = 1 << 16, 1 << 14
#: Bytes of a text that are hashed at once.
PIECE = 1 << 19

_RUN = "id1 long, id2 long, key long, frag long, n long, loc long"


@functools.lru_cache(1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    base = 0x9E3779B97F4A7C15
    both = [np.full(size + 1, b, np.uint64) for b in (base, pow(base, -1, 1 << 64))]
    for powers in both:
        powers[0] = 1
    return np.cumprod(both[0]), np.cumprod(both[1])


remembers("repeated_bytes", _powers.cache_clear)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def anchored_runs(data: bytes, length: int = LENGTH, anchor: int = ANCHOR):
    """(first window, last window, anchor, anchor's hash) as arrays: windows of ``length`` bytes in runs that
    have one anchor in common, the least-hashed ``anchor`` bytes in them (the first of equal ones).

    The anchor of a window depends on its bytes alone, so equal windows have equal anchors at equal places.
    """
    out = []
    wide = length - anchor + 1
    up, down = _powers(PIECE + length)
    for start in range(0, max(0, len(data) - length + 1), PIECE):
        part = np.frombuffer(data, np.uint8, min(PIECE + length - 1, len(data) - start), start).astype(np.uint64)
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((part + np.uint64(1)) * up[: len(part)])))
        hashes = _mixed((sums[anchor:] - sums[:-anchor]) * down[: len(part) - anchor + 1])
        places = np.arange(len(hashes), dtype=np.uint64)
        marked = (hashes & ~np.uint64((1 << 21) - 1)) | places
        windows = len(part) - length + 1
        blocks = -(-len(marked) // wide)
        grid = np.full(blocks * wide, np.iinfo(np.uint64).max, np.uint64)
        grid[: len(marked)] = marked
        grid = grid.reshape(blocks, wide)
        ahead = np.minimum.accumulate(grid, axis=1).ravel()
        behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
        least = np.minimum(behind[:windows], ahead[wide - 1 : wide - 1 + windows])
        at = (least & np.uint64((1 << 21) - 1)).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        last = np.append(first[1:], windows) - 1
        out.append((first + start, last + start, at[first] + start, hashes[at[first]].view(np.int64)))
    if not out:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    return tuple(np.concatenate(c) for c in zip(*out))


def _location(first, last, anchor):
    """First window, number of further ones and distance to the anchor in one number."""
    return (first << 18) | ((last - first) << 9) | (anchor - first)


def _where(loc):
    return loc >> 18, (loc >> 9) & 511, loc & 511


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _digest(data: bytes) -> int:
    return _signed(xxhash.xxh3_64_intdigest(data))


def _rows(columns: list[list | np.ndarray], names: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], [p.split()[0] for p in names.split(",")])


def _runs(batches, length: int, anchor: int):
    working("repeated_bytes")
    for batch in batches:
        parts: list[list] = [[] for _ in range(6)]
        for id1, id2, data in zip(*(batch.column(c).to_pylist() for c in ("id1", "id2", "text"))):
            first, last, at, keys = anchored_runs(data, length, anchor)
            if not len(first):
                continue
            ends = (last + length).tolist()
            own = np.array([_digest(data[a:b]) for a, b in zip(first.tolist(), ends)], np.int64)
            same = np.ones(len(first), np.int64)
            for part, values in zip(parts, (same * id1, same * id2, keys, own, same, _location(first, last, at))):
                part.append(values)
        if parts[0]:
            yield _rows([np.concatenate(p) for p in parts], _RUN)


def _cuts(batches, cut, schema: str):
    """Calls ``cut`` for each wanted run of a text; copies of a text in one task are read once."""
    seen: set[tuple[int, int]] = set()
    for batch in batches:
        out: list[tuple] = []
        for id1, id2, data, wanted in zip(*(batch.column(c).to_pylist() for c in ("id1", "id2", "text", "wanted"))):
            if (id1, id2) in seen:
                continue
            seen.add((id1, id2))
            for w in wanted:
                out += cut(data, id1, id2, w)
        names = [p.split()[0] for p in schema.split(", ")]
        kinds = [pa.binary() if "binary" in p else pa.int64() for p in schema.split(", ")]
        for i in range(0, len(out), 4096):
            columns = zip(*out[i : i + 4096])
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def _narrowed(data: bytes, id1: int, id2: int, w: dict, length: int, step: int) -> list[tuple]:
    """Runs of at most ``step`` windows; their key is the core that all of them share."""
    first, more, distance = _where(w["loc"])
    anchor, out = first + distance, []
    near = distance - more  # distance of the last window to the anchor
    for block in range(near // step, distance // step + 1):
        far = min(distance, block * step + step - 1)
        low, high = anchor - far, anchor - max(near, block * step)
        core = data[anchor - block * step : anchor - block * step - step + 1 + length]
        out.append((id1, id2, _digest(core), _digest(data[low : high + length]), w["n"], _location(low, high, anchor)))
    return out


def repeated_windows(parts: list[bytes], length: int) -> list[np.ndarray]:
    """For each part the starts of ``length`` bytes that also start elsewhere in the parts: neighbours in the
    suffix array of all parts that agree so far."""
    text = b"".join(p + b"\x00" for p in parts)
    symbols = np.frombuffer(text, np.uint8).astype(np.int64) + 1
    bounds = np.cumsum([0] + [len(p) + 1 for p in parts])
    symbols[bounds[1:] - 1] = 0  # below every byte
    left = np.concatenate([np.arange(len(p), -1, -1) for p in parts])
    order = np.array(suffix_array(symbols), np.int64)
    long = left[order] >= length
    hit = np.zeros(len(text), bool)
    for i in np.flatnonzero(long[:-1] & long[1:]).tolist():
        a, b = int(order[i]), int(order[i + 1])
        if text[a : a + length] == text[b : b + length]:
            hit[a] = hit[b] = True
    return [np.flatnonzero(hit[a : b - 1]) for a, b in zip(bounds[:-1], bounds[1:])]


def _stretches(marks: np.ndarray):
    """(start, end) of each run of set marks."""
    edges = np.flatnonzero(np.diff(marks, prepend=False, append=False)).tolist()
    return zip(edges[::2], edges[1::2])


class Neighbourhoods:
    """Runs of windows with their texts, gathered anchor by anchor until a suffix array of them is worth while."""

    def __init__(self, length: int):
        self.length = length
        self.rows: list[tuple[int, int, int, np.ndarray]] = []  # ids, first window, windows found twice
        self.parts: list[bytes] = []
        self.places: list[tuple[int, int]] = []
        self.size = 0

    def add(self, group: list[tuple]) -> None:
        """Different runs of one anchor as (id1, id2, n, loc, bytes). Runs are narrowed to windows with a core that
        another run holds too. Equal narrow runs are repeated whole; the suffix array gets one of them beside
        the different ones of the same core."""
        cores: dict[int, dict[int, list[tuple[int, int, int]]]] = {}
        base = len(self.rows)
        wanted: dict[int, np.ndarray] = {}  # windows of a run for the suffix array
        for number, (id1, id2, n, loc, data) in enumerate(group):
            first, more, distance = _where(loc)
            self.rows.append((id1, id2, first, np.zeros(more + 1, bool)))
            for *_, core, own, _, place in _narrowed(data, 0, 0, {"loc": loc & ((1 << 18) - 1), "n": n}, self.length, NARROW):
                cores.setdefault(core, {}).setdefault(own, []).append((number, n, place))
        for alike in cores.values():
            for holders in alike.values():
                if sum(n for _, n, _ in holders) > 1:
                    for number, _, place in holders:
                        low, more, _ = _where(place)
                        self.rows[base + number][3][low : low + more + 1] = True
            if len(alike) > 1 and any(len(h) == 1 and h[0][1] == 1 for h in alike.values()):
                for holders in alike.values():
                    number, _, place = holders[0]
                    low, more, _ = _where(place)
                    wanted.setdefault(number, np.zeros_like(self.rows[base + number][3]))[low : low + more + 1] = True
        for number, windows in wanted.items():
            for low, high in _stretches(windows):
                self.parts.append(group[number][4][low : high - 1 + self.length])
                self.places.append((base + number, low))
                self.size += len(self.parts[-1])

    def spans(self) -> list[tuple[int, int, int]]:
        """(id1, id2, span) of the windows found twice so far; begins anew."""
        if self.parts:
            for (row, low), starts in zip(self.places, repeated_windows(self.parts, self.length)):
                self.rows[row][3][low + starts] = True
        out = []
        for id1, id2, first, hit in self.rows:
            out += [(id1, id2, _span(first + a, b - a + self.length - 1)) for a, b in _stretches(hit)]
        self.__init__(self.length)
        return out


def _arrays(batches, length: int):
    """Spans of windows that occur twice among the runs of an anchor; rows come sorted by anchor."""
    near = Neighbourhoods(length)
    key, group = None, {}
    for batch in by_size(batches, "bytes", 1 << 20):
        for row in zip(*(batch.column(c).to_pylist() for c in ("key", "frag", "id1", "id2", "n", "loc", "bytes"))):
            if row[0] != key:
                near.add(list(group.values()))
                key, group = row[0], {}
                if near.size > ARRAY_BYTES or len(near.rows) > ARRAY_ROWS:
                    found = near.spans()
                    if found:
                        yield _rows(list(zip(*found)), "id1, id2, span")
            group.setdefault(row[1], row[2:])
    near.add(list(group.values()))
    found = near.spans()
    if found:
        yield _rows(list(zip(*found)), "id1, id2, span")


def _span(start, size):
    return (start << 20) | size


def _emptied(batches):
    """Texts without their spans."""
    for batch in batches:
        sizes, removed, runs, spans, kept = [], [], [], [], []
        for data, found in zip(batch.column("text").to_pylist(), batch.column("found").to_pylist()):
            out, pieces, at = [], [], 0
            for packed in sorted(found or ()):
                low, high = packed >> 20, (packed >> 20) + (packed & 0xFFFFF)
                if out and low <= out[-1]:
                    out[-1] = max(out[-1], high)
                else:
                    out += [low, high]
            for low, high in zip(out[::2], out[1::2]):
                pieces.append(data[at:low])
                at = high
            pieces.append(data[at:])
            rest = b"".join(pieces)
            sizes.append(len(data))
            removed.append(len(data) - len(rest))
            runs.append(len(out) // 2)
            spans.append(out)
            kept.append(rest)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(spans, pa.list_(pa.int64())), pa.array(kept, pa.binary())],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "spans", "kept"],
        )


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, anchor: int = ANCHOR, together: int = TOGETHER
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, spans (first byte and byte behind the
    last of each removed run, alternating), kept (binary: the bytes that are left).

    A byte goes when it lies in ``length`` bytes that also start anywhere else in the UTF-8 texts, in the same
    text too; matches do not cross texts and are judged on the input.

    Every window of ``length`` bytes has an anchor that its bytes alone decide, and windows of one anchor
    stand in runs. Runs meet by the anchor's hash. Equal runs collapse into a count before anything else, so
    that a group of copies is one row; what occurs twice so is repeated whole. Where different runs share an
    anchor, their texts are cut out and narrowed to windows with a common core, and one suffix array of those
    that differ, built by Lyndon groups, tells which windows are repeated. An anchor with more than ``together`` different runs does not meet in one task: its runs are
    split by the cores that 16 and then single windows share, where such runs collapse again.

    Texts are told apart by 128 bits, runs of one anchor by 64 bits. Null text is the empty text; texts under
    ``length`` bytes stay whole; rows that repeat a text lose it from ``length`` bytes on, whatever their ids;
    ids may be null or repeat and are only carried; an empty table gives none; other columns are not read.
    """
    if length - anchor > 511:
        raise ValueError("an anchor may be shorter than a window by 511 bytes at most")
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(
        F.xxhash64(text).alias("id1"), F.xxhash64(F.lit("second"), text).alias("id2"), F.col(id_col).alias("doc_id"), text.alias("text")
    )
    texts = rows.filter(F.octet_length("text") >= length).select("id1", "id2", "text")
    runs = stage_table(map_arrow(texts, lambda batches: _runs(batches, length, anchor), _RUN), "runs")
    spans, held = None, ()
    for step in (*STEPS, 0):
        first = [F.first(c).alias(c) for c in ("id1", "id2", "loc")]
        kinds = stage_table(runs.groupBy("key", "frag").agg(F.sum("n").alias("n"), *first), "kinds")
        more = F.shiftright(F.col("loc").bitwiseAND(F.lit(511 << 9)), 9)
        whole = skew_join(runs, kinds.filter("n > 1").select("key", "frag"), ["key", "frag"]).select(
            "id1", "id2", _span_column(F.shiftright("loc", 18), more + length).alias("span")
        )
        counts = kinds.groupBy("key").agg(F.count("*").alias("kinds"), F.min("n").alias("least"))
        mixed = skew_join(kinds, counts.filter("kinds > 1 and least = 1").drop("least"), ["key"])
        mixed = stage_table(mixed, "mixed")

        def cut_out(wanted, cut, schema):
            listed = wanted.groupBy("id1", "id2").agg(F.collect_list(F.struct("key", "frag", "n", "loc")).alias("wanted"))
            return map_arrow(skew_join(texts, listed, ["id1", "id2"]), lambda batches: _cuts(batches, cut, schema), schema)

        def bytes_of(data, id1, id2, w):
            low, further, _ = _where(w["loc"])
            return [(w["key"], w["frag"], id1, id2, w["n"], w["loc"], data[low : low + further + length])]

        cut = cut_out(mixed.filter(F.col("kinds") <= together), bytes_of, "key long, frag long, id1 long, id2 long, n long, loc long, bytes binary")
        shared = cut.repartition("key").sortWithinPartitions("key", "frag")
        found = shared.mapInArrow(lambda batches: _arrays(batches, length), "id1 long, id2 long, span long")
        found = stage_table(whole.unionByName(found).distinct(), "spans")
        spans = found if spans is None else spans.unionByName(found)
        crowded = mixed.filter(F.col("kinds") > together)
        finer, gone = None, held
        if step and not crowded.isEmpty():
            # All later rounds are about these texts, so only this join moves the others.
            texts = stage_table(skew_join(texts, crowded.select("id1", "id2").distinct(), ["id1", "id2"]).select("id1", "id2", "text"), "crowded")
            held = (texts,)
            narrowed = cut_out(crowded, lambda d, i, j, w, step=step: _narrowed(d, i, j, w, length, step), _RUN)
            finer = stage_table(narrowed.distinct(), "runs")
        drop_stages(docs.sparkSession, runs, kinds, mixed, *gone)
        if finer is None:
            break
        runs = finer
    lists = spans.groupBy("id1", "id2").agg(F.collect_list("span").alias("found"))
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, spans array<long>, kept binary"
    return map_arrow(skew_join(rows, lists, ["id1", "id2"], "left"), _emptied, schema)


def _span_column(start, size):
    return F.shiftleft(start, 20) + size
