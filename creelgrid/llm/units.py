"""Splitting texts where the byte-level pre-tokenizer always splits, and remembering what the units give."""

from __future__ import annotations

import re
from collections.abc import Callable, Collection, Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: White space other than the blank and the line feed, as any of the libraries sees it.
_ODD = "".join(c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n")
_BOUNDARY = re.compile(r"(?<=\S) (?=\S)")
#: New units that are encoded at once, which bounds what the libraries hold beside the results.
_AT_ONCE = 1 << 14
#: A word of Latin letters and what follows on it, which every library takes apart there.
_WORD = re.compile(r"([A-Za-zÀ-ÖØ-öø-ɏ]++)([\x00-@\[-`{-\x7f].*)", re.DOTALL)
#: Texts in which not every blank is a boundary.
_ELSE = rf"\A | \z|  | \n|\n |[{_ODD}]"


def units(texts: pa.Array) -> pa.Array:
    """Lists of the parts of texts cut at each single blank between two characters that are no white space.

    A blank there starts a match of the pattern whatever surrounds it, and no match goes past it, so the
    tokens of a text are those of the first part and of ``" " + part`` for every other.
    """
    parts = pc.split_pattern(texts, " ")
    odd = np.flatnonzero(pc.match_substring_regex(texts, _ELSE).to_numpy(zero_copy_only=False))
    if not odd.size:
        return parts
    cut = pa.array([_BOUNDARY.split(x) for x in texts.take(pa.array(odd)).to_pylist()], parts.type)
    at = np.arange(len(texts))
    at[odd] = len(texts) + np.arange(len(odd))
    return pa.concat_arrays([parts, cut]).take(pa.array(at))


def _strings(column: pa.Array) -> list[str]:
    """``to_pylist`` without a scalar per row."""
    return column.to_numpy(zero_copy_only=False).tolist()


class UnitCache:
    """What units give, as bytes; computed for many new units at a time and kept up to a bound."""

    def __init__(self, encode: Callable[[list[str]], Iterable[bytes]], most: int = 400_000, longest: int = 64):
        self.encode, self.most, self.longest = encode, most, longest
        self.first: dict[str, bytes] = {}
        self.spaced: dict[str, bytes] = {}

    def _fill(self, known: dict[str, bytes], prefix: str, wanted: Collection[str]) -> dict[str, bytes]:
        """``known`` with all that is wanted, or a fresh dictionary for overlong units."""
        new = [x for x in wanted if x not in known]
        if not new:
            return known
        if len(known) > self.most:
            known.clear()
            new = list(wanted)
        found: dict[str, bytes] = {}
        for k in range(0, len(new), _AT_ONCE):
            some = new[k : k + _AT_ONCE]
            found.update(zip(some, self.encode([prefix + x for x in some])))
        known.update((k, v) for k, v in found.items() if len(k) <= self.longest)
        return known if max(map(len, new)) <= self.longest else {**{k: known[k] for k in wanted if k in known}, **found}

    def texts(self, texts: pa.Array | list[str | None]) -> list[bytes]:
        """For each text the bytes of all its units, one after the other; null is the empty text.

        Only the different units of the texts become Python strings; Arrow cuts, counts and joins the rest.
        Words are remembered without the marks behind them: a match of letters ends there, and the next
        begins anew. (A special token must not begin with letters and go on with marks.)
        """
        if not len(texts):
            return []
        column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        parts = units(column.fill_null(""))
        starts = np.concatenate(([0], np.cumsum(parts.value_lengths().to_numpy())))
        coded = parts.flatten().dictionary_encode()
        code, names = coded.indices.to_numpy().astype(np.int64), _strings(coded.dictionary)
        heads = [names[i] for i in code[starts[:-1]].tolist()]
        code[starts[:-1]] = len(names) + np.arange(len(heads))
        there = np.bincount(code, minlength=len(names))[: len(names)] > 0
        cut = [(m.groups() if (m := _WORD.match(x)) else (x, "")) if b else ("", "") for x, b in zip(names, there.tolist())]
        first = self._fill(self.first, "", {*heads, *(b for _, b in cut)})
        spaced = self._fill(self.spaced, " ", {a for a, _ in cut} - {""})
        later = (spaced[a] + first[b] if b else spaced.get(a, b"") for a, b in cut)
        values = pa.array([*later, *map(first.__getitem__, heads)], pa.large_binary())
        joined = values.take(pa.array(code))
        ends = np.frombuffer(joined.buffers()[1], np.int64)[joined.offset :][starts].tolist()
        data = memoryview(joined.buffers()[2] or b"")
        return [bytes(data[a:b]) for a, b in zip(ends, ends[1:])]
