"""License notices by template mark-up: optional and replaceable regions compiled into token automata."""

from __future__ import annotations

import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import map_arrow, words_of

# Base phrases with their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Wording of public license notices, as templates. [[...]] is optional, {m-n} stands for m to
# n words of any kind, and (a|b) for one of two wordings.
TEMPLATES = {
    "gpl-3.0": "licensed under the [[terms of the]] gnu general public license [[as published by the free"
    " software foundation]] [[either]] version 3 [[of the license]] [[(or at your option any later version|only)]]",
    "gpl-2.0": "licensed under the [[terms of the]] gnu general public license [[as published by the free"
    " software foundation]] [[either]] version 2 [[of the license]] [[(or at your option any later version|only)]]",
    "apache-2.0": "licensed under the apache license version 2 0 [[the license you may not use this file except"
    " in compliance with the license you may obtain a copy of the license at {1-8} unless required by applicable"
    " law or agreed to in writing software distributed under the license is distributed on an as is basis without"
    " warranties or conditions of any kind either express or implied see the license for the specific language"
    " governing permissions and limitations under the license]]",
    "mit-notice": "(released|licensed|distributed|available) under the [[terms of the]] mit license",
    "mit": "permission is hereby granted free of charge to any person obtaining a copy of this software and"
    " associated documentation files the software to deal in the software without restriction including without"
    " limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the"
    " software and to permit persons to whom the software is furnished to do so subject to the following"
    " conditions the above copyright notice and this permission notice [[including the next paragraph]] shall be"
    " included in all copies or substantial portions of the software the software is provided as is without"
    " warranty of any kind",
    "isc": "permission to use copy modify and [[or]] distribute this software for any purpose with or without fee"
    " is hereby granted provided that the above copyright notice and this permission notice appear in all copies"
    " the software is provided as is and {1-8} disclaims all warranties",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted provided"
    " that the following conditions are met [[1]] redistributions of source code must retain the above copyright"
    " notice this list of conditions and the following disclaimer [[2]] redistributions in binary form must"
    " reproduce the above copyright notice this list of conditions and the following disclaimer in the"
    " documentation and or other materials provided with the distribution [[3]] [[neither the name of {1-12} nor"
    " the names of {1-8} may be used to endorse or promote products derived from this software without specific"
    " prior written permission]]",
    "cc-by-4.0": "licensed under [[a]] [[creative commons]] cc by 4 0",
    "cc-by-sa-4.0": "licensed under [[a]] [[creative commons]] cc by sa 4 0",
    "cc-by-nc-4.0": "licensed under [[a]] [[creative commons]] cc by nc 4 0",
    "cc-by-nc-sa-4.0": "licensed under [[a]] [[creative commons]] cc by nc sa 4 0",
    "cc-by-nd-4.0": "licensed under [[a]] [[creative commons]] cc by nd 4 0",
    "cc-by-nc-nd-4.0": "licensed under [[a]] [[creative commons]] cc by nc nd 4 0",
    "lgpl-3.0": "licensed under the gnu lesser general public license [[as published by the free software foundation]]"
    " [[either]] version 3 [[of the license]] [[(or at your option any later version|only)]]",
    "lgpl-2.1": "licensed under the gnu lesser general public license [[as published by the free software foundation]]"
    " [[either]] version 2 1 [[of the license]] [[(or at your option any later version|only)]]",
    "agpl-3.0": "licensed under the gnu affero general public license [[as published by the free software foundation]]"
    " [[either]] version 3 [[of the license]] [[(or at your option any later version|only)]]",
    "apache-2.0-notice": "licensed under the apache license version 2 0 [[the license]] you may not use this file except"
    " in compliance with the license you may obtain a copy of the license at {1-10} unless required by applicable"
    " law or agreed to in writing software distributed under the license is distributed on an as is basis without"
    " warranties or conditions of any kind either express or implied see the license for the specific language"
    " governing permissions and limitations under the license",
}

# The header of the GNU licenses, as published, and notices that name such a license by its terms.
_GNU = (
    "[[redistribute it and or modify it]] under the terms of the gnu {name} [[{short}]] [[as published by the free"
    " software foundation]] [[either]] version {version} [[of the license]] [[as published by the free software foundation]]"
    " [[(or at your option any later version|or any later version|only)]] [[{{1-6}} is distributed in the hope that it will"
    " be useful but without any warranty without even the implied warranty of merchantability or fitness for a"
    " particular purpose see the gnu {name} for more details]]"
)
TEMPLATES |= {
    f"{short}-{version}-terms": _GNU.format(name=f"{name}general public license", short=short, version=version.removesuffix(".0").replace(".", " "))
    for name, short, version in [
        ("", "gpl", "2.0"), ("", "gpl", "3.0"), ("library ", "lgpl", "2.0"), ("lesser ", "lgpl", "2.1"),
        ("lesser ", "lgpl", "3.0"), ("affero ", "agpl", "3.0"),
    ]
}

# The long names of the Creative Commons licenses.
_CC = {
    "by": "attribution",
    "by-sa": "attribution (sharealike|share alike)",
    "by-nd": "attribution (noderivatives|noderivs|no derivatives|no derivs)",
    "by-nc": "attribution (noncommercial|non commercial)",
    "by-nc-sa": "attribution (noncommercial|non commercial) (sharealike|share alike)",
    "by-nc-nd": "attribution (noncommercial|non commercial) (noderivatives|noderivs|no derivatives|no derivs)",
}
TEMPLATES |= {
    f"cc-{short}-{version}-name": f"creative commons {name} {version.replace('.', ' ')} [[(international|unported|generic)]] [[public]] [[(license|licence)]]"
    for short, name in _CC.items()
    for version in ("2.0", "2.5", "3.0", "4.0")
}

_MARK = re.compile(r"\[\[|\]\]|\(|\||\)|\{(\d+)-(\d+)\}|[^\s\[\](){}|]+")


class Template:
    """An automaton over words. Arcs of a state: word -> states, ``None`` -> states for any word; free moves."""

    def __init__(self, text: str):
        self.arcs: list[dict[bytes | None, list[int]]] = [{}]
        self.free: list[list[int]] = [[]]
        self.pinned: list[bytes] = []  # the longest run of words outside every region: must occur
        tokens = [m for m in _MARK.finditer(text)]
        self.at, depth, run = 0, 0, []
        stack: list[tuple[int, list[int]]] = []
        for m in tokens:
            mark = m[0]
            if mark in ("[[", "("):
                stack.append((self.at, []))
                depth += 1
            elif mark == "|":
                stack[-1][1].append(self.at)
                self.at = self._state()
                self.free[stack[-1][0]].append(self.at)
            elif mark in ("]]", ")"):
                start, ends = stack.pop()
                depth -= 1
                end = self._state()
                for x in [*ends, self.at, *([start] if mark == "]]" else [])]:
                    self.free[x].append(end)
                self.at = end
            elif m[1]:
                least, most = int(m[1]), int(m[2])
                skipped = []
                for k in range(most):
                    if k >= least:
                        skipped.append(self.at)
                    self._arc(None)
                for x in skipped:
                    self.free[x].append(self.at)
            else:
                self._arc(mark.encode())
            if depth or mark in ("]]", ")") or m[1]:
                run = []
            else:
                run.append(mark.encode())
                self.pinned = max(self.pinned, list(run), key=lambda r: len(b" ".join(r)))
        self.accept = self.at
        self.needle = b" " + b" ".join(self.pinned) + b" "
        self.first = set().union(*(self.arcs[s].keys() for s in self._close({0})))

    def _state(self) -> int:
        self.arcs.append({})
        self.free.append([])
        return len(self.arcs) - 1

    def _arc(self, word: bytes | None) -> None:
        to = self._state()
        self.arcs[self.at].setdefault(word, []).append(to)
        self.at = to

    def _close(self, states: set[int]) -> set[int]:
        todo, seen = list(states), set(states)
        while todo:
            for x in self.free[todo.pop()]:
                if x not in seen:
                    seen.add(x)
                    todo.append(x)
        return seen

    def match(self, words: list[bytes], start: int) -> int:
        """Words of the longest match that begins at ``start``, or 0."""
        states, best = self._close({0}), 0
        for k in range(start, len(words)):
            states = self._close({t for s in states for t in (*self.arcs[s].get(words[k], ()), *self.arcs[s].get(None, ()))})
            if not states:
                break
            if self.accept in states:
                best = k + 1 - start
        return best

    def places(self, words: list[bytes], spaced: bytes) -> list[tuple[int, int]]:
        """(first word, words) of every match in a text; ``spaced``: its words, each between two blanks."""
        if self.needle not in spaced:  # mandatory wording is missing
            return []
        starts = range(len(words)) if None in self.first else [i for i, w in enumerate(words) if w in self.first]
        return [(i, n) for i in starts if (n := self.match(words, i))]


@lru_cache(4)
def _templates(items: tuple[tuple[str, str], ...]) -> list[tuple[str, Template]]:
    return [(name, Template(text)) for name, text in items]


def _phrase_places(spaced: bytes, phrase: bytes) -> list[int]:
    out, at = [], spaced.find(phrase)
    while at >= 0:
        out.append(at)
        at = spaced.find(phrase, at + 1)
    return out


def scan_licenses(
    docs: DataFrame, templates: dict[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    spans, score.

    Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` with A-Z lower-cased. Base: places where the words
    of a phrase of ``PHRASES`` stand consecutively; first_word and last_word are their least and greatest
    first word (null without a place). A template adds its label when its mandatory wording occurs word by
    word, with optional regions there or not and replaceable ones within their bounds; ``spans`` holds
    (label, first word, words) of the longest match at each place. Labels are distinct, sorted and
    comma-joined, empty without any. score: 1 with a template, 0.5 with base phrases alone, else 0.

    Null and empty texts have no words; rows that repeat and null ids stay; an empty table gives none; other
    columns are not read.
    """
    items = tuple((TEMPLATES if templates is None else templates).items())

    def run(batches):
        own = _templates(items)
        phrases = [(b" " + p.encode() + b" ", label) for p, label in PHRASES.items()]
        for batch in batches:
            out = {k: [] for k in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "spans", "score")}
            for text in batch.column("text").to_pylist():
                words = words_of(text)
                spaced = b" " + b" ".join(words) + b" "
                places, base = [], set()
                for phrase, label in phrases:
                    found = _phrase_places(spaced, phrase)
                    if found:
                        base.add(label)
                        places += found
                spans = [(name, i, n) for name, t in own for i, n in t.places(words, spaced)]
                out["n_words"].append(len(words))
                out["n_base"].append(len(places))
                out["first_word"].append(spaced.count(b" ", 0, min(places)) if places else None)
                out["last_word"].append(spaced.count(b" ", 0, max(places)) if places else None)
                out["base_labels"].append(",".join(sorted(base)))
                out["labels"].append(",".join(sorted(base | {s[0] for s in spans})))
                out["spans"].append([{"label": a, "first": i, "words": n} for a, i, n in spans])
                out["score"].append(1.0 if spans else 0.5 if places else 0.0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(v, kinds[k]) for k, v in out.items())], ["doc_id", *out])

    span = pa.struct([("label", pa.string()), ("first", pa.int64()), ("words", pa.int64())])
    kinds = dict.fromkeys(("n_words", "n_base", "first_word", "last_word"), pa.int64())
    kinds |= {"base_labels": pa.string(), "labels": pa.string(), "spans": pa.list_(span), "score": pa.float64()}
    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = picked.schema["doc_id"].dataType.simpleString()
    return map_arrow(
        picked,
        run,
        f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string,"
        " spans array<struct<label:string,first:long,words:long>>, score double",
    )
