import random

import pytest

from creelgrid.llm import decontaminate, licenses
from creelgrid.llm.base import words_of


def brute(text, items, window=13):
    words = words_of(text)
    hit, names = set(), set()
    for name, item in items:
        own = words_of(item)
        n = min(window, len(own))
        for s in range(len(own) - n + 1) if n else ():
            for i in range(len(words) - n + 1):
                if words[i : i + n] == own[s : s + n]:
                    hit |= set(range(i, i + n))
                    names.add(name or "")
    return len(words), len(hit), sorted(names), len(hit) > 0 and 20 * len(hit) >= len(words)


def test_windows_against_brute_force(spark, make_docs):
    random.seed(2)
    some = lambda n: " ".join(random.choices(["a", "b", "Cc", "dé", "e5"], k=n))
    items = [(f"i{k}", some(random.choice([0, 1, 3, 12, 13, 14, 40]))) for k in range(12)] + [(None, "b a b a e5"), ("i1", "dé dé dé")]
    docs = [(k, " ".join([*random.choices(["a", "b", "Cc", "dé", "e5", "zz"], k=random.randint(0, 50)), random.choice(items)[1].upper(), "zz"])) for k in range(60)]
    docs += [(None, None), (1000, ""), (1000, "a b"), (1000, "a b")]
    benchmark = spark.createDataFrame(items + [("null", None)], "item_id string, text string")
    for window, block in ((13, 1 << 20), (5, 1 << 20), (5, 60)):  # the last: many passes
        found = decontaminate.contamination(make_docs(docs, items="clash", spans="clash"), benchmark, window=window, block_bytes=block)
        got = sorted(((r.doc_id, r.n_words, r.n_hit, list(r["items"]), r.contaminated) for r in found.collect()), key=repr)
        assert got == sorted(((i, *brute(t, items, window)) for i, t in docs), key=repr)


def test_spans_and_empty_tables(spark, make_docs):
    benchmark = spark.createDataFrame([("x", "one two three")], "item_id string, text string")
    row = decontaminate.contamination(make_docs([(1, "zero One, TWO three four one two three")]), benchmark).first()
    assert (list(row.spans), row.n_hit, list(row["items"])) == ([1, 3, 5, 7], 6, ["x"])
    assert decontaminate.contamination(make_docs([]), benchmark).count() == 0
    assert decontaminate.contamination(make_docs([(1, "one two three")]), benchmark.limit(0)).first().n_hit == 0


def test_template_regions():
    t = licenses.Template("(use|copy) of [[this [[free]] software]] is {1-3} granted {0-1} here")
    good = ["use of is fully granted here", "copy of this software is a b c granted x here", "use of this free software is a granted here"]
    bad = ["use of this is a granted here", "use of is granted here", "use of is a b c d granted here", "use of is a granted x y here"]
    for text in good:
        words = text.encode().split()
        assert t.match(words, 0) == len(words), text
    for text in bad:
        assert t.match(text.encode().split(), 0) == 0, text


@pytest.mark.parametrize("name", list(licenses.TEMPLATES))
def test_every_template_has_a_text(name):
    import re

    plain = re.sub(r"\[\[.*?\]\](?!\])", "", licenses.TEMPLATES[name].replace("]]]]", "]]"))
    plain = re.sub(r"\((\w+)\|.*?\)", r"\1", re.sub(r"\{\d+-\d+\}", "somebody", plain)).replace("]]", "")
    words = plain.encode().split()
    found = licenses.Template(licenses.TEMPLATES[name])
    spaced = b" " + b" ".join([b"before", *words, b"after"]) + b" "
    assert (1, len(words)) in found.places([b"before", *words, b"after"], spaced)
    changed = [*words[:-1], b"other"]
    assert not found.places(changed, b" " + b" ".join(changed) + b" ")


GNU = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} as published by
the Free Software Foundation, either version {} of the License, or (at your option) any later version. This program is distributed
in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A
PARTICULAR PURPOSE. See the GNU {} for more details."""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the
License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or
agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF
ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify,
merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to
do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or
substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND"""
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE
AUTHOR DISCLAIMS ALL WARRANTIES"""
BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the
following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the
following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright
holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior
written permission."""
PUBLISHED = [("apache-2.0-notice", APACHE, 0), ("mit", MIT, 0), ("isc", ISC, 0), ("bsd", BSD, 0)]
PUBLISHED += [
    (f"{label}-terms", GNU.format(name, version, name), 7)
    for label, name, version in [
        ("gpl-2.0", "General Public License", "2"), ("gpl-3.0", "General Public License", "3"),
        ("lgpl-2.0", "Library General Public License", "2"), ("lgpl-2.1", "Lesser General Public License", "2.1"),
        ("lgpl-3.0", "Lesser General Public License", "3"), ("agpl-3.0", "Affero General Public License", "3"),
    ]
]
PUBLISHED += [
    (f"cc-{label}-{version}-name", f"This work is licensed under a Creative Commons {name} {version} {kind} License.", 6)
    for version, kind in (("2.0", "Generic"), ("2.5", "Generic"), ("3.0", "Unported"), ("4.0", "International"))
    for label, name in [
        ("by", "Attribution"), ("by-sa", "Attribution-ShareAlike"), ("by-nd", "Attribution-NoDerivatives"),
        ("by-nc", "Attribution-NonCommercial"), ("by-nc-sa", "Attribution-NonCommercial-ShareAlike"),
        ("by-nc-nd", "Attribution-NonCommercial-NoDerivatives"),
    ]
]


@pytest.mark.parametrize("label,text,first", PUBLISHED)
def test_published_notices(label, text, first):
    """The first span reaches from ``first`` to the end, and no other notice is found, but Apache's short sentence in the whole."""
    words = words_of(text)
    spaced = b" " + b" ".join(words) + b" "
    found = {n: licenses.Template(t).places(words, spaced) for n, t in licenses.TEMPLATES.items()}
    found = {n: p for n, p in found.items() if p}
    assert set(found) - {"apache-2.0"} == {label}
    assert found[label][0] == (first, len(words) - first)


def test_published_notices_in_rows(make_docs):
    rows = licenses.scan_licenses(make_docs(list(enumerate(t for _, t, _ in PUBLISHED)))).collect()
    assert all(PUBLISHED[r.doc_id][0] in r.labels.split(",") and r.score == 1 for r in rows) and len(rows) == len(PUBLISHED)


def test_license_rows(make_docs, odd_docs):
    docs = make_docs(
        [
            (1, "Text. Released under the MIT License. More; mit  license, MIT-license."), (2, "Licensed under CC BY-NC 4.0."),
            (3, "This work is licensed under the GNU General Public License, version 3."), (4, "Licensed under the Apache License, Version 2.0."),
            (5, "apache licenses"), (6, None), (6, None), (None, "cc by cc by"),
        ],
        score="clash",
    )
    rows = {(r.doc_id, r.n_words): (r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score) for r in licenses.scan_licenses(docs).collect()}
    assert rows[1, 11] == (3, 4, 9, "mit", "mit,mit-notice", 1.0)
    assert rows[2, 7] == (1, 2, 2, "cc-by", "cc-by,cc-by-nc-4.0", 1.0)
    assert rows[3, 12] == (1, 6, 6, "gpl", "gpl,gpl-3.0", 1.0)
    assert rows[4, 8] == (1, 3, 3, "apache", "apache,apache-2.0", 1.0)
    assert rows[5, 2] == rows[6, 0] == (0, None, None, "", "", 0.0)
    assert rows[None, 4] == (2, 0, 2, "cc-by", "cc-by", 0.5)
    assert licenses.scan_licenses(odd_docs).count() == odd_docs.count()
    assert licenses.scan_licenses(odd_docs.limit(0)).count() == 0


def test_base_places_against_brute_force():
    random.seed(6)
    pool = ["mit", "license", "cc", "by", "apache", "gnu", "general", "public", "x"]
    for _ in range(200):
        words = [w.encode() for w in random.choices(pool, k=random.randint(0, 40))]
        spaced = b" " + b" ".join(words) + b" "
        for phrase in licenses.PHRASES:
            own = phrase.encode().split()
            want = [i for i in range(len(words)) if words[i : i + len(own)] == own]
            found = licenses._phrase_places(spaced, b" " + phrase.encode() + b" ")
            assert [spaced.count(b" ", 0, p) for p in found] == want
