import random

import numpy as np
import pytest

from creelgrid.llm import repeated_bytes
from creelgrid.llm.suffix_groups import lyndon_groups, suffix_array


def texts(seed, n=400):
    random.seed(seed)
    for _ in range(n):
        size = random.randint(0, 50)
        symbols = [random.randint(0, random.choice([1, 2, 4])) for _ in range(size)]
        yield (symbols[: random.randint(1, 7)] * 50)[:size] if random.random() < 0.3 else symbols


def test_suffix_array_against_sorting():
    for symbols in texts(1):
        assert suffix_array(np.array(symbols, np.int64)) == sorted(range(len(symbols)), key=lambda i: symbols[i:])


def test_groups_are_lyndon_prefixes():
    for symbols in texts(2, 100):
        _, group, smaller = lyndon_groups(np.array(symbols, np.int64))
        n = len(symbols)

        def prefix(i, n=n, symbols=symbols):
            return next(symbols[i:j] for j in range(n, i, -1) if all(symbols[i:j] < symbols[k:j] for k in range(i + 1, j)))

        prefixes = [prefix(i) for i in range(n)]
        for i in range(n):
            assert all((prefixes[i] < prefixes[j]) == (group[i] < group[j]) for j in range(n))
            assert smaller[i] == max((j for j in range(i) if prefixes[j] < prefixes[i]), default=-1)


def test_anchors_depend_on_the_window_alone():
    random.seed(3)
    for size, length, anchor in ((3000, 40, 12), (900, 40, 39), (39, 40, 12), (40, 40, 12)):
        data = bytes(random.choices(b"ab", k=size)) + b"ab" * 30
        first, last, at, keys = repeated_bytes.anchored_runs(data, length, anchor)
        covered = [i for a, b in zip(first, last) for i in range(a, b + 1)]
        assert covered == list(range(len(data) - length + 1))
        known = {}
        for a, b, p, k in zip(first.tolist(), last.tolist(), at.tolist(), keys.tolist()):
            for s in range(a, b + 1):
                assert s <= p and p + anchor <= s + length
                assert known.setdefault(data[s : s + length], (p - s, k)) == (p - s, k)


def test_pieces_of_a_long_text(monkeypatch):
    data = bytes(random.Random(4).choices(b"abc", k=5000))
    whole = repeated_bytes.anchored_runs(data, 40, 12)
    monkeypatch.setattr(repeated_bytes, "PIECE", 700)
    repeated_bytes._powers.cache_clear()
    pieces = repeated_bytes.anchored_runs(data, 40, 12)
    repeated_bytes._powers.cache_clear()

    def per_window(runs):
        return [(p, k) for a, b, p, k in zip(*(x.tolist() for x in runs)) for _ in range(a, b + 1)]

    assert per_window(whole) == per_window(pieces)


def brute(rows, length):
    counts = {}
    encoded = [(i, (t or "").encode()) for i, t in rows]
    for _, data in encoded:
        for s in range(len(data) - length + 1):
            counts[data[s : s + length]] = counts.get(data[s : s + length], 0) + 1
    out = []
    for i, data in encoded:
        gone = bytearray(len(data))
        for s in range(len(data) - length + 1):
            if counts[data[s : s + length]] > 1:
                gone[s : s + length] = b"\x01" * length
        runs = bytes(gone).split(b"\x00")
        out.append((i, len(data), sum(gone), sum(1 for r in runs if r), bytes(b for b, g in zip(data, gone) if not g)))
    return sorted(out, key=repr)


def result(docs, *sizes):
    found = repeated_bytes.remove_repeats(docs, "doc_id", "text", *sizes).collect()
    for r in found:
        assert sum(r.spans[1::2]) - sum(r.spans[::2]) == r.n_removed and r.spans == sorted(r.spans)
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in found), key=repr)


@pytest.mark.parametrize("together", [128, 3])
def test_against_brute_force(make_docs, together):
    """Copies, near copies, passages in other surroundings, repeats in one text; with ``together`` 3 all crowded anchors are split."""
    r = random.Random(5)
    some = lambda n: "".join(r.choices("abcdé ", k=n))
    passage, base = some(90), some(400)
    rows = [(i, some(r.randint(0, 60)) + passage + some(r.randint(0, 60))) for i in range(25)]
    rows += [(100 + i, base[: r.randint(0, 400)] + some(3) + base[r.randint(0, 400) :]) for i in range(15)]
    rows += [(200, base), (201, base), (201, base), (None, base), (None, None), (202, ""), (203, "x" * 300), (204, "ab" * 120 + "c" + "ab" * 25)]
    rows += [(300 + i, some(200)) for i in range(10)]
    docs = make_docs(rows, n_bytes="clash", key="clash", found="clash")
    assert result(docs, 60, 24, together) == brute(rows, 60)


def test_later_rounds_read_texts_of_crowded_anchors_alone(make_docs, monkeypatch):
    random.seed(11)
    word = lambda: "".join(random.choices("abcdefgh", k=6))
    passage = " ".join(word() for _ in range(40))
    crowd = [f"{' '.join(word() for _ in range(20))} {passage} {' '.join(word() for _ in range(20))}" for _ in range(8)]
    rows = list(enumerate([*crowd, *(" ".join(word() for _ in range(60)) for _ in range(30))]))
    held = []
    stage = repeated_bytes.stage_table

    def staged(df, name, *more):
        table = stage(df, name, *more)
        if name == "crowded":
            held.append(table.count())
        return table

    monkeypatch.setattr(repeated_bytes, "stage_table", staged)
    assert result(make_docs(rows), 60, 24, 3) == brute(rows, 60)
    assert held and max(held) <= len(crowd)


def test_odd_documents(odd_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert result(odd_docs) == brute(rows, 400)


def test_exactly_the_length(make_docs):
    r = random.Random(6)
    some = lambda n: "".join(r.choices("abcdefgh", k=n))
    passage = some(400)
    rows = [(1, "p" + passage + "q"), (2, "r" + passage + "s"), (3, "t" + passage[:399] + "u"), (4, passage[:399])]
    assert [x[2] for x in result(make_docs(rows))] == [400, 400, 0, 0]


def test_empty(make_docs):
    assert result(make_docs([])) == []
    assert result(make_docs([(1, None)])) == [(1, 0, 0, 0, b"")]
