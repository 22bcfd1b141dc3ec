import hashlib
import re

from creelgrid.llm import exact_dedup


def brute(rows):
    groups = {}
    for i, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text or ""), []).append((-len(text or ""), i is None, i if i is not None else 0))
    out = []
    for i, text in rows:
        plain = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        best = min(groups[plain])
        keep = None if best[1] else best[2]
        out.append((i, keep, len(groups[plain]), i == keep, hashlib.sha256(plain.encode()).hexdigest()))
    return sorted(out, key=repr)


def result(docs):
    return sorted((tuple(r) for r in exact_dedup.exact_duplicates(docs).collect()), key=repr)


def test_against_brute_force(odd_docs):
    assert result(odd_docs) == brute([(r.doc_id, r.text) for r in odd_docs.collect()])


def test_frequent_and_rare_digests(make_docs):
    rows = [(i, "hot text") for i in range(400)] + [(1000 + i, f"text {i // 2}" + " " * (i % 2)) for i in range(600)]
    assert result(make_docs(rows)) == brute(rows)


def test_without_the_frequent_path(make_docs, monkeypatch):
    rows = [(i, f"t{i % 50}") for i in range(300)]
    monkeypatch.setattr(exact_dedup, "HEAVY", 2)
    assert result(make_docs(rows)) == brute(rows)


def test_empty(make_docs):
    assert result(make_docs([])) == []


def test_no_python_in_the_plan(make_docs):
    plan = exact_dedup.exact_duplicates(make_docs([(1, "a")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_rows_that_stay(odd_docs):
    kept = exact_dedup.drop_exact_duplicates(odd_docs)
    assert kept.columns == odd_docs.columns
    rows = [(r.doc_id, (r.text or "")[:20]) for r in kept.collect()]
    assert len(rows) == len(set(rows)) and (3, " \t\n") in rows and (1, "") not in rows
    assert [r for r in rows if r[0] in (5, 6)] == [(5, "The same text here, ")]
