import hashlib
import sys
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from creelgrid.llm import queries  # noqa: E402

from .test_near_dedup import classes  # noqa: E402
from .test_search import brute  # noqa: E402
from .test_tokens import tiktoken_encoding  # noqa: E402, F401


@pytest.fixture
def sf_dir(spark, tmp_path):
    """A small documents table with cases for every stage."""
    passage = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron"
    english = [f"the cat number {i} sat on the warm mat and looked at the tall tree near house {i * 7}" for i in range(8)]
    german = [f"der hund nummer {i} lief durch den garten und sah die alte katze am haus {i * 3}" for i in range(8)]
    rows = [(i, t, "en" if i < 8 else "de", "s", len(t)) for i, t in enumerate(english + german)]
    long = " ".join(f"tree house cat mat number looked warm {k}" for k in range(40))
    rows += [
        (100, long, "en", "s", 1), (101, long + "  ", "en", "s", 1), (102, long.replace("warm 7 ", "cold 7 "), "en", "s", 1),
        (103, passage, "en", "s", 1), (104, "?!? 123", None, "s", 1), (105, None, None, None, None), (101, long + "  ", "en", "s", 1),
    ]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([("b1", passage)], "item_id string, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    return str(tmp_path), rows, passage


def test_run_against_brute_force(spark, sf_dir, tiktoken_encoding):  # noqa: F811
    folder, rows, passage = sf_dir
    left = {r[0]: r[1] for r in rows if r[0] not in (104, 105)}  # no letter or no text
    best = {}
    for i, t in left.items():
        plain = "".join(t.split())
        best[plain] = min(best.get(plain, (0, 0)), (-len(t), i)) if plain in best else (-len(t), i)
    left = {i: t for i, t in left.items() if best["".join(t.split())][1] == i}
    same = classes(sorted(left.items()))
    left = {i: t for i, t in left.items() if same[i] == i}
    left = {i: t for i, t in left.items() if not brute(t, [("b1", passage)])[3]}
    want = {}
    for i, t in left.items():
        ids = tiktoken_encoding.encode_ordinary(t)
        want[i] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())
    got = corpus_pipeline.run(spark, folder)
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got.collect()} == want
    assert 102 not in want and 103 not in want and 100 not in want and 101 in want
    assert got.count() == len(want)


def test_stages_keep_the_columns(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir[0]}/documents.parquet")
    clash = docs.selectExpr("*", "1 as kept", "'x' as text_sha256", "2 as lang_pred", "3 as spans", "4 as class_id")
    for rows in (docs, clash, clash.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, rows, sf_dir[0])
            assert out.columns == rows.columns, name
            assert out.count() <= rows.count()


def test_one_query_for_each_operator():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES)
    assert numbers == list(range(1, 14)) and len(corpus_pipeline.STAGES) == 5


def test_without_the_subpackage(tmp_path):
    """The entry, without the text operators, still gives the other queries."""
    import shutil
    import subprocess

    root = Path(__file__).resolve().parents[2]
    for part in ("creelgrid", "probes", "__spark_entry__.py"):
        source = root / part
        if source.is_dir():
            shutil.copytree(source, tmp_path / part, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        else:
            shutil.copy(source, tmp_path / part)
    code = "import __spark_entry__ as e; assert len(e.queries()) > 70 and not [q for q in e.queries() if q.startswith('op')]"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)})
