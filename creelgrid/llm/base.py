"""What the text operators share: tables, folds, byte-wise words, Arrow batches by size."""

from __future__ import annotations

import ctypes
import shutil
import tempfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a task holds as Python strings at once; one longer text is a batch of its own.
BATCH_BYTES = 4 << 20

#: Lower-cases A-Z, keeps 0-9, a-z and every byte of a character beyond ASCII, and turns the rest into
#: spaces: what is left between spaces are the words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``.
WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


_caches: dict[str, Callable[[], None]] = {}
_working: list[str | None] = [None]


def remembers(operator: str, forget: Callable[[], None]) -> None:
    """An operator keeps something in a worker from task to task; ``forget`` drops it."""
    _caches[operator] = forget


def working(operator: str) -> None:
    """Called in a task before an operator uses what it keeps: a reused worker drops what all others kept."""
    if _working[0] != operator:
        _working[0] = operator
        for other, forget in _caches.items():
            if other != operator:
                forget()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc keeps what was freed for itself
        if trim is not None:
            trim(0)


_shipped: dict[str, tempfile.TemporaryDirectory] = {}


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application, as ``--py-files`` would."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        _shipped[app] = folder = tempfile.TemporaryDirectory(prefix="creelgrid-py-")
        package = Path(__file__).resolve().parents[1]
        tree = shutil.copytree(package, f"{folder.name}/tree/{package.name}", ignore=shutil.ignore_patterns("__pycache__"))
        spark.sparkContext.addPyFile(shutil.make_archive(f"{folder.name}/{package.name}", "zip", Path(tree).parent))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def numbered(df: DataFrame) -> DataFrame:
    """The columns as c0, c1, ..., which clash with no column that an operator adds."""
    return df.toDF(*(f"c{i}" for i in range(len(df.columns))))


def named(df: DataFrame, like: DataFrame) -> DataFrame:
    """Columns c0, c1, ... under the names of ``like`` again."""
    return df.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(like.columns)))


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id falls in fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts, F.lit(0))


def words_of(text: str | None) -> list[bytes]:
    """The words of a text in UTF-8, A-Z lower-cased; none for null."""
    return (text or "").encode("utf-8", "replace").translate(WORD_BYTES).split()


def by_size(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of Arrow batches whose ``column`` holds about ``most`` bytes (a longer text stands alone)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        start = held = 0
        for i, length in enumerate(lengths.tolist()):
            if held and held + length > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += length
        yield batch.slice(start)


def map_arrow(df: DataFrame, run, schema: str) -> DataFrame:
    """``run`` over Arrow batches of bounded text size."""
    return df.mapInArrow(lambda batches: run(by_size(batches)), schema)
