"""A training corpus from raw documents: language, copies, near copies, benchmark passages, token ids."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creelgrid.llm import byte_bpe, decontaminate, exact_dedup, language, near_dedup
from creelgrid.llm.base import named, numbered, ship, table
from creelgrid.session import configure, stage_table


def _place(docs: DataFrame, column: str) -> str:
    return f"c{docs.columns.index(column)}"


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts that are ``und`` or hold hardly an n-gram of any language; learns from the rows given."""
    ship(configure(spark))
    rows = numbered(docs)
    slices = language.train(docs)
    found = language.predict(rows, slices, rows.columns, _place(docs, "text"))
    return named(found.filter(~language.rejected(F.col("lang_pred"), F.col("share"))), docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of texts that are equal but for white space stays."""
    configure(spark)
    return exact_dedup.drop_exact_duplicates(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each class stays; rows without an id are not judged."""
    ship(configure(spark))
    found = near_dedup.near_duplicates(docs)
    dropped = found.filter(~F.col("kept") & F.col("doc_id").isNotNull()).select("doc_id").distinct()
    return docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops contaminated documents: a twentieth of the words or more lie in benchmark windows."""
    ship(configure(spark))
    rows = numbered(docs)
    found = decontaminate.contamination(
        rows, table(spark, sf_dir, "benchmark"), id_col=_place(docs, "doc_id"), text_col=_place(docs, "text"), extra=tuple(rows.columns)
    )
    return named(found.filter(~F.col("contaminated")), docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text that is left, with digests of them and of what they decode to."""
    ship(configure(spark))
    coded = byte_bpe.encode_decode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    digests = (F.sha2(c, 256).alias(f"{c}_sha256") for c in ("ids", "decoded"))
    return coded.select("doc_id", "n_tokens", *digests)


STAGES = [
    ("language", known_language),
    ("exact", exact_copies),
    ("near", near_copies),
    ("benchmark", no_benchmark),
    ("tokens", token_ids),
]

#: The language stage learns a filter, which SQL cannot express; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each result is a written table that the next stage reads."""
    docs = table(spark, str(sf_dir), "documents")
    for name, stage in STAGES[:-1]:
        docs = stage_table(stage(spark, docs, str(sf_dir)), name)
    return STAGES[-1][1](spark, docs, str(sf_dir))
