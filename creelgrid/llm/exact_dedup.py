"""Exact duplicates, with the frequent digests split off before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from creelgrid.session import stage_table

#: Digests that the frequent-item summary tracks, and the most of them that are split off. At most
#: ``HEAVY`` winners are broadcast, whatever the input; a digest that is missed goes the ordinary way.
TRACKED = 4096
HEAVY = 256

_SPACES = " \t\n\x0b\x0c\r"


def normalised(text: Column) -> Column:
    """The text without the characters ``[\\x20\\x09-\\x0D]``; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), _SPACES, "")


def _best(doc_id: Column, length: Column) -> Column:
    """Orders copies: most code points first, then the smallest id; rows without an id come last."""
    return F.struct((-length).alias("short"), doc_id.isNull().alias("anonymous"), doc_id.alias("doc_id"))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they agree without white space (SHA-256 of the rest). Of equal texts the one
    with the most code points stays, then the smallest id. A Misra-Gries summary (``approx_top_k``)
    proposes the frequent digests; exact counts and winners of these, at most ``HEAVY`` rows, are
    broadcast, so that their rows are settled where they lie. The rest shuffles by digest, and no
    group in it can be large.

    Null text is the empty text, and empty texts are copies of each other. A null id can stay only
    when its group has no other id at the same length; ``kept`` is then true of the null rows. Rows
    that repeat an id with the same text are all kept rows if that id is. An empty table gives none.
    """
    digests = stage_table(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.sha2(normalised(F.col(text_col)).cast("binary"), 256).alias("text_sha256"),
            F.coalesce(F.char_length(F.col(text_col)), F.lit(0)).cast("long").alias("length"),
        ),
        "digests",
    )
    frequent = digests.select(F.explode(F.expr(f"approx_top_k(text_sha256, {HEAVY}, {TRACKED})")).alias("f")).select(
        F.col("f.item").alias("text_sha256")
    )
    best = _best(F.col("doc_id"), F.col("length"))
    winners = (
        digests.join(F.broadcast(frequent), "text_sha256", "left_semi")
        .groupBy("text_sha256")
        .agg(F.min(best).alias("best"), F.count("*").alias("group_size"))
    )
    winners = stage_table(winners.filter("group_size > 1"), "winners")

    heavy = digests.join(F.broadcast(winners), "text_sha256")
    group = W.partitionBy("text_sha256")
    rest = (
        digests.join(F.broadcast(winners), "text_sha256", "left_anti")
        .withColumn("best", F.min(best).over(group))
        .withColumn("group_size", F.count("*").over(group))
    )
    return heavy.unionByName(rest).select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        F.col("group_size").cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("best.doc_id")).alias("kept"),
        "text_sha256",
    )


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; of rows that repeat an id and a text, one."""
    found = stage_table(exact_duplicates(docs, id_col, text_col).filter("kept"), "kept")
    keys = found.select(F.col("doc_id").alias("kept_id"), F.col("text_sha256").alias("kept_digest"))
    own = docs.withColumn("kept_digest", F.sha2(normalised(F.col(text_col)).cast("binary"), 256))
    same = (own[id_col].eqNullSafe(F.col("kept_id"))) & (own["kept_digest"] == keys["kept_digest"])
    kept = own.join(keys, same, "left_semi")
    repeated = stage_table(keys.groupBy("kept_id", "kept_digest").count().filter("count > 1"), "repeated")
    if not repeated.isEmpty():
        twice = (own[id_col].eqNullSafe(repeated["kept_id"])) & (own["kept_digest"] == repeated["kept_digest"])
        kept = kept.join(repeated, twice, "left_anti").unionByName(kept.join(repeated, twice, "left_semi").dropDuplicates([id_col, "kept_digest"]))
    return kept.select(*docs.columns)
