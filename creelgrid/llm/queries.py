"""The driver's queries on the text operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creelgrid.session import configure

from . import (
    byte_bpe,
    decontaminate,
    exact_dedup,
    hard_negatives,
    language,
    licenses,
    near_dedup,
    pitman_yor,
    ranked_search,
    repeated_bytes,
    token_files,
    toxicity,
    word_pieces,
)
from .base import fold, ship, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return build(configure(spark), str(sf_dir))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


@query(
    "op10_exact_dedup",
    r"""
    with d as (
      select doc_id, length(coalesce(text, '')) as n,
             sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) as text_sha256
      from documents
    )
    select doc_id, first_value(doc_id) over (partition by text_sha256 order by n desc, doc_id) as keep_id,
           count(*) over (partition by text_sha256) as group_size,
           doc_id = first_value(doc_id) over (partition by text_sha256 order by n desc, doc_id) as kept, text_sha256
    from d
    """,
)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


@query("op2_token_files")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op4_byte_bpe")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = byte_bpe.encode_decode(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    )
    return coded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


@query(
    "op5_decontaminate",
    r"""
    with d as (
      select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents
    ), b as (
      select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark
    ), windows as (
      select distinct item_id, least(13, len(w)) as n, array_to_string(w[i : i + least(13, len(w)) - 1], ' ') as g
      from (select item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) as i from b where len(w) > 0)
    ), grams as (
      select doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') as g
      from (select doc_id, w, n, unnest(range(1, greatest(1, len(w) - n + 2))) as i
            from d, (select distinct n from windows))
    ), found as (
      select doc_id, n, i, item_id from grams join windows using (n, g)
    ), hits as (
      select doc_id, count(distinct p) as n_hit
      from (select doc_id, unnest(range(i, i + n)) as p from (select distinct doc_id, n, i from found)) group by doc_id
    ), items as (
      select doc_id, count(*) as n_items, string_agg(item_id, ',' order by item_id) as names
      from (select distinct doc_id, cast(item_id as varchar) as item_id from found) group by doc_id
    )
    select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
           sha256(coalesce(names, '')) as items_sha256,
           coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
    from d left join hits using (doc_id) left join items using (doc_id)
    """,
)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"), "contaminated",
    )


@query("op7_licenses")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents")).drop("spans")


@query("op6_language")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", fold(F.col("doc_id"), 3) == 1)
    slices = language.train(docs.filter(~F.col("held_out")))
    return language.predict(docs, slices, ["doc_id", "held_out"]).drop("share")


@query("op8_toxicity")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id"), 3) == 1
    machine = toxicity.train(docs.filter(~held_out), table(spark, sf_dir, "labels").filter(~held_out))
    return toxicity.score(docs, machine).select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query("op1_word_pieces")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_pieces.count_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


@query("op3_near_dedup")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


@query("op9_language_model")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("train", fold(F.col("doc_id"), 10) != 0)
    return pitman_yor.score(docs).select(
        "doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


@query(
    "op11_repeated_bytes",
    r"""
    with d as (
      select row_number() over () as r, doc_id, hex(encode(coalesce(text, ''))) as h from documents
    ), windows as (
      select r, i, md5(substr(h, 2 * i + 1, 800)) as k
      from (select r, h, unnest(range(0, cast(len(h) // 2 as bigint) - 399)) as i from d where len(h) >= 800)
    ), repeated as (
      select r, i from (select r, i, count(*) over (partition by k) as n from windows) where n > 1
    ), marked as (
      select r, i, case when i <= lag(i) over (partition by r order by i) + 400 then 0 else 1 end as fresh from repeated
    ), numbered as (
      select r, i, sum(fresh) over (partition by r order by i) as span from marked
    ), spans as (
      select r, min(i) as a, max(i) + 400 as b from numbered group by r, span
    ), pieces as (
      select r, a, b, coalesce(lag(b) over (partition by r order by a), 0) as before from spans
    ), kept as (
      select d.r, sum(b - a) as n_removed, count(*) as n_spans,
             string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' order by a) || substr(any_value(h), 2 * max(b) + 1) as rest
      from pieces join d using (r) group by d.r
    )
    select doc_id, cast(len(h) // 2 as bigint) as n_bytes, cast(coalesce(n_removed, 0) as bigint) as n_removed,
           coalesce(n_spans, 0) as n_spans, sha256(unhex(coalesce(rest, h))) as kept_sha256
    from d left join kept using (r)
    """,
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated_bytes.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query(
    "op12_hard_negatives",
    """
    with v as (
      select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
             list_transform(embedding, lambda x: floor(256 * x::double)) as e
      from embeddings
      where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    ), s as (
      select a.vec_id as a, v.vec_id as b, a.label = v.label as same, cast(list_inner_product(a.e, v.e) as bigint) as s
      from v as a, v where a.vec_id % 50 = 0
    ), p as (
      select a, b as p, s as ps from s where same and b <> a
      qualify row_number() over (partition by a order by s desc, b) <= 5
    )
    select a as anchor_id, p as positive_id, cast(row_number() over (partition by a, p order by s desc, b) as integer) as rank,
           b as negative_id, ps as positive_score, s as negative_score
    from p join s using (a) where not same and 50 * ps <= 100 * s and 100 * s <= 95 * ps
    qualify rank <= 3
    """,
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings").withColumn("label", label))


@query(
    "op13_ranked_search",
    r"""
    with t as (
      select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
      from documents
    ), tf as (
      select doc_id, term, count(*) as tf from t group by all
    ), size as (
      select doc_id, cast(sum(tf) as bigint) as n from tf group by doc_id
    ), total as (
      select count(*) as docs, cast(sum(n) as bigint) as l from size
    ), w as (
      select term, cast(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) as bigint) as w from tf, total group by term, docs
    ), q as (
      select distinct item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
      from benchmark
    ), scored as (
      select item_id, doc_id, cast(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // l)))) as bigint) as score
      from q join tf using (term) join w using (term) join size using (doc_id), total group by item_id, doc_id
    )
    select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id) as integer) as rank, doc_id, score
    from scored where score > 0
    qualify rank <= 50
    """,
)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
