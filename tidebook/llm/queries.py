"""The queries of this subpackage: name -> function of (spark, sf_dir), and DuckDB SQL where it can express one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_best_two_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidebook.llm import packing

    out = packing.pack_documents(_docs(spark, sf_dir), keep_ids=False)
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op2_gear_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidebook.llm import chunk_dedup

    return chunk_dedup.repeats(_docs(spark, sf_dir))


def op3_cotrained_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidebook.llm import cotraining

    docs = _docs(spark, sf_dir).select("doc_id", "text", "lang", "source", "n_chars")
    out = cotraining.scored(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return out.select("doc_id", "score", (F.col("score") >= cotraining.THRESHOLD).alias("kept"))


def op4_qgram_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidebook.llm import decontaminate

    return decontaminate.contaminated(_docs(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet")).drop("row_digest")


def op5_chosen_path_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidebook.llm import chosen_path

    return chosen_path.near_duplicates(_docs(spark, sf_dir))


def op7_merkle_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidebook.llm import merkle

    out = merkle.edited_fingerprints(_docs(spark, sf_dir))
    return out.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint", "near_edited", "near_next", "edits")


def op10_bootstrapped_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidebook.llm import pii

    out = pii.extract(_docs(spark, sf_dir))
    counts = [F.expr(f"cast(size(filter(base, s -> s.kind = '{k}')) as long)").alias(f"n_{k}") for k in pii.KINDS]
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    return out.select("doc_id", *counts, F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.concat("base", "found")).alias("spans"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidebook.llm import licenses

    out = licenses.scan(_docs(spark, sf_dir))
    starts, base = F.transform("places", lambda p: p["start"]), F.transform("places", lambda p: p["label"])
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    return out.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        joined(base).alias("base_labels"), joined(F.concat(base, "found")).alias("labels"), "score",
    )


def _remainder(column: str, by: int):
    """crc32 of an id as text, modulo ``by``."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % by


def op8_kneser_ney_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidebook.llm import kneser_ney

    held_out = _remainder("doc_id", 5) == 1
    out = kneser_ney.scored(_docs(spark, sf_dir), ~held_out)
    return out.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op9_crf_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidebook.llm import toxic_crf

    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    out = toxic_crf.toxicity(_docs(spark, sf_dir), labels, _remainder("doc_id", 3) != 1)
    offsets = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",")
    return out.select("doc_id", (_remainder("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= toxic_crf.THRESHOLD).cast("int").alias("predicted"), offsets.alias("toxic_spans"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in globals().items() if k.startswith("op") and callable(f)}


#: Near-duplicates in DuckDB: whole shingle sets, every pair that shares a shingle, reachability.
NEAR_DUPLICATES = r"""
with recursive words as (select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents),
sets as (select doc_id, list_distinct(case when len(w) >= 5 then list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as s from words),
shingles as (select doc_id, unnest(s) as s from sets),
pairs as (select a.doc_id as a, b.doc_id as b, count(*) as n from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id group by 1, 2),
links as (select a, b from pairs p join sets x on x.doc_id = p.a join sets y on y.doc_id = p.b where 100 * p.n >= 75 * (len(x.s) + len(y.s) - p.n)),
ways as (select a, b from links union all select b, a from links),
reached as (select doc_id as id, doc_id as root from sets union select w.b, r.root from reached r join ways w on w.a = r.id),
components as (select id, min(root) as component_id from reached group by 1)
select doc_id, len(s)::bigint as n_shingles, component_id, doc_id = component_id as kept from sets join components on id = doc_id
"""


def oracle_sql() -> dict[str, str]:
    """Of the ten only near-duplicates: models, tokenisers and digests aren't SQL; tests hold the others against plain versions."""
    return {"op5_chosen_path_near_dedup": NEAR_DUPLICATES}
