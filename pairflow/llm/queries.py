"""The registered queries of this subpackage and, where SQL can express them, their SQL."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairflow.llm import bpe, fim, iblt, langid, licenses, mixing, packing, repair, search, sharding, simhash, toxicity, wordpiece
from pairflow.llm.base import documents, fold, labels

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op1_bm25_top_k(spark: SparkSession, d: str) -> DataFrame:
    """Every document whose id is divisible by 50 asks all documents."""
    docs = documents(spark, d)
    found = search.search(docs, docs.where("doc_id % 50 = 0"))
    return found.select(F.col("query").alias("query_id"), "rank", F.col("id").alias("doc_id"), F.round("score", 6).alias("score"))


def op2_token_counts(spark: SparkSession, d: str) -> DataFrame:
    return wordpiece.token_counts(documents(spark, d), RANKS)


def op3_best_fit_packing(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(documents(spark, d))


def op4_language_id(spark: SparkSession, d: str) -> DataFrame:
    docs = documents(spark, d).select("doc_id", "text", "lang", fold("doc_id", 3).alias("fold"))
    model = langid.train(docs.where("fold <> 1"))
    found = langid.predict(model, docs.select("doc_id", "fold", "text"))
    return found.select(
        "doc_id",
        (F.col("fold") == 1).alias("held_out"),
        F.col("p.lang").alias("lang_pred"),
        F.col("p.score").alias("score"),
        F.col("p.hit").alias("hit_rate"),
    )


def op5_simhash_near_dedup(spark: SparkSession, d: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, d)).select("doc_id", "fingerprint", "component_id")


def op6_lm_scoring(spark: SparkSession, d: str) -> DataFrame:
    held_out = fold("doc_id", 5) == 1
    rows = mixing.score(documents(spark, d), ~held_out, "lang", occurrences=True, in_order=True)
    return rows.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte")


def op7_byte_bpe(spark: SparkSession, d: str) -> DataFrame:
    rows = documents(spark, d).select("doc_id", bpe.round_trip(F.col("text"), RANKS, public_tokenizers.PATTERN).alias("t"))
    return rows.select(
        "doc_id",
        (F.length("t.ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("t.ids", 256).alias("ids_sha256"),
        F.sha2("t.decoded", 256).alias("decoded_sha256"),
    )


def op8_document_fingerprints(spark: SparkSession, d: str) -> DataFrame:
    return iblt.fingerprints(documents(spark, d))


def op9_license_scan(spark: SparkSession, d: str) -> DataFrame:
    return licenses.scan(documents(spark, d))


def op10_toxicity(spark: SparkSession, d: str) -> DataFrame:
    docs = documents(spark, d)
    model = toxicity.train(docs, labels(spark, d).where(fold("doc_id", 5) != 0))
    found = docs.select("doc_id", toxicity.score(model, spark, F.col("text")).alias("f"))
    found = found.select("doc_id", "f", toxicity.probability(model, F.col("f")).alias("score"))
    return found.select(
        "doc_id",
        (fold("doc_id", 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.col("f.n_matches").alias("n_matches"),
    )


def op11_conversation_repair(spark: SparkSession, d: str) -> DataFrame:
    rows = spark.read.parquet(f"{d.rstrip('/')}/conversations.parquet")
    turns = repair.turns_of(repair.damaged(rows), "conv", "turn", "role", "text", "present")
    return repair.digests(turns, repair.audits(turns)).withColumnRenamed("conv", "conv_id")


def op12_fill_in_middle(spark: SparkSession, d: str) -> DataFrame:
    rows = fim.transform(documents(spark, d))
    return rows.select(
        F.col("id").alias("doc_id"),
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fim.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


def op13_sharding(spark: SparkSession, d: str) -> DataFrame:
    """Whole documents, shuffled and written as shards; the digests are of what the shards hold."""
    rows = sharding.written(documents(spark, d))
    text = F.coalesce("text", F.lit(""))
    return rows.select(
        "doc_id",
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_bm25_top_k,
        op2_token_counts,
        op3_best_fit_packing,
        op4_language_id,
        op5_simhash_near_dedup,
        op6_lm_scoring,
        op7_byte_bpe,
        op8_document_fingerprints,
        op9_license_scan,
        op10_toxicity,
        op11_conversation_repair,
        op12_fill_in_middle,
        op13_sharding,
    )
}
ORACLE: dict = {
    "op12_fill_in_middle": """
        with d as (select doc_id, coalesce(text, '') as t, sha256('7:' || doc_id) as h from documents),
        l as (select *, regexp_extract_all(t, '[^\n]*\n|[^\n]+') as ls,
                     [('0x' || h[8 * i - 7 : 8 * i])::bigint for i in range(1, 5)] as r from d),
        c as (select *, len(ls) as n, least(r[1] % (len(ls) + 1), r[2] % (len(ls) + 1)) as a,
                     greatest(r[1] % (len(ls) + 1), r[2] % (len(ls) + 1)) as b from l),
        p as (select doc_id, t, n, array_to_string(ls[1 : a], '') as p, array_to_string(ls[a + 1 : b], '') as m,
                     array_to_string(ls[b + 1 : n], '') as s,
                     case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or r[3] % 100 >= 100 then 'plain'
                          when r[4] % 100 < 50 then 'spm' else 'psm' end as form from c)
        select doc_id, n::bigint as n, form, case when form <> 'plain' then length(p) end::bigint as prefix_chars,
               case when form <> 'plain' then length(m) end::bigint as middle_chars,
               sha256(case form when 'plain' then t when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m
                      else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
               sha256(t) as restored_sha256
        from p""",
}
