"""Queries over the tables ``documents``, ``pages`` and ``embeddings``, one
for each operator, and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import encoding, langid, licences, mixing, negatives, neighbours, pii, simhash, spotsigs, suffixes, urls, variants, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.removed(table(spark, sf_dir, "documents"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.range(1).select(F.inline(F.array(*[F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(v).alias("verdict")) for h, p, v in urls.RULES])))
    return urls.judge(table(spark, sf_dir, "pages").select("page_id", "url"), rules).drop("url")


def op6_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.groups(table(spark, sf_dir, "documents"), shingle=3, radius=2)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op7_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.edited_fingerprints(table(spark, sf_dir, "documents"))


def op8_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding.encode_documents(table(spark, sf_dir, "documents"))


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


def op11_warc_writer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.report(table(spark, sf_dir, "pages"), at_least=0)


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.variants(table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label=label)


QUERIES = {f.__name__: f for f in (op1_licence_scan, op2_mix_sources, op3_language_id, op4_suffix_dedup, op5_url_filter, op6_simhash_dedup, op7_spotsigs, op8_prefix_forest, op9_sentencepiece, op10_personal_data, op11_warc_writer, op12_spelling_variants, op13_hard_negatives)}
ORACLE_SQL = {"op2_mix_sources": mixing.REPORT_SQL, "op5_url_filter": urls.JUDGE_SQL, "op7_spotsigs": spotsigs.EDITED_SQL, "op11_warc_writer": warc.REPORT_SQL, "op12_spelling_variants": variants.VARIANTS_SQL, "op13_hard_negatives": negatives.MINE_SQL}
