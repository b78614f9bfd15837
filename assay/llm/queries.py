"""The operators' queries over the registered tables, and their SQL where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.llm import decontamination, divergence, html_text, kmeans, language, licenses, mixing, neighbours, quality_gam, quality_rules, repeats, secrets, simhash
from assay.llm.common import read
from assay.llm.oracle import ORACLE_SQL as ORACLE_SQL


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")
    return decontamination.digest(decontamination.decontaminate(docs, items))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.apply_rules(read(spark, sf_dir, "documents")).drop("cleaned")


def op3_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = quality_gam.train(docs, read(spark, sf_dir, "labels"))
    scored = quality_gam.predict(docs, model)
    return scored.select("doc_id", quality_gam.held_out().alias("held_out"), "score", "predicted")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(read(spark, sf_dir, "documents")))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = language.train(docs.where(~language.held_out()))
    found = language.predict(docs, model)
    return found.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score")


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read(spark, sf_dir, "documents")).drop("detections")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(mixing.mix(read(spark, sf_dir, "documents")))


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(read(spark, sf_dir, "pages"))


def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = repeats.remove_repeats(read(spark, sf_dir, "documents"))
    return result.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read(spark, sf_dir, "documents"))


def op12_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kmeans.cluster(read(spark, sf_dir, "embeddings"))


def op13_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(read(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_decontamination, op2_quality_rules, op3_quality_gam, op4_simhash, op5_secrets,
        op6_language, op7_licenses, op8_mixing, op9_html_text, op10_repeats,
        op11_divergence, op12_clusters, op13_neighbours,
    )
}
