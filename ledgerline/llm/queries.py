"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import (centroids, decontaminate, html_extract, language_id, lm_score, mixing, ngram_join,
                            projection_search, quality_rules, rule_ensemble, spelling, url_filter, warc_store)
from ledgerline.llm.common import checkpointed, crc_rest
from ledgerline.llm.oracles import SPELLING_SQL, WARC_SQL, centroid_sql, leaks_sql, url_sql
from ledgerline.llm.stats import text_stats
from ledgerline.session import read_table, shared_folder

# The lists of op8: rules as (host, path, verdict), and hosts that are blocked anyway.
URL_RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block"))
BLOCKED_NAMES = ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")
BLOCKED_HOSTS = tuple(f"{n}.example.{t}" for n in BLOCKED_NAMES for t in ("com", "net", "org"))


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_posteriors(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "votes", "posterior")


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "class_id", "n_links", "n_copies")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = language_id.train(language_id.sample_windows(docs, crc_rest(F.col("doc_id"), 3) != 1))
    return language_id.identify(docs, model).select(
        "doc_id", (crc_rest(F.col("doc_id"), 3) == 1).alias("held_out"), "lang_pred", "score")


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(read_table(spark, sf_dir, "documents"), crc_rest(F.col("doc_id"), 10) == 0)


def op7_warc_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "warc")
    warc_store.write_archive(read_table(spark, sf_dir, "pages"), folder)
    return warc_store.read_records(spark, folder).select(
        F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to", "target_uri")


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = [url_filter.Entry(*r) for r in URL_RULES]
    entries += [url_filter.Entry(h, "", "block", listed=True) for h in BLOCKED_HOSTS]
    return url_filter.judge_urls(read_table(spark, sf_dir, "pages"), url_filter.build_index(spark, entries))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    stats = checkpointed(docs.select("doc_id", text_stats(F.col("text")).alias("s"))
                         .select("doc_id", *rule_ensemble.features(F.col("s"))))
    model = rule_ensemble.fit(*rule_ensemble.training_rows(stats, labels.where(crc_rest(F.col("doc_id"), 5) != 0)))
    return stats.select("doc_id", (crc_rest(F.col("doc_id"), 5) == 0).alias("held_out"),
                        model.score().alias("score")).withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op10_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_pages(read_table(spark, sf_dir, "pages"))


def op11_centroid_cluster(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster_vectors(read_table(spark, sf_dir, "embeddings")).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op12_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projection_search.nearest_vectors(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_quality_rules, op2_mix_sources, op3_decontaminate, op4_ngram_join, op5_language_id, op6_lm_score,
        op7_warc_store, op8_url_filter, op9_quality_classifier, op10_html_extract, op11_centroid_cluster,
        op12_nearest_vectors, op13_spelling_variants)}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return {"op3_decontaminate": leaks_sql("documents"), "op7_warc_store": WARC_SQL,
            "op8_url_filter": url_sql(URL_RULES, BLOCKED_HOSTS), "op11_centroid_cluster": centroid_sql(),
            "op13_spelling_variants": SPELLING_SQL}
