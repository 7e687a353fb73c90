"""Registered queries of the training-data operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recoflow.llm import (chosen_path, cross_parse, html_text, phrase_automata, pstable, quality, raking, repair, spaced_seed, spelling,
                          suffix_dedup, url_graph, warc)
from recoflow.llm.common import id_remainder, table


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    model = quality.train(docs, labels, id_remainder("doc_id", 3) != 1)
    scored = quality.score_documents(docs, model)
    return scored.select("doc_id", F.coalesce(id_remainder("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op2_raking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raking.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")).drop("text")


def op3_pstable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pstable.link_vectors(table(spark, sf_dir, "embeddings"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(table(spark, sf_dir, "pages"))


def op6_spaced_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spaced_seed.contamination(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup_substrings(table(spark, sf_dir, "documents").select("doc_id", "text"), with_text=False).drop("kept_text")


def op8_url_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_graph.judge_urls(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op9_cross_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = cross_parse.train(docs, id_remainder("doc_id", 4) != 2)
    found = cross_parse.identify(docs.select("doc_id", "text"), model, "lang_pred", "score")
    return found.select("doc_id", F.coalesce(id_remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op10_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_path.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), width=2)


def op11_count_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op12_phrase_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_automata.removed_words(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op13_cyk_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.damage_and_repair(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_raking": op2_raking,
    "op3_pstable": op3_pstable,
    "op4_warc": op4_warc,
    "op5_html_text": op5_html_text,
    "op6_spaced_seed": op6_spaced_seed,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_url_graph": op8_url_graph,
    "op9_cross_parse": op9_cross_parse,
    "op10_chosen_path": op10_chosen_path,
    "op11_count_trie": op11_count_trie,
    "op12_phrase_automata": op12_phrase_automata,
    "op13_cyk_repair": op13_cyk_repair,
}
