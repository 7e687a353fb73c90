"""Training-corpus pipeline: five stages over ``documents``, each written as Parquet and reread.

Each stage takes (spark, docs, sf_dir) and works on all that the one before
kept. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recoflow.llm import chosen_path, cross_parse, raking, spaced_seed, suffix_dedup
from recoflow.llm.common import materialize, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters go, and those that the language found does not explain (phrases of fewer than
    ``cross_parse.EXPLAINED`` symbols, as in scripts of no language labelled). A null lang becomes the one found;
    a given lang stays. With no labelled text to learn from, all documents with letters stay as they are."""
    docs = docs.select(*COLUMNS)
    model = cross_parse.train(docs)
    if model is None:
        return docs.where(F.regexp_like("text", F.lit(r"\p{L}")))
    found = cross_parse.identify(docs, model, explained_as="lang_explained").where("lang_explained")
    return found.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, similarity 0.8) the smallest id stays."""
    docs = docs.select(*COLUMNS)
    gone = materialize(chosen_path.near_duplicates(docs).where("not kept").select("doc_id").distinct(), "near-copies")
    return docs.join(gone, "doc_id", "left_anti").select(*COLUMNS)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 100 bytes or more that an earlier document holds are cut; documents left empty by that go."""
    docs = docs.select(*COLUMNS)
    cut = suffix_dedup.dedup_substrings(docs, carry=True)
    cut = cut.where("n_removed = 0 or kept_text <> ''")
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("row.text"))
    return cut.select("doc_id", text.alias("text"), "row.lang", "row.source",
                      F.when(F.col("n_removed") > 0, F.char_length(text).cast("long")).otherwise(F.col("row.n_chars")).alias("n_chars"))


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return spaced_seed.without_leaks(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose token shares of sources, languages and topics are raked to the targets."""
    return raking.mix(docs.select(*COLUMNS)).where("sampled").drop("sampled")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("suffix_dedup", drop_repeats),
    ("decontamination", drop_benchmark_leaks),
    ("mixing", mix_sources),
]

#: Language models, similarity joins and suffix orders are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialize(docs, f"stage-{name}")
    return docs
