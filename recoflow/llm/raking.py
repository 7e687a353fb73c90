"""Operator 2: mixing to target weights by iterative proportional fitting (DataFrame operations only).

Documents are counted into cells of source, language and topic, and each cell gets
a probability, min(1, source factor x language factor x topic factor). The factors
are raked: those of the sources are set so that each source's expected tokens meet
its target, then those of the languages, then of the topics, and again, until all
three margins fit. A document is sampled with its cell's probability, by a hash of
its id.

The expected tokens of the sample are the share ``KEEP`` of the corpus, whatever
its categories. A category's target is its target share of that, or all its tokens
if it has fewer; what it lacks is spread over the others in proportion to their
shares. So a rare category is kept whole and takes nothing from the rest. With
fewer than ``KEEP`` of the tokens in categories that have a target, all of those
are kept. Where the margins contradict each other (a cell would be needed more than
once), the last raked, the topic, fits best.

A target share is the corpus share to the power ``TEMPERATURE``, made to sum to 1,
unless targets are given. A topic is the form of a text: table, symbols, shouting
or prose. Only the cells, aggregated with partial sums, are raked; they are
broadcast to the documents if they are at most ``MAX_CELLS``, and joined by a
shuffle beyond that.

Defined cases: a null source or language is the category ``unknown``; null and
empty texts have no tokens and are prose; cells without tokens have probability
0 and are never sampled; documents of one id fall to the same hash; categories without
a given target get none and are left out; an empty table gives an empty result;
other columns are passed through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from recoflow.llm.common import materialize

TEMPERATURE = 0.8
KEEP = 0.5  # expected tokens of a sample, as a share of the corpus
ROUNDS = 12
MAX_CELLS = 100_000
MARGINS = ("source", "lang", "topic")
WORD = r"[^\x20\x09-\x0D]+"


def topic_of(text: Column) -> Column:
    return (F.when(F.contains(text, F.lit(" | ")), "table")
            .when(F.contains(text, F.lit("%%% ")) | F.contains(text, F.lit("### ")), "symbols")
            .when(F.contains(text, F.lit("!! ")), "shouting").otherwise("prose"))


def _described(docs: DataFrame) -> DataFrame:
    """Cell columns and tokens; the input row is one column, ``row``, so that no name of it can clash."""
    unknown = lambda c: F.coalesce(F.col(c), F.lit("unknown")).alias(f"_{c}")
    return docs.select(F.struct("*").alias("row"), unknown("source"), unknown("lang"), topic_of(F.col("text")).alias("_topic"),
                       F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("_tokens"))


def _fill(room: Column, pull: Column, goal: Column, by: list[str], ties: list[str]) -> Column:
    """The x with which the sum of least(room, x * pull) over the rows of equal ``by`` is ``goal``, which is at most
    the sum of ``room``. Of the rows in the order in which they fill up, some first ones are full; counting too
    many or too few of them as full gives a smaller x, so the largest is it."""
    part = Window.partitionBy(*by)
    full = part.orderBy(room / pull, *ties).rowsBetween(Window.unboundedPreceding, -1)
    rest = part.orderBy((room / pull).desc(), *(F.desc(t) for t in ties)).rowsBetween(Window.unboundedPreceding, 0)
    return (goal - F.coalesce(F.sum(room).over(full), F.lit(0.0))) / F.sum(pull).over(rest)


def rake(cells: DataFrame, targets: dict[str, dict[str, float]] | None = None, temperature: float = TEMPERATURE, rounds: int = ROUNDS,
         keep: float = KEEP) -> DataFrame:
    """Cells (_source, _lang, _topic, _tokens) with their probability. Cells that are never sampled are left out."""
    key = [f"_{m}" for m in MARGINS]
    corpus = cells.agg(F.sum("_tokens")).first()[0] or 0
    for m in MARGINS:
        if targets and m in targets:
            share = F.coalesce(*(F.when(F.col(f"_{m}") == k, F.lit(float(v))) for k, v in targets[m].items()), F.lit(0.0))
            cells = cells.withColumn(f"_want_{m}", share)
        else:
            sums = cells.groupBy(f"_{m}").agg(F.pow(F.sum("_tokens").cast("double"), F.lit(temperature)).alias(f"_want_{m}"))
            cells = cells.join(sums, f"_{m}")
    cells = cells.where(" and ".join(["_tokens > 0", *(f"_want_{m} > 0" for m in MARGINS)]))
    cells = materialize(cells.withColumn("_room", F.col("_tokens").cast("double")), "cells")
    budget = F.lit(float(min(keep * corpus, cells.agg(F.sum("_tokens")).first()[0] or 0)))
    rows = cells
    for m in MARGINS:
        sums = cells.groupBy(f"_{m}").agg(F.sum("_room").alias("_all"), F.first(f"_want_{m}").alias("_want"))
        sums = sums.withColumn("_x", _fill(F.col("_all"), F.col("_want"), budget, [], [f"_{m}"]))
        sums = sums.withColumn("_x", F.max("_x").over(Window.partitionBy()))
        rows = rows.join(sums.select(f"_{m}", F.least("_all", F.col("_x") * F.col("_want")).alias(f"_goal_{m}")), f"_{m}")
    rows = materialize(rows.select(*key, "_room", *(f"_goal_{m}" for m in MARGINS), F.lit(1.0).alias("_p")), "goals")
    for r in range(rounds):
        for m in MARGINS:
            rows = rows.withColumn("_x", _fill(F.col("_room"), F.col("_room") * F.col("_p"), F.col(f"_goal_{m}"), [f"_{m}"], key))
            rows = rows.withColumn("_p", F.col("_p") * F.max("_x").over(Window.partitionBy(f"_{m}"))).drop("_x")
        if r % 2 == 1:
            rows = materialize(rows, "raked")
    return rows.select(*key, F.least(F.lit(1.0), "_p").alias("probability"))


def mix(docs: DataFrame, targets: dict[str, dict[str, float]] | None = None, temperature: float = TEMPERATURE, rounds: int = ROUNDS,
        keep: float = KEEP) -> DataFrame:
    """``docs`` with topic, n_tokens, probability and sampled as last columns (in place of columns so named)."""
    rows = _described(docs.drop("topic", "n_tokens", "probability", "sampled"))
    key = ["_source", "_lang", "_topic"]
    cells = materialize(rows.groupBy(*key).agg(F.sum("_tokens").alias("_tokens")), "counted")
    raked = materialize(rake(cells, targets, temperature, rounds, keep), "probabilities")
    factors = cells.select(*key).join(raked, key, "left").withColumn("probability", F.coalesce("probability", F.lit(0.0)))
    out = rows.join(F.broadcast(factors) if cells.count() <= MAX_CELLS else factors, key)
    draw = F.conv(F.substring(F.md5(F.concat(F.lit("mix:"), F.coalesce(F.col("row.doc_id").cast("string"), F.lit(""))).cast("binary")), 1, 8), 16, 10)
    names = rows.schema["row"].dataType.names
    return out.select(*(F.col("row").getField(c).alias(c) for c in names), F.col("_topic").alias("topic"), F.col("_tokens").alias("n_tokens"), "probability",
                      (draw.cast("double") / 4294967296 < F.col("probability")).alias("sampled"))
