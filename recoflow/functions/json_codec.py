"""Review message codec (P15-P17, F5): JSON text <-> the five message fields.

Encoding keeps missing fields as JSON ``null`` (the producer emits every key).
Decoding is PERMISSIVE with a corrupt-record column, so arrays, scalars, JSON
``null`` and broken text are routed to a quarantine instead of failing the job.
The field list is fixed: unknown keys are dropped, missing keys become NULL,
and values are kept as text (a number as the parser prints it: ``1.10`` is ``1.1``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import CORRUPT_COLUMN, MESSAGE_COLUMNS, MESSAGE_PARSE_SCHEMA

# Quarantine reasons.
REASON_MALFORMED = "malformed_json"
REASON_NOT_OBJECT = "not_an_object"


def encode_message(*cols: str) -> Column:
    """The review message as JSON text, NULL fields kept as ``null``."""
    names = cols or MESSAGE_COLUMNS
    return F.to_json(F.struct(*[F.col(c) for c in names]), {"ignoreNullFields": "false"})


def decode_messages(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Parse ``value`` once into a one-element ``_routed`` array of
    ``struct(m, reason, empty)``.

    ``m`` holds the five fields, ``reason`` is NULL for a landable message and
    otherwise says why it is quarantined, ``empty`` marks ``{}``, which the
    reference drops silently (an empty dict is falsy) rather than quarantines.

    The outputs are taken with ``explode(filter(_routed, ...))`` (0 or 1 rows
    per message) instead of a ``Filter``: Catalyst would push a filter on the
    parsed struct below the projection and inline ``from_json`` into it, parsing
    each message again for every branch.
    """
    # Strict JSON, as the producer writes it: Spark would otherwise accept
    # single-quoted strings, which standard JSON (and the SQL oracle) reject.
    opts = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN,
            "allowSingleQuotes": "false"}
    value = F.col(value_col)
    # The parser stops at the end of the first value; wrapped in an object and in an array, a text
    # with anything after it is no JSON in at least one of them. The message itself is read out of the object.
    wrapped = F.concat(F.lit('{"m":'), value, F.lit(',"end":1}'))
    rec = F.struct(F.from_json(wrapped, MESSAGE_PARSE_SCHEMA, opts).alias("w"), value.alias("v"))

    def route(r: Column) -> Column:
        w = r["w"]
        array = F.try_parse_json(F.concat(F.lit("["), r["v"], F.lit("]"))).isNotNull()
        good = F.coalesce(w["m"].isNotNull() & w[CORRUPT_COLUMN].isNull() & (w["end"] == 1) & array, F.lit(False))
        whole = array & F.try_parse_json(F.concat(F.lit('{"m":'), r["v"], F.lit(',"end":1}'))).isNotNull()
        reason = (
            F.when(good, F.lit(None).cast("string"))
            .when(F.coalesce(whole, F.lit(False)) & F.try_parse_json(r["v"]).isNotNull(), F.lit(REASON_NOT_OBJECT))
            .otherwise(F.lit(REASON_MALFORMED))
        )
        empty = good & F.trim(r["v"]).rlike(r"^\{\s*\}$")
        return F.struct(w["m"].alias("m"), reason.alias("reason"), empty.alias("empty"))

    return df.withColumn("_routed", F.transform(F.array(rec), route))


def landable(decoded: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """F5 + P15: good messages aligned to the fixed column list and order."""
    good = F.filter("_routed", lambda r: r["reason"].isNull() & ~r["empty"])
    return decoded.select(*keep, F.explode(good).alias("_r")).select(
        *keep, *[F.col(f"_r.m.{c}").alias(c) for c in MESSAGE_COLUMNS])


def quarantined(decoded: DataFrame, value_col: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """messages that are not JSON objects, with the raw text and the reason."""
    bad = F.filter("_routed", lambda r: r["reason"].isNotNull())
    return decoded.select(*keep, F.col(value_col).alias("value"), F.explode(bad).alias("_r")).select(
        *keep, "value", F.col("_r.reason").alias("reason"))
