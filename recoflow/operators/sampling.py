"""First-n, trimming and fixed-size uniform sampling (L1-L3).

``orderBy(k).limit(n)`` plans as TakeOrderedAndProject: every partition sends
its own top n rows to ONE task. With 10^5 partitions and n = 5M that single
task would receive up to 5*10^11 rows. :func:`exact_first_n` instead finds the
n-th key by a distributed radix select and keeps the rows up to it with a plain filter:

* the sort keys alone are written once (one pass over the input's joins, with
  only the key column read), as 64-bit words whose order is the sort order;
* a level counts the keys by the next 16 bits that differ
  (``groupBy(bucket).count``, at most 65,536 rows reach the driver) and goes on in
  the bucket that holds the n-th key, until that bucket ends exactly there or
  one key is left; a bigint takes four levels at most;
* the filter ``key <= cut`` on the input is pushed below its joins, so the second
  pass reads only the rows that are taken.

Rows with the cut's key are told apart by a hash of the whole row; only rows that are
equal in all columns remain, and those are counted and repeated, not ranked.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache, reduce
from itertools import islice
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_dir

#: Bits of a word that one level of the radix select counts by.
RADIX_BITS = 16
# Bytes of text in one word, so that a word is never negative.
TEXT_BYTES = 7
_SIGN = 1 << 63

#: A sort term: its name, "long" or "text", ascending with NULL last.
Term = tuple[str, str]


def _text_word(text: Column, i: int) -> Column:
    """Bytes ``7 i .. 7 i + 6`` of a text (zeros behind its end) as a number: in order of the text's bytes."""
    part = F.hex(F.substring(text.cast("binary"), i * TEXT_BYTES + 1, TEXT_BYTES))
    return F.conv(F.rpad(part, 2 * TEXT_BYTES, "0"), 16, 10).cast("bigint")


def _words(terms: list[Term], longest: Callable[[], int]) -> Iterator[Column]:
    """The sort words of a row, most significant first; texts have at most ``longest()`` bytes, asked when a text is reached."""
    for name, kind in terms:
        c = F.col(name)
        yield F.when(c.isNull(), 1).otherwise(0).cast("bigint")
        if kind == "long":
            yield F.coalesce(c, F.lit(0)).cast("bigint")
            continue
        text = F.coalesce(c, F.lit(""))
        for i in range(-(-longest() // TEXT_BYTES)):
            yield _text_word(text, i)
        yield F.octet_length(text).cast("bigint")  # 'a' before 'a\\0'


def _unsigned(x: int) -> int:
    return (x ^ -_SIGN) & ((1 << 64) - 1)


def radix_cut(keys: DataFrame, words: Iterator[Column], n: int) -> tuple[list[int], int | None]:
    """The leading words ``cut`` of the ``n``-th row, as many as it takes, and None if exactly ``n`` rows have
    leading words <= cut; otherwise how many of the rows with all words of the cut are among the
    first ``n``. ``keys`` has more than ``n`` > 0 rows.
    """
    cut: list[int] = []
    w, tied, need = "_word", keys, n
    for word in words:
        rows = tied.withColumn(w, word)
        lo, hi, size = rows.agg(F.min(w), F.max(w), F.count(F.lit(1))).first()
        while lo < hi and need < size:
            differ = (_unsigned(lo) ^ _unsigned(hi)).bit_length()  # bits above are the same in all rows
            shift = max(0, differ - RADIX_BITS)
            bucket = F.shiftrightunsigned(F.col(w).bitwiseXOR(F.lit(-_SIGN)), shift).bitwiseAND(F.lit((1 << RADIX_BITS) - 1))
            inside = rows.where(F.col(w).between(F.lit(lo), F.lit(hi)))
            counts = inside.groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("n"), F.min(w).alias("lo"), F.max(w).alias("hi"))
            for b in sorted(counts.collect()):  # 65,536 rows at most
                if need <= b["n"]:
                    lo, hi, size = b["lo"], b["hi"], b["n"]
                    break
                need -= b["n"]
        cut.append(hi)
        if need == size:  # the bucket ends with the n-th row
            return cut, None
        tied = rows.where(F.col(w) == F.lit(lo)).drop(w)
    return cut, need


def _compared(words: list[Column], cut: list[int]) -> tuple[Column, Column]:
    """Whether a row's words are below the cut, and whether they are the cut."""
    below = F.lit(False)
    for word, value in reversed(list(zip(words, cut))):
        below = (word < F.lit(value)) | ((word == F.lit(value)) & below)
    return below, reduce(and_, (word == F.lit(value) for word, value in zip(words, cut)))


def _equal_rows(rows: DataFrame, n: int) -> DataFrame:
    """``n`` of rows that agree in a hash of all columns. Equal rows are counted (partial sums) and
    repeated; different ones (a hash collision) are taken in order of their columns."""
    columns = rows.columns
    counted = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("__copies"))
    before = F.coalesce(F.sum("__copies").over(Window.orderBy(*columns).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counted = counted.withColumn("__take", F.least("__copies", F.lit(n) - before)).where("__take > 0")
    return counted.select(*columns, F.explode(F.sequence(F.lit(1).cast("bigint"), "__take"))).select(*columns)


def exact_first_n(df: DataFrame, n: int, terms: dict[str, tuple[Column, str]]) -> tuple[DataFrame, int]:
    """Exactly the rows of ``df.orderBy(terms).limit(n)`` (as a set), and how many they are.

    ``terms``: name -> (column, "long" or "text"), each ascending with NULL
    last; texts are in order of their UTF-8 bytes. Of rows with equal terms, those with
    the smaller hash of all columns come first, so the result does not depend on partitioning.
    """
    if n <= 0:
        return df.limit(0), 0
    columns = df.columns
    named = {f"__{name}": c for name, (c, _) in terms.items()}
    kinds = [(f"__{name}", kind) for name, (_, kind) in terms.items()]
    path = scratch_dir(df.sparkSession, "sort-keys")
    df.select(*(c.alias(name) for name, c in named.items())).write.parquet(path)
    keys = df.sparkSession.read.parquet(path)
    count = keys.count()  # from the footers
    if count <= n:
        return df, count
    texts = [F.max(F.octet_length(name)) for name, kind in kinds if kind == "text"]
    longest = cache(lambda: max(x or 0 for x in keys.agg(*texts).first()))
    cut, need = radix_cut(keys, _words(kinds, longest), n)

    rows = df.withColumns(named)
    below, at = _compared(list(islice(_words(kinds, longest), len(cut))), cut)
    if need is None:
        return rows.where(below | at).select(*columns), n
    head, tied = rows.where(below).select(*columns), rows.where(at).select(*columns)
    if list(terms) == ["row"]:
        return head.unionByName(_equal_rows(tied, need)), n
    return head.unionByName(exact_first_n(tied, need, {"row": (F.xxhash64(*columns), "long")})[0]), n


def _key_terms(key: str) -> dict[str, tuple[Column, str]]:
    """Numeric keys by value, then other keys by text, then NULL keys."""
    return {"number": (F.col(key).try_cast("bigint"), "long"), "text": (F.col(key).cast("string"), "text")}


def first_n_with_count(df: DataFrame, n: int, key: str = "review_id") -> tuple[DataFrame, int]:
    """L1: the first ``n`` rows by the stable review key, and how many rows
    that is.

    Replaces the reference's partition-dependent ``monotonically_increasing_id``
    order: the same rows come back for any partitioning. Numeric keys sort by
    value, other keys (message hashes, positions) by text after them.
    """
    return exact_first_n(df, n, _key_terms(key))


def first_n_by_key(df: DataFrame, n: int, key: str = "review_id") -> DataFrame:
    """L1 (see :func:`first_n_with_count`)."""
    return first_n_with_count(df, n, key)[0]


def trim_rows(df: DataFrame, n_lines: int, key: str = "review_id") -> DataFrame:
    """L2: keep the first ``n_lines`` lines of a file *including its header*.

    A Spark table has no line order, so "file order" is the stable key order;
    the header counts as one line, so ``n_lines - 1`` data rows are kept.
    """
    if n_lines <= 0:
        raise ValueError("number of lines to keep must be a positive integer")
    return first_n_by_key(df, n_lines - 1, key)


def _sample_hash(key: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def sample_fixed_size(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """L3: a uniform sample of exactly ``n`` rows (all rows if fewer).

    Rows are ranked by ``md5('<seed>:' || key)``; the result does not depend on
    partitioning and is the same for the same seed. A NULL key has a NULL hash and
    sorts last (as in SQL's default ``NULLS LAST``).
    """
    h = _sample_hash(F.col(key), seed)
    # 15 hex digits of the hash are a number of 60 bits: in order of the text, and one word.
    terms = {"prefix": (F.conv(F.substring(h, 1, 15), 16, 10).cast("bigint"), "long"), "hash": (h, "text"), "text": (F.col(key).cast("string"), "text")}
    return exact_first_n(df, n, terms)[0]
