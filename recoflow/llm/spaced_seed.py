"""Operator 6: benchmark decontamination by spaced-seed hashing (DataFrame operations only).

An item is cut into blocks of ``BLOCK`` words. A seed is a block without one of its
words: a block with all words in place shares ``BLOCK`` seeds with a document, one
with a replaced word still shares one. Where k of an item's words are replaced, its
m blocks share at least 2 m - k seeds at one alignment, wherever the k are. At 80
percent, k is at most m, whatever the length, so at least m seeds are met, and no
item is missed. Alignments with that many hits are compared word by word: where at
least ``PERCENT`` percent of the item's words stand in place, whatever the rest were
replaced by, the document holds the item. An item shorter than a block may not
differ in any word and is one seed as a whole. Lower percentages than
``LEAST_PERCENT`` are refused, as seeds would miss items.

Documents are hashed at all their words, but seeds are made only where two words
meet that open a seed of some item. Benchmark seeds are broadcast in blocks whose
size is checked (``MAX_SEEDS`` rows); a larger benchmark is searched block after
block, so the hashes of the corpus are never shuffled. Only hits, joined back to
their documents, are.

Defined cases: words are what lies between ASCII white space, in lower case;
null and empty texts hold nothing and items without words are held by nothing;
equal items are all reported; rows that repeat id and text share one result; an
empty table on either side gives no hits; only doc_id and text, item_id and text
are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recoflow.llm.common import materialize

BLOCK = 5
#: A seed's words, by their distance from the first of the two neighbours that open it. The first of these seeds is a
#: block without its last word, or without its first one; the others leave out one word inside.
SHAPES = ((0, 1, 2, 3), (-2, 0, 1, 2), (0, 1, 3, 4), (0, 1, 2, 4))
#: (shape, where its opening word is in the block)
BLOCK_SEEDS = ((0, 0), (0, 1), (1, 2), (2, 0), (3, 0))
PERCENT = LEAST_PERCENT = 80
MAX_SEEDS = 1_000_000
BLANKS = r"[\x20\x09-\x0D]+"
#: The word pairs that open a seed are sent along as a table of this many slots, to skip other places early.
PAIR_SLOTS = 1 << 16


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), BLANKS), lambda w: w != "")


def hashes_of(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _opening(h: Column, i: Column) -> Column:
    """The pair of words at ``i``; the last word of a text stands alone."""
    return F.xxhash64(F.get(h, i), F.get(h, i + 1))


def _seed(h: Column, i: Column, shape: int) -> Column:
    """Hash of the words of ``shape`` around place ``i``. Words beyond an end of the text are left out, which no item's
    seed has."""
    return F.xxhash64(F.lit(shape), *(F.get(h, i + k) for k in SHAPES[shape]))


def _whole(h: Column, i: Column, n: int) -> Column:
    """Hash of ``n`` words from ``i``, as an item shorter than a block."""
    return F.xxhash64(F.lit(-n), *(F.get(h, i + k) for k in range(n)))


def _item_seeds(h: Column) -> Column:
    """Array of (p, seed, pair) of an item: the place that opens the seed, its hash and the opening pair's."""
    def one(p: Column, seed: Column) -> Column:
        return F.struct(p.alias("p"), seed.alias("seed"), _opening(h, p).alias("pair"))

    starts = F.sequence(F.lit(0), F.floor(F.size(h) / BLOCK).cast("int") - 1)
    blocks = F.flatten(F.transform(starts, lambda b: F.array(*(one(b * BLOCK + at, _seed(h, b * BLOCK + at, s)) for s, at in BLOCK_SEEDS))))
    out = F.when(F.size(h) >= BLOCK, blocks)
    for n in range(1, BLOCK):
        whole = F.struct(F.lit(0).alias("p"), _whole(h, F.lit(0), n).alias("seed"),
                         (F.xxhash64(F.get(h, F.lit(0))) if n == 1 else _opening(h, F.lit(0))).alias("pair"))
        out = out.when(F.size(h) == n, F.array(whole))
    return out


def _key() -> Column:
    return F.xxhash64("doc_id", "text")


def find_items(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT, max_seeds: int = MAX_SEEDS) -> DataFrame:
    """(key, item_id, matched, item_words): items that documents hold, with the words in place. ``key`` hashes id and text."""
    if percent < LEAST_PERCENT:
        raise ValueError(f"percent is {percent}; below {LEAST_PERCENT}, seeds would miss items")
    items = benchmark.select("item_id", words_of(F.col("text")).alias("item"))
    hashed = items.select("item_id", hashes_of(F.col("item")).alias("h"))
    n = F.size("h")
    differ = n - F.ceil(n * percent / 100)
    need = F.greatest(F.lit(1), 2 * F.floor(n / BLOCK) - differ).cast("int").alias("need")
    seeds = hashed.select("item_id", n.alias("n"), need, F.explode(_item_seeds(F.col("h"))).alias("s"))
    seeds = materialize(seeds.select("s.seed", "item_id", F.col("s.p").alias("item_at"), "need", "n", "s.pair"), "seeds")
    blocks = max(1, -(-seeds.count() // max_seeds))
    short = sorted(r.n for r in seeds.where(F.col("n") < BLOCK).select("n").distinct().collect())
    slots = bytearray(PAIR_SLOTS)
    for r in seeds.select(F.pmod("pair", F.lit(PAIR_SLOTS)).alias("slot")).distinct().collect():
        slots[r.slot] = 1
    listed = lambda pair: F.lit(bytes(slots)).substr((F.pmod(pair, F.lit(PAIR_SLOTS)) + 1).cast("int"), F.lit(1)) == F.lit(b"\x01")
    corpus = docs.select(_key().alias("key"), hashes_of(words_of(F.col("text"))).alias("h"))
    h = F.col("h")
    opens = lambda i: listed(_opening(h, i)) | listed(F.xxhash64(F.get(h, i))) if 1 in short else listed(_opening(h, i))
    at = F.filter(F.when(F.size(h) > 0, F.sequence(F.lit(0), F.size(h) - 1)), opens)
    # explode_outer: a filter on the array's size would be pushed down and compute all arrays again, in its lambdas
    # once for every place. Rows without places have a null seed and find no partner.
    corpus = corpus.select("key", "h", at.alias("at"))
    made = F.flatten(F.transform("at", lambda i: F.array(*(
        F.struct(i.alias("p"), seed.alias("seed"))
        for seed in [*(_seed(h, i, s) for s in range(len(SHAPES))), *(_whole(h, i, k) for k in short)]))))
    corpus = corpus.select("key", F.explode_outer(made).alias("s")).select("key", "s.seed", "s.p")
    hits = None
    for b in range(blocks):
        part = seeds.where(F.pmod(F.xxhash64("seed"), F.lit(blocks)) == b).drop("n", "pair")
        found = corpus.join(F.broadcast(part), "seed").select("key", "item_id", (F.col("p") - F.col("item_at")).alias("shift"), "need")
        hits = found if hits is None else hits.union(found)
    hits = hits.groupBy("key", "item_id", "shift", "need").agg(F.count("*").alias("n")).where("n >= need").drop("n", "need")
    hits = materialize(hits, "hits")
    texts = docs.select(_key().alias("key"), "text").join(hits.select("key").distinct(), "key", "left_semi").dropDuplicates(["key"])
    aligned = hits.join(texts, "key").join(items, "item_id").withColumn("words", words_of(F.col("text")))
    same = F.size(F.filter(F.sequence(F.lit(0), F.size("item") - 1),
                           lambda i: F.coalesce(F.get("item", i) == F.when(i + F.col("shift") >= 0, F.get("words", i + F.col("shift"))), F.lit(False))))
    return (aligned.select("key", "item_id", same.alias("matched"), F.size("item").alias("item_words"))
            .where(F.col("matched") * 100 >= F.col("item_words") * percent)
            .groupBy("key", "item_id", "item_words").agg(F.max("matched").alias("matched")))


def contamination(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT, max_seeds: int = MAX_SEEDS) -> DataFrame:
    """One row per document: doc_id, contaminated, n_items, best_percent, first_item."""
    found = materialize(find_items(docs, benchmark, percent, max_seeds), "found").groupBy("key").agg(
        F.count("*").alias("n_items"), F.max(F.floor(F.col("matched") * 100 / F.col("item_words"))).cast("int").alias("best_percent"),
        F.min("item_id").alias("first_item"))
    out = docs.select("doc_id", _key().alias("key")).join(found, "key", "left")
    return out.select("doc_id", F.col("n_items").isNotNull().alias("contaminated"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
                      F.coalesce("best_percent", F.lit(0)).alias("best_percent"), "first_item")


def without_leaks(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The documents that hold no benchmark item."""
    found = materialize(find_items(docs, benchmark, percent).select("key").distinct(), "found")
    rows = docs.select(_key().alias("key"), F.struct("*").alias("row"))
    return rows.join(found, "key", "left_anti").select(*(F.col("row").getField(c).alias(c) for c in docs.columns))
