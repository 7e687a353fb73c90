"""Operator 11: spelling variants by a trie over letter-count vectors.

Words are counted over whole texts, and each frequent word is arranged by its
length and the counts of its letters in ``GROUPS`` groups. Two words that differ by one
code point have vectors that differ by a surplus of one at most and a deficit
of one at most, so near words are found by a depth-first search in a trie of those
vectors, which spends each budget once; words at the leaves it reaches are verified.

* The trie's top levels (length, and the first counts, as many as the number of words
  asks for) are the shuffle key: a task holds the subtrees of its shards, and a word
  asks every shard that its budgets reach. A shard of more than ``SHARD_BYTES`` is dealt
  into blocks, all of which are asked, so no task holds more.
* In a shard, the words to find are sorted first and become the trie; the words that ask
  stream past in batches. The search goes depth-first by blocks of up to ``FRONTIER``
  (word, node, budgets) entries on a stack, so its memory is bounded too.
* Chains of forms are followed by pointer doubling.

Defined cases: null text has no words; a null doc_id is an empty string in the damage key;
rows that repeat an id count again; an empty table gives an empty result; words may be
of any length; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recoflow.llm.common import boundaries, materialize

MIN_LENGTH = 6
MIN_COUNT = 5
RATIO = 5
GROUPS = 12
SHARD_WORDS = 20_000
SHARD_BYTES = 8 << 20
FRONTIER = 200_000
TYPO_RATE = 199
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n): lower-cased letter runs, some with a letter deleted as their checksum says, that are frequent."""
    run = F.explode(F.regexp_extract_all("text", F.lit("[A-Za-zÀ-ÿ]+"), F.lit(0)))
    runs = docs.select(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":")).alias("doc"), run.alias("run"))
    # A shorter run cannot become a word.
    runs = runs.where(F.char_length("run") >= min_length)
    low = F.when(F.col("run").rlike("[A-Z]"), F.translate("run", UPPER, LOWER)).otherwise(F.col("run"))
    runs = runs.select("doc", low.alias("run"))
    h = F.crc32(F.concat("doc", "run").cast("binary"))
    at = (h % F.char_length("run")).cast("int")
    word = F.when(h % TYPO_RATE == 0, F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.char_length("run")))).otherwise(F.col("run"))
    words = runs.select(word.alias("word")).where(F.char_length("word") >= min_length)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


def vectors(grid: np.ndarray, groups: int = GROUPS) -> np.ndarray:
    """Letter-group counts of words of one length (a row of code points each)."""
    group = grid % groups
    return np.stack([(group == g).sum(axis=1) for g in range(groups)], axis=1).astype(np.int64)


def _grid(words: list[str]) -> np.ndarray:
    """Code points, all below 256, of words of one length."""
    return np.frombuffer("".join(words).encode("latin-1"), dtype=np.uint8).reshape(len(words), -1)


def _shard(length: np.ndarray | int, top: np.ndarray) -> np.ndarray:
    """A 64-bit key of a length and the counts of the first groups."""
    h = np.full(len(top), 0x9E3779B97F4A7C15, dtype=np.uint64)
    for c in (np.full(len(top), length), *top.T):
        h = (h + c.astype(np.uint64)) * np.uint64(0xC2B2AE3D27D4EB4F)
        h ^= h >> np.uint64(29)
    return h.view(np.int64)


def _steps(depth: int) -> list[tuple[int, np.ndarray]]:
    """(length step, count steps) from a word to the shards in reach of its budgets."""
    unit = np.eye(depth, dtype=np.int64)
    none = np.zeros(depth, dtype=np.int64)
    same = [none, *unit, *(-unit), *(unit[i] - unit[j] for i in range(depth) for j in range(depth) if i != j)]
    return [(0, s) for s in same] + [(1, s) for s in (none, *unit)] + [(-1, s) for s in (none, *(-unit))]


def _by_length(words: list[str]) -> Iterator[tuple[int, np.ndarray]]:
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    order = np.argsort(sizes, kind="stable")
    edges = boundaries(sizes[order])
    for a, b in zip(edges[:-1], edges[1:]):
        yield int(sizes[order[a]]), order[a:b]


def _placed(depth: int, asking: bool):
    """Words with the shard they live in, or with each shard they ask."""
    steps = _steps(depth) if asking else [(0, np.zeros(depth, dtype=np.int64))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column("word").to_pylist()
            for length, at in _by_length(words):
                top = np.zeros((len(at), GROUPS), dtype=np.int64)
                step = max(1, (1 << 24) // length)
                for lo in range(0, len(at), step):
                    top[lo:lo + step] = vectors(_grid([words[i] for i in at[lo:lo + step]]))
                top = top[:, :depth]
                for more, by in steps:
                    counts = top + by
                    ok = (counts >= 0).all(axis=1) & (counts.sum(axis=1) <= length + more)
                    rows = pa.array(at[ok])
                    if len(rows):
                        yield pa.RecordBatch.from_arrays([pa.array(_shard(length + more, counts[ok])), batch.column("word").take(rows), batch.column("n").take(rows)],
                                                         names=["shard", "word", "n"])

    return run


class Trie:
    """Words of one length by their vectors. A node of depth d is a run of sorted vectors with the same first d
    counts; ``keys[d]`` holds (parent node, count) of the nodes of depth d + 1, in order."""

    def __init__(self, words: list[str], counts: np.ndarray):
        self.length = len(words[0])
        grid, best = _grid(words), np.asarray(counts, dtype=np.int64)
        vec = vectors(grid)
        order = np.lexsort(vec.T[::-1])
        self.words, self.grid, self.n, vec = [words[i] for i in order], grid[order], best[order], vec[order]
        self.base = self.length + 3
        self.keys, node = [], np.zeros(len(vec), dtype=np.int64)
        for d in range(vec.shape[1]):
            key, node = np.unique(node * self.base + vec[:, d] + 1, return_inverse=True)
            self.keys.append(key)
        self.starts = np.searchsorted(node, np.arange(len(self.keys[-1]) + 1))

    def leaves(self, vec: np.ndarray, limit: int = FRONTIER) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(rows of ``vec``, leaf nodes) in reach of a surplus of one and a deficit of one."""
        n = len(vec)
        more = self.length - int(vec[0].sum())
        stack = [(0, np.arange(n), np.zeros(n, dtype=np.int64), np.ones(n, dtype=np.int8), np.ones(n, dtype=np.int8))]
        while stack:
            d, row, node, surplus, deficit = stack.pop()
            if len(row) > limit:  # the rest waits on the stack
                stack.append((d, row[limit:], node[limit:], surplus[limit:], deficit[limit:]))
                row, node, surplus, deficit = row[:limit], node[:limit], surplus[:limit], deficit[:limit]
            if d == vec.shape[1]:
                done = surplus - deficit == -more  # what a word has in more letters, it has in surplus
                yield row[done], node[done]
                continue
            found = []
            for step in (0, 1, -1):
                may = slice(None) if step == 0 else surplus > 0 if step == 1 else deficit > 0
                key = node[may] * self.base + vec[row[may], d] + step + 1
                at = np.minimum(np.searchsorted(self.keys[d], key), len(self.keys[d]) - 1)
                hit = self.keys[d][at] == key
                found.append((row[may][hit], at[hit], surplus[may][hit] - (step == 1), deficit[may][hit] - (step == -1)))
            stack.append((d + 1, *(np.concatenate([f[i] for f in found]) for i in range(4))))

    def near(self, words: list[str], limit: int = FRONTIER) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(indices of ``words``, of one length; indices of the trie's words) that differ by one code point."""
        asked = _grid(words)
        for row, leaf in self.leaves(vectors(asked), limit):
            sizes = self.starts[leaf + 1] - self.starts[leaf]
            step = max(1, (1 << 24) // max(self.length, 1))
            ends = np.cumsum(sizes)
            lo = 0
            while lo < len(leaf):  # as many leaves as make ``step`` candidates, one at least
                hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + step, "right")))
                part = sizes[lo:hi]
                q = np.repeat(row[lo:hi], part)
                w = np.repeat(self.starts[leaf[lo:hi]], part) + np.arange(part.sum()) - np.repeat(np.cumsum(part) - part, part)
                for a in range(0, len(q), step):
                    ok = one_edit(asked[q[a:a + step]], self.grid[w[a:a + step]])
                    yield q[a:a + step][ok], w[a:a + step][ok]
                lo = hi


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether rows of code points differ by exactly one inserted, deleted or replaced one."""
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(axis=1) == 1
    if a.shape[1] > b.shape[1]:
        a, b = b, a
    before = np.logical_and.accumulate(a == b[:, :-1], axis=1)
    after = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1)[:, ::-1]
    return before.sum(axis=1) + after.sum(axis=1) >= a.shape[1]


_FOUND = "word string, n bigint, n_near bigint, form_n bigint, form string"


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by shard and block, a block's words before those that ask, to each asking word's near words:
    their number, and the most frequent one."""
    now, words, counts, trie = None, [], [], None
    for batch in batches:
        shard, block, asking = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("shard", "block", "asking"))
        key = np.stack([shard, block, asking])
        edges = np.concatenate([[0], np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1, [batch.num_rows]]) if batch.num_rows else []
        for a, b in zip(edges[:-1], edges[1:]):
            if (shard[a], block[a]) != now:
                now, words, counts, trie = (shard[a], block[a]), [], [], None
            part = batch.slice(a, b - a)
            if not asking[a]:
                words += part.column("word").to_pylist()
                counts.append(part.column("n").to_numpy())
                continue
            if trie is None and words:
                n = np.concatenate(counts)
                trie = [Trie([words[i] for i in at], n[at]) for _, at in _by_length(words)]
            if not words:
                continue
            asked = part.column("word").to_pylist()
            total, top, form = np.zeros(len(asked), dtype=np.int64), np.zeros(len(asked), dtype=np.int64), [None] * len(asked)
            for length, at in _by_length(asked):
                step = max(1, (1 << 22) // length)
                for t in trie:
                    if abs(t.length - length) > 1:
                        continue
                    for lo in range(0, len(at), step):
                        some = at[lo:lo + step]
                        for q, w in t.near([asked[i] for i in some]):
                            total += np.bincount(some[q], minlength=len(asked))
                            order = np.lexsort((-t.n[w], q))
                            q, w = some[q[order]], w[order]
                            # Per word the most frequent ones, of which the smallest counts.
                            most = t.n[w] == np.repeat(t.n[w[boundaries(q)[:-1]]], np.diff(boundaries(q)))
                            for i, j in zip(q[most].tolist(), w[most].tolist()):
                                if t.n[j] > top[i] or (t.n[j] == top[i] and t.words[j] < form[i]):
                                    top[i], form[i] = t.n[j], t.words[j]
            some = np.flatnonzero(total)
            if len(some):
                yield pa.RecordBatch.from_arrays([part.column("word").take(pa.array(some)), part.column("n").take(pa.array(some)), pa.array(total[some]),
                                                  pa.array(top[some]), pa.array([form[i] for i in some.tolist()], pa.string())],
                                                 names=["word", "n", "n_near", "form_n", "form"])


def near_words(words: DataFrame, n_words: int, shard_words: int = SHARD_WORDS, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(word, n_near, form_n, form) for words with near words: how many, and the most frequent one (ties: the smallest)."""
    # Each count that goes into the key splits shards by three or so.
    depth = min(GROUPS, max(1, math.ceil(math.log(max(n_words / shard_words / 4, 1), 3))))
    schema = "shard bigint, word string, n bigint"
    lives = words.mapInArrow(_placed(depth, False), schema)
    size = F.sum(F.octet_length("word") + 64)
    blocks = lives.groupBy("shard").agg(F.ceil(size / shard_bytes).cast("int").alias("blocks"))
    blocks = materialize(blocks, "shards")
    asks = words.mapInArrow(_placed(depth, True), schema)
    lives = lives.join(blocks, "shard").select("shard", F.pmod(F.xxhash64("word"), "blocks").cast("int").alias("block"), F.lit(False).alias("asking"), "word", "n")
    asks = asks.join(blocks, "shard").select("shard", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(True).alias("asking"), "word", "n")
    rows = lives.union(asks).repartition("shard", "block").sortWithinPartitions("shard", "block", "asking")
    found = rows.mapInArrow(_search, _FOUND)
    # The smallest of the most frequent: a maximum of counts, then a minimum of words.
    first = F.min(F.struct((-F.col("form_n")).alias("m"), F.col("form").alias("form")))
    found = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), first.alias("f"))
    return found.select("word", "n_near", (-F.col("f.m")).alias("form_n"), F.col("f.form").alias("form"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for words with a form (columns word, form): the last of the chain of forms."""
    jumps = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = jumps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = materialize(jumps.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        jumps = further.select("word", "root")
        if further.where("moved").isEmpty():
            return jumps


def group_variants(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, ratio: int = RATIO, **sizes: int) -> DataFrame:
    """Per frequent word: word, n, n_near, form, form_n, root."""
    words = materialize(words_of(docs, min_length, min_count), "words")
    near = materialize(near_words(words, words.count(), **sizes), "near")
    is_form: Column = F.col("form_n") >= ratio * F.col("n")
    known = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(is_form, F.col("form")).alias("form"), F.when(is_form, F.col("form_n")).alias("form_n"))
    known = materialize(known, "forms")
    last = roots(known.where("form IS NOT NULL"))
    return known.join(last, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
