"""Operator 7: exact removal of repeated byte strings.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts earlier:
in a document of smaller id, or earlier in the same document.

The collection's Burrows-Wheeler transform is built column by column: each round
puts one more symbol in front of every string, and the new order of the suffixes
is the old one, stably sorted by those symbols (``column_order``). Over whole
documents that takes as many rounds as the longest has bytes, each of which reads
and writes the whole transform, and no part of it can be built on its own. So
Spark first cuts the work into independent collections of short strings:

1. Equal texts are one document, the smallest id; of the others all bytes go
   (if there are ``LENGTH`` at least).
2. Each window of ``LENGTH`` bytes is filed under its smallest hash of ``GRAM``
   bytes (its anchor). Equal windows have equal anchors, so windows whose anchor
   occurs once are unique. Anchors are counted with partial minima and maxima of their places.
   Those that repeat go to the tasks as a bit filter of ``FILTER_BITS`` at most, which
   lets a few others pass as well; if there are more of them, they are joined instead.
3. For an anchor that repeats, the bytes around it that its windows cover are a
   short string. Equal ones are merged by 128 bits of hashes with a partial minimum, so a passage that
   very many documents share is not gathered anywhere, and only places are shuffled. The
   bytes are cut again for the strings of anchors that have several.
4. Strings of one anchor form a collection, aligned at the anchor. Tasks hold
   several at a time (``CHUNK`` strings and one collection at most, so the
   transform's columns stay in memory and need no files), build their suffix
   order column by column, and mark every window that is equal to one of a
   smaller place. An anchor with more than ``HOT`` different strings is
   resolved by a partial minimum per window instead.
5. Marked windows go back to their documents, whose bytes they cover.

Defined cases: null text is empty; a text shorter than ``LENGTH`` keeps all;
rows that repeat id and text are one document and get one result; rows of one id
with other texts are ordered by a hash of the text; a null id sorts first; an
empty table gives an empty result; only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recoflow.llm.common import boundaries, groups_of, materialize, powers

LENGTH = 100
GRAM = 32
HOT = 20_000
CHUNK = 16_000
#: Size of the filter of repeated anchors (64 MB), and its bits per anchor.
FILTER_BITS = 1 << 29
BITS_EACH = 16


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """Hash of every substring of ``gram`` bytes."""
    if len(data) < gram:
        return np.zeros(0, dtype=np.uint64)
    up, down = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=total[1:])
    h = (total[gram:] - total[:-gram]) * down[:len(data) - gram + 1]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def anchors(data: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of the windows of ``data``: place, hash, first and last window."""
    h = gram_hashes(data, gram)
    span = length - gram + 1  # grams in a window
    n = len(data) - length + 1
    if n < 1:
        none = np.zeros(0, dtype=np.int64)
        return none, none.astype(np.uint64), none, none
    # Smallest gram of each window, by windows of doubled size; then its leftmost place for each run of
    # windows with one minimum (a run goes on from there if the minimum comes again).
    least, size = h, 1
    while size < span:
        step = min(size, span - size)
        least = np.minimum(least[:-step], least[step:])
        size += step
    first = np.concatenate([[0], np.flatnonzero(least[1:] != least[:-1]) + 1])
    last = np.concatenate([first[1:], [n]]) - 1
    found = []
    while len(first):
        at = np.concatenate([f + (h[f[:, None] + np.arange(span)] == least[f][:, None]).argmax(axis=1)
                             for f in np.array_split(first, -(-len(first) // 20_000))])
        found.append((at, first, np.minimum(last, at)))
        more = last > at
        first, last = at[more] + 1, last[more]
    at, first, last = (np.concatenate([x[i] for x in found]) for i in range(3))
    if len(found) > 1:
        order = np.argsort(first)
        at, first, last = at[order], first[order], last[order]
    return at, h[at], first, last


def column_order(grid: np.ndarray, group: np.ndarray, core: int) -> Iterator[tuple[int, np.ndarray]]:
    """(column, rows in order of their suffixes from that column), from the last column to the first.

    ``grid`` has a string in each row, padded with 0; in column ``core`` stands the number of its group.
    Each round puts one symbol in front of every suffix: their new order is the old one, stably sorted by
    those symbols, which are the column's part of the transform.
    """
    order = np.arange(len(grid))
    for column in range(grid.shape[1] - 1, -1, -1):
        symbols = group if column == core else grid[:, column]
        order = order[np.argsort(symbols[order], kind="stable")]
        yield column, order


def _documents(docs: DataFrame, *more: str) -> DataFrame:
    """Texts with a key (id, h1): the id (a null one before all) and hashes of the text."""
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", *more, F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("id"), text.alias("text"),
                       F.octet_length(text).cast("long").alias("n"), F.xxhash64(text).alias("h1"), F.xxhash64(F.lit("2"), text).alias("h2"))


def _anchor_rows(length: int, gram: int):
    """Anchors of each text, and a hash of where they are (a text and a place in it)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [anchors(np.frombuffer(t.as_py().encode(), dtype=np.uint8), length, gram)[:2] for t in batch.column("text")]
            keys = batch.column("h1").to_numpy().view(np.uint64)
            for lo in range(0, len(parts), 500):  # pieces of some hundred documents
                some = parts[lo:lo + 500]
                at, h = (np.concatenate([p[i] for p in some]) for i in (0, 1))
                if len(h):
                    where = np.repeat(keys[lo:lo + 500], [len(p[0]) for p in some]) + at.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                    yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(where.view(np.int64))], names=["hash", "place"])

    return run


def _filter_of(hashes: DataFrame, bits: int) -> np.ndarray:
    """Bits set at the hashes modulo ``bits``: at most ``bits`` / 8 bytes, whatever the number of hashes."""
    at = F.col("hash").bitwiseAND(F.lit(bits - 1))
    rows = hashes.groupBy(F.shiftright(at, 15).alias("block")).agg(F.bitmap_construct_agg(at.bitwiseAND(F.lit((1 << 15) - 1))).alias("bits"))
    out = np.zeros(bits // 8, dtype=np.uint8)
    for row in rows.toLocalIterator():
        out[row["block"] << 12:(row["block"] + 1) << 12] = np.frombuffer(row["bits"], dtype=np.uint8)
    return out


STRINGS = "id bigint, h1 bigint, hash bigint, s1 bigint, s2 bigint, lo int, core int, hi int"


def _strings(length: int, gram: int, passing: np.ndarray | None):
    """Place and hash of the string around each anchor of a text that passes the filter (if there is none: that is in column ``hashes``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(rows):
            long, int_ = pa.int64(), pa.int32()
            types = (long, long, long, long, long, int_, int_, int_)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=["id", "h1", "hash", "s1", "s2", "lo", "core", "hi"])

        mask = None if passing is None else np.uint64(len(passing) * 8 - 1)
        for batch in batches:
            rows = []
            lists = batch.column("hashes") if passing is None else [None] * batch.num_rows
            for i, h1, text, known in zip(batch.column("id").to_pylist(), batch.column("h1").to_pylist(), batch.column("text"), lists):
                raw = text.as_py().encode()
                at, h, first, last = anchors(np.frombuffer(raw, dtype=np.uint8), length, gram)
                if passing is None:
                    some = np.flatnonzero(np.isin(h.view(np.int64), known.values.to_numpy()))
                else:
                    bit = h & mask
                    some = np.flatnonzero(passing[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8) & 1)
                for a, x, lo, hi in zip(at[some].tolist(), h[some].view(np.int64).tolist(), first[some].tolist(), last[some].tolist()):
                    # The place of the anchor in the string is part of the string's hash.
                    s = xxhash.xxh3_128_digest(raw[lo:hi + length], seed=a - lo)
                    rows.append((i, h1, x, int.from_bytes(s[:8], "big", signed=True), int.from_bytes(s[8:], "big", signed=True), lo, a - lo, hi))
                if len(rows) > 20_000:
                    yield batch_of(rows)
                    rows = []
            if rows:
                yield batch_of(rows)

    return run


def _bytes_of(length: int):
    """The bytes of strings (column ``strings``: structs of hash, c, lo, core and hi) of a text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i, h1, text, strings in zip(*(batch.column(c).to_pylist() for c in ("id", "h1", "text", "strings"))):
                raw = text.encode()
                rows += [(i, h1, x["hash"], x["c"], x["lo"], x["core"], raw[x["lo"]:x["hi"] + length]) for x in strings]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()))],
                                                 names=["id", "h1", "hash", "c", "lo", "core", "s"])

    return run


def _resolve(length: int, gram: int, chunk: int):
    """Strings (rows sorted by hash, each with its smallest place) to the windows that repeat a
    smaller place: (id, h1, lo, hi) runs of window starts."""
    span, side = length - gram + 1, length - gram  # with its anchor as one symbol, a window has ``span``

    def collection(batch: pa.RecordBatch) -> Iterator[tuple[int, int, int, int]]:
        ids, h1, lo, core = (batch.column(c).to_numpy() for c in ("id", "h1", "lo", "core"))
        group = np.cumsum(np.concatenate([[0], np.diff(batch.column("hash").to_numpy()) != 0])).astype(np.uint16)
        # A row per string, all anchors in one column: equal windows start in the same column.
        grid = np.zeros((len(ids), 2 * side + 1), dtype=np.uint8)
        after = np.zeros(len(ids), dtype=np.int64)
        for i, (s, c) in enumerate(zip(batch.column("s").to_pylist(), core.tolist())):
            grid[i, side - c:side] = np.frombuffer(s, np.uint8, c)
            after[i] = len(s) - c - gram
            grid[i, side + 1:side + 1 + after[i]] = np.frombuffer(s, np.uint8, after[i], c + gram)
        rank = np.empty(len(ids), dtype=np.int64)  # of the strings' places
        rank[np.lexsort((lo + core, h1, ids))] = np.arange(len(ids))
        texts, starts = [], []
        for column, order in column_order(grid, group, side):
            if column > side:
                continue
            # Suffixes next to each other that share a whole window are equal windows; strings that are
            # too short to have a window here hold padding in it.
            rows = grid[order, column:column + span]
            new = np.ones(len(order), dtype=bool)
            new[1:] = (rows[1:] != rows[:-1]).any(axis=1) | (group[order][1:] != group[order][:-1])
            has = (core[order] >= side - column) & (after[order] >= column)
            run = np.cumsum(new) - 1
            least = np.full(run[-1] + 1, len(ids))
            np.minimum.at(least, run[has], rank[order[has]])
            later = order[has & (least[run] < rank[order])]
            texts.append(later)
            starts.append(lo[later] + core[later] - (side - column))
        text, start = np.concatenate(texts), np.concatenate(starts)
        order = np.lexsort((start, text))
        text, start = text[order], start[order]
        cut = np.flatnonzero((text[1:] != text[:-1]) | (start[1:] != start[:-1] + 1)) + 1
        for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(text)]):
            if b > a:
                yield int(ids[text[a]]), int(h1[text[a]]), int(start[a]), int(start[b - 1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in groups_of(batches, "hash"):
            edges, lo = boundaries(batch.column("hash").to_numpy()), 0
            while lo < batch.num_rows:
                hi = int(edges[max(np.searchsorted(edges, lo + chunk, "right") - 1, np.searchsorted(edges, lo, "right"))])
                if rows := list(collection(batch.slice(lo, hi - lo))):
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (
                        pa.int64(), pa.int64(), pa.int32(), pa.int32()))], names=["id", "h1", "lo", "hi"])
                lo = hi

    return run


def _cut(length: int, with_text: bool):
    """Removed bytes of each document, from its text and runs of window starts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, los, his, copy in zip(batch.column("text"), batch.column("los"), batch.column("his"), batch.column("copy").to_pylist()):
                raw = text.as_py().encode()
                data = np.frombuffer(raw, dtype=np.uint8)
                gone = np.zeros(len(data) + 1, dtype=np.int64)
                if copy and len(data) >= length:
                    gone[0], gone[-1] = 1, -1
                elif los.is_valid:
                    np.add.at(gone, los.values.to_numpy(), 1)
                    np.add.at(gone, his.values.to_numpy() + length, -1)
                gone = np.cumsum(gone)[:-1] > 0
                spans = int((gone[1:] & ~gone[:-1]).sum() + (gone[:1].sum()))
                rest = data[~gone].tobytes()
                out.append((len(data), int(gone.sum()), spans, hashlib.sha256(rest).hexdigest(), rest.decode("utf-8", "ignore") if with_text else None))
            cols = [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()))] if out else []
            if out:
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("row"), *cols], names=["doc_id", "row", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"])

    return run


def removed_windows(rows: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT, chunk: int = CHUNK, filter_bits: int = FILTER_BITS) -> DataFrame:
    """(id, h1, lo, hi): runs of starts of windows that also start earlier, for the rows of ``_documents``."""
    rows = rows.where(F.col("n") >= length).select("id", "h1", "text")
    found = rows.select("h1", "text").mapInArrow(_anchor_rows(length, gram), "hash bigint, place bigint")
    # An anchor repeats if it is at two places; equal texts have it at one and the same.
    again = found.groupBy("hash").agg(F.min("place").alias("a"), F.max("place").alias("b")).where("a < b").select("hash")
    again = materialize(again, "again")
    bits = 1 << max(15, (BITS_EACH * again.count() - 1).bit_length())
    if bits <= filter_bits:
        strings = rows.mapInArrow(_strings(length, gram, _filter_of(again, bits)), STRINGS)
    else:
        each = rows.select("id", "h1", F.explode(_hashes_of(length, gram)("text")).alias("hash")).join(again, "hash", "left_semi")
        each = each.groupBy("id", "h1").agg(F.collect_set("hash").alias("hashes"))
        strings = rows.join(each, ["id", "h1"]).mapInArrow(_strings(length, gram, None), STRINGS)
    strings = materialize(strings, "strings")
    same = ["hash", "s1", "s2"]
    place = F.struct("id", "h1", "lo")
    least = strings.groupBy(*same).agg(F.min(F.struct("id", "h1", "lo", "core", "hi")).alias("p"))
    least = materialize(least.select(*same, "p.*"), "least")
    # Every window of a string that has a smaller place elsewhere goes.
    smaller = least.select(*same, place.alias("p"))
    copies = strings.select(*same, "id", "h1", "lo", "hi").join(smaller, same).where(place > F.col("p")).select("id", "h1", "lo", "hi")
    per_hash = least.groupBy("hash").agg(F.count("*").alias("c")).where("c > 1")
    several = least.join(per_hash, "hash").groupBy("id", "h1").agg(F.collect_list(F.struct("hash", "c", "lo", "core", "hi")).alias("strings"))
    first = rows.join(several, ["id", "h1"]).dropDuplicates(["id", "h1"]).mapInArrow(_bytes_of(length), "id bigint, h1 bigint, hash bigint, c bigint, lo int, core int, s binary")
    first = materialize(first, "several")
    last = F.length("s") - length
    warm = first.where(F.col("c") <= hot).drop("c").repartition("hash").sortWithinPartitions("hash")
    runs = warm.mapInArrow(_resolve(length, gram, chunk), "id bigint, h1 bigint, lo int, hi int")
    spread = (first.where(F.col("c") > hot).select("hash", "id", "h1", "lo", "s", F.explode(F.sequence(F.lit(0), last)).alias("o"))
              .select("hash", "id", "h1", (F.col("lo") + F.col("o")).alias("lo"), F.col("s").substr(F.col("o") + 1, F.lit(length)).alias("w"))
              .select("hash", F.xxhash64("w").alias("w1"), F.xxhash64(F.lit("2"), "w").alias("w2"), place.alias("p")))
    where = ["hash", "w1", "w2"]
    spread = spread.join(spread.groupBy(*where).agg(F.min("p").alias("q")), where).where("p > q")
    return copies.union(runs).union(spread.select("p.id", "p.h1", "p.lo", F.col("p.lo").alias("hi")))


def _hashes_of(length: int, gram: int):
    @F.pandas_udf("array<bigint>")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: anchors(np.frombuffer(t.encode(), dtype=np.uint8), length, gram)[1].view(np.int64))

    return run


def dedup_substrings(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT, chunk: int = CHUNK, with_text: bool = True, carry: bool = False,
                     filter_bits: int = FILTER_BITS) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept_text (null unless ``with_text``;
    characters that a cut splits are left out of it) and, with ``carry``, ``row``, the whole input row."""
    rows = _documents(docs)
    same = ["n", "h1", "h2"]
    owners = materialize(rows.groupBy(*same).agg(F.min("id").alias("id")), "owners")
    gone = materialize(removed_windows(rows, length, gram, hot, chunk, filter_bits), "windows")
    by_doc = gone.groupBy("id", "h1").agg(F.collect_list("lo").alias("los"), F.collect_list("hi").alias("his"))
    known = owners.join(by_doc, ["id", "h1"], "left").select(*same, F.col("id").alias("owner"), "los", "his")
    if carry:  # the row holds the text
        whole = _documents(docs.withColumn("row", F.struct("*")), "row").drop("text")
        text = F.coalesce("row.text", F.lit(""))
    else:
        whole = _documents(docs.withColumn("row", F.lit(None).cast("string")), "row")
        text = F.col("text")
    out = whole.join(known, same).select("doc_id", "row", text.alias("text"), "los", "his", (F.col("id") > F.col("owner")).alias("copy"))
    schema = out.select("doc_id", "row", *(F.lit(0).cast("long").alias(c) for c in ("n_bytes", "n_removed", "n_spans")),
                        F.lit("").alias("kept_sha256"), F.lit(None).cast("string").alias("kept_text")).schema
    done = out.mapInArrow(_cut(length, with_text), schema)
    return done if carry else done.drop("row")
