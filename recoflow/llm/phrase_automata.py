"""Operator 12: passages that recur across documents, found by sharded Aho-Corasick automata.

A word goes if a window of ``WINDOW`` words that covers it also starts in a document of smaller id.

1. Confirm recurring passages. Of every window, the smallest hash of ``GRAM`` consecutive words is
   its anchor phrase, so equal windows have equal phrases at equal places. Phrases in two or
   more texts recur; their windows are counted by hash with partial minima, which gives
   those that recur across documents and the place of the smallest document that has them.
   Neighbouring ones make a passage of that document.
2. Compile automata. Passages go to shards by their document (a long one's to several), ``SHARD_BYTES`` or so each;
   a shard's anchor phrases become one Aho-Corasick automaton over its own word numbers.
3. Stream documents. Every text that has an anchor phrase of a shard streams past the shard's
   automaton (the words around such phrases, as far as a window reaches), which finds every occurrence of its
   phrases; windows with one are compared, word by word, with the passage that has a window of that
   hash, and runs of ``WINDOW`` equal words or more go from documents of larger id. The segments of a
   busy shard are dealt over several tasks, each with the shard's automaton, so a passage that a third of
   all documents hold is no hot key.

Hashes only choose candidates; what is removed has been compared word by word. Exact copies of a
text are one document, the smallest id; the other copies go whole.

Defined cases: null text has no words; texts under ``WINDOW`` words keep all; rows of one id
never remove each other's words, and rows that repeat id and text get one result; a null id
counts as smaller than any other; an empty table gives an empty result; words are kept as they
are; texts may be of any length; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recoflow.llm.chosen_path import word_hashes
from recoflow.llm.common import materialize, powers

WINDOW = 50
GRAM = 16
SHARD_BYTES = 2_000_000
PIECE = 20_000
#: Bytes of text that stream past one copy of a shard's automaton.
STREAM_BYTES = 8 << 20
NULL_ID = -(1 << 63)


def _window_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of every ``size`` consecutive words, from their hashes."""
    if len(h) < size:
        return np.zeros(0, dtype=np.uint64)
    up, down = powers(len(h) + 1)
    total = np.zeros(len(h) + 1, dtype=np.uint64)
    np.cumsum(h * up[:len(h)], out=total[1:])
    out = (total[size:] - total[:-size]) * down[:len(h) - size + 1]
    out ^= out >> np.uint64(31)
    out *= np.uint64(0x9E3779B97F4A7C15)
    return out ^ (out >> np.uint64(29))


def anchor_phrases(h: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Of every window, the place of its (leftmost) anchor phrase; and the hashes of all phrases."""
    g = _window_hashes(h, gram)
    span, n = window - gram + 1, len(h) - window + 1
    if n < 1:
        return np.zeros(0, dtype=np.int64), g
    # The least phrase among spans of doubling size; of equal ones the left one stays.
    at, size = np.arange(len(g)), 1
    while size < span:
        step = min(size, span - size)
        left, right = at[:-step], at[step:]
        at = np.where(g[left] <= g[right], left, right)
        size += step
    return at, g


def _raw(value: pa.Scalar) -> bytes:
    return memoryview(value.as_buffer()).tobytes()


#: Bytes of texts whose words are hashed at once.
CHUNK_BYTES = 1 << 20


class _Chunk:
    """Some texts of a batch (rows ``lo`` to ``hi``), their words one after another: ``h``, hashes of all words, and the
    ``start``, anchor phrase (``core``) and text of every window inside a text; ``g``, hashes of phrases."""

    def __init__(self, lo: int, raws: list[bytes], window: int, gram: int):
        self.lo, self.hi = lo, lo + len(raws)
        self.words = [raw.split() for raw in raws]  # bytes are split at ASCII white space
        self.n = np.array([len(w) for w in self.words], dtype=np.int64)
        ends = np.cumsum(self.n)
        self.first = ends - self.n
        self.h = word_hashes(b"\n".join(raws))
        at, self.g = anchor_phrases(self.h, window, gram)
        start = np.arange(len(at))
        text = np.searchsorted(ends, start, "right")
        inside = start + window <= ends[text]
        self.start, self.core, self.text = start[inside], at[inside], text[inside]


def _chunks(column: pa.Array, window: int, gram: int) -> Iterator[_Chunk]:
    lo, raws, size = 0, [], 0
    for i, value in enumerate(column):
        raws.append(_raw(value))
        size += len(raws[-1])
        if size >= CHUNK_BYTES or i + 1 == len(column):
            yield _Chunk(lo, raws, window, gram)
            lo, raws, size = i + 1, [], 0


def _scanned(window: int, gram: int):
    """Per text: its size, the hash of its words joined by one space, and its anchor phrases."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in _chunks(batch.column("text"), window, gram):
                sha = [hashlib.sha256(b" ".join(w)).hexdigest() for w in c.words]
                new = np.flatnonzero(np.concatenate([[True], (c.core[1:] != c.core[:-1]) | (c.text[1:] != c.text[:-1])])) if len(c.core) else np.zeros(0, dtype=np.int64)
                offsets = np.searchsorted(c.text[new], np.arange(len(c.n) + 1)).astype(np.int32)
                phrases = pa.ListArray.from_arrays(pa.array(offsets), pa.array(c.g[c.core[new]].view(np.int64)))
                rows = batch.slice(c.lo, c.hi - c.lo)
                yield pa.RecordBatch.from_arrays([*(rows.column(x) for x in ("doc_id", "id", "h1", "h2")), pa.array(c.n), pa.array(sha, pa.string()), phrases],
                                                 names=["doc_id", "id", "h1", "h2", "n_words", "sha", "phrases"])

    return run


def _windows(window: int, gram: int):
    """Windows of recurring phrases (column ``phrases``): hash, phrase, document and place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, h1 = (batch.column(c).to_numpy() for c in ("id", "h1"))
            for c in _chunks(batch.column("text"), window, gram):
                known = batch.column("phrases").slice(c.lo, c.hi - c.lo).flatten().to_numpy()
                some = np.flatnonzero(np.isin(c.g[c.core].view(np.int64), known))
                if len(some):
                    start, text = c.start[some], c.text[some]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(_window_hashes(c.h, window)[start].view(np.int64)), pa.array(c.g[c.core[some]].view(np.int64)), pa.array(ids[c.lo + text]), pa.array(h1[c.lo + text]),
                         pa.array((start - c.first[text]).astype(np.int32))], names=["hash", "phrase", "id", "h1", "at"])

    return run


def _passages(window: int, gram: int, piece: int):
    """A document's recurring windows (``places``) to passages: runs of neighbouring windows, ``piece`` at most, as
    text, with their anchor phrases and the places of those."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i, text, places in zip(batch.column("id").to_pylist(), batch.column("text"), batch.column("places")):
                raw = _raw(text)
                words, (anchor, g) = raw.split(), anchor_phrases(word_hashes(raw), window, gram)
                at = np.sort(places.values.to_numpy())
                new = np.flatnonzero(np.diff(at, prepend=at[0] - 2) > 1)
                for lo, hi in zip(new, [*new[1:], len(at)]):
                    for a in range(int(lo), int(hi), piece):
                        b = min(a + piece, int(hi))
                        cores = np.unique(anchor[at[a:b]])
                        out.append((i, int(at[a]), b" ".join(words[at[a]:at[b - 1] + window]), cores - at[a], g[cores].view(np.int64)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())))],
                                                 names=["id", "at", "body", "cores", "phrases"])

    return run


def _segments(window: int, gram: int):
    """The parts of a text that can hold a passage of a shard: around each of its anchor phrases that the shard has
    (``routes``: structs of shard and phrase), as far as a window reaches; overlapping ones are one segment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i, h1, text, routes in zip(batch.column("id").to_pylist(), batch.column("h1").to_pylist(), batch.column("text"), batch.column("routes")):
                raw = _raw(text)
                at, g = anchor_phrases(word_hashes(raw), window, gram)
                words, cores = raw.split(), np.unique(at)
                shard, phrase = (routes.values.field(c).to_numpy() for c in ("shard", "phrase"))
                order = np.argsort(phrase, kind="stable")
                shard, phrase, mine = shard[order], phrase[order], g[cores].view(np.int64)
                lo, n = np.searchsorted(phrase, mine, "left"), np.searchsorted(phrase, mine, "right")
                n -= lo
                to = shard[np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())]
                core = np.repeat(cores, n)
                order = np.lexsort((core, to))
                to, core = to[order], core[order]
                left, right = np.maximum(core - (window - gram), 0), np.minimum(core + window, len(words))
                new = np.flatnonzero(np.concatenate([[True], (to[1:] != to[:-1]) | (left[1:] > right[:-1])])) if len(to) else []
                for a, b in zip(new, [*new[1:], len(to)]):
                    out.append((int(to[a]), i, h1, int(left[a]), b" ".join(words[left[a]:right[b - 1]])))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()))],
                                                 names=["shard", "id", "h1", "base", "body"])

    return run


class Automaton:
    """Passages of one shard, and an Aho-Corasick automaton over their anchor phrases. Words are numbers of
    the shard's vocabulary, three letters of 128 each in the automaton; words it does not know are 0."""

    def __init__(self, passages: list[tuple[int, bytes, list[int]]], window: int, gram: int):
        self.window, self.gram, self.number = window, gram, {}
        number = self.number
        self.words = [np.array([number.setdefault(w, len(number) + 1) for w in body.split()], dtype=np.int32) for _, body, _ in passages]
        if len(number) >= 1 << 21:
            raise ValueError("a shard has more distinct words than three letters can number")
        self.found = ahocorasick.Automaton()
        for words, (_, _, cores) in zip(self.words, passages):
            for core in cores:
                self.found.add_word(self.letters(words[core:core + gram]), True)
        self.found.make_automaton()
        # Each window's passage and place, by its hash.
        hashes = [_window_hashes(word_hashes(body), window) for _, body, _ in passages]
        sizes = [len(h) for h in hashes]
        hashes = np.concatenate(hashes)
        passage, place = np.repeat(np.arange(len(passages)), sizes), np.concatenate([np.arange(n) for n in sizes])
        owner = np.repeat(np.array([p[0] for p in passages], dtype=np.int64), sizes)
        order = np.lexsort((owner, hashes))
        self.hashes, self.passage, self.place, self.owner = hashes[order], passage[order], place[order], owner[order]

    @staticmethod
    def letters(numbers: np.ndarray) -> str:
        return (numbers[:, None] >> np.array([14, 7, 0]) & 127).astype(np.uint8).tobytes().decode("latin-1")

    def shared(self, owner: int, raw: bytes) -> list[tuple[int, int]]:
        """Runs [lo, hi) of ``window`` words or more that the text shares with passages of smaller documents."""
        get, window = self.number.get, self.window
        words = np.fromiter((get(w, 0) for w in raw.split()), dtype=np.int32)
        starts = len(words) - window + 1
        if starts < 1:
            return []
        ends = np.fromiter((end for end, _ in self.found.iter(self.letters(words))), dtype=np.int64)
        ends = (ends[(ends + 1) % 3 == 0] + 1) // 3  # at borders of words
        if not len(ends):
            return []
        hits = np.zeros(len(words) + 1, dtype=np.int64)
        hits[ends - self.gram + 1] = 1  # phrases that start before a place
        hits = np.cumsum(hits)
        has = hits[window - self.gram + 1:window - self.gram + 1 + starts] > hits[:starts]
        # The passage that a window is compared with is the one of its hash, of the smallest document.
        h = _window_hashes(word_hashes(raw), window)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        some = np.flatnonzero(has & (self.hashes[at] == h) & (self.owner[at] < owner))
        passage, shift = self.passage[at[some]], some - self.place[at[some]]
        order = np.lexsort((some, shift, passage))
        some, passage, shift = some[order], passage[order], shift[order]
        new = np.flatnonzero(np.concatenate([[True], (passage[1:] != passage[:-1]) | (shift[1:] != shift[:-1]) | (some[1:] > some[:-1] + window)])) if len(some) else []
        runs = []
        for a, b in zip(new, [*new[1:], len(some)]):
            lo, hi = int(some[a]), int(some[b - 1]) + window
            same = np.concatenate([[False], words[lo:hi] == self.words[passage[a]][lo - shift[a]:hi - shift[a]], [False]])
            edges = np.flatnonzero(same[1:] != same[:-1])
            runs += [(lo + int(x), lo + int(y)) for x, y in zip(edges[::2], edges[1::2]) if y - x >= window]
        return runs


def _located(window: int, gram: int):
    """Rows sorted by shard and task, passages before segments of texts, to runs of words that go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, passages, automaton = None, [], None
        for batch in batches:
            out = []
            for shard, part, streamed, i, h1, base, body, cores in zip(*(batch.column(c).to_pylist() for c in ("shard", "part", "streamed", "id", "h1", "base")), batch.column("body"),
                                                                       batch.column("cores").to_pylist()):
                if (shard, part) != now:
                    now, passages, automaton = (shard, part), [], None
                if not streamed:
                    passages.append((i, _raw(body), cores))
                    continue
                if automaton is None:
                    automaton = Automaton(passages, window, gram)
                out += [(i, h1, base + lo, base + hi) for lo, hi in automaton.shared(i, _raw(body))]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["id", "h1", "lo", "hi"])

    return run


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts and the runs of words that go, to how many go and the hash of what stays."""
    for batch in batches:
        removed, sha = [], []
        for text, los, his in zip(batch.column("text"), batch.column("los"), batch.column("his")):
            words = _raw(text).split()
            edge = np.zeros(len(words) + 1, dtype=np.int64)
            np.add.at(edge, los.values.to_numpy(), 1)
            np.add.at(edge, his.values.to_numpy(), -1)
            gone = np.cumsum(edge)[:-1] > 0
            removed.append(int(gone.sum()))
            sha.append(hashlib.sha256(b" ".join(w for w, g in zip(words, gone.tolist()) if not g)).hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("h1"), batch.column("h2"), pa.array(removed, pa.int64()), pa.array(sha, pa.string())],
                                         names=["id", "h1", "h2", "n_gone", "rest"])


def _texts(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("id"), F.xxhash64(text).alias("h1"),
                       F.xxhash64(F.lit("2"), text).alias("h2"), text.cast("binary").alias("text"))


def removed_words(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, shard_bytes: int = SHARD_BYTES, piece: int = PIECE,
                  stream_bytes: int = STREAM_BYTES) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept_sha256."""
    texts = _texts(docs)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    scanned = texts.mapInArrow(_scanned(window, gram), f"doc_id {id_type}, id bigint, h1 bigint, h2 bigint, n_words bigint, sha string, phrases array<bigint>")
    scanned = materialize(scanned, "scanned")
    # Phrases of two texts or more (copies are one text), and the texts that have them.
    found = scanned.select("id", "h1", "h2", F.explode("phrases").alias("phrase"))
    again = found.groupBy("phrase").agg(F.min("h1").alias("a"), F.max("h1").alias("b")).where("a < b").select("phrase")
    having = found.join(again, "phrase", "left_semi").groupBy("h1", "h2").agg(F.min("id").alias("id"), F.collect_set("phrase").alias("phrases"))
    having = materialize(texts.select("id", "h1", "h2", "text").join(having, ["id", "h1", "h2"]).dropDuplicates(["id", "h1", "h2"]), "having")

    windows = having.mapInArrow(_windows(window, gram), "hash bigint, phrase bigint, id bigint, h1 bigint, at int")
    windows = windows.groupBy("hash", "phrase").agg(F.min(F.struct("id", "h1", "at")).alias("p"), F.max("id").alias("last")).where("p.id < last")
    by_doc = windows.groupBy("p.id", "p.h1").agg(F.collect_list("p.at").alias("places"))
    by_doc = having.select("id", "h1", "text").join(by_doc, ["id", "h1"])
    passages = by_doc.mapInArrow(_passages(window, gram, piece), "id bigint, at bigint, body binary, cores array<bigint>, phrases array<bigint>")
    passages = materialize(passages, "passages")
    size = passages.agg(F.sum(F.octet_length("body")).alias("n")).first()["n"] or 0
    shards = max(1, -(-size // shard_bytes))
    passages = passages.withColumn("shard", F.pmod(F.xxhash64("id", F.floor(F.col("at") / piece)), F.lit(shards)).cast("int"))

    # A text goes to the shards that have a phrase of it from a smaller document.
    asked = passages.select("shard", "id", F.explode("phrases").alias("phrase")).groupBy("phrase", "shard").agg(F.min("id").alias("least"))
    routes = having.select("id", "h1", F.explode("phrases").alias("phrase")).join(asked, "phrase").where("id > least")
    routes = routes.groupBy("id", "h1").agg(F.collect_list(F.struct("shard", "phrase")).alias("routes"))
    segments = having.select("id", "h1", "text").join(routes, ["id", "h1"]).mapInArrow(_segments(window, gram), "shard int, id bigint, h1 bigint, base bigint, body binary")
    segments = materialize(segments, "segments")
    parts = segments.groupBy("shard").agg(F.ceil(F.sum(F.octet_length("body")) / stream_bytes).cast("int").alias("parts"))
    streams = segments.join(parts, "shard").select("shard", F.pmod(F.xxhash64("id", "h1", "base"), "parts").cast("int").alias("part"), F.lit(True).alias("streamed"),
                                                   "id", "h1", "base", "body", F.lit(None).cast("array<bigint>").alias("cores"))
    none = F.lit(0).cast("long")
    copies = passages.join(parts, "shard").select("shard", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(False).alias("streamed"),
                                                  "id", none.alias("h1"), none.alias("base"), "body", "cores")
    rows = copies.union(streams).repartition("shard", "part").sortWithinPartitions("shard", "part", "streamed")
    runs = materialize(rows.mapInArrow(_located(window, gram), "id bigint, h1 bigint, lo bigint, hi bigint"), "runs")

    gone = runs.groupBy("id", "h1").agg(F.collect_list("lo").alias("los"), F.collect_list("hi").alias("his"))
    cut = having.select("id", "h1", "h2", "text").join(gone, ["id", "h1"]).mapInArrow(_kept, "id bigint, h1 bigint, h2 bigint, n_gone bigint, rest string")
    owners = scanned.groupBy("h1", "h2").agg(F.min("id").alias("owner"))
    whole = (F.col("id") > F.col("owner")) & (F.col("n_words") >= window)
    return scanned.drop("phrases").join(owners, ["h1", "h2"]).join(cut, ["id", "h1", "h2"], "left").select(
        "doc_id", "n_words", F.when(whole, F.col("n_words")).otherwise(F.coalesce("n_gone", F.lit(0).cast("long"))).alias("n_removed"),
        F.when(whole, F.lit(hashlib.sha256().hexdigest())).otherwise(F.coalesce("rest", "sha")).alias("kept_sha256"))
