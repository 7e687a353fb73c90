"""Operator 10: near-duplicate documents by chosen-path set similarity join.

A document is the set of its distinct ``width``-word shingles (64-bit hashes).
Documents of one and the same set are one class, found with a partial minimum,
and go on as a single representative. Each representative has a signature of
``COORDS`` minwise tokens. A tree starts with all representatives in its root,
whose children hold those that have the same minwise tokens at two coordinates,
the tree's own. Any other node branches by two coordinates of the signature,
chosen by its path, and a child holds the members that have the same token at one.
At a similarity of 0.8 a pair stays together in a root's child with probability
0.64, and in one of two later children with 0.96; ``TREES`` independent trees
miss a pair with a probability of 2e-9.

At each depth, for all nodes of all trees at once, nodes of ``SMALL`` members or fewer are leaves. In larger ones

* every member is compared with its node's smallest and largest id, which links
  a group of near copies, however large, with a linear number of comparisons;
* links found so far are turned into components, and nodes within one component
  are done. A node whose members of different components make at most ``LEAF``
  pairs per member is a leaf too;
* other nodes branch again. A child that holds more than half of its parent's members does not shrink, and is
  a leaf as well, and so is what is large after ``MAX_DEPTH`` branchings: nothing is given up.

Leaves are compared exhaustively, inside tasks: a large one is dealt into blocks of ``BLOCK``, and each
pair of blocks is a unit of work. A large group of near copies is a large leaf in every tree, so large leaves with the
same largest component are put together where that makes fewer rows, and compared once instead of once for each tree
and branch. The members of that component have blocks of their own, which are not compared with one another. No pair
of documents becomes a row before it counts:

* a unit of one block gives the spanning forest of its likely pairs, the most alike first, across components only. Those
  are confirmed, each once for all trees, and give new components;
* where likely pairs of different components are left then, the sets of these documents go to the
  unit, which compares them all and gives a spanning forest of the links. A pair is compared in one
  node only, the smallest in which both are left.

Comparisons are first made on sizes and on four bits of each minwise token (a
pair at the threshold fails that with a probability of about 1e-6); pairs that
pass are confirmed on the full sets, made anew from the whole texts.

Defined cases: words are what lies between ASCII white space, A-Z lower-cased; a
text with fewer words than ``width`` is one shingle; null and empty texts, and
texts without words, have an empty set and link with nothing; rows that repeat
an id are one vertex, each with its own n_shingles; a row with a null id is kept
and has no component; an empty table gives an empty result; columns other than
doc_id and text are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recoflow.llm.common import boundaries, connected_components, groups_of, materialize, powers

WIDTH = 5
PERCENT = 80
COORDS = 64
TREES = 20
LEAF = 256
SMALL = 256
BLOCK = 128
#: Texts to compare are picked by a broadcast of their ids up to this number (8 bytes each), by a shuffle beyond.
MAX_IDS = 1_000_000
MAX_DEPTH = 4
#: Of 64 four-bit tokens, a pair at 0.8 has 52 equal on average (deviation 3.1).
MIN_EQUAL = 36
_K = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _K[3]
    h = (h ^ (h >> np.uint64(29))) * _K[0]
    return h ^ (h >> np.uint64(32))


_RNG = np.random.default_rng(11)
_A = _RNG.integers(0, 1 << 63, (COORDS, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RNG.integers(0, 1 << 63, (COORDS, 1), dtype=np.uint64)
_LETTER = _RNG.integers(0, 1 << 63, 256, dtype=np.uint64)
_BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_PIECE = 1 << 16
#: Longer words get a hash of their own; polynomials modulo 2**64 are weak only on long strings.
_LONG = 64
_NEXT_BLANK = re.compile(rb"[\x20\x09-\x0D]")


def word_hashes(raw: bytes) -> np.ndarray:
    """Hashes of the words between ASCII white space, in order: one polynomial over the bytes of a piece of
    text gives those of all its words at once."""
    out, lo = [], 0
    while lo < len(raw):
        cut = _NEXT_BLANK.search(raw, lo + _PIECE)
        hi = cut.start() if cut else len(raw)
        data = np.frombuffer(raw, dtype=np.uint8, count=hi - lo, offset=lo)
        inside = np.zeros(len(data) + 2, dtype=bool)
        np.logical_not(_BLANK[data], out=inside[1:-1])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        start, end = edges[::2], edges[1::2]
        up, down = powers(len(data) + 1)
        total = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_LETTER[data] * up[:len(data)], out=total[1:])
        h = _mix((total[end] - total[start]) * down[start])
        for i in np.flatnonzero(end - start > _LONG).tolist():
            h[i] = xxhash.xxh64_intdigest(raw[lo + start[i]:lo + end[i]])
        out.append(h)
        lo = hi
    return np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)


def shingles(text: str | None, width: int) -> np.ndarray:
    """Sorted hashes of a text's distinct shingles. Bytes are lower-cased and
    split as ASCII, which leaves other letters and blanks alone."""
    h = word_hashes((text or "").encode("utf-8", "surrogatepass").lower())
    if not len(h):
        return h
    size = min(width, len(h))
    out = np.full(len(h) - size + 1, size, dtype=np.uint64)
    for k in range(size):
        out = _mix(out * _K[1] + h[k:len(h) - size + 1 + k])
    return np.unique(out)


def minwise(s: np.ndarray) -> np.ndarray:
    """The smallest of all hashed shingles, per hash function (32 bits)."""
    least = (s[None, :2048] * _A + _B).min(axis=1)
    for i in range(2048, len(s), 2048):
        least = np.minimum(least, (s[None, i:i + 2048] * _A + _B).min(axis=1))
    return (least >> np.uint64(32)).astype(np.uint32)


SIGNED = "doc_id bigint, n bigint, h1 bigint, h2 bigint, k0 bigint, k1 bigint, k2 bigint, k3 bigint, sig array<int>"


def signatures(docs: DataFrame, width: int) -> DataFrame:
    """Per row: size of its set, a 128-bit hash of it, packed four-bit tokens, and the minwise tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            nums, sig = np.zeros((7, n), dtype=np.uint64), np.zeros((n, COORDS), dtype=np.uint32)
            for i, text in enumerate(batch.column("text")):
                s = shingles(text.as_py(), width)
                nums[0, i] = len(s)
                if len(s):
                    nums[1, i], nums[2, i] = _mix(s).sum(), _mix(s ^ _K[2]).sum()
                    sig[i] = minwise(s)
            four = (sig & np.uint32(15)).astype(np.uint64).reshape(n, 4, 16)
            nums[3:] = (four << (np.arange(16, dtype=np.uint64) * np.uint64(4))).sum(axis=2, dtype=np.uint64).T
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, n * COORDS + 1, COORDS, dtype=np.int32)), pa.array(sig.view(np.int32).ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(x.view(np.int64)) for x in nums), lists],
                                             names=["doc_id", "n", "h1", "h2", "k0", "k1", "k2", "k3", "sig"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SIGNED)


def _alike(a: str, b: str, percent: int) -> Column:
    """Whether two rows may be similar enough, by sizes and four-bit tokens."""
    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    differ = F.lit(0)
    for k in range(4):
        x = F.col(f"{a}.k{k}").bitwiseXOR(F.col(f"{b}.k{k}"))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(0x1111111111111111))
        differ = differ + F.bit_count(x)
    return (F.least(na, nb) * 100 >= F.greatest(na, nb) * percent) & (differ <= COORDS - MIN_EQUAL)


def _texts(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(doc_id, text) of some documents, written once for several joins."""
    ids = materialize(ids.distinct(), "ids")
    few = F.broadcast(ids) if ids.count() <= MAX_IDS else ids
    return materialize(docs.select("doc_id", "text").join(few, "doc_id", "left_semi"), "texts")


def confirm(pairs: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Of the pairs (u, v), those whose whole texts are similar enough. ``docs`` has one row per id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, right = None, None
        for batch in batches:
            keep = []
            for text_u, text_v in zip(batch.column("tu"), batch.column("tv")):
                if right is None or text_v.as_py() != last:
                    last, right = text_v.as_py(), shingles(text_v.as_py(), width)
                left = shingles(text_u.as_py(), width)
                both = np.concatenate([left, right])
                both.sort()
                shared = int((both[1:] == both[:-1]).sum())
                keep.append(shared > 0 and 100 * shared >= percent * (len(both) - shared))
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    if pairs.isEmpty():
        return pairs
    text = _texts(docs, pairs.select(F.explode(F.array("u", "v")).alias("doc_id")))
    both = (pairs.join(text.select(F.col("doc_id").alias("u"), F.col("text").alias("tu")), "u")
            .join(text.select(F.col("doc_id").alias("v"), F.col("text").alias("tv")), "v"))
    return both.select("u", "v", "tu", "tv").mapInArrow(run, "u bigint, v bigint")


class _Forest:
    """Disjoint sets of the labels 0 to n - 1."""

    def __init__(self, n: int):
        self.up, self.left = list(range(n)), n

    def join(self, a: int, b: int) -> bool:
        """Whether the two were apart."""
        up = self.up
        while up[a] != a:
            up[a] = a = up[up[a]]
        while up[b] != b:
            up[b] = b = up[up[b]]
        if a == b:
            return False
        up[max(a, b)] = min(a, b)
        self.left -= 1
        return True


def _likely(batch: pa.RecordBatch, component: str, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of a unit's rows (later, earlier) of different components that may be similar enough, by sizes and
    four-bit tokens, the most alike first; and each row's component as a small number. Only pairs of different
    blocks count in a unit of two blocks."""
    n = batch.column("n").to_numpy()
    label = np.unique(batch.column(component).to_numpy(), return_inverse=True)[1]
    side = batch.column("side").to_numpy()
    k = [batch.column(f"k{i}").to_numpy().view(np.uint64) for i in range(4)]
    later, earlier, differ = [], [], []
    step = max(1, (1 << 20) // len(n))
    for lo in range(0, len(n), step):
        rows = np.arange(lo, min(lo + step, len(n)))
        apart = (label[rows, None] != label) & (rows[:, None] > np.arange(len(n)))
        if side[0] != side[-1]:
            apart &= side[rows, None] != side
        apart &= np.minimum(n[rows, None], n) * 100 >= np.maximum(n[rows, None], n) * percent
        i, j = np.nonzero(apart)
        i += lo
        d = np.zeros(len(i), dtype=np.int64)
        for x in k:
            y = x[i] ^ x[j]
            y |= y >> np.uint64(2)
            y |= y >> np.uint64(1)
            d += np.bitwise_count(y & np.uint64(0x1111111111111111))
        some = d <= COORDS - MIN_EQUAL
        later.append(i[some])
        earlier.append(j[some])
        differ.append(d[some])
    i, j, d = np.concatenate(later), np.concatenate(earlier), np.concatenate(differ)
    order = np.lexsort((j, i, d))
    return i[order], j[order], label


def _tree(batch: pa.RecordBatch, component: str, percent: int) -> list[tuple[int, int]]:
    """The spanning forest of a unit's likely pairs, over components."""
    i, j, label = _likely(batch, component, percent)
    forest, out = _Forest(int(label.max()) + 1), []
    for a, b, x, y in zip(i.tolist(), j.tolist(), label[i].tolist(), label[j].tolist()):
        if forest.join(x, y):
            out.append((a, b))
            if forest.left == 1:
                break
    return out


def _each_unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in groups_of(batches, "unit"):
        edges = boundaries(batch.column("unit").to_numpy())
        for a, b in zip(edges[:-1], edges[1:]):
            if b - a > 1:
                yield batch.slice(a, b - a)


def _pairs_of(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=names)


def _first_pairs(percent: int):
    """Units of one block to the pairs of their spanning forests, with the node; of others, only the node if any pair is likely."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for unit in _each_unit(batches):
            ids, node = unit.column("doc_id").to_numpy(), int(unit.column("node")[0].as_py())
            if unit.column("side")[0].as_py() != unit.column("side")[unit.num_rows - 1].as_py():
                if len(_likely(unit, "known", percent)[0]):
                    out.append((node, None, None))
                continue
            out += [(node, int(max(ids[a], ids[b])), int(min(ids[a], ids[b]))) for a, b in _tree(unit, "known", percent)]
            if len(out) > 20_000:
                yield _pairs_of(out, ["node", "u", "v"])
                out = []
        if out:
            yield _pairs_of(out, ["node", "u", "v"])

    return run


def _left_over(percent: int):
    """Units to the documents that are in likely pairs of different components still, other than the pairs that
    were in the unit's first forest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit in _each_unit(batches):
            i, j, _ = _likely(unit, "component", percent)
            if not len(i):
                continue
            one = unit.column("side")[0].as_py() == unit.column("side")[unit.num_rows - 1].as_py()
            tested = np.array([a * unit.num_rows + b for a, b in _tree(unit, "known", percent)] if one else [], dtype=np.int64)
            new = ~np.isin(i * unit.num_rows + j, tested)
            rows = np.unique(np.concatenate([i[new], j[new]]))
            if len(rows):
                yield unit.take(pa.array(rows))

    return run


def _links_within(width: int, percent: int):
    """Units, with texts, to a spanning forest of the links between components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit in _each_unit(batches):
            i, j, label = _likely(unit, "component", percent)
            ids, out = unit.column("doc_id").to_numpy(), []
            # Pairs that are left in a smaller node as well are compared there.
            nodes, node = unit.column("nodes"), unit.column("node")[0].as_py()
            held, owner = nodes.flatten().to_numpy(), np.repeat(np.arange(unit.num_rows), nodes.value_lengths().to_numpy())
            held, owner = held[held < node], owner[held < node]
            if len(held):
                names, at = np.unique(held, return_inverse=True)
                inside = np.zeros((unit.num_rows, len(names)), dtype=np.float32)
                inside[owner, at] = 1
                own = (inside @ inside.T)[i, j] == 0
                i, j = i[own], j[own]
            if not len(i):
                continue
            sets = [shingles(t.as_py(), width) for t in unit.column("text")]
            sizes = np.array([len(x) for x in sets])
            tokens, owners = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
            order = np.argsort(tokens, kind="stable")
            tokens, owners = tokens[order], owners[order]
            forest = _Forest(int(label.max()) + 1)
            order = np.argsort(i, kind="stable")
            i, j = i[order], j[order]
            edges = boundaries(i)
            for a, b in zip(edges[:-1], edges[1:]):
                row, other = int(i[a]), j[a:b]
                lo, hi = np.searchsorted(tokens, sets[row], "left"), np.searchsorted(tokens, sets[row], "right")
                n = hi - lo
                hits = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
                shared = np.bincount(owners[hits], minlength=len(sets))[other]
                for x in other[100 * shared >= percent * (sizes[other] + sizes[row] - shared)].tolist():
                    if forest.join(int(label[row]), int(label[x])):
                        out.append((int(max(ids[row], ids[x])), int(min(ids[row], ids[x]))))
            if out:
                yield _pairs_of(out, ["u", "v"])

    return run


def _largest(leaves: DataFrame, block: int) -> DataFrame:
    """Per node: rows, its largest component (ties: the smallest) with its rows, and the rows its units take."""
    parts = leaves.groupBy("node", "known").agg(F.count("*").alias("c"))
    nodes = parts.groupBy("node").agg(F.sum("c").alias("m"), F.min(F.struct(-F.col("c"), "known")).alias("top"))
    nodes = nodes.select("node", "m", F.col("top.known").alias("major"), (-F.col("top.col1")).alias("alike"))
    # Of a component that fills blocks of its own, rows meet the others only.
    apart = F.col("alike") > block
    own = F.when(apart, F.ceil(F.col("alike") / block)).otherwise(0).cast("int")
    others = F.ceil((F.col("m") - F.when(apart, F.col("alike")).otherwise(0)) / block).cast("int")
    nodes = nodes.withColumn("own", own).withColumn("others", others)
    return nodes.withColumn("cost", F.when(apart, F.col("alike")).otherwise(0) * F.col("others")
                            + (F.col("m") - F.when(apart, F.col("alike")).otherwise(0)) * (F.col("own") + F.col("others")))


def _together(leaves: DataFrame, block: int) -> DataFrame:
    """Leaves (node, doc_id, known), those of more than a block with the same largest component as one where that
    makes fewer rows of units, with the columns of ``_largest``."""
    nodes = materialize(_largest(leaves, block), "leaf-sizes")
    large = materialize(leaves.join(nodes.where(F.col("m") > block).select("node", "major"), "node"), "large-leaves")
    whole = large.select(F.xxhash64("major", F.lit("leaves")).alias("node"), "major", "doc_id", "known").distinct()
    ours = nodes.where(F.col("m") > block).groupBy("major").agg(F.sum("cost").alias("apart"), F.count("*").alias("leaves"))
    fewer = _largest(whole, block).join(whole.select("node", F.col("major").alias("of")).distinct(), "node")
    fewer = fewer.join(ours.withColumnRenamed("major", "of"), "of").where("leaves > 1 and cost < apart")
    fewer = materialize(fewer.select("of", "node", "m", "major", "alike", "own", "others", "cost"), "joined-leaves")
    gone = nodes.join(fewer.select(F.col("of").alias("major")), "major", "left_semi").where(F.col("m") > block).select("node")
    columns = ["node", "doc_id", "known", "major", "own", "others"]
    kept = leaves.join(nodes.join(gone, "node", "left_anti"), "node").select(columns)
    return kept.union(whole.drop("major").join(fewer.drop("of"), "node").select(columns))


def _units(leaves: DataFrame, light: DataFrame, block: int) -> DataFrame:
    """The members of leaves (node, doc_id, known) in units: each pair of a node's blocks of which one holds others
    than the node's largest component."""
    apart = (F.col("own") > 0) & (F.col("known") == F.col("major"))
    deal = F.when(apart, F.col("others") + F.pmod(F.xxhash64("doc_id"), F.greatest("own", F.lit(1)))).otherwise(
        F.pmod(F.xxhash64("doc_id"), F.greatest("others", F.lit(1))))
    rows = _together(leaves, block).withColumn("side", deal.cast("int"))
    meets = F.when(apart, F.col("others")).otherwise(F.col("own") + F.col("others"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), meets - 1)))
    unit = F.when(F.col("own") + F.col("others") == 1, F.col("node")).otherwise(F.xxhash64("node", F.least("side", "other"), F.greatest("side", "other")))
    rows = rows.select(unit.alias("unit"), "node", "doc_id", "side", "known", F.col("known").alias("component")).join(light, "doc_id")
    return rows.select("unit", "node", "side", "doc_id", "known", "component", "n", "k0", "k1", "k2", "k3")


def _by_unit(rows: DataFrame) -> DataFrame:
    return rows.repartition("unit").sortWithinPartitions("unit", "side", "doc_id")


def _labelled(rows: DataFrame, links: DataFrame | None, name: str) -> DataFrame:
    """Rows with the component of their doc_id (its own id if it has no links)."""
    if links is None:
        return rows.withColumn(name, F.col("doc_id"))
    # Links are stars here: every document but the least of its component is u once.
    return rows.join(links.select(F.col("u").alias("doc_id"), F.col("v").alias(name)), "doc_id", "left").withColumn(name, F.coalesce(name, "doc_id"))


def _stars(links: DataFrame) -> DataFrame:
    """Links that stand for the components of the given ones."""
    comp = connected_components(links)
    return materialize(comp.select(F.col("id").alias("u"), F.col("component").alias("v")).where("u <> v"), "stars")


def find_links(classes: DataFrame, docs: DataFrame, width: int, percent: int, leaf: int = LEAF,
               max_depth: int = MAX_DEPTH, trees: int = TREES, small: int = SMALL, block: int = BLOCK) -> DataFrame:
    """Links (u, v) between representatives that give the components of the whole similarity graph."""
    light = classes.drop("sig")
    first = [F.xxhash64(F.lit(t), F.element_at("sig", 2 * t + 1), F.element_at("sig", 2 * t + 2)) for t in range(trees)]
    nodes = classes.select(F.explode(F.array(*first)).alias("node"), "doc_id", F.lit(None).cast("long").alias("parent"))
    leaves, links = None, None
    for depth in range(1, max_depth + 1):
        sizes = nodes.groupBy("node").agg(F.count("*").alias("m"), F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi")
        # Most nodes hold one document.
        nodes = materialize(nodes.join(sizes, "node"), "nodes")
        settled = (F.col("m") <= small) | F.coalesce(2 * F.col("m") > F.col("parent"), F.lit(False))
        leaves = _plus(leaves, nodes.where(settled).select("node", "doc_id"))
        large = nodes.where(~settled)
        if large.isEmpty():
            break
        pivots = large.select("doc_id", F.explode(F.array("lo", "hi")).alias("v")).where("doc_id <> v")
        pivots = pivots.select(F.greatest("doc_id", "v").alias("u"), F.least("doc_id", "v").alias("v")).distinct()
        new = confirm(materialize(_checked(pivots, light, percent), "pairs"), docs, width, percent)
        links = _stars(_plus(links, materialize(new, "links")))
        rows = materialize(_labelled(large.select("node", "doc_id", "m"), links, "component"), "labelled")
        # Nodes with members of several components, and how many pairs those make.
        by_label = rows.groupBy("node", "component").agg(F.count("*").alias("c"))
        cross = by_label.groupBy("node").agg(F.sum("c").alias("all"), F.sum(F.col("c") * F.col("c")).alias("squares"))
        cross = cross.select("node", ((F.col("all") * F.col("all") - F.col("squares")) / 2).alias("cross")).where("cross > 0")
        rows = materialize(rows.join(cross, "node"), "mixed")
        done = F.lit(True) if depth == max_depth else F.col("cross") <= leaf * F.col("m")
        leaves = _plus(leaves, rows.where(done).select("node", "doc_id"))
        rest = rows.where(~done)
        if depth == max_depth or rest.isEmpty():
            break
        at = F.pmod(F.xxhash64("node", "branch"), F.lit(COORDS)).cast("int") + 1
        nodes = (rest.select("node", "doc_id", F.col("m").alias("parent")).join(classes.select("doc_id", "sig"), "doc_id")
                 .select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("branch"))
                 .select(F.xxhash64("node", "branch", F.element_at("sig", at)).alias("node"), "doc_id", "parent"))

    # One row a document takes the labels, so that memberships need one join only.
    known = materialize(_labelled(classes.select("doc_id").distinct(), links, "known"), "known")
    leaves = materialize(leaves.join(known, "doc_id"), "leaves")
    if links is not None:  # what the larger nodes' links have settled
        mixed = leaves.groupBy("node").agg(F.min("known").alias("a"), F.max("known").alias("b")).where("a < b").select("node")
        leaves = materialize(leaves.join(mixed, "node", "left_semi"), "leaves")
    units = materialize(_units(leaves, light, block), "units")
    pairs = _by_unit(units).mapInArrow(_first_pairs(percent), "node bigint, u bigint, v bigint")
    pairs = materialize(pairs, "first-pairs")
    new = materialize(confirm(materialize(pairs.where("u IS NOT NULL").select("u", "v").distinct(), "pairs"), docs, width, percent), "links")
    links = _plus(links, new)
    # Units where likely pairs are left after these.
    units = units.join(pairs.select("node").distinct(), "node", "left_semi")
    known = materialize(_labelled(classes.select("doc_id").distinct(), _stars(links), "component"), "known")
    units = units.drop("component").join(known, "doc_id").select(units.columns)
    left = materialize(_by_unit(units).mapInArrow(_left_over(percent), units.schema), "left-over")
    if not left.isEmpty():
        nodes = left.groupBy("doc_id").agg(F.collect_set("node").alias("nodes"))  # a few for each tree
        rows = left.join(nodes, "doc_id").join(_texts(docs, left.select("doc_id")), "doc_id")
        links = _plus(links, materialize(_by_unit(rows).mapInArrow(_links_within(width, percent), "u bigint, v bigint"), "links"))
    return links


def _checked(pairs: DataFrame, light: DataFrame, percent: int) -> DataFrame:
    """Pairs of ids that pass the comparison of sizes and tokens."""
    some = pairs.join(light.withColumnRenamed("doc_id", "u").alias("a"), "u").select(
        "v", F.struct("u", "n", "k0", "k1", "k2", "k3").alias("a"))
    some = some.join(light.withColumnRenamed("doc_id", "v"), "v").select(
        "a", F.struct("v", "n", "k0", "k1", "k2", "k3").alias("b"))
    return some.where(_alike("a", "b", percent)).select("a.u", "b.v")


def _plus(held: DataFrame | None, new: DataFrame) -> DataFrame:
    return new if held is None else held.union(new)


def near_duplicates(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, leaf: int = LEAF,
                    max_depth: int = MAX_DEPTH, trees: int = TREES, small: int = SMALL, block: int = BLOCK) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    signed = materialize(signatures(docs, width), "signed")
    same = ["n", "h1", "h2"]
    owners = signed.where("doc_id is not null and n > 0").groupBy(*same).agg(F.min("doc_id").alias("rep"))
    owners = materialize(owners, "classes")
    # An id may stand for several sets; each has its own row, under the id that owns the set.
    classes = materialize(signed.join(owners, same).where("doc_id = rep").select("doc_id", "n", "k0", "k1", "k2", "k3", "sig")
                          .distinct(), "representatives")
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    repeats = _repeats(signed)
    links = find_links(classes, text.distinct() if repeats else text, width, percent, leaf, max_depth, trees, small, block)
    # Copies hang on their representative; representatives on the least id of their component.
    copies = signed.where("n > 0").join(owners, same).where("doc_id > rep").select(F.col("doc_id").alias("u"), F.col("rep").alias("v"))
    comp = connected_components(links.union(copies)) if repeats else connected_components(links)
    rep = signed.join(owners, same, "left").select("doc_id", "n", F.coalesce("rep", "doc_id").alias("rep"))
    out = rep.join(comp.withColumnRenamed("id", "rep"), "rep", "left")
    out = out.select("doc_id", F.col("n").alias("n_shingles"),
                     F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "rep")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _repeats(signed: DataFrame) -> bool:
    """Whether an id stands on several rows."""
    return not signed.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").isEmpty()
