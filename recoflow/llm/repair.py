"""Operator 13: repair of conversations by weighted CYK interval parsing.

A conversation is well formed if the first letters of its roles give ``(s?(ua)+)?``.
The grammar is in Chomsky normal form and closed under intervals: besides the empty
span E its nonterminals are the alternating strings by first and last letter (UU, UA,
AU, AA) and those behind a leading system turn (S, SU, SA), so every part of a well
formed string has a nonterminal, and ``PRODUCTIONS`` joins two neighbouring spans. A
cell holds, per nonterminal, the least (cost, audit) of a span. Cells of single rows
are closed under insertions on either side, which covers insertions anywhere; longer
spans are combined bottom-up, doubling their length. As any split of a span gives the
same cell, one split per span is enough, and a conversation may be cut anywhere:

1. Rows are range-partitioned by conversation and turn, so that a very long
   conversation spreads over many tasks. Each task reduces its part of a conversation,
   in segments of ``SEGMENT`` rows at most, to one cell and some counts each.
2. Segments (one row for most conversations) are combined per conversation.
3. Rows stream past their conversation's audit, which gives the repaired text and its
   hash, without being held.

Equal costs have prefix-free audits (the letters of an audit fix its cost), so the least
audit of a span is made of the least audits of its parts.

Costs: keep 0, re-role 3, delete 4, insert 3; an undeleted truncated row 3 more; blank and
duplicate rows must be deleted.

Defined cases: null role or text is one space, a null conv_id or turn is one space in the
damage key; a null conv_id is a conversation of its own; null turns come first; rows
with one turn are ordered by role and text; equal rows of one turn are one after
another, and all but the first are duplicates; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recoflow.llm.common import materialize

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
SEGMENT = 4096

E, UU, UA, AU, AA, S, SU, SA = NONTERMINALS = range(8)
ACCEPTED = (E, UA, SA)
#: (left, right, whole): two spans side by side.
PRODUCTIONS = [(E, E, E)] + [p for x in NONTERMINALS[1:] for p in ((E, x, x), (x, E, x))] + [
    (UU, AU, UU), (UU, AA, UA), (UA, UU, UU), (UA, UA, UA), (AU, AU, AU), (AU, AA, AA), (AA, UU, AU), (AA, UA, AA),
    (S, UU, SU), (S, UA, SA), (SU, AU, SU), (SU, AA, SA), (SA, UU, SU), (SA, UA, SA)]
_ROLES = {"u": "user", "a": "assistant"}

Cell = list[tuple[int, str] | None]


def joined(left: Cell, right: Cell) -> Cell:
    """The cell of two spans side by side."""
    out: Cell = [None] * len(NONTERMINALS)
    for x, y, z in PRODUCTIONS:
        a, b = left[x], right[y]
        if a is not None and b is not None:
            new = (a[0] + b[0], a[1] + b[1])
            if out[z] is None or new < out[z]:
                out[z] = new
    return out


#: What insertions alone make of an empty span.
INSERTED: Cell = [(0, ""), (INSERT, "I"), (2 * INSERT, "II"), (2 * INSERT, "II"), (INSERT, "I"), None, None, None]


def row_cell(initial: str, must_go: bool, truncated: bool) -> Cell:
    """The cell of one row, closed under insertions before and after it."""
    cell: Cell = [None] * len(NONTERMINALS)
    cell[E] = (DELETE, "D")
    if not must_go:
        more = TRUNCATED if truncated else 0
        cell[UU] = (more + KEEP, "K") if initial == "u" else (more + REROLE, "R")
        cell[AA] = (more + KEEP, "K") if initial == "a" else (more + REROLE, "R")
        if initial == "s":
            cell[S] = (more + KEEP, "K")
    return joined(joined(INSERTED, cell), INSERTED)


_ROW_CELLS = {(i, g, t): row_cell(i, g, t) for i in ("u", "a", "s", "") for g in (False, True) for t in (False, True)}


def span_cell(cells: list[Cell]) -> Cell:
    """Spans of doubling length, bottom-up."""
    while len(cells) > 1:
        pairs = [joined(a, b) for a, b in zip(cells[::2], cells[1::2])]
        cells = pairs + cells[len(pairs) * 2:]
    return cells[0]


def best(cell: Cell) -> tuple[int, str]:
    return min(cell[x] for x in ACCEPTED if cell[x] is not None)


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) after the damage that crc32 of ``conv_id:turn`` picks."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", space).alias("role"),
                                F.coalesce("text", space).alias("text"), (F.crc32(key.cast("binary")) % 20).alias("damage"))
    text = (F.when(F.col("damage") == 1, F.lit("")).when(F.col("damage") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")))
    role = F.when(F.col("damage") == 4, F.lit("user")).otherwise(F.col("role"))
    rows = rows.where("damage <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), F.when(F.col("damage") == 3, 2).otherwise(1).alias("copies"))
    return rows


_BLANKS = r"[\x20\x09-\x0D]"


def _in_order(*first: Column) -> list[Column]:
    return [F.col("conv_id").asc_nulls_first(), *first, F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]


def faulty(rows: DataFrame) -> DataFrame:
    """One row per distinct (conv_id, turn, role, text), with its number of copies, whether it is the first of
    its role and text, and its fault. Only partial sums and minima are taken, so a message that
    fills a conversation is not gathered in one task."""
    merged = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    merged = merged.withColumn("h1", F.xxhash64("role", "text")).withColumn("h2", F.xxhash64(F.lit("2"), "text", "role"))
    turn = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    least = merged.groupBy("conv_id", "h1", "h2").agg(F.min(turn).alias("first")).select(
        F.col("conv_id").alias("of"), F.col("h1").alias("g1"), F.col("h2").alias("g2"), "first.*").withColumnRenamed("turn", "first_turn")
    same = F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("h1") == F.col("g1")) & (F.col("h2") == F.col("g2"))
    body = F.col("text")
    return merged.join(least, same).select(
        "conv_id", "turn", "role", "text", "copies", F.col("turn").eqNullSafe(F.col("first_turn")).alias("first"),
        (~body.rlike(r"[^\x20\x09-\x0D]")).alias("blank"), (~body.rlike(r"[.!?]" + _BLANKS + r"*\z")).alias("cut"))


SEGMENTS = ("conv_id {id}, place bigint, n bigint, costs array<bigint>, audits array<string>, first string, last string, illegal bigint, "
            "low bigint, high bigint, turns bigint, blank bigint, duplicate bigint, truncated bigint")


class _Segment:
    """What is kept of a run of rows."""

    def __init__(self, conv):
        self.conv, self.cells, self.n, self.first, self.last = conv, [], 0, None, None
        self.illegal = self.blank = self.duplicate = self.truncated = self.turns = 0
        self.low = self.high = None

    def add(self, turn, initial: str, blank: bool, duplicate: bool, cut: bool) -> None:
        duplicate = duplicate and not blank
        truncated = cut and not blank and not duplicate
        self.cells.append(_ROW_CELLS[initial if initial in ("u", "a", "s") else "", blank or duplicate, truncated])
        self.blank += blank
        self.duplicate += duplicate
        self.truncated += truncated
        if self.n:
            self.illegal += self.last + initial not in ("su", "ua", "au")
        else:
            self.first = initial
        self.last = initial
        self.n += 1
        if turn is not None:
            self.turns += turn != self.high
            self.low = turn if self.low is None else self.low
            self.high = turn

    def row(self, place: int) -> tuple:
        cell = span_cell(self.cells)
        return (self.conv, place, self.n, [c and c[0] for c in cell], [c and c[1] for c in cell], self.first, self.last, self.illegal,
                self.low, self.high, self.turns, self.blank, self.duplicate, self.truncated)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _segment_schema(conv: pa.DataType) -> pa.Schema:
    long = pa.int64()
    return pa.schema([("conv_id", conv), ("place", long), ("n", long), ("costs", pa.list_(long)), ("audits", pa.list_(pa.string())),
                      ("first", pa.string()), ("last", pa.string()), *((c, long) for c in ("illegal", "low", "high", "turns", "blank", "duplicate", "truncated"))])


def _segments(size: int):
    """Rows in order to segments; ``place`` orders a conversation's segments: sorted partitions one after another."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        place, now, out = TaskContext.get().partitionId() << 40, None, []
        for batch in batches:
            schema = _segment_schema(batch.schema.field("conv_id").type)
            for conv, turn, role, copies, first, blank, cut in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "copies", "first", "blank", "cut"))):
                for i in range(copies):
                    if now is None or conv != now.conv or now.n == size:
                        if now is not None:
                            out.append(now.row(place))
                            place += 1
                        now = _Segment(conv)
                    now.add(turn, role[:1], blank, not first or i > 0, cut)
            if out:
                yield _batch(out, schema)
                out = []
        if now is not None:
            yield _batch([now.row(place)], schema)

    return run


HEADS = "conv_id {id}, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"


def _combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments in order to one row per conversation. A segment of no rows only names its conversation."""

    def head(segments: list[dict]) -> tuple:
        some = [s for s in segments if s["n"]]
        illegal = sum(s["illegal"] for s in some) + sum(a["last"] + b["first"] not in ("su", "ua", "au") for a, b in zip(some, some[1:]))
        known = [s for s in some if s["low"] is not None]
        turns = sum(s["turns"] for s in known) - sum(a["high"] == b["low"] for a, b in zip(known, known[1:]))
        gaps = known[-1]["high"] - known[0]["low"] + 1 - turns if known else 0
        cells = [[None if c is None else (c, a) for c, a in zip(s["costs"], s["audits"])] for s in some]
        cost, audit = best(span_cell(cells)) if cells else (0, "")
        return (segments[0]["conv_id"], gaps, *(sum(s[c] for s in some) for c in ("blank", "duplicate", "truncated")), illegal, cost, audit)

    held, out = [], []
    for batch in batches:
        schema = pa.schema([("conv_id", batch.schema.field("conv_id").type), *((c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
                            ("audit", pa.string())])
        for s in batch.to_pylist():
            if held and held[0]["conv_id"] != s["conv_id"]:
                out.append(head(held))
                held = []
            held.append(s)
        if out:
            yield _batch(out, schema)
            out = []
    if held:
        yield _batch([head(held)], schema)


def repaired_lines(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[str]:
    """The repaired conversation's ``role:text`` lines, from its rows (role, text) in order."""
    last = ""
    for letter in audit:
        role, text = next(rows) if letter != "I" else ("", "")
        if letter == "D":
            continue
        if letter != "K":
            role = _ROLES["a" if last == "u" else "u"]
        last = role[:1]
        yield f"{role}:{text}"


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each conversation's head and then its rows, in order, to the head with the repaired text's hash."""
    heads = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    stream = ((batch, i) for batch in batches for i in range(batch.num_rows))
    pending = None

    def rows():
        nonlocal pending
        for batch, i in stream:
            if not batch.column("is_row")[i].as_py():
                pending = (batch, i)
                return
            role, text = batch.column("role")[i].as_py(), batch.column("text")[i].as_py()
            for _ in range(batch.column("copies")[i].as_py()):
                yield role, text
        pending = None

    pending, out, schema = next(stream, None), [], None
    while pending is not None:
        batch, i = pending
        head = [batch.column(c)[i].as_py() for c in heads]
        schema = pa.schema([*(batch.schema.field(c) for c in heads), ("repaired_sha256", pa.string())])
        digest, left = hashlib.sha256(), rows()
        for k, line in enumerate(repaired_lines(head[-1], left)):
            digest.update(("\n" if k else "").encode() + line.encode("utf-8", "surrogatepass"))
        for _ in left:  # on to the next head
            pass
        out.append((*head, digest.hexdigest()))
        if len(out) == 2000:
            yield _batch(out, schema)
            out = []
    if out:
        yield _batch(out, schema)


def repair(conversations: DataFrame, rows: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """Per conversation of ``conversations``: faults and cheapest repair of its ``rows`` (conv_id, turn, role, text, copies)."""
    id_type = conversations.schema["conv_id"].dataType.simpleString()
    rows = materialize(faulty(rows), "turns")
    ordered = rows.repartitionByRange(*_in_order()).sortWithinPartitions(*_in_order())
    parts = ordered.mapInArrow(_segments(segment), SEGMENTS.format(id=id_type))
    nothing = [F.lit(0).cast("long").alias(f.name) if f.name == "n" else F.lit(None).cast(f.dataType).alias(f.name) for f in parts.schema.fields[1:]]
    parts = parts.unionByName(conversations.select("conv_id").distinct().select("conv_id", *nothing))
    heads = (parts.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), F.col("place").asc_nulls_first())
             .mapInArrow(_combined, HEADS.format(id=id_type)))
    none = lambda c, t: F.lit(None).cast(t).alias(c)
    heads = heads.select("*", none("turn", "long"), none("role", "string"), none("text", "string"), none("copies", "long"), F.lit(False).alias("is_row"))
    lines = rows.select("conv_id", "turn", "role", "text", F.col("copies").cast("long").alias("copies"), F.lit(True).alias("is_row"))
    both = heads.unionByName(lines, allowMissingColumns=True)
    both = both.repartition("conv_id").sortWithinPartitions(*_in_order(F.col("is_row")))
    return both.mapInArrow(_hashed, HEADS.format(id=id_type) + ", repaired_sha256 string")


def damage_and_repair(conversations: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """The conversations, damaged as above, with their faults, cheapest edits and the repaired text's hash."""
    return repair(conversations, damaged(conversations), segment)
