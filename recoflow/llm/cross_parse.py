"""Operator 9: language identification by cross-parsing entropy.

For each language a suffix automaton is built from a bounded sample of labelled
text. A text is parsed against each automaton: starting anywhere in the sample,
follow the text as far as any substring of the sample goes, count one phrase,
and start again. A text in the sample's language needs few, long phrases. With
p phrases over n symbols and N symbols of sample, p * log2(N) / n is the
cross-parsing entropy per symbol; the language with the least wins, of equal
ones the first in order.

Training needs at most ``SAMPLE_DOCS`` documents of at most ``SAMPLE_DOC_CHARS``
characters and ``SAMPLE_CHARS`` symbols per language, picked by a hash of the id,
whatever the size of the corpus; texts whose label a model of the others
contradicts are left out. Every letter of every sample is a symbol, so the moves of
all automata share one sparse array: a state is a place in it, its move by symbol c
lies c cells further, and each cell names the state that owns it. The model is sent to the tasks. Prediction is
one pass over whole texts without a shuffle. To step through many texts at once,
texts are parsed in blocks of ``BLOCK`` symbols, each of which starts a phrase of
its own; phrases of all blocks are added up. Case is folded, and every run of
other characters than letters is one blank.

A text is explained by the language found if its phrases have ``EXPLAINED`` symbols
or more on average, the last one aside. Text in a language of the model has several
times that; text in letters that no sample holds has one.

Defined cases: a null text, or one without a letter, is ``und`` with score 0;
letters no sample holds are phrases of their own; with no labelled text every
document is ``und``; repeated rows are judged alike; an empty table gives an
empty result; columns other than the id, text and (for training) lang columns
are passed through untouched or not read.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recoflow.llm.common import smallest

SAMPLE_DOCS = 200
MAX_LANGS = 200
SAMPLE_DOC_CHARS = 4_000
SAMPLE_CHARS = 40_000
BLOCK = 512
STEP_CHARS = 2_000_000
UNDETERMINED = "und"
EXPLAINED = 2
BLANK, OTHER, FIRST = 1, 2, 3  # symbols: 0 ends a sample text, then blank, letters of no sample, letters


@dataclass
class Model:
    langs: list[str]
    symbols: np.ndarray  # code point -> symbol
    width: int
    moves: np.ndarray  # cell -> next state, 0 where there is none
    owners: np.ndarray  # cell -> state that has the move
    roots: np.ndarray
    bits: np.ndarray  # log2 of each sample's length


def suffix_automaton(text: list[int]) -> list[dict[int, int]]:
    """Transitions of the automaton of all substrings of ``text``; state 0 is the start."""
    moves: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in text:
        new = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and c not in moves[at]:
            moves[at][c] = new
            at = link[at]
        if at >= 0:
            to = moves[at][c]
            if length[to] == length[at] + 1:
                link[new] = to
            else:
                copy = len(moves)
                moves.append(dict(moves[to]))
                length.append(length[at] + 1)
                link.append(link[to])
                while at >= 0 and moves[at].get(c) == to:
                    moves[at][c] = copy
                    at = link[at]
                link[to] = link[new] = copy
        last = new
    return moves


def _placed(rows: list[dict[int, int]], start: int, width: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Rows of moves laid over each other in cells from ``start`` on, without collisions: the next states and the owners
    of the cells, and the place of state 0. Rows with most moves are placed first, each at the first free one of
    random places; a quarter of the cells gets used."""
    size = max(64, 4 * sum(map(len, rows)), 2 * len(rows))
    pick, at, used = random.Random(len(rows)), [0] * len(rows), bytearray(size + width)
    taken = set()
    for i in sorted(range(len(rows)), key=lambda i: -len(rows[i])):
        p = pick.randrange(size)
        while p in taken or any(used[p + c] for c in rows[i]):
            p = pick.randrange(size)
        taken.add(p)
        at[i] = p
        for c in rows[i]:
            used[p + c] = 1
    moves, owners = np.zeros(size + width, dtype=np.int32), np.zeros(size + width, dtype=np.int32)
    for i, row in enumerate(rows):
        for c, to in row.items():
            moves[at[i] + c], owners[at[i] + c] = start + at[to], start + at[i]
    return moves, owners, start + at[0]


def _symbols_of(texts: list[str], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all texts in one array, blanks collapsed, and where each text ends."""
    low = [t.lower() for t in texts]
    codes = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    sym = table[codes]
    ends = np.cumsum([len(t) for t in low])
    starts = np.concatenate([[0], ends[:-1]])
    blank = sym == BLANK
    before = np.empty_like(blank)
    before[:1] = True
    before[1:] = blank[:-1]
    before[starts[starts < len(sym)]] = True  # a blank that starts a text goes
    keep = ~(blank & before)
    return sym[keep], np.concatenate([[0], np.cumsum(keep)])[ends]


def fit(samples: dict[str, list[str]], sample_chars: int = SAMPLE_CHARS) -> Model | None:
    """A model from texts per language; whole texts are taken until ``sample_chars`` symbols are reached."""
    letters: set[str] = set()
    chosen: dict[str, list[str]] = {}
    for lang in sorted(samples):
        room, taken = sample_chars, []
        for t in dict.fromkeys(samples[lang]):
            if room > 0 and any(c.isalpha() for c in t):
                taken.append(t.lower())
                room -= len(t)
        if taken:
            chosen[lang] = taken
            letters.update(c for t in taken for c in set(t) if c.isalpha())
    if not chosen:
        return None
    table = np.full(0x110000, BLANK, dtype=np.uint32)
    table[[c for c in range(0x110000) if chr(c).isalpha()]] = OTHER
    known = sorted(letters)
    for i, c in enumerate(known):
        table[ord(c)] = FIRST + i
    width = FIRST + len(known)
    parts, owners, roots, bits, start = [np.zeros(width, dtype=np.int32)], [np.zeros(width, dtype=np.int32)], [], [], width
    for lang, taken in chosen.items():
        text: list[int] = []
        for t in taken:
            text += [*_symbols_of([t], table)[0].tolist(), 0]
        rows = [{c: to for c, to in row.items() if c} for row in suffix_automaton(text)]
        moves, owner, root = _placed(rows, start, width)
        parts.append(moves)
        owners.append(owner)
        roots.append(root)
        bits.append(np.log2(max(2, len(text))))
        start += len(moves)
    return Model(list(chosen), table, width, np.concatenate(parts), np.concatenate(owners), np.array(roots), np.array(bits))


def _next(model: Model, state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    """The state each state moves to by a symbol, 0 where there is none."""
    cell = state + symbol
    return np.where(model.owners[cell] == state, model.moves[cell], 0).astype(np.int64)


def phrases(model: Model, sym: np.ndarray, ends: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """Phrases of each text (rows) against each language (columns)."""
    starts = np.concatenate([[0], ends[:-1]])
    n_blocks = -(-(ends - starts) // block)
    text = np.repeat(np.arange(len(ends)), n_blocks)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(n_blocks) - n_blocks, n_blocks)
    at = starts[text] + nth * block
    size = np.minimum(block, ends[text] - at)
    order = np.argsort(-size, kind="stable")
    at, size, text = at[order], size[order], text[order]
    live = np.searchsorted(-size, -np.arange(1, block + 1), side="right")  # blocks longer than each step
    first = _next(model, model.roots[:, None].astype(np.int64), np.arange(model.width)[None, :])
    state = np.repeat(model.roots[:, None].astype(np.int64), len(at), axis=1)
    count = np.zeros(state.shape, dtype=np.int64)
    for j in range(block):
        k = int(live[j])
        if not k:
            break
        c = sym[at[:k] + j].astype(np.int64)
        to = _next(model, state[:, :k], c)
        stuck = (to == 0) & (state[:, :k] != model.roots[:, None])  # a phrase ends before this symbol
        count[:, :k] += stuck
        to = np.where(stuck, first[:, c], to)
        lost = to == 0  # no sample of the language has this symbol
        if lost.any():
            count[:, :k] += lost
            to = np.where(lost, model.roots[:, None], to)
        state[:, :k] = to
    count += state != model.roots[:, None]
    out = np.zeros((len(ends), len(model.langs)))
    for lang in range(len(model.langs)):
        out[:, lang] = np.bincount(text, weights=count[lang], minlength=len(ends))
    return out


def judge(model: Model | None, texts: list[str]) -> tuple[list[str], list[float], list[bool]]:
    """Language and score of each text, and whether the language explains it. The score is the second language's share
    of the two least entropies: 0.5 if they are equal, 1 with one language."""
    langs, scores, explained = [UNDETERMINED] * len(texts), [0.0] * len(texts), [False] * len(texts)
    if model is None or not texts:
        return langs, scores, explained
    sym, ends = _symbols_of(texts, model.symbols)
    starts = np.concatenate([[0], ends[:-1]])
    seen = np.concatenate([[0], np.cumsum(sym != BLANK)])
    letters = seen[ends] - seen[starts]
    n = np.maximum(1, ends - starts)
    count = phrases(model, sym, ends)
    entropy = count * model.bits / n[:, None]
    best = np.argmin(entropy, axis=1)
    two = np.sort(entropy, axis=1)[:, :2]
    score = two[:, -1] / np.maximum(two.sum(axis=1), 1e-12) if entropy.shape[1] > 1 else np.ones(len(texts))
    fits = (count[np.arange(len(texts)), best] - 1) * EXPLAINED < n
    for i in np.flatnonzero(letters > 0):
        langs[i], scores[i], explained[i] = model.langs[best[i]], float(min(1.0, max(0.0, score[i]))), bool(fits[i])
    return langs, scores, explained


def predict(model: Model | None, texts: list[str]) -> tuple[list[str], list[float]]:
    """Language and score of each text."""
    return judge(model, texts)[:2]


def train(docs: DataFrame, eligible: Column | None = None, sample_docs: int = SAMPLE_DOCS,
          sample_chars: int = SAMPLE_CHARS, max_langs: int = MAX_LANGS) -> Model | None:
    """Fit on (doc_id, text, lang) rows where ``eligible`` holds: ``sample_docs`` documents of each of the ``max_langs``
    most frequent languages. The ids are picked first, so that only chosen texts move; of an id on several
    rows one text counts."""
    rows = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & (F.char_length("text") <= SAMPLE_DOC_CHARS))
    if eligible is not None:
        rows = rows.where(eligible)
    keyed = rows.select("doc_id", "lang", F.xxhash64(F.lit("sample"), "doc_id").alias("h")).distinct()
    ids = smallest(keyed, "lang", "h", "doc_id", sample_docs, max_langs)
    picked = rows.select("doc_id", "lang", "text").join(F.broadcast(ids), ["doc_id", "lang"])
    picked = picked.groupBy("doc_id", "lang", "h").agg(F.min("text").alias("text"))  # an id may stand on many rows
    samples: dict[str, list[str]] = {}
    for r in sorted(picked.collect(), key=lambda r: (r.lang, r.h, r.doc_id, r.text)):
        samples.setdefault(r.lang, []).append(r.text)
    return fit(agreed(samples, sample_chars), sample_chars)


def agreed(samples: dict[str, list[str]], sample_chars: int = SAMPLE_CHARS) -> dict[str, list[str]]:
    """The sample without texts in the wrong language: each half is judged by a model of the other
    half, and texts it places elsewhere go. A language that would lose all its texts keeps them."""
    folds = [{k: list(dict.fromkeys(v))[i::2] for k, v in samples.items()} for i in (0, 1)]
    kept: dict[str, list[str]] = {}
    for i in (0, 1):
        model = fit(folds[1 - i], sample_chars)
        for lang, texts in folds[i].items():
            if model is None or lang not in model.langs:
                kept.setdefault(lang, []).extend(texts)
            else:
                kept.setdefault(lang, []).extend(t for t, p in zip(texts, predict(model, texts)[0]) if p == lang)
    return {lang: kept.get(lang) or texts for lang, texts in samples.items()}


def identify(docs: DataFrame, model: Model | None, lang_as: str = "lang_pred", score_as: str = "lang_score",
             explained_as: str | None = None) -> DataFrame:
    """``docs`` with the predicted language, its score and, if named, whether it explains the text as last columns (in
    place of columns so named)."""
    new = [c for c in (lang_as, score_as, explained_as) if c]
    docs = docs.drop(*new)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    schema = docs.select("*", *(F.lit(v).alias(c) for c, v in zip(new, ("", 0.0, False)))).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, texts in text_pieces(batch):
                found = [pa.array(x, t) for x, t in zip(judge(sent.value, texts), (pa.string(), pa.float64(), pa.bool_()))]
                yield pa.RecordBatch.from_arrays([*piece.columns, *found[:len(new)]], names=schema.names)

    return docs.mapInArrow(run, schema)


def text_pieces(batch: pa.RecordBatch, step: int = STEP_CHARS) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of a batch of about ``step`` characters of its ``text`` column, with the texts (null: empty)."""
    texts = [t or "" for t in batch.column("text").to_pylist()]
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= step or i + 1 == len(texts):
            yield batch.slice(start, i + 1 - start), texts[start:i + 1]
            start, size = i + 1, 0
