"""Operators 11 to 13 against brute force: nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import hashlib
import itertools
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from recoflow.llm import phrase_automata, repair, spelling

CLASH = "extra string, word string, n long, shard int, h1 long, phrases string, role2 string"


# ------------------------------------------------------------------ operator 11
def _near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def _variants(rows, min_length=6, min_count=5, ratio=5):
    count = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{low}".encode())
            if h % 199 == 0:
                at = h % len(low)
                low = low[:at] + low[at + 1:]
            if len(low) >= min_length:
                count[low] += 1
    words = {w: n for w, n in count.items() if n >= min_count}
    form, out = {}, {}
    for w, n in words.items():
        near = [v for v in words if _near(w, v)]
        best = min(near, key=lambda v: (-words[v], v)) if near else None
        form[w] = best if best is not None and words[best] >= ratio * n else None
        out[w] = (n, len(near))
    root = {}
    for w in words:
        last = w
        while form[last] is not None:
            last = form[last]
        root[w] = last
    return sorted((w, n, k, form[w], words.get(form[w]), root[w]) for w, (n, k) in out.items())


def _word_rows():
    r = np.random.default_rng(5)
    base = ["another", "anöther", "strasse", "straße", "Éclairs", "éclairs", "àéîõüÿ", "eleven", "thirteen", "x" * 300]
    texts = []
    for i in range(160):
        words = []
        for w in r.choice(base, 25, p=[.2, .05, .2, .05, .05, .05, .1, .1, .15, .05]):
            w, k = str(w), int(r.integers(0, 9))
            at = int(r.integers(0, len(w)))
            if k == 0 and len(w) < 100:
                w = w[:at] + w[at + 1:]
            elif k == 1 and len(w) < 100:
                w = w[:at] + "aeé"[int(r.integers(0, 3))] + w[at:]
            elif k == 2:
                w = w[:at] + "xk"[int(r.integers(0, 2))] + w[at + 1:]
            words.append(w.upper() if k == 3 and w.isascii() else w)
        texts.append(", ".join(words))
    rows = list(enumerate(texts)) + [(900, None), (901, ""), (902, "... 123 _"), (None, "another another"), (3, texts[3]), (3, texts[3])]
    # Chains of forms: 5, 25, 125 and 625 times; Kelvin sign and long s are no letters of the class.
    rows += [(1000 + i, " ".join(["chainsa"] * 5 + ["chainsb"] * 25 + ["chainscc"] * 125)) for i in range(1)]
    rows += [(1001, " ".join(["chainscb"] * 130 + ["chainsccd"] * 700)), (1002, "Kelvins Kelvins ſtrange kelvins " * 4)]
    return rows


@pytest.mark.parametrize("sizes", [{}, {"shard_words": 2, "shard_bytes": 300}])
def test_variants_equal_all_pairs(spark, sizes):
    rows = _word_rows()
    docs = spark.createDataFrame([(*r, "clash", "c", 1, 2, 3, "p", "r") for r in rows], f"doc_id long, text string, {CLASH}")
    got = sorted((r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in spelling.group_variants(docs, **sizes).collect())
    want = _variants(rows)
    assert got == want and len(want) > 60
    assert any(f is not None and r != f for _, _, _, f, _, r in want)  # a chain


def test_variants_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.group_variants(docs).count() == 0
    assert spelling.group_variants(spark.createDataFrame([(1, None), (None, "a b")], "doc_id long, text string")).count() == 0


def test_trie_reaches_every_near_vector():
    r = np.random.default_rng(1)
    words = sorted({"".join(r.choice(list("abcdefgé"), 7)) for _ in range(1500)})
    trie = spelling.Trie(words, np.ones(len(words)))
    asked = sorted({"".join(r.choice(list("abcdefgé"), 7)) for _ in range(200)})
    for limit in (50, 10**6):
        got = {(asked[q], trie.words[w]) for qs, ws in trie.near(asked, limit) for q, w in zip(qs, ws)}
        assert got == {(a, b) for a in asked for b in words if _near(a, b)}
    shorter = [w[:3] + w[4:] for w in words[:100]]
    got = {(shorter[q], trie.words[w]) for qs, ws in trie.near(shorter) for q, w in zip(qs, ws)}
    assert got == {(a, b) for a in shorter for b in words if _near(a, b)}


# ------------------------------------------------------------------ operator 12
def _words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def _passages_removed(rows, window):
    """Per row: (n_words, n_removed, sha256 of what stays)."""
    least = {}
    for doc, text in rows:
        w = _words(text)
        for i in range(len(w) - window + 1):
            key = tuple(w[i:i + window])
            rank = -1 if doc is None else doc
            least[key] = min(least.get(key, rank), rank)
    out = []
    for doc, text in rows:
        w, gone = _words(text), set()
        for i in range(len(w) - window + 1):
            if least[tuple(w[i:i + window])] < (-1 if doc is None else doc):
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def _passage_rows():
    r = np.random.default_rng(11)
    words = [f"w{i}" for i in range(500)] + ["é", "\xa0nb", "\x85x", "語"]
    fresh = lambda n: [str(w) for w in r.choice(words, n)]
    shared, other, tiny = fresh(70), fresh(55), fresh(50)
    long = fresh(3000)
    edited = list(long)
    for i in range(20, 3000, 170):
        edited[i] = "changed"
    texts = [fresh(40) + shared + fresh(30), fresh(10) + shared[:60] + fresh(5) + other, shared, other + shared, tiny, fresh(3) + tiny + fresh(3),
             fresh(9) + tiny[:49] + fresh(9), ["spam"] * 400, ["spam"] * 120 + fresh(20), ["a", "b"] * 200, ["b", "a"] * 100, long, edited, long[1000:1400],
             shared[::-1], fresh(49), ["x" * 3_000] * 60, fresh(4) + ["x" * 3_000] * 55]
    rows = [(i, (" " if i % 2 else " \n\t")[:1 + i % 3].join(t)) for i, t in enumerate(texts)]
    rows += [(100, rows[0][1]), (101, rows[0][1]), (0, rows[0][1]), (102, None), (103, ""), (104, " \x0b\x0c\r\n"), (None, " ".join(other)), (105, " ".join(other)),
             (11, " ".join(shared)), (106, "\x1c".join(fresh(80)))]
    # A passage in every third document, another in two thousand near copies' worth of places.
    rows += [(200 + i, " ".join(fresh(5) + shared + fresh(5))) for i in range(40)]
    near = fresh(160)
    for i in range(30):
        copy = list(near)
        copy[int(r.integers(0, 160))] = f"edit{i}"
        rows.append((300 + i, " ".join(copy)))
    return rows


@pytest.mark.parametrize("sizes", [{}, {"shard_bytes": 500, "piece": 40, "stream_bytes": 20_000}])
def test_passages_equal_a_scan_of_windows(spark, sizes):
    rows = _passage_rows()
    docs = spark.createDataFrame([(*r, "clash", "c", 1, 2, 3, "p", "r") for r in rows], f"doc_id long, text string, {CLASH}")
    got = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in phrase_automata.removed_words(docs, **sizes).collect()), key=str)
    assert got == _passages_removed(rows, 50)


def test_short_windows_and_nothing(spark):
    rows = [(i, " ".join(t)) for i, t in enumerate(itertools.product("ab", repeat=9))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in phrase_automata.removed_words(docs, window=6, gram=2).collect()), key=str)
    assert got == _passages_removed(rows, 6)
    assert phrase_automata.removed_words(docs.limit(0)).count() == 0
    one = phrase_automata.removed_words(spark.createDataFrame([(None, None)], "doc_id long, text string")).collect()
    assert [(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in one] == [(None, 0, 0, hashlib.sha256().hexdigest())]


# ------------------------------------------------------------------ operator 13
def _damage(rows):
    out = {}
    for conv, turn, role, text in rows:
        out.setdefault(conv, [])
        role, text = (" " if x is None else x for x in (role, text))
        x = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if x == 0:
            continue
        text = "" if x == 1 else re.sub("[.!?]", "", text) if x == 2 else text
        out[conv] += [(turn, "user" if x == 4 else role, text)] * (2 if x == 3 else 1)
    return {c: sorted(r, key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), t[2].encode())) for c, r in out.items()}


def _repaired(rows):
    """Everything by a search over automaton states, one row after another."""
    faults, seen = [], set()
    for _, role, text in rows:
        body = re.findall(r"[^\x20\x09-\x0D]", text)
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    states = {"": (0, "", ())}

    def improve(into, state, value):
        if state not in into or value[:2] < into[state][:2]:
            into[state] = value

    def inserted(states):
        for _ in range(3):
            for s, (c, a, t) in list(states.items()):
                role = "assistant" if s == "u" else "user"
                improve(states, role[0], (c + 3, a + "I", (*t, f"{role}:")))
        return states

    for (_, role, text), fault in zip(rows, faults):
        after = {}
        for s, (c, a, t) in inserted(states).items():
            improve(after, s, (c + 4, a + "D", t))
            if fault in ("blank", "duplicate"):
                continue
            more, i = 3 * (fault == "truncated"), role[:1]
            if (i == "s" and s == "") or (i == "u" and s != "u") or (i == "a" and s == "u"):
                improve(after, i, (c + more, a + "K", (*t, f"{role}:{text}")))
            new = "assistant" if s == "u" else "user"
            improve(after, new[0], (c + more + 3, a + "R", (*t, f"{new}:{text}")))
        states = after
    final = inserted(states)
    cost, audit, lines = min((final[s] for s in ("", "a") if s in final), key=lambda v: v[:2])
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def _turns():
    r = np.random.default_rng(2)
    roles, texts = ["user", "assistant", "system", "user", "assistant", "u", "tool", "", None, "Ärzt"], ["Hi.", "Yes!", "cut off", "", " \t\n", None, "a.\x0b", "ok?  ", "Längér text."]
    rows = []
    for conv in range(120):
        n = int(r.integers(1, 9))
        for turn in sorted(int(t) for t in r.integers(0, 12, n)):
            odd = r.random() < 0.4
            role = roles[int(r.integers(0, len(roles)))] if odd else ("user", "assistant")[turn % 2]
            text = texts[int(r.integers(0, len(texts)))] if r.random() < 0.5 else f"Text {int(r.integers(0, 60))}."
            rows.append((conv, None if r.random() < 0.04 else turn, role, text))
    rows += [(None, i, ("user", "assistant")[i % 2], f"T{i}.") for i in range(6)] + [(None, None, "system", "S.")]
    rows += [(500, i, ("user", "assistant")[i % 2] if i % 7 else "tool", f"Turn {i % 90}{'.' if i % 5 else ''}") for i in range(700)]  # one long conversation
    rows += [(501, 3, "user", "Same.")] * 4 + [(502, i, "user", "Same.") for i in range(30)]
    drop = next(t for t in range(1000) if zlib.crc32(f"503:{t}".encode()) % 20 == 0)
    return rows + [(503, drop, "user", "Gone.")]


@pytest.mark.parametrize("segment", [4096, 3])
def test_repair_equals_a_search(spark, segment):
    rows = _turns()
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, first string, copies int")
    got = {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256)
           for r in repair.damage_and_repair(df.repartition(5), segment=segment).collect()}
    want = {c: _repaired(r) for c, r in _damage(rows).items()}
    assert set(got) == set(want)
    for c in want:
        assert got[c] == want[c], c
    assert got[503] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())


def test_repair_of_nothing(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert repair.damage_and_repair(df).count() == 0


def test_any_split_gives_the_same_cell():
    """Spans cut anywhere combine to the cell of all splits (the full interval table)."""
    r = np.random.default_rng(0)
    for _ in range(40):
        rows = [repair.row_cell("uas "[int(r.integers(0, 4))], r.random() < 0.2, r.random() < 0.3) for _ in range(7)]
        table = {(i, i + 1): c for i, c in enumerate(rows)}
        for size in range(2, 8):
            for i in range(8 - size):
                cells = [repair.joined(table[i, k], table[k, i + size]) for k in range(i + 1, i + size)]
                assert all(c == cells[0] for c in cells)
                table[i, i + size] = cells[0]
        assert repair.span_cell(rows) == table[0, 7]
