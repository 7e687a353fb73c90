import collections
import hashlib
import itertools

import numpy as np
import pytest

import corpus_pipeline
from recoflow.llm import chosen_path, raking
from tests.llm.test_operators import _components, _sets


def test_stages_keep_the_columns(spark):
    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[2:]:
        out = stage(spark, docs, d)
        assert out.columns[:5] == docs.columns and 0 < out.count() <= docs.count(), name
    assert corpus_pipeline.identify_language(spark, docs.limit(0), d).count() == 0


def test_language_fills_and_rejects(spark):
    en, de = "the cat and the dog went to the house with that thing", "der hund und die katze gehen schnell nach dem haus"
    rows = [(i, f"{en} {i}", "en") for i in range(4)] + [(i, f"{de} {i}", "de") for i in range(4, 8)] + [
        (8, "the dog and the cat", None), (9, "die katze und der hund", None), (10, "die katze und der hund", "en"),
        (11, "собака пошла домой", None), (12, "σκύλος και γάτα", None), (13, "123 !", "en"), (14, None, "en")]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(i, t, lang, "s", len(t or "")) for i, t, lang in rows], schema)
    got = {r.doc_id: r.lang for r in corpus_pipeline.identify_language(spark, docs, "").collect()}
    assert got == {**dict.fromkeys(range(4), "en"), **dict.fromkeys(range(4, 8), "de"), 8: "en", 9: "de", 10: "en"}
    unlabelled = docs.selectExpr("doc_id", "text", "cast(null as string) lang", "source", "n_chars")
    assert corpus_pipeline.identify_language(spark, unlabelled, "").count() == 13


def _near(rows, width):
    sets = {r.doc_id: _sets(r.text, width) for r in rows}
    return _components(sets, [(a, b) for a, b in itertools.combinations(sets, 2)
                              if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])])


def _cut(rows):
    """{doc_id: text} without the passages of 100 bytes that came before; emptied texts are left out."""
    seen, out = set(), {}
    for r in sorted(rows, key=lambda r: r.doc_id):
        b = r.text.encode()
        gone = np.zeros(len(b), dtype=bool)
        for p in range(len(b) - 99):
            if b[p:p + 100] in seen:
                gone[p:p + 100] = True
            seen.add(b[p:p + 100])
        rest = bytes(x for x, g in zip(b, gone) if not g).decode()
        if rest or not gone.any():
            out[r.doc_id] = rest
    return out


def _holds(text, item):
    w, i = text.lower().split(), item.lower().split()
    return any(100 * sum(0 <= k + s < len(w) and w[k + s] == x for k, x in enumerate(i)) >= 80 * len(i) for s in range(-len(i), len(w) + 1))


def _least(goal, pairs):
    """x with which the sum of min(room, x * pull) is ``goal``."""
    lo, hi = 0.0, 1e12
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if sum(min(room, mid * pull) for room, pull in pairs) < goal else (lo, mid)
    return hi


def _mixed(rows):
    """{doc_id: probability}"""
    cell = {r.doc_id: (r.source or "unknown", r.lang or "unknown", "symbols" if "### " in r.text else "prose") for r in rows}
    room = collections.Counter()
    for r in rows:
        room[cell[r.doc_id]] += len(r.text.split())
    budget, goals, p = raking.KEEP * sum(room.values()), [], dict.fromkeys(room, 1.0)
    for m in range(3):
        have = collections.Counter()
        for c, n in room.items():
            have[c[m]] += n
        x = _least(budget, [(n, n ** raking.TEMPERATURE) for n in have.values()])
        goals.append({k: min(n, x * n ** raking.TEMPERATURE) for k, n in have.items()})
    for _ in range(raking.ROUNDS):
        for m in range(3):
            for k, goal in goals[m].items():
                own = [c for c in room if c[m] == k]
                x = _least(goal, [(room[c], room[c] * p[c]) for c in own])
                p.update({c: p[c] * x for c in own})
    return {i: min(1.0, p[c]) for i, c in cell.items()}


def test_stages_equal_plain_python(spark, tmp):
    r = np.random.default_rng(21)
    vocabulary = {lang: ["".join(r.choice(list(letters), r.integers(2, 7))) for _ in range(300)]
                  for lang, letters in (("en", "aeioutnshrdl"), ("de", "eäüößkzwbgmf"))}
    texts = [(lang, " ".join(r.choice(vocabulary[lang], 60))) for lang in ("en", "de", "en") for _ in range(10)]
    rows = [(i, t, None if i == 5 else lang, f"s{i % 3}" if i % 7 else None) for i, (lang, t) in enumerate(texts)]
    add = lambda t, lang, source="s1": rows.append((len(rows), t, lang, source))
    for i in range(12):  # near copies and copies
        w = texts[1][1].split()
        w[5 * i % 60] = "newword"
        add(" ".join(w) if i < 9 else texts[1][1], "en")
    passage, item = texts[2][1][:160], " ".join(r.choice(vocabulary["en"], 20))
    add(" ".join(r.choice(vocabulary["en"], 50)) + " " + passage, "en")
    add(passage, "en")
    replaced = " ".join("other" if i % 5 == 2 else x for i, x in enumerate(item.split()))
    add(" ".join(r.choice(vocabulary["en"], 30)) + f" {replaced} " + " ".join(r.choice(vocabulary["en"], 30)), "en")
    add("собака пошла домой и потом", None)
    add("12 34 !", "en")
    add(" ".join(r.choice(vocabulary["de"], 40)) + " ### " + " ".join(r.choice(vocabulary["de"], 5)), "de", "rare")
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([(*x, len(x[1])) for x in rows], schema).write.parquet(f"{tmp}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp}/documents.parquet")
    before = docs.collect()
    for name, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame(before, docs.schema) if name != "language_id" else docs
        after = {x.doc_id: x for x in stage(spark, docs, tmp).collect()}
        got = {i: x.text for i, x in after.items()}
        text = {x.doc_id: x.text for x in before}
        if name == "language_id":
            want = {i: t for i, t in text.items() if i not in (45, 46)}
            assert after[5].lang == "en"
        elif name == "near_dedup":
            roots = _near(before, 5)
            want = {i: t for i, t in text.items() if roots[i] == i}
            assert len(text) - len(want) == 12
        elif name == "suffix_dedup":
            want = _cut(before)
            assert sum(t != text[i] for i, t in want.items()) > 0 and len(want) < len(text)
            assert all(x.n_chars == len(x.text) for x in after.values())
        elif name == "decontamination":
            want = {i: t for i, t in text.items() if not _holds(t, item)}
            assert len(text) - len(want) == 1
        else:
            p = _mixed(before)
            draw = {i: int(hashlib.md5(f"mix:{i}".encode()).hexdigest()[:8], 16) / 2**32 for i in text}
            want = {i: t for i, t in text.items() if draw[i] < p[i]}
            assert all(abs(x.probability - p[i]) < 1e-6 for i, x in after.items()) and max(p.values()) == 1
        assert got == want, name
        before = [x for x in after.values()]
    assert {x.doc_id: x.text for x in corpus_pipeline.run(spark, tmp).collect()} == got


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates_with_deep_trees(spark, width):
    r = np.random.default_rng(width)
    vocabulary = [f"w{i}" for i in range(500)]
    texts = [" ".join(r.choice(vocabulary, 60)) for _ in range(40)]
    for base in texts[:6]:
        for _ in range(12):
            w = base.split()
            w[r.integers(60)] = "changed"
            texts.append(" ".join(w))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = _near(docs.collect(), width)
    assert sorted(collections.Counter(want.values()).values())[-6:] > [8] * 6
    for sizes in ({}, {"leaf": 4, "max_depth": 1, "small": 4, "block": 3}, {"leaf": 4, "max_depth": 3, "small": 2, "block": 2}, {"leaf": 0, "max_depth": 2, "small": 1, "block": 64}):
        got = chosen_path.near_duplicates(docs, width=width, **sizes).collect()
        assert {x.doc_id: x.component_id for x in got} == want, sizes
