"""Benchmark phrases in documents against plain Python; no Python in the plan."""

import random
import re
import string

import pytest

from wakeline.llm import leaks as L

from .cases import ODD

ITEMS = "item_id long, text string"
_LOW = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(_LOW))


def plain(docs, items, window=10, near_words=6, near_width=30):
    cut = [(i, words(t)) for i, t in items]
    phrases = {(i, tuple(w[s : s + window])) for i, w in cut if w for s in range(max(len(w) - window, 0) + 1)}
    counts = {}
    for _, t in docs:
        for w in words(t):
            counts[w] = counts.get(w, 0) + 1
    rarest = {}
    for i in {i for i, w in cut if w}:
        held = {x for j, w in cut if j == i for x in w}
        rarest[i] = sorted(held, key=lambda w: (counts.get(w, 0), w.encode()))[:near_words]
    out = []
    for d, t in docs:
        w = words(t)
        hit, owners = set(), set()
        for i, p in phrases:
            for s in range(len(w) - len(p) + 1):
                if tuple(w[s : s + len(p)]) == p:
                    hit |= set(range(s, s + len(p)))
                    owners.add("" if i is None else str(i))
        near = sum(any(set(r) <= set(w[s : s + near_width]) for s in range(len(w))) for r in rarest.values())
        out.append((d, len(w), len(hit), sorted(owners), len(owners), near, bool(hit)))
    return sorted(out, key=str)


def invented(seed, n, letters="abcd"):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, 3))) for _ in range(n))


def found(spark, docs, items, **more):
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS term", "2 AS pos", "3 AS item")
    i = spark.createDataFrame(items, ITEMS).selectExpr("*", "1 AS doc_id", "2 AS phrase")
    return sorted((tuple(r) for r in L.contamination(d, i, **more).collect()), key=str)


def test_phrases_as_by_hand(spark):
    items = [(i, invented(i, 25)) for i in range(6)] + [(6, "One two"), (7, ""), (8, None), (None, invented(90, 12)), (1, invented(91, 14))]
    docs = [(100 + i, invented(i + 40, 60)) for i in range(10)]
    docs += [(i, invented(i + 60, 20) + " | " + (t or "").upper() + ", " + invented(i + 80, 9)) for i, (_, t) in enumerate(items)]
    docs += [(50, " ".join(words(items[0][1])[3:14]) * 2), (51, "ONE-two one two"), (51, "ONE-two one two"), (None, "one, Two"), (None, None)]
    docs += [(60 + i, t) for i, t in enumerate(ODD)]
    assert found(spark, docs, items) == plain(docs, items)


def test_short_phrases_and_narrow_neighbourhoods(spark):
    items = [(i, invented(i, 7, "ab")) for i in range(5)] + [(9, "a"), (10, "a b"), (11, "É é É"), (12, "ab" * 4000)]
    docs = [(i, invented(i + 40, 300, "ab")) for i in range(6)] + [(7, "É é é É É é É"), (8, "x " + "ab" * 4000)]
    assert found(spark, docs, items, window=3, near_words=2, near_width=4) == plain(docs, items, 3, 2, 4)


def test_empty_tables(spark):
    docs, items = [(1, "a b"), (2, None)], [(1, "a b")]
    assert found(spark, docs, []) == [(1, 2, 0, [], 0, 0, False), (2, 0, 0, [], 0, 0, False)]
    assert found(spark, [], items) == []


def test_many_copies(spark):
    docs = [(1, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11")] * 300 + [(i, "w2 w1 w3 w5 w4") for i in range(300)]
    items = [(1, docs[0][1]), (2, docs[0][1])]
    assert found(spark, docs, items) == plain(docs, items)


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    plan = L.contamination(docs, spark.createDataFrame([(1, "a")], ITEMS))._jdf.queryExecution().toString()
    assert not [w for w in ("Python", "Pandas", "InArrow", "MapPartitions") if w in plan.replace("ArrowEvalPython", "Python")]


@pytest.mark.parametrize("text", ["", "Ab-C2 é_x", "\x7f{a}~[b]", "日本 語。x"])
def test_words(spark, text):
    assert spark.createDataFrame([(text,)], "t string").select(L.words(L.F.col("t")).alias("w")).first().w == words(text)
