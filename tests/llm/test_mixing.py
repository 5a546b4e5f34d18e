"""Mixing against the same rules in plain Python."""

import random
import re
from collections import defaultdict

import pytest

from wakeline.llm import mixing

from .cases import ODD, words


def plain_targets(sizes):
    """Targets by capping and resharing, source by source."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    total, held = sum(sizes.values()), {}
    while True:
        left = total - sum(held.values())
        open_ = [s for s in order if s not in held]
        all_ = sum(weight[s] for s in open_)
        target = {s: left * weight[s] / all_ for s in open_}
        over = [s for s in open_ if target[s] > 3 * sizes[s]]
        if not over:
            return {**held, **target}
        held.update({s: float(3 * sizes[s]) for s in over})


def rows_of(sizes, seed=0):
    rng, rows = random.Random(seed), []
    for source, (n, most) in sizes.items():
        rows += [(len(rows) + i, words(rng.randint(1, most), rng.random()), "en", source) for i in range(n)]
    return rows


@pytest.mark.parametrize("sizes", [
    {"a": (40, 60), "b": (40, 60), "c": (40, 60)},
    {"a": (300, 40), "b": (3, 10), "c": (2, 20), None: (5, 30), "Z": (1, 1)},
    {"a": (1, 5)},
    {"a": (2, 3000), "b": (200, 5), "é": (1, 2), "\U0001F600": (30, 9)},
])
def test_targets_are_shared_and_met(documents, sizes):
    rows = rows_of(sizes)
    got = mixing.mix(documents(rows)).collect()
    assert len(got) == len(rows)
    size, taken = defaultdict(int), defaultdict(int)
    for r in got:
        text = rows[r.doc_id][1]
        assert r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", text))
        assert 0 <= r.taken <= 3 * r["size"]
        size[r.source] += r["size"]
        taken[r.source] += r.taken
    expected = plain_targets(dict(size))
    assert sum(taken.values()) == sum(size.values())
    for r in got:
        assert r.source_size == size[r.source]
        assert r.target == pytest.approx(expected[r.source])
    for s in size:
        assert abs(taken[s] - expected[s]) <= mixing.PACKET * (len(size) + 1)


def test_chunks_and_ranges_do_not_change_the_mix(documents, monkeypatch):
    df = documents(rows_of({"a": (200, 50), "b": (20, 50), None: (9, 90)}, 3))
    whole = sorted(mixing.mix(df).collect(), key=str)
    assert sorted(mixing.mix(df).collect(), key=str) == whole
    monkeypatch.setattr(mixing, "CHUNK", 3)
    assert sorted(mixing.mix(df).collect(), key=str) == whole


def test_odd_texts_and_empty_table(documents):
    rows = [(i, t, None, "s") for i, t in enumerate(ODD)] + [(None, "a b", None, None)] * 3
    got = mixing.mix(documents(rows, more="size taken rank target")).collect()
    assert len(got) == len(rows)
    assert all(r.taken == 0 for r in got if r["size"] == 0)
    assert mixing.mix(documents([])).collect() == []
    assert [r.taken for r in mixing.mix(documents([(1, None), (2, "  ")])).collect()] == [0, 0]
    assert mixing.mixed_documents(documents([])).collect() == []


def test_mixed_documents_hold_what_is_taken(documents):
    df = documents(rows_of({"a": (30, 80), "b": (3, 40), "c": (2, 400)}, 5), more="i rank")
    taken = {r.doc_id: r for r in mixing.mix(df).collect()}
    mixed = mixing.mixed_documents(df)
    assert mixed.columns == df.columns
    words_of, text_of = defaultdict(int), {r.doc_id: r.text for r in df.collect()}
    for r in mixed.collect():
        words_of[r.doc_id] += len(r.text.split())
        assert text_of[r.doc_id].startswith(r.text)
    assert dict(words_of) == {k: r.taken for k, r in taken.items() if r.taken}
