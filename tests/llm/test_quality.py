"""Quality classifier: held against known junk, and the estimates it stands on."""

import json
import random

import numpy as np
import pytest

from wakeline.llm import quality

from .cases import ODD, prose

JUNK = (
    lambda i: " ".join(w + random.Random(f"{i}{k}").choice(["###", "$$$", "%%%", "&&&"]) for k, w in enumerate(prose(60, i).split())),
    lambda i: "!! ".join(prose(60, i).upper().split()) + "!!",
    lambda i: " ".join(prose(4, i).split()[:1] * 90),
    lambda i: " | ".join(prose(50, i).split()),
    lambda i: " ".join(prose(6, i).split() * 14),
)


@pytest.fixture(scope="module")
def rows():
    return [(i, JUNK[i % 5](i) if i % 7 == 0 else prose(20 + i % 150, i)) for i in range(700)]


def test_junk_goes_and_prose_stays(documents, rows):
    df = documents(rows)
    got = {r.doc_id: r for r in quality.classify(df, quality.fit(df)).collect()}
    right = [got[i].accepted == (i % 7 != 0) for i, _ in rows]
    assert np.mean(right) >= 0.98
    assert np.mean([got[i].accepted for i, _ in rows if i % 7]) >= 0.99
    kept = quality.accept(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, r in got.items() if r.accepted)


def test_accuracies_are_found_from_votes_alone():
    rng = np.random.default_rng(0)
    junk = rng.random(20_000) < 0.15
    hit = np.array([0.9, 0.6, 0.8, 0.5, 0.7])
    false = np.array([0.02, 0.01, 0.05, 0.03, 0.02])
    votes = np.where(rng.random((20_000, 5)) < np.where(junk[:, None], hit, false), 1, 2)
    votes[rng.random(votes.shape) < 0.2] = 0
    pattern, at, count = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    posterior, share = quality.accuracies(pattern, count.astype(float))
    assert share == pytest.approx(0.15, abs=0.02)
    assert np.mean((posterior[at.ravel()] > 0.5) == junk) > 0.95


def test_statistics_as_counted_one_by_one():
    texts = ["The cat and the cat and the cat.", "A | b | c ### !!", "WORD WORD word", "x", "", " ", "one two three four five. six? seven!"]
    data, starts = quality.byte_table(texts)
    got = quality.statistics(data, starts)
    for i, t in enumerate(texts):
        w = t.split()
        assert got["words"][i] == len(w)
        low = [x.lower() for x in w]
        triples = list(zip(low, low[1:], low[2:]))
        if triples:
            assert got["fresh_triples"][i] == pytest.approx(len(set(triples)) / len(triples))
        if w:
            assert got["variety"][i] == pytest.approx(len(set(low)) / len(w) ** 0.5)
            assert got["same_again"][i] == pytest.approx(sum(a == b for a, b in zip(low, low[1:])) / len(w))
            assert got["bare_words"][i] == pytest.approx(sum(not any(c.isalnum() for c in x) for x in w) / len(w))
            assert got["function_words"][i] == pytest.approx(sum(x in quality.FUNCTION_WORDS for x in low) / len(w))


def test_scores_do_not_depend_on_the_batch(rows):
    texts = [t for _, t in rows[:50]]
    weights = np.random.default_rng(1).normal(size=quality.DIMS + 1)
    whole = quality.scores(texts, weights)[0]
    assert np.allclose(whole, [quality.scores([t], weights)[0][0] for t in texts])
    x = quality.features(texts)[1]
    assert np.allclose(whole, 1 / (1 + np.exp(-(x @ weights[:-1] + weights[-1]))), atol=1e-4)


def test_odd_texts_and_empty_table(documents, rows):
    model = quality.fit(documents(rows))
    odd = [(i, t) for i, t in enumerate(ODD)] + [(0, None)]
    df = documents(odd, more="score accepted hash x")
    got = quality.classify(df, model).collect()
    assert len(got) == len(odd)
    assert all(r.score == 0 and not r.accepted for r in got if not (ODD[r.doc_id] or "").strip(" \n\t"))
    assert quality.classify(documents([]), model).collect() == []
    assert json.loads(quality.fit(documents([])))["posterior"] == {}
    assert quality.accept(documents([])).collect() == []
    assert quality.accept(df).columns == df.columns
