"""Near-duplicate join against all pairs in plain Python."""

import random
from collections import Counter

import numpy as np
import pytest

from wakeline.llm import nearjoin

from .cases import ODD, words


def plain_sets(texts):
    out = []
    for t in texts:
        w = (t or "").lower().split()
        out.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    return out


def plain(rows):
    """(class, links, copy) by position, all pairs compared."""
    sets = plain_sets([r[1] for r in rows])
    links, root = Counter(), list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and both / len(sets[i] | sets[j]) >= 0.8:
                links[i] += 1
                links[j] += 1
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    least = {}
    for i, r in enumerate(rows):
        least.setdefault(find(i), []).append(r[0])
    return [(min(k for k in least[find(i)]), links[i]) for i in range(len(rows))]


def variants(base, seed, n, edits):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        w = base.split()
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(len(w))] = f"q{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


@pytest.fixture(scope="module")
def corpus():
    texts = []
    for s in range(6):
        texts += variants(words(120, s), s, 8, 3)
    texts += [texts[0].upper(), "  ".join(texts[1].split()), texts[2], texts[2]]
    texts += [words(80, 100 + s) for s in range(20)]
    shared = words(60, 55)
    texts += [shared + " " + words(90, 200 + s) for s in range(10)]
    texts += ["one two three", "One two  three", "one two", "a b c d e", "a b c d e f"]
    return [(i * 7 + 3, t) for i, t in enumerate(texts)]


def test_links_and_classes_as_in_all_pairs(documents, corpus):
    got = {r.doc_id: r for r in nearjoin.near_duplicates(documents(corpus)).collect()}
    for (key, _), (least, links) in zip(corpus, plain(corpus)):
        assert (got[key].class_id, got[key].n_links) == (least, links), key


def test_groups_over_a_block_are_cut_without_loss(documents, corpus, monkeypatch):
    whole = sorted(nearjoin.near_duplicates(documents(corpus)).collect())
    monkeypatch.setattr(nearjoin, "BLOCK", 3)
    assert sorted(nearjoin.near_duplicates(documents(corpus)).collect()) == whole


def test_odd_texts_repeated_rows_null_keys(documents):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(100, "a b c d e f g"), (100, "a b c d e f g"), (None, "a b c d e f g"), (None, None)]
    got = nearjoin.near_duplicates(documents(rows, more="root lo hi side key node")).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id == 100 or (r.doc_id is None and r.n_links):
            assert (r.class_id, r.n_links) == (100, 2)
    assert {r.doc_id: r.n_links for r in got}[0] == 0
    kept = nearjoin.keep_one(documents(rows, more="__times key"))
    assert kept.columns[-2:] == ["__times", "key"]
    ids = sorted((r.doc_id is None, r.doc_id or 0, r.text is None) for r in kept.collect())
    assert ids.count((False, 100, False)) == 1
    assert (True, 0, False) not in ids and (True, 0, True) in ids


def test_empty_table(documents):
    assert nearjoin.near_duplicates(documents([])).collect() == []
    assert nearjoin.keep_one(documents([])).collect() == []


def test_prefix_is_shortened_until_the_recall_is_reached():
    assert nearjoin.depth(recall=0.5) == 4
    assert nearjoin.depth(recall=0.999) == 3
    assert nearjoin.depth() == 2
    assert 1 - (1 - 0.8 ** nearjoin.depth()) ** nearjoin.TREES >= nearjoin.RECALL


def test_shared_counts_are_exact():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 60, rng.integers(0, 50)).astype(np.uint64)) for _ in range(30)]
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    rows, cols = np.arange(0, 12), np.arange(8, 30)
    got = nearjoin.shared_counts(np.concatenate(sets), starts, rows, cols)
    assert got.tolist() == [[len(np.intersect1d(sets[i], sets[j])) for j in cols] for i in rows]


def test_one_of_each_class_stays_without_keys_and_with_repeated_keys(documents):
    near, same, other = (variants(words(120, s), s, 3, 2) for s in (1, 2, 3))
    alone = [(None, words(90, 70)), (5, words(90, 71)), (5, words(90, 72)), (None, "")]
    rows = [(None, t) for t in near] + [(5, t) for t in same] + [(9, other[0]), (None, other[1]), (5, other[2]), (5, other[2])] + alone
    kept = [(r.doc_id, r.text) for r in nearjoin.keep_one(documents(rows)).collect()]
    for group, key in ((near, None), (same, 5), (other, 5)):
        assert [k for k, t in kept if t in group] == [key]
    assert all(kept.count(r) == 1 for r in alone) and len(kept) == 3 + len(alone)


def test_texts_of_a_hot_key_are_fetched_once_a_class(documents, monkeypatch):
    """A key with many classes gives one text a class, not rows x classes."""
    rows = [(key, t) for key in (1, None) for s in range(12) for t in variants(words(60, s + 100 * (key is None)), s, 3, 1) * 2]
    fetched, verified = [], nearjoin.verified
    monkeypatch.setattr(nearjoin, "verified", lambda members, *a: fetched.extend(r.id for r in members.collect()) or verified(members, *a))
    got = nearjoin.near_duplicates(documents(rows)).collect()
    assert fetched and len(fetched) == len(set(fetched)) <= len({" ".join(t.split()) for _, t in rows})
    assert sorted(r.n_links for r in got) == sorted(n for _, n in plain(rows_with_numbers(rows)))


def rows_with_numbers(rows):
    return [(i, t) for i, (_, t) in enumerate(rows)]


@pytest.mark.parametrize("seed", range(12))
@pytest.mark.parametrize("leaders", [2, 64])
def test_shortened_prefixes_connect_what_all_pairs_do(monkeypatch, seed, leaders):
    """Within every subtrie the same rows are connected as by comparing all its pairs, whatever their labels."""
    monkeypatch.setattr(nearjoin, "LEADERS", leaders)
    rng = np.random.default_rng(seed)
    sizes = rng.integers(1, 40, 6)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    shifts = nearjoin.levels(2)
    rest = np.concatenate([np.sort(rng.integers(0, 3, s) << 31 | rng.integers(0, 3, s)) for s in sizes])
    base = rng.integers(0, 256, (8, 48)).astype(np.uint8)
    sig = base[rng.integers(0, 8, len(rest))].copy()
    flips = rng.random(sig.shape) < 0.3
    sig[flips] = rng.integers(0, 256, int(flips.sum()))
    side = np.concatenate([rng.integers(0, 2, s) if k % 2 else np.full(s, -1) for k, s in enumerate(sizes)])
    a, b = np.triu_indices(len(rest), 1)
    subtrie = np.repeat(np.arange(len(sizes)), sizes)
    use = (subtrie[a] == subtrie[b]) & ((side[a] < 0) | (side[a] != side[b]))
    use &= (sig[a] == sig[b]).sum(1) >= int(np.ceil(nearjoin.ESTIMATE * 48))
    want = nearjoin.union_find(len(rest), a[use], b[use])
    got = nearjoin.connected(starts, rest, sig, side, shifts)
    top = nearjoin.union_find(len(rest), np.arange(len(rest)), got)
    assert top.tolist() == want.tolist()
