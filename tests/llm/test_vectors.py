"""Near duplicates among vectors against all pairs."""

import math

import numpy as np
import pytest

from wakeline.llm import vectors


def plain(rows):
    """(n_links, component) by position, all pairs compared."""
    ok = [r[2] is not None and r[1] is not None and len(r[1]) and all(x is not None and math.isfinite(x) for x in r[1]) and any(r[1]) for r in rows]
    links, label = [0] * len(rows), list(range(len(rows)))
    edges = []
    for i in range(len(rows)):
        for j in range(i):
            if ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]):
                a, b = (np.array(rows[k][1], np.float64) for k in (i, j))
                if a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= 0.98:
                    links[i] += 1
                    links[j] += 1
                    edges.append((i, j))
    moved = True
    while moved:
        moved = False
        for i, j in edges:
            if label[i] != label[j]:
                label[i] = label[j] = min(label[i], label[j])
                moved = True
    least = {}
    for i, r in enumerate(rows):
        least.setdefault(label[i], []).append(r[0])
    return [(links[i], min(least[label[i]])) for i in range(len(rows))]


def made(n, seed, dims=16, labels=3):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, dims))
    for i in range(0, n, 3):
        base[i] = base[i // 4] * rng.uniform(0.5, 2) + rng.normal(size=dims) * rng.choice([0.02, 0.1, 0.25, 0.4])
    return [(int(i * 5 + 2), [float(np.float32(x)) for x in v], int(rng.integers(labels))) for i, v in enumerate(base)]


def run(spark, rows, kind="float", label="int"):
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label {label}").selectExpr("*", "1 AS id", "2 AS root", "3 AS pivot")
    return {r.vec_id: r for r in vectors.near_vectors(df).collect()}


@pytest.mark.parametrize("kind", ["float", "double"])
def test_recall_and_no_link_below_the_bound(spark, kind):
    rows = made(240, 1) + [(9000 + i, made(240, 1)[3][1], made(240, 1)[3][2]) for i in range(6)]
    got, want = run(spark, rows, kind), plain(rows)
    found, real = 0, 0
    for r, (links, _) in zip(rows, want):
        assert got[r[0]].n_links <= links
        found, real = found + got[r[0]].n_links, real + links
    assert real > 100 and found >= 0.97 * real
    if found == real:
        for r, (_, least) in zip(rows, want):
            assert got[r[0]].component_id == least and got[r[0]].kept == (least == r[0])


def test_hot_list_is_cut_without_loss(spark, monkeypatch):
    rng = np.random.default_rng(3)
    centre = rng.normal(size=16)
    rows = [(i, [float(x) for x in centre + rng.normal(size=16) * 0.03], 1) for i in range(60)]
    whole = run(spark, rows)
    monkeypatch.setattr(vectors, "BLOCK", 7)
    assert run(spark, rows) == whole
    assert {r.n_links for r in whole.values()} == {links for links, _ in plain(rows)}
    assert {r.component_id for r in whole.values()} == {0}


def test_odd_vectors(spark):
    v = [1.0, 2.0, 3.0]
    rows = [
        (1, v, 1), (2, v, 1), (3, v, 2), (4, v, None), (5, None, 1), (6, [0.0, 0.0, 0.0], 1), (7, [0.0] * 3, 1), (8, [float("nan"), 1.0, 1.0], 1),
        (9, [float("inf"), 1.0, 1.0], 1), (10, [None, 1.0, 1.0], 1), (11, [], 1), (12, [2.0, 4.0, 6.0], 1), (13, [1.0, 2.0], 1), (14, [1e-30, 2e-30, 3e-30], 1),
        (15, [3e30, 6e30, 9e30], 1), (2, v, 1), (16, [-1.0, -2.0, -3.0], 1), (17, [1.0, 2.0], 1),
    ]
    got = vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()
    assert len(got) == len(rows)
    by = {r.vec_id: r for r in got}
    for key in (1, 2, 12, 14, 15):
        assert (by[key].n_links, by[key].component_id) == (5, 1)
    assert (by[13].n_links, by[17].component_id) == (1, 13)
    for key in (3, 4, 5, 6, 7, 8, 9, 10, 11, 16):
        assert (by[key].n_links, by[key].component_id, by[key].kept) == (0, key, True)


def test_empty_table_and_null_keys(spark):
    assert run(spark, []) == {}
    df = spark.createDataFrame([(None, [1.0, 0.0], 1), (4, [1.0, 0.0], 1), (None, None, None)], "vec_id long, embedding array<float>, label int")
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in vectors.near_vectors(df).collect()), key=str)
    assert got == [(4, 1, 4, True), (None, 0, None, True), (None, 1, 4, False)]
