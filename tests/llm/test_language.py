"""Language identification: held-out accuracy, what it learns from, and odd texts."""

import zlib

import numpy as np
import pytest

from wakeline.llm import language

from .cases import ODD, prose

TONGUES = {
    "en": ["the", "of", "and", "with", "that", "this", "which"],
    "de": ["der", "die", "und", "nicht", "über", "mit", "für"],
    "fr": ["le", "les", "été", "que", "où", "dans", "très"],
}


@pytest.fixture(scope="module")
def taught(documents):
    rows = [(i, prose(30 + i % 90, i, list(TONGUES.values())[i % 3]), list(TONGUES)[i % 3]) for i in range(420)]
    df = documents(rows)
    return rows, language.fit(df)


def test_held_out_rows_are_told_apart(documents, taught):
    rows, model = taught
    got = {r.doc_id: r for r in language.identify(documents([(i, t) for i, t, _ in rows]), model).collect()}
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 == 2]
    assert len(held) > 60
    assert np.mean([got[i].lang_pred == lang for i, _, lang in held]) >= 0.97
    assert all(0 < r.score <= 1 for r in got.values())


def test_held_out_rows_and_null_languages_teach_nothing(documents, taught):
    rows, model = taught
    wrong = [(i, t, "zz" if zlib.crc32(str(i).encode()) % 4 == 2 else lang) for i, t, lang in rows] + [(10_000 + i, "qqq", None) for i in range(4)]
    assert language.Network.load(language.fit(documents(wrong))).langs == sorted(TONGUES)
    got = language.fit(documents(wrong))
    assert got == model


def test_sample_is_bounded_whatever_the_keys(documents, monkeypatch):
    """Null keys, one key for all and equal rows: at most SAMPLE_DOCS documents a language teach."""
    monkeypatch.setattr(language, "SAMPLE_DOCS", 5)
    seen = []
    monkeypatch.setattr(language.Network, "train", lambda net, x, y: seen.append(np.bincount(y).tolist()))
    texts = [(prose(12, i, TONGUES[("en", "de")[i % 2]]), ("en", "de")[i % 2]) for i in range(10_000)]
    short = [(t[:100], lang) for t, lang in texts]  # one window each
    for rows in ([(None, *r) for r in short], [(1, *r) for r in short], [(i, *short[i % 2]) for i in range(4000)]):
        language.fit(documents(rows))
    assert seen == [[5, 5], [5, 5], [5, 5]]


def test_crc_is_that_of_the_id_as_text(documents):
    from pyspark.sql import functions as F

    got = documents([(i, "a") for i in range(200)]).select("doc_id", language.held_out(F.col("doc_id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)


def test_whole_text_counts(documents, taught):
    """Ten parts German behind one part English are German, wherever the German begins."""
    _, model = taught
    text = prose(40, 1, TONGUES["en"]) + " " + prose(400, 2, TONGUES["de"])
    assert language.identify(documents([(1, text)]), model).first().lang_pred == "de"


def test_odd_texts_and_nothing_taught(documents, taught):
    _, model = taught
    rows = [(i, t) for i, t in enumerate([*ODD, "12 34", "?!", "中"])]
    got = {r.doc_id: r for r in language.identify(documents(rows, more="text_ lang_pred score"), model).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        assert (got[i].lang_pred == "und") == (not any(c.isalpha() for c in t or "")), t
    assert language.identify(documents([]), model).collect() == []
    nothing = language.fit(documents([(1, "abc"), (2, None, "en")]))
    assert [r.lang_pred for r in language.identify(documents([(1, "abc def")]), nothing).collect()] == ["und"]


def test_gradients_are_those_of_the_loss():
    net = language.Network(["a", "b"], seed=1)
    rng = np.random.default_rng(0)
    x, y = rng.integers(97, 110, (5, language.WINDOW)).astype(np.uint8), rng.integers(0, 2, 5)

    def loss():
        p = net.predict(x, net.tables())
        return -np.log(p[np.arange(5), y].astype(np.float64)).mean()

    grads = net.gradients(x, y)
    for name, at in (("conv3", (5, 2)), ("embed", (100, 1)), ("out", (3, 1)), ("shift", (4,)), ("bias", (0,))):
        held = net.parts[name][at]
        net.parts[name][at] = held + 1e-2
        up = loss()
        net.parts[name][at] = held - 1e-2
        down = loss()
        net.parts[name][at] = held
        assert (up - down) / 2e-2 == pytest.approx(float(grads[name][at]), abs=3e-3)
