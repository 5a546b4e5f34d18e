"""The pipeline: stage by stage against plain Python, and end to end."""

import re
import struct

import pytest

import corpus_pipeline as C
from wakeline.llm import bpe, mixing, secrets
from wakeline.llm.common import stored

from .cases import ODD, prose, words
from .test_nearjoin import plain

NAMES = ["quality", "near_duplicates", "secrets", "mixing", "tokens"]
SECRET = "password = 0123456789abcdef0123456789abcdef"


@pytest.fixture(scope="module")
def raw(documents, spark, tmp_path_factory):
    """Prose with copies, near copies, junk and secrets from three sources, one of them hot."""
    rows = [(i, prose(60 + i % 90, i), "en", "hot" if i % 3 else f"s{i % 5}") for i in range(240)]
    rows += [(1000 + i, rows[i][1], "en", "copy") for i in range(20)]
    rows += [(2000 + i, rows[i][1] + " tail", "en", None) for i in range(20, 30)]
    rows += [(3000 + i, " ".join(w + "###" for w in prose(80, 500 + i).split()), "en", "hot") for i in range(30)]
    rows += [(4000 + i, f"{prose(50, 900 + i)} {SECRET} {prose(30, 950 + i)}", "en", "s1") for i in range(8)]
    rows += [(5000 + i, t, None, "odd") for i, t in enumerate(ODD)]
    path = str(tmp_path_factory.mktemp("corpus"))
    documents(rows).write.parquet(f"{path}/documents.parquet")
    return rows, path


@pytest.fixture(scope="module")
def outputs(spark, raw):
    docs, out = spark.read.parquet(f"{raw[1]}/documents.parquet"), {}
    for name, stage in C.STAGES:
        docs = out[name] = stored(stage(spark, docs, raw[1]), name)
    return out


def test_stages_are_those_asked_for():
    assert [name for name, _ in C.STAGES] == NAMES and C.ORACLE_SQL is None


def test_junk_goes(raw, outputs):
    kept = {r.doc_id for r in outputs["quality"].collect()}
    assert not any(3000 <= i < 4000 for i in kept)
    assert sum(i < 3000 for i in kept) >= 0.98 * 270 and sum(4000 <= i < 5000 for i in kept) == 8
    assert outputs["quality"].columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_one_of_each_group_stays(outputs):
    before = sorted((r.doc_id, r.text) for r in outputs["quality"].collect())
    want = sorted(key for (key, text), (least, _) in zip(before, plain(before)) if key == least)
    assert sorted(r.doc_id for r in outputs["near_duplicates"].collect()) == want
    assert outputs["near_duplicates"].columns == outputs["quality"].columns
    assert not any(1000 <= i < 3000 for i in want)


def test_secrets_are_replaced_and_nothing_else(outputs):
    before = {r.doc_id: r.text for r in outputs["near_duplicates"].collect()}
    after = {r.doc_id: r for r in outputs["secrets"].collect()}
    assert before.keys() == after.keys()
    for i, text in before.items():
        if SECRET in text:
            assert after[i].text == text.replace(SECRET, "[secret]") and after[i].n_chars == len(after[i].text)
        elif not secrets.find_secrets(text):
            assert after[i].text == text


def test_mix_takes_the_budget(outputs):
    before = {r.doc_id: r for r in outputs["secrets"].collect()}
    after = outputs["mixing"].collect()
    size = lambda text: len(re.findall(mixing.WORD, text or ""))
    assert sum(size(r.text) for r in after) == sum(size(r.text) for r in before.values())
    for r in after:
        assert before[r.doc_id].text.startswith(r.text) and before[r.doc_id].source == r.source
    taken = {r.doc_id: r.taken for r in mixing.mix(outputs["secrets"]).collect()}
    for i in taken:
        assert sum(size(r.text) for r in after if r.doc_id == i) == taken[i]


def test_tokens_are_those_of_the_texts(outputs):
    with open(C.RANKS, "rb") as f:
        lines = f.read()
    texts = sorted((r.doc_id, r.text) for r in outputs["mixing"].collect())
    coded = sorted((r.doc_id, bytes(r.ids), bytes(r.ends), r.n_tokens) for r in outputs["tokens"].collect())
    want = sorted((i, ids.tobytes(), len(ids), len(t.encode())) for (i, t), ids in zip(texts, bpe.encode_texts([t for _, t in texts], lines)))
    assert [(i, ids, n) for i, ids, _, n in coded] == [(i, ids, n) for i, ids, n, _ in want]
    assert all(struct.unpack(f"<{n}I", ends)[-1] == size for (_, _, ends, n), (_, _, _, size) in zip(coded, want) if n)


def test_run_is_the_stages_in_turn(spark, raw, outputs):
    got = C.run(spark, raw[1])
    assert sorted((r.doc_id, bytes(r.ids)) for r in got.collect()) == sorted((r.doc_id, bytes(r.ids)) for r in outputs["tokens"].collect())


def test_empty_table_and_more_columns(spark, documents, tmp_path):
    documents([]).write.parquet(str(tmp_path / "empty" / "documents.parquet"))
    assert C.run(spark, str(tmp_path / "empty")).collect() == []
    extra = "rank size taken i hash key id root __times t1"
    rows = [(i, prose(60 + i, i), "en", "s") for i in range(12)] + [(3, prose(63, 3), "en", "s"), (None, prose(80, 99), None, None), (None, None)]
    df = documents(rows, more=extra)
    docs = df
    for name, stage in C.STAGES[:-1]:
        docs = stored(stage(spark, docs, ""), name)
        assert docs.columns == df.columns, name
    assert C.STAGES[-1][1](spark, docs, "").count() == docs.count()
