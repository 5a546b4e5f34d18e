"""Byte-level BPE against the tokenizer library, and round trips."""

import hashlib
import random
import struct
import unicodedata

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st

from wakeline.llm import bpe

from .cases import ODD

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
LINES = open(PATH, "rb").read()
ENCODING = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(LINES), special_tokens={})


def agree(texts):
    for t, ids in zip(texts, bpe.encode_texts(texts, LINES)):
        assert list(ids) == ENCODING.encode_ordinary(t), t[:80]


def test_corners():
    agree([t or "" for t in ODD])
    agree(["it's 'tis we'll  've\n's \n's  's!'s", "''s 'S 'll're'x'", "a  b\t\tc \n\n d  ", "é'sä 12½³ ٣ 中文字　a\xa0b c\x85d\x1cx", "!'" * 500, " " * 99 + "a", "' s", "a're"])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab'stmdrevl  \n\t1½!é中 　"), max_size=40), max_size=8))
def test_any_text_of_few_characters(texts):
    agree(texts) if texts else None


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    agree([text])


def test_scan_of_functions_equals_steps():
    step, starts = bpe.automaton()
    rng = np.random.default_rng(2)
    for n in (1, 31, 32, 33, 1024, 5000):
        symbol = rng.integers(0, 9, n).astype(np.uint8)
        state, out = bpe.FRESH, []
        for i, s in enumerate(symbol):
            if starts[s * bpe.STATES + state]:
                out.append(i)
            state = step[s * bpe.STATES + state]
        assert bpe.boundaries(symbol).tolist() == out


def test_long_slices_merge_like_short_ones():
    ranks = bpe.read_ranks(LINES)
    rng = random.Random(4)
    for _ in range(200):
        piece = "".join(rng.choice("theandingor") for _ in range(rng.randint(2, 47))).encode()
        if piece not in ranks:
            assert bpe.merge_long(piece, ranks) == bpe.merge(piece, ranks)


def test_classes_follow_the_general_categories():
    for c in "aÉ中1½٣ !_​":
        want = {"L": bpe.LETTER, "N": bpe.NUMBER}.get(unicodedata.category(c)[0], bpe.SPACE_IN_RUN if c == " " else bpe.OTHER)
        assert bpe.classes()[ord(c)] == want


def test_round_trip_with_offsets(documents):
    df = documents([(i, t) for i, t in enumerate(ODD)], more="ids_ more")
    coded = bpe.encode(df, PATH)
    assert coded.columns == ["doc_id", "lang", "source", "n_chars", "ids_", "more", "n_tokens", "ids", "ends"]
    both = bpe.encode(df, PATH, ends=None, decoded="back").select("doc_id", "back").orderBy("doc_id").collect()
    for r, d, b in zip(coded.orderBy("doc_id").collect(), bpe.decode(coded, PATH).orderBy("doc_id").collect(), both):
        assert b.back == d.decoded
        raw = (ODD[r.doc_id] or "").encode()
        ids, ends = (struct.unpack(f"<{r.n_tokens}I", x) for x in (r.ids, r.ends))
        assert bytes(d.decoded) == raw
        assert list(ids) == ENCODING.encode_ordinary(raw.decode())
        assert [raw[a:b] for a, b in zip((0, *ends), ends)] == [ENCODING.decode_single_token_bytes(i) for i in ids]


def test_results_named_like_columns_and_empty_table(documents):
    df = documents([(1, "a b"), (1, "a b")], more="ids n_tokens decoded")
    coded = bpe.decode(bpe.encode(df, PATH, ends=None), PATH)
    assert coded.columns.count("decoded") == 1 and coded.count() == 2
    assert bpe.encode(documents([]), PATH).collect() == []


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001"])
def test_query_against_the_library(spark, sf):
    from wakeline.llm.queries import QUERIES

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op9_byte_bpe"](spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = ENCODING.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
