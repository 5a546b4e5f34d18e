"""Order MinHash against the same sketch in plain Python, and what it must tell apart."""

import hashlib
import random
import re
import struct
from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from wakeline.llm import fingerprints

from .cases import ODD, words


def edits(rows):
    """Edited text of each position, by the stated rule."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, -(rows[i][0] or 0)))
    out = {}
    for k, i in enumerate(order):
        t, n = rows[i][1] or "", rows[order[(k + 1) % len(order)]][1] or ""
        half = len(t) // 2
        out[i] = t[: len(t) - half] + n[:half]
    return out


def _hash(values, seed=42):
    """xxhash64 of longs one after the other, as the engine chains them."""
    for v in values:
        seed = xxhash.xxh64_intdigest(struct.pack("<q", v), seed)
        seed = seed - 2**64 if seed >= 2**63 else seed
    return seed


def sketch(text):
    """The signature in plain Python: units, numbered k-mers, the two least of each bin in text order."""
    words = re.split(r"[ \t\n\x0b\f\r]+", text or "")
    words = [w for w in words if w]
    if not words:
        return []

    def pieces(t):
        return [t[i : i + fingerprints.PIECE] for i in range(max(len(t) - fingerprints.PIECE, 0) + 1)]

    def chars(t):  # as the hash of single characters chained
        seed = 42
        for c in t:
            seed = xxhash.xxh64_intdigest(c.encode(), seed)
        return seed - 2**64 if seed >= 2**63 else seed

    one = lambda w: chars([w])
    units = [h for w in words for h in ([chars(p) for p in pieces(w)] if len(w) > fingerprints.LONG else [one(w)])]
    k = fingerprints.KMER
    grams = [(_hash(units[i : i + k]), i) for i in range(max(len(units) - k, 0) + 1)]
    if len(units) < fingerprints.FEW:
        grams += [(chars(p), i + fingerprints.FEW) for i, p in enumerate(pieces(text.strip(" ")))]
    grams = sorted((h >> fingerprints.PLACE, place) for h, place in grams)
    seen, numbered = Counter(), []
    for h, place in grams:
        numbered.append((_hash([h, seen[h]]) >> fingerprints.PLACE, place))
        seen[h] += 1
    bins = defaultdict(list)
    for h, place in sorted(numbered):
        bins[h >> (64 - fingerprints.BITS - fingerprints.PLACE)].append((place, h))
    out = []
    for b in sorted(bins):
        least = [h for _, h in sorted(bins[b][:2])]
        out.append(((b + (1 << (fingerprints.BITS - 1))) << fingerprints.TUPLE) | (_hash(least) & ((1 << fingerprints.TUPLE) - 1)))
    return out


def test_signature_is_that_of_plain_python(documents):
    texts = [*ODD, *[words(n, n) for n in (1, 3, 4, 31, 32, 33, 200)], "a b c " * 40, "é" * 300, "日本語" * 30 + " x " + words(20, 1), "a b " + "z" * 17]
    got = fingerprints.fingerprints(documents(list(enumerate(texts)))).collect()
    assert {r.doc_id: r.signature for r in got} == {i: sketch(t) for i, t in enumerate(texts)}


def test_half_of_a_text_without_spaces_and_of_a_short_one(documents):
    rng = random.Random(2)
    solid = lambda n: "".join(chr(rng.randint(0x4E00, 0x5E00)) for _ in range(n))
    for n in (301, 600, 5000):
        got = fingerprints.edited_fingerprints(documents([(2, solid(n)), (1, solid(n))])).collect()
        assert all(r.near_edited > 0.2 > 0.1 > r.near_next for r in got), n
    short = fingerprints.edited_fingerprints(documents([(2, "abcd efgh ijkl mno"), (1, "qrst uvwx yzab cd?")])).collect()
    assert all(r.near_edited > 0.2 for r in short)


def test_null_and_repeated_ids_are_dealt_out(documents, monkeypatch):
    """No block of rows grows with the rows of one id, and equal rows are one until the end."""
    monkeypatch.setattr(fingerprints, "ROW_BITS", 3)
    monkeypatch.setattr(fingerprints, "COPIES", 4)
    rows = [(None, words(8, i)) for i in range(60)] + [(7, words(8, 100 + i)) for i in range(60)] + [(9, "same text here")] * 30
    ids = fingerprints._rows(documents(rows), "doc_id", "text").groupBy(*fingerprints._ROW).count().drop("count")
    sizes = [r["count"] for r in fingerprints._followers(ids).groupBy("block").count().collect()]
    assert max(sizes) <= 9 and sum(sizes) == 121 + len(sizes)
    got = fingerprints.edited_fingerprints(documents(rows)).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    itself = hashlib.sha256(b"same tesame te").hexdigest()
    assert sum(r.doc_id == 9 and r.edited_sha256 == itself for r in got) == 29
    texts = {t for _, t in rows}
    halves = Counter(r.edited_sha256 for r in got)
    following = Counter(hashlib.sha256((a[: len(a) - len(a) // 2] + b[: len(a) // 2]).encode()).hexdigest() for a in texts for b in texts)
    assert all(h in following for h in halves)


@pytest.mark.parametrize("row_bits", [11, 1])
def test_edited_texts_and_neighbours(documents, monkeypatch, row_bits):
    monkeypatch.setattr(fingerprints, "ROW_BITS", row_bits)
    rng = random.Random(5)
    rows = [(rng.randrange(10**12) if i % 3 else i, t) for i, t in enumerate([*[words(rng.randint(1, 200), i) for i in range(40)], *ODD])]
    rows.append((-5, "né " * 40))
    want = edits(rows)
    by = {r[0]: i for i, r in enumerate(rows)}
    got = fingerprints.edited_fingerprints(documents(rows, more="bucket id hash guest")).collect()
    assert len(got) == len(rows)
    for r in got:
        i = by[r.doc_id]
        assert r.n_chars == len(rows[i][1] or "")
        assert r.edited_sha256 == hashlib.sha256(want[i].encode()).hexdigest()
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1


def test_equal_texts_equal_fingerprints_and_likeness_falls_with_edits(documents):
    base = words(400, 1).split()
    moved = base[200:] + base[:200]
    shuffled = base[:]
    random.Random(1).shuffle(shuffled)
    few = base[:]
    for i in range(0, 400, 80):
        few[i] = "changed"
    texts = [base, base, few, moved, shuffled, words(400, 9).split()]
    got = fingerprints.fingerprints(documents([(i, " ".join(t)) for i, t in enumerate(texts)])).orderBy("doc_id")
    rows = got.collect()
    assert rows[0].fingerprint == rows[1].fingerprint and len(rows[0].signature) > 50
    pairs = got.alias("a").filter("doc_id = 0").crossJoin(got.alias("b"))
    like = {r[0]: r[1] for r in pairs.select(F.col("b.doc_id"), fingerprints.likeness(F.col("a.signature"), F.col("b.signature"))).collect()}
    assert like[1] == 1.0 and like[1] > like[2] > like[3] > like[5] and like[4] < 0.1 and like[5] == 0.0


def test_order_counts_where_the_set_of_kmers_does_not(documents):
    """Two texts of the same k-mers in another order differ, which a plain minimum sketch would not see."""
    a, b = " ".join(["p q r"] * 1 + ["s t u v w x y z"] * 1), " ".join(["s t u v w x y z", "p q r"])
    long_a, long_b = words(300, 3), words(300, 4)
    texts = [f"{long_a} {long_b}", f"{long_b} {long_a}", a, b]
    rows = fingerprints.fingerprints(documents(list(enumerate(texts)))).orderBy("doc_id").collect()
    x, y = set(rows[0].signature), set(rows[1].signature)
    assert 0.2 < len(x & y) / len(x) < 0.9


def test_repeats_are_numbered(documents):
    rows = [(1, "a b c " * 10), (2, "a b c " * 60), (3, "a b c " * 60)]
    got = {r.doc_id: r for r in fingerprints.fingerprints(documents(rows)).collect()}
    assert got[2].fingerprint == got[3].fingerprint
    assert len(got[2].signature) > len(got[1].signature) > 10


def test_single_row_repeated_rows_nulls_and_empty_table(documents):
    one = fingerprints.edited_fingerprints(documents([(1, "abcdef")])).first()
    assert one.edited_sha256 == hashlib.sha256(b"abcabc").hexdigest() and one.near_next == 1.0
    rows = [(None, "a b"), (None, None), (3, "x y z w"), (3, "x y z w"), (2, None)]
    got = fingerprints.edited_fingerprints(documents(rows)).collect()
    assert len(got) == 5 and len({r.fingerprint for r in got if r.doc_id == 3}) == 1
    assert fingerprints.edited_fingerprints(documents([])).collect() == []


def test_no_python_on_the_path(documents):
    plan = fingerprints.edited_fingerprints(documents([(1, "a b c d"), (2, "c d e")]))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
