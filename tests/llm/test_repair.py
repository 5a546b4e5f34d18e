"""Repairs against a plain dynamic program, whole and in pieces; faults, order and hashes against plain Python."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from wakeline.llm import repair as R

SCHEMA = "conv_id long, turn long, role string, text string"
WS = " \t\n\x0b\x0c\r"
ROLE = {2: "user", 3: "assistant"}


def cheapest(turns):
    """Least (cost, edits): forward over turns, one best way for every state."""
    best = {0: (0, "")}

    def grown(best):
        for _ in range(3):
            for q, (c, a) in list(best.items()):
                best[R._NEXT[q]] = min(best.get(R._NEXT[q], (10**9, "")), (c + 2, a + "I"))
        return best

    for ch in turns:
        new = {}
        for q, (c, a) in grown(best).items():
            ways = [(q, c + 3, "D")]
            if ch not in "1234":
                cut, kept = ch in "SUAX", R._KEPT[R._CLASS[ch]][q]
                ways += [(kept, c + cut, "K")] if kept is not None else []
                ways += [(R._NEXT[q], c + 2 + cut, "R")]
            for state, cost, letter in ways:
                new[state] = min(new.get(state, (10**9, "")), (cost, a + letter))
        best = new
    best = grown(best)
    return min(best[q] for q in (0, 3) if q in best)


def plain(rows):
    """{conv: (gaps, blank, duplicate, truncated, illegal, cost, audit, hash)}"""
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        groups[conv].append((turn, " " if role is None else role, " " if text is None else text))
    out = {}
    for conv, held in groups.items():
        held.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
        seen, marks, kinds, faults = set(), "", "", [0, 0, 0]
        for _, role, text in held:
            kind = role[0] if role[:1] in tuple("sua") else "x"
            kinds += kind
            shown = text.rstrip(WS)
            if not shown.strip(WS):
                fault = 0
            elif (role, text) in seen:
                fault = 1
            else:
                fault = 2 if shown[-1] not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                faults[fault] += 1
            marks += {0: str("suax".index(kind) + 1), 1: str("suax".index(kind) + 1), 2: kind.upper()}.get(fault, kind)
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(kinds, kinds[1:]))
        cost, audit = cheapest(marks)
        state, said, rest = 0, [], iter(held)
        for e in audit:
            if e == "I":
                state = R._NEXT[state]
                said.append(ROLE[state] + ":")
                continue
            _, role, text = next(rest)
            if e == "K":
                state = R._KEPT[role[0]][state]
                said.append(f"{role}:{text}")
            elif e == "R":
                state = R._NEXT[state]
                said.append(f"{ROLE[state]}:{text}")
        turns = [t for t, _, _ in held if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[conv] = (gaps, *faults, illegal, cost, audit, hashlib.sha256("\n".join(said).encode()).hexdigest())
    return out


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        show = lambda v: " " if v is None else str(v)
        fate = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20
        role, text = show(role), show(text)
        if fate == 1:
            text = ""
        elif fate == 2:
            text = text.translate({ord(c): None for c in ".!?"})
        elif fate == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    return out


def conversations(seed, sizes):
    rng = random.Random(seed)
    rows = []
    for conv, n in enumerate(sizes):
        for i in range(n):
            role = ["user", "assistant"][i % 2] if rng.random() < 0.8 else rng.choice(["system", "user", "assistant", "tool", "", None])
            text = rng.choice(["", " \n", "Well.", "Why not", "No!\n", "é", None]) if rng.random() < 0.3 else f"Said {rng.random()}" + rng.choice([".", "?", ""])
            turn = None if rng.random() < 0.05 else i + (rng.random() < 0.1) * 3
            rows.append((None if conv == 3 else conv, turn, role, text))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("segment", [16, 3, 1])
def test_search_finds_the_least_of_the_cheapest(monkeypatch, segment):
    monkeypatch.setattr(R, "SEGMENT", segment)
    R.search.cache_clear()
    rng = random.Random(segment)
    for _ in range(1500):
        turns = "".join(rng.choice("ssuuaaxSUAX1234uaua") for _ in range(rng.randint(1, 14)))
        cost, path, state = R.walk(turns, 0, list(R.CLOSING))
        assert (cost + R.CLOSING[state], path + "I" * (R.CLOSING[state] // 2)) == cheapest(turns)
    R.search.cache_clear()


def checked(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    return {r.conv_id: tuple(r)[1:] for r in R.audit(df.selectExpr("*", "1 AS key", "2 AS at", "3 AS cost")).collect()}


def test_conversations_as_by_hand(spark):
    rows = conversations(1, [1, 2, 8, 6, 8, 30, 7, 5, 60, 3])
    assert checked(spark, rows) == plain(rows)


def test_long_conversations_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(R, "PIECE_BITS", 3)
    rows = conversations(2, [150, 4, 90, 40])
    assert checked(spark, rows) == plain(rows)


def test_damage(spark):
    rows = conversations(3, [20] * 30)
    got = R.damaged(spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS __fate"))
    key = lambda r: tuple(str(v) for v in r)
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(plain_damage(rows), key=key)


def test_conversations_that_lost_all_rows(spark):
    every = spark.createDataFrame([(1, 1, "user", "a"), (2, 1, None, None), (None, None, None, None)], SCHEMA)
    nothing = hashlib.sha256().hexdigest()
    got = {r.conv_id: tuple(r)[1:] for r in R.audit(every.limit(0), every=every).collect()}
    assert got == dict.fromkeys([1, 2, None], (0, 0, 0, 0, 0, 0, "", nothing))
    assert R.audit(every.limit(0)).collect() == []


def test_repeated_rows_and_repaired_turns(spark):
    rows = [(1, 1, "system", "Be kind.")] + [(1, 2, "user", "Hi.")] * 40 + [(1, 3, "user", "What")] + [(1, 4, "x" * 500, "y" * 30_000)]
    assert checked(spark, rows) == plain(rows)
    got = R.repaired(spark.createDataFrame(rows, SCHEMA)).orderBy("place").collect()
    said = "\n".join(f"{r.role}:{r.text}" for r in got if r.edit != "D")
    assert hashlib.sha256(said.encode()).hexdigest() == plain(rows)[1][-1]
    assert "".join(r.edit for r in got) == plain(rows)[1][-2]
