"""Repair of conversations: the cheapest edits after which roles alternate as they should, found by iterative deepening A*.

A conversation is well formed when its roles' initials read ``(s?(ua)+)?``. Turns are kept, given another role, deleted,
or inserted; ``search`` walks depth first through these edits in ASCII order of their initials, under a cost bound that
rises to the least cost it had to cut off, and remembers what has failed with how much left to spend. The first path it
completes is the cheapest, and of the cheapest the least in ASCII.

What the search needs of a turn is one character: its role's initial and its fault. Turns are put in order by a range
sort of narrow rows, which cuts a conversation of any length into pieces of at most ``PIECE`` turns. Pieces of one
conversation are joined through the four states between them: least costs from state to state (by the search), scanned
from the back, tell what each end state will still cost; exits scanned from the front tell where each piece begins. A
text is moved once, to where its conversation is written out; there a task holds one conversation's edits, a letter a turn.

Order: by turn (nulls first), then role, then SHA-256 of the text. A null role or text is one space; rows of null
conversation id are one conversation; repeated rows are repeated turns; an empty table gives an empty table. Other columns
are ignored, whatever they are called.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from wakeline.llm.common import map_arrow, stored

#: Turns of one piece as a power of two, and turns that one search takes at once.
PIECE_BITS = 13
SEGMENT = 16

#: Costs of the edits, and of keeping a turn that breaks off.
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1

#: Neither visible character nor line: what a blank text is made of.
BLANKS = " \t\n\x0b\f\r"

# States: nothing said yet, system, user, assistant spoke last. The role that a new turn must have follows from them.
_NEXT = (2, 2, 3, 2)
_KEPT = {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None), "x": (None,) * 4}
_ROLE = {2: "user", 3: "assistant"}
#: What ending a conversation in each state costs: a user's turn wants an answer, a system's both.
CLOSING = (0, 2 * INSERT, INSERT, 0)
NEVER = 1 << 60

# One character a turn: lower case whole, upper case truncated, a digit blank or duplicate.
_CLASS = {c: k for c, k in zip("suaxSUAX1234", "suaxsuaxsuax")}
_CUT, _LOST = frozenset("SUAX"), frozenset("1234")


@lru_cache(maxsize=200_000)
def search(turns: str, entry: int, ends: tuple[int, ...]) -> tuple[int, str, int]:
    """(cost, edits, exit) of the cheapest edits of ``turns`` from state ``entry``; ``ends`` is what each exit will cost.

    Of equally cheap edits the least in ASCII. Edits before a turn are its own: nothing is inserted behind the last one.
    Cost NEVER where no exit with an end below NEVER can be reached.
    """
    n = len(turns)
    if not any(end < NEVER and _reachable(turns, entry, q) for q, end in enumerate(ends)):
        return NEVER, "", entry
    least, first = _bounds(turns)
    closing = min(ends)

    def estimate(i: int, q: int) -> int:
        if i == n:
            return ends[q]
        kind = first[i]
        return closing + least[i] + (kind not in ("", "x") and _KEPT[kind][q] is None)

    needed: dict[tuple[int, int], int] = {}  # of states that failed: what they cost at least, as far as is known by now
    bound = estimate(0, entry)
    while True:
        over, path, stack = NEVER, [], [[0, entry, 0, iter(_edits(turns, 0, entry)), NEVER]]
        while stack:
            frame = stack[-1]
            i, q, spent, edits, _ = frame
            if i == n:
                return spent + ends[q], "".join(path), q
            for letter, j, state, cost in edits:
                if (rest := needed.get((j, state))) is None:
                    rest = estimate(j, state)
                if spent + cost + rest > bound:
                    over = min(over, spent + cost + rest)
                elif letter != "I" or all(f[0] != i or f[1] != state for f in stack[-3:]):
                    path.append(letter)
                    stack.append([j, state, spent + cost, iter(_edits(turns, j, state)), NEVER])
                    break
                frame[4] = min(frame[4], cost + rest)
            else:
                needed[i, q] = max(needed.get((i, q), 0), frame[4])
                stack.pop()
                if stack:
                    parent = stack[-1]
                    parent[4] = min(parent[4], spent - parent[2] + needed[i, q])
                    over = min(over, max(spent + needed[i, q], bound + 1))
                    path.pop()
        bound = over


def _allowed(c: str, q: int) -> list[tuple[str, int, int, int]]:
    """(initial, turns used, next state, cost) of the edits at a turn in ASCII order."""
    edits = [("D", 1, q, DELETE), ("I", 0, _NEXT[q], INSERT)]
    if c not in _LOST:
        cut = TRUNCATED if c in _CUT else 0
        if (kept := _KEPT[_CLASS[c]][q]) is not None:
            edits.append(("K", 1, kept, cut))
        edits.append(("R", 1, _NEXT[q], REROLE + cut))
    return edits


_EDITS = {(c, q): _allowed(c, q) for c in _CLASS for q in range(4)}


def _edits(turns: str, i: int, q: int) -> list[tuple[str, int, int, int]]:
    return [(letter, i + used, state, cost) for letter, used, state, cost in _EDITS[turns[i], q]] if i < len(turns) else []


def _reachable(turns: str, entry: int, exit: int) -> bool:
    if exit == 0:
        return entry == 0
    if exit == 1:
        return entry == 1 or (entry == 0 and ("s" in turns or "S" in turns))
    return True


def _bounds(turns: str) -> tuple[list[int], list[str]]:
    """What the turns from i on cost at least, and the class of the first that may stay.

    A lost turn costs its deletion, another role's a change, a truncated one its mark; of two neighbours that may not follow
    each other something must change, and no edit mends more than two such pairs.
    """
    least, first = [0] * (len(turns) + 1), [""] * (len(turns) + 1)
    for i in range(len(turns) - 1, -1, -1):
        c = turns[i]
        kind, after = _CLASS[c], first[i + 1]
        if c in _LOST:
            least[i], first[i] = least[i + 1] + DELETE, after
            continue
        own = (REROLE if kind == "x" else 0) + (TRUNCATED if c in _CUT else 0)
        clash = kind != "x" and after not in ("", "x") and kind + after not in ("su", "ua", "au")
        least[i], first[i] = least[i + 1] + own + clash, kind
    return least, first


def segments(turns: str) -> list[str]:
    return [turns[i : i + SEGMENT] for i in range(0, len(turns), SEGMENT)]


def least_costs(turns: str) -> list[int]:
    """Least costs from each state to each (16 numbers), by a search for every pair in every segment."""
    total = [0 if p == q else NEVER for p in range(4) for q in range(4)]
    for part in segments(turns):
        one = [search(part, p, tuple(0 if e == q else NEVER for e in range(4)))[0] for p in range(4) for q in range(4)]
        total = [min(NEVER, min(total[4 * p + k] + one[4 * k + q] for k in range(4))) for p in range(4) for q in range(4)]
    return total


def before(costs: list[int], ends: list[int]) -> list[int]:
    """What each entry state costs, given least costs from state to state and what each exit will cost."""
    return [min(NEVER, min(costs[4 * p + q] + ends[q] for q in range(4))) for p in range(4)]


def walk(turns: str, entry: int, ends: list[int]) -> tuple[int, str, int]:
    """(own cost, edits, exit) of the cheapest way through ``turns`` of any number, segment by segment."""
    parts = segments(turns)
    behind = [tuple(ends)]
    for part in reversed(parts[1:]):
        behind.append(tuple(before(least_costs(part), list(behind[-1]))))
    paths, spent = [], 0
    for part, after in zip(parts, reversed(behind)):
        cost, path, state = search(part, entry, after)
        if cost >= NEVER:
            return NEVER, "", entry
        spent += cost - after[state]
        paths.append(path)
        entry = state
    return spent, "".join(paths), entry


def _rows(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(key, turn, role, text, sha): the key is a string, never null."""
    id_ = F.col(f"`{conv}`").cast("string")
    key = F.when(id_.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), id_))
    return rows.select(
        key.alias("key"),
        F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(f"`{text}`"), F.lit(" ")).alias("text"),
    ).withColumn("sha", F.unhex(F.sha2("text", 256)))


def _pieces(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stored (key, block, turns, blank, duplicate, truncated) of all pieces in order, and (key, gaps)."""
    shown = F.rtrim("text", F.lit(BLANKS))
    narrow = rows.select(
        "key",
        "turn",
        "role",
        "sha",
        (shown == "").alias("blank"),
        (~F.right(shown, F.lit(1)).isin(".", "!", "?")).alias("truncated"),
        F.monotonically_increasing_id().alias("__row"),
    )
    order = ["key", F.col("turn").asc_nulls_first(), "role", "sha", "__row"]
    ordered = stored(narrow, "turns").repartitionByRange(*order).sortWithinPartitions(*order)
    ordered = stored(ordered.drop("__row").withColumn("at", F.monotonically_increasing_id()), "ordered")
    same = ordered.groupBy("key", "role", "sha").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    same = stored(same.filter("n > 1").drop("n"), "repeats")
    marked = ordered.join(same, ["key", "role", "sha"], "left")
    repeat = ~F.col("blank") & (F.col("at") > F.coalesce("first", "at"))
    initial = F.substring("role", 1, 1)
    kind = F.when(initial.isin("s", "u", "a"), initial).otherwise(F.lit("x"))
    lost = F.col("blank") | F.col("duplicate")
    marked = marked.select("key", F.shiftright("at", PIECE_BITS).alias("block"), "at", "blank", repeat.alias("duplicate"), "truncated", kind.alias("kind"))
    mark = F.when(lost, F.translate("kind", "suax", "1234")).when(F.col("truncated"), F.upper("kind")).otherwise(F.col("kind"))
    pieces = marked.groupBy("key", "block").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", mark.alias("mark")))), lambda s: s["mark"]), "").alias("turns"),
        F.count_if("blank").alias("blank"),
        F.count_if("duplicate").alias("duplicate"),
        F.count_if(~lost & F.col("truncated")).alias("truncated"),
    )
    gaps = ordered.groupBy("key").agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn"), F.lit(0)).cast("long").alias("gaps"))
    return stored(pieces, "pieces"), gaps


_BY_KEY = "key string, block long"


def _audits(pieces: DataFrame) -> DataFrame:
    """(key, block, audit, cost) of every piece."""
    counted = pieces.select("key", "block", "turns", F.count(F.lit(1)).over(Window.partitionBy("key")).alias("n"))
    counted = stored(counted, "counted")
    plain = map_arrow(counted.filter("n = 1").select("key", "block", "turns"), _walk_whole, f"{_BY_KEY}, audit string, cost long")
    cut = counted.filter("n > 1").select("key", "block", "turns").repartition("key", "block")
    costs = stored(map_arrow(cut, _cost_pieces, f"{_BY_KEY}, costs array<long>"), "costs")
    ends = costs.groupBy("key").applyInArrow(_scan_ends, f"{_BY_KEY}, ends array<long>, last boolean")
    walked = map_arrow(
        cut.join(stored(ends, "ends"), ["key", "block"]), _walk_pieces,
        f"{_BY_KEY}, last boolean, paths array<string>, spent array<long>, exits array<int>",
    )
    walked = stored(walked, "walked")
    entered = walked.select("key", "block", "exits").groupBy("key").applyInArrow(_scan_entries, f"{_BY_KEY}, entry int")
    chosen = walked.join(stored(entered, "entries"), ["key", "block"])
    of = lambda name: F.get(F.col(name), F.col("entry"))
    closing = F.when(F.col("last"), F.get(F.array(*[F.lit(c) for c in CLOSING]), of("exits"))).otherwise(0)
    cut_audit = F.concat(of("paths"), F.expr(f"repeat('I', div(__closing, {INSERT}))"))
    chosen = chosen.withColumn("__closing", closing.cast("int"))
    return plain.union(chosen.select("key", "block", cut_audit.alias("audit"), (of("spent") + F.col("__closing")).alias("cost")))


def _walk_whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for turns in batch.column("turns").to_pylist():
            cost, path, state = walk(turns, 0, list(CLOSING))
            found.append((path + "I" * (CLOSING[state] // INSERT), cost + CLOSING[state]))
        columns = [batch.column("key"), batch.column("block"), pa.array([a for a, _ in found], pa.string()), pa.array([c for _, c in found], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["key", "block", "audit", "cost"])


def _cost_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        costs = pa.array([least_costs(t) for t in batch.column("turns").to_pylist()], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("block"), costs], names=["key", "block", "costs"])


def _scan_ends(table: pa.Table) -> pa.Table:
    """What the conversation still costs behind each piece, from its last piece to its first."""
    table = table.sort_by([("block", "descending")])
    ends, now = [], list(CLOSING)
    for costs in table.column("costs").to_pylist():
        ends.append(now)
        now = before(costs, now)
    last = [True] + [False] * (table.num_rows - 1)
    return pa.table({"key": table.column("key"), "block": table.column("block"), "ends": pa.array(ends, pa.list_(pa.int64())), "last": last})


def _walk_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [
            [walk(turns, entry, ends) for entry in range(4)]
            for turns, ends in zip(batch.column("turns").to_pylist(), batch.column("ends").to_pylist())
        ]
        columns = [
            batch.column("key"),
            batch.column("block"),
            batch.column("last"),
            pa.array([[w[1] for w in r] for r in rows], pa.list_(pa.string())),
            pa.array([[w[0] for w in r] for r in rows], pa.list_(pa.int64())),
            pa.array([[w[2] for w in r] for r in rows], pa.list_(pa.int32())),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["key", "block", "last", "paths", "spent", "exits"])


def _scan_entries(table: pa.Table) -> pa.Table:
    table = table.sort_by("block")
    entries, state = [], 0
    for exits in table.column("exits").to_pylist():
        entries.append(state)
        state = exits[state]
    return pa.table({"key": table.column("key"), "block": table.column("block"), "entry": pa.array(entries, pa.int32())})


_FACTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _heads(pieces: DataFrame, gaps: DataFrame) -> DataFrame:
    """One row per conversation: its faults, cost and audit."""
    kinds = F.translate("turns", "SUAX1234", "suaxsuax")
    lawful = sum((F.length("kinds") - F.length(F.replace("kinds", F.lit(p), F.lit("")))) / 2 for p in ("su", "ua", "au"))
    back = F.lag(F.right("kinds", F.lit(1))).over(Window.partitionBy("key").orderBy("block"))
    seam = F.concat(back, F.substring("kinds", 1, 1))
    faults = pieces.withColumn("kinds", kinds).withColumn("seam", seam)
    broken = F.length("kinds") - 1 - lawful + (F.col("seam").isNotNull() & ~F.col("seam").isin("su", "ua", "au")).cast("int")
    faults = faults.groupBy("key").agg(
        *[F.sum(c).cast("long").alias(c) for c in ("blank", "duplicate", "truncated")], F.sum(broken).cast("long").alias("illegal")
    )
    parts = F.transform(F.array_sort(F.collect_list(F.struct("block", "audit"))), lambda s: s["audit"])
    audits = _audits(pieces).groupBy("key").agg(F.array_join(parts, "").alias("audit"), F.sum("cost").alias("cost"))
    return stored(faults.join(audits, "key").join(gaps, "key"), "heads")


def _written(rows: DataFrame, heads: DataFrame) -> DataFrame:
    """The texts of each conversation in order behind its head; a text moves here and nowhere else."""
    head = heads.select("key", F.lit(0).alias("kind"), F.lit(None).cast(rows.schema["turn"].dataType).alias("turn"),
                        F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"),
                        F.lit(None).cast("binary").alias("sha"), "audit", *_FACTS)
    none = [F.lit(None).cast("string").alias("audit"), *[F.lit(None).cast("long").alias(c) for c in _FACTS]]
    every = head.union(rows.select("key", F.lit(1).alias("kind"), "turn", "role", "text", "sha", *none))
    order = ["key", "kind", F.col("turn").asc_nulls_first(), "role", "sha"]
    return every.repartition("key").sortWithinPartitions(*order).drop("turn", "sha")


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict | None, str, str, str]]:
    """(head, edit, role, text): a head opens its conversation, then its turns follow, the deleted ones too."""
    audit, at, state = "", 0, 0

    def inserts():
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            at, state = at + 1, _NEXT[state]
            yield None, "I", _ROLE[state], ""

    for batch in batches:
        names = batch.schema.names
        for row in zip(*(batch.column(c).to_pylist() for c in names)):
            row = dict(zip(names, row))
            if row["kind"] == 0:
                yield from inserts()
                audit, at, state = row["audit"], 0, 0
                yield row, "", "", ""
                continue
            yield from inserts()
            edit, role = audit[at], row["role"]
            at += 1
            if edit == "K":
                state = _KEPT[role[0]][state]
            elif edit == "R":
                state = _NEXT[state]
                role = _ROLE[state]
            yield None, edit, role, row["text"]
    yield from inserts()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    done: list[tuple[dict, str]] = []
    head, sha, said = None, None, False
    for opened, edit, role, text in _turns(batches):
        if opened is not None:
            if head is not None:
                done.append((head, sha.hexdigest()))
            if len(done) >= 5000:
                yield _digest_batch(done)
                done = []
            head, sha, said = opened, hashlib.sha256(), False
        elif edit != "D":
            sha.update((("\n" if said else "") + f"{role}:{text}").encode())
            said = True
    if head is not None:
        done.append((head, sha.hexdigest()))
    if done:
        yield _digest_batch(done)


def _digest_batch(done: list[tuple[dict, str]]) -> pa.RecordBatch:
    names = ["key", *_FACTS, "audit"]
    kinds = [pa.string(), *[pa.int64()] * len(_FACTS), pa.string()]
    columns = [pa.array([h[c] for h, _ in done], k) for c, k in zip(names, kinds)]
    return pa.RecordBatch.from_arrays([*columns, pa.array([s for _, s in done])], names=[*names, "repaired_sha256"])


def _spelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out, key, place, size = [], None, 0, 0
    names = ["key", "place", "edit", "role", "text"]
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]
    for opened, edit, role, text in _turns(batches):
        if opened is not None:
            key, place = opened["key"], 0
            continue
        out.append((key, place, edit, role, text))
        place, size = place + 1, size + len(text)
        if len(out) >= 5000 or size > 1_000_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)
            out, size = [], 0
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)


def _ids(rows: DataFrame, conv: str) -> DataFrame:
    id_ = F.col(f"`{conv}`").cast("string")
    key = F.when(id_.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), id_))
    return rows.select(F.col(f"`{conv}`").alias(conv), key.alias("key")).distinct()


def audit(
    rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", every: DataFrame | None = None
) -> DataFrame:
    """One row per conversation: id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    ``every`` may hold more conversations (column ``conv``): those without rows get zeros, an empty audit and the hash of
    nothing. The hash is that of ``role:text`` of the repaired turns, joined by line feeds.
    """
    source = _rows(rows, conv, turn, role, text)
    pieces, gaps = _pieces(source)
    schema = "key string, " + ", ".join(f"{c} long" for c in _FACTS) + ", audit string, repaired_sha256 string"
    found = map_arrow(_written(source, _heads(pieces, gaps)), _digests, schema)
    ids = _ids(rows if every is None else every, conv)
    nothing = {**dict.fromkeys(_FACTS, 0), "audit": "", "repaired_sha256": hashlib.sha256().hexdigest()}
    return ids.join(found, "key", "left").select(F.col(f"`{conv}`"), *[F.coalesce(c, F.lit(v)).alias(c) for c, v in nothing.items()])


def repaired(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(id, place, edit, role, text): all turns in order with what became of them; ``edit`` D marks those to leave out."""
    source = _rows(rows, conv, turn, role, text)
    pieces, gaps = _pieces(source)
    found = map_arrow(_written(source, _heads(pieces, gaps)), _spelled, "key string, place long, edit string, role string, text string")
    return _ids(rows, conv).join(found, "key").select(F.col(f"`{conv}`"), "place", "edit", "role", "text")


def damaged(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows spoilt by crc32(``conv:turn``) % 20: 0 gone, 1 emptied, 2 without ``.!?``, 3 twice, 4 said by the user."""

    def shown(name: str) -> Column:
        return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(" "))

    fate = (F.crc32(F.concat_ws(":", shown(conv), shown(turn)).cast("binary")) % 20).alias("__fate")
    kept = rows.select(F.col(f"`{conv}`"), F.col(f"`{turn}`"), shown(role).alias("__role"), shown(text).alias("__text"), fate).filter("__fate <> 0")
    said = F.when(F.col("__fate") == 1, F.lit("")).when(F.col("__fate") == 2, F.regexp_replace("__text", "[.!?]", "")).otherwise(F.col("__text"))
    by = F.when(F.col("__fate") == 4, F.lit("user")).otherwise(F.col("__role"))
    times = F.when(F.col("__fate") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return kept.select(F.col(f"`{conv}`"), F.col(f"`{turn}`"), by.alias(role), said.alias(text), F.explode(times).alias("__copy")).drop("__copy")
