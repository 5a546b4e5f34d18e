"""Removal of long byte strings that occur more than once, by sorting suffixes from shared anchors."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wakeline.llm.common import Prefixes, byte_table, grouped, in_blocks, map_arrow, runs, starts_of, stored, text_batches

#: Length of a repeated string, and of the anchors that any such string holds.
LENGTH, ANCHOR = 400, 64
#: Bytes before and behind an anchor that a string of LENGTH around it can reach.
REACH = LENGTH - ANCHOR
#: Occurrences of an anchor that meet in one task, and up to how many are compared by pairs.
BLOCK, PAIRWISE = 16_384, 128
#: Bytes compared at once by the multikey quicksort, and the depth from which blind tries take over.
SUPER, SHALLOW = 8, 24


def sliding(a: np.ndarray, width: int, pick: np.ufunc, fill: int) -> np.ndarray:
    """pick (minimum or maximum) of every ``width`` neighbours: running picks from both ends of blocks."""
    n = len(a)
    rows = -(-n // width)
    grid = np.full(rows * width, fill, a.dtype)
    grid[:n] = a
    grid = grid.reshape(rows, width)
    ahead = pick.accumulate(grid, 1).ravel()
    back = pick.accumulate(grid[:, ::-1], 1)[:, ::-1].ravel()
    return pick(back[: n - width + 1], ahead[width - 1 : n])


def anchors(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, position in it, hash, hash of the context) of all anchors of texts of LENGTH bytes and more.

    An anchor is a string of ANCHOR bytes whose hash is the least within some LENGTH bytes of one text (all ties count).
    So equal strings of LENGTH bytes hold equal anchors at equal places. The context is what a string of LENGTH bytes
    around the anchor can cover; equal contexts mean that all of these strings occur at both places.
    """
    none = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return none, none, none, none
    sums = Prefixes(data)
    at = np.arange(len(data) - ANCHOR + 1)
    value = sums.of(at, at + ANCHOR) | np.uint64(1)
    least = sliding(value, REACH + 1, np.minimum, 2**64 - 1)  # of LENGTH bytes from each place on
    text = np.searchsorted(starts, np.arange(len(least)), side="right") - 1
    least[np.arange(len(least)) + LENGTH > starts[text + 1] - 1] = 0  # runs over the end of its text
    ahead = np.concatenate([np.zeros(REACH, np.uint64), least, np.zeros(len(value) - len(least), np.uint64)])
    best = sliding(ahead, REACH + 1, np.maximum, 0)
    place = np.flatnonzero(best == value)
    owner = np.searchsorted(starts, place, side="right") - 1
    begin, end = np.maximum(place - REACH, starts[owner]), np.minimum(place + LENGTH, starts[owner + 1] - 1)
    context = sums.of(begin, end) + (place - begin).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return owner, place - starts[owner], value[place].view(np.int64), context.view(np.int64)


def reduced(
    owner: np.ndarray, place: np.ndarray, value: np.ndarray, context: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, last, count): occurrences of equal anchor and context in one text, whose contexts touch, as one.

    ``first`` are rows of the input, ``last`` places. All of them cover one span, from the context of the first to that of
    the last, so a run of one byte or of a short period gives a few rows however long it is.
    """
    order = np.lexsort((place, context, value, owner))
    o, p, v, c = owner[order], place[order], value[order], context[order]
    new = np.ones(len(o), bool)
    new[1:] = (o[1:] != o[:-1]) | (v[1:] != v[:-1]) | (c[1:] != c[:-1]) | (p[1:] - p[:-1] > REACH + LENGTH)
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(o))
    return order[begin], p[end - 1], (end - begin).astype(np.int64)


def common_prefix(a: bytes, b: bytes, low: int = 0) -> int:
    """Length of the common prefix; the first ``low`` bytes are known to agree."""
    high = min(len(a), len(b))
    if a[low:high] == b[low:high]:
        return high
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


class BlindTrie:
    """Sorts strings with a long common prefix: nodes know only a depth and the bytes that branch there."""

    def __init__(self, strings: list[bytes], depth: int):
        self.strings, self.depth, self.root = strings, depth, None

    def insert(self, i: int) -> None:
        """Go down by branching bytes alone to some leaf, compare once with it, and branch at the first difference."""
        s = self.strings[i]
        if self.root is None:
            self.root = [i]
            return
        node = self.root
        while isinstance(node, tuple):
            at, children = node
            byte = s[at] if at < len(s) else -1
            node = children[byte] if byte in children else next(iter(children.values()))
        leaf = self.strings[node[0]]
        same = common_prefix(s, leaf, self.depth)
        if same == len(s) == len(leaf):
            node.append(i)
            return
        new, old = (s[same] if same < len(s) else -1), (leaf[same] if same < len(leaf) else -1)
        parent, edge, node = None, None, self.root
        while isinstance(node, tuple) and node[0] < same:
            parent, edge = node, s[node[0]]
            node = node[1][edge]
        if isinstance(node, tuple) and node[0] == same:
            node[1][new] = [i]
            return
        branch = (same, {old: node, new: [i]})
        if parent is None:
            self.root = branch
        else:
            parent[1][edge] = branch

    def ordered(self) -> list[int]:
        out, stack = [], [self.root]
        while stack:
            node = stack.pop()
            if isinstance(node, tuple):
                stack += [node[1][b] for b in sorted(node[1], reverse=True)]
            else:
                out += node
        return out


def sorted_suffixes(strings: list[bytes]) -> list[int]:
    """Numbers of the strings in order: multikey quicksort to SHALLOW bytes, blind tries for what is still equal."""
    out: list[int] = []
    stack = [(list(range(len(strings))), 0)]
    while stack:
        group, depth = stack.pop()
        if len(group) == 1:
            out += group
            continue
        if depth >= SHALLOW:
            trie = BlindTrie(strings, depth)
            for i in group:
                trie.insert(i)
            out += trie.ordered()
            continue
        keys = {i: strings[i][depth : depth + SUPER] for i in group}
        pivot = keys[group[len(group) // 2]]
        less = [i for i in group if keys[i] < pivot]
        same = [i for i in group if keys[i] == pivot]
        more = [i for i in group if keys[i] > pivot]
        if more:
            stack.append((more, depth))
        if len(pivot) < SUPER:  # all of these end here and are equal
            stack += [([i], depth) for i in same]
        else:
            stack.append((same, depth + SUPER))
        if less:
            stack.append((less, depth))
    return out


def neighbours(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(order, common prefix of each string with the one before it in the order; 0 for the first)."""
    order = sorted_suffixes(strings)
    step = [0] + [common_prefix(strings[a], strings[b]) for a, b in zip(order, order[1:])]
    return np.array(order), np.array(step, np.int32)


def prefix_lengths(strings: list[bytes]) -> np.ndarray:
    """(n, n) lengths of common prefixes: the least of the neighbours' between two places of the order."""
    order, step = neighbours(strings)
    n = len(order)
    grid = np.zeros((n, n), np.int32)
    for k in range(n - 1):
        grid[order[k], order[k + 1 :]] = np.minimum.accumulate(step[k + 1 :])
    return np.maximum(grid, grid.T)


def reaches(lefts: list[bytes], rights: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes before and behind the anchor that repeated strings of LENGTH bytes cover, for each occurrence; -1: none.

    ``lefts`` are read away from the anchor. All strings that count hold the anchor, so what they cover is one span.
    """
    n = len(lefts)
    if n == 2:
        a, b = sorted_suffixes(rights)
        left, right = common_prefix(*lefts), common_prefix(rights[a], rights[b])
        ok = left + right >= REACH
        return np.full(2, left if ok else -1), np.full(2, right if ok else -1)
    if n <= PAIRWISE:
        left, right = prefix_lengths(lefts), prefix_lengths(rights)
        ok = left + right >= REACH
        np.fill_diagonal(ok, False)
        return np.where(ok, left, -1).max(1), np.where(ok, right, -1).max(1)
    return reaches_of_many(lefts, rights)


def reaches_of_many(lefts: list[bytes], rights: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """As ``reaches`` without comparing pairs.

    A string of LENGTH bytes begins x bytes before the anchor. Occurrences that agree on x bytes to the left are runs of
    the left order, those that agree on REACH - x bytes to the right are runs of the right order; two that share both
    runs hold the same string. The x that matter are the common prefixes of neighbours, at most REACH + 1 of them.
    """
    n = len(lefts)
    (left_order, left_step), (right_order, right_step) = neighbours(lefts), neighbours(rights)
    first = np.union1d(left_step[1:], REACH - right_step[1:])
    first = first[(first >= 0) & (first <= REACH)]
    left, right = np.full(n, -1), np.full(n, -1)
    left_run, right_run = np.empty(n, np.int64), np.empty(n, np.int64)
    left_size, right_size = np.array([len(x) for x in lefts]), np.array([len(x) for x in rights])
    for x in first.tolist():
        left_run[left_order] = np.cumsum(left_step < x)
        right_run[right_order] = np.cumsum(right_step < REACH - x)
        some = np.flatnonzero((left_size >= x) & (right_size >= REACH - x))
        key = left_run[some] * (n + 1) + right_run[some]
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(some), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        rows = some[twice]
        left[rows] = np.maximum(left[rows], x)
        right[rows] = np.maximum(right[rows], REACH - x)
    return left, right


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs covered by the spans."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def repeated_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", kept_text: bool = False) -> DataFrame:
    """Per row of ``docs``: key, n_bytes, spans (array of start, end in bytes: maximal removed runs), kept_sha256, kept_chars
    (code points that begin in the remaining bytes).

    Texts are UTF-8 bytes. A byte is removed if it lies in a string of LENGTH bytes that also starts elsewhere, in the
    same text or another, overlapping or not, all judged on the input. With ``kept_text`` the remaining bytes come as
    ``kept``. Null and short texts: nothing removed. Repeated rows and null keys are rows like others; copies of a text
    of LENGTH bytes or more lose all bytes in all rows. Extra columns are not read.

    1. All texts give their anchors with a hash of the context (two longs and a position an anchor, one anchor in 170
       bytes or so; those of one text that are alike and touch, as in runs of a short period, are one row). 2. Anchors whose context occurs twice cover it whole. 3. Of anchors with several contexts one
       occurrence a context is cut out, and the contexts of an anchor are compared: suffixes to the right and to the
       left are sorted, common prefixes follow from neighbours, in time linear in a large group. Only anchors with over
       BLOCK different contexts are cut into pairs of blocks.
    4. Covered spans meet the distinct texts again.
    """
    source = docs.select(
        F.col(key).alias("key"),
        F.col(text).alias("text"),
        F.xxhash64(text).alias("t1"),
        F.xxhash64(F.lit(1), text).alias("t2"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
    )
    long = source.filter(F.col("n_bytes") >= LENGTH)

    def find(batches):
        for batch, texts in text_batches(batches):
            data, starts = byte_table(texts)
            owner, place, value, context = anchors(data, starts)
            first, last, times = reduced(owner, place, value, context)
            texts_ = pa.array(owner[first])
            yield pa.RecordBatch.from_arrays(
                [batch.column("t1").take(texts_), batch.column("t2").take(texts_)]
                + [pa.array(place[first].astype(np.int32)), pa.array(value[first]), pa.array(context[first])]
                + [pa.array(last.astype(np.int32)), pa.array(times)],
                names=["t1", "t2", "place", "anchor", "context", "last", "times"],
            )

    schema = "t1 long, t2 long, place int, anchor long, context long, last int, times long"
    found = stored(map_arrow(long.select("text", "t1", "t2"), find, schema), "anchors")
    seen = found.groupBy("anchor", "context").agg(
        F.sum("times").alias("times"), F.min(F.struct("t1", "t2", "place")).alias("first")
    )
    seen = stored(seen, "contexts")
    twice = seen.filter("times > 1").select(F.col("anchor").alias("__a"), F.col("context").alias("__c"))
    whole = found.join(twice, (found.anchor == twice["__a"]) & (found.context == twice["__c"]))
    whole = whole.select("t1", "t2", (F.col("place") - REACH).alias("begin"), (F.col("last") + LENGTH).alias("end")).distinct()

    several = in_blocks(seen, ["anchor"], F.xxhash64("context"), BLOCK)
    wanted = several.groupBy("first.t1", "first.t2").agg(
        F.collect_list(F.struct("first.place", "anchor", "lo", "hi", "times")).alias("wanted")
    )
    texts = long.groupBy("t1", "t2").agg(F.first("text").alias("text"))
    names = ["anchor", "lo", "hi", "times", "t1", "t2", "place", "left", "right"]
    kinds = [pa.int64(), pa.int32(), pa.int32(), *[pa.int64()] * 3, pa.int32(), pa.binary(), pa.binary()]

    def cut(batches):
        for batch in batches:
            out = [[] for _ in names]
            for t1, t2, t, want in zip(*(batch.column(c).to_pylist() for c in ("t1", "t2", "text", "wanted"))):
                raw = t.encode("utf-8", "replace")
                for w in want:
                    p = w["place"]
                    row = (*(w[c] for c in names[:4]), t1, t2, p, raw[max(0, p - REACH) : p][::-1], raw[p + ANCHOR : p + LENGTH])
                    for column, x in zip(out, row):
                        column.append(x)
                if len(out[0]) > 5000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=names)
                    out = [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=names)

    cuts = map_arrow(
        texts.join(wanted, ["t1", "t2"]).select("t1", "t2", "text", "wanted"),
        cut,
        "anchor long, lo int, hi int, times long, t1 long, t2 long, place int, left binary, right binary",
    )
    met = grouped(cuts, ["anchor", "lo", "hi"])

    def compare(batches):
        for table in runs(batches, ["anchor", "lo", "hi"]):
            bounds = starts_of(table, ["anchor", "lo", "hi"])
            columns = {c: table.column(c).to_pylist() for c in ("left", "right")}
            left, right = np.full(table.num_rows, -1), np.full(table.num_rows, -1)
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                if b - a > 1:
                    left[a:b], right[a:b] = reaches(columns["left"][a:b], columns["right"][a:b])
            place = table.column("place").to_numpy()
            use = np.flatnonzero((left >= 0) & (table.column("times").to_numpy() == 1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(table.column(c).to_numpy()[use]) for c in ("t1", "t2")]
                + [pa.array((place - left)[use].astype(np.int32)), pa.array((place + ANCHOR + right)[use].astype(np.int32))],
                names=["t1", "t2", "begin", "end"],
            )

    part = map_arrow(met, compare, "t1 long, t2 long, begin int, end int")
    spans = whole.union(part).groupBy("t1", "t2").agg(F.collect_list(F.struct("begin", "end")).alias("spans"))

    def remove(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part_ = batch.slice(at, 500)
                cuts_, shas, sizes, kept = [], [], [], []
                for t, raw_spans in zip(part_.column("text").to_pylist(), part_.column("spans").to_pylist()):
                    raw = t.encode("utf-8", "replace")
                    got = merged([(max(0, s["begin"]), min(len(raw), s["end"])) for s in raw_spans])
                    ends = [0] + [b for _, b in got]
                    rest = b"".join(raw[b:a] for b, (a, _) in zip(ends, got)) + raw[ends[-1] :]
                    cuts_.append([{"start": a, "end": b} for a, b in got])
                    shas.append(hashlib.sha256(rest).hexdigest())
                    sizes.append(int(((np.frombuffer(rest, np.uint8) & 0xC0) != 0x80).sum()))
                    kept.append(rest if kept_text else None)
                yield pa.RecordBatch.from_arrays(
                    [part_.column("t1"), part_.column("t2"), pa.array(cuts_, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))]
                    + [pa.array(shas), pa.array(sizes, pa.int64()), pa.array(kept, pa.binary())],
                    names=["t1", "t2", "spans", "sha", "chars", "kept"],
                )

    done = map_arrow(
        texts.join(spans, ["t1", "t2"]).select("t1", "t2", "text", "spans"),
        remove,
        "t1 long, t2 long, spans array<struct<start:int,end:int>>, sha string, chars long, kept binary",
    )
    done = done.withColumnsRenamed({"t1": "__t1", "t2": "__t2"})
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    whole_chars = F.char_length(F.coalesce(F.col("text"), F.lit(""))).cast("long").alias("own_chars")
    rows = source.select("key", "t1", "t2", "n_bytes", F.sha2(raw, 256).alias("own"), whole_chars, *([raw.alias("raw")] if kept_text else []))
    out = rows.join(done, (F.col("t1") == F.col("__t1")) & (F.col("t2") == F.col("__t2")), "left")
    return out.select(
        F.col("key").alias(key),
        "n_bytes",
        F.coalesce("spans", F.array().cast("array<struct<start:int,end:int>>")).alias("spans"),
        F.coalesce("sha", "own").alias("kept_sha256"),
        F.coalesce("chars", "own_chars").alias("kept_chars"),
        *([F.coalesce("kept", "raw").alias("kept")] if kept_text else []),
    )
