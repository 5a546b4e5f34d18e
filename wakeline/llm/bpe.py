"""Byte-level BPE: boundaries by a scan of transition functions, merges of cached slices, decoding by offsets."""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
import unicodedata
from array import array
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from wakeline.llm.common import map_arrow, text_batches

# Fixed values of the pre-tokenising pattern
#   's|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+
SHORT_ENDINGS = ("s", "t", "m", "d")
LONG_ENDINGS = ("re", "ve", "ll")
WHITE = (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)

# Symbols: a character's class, with what follows folded in.
OTHER, LETTER, NUMBER, SPACE_IN_RUN, LAST_SPACE, JOINED_SPACE, SHORT_MARK, LONG_MARK, END = range(9)
# States: what the scan is inside of.
FRESH, IN_LETTERS, IN_NUMBERS, IN_OTHER, IN_SPACE, AFTER_JOINED, ONE_MORE, TWO_MORE = range(8)
STATES = 8
#: Characters that one row of the scan composes before rows are composed with each other.
WIDTH = 32
#: Recent slices kept with their ids by each worker (as many older ones stay too), and the longest slice kept.
CACHE, CACHED_BYTES = 120_000, 64
NO_RANK = 1 << 40


@functools.cache
def classes() -> np.ndarray:
    """Class of every code point: other, letter, number or white space (as SPACE_IN_RUN)."""
    table = np.zeros(0x110000, np.uint8)
    for point in range(0x110000):
        kind = unicodedata.category(chr(point))[0]
        if kind == "L":
            table[point] = LETTER
        elif kind == "N":
            table[point] = NUMBER
    table[list(WHITE)] = SPACE_IN_RUN
    return table


@functools.cache
def automaton() -> tuple[np.ndarray, np.ndarray]:
    """(next state, whether a slice starts here), both indexed by symbol * STATES + state."""
    step, starts = np.zeros((9, STATES), np.uint8), np.ones((9, STATES), bool)
    for symbol, inside in ((LETTER, IN_LETTERS), (NUMBER, IN_NUMBERS), (OTHER, IN_OTHER)):
        step[symbol] = inside
        starts[symbol, [inside, AFTER_JOINED]] = False
    step[LETTER, ONE_MORE], step[LETTER, TWO_MORE] = FRESH, ONE_MORE
    starts[LETTER, [ONE_MORE, TWO_MORE]] = False
    for symbol, more in ((SHORT_MARK, ONE_MORE), (LONG_MARK, TWO_MORE)):
        step[symbol] = more
        step[symbol, [IN_OTHER, AFTER_JOINED]] = IN_OTHER
        starts[symbol, [IN_OTHER, AFTER_JOINED]] = False
    step[SPACE_IN_RUN] = IN_SPACE
    starts[SPACE_IN_RUN, IN_SPACE] = False
    step[LAST_SPACE], step[JOINED_SPACE], step[END] = FRESH, AFTER_JOINED, FRESH
    return step.ravel(), starts.ravel()


def symbols(points: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Symbols of code points; ``ends`` are the places of the separators that close each text."""
    kind = classes()[points]
    kind[ends] = END
    white = kind == SPACE_IN_RUN
    solid = ~white
    solid[ends] = False
    last = np.zeros(len(kind), bool)
    last[:-1] = white[:-1] & solid[1:]
    out = kind.copy()
    out[last] = LAST_SPACE
    out[last & (points == 0x20)] = JOINED_SPACE
    mark = np.flatnonzero((points == 0x27) & (kind == OTHER))
    if len(mark):
        padded = np.concatenate([np.where(kind == END, 0, points), [0, 0]])
        one, two = padded[mark + 1], padded[mark + 2]
        out[mark[np.isin(one, [ord(c) for c in SHORT_ENDINGS])]] = SHORT_MARK
        long = np.zeros(len(mark), bool)
        for a, b in LONG_ENDINGS:
            long |= (one == ord(a)) & (two == ord(b))
        out[mark[long]] = LONG_MARK
    return out


def entry_states(functions: np.ndarray) -> np.ndarray:
    """State before each of n transition functions (n, STATES), the first entered FRESH.

    Functions compose associatively, so blocks of WIDTH are composed side by side, the blocks' compositions are scanned
    the same way, and the states go back down.
    """
    n = len(functions)
    if n <= WIDTH:
        out, state = np.zeros(n, np.uint8), FRESH
        for i in range(n):
            out[i] = state
            state = functions[i, state]
        return out
    rows = -(-n // WIDTH)
    padded = np.zeros((rows * WIDTH, STATES), np.uint8)
    padded[:n] = functions
    padded = padded.reshape(rows, WIDTH, STATES)
    whole = np.tile(np.arange(STATES, dtype=np.uint8), (rows, 1))
    for i in range(WIDTH):
        whole = np.take_along_axis(padded[:, i], whole, 1)
    state = entry_states(whole)
    out = np.zeros((rows, WIDTH), np.uint8)
    for i in range(WIDTH):
        out[:, i] = state
        state = padded[np.arange(rows), i, state]
    return out.ravel()[:n]


def boundaries(symbol: np.ndarray) -> np.ndarray:
    """Places where slices start."""
    step, starts = automaton()
    n = len(symbol)
    rows = -(-n // WIDTH)
    grid = np.full(rows * WIDTH, END, np.uint8)
    grid[:n] = symbol
    grid = np.ascontiguousarray(grid.reshape(rows, WIDTH).T).astype(np.intp) * STATES
    whole = np.tile(np.arange(STATES, dtype=np.uint8), (rows, 1))
    for i in range(WIDTH):
        whole = step.take(grid[i][:, None] + whole)
    state = entry_states(whole)
    out = np.zeros((WIDTH, rows), bool)
    for i in range(WIDTH):
        at = grid[i] + state
        out[i] = starts.take(at)
        state = step.take(at)
    return np.flatnonzero(out.T.ravel()[:n])


def read_ranks(lines: bytes) -> dict[bytes, int]:
    """Ranks of a file with one base64 token and its rank a line."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines.splitlines()) if a}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one slice: the pair of least rank, leftmost first, is joined until none has a rank."""
    if piece in ranks:
        return [ranks[piece]]
    if len(piece) > 48:
        return merge_long(piece, ranks)
    parts = [piece[i : i + 1] for i in range(len(piece))]
    find = ranks.get
    rank = [find(piece[i : i + 2], NO_RANK) for i in range(len(piece) - 1)]
    while rank:
        best = min(rank)
        if best == NO_RANK:
            break
        at = rank.index(best)
        joined = parts[at] + parts[at + 1]
        parts[at : at + 2] = [joined]
        del rank[at]
        if at:
            rank[at - 1] = find(parts[at - 1] + joined, NO_RANK)
        if at < len(rank):
            rank[at] = find(joined + parts[at + 1], NO_RANK)
    return [ranks[p] for p in parts]


def merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """As ``merge``, with a heap of pairs over linked parts."""
    n = len(piece)
    stop, after, prior = list(range(1, n + 1)), list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    alive = [True] * n
    while heap:
        _, i, end = heapq.heappop(heap)
        j = after[i] if alive[i] else n
        if not alive[i] or j >= n or stop[j] != end:
            continue
        alive[j] = False
        stop[i], after[i] = end, after[j]
        if after[i] < n:
            prior[after[i]] = i
            if (r := ranks.get(piece[i : stop[after[i]]])) is not None:
                heapq.heappush(heap, (r, i, stop[after[i]]))
        if prior[i] >= 0 and (r := ranks.get(piece[prior[i] : end])) is not None:
            heapq.heappush(heap, (r, prior[i], end))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : stop[i]]])
        i = after[i]
    return out


class Slices(dict):
    """Ids of slices, merged on first sight. When full, what was not seen since the last time it was full goes."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.older = ranks, {}

    def __missing__(self, piece: str) -> tuple[int, ...]:
        ids = self.older.get(piece)
        if ids is None:
            raw = piece.encode("utf-8", "surrogatepass")
            ids = tuple(merge(raw, self.ranks))
            if len(raw) > CACHED_BYTES:
                return ids
        if len(self) >= CACHE:
            self.older = dict(self)
            self.clear()
        self[piece] = ids
        return ids


_KNOWN: dict[str, tuple[dict[bytes, int], list[bytes], Slices]] = {}


def vocabulary(lines: bytes) -> tuple[dict[bytes, int], list[bytes], Slices]:
    """(ranks, tokens by id, slices) of a rank file, made once by each worker."""
    name = hashlib.sha256(lines).hexdigest()
    if name not in _KNOWN:
        ranks = read_ranks(lines)
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        _KNOWN.clear()
        _KNOWN[name] = ranks, tokens, Slices(ranks)
    return _KNOWN[name]


def encode_texts(texts: list[str], lines: bytes) -> list[array]:
    """Ids of each text."""
    known = vocabulary(lines)[2]
    joined = "\n".join(texts) + "\n"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    starts = boundaries(symbols(points, ends))
    first = np.searchsorted(starts, ends + 1 - [len(t) + 1 for t in texts])
    closing = np.searchsorted(starts, ends)
    places = starts.tolist()
    find = known.__getitem__
    out = []
    for a, b in zip(first.tolist(), closing.tolist()):
        # places[b] is the separator's own slice, so it ends the last slice of the text.
        pieces = [joined[i:j] for i, j in zip(places[a:b], places[a + 1 : b + 1])]
        out.append(array("I", chain.from_iterable(map(find, pieces))))
    return out


def decode_ids(coded: list[array], lines: bytes) -> list[bytes]:
    """Bytes of each text's ids."""
    tokens = vocabulary(lines)[1]
    return [b"".join(map(tokens.__getitem__, ids)) for ids in coded]


def encode(
    docs: DataFrame, ranks_path: str, text: str = "text", ids: str = "ids", ends: str | None = "ends", decoded: str | None = None
) -> DataFrame:
    """``docs`` without its text, plus n_tokens, ``ids``, ``ends`` and ``decoded`` (none where the name is None).

    ``decoded`` holds the bytes that the ids give back, as ``decode`` would.

    ``ids`` holds the ids as little-endian unsigned 32-bit integers, ``ends`` the byte offset behind each token, packed
    alike; with both a token's bytes are found in the text and back. The rank file is read here and sent to workers;
    its size is that of the vocabulary. Null or empty text: no ids. Texts are encoded whole, a text of any length on its
    own if it is long; rows are independent, so repeated rows give repeated results. A column of ``docs`` named like a
    result is replaced.
    """
    with open(ranks_path, "rb") as f:
        lines = docs.sparkSession.sparkContext.broadcast(f.read())
    added = ["n_tokens", ids, *([ends] if ends else []), *([decoded] if decoded else [])]
    others = [c for c in docs.columns if c not in (text, *added)]
    schema = docs.select(*others).schema.add("n_tokens", "long").add(ids, "binary")
    if ends:
        schema = schema.add(ends, "binary")
    if decoded:
        schema = schema.add(decoded, "binary")
    source = docs.select(*others, text)

    def work(batches):
        for batch, texts in text_batches(batches, text):
            coded = encode_texts(texts, lines.value)
            columns = [batch.column(c) for c in others]
            columns.append(pa.array([len(c) for c in coded], pa.int64()))
            columns.append(pa.array([c.tobytes() for c in coded], pa.binary()))
            if ends:
                tokens = vocabulary(lines.value)[1]
                stops = (array("I", accumulate(len(tokens[i]) for i in c)).tobytes() for c in coded)
                columns.append(pa.array(list(stops), pa.binary()))
            if decoded:
                columns.append(pa.array(decode_ids(coded, lines.value), pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return map_arrow(source, work, schema)


def decode(coded: DataFrame, ranks_path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``coded`` without ``ids``, plus ``out``: the bytes of its tokens. No or null ids: no bytes."""
    with open(ranks_path, "rb") as f:
        lines = coded.sparkSession.sparkContext.broadcast(f.read())
    others = [c for c in coded.columns if c not in (ids, out)]
    schema = coded.select(*others).schema.add(out, "binary")

    def work(batches):
        for batch in batches:
            texts = decode_ids([array("I", raw or b"") for raw in batch.column(ids).to_pylist()], lines.value)
            columns = [*(batch.column(c) for c in others), pa.array(texts, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return map_arrow(coded.select(*others, ids), work, schema)
