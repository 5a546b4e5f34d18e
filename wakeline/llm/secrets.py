"""Secrets in texts: fixed patterns, and windows of high entropy per character class."""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from wakeline.llm.common import map_arrow, text_batches

# Fixed patterns. A match is a secret from so many characters on (of its group, if one is named).
ASSIGN = re.compile(
    r"(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
    r"|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ASSIGN_LEAST = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
BASE_KINDS = ("assign", "access", "hex")

#: Entropy kinds: characters of the class, window, least bits per character in a window.
CLASSES = {
    "entropy_hex": (re.compile(r"[0-9A-Fa-f]{20,}"), 20, 3.0),
    "entropy_upper": (re.compile(r"[A-Z0-9]{20,}"), 20, 3.4),
    "entropy_mixed": (re.compile(r"[A-Za-z0-9+/_-]{24,}={0,2}"), 24, 3.9),
}
KINDS = (*BASE_KINDS, *CLASSES)

#: Candidates that may hold harmless parts; what exactly is harmless in them says ``harmless``.
ALLOWED = (
    re.compile(r"[^0-9]*"),  # words: no digit
    re.compile(r"[0-9]*"),  # numbers
    re.compile(r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}"),  # UUIDs
    re.compile(r"(?:[A-Za-z]+[_/-])+[A-Za-z0-9]{0,8}"),  # paths and names in parts
    re.compile(r".*(?:EXAMPLE|example|XXXXXX|xxxxxx|000000|123456789|abcdefgh).*"),  # placeholders, sequences
)
PART = re.compile(r"[A-Za-z0-9]+")
HUMP = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
NUMBER = re.compile(r"v?[0-9]+")
PLACEHOLDER = re.compile(r"EXAMPLE|example")
REPEAT = re.compile(r"([A-Za-z0-9])\1{5,}")
#: Characters that go up one by one from which a stretch is a sequence; a letter may follow 9.
SEQUENCE = 6


def is_word(part: str, width: int) -> bool:
    """Letters that are cased like words: humps of three or more (the first may be shorter), four on average.

    A hump as long as a window is left to its entropy.
    """
    if not part.isalpha():
        return False
    humps = [len(h) for h in HUMP.findall(part)]
    if len(part) <= 3:
        return True
    return max(humps) < width and min(humps[1:], default=3) >= 3 and len(part) >= 4 * len(humps) - 3


def harmless(s: str, width: int) -> bytearray:
    """A flag for every character of a candidate: 1 where a harmless part covers it.

    Parts end at / _ - + =. Harmless are separators, words, numbers, a whole UUID, an end of up to 8 characters behind a
    word, repeats of a character, sequences, and a part named example unless what else is in it is as long as a window.
    Candidates that match nothing of ALLOWED have no harmless part.
    """
    flags = bytearray(len(s))
    if not any(p.fullmatch(s) for p in ALLOWED):
        return flags
    if ALLOWED[1].fullmatch(s) or ALLOWED[2].fullmatch(s):
        return bytearray(b"\1" * len(s))
    spans, at, after_word = [], 0, False
    for m in PART.finditer(s):
        spans.append((at, m.start()))
        at = m.end()
        word = is_word(m[0], width)
        if word or NUMBER.fullmatch(m[0]) or (after_word and at - m.start() <= 8 and not s[at:].strip("=")):
            spans.append(m.span())
        for x in PLACEHOLDER.finditer(m[0]):
            short = x.start() < width and len(m[0]) - x.end() < width
            spans.append(m.span() if short else (m.start() + x.start(), m.start() + x.end()))
        after_word = word
    spans.append((at, len(s)))
    spans += [m.span() for m in REPEAT.finditer(s)]
    begin = 0
    for i in range(1, len(s) + 1):
        if i < len(s) and (ord(s[i]) == ord(s[i - 1]) + 1 or s[i - 1] == "9" and s[i] in "aA"):
            continue
        if i - begin >= SEQUENCE:
            spans.append((begin, i))
        begin = i
    for x, y in spans:
        flags[x:y] = b"\1" * (y - x)
    return flags


def entropy_windows(s: str, width: int, least: float, harmless: bytes = b"") -> Iterator[tuple[int, int]]:
    """Unions of the windows of ``width`` characters whose Shannon entropy is ``least`` or more.

    Windows of which every character is flagged in ``harmless`` don't count.

    H = log2(w) - sum(c * log2(c)) / w; a step changes two counts, so it costs the same at any width.
    """
    weight = [c * math.log2(c) if c else 0.0 for c in range(width + 2)]  # one more: counts fall after they rise
    counts: dict[str, int] = {}
    total, begin, end, free = 0.0, -1, -1, -1 if harmless else len(s)
    for i, c in enumerate(s):
        if harmless and not harmless[i]:
            free = i
        n = counts.get(c, 0)
        counts[c] = n + 1
        total += weight[n + 1] - weight[n]
        if i >= width:
            c = s[i - width]
            n = counts[c]
            counts[c] = n - 1
            total += weight[n - 1] - weight[n]
        if i >= width - 1 and free > i - width and math.log2(width) - total / width >= least - 1e-9:
            at = i - width + 1
            if begin >= 0 and at > end:
                yield begin, end
                begin = at
            elif begin < 0:
                begin = at
            end = i + 1
    if begin >= 0:
        yield begin, end


def find_secrets(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of all secrets of a text, by start, then kind."""
    found = []
    if ":" in text or "=" in text:
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text)]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    base = [(a, b) for _, a, b in found]
    for kind, (pattern, width, least) in CLASSES.items():
        for m in pattern.finditer(text):
            for a, b in entropy_windows(m[0], width, least, harmless(m[0], width)):
                a, b = a + m.start(), b + m.start()
                if not any(x <= a and b <= y for x, y in base):
                    found.append((kind, a, b))
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def scan(docs: DataFrame, text: str = "text", out: str = "secrets") -> DataFrame:
    """``docs`` without its text, plus ``out``: array of (kind, start, end), code points, end exclusive.

    Base kinds: assignments to password-like names, access keys, long hex strings; leftmost matches that don't overlap
    within a kind. Entropy kinds add windows that are not inside a base span, nor covered by harmless parts.
    Whole texts are read. Null or empty text: an empty array. A column named like ``out`` is replaced.
    """
    others = [c for c in docs.columns if c not in (text, out)]
    source = docs.select(*others, text)
    schema = "array<struct<kind:string,start:int,end:int>>"
    full = docs.select(*others, F.lit(None).cast(schema).alias(out)).schema
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def work(batches):
        for batch, texts in text_batches(batches, text):
            spans = [[{"kind": k, "start": a, "end": b} for k, a, b in find_secrets(t)] for t in texts]
            columns = [*(batch.column(c) for c in others), pa.array(spans, kind)]
            yield pa.RecordBatch.from_arrays(columns, names=[*others, out])

    return map_arrow(source, work, full)


def listed(spans: Column) -> Column:
    """kind:start:end of spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def of_kind(*kinds: str) -> Callable[[Column], Column]:
    """Whether a span is of one of the kinds."""
    return lambda span: span["kind"].isin(*kinds)


def redact(docs: DataFrame, text: str = "text", mark: str = "[secret]") -> DataFrame:
    """``docs`` with every secret replaced by ``mark``; overlapping spans are replaced as one. Null stays null.

    ``n_chars``, if there is such a column, becomes the new length where anything was replaced.
    """
    names = docs.columns

    def work(batches):
        for batch, texts in text_batches(batches, text):
            new, length = [], []
            for old, t in zip(batch.column(text).to_pylist(), texts):
                out, at, end = [], 0, -1
                for _, a, b in find_secrets(t):
                    if a >= end:
                        out += [t[at:a], mark]
                    end = max(end, b)
                    at = end
                new.append("".join([*out, t[at:]]) if out else old)
                length.append(len(new[-1]) if out else None)
            columns = []
            for c in names:
                if c == text:
                    columns.append(pa.array(new, batch.column(c).type))
                elif c == "n_chars":
                    kept = batch.column(c).to_pylist()
                    columns.append(pa.array([k if n is None else n for k, n in zip(kept, length)], batch.column(c).type))
                else:
                    columns.append(batch.column(c))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return map_arrow(docs, work, docs.schema)
