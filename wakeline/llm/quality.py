"""Quality classifier without labels: heuristic voters, their accuracies by expectation-maximisation, a hashed scorer."""

from __future__ import annotations

import base64
import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wakeline.llm.common import Prefixes, byte_table, map_arrow, mixed, stored, text_batches

#: Rows that the scorer is fitted on, about so many, drawn by hash from all rows.
SAMPLE = 4000
#: Size of the scorer's hashed feature space.
DIMS = 2048
#: Documents with a lower probability of being fine are rejected.
THRESHOLD = 0.5
#: Most common function words of the languages the voters know (fixed values).
FUNCTION_WORDS = (
    "the of and to in a is that for it as with be by on are was this from or an at not have "
    "de la le et les des en un une du que qui dans est pour pas sur par au avec "
    "der die und das den von mit ist ein eine nicht auf zu im für als dem sich auch "
    "el los las y del se por con una su para es al lo como más no"
).split()
#: Voters: statistic, where it votes junk, where it votes fine (ranges, ends included), least number of words.
VOTERS = (
    ("symbols", (0.08, 1.0), (0.0, 0.04), 1),
    ("upper", (0.6, 1.0), (0.0, 0.3), 3),
    ("fresh_triples", (0.0, 0.6), (0.85, 1.0), 12),
    ("variety", (0.0, 1.6), (3.5, 1e9), 20),
    ("bare_words", (0.1, 1.0), (0.0, 0.03), 14),
    ("double_marks", (0.2, 1e9), (0.0, 0.03), 3),
    ("sentence", (90.0, 1e9), (1.5, 60.0), 8),
    ("function_words", (0.0, 0.02), (0.08, 0.7), 20),
    ("same_again", (0.2, 1.0), (0.0, 0.05), 10),
)
#: Edges of the bins that make a statistic a feature of the scorer.
BINS = {
    "symbols": (0.01, 0.03, 0.06, 0.09, 0.12, 0.2, 0.3),
    "upper": (0.05, 0.15, 0.3, 0.45, 0.6, 0.8),
    "fresh_triples": (0.2, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.97),
    "variety": (1.0, 1.6, 2.5, 3.5, 5.0, 8.0),
    "bare_words": (0.01, 0.05, 0.1, 0.15, 0.3),
    "double_marks": (0.01, 0.05, 0.1, 0.2, 0.5),
    "sentence": (1.5, 3.0, 6.0, 12.0, 25.0, 60.0, 90.0),
    "function_words": (0.01, 0.03, 0.06, 0.1, 0.2, 0.4, 0.7),
    "same_again": (0.005, 0.02, 0.05, 0.1, 0.3),
    "words": (2.0, 6.0, 15.0, 40.0, 150.0, 1000.0),
}
_U = np.uint64


def _class_tables() -> dict[str, np.ndarray]:
    byte = np.arange(256)
    letter = ((byte >= 65) & (byte <= 90)) | ((byte >= 97) & (byte <= 122)) | (byte >= 0xC0)
    digit = (byte >= 48) & (byte <= 57)
    white = byte <= 32
    plain = np.isin(byte, [ord(c) for c in ".,'\"-;:!?()"])
    follow = (byte >= 0x80) & (byte < 0xC0)
    return {
        "white": white,
        "ascii": letter & (byte < 128),
        "upper": (byte >= 65) & (byte <= 90),
        "solid": ~white & ~follow,
        "symbol": ~(letter | digit | white | plain | follow),
        "mark": ~(letter | digit | white | follow),
        "alnum": letter | digit,
        "stop": np.isin(byte, [ord(c) for c in ".!?"]),
        "lower": np.where((byte >= 65) & (byte <= 90), byte + 32, byte).astype(np.uint8),
    }


_T = _class_tables()


def _distinct(owner: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    """Distinct values of each owner."""
    key = np.sort(mixed(value + owner.astype(np.uint64) * _U(0x9E3779B97F4A7C15)) >> _U(20) | (owner.astype(np.uint64) << _U(44)))
    fresh = np.ones(len(key), bool)
    fresh[1:] = key[1:] != key[:-1]
    return np.bincount((key[fresh] >> _U(44)).astype(np.int64), minlength=n)[:n]


def _function_hashes() -> np.ndarray:
    data, starts = byte_table(list(FUNCTION_WORDS))
    return np.sort(Prefixes(data).of(starts[:-1], starts[1:] - 1))


def statistics(data: np.ndarray, starts: np.ndarray) -> dict[str, np.ndarray]:
    """The voters' statistics of each text, and its number of words."""
    n = len(starts) - 1
    begin = starts[:-1]
    count = lambda name: np.add.reduceat(_T[name][data], begin, dtype=np.int64)
    white = _T["white"][data]
    first = ~white
    first[1:] &= white[:-1]
    at = np.flatnonzero(first)
    last = ~white
    last[:-1] &= white[1:]
    end = np.flatnonzero(last) + 1
    owner = np.searchsorted(starts, at, side="right") - 1
    words = np.bincount(owner, minlength=n)
    value = Prefixes(_T["lower"][data]).of(at, end)
    some = np.maximum(words, 1)
    joined = (owner[2:] == owner[:-2]) if len(owner) > 2 else np.zeros(0, bool)
    triple = (value[:-2] * _U(3) + value[1:-1] * _U(5) + value[2:] * _U(7))[joined] if len(owner) > 2 else value[:0]
    triple_owner = owner[:-2][joined] if len(owner) > 2 else owner[:0]
    again = np.flatnonzero((value[1:] == value[:-1]) & (owner[1:] == owner[:-1])) + 1
    named = np.concatenate([[0], np.cumsum(_T["alnum"][data], dtype=np.int64)])
    bare = named[end] == named[at]
    mark = _T["mark"][data]
    double = np.zeros(len(data), bool)
    double[1:] = mark[1:] & (data[1:] == data[:-1])
    known = _function_hashes()
    place = np.minimum(np.searchsorted(known, value), len(known) - 1)
    triples = words - 2
    return {
        "symbols": count("symbol") / np.maximum(count("solid"), 1),
        "upper": count("upper") / np.maximum(count("ascii"), 1),
        "fresh_triples": np.where(triples > 0, _distinct(triple_owner, triple, n) / np.maximum(triples, 1), 1.0),
        "variety": _distinct(owner, value, n) / np.sqrt(some),
        "bare_words": np.bincount(owner, bare, minlength=n) / some,
        "double_marks": np.add.reduceat(double, begin, dtype=np.int64) / some,
        "sentence": words / np.maximum(count("stop"), 1),
        "function_words": np.bincount(owner, known[place] == value, minlength=n) / some,
        "same_again": np.bincount(owner[again], minlength=n) / some,
        "words": words.astype(float),
    }


def votes(stats: dict[str, np.ndarray]) -> np.ndarray:
    """(texts, voters): 0 abstains, 1 junk, 2 fine."""
    out = np.zeros((len(stats["words"]), len(VOTERS)), np.int8)
    for k, (name, junk, fine, least) in enumerate(VOTERS):
        x, enough = stats[name], stats["words"] >= least
        out[enough & (x >= fine[0]) & (x <= fine[1]), k] = 2
        out[enough & (x >= junk[0]) & (x <= junk[1]), k] = 1
    return out


def accuracies(patterns: np.ndarray, weight: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, float]:
    """(posterior of junk for each pattern of votes, share of junk), by expectation-maximisation.

    Voters err independently given the class; each has its own chance of voting junk in either class, if it votes at
    all; abstaining says nothing. A voter knows one kind of junk, so a text starts as junk if two voters say so, as
    doubtful if one does; from there the votes alone decide.
    """
    junk, fine = (patterns == 1).astype(float), (patterns == 2).astype(float)
    posterior = np.select([junk.sum(1) >= 2, junk.sum(1) == 1], [0.95, 0.3], 0.02)
    share = 0.1
    for _ in range(rounds):
        chance = np.empty((2, patterns.shape[1]))  # class (0 fine, 1 junk), voter: votes junk
        for c, p in ((0, (1 - posterior) * weight), (1, posterior * weight)):
            chance[c] = (p @ junk + 0.1) / (p @ (junk + fine) + 1.0)
        chance[1] = np.maximum(chance[1], chance[0])  # no voter is worse than none
        share = float(np.clip((posterior * weight).sum() / max(weight.sum(), 1e-9), 0.001, 0.5))
        log = junk @ np.log(chance).T + fine @ np.log(1 - chance).T + np.log([1 - share, share])
        new = 1 / (1 + np.exp(np.clip(log[:, 0] - log[:, 1], -500, 500)))
        done = np.abs(new - posterior).max(initial=0) < 1e-9
        posterior = new
        if done:
            break
    return posterior, share


def _trigrams(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of the three bytes at each place, places of which all three lie in one text)."""
    b = data.astype(np.uint32)
    b[_T["alnum"][data] & (data >= 48) & (data <= 57)] = 48
    code = np.zeros(len(b), np.uint32)
    code[:-2] = (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]
    bucket = (code * np.uint32(0x9E3779B1)) >> np.uint32(32 - int(np.log2(DIMS)))
    inside = np.ones(len(b), bool)
    for back in (1, 2, 3):
        inside[np.maximum(starts[1:] - back, starts[:-1])] = False
    return bucket, inside


def _bin_buckets(stats: dict[str, np.ndarray]) -> np.ndarray:
    """(texts, statistics): hashed feature of each statistic's bin."""
    out = []
    for k, (name, edges) in enumerate(BINS.items()):
        bin_ = np.searchsorted(edges, stats[name], side="right").astype(np.uint64)
        out.append(mixed(bin_ + _U(1000 * (k + 1))) % _U(DIMS))
    return np.stack(out, 1).astype(np.int64)


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(votes, hashed features (texts, DIMS), words) of texts: shares of byte trigrams, and bins of statistics."""
    data, starts = byte_table(texts)
    stats = statistics(data, starts)
    bucket, inside = _trigrams(data, starts)
    owner = np.repeat(np.arange(len(texts)), np.diff(starts))
    flat = np.bincount(owner[inside] * DIMS + bucket[inside], minlength=len(texts) * DIMS)
    x = flat.reshape(len(texts), DIMS).astype(np.float32)
    x /= np.maximum(x.sum(1, keepdims=True), 1)
    np.add.at(x, (np.arange(len(texts))[:, None], _bin_buckets(stats)), 1.0)
    return votes(stats), x, stats["words"]


def scores(texts: list[str], weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(probability of being fine, votes, words) of texts."""
    data, starts = byte_table(texts)
    stats = statistics(data, starts)
    bucket, inside = _trigrams(data, starts)
    part = np.where(inside, weights[:-1].astype(np.float32)[bucket], np.float32(0))
    total = np.add.reduceat(part, starts[:-1], dtype=np.float64)
    number = np.add.reduceat(inside, starts[:-1], dtype=np.int64)
    z = total / np.maximum(number, 1) + weights[:-1][_bin_buckets(stats)].sum(1) + weights[-1]
    return 1 / (1 + np.exp(-np.clip(z, -60, 60))), votes(stats), stats["words"]


def fit_scorer(x: np.ndarray, fine: np.ndarray, rounds: int = 300, rate: float = 0.5, ridge: float = 1e-4) -> np.ndarray:
    """Logistic regression on soft labels by full-batch Adam; the last weight is the constant. Both classes weigh alike."""
    n = len(x)
    w, m, v = np.zeros(DIMS + 1), np.zeros(DIMS + 1), np.zeros(DIMS + 1)
    if not n:
        w[-1] = 1.0
        return w
    weight = fine * 0.5 / max(fine.mean(), 0.02) + (1 - fine) * 0.5 / max(1 - fine.mean(), 0.02)
    for t in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ w[:-1].astype(np.float32) + w[-1], -60, 60)))
        g = weight * (p - fine) / n
        grad = np.append(x.T @ g.astype(np.float32), g.sum())
        grad[:-1] += ridge * w[:-1]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        w -= rate / t**0.5 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def _coded(votes_: np.ndarray) -> np.ndarray:
    return votes_.astype(np.int64) @ 3 ** np.arange(len(VOTERS))


def _decoded(code: np.ndarray) -> np.ndarray:
    return code[:, None] // 3 ** np.arange(len(VOTERS)) % 3


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> str:
    """The model as JSON text: posterior of each pattern of votes seen, and the scorer's weights.

    The voters vote on all rows; only the counts of their patterns (3^9 at most) come to the driver. The scorer is fitted
    on about ``sample`` rows, drawn by a hash of key and text, with their patterns' posteriors as labels.
    """
    source = docs.select(F.xxhash64(F.lit(3), key, text).alias("hash"), F.col(text).alias("text"))

    def vote(batches):
        for batch, texts in text_batches(batches):
            data, starts = byte_table(texts)
            code, count = np.unique(_coded(votes(statistics(data, starts))), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(count)], names=["code", "n"])

    seen = map_arrow(source.select("text"), vote, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    seen = seen.orderBy("code").toPandas()
    if not len(seen):
        return json.dumps({"posterior": {}, "weights": base64.b64encode(np.append(np.zeros(DIMS), 1.0).tobytes()).decode()})
    posterior, _ = accuracies(_decoded(seen["code"].to_numpy()), seen["n"].to_numpy().astype(float))
    junk = dict(zip(seen["code"].tolist(), posterior.tolist()))
    total = int(seen["n"].sum())

    def describe(batches):
        for batch, texts in text_batches(batches):
            for i in range(0, len(texts), 500):
                v, x, _ = features(texts[i : i + 500])
                columns = [
                    batch.column("hash")[i : i + 500],
                    pa.array(_coded(v)),
                    pa.array([r.tobytes() for r in x.astype(np.float16)], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["hash", "code", "x"])

    drawn = source.filter(F.pmod("hash", F.lit(max(total, 1))) < sample)
    drawn = stored(map_arrow(drawn, describe, "hash long, code long, x binary"), "drawn").orderBy("hash", "code").toArrow()
    x = np.frombuffer(b"".join(drawn.column("x").to_pylist()), np.float16).reshape(-1, DIMS).astype(np.float32)
    fine = 1 - np.array([junk[c] for c in drawn.column("code").to_pylist()])
    weights = fit_scorer(x, fine)
    return json.dumps({"posterior": junk, "weights": base64.b64encode(weights.tobytes()).decode()})


def classify(docs: DataFrame, model: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns of ``docs`` plus score (probability of being fine), junk_posterior, votes and accepted.

    ``votes`` lists the voters that voted, as name=junk or name=fine. Texts without a word (null, empty, blank) get
    score 0 and are rejected. Whole texts are read; rows are independent; repeated rows get the same result.
    """
    source = docs.select(*[F.col(c).alias(f"__{i}") for i, c in enumerate(keep)], F.col(text).alias("text"))
    schema = source.drop("text").schema
    for name, kind in (("score", "double"), ("junk_posterior", "double"), ("votes", "string"), ("accepted", "boolean")):
        schema = schema.add(name, kind)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches):
        held = json.loads(sent.value)
        weights = np.frombuffer(base64.b64decode(held["weights"]))
        junk = {int(k): v for k, v in held["posterior"].items()}
        said = {}
        for batch, texts in text_batches(batches):
            score, voted, words = scores(texts, weights)
            score = np.where(words > 0, score, 0.0)
            code = _coded(voted).tolist()
            for c in set(code) - set(said):
                row = _decoded(np.array([c]))[0]
                said[c] = ",".join(f"{v[0]}={('', 'junk', 'fine')[x]}" for v, x in zip(VOTERS, row) if x)
            columns = [
                *(batch.column(i) for i in range(len(keep))),
                pa.array(score),
                pa.array([junk.get(c) for c in code], pa.float64()),
                pa.array([said[c] for c in code]),
                pa.array(score >= THRESHOLD),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    out = map_arrow(source, work, schema)
    return out.select(*[F.col(f"__{i}").alias(c) for i, c in enumerate(keep)], "score", "junk_posterior", "votes", "accepted")


def accept(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the rows that the classifier, fitted on ``docs`` itself, rejects."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, key, text))
    schema = docs.schema

    def work(batches):
        weights = np.frombuffer(base64.b64decode(json.loads(model.value)["weights"]))
        for batch, texts in text_batches(batches, text):
            score, _, words = scores(texts, weights)
            yield batch.filter(pa.array((score >= THRESHOLD) & (words > 0)))

    return map_arrow(docs, work, schema)
