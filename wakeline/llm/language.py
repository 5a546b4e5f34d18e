"""Language identification by a byte convolutional network over fixed-length windows."""

from __future__ import annotations

import base64
import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from wakeline.llm.common import map_arrow, stored, text_batches

#: Bytes of a window; windows follow each other without gaps, the last is padded with zeros.
WINDOW = 128
#: Filter widths, filters of each width, size of a byte's embedding.
WIDTHS, FILTERS, EMBED = (2, 3, 4, 5), 12, 8
#: Training documents of each language, and windows drawn from each: the bound of the fitted sample.
SAMPLE_DOCS, SAMPLE_WINDOWS = 600, 8
STEPS, BATCH, RATE = 500, 256, 0.004
#: Windows convolved at once.
STEP = 256
_LETTER = re.compile(r"[^\W\d_]")


def windows_of(text: str) -> np.ndarray:
    """(windows, WINDOW) bytes of the lower-cased text with white space runs as one space."""
    raw = " ".join(text.lower().split()).encode("utf-8", "replace")
    n = max(1, -(-len(raw) // WINDOW))
    return np.frombuffer(raw.ljust(n * WINDOW, b"\0"), np.uint8).reshape(n, WINDOW)


class Network:
    """Embedding, convolutions of several widths, maximum over the window, softmax. float32 throughout."""

    def __init__(self, langs: list[str], parts: dict[str, np.ndarray] | None = None, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.langs = langs
        hidden = len(WIDTHS) * FILTERS
        self.parts = parts or {
            "embed": rng.normal(0, 0.5, (256, EMBED)).astype(np.float32),
            **{f"conv{w}": rng.normal(0, (w * EMBED) ** -0.5, (w * EMBED, FILTERS)).astype(np.float32) for w in WIDTHS},
            "shift": np.zeros(hidden, np.float32),
            "out": rng.normal(0, hidden**-0.5, (hidden, len(langs))).astype(np.float32),
            "bias": np.zeros(len(langs), np.float32),
        }

    def dump(self) -> str:
        packed = {k: [v.shape, base64.b64encode(v.tobytes()).decode()] for k, v in self.parts.items()}
        return json.dumps({"langs": self.langs, "parts": packed})

    @staticmethod
    def load(text: str) -> Network:
        held = json.loads(text)
        parts = {k: np.frombuffer(base64.b64decode(v), np.float32).reshape(s) for k, (s, v) in held["parts"].items()}
        return Network(held["langs"], parts)

    def tables(self) -> dict[int, list[np.ndarray]]:
        """Each filter's response to single bytes and byte pairs, so that a convolution is a sum of looked-up rows."""
        out = {}
        for w in WIDTHS:
            kernel = self.parts[f"conv{w}"].reshape(w, EMBED, FILTERS)
            single = [self.parts["embed"] @ kernel[i] for i in range(w)]
            out[w] = [
                (single[i][:, None, :] + single[i + 1][None, :, :]).reshape(-1, FILTERS) if i + 1 < w else single[i]
                for i in range(0, w, 2)
            ]
        return out

    def predict(self, x: np.ndarray, tables: dict[int, list[np.ndarray]]) -> np.ndarray:
        """(windows, languages) probabilities."""
        out = np.empty((len(x), len(self.langs)), np.float32)
        for at in range(0, len(x), STEP):
            b = x[at : at + STEP].astype(np.int32)
            pair = b[:, :-1] * 256 + b[:, 1:]
            hidden = []
            for w in WIDTHS:
                n = WINDOW - w + 1
                total = None
                for i, table in zip(range(0, w, 2), tables[w]):
                    index = pair[:, i : i + n] if i + 1 < w else b[:, i : i + n]
                    part = table.take(index, axis=0)
                    total = part if total is None else np.add(total, part, out=total)
                hidden.append(total.max(1))
            h = np.maximum(np.concatenate(hidden, 1) + self.parts["shift"], 0)
            z = h @ self.parts["out"] + self.parts["bias"]
            z = np.exp(z - z.max(1, keepdims=True))
            out[at : at + STEP] = z / z.sum(1, keepdims=True)
        return out

    def gradients(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        p = self.parts
        n = len(x)
        e = p["embed"][x]  # (n, WINDOW, EMBED)
        tops, places, columns = [], [], []
        for w in WIDTHS:
            view = np.lib.stride_tricks.sliding_window_view(e, (w, EMBED), (1, 2)).reshape(n, WINDOW - w + 1, w * EMBED)
            r = view @ p[f"conv{w}"]
            place = r.argmax(1)
            tops.append(np.take_along_axis(r, place[:, None], 1)[:, 0])
            places.append(place)
            columns.append(view)
        a = np.concatenate(tops, 1) + p["shift"]
        h = np.maximum(a, 0)
        z = h @ p["out"] + p["bias"]
        z = np.exp(z - z.max(1, keepdims=True))
        z /= z.sum(1, keepdims=True)
        z[np.arange(n), y] -= 1
        z /= n
        grads = {"out": h.T @ z, "bias": z.sum(0), "embed": np.zeros_like(p["embed"])}
        da = (z @ p["out"].T) * (a > 0)
        grads["shift"] = da.sum(0)
        for k, w in enumerate(WIDTHS):
            d = da[:, k * FILTERS : (k + 1) * FILTERS]
            picked = columns[k][np.arange(n)[:, None], places[k]]  # (n, FILTERS, w * EMBED)
            grads[f"conv{w}"] = np.einsum("nf,nfc->cf", d, picked)
            back = (d[:, :, None] * p[f"conv{w}"].T[None]).reshape(n, FILTERS, w, EMBED)
            byte = x[np.arange(n)[:, None, None], places[k][:, :, None] + np.arange(w)]
            np.add.at(grads["embed"], byte.ravel(), back.reshape(-1, EMBED))
        return grads

    def train(self, x: np.ndarray, y: np.ndarray, seed: int = 7) -> None:
        """Adam over shuffled batches, as many whatever the size of the sample."""
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.parts.items()}
        second = {k: np.zeros_like(v) for k, v in self.parts.items()}
        order = np.zeros(0, np.int64)
        for t in range(1, STEPS + 1):
            if len(order) < BATCH:
                order = np.concatenate([order, rng.permutation(len(x))])
            i, order = order[:BATCH], order[BATCH:]
            for k, g in self.gradients(x[i], y[i]).items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                step = first[k] / (1 - 0.9**t) / (np.sqrt(second[k] / (1 - 0.999**t)) + 1e-8)
                self.parts[k] = (self.parts[k] - RATE * (1 - t / STEPS) * step).astype(np.float32)


def held_out(key: Column) -> Column:
    """Whether a document is kept from training: crc32 of its id as text, modulo 4, is 2 (a null id counts as empty text)."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> str:
    """The network as JSON text, trained on the texts and languages of rows that are not held out.

    The sample is SAMPLE_DOCS documents a language, least hash of key and text first, one of equal hash, whatever keys are
    null or repeated, and up to SAMPLE_WINDOWS of each document's windows, spread over the whole text: so much, times the
    number of languages, comes to the driver.
    Rows with null language or null text don't teach. No teaching row at all: a network without languages.
    """
    source = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    usable = source.filter(~held_out(F.col("key")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    usable = usable.withColumn("hash", F.xxhash64(F.lit(11), "key", "text"))
    order = Window.partitionBy("lang").orderBy("hash")
    ids = usable.select("lang", "hash").distinct().withColumn("rank", F.row_number().over(order))
    ids = stored(ids.filter(F.col("rank") <= SAMPLE_DOCS).drop("rank"), "taught")
    taught = usable.join(F.broadcast(ids), ["lang", "hash"]).dropDuplicates(["lang", "hash"]).select("key", "lang", "text")

    def cut(batches):
        for batch, texts in text_batches(batches):
            langs, rows = batch.column("lang").to_pylist(), []
            for t in texts:
                x = windows_of(t)
                x = x[np.unique(np.linspace(0, len(x) - 1, SAMPLE_WINDOWS).round().astype(int))] if _LETTER.search(t) else x[:0]
                rows.append(x.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(langs), pa.array(rows, pa.binary())], names=["key", "lang", "x"])

    schema = taught.select("key", "lang").schema.add("x", "binary")
    got = map_arrow(taught, cut, schema).orderBy("lang", "key", "x").toArrow()
    got = [(v, r) for v, r in zip(got.column("lang").to_pylist(), got.column("x").to_pylist()) if r]
    langs = sorted({v for v, _ in got})
    net = Network(langs or [])
    if langs:
        x = [np.frombuffer(r, np.uint8).reshape(-1, WINDOW) for _, r in got]
        y = np.repeat([langs.index(v) for v, _ in got], [len(r) for r in x])
        net.train(np.concatenate(x), y)
    return net.dump()


def identify(docs: DataFrame, model: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns of ``docs`` plus lang_pred and score.

    All windows of the whole text are classified; their probabilities are averaged (each window weighs by its bytes), the
    largest is the score. Null texts and texts without a letter get ``und`` and score 0, as does every text if the
    network knows no language. Equal averages: the first language by name.
    """
    source = docs.select(*[F.col(c).alias(f"__{i}") for i, c in enumerate(keep)], F.col(text).alias("text"))
    schema = source.drop("text").schema.add("lang_pred", "string").add("score", "double")
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches):
        net = Network.load(sent.value)
        tables = net.tables()
        for batch, texts in text_batches(batches):
            langs, score = ["und"] * len(texts), np.zeros(len(texts))
            use = [i for i, t in enumerate(texts) if net.langs and _LETTER.search(t)]
            for at in range(0, len(use), 64):
                part = use[at : at + 64]
                x = [windows_of(texts[i]) for i in part]
                starts = np.cumsum([0] + [len(w) for w in x])
                flat = np.concatenate(x)
                weight = np.maximum((flat != 0).sum(1), 1).astype(float)
                p = net.predict(flat, tables) * weight[:, None]
                mean = np.add.reduceat(p, starts[:-1], axis=0) / np.add.reduceat(weight, starts[:-1])[:, None]
                best = mean.argmax(1)
                for i, b, m in zip(part, best, mean):
                    langs[i], score[i] = net.langs[b], min(1.0, max(0.0, float(m[b])))
            columns = [*(batch.column(i) for i in range(len(keep))), pa.array(langs), pa.array(score)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    out = map_arrow(source, work, schema)
    return out.select(*[F.col(f"__{i}").alias(c) for i, c in enumerate(keep)], "lang_pred", "score")
