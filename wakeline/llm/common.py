"""Helpers shared by the operators of this folder: stored tables, runs of equal keys, hot groups in blocks, components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from wakeline.session import work_path

#: Texts handed to numpy at once stay below this many bytes (a longer single text goes alone).
CHUNK_CHARS = 500_000


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it again: later steps neither recompute it nor lose it."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drawn(df: DataFrame, hash_: str, rows: int) -> DataFrame:
    """At most ``rows`` rows, those of least ``hash_``, one a hash: hashes alone decide, then only these rows move."""
    cut = df.select(hash_).orderBy(hash_).limit(rows).agg(F.max(hash_)).first()[0]
    return df.filter(F.lit(False) if cut is None else F.col(hash_) <= cut).dropDuplicates([hash_])


def text_batches(
    batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = CHUNK_CHARS
) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of Arrow batches with their texts (null: empty), of ``limit`` bytes or one text; one is held at a time."""
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(text)
        ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        begin = 0
        while begin < batch.num_rows:
            before = ends[begin - 1] if begin else 0
            stop = max(begin + 1, int(np.searchsorted(ends, before + limit, side="right")))
            part = batch.slice(begin, stop - begin)
            yield part, ["" if t is None else t for t in part.column(text).to_pylist()]
            begin = stop


def map_arrow(df: DataFrame, fn: Callable, schema: str | T.StructType) -> DataFrame:
    """``mapInArrow`` for a function from record batches to record batches."""
    return df.mapInArrow(fn, schema)


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of whole groups from batches sorted by ``keys``; a group is held until it is complete.

    Groups are bounded by ``in_blocks``, so what is held is bounded too.
    """
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        change = np.zeros(batch.num_rows, bool)
        for k in keys:
            v = batch.column(k).to_numpy(zero_copy_only=False)
            change[1:] |= v[1:] != v[:-1]
        first = tuple(batch.column(k)[0].as_py() for k in keys)
        cuts = np.flatnonzero(change)
        if held and first != last:
            yield pa.Table.from_batches(held)
            held = []
        if len(cuts):
            end = int(cuts[-1])
            yield pa.Table.from_batches([*held, batch.slice(0, end)])
            held = [batch.slice(end)]
        else:
            held.append(batch)
        last = tuple(batch.column(k)[batch.num_rows - 1].as_py() for k in keys)
    if held:
        yield pa.Table.from_batches(held)


def starts_of(table: pa.Table, keys: list[str]) -> np.ndarray:
    """First row of every group of a table sorted by ``keys``, and the row count at the end."""
    change = np.ones(table.num_rows, bool)
    change[1:] = False
    for k in keys:
        v = table.column(k).to_numpy()
        change[1:] |= v[1:] != v[:-1]
    return np.append(np.flatnonzero(change), table.num_rows)


def in_blocks(df: DataFrame, keys: list[str], spread: Column, block: int, counts: DataFrame | None = None) -> DataFrame:
    """Rows of groups of two or more, with ``lo``, ``hi`` and ``side``; groups above ``block`` rows are cut.

    A group of n rows has ceil(n / block) parts, chosen by the hash ``spread``. Each pair of parts (lo <= hi) becomes
    one small group (keys, lo, hi) that holds both parts, so every pair of rows meets exactly once among the pairs to be
    compared: rows of both sides where lo < hi, all rows where lo = hi. No task ever holds a whole hot group.
    """
    if counts is None:
        counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    counts = counts.filter("__n > 1").withColumn("__parts", F.ceil(F.col("__n") / F.lit(block)).cast("int"))
    met = df.join(counts, keys).withColumn("__part", F.pmod(spread, F.col("__parts")).cast("int"))
    met = met.withColumn("__other", F.explode(F.sequence(F.lit(0), F.col("__parts") - 1)))
    return met.select(
        *df.columns,
        F.least("__part", "__other").alias("lo"),
        F.greatest("__part", "__other").alias("hi"),
        (F.col("__part") > F.col("__other")).alias("side"),
    )


def grouped(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with equal keys next to each other in one partition."""
    return df.repartition(*keys).sortWithinPartitions(*keys)


def components(edges: DataFrame, most: int = 60) -> DataFrame:
    """(node, root): the smallest node reachable over undirected ``edges`` (a, b), for every node that has an edge.

    Labels travel to neighbours and then to the label's own label, so chains halve every round. Each round writes its
    labels to the shared folder. Raises when ``most`` rounds don't settle (chains of over 2^30 nodes).
    """
    both = stored(
        edges.filter("a <> b").select("a", "b").union(edges.filter("a <> b").select("b", "a")).distinct(), "edges"
    )
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("root")), "labels")
    for _ in range(most):
        near = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("root").alias("__near"))
        best = labels.join(near, labels.node == near.a, "left").select(
            "node", "root", F.least("root", F.coalesce("__near", "root")).alias("__new")
        )
        up = labels.select(F.col("node").alias("__up"), F.col("root").alias("__far"))
        new = stored(
            best.join(up, best["__new"] == up["__up"], "left").select(
                "node", "root", F.least("__new", F.coalesce("__far", "__new")).alias("__new")
            ),
            "labels",
        )
        moved = new.filter(F.col("__new") < F.col("root")).limit(1).count()
        labels = new.select("node", F.col("__new").alias("root"))
        if not moved:
            return labels
    raise RuntimeError(f"components did not settle in {most} rounds")


def union_find(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of n nodes over the edges (a[i], b[i])."""
    root = np.arange(n)
    while len(a):
        ra, rb = root[a], root[b]
        low = np.minimum(ra, rb)
        before = root.copy()
        np.minimum.at(root, ra, low)
        np.minimum.at(root, rb, low)
        while True:
            up = root[root]
            if np.array_equal(up, root):
                break
            root = up
        if np.array_equal(root, before):
            break
    return root


class Recent(dict):
    """Values of ``make``, kept for the keys seen of late: when full, keys not seen since the last time are let go."""

    def __init__(self, make: Callable, most: int = 100_000):
        self.make, self.most, self.older = make, most, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit finalizer: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def pairs_within(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers (i, j), i < j, of all pairs inside consecutive groups of the given sizes."""
    counts = sizes * (sizes - 1) // 2
    group = np.repeat(np.arange(len(sizes)), counts)
    at = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    n = sizes[group].astype(float)
    i = np.floor((2 * n - 1 - np.sqrt((2 * n - 1) ** 2 - 8 * at)) / 2).astype(np.int64)
    n = sizes[group]
    i -= i * (2 * n - i - 1) // 2 > at  # square roots of large numbers may be off by one
    i += (i + 1) * (2 * n - i - 2) // 2 <= at
    j = at - i * (2 * n - i - 1) // 2 + i + 1
    begin = (np.cumsum(sizes) - sizes)[group]
    return begin + i, begin + j


_R = 0xD6E8FEB86659FD93
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd number modulo 2^64, and of its inverse."""
    if len(_POWERS[0]) < n:
        size = max(n, 1 << 16)
        for k, base in enumerate((_R, pow(_R, -1, 1 << 64))):
            grown = np.full(size, base, np.uint64)
            grown[0] = 1
            _POWERS[k] = np.multiply.accumulate(grown)
    return _POWERS[0][:n], _POWERS[1][:n]


class Prefixes:
    """Hashes of any substring of a byte array, from sums over its prefixes."""

    def __init__(self, data: np.ndarray):
        up, self.down = powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=self.sums[1:])

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of data[begin:end], elementwise; equal bytes give equal hashes wherever they stand."""
        value = (self.sums[end] - self.sums[begin]) * self.down[begin]
        return mixed(value + (end - begin).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def byte_table(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, starts): UTF-8 of the texts, a line feed behind each; ``starts`` has one more entry than texts."""
    raw = [t.encode("utf-8", "replace") for t in texts]
    data = np.frombuffer(b"\n".join([*raw, b""]), np.uint8)
    return data, np.concatenate([[0], np.cumsum([len(r) + 1 for r in raw], dtype=np.int64)])


def link_rows(ids: np.ndarray, copies: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    """(id, links, near) of rows that have a link (a[i], b[i]): copies linked to, and the least id connected with here."""
    node, index = np.unique(ids, return_inverse=True)
    x, y = index[a], index[b]
    links = np.bincount(x, copies[b], len(node)) + np.bincount(y, copies[a], len(node))
    some = np.flatnonzero(links)
    root = union_find(len(node), x, y)
    columns = [pa.array(node[some]), pa.array(links[some].astype(np.int64)), pa.array(node[root[some]])]
    return pa.RecordBatch.from_arrays(columns, names=["id", "links", "near"])
