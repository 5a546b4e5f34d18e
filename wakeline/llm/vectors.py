"""Near duplicates among vectors of one label: a pivot-permutation index, then exact cosines."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from wakeline.llm.common import components, drawn, grouped, in_blocks, link_rows, map_arrow, pairs_within, runs, starts_of, stored

#: Least cosine of a link.
COSINE = 0.98
#: Reference points: one for so many distinct vectors, within these bounds. The sample they are is bounded by the latter.
PER_PIVOT, LEAST_PIVOTS, MOST_PIVOTS = 16, 64, 4096
#: Nearest reference points that describe a vector, and how many of them a pair must share.
NEAREST, SHARED = 8, 2
#: No two pivots are nearer: a dense group gets one, so that its members agree on their order of pivots.
APART = 0.8
#: Rows of a pivot list, and pairs of rows, that are compared at once.
BLOCK, PAIRS = 512, 200_000


def usable(v: Column) -> Column:
    """Whether a vector can link at all: not null, no null or non-finite component, not zero."""
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(v.isNotNull() & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def unit(rows: np.ndarray) -> np.ndarray:
    rows = rows.astype(np.float64)
    rows /= np.abs(rows).max(1, keepdims=True)  # squares neither overflow nor vanish
    return rows / np.sqrt((rows * rows).sum(1, keepdims=True))


def apart(rows: np.ndarray) -> np.ndarray:
    """The rows, in order, that have a cosine below APART with all rows taken before."""
    taken = np.empty_like(rows)
    n = 0
    for row in rows:
        if not n or (taken[:n] @ row).max() < APART:
            taken[n] = row
            n += 1
    return taken[:n]


def nearest_pivots(rows: np.ndarray, pivots: np.ndarray, first: int) -> np.ndarray:
    """(rows, NEAREST) numbers of the nearest pivots, nearest first, ties by number; -1 where there are fewer pivots."""
    out = np.full((len(rows), NEAREST), -1, np.int32)
    for at in range(0, len(rows), 1024):
        near = unit(rows[at : at + 1024]) @ pivots.T
        k = min(NEAREST, len(pivots))
        out[at : at + 1024, :k] = np.argsort(-near, axis=1, kind="stable")[:, :k] + first
    return out


def pivot_lists(classes: DataFrame) -> tuple[DataFrame, type]:
    """(inverted lists, numpy type of a component). The lists have a row (label, pivot, id, copies, perm, vec) for each of the nearest pivots of a class.

    ``perm`` packs the ordered pivots, ``vec`` the components as doubles or floats. Pivots are classes of least hash,
    those of one dimension describe the vectors of that dimension. Pivots too near to one another are left out.
    """
    count = classes.count()
    number = min(MOST_PIVOTS, max(LEAST_PIVOTS, count // PER_PIVOT))
    hashed = classes.select(F.xxhash64(F.lit(5), "h1", "h2").alias("hash"), "label", "embedding")
    chosen = drawn(hashed, "hash", number).orderBy("hash", "label").select("embedding").toPandas()
    by_size: dict[int, list] = {}
    for v in chosen["embedding"]:
        by_size.setdefault(len(v), []).append(np.asarray(v, np.float64))
    pivots, first = {}, 0
    for size, rows in sorted(by_size.items()):
        pivots[size] = (apart(unit(np.stack(rows))), first)
        first += len(pivots[size][0])
    sent = classes.sparkSession.sparkContext.broadcast(pivots)
    single = classes.schema["embedding"].dataType.elementType.typeName() == "float"
    kind = np.float32 if single else np.float64

    def work(batches):
        for batch in batches:
            vectors = batch.column("embedding")
            lengths = np.diff(vectors.offsets.to_numpy())
            flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(kind)
            begin = np.cumsum(lengths) - lengths
            for size in np.unique(lengths).tolist():
                rows = np.flatnonzero(lengths == size)
                x = flat[begin[rows][:, None] + np.arange(size)]
                held, low = sent.value.get(size, (np.zeros((0, size)), 0))
                # A dimension without pivots has one list for each label.
                perm = nearest_pivots(x, held, low) if len(held) else np.full((len(rows), NEAREST), -size - 1, np.int32)
                some = pa.array(rows)
                columns = [batch.column(c).take(some) for c in ("label", "id", "copies")]
                lists = [sorted({p for p in r if p != -1}) for r in perm.tolist()]
                columns.append(pa.array(lists, pa.list_(pa.int32())))
                columns.append(pa.array([r.tobytes() for r in perm], pa.binary()))
                columns.append(pa.array([r.tobytes() for r in x], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=["label", "id", "copies", "pivots", "perm", "vec"])

    label = classes.schema["label"].dataType.simpleString()
    schema = f"label {label}, id long, copies long, pivots array<int>, perm binary, vec binary"
    described = stored(map_arrow(classes.select("label", "id", "copies", "embedding"), work, schema), "pivots")
    return described.withColumn("pivot", F.explode("pivots")).drop("pivots"), kind


def linked(lists: DataFrame, kind: type, cosine: float) -> DataFrame:
    """(id, links, near) of pairs that share SHARED pivots (all, if there are fewer) and reach ``cosine``.

    A pair meets in every list of a pivot both have; it counts in the list of the least of these.
    """
    lists = lists.withColumn("label", F.col("label").cast("string"))
    met = grouped(in_blocks(lists, ["label", "pivot"], F.xxhash64("id"), BLOCK), ["label", "pivot", "lo", "hi"])
    keys = ["label", "pivot", "lo", "hi"]

    def work(batches):
        for table in runs(batches, keys):
            ids, copies = table.column("id").to_numpy(), table.column("copies").to_numpy()
            perm = np.frombuffer(b"".join(table.column("perm").to_pylist()), np.int32).reshape(-1, NEAREST)
            vec = table.column("vec").to_pylist()
            pivot, side = table.column("pivot").to_numpy(), table.column("side").to_numpy()
            cross = table.column("lo").to_numpy() < table.column("hi").to_numpy()
            sizes = np.diff(starts_of(table, keys))
            bounds = np.cumsum(sizes) - sizes
            found_a, found_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            cut = 0
            while cut < len(sizes):
                pairs = np.cumsum(sizes[cut:] * (sizes[cut:] - 1) // 2)
                stop = cut + max(1, int(np.searchsorted(pairs, PAIRS)))
                i, j = pairs_within(sizes[cut:stop])
                i, j = i + bounds[cut], j + bounds[cut]
                for at in range(0, len(i), PAIRS):
                    a, b = i[at : at + PAIRS], j[at : at + PAIRS]
                    use = ~cross[a] | (side[a] != side[b])
                    a, b = a[use], b[use]
                    least, shared = np.full(len(a), 2**31 - 1), np.zeros(len(a), np.int64)
                    for k in range(NEAREST):
                        p = perm[a, k]
                        both = (perm[b] == p[:, None]).any(1) & (p != -1)
                        if (p < -1).any():
                            both &= (p >= 0) | (k == 0)
                        shared += both
                        least = np.where(both, np.minimum(least, p), least)
                    enough = np.minimum(SHARED, np.where(perm[a, 0] < -1, 1, (perm[a] != -1).sum(1)))
                    near = (shared >= enough) & (least == pivot[a])
                    a, b = a[near], b[near]
                    for s in range(0, len(a), 20_000):
                        x = [np.stack([np.frombuffer(vec[r], kind) for r in rows]) for rows in (a[s : s + 20_000], b[s : s + 20_000])]
                        far = (unit(x[0]) * unit(x[1])).sum(1) < cosine
                        found_a.append(a[s : s + 20_000][~far])
                        found_b.append(b[s : s + 20_000][~far])
                cut = stop
            a, b = np.concatenate(found_a), np.concatenate(found_b)
            if len(a):
                yield link_rows(ids, copies, a, b)

    return map_arrow(met, work, "id long, links long, near long")


def near_vectors(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", cosine: float = COSINE
) -> DataFrame:
    """Per row: key, n_links, component_id (least key reachable over links, itself included), kept (key = component_id).

    Rows of one non-null label are linked if the cosine of their vectors, in double precision, is ``cosine`` or more.
    Equal vectors are one class and are compared once, so copies cost nothing. Vectors that are null, empty, zero or hold
    null or non-finite components have no links, neither have those with null label or of unequal dimension; such rows
    are their own component. Repeated rows are copies. Null keys: linked, but never a component's least key unless
    it has no other; a component without any key is null and its rows are kept. Extra columns are not read.

    A pair whose cosine is high enough is missed only if its ordered lists of nearest pivots share less than SHARED.
    """
    rows = vectors.select(
        F.col(key).alias("key"), F.col(label).alias("label"), F.col(vector).alias("embedding"), usable(F.col(vector)).alias("ok")
    ).withColumns({"h1": F.xxhash64("embedding"), "h2": F.xxhash64(F.lit(1), "embedding")})
    rows = rows.withColumn("ok", F.col("ok") & F.col("label").isNotNull())
    classes = rows.filter("ok").groupBy("label", "h1", "h2").agg(
        F.first("embedding").alias("embedding"), F.min("key").alias("least"), F.count(F.lit(1)).alias("copies")
    )
    classes = stored(classes.withColumn("id", F.monotonically_increasing_id()), "vectors")
    lists, kind = pivot_lists(classes)
    links = stored(linked(lists, kind, cosine), "links")
    roots = components(links.select(F.col("id").alias("a"), F.col("near").alias("b")))
    counted = links.groupBy("id").agg(F.sum("links").alias("links"))
    named = classes.drop("embedding").join(roots, F.col("id") == F.col("node"), "left").drop("node")
    named = named.withColumn("root", F.coalesce("root", "id"))
    heads = named.groupBy("root").agg(F.min("least").alias("head"))
    named = named.join(heads, "root").join(counted, "id", "left").select(
        F.col("label").alias("__label"),
        F.col("h1").alias("__h1"),
        F.col("h2").alias("__h2"),
        "head",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).cast("long").alias("links"),
    )
    same = F.col("ok") & (F.col("label") == F.col("__label")) & (F.col("h1") == F.col("__h1")) & (F.col("h2") == F.col("__h2"))
    out = rows.drop("embedding").join(named, same, "left")
    out = out.withColumn("component", F.coalesce("head", "key"))
    return out.select(
        F.col("key").alias(key),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.col("component").cast("long").alias("component_id"),
        F.col("key").eqNullSafe(F.col("component")).alias("kept"),
    )
