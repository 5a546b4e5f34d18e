"""Join of documents by Jaccard similarity of their word shingles: MinHash LSH forest, then exact verification."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from wakeline.llm.common import (
    Recent, components, in_blocks, map_arrow, mixed, pairs_within, runs, starts_of, stored, text_batches, union_find,
)

#: Words of a shingle, least similarity of a link.
SHINGLE, SIMILARITY = 5, 0.8
#: Tries of the forest, longest label, and the share of links at exactly SIMILARITY that the tries must bring together.
TREES, LONGEST, RECALL = 12, 4, 0.9999
#: Estimated similarity from which a pair that meets in a trie is verified: 4.9 standard errors of the estimate below 0.8.
ESTIMATE = 0.52
#: Rows of a group that one task compares at once.
BLOCK = 512
#: Members of a node above which each is compared with what it is not connected with yet, one after the other.
LEADERS = 64
_LABEL = T.StructType([T.StructField("node", T.LongType()), T.StructField("rest", T.LongType())])
_U = np.uint64
_rng = np.random.default_rng(20240501)
_FLIP = _rng.integers(0, 2**63, TREES * LONGEST, dtype=np.uint64)
_ODD = _rng.integers(0, 2**63, TREES * LONGEST, dtype=np.uint64) * _U(2) + _U(1)


def depth(similarity: float = SIMILARITY, trees: int = TREES, longest: int = LONGEST, recall: float = RECALL) -> int:
    """Length down to which matched prefixes are shortened: until the tries reach ``recall`` for links at ``similarity``.

    Two signatures share a prefix of length d in one trie with probability s^d, in at least one of the tries with
    1 - (1 - s^d)^trees.
    """
    d = longest
    while d > 1 and 1 - (1 - similarity**d) ** trees < recall:
        d -= 1
    return d


def word_number(word: str) -> int:
    return int.from_bytes(hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")


_WORDS = Recent(word_number)


def shingle_sets(texts: list[str], width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, starts): the distinct hashed shingles of each text, sorted, one text after the other.

    Words are lower-cased runs of non-space. A text of 1 to ``width - 1`` words has one shingle, all of its words; a
    text without words has none. ``starts`` has one more entry than there are texts.
    """
    words = [t.lower().split() for t in texts]
    counts = np.array([len(w) for w in words], np.int64)
    flat = np.fromiter((_WORDS[w] for ws in words for w in ws), np.uint64, int(counts.sum()))
    begin = np.cumsum(counts) - counts
    n = np.maximum(counts - width + 1, np.minimum(counts, 1))
    owner = np.repeat(np.arange(len(texts)), n)
    at = begin[owner] + np.arange(n.sum()) - (np.cumsum(n) - n)[owner]
    padded = np.concatenate([flat, np.zeros(width, np.uint64)])
    value = np.zeros(len(at), np.uint64)
    for i in range(width):
        inside = i < counts[owner]
        value = value * _U(0x9E3779B97F4A7C15) + np.where(inside, padded[at + i] + _U(1), _U(0))
    value = mixed(value)
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    fresh = np.ones(len(value), bool)
    fresh[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    value, owner = value[fresh], owner[fresh]
    return value, np.searchsorted(owner, np.arange(len(texts) + 1))


def signatures(value: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """(texts, TREES * LONGEST) minima of hash functions; texts without shingles have zeros."""
    out = np.zeros((len(starts) - 1, len(_FLIP)), np.uint32)
    some = np.flatnonzero(starts[1:] > starts[:-1])
    if len(some):
        for k in range(len(_FLIP)):
            least = np.minimum.reduceat(((value ^ _FLIP[k]) * _ODD[k]) >> _U(32), starts[:-1][some])
            out[some, k] = least
    return out


def set_keys(value: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each set of shingles."""
    out = []
    for salt in (0x2545F4914F6CDD1D, 0x9E6C63D0876A9A47):
        total = np.concatenate([[_U(0)], np.cumsum(mixed(value ^ _U(salt)))])
        out.append(mixed(total[starts[1:]] - total[starts[:-1]] + (starts[1:] - starts[:-1]).astype(np.uint64)).view(np.int64))
    return out[0], out[1]


def levels(length: int) -> list[int]:
    """Bits to drop from the rest of a label to leave prefixes of LONGEST, ..., ``length`` minima."""
    bits = 63 // max(1, LONGEST - length)
    return [bits * (LONGEST - d) for d in range(LONGEST, length, -1)] + [63]


def described(docs: DataFrame, key: str, text: str, similarity: float = SIMILARITY) -> DataFrame:
    """Per row: key, text_key, hashes of its set of shingles, their number, signature bytes and labels in all tries.

    A label is the hash of the shortest prefix that may be matched and, as one number that sorts like them, the minima
    behind it (their leading bits).
    """
    source = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.xxhash64(text).alias("text_key"))
    schema = source.select("key", "text_key").schema
    for name, kind in (("lo64", "long"), ("hi64", "long"), ("n", T.IntegerType()), ("sig", "binary"), ("labels", T.ArrayType(_LABEL))):
        schema = schema.add(name, kind)
    length = depth(similarity)
    bits = 63 // max(1, LONGEST - length)

    def work(batches):
        for batch, texts in text_batches(batches):
            value, starts = shingle_sets(texts)
            sig = signatures(value, starts)
            lo, hi = set_keys(value, starts)
            prefix, rest = np.empty((len(texts), TREES), np.uint64), np.zeros((len(texts), TREES), np.uint64)
            for t in range(TREES):
                p = np.full(len(texts), t + 1, np.uint64)
                for k in range(length):
                    p = mixed(p * _U(0x9E3779B97F4A7C15) + sig[:, t * LONGEST + k])
                prefix[:, t] = p
                for k in range(length, LONGEST):  # minima are 32 bits
                    part = sig[:, t * LONGEST + k].astype(np.uint64)
                    rest[:, t] = (rest[:, t] << _U(bits)) | (part >> _U(32 - bits) if bits < 32 else part << _U(bits - 32))
            low = sig.astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"),
                    batch.column("text_key"),
                    pa.array(lo),
                    pa.array(hi),
                    pa.array(np.diff(starts).astype(np.int32)),
                    pa.array([r.tobytes() for r in low], pa.binary()),
                    pa.ListArray.from_arrays(
                        pa.array(np.arange(len(texts) + 1, dtype=np.int32) * TREES),
                        pa.StructArray.from_arrays([pa.array(c.view(np.int64).ravel()) for c in (prefix, rest)], names=["node", "rest"]),
                    ),
                ],
                names=schema.names,
            )

    return map_arrow(source, work, schema)


def met_in_tries(classes: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(a, b): classes that meet in a trie with a promising estimate, as edges that connect all such pairs.

    A task holds subtries, their labels sorted, so that the nodes of every length are runs. It begins with the longest
    prefixes and shortens them, length by length, for members that nothing connects yet; pairs that are connected already
    or that have met below a longer prefix are not compared again. Only a spanning set goes on, so n members give less
    than n rows.
    """
    nodes = classes.select("id", F.inline("labels"))
    met = in_blocks(nodes, ["node"], F.xxhash64("id"), BLOCK)
    met = met.join(classes.select("id", "sig"), "id").select("node", "lo", "hi", "side", "rest", "id", "sig")
    met = met.repartition("node", "lo", "hi").sortWithinPartitions("node", "lo", "hi", "rest")
    shifts = levels(depth(similarity))

    def work(batches):
        for table in runs(batches, ["node", "lo", "hi"]):
            ids = table.column("id").to_numpy()
            sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint8).reshape(len(ids), -1)
            side = np.where(table.column("lo").to_numpy() < table.column("hi").to_numpy(), table.column("side").to_numpy().astype(int), -1)
            starts = starts_of(table, ["node", "lo", "hi"])
            root = connected(starts, table.column("rest").to_numpy(), sig, side, shifts)
            moved = np.flatnonzero(root != np.arange(len(root)))
            if len(moved):
                node, index = np.unique(ids, return_inverse=True)
                top = union_find(len(node), index[moved], index[root[moved]])
                moved = np.flatnonzero(top != np.arange(len(node)))
                yield pa.RecordBatch.from_arrays([pa.array(node[moved]), pa.array(node[top[moved]])], names=["a", "b"])

    return map_arrow(met, work, "a long, b long")


def connected(starts: np.ndarray, rest: np.ndarray, sig: np.ndarray, side: np.ndarray, shifts: list[int]) -> np.ndarray:
    """Least row connected with each row within its subtrie: from the longest prefixes to the shortest.

    ``starts`` are the subtries' first rows and the row count, ``rest`` their sorted labels, ``side`` is -1 or the side of a
    row in a group that compares two blocks.
    """
    n, least = len(rest), int(np.ceil(ESTIMATE * sig.shape[1]))
    subtrie = np.zeros(n, np.int64)
    subtrie[starts[1:-1]] = 1
    subtrie = np.cumsum(subtrie)
    root = np.arange(n)
    longer = np.full(n, -1)  # the node of the length before; none at first
    for k, shift in enumerate(shifts):
        value = rest >> shift
        fresh = np.ones(n, bool)
        fresh[1:] = (subtrie[1:] != subtrie[:-1]) | (value[1:] != value[:-1])
        node = np.cumsum(fresh) - 1
        begin = np.append(np.flatnonzero(fresh), n)
        sizes = np.diff(begin)
        small = np.flatnonzero((sizes > 1) & (sizes <= LEADERS))
        edges_a, edges_b = [], []
        at = 0
        while at < len(small):
            work = np.cumsum(sizes[small[at:]] * (sizes[small[at:]] - 1) // 2)
            stop = at + max(1, int(np.searchsorted(work, 300_000)))
            rows = np.concatenate([np.arange(begin[g], begin[g + 1]) for g in small[at:stop]])
            i, j = pairs_within(sizes[small[at:stop]])
            a, b = rows[i], rows[j]
            use = (root[a] != root[b]) & ((side[a] < 0) | (side[a] != side[b]))
            if k:
                use &= longer[a] != longer[b]
            a, b = a[use], b[use]
            near = (sig[a] == sig[b]).sum(1) >= least
            edges_a.append(a[near])
            edges_b.append(b[near])
            at = stop
        for g in np.flatnonzero(sizes > LEADERS):
            rows = np.arange(begin[g], begin[g + 1])
            own = np.unique(root[rows], return_inverse=True)[1]  # what is connected, as far as known
            for r in range(len(rows) - 1):
                others = np.flatnonzero(own[r + 1 :] != own[r]) + r + 1
                if k:
                    others = others[longer[rows[others]] != longer[rows[r]]]
                if side[rows[r]] >= 0:
                    others = others[side[rows[others]] != side[rows[r]]]
                if not len(others):
                    continue
                hit = others[(sig[rows[others]] == sig[rows[r]]).sum(1) >= least]
                if len(hit):
                    edges_a.append(np.full(len(hit), rows[r]))
                    edges_b.append(rows[hit])
                    joined = np.zeros(own.max() + 1, bool)
                    joined[own[hit]] = True
                    own[joined[own]] = own[r]
        if edges_a:
            a, b = np.concatenate(edges_a), np.concatenate(edges_b)
            if len(a):
                root = union_find(n, np.concatenate([a, np.arange(n)]), np.concatenate([b, root]))
        longer = node
    return root


def shared_counts(value: np.ndarray, starts: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Number of common shingles of each of ``rows`` with each of ``cols``, by products of 0/1 matrices in slices."""
    members = np.union1d(rows, cols)
    take = np.concatenate([np.arange(starts[m], starts[m + 1]) for m in members])
    owner = np.repeat(np.arange(len(members)), [starts[m + 1] - starts[m] for m in members])
    _, column, seen = np.unique(value[take], return_inverse=True, return_counts=True)
    shared = seen[column] > 1  # what only one text has is in no intersection
    column, owner = column[shared], owner[shared]
    _, column = np.unique(column, return_inverse=True)
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    out = np.zeros((len(rows), len(cols)), np.float64)
    at_r, at_c = np.searchsorted(members, rows), np.searchsorted(members, cols)
    step = max(256, 4_000_000 // max(1, len(members)))
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, step):
        a, b = np.searchsorted(column, [low, low + step])
        grid = np.zeros((len(members), step), np.float32)
        grid[owner[a:b], column[a:b] - low] = 1
        out += grid[at_r] @ grid[at_c].T
    return out


def verified(members: DataFrame, similarity: float) -> DataFrame:
    """(id, links, near) from (root, id, copies, lo64, hi64, text): exact Jaccard of all pairs of a root, in blocks.

    ``links`` counts documents (copies included) of other classes in the block, ``near`` is the least id that the block
    connects with. A row whose text has another set than its class is left out.
    """
    met = in_blocks(members, ["root"], F.xxhash64("id"), BLOCK)
    # The work is in the pairs, not in the bytes: partitions are not put together again where they are small.
    tasks = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = met.repartition(tasks, "root", "lo", "hi").sortWithinPartitions("root", "lo", "hi")

    def work(batches):
        for table in runs(batches, ["root", "lo", "hi"]):
            bounds = starts_of(table, ["root", "lo", "hi"])
            texts = ["" if t is None else t for t in table.column("text").to_pylist()]
            ids, copies = table.column("id").to_numpy(), table.column("copies").to_numpy()
            lo64, hi64 = table.column("lo64").to_numpy(), table.column("hi64").to_numpy()
            side = table.column("side").to_numpy()
            cross = table.column("lo").to_numpy() < table.column("hi").to_numpy()
            out_id, out_links, out_near = [], [], []
            for begin, end in zip(bounds[:-1], bounds[1:]):
                value, starts = shingle_sets(texts[begin:end])
                x, y = set_keys(value, starts)
                good = (x == lo64[begin:end]) & (y == hi64[begin:end])
                _, first = np.unique(ids[begin:end], return_index=True)
                one = np.zeros(end - begin, bool)
                first = np.concatenate([np.flatnonzero(good & (ids[begin:end] == i))[:1] for i in ids[begin:end][first]])
                one[first] = True
                rows = np.flatnonzero(one & ~side[begin:end]) if cross[begin] else np.flatnonzero(one)
                cols = np.flatnonzero(one & side[begin:end]) if cross[begin] else rows
                if not len(rows) or not len(cols):
                    continue
                size = np.diff(starts)
                inter = shared_counts(value, starts, rows, cols)
                either = size[rows][:, None] + size[cols][None, :] - inter
                near = inter >= similarity * either - 1e-9
                if not cross[begin]:
                    np.fill_diagonal(near, False)
                links = np.zeros(end - begin, np.int64)
                links[rows] += near @ copies[begin:end][cols]
                if cross[begin]:
                    links[cols] += near.T @ copies[begin:end][rows]
                a, b = np.nonzero(near)
                rank = np.argsort(ids[begin:end], kind="stable")
                place = np.empty_like(rank)
                place[rank] = np.arange(len(rank))
                root = union_find(end - begin, place[rows[a]], place[cols[b]])
                some = np.flatnonzero(links)
                out_id.append(ids[begin:end][some])
                out_links.append(links[some])
                out_near.append(ids[begin:end][rank[root[place[some]]]])
            if out_id:
                columns = [pa.array(np.concatenate(c)) for c in (out_id, out_links, out_near)]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "links", "near"])

    return map_arrow(met, work, "id long, links long, near long")


def row_key(key: Column, text_key: Column) -> Column:
    """Hash of a row's key and text: rows of one key with other texts have others, rows equal in both the same."""
    return F.xxhash64(F.lit(7), key, text_key)


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """Per row of ``docs``: key, text_key, copy_id, class_id, n_links.

    Links join rows whose sets of five-word shingles have a Jaccard similarity of ``similarity`` (0.8 or more) or above.
    ``n_links`` counts the other rows linked directly, copies included; ``class_id`` is the least key reachable by links,
    ``copy_id`` the least key with the same set of shingles; ``text_key`` tells rows of one key apart. Rows with equal
    sets are one class and are compared once. Null, empty and blank texts have no shingles and no links; texts of under
    five words equal only the same words. A null key gives a null class_id if no row of its class has a key; then and
    for rows without links copy_id and class_id are the row's own key. Extra columns are not read.

    Steps: describe rows; reduce copies to classes; meet in the tries; connect what met; verify every connected set
    exactly in blocks; connect verified links. No step emits all pairs of a group, none holds a whole hot group.
    """
    found = linked(docs, key, text, similarity)
    return found.select(
        F.col("key").alias(key),
        "text_key",
        F.coalesce("least", "key").alias("copy_id"),
        F.coalesce("class", "key").alias("class_id"),
        F.coalesce(F.col("links") + F.col("copies") - 1, F.lit(0)).cast("long").alias("n_links"),
    )


def linked(docs: DataFrame, key: str, text: str, similarity: float) -> DataFrame:
    """Per row of ``docs``: key, text_key, and least, class, root, copies, links of its set; null without shingles.

    ``root`` is a number of the connected class, which tells classes of the same least key (or none) apart.
    """
    rows = stored(described(docs, key, text, similarity), "described")
    sets = rows.filter("n > 0").groupBy("lo64", "hi64")
    shown = F.min(F.struct(row_key(F.col("key"), F.col("text_key")).alias("row_key"), "text_key")).alias("shown")
    classes = sets.agg(
        F.min("key").alias("least"), shown, F.count(F.lit(1)).alias("copies"), F.first("sig").alias("sig"), F.first("labels").alias("labels")
    )
    classes = stored(classes.withColumn("id", F.monotonically_increasing_id()), "classes")
    met = components(met_in_tries(classes, similarity))
    known = classes.select("id", "shown.*", "copies", "lo64", "hi64").join(met, classes.id == met.node).drop("node")
    texts = docs.select(row_key(F.col(key), F.xxhash64(text)).alias("row_key"), F.xxhash64(text).alias("text_key"), F.col(text).alias("text"))
    members = texts.join(known, ["row_key", "text_key"]).dropDuplicates(["row_key", "text_key", "id"])
    members = members.select("root", "id", "copies", "lo64", "hi64", "text")
    links = stored(verified(members, similarity), "links")
    near = components(links.select(F.col("id").alias("a"), F.col("near").alias("b")))
    counted = links.groupBy("id").agg(F.sum("links").alias("links"))
    named = classes.select("id", "lo64", "hi64", "least", "copies").join(near, F.col("id") == F.col("node"), "left")
    named = named.withColumn("root", F.coalesce("root", "id")).drop("node")
    heads = named.groupBy("root").agg(F.min("least").alias("class"))
    named = named.join(heads, "root").join(counted, "id", "left")
    named = named.select(
        F.col("lo64").alias("__lo"), F.col("hi64").alias("__hi"), "least", "class", "root", "copies", F.coalesce("links", F.lit(0)).alias("links")
    )
    out = rows.join(named, (F.col("lo64") == F.col("__lo")) & (F.col("hi64") == F.col("__hi")) & (F.col("n") > 0), "left")
    return out.select("key", "text_key", "least", "class", "root", "copies", "links")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with one row of each class: the one of least key, nulls last; of equal keys one by a hash of the text.

    Rows without shingles are no copies of anything; all stay. Rows with null key in a class that has keys go.
    """
    found = linked(docs, key, text, similarity).groupBy("root", "key", "text_key").agg(F.count(F.lit(1)).alias("times"))
    found = stored(found, "found")
    first = F.min(F.struct(F.col("key").isNull().alias("none"), "key", "text_key", "times")).alias("first")
    held = found.filter("root is not null").groupBy("root").agg(first).select("first.key", "first.text_key", "first.times")
    held = held.union(found.filter("root is null").select("key", "text_key", F.lit(1).cast("long")))
    held = stored(held.toDF("__key", "__text_key", "__times"), "kept")
    rows = docs.select(F.struct("*").alias("row"), F.col(key).alias("key"), F.xxhash64(text).alias("text_key"))
    met = rows.join(held, rows.key.eqNullSafe(held["__key"]) & (rows.text_key == held["__text_key"]))
    if held.filter("__times > 1").limit(1).count():
        again = F.col("__times") > 1
        met = met.filter(~again).union(met.filter(again).dropDuplicates(["key", "text_key"]))
    return met.select("row.*")
