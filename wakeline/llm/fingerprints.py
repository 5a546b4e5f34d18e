"""Document fingerprints by order MinHash, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from wakeline.llm.common import stored

#: Units of a k-mer. Units are words, or overlapping pieces of words of over LONG code points.
KMER = 3
LONG, PIECE = 16, 4
#: Texts of fewer units also give all runs of PIECE code points.
FEW = 32
#: Bins of the hash range (2^BITS), each giving one tuple of its two least k-mers.
BITS = 6
#: Low bits of a packed long that hold a k-mer's place in the text (all that an array can have); the high bits hold its hash.
PLACE = 31
#: Bits of a tuple's hash in the signature.
TUPLE = 26
#: Rows that one task orders together, as a power of two, and copies that one row stands for at most.
ROW_BITS, COPIES = 11, 10_000


def _high(x: Column) -> Column:
    return F.shiftright(x, PLACE)


def _place(x: Column) -> Column:
    return x.bitwiseAND(F.lit((1 << PLACE) - 1))


def _packed(hash_: Column, place: Column) -> Column:
    return F.shiftleft(F.shiftright(hash_, PLACE), PLACE).bitwiseOR(place.cast("long"))


def _bin(x: Column) -> Column:
    return F.shiftright(x, 64 - BITS)


def _let(value: Column, then) -> Column:
    """``then(value)``, with ``value`` computed once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _pieces(text: Column) -> Column:
    """Hashes of all runs of PIECE code points (of the whole text, if it has fewer), in order."""

    def cut(c: Column) -> Column:
        last = F.greatest(F.size(c) - PIECE, F.lit(0))
        return F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(c, i + k) for k in range(PIECE)]))

    return _let(F.split(text, ""), cut)


def units(text: Column) -> Column:
    """Hashes of the units of a text, in order: its words, those of over LONG code points by their overlapping pieces."""

    def hashed(words: Column) -> Column:
        whole = F.transform(words, lambda w: F.xxhash64(w))
        cut = F.flatten(F.transform(words, lambda w: F.when(F.char_length(w) > LONG, _pieces(w)).otherwise(F.array(F.xxhash64(w)))))
        return F.when(F.exists(words, lambda w: F.char_length(w) > LONG), cut).otherwise(whole)

    return _let(F.filter(F.split(text, r"\s+"), lambda w: w != ""), hashed)


def with_signature(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` plus ``out``: the signature of column ``text`` as an array of longs, at most one a bin, in bin order.

    k-mers are runs of KMER units (fewer units are one k-mer). Texts of fewer than FEW units also give all runs of PIECE
    code points, behind the others, so that short texts and texts without spaces are compared by what they share, too.
    Equal k-mers are told apart by the number of their occurrence. All get one hash; the hash range has 2^BITS bins. Of
    each bin the two least k-mers are taken, put in the order of the text and hashed together, so moving text about
    changes tuples that a set of k-mers would keep. A text without words has an empty signature.

    Everything is a pass over arrays of longs (hash high, place low), sorted as longs twice: by k-mer, which numbers the
    occurrences, and by hash. Each step is a column of its own so that it is computed once.
    """
    c = {k: f"__{out}_{k}" for k in ("words", "kmers", "runs", "minima", "picked", "starts")}
    drop = list(c.values())
    df = df.withColumn(c["words"], units(F.coalesce(text, F.lit(""))))
    w = F.col(c["words"])
    kmer = lambda i: _packed(F.xxhash64(*[F.get(w, i + k) for k in range(KMER)]), i)
    last = F.greatest(F.size(w) - KMER, F.lit(0))
    none = F.array().cast("array<bigint>")
    long = F.transform(F.sequence(F.lit(0), last), kmer)
    short = F.concat(long, F.transform(_pieces(F.trim(F.coalesce(text, F.lit("")))), lambda h, i: _packed(h, i + FEW)))
    df = df.withColumn(
        c["kmers"], F.when(F.size(w) >= FEW, F.sort_array(long)).when(F.size(w) > 0, F.sort_array(short)).otherwise(none)
    )
    k = F.col(c["kmers"])
    places = F.when(F.size(k) > 0, F.sequence(F.lit(0), F.size(k) - 1)).otherwise(F.array().cast("array<int>"))
    begins = lambda j: (j == 0) | (_high(F.get(k, j - 1)) != _high(F.get(k, j)))
    df = df.withColumn(c["runs"], F.filter(places, begins))
    r = F.col(c["runs"])
    numbered = lambda x, n: _packed(F.xxhash64(_high(x), n.cast("long")), _place(x))
    first = F.transform(r, lambda j: numbered(F.get(k, j), F.lit(0)))
    stop = lambda i: F.coalesce(F.get(r, i + 1), F.size(k))
    which = F.when(F.size(r) > 0, F.sequence(F.lit(0), F.size(r) - 1)).otherwise(F.array().cast("array<int>"))
    repeated = F.filter(which, lambda i: stop(i) - F.get(r, i) > 1)
    again = F.flatten(
        F.transform(
            repeated,
            lambda i: F.transform(F.sequence(F.get(r, i) + 1, stop(i) - 1), lambda j: numbered(F.get(k, j), j - F.get(r, i))),
        )
    )
    df = df.withColumn(c["minima"], F.sort_array(F.concat(first, again)))
    m = F.col(c["minima"])
    df = df.withColumn(c["picked"], F.filter(m, lambda x, j: (j < 2) | (_bin(F.get(m, j - 2)) != _bin(x))))
    p = F.col(c["picked"])
    all_ = F.when(F.size(p) > 0, F.sequence(F.lit(0), F.size(p) - 1)).otherwise(F.array().cast("array<int>"))
    df = df.withColumn(c["starts"], F.filter(all_, lambda j: (j == 0) | (_bin(F.get(p, j - 1)) != _bin(F.get(p, j)))))

    def tuple_(j: Column) -> Column:
        a, b = F.get(p, j), F.get(p, j + 1)
        one = F.coalesce(_bin(b) != _bin(a), F.lit(True))
        hash_ = (
            F.when(one, F.xxhash64(_high(a)))
            .when(_place(a) <= _place(b), F.xxhash64(_high(a), _high(b)))
            .otherwise(F.xxhash64(_high(b), _high(a)))
        )
        bin_ = _bin(a) + (1 << (BITS - 1))
        return F.shiftleft(bin_, TUPLE).bitwiseOR(hash_.bitwiseAND(F.lit((1 << TUPLE) - 1)))

    return df.withColumn(out, F.transform(c["starts"], tuple_)).drop(*drop)


def as_text(signature: Column) -> Column:
    """Eight hexadecimal digits a tuple."""
    return F.array_join(F.transform(signature, lambda x: F.lpad(F.hex(x), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Square root of the share of the bins either signature fills in which both have the same tuple.

    Both k-mers of a bin have to agree for that, so the root estimates the share of k-mers in common, in order. Two empty
    signatures are alike.
    """
    bins = F.size(F.array_union(F.transform(a, lambda x: F.shiftright(x, TUPLE)), F.transform(b, lambda x: F.shiftright(x, TUPLE))))
    return F.when(bins == 0, 1.0).otherwise(F.sqrt(F.size(F.array_intersect(a, b)) / bins))


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``text`` of all rows with ``signature`` and ``fingerprint``. Null text: as empty."""
    got = with_signature(docs.select(key, text), text, "signature")
    return got.withColumn("fingerprint", as_text(F.col("signature")))


_ROW = ["k", "none", "h1", "h2"]


def _followers(ids: DataFrame) -> DataFrame:
    """Stored (row, at, block, guest): rows by their block, and as guest the row that follows a block's last.

    ``ids`` holds distinct rows. They are put in order by a range sort; a block is 2^ROW_BITS of them. The first of the
    next block is found among the firsts of a partition's blocks, for the last block among the firsts of partitions.
    """
    order = ["none", F.col("k").desc(), F.col("h1").desc(), F.col("h2").desc()]
    placed = ids.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    placed = stored(placed.withColumn("block", F.shiftright("at", ROW_BITS)), "placed")
    row = F.struct(*_ROW, "at")
    firsts = placed.groupBy("block").agg(F.min_by(row, "at").alias("first"))
    firsts = stored(firsts.withColumn("part", F.shiftright("block", 33 - ROW_BITS)), "firsts")
    within = firsts.withColumn("after", F.lead("first").over(Window.partitionBy("part").orderBy("block")))
    parts = firsts.groupBy("part").agg(F.min_by("first", "block").alias("first"))
    around = parts.select(  # one row a partition
        "part", F.coalesce(F.lead("first").over(Window.orderBy("part")), F.min_by("first", "part").over(Window.partitionBy())).alias("next")
    )
    guests = within.join(around, "part").select("block", F.coalesce("after", "next").alias("g"))
    guests = guests.select(*[F.col(f"g.{c}").alias(c) for c in _ROW], F.col("g.at").alias("at"), "block", F.lit(1).alias("guest"))
    return stored(placed.select(*_ROW, "at", "block", F.lit(0).alias("guest")).unionByName(guests), "followers")


def _rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    source = F.coalesce(F.col(text), F.lit(""))
    id_ = F.col(key).cast("long")
    return docs.select(
        F.coalesce(id_, F.lit(0)).alias("k"),
        id_.isNull().alias("none"),
        F.xxhash64(source).alias("h1"),
        F.xxhash64(F.lit(1), source).alias("h2"),
        source.alias("text"),
    )


def with_next(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Two tables (id, text, signature, next_text, next_signature, copies): distinct rows with the row that follows them in
    descending id, null ids last, after the last the first; and rows that repeat, which follow themselves ``copies`` times.

    Rows of equal id go by hashes of their text, so neither null ids nor a repeated one share a task.
    """
    rows = _rows(docs, key, text)
    ids = stored(rows.groupBy(*_ROW).agg(F.count(F.lit(1)).alias("copies")), "ids")
    met = rows.groupBy(*_ROW).agg(F.first("text").alias("text")).join(_followers(ids), _ROW)
    both = with_signature(met.repartition("block"), "text", "signature")
    order = Window.partitionBy("block").orderBy("guest", "at")
    both = both.withColumn("next_text", F.lead("text").over(order)).withColumn("next_signature", F.lead("signature").over(order))
    id_ = F.when(~F.col("none"), F.col("k")).alias("id")
    own = both.filter("guest = 0").select(id_, "text", "signature", "next_text", "next_signature", F.lit(1).cast("long").alias("copies"))
    repeated = stored(ids.filter("copies > 1"), "copies")
    again = rows.join(repeated, _ROW, "left_semi").groupBy(*_ROW).agg(F.first("text").alias("text")).join(repeated, _ROW)
    again = with_signature(again, "text", "signature")
    itself = [F.col("text").alias("next_text"), F.col("signature").alias("next_signature")]
    return own, again.select(id_, "text", "signature", *itself, (F.col("copies") - 1).alias("copies"))


def _copied(rows: DataFrame) -> DataFrame:
    """Every row ``copies`` times; tasks get at most COPIES of one row."""
    parts = F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / COPIES))
    dealt = rows.withColumn("part", F.explode(parts)).repartition("part", "copies")
    own = F.sequence(F.col("part") * COPIES, F.least("copies", (F.col("part") + 1) * COPIES) - 1)
    return dealt.withColumn("__copy", F.explode(own)).drop("__copy", "part")


def edited_fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of all texts, of edited texts, and how alike a text's is to the edited one's and to the next row's.

    A text of n code points loses its last floor(n / 2); the next row's text, in descending ``key``, gives as many from
    its start, or all it has. Likenesses lie between 0 and 1. Null text: as empty. A single row is followed by itself.
    ``key`` is an integer column; null keys come last, repeated keys by hashes of the text, equal rows follow each other.
    Extra columns are not read.
    """
    own, again = with_next(docs, key, text)
    return _compared(own, key).drop("copies").union(_copied(_compared(again, key)).drop("copies"))


def _compared(near: DataFrame, key: str) -> DataFrame:
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))
    near = near.select("id", n.cast("long").alias("n_chars"), edited.alias("edited"), "signature", "next_signature", "copies")
    near = near.withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256))
    near = with_signature(near, "edited", "edited_signature")
    return near.select(
        F.col("id").alias(key),
        "n_chars",
        "edited_sha256",
        as_text(F.col("signature")).alias("fingerprint"),
        as_text(F.col("edited_signature")).alias("edited_fingerprint"),
        likeness(F.col("signature"), F.col("edited_signature")).alias("near_edited"),
        likeness(F.col("signature"), F.col("next_signature")).alias("near_next"),
        "copies",
    )
