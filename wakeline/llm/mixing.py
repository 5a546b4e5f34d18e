"""Mix sources to target weights by weighted fair queueing."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from wakeline.llm.common import stored

#: Words are maximal runs of anything but space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"
#: Weights of the sources in code point order, repeating.
WEIGHTS = (1, 2, 3)
#: No source, and no document, is taken more often than this.
REPEATS = 3
#: Words of a packet: documents are queued in pieces of this size.
PACKET = 256
#: Rows, or packets, that one window task handles together.
CHUNK = 512


def word_count(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, source: str = "source", weights: tuple = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """``sizes`` (source, source_size) with ``rank`` and ``target``: sources by code point, null last.

    All targets share the sum of all sizes by weight; a target above ``repeats`` times its size stops there and the
    excess goes to the others by weight, until none is above. Ranks come from a range sort, levels from one aggregated
    row per round, so the number of sources is not limited. All sizes 0: all targets 0.
    """
    spark = sizes.sparkSession
    ranked = sizes.orderBy(F.col(source).asc_nulls_last()).rdd.zipWithIndex()
    schema = sizes.select(source, "source_size").schema
    ranked = ranked.map(lambda x: (*x[0], x[1]))
    table = stored(spark.createDataFrame(ranked, schema.add("rank", "long")), "sources")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    table = table.withColumn("weight", weight)
    stop = F.col("source_size") * F.lit(repeats)
    level, capped = None, -1
    while True:
        above = F.lit(False) if level is None else F.lit(level) * F.col("weight") > stop
        row = table.agg(
            F.sum("source_size").alias("all"),
            F.sum(F.when(above, stop).otherwise(0)).alias("held"),
            F.sum(F.when(above, 0.0).otherwise(F.col("weight"))).alias("open"),
            F.count_if(above).alias("capped"),
        ).first()
        if row["capped"] == capped or not row["open"]:
            break
        level, capped = ((row["all"] or 0) - (row["held"] or 0)) / row["open"], row["capped"]
    return table.withColumn("target", F.least(F.lit(level or 0.0) * F.col("weight"), stop.cast("double")))


def before(totals: DataFrame, keys: list[str], place: str, value: str, bits: int) -> DataFrame:
    """(keys, place, before): the sum of ``value`` over smaller places, in two levels of windows of 2^bits places."""
    high = totals.withColumn("__high", F.shiftright(place, bits))
    sums = high.groupBy(*keys, "__high").agg(F.sum(value).alias("__sum"))
    ahead = Window.partitionBy(*keys).orderBy("__high").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*keys, "__high", F.coalesce(F.sum("__sum").over(ahead), F.lit(0)).alias("__base"))
    inner = Window.partitionBy(*keys, "__high").orderBy(place).rowsBetween(Window.unboundedPreceding, -1)
    low = high.withColumn("__low", F.coalesce(F.sum(value).over(inner), F.lit(0)))
    met = low.join(sums, [*keys, "__high"])
    return met.select(*keys, place, (F.col("__base") + F.col("__low")).alias("before"))


def mix(
    docs: DataFrame,
    source: str = "source",
    text: str = "text",
    key: str = "doc_id",
    weights: tuple = WEIGHTS,
    repeats: int = REPEATS,
    packet: int = PACKET,
    seed: int = 17,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """What a mix of all documents takes of each: ``key``, source, size, source_size, target, taken and ``keep``.

    Documents of a source are shuffled by a hash of key, source and text, queued up to ``repeats`` times over, and cut
    into packets of ``packet`` words. A packet's virtual finish time is the source's words up to its end divided by the
    source's target. Packets are put in ranges of finish time; whole ranges below the budget (the sum of all sizes) are
    taken, the range in which it ends is sorted and truncated there. So a source's taken words differ from its target
    by less than a packet and the truncated rest, and all taken words add up to the budget.

    A source that holds most rows is cut into chunks by hash, with prefix sums over chunk totals. Null text: size 0,
    taken 0. Null sources form one source, the last. Null keys and repeated rows are rows like others. Equal input
    gives equal output; ties in the shuffle go by key, then size. An empty table gives an empty table.
    """
    order = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(key), F.col(source), F.col(text)), 1)
    rows = stored(
        docs.select(
            F.col(key).alias("__key"),
            F.col(source).alias("__source"),
            word_count(F.col(text)).alias("__size"),
            order.alias("__order"),
            *[F.col(c).alias(f"__keep_{i}") for i, c in enumerate(keep)],
        ),
        "sized",
    )
    count = rows.count()
    sizes = rows.groupBy(F.col("__source").alias("source")).agg(F.sum("__size").alias("source_size"))
    goal = targets(sizes, "source", weights, repeats)
    rows = rows.join(goal, rows["__source"].eqNullSafe(goal["source"])).drop("source", "weight")

    bits = max(0, math.ceil(math.log2(max(1, count / CHUNK))))
    rows = rows.withColumn("__place", F.shiftright("__order", 63 - bits) if bits else F.lit(0).cast("long"))
    chunk = Window.partitionBy("rank", "__place").orderBy("__order", "__key", "__size")
    upto = chunk.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = rows.groupBy("rank", "__place").agg(F.sum("__size").alias("__total"))
    ahead = before(totals, ["rank"], "__place", "__total", (bits + 1) // 2)
    queued = (
        rows.withColumn("__pos", F.row_number().over(chunk))
        .withColumn("__upto", F.sum("__size").over(upto))
        .join(ahead, ["rank", "__place"])
        .withColumn("__start", F.col("before") + F.col("__upto") - F.col("__size"))
        .drop("before", "__upto")
    )
    narrow = stored(queued.drop(*[f"__keep_{i}" for i in range(len(keep))]), "queued")

    totals = goal.agg(
        F.sum("source_size").alias("budget"), F.min(F.when(F.col("target") > 0, F.col("target"))).alias("least")
    ).first()
    budget = totals["budget"] or 0
    # All targets are reached at this time, so later packets are never taken.
    latest = 1 + packet / totals["least"] if totals["least"] else 0.0
    ranges = max(1, round(budget / packet / CHUNK))
    pieces = F.ceil(F.col("__size") / F.lit(packet))

    def packets(i: Column) -> Column:
        """Start, words, finish time and range of packet i of a document, counted over all its repeats."""
        part, turn = i % pieces, F.floor(i / pieces)
        words = F.least(F.lit(packet).cast("long"), F.col("__size") - part * packet)
        start = F.col("__start") + turn * F.col("source_size") + part * packet
        finish = (start + words) / F.col("target")
        return F.struct(i.alias("i"), words.alias("words"), finish.alias("finish"), F.floor(finish * ranges).alias("range"))

    listed = F.when(
        F.col("__size") > 0,
        F.filter(F.transform(F.sequence(F.lit(0).cast("long"), pieces * repeats - 1), packets), lambda p: p["finish"] <= latest),
    )
    queue = narrow.withColumn("__packets", listed)
    each = queue.select(F.explode("__packets").alias("p")).groupBy(F.col("p.range").alias("range")).agg(F.sum("p.words").alias("words"))
    each = stored(each, "ranges")
    ends = before(each, [], "range", "words", max(1, math.ceil(math.log2(ranges + 1) / 2)))
    cut = ends.join(each, "range").filter((F.col("before") < budget) & (F.col("before") + F.col("words") >= budget)).first()
    last, left = (cut["range"], budget - cut["before"]) if cut else (-1, 0)

    own = ["rank", "__place", "__pos"]
    edge = queue.select(*own, "__order", F.explode(F.filter("__packets", lambda p: p["range"] == last)).alias("p"))
    edge = edge.select(*own, "__order", "p.i", "p.words", "p.finish")
    sorted_ = Window.partitionBy(F.lit(0)).orderBy("finish", "rank", "__order", "__pos", "i")
    edge = edge.withColumn("__sum", F.sum("words").over(sorted_.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    got = F.greatest(F.lit(0), F.least(F.col("words"), F.lit(left) - (F.col("__sum") - F.col("words"))))
    edge = edge.groupBy(*own).agg(F.sum(got).alias("__edge"))
    whole = F.aggregate(
        F.coalesce("__packets", F.array().cast("array<struct<i:bigint,words:bigint,finish:double,range:bigint>>")),
        F.lit(0).cast("long"),
        lambda s, p: s + F.when(p["range"] < last, p["words"]).otherwise(0),
    )
    full = queued.withColumn("__packets", listed) if keep else queue
    out = full.withColumn("__whole", whole).join(edge, own, "left")
    return out.select(
        F.col("__key").alias(key),
        F.col("__source").alias(source),
        F.col("__size").alias("size"),
        "source_size",
        "target",
        (F.col("__whole") + F.coalesce("__edge", F.lit(0))).cast("long").alias("taken"),
        *[F.col(f"__keep_{i}").alias(f"kept_{c}") for i, c in enumerate(keep)],
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself with the columns of ``docs``: a row for every time a document is taken.

    A document whose last turn is cut short gives its first words there, white space as it stands.
    """
    names = docs.columns
    taken = mix(docs, keep=tuple(names), **options)
    turns = F.ceil(F.col("taken") / F.col("size"))
    rows = taken.filter("taken > 0").withColumn("__turn", F.explode(F.sequence(F.lit(1).cast("long"), turns)))
    rest = F.col("taken") - (F.col("__turn") - 1) * F.col("size")
    text = F.col("kept_" + options.get("text", "text"))
    words = F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0))
    text = F.when(rest >= F.col("size"), text).otherwise(F.array_join(F.slice(words, F.lit(1), rest.cast("int")), ""))
    return rows.select(*[(text if c == options.get("text", "text") else F.col(f"kept_{c}")).alias(c) for c in names])
