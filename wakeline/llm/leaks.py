"""Benchmark phrases in a corpus by a positional inverted index, in DataFrame functions only.

The index holds a posting (text, place) for every occurrence of every benchmark word in every document, stored in the
order of the documents, so building it moves nothing. Phrases are found by intersecting offset-adjusted lists: the
postings of a phrase's rarest word propose starts, those of its second rarest thin them out, those of the others confirm
what is left. Lists of frequent words are thus read only where rarer ones have met. Near matches ask that an item's
rarest words stand within a few words of each other, in any order.

Documents are known by two 64-bit hashes of their text: copies share their postings' answers and are searched once.
No list, phrase or item is collected; all joins are plain, so that the optimizer broadcasts a side only where the size of
its stored table allows it, and splits hot keys otherwise.

Nulls: a null text has no words; a null item id is an id like any other, listed as an empty string. Rows that share an item
id are one item. Empty tables give no rows, or rows without hits. Other columns are ignored, whatever they are called.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window, functions as F

from wakeline.llm.common import stored

#: Words of a phrase; an item of fewer words is one phrase.
WINDOW = 10

#: A near match: this many of an item's rarest words (all, if it has fewer) within so many consecutive words.
NEAR_WORDS, NEAR_WIDTH = 6, 30

#: What stands between words, in texts whose A-Z are lower case.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

_TEXT = ["__h1", "__h2"]
_END = ""


def words(text: Column) -> Column:
    """The words of a text as an array, A-Z in lower case and other letters as they are."""
    text = F.coalesce(text, F.lit(""))
    ascii_only = F.octet_length(text) == F.length(text)
    low = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))
    return F.filter(F.split(low, BETWEEN), lambda w: w != "")


def phrases(items: DataFrame, item: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """(item, phrase) for all ``window`` consecutive words of each item; each phrase is an array of words."""
    cut = items.select(F.col(f"`{item}`").alias("item"), words(F.col(f"`{text}`")).alias("w")).filter(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - window + 1, F.lit(1)))
    return cut.select("item", "w", F.explode(starts).alias("at")).select("item", F.slice("w", F.col("at"), window).alias("phrase"))


def postings(documents: DataFrame, terms: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """The index: (__h1, __h2, term, pos) of every occurrence of a word of ``terms`` (column ``term``).

    Behind the last word of every document stands a posting of the empty word: its place is the number of words, and it
    alone carries the id, so the index also lists the documents.
    """
    source = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = documents.select(
        F.col(f"`{doc}`").alias("doc"),
        F.xxhash64(source).alias("__h1"),
        F.xxhash64(F.lit(1), source).alias("__h2"),
        F.posexplode(F.concat(words(source), F.array(F.lit(_END)))).alias("pos", "term"),
    )
    terms = terms.select("term").union(terms.sparkSession.range(1).select(F.lit(_END)))
    known = rows.join(stored(terms, "terms"), "term", "left_semi")
    return stored(known.select(*_TEXT, "term", "pos", F.when(F.col("term") == _END, F.col("doc")).alias("doc")), "postings")


def by_rarity(phrases: DataFrame, index: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Stored (phrases, members, counts): (pid, n, ranked) of each distinct phrase all of whose words occur, with its words
    from the rarest on as (count, offset, term); (pid, item) of the items that hold it; occurrences of every word."""
    pairs = stored(phrases.distinct(), "phrases")
    ids = stored(pairs.select("phrase").distinct().select(F.monotonically_increasing_id().alias("pid"), "phrase"), "phrase-ids")
    members = stored(pairs.join(ids, "phrase").select("pid", "item"), "members")
    counts = stored(index.filter(F.col("term") != _END).groupBy("term").agg(F.count(F.lit(1)).alias("count")), "counts")
    parts = ids.select("pid", F.posexplode("phrase").alias("offset", "term")).join(counts, "term", "left")
    ranked = parts.groupBy("pid").agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.coalesce("count", F.lit(0))).alias("least"),
        F.sort_array(F.collect_list(F.struct("count", "offset", "term"))).alias("ranked"),
    )
    return stored(ranked.filter("least > 0").drop("least"), "ranked"), members, counts


def exact(index: DataFrame, ranked: DataFrame) -> DataFrame:
    """(__h1, __h2, start, n, pid): where every phrase occurs, by lists from the rarest word on."""
    rarest = F.col("ranked")[0]
    first = ranked.select("pid", "n", rarest["term"].alias("term"), rarest["offset"].alias("offset"))
    met = index.filter(F.col("term") != _END).join(first, "term")
    met = met.select(*_TEXT, (F.col("pos") - F.col("offset")).alias("start"), "n", "pid").filter("start >= 0").distinct()
    met = _confirmed(stored(met, "met"), index, ranked, 1, 2)
    return stored(_confirmed(stored(met, "met"), index, ranked, 2, None), "matches")


def _confirmed(met: DataFrame, index: DataFrame, ranked: DataFrame, begin: int, end: int | None) -> DataFrame:
    """Those of ``met`` whose words ``begin`` to ``end`` of the ranking stand at their places too."""
    size = F.size("ranked")
    upto = F.least(size, F.lit(end)) if end else size
    rest = ranked.filter(size > begin).select("pid", F.slice("ranked", F.lit(begin + 1), upto - begin).alias("rest"))
    wanted = stored(rest.select("pid", F.explode("rest").alias("r")).select("pid", "r.offset", "r.term"), "wanted")
    texts = stored(met.filter(F.col("n") > begin).select(*_TEXT).distinct(), "met-texts")
    lists = index.join(wanted.select("term").distinct(), "term", "left_semi").join(texts, _TEXT, "left_semi")
    places = met.join(wanted, "pid").withColumn("pos", F.col("start") + F.col("offset")).drop("offset")
    found = places.join(lists.select(*_TEXT, "pos", "term").distinct(), [*_TEXT, "pos", "term"])
    held = found.groupBy(*_TEXT, "start", "n", "pid").agg(F.count(F.lit(1)).alias("held"))
    asked = F.least(F.col("n"), F.lit(end)) if end else F.col("n")
    return held.filter(F.col("held") == asked - begin).select(*met.columns).union(met.filter(F.col("n") <= begin))


def rarest_words(items: DataFrame, counts: DataFrame, n_words: int, item: str = "item_id", text: str = "text") -> DataFrame:
    """(item, term, bit, full): the ``n_words`` rarest distinct words of each item, a bit for each and the sum of all."""
    held = items.select(F.col(f"`{item}`").alias("item"), F.explode(words(F.col(f"`{text}`"))).alias("term")).distinct()
    held = held.join(counts, "term", "left").withColumn("count", F.coalesce("count", F.lit(0)))
    order = Window.partitionBy("item").orderBy("count", "term")
    kept = held.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n_words)
    bit = F.expr("shiftleft(1L, rank - 1)")
    every = Window.partitionBy("item")
    return kept.select("item", "term", bit.alias("bit")).withColumn("full", F.sum("bit").over(every))


def near_matches(index: DataFrame, rarest: DataFrame, width: int = NEAR_WIDTH) -> DataFrame:
    """(__h1, __h2, item) where all rarest words of an item stand within ``width`` consecutive words of a document."""
    rarest = stored(rarest, "rarest")
    met = index.join(rarest, "term").select(*_TEXT, "item", "pos", "bit", "full").distinct()
    ahead = Window.partitionBy(*_TEXT, "item").orderBy("pos").rangeBetween(0, width - 1)
    return met.withColumn("seen", F.bit_or("bit").over(ahead)).filter("seen = full").select(*_TEXT, "item").distinct()


def hits(matches: DataFrame) -> DataFrame:
    """(__h1, __h2, n_hit): words of each text within any match, those in several counted once."""
    spans = matches.groupBy(*_TEXT, "start").agg(F.max(F.col("start") + F.col("n")).alias("end"))
    before = Window.partitionBy(*_TEXT).orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    begin = F.greatest("start", F.coalesce(F.max("end").over(before), F.col("start")))
    spans = spans.withColumn("new", F.greatest(F.col("end") - begin, F.lit(0)))
    return spans.groupBy(*_TEXT).agg(F.sum("new").cast("long").alias("n_hit"))


def contamination(
    documents: DataFrame,
    items: DataFrame,
    doc: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    near_words: int = NEAR_WORDS,
    near_width: int = NEAR_WIDTH,
) -> DataFrame:
    """One row per document: id, n_words, n_hit, items (sorted ids as strings), n_items, near_items, contaminated.

    ``n_hit`` counts words within an occurrence of any phrase, ``items`` lists the items that own such a phrase,
    ``near_items`` counts items whose rarest words meet. Rows of ``documents`` stay one to one, repeated ones too.
    """
    cut = stored(phrases(items, item, item_text, window), "windows")
    index = postings(documents, cut.select(F.explode("phrase").alias("term")).distinct(), doc, text)
    ranked, members, counts = by_rarity(cut, index)
    matches = exact(index, ranked)
    owners = matches.select(*_TEXT, "pid").distinct().join(members, "pid").select(*_TEXT, "item").distinct()
    name = F.coalesce(F.col("item").cast("string"), F.lit(""))
    owners = owners.groupBy(*_TEXT).agg(F.array_sort(F.collect_list(name)).alias("items"))
    close = near_matches(index, rarest_words(items, counts, near_words, item, item_text), near_width)
    close = close.groupBy(*_TEXT).agg(F.count(F.lit(1)).alias("near_items"))
    listed = index.filter(F.col("term") == _END).select(*_TEXT, F.col("doc").alias(doc), F.col("pos").cast("long").alias("n_words"))
    every = listed.join(hits(matches), _TEXT, "left").join(owners, _TEXT, "left").join(close, _TEXT, "left")
    none = F.array().cast("array<string>")
    return every.select(
        F.col(f"`{doc}`"),
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", none).alias("items"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("near_items", F.lit(0).cast("long")).alias("near_items"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )
