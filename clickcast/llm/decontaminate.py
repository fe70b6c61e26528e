"""Benchmark decontamination by a prefix-filtered join.

The items of a benchmark are cut into windows of ``window`` words; an item with fewer words is one window. Words of the
windows are ordered by how often they occur in all documents, the rarest first. A document that contains a window contains
all its words, so the necessary prefix is one word: the rarest. Only where that word stands in a document are windows
looked for. Position and length bounds come first (the window must not begin before the document or end after it), then
the words around are compared one by one.

Windows of an item that share their rarest word share one row, the *anchor*: the word with up to ``window - 1`` item words
on either side. The longest run of equal words around the anchor holds a window if it has ``window`` words (for a short
item, all of them). So a passage gives a few rows, not one per window.

The anchors are broadcast in blocks of at most ``block_words`` words each, split by word; a larger benchmark means
more blocks, each joined with all documents. Documents are never shuffled for the search, only what was found is.
DataFrame functions only.

Defined results: a null or empty text has no words; a null item or one without words has no window; a null item id with a
window marks words but is not listed; repeated items and repeated documents change nothing; rows are told apart by id and
text, so documents that share an id keep their own results, and a null id is an id. No item: nothing is hit.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickcast.llm.common import fresh_prefix, lower_ascii, sent_if_few, split_words, written

WINDOW = 10
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Words of anchors in one broadcast: some 20 MB.
BLOCK_WORDS = 1_000_000


def _words(text: Column) -> Column:
    return split_words(lower_ascii(text), BETWEEN)


def _windows(items: DataFrame, window: int) -> DataFrame:
    """``item, words, start, need``: every window of every item; ``need`` is its number of words."""
    n = F.size("words")
    starts = F.sequence(F.lit(0), F.greatest(n - window, F.lit(0)))
    return items.filter(n > 0).select("item", "words", F.explode(starts).alias("start"), F.least(n, F.lit(window)).alias("need"))


def _word_counts(docs: DataFrame, vocabulary: DataFrame, blocks: int) -> DataFrame:
    """``token, n``: how often the words of ``vocabulary`` occur in all documents."""
    # The outer form, as for the other Spark filters the arrays first and cuts every text into words twice.
    words = docs.select(F.explode_outer("words").alias("token"))
    parts = [words.join(F.broadcast(b), "token") for b in _blocks(vocabulary, blocks)]
    return reduce(DataFrame.unionAll, parts).groupBy("token").agg(F.count("*").alias("n"))


def _blocks(table: DataFrame, blocks: int) -> list[DataFrame]:
    if blocks == 1:
        return [table]
    return [table.filter(F.pmod(F.xxhash64("token"), F.lit(blocks)) == i) for i in range(blocks)]


def find_anchors(docs: DataFrame, items: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> tuple[DataFrame, int]:
    """The anchors of ``items`` (``item, words``) against ``docs`` (``words``), and the number of blocks to join them in."""
    windows = _windows(items, window)
    vocabulary = items.select(F.explode("words").alias("token")).distinct()
    total = items.agg(F.sum(F.size("words"))).first()[0] or 0
    blocks = max(1, -(-total // block_words))
    counts = written(_word_counts(docs, vocabulary, blocks), "leak-counts")
    # Each word of a window with its frequency; the window's smallest (frequency, word, place) is its anchor.
    places = windows.select(
        "item", "words", "start", "need", F.posexplode(F.slice("words", F.col("start") + 1, F.col("need"))).alias("place", "token")
    )
    rarest = places.join(counts, "token").groupBy("item", "words", "start", "need").agg(
        F.min(F.struct("n", "token", "place")).alias("rarest"), F.count("*").alias("known")
    )
    # A window with a word that no document has occurs nowhere.
    rarest = rarest.filter(F.col("known") == F.col("need"))
    at = F.col("start") + F.col("rarest.place")
    side = window - 1
    left = F.reverse(F.slice("words", F.greatest(at - side, F.lit(0)) + 1, F.least(at, F.lit(side))))
    anchors = rarest.select(
        "item", F.col("rarest.token").alias("token"), left.alias("left"), F.slice("words", at + 2, side).alias("right"), "need"
    )
    anchors = anchors.groupBy("token", "left", "right", "need").agg(F.sort_array(F.collect_set("item")).alias("items"))
    anchors = written(anchors, "leak-anchors")
    total = anchors.agg(F.sum(F.size("left") + F.size("right") + F.size("items") + 1)).first()[0] or 0
    return anchors, max(1, -(-total // block_words))


def _run(context: str, steps: int, side: int) -> Column:
    """How many words of the document agree with ``context``, going from the anchor in ``steps`` of 1 or -1.

    Written out as one comparison per word, not with a lambda function: so it is compiled into the join, and of the pairs
    that fail nothing is kept, the document's array of words least of all.
    """
    length, here = F.lit(side), F.col("at")
    for i in reversed(range(side)):
        equal = F.get("words", here + steps * (i + 1)) == F.get(context, F.lit(i))
        length = F.when(F.coalesce(equal, F.lit(False)), length).otherwise(i)
    return length


def find_hits(docs: DataFrame, items: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``key, from_word, to_word`` (end exclusive)``, items``: runs of words in ``docs`` (``key, words``) that hold windows."""
    anchors, blocks = find_anchors(docs, items, window, block_words)
    side = window - 1
    tokens = docs.select("key", "words", F.posexplode_outer("words").alias("at", "token"))
    found = []
    for block in _blocks(anchors, blocks):
        pairs = tokens.join(F.broadcast(block), "token")
        # Bounds on position and length: what the anchor's window needs must fit into the document.
        room = F.least(F.col("at"), F.size("left")) + F.least(F.size("words") - F.col("at") - 1, F.size("right")) + 1
        pairs = pairs.filter(room >= F.col("need"))
        runs = pairs.select("key", "at", "need", "items", _run("left", -1, side).alias("l"), _run("right", 1, side).alias("r"))
        runs = runs.filter(F.col("l") + F.col("r") + 1 >= F.col("need"))
        found.append(runs.select("key", (F.col("at") - F.col("l")).alias("from_word"), (F.col("at") + F.col("r") + 1).alias("to_word"), "items"))
    return reduce(DataFrame.unionAll, found)


def _prepared(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col)
    key = F.struct(F.col(id_col).alias("id"), F.xxhash64(text).alias("hash"), F.length(text).alias("length"))
    return docs.select(key.alias("key"), _words(text).alias("words"))


def _items(benchmark: DataFrame, item_col: str, text_col: str) -> DataFrame:
    return benchmark.select(F.col(item_col).cast("string").alias("item"), _words(F.col(text_col)).alias("words")).distinct()


def contamination(
    docs: DataFrame, benchmark: DataFrame, *, id_col="doc_id", text_col="text", item_col="item_id", item_text_col="text",
    window: int = WINDOW, block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Per document with a hit: ``key`` (id, and hash and length of the text), ``n_hit``, ``items``, ``spans`` of words."""
    hits = find_hits(_prepared(docs, id_col, text_col), _items(benchmark, item_col, item_text_col), window, block_words)
    found = hits.groupBy("key").agg(
        F.sort_array(F.collect_set(F.struct("from_word", "to_word"))).alias("runs"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    # Runs in order: each adds what lies beyond the end of those before.
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    covered = F.aggregate(
        "runs", start,
        lambda a, r: F.struct(
            (a["n"] + F.greatest(r["to_word"] - F.greatest(r["from_word"], a["end"]), F.lit(0))).alias("n"),
            F.greatest(a["end"], r["to_word"]).alias("end"),
        ),
        lambda a: a["n"],
    )
    return found.select("key", covered.cast("long").alias("n_hit"), "items", F.col("runs").alias("spans"))


def hit_counts(docs: DataFrame, benchmark: DataFrame, *, id_col="doc_id", text_col="text", **options) -> DataFrame:
    """Every document: id, ``n_words``, ``n_hit``, ``n_items``, ``items`` (ids as strings, sorted), ``contaminated``."""
    found = contamination(docs, benchmark, id_col=id_col, text_col=text_col, **options)
    found = found.select(F.col("key").alias("found_key"), "n_hit", "items")
    rows = _prepared(docs, id_col, text_col).select("key", F.size("words").cast("long").alias("n_words"))
    joined = rows.join(found, F.col("key").eqNullSafe(F.col("found_key")), "left")
    n_hit, items = F.coalesce("n_hit", F.lit(0)), F.coalesce("items", F.array().cast("array<string>"))
    return joined.select(
        F.col("key.id").alias(id_col), "n_words", n_hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"), items.alias("items"),
        (n_hit > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, *, id_col="doc_id", text_col="text", **options) -> DataFrame:
    """The documents without a hit, with their own columns."""
    found = contamination(docs, benchmark, id_col=id_col, text_col=text_col, **options)
    p = fresh_prefix(docs)
    found = sent_if_few(written(found.select(F.col("key").alias(p + "found")), "leak-found"))
    text = F.col(text_col)
    key = F.struct(F.col(id_col).alias("id"), F.xxhash64(text).alias("hash"), F.length(text).alias("length"))
    return docs.withColumn(p + "key", key).join(found, F.col(p + "key").eqNullSafe(F.col(p + "found")), "left_anti").select(*docs.columns)
