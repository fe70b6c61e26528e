"""Mixing sources to target weights by capped water-filling.

Every source has a weight and a size, the words of its documents. The mix has as many words as all sources together. A
source gets its share by weight, but at most ``max_epochs`` times its size; what a clamped source leaves is dealt out
again by weight to the others, until no target is above its limit. A source is then read whole as many times as its
target allows, and the rest of the target is a fractional repetition: its documents in the order of a seeded hash, until
the words suffice. Where that ends within a document, the first words of it are taken.

The order of the hash is never sorted as a whole. Words are summed by source and by the first hex digits of the hash,
running sums find the one bin of each source in which its fractional repetition ends, and only that bin is looked into.
DataFrame functions only.

Defined results: a null or empty text has size 0 and is never taken; the null source is a source, last in order; a null
id hashes like an empty one; documents of one source with equal ids, repeated rows among them, have equal hashes and
share in proportion what is taken of them (rounded down); an empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clickcast.llm.common import fresh_prefix, numbered, split_words, written

MAX_EPOCHS = 3
WEIGHTS = (1, 2, 3)
SEED = 17
# Hex digits of the hash that name a bin: 4096 bins a source.
BIN_DIGITS = 3
# The plan, one row per source and bin, is broadcast up to this many rows of some 100 bytes; beyond, it is shuffled.
BROADCAST_ROWS = 200_000


def _sized(docs: DataFrame, p: str, id_col: str, text_col: str, source_col: str, seed: int) -> DataFrame:
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"))
    return docs.withColumns(
        {p + "size": F.size(split_words(F.col(text_col))).cast("long"), p + "source": F.col(source_col).cast("string"), p + "hash": digest}
    ).withColumn(p + "bin", F.substring(p + "hash", 1, BIN_DIGITS))


def fill_targets(sources: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``sources`` (with ``weight`` and ``source_size``) and their ``target`` words.

    Each round sets the level of the sources that are not clamped and clamps those above their limit; levels only rise,
    so the clamped ones are those whose limit lies below the level. The driver holds two numbers.
    """
    wide = lambda c: c.cast("decimal(19,0)")
    limit, weight = F.col("source_size") * max_epochs, F.col("weight")

    def clamped(words: int, weights: int) -> Column:
        return wide(limit) * wide(F.lit(weights)) < wide(F.lit(words)) * wide(weight)

    first = sources.agg(F.sum("source_size").alias("words"), F.sum("weight").alias("weights")).first()
    total = words = first["words"] or 0
    weights, count = first["weights"] or 1, -1
    while True:
        over = clamped(words, weights)
        row = sources.agg(
            F.sum(F.when(over, limit)).alias("words"),
            F.sum(F.when(~over, weight)).alias("weights"),
            F.count_if(over).alias("count"),
        ).first()
        # A rounding of the level is impossible, so a round that clamps nobody new is the last.
        if row["count"] == count or not row["weights"]:
            break
        count, words, weights = row["count"], total - (row["words"] or 0), row["weights"]
    share = (F.lit(words).cast("long") * weight).cast("double") / F.lit(weights).cast("double")
    return sources.withColumn("target", F.when(clamped(words, weights), limit.cast("double")).otherwise(share))


def mix_plan(
    docs: DataFrame, *, id_col="doc_id", text_col="text", source_col="source", weights=WEIGHTS, max_epochs=MAX_EPOCHS, seed=SEED
) -> DataFrame:
    """One row per source and bin: ``source, bin, source_size, target, whole`` and where the fractional repetition ends.

    A document is in the fractional repetition if its hash lies before ``edge``; of documents at the edge, which have
    ``edge_size`` words, ``edge_words`` are taken.
    """
    p = fresh_prefix(docs)
    sized = _sized(docs, p, id_col, text_col, source_col, seed).select(
        F.col(p + "source").alias("source"), F.col(p + "bin").alias("bin"), F.col(p + "hash").alias("hash"), F.col(p + "size").alias("size")
    )
    bins = written(sized.groupBy("source", "bin").agg(F.sum("size").alias("words")), "mix-bins")
    sources = bins.groupBy("source").agg(F.sum("words").alias("source_size"))
    ranked = numbered(sources, [F.col("source").asc_nulls_last()], "rank")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int")).cast("long")
    sources = fill_targets(written(ranked.withColumn("weight", weight), "mix-sources"), max_epochs)
    # A whole number of words, so that no rest is lost to rounding.
    aim = F.floor(F.col("target") + 0.5)
    sources = sources.select(
        F.col("source").alias("s"),
        "source_size",
        "target",
        F.when(F.col("source_size") > 0, F.floor(aim / F.col("source_size"))).otherwise(0).cast("long").alias("whole"),
    ).withColumn("rest", F.floor(F.col("target") + 0.5) - F.col("whole") * F.col("source_size"))
    earlier = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    placed = bins.withColumn("before", F.coalesce(F.sum("words").over(earlier), F.lit(0)))
    placed = placed.join(sources, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    placed = written(placed, "mix-placed")
    ends = (F.col("before") < F.col("rest")) & (F.col("rest") < F.col("before") + F.col("words"))

    bounds = placed.filter(ends).select(
        F.col("source").alias("s"), F.col("bin").alias("b"), (F.col("rest") - F.col("before")).alias("left")
    )
    inside = sized.join(bounds, F.col("source").eqNullSafe(F.col("s")) & (F.col("bin") == F.col("b")))
    inside = inside.groupBy("s", "left", "hash").agg(F.sum("size").alias("edge_size"))
    earlier = Window.partitionBy("s").orderBy("hash").rowsBetween(Window.unboundedPreceding, -1)
    inside = inside.withColumn("edge_words", F.col("left") - F.coalesce(F.sum("edge_size").over(earlier), F.lit(0)))
    edges = inside.filter((F.col("edge_words") >= 0) & (F.col("edge_words") < F.col("edge_size"))).select(
        "s", F.col("hash").alias("edge"), "edge_words", "edge_size", F.substring("hash", 1, BIN_DIGITS).alias("b")
    )
    plan = placed.join(edges, F.col("source").eqNullSafe(F.col("s")) & (F.col("bin") == F.col("b")), "left")
    # Bins that end before the rest does are in it: every hash lies before "g". The others are not.
    edge = F.coalesce("edge", F.when(F.col("before") + F.col("words") <= F.col("rest"), "g").otherwise(""))
    return written(
        plan.select("source", "bin", "source_size", "target", "whole", edge.alias("edge"), "edge_words", "edge_size"), "mix-plan"
    )


def _with_plan(docs: DataFrame, p: str, id_col, text_col, source_col, weights, max_epochs, seed) -> DataFrame:
    """``docs`` with the plan's columns and ``whole``, ``part``, ``taken``, all under the prefix ``p``."""
    plan = mix_plan(
        docs, id_col=id_col, text_col=text_col, source_col=source_col, weights=weights, max_epochs=max_epochs, seed=seed
    )
    small = plan.count() <= BROADCAST_ROWS
    plan = plan.select(*(F.col(c).alias(f"{p}plan_{c}") for c in plan.columns))
    on = F.col(p + "source").eqNullSafe(F.col(p + "plan_source")) & (F.col(p + "bin") == F.col(p + "plan_bin"))
    joined = _sized(docs, p, id_col, text_col, source_col, seed).join(F.broadcast(plan) if small else plan, on)
    size, edge = F.col(p + "size"), F.col(p + "plan_edge")
    at_edge = F.floor(size * F.col(p + "plan_edge_words") / F.col(p + "plan_edge_size"))
    part = F.when(F.col(p + "hash") < edge, size).when(F.col(p + "hash") == edge, at_edge).otherwise(0).cast("long")
    whole = F.when(size > 0, F.col(p + "plan_whole")).otherwise(0)
    return joined.withColumns({p + "whole": whole, p + "part": part, p + "taken": size * whole + part})


def mix_counts(
    docs: DataFrame, *, id_col="doc_id", text_col="text", source_col="source", weights=WEIGHTS, max_epochs=MAX_EPOCHS, seed=SEED
) -> DataFrame:
    """Per document: id, ``size``, ``source_size``, ``target`` (its source's) and ``taken``, the words the mix takes."""
    p = fresh_prefix(docs)
    mixed = _with_plan(docs.select(id_col, text_col, source_col), p, id_col, text_col, source_col, weights, max_epochs, seed)
    return mixed.select(
        id_col,
        F.col(p + "size").alias("size"),
        F.col(p + "plan_source_size").alias("source_size"),
        F.col(p + "plan_target").alias("target"),
        F.col(p + "taken").alias("taken"),
    )


def mixed_documents(
    docs: DataFrame, *, id_col="doc_id", text_col="text", source_col="source", weights=WEIGHTS, max_epochs=MAX_EPOCHS, seed=SEED
) -> DataFrame:
    """The mix itself: the columns of ``docs`` and ``repetition`` (1, 2, ...), one row per time a document is read.

    A repetition that takes only some of a document's words has these as its text, joined by blanks. An own column named
    ``repetition`` is replaced.
    """
    p = fresh_prefix(docs)
    mixed = _with_plan(docs, p, id_col, text_col, source_col, weights, max_epochs, seed)
    times = F.col(p + "whole") + (F.col(p + "part") > 0).cast("int")
    mixed = mixed.filter(times > 0).withColumn(p + "time", F.explode(F.sequence(F.lit(1).cast("long"), times)))
    cut = (F.col(p + "time") > F.col(p + "whole")) & (F.col(p + "part") < F.col(p + "size"))
    first_words = F.array_join(F.slice(split_words(F.col(text_col)), 1, F.col(p + "part").cast("int")), " ")
    texts = {text_col: F.when(cut, first_words).otherwise(F.col(text_col))}
    own = [texts[c].alias(c) if c in texts else F.col(c) for c in docs.columns if c != "repetition"]
    return mixed.select(*own, F.col(p + "time").cast("int").alias("repetition"))
