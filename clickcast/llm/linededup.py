"""Line dedup by a tree of log templates.

The tree has a fixed depth: a line goes by its number of words, then by its first ``LEADING`` words, each with a word that
holds a digit as a wildcard. What arrives at a leaf is generalised together: at every place of the line the words of the
leaf are counted, and a place with nearly as many different words as lines is a variable field and becomes a wildcard too.
A template must keep ``LEAST_FIXED`` of its words; a line of a leaf whose lines have less in common is its own template,
with its digits as wildcards. Templates that recur in ``LEAST_DOCS`` documents or more are dropped, wherever they stand.

Copies of a document repeat all its lines, but that is no boilerplate, and near-duplicate detection needs them. So a
document has a family, its component of documents whose sets of word shingles have a similarity of ``FAMILY_SHARED`` in
``FAMILY_OF`` (see ``neardup``), and a template recurs only if it is in ``LEAST_DOCS - 1`` documents, and a quarter of
all it is in, besides those of its largest family. A passage that unrelated documents share makes them no family unless
it is most of their text. Families are sought among the documents with a template that is in ``LEAST_DOCS`` documents.

Leaves with fewer lines than ``LEAST_DOCS`` cannot recur and are left out before any line is shuffled, and lines that begin
like fewer are not even cut into words. Everything is counted by aggregations; no line, leaf or template is ever brought
together with all its documents. Of documents with the same text one is looked up for the family of all.

Defined results: null texts stay null; blank lines and lines of fewer than ``LEAST_WORDS`` words stay; a text all of whose
lines go becomes empty; rows are told apart by id and text, so a null id is an id and documents that share one keep their
own lines; a repeated row counts once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickcast.llm.common import fresh_prefix, sent_if_few, written
from clickcast.llm.neardup import near_duplicates

LEADING = 3
LEAST_WORDS = 4
LEAST_DOCS = 5
LEAST_FIXED = 0.5
# A place is variable if its different words are more than this share of the leaf's lines, and more than MOST_NAMED.
VARIABLE_SHARE, MOST_NAMED = 0.1, 4
# Similarity from which documents are of one family, as a fraction.
FAMILY_SHARED, FAMILY_OF = 60, 100
WILDCARD = "<*>"
# What parts words besides the space, and no lines: tab, vertical tab, form feed, carriage return.
OTHER_BLANKS = r"[\x09\x0B-\x0D]"


def _masked(word: Column) -> Column:
    return F.when(word.rlike("[0-9]"), WILDCARD).otherwise(word)


def _key(id_col: str, text_col: str) -> Column:
    text = F.col(text_col)
    return F.struct(F.col(id_col).alias("id"), F.xxhash64(text).alias("hash"), F.octet_length(text).alias("length"))


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _has_others(part: Column) -> Column:
    """Whether words may be parted by other blanks; a pattern for the four would take Spark many times as long."""
    return reduce(Column.__or__, (part.contains(blank) for blank in "\t\v\f\r"))


def _plain(line: Column) -> Column:
    """``line`` with a space for every blank."""
    return F.when(_has_others(line), F.regexp_replace(line, OTHER_BLANKS, " ")).otherwise(line)


def _words(line: Column) -> Column:
    """The words of a ``_plain`` line, none for null. Spark looks for a space as it is; a pattern it compiles for each line."""
    return F.array_remove(F.split(F.coalesce(line, F.lit("")), " "), "")


def _odd(part: Column) -> Column:
    """Whether words may be parted by something else than single spaces."""
    return part.startswith(" ") | part.endswith(" ") | part.contains("  ")


def _lead(line: Column) -> Column:
    """A hash of the first words of ``line``, which is cut into words only where there is something else between them than a space."""
    first = F.substring_index(line, " ", LEADING)
    first = F.when(_odd(first) | _has_others(first), F.array_join(F.slice(_words(_plain(line)), 1, LEADING), " ")).otherwise(first)
    return F.xxhash64(F.when(first.rlike("[0-9]"), F.regexp_replace(first, "[^ ]*[0-9][^ ]*", WILDCARD)).otherwise(first))


def _leaves(docs: DataFrame, text_col: str, least_lines: int) -> DataFrame:
    """``lead``, a hash of their first words, of the lines of which so many begin alike; others are in no leaf with as many."""
    lines = docs.select(F.explode_outer(_lines(F.col(text_col))).alias("line"))
    counted = lines.select(_lead(F.col("line")).alias("lead")).groupBy("lead").agg(F.count("*").alias("lines"))
    return counted.filter(F.col("lines") >= least_lines).select("lead")


def _lines_of(docs: DataFrame, leaves: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``key, at, line, size, leaf`` of the lines that begin like ``leaves``.

    Their words are parted by single spaces, and one that holds a digit is a wildcard; ``size`` is their number.
    """
    # The key is made before the lines become rows, else it hashes the text once for each of them.
    rows = docs.select(_key(id_col, text_col).alias("key"), _lines(F.col(text_col)).alias("lines"))
    lines = rows.select("key", F.posexplode_outer("lines").alias("at", "line")).withColumn("lead", _lead(F.col("line")))
    # Only lines that begin like one of a leaf are cut into words.
    lines = lines.join(leaves.select("lead").distinct(), "lead", "left_semi").withColumn("line", _plain(F.col("line")))
    lines = lines.withColumn("words", _words(F.col("line")))
    spaced = F.when(_odd(F.col("line")), F.array_join("words", " ")).otherwise(F.col("line"))
    line = F.when(F.col("line").rlike("[0-9]"), F.array_join(F.transform("words", _masked), " ")).otherwise(spaced)
    lines = lines.select("key", "at", line.alias("line"), F.size("words").alias("size"), "lead")
    return lines.select("key", "at", "line", "size", F.xxhash64("size", "lead").alias("leaf"))


def _full(lines: DataFrame, least_lines: int) -> DataFrame:
    """``leaf`` of the leaves with so many lines that are not short."""
    counted = lines.groupBy("leaf").agg(F.count("*").alias("lines"), F.max("size").alias("words"))
    return counted.filter((F.col("lines") >= least_lines) & (F.col("words") >= LEAST_WORDS)).select("leaf")


def _families(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``key, family`` of every document."""
    rows = docs.filter(F.col(text_col).isNotNull()).select(_key(id_col, text_col).alias("key"), F.col(text_col).alias("text"))
    found = near_duplicates(rows, id_col="key", text_col="text", min_shared=FAMILY_SHARED, of=FAMILY_OF)
    return found.select("key", F.xxhash64("component_id").alias("family")).distinct()


def _families_of(members: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``hash, length, family`` of every text of ``members``, which must be at hand."""
    # Equal texts have equal sets, so one document stands for all of its text.
    p = fresh_prefix(docs)
    wanted = members.groupBy("key.hash", "key.length").agg(F.min("key").alias(p + "wanted")).select(p + "wanted")
    wanted = sent_if_few(written(wanted, "lines-wanted"))
    docs = docs.join(wanted, _key(id_col, text_col).eqNullSafe(F.col(p + "wanted")), "left_semi")
    return _families(docs, id_col, text_col).select("key.hash", "key.length", "family")


def _variable_places(lines: DataFrame) -> DataFrame:
    """``leaf, variable``: the places (from 0) of each leaf whose words vary."""
    words = lines.select("leaf", F.posexplode_outer(F.split("line", " ")).alias("place", "word")).filter(F.col("place") >= LEADING)
    named = words.groupBy("leaf", "place", F.xxhash64("word").alias("word")).agg(F.count("*").alias("n"))
    places = named.groupBy("leaf", "place").agg(F.count("*").alias("named"), F.sum("n").alias("lines"))
    places = places.filter((F.col("named") > MOST_NAMED) & (F.col("named") > F.col("lines") * VARIABLE_SHARE))
    # At most one row per place of a line.
    return places.groupBy("leaf").agg(F.collect_set("place").alias("variable"))


def recurring_lines(docs: DataFrame, *, id_col="doc_id", text_col="text", least_docs: int = LEAST_DOCS) -> DataFrame:
    """``key, at``: the places of the lines to drop, by document (id, and hash and length of the text)."""
    leaves = written(_leaves(docs, text_col, least_docs), "lines-leaves")
    lines = written(_lines_of(docs, leaves, id_col, text_col), "lines-kept")
    kept = lines.join(written(_full(lines, least_docs), "lines-full"), "leaf")
    variable = written(_variable_places(kept), "lines-variable")
    placed = kept.join(variable, "leaf", "left").withColumn("words", F.split("line", " "))
    masked = F.transform("words", lambda w, i: F.when(F.array_contains("variable", i), WILDCARD).otherwise(w))
    placed = placed.withColumn("masked", F.when(F.col("variable").isNotNull(), masked))
    fixed = F.size(F.array_remove("masked", WILDCARD))
    general = F.col("masked").isNotNull() & (fixed >= F.size("words") * LEAST_FIXED)
    template = F.when(general, F.xxhash64("leaf", "masked")).otherwise(F.xxhash64("leaf", "words"))
    placed = written(placed.select("key", "at", template.alias("template")), "lines-templates")

    # Templates in fewer documents than needed go before families are looked up.
    by_doc = placed.select("template", "key").distinct()
    often = by_doc.groupBy("template").agg(F.count("*").alias("docs")).filter(F.col("docs") >= least_docs).select("template")
    often = written(often, "lines-often")
    members = written(by_doc.join(often, "template"), "lines-members")
    alike = _families_of(members, docs, id_col, text_col)
    members = members.withColumns({"hash": F.col("key.hash"), "length": F.col("key.length")}).join(alike, ["hash", "length"])
    families = members.groupBy("template", "family").agg(F.count("*").alias("n"))
    totals = families.groupBy("template").agg(F.sum("n").alias("docs"), F.max("n").alias("largest"))
    besides = F.col("docs") - F.col("largest")
    recurring = totals.filter((besides >= least_docs - 1) & (besides * 4 >= F.col("docs"))).select("template")
    return placed.join(written(recurring, "lines-recurring"), "template").select("key", "at")


def _joined(docs: DataFrame, p: str, id_col: str, text_col: str, least_docs: int) -> DataFrame:
    """``docs`` with ``gone``, the places of the dropped lines, and ``left``, the text without them, under the prefix ``p``."""
    found = recurring_lines(docs, id_col=id_col, text_col=text_col, least_docs=least_docs)
    # A document has as many rows here as it has lines to drop.
    found = found.groupBy("key").agg(F.collect_set("at").alias("at")).select(F.col("key").alias(p + "found"), F.col("at").alias(p + "at"))
    # What is found grows with the documents, so it is never broadcast: the plan is the same at every size.
    found = written(found, "lines-found").hint("merge")
    joined = docs.withColumn(p + "key", _key(id_col, text_col)).join(found, F.col(p + "key") == F.col(p + "found"), "left")
    gone = F.coalesce(p + "at", F.array().cast("array<int>"))
    left = F.array_join(F.filter(F.split(F.col(text_col), "\n"), lambda line, i: ~F.array_contains(gone, i)), "\n")
    return joined.withColumns({p + "gone": gone, p + "left": F.when(F.size(gone) > 0, left).otherwise(F.col(text_col))})


def line_counts(docs: DataFrame, *, id_col="doc_id", text_col="text", least_docs: int = LEAST_DOCS) -> DataFrame:
    """Per document: id, ``n_lines``, ``n_dropped`` and ``text``, what is left of it."""
    p = fresh_prefix(docs)
    rows = _joined(docs.select(id_col, text_col), p, id_col, text_col, least_docs)
    n_lines = F.when(F.col(text_col).isNull(), 0).otherwise(F.size(F.split(F.col(text_col), "\n"))).cast("long")
    return rows.select(id_col, n_lines.alias("n_lines"), F.size(p + "gone").cast("long").alias("n_dropped"), F.col(p + "left").alias("text"))


def drop_recurring_lines(
    docs: DataFrame, *, id_col="doc_id", text_col="text", length_col: str | None = None, least_docs: int = LEAST_DOCS
) -> DataFrame:
    """The documents without their recurring lines, with their own columns; ``length_col`` follows the text.

    A document of which nothing but blank is left, though something was there, goes.
    """
    p = fresh_prefix(docs)
    rows = _joined(docs, p, id_col, text_col, least_docs)
    emptied = (F.size(p + "gone") > 0) & (F.trim(F.col(p + "left")) == "")
    new = {text_col: F.col(p + "left")}
    if length_col is not None:
        length = F.when(F.size(p + "gone") > 0, F.length(p + "left")).otherwise(F.col(length_col))
        new[length_col] = length.cast(docs.schema[length_col].dataType)
    return rows.filter(~F.coalesce(emptied, F.lit(False))).select(*(new[c].alias(c) if c in new else F.col(c) for c in docs.columns))
