"""What several operators of this package share: words, fresh column names, written intermediates, numbering."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

from clickcast.session import scratch_path

# Between words: blank, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    """``text`` with A-Z in lower case and every other character as it is."""
    # Most texts have no other characters; there this is Spark's much faster lower case.
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def spaced(text: Column) -> Column:
    """``text`` with a space for every blank; words between spaces are found without a pattern, in a fraction of the time."""
    lines = F.replace(text, F.lit("\n"), F.lit(" "))
    odd = reduce(Column.__or__, (text.contains(blank) for blank in "\t\v\f\r"))
    return F.when(odd, F.regexp_replace(lines, r"[\x09-\x0D]", " ")).otherwise(lines)


def split_words(text: Column, between: str = BLANKS) -> Column:
    """The words of ``text`` in order, an empty array for null: what lies between matches of ``between``."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), between), "")


def fresh_prefix(*frames: DataFrame) -> str:
    """A prefix that no column of ``frames`` starts with, for helper columns beside the caller's own."""
    prefix, names = "_llm_", [c.lower() for df in frames for c in df.columns]
    while any(c.startswith(prefix) for c in names):
        prefix = "_" + prefix
    return prefix


def written(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """``df`` written once as Parquet below the shared folder and read again: it cuts lineage and outlives executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Keys that are sent to all rows that they select, some 100 MB at most.
BROADCAST_ROWS = 2_000_000


def sent_if_few(keys: DataFrame) -> DataFrame:
    """``keys``, which must be at hand and narrow: to be broadcast if they are few, else left to a shuffle.

    A join that only selects rows then moves no text in the usual case.
    """
    return F.broadcast(keys) if keys.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else keys


def numbered(df: DataFrame, order: Sequence[Column], number: str) -> DataFrame:
    """``df`` with ``number``, 0, 1, 2, ... in ``order``, by a range-partitioned sort; no task sees more than its share.

    Rows that ``order`` does not tell apart are numbered in any order. One row per partition is brought together.
    """
    p = fresh_prefix(df)
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = written(ranged.withColumn(p + "id", F.monotonically_increasing_id()), f"numbered-{uuid.uuid4().hex[:8]}")
    # The id holds the partition in its upper 31 bits and the row within the partition in its lower 33.
    placed = placed.withColumn(p + "part", F.shiftright(p + "id", 33))
    sizes = placed.groupBy(p + "part").agg(F.count("*").alias(p + "size"))
    before = Window.orderBy(p + "part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(p + "part", F.coalesce(F.sum(p + "size").over(before), F.lit(0)).alias(p + "start"))
    row = F.col(p + "id").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.join(starts, p + "part").select(*df.columns, (F.col(p + "start") + row).alias(number))


def in_pandas(rows: DataFrame, function, columns: str) -> DataFrame:
    """``rows.mapInPandas`` with the column ``id`` passed through as text, where its type has one.

    Pandas would make floats of whole numbers that stand beside a null, and 2**53 + 1 would come back as another id.
    """
    kind = rows.schema["id"].dataType
    if not isinstance(kind, AtomicType):
        return rows.mapInPandas(function, f"id {kind.simpleString()}, {columns}")
    found = rows.withColumn("id", F.col("id").cast("string")).mapInPandas(function, f"id string, {columns}")
    return found.withColumn("id", F.col("id").cast(kind))


def held_out(id_: Column) -> Column:
    """Whether a row is held out of every fit: the crc32 of its id as text is divisible by 5. A null id counts as empty."""
    return F.crc32(F.coalesce(id_.cast("string"), F.lit("")).cast("binary")) % 5 == 0
