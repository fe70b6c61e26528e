"""A left join that stays even when a few keys hold most of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, IntegerType, LongType, StringType

from clickcast.session import checkpointed

# A key with this many rows is frequent: its rows should not meet in one task.
HOT_ROWS = 5_000_000
# A table of frequent keys, one column and a mark, is broadcast up to this many of them, some 50 MB; a wider one up to so many
# fewer. A longer one is dealt out with its rows.
BROADCAST_KEYS = 500_000
# Into so many parts the rows of a frequent key are dealt if the frequent keys are too many for a broadcast.
SALTS = 64


def frequent_keys(table: DataFrame, rows: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """The rows of ``table``, one per key, whose count ``rows`` is at least ``hot_rows``.

    There are at most as many as ``hot_rows`` goes into all rows counted: 200,000 for 10^12 rows and the default.
    """
    return table.filter(F.col(rows) >= hot_rows)


def broadcast_rows(columns: int) -> int:
    """How many rows of so many columns are broadcast."""
    return max(1, 2 * BROADCAST_KEYS // max(2, columns))


def not_broadcast(table: DataFrame, rows: int) -> DataFrame:
    """``table``, of at most ``rows`` rows, to be joined by a shuffle if those are too many for a broadcast.

    Spark decides by the size of the file, of which a table of counts takes a few bytes a row, and builds the broadcast of
    200 bytes a row on the driver.
    """
    return table.hint("merge") if rows > broadcast_rows(len(table.columns)) else table


def at_hand(few: DataFrame) -> DataFrame:
    """``few``, expected to have few rows, worked out once: up to BROADCAST_KEYS rows on the driver, more in a checkpoint."""
    rows = few.limit(BROADCAST_KEYS + 1).collect()
    if len(rows) > BROADCAST_KEYS:
        return checkpointed(few)
    return few.sparkSession.createDataFrame(rows, few.schema)


def join_few(df: DataFrame, few: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join ``df``, whose keys may be frequent, with ``few``, a row per frequent key that is at hand without much work.

    ``few`` is counted: up to BROADCAST_KEYS narrow rows are broadcast (see ``broadcast_rows``). Of more, each is copied SALTS times, and the rows of ``df``
    are dealt to the copies by a hash of their content and partition.
    """
    most = broadcast_rows(len(few.columns))
    if few.limit(most + 1).count() <= most:
        return df.join(F.broadcast(few), list(keys), how)
    salted = df.withColumn("_salt", F.pmod(_spread(df), F.lit(SALTS)).cast("int"))
    copies = few.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(copies.hint("merge"), [*keys, "_salt"], how).drop("_salt")


def _spread(df: DataFrame):
    """A hash of content and partition: copies of a row differ, and a task that runs again gives the same."""
    content = [f.name for f in df.schema.fields if isinstance(f.dataType, AtomicType)]
    return F.xxhash64(F.spark_partition_id(), *content)


def spread_join(df: DataFrame, table: DataFrame, frequent: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join of ``df`` with ``table``, which has one row per key.

    ``frequent`` has the columns of ``table`` for the frequent keys (see ``frequent_keys``) and reaches the rows by
    ``join_few``. The rows of those keys, and rows with a null key, need no partner from ``table``: one of their keys is
    replaced, for the shuffle only, by a hash of their content and of the partition they come from. That spreads them,
    copies of one row included, and a task that runs again sends its rows to the same places, as it would not with random
    numbers. All other rows meet ``table`` by key, under the partitioning an aggregation by ``keys`` leaves. Where
    ``table`` is small enough at run time, it is broadcast and nothing is shuffled.
    """
    keys = list(keys)
    values = [c for c in table.columns if c not in keys]
    # The key that is replaced: one whose type holds any positive integer, else one as text.
    wide = (IntegerType, LongType, StringType)
    key = next((k for k in keys if isinstance(df.schema[k].dataType, wide)), keys[0])
    kind = df.schema[key].dataType if isinstance(df.schema[key].dataType, wide) else StringType()
    spread = F.pmod(_spread(df), F.lit(2**31 - 1)).cast(kind)
    no_partner = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys], F.col("_frequent").isNotNull())

    known = frequent.select(*keys, *(F.col(v).alias(f"_known_{v}") for v in values), F.lit(True).alias("_frequent"))
    rows = join_few(df, known, keys)
    rows = rows.withColumn("_key", F.when(no_partner, spread).otherwise(F.col(key).cast(kind)))
    others = [F.col(k) for k in keys if k != key]
    other = table.select(F.col(key).cast(kind).alias("_key"), *others, *(F.col(v).alias(f"_other_{v}") for v in values))
    joined = rows.join(other, ["_key", *(k for k in keys if k != key)], "left")
    # A replaced key may meet a row of ``table`` by chance; what it finds there is not used.
    return joined.select(
        *df.columns,
        *(
            F.when(F.col("_frequent"), F.col(f"_known_{v}")).when(F.col(key).isNotNull(), F.col(f"_other_{v}")).alias(v)
            for v in values
        ),
    )
