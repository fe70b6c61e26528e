"""Sharding: histogram sort into shards of equal bytes.

Documents are ordered by a key: the hash of the text, then that of the id, then one of the row's place in the input, which
tells rows apart that have both in common. A shard is a range of keys, so equal texts lie side by side and a group of them
is cut only where a shard is full. A document belongs to the shard in which its first byte lies when all documents stand in
a row: ``shard = floor(bytes before it * shards / all bytes)``.

The boundaries (splitters) are found on a narrow table of keys and sizes. In each round a few row keys are drawn from every
interval that still holds a splitter, as probes; every partition counts the bytes and rows below each of its probes, the
counts are summed, and the intervals shrink to the two probes around each splitter. A splitter is done when it is within
``tolerance`` bytes of its target, by default when no row lies between. The number of rounds grows with the logarithm of the
rows in a shard. Only then are the rows themselves moved, once: to a task per range, of which a shard has as many as its
bytes need (``range_bytes``); a task sorts its range and numbers the rows. Inner boundaries of a shard only balance tasks,
so a quarter of a range is near enough for them.

What reaches the driver: the totals, ``PROBES`` keys for each boundary still open, and a count for each. There is a boundary
per shard and per ``range_bytes``, of 40 bytes each.

Defined results: a null text is empty, so every row has at least one byte; a null id counts as an empty one; rows alike in
text and id are spread by their place and may lie in several shards; a table with fewer rows than shards leaves some empty;
an empty table gives no rows; the documents' own columns come back in the struct ``row``, whatever their names.
Rows alike in text and id are told apart by ``monotonically_increasing_id``: should a second reading of ``docs`` deal them
out otherwise, the sizes differ from their targets by the noise of a draw among those rows. Slots are counted on what was
written, so they have no gaps in any case.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from clickcast.llm.common import written

SHARDS = 16
# Bytes of text for one task of the exchange.
RANGE_BYTES = 32_000_000
# Keys drawn from an open interval in one round.
PROBES = 64
# Two hashes of 16 bytes and the place of 8.
KEY_BYTES, PLACE_AT = 40, 32


def _text(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def _key(id_col: str, text_col: str) -> Column:
    place = F.unhex(F.lpad(F.hex(F.xxhash64(F.monotonically_increasing_id())), 16, "0"))
    return F.concat(F.unhex(F.md5(_text(text_col).cast("binary"))), F.unhex(F.md5(_text(id_col).cast("binary"))), place)


def _size(text_col: str) -> Column:
    return F.octet_length(_text(text_col)).cast("long") + 1


def _bytes(column: pa.Array) -> np.ndarray:
    """A column of keys as an array of fixed width, which numpy compares byte by byte."""
    kind = f"S{KEY_BYTES}"
    if not len(column):
        return np.empty(0, kind)
    start = column.offset * KEY_BYTES
    return np.frombuffer(column.buffers()[2], kind, len(column), start)


def _draw(keys: np.ndarray, turn: int) -> np.ndarray:
    """A number in [0, 1) per key, the same whenever it is asked for in this round."""
    words = np.frombuffer(keys.tobytes(), ">u8").reshape(len(keys), -1).astype(np.uint64)
    mixed = np.bitwise_xor.reduce(words, 1) * np.uint64(0x9E3779B97F4A7C15 + 2 * turn)
    return (mixed >> np.uint64(11)) / float(1 << 53)


def _counted(probes: list[bytes], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes and rows between neighbouring probes: a row per interval with rows, of the whole partition."""
    edges = np.array(probes, f"S{KEY_BYTES}")
    size, rows = np.zeros(len(probes) + 1, np.int64), np.zeros(len(probes) + 1, np.int64)
    for batch in batches:
        at = np.searchsorted(edges, _bytes(batch.column(0)), "right")
        np.add.at(size, at, batch.column(1).to_numpy())
        rows += np.bincount(at, minlength=len(rows))
    held = np.flatnonzero(rows)
    yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(size[held]), pa.array(rows[held])], ["at", "size", "rows"])


def _drawn(
    intervals: list[tuple[bytes, bytes, float]], turn: int, batches: Iterator[pa.RecordBatch]
) -> Iterator[pa.RecordBatch]:
    """Keys strictly inside the intervals, each taken with its interval's rate."""
    low, high = (np.array([x[i] for x in intervals], f"S{KEY_BYTES}") for i in (0, 1))
    rate = np.array([x[2] for x in intervals])
    for batch in batches:
        keys = _bytes(batch.column(0))
        at = np.searchsorted(low, keys, "left") - 1
        inside = (at >= 0) & (keys < high[at])
        keys, at = keys[inside], at[inside]
        taken = keys[_draw(keys, turn) < rate[at]] if len(keys) else keys
        width = pa.binary(KEY_BYTES)
        fixed = pa.FixedSizeBinaryArray.from_buffers(width, len(taken), [None, pa.py_buffer(taken.tobytes())])
        yield pa.RecordBatch.from_arrays([fixed.cast(pa.binary())], ["key"])


@dataclass(frozen=True)
class Shards:
    """What ``write_shards`` has written: read it with ``read_shards``, from any session, by its folder and schema."""

    folder: str
    schema: StructType
    splitters: Splitters


@dataclass(frozen=True)
class Splitters:
    """The first key of each range but the first, ``ranges`` to a shard; ``rounds`` of counting it took to find them."""

    keys: tuple[bytes, ...]
    ranges: int
    rounds: int

    def place(self, key: Column) -> Column:
        """The range of a key: how many splitters are not above it."""
        edges = np.array(self.keys, f"S{KEY_BYTES}")
        return F.arrow_udf(lambda k: pa.array(np.searchsorted(edges, _bytes(k), "right"), pa.int32()), "int")(key)


# Above every key, for the boundaries after the last row.
END = b"\xff" * KEY_BYTES
BEGIN = b""


def _below(keys: DataFrame, probes: list[bytes]) -> list[tuple[bytes, int, int]]:
    """Each probe with the exact bytes and rows of all partitions below it."""
    if not probes:
        return []
    found = keys.select("key", "size").mapInArrow(lambda x: _counted(probes, x), "at long, size long, rows long")
    summed = {r["at"]: r for r in found.groupBy("at").agg(F.sum("size").alias("size"), F.sum("rows").alias("rows")).collect()}
    below, size, rows = [], 0, 0
    for i, probe in enumerate(probes):
        if i in summed:
            size, rows = size + summed[i]["size"], rows + summed[i]["rows"]
        below.append((probe, size, rows))
    return below


def find_splitters(
    keys: DataFrame, shards: int = SHARDS, range_bytes: int = RANGE_BYTES, tolerance: int = 0
) -> Splitters:
    """Splitters for ``keys`` (``key, size``), a table at hand that is read once or twice a round."""
    total = keys.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("size"), F.count("*").alias("rows")).first()
    ranges = max(1, -(-total["size"] // (shards * range_bytes)))
    n = shards * ranges
    # Of each boundary: the probe below it and the one not below it, with the bytes and rows before them.
    low, high = (BEGIN, 0, 0), (END, total["size"], total["rows"])
    around = {g: (low, high) for g in range(1, n)}
    near = {g: tolerance if g % ranges == 0 else max(tolerance, range_bytes // 4) for g in around}
    open_, turn = set(around) if total["rows"] else set(), 0
    while open_:
        turn += 1
        # Neighbouring boundaries may share an interval: it gets the probes of all of them.
        wanted: dict[tuple[bytes, bytes], list] = {}
        for g in open_:
            (a, _, r), (b, _, s) = around[g]
            wanted.setdefault((a, b), [s - r, 0])[1] += 1
        intervals = [(a, b, min(1.0, PROBES * k / max(1, rows))) for (a, b), (rows, k) in sorted(wanted.items())]
        exhausted = {(a, b) for a, b, rate in intervals if rate >= 1}
        drawn = keys.select("key").mapInArrow(lambda x, i=intervals, t=turn: _drawn(i, t, x), "key binary")
        below = _below(keys, sorted({bytes(r["key"]) for r in drawn.collect()}))
        sizes = np.array([b[1] for b in below], np.int64)
        for g in sorted(open_):
            # The target as a whole number: bytes before a row times n are at least g times all bytes.
            target = -(-g * total["size"] // n)
            i = int(np.searchsorted(sizes, target, "left"))
            old_low, old_high = around[g]
            new_low = max(old_low, below[i - 1]) if i else old_low
            new_high = min(old_high, below[i]) if i < len(below) else old_high
            around[g] = (new_low, new_high)
            alone = new_high[2] - new_low[2] <= (new_low[0] != BEGIN)
            if alone or new_high[1] - target <= near[g] or (old_low[0], old_high[0]) in exhausted:
                open_.remove(g)
    # A boundary done early may stand above a later one, which then serves both: it is not below either target.
    above, found = (END, 0, 0), []
    for g in sorted(around, reverse=True):
        above = min(above, around[g][1])
        found.append(above)
    # The place of a row decides only among rows alike in text and id: where none stands below the splitter, leave it out.
    alike = {key[:PLACE_AT]: rows for key, _, rows in _below(keys, sorted({f[0][:PLACE_AT].ljust(KEY_BYTES, b"\0") for f in found}))}
    firsts = [key[:PLACE_AT].ljust(KEY_BYTES, b"\0") if key != END and alike[key[:PLACE_AT]] == rows else key for key, _, rows in found]
    return Splitters(tuple(reversed(firsts)), ranges, turn)


def write_shards(
    docs: DataFrame,
    folder: str,
    *,
    shards: int = SHARDS,
    id_col="doc_id",
    text_col="text",
    range_bytes: int = RANGE_BYTES,
    tolerance: int = 0,
) -> Shards:
    """``docs`` as Parquet in ``folder``, a folder ``shard=<n>`` per shard, its files in the order of the key.

    Each row is ``row`` (the document), ``size``, ``text_crc32``, ``range`` and ``place``, its number in that range.
    """
    keyed = written(docs.select(_key(id_col, text_col).alias("key"), _size(text_col).alias("size")), "shard-keys")
    splitters = find_splitters(keyed, shards, range_bytes, tolerance)
    rows = docs.select(
        F.struct("*").alias("row"), _key(id_col, text_col).alias("key"), _size(text_col).alias("size"),
        F.crc32(_text(text_col).cast("binary")).alias("text_crc32"),
    )
    rows = rows.withColumn("range", splitters.place(F.col("key")))
    rows = rows.withColumn("shard", F.floor(F.col("range") / splitters.ranges).cast("int"))
    moved = rows.repartitionById(shards * splitters.ranges, F.col("range")).sortWithinPartitions("shard", "range", "key")
    number = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    moved = moved.withColumn("place", number).drop("key")
    moved.write.partitionBy("shard").option("compression", "zstd").parquet(folder)
    return Shards(folder, moved.schema, splitters)


def read_shards(spark: SparkSession, shards: Shards) -> DataFrame:
    """``row, size, text_crc32, shard, slot``: the rows ``write_shards`` has written; ``slot`` numbers those of a shard."""
    rows = spark.read.schema(shards.schema).parquet(shards.folder)
    # A row per range, which says how many rows of its shard stand before it.
    ranges = rows.groupBy("shard", "range").agg(F.count("*").alias("n"), F.min("place").alias("first"))
    before = Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.select("range", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("start"))
    return rows.join(starts, "range").select("row", "size", "text_crc32", "shard", (F.col("place") + F.col("start")).alias("slot"))
