"""Conversation structure repair: the cheapest edits that make every conversation alternate.

Each row has at most one fault: blank, duplicate (role and text seen earlier in the conversation) or truncated (does not end
in ``. ! ?``). Keeping a row costs nothing, giving it the role user or assistant 1, deleting it 2, inserting an empty row 5;
blank and duplicate rows must go, a truncated one that stays costs 5 more. The initials of the repaired roles must read
``(s?(ua)+)?``. Of the cheapest repairs the one whose edits, as letters ``D I K R``, come first in ASCII order is taken.

Method: Four Russians. What a repair has written so far matters only as one of four states (nothing, s, u, a), so the costs
of finishing from each of them, less their least, form one of a few vectors. For every such vector and every block of
``BLOCK`` rows, as symbols, a table has the vector before the block and what to add. A conversation is read from its end,
a lookup per block. To trace the repair from the front, each block is expanded backward from the vector at its end, row by
row, and in every state the least letter is taken that keeps to the cheapest cost; so ties are settled from the front.

Scale. Rows are put in order by one range-partitioned sort of the whole table, written once; a row's number there orders it.
A conversation is cut into pieces of at most 65,536 rows, wherever the numbers or partitions pass such a mark. Nearly all
have one piece. For the others each piece gives its 4 x 4 table of costs, from the four unit vectors; those are folded into
the vector at the end of each piece, each piece is traced from all four states, and a chain over the pieces picks the one
that applies. So no task holds more than a piece, or one row per piece of a conversation. Duplicates are found by an
aggregation to the first row of each role and text and a join on the row number, so copies never meet either. Texts move
twice: in the sort, and with the audits to where they are applied, by piece (``repaired``) or conversation (``digests``).
The digest of a conversation is one SHA-256 over its texts, and its audit one string: these, by their nature, are made in
one task each; the digest streams and holds one row at a time.

Defined results: nulls in role and text are one space, as text of that kind is blank and a role of that kind is no role to
keep; null conversation ids are one conversation; rows come by turn, nulls first, then by role, the text's first 64
characters and its hash; repeated rows are duplicates; an empty table gives empty tables; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from clickcast.llm.common import written

RETITLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
BLOCK = 4
PIECE_BITS = 16
# States: nothing written, a system row, a user row, an assistant row. What a role that is chosen must be, and leads to.
CHOSEN = ("user", "user", "assistant", "user")
NEXT = (2, 2, 3, 2)
# Where keeping a row of an initial leads from each state; -1: not allowed.
KEPT = {"s": (1, -1, -1, -1), "u": (2, 2, -1, 2), "a": (-1, -1, 3, -1), "x": (-1, -1, -1, -1)}
INITIALS = "suax"
# A row's code: its initial times four plus its fault. As a symbol: 0 must go, else by initial and whether it is truncated.
FAULTS = ("none", "blank", "duplicate", "truncated")
SYMBOLS = 1 + 2 * len(INITIALS)
OF_CODE = np.array([0 if f in (1, 2) else 1 + 2 * i + (f == 3) for i in range(4) for f in range(4)])
NEVER = 1_000_000
# What finishing costs behind the last row.
LAST = (0, 2 * INSERT, INSERT, 0)
UNITS = tuple(tuple(0 if q == r else NEVER for q in range(4)) for r in range(4))


def _with_inserts(costs: list[int]) -> list[int]:
    for _ in range(3):
        costs = [min(costs[q], INSERT + costs[NEXT[q]]) for q in range(4)]
    return [min(c, NEVER) for c in costs]


def _choices(state: int, symbol: int) -> list[tuple[str, int, int]]:
    """``letter, cost, next state`` of what can be done with a row, in ASCII order of the letter."""
    made = [("D", DELETE, state)]
    if symbol:
        extra, to = TRUNCATED * ((symbol - 1) % 2), KEPT[INITIALS[(symbol - 1) // 2]][state]
        if to >= 0:
            made.append(("K", extra, to))
        made.append(("R", RETITLE + extra, NEXT[state]))
    return made


def _before(costs: tuple[int, ...], symbol: int) -> list[int]:
    """The costs of finishing from before a row of ``symbol``, given those from behind it."""
    return _with_inserts([min(cost + costs[to] for _, cost, to in _choices(q, symbol)) for q in range(4)])


def _normal(costs) -> tuple[tuple[int, ...], int]:
    least = min(costs)
    return tuple(NEVER if c >= NEVER // 2 else c - least for c in costs), least


@dataclass(frozen=True)
class Tables:
    """The vectors, and for each with each symbol (``one``) or block (``block``) the vector before it and what is added."""

    vectors: tuple[tuple[int, ...], ...]
    number: dict
    one: list
    one_added: list
    block: np.ndarray
    block_added: np.ndarray


@cache
def tables() -> Tables:
    """Every vector that can be reached from the end of a conversation or a unit vector, and the tables over them."""
    vectors, number, one, added = [], {}, [], []

    def named(vector):
        if vector not in number:
            number[vector] = len(vectors)
            vectors.append(vector)
        return number[vector]

    for start in (LAST, *UNITS):
        named(_normal(start)[0])
    at = 0
    while at < len(vectors):
        steps = [_normal(_before(vectors[at], s)) for s in range(SYMBOLS)]
        one.append([named(v) for v, _ in steps])
        added.append([least for _, least in steps])
        at += 1
    # A block's number has its first row as the highest digit; it is read from its last row on.
    step, plus = np.array(one), np.array(added)
    block, block_added = step, plus
    for _ in range(BLOCK - 1):
        first = step[block]
        block_added = (block_added[:, :, None] + plus[block]).transpose(0, 2, 1).reshape(len(vectors), -1)
        block = first.transpose(0, 2, 1).reshape(len(vectors), -1)
    return Tables(tuple(vectors), number, one, added, block, block_added)


class Piece:
    """The symbols of consecutive rows, read from the end with the costs behind them."""

    def __init__(self, symbols: np.ndarray, costs: tuple[int, ...]):
        t = tables()
        vector, least = _normal(costs)
        self.symbols = symbols.tolist()
        # Rows that fill no block stand at the front, as a shorter one.
        self.rest = len(symbols) % BLOCK
        blocks = symbols[self.rest :].reshape(-1, BLOCK) @ (SYMBOLS ** np.arange(BLOCK - 1, -1, -1))
        now = t.number[vector]
        self.ends = [now]
        for b in blocks[::-1].tolist():
            least += int(t.block_added[now, b])
            now = int(t.block[now, b])
            self.ends.append(now)
        self.ends.reverse()
        for s in reversed(self.symbols[: self.rest]):
            least += t.one_added[now][s]
            now = t.one[now][s]
        self.costs = tuple(least + c for c in t.vectors[now])

    def trace(self, state: int) -> tuple[str, int]:
        """The edits from a state, and the state they lead to."""
        t, letters = tables(), []
        starts = [0, *range(self.rest, len(self.symbols), BLOCK)] if self.rest else [*range(0, len(self.symbols), BLOCK)]
        ends = self.ends if self.rest else self.ends[1:]
        for start, end in zip(starts, ends):
            rows = self.symbols[start : start + (self.rest if self.rest and not start else BLOCK)]
            # Expand the block: the vector before each of its rows, from the last to the first.
            before = [end]
            for s in reversed(rows):
                before.append(t.one[before[-1]][s])
            before.reverse()
            for i, s in enumerate(rows):
                here, behind, plus = t.vectors[before[i]], t.vectors[before[i + 1]], t.one_added[before[i + 1]][s]
                while True:
                    letter, to = next(
                        (x, to) for x, cost, to in _with_insert(state, s, here) if cost + _value(x, here, behind, plus)[to] == here[state]
                    )
                    letters.append(letter)
                    state = to
                    if letter != "I":
                        break
        return "".join(letters), state


def _with_insert(state: int, symbol: int, here: tuple[int, ...]) -> list[tuple[str, int, int]]:
    delete, *rest = _choices(state, symbol)
    return [delete, ("I", INSERT, NEXT[state]), *rest]


def _value(letter: str, here: tuple[int, ...], behind: tuple[int, ...], plus: int) -> list[int]:
    """The costs of finishing after an edit, on the scale of the vector before the row."""
    return list(here) if letter == "I" else [c - plus for c in behind]


def finish(state: int) -> str:
    """The rows to insert behind the last one."""
    letters = ""
    while LAST[state]:
        letters, state = letters + "I", NEXT[state]
    return letters


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode(), np.uint8).astype(np.int64) - ord("A")


# Rows in order


def ordered_rows(rows: DataFrame, *, conv_col="conv_id", turn_col="turn", role_col="role", text_col="text") -> DataFrame:
    """``conv`` (the id in a struct), ``id`` (orders all rows), ``turn, role, text``: written."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(" "))
    made = rows.select(
        F.struct(F.col(conv_col).alias("id")).alias("conv"), F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit(" ")).alias("role"), text.alias("text"),
        F.xxhash64(F.monotonically_increasing_id()).alias("spread"),
    )
    order = [
        F.col("conv.id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", F.substring("text", 1, 64),
        F.md5(F.col("text").cast("binary")), "spread",
    ]
    ranged = made.repartitionByRange(*order).sortWithinPartitions(*order).drop("spread")
    return written(ranged.withColumn("id", F.monotonically_increasing_id()), "conversation-rows")


BLANK_CHARS = " \t\n\x0b\x0c\r"


def _classified(placed: DataFrame) -> DataFrame:
    """``conv, id, turn, fault, code`` per row: the code as a letter from A on."""
    last = F.right(F.rtrim("text", F.lit(BLANK_CHARS)), F.lit(1))
    same = F.md5(F.concat(F.octet_length("role"), F.lit(":"), "role", "text").cast("binary"))
    narrow = placed.select("conv", "id", "turn", F.left("role", F.lit(1)).alias("initial"), last.alias("last"), same.alias("same"))
    first = narrow.filter("last <> ''").groupBy("conv", "same").agg(F.min("id").alias("id")).select("id", F.lit(True).alias("first"))
    fault = F.when(F.col("last") == "", 1).when(F.col("first").isNull(), 2).when(~F.col("last").isin(*".!?"), 3).otherwise(0)
    initial = F.when(F.col("initial") == "s", 0).when(F.col("initial") == "u", 1).when(F.col("initial") == "a", 2).otherwise(3)
    marked = narrow.join(first, "id", "left").withColumn("fault", fault)
    return marked.select("conv", "id", "turn", "fault", F.char(ord("A") + 4 * initial + F.col("fault")).alias("code"))


def _piece(id_: Column) -> Column:
    return F.shiftright(id_, PIECE_BITS)


def _pieces(rows: DataFrame) -> DataFrame:
    listed = F.array_sort(F.collect_list(F.struct("id", "code")))
    found = rows.groupBy("conv", _piece(F.col("id")).alias("piece")).agg(listed.alias("l"))
    return found.select("conv", "piece", F.array_join(F.transform("l", lambda x: x["code"]), "").alias("codes"))


def _costs_between(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per piece its costs from each state to each."""
    for batch in batches:
        rows = []
        for codes in batch.column(2):
            symbols = OF_CODE[codes_of(codes.as_py())]
            by_end = [Piece(symbols, unit).costs for unit in UNITS]
            rows.append([by_end[r][q] for q in range(4) for r in range(4)])
        columns = [batch.column(0), batch.column(1), pa.array(rows, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, ["conv", "piece", "between"])


def _fold(pieces: pd.DataFrame) -> pd.DataFrame:
    """The costs of finishing from behind each piece of a conversation."""
    pieces = pieces.sort_values("piece").reset_index(drop=True)
    behind, costs = [], list(LAST)
    for between in reversed(pieces["between"].tolist()):
        behind.append(costs)
        costs = [min(between[4 * q + r] + costs[r] for r in range(4)) for q in range(4)]
    pieces["behind"] = behind[::-1]
    pieces["first"] = pieces.index == 0
    pieces["final"] = pieces.index == len(pieces) - 1
    return pieces[["conv_id", "piece", "behind", "first", "final"]]


def _illegal(initials: str) -> int:
    return sum(initials[i : i + 2] not in ("su", "ua", "au") for i in range(len(initials) - 1))


def _traced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per piece and state it may begin in: the edits, the state behind them and the costs."""
    for batch in batches:
        audits, states, costs, illegal, edges = [], [], [], [], []
        for codes, behind, final in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4))):
            found = codes_of(codes)
            piece = Piece(OF_CODE[found], tuple(behind) if behind is not None else LAST)
            # A conversation of one piece begins with nothing.
            traces = [piece.trace(q) for q in range(4 if behind is not None else 1)]
            audits.append([a + (finish(q) if final else "") for a, q in traces])
            states.append([q for _, q in traces])
            costs.append(list(piece.costs))
            initials = "".join(INITIALS[c // 4] for c in found.tolist())
            illegal.append(_illegal(initials))
            edges.append(initials[0] + initials[-1])
        arrays = [
            batch.column(0), batch.column(1), pa.array(audits, pa.list_(pa.string())), pa.array(states, pa.list_(pa.int32())),
            pa.array(costs, pa.list_(pa.int64())), pa.array(illegal, pa.int64()), pa.array(edges, pa.string()),
        ]
        yield pa.RecordBatch.from_arrays(arrays, ["conv", "piece", "audits", "states", "costs", "illegal", "edges"])


def _chain(pieces: pd.DataFrame) -> pd.DataFrame:
    """The state in which each piece of a conversation begins, and whether the rows where it meets the last one may."""
    pieces = pieces.sort_values("piece").reset_index(drop=True)
    begin, meets, state, last = [], [], 0, ""
    for states, edges in zip(pieces["states"], pieces["edges"]):
        begin.append(state)
        meets.append(_illegal(last + edges[0]))
        state, last = int(states[state]), edges[1]
    pieces["begin"], pieces["meets"] = begin, meets
    return pieces[["conv_id", "piece", "begin", "meets"]]


@dataclass(frozen=True)
class Repair:
    """``rows`` as ``ordered_rows`` has them; ``classified``; ``edits``: ``conv, piece, begin, audit, cost, illegal``."""

    rows: DataFrame
    classified: DataFrame
    edits: DataFrame


def _by_conversation(df: DataFrame, function, schema: str) -> DataFrame:
    """``function`` over the pieces of each conversation, with the id as a plain column; back with ``conv``."""
    kind = df.schema["conv"].dataType["id"].dataType.simpleString()
    plain = df.withColumn("conv_id", F.col("conv.id")).drop("conv")
    made = plain.groupBy("conv_id").applyInPandas(lambda _, x: function(x), f"conv_id {kind}, {schema}")
    return made.withColumn("conv", F.struct(F.col("conv_id").alias("id"))).drop("conv_id")


def find_repair(rows: DataFrame, **columns) -> Repair:
    """The edits for every conversation of ``rows``."""
    placed = ordered_rows(rows, **columns)
    classified = written(_classified(placed), "conversation-codes")
    pieces = written(_pieces(classified), "conversation-pieces")
    conv = placed.schema["conv"].dataType.simpleString()
    several = pieces.groupBy("conv").agg(F.count("*").alias("n")).filter("n > 1").select("conv")
    between = pieces.join(several, "conv", "left_semi").mapInArrow(
        _costs_between, f"conv {conv}, piece long, between array<long>"
    )
    ends = _by_conversation(between, _fold, "piece long, behind array<long>, first boolean, final boolean")
    known = pieces.join(ends, ["conv", "piece"], "left").select(
        "conv", "piece", "codes", "behind", F.coalesce("final", F.lit(True)).alias("final")
    )
    kinds = "piece long, audits array<string>, states array<int>, costs array<long>, illegal long, edges string"
    traced = written(known.mapInArrow(_traced, f"conv {conv}, {kinds}"), "conversation-edits")
    parts = traced.filter(F.size("audits") > 1).select("conv", "piece", "states", "edges")
    begins = _by_conversation(parts, _chain, "piece long, begin int, meets long")
    begin = F.coalesce("begin", F.lit(0))
    edits = traced.join(begins, ["conv", "piece"], "left").select(
        "conv", "piece", begin.alias("begin"), F.get("audits", begin).alias("audit"), F.get("costs", begin).alias("cost"),
        (F.col("illegal") + F.coalesce("meets", F.lit(0))).alias("illegal"),
    )
    return Repair(placed, classified, edits)


def _with_edits(repair: Repair, *keys: str) -> DataFrame:
    """Rows and, before those of each piece, its edits; what has ``keys`` in common is in one partition, in order."""
    none = F.lit(None)
    edits = repair.edits.select(
        "conv", F.shiftleft("piece", PIECE_BITS).alias("id"), "audit", "begin", none.cast("string").alias("role"),
        none.cast("string").alias("text"), "piece", F.lit(0).alias("kind"),
    )
    rows = repair.rows.select(
        "conv", "id", none.cast("string").alias("audit"), none.cast("int").alias("begin"), "role", "text",
        _piece(F.col("id")).alias("piece"), F.lit(1).alias("kind"),
    )
    both = edits.unionByName(rows).repartition(*keys).sortWithinPartitions("conv", "id", "kind")
    return both.select("conv", "id", "audit", "begin", "role", "text")


class _Editor:
    """Applies the edits of pieces to their rows, which come one by one, each piece's edits first."""

    def begin(self, audit: str, state: int) -> None:
        self.letters, self.state = iter(audit), state
        self.left = len(audit) - audit.count("I")

    def _chosen(self, text: str) -> tuple[str, str]:
        role, self.state = CHOSEN[self.state], NEXT[self.state]
        return role, text

    def row(self, role: str, text: str) -> list[tuple[str, str]]:
        """What takes the place of a row: rows inserted before it, itself, and behind the last row what is inserted there."""
        made = []
        for letter in self.letters:
            if letter == "I":
                made.append(self._chosen(""))
                continue
            if letter == "K":
                made.append((role, text))
                self.state = KEPT[role[0]][self.state]
            elif letter == "R":
                made.append(self._chosen(text))
            break
        self.left -= 1
        if not self.left:
            made += [self._chosen("") for _ in self.letters]
        return made


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, int, list[tuple[str, str]]]]:
    """Per row its conversation, its number and what takes its place."""
    editor = _Editor()
    for batch in batches:
        for conv, id_, audit, begin, role, text in zip(*(c.to_pylist() for c in batch.columns)):
            if audit is not None:
                editor.begin(audit, begin)
            else:
                yield conv, id_, editor.row(role, text)


# Rows of an output batch.
BATCH_ROWS = 1000


def _packed(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == BATCH_ROWS:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def repaired(repair: Repair) -> DataFrame:
    """The repaired conversations: ``conv`` (the id in a struct), ``place`` and ``part``, which order the rows, ``role, text``.

    Rows inserted beside a row have its ``place`` and a ``part`` of their own.
    """
    made = f"conv {repair.rows.schema['conv'].dataType.simpleString()}, place long, part int, role string, text string"
    schema = _arrow(made)

    def rows(batches):
        edited = ((c, i, n, *line) for c, i, lines in _edited(batches) for n, line in enumerate(lines))
        return _packed(edited, schema)

    return _with_edits(repair, "conv", "piece").mapInArrow(rows, made)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, str]]:
    last, digest, empty = None, None, True
    for conv, _, lines in _edited(batches):
        if conv != last:
            if last is not None:
                yield last, digest.hexdigest()
            last, digest, empty = conv, hashlib.sha256(), True
        for role, text in lines:
            digest.update(f"{role}:{text}".encode() if empty else f"\n{role}:{text}".encode())
            empty = False
    if last is not None:
        yield last, digest.hexdigest()


def digests(repair: Repair) -> DataFrame:
    """``conv, repaired_sha256``: of the repaired rows of a conversation as ``role:text``, a line each."""
    made = f"conv {repair.rows.schema['conv'].dataType.simpleString()}, repaired_sha256 string"
    schema = _arrow(made)
    return _with_edits(repair, "conv").mapInArrow(lambda batches: _packed(_hashed(batches), schema), made)


def _arrow(columns: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(columns))


def report(repair: Repair) -> DataFrame:
    """Per conversation ``conv, gaps, blank, duplicate, truncated, illegal, cost, audit``."""
    fault = F.col("fault")
    gaps = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    counts = repair.classified.groupBy("conv").agg(
        F.coalesce(gaps, F.lit(0)).cast("long").alias("gaps"),
        *(F.count_if(fault == i).alias(name) for i, name in enumerate(FAULTS) if i),
    )
    ordered = F.array_sort(F.collect_list(F.struct("piece", "audit")))
    edits = repair.edits.groupBy("conv").agg(
        F.sum("illegal").alias("illegal"), F.min_by("cost", "piece").alias("cost"), ordered.alias("l")
    )
    audit = F.array_join(F.transform("l", lambda x: x["audit"]), "")
    return counts.join(edits.withColumn("audit", audit).drop("l"), "conv")
