"""Near-duplicate documents by SetSketch registers.

A document's set is its distinct word shingles. Sets that are equal become one class first, so copies cost one
aggregation however many there are. Each class has a SetSketch: ``REGISTERS`` registers, each the exponentially spaced,
truncated minimum of an exponential hash over the set; the sketch of a union is the registers' maxima. Registers of two
sets are equal with a probability near their Jaccard similarity, so bands of registers, equal as a whole, name the
candidates: with 20 bands of 4, a pair at similarity 0.8 is missed with probability (1 - 0.8^4)^20 = 3e-5, at 0.85 4e-7. For a
candidate pair the similarity is estimated by maximum likelihood from how many registers are greater, equal and less,
jointly with the known set sizes; far too dissimilar pairs go, every other pair is verified on the full sets.

Pairs of a bucket are not enumerated. First every member meets one other, the smallest of the smallest members of its
buckets (ids are hashes, so that is a random choice), and what is linked becomes one component; this settles nearly every
group. In buckets that still
hold several components, all pairs across components are tested, in blocks: a bucket is dealt into chunks of at most
``CHUNK`` members, and a task gets two chunks, compares their sketches as matrices, verifies likely pairs on the full sets
and returns the links it needs. A pair is tested in the first band it shares and nowhere else. So buckets have no cap, no
task gets more than two chunks, and no table of pairs is ever made; the work is quadratic only in members that are alike
in a band, yet not linked.

Defined results: null, empty or blank texts have an empty set, no link, and stand for themselves; documents that share an
id and differ in text each have their own set, and stand and fall with their components; a null id never names a
component that has another id. Sets are of 64-bit hashes of shingles. ``drop_near_duplicates`` knows rows by id and text
and keeps one row of each component.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickcast.llm.common import fresh_prefix, lower_ascii, sent_if_few, spaced, split_words
from clickcast.llm.common import written as written_as

# Words of a shingle, and the similarity from which documents are linked, as a fraction.
SHINGLE = 5
MIN_SHARED, OF = 80, 100
BANDS, ROWS = 20, 4
REGISTERS = BANDS * ROWS
# SetSketch parameters: base of the spacing, rate of the exponential hash, largest register.
BASE, RATE, TOP = 1.001, 20.0, 65535
# A pair is verified unless the likelihood of its estimate exceeds that of the threshold by this factor's logarithm.
PRUNE = 10.0
# Pairs with fewer equal registers are not worth an estimate: of 80, 64 are expected at a similarity of 0.8, and fewer
# than 40 have a probability of some 1e-8.
LEAST_EQUAL = 40
# Members of a chunk, and shingles of all its members together, at most.
CHUNK, CHUNK_SHINGLES = 1024, 2_000_000
# Elements hashed at a time; their intermediate values stay in the processor's cache.
BLOCK = 16_384

# Hashes do not compress.
written = partial(written_as, compression="uncompressed")

_rng = np.random.default_rng(4242)
_FACTORS = _rng.integers(0, 2**63, REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADDENDS = _rng.integers(0, 2**64, REGISTERS, dtype=np.uint64)
_MIX = _rng.integers(0, 2**63, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX[6]
    x = (x ^ (x >> np.uint64(29))) * _MIX[7]
    return x ^ (x >> np.uint64(32))


def shingle_sets(words: np.ndarray, ends: np.ndarray, size: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each document, from the word hashes of all, one document after the other."""
    words = words.astype(np.uint64, copy=False)
    hashed = words * _MIX[0]
    for i in range(1, size):
        hashed = hashed[: max(len(words) - i, 0)] * _MIX[0] + words[i:]
    hashed = _mixed(hashed)
    sets, start = [], 0
    for end in ends:
        if end - start >= size:
            sets.append(np.unique(hashed[start : end - size + 1]))
        elif end > start:
            whole = np.array([end - start], np.uint64)
            for i in range(start, end):
                whole = whole * _MIX[1] + words[i : i + 1]
            sets.append(_mixed(whole))
        else:
            sets.append(np.zeros(0, np.uint64))
        start = end
    return sets


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """The registers of each non-empty set, one row per set."""
    smallest = np.empty((len(sets), REGISTERS), np.uint64)
    smallest[:] = np.uint64(2**64 - 1)
    group, elements = [], 0
    for i, s in enumerate(sets):
        for start in range(0, len(s), BLOCK):
            part = s[start : start + BLOCK]
            if elements + len(part) > BLOCK:
                _minima(group, smallest)
                group, elements = [], 0
            group.append((i, part))
            elements += len(part)
    _minima(group, smallest)
    uniform = np.clip((smallest.astype(np.float64) + 0.5) / 2.0**64, 1e-300, 1 - 1e-12)
    exponential = -np.log1p(-uniform) / RATE
    return np.clip(np.floor(1 - np.log(exponential) / np.log(BASE)), 0, TOP).astype(np.uint16)


def _minima(group: list, smallest: np.ndarray) -> None:
    if not group:
        return
    flat = np.concatenate([part for _, part in group])
    starts = np.cumsum([0, *(len(part) for _, part in group[:-1])])
    rows = np.array([i for i, _ in group])
    for r in range(REGISTERS):
        found = np.minimum.reduceat(flat * _FACTORS[r] + _ADDENDS[r], starts)
        np.minimum.at(smallest[:, r], rows, found)


def band_keys(registers: np.ndarray) -> np.ndarray:
    """One 64-bit key per band."""
    bands = registers.reshape(len(registers), BANDS, ROWS).astype(np.uint64)
    keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * _MIX[2], bands.shape[:2])
    for r in range(ROWS):
        keys = _mixed(keys * _MIX[3] + bands[:, :, r])
    return keys


def _node(shingles: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def _flat(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    offsets = column.offsets.to_numpy()
    return column.flatten().to_numpy(zero_copy_only=False).view(np.uint64), offsets[1:] - offsets[0]


def _lists(rows: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, rows)])
    values = np.concatenate(rows).view(np.int64) if rows else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))


# Word hashes handled at a time, however many a batch brings.
_SLICE = 250


def _sketch_batches(size: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["id", "n_shingles", "node", "bands", "registers"]
    for whole in batches:
        for at in range(0, whole.num_rows, _SLICE):
            batch = whole.slice(at, _SLICE)
            sets = shingle_sets(*_flat(batch.column(1)), size)
            registers = sketches(sets)
            nodes = [_node(s) if len(s) else None for s in sets]
            columns = [
                batch.column(0),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array(nodes, pa.int64()),
                _lists(list(band_keys(registers))),
                pa.array([r.tobytes() for r in registers], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)


def _set_batches(size: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, _SLICE):
            sets = shingle_sets(*_flat(whole.slice(at, _SLICE).column(0)), size)
            nodes = pa.array([_node(s) if len(s) else None for s in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([nodes, _lists(sets)], ["node", "shingles"])


def log_likelihood(similarity, greater, less, equal, u, v) -> np.ndarray:
    """Of a Jaccard similarity, given how many registers of the first sketch are greater, less and equal.

    ``u`` and ``v`` are the sets' shares of the sum of their sizes. A register is greater with probability
    ``p(u - v * similarity)``, less with ``p(v - u * similarity)``, where ``p(x) = -log_b(1 - x * (b - 1) / b)``.
    """
    p = lambda x: -np.log1p(-np.clip(x, 1e-12, 1) * (BASE - 1) / BASE) / np.log(BASE)
    more, fewer = p(u - v * similarity), p(v - u * similarity)
    return greater * np.log(more) + less * np.log(fewer) + equal * np.log(np.clip(1 - more - fewer, 1e-12, 1))


def hopeless(greater, less, equal, n_first, n_second, threshold: float) -> np.ndarray:
    """Which pairs of sketches are so unlike that a similarity of ``threshold`` or more can be ruled out."""
    u = n_first / (n_first + n_second)
    v = 1 - u
    top = np.minimum(u / v, v / u)
    low, high = np.zeros(len(u)), top.copy()
    for _ in range(14):
        a, b = low + (high - low) / 3, high - (high - low) / 3
        rising = log_likelihood(a, greater, less, equal, u, v) < log_likelihood(b, greater, less, equal, u, v)
        low, high = np.where(rising, a, low), np.where(rising, high, b)
    best = (low + high) / 2
    at = log_likelihood(np.minimum(threshold, top), greater, less, equal, u, v)
    behind = log_likelihood(best, greater, less, equal, u, v) - at > PRUNE
    # The sizes alone bound the similarity by the smaller over the larger.
    return (top < threshold - 1e-9) | ((best < threshold) & behind)


def _registers(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(len(column), REGISTERS)


def _likely_batches(threshold: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        first, second = _registers(batch.column(2)), _registers(batch.column(3))
        sizes = [batch.column(i).to_numpy().astype(np.float64) for i in (4, 5)]
        greater, less = (first > second).sum(1), (first < second).sum(1)
        likely = pa.array(~hopeless(greater, less, REGISTERS - greater - less, *sizes, threshold))
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(likely), batch.column(1).filter(likely)], ["a", "b"])


def likely_pairs(registers, sizes, components, chunks, key: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Places of the likely pairs of a block: of two chunks, or within one; of two components; first alike in band ``key``."""
    keys = band_keys(registers)
    band = int(np.argmax(keys[0].view(np.int64) == key))
    one = np.flatnonzero(chunks == chunks.min())
    two = np.flatnonzero(chunks == chunks.max())
    found = []
    for start in range(0, len(one), 64):
        rows = one[start : start + 64]
        i, j = (x.ravel() for x in np.meshgrid(rows, two, indexing="ij"))
        worth = components[i] != components[j]
        if one is two or chunks[one[0]] == chunks[two[0]]:
            worth &= i < j
        small, large = np.minimum(sizes[i], sizes[j]), np.maximum(sizes[i], sizes[j])
        i, j = (x[worth & (small >= threshold * large - 1e-9)] for x in (i, j))
        equal = np.array([], int)
        if len(i):
            equal = np.concatenate([(registers[a] == registers[b]).sum(1) for a, b in _pieces(i, j)])
        i, j = i[equal >= LEAST_EQUAL], j[equal >= LEAST_EQUAL]
        if not len(i):
            continue
        greater = np.concatenate([(registers[a] > registers[b]).sum(1) for a, b in _pieces(i, j)])
        equal = equal[equal >= LEAST_EQUAL]
        keep = ~hopeless(greater, REGISTERS - greater - equal, equal, sizes[i], sizes[j], threshold)
        keep &= np.argmax(keys[i] == keys[j], axis=1) == band
        found.append((i[keep], j[keep]))
    return tuple(np.concatenate(x) if found else np.zeros(0, int) for x in (zip(*found) if found else ((), ())))


def _pieces(i: np.ndarray, j: np.ndarray, size: int = 16_384) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    return ((i[s : s + size], j[s : s + size]) for s in range(0, len(i), size))


def _block(table: pa.Table, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    columns = {n: table[n].to_numpy() for n in ("n_shingles", "component", "chunk")}
    registers = _registers(table["registers"])
    sizes = columns["n_shingles"].astype(np.float64)
    return likely_pairs(registers, sizes, columns["component"], columns["chunk"], table["key"][0].as_py(), threshold)


def _likely_members(threshold: float, table: pa.Table) -> pa.Table:
    """The members of a block that have a likely partner in it."""
    i, j = _block(table, threshold)
    return table.take(pa.array(np.unique(np.concatenate([i, j]))))


def _block_links(threshold: float, shared: int, of: int, table: pa.Table) -> pa.Table:
    """Links that join the components of a block, verified on the full sets."""
    i, j = _block(table, threshold)
    nodes, components = table["node"].to_numpy(), table["component"].to_numpy().copy()
    sets = [np.asarray(s.values).view(np.uint64) for s in table["shingles"]]
    links = []
    for a, b in zip(i.tolist(), j.tolist(), strict=True):
        if components[a] == components[b]:
            continue
        common = _common(sets[a], sets[b])
        if common * of >= (len(sets[a]) + len(sets[b]) - common) * shared:
            links.append((nodes[a], nodes[b]))
            components[components == components[b]] = components[a]
    rows = np.array(links, np.int64).reshape(len(links), 2)
    return pa.table({"a": rows[:, 0], "b": rows[:, 1]})


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """How many elements two sorted arrays without repeats share."""
    at = np.searchsorted(a, b)
    at[at == len(a)] = len(a) - 1
    return int((a[at] == b).sum())


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (its smallest node) for the nodes of ``edges`` (``a, b``).

    Each step takes the smallest label among the neighbours and then the label of that label, so paths halve. Labels only
    fall: when no neighbour has a smaller one, they are final.
    """
    both = written(edges.union(edges.select("b", "a")).toDF("a", "b").distinct(), "cc-edges")
    labels = written(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("label")).withColumnRenamed("a", "node"), "cc-labels")
    while True:
        around = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("around"))
        hooked = labels.join(around, F.col("node") == F.col("a"))
        hooked = written(hooked.select("node", "label", F.least("label", "around").alias("hooked")), "cc-hooked")
        if hooked.filter("label != hooked").isEmpty():
            return labels.withColumnRenamed("label", "component")
        onward = hooked.select(F.col("node").alias("at"), F.col("hooked").alias("onward"))
        labels = written(hooked.join(onward, F.col("hooked") == F.col("at")).select("node", F.col("onward").alias("label")), "cc-labels")


class _Search:
    """The search through the buckets of one run."""

    def __init__(self, docs: DataFrame, classes: DataFrame, size: int, shared: int, of: int):
        self.docs, self.classes, self.size, self.shared, self.of = docs, classes, size, shared, of
        keys = classes.select(F.explode("bands").alias("key"), "node")
        several = keys.groupBy("key").agg(F.count("*").alias("members")).filter("members > 1")
        self.rows = written(keys.join(several, "key").select("key", "node"), "dup-buckets")
        self.joined = written(classes.limit(0).select("node", F.col("node").alias("component")), "dup-components")

    def _open(self) -> DataFrame | None:
        """Members of the buckets that hold several components, with ``component`` and their bucket's ``first``."""
        now = self.rows.join(self.joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
        now = written(now.select("key", "node", "component"), "dup-open")
        state = now.groupBy("key").agg(
            F.min(F.struct("node", "component")).alias("first"), F.min("component").alias("low"), F.max("component").alias("high")
        )
        state = written(state.filter("low < high").select("key", "first"), "dup-state")
        if state.isEmpty():
            return None
        rows = now.join(state, "key")
        self.rows = rows.select("key", "node")
        return rows

    def run(self) -> DataFrame:
        """``node, component`` of every class that is linked with another."""
        if (rows := self._open()) is None:
            return self.joined
        # One pair per member: the smallest of the leaders of its buckets.
        across = rows.filter(F.col("component") != F.col("first.component"))
        pairs = across.groupBy("node").agg(F.min("first.node").alias("a")).select("a", F.col("node").alias("b"))
        self._link(self._verified(self._likely(pairs)))
        if (rows := self._open()) is not None:
            self._link(self._links_in_blocks(rows.select("key", "node", "component")))
        return self.joined

    def _links_in_blocks(self, rows: DataFrame) -> DataFrame:
        shared, of, threshold = self.shared, self.of, self.shared / self.of

        def members(table: pa.Table) -> pa.Table:
            return _likely_members(threshold, table)

        def links(table: pa.Table) -> pa.Table:
            return _block_links(threshold, shared, of, table)

        rows = rows.join(self.classes.select("node", "n_shingles", "registers"), "node")
        rows = written(rows, "dup-members")
        size = rows.groupBy("key").agg(F.count("*").alias("members"), F.sum("n_shingles").alias("shingles"))
        chunks = F.ceil(F.greatest(F.col("members") / CHUNK, F.col("shingles") / CHUNK_SHINGLES)).cast("int")
        rows = rows.join(written(size.select("key", chunks.alias("chunks")), "dup-chunks"), "key")
        # A chunk meets itself and every other.
        rows = rows.withColumn("chunk", F.pmod(F.hash("node"), F.col("chunks")))
        meets = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
        rows = rows.select("key", "node", "component", "n_shingles", "registers", "chunk", meets.alias("other"))
        rows = rows.withColumns({"low": F.least("chunk", "other"), "high": F.greatest("chunk", "other")}).drop("other")
        likely = rows.groupBy("key", "low", "high").applyInArrow(members, rows.schema)
        likely = written(likely, "dup-block-members")
        # Each set is sent to the blocks in which its document has a likely partner.
        sets = self._sets(likely.select("node").distinct()).select("node", "shingles")
        blocks = likely.join(sets, "node").groupBy("key", "low", "high")
        linked = blocks.applyInArrow(links, "a long, b long")
        return linked.distinct()

    def _likely(self, pairs: DataFrame) -> DataFrame:
        known = self.classes.select("node", "registers", F.col("n_shingles").cast("double").alias("n"))
        a, b = (known.toDF(c, f"registers_{c}", f"n_{c}") for c in "ab")
        both = pairs.join(b, "b").join(a, "a").select("a", "b", "registers_a", "registers_b", "n_a", "n_b")
        return written(both.mapInArrow(partial(_likely_batches, self.shared / self.of), "a long, b long"), "dup-likely")

    def _sets(self, nodes: DataFrame) -> DataFrame:
        """``node, shingles, n_shingles`` of the given classes: their full sets, made anew for one document of each."""
        nodes = written(nodes.join(self.classes.select("node", "id", "n_shingles"), "node"), "dup-nodes")
        wanted = nodes.select(F.col("id").alias("wanted")).distinct()
        texts = self.docs.join(sent_if_few(wanted), F.col("id").eqNullSafe(F.col("wanted")), "left_semi")
        sets = _word_hashes(texts).mapInArrow(partial(_set_batches, self.size), "node long, shingles array<long>")
        return written(sets.join(nodes.select("node", "n_shingles"), "node").dropDuplicates(["node"]), "dup-sets")

    def _verified(self, pairs: DataFrame) -> DataFrame:
        """The pairs that reach the threshold on their full sets."""
        sets = self._sets(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct())
        a, b = (sets.toDF(c, f"set_{c}", f"n_{c}") for c in "ab")
        common = F.size(F.array_intersect("set_a", "set_b")).cast("long")
        union = F.col("n_a") + F.col("n_b") - common
        both = pairs.join(b, "b").join(a, "a")
        return both.filter(common * self.of >= union * self.shared).select("a", "b")

    def _link(self, links: DataFrame) -> None:
        of = self.joined
        for c in "ab":
            links = links.join(of.toDF(c, f"of_{c}"), c, "left").withColumn(f"of_{c}", F.coalesce(f"of_{c}", c))
        links = written(links, "dup-edges")
        if links.isEmpty():
            return
        merged = components(links.select(F.col("of_a").alias("a"), F.col("of_b").alias("b")).filter("a != b"))
        old = merged.select(F.col("node").alias("old"), F.col("component").alias("new"))
        known = of.union(links.select("a", "of_a")).union(links.select("b", "of_b")).distinct().toDF("node", "component")
        joined = known.join(old, F.col("component") == F.col("old"), "left")
        self.joined = written(joined.select("node", F.coalesce("new", "component").alias("component")), "dup-components")


def _word_hashes(docs: DataFrame, *kept: str) -> DataFrame:
    """``kept`` columns and ``words``, the hashes of a text's words."""
    # In a step of its own, else the text is made lower case for each use.
    plain = docs.select(*kept, lower_ascii(F.col("text")).alias("text"))
    words = F.transform(split_words(spaced(F.col("text")), " "), lambda w: F.xxhash64(w))
    return plain.select(*kept, words.alias("words"))


def near_duplicates(
    docs: DataFrame, *, id_col="doc_id", text_col="text", shingle: int = SHINGLE, min_shared: int = MIN_SHARED, of: int = OF
) -> DataFrame:
    """Per document: id, ``n_shingles``, ``node`` (its class of equal sets), ``component_id`` (smallest id) and ``kept``.

    Documents are linked where ``of * intersection >= min_shared * union``. ``kept`` is true for the documents that bear
    the id of their component.
    """
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = docs.schema["id"].dataType.simpleString()
    schema = f"id {kind}, n_shingles long, node long, bands array<long>, registers binary"
    made = _word_hashes(docs, "id").mapInArrow(partial(_sketch_batches, shingle), schema)
    made = written(made, "dup-sketches")
    one = [F.first(c).alias(c) for c in ("n_shingles", "bands", "registers")]
    classes = written(made.filter("node is not null").groupBy("node").agg(F.min("id").alias("id"), *one), "dup-classes")
    joined = _Search(docs, classes, shingle, min_shared, of).run()
    named = classes.select("node", "id").join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = written(named, "dup-named")
    smallest = written(named.groupBy("component").agg(F.min("id").alias("component_id")), "dup-smallest")
    named = written(named.join(smallest, "component").select("node", "component_id"), "dup-found")
    rows = made.select("id", "n_shingles", "node").join(named, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id"))
    rows = rows.select(F.col("id"), "n_shingles", "node", component.alias("component_id"))
    return rows.select(F.col("id").alias(id_col), "n_shingles", "node", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, *, id_col="doc_id", text_col="text", **options) -> DataFrame:
    """The documents that stay, one row per component, with their own columns.

    A row is known by its id and the hash and length of its text, so neither null nor shared ids take other rows along. Of
    a component the row with the smallest id stays (null after all others, then by hash and length); of rows that have
    its id and text too, the one whose columns come first. Documents without a word stand for themselves and all stay.
    """
    p = fresh_prefix(docs)
    text = F.col(text_col)
    key = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.xxhash64(text).alias("hash"), F.length(text).alias("length"))
    found = near_duplicates(docs.select(key.alias("id"), text.alias("text")), id_col="id", text_col="text", **options)
    found = written(found.filter("node is not null").select(F.col("id").alias(p + "found"), "kept"), "dup-rows")
    gone = sent_if_few(written(found.filter("not kept").select(p + "found").distinct(), "dup-gone"))
    again = found.filter("kept").groupBy(p + "found").agg(F.count("*").alias("n")).filter("n > 1").select(p + "found")
    again = written(again, "dup-again")
    same = F.col(p + "key").eqNullSafe(F.col(p + "found"))
    stay = docs.withColumn(p + "key", key).join(gone, same, "left_anti")
    if again.isEmpty():
        return stay.select(*docs.columns)
    again = sent_if_few(again)
    # Maps have no order.
    order = [c for c, kind in docs.dtypes if "map<" not in kind and c != text_col]
    first = F.min_by(F.struct(*docs.columns), F.struct(*order)).alias(p + "row")
    repeated = stay.join(again, same, "left_semi").groupBy(p + "key").agg(first).select(p + "row.*")
    return stay.join(again, same, "left_anti").select(*docs.columns).unionByName(repeated)
