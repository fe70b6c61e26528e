"""Periodic runs: maximal stretches of words that repeat with a period.

A run is a stretch of consecutive words with smallest period q (words q apart are equal), at least ``MIN_LENGTH`` words and
``EXPONENT`` periods long, that neither neighbouring word extends.

Method: maximal pairs. Two places i < j of a text that agree in exactly l words, and whose words to the left differ, are a
maximal pair. The stretch from i on of l + q words, q = j - i, then has period q and no neighbour extends it, so if it is
long enough it is a run as it stands; of pairs with the same stretch the one with the smallest q names the period. The pairs
are found bottom-up on the tree of LCP intervals: the suffixes that share their first l words, with the left word of each
as its class. Where two children of an interval meet, each start of the smaller one is held against those starts of the
larger one that are near enough for ``EXPONENT`` periods (q <= l / (EXPONENT - 1)) and of another class. Starts of l equal
words at most l / 2 apart are an arithmetic progression in which all but the first have the same left word; so the class
lists are kept as one list by place, in which what a start can pair with is either everything near to its right or the one
start at the far left, and no pair within a class is ever looked at. The pairs looked at are as many as are reported.

The suffixes of many texts are sorted together by doubling (their first 1, 2, 4, ... words), with the words of each text
marked as its own, so that texts never mix. A run of the least length has a pair of ``least_common`` words, so suffixes
whose first words up to that length (a power of two below it) occur once in their text are in no interval of use and leave
the sort early; in ordinary prose that is all of them. LCP values come from the ranks of the rounds.

Each text is worked on by itself, so there is no shuffle, and a lost task repeats its own texts only. Memory: the words of
one text, or of CHUNK_WORDS words of short ones, with some 250 bytes a word.

Defined results: null, empty and blank texts have no words and no run; repeated rows and rows that share an id each get a
row of their own, null ids too; an empty table gives an empty table; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_LENGTH = 24
EXPONENT = 3
# Short texts are sorted together up to so many words.
CHUNK_WORDS = 200_000

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
RUN = "start long, length long, period long"


def least_common(min_length: int = MIN_LENGTH, exponent: int = EXPONENT) -> int:
    """How many words the pair of any run agrees in: its length less one period."""
    return -(-min_length * (exponent - 1) // exponent)


def _group_starts(differs: np.ndarray) -> np.ndarray:
    """For sorted values, the index of the first of each one's equals."""
    return np.maximum.accumulate(np.where(differs, np.arange(len(differs)), 0))


def _differs(values: np.ndarray) -> np.ndarray:
    return np.concatenate([[True], values[1:] != values[:-1]])


def _shared(differs: np.ndarray) -> np.ndarray:
    """For sorted values, whether each has an equal."""
    return ~(differs & np.concatenate([differs[1:], [True]]))


def sorted_suffixes(codes: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes whose first words, up to a power of two of at most ``least``, are not alone, in order of their words.

    And the number of words each has in common with the one before; 0 for the first.
    """
    n = len(codes)
    order = np.argsort(codes, kind="stable")
    differs = _differs(codes[order])
    # A suffix's rank is where the group of its equals starts. Behind the last word there is a rank below all others.
    rank = np.full(n + 1, -1, np.int64)
    rank[order] = _group_starts(differs)
    open_, width, rounds, found = order[_shared(differs)], 1, [rank.astype(np.int32)], None
    while len(open_):
        if found is None and 2 * width > least:
            found = open_
        key = rank[open_] * (n + 1) + rank[np.minimum(open_ + width, n)] + 1
        order = np.argsort(key, kind="stable")
        key, open_ = key[order], open_[order]
        old, differs = rank[open_], _differs(key)
        rank[open_] = old + _group_starts(differs) - _group_starts(_differs(old))
        open_, width = open_[_shared(differs)], 2 * width
        rounds.append(rank.astype(np.int32))
    if found is None:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    found = found[np.argsort(rank[found])]
    left, right = found[:-1].copy(), found[1:].copy()
    common = np.zeros(len(found), np.int64)
    for k in range(len(rounds) - 1, -1, -1):
        step = (rounds[k][left] == rounds[k][right]) * (1 << k)
        left, right = np.minimum(left + step, n), np.minimum(right + step, n)
        common[1:] += step
    return found, common


def maximal_pairs(codes: np.ndarray, min_length: int, exponent: int) -> dict[tuple[int, int], int]:
    """``(start, length)`` to the period of every run in a sequence of codes."""
    if exponent < 3:
        raise ValueError("from three periods on the starts of an interval are progressions")
    least = least_common(min_length, exponent)
    suffixes, common = sorted_suffixes(codes, least)
    found: dict[tuple[int, int], int] = {}
    if not len(suffixes):
        return found
    before = np.concatenate([[-1], codes[:-1]]).tolist()

    def report(start: int, period: int, length: int) -> None:
        if length >= min_length and found.get((start, length), period) >= period:
            found[start, length] = period

    def merged(words: int, a: list[int], b: list[int]) -> list[int]:
        """The starts of two children of an interval with ``words`` words in common, after reporting the pairs they make."""
        if len(a) < len(b):
            a, b = b, a
        reach = words // (exponent - 1)
        for x in b:
            at = bisect_left(a, x)
            if at < len(a) and a[at] - x <= reach and before[a[at]] != before[x]:
                for k in range(at, len(a)):
                    if a[k] - x > reach:
                        break
                    report(x, a[k] - x, words + a[k] - x)
            if at and x - a[at - 1] <= reach:
                first = a[bisect_left(a, x - reach, 0, at)]
                if before[first] != before[x]:
                    report(first, x - first, words + x - first)
        if len(b) < 8:
            for x in b:
                insort(a, x)
        else:
            a.extend(b)
            a.sort()
        return a

    # Open intervals by words in common, with the starts of the children so far; the last child is still apart.
    intervals: list[tuple[int, list[int]]] = []
    child: list[int] = []
    for start, words in zip([*suffixes.tolist(), -1], [*common.tolist(), 0]):
        while intervals and intervals[-1][0] > words:
            child = merged(*intervals.pop(), child)
        if words >= least:
            if intervals and intervals[-1][0] == words:
                child = merged(*intervals.pop(), child)
            intervals.append((words, child))
        child = [start]
    return found


def text_words(text: str | None) -> list[str]:
    return _WORD.findall(text or "")


def runs_of(texts: Sequence[list[str]], min_length: int = MIN_LENGTH, exponent: int = EXPONENT) -> list[list[tuple[int, int, int]]]:
    """``start, length, period`` of the runs of each text, given as words, by start and period."""
    code: dict[str, int] = defaultdict()
    code.default_factory = code.__len__
    sizes = [len(t) for t in texts]
    ends = np.cumsum(sizes, dtype=np.int64)
    named = np.fromiter((code[w] for t in texts for w in t), np.int64, int(ends[-1]) if len(ends) else 0)
    made: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not len(named):
        return made
    codes = named + np.repeat(np.arange(len(texts), dtype=np.int64) * len(code), sizes)
    for (start, length), period in maximal_pairs(codes, min_length, exponent).items():
        text = int(np.searchsorted(ends, start, "right"))
        made[text].append((start - (int(ends[text]) - sizes[text]), length, period))
    return [sorted(x, key=lambda r: (r[0], r[2])) for x in made]


def collapsed(words: list[str], runs: Sequence[tuple[int, int, int]]) -> str:
    """The words that are in no run after its first period, joined by blanks."""
    if runs:
        gone = np.zeros(len(words) + 1, np.int64)
        for start, length, period in runs:
            gone[start + period] += 1
            gone[start + length] -= 1
        words = [w for w, g in zip(words, np.cumsum(gone)) if not g]
    return " ".join(words)


def _chunks(texts: pa.Array) -> Iterator[list[list[str]]]:
    chunk, size = [], 0
    for text in texts:
        chunk.append(text_words(text.as_py()))
        size += len(chunk[-1])
        if size >= CHUNK_WORDS:
            yield chunk
            chunk, size = [], 0
    if chunk:
        yield chunk


def _found(min_length: int, exponent: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in RUN.split(", ")]
    kind = pa.list_(pa.struct([(c, pa.int64()) for c in names]))
    for batch in batches:
        done = 0
        for chunk in _chunks(batch.column(1)):
            runs = runs_of(chunk, min_length, exponent)
            columns = [
                batch.column(0).slice(done, len(chunk)),
                pa.array([len(w) for w in chunk], pa.int64()),
                pa.array([[dict(zip(names, r)) for r in x] for x in runs], kind),
                pa.array([collapsed(w, x) for w, x in zip(chunk, runs)], pa.string()),
            ]
            done += len(chunk)
            yield pa.RecordBatch.from_arrays(columns, ["id", "n_words", "runs", "collapsed"])


def periodic_runs(
    docs: DataFrame, *, id_col="doc_id", text_col="text", min_length: int = MIN_LENGTH, exponent: int = EXPONENT
) -> DataFrame:
    """Per document ``id``, ``n_words``, ``runs`` (``start, length, period`` by start and period) and the ``collapsed`` text.

    Collapsed, a run keeps its first period; words are joined by one blank.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    made = f"id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return rows.mapInArrow(lambda batches: _found(min_length, exponent, batches), made)
