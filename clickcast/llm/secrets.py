"""Secret scan: fixed patterns, and a battery of randomness tests over all other tokens.

Patterns give the base spans: assignments of a long value to a telling name, access keys, long hex strings. The battery
then looks at every token of at least ``MIN_LENGTH`` characters that no base span touches. Its encoding is inferred from
its characters (hex, base32, letters and digits, base64); digits alone are no secret. Three tests follow:

* chi-squared uniformity over the encoding's alphabet, taken as the rate at which two of the token's characters are
  equal. The null hypothesis is ordinary text, whose rate is known to be far higher than the alphabet's; its p-value is
  small where the characters are spread too evenly to be words.
* runs: ordinary tokens keep to one class of characters (letters of one case, digits, signs) for some time; the p-value is
  the chance of as many changes of class in ordinary text. And against randomness: the number of runs above and below the
  middle of the alphabet must be what independent characters give, and there must not be too few changes of class.
* serial correlation of neighbouring characters must be near zero.

A token that fails a test against randomness at ``GATE`` is orderly (counters, keyboard rows, words) and dropped. The two
p-values against ordinary text are combined after Fisher. Both depend on the length, so that a short token is significant
only if it is extreme. The combined p-values of a document's tokens then pass the step-up procedure of Benjamini and
Hochberg at ``FALSE_DISCOVERIES``, over all tokens of the document that are long enough to be tested.

Defined results: null and empty texts have no span; each row is scanned by itself, so ids may be null or repeated.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from math import comb, erfc, exp, log, sqrt

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickcast.llm.common import in_pandas

KINDS = ("assign", "access", "hex", "random")
# The base patterns and their least lengths. Letters of names are in either case, of A-Z only.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 12, "access": 18, "hex": 16}

MIN_LENGTH = 16
TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % MIN_LENGTH)
# Encodings by their characters, the narrowest first, with the size of their alphabet.
ENCODINGS = (
    ("hex", re.compile(r"(?:[0-9a-f]+|[0-9A-F]+)\Z"), "0123456789abcdef"),
    ("base32", re.compile(r"(?:[A-Z2-7]+=*|[a-z2-7]+=*)\Z"), "abcdefghijklmnopqrstuvwxyz234567"),
    ("alnum", re.compile(r"[A-Za-z0-9]+\Z"), "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
    ("base64", re.compile(r".*", re.S), "+-/0123456789=ABCDEFGHIJKLMNOPQRSTUVWXYZ_abcdefghijklmnopqrstuvwxyz"),
)
# How often two characters of ordinary text are equal, and three of them.
EQUAL_PAIRS, EQUAL_TRIPLES = 0.066, 0.0062
# How often the class of characters changes from one to the next in ordinary tokens.
CHANGES = 0.2
GATE = 1e-3
FALSE_DISCOVERIES = 1e-3


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """``start, end, kind`` of the patterns: leftmost matches that do not overlap, then those that are long enough."""
    spans = []
    for kind, pattern, group in (("assign", ASSIGN, 2), ("access", ACCESS, 0), ("hex", HEX, 0)):
        for match in pattern.finditer(text):
            if match.end(group) - match.start(group) >= LEAST[kind]:
                spans.append((match.start(), match.end(), kind))
    return spans


def _upper_tail(z: float) -> float:
    return 0.5 * erfc(z / sqrt(2))


def spread_p(token: str) -> float:
    """The chance that ordinary text of this length has its characters spread as evenly as this token, or more."""
    n = len(token)
    same = sum(c * (c - 1) for c in Counter(token).values()) / (n * (n - 1))
    p, t = EQUAL_PAIRS, EQUAL_TRIPLES
    variance = 2 * (p + 2 * (n - 2) * t - (2 * n - 3) * p * p) / (n * (n - 1))
    return _upper_tail((p - same) / sqrt(variance))


def runs_p(places: list[int], size: int) -> float:
    """Two-sided p-value of the number of runs above and below the middle of the alphabet."""
    above = [p >= size / 2 for p in places]
    n, n1 = len(above), sum(above)
    n0 = n - n1
    if not n0 or not n1:
        return 0.0
    runs = 1 + sum(a != b for a, b in zip(above, above[1:]))
    mean = 1 + 2 * n0 * n1 / n
    variance = (mean - 1) * (mean - 2) / (n - 1)
    return 2 * _upper_tail(abs(runs - mean) / sqrt(variance)) if variance > 0 else 0.0


def serial_p(places: list[int]) -> float:
    """Two-sided p-value of the correlation of each character with the next."""
    n = len(places)
    mean = sum(places) / n
    around = [p - mean for p in places]
    variance = sum(a * a for a in around)
    if variance == 0:
        return 0.0
    r = sum(a * b for a, b in zip(around, around[1:])) / variance
    return 2 * _upper_tail(abs(r + 1 / n) * sqrt(n))


def _kind_of_character(c: str) -> int:
    return 0 if c.isdigit() else 1 if c.islower() else 2 if c.isupper() else 3


def mixing_p(token: str) -> float:
    """The chance of as few changes between digits, small letters and capitals if the order were random."""
    kinds = [_kind_of_character(c) for c in token]
    n, counts = len(kinds), Counter(kinds)
    same = sum(c * (c - 1) for c in counts.values()) / (n * (n - 1))
    changes = sum(a != b for a, b in zip(kinds, kinds[1:]))
    mean = (n - 1) * (1 - same)
    variance = (n - 1) * same * (1 - same)
    return _upper_tail((mean - changes) / sqrt(variance)) if variance > 0 else 1.0


def changes_p(token: str) -> float:
    """The chance that an ordinary token of this length changes its class of characters as often as this one, or more."""
    kinds = [_kind_of_character(c) for c in token]
    n, k = len(kinds) - 1, sum(a != b for a, b in zip(kinds, kinds[1:]))
    if n > 1000:
        return _upper_tail((k - n * CHANGES) / sqrt(n * CHANGES * (1 - CHANGES)))
    return sum(comb(n, i) * CHANGES**i * (1 - CHANGES) ** (n - i) for i in range(k, n + 1))


def fisher(first: float, second: float) -> float:
    """Two p-values combined: minus twice the logarithm of their product is chi-squared with four degrees of freedom."""
    half = -log(max(first, 1e-300)) - log(max(second, 1e-300))
    return exp(-half) * (1 + half)


def battery(token: str) -> float | None:
    """The p-value of a token against ordinary text, or None if it is orderly or has no encoding worth testing."""
    if token.isdigit():
        return None
    kinds = len({_kind_of_character(c) for c in token})
    if kinds < 2:
        # Words in one case have no digits; a random string this long without any is rarer than such words are.
        return None
    _, _, alphabet = next(e for e in ENCODINGS if e[1].match(token))
    plain = token.lower() if len(alphabet) <= 32 else token
    order = {c: i for i, c in enumerate(alphabet)}
    places = [order[c] for c in plain if c in order]
    if min(runs_p(places, len(alphabet)), serial_p(places), mixing_p(token)) < GATE:
        return None
    return fisher(spread_p(token), changes_p(token))


def random_spans(text: str, taken: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Tokens that the battery finds random, away from the spans in ``taken``."""
    tested, known, at, reach = [], sorted(taken), 0, 0
    for match in TOKEN.finditer(text):
        start, end = match.span()
        # Tokens come in order, so the spans that begin before this one ends are those of the last token and some more.
        while at < len(known) and known[at][0] < end:
            reach = max(reach, known[at][1])
            at += 1
        if reach <= start:
            p = battery(match.group())
            tested.append((1.0 if p is None else p, start, end))
    tested.sort()
    passed = 0
    for rank, (p, _, _) in enumerate(tested, 1):
        if p <= FALSE_DISCOVERIES * rank / len(tested):
            passed = rank
    return [(start, end, "random") for _, start, end in tested[:passed]]


def joined(spans: list[tuple[int, int, str]]) -> str:
    """``kind:start:end``, by start, then in the order of ``KINDS``."""
    return ",".join(f"{k}:{s}:{e}" for s, e, k in sorted(spans, key=lambda x: (x[0], KINDS.index(x[2]), x[1])))


def _scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for text in batch["text"]:
            base = base_spans(text or "")
            rows.append((base, random_spans(text or "", base)))
        yield pd.DataFrame(
            {
                "id": batch["id"],
                **{f"n_{k}": [sum(s[2] == k for s in base + more) for base, more in rows] for k in KINDS},
                "base_spans": [joined(base) for base, _ in rows],
                "spans": [joined(base + more) for base, more in rows],
            }
        )


def scan(docs: DataFrame, *, id_col="doc_id", text_col="text") -> DataFrame:
    """Per document: id, the number of spans of each kind, ``base_spans`` and ``spans`` (code points, end exclusive)."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return in_pandas(rows, _scan, f"{counts}, base_spans string, spans string").withColumnRenamed("id", id_col)
