"""Counts over one text that the quality operators share. Words are separated by blank, tab and line ends only."""

from __future__ import annotations

from collections import Counter
from typing import NamedTuple

SYMBOLS = "#*$%&|<>"
_BLANKS = " \t\n\x0b\x0c\r"


class Counts(NamedTuple):
    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int
    n_lines: int
    n_distinct: int
    n_top: int
    n_digits: int
    n_upper: int
    n_letters: int
    n_stops: int
    n_stop_lines: int
    n_short: int


def repeated_words(words: list) -> int:
    """Words that lie in a 3-word window found twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    counts = Counter(windows)
    marked = bytearray(len(words))
    for i, window in enumerate(windows):
        if counts[window] > 1:
            marked[i : i + 3] = b"\x01\x01\x01"
    return sum(marked)


def count(text: str | None) -> Counts:
    """The counts of a text; null has none."""
    text = text or ""
    # bytes.split() separates at exactly these six characters.
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    lines = [line for line in raw.split(b"\n") if line.strip()]
    by_word = Counter(words)
    letters = sum(map(str.isalpha, text)) if not text.isascii() else sum(map(raw.count, _LETTERS))
    return Counts(
        n_words=len(words),
        word_chars=len(text) - sum(map(text.count, _BLANKS)),
        n_symbols=sum(map(text.count, SYMBOLS)),
        n_dup_lines=len(lines) - len(set(lines)),
        n_repeat_words=repeated_words(words),
        n_lines=len(lines),
        n_distinct=len(by_word),
        n_top=max(by_word.values(), default=0),
        n_digits=sum(map(text.count, "0123456789")),
        n_upper=sum(map(raw.count, _UPPER)),
        n_letters=letters,
        n_stops=sum(map(text.count, ".!?")),
        n_stop_lines=sum(line.rstrip().endswith((b".", b"!", b"?")) for line in lines),
        n_short=sum(n for w, n in by_word.items() if len(w) <= 3),
    )


_UPPER = [bytes([b]) for b in range(65, 91)]
_LETTERS = _UPPER + [bytes([b]) for b in range(97, 123)]
