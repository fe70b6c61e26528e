"""Language identification, word first.

A word that was learned is scored by its log frequency in each language. An unseen word backs off to characters: at each
of its positions counts the longest known character n-gram that ends there, five characters down to one, with marks for
the word's begin and end, by its log frequency in each language; each weighs one over its length, since they overlap.
A text's score is the sum over all its words; the language with the highest score is predicted.

The fit reads at most about ``sample_docs`` labelled documents a language (chosen by a hash of the id) and keeps
``max_words`` words and ``max_grams`` n-grams of each length per language, the most frequent ones: so the model that is
sent to the executors is bounded by these parameters and the number of languages.

Defined results: null, empty or letterless texts are ``und`` with score 0, and so is everything if nothing was learned.
The score is the posterior probability of the predicted language over the learned ones. Ties go to the first language in
order of name. Null languages, ids and texts are not learned from. Documents that share an id are predicted one by one.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickcast.llm.common import held_out, in_pandas, written

SAMPLE_DOCS, MAX_WORDS, MAX_GRAMS = 4000, 50_000, 5000
ORDERS = (5, 4, 3, 2, 1)
SMOOTHING = 0.5
UNKNOWN = "und"
# Unseen words remembered by a task before it starts anew.
REMEMBERED = 50_000

_LETTERS = re.compile(r"[^\W\d_]+")


def letter_words(text: str | None) -> list[str]:
    return _LETTERS.findall(text.lower()) if text else []


def marked(word: str) -> str:
    return f"\x02{word}\x03"


@dataclass
class LanguageModel:
    """``languages``; ``rows`` from a word or n-gram to its row in ``scores`` (log frequency per language)."""

    languages: list[str]
    words: dict[str, int]
    grams: dict[str, int]
    word_scores: np.ndarray
    gram_scores: np.ndarray
    _memory: dict[str, list[int]] = field(default_factory=dict, repr=False)

    def __post_init__(self) -> None:
        lengths = np.array([len(g) for g in self.grams], np.float64).reshape(-1, 1)
        self._weighted = self.gram_scores / lengths if len(lengths) else self.gram_scores

    def gram_rows(self, word: str) -> list[int]:
        """The rows of the n-grams that count for a word."""
        rows = self._memory.get(word)
        if rows is not None:
            return rows
        rows, text, known = [], marked(word), self.grams.get
        for end in range(1, len(text) + 1):
            for start in range(max(0, end - ORDERS[0]), end):
                row = known(text[start:end])
                if row is not None:
                    rows.append(row)
                    break
        if len(self._memory) >= REMEMBERED:
            self._memory.clear()
        if len(word) <= 64:
            self._memory[word] = rows
        return rows

    def back_off(self, word: str) -> np.ndarray:
        """The score of an unseen word in each language."""
        return self._weighted[self.gram_rows(word)].sum(0)

    def predict(self, text: str | None) -> tuple[str, float]:
        words = letter_words(text)
        # The words may be of digits that only look like letters to the pattern, such as raised ones.
        if not words or not self.languages or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        seen, unseen, known = [], [], self.words.get
        for word in words:
            row = known(word)
            if row is None:
                unseen += self.gram_rows(word)
            else:
                seen.append(row)
        total = np.zeros(len(self.languages))
        # Each row once, times how often it stands in the text: a text has many words but few rows.
        for rows, scores in ((seen, self.word_scores), (unseen, self._weighted)):
            if rows:
                which, times = np.unique(rows, return_counts=True)
                total += times @ scores[which]
        best = int(total.argmax())
        return self.languages[best], float(1 / np.exp(np.clip(total - total[best], -700, 0)).sum())


def _count_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        counts: Counter = Counter()
        for lang, text in zip(batch["lang"], batch["text"], strict=True):
            counts.update((lang, w) for w in letter_words(text))
        yield pd.DataFrame([(lang, w, n) for (lang, w), n in counts.items()], columns=["lang", "word", "n"])


def _count_grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        counts: Counter = Counter()
        for lang, word, n in zip(batch["lang"], batch["word"], batch["n"], strict=True):
            text = marked(word)
            for order in ORDERS:
                for i in range(len(text) - order + 1):
                    counts[lang, order, text[i : i + order]] += n
        yield pd.DataFrame([(lang, o, g, n) for (lang, o, g), n in counts.items()], columns=["lang", "size", "gram", "n"])


def _scores(rows: list, languages: list[str]) -> tuple[dict[str, int], np.ndarray]:
    """Rows ``lang, name, n`` as an index of names and their log frequencies, smoothed, per language."""
    index: dict[str, int] = {}
    for r in rows:
        index.setdefault(r["name"], len(index))
    counts = np.full((len(index), len(languages)), SMOOTHING)
    for r in rows:
        counts[index[r["name"]], languages.index(r["lang"])] += r["n"]
    return index, np.log(counts / counts.sum(0)) if len(index) else counts


def fit(
    docs: DataFrame, *, id_col="doc_id", text_col="text", lang_col="lang", sample_docs=SAMPLE_DOCS, max_words=MAX_WORDS, max_grams=MAX_GRAMS
) -> LanguageModel:
    """Learn from the documents that are not held out."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.filter(~held_out(F.col("id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    languages = sorted(sizes)
    if not languages:
        return LanguageModel([], {}, {}, np.zeros((0, 0)), np.zeros((0, 0)))
    share = F.create_map(*(F.lit(x) for lang in languages for x in (lang, min(1.0, sample_docs / sizes[lang]))))
    chosen = F.pmod(F.xxhash64(F.col("id")), F.lit(1_000_000)) < share[F.col("lang")] * 1_000_000
    words = rows.filter(chosen).select("lang", "text").mapInPandas(_count_words, "lang string, word string, n long")
    words = written(words.groupBy("lang", "word").agg(F.sum("n").alias("n")), "lang-words")
    grams = words.mapInPandas(_count_grams, "lang string, size int, gram string, n long")
    grams = grams.groupBy("lang", "size", "gram").agg(F.sum("n").alias("n"))
    top = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))
    best_words = words.withColumn("top", top).filter(F.col("top") <= max_words).select("lang", F.col("word").alias("name"), "n")
    top = F.row_number().over(Window.partitionBy("lang", "size").orderBy(F.desc("n"), "gram"))
    best_grams = grams.withColumn("top", top).filter(F.col("top") <= max_grams).select("lang", F.col("gram").alias("name"), "n", "size")
    word_index, word_scores = _scores(best_words.collect(), languages)
    # Frequencies of n-grams are among those of the same length.
    gram_index: dict[str, int] = {}
    parts, found = [], best_grams.collect()
    for order in ORDERS:
        index, scores = _scores([r for r in found if r["size"] == order], languages)
        gram_index |= {g: i + len(gram_index) for g, i in index.items()}
        parts.append(scores)
    return LanguageModel(languages, word_index, gram_index, word_scores, np.concatenate(parts))


def predict(docs: DataFrame, model: LanguageModel, *, id_col="doc_id", text_col="text") -> DataFrame:
    """Per document: id, ``lang_pred`` and ``score``. Only the text is looked at."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def label(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = sent.value
        for batch in batches:
            made = [known.predict(t) for t in batch["text"]]
            yield pd.DataFrame({"id": batch["id"], "lang_pred": [m[0] for m in made], "score": [m[1] for m in made]})

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return in_pandas(rows, label, "lang_pred string, score double").withColumnRenamed("id", id_col)
