"""Language identification, word first with back-off to character n-grams.

A word that is known in any language adds its log frequency per language; an
unseen word adds the mean log frequency of its character n-grams, at each
position the longest known one, from ``max_gram`` characters down to one.  The
language with the largest sum wins.  The model is a bounded table (so many words
and n-grams per language), fitted by Spark on a bounded sample of labelled rows
and broadcast; scoring is one narrow pass.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barlab.llm.common import batch_of, held_out, short_batches, small_join, written

_WORD = re.compile(r"[^\W\d_]+")
#: Evidence of an n-gram counts this much less for each character it is shorter than the longest (log scale).
BACKOFF = math.log(0.4)
UNDETERMINED = "und"


@dataclass
class LanguageModel:
    """``words`` and ``grams`` give the row of a key in ``word_rows`` and
    ``gram_rows``: log frequencies in the order of ``languages`` (sorted names),
    those of n-grams less what back-off costs."""

    languages: list[str]
    words: dict[str, int]
    word_rows: np.ndarray
    grams: dict[str, int]
    gram_rows: np.ndarray
    max_gram: int

    def backed_off(self, words: list[str]) -> np.ndarray:
        """A row per unseen word: mean over its positions of the longest known
        n-gram that starts there (0 where no n-gram is known)."""
        get, longest = self.grams.get, self.max_gram
        found: list[int] = []
        counts = []
        for word in words:
            padded = f"<{word}>"
            before = len(found)
            for start in range(len(padded)):
                for size in range(longest, 0, -1):
                    row = get(padded[start:start + size])
                    if row is not None:
                        found.append(row)
                        break
            counts.append(len(found) - before)
        out = np.zeros((len(words), len(self.languages)), np.float32)
        some = np.array(counts) > 0
        if found:
            starts = np.concatenate([[0], np.cumsum(counts)[:-1]])[some]
            out[some] = np.add.reduceat(self.gram_rows[found], starts, axis=0) / np.array(counts)[some][:, None]
        return out


def _sample(docs: DataFrame, per_language: int) -> DataFrame:
    """About ``per_language`` rows of each language, chosen by a hash of the row;
    all rows of smaller ones."""
    sizes = written(docs.groupBy("lang").agg(F.count("*").alias("lang_rows")), "language-sizes")
    unit = F.pmod(F.xxhash64("doc_id", "lang"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return small_join(docs, sizes, "lang").filter(unit * F.col("lang_rows") < per_language).drop("lang_rows")


def _counts(batches: Iterator[pa.RecordBatch], max_gram: int) -> Iterator[pa.RecordBatch]:
    """Per language: counts of words and of the n-grams of its words."""
    def flush(words: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
        for lang, counter in words.items():
            grams: Counter = Counter()
            for word, n in counter.items():
                padded = f"<{word}>"
                for size in range(1, max_gram + 1):
                    for start in range(len(padded) - size + 1):
                        grams[padded[start:start + size]] += n
            for size, table in ((0, counter), *((s, None) for s in range(1, max_gram + 1))):
                table = table if table is not None else {g: n for g, n in grams.items() if len(g) == size}
                if table:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(table)), pa.array([size] * len(table), pa.int32()), pa.array(list(table)),
                         pa.array(list(table.values()), pa.int64())], names=["lang", "size", "key", "n"])

    words: dict[str, Counter] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words.setdefault(lang, Counter()).update(w for w in _WORD.findall(text.lower()) if len(w) <= 64)
        if sum(map(len, words.values())) > 200_000:
            yield from flush(words)
            words = {}
    yield from flush(words)


def fit_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", *,
                  modulus: int = 4, remainder: int = 2, docs_per_language: int = 1_000, words: int = 5_000,
                  grams: int = 3_000, max_gram: int = 4) -> LanguageModel:
    """Fit on a bounded sample: about ``docs_per_language`` labelled rows of each
    language that are not held out.  Keeps the ``words`` most frequent words and
    the ``grams`` most frequent n-grams of each size, per language."""
    short_batches(docs.sparkSession)
    rows = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & ~held_out(id_col, modulus, remainder))
    rows = rows.select(F.col(id_col).cast("string").alias("doc_id"), F.col(lang_col).cast("string").alias("lang"),
                       F.col(text_col).cast("string").alias("text"))
    rows = _sample(rows, docs_per_language).select("lang", "text")
    counted = rows.mapInArrow(lambda b: _counts(b, max_gram), "lang string, size int, key string, n long")
    totals = counted.groupBy("lang", "size", "key").agg(F.sum("n").alias("n"))
    by = Window.partitionBy("lang", "size")
    ranked = totals.withColumn("total", F.sum("n").over(by)).withColumn(
        "rank", F.row_number().over(by.orderBy(F.col("n").desc(), "key")))
    limit = F.when(F.col("size") == 0, words).otherwise(grams)
    got = ranked.filter(F.col("rank") <= limit).select("lang", "size", "key", "n", "total").toPandas()  # bounded per language
    languages = sorted(got["lang"].unique())
    column = {name: k for k, name in enumerate(languages)}
    floors = {(lang, size): math.log(0.5 / (total + 1))
              for (lang, size), total in got.groupby(["lang", "size"])["total"].first().items()}
    lowest = min(floors.values(), default=0.0)

    def table(part, cost: bool) -> tuple[dict[str, int], np.ndarray]:
        places = {key: k for k, key in enumerate(sorted(part["key"].unique()))}
        sizes = dict(zip(part["key"], part["size"]))
        out = np.array([[floors.get((name, sizes[key]), lowest) for name in languages] for key in places], np.float32)
        out = out.reshape(len(places), len(languages))
        for lang, key, n, total in part[["lang", "key", "n", "total"]].itertuples(index=False):
            out[places[key], column[lang]] = math.log((n + 0.5) / (total + 1))
        if cost and len(places):
            out += np.array([[BACKOFF * (max_gram - sizes[key])] for key in places], np.float32)
        return places, out

    return LanguageModel(languages, *table(got[got["size"] == 0], False), *table(got[got["size"] > 0], True), max_gram)


class _WordRows:
    """Scores of words by row of a matrix: first the model's own words, then a
    bounded cache of unseen ones."""

    def __init__(self, model: LanguageModel):
        self.model = model
        self.limit = max(1_000, min(100_000, 8_000_000 // max(1, len(model.languages))))
        self.matrix = np.zeros((len(model.words) + self.limit, len(model.languages)), np.float32)
        self.matrix[:len(model.words)] = model.word_rows
        self.reset()

    def reset(self) -> None:
        self.rows = dict(self.model.words)
        self.used = len(self.rows)

    def scores(self, words: list[str]) -> tuple[np.ndarray, int]:
        """Sum of the words' rows and how many words there are."""
        total, n = np.zeros(len(self.model.languages)), 0
        size = min(20_000, self.limit)
        for start in range(0, len(words), size):
            part = words[start:start + size]
            known = list(map(self.rows.get, part))
            if None in known:
                unseen = [w for w, row in zip(part, known) if row is None]
                new = sorted({w for w in unseen if len(w) <= 64 and (w.isalpha() or any(map(str.isalpha, w)))})
                if self.used + len(new) > len(self.matrix):
                    self.reset()
                    return self._again(words[start:], total, n)
                if new:
                    self.matrix[self.used:self.used + len(new)] = self.model.backed_off(new)
                    self.rows.update(zip(new, range(self.used, self.used + len(new))))
                    self.used += len(new)
                    known = list(map(self.rows.get, part))
                if None in known:  # too long to be cached, or without a letter
                    other = [w for w, row in zip(part, known) if row is None and any(map(str.isalpha, w))]
                    if other:
                        total += self.model.backed_off(other).sum(0, dtype=np.float64)
                        n += len(other)
                    known = [row for row in known if row is not None]
            if known:
                total += self.matrix[known].sum(0, dtype=np.float64)
                n += len(known)
        return total, n

    def _again(self, words: list[str], total: np.ndarray, n: int) -> tuple[np.ndarray, int]:
        more, count = self.scores(words)
        return total + more, n + count


_PREDICTED = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()),
                        ("score", pa.float64())])


def _judge(cache: _WordRows, texts: pa.Array) -> tuple[list[str], list[float]]:
    """Language and score of each text."""
    model = cache.model
    names, shares = [], []
    for start in range(0, len(texts), 64):
        for text in texts.slice(start, 64).to_pylist():
            total, n = cache.scores(_WORD.findall(text.lower())) if model.languages and text else (None, 0)
            if not n:
                names.append(UNDETERMINED)
                shares.append(0.0)
                continue
            mean = total / n * min(n, 10)
            best = int(np.argmax(mean))
            names.append(model.languages[best])
            shares.append(float(1.0 / np.exp(mean - mean[best]).sum()))
    return names, shares


def predict_language(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text", *,
                     modulus: int = 4, remainder: int = 2) -> DataFrame:
    """One row per input row: ``doc_id, held_out, lang_pred, score``.

    ``lang_pred`` is a learned language, ``und`` if the text is null or has no
    letter or nothing was learned.  ``score`` is the winner's share of a softmax
    over the languages' mean evidence per word, weighed with at most ten words
    (``und``: 0).  Ties go to the first name.  Null identifiers and repeated rows
    pass through; other columns are ignored; an empty table gives an empty
    result.
    """
    short_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _WordRows(shared.value)
        for batch in batches:
            names, shares = _judge(cache, batch.column(2))
            yield batch_of(_PREDICTED, [batch.column(0), batch.column(1), names, shares])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col, modulus, remainder).alias("held_out"),
                       F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(predict, "doc_id long, held_out boolean, lang_pred string, score double")


def with_known_language(docs: DataFrame, model: LanguageModel, text_col: str = "text", *, min_score: float = 0.0) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose text has a learned
    language with at least ``min_score``: rows without any letter go."""
    short_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _WordRows(shared.value)
        for batch in batches:
            names, shares = _judge(cache, batch.column(place))
            yield batch.filter(pa.array([n != UNDETERMINED and s >= min_score for n, s in zip(names, shares)], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
