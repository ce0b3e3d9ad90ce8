"""Ranked lexical search: term-at-a-time with a limit on accumulators.

1. One pass over the texts counts, per document, all its terms and those that an
   item asks for: a narrow row of term numbers and occurrences.  The corpus
   figures (documents, terms, documents per term) are sums over these rows.
2. The rows are searched in blocks of documents.  A block's postings are sorted
   by term; for each item its terms are taken rarest first.  A document gets an
   accumulator when a term first meets it, until the *remaining bound*, the sum of
   the best contributions that the terms still to come make in the block, can't
   reach the score that a document must beat: the k-th best partial score of the
   block, or of the whole documents that the task has ranked before, if higher.
   From then on only accumulators that exist are updated, exactly.
3. A task gives its k best of each item; they are merged in two rounds, so an
   item never meets the answers of all tasks in one.

Scores are 64-bit integers, so their sums don't depend on the order of terms or
on how documents are dealt to blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barlab.llm.common import short_batches, text_bytes, written

#: Bytes that belong to terms, A-Z lower-cased; all others become blanks.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
PIECE = 1 << 20
POSTINGS = "doc_id long, n long, terms array<int>, tfs array<int>"
_ARROW_POSTINGS = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())),
                             ("tfs", pa.list_(pa.int32()))])
FOUND = "item int, doc_id long, score long, part int"
_ARROW_FOUND = pa.schema([("item", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64()), ("part", pa.int32())])
LOWEST_ID = np.iinfo(np.int64).min  # stands for a null identifier inside a block


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a whole text, in pieces of about a megabyte that end where a
    term ends, so that a very long text is never held as one list."""
    start = 0
    while start < len(text):
        piece = text[start:start + PIECE].translate(_LETTERS)
        if start + PIECE < len(text):
            cut = piece.rfind(b" ")
            if cut < 0:  # a term longer than a piece: take it whole
                rest = text[start:].translate(_LETTERS)
                cut = rest.find(b" ")
                cut = len(rest) if cut < 0 else cut
                piece = rest[:cut]
            else:
                piece = piece[:cut]
        start += max(len(piece), 1)
        yield piece.split()


def weight(documents: int, df: int) -> int:
    """Weight of a term that ``df`` of ``documents`` hold."""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


@dataclass(frozen=True)
class Items:
    """A block of items: distinct terms, and per item its term numbers with how
    often it asks for each."""

    numbers: tuple[int, ...]
    vocabulary: dict[bytes, int]
    terms: tuple[np.ndarray, ...]
    asked: tuple[np.ndarray, ...]

    @classmethod
    def of(cls, rows: list[tuple[int, bytes]]) -> Items:
        vocabulary: dict[bytes, int] = {}
        numbers, terms, asked = [], [], []
        for number, text in rows:
            ids = [vocabulary.setdefault(t, len(vocabulary)) for piece in terms_of(text) for t in piece]
            if ids:
                distinct, times = np.unique(np.array(ids, np.int64), return_counts=True)
                numbers.append(number)
                terms.append(distinct)
                asked.append(times.astype(np.int64))
        return cls(tuple(numbers), vocabulary, tuple(terms), tuple(asked))


# --------------------------------------------------------------------------- pass 1
def _postings(shared):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value.vocabulary.get
        for batch in batches:
            sizes, lengths, terms, tfs = [], [], [], []
            for text in text_bytes(batch.column(1)):
                n, met = 0, []
                for piece in terms_of(text):
                    n += len(piece)
                    met.append(np.fromiter((i for i in map(number, piece) if i is not None), np.int32))
                ids, times = np.unique(np.concatenate(met) if met else np.empty(0, np.int32), return_counts=True)
                sizes.append(n)
                lengths.append(len(ids))
                terms.append(ids)
                tfs.append(times.astype(np.int32))
            ends = pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32))
            flat = lambda parts: pa.array(np.concatenate(parts) if parts else np.empty(0, np.int32), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()),
                                              pa.ListArray.from_arrays(ends, flat(terms)),
                                              pa.ListArray.from_arrays(ends, flat(tfs))], schema=_ARROW_POSTINGS)
    return count


# --------------------------------------------------------------------------- pass 2
@dataclass
class Best:
    """The best documents of one item so far: score, then smallest identifier."""

    k: int
    ids: np.ndarray
    scores: np.ndarray

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        ids, scores = np.concatenate([self.ids, ids]), np.concatenate([self.scores, scores])
        order = np.lexsort((ids, -scores))[:self.k]
        self.ids, self.scores = ids[order], scores[order]

    @property
    def bar(self) -> int:
        """What a document must reach to be among the best; 0 if any score does."""
        return int(self.scores[-1]) if len(self.scores) >= self.k else 0


def _kth(scores: np.ndarray, k: int) -> int:
    return int(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else 0


def search_block(docs: np.ndarray, impacts: np.ndarray, starts: np.ndarray, size: int, terms: np.ndarray,
                 asked: np.ndarray, weights: np.ndarray, bar: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents of a block (numbers below ``size``) and scores for one item.

    ``docs`` and ``impacts`` are the postings, sorted by term and document;
    those of term ``t`` lie from ``starts[t]`` to ``starts[t + 1]``.  All documents
    that reach ``bar`` and the block's k-th best score are among the answers, with
    whole scores."""
    here = np.flatnonzero(starts[terms + 1] > starts[terms])
    here = here[np.lexsort((terms[here], -weights[terms[here]]))]  # rarest first
    steps = []
    for i in here.tolist():
        a, b, factor = starts[terms[i]], starts[terms[i] + 1], int(asked[i] * weights[terms[i]])
        if factor:
            steps.append((a, b, factor, factor * int(impacts[a:b].max())))
    bound = sum(s[3] for s in steps)
    total = np.zeros(size, np.int64)
    alive, creating = None, True
    for a, b, factor, most in steps:
        if creating and bound < bar:  # a document first met now can't come up to it
            alive, creating = np.flatnonzero(total), False
        if creating:
            total[docs[a:b]] += factor * impacts[a:b]  # a term's documents are distinct
            bound -= most
            if bar <= bound < total.max():  # else the k-th can't end the creation either
                bar = max(bar, _kth(total, k))
        elif len(alive):
            if len(alive) < b - a:
                at = np.searchsorted(docs[a:b], alive)
                met = at < b - a
                met[met] = docs[a:b][at[met]] == alive[met]
                total[alive[met]] += factor * impacts[a:b][at[met]]
            else:
                met = total[docs[a:b]] > 0
                total[docs[a:b][met]] += factor * impacts[a:b][met]
    found = np.flatnonzero(total)
    return found, total[found]


def _searched(shared, weights_shared, documents: int, terms_total: int, k: int, block: int):
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= block:
                yield pa.Table.from_batches(held).combine_chunks()
                held, rows = [], 0
        if rows:
            yield pa.Table.from_batches(held).combine_chunks()

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        items, weights = shared.value, weights_shared.value
        best = [Best(k, np.empty(0, np.int64), np.empty(0, np.int64)) for _ in items.numbers]
        for got in blocks(batches):
            ids = np.asarray(got["doc_id"].combine_chunks().fill_null(LOWEST_ID))
            n = np.asarray(got["n"].combine_chunks())
            column, tfs = got["terms"].combine_chunks(), got["tfs"].combine_chunks()
            column, tfs = (c if isinstance(c, pa.ListArray) else c.chunk(0) for c in (column, tfs))
            lengths = np.asarray(column.value_lengths())
            term = np.asarray(column.flatten())
            tf = np.asarray(tfs.flatten()).astype(np.int64)
            doc = np.repeat(np.arange(len(ids)), lengths)
            m = 75 + (25 * n * documents) // terms_total
            impact = (1_000_000_000 * tf) // (1000 * tf + 12 * m[doc])
            order = np.argsort(term, kind="stable")  # documents ascend within a term
            doc, impact = doc[order], impact[order]
            starts = np.concatenate([[0], np.cumsum(np.bincount(term, minlength=len(weights)))])
            for item, top in enumerate(best):
                found, scores = search_block(doc, impact, starts, len(ids), items.terms[item], items.asked[item], weights,
                                             top.bar, k)
                if len(found) > k:  # ties with the k-th stay: the identifier decides
                    stay = scores >= _kth(scores, k)
                    found, scores = found[stay], scores[stay]
                top.add(ids[found], scores)
        part = TaskContext.get().partitionId()
        if any(len(b.ids) for b in best):
            all_ids = np.concatenate([b.ids for b in best])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.array(items.numbers, np.int32), [len(b.ids) for b in best])),
                 pa.array(all_ids, pa.int64(), mask=all_ids == LOWEST_ID),
                 pa.array(np.concatenate([b.scores for b in best])), pa.array(np.full(len(all_ids), part, np.int32))],
                schema=_ARROW_FOUND)

    return search


def _best(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_first())
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def lexical_search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   item_col: str = "item_id", item_text_col: str = "text", *, k: int = 20, block_terms: int = 200_000,
                   block_docs: int = 16_384) -> DataFrame:
    """The ``k`` best documents of each item: ``item_id, rank, doc_id, score``.

    Terms are runs of ASCII letters and digits and of characters beyond ASCII, A-Z
    lower-cased.  Only scores above 0 are ranked; equal scores go by ascending
    identifier, a null identifier first.  Texts without terms (null, empty, blanks)
    count nowhere and are never found.  Repeated documents are documents each,
    items without terms find nothing, and repeated items are ranked each, with
    their own ranks.  Very long texts are read whole, a megabyte at a time.  Empty
    tables give an empty result; other columns are ignored.

    Items are taken in blocks of about ``block_terms`` terms, which is what the
    driver and a broadcast hold; each block reads the texts once.  A single item
    above that is a block of its own.
    """
    spark = docs.sparkSession
    short_batches(spark)
    text = F.coalesce(F.col(item_text_col).cast("string"), F.lit(""))
    named = written(items.select(F.col(item_col).alias("item_id"), text.alias("words"))
                    .withColumn("item", F.monotonically_increasing_id()), "search-items")
    size = F.regexp_count("words", F.lit("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"))
    total = named.agg(F.sum(size)).first()[0] or 0
    blocks = max(1, -(-total // block_terms))
    block_of = F.pmod(F.xxhash64("item"), F.lit(blocks))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    found = None
    for block in range(blocks):
        asked = sorted((r["item"], r["words"].encode()) for r in  # bounded by block_terms
                       named.filter(block_of == block).select("item", "words").toLocalIterator())
        here = Items.of([(place, words) for place, (_, words) in enumerate(asked)])
        if not here.numbers:
            continue
        shared = spark.sparkContext.broadcast(here)
        postings = written(rows.mapInArrow(_postings(shared), POSTINGS), "search-postings").filter("n > 0")
        documents, terms_total = postings.agg(F.count("*"), F.sum("n")).first()
        if not documents:
            break
        weights = np.full(len(here.vocabulary), weight(documents, 0), np.int64)
        counts = postings.select(F.explode("terms").alias("term")).groupBy("term").count()
        for r in counts.toLocalIterator():  # at most one row a term of the block
            weights[r["term"]] = weight(documents, r["count"])
        best = postings.mapInArrow(_searched(shared, spark.sparkContext.broadcast(weights), documents, terms_total, k,
                                             block_docs), FOUND)
        best = best.withColumn("group", F.floor(F.col("part") / 64))
        best = _best(_best(best, ["item", "group"], k).drop("rank"), ["item"], k)
        places = spark.createDataFrame([(place, item) for place, (item, _) in enumerate(asked)], "item int, place long")
        best = best.join(places, "item").select("place", "rank", "doc_id", "score")
        found = best if found is None else found.unionByName(best)
    names = named.select("item_id", F.col("item").alias("place"))
    if found is None:
        found = spark.createDataFrame([], "place long, rank int, doc_id long, score long")
    return found.join(names, "place").select("item_id", "rank", "doc_id", "score")
