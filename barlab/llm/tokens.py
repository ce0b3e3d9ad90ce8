"""Token counts by a map-side two-tier lookup.

A byte-level BPE cuts a text into pre-tokens and encodes each on its own, so a
text's count is the sum of its pre-tokens' counts.  Tier one is a compact table
of frequent pre-tokens and their lengths, broadcast to every task; tier two is a
cache of each task's worker that encodes what tier one misses.  Both are bounded
(entries and entry length), and what they hold decides speed only, never counts.
No pre-token is shuffled: the frequent table comes from bounded heavy-hitter
summaries, one row per partition, merged in a tree.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlab.llm.common import batch_of, short_batches

# Fixed value: the published pre-token pattern of this vocabulary.  Its alternatives are mutually exclusive by first
# character except that contractions come before other marks, so the common ones stand first here; \s is spelt as the
# Unicode property, as the tokenizer library reads it.
PATTERN = (r" ?\p{L}++| ?\p{N}++|'(?:[stmd]|re|ve|ll)| ?[^\p{White_Space}\p{L}\p{N}]++"
           r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
# Fixed value: characters whose class may differ between the Unicode versions of the two libraries (newly assigned
# ones; all supplementary planes but the emoji); a text with any of them is encoded whole by the tokenizer library.
NEWER = r"[\u0558\u058b\u058c\u088f\u0c5c\u0cdc\u208f-\u209f\ua7ce-\ua7f1\uab6c\uab6d" \
        "\U00010000-\U0001efff\U0001fb00-\U0010ffff]"
#: Longer pre-tokens are never cached, so that cache entries are bounded.
MAX_KEY = 48
_SUMMARY = "part int, tokens array<string>, counts array<long>"


@lru_cache(maxsize=4)
def load_tokenizer(path: str):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@lru_cache(maxsize=1)
def pre_tokens():
    """Splitter into pre-tokens, and the search for characters that forbid it."""
    import regex
    return regex.compile(PATTERN).findall, re.compile(NEWER).search


class Lengths(dict):
    """pre-token -> number of tokens: frequent ones from the broadcast table,
    others encoded once and cached until the cache is full."""

    def __init__(self, path: str, frequent: dict[str, int], limit: int = 300_000):
        super().__init__(frequent)
        self.frequent, self.limit = frequent, limit + len(frequent)
        self.encode = load_tokenizer(path).encode

    def __missing__(self, token: str) -> int:
        n = len(self.encode(token, add_special_tokens=False).ids)
        if len(token) <= MAX_KEY:
            if len(self) >= self.limit:
                self.clear()
                self.update(self.frequent)
            self[token] = n
        return n


def _specials(path: str) -> list[str]:
    return [t.content for t in load_tokenizer(path).get_added_tokens_decoder().values()]


def pieces(text: str, specials: list[str]) -> tuple[list[str], int]:
    """Text between added tokens, and how many of those there are."""
    parts = [text]
    for special in specials:
        if special in text:
            parts = [p for part in parts for p in part.split(special)]
    return parts, len(parts) - 1


def _heavy(counter: Counter, size: int) -> Counter:
    """The ``size`` largest counts (ties by token, so that reruns agree)."""
    if len(counter) <= size:
        return counter
    return Counter(dict(sorted(counter.items(), key=lambda kv: (-kv[1], kv[0]))[:size]))


def frequent_pretokens(docs: DataFrame, path: str, text_col: str = "text", *, entries: int = 16_384,
                       fan_in: int = 16) -> dict[str, int]:
    """The (approximately) most frequent pre-tokens of all documents with their
    token counts: at most ``entries``, about 1 MB.  Every partition counts whole
    texts by their pieces between spaces, pruning the counter to 4 x ``entries``
    whenever it grows beyond 16 x, cuts the pieces into pre-tokens and gives one
    summary row; summaries merge ``fan_in`` at a time."""
    short_batches(docs.sparkSession)
    text = docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))

    def summary(part: int, counter: Counter) -> pa.RecordBatch:
        top = _heavy(counter, entries)
        return pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([list(top)], pa.list_(pa.string())),
             pa.array([list(top.values())], pa.list_(pa.int64()))], names=["part", "tokens", "counts"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces_seen: Counter = Counter()
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                for value in batch.column(0).slice(start, 64).to_pylist():
                    pieces_seen.update(value.split(" "))
                if len(pieces_seen) > 16 * entries:
                    pieces_seen = _heavy(pieces_seen, 4 * entries)
        # a pre-token never goes on over a space, so each distinct piece is cut only once
        split, counter = pre_tokens()[0], Counter()
        for piece, n in pieces_seen.items():
            for token in split(" " + piece) if len(piece) <= 16 * MAX_KEY else ():
                if len(token) <= MAX_KEY:
                    counter[token] += n
        yield summary(TaskContext.get().partitionId(), counter)

    def merge(key: tuple, got: pa.Table) -> pa.Table:
        counter: Counter = Counter()
        for tokens, counts in zip(got["tokens"].to_pylist(), got["counts"].to_pylist()):
            counter.update(dict(zip(tokens, counts)))
        return pa.Table.from_batches([summary(key[0].as_py(), counter)])

    found = text.mapInArrow(count, _SUMMARY)
    left = (text.select(F.spark_partition_id().alias("p")).agg(F.max("p")).first()[0] or 0) + 1
    while left > 1:
        found = found.withColumn("grp", F.floor(F.col("part") / fan_in).cast("int")).groupBy("grp").applyInArrow(merge, _SUMMARY)
        left = -(-left // fan_in)
    row = found.first()  # one summary of at most `entries` short strings
    if row is None:
        return {}
    encoded = load_tokenizer(path).encode_batch(list(row["tokens"]), add_special_tokens=False)
    return {t: len(e.ids) for t, e in zip(row["tokens"], encoded)}


_COUNTED = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())])


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", *, limit: int = 512,
                 frequent: dict[str, int] | None = None) -> DataFrame:
    """One row per input row: ``doc_id, n_bytes, n_tokens, over_limit``.

    ``path`` is a byte-level BPE file of the ``tokenizers`` library, present on
    every machine.  Counts are those of that library for the whole text, without
    begin and end tokens; strings of added tokens inside a text are one token
    each, as by its default.  A null text counts as empty: 0 bytes, 0 tokens.
    ``frequent`` may carry a table from an earlier ``frequent_pretokens``; else
    it is built here.  Null identifiers and repeated rows pass through; other
    columns are ignored; an empty table gives an empty result.
    """
    short_batches(docs.sparkSession)
    table = frequent_pretokens(docs, path, text_col) if frequent is None else frequent
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length, specials, (split, newer) = Lengths(path, shared.value).__getitem__, _specials(path), pre_tokens()
        encode = load_tokenizer(path).encode
        for batch in batches:
            n = np.zeros(batch.num_rows, np.int64)
            size = np.zeros(batch.num_rows, np.int64)
            at = 0
            for start in range(0, batch.num_rows, 64):
                for text in batch.column(1).slice(start, 64).to_pylist():
                    if not text.isascii() and newer(text):
                        n[at] = len(encode(text, add_special_tokens=False).ids)
                    else:
                        parts, found = pieces(text, specials)
                        n[at] = found + sum(sum(map(length, split(p))) for p in parts)
                    size[at] = len(text.encode("utf-8"))
                    at += 1
            yield batch_of(_COUNTED, [batch.column(0), size, n, n > limit])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
