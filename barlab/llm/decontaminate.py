"""Benchmark decontamination with a generalised suffix automaton.

The normalised words of all benchmark items go into one suffix automaton.  The
words of a document are streamed through it: at each word the automaton knows
the longest run of words, ending there, that occurs in some item.  A run that
reaches the window length marks its last ``window`` words as hit; the state of
exactly that length names the items.  Items shorter than a window are one window
each and are found at their states on the suffix-link path.

The automaton depends on the benchmark only.  Its word count is checked: beyond
``block_words`` the items are dealt into blocks, each with an automaton of its
own and one pass over the documents, so that a task's memory stays bounded.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlab.llm.common import anti_rows, batch_of, short_batches, text_bytes, text_key, written

#: ASCII letters to lower case, other ASCII but digits to a space, the rest (UTF-8 beyond ASCII) as it is.
_PLAIN = bytes(c if c >= 0x80 or chr(c).isdigit() else ord(chr(c).lower()) if chr(c).isalpha() else 0x20
               for c in range(256))
_WORD = re.compile(rb"[^ ]+")


def plain(text: bytes) -> bytes:
    return text.translate(_PLAIN)


def word_chunks(text: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """Words of normalised text, about ``size`` bytes at a time."""
    start = 0
    while start < len(text):
        end = text.find(b" ", start + size)
        end = len(text) if end < 0 else end
        yield text[start:end].split()
        start = end


class SuffixAutomaton:
    """Generalised suffix automaton over word sequences.

    ``next`` has the transitions of each state, ``link`` its suffix link,
    ``length`` its longest run.  ``items[state]`` are the items that hold the run
    of exactly ``window`` words which the state stands for; ``short[state]`` the
    (length, item) of short items that end the state's run, own and inherited;
    ``alert[state]`` the match length from which anything is to be reported."""

    def __init__(self, sequences: list[tuple[str, list[bytes]]], window: int):
        self.window = window
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        for _, words in sequences:
            last = 0
            for word in words:
                last = self._extend(last, word)
        self.items: list[set[str] | None] = [None] * len(self.next)
        marks: dict[int, list[tuple[int, str]]] = {}
        for item, words in sequences:
            for state, matched in self.walk(words):
                if len(words) >= window and matched >= window:
                    at = self.of_length(state, window)
                    if self.items[at] is None:
                        self.items[at] = set()
                    self.items[at].add(item)
            if 0 < len(words) < window:
                state = 0
                for word in words:
                    state = self.next[state][word]
                marks.setdefault(state, []).append((len(words), item))
        self.short: list[list[tuple[int, str]]] = [[]] * len(self.next)
        for state in sorted(range(len(self.next)), key=self.length.__getitem__):
            own = marks.get(state, [])
            above = self.short[self.link[state]] if state else []
            self.short[state] = own + above if own else above
        never = 1 << 60
        self.alert = [min([window if self.length[s] >= window else never, *(n for n, _ in self.short[s])])
                      for s in range(len(self.next))]

    def _new(self, length: int, moves: dict[bytes, int], link: int) -> int:
        self.next.append(moves)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _extend(self, last: int, word: bytes) -> int:
        """State of the run ``last`` + ``word``, made if it is not there."""
        there = self.next[last].get(word)
        if there is not None:
            if self.length[there] == self.length[last] + 1:
                return there
            return self._clone(last, word, there)
        state = self._new(self.length[last] + 1, {}, 0)
        at = last
        while at >= 0 and word not in self.next[at]:
            self.next[at][word] = state
            at = self.link[at]
        if at >= 0:
            to = self.next[at][word]
            self.link[state] = to if self.length[to] == self.length[at] + 1 else self._clone(at, word, to)
        return state

    def _clone(self, at: int, word: bytes, to: int) -> int:
        """Split ``to``: a state for its runs of at most length(at) + 1."""
        clone = self._new(self.length[at] + 1, dict(self.next[to]), self.link[to])
        self.link[to] = clone
        while at >= 0 and self.next[at].get(word) == to:
            self.next[at][word] = clone
            at = self.link[at]
        return clone

    def of_length(self, state: int, n: int) -> int:
        """The state of the last ``n`` words of a match that ended in ``state``."""
        while self.length[self.link[state]] >= n:
            state = self.link[state]
        return state

    def walk(self, words, state: int = 0, matched: int = 0) -> Iterator[tuple[int, int]]:
        """(state, longest matching length) after each word."""
        moves, link, length = self.next, self.link, self.length
        for word in words:
            to = moves[state].get(word)
            if to is None:
                while state and to is None:
                    state = link[state]
                    to = moves[state].get(word)
                if to is None:
                    matched = 0
                else:
                    matched, state = length[state] + 1, to
            else:
                matched += 1
                state = to
            yield state, matched

    def scan(self, text: bytes) -> tuple[int, int, list[list[int]], set[str]]:
        """Of normalised text: words, longest match, merged hit spans (word
        numbers, end exclusive) and the items that were met."""
        moves, link, length, alert = self.next, self.link, self.length, self.alert
        state = matched = longest = at = 0
        spans: list[list[int]] = []
        items: set[str] = set()
        for words in word_chunks(text):
            for word in words:
                to = moves[state].get(word)
                if to is None:
                    while state and to is None:
                        state = link[state]
                        to = moves[state].get(word)
                    if to is None:
                        matched = 0
                    else:
                        matched, state = length[state] + 1, to
                else:
                    matched += 1
                    state = to
                at += 1
                if matched > longest:
                    longest = matched
                if matched >= alert[state]:
                    self._report(state, matched, at, spans, items)
        return at, longest, spans, items

    def _report(self, state: int, matched: int, at: int, spans: list[list[int]], items: set[str]) -> None:
        most = 0
        if matched >= self.window:
            found = self.items[self.of_length(state, self.window)]
            if found:
                most = self.window
                items |= found
        for n, item in self.short[state]:
            if n <= matched:
                most = max(most, n)
                items.add(item)
        if most:
            merge_span(spans, at - most, at)


def merge_span(spans: list[list[int]], start: int, end: int) -> None:
    """Add a span whose end is not before any other; touching spans become one."""
    while spans and spans[-1][1] >= start:
        start = min(start, spans.pop()[0])
    spans.append([start, end])


def without_spans(text: bytes, spans: list[list[int]]) -> bytes:
    """The text less the bytes from the first to the last word of each span."""
    if not spans:
        return text
    out, kept, k = [], 0, 0
    first = 0
    for number, word in enumerate(_WORD.finditer(plain(text))):
        if number == spans[k][0]:
            first = word.start()
        if number == spans[k][1] - 1:
            out.append(text[kept:first])
            kept, k = word.end(), k + 1
            if k == len(spans):
                break
    return b"".join([*out, text[kept:]])


_AUTOMATA: dict[str, SuffixAutomaton] = {}


def _automaton(sequences: list[tuple[str, bytes]], window: int) -> SuffixAutomaton:
    """Built once per worker and benchmark block."""
    key = hashlib.sha256(repr((window, sequences)).encode()).hexdigest()
    if key not in _AUTOMATA:
        _AUTOMATA.clear()
        _AUTOMATA[key] = SuffixAutomaton([(i, plain(t).split()) for i, t in sequences], window)
    return _AUTOMATA[key]


_SCANNED = ("doc_id long, text_key long, text string, n_words long, longest long, spans array<array<long>>, items array<string>")
_ARROW_SCANNED = pa.schema([
    ("doc_id", pa.int64()), ("text_key", pa.int64()), ("text", pa.string()), ("n_words", pa.int64()), ("longest", pa.int64()),
    ("spans", pa.list_(pa.list_(pa.int64()))), ("items", pa.list_(pa.string()))])
_RESULT = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("n_items", pa.int64()),
    ("items_sha256", pa.string()), ("contaminated", pa.bool_()), ("longest", pa.int64()),
    ("spans", pa.list_(pa.list_(pa.int64()))), ("items", pa.list_(pa.string())), ("clean_text", pa.string()),
    ("text_key", pa.int64())])


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, block_words: int) -> int:
    words = benchmark.agg(F.sum(F.regexp_count(F.coalesce(F.col(text_col).cast("string"), F.lit("")),
                                               F.lit("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+")))).first()[0] or 0
    return max(1, -(-words // block_words))


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", *, window: int = 13, max_share: int = 20,
                  block_words: int = 200_000, clean: bool = False) -> DataFrame:
    """One row per input row: ``doc_id, n_words, n_hit, n_items, items_sha256,
    contaminated, longest, spans, items, clean_text, text_key``.

    ``n_hit`` words lie inside an occurrence of a window (``window`` consecutive
    words of an item, or a whole shorter item); ``spans`` are those words'
    ranges, ``longest`` the longest run shared with any item, ``items`` the ids
    (as text, sorted) of items with an occurring window.  ``contaminated``: hit
    words are at least one in ``max_share``.  With ``clean``, ``clean_text`` is
    the text of a contaminated document without its spans, and the text as it is
    of any other; else it is null.

    Null or empty texts have no words and are clean.  Null identifiers and
    repeated rows pass through, one result row each.  Items without words have
    no window; equal items each count; a null item id counts as the empty id.
    An empty benchmark leaves all clean; an empty table gives an empty result;
    other columns are ignored.
    """
    short_batches(docs.sparkSession)
    spark = docs.sparkSession
    blocks = _blocks(benchmark, item_col, item_text_col, block_words)
    named = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"),
                             F.coalesce(F.col(item_text_col).cast("string"), F.lit("")).alias("words"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_key(text_col).alias("text_key"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    state = rows.select("*", F.lit(0).cast("long").alias("n_words"), F.lit(0).cast("long").alias("longest"),
                        F.array().cast("array<array<long>>").alias("spans"), F.array().cast("array<string>").alias("items"))
    for block in range(blocks):
        part = named if blocks == 1 else named.filter(F.pmod(F.xxhash64("item", "words"), F.lit(blocks)) == block)
        sequences = sorted((r["item"], r["words"].encode()) for r in part.toLocalIterator())  # bounded by block_words
        shared = spark.sparkContext.broadcast(sequences)
        state = _pass(state, shared, window, last=block == blocks - 1, max_share=max_share, clean=clean)
        if block < blocks - 1:
            state = written(state, "decontaminate-pass")
    return state


def _pass(state: DataFrame, shared, window: int, *, last: bool, max_share: int, clean: bool) -> DataFrame:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(shared.value, window)
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                out: list[list] = [[] for _ in range(9 if last else 4)]
                before = zip(*(part.column(k).to_pylist() for k in (4, 5, 6)))
                for text, (was, old, met) in zip(text_bytes(part.column(2)), before):
                    n, longest, spans, items = automaton.scan(plain(text))
                    if old:
                        merged: list[list[int]] = []
                        for a, b in sorted([*old, *spans], key=lambda s: (s[1], s[0])):
                            merge_span(merged, a, b)
                        spans = merged
                    names = sorted(items.union(met))
                    row = [n, max(longest, was), spans, names]
                    if last:
                        hit = sum(b - a for a, b in spans)
                        bad = hit > 0 and max_share * hit >= n
                        shown = (without_spans(text, spans) if bad else text).decode("utf-8") if clean else None
                        row = [n, hit, len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bad,
                               row[1], spans, names, shown]
                    for column, value in zip(out, row):
                        column.append(value)
                if last:
                    yield batch_of(_RESULT, [part.column(0), *out, part.column(1)])
                else:
                    yield batch_of(_ARROW_SCANNED, [part.column(0), part.column(1), part.column(2), *out])

    schema = ("doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, "
              "longest long, spans array<array<long>>, items array<string>, clean_text string, text_key long") if last else _SCANNED
    return state.mapInArrow(scan, schema)


def without_contaminated(docs: DataFrame, decided: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are, that are not contaminated."""
    gone = decided.filter("contaminated").select(F.col("doc_id").alias("__gone"), F.col("text_key").alias("__key")).distinct()
    return anti_rows(docs, gone, id_col, text_col)
