"""Token ids packed into rows of fixed length, best fit decreasing.

Documents are encoded and cut, without loss, into pieces of at most ``row_len``
tokens.  Pieces are packed in windows of about ``window_tokens`` tokens, so that
memory is bounded whatever a partition holds: longest first, each into the open
row with the least room that still takes it.  Rooms are kept in a segment tree
over capacities (leaf r: how many open rows have r tokens left), so that search
takes log2(row_len) steps.  No shuffle: a partition packs its own documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlab.llm.common import batch_of, short_batches


@lru_cache(maxsize=4)
def load_ranks(path: str):
    """Encoder of a ``.tiktoken`` rank file; its largest id plus one is free."""
    import base64

    import public_tokenizers
    import tiktoken
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("rows", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


class Rooms:
    """Segment tree over capacities 0..size: finds the least room >= a length."""

    def __init__(self, size: int):
        self.leaves = 1
        while self.leaves <= size:
            self.leaves *= 2
        self.count = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(self.leaves)]

    def add(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        node = room + self.leaves
        while node:
            self.count[node] += 1
            node //= 2

    def take(self, length: int) -> tuple[int, int] | None:
        """(room, row) of the tightest open row that takes ``length``, removed; None if there is none."""
        node = length + self.leaves
        if not self.count[node]:
            while True:  # up until a right sibling holds rows
                if node <= 1:
                    return None
                if node % 2 == 0 and self.count[node + 1]:
                    node += 1
                    break
                node //= 2
            while node < self.leaves:  # down to its least capacity
                node *= 2
                if not self.count[node]:
                    node += 1
        room = node - self.leaves
        while node:
            self.count[node] -= 1
            node //= 2
        return room, self.rows[room].pop()


def best_fit_decreasing(lengths: list[int], row_len: int) -> list[list[int]]:
    """Piece numbers of each row.  Pieces go longest first, ties by number."""
    rooms, rows = Rooms(row_len), []
    for piece in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        n = lengths[piece]
        found = rooms.take(n)
        if found is None:
            rows.append([piece])
            room, row = row_len - n, len(rows) - 1
        else:
            room, row = found[0] - n, found[1]
            rows[row].append(piece)
        if room:
            rooms.add(room, row)
    return rows


_PACKED = pa.schema([
    ("shard", pa.int32()), ("row", pa.int64()), ("n_tokens", pa.int32()), ("ids", pa.binary()),
    ("cu_seqlens", pa.list_(pa.int32())), ("position_ids", pa.binary()), ("doc_ids", pa.list_(pa.int64())),
    ("offsets", pa.list_(pa.int64()))])
PACKED_SCHEMA = ("shard int, row long, n_tokens int, ids binary, cu_seqlens array<int>, position_ids binary, "
                 "doc_ids array<long>, offsets array<long>")


def pack_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", *, row_len: int = 2048,
                end_id: int | None = None, pad_id: int = 0, window_tokens: int = 2_000_000) -> DataFrame:
    """One row per packed row of ``row_len`` tokens.

    ``ids`` is the row of the id matrix (little-endian unsigned, 2 bytes each up
    to 65,536 ids, else 4; ``pad_id`` after ``n_tokens``); ``cu_seqlens`` starts
    at 0 and has the running length after each segment; ``position_ids`` (same
    width as ids) restart at 0 with each segment; ``doc_ids`` and ``offsets``
    name each segment's document and its first token's place in that document,
    so that a document is the join of its segments.  ``(shard, row)`` is unique.

    ``end_id`` is appended to every document if given.  A text without tokens
    (null or empty, no ``end_id``) gives no segment.  Documents with a null or a
    repeated identifier are packed each on their own; other columns are ignored;
    an empty table gives an empty result.
    """
    short_batches(docs.sparkSession)
    end = [] if end_id is None else [end_id]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard, done = load_ranks(path), TaskContext.get().partitionId(), 0
        wide = max(encoder.n_vocab, pad_id + 1, (end_id or 0) + 1, row_len) > 65_536
        kind = np.dtype("<u4" if wide else "<u2")
        count = np.arange(row_len, dtype=kind)

        def emit(parts: list[tuple[int | None, int, np.ndarray]]) -> Iterator[pa.RecordBatch]:
            nonlocal done
            rows = best_fit_decreasing([len(p[2]) for p in parts], row_len)
            for start in range(0, len(rows), 512):
                out: list[list] = [[] for _ in _PACKED]
                for at, row in enumerate(rows[start:start + 512], start):
                    ids, position = np.full(row_len, pad_id, kind), np.zeros(row_len, kind)
                    ends = [0]
                    for k in row:
                        piece = parts[k][2]
                        ids[ends[-1]:ends[-1] + len(piece)] = piece
                        position[ends[-1]:ends[-1] + len(piece)] = count[:len(piece)]
                        ends.append(ends[-1] + len(piece))
                    for column, value in zip(out, (shard, done + at, ends[-1], ids.tobytes(), ends, position.tobytes(),
                                                   [parts[k][0] for k in row], [parts[k][1] for k in row])):
                        column.append(value)
                yield batch_of(_PACKED, out)
            done += len(rows)

        held: list[tuple[int | None, int, np.ndarray]] = []
        tokens = 0
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    ids = encoder.encode_to_numpy(text, disallowed_special=()).astype(kind)
                    if end:
                        ids = np.concatenate([ids, np.array(end, kind)])
                    for first in range(0, len(ids), row_len):
                        held.append((doc, first, ids[first:first + row_len]))
                        tokens += len(held[-1][2])
                        if tokens >= window_tokens:
                            yield from emit(held)
                            held, tokens = [], 0
        if held:
            yield from emit(held)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(pack, PACKED_SCHEMA)


def write_packed(packed: DataFrame, path: str) -> None:
    """Write the packed rows as Parquet under ``path``, a folder that all
    executors share, one file per shard, replacing what is there."""
    packed.write.mode("overwrite").parquet(path)


def segments(packed: DataFrame, row_len: int = 2048) -> DataFrame:
    """``doc_id, offset, ids``: the packed segments again, ids as bytes; joined
    in order of offset they give each document's ids."""
    cut = packed.select("*", F.posexplode("doc_ids").alias("k", "doc_id")).withColumn(
        "width", (F.length("ids") / row_len).cast("int"))
    first = F.element_at("cu_seqlens", F.col("k") + 1)
    last = F.element_at("cu_seqlens", F.col("k") + 2)
    return cut.select("doc_id", F.element_at("offsets", F.col("k") + 1).alias("offset"),
                      F.substring(F.col("ids"), first * F.col("width") + 1, (last - first) * F.col("width")).alias("ids"))
