"""Exact dedup: tree-merge of sorted digest runs.

1. Every row gets the SHA-256 of its text; (id, digest) is written once.
2. Each partition sorts its digests into a *run*: one row per digest with the
   identifier that stays and the number of rows.
3. Binomial rounds: in round k the runs whose numbers agree after dropping k
   radix-``fan_in`` digits meet and are multiway-merged; equal digests collapse
   to one row whose identifier is chosen again.  A run is dealt out by digest
   range, so a merge holds one range of a few runs, never a whole table.  A
   group of copies of any size is one row per run, so it cannot skew a merge.
4. The merged answers are joined back to the rows; groups above a size that only
   a bounded number of groups can reach are broadcast, all others are joined by
   shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlab.llm.common import answers_to_rows, batch_of, written

RUN_SCHEMA = "rng int, run int, sha binary, keep_id long, n long"
_ARROW_RUN = pa.schema([("rng", pa.int32()), ("run", pa.int32()), ("sha", pa.binary()), ("keep_id", pa.int64()),
                        ("n", pa.int64())])


def _words(sha: list[bytes]) -> np.ndarray:
    """Digests as rows of four big-endian words, so that row order is digest order."""
    return np.frombuffer(b"".join(sha), dtype=">u8").reshape(-1, 4).astype(np.uint64)


def _merge_two(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row numbers that interleave two runs sorted by first word: a, then b + len(a)."""
    at = np.searchsorted(a, b, side="right") + np.arange(len(b))
    order = np.empty(len(a) + len(b), np.int64)
    from_a = np.ones(len(order), bool)
    from_a[at] = False
    order[at] = np.arange(len(b)) + len(a)
    order[from_a] = np.arange(len(a))
    return order


def merge_runs(words: np.ndarray, ids: np.ndarray, has_id: np.ndarray, n: np.ndarray, starts: list[int],
               keep_largest: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Merge runs, each sorted by digest, and collapse equal digests.

    ``starts`` gives each run's first row.  Runs are merged pairwise until one
    is left; rows whose first words tie are verified on all four words, so
    different digests never collapse.  Returns the row numbers of the first of
    each digest, identifiers, whether one is known, and row counts."""
    ends = [*starts[1:], len(words)]
    runs = [np.arange(s, e) for s, e in zip(starts, ends)]
    first = words[:, 0]
    while len(runs) > 1:
        merged = []
        for a, b in zip(runs[::2], runs[1::2]):
            both = np.concatenate([a, b])
            merged.append(both[_merge_two(first[a], first[b])])
        runs = merged + ([runs[-1]] if len(runs) % 2 else [])
    order = runs[0] if runs else np.empty(0, np.int64)
    w = words[order]
    tied = w[1:, 0] == w[:-1, 0]
    if np.any(tied & np.any(w[1:] != w[:-1], axis=1)):  # equal first word, other digest: order by all words
        order = order[np.lexsort((w[:, 3], w[:, 2], w[:, 1], w[:, 0]))]
        w = words[order]
    if not len(order):
        return order, ids, has_id, n
    new = np.concatenate([[True], np.any(w[1:] != w[:-1], axis=1)])
    at = np.flatnonzero(new)
    low, high = np.iinfo(np.int64).min, np.iinfo(np.int64).max
    if keep_largest:
        best = np.maximum.reduceat(np.where(has_id[order], ids[order], low), at)
    else:
        best = np.minimum.reduceat(np.where(has_id[order], ids[order], high), at)
    return order[at], best, np.logical_or.reduceat(has_id[order], at), np.add.reduceat(n[order], at)


def _ranges(words: np.ndarray, ranges: int) -> np.ndarray:
    """Range number of each digest: its leading 32 bits scaled to ``ranges``."""
    return ((words[:, 0] >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int32)


def _ids(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    has = np.asarray(column.is_valid())
    return np.asarray(column.fill_null(0)), has


def _output(words, sha, run, ranges, first, best, has, n) -> pa.RecordBatch:
    keep = pa.array(best, type=pa.int64(), mask=~has)
    return batch_of(_ARROW_RUN, [_ranges(words[first], ranges), np.full(len(first), run, np.int32),
                                 [sha[i] for i in first.tolist()], keep, n])


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, keep: str = "max",
                fan_in: int = 16, digests_per_range: int = 100_000) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Rows are one group when their texts are identical; a null text counts as
    the empty text.  The row with the largest identifier stays (``keep="min"``:
    the smallest).  A null identifier never wins against a known one; in a
    group that has only null identifiers ``keep_id`` is null and every row is
    kept, as none can be named.  Repeated rows (same identifier and text) count
    once each in ``group_size`` and share ``kept``.  An empty table gives an
    empty result; other columns of ``docs`` are ignored.
    """
    if keep not in ("max", "min"):
        raise ValueError("keep is 'max' or 'min'")
    largest = keep == "max"
    rows = written(docs.select(F.col(id_col).cast("long").alias("doc_id"),
                               F.unhex(F.sha2(F.coalesce(F.col(text_col).cast("string"), F.lit("")), 256)).alias("sha")),
                   "exact-digests")
    total, last = rows.select(F.spark_partition_id().alias("part")).agg(F.count("*"), F.max("part")).first()
    ranges = max(1, -(-total // digests_per_range))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = TaskContext.get().partitionId()
        got = pa.Table.from_batches(list(batches), schema=pa.schema([("doc_id", pa.int64()), ("sha", pa.binary())]))
        if not got.num_rows:
            return
        sha = got["sha"].to_pylist()
        words = _words(sha)
        ids, has = _ids(got["doc_id"].combine_chunks())
        order = np.lexsort((words[:, 3], words[:, 2], words[:, 1], words[:, 0]))
        first, best, known, n = merge_runs(words[order], ids[order], has[order], np.ones(len(sha), np.int64),
                                           [0], largest)
        yield _output(words, sha, run, ranges, order[first], best, known, n)

    def merge(key: tuple, got: pa.Table) -> pa.Table:
        run = np.asarray(got["run"])
        by_run = np.argsort(run, kind="stable")  # rows of one run arrive in any order; each run is re-sorted below
        sha = got["sha"].to_pylist()
        words = _words(sha)
        ids, has = _ids(got["keep_id"].combine_chunks())
        n = np.asarray(got["n"])
        order = by_run[np.lexsort((words[by_run, 0], run[by_run]))]
        starts = np.flatnonzero(np.concatenate([[True], run[order][1:] != run[order][:-1]])).tolist()
        first, best, known, n = merge_runs(words[order], ids[order], has[order], n[order], starts, largest)
        return pa.Table.from_batches([_output(words, sha, int(key[1].as_py()), ranges, order[first], best, known, n)])

    runs = rows.mapInArrow(build, RUN_SCHEMA)
    count = (last or 0) + 1
    while count > 1:
        grouped = runs.withColumn("grp", F.floor(F.col("run") / fan_in).cast("int"))
        runs = grouped.groupBy("rng", "grp").applyInArrow(merge, RUN_SCHEMA)
        count = -(-count // fan_in)
    answers = written(runs.select("sha", "keep_id", F.col("n").alias("group_size")), "exact-answers")

    joined = answers_to_rows(rows, answers, "sha", "group_size")
    return joined.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                         F.lower(F.hex("sha")).alias("text_sha256"))
