import hashlib
from collections import defaultdict

import numpy as np
import pytest

from barlab.llm.exact_dedup import exact_dedup, merge_runs
from tests.llm.conftest import edge_rows, rows_of


def brute(rows, best=max):
    groups = defaultdict(list)
    for doc, text, *_ in rows:
        groups[text or ""].append(doc)
    out = []
    for doc, text, *_ in rows:
        named = [d for d in groups[text or ""] if d is not None]
        keep = best(named) if named else None
        out.append((doc, keep, len(groups[text or ""]), doc == keep, hashlib.sha256((text or "").encode()).hexdigest()))
    return sorted(out, key=lambda r: tuple((v is not None, v) for v in r))


COLUMNS = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@pytest.mark.parametrize("keep,best", [("max", max), ("min", min)])
def test_edges(edge, keep, best):
    got = exact_dedup(edge.repartition(7), keep=keep, fan_in=2, digests_per_range=3)
    assert rows_of(got, *COLUMNS) == brute(edge_rows(), best)


def test_empty(empty):
    assert exact_dedup(empty).collect() == []


def test_equal_first_words_never_collapse():
    same = 7
    words = np.array([[same, 1, 0, 0], [same, 2, 0, 0], [same, 1, 0, 0], [same, 3, 0, 0]], np.uint64)
    first, ids, has, n = merge_runs(words, np.array([5, 6, 9, 1]), np.ones(4, bool), np.ones(4, np.int64), [0, 2], True)
    assert words[first, 1].tolist() == [1, 2, 3] and ids.tolist() == [9, 6, 1] and n.tolist() == [2, 1, 1]


def test_many_runs(spark):
    rows = [(i, f"text {i % 50}", None, None, None) for i in range(1_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert rows_of(exact_dedup(df.repartition(40), fan_in=3, digests_per_range=10), *COLUMNS) == brute(rows)
