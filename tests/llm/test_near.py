import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from barlab.llm import near_dedup as nd
from barlab.llm.components import components
from barlab.llm.near_dedup import near_dedup, one_of_each
from tests.llm.conftest import SCHEMA, edge_rows, rows_of

WHITE = " \t\n\x0b\x0c\r"


def shingles(text, width):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = "".join(" " if c in WHITE else c for c in lower).split(" ")
    words = [w for w in words if w]
    if len(words) < width:
        return {tuple(words)} if words else set()
    return set(zip(*(words[k:] for k in range(width))))


def brute(rows, width):
    """Components over all pairs; classes without a named row are not linked."""
    sets = [shingles(r[1], width) for r in rows]
    named = {frozenset(s) for r, s in zip(rows, sets) if r[0] is not None}
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            equal = a == b
            linked = a and b and (equal or (frozenset(a) in named and frozenset(b) in named))
            if linked and 100 * len(a & b) >= 80 * len(a | b):
                parent[find(i)] = find(j)
    lowest = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            lowest[find(i)] = min(r[0], lowest.get(find(i), r[0]))
    out = [(r[0], len(sets[i]), (lowest.get(find(i)) if sets[i] else r[0])) for i, r in enumerate(rows)]
    return sorted(((d, n, c, d == c) for d, n, c in out), key=lambda r: tuple((v is not None, v) for v in r))


def varied(n, seed, vocabulary=300, length=60, edits=6):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(vocabulary)}" for _ in range(length)]
    rows = []
    for k in range(n):
        words = list(base)
        for _ in range(rng.randrange(edits)):
            words[rng.randrange(length)] = f"x{rng.randrange(10 ** 6)}"
        rows.append((k, " ".join(words), None, None, None))
    return rows


COLUMNS = ("doc_id", "n_shingles", "component_id", "kept")


@pytest.mark.parametrize("width", [2, 5])
def test_edges(edge, width):
    assert rows_of(near_dedup(edge, shingle_words=width), *COLUMNS) == brute(edge_rows(), width)


def test_empty(empty):
    assert near_dedup(empty).collect() == []


def test_group_with_differing_pairs(spark):
    rows = varied(250, 1, edits=9) + [(1_000 + k, f"other text number {k} of its own kind {k * 7}", None, None, None)
                                      for k in range(50)]
    assert rows_of(near_dedup(spark.createDataFrame(rows, SCHEMA), shingle_words=2), *COLUMNS) == brute(rows, 2)


def test_crowded_regions_go_deeper(spark, monkeypatch):
    monkeypatch.setattr(nd, "REGION", 12)
    rows = varied(120, 3, edits=4)
    got = {r["doc_id"]: r["component_id"] for r in near_dedup(spark.createDataFrame(rows, SCHEMA), shingle_words=2).collect()}
    want = {r[0]: r[2] for r in brute(rows, 2)}
    assert sum(got[k] != want[k] for k in want) <= 0.05 * len(want)
    assert all(want[got[k]] == want[k] for k in want)  # never joined across components


def test_signature_estimates_similarity():
    rng = np.random.default_rng(0)
    pool = rng.integers(0, 2 ** 63, 3_000).astype(np.uint64)
    a, b = nd.minhash(pool[:2_000]), nd.minhash(pool[1_000:])
    assert abs((a == b).mean() - 1 / 3) < 0.15


def test_components_of_chains_and_stars(spark):
    name = lambda k: bytes([k // 256, k % 256])
    chain = [(name(k), name(k + 1)) for k in range(0, 300)]
    star = [(name(1_000), name(1_000 + k)) for k in range(1, 100)]
    edges = spark.createDataFrame(chain + star, "a binary, b binary").repartition(9)
    got = {bytes(r["node"]): bytes(r["root"]) for r in components(edges).collect()}
    assert got == {name(k): name(0) for k in range(301)} | {name(1_000 + k): name(1_000) for k in range(100)}


def test_stage_keeps_one_of_each(spark, edge):
    kept = one_of_each(edge, near_dedup(edge))
    assert kept.columns == edge.columns
    ids = sorted(r["doc_id"] for r in kept.select("doc_id").collect() if r["doc_id"] is not None)
    assert ids == [1, 4, 5, 6, 7, 9, 11, 12, 13]
    assert kept.filter("doc_id IS NULL AND text = 'only without a name'").count() == 1
    assert one_of_each(edge.filter(F.lit(False)), near_dedup(edge.filter(F.lit(False)))).count() == 0


def test_crowded_regions_are_compared_whole(spark, monkeypatch):
    monkeypatch.setattr(nd, "REGION", 4)
    rows = varied(150, 5, edits=16)
    got = {r["doc_id"]: r["component_id"] for r in near_dedup(spark.createDataFrame(rows, SCHEMA), shingle_words=2).collect()}
    assert got == {r[0]: r[2] for r in brute(rows, 2)}
