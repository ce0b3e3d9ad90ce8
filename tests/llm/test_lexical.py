import math
import re
from collections import Counter

import numpy as np
import pytest

from barlab.llm import lexical
from barlab.llm.lexical import lexical_search, search_block, terms_of
from tests.llm.conftest import edge_rows

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}
ITEMS = "item_id string, text string, score string, rank string, place string, part string"


def terms(text):
    return [t.translate(LOWER) for t in TERM.findall(text or "")]


def brute(docs, items, k=20):
    held = [(d, Counter(terms(t))) for d, t in docs if terms(t)]
    n_docs, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for doc, c in held:
            m = 75 + 25 * sum(c.values()) * n_docs // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 12 * m))
                        for t in terms(text) if t in c)
            if score > 0:
                scores.append((-score, (doc is not None, doc or 0), doc))
        out += [(item, r, doc, -s) for r, (s, _, doc) in enumerate(sorted(scores, key=lambda x: x[:2])[:k], 1)]
    return sorted(out, key=repr)


def found(df):
    return sorted([tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()], key=repr)


def items_frame(spark, items):
    return spark.createDataFrame([(i, t, "a", "b", "c", "d") for i, t in items], ITEMS)


ASKED = [("a", "the quick FOX the fox"), ("b", "word1 word2 and1 and1 größe Größe"), ("c", None), ("d", "... !!"), ("e", ""),
         ("f", "unheard of"), (None, "single 12345"), ("a", "日本語のテキスト tea"), ("g", "the quick FOX the fox"),
         ("h", " ".join(f"word{i}" for i in range(900)))]


@pytest.mark.parametrize("k,block_terms,block_docs", [(20, 200_000, 16_384), (2, 40, 3)])
def test_edges(spark, edge, k, block_terms, block_docs):
    docs = [(r[0], r[1]) for r in edge_rows()]
    got = lexical_search(edge.repartition(3), items_frame(spark, ASKED), k=k, block_terms=block_terms, block_docs=block_docs)
    assert found(got) == brute(docs, ASKED, k)


def test_empty(spark, empty, small):
    asked = items_frame(spark, ASKED)
    assert lexical_search(empty, asked).collect() == []
    assert lexical_search(small.limit(3), asked.limit(0)).collect() == []


def test_tests_data(spark, small):
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    docs = [(r["doc_id"], r["text"]) for r in small.collect()]
    items = [(r["item_id"], r["text"]) for r in bench.collect()]
    assert found(lexical_search(small.repartition(5), bench, k=7, block_docs=16)) == brute(docs, items, 7)


def test_blocks_with_creation_ended_are_whole():
    """Random postings with one very common, cheap term: scores of what is left
    are whole and nothing that reaches the k best is missing."""
    dice = np.random.default_rng(3)
    for _ in range(200):
        size, k = int(dice.integers(1, 60)), int(dice.integers(1, 6))
        weights = np.sort(dice.integers(0, 4000, 6))[::-1].astype(np.int64)
        held = [np.flatnonzero(dice.random(size) < p) for p in (0.05, 0.1, 0.2, 0.4, 0.8, 1.0)]
        impacts = [dice.integers(1, 900_000, len(x)) for x in held]
        starts = np.concatenate([[0], np.cumsum([len(x) for x in held])])
        asked = dice.integers(1, 4, 6)
        whole = np.zeros(size, np.int64)
        for t in range(6):
            whole[held[t]] += asked[t] * weights[t] * impacts[t]
        bar = int(dice.integers(0, whole.max() + 2)) if dice.random() < 0.3 else 0
        docs, scores = search_block(np.concatenate(held), np.concatenate(impacts), starts, size, np.arange(6), asked,
                                    weights, bar, k)
        got = dict(zip(docs.tolist(), scores.tolist()))
        kth = np.sort(whole)[::-1][min(k, size) - 1]
        assert all(got[d] == whole[d] for d in got if whole[d] >= max(bar, kth))
        assert {d for d in range(size) if whole[d] > 0 and whole[d] >= max(bar, kth)} <= set(got)


def test_creation_really_ends():
    docs = np.concatenate([np.arange(20), np.arange(1000)])
    impacts = np.concatenate([np.full(20, 900_000), np.full(1000, 10)])
    found_docs, _ = search_block(docs, impacts, np.array([0, 20, 1020]), 1000, np.array([0, 1]), np.array([1, 1]),
                                 np.array([5000, 1]), 0, 20)
    assert found_docs.tolist() == list(range(20))


def test_pieces_of_long_texts(monkeypatch):
    monkeypatch.setattr(lexical, "PIECE", 10)
    text = "Alpha beta-gamma  delta " + "x" * 35 + " é epsilon"
    assert [t.decode() for piece in terms_of(text.encode()) for t in piece] == terms(text)
