import math
import re

import pytest

from barlab.llm.mixing import (EARLY, LATE, STEADY, curriculum_mix, inverse_demand, mixed_documents, schedule_pieces,
                               training_order)
from tests.llm.conftest import SCHEMA, edge_rows


def targets(sizes, weights=(5, 2, 1), most=3):
    """Shares by weight; what is above ``most`` times a source's size is shared again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    fixed, total = {}, sum(sizes.values())
    while True:
        free = [s for s in names if s not in fixed]
        if not free:
            return fixed
        left, w = total - sum(fixed.values()), sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / w > most * sizes[s]]
        if not over:
            return fixed | {s: left * weight[s] / w for s in free}
        fixed |= {s: most * sizes[s] for s in over}


def count(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def check(rows, got):
    sizes = {}
    for _, text, _, source, _ in rows:
        sizes[source] = sizes.get(source, 0) + count(text)
    want = targets(sizes)
    assert sorted((r["doc_id"] or -1, r["size"]) for r in got) == sorted((r[0] or -1, count(r[1])) for r in rows)
    for source in sizes:
        own = [r for r in got if r["source"] == source]
        assert all(r["source_size"] == sizes[source] for r in own)
        assert all(math.isclose(r["target"], want[source], abs_tol=1e-6) for r in own)
        taken = sum(r["copies"] * r["size"] for r in own)
        assert abs(taken - want[source]) <= max((r["size"] for r in own), default=0) / 2 + 1e-6
        assert all(0 <= r["copies"] <= 3 and len(r["positions"]) == r["copies"] for r in own)
        assert all(0 <= p <= 1 for r in own for p in r["positions"])


def test_edges(edge, empty):
    check(edge_rows(), curriculum_mix(edge).collect())
    assert curriculum_mix(empty).collect() == [] and training_order(curriculum_mix(empty)).collect() == []


def test_small_sources_stop_at_three_times_their_size(spark):
    rows = [(k, "w " * 5, None, "a", None) for k in range(4)] + [(10 + k, "w " * (k % 9 + 1), None, "b", None) for k in range(300)]
    rows += [(500 + k, "w " * 3, None, "c", None) for k in range(200)]
    got = curriculum_mix(spark.createDataFrame(rows, SCHEMA), rows_per_bucket=20).collect()
    check(rows, got)
    assert {r["copies"] for r in got if r["source"] == "a"} == {3}


def test_reruns_and_buckets_agree(small):
    a, b = (sorted((r["doc_id"], r["copies"], tuple(r["positions"])) for r in curriculum_mix(d, rows_per_bucket=n).collect())
            for d, n in ((small, 7), (small.repartition(9), 1_000)))
    assert a == b


@pytest.mark.parametrize("knots", [STEADY, LATE, EARLY, ((0.0, 0.0), (1.0, 1.0)), ((0.0, 1.0), (0.3, 0.0), (0.6, 0.0), (1.0, 2.0))])
def test_inverse_of_integrated_schedule(spark, knots):
    from pyspark.sql import functions as F
    got = spark.range(0, 101).select((F.col("id") / 100.0).alias("y")).withColumn("u", inverse_demand(F.col("y"), schedule_pieces(knots)))

    def integral(u):
        out = 0.0
        for (u0, w0), (u1, w1) in zip(knots, knots[1:]):
            top = min(u, u1)
            if top > u0:
                at_top = w0 + (w1 - w0) * (top - u0) / (u1 - u0)
                out += (top - u0) * (w0 + at_top) / 2
        return out

    for r in got.collect():
        assert abs(integral(r["u"]) / integral(1.0) - r["y"]) < 1e-9


def test_order_follows_positions(small):
    got = [r["position"] for r in training_order(curriculum_mix(small), 3).collect()]
    known = [p for p in got if p is not None]
    assert known == sorted(known) and all(p is None for p in got[len(known):])


def test_late_schedule_comes_late(small):
    rows = curriculum_mix(small, schedules=(STEADY, LATE, EARLY)).selectExpr("source", "explode(positions) AS p").toPandas()
    mean = rows.groupby("source")["p"].mean()
    names = sorted(mean.index)
    assert sum(mean[n] for n in names[1::3]) / len(names[1::3]) > 0.55 > 0.45 > sum(mean[n] for n in names[2::3]) / len(names[2::3])


def test_mixed_documents_repeat_whole_rows(edge):
    plan = curriculum_mix(edge)
    mixed = mixed_documents(edge, plan)
    assert mixed.columns == edge.columns
    want = {}
    for r in plan.collect():
        key = (r["doc_id"], r["size"])
        want[key] = want.get(key, 0) + r["copies"]
    got = {}
    for r in mixed.select("doc_id", "text").collect():
        key = (r["doc_id"], count(r["text"]))
        got[key] = got.get(key, 0) + 1
    assert got == {k: n for k, n in want.items() if n}


def test_no_python_in_plan(small):
    for df in (training_order(curriculum_mix(small)), mixed_documents(small, curriculum_mix(small))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan


def test_rows_that_share_identifier_and_text_stay_apart(spark):
    """Two sources, two languages, repeated rows: each row's copies are its own."""
    rows = [(1, "one two three", "en", "a", 1), (1, "one two three", "en", "b", 1), (1, "one two three", "de", "a", 1),
            (1, "one two three", "de", "a", 1), (1, "one two three", None, None, None), (None, "x y", "en", "a", 2),
            (None, "x y", "en", "a", 2), (None, "x y", "en", "b", 2), (2, "single row of a", "en", "a", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    plan = curriculum_mix(docs)
    want, got = {}, {}
    for r in plan.collect():
        key = (r["doc_id"], r["size"], r["source"])
        want[key] = want.get(key, 0) + r["copies"]
    mixed = [tuple(r) for r in mixed_documents(docs.repartition(4), plan).collect()]
    assert set(mixed) <= set(rows)
    for r in mixed:
        key = (r[0], count(r[1]), r[3])
        got[key] = got.get(key, 0) + 1
    assert got == {k: n for k, n in want.items() if n}
    of_a = [r for r in mixed if r[0] == 1 and r[3] == "a"]
    assert abs(sum(r[2] == "de" for r in of_a) * 1 - sum(r[2] == "en" for r in of_a) * 2) <= 2  # two rows of three
