"""Registered queries against SQL, and the pipeline against its parts."""

import pytest

import __spark_entry__ as E
import corpus_pipeline as C
from barlab.llm.queries import ORACLE_SQL, QUERIES
from barlab.plans.check import compare, duck
from tests.conftest import SF_SMOKE
from tests.llm.test_near import brute as near_brute
from tests.llm.test_decontaminate import brute as hit_brute


def test_registered():
    got = E.queries()
    assert set(QUERIES) | {"pipeline"} <= set(got) and set(ORACLE_SQL) <= set(E.oracle_sql())
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    r = compare(QUERIES[name](spark, SF_SMOKE).toPandas(), duck(SF_SMOKE).execute(ORACLE_SQL[name]).df())
    assert r["ok"], r


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_SMOKE}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF_SMOKE}/benchmark.parquet").select("item_id", "text").collect()]
    stage = dict(C.STAGES)
    assert [n for n, _ in C.STAGES] == ["language_id", "near_dedup", "decontamination", "mixing", "token_output"]

    known = stage["language_id"](spark, docs, SF_SMOKE)
    assert known.columns == docs.columns and known.count() == sum(any(map(str.isalpha, r[1])) for r in rows)
    kept = stage["near_dedup"](spark, docs, SF_SMOKE)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(d for d, _, _, k in near_brute(rows, 5) if k)
    clean = stage["decontamination"](spark, docs, SF_SMOKE)
    assert sorted(r["doc_id"] for r in clean.collect()) == sorted(r[0] for r in hit_brute(rows, items) if not r[5])
    mixed = stage["mixing"](spark, docs, SF_SMOKE)
    assert mixed.columns == docs.columns
    words = docs.selectExpr("sum(regexp_count(text, '[^ \\t\\n]+'))").first()[0]
    assert abs(mixed.selectExpr("sum(regexp_count(text, '[^ \\t\\n]+'))").first()[0] - words) < 0.05 * words


def test_run_gives_the_last_stage(spark):
    out = C.run(spark, SF_SMOKE)
    assert out.columns[:4] == ["shard", "row", "n_tokens", "ids"] and out.count() > 0


def test_edges_pass_all_stages(spark, edge, empty):
    for docs in (edge, empty):
        for _, stage in C.STAGES[:-1]:
            out = stage(spark, docs, SF_SMOKE)
            assert out.columns == docs.columns
            docs = C.written(out, "test")
        assert C.STAGES[-1][1](spark, docs, SF_SMOKE).count() >= 0
