import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from barlab.llm.merkle import folded, leaf_digest, merkle_manifest, proof_digest
from tests.llm.conftest import edge_rows, rows_of


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    doc, text, lang, source, n = row
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc, source, lang, n, text)])


def climb(leaves, fan_out):
    """Top digest and, per leaf, its siblings level by level."""
    proofs = [[] for _ in leaves]
    at = list(range(len(leaves)))
    nodes = leaves
    while len(nodes) > 1:
        for k, place in enumerate(at):
            run = place // fan_out * fan_out
            proofs[k].append(("".join(nodes[run:place]), "".join(nodes[place + 1:run + fan_out])))
        nodes = [h(*nodes[i:i + fan_out]) for i in range(0, len(nodes), fan_out)]
        at = [place // fan_out for place in at]
    return nodes[0], proofs


def brute(rows, fan_out):
    groups = defaultdict(list)
    for r in rows:
        groups[r[3]].append((r[0], leaf(r)))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    done = {}
    for name in names:
        groups[name].sort(key=lambda d: (d[0] is not None, d[0] or 0, d[1]))
        done[name] = climb([d[1] for d in groups[name]], fan_out)
    root, upper = climb([done[name][0] for name in names], fan_out)
    out = []
    for name, above in zip(names, upper):
        subroot, proofs = done[name]
        for place, ((doc, digest), proof) in enumerate(zip(groups[name], proofs)):
            out.append((doc, name, place, digest, subroot, root, h(*[a + b for a, b in proof + above])))
    return sorted(out, key=lambda r: tuple((v is not None, v) for v in r))


COLUMNS = ("doc_id", "source", "position", "leaf", "subroot", "root", "proof")


def manifest(df, **kw):
    return merkle_manifest(df, **kw).withColumn("proof", proof_digest())


@pytest.mark.parametrize("fan_out", [2, 16])
def test_edges(edge, fan_out):
    got = manifest(edge.repartition(5), fan_out=fan_out)
    assert rows_of(got, *COLUMNS) == brute(edge_rows(), fan_out)


def test_empty_and_single(spark, empty):
    assert merkle_manifest(empty).collect() == []
    one = spark.createDataFrame([(1, "a", "en", "s", 1)], empty.schema)
    row = manifest(one).first()
    assert row["leaf"] == row["subroot"] == row["root"] and row["path"] == [] and row["proof"] == h()


def test_deep_tree_with_hot_group_and_short_last_run(spark, empty):
    rows = [(i // 2, f"text {i}", "en", "hot" if i % 3 else f"s{i % 57}", i) for i in range(1, 914)]
    rows += [(5, "same", "en", "hot", 1)] * 300  # rows equal in all fields
    got = manifest(spark.createDataFrame(rows, empty.schema).repartition(9), fan_out=3)
    assert rows_of(got, *COLUMNS) == brute(rows, 3)


def test_a_changed_field_is_found(spark, empty):
    rows = [(i, "Some Text" if i % 2 else "plain", None, "s", i) for i in range(40)]
    seen = leaf_digest(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), F.lower("text"))
    got = merkle_manifest(spark.createDataFrame(rows, empty.schema), carry={"seen": seen})
    got = got.select("doc_id", (folded("seen") == F.col("root")).alias("ok"), (folded("leaf") == F.col("root")).alias("same"))
    assert {(r["doc_id"] % 2, r["ok"], r["same"]) for r in got.collect()} == {(0, True, True), (1, False, True)}
