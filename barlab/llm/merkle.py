"""Merkle manifest of a dataset: leaves, subtrees per group, one root, proofs.

Every row is a leaf: the SHA-256 of its fields, each with its length.  The leaves
of one group (a source), in order of their identifiers, are cut into runs of
``fan_out``; the digest of a run's digests is a node of the next level, until one
node, the group's subroot, is left.  The subroots, in order of their groups, are
the leaves of the upper tree, whose last node is the root of the dataset.

* Positions: the leaves are range-sorted by (group, identifier, digest) once; a
  leaf's position is its place in its range plus the leaves of its group in
  earlier ranges.  A group of any size is as many ranges as it needs.
* A level is one window per run: ``lag`` and ``lead`` columns at the fixed
  offsets 1 .. ``fan_out - 1``, masked by the slot in the run and by the run's
  length, are a node's siblings before and after it.  The first child of a run
  hashes itself and what follows: the parent.  Levels shrink ``fan_out``-fold and
  are written, so a lost executor re-reads a level and climbs no tree again.
* Proofs go down: a node's path is its own siblings and then its parent's path.
  Window and join share the key (group, run), hence one exchange, and no key has
  more than ``fan_out`` rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlab.llm.common import small_join, written

PATH = "array<struct<before:string,after:string>>"


def leaf_digest(*fields: Column) -> Column:
    """Lowercase hex SHA-256 of the fields in order, each ``-`` if null, else its
    UTF-8 byte count, ``:`` and its text."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.when(t.isNull(), F.lit("-"))
                             .otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]), 256)


def folded(leaf: str, path: str = "path") -> Column:
    """The root that a leaf digest leads to with the siblings of ``path``."""
    return F.aggregate(path, F.col(leaf), lambda h, s: F.sha2(F.concat(s["before"], h, s["after"]), 256))


def proof_digest(path: str = "path") -> Column:
    """SHA-256 of the siblings' digests, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), ""), 256)


def _positions(rows: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """``rows`` (with ``grp``, never null) with ``pos``, the place in the group
    from 0, and ``n``, the group's size."""
    by = [F.col("grp"), *order]
    ranged = (rows.repartitionByRange(*by).sortWithinPartitions(*by)
              .withColumn("at", F.monotonically_increasing_id()))
    placed = written(ranged, name).withColumn("part", F.shiftright("at", 33))
    parts = placed.groupBy("grp", "part").agg(F.min("at").alias("first"), F.count("*").alias("here"))
    w = Window.partitionBy("grp")
    parts = written(parts.select(
        "grp", "part", "first", F.sum("here").over(w).alias("n"),
        F.coalesce(F.sum("here").over(w.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("start")),
        f"{name}-parts")
    return (small_join(placed, parts, ["grp", "part"])
            .withColumn("pos", F.col("at") - F.col("first") + F.col("start")).drop("at", "part", "first", "start"))


def _siblings(nodes: DataFrame, fan_out: int) -> DataFrame:
    """Nodes of groups that go on climbing, with the digests before and after
    them in their run."""
    run = "OVER (PARTITION BY grp, run ORDER BY pos)"
    before = [f"CASE WHEN slot >= {k} THEN lag(digest, {k}) {run} ELSE '' END" for k in range(fan_out - 1, 0, -1)]
    after = [f"CASE WHEN slot + {k} < length THEN lead(digest, {k}) {run} ELSE '' END" for k in range(1, fan_out)]
    runs = nodes.filter("n > 1").selectExpr("*", f"pos div {fan_out} AS run", f"pos % {fan_out} AS slot",
                                            f"least({fan_out}, n - pos + pos % {fan_out}) AS length")
    return runs.selectExpr(*nodes.columns, "run", f"concat({', '.join(before)}) AS before", f"concat({', '.join(after)}) AS after")


def _climb(leaves: DataFrame, fan_out: int, name: str) -> list[DataFrame]:
    """The levels ``grp, pos, n, digest`` from the leaves up; a group's top node
    is the one with ``n = 1``."""
    levels = [leaves]
    most = leaves.agg(F.max("n")).first()[0] or 0
    while most > 1:
        first = _siblings(levels[-1].select("grp", "pos", "n", "digest"), fan_out).filter(f"pos % {fan_out} = 0")
        levels.append(written(first.selectExpr("grp", "run AS pos", f"(n + {fan_out - 1}) div {fan_out} AS n",
                                               "sha2(concat(digest, after), 256) AS digest"), f"{name}-{len(levels)}"))
        most = -(-most // fan_out)
    return levels


def _tops(levels: list[DataFrame]) -> DataFrame:
    tops = [lv.filter("n = 1").select("grp", F.col("digest").alias("top")) for lv in levels]
    out = tops[0]
    for t in tops[1:]:
        out = out.unionByName(t)
    return out


def _descend(levels: list[DataFrame], tops: DataFrame, fan_out: int) -> DataFrame:
    """The lowest level's rows with what ``tops`` (``grp, path, ...``) says of
    their group, ``path`` starting with their own siblings."""
    told = [c for c in tops.columns if c not in ("grp", "path")]
    above = None
    for level in reversed(levels):
        ended = level.filter("n = 1").join(tops, "grp")
        if above is None:
            above = ended
            continue
        parents = above.select("grp", F.col("pos").alias("run"), F.col("path").alias("upper"), *told)
        inner = _siblings(level, fan_out).join(parents, ["grp", "run"])
        inner = inner.selectExpr(*[c if c != "path" else "concat(array(struct(before, after)), upper) AS path"
                                   for c in ended.columns])
        above = inner.union(ended)
    return above


def merkle_manifest(docs: DataFrame, fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
                    id_col: str = "doc_id", group_col: str = "source", *, fan_out: int = 16,
                    carry: Mapping[str, Column] | None = None) -> DataFrame:
    """One row per input row: ``doc_id, source`` (the group), ``position`` (from
    0 in the group), ``leaf, subroot, root, path`` and the columns of ``carry``
    (expressions over ``docs``).  ``path`` holds the digests before and after a
    node in its run, level by level from the leaf to the root: enough to fold a
    leaf to the root with :func:`folded`.

    A null in any field counts as ``-``, an empty text as ``0:``.  Null
    identifiers come first in their group and the null group comes before all
    others.  Rows with equal identifiers are ordered by leaf digest; repeated rows
    are equal leaves, one position each.  A run may hold fewer nodes, even one,
    whose parent is still its digest; a group of one row has its leaf as subroot,
    one group's subroot is the root.  Very long texts are hashed whole where they
    are read and never moved.  An empty table gives an empty result; other columns
    of ``docs``, whatever their names, are ignored.
    """
    if fan_out < 2:
        raise ValueError("a node needs room for two children")
    carried = dict(carry or {})
    group = F.col(group_col).cast("string")
    leaves = docs.select(
        F.coalesce(F.concat(F.lit("="), group), F.lit("")).alias("grp"), F.col(id_col).cast("long").alias("doc_id"),
        leaf_digest(*[F.col(c) for c in fields]).alias("digest"),
        (F.struct(*[c.alias(name) for name, c in carried.items()]) if carried else F.lit(0)).alias("carried"))
    # written before the range sort, which samples its input; rid spreads rows that are equal in all fields
    leaves = written(leaves, "merkle-digests").withColumn("rid", F.monotonically_increasing_id())
    placed = _positions(leaves, [F.col("doc_id").asc_nulls_first(), F.col("digest"), F.col("rid")], "merkle-leaves")
    lower = _climb(placed, fan_out, "merkle-level")

    subroots = written(_tops(lower), "merkle-subroots").select(F.lit(0).alias("grp"), F.col("grp").alias("name"),
                                                              F.col("top").alias("digest"))
    upper = _climb(_positions(subroots, [F.col("name")], "merkle-upper"), fan_out, "merkle-upper-level")
    root = _tops(upper).select("grp", F.col("top").alias("root"), F.array().cast(PATH).alias("path"))
    groups = _descend(upper, root, fan_out).select(F.col("name").alias("grp"), F.col("digest").alias("subroot"), "root", "path")

    found = _descend(lower, groups, fan_out)
    source = F.when(F.col("grp") != "", F.substring("grp", 2, 2_147_483_647)).alias("source")
    return found.select("doc_id", source, F.col("pos").alias("position"), F.col("digest").alias("leaf"), "subroot", "root",
                        "path", *[F.col("carried")[name].alias(name) for name in carried])
