"""Exact quantiles (linear interpolation) of groups of any size.

* :func:`group_quantiles`: one per group, by refining a histogram: each pass counts
  a group's values in ``buckets`` equal steps of the interval that still holds the
  wanted ranks, and goes on with the step they fall into.  A pass shuffles one row
  per group, step and task, whatever the size of the group.
* :func:`quantile_so_far`: at every row of an unbroken series, over all values up to
  it.  Values are counted in global buckets per chunk; prefix sums over chunks say
  in which buckets of the past a chunk's ranks lie, and only these buckets' values
  go to the chunk.  With ``m`` rows in the chunk and ``n`` values before it, the
  ranks asked for are at most about ``2 m`` places of the ``n``.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlab.operators import zigzag as zz
from barlab.session import scratch_dir, ship_package


def written(df: DataFrame, name: str) -> DataFrame:
    """Through the shared folder: the next pass starts from files."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _known(c: str):
    return F.col(c).isNotNull() & ~F.isnan(c)


# --------------------------------------------------------------------------- one value a group
def group_quantiles(df: DataFrame, src: str, shares: dict[str, float], keys: Sequence[str], *, buckets: int = 1024,
                    enough: int = 4096) -> DataFrame:
    """``keys``, ``n`` and a column per entry of ``shares`` (name -> share): exact
    quantiles of the known (not NULL, not NaN) values.  Groups without a known
    value have no row; NULL keys are a group.

    When at most ``enough`` rows (or one value, or values that no step can tell
    apart) are left per wanted rank, these are grouped by value, so that ties
    collapse before they meet, and the ranks are read off."""
    names = [f"__g{k}" for k in range(len(keys))]
    rows = df.filter(_known(src)).select(*[F.col(c).alias(n) for c, n in zip(keys, names)], F.col(src).cast("double").alias("__v"))
    whole = rows.groupBy(*names).agg(F.count("*").alias("n"), F.min("__v").alias("a"), F.max("__v").alias("b"))
    wanted = F.explode(F.array(*[F.struct(F.lit(name).alias("name"), F.lit(float(q)).alias("q")) for name, q in shares.items()]))
    state = whole.withColumn("__w", wanted).select(
        *names, "n", "a", "b", F.col("__w.name").alias("name"), F.lit(0).cast("long").alias("below"), F.col("n").alias("left"),
        (F.col("__w.q") * (F.col("n") - 1)).alias("place"))
    state = written(state.withColumn("lo", F.floor("place")), "quantile-state")
    same = F.lit(True)
    for n in names:
        same &= F.col(n).eqNullSafe(F.col(f"s{n}"))
    w = Window.partitionBy(*[f"s{n}" for n in names], "name").orderBy("bucket")
    while True:
        open_ranks = state.filter((F.col("left") > enough) & (F.col("a") < F.col("b")))
        if not open_ranks.limit(1).count():
            break
        asked = open_ranks.withColumnsRenamed({n: f"s{n}" for n in names})
        step = F.least(F.floor((F.col("__v") / 2 - F.col("a") / 2) / (F.col("b") / 2 - F.col("a") / 2) * buckets), F.lit(buckets - 1))
        counts = (rows.join(asked, same & F.col("__v").between(F.col("a"), F.col("b")))
                  .groupBy(*[f"s{n}" for n in names], "name", "n", "place", "lo", "below", "left", "a", "b", step.alias("bucket"))
                  .agg(F.count("*").alias("here"), F.min("__v").alias("first"), F.max("__v").alias("last")))
        at = F.col("below") + F.sum("here").over(w.rowsBetween(Window.unboundedPreceding, 0))
        counts = counts.withColumn("upto", at)  # at most `buckets` rows a window
        hits = counts.filter((F.col("upto") > F.col("lo")) & (F.col("upto") - F.col("here") <= F.least(F.col("lo") + 1, F.col("n") - 1)))
        found = hits.groupBy(*[f"s{n}" for n in names], "name").agg(
            F.first("n").alias("n"), F.min("first").alias("a"), F.max("last").alias("b"),
            F.min(F.col("upto") - F.col("here")).alias("below"), F.sum("here").alias("left"), F.first("place").alias("place"),
            F.first("lo").alias("lo"), F.first("left").alias("was"))
        # a step that keeps all rows tells nothing apart: the values are read off as they are
        moved = found.withColumnsRenamed({f"s{n}": n for n in names}).withColumn(
            "left", F.when(F.col("left") < F.col("was"), F.col("left")).otherwise(F.lit(0)))
        done = state.filter((F.col("left") <= enough) | (F.col("a") >= F.col("b")))
        state = written(done.unionByName(moved.drop("was")), "quantile-state")

    asked = state.withColumnsRenamed({n: f"s{n}" for n in names})
    values = (rows.join(asked, same & F.col("__v").between(F.col("a"), F.col("b")))
              .groupBy(*[f"s{n}" for n in names], "name", "n", "place", "lo", "below", "__v").agg(F.count("*").alias("here")))
    w = Window.partitionBy(*[f"s{n}" for n in names], "name").orderBy("__v").rowsBetween(Window.unboundedPreceding, 0)
    values = values.withColumn("upto", F.col("below") + F.sum("here").over(w))
    read = lambda rank: F.min(F.when(F.col("upto") > rank, F.col("__v")))
    per_rank = values.groupBy(*[f"s{n}" for n in names], "name", "n").agg(
        read(F.col("lo")).alias("x"), read(F.least(F.col("lo") + 1, F.col("n") - 1)).alias("y"),
        F.first(F.col("place") - F.col("lo")).alias("part"))
    per_rank = per_rank.withColumn("value", F.col("x") + (F.col("y") - F.col("x")) * F.col("part"))
    out = per_rank.groupBy(*[f"s{n}" for n in names], "n").agg(
        *[F.max(F.when(F.col("name") == name, F.col("value"))).alias(name) for name in shares])
    return out.select(*[F.col(f"s{n}").alias(c) for c, n in zip(keys, names)], "n", *shares)


def fill_with_median(df: DataFrame, src: str, out: str, keys: Sequence[str]) -> DataFrame:
    """NULLs replaced by the group's exact median, groups of any size."""
    medians = group_quantiles(df, src, {"__median": 0.5}, keys).drop("n")
    medians = medians.withColumnsRenamed({c: f"__m_{c}" for c in keys})
    same = F.lit(True)
    for c in keys:
        same &= F.col(c).eqNullSafe(F.col(f"__m_{c}"))
    joined = df.join(medians, same, "left")
    return joined.withColumn(out, F.coalesce(F.col(src), F.col("__median"))).drop("__median", *[f"__m_{c}" for c in keys])


# --------------------------------------------------------------------------- at every row of a series
def _edges(q: float, coarse: int, fine: int) -> list[float]:
    """Shares at which buckets end: everywhere, and densely around ``q``, where the
    running quantile of a long series stays."""
    near = [q + 0.05 * (2 * k / fine - 1) for k in range(fine + 1)]
    return sorted({round(x, 9) for x in [k / coarse for k in range(1, coarse)] + near if 0 < x < 1})


def quantile_so_far(df: DataFrame, src: str, q: float, out: str, *, keys: Sequence[str] = ("symbol",), chunk: str = "dt",
                    order: str = "ts", coarse: int = 128, fine: int = 256) -> DataFrame:
    """Adds the exact quantile of all known values of the unbroken series up to
    each row, the row's own included (W18, W19); NULL before the first one.

    No task holds a series: the largest groups are a chunk with the values of the
    past that its ranks need, and a series' table of one row per chunk with its
    bucket counts."""
    of_chunk = [*keys, chunk]
    shares = _edges(q, coarse, fine)
    size = len(shares) + 1
    known = df.filter(_known(src)).select(*of_chunk, F.col(src).cast("double").alias("__v"))
    edges = known.groupBy(*keys).agg(F.percentile_approx("__v", shares, 20_000).alias("__edges"))
    edges = edges.withColumnsRenamed({c: f"__e_{c}" for c in keys})
    same = F.lit(True)
    for c in keys:
        same &= F.col(c).eqNullSafe(F.col(f"__e_{c}"))
    # binary search: how many edges are at or below the value
    steps = ", ".join(str(1 << k) for k in reversed(range(size.bit_length())))
    bucket = F.expr(f"aggregate(array({steps}), 0, (at, s) -> CASE WHEN at + s <= {size - 1} AND "
                    "try_element_at(__edges, at + s) <= __v THEN at + s ELSE at END)")
    held = (known.join(edges, same).select(*of_chunk, "__v", bucket.alias("__b")).groupBy(*of_chunk, "__b")
            .agg(F.count("*").alias("__n"), F.collect_list("__v").alias("__x")))
    held = written(held, "quantile-buckets")

    counts = held.groupBy(*of_chunk).agg(F.sum("__n").alias("m"), F.map_from_entries(F.collect_list(F.struct("__b", "__n"))).alias("by"))
    counts = counts.selectExpr(*of_chunk, "m", f"transform(sequence(0, {size - 1}), b -> coalesce(by[b], 0L)) AS counts")
    kind = (f"array<struct<chunk:{df.schema[chunk].dataType.simpleString()}, before:bigint, below:bigint, first:int, last:int>>")
    # the buckets that hold the places zigzag.ranks_needed names, and the values below them
    low = f"greatest(0L, CAST(floor({q!r}D * greatest(y.before - 1, 0)) AS BIGINT) - c.m - 1)"
    high = f"least(y.before - 1, CAST(floor({q!r}D * greatest(y.before + c.m - 1, 0)) AS BIGINT) + 1)"
    scan = (f"aggregate(y.counts, named_struct('at', 0L, 'b', 0, 'below', 0L, 'first', -1, 'last', -1), (s, n) -> named_struct("
            f"'at', s.at + n, 'b', s.b + 1, 'below', CASE WHEN s.at + n <= {low} THEN s.below + n ELSE s.below END, "
            f"'first', CASE WHEN s.first < 0 AND s.at + n > {low} THEN s.b ELSE s.first END, "
            f"'last', CASE WHEN s.last < 0 AND s.at + n > {high} THEN s.b ELSE s.last END))")
    told = (f"transform(array({scan}), s -> named_struct('chunk', c.`{chunk}`, 'before', y.before, 'below', s.below, "
            "'first', s.first, 'last', s.last))")
    step = (f"named_struct('before', y.before + c.m, 'counts', zip_with(y.counts, c.counts, (a, b) -> a + b), "
            f"'out', concat(y.out, CAST({told} AS {kind})))")
    begin = f"named_struct('before', 0L, 'counts', array_repeat(0L, {size}), 'out', CAST(array() AS {kind}))"
    needs = (counts.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(chunk, "m", "counts"))).alias("chunks"))
             .selectExpr(*[f"`{c}`" for c in keys], f"explode(aggregate(chunks, {begin}, (y, c) -> {step}, y -> y.out)) AS need")
             .filter("need.before > 0")
             .select(*keys, F.col("need.chunk").alias(chunk), F.col("need.before").alias("before"), F.col("need.below").alias("below"),
                     F.explode(F.sequence("need.first", "need.last")).alias("__b")))

    past = held.select(*[F.col(c).alias(f"__e_{c}") for c in keys], F.col(chunk).alias("__then"), F.col("__b").alias("__pb"), "__x")
    parts = needs.join(past, same & (F.col("__b") == F.col("__pb")) & (F.col("__then") < F.col(chunk)))
    parts = parts.select(*of_chunk, "before", "below", "__x")
    ship_package(df.sparkSession)
    schema = T.StructType([*[f for f in df.schema.fields if f.name != out], T.StructField(out, T.DoubleType())])

    def per_chunk(rows: pd.DataFrame, seen: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(order, kind="stable").reset_index(drop=True)
        x = rows[src].to_numpy(float)
        if len(seen):
            part = sorted(v for values in seen["__x"] for v in values)
            found = zz.quantiles_from(part, int(seen["below"].iloc[0]), int(seen["before"].iloc[0]), x, q)
        else:
            found = zz.quantiles_so_far([], x, q)
        return rows.assign(**{out: found}).reindex(columns=schema.names)

    got = df.groupBy(*of_chunk).cogroup(parts.groupBy(*of_chunk)).applyInPandas(per_chunk, schema)
    return got.withColumn(out, F.when(~F.isnan(out), F.col(out)))
