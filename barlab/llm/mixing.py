"""Mixing sources to target weights by a time-varying curriculum (DataFrame only).

Each source has a *target* number of words (its weight's share of all words, at
most ``max_epochs`` times its size) and a *schedule*: how strongly it is asked
for as training goes from 0 to 1.  The schedule is integrated to a cumulative
demand curve that ends at the target.  Documents of a source stand in a hashed
order; a copy whose words lie at cumulative demand ``y`` gets the training
position at which the curve reaches ``y`` (the curve is inverted in closed form,
piece by piece).  ``training_order`` range-sorts the copies by position.

Scale: a source of any size is cut into hash buckets of about
``rows_per_bucket`` rows.  Words are summed per bucket first, the running sums
over buckets and sources are small tables, and the running sum inside a bucket
is a window over that bucket alone -- a hot source is spread over as many tasks
as it has buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlab.llm.common import same_row, text_key, written

#: (progress, weight) knots; weight is linear between knots.  Sources take the
#: schedules in turn, in the order of their names.
STEADY = ((0.0, 1.0), (1.0, 1.0))
LATE = ((0.0, 0.25), (0.5, 0.75), (1.0, 2.0))
EARLY = ((0.0, 2.0), (0.6, 0.75), (1.0, 0.25))

WORD = r"[^\x20\x09-\x0D]+"
_HASH_BITS = 52


def schedule_pieces(knots: Sequence[tuple[float, float]]) -> list[tuple[float, float, float, float, float]]:
    """Pieces ``(y0, u0, u1, w0, w1)`` of the integral of a schedule, scaled to
    end at 1: from progress ``u0``, where the integral is ``y0``, to ``u1``."""
    if len(knots) < 2 or knots[0][0] != 0.0 or knots[-1][0] != 1.0 or any(w < 0 for _, w in knots):
        raise ValueError("a schedule has knots from 0 to 1 with weights of at least 0")
    spans = [(u0, u1, w0, w1) for (u0, w0), (u1, w1) in zip(knots, knots[1:])]
    area = sum((u1 - u0) * (w0 + w1) / 2 for u0, u1, w0, w1 in spans)
    if area <= 0 or any(u1 <= u0 for u0, u1, _, _ in spans):
        raise ValueError("a schedule needs rising knots and a positive integral")
    out, y = [], 0.0
    for u0, u1, w0, w1 in spans:
        out.append((y, u0, u1, w0 / area, w1 / area))
        y += (u1 - u0) * (w0 + w1) / 2 / area
    return out


def inverse_demand(y: Column, pieces: list[tuple[float, float, float, float, float]]) -> Column:
    """Progress at which the scaled integral reaches ``y`` (0 to 1)."""
    out = F.lit(None).cast("double")
    for y0, u0, u1, w0, w1 in pieces:  # later pieces override earlier ones
        slope, rest = (w1 - w0) / (u1 - u0), F.greatest(y - F.lit(y0), F.lit(0.0))
        # rest = w0*d + slope*d^2/2, solved in the form that is stable for slope = 0 and w0 = 0
        root = F.sqrt(F.greatest(F.lit(w0 * w0) + F.lit(2 * slope) * rest, F.lit(0.0)))
        d = F.when(rest <= 0, F.lit(0.0)).otherwise(F.lit(2.0) * rest / (F.lit(w0) + root))
        out = F.when(y >= F.lit(y0), F.least(F.lit(u0) + d, F.lit(u1))).otherwise(out)
    return out


def _order_hash() -> Column:
    """52 bits of the MD5 of the identifier: the order inside a source."""
    digits = F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), 1, 13)
    return F.conv(digits, 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float], max_epochs: int) -> DataFrame:
    """``source, source_size, target, turn`` from one row per source.

    Sources in code point order (null last) take ``weights`` in turn and share
    all words by weight; a target stops at ``max_epochs`` times its source's
    size and the excess is shared again by weight until none is above.  That is
    water-filling: with sources ordered by size per weight, the first k stop at
    their limit, for the smallest k at which the next one stays below it."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.row_number().over(by_name) - 1
    w = sizes.withColumn("turn", turn)
    w = w.withColumn("weight", F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                                            (F.col("turn") % len(weights) + 1).cast("int")))
    w = w.withColumn("cap", F.col("source_size") * F.lit(float(max_epochs)))
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), "turn")
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    left = (F.sum("source_size").over(every).cast("double") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
    weight_left = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    w = w.withColumn("level", left / weight_left)
    # a source is below its limit exactly when the level of the first such source is
    w = w.withColumn("water", F.when(F.col("cap") >= F.col("weight") * F.col("level"), F.col("level")))
    water = F.first("water", ignorenulls=True).over(by_cap.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return w.select("source", "source_size", "turn",
                    F.least(F.col("cap"), F.coalesce(F.col("weight") * water, F.col("cap"))).alias("target"))


def curriculum_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", *,
                   weights: Sequence[float] = (5, 2, 1), max_epochs: int = 3,
                   schedules: Sequence[Sequence[tuple[float, float]]] = (STEADY, LATE, EARLY),
                   rows_per_bucket: int = 2_000) -> DataFrame:
    """One row per input row: ``doc_id, source, size, source_size, target, copies,
    positions`` and ``bucket, row, text_key``, which name the row.

    ``size`` counts the words of the whole text (null or empty: 0).  ``copies``
    says how often the mix takes the document (0 to ``max_epochs``) and
    ``positions`` has a training position in [0, 1] for each copy.  Whole
    documents are taken in hashed order, epoch after epoch, while the middle of
    the document lies before the target; then the document whose size is nearest
    to what the source is off by is added or left out, where that brings the
    sum nearer (done twice).  Documents without words are taken 0 times.

    A null source is a source of its own.  Repeated rows and rows with the same
    or a null identifier are documents of their own; among equal identifiers the
    longer stands first.  Reruns give the same result.  An empty table gives
    an empty result; other columns are ignored.
    """
    rows = written(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                               text_key(text_col).alias("text_key"), F.regexp_count(F.coalesce(F.col(text_col).cast("string"), F.lit("")), F.lit(WORD))
                               .cast("long").alias("size")).withColumn("h", _order_hash()), "mix-rows")
    total = rows.count()
    buckets = max(1, -(-total // rows_per_bucket))
    rows = rows.withColumn("bucket", F.floor(F.col("h") * F.lit(float(buckets)) / F.lit(float(1 << _HASH_BITS))).cast("long"))
    same = F.col("source").eqNullSafe(F.col("s_source"))

    sums = written(rows.groupBy("source", "bucket").agg(F.sum("size").alias("words")), "mix-buckets")
    targets = written(source_targets(sums.groupBy("source").agg(F.sum("words").alias("source_size")), weights, max_epochs),
                      "mix-targets")
    few = targets.limit(100_001).count() <= 100_000

    def with_targets(df: DataFrame, right: DataFrame) -> DataFrame:
        right = right.withColumnRenamed("source", "s_source")
        return df.join(F.broadcast(right) if few else right, same).drop("s_source")

    running = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.withColumn("offset", F.coalesce(F.sum("words").over(running), F.lit(0))).select(
        F.col("source").alias("s_source"), F.col("bucket").alias("s_bucket"), "offset")
    inside = Window.partitionBy("source", "bucket").orderBy("h", "doc_id", F.col("size").desc())
    placed = (rows.withColumn("before", F.coalesce(
                  F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
              .withColumn("row", F.row_number().over(inside)))
    placed = placed.join(offsets, same & (F.col("bucket") == F.col("s_bucket"))).withColumn(
        "start", F.col("before") + F.col("offset")).drop("s_source", "s_bucket", "before", "offset", "h")
    placed = with_targets(placed, targets)
    # copy e covers words [e*source_size + start, + size) of what the source gives; its middle must lie before the target
    middle = F.col("start") + F.col("size") / 2.0
    copies = F.ceil((F.col("target") - middle) / F.nullif(F.col("source_size"), F.lit(0)))
    placed = written(placed.withColumn("copies", F.when(F.col("size") == 0, 0).otherwise(
        F.least(F.greatest(F.coalesce(copies, F.lit(0)), F.lit(0)), F.lit(max_epochs))).cast("int")), "mix-placed")

    for step in range(2):
        placed = _nudged(placed, with_targets, max_epochs)
        if step == 0:
            placed = written(placed, "mix-nudged")
    return _positions(placed, schedules).select("doc_id", "source", "size", "source_size", "target", "copies",
                                                "positions", "bucket", "row", "text_key")


def _nudged(placed: DataFrame, with_targets, max_epochs: int) -> DataFrame:
    """Add or leave out one copy of the document nearest in size to what its
    source is off by, if that brings the source nearer to its target."""
    off = placed.groupBy("source").agg((F.first("target") - F.sum(F.col("copies") * F.col("size"))).alias("off"))
    seen = with_targets(placed, off)
    can = F.when(F.col("off") > 0, F.col("copies") < max_epochs).otherwise(F.col("copies") > 0)
    miss = F.abs(F.col("size") - F.abs("off"))
    best = (seen.filter(can & (F.col("size") > 0) & (miss < F.abs("off"))).groupBy("source")
            .agg(F.min(F.struct(miss.alias("miss"), "bucket", "row")).alias("best"), F.first("off").alias("off")))
    best = best.select("source", F.col("best.bucket").alias("b_bucket"), F.col("best.row").alias("b_row"),
                       F.signum("off").cast("int").alias("change"))
    best = written(best.withColumnRenamed("source", "s_source"), "mix-best")  # counted below, then joined
    hit = (F.col("source").eqNullSafe(F.col("s_source")) & (F.col("bucket") == F.col("b_bucket"))
           & (F.col("row") == F.col("b_row")))
    joined = placed.join(F.broadcast(best) if best.limit(100_001).count() <= 100_000 else best, hit, "left")
    return joined.withColumn("copies", F.col("copies") + F.coalesce("change", F.lit(0))).drop(
        "s_source", "b_bucket", "b_row", "change")


def _positions(placed: DataFrame, schedules) -> DataFrame:
    pieces = [schedule_pieces(s) for s in schedules]

    def at(epoch: Column) -> Column:
        y = F.least((epoch * F.col("source_size") + F.col("start") + F.col("size") / 2.0) / F.col("target"), F.lit(1.0))
        out = inverse_demand(y, pieces[0])
        for k in range(1, len(pieces)):
            out = F.when(F.col("turn") % len(pieces) == k, inverse_demand(y, pieces[k])).otherwise(out)
        return out

    some = F.transform(F.sequence(F.lit(0), F.greatest(F.col("copies") - 1, F.lit(0))), at)
    return placed.withColumn("positions", F.when(F.col("copies") > 0, some).otherwise(F.array().cast("array<double>")))


def training_order(plan: DataFrame, partitions: int | None = None) -> DataFrame:
    """Copies range-sorted by training position; documents that the mix leaves
    out come last with a null position.  Ties go by identifier, then epoch."""
    copies = plan.select("*", F.posexplode_outer("positions").alias("epoch", "position")).drop("positions")
    keys = [F.col("position").asc_nulls_last(), F.col("doc_id").asc_nulls_last(), F.col("epoch").asc_nulls_last()]
    spread = copies.repartitionByRange(partitions, *keys) if partitions else copies.repartitionByRange(*keys)
    return spread.sortWithinPartitions(*keys)


def mixed_documents(docs: DataFrame, plan: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    source_col: str = "source") -> DataFrame:
    """The copies that ``plan`` takes, each a row of ``docs`` with all its columns
    as they are, range-sorted by training position.

    A row is found by identifier, text and source.  Rows that agree in these share
    the positions of their plan rows evenly, whatever else they differ in: rows are
    told apart by a 64-bit hash of the other columns, equal rows are counted, and
    each kind of row takes as many places in turn as it has rows.  No row is lost
    and none meets all its likes in one task."""
    key = [F.col(id_col).cast("long").alias("__gone"), text_key(text_col).alias("__key"), F.col(source_col).cast("string").alias("__source")]
    by_row = plan.groupBy(F.col("doc_id").alias("__gone"), F.col("text_key").alias("__key"), F.col("source").alias("__source")).agg(
        F.array_sort(F.flatten(F.collect_list("positions"))).alias("__positions"), F.count("*").alias("__rows"))
    by_row = written(by_row, "mix-plan")
    rest = [c for c in docs.columns if c not in (id_col, text_col, source_col)]
    kind = F.xxhash64(*rest) if rest else F.lit(0).cast("long")
    same = same_row(id_col, text_col) & F.col(source_col).cast("string").eqNullSafe(F.col("__source"))
    once = docs
    if by_row.filter("__rows > 1").limit(1).count():
        kinds = docs.select(*key, kind.alias("__kind")).groupBy("__gone", "__key", "__source", "__kind").agg(F.count("*").alias("__n"))
        w = Window.partitionBy("__gone", "__key", "__source").orderBy("__kind").rowsBetween(Window.unboundedPreceding, -1)
        kinds = kinds.withColumn("__first", F.coalesce(F.sum("__n").over(w), F.lit(0)))
        kinds = kinds.withColumnsRenamed({c: f"{c}_k" for c in ("__gone", "__key", "__source")})
        likes = (F.col("__gone").eqNullSafe(F.col("__gone_k")) & (F.col("__key") == F.col("__key_k"))
                 & F.col("__source").eqNullSafe(F.col("__source_k")))
        turn = lambda i: F.pmod(i, F.col("__rows"))
        own = F.filter("__positions", lambda _, i: (turn(i) >= F.col("__first")) & (turn(i) < F.col("__first") + F.col("__n")))
        by_row = by_row.join(kinds, likes).select("__gone", "__key", "__source", "__kind", own.alias("__positions"))
        once = docs.dropDuplicates(docs.columns)
        same &= kind == F.col("__kind")
    taken = once.join(by_row.filter(F.size("__positions") > 0), same)
    copies = taken.select(*docs.columns, F.posexplode("__positions").alias("__epoch", "__position"))
    keys = ["__position", F.col(id_col).asc_nulls_last(), "__epoch"]
    return copies.repartitionByRange(*keys).sortWithinPartitions(*keys).select(*docs.columns)
