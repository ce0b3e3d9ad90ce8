"""MinHash near-dedup with an LSH forest.

1. Each text becomes its set of hashed word shingles.  Texts with equal sets are
   one *class*; only classes are compared.  A class has ``TREES * BAND`` minhash
   values; tree t sorts classes by the values from place ``t * BAND`` on, round
   the end.  Classes that share a tree's first ``BAND`` values are a *region*.
2. Regions of one class end here (a count by key, no signatures moved).  For
   round one alone, a region with more than ``REGION`` classes is cut by longer
   prefixes of its own order, as deep as it takes; classes that agree to the last
   depth are dealt into blocks, other ones in each tree.
3. Round one: neighbours in each region's order, whose common prefix is the
   longest, are candidates.  Candidates whose signatures are alike enough are
   confirmed on full shingle sets; links give components.
4. Rounds two and three: within a region, classes of *different* components are
   compared by signature, and all pairs that may be links are confirmed -- first
   the likeliest few per class and component, then all that are left.  In a
   region of more than ``FEW_CLASSES`` classes the comparing task holds the
   lowest ``SKETCH`` hashes of each set, which is the whole set of most texts:
   it confirms there and then, joins components as it goes and gives out only
   links that join two of them, and pairs of longer texts that need the full sets.
   A region of more than ``REGION`` classes is first compared within the groups
   of round one, then whole: its classes are dealt into blocks, and every two
   blocks meet in a task, but for blocks of the region's largest component.
   Pairs inside one component are never made, so a group of n near copies costs
   about n links, not n squared pairs, and yet no link between different
   components that share a region is passed over.

Two texts with similarity 0.8 miss all 24 regions with probability 7e-5.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlab.llm.common import (WordHash, answers_to_rows, anti_rows, batch_of, short_batches, small_join, text_bytes, text_key,
                               written)
from barlab.llm.components import components
from barlab.llm.decontaminate import word_chunks

TREES, BAND = 24, 5
HASHES = TREES * BAND
#: Classes of a region that one task compares; larger regions are compared by pairs of blocks of about so many.
REGION = 2_048
#: Beyond so many classes a region's pairs are confirmed where they are compared, on the lowest hashes of each set.
FEW_CLASSES, SKETCH = 24, 1_024
#: Prefix lengths tried in turn for crowded regions.
DEPTHS = (8, 12, 20, 40, HASHES)

_rng = np.random.default_rng(20240229)
_A = (_rng.integers(0, 1 << 32, HASHES, dtype=np.uint64).astype(np.uint32)) | np.uint32(1)
_B = _rng.integers(0, 1 << 32, HASHES, dtype=np.uint64).astype(np.uint32)
_C1, _C2, _C3 = (np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _C2
    h = (h ^ (h >> np.uint64(27))) * _C3
    return h ^ (h >> np.uint64(31))


def shingle_set(text: bytes, words_of: WordHash, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles of ``width`` words
    (ASCII letters lower-cased); with fewer words, of the whole sequence."""
    parts = [words_of.of(words) for words in word_chunks(text.lower().replace(b"\n", b" "))]
    words = np.concatenate(parts) if parts else np.empty(0, np.uint64)
    width = min(width, len(words))
    if not width:
        return words
    h = np.full(len(words) - width + 1, np.uint64(width), np.uint64)
    for k in range(width):
        h = _mixed(h * _C1 + words[k:len(words) - width + 1 + k])
    return np.unique(h)


def minhash(shingles: np.ndarray) -> np.ndarray:
    low = (shingles ^ (shingles >> np.uint64(32))).astype(np.uint32)
    out = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for start in range(0, len(low), 256):
        np.minimum(out, (low[start:start + 256, None] * _A + _B).min(0), out=out)
    return out


def region_keys(signature: np.ndarray) -> np.ndarray:
    bands = signature.reshape(TREES, BAND).astype(np.uint64)
    h = np.arange(1, TREES + 1, dtype=np.uint64)
    for k in range(BAND):
        h = _mixed(h * _C1 + bands[:, k])
    return h.view(np.int64)


_SIGNED = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("n", pa.int64()), ("cls", pa.binary()), ("keys", pa.list_(pa.int64())),
                     ("sig", pa.binary())])


def _sign(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    words_of = WordHash()
    for batch in batches:
        for start in range(0, batch.num_rows, 512):
            part = batch.slice(start, 512)
            out: list[list] = [[] for _ in range(4)]
            for text in text_bytes(part.column(2)):
                found = shingle_set(text, words_of, width)
                row = [0, None, None, None]
                if len(found):
                    signature = minhash(found)
                    # the last byte of each value: two classes differ in it by chance once in 256
                    row = [len(found), hashlib.blake2b(found.tobytes(), digest_size=16).digest(),
                           region_keys(signature), (signature & np.uint32(255)).astype(np.uint8).tobytes()]
                for column, value in zip(out, row):
                    column.append(value)
            yield batch_of(_SIGNED, [part.column(0), part.column(1), *out])


def _sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    words_of = WordHash()
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            sets = [shingle_set(t, words_of, width).tobytes() for t in text_bytes(batch.column(0).slice(start, 256))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([hashlib.blake2b(s, digest_size=16).digest() for s in sets], pa.binary()),
                 pa.array(sets, pa.binary())], names=["cls", "shingles"])


def whole_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables that end where ``key`` changes, from batches sorted by it."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.asarray(batch.column(key))
        change = np.flatnonzero(keys[1:] != keys[:-1])
        if held and keys[0] != held[-1].column(key)[-1].as_py():
            yield pa.Table.from_batches(held)
            held = []
        if len(change):
            cut = int(change[-1]) + 1
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = [batch.slice(cut)]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


_PAIR = pa.schema([("a", pa.binary()), ("b", pa.binary())])


def _members(table: pa.Table) -> tuple[np.ndarray, list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    sig = np.frombuffer(b"".join(table["sig"].to_pylist()), np.uint8).reshape(-1, HASHES)
    return (np.asarray(table["grp"]), table["cls"].to_pylist(), np.asarray(table["n"]), np.asarray(table["tree"]), sig)


def _pairs(cls: list[bytes], left: np.ndarray, right: np.ndarray) -> pa.RecordBatch:
    ordered = [(cls[i], cls[j]) if cls[i] < cls[j] else (cls[j], cls[i]) for i, j in zip(left.tolist(), right.tolist())]
    return batch_of(_PAIR, [[p[0] for p in ordered], [p[1] for p in ordered]])


def _near(n: np.ndarray, left, right, percent: int) -> np.ndarray:
    """Sizes alone allow the similarity."""
    return 100 * np.minimum(n[left], n[right]) >= percent * np.maximum(n[left], n[right])


def _neighbours(batches: Iterator[pa.RecordBatch], percent: int, alike: float, reach: int) -> Iterator[pa.RecordBatch]:
    """Pairs at most ``reach`` places apart in a region's order."""
    for table in whole_groups(batches, "grp"):
        grp, cls, n, tree, sig = _members(table)
        rolled = sig[np.arange(len(sig))[:, None], (np.arange(24) + (tree * BAND)[:, None]) % HASHES]
        deep = np.ascontiguousarray(rolled).view(">u8")
        order = np.lexsort((n, deep[:, 2], deep[:, 1], deep[:, 0], grp))
        for step in range(1, reach + 1):
            left, right = order[:-step], order[step:]
            same = (grp[left] == grp[right]) & _near(n, left, right, percent)
            left, right = left[same], right[same]
            for start in range(0, len(left), 8_192):
                i, j = left[start:start + 8_192], right[start:start + 8_192]
                likely = (sig[i] == sig[j]).mean(1) >= alike
                if likely.any():
                    yield _pairs(cls, i[likely], j[likely])


_JUDGED = pa.schema([("a", pa.binary()), ("b", pa.binary()), ("link", pa.bool_())])


def _judged(x: np.ndarray, y: np.ndarray, n_x: int, n_y: int, percent: int) -> bool | None:
    """Whether two sets are linked, from their lowest hashes: known if these are
    the whole sets; else None unless the estimate is five deviations too low."""
    if n_x <= SKETCH and n_y <= SKETCH:
        both = len(np.intersect1d(x, y, assume_unique=True))
        return 100 * both >= percent * (n_x + n_y - both)
    lowest = np.union1d(x, y)[:SKETCH]
    share = np.isin(lowest, x, assume_unique=True) & np.isin(lowest, y, assume_unique=True)
    return None if share.mean() >= percent / 100 - 5 * 0.5 / len(lowest) ** 0.5 else False


def _across(batches: Iterator[pa.RecordBatch], percent: int, alike: float, few: int | None) -> Iterator[pa.RecordBatch]:
    """Pairs of a region whose classes are in different components: of each class
    of the component with fewer members here, the ``few`` likeliest in each
    other component, or all that may be links.  ``link`` is known (true) where
    sketches are at hand and decide, else null.  Where two blocks meet, ``side``
    is 1 or 2 and only pairs across are made; elsewhere it is 0.

    A pair that meets in several uncrowded regions is made in the first alone."""
    for table in whole_groups(batches, "grp"):
        grp, cls, n, tree, sig = _members(table)
        _, root = np.unique(np.array(table["root"].to_pylist(), dtype=object), return_inverse=True)
        whole, mask, side = np.asarray(table["whole"]), np.asarray(table["mask"]), np.asarray(table["side"])
        sketch = table["sketch"].to_pylist()
        starts = np.flatnonzero(np.concatenate([[True], grp[1:] != grp[:-1]]))
        out: list[tuple[int, int, bool | None]] = []
        for first, last in zip(starts, np.append(starts[1:], len(grp))):
            here, count = np.unique(root[first:last], return_inverse=True, return_counts=True)[1:]
            if len(count) < 2:
                continue
            weight = count[here] * (len(count) + 1) + here  # order of components: by members, ties by number
            joined = np.arange(len(count))  # components that links found here have made one
            lowest = [np.frombuffer(x, np.uint64) if x is not None else None for x in sketch[first:last]]
            for i in range(last - first):
                other = np.flatnonzero((weight > weight[i]) & (joined[here] != joined[here[i]])
                                       & ((side[first:last] != side[first + i]) | (side[first + i] == 0))
                                       & _near(n, first + i, np.arange(first, last), percent))
                if not len(other):
                    continue
                equal = sig[first + other] == sig[first + i]
                score = equal.mean(1)
                keep = score >= alike
                if whole[first]:  # in the first uncrowded region where both are?
                    bands = equal.reshape(-1, TREES, BAND).all(2)
                    bands &= (int(mask[first + i]) >> np.arange(TREES) & 1).astype(bool)
                    keep &= ~bands[:, :tree[first]].any(1)
                other, score = other[keep], score[keep]
                ranked = other[np.lexsort((other, -score))]
                made = np.zeros(len(count), np.int64)
                for j in ranked.tolist():
                    if joined[here[j]] == joined[here[i]] or few is not None and made[here[j]] >= few:
                        continue
                    made[here[j]] += 1
                    link = None
                    if lowest[i] is not None and lowest[j] is not None:
                        link = _judged(lowest[i], lowest[j], int(n[first + i]), int(n[first + j]), percent)
                    if link:
                        joined[joined == joined[here[j]]] = joined[here[i]]
                    if link is not False:
                        out.append((first + i, first + j, link))
        for start in range(0, len(out), 8_192):
            part = out[start:start + 8_192]
            pairs = _pairs(cls, np.array([p[0] for p in part]), np.array([p[1] for p in part]))
            yield batch_of(_JUDGED, [pairs.column(0), pairs.column(1), [p[2] for p in part]])


def _confirm(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs whose full shingle sets are similar enough."""
    for batch in batches:
        keep = []
        for x, y in zip(batch.column("set_a").to_pylist(), batch.column("set_b").to_pylist()):
            a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            both = len(np.intersect1d(a, b, assume_unique=True))
            keep.append(100 * both >= percent * (len(a) + len(b) - both))
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(keep, pa.bool_())],
                                         names=["a", "b", "link"])


def _forest(classes: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """``grp, tree, cls, whole``: the regions of at least two classes, crowded
    ones cut deeper.  ``whole`` marks groups that are a whole region.  Then
    ``grp, tree, cls`` of the crowded regions, uncut, if there are any."""
    regions = classes.select("cls", F.posexplode("keys").alias("tree", "grp"))
    sizes = regions.groupBy("grp").agg(F.count("*").alias("size")).filter("size > 1")
    live = written(regions.join(sizes, "grp"), "forest-live")
    groups = live.filter(F.col("size") <= REGION).select("grp", "tree", "cls", F.lit(True).alias("whole"))
    crowded = live.filter(F.col("size") > REGION).drop("size")
    if not crowded.limit(1).count():
        return groups, None
    uncut = crowded
    rolled = F.concat(F.expr(f"substring(sig, tree * {BAND} + 1, {HASHES})"), F.expr(f"substring(sig, 1, tree * {BAND})"))
    crowded = crowded.join(classes.select("cls", "sig"), "cls").withColumn("order", rolled).drop("sig")
    for depth in DEPTHS:
        deeper = written(crowded.withColumn("grp", F.xxhash64("tree", F.substring("order", 1, depth), F.lit(depth))),
                         "forest-deeper")
        sizes = deeper.groupBy("grp").agg(F.count("*").alias("size")).filter("size > 1")
        deeper = deeper.join(sizes, "grp")
        groups = groups.unionByName(deeper.filter(F.col("size") <= REGION)
                                    .select("grp", "tree", "cls", F.lit(False).alias("whole")))
        crowded = deeper.filter(F.col("size") > REGION)
        if not crowded.limit(1).count():
            return groups, uncut
        last, crowded = crowded, crowded.drop("size")
    block = F.pmod(F.xxhash64("cls", "tree"), F.ceil(F.col("size") / REGION))  # equal signatures: other blocks in each tree
    cut = last.select(F.xxhash64("grp", block).alias("grp"), "tree", "cls", F.lit(False).alias("whole"))
    return groups.unionByName(cut), uncut


def _block_pairs(rooted: DataFrame, roots: DataFrame) -> DataFrame:
    """Rows of crowded regions dealt to pairs of blocks, ``grp`` and ``side`` new:
    any two classes of different components of a region meet in exactly one pair.

    The largest component of a region, whose classes need not meet, has blocks of
    its own; these meet the blocks of the rest alone, so n near copies and a few
    other classes are about n rows.  ``roots``: ``grp, root`` of the same rows."""
    counts = roots.groupBy("grp", "root").agg(F.count("*").alias("here"))
    regions = counts.groupBy("grp").agg(F.sum("here").alias("members"), F.max(F.struct("here", "root")).alias("top"))
    regions = regions.filter("members > top.here").select(
        "grp", "members", F.col("top.root").alias("home"), F.ceil(F.col("top.here") / REGION).cast("int").alias("homes"),
        F.ceil((F.col("members") - F.col("top.here")) / REGION).cast("int").alias("rests"))
    own, at = F.col("root") == F.col("home"), F.col("at")

    def met(count: str, kind: str, pair, side) -> Column:
        return F.transform(F.sequence(F.lit(0), F.col(count) - 1), lambda b: F.struct(
            F.xxhash64("grp", F.lit(kind), *pair(b)).alias("grp"), side(b).cast("int").alias("side")))

    of_home = met("rests", "home", lambda b: (b, at), lambda b: F.lit(2))
    of_rest = F.concat(
        met("homes", "home", lambda b: (at, b), lambda b: F.lit(1)),
        met("rests", "rest", lambda b: (F.least(at, b), F.greatest(at, b)),
            lambda b: F.when(at == b, 0).when(at < b, 1).otherwise(2)))
    dealt = small_join(rooted, regions, "grp").withColumn(
        "at", F.pmod(F.xxhash64("cls", "tree"), F.when(own, F.col("homes")).otherwise(F.col("rests"))).cast("int"))
    dealt = dealt.withColumn("met", F.explode(F.when(own, of_home).otherwise(of_rest)))
    return dealt.withColumns({"grp": F.col("met.grp"), "side": F.col("met.side")}).drop("met", "at", "home", "homes", "rests")


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shingle_words: int = 5,
               percent: int = 80, alike: float = 0.66, reach: int = 2, few: int = 4) -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id, kept, text_key``.

    Words are runs of other characters than ASCII white space, ASCII letters
    lower-cased.  Two texts are linked when 100 times the intersection of their
    sets of ``shingle_words``-word shingles is at least ``percent`` times the
    union, confirmed on the full sets; ``component_id`` is the smallest
    identifier reachable over links, and the row that bears it is ``kept``;
    ``text_key`` is a 64-bit hash of the text, to find the row by.

    A null or empty text has an empty set and is linked with nothing.  Repeated
    rows are equal texts and share ``kept`` if they share the identifier.  A
    null identifier is never the smallest; texts that only rows with null
    identifiers have are not linked with other texts, and those rows are kept.
    An empty table gives an empty result; other columns are ignored.

    ``alike`` is the share of equal signature values from which a candidate is
    confirmed (0.66 is 3.8 standard deviations below a similarity of 0.8).
    """
    short_batches(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_key(text_col).alias("text_key"),
                        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = written(texts.mapInArrow(
        lambda b: _sign(b, shingle_words),
        "doc_id long, text_key long, n long, cls binary, keys array<long>, sig binary"), "near-rows")
    classes = written(rows.filter("n > 0").groupBy("cls").agg(
        F.min("doc_id").alias("min_id"), F.count("*").alias("copies"), F.first("n").alias("n"),
        F.first("keys").alias("keys"), F.first("sig").alias("sig")), "near-classes")
    named = classes.filter("min_id IS NOT NULL")
    groups, crowded = _forest(named)
    groups = written(groups, "near-groups")
    masks = groups.groupBy("cls").agg(F.bit_or(F.when(F.col("whole"), F.expr("shiftleft(1, tree)")).otherwise(0)).alias("mask"))
    live = written(named.join(masks, "cls").select("cls", "min_id", "n", "sig", "mask"), "near-live")
    sets = written(small_join(texts, live.select(F.col("min_id").alias("doc_id")), "doc_id", "left_semi", limit=1_000_000)
                   .select("text").distinct().mapInArrow(lambda b: _sets(b, shingle_words), "cls binary, shingles binary")
                   .dropDuplicates(["cls"]), "near-sets")

    def grouped(rows_: DataFrame) -> DataFrame:
        return rows_.repartition("grp").sortWithinPartitions("grp", "cls")

    def confirmed(pairs: DataFrame) -> DataFrame:
        one, two = (sets.select(F.col("cls").alias(k), F.col("shingles").alias(f"set_{k}")) for k in "ab")
        return pairs.join(one, "a").join(two, "b").select("a", "b", "set_a", "set_b").mapInArrow(
            lambda b: _confirm(b, percent), "a binary, b binary, link boolean")

    first = grouped(groups.join(live, "cls").select("grp", "tree", "cls", "n", "sig")).mapInArrow(
        lambda b: _neighbours(b, percent, alike, reach), "a binary, b binary")
    tested = written(confirmed(first.distinct()), "near-tested")
    links = tested.filter("link").select("a", "b")
    labels = components(links)
    lowest = sets.select("cls", F.substring("shingles", 1, 8 * SKETCH).alias("sketch"))

    def rooted(rows_: DataFrame) -> DataFrame:
        return rows_.join(labels.withColumnRenamed("node", "cls"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))

    def in_groups(rows_: DataFrame) -> DataFrame:
        named_rows = rooted(rows_.join(live, "cls"))
        mixed = named_rows.groupBy("grp").agg(F.min("root").alias("r0"), F.max("root").alias("r1"),
                                              F.count("*").alias("members")).filter("r0 <> r1")
        open_rows = named_rows.join(mixed.select("grp", "members"), "grp").select(
            "grp", "tree", "cls", "n", "sig", "root", "whole", "mask", F.lit(0).alias("side"), "members")
        return open_rows.filter(F.col("members") > FEW_CLASSES).join(lowest, "cls", "left").unionByName(
            open_rows.filter(F.col("members") <= FEW_CLASSES).withColumn("sketch", F.lit(None).cast("binary")))

    def in_blocks(rows_: DataFrame) -> DataFrame:
        named_rows = rooted(rows_.join(live, "cls")).join(lowest, "cls", "left").select(
            "grp", "tree", "cls", "n", "sig", "root", F.lit(False).alias("whole"), "mask", "sketch")
        return _block_pairs(named_rows, rooted(rows_).select("grp", "root"))

    rounds = [(few, groups, None), (None, groups, None)]
    if crowded is not None:
        rounds = [(few, groups, None), (few, None, crowded), (None, groups.filter("whole"), crowded)]
    for limit, uncrowded, uncut in rounds:
        parts = ([in_groups(uncrowded)] if uncrowded is not None else []) + ([in_blocks(uncut)] if uncut is not None else [])
        open_rows = functools.reduce(DataFrame.unionByName, parts)
        judged = written(grouped(open_rows).mapInArrow(lambda b, k=limit: _across(b, percent, alike, k),
                                                       "a binary, b binary, link boolean"), "near-judged")
        unsure = judged.filter("link IS NULL").select("a", "b").distinct().join(tested.select("a", "b"), ["a", "b"], "left_anti")
        found = written(confirmed(unsure).unionByName(judged.filter("link").distinct()), "near-tested")
        tested = tested.unionByName(found)
        fresh = found.filter("link").select("a", "b")
        if fresh.limit(1).count():
            links = links.unionByName(fresh)
            labels = components(links)
    lowest = labels.join(classes.select(F.col("cls").alias("node"), "min_id"), "node")
    lowest = lowest.join(lowest.groupBy("root").agg(F.min("min_id").alias("component_id")), "root").select(
        F.col("node").alias("cls"), "component_id")
    answers = written(classes.join(lowest, "cls", "left").select(
        "cls", "copies", F.coalesce("component_id", "min_id").alias("component_id")), "near-answers")
    out = answers_to_rows(rows.select("doc_id", "text_key", "n", "cls"), answers, "cls", "copies").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("doc_id"))
        .otherwise(F.col("component_id")).alias("component_id"), "text_key")
    return out.select("doc_id", "n_shingles", "component_id",
                      F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "text_key")


def one_of_each(docs: DataFrame, decided: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are, that ``near_dedup`` keeps;
    of rows with equal identifier and text, one."""
    gone = decided.filter(~F.col("kept")).select(F.col("doc_id").alias("__gone"), F.col("text_key").alias("__key")).distinct()
    left = anti_rows(docs, gone, id_col, text_col)
    repeated = decided.filter("kept").groupBy("doc_id", "text_key").count().filter("count > 1")
    return left.dropDuplicates([id_col, text_col]) if repeated.limit(1).count() else left
