"""Quality classifier: a byte-level convolutional network in numpy.

Bytes are embedded, learned filters of 16 bytes slide over them in steps of 8
(so that they overlap), and see besides the embedded bytes how many of the 16
equal the byte 1 to 24 places before (which shows repetition).  Windows are
grouped in chunks of 1,024 bytes that cover the whole document; a filter gives
its largest value anywhere and its largest mean over a chunk, and a logistic
unit combines these into one probability.

Training is on the driver, on the whole texts of a bounded sample of labelled
rows; scoring is one narrow pass that works on buffers of bounded size whatever a
text's length.  A score is a function of the text's bytes alone: filters are scored
in whole numbers whose sums are exact in any order, so neither the texts beside it
in a buffer nor the number of partitions change its last bit.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlab.llm.common import batch_of, held_out, short_batches, small_join, text_bytes, written

STEP = 8
LAGS = 24
BEFORE = 32  # bytes kept before a segment, for the lags
CHUNK = 128  # windows
SEGMENT = 1 << 18  # bytes; a multiple of STEP * CHUNK


@dataclass
class ByteCnn:
    embed: np.ndarray  # 256 x d
    first: np.ndarray  # STEP*d x filters: first half of a window
    second: np.ndarray  # STEP*d x filters
    repeat: np.ndarray  # LAGS x filters
    bias: np.ndarray  # filters
    out: np.ndarray  # 2*filters
    out_bias: float

    def params(self) -> list[np.ndarray]:
        return [self.embed, self.first, self.second, self.repeat, self.bias, self.out]


def laid_out(parts: list[tuple[bytes, bytes, bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Segments ``(bytes before, body, bytes after)`` in one buffer of zeros:
    the buffer, each segment's first window and its number of windows."""
    sizes = [max(1, -(-len(body) // STEP)) for _, body, _ in parts]
    buffer = np.zeros(sum(BEFORE + (n + 1) * STEP for n in sizes), np.uint8)
    first, at = [], 0
    for (before, body, after), n in zip(parts, sizes):
        start = at + BEFORE
        if before:
            buffer[start - len(before):start] = np.frombuffer(before, np.uint8)
        rest = (body + after)[:(n + 1) * STEP]
        buffer[start:start + len(rest)] = np.frombuffer(rest, np.uint8)
        first.append(start // STEP)
        at += BEFORE + (n + 1) * STEP
    return buffer, np.array(first), np.array(sizes)


def equal_bytes(buffer: np.ndarray) -> np.ndarray:
    """Per window and lag: how many of its bytes equal the byte so many places before."""
    out = np.empty((len(buffer) // STEP, LAGS), np.float32)
    some = buffer != 0
    same = np.zeros(len(buffer), np.uint8)
    for lag in range(1, LAGS + 1):
        same[:lag] = 0
        np.logical_and(buffer[lag:] == buffer[:-lag], some[lag:], out=same[lag:].view(bool))
        out[:, lag - 1] = same.reshape(-1, STEP).sum(1, dtype=np.uint8)
    out[:-1] += out[1:]
    return out


def planes(buffer: np.ndarray) -> np.ndarray:
    """As shares of a window's bytes."""
    return equal_bytes(buffer) * np.float32(1 / (2 * STEP))


def activations(net: ByteCnn, buffer: np.ndarray, repeated: np.ndarray) -> np.ndarray:
    """Rectified filter values of every window (the last window of the buffer has no second half)."""
    blocks = net.embed[buffer].reshape(-1, STEP * net.embed.shape[1])
    h = blocks @ net.first + repeated @ net.repeat + net.bias
    h[:-1] += blocks[1:] @ net.second
    return np.maximum(h, 0, out=h)


def pooled(h: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Per segment: largest value and largest chunk mean of each filter, in doubles."""
    rows = np.concatenate([np.arange(f, f + n) for f, n in zip(first, sizes)])
    h = h[rows]
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    chunk_starts = np.concatenate([s + np.arange(0, n, CHUNK) for s, n in zip(starts, sizes)])
    chunk_sizes = np.diff(np.append(chunk_starts, len(h)))
    means = np.add.reduceat(h, chunk_starts, axis=0, dtype=np.float64) / chunk_sizes[:, None]
    of = np.concatenate([[0], np.cumsum(-(-sizes // CHUNK))[:-1]])
    return np.concatenate([np.maximum.reduceat(h, starts, axis=0), np.maximum.reduceat(means, of, axis=0)], axis=1)


@dataclass
class Scorer:
    """A network in whole numbers.  A window's sum has 2 * STEP * d products of at
    most 255 * 255, LAGS * 16 of at most 15,000 and a bias of at most 2,000,000: for
    d = 8 less than 2**24, so float32 holds every partial sum exactly."""

    net: ByteCnn  # embed, first, second, repeat (per equal byte) and bias as whole numbers
    unit: float

    @classmethod
    def of(cls, net: ByteCnn) -> Scorer:
        top = lambda *arrays: max(float(np.abs(a).max()) for a in arrays)
        scale = top(net.embed) / 255 or 1.0
        unit = max(scale * top(net.first, net.second) / 255, top(net.repeat) / (2 * STEP) / 15_000,
                   top(net.bias) / 2_000_000) or 1.0
        whole = lambda a, by: np.rint(a.astype(np.float64) / by).astype(np.float32)
        return cls(ByteCnn(whole(net.embed, scale), whole(net.first, unit / scale), whole(net.second, unit / scale),
                           whole(net.repeat, unit * 2 * STEP), whole(net.bias, unit), net.out.astype(np.float64),
                           float(net.out_bias)), unit)

    def features(self, parts: list[tuple[bytes, bytes, bytes]]) -> np.ndarray:
        """Per segment, in units."""
        buffer, first, sizes = laid_out(parts)
        return pooled(activations(self.net, buffer, equal_bytes(buffer)), first, sizes)

    def score(self, features: np.ndarray) -> float:
        logit = math.fsum((features * self.unit * self.net.out).tolist()) + self.net.out_bias
        return 1.0 / (1.0 + math.exp(-min(30.0, max(-30.0, logit))))


def probability(net: ByteCnn, features: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(features @ net.out + net.out_bias, -30, 30)))


def cut(text: bytes) -> list[tuple[bytes, bytes, bytes]]:
    """A text as segments that together cover it; an empty text is one empty segment."""
    return [(text[max(0, s - BEFORE):s], text[s:s + SEGMENT], text[s + SEGMENT:s + SEGMENT + STEP])
            for s in range(0, max(1, len(text)), SEGMENT)]


def chunks_of(text: bytes) -> list[tuple[bytes, bytes, bytes]]:
    """All chunks of a text with the bytes around them, as scoring sees them."""
    size = STEP * CHUNK
    return [(text[max(0, s - BEFORE):s], text[s:s + size], text[s + size:s + size + STEP])
            for s in range(0, max(1, len(text)), size)]


def winners(net: ByteCnn, parts: list, at_once: int = SEGMENT // (STEP * CHUNK)) -> list:
    """The chunks of one text that give some filter its largest value or mean: the
    only ones that a maximum's gradient reaches.  A text of any length is looked
    at in stretches of bounded size."""
    if len(parts) <= at_once // 16:
        return parts
    best, which = None, None
    for start in range(0, len(parts), at_once):
        buffer, first, sizes = laid_out(parts[start:start + at_once])
        found = pooled(activations(net, buffer, planes(buffer)), first, sizes)
        top, place = found.max(0), found.argmax(0) + start
        which = place if best is None else np.where(top > best, place, which)
        best = top if best is None else np.maximum(best, top)
    return [parts[k] for k in np.unique(which).tolist()]


def train_cnn(samples: list[tuple[list, int]], *, filters: int = 32, dims: int = 8, epochs: int = 10,
              batch: int = 64, rate: float = 3e-3, share: float | None = None, seed: int = 7) -> ByteCnn:
    """Fit on documents given as chunks (bytes, or with the bytes before and
    after); classes are weighed so that label 1 has the given ``share`` (default:
    its share of the samples)."""
    samples = [([(b"", c, b"") if isinstance(c, bytes) else c for c in chunks], label) for chunks, label in samples]
    rng = np.random.default_rng(seed)
    draw = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
    width = STEP * dims
    net = ByteCnn(draw(256, dims, scale=0.5), draw(width, filters, scale=0.1), draw(width, filters, scale=0.1),
                  draw(LAGS, filters, scale=0.3), np.zeros(filters, np.float32), draw(2 * filters, scale=0.1), 0.0)
    labels = np.array([y for _, y in samples])
    ones = labels.mean() if len(labels) else 0.5
    if not 0 < ones < 1:  # one class only: nothing to separate
        net.out[:] = 0
        net.out_bias = 5.0 if ones else -5.0
        return net
    share = ones if share is None else share
    weight = np.where(labels == 1, share / ones, (1 - share) / (1 - ones))
    m = [np.zeros_like(p) for p in net.params()] + [0.0]
    v = [np.zeros_like(p) for p in net.params()] + [0.0]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(samples))
        for start in range(0, len(order), batch):
            picked = order[start:start + batch]
            parts, owner = [], []
            for k, i in enumerate(picked):
                chosen = winners(net, samples[i][0])
                parts += chosen
                owner += [k] * len(chosen)
            grads = _gradients(net, parts, np.array(owner), labels[picked], weight[picked])
            step += 1
            for k, (p, g) in enumerate(zip([*net.params(), net.out_bias], grads)):
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                change = rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
                if k < 6:
                    p -= change
                else:
                    net.out_bias -= float(change)
    return net


def _gradients(net: ByteCnn, parts, owner: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> list:
    buffer, first, sizes = laid_out(parts)
    repeated = planes(buffer)
    h = activations(net, buffer, repeated)
    filters, docs = h.shape[1], len(labels)
    by_part = pooled(h, first, sizes)  # a training chunk is one chunk, so its mean is one mean
    by_part = by_part.astype(np.float32)
    features = np.full((docs, 2 * filters), -1.0, np.float32)
    best = np.zeros((docs, 2 * filters), np.int64)
    for part, doc in enumerate(owner):
        better = by_part[part] > features[doc]
        features[doc][better] = by_part[part][better]
        best[doc][better] = part
    prob = probability(net, features)
    g_logit = ((prob - labels) * weight / docs).astype(np.float32)
    g_features = g_logit[:, None] * net.out
    g_h = np.zeros_like(h)
    column = np.arange(filters)
    for doc in range(docs):
        for k in range(filters):
            part = best[doc, k]
            s, n = first[part], sizes[part]
            g_h[s + int(h[s:s + n, k].argmax()), k] += g_features[doc, k]
        for part in np.unique(best[doc, filters:]):
            own = column[best[doc, filters:] == part]
            g_h[first[part]:first[part] + sizes[part], own] += g_features[doc, filters + own] / sizes[part]
    g_h *= h > 0
    blocks = net.embed[buffer].reshape(-1, STEP * net.embed.shape[1])
    g_blocks = g_h @ net.first.T
    g_blocks[1:] += g_h[:-1] @ net.second.T
    g_bytes = g_blocks.reshape(-1, net.embed.shape[1])
    g_embed = np.stack([np.bincount(buffer, weights=g_bytes[:, d], minlength=256) for d in range(net.embed.shape[1])], 1)
    return [g_embed.astype(np.float32), blocks.T @ g_h, blocks[1:].T @ g_h[:-1], repeated.T @ g_h, g_h.sum(0),
            features.T @ g_logit, float(g_logit.sum())]


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                label_col: str = "quality", *, modulus: int = 3, remainder: int = 1, per_label: int = 1_200,
                sample_bytes: int = 64 << 20) -> ByteCnn:
    """Fit on the whole texts of a bounded sample of labelled rows that are not
    held out: about ``per_label`` of each label in the order of a hash, fewer if
    the next text would bring a label's texts above half of ``sample_bytes`` (its
    first text is always taken).  The labels' true shares weigh the sample.
    Without labelled rows every text scores 1/2."""
    short_batches(docs.sparkSession)
    open_row = ~held_out(id_col, modulus, remainder) & F.col(id_col).isNotNull()
    marked = (labels.filter(open_row & F.col(label_col).isin(0, 1)).groupBy(F.col(id_col).cast("long").alias("doc_id"))
              .agg(F.max(label_col).cast("int").alias("label")))
    counts = {r["label"]: r["count"] for r in marked.groupBy("label").count().collect()}  # two rows
    unit = F.pmod(F.xxhash64("doc_id", F.lit("cnn")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    bound = F.when(F.col("label") == 1, per_label / max(1, counts.get(1, 0))).otherwise(per_label / max(1, counts.get(0, 0)))
    picked = marked.withColumn("unit", unit).filter(F.col("unit") < bound)
    rows = docs.filter(open_row).select(F.col(id_col).cast("long").alias("doc_id"),
                                        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    sample = written(small_join(rows, picked, "doc_id"), "quality-sample")
    sizes = sample.select("label", "unit", F.octet_length("text").alias("size")).collect()  # about 2 * per_label narrow rows
    if not sizes:
        net = train_cnn([])
        net.out[:], net.out_bias = 0, 0.0
        return net
    ends = {}
    for label in (0, 1):
        held = 0
        for r in sorted((r for r in sizes if r["label"] == label), key=lambda r: (r["unit"], r["size"])):
            if held and held + r["size"] > sample_bytes // 2:
                break
            held += r["size"]
            ends[label] = r["unit"]
    taken = F.col("unit") <= F.when(F.col("label") == 1, ends.get(1, -1.0)).otherwise(ends.get(0, -1.0))
    texts = sample.filter(taken).select("doc_id", "label", F.col("text").cast("binary").alias("text")).collect()
    texts = sorted((r["doc_id"], r["label"], bytes(r["text"])) for r in texts)
    share = counts.get(1, 0) / sum(counts.values())
    return train_cnn([(chunks_of(text), label) for _, label, text in texts], share=min(0.99, max(0.01, share)))


_SCORED = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())])


def score_quality(docs: DataFrame, net: ByteCnn, id_col: str = "doc_id", text_col: str = "text", *, modulus: int = 3,
                  remainder: int = 1, threshold: float = 0.5) -> DataFrame:
    """One row per input row: ``doc_id, held_out, score, predicted``.

    The score is the probability of label 1 and looks at all bytes of the text
    alone: equal texts score equal to the last bit, however the rows are dealt.  A
    null text scores as the empty one; very long texts are read in segments of
    256 KB that are pooled together.  A score equal to the threshold is predicted
    1.  Null identifiers and repeated rows pass through; other columns are ignored;
    an empty table gives an empty result."""
    short_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(Scorer.of(net))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = shared.value

        def flush(held: list, owner: list[int], best: dict[int, np.ndarray]) -> None:
            for doc, values in zip(owner, scorer.features(held)):
                best[doc] = np.maximum(best[doc], values) if doc in best else values

        for batch in batches:
            best: dict[int, np.ndarray] = {}
            held: list = []
            owner: list[int] = []
            size = 0
            for doc, text in enumerate(text_bytes(batch.column(2))):
                for part in cut(text):
                    held.append(part)
                    owner.append(doc)
                    size += len(part[1]) + BEFORE + 2 * STEP
                    if size >= SEGMENT:
                        flush(held, owner, best)
                        held, owner, size = [], [], 0
            if held:
                flush(held, owner, best)
            if not batch.num_rows:
                continue
            values = np.array([scorer.score(best[k]) for k in range(batch.num_rows)])
            yield batch_of(_SCORED, [batch.column(0), batch.column(1), values, (values >= threshold).astype(np.int32)])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col, modulus, remainder).alias("held_out"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(score, "doc_id long, held_out boolean, score double, predicted int")
