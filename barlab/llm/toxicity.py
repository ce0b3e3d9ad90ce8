"""Toxicity by non-negative positive-unlabelled learning.

Known toxic rows are the positives; all other text is unlabelled, a mix of which
a share ``prior`` is toxic.  A linear scorer on hashed word features is trained
with the non-negative risk estimator: with losses l+(z) = s(-z) and l-(z) = s(z),

    risk = prior * E_P[l+] + max(0, E_U[l-] - prior * E_P[l-])

so that unlabelled text counts as negative only beyond what its toxic share
explains: where the bracket would be negative it is 0, and only the positive
part is followed, which is what keeps a flexible scorer from over-fitting.  The
losses are sigmoid losses: as they are bounded, a few far-out positives cannot
make the bracket negative on their own.

Features of a text are its distinct words and their beginnings (4 to 6 letters),
hashed.  Spark counts in how many positive and unlabelled texts each occurs, and
only features that are clearly more frequent among positives are kept, at most
``features`` of them: a bounded model for a broadcast.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlab.llm.common import batch_of, held_out, short_batches, small_join, written

_WORD = re.compile(r"[^\W\d_]+")


class WordFeatures(dict):
    """word -> hashes of the word and of its beginnings; bounded cache."""

    def __missing__(self, word: str) -> tuple[int, ...]:
        keys = {"=" + word, *(word[:n] for n in (4, 5, 6) if len(word) >= n)}
        hashes = tuple(sorted(int.from_bytes(hashlib.blake2b(k.encode(), digest_size=8).digest(), "little", signed=True)
                              for k in keys))
        if len(self) > 200_000:
            self.clear()
        if len(word) <= 64:
            self[word] = hashes
        return hashes


@dataclass
class PuModel:
    """``weights`` by feature hash; a text's logit is ``bias`` plus the weights of
    its distinct features."""

    weights: dict[int, float]
    bias: float
    prior: float

    def score(self, hashes) -> float:
        logit = self.bias + sum(map(self.weights.get, hashes, (0.0,) * len(hashes)))
        return float(1.0 / (1.0 + np.exp(-np.clip(logit, -30.0, 30.0))))


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc, p, u, feature: one row per distinct feature of each text."""
    cache = WordFeatures()
    for batch in batches:
        for start in range(0, batch.num_rows, 16):
            part = batch.slice(start, 16)
            docs, in_p, in_u, found = [], [], [], []
            for doc, p, u, text in zip(*(part.column(k).to_pylist() for k in range(4))):
                keys = sorted(set().union(*map(cache.__getitem__, set(_WORD.findall(text.lower())))))
                docs += [doc] * len(keys)
                in_p += [p] * len(keys)
                in_u += [u] * len(keys)
                found += keys
            yield pa.RecordBatch.from_arrays(
                [pa.array(docs, pa.int64()), pa.array(in_p, pa.int32()), pa.array(in_u, pa.int32()),
                 pa.array(found, pa.int64())], names=["doc", "p", "u", "feature"])


def nn_pu_train(doc_of: np.ndarray, feature_of: np.ndarray, p: np.ndarray, u: np.ndarray, n_features: int,
                prior: float, *, steps: int = 400, rate: float = 0.1, penalty: float = 1e-6) -> tuple[np.ndarray, float]:
    """Weights and bias by Adam on the non-negative risk.

    ``(doc_of[i], feature_of[i])`` are the ones of a sparse 0/1 matrix with a
    row per document; ``p`` marks the known positives and ``u`` the unlabelled
    sample (a document may be in both)."""
    n = len(p)
    share_p, share_u = p / max(1, p.sum()), u / max(1, u.sum())
    m, v = np.zeros(n_features + 1), np.zeros(n_features + 1)
    w = np.append(np.full(n_features, 1.5), -2.0)  # every feature was kept for being frequent among positives
    for step in range(1, steps + 1):
        logit = np.bincount(doc_of, weights=w[feature_of], minlength=n) + w[-1]
        prob = 1.0 / (1.0 + np.exp(-np.clip(logit, -30, 30)))
        slope = prob * (1.0 - prob)
        negative = prob @ share_u - prior * (prob @ share_p)
        g_negative = slope * (share_u - prior * share_p)
        g = (g_negative if negative >= 0 else 0.0) - prior * slope * share_p
        grad = np.concatenate([np.bincount(feature_of, weights=g[doc_of], minlength=n_features), [g.sum()]])
        grad[:-1] += penalty * w[:-1]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        w -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        w[:-1] = np.maximum(w[:-1], 0.0)  # a feature may count for a text being toxic, never against it
    return w[:-1], float(w[-1])


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 label_col: str = "toxic", *, modulus: int = 4, remainder: int = 2, positives: int = 4_000,
                 unlabelled: int = 12_000, features: int = 8_000, min_docs: int = 3, min_lift: float = 5.0,
                 min_z: float = 5.0, prior: float | None = None) -> PuModel:
    """Fit on a bounded sample of rows that are not held out: about
    ``positives`` toxic and ``unlabelled`` other texts, chosen by hash.

    ``prior`` is the toxic share of the unlabelled text; by default the share
    among the labelled rows that are not held out.  A feature is kept if it is in
    ``min_docs`` sampled positives, ``min_lift`` times as frequent there as in the
    unlabelled sample and ``min_z`` standard deviations above what that gives.  Without positives every text scores the prior."""
    short_batches(docs.sparkSession)
    open_rows = docs.filter(~held_out(id_col, modulus, remainder) & F.col(id_col).isNotNull())
    rows = open_rows.select(F.col(id_col).cast("long").alias("doc_id"),
                            F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    marked = labels.filter(~held_out(id_col, modulus, remainder) & F.col(id_col).isNotNull())
    marked = marked.groupBy(F.col(id_col).cast("long").alias("doc_id")).agg(F.max(label_col).alias("label"))
    known, toxic = marked.agg(F.count("label"), F.sum("label")).first()
    if not toxic:
        return PuModel({}, -30.0 if prior is None else float(np.log(prior / (1 - prior))), prior or 0.0)
    prior = min(0.9, toxic / known) if prior is None else prior

    def chosen(column: str, count: int, bound: int):
        return F.pmod(F.xxhash64(column, F.lit("pu")), F.lit(1 << 30)) < int((1 << 30) * min(1.0, bound / max(1, count)))

    found = marked.filter((F.col("label") == 1) & chosen("doc_id", toxic, positives)).select("doc_id", F.lit(1).alias("p"))
    total = rows.count()
    sample = small_join(rows, found, "doc_id", "left").select(
        "doc_id", F.coalesce("p", F.lit(0)).alias("p"), chosen("doc_id", total, unlabelled).cast("int").alias("u"), "text")
    ones = written(sample.filter((F.col("p") == 1) | (F.col("u") == 1))
                   .mapInArrow(_feature_rows, "doc long, p int, u int, feature long"), "pu-features")
    docs_seen = ones.groupBy("doc").agg(F.max("p").alias("p"), F.max("u").alias("u"))
    n_p, n_u = docs_seen.agg(F.sum("p"), F.sum("u")).first()
    if not n_p or not n_u:
        return PuModel({}, float(np.log(prior / (1 - prior))), prior)
    by_feature = ones.groupBy("feature").agg(F.sum("p").alias("in_p"), F.sum("u").alias("in_u"))
    usual = (F.col("in_u") + 1) / F.lit(float(n_u + 2))
    beyond = (F.col("in_p") - n_p * usual) / F.sqrt(n_p * usual * (1 - usual))
    kept = (by_feature.filter((F.col("in_p") >= min_docs) & (F.col("in_p") >= min_lift * n_p * usual) & (beyond >= min_z))
            .orderBy(F.col("in_p").desc(), F.col("in_u"), "feature").limit(features).select("feature"))
    names = np.array(sorted(r["feature"] for r in kept.collect()), np.int64)  # at most `features`
    kept = docs.sparkSession.createDataFrame([(int(f),) for f in names], "feature long")
    used = ones.join(F.broadcast(kept), "feature").select("doc", "feature").toPandas()  # a few per sampled text
    seen = docs_seen.toPandas().sort_values("doc")
    place = {doc: k for k, doc in enumerate(seen["doc"])}
    doc_of = np.fromiter((place[d] for d in used["doc"]), np.int64, len(used))
    feature_of = np.searchsorted(names, used["feature"].to_numpy())
    weights, bias = nn_pu_train(doc_of, feature_of, seen["p"].to_numpy(float), seen["u"].to_numpy(float), len(names), prior)
    return PuModel(dict(zip(names.tolist(), weights.tolist())), bias, prior)


_SCORED = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())])


def score_toxicity(docs: DataFrame, model: PuModel, id_col: str = "doc_id", text_col: str = "text", *, modulus: int = 4,
                   remainder: int = 2, threshold: float = 0.3) -> DataFrame:
    """One row per input row: ``doc_id, held_out, score, predicted``.

    The score looks at the whole text alone.  A null or empty text scores as one
    without features.  Null identifiers and repeated rows pass through; other
    columns are ignored; an empty table gives an empty result."""
    short_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, features = shared.value, WordFeatures()
        kept = model.weights.keys()
        hits: dict[str, tuple[int, ...]] = {}

        def of(word: str) -> tuple[int, ...]:
            got = hits.get(word)
            if got is None:
                got = tuple(h for h in features[word] if h in kept)
                if len(hits) > 300_000:
                    hits.clear()
                if len(word) <= 64:
                    hits[word] = got
            return got

        for batch in batches:
            scores = []
            for start in range(0, batch.num_rows, 64):
                for text in batch.column(2).slice(start, 64).to_pylist():
                    found: set[int] = set()
                    for got in map(of, set(_WORD.findall(text.lower()))):
                        if got:
                            found.update(got)
                    scores.append(model.score(sorted(found)))
            values = np.array(scores)
            yield batch_of(_SCORED, [batch.column(0), batch.column(1), values, (values >= threshold).astype(np.int32)])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col, modulus, remainder).alias("held_out"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(score, "doc_id long, held_out boolean, score double, predicted int")
