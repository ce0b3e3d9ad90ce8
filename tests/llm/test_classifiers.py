import hashlib
import math
import random
import re

import numpy as np
import pytest

from barlab.llm import quality as q
from barlab.llm.language import fit_languages, predict_language, with_known_language
from barlab.llm.quality import fit_quality, score_quality
from barlab.llm.toxicity import fit_toxicity, nn_pu_train, score_toxicity
from tests.llm.conftest import LONG, edge_rows

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


def held_out_of(scored, labels, column):
    got = scored.join(labels, "doc_id").filter("held_out").select("score", "predicted", column).toPandas()
    return got["score"].to_numpy(), got["predicted"].to_numpy(), got[column].to_numpy()


def auc(score, label):
    pos, neg = score[label == 1], score[label == 0]
    return ((pos[:, None] > neg).mean() + 0.5 * (pos[:, None] == neg).mean())


def test_language_held_out(docs):
    got = predict_language(docs, fit_languages(docs)).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out")
    right = got.filter("lang_pred = lang").count()
    assert right >= 0.98 * got.count() > 0


def test_language_edges(spark, docs, edge, empty):
    model = fit_languages(docs)
    got = {r["doc_id"]: r for r in predict_language(edge, model).collect()}
    assert got[4]["lang_pred"] == got[5]["lang_pred"] == got[6]["lang_pred"] == got[11]["lang_pred"] == "und"
    assert got[4]["score"] == 0.0 and all(0 <= r["score"] <= 1 for r in got.values())
    assert got[1]["lang_pred"] == "en" and got[12]["lang_pred"] == "de"
    kept = with_known_language(edge, model)
    assert kept.columns == edge.columns and kept.count() == len(edge_rows()) - 5
    assert predict_language(empty, model).collect() == []
    nothing = fit_languages(empty)
    assert {r["lang_pred"] for r in predict_language(edge, nothing).collect()} == {"und"}


def test_language_learns_from_open_rows_only(spark, docs):
    from pyspark.sql import functions as F

    from barlab.llm.common import held_out
    spoiled = docs.withColumn("lang", F.when(held_out("doc_id", 4, 2), "xx").otherwise(F.col("lang")))
    assert fit_languages(spoiled).languages == fit_languages(docs).languages


def test_toxicity_held_out(docs, labels):
    score, predicted, label = held_out_of(score_toxicity(docs, fit_toxicity(docs, labels)), labels, "toxic")
    assert auc(score, label) > 0.75 and (predicted == label).mean() > 0.9


def test_toxicity_edges(docs, labels, edge, empty):
    model = fit_toxicity(docs, labels)
    got = score_toxicity(edge, model).collect()
    assert len(got) == len(edge_rows()) and all(0 <= r["score"] <= 1 for r in got)
    assert all(r["predicted"] == int(r["score"] >= 0.3) for r in got)
    assert score_toxicity(empty, model).collect() == []
    none = fit_toxicity(docs, labels.limit(0))
    assert {r["predicted"] for r in score_toxicity(edge, none).collect()} == {0}
    assert fit_toxicity(empty, labels).weights == {}


def test_non_negative_risk_separates_unlabelled():
    """Half of the unlabelled positives are never labelled, yet score high."""
    rng = np.random.default_rng(1)
    n, prior = 2_000, 0.2
    toxic = rng.random(n) < prior
    p = (toxic & (rng.random(n) < 0.5)).astype(float)
    doc_of, feature_of = [], []
    for k in range(n):
        words = {int(rng.integers(0, 20))} | ({int(rng.integers(20, 24))} if toxic[k] else set())
        doc_of += [k] * len(words)
        feature_of += sorted(words)
    w, b = nn_pu_train(np.array(doc_of), np.array(feature_of), p, np.ones(n), 24, prior)
    logit = np.bincount(doc_of, weights=w[feature_of], minlength=n) + b
    hidden = toxic & (p == 0)
    assert (logit[hidden] > 0).mean() > 0.95 and (logit[~toxic] > 0).mean() < 0.05


def test_quality_held_out(docs, labels):
    score, predicted, label = held_out_of(score_quality(docs, fit_quality(docs, labels)), labels, "quality")
    assert auc(score, label) > 0.95 and (predicted == label).mean() > 0.93


def test_quality_edges(docs, labels, edge, empty):
    net = fit_quality(docs, labels)
    got = score_quality(edge, net).collect()
    assert len(got) == len(edge_rows()) and all(0 <= r["score"] <= 1 for r in got)
    by_id = {r["doc_id"]: r["score"] for r in got}
    assert by_id[4] == by_id[5]  # null and empty
    assert score_quality(empty, net).collect() == []
    none = fit_quality(docs, labels.limit(0))
    assert {r["score"] for r in score_quality(edge, none).collect()} == {0.5}


def test_segments_cover_whole_texts(monkeypatch):
    """A text cut into small segments gives what it gives in one piece."""
    rng = random.Random(3)
    net = q.train_cnn([([bytes(rng.randrange(32, 120) for _ in range(900))], k % 2) for k in range(40)], epochs=1)
    text = LONG.encode()[:50_000]

    def pooled(parts):
        buffer, first, sizes = q.laid_out(parts)
        return q.pooled(q.activations(net, buffer, q.planes(buffer)), first, sizes).max(0)

    whole = pooled(q.cut(text))
    monkeypatch.setattr(q, "SEGMENT", q.STEP * q.CHUNK * 3)
    assert len(q.cut(text)) > 10
    np.testing.assert_allclose(pooled(q.cut(text)), whole, rtol=1e-4, atol=1e-5)


def test_gradients_match_differences():
    rng = np.random.default_rng(2)
    samples = [([bytes(rng.integers(60, 70, 100).tolist()), bytes(rng.integers(60, 70, 64).tolist())], k % 2) for k in range(6)]
    net = q.train_cnn(samples, epochs=1, filters=4, dims=3)
    for p in net.params():
        p[...] = p.astype(np.float32)
    parts, owner = [], []
    for k, (chunks, _) in enumerate(samples):
        parts += [(b"", c, b"") for c in chunks]
        owner += [k] * len(chunks)
    labels, weight = np.array([y for _, y in samples]), np.ones(6)

    def loss():
        buffer, first, sizes = q.laid_out(parts)
        by_part = q.pooled(q.activations(net, buffer, q.planes(buffer)), first, sizes)
        features = np.stack([by_part[np.array(owner) == k].max(0) for k in range(6)])
        prob = q.probability(net, features.astype(np.float64))
        return -np.mean(np.where(labels == 1, np.log(prob), np.log(1 - prob)))

    grads = q._gradients(net, parts, np.array(owner), labels, weight)
    for p, g in list(zip(net.params(), grads))[1:]:
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        before, step = p[at], 1e-2
        p[at] = before + step
        up = loss()
        p[at] = before - step
        down = loss()
        p[at] = before
        assert abs((up - down) / (2 * step) - g[at]) < 0.1 * abs(g[at]) + 1e-3


def test_quality_is_a_function_of_the_text_alone(spark, docs, labels):
    """Equal to the last bit at 1, 4 and 16 partitions and for copies."""
    net = fit_quality(docs, labels)
    both = docs.unionByName(docs.withColumn("doc_id", docs["doc_id"] + 1_000_000))
    got = [{r["doc_id"]: r["score"] for r in score_quality(both.repartition(n), net).collect()} for n in (1, 4, 16)]
    assert got[0] == got[1] == got[2]
    assert all(got[0][k] == got[0][k + 1_000_000] for k in got[0] if k < 1_000_000)


def plain_score(net, text):
    """The network window by window in whole numbers, no batches."""
    s = q.Scorer.of(net)
    whole = lambda a: a.astype(np.int64)
    n = max(1, -(-len(text) // q.STEP))
    padded = np.frombuffer(bytes(q.BEFORE) + text + bytes((n + 1) * q.STEP - len(text)), np.uint8).astype(np.int64)
    values = []
    for w in range(n):
        at = q.BEFORE + w * q.STEP
        window = padded[at:at + 2 * q.STEP]
        embedded = whole(s.net.embed)[window]
        equal = [int(((window == padded[at - lag:at + 2 * q.STEP - lag]) & (window != 0)).sum()) for lag in range(1, q.LAGS + 1)]
        h = (embedded[:q.STEP].reshape(-1) @ whole(s.net.first) + embedded[q.STEP:].reshape(-1) @ whole(s.net.second)
             + np.array(equal) @ whole(s.net.repeat) + whole(s.net.bias))
        values.append(np.maximum(h, 0))
    values = np.array(values)
    means = np.array([values[a:a + q.CHUNK].sum(0) / len(values[a:a + q.CHUNK]) for a in range(0, n, q.CHUNK)])
    return s.score(np.concatenate([values.max(0), means.max(0)]))


def test_quality_equals_a_plain_scorer(spark, docs, labels):
    net = fit_quality(docs, labels)
    texts = [r["text"] for r in docs.limit(40).collect()] + ["", "x", "é" * 5_000, LONG[:300_000]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in score_quality(df, net).collect()}
    assert all(got[k] == plain_score(net, t.encode()) for k, t in enumerate(texts))


def test_training_looks_at_whole_texts():
    """What decides is in the middle of texts of many chunks."""
    rng = random.Random(11)
    plain = lambda n: bytes(rng.choice(b"abcdefgh ") for _ in range(n))
    texts = [(plain(30_000) + (b"0123456789" * 30 if k % 2 else b"") + plain(30_000), k % 2) for k in range(60)]
    net = q.train_cnn([(q.chunks_of(t), y) for t, y in texts], epochs=6)
    scores = [q.Scorer.of(net).score(q.Scorer.of(net).features(q.cut(t)).max(0)) for t, _ in texts]
    assert all((s >= 0.5) == bool(y) for s, (_, y) in zip(scores, texts))


def plain_language(model, text):
    """Language and score of a text word by word, n-gram by n-gram, from the model's tables."""
    evidence = []
    for word in re.findall(r"[^\W\d_]+", (text or "").lower()):
        if not any(c.isalpha() for c in word):
            continue
        if word in model.words:
            evidence.append([float(x) for x in model.word_rows[model.words[word]]])
            continue
        padded, found = f"<{word}>", []
        for start in range(len(padded)):
            known = [padded[start:start + size] for size in range(model.max_gram, 0, -1) if padded[start:start + size] in model.grams]
            found += known[:1]
        rows = [model.gram_rows[model.grams[g]] for g in found]
        evidence.append([sum(float(r[k]) for r in rows) / len(rows) if rows else 0.0 for k in range(len(model.languages))])
    if not evidence or not model.languages:
        return "und", 0.0
    mean = [sum(e[k] for e in evidence) / len(evidence) * min(len(evidence), 10) for k in range(len(model.languages))]
    best = max(range(len(mean)), key=lambda k: (mean[k], -k))
    return model.languages[best], 1.0 / sum(math.exp(m - mean[best]) for m in mean)


def test_language_equals_a_plain_scorer(spark, docs, edge):
    model = fit_languages(docs)
    texts = [r["text"] for r in docs.limit(150).collect()] + [r[1] for r in edge_rows()] + ["zzz " * 30_000, "x" * 500, "größe 12 ŁÓDŹ"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in predict_language(df, model).collect()}
    for k, text in enumerate(texts):
        name, score = plain_language(model, text)
        assert got[k][0] == name and abs(got[k][1] - score) < 1e-4, k


def plain_toxicity(model, text):
    found = set()
    for word in set(re.findall(r"[^\W\d_]+", (text or "").lower())):
        for key in {"=" + word} | {word[:n] for n in (4, 5, 6) if len(word) >= n}:
            found.add(int.from_bytes(hashlib.blake2b(key.encode(), digest_size=8).digest(), "little", signed=True))
    logit = model.bias + math.fsum(model.weights.get(h, 0.0) for h in found)
    return 1.0 / (1.0 + math.exp(-min(30.0, max(-30.0, logit))))


def test_toxicity_equals_a_plain_scorer(spark, docs, labels):
    model = fit_toxicity(docs, labels)
    texts = [r["text"] for r in docs.limit(300).collect()] + [r[1] for r in edge_rows()]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    for r in score_toxicity(df, model).collect():
        want = plain_toxicity(model, texts[r["doc_id"]])
        assert abs(r["score"] - want) < 1e-12 and r["predicted"] == int(r["score"] >= 0.3)


def test_training_risk_is_the_non_negative_estimator():
    """The trained weights lower the risk written out document by document."""
    rng = np.random.default_rng(5)
    n, features, prior = 300, 12, 0.25
    toxic = rng.random(n) < prior
    p = (toxic & (rng.random(n) < 0.6)).astype(float)
    has = rng.random((n, features)) < np.where(toxic[:, None], 0.4, 0.1)

    def risk(w, b):
        on_p, on_u_negative, on_p_negative = [], [], []
        for k in range(n):
            z = sum(w[f] for f in range(features) if has[k, f]) + b
            loss_pos, loss_neg = 1 / (1 + math.exp(z)), 1 / (1 + math.exp(-z))
            on_u_negative.append(loss_neg)
            if p[k]:
                on_p.append(loss_pos)
                on_p_negative.append(loss_neg)
        mean = lambda x: sum(x) / len(x)
        return prior * mean(on_p) + max(0.0, mean(on_u_negative) - prior * mean(on_p_negative))

    doc_of, feature_of = np.nonzero(has)
    w, b = nn_pu_train(doc_of, feature_of, p, np.ones(n), features, prior)
    assert risk(w, b) < risk(np.full(features, 1.5), -2.0) and risk(w, b) < min(risk(np.zeros(features), -9.0), risk(np.zeros(features), 9.0))
