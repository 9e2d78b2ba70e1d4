"""Toxicity by a classifier chain over hashed words and word beginnings.

Categories are predicted one after the other by linear models; each later model also gets the
probabilities of the earlier ones. In fitting, those are out-of-fold predictions, so a later model
sees earlier probabilities as good as they will be on new documents.

Fitting uses at most about ``MAX_LABELLED`` labelled documents, those with the smallest hashes of
their ids; everything else covers all rows. Judging is narrow: one pass over the texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelspark import scratch
from reelspark.llm.sampling import about
from reelspark.llm.words import batches, hashes, joined, per_text, pieces, spans

#: Labelled documents used for fitting, at most (in expectation; chosen by hash).
MAX_LABELLED = 10_000
#: Features per category, their least number of documents, and the least significance (root of likelihood ratio).
MAX_FEATURES, MIN_DOCS, MIN_Z = 1024, 4, 4.0
FOLDS, BINS = 5, 16
#: Share of right ones among what a threshold takes, at least: clean documents are to stay.
MIN_PRECISION = 0.8
#: Bytes whose features are made at once; a longer text goes in pieces.
CHUNK_BYTES = 1 << 21
#: Features are hashes with this seed, always the same: a fitted chain names its features by them.
SEED = 1
#: Beginnings of longer words that count as features of their own, in bytes.
BEGINNINGS = (4, 5)

_U = np.uint64
_IN_WORD = np.zeros(256, bool)
_IN_WORD[48:58] = _IN_WORD[65:91] = _IN_WORD[97:123] = _IN_WORD[128:] = True


def _chunk_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(text number, feature) of every word and word beginning, repeats included."""
    data = joined(texts, lower=True)
    first, last = spans(data, _IN_WORD)
    text = np.repeat(np.arange(len(texts)), np.diff(per_text(texts, first)))
    out, who = [hashes(data, first, last, SEED)], [text]
    for length in BEGINNINGS:
        long = last - first > length
        out.append(hashes(data, first[long], first[long] + length, SEED + length))
        who.append(text[long])
    return np.concatenate(who), np.concatenate(out)


def _features(texts: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(number of texts, text numbers, features) of runs of texts."""
    for run in batches(texts, CHUNK_BYTES):
        if len(run[0]) > CHUNK_BYTES:  # in pieces, of which each feature is kept once
            found = np.unique(np.concatenate([np.unique(_chunk_features([p])[1]) for p in pieces(run[0], CHUNK_BYTES, _IN_WORD)]))
            yield 1, np.zeros(len(found), np.int64), found
        else:
            yield len(run), *_chunk_features(run)


@dataclass
class Linear:
    weights: np.ndarray
    bias: float

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x @ self.weights + self.bias, -30, 30)))


def fit_linear(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, steps: int = 300) -> Linear:
    """Logistic regression with an L2 penalty, by accelerated gradient steps; one class only gives a constant."""
    n = max(1, len(y))
    p = (y.sum() + 0.5) / (n + 1)
    model = Linear(np.zeros(x.shape[1], np.float32), float(np.log(p / (1 - p))))
    if not 0 < y.sum() < len(y):
        return model
    # The largest eigenvalue of the curvature bounds the step: a few power iterations give it.
    v = np.ones(x.shape[1], np.float32)
    for _ in range(8):
        v = x.T @ (x @ v)
        top = float(np.linalg.norm(v)) or 1.0
        v /= top
    rate = 1 / (0.25 * (top + n) / n + penalty / n)
    w, b, mw, mb = model.weights.copy(), model.bias, model.weights.copy(), model.bias
    for k in range(steps):
        error = (Linear(mw, mb).probability(x) - y).astype(np.float32)
        nw = mw - rate * (x.T @ error / n + penalty / n * mw)
        nb = mb - rate * float(error.mean())
        beta = k / (k + 3)
        mw, mb = nw + beta * (nw - w), nb + beta * (nb - b)
        w, b = nw, nb
    return Linear(w, b)


@dataclass
class Chain:
    """Fitted models in order; ``features`` is sorted, and a model weighs them and the earlier categories' logits."""

    categories: list[str]
    features: np.ndarray
    models: list[Linear]
    thresholds: list[float]

    def probabilities(self, present: np.ndarray) -> np.ndarray:
        out = np.zeros((len(present), len(self.models)), np.float64)
        for c, model in enumerate(self.models):
            out[:, c] = model.probability(np.hstack([present, _logit(out[:, :c])]))
        return out


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p)).astype(np.float32)


def _z_scores(counts: np.ndarray, positives: np.ndarray, total: int, total_positive: int) -> np.ndarray:
    """Signed root of the likelihood ratio between a feature's rate of positives and the overall rate."""
    base = min(max(total_positive / max(1, total), 1e-9), 1 - 1e-9)
    n = np.maximum(counts, 1)
    rate = positives / n
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(rate > 0, positives * np.log(rate / base), 0) + np.where(rate < 1, (counts - positives) * np.log((1 - rate) / (1 - base)), 0)
    return np.where(counts >= MIN_DOCS, np.sign(rate - base) * np.sqrt(2 * np.maximum(gain, 0)), 0.0)


def _chosen(tally: np.ndarray, per_fold: np.ndarray) -> dict[tuple[int | None, int], np.ndarray]:
    """For each fold left out, and for none, and each category: the places of its best features, best first."""
    use = {}
    for left_out in (*range(FOLDS), None):
        ks = [k for k in range(FOLDS) if k != left_out]
        seen, docs = tally[:, ks].sum(axis=1), per_fold[ks].sum(axis=0)
        for c in range(tally.shape[2] - 1):
            z = np.abs(_z_scores(seen[:, 0], seen[:, c + 1], docs[0], docs[c + 1]))
            best = np.argsort(-z, kind="stable")[:MAX_FEATURES]
            use[left_out, c] = best[z[best] >= MIN_Z]
    return use


def fit_chain(features: np.ndarray, tally: np.ndarray, fold: np.ndarray, y: np.ndarray, present: np.ndarray, categories: list[str]) -> Chain:
    """``tally``: per feature, fold and (documents, positives per category); ``present``: documents x features, 0/1.

    A fold's predictions come from features chosen, and models fitted, on the other folds alone.
    """
    per_fold = np.array([[np.sum(fold == k), *y[fold == k].sum(axis=0)] for k in range(FOLDS)]).reshape(FOLDS, -1)
    use = _chosen(tally, per_fold)
    models, thresholds, before = [], [], np.zeros((len(y), 0), np.float32)
    for c in range(len(categories)):
        outside = np.zeros(len(y))
        for k in range(FOLDS):
            inside = fold != k
            cols = use[k, c]
            m = fit_linear(np.hstack([present[inside][:, cols], before[inside]]), y[inside, c])
            outside[~inside] = m.probability(np.hstack([present[~inside][:, cols], before[~inside]]))
        cols = use[None, c]
        m = fit_linear(np.hstack([present[:, cols], before]), y[:, c])
        weights = np.zeros(len(features) + before.shape[1], np.float32)
        weights[cols], weights[len(features) :] = m.weights[: len(cols)], m.weights[len(cols) :]
        models.append(Linear(weights, m.bias))
        thresholds.append(best_threshold(outside, y[:, c]))
        before = np.hstack([before, _logit(outside)[:, None]])
    # Features that only a fold had chosen weigh nothing in the models of all folds.
    used = np.unique(np.concatenate([use[None, c] for c in range(len(categories))])) if categories else np.zeros(0, int)
    models = [Linear(np.concatenate([m.weights[: len(features)][used], m.weights[len(features) :]]), m.bias) for m in models]
    return Chain(categories, features[used], models, thresholds)


def best_threshold(p: np.ndarray, y: np.ndarray) -> float:
    """The probability from which the out-of-fold F1 is best, the middle of the gap below it.

    Only where at least ``MIN_PRECISION`` of what it takes is right; if that is nowhere so, nothing is taken.
    """
    order = np.argsort(-p, kind="stable")
    hits = np.cumsum(y[order])
    last = np.append(np.flatnonzero(np.diff(p[order])), len(p) - 1) if len(p) else np.zeros(0, int)
    last = last[hits[last] >= MIN_PRECISION * (last + 1)] if len(last) else last
    if not len(last) or not y.sum():
        return 1.1
    at = last[np.argmax(2 * hits[last] / (last + 1 + y.sum()))]
    low = p[order][at + 1] if at + 1 < len(p) else 0.0
    return float((p[order][at] + low) / 2)


def fit(docs: DataFrame, labels: DataFrame, categories: dict[str, Column], id_col: str = "doc_id", text_col: str = "text", max_labelled: int = MAX_LABELLED) -> Chain:
    """Fit the chain for ``categories`` (name: boolean column of ``labels``, null counts as false), in that order."""
    names = list(categories)
    own = labels.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("label_id")).agg(*[F.max(F.coalesce(c, F.lit(False)).cast("int")).alias(f"y{k}") for k, c in enumerate(categories.values())])
    own = own.filter(about(F.xxhash64("label_id", F.lit(7)), max_labelled, own.count()))
    sample = docs.select(F.col(id_col).cast("long").alias("label_id"), F.col(text_col).cast("string").cast("binary").alias("data"))
    own = F.broadcast(own)  # bounded by max_labelled
    # An id may stand on very many rows: they are thinned by a hash of id and text, and equal ones become one.
    rows = docs.select(F.col(id_col).cast("long").alias("label_id")).join(own, "label_id").count()
    sample = sample.join(own, "label_id").withColumn("hash", F.xxhash64("label_id", "data")).filter(about(F.col("hash"), max_labelled, rows))
    sample = sample.dropDuplicates(["label_id", "hash"]).withColumn("fold", F.pmod(F.xxhash64("label_id", F.lit(11)), F.lit(FOLDS)).cast("int"))
    columns = ["label_id", "data", *[f"y{k}" for k in range(len(names))], "fold"]
    sample = scratch.written(sample.select(*columns), "toxicity-sample")

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code = np.array(batch.column(len(columns) - 1).to_pylist(), np.uint32)
            for k in range(len(names)):
                code |= np.array(batch.column(2 + k).to_pylist(), np.uint32) << (3 + k)
            at = 0
            for count, who, feature in _features([t or b"" for t in batch.column(1).to_pylist()]):
                pairs = np.unique(np.stack([who.astype(_U), feature]), axis=1) if len(who) else np.zeros((2, 0), _U)
                bins = (pairs[1] >> _U(60)).astype(np.int64) % BINS
                for b in range(BINS):
                    mine = bins == b
                    codes = code[at + pairs[0][mine].astype(np.int64)]
                    yield pa.RecordBatch.from_pydict({"bin": pa.array([b], pa.int32()), "features": [pairs[1][mine].tobytes()], "codes": [codes.tobytes()]})
                at += count

    def count(part: pd.DataFrame) -> pd.DataFrame:
        feature = np.frombuffer(b"".join(part["features"]), _U)
        code = np.frombuffer(b"".join(part["codes"]), np.uint32)
        names_, at = np.unique(feature, return_inverse=True)
        tally = np.zeros((len(names_), FOLDS, 1 + len(names)), np.int64)
        fold_ = (code & 7).astype(np.int64)
        np.add.at(tally, (at, fold_, 0), 1)
        for k in range(len(names)):
            np.add.at(tally, (at, fold_, k + 1), ((code >> (3 + k)) & 1).astype(np.int64))
        # What any fold or all of them might choose; which of it they do is decided when all bins are together.
        found = _chosen(tally, np.array(per_fold))
        keep = np.unique(np.concatenate([*found.values(), np.zeros(0, int)]))
        return pd.DataFrame({"feature": names_[keep].astype(np.int64), "tally": pd.Series([t.ravel().tolist() for t in tally[keep]], dtype=object)})

    sums = {r["fold"]: [int(x or 0) for x in r[1:]] for r in sample.groupBy("fold").agg(F.count(F.lit(1)), *[F.sum(f"y{k}") for k in range(len(names))]).collect()}
    per_fold = [sums.get(k, [0] * (1 + len(names))) for k in range(FOLDS)]
    dealt = sample.mapInArrow(deal, "bin int, features binary, codes binary")
    got = dealt.groupBy("bin").applyInPandas(count, "feature long, tally array<long>").collect()  # bounded: folds, categories and bins times MAX_FEATURES
    features = np.array([r["feature"] for r in got], np.int64).astype(_U)
    order = np.argsort(features)
    features = features[order]
    tally = np.array([got[k]["tally"] for k in order], np.int64).reshape(len(got), FOLDS, 1 + len(names))
    chosen = np.unique(np.concatenate([*_chosen(tally, np.array(per_fold)).values(), np.zeros(0, int)]))
    features, tally = features[chosen], tally[chosen]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            present = _present([t or b"" for t in batch.column(1).to_pylist()], features)
            hits = [np.flatnonzero(row).tolist() for row in present]
            yield pa.RecordBatch.from_arrays([pa.array(hits, pa.list_(pa.int32())), *batch.columns[2:]], ["hits", *columns[2:]])

    rows = sample.mapInArrow(find, "hits array<int>, " + ", ".join(f"{c} int" for c in columns[2:])).collect()  # bounded by max_labelled
    present = np.zeros((len(rows), len(features)), np.float32)
    for k, r in enumerate(rows):
        present[k, r["hits"]] = 1
    y = np.array([[r[f"y{k}"] for k in range(len(names))] for r in rows], np.float64).reshape(len(rows), len(names))
    return fit_chain(features, tally, np.array([r["fold"] for r in rows], np.int64), y, present, names)


def _present(texts: list[bytes], features: np.ndarray) -> np.ndarray:
    """Texts x features: which of ``features`` (sorted) each text has."""
    out, at = np.zeros((len(texts), len(features)), np.float32), 0
    if not len(features):
        return out
    likely = np.zeros(1 << 16, bool)
    likely[(features & _U(0xFFFF)).astype(np.int64)] = True
    for count, who, feature in _features(texts):
        maybe = likely[(feature & _U(0xFFFF)).astype(np.int64)]
        who, feature = who[maybe], feature[maybe]
        place = np.minimum(np.searchsorted(features, feature), len(features) - 1)
        hit = features[place] == feature
        out[at + who[hit], place[hit]] = 1
        at += count
    return out


def judge(docs: DataFrame, chain: Chain, text_col: str = "text") -> DataFrame:
    """``docs`` with its columns in a struct ``doc``, and ``p_<category>`` for each category.

    Null and empty texts have no features and get the probabilities of a text without signs. Extra
    columns are carried inside ``doc``, so their names cannot clash. Narrow. Empty in, empty out.
    """
    names = [f"p_{c}" for c in chain.categories]

    @F.pandas_udf(", ".join(f"{n} double" for n in names))
    def probabilities(text: pd.Series) -> pd.DataFrame:
        parts = [chain.probabilities(_present([t or b"" for t in text.iloc[k : k + 512]], chain.features)) for k in range(0, len(text), 512)]
        return pd.DataFrame(np.vstack([*parts, np.zeros((0, len(names)))]), columns=names)

    found = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"), probabilities(F.col(text_col).cast("string").cast("binary")).alias("p"))
    return found.select("doc", *[F.col(f"p.{n}").alias(n) for n in names])


def default_categories() -> dict[str, Column]:
    """The labelled categories, in the chain's order: what helps to tell a later one comes first."""
    return {"low_quality": F.col("quality") == 0, "toxic": F.col("toxic") == 1}


def reject_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows judged toxic, columns unchanged."""
    chain = fit(docs, labels, default_categories())
    kept = judge(docs, chain).filter(F.col("p_toxic") < F.lit(chain.thresholds[-1]))
    return kept.select("doc.*")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its category probabilities; toxic: judged toxic at the out-of-fold threshold."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    chain = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), default_categories())
    return judge(docs, chain).select(
        F.col("doc.doc_id").alias("doc_id"), F.col("p_low_quality"), F.col("p_toxic"), (F.col("p_toxic") >= F.lit(chain.thresholds[-1])).alias("toxic")
    )
