"""Toxicity by non-negative positive-unlabelled learning.

The only supervision is a set of confirmed toxic texts; everything else is unlabelled, toxic texts among it. Linear classifiers over
word and word-prefix features are trained in numpy on the non-negative risk estimator
    pi * R+(positive) + max(0, R-(unlabelled) - pi * R-(positive)),
with the class prior pi estimated from the sample as the smallest ratio of an event's rates among unlabelled and positive texts.

Fitting uses bounded samples (`MAX_POSITIVE`, `MAX_UNLABELLED` texts, those whose ids hash lowest); scoring covers every whole text,
in one pass without a shuffle. The model that is sent to the executors has at most `MAX_FEATURES` weights.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textkit as tk

MAX_POSITIVE = 5_000
MAX_UNLABELLED = 12_000
MAX_FEATURES = 600
LEAST = 5  # positive texts that a feature must be in, at every size of sample
BITS = 22  # features are hashed to this many bits
SHARPNESS = 2.0  # of the scores about the threshold
PREFIXES = (4, 5, 6, 7, 8)  # bytes


def _features(p: tk.Piece) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of a piece and the text of each: whole words, and prefixes of longer ones."""
    p.buf = tk.LOWER[p.buf]
    a, b, first = tk.words(p, tk.ALNUM_WORD)
    pre = tk.prefix_hash(p.buf)
    doc = np.repeat(np.arange(len(p.start)), np.diff(first))
    fs, ds = [tk.span_hash(pre, a, b) >> tk.U64(64 - BITS)], [doc]
    for k in PREFIXES:
        long = b - a > k
        fs.append(tk.mix(tk.span_hash(pre, a[long], a[long] + k) + tk.U64(k)) >> tk.U64(64 - BITS))
        ds.append(doc[long])
    return np.concatenate(fs).astype(np.int64), np.concatenate(ds)


def _distinct(f: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    both = np.unique((d << BITS) | f)
    return both & ((1 << BITS) - 1), both >> BITS


def _document_counts(docs: DataFrame) -> DataFrame:
    """(feature, n): in how many texts each feature occurs; summed per task before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for p in tk.pieces(batch):
                f, _ = _distinct(*_features(p))
                total = np.zeros(1 << BITS, np.int32) if total is None else total
                total += np.bincount(f, minlength=1 << BITS).astype(np.int32)
        if total is not None:
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at].astype(np.int64))], ["feature", "n"])

    return docs.select("doc_id", "text").mapInArrow(run, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n"))


def _occurrences(docs: DataFrame, chosen: np.ndarray) -> DataFrame:
    """(doc_id, positive, found): the chosen features of each text, as int32 bytes of their indexes."""
    slot = np.full(1 << BITS, -1, np.int32)
    slot[chosen] = np.arange(len(chosen))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in tk.pieces(batch):
                f, d = _features(p)
                keep = slot[f] >= 0
                f, d = _distinct(slot[f[keep]].astype(np.int64), d[keep])
                cut = np.searchsorted(d, np.arange(len(p.start) + 1))
                f = f.astype("i4")
                yield pa.RecordBatch.from_arrays(
                    [p.ids, batch.column("positive").slice(p.row, len(p.ids)), pa.array([f[cut[k] : cut[k + 1]].tobytes() for k in range(len(p.start))], pa.binary())], ["doc_id", "positive", "found"]
                )

    return docs.select("doc_id", "positive", "text").mapInArrow(run, "doc_id long, positive boolean, found binary")


@dataclass
class Model:
    """Slots of `features` (hashes) with one row of weights for each classifier."""

    features: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    prior: float


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def train_nnpu(xp: np.ndarray, xu: np.ndarray, prior: float, seed: int, steps: int = 600, rate: float = 0.05, decay: float = 1e-5, batch: int = 1024) -> tuple[np.ndarray, float]:
    """Weights and bias (that of the last column, which holds ones) of a linear classifier by the non-negative PU risk with logistic loss (Adam; deterministic for a seed).

    Where the corrected negative risk of a batch falls below zero, the step ascends it instead, as Kiryo et al. (2017) propose.
    """
    rng = np.random.Generator(np.random.PCG64(seed))
    w, m, v = (np.zeros(xp.shape[1], np.float32) for _ in range(3))
    for t in range(1, steps + 1):
        p, u = (x[rng.integers(0, len(x), min(len(x), batch))] for x in (xp, xu))
        zp, zu = p @ w, u @ w
        # loss of label +1: log(1+exp(-z)), gradient -(1-s); of label -1: log(1+exp(z)), gradient s
        sp, su = _sigmoid(zp), _sigmoid(zu)
        negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        g_neg = u.T @ su / len(u) - prior * (p.T @ sp) / len(p)
        g = -prior * (p.T @ (1 - sp)) / len(p) + g_neg if negative >= 0 else -g_neg
        g = g.astype(np.float32)
        g[:-1] += np.float32(decay) * w[:-1]
        m = 0.9 * m + 0.1 * g
        v = 0.999 * v + 0.001 * g * g
        w = w - np.float32(rate / (1 - 0.9**t)) * m / (np.sqrt(v / np.float32(1 - 0.999**t)) + np.float32(1e-8))
    return w[:-1].astype(np.float64), float(w[-1])


def fit_arrays(p_lists: list[np.ndarray], u_lists: list[np.ndarray], n_features: int, seeds: tuple[int, ...] = (1, 2, 3)) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Chosen features, weights, biases and prior from the feature indexes of positive and unlabelled texts."""
    np_, nu = len(p_lists), len(u_lists)
    dp, du = (np.bincount(np.concatenate([np.zeros(0, np.int32), *x]), minlength=n_features).astype(float) for x in (p_lists, u_lists))
    rp, ru = dp / np_, (du + 0.5) / (nu + 1)
    # one-sided bound of the log ratio of rates; features typical of positives only
    bound = np.log(np.maximum(rp, 1e-12) / ru) - 1.64 * np.sqrt(1 / np.maximum(dp, 1) + 1 / np.maximum(du, 1))
    chosen = np.flatnonzero((dp >= LEAST) & (bound > np.log(2.5)))
    chosen = np.sort(chosen[np.argsort(-(bound * dp)[chosen], kind="stable")[:MAX_FEATURES]])
    slot = np.full(n_features, -1)
    slot[chosen] = np.arange(len(chosen))

    def dense(lists: list[np.ndarray]) -> np.ndarray:
        x = np.zeros((len(lists), len(chosen) + 1), np.float32)
        x[:, -1] = 1
        for i, f in enumerate(lists):
            s = slot[f]
            x[i, s[s >= 0]] = 1
        return x

    xp, xu = dense(p_lists), dense(u_lists)
    # the prior: no event is rarer among unlabelled texts than pi times its rate among positives
    strong = np.argsort(-(bound * np.sqrt(dp))[chosen], kind="stable")[:400]
    prior = 0.5
    for k in range(1, len(strong) + 1, 5):
        ep, eu = ((x[:, strong[:k]] > 0).any(axis=1).mean() for x in (xp, xu))
        if ep > 0.05:
            prior = min(prior, (eu + 1 / np.sqrt(nu) / 4) / ep)
    prior = float(np.clip(prior, 0.005, 0.5))
    fits = [train_nnpu(xp, xu, prior, s) for s in seeds] if len(chosen) else [(np.zeros(0), -2.0)]
    w, b = np.array([w for w, _ in fits]), np.array([b for _, b in fits])
    if len(chosen):
        # the decision threshold, a score of 0.7: almost all confirmed positives lie above it, and no larger share of the unlabelled texts than the prior
        for k in range(len(b)):
            cut = max(np.quantile(xp[:, :-1] @ w[k] + b[k], 0.02), np.quantile(xu[:, :-1] @ w[k] + b[k], 1 - 0.9 * prior))
            w[k], b[k] = SHARPNESS * w[k], SHARPNESS * (b[k] - cut) + np.log(0.7 / 0.3)
    return chosen, w, b, prior


def fold(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 3; null for null ids."""
    return F.crc32(F.col(id_col).cast("string")) % 3


def fit(docs: DataFrame, labels: DataFrame, learn: Column | None = None, max_positive: int = MAX_POSITIVE, max_unlabelled: int = MAX_UNLABELLED) -> Model | None:
    """A model from docs and labels (doc_id, toxic); None where there is no positive text.

    learn: a condition on doc_id for rows that may be used. Only toxic = 1 rows are read from the labels; of several labels of one
    id the highest counts; null ids are never used.
    """
    allowed = F.col("doc_id").isNotNull() if learn is None else F.col("doc_id").isNotNull() & learn
    rank = F.xxhash64("doc_id")
    positive = labels.where(allowed & (F.col("toxic") == 1)).select("doc_id").distinct()
    few = positive.orderBy(rank, "doc_id").limit(max_positive)
    some = docs.where(allowed).select("doc_id").distinct().orderBy(rank, "doc_id").limit(max_unlabelled)
    sample = few.withColumn("positive", F.lit(True)).unionByName(some.withColumn("positive", F.lit(False)))
    # at most max_positive + max_unlabelled ids: bounded, so it may be broadcast
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(sample), "doc_id").where("text IS NOT NULL")
    counts = _document_counts(rows.where("positive")).where(F.col("n") >= LEAST).select("feature").toPandas()
    candidates = np.sort(counts["feature"].to_numpy(np.int64))
    del counts
    if not len(candidates):
        return None
    found = _occurrences(rows, candidates).toPandas()
    found = found.sort_values(["doc_id", "positive", "found"])
    lists = [np.frombuffer(x, "i4") for x in found["found"]]
    is_p = found["positive"].to_numpy(bool)
    del found
    p, u = [x for x, y in zip(lists, is_p) if y], [x for x, y in zip(lists, is_p) if not y]
    del lists
    if not p or not u:
        return None
    chosen, w, b, prior = fit_arrays(p, u, len(candidates))
    return Model(candidates[chosen], w, b, prior)


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """doc_id, score and any columns in `keep`, a row for each row of docs. Null and empty texts get the score of no features; without a model every score is 0."""
    slot = np.full(1 << BITS, -1, np.int32)
    w, b = np.zeros((1, 0)), np.array([-30.0])
    if model is not None:
        slot[model.features] = np.arange(len(model.features))
        w, b = model.weights, model.bias
    w = w.T.copy()
    some = slot >= 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in tk.pieces(batch, "__id", "__text"):
                f, d = _features(p)
                at = some[f]
                f, d = _distinct(slot[f[at]].astype(np.int64), d[at])
                z = np.stack([np.bincount(d, w[f, k], minlength=len(p.start)) + b[k] for k in range(len(b))])
                s = np.clip(_sigmoid(z).mean(axis=0), 0, 1)
                rest = [batch.column(c).slice(p.row, len(p.ids)) for c in kept]
                yield pa.RecordBatch.from_arrays([*rest, pa.array(s)], [*kept, "__score"])

    kept = ["__id", *[f"__k_{c}" for c in keep or []]]
    source = docs.select(F.col(id_col).cast("long").alias("__id"), F.col(text_col).cast("string").alias("__text"), *(F.col(c).alias(f"__k_{c}") for c in keep or []))
    schema = source.drop("__text").schema.add("__score", "double")
    out = source.mapInArrow(run, schema)
    return out.select(F.col("__id").alias("doc_id"), F.col("__score").alias("score"), *(F.col(f"__k_{c}").alias(c) for c in keep or []))


def without_toxic(docs: DataFrame, model: Model | None, threshold: float = 0.7, text_col: str = "text") -> DataFrame:
    """The rows of docs, all columns as they are, whose score is below threshold. Without a model all stay."""
    if model is None:
        return docs
    slot = np.full(1 << BITS, -1, np.int32)
    slot[model.features] = np.arange(len(model.features))
    some, w, b = slot >= 0, model.weights.T.copy(), model.bias

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.RecordBatch.from_arrays([pa.nulls(batch.num_rows), batch.column(at)], ["id", "text"])
            keep = [np.zeros(0, bool)]
            for p in tk.pieces(texts, "id", "text"):
                f, d = _features(p)
                k = some[f]
                f, d = _distinct(slot[f[k]].astype(np.int64), d[k])
                z = np.stack([np.bincount(d, w[f, i], minlength=len(p.start)) + b[i] for i in range(len(b))])
                keep.append(_sigmoid(z).mean(axis=0) < threshold)
            yield batch.filter(pa.array(np.concatenate(keep)))

    at = docs.columns.index(text_col)
    return docs.mapInArrow(run, docs.schema)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, scored by a model that never saw a third of the ids."""
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    model = fit(docs, labels, fold() != 1)
    return score(docs, model).select("doc_id", F.coalesce(fold() == 1, F.lit(True)).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
