"""Toxicity by non-negative positive-unlabelled learning.

A linear classifier on the words of a text is trained from confirmed toxic documents and from unlabelled text,
with the risk of the negative class taken from the unlabelled text and corrected by the share of toxic
documents in it; where the corrected risk of a batch is negative, its gradient is reversed. That loss leaves the
scores timid: what labelled documents say of models that didn't see them calibrates them, by Platt's method.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import matching, released, slices, written
from .features import word_hashes

#: Bounds of the training sample: confirmed toxic documents and unlabelled ones, chosen by a hash.
MOST_POSITIVE = 4_000
MOST_UNLABELLED = 12_000
#: Features beside the words themselves: the first letters of longer words.
PREFIXES = (4, 6)
#: A feature takes part if at least so many confirmed toxic documents of the sample have it, and if they are as many
#: standard deviations over what the unlabelled text leads to expect.
LEAST_DOCS = 3
LEAST_DEVIATION = 3.5
#: Part of the gradient that is reversed where the corrected risk of the negative class is below zero.
REVERSED = 0.1
#: Parts of the sample that are left out in turn for the calibration, and the documents of either label that it needs at least.
PARTS = 3
LEAST_LABELLED = 20
THRESHOLD = 0.7


@dataclass
class Model:
    keys: np.ndarray  # sorted hashes of the features that have a weight
    weights: np.ndarray
    bias: float

    def logits(self, features: list[np.ndarray]) -> np.ndarray:
        out = np.full(len(features), self.bias)
        if not len(self.keys):
            return out
        for i, f in enumerate(features):
            at = np.minimum(np.searchsorted(self.keys, f), len(self.keys) - 1)
            out[i] += self.weights[at[self.keys[at] == f]].sum()
        return out

    def scores(self, texts: list[str | None]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits([features(t) for t in texts]), -30, 30)))


def features(text: str | None) -> np.ndarray:
    """The distinct features of a whole text, as hashes."""
    return np.unique(word_hashes(text, PREFIXES))


def train(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, epochs: int = 40, batches: int = 8, rate: float = 0.05, l2: float = 1e-3, seed: int = 0) -> Model:
    """Non-negative PU risk with the logistic loss, by Adam with a shrinking step. prior: the share of toxic documents in the unlabelled ones."""
    if not positive or not unlabelled:
        return Model(np.empty(0, np.uint64), np.empty(0), float(np.log(max(prior, 1e-4) / (1 - min(prior, 0.999)))))
    keys, in_docs = np.unique(np.concatenate(positive), return_counts=True)
    all_keys, all_docs = np.unique(np.concatenate(unlabelled), return_counts=True)
    at = np.minimum(np.searchsorted(all_keys, keys), max(0, len(all_keys) - 1))
    share = (np.where(all_keys[at] == keys, all_docs[at], 0) if len(all_keys) else np.zeros(len(keys))) / len(unlabelled)
    expected = len(positive) * (share + 0.5 / len(unlabelled))
    keys = keys[(in_docs >= LEAST_DOCS) & ((in_docs - expected) / np.sqrt(expected + 0.25) >= LEAST_DEVIATION)]
    if not len(keys):
        return train([], [], prior)

    def rows(docs: list[np.ndarray]) -> list[np.ndarray]:
        out = []
        for f in docs:
            at = np.minimum(np.searchsorted(keys, f), len(keys) - 1)
            out.append(at[keys[at] == f])
        return out

    p_rows, u_rows = rows(positive), rows(unlabelled)
    k, rng = len(keys) + 1, np.random.default_rng(seed)
    w, m, v, step = np.zeros(k), np.zeros(k), np.zeros(k), 0
    w[-1] = np.log(prior / (1 - prior))
    sig = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def forward(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        idx = np.concatenate(docs)
        own = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
        return idx, own, np.bincount(own, w[idx], len(docs)) + w[-1]

    def backward(idx: np.ndarray, own: np.ndarray, dz: np.ndarray) -> np.ndarray:
        g = np.empty(k)
        g[:-1] = np.bincount(idx, dz[own], k - 1)
        g[-1] = dz.sum()
        return g

    for epoch in range(epochs):
        p_order, u_order = rng.permutation(len(p_rows)), rng.permutation(len(u_rows))
        for b in range(batches):
            p, u = p_order[b::batches], u_order[b::batches]
            if not len(p):
                p = p_order
            if not len(u):
                u = u_order
            pi, po, pz = forward([p_rows[i] for i in p])
            ui, uo, uz = forward([u_rows[i] for i in u])
            sp, su = sig(pz), sig(uz)
            negative = np.logaddexp(0, uz).mean() - prior * np.logaddexp(0, pz).mean()  # risk of the negative class
            d_neg = backward(ui, uo, su / len(u)) - prior * backward(pi, po, sp / len(p))
            if negative >= 0:
                g = d_neg + prior * backward(pi, po, (sp - 1) / len(p))
            else:
                g = -REVERSED * d_neg + prior * backward(pi, po, (sp - 1) / len(p))
            g[:-1] += l2 * w[:-1]
            step += 1
            lr = rate / (1 + 0.2 * epoch)
            m = 0.9 * m + 0.1 * g
            v = 0.99 * v + 0.01 * g * g
            w -= lr * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
    used = np.flatnonzero(w[:-1])
    return Model(keys[used], w[:-1][used], float(w[-1]))


def platt(z: np.ndarray, y: np.ndarray, prior: float, steps: int = 100) -> tuple[float, float]:
    """Slope and shift of the logits z under which they are the log odds of the label y, toxic documents being as frequent as `prior`.

    By Newton's method on the log loss, with Platt's targets, under which both stay finite. (1, 0) where no rising line fits.
    """
    n1, n0 = int((y == 1).sum()), int((y == 0).sum())
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    weight = np.where(y == 1, prior / n1, (1 - prior) / n0)
    x = np.stack([z, np.ones(len(z))], 1)

    def loss(ab: np.ndarray) -> float:
        s = x @ ab
        return float(weight @ (np.logaddexp(0, s) - target * s))

    ab = np.array([1.0, 0.0])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ ab, -30, 30)))
        g = x.T @ (weight * (p - target))
        move = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + 1e-9 * np.eye(2), g)
        size = 1.0
        while size > 1e-6 and loss(ab - size * move) > loss(ab) - 1e-4 * size * float(g @ move):
            size /= 2
        ab = ab - size * move
        if np.abs(size * move).max() < 1e-8:
            break
    return (float(ab[0]), float(ab[1])) if ab[0] > 0 and np.isfinite(ab).all() else (1.0, 0.0)


def calibrated(model: Model, positive: list[tuple[int, np.ndarray]], unlabelled: list[tuple[int, np.ndarray]], negative: list[tuple[int, np.ndarray]], prior: float) -> Model:
    """The model with weights and bias under which its scores are probabilities of the label.

    Positive documents and those labelled otherwise (negative, of the unlabelled ones) are scored by models of the
    other parts. Documents come with their part, by a hash of the text: those left without features spread over all. With too few labelled documents the model stays as it is.
    """
    if min(len(positive), len(negative)) < LEAST_LABELLED or not len(model.keys):
        return model
    z, y = [], []
    for k in range(PARTS):
        left = [[f for part, f in docs if part != k] for docs in (positive, unlabelled)]
        other = train(*left, prior)
        for docs, label in ((positive, 1), (negative, 0)):
            own = [f for part, f in docs if part == k]
            z.append(other.logits(own))
            y.append(np.full(len(own), label))
    slope, shift = platt(np.concatenate(z), np.concatenate(y), prior)
    return Model(model.keys, model.weights * slope, model.bias * slope + shift)


def fold(doc_id: Column) -> Column:
    """crc32 of the doc_id as text, modulo 3; null for a null doc_id. Rows at 1 are held out."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3))


def _features(rows: DataFrame, keep: np.ndarray | None = None) -> DataFrame:
    """toxic, negative, part, f: the features of each text, of those in `keep` (sorted) if that is given."""

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = []
            for t in batch[3].to_pylist():
                f = features(t)
                if keep is not None:
                    at = np.minimum(np.searchsorted(keep, f), len(keep) - 1)
                    f = f[keep[at] == f]
                out.append(f.view(np.int64))
            yield pa.RecordBatch.from_arrays([batch[0], batch[1], batch[2], pa.array(out, pa.list_(pa.int64()))], names=["toxic", "negative", "part", "f"])

    return rows.select("toxic", "negative", "part", "text").mapInArrow(run, "toxic int, negative boolean, part int, f array<long>")


def fit(docs: DataFrame, labels: DataFrame, most_positive: int = MOST_POSITIVE, most_unlabelled: int = MOST_UNLABELLED) -> Model:
    """Trains on the documents that aren't held out, and calibrates. The prior is the toxic share of their labelled ones.

    Labels of other rows are never read. A document labelled more than once is toxic if any of its labels says so.
    """
    seen = labels.where(F.col("doc_id").isNotNull() & (fold(F.col("doc_id")) != 1) & F.col("toxic").isNotNull())
    seen = seen.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    total, toxic = seen.agg(F.count(F.lit(1)), F.sum("toxic")).first()
    prior = min(0.9, max(1e-3, (toxic or 0) / total)) if total else 0.05
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where(F.col("doc_id").isNotNull() & (fold(F.col("doc_id")) != 1) & F.col("text").isNotNull())
    h = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    n = docs.count()
    # the sample's ids are bounded, so they are broadcast and no text is shuffled
    positive = seen.where("toxic = 1").where(h < F.lit(1.2 * most_positive / max(1, toxic or 0))).select("doc_id").limit(most_positive)
    drawn = h < F.lit(1.8 * most_unlabelled / max(1, n))
    unlabelled = docs.select(F.col("doc_id").cast("long").alias("doc_id")).where(F.col("doc_id").isNotNull() & (fold(F.col("doc_id")) != 1)).where(drawn).distinct().limit(most_unlabelled)
    unlabelled = unlabelled.join(seen.where(drawn).select("doc_id", (F.col("toxic") == 0).alias("negative")), "doc_id", "left")
    ids = positive.select("doc_id", F.lit(1).alias("toxic"), F.lit(False).alias("negative")).unionAll(unlabelled.select("doc_id", F.lit(0), F.coalesce("negative", F.lit(False))))
    sample = written(own.join(F.broadcast(written(ids, "sample-ids")), "doc_id").select("toxic", "negative", F.pmod(F.xxhash64("text"), F.lit(PARTS)).cast("int").alias("part"), "text"), "sample")
    counts = sample.groupBy("toxic").count().collect()
    p, u = (sum(r["count"] for r in counts if r.toxic == c) for c in (1, 0))
    if not p or not u:
        return train([], [], prior)
    # only features that toxic documents share beyond what is expected can take part: the rest stays on the executors
    seen_in = _features(sample).select("toxic", F.explode("f").alias("f")).groupBy("f").agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b"))
    expected = F.lit(float(p)) * (F.col("b") + 0.5) / F.lit(float(u))
    shared = seen_in.where((F.col("a") >= LEAST_DOCS) & ((F.col("a") - expected) / F.sqrt(expected + 0.25) >= LEAST_DEVIATION)).select("f").toArrow()
    keep = np.sort(shared["f"].to_numpy().view(np.uint64))
    if not len(keep):
        return train([], [], prior)
    rows = _features(sample, keep).toArrow()
    toxic_rows, negative_rows = rows["toxic"].to_numpy(), rows["negative"].to_numpy(zero_copy_only=False)
    lists = [f.values.to_numpy().view(np.uint64) for f in rows["f"]]
    of = lambda chosen: sorted(((k, f) for k, f, c in zip(rows["part"].to_pylist(), lists, chosen, strict=True) if c), key=lambda x: (x[1].tobytes(), x[0]))
    positive, unlabelled = of(toxic_rows == 1), of(toxic_rows == 0)
    model = train([f for _, f in positive], [f for _, f in unlabelled], prior)
    return calibrated(model, positive, unlabelled, of(negative_rows), prior)


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of every row; only the text is looked at.

    Null or empty text: the score of a text without words. Null doc_id: not held out. Repeated rows each have a row.
    """

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            s = model.scores(batch[2].to_pylist())
            yield pa.RecordBatch.from_arrays([batch[0], batch[1], pa.array(s), pa.array((s >= threshold).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    held = F.coalesce(fold(F.col("doc_id")) == 1, F.lit(False)).alias("held_out")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held, F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted: trains and scores. Empty table: no rows. Extra columns are ignored."""
    return score(docs, fit(docs, labels))


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs, all columns, that score below the threshold.

    Null, empty and wordless texts score as texts without words, and stay; very long texts are scored whole. Ties and
    repeated rows are decided alike. Empty table: no rows. Without labels all rows stay. Columns of any name stay.
    """
    model = fit(docs, labels)
    return docs.where(matching(lambda texts: model.scores(texts) < threshold)(F.col("text").cast("string")))
