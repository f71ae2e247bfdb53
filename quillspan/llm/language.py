"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Document frequencies count all training documents. The classifier is trained on a bounded sample of them by
follow-the-regularised-leader with elastic-net penalties, and its scores are calibrated by a temperature that
is fitted on documents of the sample that training left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import matching, released, slices, summed
from .features import char_ngrams, has_letter

#: Hashed n-grams: 2 to the power of this, fewer where there are many languages.
BITS = 16
#: Bound of the labelled training sample, shared evenly by the languages, with at least LEAST_EACH of each; documents are chosen by a hash.
MOST_ROWS = 4_000
LEAST_EACH = 8
#: Bound of the model's size, n-grams times languages. Every language is learned; more than fit in with FEWEST_BITS are an error.
MOST_WEIGHTS = 1 << 23
FEWEST_BITS = 8
UNDETERMINED = "und"


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # a row for each n-gram, with the inverse document frequency in it
    idf: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        names, scores = [], np.zeros(len(texts))
        for i, t in enumerate(texts):
            if not self.languages or not has_letter(t):
                names.append(UNDETERMINED)
                continue
            idx, x = counted(t, self.idf)
            z = (x @ self.weights[idx] + self.bias) / self.temperature
            e = np.exp(z - z.max())
            best = int(e.argmax())
            names.append(self.languages[best])
            scores[i] = e[best] / e.sum()
        return names, scores


def counted(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of a whole text and their TF-IDF values, of Euclidean length 1."""
    idx, count = distinct(char_ngrams(text, len(idf).bit_length() - 1))
    x = np.log1p(count) * idf[idx]
    return idx, x / max(1e-12, float(np.sqrt(x @ x)))


def distinct(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams and how often each stands there."""
    if not len(grams):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    g = np.sort(grams.astype(np.uint16), kind="stable")  # 16 bits: a radix sort
    edge = np.concatenate([np.flatnonzero(g[1:] != g[:-1]) + 1, [len(g)]])
    return g[edge - 1].astype(np.int64), np.diff(edge, prepend=0)


def train_ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int, epochs: int = 3, alpha: float = 0.5, beta: float = 1.0, l1: float = 2e-4, l2: float = 1e-4, seed: int = 0, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Follow-the-regularised-leader, per coordinate, on the multinomial loss."""
    z, n = np.zeros((1 << bits, classes)), np.zeros((1 << bits, classes))
    zb, nb = np.zeros(classes), np.zeros(classes)

    def leader(z: np.ndarray, n: np.ndarray, l1: float) -> np.ndarray:
        return np.where(np.abs(z) > l1, (np.sign(z) * l1 - z) / ((beta + np.sqrt(n)) / alpha + l2), 0.0)

    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            idx, x, y = rows[i]
            zi, ni = z[idx], n[idx]
            w, b = leader(zi, ni, l1), leader(zb, nb, 0.0)
            s = x @ w + b
            p = np.exp(s - s.max())
            p /= p.sum()
            p[y] -= 1
            g = x[:, None] * p
            new = ni + g * g
            z[idx] = zi + g - (np.sqrt(new) - np.sqrt(ni)) / alpha * w
            n[idx] = new
            new = nb + p * p
            zb, nb = zb + p - (np.sqrt(new) - np.sqrt(nb)) / alpha * b, new
    return leader(z, n, l1), leader(zb, nb, 0.0)


def fit_temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature of the least log loss, by golden-section search on its logarithm."""
    if not len(y):
        return 1.0

    def loss(t: float) -> float:
        s = logits / np.exp(t)
        s = s - s.max(1, keepdims=True)
        return float((np.log(np.exp(s).sum(1)) - s[np.arange(len(y)), y]).mean())

    lo, hi, g = -3.0, 3.0, (5**0.5 - 1) / 2
    for _ in range(40):
        a, b = hi - g * (hi - lo), lo + g * (hi - lo)
        lo, hi = (lo, b) if loss(a) < loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


def fold(doc_id: Column) -> Column:
    """crc32 of the doc_id as text, modulo 5; null for a null doc_id. Rows at 0 are held out."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5))


def bits_for(languages: int) -> int:
    """As many bits of hashed n-grams as keep the model within its bound."""
    bits = min(BITS, (MOST_WEIGHTS // max(1, languages)).bit_length() - 1)
    if bits < FEWEST_BITS:
        raise ValueError(f"over {MOST_WEIGHTS >> FEWEST_BITS} values of lang: more than a model of bounded size can tell apart")
    return bits


def document_frequencies(docs: DataFrame, bits: int = BITS) -> tuple[np.ndarray, int]:
    """How many documents have each n-gram, over all of docs (column text), and how many documents there are.

    Each task counts its documents in one vector.
    """

    @released
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros((1 << bits) + 1)
        for batch in slices(batches):
            for t in batch[0].to_pylist():
                df[distinct(char_ngrams(t, bits))[0]] += 1
            df[-1] += batch.num_rows
        yield pa.RecordBatch.from_arrays([pa.array([df.tobytes()], pa.binary())], names=["v"])

    df = summed(docs.select("text").mapInArrow(count, "v binary"), (1 << bits) + 1)
    if df is None:
        return np.zeros(1 << bits), 0
    return df[:-1], int(df[-1])


def fit(docs: DataFrame, most_rows: int = MOST_ROWS) -> Model:
    """Learns every language, from text and non-null lang of the documents that aren't held out.

    More values of lang than a model of bounded size can tell apart (32,768) are a ValueError.
    """
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    own = own.where("lang is not null and text is not null").where(fold(F.col("doc_id")) != 0)
    by_lang = own.groupBy("lang").count().orderBy("lang").limit(1 + (MOST_WEIGHTS >> FEWEST_BITS)).collect()
    languages = [r.lang for r in by_lang]
    bits = bits_for(len(languages))
    if not languages:
        return Model([], np.zeros((1 << bits, 0)), np.ones(1 << bits), np.zeros(0))
    df, n = document_frequencies(own, bits)
    idf = np.log((1 + n) / (1 + df)) + 1
    each = max(LEAST_EACH, most_rows // len(languages))
    table = [(r.lang, i, min(1.0, 1.1 * each / r["count"])) for i, r in enumerate(by_lang)]
    numbered = F.broadcast(docs.sparkSession.createDataFrame(table, "lang string, y int, share double"))  # of bounded size, by bits_for
    h = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    sample = own.join(numbered, "lang").where(h < F.col("share")).select("doc_id", "text", "y", (fold(F.col("doc_id")) == 1).alias("calibrate"))
    sample = sample.limit(2 * most_rows + 2 * LEAST_EACH * len(languages))

    @released
    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            xs = [counted(t, idf) for t in batch[1].to_pylist()]
            cols = [batch[0], batch[2], batch[3], pa.array([i.astype(np.int32).tobytes() for i, _ in xs], pa.binary()), pa.array([x.astype(np.float32).tobytes() for _, x in xs], pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "y", "calibrate", "i", "x"])

    # as Arrow batches: the driver's JVM would hold collected rows several times
    rows = sample.mapInArrow(extract, "doc_id long, y int, calibrate boolean, i binary, x binary").toArrow()
    rows = sorted(zip(*(rows[c].to_pylist() for c in ("doc_id", "y", "i", "x", "calibrate")), strict=True), key=lambda r: r[:3])
    data = [(np.frombuffer(i, np.int32), np.frombuffer(x, np.float32).astype(float), y) for _, y, i, x, _ in rows]
    learn = [d for d, r in zip(data, rows, strict=True) if not r[4]] or data
    check = [d for d, r in zip(data, rows, strict=True) if r[4]]
    w, b = train_ftrl(learn, len(languages), bits=bits)
    model = Model(languages, w, idf, b)
    if check:
        model.temperature = fit_temperature(np.array([x @ w[i] + b for i, x, _ in check]), np.array([y for *_, y in check]))
    return model


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row; only the text is looked at.

    und, with score 0, if the text is null or has no letter, or if nothing could be learned. Null doc_id: not held
    out, and not learned from. Repeated rows each have a row.
    """

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            names, scores = model.predict(batch[2].to_pylist())
            yield pa.RecordBatch.from_arrays([batch[0], batch[1], pa.array(names, pa.string()), pa.array(scores)], names=["doc_id", "held_out", "lang_pred", "score"])

    held = F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held, F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def language(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score: trains and predicts. Empty table: no rows. Extra columns are ignored."""
    return identify(docs, fit(docs))


def with_language(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """The rows of docs, all columns, whose language is found with a score of at least `least`.

    Null and empty texts, and those without a letter, go; very long texts are looked at whole. Ties and repeated rows
    are decided alike. Empty table: no rows; if nothing can be learned, all rows go. Columns of any name stay.
    """
    model = fit(docs)

    def keep(texts: list[str | None]) -> np.ndarray:
        names, scores = model.predict(texts)
        return (np.array(names, object) != UNDETERMINED) & (scores >= least)

    return docs.where(matching(keep)(F.col("text").cast("string")))
