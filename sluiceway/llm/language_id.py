"""Language identification by sparse multinomial logistic regression.

Features are TF-IDF weights of character 1- to 3-grams of the lower-cased text, hashed to a
fixed number of dimensions. Document frequencies are counted over all training documents;
the weights are trained on a bounded sample of them with the follow-the-regularised-leader
proximal method, whose L1 term keeps them sparse and whose L2 term keeps them small. A part
of the sample that training never saw sets a temperature, so scores are probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.common import blocks, give_back, materialize

DIM_BITS = 15
DIMS = 1 << DIM_BITS
ORDERS = 3
SLICES = 16
MERGES = 256
BLOCK = 2 << 20
UNKNOWN = "und"


def ngram_counts(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each text, the hashed n-grams in it and how often each is there."""
    low = [t.lower() for t in texts]
    codes = np.frombuffer("".join(low).encode("utf-32-le"), np.uint32)
    shift = np.uint32(32 - DIM_BITS)
    grams, h = [], np.zeros(len(codes), np.uint32)
    for n in range(ORDERS):
        h = h[: len(codes) - n] * np.uint32(0x01000193) + codes[n:] + np.uint32(n + 1) if n <= len(codes) else h[:0]
        mixed = (h ^ h >> np.uint32(15)) * np.uint32(0x85EBCA6B)
        grams.append(((mixed ^ mixed >> np.uint32(13)) * np.uint32(0xC2B2AE35) >> shift).astype(np.int64))
    begin = 0
    for t in low:
        end = begin + len(t)
        counts = np.bincount(np.concatenate([g[begin : max(begin, end - n)] for n, g in enumerate(grams)]), minlength=DIMS)
        found = np.flatnonzero(counts)
        yield found, counts[found]
        begin = end


def tf_idf(found: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = (1 + np.log(counts)) * idf[found]
    norm = np.sqrt(x @ x)
    return x / norm if norm else x


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


class Ftrl:
    """Multinomial follow-the-regularised-leader (proximal), with L1 and L2 penalties."""

    def __init__(self, dims: int, classes: int, alpha: float = 1.0, beta: float = 1.0, l1: float = 0.02, l2: float = 1e-3) -> None:
        self.z, self.n = np.zeros((dims, classes)), np.zeros((dims, classes))
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, rows: np.ndarray | slice) -> np.ndarray:
        z = self.z[rows]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(self.n[rows])) / self.alpha + self.l2)
        return np.where(np.abs(z) > self.l1, w, 0.0)

    def learn(self, found: np.ndarray, x: np.ndarray, label: int) -> None:
        w = self.weights(found)
        error = softmax(x @ w)
        error[label] -= 1
        g = x[:, None] * error
        n = self.n[found]
        after = n + g * g
        self.z[found] += g - (np.sqrt(after) - np.sqrt(n)) / self.alpha * w
        self.n[found] = after


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray
    idf: np.ndarray
    temperature: float

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and score of each text; UNKNOWN and 0 for null, without a letter, or untrained."""
        known = [i for i, t in enumerate(texts) if t and any(c.isalpha() for c in t)] if self.languages else []
        names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        for i, (found, counts) in zip(known, ngram_counts([texts[i] for i in known]), strict=True):
            p = softmax(tf_idf(found, counts, self.idf) @ self.weights[found] / self.temperature)
            best = int(p.argmax())
            names[i], scores[i] = self.languages[best], float(p[best])
        return names, scores


def fit_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the least negative log-likelihood, by golden-section search on its logarithm."""
    if not len(labels):
        return 1.0

    def loss(t: float) -> float:
        p = softmax(logits / np.exp(t))[np.arange(len(labels)), labels]
        return float(-np.log(np.maximum(p, 1e-12)).mean())

    a, b, ratio = np.log(0.02), np.log(20.0), (5**0.5 - 1) / 2
    for _ in range(40):
        c, d = b - ratio * (b - a), a + ratio * (b - a)
        a, b = (a, d) if loss(c) < loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


def train(languages: list[str], sample: list[tuple[int, np.ndarray, np.ndarray]], idf: np.ndarray, epochs: int = 3, seed: int = 7) -> Model:
    """sample: (language, n-grams, their weights). Every fifth example is kept for calibration."""
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(sample))
    held = order[::5] if len(order) >= 10 else order[:0]
    used = np.setdiff1d(order, held)
    ftrl = Ftrl(DIMS, len(languages))
    for _ in range(epochs):
        for i in rng.permutation(used):
            ftrl.learn(sample[i][1], sample[i][2].astype(float), sample[i][0])
    weights = ftrl.weights(slice(None))
    logits = np.array([sample[i][2] @ weights[sample[i][1]] for i in held]).reshape(-1, len(languages))
    return Model(languages, weights.astype(np.float32), idf, fit_temperature(logits, np.array([sample[i][0] for i in held], np.int64)))


def fold(id_col: str, parts: int) -> Column:
    """crc32 of the id as text, modulo parts; of an empty text where the id is null."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % parts


def sum_vectors(parts: DataFrame) -> np.ndarray:
    """Sum of the vectors in parts (slice int, task int, data binary of int64), in two levels."""

    def add(pdf):
        total = sum(np.frombuffer(d, np.int64) for d in pdf["data"])
        return pdf.iloc[:1].assign(data=total.tobytes())

    for tasks in (MERGES, 1):
        parts = parts.withColumn("task", F.pmod("task", F.lit(tasks))).groupBy("slice", "task").applyInPandas(add, "slice int, task int, data binary")
    out = {r.slice: np.frombuffer(r.data, np.int64) for r in parts.collect()}  # SLICES rows
    return np.concatenate([out[i] for i in range(SLICES)]) if out else np.zeros(DIMS, np.int64)


def learn_model(docs: DataFrame, per_language: int = 1000, text_col: str = "text", lang_col: str = "lang", key: Column | None = None, most_languages: int = 256) -> Model:
    """Trains on all rows of docs with a text and a language.

    Document frequencies are those of all these rows. Weights and temperature come of about
    per_language rows of each language, or all if there are fewer: those whose hash of `key`
    and text is below the language's share. Rows with one key and text count once there, so
    the sample is bounded even if ids are null or rows repeated. Of more than most_languages
    languages, those with the most rows are learned.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"), (F.xxhash64(*([] if key is None else [key]), F.col(text_col)).bitwiseAND(0x7FFFFFFF) / float(1 << 31)).alias("u")).filter("text is not null and lang is not null")
    counts = dict(map(tuple, rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(most_languages).collect()))
    languages = sorted(counts)
    shares = {name: per_language / n for name, n in counts.items()}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n, seen = np.zeros(DIMS, np.int64), 0, set()
        kinds = [pa.int32(), pa.int32(), pa.string(), pa.binary(), pa.int64()]
        names = ["slice", "task", "lang", "data", "n"]
        for batch in blocks(batches, limit=BLOCK):
            taken = []
            langs, u = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            for i, (found, tf) in enumerate(ngram_counts(batch.column(0).to_pylist())):
                df[found] += 1
                n += 1
                if u[i] < shares.get(langs[i], 0) and (langs[i], u[i]) not in seen:
                    seen.add((langs[i], u[i]))  # a part of the sample at most
                    taken.append((-1, 0, langs[i], found.astype("<u2").tobytes() + tf.astype("<u4").tobytes(), 0))
            if taken:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*taken, strict=True), kinds, strict=True)], names=names)
        if n:
            task = TaskContext.get().partitionId()
            parts = [(i, task, None, part.tobytes(), n if i == 0 else 0) for i, part in enumerate(np.split(df, SLICES))]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*parts, strict=True), kinds, strict=True)], names=names)

    found = materialize(rows.mapInArrow(count, "slice int, task int, lang string, data binary, n long"))
    df = sum_vectors(found.filter("slice >= 0").select("slice", "task", "data"))
    total = found.agg(F.sum("n")).first()[0] or 0
    idf = (np.log((1 + total) / (1 + df)) + 1).astype(np.float32)
    place = {name: i for i, name in enumerate(languages)}
    picked = sorted((place[r.lang], bytes(r.data)) for r in found.filter("slice < 0").select("lang", "data").distinct().toLocalIterator())
    sample = []
    for i, data in picked:
        n = len(data) // 6
        grams = np.frombuffer(data, "<u2", n)
        sample.append((i, grams, tf_idf(grams, np.frombuffer(data, "<u4", n, 2 * n), idf).astype(np.float32)))
    del picked
    model = train(languages, sample, idf) if sample else Model([], np.zeros((DIMS, 0), np.float32), idf, 1.0)
    del sample
    give_back()
    return model


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: Column | None = None) -> DataFrame:
    """id, held_out (the value of keep), lang_pred and score of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # DIMS numbers a language

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, limit=BLOCK):
            names, scores = shared.value.predict(batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col(id_col).alias("doc_id"), (keep if keep is not None else F.lit(False)).alias("held_out"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(label, f"doc_id {kind}, held_out boolean, lang_pred string, score double").withColumnRenamed("doc_id", id_col)


def identify_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", parts: int = 4, held: int = 2, per_language: int = 1000) -> DataFrame:
    """One row per input row: id, held_out, lang_pred, score (0 to 1).

    Rows whose crc32(id as text) mod parts is `held` are held out; the model learns from the
    text and language of the others and predicts all rows from their whole text alone. A
    null text or one without a letter is 'und' with score 0, as are all if nothing could be
    learned; rows without a language are predicted but not learned from. Equal texts have
    equal predictions. Empty table: no rows. Other columns are ignored.
    """
    held_out = fold(id_col, parts) == held
    model = learn_model(docs.filter(~held_out), per_language, text_col, lang_col, F.col(id_col))
    return predict(docs, model, id_col, text_col, held_out)


def keep_identified(docs: DataFrame, least_score: float = 0.5, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", parts: int = 4, held: int = 2, per_language: int = 1000) -> DataFrame:
    """The rows of docs with a language of at least this score, with all their columns; the model is as in identify_languages."""
    model = learn_model(docs.filter(fold(id_col, parts) != held), per_language, text_col, lang_col, F.col(id_col))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, text_col, BLOCK):
            names, scores = shared.value.predict(batch.column(place).to_pylist())
            yield batch.filter(pa.array([n != UNKNOWN and s >= least_score for n, s in zip(names, scores, strict=True)], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
