"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features: hashed character 1- to 3-grams of the lower-cased text with every run of non-letters as one space; a
feature's weight is its relative frequency in the text times its inverse document frequency. Document frequencies
count all learnable documents, in Spark. Weights are trained with follow-the-regularised-leader (per-coordinate
rates) and elastic-net penalties, which leave most of them zero, on a bounded sample: ``PER_LANGUAGE`` documents
of each language, fewer (one at least) where that would pass ``SAMPLE_ROWS`` in all; those with the smallest hash of
id and text, whole texts. A fifth of the sample is kept back to calibrate the probabilities with one temperature.
Every language is learnt, however many there are: training holds half a MB for each, and a scored text is multiplied
by its distinct buckets, a bounded slice at a time.

Defined cases. Null text, or one without a letter: ``und`` with score 0. Null languages teach nothing. Nothing to
learn from: ``und`` with score 0. Ties go to the language that sorts first. Null ids and repeated rows stay rows. Further columns are ignored.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candela.llm.common import pick, stored
from candela.llm.spans import mix

BUCKETS = 1 << 15
ORDERS = 3
PER_LANGUAGE = 400
SAMPLE_ROWS = 20_000
SLICE = 1 << 20
PIECE = 1 << 18
SCALE = 20.0
_SPACE = 32


def _letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


class Grams:
    """Turns texts into hashed n-grams; made once in a task."""

    def __init__(self):
        self.letter = _letters()

    def clean(self, text: str | None) -> np.ndarray:
        """Code points of the text in normal form; empty if it has no letter."""
        point = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = self.letter[point]
        if not letter.any():
            return np.empty(0, np.uint32)
        point = np.where(letter, point, np.uint32(_SPACE))
        keep = letter.copy()
        keep[1:] |= letter[:-1]  # the first of a run of others
        return np.concatenate(([np.uint32(_SPACE)], point[keep], [np.uint32(_SPACE)])).astype(np.uint32)

    @staticmethod
    def features(point: np.ndarray) -> np.ndarray:
        """Bucket of every n-gram that starts in the text."""
        out, h = [], np.zeros(len(point), np.uint64)
        for n in range(ORDERS):
            h = h[: len(point) - n] * np.uint64(0x100000001B3) + point[n:].astype(np.uint64) + np.uint64(1)
            if not len(h):
                break
            out.append((mix(h + np.uint64(n)) % np.uint64(BUCKETS)).astype(np.int32))
        return np.concatenate(out) if out else np.empty(0, np.int32)

    def pieces(self, text: str | None):
        """Features of the whole text, in pieces of bounded size (grams across a cut count in the first)."""
        point = self.clean(text)
        for i in range(0, len(point), PIECE):
            part = point[i : i + PIECE + ORDERS - 1]
            got = self.features(part)
            if len(part) > PIECE:  # grams that start in the overlap belong to the next piece
                got = np.concatenate([x[:PIECE] for x in _by_order(got, len(part))])
            yield got


def _by_order(features: np.ndarray, n: int) -> list[np.ndarray]:
    """The features of each order of a piece of n characters."""
    sizes = [max(0, n - k) for k in range(ORDERS)]
    return np.split(features, np.cumsum(sizes)[:-1])


def document_frequencies(docs: DataFrame, text_col: str = "text") -> tuple[np.ndarray, int]:
    """How many of all documents hold each bucket, and how many there are."""

    def run(batches):
        grams, seen, n = Grams(), np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                present = np.zeros(BUCKETS, bool)
                for f in grams.pieces(text):
                    present[f] = True
                seen += present
                n += 1
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate((at, [-1])), pa.int64()), pa.array(np.concatenate((seen[at], [n])), pa.int64())], names=["bucket", "n"])

    rows = pick(docs, **{text_col: "string"}).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    got = rows.toArrow()  # one row for each bucket at most
    bucket, n = got.column("bucket").to_numpy(), got.column("n").to_numpy()
    df = np.zeros(BUCKETS, np.int64)
    df[bucket[bucket >= 0]] = n[bucket >= 0]
    return df, int(n[bucket < 0].sum())


def _counts(grams: Grams, text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and their relative frequencies."""
    total = np.zeros(BUCKETS, np.int64)
    for f in grams.pieces(text):
        total += np.bincount(f, minlength=BUCKETS)
    at = np.flatnonzero(total)
    return at, (total[at] / max(1, total.sum())).astype(np.float64)


def train(samples: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, classes: int, epochs: int = 5, alpha: float = 0.5, beta: float = 1.0,
          l1: float = 0.02, l2: float = 0.002, seed: int = 3) -> np.ndarray:
    """Weights (buckets x classes) by follow-the-regularised-leader. The gradients' sums z and squares n give the
    weights in closed form: zero where |z| <= l1, else shrunk by l1 and l2."""
    z, n = np.zeros((BUCKETS, classes)), np.zeros((BUCKETS, classes))

    def weights(at):
        zi, ni = z[at], n[at]
        return np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(ni)) / alpha + l2))

    r = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in r.permutation(len(samples)):
            at, x = samples[i]
            w = weights(at)
            p = _softmax(x @ w)
            p[y[i]] -= 1
            g = x[:, None] * p
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - sigma * w
            n[at] += g * g
    out = np.empty((BUCKETS, classes), np.float32)
    step = max(1, SLICE // max(1, classes))
    for i in range(0, BUCKETS, step):
        out[i : i + step] = weights(slice(i, i + step))
    return out


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature with the least log loss, by golden-section search over its logarithm; 1 without rows."""
    if not len(y):
        return 1.0

    def loss(t):
        return -np.log(_softmax(logits / np.exp(t))[np.arange(len(y)), y] + 1e-12).mean()

    a, b, q = -4.0, 4.0, (5**0.5 - 1) / 2
    for _ in range(60):
        c, d = b - q * (b - a), a + q * (b - a)
        a, b = (a, d) if loss(c) < loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", learn=None, per_language: int = PER_LANGUAGE,
        sample_rows: int = SAMPLE_ROWS) -> dict:
    """Model from the rows for whose id ``learn`` (id column -> condition) holds."""
    docs = pick(docs, **{id_col: "long", text_col: "string", lang_col: "string"}).toDF("id", "text", "lang")
    docs = docs.where("lang is not null")
    docs = docs.where(learn(F.col("id"))) if learn else docs
    sizes = stored(docs.groupBy("lang").count(), "languages")
    names = sorted(r["lang"] for r in sizes.collect())  # one for each class of the model
    if not names:
        return {"names": []}
    per_language = max(1, min(per_language, sample_rows // len(names)))
    df, n_docs = document_frequencies(docs, "text")
    # of each language the smallest hashes: a share that holds per_language rows with a margin, cut to them
    hashed = docs.withColumn("h", F.xxhash64("id", "text"))
    wanted = 2 * per_language + 50
    edges = sizes.select("lang", F.when(F.col("count") > wanted, (wanted / F.col("count") * 2.0**64 - 2.0**63).cast("long")).otherwise(F.lit((1 << 63) - 1)).alias("edge"))
    few = hashed.select("lang", "h").join(edges, "lang").where("h <= edge")
    own = Window.partitionBy("lang").orderBy("h")
    first = few.select("lang", "h").distinct().withColumn("k", F.row_number().over(own)).where(F.col("k") <= per_language).drop("k")
    if len(names) <= sample_rows:  # then sample_rows bounds the broadcast
        first = F.broadcast(first)
    chosen = hashed.join(first, ["lang", "h"]).dropDuplicates(["lang", "h"]).select("lang", "h", "text")

    def run(batches):
        grams, rows = Grams(), []
        for b in batches:
            for lang, h, text in zip(*(c.to_pylist() for c in b.columns)):
                at, tf = _counts(grams, text)
                if len(at):
                    rows.append((h, lang, at.astype(np.int32).tobytes(), tf.astype(np.float32).tobytes()))
        types = (pa.int64(), pa.string(), pa.binary(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], t) for j, t in enumerate(types)], names=["h", "lang", "at", "tf"])

    rows = chosen.mapInArrow(run, "h long, lang string, at binary, tf binary")
    idf = np.log((1 + n_docs) / (1 + df)) + 1

    def learn_all(batches):
        got = sorted(x for b in batches for x in zip(*(c.to_pylist() for c in b.columns)))
        data = [(np.frombuffer(a, np.int32), np.frombuffer(t, np.float32).astype(np.float64)) for _, _, a, t in got]
        data = [(a, _scaled(t * idf[a])) for a, t in data]
        place = {lang: i for i, lang in enumerate(names)}
        y = np.array([place[lang] for _, lang, _, _ in got], np.int64)
        kept = np.array([h % 5 == 0 for h, *_ in got], bool)
        w = train([data[i] for i in np.flatnonzero(~kept)], y[~kept], len(names))
        logit = np.array([x @ w[a] for (a, x), k in zip(data, kept) if k]).reshape(-1, len(names))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps((w, temperature(logit, y[kept])))], pa.binary())], names=["model"])

    w, t = pickle.loads(rows.repartition(1).mapInArrow(learn_all, "model binary").collect()[0].model)
    return {"names": names, "idf": idf.astype(np.float32), "weights": w, "temperature": t}


def _scaled(x: np.ndarray) -> np.ndarray:
    """TF-IDF values of one text as they enter the model: their sum is one, times a constant that keeps steps sizeable."""
    return SCALE * x / max(float(x.sum()), 1e-12)


def _weighted(table: np.ndarray, at: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Sum of the rows ``at`` of the table times ``share``; at most ``SLICE`` values are gathered at a time."""
    out, step = np.zeros(table.shape[1]), max(1, SLICE // table.shape[1])
    for i in range(0, len(at), step):
        out += share[i : i + step] @ table[at[i : i + step]].astype(np.float64)
    return out


def predict(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, lang_pred, score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        grams = Grams()
        table = np.concatenate((m["weights"] * m["idf"][:, None], m["idf"][:, None]), axis=1) if m["names"] else None
        for batch in batches:
            names, scores = [], []
            for text in batch.column(1).to_pylist():
                at, share = _counts(grams, text) if m["names"] else ((), ())
                if not len(at):
                    names.append("und")
                    scores.append(0.0)
                    continue
                total = _weighted(table, at, share)
                p = _softmax(SCALE * total[:-1] / max(float(total[-1]), 1e-12) / m["temperature"])
                names.append(m["names"][int(p.argmax())])
                scores.append(float(min(1.0, p.max())))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=[id_col, "lang_pred", "score"])

    return pick(docs, **{id_col: "long", text_col: "string"}).mapInArrow(run, f"{id_col} long, lang_pred string, score double")
