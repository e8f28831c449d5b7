"""Toxicity: a bidirectional gated recurrent network with attention pooling, trained in numpy.

Input of a position: an embedding of the word and the mean of embeddings of its character trigrams (hashed).
Words in fewer than ``MIN_DOCUMENTS`` documents of the sample, and those beyond the ``WORD_ROWS`` most frequent, share
one embedding, so that the network cannot learn texts by their rare words. Two gated recurrent passes (one in each
direction), attention over the positions, one logit. A text is cut into overlapping windows that cover it whole; its
logit is that of its most toxic window, mapped to a probability by a scale and shift fitted on the training documents.

Training. Labels belong to documents, so the windows to learn from are found in turns: a positive document gives
the window that scores highest so far (at first by the words' log odds in the sample), a negative one its hardest
windows. The sample is bounded: ``max_toxic`` and ``max_clean`` labelled documents, those with the smallest hash of id
and text. Training runs in one task over that sample and returns the weights, a few hundred kB.

Scoring goes through whole texts in tasks; weights are broadcast (their size is fixed by the constants here).

Normal form: A-Z lower-cased; words are runs of digits, letters and characters outside ASCII.

Defined cases. Null text or one without words: the score of a window without words, which is the lowest (logit
``EMPTY``). Null labels or ids and labels without a document take no part in training; a document with several
labels counts as toxic if any says so. A sample without both classes: every score is the share of toxic labels in
it (0 if there are none). Null ids and repeated rows stay rows. Further columns are ignored (``score``) or kept
(``drop_toxic``).
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.llm.common import pick, release, replace_column, stored, texts_of
from candela.llm.decontaminate import NORMAL
from candela.llm.spans import WHITE, Spans, mix

WORD_ROWS, CHAR_ROWS, WORD_DIM, CHAR_DIM, HIDDEN = 1 << 13, 1 << 12, 8, 8, 8
WINDOW, STRIDE = 32, 16
MAX_TOXIC, MAX_CLEAN = 600, 2400
MIN_DOCUMENTS = 3
EMPTY = -12.0
BATCH_BYTES = 2 << 20
THRESHOLD = 0.3


class Words:
    """Distinct words of some texts with their inputs, and the texts as numbers of them. ``known``: hashes of the
    words that have an embedding of their own, sorted."""

    def __init__(self, texts: list[bytes], known: np.ndarray):
        spans = Spans([t.translate(NORMAL) for t in texts], WHITE)
        self.first = spans.first
        self.hash, at, self.code = np.unique(spans.hashes(), return_index=True, return_inverse=True)
        size = spans.ends[at] - spans.starts[at]
        self.n_tri = size + 1  # the word between two marks, and its last two bytes with the mark
        stop = np.cumsum(self.n_tri)
        self.tri_at = stop - self.n_tri
        offset = np.arange(int(self.n_tri.sum())) - np.repeat(self.tri_at - spans.starts[at], self.n_tri)
        byte = np.concatenate(([np.uint8(32)], spans.buf, [np.uint8(32)])).astype(np.uint64)  # marks at the ends of the texts
        last = np.minimum(offset + 2, np.repeat(spans.ends[at] + 1, self.n_tri))
        gram = np.where(byte == 10, np.uint64(32), byte)
        self.tri = (mix((gram[offset] | gram[offset + 1] << np.uint64(8) | gram[last] << np.uint64(16)) + np.uint64(1)) % np.uint64(CHAR_ROWS)).astype(np.int64)
        self.know(known)

    def know(self, known: np.ndarray) -> None:
        """Rows of the word embeddings; 0 for words without one of their own."""
        self.row = np.zeros(len(self.hash), np.int64)
        if len(known):
            at = np.minimum(np.searchsorted(known, self.hash), len(known) - 1)
            self.row = np.where(known[at] == self.hash, at + 1, 0)

    def document_count(self) -> np.ndarray:
        """How many texts hold each word."""
        doc = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))
        pair = np.unique(doc * np.int64(max(1, len(self.hash))) + self.code)
        return np.bincount(pair % max(1, len(self.hash)), minlength=len(self.hash))

    def grams(self, use: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Trigram rows of the words ``use`` one after the other, and where each word's begin."""
        n = self.n_tri[use]
        at = np.cumsum(n) - n
        return self.tri[np.arange(int(n.sum())) + np.repeat(self.tri_at[use] - at, n)], at

    def vectors(self, p: dict, use: np.ndarray) -> np.ndarray:
        """Input vectors of the words ``use``."""
        tri, at = self.grams(use)
        chars = np.add.reduceat(p["char"][tri], at, axis=0) / self.n_tri[use][:, None].astype(np.float32) if len(use) else np.zeros((0, CHAR_DIM), np.float32)
        return np.concatenate((p["word"][self.row[use]], chars), axis=1)

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """(text, numbers of distinct words at the window's positions, -1 beyond the text); all words are covered."""
        text, begin, stop = [], [], []
        for t in range(len(self.first) - 1):
            a, b = int(self.first[t]), int(self.first[t + 1])
            if b > a:
                starts = np.arange(a, max(a + 1, b - WINDOW + STRIDE), STRIDE)
                text.append(np.full(len(starts), t))
                begin.append(starts)
                stop.append(np.full(len(starts), b))
        if not text:
            return np.empty(0, np.int64), np.empty((0, WINDOW), np.int64)
        at = np.concatenate(begin)[:, None] + np.arange(WINDOW)
        inside = at < np.concatenate(stop)[:, None]
        return np.concatenate(text), np.where(inside, self.code[np.minimum(at, len(self.code) - 1)], -1)


def new_weights(seed: int = 7) -> dict[str, np.ndarray]:
    r, d = np.random.default_rng(seed), WORD_DIM + CHAR_DIM
    p = {"word": r.normal(0, 0.1, (WORD_ROWS + 1, WORD_DIM)), "char": r.normal(0, 0.1, (CHAR_ROWS, CHAR_DIM))}
    for side in "fb":
        p[f"W{side}"] = r.normal(0, d**-0.5, (d, 3 * HIDDEN))
        p[f"U{side}"] = r.normal(0, HIDDEN**-0.5, (HIDDEN, 3 * HIDDEN))
        p[f"c{side}"] = np.zeros(3 * HIDDEN)
    p |= {"att": r.normal(0, 0.3, (2 * HIDDEN, HIDDEN)), "att_v": r.normal(0, 0.3, HIDDEN), "out": r.normal(0, 0.3, 2 * HIDDEN), "bias": np.zeros(1)}
    return {k: v.astype(np.float32) for k, v in p.items()}


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + np.float32(0.5)


def _pass(x: np.ndarray, mask: np.ndarray, U: np.ndarray, keep: list | None) -> np.ndarray:
    """Gated recurrent pass over x (time, batch, 3 hidden: update, reset, candidate); where the mask is 0 the state stays."""
    h = np.zeros((x.shape[1], HIDDEN), np.float32)
    states = np.empty((len(x), x.shape[1], HIDDEN), np.float32)
    for t in range(len(x)):
        gate = _sigmoid(x[t, :, : 2 * HIDDEN] + h @ U[:, : 2 * HIDDEN])
        z, r = gate[:, :HIDDEN], gate[:, HIDDEN:]
        c = np.tanh(x[t, :, 2 * HIDDEN :] + (r * h) @ U[:, 2 * HIDDEN :])
        m = mask[t][:, None]
        new = h + m * z * (c - h)
        if keep is not None:
            keep.append((h, z, r, c, m))
        states[t] = h = new
    return states


def _pool(p: dict, states: np.ndarray, mask: np.ndarray):
    """Attention pooling: logit, and what the gradient needs."""
    a = np.tanh(states @ p["att"])
    e = np.where(mask > 0, a @ p["att_v"], np.float32(-1e9))
    w = np.exp(e - e.max(axis=0))
    w /= w.sum(axis=0)
    pooled = (w[:, :, None] * states).sum(axis=0)
    return pooled @ p["out"] + p["bias"][0], a, w, pooled


def _inputs(windows: np.ndarray):
    """Word numbers by time and window, and where there is a word."""
    return np.maximum(windows, 0).T, (windows >= 0).T.astype(np.float32)


def logits(p: dict, words: Words, windows: np.ndarray, batch: int = 4096) -> np.ndarray:
    """Logit of every window."""
    vectors = words.vectors(p, np.arange(len(words.hash)))
    table = {s: vectors @ p[f"W{s}"] + p[f"c{s}"] for s in "fb"}
    out = np.empty(len(windows), np.float32)
    for i in range(0, len(windows), batch):
        safe, mask = _inputs(windows[i : i + batch])
        forward = _pass(table["f"][safe], mask, p["Uf"], None)
        backward = _pass(table["b"][safe[::-1]], mask[::-1], p["Ub"], None)[::-1]
        out[i : i + batch] = _pool(p, np.concatenate((forward, backward), axis=2), mask)[0]
    return out


def gradient(p: dict, words: Words, windows: np.ndarray, y: np.ndarray, weight: np.ndarray, drop: np.ndarray):
    """Loss (weighted cross-entropy) and gradient of all weights. ``drop``: factors of the input vectors (time, window)."""
    safe, mask = _inputs(windows)
    use, local = np.unique(safe, return_inverse=True)
    local = local.reshape(safe.shape)
    vectors = words.vectors(p, use)
    x = vectors[local] * drop[:, :, None]
    keep: dict[str, list] = {"f": [], "b": []}
    forward = _pass(x @ p["Wf"] + p["cf"], mask, p["Uf"], keep["f"])
    backward = _pass(x[::-1] @ p["Wb"] + p["cb"], mask[::-1], p["Ub"], keep["b"])[::-1]
    states = np.concatenate((forward, backward), axis=2)
    logit, a, w, pooled = _pool(p, states, mask)
    prob = 1 / (1 + np.exp(-logit))
    loss = -(weight * np.where(y > 0, np.log(prob + 1e-9), np.log(1 - prob + 1e-9))).sum() / weight.sum()
    d = (weight * (prob - y) / weight.sum()).astype(np.float32)
    g = {"out": pooled.T @ d, "bias": np.array([d.sum()], np.float32)}
    d_pooled = d[:, None] * p["out"]
    d_w = (states * d_pooled).sum(axis=2)
    d_e = w * (d_w - (w * d_w).sum(axis=0))
    d_a = d_e[:, :, None] * p["att_v"] * (1 - a * a)
    g["att_v"] = np.einsum("tb,tbh->h", d_e, a)
    g["att"] = np.einsum("tbs,tbh->sh", states, d_a)
    d_states = w[:, :, None] * d_pooled + d_a @ p["att"].T
    d_x = np.zeros_like(x)
    for side in "fb":
        flip = side == "b"
        own = d_states[:, :, HIDDEN:][::-1] if flip else d_states[:, :, :HIDDEN]
        xs = x[::-1] if flip else x
        U, W = p[f"U{side}"], p[f"W{side}"]
        g_u, g_in, back = np.zeros_like(U), np.empty((*xs.shape[:2], 3 * HIDDEN), np.float32), np.zeros((xs.shape[1], HIDDEN), np.float32)
        for t in reversed(range(len(xs))):
            h, z, r, c, m = keep[side][t]
            back = back + own[t]
            d_new = back * m
            d_c = d_new * z * (1 - c * c)
            d_rh = d_c @ U[:, 2 * HIDDEN :].T
            d_gate = np.concatenate((d_new * (c - h) * z * (1 - z), d_rh * h * r * (1 - r)), axis=1)
            g_u[:, : 2 * HIDDEN] += h.T @ d_gate
            g_u[:, 2 * HIDDEN :] += (r * h).T @ d_c
            g_in[t] = np.concatenate((d_gate, d_c), axis=1)
            back = back - d_new * z + d_rh * r + d_gate @ U[:, : 2 * HIDDEN].T
        g[f"U{side}"], g[f"c{side}"] = g_u, g_in.sum(axis=(0, 1))
        g[f"W{side}"] = np.einsum("tbd,tbh->dh", xs, g_in)
        part = g_in @ W.T
        d_x += part[::-1] if flip else part
    d_x *= (mask * drop)[:, :, None]
    d_vec = np.zeros_like(vectors)
    np.add.at(d_vec, local.ravel(), d_x.reshape(-1, d_x.shape[2]))
    g["word"], g["char"] = np.zeros_like(p["word"]), np.zeros_like(p["char"])
    np.add.at(g["word"], words.row[use], d_vec[:, :WORD_DIM])
    n = words.n_tri[use]
    np.add.at(g["char"], words.grams(use)[0], np.repeat(d_vec[:, WORD_DIM:] / n[:, None].astype(np.float32), n, axis=0))
    return loss, g


def _best(score: np.ndarray, text: np.ndarray, count: int, most: int) -> np.ndarray:
    """Numbers of the ``most`` highest windows of each text."""
    order = np.lexsort((-score, text))
    first = np.searchsorted(text[order], np.arange(count))
    rank = np.arange(len(order)) - first[text[order]]
    return order[rank < most]


def _log_odds(words: Words, y: np.ndarray) -> np.ndarray:
    """Log odds of each word by the documents of each class that hold it; 0 for rare words."""
    doc = np.repeat(np.arange(len(y)), np.diff(words.first))
    pair = np.unique(doc * np.int64(len(words.hash)) + words.code)
    doc, word = pair // len(words.hash), pair % len(words.hash)
    pos = np.bincount(word[y[doc] > 0], minlength=len(words.hash))
    neg = np.bincount(word[y[doc] == 0], minlength=len(words.hash))
    n_pos, n_neg = max(1, int((y > 0).sum())), max(1, int((y == 0).sum()))
    odds = np.log((pos + 0.5) / (n_pos + 1)) - np.log((neg + 0.5) / (n_neg + 1))
    return np.where(pos + neg >= MIN_DOCUMENTS, odds, 0.0)


def train(texts: list[bytes], y: np.ndarray, rounds: int = 3, steps: int = 60, batch: int = 256, rate: float = 0.02, seed: int = 7,
          share: float | None = None) -> dict:
    """Weights for texts with labels 0/1, with ``scale`` and ``shift`` of a text's probability. ``share``: share of label 1
    where the texts come from, if the sample's own is not it."""
    if not len(y) or y.min() == y.max():
        return {"constant": float(y.mean()) if len(y) else 0.0}
    r, p, words = np.random.default_rng(seed), new_weights(seed), Words(texts, np.empty(0, np.uint64))
    text, windows = words.windows()
    if not len(text):
        return {"constant": float(y.mean())}
    n_docs = words.document_count()
    often = np.lexsort((words.hash, -n_docs))[:WORD_ROWS]
    known = np.sort(words.hash[often[n_docs[often] >= MIN_DOCUMENTS]])
    words.know(known)
    odds = np.where(windows >= 0, _log_odds(words, y)[np.maximum(windows, 0)], -9.0)
    score = score_of = odds.max(axis=1)
    m, v, step = {k: np.zeros_like(x) for k, x in p.items()}, {k: np.zeros_like(x) for k, x in p.items()}, 0
    for turn in range(rounds):
        pos = _best(np.where(y[text] > 0, score, -99), text, len(y), 1)
        pos = pos[(y[text[pos]] > 0) & (score[pos] > np.quantile(score[y[text] == 0], 0.9))]  # windows like any other teach nothing
        hard = _best(score, text, len(y), 3)
        hard = hard[y[text[hard]] == 0]
        easy = np.flatnonzero(y[text] == 0)
        if not len(pos) or not len(hard):
            break
        for _ in range(steps):
            pick_ = np.concatenate((r.choice(pos, batch // 4), r.choice(hard, batch // 2), r.choice(easy, batch // 4)))
            learnt = windows[pick_]
            # a positive window keeps its most telling word and gets half its other words from a negative one, so that
            # the network learns the word and not the text around it
            k = batch // 4
            other = windows[r.choice(easy, k)]
            swap = (r.random((k, WINDOW)) < 0.5) & (odds[pick_[:k]] < score_of[pick_[:k]][:, None]) & (learnt[:k] >= 0) & (other >= 0)
            learnt[:k] = np.where(swap, other, learnt[:k])
            drop = (r.random((WINDOW, len(pick_))) >= 0.15).astype(np.float32) / np.float32(0.85)
            _, g = gradient(p, words, learnt, (y[text[pick_]] > 0).astype(np.float32), np.ones(len(pick_), np.float32), drop)
            step += 1
            lr = rate * 0.5**turn
            for k in p:
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                v[k] = 0.98 * v[k] + 0.02 * g[k] * g[k]
                p[k] = (p[k] - lr * (m[k] / (1 - 0.9**step) / (np.sqrt(v[k] / (1 - 0.98**step)) + 1e-7) + 1e-2 * p[k])).astype(np.float32)
        score = logits(p, words, windows)
    best = np.full(len(y), EMPTY, np.float64)
    np.maximum.at(best, text, score)
    scale, shift = _platt(best, y)
    if share is not None and 0 < share < 1:
        shift += float(np.log(share / (1 - share)) - np.log(y.mean() / (1 - y.mean())))
    return p | {"known": known, "scale": scale, "shift": shift}


def _platt(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Scale and shift of a logistic fit, by Newton steps; smoothed targets keep it finite."""
    target = np.where(y > 0, ((y > 0).sum() + 1) / ((y > 0).sum() + 2), 1 / ((y == 0).sum() + 2))
    w = np.array([0.5, 0.0])
    X = np.stack([x, np.ones_like(x)], axis=1)
    for _ in range(50):
        q = 1 / (1 + np.exp(-np.clip(X @ w, -30, 30)))
        H = (X * (q * (1 - q))[:, None]).T @ X + 1e-3 * np.eye(2)
        w = w - np.clip(np.linalg.solve(H, X.T @ (q - target) + 1e-3 * w * np.array([1, 0])), -2, 2)
    return float(max(w[0], 1e-3)), float(w[1])


def text_scores(p: dict, texts: list[bytes]) -> np.ndarray:
    """Probability of each text."""
    if "constant" in p:
        return np.full(len(texts), p["constant"])
    words = Words(texts, p["known"])
    text, windows = words.windows()
    best = np.full(len(texts), EMPTY, np.float64)
    if len(text):
        np.maximum.at(best, text, logits(p, words, windows))
    return 1 / (1 + np.exp(-np.clip(p["scale"] * best + p["shift"], -30, 30)))


def sample(docs: DataFrame, labels: DataFrame, max_toxic: int = MAX_TOXIC, max_clean: int = MAX_CLEAN) -> tuple[DataFrame, float | None]:
    """Rows (h, y, text) to learn from, of documents (id, text) and labels (id, y), and the share of label 1 among all
    distinct labelled rows."""
    labels = labels.groupBy("id").agg(F.max((F.col("y") != 0).cast("int")).alias("y"))
    hashed = docs.withColumn("h", F.xxhash64("id", "text"))
    # hashes only: of each class the smallest, however many texts an id has; labels without a document use up no place
    rows = stored(hashed.select("id", "h").distinct().join(labels, "id"), "labelled")
    few = None
    for y, most in ((0, max_clean), (1, max_toxic)):  # a bounded sort, no shuffle of a whole class
        part = rows.where(F.col("y") == y).orderBy("h", "id").limit(most)
        few = part if few is None else few.unionByName(part)
    # at most max_toxic + max_clean rows: a proven bound for the broadcast
    return hashed.join(F.broadcast(few), ["id", "h"]).dropDuplicates(["id", "h"]).select("h", "y", "text"), rows.agg(F.avg("y")).first()[0]


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", learn=None,
        max_toxic: int = MAX_TOXIC, max_clean: int = MAX_CLEAN) -> dict:
    """Weights learnt from the labelled rows for whose id ``learn`` (id column -> condition) holds."""
    labels = pick(labels, **{id_col: "long", label_col: "int"}).toDF("id", "y").dropna()
    labels = labels.where(learn(F.col("id"))) if learn else labels
    rows, share = sample(pick(docs, **{id_col: "long", text_col: "string"}).toDF("id", "text"), labels, max_toxic, max_clean)

    def run(batches):
        rows = [x for b in batches for x in zip(b.column("h").to_pylist(), b.column("y").to_pylist(), texts_of(b.column("text")))]
        rows.sort()
        weights = train([t for _, _, t in rows], np.array([y for _, y, _ in rows], np.int64), share=share)
        del rows
        release()
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(weights)], pa.binary())], names=["weights"])

    got = rows.repartition(1).mapInArrow(run, "weights binary").collect()
    return pickle.loads(got[0].weights) if got else {"constant": 0.0}


def _grouped(texts: list[bytes]):
    """(first, last) of runs of texts of bounded size."""
    at, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t) + 1
        if size >= BATCH_BYTES:
            yield at, i + 1
            at, size = i + 1, 0
    if at < len(texts):
        yield at, len(texts)


def score(docs: DataFrame, weights: dict, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Per row: id, score, predicted (1 if the score reaches the threshold)."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches):
        for batch in batches:
            texts = texts_of(batch.column(1))
            for a, b in _grouped(texts):
                s = text_scores(shared.value, texts[a:b])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(s, pa.float64()), pa.array((s >= threshold).astype(np.int32))], names=[id_col, "score", "predicted"])
            release()

    return pick(docs, **{id_col: "long", text_col: "string"}).mapInArrow(run, f"{id_col} long, score double, predicted int")


def drop_toxic(docs: DataFrame, weights: dict, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with all columns, without the rows whose score reaches the threshold."""
    place = replace_column(docs.columns, text_col)
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches):
        for batch in batches:
            texts = texts_of(batch.column(place))
            for a, b in _grouped(texts):
                keep = text_scores(shared.value, texts[a:b]) < threshold
                yield batch.slice(a, b - a).filter(pa.array(keep))
            release()

    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)
