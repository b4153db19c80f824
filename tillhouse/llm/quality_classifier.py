"""Operator 1: quality classifier.

1. Random indexing over the whole corpus: every word gives two tokens, its
   lower-case letters and its shape (case, digits, punctuation kept), hashed
   into ``WORDS`` + ``SHAPES`` rows.  A token's index vector has two entries
   of +-1; its word vector is the sum of the index vectors of the words at
   most two places away, over all occurrences in all documents.  Each task
   sums in one fixed array, Spark adds the arrays; the sum has a fixed size.
2. A document is the mean of its word vectors and shape vectors, the mean of
   its index vectors, and four ratios of word counts.
3. A two-layer numpy network learns ``labels.quality`` from a bounded sample
   of ``sample_rows`` labelled documents (the smallest hashes of doc_id among
   rows whose crc32(doc_id as text) mod 5 is not 0).  A fifth of the sample
   sets the temperature that divides the network's logit.
4. Every whole text is scored in one scan.  No text is shuffled.

Defined results: null and empty texts have the zero vector and get the
network's score for it; without labels, or with one class only, every score is
the share of label 1 (0.5 without labels); a null doc_id is never held out and
never trains; repeated rows and labels each count; columns named like an
output are replaced, others pass through.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillhouse.llm.common import U, mix, with_arrow_columns
from tillhouse.llm.memo import make_room

WORDS, SHAPES, DIM, WINDOW = 8192, 1024, 64, 2
ROWS = WORDS + SHAPES
_LETTERS = re.compile(r"[^\w]+")
#: Index vectors: two places and signs for each row of the token table.
_H = mix(np.arange(1, ROWS + 1, dtype=np.uint64))
PLACES = np.stack([(_H % U(DIM)), ((_H >> U(20)) % U(DIM))]).astype(np.int64)
SIGNS = np.stack([((_H >> U(40)) & U(1)), ((_H >> U(41)) & U(1))]).astype(np.float32) * 2 - 1
INDEX = np.zeros((ROWS, DIM), np.float32)
for _p, _s in zip(PLACES, SIGNS):
    np.add.at(INDEX, (np.arange(ROWS), _p), _s)


def _shape(word: str) -> str:
    out: list[str] = []
    for c in word:
        k = "A" if c.isupper() else "a" if c.isalpha() else "9" if c.isdigit() else c
        if len(out) < 6 and not (out and out[-1] == k and k in "Aa9"):
            out.append(k)
    return "".join(out)


class _Memo(dict):
    """Both rows of each word seen, as one number: the word's times SHAPES, and the shape's."""

    def __missing__(self, word: bytes) -> int:
        w = word.decode("utf-8", "replace")
        core = _LETTERS.sub("", w.lower())
        code = self[word] = xxhash.xxh3_64_intdigest(core) % WORDS * SHAPES + xxhash.xxh3_64_intdigest(_shape(w)) % SHAPES
        return code


_MEMO = _Memo()


def token_rows(text: str | None) -> np.ndarray:
    """Rows of the words' tokens and of their shapes: an array of shape (2, words)."""
    words = (text or "").encode("utf-8", "surrogatepass").split()
    if len(_MEMO) > 400_000:
        _MEMO.clear()
    codes = np.fromiter(map(_MEMO.__getitem__, words), np.int64, len(words))
    return np.stack([codes // SHAPES, WORDS + codes % SHAPES])


def word_vectors(docs: DataFrame, text: str = "text") -> np.ndarray:
    """The ROWS x DIM word vectors of all documents (unit length, centred)."""
    def add(total: np.ndarray, held: list[np.ndarray]) -> None:
        tokens = np.concatenate(held, axis=1)
        owner = np.repeat(np.arange(len(held)), [h.shape[1] for h in held])
        for gap in range(1, WINDOW + 1):
            same = owner[gap:] == owner[:-gap]
            left, right = tokens[:, :-gap][:, same], tokens[:, gap:][:, same]
            for to, of in ((left, right), (right, left)):
                for a in to:
                    for b in of:
                        for p, s in zip(PLACES, SIGNS):
                            total += np.bincount(a * DIM + p[b], s[b], ROWS * DIM)

    def work(batches):
        make_room("quality_classifier", _MEMO.clear)
        total, held, words = np.zeros(ROWS * DIM, np.float64), [], 0
        for batch in batches:
            for t in batch.column(0).to_pylist():
                held.append(token_rows(t))
                words += held[-1].shape[1]
                if words > 400_000:
                    add(total, held)
                    held, words = [], 0
        if words:
            add(total, held)
        grid = total.reshape(ROWS, DIM)
        used = np.nonzero(np.abs(grid).sum(1))[0]
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(list(grid[used].astype(np.float32)), pa.list_(pa.float32()))],
                                         names=["row", "v"])

    parts = docs.select(F.col(text).alias("text")).mapInArrow(work, "row int, v array<float>")
    sums = parts.groupBy("row").agg(F.array(*[F.sum(F.col("v")[i]) for i in range(DIM)]).alias("v"))
    out = np.zeros((ROWS, DIM), np.float32)
    for r in sums.collect():  # ROWS rows at most, whatever the corpus
        out[r["row"]] = r["v"]
    out = np.sign(out) * np.log1p(np.abs(out))
    out /= np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)
    used = np.abs(out).sum(1) > 0
    if used.any():
        out[used] -= out[used].mean(0)
    return out


def pooled(texts: list[str | None], vectors: np.ndarray) -> np.ndarray:
    """Document vectors: pooled word, shape and index vectors and four ratios."""
    make_room("quality_classifier", _MEMO.clear)
    out = np.zeros((len(texts), 4 * DIM + 4), np.float32)
    for i, t in enumerate(texts):
        tokens = token_rows(t)
        if n := tokens.shape[1]:
            x = out[i]
            for k, rows in enumerate(tokens):
                ids, times = np.unique(rows, return_counts=True)
                share = (times / n).astype(np.float32)
                x[k * DIM:(k + 1) * DIM] = share @ vectors[ids]
                x[(2 + k) * DIM:(3 + k) * DIM] = share @ INDEX[ids]
                x[4 * DIM + k] = len(ids) / n ** 0.7
            x[4 * DIM + 2] = np.log1p(n) / 10
            x[4 * DIM + 3] = (tokens[0][1:] == tokens[0][:-1]).mean() if n > 1 else 0
    return out


class Network:
    """Inputs -> 32 tanh -> logit, trained by Adam; probabilities are sigmoid(logit / temperature)."""

    def __init__(self, x: np.ndarray, y: np.ndarray, hidden: int = 32, epochs: int = 60, seed: int = 7):
        self.constant = None
        if len(y) < 10 or y.min() == y.max():
            self.constant = float(y.mean()) if len(y) else 0.5
            return
        rng = np.random.default_rng(seed)
        order = rng.permutation(len(y))
        hold, fit = order[:len(y) // 5], order[len(y) // 5:]
        self.mean, self.scale = x[fit].mean(0), x[fit].std(0) + 1e-3
        z = (x - self.mean) / self.scale
        p = [rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], hidden)), np.zeros(hidden),
             rng.normal(0, 1 / np.sqrt(hidden), hidden), np.zeros(1)]
        m, v, step = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
        for _ in range(epochs):
            rng.shuffle(fit)
            for at in range(0, len(fit), 64):
                b = fit[at:at + 64]
                h = np.tanh(z[b] @ p[0] + p[1])
                g = 1 / (1 + np.exp(-(h @ p[2] + p[3]))) - y[b]
                back = np.outer(g, p[2]) * (1 - h * h)
                step += 1
                for k, d in enumerate((z[b].T @ back, back.sum(0), h.T @ g, np.array([g.sum()]))):
                    d = d / len(b) + 1e-3 * p[k]
                    m[k] = 0.9 * m[k] + 0.1 * d
                    v[k] = 0.999 * v[k] + 0.001 * d * d
                    p[k] = p[k] - 3e-3 * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
        self.p, self.temperature = p, 1.0
        logit = self.logits(x[hold])
        grid = np.exp(np.linspace(np.log(0.25), np.log(8), 60))
        loss = [np.mean(np.logaddexp(0, logit / t) - y[hold] * logit / t) for t in grid] if len(hold) else [0]
        self.temperature = float(grid[int(np.argmin(loss))])

    def logits(self, x: np.ndarray) -> np.ndarray:
        h = np.tanh((x - self.mean) / self.scale @ self.p[0] + self.p[1])
        return h @ self.p[2] + self.p[3]

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def held_out(doc_id):
    crc = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    return F.coalesce(crc % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, vectors: np.ndarray, sample_rows: int = 6000, doc_id: str = "doc_id",
          text: str = "text") -> Network:
    """The network, from at most ``sample_rows`` labels that are not held out."""
    few = (labels.where(F.col(doc_id).isNotNull() & F.col("quality").isNotNull() & ~held_out(doc_id))
                 .select(F.col(doc_id).alias("doc_id"), F.col("quality").cast("int").alias("quality"))
                 .orderBy(F.xxhash64("doc_id"), "quality").limit(sample_rows))
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows = texts.join(F.broadcast(few), "doc_id").select("quality", "text", "doc_id")
    got = (with_arrow_columns(rows, [T.StructField("x", T.ArrayType(T.FloatType()))], "text",
                              lambda ts: [list(pooled(ts, vectors))])
           .drop("text").orderBy("doc_id", "quality").limit(4 * sample_rows).collect())
    x = np.array([r["x"] for r in got], np.float32).reshape(-1, 4 * DIM + 4)
    return Network(x, np.array([r["quality"] for r in got], np.float64))


def quality_scores(docs: DataFrame, labels: DataFrame, corpus: DataFrame | None = None, threshold: float = 0.3,
                   sample_rows: int = 6000, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` plus held_out, score and predicted.  ``corpus``: the documents
    that word vectors and labels' texts come from (``docs`` unless given)."""
    corpus = docs if corpus is None else corpus
    sc = docs.sparkSession.sparkContext
    vectors = word_vectors(corpus, text)
    model = sc.broadcast((vectors, train(corpus, labels, vectors, sample_rows, doc_id, text)))

    def make(texts):
        vectors, network = model.value
        return [network.score(pooled(texts, vectors)).astype(np.float64)]

    scored = with_arrow_columns(docs.drop("held_out", "predicted"), [T.StructField("score", T.DoubleType())], text, make)
    return scored.withColumn("held_out", held_out(doc_id)).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int"))
