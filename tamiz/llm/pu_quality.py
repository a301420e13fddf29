"""Quality classifier: positive-unlabelled learning with the non-negative unbiased risk.

Trusted positives and unlabelled text are all that is learned from; no document is taken as a
negative. The share of positives in the unlabelled text is estimated first. With the logistic
loss the unbiased risk ``E_u[l(-g)] - prior * E_p[g]`` is convex in a linear score ``g``, so Newton
steps minimise it, each one pass over a table of features; a step after which the part of the
negatives, ``E_u[l(-g)] - prior * E_p[l(-g)]``, is below zero is taken back as the method asks.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, FloatType, StructField, StructType

from tamiz.llm.common import append_columns, fold, stored
from tamiz.llm.quality_rules import SYMBOLS, repeated_words

RIDGE = 0.1
MAX_STEPS = 25
BINS = 2000
ODD = re.compile(rb"[^0-9A-Za-z.,;:!?'\"()\x80-\xff-]")
WHITE = b" \t\n\r\v\f"
EDGES = b".,;:!?'\"()-"


def _changed(text: str, other: str) -> int:
    """Characters of a text that differ from their own lower case; ``other`` is the whole text in lower case."""
    if len(text) != len(other):  # some character has a lower case of two
        return sum(c != c.lower() for c in text)
    a, b = (np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) for t in (text, other))
    return int(np.count_nonzero(a != b))


def features(text: str | None) -> list[float]:
    """Shares that describe the form of a text, each between 0 and about 1; zeros for an empty one."""
    text = text or ""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    n = len(words)
    if not n:
        return [0.0] * N_FEATURES
    count = Counter(words)
    most = count.most_common(1)[0][1]
    lines = [line for line in text.split("\n") if line.strip()]
    runs = sum(a == b for a, b in zip(words, words[1:]))
    lower = len(text) - sum(map(text.count, " \n\t"))
    upper = _changed(text, text.lower())
    shouted = sum(map(str.isupper, text.split())) if upper else 0
    odd = sum(c for w, c in count.items() if ODD.search(w)) if ODD.search(data.translate(None, WHITE)) else 0
    ends = sum(w[-1] in EDGES for w in words)
    symbols = sum(map(text.count, SYMBOLS))
    digits = sum(data.count(c) for c in b"0123456789")
    shares = [
        min(1.0, symbols / n), shouted / n, odd / n, most / n if n > 3 else 0.0, runs / n,
        repeated_words(words) / n, 1 - len(set(lines)) / max(1, len(lines)), min(1.0, text.count("|") / n),
        min(1.0, text.count("!") / n), digits / max(1, lower), upper / max(1, lower), ends / n,
        sum(len(line.split()) < 3 for line in lines) / max(1, len(lines)), min(1.0, text.count("http") / n),
        min(1.0, sum(map(text.count, "{}[]=/\\_~^@")) / n)]
    shape = [
        math.log1p(n) / 10, min(2.0, len(data) / n / 10), math.log(1 + len(count)) / math.log(1 + n),
        min(1.0, math.log1p(n / max(1, len(lines))) / 10), min(1.0, max(map(len, count)) / 50),
        min(1.0, sum(map(text.count, ".!?")) * 5 / n), min(1.0, text.count(",") * 10 / n),
        1 - len(text) / len(data), float(n < 20)]
    return [*shares, *(math.sqrt(s) for s in shares), *(float(s > 0.02) for s in shares), *shape]


N_FEATURES = 3 * 15 + 9


def _table(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, held_out) -> DataFrame:
    """doc_id, held_out, trusted, x: features of every document; trusted marks positives that may be learned from."""
    fields = StructType([StructField("x", ArrayType(FloatType()))])
    kept = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), held_out.alias("held_out"))
    described = append_columns(kept, "text", fields, lambda texts: [[features(t) for t in texts]]).drop("text")
    good = (labels.filter(~held_out).groupBy("doc_id").agg(F.min("quality").alias("q")).filter("q = 1")
            .select(F.col("doc_id").alias("good")))
    return stored(described.join(good, F.col("doc_id") == F.col("good"), "left").select(
        "doc_id", "held_out", F.col("good").isNotNull().alias("trusted"), "x"), "features")


def _sums(table: DataFrame, compute) -> np.ndarray:
    """Sum over all tasks of the vector that ``compute`` makes of a batch (matrix, trusted).

    A task sends its vector once, entry by entry, and entries are added by groups, so neither the
    driver nor a single task gets a vector from every task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = compute(_matrix(batch.column("x")), batch.column("trusted").to_numpy(zero_copy_only=False))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)],
                                             names=["i", "v"])

    rows = table.select("x", "trusted").mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(len(rows))
    for row in rows:
        out[row["i"]] = row["v"]
    return out


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    return np.hstack([values, np.ones((len(values), 1))])


def _expit(g: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(g / 2))


def _softplus(g: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, g)


def _newton(table: DataFrame, n_u: float, n_p: float, prior: float, mean: np.ndarray, scale: np.ndarray,
            mode: str) -> np.ndarray:
    """Weights over standardised features and a constant.

    ``mode`` "pu" minimises the non-negative risk; "discriminate" tells positives from unlabelled text.
    """
    d = len(mean)
    w = np.zeros(d)
    upper = np.triu_indices(d)
    ridge = np.full(d, RIDGE)
    ridge[-1] = 1e-6
    step = np.zeros(d)

    def at(w: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        def compute(x: np.ndarray, trusted: np.ndarray) -> np.ndarray:
            x = (x - mean) / scale
            g = x @ w
            s = _expit(g)
            p = trusted.astype(np.float64) / n_p
            if mode == "pu":
                slope, curve = s / n_u - prior * p, s * (1 - s) / n_u
            else:
                slope, curve = s / n_u - (1 - s) * p, s * (1 - s) * (1 / n_u + p)
            rest = _softplus(g) @ (1 / n_u - prior * p)
            hessian = (x * curve[:, None]).T @ x
            return np.concatenate([[rest], x.T @ slope, hessian[upper]])

        sums = _sums(table, compute)
        hessian = np.zeros((d, d))
        hessian[upper] = sums[1 + d:]
        hessian = hessian + np.triu(hessian, 1).T + np.diag(ridge)
        return sums[1:1 + d] + ridge * w, hessian, float(sums[0])

    for _ in range(MAX_STEPS):
        gradient, hessian, rest = at(w)
        if mode == "pu" and rest < 0 and step.any():
            w, step = w - step / 2, step / 2
            if np.abs(step).max() < 1e-3:
                break
            continue
        step = -np.linalg.solve(hessian, gradient)
        step *= min(1.0, 4.0 / max(np.abs(step).max(), 1e-12))
        w = w + step
        if np.abs(step).max() < 1e-3:
            break
    return w


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray, n_p: float, n_u: float) -> float:
    """Share of positives among the unlabelled, from histograms of a score over both, lowest bin first.

    Above a cut that nearly no negative passes, the shares of unlabelled and positive rows are in
    the ratio of the prior; the cut is the one of the lowest upper confidence bound.
    """
    above_p = np.cumsum(positive[::-1])[::-1] / max(n_p, 1)
    above_u = np.cumsum(unlabelled[::-1])[::-1] / max(n_u, 1)
    usable = above_p > 0.01
    if not usable.any():
        return 0.5
    p, u = above_p[usable], above_u[usable]
    doubt = math.sqrt(math.log(40) / (2 * max(n_p, 1))) + math.sqrt(math.log(40) / (2 * max(n_u, 1)))
    best = int(np.argmin((u + 1.01 * doubt) / p))
    return float(min(0.99, max(0.01, u[best] / p[best])))


def fit(table: DataFrame) -> dict | None:
    """Weights and prior from the rows that are not held out; None without positives."""
    learn = table.filter("not held_out")
    n_u, n_p = learn.agg(F.count("*"), F.count(F.when(F.col("trusted"), 1))).first()
    if not n_p:
        return None
    moments = _sums(learn, lambda x, _: np.concatenate([x.sum(axis=0), (x * x).sum(axis=0)]))
    d = len(moments) // 2
    mean = moments[:d] / n_u
    scale = np.sqrt(np.maximum(moments[d:] / n_u - mean ** 2, 0))
    mean[-1], scale[-1] = 0.0, 1.0
    scale[scale < 1e-6] = 1.0
    first = _newton(learn, n_u, n_p, 0.5, mean, scale, "discriminate")

    def histogram(x: np.ndarray, trusted: np.ndarray) -> np.ndarray:
        bins = np.minimum((_expit(((x - mean) / scale) @ first) * BINS).astype(int), BINS - 1)
        return np.concatenate([np.bincount(bins[trusted], minlength=BINS), np.bincount(bins, minlength=BINS)]).astype(float)

    counts = _sums(learn, histogram)
    prior = estimate_prior(counts[:BINS], counts[BINS:], n_p, n_u)
    return {"w": _newton(learn, n_u, n_p, prior, mean, scale, "pu"), "mean": mean, "scale": scale, "prior": prior}


def classify(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
             modulus: int = 4, held: int = 2, threshold: float = 0.7) -> DataFrame:
    """A row for each document: doc_id, ``held_out``, ``score``, ``predicted``, ``prior``.

    Documents whose id falls into fold ``held`` of ``modulus`` are scored and never learned from.
    Of ``labels`` (doc_id, quality) only positives are used; an id with both labels is no positive.
    A NULL or empty text is scored by its (zero) features. Without a positive every score is 0.5. Repeated rows count and are
    scored each, long texts are read whole, other columns play no part, and an empty table gives no rows.
    """
    table = _table(docs, labels, doc_id, text, fold("doc_id", modulus) == held)
    model = fit(table)
    prior = model["prior"] if model else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            if model:
                scores = _expit(((_matrix(batch.column("x")) - model["mean"]) / model["scale"]) @ model["w"])
            else:
                scores = np.full(batch.num_rows, 0.5)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(scores)],
                                             names=["doc_id", "held_out", "score"])

    kind = table.schema["doc_id"].dataType.simpleString()
    return table.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double").withColumns({
        "predicted": F.when(F.col("score") >= threshold, 1).otherwise(0), "prior": F.lit(prior).cast("double")})
