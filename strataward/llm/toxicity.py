"""Toxicity by classifier chains.

The categories are predicted one after the other. Each has a linear model over the words of
a text and their beginnings, and the log-odds of every earlier category are further inputs of the later ones. In
training these come from models that have not seen the row (out of fold), so the later
models learn how far the earlier ones can be trusted.

The models are fitted on a bounded sample of labelled rows (``Training.max_rows``, chosen by
a hash of the id) in one task; every document is scored by its whole text.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataward.llm.common import ROW, chosen, id_and_text, keep, keyed
from strataward.llm.words import lists, slices, word_features

# Words here are runs of ASCII letters and digits and of bytes beyond ASCII.
BREAK = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
PREFIXES = (4, 5, 6)  # bytes; words that share a stem share such a beginning
CATEGORIES = ("low_quality", "toxic")


@dataclass(frozen=True)
class Training:
    """Limits of the fit: rows in the sample, words in the vocabulary, folds, shrinkage, steps."""

    max_rows: int = 8000
    max_words: int = 768
    min_rows: int = 5
    folds: int = 3
    shrink: float = 5e-4
    steps: int = 600


@dataclass
class Chain:
    """Vocabulary (sorted word hashes) and, per category, weights of words and earlier log-odds, intercept, threshold."""

    words: np.ndarray
    categories: Sequence[str]
    weights: list[np.ndarray] = field(default_factory=list)
    earlier: list[np.ndarray] = field(default_factory=list)
    intercepts: list[float] = field(default_factory=list)
    thresholds: list[float] = field(default_factory=list)

    def __post_init__(self) -> None:
        self.low = np.zeros(1 << 16, bool)
        self.low[(self.words & np.uint64(0xFFFF)).astype(np.int64)] = True

    def find(self, hashes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (text, vocabulary entry) pairs; ``hashes`` has a row per kind of feature."""
        if not len(self.words):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        found = []
        for row in np.atleast_2d(hashes):
            near = np.flatnonzero(self.low[(row & np.uint64(0xFFFF)).astype(np.int64)])
            at = np.searchsorted(self.words, row[near])
            at[at == len(self.words)] = 0
            hit = self.words[at] == row[near]
            text = np.searchsorted(offsets, near[hit], side="right") - 1
            found.append(text * len(self.words) + at[hit])
        pairs = np.unique(np.concatenate(found))
        return pairs // len(self.words), pairs % len(self.words)

    def log_odds(self, texts: np.ndarray, words: np.ndarray, n: int) -> np.ndarray:
        """Log-odds of each category in turn, one row per text."""
        out = np.zeros((n, len(self.weights)))
        for k, w in enumerate(self.weights):
            out[:, k] = self.intercepts[k] + np.bincount(texts, weights=w[words], minlength=n) + out[:, :k] @ self.earlier[k]
        return out


def probability(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_linear(x: np.ndarray, dense: np.ndarray, y: np.ndarray, t: Training) -> tuple[np.ndarray, np.ndarray, float]:
    """Logistic regression with an L1 term on the words (accelerated proximal gradient)."""
    n, k = x.shape
    a = np.hstack([x, dense.astype(np.float32) / 4, np.ones((n, 1), np.float32)])
    v = np.ones(a.shape[1], np.float32)
    for _ in range(20):  # largest curvature
        v = a.T @ (a @ v)
        v /= np.linalg.norm(v)
    step = 4 * n / float(v @ (a.T @ (a @ v)))
    w = np.zeros(a.shape[1], np.float32)
    ahead, pace = w.copy(), 1.0
    for _ in range(t.steps):
        z = ahead - step * (a.T @ (probability(a @ ahead) - y).astype(np.float32)) / n
        z[:k] = np.sign(z[:k]) * np.maximum(np.abs(z[:k]) - step * t.shrink, 0)
        faster = (1 + (1 + 4 * pace * pace) ** 0.5) / 2
        ahead, w, pace = z + (pace - 1) / faster * (z - w), z, faster
    return w[:k].astype(float), w[k:-1].astype(float) / 4, float(w[-1])


def best_threshold(p: np.ndarray, y: np.ndarray) -> float:
    """Middle of the gap, in log-odds, at which the F1 of out-of-fold predictions is best."""
    order = np.argsort(-p, kind="stable")
    z, hit = p[order], np.cumsum(y[order])
    f1 = 2 * hit / (np.arange(1, len(z) + 1) + max(y.sum(), 1))
    f1[:-1][z[:-1] == z[1:]] = -1  # equal scores stay together
    i = int(np.argmax(f1))
    return float((z[i] + z[i + 1]) / 2) if i + 1 < len(z) else float(z[i] - 1)


def vocabulary(hashes: np.ndarray, rows: np.ndarray, labels: np.ndarray, t: Training) -> np.ndarray:
    """The words that tell most about any category: largest chi-square among those in enough rows."""
    words, inverse = np.unique(hashes, return_inverse=True)
    n, seen = len(labels), np.bincount(inverse, minlength=len(words))
    score = np.zeros(len(words))
    for y in labels.T:
        both = np.bincount(inverse, weights=y[rows], minlength=len(words))
        expect = seen * y.mean()
        spread = expect * (1 - y.mean()) * (1 - seen / n)
        score = np.maximum(score, np.where(spread > 0, (both - expect) ** 2 / np.maximum(spread, 1e-12), 0))
    score[seen < t.min_rows] = -1
    best = np.lexsort((words, -score))[: t.max_words]
    return np.sort(words[best[score[best] > 0]])


def fit_chain(ids: np.ndarray, sets: list[np.ndarray], labels: np.ndarray, categories: Sequence[str], t: Training) -> Chain:
    """Fit the models in order. Rows are put in id order and dealt to folds, so the fit depends on the rows only."""
    order = np.argsort(ids, kind="stable")
    sets, labels = [sets[i] for i in order], labels[order].astype(float)
    sizes = np.array([len(s) for s in sets], np.int64)
    rows = np.repeat(np.arange(len(sets)), sizes)
    hashes = np.concatenate(sets) if len(sets) else np.empty(0, np.uint64)
    chain = Chain(vocabulary(hashes, rows, labels, t) if len(hashes) else np.empty(0, np.uint64), categories)
    texts, words = chain.find(hashes, np.concatenate(([0], np.cumsum(sizes))))
    x = np.zeros((len(sets), len(chain.words)), np.float32)
    x[texts, words] = 1
    fold = np.arange(len(sets)) % t.folds
    outside = np.zeros((len(sets), len(categories)))
    for k in range(len(categories)):
        y, dense = labels[:, k], outside[:, :k]
        for f in range(t.folds):
            w, e, b = fit_linear(x[fold != f], dense[fold != f], y[fold != f], t)
            outside[fold == f, k] = x[fold == f] @ w + dense[fold == f] @ e + b
        w, e, b = fit_linear(x, dense, y, t)
        chain.weights.append(w)
        chain.earlier.append(e)
        chain.intercepts.append(b)
        chain.thresholds.append(best_threshold(outside[:, k], y))
    return chain


def _word_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, texts in slices(batch):
            hashes, offsets = word_features([t.lower() for t in texts], BREAK, PREFIXES)
            sets = [np.unique(hashes[:, b:e]) for b, e in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_arrays([part["doc_id"], part["y"], lists(sets, pa.int64())], names=["doc_id", "y", "words"])


def train(docs: DataFrame, labels: DataFrame, categories: Sequence[str] = CATEGORIES, t: Training = Training()) -> Chain | None:
    """Fit on at most about ``t.max_rows`` labelled documents; None if there are none.

    ``labels`` has ``doc_id`` and one 0/1 column per category. Rows with a null are left out;
    of repeated ids each category's largest label counts, and of the documents with one id one.
    """
    named = labels.groupBy(F.col("doc_id").alias("label_id")).agg(*[F.max(F.col(c).cast("double")).alias(c) for c in categories]).dropna()
    n = named.count()
    if not n:
        return None
    sample = named.where(chosen(F.lit(t.max_rows / n), "label_id"))
    y = F.array(*categories).alias("y")
    # a hash sample of max_rows ids: bounded, so it goes to every task; only texts of these ids are shuffled
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(
        F.broadcast(sample.select("label_id", y)), F.col("doc_id") == F.col("label_id")
    )
    # one text per id, merged in the tasks: an id that many rows carry is one training row
    rows = rows.groupBy("doc_id").agg(F.min_by(F.struct("y", "text"), F.xxhash64("text")).alias("one")).select("doc_id", "one.y", "one.text")
    sets = rows.mapInArrow(_word_sets, "doc_id long, y array<double>, words array<long>")

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        words = [np.asarray(w, np.int64).view(np.uint64) for w in group["words"]]
        c = fit_chain(group["doc_id"].to_numpy(), words, np.vstack(group["y"]), categories, t)
        out = [(k, "word", h, w) for k in range(len(categories)) for h, w in zip(c.words.view(np.int64), c.weights[k])]
        for k in range(len(categories)):
            out += [(k, "earlier", j, e) for j, e in enumerate(c.earlier[k])]
            out += [(k, "intercept", 0, c.intercepts[k]), (k, "threshold", 0, c.thresholds[k])]
        return pd.DataFrame(out, columns=["category", "kind", "item", "value"])

    model = sets.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(fit, "category int, kind string, item long, value double").collect()
    if not model:
        return None
    hashes = np.array(sorted({r.item for r in model if r.kind == "word"}), np.int64)
    chain = Chain(np.sort(hashes.view(np.uint64)), categories)
    place = {int(h): i for i, h in enumerate(chain.words.view(np.int64))}
    for k in range(len(categories)):
        own = [r for r in model if r.category == k]
        w = np.zeros(len(chain.words))
        for r in own:
            if r.kind == "word":
                w[place[r.item]] = r.value
        chain.weights.append(w)
        chain.earlier.append(np.array([r.value for r in sorted((r for r in own if r.kind == "earlier"), key=lambda r: r.item)]))
        chain.intercepts.append(next(r.value for r in own if r.kind == "intercept"))
        chain.thresholds.append(next(r.value for r in own if r.kind == "threshold"))
    return chain


def predict(rows: DataFrame, chain: Chain | None, categories: Sequence[str] = CATEGORIES) -> DataFrame:
    """``_row``, ``doc_id``, ``p_<category>`` of each and ``<last category>`` (boolean) for every keyed row.

    The last category holds if its log-odds are above the threshold of the chain. Without a
    chain (no labels) all probabilities are 0. Null and empty texts have no words and are
    never rejected.
    """
    names = [f"p_{c}" for c in categories]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch):
                n = len(texts)
                p, above = np.zeros((n, len(categories))), np.zeros(n, bool)
                if chain is not None:
                    hashes, offsets = word_features([t.lower() for t in texts], BREAK, PREFIXES)
                    z = chain.log_odds(*chain.find(hashes, offsets), n)
                    p, above = probability(z), (z[:, -1] > chain.thresholds[-1]) & (np.diff(offsets) > 0)
                yield pa.RecordBatch.from_arrays(
                    [part[ROW], part["doc_id"], *[pa.array(p[:, k]) for k in range(len(categories))], pa.array(above)],
                    names=[ROW, "doc_id", *names, categories[-1]],
                )

    schema = f"{ROW} long, doc_id long, {', '.join(f'{n} double' for n in names)}, {categories[-1]} boolean"
    return id_and_text(rows).mapInArrow(run, schema)


def document_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``labels`` table as the two categories of the chain."""
    quality: Column = 1 - F.col("quality")
    return spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", quality.alias("low_quality"), "toxic")


def score_documents(docs: DataFrame, labels: DataFrame, training: Training = Training()) -> DataFrame:
    """``doc_id``, ``p_low_quality``, ``p_toxic``, ``toxic`` and ``kept`` (not toxic), one row per document."""
    chain = train(docs, labels, t=training)
    return predict(keyed(docs), chain).drop(ROW).withColumn("kept", ~F.col("toxic"))


def drop_toxic(docs: DataFrame, labels: DataFrame, training: Training = Training()) -> DataFrame:
    """The documents that are not predicted toxic, with their own columns."""
    rows = keyed(docs)
    return keep(rows, predict(rows, train(docs, labels, t=training)).where("NOT toxic"))
