"""Quality classifier: regularised quadratic discriminant over document statistics.

A document becomes a short vector of transformed statistics of its whole text. Class means and
covariances are sums over all labelled training rows, gathered by Spark. A class covariance is
shrunk towards the pooled one, and that towards its diagonal. Tasks get the Cholesky factors, so a
score is a difference of two log densities from Mahalanobis distances.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm.common import text_of
from kindred.session import through_table

N_STATS = 17


def statistics(text: bytes) -> np.ndarray:
    """Statistics of a whole text, transformed towards a bell shape; zeros for an empty one."""
    out = np.zeros(N_STATS)
    if not text:
        return out
    hist = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    size = len(text)
    upper, lower, digits = hist[65:91].sum(), hist[97:123].sum(), hist[48:58].sum()
    marks = hist[33:48].sum() + hist[58:65].sum() + hist[91:97].sum() + hist[123:127].sum()
    plain = hist[44] + hist[46]
    words = text.split()
    n = len(words)
    lengths = np.fromiter(map(len, words), np.int64, n) if n else np.zeros(1)
    lines = text.split(b"\n")
    share = lambda a, b: (a + 0.5) / (b + 1)
    root = lambda a, b: np.sqrt(a / max(b, 1))
    out[:] = (
        np.log1p(n),
        np.log1p(lengths.mean()),
        np.log1p(lengths.std()),
        np.log1p(lengths.max()),
        np.log(share(upper, upper + lower)),
        root(digits, size),
        root(marks - plain, size),
        root(plain, size),
        root(hist[124], size),
        root(hist[33], size),
        root(hist[35] + hist[36] + hist[37] + hist[38] + hist[42], size),
        root(hist[128:].sum(), size),
        np.log1p(len(set(words))) - np.log1p(n),
        np.log(share(len(set(zip(words, words[1:]))), max(n - 1, 0))),
        root(sum(a == b for a, b in zip(words, words[1:])), n),
        np.log(share(len(set(lines)), len(lines))),
        np.log1p(n / len(lines)),
    )
    return out


@dataclass(frozen=True)
class Discriminant:
    """Means, inverse Cholesky factors and log terms of the two classes."""

    means: np.ndarray
    factors: np.ndarray
    offsets: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 for the rows of ``x``."""
        logs = [
            b - 0.5 * np.square((x - m) @ f.T).sum(1)
            for m, f, b in zip(self.means, self.factors, self.offsets)
        ]
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))


def discriminant(
    counts, sums, products, towards_pooled: float = 0.1, towards_diagonal: float = 0.05
) -> Discriminant:
    """From the number of rows, the sums and the sums of products of each class.

    Shrinkage keeps the covariances invertible for any number of rows. A class without rows takes the
    mean of all rows and one pseudo-row, without any labels the score is 0.5 throughout.
    """
    counts, sums, products = np.asarray(counts, float), np.asarray(sums), np.asarray(products)
    total = max(counts.sum(), 1)
    overall = sums.sum(0) / total
    means = np.array([s / n if n else overall for n, s in zip(counts, sums)])
    scatter = [p - n * np.outer(m, m) for n, m, p in zip(counts, means, products)]
    pooled = sum(scatter) / total
    spread = np.diag(np.diag(pooled) + 1e-4)
    pooled = (1 - towards_diagonal) * pooled + towards_diagonal * spread
    factors, offsets = [], []
    for n, s in zip(counts, scatter):
        own = (1 - towards_pooled) * s / n + towards_pooled * pooled if n > 1 else pooled
        lower = np.linalg.cholesky(own + 1e-6 * np.eye(len(own)))
        factors.append(np.linalg.inv(lower))
        offsets.append(np.log((n + 1) / (total + 2)) - np.log(np.diag(lower)).sum())
    return Discriminant(means, np.array(factors), np.array(offsets))


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``stats`` of every row; a null text counts as empty."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            stats = [statistics(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(stats, pa.list_(pa.float64()))], ["doc_id", "stats"]
            )

    texts = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).cast("binary").alias("text"))
    return texts.mapInArrow(run, f"doc_id {kind}, stats array<double>")


def fit(labelled: DataFrame) -> Discriminant:
    """From rows of ``stats`` and ``label`` (0 or 1; other values are ignored)."""

    def moments(batches):
        sums = {}
        for batch in batches:
            x = np.array(batch.column("stats").to_pylist()).reshape(-1, N_STATS)
            y = batch.column("label").to_numpy(zero_copy_only=False)
            for label in (0, 1):
                rows = x[y == label]
                part = np.concatenate([[len(rows)], rows.sum(0), (rows.T @ rows).ravel()])
                sums[label] = sums.get(label, 0) + part
        for label, part in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([label], pa.int32()), pa.array([part], pa.list_(pa.float64()))],
                ["label", "part"],
            )

    rows = (
        labelled.where("label in (0, 1)")
        .select("stats", F.col("label").cast("int").alias("label"))
        .mapInArrow(moments, "label int, part array<double>")
        .select("label", F.posexplode("part").alias("at", "value"))
        .groupBy("label", "at")
        .agg(F.sum("value").alias("value"))
        .collect()  # two classes, 1 + d + d * d numbers each
    )
    parts = np.zeros((2, 1 + N_STATS + N_STATS**2))
    for r in rows:
        parts[r.label, r.at] = r.value
    return discriminant(
        parts[:, 0], parts[:, 1 : 1 + N_STATS], parts[:, 1 + N_STATS :].reshape(2, N_STATS, N_STATS)
    )


def scores(measured: DataFrame, model: Discriminant) -> DataFrame:
    """Adds ``score`` to a table with ``stats`` and drops these."""
    names = [c for c in measured.columns if c != "stats"]
    kinds = [f"{c} {measured.schema[c].dataType.simpleString()}" for c in names]

    def run(batches):
        for batch in batches:
            x = np.array(batch.column("stats").to_pylist()).reshape(-1, N_STATS)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in names] + [pa.array(model.score(x))], [*names, "score"]
            )

    return measured.mapInArrow(run, ", ".join([*kinds, "score double"]))


def classify(
    docs: DataFrame,
    labels: DataFrame,
    held_out,
    label_col: str = "quality",
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every row of ``docs``.

    ``held_out``: a column expression over ``doc_id``; labels of rows where it holds are not learnt
    from. Labels without a document, or that are null, are ignored; a document with several labels
    counts once for each. Ids only join labels, they are no input of the score; equal texts have
    equal scores.
    """
    measured = through_table(measure(docs, id_col, text_col), "stats")
    known = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).alias("label"))
    training = measured.where(~held_out).join(known, "doc_id")
    model = fit(training)
    return scores(measured.withColumn("held_out", held_out), model).withColumn(
        "predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0)
    )


def keep(docs: DataFrame, model: Discriminant, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose score is at least 0.5, with all their columns."""

    @F.pandas_udf("double")
    def judged(texts: pd.Series) -> pd.Series:
        stats = np.array([statistics(t) for t in texts]).reshape(-1, N_STATS)
        return pd.Series(model.score(stats))

    return docs.where(judged(text_of(text_col).cast("binary")) >= 0.5)
