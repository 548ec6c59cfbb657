"""Quality: regularised quadratic discriminant over transformed text statistics.

Each class has a mean and a covariance, shrunk towards the pooled one and that
towards its mean variance. The score is the difference of the log densities:
squared Mahalanobis distances by the Cholesky factors, which are worked out
once. The moments are sums over all labelled rows, one aggregate; nothing but
them comes to the driver.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripline.llm.toxicity import fold
from tripline.sources.session import settle

#: Weight of the pooled covariance in a class's, and of the mean variance in the pooled one.
POOLED, SPHERE = 0.2, 0.01
#: Texts are compressed in pieces of so many bytes, to bound the effort's memory.
PIECE = 1 << 20

STATISTICS = ("words", "word_length", "types", "upper", "symbols", "exclaimed", "bars", "digits",
              "adjacent", "repeated_lines", "ended_lines", "squeezed")
_UPPER, _DIGITS, _SYMBOLS = bytes(range(65, 91)), b"0123456789", b"#*$%&<>=~^_{}[]\\@/"
_ENDED = re.compile(r"[.!?…][\"'”’»)\]]*$")


def _log(share: float, floor: float = 0.002) -> float:
    """Shares pile up at zero: the log beyond a floor spreads them."""
    return math.log((share + floor) / floor)


def describe(text: str | None) -> list[float]:
    """Transformed statistics; all zero for a null or wordless text."""
    words = (text or "").split()
    n = len(words)
    if not n:
        return [0.0] * len(STATISTICS)
    raw = text.encode()
    size = len(raw)
    share = lambda signs: (size - len(raw.translate(None, signs))) / size
    lines = [line for line in map(str.strip, text.split("\n")) if line]
    squeezed = sum(len(zlib.compress(raw[at:at + PIECE], 1)) for at in range(0, size, PIECE))
    adjacent = sum(map(str.__eq__, words, words[1:]))
    return [
        math.log1p(n), math.log(sum(map(len, words)) / n), math.log(len(set(words))) / math.log1p(n),
        _log(share(_UPPER), 0.02), _log(share(_SYMBOLS)), _log(share(b"!")), _log(share(b"|")),
        _log(share(_DIGITS)), _log(adjacent / n), _log(1 - len(set(lines)) / len(lines), 0.02),
        sum(bool(_ENDED.search(line)) for line in lines) / len(lines),
        math.log((squeezed + 1) / size)]


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id and ``stats`` of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array([describe(t.as_py()) for t in batch["text"]],
                                           pa.list_(pa.float64()))], names=["doc_id", "stats"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, stats array<double>")


@dataclass
class Discriminant:
    """Means, inverse Cholesky factors and log-determinant terms of classes 0 and 1."""

    means: list[np.ndarray]
    inverses: list[np.ndarray]
    offsets: list[float]

    @classmethod
    def of(cls, counts, sums, products) -> Discriminant:
        """From each class's count, sums and sums of products."""
        counts = np.asarray(counts, dtype=float)
        means = [np.asarray(s) / n for s, n in zip(sums, counts)]
        own = [np.asarray(p) / n - np.outer(m, m) for p, n, m in zip(products, counts, means)]
        pooled = sum(n * c for n, c in zip(counts, own)) / counts.sum()
        size = len(pooled)
        sphere = max(np.trace(pooled) / size, 1e-6) * np.eye(size)
        pooled = (1 - SPHERE) * pooled + SPHERE * sphere
        inverses, offsets = [], []
        for n, c in zip(counts, own):
            factor = np.linalg.cholesky((1 - POOLED) * c + POOLED * pooled)
            inverses.append(np.linalg.inv(factor))
            offsets.append(math.log(n / counts.sum()) - np.log(np.diag(factor)).sum())
        return cls(means, inverses, offsets)

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Probability of class 1 for each row."""
        logs = [o - 0.5 * (((rows - m) @ w.T) ** 2).sum(axis=1)
                for m, w, o in zip(self.means, self.inverses, self.offsets)]
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500)))


def fit(stats: DataFrame, labels: DataFrame, folds: int = 3,
        held_out: int = 1) -> Discriminant | float:
    """Fit on labelled rows (doc_id, ``label``) outside the held-out fold.

    With fewer than two rows of a class there is nothing to tell apart: the
    share of class 1 is returned, 0 without any row.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1)
                         & (fold(F.col("doc_id"), folds) != held_out)).select("doc_id", "label")
    d = len(STATISTICS)
    at = lambda i: F.col("stats")[i]
    pairs = [(i, j) for i in range(d) for j in range(i + 1)]
    rows = stats.join(known, "doc_id").groupBy("label").agg(
        F.count("*").alias("n"), F.array(*(F.sum(at(i)) for i in range(d))).alias("sums"),
        F.array(*(F.sum(at(i) * at(j)) for i, j in pairs)).alias("products")).collect()
    by = {r.label: r for r in rows}  # two rows
    counts = [by[k].n if k in by else 0 for k in (0, 1)]
    if min(counts) < 2:
        return counts[1] / max(1, sum(counts))
    products = []
    for k in (0, 1):
        full = np.zeros((d, d))
        for (i, j), value in zip(pairs, by[k].products):
            full[i, j] = full[j, i] = value
        products.append(full)
    return Discriminant.of(counts, [by[k].sums for k in (0, 1)], products)


def score(docs: DataFrame, labels: DataFrame, folds: int = 3, held_out: int = 1) -> DataFrame:
    """doc_id and score of every row, null and empty texts too; other columns are ignored.

    The statistics are written once: the fit and the scores read them.
    """
    stats = settle(statistics(docs), "statistics")
    fitted = fit(stats, labels, folds, held_out)
    if isinstance(fitted, float):
        return stats.select("doc_id", F.lit(fitted).alias("score"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array(batch["stats"].to_pylist(), dtype=float).reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(fitted.score(rows))], names=["doc_id", "score"])

    return stats.mapInArrow(run, "doc_id long, score double")
