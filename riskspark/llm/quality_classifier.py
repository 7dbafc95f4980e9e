"""Quality classifier: a regularised quadratic discriminant over document statistics.

Each text becomes a vector of transformed statistics. Each class is a Gaussian
whose covariance is shrunk towards the pooled one and then towards a multiple of
the identity; the score is the posterior of class 1 from the difference of the
log-densities, with Mahalanobis distances by each class's Cholesky factor, whose
inverse is computed once and shipped.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lean, text_of

#: Labelled rows to fit on, about.
TRAIN_ROWS = 50_000
FEATURES = (
    "log_words", "word_length", "upper_share", "symbol_share", "punctuation_share", "digit_share",
    "space_share", "distinct_share", "repeat_share", "line_repeat_share", "log_line_words", "squeeze", "entropy",
)
_UPPER, _LOWER, _DIGIT, _SPACE, _SYMBOL, _PUNCTUATION = (
    np.array([chr(b) in s for b in range(256)])
    for s in ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789", " \t\n\x0b\x0c\r", "#*$%&|<>{}[]~^\\/@=_+", ".,;:!?\"'()-`")
)


def _logit(share: float, n: float) -> float:
    """Log odds of a share of n trials, finite at 0 and 1."""
    return float(np.log((share * n + 0.5) / ((1 - share) * n + 0.5)))


def statistics(text: str) -> list[float]:
    """The transformed statistics of a whole text; all are finite, also for an empty one."""
    raw = text.encode("utf-8", "surrogatepass")
    size = len(raw)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    words = raw.split()
    n = len(words)
    upper, lower = int(counts[_UPPER].sum()), int(counts[_LOWER].sum())
    spaces = int(counts[_SPACE].sum())
    lines = [x for x in raw.split(b"\n") if x.strip()]
    pairs = max(1, n - 1)
    p = counts[counts > 0] / max(1, size)
    return [
        float(np.log1p(n)),
        float(np.log1p((size - spaces) / max(1, n))),
        _logit(upper / max(1, upper + lower), 100),
        _logit(float(counts[_SYMBOL].sum()) / max(1, size), 200),
        _logit(float(counts[_PUNCTUATION].sum()) / max(1, size), 200),
        _logit(float(counts[_DIGIT].sum()) / max(1, size), 200),
        _logit(spaces / max(1, size), 200),
        float(np.log1p(len(set(words))) - 0.75 * np.log1p(n)),
        _logit(1 - len(set(zip(words[:-1], words[1:], strict=True))) / pairs if n > 1 else 0.0, 100),
        _logit(1 - len(set(lines)) / len(lines) if lines else 0.0, 20),
        float(np.log1p(n / max(1, len(lines)))),
        float(np.log(max(1, len(zlib.compress(raw, 1))) / max(1, size))),
        float(-(p * np.log2(p)).sum()) if size else 0.0,
    ]


def document_statistics(documents: DataFrame, *keep: str) -> DataFrame:
    """``keep`` and a column for each statistic of the whole text; null counts as empty."""

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([statistics(x.as_py()) for x in batch.column(batch.num_columns - 1)]).reshape(-1, len(FEATURES))
            own = [*batch.columns[:-1], *(pa.array(values[:, i]) for i in range(len(FEATURES)))]
            yield pa.RecordBatch.from_arrays(own, names=[*batch.schema.names[:-1], *FEATURES])

    df = text_of(documents, *keep)
    kinds = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields[:-1]), *(f"{x} double" for x in FEATURES)])
    return df.mapInArrow(lean(measured), kinds)


@dataclass
class Discriminant:
    """Two Gaussian classes over standardised statistics; the inverses are those of their Cholesky factors."""

    centre: np.ndarray
    scale: np.ndarray
    means: np.ndarray
    inverses: np.ndarray
    offsets: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Posterior of class 1."""
        z = (x - self.centre) / self.scale
        logs = []
        for k in (0, 1):
            away = (z - self.means[k]) @ self.inverses[k].T
            logs.append(self.offsets[k] - 0.5 * (away**2).sum(1))
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))


def fit(labelled: DataFrame, label: Column, to_pooled: float = 0.6, to_identity: float = 0.02, smallest: int = 2) -> Discriminant | None:
    """Fit on rows with the statistics' columns, all of them, by one aggregate of sums and products.

    None if a class has fewer than ``smallest`` rows.
    """
    d = len(FEATURES)
    sums = [F.sum(c).alias(f"s{i}") for i, c in enumerate(FEATURES)]
    products = [F.sum(F.col(a) * F.col(FEATURES[j])).alias(f"p{i}_{j}") for i, a in enumerate(FEATURES) for j in range(i, d)]
    rows = {r["label"]: r for r in labelled.groupBy(label.alias("label")).agg(F.count("*").alias("n"), *sums, *products).filter("label in (0, 1)").collect()}
    if len(rows) < 2 or min(r["n"] for r in rows.values()) < smallest:
        return None
    n = np.array([rows[k]["n"] for k in (0, 1)], float)
    s = np.array([[rows[k][f"s{i}"] for i in range(d)] for k in (0, 1)])
    p = np.array([[[rows[k][f"p{min(i, j)}_{max(i, j)}"] for j in range(d)] for i in range(d)] for k in (0, 1)])
    centre = s.sum(0) / n.sum()
    variance = np.diagonal(p.sum(0)) / n.sum() - centre**2
    scale = np.sqrt(np.where(variance > 1e-9 * (1 + centre**2), variance, 1.0))  # a constant statistic says nothing
    means = (s / n[:, None] - centre) / scale
    within = (p / n[:, None, None] - np.einsum("ki,kj->kij", s / n[:, None], s / n[:, None])) / np.outer(scale, scale)
    pooled = (within * n[:, None, None]).sum(0) / n.sum()
    inverses, offsets = [], []
    for k in (0, 1):
        cov = (1 - to_pooled) * within[k] + to_pooled * pooled
        cov = (1 - to_identity) * cov + to_identity * max(np.trace(cov) / d, 1e-6) * np.eye(d)
        factor = np.linalg.cholesky(cov)
        inverses.append(np.linalg.inv(factor))
        offsets.append(np.log(n[k] / n.sum()) - np.log(np.diagonal(factor)).sum())
    return Discriminant(centre, scale, means, np.array(inverses), np.array(offsets))


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(5)) == 0, F.lit(False))


def train(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", train_rows: int = TRAIN_ROWS) -> Discriminant | None:
    """Fit on labels of 0 or 1 whose document isn't held out.

    A document with several labels counts by its lowest. About ``train_rows``
    labels are taken, by a hash of the id; so bounded, they are broadcast, and
    the texts are read where they lie.
    """
    known = labels.filter("quality in (0, 1)").groupBy(F.col(id_col).cast("long").alias("doc_id")).agg(F.min("quality").alias("label")).filter(~held_out())
    share = min(1.0, train_rows / max(1, known.count()))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30))
    texts = documents.select(F.col(id_col).cast("long").alias("doc_id"), "text")
    return fit(document_statistics(texts.join(F.broadcast(known.filter(place)), "doc_id"), "label"), F.col("label"))


def _scores(texts: list[str | None], model: Discriminant | None) -> np.ndarray:
    if model is None:
        return np.full(len(texts), 0.5)
    return model.scores(np.array([statistics(x or "") for x in texts]).reshape(-1, len(FEATURES)))


def score_quality(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", threshold: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document row.

    Without two classes to learn from every score is 0.5. Null texts count as
    empty and get a score; repeated rows are scored each; other columns are not
    read. Two passes over the texts, the first over labelled ones; no shuffle.
    """
    model = train(documents, labels, id_col)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = _scores(batch.column("text").to_pylist(), model)
            own = [batch.column("doc_id"), batch.column("held_out"), pa.array(s), pa.array((s >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(own, names=["doc_id", "held_out", "score", "predicted"])

    read = text_of(documents, F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"))
    return read.mapInArrow(lean(scored), "doc_id long, held_out boolean, score double, predicted int")


def keep_good(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", threshold: float = 0.3) -> DataFrame:
    """The rows of ``documents`` whose score reaches the threshold, with all their columns."""
    model = train(documents, labels, id_col)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_scores(batch.column("text").to_pylist(), model) >= threshold))

    return documents.mapInArrow(lean(kept), documents.schema)
