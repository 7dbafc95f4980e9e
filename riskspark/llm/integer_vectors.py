"""Vectors as exact integers, their squared distances, and sums by group in bounded memory."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lean, written

#: Rows of a batch that are judged at once.
BLOCK = 2048


def usable(vector: Column, dims: int) -> Column:
    """Whether a vector has exactly ``dims`` components, none null, NaN or infinite; never null."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) == dims) & finite, F.lit(False))


def integer_vectors(embeddings: DataFrame, scale: int, dims: int, keep: dict[str, str], vector: str = "embedding") -> DataFrame:
    """The columns ``keep`` (new name: old name) and ``ints``, floor(scale * x) of each component x; written once.

    Rows without a usable vector are left out, all others stay, repeated ones too.
    """
    x = F.col(vector).cast("array<double>")
    ints = F.transform(x, lambda c: F.floor(c * float(scale)))
    return written(embeddings.filter(usable(x, dims)).select(*[F.col(old).alias(new) for new, old in keep.items()], ints.alias("ints")), "vectors")


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """A batch's vectors as rows of int64."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(-1, dims)


def exact_in(points: np.ndarray, others: np.ndarray) -> type:
    """The type in which all squared distances of two sets of points are exact; none is too small for a long: an error, as in ANSI sums."""
    most = max((int(abs(int(x.min()))) if i else int(x.max()) for x in (points, others) if x.size for i in (0, 1)), default=0)
    need = 4 * points.shape[1] * most * most
    if need >= 1 << 63:
        raise OverflowError(f"squared distances of components as large as {most} don't fit a long")
    return np.float64 if need < 1 << 53 else np.int64


def squared(points: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Exact squared distances, a row a point, a column one of ``others``."""
    kind = exact_in(points, others)
    a, b = points.astype(kind), others.astype(kind)
    if kind is np.float64:  # sums of integers below 2^53 are exact in any order
        return ((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)).astype(np.int64)
    return np.stack([((a - x) ** 2).sum(1) for x in b], axis=1)


class Sums:
    """Componentwise sums and counts of the vectors of each group, of a bounded number of groups."""

    def __init__(self, groups: int, dims: int):
        self.sums = np.zeros((groups, dims), np.int64)
        self.counts = np.zeros(groups, np.int64)

    def add(self, groups: np.ndarray, vectors: np.ndarray) -> None:
        if len(groups):
            order = np.argsort(groups, kind="stable")
            found, first = np.unique(groups[order], return_index=True)
            self.sums[found] += np.add.reduceat(vectors[order], first, axis=0)
            self.counts += np.bincount(groups, minlength=len(self.counts))

    def batch(self) -> pa.RecordBatch:
        used = np.flatnonzero(self.counts)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(used) + 1) * self.sums.shape[1], pa.int32()), pa.array(self.sums[used].ravel()))
        return pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(self.counts[used]), lists], names=["grp", "n", "sums"])


def group_means(vectors: DataFrame, dims: int, width: int, groups: int, fill: Callable[[Sums, np.ndarray], None]) -> dict[int, np.ndarray]:
    """The floor of each non-empty group's componentwise mean, exactly.

    ``fill`` adds a block of vectors to the sums of a task, which have ``width``
    components; a task sends at most ``groups`` rows, Spark sums them, and so many
    rows reach the driver.
    """

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = Sums(groups, width)
        for batch in batches:
            whole = matrix(batch.column(0), dims)
            for i in range(0, len(whole), BLOCK):
                fill(sums, whole[i : i + BLOCK])
        yield sums.batch()

    rows = vectors.select("ints").mapInArrow(lean(summed), "grp long, n long, sums array<bigint>")
    totals = rows.groupBy("grp").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[j]) for j in range(width)]).alias("sums"))
    return {r["grp"]: np.array([s // r["n"] for s in r["sums"]], np.int64) for r in totals.collect()}
