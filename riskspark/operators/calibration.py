"""Isotonic calibration by ranges of the score, and principal components as a table."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.lineage import written

#: Ranges whose blocks meet in one task of a round.
FAN = 16
#: Ends of blocks that are sent to every task.
MOST_KNOTS = 2_000_000
BLOCKS = "part int, low double, high double, pos long, n long"


def pooled(lows, highs, pos, n) -> list[list]:
    """Adjacent blocks in order of score, put together until their means rise; counts are whole numbers, so means compare exactly."""
    out: list[list] = []
    for block in zip(lows, highs, pos, n, strict=True):
        out.append(list(block))
        _settle(out)
    return out


def _settle(blocks: list[list]) -> None:
    """Pool the last block with those before it while their means don't rise."""
    while len(blocks) > 1 and blocks[-2][2] * blocks[-1][3] >= blocks[-1][2] * blocks[-2][3]:
        _, high, pos, n = blocks.pop()
        blocks[-1][1:] = [high, blocks[-1][2] + pos, blocks[-1][3] + n]


def _table(part: int, blocks: list[list]) -> pa.RecordBatch:
    columns = [[b[i] for b in blocks] for i in range(4)]
    return pa.RecordBatch.from_arrays([pa.array([part] * len(blocks), pa.int32()), pa.array(columns[0], pa.float64()), pa.array(columns[1], pa.float64()), pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.int64())], names=["part", "low", "high", "pos", "n"])


def isotonic_blocks(df: DataFrame, score: str, label: str) -> DataFrame:
    """(low, high, pos, n, value): stretches of the score with one calibrated value, the share of positive rows, rising from block to block.

    Pool-adjacent-violators: scores are dealt by ranges and pooled in each, then
    blocks of ``FAN`` neighbouring ranges are pooled together, round by round; the
    order of pooling doesn't change the result. N rows labelled 0 or 1 have at
    most about N^(2/3) blocks, as rising shares need growing blocks, so what meets
    in one task is far smaller than the table. Rows without a score or a label
    don't count; an empty table has no blocks.
    """
    counts = df.select(F.col(score).cast("double").alias("s"), F.col(label).cast("int").alias("y")).filter("s is not null and not isnan(s) and y is not null").groupBy("s").agg(F.count_if(F.col("y") == 1).alias("pos"), F.count("*").alias("n"))

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        blocks: list[list] = []
        for batch in batches:
            s, p, n = (batch.column(i).to_pylist() for i in range(3))
            blocks = _joined(blocks, s, p, n)
        if blocks:
            yield _table(TaskContext.get().partitionId(), blocks)

    found = written(counts.repartitionByRange("s").sortWithinPartitions("s").mapInArrow(own, BLOCKS), "blocks")
    last = found.agg(F.max("part")).first()[0] or 0

    def together(table: pa.Table) -> pa.Table:
        table = table.sort_by("low")
        return pa.Table.from_batches([_table(table.column("part")[0].as_py(), pooled(*(table.column(c).to_pylist() for c in ("low", "high", "pos", "n"))))])

    while last > 0:
        grouped = found.withColumn("part", F.floor(F.col("part") / FAN).cast("int"))
        found, last = written(grouped.groupBy("part").applyInArrow(together, BLOCKS), "blocks"), last // FAN
    return found.select("low", "high", "pos", "n", (F.col("pos") / F.col("n")).alias("value"))


def _joined(blocks: list[list], s: list, p: list, n: list) -> list[list]:
    """Blocks so far and further scores: only the last block can still change, and those that its pooling reaches."""
    for block in pooled(s, s, p, n):
        blocks.append(block)
        _settle(blocks)
    return blocks


def calibrate_by_blocks(df: DataFrame, blocks: DataFrame, score: str, output: str = "calibrated") -> DataFrame:
    """The value of each row's block; between two blocks on the line from one to the other, beyond the ends that of the end.

    A row without a score has none. Two ends a block are sent to every task, at
    most ``MOST_KNOTS``; more is an error.
    """
    knots = blocks.select(F.explode(F.array("low", "high")).alias("at"), "value").distinct().orderBy("at", "value").limit(MOST_KNOTS + 1).collect()
    if len(knots) > MOST_KNOTS:
        raise ValueError(f"more than {MOST_KNOTS} ends of blocks; calibrate on rounded scores")
    shared = df.sparkSession.sparkContext.broadcast((np.array([k[0] for k in knots]), np.array([k[1] for k in knots])))

    @F.pandas_udf("double")
    def value(scores: pd.Series) -> pd.Series:
        xs, ys = shared.value
        return pd.Series(np.interp(scores, xs, ys), index=scores.index).where(scores.notna(), None) if len(xs) else pd.Series([None] * len(scores), dtype="float64")

    return df.withColumn(output, value(F.col(score).cast("double")))


def fit_components(df: DataFrame, features: Sequence[str], k: int) -> DataFrame:
    """(component, feature, mean, scale, weight, share): the first ``k`` principal components of standardised features.

    Means, deviations and covariances come from one aggregate; the eigenvectors of
    the correlations, as large as the features are many, from the driver. A
    component's sign is fixed: its largest weight, the first of equals, is positive.
    ``share`` is the share of variance. Rows with a null or NaN feature are left out;
    a constant feature has scale 1 and weight 0.
    """
    names = list(features)
    values = [F.col(f"`{f}`").cast("double") for f in names]
    whole = df.select(*[v.alias(f"x{i}") for i, v in enumerate(values)]).filter(" and ".join(f"x{i} is not null and not isnan(x{i})" for i in range(len(names))))
    pairs = [(i, j) for i in range(len(names)) for j in range(i)]
    stats = [*[F.avg(f"x{i}") for i in range(len(names))], *[F.stddev_samp(f"x{i}") for i in range(len(names))], *[F.covar_samp(f"x{i}", f"x{j}") for i, j in pairs]]
    row = [x if x is not None and x == x else 0.0 for x in whole.agg(*[c.alias(f"c{i}") for i, c in enumerate(stats)]).first()]
    d = len(names)
    matrix = np.diag([float(s > 0) for s in row[d : 2 * d]])
    for (i, j), r in zip(pairs, row[2 * d :], strict=True):
        matrix[i, j] = matrix[j, i] = r / ((row[d + i] or 1.0) * (row[d + j] or 1.0))
    size, vectors = np.linalg.eigh(matrix)
    out = []
    for c in range(min(k, d)):
        v = vectors[:, d - 1 - c]
        v = v if v[int(np.argmax(np.round(np.abs(v), 12)))] > 0 else -v
        out += [(c, f, float(row[i]), float(row[d + i] or 1.0), float(v[i]), float(max(0.0, size[d - 1 - c]) / max(matrix.trace(), 1e-300))) for i, f in enumerate(names)]
    return df.sparkSession.createDataFrame(out, "component int, feature string, mean double, scale double, weight double, share double")


def residual_score(df: DataFrame, components: DataFrame, output: str = "anomaly_score") -> DataFrame:
    """Length of what the components leave of a standardised row, over the row's length (0 to 1); null with a null or NaN feature, 0 at the mean.

    ``components`` is a stored table of ``fit_components``, a row a component and feature.
    """
    rows = components.orderBy("component", "feature").collect()
    scaled = {r["feature"]: (F.nanvl(F.col(f"`{r['feature']}`").cast("double"), F.lit(None).cast("double")) - r["mean"]) / r["scale"] for r in rows}
    whole = sum((z * z for z in scaled.values()), F.lit(0.0))
    kept = F.lit(0.0)
    for c in sorted({r["component"] for r in rows}):
        part = sum((scaled[r["feature"]] * r["weight"] for r in rows if r["component"] == c), F.lit(0.0))
        kept = kept + part * part
    left = whole - kept
    return df.withColumn(output, F.when(whole.isNull(), None).when(whole > 0, F.sqrt(F.when(left > 0, left).otherwise(0.0) / whole)).otherwise(0.0))
