"""Running sums, previous rows and exact quantiles of groups too large for one task.

Rows are dealt by ranges of the group and the order, summed within each range, and
the ranges' totals, a row each, are summed after that. So no group has to pass
one task whole, as it would under a window over the group.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .lineage import written

PART = "__part"


def _sorted(order: str, down: bool) -> Column:
    return F.desc(order) if down else F.asc(order)


def running_sums(df: DataFrame, group: str, order: str, sums: Mapping[str, str], down: bool = False) -> DataFrame:
    """``df`` with the running sum of each column named in ``sums``, under its new name, and the part of each row.

    Sums go by ``order`` within ``group`` and count rows of equal order alike. The
    result is written to the shared folder.
    """
    dealt = df.repartitionByRange(group, _sorted(order, down)).withColumn(PART, F.spark_partition_id())
    within = Window.partitionBy(group, PART).orderBy(_sorted(order, down))
    own = written(dealt.withColumns({new: F.sum(c).over(within) for c, new in sums.items()}), "ranges")
    earlier = Window.partitionBy(group).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    totals = own.groupBy(group, PART).agg(*[F.sum(c).alias(c) for c in sums])
    before = totals.select(group, PART, *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"__{new}") for c, new in sums.items()])
    joined = own.join(before, [group, PART])
    return joined.withColumns({new: F.col(new) + F.col(f"__{new}") for new in sums.values()}).drop(*[f"__{new}" for new in sums.values()])


def previous_rows(df: DataFrame, group: str, order: str, columns: Sequence[str], down: bool = False) -> DataFrame:
    """``df``, with parts as ``running_sums`` gives them, with ``prev_<c>`` of the row before; orders are distinct within a group."""
    within = Window.partitionBy(group, PART).orderBy(_sorted(order, down))
    values = F.struct(*columns)
    last = (F.min_by if down else F.max_by)(values, F.col(order))
    ends = df.groupBy(group, PART).agg(last.alias("__last"))
    ahead = ends.select(group, PART, F.lag("__last").over(Window.partitionBy(group).orderBy(PART)).alias("__ahead"))
    joined = df.withColumn("__prev", F.lag(values).over(within)).join(ahead, [group, PART])
    prev = F.coalesce("__prev", "__ahead")
    return joined.withColumns({f"prev_{c}": prev[c] for c in columns}).drop("__prev", "__ahead")


def quantiles_of(summed: DataFrame, group: str, value: str, running: str, points: Sequence[float]) -> DataFrame:
    """(group, quantiles): interpolated quantiles from distinct values with the running sum of their counts."""
    return quantiles_and(summed, group, value, running, points).filter("quantiles is not null")


def quantiles_and(summed: DataFrame, group: str, value: str, running: str, points: Sequence[float], **also: Column) -> DataFrame:
    """(group, quantiles, ``also``...) with further aggregates of the same read; quantiles are null where all counts are 0."""
    total = summed.groupBy(group).agg(F.max(running).alias("__n"))
    at = [F.lit(p) * (F.col("__n") - 1) for p in points]
    joined = summed.join(F.broadcast(total), group)
    ends = joined.groupBy(group).agg(
        F.max("__n").alias("__n"), *[F.min(F.when(F.col(running) > F.floor(x), F.col(value))).alias(f"__low{i}") for i, x in enumerate(at)], *[F.min(F.when(F.col(running) > F.ceil(x), F.col(value))).alias(f"__high{i}") for i, x in enumerate(at)],
        *[column.alias(name) for name, column in also.items()],
    )
    out = []
    for i, x in enumerate(at):
        low, high = F.col(f"__low{i}"), F.col(f"__high{i}")
        out.append(F.when(low == high, low).otherwise((F.ceil(x) - x) * low + (x - F.floor(x)) * high))
    return ends.select(group, F.when(F.col("__n") > 0, F.array(*out)).alias("quantiles"), *also)


def exact_quantiles(df: DataFrame, group: str, value: str, points: Sequence[float]) -> DataFrame:
    """(group, quantiles): interpolated quantiles of ``value``, nulls left out, by counts of the distinct values."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(group, value).agg(F.count("*").alias("__count"))
    return quantiles_of(running_sums(counts, group, value, {"__count": "__running"}), group, value, "__running", points)


def _edge(df: DataFrame, column: str, n: int) -> tuple[DataFrame, int, int]:
    """(the value, as a table of one row, that the n-th row has by ``column``, nulls first; rows of smaller values; rows of that value)."""
    counts = df.groupBy(F.col(column).alias("__edge")).agg(F.count("*").alias("__count"))
    dealt = written(counts.repartitionByRange(F.asc_nulls_first("__edge")).withColumn(PART, F.spark_partition_id()), "ranges")
    before = 0
    for part, rows in dealt.groupBy(PART).agg(F.sum("__count")).orderBy(PART).collect():
        if before + rows >= n:
            break
        before += rows
    within = Window.partitionBy(PART).orderBy(F.asc_nulls_first("__edge"))
    reached = dealt.filter(F.col(PART) == part).withColumn("__upto", before + F.sum("__count").over(within)).filter(F.col("__upto") >= n)
    edge = written(reached.orderBy(F.asc_nulls_first("__edge")).limit(1), "edges", 1)
    count, upto = edge.select("__count", "__upto").first()
    return edge.select("__edge"), upto - count, count


def first_rows(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The columns ``order`` of the n first rows by them, ascending and nulls first; of all rows where there aren't more.

    The values of the first column are counted, dealt by ranges and their counts
    summed, up to the value that the n-th row has. Rows of smaller values are taken;
    those of that value go by the next column, unless all are wanted. Rows equal in
    all columns are made anew, as many as are wanted. So no task holds n rows, and
    the driver gets one row a range.
    """
    rows = df.select(*order)
    if n < 1:
        return rows.limit(0)
    total = rows.count()
    left, smaller, edges = min(n, total), [], []
    for c in order:
        if left == total:
            break
        edge, before, total = _edge(rows, c, left)
        left -= before
        edges.append(F.broadcast(edge.withColumnRenamed("__edge", c)))
        beside = rows.crossJoin(F.broadcast(edge))
        smaller.append(beside.filter(F.struct(F.col(c).alias("v")) < F.struct(F.col("__edge").alias("v"))).drop("__edge"))
        rows = beside.filter(F.col(c).eqNullSafe(F.col("__edge"))).drop("__edge")
    if left < total:
        rows = reduce(DataFrame.crossJoin, edges, df.sparkSession.range(left)).select(*order)
    return reduce(DataFrame.unionByName, smaller, rows)
