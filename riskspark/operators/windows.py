"""Row windows, global order, velocity windows, top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.lineage import written
from ..functions.ranges import exact_quantiles
from ..functions.scalars import haversine_km
from ..functions.skew import join_hot

IMPOSSIBLE_KMH = 900.0
LEAST_HOURS = 0.001
#: Size of a sketch of distinct values, as a power of two: 2 KB, counts within about 1.6 %.
SKETCH_LG_K = 12


def geo_velocity(df: DataFrame, key: str = "card_id", ts: str = "event_time_ts", tie: str = "transaction_id") -> DataFrame:
    """Distance, hours and speed since the card's previous event; the first has zeros. Equal times go by ``tie``."""
    order = Window.partitionBy(key).orderBy(ts, tie)
    before = {c: F.lag(c).over(order) for c in ("latitude", "longitude", ts)}
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    df = df.withColumns({"prev_lat": before["latitude"], "prev_lon": before["longitude"], "prev_time": before[ts]})
    known = F.col("prev_lat").isNotNull() & F.col("latitude").isNotNull()
    km = F.when(known, haversine_km(F.col("prev_lat"), F.col("prev_lon"), F.col("latitude"), F.col("longitude"))).otherwise(0.0)
    hours = F.when(F.col("prev_time").isNotNull(), (micros(ts) - micros("prev_time")) / 3600e6).otherwise(0.0)
    df = df.withColumns({"distance_km": km, "time_delta_hours": hours})
    df = df.withColumn("velocity_kmh", F.when(F.col("time_delta_hours") > LEAST_HOURS, F.col("distance_km") / F.col("time_delta_hours")).otherwise(0.0))
    return df.withColumn("is_impossible_travel", F.coalesce(F.col("velocity_kmh") > IMPOSSIBLE_KMH, F.lit(False)).cast("int")).drop("prev_lat", "prev_lon", "prev_time")


def with_global_rank(df: DataFrame, order: str, tie: str, output: str = "rank") -> DataFrame:
    """Place in the global order, from 1, without a window over the whole table.

    Rows are dealt by ranges of the order and written, so that the ranges hold
    still; each part's rows are counted, and a row's place is its place in its
    part after all earlier parts.
    """
    dealt = written(df.repartitionByRange(F.col(order).asc_nulls_first(), F.col(tie).asc_nulls_first()).withColumn("__part", F.spark_partition_id()), "ranges")
    counts = dealt.groupBy("__part").agg(F.count("*").alias("__n"))
    before = counts.select("__part", F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    place = F.row_number().over(Window.partitionBy("__part").orderBy(F.col(order).asc_nulls_first(), F.col(tie).asc_nulls_first()))
    return dealt.join(F.broadcast(before), "__part").withColumn(output, F.col("__before") + place).drop("__part", "__before")


def chronological_split(df: DataFrame, order: str = "event_time_ts", tie: str = "transaction_id", train: float = 0.70, validation: float = 0.15) -> DataFrame:
    """Add ``split``: train, validation or test, by global order."""
    ranked = with_global_rank(df, order, tie, "__rank")
    n = df.count()
    first, second = int(n * train), int(n * (train + validation))
    return ranked.withColumn("split", F.when(F.col("__rank") <= first, "train").when(F.col("__rank") <= second, "validation").otherwise("test")).drop("__rank")


def quantile_cutoff(df: DataFrame, order: Column, share: float = 0.80, label: str = "is_fraud") -> DataFrame:
    """(side, rows, fraud_rate) before and after a quantile of the order."""
    at = df.select(F.lit(0).alias("__all"), order.alias("__at"), F.col(label).alias("__y"))
    cut = exact_quantiles(at, "__all", "__at", [share]).select(F.get("quantiles", F.lit(0)).alias("__cut"))
    sided = at.crossJoin(F.broadcast(cut)).withColumn("side", F.when(F.col("__at") <= F.col("__cut"), "before").otherwise("after"))
    return sided.groupBy("side").agg(F.count("*").alias("rows"), F.avg(F.col("__y").cast("double")).alias("fraud_rate"))


def latest_row(df: DataFrame, order: str, tie: str) -> DataFrame:
    """The newest row; ties by ``tie``."""
    return df.orderBy(F.desc(order), F.desc(tie)).limit(1)


def top_levels(df: DataFrame, column: str, k: int, label: str = "is_fraud") -> DataFrame:
    """The k most frequent levels with fraud rate and share of rows; ties by level."""
    counts = df.groupBy(column).agg(F.count("*").alias("rows"), F.avg(F.col(label).cast("double")).alias("fraud_rate"))
    total = counts.agg(F.sum("rows").alias("total"))
    return counts.orderBy(F.desc("rows"), F.asc_nulls_first(column)).limit(k).crossJoin(F.broadcast(total)).withColumn("share", F.col("rows") / F.col("total")).drop("total")


def case_queue(cases: DataFrame, status: str, action: str | None = None, n: int = 100, ts: str = "created_at", tie: str = "case_id") -> DataFrame:
    """The newest n cases of a status, and action if given, for analysts."""
    found = cases.filter(F.col("case_status") == status)
    found = found.filter(F.col("decision_action") == action) if action else found
    return found.orderBy(F.desc(ts), F.desc(tie)).limit(n)


#: Leading bits of a hash by which a sample's rows are counted.
SAMPLE_BITS = 16


def exact_sample(df: DataFrame, key: str, strata: Sequence[str] = (), n: int | None = None, share: float | None = None, seed: int = 0) -> DataFrame:
    """A sample of exactly ``n`` rows, or the rounded ``share`` of the rows, of each stratum; all where there are fewer.

    The rows with the smallest md5 of ``<seed>:<key>`` are taken, so that the sample is
    the same under any partitioning, and a smaller one is part of a larger. A null
    key counts as an empty one; rows of equal key come in the order of their columns.

    Rows are counted by the hash's leading bits; from the counts follows up to where
    a stratum is taken whole, and only rows at that edge are put in order. So no
    stratum is sorted or gathered.
    """
    if (n is None) == (share is None):
        raise ValueError("give n or share")
    names = list(strata)
    shift = 16 - SAMPLE_BITS
    hashed = df.withColumn("__h", F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))))
    spot = F.shiftright(F.conv(F.substring("__h", 1, 4), 16, 10).cast("int"), shift)
    hashed = hashed.withColumn("__b", spot).withColumn("__s", F.coalesce(F.to_json(F.struct(*names)), F.lit("")) if names else F.lit(""))
    counts = hashed.groupBy("__s", "__b").agg(F.count("*").alias("__n"))
    upto = Window.partitionBy("__s").orderBy("__b")
    summed = counts.withColumns({"__end": F.sum("__n").over(upto), "__all": F.sum("__n").over(Window.partitionBy("__s"))})
    wanted = F.lit(n).cast("long") if n is not None else F.round(F.col("__all") * share).cast("long")
    # Each stratum's bucket in which the sample ends, and how many of its rows belong to it.
    edge = summed.withColumn("__k", F.least(wanted, F.col("__all"))).filter("__end >= __k and __end - __n < __k")
    edge = written(edge.select("__s", F.col("__b").alias("__edge"), (F.col("__k") - F.col("__end") + F.col("__n")).alias("__take"), F.col("__all").alias("__rows")), "edges")
    joined = join_hot(hashed, edge, "__s", "__rows", edge.agg(F.sum("__rows")).first()[0] or 0)
    columns = [F.col(f"`{c}`") for c in df.columns]
    whole = joined.filter("__b < __edge").select(*columns)
    order = Window.partitionBy("__s").orderBy("__h", *columns)
    return whole.unionByName(joined.filter("__b = __edge").withColumn("__r", F.row_number().over(order)).filter("__r <= __take").select(*columns))


def velocity(
    df: DataFrame, key: str, length: str, slide: str | None = None, prefix: str = "", ts: str = "event_time_ts", amount: str = "amount",
    measures: tuple[str, ...] = ("count", "sum"), distinct: str | None = None, watermark: str | None = "10 minutes", exact: bool = False,
) -> DataFrame:
    """Counts and amounts of a key in sliding or tumbling windows; the feature's time is the window's end.

    One code path for batch and stream: in batch the watermark does nothing. The
    end, not the start, stamps the row, so no later event leaks into it.
    """
    time = F.col(ts).cast("timestamp")
    df = df.withColumn("__ts", time)
    df = df.withWatermark("__ts", watermark) if watermark else df
    value = F.col(amount)
    known = {
        "count": F.count("*"), "avg": F.avg(value), "std": F.coalesce(F.stddev(value), F.lit(0.0)), "max": F.max(value), "sum": F.sum(value),
    }
    aggs = [known[m].alias(f"{prefix}{m}") for m in measures]
    if distinct:
        aggs.append((F.count_distinct(distinct) if exact else F.approx_count_distinct(distinct)).alias(f"{prefix}distinct_{distinct}"))
    window = F.window("__ts", length, slide) if slide else F.window("__ts", length)
    return df.groupBy(key, window).agg(*aggs).select(key, F.col("window.end").alias("feature_timestamp"), *[f"{prefix}{m}" for m in measures], *([f"{prefix}distinct_{distinct}"] if distinct else []))


def velocity_by_panes(df: DataFrame, key: str, length: str, slide: str, prefix: str = "", ts: str = "event_time_ts", amount: str = "amount", distinct: str | None = None, lg_k: int = SKETCH_LG_K) -> DataFrame:
    """``velocity`` (count, sum, avg and distinct) of a batch, from panes of one slide each that windows put together.

    Rows are summed up once a pane, and only panes are repeated for the windows they
    lie in, where ``velocity`` repeats every row. Distinct values are sketches that
    unite over panes; their relative error is about 1.04 / sqrt(2^lg_k), and small
    counts are exact. ``length`` must be a multiple of ``slide``.
    """
    value = F.col(amount)
    pane = F.window(F.col(ts).cast("timestamp"), slide)
    sums = [F.count("*").alias("n"), F.count(value).alias("valued"), F.sum(value).alias("total")]
    panes = df.groupBy(key, pane.alias("pane")).agg(*sums, *([F.hll_sketch_agg(F.col(distinct), lg_k).alias("sketch")] if distinct else []))
    step = F.expr(f"INTERVAL {slide}")
    ends = F.sequence(F.col("pane.end"), F.col("pane.start") + F.expr(f"INTERVAL {length}"), step)
    spread = panes.select(key, F.explode(ends).alias("feature_timestamp"), "n", "valued", "total", *(["sketch"] if distinct else []))
    total = F.sum("total")
    out = [F.sum("n").alias(f"{prefix}count"), total.alias(f"{prefix}sum"), F.try_divide(total, F.sum("valued")).alias(f"{prefix}avg")]
    if distinct:
        out.append(F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("sketch")), F.lit(0)).alias(f"{prefix}distinct_{distinct}"))
    return spread.groupBy(key, "feature_timestamp").agg(*out)


def card_velocity_5m(df: DataFrame, **options) -> DataFrame:
    return velocity(df, "card_id", "5 minutes", "1 minute", "card_5m_", measures=("count", "avg", "std", "max", "sum"), **options)


def card_velocity_1h(df: DataFrame, **options) -> DataFrame:
    return velocity(df, "card_id", "1 hour", "5 minutes", "card_1h_", **options)


def customer_velocity_1h(df: DataFrame, **options) -> DataFrame:
    return velocity(df, "customer_id", "1 hour", "5 minutes", "customer_1h_", measures=("count", "sum", "avg"), distinct="merchant_id", **options)


def customer_velocity_24h(df: DataFrame, **options) -> DataFrame:
    return velocity(df, "customer_id", "24 hours", None, "customer_24h_", distinct="device_id", **options)
