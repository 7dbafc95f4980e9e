"""Distribution drift of many features at once.

Features are unpivoted to (feature, side, value) and handled together: one scan
counts all values, whatever the number of features, and every measure is made of
the counts. Where nearly every value is distinct, the same measures come from
quantile sketches, which merge over tasks and days.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.lineage import written
from ..functions.ranges import quantiles_and, running_sums

EPS = 1e-6
#: Size of the sketch of a feature's values, which is some 100 KB at most, with ranks within 0.13 %; quantiles read from it.
SKETCH_K, SKETCH_POINTS = 4096, 2000
#: Fixed thresholds: (warning, critical).
PSI, JSD, KS, KS_P = (0.10, 0.25), (0.05, 0.15), (0.05, 0.10), (0.01, 0.001)


def long_form(reference: DataFrame, current: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, side, value) of both tables; nulls and NaN are left out, as are features that one table lacks."""
    both = [f for f in features if f in reference.columns and f in current.columns]
    parts = [df.select(F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in both])).alias("x")).select("x.feature", F.lit(side).alias("side"), "x.value") for side, df in (("ref", reference), ("cur", current))]
    return parts[0].unionByName(parts[1]).filter("value is not null and not isnan(value)")


def value_counts(values: DataFrame) -> DataFrame:
    """(feature, value, r, c, r_running, c_running): how often each value stands on each side, and up to it.

    All measures come from this table, which is written once.
    """
    counts = values.groupBy("feature", "value").agg(F.count_if(F.col("side") == "ref").alias("r"), F.count_if(F.col("side") == "cur").alias("c"))
    return running_sums(counts, "feature", "value", {"r": "r_running", "c": "c_running"})


def measures_from(counts: DataFrame, buckets: int = 10, bins: int = 50) -> DataFrame:
    """(feature, ref_n, cur_n, psi, ks_stat, ks_p_value, jsd) of the counts; measures are null where a side has no value.

    The counts are read three times, whatever is measured: for the number of
    reference values, for edges and spans, and to deal values to buckets and bins. Both rise with
    the value, so a feature has less than ``buckets + bins`` cells, of which its measures are made.
    """
    edges = quantiles_and(
        counts, "feature", "value", "r_running", [i / buckets for i in range(1, buckets)],
        ref_n=F.sum("r"), cur_n=F.sum("c"), lo=F.min("value"), hi=F.max("value"),
    )
    flat = F.col("hi") == F.col("lo")
    edges = edges.withColumns({"lo": F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")), "hi": F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi"))})
    width = (F.col("hi") - F.col("lo")) / bins
    # Inner edges at or below the value, so bucket 0 is below the first one.
    bucket = F.size(F.filter("quantiles", lambda e: e <= F.col("value")))
    at = F.least(F.lit(bins - 1), F.floor((F.col("value") - F.col("lo")) / width)).cast("int")
    gap = F.abs(F.try_divide("r_running", "ref_n") - F.try_divide("c_running", "cur_n"))
    of_feature = ["feature", "ref_n", "cur_n", "lo", "hi"]
    cells = counts.join(F.broadcast(edges), "feature").groupBy(*of_feature, bucket.alias("bucket"), at.alias("bin")).agg(F.sum("r").alias("r"), F.sum("c").alias("c"), F.max(gap).alias("gap"))
    whole = cells.groupBy(*of_feature).agg(F.collect_list(F.struct("bucket", "bin", "r", "c")).alias("cells"), F.max("gap").alias("gap")).withColumn("there", (F.col("ref_n") > 0) & (F.col("cur_n") > 0))
    few = lambda n: (F.col("ref_n") < n) | (F.col("cur_n") < n)
    measure = lambda few, value: F.when(F.col("there"), F.when(few, 0.0).otherwise(value))
    en = (F.col("ref_n") * F.col("cur_n")) / (F.col("ref_n") + F.col("cur_n"))
    found = {"psi": measure(few(buckets), _psi(buckets)), "ks_stat": F.when(F.col("there"), F.col("gap")), "jsd": measure(few(bins), _jsd(bins, width))}
    return whole.withColumns(found).select("feature", "ref_n", "cur_n", "psi", "ks_stat", ks_p_value(F.col("ks_stat"), en).alias("ks_p_value"), "jsd")


def _sums(part: str, n: int, count: str) -> Column:
    """The cells' counts summed up in each of the ``n`` buckets or bins, 0 where it has no cell."""
    mine = lambda i: F.filter("cells", lambda cell: cell[part] == i)
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.aggregate(mine(i), F.lit(0.0), lambda total, cell: total + cell[count]))


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, x: total + x)


def _psi(buckets: int) -> Column:
    """Reference quantiles as edges, open ends; equal edges leave empty buckets, which the smoothing covers."""
    share = lambda count, n: F.transform(_sums("bucket", buckets, count), lambda x: x / F.col(n) + EPS)
    return _total(F.zip_with(share("r", "ref_n"), share("c", "cur_n"), lambda e, a: (a - e) * F.log(a / e)))


def _jsd(bins: int, width: Column) -> Column:
    """Over equal bins of both sides' range, of smoothed densities scaled to 1."""

    def shares(count: str, n: str) -> Column:
        # The counts add up to the side's size, so the densities before smoothing to 1 / width.
        total = 1 / width + bins * 1e-10
        return F.transform(_sums("bin", bins, count), lambda x: (x / (F.col(n) * width) + 1e-10) / total)

    term = lambda p, q: p * F.log(2 * p / (p + q)) + q * F.log(2 * q / (p + q))
    return F.greatest(F.lit(0.0), _total(F.zip_with(shares("r", "ref_n"), shares("c", "cur_n"), term)) / 2)


def psi(values: DataFrame, buckets: int = 10) -> DataFrame:
    """(feature, psi): 0 with fewer values than buckets on a side. Buckets are closed below and open above."""
    return measures_from(value_counts(values), buckets=buckets).filter("psi is not null").select("feature", "psi")


def jsd(values: DataFrame, bins: int = 50) -> DataFrame:
    """(feature, jsd): squared Jensen-Shannon distance, in nats; 0 with fewer values than bins on a side."""
    return measures_from(value_counts(values), bins=bins).filter("jsd is not null").select("feature", "jsd")


def ks_2samp(values: DataFrame) -> DataFrame:
    """(feature, ks_stat, ks_p_value): the largest gap of the distributions, and its asymptotic p."""
    return measures_from(value_counts(values)).filter("ks_stat is not null").select("feature", "ks_stat", "ks_p_value")


def ks_p_value(stat: Column, en: Column) -> Column:
    """The asymptotic p of a gap, for an effective number of values."""
    x = -2 * stat * stat * en
    terms = [F.lit(2.0 * (-1) ** (k - 1)) * F.exp(x * (k * k)) for k in range(1, 101)]
    series = F.aggregate(F.array(*terms), F.lit(0.0), lambda a, b: a + b)
    return F.when(stat == 0, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), series)))


# Measures of sketches ---------------------------------------------------------


def rank_error(k: int) -> float:
    """The error of a rank read from a sketch of size ``k``, as a share of all values, that 99 in 100 sketches keep."""
    return 2.296 / k**0.9021


def side_sketches(values: DataFrame, k: int = SKETCH_K, *more: str) -> DataFrame:
    """(feature, side, ``more``..., sketch, n, lo, hi): a quantile sketch of each feature and side, as of a day if ``more`` has one.

    Values are sketched where they are read; only sketches are shuffled.
    """
    return values.groupBy("feature", "side", *more).agg(F.kll_sketch_agg_double("value", k).alias("sketch"), F.count("*").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi"))


def merged_sketches(sketches: DataFrame) -> DataFrame:
    """(feature, side, sketch, n, lo, hi) of several days' sketches."""
    return sketches.groupBy("feature", "side").agg(F.kll_merge_agg_double("sketch").alias("sketch"), F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))


def sketched_counts(sketches: DataFrame, points: int = SKETCH_POINTS) -> DataFrame:
    """What ``value_counts`` gives, from one sketch a feature and side: ``points`` quantiles that share the side's rows evenly.

    So every measure of counts is one of sketches, with shares that are off by
    ``rank_error`` and 1 / ``points`` at most. Both ends of the range stand there
    with no rows of their own. A feature has 2 * ``points`` + 2 rows at most, so
    they are summed up in one window.
    """
    grid = F.array(*[F.lit((i + 0.5) / points) for i in range(points)])
    inner = sketches.select("feature", "side", (F.col("n") / points).alias("w"), F.explode(F.kll_sketch_get_quantile_double("sketch", grid)).alias("value"))
    ends = sketches.select("feature", "side", F.lit(0.0).alias("w"), F.explode(F.array("lo", "hi")).alias("value"))
    weight = lambda s: F.sum(F.when(F.col("side") == s, F.col("w")).otherwise(0.0))
    counts = inner.unionByName(ends).groupBy("feature", "value").agg(weight("ref").alias("r"), weight("cur").alias("c"))
    upto = Window.partitionBy("feature").orderBy("value")
    return counts.select("*", F.sum("r").over(upto).alias("r_running"), F.sum("c").over(upto).alias("c_running"))


def sketched_measures(sketches: DataFrame, points: int = SKETCH_POINTS) -> DataFrame:
    """(feature, ref_n, cur_n, psi, ks_stat, ks_p_value, jsd) of one sketch a feature and side."""
    measures = measures_from(written(sketched_counts(sketches, points), "sketched"))
    n = lambda s: F.coalesce(F.max(F.when(F.col("side") == s, F.col("n"))), F.lit(0)).alias(f"{s}_n")
    return sketches.groupBy("feature").agg(n("ref"), n("cur")).join(measures.drop("ref_n", "cur_n"), "feature", "left")


def feature_drift_report(reference: DataFrame, current: DataFrame, features: Sequence[str], least: int = 30, sketch: int | None = None) -> DataFrame:
    """(feature, psi, ks_stat, ks_p_value, jsd, ref_n, cur_n, status), one row a feature asked for.

    Features that a table lacks are MISSING; with fewer than ``least`` values on
    a side they are INSUFFICIENT_DATA. Values are counted, which shuffles each
    distinct one; for features whose values hardly repeat give ``sketch``, the size
    of quantile sketches, which leave measures off by their rank error.
    """
    values = long_form(reference, current, features)
    asked = reference.sparkSession.createDataFrame([(f, f in reference.columns and f in current.columns) for f in features], "feature string, there boolean")
    measures = sketched_measures(written(side_sketches(values, sketch), "sketches")) if sketch else measures_from(value_counts(values))
    joined = asked.join(measures, "feature", "left")
    joined = joined.fillna(0, ["ref_n", "cur_n"])
    few = (F.col("ref_n") < least) | (F.col("cur_n") < least)

    def passes(level: int):
        return (F.col("psi") >= PSI[level]) | ((F.col("ks_stat") >= KS[level]) & (F.col("ks_p_value") < KS_P[level])) | (F.col("jsd") >= JSD[level])

    status = F.when(~F.col("there"), "MISSING").when(few, "INSUFFICIENT_DATA").when(passes(1), "CRITICAL_DRIFT").when(passes(0), "WARNING").otherwise("STABLE")
    shown = {"psi": (0.0, 4), "ks_stat": (0.0, 4), "ks_p_value": (1.0, 6), "jsd": (0.0, 4)}
    return joined.select("feature", *[F.when(few, empty).otherwise(F.round(c, digits)).alias(c) for c, (empty, digits) in shown.items()], "ref_n", "cur_n", status.alias("status"))


def drift_summary(report: DataFrame) -> DataFrame:
    """One row over the report: counts by status, worst and mean measures, overall status. Missing features don't count."""
    is_ = lambda s: F.col("status") == s
    scored = F.col("status").isin("CRITICAL_DRIFT", "WARNING", "STABLE")
    row = report.filter(~is_("MISSING")).agg(
        F.count_if(is_("CRITICAL_DRIFT")).alias("critical_count"), F.count_if(is_("WARNING")).alias("warning_count"), F.count_if(is_("STABLE")).alias("stable_count"), F.count_if(is_("INSUFFICIENT_DATA")).alias("insufficient_data_count"),
        F.round(F.coalesce(F.max(F.when(scored, F.col("psi"))), F.lit(0.0)), 4).alias("max_psi"), F.round(F.coalesce(F.avg(F.when(scored, F.col("jsd"))), F.lit(0.0)), 4).alias("mean_jsd"), F.count("*").alias("total_features_evaluated"),
    )
    total = F.greatest(F.col("total_features_evaluated"), F.lit(1))
    overall = F.when(F.col("total_features_evaluated") == 0, "NO_DATA").when(F.col("critical_count") > 0, "CRITICAL_DRIFT").when(F.col("warning_count") / total > 0.20, "WARNING").otherwise("STABLE")
    return row.select(overall.alias("overall_status"), "*", F.round((F.col("critical_count") + F.col("warning_count")) / total, 4).alias("drift_severity_pct"))


def prediction_drift(baseline: DataFrame, current: DataFrame, score: str, psi_threshold: float = 0.15, jsd_threshold: float = 0.10) -> DataFrame:
    """One row: psi, jsd, means and population deviations of the score, and whether it drifted."""
    values = long_form(baseline, current, [score])
    side = lambda s: F.when(F.col("side") == s, F.col("value"))
    stats = values.groupBy("feature").agg(*[f(side(s)).alias(f"{s}_{k}") for s in ("ref", "cur") for k, f in (("mean", F.avg), ("std", F.stddev_pop))])
    measures = measures_from(value_counts(values)).filter("psi is not null").select("feature", "psi", "jsd")
    joined = measures.join(stats, "feature").drop("feature")
    return joined.withColumn("drifted", (F.col("psi") >= psi_threshold) | (F.col("jsd") >= jsd_threshold))


def label_rate_drift(baseline: DataFrame, current: DataFrame, label: str, threshold: float = 0.30) -> DataFrame:
    """One row: both rates, their relative change and whether it passes the threshold; a zero baseline can't be compared."""
    rate = lambda df, name: df.agg(F.avg(F.col(label).cast("double")).alias(name))
    row = rate(baseline, "baseline_rate").crossJoin(F.broadcast(rate(current, "current_rate")))
    change = F.try_divide(F.abs(F.col("current_rate") - F.col("baseline_rate")), F.col("baseline_rate"))
    return row.select("*", change.alias("relative_change"), F.coalesce(change >= threshold, F.lit(False)).alias("drifted"))


def retrain_decision(summary: DataFrame, prediction: DataFrame, label: DataFrame) -> DataFrame:
    """One row: whether to retrain, why, and the findings as JSON for the history."""
    parts = [df.select(F.struct(*df.columns).alias(name)) for df, name in ((summary, "features"), (prediction, "prediction"), (label, "label"))]
    row = parts[0].crossJoin(F.broadcast(parts[1])).crossJoin(F.broadcast(parts[2]))
    reasons = F.array_compact(F.array(F.when(F.col("features.overall_status") == "CRITICAL_DRIFT", "FEATURE_DRIFT"), F.when(F.col("prediction.drifted"), "PREDICTION_DRIFT"), F.when(F.col("label.drifted"), "LABEL_RATE_DRIFT")))
    return row.select((F.size(reasons) > 0).alias("retrain"), F.array_join(reasons, ",").alias("reason"), F.to_json(F.struct("features", "prediction", "label")).alias("report"))
