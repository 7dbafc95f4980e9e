"""Model quality as aggregations; no scores are collected."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ranges import PART, previous_rows, running_sums
from ..functions.tails import fair_tail


def score_counts(df: DataFrame, scores: Sequence[str], label: str = "is_fraud") -> DataFrame:
    """(model, score, pos, neg) of all models in one scan; null scores and labels are left out."""
    models = F.explode(F.array(*[F.struct(F.lit(s).alias("model"), F.col(s).cast("double").alias("score")) for s in scores])).alias("x")
    return df.filter(F.col(label).isNotNull()).select(F.col(label).alias("y"), models).filter("x.score is not null").groupBy("x.model", "x.score").agg(F.count_if(F.col("y") == 1).alias("pos"), F.count_if(F.col("y") == 0).alias("neg"))


def pr_curve(df: DataFrame, scores: Sequence[str], label: str = "is_fraud") -> DataFrame:
    """(model, score, tp, fp, p, n, precision, recall, fpr) at every distinct score, as the least one that is flagged.

    Sums run within ranges of the score and over the ranges' totals, so that
    many distinct scores don't meet in one task.
    """
    return _curve(df, scores, label).drop(PART)


def _curve(df: DataFrame, scores: Sequence[str], label: str) -> DataFrame:
    summed = running_sums(score_counts(df, scores, label), "model", "score", {"pos": "tp", "neg": "fp"}, down=True)
    totals = summed.groupBy("model").agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    tp, fp = F.col("tp"), F.col("fp")
    return summed.join(F.broadcast(totals), "model").select("model", "score", PART, "tp", "fp", "p", "n", (tp / (tp + fp)).alias("precision"), F.try_divide(tp, F.col("p")).alias("recall"), F.try_divide(fp, F.col("n")).alias("fpr"))


def _with_previous(df: DataFrame, scores: Sequence[str], label: str, *columns: str) -> DataFrame:
    """The curve, each point with the one before it, of lower recall."""
    return previous_rows(_curve(df, scores, label), "model", "score", columns, down=True)


def pr_summary(df: DataFrame, scores: Sequence[str], label: str = "is_fraud") -> DataFrame:
    """(model, pr_auc, average_precision): the trapezoid area, from precision 1 at recall 0, and the step sum."""
    curve = _with_previous(df, scores, label, "precision", "recall")
    step = F.col("recall") - F.coalesce("prev_recall", F.lit(0.0))
    area = step * (F.col("precision") + F.coalesce("prev_precision", F.lit(1.0))) / 2
    return curve.groupBy("model").agg(F.sum(area).alias("pr_auc"), F.sum(step * F.col("precision")).alias("average_precision"))


def operating_points(df: DataFrame, scores: Sequence[str], label: str = "is_fraud", rates: Sequence[float] = (0.01, 0.05)) -> DataFrame:
    """(model, recall_at_fpr_<percent>..., best_f1, best_threshold); recall is interpolated on the ROC."""
    curve = _with_previous(df, scores, label, "recall", "fpr").fillna(0.0, ["prev_recall", "prev_fpr"])
    out = []
    for rate in rates:
        crosses = (F.col("prev_fpr") <= rate) & (F.col("fpr") >= rate)
        share = F.coalesce(F.try_divide(F.lit(rate) - F.col("prev_fpr"), F.col("fpr") - F.col("prev_fpr")), F.lit(1.0))
        at = F.when(crosses, F.col("prev_recall") + (F.col("recall") - F.col("prev_recall")) * share)
        out.append(F.max(at).alias(f"recall_at_fpr_{round(100 * rate)}"))
    f1 = F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), F.lit(0.0))
    return curve.groupBy("model").agg(*out, F.max(f1).alias("best_f1"), F.max_by("score", F.struct(f1, F.col("score"))).alias("best_threshold"))


def champion_challenger(df: DataFrame, champion: str = "champion", challenger: str = "challenger", label: str = "is_fraud", cut: float = 0.5, high_amount: float = 5000.0) -> DataFrame:
    """One row of both models' measures and the three gates, and whether the challenger passes them all."""
    area = pr_summary(df, [champion, challenger], label).groupBy().agg(*[F.max(F.when(F.col("model") == m, F.col("pr_auc"))).alias(f"{k}_pr_auc") for k, m in (("champion", champion), ("challenger", challenger))])
    y, high = F.col(label), F.col("amount") > high_amount
    rates = []
    for k, m in (("champion", champion), ("challenger", challenger)):
        flagged = F.col(m) >= cut
        rates.append(F.try_divide(F.count_if(flagged & (y == 0)), F.count_if(y == 0)).alias(f"{k}_fpr"))
        rates.append(F.try_divide(F.count_if(flagged & high & (y == 1)), F.count_if(high & (y == 1))).alias(f"{k}_high_recall"))
    row = area.crossJoin(F.broadcast(df.agg(*rates)))
    gates = {
        "pr_auc_gate": F.col("challenger_pr_auc") >= F.col("champion_pr_auc") - 0.005,
        "high_recall_gate": F.col("champion_high_recall").isNull() | (F.col("challenger_high_recall") >= F.col("champion_high_recall") - 0.01),
        "fpr_gate": F.col("challenger_fpr") <= F.col("champion_fpr") * 1.05,
    }
    row = row.select("*", *[F.coalesce(g, F.lit(False)).alias(n) for n, g in gates.items()])
    return row.withColumn("promote", F.col("pr_auc_gate") & F.col("high_recall_gate") & F.col("fpr_gate"))


def mcnemar(df: DataFrame, champion: str = "champion", challenger: str = "challenger", label: str = "is_fraud", cut: float = 0.5) -> DataFrame:
    """One row: b (only the champion is right), c (only the challenger), and the exact two-sided binomial p.

    The tail is a continued fraction, so any number of differing rows takes the same memory.
    """
    right = lambda s: (F.col(s) >= cut) == (F.col(label) == 1)
    row = df.agg(F.count_if(right(champion) & ~right(challenger)).alias("b"), F.count_if(~right(champion) & right(challenger)).alias("c"))
    n, k = F.col("b") + F.col("c"), F.least("b", "c")
    return row.select("b", "c", F.when(2 * k >= n, 1.0).otherwise(F.least(F.lit(1.0), 2 * fair_tail(n, k))).alias("p_value"))


def rollback_check(telemetry: DataFrame, fpr_factor: float = 2.0, recall_factor: float = 0.8) -> DataFrame:
    """One row: whether the model must go back, and why."""
    fpr = F.coalesce(F.col("recent_fpr") > fpr_factor * F.col("baseline_fpr"), F.lit(False))
    recall = F.coalesce(F.col("recent_recall") < recall_factor * F.col("baseline_recall"), F.lit(False))
    return telemetry.select("*", (fpr | recall).alias("rollback"), F.concat_ws(",", F.when(fpr, "FPR"), F.when(recall, "RECALL")).alias("reasons"))
