"""Model building on MLlib, and scoring; nothing is collected but what a model is."""

from __future__ import annotations

import math
from collections.abc import Sequence
from decimal import Decimal

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import PCA, StandardScaler, StringIndexer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def select_columns(df: DataFrame, columns: Sequence[str], most_null: float = 0.95, least_variance: float = 0.01) -> list[str]:
    """The columns with few enough nulls and enough variance (nulls as 0), by one aggregate."""
    row = df.agg(*[x for i, c in enumerate(columns) for x in (F.avg(F.col(c).isNull().cast("double")).alias(f"n{i}"), F.var_pop(F.coalesce(F.col(c).cast("double"), F.lit(0.0))).alias(f"v{i}"))]).first()
    return [c for i, c in enumerate(columns) if (row[f"n{i}"] is not None and row[f"n{i}"] < most_null) and (row[f"v{i}"] or 0.0) > least_variance]


def fit_ordinals(train: DataFrame, columns: Sequence[str]):
    """Indexers of the columns' training values, in alphabetic order."""
    text = train.select(*[F.col(c).cast("string").alias(c) for c in columns])
    return StringIndexer(inputCols=list(columns), outputCols=[f"{c}_idx" for c in columns], stringOrderType="alphabetAsc", handleInvalid="keep").fit(text)


def ordinal_encode(df: DataFrame, model) -> DataFrame:
    """``<c>_idx`` of each column; values not seen in training, and nulls, are -1."""
    columns = model.getInputCols()
    text = df.withColumns({c: F.col(c).cast("string") for c in columns})
    out = model.transform(text)
    sizes = dict(zip(columns, map(len, model.labelsArray), strict=True))
    return out.withColumns({f"{c}_idx": F.when(F.col(f"{c}_idx") >= n, -1).otherwise(F.col(f"{c}_idx")).cast("int") for c, n in sizes.items()})


def train_classifier(train: DataFrame, label: str, features: str = "features", weight: str | None = None, floor: float = 0.70, depths: Sequence[int] = (3, 5), trees: int = 20, seed: int = 42):
    """(model, area under the PR curve on held-out rows, whether it reaches the floor): boosted trees, the depth by validation."""
    gbt = GBTClassifier(labelCol=label, featuresCol=features, maxIter=trees, seed=seed)
    if weight:
        gbt = gbt.setWeightCol(weight)
    judge = BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderPR")
    search = TrainValidationSplit(estimator=gbt, estimatorParamMaps=ParamGridBuilder().addGrid(gbt.maxDepth, list(depths)).build(), evaluator=judge, trainRatio=0.8, seed=seed)
    found = search.fit(train)
    best = max(found.validationMetrics)
    return found.bestModel, best, best >= floor


def anomaly_model(legitimate: DataFrame, features: str = "features", components: int = 3) -> PipelineModel:
    """Scaling and principal components of legitimate rows."""
    return Pipeline(stages=[StandardScaler(inputCol=features, outputCol="scaled", withMean=True, withStd=True), PCA(k=components, inputCol="scaled", outputCol="components")]).fit(legitimate)


def anomaly_score(df: DataFrame, model: PipelineModel, output: str = "anomaly_score") -> DataFrame:
    """Length of what the components leave unexplained, over the length of the scaled row (0 to 1)."""
    out = model.transform(df)
    matrix = model.stages[1].pc.toArray()
    scaled, parts = vector_to_array("scaled"), vector_to_array("components")
    squares = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x * x)
    # The components are orthonormal, so the residual's square is a difference of squares.
    whole = squares(scaled)
    left = F.greatest(F.lit(0.0), whole - squares(parts)) if matrix.size else whole
    return out.withColumn(output, F.when(whole > 0, F.sqrt(left / whole)).otherwise(0.0)).drop("scaled", "components")


def fit_isotonic(df: DataFrame, score: str, label: str):
    return IsotonicRegression(featuresCol="__s", labelCol="__y", isotonic=True).fit(df.select(array_to_vector(F.array(F.col(score).cast("double"))).alias("__s"), F.col(label).cast("double").alias("__y")))


def calibrate(df: DataFrame, model, score: str, output: str = "calibrated") -> DataFrame:
    """Calibrated probabilities in [0, 1]: isotonic, or sigmoid if the model is a logistic one."""
    with_vector = df.withColumn("__s", array_to_vector(F.array(F.col(score).cast("double"))))
    if hasattr(model, "coefficients"):
        return with_vector.withColumn(output, 1 / (1 + F.exp(-(F.lit(float(model.coefficients[0])) * F.col(score) + F.lit(float(model.intercept)))))).drop("__s")
    out = model.setFeaturesCol("__s").setPredictionCol("__p").transform(with_vector)
    return out.withColumn(output, F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("__p")))).drop("__s", "__p")


def fit_sigmoid(df: DataFrame, score: str, label: str):
    rows = df.select(array_to_vector(F.array(F.col(score).cast("double"))).alias("features"), F.col(label).cast("double").alias("label"))
    return LogisticRegression().fit(rows)


def fit_stack(df: DataFrame, scores: Sequence[str], label: str, weight: str | None = None):
    """A logistic model of calibrated scores."""
    rows = df.withColumn("__x", array_to_vector(F.array(*[F.col(s).cast("double") for s in scores])))
    lr = LogisticRegression(featuresCol="__x", labelCol=label)
    return (lr.setWeightCol(weight) if weight else lr).fit(rows)


def stack_scores(df: DataFrame, model, scores: Sequence[str], version: str, output: str = "fraud_probability") -> DataFrame:
    """The final probability and the model's version next to the components."""
    odds = F.lit(float(model.intercept))
    for s, w in zip(scores, model.coefficients, strict=True):
        odds = odds + F.lit(float(w)) * F.col(s)
    return df.withColumns({output: 1 / (1 + F.exp(-odds)), "model_version": F.lit(version)})


def batch_score(df: DataFrame, model, output: str = "score") -> DataFrame:
    """The positive class's probability by a fitted classifier; the model's own columns are dropped."""
    out = model.transform(df)
    return out.withColumn(output, vector_to_array("probability")[1]).drop("rawPrediction", "probability", "prediction")


def shadow_scores(df: DataFrame, champion, challenger, versions: tuple[str, str], key: str = "transaction_id") -> DataFrame:
    """Both models' scores of each row, their difference, an error flag and the versions; one pass, nothing collected."""
    both = batch_score(batch_score(df, champion, "champion_score"), challenger, "challenger_score")
    return both.select(key, "champion_score", "challenger_score", (F.col("challenger_score") - F.col("champion_score")).alias("delta"), ((F.col("champion_score") < 0) | (F.col("challenger_score") < 0)).alias("is_error"), F.lit(versions[0]).alias("champion_version"), F.lit(versions[1]).alias("challenger_version"))


#: Digits that integers of a type have, and that a decimal can hold.
INTEGER_DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 20}
DECIMAL_DIGITS = 38


def _contribution(c: str, kind: str, weight: float, mean: float) -> Column:
    """``weight * (c - mean)``, null as the mean; of integers in exact decimals where they fit, as doubles would part equal contributions."""
    if kind in INTEGER_DIGITS and math.isfinite(weight) and math.isfinite(mean):
        w, m = (Decimal(format(Decimal(repr(float(x))), "f")) for x in (weight, mean))
        (_, dw, sw), (_, dm, sm) = w.as_tuple(), m.as_tuple()
        if max(INTEGER_DIGITS[kind], len(dm) + sm, 1) + 1 - sm + max(len(dw), -sw) + 1 <= DECIMAL_DIGITS:
            return (F.lit(w) * (F.coalesce(F.col(c).cast(f"decimal({INTEGER_DIGITS[kind]},0)"), F.lit(m)) - F.lit(m))).cast("double")
    return F.lit(float(weight)) * (F.coalesce(F.col(c).cast("double"), F.lit(float(mean))) - F.lit(float(mean)))


def top_risk_factors(df: DataFrame, coefficients: dict[str, float], means: dict[str, float], k: int = 5, output: str = "top_risk_factors") -> DataFrame:
    """The k features that raise a linear model's score most: coefficient times distance from the mean, positive ones only.

    Equal contributions come in the order of the coefficients. Of more than k, those are held that
    one pass in that order leaves: a feature goes in for the first of the least held if it exceeds that.
    """
    kinds = [kind for _, kind in df.select(*coefficients).dtypes]
    parts = F.array(*[F.struct(_contribution(c, kinds[i], w, means[c]).alias("contribution"), F.lit(i).alias("place"), F.lit(c).alias("feature")) for i, (c, w) in enumerate(coefficients.items())])

    def held(best: Column, x: Column) -> Column:
        least = F.array_min(best)
        return F.when(F.size(best) < k, F.concat(best, F.array(x))).when(x["contribution"] > least["contribution"], F.concat(F.filter(best, lambda y: y["place"] != least["place"]), F.array(x))).otherwise(best)

    none = F.array().cast("array<struct<contribution:double,place:int,feature:string>>")
    best = F.aggregate(F.filter(parts, lambda x: x["contribution"] > 0), none, held)
    ordered = F.reverse(F.array_sort(F.transform(best, lambda x: F.struct(x["contribution"], (-x["place"]).alias("place"), x["feature"]))))
    return df.withColumn(output, F.transform(ordered, lambda x: F.struct(x["contribution"].alias("contribution"), x["feature"].alias("feature"))))
