"""Fee-rate regression (M1-M8, K12) on ``pyspark.ml``.

Fitting is distributed: each optimiser step is one aggregation over the
partitions, only the coefficient vector travels to the driver. Scores and errors
are DataFrame aggregations; nothing is collected row by row.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import MinMaxScaler, PolynomialExpansion, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LABEL = "fee_rate"


@dataclass(frozen=True)
class FitParams:
    max_iter: int
    reg_param: float
    elastic_net: float


# The settings of the original model jobs.
LINEAR_PARAMS = FitParams(max_iter=100, reg_param=0.5, elastic_net=0.5)
POLY_PARAMS = FitParams(max_iter=20, reg_param=0.3, elastic_net=0.8)
SAVED_MODEL_PARAMS = FitParams(max_iter=10, reg_param=0.3, elastic_net=0.8)
TRAIN_PERCENT = 70
SPLIT_WEIGHTS = (0.7, 0.3)
SPLIT_SEED = 123
POLY_DEGREE = 2


def assemble(
    df: DataFrame, inputs: Sequence[str] = ("size",), out: str = "features", include_label: bool = False
) -> DataFrame:
    """M1: assemble numeric columns into a feature vector.

    ``include_label`` reproduces the original training job, whose features also
    held the label (the fit then trivially predicts the label from itself).
    """
    cols = list(inputs) + ([LABEL] if include_label and LABEL not in inputs else [])
    return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid="skip").transform(df)


def poly_expand(df: DataFrame, degree: int = POLY_DEGREE, inp: str = "features", out: str = "poly_features") -> DataFrame:
    """M2: polynomial expansion; degree 2 of [s] is [s, s^2]."""
    return PolynomialExpansion(degree=degree, inputCol=inp, outputCol=out).transform(df)


def minmax_scale(df: DataFrame, inp: str = "features", out: str = "scaledFeatures") -> DataFrame:
    """M3: rescale every feature to [0, 1] (min and max found in one pass)."""
    return MinMaxScaler(inputCol=inp, outputCol=out).fit(df).transform(df)


def split_bucket(key: str | Column) -> Column:
    """A stable bucket 0..99 of a key: the first 32 bits of its MD5, mod 100."""
    k = F.col(key) if isinstance(key, str) else key
    return F.pmod(F.conv(F.substring(F.md5(k.cast("string")), 1, 8), 16, 10).cast("bigint"), F.lit(100))


def hash_split(df: DataFrame, key: str = "hash", train_percent: int = TRAIN_PERCENT) -> tuple[DataFrame, DataFrame]:
    """M4, reproducible: the same row lands in the same split whatever the partitioning."""
    train = split_bucket(key) < train_percent
    return df.filter(train), df.filter(~train)


def random_split(df: DataFrame, weights=SPLIT_WEIGHTS, seed: int = SPLIT_SEED) -> list[DataFrame]:
    """M4 as in the original job (depends on partitioning, so not reproducible across layouts)."""
    return df.randomSplit(list(weights), seed=seed)


def fit_linear(train: DataFrame, params: FitParams = LINEAR_PARAMS, features: str = "features") -> LinearRegressionModel:
    """M5: elastic-net linear regression."""
    lr = LinearRegression(
        featuresCol=features,
        labelCol=LABEL,
        maxIter=params.max_iter,
        regParam=params.reg_param,
        elasticNetParam=params.elastic_net,
    )
    return lr.fit(train)


def coefficients(model: LinearRegressionModel, df: DataFrame) -> DataFrame:
    """The fitted intercept and coefficients as one row (c0, c1, ...)."""
    coefs = [float(c) for c in model.coefficients]
    return df.sparkSession.range(1).select(
        F.lit(float(model.intercept)).alias("intercept"),
        *[F.lit(c).alias(f"c{i}") for i, c in enumerate(coefs)],
    )


def predict(model: LinearRegressionModel, df: DataFrame) -> DataFrame:
    """M6."""
    return model.transform(df)


def rmse(predictions: DataFrame) -> float:
    """M7 through the evaluator (one distributed aggregation)."""
    return RegressionEvaluator(predictionCol="prediction", labelCol=LABEL, metricName="rmse").evaluate(predictions)


def error_summary(predictions: DataFrame) -> DataFrame:
    """M7 + M8 + A9 as one aggregation: rmse, mean label, rmse as percent of the mean."""
    err = F.col(LABEL) - F.col("prediction")
    stats = predictions.agg(
        F.sqrt(F.avg(err * err)).alias("rmse"),
        F.avg(LABEL).alias("mean_label"),
        F.count(F.lit(1)).alias("n"),
    )
    return stats.withColumn("rmse_percent", F.try_divide(F.col("rmse"), F.col("mean_label")) * 100)


def feature_columns(df: DataFrame, vec: str, names: Sequence[str]) -> list[Column]:
    arr = vector_to_array(F.col(vec))
    return [arr[i].alias(n) for i, n in enumerate(names)]


def save(model: LinearRegressionModel, path: str) -> str:
    """Persist the model (metadata and coefficients) to shared storage."""
    model.write().overwrite().save(path)
    return path


def load(path: str) -> LinearRegressionModel:
    return LinearRegressionModel.load(path)
