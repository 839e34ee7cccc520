"""Elastic-net regression from one pass over the data, and an exact split.

What the fit needs of the data are means, variances and covariances. They are mergeable aggregates
of Spark (stable under any order of merging), so training is one aggregation without a shuffle of
rows, and the optimisation works on a matrix of the number of features, whatever the number of rows.
The objective is that of ``pyspark.ml``'s LinearRegression with standardisation.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feeflow.models.regression import LABEL, LINEAR_PARAMS, FitParams

MODEL = "intercept DOUBLE, coefficients ARRAY<DOUBLE>, features ARRAY<STRING>"
# The hash of a key as a number of so many bits, looked at so many bits at a time.
HASH_BITS, LEVEL_BITS = 60, 15


@dataclass(frozen=True)
class LinearFit:
    """``features`` are SQL expressions over the columns of the scored table."""

    intercept: float
    coefficients: tuple[float, ...]
    features: tuple[str, ...]

    def prediction(self) -> Column:
        out = F.lit(self.intercept)
        for c, x in zip(self.coefficients, self.features, strict=True):
            out = out + F.lit(c) * F.expr(x).cast("double")
        return out

    def as_row(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(self.intercept, list(self.coefficients), list(self.features))], MODEL)


@dataclass(frozen=True)
class Moments:
    n: int
    mean: tuple[float, ...]  # of the features, then of the label
    covariance: tuple[tuple[float, ...], ...]


def moments(df: DataFrame, features: Sequence[str], label: str = LABEL) -> Moments:
    """Means and population covariances of features and label in one aggregation.

    Rows with a null in any of them are skipped, as the assembler does."""
    cols = [F.expr(x).cast("double") for x in (*features, label)]
    k = len(cols)
    whole = df.select(*[c.alias(f"v{i}") for i, c in enumerate(cols)]).dropna()
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    aggs = [F.avg(f"v{i}").alias(f"m{i}") for i in range(k)]
    aggs += [(F.var_pop(f"v{i}") if i == j else F.covar_pop(f"v{i}", f"v{j}")).alias(f"c{i}_{j}") for i, j in pairs]
    row = whole.agg(F.count(F.lit(1)).alias("n"), *aggs).first()
    if not row["n"]:
        raise ValueError("no complete row to fit on")
    cov = tuple(tuple(row[f"c{min(i, j)}_{max(i, j)}"] for j in range(k)) for i in range(k))
    return Moments(row["n"], tuple(row[f"m{i}"] for i in range(k)), cov)


def coordinate_descent(r: Sequence[Sequence[float]], c: Sequence[float], l1: float, l2: float, tol: float = 1e-15, sweeps: int = 200_000) -> list[float]:
    """Minimiser of z'Rz / 2 - c'z + l1 |z| + l2 |z|^2 / 2 for a correlation matrix R."""
    z = [0.0] * len(c)
    for _ in range(sweeps):
        change = 0.0
        for j in range(len(c)):
            rest = c[j] - sum(r[j][k] * z[k] for k in range(len(c)) if k != j)
            new = math.copysign(max(abs(rest) - l1, 0.0), rest) / (1 + l2)
            change, z[j] = max(change, abs(new - z[j])), new
        if change <= tol:
            break
    return z


def fit_moments(m: Moments, features: Sequence[str], params: FitParams = LINEAR_PARAMS) -> LinearFit:
    """M5, converged. A feature without spread gets coefficient 0, a label without spread all of them."""
    k = len(features)
    sd = [math.sqrt(max(0.0, m.covariance[i][i])) for i in range(k + 1)]
    used = [i for i in range(k) if sd[i] > 0 and sd[k] > 0]
    coefficients = [0.0] * k
    if used:
        corr = lambda i, j: 1.0 if i == j else m.covariance[i][j] / (sd[i] * sd[j])
        reg = params.reg_param / sd[k]
        z = coordinate_descent(
            [[corr(i, j) for j in used] for i in used], [corr(i, k) for i in used], params.elastic_net * reg, (1 - params.elastic_net) * reg
        )
        for i, v in zip(used, z, strict=True):
            coefficients[i] = v * sd[k] / sd[i]
    intercept = m.mean[k] - sum(c * x for c, x in zip(coefficients, m.mean, strict=False))
    return LinearFit(intercept, tuple(coefficients), tuple(features))


def fit(df: DataFrame, features: Sequence[str], label: str = LABEL, params: FitParams = LINEAR_PARAMS) -> LinearFit:
    return fit_moments(moments(df, features, label), features, params)


def errors(df: DataFrame, model: LinearFit, label: str = LABEL) -> DataFrame:
    """M6 + M7 + M8 + A9 in one aggregation: rmse, mean_label, rmse_percent, n."""
    err = F.col(label) - model.prediction()
    stats = df.agg(F.sqrt(F.avg(err * err)).alias("rmse"), F.avg(label).alias("mean_label"), F.count(F.lit(1)).alias("n"))
    return stats.withColumn("rmse_percent", F.try_divide("rmse", "mean_label") * 100)


def save(model: LinearFit, spark: SparkSession, path: str) -> str:
    """The model as a one-row table in shared storage."""
    model.as_row(spark).coalesce(1).write.mode("overwrite").parquet(path)
    return path


def load(spark: SparkSession, path: str) -> LinearFit:
    row = spark.read.schema(MODEL).parquet(path).first()
    return LinearFit(row["intercept"], tuple(row["coefficients"]), tuple(row["features"]))


def hash_rank(key: str | Column) -> Column:
    """A key's place in a fixed random order: the first HASH_BITS bits of its MD5."""
    k = F.col(key) if isinstance(key, str) else key
    return F.conv(F.substring(F.md5(k.cast("string")), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def exact_split(df: DataFrame, key: str = "hash", share: float = 0.7) -> tuple[DataFrame, DataFrame]:
    """M4 of exact size: the floor(share * n) rows that come first by ``hash_rank``, and the others.

    The rank at which to cut is found by counting rows in cells of the hash, then in the cell that
    holds the cut, and so on: every pass brings at most 2 ** LEVEL_BITS counts to the driver and nothing
    is sorted. The same rows are taken whatever the partitioning. Rows of one key stay together: if
    the cut falls inside them they all go to the first part. A null key goes to the second part.
    """
    ranked = df.withColumn("__rank", hash_rank(key))
    ranks = ranked.filter(F.col("__rank").isNotNull()).select("__rank")
    left = math.floor(share * df.count())
    prefix, shift, cut = None, HASH_BITS, -1
    while left > 0 and shift > 0:
        inside = ranks if prefix is None else ranks.filter(F.shiftright("__rank", shift) == prefix)
        shift -= LEVEL_BITS
        cells = sorted(inside.groupBy(F.shiftright("__rank", shift).alias("cell")).agg(F.count("*").alias("n"), F.max("__rank").alias("top")).collect())
        for r in cells:
            if left <= r["n"]:
                break
            left -= r["n"]
            cut = r["top"]
        else:
            break  # fewer rows with a key than asked for: all of them
        prefix = r["cell"]
        if left == r["n"]:
            cut, left = r["top"], 0
        elif shift == 0:
            cut = r["top"]
    first = F.coalesce(F.col("__rank") <= cut, F.lit(False))
    return ranked.filter(first).drop("__rank"), ranked.filter(~first).drop("__rank")
