"""Profiling of the fee table.

Everything is one distributed aggregation; nothing is collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feeflow.functions import rate_cents

# The plotted range of the original scatter plot and its bins.
SIZE_RANGE = (100, 1000)
RATE_RANGE = (0, 100)
SIZE_BIN = 100
RATE_BIN = 10
STAT_DIGITS = 4


def describe_fees(fees: DataFrame) -> DataFrame:
    """A10: count, mean, stddev, min, max of size, fee and fee_rate.

    One aggregation pass, then a 5-row unpivot. Means are computed from exact
    integer sums (fee_rate in hundredths) so they do not depend on merge order;
    standard deviations are rounded to 4 digits.
    """
    n = F.count(F.lit(1)).cast("double")

    def mean_of(total):
        return F.try_divide(total.cast("double"), n)

    stats = fees.agg(
        F.count(F.lit(1)).cast("double").alias("count_"),
        mean_of(F.sum("size")).alias("mean_size"),
        mean_of(F.sum("fee")).alias("mean_fee"),
        F.try_divide(F.sum(rate_cents("fee_rate")).cast("double"), n * 100.0).alias("mean_fee_rate"),
        F.round(F.stddev_samp("size"), STAT_DIGITS).alias("sd_size"),
        F.round(F.stddev_samp("fee"), STAT_DIGITS).alias("sd_fee"),
        F.round(F.stddev_samp("fee_rate"), STAT_DIGITS).alias("sd_fee_rate"),
        F.min("size").cast("double").alias("min_size"),
        F.min("fee").cast("double").alias("min_fee"),
        F.min("fee_rate").alias("min_fee_rate"),
        F.max("size").cast("double").alias("max_size"),
        F.max("fee").cast("double").alias("max_fee"),
        F.max("fee_rate").alias("max_fee_rate"),
    )
    return stats.select(
        F.expr(
            "stack(5,"
            " 'count', count_, count_, count_,"
            " 'mean', mean_size, mean_fee, mean_fee_rate,"
            " 'stddev', sd_size, sd_fee, sd_fee_rate,"
            " 'min', min_size, min_fee, min_fee_rate,"
            " 'max', max_size, max_fee, max_fee_rate)"
            " AS (summary, size, fee, fee_rate)"
        )
    )


def size_fee_corr(fees: DataFrame) -> DataFrame:
    """Pearson correlation of size and fee rate, with the row count."""
    return fees.agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.corr(F.col("size").cast("double"), F.col("fee_rate")), 6).alias("corr_size_fee_rate"),
    )


def size_fee_histogram(
    fees: DataFrame, size_range=SIZE_RANGE, rate_range=RATE_RANGE, size_bin: int = SIZE_BIN, rate_bin: int = RATE_BIN
) -> DataFrame:
    """A17 + F2: 2-D bin counts of (size, fee_rate) inside the plotted range."""
    inside = fees.filter(F.col("size").between(*size_range) & F.col("fee_rate").between(*rate_range))
    return inside.groupBy(
        (F.floor(F.col("size") / size_bin) * size_bin).cast("int").alias("size_bin"),
        (F.floor(F.col("fee_rate") / rate_bin) * rate_bin).cast("int").alias("rate_bin"),
    ).agg(F.count(F.lit(1)).alias("n_tx"))


def volume_by_time(outputs: DataFrame) -> DataFrame:
    """Distinct (hash, out_addr, out_value, time) outputs, summed per time."""
    dist = outputs.select("hash", "out_addr", "out_value", "time").distinct()
    return dist.groupBy("time").agg(
        F.count(F.lit(1)).alias("n_outputs"),
        F.sum("out_value").alias("volume_sat"),
    )
