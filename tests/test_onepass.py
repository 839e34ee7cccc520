"""One-pass fits against pyspark.ml, and the exact split."""

from __future__ import annotations

import hashlib
import math
import random

import pytest

from feeflow.models import onepass as op
from feeflow.models import regression as ml


@pytest.fixture(scope="module")
def data(spark):
    r = random.Random(4)
    rows = []
    for i in range(3000):
        size = r.randint(1, 300)
        rows.append((str(i), size, 5000.0 / size + 0.02 * size + r.gauss(0, 3)))
    return spark.createDataFrame(rows, "hash string, size long, fee_rate double").repartition(5).cache()


@pytest.mark.parametrize("params", [ml.LINEAR_PARAMS, ml.POLY_PARAMS, ml.FitParams(100, 0.0, 0.0), ml.FitParams(100, 0.3, 0.0), ml.FitParams(100, 40.0, 1.0)])
def test_fit_equals_pyspark_ml(data, params):
    from pyspark.ml.regression import LinearRegression

    features = ("size", "cast(size as double) * size")
    mine = op.fit(data, features, params=params)
    vectors = ml.poly_expand(ml.assemble(data))
    theirs = LinearRegression(
        featuresCol="poly_features", labelCol="fee_rate", maxIter=5000, tol=1e-14, regParam=params.reg_param, elasticNetParam=params.elastic_net
    ).fit(vectors)
    assert math.isclose(mine.intercept, theirs.intercept, rel_tol=1e-6, abs_tol=1e-7)
    assert all(math.isclose(a, b, rel_tol=1e-5, abs_tol=1e-8) for a, b in zip(mine.coefficients, theirs.coefficients, strict=True))
    a = op.errors(data, mine).first()
    b = ml.error_summary(ml.predict(theirs, vectors)).first()
    assert math.isclose(a["rmse"], b["rmse"], rel_tol=1e-7) and a["n"] == b["n"] and math.isclose(a["mean_label"], b["mean_label"], rel_tol=1e-12)
    assert math.isclose(b["rmse"], ml.rmse(ml.predict(theirs, vectors)), rel_tol=1e-12)


def test_fit_without_spread_and_with_nulls(spark):
    rows = [("a", 5, 1.0), ("b", 5, 3.0), ("c", None, 9.0), ("d", 5, None)]
    df = spark.createDataFrame(rows, "hash string, size long, fee_rate double")
    assert op.fit(df, ["size"]) == op.LinearFit(2.0, (0.0,), ("size",))
    same = spark.createDataFrame([("a", 1, 2.0), ("b", 2, 2.0)], "hash string, size long, fee_rate double")
    assert op.fit(same, ["size"]) == op.LinearFit(2.0, (0.0,), ("size",))
    with pytest.raises(ValueError):
        op.fit(df.filter("false"), ["size"])


def test_model_survives_saving(spark, data, tmp_path):
    model = op.fit(data, ["size"])
    assert op.load(spark, op.save(model, spark, str(tmp_path / "m"))) == model


@pytest.mark.parametrize("bits", [2, 15])
def test_exact_split(spark, data, bits, monkeypatch):
    monkeypatch.setattr(op, "LEVEL_BITS", bits)  # few bits: many passes, down to the last ones
    rank = lambda h: int(hashlib.md5(h.encode()).hexdigest()[:15], 16)
    keys = sorted((r.hash for r in data.select("hash").collect()), key=rank)
    for share in (0.0, 0.0005, 0.7, 1.0):
        got = []
        for parts in (1, 9):
            first, rest = op.exact_split(data.repartition(parts), share=share)
            got.append({r.hash for r in first.select("hash").collect()})
            assert first.count() + rest.count() == len(keys) and first.columns == data.columns
        assert got[0] == got[1] == set(keys[: math.floor(share * len(keys))])


def test_exact_split_keeps_a_key_together(spark):
    rows = [("a",)] * 50 + [("b",)] * 50 + [(None,)] * 3
    first, rest = op.exact_split(spark.createDataFrame(rows, "hash string"), share=0.3)
    assert first.count() == 50 and first.distinct().count() == 1
    assert rest.filter("hash is null").count() == 3
    none, all_ = op.exact_split(spark.createDataFrame([], "hash string"))
    assert none.count() == all_.count() == 0
