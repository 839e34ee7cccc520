"""Models: an unregularised fit against closed-form least squares, splits, save/load."""

from __future__ import annotations

import tempfile

from feeflow.models import regression as ml
from feeflow.plans.queries import REGISTRY
from tests.conftest import SF_SMALL
from tests.oracle_util import duck


def test_ols_matches_sql_regression(spark):
    df = ml.assemble(REGISTRY["tx_fees"](spark, SF_SMALL))
    model = ml.fit_linear(df, ml.FitParams(max_iter=100, reg_param=0.0, elastic_net=0.0))
    slope, intercept = duck(SF_SMALL).execute(
        "WITH f AS (" + __import__("__spark_entry__").oracle_sql()["tx_fees"] + ") "
        "SELECT regr_slope(fee_rate, size), regr_intercept(fee_rate, size) FROM f"
    ).fetchone()
    assert abs(model.coefficients[0] - slope) <= 1e-6 * max(1.0, abs(slope))
    assert abs(model.intercept - intercept) <= 1e-6 * max(1.0, abs(intercept))


def test_hash_split_is_stable(spark):
    df = REGISTRY["tx_fees"](spark, SF_SMALL)
    a, _ = ml.hash_split(df)
    b, _ = ml.hash_split(df.repartition(7))
    assert sorted(r.hash for r in a.collect()) == sorted(r.hash for r in b.collect())


def test_polynomial_terms(spark):
    df = ml.poly_expand(ml.assemble(spark.createDataFrame([(3.0, 1.0)], "size double, fee_rate double")))
    assert list(df.first()["poly_features"]) == [3.0, 9.0]


def test_label_in_features_parity_mode(spark):
    df = ml.assemble(REGISTRY["tx_fees"](spark, SF_SMALL), include_label=True)
    assert df.first()["features"].size == 2


def test_save_load_predicts_the_same(spark):
    df = ml.assemble(REGISTRY["tx_fees"](spark, SF_SMALL))
    model = ml.fit_linear(df, ml.SAVED_MODEL_PARAMS)
    loaded = ml.load(ml.save(model, tempfile.mkdtemp() + "/m"))
    a = {r.hash: r.prediction for r in ml.predict(model, df).collect()}
    b = {r.hash: r.prediction for r in ml.predict(loaded, df).collect()}
    assert a == b


def test_error_summary(spark):
    preds = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0)], "fee_rate double, prediction double")
    r = ml.error_summary(preds).first()
    assert abs(r.rmse - (0.5 ** 0.5)) < 1e-12 and r.mean_label == 2.0 and abs(r.rmse_percent - 35.355339) < 1e-5
    assert abs(ml.rmse(preds) - r.rmse) < 1e-12
