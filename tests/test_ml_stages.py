"""Pipeline stages: parity with the plain operators, MLlib's own stages, persistence."""

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.linalg import SparseVector
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from hourprofile.operators import ml
from hourprofile.operators import model as M
from hourprofile.plans import queries as Q
from hourprofile.session import materialize
from hourprofile.spec import TEST_OBS

from conftest import SF_SMALL

CATS, VOLUMES, HOUR = list(TEST_OBS.categoricals), list(TEST_OBS.volumes), 8


@pytest.fixture(scope="module")
def rows(spark):
    return materialize(Q.training_rows(spark, SF_SMALL), "ml-rows")


def test_stages_in_a_pipeline(spark, rows, tmp):
    enc, _, k = Q._encoded(spark, SF_SMALL)
    plain = M.predict(M.design(enc, CATS, VOLUMES, keep=("id", "date")), M.rule_models(spark, k), HOUR, back_transform=False)
    want = {(r.id, r.date): r.predicted for r in plain.select("id", "date", "predicted").collect()}
    stages = Pipeline(stages=[ml.CategoryEncoder(inputCols=CATS), ml.HourFeatures(fields=CATS, volumes=VOLUMES, hour=HOUR)])
    stages.write().overwrite().save(tmp + "/pipeline")
    fitted = Pipeline.load(tmp + "/pipeline").fit(rows)
    whole = PipelineModel([*fitted.stages, ml.HourModels(M.rule_models(spark, k), HOUR)])
    whole.write().overwrite().save(tmp + "/model")
    out = PipelineModel.load(tmp + "/model").transform(rows)
    got = {(r.id, r.date): r for r in out.select("id", "date", "prediction", "features", "label").collect()}
    assert got.keys() == want.keys() and all(abs(got[x].prediction - want[x]) < 1e-9 for x in want)
    one = next(iter(got.values())).features
    assert isinstance(one, SparseVector) and one.size == k + 23 and len(one.indices) == len(CATS) + 23


def test_mllib_fits_on_the_features(spark, rows):
    pipe = Pipeline(stages=[ml.CategoryEncoder(inputCols=CATS), ml.HourFeatures(fields=CATS, volumes=VOLUMES, hour=HOUR),
                            LinearRegression(regParam=0.01, maxIter=20)])
    fitted = pipe.fit(rows)
    rmse = np.sqrt(fitted.transform(rows).agg(F.avg(F.pow(F.col("prediction") - F.col("label"), 2))).first()[0])
    sd = rows.agg(F.stddev(F.log(F.col("v08").cast("double") + 0.01))).first()[0]
    assert rmse < sd


def test_unseen_values(spark, rows):
    cut = ml.CategoryEncoder(inputCols=["date"], unseen="skip").fit(rows.where("date < '2024-01-10'"))
    assert cut.transform(rows).count() == rows.where("date < '2024-01-10'").count()
    with pytest.raises(ValueError, match="no levels"):
        ml.HourFeatures(fields=["date"], volumes=VOLUMES, hour=0).transform(rows.withColumn("pos_date", F.lit(0)))
