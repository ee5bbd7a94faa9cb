"""Price model: MLlib pipeline, evaluation as one SQL aggregate, coefficients, residuals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import residual
from ..schemas import MODEL_ELASTIC_NET, MODEL_FEATURES, MODEL_LABEL, MODEL_MAX_ITER, MODEL_REG_PARAM
from .clean import existing


def model_frame(df: DataFrame, features: Sequence[str] = MODEL_FEATURES, label: str = MODEL_LABEL,
                keep: Sequence[str] = ()) -> DataFrame:
    """Existing features + label (+ kept columns), rows complete in features and label."""
    feats = existing(df, features)
    cols = list(dict.fromkeys([*feats, label, *existing(df, keep)]))
    return df.select(*cols).na.drop(subset=[*feats, label])


def fit_price_model(train: DataFrame, features: Sequence[str] = MODEL_FEATURES, label: str = MODEL_LABEL,
                    max_iter: int = MODEL_MAX_ITER, reg_param: float = MODEL_REG_PARAM,
                    elastic_net: float = MODEL_ELASTIC_NET) -> PipelineModel:
    """Assemble existing features, standardise (mean and std), ridge regression."""
    feats = existing(train, features)
    pipe = Pipeline(stages=[
        VectorAssembler(inputCols=feats, outputCol="features_raw"),
        StandardScaler(inputCol="features_raw", outputCol="features", withMean=True, withStd=True),
        LinearRegression(featuresCol="features", labelCol=label, maxIter=max_iter,
                         regParam=reg_param, elasticNetParam=elastic_net),
    ])
    return pipe.fit(train)


def predict(model: PipelineModel, test: DataFrame) -> DataFrame:
    return model.transform(test)


def eval_regression(pred: DataFrame, label: str = MODEL_LABEL, prediction: str = "prediction") -> DataFrame:
    """RMSE, R², MAE in one aggregate (R² = 1 − SS_res / SS_tot, SS_tot from a stable variance)."""
    d = pred.filter(F.col(label).isNotNull() & F.col(prediction).isNotNull())
    e = F.col(label) - F.col(prediction)
    return d.agg(F.sqrt(F.avg(e * e)).alias("rmse"),
                 (F.lit(1.0) - F.sum(e * e) / (F.var_pop(label) * F.count(F.lit(1)))).alias("r2"),
                 F.avg(F.abs(e)).alias("mae"), F.count(F.lit(1)).alias("n"))


def model_coefficients(model: PipelineModel, features: Sequence[str]) -> DataFrame:
    """(term, coefficient, raw_coefficient): standardised-space coefficients, intercept and β/σ.

    Only the fitted model's few numbers are on the driver; they become a small frame.
    """
    lr = model.stages[-1]
    scaler = model.stages[1]
    std = list(scaler.std)
    rows = [("intercept", float(lr.intercept), None)]
    for f, c, s in zip(features, lr.coefficients, std):
        rows.append((f, float(c), float(c) / float(s) if s else None))
    spark = SparkSession.getActiveSession()
    schema = T.StructType([T.StructField("term", T.StringType()), T.StructField("coefficient", T.DoubleType()),
                           T.StructField("raw_coefficient", T.DoubleType())])
    return spark.createDataFrame(rows, schema)


def metrics_frame(metrics: DataFrame, coefficients: DataFrame) -> DataFrame:
    """One row: rmse, r2, mae, intercept, coefficients map — the metrics record."""
    coef = coefficients.filter(F.col("term") != "intercept").agg(
        F.map_from_entries(F.collect_list(F.struct("term", "coefficient"))).alias("coefficients"))
    icpt = coefficients.filter(F.col("term") == "intercept").agg(F.first("coefficient"))
    return metrics.select("rmse", "r2", "mae", icpt.scalar().alias("intercept"),
                          coef.scalar().alias("coefficients"))


def residual_frame(pred: DataFrame, label: str = MODEL_LABEL, prediction: str = "prediction") -> tuple[DataFrame, DataFrame]:
    """(actual, predicted, residual) rows and the shared axis limits min − 0.5, max + 0.5."""
    d = pred.select(label, prediction).na.drop()
    rows = d.withColumn("residual", residual(label, prediction))
    lim = d.agg((F.least(F.min(label), F.min(prediction)) - F.lit(0.5)).alias("lim_lo"),
                (F.greatest(F.max(label), F.max(prediction)) + F.lit(0.5)).alias("lim_hi"))
    return rows, lim


def line_predictions(train: DataFrame, test: DataFrame, x: str, y: str) -> DataFrame:
    """Predictions of a least-squares line fitted on ``train`` (the SQL-checkable model)."""
    fit = train.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).agg(
        F.struct(F.regr_slope(y, x).alias("b"), F.regr_intercept(y, x).alias("a")).alias("s")).scalar()
    return test.withColumn("prediction", fit["a"] + fit["b"] * F.col(x))
