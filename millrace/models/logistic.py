"""One-hot encoded, L2-regularised logistic regression with ``pyspark.ml``."""

from __future__ import annotations

from datetime import date

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.schema import (
    CATEGORICAL,
    CUSTOMER,
    HYPERPARAMETERS,
    NUMERICAL,
    PREDICTION,
    PREDICTION_DATE,
    TARGET,
)
from millrace.sources.exists import remove
from millrace.workspace import stored


def encoder(columns: list[str] = CATEGORICAL) -> list:
    """Stages that turn each column into 0/1 slots, one per category seen in the fit.

    "keep" adds a last slot for everything unseen or NULL, and dropLast removes just that
    slot, so such a value becomes all zeros.
    """
    indexed = [f"{c}_index" for c in columns]
    return [
        StringIndexer(
            inputCols=columns, outputCols=indexed, handleInvalid="keep", stringOrderType="alphabetAsc"
        ),
        OneHotEncoder(inputCols=indexed, outputCols=[f"{c}_hot" for c in columns], dropLast=True),
    ]


def one_hot(fitted_on: DataFrame, df: DataFrame, columns: list[str] = CATEGORICAL) -> DataFrame:
    """Encode ``df`` with the categories of ``fitted_on``; adds ``<column>_hot`` vectors."""
    model = Pipeline(stages=encoder(columns)).fit(fitted_on.select(*columns))
    return model.transform(df).drop(*[f"{c}_index" for c in columns])


def fit(features: DataFrame, parameters: dict | None = None) -> tuple[PipelineModel, int]:
    """Fit on complete rows; returns the model and the number of rows used.

    ``C`` weighs the summed loss against the penalty, Spark weighs the mean loss, hence
    regParam = 1 / (C * n) without feature scaling. The customer is never a feature. The
    feature rows are stored for the time of the fit, because category index, count and
    optimizer all pass over them.
    """
    p = {**HYPERPARAMETERS, **(parameters or {})}
    if p["penalty"] != "l2":
        raise ValueError("only the L2 penalty is supported")
    complete = features.select(*CATEGORICAL, *NUMERICAL, TARGET).dropna(subset=[*NUMERICAL, TARGET])
    rows, path = stored(complete, "fit")
    try:
        n = rows.count()
        if n == 0:
            raise ValueError("no complete rows to fit on")
        assembler = VectorAssembler(
            inputCols=[*[f"{c}_hot" for c in CATEGORICAL], *NUMERICAL],
            outputCol="features",
            handleInvalid="keep",
        )
        regression = LogisticRegression(
            featuresCol="features",
            labelCol=TARGET,
            predictionCol=PREDICTION,
            regParam=1.0 / (p["C"] * n),
            elasticNetParam=0.0,
            standardization=False,
            fitIntercept=p["fit_intercept"],
            maxIter=p["max_iter"],
            tol=p["tol"],
            family="binomial",
        )
        return Pipeline(stages=[*encoder(), assembler, regression]).fit(rows), n
    finally:
        remove(features.sparkSession, path)


def feature_names(model: PipelineModel) -> list[str]:
    """Names of the coefficients, in order."""
    labels = model.stages[0].labelsArray
    hot = [f"{c}={v}" for c, found in zip(CATEGORICAL, labels) for v in found]
    return [*hot, *NUMERICAL]


def coefficients(model: PipelineModel) -> list[tuple[str, float]]:
    """(name, weight) of the intercept and every feature: a fixed, small number of pairs."""
    fitted = model.stages[-1]
    return [("intercept", float(fitted.intercept)), *zip(feature_names(model), map(float, fitted.coefficients))]


def predict(model: PipelineModel, df: DataFrame, as_of: date) -> DataFrame:
    """(customer_number, prediction, probability, prediction_date) for every row.

    The key stays beside the prediction. A row that lacks a numeric feature gets a NULL
    prediction instead of a guess.
    """
    complete = F.lit(True)
    for c in NUMERICAL:
        complete = complete & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    scored = model.transform(df.withColumn("_complete", complete))
    known = F.col("_complete")
    return scored.select(
        CUSTOMER,
        F.when(known, F.col(PREDICTION).cast("int")).alias(PREDICTION),
        F.when(known, vector_to_array("probability")[1]).alias("probability"),
        F.lit(as_of).alias(PREDICTION_DATE),
    )
