"""Feature preparation, training and scoring with MLlib."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import Imputer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanweave.functions.expressions import quoted, ratio
from loanweave.functions.roles import numeric_columns
from loanweave.sources.tables import APPLICANT, BUREAU_LOAN, LABEL, PREVIOUS_LOAN
from loanweave.sources.writers import save_model

SEED = 42
NOT_FEATURES = (LABEL, APPLICANT, BUREAU_LOAN, PREVIOUS_LOAN)


def feature_columns(df: DataFrame, exclude: Iterable[str] = NOT_FEATURES) -> list[str]:
    return numeric_columns(df.schema, "plain", exclude)


def with_ratios(
    df: DataFrame,
    credit: str = "AMT_CREDIT",
    annuity: str = "AMT_ANNUITY",
    income: str = "AMT_INCOME_TOTAL",
) -> DataFrame:
    return df.withColumns(
        {
            "Credit_to_Income": F.expr(ratio(quoted(credit), quoted(income))),
            "Annuity_to_Income": F.expr(ratio(quoted(annuity), quoted(income))),
        }
    )


def scaled_features(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Adds ``features`` and standardised ``scaled_features``; rows with a NULL are left out.

    Fitting reads the data once for all means and deviations.
    """
    assembled = VectorAssembler(
        inputCols=list(columns), outputCol="features", handleInvalid="skip"
    ).transform(df)
    scaler = StandardScaler(
        inputCol="features", outputCol="scaled_features", withMean=True, withStd=True
    )
    return scaler.fit(assembled).transform(assembled)


def application_features(
    df: DataFrame,
    label: str = LABEL,
    key: str = APPLICANT,
    **amounts: str,
) -> DataFrame:
    """Ratios, then all int and double columns but key and label as one scaled vector."""
    enriched = with_ratios(df, **amounts)
    columns = numeric_columns(enriched.schema, "int_double", (label, key))
    return scaled_features(enriched, columns)


def imputed(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Adds ``<c>_imp`` with NULLs replaced by the mean (cut to whole numbers in int columns)."""
    names = list(columns)
    return Imputer(inputCols=names, outputCols=[f"{c}_imp" for c in names]).fit(df).transform(df)


def training_pipeline(features: Sequence[str], classifier: Estimator) -> Pipeline:
    """Mean imputation, one vector, standardisation, classifier."""
    names = [f"{c}_imp" for c in features]
    return Pipeline(
        stages=[
            Imputer(inputCols=list(features), outputCols=names),
            VectorAssembler(inputCols=names, outputCol="raw_features"),
            StandardScaler(
                inputCol="raw_features", outputCol="features", withMean=True, withStd=True
            ),
            classifier,
        ]
    )


# Hyperparameters of both classifiers.
def classifiers(label: str = LABEL) -> dict[str, Estimator]:
    return {
        "LogisticRegression": LogisticRegression(
            labelCol=label, featuresCol="features", maxIter=100, regParam=0.01
        ),
        "RandomForest": RandomForestClassifier(
            labelCol=label, featuresCol="features", numTrees=100, maxDepth=6, seed=SEED
        ),
    }


def split_random(
    df: DataFrame, train: float = 0.8, seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    first, second = df.randomSplit([train, 1 - train], seed=seed)
    return first, second


def probability_gap(first: DataFrame, second: DataFrame, key: str) -> float:
    """Largest difference between the probabilities of label 1 in two scorings of the same rows."""
    one, two = (d.select(key, vector_to_array("probability")[1].alias(n)) for d, n in ((first, "a"), (second, "b")))
    return one.join(two, key).agg(F.coalesce(F.max(F.abs(F.col("a") - F.col("b"))), F.lit(0.0))).first()[0]


def gradient_size(model: PipelineModel, train: DataFrame, label: str = LABEL) -> float:
    """Largest component of the gradient of the penalised mean loss at a fitted logistic
    regression: 0 at the optimum. One aggregate over the training rows."""
    linear = model.stages[-1]
    x = vector_to_array("features")
    off = vector_to_array("probability")[1] - F.col(label)
    penalty = linear.getRegParam()
    parts = [F.avg(off * x[i]) + F.lit(penalty * float(w)) for i, w in enumerate(linear.coefficients.toArray())]
    row = model.transform(train).agg(F.avg(off), *parts).first()
    return max(abs(v) for v in row)


def hash_bucket(key: str, buckets: int = 100) -> Column:
    """Stable bucket of a key, the same on every cluster and in every retry."""
    digest = F.md5(F.col(key).cast("string").cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % buckets


def split_by_key(df: DataFrame, key: str, train_pct: int = 80) -> tuple[DataFrame, DataFrame]:
    """Train and test parts that depend on the key alone; a NULL key goes to training."""
    bucket = F.coalesce(hash_bucket(key), F.lit(0))
    return df.where(bucket < train_pct), df.where(bucket >= train_pct)


def auc(
    predictions: DataFrame, label: str = LABEL, score: str = "rawPrediction", bins: int = 1000
) -> float:
    """Area under the ROC curve; ``bins=0`` is exact, with one curve point per score."""
    return BinaryClassificationEvaluator(
        labelCol=label, rawPredictionCol=score, metricName="areaUnderROC", numBins=bins
    ).evaluate(predictions)


def train_and_evaluate(
    df: DataFrame,
    label: str = LABEL,
    key: str = APPLICANT,
    models: Mapping[str, Estimator] | None = None,
    split: str = "key",
    save_to: str | None = None,
) -> tuple[DataFrame, dict[str, PipelineModel]]:
    """Rows ``(model, auc)`` and the fitted models.

    ``df`` is read once per optimiser pass, so give a stored table, not a long lineage.
    """
    features = feature_columns(df, (*NOT_FEATURES, label, key))
    if split not in ("key", "random"):
        raise ValueError(f"unknown split {split!r}")
    train, test = split_by_key(df, key) if split == "key" else split_random(df)
    fitted, rows = {}, []
    for name, estimator in (models or classifiers(label)).items():
        model = training_pipeline(features, estimator).fit(train)
        rows.append((name, round(auc(model.transform(test), label), 4)))
        fitted[name] = model
        if save_to:
            save_model(model, f"{save_to}/model_{name}")
    return df.sparkSession.createDataFrame(rows, "model STRING, auc DOUBLE"), fitted
