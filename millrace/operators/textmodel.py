"""Text classification: hashed token counts, IDF and logistic regression, trained on Spark."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.features import tokenize
from millrace.operators.models import without_summary
from millrace.session import spread


def fit_text_classifier(
    df: DataFrame, text: str, label: str, dims: int = 4096, max_iter: int = 20, reg: float = 0.01
) -> PipelineModel:
    ready = tokenize(spread(df), text, "tokens").withColumn("_label", F.col(label).cast("double"))
    stages = [
        HashingTF(inputCol="tokens", outputCol="_tf", numFeatures=dims),
        IDF(inputCol="_tf", outputCol="features"),
        LogisticRegression(featuresCol="features", labelCol="_label", maxIter=max_iter, regParam=reg),
    ]
    fitted = Pipeline(stages=stages).fit(ready)
    without_summary(fitted.stages[-1])
    return fitted


def classify_text(df: DataFrame, model: PipelineModel, text: str) -> DataFrame:
    """Rows with ``prediction`` and nothing else added."""
    made = model.transform(tokenize(df, text, "tokens"))
    return made.select(*df.columns, "prediction")


def label_text(df: DataFrame, model: PipelineModel, text: str, out: str = "sentiment") -> DataFrame:
    """Class 1 is Positive, class 0 Negative."""
    made = classify_text(df, model, text)
    return made.withColumn(out, F.when(F.col("prediction") == 1, "Positive").otherwise("Negative")).drop("prediction")
