"""A text classifier trained and evaluated with Spark ML: hashed term frequencies, inverse document frequencies, multinomial regression."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer
from pyspark.sql import DataFrame


def train(rows: DataFrame, text: str = "text", label: str = "label", features: int = 1 << 14, rounds: int = 20, penalty: float = 0.01) -> PipelineModel:
    """Fit on rows with a text and a label 0, 1, 2, ...; the regression stops early when its loss no longer falls."""
    sound = rows.where(f"{text} is not null and {label} is not null").select(text, rows[label].cast("double").alias(label))
    stages = [
        RegexTokenizer(inputCol=text, outputCol="_words", pattern=r"[^\p{L}\p{N}]+"),
        HashingTF(inputCol="_words", outputCol="_tf", numFeatures=features),
        IDF(inputCol="_tf", outputCol="_x", minDocFreq=2),
        LogisticRegression(featuresCol="_x", labelCol=label, family="multinomial", maxIter=rounds, regParam=penalty),
    ]
    return Pipeline(stages=stages).fit(sound)


def predict(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """rows with prediction and probability; null texts count as empty."""
    return model.transform(rows.fillna("", [model.stages[0].getInputCol()])).drop("_words", "_tf", "_x", "rawPrediction")


def evaluate(model: PipelineModel, rows: DataFrame, label: str = "label") -> DataFrame:
    """One row: rows, mean loss and accuracy."""
    found = model.transform(rows.where(f"{label} is not null").withColumn(label, rows[label].cast("double")).fillna("", [model.stages[0].getInputCol()])).cache()
    score = lambda name: float(MulticlassClassificationEvaluator(labelCol=label, metricName=name).evaluate(found))
    n = found.count()
    out = rows.sparkSession.createDataFrame([(n, score("logLoss") if n else None, score("accuracy") if n else None)], "n long, loss double, accuracy double")
    found.unpersist()
    return out
