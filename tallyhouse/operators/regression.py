"""Regression of the sales amount on the time of the transaction."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LABEL = "total_sales_amount"
FEATURE = "transaction_date"
MODEL_COLUMNS = (FEATURE, LABEL, "transaction_date_readable")

# Training rows of one task. The learner keeps about 150 bytes of each and reads them once per level.
ROWS_PER_TASK = 250_000


def _labelled(sales: DataFrame) -> DataFrame:
    """Rows with feature and label, both as doubles; others would fail the fit."""
    return sales.where(F.col(FEATURE).isNotNull() & F.col(LABEL).isNotNull()).withColumn(
        LABEL, F.col(LABEL).cast("double")
    )


def _training_rows(sales: DataFrame) -> DataFrame:
    """Feature and label, dealt evenly over as many tasks as their number asks for.

    Training passes over its rows many times and keeps a task's rows as one block, so a task holds no
    more rows when there are more in all, on any number of cores and however the events are spread
    over files or topic partitions. Rows are dealt in turn, not by a key, so many sales of one id,
    moment or amount do not meet in one task; Spark sorts them before, so a task that runs again gives
    the same rows. The count is one more pass over the sales: keep them if they are costly.
    """
    known = _labelled(sales).select(FEATURE, LABEL)
    return known.repartition(max(1, -(-known.count() // ROWS_PER_TASK)))


def fit_sales_model(sales: DataFrame, trees: int = 10, seed: int = 42) -> PipelineModel:
    """Random forest on one feature."""
    forest = RandomForestRegressor(
        labelCol=LABEL, featuresCol="features", numTrees=trees, seed=seed
    )
    assembler = VectorAssembler(
        inputCols=[FEATURE], outputCol="features", handleInvalid="skip"
    )
    return Pipeline(stages=[assembler, forest]).fit(_training_rows(sales))


def predict_sales(model: PipelineModel, sales: DataFrame) -> DataFrame:
    """Readable date, actual amount and predicted amount of each labelled event."""
    return model.transform(_labelled(sales)).select(
        "transaction_date_readable", LABEL, "prediction"
    )


def regression_mse(predictions: DataFrame) -> DataFrame:
    """Mean squared error, one row."""
    error = F.col(LABEL) - F.col("prediction")
    return predictions.agg(F.avg(error * error).alias("mse"))
