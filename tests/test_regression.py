import pytest
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import RegressionEvaluator

from tallyhouse.operators import regression
from tallyhouse.operators.regression import fit_sales_model, predict_sales, regression_mse
from tallyhouse.plans import queries
from tallyhouse.sources.tables import sales_view


def test_error_equals_the_evaluator_and_nulls_are_dropped(spark):
    sales = sales_view(
        spark,
        "/root/testdata/sf0.001",
        ("transaction_date", "total_sales_amount", "transaction_date_readable", "sales_id"),
    )
    gaps = spark.createDataFrame(
        [(None, None, "x", "1"), (5, None, "y", "2"), (None, 1.0, "z", "3")],
        "transaction_date bigint, total_sales_amount double, transaction_date_readable string, sales_id string",
    )
    model = fit_sales_model(sales.unionByName(gaps))
    predictions = predict_sales(model, sales.unionByName(gaps))
    assert predictions.count() == sales.count()
    assert predictions.columns == [
        "transaction_date_readable",
        "total_sales_amount",
        "prediction",
    ]
    expected = RegressionEvaluator(
        labelCol="total_sales_amount", predictionCol="prediction", metricName="mse"
    ).evaluate(predictions)
    mse = regression_mse(predictions).first().mse
    assert abs(mse - expected) < 1e-6 * expected
    assert model.stages[-1].getNumTrees == 10


@pytest.mark.parametrize("ids", ["cast(id AS string)", "'7'", "cast(NULL AS string)"])
def test_training_rows_of_a_task_do_not_grow_with_all(spark, monkeypatch, ids):
    """On two shuffle partitions, also where all sales have one id or none, and one moment and amount."""
    monkeypatch.setattr(regression, "ROWS_PER_TASK", 1000, raising=False)
    monkeypatch.setattr(Pipeline, "fit", lambda self, rows: rows)
    for n, tasks in ((900, 1), (5000, 5), (20_000, 20)):
        sales = spark.range(n).selectExpr(
            "if(id % 4 = 0, 5, id) AS transaction_date",
            "if(id % 4 = 0, 5, id) AS total_sales_amount",
            "'x' AS transaction_date_readable",
            f"{ids} AS sales_id",
        )
        training = fit_sales_model(sales)
        sizes = training.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()
        assert len(sizes) == tasks and max(sizes) <= 1050
        expected = sorted((5, 5.0) if i % 4 == 0 else (i, float(i)) for i in range(n))
        assert sorted(tuple(r) for r in training.collect()) == expected


@pytest.mark.parametrize("name", ["predict_sales_check", "regression_mse_check", "predict_sales"])
def test_tasks_of_the_fit_follow_the_rows_of_the_tables(spark, monkeypatch, name):
    fits = []
    real = Pipeline.fit
    monkeypatch.setattr(regression, "ROWS_PER_TASK", 1000, raising=False)
    monkeypatch.setattr(queries, "_FITTED", {})
    monkeypatch.setattr(
        Pipeline, "fit", lambda self, rows: fits.append((rows.count(), rows.rdd.getNumPartitions())) or real(self, rows)
    )
    rows = queries.all_queries()[name](spark, "/root/testdata/sf0.001").collect()
    ((n, tasks),) = fits
    assert n > 5000 and tasks == -(-n // 1000)
    assert len(rows) == n or rows[0].n_rows == n and rows[0][-1] is True
