"""Prediction errors, metrics and chart tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripline.functions.display import percent_text
from tripline.operators.bands import first_rows, numbered
from tripline.operators.sampling import first_by_hash
from tripline.sources.schemas import LABEL

LINE_ROWS = 100
SCATTER_ROWS = 2000


def with_abs_error(predictions: DataFrame, label: str = LABEL) -> DataFrame:
    return predictions.withColumn("abs_error", F.abs(F.col(label) - F.col("prediction")))


def error_margin(predictions: DataFrame, key: str, label: str = LABEL) -> DataFrame:
    """Actual, predicted and error per trip, at 2 dp."""
    return with_abs_error(predictions, label).select(
        key, F.round(label, 2).alias("actual_mins"),
        F.round("prediction", 2).alias("predicted_mins"),
        F.round("abs_error", 2).alias("error_mins"))


def regression_metrics(predictions: DataFrame, label: str = LABEL) -> DataFrame:
    """RMSE, R2 (about the mean) and MAE in one aggregate, unrounded.

    R2 is null for a constant label, where it is not defined.
    """
    y, p = F.col(label), F.col("prediction")
    squared = (y - p) * (y - p)
    spread = F.count(y) * F.var_pop(y)
    return predictions.agg(
        F.sqrt(F.avg(squared)).alias("RMSE"),
        (1 - F.try_divide(F.sum(squared), spread)).alias("R2_Score"),
        F.avg(F.abs(y - p)).alias("MAE"),
    )


def metrics_record(metrics: DataFrame) -> DataFrame:
    """The published record: 2, 4 and 2 dp."""
    return metrics.select(F.round("RMSE", 2).alias("RMSE"),
                          F.round("R2_Score", 4).alias("R2_Score"),
                          F.round("MAE", 2).alias("MAE"))


def metrics_display(record: DataFrame) -> DataFrame:
    """The record with R2 as percent text."""
    return record.withColumn("r2_text", percent_text(F.col("R2_Score")))


def chart_line(predictions: DataFrame, key: str, rows: int = LINE_ROWS,
               label: str = LABEL) -> DataFrame:
    """Actual and predicted of the first trips by key, numbered for a line chart."""
    return numbered(first_rows(predictions, [key], rows), [key]).select(
        "idx", key, F.round(label, 2).alias("actual_mins"),
        F.round("prediction", 2).alias("predicted_mins"))


def chart_scatter(predictions: DataFrame, key: str, rows: int = SCATTER_ROWS,
                  label: str = LABEL) -> DataFrame:
    """Actual and predicted of ``rows`` trips in hash order, or of all if fewer."""
    return first_by_hash(predictions, key, rows, too_few="take").select(
        key, F.round(label, 2).alias("actual_mins"),
        F.round("prediction", 2).alias("predicted_mins"))
