"""Prediction sets: Parquet with every column, and two CSV extracts."""

from __future__ import annotations

from pyspark.sql import DataFrame

from rotativa.operators.classify import with_probability_text
from rotativa.sources.headlines import CSV_OPTIONS

# --- fixed values: names of the outputs ---------------------------------------
PREDICTIONS = "predicciones.csv"
PREDICTIONS_WITH_PROBABILITY = "predicciones_prob.csv"
ALL_COLUMNS = "predicciones_parquet"


def save_predictions(predictions: DataFrame, base: str) -> DataFrame:
    """Write the three outputs and return the stored predictions.

    The model is applied once: the Parquet set is written first and the CSV
    extracts are read back from it, column by column.
    """
    predictions.write.mode("overwrite").parquet(f"{base}/{ALL_COLUMNS}")
    stored = predictions.sparkSession.read.parquet(f"{base}/{ALL_COLUMNS}")
    (
        stored.select("clean_text", "label", "prediction")
        .write.mode("overwrite")
        .options(**CSV_OPTIONS)
        .csv(f"{base}/{PREDICTIONS}")
    )
    (
        with_probability_text(stored)
        .select("clean_text", "label", "prediction", "probability_str")
        .write.mode("overwrite")
        .options(**CSV_OPTIONS)
        .csv(f"{base}/{PREDICTIONS_WITH_PROBABILITY}")
    )
    return stored


def save_predictions_by_day(predictions: DataFrame, path: str) -> None:
    """Predictions in one folder per day."""
    days = ["year", "month", "day"]
    (
        predictions.hint("rebalance", *days)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*days)
        .parquet(path)
    )
