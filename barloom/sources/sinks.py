"""Sinks (SNK1–SNK5): features/targets, CV results, run summaries, models and
selected feature names, written as tables (parquet) partitioned for pruning."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def save_xy(X: DataFrame, y: DataFrame, path: str, run_date: str | None = None) -> None:
    """SNK1: X and y under one run date (``run_date=…/part=X|y``); key columns kept."""
    d = run_date or _dt.date.today().isoformat()
    X.withColumn("run_date", F.lit(d)).write.mode("overwrite").partitionBy("run_date").parquet(f"{path}/X")
    y.withColumn("run_date", F.lit(d)).write.mode("overwrite").partitionBy("run_date").parquet(f"{path}/y")


def save_cv_results(cv: DataFrame, path: str, fmt: str = "parquet") -> None:
    """SNK2: the CV result table (one row per candidate)."""
    w = cv.coalesce(1).write.mode("overwrite")  # one row per candidate: a single small file
    (w.option("header", True).csv(path) if fmt == "csv" else w.parquet(path))


def save_run_summary(spark: SparkSession, rows: list[tuple], path: str) -> DataFrame:
    """SNK3: best score and parameters per model (a handful of rows)."""
    df = spark.createDataFrame(rows, "model string, best_score double, best_params string")
    df.coalesce(1).write.mode("overwrite").parquet(path)
    return df


def save_model(model, path: str) -> None:
    """SNK4: MLlib model/pipeline in the MLlib format."""
    model.write().overwrite().save(path)


def load_model(path: str):
    from pyspark.ml import PipelineModel
    return PipelineModel.load(path)


def save_feature_names(spark: SparkSession, names: list[str], path: str) -> DataFrame:
    """SNK5: selected feature names with 0-based positions, plus the ``idx_name,`` text form."""
    df = spark.createDataFrame(list(enumerate(names)), "idx int, name string")
    df.coalesce(1).write.mode("overwrite").parquet(path)
    return df


def feature_names_text(names: list[str]) -> str:
    return "".join(f"{i}_{n}," for i, n in enumerate(names))
