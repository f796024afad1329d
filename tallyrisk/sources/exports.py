"""The six published CSV files of a run, under the names that their readers know.

A file has the run's columns in a fixed order behind a header of published names; it is read back by position into the run's own names
and types (``read_export``).
"""
from __future__ import annotations

import datetime as _dt
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import publish

# Published column names of the exported files (columns not listed keep their names).
PUBLISHED_NAMES = {
    "customer_name": "Customer",
    "supplier_name": "supplier",
    "customer_type": "Customer_type",
    "total_invoice": "Total_Invoice",
    "paid_invoice": "Paid_Invoice",
    "unpaid_invoice": "Unpaid_Invoice",
    "open_ar": "Open_AR",
    "total_ar": "total_AR",
    "aging_balance": "Aging_Balance",
    "outstanding_balance": "Outstanding_Balance",
    "payment_timeliness_ratio": "Payment_Timeliness_Ratio",
    "late_payment_ratio_lt10": "Late_Payment_Ratio_less_10_days",
    "late_payment_ratio_gt10": "Late_Payment_Ratio_more_10_days",
    "payment_cycle": "Payment_Cycle",
    "delinquent_payment_lt10": "Delinquent_Payment_less_10_days",
    "delinquent_overdueday_lt10": "Delinquent_Overdueday_less_10_days",
    "delinquent_payment_gt10": "Delinquent_Payment_more_10_days",
    "delinquent_overdueday_gt10": "Delinquent_Overdueday_more_10_days",
    "suppliers_freq": "Suppliers_freq",
    "timeliness_of_chargeback": "Timeliness_of_chargeback",
    "risk_balance": "Risk_balance",
    "predict_ar_10d": "Predict_AR_10days",
    "predict_ar_30d": "Predict_AR_30days",
    "predicted_10d": "Predict_AR_10days",
    "predicted_30d": "Predict_AR_30days",
    "early_share": "early_payment",
    "lt10_share": "early_payment_before_10",
    "gt10_share": "early_payment_after_10",
    "late_lt10_date": "late_payment_date_before_10",
    "late_gt10_date": "late_payment_date_after_10",
    "score": "Score",
    "level": "Level",
}

# File name of each export.
FILES = {
    "predictions_10d": "Predictor_ten",
    "predictions_30d": "Predictor_thirty",
    "pair_scores": "Customer_Score",
    "customer_weights": "Customer_Parameter_Weights",
    "supplier_scores": "Supplier_Score",
    "supplier_weights": "Supplier_Parameter_Weights",
}
FLAGGED = ("pair_scores", "supplier_scores")


def published_name(column: str) -> str:
    """A weight column is published under its metric's name."""
    return PUBLISHED_NAMES.get(column.removeprefix("w_"), column.removeprefix("w_"))


def with_run_columns(df: DataFrame, name: str, day: _dt.date) -> DataFrame:
    """The run's date, and for scores the flag of an override (none yet when they are exported)."""
    out = df.withColumn("processing_date", F.lit(day))
    return out.withColumn("is_flagged", F.lit(0)) if name in FLAGGED else out


def write_export(df: DataFrame, folder: str, name: str, day: _dt.date) -> T.StructType:
    """Write one export; returns the schema to read it back with."""
    out = with_run_columns(df, name, day)
    renames = {c: published_name(c) for c in out.columns}
    clash = sorted({v for v in renames.values() if list(renames.values()).count(v) > 1})
    if clash:
        raise ValueError(f"export {name}: several columns would be published as {clash}")
    publish.export_csv(out, os.path.join(folder, FILES[name]), renames, index=False)
    return out.schema


def read_export(spark: SparkSession, folder: str, name: str, schema: T.StructType) -> DataFrame:
    return publish.load_csv_positional(spark, os.path.join(folder, FILES[name]), schema, index=False)
