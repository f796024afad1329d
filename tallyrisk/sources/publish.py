"""Sinks: positional CSV loads, snapshot publishing with history, state tables.

All writes are whole-DataFrame writes (no driver loops) and idempotent: a
rerun of the same processing date replaces that date's snapshot instead of
appending duplicates.  Published tables are committed atomically (``store``).
"""
from __future__ import annotations

import datetime as _dt
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .store import Store

INDEX_COL = "_idx"


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh folder under the session's shared checkpoint folder (never a machine-local path on a cluster)."""
    from ..session import ensure_checkpoint_dir
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, *parts, uuid.uuid4().hex)


def export_csv(df: DataFrame, path: str, renames: dict[str, str] | None = None, index: bool = True,
               compression: str = "none") -> None:
    """CSV export with a header; optionally renamed columns and a leading row-id column
    (unique, not consecutive: it is dropped again by the positional loader).  Files that only a load reads are compressed (``"gzip"``)."""
    out = df.withColumnsRenamed(renames) if renames else df
    if index:
        out = out.select(F.monotonically_increasing_id().alias(INDEX_COL), *out.columns)
    out.write.mode("overwrite").option("header", True).option("compression", compression).csv(path)


def load_csv_positional(spark: SparkSession, path: str, schema: T.StructType, index: bool = True) -> DataFrame:
    """Load a CSV by position into named, typed columns; a leading index column is skipped.

    The schema is explicit (no inference pass over the data); unparsable values
    become null instead of failing the load.
    """
    fields = ([T.StructField(INDEX_COL, T.StringType())] if index else []) + list(schema.fields)
    df = (spark.read.schema(T.StructType(fields)).option("header", True).option("mode", "PERMISSIVE")
          .csv(path))
    return df.drop(INDEX_COL) if index else df


def dated_path(path: str, date_col: str, day: _dt.date) -> str:
    return os.path.join(path, f"{date_col}={day.isoformat()}")


def write_partition(df: DataFrame, path: str, date_col: str, day: _dt.date) -> None:
    """Replace one date's folder, also when ``df`` is empty; other dates stay."""
    df.write.mode("overwrite").parquet(dated_path(path, date_col, day))


def read_partition(spark: SparkSession, path: str, date_col: str, day: _dt.date) -> DataFrame:
    """One date's load, with its date column."""
    return spark.read.parquet(dated_path(path, date_col, day)).withColumn(date_col, F.lit(day))


def publish_with_audit(df: DataFrame, base: str, processing_date: _dt.date) -> None:
    """Publish a day's snapshot by one atomic commit (see ``store``); other days stay, a rerun replaces its own."""
    Store(df.sparkSession, base).publish(df, processing_date)


def read_current(spark: SparkSession, base: str) -> DataFrame:
    """The snapshot of the last processing date, with that date."""
    return Store(spark, base).current()


def read_history(spark: SparkSession, base: str) -> DataFrame:
    """The published snapshots of all processing dates."""
    return Store(spark, base).history()


def full_refresh(df: DataFrame, path: str) -> None:
    """Full-snapshot load: truncate and replace."""
    df.write.mode("overwrite").parquet(path)


def append_load(df: DataFrame, path: str, load_date: _dt.date) -> None:
    """Daily append load made idempotent: the load date's partition is replaced."""
    write_partition(df, path, "load_date", load_date)


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def ensure_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read a state table, creating it empty with the given schema if nothing lies at its path.

    A table that is there but cannot be read raises; nothing is ever overwritten.
    """
    if not exists(spark, path):
        spark.createDataFrame([], schema).write.mode("errorifexists").parquet(path)
    return spark.read.schema(schema).parquet(path)


def derive_processing_date(published: DataFrame | None, today: _dt.date) -> _dt.date:
    """Next processing date: the day after the last published run, else yesterday."""
    if published is not None:
        last = published.agg(F.max("processing_date").alias("d")).first()["d"]
        if last is not None:
            return last + _dt.timedelta(days=1)
    return today - _dt.timedelta(days=1)


def constants_upsert(existing: DataFrame, new_values: dict[str, float], processing_date: _dt.date) -> DataFrame:
    """Constants for a processing date: keep a value stored for that date (or a later one),
    refresh a value stored for an earlier date, insert a missing one.

    ``existing`` may hold several rows per id; the latest one is the stored value.
    ``new_values`` are the freshly drawn candidates (injected in tests).
    """
    spark = existing.sparkSession
    stored = (existing.groupBy("id")
              .agg(F.max_by(F.struct("value", "processing_date"), F.struct("processing_date", "value")).alias("s"))
              .select("id", F.col("s.value").alias("old_value"), F.col("s.processing_date").alias("old_date")))
    cand = spark.createDataFrame([(k, float(v)) for k, v in sorted(new_values.items())], ["id", "new_value"])
    j = cand.join(stored, "id", "full")
    D = F.lit(processing_date)
    refresh = F.col("old_date").isNull() | (F.col("old_date") < D)
    return j.select("id",
                    F.when(refresh & F.col("new_value").isNotNull(), F.col("new_value")).otherwise(F.col("old_value"))
                    .alias("value"),
                    F.when(refresh & F.col("new_value").isNotNull(), D).otherwise(F.col("old_date"))
                    .alias("processing_date"))


def draw_constants(processing_date: _dt.date) -> dict[str, float]:
    """Fresh constants for a processing date: c1, c2 uniform in [0, 1), c3..c5 uniform in [-1, 1).

    Seeded by the date, so a rerun of the same day draws the same values (the
    stored values still win, see ``constants_upsert``).
    """
    import random
    rng = random.Random(processing_date.toordinal())
    return {"c1": rng.random(), "c2": rng.random(), "c3": rng.uniform(-1, 1), "c4": rng.uniform(-1, 1),
            "c5": rng.uniform(-1, 1)}
