"""Daily runs chained through stored state.

A run takes its date, constants and reason weights from what earlier runs published, and publishes its own: the processing date is the day after
the last published one; the constants are those stored for the date, or stored before and drawn anew, or drawn first; the reason weights are the
weights published by the run before, laid over the input's.  State is read as of the run's date, so running a day again gives that day's
result and changes no other day.
"""
from __future__ import annotations

import dataclasses
import datetime as _dt
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..params import DEFAULT, Params
from ..sources import publish
from ..sources.store import Store
from ..sources.tables import Tables
from .pipeline import run_scoring

#: the table whose last published day says how far the runs have come
CLOCK = "agg_customer_score"
CONSTANTS_SCHEMA = "id string, value double, processing_date date"


def merge_by_key(old: DataFrame, new: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Rows of both, one for each key; ``new`` wins where both have it."""
    rows = old.select(*keys, value, F.lit(0).alias("_new")).unionByName(new.select(*keys, value, F.lit(1).alias("_new")))
    return rows.groupBy(*keys).agg(F.max_by(value, F.struct("_new", value)).alias(value))


class State:
    """What runs leave for later runs, in the folder that they publish to."""

    def __init__(self, spark: SparkSession, out_dir: str):
        self.spark, self.out_dir = spark, out_dir

    def store(self, name: str) -> Store:
        return Store(self.spark, os.path.join(self.out_dir, name))

    def next_date(self, today: _dt.date) -> _dt.date:
        """The day after the last published run; yesterday if there is none."""
        last = self.store(CLOCK).last_day()
        return (last if last is not None else today - _dt.timedelta(days=2)) + _dt.timedelta(days=1)

    def constants(self, day: _dt.date, first: DataFrame | None = None, drawn: dict[str, float] | None = None) -> DataFrame:
        """The constants of a day, stored for it; ``first`` is what counts as stored before the first run."""
        store = self.store("constant_values")
        found = store.as_of(day)
        # the snapshot's own date column is the day it was stored on; a value's date is kept beside it
        before = (found.select("id", "value", F.col("value_date").alias("processing_date")) if found is not None
                  else first if first is not None else self.spark.createDataFrame([], CONSTANTS_SCHEMA))
        now = publish.constants_upsert(before, drawn or publish.draw_constants(day), day)
        store.publish(now.select("id", "value", F.col("processing_date").alias("value_date")), day)
        return store.read(day).select("id", "value", F.col("value_date").alias("processing_date"))

    def reasons(self, entity: str, given: DataFrame, day: _dt.date) -> DataFrame:
        """Reason weights for a day's run: those published before the day over the input's."""
        before = self.store(f"{entity}_reason").before(day)
        key = [f"{entity}_id", "reason"]
        return given if before is None else merge_by_key(given, before, key, "weight")


def run_day(spark: SparkSession, t: Tables, out_dir: str, today: _dt.date, p: Params = DEFAULT, day: _dt.date | None = None,
            first_constants: DataFrame | None = None) -> tuple[_dt.date, dict[str, str]]:
    """The next day's run (or ``day`` again); returns its date and the published tables."""
    state = State(spark, out_dir)
    day = day or state.next_date(today)
    constants = {r.id: r.value for r in state.constants(day, first_constants).collect()}   # 5 rows
    p = dataclasses.replace(p, processing_date=day, constants=constants)
    reasons = {e: state.reasons(e, t[f"{e}_reason"], day) for e in ("customer", "supplier")}
    return day, run_scoring(spark, t, out_dir, p, reasons=reasons)
