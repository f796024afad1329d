"""Load the driver's parquet tables and build the domain relations on Spark."""
from __future__ import annotations

import hashlib
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import marks, narrowed
from .fixtures import BASE_TABLES, FIXTURES, placeholders, spark_text


def base(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


_RUNS: dict = {}


def _version(spark: SparkSession, sf_dir: str) -> int:
    """Changes with the length and time of any base table's files."""
    path = spark._jvm.org.apache.hadoop.fs.Path(sf_dir)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = []
    for status in fs.listStatus(path):
        for f in (fs.listStatus(status.getPath()) if status.isDirectory() else [status]):
            found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return hash(tuple(sorted(found)))


class Tables:
    """Lazily built domain relations for one data directory.

    Nothing is read until a relation is used; each relation is a lazy plan
    over the parquet scans, so column pruning and filter pushdown reach the
    files.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._cache: dict[str, DataFrame] = {}
        self._made: dict[str, DataFrame] = {}       # relations built here; others in the cache were put there instead
        self._stages: dict[tuple[str, str], DataFrame] = {}

    @classmethod
    def for_run(cls, spark: SparkSession, sf_dir: str) -> "Tables":
        """The shared table context of one scoring run (per Spark application, data folder and input files).

        Stages materialised by one query are reused by the next, as in a
        production run that produces every output table from one pass.  Changed
        input files make a new context.
        """
        key = (spark.sparkContext.applicationId, sf_dir, _version(spark, sf_dir))
        if key not in _RUNS:
            for old in [k for k in _RUNS if k[:2] == key[:2]]:
                del _RUNS[old]
            _RUNS[key] = cls(spark, sf_dir)
        return _RUNS[key]

    def stage(self, name: str, build, params=None) -> DataFrame:
        """Build a reused intermediate once for its parameters and cut its lineage: compressed Parquet in the shared checkpoint folder.

        A lost executor re-reads it instead of recomputing the whole upstream plan, a reader gets the columns it uses, and the
        planner knows its size.
        """
        key = (name, repr(params))
        if key not in self._stages:
            from ..session import ensure_checkpoint_dir
            path = f"{ensure_checkpoint_dir(self.spark).rstrip('/')}/tallyrisk-stages/{name}-{uuid.uuid4().hex}"
            df = build()
            df.write.option("compression", "zstd").parquet(path)
            self._stages[key] = self.spark.read.schema(df.schema).parquet(path)
        return self._stages[key]

    def release(self) -> None:
        """Forget the stages of a finished run."""
        self._stages.clear()

    def source_version(self, *names: str) -> str:
        """Digest of the files behind relations: their paths, lengths and times.  It is the same in every process."""
        found = []
        for table in sorted({b for n in names for b in ([n] if n in BASE_TABLES else placeholders(FIXTURES[n]))}):
            path = self.spark._jvm.org.apache.hadoop.fs.Path(os.path.join(self.sf_dir, f"{table}.parquet"))
            fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
            status = fs.getFileStatus(path)
            found += sorted((f.getPath().toString(), f.getLen(), f.getModificationTime())
                            for f in (fs.listStatus(path) if status.isDirectory() else [status]))
        return hashlib.sha256(repr(found).encode()).hexdigest()

    def base(self, name: str) -> DataFrame:
        key = "base:" + name
        if key not in self._cache:
            self._cache[key] = base(self.spark, self.sf_dir, name)
        return self._cache[key]

    def __getitem__(self, name: str) -> DataFrame:
        if name in BASE_TABLES:
            return self.base(name)
        if name not in self._cache:
            text = spark_text(name)
            kwargs = {t: self.base(t) for t in placeholders(text)}
            self._cache[name] = self._made[name] = conform(self.spark.sql(text, **kwargs), name)
        return self._cache[name]

    def within(self, name: str, start, end) -> DataFrame:
        """A relation of line items dated by their order, for a window of dates: the rows of ``self[name]`` of that window are all there, and few others.

        The order keys of the window's orders are told to the scans; an order whose key repeats with another date is read with them, so that what
        the relation sums by order stays whole.  A relation that was put in the place of this one is returned as it is.
        """
        if name in self._cache and self._cache[name] is not self._made.get(name):
            return self._cache[name]
        dated = self.base("orders").filter(F.col("o_orderdate").cast("date").between(F.lit(start), F.lit(end)))
        marked = self.stage("order_marks", lambda: marks(dated, "o_orderkey"), (start, end))
        text = spark_text(name)
        kwargs = {t: self.base(t) for t in placeholders(text)}
        for table, key in (("orders", "o_orderkey"), ("lineitem", "l_orderkey")):
            kwargs[table] = narrowed(kwargs[table], key, dated, "o_orderkey", marked)
        return conform(self.spark.sql(text, **kwargs), name)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self[name]


#: id and date columns of the loaded dimensions
DIMENSIONS = {
    "crm_customers": (("customer_id", "ndg_id", "customer_type_id"), ()),
    "crm_classes": (("supplier_id", "status_index"), ()),
    "crm_ndg": (("id",), ()),
    "contract_status": (("id", "status_index"), ()),
    "cash_balance": (("id", "status_index"), ()),
    "customer_update_level": (("customer_id",), ()),
    "supplier_update_level": (("supplier_id",), ()),
}


def conform(df: DataFrame, name: str) -> DataFrame:
    """A dimension whose ids or dates arrive as text gets them typed, leniently; columns that are typed already cost nothing."""
    ids, dates = DIMENSIONS.get(name, ((), ()))
    text = {f.name for f in df.schema if f.dataType.simpleString() == "string"}
    ids, dates = ([c for c in cols if c in text] for cols in (ids, dates))
    df = coerce_ids(df, ids) if ids else df
    return coerce_dates(df, dates) if dates else df


def coerce_ids(df: DataFrame, cols) -> DataFrame:
    """Ids that may arrive as text: lenient cast to BIGINT (bad values become null, no error under ANSI)."""
    return df.withColumns({c: F.expr(f"try_cast(CAST({c} AS STRING) AS BIGINT)") for c in cols})


def coerce_dates(df: DataFrame, cols) -> DataFrame:
    """Dates that may arrive as text: lenient cast to DATE (unparsable values become null)."""
    return df.withColumns({c: F.expr(f"try_cast(CAST({c} AS STRING) AS DATE)") for c in cols})
