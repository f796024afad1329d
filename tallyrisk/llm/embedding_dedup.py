"""Embedding near-dedup: random-hyperplane sign hashing in several tables, exact cosine, connected components.

* Vectors that are equal element by element form one class; classes, not vectors, are compared.
* Each class gets ``tables`` signatures of ``bits`` hyperplane signs.  Classes that agree in a table share a bucket.  The number of
  bits follows the number of classes (buckets keep their mean size as data grow), and the number of tables is the smallest
  that finds a pair *at* the threshold with probability ``recall``; more similar pairs are found more surely.
* Buckets are cut into blocks of at most about ``block`` classes by hash, and each pair of blocks is one group: a hot bucket
  becomes many groups, none larger than two blocks.  In a group all pairs are verified by the exact cosine in double precision.
  A pair that meets in several tables counts in the first only (each row carries all its signatures).
* A group emits no pairs: it emits one partial link count for each class and a spanning forest of its links, so output
  stays linear.  Counts are summed; the forests go to distributed connected components.

The class with the smallest vec_id of a component gives ``component_id``.  Class members count as links of each other.

Defined results: vectors that are null, empty, zero or hold null or non-finite components link with nothing and are kept; vectors of
unlike length never link; rows with equal vec_id are one vector if equal (reported once for each row) and are separate class
members otherwise; null vec_ids get ``component_id`` null, no links, and are kept; empty tables give empty results; labels and extra columns
are ignored.
"""
from __future__ import annotations

from collections.abc import Iterator
from math import acos, ceil, log, log2, pi

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, column, list_column, row_groups
from .components import connected_components

THRESHOLD = 0.9
RECALL = 0.999
BUCKET = 256     # aimed-at mean bucket size
BLOCK = 1024
SEED = 20177
MIN_BITS, MAX_BITS = 6, 30


def plan_tables(n: int, threshold: float, recall: float) -> tuple[int, int]:
    """Bits for each signature and number of tables for n classes."""
    bits = int(min(MAX_BITS, max(MIN_BITS, ceil(log2(max(2, n / BUCKET))))))
    found = (1 - acos(threshold) / pi) ** bits
    return bits, ceil(log(1 - recall) / log(1 - found))


def planes(dim: int, bits: int, tables: int) -> np.ndarray:
    return np.random.default_rng([SEED, dim]).standard_normal((dim, bits * tables))


def signatures(vectors: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """(rows, tables) int32 signatures."""
    signs = (vectors @ planes(vectors.shape[1], bits, tables) >= 0).reshape(len(vectors), tables, bits)
    return (signs * (1 << np.arange(bits, dtype=np.int64))).sum(axis=2).astype(np.int32)


def usable(col: Column) -> Column:
    """Vectors that take part: not null, no null or non-finite component, not zero."""
    finite = F.forall(col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(col.isNotNull() & finite & F.exists(col, lambda x: x != 0), F.lit(False))


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _matrices(batch, name: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix) for every vector length in the batch."""
    values, offsets = list_column(batch, name)
    lengths = np.diff(offsets)
    for dim in np.unique(lengths):
        rows = np.flatnonzero(lengths == dim)
        yield rows, values[offsets[rows][:, None] + np.arange(dim)]


def _hashed(bits: int, tables: int, whole_rows: bool):
    """One row for each class and table; with ``whole_rows`` also the vector and all signatures."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for given in batches:
            for at in range(0, given.num_rows, 1024):
                batch = given.slice(at, 1024)
                for rows, x in _matrices(batch, "embedding"):
                    n, s = len(rows), signatures(_unit(x), bits, tables)
                    rep = pa.array(np.repeat(np.arange(n), tables))
                    out = {"t": pa.array(np.tile(np.arange(tables, dtype=np.int32), n)), "sig": pa.array(s.ravel()),
                           "dim": pa.array(np.full(n * tables, x.shape[1], np.int32))}
                    if whole_rows:
                        out |= {k: pa.array(column(batch, k)[rows]).take(rep) for k in ("class_id", "copies")}
                        out |= {k: pa.array([r.tobytes() for r in v], pa.binary()).take(rep) for k, v in (("vec", x), ("sigs", s))}
                    yield pa.RecordBatch.from_pydict(out)
    return run


def _verify(threshold: float, kind: type):
    """Over rows sorted by group: partial link counts and a spanning forest of each group's links."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("weight", pa.int64())])
    keys = ["t", "sig", "dim", "lo", "hi"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole, starts in row_groups(batches, keys):
            a_out, b_out, w_out = [], [], []
            ids, size, home = column(whole, "class_id"), column(whole, "copies"), column(whole, "home")
            t, lo, hi, dims = (column(whole, k) for k in ("t", "lo", "hi", "dim"))
            vecs, sigs = column(whole, "vec"), column(whole, "sigs")
            for s, e in zip(starts[:-1], starts[1:]):
                if e - s < 2:
                    continue
                x = _unit(np.frombuffer(b"".join(vecs[s:e]), kind).reshape(e - s, dims[s]))
                sig = np.frombuffer(b"".join(sigs[s:e]), np.int32).reshape(e - s, -1)
                cos = x @ x.T
                first, second = np.nonzero(np.triu(cos >= threshold, 1))
                if lo[s] != hi[s]:  # pairs within one block belong to the block's own group
                    cross = home[s:e][first] != home[s:e][second]
                    first, second = first[cross], second[cross]
                if t[s]:
                    new = ~(sig[first, :t[s]] == sig[second, :t[s]]).any(axis=1)
                    first, second = first[new], second[new]
                if not len(first):
                    continue
                count = np.bincount(first, weights=size[s:e][second], minlength=e - s) \
                    + np.bincount(second, weights=size[s:e][first], minlength=e - s)
                linked = np.flatnonzero(count)
                a_out.append(ids[s:e][linked])
                b_out.append(ids[s:e][linked])
                w_out.append(count[linked].astype(np.int64))
                root = _forest(first, second, ids[s:e])
                child = np.flatnonzero(root != np.arange(e - s))
                a_out.append(ids[s:e][child])
                b_out.append(ids[s:e][root[child]])
                w_out.append(np.zeros(len(child), np.int64))
            if a_out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(v)) for v in (a_out, b_out, w_out)], schema=schema)
    return run


def _forest(first: np.ndarray, second: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Row number of the smallest id reachable from every row over the links."""
    n = len(ids)
    order = np.argsort(ids, kind="stable")
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    a, b = place[first], place[second]
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    return order[label[place]]


def embedding_links(df: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, block: int = BLOCK,
                    vec: str = "embedding", vec_id: str = "vec_id") -> DataFrame:
    """One row for each vector: vec_id, n_links, component_id, kept."""
    scratch = Scratch(df.sparkSession, "embedding-dedup")
    kind = "float" if df.schema[vec].dataType.simpleString() == "array<float>" else "double"
    rows = df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vec).cast(f"array<{kind}>").alias("embedding"))
    part = rows.filter(usable(F.col("embedding")) & F.col("vec_id").isNotNull())
    classes = scratch.write(part.groupBy("embedding").agg(F.min("vec_id").alias("class_id"), F.count("*").alias("copies")),
                            "classes")
    bits, tables = plan_tables(classes.count(), threshold, recall)
    # buckets above one block; the written table's size is known, so the planner broadcasts it only below its limit
    hot = scratch.write(classes.select("embedding").mapInArrow(_hashed(bits, tables, False), "t int, sig int, dim int")
                        .groupBy("t", "sig", "dim").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
                        .filter("blocks > 1"), "hot")
    hashed = classes.mapInArrow(_hashed(bits, tables, True),
                                "t int, sig int, dim int, class_id long, copies long, vec binary, sigs binary")
    blocks = F.coalesce("blocks", F.lit(1))
    placed = (hashed.join(hot, ["t", "sig", "dim"], "left")
              .withColumn("home", F.pmod(F.xxhash64("class_id", "t"), blocks).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
              .withColumns({"lo": F.least("home", "other"), "hi": F.greatest("home", "other")}).drop("other", "blocks"))
    keys = ["t", "sig", "dim", "lo", "hi"]
    verified = scratch.write(
        placed.repartition(*keys).sortWithinPartitions(*keys)
        .mapInArrow(_verify(threshold, np.float32 if kind == "float" else np.float64), "a long, b long, weight long"), "verified")
    counts = verified.filter("weight > 0").groupBy(F.col("a").alias("class_id")).agg(F.sum("weight").alias("n"))
    found = connected_components(verified.filter("weight = 0").select("a", "b"), scratch)
    of_class = (classes.join(counts, "class_id", "left")
                .join(found.withColumnRenamed("node", "class_id"), "class_id", "left")
                .select("embedding", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
                        F.coalesce("component", "class_id").alias("component_id")))
    return (rows.withColumn("takes", usable(F.col("embedding")) & F.col("vec_id").isNotNull())
            .withColumn("embedding", F.when(F.col("takes"), F.col("embedding")))
            .join(of_class, "embedding", "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component_id", "vec_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))))
