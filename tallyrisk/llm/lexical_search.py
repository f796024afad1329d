"""Ranked lexical search by length buckets of impact vectors.

A document's impact vector has, for each query term, the term's weight times its saturated frequency (integers, see ``weight`` and
``impact``); its score for an item is the inner product with the item's term counts.  The vectors are put in order of length (range sort by
Euclidean length, longest first) and cut into buckets of ``BUCKET`` neighbours:

* *Between buckets.*  By Cauchy-Schwarz no vector of a bucket scores above |item| x the bucket's greatest length.  A bucket whose
  bound lies below the item's threshold (its k-th best score so far) is passed over.
* *Inside a bucket.*  The item's ``FOCUS`` heaviest coordinates are summed exactly; what the other coordinates can add is at most
  |rest of the item| x |rest of the vector|.  Vectors whose bound lies below the threshold are left.
* *Survivors* are scored anew over all the item's terms in 64-bit integers; only these scores are compared and returned.

Bounds are doubles rounded up by a billionth, and a vector is left only if its bound is *below* the threshold, so ties survive and the result is
exact.  Buckets are visited in rounds: first the longest vectors (quantiles ``ROUNDS`` of length), whose k-th scores become the thresholds
that all tasks of the next round start with; tasks raise them further as they go.

Items are read in blocks of at most ``BLOCK_TERMS`` terms; a block's vocabulary, its thresholds and its k best rows for each item are what
the driver and the tasks hold, whatever the number of documents or items.  Documents are read once for each block; their term statistics (N, L, df)
are sums over all of them.  What is written for a document is its counts of the block's terms.

Terms are maximal runs of characters that are not ASCII, or are ASCII letters or digits; only A-Z are lower-cased.

Defined results: a null or empty text has no terms and is never returned; an item without terms has no rows; rows of documents with null doc_id count
in the statistics but are not ranked; rows with equal doc_id are documents of their own, and equal rows of equal score take a rank each; equal item rows are one
item, items of equal item_id and unlike texts are ranked apart; empty tables give empty results; other columns are ignored.
"""
from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, column, list_column

TOP = 10
BUCKET = 2048
FOCUS = 4
ROUNDS = (0.99, 0.9, 0.0)
BLOCK_TERMS = 100_000
#: upward rounding of bounds
UP = 1 + 1e-9

#: every byte that ends a term becomes a blank, A-Z become a-z; bytes of longer characters stay
_FOLD = bytes(b if b >= 0x80 or chr(b).isalnum() else 32 for b in range(256)).lower()


def terms(text: str | None) -> list[bytes]:
    """Terms of a whole text as UTF-8."""
    return (text or "").encode("utf-8").translate(_FOLD).split()


def weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def impact(w: np.ndarray, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return w * (1_000_000_000 * tf // (1000 * tf + 8 * m))


@dataclass
class Block:
    """Items of one block: vocabulary and sparse term counts."""

    items: list[tuple[int | None, dict[int, int]]]
    vocabulary: dict[bytes, int]


def blocks(items: DataFrame, size: int = BLOCK_TERMS) -> Iterator[Block]:
    """The items in blocks of bounded size, one on the driver at a time."""
    block = Block([], {})
    total = 0
    for row in items.toLocalIterator():
        counts = Counter(terms(row.text))
        if not counts:
            continue
        if total and total + len(counts) > size:
            yield block
            block, total = Block([], {}), 0
        total += len(counts)
        block.items.append((row.item_id, {block.vocabulary.setdefault(t, len(block.vocabulary)): c for t, c in counts.items()}))
    if total:
        yield block


# ------------------------------------------------------------------ term counts of documents

_TERMS = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("tids", pa.list_(pa.int32())), ("tfs", pa.list_(pa.int32()))])
TERMS = "doc_id long, n long, tids array<int>, tfs array<int>"


def _term_counts(vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = vocabulary.value.get
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                sizes, tids, tfs = [], [], []
                for text in batch.column("text"):
                    found = terms(text.as_py())
                    ids, counts = np.unique([i for i in map(get, found) if i is not None], return_counts=True)
                    sizes.append(len(found))
                    tids.append(ids.astype(np.int32))
                    tfs.append(counts.astype(np.int32))
                ends = np.concatenate([[0], np.cumsum([len(x) for x in tids])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(ends, pa.array(np.concatenate(tids))),
                     pa.ListArray.from_arrays(ends, pa.array(np.concatenate(tfs)))], schema=_TERMS)
    return run


_VECTORS = pa.schema([("doc_id", pa.int64()), ("length", pa.float64()), ("tids", pa.list_(pa.int32())), ("impacts", pa.list_(pa.int64()))])
VECTORS = "doc_id long, length double, tids array<int>, impacts array<long>"


def _impact_vectors(n_docs: int, n_terms: int, weights):
    """Impact vectors with their lengths; documents without weight are left out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = weights.value
        for batch in batches:
            if not batch.num_rows:
                continue
            tids, ends = list_column(batch, "tids")
            tids, tfs = tids[ends[0]:ends[-1]], list_column(batch, "tfs")
            tfs = tfs[0][tfs[1][0]:tfs[1][-1]].astype(np.int64)
            ends = ends - ends[0]
            m = np.array([25 + 75 * n * n_docs // max(n_terms, 1) for n in column(batch, "n").tolist()], dtype=np.int64)
            imp = impact(w[tids], tfs, np.repeat(m, np.diff(ends)))
            length = np.sqrt(np.add.reduceat(imp.astype(np.float64) ** 2, ends[:-1]))   # no row is empty
            out = pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(length), pa.ListArray.from_arrays(ends.astype(np.int32), pa.array(tids)),
                 pa.ListArray.from_arrays(ends.astype(np.int32), pa.array(imp))], schema=_VECTORS)
            yield out.filter(pa.array(length > 0))
    return run


# ------------------------------------------------------------------ search

@dataclass
class Queries:
    """A block's items as arrays: term ids, counts, focus coordinates, lengths, thresholds."""

    tids: list[np.ndarray]
    counts: list[np.ndarray]
    focus: list[np.ndarray]
    length: np.ndarray
    rest: np.ndarray
    least: np.ndarray
    terms: int


def prepared(block: Block, w: np.ndarray, least: np.ndarray) -> Queries:
    tids, counts, focus, length, rest = [], [], [], [], []
    for _, c in block.items:
        t = np.fromiter(c.keys(), np.int64, len(c))
        q = np.fromiter(c.values(), np.int64, len(c))
        order = np.lexsort((t, -(q * w[t])))
        t, q = t[order], q[order]
        q, t = q[w[t] > 0], t[w[t] > 0]
        tids.append(t)
        counts.append(q)
        focus.append(np.arange(min(FOCUS, len(t))))
        length.append(math.sqrt(float((q * q).sum())) * UP)
        rest.append(math.sqrt(float((q[FOCUS:] ** 2).sum())) * UP)
    return Queries(tids, counts, focus, np.array(length), np.array(rest), least, len(block.vocabulary))


class Best:
    """The k best (score, doc_id) of every item so far, and with them its threshold."""

    def __init__(self, least: np.ndarray, k: int):
        self.k, self.least = k, least.copy()
        none = np.zeros(0, np.int64)
        self.rows = [(none, none)] * len(least)

    def add(self, q: int, score: np.ndarray, doc: np.ndarray) -> None:
        s, d = self.rows[q]
        s, d = np.concatenate([s, score]), np.concatenate([d, doc])
        order = np.lexsort((d, -s))[:self.k]
        self.rows[q] = s[order], d[order]
        if len(order) == self.k:
            self.least[q] = max(self.least[q], s[order[-1]])


def search_bucket(doc: np.ndarray, length: np.ndarray, tids: np.ndarray, impacts: np.ndarray, ends: np.ndarray, qs: Queries, best: Best) -> None:
    """One bucket (rows in falling order of length) against all items whose bound reaches it."""
    open_ = np.flatnonzero((qs.length * (length[0] * UP) >= best.least) & (qs.length > 0))
    if not len(open_):
        return
    row_of = np.repeat(np.arange(len(doc)), np.diff(ends))
    order = np.argsort(tids, kind="stable")
    by_term, rows, imps = tids[order], row_of[order], impacts[order]
    squares = length * length
    dense = np.zeros(qs.terms, np.int64)
    for q in open_:
        t, c = qs.tids[q], qs.counts[q]
        part = np.zeros(len(doc), np.int64)
        seen = np.zeros(len(doc))
        a, b = np.searchsorted(by_term, t, "left"), np.searchsorted(by_term, t, "right")
        for f in qs.focus[q]:
            at = rows[a[f]:b[f]]
            part[at] += c[f] * imps[a[f]:b[f]]
            seen[at] += imps[a[f]:b[f]].astype(np.float64) ** 2
        # what is left of a vector, rounded up by the error of the difference
        left = np.sqrt(np.maximum(squares * UP - seen, 0)) * UP
        alive = np.flatnonzero(part * UP + qs.rest[q] * left >= max(best.least[q], 1))
        if not len(alive):
            continue
        dense[t] = c
        n = ends[alive + 1] - ends[alive]
        spot = np.repeat(ends[alive] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        score = np.add.reduceat(dense[tids[spot]] * impacts[spot], np.concatenate([[0], np.cumsum(n)[:-1]]))
        dense[t] = 0
        good = (score > 0) & (score >= best.least[q])
        if good.any():
            best.add(q, score[good], doc[alive[good]])


FOUND = "q int, doc_id long, score long"


def _search(queries, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        qs = queries.value
        best = Best(qs.least, k)
        for whole in batches:
            for at in range(0, whole.num_rows, BUCKET):
                batch = whole.slice(at, BUCKET)
                length = column(batch, "length")
                order = np.argsort(-length, kind="stable")
                if (order != np.arange(len(order))).any():
                    batch = batch.take(pa.array(order))
                    length = length[order]
                tids, ends = list_column(batch, "tids")
                imps, _ = list_column(batch, "impacts")
                tids, imps, ends = tids[ends[0]:ends[-1]], imps[ends[0]:ends[-1]], ends - ends[0]
                search_bucket(column(batch, "doc_id"), length, tids, imps, ends.astype(np.int64), qs, best)
        for q, (score, doc) in enumerate(best.rows):
            if len(score):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(score), q, np.int32)), pa.array(doc), pa.array(score)],
                                                 names=["q", "doc_id", "score"])
    return run


def _top(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("q").orderBy(F.col("score").desc(), "doc_id")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def _search_block(spark: SparkSession, texts: DataFrame, block: Block, k: int, scratch: Scratch, name: str) -> DataFrame:
    sc = spark.sparkContext
    vocabulary = sc.broadcast(block.vocabulary)
    counted = scratch.write(texts.mapInArrow(_term_counts(vocabulary), TERMS), f"{name}-terms")
    vocabulary.destroy()
    n_docs, n_terms = counted.filter("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = dict(map(tuple, counted.select(F.explode("tids").alias("t")).groupBy("t").count().collect()))
    w = np.array([weight(n_docs, df.get(t, 0)) for t in range(len(block.vocabulary))], dtype=np.int64)
    weights = sc.broadcast(w)
    vectors = (counted.filter("doc_id IS NOT NULL AND size(tids) > 0")
               .mapInArrow(_impact_vectors(n_docs, n_terms, weights), VECTORS))
    by_length = scratch.write(vectors.repartitionByRange(F.col("length").desc(), "doc_id")
                              .sortWithinPartitions(F.col("length").desc(), "doc_id"), f"{name}-vectors")
    weights.destroy()
    cuts = by_length.agg(F.percentile_approx("length", [float(x) for x in ROUNDS[:-1]], 10_000)).first()[0] or [0.0] * (len(ROUNDS) - 1)
    least = np.zeros(len(block.items), np.int64)
    found = None
    high = None
    for r, low in enumerate([*cuts, 0.0]):
        part = by_length.filter(F.col("length") >= low)
        if high is not None:
            part = part.filter(F.col("length") < high)
        high = low
        queries = sc.broadcast(prepared(block, w, least))
        rows = part.mapInArrow(_search(queries, k), FOUND)
        if found is not None:
            rows = rows.unionByName(found.drop("rank"))
        found = scratch.write(_top(rows, k), f"{name}-found{r}")
        queries.destroy()
        least = np.zeros(len(block.items), np.int64)
        for q, s in found.filter(F.col("rank") == k).select("q", "score").collect():
            least[q] = s
    scratch.drop(f"{name}-terms")
    scratch.drop(f"{name}-vectors")
    ids = spark.createDataFrame([(q, i) for q, (i, _) in enumerate(block.items)], "q int, item_id long")
    return found.join(F.broadcast(ids), "q").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents of every item."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "lexical-search")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    asked = items.select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for i, block in enumerate(blocks(asked)):
        out = out.unionByName(_search_block(spark, texts, block, k, scratch, f"b{i}"))
    return out
