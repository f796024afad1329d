"""Approximate nearest neighbours: an NN-descent graph by iterative joins, and greedy search on it.

**Nodes** are the distinct vectors; a vector with very many copies is one node that knows its ``MEMBERS`` smallest ids (no
search needs more), found by a ranked window whose limit Spark applies before the shuffle.

**Graph.**  Every node starts with the nearest of its neighbours in a few random orders (sign hash, then one projection; a
range sort cut into blocks of ``BLOCK`` rows, so no bucket can be hot).  Then each round joins neighbours of neighbours: the
``JOINED`` nearest of a node's list and (at most ``REVERSE``, by hash) nodes that list it are brought together with their vectors by two
joins, compared with each other if one of the two is new, and pairs nearer than a node's worst neighbour update its list of
``K``.  Rounds stop when fewer than ``SETTLED`` of all list places change, or after ``rounds(nodes)``.

**Search** is greedy with a beam of ``beam_width(nodes)`` nodes a query, all queries at once: each round expands the nearest nodes not yet expanded,
joins their neighbours (both directions) with those nodes' vectors, and brings them together with the query's vector and its beam, of which the nearest stay.  It ends when every node
of every beam is expanded.  Beams start at the nearest of ``SEEDS`` sampled nodes and, for queries that are themselves indexed, at their
own node.  Building and search use half-precision vectors, each with a power of two of its own, so that no vector's size
costs another its precision, and distances in double precision; the nearest of the beam are then measured in double precision on the originals.

Every row is indexed; only the sample behind the mean and the seeds is bounded.  Recall is measured in the tests.

Defined results: vectors that are null, empty, zero or hold null or non-finite components take no part, nor do vectors of another length
than the commonest one (the longer of equally common ones) and null ids; equal vectors and equal distances are ranked by id; rows with equal id and
equal vector are one candidate; an empty table gives an empty result; extra columns are ignored.
"""
from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, column, list_column, row_groups
from .embedding_dedup import usable

K = 32             # length of a node's list
JOINED = 20        # of the list, nearest first, that takes part in a round's join
REVERSE = 20
TABLES = 4
BLOCK = 512
ROUNDS = 5         # at least; see ``rounds``
SETTLED = 0.02
BEAM = 240         # at least; see ``beam_width``
EXPANDED = 60      # nodes of a beam that a round of the search expands, nearest first
EXACT = 4          # times the asked number of neighbours: the nearest of a beam that are measured exactly
SEEDS = 256
SEARCH_ROUNDS = 400   # more is an error: a beam takes in nodes only while they are nearer
SAMPLE = 2000
SEED = 4242


def _matrix(batch, name: str) -> np.ndarray:
    values, offsets = list_column(batch, name)
    n = batch.num_rows
    return values[offsets[0]:offsets[-1]].reshape(n, -1) if n else values.reshape(0, 1)


def rounds(n: int) -> int:
    """Rounds of the descent over n nodes: ``ROUNDS`` up to 2^15, one more for every eightfold number."""
    return max(ROUNDS, ceil(log2(max(2, n)) / 3))


def beam_width(n: int) -> int:
    """Nodes of a query's beam over n nodes: ``BEAM`` up to 2^15, 16 more for every doubling."""
    return max(BEAM, 16 * ceil(log2(max(2, n))))


def _packed(x: np.ndarray) -> list[bytes]:
    """Each row as its power of two and its components in half precision, the largest of them in [2^14, 2^15)."""
    power = np.frexp(np.abs(x).max(axis=1))[1] - 15
    half = np.ldexp(x, -power[:, None]).astype(np.float16)
    # a component just below 2^15 may round up to it, which half precision holds
    return [p.tobytes() + r.tobytes() for p, r in zip(power.astype(np.int16), half)]


def _halves(batch) -> np.ndarray:
    raw = np.frombuffer(b"".join(column(batch, "half")), np.int16).reshape(batch.num_rows, -1)
    return raw[:, 1:].copy().view(np.float16) * np.ldexp(1.0, raw[:, :1].astype(np.int32))


def _squared(x: np.ndarray) -> np.ndarray:
    s = (x * x).sum(axis=1)
    return np.maximum(s[:, None] + s[None, :] - 2 * (x @ x.T), 0)


def _batch(**cols: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({k: pa.array(v) for k, v in cols.items()})


def _nearest(a: np.ndarray, b: np.ndarray, d: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k nearest distinct b of every a, in order of (a, d, b)."""
    if not len(a):
        return a, b, d
    o = np.lexsort((d, b, a))
    a, b, d = a[o], b[o], d[o]
    first = np.ones(len(a), bool)
    first[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    a, b, d = a[first], b[first], d[first]
    o = np.lexsort((b, d, a))
    a, b, d = a[o], b[o], d[o]
    take = _rank(a) < k
    return a[take], b[take], d[take]


def _rank(a: np.ndarray) -> np.ndarray:
    """Place of every row within its run of equal values."""
    at = np.arange(len(a))
    start = np.ones(len(a), bool)
    start[1:] = a[1:] != a[:-1]
    return at - np.maximum.accumulate(np.where(start, at, 0))


# ------------------------------------------------------------------ graph

def _orders(middle: np.ndarray, scale: float, bits: int):
    """Nodes in ``TABLES`` random orders: (t, sig, proj, node, half)."""
    rng = np.random.default_rng(SEED)
    planes = rng.standard_normal((TABLES, len(middle), bits + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch, "vec").astype(np.float64)
            half = pa.array(_packed((x - middle) / scale), pa.binary())
            for t in range(TABLES):
                p = (x - middle) @ planes[t]
                sig = ((p[:, :bits] >= 0) * (1 << np.arange(bits, dtype=np.int64))).sum(axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), t, np.int32)), pa.array(sig), pa.array(p[:, bits]),
                                                  batch.column("node"), half], names=["t", "sig", "proj", "node", "half"])
    return run


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nearest neighbours within consecutive blocks of a sorted run; a block starts with the second half of the one before."""
    ids, x = np.empty(0, np.int64), None

    def block(i: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
        d = _squared(v)
        np.fill_diagonal(d, np.inf)
        k = min(K, len(i) - 1)
        near = np.argpartition(d, k - 1, axis=1)[:, :k]
        return _batch(node=np.repeat(i, k), neigh=i[near].ravel(), d=np.take_along_axis(d, near, axis=1).ravel())

    fresh = 0
    for batch in batches:
        ids = np.concatenate([ids, column(batch, "node")])
        x = _halves(batch) if x is None else np.concatenate([x, _halves(batch)])
        fresh += batch.num_rows
        while len(ids) >= BLOCK:
            yield block(ids[:BLOCK], x[:BLOCK])
            ids, x = ids[BLOCK // 2:], x[BLOCK // 2:]
            fresh = len(ids) - (BLOCK - BLOCK // 2)
    if fresh > 0 and len(ids) > 1:
        yield block(ids, x)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Local joins: neighbours of one node against each other; pairs that improve a list."""
    kept: list[tuple] = []
    size = 0
    for whole, starts in row_groups(batches, ["v"]):
        u, new, worst, x = column(whole, "u"), column(whole, "new"), column(whole, "worst"), _halves(whole)
        for s, e in zip(starts[:-1], starts[1:]):
            if e - s < 2 or not new[s:e].any():
                continue
            d = _squared(x[s:e])
            take = (d < worst[s:e, None]) & (new[s:e, None] | new[None, s:e])
            np.fill_diagonal(take, False)
            i, j = np.nonzero(take)
            kept.append((u[s:e][i], u[s:e][j], d[i, j]))
            size += len(i)
            if size > 1_000_000:
                yield _batch(**dict(zip(("node", "neigh", "d"), _nearest(*(np.concatenate(c) for c in zip(*kept)), K))))
                kept, size = [], 0
    if kept:
        yield _batch(**dict(zip(("node", "neigh", "d"), _nearest(*(np.concatenate(c) for c in zip(*kept)), K))))


def _merged(rows: DataFrame) -> DataFrame:
    """Each node's list of the K nearest of ``rows`` (node, neigh, d, old), and which of them are new to it: one shuffle, by node."""
    pairs = rows.repartition("node").groupBy("node", "neigh").agg(F.min("d").alias("d"), F.max("old").alias("old"))
    return (pairs.withColumn("place", F.row_number().over(Window.partitionBy("node").orderBy("d", "neigh"))).filter(F.col("place") <= K)
            .select("node", "neigh", "d", (~F.col("old")).alias("new"), (F.col("place") - 1).alias("nth")))


def build_graph(nodes: DataFrame, scratch: Scratch) -> tuple[DataFrame, np.ndarray, float]:
    """(node, neigh, d, new, nth): lists of nearest nodes, and the middle and scale of half-precision vectors; ``nodes``: (node, vec) of one length.

    Half precision holds differences from the middle, so an offset that all vectors share costs none of it."""
    n = nodes.count()
    dim_rows = nodes.orderBy(F.xxhash64("node")).limit(SAMPLE).select("vec").toArrow()
    if n < 2:
        return scratch.write(nodes.limit(0).selectExpr("node", "node AS neigh", "CAST(0 AS double) AS d", "true AS new", "0 AS nth"), "graph"), np.zeros(1), 1.0
    # the median: a vector far larger than the others does not move it
    middle = np.median(_matrix(dim_rows, "vec").astype(np.float64), axis=0)
    scale = nodes.agg(F.max(F.array_max(F.transform("vec", lambda x: F.abs(x))))).first()[0] / 100.0
    bits = max(1, ceil(log2(max(2, n / (BLOCK / 2)))))
    spread = nodes.mapInArrow(_orders(middle, scale, bits), "t int, sig long, proj double, node long, half binary")
    spread = scratch.write(spread, "orders")
    edges = scratch.write(_merged(spread.repartitionByRange("t", "sig", "proj", "node").sortWithinPartitions("t", "sig", "proj", "node")
                                  .mapInArrow(_blocks, "node long, neigh long, d double").withColumn("old", F.lit(False))), "graph-0")
    halves = spread.filter("t = 0").select("node", "half")
    for r in range(1, rounds(n) + 1):
        worst = edges.filter(F.col("nth") == K - 1).select("node", F.col("d").alias("worst"))     # of full lists
        known = halves.join(worst, "node", "left").select(F.col("node").alias("u"), "half",
                                                          F.coalesce("worst", F.lit(float("inf"))).alias("worst"))
        part = edges.filter(F.col("nth") < JOINED)
        place = F.row_number().over(Window.partitionBy("v").orderBy("back", ~F.col("new"), F.xxhash64("u", F.lit(r))))
        around = (part.select(F.col("node").alias("v"), F.col("neigh").alias("u"), "new", F.lit(False).alias("back"))
                  .unionByName(part.select(F.col("neigh").alias("v"), F.col("node").alias("u"), "new", F.lit(True).alias("back")))
                  .withColumn("place", place).filter(F.col("place") <= JOINED + REVERSE)
                  .groupBy("v", "u").agg(F.max("new").alias("new")))
        found = (around.join(known, "u").select("v", "u", "new", "worst", "half").repartition("v").sortWithinPartitions("v")
                 .mapInArrow(_compare, "node long, neigh long, d double").withColumn("old", F.lit(False)))
        edges = scratch.write(_merged(edges.select("node", "neigh", "d", (~F.col("new") | (F.col("nth") < JOINED)).alias("old")).unionByName(found)), f"graph-{r}")
        scratch.drop(f"graph-{r - 1}")
        if edges.filter(f"new AND nth < {JOINED}").count() < SETTLED * JOINED * n:
            break
    return edges, middle, scale


# ------------------------------------------------------------------ search

def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Exact Euclidean distances."""
    for batch in batches:
        if batch.num_rows:
            x = _matrix(batch, "q_vec").astype(np.float64) - _matrix(batch, "vec").astype(np.float64)
            yield pa.RecordBatch.from_arrays([batch.column("q"), batch.column("node"), pa.array(np.sqrt((x * x).sum(axis=1)))],
                                             names=["q", "node", "d"])


def _halved(middle: np.ndarray, scale: float, *keep: str, name: str = "vec"):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            half = _packed((_matrix(batch, name).astype(np.float64) - middle) / scale)
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), pa.array(half, pa.binary())], names=[*keep, "half"])
    return run


def _seeded(ids: np.ndarray, seeds: np.ndarray, scale: float):
    """The nearest seeds of every query (seeds: a bounded block)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch, "q_vec").astype(np.float64)
            for at in range(0, len(x), 256):
                y = x[at:at + 256]
                d = (((y[:, None, :] - seeds[None, :, :]) / scale) ** 2).sum(axis=2)
                k = min(4, len(ids))
                near = np.argsort(d, axis=1, kind="stable")[:, :k]
                yield _batch(q=np.repeat(column(batch, "q")[at:at + 256], k), node=ids[near].ravel(), d=np.take_along_axis(d, near, axis=1).ravel())
    return run


QUERY, HELD, FOUND = range(3)      # rows that make a beam: the query's vector, a node with its distance, a node with its vector


def _apart(query: np.ndarray, of: np.ndarray, x: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Squared distance of every row of x to the query of its group ``to``, the nearest one if ``query`` (groups ``of``, ascending) has several."""
    first, last = np.searchsorted(of, to), np.searchsorted(of, to, "right")
    out = np.full(len(x), np.inf)
    for j in range(int((last - first).max(initial=0))):
        has = first + j < last
        out[has] = np.minimum(out[has], ((x[has] - query[first[has] + j]) ** 2).sum(axis=1))
    return out


def _beams(width: int):
    """From rows sorted by query: the nearest ``width`` nodes of each, and whether they were expanded."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole, starts in row_groups(batches, ["q"]):
            kind, d = column(whole, "kind"), column(whole, "d").copy()
            found = kind == FOUND
            if found.any():
                group, asked = np.repeat(np.arange(len(starts) - 1), np.diff(starts)), kind == QUERY
                d[found] = _apart(_halves(whole.filter(pa.array(asked))), group[asked], _halves(whole.filter(pa.array(found))), group[found])
            take = kind != QUERY
            q, node, d, done = column(whole, "q")[take], column(whole, "node")[take], d[take], column(whole, "done")[take]
            o = np.lexsort((~done, node, q))
            q, node, d, done = q[o], node[o], d[o], done[o]
            first = np.ones(len(q), bool)
            first[1:] = (q[1:] != q[:-1]) | (node[1:] != node[:-1])
            q, node, d, done = q[first], node[first], d[first], done[first]
            o = np.lexsort((node, d, q))
            q, node, d, done = q[o], node[o], d[o], done[o]
            take = _rank(q) < width
            q, node, d, done = q[take], node[take], d[take], done[take]
            o = np.lexsort((d, done, q))     # the nearest that are not expanded come first in each beam
            q, node, d, done = q[o], node[o], d[o], done[o]
            yield _batch(q=q, node=node, d=d, done=done, next=~done & (_rank(q) < EXPANDED))
    return run


def _reached(todo: DataFrame, neigh: DataFrame, beam: DataFrame) -> DataFrame:
    """(q, node) of neighbours of the nodes ``todo`` that are not in the beam: dealt by node once, as the join with the vectors wants them."""
    return (todo.join(neigh, "node").select("q", F.explode("neigh").alias("node"), F.lit(False).alias("held"))
            .unionByName(beam.select("q", "node", F.lit(True).alias("held")))
            .repartition("node").groupBy("q", "node").agg(F.max("held").alias("held")).filter("NOT held").select("q", "node"))


def search(nodes: DataFrame, graph: DataFrame, middle: np.ndarray, scale: float, queries: DataFrame, top: int, scratch: Scratch) -> DataFrame:
    """(q, node, d): the nearest ``EXACT * top`` nodes of the beam of every query (q, q_vec, own: its node or null), measured exactly."""
    neigh = (graph.withColumn("place", F.row_number().over(Window.partitionBy("neigh").orderBy("d", "node"))).filter(F.col("place") <= REVERSE)
             .select(F.col("neigh").alias("node"), F.col("node").alias("neigh")).unionByName(graph.select("node", "neigh"))
             .groupBy("node").agg(F.collect_set("neigh").alias("neigh")))
    neigh = scratch.write(neigh, "adjacency")   # at most K + REVERSE a node
    sample = nodes.orderBy(F.xxhash64(F.lit(SEED), "node")).limit(SEEDS).toArrow()
    seeded = queries.mapInArrow(_seeded(column(sample, "node"), _matrix(sample, "vec").astype(np.float64), scale), "q long, node long, d double")
    halves = scratch.write(nodes.mapInArrow(_halved(middle, scale, "node"), "node long, half binary"), "halves")
    asked = scratch.write(queries.mapInArrow(_halved(middle, scale, "q", name="q_vec"), "q long, half binary"), "asked")
    width = beam_width(nodes.count())
    own = queries.filter("own IS NOT NULL").select("q", F.col("own").alias("node"), F.lit(0.0).alias("d"))

    def held(rows: DataFrame) -> DataFrame:
        return rows.select("q", F.lit(HELD).alias("kind"), "node", "d", "done", F.lit(None).cast("binary").alias("half"))

    def beams(rows: DataFrame, name: str) -> DataFrame:
        return scratch.write(rows.repartition("q").sortWithinPartitions("q")
                             .mapInArrow(_beams(width), "q long, node long, d double, done boolean, next boolean"), name)

    # the queries' vectors come as rows beside the found nodes', so that one shuffle by query measures and ranks
    points = asked.select("q", F.lit(QUERY).alias("kind"), F.lit(0).cast("long").alias("node"), F.lit(0.0).alias("d"), F.lit(True).alias("done"), "half")
    beam = scratch.write(seeded.unionByName(own).withColumns({"done": F.lit(False), "next": F.lit(True)}), "beam-0")    # less than EXPANDED a query
    for r in range(1, SEARCH_ROUNDS):
        todo = beam.filter("next")
        if todo.isEmpty():
            break
        found = _reached(todo, neigh, beam).join(halves, "node").select("q", F.lit(FOUND).alias("kind"), "node", F.lit(0.0).alias("d"),
                                                                        F.lit(False).alias("done"), "half")
        beam = beams(held(beam.select("q", "node", "d", (F.col("done") | F.col("next")).alias("done"))).unionByName(found).unionByName(points), f"beam-{r}")
        scratch.drop(f"beam-{r - 1}")
    else:
        raise RuntimeError("the search did not settle")
    near = (beam.withColumn("place", F.row_number().over(Window.partitionBy("q").orderBy("d", "node")))
            .filter(F.col("place") <= EXACT * top + 1).select("q", "node"))
    return (near.join(nodes, "node").join(queries.select("q", "q_vec"), "q").select("q", "node", "q_vec", "vec")
            .mapInArrow(_measured, "q long, node long, d double"))


def nearest(df: DataFrame, is_query, top: int = 10, vec: str = "embedding", vec_id: str = "vec_id") -> DataFrame:
    """The ``top`` nearest other rows found for every row that ``is_query`` (a condition on vec_id): query_id, rank, vec_id, score."""
    scratch = Scratch(df.sparkSession, "nn-descent")
    kind = "float" if df.schema[vec].dataType.simpleString() == "array<float>" else "double"
    rows = (df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vec).cast(f"array<{kind}>").alias("vec"))
            .filter(usable(F.col("vec")) & F.col("vec_id").isNotNull()))
    length = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).limit(1).collect()
    rows = rows.filter(F.size("vec") == (length[0]["n"] if length else 0))
    members = top + 1
    by_vec = Window.partitionBy("vec").orderBy("vec_id")
    ranked = scratch.write(rows.distinct().withColumns({"nth": F.row_number().over(by_vec), "node": F.first("vec_id").over(
        by_vec.rowsBetween(Window.unboundedPreceding, Window.currentRow))}).filter(F.col("nth") <= members), "members")
    nodes = scratch.write(ranked.filter("nth = 1").select("node", "vec"), "nodes")
    of_node = ranked.select("node", "vec_id")
    asked = rows.filter(is_query).distinct().join(nodes, "vec").select(
        F.col("vec_id").alias("q"), F.col("vec").alias("q_vec"), F.col("node").alias("own"))
    asked = scratch.write(asked, "queries")
    graph, middle, scale = build_graph(nodes, scratch)
    found = search(nodes, graph, middle, scale, asked, top, scratch)
    hits = found.join(of_node, "node").filter("q <> vec_id")
    by = Window.partitionBy("q").orderBy("d", "vec_id")
    return (hits.withColumn("rank", F.row_number().over(by).cast("int")).filter(F.col("rank") <= top)
            .select(F.col("q").alias("query_id"), "rank", "vec_id", F.col("d").alias("score")))
