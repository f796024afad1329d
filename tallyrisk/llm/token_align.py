"""Alignment of two tokenizers' tokens by lockstep merging, with corpus-wide link counts.

Both token sequences of a text tile the same bytes.  Two pointers walk them in byte order: the tokens under the pointers overlap (a link), the
one that ends first is passed, both are passed where they end together (a cut).  ``lockstep`` does this for all texts of a batch at once: one NumPy
state vector holds a pointer pair for each lane, every step emits the lanes' links and cuts and advances all pointers, and finished lanes are
compacted away.  So that a very long text does not walk alone, texts are split into lanes at cuts near every ``LANE`` tokens; a stretch without a
cut stays one lane, whatever its length.

**Counts.**  A document's distinct linked id pairs with their multiplicities are written once; one grouped count over them (combined map-side, at most one
row for each pair and task) says in how many documents each pair is linked, and which pairs are the most frequent of their A id.  These figures are then looked up from
the documents' pair lists.  The number of pairs is bounded by the vocabularies, not by the corpus, and a lookup holds ``SLICE`` pairs (plus one A id's):
larger tables are cut by A id into slices, each broadcast and passed over by itself, whose sums are added up for each document.  No document or pair row is shuffled for it.

A is a byte-level vocabulary file applied to a blank and the text, B a sentencepiece model that puts a blank in front itself.  Strings of special
tokens are plain text.

Defined results: a null or empty text, and one whose joined tokens of either side are not a blank and the text (U+2581 inside a text, say), has no
tokens: counts 0, groups ``''``, digest ``''``; rows are documents of their own, whatever their ids (null included); empty tables give empty results; other columns are ignored.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .byte_bpe import byte_bpe
from .common import Scratch, column, list_column

LANE = 512           # A tokens
SEEK = 64            # A tokens searched for a cut behind each
CHUNK = 1 << 20      # tokens aligned at once (a longer text alone)
SLICE = 4_000_000    # pairs looked up at once
BLANK = "▁"


class Sides:
    """Both tokenizers: ids and token bytes."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        self.a = byte_bpe(path_a, False)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_a = [b""] * (max(self.a.vocabulary.values()) + 1)
        for w, i in self.a.vocabulary.items():
            self.bytes_a[i] = w
        self.bytes_b = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.n_b = len(self.bytes_b)
        self.len_a, self.len_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))
        digits = len(str(max(len(self.bytes_a), self.n_b)))
        self.digits = np.zeros((max(len(self.bytes_a), self.n_b), digits + 1), np.uint8)
        self.width = np.zeros(len(self.digits), np.int64)
        for i in range(len(self.digits)):
            d = str(i).encode()
            self.digits[i, :len(d)] = np.frombuffer(d, np.uint8)
            self.width[i] = len(d)

    def _piece(self, i: int) -> bytes:
        if self.b.is_byte(i):
            return bytes([int(self.b.id_to_piece(i)[3:-1], 16)])
        if self.b.is_control(i) or self.b.is_unknown(i):
            return b""   # stands for no text: a text with it fails the comparison
        return self.b.id_to_piece(i).replace(BLANK, " ").encode("utf-8")

    def __call__(self, text: str | None) -> tuple[list[int], list[int]]:
        if not text:
            return [], []
        want = b" " + text.encode("utf-8")
        a, b = self.a(" " + text), self.b.encode(text)
        if b"".join(map(self.bytes_a.__getitem__, a)) != want or b"".join(map(self.bytes_b.__getitem__, b)) != want:
            return [], []
        return a, b


@lru_cache(maxsize=1)
def sides(path_a: str, path_b: str) -> Sides:
    return Sides(path_a, path_b)


def lanes(end_a: np.ndarray, end_b: np.ndarray, first_a: np.ndarray, first_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first A token, first B token, A token behind the last) of every lane; texts are given by ``first_a``, ``first_b`` (with the ends)."""
    targets = np.concatenate([np.arange(a + LANE, b - LANE // 2, LANE) for a, b in zip(first_a[:-1], first_a[1:])] or [np.zeros(0, np.int64)]).astype(np.int64)
    starts_a, starts_b = [first_a[:-1]], [first_b[:-1]]
    if len(targets):
        near = np.minimum(targets[:, None] + np.arange(min(SEEK, LANE // 2)), len(end_a) - 1)
        at = np.searchsorted(end_b, end_a[near])
        shared = (at < len(end_b)) & (end_b[np.minimum(at, len(end_b) - 1)] == end_a[near])
        hit = np.flatnonzero(shared.any(axis=1))
        spot = shared[hit].argmax(axis=1)
        starts_a.append(near[hit, spot] + 1)
        starts_b.append(at[hit, spot] + 1)
    a, b = np.concatenate(starts_a), np.concatenate(starts_b)
    a, keep = np.unique(a, return_index=True)   # a cut at a text's end is the next text's start
    b = b[keep]
    inside = a < len(end_a)
    a, b = a[inside], b[inside]
    return a, b, np.append(a[1:], len(end_a))


def lockstep(end_a: np.ndarray, end_b: np.ndarray, first_a: np.ndarray, first_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Links (A token, B token) and cuts (last A token, last B token) of texts laid end to end, by all lanes in step."""
    a, b, stop = lanes(end_a, end_b, first_a, first_b)
    link_a, link_b, cut_a, cut_b = [], [], [], []
    while len(a):
        ea, eb = end_a[a], end_b[b]
        link_a.append(a)
        link_b.append(b)
        cut = ea == eb
        cut_a.append(a[cut])
        cut_b.append(b[cut])
        a, b = a + (ea <= eb), b + (eb <= ea)
        on = a < stop
        if not on.all():
            a, b, stop = a[on], b[on], stop[on]
    none = [np.zeros(0, np.int64)]
    return tuple(np.concatenate(x or none) for x in (link_a, link_b, cut_a, cut_b))


def group_bytes(s: Sides, ids_a: np.ndarray, ids_b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray, first_a: np.ndarray,
                first_b: np.ndarray) -> list[bytes]:
    """``a1,a2|b1;a3|b2,b3`` of every text."""
    last_a, last_b = np.sort(cut_a), np.sort(cut_b)
    # a token's place among all: A tokens stand behind the B tokens of earlier groups, B tokens behind the A tokens of their own
    flag_a, flag_b = np.zeros(len(ids_a), bool), np.zeros(len(ids_b), bool)
    flag_a[last_a] = flag_b[last_b] = True
    group_a, group_b = np.cumsum(flag_a) - flag_a, np.cumsum(flag_b) - flag_b
    at_a = np.arange(len(ids_a)) + np.concatenate([[0], last_b + 1])[group_a]
    at_b = np.arange(len(ids_b)) + (last_a + 1)[group_b]
    cells = np.empty((len(ids_a) + len(ids_b), s.digits.shape[1]), np.uint8)
    width = np.empty(len(cells), np.int64)
    cells[at_a], cells[at_b] = s.digits[ids_a], s.digits[ids_b]
    width[at_a], width[at_b] = s.width[ids_a], s.width[ids_b]
    mark = np.full(len(cells), ord(","), np.uint8)
    mark[at_a[flag_a]], mark[at_b[flag_b]] = ord("|"), ord(";")
    cells[np.arange(len(cells)), width] = mark
    flat = cells.ravel()
    raw = flat[flat != 0].tobytes()
    ends = np.concatenate([[0], np.cumsum(width + 1)])[first_a + first_b]
    return [raw[x:y - 1] if y > x else b"" for x, y in zip(ends[:-1], ends[1:])]


_ALIGNED = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
                      ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("pairs", pa.list_(pa.int64())), ("times", pa.list_(pa.int32()))])
ALIGNED = ("row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, "
           "times array<int>")


def _ends(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def aligned_texts(s: Sides, tokens: list[tuple[list[int], list[int]]]) -> dict:
    """Everything the result needs of some texts' tokens: counts, groups, distinct pairs with their multiplicities."""
    n_a, n_b = (np.array([len(t[i]) for t in tokens], np.int64) for i in (0, 1))
    ids_a, ids_b = (np.fromiter((x for t in tokens for x in t[i]), np.int64, int(n.sum())) for i, n in ((0, n_a), (1, n_b)))
    first_a, first_b = _ends(n_a), _ends(n_b)
    link_a, link_b, cut_a, cut_b = lockstep(np.cumsum(s.len_a[ids_a]), np.cumsum(s.len_b[ids_b]), first_a, first_b)
    doc_of = np.repeat(np.arange(len(tokens)), n_a)
    space = len(s.bytes_a) * s.n_b
    keys, times = np.unique(doc_of[link_a] * space + ids_a[link_a] * s.n_b + ids_b[link_b], return_counts=True)
    return {"n_a": n_a, "n_b": n_b, "n_groups": np.bincount(doc_of[cut_a], minlength=len(tokens)),
            "n_links": np.bincount(doc_of[link_a], minlength=len(tokens)),
            "groups": group_bytes(s, ids_a, ids_b, cut_a, cut_b, first_a, first_b),
            "pairs": keys % space, "times": times, "ends": _ends(np.bincount(keys // space, minlength=len(tokens)))}


def _aligned(path_a: str, path_b: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = sides(path_a, path_b)
        row = TaskContext.get().partitionId() << 36
        ids: list = []
        tokens: list = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal row
            x = aligned_texts(s, tokens)
            rows = np.arange(row, row + len(ids))
            row += len(ids)
            ends = x["ends"].astype(np.int32)
            return pa.RecordBatch.from_arrays(
                [pa.array(rows), pa.array(ids, pa.int64()), *(pa.array(x[c].astype(np.int64)) for c in ("n_a", "n_b", "n_groups", "n_links")),
                 pa.array([hashlib.sha256(g).hexdigest() if g else "" for g in x["groups"]], pa.string()),
                 pa.ListArray.from_arrays(ends, pa.array(x["pairs"])), pa.ListArray.from_arrays(ends, pa.array(x["times"].astype(np.int32)))],
                schema=_ALIGNED)

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                a, b = s(text.as_py())
                if tokens and held + len(a) + len(b) > CHUNK:
                    yield flush()
                    ids, tokens, held = [], [], 0
                ids.append(doc_id)
                tokens.append((a, b))
                held += len(a) + len(b)
        if tokens:
            yield flush()
    return run


def link_counts(aligned: DataFrame, n_b: int) -> DataFrame:
    """(pair, n, a): in how many documents a pair is linked, and its A id."""
    return (aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))
            .withColumn("a", F.expr(f"CAST(pair DIV {n_b} AS INT)")))


_SUMS = pa.schema([("row", pa.int64()), ("n_best", pa.int64()), ("count_sum", pa.int64())])


def _looked_up(table):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n, best = table.value
        for batch in batches:
            if not batch.num_rows:
                continue
            pairs, ends = list_column(batch, "pairs")
            times, _ = list_column(batch, "times")
            pairs, times, ends = pairs[ends[0]:ends[-1]], times[ends[0]:ends[-1]].astype(np.int64), ends - ends[0]
            at = np.minimum(np.searchsorted(known, pairs), len(known) - 1)
            times = np.where(known[at] == pairs, times, 0)   # pairs of other slices
            total, top = (np.concatenate([[0], np.cumsum(x)]) for x in (times * n[at], times * best[at]))
            yield pa.RecordBatch.from_arrays([pa.array(column(batch, "row")), pa.array(top[ends[1:]] - top[ends[:-1]]),
                                              pa.array(total[ends[1:]] - total[ends[:-1]])], schema=_SUMS)
    return run


def align(docs: DataFrame, tokenizer_a: str, tokenizer_b: str, slice_pairs: int = SLICE) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256: one row for each row of ``docs``."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "token-align")
    aligned = scratch.write(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
                            .mapInArrow(_aligned(tokenizer_a, tokenizer_b), ALIGNED), "aligned")
    n_b = sides(tokenizer_a, tokenizer_b).n_b
    counts = scratch.write(link_counts(aligned, n_b), "counts")
    most = counts.groupBy("a").agg(F.max("n").alias("most"), F.count("*").alias("pairs"))
    # one row for each A id: bounded by the vocabulary
    per_a = most.select("a", "pairs").orderBy("a").collect()
    best = scratch.write(counts.join(most.select("a", "most"), "a").select("a", "pair", "n", (F.col("n") == F.col("most")).alias("best")), "best")
    sums = None
    for i, (low, high) in enumerate(_slices(per_a, slice_pairs)):
        part = best.filter(F.col("a").between(low, high)).select("pair", "n", "best").toArrow()
        known, n, flag = (column(part, c) for c in ("pair", "n", "best"))
        order = np.argsort(known)
        table = spark.sparkContext.broadcast((known[order], n[order], flag[order].astype(np.int64)))
        found = scratch.write(aligned.select("row", "pairs", "times").mapInArrow(_looked_up(table), "row long, n_best long, count_sum long"), f"sums{i}")
        table.destroy()
        sums = found if sums is None else sums.unionByName(found)
    kept = aligned.drop("pairs", "times")
    if sums is None:
        return kept.drop("row").withColumns({"n_best": F.lit(0).cast("long"), "count_sum": F.lit(0).cast("long")})
    total = sums.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return kept.join(total, "row").drop("row")


def _slices(per_a: list, size: int) -> Iterator[tuple[int, int]]:
    """Ranges of A ids with at most ``size`` pairs each (one id at least)."""
    low, total = None, 0
    for a, pairs in per_a:
        if low is None:
            low, total, high = a, pairs, a
        elif total + pairs > size:
            yield low, high
            low, total, high = a, pairs, a
        else:
            total, high = total + pairs, a
    if low is not None:
        yield low, high
