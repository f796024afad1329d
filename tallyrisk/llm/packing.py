"""Packing along a space-filling curve.

Every document is encoded (byte-level BPE, then the end id), its token counts are hashed to a vector and projected to
``DIMS`` dimensions, and the point's Hilbert key orders the documents.  A range sort by (key, doc_id) puts neighbouring documents next to
each other, and each range packs its run of the curve by itself: documents are laid one behind the other and cut where a sequence is full,
so only the last sequence of a range is padded.  A key with very many documents is cut by doc_id like any other run.

One pass tokenises.  Whole stretches of ``length`` ids need no neighbours: each is a sequence of its own, and its checksum is taken at once.
Only the rest of a document (fewer than ``length`` ids, 2 bytes each) travels along the curve, since where it is cut depends on its
neighbours.  Tokenised documents are written to the shared scratch folder before the range sort, which reads its input twice.

The last sequence of a range may be cut further into sequences of power-of-two lengths (``power_of_two``), which need no
padding at all.

Token ids are those of the public vocabulary file, whose path is a parameter (see ``byte_bpe``: any text, also very long runs of blanks).

Defined results: a null or empty text is the end id alone; rows with null or equal doc_id are packed as documents of their own;
empty tables give empty results; other columns are ignored.
"""
from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .byte_bpe import byte_bpe
from .common import Scratch

LENGTH = 2048
END_ID = 1
DIMS = 3
BITS = 10            # of the Hilbert curve, for each dimension
HASHED = 1024        # size of the hashed count vector

SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "hilbert long")


@lru_cache(maxsize=1)
def _projection() -> np.ndarray:
    return np.random.default_rng(4099).standard_normal((HASHED, DIMS))


def point(ids: np.ndarray) -> np.ndarray:
    """A document's place in the unit cube: hashed counts, unit length, projected, squashed."""
    hashed = (ids.astype(np.uint32) * np.uint32(2654435761)) >> np.uint32(22)
    v = np.bincount(hashed, minlength=HASHED).astype(np.float64)
    n = np.sqrt((v * v).sum())
    return 1 / (1 + np.exp(-1.7 * (v @ _projection()) / (n or 1)))


def hilbert_key(points: np.ndarray) -> np.ndarray:
    """Hilbert curve index of points in the unit cube (rows), ``BITS`` bits a dimension.

    Each level of the curve is a Gray-coded cube whose sub-cubes are reflected and turned; undoing those from the highest bit down
    leaves coordinates whose interleaved bits are the index.
    """
    x = np.minimum((points * (1 << BITS)).astype(np.int64), (1 << BITS) - 1).T.copy()
    dims = len(x)
    q = 1 << (BITS - 1)
    while q > 1:
        p = q - 1
        for i in range(dims):
            high = (x[i] & q) != 0
            swap = (x[0] ^ x[i]) & p
            x[0] = np.where(high, x[0] ^ p, x[0] ^ swap)
            x[i] = np.where(high, x[i], x[i] ^ swap)
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    q = 1 << (BITS - 1)
    while q > 1:
        flip = np.where((x[-1] & q) != 0, flip ^ (q - 1), flip)
        q >>= 1
    x ^= flip
    key = np.zeros_like(x[0])
    for bit in range(BITS - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[i] >> bit) & 1)
    return key


def crc_of(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


_DOCS = pa.schema([("doc_id", pa.int64()), ("hilbert", pa.int64()), ("doc_tokens", pa.int64()),
                   ("whole_crc32", pa.list_(pa.int64())), ("rest", pa.binary())])
DOCS = "doc_id long, hilbert long, doc_tokens long, whole_crc32 array<long>, rest binary"


def _tokenised(path: str, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = byte_bpe(path, True)
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                points, tokens, crcs, rests = [], [], [], []
                for text in batch.column("text"):
                    ids = np.array(enc(text.as_py() or ""), dtype="<u2")
                    points.append(point(ids))
                    ids = np.append(ids, np.uint16(END_ID))
                    full = len(ids) // length * length
                    tokens.append(len(ids))
                    crcs.append([crc_of(ids[i:i + length]) for i in range(0, full, length)])
                    rests.append(ids[full:].astype("<u2").tobytes())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(hilbert_key(np.array(points))), pa.array(tokens, pa.int64()),
                     pa.array(crcs, pa.list_(pa.int64())), pa.array(rests, pa.binary())], schema=_DOCS)
    return run


def _packed(length: int, power_of_two: bool):
    """One range of the curve: whole stretches alone, rests one behind the other."""
    out_schema = pa.schema([(f.split()[0], pa.int64()) for f in SCHEMA.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seq = TaskContext.get().partitionId() << 36
        open_seq, used, seq = seq, 0, seq + 1
        tail: list[tuple] = []   # pieces of the open sequence: doc_id, start, ids, doc_tokens, hilbert
        for batch in batches:
            rows: list[tuple] = []
            cols = [batch.column(n).to_pylist() for n in ("doc_id", "hilbert", "doc_tokens", "whole_crc32", "rest")]
            for doc_id, key, tokens, crcs, rest in zip(*cols):
                for i, crc in enumerate(crcs):
                    rows.append((doc_id, i * length, length, crc, tokens, seq, 0, key))
                    seq += 1
                ids, at, start = np.frombuffer(rest, "<u2"), 0, len(crcs) * length
                while at < len(ids):
                    n = min(length - used, len(ids) - at)
                    tail.append((doc_id, start + at, ids[at:at + n], tokens, key))
                    at, used = at + n, used + n
                    if used == length:
                        rows += _closed(tail, open_seq)
                        tail, open_seq, used, seq = [], seq, 0, seq + 1
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], schema=out_schema)
        rows = []
        if power_of_two:
            # the last sequence falls into lengths that are powers of two, largest first
            while tail:
                size, part, rest, n = 1 << (used.bit_length() - 1), [], [], 0
                for doc_id, start, ids, tokens, key in tail:
                    k = max(0, min(len(ids), size - n))
                    if k:
                        part.append((doc_id, start, ids[:k], tokens, key))
                    if k < len(ids):
                        rest.append((doc_id, start + k, ids[k:], tokens, key))
                    n += k
                rows += _closed(part, open_seq)
                tail, used, open_seq, seq = rest, used - size, seq, seq + 1
        else:
            rows = _closed(tail, open_seq)
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], schema=out_schema)
    return run


def _closed(pieces: list[tuple], seq: int) -> list[tuple]:
    out, at = [], 0
    for doc_id, start, ids, tokens, key in pieces:
        out.append((doc_id, start, len(ids), crc_of(ids), tokens, seq, at, key))
        at += len(ids)
    return out


def pack(docs: DataFrame, tokenizer: str, length: int = LENGTH, power_of_two: bool = True) -> DataFrame:
    """One row for each piece: its place in its document and in its sequence, the checksum of its ids and the curve key."""
    scratch = Scratch(docs.sparkSession, "packing")
    tokens = scratch.write(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
                           .mapInArrow(_tokenised(tokenizer, length), DOCS), "tokens")
    order = ["hilbert", "doc_id", "doc_tokens"]
    return (tokens.repartitionByRange(*order).sortWithinPartitions(*order, "rest")
            .mapInArrow(_packed(length, power_of_two), SCHEMA))
