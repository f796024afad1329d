"""Substring dedup by unit hashing: keep the earliest occurrence of a repeated passage, remove the later ones.

Every text is cut into units: at line ends, after a sentence end (``.``, ``!`` or ``?`` and white space; ``。``, ``！`` or ``？``), at blanks
behind a character of a script written without blanks, and before a word that begins with a capital.  The cuts depend on the text next to them alone, so a passage gives the same units wherever it stands,
also in the middle of a line.  Units are normalised (lower case, single spaces), hashed to 128 bits and grouped globally.
A unit *repeats* if an occurrence of lower rank (doc_id, then place) exists.  A unit of fewer than ``MIN_UNIT_WORDS``
words says too little alone: it is hashed together with the units behind it, and with those before it, up to the next longer unit or
``MIN_WORDS`` words, and repeats if such a window does.  (A window that overlaps the earliest one of its digest does not count.)  A maximal
run of repeating units is removed if its units have ``min_words`` words or more; the removed span reaches from the run's first
character to its last, with the white space behind it.  Any unit that does not repeat ends the run.
Beside the units, whole lines of ``MIN_UNIT_WORDS`` words or more are hashed, and whole paragraphs (lines between blank lines) that hold a
shorter line.  One that repeats as such is removed whatever its length; the floor of ``min_words`` is for pieces cut from inside lines.
So what stays of earlier-seen text are pieces below that floor and lines of one or two words that stand alone.  A word is a stretch without blanks; in the scripts written without blanks
(Chinese, Japanese, Thai, Lao, Khmer, Burmese) every character is one.

Work: each text is cut once; one row for each unit (two for each short one) with its place in words and characters goes to a scratch table.  The
earliest rank of a digest is a minimum (map-side combined, so a digest with a third of all rows is harmless).  Digests seen twice are written, so that their
join with the occurrences can be split where a digest is hot (AQE splits no partition of an aggregate).  Occurrences of digests seen once, which
are most, are kept out of that join's shuffle by a Bloom filter of the others: its size is fixed (``FILTER_BITS`` at most) whatever the input, and
what it lets through wrongly the join drops.  Nothing gathers a digest's occurrences.  The repeats of a document meet its text by its key.

Defined results: a null or empty text has no units and is kept; rows with equal doc_id (null included) and equal text are the
same document and are treated alike (repeats inside it count once for all its copies); rows with equal doc_id and unlike texts are
ranked by a hash of the text; empty tables give empty results; all other columns are kept, and input columns named
``removed`` are replaced.
"""
from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch

MIN_WORDS = 13
MIN_UNIT_WORDS = 3
#: capital letters (category Lu), as a character class
_CAPITALS = "".join(re.escape(c) for c in map(chr, range(0x110000)) if unicodedata.category(c) == "Lu")
#: scripts written without blanks: Thai, Lao, Burmese, Khmer, kana, Han
_UNSPACED = "\u0e01-\u0eff\u1000-\u109f\u1780-\u17ff\u3041-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_CUT = re.compile(rf"(?<=[.!?])\s+|(?<=[。！？])\s*|(?<=[{_UNSPACED}])\s+|\n|\s(?=[{_CAPITALS}])")
#: the same cuts in a text without the characters of ``_DENSE``: every one begins with a blank, which the engine looks for quickly
_CUT_PLAIN = re.compile(rf"\s(?:(?<=[.!?].)\s*|(?<=\n)|(?=[{_CAPITALS}]))", re.DOTALL)
_DENSE = re.compile(rf"[。！？{_UNSPACED}]")
_WORD = re.compile(rf"[{_UNSPACED}]|[^\s{_UNSPACED}]+")

SPAN = "array<struct<start:int,end:int>>"


def count_words(norm: str) -> int:
    return norm.count(" ") + 1 if norm.isascii() else len(_WORD.findall(norm))


def cut(text: str) -> list[tuple[int, int, str, int]]:
    """(start, end, normalised text, words) of every unit that is not blank; the units of a text tile it but for blanks."""
    out, at = [], 0
    ascii_ = text.isascii()
    plain = ascii_ or not _DENSE.search(text)
    low = text.lower() if ascii_ else None      # other letters may change their number
    for end in [m.end() for m in (_CUT_PLAIN if plain else _CUT).finditer(text)] + [len(text)]:
        if end > at:
            words = (low[at:end] if ascii_ else text[at:end].lower()).split()
            if words:
                norm = " ".join(words)
                out.append((at, end, norm, len(words) if plain else count_words(norm)))
        at = end
    return out


def windows(units: list[tuple[int, int, str, int]]) -> list[tuple[int, int, str]]:
    """(first unit, units, hashed text): every long unit alone, every short one with its neighbours on either side."""
    alone: list[tuple[int, int, str]] = []
    out: dict[tuple[int, int], str] = {}    # of two units or more
    for i, (_, _, norm, n) in enumerate(units):
        if n >= MIN_UNIT_WORDS:
            alone.append((i, 1, norm))
            continue
        for step in (1, -1):
            total, j = n, i
            while total < MIN_WORDS and 0 <= j + step < len(units):
                j += step
                total += units[j][3]
                if units[j][3] >= MIN_UNIT_WORDS:
                    break
            else:
                if total < MIN_WORDS:
                    continue    # the text ends first: the window of the other side has these units
            a, b = min(i, j), max(i, j) + 1
            if (a, b - a) not in out:
                out[a, b - a] = " ".join(u[2] for u in units[a:b])
    return alone + [(a, n, t) for (a, n), t in out.items()]


def wholes(text: str, units: list[tuple[int, int, str, int]]) -> list[tuple[int, int, str]]:
    """(first unit, units as a negative number, hashed text) of whole lines, and of whole paragraphs that hold a line too short to be hashed by itself.

    The hashed text begins with a line end, or two, which no unit's has: a line is compared with lines only."""
    out: list[tuple[int, int, str]] = []
    line = par = 0
    lines: list[str] = []
    short = False
    for i, u in enumerate(units):
        ends = text.count("\n", u[0], units[i + 1][0]) if i + 1 < len(units) else 2
        if not ends:
            continue
        lines.append(" ".join(x[2] for x in units[line:i + 1]))
        if sum(x[3] for x in units[line:i + 1]) >= MIN_UNIT_WORDS:
            out.append((line, line - i - 1, "\n" + lines[-1]))
        else:
            short = True
        line = i + 1
        if ends > 1:
            if short and len(lines) > 1 and sum(x[3] for x in units[par:line]) >= MIN_UNIT_WORDS:
                out.append((par, par - line, "\n\n" + "\n".join(lines)))
            par, lines, short = line, [], False
    return out


_OCC = pa.schema([("doc_id", pa.int64()), ("place", pa.int64()), ("n", pa.int32()), ("start", pa.int32()), ("stop", pa.int32()),
                  ("w0", pa.int32()), ("w1", pa.int32()), ("d1", pa.int64()), ("d2", pa.int64())])
OCC = "doc_id long, place long, n int, start int, stop int, w0 int, w1 int, d1 long, d2 long"
FLUSH = 200_000
FILTER_BITS = 1 << 28      # 32 MB
KEY_BITS = 12              # bits of the filter for each digest, before rounding up to a power of two
PROBES = 4


def _digest(text: str) -> bytes:
    return xxhash.xxh3_128_digest(text if text.isascii() else text.encode("utf-8", "surrogatepass"))


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    docs: list = []
    rows: list[np.ndarray] = []     # of each text: place, n, start, stop, w0, w1
    digests: list[bytes] = []

    def flush():
        raw = np.frombuffer(b"".join(digests), dtype=">i8").reshape(-1, 2).astype(np.int64)
        cols = np.concatenate(rows, axis=1)
        return pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(cols[0]), *(pa.array(c.astype(np.int32)) for c in cols[1:]),
                                           pa.array(raw[:, 0]), pa.array(raw[:, 1])], schema=_OCC)

    for batch in batches:
        for doc_id, h, text in zip(batch.column("doc_id").to_pylist(), batch.column("_h").to_pylist(), batch.column("text")):
            text = text.as_py()
            if not text:
                continue
            units = cut(text)
            found = windows(units) + wholes(text, units)
            if not found:
                continue
            start, stop, _, n_words = zip(*units)
            before = np.concatenate([[0], np.cumsum(n_words)])
            i, n, hashed = zip(*found)
            i, n = np.array(i, np.int64), np.array(n, np.int64)
            end = i + np.abs(n)
            docs += [doc_id] * len(hashed)
            rows.append(np.stack([(h << 32) + i, n, np.array(start)[i], np.array(stop)[end - 1], before[i], before[end]]))
            digests += map(_digest, hashed)
            if len(docs) >= FLUSH:
                yield flush()
                docs, rows, digests = [], [], []
    if docs:
        yield flush()


def _keyed(docs: DataFrame) -> DataFrame:
    """With ``_h``, a hash of the text: places of one document are this hash in the high half, the unit's number in the low."""
    return docs.withColumn("_h", F.hash("text").bitwiseAND(0x7FFFFFFF))


def bloom_words(digests: DataFrame, bits: int) -> np.ndarray:
    """Filter of all (d1, d2): the 64-bit words are put together by a grouped bit_or, so the driver gets ``bits / 64`` numbers at most."""
    bit = F.explode(F.array(*[((F.shiftrightunsigned("d1", 8) + i * F.shiftrightunsigned("d2", 8)).bitwiseAND(bits - 1)) for i in range(PROBES)]))
    words = (digests.select(bit.alias("bit")).groupBy(F.shiftright("bit", 6).cast("int").alias("w"))
             .agg(F.bit_or(F.expr("shiftleft(1L, CAST(bit & 63 AS INT))")).alias("v")).toArrow())
    out = np.zeros(bits // 64, np.int64)
    out[words.column("w").to_numpy()] = words.column("v").to_numpy()
    return out


def _passing(filter_):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = filter_.value.view(np.uint64)
        mask = np.uint64(len(words) * 64 - 1)
        for batch in batches:
            d1, d2 = (batch.column(c).to_numpy().view(np.uint64) for c in ("d1", "d2"))
            ok = np.ones(len(d1), bool)
            for i in range(PROBES):
                bit = ((d1 >> np.uint64(8)) + np.uint64(i) * (d2 >> np.uint64(8))) & mask
                ok &= (words[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) == 1
            yield batch.filter(pa.array(ok))
    return run


def repeats(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """(doc_id, place, n, start, stop, w0, w1) of every window of which an earlier occurrence exists that it does not overlap."""
    spark = docs.sparkSession
    occ = scratch.write(_keyed(docs).select("doc_id", "_h", "text").mapInArrow(_occurrences, OCC), "units")
    first = scratch.write(
        occ.groupBy("d1", "d2").agg(F.min(F.struct("doc_id", "place", "n")).alias("first"), F.count("*").alias("seen"))
        .filter("seen > 1").select("d1", "d2", F.col("first.doc_id").alias("f_doc"),
                                   (F.col("first.place") + F.abs("first.n")).alias("f_end")), "first")
    bits = 1 << 10
    while bits < min(first.count() * KEY_BITS, FILTER_BITS):
        bits *= 2
    filter_ = spark.sparkContext.broadcast(bloom_words(first, bits))
    again = scratch.write(
        occ.mapInArrow(_passing(filter_), OCC).join(first.hint("merge"), ["d1", "d2"])
        .filter(~(F.col("doc_id").eqNullSafe(F.col("f_doc")) & (F.col("place") < F.col("f_end"))))
        .select("doc_id", "place", "n", "start", "stop", "w0", "w1"), "repeats")
    filter_.destroy()
    scratch.drop("units")
    scratch.drop("first")
    return again


def spans(marked: list[dict], min_words: int) -> list[tuple[int, int]]:
    """Removed spans of one text: the maximal runs of its repeating windows that have ``min_words`` words, and the whole lines.

    ``marked``: first unit ``i``, number of units ``n`` (negative for a whole line), characters ``start`` to ``stop``, words ``w0`` to ``w1``."""
    runs: list[list[int]] = []
    for m in sorted(marked, key=lambda m: m["i"]):
        end = m["i"] + abs(m["n"])
        if runs and m["i"] <= runs[-1][0]:
            if end > runs[-1][0]:
                runs[-1][0], runs[-1][2], runs[-1][4] = end, m["stop"], m["w1"]
        else:
            runs.append([end, m["start"], m["stop"], m["w0"], m["w1"]])
    gone = sorted([(r[1], r[2]) for r in runs if r[4] - r[3] >= min_words] + [(m["start"], m["stop"]) for m in marked if m["n"] < 0])
    out: list[tuple[int, int]] = []
    for a, b in gone:      # units tile the text but for blanks: spans of neighbouring units touch
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


def substring_dedup(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with repeated passages taken out of ``text``; ``removed`` lists their (start, end) in the original text."""
    docs = docs.drop("removed")
    marks = (repeats(docs, Scratch(docs.sparkSession, "substring-dedup")).groupBy("doc_id", F.shiftright("place", 32).cast("int").alias("_h"))
             .agg(F.collect_set(F.struct(F.col("place").bitwiseAND(0xFFFFFFFF).cast("int").alias("i"), "n", "start", "stop", "w0", "w1")).alias("_marks"))
             .withColumnRenamed("doc_id", "_doc").withColumnRenamed("_h", "_mh"))
    names, fields = docs.columns, docs.schema.fields
    joined = (_keyed(docs).join(marks, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("_h") == F.col("_mh")), "left")
              .select(*names, "_marks"))

    at = names.index("text")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, taken = [], []
            for text, marked in zip(batch.column("text"), batch.column("_marks")):
                text, marked = text.as_py(), marked.as_py()
                out = spans(marked, min_words) if text and marked else []
                if out:
                    keep, end = [], 0
                    for a, b in out:
                        keep.append(text[end:a])
                        end = b
                    text = "".join(keep) + text[end:]
                texts.append(text)
                taken.append([{"start": a, "end": b} for a, b in out])
            cols = [batch.column(i) for i in range(len(names))]
            cols[at] = pa.array(texts, pa.string())
            cols.append(pa.array(taken, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))))
            yield pa.RecordBatch.from_arrays(cols, names=[*names, "removed"])

    return joined.mapInArrow(remove, T.StructType([*fields, T.StructField("removed", T._parse_datatype_string(SPAN))]))
